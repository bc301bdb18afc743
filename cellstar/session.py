"""Session construction and the shared scratch folder.

On a cluster the session is created by the platform; ``configure`` only
fills in settings the engine relies on when they are missing (UTC session
zone, AQE with skew handling). ``scratch_dir`` returns a
fresh folder below ``spark.checkpoint.dir`` -- the shared folder the cluster
names -- and only when that setting is absent (tests, local runs) sets one
below the system temp folder.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on; applied only if the session does not set them.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, so that Python
    steps find it wherever the session was started."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="cellstar-zip-")  # the driver's own file; Spark's file server hands it out
    spark.sparkContext.addPyFile(shutil.make_archive(
        os.path.join(folder, "cellstar"), "zip", os.path.dirname(package), os.path.basename(package)))
    _SHIPPED.add(app)


def configure(spark: SparkSession) -> SparkSession:
    ship_package(spark)
    for key, value in REQUIRED_CONF.items():
        if key == "spark.sql.session.timeZone" or spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, cores: int | None = None,
                app_name: str = "cellstar") -> SparkSession:
    """Local/test session builder. On a cluster use the provided session and
    call :func:`configure`."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cores}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.default.parallelism", str(cores))
        .config("spark.driver.memory", os.environ.get("CELLSTAR_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def _checkpoint_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        # Executors of a cluster would each write to a disk of their own.
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="cellstar-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint folder."""
    return f"{_checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
