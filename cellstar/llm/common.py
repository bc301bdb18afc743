"""Shared pieces of the operators: table access, Arrow columns as flat arrays,
written intermediate tables, row keys.

Conventions of all operators: a null text counts as the empty text; a null
``doc_id`` is kept and sorts before all others; a row repeated with the same
id and text gets the same result as its twin; columns of the input that an
operator does not name are ignored, so clashing names cannot disturb it.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellstar.session import scratch_dir, ship_package

#: Rows handed to Python at a time. Texts average a few kB and the longest
#: reach some MB, so a few hundred rows keep a worker's arrays small.
ARROW_ROWS = 256
#: Characters that one vectorised step handles at a time inside a worker.
CHUNK_CHARS = 1 << 19

#: The word pattern of the contracts.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """The package on the executors, and settings that the Arrow steps rely on."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) and the named columns."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


#: Spark's setting by which an execution's shuffle files go when it ends, not at
#: the driver's next garbage collection (from 4.1 on; earlier versions ignore it).
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there,
    and the files survive a lost executor. ``release``: its shuffle files go
    once it is written."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    if not release:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(*frames: DataFrame) -> None:
    """Remove the files of staged tables that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def schema(before: str, kept: list, after: str = "") -> T.StructType:
    """The columns of two DDL texts with the fields ``kept`` between them."""
    return T.StructType([*T.StructType.fromDDL(before).fields, *kept,
                         *(T.StructType.fromDDL(after).fields if after else ())])


def lean(run):
    """``run`` over the batches of a task, giving memory back to the system when
    the task ends: workers are kept for the next task, and share an executor's
    memory with its JVM."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if sys.platform == "linux":
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def text_chunks(batch: pa.RecordBatch, name: str = "text", limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of ``batch`` whose texts hold at most ``limit`` bytes
    together (a single longer text is a range of its own)."""
    ends = offsets_of(batch.column(name))
    a, n = 0, batch.num_rows
    while a < n:
        b = int(np.searchsorted(ends, ends[a] + limit, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


def offsets_of(column: pa.Array) -> np.ndarray:
    """Byte offsets (rows + 1) of a string or binary column without nulls."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    raw = np.frombuffer(column.buffers()[1], kind)
    return raw[column.offset:column.offset + len(column) + 1].astype(np.int64)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column as one array, and each row's offsets in it."""
    ends = offsets_of(column)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0]:ends[-1]], ends - ends[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the splitmix64 constants, fixed values)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def held_out(doc_id) -> F.Column:
    """True where crc32 of the id's decimal text leaves remainder 0 modulo 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
