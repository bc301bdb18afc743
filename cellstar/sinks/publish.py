"""Table sinks: create, append, replace and publish.

Tables are folders in a file format given as a parameter (Parquet here; no
table-format add-on is present). Publish commits all tables at once, as whole
tables, so running it twice leaves the same rows -- the reference's
append-on-rerun duplicates cannot happen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellstar.sinks import versions as V


def create_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Create from the data's schema; fails when the table exists."""
    df.write.mode("errorifexists").format(fmt).save(path)
    return path


def append(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Append rows to an existing table."""
    df.write.mode("append").format(fmt).save(path)
    return path


def replace_table(df: DataFrame, path: str, fmt: str = "parquet",
                  partition_by: list[str] | None = None) -> str:
    """Create or replace. With ``partition_by`` only the partitions
    present in ``df`` are replaced (dynamic partition overwrite), so reloading
    one measurement leaves the others untouched."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.save(path)
    return path


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


# Facts are partitioned by date so date-bounded questions read only their days.
DEFAULT_PARTITIONS = {"fact_excel_measurements": ["date_id"], "fact_dat_measurements": ["date_id"]}


def publish(tables: dict[str, DataFrame], root: str, fmt: str = "parquet",
            partition_by: dict[str, list[str]] | None = None, append: dict[str, DataFrame] | None = None,
            base: int | None = None, carry: bool = False, note: dict | None = None) -> dict[str, str]:
    """Publish the star-schema tables under ``root`` in one commit
    (``sinks/versions``); returns the folder of each table that was written.

    Readers see all new tables or all old ones; tables that are read while the
    new ones are made (a further load) stay readable. A failure, also of the
    commit, leaves the published version as it was."""
    spark = next(iter({**tables, **(append or {})}.values())).sparkSession
    parts = DEFAULT_PARTITIONS if partition_by is None else partition_by
    draft = V.prepare(spark, root, tables, append=append, partition_by=parts, base=base, carry=carry, fmt=fmt, note=note)
    V.commit(spark, draft)
    return {name: f"{draft.root}/{folders[-1]}" for name, folders in draft.tables.items()
            if name in tables or name in (append or {})}


def read_published(spark: SparkSession, root: str, version: int | None = None, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The published tables of one version (the newest when None)."""
    return V.read_version(spark, root, version, fmt)


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """H2: the first ``n`` rows in key order (repeatable, unlike a bare LIMIT)."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order_by]).limit(n)
