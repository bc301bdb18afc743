"""Parquet scans.

Parquet written by pandas stores timestamps as INT64 nanoseconds, which Spark
refuses unless ``spark.sql.legacy.parquet.nanosAsLong`` is on; the values then
arrive as bigint. ``read_parquet_nanos`` sets the flag only while the scan's
schema is resolved and narrows each named column to a microsecond timestamp
under a new name (``timestamp`` -> ``adjusted_timestamp``), as the silver step
of the reference does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"


def read_parquet_nanos(spark: SparkSession, path: str, narrow: dict[str, str]) -> DataFrame:
    """Read ``path``; each ``narrow`` column (INT64 nanoseconds) becomes a
    ``timestamp_ntz`` at microsecond precision named ``narrow[column]``."""
    before = spark.conf.get(NANOS_AS_LONG, None)
    spark.conf.set(NANOS_AS_LONG, "true")
    try:
        df = spark.read.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(NANOS_AS_LONG)
        else:
            spark.conf.set(NANOS_AS_LONG, before)
    cols = []
    for c in df.columns:
        if c in narrow:
            cols.append(F.expr(f"timestamp_micros(`{c}` div 1000)").cast("timestamp_ntz").alias(narrow[c]))
        else:
            cols.append(F.col(c))
    return df.select(*cols)
