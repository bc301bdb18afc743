"""Facts laid out so that reads of one measurement and of one day both prune.

A fact foldered by date must open every day's folder to find one measurement.
Here rows are ordered along a curve: the bits of both dense keys interleaved
(``curve``), so a file covers a few small rectangles of (measurement, date). Files
are cut by range on (curve, timestamp): a measurement, or a single day of one,
that has a third of all rows is split over many files. ``_files`` beside the
data holds the least and greatest keys of each rectangle of a file, some five
rows a file, made from the written files; ``read`` asks it which files can hold
the wanted keys and opens only these. (One pair of bounds a file would not do:
a stretch of the curve that crosses the middle spans nearly everything.) The file
list of a read is what any scan's driver holds anyway.

Null keys lie first on the curve and are found by reads without bounds. An empty
table has no files and reads back empty; a folder is written once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bits taken from each key: two dense keys share a 62-bit number.
BITS = 31


def curve(a: str, b: str):
    """The low ``BITS`` bits of two whole numbers interleaved, ``a``'s in the higher places."""
    def spread(c: str, place: int):
        key = F.coalesce(F.col(c).cast("bigint"), F.lit(0))
        return [F.shiftleft(F.shiftright(key, i).bitwiseAND(F.lit(1)), 2 * i + place) for i in range(BITS)]

    bits = spread(a, 1) + spread(b, 0)
    out = bits[0]
    for bit in bits[1:]:
        out = out.bitwiseOR(bit)
    return out


def write(df: DataFrame, path: str, keys: tuple[str, str] = ("measurement_id", "date_id"), then: str = "timestamp",
          files: int | None = None) -> str:
    """Write ``df`` along the curve of ``keys``; ``files`` pins the number of
    ranges (otherwise ``spark.sql.shuffle.partitions`` and AQE give it)."""
    place = "_curve"
    while place in df.columns:
        place += "_"
    at = df.withColumn(place, curve(*keys))
    order = [place, then]
    ranged = at.repartitionByRange(files, *order) if files else at.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).drop(place).write.mode("errorifexists").parquet(f"{path}/data")
    written = df.sparkSession.read.schema(df.schema).parquet(f"{path}/data").select(
        F.col("_metadata.file_path").alias("file"), *[F.col(k).alias(f"key_{i}") for i, k in enumerate(keys)])
    at = written.withColumn("at", curve("key_0", "key_1"))
    size = at.groupBy("file").agg(F.max("at").alias("top")).agg(F.count(F.lit(1)).alias("files"), F.max("top").alias("top")).first()
    # squares of the curve, about four times as many as files: a file holds few of them
    square = max(0, (size["top"] or 0).bit_length() - (size["files"].bit_length() + 2))
    bounds = [f(f"key_{i}").alias(f"{name}_{i}") for i in range(2) for name, f in (("low", F.min), ("high", F.max))]
    (at.groupBy("file", F.shiftright("at", square).alias("square")).agg(F.count(F.lit(1)).alias("n_rows"), *bounds)
     .write.mode("errorifexists").parquet(f"{path}/_files"))
    return path


def files_for(spark: SparkSession, path: str, first: tuple | None = None, second: tuple | None = None) -> DataFrame:
    """The files that can hold keys within the given (low, high) bounds, with the
    number of rows of their rectangles that can."""
    found = spark.read.parquet(f"{path}/_files")
    for i, bounds in enumerate((first, second)):
        if bounds is not None:
            low, high = bounds
            found = found.filter((F.col(f"low_{i}") <= F.lit(high)) & (F.col(f"high_{i}") >= F.lit(low)))
    return found.groupBy("file").agg(F.sum("n_rows").alias("n_rows"))


def read(spark: SparkSession, path: str, schema: StructType, first: tuple | None = None, second: tuple | None = None,
         keys: tuple[str, str] = ("measurement_id", "date_id")) -> DataFrame:
    """The rows within the given bounds of the two keys (None: no bound), from
    the files that can hold them."""
    rows = spark.read.schema(schema)
    if first is None and second is None:
        return rows.parquet(f"{path}/data")
    paths = [r.file for r in files_for(spark, path, first, second).select("file").collect()]
    out = rows.parquet(*paths) if paths else spark.createDataFrame([], schema)
    for key, bounds in zip(keys, (first, second)):
        if bounds is not None:
            out = out.filter(F.col(key).between(*bounds))
    return out
