"""Facts along a curve: one measurement and one day each read few files, every row is kept, hot keys are split."""

import random
import tempfile

from pyspark.sql import functions as F

from cellstar.sinks import clustered as CL

FACT = "measurement_id bigint, date_id bigint, timestamp bigint, _curve string"


def folder():
    return tempfile.mkdtemp(prefix="clustered-") + "/fact"


def test_curve_interleaves_bits(spark):
    r = random.Random(1)
    pairs = [(0, 0), (1, 0), (0, 1), (2 ** 31 - 1, 2 ** 31 - 1), *((r.getrandbits(31), r.getrandbits(31)) for _ in range(200))]

    def plain(a, b):
        return sum(((a >> i) & 1) << (2 * i + 1) | ((b >> i) & 1) << (2 * i) for i in range(31))

    got = spark.createDataFrame(pairs, "a bigint, b bigint").select("a", "b", CL.curve("a", "b").alias("z")).collect()
    assert all(x.z == plain(x.a, x.b) for x in got)


def test_one_measurement_and_one_day_read_few_files(spark):
    rows = spark.range(64 * 64 * 20).select((F.col("id") % 64 + 1).alias("measurement_id"),
                                            (F.floor(F.col("id") / 64) % 64 + 1).alias("date_id"),
                                            F.col("id").alias("timestamp"), F.lit("x").alias("_curve"))
    path = CL.write(rows, folder(), files=64)
    total = CL.files_for(spark, path).count()
    assert total >= 60
    one = CL.read(spark, path, rows.schema, first=(17, 17))
    day = CL.read(spark, path, rows.schema, second=(40, 40))
    cell = CL.read(spark, path, rows.schema, first=(17, 17), second=(40, 40))
    assert one.count() == day.count() == 64 * 20 and cell.count() == 20
    # 64 files, keys 1 to 64: a row or column crosses nine squares of 8 x 8 cells, each shared by two files
    assert len(one.inputFiles()) <= 18 and len(day.inputFiles()) <= 18 and len(cell.inputFiles()) <= 2
    # without the bounds by square a day would read more
    whole = spark.read.parquet(f"{path}/_files").groupBy("file").agg(F.min("low_1").alias("low"), F.max("high_1").alias("high"))
    assert whole.filter("low <= 40 and high >= 40").count() >= len(day.inputFiles())
    assert CL.read(spark, path, rows.schema).count() == rows.count()


def test_a_hot_day_of_a_measurement_is_split(spark):
    """Half of all rows are of one measurement and day."""
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 50).cast("bigint").alias("measurement_id"),
        F.when(F.col("id") % 2 == 0, 3).otherwise(F.col("id") % 30).cast("bigint").alias("date_id"),
        F.col("id").alias("timestamp"), F.lit(None).cast("string").alias("_curve"))
    path = CL.write(rows, folder(), files=16)
    assert max(r.n_rows for r in CL.files_for(spark, path).collect()) < 8_000
    assert CL.read(spark, path, rows.schema, first=(7, 7), second=(3, 3)).count() == rows.filter(
        "measurement_id = 7 and date_id = 3").count()


def test_nulls_and_empty(spark):
    some = spark.createDataFrame([(None, 1, 5, "a"), (1, None, None, "b"), (1, 1, 1, "c"), (1, 1, 1, "c")], FACT)
    path = CL.write(some, folder())
    assert sorted(map(str, CL.read(spark, path, some.schema).collect())) == sorted(map(str, some.collect()))
    assert CL.read(spark, path, some.schema, first=(1, 1)).count() == 3
    assert CL.read(spark, path, some.schema, first=(9, 9)).count() == 0
    none = CL.write(some.limit(0), folder())
    assert CL.read(spark, none, some.schema).count() == 0 and CL.read(spark, none, some.schema, first=(1, 1)).count() == 0
