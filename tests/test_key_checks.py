"""K1 by bitmaps and K4 by one tagged union: planted faults, equal reports, exchanges."""

import random

from cellstar.operators import checks as K


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def keys(spark, values):
    return spark.createDataFrame([(v, "x") for v in values], "k bigint, bucket string")


def test_dense_keys_find_repeated_and_missing(spark):
    r = random.Random(5)
    values = [k for k in range(1, 100_001) if k not in (7, 32_768, 32_769, 99_000)] + [5, 5, 40_000, 99_999, None, None, 0, -3]
    r.shuffle(values)
    tables = {"good": keys(spark, range(1, 70_001)), "bad": keys(spark, values), "none": keys(spark, []),
              "nulls": keys(spark, [None])}
    found = {x.table_name: x for x in K.check_dense_keys(tables, {t: "k" for t in tables}).collect()}
    exact = {x.table_name: x for x in K.check_unique(tables, {t: [["k"]] for t in tables}).collect()}
    for t in ("good", "bad", "nulls"):
        assert (found[t].n_rows, found[t].n_keys, found[t].n_duplicate_keys) == (
            exact[t].n_rows, exact[t].n_keys, exact[t].n_duplicate_keys)
    assert (found["good"].n_missing, found["good"].max_key) == (0, 70_000)
    assert (found["bad"].n_missing, found["bad"].n_duplicate_keys) == (4, 4)
    assert (found["none"].n_rows, found["none"].n_keys, found["none"].n_missing) == (0, 0, 0)


def test_dense_keys_shuffle_buckets_only(spark):
    """One row a bucket and task is dealt out, not one a key."""
    from pyspark.sql import functions as F
    df = spark.range(1, 200_001, 1, 4).select(F.col("id").alias("k"))
    rows = df.select("k", F.bitmap_bucket_number("k").alias("bucket"))
    partial = rows.withColumn("task", F.spark_partition_id()).groupBy("task", "bucket").count().count()
    assert partial <= 200_000 // 32_768 + 1 + 4
    assert K.check_dense_keys({"t": df}, {"t": "k"}).first().n_missing == 0


def test_references_equal_joins(spark):
    r = random.Random(6)
    fact = spark.createDataFrame([(r.choice([None, 1, 1, 1, 2, 9, 17]), r.choice([None, 3, 4, 5])) for _ in range(3000)],
                                 "a bigint, b int")
    other = spark.createDataFrame([(1,), (100,)], "a bigint")
    dim_a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "a_id bigint, name string")
    dim_b = spark.createDataFrame([], "b_id bigint")
    tables = {"fact": fact, "other": other, "dim_a": dim_a, "dim_b": dim_b, "empty": other.limit(0)}
    fks = [("fact", "a", "dim_a", "a_id"), ("fact", "b", "dim_b", "b_id"), ("other", "a", "dim_a", "a_id"),
           ("empty", "a", "dim_b", "b_id")]
    one = K.check_references(tables, fks)
    same = sorted(map(tuple, one.collect()))
    assert same == sorted(map(tuple, K.check_foreign_keys(tables, fks).collect()))
    assert same[-1][-1] == 1 and any(x[-1] > 0 for x in same)


def test_references_one_exchange_of_keys(spark):
    fact = spark.range(100).selectExpr("id as a", "id as b", "id as c")
    dims = {f"d{c}": spark.range(50).selectExpr(f"id as {c}") for c in "abc"}
    counts = []
    for n in (1, 3):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            found = K.check_references({"fact": fact, **dims}, [("fact", c, f"d{c}", c) for c in "abc"[:n]])
            counts.append(plan(found).count("Exchange hashpartitioning(ref") + plan(found).count("Exchange hashpartitioning(x"))
            assert {x.n_missing for x in found.collect()} == {50}
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert counts[0] == counts[1] and counts[1] >= 1
