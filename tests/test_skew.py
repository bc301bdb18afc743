"""A measurement holding a third of all rows is split over tasks, not sent to one."""

from pyspark.sql import functions as F

from cellstar.plans.star import build_star
from cellstar.sources import fixtures as fx
from paths import SMALL


def test_hot_measurement_spans_many_key_ranges(spark):
    rd = fx.readings(spark, SMALL)
    uid = F.substring("table_name", 2, 3).cast("int")
    hot = F.when((uid % 3 == 0) & F.col("table_name").startswith("2"), F.lit("2999_table"))
    rd = rd.withColumn("table_name", F.coalesce(hot, F.col("table_name")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        st = build_star(fx.sheet_rows(rd), fx.dat_rows(rd), fx.metadata_rows(rd))
        fact = st.fact_dat_measurements
        hot_id = st.dim_measurement.filter("measurement_name = '2999'").first()["measurement_id"]
        per_file = (fact.filter(F.col("measurement_id") == hot_id)
                    .groupBy(F.input_file_name().alias("f")).count().collect())
        n_hot = sum(r["count"] for r in per_file)
        n_all = fact.count()
        assert n_hot * 4 > n_all                       # the fixture really is skewed
        assert len(per_file) >= 3                      # ... yet spread over several key ranges
        assert max(r["count"] for r in per_file) < n_hot
        keys = fact.agg(F.min("fact_dat_measurement_id"), F.max("fact_dat_measurement_id"),
                        F.count_distinct("fact_dat_measurement_id")).first()
        assert tuple(keys) == (1, n_all, n_all)        # keys stay dense and unique
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
