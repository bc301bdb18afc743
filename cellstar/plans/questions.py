"""The four analysis questions on the star schema.

The reference states them as goals only; the formulas are ours:

* Q1 which material performs better at a given current density: mean cell
  voltage per material and 100 mA/cm² density bin (machine 2, which records
  the electrode area). Lower voltage at equal density is better.
* Q2 the same material on the two machines: reading counts and mean voltage /
  current per material and machine, over the union of both facts.
* Q3 which material degrades faster: least-squares slope of voltage over hours
  since the measurement's start, per measurement (>= 2 points), averaged per
  material. A larger slope is faster degradation.
* Q4 purity / volume of H2 per material: mean H2 purity, and H2 volume as the
  trapezoid integral of ``h2_flow`` (per minute) over time per measurement.

Every query aggregates on integer keys first (partial, map-side) and joins the
small named dimensions afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellstar.operators.lookup import broadcast_if_small

DENSITY_BIN = 100.0  # mA/cm² per bin


def _dbl(c: str):
    return F.col(c).cast("double")


def _mean(c: str, scale: int = 6):
    """Exact decimal sum / count, rounded half-up."""
    return F.round(F.sum(c) / F.count(c), scale).cast("double")


def q1_material_by_density(fact_dat: DataFrame, dim_dat_metadata: DataFrame,
                           dim_material: DataFrame) -> DataFrame:
    area = broadcast_if_small(dim_dat_metadata.select("dat_metadata_id", "electrodes_area"))
    density = _dbl("current_a") * F.lit(1000.0) / _dbl("electrodes_area")
    binned = (fact_dat.filter(F.col("current_a").isNotNull() & F.col("voltage_v").isNotNull())
              .join(area, "dat_metadata_id")
              .filter(F.col("electrodes_area") > 0)
              .select("electrode_material_id", "voltage_v",
                      (F.floor(density / F.lit(DENSITY_BIN)) * F.lit(int(DENSITY_BIN))).cast("bigint")
                      .alias("density_bin")))
    agg = binned.groupBy("electrode_material_id", "density_bin").agg(
        F.count(F.lit(1)).alias("n_readings"),
        _mean("voltage_v").alias("avg_voltage_v"),
        F.min("voltage_v").alias("min_voltage_v"),
        F.max("voltage_v").alias("max_voltage_v"))
    return (agg.join(broadcast_if_small(dim_material), "electrode_material_id")
            .select("electrode_material", "density_bin", "n_readings", "avg_voltage_v",
                    "min_voltage_v", "max_voltage_v"))


SHARED_FACT_COLUMNS = ["machine_id", "measurement_id", "timestamp", "electrode_material_id",
                       "voltage_v", "current_a", "operator_id"]


def shared_facts(fact_excel: DataFrame, fact_dat: DataFrame) -> DataFrame:
    """Both facts on the columns they share (same types by design)."""
    return (fact_excel.select(*SHARED_FACT_COLUMNS)
            .unionByName(fact_dat.select(*SHARED_FACT_COLUMNS)))


def q2_machine_compare(fact_excel: DataFrame, fact_dat: DataFrame, dim_machine: DataFrame,
                       dim_material: DataFrame) -> DataFrame:
    agg = shared_facts(fact_excel, fact_dat).groupBy("electrode_material_id", "machine_id").agg(
        F.count(F.lit(1)).alias("n_readings"),
        F.count("voltage_v").alias("n_voltage"),
        _mean("voltage_v").alias("avg_voltage_v"),
        _mean("current_a").alias("avg_current_a"),
        F.min("voltage_v").alias("min_voltage_v"),
        F.max("voltage_v").alias("max_voltage_v"))
    return (agg.join(broadcast_if_small(dim_machine), "machine_id")
            .join(broadcast_if_small(dim_material), "electrode_material_id")
            .select("electrode_material", "machine_name", "n_readings", "n_voltage",
                    "avg_voltage_v", "avg_current_a", "min_voltage_v", "max_voltage_v"))


def _hours_since(ts: str, start: str):
    return ((F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col(start).cast("timestamp")))
            / F.lit(3.6e9))


def measurement_slopes(fact_excel: DataFrame, fact_dat: DataFrame,
                       dim_measurement: DataFrame) -> DataFrame:
    """Voltage slope (V per hour) per measurement, >= 2 readings with a voltage."""
    start = broadcast_if_small(dim_measurement.select("measurement_id", "start_timestamp"))
    pts = (shared_facts(fact_excel, fact_dat).filter(F.col("voltage_v").isNotNull())
           .join(start, "measurement_id")
           .select("measurement_id", "electrode_material_id",
                   _dbl("voltage_v").alias("v"), _hours_since("timestamp", "start_timestamp").alias("h")))
    return (pts.groupBy("measurement_id", "electrode_material_id")
            .agg(F.regr_slope("v", "h").alias("slope"), F.count(F.lit(1)).alias("n"))
            .filter((F.col("n") >= 2) & F.col("slope").isNotNull()))


def q3_degradation(fact_excel: DataFrame, fact_dat: DataFrame, dim_measurement: DataFrame,
                   dim_material: DataFrame) -> DataFrame:
    slopes = measurement_slopes(fact_excel, fact_dat, dim_measurement)
    agg = slopes.groupBy("electrode_material_id").agg(
        F.count(F.lit(1)).alias("n_measurements"),
        F.round(F.avg("slope"), 6).alias("avg_slope_v_per_h"),
        F.round(F.min("slope"), 6).alias("min_slope_v_per_h"),
        F.round(F.max("slope"), 6).alias("max_slope_v_per_h"))
    return (agg.join(broadcast_if_small(dim_material), "electrode_material_id")
            .select("electrode_material", "n_measurements", "avg_slope_v_per_h",
                    "min_slope_v_per_h", "max_slope_v_per_h"))


def h2_volume_per_measurement(fact_dat: DataFrame) -> DataFrame:
    """Trapezoid volume per measurement over its readings with a flow, in time
    order (of equal times the smaller flow first); a gap of any length between
    two such readings is bridged.

    The previous reading is found inside buckets of one measurement and day, so
    a hot measurement is split; each bucket's first reading is then paired with
    the last one of the bucket before it, one row a bucket. Keys play no part,
    so it makes no difference in how many loads the rows came."""
    ts = F.unix_micros(F.col("timestamp").cast("timestamp"))
    rows = fact_dat.filter(F.col("h2_flow").isNotNull() & F.col("timestamp").isNotNull()).select(
        "measurement_id", "electrode_material_id", F.to_date("timestamp").alias("day"), ts.alias("us"),
        _dbl("h2_flow").alias("flow"))
    within = Window.partitionBy("measurement_id", "day").orderBy("us", "flow")
    seg = (F.col("flow") + F.lag("flow").over(within)) / F.lit(2.0) * (F.col("us") - F.lag("us").over(within)) / F.lit(6e7)
    point = F.struct("us", "flow", "electrode_material_id")
    buckets = rows.withColumn("seg", seg).groupBy("measurement_id", "day").agg(
        F.min(point).alias("first"), F.max(point).alias("last"))
    inside = rows.withColumn("seg", seg).filter(F.col("seg").isNotNull()).groupBy(
        "measurement_id", "electrode_material_id").agg(
        F.sum("seg").alias("h2_volume"))
    by_day = Window.partitionBy("measurement_id").orderBy("day")
    seams = (buckets.withColumn("before", F.lag("last").over(by_day)).filter(F.col("before").isNotNull())
             .select("measurement_id", F.col("first.electrode_material_id").alias("electrode_material_id"),
                     ((F.col("first.flow") + F.col("before.flow")) / F.lit(2.0)
                      * (F.col("first.us") - F.col("before.us")) / F.lit(6e7)).alias("h2_volume")))
    return (inside.unionByName(seams).groupBy("measurement_id", "electrode_material_id")
            .agg(F.sum("h2_volume").alias("h2_volume")))


def q4_h2_output(fact_dat: DataFrame, dim_material: DataFrame) -> DataFrame:
    vol = (h2_volume_per_measurement(fact_dat).groupBy("electrode_material_id")
           .agg(F.round(F.sum("h2_volume"), 4).alias("h2_volume"),
                F.count(F.lit(1)).alias("n_measurements")))
    purity = fact_dat.groupBy("electrode_material_id").agg(
        F.count(F.lit(1)).alias("n_readings"),
        _mean("h2_purity_percent", 4).alias("avg_h2_purity_percent"),
        _mean("h2_flow", 6).alias("avg_h2_flow"))
    return (purity.join(vol, "electrode_material_id", "left")
            .join(broadcast_if_small(dim_material), "electrode_material_id")
            .select("electrode_material", "n_readings", "n_measurements", "avg_h2_purity_percent",
                    "avg_h2_flow", "h2_volume"))
