"""Mergeable states of the four questions (N10-N13 with B9, H6).

Q1-Q4 on the facts read all readings at every load. Here each measurement keeps
small rows from which the questions are answered, and a load makes new rows only
for the measurements that it holds; all other rows stay as they are:

* ``state_readings``, a row per (measurement, machine, material, part): counts,
  exact decimal sums, least and greatest voltage, and for the slope the count,
  both means and the two centred sums of (hours, voltage);
* ``state_density``, a row per (measurement, material, density bin, part);
* ``state_interval``, a row per (measurement, part): the first and last reading
  with a flow, the two end points that the trapezoid of a neighbour needs;
* ``state_volume``, a row per (measurement, material, part): the trapezoids
  that lie inside the part.

A part is a stretch of a measurement's time; readings are first cut by day, so a
measurement with a third of all readings is many parts. Two states of one
measurement merge when their parts do not overlap in time: sums add, centred
sums move to the common mean, and the trapezoid between two neighbouring parts
comes from their end points. ``compact`` folds a measurement's parts into one.
Rows without a time have a part of their own and no place in slope or volume.

Empty facts give empty states; extra columns of the facts are not read; null
values count as missing readings, as in the questions on the facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellstar.operators.keys import stage
from cellstar.operators.lookup import broadcast_if_small
from cellstar.plans.concurrent import run_concurrently
from cellstar.plans.questions import DENSITY_BIN, SHARED_FACT_COLUMNS

STATES = ["state_readings", "state_density", "state_interval", "state_volume"]
FLOWS = ["h2_flow", "h2_purity_percent"]
_MICROS_PER_HOUR = 3.6e9
_EXACT = "decimal(38,4)"
_READING_KEY = ["measurement_id", "machine_id", "electrode_material_id"]


class OverlappingParts(ValueError):
    """Two parts of one measurement share a stretch of time: they can't merge;
    the measurement has to be loaded as a whole."""


def _micros(c: str):
    return F.unix_micros(F.col(c).cast("timestamp"))


def _readings(fact_excel: DataFrame, fact_dat: DataFrame) -> DataFrame:
    """Both facts; machine 1 has no flows."""
    none = [F.lit(None).cast("decimal(10,4)").alias(c) for c in FLOWS]
    return (fact_excel.select(*SHARED_FACT_COLUMNS, *none, F.lit(0).alias("dat"))
            .unionByName(fact_dat.select(*SHARED_FACT_COLUMNS, *FLOWS, F.lit(1).alias("dat"))))


def reading_states(fact_excel: DataFrame, fact_dat: DataFrame) -> DataFrame:
    """``state_readings`` of the given fact rows, a part a day. Hours count from
    the day's midnight, so the centred sums keep their digits."""
    day = F.to_date("timestamp")
    rows = _readings(fact_excel, fact_dat).select(
        *_READING_KEY, day.alias("part"), "voltage_v", "current_a", *FLOWS, "dat",
        F.col("voltage_v").cast("double").alias("v"),
        ((_micros("timestamp") - F.unix_micros(day.cast("timestamp"))) / F.lit(_MICROS_PER_HOUR)).alias("h"))
    agg = rows.groupBy(*_READING_KEY, "part").agg(
        F.count(F.lit(1)).alias("n_readings"),
        F.sum("dat").cast("bigint").alias("n_dat"),
        F.count("voltage_v").alias("n_voltage"), F.sum("voltage_v").cast(_EXACT).alias("sum_voltage"),
        F.count("current_a").alias("n_current"), F.sum("current_a").cast(_EXACT).alias("sum_current"),
        F.count("h2_flow").alias("n_flow"), F.sum("h2_flow").cast(_EXACT).alias("sum_flow"),
        F.count("h2_purity_percent").alias("n_purity"), F.sum("h2_purity_percent").cast(_EXACT).alias("sum_purity"),
        F.min("voltage_v").alias("min_voltage"), F.max("voltage_v").alias("max_voltage"),
        F.regr_count("v", "h").alias("n"), F.regr_avgx("v", "h").alias("mean_h"), F.regr_avgy("v", "h").alias("mean_v"),
        F.regr_sxx("v", "h").alias("c_hh"), F.regr_sxy("v", "h").alias("c_hv"))
    return agg.withColumn("origin_us", F.unix_micros(F.col("part").cast("timestamp")))


_SUMS = ["n_readings", "n_dat", "n_voltage", "sum_voltage", "n_current", "sum_current", "n_flow", "sum_flow",
         "n_purity", "sum_purity"]


def fold_readings(states: DataFrame, by: list[str]) -> DataFrame:
    """The states of each group ``by`` merged into one row. The centred sums of a
    part grow by its count times the square of its mean's distance from the common
    mean, so means come first and are joined back: two partial aggregates, no
    group in one task. Mean hours count from the epoch while they are compared."""
    timed = F.col("n") > 0
    at = states.withColumn("_h", F.when(timed, F.col("mean_h") + F.col("origin_us") / F.lit(_MICROS_PER_HOUR)))
    n = F.sum(F.when(timed, F.col("n")))
    means = at.groupBy(*[F.col(c).alias(f"_by_{c}") for c in by]).agg(
        F.min(F.when(timed, F.col("origin_us"))).alias("_origin"),
        (F.sum(F.col("_h") * F.col("n")) / n).alias("_mh"),
        (F.sum(F.when(timed, F.col("mean_v") * F.col("n"))) / n).alias("_mv"))
    at = at.join(means, [at[c].eqNullSafe(means[f"_by_{c}"]) for c in by])
    dh, dv = F.col("_h") - F.col("_mh"), F.col("mean_v") - F.col("_mv")
    return at.groupBy(*by).agg(
        F.min("part").alias("part"),
        *[F.sum(c).cast("bigint" if c.startswith("n_") else _EXACT).alias(c) for c in _SUMS],
        F.min("min_voltage").alias("min_voltage"), F.max("max_voltage").alias("max_voltage"),
        F.sum("n").alias("n"),
        F.min(F.col("_mh") - F.col("_origin") / F.lit(_MICROS_PER_HOUR)).alias("mean_h"), F.min("_mv").alias("mean_v"),
        F.sum(F.when(timed, F.col("c_hh") + F.col("n") * dh * dh)).alias("c_hh"),
        F.sum(F.when(timed, F.col("c_hv") + F.col("n") * dh * dv)).alias("c_hv"),
        F.min("_origin").alias("origin_us"))


def density_states(fact_dat: DataFrame, dim_dat_metadata: DataFrame) -> DataFrame:
    """``state_density`` of the given machine 2 rows, a part a day."""
    area = broadcast_if_small(dim_dat_metadata.select("dat_metadata_id", "electrodes_area"))
    density = F.col("current_a").cast("double") * F.lit(1000.0) / F.col("electrodes_area").cast("double")
    return (fact_dat.filter(F.col("current_a").isNotNull() & F.col("voltage_v").isNotNull())
            .join(area, "dat_metadata_id").filter(F.col("electrodes_area") > 0)
            .select("measurement_id", "electrode_material_id", F.to_date("timestamp").alias("part"), "voltage_v",
                    (F.floor(density / F.lit(DENSITY_BIN)) * F.lit(int(DENSITY_BIN))).cast("bigint").alias("density_bin"))
            .groupBy("measurement_id", "electrode_material_id", "density_bin", "part")
            .agg(F.count(F.lit(1)).alias("n_readings"), F.sum("voltage_v").cast(_EXACT).alias("sum_voltage"),
                 F.min("voltage_v").alias("min_voltage"), F.max("voltage_v").alias("max_voltage")))


def _point(us, flow, material):
    return F.struct(us.alias("us"), flow.alias("flow"), material.alias("electrode_material_id"))


def flow_states(fact_dat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``state_interval`` and ``state_volume`` of the given machine 2 rows, a
    part a day. A trapezoid belongs to the material of its later reading."""
    rows = fact_dat.filter(F.col("h2_flow").isNotNull() & F.col("timestamp").isNotNull()).select(
        "measurement_id", "electrode_material_id", F.to_date("timestamp").alias("part"),
        _micros("timestamp").alias("us"), F.col("h2_flow").cast("double").alias("flow"))
    point = _point(F.col("us"), F.col("flow"), F.col("electrode_material_id"))
    ends = rows.groupBy("measurement_id", "part").agg(F.min(point).alias("first"), F.max(point).alias("last"))
    within = Window.partitionBy("measurement_id", "part").orderBy("us", "flow", "electrode_material_id")
    inside = rows.select("measurement_id", "electrode_material_id", "part", _trapezoid(
        F.lag("us").over(within), F.lag("flow").over(within), F.col("us"), F.col("flow")).alias("volume"))
    volume = inside.filter(F.col("volume").isNotNull()).groupBy(
        "measurement_id", "electrode_material_id", "part").agg(F.sum("volume").alias("volume"))
    return ends, volume


def _trapezoid(us0, flow0, us1, flow1):
    return (flow0 + flow1) / F.lit(2.0) * (us1 - us0) / F.lit(6e7)


def measurement_states(fact_excel: DataFrame, fact_dat: DataFrame, dim_dat_metadata: DataFrame) -> dict[str, DataFrame]:
    """The four state tables of the given fact rows, each written once."""
    interval, volume = flow_states(fact_dat)
    made = {"state_readings": reading_states(fact_excel, fact_dat),
            "state_density": density_states(fact_dat, dim_dat_metadata),
            "state_interval": interval, "state_volume": volume}
    return run_concurrently({k: (lambda k=k, df=df: stage(df, k)) for k, df in made.items()})


def replace_states(old: dict[str, DataFrame], new: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Measurements that ``new`` holds are replaced as a whole, all others
    keep their rows. Every fact row has a row in ``state_readings``, so that
    table names the measurements."""
    loaded = broadcast_if_small(stage(new["state_readings"].select("measurement_id").distinct(), "state_loaded"))
    return {k: old[k].join(loaded, "measurement_id", "left_anti").select(new[k].columns).unionByName(new[k])
            for k in STATES}


def append_states(old: dict[str, DataFrame], new: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """More readings of the same measurements, at times that no part of ``old``
    spans (else ``OverlappingParts``): the states are put together."""
    both = {k: old[k].unionByName(new[k]) for k in STATES}
    by_time = Window.partitionBy("measurement_id").orderBy("first.us", "last.us")
    bad = (both["state_interval"].withColumn("_before", F.lag("last.us").over(by_time))
           .filter(F.col("_before") >= F.col("first.us")).select("measurement_id").first())
    if bad is not None:
        raise OverlappingParts(f"measurement {bad[0]}: two parts share a stretch of time")
    return both


def seams(interval: DataFrame) -> DataFrame:
    """The trapezoids between neighbouring parts of a measurement, one row a part."""
    by_time = Window.partitionBy("measurement_id").orderBy("first.us")
    before = F.lag("last").over(by_time)
    return (interval.withColumn("_before", before).filter(F.col("_before").isNotNull())
            .select("measurement_id", F.col("first.electrode_material_id").alias("electrode_material_id"), "part",
                    _trapezoid(F.col("_before.us"), F.col("_before.flow"), F.col("first.us"), F.col("first.flow"))
                    .alias("volume")))


def compact(states: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Each measurement's parts folded into one, its intervals into one interval
    that holds the trapezoids between them; the answers stay the same."""
    inner = states["state_volume"].unionByName(seams(states["state_interval"]))
    made = {
        "state_readings": fold_readings(states["state_readings"], _READING_KEY).select(states["state_readings"].columns),
        "state_density": states["state_density"].groupBy("measurement_id", "electrode_material_id", "density_bin").agg(
            F.min("part").alias("part"), F.sum("n_readings").alias("n_readings"),
            F.sum("sum_voltage").cast(_EXACT).alias("sum_voltage"),
            F.min("min_voltage").alias("min_voltage"), F.max("max_voltage").alias("max_voltage")),
        "state_interval": states["state_interval"].groupBy("measurement_id").agg(
            F.min("part").alias("part"), F.min("first").alias("first"), F.max("last").alias("last")),
        "state_volume": inner.groupBy("measurement_id", "electrode_material_id").agg(
            F.min("part").alias("part"), F.sum("volume").alias("volume"))}
    return {k: df.select(states[k].columns) for k, df in made.items()}


def _mean(total: str, n: str, scale: int = 6):
    """As the questions on the facts round: an exact sum of the facts' type over its count."""
    return F.round(F.sum(total).cast("decimal(20,4)") / F.sum(n), scale).cast("double")


def q1_material_by_density(states: dict[str, DataFrame], dim_material: DataFrame) -> DataFrame:
    agg = states["state_density"].groupBy("electrode_material_id", "density_bin").agg(
        F.sum("n_readings").alias("n_readings"), _mean("sum_voltage", "n_readings").alias("avg_voltage_v"),
        F.min("min_voltage").alias("min_voltage_v"), F.max("max_voltage").alias("max_voltage_v"))
    return (agg.join(broadcast_if_small(dim_material), "electrode_material_id")
            .select("electrode_material", "density_bin", "n_readings", "avg_voltage_v", "min_voltage_v", "max_voltage_v"))


def q2_machine_compare(states: dict[str, DataFrame], dim_machine: DataFrame, dim_material: DataFrame) -> DataFrame:
    agg = states["state_readings"].groupBy("electrode_material_id", "machine_id").agg(
        F.sum("n_readings").alias("n_readings"), F.sum("n_voltage").alias("n_voltage"),
        _mean("sum_voltage", "n_voltage").alias("avg_voltage_v"), _mean("sum_current", "n_current").alias("avg_current_a"),
        F.min("min_voltage").alias("min_voltage_v"), F.max("max_voltage").alias("max_voltage_v"))
    return (agg.join(broadcast_if_small(dim_machine), "machine_id")
            .join(broadcast_if_small(dim_material), "electrode_material_id")
            .select("electrode_material", "machine_name", "n_readings", "n_voltage", "avg_voltage_v", "avg_current_a",
                    "min_voltage_v", "max_voltage_v"))


def q3_degradation(states: dict[str, DataFrame], dim_material: DataFrame) -> DataFrame:
    folded = fold_readings(states["state_readings"], ["measurement_id", "electrode_material_id"])
    slopes = folded.filter((F.col("n") >= 2) & (F.col("c_hh") > 0)).select(
        "electrode_material_id", (F.col("c_hv") / F.col("c_hh")).alias("slope"))
    agg = slopes.groupBy("electrode_material_id").agg(
        F.count(F.lit(1)).alias("n_measurements"), F.round(F.avg("slope"), 6).alias("avg_slope_v_per_h"),
        F.round(F.min("slope"), 6).alias("min_slope_v_per_h"), F.round(F.max("slope"), 6).alias("max_slope_v_per_h"))
    return (agg.join(broadcast_if_small(dim_material), "electrode_material_id")
            .select("electrode_material", "n_measurements", "avg_slope_v_per_h", "min_slope_v_per_h", "max_slope_v_per_h"))


def q4_h2_output(states: dict[str, DataFrame], dim_material: DataFrame, folded: bool = False) -> DataFrame:
    """``folded``: the states come from ``compact``; a measurement is one interval, without seams."""
    volumes = states["state_volume"]
    per = ((volumes if folded else volumes.unionByName(seams(states["state_interval"])))
           .groupBy("measurement_id", "electrode_material_id").agg(F.sum("volume").alias("volume")))
    volume = per.groupBy("electrode_material_id").agg(
        F.round(F.sum("volume"), 4).alias("h2_volume"), F.count(F.lit(1)).alias("n_measurements"))
    purity = states["state_readings"].filter("n_dat > 0").groupBy("electrode_material_id").agg(
        F.sum("n_dat").alias("n_readings"), _mean("sum_purity", "n_purity", 4).alias("avg_h2_purity_percent"),
        _mean("sum_flow", "n_flow").alias("avg_h2_flow"))
    return (purity.join(volume, "electrode_material_id", "left")
            .join(broadcast_if_small(dim_material), "electrode_material_id")
            .select("electrode_material", "n_readings", "n_measurements", "avg_h2_purity_percent", "avg_h2_flow",
                    "h2_volume"))
