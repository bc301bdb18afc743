"""Dimension building: distinct members, anti-join, dense keys, union.

The reference inserts one member at a time after a point lookup. Here the
members of all load batches (machine 1, then machine 2) are de-duplicated in
one aggregation, a member belongs to the first batch it appears in, the ones
already in an existing dimension are removed with one ``left_anti`` join
(null-safe when the natural key may hold NULL), and the rest are numbered
after the existing maximum in (batch, natural key) order -- the same keys a
batch-by-batch load gives, which ``dim_incremental`` checks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstar.functions.clean import date_of, time_key
from cellstar.operators.keys import dense_keys, known_rows, next_key, remember_rows


def _null_safe_on(left: DataFrame, right: DataFrame, cols: list[str]):
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in cols])


def new_members(members: DataFrame, existing: DataFrame | None, natural_key: list[str],
                null_safe: bool = False) -> DataFrame:
    """Members whose natural key is not yet in ``existing``."""
    if existing is None:
        return members
    ex = existing.select(*natural_key)
    if null_safe:
        return members.join(ex, _null_safe_on(members, ex, natural_key), "left_anti")
    return members.join(ex, natural_key, "left_anti")


def build_dimension(members: DataFrame | list[DataFrame], natural_key: list[str], key_col: str,
                    existing: DataFrame | None = None, null_safe: bool = False,
                    name: str | None = None) -> DataFrame:
    """Add the distinct ``members`` not in ``existing`` with keys after its maximum.

    ``members`` holds the natural key and the attributes. A list of member
    frames is a sequence of load batches (machine 1, then machine 2): a member
    belongs to the first batch it appears in and takes that batch's
    attributes; keys follow (batch, natural key) order, exactly as loading the
    batches one after the other would give. One shuffle per batch for the
    de-duplication, one range shuffle for the keys, whatever the batch count.
    """
    batches = members if isinstance(members, list) else [members]
    attrs = [c for c in batches[0].columns if c not in natural_key]
    tagged = reduce(DataFrame.unionByName, [
        b.select(*natural_key, *attrs, F.lit(i).alias("_batch")) for i, b in enumerate(batches)])
    if attrs:
        deduped = tagged.groupBy(*natural_key).agg(
            F.min("_batch").alias("_batch"),
            *[F.min_by(c, F.struct("_batch", c)).alias(c) for c in attrs])
    else:
        deduped = tagged.groupBy(*natural_key).agg(F.min("_batch").alias("_batch"))
    fresh = new_members(deduped, existing, natural_key, null_safe)
    base = next_key(existing, key_col)
    keyed = dense_keys(fresh, ["_batch", *natural_key], key_col, base=base, name=name or key_col)
    keyed = remember_rows(keyed.select(key_col, *natural_key, *attrs), known_rows(keyed))
    if existing is None:
        return keyed
    out = existing.select(key_col, *natural_key, *attrs).unionByName(keyed)
    n_old, n_new = known_rows(existing), known_rows(keyed)
    return remember_rows(out, n_old + n_new) if n_old is not None and n_new is not None else out


# --- the seven dimensions of the star schema ---------------------------------

def measurement_members(rows: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """N2 members: first and last reading per measurement (F1), a partial aggregate."""
    return (rows.groupBy("measurement_name")
            .agg(F.min(ts_col).alias("start_timestamp"), F.max(ts_col).alias("finish_timestamp")))


def date_members(rows: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """N3 members: distinct dates with day, month, year."""
    d = rows.select(date_of(ts_col).alias("date")).distinct()
    return d.select("date",
                    F.dayofmonth("date").cast("bigint").alias("day"),
                    F.month("date").cast("bigint").alias("month"),
                    F.year("date").cast("bigint").alias("year"))


def time_members(rows: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """N4 members: distinct time of day at microsecond grain with hour, minute, whole second."""
    t = rows.select(time_key(ts_col).alias("time"), F.col(ts_col).alias("_ts"))
    t = t.groupBy("time").agg(F.min("_ts").alias("_ts"))
    return t.select("time",
                    F.hour("_ts").cast("bigint").alias("hour"),
                    F.minute("_ts").cast("bigint").alias("minute"),
                    F.second("_ts").cast("bigint").alias("second"))


def operator_members(rows: DataFrame, name_col: str = "operator_name", levels: DataFrame | None = None,
                     level: str = "medium") -> DataFrame:
    """N5 members: distinct non-null operator names (D3, F3) with their level:
    the one the documents name (``levels``: operator_name, operator_level),
    ``level`` where none does."""
    from cellstar.operators.lookup import broadcast_if_small
    names = rows.filter(F.col(name_col).isNotNull()).select(F.col(name_col).alias("operator_name")).distinct()
    if levels is None:
        return names.select("operator_name", F.lit(level).alias("operator_level"))
    return names.join(broadcast_if_small(levels), "operator_name", "left").select(
        "operator_name", F.coalesce("operator_level", F.lit(level)).alias("operator_level"))


def operator_levels(metadata: DataFrame) -> DataFrame:
    """One level per operator named in the metadata. Where documents name
    several, the one that most documents name; of equally many, the first in
    alphabetical order."""
    named = metadata.filter(F.col("operator_name").isNotNull() & (F.coalesce("operator_level", F.lit("")) != ""))
    counted = named.groupBy("operator_name", "operator_level").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("operator_name").agg(F.min(F.struct((-F.col("n")).alias("n"), "operator_level")).alias("m")) \
        .select("operator_name", F.col("m.operator_level").alias("operator_level"))


def material_members(rows: DataFrame, col: str = "electrode_material") -> DataFrame:
    """N6 members: distinct non-null electrode materials."""
    return (rows.filter(F.col(col).isNotNull())
            .select(F.col(col).alias("electrode_material")).distinct())


DAT_METADATA_KEY = [
    "diaphragm", "thickness", "porosity", "electrolyte", "electrodes", "electrodes_area",
    "current_density_mode", "current_density_value", "pump_speed_mode", "pump_speed_value",
    "experiment_running_time",
]
