"""The star schema: seven dimensions and two facts.

Flow, one lazy plan per table:

    sheet rows (machine 1) --clean+enrich--> silver_excel --+
    .dat rows  (machine 2) --clean---------> silver_dat ----+--> dims (batch 1, batch 2) --> facts

Silver tables are written once (``stage``) so the dimension scans prune to the
columns they need and never recompute ingest. Dimensions are built with
machine 1 first; machine 2 adds only new members after the existing maximum.
Facts resolve every key with a join and take dense keys in
(measurement, timestamp, record) order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from cellstar.functions import clean as C
from cellstar.operators import dims as D
from cellstar.operators.metadata import enrich
from cellstar.operators.keys import dense_keys, known_rows, next_key, remember_rows, stage
from cellstar.operators.lookup import Lookup, broadcast_if_small, resolve_keys, small_lookups
from cellstar.plans.concurrent import run_concurrently
from cellstar.sources.fixtures import DAT_MEASURES

# Defaults for machine 1 when no metadata document names them.
MACHINE1_DEFAULT_OPERATOR = "Operator_2d226185_e3f33b7d"
MACHINE1_DEFAULT_MATERIAL = "1"
DEFAULT_OPERATOR_LEVEL = "medium"

# Fact keys follow this order; the source table (file) breaks ties between files
# of one measurement whose line numbers coincide.
FACT_ORDER = ["measurement_name", "timestamp", "record_id", "table_name"]

FACT_EXCEL_COLUMNS = [
    "fact_excel_measurement_id", "machine_id", "measurement_id", "timestamp", "date_id", "time_id",
    "electrode_material_id", "voltage_v", "current_a", "time_in_step", "record_id", "cycle",
    "step_id", "step_name", "capacity_mah", "energy_mwh", "operator_id",
]
FACT_DAT_COLUMNS = [
    "fact_dat_measurement_id", "machine_id", "measurement_id", "timestamp", "date_id", "time_id",
    "electrode_material_id", "dat_metadata_id", "voltage_v", "current_a", "h2_flow", "o2_flow",
    "h2_purity_percent", "o2_purity_percent", "h2_pressure_bar", "o2_pressure_bar",
    "h2_level_percent", "o2_level_percent", "set_pressure_bar", "cathode_temp_c",
    "anode_temp_c", "cell_inlet_temp_c", "operator_id",
]


def enrich_with_metadata(rows: DataFrame, metadata: DataFrame | None) -> DataFrame:
    """E8 + C14: operator, level and material per measurement from the metadata
    documents (left join); the fixed machine 1 values are only defaults."""
    defaults = {"operator_name": MACHINE1_DEFAULT_OPERATOR, "operator_level": DEFAULT_OPERATOR_LEVEL,
                "electrode_material": MACHINE1_DEFAULT_MATERIAL}
    if metadata is None:
        return rows.select("*", *[F.lit(v).alias(c) for c, v in defaults.items()])
    return enrich(rows, metadata, defaults)


def clean_sheet(sheet: DataFrame) -> DataFrame:
    """C1-C8, C12, C13 for machine 1 rows (the fact's typed columns)."""
    return sheet.selectExpr(
        "table_name",
        "substring_index(table_name, '_', 1) AS measurement_name",
        "concat('machine_', substring(table_name, 1, 1)) AS machine_name",
        "timestamp",
        "CAST(record_ID AS BIGINT) AS record_id",
        "CAST(cycle AS BIGINT) AS cycle",
        "CAST(step_ID AS BIGINT) AS step_id",
        "step_name",
        "CAST(time_in_step AS DECIMAL(18,8)) AS time_in_step",
        f"CAST(round({C.to_decimal_sql('voltage_V', 10, 4)}, 4) AS DECIMAL(10,4)) AS voltage_v",
        f"CAST({C.nan_to_null_sql('current_mA', DoubleType())} / 1000D AS DECIMAL(10,4)) AS current_a",
        f"{C.to_decimal_sql('capacity_mAh', 18, 8)} AS capacity_mah",
        f"{C.to_decimal_sql('energy_mWh', 18, 8)} AS energy_mwh",
        "to_date(timestamp) AS date",
        f"date_format(timestamp, '{C.TIME_KEY_FORMAT}') AS time",
    )


def clean_dat(dat: DataFrame) -> DataFrame:
    """C3-C5, C8, C9 for machine 2 rows: measures as decimal(10,4), header typed."""
    return dat.selectExpr(
        "table_name",
        "substring_index(table_name, '_', 1) AS measurement_name",
        "concat('machine_', substring(table_name, 1, 1)) AS machine_name",
        "CAST(record_id AS BIGINT) AS record_id",
        "timestamp",
        *[f"{C.to_decimal_sql(c, 10, 4)} AS {c}" for c in DAT_MEASURES],
        "operator AS operator_name",
        "electrodes AS electrode_material",
        "diaphragm",
        "CAST(thickness AS BIGINT) AS thickness",
        "CAST(porosity AS BIGINT) AS porosity",
        "electrolyte", "electrodes",
        f"{C.to_decimal_sql('electrodes_area', 10, 3)} AS electrodes_area",
        "current_density_mode",
        f"{C.to_decimal_sql('current_density_value', 10, 2)} AS current_density_value",
        "pump_speed_mode",
        f"{C.to_decimal_sql('pump_speed_value', 10, 2)} AS pump_speed_value",
        f"{C.to_decimal_sql('experiment_running_time', 10, 2)} AS experiment_running_time",
        "to_date(timestamp) AS date",
        f"date_format(timestamp, '{C.TIME_KEY_FORMAT}') AS time",
    )


@dataclass
class Star:
    silver_excel: DataFrame
    silver_dat: DataFrame
    dim_machine: DataFrame
    dim_measurement: DataFrame
    dim_date: DataFrame
    dim_time: DataFrame
    dim_operator: DataFrame
    dim_electrode_material: DataFrame
    dim_dat_metadata: DataFrame
    fact_excel_measurements: DataFrame
    fact_dat_measurements: DataFrame
    #: After a further load: the fact rows of that load alone, and whether it
    #: replaced rows that were there (if not, the facts only grew by these).
    fresh_facts: dict[str, DataFrame] | None = None
    replaced: bool = True

    def tables(self) -> dict[str, DataFrame]:
        return {k: v for k, v in self.__dict__.items() if k.startswith(("dim_", "fact_"))}


def _written(metadata: DataFrame | None) -> DataFrame | None:
    """The metadata rows, made once for the enrichment and the operators' levels."""
    return None if metadata is None else stage(metadata, "metadata")


def silver_tables(sheet: DataFrame, dat: DataFrame, metadata: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    out = run_concurrently({
        "s1": lambda: stage(enrich_with_metadata(clean_sheet(sheet), metadata), "silver_excel"),
        "s2": lambda: stage(clean_dat(dat), "silver_dat"),
    })
    return out["s1"], out["s2"]


def build_dimensions(s1: DataFrame, s2: DataFrame, existing: dict | None = None,
                     metadata: DataFrame | None = None) -> dict[str, DataFrame]:
    """Batch 1 from machine 1 rows, batch 2 (machine 2) continues the keys."""
    ex = dict(existing or {})
    levels = D.operator_levels(metadata) if metadata is not None else None
    specs = [
        ("dim_machine", ["machine_name"], "machine_id",
         lambda r: r.select("machine_name", F.col("machine_name").alias("machine_type")), False),
        ("dim_measurement", ["measurement_name"], "measurement_id",
         lambda r: D.measurement_members(r), False),
        ("dim_date", ["date"], "date_id", lambda r: D.date_members(r), False),
        ("dim_time", ["time"], "time_id", lambda r: D.time_members(r), False),
        ("dim_operator", ["operator_name"], "operator_id",
         lambda r: D.operator_members(r, levels=levels, level=DEFAULT_OPERATOR_LEVEL), False),
        ("dim_electrode_material", ["electrode_material"], "electrode_material_id",
         lambda r: D.material_members(r), False),
    ]
    jobs = {name: (lambda nk=nk, key=key, members=members, null_safe=null_safe, name=name:
                   D.build_dimension([members(s1), members(s2)], nk, key, existing=ex.get(name),
                                     null_safe=null_safe, name=name))
            for name, nk, key, members, null_safe in specs}
    jobs["dim_dat_metadata"] = lambda: D.build_dimension(
        s2.select(*D.DAT_METADATA_KEY), D.DAT_METADATA_KEY, "dat_metadata_id",
        existing=ex.get("dim_dat_metadata"), null_safe=True, name="dim_dat_metadata")
    return run_concurrently(jobs)


# The time-of-day join runs on microseconds since midnight (a bigint) rather than
# the HH:mm:ss.SSSSSS text: at scale dim_time is too large to broadcast, so this
# join shuffles the fact, and a long key halves the shuffled key bytes.
_TS_MICROS_OF_DAY = "pmod(unix_micros(CAST(timestamp AS TIMESTAMP)), 86400000000)"
_KEY_MICROS_OF_DAY = ("unix_micros(to_timestamp(concat('1970-01-01 ', time), "
                      f"'yyyy-MM-dd {C.TIME_KEY_FORMAT}'))")


def _time_lookup(dim_time: DataFrame) -> Lookup:
    dim = remember_rows(dim_time.selectExpr("time_id", f"{_KEY_MICROS_OF_DAY} AS time_us"), known_rows(dim_time))
    return Lookup(dim, "time_id", ["time_us"])


def _keyed_fact(silver: DataFrame, lookups: list[Lookup], columns: list[str], existing: DataFrame | None,
                name: str) -> DataFrame:
    """The fact's rows with dense keys (the first column) in ``FACT_ORDER``. Rows are
    dealt by range before the broadcast lookups, so the sample that finds the ranges
    only scans, and only the fact's columns are written."""
    key, *rest = columns
    small, large = small_lookups(lookups)
    rows = resolve_keys(silver.selectExpr("*", f"{_TS_MICROS_OF_DAY} AS time_us"), large)
    keyed = dense_keys(rows, FACT_ORDER, key, base=next_key(existing, key), name=name,
                       then=lambda ranged: resolve_keys(ranged, small), keep=rest)
    return remember_rows(keyed.select(*columns), known_rows(keyed))


def build_fact_excel(s1: DataFrame, dims: dict, existing: DataFrame | None = None) -> DataFrame:
    """Machine 1 fact; every lookup strict."""
    return _keyed_fact(s1, [
        Lookup(dims["dim_machine"], "machine_id", ["machine_name"]),
        Lookup(dims["dim_measurement"], "measurement_id", ["measurement_name"]),
        Lookup(dims["dim_date"], "date_id", ["date"]),
        _time_lookup(dims["dim_time"]),
        Lookup(dims["dim_electrode_material"], "electrode_material_id", ["electrode_material"]),
        Lookup(dims["dim_operator"], "operator_id", ["operator_name"]),
    ], FACT_EXCEL_COLUMNS, existing, "fact_excel")


def build_fact_dat(s2: DataFrame, dims: dict, existing: DataFrame | None = None,
                   metadata_lookup: str = "full") -> DataFrame:
    """Machine 2 fact. Operator is optional (E2). The metadata id is found
    on the whole header tuple, null-safe (E4, ``full``), or -- as the reference
    does -- the lowest id with the same electrodes (E3, ``first``)."""
    if metadata_lookup == "first":
        meta = Lookup(dims["dim_dat_metadata"], "dat_metadata_id", ["electrode_material"],
                      ["electrodes"], mode="first")
    else:
        meta = Lookup(dims["dim_dat_metadata"], "dat_metadata_id", D.DAT_METADATA_KEY, mode="null_safe")
    return _keyed_fact(s2, [
        Lookup(dims["dim_machine"], "machine_id", ["machine_name"]),
        Lookup(dims["dim_measurement"], "measurement_id", ["measurement_name"]),
        Lookup(dims["dim_date"], "date_id", ["date"]),
        _time_lookup(dims["dim_time"]),
        Lookup(dims["dim_electrode_material"], "electrode_material_id", ["electrode_material"]),
        Lookup(dims["dim_operator"], "operator_id", ["operator_name"], mode="optional"),
        meta,
    ], FACT_DAT_COLUMNS, existing, "fact_dat")


class UnresolvedKeyError(ValueError):
    """A strict lookup found no dimension member (E1: the load must fail)."""


def _check_all_rows_kept(silver: DataFrame, fact: DataFrame, name: str) -> None:
    n_in, n_out = silver.count(), known_rows(fact)
    if n_out is None:
        n_out = fact.count()
    if n_out < n_in:
        raise UnresolvedKeyError(f"{name}: {n_in - n_out} of {n_in} rows found no dimension member")
    if n_out > n_in:
        raise UnresolvedKeyError(f"{name}: {n_out - n_in} extra rows -- a lookup matched more than one member")


def update_star(existing: dict[str, DataFrame], sheet: DataFrame, dat: DataFrame, metadata: DataFrame | None = None,
                metadata_lookup: str = "full", strict: bool = True) -> Star:
    """H6: add a load to tables that exist (read from where they are published).

    Dimension members keep their keys, new ones continue after the maximum. A
    measurement that the load holds is replaced as a whole -- its fact rows,
    which take keys after the maximum, and its first and last reading -- and all
    other rows stay as they are. An operator's level follows the new documents
    where they name one.
    """
    metadata = _written(metadata)
    s1, s2 = silver_tables(sheet, dat, metadata)
    dims = build_dimensions(s1, s2, {k: v for k, v in existing.items() if k.startswith("dim_")}, metadata)
    loaded = stage(s1.select("measurement_name", "timestamp").unionByName(s2.select("measurement_name", "timestamp"))
                   .groupBy("measurement_name").agg(F.min("timestamp").alias("_first"), F.max("timestamp").alias("_last")),
                   "loaded_measurements")
    dims["dim_measurement"] = stage(
        dims["dim_measurement"].join(broadcast_if_small(loaded), "measurement_name", "left").select(
            "measurement_id", "measurement_name", F.coalesce("_first", "start_timestamp").alias("start_timestamp"),
            F.coalesce("_last", "finish_timestamp").alias("finish_timestamp")), "dim_measurement")
    if metadata is not None:
        levels = D.operator_levels(metadata).withColumnRenamed("operator_level", "_level")
        dims["dim_operator"] = stage(
            dims["dim_operator"].join(broadcast_if_small(levels), "operator_name", "left").select(
                "operator_id", "operator_name", F.coalesce("_level", "operator_level").alias("operator_level")),
            "dim_operator")
    old = {k: v for k, v in existing.items() if k.startswith("fact_")}
    new = run_concurrently({
        "fact_excel_measurements": lambda: build_fact_excel(s1, dims, old["fact_excel_measurements"]),
        "fact_dat_measurements": lambda: build_fact_dat(s2, dims, old["fact_dat_measurements"], metadata_lookup)})
    if strict:
        _check_all_rows_kept(s1, new["fact_excel_measurements"], "fact_excel_measurements")
        _check_all_rows_kept(s2, new["fact_dat_measurements"], "fact_dat_measurements")
    known = existing["dim_measurement"].join(loaded, "measurement_name", "left_semi").limit(1).count() > 0
    replaced = broadcast_if_small(dims["dim_measurement"].join(loaded, "measurement_name", "left_semi")
                                  .select("measurement_id"))
    facts = {k: v.join(replaced, "measurement_id", "left_anti").select(new[k].columns).unionByName(new[k])
             for k, v in old.items()}
    return Star(silver_excel=s1, silver_dat=s2, **facts, **dims, fresh_facts=new, replaced=known)


def build_star(sheet: DataFrame, dat: DataFrame, metadata: DataFrame | None = None,
               metadata_lookup: str = "full", strict: bool = True) -> Star:
    metadata = _written(metadata)
    s1, s2 = silver_tables(sheet, dat, metadata)
    dims = build_dimensions(s1, s2, metadata=metadata)
    facts = run_concurrently({
        "fe": lambda: build_fact_excel(s1, dims),
        "fd": lambda: build_fact_dat(s2, dims, metadata_lookup=metadata_lookup),
    })
    if strict:
        _check_all_rows_kept(s1, facts["fe"], "fact_excel_measurements")
        _check_all_rows_kept(s2, facts["fd"], "fact_dat_measurements")
    return Star(silver_excel=s1, silver_dat=s2, fact_excel_measurements=facts["fe"],
                fact_dat_measurements=facts["fd"], **dims)
