"""Readings derived from the driver tables.

The instruments' own files are not available, so the readings come from the
``events`` table through the fixed view text below (shared with the SQL
oracle). Two typed-as-landed frames are derived from it:

* ``sheet_rows``  -- machine 1 workbook rows (one table per measurement),
* ``dat_rows``    -- machine 2 ``.dat`` rows with the file header attached.

Header values of a ``.dat`` file are constant per file; they are derived from
the smallest ``k`` of the measurement, computed with a partial aggregation
(no window over a measurement, so a hot measurement never lands in one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellstar.functions.clean import measurement_name

# Fixed value: the readings view, text identical to the one the SQL oracle runs.
READINGS_SQL = """
select event_id as record_id, ts as reading_ts,
 concat(case when user_id % 2 = 0 then '1' else '2' end, lpad(cast(user_id as string), 3, '0'), '_table') as table_name,
 concat('step_', event_type) as step_name,
 concat('Operator_', cast(cast(regexp_extract(props, '([0-9]+)', 1) as bigint) % 7 as string)) as operator_name,
 case when user_id % 4 < 2 then 'material_A' else 'material_B' end as electrode_material,
 case when cast(regexp_extract(props, '([0-9]+)', 1) as bigint) % 10 = 0 then 'NAN' else cast(value as string) end as voltage_raw,
 case when event_id % 50 = 0 then null else value * 10 end as current_ma,
 cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k
from {events}
"""

# Header text of a machine 2 file, names exactly as the instrument writes them.
DAT_HEADER_KEYS = [
    "Operator", "Diaphragm", "Thikness", "Porosity", "Electrolyte", "Electrodes",
    "Electrodes Area [cm²]", "Current Density Mode", "Value [mA/cm²]",
    "Pump Speed Mode", "Value [ml/min]", "Experiment Running Time [h]",
]
# Table columns of a machine 2 file, in file order.
DAT_TABLE_COLUMNS = [
    "TimeStamp", "Voltage [V]", "H2 Flow", "O2 Flow", "H2 Purity [%]", "O2 Purity [%]",
    "Current [A]", "H2 Pressure [bar]", "O2 Pressure [bar]", "SetPressure [bar]",
    "Cathode Temp [°C]", "Anode Temp [°C]", "Cell Inlet Temp [°C]", "[H2 Level [%]", "O2 Level [%]",
]
# Clean column names used once a file is ingested (same order as the two lists above).
DAT_HEADER_FIELDS = [
    "operator", "diaphragm", "thickness", "porosity", "electrolyte", "electrodes",
    "electrodes_area", "current_density_mode", "current_density_value",
    "pump_speed_mode", "pump_speed_value", "experiment_running_time",
]
DAT_MEASURES = [
    "voltage_v", "h2_flow", "o2_flow", "h2_purity_percent", "o2_purity_percent",
    "current_a", "h2_pressure_bar", "o2_pressure_bar", "set_pressure_bar",
    "cathode_temp_c", "anode_temp_c", "cell_inlet_temp_c", "h2_level_percent", "o2_level_percent",
]
DAT_HEADER_MAP = dict(zip(DAT_HEADER_KEYS, DAT_HEADER_FIELDS))
DAT_COLUMN_MAP = dict(zip(DAT_TABLE_COLUMNS, ["timestamp"] + DAT_MEASURES))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings view (one row per reading of either machine)."""
    return spark.sql(READINGS_SQL, events=events(spark, sf_dir))


def machine_readings(rd: DataFrame, machine: str) -> DataFrame:
    """Rows of the tables of one machine (first digit of the name)."""
    return rd.filter(F.col("table_name").rlike("^[0-9]") & F.col("table_name").startswith(machine))


def _first_by(rows: DataFrame, name) -> DataFrame:
    """Least time, ``k`` and material of each ``name``. Materials are grouped first:
    the least of a text can't be kept in a hash aggregate, which then sorts all rows."""
    each = rows.groupBy(name, "electrode_material").agg(F.min("reading_ts").alias("start_ts"), F.min("k").alias("hk"))
    return each.groupBy(each.columns[0]).agg(
        F.min("start_ts").alias("start_ts"), F.min("hk").alias("hk"), F.min("electrode_material").alias("hk_material"))


def _measurement_start(rows: DataFrame) -> DataFrame:
    return _first_by(rows, measurement_name("table_name").alias("measurement_name"))


def sheet_rows(rd: DataFrame) -> DataFrame:
    """Machine 1 workbook rows, typed as a sheet reader lands them.

    ``time_in_step`` is seconds since the first reading of the measurement;
    capacity and energy are text so the missing-value rule applies to them.
    """
    m1 = machine_readings(rd, "1").withColumn("measurement_name", measurement_name("table_name"))
    start = _measurement_start(m1).select("measurement_name", "start_ts")
    return m1.join(start, "measurement_name").selectExpr(
        "table_name", "record_id AS record_ID", "k AS cycle", "k % 6 AS step_ID", "step_name",
        "(unix_micros(CAST(reading_ts AS TIMESTAMP)) - unix_micros(CAST(start_ts AS TIMESTAMP))) / 1000000D"
        " AS time_in_step",
        "voltage_raw AS voltage_V", "current_ma AS current_mA",
        "CASE WHEN current_ma IS NULL THEN 'NAN' ELSE CAST(current_ma AS STRING) END AS capacity_mAh",
        "CASE WHEN voltage_raw = 'NAN' THEN 'NAN' ELSE CAST(k AS STRING) END AS energy_mWh",
        "reading_ts AS timestamp", "'yes' AS Validated")


def dat_rows(rd: DataFrame) -> DataFrame:
    """Machine 2 rows with header fields attached, clean names, values as text.

    Header (per measurement, from its smallest ``k`` = hk): operator
    ``Operator_<hk % 7>``, diaphragm ``D<hk % 3>``, thickness ``hk % 5``,
    porosity ``hk % 2``, pump value missing when ``hk % 4 = 0``.
    """
    m2 = machine_readings(rd, "2").withColumn("measurement_name", measurement_name("table_name"))
    hdr = _measurement_start(m2).select("measurement_name", "hk", "hk_material")
    cur = "CASE WHEN current_ma IS NULL THEN 'NAN' ELSE CAST(current_ma / {d} AS STRING) END"
    return m2.join(hdr, "measurement_name").selectExpr(
        "table_name", "record_id", "reading_ts AS timestamp", "voltage_raw AS voltage_v",
        cur.format(d=2000) + " AS h2_flow",
        cur.format(d=4000) + " AS o2_flow",
        "CAST(90 + k / 10 AS STRING) AS h2_purity_percent",
        "CASE WHEN k % 4 = 0 THEN 'NAN' ELSE CAST(95 + k / 20 AS STRING) END AS o2_purity_percent",
        cur.format(d=1000) + " AS current_a",
        "CAST(k % 7 + 1 AS STRING) AS h2_pressure_bar",
        "CAST(k % 5 + 1 AS STRING) AS o2_pressure_bar",
        "'5' AS set_pressure_bar",
        "CAST(k % 10 + 55 AS STRING) AS cathode_temp_c",
        "CAST(k % 8 + 55 AS STRING) AS anode_temp_c",
        "CAST(k % 6 + 50 AS STRING) AS cell_inlet_temp_c",
        "CAST(k % 50 + 25 AS STRING) AS h2_level_percent",
        "CAST(k % 40 + 30 AS STRING) AS o2_level_percent",
        "concat('Operator_', CAST(hk % 7 AS STRING)) AS operator",
        "concat('D', CAST(hk % 3 AS STRING)) AS diaphragm",
        "CAST(hk % 5 AS STRING) AS thickness",
        "CAST(hk % 2 AS STRING) AS porosity",
        "'KOH' AS electrolyte",
        "hk_material AS electrodes",
        "'5.0' AS electrodes_area",
        "'const' AS current_density_mode",
        "'400' AS current_density_value",
        "CASE WHEN hk % 4 = 0 THEN 'off' ELSE 'const' END AS pump_speed_mode",
        "CASE WHEN hk % 4 = 0 THEN 'NAN' ELSE CAST(hk % 4 * 25 AS STRING) END AS pump_speed_value",
        "'2.5' AS experiment_running_time",
    )


def metadata_rows(rd: DataFrame, batch: int = 1) -> DataFrame:
    """Metadata workbook rows: one per measurement table. The level depends on
    the measurement number, so an operator's documents may name several.

    Batch 2 is the re-delivered sheet: every tenth measurement has its
    operator level changed to ``high`` (the upsert must replace those).
    """
    per_table = _first_by(rd.filter(F.col("table_name").rlike("^[0-9]")), F.col("table_name")).select(
        "table_name", "hk", F.col("hk_material").alias("electrode_material"))
    mname = measurement_name("table_name")
    level = F.element_at(F.array(F.lit("low"), F.lit("medium"), F.lit("high")),
                         (mname.cast("bigint") % 3).cast("int") + 1)
    if batch == 2:
        level = F.when(mname.cast("bigint") % 10 == 0, F.lit("high")).otherwise(level)
    return per_table.select(
        F.concat(mname, F.lit("_meta")).alias("json_name"),
        F.concat(F.lit("Operator_"), (F.col("hk") % 7).cast("string")).alias("operator_name"),
        level.alias("operator_level"),
        F.concat(F.lit("machine_"), F.substring("table_name", 1, 1)).alias("machine_name"),
        F.concat(F.lit("machine_"), F.substring("table_name", 1, 1)).alias("machine_type"),
        "electrode_material",
        mname.alias("measurement_name"),
    )
