"""Registered queries: landing-area files and the ``.dat`` ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellstar.functions.clean import MEASUREMENT_DATA_MARKER, measurement_name, path_extension, path_stem, to_decimal
from cellstar.plans import registry as _base  # noqa: F401  (q2_from_files reuses its oracle)
from cellstar.plans.catalog import memo, readings_for, register
from cellstar.plans.oracle import MEASURES, star_sql
from cellstar.session import scratch_dir
from cellstar.sources import dat as DAT
from cellstar.sources import files as FL
from cellstar.sources import fixtures as fx
from cellstar.sources.fixtures import DAT_HEADER_FIELDS, DAT_HEADER_KEYS, DAT_TABLE_COLUMNS

DAT_TABLE_LINE = "\t".join(DAT_TABLE_COLUMNS)


def landed_dat_root(spark, sf_dir) -> str:
    """Render the machine 2 files of ``sf_dir`` once per session (plus the
    header-only copies that must be quarantined) and return their folder."""
    def build():
        dat = fx.dat_rows(readings_for(spark, sf_dir))
        root = scratch_dir(spark, "landing-dat")
        return DAT.write_dat_files(DAT.dat_lines(dat).unionByName(DAT.broken_lines(dat)), root)
    return memo("landing-dat", spark, sf_dir, build)


def parsed_dat(spark, sf_dir):
    files = DAT.read_dat_files(spark, landed_dat_root(spark, sf_dir))
    return DAT.parse_dat(files, name_col="file_stem")


def typed_dat(rows):
    """C3-C5 on ingested rows: measures as decimal(10,4), header typed."""
    return rows.select(
        measurement_name("table_name").alias("measurement_name"), "timestamp",
        *[to_decimal(c, 10, 4).alias(c) for c in MEASURES],
        F.col("operator").alias("operator_name"), "diaphragm",
        F.col("thickness").cast("bigint").alias("thickness"), F.col("porosity").cast("bigint").alias("porosity"),
        "electrolyte", "electrodes", to_decimal("electrodes_area", 10, 3).alias("electrodes_area"),
        "current_density_mode", to_decimal("current_density_value", 10, 2).alias("current_density_value"),
        "pump_speed_mode", to_decimal("pump_speed_value", 10, 2).alias("pump_speed_value"),
        to_decimal("experiment_running_time", 10, 2).alias("experiment_running_time"))


_TYPED_SQL = ("select measurement_name, timestamp, " + ", ".join(MEASURES) +
              ", operator_name, diaphragm, thickness, porosity, electrolyte, electrodes, electrodes_area, "
              "current_density_mode, current_density_value, pump_speed_mode, pump_speed_value, "
              "experiment_running_time from s2c")


@register("dat_ingest", star_sql(_TYPED_SQL))
def dat_ingest(spark, sf_dir):
    """Render -> binaryFile -> parse -> typed rows; equals the machine 2 rows."""
    return typed_dat(DAT.dat_rows_from_files(parsed_dat(spark, sf_dir)))


_HEADER_UNPIVOT = " union all ".join(
    f"select distinct split_part(table_name, '_', 1) as measurement_name, '{k}' as key, "
    f"coalesce({f}, 'NAN') as value from dat"
    for k, f in zip(DAT_HEADER_KEYS, DAT_HEADER_FIELDS))


@register("dat_header_map", star_sql(f"select distinct * from ({_HEADER_UNPIVOT})"))
def dat_header_map(spark, sf_dir):
    """Header ``key: value`` pairs of each ingested file."""
    files = DAT.parse_files(DAT.read_dat_files(spark, landed_dat_root(spark, sf_dir)), name_col="file_stem")
    files = files.filter(F.col("error").isNull())
    return (files.select(measurement_name("file_stem").alias("measurement_name"),
                         F.explode("header").alias("key", "value"))
            .distinct())


_QUARANTINE_SQL = """
select split_part(table_name, '_', 1) || '_broken' as file_stem, 'quarantined' as status,
  'no measurement data marker' as error, cast(0 as bigint) as n_rows
from dat where cast(split_part(table_name, '_', 1) as bigint) % 10 = 3
group by 1"""


@register("ingest_quarantine", star_sql(_QUARANTINE_SQL))
def ingest_quarantine(spark, sf_dir):
    """Files that failed to parse, with the reason; the others go on."""
    st = DAT.ingest_status(parsed_dat(spark, sf_dir))
    return st.filter(F.col("status") == "quarantined").select("file_stem", "status", "error", "n_rows")


@register("ingest_summary", star_sql(f"""
select 'ok' as status, count(distinct split_part(table_name, '_', 1) || strftime(timestamp, '%Y%m'))
         as n_files, count(*) as n_rows from dat
union all
select 'quarantined', count(*), 0 from ({_QUARANTINE_SQL})"""))
def ingest_summary(spark, sf_dir):
    """Files and rows per status."""
    st = DAT.ingest_status(parsed_dat(spark, sf_dir))
    return st.groupBy("status").agg(F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").alias("n_rows"))


@register("rows_per_file", star_sql("""
select split_part(table_name, '_', 1) || '_' || strftime(timestamp, '%Y%m') as file_stem, count(*) as n_rows
from dat group by 1"""))
def rows_per_file(spark, sf_dir):
    """rows read from each file."""
    st = DAT.ingest_status(parsed_dat(spark, sf_dir))
    return st.filter(F.col("status") == "ok").select("file_stem", "n_rows")


def _text_length(c: str) -> str:
    """Length of a number's text as Spark writes it: below 0.001 as digits, ``E``, exponent."""
    digits = f"ltrim(replace(regexp_replace({c}, 'e.*$', ''), '.', ''), '0')"
    return (f"case when {c} is null then 0 when try_cast({c} as double) <> 0 and try_cast({c} as double) < 0.001 "
            f"then greatest(length({digits}), 2) + 4 else length({c}) end")


@register("file_manifest", star_sql(f"""
select file_stem, '.csv' as extension, cast(sum(n + 1) as bigint) as length
from (
  select split_part(table_name, '_', 1) || '_' || strftime(timestamp, '%Y%m') as file_stem,
    26 + case when record_id % 3 = 2 then 3 else 0 end + {" + ".join(f"1 + {_text_length(c)}" for c in MEASURES)} as n
  from dat
  union all
  select file_stem, length(h) from (
    select distinct split_part(table_name, '_', 1) || '_' || strftime(timestamp, '%Y%m') as file_stem,
      unnest([{", ".join(f"'{k}' || ':' || {'chr(9)' if k == 'Operator' else repr(' ')} || coalesce({f}, 'NAN')"
                         for k, f in zip(DAT_HEADER_KEYS, DAT_HEADER_FIELDS))},
              '{MEASUREMENT_DATA_MARKER}', '{DAT_TABLE_LINE}']) as h from dat)
  union all
  select file_stem, length(h) from (
    select distinct split_part(table_name, '_', 1) || '_broken' as file_stem,
      unnest([{", ".join(f"'{k}' || ':' || {'chr(9)' if k == 'Operator' else repr(' ')} || coalesce({f}, 'NAN')"
                         for k, f in zip(DAT_HEADER_KEYS, DAT_HEADER_FIELDS))}]) as h
    from dat where cast(split_part(table_name, '_', 1) as bigint) % 10 = 3))
group by 1"""))
def file_manifest(spark, sf_dir):
    """A1/A2: stem, extension and size of every landed file (Latin-1: a byte a character)."""
    files = FL.manifest(spark, landed_dat_root(spark, sf_dir)).filter(~F.col("path").rlike("/[._][^/]*$"))
    return files.select(F.regexp_extract("path", r"file_stem=([^/]+)/", 1).alias("file_stem"),
                        path_extension("path").alias("extension"), "length")


def bronze_root(spark, sf_dir):
    def build():
        path = scratch_dir(spark, "bronze-dat")
        rows = dat_ingest(spark, sf_dir)
        rows.write.mode("errorifexists").partitionBy("measurement_name").parquet(path)
        return path, rows.schema
    return memo("bronze-dat", spark, sf_dir, build)


def read_bronze(spark, sf_dir):
    """Read the bronze table with its declared schema, so partition folder
    values stay text (``measurement_name=0012`` is not the number 12)."""
    path, schema = bronze_root(spark, sf_dir)
    return spark.read.schema(schema).parquet(path)


@register("bronze_roundtrip", star_sql(_TYPED_SQL))
def bronze_roundtrip(spark, sf_dir):
    """B1: ingested rows written as Parquet partitioned by measurement, read back."""
    return read_bronze(spark, sf_dir)


@register("parquet_scan", star_sql("""
select measurement_name, count(*) as n_rows, min(timestamp) as first_ts, max(timestamp) as last_ts,
  count(voltage_v) as n_voltage
from s2c where starts_with(measurement_name, '2') group by measurement_name"""))
def parquet_scan(spark, sf_dir):
    """Scan a Parquet table with a partition filter and column pruning
    (the plan reads two columns and only matching partition folders)."""
    df = read_bronze(spark, sf_dir)
    return (df.filter(F.col("measurement_name").startswith("2"))
            .groupBy("measurement_name")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min("timestamp").alias("first_ts"),
                 F.max("timestamp").alias("last_ts"), F.count("voltage_v").alias("n_voltage")))


_LANDING = """
, landing as (
  select distinct 'raw-data/machine_' || substr(table_name, 1, 1) || '/' || split_part(table_name, '_', 1)
         || case when starts_with(table_name, '1') then '.xlsx' else '.dat' end as path
  from readings where regexp_matches(table_name, '^[0-9]')
  union all
  select distinct 'raw-data/machine_' || substr(table_name, 1, 1) || '/notes/' || split_part(table_name, '_', 1)
         || '.Notes.TXT' from readings
  where regexp_matches(table_name, '^[0-9]') and cast(split_part(table_name, '_', 1) as bigint) % 10 = 0
  union all
  select 'raw-data/metadata/metadata.xlsx')
"""


@register("route_files", star_sql(_LANDING + """
select path,
  case when contains(path, 'metadata') then 'metadata' when contains(path, 'machine_1') then 'machine_1'
       when contains(path, 'machine_2') then 'machine_2' else 'skipped' end as route,
  lower(regexp_extract(path, '[^/]*?(\\.[^./]*)$', 1)) as extension,
  case when contains(path, 'metadata') then lower(regexp_extract(path, '[^/]*?(\\.[^./]*)$', 1)) in ('.xlsx', '.xls')
       when contains(path, 'machine_1') then lower(regexp_extract(path, '[^/]*?(\\.[^./]*)$', 1)) in ('.xlsx', '.xls')
       when contains(path, 'machine_2') then lower(regexp_extract(path, '[^/]*?(\\.[^./]*)$', 1)) = '.dat'
       else false end as accepted
from landing"""))
def route_files(spark, sf_dir):
    return FL.route_files(FL.landing_paths(fx.readings(spark, sf_dir)))


@register("file_sequence", star_sql(_LANDING + """
select path, regexp_extract(path, '([^/]+)$', 1) as file_name, ext as extension,
  cast(case ext when '.xlsx' then 1001 else 2001 end
       + row_number() over (partition by ext order by regexp_extract(path, '([^/]+)$', 1), path) - 1 as bigint)
    as sequence
from (select path, lower(regexp_extract(path, '[^/]*?(\\.[^./]*)$', 1)) as ext from landing)
where ext in ('.xlsx', '.dat')"""))
def file_sequence(spark, sf_dir):
    return FL.file_sequence(FL.landing_paths(fx.readings(spark, sf_dir)))


@register("tables_by_machine", star_sql("""
select distinct table_name, substr(table_name, 1, 1) as machine_digit from readings
where regexp_matches(table_name, '^[0-9]')"""))
def tables_by_machine(spark, sf_dir):
    """Measurement tables, kept by a leading digit, with their machine."""
    rd = fx.readings(spark, sf_dir)
    return (rd.filter(F.col("table_name").rlike("^[0-9]")).select("table_name").distinct()
            .select("table_name", F.substring("table_name", 1, 1).alias("machine_digit")))


@register("silver_readings", star_sql("""
select record_ID, cycle, step_ID, step_name, time_in_step, voltage_V, current_mA, capacity_mAh, energy_mWh,
  make_timestamp(epoch_us(timestamp)) as adjusted_timestamp, table_name from sheet"""))
def silver_readings(spark, sf_dir):
    """Explicit column list (``Validated`` dropped) and the nanosecond
    timestamp of a sheet reader narrowed to microseconds under a new name."""
    sheet = fx.sheet_rows(fx.readings(spark, sf_dir))
    nanos = (F.unix_micros(F.col("timestamp").cast("timestamp")) * F.lit(1000)).alias("timestamp_ns")
    landed = sheet.select("*", nanos)
    return landed.select("record_ID", "cycle", "step_ID", "step_name", "time_in_step", "voltage_V", "current_mA",
                         "capacity_mAh", "energy_mWh",
                         F.timestamp_micros(F.expr("timestamp_ns div 1000")).cast("timestamp_ntz")
                         .alias("adjusted_timestamp"),
                         "table_name")


@register("one_measurement", star_sql(_TYPED_SQL + " where starts_with(measurement_name, '2001')"))
def one_measurement(spark, sf_dir, prefix: str = "2001"):
    """Load a single measurement (name prefix) -- a partition-pruned scan of the bronze table."""
    df = read_bronze(spark, sf_dir)
    return df.filter(F.col("measurement_name").startswith(prefix))



# --- workbooks (A3, A9, C16) -------------------------------------------------------------

from cellstar.plans.warehouse import METADATA_COLUMNS, SHEET_COLUMNS, SHEET_NUMERIC  # noqa: E402

def landed_workbooks(spark, sf_dir, kind: str = "sheet", extension: str = ".xlsx"):
    """Workbooks rendered from the tables, kept as a (path, content) table in
    the shared scratch folder (the shape a ``binaryFile`` scan returns)."""
    return memo("workbooks", spark, sf_dir, lambda: _render_workbooks(spark, sf_dir, kind, extension), kind, extension)


def _bounded_books(rows, file_col: str, by: str, most: int = 20_000):
    """Files of more than ``most`` rows cut into several by a hash of ``by``: a legacy
    sheet has 65,536 rows, and one task makes a workbook in memory."""
    from cellstar.operators.keys import stage
    from cellstar.operators.lookup import broadcast_if_small
    full = stage(rows.groupBy(file_col).agg(F.ceil(F.count(F.lit(1)) / F.lit(most)).alias("_n")).filter("_n > 1"), "book_sizes")
    part = F.pmod(F.xxhash64(by), F.col("_n")).cast("string")
    return rows.join(broadcast_if_small(full), file_col, "left").withColumn(
        file_col, F.when(F.col("_n").isNull(), F.col(file_col)).otherwise(F.concat(file_col, F.lit("_"), part))).drop("_n")


def _render_workbooks(spark, sf_dir, kind, extension):
    from cellstar.operators.keys import stage
    from cellstar.sources import sheet as SH
    rd = readings_for(spark, sf_dir)
    if kind == "sheet":
        rows = fx.sheet_rows(rd)
        f = F.concat(measurement_name("table_name"), F.lit("_"), F.date_format("timestamp", "yyyyMM"))
        # times as the date numbers that a workbook stores
        micros = "unix_micros(CAST(timestamp AS TIMESTAMP))"
        rows = rows.withColumn("_f", f).withColumn("_ts", F.col("timestamp")).withColumn("timestamp", F.expr(
            f"CAST({micros} div 86400000000 + 25569 AS DOUBLE) + pmod({micros}, 86400000000) / 86400000000D"))
        if extension == ".xls":
            rows = _bounded_books(rows, "_f", "record_ID")
        wb = SH.render_workbooks(rows, "_f", SHEET_COLUMNS, SHEET_NUMERIC, ["_ts", "record_ID"], extension=extension)
    else:
        rows = fx.metadata_rows(rd)
        # one workbook per machine and block of 1,000 measurement numbers: bounded groups
        block = F.floor(F.col("measurement_name").cast("bigint") / 1000).cast("string")
        wb = SH.render_workbooks(rows.withColumn("_f", F.concat_ws("_", F.lit("metadata"), "machine_name", block)),
                                 "_f", METADATA_COLUMNS, set(), ["json_name"], folder="raw-data/metadata",
                                 sheet="metadata", extension=extension)
    return stage(wb, f"landing-{kind}")


_SHEET_SQL = star_sql("""
select split_part(table_name, '_', 1) as measurement_name, record_ID, cycle, step_ID, step_name, time_in_step,
  voltage_V, current_mA, capacity_mAh, energy_mWh, timestamp from sheet""")


@register("sheet_ingest", _SHEET_SQL)
def sheet_ingest(spark, sf_dir):
    """A3: sheet ``Sheet1`` of every machine 1 workbook, typed once in Spark."""
    return typed_sheets(landed_workbooks(spark, sf_dir))


@register("sheet_ingest_xls", _SHEET_SQL)
def sheet_ingest_xls(spark, sf_dir):
    """A1/A3: the same measurements delivered as legacy workbooks."""
    return typed_sheets(landed_workbooks(spark, sf_dir, extension=".xls"))


@register("metadata_sheet_ingest_xls", star_sql("select " + ", ".join(METADATA_COLUMNS) + " from meta"))
def metadata_sheet_ingest_xls(spark, sf_dir):
    """A9 + C16: metadata delivered as legacy workbooks."""
    from cellstar.plans.warehouse import metadata_rows_from_files
    return metadata_rows_from_files(landed_workbooks(spark, sf_dir, "metadata", extension=".xls"))


def typed_sheets(files):
    from cellstar.plans.warehouse import land_sheets
    from cellstar.operators.keys import stage
    rows = DAT.whole_files(stage(land_sheets(files), "landed_sheet"))   # each workbook is opened once
    return rows.select(
        measurement_name("table_name").alias("measurement_name"), "record_ID", "cycle", "step_ID", "step_name",
        "time_in_step", "voltage_V", "current_mA", "capacity_mAh", "energy_mWh", "timestamp")


@register("quarantine_all", star_sql("""
select split_part(table_name, '_', 1) || '_broken' as file, 'no measurement data marker' as error
from dat where cast(split_part(table_name, '_', 1) as bigint) % 10 = 3 group by 1
union all
select split_part(table_name, '_', 1) || '_' || strftime(timestamp, '%Y%m'), 'unreadable experiment_running_time: 2.5x'
from dat where cast(split_part(table_name, '_', 1) as bigint) % 10 = 1 group by 1
union all
select split_part(table_name, '_', 1) || '_' || strftime(timestamp, '%Y%m'), 'BadZipFile: File is not a zip file'
from sheet where cast(split_part(table_name, '_', 1) as bigint) % 10 = 2 group by 1"""))
def quarantine_all(spark, sf_dir):
    """Files of both machines that are kept out whole -- no marker, one bad
    cell, a workbook that breaks off -- each with its reason."""
    from cellstar.plans.warehouse import land
    number = F.regexp_extract("path", r"([0-9]+)_[^/]*(/[^/]*)?$", 1).cast("bigint") % 10
    dat = DAT.read_dat_files(spark, landed_dat_root(spark, sf_dir))
    text = F.decode("content", DAT.ENCODING)
    dat = dat.withColumn("content", F.when(
        F.substring_index("file_stem", "_", 1).cast("bigint") % 10 == 1,
        F.encode(F.replace(text, F.lit("[h]: 2.5"), F.lit("[h]: 2.5x")), DAT.ENCODING)).otherwise(F.col("content")))
    books = landed_workbooks(spark, sf_dir)
    cut = F.expr("substring(content, 1, CAST(length(content) * 3 / 5 AS INT))")
    books = books.withColumn("content", F.when(number == 2, cut).otherwise(F.col("content")))
    bad = land(dat, books).quarantine()
    folder = F.regexp_extract("source", r"file_stem=([^/]+)/", 1)
    return bad.select(F.when(folder != "", folder).otherwise(path_stem("source")).alias("file"), "error")


@register("metadata_sheet_ingest", star_sql(
    "select " + ", ".join(METADATA_COLUMNS) + " from meta"))
def metadata_sheet_ingest(spark, sf_dir):
    """A9 + C16: the first sheet of the metadata workbooks, empty cells as ''."""
    from cellstar.sources import sheet as SH
    rows = SH.read_sheets(landed_workbooks(spark, sf_dir, "metadata"), METADATA_COLUMNS, sheet_name=None,
                          fill_text="")
    return rows.filter(F.col("error").isNull()).select(*METADATA_COLUMNS)


@register("streaming_ingest", star_sql(_TYPED_SQL))
def streaming_ingest(spark, sf_dir):
    """Landed files ingested incrementally (file stream, exactly-once file sink),
    run twice: the second run finds nothing new, so the table does not grow."""
    from cellstar.streaming.landing import run_available_now
    root = landed_dat_root(spark, sf_dir)
    out, ckpt = scratch_dir(spark, "stream-bronze"), scratch_dir(spark, "stream-ckpt")
    for _ in range(2):  # Spark's own text files stand for the instrument's here
        run_available_now(spark, root, out, ckpt, glob="*.csv")
    rows = spark.read.parquet(out).filter(F.col("status") == "ok").filter(F.col("line_no").isNotNull())
    return typed_dat(rows)


@register("dat_ingest_split", star_sql(_TYPED_SQL))
def dat_ingest_split(spark, sf_dir):
    """A4-A8 by byte range: files of any size, cut wherever the scan's ranges end."""
    from cellstar.sources.dat_split import parse_dat_split
    return typed_dat(DAT.dat_rows_from_files(DAT.whole_files(parse_dat_split(spark, landed_dat_root(spark, sf_dir), "*.csv"))))


_STREAM_ROWS = """
select ms.measurement_name, f.timestamp, f.voltage_v, f.current_a, f.h2_flow, o.operator_name, em.electrode_material,
  md.diaphragm, ms.start_timestamp, ms.finish_timestamp
from fact_dat_measurements f join dim_measurement ms using (measurement_id) left join dim_operator o using (operator_id)
  join dim_electrode_material em using (electrode_material_id) join dim_dat_metadata md using (dat_metadata_id)
"""


@register("streaming_star", star_sql(_STREAM_ROWS))
def streaming_star(spark, sf_dir):
    """Landed files streamed into the published star in two batches, months of
    one measurement in both, then again: a second stream with a checkpoint of its
    own brings every file again, and nothing changes."""
    from cellstar.sinks.publish import read_published
    from cellstar.streaming.landing import stream_to_star
    landing, gold = landed_dat_root(spark, sf_dir), scratch_dir(spark, "stream-gold")
    half = -(-FL.manifest(spark, landing, glob="*.csv").count() // 2)
    for _ in range(2):  # Spark's own text files stand for the instrument's here
        stream_to_star(spark, landing, gold, scratch_dir(spark, "star-ckpt"), glob="*.csv", max_files_per_trigger=half)
    t = read_published(spark, gold)
    for name, df in t.items():
        if name.startswith(("dim_", "fact_")):
            df.createOrReplaceTempView(f"streamed_{name}")
    text = _STREAM_ROWS
    for name in ("fact_dat_measurements", "dim_measurement", "dim_operator", "dim_electrode_material", "dim_dat_metadata"):
        text = text.replace(f" {name} ", f" streamed_{name} ")
    return spark.sql(text)


def warehouse_from_files(spark, sf_dir):
    """The star schema built only from the landed files (``.dat``, machine 1
    workbooks, metadata workbooks) -- broken files are quarantined, not loaded."""
    from cellstar.plans.warehouse import build_warehouse

    def build():
        dat_files = DAT.read_dat_files(spark, landed_dat_root(spark, sf_dir))
        return build_warehouse(dat_files, landed_workbooks(spark, sf_dir, "sheet"),
                               landed_workbooks(spark, sf_dir, "metadata"))
    return memo("warehouse", spark, sf_dir, build)


def _q2_sql():
    from cellstar.plans.catalog import ORACLES
    return ORACLES["q2_machine_compare"]


@register("q2_from_files", _q2_sql())
def q2_from_files(spark, sf_dir):
    """Q2 answered from the warehouse built from files: equal to Q2 on the tables."""
    from cellstar.plans import questions as Q
    st = warehouse_from_files(spark, sf_dir)
    return Q.q2_machine_compare(st.fact_excel_measurements, st.fact_dat_measurements, st.dim_machine,
                                st.dim_electrode_material)


@register("fact_counts_from_files", star_sql("""
select 'fact_excel_measurements' as table_name, count(*) as n_rows, count(distinct measurement_id) as n_measurements
from fact_excel_measurements
union all
select 'fact_dat_measurements', count(*), count(distinct measurement_id) from fact_dat_measurements"""))
def fact_counts_from_files(spark, sf_dir):
    """Every landed reading reaches its fact; measurement counts match the tables."""
    st = warehouse_from_files(spark, sf_dir)
    parts = [f.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("measurement_id").alias("n_measurements"))
             .select(F.lit(name).alias("table_name"), "n_rows", "n_measurements")
             for name, f in [("fact_excel_measurements", st.fact_excel_measurements),
                             ("fact_dat_measurements", st.fact_dat_measurements)]]
    return parts[0].unionByName(parts[1])
