"""Registered queries: scalar cleaning functions and name handling over the readings."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from cellstar.functions import clean as C
from cellstar.plans.catalog import register
from cellstar.plans.oracle import star_sql
from cellstar.sources import fixtures as fx
from cellstar.sources.files import landing_paths


@register("nan_to_null", star_sql("""
select record_id,
  case when voltage_raw is null or voltage_raw = 'NAN' then null else voltage_raw end as voltage_text,
  case when current_ma is null or isnan(current_ma) then null else current_ma end as current_ma
from readings"""))
def nan_to_null(spark, sf_dir):
    rd = fx.readings(spark, sf_dir)
    return rd.select("record_id",
                     C.nan_to_null("voltage_raw", StringType()).alias("voltage_text"),
                     C.nan_to_null("current_ma", DoubleType()).alias("current_ma"))


@register("decimal_cast", star_sql("""
select record_id,
  case when voltage_raw = 'NAN' then null else cast(voltage_raw as decimal(10,4)) end as v_10_4,
  case when voltage_raw = 'NAN' then null else cast(voltage_raw as decimal(18,8)) end as v_18_8,
  case when voltage_raw = 'NAN' then null else cast(voltage_raw as decimal(10,3)) end as v_10_3,
  case when voltage_raw = 'NAN' then null else cast(voltage_raw as decimal(10,2)) end as v_10_2
from readings"""))
def decimal_cast(spark, sf_dir):
    rd = fx.readings(spark, sf_dir)
    return rd.select("record_id", *[C.to_decimal("voltage_raw", p, s).alias(f"v_{p}_{s}")
                                    for p, s in [(10, 4), (18, 8), (10, 3), (10, 2)]])


@register("round_half_up", star_sql("""
select record_id,
  round(case when voltage_raw = 'NAN' then null else cast(voltage_raw as decimal(10,4)) end, 4) as v_round4,
  round(case when voltage_raw = 'NAN' then null else cast(voltage_raw as decimal(10,4)) end, 1) as v_round1,
  round(case when voltage_raw = 'NAN' then null else cast(voltage_raw as decimal(10,4)) end, 0) as v_round0
from readings"""))
def round_half_up(spark, sf_dir):
    rd = fx.readings(spark, sf_dir)
    v = C.to_decimal("voltage_raw", 10, 4)
    return rd.select("record_id", *[C.round_half_up(v, k).cast(f"decimal(10,{k})").alias(f"v_round{k}")
                                    for k in (4, 1, 0)])


@register("milliamp_to_amp", star_sql("""
select record_id, current_ma,
  case when current_ma is null or isnan(current_ma) then null
       else cast(cast(current_ma / 1000.0 as varchar) as decimal(10,4)) end as current_a
from readings"""))
def milliamp_to_amp(spark, sf_dir):
    rd = fx.readings(spark, sf_dir)
    return rd.select("record_id", "current_ma", C.milliamp_to_amp("current_ma").alias("current_a"))


@register("measurement_name", star_sql("""
select distinct table_name, split_part(table_name, '_', 1) as measurement_name,
  substr(table_name, 1, 1) as machine_digit, 'machine_' || substr(table_name, 1, 1) as machine_name,
  regexp_matches(table_name, '^[0-9]') as starts_with_digit
from readings"""))
def measurement_name(spark, sf_dir):
    rd = fx.readings(spark, sf_dir).select("table_name").distinct()
    return rd.select("table_name", C.measurement_name("table_name").alias("measurement_name"),
                     C.machine_digit("table_name").alias("machine_digit"),
                     C.machine_name("table_name").alias("machine_name"),
                     C.starts_with_digit("table_name").alias("starts_with_digit"))


@register("dim_date_parts", star_sql("""
select record_id, cast(reading_ts as date) as date, cast(day(reading_ts) as bigint) as day,
  cast(month(reading_ts) as bigint) as month, cast(year(reading_ts) as bigint) as year,
  strftime(reading_ts, '%H:%M:%S.%f') as time, cast(hour(reading_ts) as bigint) as hour,
  cast(minute(reading_ts) as bigint) as minute, cast(second(reading_ts) as bigint) as second
from readings"""))
def dim_date_parts(spark, sf_dir):
    """C8-C11 on every reading: date, time-of-day key and their whole-number parts."""
    rd = fx.readings(spark, sf_dir)
    ts = F.col("reading_ts")
    return rd.select("record_id", C.date_of(ts).alias("date"),
                     F.dayofmonth(ts).cast("bigint").alias("day"), F.month(ts).cast("bigint").alias("month"),
                     F.year(ts).cast("bigint").alias("year"), C.time_key(ts).alias("time"),
                     F.hour(ts).cast("bigint").alias("hour"), F.minute(ts).cast("bigint").alias("minute"),
                     F.second(ts).cast("bigint").alias("second"))


_LANDING_SQL = """
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


@register("path_parts", star_sql(_LANDING_SQL + """
select path, regexp_extract(path, '([^/]+?)(\\.[^./]*)?$', 1) as stem,
  regexp_extract(path, '([^/]+)/[^/]+$', 1) as folder,
  lower(regexp_extract(path, '[^/]*?(\\.[^./]*)$', 1)) as extension,
  replace(regexp_extract(path, '([^/]+?)(\\.[^./]*)?$', 1), '.', '_') || '_table' as table_name
from landing"""))
def path_parts(spark, sf_dir):
    paths = landing_paths(fx.readings(spark, sf_dir))
    return paths.select("path", C.path_stem("path").alias("stem"), C.path_folder("path").alias("folder"),
                        C.path_extension("path").alias("extension"), C.table_name_of("path").alias("table_name"))


@register("fill_text", star_sql("""
select record_id, coalesce(case when o2_purity_percent = 'NAN' then null else o2_purity_percent end, '')
    as o2_purity_percent,
  coalesce(case when pump_speed_value = 'NAN' then null else pump_speed_value end, '') as pump_speed_value,
  h2_purity_percent
from dat"""))
def fill_text(spark, sf_dir):
    dat = fx.dat_rows(fx.readings(spark, sf_dir))
    typed = dat.select("record_id",
                       C.nan_to_null("o2_purity_percent", StringType()).alias("o2_purity_percent"),
                       C.nan_to_null("pump_speed_value", StringType()).alias("pump_speed_value"),
                       "h2_purity_percent")
    return C.fill_text(typed, "")
