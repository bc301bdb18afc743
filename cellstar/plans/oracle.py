"""DuckDB SQL oracles for the registered queries.

The oracle is written independently of the Spark code, as plain SQL with
window functions where Spark uses the distributed key allocator. It runs on
the driver's pre-registered views (``events`` etc.). ``STAR`` is a WITH-chain
from the readings view to both facts; each query appends its final SELECT.

Pinned semantics (Spark 4.1 vs DuckDB): a double becomes a decimal through its
shortest text in Spark, so the oracle writes ``cast(cast(x as varchar) as
decimal)``; integer results are cast to bigint; NULLs sort first.
"""

from __future__ import annotations

from cellstar.sources.fixtures import READINGS_SQL

MEASURES = [
    "voltage_v", "h2_flow", "o2_flow", "h2_purity_percent", "o2_purity_percent",
    "current_a", "h2_pressure_bar", "o2_pressure_bar", "set_pressure_bar",
    "cathode_temp_c", "anode_temp_c", "cell_inlet_temp_c", "h2_level_percent", "o2_level_percent",
]
META_KEY = [
    "diaphragm", "thickness", "porosity", "electrolyte", "electrodes", "electrodes_area",
    "current_density_mode", "current_density_value", "pump_speed_mode", "pump_speed_value",
    "experiment_running_time",
]


def _dec(x: str, p: int, s: int) -> str:
    return f"case when {x} is null or {x} = 'NAN' then null else cast({x} as decimal({p},{s})) end"


def _dim(name: str, key: str, nk: list[str], attrs: list[str], members_sql: str) -> str:
    """Batch-ordered dense numbering: a member keeps the first batch it appears in."""
    nkl = ", ".join(nk)
    attr_min = "".join(f", min({a}) as {a}" for a in attrs)
    attr_sel = "".join(f", {a}" for a in attrs)
    order = ", ".join(f"{c} nulls first" for c in ["_batch", *nk])
    return f"""
{name}_m as ({members_sql}),
{name}_b as (select {nkl}{attr_min}, _batch from {name}_m group by all),
{name}_f as (select * from (select *, row_number() over (partition by {nkl} order by _batch) as _rn
             from {name}_b) where _rn = 1),
{name} as (select cast(row_number() over (order by {order}) as bigint) as {key}, {nkl}{attr_sel}
           from {name}_f)"""


def _dim_nullsafe(name: str, key: str, nk: list[str], members_sql: str) -> str:
    nkl = ", ".join(nk)
    order = ", ".join(f"{c} nulls first" for c in nk)
    return f"""
{name}_m as ({members_sql}),
{name} as (select cast(row_number() over (order by {order}) as bigint) as {key}, {nkl}
           from (select distinct {nkl} from {name}_m))"""


READINGS_CTE = "readings as (" + READINGS_SQL.replace("{events}", "events") + ")"

SILVER = READINGS_CTE + """,
m1 as (select * from readings where regexp_matches(table_name, '^[0-9]') and starts_with(table_name, '1')),
m2 as (select * from readings where regexp_matches(table_name, '^[0-9]') and starts_with(table_name, '2')),
m1_start as (select split_part(table_name, '_', 1) as mn, min(reading_ts) as start_ts from m1 group by 1),
m2_hdr as (select split_part(table_name, '_', 1) as mn, min(k) as hk, min(electrode_material) as hk_material
           from m2 group by 1),
sheet as (
  select r.table_name, r.record_id as record_ID, r.k as cycle, r.k % 6 as step_ID, r.step_name,
    (epoch_us(r.reading_ts) - epoch_us(s.start_ts)) / 1e6 as time_in_step,
    r.voltage_raw as voltage_V, r.current_ma as current_mA,
    case when r.current_ma is null then 'NAN' else cast(r.current_ma as varchar) end as capacity_mAh,
    case when r.voltage_raw = 'NAN' then 'NAN' else cast(r.k as varchar) end as energy_mWh,
    r.reading_ts as timestamp, 'yes' as Validated
  from m1 r join m1_start s on split_part(r.table_name, '_', 1) = s.mn),
dat as (
  select r.table_name, r.record_id, r.reading_ts as timestamp, r.voltage_raw as voltage_v,
    case when r.current_ma is null then 'NAN' else cast(r.current_ma / 2000 as varchar) end as h2_flow,
    case when r.current_ma is null then 'NAN' else cast(r.current_ma / 4000 as varchar) end as o2_flow,
    cast(90 + r.k / 10 as varchar) as h2_purity_percent,
    case when r.k % 4 = 0 then 'NAN' else cast(95 + r.k / 20 as varchar) end as o2_purity_percent,
    case when r.current_ma is null then 'NAN' else cast(r.current_ma / 1000 as varchar) end as current_a,
    cast(r.k % 7 + 1 as varchar) as h2_pressure_bar, cast(r.k % 5 + 1 as varchar) as o2_pressure_bar,
    '5' as set_pressure_bar, cast(r.k % 10 + 55 as varchar) as cathode_temp_c,
    cast(r.k % 8 + 55 as varchar) as anode_temp_c, cast(r.k % 6 + 50 as varchar) as cell_inlet_temp_c,
    cast(r.k % 50 + 25 as varchar) as h2_level_percent, cast(r.k % 40 + 30 as varchar) as o2_level_percent,
    'Operator_' || cast(h.hk % 7 as varchar) as operator, 'D' || cast(h.hk % 3 as varchar) as diaphragm,
    cast(h.hk % 5 as varchar) as thickness, cast(h.hk % 2 as varchar) as porosity, 'KOH' as electrolyte,
    h.hk_material as electrodes, '5.0' as electrodes_area, 'const' as current_density_mode,
    '400' as current_density_value,
    case when h.hk % 4 = 0 then 'off' else 'const' end as pump_speed_mode,
    case when h.hk % 4 = 0 then 'NAN' else cast(h.hk % 4 * 25 as varchar) end as pump_speed_value,
    '2.5' as experiment_running_time
  from m2 r join m2_hdr h on split_part(r.table_name, '_', 1) = h.mn),
meta as (
  select split_part(table_name, '_', 1) || '_meta' as json_name,
    'Operator_' || cast(min(k) % 7 as varchar) as operator_name,
    ['low', 'medium', 'high'][cast(split_part(table_name, '_', 1) as bigint) % 3 + 1] as operator_level,
    'machine_' || substr(table_name, 1, 1) as machine_name, 'machine_' || substr(table_name, 1, 1) as machine_type,
    min(electrode_material) as electrode_material, split_part(table_name, '_', 1) as measurement_name
  from readings where regexp_matches(table_name, '^[0-9]') group by table_name),
s1c as (
  select table_name, split_part(table_name, '_', 1) as measurement_name,
    'machine_' || substr(table_name, 1, 1) as machine_name, timestamp,
    cast(record_ID as bigint) as record_id, cast(cycle as bigint) as cycle, cast(step_ID as bigint) as step_id,
    step_name, cast(cast(time_in_step as varchar) as decimal(18,8)) as time_in_step,
    cast(round(""" + _dec("voltage_V", 10, 4) + """, 4) as decimal(10,4)) as voltage_v,
    case when current_mA is null or isnan(current_mA) then null
         else cast(cast(current_mA / 1000.0 as varchar) as decimal(10,4)) end as current_a,
    """ + _dec("capacity_mAh", 18, 8) + """ as capacity_mah,
    """ + _dec("energy_mWh", 18, 8) + """ as energy_mwh,
    cast(timestamp as date) as date, strftime(timestamp, '%H:%M:%S.%f') as time
  from sheet),
s1e as (
  select s.*, coalesce(m.operator_name, 'Operator_2d226185_e3f33b7d') as operator_name,
    coalesce(m.operator_level, 'medium') as operator_level,
    coalesce(m.electrode_material, '1') as electrode_material
  from s1c s left join meta m on s.measurement_name = m.measurement_name),
s2c as (
  select table_name, split_part(table_name, '_', 1) as measurement_name,
    'machine_' || substr(table_name, 1, 1) as machine_name, cast(record_id as bigint) as record_id, timestamp,
    """ + ",\n    ".join(_dec(m, 10, 4) + f" as {m}" for m in MEASURES) + """,
    operator as operator_name, electrodes as electrode_material,
    diaphragm, cast(thickness as bigint) as thickness, cast(porosity as bigint) as porosity,
    electrolyte, electrodes, """ + _dec("electrodes_area", 10, 3) + """ as electrodes_area,
    current_density_mode, """ + _dec("current_density_value", 10, 2) + """ as current_density_value,
    pump_speed_mode, """ + _dec("pump_speed_value", 10, 2) + """ as pump_speed_value,
    """ + _dec("experiment_running_time", 10, 2) + """ as experiment_running_time,
    cast(timestamp as date) as date, strftime(timestamp, '%H:%M:%S.%f') as time
  from dat)"""

DIMS = ",".join([
    _dim("dim_machine", "machine_id", ["machine_name"], ["machine_type"],
         "select machine_name, machine_name as machine_type, 0 as _batch from s1e "
         "union all select machine_name, machine_name, 1 from s2c"),
    _dim("dim_measurement", "measurement_id", ["measurement_name"], ["start_timestamp", "finish_timestamp"],
         "select measurement_name, min(timestamp) as start_timestamp, max(timestamp) as finish_timestamp, "
         "0 as _batch from s1e group by 1 union all select measurement_name, min(timestamp), max(timestamp), 1 "
         "from s2c group by 1"),
    _dim("dim_date", "date_id", ["date"], ["day", "month", "year"],
         "select date, cast(day(date) as bigint) as day, cast(month(date) as bigint) as month, "
         "cast(year(date) as bigint) as year, _batch from (select distinct date, 0 as _batch from s1e "
         "union all select distinct date, 1 from s2c)"),
    _dim("dim_time", "time_id", ["time"], ["hour", "minute", "second"],
         "select time, cast(hour(timestamp) as bigint) as hour, cast(minute(timestamp) as bigint) as minute, "
         "cast(second(timestamp) as bigint) as second, _batch from (select time, timestamp, 0 as _batch from s1e "
         "union all select time, timestamp, 1 from s2c)"),
    _dim("dim_operator", "operator_id", ["operator_name"], ["operator_level"],
         "select o.operator_name, coalesce(l.operator_level, 'medium') as operator_level, _batch from ("
         "select operator_name, 0 as _batch from s1e where operator_name is not null "
         "union all select operator_name, 1 from s2c where operator_name is not null) o "
         "left join (select operator_name, operator_level from ("
         "select operator_name, operator_level, row_number() over (partition by operator_name "
         "order by count(*) desc, operator_level) as _rn from meta group by 1, 2) where _rn = 1) l "
         "on o.operator_name = l.operator_name"),
    _dim("dim_electrode_material", "electrode_material_id", ["electrode_material"], [],
         "select electrode_material, 0 as _batch from s1e where electrode_material is not null "
         "union all select electrode_material, 1 from s2c where electrode_material is not null"),
    _dim_nullsafe("dim_dat_metadata", "dat_metadata_id", META_KEY, "select * from s2c"),
])

_META_ON = " and ".join(f"s.{c} is not distinct from md.{c}" for c in META_KEY)

FACTS = f"""
fact_excel_measurements as (
  select cast(row_number() over (order by s.measurement_name, s.timestamp, s.record_id) as bigint)
           as fact_excel_measurement_id,
    mc.machine_id, ms.measurement_id, s.timestamp, d.date_id, t.time_id, em.electrode_material_id,
    s.voltage_v, s.current_a, s.time_in_step, s.record_id, s.cycle, s.step_id, s.step_name,
    s.capacity_mah, s.energy_mwh, o.operator_id
  from s1e s
  join dim_machine mc on s.machine_name = mc.machine_name
  join dim_measurement ms on s.measurement_name = ms.measurement_name
  join dim_date d on s.date = d.date
  join dim_time t on s.time = t.time
  join dim_electrode_material em on s.electrode_material = em.electrode_material
  join dim_operator o on s.operator_name = o.operator_name),
fact_dat_measurements as (
  select cast(row_number() over (order by s.measurement_name, s.timestamp, s.record_id) as bigint)
           as fact_dat_measurement_id,
    mc.machine_id, ms.measurement_id, s.timestamp, d.date_id, t.time_id, em.electrode_material_id,
    md.dat_metadata_id, s.voltage_v, s.current_a, s.h2_flow, s.o2_flow, s.h2_purity_percent,
    s.o2_purity_percent, s.h2_pressure_bar, s.o2_pressure_bar, s.h2_level_percent, s.o2_level_percent,
    s.set_pressure_bar, s.cathode_temp_c, s.anode_temp_c, s.cell_inlet_temp_c, o.operator_id
  from s2c s
  join dim_machine mc on s.machine_name = mc.machine_name
  join dim_measurement ms on s.measurement_name = ms.measurement_name
  join dim_date d on s.date = d.date
  join dim_time t on s.time = t.time
  join dim_electrode_material em on s.electrode_material = em.electrode_material
  left join dim_operator o on s.operator_name = o.operator_name
  left join dim_dat_metadata md on {_META_ON})"""

STAR = "with " + SILVER + "," + DIMS + "," + FACTS + "\n"


def star_sql(select: str) -> str:
    return STAR + select
