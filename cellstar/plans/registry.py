"""Registered queries: star schema tables and the four questions."""

from __future__ import annotations

from cellstar.plans import questions as Q
from cellstar.plans.catalog import register, star_for
from cellstar.plans.oracle import star_sql

# --- dimensions (N1-N7) -------------------------------------------------------


@register("dim_machine", star_sql("select * from dim_machine"))
def dim_machine(spark, sf_dir):
    return star_for(spark, sf_dir).dim_machine


@register("dim_measurement", star_sql("select * from dim_measurement"))
def dim_measurement(spark, sf_dir):
    return star_for(spark, sf_dir).dim_measurement


@register("dim_date", star_sql("select * from dim_date"))
def dim_date(spark, sf_dir):
    return star_for(spark, sf_dir).dim_date


@register("dim_time", star_sql("select * from dim_time"))
def dim_time(spark, sf_dir):
    return star_for(spark, sf_dir).dim_time


@register("dim_operator", star_sql("select * from dim_operator"))
def dim_operator(spark, sf_dir):
    return star_for(spark, sf_dir).dim_operator


@register("dim_electrode_material", star_sql("select * from dim_electrode_material"))
def dim_electrode_material(spark, sf_dir):
    return star_for(spark, sf_dir).dim_electrode_material


@register("dim_dat_metadata", star_sql("select * from dim_dat_metadata"))
def dim_dat_metadata(spark, sf_dir):
    return star_for(spark, sf_dir).dim_dat_metadata


# --- facts (N8, N9) -------------------------------------------------------------


@register("fact_excel", star_sql("select * from fact_excel_measurements"))
def fact_excel(spark, sf_dir):
    return star_for(spark, sf_dir).fact_excel_measurements


@register("fact_dat", star_sql("select * from fact_dat_measurements"))
def fact_dat(spark, sf_dir):
    return star_for(spark, sf_dir).fact_dat_measurements


# --- the four questions (N10-N13) --------------------------------------------------

_MEAN = "cast(round(sum({c}) / count({c}), {s}) as double)"


def _mean(c, s=6):
    return _MEAN.format(c=c, s=s)


@register("q1_material_by_density", star_sql(f"""
select em.electrode_material, b.density_bin, count(*) as n_readings,
  {_mean('b.voltage_v')} as avg_voltage_v, min(b.voltage_v) as min_voltage_v, max(b.voltage_v) as max_voltage_v
from (select f.electrode_material_id, f.voltage_v,
        cast(floor(cast(f.current_a as double) * 1000.0 / cast(md.electrodes_area as double) / 100.0) * 100
             as bigint) as density_bin
      from fact_dat_measurements f join dim_dat_metadata md using (dat_metadata_id)
      where f.current_a is not null and f.voltage_v is not null and md.electrodes_area > 0) b
join dim_electrode_material em using (electrode_material_id)
group by em.electrode_material, b.density_bin"""))
def q1_material_by_density(spark, sf_dir):
    st = star_for(spark, sf_dir)
    return Q.q1_material_by_density(st.fact_dat_measurements, st.dim_dat_metadata,
                                    st.dim_electrode_material)


_SHARED = ("select machine_id, measurement_id, timestamp, electrode_material_id, voltage_v, current_a, "
           "operator_id from fact_excel_measurements union all select machine_id, measurement_id, timestamp, "
           "electrode_material_id, voltage_v, current_a, operator_id from fact_dat_measurements")


@register("q2_machine_compare", star_sql(f"""
select em.electrode_material, mc.machine_name, count(*) as n_readings, count(u.voltage_v) as n_voltage,
  {_mean('u.voltage_v')} as avg_voltage_v, {_mean('u.current_a')} as avg_current_a,
  min(u.voltage_v) as min_voltage_v, max(u.voltage_v) as max_voltage_v
from ({_SHARED}) u
join dim_machine mc using (machine_id)
join dim_electrode_material em using (electrode_material_id)
group by em.electrode_material, mc.machine_name"""))
def q2_machine_compare(spark, sf_dir):
    st = star_for(spark, sf_dir)
    return Q.q2_machine_compare(st.fact_excel_measurements, st.fact_dat_measurements,
                                st.dim_machine, st.dim_electrode_material)


@register("q3_degradation", star_sql(f"""
, slopes as (
  select u.measurement_id, u.electrode_material_id,
    regr_slope(cast(u.voltage_v as double),
               (epoch_us(u.timestamp) - epoch_us(ms.start_timestamp)) / 3.6e9) as slope, count(*) as n
  from ({_SHARED}) u join dim_measurement ms using (measurement_id)
  where u.voltage_v is not null
  group by u.measurement_id, u.electrode_material_id)
select em.electrode_material, count(*) as n_measurements, round(avg(slope), 6) as avg_slope_v_per_h,
  round(min(slope), 6) as min_slope_v_per_h, round(max(slope), 6) as max_slope_v_per_h
from slopes join dim_electrode_material em using (electrode_material_id)
where n >= 2 and slope is not null and not isnan(slope)
group by em.electrode_material"""))
def q3_degradation(spark, sf_dir):
    st = star_for(spark, sf_dir)
    return Q.q3_degradation(st.fact_excel_measurements, st.fact_dat_measurements,
                            st.dim_measurement, st.dim_electrode_material)


@register("q4_h2_output", star_sql(f"""
, seg as (
  select measurement_id, electrode_material_id,
    (cast(h2_flow as double) + cast(lag(h2_flow) over w as double)) / 2.0
      * (epoch_us(timestamp) - epoch_us(lag(timestamp) over w)) / 6e7 as s
  from fact_dat_measurements where h2_flow is not null and timestamp is not null
  window w as (partition by measurement_id order by timestamp, h2_flow)),
vol as (
  select electrode_material_id, round(sum(v), 4) as h2_volume, count(*) as n_measurements
  from (select measurement_id, electrode_material_id, sum(s) as v from seg
        group by measurement_id, electrode_material_id
        having count(*) > 1) group by electrode_material_id),
pur as (
  select electrode_material_id, count(*) as n_readings,
    {_mean('h2_purity_percent', 4)} as avg_h2_purity_percent, {_mean('h2_flow')} as avg_h2_flow
  from fact_dat_measurements group by electrode_material_id)
select em.electrode_material, p.n_readings, v.n_measurements, p.avg_h2_purity_percent, p.avg_h2_flow,
  v.h2_volume
from pur p left join vol v using (electrode_material_id)
join dim_electrode_material em using (electrode_material_id)"""))
def q4_h2_output(spark, sf_dir):
    st = star_for(spark, sf_dir)
    return Q.q4_h2_output(st.fact_dat_measurements, st.dim_electrode_material)
