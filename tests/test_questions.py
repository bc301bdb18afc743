"""Q3 / Q4 formulas on hand-made facts with known answers."""

import datetime as dt
from decimal import Decimal

from cellstar.plans import questions as Q

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
FACT = ("fact_dat_measurement_id bigint, machine_id bigint, measurement_id bigint, timestamp timestamp_ntz, "
        "electrode_material_id bigint, voltage_v decimal(10,4), current_a decimal(10,4), operator_id bigint, "
        "h2_flow decimal(10,4), h2_purity_percent decimal(10,4)")


def facts(spark, rows):
    return spark.createDataFrame(rows, FACT)


def materials(spark):
    return spark.createDataFrame([(1, "material_A")], "electrode_material_id bigint, electrode_material string")


def row(key, m, minutes, v, flow, purity):
    return (key, 2, m, T0 + dt.timedelta(minutes=minutes), 1, Decimal(v), Decimal("1.0"), 1, Decimal(flow),
            Decimal(purity))


def test_q4_trapezoid_volume_and_purity(spark):
    f = facts(spark, [row(1, 10, 0, "2", "1.0", "99"), row(2, 10, 1, "2", "3.0", "98"),
                      row(3, 10, 3, "2", "3.0", "97"), row(4, 11, 0, "2", "5.0", "96")])
    r = Q.q4_h2_output(f, materials(spark)).first()
    assert r.h2_volume == 8.0          # (1+3)/2*1 + (3+3)/2*2; measurement 11 has one reading
    assert r.n_measurements == 1 and r.n_readings == 4
    assert r.avg_h2_purity_percent == 97.5


def test_q3_slope_per_hour(spark):
    dat = facts(spark, [row(i + 1, 10, 60 * i, str(2 + 0.5 * i), "1", "99") for i in range(4)])
    excel = dat.limit(0)
    meas = spark.createDataFrame([(10, T0)], "measurement_id bigint, start_timestamp timestamp_ntz")
    r = Q.q3_degradation(excel, dat, meas, materials(spark)).first()
    assert (r.n_measurements, r.avg_slope_v_per_h) == (1, 0.5)


def test_q4_missing_flows_and_two_loads(spark):
    """A missing flow is bridged; keys that come from a second load don't matter."""
    rows = [row(1, 10, 0, "2", "60", "99"), (2, 2, 10, T0 + dt.timedelta(minutes=1), 1, Decimal("2"), Decimal("1"), 1,
                                             None, Decimal("98")), row(3, 10, 3, "2", "60", "97")]
    assert Q.q4_h2_output(facts(spark, rows), materials(spark)).first().h2_volume == 180.0
    late = [row(3, 10, 0, "2", "60", "99"), row(1, 10, 1, "2", "60", "99"), row(2, 10, 2, "2", "60", "99")]
    assert Q.q4_h2_output(facts(spark, late), materials(spark)).first().h2_volume == 120.0
    days = [row(1, 10, 0, "2", "60", "99"), row(2, 10, 1440, "2", "60", "99"), row(3, 10, 1441, "2", "60", "99")]
    assert Q.q4_h2_output(facts(spark, days), materials(spark)).first().h2_volume == 60.0 * 1441
