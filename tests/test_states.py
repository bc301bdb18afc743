"""States of the questions: any split into loads and parts answers as the facts do; states only are read."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from paths import SMALL

from cellstar.operators.keys import stage
from cellstar.plans import questions as Q
from cellstar.plans import states as ST
from cellstar.plans.catalog import QUERIES, load_all

T0 = dt.datetime(2024, 1, 1, 20, 0, 0)
FACT = ("fact_dat_measurement_id bigint, machine_id bigint, measurement_id bigint, timestamp timestamp_ntz, "
        "electrode_material_id bigint, dat_metadata_id bigint, voltage_v decimal(10,4), current_a decimal(10,4), "
        "operator_id bigint, h2_flow decimal(10,4), h2_purity_percent decimal(10,4), first string")


def rows_of(seed, n=400, measurements=5):
    """Readings over several days with missing values and times, equal times
    and a measurement that changes its material."""
    r = random.Random(seed)

    def number(hi):
        return None if r.random() < 0.15 else Decimal(r.randrange(hi)) / 100

    out = []
    for i in range(n):
        m = r.randrange(measurements)
        at = None if r.random() < 0.02 else T0 + dt.timedelta(minutes=r.randrange(6000))
        out.append((i, 2, m, at, 1 + (m == 0 and r.random() < 0.5) + m % 2, 1, number(300), number(500), 1, number(900),
                    number(10000), "x"))
    return out


def tables(spark):
    return {"area": spark.createDataFrame([(1, Decimal("5.0"))], "dat_metadata_id bigint, electrodes_area decimal(10,3)"),
            "material": spark.createDataFrame([(i, f"material_{i}") for i in (1, 2, 3)],
                                              "electrode_material_id bigint, electrode_material string"),
            "machine": spark.createDataFrame([(2, "machine_2")], "machine_id bigint, machine_name string"),
            "measurement": spark.createDataFrame([(m, T0) for m in range(9)],
                                                 "measurement_id bigint, start_timestamp timestamp_ntz")}


def answers(states, t):
    return [ST.q1_material_by_density(states, t["material"]), ST.q2_machine_compare(states, t["machine"], t["material"]),
            ST.q3_degradation(states, t["material"]), ST.q4_h2_output(states, t["material"])]


def same(found, wanted):
    for a, b in zip(found, wanted):
        assert a.columns == b.columns
        left, right = (sorted((tuple(r) for r in df.collect()), key=repr) for df in (a, b))
        assert len(left) == len(right)
        for x, y in zip(left, right):
            for u, v in zip(x, y):
                assert u == pytest.approx(v, rel=1e-6, abs=2e-6) if isinstance(u, float) else u == v


def expected(fact, t):
    none = fact.limit(0)
    return [Q.q1_material_by_density(fact, t["area"], t["material"]), Q.q2_machine_compare(none, fact, t["machine"], t["material"]),
            Q.q3_degradation(none, fact, t["measurement"], t["material"]), Q.q4_h2_output(fact, t["material"])]


def test_states_answer_as_facts_do_whole_and_compacted(spark):
    t = tables(spark)
    fact = stage(spark.createDataFrame(rows_of(1), FACT), "t")
    states = ST.measurement_states(fact.limit(0), fact, t["area"])
    wanted = expected(fact, t)
    same(answers(states, t), wanted)
    folded = {k: stage(df, k) for k, df in ST.compact(states).items()}
    same(answers(folded, t), wanted)
    assert folded["state_interval"].count() <= 5
    assert {k: v.columns for k, v in folded.items()} == {k: v.columns for k, v in states.items()}


def test_parts_cut_at_any_time_merge(spark):
    """Three loads of the same measurements, each a later stretch of time; the
    first two folded before the third comes."""
    t = tables(spark)
    rows = [r for r in rows_of(2) if r[3] is not None]
    fact = stage(spark.createDataFrame(rows, FACT), "t")
    cuts = [T0, T0 + dt.timedelta(minutes=1777), T0 + dt.timedelta(minutes=4000), T0 + dt.timedelta(days=99)]
    states = None
    for a, b in zip(cuts, cuts[1:]):
        part = spark.createDataFrame([r for r in rows if a <= r[3] < b], FACT)
        new = ST.measurement_states(part.limit(0), part, t["area"])
        states = new if states is None else ST.compact(ST.append_states(states, new))
    same(answers(states, t), expected(fact, t))


def test_overlapping_parts_are_refused(spark):
    t = tables(spark)
    fact = stage(spark.createDataFrame(rows_of(3), FACT), "t")
    odd = ST.measurement_states(fact.limit(0), fact.filter("fact_dat_measurement_id % 2 = 1"), t["area"])
    even = ST.measurement_states(fact.limit(0), fact.filter("fact_dat_measurement_id % 2 = 0"), t["area"])
    with pytest.raises(ST.OverlappingParts):
        ST.append_states(odd, even)


def test_a_loaded_measurement_is_replaced(spark):
    t = tables(spark)
    old = spark.createDataFrame(rows_of(4), FACT)
    again = stage(spark.createDataFrame([r for r in rows_of(5) if r[2] in (1, 3)], FACT), "t")
    states = ST.replace_states(ST.measurement_states(old.limit(0), old, t["area"]),
                               ST.measurement_states(old.limit(0), again, t["area"]))
    fact = stage(old.filter("measurement_id not in (1, 3)").unionByName(again), "t")
    same(answers(states, t), expected(fact, t))


def test_empty_facts(spark):
    t = tables(spark)
    none = spark.createDataFrame([], FACT)
    states = ST.measurement_states(none, none, t["area"])
    assert [df.count() for df in answers(states, t)] == [0, 0, 0, 0]
    assert [df.count() for df in answers(ST.compact(states), t)] == [0, 0, 0, 0]


def test_after_three_loads_only_states_and_dimensions_are_read(spark):
    load_all()
    for q, source in (("q1", "q1_material_by_density"), ("q2", "q2_machine_compare"), ("q3", "q3_degradation"),
                      ("q4", "q4_h2_output")):
        found = QUERIES[f"{q}_from_states"](spark, SMALL)
        read = {f.split("/")[-2] for f in found.inputFiles()}
        assert read and not any("fact_" in f or "date_id=" in f for f in read), read
        same([found], [QUERIES[source](spark, SMALL)])
