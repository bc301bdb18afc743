"""Work of the star build and of the loads: what is sampled, written and read again."""

import re

import pytest
from paths import SMALL

from cellstar.operators import lookup as L
from cellstar.plans import star as S
from cellstar.plans.catalog import load_all, readings_for, star_for
from cellstar.sources import fixtures as fx


def test_fact_keys_stage_only_the_fact(spark):
    load_all()
    st = star_for(spark, SMALL)
    for fact, columns in ((st.fact_dat_measurements, S.FACT_DAT_COLUMNS), (st.fact_excel_measurements, S.FACT_EXCEL_COLUMNS)):
        files = [f for f in fact.inputFiles() if "/fact_" in f]
        assert set(spark.read.parquet(*files).columns) == set(columns[1:])


@pytest.mark.parametrize("limit", [0, 20])
def test_facts_are_the_same_however_dimensions_are_joined(spark, monkeypatch, limit):
    """Dimensions above the limit are joined by shuffle, before the rows are dealt by range."""
    load_all()
    st = star_for(spark, SMALL)
    dims = {k: v for k, v in st.tables().items() if k.startswith("dim_")}
    monkeypatch.setattr(L, "is_small", lambda dim, rows, *a: rows <= limit)
    small, large = L.small_lookups([L.Lookup(dims["dim_time"], "time_id", ["time"]),
                                    L.Lookup(dims["dim_machine"], "machine_id", ["machine_name"])])
    assert [x.key_col for x in large] == (["time_id"] if limit else ["time_id", "machine_id"])
    for made, wanted in ((S.build_fact_dat(st.silver_dat, dims), st.fact_dat_measurements),
                         (S.build_fact_excel(st.silver_excel, dims), st.fact_excel_measurements)):
        assert sorted(made.collect(), key=lambda r: r[0]) == sorted(wanted.collect(), key=lambda r: r[0])


def test_rows_are_hashed_not_sorted_for_the_measurement_starts(spark):
    rd = readings_for(spark, SMALL)
    for df in (fx.metadata_rows(rd), fx.dat_rows(rd)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.findall(r"(\w+Aggregate)\(", plan)[-1] == "HashAggregate"


def test_a_load_of_new_measurements_adds_folders(spark):
    """The third load brings new measurements only: no fact and no state is written again."""
    from cellstar.plans.registry_ops import _three_loads
    load_all()
    tables = _three_loads(spark, SMALL)
    for name in ("fact_dat_measurements", "fact_excel_measurements", "state_readings", "state_volume"):
        assert len({re.search(r"_versions/(\w+)/", f)[1] for f in tables[name].inputFiles()}) == 2
