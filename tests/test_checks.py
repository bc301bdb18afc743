"""Constraint checks find seeded violations (K1-K6), and plan shape holds for every query."""

import pytest
from pyspark.sql import Row

import __spark_entry__ as E
from cellstar.operators import checks as K
from cellstar.plans import catalog
from paths import SMALL


def test_checks_report_seeded_bad_rows(spark):
    dim = spark.createDataFrame([Row(k=1, name="a"), Row(k=2, name="b"), Row(k=2, name="a" * 60)])
    fact = spark.createDataFrame([Row(id=1, k=1), Row(id=2, k=7), Row(id=3, k=None), Row(id=3, k=2)],
                                 "id bigint, k bigint")
    tables = {"dim": dim, "fact": fact}
    uniq = {(r.table_name, r.key_columns): r.n_duplicate_keys
            for r in K.check_unique(tables, {"dim": [["k"], ["name"]], "fact": [["id"]]}).collect()}
    assert uniq == {("dim", "k"): 1, ("dim", "name"): 0, ("fact", "id"): 1}
    nn = {r.column_name: r.n_null for r in K.check_not_null(tables, {"fact": ["id", "k"]}).collect()}
    assert nn == {"id": 0, "k": 1}
    fk = K.check_foreign_keys(tables, [("fact", "k", "dim", "k")]).first()
    assert fk.n_missing == 1                      # k=7; the NULL is not a violation
    ln = K.check_lengths(tables, {"dim": {"name": 50}}).first()
    assert (ln.max_length, ln.n_over) == (60, 1)
    raw = spark.createDataFrame([Row(v="1.5"), Row(v="NAN"), Row(v="123456789.5"), Row(v=None)])
    dr = {r.target: r.n_out_of_range for r in K.check_decimal_range(raw, ["v"], [(10, 4), (5, 3)]).collect()}
    assert dr == {"decimal(10,4)": 1, "decimal(5,3)": 1}


PYTHON_OK = {"sheet_ingest", "metadata_sheet_ingest"}   # the workbook reader (mapInPandas)
WINDOW_OK = {"q4_h2_output"}   # within a measurement and day, and over one row a day
catalog.load_all()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plan_shape(spark, name):
    df = E.queries()[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON_OK:
        assert "Python" not in plan and "MapInPandas" not in plan and "FlatMapGroupsInPandas" not in plan
    if name not in WINDOW_OK:
        assert "Window" not in plan      # no window anywhere: no group is ever gathered by one task
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:   # only the final step of a two-phase global aggregate
            child = lines[i + 1]
            assert "partial_" in child or "HashAggregate(keys=[], functions=[]" in child or "LocalLimit" in child or "TakeOrdered" in child, (line, child)
