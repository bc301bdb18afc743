"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from cellstar.plans import catalog
from oracle_check import compare
from paths import SMALL

catalog.load_all()
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


def test_every_engine_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    status, a, b, _, info = compare(spark, duck, name, QUERIES[name], ORACLES.get(name), SMALL)
    assert status in ("ok", "rows-only"), f"{name}: {status} {a} {b} {info}"


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 4
    assert set(df.columns) >= {"electrode_material", "machine_name", "avg_voltage_v"}


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_result_types_match_oracle(spark, duck, name):
    spark_types = {f.name: f.dataType.simpleString() for f in QUERIES[name](spark, SMALL).schema.fields}
    duck_types = {d[0]: str(d[1]) for d in duck.execute(ORACLES[name]).description}
    for col, t in spark_types.items():
        assert duck_types.get(col) == SPARK_TO_DUCK.get(t, t.upper()), (name, col, t, duck_types.get(col))
