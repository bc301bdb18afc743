"""Run registered queries on Spark and their SQL oracles on DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: name, status, spark rows, oracle rows, seconds.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


STRICT = os.environ.get("ORACLE_STRICT") == "1"


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if STRICT else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v) if STRICT else round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date, dt.time)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    if os.environ.get("ORACLE_UTC", "1") == "1":
        con.execute("set TimeZone='UTC'")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return "rows-only", len(s_rows), None, t1 - t0, ""
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    if sorted(s_cols) != sorted(o_cols):
        return "COLS", len(s_rows), len(o_rows), t1 - t0, f"{sorted(s_cols)} vs {sorted(o_cols)}"
    a, b = rows_of(s_cols, s_rows), rows_of(o_cols, o_rows)
    if len(a) != len(b):
        return "COUNT", len(a), len(b), t1 - t0, ""
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        return "VALUES", len(a), len(b), t1 - t0, repr(diff)[:600]
    return "ok", len(a), len(b), t1 - t0, ""


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as E
    from cellstar.session import get_session
    spark = get_session()
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or list(qs)):
        try:
            st, a, b, secs, info = compare(spark, con, name, qs[name], orc.get(name), sf_dir)
        except Exception as e:  # report and continue
            st, a, b, secs, info = "ERROR", None, None, 0.0, repr(e)[:800]
        bad += st not in ("ok", "rows-only")
        print(f"{name:28s} {st:9s} {a!s:>7} {b!s:>7} {secs:6.1f}s {info}", flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
