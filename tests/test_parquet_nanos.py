"""Parquet with nanosecond timestamps (as pandas writes it) is read and narrowed."""

import datetime as dt
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq

from cellstar.sources.parquet import read_parquet_nanos


def test_nanosecond_timestamps_are_narrowed(spark):
    path = tempfile.mkdtemp(prefix="nanos-") + "/t.parquet"
    ns = [1704067211172425123, 1704067212000000999]
    pq.write_table(pa.table({"record_ID": [1, 2], "timestamp": pa.array(ns, pa.timestamp("ns"))}), path)
    df = read_parquet_nanos(spark, path, {"timestamp": "adjusted_timestamp"})
    assert df.columns == ["record_ID", "adjusted_timestamp"]
    got = [r.adjusted_timestamp for r in df.orderBy("record_ID").collect()]
    assert got == [dt.datetime(2024, 1, 1, 0, 0, 11, 172425), dt.datetime(2024, 1, 1, 0, 0, 12)]
    assert spark.conf.get("spark.sql.legacy.parquet.nanosAsLong", None) is None  # flag restored
