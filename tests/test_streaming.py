"""Incremental landing ingest: each file is loaded once, new files are picked up."""

import os
import tempfile

from cellstar.sources.fixtures import DAT_TABLE_COLUMNS
from cellstar.streaming.landing import run_available_now


def _write(root, name, n_rows):
    cols = "\t".join(DAT_TABLE_COLUMNS)
    body = "".join(f"2024-01-01 00:00:{i:02d}.000000" + "\t1.0" * 14 + "\n" for i in range(n_rows))
    with open(os.path.join(root, f"{name}.dat"), "w", encoding="latin-1") as fh:
        fh.write(f"Operator:\tOperator_1\nMeasurement Data:\n{cols}\n{body}")


def test_new_files_only(spark):
    base = tempfile.mkdtemp(prefix="stream-")
    landing, out, ckpt = (os.path.join(base, d) for d in ("landing", "bronze", "ckpt"))
    os.makedirs(landing)
    _write(landing, "2001", 3)
    _write(landing, "2003", 2)

    def ok_rows():
        return spark.read.parquet(out).filter("status = 'ok' AND line_no IS NOT NULL").count()

    run_available_now(spark, landing, out, ckpt, glob="*.dat")
    assert ok_rows() == 5
    _write(landing, "2005", 4)
    run_available_now(spark, landing, out, ckpt, glob="*.dat")
    assert ok_rows() == 9
    run_available_now(spark, landing, out, ckpt, glob="*.dat")   # nothing new: no growth
    assert ok_rows() == 9
    stems = {r.file_stem for r in spark.read.parquet(out).select("file_stem").distinct().collect()}
    assert stems == {"2001", "2003", "2005"}
