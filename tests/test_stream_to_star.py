"""Landing stream to star: killed at each step, restarted, re-delivered, under two names."""

import os
import shutil
import tempfile

import pytest

from cellstar.plans.warehouse import build_warehouse, landing_files
from cellstar.sinks import versions as V
from cellstar.sinks.publish import read_published
from cellstar.sources.fixtures import DAT_TABLE_COLUMNS
from cellstar.streaming import landing as L


def dat(root, name, day, rows, operator="Operator_1", marker="Measurement Data:"):
    cols = "\t".join(DAT_TABLE_COLUMNS)
    body = "".join(f"2024-01-{day:02d} 00:00:{i:02d}.000000\t{1 + i / 4}" + "\t1.5" * 13 + "\n" for i in range(rows))
    with open(os.path.join(root, f"{name}.dat"), "w", encoding="latin-1") as fh:
        fh.write(f"Operator:\t{operator}\nElectrodes: material_A\nElectrodes Area [cm²]: 5.0\n{marker}\n{cols}\n{body}")


def facts(tables):
    f = tables["fact_dat_measurements"].join(tables["dim_measurement"], "measurement_id") \
        .join(tables["dim_operator"], "operator_id", "left")
    keys = [r[0] for r in tables["fact_dat_measurements"].select("fact_dat_measurement_id").collect()]
    assert len(set(keys)) == len(keys)
    return sorted((r.measurement_name, str(r.timestamp), str(r.voltage_v), r.operator_name, str(r.start_timestamp),
                   str(r.finish_timestamp)) for r in f.collect())


class Killed(Exception):
    pass


def test_equals_the_batch_build_wherever_it_is_killed(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="star-")
    landing, gold, ckpt = (os.path.join(base, d) for d in ("machine_2", "gold", "ckpt"))
    os.makedirs(landing)
    dat(landing, "2001_a", 1, 3)
    dat(landing, "2003_a", 1, 2, "Operator_2")
    dat(landing, "2007_a", 1, 2, marker="no marker")

    def run():
        L.stream_to_star(spark, landing, gold, ckpt)

    real = V.commit
    def before(*_):
        raise Killed("before the commit")
    def after(spark_, draft):
        real(spark_, draft)
        raise Killed("after the commit")

    monkeypatch.setattr(V, "commit", before)
    with pytest.raises(Exception, match="before the commit"):
        run()
    assert read_published(spark, gold) == {}
    monkeypatch.setattr(V, "commit", after)
    with pytest.raises(Exception, match="after the commit"):
        run()                                     # the star is there, the stream's own log doesn't know
    one = facts(read_published(spark, gold))
    monkeypatch.setattr(V, "commit", real)
    run()                                         # the batch runs again and is recognised
    assert V.list_versions(spark, gold) == [1] and facts(read_published(spark, gold)) == one

    dat(landing, "2001_b", 2, 4)                  # a later month of a known measurement
    dat(landing, "2005_a", 1, 2, "Operator_3")
    shutil.copy(f"{landing}/2003_a.dat", f"{landing}/2003_copy.dat")   # one file under two names
    monkeypatch.setattr(L, "publish", lambda *a, **k: (_ for _ in ()).throw(Killed("while it publishes")))
    with pytest.raises(Exception, match="while it publishes"):
        run()
    assert facts(read_published(spark, gold)) == one
    monkeypatch.undo()
    run()
    L.stream_to_star(spark, landing, gold, os.path.join(base, "other"))     # all files again
    tables = read_published(spark, gold)
    assert V.list_versions(spark, gold) == [1, 2]

    os.remove(f"{landing}/2003_copy.dat")
    files = landing_files(spark, landing, glob="*.dat")
    whole = build_warehouse(files, spark.createDataFrame([], "path string, content binary")).tables()
    assert facts(tables) == facts(whole) and len(facts(tables)) == 11
    ledger = {r.source.rsplit("/", 1)[-1]: r.status for r in tables["ledger"].collect()}
    assert ledger == {"2001_a.dat": "loaded", "2003_a.dat": "loaded", "2007_a.dat": "quarantined",
                      "2001_b.dat": "loaded", "2005_a.dat": "loaded"}

    dat(landing, "2009_a", 3, 2)                  # new measurements only: the facts grow by a folder
    run()
    folders = V.manifest(spark, gold)["tables"]
    assert len(folders["fact_dat_measurements"]) == 2 and len(folders["dim_measurement"]) == 1
    assert len(facts(read_published(spark, gold))) == 13
