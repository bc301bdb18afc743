"""One commit for all tables: failures between any two, two publishers, appended folders, old versions."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cellstar.sinks import versions as V
from cellstar.sinks.publish import publish, read_published

NAMES = [f"t{i}" for i in range(9)]


def load(spark, value, rows=3):
    return {n: spark.range(rows).select(F.lit(value).alias("v"), (F.col("id") % 2).alias("date_id"), "id") for n in NAMES}


def seen(spark, root, version=None):
    return {n: sorted((r.v, r.id) for r in df.collect()) for n, df in read_published(spark, root, version).items()}


def folders(root):
    return sorted(os.listdir(f"{root}/_versions"))


def test_failure_between_any_two_tables_leaves_all_as_they_were(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="gold-") + "/gold"
    assert read_published(spark, root) == {}
    publish(load(spark, "old"), root, partition_by={"t3": ["date_id"]})
    before, files = seen(spark, root), folders(root)
    assert set(before) == set(NAMES) and before["t3"] == [("old", i) for i in range(3)]
    for k in range(9):
        new = load(spark, "new")
        new[NAMES[k]] = new[NAMES[k]].withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
        with pytest.raises(Exception, match="lost"):
            publish(new, root)
        assert seen(spark, root) == before and folders(root) == files
    monkeypatch.setattr(V, "commit", lambda *_: (_ for _ in ()).throw(OSError("killed before the commit")))
    with pytest.raises(OSError):
        publish(load(spark, "new"), root)
    assert seen(spark, root) == before and V.list_versions(spark, root) == [1]


def test_two_publishers_one_wins(spark):
    root = tempfile.mkdtemp(prefix="gold-") + "/gold"
    publish(load(spark, "base"), root)
    first, second = (V.prepare(spark, root, load(spark, x)) for x in ("first", "second"))
    assert V.commit(spark, second) == 2
    with pytest.raises(V.Conflict):
        V.commit(spark, first)
    assert {v for rows in seen(spark, root).values() for v, _ in rows} == {"second"}
    assert V.list_versions(spark, root) == [1, 2] and len(folders(root)) == 2
    assert not [f for f in os.listdir(f"{root}/_commits") if f.startswith(".") and not f.endswith(".crc")]


def test_readers_keep_their_version_and_old_ones_expire(spark):
    root = tempfile.mkdtemp(prefix="gold-") + "/gold"
    publish(load(spark, "one"), root)
    reader = read_published(spark, root)
    part = {"t0": load(spark, "two")["t0"]}
    publish({}, root, append=part, carry=True)                                  # t1.. are carried, t0 grows
    assert sorted(r.v for r in reader["t0"].collect()) == ["one"] * 3
    assert seen(spark, root)["t0"] == [("one", i) for i in range(3)] + [("two", i) for i in range(3)]
    assert seen(spark, root)["t8"] == seen(spark, root, 1)["t8"]
    publish({"t8": load(spark, "three")["t8"]}, root, carry=True, note={"load": 3})
    assert V.manifest(spark, root)["note"] == {"load": 3}
    assert V.expire(spark, root, keep=1) == [1, 2]
    now = seen(spark, root)
    assert now["t8"] == [("three", i) for i in range(3)] and len(now["t0"]) == 6 and now["t1"][0][0] == "one"
