"""Files cut into byte ranges give the rows of files read whole."""

import os
import random
import tempfile

import pytest

from cellstar.sources import dat as DAT
from cellstar.sources.dat_split import numbered, parse_dat_split, read_lines
from cellstar.sources.fixtures import DAT_TABLE_COLUMNS


def write(root, name, text):
    with open(os.path.join(root, name), "wb") as fh:
        fh.write(text.encode("latin-1"))


def landing():
    root = tempfile.mkdtemp(prefix="split-")
    rng = random.Random(1)
    cols = "\t".join(DAT_TABLE_COLUMNS)

    def line(i):
        return f"2024-01-01 00:{i // 60 % 60:02d}:{i % 60:02d}.000000" + "".join(
            "\t" + rng.choice(["1.5", "NAN", "", "2.25"]) for _ in range(14))

    head = "Operator:\tBjörn\nThikness: 1\nThikness: 2\nElectrodes Area [cm²]: 5.0\nnothing here\n"
    for k, (n, end) in enumerate([(400, "\n"), (3, "\r\n"), (0, "\n"), (57, "\n")]):
        write(root, f"200{k} x+y%.dat", (head + "Measurement Data: now\n" + cols + "\n").replace("\n", end)
              + "".join(line(i) + end for i in range(n)))
    write(root, "2010.dat", head * 30)                                     # no marker
    write(root, "2011.dat", "")
    write(root, "2012.dat", head + "Measurement Data:")                     # nothing after it
    write(root, "2013.dat", head + "Measurement Data:\n" + cols + "\n" + line(1) + "\t1\t2\n" + line(2) + "\n")
    write(root, "2014.dat", head + "Measurement Data:\n" + cols + "\n" + line(1) + "\n \n" + line(2))   # no last line end
    write(root, "2015.dat", "Measurement Data:\n" + cols + "\n" + line(1) + "\nMeasurement Data:\n" + line(2) + "\n")
    return root


def by_name(df, columns):
    rows = df.selectExpr("substring_index(source, '/', -1) as name", *columns).collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("size", [400, 4000, 10**8])
def test_cut_anywhere_equals_whole_files(spark, size):
    root = landing()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = read_lines(spark, root, "*.dat")
        ranges = {r.source.rsplit("/", 1)[-1]: r.n for r in
                  lines.groupBy("source").agg({"range": "count"}).withColumnRenamed("count(range)", "n").collect()}
        assert len(ranges) == 9        # the empty file has no line
        most = max(r["count"] for r in lines.select("source", "range").distinct().groupBy("source").count().collect())
        assert most > 50 if size == 400 else most > 5 if size == 4000 else most < 20
        places = [r.place for r in numbered(lines).filter("source like '%2000%'").collect()]
        assert sorted(places) == list(range(len(places)))
        split = parse_dat_split(spark, root, "*.dat")
        whole = DAT.parse_dat(DAT.read_dat_files(spark, root, "*.dat"))
        columns = [c for c in whole.columns if c not in ("source", "file_stem", "table_name")]
        a, b = (by_name(DAT.whole_files(x), columns) for x in (split, whole))
        assert a == b and len(a) > 400
        keep = lambda x: by_name(DAT.broken_files(x), ["error"])
        assert keep(split) == keep(whole) and "2013.dat" in dict(keep(whole))
    finally:
        for key, value in zip(("maxPartitionBytes", "openCostInBytes"), before):
            spark.conf.set(f"spark.sql.files.{key}", value)


def test_marker_line_is_found_once_and_no_line_is_shuffled(spark):
    root = landing()
    split = parse_dat_split(spark, root, "*.dat")
    plan = split._jdf.queryExecution().executedPlan().toString()
    body = plan.split("Union")[1] if "Union" in plan else plan
    first = body.split("FileScan parquet")[0]
    assert "SortMergeJoin" not in first and "BroadcastHashJoin" in first
    assert split.filter("file_stem = '2015'").count() == 3   # the second marker is a line like any other
