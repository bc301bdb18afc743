"""Landing-file helpers: routing, path parts, per-extension numbering."""

from pyspark.sql import Row

from cellstar.functions import clean as C
from cellstar.sources.files import file_sequence, route_files


def paths(spark, *ps):
    return spark.createDataFrame([Row(path=p) for p in ps])


def test_route_and_accept(spark):
    df = paths(spark, "raw/machine_1/a.XLSX", "raw/machine_2/b.DAT", "raw/machine_2/c.txt",
               "raw/metadata/metadata.xlsx", "raw/other/x.dat", "raw/machine_1/metadata_copy.dat")
    got = {r.path: (r.route, r.extension, r.accepted) for r in route_files(df).collect()}
    assert got["raw/machine_1/a.XLSX"] == ("machine_1", ".xlsx", True)      # case-insensitive extension
    assert got["raw/machine_2/b.DAT"] == ("machine_2", ".dat", True)
    assert got["raw/machine_2/c.txt"] == ("machine_2", ".txt", False)
    assert got["raw/metadata/metadata.xlsx"] == ("metadata", ".xlsx", True)
    assert got["raw/other/x.dat"] == ("skipped", ".dat", False)             # unknown files kept, flagged
    assert got["raw/machine_1/metadata_copy.dat"][0] == "metadata"          # 'metadata' wins, as routed


def test_path_parts(spark):
    df = paths(spark, "s3://b/raw/machine_2/2001.run.1.dat", "/x/noext")
    got = {r.path: r for r in df.select("path", C.path_stem("path").alias("stem"),
                                        C.path_folder("path").alias("folder"),
                                        C.table_name_of("path").alias("t")).collect()}
    r = got["s3://b/raw/machine_2/2001.run.1.dat"]
    assert (r.stem, r.folder, r.t) == ("2001.run.1", "machine_2", "2001_run_1_table")
    assert got["/x/noext"].stem == "noext"


def test_file_sequence_per_extension(spark):
    df = paths(spark, "m2/b.dat", "m1/z.xlsx", "m2/a.dat", "m1/y.xlsx", "m2/c.txt")
    got = {r.file_name: r.sequence for r in file_sequence(df).collect()}
    assert got == {"y.xlsx": 1001, "z.xlsx": 1002, "a.dat": 2001, "b.dat": 2002}


def test_ndax_files_numbered_from_1001(spark):
    df = paths(spark, "m1/b.ndax", "m1/a.NDAX", "m2/x.dat")
    got = {r.file_name: r.sequence for r in file_sequence(df).collect()}
    assert got == {"a.NDAX": 1001, "b.ndax": 1002, "x.dat": 2001}
