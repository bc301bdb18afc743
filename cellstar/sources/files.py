"""Landing-area files: listing, manifest, routing and file numbering.

Listing is a Spark job (``binaryFile`` with the content column pruned), so a
landing area of millions of files is never listed page by page on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellstar.functions.clean import path_extension
from cellstar.operators.keys import dense_keys

# Accepted data-file extensions per machine and the numbering bases.
MACHINE_EXTENSIONS = {"machine_1": [".xlsx", ".xls"], "machine_2": [".dat"]}
SEQUENCE_BASE = {".ndax": 1001, ".xlsx": 1001, ".dat": 2001}


def manifest(spark: SparkSession, root: str, glob: str | None = None,
             recursive: bool = True) -> DataFrame:
    """A1/A2: path, size and modification time of every file below ``root``.

    Only metadata columns are selected, so Spark never reads file contents.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(root).select("path", "length", "modificationTime")


def landing_paths(readings: DataFrame) -> DataFrame:
    """Paths of a landing area derived from the readings: one data file per
    measurement (``.xlsx`` for machine 1, ``.dat`` for machine 2), a notes file
    for every tenth measurement, and the metadata workbook."""
    t = readings.filter(F.col("table_name").rlike("^[0-9]")).select("table_name").distinct()
    m = F.substring_index("table_name", "_", 1)
    folder = F.concat(F.lit("raw-data/machine_"), F.substring("table_name", 1, 1))
    data = t.select(F.concat(folder, F.lit("/"), m,
                             F.when(F.col("table_name").startswith("1"), F.lit(".xlsx"))
                             .otherwise(F.lit(".dat"))).alias("path"))
    notes = (t.filter(m.cast("bigint") % 10 == 0)
             .select(F.concat(folder, F.lit("/notes/"), m, F.lit(".Notes.TXT")).alias("path")))
    meta = readings.sparkSession.range(1).select(F.lit("raw-data/metadata/metadata.xlsx").alias("path"))
    return data.unionByName(notes).unionByName(meta)


def route(path_col="path"):
    """Which pipeline a landed file belongs to; unknown files are kept as ``skipped``."""
    p = F.col(path_col) if isinstance(path_col, str) else path_col
    return (F.when(p.contains("metadata"), F.lit("metadata"))
            .when(p.contains("machine_1"), F.lit("machine_1"))
            .when(p.contains("machine_2"), F.lit("machine_2"))
            .otherwise(F.lit("skipped")))


def route_files(paths: DataFrame) -> DataFrame:
    """D2 + D7: route and accept by lower-case extension."""
    ext = path_extension("path")
    r = route("path")
    accepted = (F.when(r == "machine_1", ext.isin(*MACHINE_EXTENSIONS["machine_1"]))
                .when(r == "machine_2", ext.isin(*MACHINE_EXTENSIONS["machine_2"]))
                .when(r == "metadata", ext.isin(".xlsx", ".xls"))
                .otherwise(F.lit(False)))
    return paths.select("path", r.alias("route"), ext.alias("extension"), accepted.alias("accepted"))


# Name patterns of the accepted files in any letter case (a listing filter is case-sensitive).
ROUTE_GLOBS = {"machine_1": "*.{[xX][lL][sS],[xX][lL][sS][xX]}", "machine_2": "*.[dD][aA][tT]",
               "metadata": "*.{[xX][lL][sS],[xX][lL][sS][xX]}"}


def routed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Contents of the accepted files of one route, whatever their letter case."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", ROUTE_GLOBS[name])
             .option("recursiveFileLookup", "true").load(root))
    # the scheme that a listing adds stands before the root: only what follows the root counts
    below = F.substring_index(F.col("path"), root.rstrip("/").split("://")[-1], -1)
    return files.filter(route(below) == name)


def skipped(spark: SparkSession, root: str) -> DataFrame:
    """Files below ``root`` that no route accepts, with the reason."""
    below = F.substring_index(F.col("path"), root.rstrip("/").split("://")[-1], -1)
    names = manifest(spark, root).select("path", below.alias("below"))
    ext, to = path_extension("below"), route("below")
    accepted = F.coalesce(*[F.when(to == m, ext.isin(*MACHINE_EXTENSIONS.get(m, [".xlsx", ".xls"])))
                            for m in ROUTE_GLOBS], F.lit(False))
    return names.filter(~accepted).select(
        F.col("path").alias("source"),
        F.when(to == "skipped", F.lit("no route for this folder"))
        .otherwise(F.concat(F.lit("extension not accepted: "), ext)).alias("error"))


def file_sequence(paths: DataFrame, bases: dict[str, int] | None = None) -> DataFrame:
    """Number files per extension in name order from a base (1001, 2001 ...).

    One distributed dense numbering over (extension, name) -- no per-extension
    window, so an extension holding most files never lands in one task --
    then each extension's first key is subtracted.
    """
    bases = bases or SEQUENCE_BASE
    files = paths.select(
        "path",
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
        path_extension("path").alias("extension"),
    ).filter(F.col("extension").isin(*bases.keys()))
    keyed = dense_keys(files, ["extension", "file_name", "path"], "_k", name="file_sequence")
    first = keyed.groupBy("extension").agg(F.min("_k").alias("_first"))
    base = F.create_map(*[x for e, b in bases.items() for x in (F.lit(e), F.lit(b))])
    return (keyed.join(F.broadcast(first), "extension")
            .select("path", "file_name", "extension",
                    (F.element_at(base, F.col("extension")) + F.col("_k") - F.col("_first"))
                    .cast("bigint").alias("sequence")))
