"""Machine 2 ``.dat`` files of any size (A4-A8, A15): read by byte range.

``sources/dat`` holds a file in one row, so below 2 GB and a task's memory. Here
Spark's text source cuts files into ranges (``spark.sql.files.maxPartitionBytes``)
and finds the line starts at their edges; a task holds a line. The lines are
written once, as they come, and their place follows from the written file's row
numbers, so no line is shuffled or sorted to know what comes before it:

    place in a file = lines in the file's earlier ranges + lines before it in its range

Where the marker line stands is one small aggregate a file; header lines (before
it) and the column line (after it) come from there, at most a value for each known
key. Lines are joined to that by file, broadcast behind a size check.

Same rows as ``parse_dat`` (line numbers too). Differences: blank lines count
nowhere, so one between the marker and the column line is passed over, and a line
with too many cells is reported as that line's ``cell_error``, which keeps the
file out just the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellstar.functions.clean import MEASUREMENT_DATA_MARKER
from cellstar.operators.keys import stage
from cellstar.operators.lookup import broadcast_if_small
from cellstar.sources.dat import ENCODING, WHITESPACE, line_cells, resolve_files
from cellstar.sources.fixtures import DAT_COLUMN_MAP, DAT_HEADER_KEYS

#: The path as a text; a scan gives it percent-encoded.
_PATH = "url_decode(replace(_metadata.file_path, '+', '%2B')) AS source"


def read_lines(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(source, range, line) of every line that isn't blank, written once in file order."""
    raw = (spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
           .text(root))
    lines = raw.select(F.expr(_PATH), F.col("_metadata.file_block_start").alias("range"),
                       F.regexp_replace(F.decode(F.col("value").cast("binary"), ENCODING), "\r$", "").alias("line"))
    return stage(lines.filter(F.length(F.trim("line")) > 0), "dat_lines")


def numbered(lines: DataFrame) -> DataFrame:
    """The lines with ``place``, their number (from 0) in their file."""
    rows = lines.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    # a range is read by one task: it lies in one written file, or in consecutive ones
    pieces = stage(rows.groupBy("source", "range", "_file").agg(F.min("_row").alias("_first"), F.count("*").alias("_n")),
                   "dat_ranges")
    # one row for each maxPartitionBytes of a file
    earlier = Window.partitionBy("source").orderBy("range", "_file").rowsBetween(Window.unboundedPreceding, -1)
    before = pieces.select("source", "range", "_file", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return rows.join(broadcast_if_small(before), ["source", "range", "_file"]).select(
        "source", "line", (F.col("_before") + F.col("_row") - F.col("_first")).alias("place"))


def parse_dat_split(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """``parse_dat`` rows of every file below ``root``, read by byte range."""
    lines = numbered(read_lines(spark, root, glob))
    marker = lines.filter(F.col("line").startswith(MEASUREMENT_DATA_MARKER)).groupBy("source").agg(
        F.min("place").alias("marker"))
    marker = stage(marker, "dat_markers")
    around = lines.join(broadcast_if_small(marker), "source")
    ws = F.lit(WHITESPACE)
    key = F.btrim(F.substring_index("line", ":", 1), ws)
    known = [*DAT_HEADER_KEYS, *DAT_COLUMN_MAP]
    header = (around.filter((F.col("place") < F.col("marker")) & F.col("line").contains(":") & key.isin(known))
              .groupBy("source", key.alias("k")).agg(F.max_by("line", "place").alias("line"))
              .groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct(
                  "k", F.btrim(F.expr("substring(line, instr(line, ':') + 1)"), ws)))).alias("header")))
    names = around.filter(F.col("place") == F.col("marker") + 1).select("source", F.split("line", "\t").alias("columns"))
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
             .load(root).select(F.expr(_PATH)))   # names only: no content is read
    folder = F.regexp_extract("source", r"file_stem=([^/]+)/", 1)
    per_file = (files.join(marker, "source", "left").join(header, "source", "left").join(names, "source", "left").select(
        "source", F.when(folder != "", folder).otherwise(
            F.regexp_extract("source", r"([^/]+?)(\.[^./]*)?$", 1)).alias("file_stem"),
        F.coalesce("header", F.expr("CAST(map() AS MAP<STRING,STRING>)")).alias("header"), "columns", "marker",
        F.when(F.col("marker").isNull(), "no measurement data marker").when(F.col("columns").isNull(), "no column line")
        .alias("error")))
    resolved = stage(resolve_files(per_file, "marker", "size(columns) AS _width"), "dat_files")
    body = (lines.join(broadcast_if_small(resolved.filter("error IS NULL")), "source")
            .filter(F.col("place") > F.col("marker") + 1)
            .withColumn("line_no", (F.col("place") - F.col("marker") - 2).cast("int")).drop("place"))
    unread = resolved.filter("error IS NOT NULL").select("*", F.lit(None).cast("int").alias("line_no"),
                                                         F.lit(None).cast("string").alias("line"))
    empty = resolved.filter("error IS NULL").join(body.select("source").distinct(), "source", "left_anti").select(
        "*", F.lit(None).cast("int").alias("line_no"), F.lit(None).cast("string").alias("line"))
    return line_cells(body.unionByName(unread).unionByName(empty), wide="size(_values) > _width")
