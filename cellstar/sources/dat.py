"""Machine 2 ``.dat`` files: render from rows, and parse back.

File layout (ISO-8859-1): ``key: value`` header lines, a line starting with
``Measurement Data:``, a tab-separated line of column names, then one
tab-separated line per reading.

Parsing uses only built-in functions on the ``binaryFile`` content: decode,
split into lines, find the marker with ``array_position``, fold the header
entries into a map (a repeated key keeps its last value), then
``posexplode`` the table lines and pick each column by its position in the
name line. One file is one row until the explode, so files -- not
measurements -- are the unit of parallelism.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellstar.functions.clean import MEASUREMENT_DATA_MARKER, measurement_name, q
from cellstar.operators.keys import stage
from cellstar.operators.lookup import broadcast_if_small
from cellstar.sources.fixtures import (
    DAT_COLUMN_MAP, DAT_HEADER_FIELDS, DAT_HEADER_KEYS, DAT_HEADER_MAP, DAT_MEASURES, DAT_TABLE_COLUMNS,
)

ENCODING = "ISO-8859-1"
WHITESPACE = " \t\r\n\x0b\x0c"
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# The forms that fixture files mix: with a blank or a T, six or nine digits.
TS_TEXT_FORMS = [TS_TEXT_FORMAT, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss.SSSSSS'000'"]
# Cell texts a CSV reader (pandas defaults) takes as missing.
# ``NAN`` in upper case is not among them; the cleaning rule handles it.
MISSING_CELLS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                 "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


# --- rendering (a sink: rows -> files) --------------------------------------------

def _header_line(key: str, value: Column) -> Column:
    sep = ":\t" if key == "Operator" else ": "
    return F.concat(F.lit(key + sep), F.coalesce(value, F.lit("NAN")))


def dat_lines(dat: DataFrame) -> DataFrame:
    """One row per output line: (file_stem, section, order, line).

    Files are per measurement and calendar month of the reading, so one file
    holds at most a month of one instrument; header values are those of the
    measurement (constant per file).
    """
    m = measurement_name("table_name")
    stem = F.concat(m, F.lit("_"), F.date_format("timestamp", "yyyyMM"))
    rows = dat.select(stem.alias("file_stem"), "timestamp", "record_id",
                      *DAT_MEASURES, *DAT_HEADER_FIELDS)
    data = rows.select(
        "file_stem", F.lit(2).alias("section"), F.col("timestamp").alias("ts"), F.col("record_id").alias("ord"),
        F.concat_ws("\t", F.element_at(F.array(*[F.date_format("timestamp", f) for f in TS_TEXT_FORMS]),
                                       F.pmod("record_id", F.lit(len(TS_TEXT_FORMS))).cast("int") + 1),
                    *[F.coalesce(F.col(c), F.lit("")) for c in DAT_MEASURES]).alias("line"))
    heads = rows.groupBy("file_stem").agg(*[F.min(c).alias(c) for c in DAT_HEADER_FIELDS])
    header = heads.select("file_stem", F.explode(F.array(*[
        F.struct(F.lit(i).alias("ord"), _header_line(k, F.col(f)).alias("line"))
        for i, (k, f) in enumerate(DAT_HEADER_MAP.items())]
        + [F.struct(F.lit(len(DAT_HEADER_KEYS)).alias("ord"), F.lit(MEASUREMENT_DATA_MARKER).alias("line")),
           F.struct(F.lit(len(DAT_HEADER_KEYS) + 1).alias("ord"),
                    F.lit("\t".join(DAT_TABLE_COLUMNS)).alias("line"))])).alias("h"))
    header = header.select("file_stem", F.lit(1).alias("section"), F.lit(None).cast("timestamp_ntz").alias("ts"),
                           F.col("h.ord").cast("bigint").alias("ord"), F.col("h.line").alias("line"))
    return header.unionByName(data.withColumn("ts", F.col("ts").cast("timestamp_ntz")))


def broken_lines(dat: DataFrame, every: int = 10, rem: int = 3) -> DataFrame:
    """Header-only copies (no marker) of the measurements numbered ``rem``
    modulo ``every``: files the ingest must quarantine."""
    m = measurement_name("table_name")
    heads = (dat.filter(m.cast("bigint") % every == rem)
             .groupBy(F.concat(m, F.lit("_broken")).alias("file_stem"))
             .agg(*[F.min(c).alias(c) for c in DAT_HEADER_FIELDS]))
    return heads.select("file_stem", F.lit(1).alias("section"), F.lit(None).cast("timestamp_ntz").alias("ts"),
                        F.explode(F.array(*[F.struct(F.lit(i).cast("bigint").alias("ord"),
                                                     _header_line(k, F.col(f)).alias("line"))
                                            for i, (k, f) in enumerate(DAT_HEADER_MAP.items())])).alias("h")) \
        .select("file_stem", "section", "ts", F.col("h.ord").alias("ord"), F.col("h.line").alias("line"))


def write_dat_files(lines: DataFrame, out_dir: str) -> str:
    """Write one Latin-1 text file per ``file_stem`` (folder ``file_stem=<stem>``).

    Every stem goes to one task (hash partitioning on the stem), lines sorted
    by section and reading time; no quoting, no trimming.
    """
    (lines.repartition("file_stem")
     .sortWithinPartitions("file_stem", "section", "ts", "ord")
     .select("file_stem", "line")
     .write.mode("errorifexists").partitionBy("file_stem")
     .option("encoding", ENCODING).option("sep", "\u0001").option("quote", "\u0000")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .option("header", "false")
     .csv(out_dir))
    return out_dir


# --- parsing (a source: files -> rows) ---------------------------------------------

def read_dat_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """A1/A5: the raw bytes of every file below ``root`` with its path (and any
    partition folders such as ``file_stem=``)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(root)


def parse_files(files: DataFrame, name_col: str | None = None) -> DataFrame:
    """One row per file -- header map, column names, table lines
    and the reason the file cannot be read (NULL when it can)."""
    name = q(name_col) if name_col and name_col in files.columns else \
        "regexp_extract(path, '([^/]+?)(\\\\.[^./]*)?$', 1)"
    ws = _lit(WHITESPACE)
    marker = _lit(MEASUREMENT_DATA_MARKER)
    base = files.selectExpr(
        "path AS source", f"{name} AS file_stem",
        f"split(decode(content, '{ENCODING}'), '\\r?\\n') AS lines")
    base = base.selectExpr(
        "*", f"CAST(array_position(transform(lines, l -> startswith(l, {marker})), true) AS INT) AS marker_pos")
    head = ("CASE WHEN marker_pos > 0 THEN slice(lines, 1, greatest(marker_pos - 1, 0)) "
            "ELSE CAST(array() AS ARRAY<STRING>) END")
    kv = (f"transform(filter({head}, l -> instr(l, ':') > 0), l -> named_struct("
          f"'key', btrim(substring_index(l, ':', 1), {ws}), "
          f"'value', btrim(substring(l, instr(l, ':') + 1), {ws})))")
    # A repeated key keeps its last value (independent of the session's map key
    # policy): fold the entries into a map, replacing an earlier value. Lambdas
    # here and below refer only to their own arguments, never to a computed
    # column: when a filter on the result is pushed down, such a column would be
    # re-expanded inside the lambda, once per element.
    header = ("aggregate(_kv, CAST(map() AS MAP<STRING,STRING>), (acc, e) -> "
              "map_concat(map_filter(acc, (k, v) -> k != e.key), map(e.key, e.value)))")
    base = base.selectExpr("*", f"{kv} AS _kv")
    parsed = base.selectExpr(
        "source", "file_stem",
        f"{header} AS header",
        "split(CASE WHEN marker_pos > 0 THEN try_element_at(lines, marker_pos + 1) END, '\\t') AS columns",
        "filter(CASE WHEN marker_pos > 0 THEN slice(lines, marker_pos + 2, greatest(size(lines), 1)) END, "
        "l -> length(trim(l)) > 0) AS body",
        "CASE WHEN marker_pos = 0 THEN 'no measurement data marker' END AS _e1")
    # a table line with more cells than the column line makes the whole file
    # unreadable, as a CSV reader reports it; fewer cells are missing values
    too_wide = "coalesce(array_max(transform(body, l -> size(split(l, '\\t')))), 0) > size(columns)"
    return parsed.selectExpr(
        "source", "file_stem", "header", "columns", "body",
        "coalesce(_e1, CASE WHEN columns IS NULL OR size(columns) = 0 THEN 'no column line' END, "
        f"CASE WHEN {too_wide} THEN 'row with more cells than columns' END) AS error")


def parse_dat(files: DataFrame, name_col: str | None = None) -> DataFrame:
    """A4-A8 + A15 in one pass: one row per table line with the header fields
    and the clean column names; a file that cannot be read keeps one row with
    ``status = 'quarantined'`` and its ``error``.

    Column positions and header values are resolved once per file, before the
    lines are exploded, so each line only indexes its split values.
    """
    resolved = resolve_files(parse_files(files, name_col), "CASE WHEN error IS NULL THEN body END AS _body")
    return line_cells(resolved.selectExpr("*", "posexplode_outer(_body) AS (line_no, line)").drop("_body"))


def resolve_files(per_file: DataFrame, *more: str) -> DataFrame:
    """Column positions and header values of each file (a select of its own, so
    they are computed once per file and not per line)."""
    srcs = list(DAT_COLUMN_MAP)
    return per_file.selectExpr(
        "source", "file_stem", "error",
        *[f"CAST(array_position(columns, {_lit(src)}) AS INT) AS _p{i}" for i, src in enumerate(srcs)],
        *[f"try_element_at(header, {_lit(src)}) AS _h{i}" for i, src in enumerate(srcs)],
        *[f"try_element_at(header, {_lit(k)}) AS {f}" for k, f in DAT_HEADER_MAP.items()], *more)


def line_cells(lines: DataFrame, wide: str | None = None) -> DataFrame:
    """Rows of ``resolve_files`` with ``line_no`` and ``line``: the line's cells.
    ``wide`` says which lines have too many, where that isn't known by file."""
    # split each line once; the cells below index the split array
    split = lines.selectExpr("*", "split(line, '\\t') AS _values")
    taken = []  # each cell's text in a select of its own: what follows names it several times
    missing = ", ".join(_lit(m) for m in MISSING_CELLS)
    cells, bad = [], [f"WHEN {wide} THEN 'row with more cells than columns'"] if wide else []
    for i, clean in enumerate(DAT_COLUMN_MAP.values()):
        v = f"CASE WHEN _p{i} > 0 THEN try_element_at(_values, _p{i}) END"
        v = f"CASE WHEN ({v}) IN ({missing}) THEN NULL ELSE {v} END"
        taken.append(f"coalesce(_h{i}, {v}) AS _c{i}")  # a header key equal to a column name wins
        expr = f"_c{i}"
        if clean == "timestamp":
            raw, expr = expr, timestamp_sql(expr)
            bad.append(f"WHEN ({raw}) IS NOT NULL AND ({expr}) IS NULL THEN concat('unreadable timestamp: ', {raw})")
        else:
            bad.append(unfit_sql(clean, expr, "DECIMAL(10,4)"))
        cells.append(f"{expr} AS {clean}")
    bad += [unfit_sql(f, f, kind) for f, kind in HEADER_TYPES.items()]
    return split.selectExpr("*", *taken).selectExpr(
        "source", "file_stem", "line_no",
        "CASE WHEN error IS NULL THEN 'ok' ELSE 'quarantined' END AS status", "error",
        "concat(file_stem, '_table') AS table_name", *cells, *DAT_HEADER_FIELDS,
        f"CASE WHEN line_no IS NULL THEN NULL {' '.join(bad)} END AS cell_error")


# Types of the header fields that aren't text.
HEADER_TYPES = {"thickness": "BIGINT", "porosity": "BIGINT", "electrodes_area": "DECIMAL(10,3)",
                "current_density_value": "DECIMAL(10,2)", "pump_speed_value": "DECIMAL(10,2)",
                "experiment_running_time": "DECIMAL(10,2)"}


def timestamp_sql(text: str) -> str:
    """The instrument's form, or any ISO 8601 form with 0-9 fraction digits
    (beyond microseconds they are cut); NULL where neither fits."""
    return (f"coalesce(CAST(try_to_timestamp({text}, '{TS_TEXT_FORMAT}') AS TIMESTAMP_NTZ), "
            f"try_cast({text} AS TIMESTAMP_NTZ))")


def unfit_sql(name: str, text: str, kind: str) -> str:
    """A CASE branch: the reason when a present cell doesn't fit its type."""
    return (f"WHEN ({text}) <> 'NAN' AND try_cast({text} AS {kind}) IS NULL "
            f"THEN concat('unreadable {name}: ', {text})")


def whole_files(landed: DataFrame) -> DataFrame:
    """The rows of the files that could be read whole. ``landed`` is a
    written table of ``parse_dat`` or ``read_sheets`` rows; one bad cell or a
    broken end keeps all of its file out."""
    bad = landed.filter(F.coalesce("error", "cell_error").isNotNull()).select("source").distinct()
    return landed.join(broadcast_if_small(stage(bad, "bad_files")), "source", "left_anti")


def broken_files(landed: DataFrame) -> DataFrame:
    """One row per file that is kept out, with its first reason."""
    return (landed.select("source", F.coalesce("error", "cell_error").alias("error"))
            .filter(F.col("error").isNotNull()).groupBy("source").agg(F.min("error").alias("error")))


def _lit(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def dat_rows_from_files(parsed: DataFrame) -> DataFrame:
    """The readable rows of a ``parse_dat`` result: rows with a line number
    (a quarantined file explodes to one row without one)."""
    return parsed.filter(F.col("line_no").isNotNull())


def ingest_status(parsed: DataFrame) -> DataFrame:
    """One row per file with its status, error and row count."""
    return (parsed.groupBy("source", "file_stem", "status", "error")
            .agg(F.count("line_no").alias("n_rows")))
