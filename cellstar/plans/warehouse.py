"""From landed files to the star schema: the whole chain as one Spark application.

    landing (binaryFile rows: path, content)
      .dat files        --parse_dat-->        machine 2 rows --+
      machine 1 books   --read_sheets-->      machine 1 rows --+--> build_star --> publish
      metadata books    --read_sheets-->      metadata rows  --+

Every input is a DataFrame of ``(path, content)`` -- what
``spark.read.format("binaryFile")`` returns -- so the landing area can be any
file system Spark reads. Each file is parsed once, into written tables; files
that cannot be read whole are reported by ``Landed.quarantine`` and left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellstar.operators.keys import stage
from cellstar.plans.concurrent import run_concurrently
from cellstar.plans.star import Star, build_star, update_star
from cellstar.sinks.publish import publish
from cellstar.sources import dat as DAT
from cellstar.sources import sheet as SH
from cellstar.sources.fixtures import DAT_HEADER_FIELDS, DAT_MEASURES

# The machine 1 sheet's columns and the metadata sheet's columns, as the sheets name them.
SHEET_COLUMNS = ["record_ID", "cycle", "step_ID", "step_name", "time_in_step", "voltage_V", "current_mA",
                 "capacity_mAh", "energy_mWh", "timestamp", "Validated"]
SHEET_NUMERIC = {"record_ID", "cycle", "step_ID", "time_in_step", "current_mA", "timestamp"}
SHEET_DECIMALS = {"voltage_V": "DECIMAL(10,4)", "capacity_mAh": "DECIMAL(18,8)", "energy_mWh": "DECIMAL(18,8)"}
METADATA_COLUMNS = ["json_name", "operator_name", "operator_level", "machine_name", "machine_type",
                    "electrode_material", "measurement_name"]


def landing_files(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """A1: every file below ``root`` as (path, modificationTime, length, content)."""
    r = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.load(root)


def serial_sql(text: str, base_1904: str) -> str:
    """A date number (days, as a workbook stores times) as a timestamp, rounded
    to the microsecond; NULL when ``text`` is no number."""
    days = f"try_cast({text} AS DOUBLE)"
    first = f"CASE WHEN {base_1904} THEN -24107 ELSE -25569 END"   # 1904-01-01 and 1899-12-30 from 1970-01-01
    return (f"CAST(timestamp_micros((CAST(floor({days}) AS BIGINT) + {first}) * 86400000000 "
            f"+ CAST(round(({days} - floor({days})) * 86400000000D) AS BIGINT)) AS TIMESTAMP_NTZ)")


def land_sheets(files: DataFrame, sheet_name: str = "Sheet1") -> DataFrame:
    """A3: machine 1 workbook rows, typed, with ``error`` (the workbook) and
    ``cell_error`` (the row). Texts that a sheet reader takes as missing are
    NULL; a time is a date number or an ISO text."""
    rows = SH.read_sheets(files, SHEET_COLUMNS, sheet_name=sheet_name)
    missing = ", ".join(DAT._lit(m) for m in DAT.MISSING_CELLS)
    rows = rows.selectExpr("source", "row_no", "error", "date1904",
                           *[f"CASE WHEN {c} IN ({missing}) THEN NULL ELSE {c} END AS {c}" for c in SHEET_COLUMNS])
    whole = "CAST(try_cast({c} AS DECIMAL(38,9)) AS BIGINT)"
    typed = {c: whole.format(c=c) for c in ("record_ID", "cycle", "step_ID")}
    typed |= {c: f"try_cast({c} AS DOUBLE)" for c in ("time_in_step", "current_mA")}
    typed["timestamp"] = f"coalesce({serial_sql('timestamp', 'coalesce(date1904, false)')}, {DAT.timestamp_sql('timestamp')})"
    bad = [f"WHEN {c} IS NOT NULL AND {c} <> 'NAN' AND ({e}) IS NULL THEN concat('unreadable {c}: ', {c})"
           for c, e in typed.items()]
    bad += [DAT.unfit_sql(c, c, kind) for c, kind in SHEET_DECIMALS.items()]
    return rows.selectExpr(
        "source", "row_no", "error", "concat(" + path_stem_sql("source") + ", '_table') AS table_name",
        *[f"{typed.get(c, c)} AS {c}" for c in SHEET_COLUMNS], f"CASE {' '.join(bad)} END AS cell_error")


def path_stem_sql(path: str) -> str:
    return f"regexp_extract({path}, '([^/]+?)(\\\\.[^./]*)?$', 1)"


def land_dat(files: DataFrame) -> DataFrame:
    """Machine 2 rows with ``error`` (the file) and ``cell_error`` (the line)."""
    return DAT.parse_dat(files, name_col="file_stem" if "file_stem" in files.columns else None)


@dataclass
class Landed:
    """Landed files, parsed once and written: rows, and what is kept out."""

    sheet: DataFrame
    dat: DataFrame

    def sheet_rows(self) -> DataFrame:
        return DAT.whole_files(self.sheet.filter(F.col("row_no").isNotNull() | F.col("error").isNotNull())).select(
            "table_name", *SHEET_COLUMNS)

    def dat_rows(self) -> DataFrame:
        """The line number stands in for a record id."""
        return DAT.dat_rows_from_files(DAT.whole_files(self.dat)).select(
            "table_name", F.col("line_no").cast("bigint").alias("record_id"), "timestamp",
            *DAT_MEASURES, *DAT_HEADER_FIELDS)

    def quarantine(self) -> DataFrame:
        """Files of either kind that could not be read whole, with the reason."""
        return DAT.broken_files(self.dat).unionByName(DAT.broken_files(self.sheet))


def land(dat_files: DataFrame, sheet_files: DataFrame) -> Landed:
    out = run_concurrently({"sheet": lambda: stage(land_sheets(sheet_files), "landed_sheet"),
                            "dat": lambda: stage(land_dat(dat_files), "landed_dat")})
    return Landed(**out)


def metadata_rows_from_files(files: DataFrame) -> DataFrame:
    """A9 + C16: the first sheet of the metadata workbooks, empty cells as ''."""
    rows = SH.read_sheets(files, METADATA_COLUMNS, sheet_name=None, fill_text="")
    return rows.filter(F.col("error").isNull()).select(*METADATA_COLUMNS)


def build_warehouse(dat_files: DataFrame, sheet_files: DataFrame, metadata_files: DataFrame | None = None,
                    publish_root: str | None = None, metadata_lookup: str = "full",
                    landed: Landed | None = None, existing: dict[str, DataFrame] | None = None) -> Star:
    """Ingest the landed files, build the star schema and (optionally) publish it.
    Files are loaded whole or not at all; pass ``landed`` to report those kept
    out. With ``existing`` tables the files are a further load (``update_star``)."""
    landed = landed or land(dat_files, sheet_files)
    meta = metadata_rows_from_files(metadata_files) if metadata_files is not None else None
    rows = landed.sheet_rows(), landed.dat_rows(), meta
    star = update_star(existing, *rows, metadata_lookup=metadata_lookup) if existing else \
        build_star(*rows, metadata_lookup=metadata_lookup)
    if publish_root:
        publish(star.tables(), publish_root)
    return star
