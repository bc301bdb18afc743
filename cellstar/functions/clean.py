"""Column expressions for cleaning and typing readings (all JVM-side built-ins).

Every function takes and returns a ``Column`` so callers compose them inside a
single ``select`` and the whole expression stays in one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType

# Fixed values that must equal the instruments' conventions.
MISSING_TEXT = "NAN"                 # text the instruments write for a missing value
TIME_KEY_FORMAT = "HH:mm:ss.SSSSSS"  # time of day at microsecond grain (TIME in the schema)
MEASUREMENT_DATA_MARKER = "Measurement Data:"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def q(name: str) -> str:
    """Quote a column name for a SQL expression."""
    return "`" + name.replace("`", "``") + "`"


# Helpers given a column *name* build one SQL expression (parsed JVM-side in a
# single call); given a Column they compose Column objects. Same plan either way.

def nan_to_null_sql(name: str, dtype: DataType | None = None) -> str:
    c = q(name)
    if isinstance(dtype, StringType):
        return f"CASE WHEN {c} IS NULL OR {c} = '{MISSING_TEXT}' THEN NULL ELSE {c} END"
    if isinstance(dtype, (DoubleType, FloatType)):
        return f"CASE WHEN {c} IS NULL OR isnan({c}) THEN NULL ELSE {c} END"
    return c


def nan_to_null(c, dtype: DataType | None = None) -> Column:
    """C4: the text ``NAN``, a float NaN, and NULL all become NULL.

    ``dtype`` is the column's type when known: a text column is compared with
    ``NAN``, a floating column is tested with ``isnan``.
    """
    if isinstance(c, str):
        return F.expr(nan_to_null_sql(c, dtype))
    if isinstance(dtype, StringType):
        return F.when(c.isNull() | (c == F.lit(MISSING_TEXT)), F.lit(None)).otherwise(c)
    if isinstance(dtype, (DoubleType, FloatType)):
        return F.when(c.isNull() | F.isnan(c), F.lit(None)).otherwise(c)
    return c


def to_decimal_sql(name: str, precision: int, scale: int, dtype: DataType | None = StringType()) -> str:
    return f"CAST({nan_to_null_sql(name, dtype)} AS DECIMAL({precision},{scale}))"


def to_decimal(c, precision: int, scale: int, dtype: DataType | None = StringType()) -> Column:
    """C4 + C5: missing rule, then an ANSI decimal cast (a value that does not
    fit raises, as the typed target table would)."""
    if isinstance(c, str):
        return F.expr(to_decimal_sql(c, precision, scale, dtype))
    return nan_to_null(c, dtype).cast(f"decimal({precision},{scale})")


def round_half_up(c, scale: int = 4) -> Column:
    """Round to ``scale`` places, ties away from zero."""
    return F.round(_col(c), scale)


def milliamp_to_amp(c, dtype: DataType | None = DoubleType()) -> Column:
    """mA -> A as a double division, then the (10,4) decimal of the fact."""
    if isinstance(c, str):
        v = nan_to_null_sql(c, dtype)
        if isinstance(dtype, StringType):
            v = f"CAST({v} AS DOUBLE)"
        return F.expr(f"CAST({v} / 1000D AS DECIMAL(10,4))")
    c = nan_to_null(c, dtype)
    if isinstance(dtype, StringType):
        c = c.cast("double")
    return (c / F.lit(1000.0)).cast("decimal(10,4)")


def date_of(ts) -> Column:
    """Calendar date of a timestamp."""
    return F.expr(f"to_date({q(ts)})") if isinstance(ts, str) else F.to_date(ts)


def time_key(ts) -> Column:
    """Time of day, microseconds kept, as the ``HH:mm:ss.SSSSSS`` text key."""
    if isinstance(ts, str):
        return F.expr(f"date_format({q(ts)}, '{TIME_KEY_FORMAT}')")
    return F.date_format(ts, TIME_KEY_FORMAT)


def measurement_name(table_name) -> Column:
    """The part of a table / file name before the first ``_``."""
    if isinstance(table_name, str):
        return F.expr(f"substring_index({q(table_name)}, '_', 1)")
    return F.substring_index(table_name, "_", 1)


def machine_digit(table_name) -> Column:
    """Machine id = first character of the table name."""
    if isinstance(table_name, str):
        return F.expr(f"substring({q(table_name)}, 1, 1)")
    return F.substring(table_name, 1, 1)


def machine_name(table_name) -> Column:
    """``machine_<digit>``; the machine type carries the same text."""
    if isinstance(table_name, str):
        return F.expr(f"concat('machine_', substring({q(table_name)}, 1, 1))")
    return F.concat(F.lit("machine_"), machine_digit(table_name))


def starts_with_digit(name) -> Column:
    """First character is a digit."""
    return _col(name).rlike("^[0-9]")


def path_stem(path) -> Column:
    """C17: file name without folder and without the last extension."""
    return F.regexp_extract(_col(path), r"([^/]+?)(\.[^./]*)?$", 1)


def path_folder(path) -> Column:
    """C17: name of the folder that holds the file (``machine_1`` ...)."""
    return F.regexp_extract(_col(path), r"([^/]+)/[^/]+$", 1)


def path_extension(path) -> Column:
    """Lower-case extension with its dot, '' when there is none."""
    return F.lower(F.regexp_extract(_col(path), r"[^/]*?(\.[^./]*)$", 1))


def table_name_of(path) -> Column:
    """C17 + C20: ``<stem>_table`` with dots turned into underscores."""
    return F.concat(F.translate(path_stem(path), ".", "_"), F.lit("_table"))


def fill_text(df, value: str = ""):
    """Fill NULLs with ``value`` in text columns only."""
    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.fillna(value, subset=text_cols) if text_cols else df
