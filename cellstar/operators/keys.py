"""Dense consecutive keys without a single-task window.

``row_number() over (order by k)`` with no partition runs in one task. Here the
rows are range-partitioned on the order columns, sorted inside each partition
and written once to a staging folder below ``spark.checkpoint.dir``. Each
written file holds one contiguous key range and file names follow partition
order, so a row's key is

    base + (rows in earlier files) + (row index inside its file) + 1

The per-file counts are one small aggregate (one row per file). Reading the
staged files back also cuts the lineage: a lost executor re-reads files
instead of recomputing the shuffle, and every re-read sees the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstar.session import scratch_dir


def next_key(dim: DataFrame | None, key_col: str) -> int:
    """``coalesce(max(key), 0)`` of an existing table (0 when absent)."""
    if dim is None:
        return 0
    return int(dim.agg(F.coalesce(F.max(key_col), F.lit(0)).alias("m")).first()["m"])


def stage(df: DataFrame, name: str, partitions: int | None = None,
          order_by: list[str] | None = None, then: Callable[[DataFrame], DataFrame] | None = None,
          keep: list[str] | None = None) -> DataFrame:
    """Write ``df`` to a fresh folder in the shared scratch area and read it back.

    With ``order_by``, ``then`` adds columns after the rows are dealt by range:
    the sample that finds the ranges runs all that comes before. It must keep
    each row in its partition (broadcast joins do). Only ``keep`` is written."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    out = df
    if order_by:
        # Without an explicit count AQE sizes the range partitions from the data
        # (merging neighbours keeps the key order); ``partitions`` pins it.
        ranged = df.repartitionByRange(partitions, *order_by) if partitions else df.repartitionByRange(*order_by)
        out = (then(ranged) if then else ranged).sortWithinPartitions(*order_by)
    if keep:
        out = out.select(*keep)
    out.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def dense_keys(df: DataFrame, order_by: list[str], key_col: str, base: int = 0,
               name: str = "keys", partitions: int | None = None,
               then: Callable[[DataFrame], DataFrame] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Number the rows of ``df`` 1..n (plus ``base``) in ``order_by`` order.

    Equal to ``base + row_number() over (order by order_by)``; ties in the
    order columns are broken by the written order, so give a total order.
    ``then`` and ``keep`` as in ``stage``; a row that ``then`` drops takes no number.
    """
    staged = stage(df, name, partitions, order_by, then, keep)
    with_pos = staged.select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    counts = with_pos.groupBy("_file").count().collect()  # one row per staged file
    files = sorted(counts, key=lambda r: _file_order(r["_file"]))
    if not files:
        return remember_rows(
            staged.select(F.lit(None).cast("bigint").alias(key_col), *staged.columns).where(F.lit(False)), 0)
    starts = [s + base for s in [0] + list(accumulate(r["count"] for r in files))[:-1]]
    total = sum(r["count"] for r in files)
    # offsets: one row per staged file, a local relation (no job of its own at each use)
    offsets = df.sparkSession.createDataFrame(pa.table({
        "_file": pa.array([r["_file"] for r in files], pa.string()), "_offset": pa.array(starts, pa.int64())}))
    key = (F.col("_offset") + F.col("_row") + F.lit(1)).cast("bigint")
    from cellstar.operators.lookup import broadcast_if_small
    out = with_pos.join(broadcast_if_small(offsets, rows=len(files)), "_file").select(key.alias(key_col), *staged.columns)
    return remember_rows(out, total)


_PART = re.compile(r"part-(\d+)(?:-.*?-c(\d+))?")


def _file_order(name: str) -> tuple:
    """Write order of a staged file: task partition number, then the file
    counter inside the task (``part-00012-<uuid>-c001``). Numeric, so
    ``part-100000`` follows ``part-99999``."""
    m = _PART.search(name)
    if not m:
        return (float("inf"), 0, name)
    return (int(m.group(1)), int(m.group(2) or 0), name)


def remember_rows(df: DataFrame, n: int | None) -> DataFrame:
    """Attach a known row count so size checks need no extra job (None: not known)."""
    if n is not None:
        df._cellstar_rows = int(n)
    return df


def known_rows(df: DataFrame) -> int | None:
    return getattr(df, "_cellstar_rows", None)
