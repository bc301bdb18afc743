"""Fact-to-dimension key resolution as joins.

The reference runs 6-7 point SELECTs per fact row. Here every lookup is one
equi-join. A dimension is broadcast only after its row count is checked
against ``max_broadcast_rows``; a larger one is joined by shuffle, and AQE may
still turn that into a broadcast once it sees the real size.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstar.operators.keys import known_rows, remember_rows

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20

# Planning widths (bytes) per type, for the broadcast size estimate.
_WIDTH = {"string": 24, "binary": 64, "bigint": 8, "int": 4, "smallint": 2, "tinyint": 1, "double": 8,
          "float": 4, "boolean": 1, "date": 4, "timestamp": 8, "timestamp_ntz": 8}


def row_width(df: DataFrame) -> int:
    """Estimated bytes per row of ``df`` (fixed widths; 24 for a text value)."""
    total = 0
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        total += 16 if t.startswith("decimal") else _WIDTH.get(t, 32)
    return total + 8


def is_small(dim: DataFrame, rows: int, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
             max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    return rows <= max_rows and rows * row_width(dim) <= max_bytes


def broadcast_if_small(dim: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                       rows: int | None = None, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint behind a size check: the row count recorded when the
    dimension was keyed (else a count of the, usually staged, dimension) and
    the estimated bytes of the broadcast columns must both be under the
    limits. Above them the join is left to a shuffle (and to AQE)."""
    n = rows if rows is not None else known_rows(dim)
    if n is None:
        n = dim.count()
    return F.broadcast(dim) if is_small(dim, n, max_rows, max_bytes) else dim


@dataclass
class Lookup:
    """One key lookup: ``fact[fact_cols] -> dim[dim_cols]`` giving ``dim[key_col]``.

    mode: ``strict`` (inner join; the fact row must find its member),
    ``optional`` (left join, NULL when absent), ``first`` (left join to the
    lowest key per lookup value, for a non-unique lookup column), ``null_safe``
    (left join with ``<=>`` on every column).
    """

    dim: DataFrame
    key_col: str
    fact_cols: list[str]
    dim_cols: list[str] | None = None
    mode: str = "strict"
    broadcast: bool | None = None   # None: decide by size check
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS
    out_col: str | None = None
    extra: dict = field(default_factory=dict)

    def _columns(self) -> DataFrame:
        dim_cols = self.dim_cols or self.fact_cols
        d = self.dim.select(self.key_col, *dim_cols)
        if self.mode == "first":
            d = d.groupBy(*dim_cols).agg(F.min(self.key_col).alias(self.key_col))
        return d.select(F.col(self.key_col).alias(self.out_col or self.key_col),
                        *[F.col(c).alias(f"__lk_{i}") for i, c in enumerate(dim_cols)])

    def is_broadcast(self) -> bool:
        if self.broadcast is not None:
            return self.broadcast
        n = known_rows(self.dim)
        if n is None:
            n = self.dim.count()
            remember_rows(self.dim, n)
        return is_small(self._columns(), n, self.max_broadcast_rows)

    def right(self) -> DataFrame:
        return F.broadcast(self._columns()) if self.is_broadcast() else self._columns()


def small_lookups(lookups: list[Lookup]) -> tuple[list[Lookup], list[Lookup]]:
    """The lookups whose dimension is broadcast, and those that shuffle the fact."""
    small, large = [], []
    for lookup in lookups:
        (small if lookup.is_broadcast() else large).append(lookup)
    return small, large


def resolve(fact: DataFrame, lookup: Lookup) -> DataFrame:
    right = lookup.right()
    pairs = [(fact[c], right[f"__lk_{i}"]) for i, c in enumerate(lookup.fact_cols)]
    if lookup.mode == "null_safe":
        cond = reduce(lambda a, b: a & b, [l.eqNullSafe(r) for l, r in pairs])
    else:
        cond = reduce(lambda a, b: a & b, [l == r for l, r in pairs])
    how = "inner" if lookup.mode == "strict" else "left"
    joined = fact.join(right, cond, how)
    return joined.drop(*[f"__lk_{i}" for i in range(len(lookup.fact_cols))])


def resolve_keys(fact: DataFrame, lookups: list[Lookup]) -> DataFrame:
    """Apply the lookups in order; each adds one key column."""
    return reduce(resolve, lookups, fact)
