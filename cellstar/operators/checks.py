"""Constraints as checks (K1-K6).

Spark enforces no keys, so every constraint of the typed schema is a query
that reports violations: one small aggregate per rule, unioned into a report.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def check_unique(tables: dict[str, DataFrame], keys: dict[str, list[list[str]]]) -> DataFrame:
    """K1/K2: per (table, key columns): rows, distinct keys, keys seen more than once.

    All key sets of a table are counted in one pass with GROUPING SETS (one
    scan and one shuffle per table, partial counts before the shuffle).
    """
    parts = []
    for t, key_sets in keys.items():
        df = tables[t]
        cols = list(dict.fromkeys(c for ks in key_sets for c in ks))  # order of first appearance
        sets = ", ".join("(" + ", ".join(f"`{c}`" for c in ks) + ")" for ks in key_sets)
        gid = {_grouping_id(cols, ks): ",".join(ks) for ks in key_sets}
        counted = df.sparkSession.sql(
            f"SELECT grouping_id({', '.join(f'`{c}`' for c in cols)}) AS _gid, count(1) AS _n "
            f"FROM {{t}} GROUP BY GROUPING SETS ({sets})", t=df)
        label = F.create_map(*[x for g, name in gid.items() for x in (F.lit(g), F.lit(name))])
        parts.append(counted.groupBy("_gid").agg(
            F.sum("_n").cast("bigint").alias("n_rows"),
            F.count(F.lit(1)).alias("n_keys"),
            F.count_if(F.col("_n") > 1).alias("n_duplicate_keys"))
            .select(F.lit(t).alias("table_name"), F.element_at(label, F.col("_gid")).alias("key_columns"),
                    "n_rows", "n_keys", "n_duplicate_keys"))
    return _union(parts)


def _grouping_id(cols: list[str], present: list[str]) -> int:
    """grouping_id() of a grouping set: bit i (from the left) set when cols[i] is absent."""
    n = len(cols)
    return sum(1 << (n - 1 - i) for i, c in enumerate(cols) if c not in present)


def check_not_null(tables: dict[str, DataFrame], columns: dict[str, list[str]]) -> DataFrame:
    """K3: NULL count of every NOT NULL column, one pass per table."""
    parts = []
    for t, cols in columns.items():
        agg = tables[t].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null"))
                                    for c in cols]))
        parts.append(agg.select(F.lit(t).alias("table_name"), stack.alias("s"))
                     .select("table_name", "s.column_name", "s.n_null"))
    return _union(parts)


def check_foreign_keys(tables: dict[str, DataFrame],
                       fks: list[tuple[str, str, str, str]]) -> DataFrame:
    """K4: rows of a fact whose (non-NULL) reference has no dimension row.

    One pass per fact: each referenced key set is left-joined (broadcast when
    its size check passes) and all unmatched references are counted in one
    aggregate, instead of one anti join -- and one fact scan -- per key.
    """
    from cellstar.operators.keys import known_rows
    from cellstar.operators.lookup import broadcast_if_small
    by_fact: dict[str, list[tuple[int, str, str, str]]] = {}
    for i, (fact, col, dim, dim_col) in enumerate(fks):
        by_fact.setdefault(fact, []).append((i, col, dim, dim_col))
    parts = []
    for fact, refs in by_fact.items():
        f = tables[fact].select(*{col for _, col, _, _ in refs})
        for i, col, dim, dim_col in refs:
            # unique by K1; the table's known size spares a count
            keys = tables[dim].select(F.col(dim_col).alias(f"_k{i}"), F.lit(True).alias(f"_hit{i}"))
            f = f.join(broadcast_if_small(keys, rows=known_rows(tables[dim])), f[col] == keys[f"_k{i}"], "left").drop(f"_k{i}")
        counts = f.agg(*[F.count_if(F.col(col).isNotNull() & F.col(f"_hit{i}").isNull()).alias(f"_m{i}")
                         for i, col, _, _ in refs])
        stack = F.explode(F.array(*[F.struct(F.lit(col).alias("column_name"), F.lit(dim).alias("referenced_table"),
                                             F.col(f"_m{i}").alias("n_missing")) for i, col, dim, _ in refs]))
        parts.append(counts.select(F.lit(fact).alias("table_name"), stack.alias("s"))
                     .select("table_name", "s.column_name", "s.referenced_table", "s.n_missing"))
    return _union(parts)


def check_dense_keys(tables: dict[str, DataFrame], keys: dict[str, str]) -> DataFrame:
    """K1 for whole-number keys without moving the keys: per table its rows,
    distinct keys, keys seen more than once, greatest key and the numbers from 1
    up to it that no row has.

    A bucket is 32,768 consecutive numbers; its bitmap and its row count are made
    where the rows lie, so what is shuffled is one row a bucket and task (for
    keys that were numbered in file order: a row a bucket, 4 kB for 32,768 keys).
    Only buckets with more rows than bits hold a repeated key, and only their
    rows are counted by key. A missing (null) key is one key, as in
    ``check_unique``; numbers below 1 count as keys, not towards ``n_missing``.
    """
    from cellstar.operators.keys import stage
    from cellstar.operators.lookup import broadcast_if_small
    parts = []
    for t, c in keys.items():
        rows = tables[t].select(F.col(c).cast("bigint").alias("k"))
        rows = rows.withColumn("bucket", F.bitmap_bucket_number("k"))
        bits = F.bitmap_construct_agg(F.bitmap_bit_position(F.coalesce("k", F.lit(1))))
        positive = F.bitmap_construct_agg(F.bitmap_bit_position(F.when(F.col("k") >= 1, F.col("k"))))
        buckets = stage(rows.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("n"), bits.alias("bits"), positive.alias("positive"), F.max("k").alias("top"))
            .select("bucket", "n", F.bitmap_count("bits").alias("n_keys"), F.bitmap_count("positive").alias("n_positive"),
                    "top"), "key_buckets")
        suspect = buckets.filter("n > n_keys").select("bucket")
        n_suspect = suspect.count()
        counted = buckets.select("n", "n_keys", "n_positive", "top", F.lit(0).cast("bigint").alias("twice"))
        if n_suspect:
            repeated = (rows.join(broadcast_if_small(suspect, rows=n_suspect), rows.bucket.eqNullSafe(suspect.bucket),
                                  "left_semi").groupBy("k").count().filter("count > 1"))
            none = F.lit(0).cast("bigint")
            counted = counted.unionByName(repeated.select(
                none.alias("n"), none.alias("n_keys"), none.alias("n_positive"), F.lit(None).cast("bigint").alias("top"),
                F.lit(1).cast("bigint").alias("twice")))
        top = F.coalesce(F.max("top"), F.lit(0))
        parts.append(counted.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("n_keys"), F.lit(0)).alias("n_keys"),
            F.coalesce(F.sum("twice"), F.lit(0)).alias("n_duplicate_keys"), top.alias("max_key"),
            (F.greatest(top, F.lit(0)) - F.coalesce(F.sum("n_positive"), F.lit(0))).alias("n_missing"))
            .select(F.lit(t).alias("table_name"), F.lit(c).alias("key_column"), "*"))
    return _union(parts)


def check_references(tables: dict[str, DataFrame], fks: list[tuple[str, str, str, str]]) -> DataFrame:
    """K4 with one shuffle of keys, however many foreign keys and facts: the
    report of ``check_foreign_keys`` without a join.

    Every table sends rows of (reference, key), counted where they lie -- a key
    that a third of the fact has is one row a task -- facts with their count,
    dimensions with a mark. One aggregation settles which keys no dimension row
    marked; the sums by reference that follow are a row a reference and task. A
    fact is read once for all its references.
    """
    spark = next(iter(tables.values())).sparkSession

    def tagged(t: str, refs: list[tuple[int, str]], n: int, hit: bool) -> DataFrame:
        each = F.explode(F.array(*[F.struct(F.lit(i).alias("ref"), F.col(c).cast("string").alias("key")) for i, c in refs]))
        return (tables[t].select(each.alias("x")).filter(F.col("x.key").isNotNull())
                .select("x.ref", "x.key", F.lit(n).cast("bigint").alias("n"), F.lit(hit).alias("hit")))

    facts: dict[str, list[tuple[int, str]]] = {}
    dims: dict[str, list[tuple[int, str]]] = {}
    for i, (fact, col, dim, dim_col) in enumerate(fks):
        facts.setdefault(fact, []).append((i, col))
        dims.setdefault(dim, []).append((i, dim_col))
    settled = _union([*(tagged(t, refs, 1, False) for t, refs in facts.items()),
                      *(tagged(t, refs, 0, True) for t, refs in dims.items())]).groupBy("ref", "key").agg(
        F.sum("n").alias("n"), F.max("hit").alias("hit"))
    missing = settled.groupBy("ref").agg(F.sum(F.when(~F.col("hit"), F.col("n")).otherwise(0)).alias("n_missing"))
    names = spark.createDataFrame([(i, f, c, d) for i, (f, c, d, _) in enumerate(fks)],
                                  "ref int, table_name string, column_name string, referenced_table string")
    return (names.join(missing, "ref", "left")
            .select("table_name", "column_name", "referenced_table",
                    F.coalesce("n_missing", F.lit(0)).cast("bigint").alias("n_missing")))


def check_lengths(tables: dict[str, DataFrame], limits: dict[str, dict[str, int]]) -> DataFrame:
    """K5: longest text and count over the declared VARCHAR length."""
    parts = []
    for t, cols in limits.items():
        agg = tables[t].agg(*[F.struct(F.max(F.length(c)).cast("bigint").alias("max_length"),
                                       F.count_if(F.length(c) > n).alias("n_over")).alias(c)
                              for c, n in cols.items()])
        stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(n).alias("limit"),
                                             F.col(f"{c}.max_length").alias("max_length"),
                                             F.col(f"{c}.n_over").alias("n_over"))
                                    for c, n in cols.items()]))
        parts.append(agg.select(F.lit(t).alias("table_name"), stack.alias("s"))
                     .select("table_name", "s.*"))
    return _union(parts)


def check_decimal_range(rows: DataFrame, columns: list[str], targets: list[tuple[int, int]]) -> DataFrame:
    """K6: text values (not missing) that do not fit a decimal(p,s) target --
    the rows an ANSI load would fail on."""
    aggs = []
    for c in columns:
        text = F.col(c).cast("string")
        present = text.isNotNull() & (text != "NAN")
        for p, s in targets:
            aggs.append(F.count_if(present & text.try_cast(f"decimal({p},{s})").isNull())
                        .alias(f"{c}__{p}_{s}"))
    agg = rows.agg(*aggs)
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(f"decimal({p},{s})").alias("target"),
                 F.col(f"{c}__{p}_{s}").alias("n_out_of_range"))
        for c in columns for p, s in targets]))
    return agg.select(stack.alias("s")).select("s.*")
