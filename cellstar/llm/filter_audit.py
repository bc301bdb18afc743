"""Audit of five filters in all 120 orders, by difference arrays over Lehmer ranks.

Every document has the set of filters it fails, a mask of five bits. For one
mask and step, the orders in which just that step removes the document are those
that begin with filters it passes and go on with one it fails; orders of one
beginning are neighbours in lexicographic (Lehmer) rank. So a mask's count is
added where such an interval begins and taken off where it ends, once for all
documents of the mask, and a prefix sum over the 120 ranks yields every order's
removals.

Filters, on whole texts (null: empty): A under 200 words; B distinct words below
half of the words; C more than 2 percent capitals A-Z; D a sign of ``#$%&*|``;
E a text that a smaller doc_id has too. A null doc_id is smaller than all
others; rows that share an id don't make each other fail E. ``labels`` count
where any row of the doc_id says 1; a null id has none. A null source is the part
``''``. No documents, no rows. DataFrame functions only.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellstar.llm.common import documents

FILTERS = "ABCDE"
#: Limits of the filters A, B and C (fixed values).
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2
ORDERS = ["".join(p) for p in permutations(FILTERS)]
_SUMS = ("n", "good", "toxic")


def intervals() -> list[tuple[int, int, int, int]]:
    """(mask, step, rank, sign): where a mask's removals in a step begin and end."""
    out = []
    for mask in range(1, 1 << len(FILTERS)):
        fails = {f for i, f in enumerate(FILTERS) if mask >> i & 1}
        for step in range(1, len(FILTERS) + 1):
            start = None
            for rank, order in enumerate([*ORDERS, None]):
                here = order is not None and order[step - 1] in fails and not fails & set(order[:step - 1])
                if here and start is None:
                    out.append((mask, step, rank, 1))
                    start = rank
                elif not here and start is not None:
                    if rank < len(ORDERS):
                        out.append((mask, step, rank, -1))
                    start = None
    return out


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by source and failed filters."""
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    small = F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    rows = documents(docs, F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"))
    rows = rows.select("doc_id", "part", F.sha2("text", 256).alias("digest"), words.alias("w"),
                       F.length("text").alias("chars"), (F.length("text") - small).alias("capitals"),
                       F.col("text").rlike(r"[#$%&*|]").alias("signs"))
    failed = {"A": F.size("w") < LEAST_WORDS,
              "B": 100 * F.size(F.array_distinct("w")) < LEAST_DISTINCT * F.size("w"),
              "C": 100 * F.col("capitals") > MOST_CAPITALS * F.col("chars"), "D": F.col("signs")}
    mask = sum((F.when(c, 1 << FILTERS.index(f)).otherwise(0) for f, c in failed.items()), F.lit(0))
    rows = rows.select("doc_id", "part", "digest", mask.alias("mask"))

    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *(F.max(F.coalesce(F.col(c).cast("int") == 1, F.lit(False)).cast("int")).alias(m)
          for c, m in (("quality", "good"), ("toxic", "toxic"))))
    rows = rows.join(marks, "doc_id", "left").na.fill(0, ["good", "toxic"])

    # of equal texts all but those of the least id fail E: copies are added up before any of them meet
    kind = ("digest", "mask", "part", "good", "toxic")
    same_id = rows.groupBy("doc_id", *kind).agg(F.count("*").alias("n"))
    texts = same_id.groupBy(*kind).agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("least"))
    # a null id sorts first in a struct
    texts = texts.withColumn("first", F.min("least.doc_id").over(Window.partitionBy("digest"))) \
        .withColumn("none", F.max(F.col("least.doc_id").isNull()).over(Window.partitionBy("digest")))
    passing = F.when(F.col("none"), F.col("least.doc_id").isNull()).otherwise(F.col("least.doc_id") == F.col("first"))
    kept = F.when(passing, F.col("least.n")).otherwise(F.lit(0))
    both = texts.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), kept.alias("n")),
        F.struct((F.col("mask") + (1 << FILTERS.index("E"))).alias("mask"), (F.col("n") - kept).alias("n")))).alias("m"))
    return both.groupBy("part", F.col("m.mask").alias("mask")).agg(
        F.sum("m.n").alias("n"), F.sum(F.col("m.n") * F.col("good")).alias("good"),
        F.sum(F.col("m.n") * F.col("toxic")).alias("toxic")).filter("n > 0")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley: 600 rows a part."""
    spark = docs.sparkSession
    counts = masks(docs, labels)
    # the same few hundred rows, whatever the input
    ends = F.broadcast(spark.createDataFrame(intervals(), "mask int, step int, rank int, sign int"))
    differences = counts.join(ends, "mask").select(
        "part", "rank", "step", *((F.col(c) * F.col("sign")).alias(c) for c in _SUMS),
        *(F.lit(None).cast("long").alias(c) for c in ("total", "fails", "alone")))

    letters = [(f, 1 << i) for i, f in enumerate(FILTERS)]
    totals = counts.groupBy("part").agg(
        F.sum("n").alias("total"),
        *(F.sum(F.when(F.col("mask").bitwiseAND(bit) != 0, F.col("n")).otherwise(0)).alias(f"fails_{f}")
          for f, bit in letters),
        *(F.sum(F.when(F.col("mask") == bit, F.col("n")).otherwise(0)).alias(f"alone_{f}") for f, bit in letters))
    order = F.element_at(F.array(*map(F.lit, ORDERS)), F.col("rank") + 1)
    letter = F.substr(order, F.col("step"), F.lit(1))
    one_of = lambda name: F.coalesce(*(F.when(letter == f, F.col(f"{name}_{f}")) for f, _ in letters))
    cells = totals.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(len(ORDERS) - 1)))) \
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))) \
        .select("part", "rank", "step", *(F.lit(0).cast("long").alias(c) for c in _SUMS), "total",
                one_of("fails").alias("fails"), one_of("alone").alias("alone"))

    grid = differences.unionByName(cells).groupBy("part", "rank", "step").agg(
        *(F.sum(c).alias(c) for c in _SUMS), *(F.max(c).alias(c) for c in ("total", "fails", "alone")))
    upto = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    grid = grid.select("part", "rank", "step", "total", "fails", "alone", *(F.sum(c).over(upto).alias(c) for c in _SUMS))
    steps = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    grid = grid.withColumn("gone", F.sum("n").over(steps)).withColumn("letter", letter).withColumn("order", order)
    return grid.select(
        "part", F.col("order").alias("filter_order"), "step", (F.col("total") - F.col("gone")).alias("kept"),
        F.col("n").alias("removed"), (F.col("fails") - F.col("n")).alias("redundant"),
        F.col("alone").alias("unique_fails"), F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(Window.partitionBy("part", "letter")).alias("shapley"))
