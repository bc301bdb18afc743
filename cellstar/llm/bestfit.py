"""Conflict-constrained best-fit packing of documents into fixed-size bins.

A document is as long as it has words; one longer than a bin is cut into full
bins and a rest. No bin holds two pieces of one source, nor two of one
duplicate cluster (unless a cluster is given, documents whose words are equal
but for A-Z form one). Bins carry their sources and clusters as one bitmap and
are ordered by residual: the search takes the least residual that is large
enough, and goes on to the next ones until a bin without a conflict is found,
so each piece goes to the tightest compatible bin (longest pieces first). A
tree over the residuals keeps the bits that all bins below a node share, and
skips what conflicts altogether.

Pieces are dealt to shards by a hash of the document and the number of its copy,
so that every shard gets its portion of a hot source, a large cluster, or a row
that repeats very often; a shard of bounded size is packed by itself, and
all shards in parallel. A null source or cluster conflicts with nothing; a null
or empty text has length 0 and takes no room. Rows that repeat a document are
documents of their own, in one cluster.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellstar.llm.common import bytes_of, documents, lean, mix64, partitions, schema, stage, text_chunks
from cellstar.llm.shingles import word_hashes

CAPACITY = 2048
#: Pieces a shard has on average.
SHARD_PIECES = 8192


class Bins:
    """Open bins by residual, each with a bitmap."""

    def __init__(self, capacity: int):
        self.size = 1
        while self.size <= capacity:
            self.size *= 2
        self.open: list[dict[int, list[int]]] = [{} for _ in range(capacity + 1)]   # residual -> bitmap -> bins
        self.shared = [-1] * (2 * self.size)   # bits that all bins below a node have; -1: no bins, or all bits

    def _update(self, residual: int) -> None:
        bits = -1
        for b in self.open[residual]:
            bits &= b
        at = residual + self.size
        self.shared[at] = bits
        while at > 1:
            at //= 2
            self.shared[at] = self.shared[2 * at] & self.shared[2 * at + 1]

    def add(self, residual: int, bits: int, number: int) -> None:
        held = self.open[residual].setdefault(bits, [])
        heapq.heappush(held, number)
        if len(held) == 1:
            self._update(residual)

    def take(self, length: int, mask: int) -> tuple[int, int, int] | None:
        """Remove and return the tightest bin that has room and no bit of ``mask``."""
        residual = self._next(length, mask)
        while residual is not None:
            held = self.open[residual]
            fit = min((numbers[0], bits) for bits, numbers in held.items() if not bits & mask) \
                if any(not bits & mask for bits in held) else None
            if fit:   # of equal residuals the bin that was opened first
                number, bits = heapq.heappop(held[fit[1]]), fit[1]
                if not held[bits]:
                    del held[bits]
                    self._update(residual)
                return residual, bits, number
            residual = self._next(residual + 1, mask)
        return None

    def _next(self, start: int, mask: int) -> int | None:
        """Least residual >= start whose bins don't all share a bit of ``mask``."""
        if start >= len(self.open):
            return None
        shared, at = self.shared, start + self.size
        while True:
            one = shared[at]
            if one != -1 and not one & mask:
                while at < self.size:   # go down, left first
                    at *= 2
                    if shared[at] == -1 or shared[at] & mask:
                        at += 1
                return at - self.size
            while at & 1:   # go up until there is a right sibling
                at //= 2
            if at == 0:
                return None
            at += 1


def pack_shard(length: list[int], source: list, cluster: list, capacity: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of every piece, given longest first."""
    source_bit: dict = {}
    seen: dict = {}
    for c in cluster:
        seen[c] = seen.get(c, 0) + 1
    for s in source:
        if s is not None:
            source_bit.setdefault(s, 1 << len(source_bit))
    cluster_bit: dict = {}
    for c, k in seen.items():
        if c is not None and k > 1:   # a single one has nothing to conflict with
            cluster_bit[c] = 1 << (len(source_bit) + len(cluster_bit))
    bins, made = Bins(capacity), 0
    number, offset = [], []
    for n, s, c in zip(length, source, cluster):
        mask = source_bit.get(s, 0) | cluster_bit.get(c, 0)
        found = bins.take(n, mask)
        if found is None:
            found = capacity, 0, made
            made += 1
        residual, bits, b = found
        number.append(b)
        offset.append(capacity - residual)
        bins.add(residual - n, bits | mask, b)
    return number, offset


def lengths(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, words, digest of the words, and the columns kept."""
    data = documents(docs, *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_chunks(batch):
                raw, ends = bytes_of(batch.column("text").slice(a, b - a))
                text, h = word_hashes(raw, ends)
                n = np.bincount(text, minlength=b - a)
                place = np.arange(len(h)) - np.concatenate(([0], np.cumsum(n)))[text]
                digest = np.zeros(b - a, np.uint64)
                np.add.at(digest, text, mix64(h ^ mix64(place.astype(np.uint64))))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n.astype(np.int64)),
                     pa.array(mix64(digest + n.astype(np.uint64)).view(np.int64)), *(part.column(k) for k in keep)],
                    ["doc_id", "n_words", "digest", *keep])

    return data.mapInArrow(lean(run), schema("doc_id long, n_words long, digest long", data.schema.fields[2:]))


def number_copies(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copy``, 1 upwards among those of one (doc_id, digest). Copies
    are numbered in each written file by themselves and the files' numbers added
    up, so no task holds all copies of a row."""
    staged = stage(rows, "lengths")
    key = [F.coalesce("doc_id", F.lit(0)).alias("id_"), F.col("doc_id").isNull().alias("none_"), "digest"]
    placed = staged.select("*", *key[:2], F.col("_metadata.file_name").alias("file_"),
                           F.col("_metadata.row_index").alias("row_"))
    own = Window.partitionBy("id_", "none_", "digest", "file_")
    placed = placed.withColumn("copy", F.row_number().over(own.orderBy("row_")))
    counts = placed.groupBy("id_", "none_", "digest", "file_").agg(F.count("*").alias("k"))
    before = Window.partitionBy("id_", "none_", "digest").orderBy("file_").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("k").over(before), F.lit(0))).filter("before > 0").drop("k")
    return placed.join(counts, ["id_", "none_", "digest", "file_"], "left").select(
        *rows.columns, (F.col("copy") + F.coalesce("before", F.lit(0))).alias("copy"))


def pack(docs: DataFrame, capacity: int = CAPACITY, cluster: str | None = None,
         shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """doc_id, piece, start_word, n_words, source, cluster, bin, offset of every piece.

    ``bin`` is a text: the shard and the bin's number in it; full bins of a long
    document are numbered by the document, and by the copy where rows repeat it.
    """
    keep = ("source",) + ((cluster,) if cluster else ())
    data = lengths(docs, *keep)
    data = data.withColumn("source", F.col("source").cast("string")).withColumn(
        "cluster", F.col(cluster).cast("long") if cluster else F.col("digest"))
    cut = number_copies(data).withColumn("full", F.expr(f"cast(n_words div {capacity} as int)"))
    rest = cut.withColumn("rest", F.col("n_words") % capacity)
    full = rest.filter("full > 0").select(
        "doc_id", F.explode(F.expr("sequence(0, full - 1)")).alias("piece"), "source", "cluster", "digest", "copy").select(
        "doc_id", "piece", (F.col("piece").cast("long") * capacity).alias("start_word"),
        F.lit(capacity).cast("long").alias("n_words"), "source", "cluster",
        F.concat_ws("-", F.lit("full"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")),
                    F.hex("digest"), F.col("copy"), F.col("piece")).alias("bin"), F.lit(0).cast("long").alias("offset"))
    small = rest.filter("rest > 0 or full = 0").select(
        "doc_id", F.col("full").alias("piece"), (F.col("full").cast("long") * capacity).alias("start_word"),
        F.col("rest").alias("n_words"), "source", "cluster", "digest", "copy")
    rows = docs.count()
    shards = max(1, -(-rows // shard_pieces))
    # dealt by the document itself, not by its source or cluster
    small = small.withColumn("shard", F.pmod(F.xxhash64("doc_id", "digest", "copy"), F.lit(shards)).cast("int"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_words", "doc_id", "digest"], ascending=[False, True, True], kind="stable",
                              na_position="first")
        bins, offset = pack_shard(pdf["n_words"].tolist(), pdf["source"].where(pdf["source"].notna(), None).tolist(),
                                  [None if pd.isna(c) else c for c in pdf["cluster"]], capacity)
        shard = pdf["shard"].iloc[0]
        return pdf.assign(bin=[f"{shard}-{b}" for b in bins], offset=offset)[
            ["doc_id", "piece", "start_word", "n_words", "source", "cluster", "bin", "offset"]]

    kinds = "doc_id long, piece int, start_word long, n_words long, source string, cluster long, bin string, offset long"
    packed = small.repartition(max(partitions(docs.sparkSession), 1), "shard").groupBy("shard").applyInPandas(one, kinds)
    return packed.unionByName(full)
