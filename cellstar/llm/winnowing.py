"""Winnowing: document fingerprints with a match guarantee.

Every ``k`` consecutive code points are hashed by a rolling polynomial; of
every ``w`` consecutive hashes the smallest is chosen, the rightmost on ties.
Any passage of at least ``w + k - 1`` code points that two texts share
therefore gives them a common fingerprint entry. A text of fewer than ``k``
code points is hashed whole (the empty text has no entry), one of fewer than
``w`` hashes is a single window. The positions of the chosen hashes are kept:
a fingerprint is the hexadecimal text of (position step, hash) pairs, a step
of at most ``w`` in two digits and the hash in eight.

``compare_neighbours`` needs each document beside the next one in descending
``doc_id``. Documents are dealt to ranges of ``doc_id`` (cut points: a bounded
number of approximate quantiles), the last document of each range is also
sent to the range above it as a guest, and every range is then read in order,
one document held at a time. Rows that share an id are ordered by their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstar.llm.common import documents, lean, mix64, partitions, sliding_min

K = 16
W = 64
_BASE = 0x9E3779B97F4A7C15
#: Standing of a null doc_id in the order: before all ids.
NULL_ID = -(1 << 63)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def rolling_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """32-bit hashes of all ``k`` consecutive code points, as uint64."""
    h = mix64(points.astype(np.uint64) + np.uint64(1))
    have, power = 1, _BASE
    while have < k:  # a window of have + step points from two of have points
        step = min(have, k - have)
        tail = pow(_BASE, step, 1 << 64)
        if step == have:
            h = h[:-step] * np.uint64(power) + h[step:]
        else:  # overlapping windows still make a function of the k points
            h = h[:-step] * np.uint64(tail) + (h[step:] ^ (h[step:] >> np.uint64(7)))
        have += step
        power = pow(_BASE, have, 1 << 64)
    return mix64(h) >> np.uint64(32)


def winnow(points: np.ndarray, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of a text's fingerprint."""
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    if n < k:
        whole = hashlib.blake2b(points.tobytes(), digest_size=4).digest()
        return np.zeros(1, np.int64), np.frombuffer(whole, "<u4").copy()
    low = np.uint64(0xFFFFFFFF)
    at = np.arange(n - k + 1, dtype=np.uint64)
    keys = (rolling_hashes(points, k) << np.uint64(32)) | (low - at)  # of equal hashes the rightmost is smallest
    keys = sliding_min(keys, min(w, len(keys)))
    keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))]
    return (low - (keys & low)).astype(np.int64), (keys >> np.uint64(32)).astype(np.uint32)


def encode(positions: np.ndarray, hashes: np.ndarray) -> str:
    out = np.empty((len(hashes), 5), np.uint8)
    out[:, 0] = np.diff(positions, prepend=0)
    out[:, 1:] = hashes.astype(">u4").view(np.uint8).reshape(-1, 4)
    return out.tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two fingerprints' hash sets; two empty ones are alike.
    Both arrays hold sorted distinct values."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """doc_id, n_chars, positions and hashes of every document's fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = [winnow(code_points(t), k, w) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(len, texts), pa.int64()),
                 pa.array([p for p, _ in found], pa.list_(pa.int64())),
                 pa.array([h.astype(np.int64) for _, h in found], pa.list_(pa.int64()))],
                ["doc_id", "n_chars", "positions", "hashes"])

    return documents(docs).mapInArrow(lean(run), "doc_id long, n_chars long, positions array<long>, hashes array<long>")


def compare_neighbours(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and both likenesses.

    The edited text replaces the last third by the beginning of the next
    document. A single document is its own next one; an empty table gives no row.
    """
    spark = docs.sparkSession
    data = documents(docs)
    parts = partitions(spark)
    ids = data.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"))
    cuts = ids.select(F.percentile_approx("id", [i / parts for i in range(1, parts)], 10 * parts)).first()[0] \
        if parts > 1 else []
    cuts = np.array(sorted(set(cuts or [])), np.int64)

    def deal(last_of: dict[int, list[int]] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pack = zstandard.ZstdCompressor(level=1).compress
            for batch in batches:
                own = batch.column("doc_id").fill_null(NULL_ID).to_numpy(zero_copy_only=False)
                bucket = np.searchsorted(cuts, own, side="right")
                if last_of is None:
                    yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(own)], ["bucket", "id"])
                    continue
                rows, to, guest = [], [], []
                for i, (b, x) in enumerate(zip(bucket.tolist(), own.tolist())):
                    rows.append(i), to.append(b), guest.append(False)
                    for other in last_of.get(x, ()):
                        rows.append(i), to.append(other), guest.append(True)
                texts = batch.column("text").to_pylist()
                packed = [pack(t.encode("utf-8", "surrogatepass")) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to, pa.int32()), pa.array(guest), batch.column("doc_id").take(pa.array(rows)),
                     pa.array([packed[i] for i in rows], pa.binary())], ["bucket", "guest", "doc_id", "packed"])
        return run

    # the largest id of every range (one row a range) and the range above it that it visits
    tops = ids.withColumnRenamed("id", "doc_id").mapInArrow(lean(deal(None)), "bucket int, id long") \
        .groupBy("bucket").agg(F.max("id").alias("id")).orderBy("bucket").collect()
    last_of: dict[int, list[int]] = {}
    for i, top in enumerate(tops):
        last_of.setdefault(top.id, []).append(tops[(i + 1) % len(tops)].bucket)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        bucket, before = None, None
        for batch in batches:
            out = []
            for b, guest, doc_id, packed in zip(*(c.to_pylist() for c in batch.columns)):
                raw = unpack(packed)
                text = raw.decode("utf-8", "surrogatepass")
                points = code_points(text)
                at, hashes = winnow(points, k, w)
                this = (text, np.unique(hashes))
                if b != bucket:
                    bucket, before = b, None
                if guest:  # of rows that share the id, the last in order stays
                    before = this
                    continue
                next_text, next_set = before or this
                m = len(text) // 3
                edited = text[:len(text) - m] + next_text[:m]
                e_at, e_hashes = winnow(code_points(edited), k, w)
                out.append((doc_id, len(text),
                            hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                            encode(at, hashes), encode(e_at, e_hashes),
                            likeness(this[1], np.unique(e_hashes)), likeness(this[1], next_set)))
                before = this
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*out), (
                        pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))],
                    ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                     "near_next"])

    dealt = data.mapInArrow(lean(deal(last_of)), "bucket int, guest boolean, doc_id long, packed binary")
    return (dealt.repartition(parts, "bucket")
            .sortWithinPartitions("bucket", F.desc("guest"), F.col("doc_id").asc_nulls_first(), "packed")
            .mapInArrow(lean(read), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                              "edited_fingerprint string, near_edited double, near_next double"))
