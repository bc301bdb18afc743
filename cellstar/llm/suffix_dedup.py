"""Exact removal of repeated passages by sharded suffix sorting.

Every byte that lies in a ``length``-byte string which also starts earlier
(smaller doc_id, or earlier in the same document) is removed; strings are
judged on the input. Texts are UTF-8 bytes, and matches stay within documents.

1. Every window of ``length`` bytes has a minimiser: its ``GRAM``-byte substring
   of least hash, the leftmost on ties. Successive windows that share one are a
   segment. Equal windows have equal minimisers, so a window can only repeat
   between segments whose minimisers are equal, and these meet by that hash.
2. Of segments that are equal throughout, all but the earliest are removed
   without looking further (first inside each worker, so that thousands of
   copies don't travel); a minimiser left with one segment is done.
3. The others are cut out of their documents, dealt to shards by minimiser, and
   every shard's suffixes are sorted by external induced sorting
   (``induced.py``); in each group of equal windows the earliest stays.
   A minimiser with more than ``HOT`` different segments (the edge of a passage
   that very many documents share) is not sorted in one shard: its segments'
   windows meet one by one as in step 2, which spreads them.
4. The removed spans meet their documents.

What a worker holds doesn't follow the input: Spark orders a task's rows by
bucket or minimiser, on disk if need be, and a worker takes one bucket, or whole
minimisers of some ``RUN`` bytes, at a time.

A null or empty text has no windows and stays as it is. A row repeated with
its id and text gets its twin's result (a string doesn't start earlier than
itself). Rows that share an id, or have none, with different texts are documents
of their own, in the order of their texts' digests; those without an id are first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellstar.llm.common import (bytes_of, documents, lean, mix64, offsets_of, partitions, schema, sliding_min, stage,
                                 text_chunks)
from cellstar.llm.induced import equal_windows
from cellstar.llm.shingles import _BASE, _INVERSE, powers

LENGTH = 100
GRAM = 32
#: Different segments of one minimiser beyond which windows meet singly.
HOT = 5_000
#: Segments gathered in a worker before they are sent.
FLUSH = 200_000
#: Segments packed in one row at most; an Arrow batch holds many such rows.
PACKED = 1_000
#: Segments of one bucket held in a worker before those that are settled, or hot, leave.
HELD = 400_000
#: Bytes of whole minimisers whose suffixes are sorted together; one minimiser has 5,000 segments of 168 at most.
RUN = 1 << 20
#: Bytes of segments sent on in one batch.
CUT = 1 << 22
NULL_ID = -(1 << 63)
#: Texts are cut into windows in slices of at most so many bytes.
SLICE = 1 << 18

_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
# a document is its id and its text's digest (ver); a text has less than 2 GB
_ROW = np.dtype([("m", "<u8"), ("dig", "<u8"), ("doc", "<i8"), ("ver", "<i8"), ("start", "<u4"), ("n", "u1")])


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all ``gram`` consecutive bytes (a power of two)."""
    h, have = _VALUE[raw], 1
    while have < gram:
        h = h[:-have] * np.uint64(pow(_BASE, have, 1 << 64)) + h[have:]
        have *= 2
    return mix64(h)


def segments(raw: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """(text index, start in text, windows, minimiser, digest) of the segments
    of the texts raw[ends[i]:ends[i+1]]; at most SLICE bytes in all."""
    n = len(raw)
    if n < length:
        return [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2
    h = gram_hashes(raw, gram)
    low = np.uint64((1 << 21) - 1)
    best = sliding_min((h & ~low) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
    at = (best & low).astype(np.int64)      # of each window's minimiser
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))[:n - length + 1]
    valid = np.zeros(n - length + 1, bool)
    for a, b in zip(ends[:-1].tolist(), (ends[1:] - length + 1).tolist()):
        if a < b:
            valid[a:b] = True
    start = valid.copy()
    start[1:] &= (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(start)
    stop = np.concatenate((first[1:], [len(valid)]))
    # a text's windows end `length` bytes before it does
    stop = np.minimum(stop, ends[text[first] + 1] - length + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_VALUE[raw] * powers(_BASE, n))))
    windows = stop - first
    digest = mix64((total[stop + length - 1] - total[first]) * powers(_INVERSE, n)[first] + windows.astype(np.uint64))
    return text[first], first - ends[text[first]], windows, h[at[first]], digest


def slices(batch: pa.RecordBatch, length: int):
    """(first row, start of the slice in its text, bytes, ends) of a batch: whole
    texts together, or overlapping slices of one long text."""
    for a, b in text_chunks(batch, limit=SLICE):
        raw, ends = bytes_of(batch.column("text").slice(a, b - a))
        if len(raw) <= SLICE:
            yield a, 0, raw, ends
            continue
        for s in range(0, len(raw) - length + 1, SLICE - length + 1):
            part = raw[s:s + SLICE]
            yield a, s, part, np.array([0, len(part)])


def settle(rows: np.ndarray):
    """Of rows sorted by (m, dig, doc, ver, start): which is the first of its equal
    segments, and which ones start later than that."""
    new = np.ones(len(rows), bool)
    new[1:] = (rows["m"][1:] != rows["m"][:-1]) | (rows["dig"][1:] != rows["dig"][:-1])
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = np.zeros(len(rows), bool)
    for f in ("doc", "ver", "start"):
        later |= rows[f] != rows[f][lead]
    return new, later


def ordered(rows: np.ndarray) -> np.ndarray:
    """Rows by (m, dig, doc, ver, start); only rows that share m are compared by more."""
    rows = rows[np.argsort(rows["m"])]
    same = rows["m"][1:] == rows["m"][:-1]
    many = np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same))) if len(rows) else same
    part = rows[many]
    rows[many] = part[np.lexsort((part["start"], part["ver"], part["doc"], part["dig"], part["m"]))]
    return rows


_FOUND = "doc long, ver long, start long, n int, m long, kind int"   # kind 0: remove; 1: sort in a shard; 2: meet singly
_SENT = "bucket int, rows binary, doc long, ver long, start long, n int, m long, kind int"
_NAMES = [x.split()[0] for x in _SENT.split(", ")]


def _found(rows: np.ndarray, kind: np.ndarray | int, length: int) -> pa.RecordBatch:
    kind = np.broadcast_to(np.asarray(kind, np.int32), len(rows))
    n = rows["n"].astype(np.int32) + np.where(kind == 0, length - 1, 0).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary()), pa.array(rows["doc"].copy()),
         pa.array(rows["ver"].copy()), pa.array(rows["start"].astype(np.int64)), pa.array(n), pa.array(rows["m"].copy().view(np.int64)), pa.array(kind.copy())],
        _NAMES)


class Sender:
    """Gathers segments; removes local repeats and packs the rest by bucket."""

    def __init__(self, buckets: int, length: int, packed: int):
        self.buckets, self.length, self.packed, self.parts, self.held = np.uint64(buckets), length, packed, [], 0

    def add(self, doc, ver, start, n, m, dig) -> None:
        rows = np.empty(len(start), _ROW)
        rows["doc"], rows["ver"], rows["start"], rows["n"], rows["m"], rows["dig"] = doc, ver, start, n, m, dig
        self.parts.append(rows)
        self.held += len(rows)

    def flush(self) -> Iterator[pa.RecordBatch]:
        rows = ordered(np.concatenate(self.parts))
        self.parts, self.held = [], 0
        first, later = settle(rows)
        if later.any():
            yield _found(rows[later], 0, self.length)
        rows = rows[first]
        bucket = (rows["m"] % self.buckets).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        rows, bucket = rows[order], bucket[order]
        new = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        new = np.concatenate([np.arange(a, b, self.packed) for a, b in zip(new, [*new[1:], len(rows)])])
        edge = np.concatenate((new, [len(rows)]))
        packed = [b"".join(rows[a:b][f].tobytes() for f in _ROW.names) for a, b in zip(edge[:-1], edge[1:])]
        k = len(packed)
        if k:
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[edge[:-1]]), pa.array(packed, pa.binary()), pa.nulls(k, pa.int64()),
                 pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()),
                 pa.nulls(k, pa.int32())],
                _NAMES)


def _unpack(blob: pa.Buffer) -> np.ndarray:
    n = blob.size // _ROW.itemsize
    rows, at = np.empty(n, _ROW), 0
    for f in _ROW.names:
        kind = _ROW[f]
        rows[f] = np.frombuffer(blob, kind, n, at)
        at += n * kind.itemsize
    return rows


class Bucket:
    """The segments of one bucket: repeats leave as they are found, and so do hot
    minimisers, of which the first ``hot`` segments tell."""

    def __init__(self, length: int, hot: int, least: int):
        self.length, self.many, self.least, self.parts, self.held = length, hot, least, [], 0
        self.most, self.hot = least, np.zeros(0, np.uint64)   # hot: the minimisers found to be so

    def add(self, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(rows)
        self.held += len(rows)
        if self.held > self.most:
            rows, size = yield from self._settled()
            hot = size > self.many
            yield from self._send(rows[hot], 2)
            self.hot = np.union1d(self.hot, rows["m"][hot])
            self.parts, self.held = [rows[~hot]], int((~hot).sum())
            self.most = max(self.least, 2 * self.held)

    def end(self) -> Iterator[pa.RecordBatch]:
        rows, size = yield from self._settled()
        rows, size = rows[size > 1], size[size > 1]
        yield from self._send(rows, np.where(size > self.many, 2, 1))

    def _settled(self):
        """What stays of the segments held, and how many of each minimiser."""
        rows = np.concatenate(self.parts)
        self.parts = []
        if len(self.hot):
            hot = np.isin(rows["m"], self.hot)
            yield from self._send(rows[hot], 2)
            rows = rows[~hot]
        rows = ordered(rows)
        first, later = settle(rows)
        yield from self._send(rows[later], 0)
        rows = rows[first]
        new = np.ones(len(rows), bool)
        new[1:] = rows["m"][1:] != rows["m"][:-1]
        group = np.cumsum(new) - 1
        return rows, np.bincount(group)[group] if len(rows) else group

    def _send(self, rows: np.ndarray, kind: np.ndarray | int) -> Iterator[pa.RecordBatch]:
        kind = np.broadcast_to(np.asarray(kind, np.int32), len(rows))
        for a in range(0, len(rows), 50_000):
            yield _found(rows[a:a + 50_000], kind[a:a + 50_000], self.length).select(_NAMES[2:])


def meet(sent: DataFrame, parts: int, length: int) -> DataFrame:
    """Equal segments against the earliest; what is left of shared minimisers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            blobs = batch.column("rows")
            done = batch.filter(blobs.is_null())
            if done.num_rows:
                yield done.select(_NAMES[2:])
            for bucket, blob in zip(batch.column("bucket").drop_null().to_pylist(), blobs.drop_null()):
                if bucket != at:
                    if held:
                        yield from held.end()
                    at, held = bucket, Bucket(length, HOT, HELD)
                yield from held.add(_unpack(blob.as_buffer()))
        if held:
            yield from held.end()

    # what is settled travels with the bucketless rows, spread by document
    key = F.coalesce("bucket", F.pmod(F.xxhash64("doc", "ver", "start"), F.lit(1 << 20)).cast("int"))
    return sent.repartition(parts, key).sortWithinPartitions("bucket").mapInArrow(lean(run), _FOUND)


def found_segments(docs: DataFrame, length: int, gram: int) -> DataFrame:
    parts = partitions(docs.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sender(4 * parts, length, PACKED)
        for batch in batches:
            ids = batch.column("doc_id").fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            ver = batch.column("ver").to_numpy(zero_copy_only=False)
            for a, shift, raw, ends in slices(batch, length):
                text, start, n, m, dig = segments(raw, ends, length, gram)
                out.add(ids[a + text], ver[a + text], start + shift, n, m, dig)
                if out.held >= FLUSH:
                    yield from out.flush()
        if out.held:
            yield from out.flush()

    return meet(versions(documents(docs)).mapInArrow(lean(send), _SENT), parts, length)


def versions(data: DataFrame) -> DataFrame:
    """``data`` with its texts' digests, which tell the rows of one id, or of none, apart."""
    return data.withColumn("ver", F.xxhash64("text"))


@F.pandas_udf(T.StringType())
def whole_characters(kept: pd.Series) -> pd.Series:
    """Bytes as text, without what is left of characters cut in two."""
    return kept.map(lambda b: bytes(b).decode("utf-8", "ignore"))


def _cut_out(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The compressed texts of documents beside their wanted segments."""
    lists = wanted.groupBy("doc", "ver").agg(F.collect_list(F.struct("start", "n", "m")).alias("segments"))
    return (lists.join(docs, (lists.doc == docs.key) & (lists.ver == docs.ver))
            .select("doc", lists.ver, "z", "segments"))


def single_windows(cut: DataFrame, parts: int, length: int) -> DataFrame:
    """Hot minimisers' windows, each a segment of its own with its own hash."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sender(4 * parts, length, PACKED)
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for doc, ver, z, found in zip(*(c.to_pylist() for c in batch.columns)):
                text = unpack(z)
                at, key = [], []
                for s in found:
                    for i in range(s["start"], s["start"] + s["n"]):
                        at.append(i)
                        key.append(hashlib.blake2b(text[i:i + length], digest_size=16).digest())
                both = np.frombuffer(b"".join(key), "<u8").reshape(-1, 2)
                out.add(doc, ver, at, 1, both[:, 0], both[:, 1])
                if out.held >= FLUSH:
                    yield from out.flush()
        if out.held:
            yield from out.flush()

    return meet(cut.mapInArrow(lean(send), _SENT), parts, length).filter("kind = 0")


def whole_minimisers(batches: Iterator[pa.RecordBatch], enough: int) -> Iterator[list[pa.RecordBatch]]:
    """Rows in order of (m, doc, ver, start), each once, in runs of whole
    minimisers that end as soon as they have ``enough`` bytes."""
    held, size, last = [], 0, None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("m", "doc", "ver", "start")], 1)
        if not len(keys):
            continue
        # a row repeated with its id and text has sent its twin's segments
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]).any(1)
        fresh[0] = last is None or bool((keys[0] != last).any())
        m = keys[:, 0]
        new = np.ones(len(m), bool)
        new[1:] = m[1:] != m[:-1]
        new[0] = last is None or m[0] != last[0]
        last = keys[-1].copy()
        if not fresh.all():
            batch, new = batch.filter(pa.array(fresh)), new[fresh]
            if not batch.num_rows:
                continue
        ends, a = offsets_of(batch.column("bytes")), 0
        for b in np.flatnonzero(new).tolist():
            if size + ends[b] - ends[a] >= enough:
                yield held + [batch.slice(a, b - a)]
                held, size, a = [], 0, b
        held.append(batch.slice(a))
        size += int(ends[-1] - ends[a])
    if held:
        yield held


def sorted_shards(cut: DataFrame, parts: int, length: int) -> DataFrame:
    """Repeats among the segments that share minimisers, by suffix sorting."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            if not batch.num_rows:
                continue
            found = batch.column("segments")
            m, start, n = (found.flatten().field(f) for f in ("m", "start", "n"))
            first, stop = start.to_pylist(), (start.to_numpy() + n.to_numpy() + length - 1).tolist()
            edge = found.offsets.to_numpy()
            doc, ver = (np.repeat(batch.column(c).to_numpy(), np.diff(edge)) for c in ("doc", "ver"))
            edge = (edge - edge[0]).tolist()
            parts, a, held = [], 0, 0
            for i, z in enumerate(batch.column("z")):
                text = unpack(z.as_buffer())
                for k in range(edge[i], edge[i + 1]):
                    parts.append(text[first[k]:stop[k]])
                    held += len(parts[-1])
                    if held >= CUT or k == edge[-1] - 1:
                        b = k + 1
                        yield pa.RecordBatch.from_arrays(
                            [m[a:b], pa.array(doc[a:b]), pa.array(ver[a:b]), start[a:b], n[a:b],
                             pa.array(parts, pa.binary())], ["m", "doc", "ver", "start", "n", "bytes"])
                        parts, a, held = [], b, 0

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in whole_minimisers(batches, RUN):
            yield from sort_run(run)

    def sort_run(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, vers, starts, counts, sizes, texts = [], [], [], [], [], []
        for batch in batches:
            docs.append(batch.column("doc").to_numpy())
            vers.append(batch.column("ver").to_numpy())
            starts.append(batch.column("start").to_numpy())
            counts.append(batch.column("n").to_numpy().astype(np.int64))
            raw, ends = bytes_of(batch.column("bytes"))
            texts.append(raw)
            sizes.append(np.diff(ends))
        doc, ver, start, n, size = map(np.concatenate, (docs, vers, starts, counts, sizes))
        text = np.concatenate(texts)
        del docs, vers, starts, counts, sizes, texts
        begin = np.concatenate(([0], np.cumsum(size)))[:-1]
        n = np.minimum(n, size - length + 1)   # windows that lie in the slice
        held: list[np.ndarray] = []   # one group's positions so far, its earliest window first

        def later(pos: np.ndarray, group: np.ndarray):
            """Windows that start later than the first of their group."""
            seg = np.searchsorted(begin, pos, side="right") - 1
            off = pos - begin[seg]
            real = off < n[seg]
            d, v, s, g = doc[seg[real]], ver[seg[real]], start[seg[real]] + off[real], group[real]
            order = np.lexsort((s, v, d, g))
            d, v, s, g = d[order], v[order], s[order], g[order]
            new = np.ones(len(g), bool)
            new[1:] = g[1:] != g[:-1]
            lead = np.flatnonzero(new)[np.cumsum(new) - 1] if len(g) else new.astype(int)
            out = (d != d[lead]) | (v != v[lead]) | (s != s[lead])
            return d[out], v[out], s[out]

        flat: list[tuple[np.ndarray, np.ndarray]] = []
        waiting_p, waiting_g = [], []
        for pos, group in equal_windows(text, length):
            level = group < 0
            if level.any():
                flat.append((pos[level], group[level]))
                pos, group = pos[~level], group[~level]
            if not len(pos):
                continue
            # a group may go on in the next block: its last positions wait
            whole = np.flatnonzero(group != group[-1])
            cut = int(whole[-1]) + 1 if len(whole) else 0
            if cut:
                waiting_p.append(pos[:cut])
                waiting_g.append(group[:cut])
                yield _spans(*later(np.concatenate(waiting_p), np.concatenate(waiting_g)), length)
                waiting_p, waiting_g = [pos[cut:]], [group[cut:]]
            else:
                waiting_p.append(pos)
                waiting_g.append(group)
        if waiting_p:
            yield _spans(*later(np.concatenate(waiting_p), np.concatenate(waiting_g)), length)
        if flat:
            yield _spans(*later(*(np.concatenate(x) for x in zip(*flat))), length)

    return (cut.mapInArrow(lean(send), "m long, doc long, ver long, start long, n int, bytes binary")
            .repartition(parts, "m").sortWithinPartitions("m", "doc", "ver", "start").mapInArrow(lean(sort), _FOUND))


def _spans(doc: np.ndarray, ver: np.ndarray, start: np.ndarray, length: int) -> pa.RecordBatch:
    """Removed windows, those that touch in one document joined."""
    order = np.lexsort((start, ver, doc))
    doc, ver, start = doc[order], ver[order], start[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (ver[1:] != ver[:-1]) | (start[1:] > start[:-1] + length)
    a = np.flatnonzero(new)
    b = np.concatenate((a[1:], [len(doc)])) - 1 if len(a) else a
    k = len(a)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[a]), pa.array(ver[a]), pa.array(start[a]), pa.array((start[b] + length - start[a]).astype(np.int32)),
         pa.nulls(k, pa.int64()), pa.array(np.zeros(k, np.int32))], _NAMES[2:])


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, kept (binary: the bytes left), n_bytes, n_removed, n_spans and
    the columns named in ``keep`` of every row."""
    parts = partitions(docs.sparkSession)
    data = documents(docs, *keep)
    found = stage(found_segments(data, length, gram), "segments")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = pa.array([z(t.encode("utf-8", "surrogatepass")) for t in batch.column("text").to_pylist()],
                             pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("doc_id").fill_null(NULL_ID), batch.column("ver"), texts,
                 *batch.columns[2:-1]], ["doc_id", "key", "ver", "z", *batch.schema.names[2:-1]])

    extra = data.schema.fields[2:]
    packed = versions(data).mapInArrow(lean(pack), schema("doc_id long, key long, ver long, z binary", extra))
    texts = packed.select("key", "ver", "z")
    removed = (found.filter("kind = 0").select("doc", "ver", "start", "n")
               .union(sorted_shards(_cut_out(texts, found.filter("kind = 1")), parts, length)
                      .select("doc", "ver", "start", "n")))
    if found.filter("kind = 2").limit(1).count():
        removed = removed.union(single_windows(_cut_out(texts, found.filter("kind = 2")), parts, length)
                                .select("doc", "ver", "start", "n"))
    spans = removed.groupBy("doc", "ver").agg(F.collect_list(F.struct("start", "n")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for z, found in zip(batch.column("z").to_pylist(), batch.column("spans").to_pylist()):
                text = unpack(z)
                kept, at, runs = [], 0, 0
                for s in sorted((s["start"], s["start"] + s["n"]) for s in found or ()):
                    a, b = s[0], min(s[1], len(text))
                    if a >= b:
                        continue
                    if a > at or not runs:
                        kept.append(text[at:a])
                        runs += 1
                    at = max(at, b)
                kept.append(text[at:])
                kept = b"".join(kept)
                rows.append((kept, len(text), len(text) - len(kept), runs))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(list(cols[0]), pa.binary()),
                 *(pa.array(list(c), pa.int64()) for c in cols[1:]), *(batch.column(k) for k in keep)],
                ["doc_id", "kept", "n_bytes", "n_removed", "n_spans", *keep])

    return (packed.join(spans, (packed.key == spans.doc) & (packed.ver == spans.ver), "left").select("doc_id", "z", "spans", *keep)
            .mapInArrow(lean(cut), schema("doc_id long, kept binary, n_bytes long, n_removed long, n_spans long", extra)))
