"""Jaccard similarity join by parity sketches.

A set of ``n`` shingles toggles one bit a shingle in a sketch of ``p`` parts,
so the Hamming distance of two sketches never exceeds the sets' symmetric
difference. Sets are dealt to size bands of ratio 1/threshold; a pair at or
above the threshold lies in one band or two adjoining ones, and the band fixes
the largest symmetric difference T such a pair can have. With p = T + 1 + slack
parts, at least slack + 1 parts of the two sketches are equal: every set joins
on (band, part, the part's bits) in its own band's scheme and in the one below.

The slack lets a set leave out parts that say little: its empty parts, and its
parts shared with very many sets (a passage common to a third of all documents
fills such parts), as long as it has no more of them than the slack; then an
equal part remains that both sets of a linked pair use.

Equal sets are one node from the start. Sharing a part makes candidates:

1. a star for each part: its sets against the one that shares the most parts;
   pairs are verified exactly and linked sets merge into components;
2. only where a part's sets still lie in several components, the pairs across
   components are looked at, block against block: the Hamming distance of their
   whole sketches drops nearly all pairs below the threshold without a row being
   made of them, and the others are verified too.

So no link between different texts is lost, and components cost about one
verification a copy. The number of links is counted afterwards: links stay within
components, so a component's sets meet block against block, where the sizes of all
intersections come from products of incidence matrices; only a sum a set leaves a
pair of blocks, no pairs are written. Signatures travel in packed arrays; a worker
keeps one set of each part it has met often and reports the rest at once, so
a part of a third of all sets doesn't reach one task whole.

All this runs on nodes, which ids take no part in; each node carries the text of
one of its rows, and a component's id is the least one of all its rows.

A null or empty text has an empty set, linked with nothing; its component is
its own id. A row repeated with the same id and text changes nothing; rows that
share an id with different texts are documents of their own. A row without an id
takes the component of its set, null where no row of the component has an id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstar.llm.common import bytes_of, documents, drop_staged, lean, mix64, partitions, stage, text_chunks
from cellstar.llm.shingles import shingle_sets

#: Bits of a sketch's part. A part is held as the exclusive or of its set bits'
#: codes, so a wide one costs nothing, and parts of one or two shingles differ.
PART_BITS = 1 << 16
#: A part that more sets share may be left out.
COMMON = 64
#: Sets that one block of a part's sets holds, when blocks are compared.
BLOCK = 2048
#: Signatures gathered in a worker before they are packed and sent.
FLUSH = 400_000
#: Sets, and shingles, of one block of a component when its links are counted.
COUNT_SETS, COUNT_SHINGLES = 4096, 1 << 20
#: A shingle in so many pairs of two blocks at most is counted pair by pair; the
#: others' columns are multiplied so many at a time.
RARE, COLUMNS = 4096, 2048
#: Pairs verified by one task's group: the sets against one centre.
CENTRE_GROUP = 256
#: Low bits of a node in transit: from the scheme below; already reported.
BELOW, REPORTED = 1, 2


class Bands:
    """Size bands for a threshold of ``percent``/100."""

    def __init__(self, percent: int, largest: int):
        starts = [1]
        while starts[-1] <= largest:
            starts.append(starts[-1] * 100 // percent + 1)
        starts.append(starts[-1] * 100 // percent + 1)
        self.starts = np.array(starts, np.int64)
        small = self.starts[1:] - 1            # the band's largest set ...
        large = small * 100 // percent         # ... and the largest that it can link with
        self.most = (100 - percent) * (small + large) // (100 + percent)   # symmetric difference
        self.slack = 4 + self.most // 16

    def of(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, n, side="right") - 1

    def parts(self, band: np.ndarray) -> np.ndarray:
        """0 where only equal sets link."""
        return np.where(self.most[band] > 0, self.most[band] + 1 + self.slack[band], 0)


def set_digest(text: np.ndarray, h: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(size, node) of every text's set; a node's low bits are free."""
    n = np.bincount(text, minlength=texts).astype(np.int64)
    a, b = np.zeros(texts, np.uint64), np.zeros(texts, np.uint64)
    np.add.at(a, text, mix64(h ^ np.uint64(0x5851F42D4C957F2D)))
    np.bitwise_xor.at(b, text, h)
    return n, mix64(a ^ mix64(b + n.astype(np.uint64))) & ~np.uint64(3)


def signatures(text: np.ndarray, h: np.ndarray, n: np.ndarray, bands: Bands, below: bool):
    """(text, key) of the parts that the texts join on in one scheme, and each
    text's number of parts that may still be left out."""
    band = bands.of(np.maximum(n, 1)) - below
    parts = np.where((n > 0) & (band >= 0), bands.parts(np.maximum(band, 0)), 0)
    slack = bands.slack[np.maximum(band, 0)]
    first = np.concatenate(([0], np.cumsum(parts)))
    use = parts[text] > 0
    t, x = text[use], h[use]
    width = (parts[t] * PART_BITS).astype(np.uint64)
    bit = ((x >> np.uint64(32)) * width) >> np.uint64(32)
    at = first[t] + (bit // np.uint64(PART_BITS)).astype(np.int64)
    bits = np.zeros(first[-1], np.uint64)
    np.bitwise_xor.at(bits, at, mix64(bit + np.uint64(1)))   # the exclusive or of bits' codes stands for the part's bits
    owner = np.repeat(np.arange(len(n)), parts)
    number = np.arange(first[-1]) - first[owner]
    empty = np.bincount(owner[bits == 0], minlength=len(n))
    key = mix64(bits ^ mix64((band[owner].astype(np.uint64) << np.uint64(32)) + number.astype(np.uint64)))
    keep = (bits != 0) | (empty > slack)[owner]
    return owner[keep], key[keep], np.where(parts > 0, np.maximum(slack - empty, 0), 0)


def _chunks(batch: pa.RecordBatch, width: int):
    """(first row, texts, shingles' text index, shingles' hashes) by chunks of a batch."""
    for a, b in text_chunks(batch):
        raw, ends = bytes_of(batch.column("text").slice(a, b - a))
        yield a, b - a, *shingle_sets(raw, ends, width)


def with_row_key(docs: DataFrame) -> DataFrame:
    """doc_id, text, and (row_id, twin), which equal texts of one id share."""
    return documents(docs).select("doc_id", "text", F.coalesce("doc_id", F.lit(-1 << 63)).alias("row_id"),
                                  F.xxhash64("text").alias("twin"))


def describe(docs: DataFrame, bands: Bands, width: int) -> DataFrame:
    """doc_id, row key, n_shingles, node and what each scheme may leave out, by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, k, text, h in _chunks(batch, width):
                n, node = set_digest(text, h, k)
                spare = [signatures(text, h, n, bands, below)[2] for below in (False, True)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(a, k) for c in ("doc_id", "row_id", "twin")), pa.array(n),
                     pa.array(node.view(np.int64)), *(pa.array(s, pa.int32()) for s in spare)],
                    ["doc_id", "row_id", "twin", "n_shingles", "node", "spare", "spare_below"])

    return with_row_key(docs).mapInArrow(lean(run), "doc_id long, row_id long, twin long, n_shingles long, node long, "
                                                    "spare int, spare_below int")


def shared_parts(docs: DataFrame, bands: Bands, width: int) -> DataFrame:
    """(key, node) for every part that at least two different sets share."""
    parts = partitions(docs.sparkSession)
    buckets = np.uint64(4 * parts)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes, held = [], [], 0

        def flush():
            nonlocal keys, nodes, held
            key, node = np.concatenate(keys), np.concatenate(nodes)
            keys, nodes, held = [], [], 0
            bucket = (key >> np.uint64(32)) % buckets
            key &= np.uint64(0xFFFFFFFF)
            order = np.lexsort((node, key, bucket))
            bucket, key, node = bucket[order], key[order], node[order]
            same = (bucket[1:] == bucket[:-1]) & (key[1:] == key[:-1])
            new = np.concatenate(([True], ~(same & (node[1:] == node[:-1]))))  # copies of a set count once
            bucket, key, node = bucket[new], key[new], node[new]
            same = np.concatenate(([False], (bucket[1:] == bucket[:-1]) & (key[1:] == key[:-1])))
            many = same | np.concatenate((same[1:], [False]))
            node[many] |= np.uint64(REPORTED)   # all of a shared part's sets are reported from here, the first goes on
            edge = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
            out = [(int(bucket[a]), key[a:b][~same[a:b]].astype("<u4").tobytes(), node[a:b][~same[a:b]].tobytes(),
                    key[a:b][many[a:b]].astype("<u4").tobytes(), node[a:b][many[a:b]].tobytes())
                   for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*out), (pa.int32(), *[pa.binary()] * 4))],
                ["bucket", "keys", "nodes", "shared_keys", "shared_nodes"])

        for batch in batches:
            for _, k, text, h in _chunks(batch, width):
                n, node = set_digest(text, h, k)
                for below in (False, True):
                    owner, key, _ = signatures(text, h, n, bands, below)
                    keys.append(key)
                    nodes.append(node[owner] | np.uint64(BELOW * below))
                    held += len(key)
                if held >= FLUSH:
                    yield flush()
        if held:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes = [], []

        def rows(key, node):
            return pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array((node & ~np.uint64(REPORTED)).view(np.int64))],
                ["key", "node"])

        for batch in batches:
            for bucket, k, v, sk, sv in zip(*(c.to_pylist() for c in batch.columns)):
                high = np.uint64(bucket) << np.uint64(32)
                keys.append(np.frombuffer(k, "<u4").astype(np.uint64) | high)
                nodes.append(np.frombuffer(v, np.uint64))
                if sk:
                    yield rows(np.frombuffer(sk, "<u4").astype(np.uint64) | high, np.frombuffer(sv, np.uint64))
        if not keys:
            return
        key, node = np.concatenate(keys), np.concatenate(nodes)
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        plain = node & ~np.uint64(REPORTED)
        same = (key[1:] == key[:-1])
        differ = same & (plain[1:] != plain[:-1])
        group = np.concatenate(([0], np.cumsum(~same)))
        shared = np.bincount(group[1:][differ], minlength=group[-1] + 1) > 0
        tell = shared[group] & ((node & np.uint64(REPORTED)) == 0)
        at = np.flatnonzero(tell)
        for a in range(0, len(at), 50_000):
            yield rows(key[at[a:a + 50_000]], node[at[a:a + 50_000]])

    sent = documents(docs).mapInArrow(
        lean(send), "bucket int, keys binary, nodes binary, shared_keys binary, shared_nodes binary")
    return sent.repartition(parts, "bucket").mapInArrow(lean(meet), "key long, node long").distinct()


def useful_parts(shared: DataFrame, nodes: DataFrame) -> DataFrame:
    """``shared`` without the parts that a set may leave out: those that more
    than COMMON sets share, where the set has no more of them than it can spare."""
    marked = shared.select("key", F.col("node").bitwiseAND(F.lit(~3)).alias("node"),
                           (F.col("node").bitwiseAND(F.lit(BELOW)) == BELOW).alias("below"))
    common = marked.groupBy("key").count().filter(F.col("count") > COMMON).select("key")
    spare = nodes.select("node", F.lit(False).alias("below"), F.col("spare")).union(
        nodes.select("node", F.lit(True), F.col("spare_below")))
    left_out = (marked.join(common, "key").groupBy("node", "below").agg(F.count("*").alias("n"))
                .join(spare, ["node", "below"]).filter(F.col("n") <= F.col("spare")).select("node", "below"))
    drop = marked.join(common, "key").join(left_out, ["node", "below"]).select("key", "node", "below")
    return marked.join(drop, ["key", "node", "below"], "left_anti").select("key", "node")


def verify(pairs: DataFrame, packed: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (a, b) of sets at or above the threshold.

    ``packed`` holds (id, z), a compressed text of each set. The sets around one
    centre ``a`` meet in groups of bounded size, the centre's text first.
    """
    parts = partitions(pairs.sparkSession)
    dealt = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(1 << 20)).alias("r"))
    size = dealt.groupBy("a").agg(F.ceil(F.count("*") / CENTRE_GROUP).cast("int").alias("groups"))
    dealt = dealt.join(size, "a").select("a", "b", F.expr("cast(r % groups as int)").alias("g"))
    centres = size.select("a", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g"))
    rows = (centres.join(packed, centres.a == packed.id).select("a", "g", F.lit(None).cast("long").alias("b"), "z")
            .unionByName(dealt.join(packed, dealt.b == packed.id).select("a", "g", "b", "z")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        centre, own = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            raw = [unpack(z) for z in batch.column("z").to_pylist()]
            ends = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
            text, h = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), ends, width)
            cut = np.searchsorted(text, np.arange(len(raw) + 1))
            out = []
            for i in range(len(raw)):
                this = h[cut[i]:cut[i + 1]]
                if b[i] is None:
                    centre, own = a[i], this
                elif a[i] == centre:
                    both = len(np.intersect1d(own, this, assume_unique=True))
                    if 100 * both >= percent * (len(own) + len(this) - both):
                        out.append(i)
            keep = pa.array(out, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(keep), batch.column("b").take(keep)], ["a", "b"])

    return (rows.repartition(parts, "a", "g").sortWithinPartitions("a", "g", F.col("b").asc_nulls_first())
            .select("a", "b", "z").mapInArrow(lean(run), "a long, b long"))


def dense_sketch(h: np.ndarray) -> bytes:
    """Parities of a set's shingles over a power of two of bits, two to four a
    shingle. Halves folded by exclusive or give the sketch of half as many bits."""
    bits = max(64, 1 << int(2 * len(h) - 1).bit_length())
    at = (h >> np.uint64(17)) & np.uint64(bits - 1)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def unlike(n: np.ndarray, sketches: list[bytes], percent: int) -> np.ndarray:
    """Matrix of the pairs whose sketches prove them below the threshold."""
    width = min(map(len, sketches))
    rows = np.zeros((len(sketches), width), np.uint8)
    for i, raw in enumerate(sketches):
        rows[i] = np.bitwise_xor.reduce(np.frombuffer(raw, np.uint8).reshape(-1, width), axis=0)
    bits = np.unpackbits(rows, axis=1).astype(np.float32)
    ones = bits.sum(1)
    apart = ones[:, None] + ones[None, :] - 2 * (bits @ bits.T)
    most = (100 - percent) * (n[:, None] + n[None, :]) // (100 + percent)
    less, more = np.minimum(n[:, None], n[None, :]), np.maximum(n[:, None], n[None, :])
    return (apart > most) | (percent * more > 100 * less)


def across_components(rest: DataFrame, packed: DataFrame, percent: int, width: int) -> DataFrame:
    """Pairs (a, b) of ``rest`` (key, id, n, c) with one key, of two components,
    that their sketches don't prove unlike. A key's sets are dealt to blocks, and
    each pair of blocks is compared by itself."""
    parts = partitions(rest.sparkSession)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            raw = [unpack(z) for z in batch.column("z").to_pylist()]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)
            text, h = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), ends, width)
            cut = np.searchsorted(text, np.arange(len(raw) + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([dense_sketch(h[a:b]) for a, b in zip(cut[:-1], cut[1:])],
                                              pa.binary())], ["id", "sketch"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group = None

        def close():
            block, ids, n, c, sketches = zip(*held)
            ids, c, block = np.array(ids), np.array(c), np.array(block)
            fit = ~unlike(np.array(n), list(sketches), percent) & (c[:, None] != c[None, :])
            if group[1] != group[2]:   # pairs inside a block belong to that block alone
                fit &= block[:, None] != block[None, :]
            a, b = np.nonzero(np.triu(fit, 1))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(ids[a], ids[b])), pa.array(np.maximum(ids[a], ids[b]))], ["a", "b"])

        for batch in batches:
            for key, i, j, *row in zip(*(col.to_pylist() for col in batch.columns)):
                if (key, i, j) != group:
                    if len(held) > 1:
                        yield close()
                    group, held = (key, i, j), []
                held.append(row)
        if len(held) > 1:
            yield close()

    sketches = (packed.join(rest.select("id").distinct(), "id").select("id", "z")
                .mapInArrow(lean(draw), "id long, sketch binary"))
    blocks = rest.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = (rest.join(blocks, "key").withColumn("block", F.expr("cast(pmod(xxhash64(id), blocks) as int)"))
            .join(sketches, "id")
            .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))))
    return (rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block",
                        "id", "n", "c", "sketch")
            .repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(lean(compare), "a long, b long").distinct())


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of the sets of hashes, left by right."""
    def entries(sets):
        own = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        h = np.concatenate(sets)
        order = np.argsort(h, kind="stable")
        return h[order], own[order]

    (ha, a), (hb, b) = entries(left), entries(right)
    both = np.intersect1d(ha, hb)
    a0, a1 = np.searchsorted(ha, both), np.searchsorted(ha, both, side="right")
    b0, b1 = np.searchsorted(hb, both), np.searchsorted(hb, both, side="right")
    out = np.zeros((len(left), len(right)), np.float32)   # whole numbers far below 2**24
    often = (a1 - a0) * (b1 - b0) > RARE

    def spread(starts, stops):
        """(index of the range, position) of all positions of the ranges."""
        size = stops - starts
        of = np.repeat(np.arange(len(size)), size)
        return of, np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + starts[of]

    dense = np.flatnonzero(often)
    for k in range(0, len(dense), COLUMNS):
        cols = dense[k:k + COLUMNS]
        x, y = np.zeros((len(left), len(cols)), np.float32), np.zeros((len(right), len(cols)), np.float32)
        of, at = spread(a0[cols], a1[cols])
        x[a[at], of] = 1
        of, at = spread(b0[cols], b1[cols])
        y[b[at], of] = 1
        out += x @ y.T
    rare = np.flatnonzero(~often)
    pairs = np.cumsum((a1 - a0)[rare] * (b1 - b0)[rare])
    flat, done = out.reshape(-1), 0
    while done < len(rare):
        upto = max(done + 1, int(np.searchsorted(pairs, (pairs[done - 1] if done else 0) + 1_000_000, side="right")))
        cols = rare[done:upto]
        of, at = spread(a0[cols], a1[cols])            # each left entry meets its shingle's right entries
        of2, at2 = spread(b0[cols][of], b1[cols][of])
        place, n = np.unique(a[at][of2] * len(right) + b[at2], return_counts=True)
        flat[place] += n
        done = upto
    return out


def count_links(members: DataFrame, packed: DataFrame, percent: int, width: int) -> DataFrame:
    """(id, n_links) of the sets of ``members`` (id, n, c: their component) that
    have links: how many other sets are at or above the threshold."""
    parts = partitions(members.sparkSession)
    size = members.groupBy("c").agg(F.count("*").alias("m"), F.sum("n").alias("total")).filter("m > 1")
    own = members.join(size, "c")
    pairs = own.filter("m = 2").select("id", F.lit(1).cast("long").alias("n_links"))   # these two are linked
    blocks = F.greatest(F.ceil(F.col("m") / COUNT_SETS), F.ceil(F.col("total") / COUNT_SHINGLES)).cast("int")
    rows = (own.filter("m > 2").withColumn("blocks", blocks)
            .withColumn("block", F.expr("cast(pmod(xxhash64(id), blocks) as int)"))
            .join(packed, "id")
            .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
            .select("c", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "z"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        group, held = None, ([], [])   # (id, hashes) of block i, and of block j

        def tally():
            left, right = held[0], held[1] or held[0]
            if group[1] != group[2] and not (held[0] and held[1]):
                return
            both = intersections([h for _, h in left], [h for _, h in right])
            na, nb = (np.array([len(h) for _, h in x], np.int64) for x in (left, right))
            mine, theirs = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
            for k in range(0, len(left), 256):
                n = both[k:k + 256].astype(np.int64)
                fit = 100 * n >= percent * (na[k:k + 256, None] + nb[None, :] - n)
                mine[k:k + 256] = fit.sum(1)
                theirs += fit.sum(0)
            if right is left:
                mine -= 1   # a set's link with itself
                found = [(left, mine)]
            else:
                found = [(left, mine), (right, theirs)]
            for x, n in found:
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in x], pa.int64()), pa.array(n)], ["id", "k"])

        for batch in batches:
            raw = [unpack(z) for z in batch.column("z").to_pylist()]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)
            text, h = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), ends, width)
            cut = np.searchsorted(text, np.arange(len(raw) + 1))
            for k, (c, i, j, block, one) in enumerate(zip(*(batch.column(x).to_pylist()
                                                            for x in ("c", "i", "j", "block", "id")))):
                if (c, i, j) != group:
                    if group is not None:
                        yield from tally()
                    group, held = (c, i, j), ([], [])
                held[block != i].append((one, h[cut[k]:cut[k + 1]].copy()))
        if group is not None:
            yield from tally()

    counted = (rows.repartition(parts, "c", "i", "j").sortWithinPartitions("c", "i", "j")
               .mapInArrow(lean(run), "id long, k long").groupBy("id").agg(F.sum("k").alias("n_links")))
    return pairs.unionByName(counted)


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id that a link (a, b) names: the smallest id
    that links reach. Alternates two steps until nothing changes: every id's
    larger neighbours are tied to its smallest neighbour, then all its smaller
    ones; each step is an aggregation and a join, written to shared files."""
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .filter("u <> v").distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        last, edges = edges, stage(small, "links")
        state, before = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.max("u")).first(), state
        drop_staged(last)
        if state == before:
            break
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def similarity_components(docs: DataFrame, percent: int = 85, width: int = 4, links: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id and, with ``links``, n_links of every document;
    n_links is the number of other sets that its set is linked with (0: only equal sets, or none)."""
    data = documents(docs)
    longest = data.agg(F.max(F.octet_length("text"))).first()[0] or 1
    bands = Bands(percent, longest)
    ids = stage(describe(data, bands, width), "sets")
    # a node is a set; its text is one row's, its least id is that of all its rows
    nodes = stage(ids.filter("n_shingles > 0").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.min(F.struct("row_id", "twin")).alias("row"), F.first("n_shingles").alias("n"),
        F.first("spare").alias("spare"), F.first("spare_below").alias("spare_below")), "nodes")
    shared = stage(shared_parts(data, bands, width), "parts")
    useful = useful_parts(shared, nodes).distinct()
    degree = useful.groupBy("node").agg(F.count("*").alias("degree"))
    known = nodes.join(degree, "node").select("node", "n", "degree")
    useful = stage(useful.join(known, "node").select("key", F.col("node").alias("id"), "n", "degree"), "members")

    near = F.col("n") * percent <= 100 * F.col("other")
    near &= F.col("other") * percent <= 100 * F.col("n")
    centre = useful.groupBy("key").agg(F.max(F.struct("degree", "id", "n")).alias("c")) \
        .select("key", F.col("c.id").alias("centre"), F.col("c.n").alias("other"))
    star = stage(useful.join(centre, "key").filter((F.col("id") != F.col("centre")) & near)
                 .select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct(), "stars")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), batch.column("twin"),
                 pa.array([z(t.encode("utf-8", "surrogatepass")) for t in batch.column("text").to_pylist()],
                          pa.binary())], ["row_id", "twin", "z"])

    wanted = nodes.select(F.col("node").alias("id"), "row.row_id", "row.twin").join(
        useful.select("id").distinct(), "id")
    packed = stage(with_row_key(data).mapInArrow(lean(pack), "row_id long, twin long, z binary")
                   .join(wanted, ["row_id", "twin"]).dropDuplicates(["row_id", "twin"]).select("id", "z"), "texts")
    first = stage(verify(star, packed, percent, width), "verified")
    merged = components(first)

    inside = useful.join(merged.withColumnRenamed("component", "c"), "id", "left") \
        .select("key", "id", "n", F.coalesce("c", "id").alias("c"))
    split = inside.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y")).filter("x <> y").select("key")
    rest = stage(inside.join(split, "key"), "rest")   # key, id, n, c
    tested = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # verification reads its pairs several times
    across = stage(across_components(rest, packed, percent, width).join(tested, ["a", "b"], "left_anti"), "across")
    second = stage(verify(across, packed, percent, width), "verified")
    final = stage(components(first.union(second)), "components")
    by_node = nodes.select("node", "least").join(final, F.col("node") == F.col("id"), "left") \
        .select("node", "least", F.coalesce("component", "node").alias("c"))
    columns = ["doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id"))
               .otherwise(F.col("doc_id")).alias("component_id")]
    least = by_node.groupBy("c").agg(F.min("least").alias("component_id"))
    if links:
        count = stage(count_links(nodes.select(F.col("node").alias("id"), "n").join(
            final.withColumnRenamed("component", "c"), "id"), packed, percent, width), "counts")
        by_node = by_node.join(count, F.col("node") == F.col("id"), "left")
        columns.append(F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    drop_staged(shared, useful, star, packed, first, rest, across, second)
    return ids.join(by_node.join(least, "c"), "node", "left").select(columns)
