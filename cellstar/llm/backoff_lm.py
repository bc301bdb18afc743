"""Language-model scoring by a weighted backoff automaton.

Tokens are words (A-Z in lower case, ``[^\\x20\\x09-\\x0D]+``) and one end a text.
The model is a trigram model over the training documents' counts:

    p(w)     = (c(w) + 0.5) / (N + 0.5 (V + 1))
    p(w | h) = (c(h w) + MU p(w | h')) / (c(h) + MU)       h' is h without its first word

so unseen n-grams take the shorter context's probability times MU / (c(h) + MU),
and a word of no training document has the one unknown word's probability. Of it
an automaton is made: a state for every context seen in training, an arc for
every n-gram seen, a failure arc from each context to the next shorter one. A
text is read once from left to right; the state is carried, failure weights and
arc weights (log10) add up to its score. A block's texts are read side by side,
in lanes; a long text has several, each of which first reads the two tokens
before it, as its state depends on no more.

At any size of the corpus: documents become bounded blocks; a block asks the hash
partitions of ``blocks`` for the counts of its own n-grams and gets them back, so
it builds the part of the automaton that its texts can reach, and no task holds
more than a block's or a partition's share. Counts cover all training documents.
Keys have 48 bits within a partition; texts longer than a block are read in
several, each with the two words before it.

Null or empty texts have their end alone. Rows with a null id are training rows
(no remainder is 1). Rows that repeat count each time and score alike. With no
training rows N is 0 and every token is unknown; with no rows there are none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstar.llm import blocks
from cellstar.llm.common import bytes_of, documents, lean, mix64, stage, text_chunks
from cellstar.llm.shingles import word_hashes

ORDER = 3
#: Words of a block: many, as n-grams that a block repeats are asked for once.
BLOCK_WORDS = 400_000
#: Strength of the shorter context against a context's own counts.
MU = 16.0
KEY_BITS = 48
#: Tokens that a lane of the traversal reads.
LANE = 256
#: Hashes of the signs before a text's first word and after its last.
BEGIN, END = mix64(np.array([0x5EED0001, 0x5EED0002], np.uint64))


def text_blocks(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(t, z, segments): the documents, in blocks of about ``block_words`` words.
    A segment is a text or a part of one: row number, doc_id, held_out, the bytes
    it has in the block, words of context it begins with, and whether the text
    begins and ends in it."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    rows = documents(docs, held.alias("held_out"))
    fields = ("row", "doc_id", "held_out", "size", "context", "first", "last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, row = TaskContext.get().partitionId() << 40, 0, 0
        waiting: list[tuple] = []   # segment fields, bytes
        words = 0

        def flush():
            nonlocal made, waiting, words
            made += 1
            z = zstandard.ZstdCompressor(level=3).compress(b"".join(raw for _, raw in waiting))
            out = pa.RecordBatch.from_arrays(
                [pa.array([task + made]), pa.array([z], pa.binary()),
                 pa.array([[dict(zip(fields, s)) for s, _ in waiting]], _SEGMENTS)], ["t", "z", "segments"])
            waiting, words = [], 0
            return out

        for batch in batches:
            for a, b in text_chunks(batch):
                some = batch.slice(a, b - a)
                raw, ends = blocks.normalise(*bytes_of(some.column("text")))
                stops = np.flatnonzero((raw == 10) | (raw == 32))
                upto = np.searchsorted(stops, ends)
                for i, (doc, out) in enumerate(zip(some.column("doc_id").to_pylist(),
                                                   some.column("held_out").to_pylist())):
                    row += 1
                    n = int(upto[i + 1] - upto[i])
                    cuts = [*range(0, n, block_words), n] if n else [0, 0]
                    for k, (x, y) in enumerate(zip(cuts, cuts[1:])):
                        context = min(x, ORDER - 1)
                        begin = ends[i] if x == context else stops[upto[i] + x - context - 1] + 1
                        end = ends[i + 1] if y == n else stops[upto[i] + y - 1] + 1
                        waiting.append(((task + row, doc, out, int(end - begin), context, x == 0, y == n),
                                        raw[begin:end].tobytes()))
                        words += y - x + 1
                        if words >= block_words:
                            yield flush()
        if waiting:
            yield flush()

    return rows.mapInArrow(lean(run), "t long, z binary, segments array<struct<row:long, doc_id:long, "
                                      "held_out:boolean, size:long, context:int, first:boolean, last:boolean>>")


_SEGMENTS = pa.list_(pa.struct([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
                                ("size", pa.int64()), ("context", pa.int32()), ("first", pa.bool_()),
                                ("last", pa.bool_())]))


class Tokens:
    """A block's tokens: hash, segment, and whether they are read (not context)."""

    def __init__(self, z: bytes, segments: list[dict]):
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(z), np.uint8)
        ends = np.concatenate(([0], np.cumsum([s["size"] for s in segments]))).astype(np.int64)
        owner, h = word_hashes(raw, ends)
        k = len(segments)
        first = np.array([s["first"] for s in segments], bool)
        last = np.array([s["last"] for s in segments], bool)
        context = np.array([s["context"] for s in segments])
        words = np.bincount(owner, minlength=k)
        size = words + first + last
        self.begin = np.concatenate(([0], np.cumsum(size)))
        at = self.begin[owner] + first[owner] + np.arange(len(h)) - (np.cumsum(words) - words)[owner]
        self.hash = np.empty(self.begin[-1], np.uint64)
        self.hash[at] = h
        self.hash[self.begin[:-1][first]] = BEGIN
        self.hash[self.begin[1:][last] - 1] = END
        self.segment = np.repeat(np.arange(k), size)
        self.skip = np.where(first, 1, context)   # the sign before a text is context, too
        self.read = np.arange(self.begin[-1]) - self.begin[:-1][self.segment] >= self.skip[self.segment]
        self.held = np.array([s["held_out"] for s in segments], bool)[self.segment]
        self.starts = np.zeros(len(self.hash), bool)
        self.starts[self.begin[:-1][first]] = True

    def weights(self, first: np.ndarray, n: int) -> np.ndarray:
        """1 for the n-grams (by first token) that training counts here."""
        end = first + n - 1
        return ((self.read[end] | (self.starts[end] if n == 1 else False)) & ~self.held[end]).astype(np.uint64)


def _levels(tokens: Tokens, ranges: blocks.Ranges):
    """(first tokens, short keys) of the n-grams, order by order."""
    return [(first, ranges.cut(k)) for first, k in blocks.grams(tokens.hash, tokens.segment, ORDER)]


def requests(staged: DataFrame, ranges: blocks.Ranges) -> DataFrame:
    """(t, level, p, keys, counts): each block's n-grams and their training counts in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, z, segments in zip(*(batch.column(c).to_pylist() for c in ("t", "z", "segments"))):
                tokens = Tokens(z, segments)
                rows = []
                for n, (first, keys) in enumerate(_levels(tokens, ranges), 1):
                    keys, counts = blocks.counted(keys, tokens.weights(first, n))
                    rows += [(t, n, p, blocks.pack_keys(keys[a:b]), blocks.pack_counts(counts[a:b]))
                             for p, a, b in ranges.split(keys)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], kind) for i, kind in
                     enumerate((pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                    ["t", "level", "p", "keys", "counts"])

    return staged.mapInArrow(lean(run), "t long, level int, p long, keys binary, counts binary")


def answers(asked: DataFrame, ranges: blocks.Ranges) -> DataFrame:
    """(t, level, p, counts, tokens, kinds): the corpus's counts in the order of
    the keys asked; on one row of a partition also its training tokens and words."""
    begin = ranges.cut(blocks.grams(np.array([BEGIN]), np.zeros(1), 1)[0][1])[0]

    def settle(table: pa.Table) -> pa.Table:
        level = table.column("level").to_pylist()
        rows, tokens, kinds = [], 0, 0
        for n in sorted(set(level)):
            own = [i for i, x in enumerate(level) if x == n]
            keys = [blocks.unpack_keys(table.column("keys")[i].as_py()) for i in own]
            counts = [blocks.unpack_counts(table.column("counts")[i].as_py()) for i in own]
            known, total = blocks.counted(np.concatenate(keys), np.concatenate(counts))
            if n == 1:
                words = (total > 0) & (known != begin)
                tokens, kinds = int(total[words].sum()), int(words.sum())
            for i, k in zip(own, keys):
                rows.append((table.column("t")[i].as_py(), n, table.column("p")[i].as_py(),
                             blocks.pack_counts(total[np.searchsorted(known, k)])))
        return pa.table([*(pa.array([r[i] for r in rows], kind) for i, kind in
                           enumerate((pa.int64(), pa.int32(), pa.int64(), pa.binary()))),
                         pa.array([tokens] + [0] * (len(rows) - 1)), pa.array([kinds] + [0] * (len(rows) - 1))],
                        ["t", "level", "p", "counts", "tokens", "kinds"])

    return asked.groupBy("p").applyInArrow(
        settle, "t long, level int, p long, counts binary, tokens long, kinds long")


class Automaton:
    """The part of the backoff automaton that a block's texts can reach.

    States: 0 is the empty context, then words, then pairs of words. The arcs of
    the empty context are by word; all others by state * words + word."""

    def __init__(self, levels, counts: list[np.ndarray], total: int, kinds: int):
        ids, known = [], []
        for (_, keys), c in zip(levels, counts):
            ids.append(np.unique(keys, return_inverse=True)[1])
            known.append(c.astype(float))
        self.words = len(known[0])
        self.word = ids[0]
        p1 = (known[0] + 0.5) / (total + 0.5 * (kinds + 1))
        self.unigram = p1
        state1 = np.where(known[0] > 0, np.cumsum(known[0] > 0), 0)
        n1 = int((known[0] > 0).sum())
        state2 = np.where(known[1] > 0, n1 + np.cumsum(known[1] > 0), 0)
        # one occurrence of every distinct n-gram tells its parts
        at2, at3 = (self._occurrence(level, index, len(c)) for level, index, c in zip(levels[1:], ids[1:], known[1:]))
        pair = np.zeros(len(self.word), int)
        pair[levels[1][0]] = ids[1]             # pair that begins at a token
        head2, tail2 = self.word[at2], self.word[at2 + 1]
        head3, tail3, last3 = pair[at3], pair[at3 + 1], self.word[at3 + 2]
        p2 = (known[1] + MU * p1[tail2]) / (known[0][head2] + MU)
        p3 = (known[2] + MU * p2[tail3]) / (known[1][head3] + MU)

        seen1, seen2, seen3 = known[0] > 0, known[1] > 0, known[2] > 0
        self.fail = np.zeros(1 + n1 + int(seen2.sum()), int)
        self.back = np.zeros(len(self.fail))
        self.back[state1[seen1]] = np.log10(MU / (known[0][seen1] + MU))
        self.fail[state2[seen2]] = state1[tail2[seen2]]
        self.back[state2[seen2]] = np.log10(MU / (known[1][seen2] + MU))
        self.root_weight, self.root_target = np.log10(p1), state1
        self.weight = np.log10(np.concatenate((p2[seen2], p3[seen3])))
        self.target = np.concatenate((state2[seen2], state2[tail3[seen3]]))
        self._place(np.concatenate((state1[head2[seen2]] * self.words + tail2[seen2],
                                    state2[head3[seen3]] * self.words + last3[seen3])))

    @staticmethod
    def _occurrence(level, index: np.ndarray, kinds: int) -> np.ndarray:
        at = np.zeros(kinds, int)
        at[index] = level[0]
        return at

    def _place(self, keys: np.ndarray) -> None:
        """A hash table of the arcs: key and arc number, the next free place after its own for each."""
        self.mask = (1 << max(4, (2 * len(keys)).bit_length())) - 1
        self.keys, self.arc = np.full(self.mask + 1, -1), np.zeros(self.mask + 1, int)
        left, at = np.arange(len(keys)), self._own_place(keys)
        while len(left):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[left[free]]      # of several, one stays
            placed = self.keys[at] == keys[left]
            self.arc[at[placed]] = left[placed]
            left, at = left[~placed], (at[~placed] + 1) & self.mask

    def _own_place(self, keys: np.ndarray) -> np.ndarray:
        return (mix64(keys) & np.uint64(self.mask)).astype(int)

    def _arcs(self, keys: np.ndarray) -> np.ndarray:
        """Arc of each key, -1 where there is none."""
        at = self._own_place(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.arc[at], -1)
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            there = self.keys[at[left]]
            hit = there == keys[left]
            out[left[hit]] = self.arc[at[left[hit]]]
            left = left[~hit & (there >= 0)]
        return out

    def advance(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, log10 probability) after reading a word in each state."""
        state, cost = state.copy(), np.zeros(len(state))
        rest = np.flatnonzero(state)
        at_root = np.flatnonzero(state == 0)
        while len(rest):
            arc = self._arcs(state[rest] * self.words + word[rest])
            hit, arc = rest[arc >= 0], arc[arc >= 0]
            missed = np.ones(len(state), bool)
            missed[hit] = False
            rest = rest[missed[rest]]
            cost[hit] += self.weight[arc]
            state[hit] = self.target[arc]
            cost[rest] += self.back[state[rest]]
            state[rest] = self.fail[state[rest]]
            at_root = np.concatenate((at_root, rest[state[rest] == 0]))
            rest = rest[state[rest] > 0]
        cost[at_root] += self.root_weight[word[at_root]]
        state[at_root] = self.root_target[word[at_root]]
        return state, cost

    def read(self, begin: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """log10 probability of the tokens [first, end) of each lane, read from
        left to right after its context [begin, first); all lanes a token at a time."""
        order = np.argsort(begin - end, kind="stable")
        begin, first, end = begin[order], first[order], end[order]
        total, state = np.zeros(len(begin)), np.zeros(len(begin), int)
        size = end - begin
        for j in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -j))       # lanes longer than j
            at = begin[:n] + j
            state[:n], cost = self.advance(state[:n], self.word[at])
            total[:n] += np.where(at >= first[:n], cost, 0.0)
        out = np.empty(len(total))
        out[order] = total
        return out


def lanes(tokens: Tokens, length: int = LANE):
    """(segment, begin, first, end) of the lanes: ``length`` tokens each, with the tokens of context before them."""
    first = tokens.begin[:-1] + tokens.skip
    count = np.maximum(-(-(tokens.begin[1:] - first) // length), 0)
    segment = np.repeat(np.arange(len(first)), count)
    k = np.arange(len(segment)) - (np.cumsum(count) - count)[segment]
    at = first[segment] + k * length
    return (segment, np.maximum(tokens.begin[:-1][segment], at - (ORDER - 1)), at,
            np.minimum(at + length, tokens.begin[1:][segment]))


def score(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    staged = stage(text_blocks(docs, block_words), "lm-blocks")
    ranges = blocks.Ranges(2 * blocks.ranges_for(documents(docs)), KEY_BITS)
    told = stage(answers(requests(staged, ranges), ranges), "lm-counts")
    sums = told.agg(F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")).first()
    total, kinds = int(sums.tokens or 0), int(sums.kinds or 0)

    own = staged.select("t", "z", "segments", *(F.lit(None).cast(kind).alias(c) for c, kind in
                                                (("level", "int"), ("p", "long"), ("counts", "binary"))))
    replies = told.select("t", F.lit(None).cast("binary").alias("z"),
                          F.lit(None).cast(staged.schema["segments"].dataType).alias("segments"),
                          "level", "p", "counts")
    kinds_of = [("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]

    def read(table: pa.Table) -> pa.Table:
        (z, segments), = [(z.as_py(), s.as_py()) for z, s in zip(table.column("z"), table.column("segments")) if z.is_valid]
        parts: list[list] = [[] for _ in range(ORDER)]
        for n, p, c in zip(*(table.column(c).to_pylist() for c in ("level", "p", "counts"))):
            if c is not None:
                parts[n - 1].append((p, c))
        counts = [np.concatenate([blocks.unpack_counts(c) for _, c in sorted(own)] or [np.zeros(0, np.uint64)])
                  for own in parts]
        tokens = Tokens(z, segments)
        model = Automaton(_levels(tokens, ranges), counts, total, kinds)
        base = np.log10(model.unigram)[model.word]
        known = counts[0][model.word] > 0
        k = len(segments)
        of = tokens.segment[tokens.read]
        segment, *lane = lanes(tokens)
        scores = np.bincount(segment, model.read(*lane), k).astype(float)
        return pa.table([*(pa.array([s[c] for s in segments], kind) for c, kind in kinds_of[:3]),
                         pa.array(np.bincount(of, minlength=k).astype(np.int64)),
                         pa.array(np.bincount(of, known[tokens.read], k).astype(np.int64)),
                         pa.array(np.bincount(of, base[tokens.read], k).astype(float)), pa.array(scores, pa.float64())],
                        [c for c, _ in kinds_of])

    parts = own.unionByName(replies).groupBy("t").applyInArrow(
        read, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return parts.groupBy("row", "doc_id", "held_out").agg(
        *(F.sum(c).alias(c) for c in ("n_tokens", "n_known")), F.lit(total).cast("long").alias("train_tokens"),
        *(F.sum(c).alias(c) for c in ("base_score", "score"))).drop("row")
