"""Phrase collocations: Misra-Gries summaries find the candidates, a second pass counts them.

Texts (A-Z in lower case) are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these
at spaces and tabs into words; n-grams of 1 to 4 words stay within a piece and
are counted per ``lang`` (null: ``und``).

* Documents become bounded blocks of one language (``blocks``), some of which
  are a unit. A unit's counts of n-gram hashes in each hash partition, merged
  from its blocks, are its Misra-Gries summary there: with all its counters, so
  without error.
* First pass: in a hash partition of mass M the units' summaries are merged
  into one of more than M / ``at_least`` counters. Each merge beyond that takes
  the (capacity + 1)-th largest count off all counters, hence at most
  M / (capacity + 1) < ``at_least`` off any: every frequent n-gram survives. The
  survivors' hashes are added up over the partition, and those that reach
  ``at_least`` are named to the units they occur in.
* Second pass: each unit counts the phrases so named in its own text, by their
  words, and sends each hash partition its phrases, packed in their order. There
  these counts are added by words: exact ones, whatever fell together as a hash
  before.

What a unit sends is packed, as most of the disk is the shuffles': no row goes out
for a single phrase, and a step's shuffle files go when its result is written.

A frequent n-gram's parts are frequent too, so all counts that the scores need
are there. Scores are exact integers (decimal arithmetic). A piece is never cut,
so a block is as long as its longest piece at least.

Null or empty texts have no words. Rows that repeat count each time; ids don't
matter. With no rows, or no frequent phrase, the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellstar.llm import blocks
from cellstar.llm.common import bytes_of, documents, lean, mix64, stage, text_chunks

UND = "und"
#: Longest phrase; least count; most phrases reported for a language.
ORDER, AT_LEAST, TOP = 4, 30, 2000
#: A phrase goes when a longer one around it has this share (percent) of its count.
COVERED = 80
#: Signs that end a piece, beside spaces and tabs that end a word (fixed values).
BREAKS = ".,;:!?\x0a\x0b\x0c\x0d"
#: Bits of a key within its hash partition: two n-grams that fall together only cost a survivor.
KEY_BITS = 26
#: Blocks' worth of words in a unit; packed bytes of units that a task holds back at most.
UNIT_BLOCKS, UNIT_BYTES = 4, 1 << 25
#: Keys or phrases that a merge sorts at a time.
MERGE_KEYS = 1 << 20


def language_blocks(docs: DataFrame, block_words: int = blocks.BLOCK_WORDS) -> DataFrame:
    """(t, lang, n_words, z): the documents' pieces, in blocks of one language; blocks of a unit share t."""
    rows = documents(docs, F.coalesce(F.col("lang").cast("string"), F.lit(UND)).alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 40, 0
        waiting: dict[str, list[np.ndarray]] = {}
        size: dict[str, int] = {}
        ready: dict[str, list[tuple[int, bytes]]] = {}

        def words_of(raw: np.ndarray) -> int:
            return int(np.count_nonzero((raw == 10) | (raw == 32)))

        def pack(lang: str, all_of_it: bool) -> None:
            raw = np.concatenate(waiting.pop(lang))
            size.pop(lang)
            stops, feeds = np.flatnonzero((raw == 10) | (raw == 32)), np.flatnonzero(raw == 10)
            wanted = stops[block_words - 1::block_words]
            cuts = np.unique(feeds[np.searchsorted(feeds, wanted)] + 1)
            *parts, rest = np.split(raw, cuts)
            if all_of_it:
                parts.append(rest)
            elif len(rest):
                waiting[lang], size[lang] = [rest.copy()], words_of(rest)
            for part in parts:
                if len(part):
                    z = zstandard.ZstdCompressor(level=3).compress(part.tobytes())
                    ready.setdefault(lang, []).append((words_of(part), z))

        def units(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal made
            for lang in sorted(ready):
                if sum(n for n, _ in ready[lang]) >= least:
                    made += 1
                    n, z = zip(*ready.pop(lang))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([task + made] * len(z)), pa.array([lang] * len(z)), pa.array(n),
                         pa.array(z, pa.binary())], ["t", "lang", "n_words", "z"])

        for batch in batches:
            for a, b in text_chunks(batch):
                some = batch.slice(a, b - a)
                langs = np.array(some.column("lang").to_pylist(), object)
                for lang in sorted(set(langs)):
                    raw, ends = bytes_of(some.column("text").take(pa.array(np.flatnonzero(langs == lang))))
                    raw, _ = blocks.normalise(raw, ends, BREAKS)
                    waiting.setdefault(lang, []).append(raw)
                    size[lang] = size.get(lang, 0) + words_of(raw)
                    if size[lang] >= block_words:
                        pack(lang, False)
                if sum(size.values()) > 4 * block_words:  # very many languages
                    for lang in sorted(waiting):
                        pack(lang, True)
                held = sum(len(z) for own in ready.values() for _, z in own)
                yield from units(UNIT_BLOCKS * block_words if held < UNIT_BYTES else 0)
        for lang in sorted(waiting):
            pack(lang, True)
        yield from units(0)

    return rows.mapInArrow(lean(run), "t long, lang string, n_words long, z binary")


def _seed(lang: str) -> np.uint64:
    known = lang.encode("utf-8", "surrogatepass")
    seed = np.array([len(known) + 1], np.uint64)
    for c in known:
        seed = mix64(seed * np.uint64(257) + np.uint64(c))
    return seed[0]


def _grams(lang: str, z: bytes):
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(z), np.uint8)
    words = blocks.Words(raw)
    return raw, words, blocks.grams(words.hash, words.line, ORDER, _seed(lang))


def summaries(staged: DataFrame, ranges: blocks.Ranges) -> DataFrame:
    """(t, p, mass, keys, counts): each unit's counters in each hash partition.
    (Were a unit's blocks read apart, each part would send its own.)"""

    def send(t: int, own: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, n = own[0] if len(own) == 1 else blocks.counted(*map(np.concatenate, zip(*own)))
        parts = ranges.split(keys)
        return pa.RecordBatch.from_arrays(
            [pa.array([t] * len(parts), pa.int64()), pa.array([p for p, _, _ in parts], pa.int64()),
             pa.array([int(n[a:b].sum()) for _, a, b in parts], pa.int64()),
             pa.array([blocks.pack_keys(keys[a:b]) for _, a, b in parts], pa.binary()),
             pa.array([blocks.pack_counts(n[a:b]) for _, a, b in parts], pa.binary())],
            ["t", "p", "mass", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, []
        for batch in batches:
            for t, lang, z in zip(*(batch.column(c).to_pylist() for c in ("t", "lang", "z"))):
                if t != now and own:
                    yield send(now, own)
                    own = []
                now = t
                own.append(blocks.counted(ranges.cut(np.concatenate([k for _, k in _grams(lang, z)[2]]))))
        if own:
            yield send(now, own)

    return staged.select("t", "lang", "z").mapInArrow(
        lean(run), "t long, p long, mass long, keys binary, counts binary")


class Summary:
    """A Misra-Gries summary: at most ``capacity`` counters, merged in bulk."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.lost = 0   # the most that any count is short of

    def merge(self, keys: list[np.ndarray], counts: list[np.ndarray]) -> None:
        self.keys, self.counts = blocks.counted(np.concatenate([self.keys, *keys]),
                                                np.concatenate([self.counts, *counts]))
        if len(self.keys) > self.capacity:
            at = len(self.counts) - self.capacity - 1
            less = np.partition(self.counts, at)[at]
            self.lost += int(less)
            alive = self.counts > less
            self.keys, self.counts = self.keys[alive], self.counts[alive] - less


def _portions(table: pa.Table):
    """Keys and counts of the group's units, some MERGE_KEYS keys at a time."""
    keys, counts, size = [], [], 0
    for k, n in zip(table.column("keys"), table.column("counts")):
        keys.append(blocks.unpack_keys(k.as_py()))
        counts.append(blocks.unpack_counts(n.as_py()))
        size += len(keys[-1])
        if size >= MERGE_KEYS:
            yield keys, counts
            keys, counts, size = [], [], 0
    if keys:
        yield keys, counts


def survivors(table: pa.Table, at_least: int) -> np.ndarray:
    """Keys of a hash partition that may reach ``at_least``, every one that does among them."""
    mass = sum(m.as_py() for m in table.column("mass"))
    summary = Summary(mass // at_least + 1)
    for keys, counts in _portions(table):
        summary.merge(keys, counts)
    found = summary.keys
    total = np.zeros(len(found), np.uint64)
    for keys, counts in _portions(table):   # what the summary took off is counted again
        k, n = blocks.counted(np.concatenate(keys), np.concatenate(counts))
        at = np.searchsorted(found, k)
        here = at < len(found)
        here[here] = found[at[here]] == k[here]
        total[at[here]] += n[here]
    return found[total >= at_least]


def frequent_keys(sent: DataFrame, at_least: int) -> DataFrame:
    """(t, named): for every unit, its keys that survive."""

    def settle(table: pa.Table) -> pa.Table:
        found = survivors(table, at_least)
        t, named = [], []
        for unit, k in zip(table.column("t"), table.column("keys")):
            own = np.intersect1d(blocks.unpack_keys(k.as_py()), found, assume_unique=True)
            if len(own):
                t.append(unit.as_py())
                named.append(blocks.pack_keys(own))
        return pa.table([pa.array(t, pa.int64()), pa.array(named, pa.binary())], ["t", "named"])

    return sent.groupBy("p").applyInArrow(settle, "t long, named binary")


def _cut(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The texts raw[start[i]:end[i]]."""
    size = end - start
    ends = np.concatenate(([0], np.cumsum(size)))
    at = np.repeat(start - ends[:-1], size) + np.arange(ends[-1])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [
        None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw[at]))])


def _added(tables: list[pa.Table], *by: str) -> pa.Table:
    """The tables' rows with f added up."""
    summed = pa.concat_tables(tables).group_by([*by]).aggregate([("f", "sum")])
    return summed.select([*by, "f_sum"]).rename_columns([*by, "f"])


def phrase_counts(told: DataFrame, ranges: blocks.Ranges) -> DataFrame:
    """(lang, p, phrases, counts): for each unit and hash partition, the unit's
    phrases with a named key, in ascending order, and their counts."""

    def count(table: pa.Table) -> pa.Table:
        texts = [(lang.as_py(), z.as_py()) for lang, z in zip(table.column("lang"), table.column("z")) if z.is_valid]
        parts = [blocks.unpack_keys(k.as_py()) for k in table.column("named") if k.is_valid]
        wanted = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
        names, out = ["lang", "p", "phrases", "counts"], []
        if len(wanted):
            seen = np.zeros(1 << 22, bool)
            seen[wanted & np.uint64(len(seen) - 1)] = True
            for lang, z in texts:
                raw, words, found = _grams(lang, z)
                for n, (first, k) in enumerate(found, 1):
                    key = ranges.cut(k)
                    maybe = np.flatnonzero(seen[key & np.uint64(len(seen) - 1)])
                    at = np.minimum(np.searchsorted(wanted, key[maybe]), len(wanted) - 1)
                    maybe = maybe[wanted[at] == key[maybe]]
                    k, one, f = np.unique(k[maybe], return_index=True, return_counts=True)
                    first = first[maybe[one]]
                    out.append(pa.table([pa.array(ranges.of(ranges.cut(k))),
                                         _cut(raw, words.start[first], words.end[first + n - 1]),
                                         pa.array(f.astype(np.int64))], ["p", "phrase", "f"]))
        if not out:
            return pa.schema([("lang", pa.string()), ("p", pa.int64()), ("phrases", pa.binary()),
                              ("counts", pa.binary())]).empty_table()
        whole = _added(out, "p", "phrase").sort_by([("p", "ascending"), ("phrase", "ascending")]).combine_chunks()
        p, first = np.unique(whole.column("p").to_numpy(), return_index=True)
        ends = np.append(first, len(whole))
        f = whole.column("f").to_numpy().astype(np.uint64)
        pack = zstandard.ZstdCompressor(level=3).compress
        lines = pc.binary_join(pa.LargeListArray.from_arrays(ends, whole.column("phrase").combine_chunks()),
                               pa.scalar(b"\n", pa.large_binary()))
        return pa.table([pa.array([texts[0][0]] * len(p), pa.string()), pa.array(p),
                         pa.array([pack(x.as_py()) for x in lines], pa.binary()),
                         pa.array([blocks.pack_counts(f[a:b]) for a, b in zip(ends, ends[1:])], pa.binary())], names)

    return told.groupBy("t").applyInArrow(count, "lang string, p long, phrases binary, counts binary")


def exact_counts(sent: DataFrame, at_least: int) -> DataFrame:
    """(lang, words, phrase, f): the units' counts added by words, those that reach ``at_least``."""

    def add(table: pa.Table) -> pa.Table:
        parts, size = [], 0
        for z, n in zip(table.column("phrases"), table.column("counts")):
            lines = pa.array([zstandard.ZstdDecompressor().decompress(z.as_py())], pa.large_binary())
            parts.append(pa.table([pc.split_pattern(lines, "\n").flatten(),
                                   pa.array(blocks.unpack_counts(n.as_py()).astype(np.int64))], ["phrase", "f"]))
            size += len(parts[-1])
            if size >= MERGE_KEYS:
                parts, size = [_added(parts, "phrase")], 0
        whole = _added(parts, "phrase")
        whole = whole.filter(pc.greater_equal(whole.column("f"), at_least))
        phrase = whole.column("phrase")
        words = pc.add(pc.count_substring(phrase, " ").cast(pa.int32()), pa.scalar(1, pa.int32()))
        return pa.table([pa.array([table.column("lang")[0].as_py()] * len(whole), pa.string()), words,
                         phrase.cast(pa.large_string(), safe=False).cast(pa.string()), whole.column("f")],
                        ["lang", "words", "phrase", "f"])

    return sent.groupBy("lang", "p").applyInArrow(add, "lang string, words int, phrase string, f long")


def count_phrases(docs: DataFrame, at_least: int = AT_LEAST,
                  block_words: int = blocks.BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, f) of all phrases of up to ORDER words that occur
    ``at_least`` times, and (lang, n) with all words of every language."""
    staged = stage(language_blocks(docs, block_words), "phrase-blocks")
    ranges = blocks.Ranges(blocks.ranges_for(documents(docs)), KEY_BITS)
    named = stage(frequent_keys(summaries(staged, ranges), at_least), "phrase-keys", release=True)
    empty = {"lang": "string", "z": "binary", "named": "binary"}
    own = staged.select("t", "lang", "z", F.lit(None).cast("binary").alias("named"))
    told = named.select("t", *(F.lit(None).cast(empty[c]).alias(c) for c in ("lang", "z")), "named")
    exact = exact_counts(phrase_counts(own.unionByName(told), ranges), at_least)
    return stage(exact, "phrase-counts", release=True), staged.groupBy("lang").agg(F.sum("n_words").alias("n"))


def collocations(docs: DataFrame, at_least: int = AT_LEAST, top: int = TOP,
                 block_words: int = blocks.BLOCK_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases."""
    counts, sizes = count_phrases(docs, at_least, block_words)
    phrases = counts.filter("words > 1").withColumn("w", F.split("phrase", " "))
    wide = "decimal(20,0)"

    # a phrase inside a longer one that has most of its occurrences goes
    inner = phrases.filter("words > 2").select(
        "lang", F.col("f").alias("around"), F.explode(F.expr(
            "flatten(transform(sequence(2, words - 1), size -> "
            "transform(sequence(1, words - size + 1), i -> array_join(slice(w, i, size), ' '))))")).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    left = phrases.join(inner, ["lang", "phrase"], "left").filter(F.expr(
        f"around is null or 100 * cast(around as {wide}) < {COVERED} * cast(f as {wide})"))

    cuts = left.select("lang", "phrase", F.col("f").alias("a"), "words", "w",
                       F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("head"),
                       F.expr("array_join(slice(w, k + 1, words - k), ' ')").alias("tail"))
    part = counts.select("lang", "phrase", "f")
    cuts = (cuts.join(part.toDF("lang", "head", "l"), ["lang", "head"])
            .join(part.toDF("lang", "tail", "r"), ["lang", "tail"]))
    score = F.expr(f"(cast(2000000 as decimal(7,0)) * cast(a as {wide})) div (cast(l as {wide}) + cast(r as {wide}))")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("least"))
    order = Window.partitionBy("lang").orderBy(F.col("least.score").desc(), F.col("a").desc(), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "least.l",
                                           "least.r", "n", "least.score")
