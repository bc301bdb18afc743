"""Language identification by interpolated Kneser-Ney character trigrams.

A text counts as lower-case letters and single spaces (every run of other
characters is one space); a letter is its code point, whatever its script.
Trigram counts of all training documents are gathered by Spark; from them follow
the continuation counts of the lower orders and the interpolated probabilities,
looked up in sorted arrays of hashed grams.

Where the counts are few (LOCAL_GRAMS, as for languages with alphabets), all
languages' arrays are handed to the workers. Beyond that the model stays in
tables: documents become bounded blocks, each asks the hash partitions
(``blocks``) for the probabilities of its own trigrams, which joins of the count
tables give, and adds them up. Both ways compute the same numbers.

A document gets the language of least cross-entropy per trigram (the first in
order on ties). Calibration, on about CALIBRATION_ROWS labelled documents that the
counts leave out: a logistic curve from the margin to the second language, scaled
by the text's length, to the chance of being right (the score); and, by length, a
bound on the cross-entropy, beyond which a document resembles no learned
language (it is rejected, with score 0).

A null text, or one without a letter, is ``und`` with score 0 and counts as
rejected; rows with a null lang, or with the label ``und``, aren't learned
from. With no training rows at all every document is ``und``.
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
from cellstar.llm.common import documents, held_out, lean, mix64, schema, stage

UND = "und"
#: Documents, about, that calibrate the score and the rejection; their largest share of the labelled ones.
CALIBRATION_ROWS, CALIBRATION_SHARE = 2000, 0.1
#: A document is rejected beyond this multiple of the largest cross-entropy
#: that a right prediction of calibration, no shorter than it, had.
REJECT_BEYOND = 1.25
#: Counts up to which all workers get the whole model, and so many numbers in its largest table.
LOCAL_GRAMS, LOCAL_NUMBERS = 1_000_000, 8_000_000
#: Grams that a worker gathers before it adds them up, and distinct ones before it sends them.
GATHER, FLUSH = 1 << 22, 1 << 20
#: Characters that are looked up at a time, and bytes of text in a block.
CHARS, BLOCK_BYTES = 1 << 18, 1 << 22
#: A gram is three code points of 21 bits.
TWO, ONE = (1 << 42) - 1, (1 << 21) - 1

_table: np.ndarray | None = None


def symbols() -> np.ndarray:
    """Symbol of every code point: itself for a letter, 0 for all others."""
    global _table
    if _table is None:
        letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        _table = np.where(letter, np.arange(0x110000), 0).astype(np.int32)
    return _table


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, trigram) of all trigrams of the texts, in order."""
    low = "\n".join(t.lower().replace("\n", " ") for t in texts) + "\n"
    points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    end = points == 10
    text = np.cumsum(end) - end
    sym = symbols()[points]
    # a text's letters between single spaces: of a run of spaces the first stays, and each text begins with one
    keep = (sym > 0) | np.concatenate(([False], sym[:-1] > 0))
    sym, text = sym[keep].astype(np.int64), text[keep]
    begin = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1]))) if len(text) else []
    begin = [i for i in begin if sym[i] > 0]
    sym, text = np.insert(sym, begin, 0), np.insert(text, begin, text[begin])
    if len(sym) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    whole = text[2:] == text[:-2]
    gram = (sym[:-2] << 42) | (sym[1:-1] << 21) | sym[2:]
    return text[2:][whole], gram[whole]


def portions(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, about CHARS characters (at least one text) at a time."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) < CHARS):
            size += len(texts[end])
            end += 1
        yield texts[at:end]
        at = end


def count_trigrams(train: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows (doc_id, text, lang)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[np.ndarray]] = {}
        counts: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        held = 0

        def add_up():
            for lang, grams in waiting.items():
                old = counts.get(lang, (np.zeros(0, np.uint64), np.zeros(0, np.uint64)))
                new = np.concatenate(grams).astype(np.uint64)
                counts[lang] = blocks.counted(np.concatenate((old[0], new)),
                                              np.concatenate((old[1], np.ones(len(new), np.uint64))))
            waiting.clear()

        def send():
            add_up()
            for lang, (gram, n) in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(gram), pa.string()), pa.array(gram.astype(np.int64)), pa.array(n.astype(np.int64))],
                    ["lang", "gram", "n"])
            counts.clear()

        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for lang in sorted(set(langs)):
                for some in portions([t for t, own in zip(texts, langs) if own == lang]):
                    waiting.setdefault(lang, []).append(trigrams(some)[1])
                    held += len(waiting[lang][-1])
                    if held >= GATHER:
                        add_up()
                        held = 0
                        if sum(len(g) for g, _ in counts.values()) >= FLUSH:
                            yield from send()
        yield from send()

    return train.mapInArrow(lean(run), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def discount(counts: np.ndarray) -> float:
    return _discount(np.count_nonzero(counts == 1), np.count_nonzero(counts == 2))


def _discount(one: int, two: int) -> float:
    return one / (one + 2 * two) if one and two else 0.5


class Model:
    """Log probabilities of all languages, over sorted arrays of hashed grams."""

    def __init__(self, languages: list[str], counts: list[tuple[np.ndarray, np.ndarray]]):
        self.languages = languages
        # what can follow: every symbol of any language, and one for all others
        size = len(np.unique(np.concatenate([g & ONE for g, _ in counts]))) + 1 if counts else 1
        own = [self._levels(g, n, size) for g, n in counts]
        every = [np.union1d(o["uni"][0], o["head"][0]) for o in own]
        self.symbol = np.unique(np.concatenate(every)) if own else np.zeros(0, np.int64)
        self.rest = np.array([o["rest"] for o in own])
        self.uni = np.tile(self.rest, (len(self.symbol), 1)) if own else np.zeros((0, 0))
        self.weight = np.ones(self.uni.shape)
        for i, o in enumerate(own):
            self.uni[np.searchsorted(self.symbol, o["uni"][0]), i] = o["uni"][1]
            self.weight[np.searchsorted(self.symbol, o["head"][0]), i] = o["head"][1]
        grams = np.unique(np.concatenate([np.union1d(o["bi"][0], o["context"][0]) for o in own])) if own else self.symbol
        p, w = self._first(grams), np.ones((len(grams), len(own)))
        for i, o in enumerate(own):
            p[np.searchsorted(grams, o["bi"][0]), i] = o["bi"][1]
            w[np.searchsorted(grams, o["context"][0]), i] = o["context"][1]
        order = np.argsort(self.hashed(grams))
        self.bi, self.bi_prob, self.bi_weight = self.hashed(grams)[order], p[order], w[order]
        grams = np.unique(np.concatenate([g for g, _ in counts])) if own else self.symbol
        p = self._lower(grams)
        for i, (gram, _) in enumerate(counts):
            p[np.searchsorted(grams, gram), i] = own[i]["tri"]
        order = np.argsort(self.hashed(grams))
        self.tri, self.tri_log = self.hashed(grams)[order], np.log(p[order]).astype(np.float32)

    @staticmethod
    def hashed(gram: np.ndarray) -> np.ndarray:
        return mix64(gram.astype(np.uint64) + np.uint64(1))

    @staticmethod
    def _levels(gram: np.ndarray, n: np.ndarray, size: int) -> dict:
        """Probabilities of one language's seen grams, order by order, and the weights of contexts."""
        # continuation counts: distinct symbols before a bigram, before a symbol
        bi, bi_n = np.unique(gram & TWO, return_counts=True)
        uni, uni_n = np.unique(bi & ONE, return_counts=True)
        d1, total = discount(uni_n), uni_n.sum()
        rest = d1 * len(uni) / total / size
        p1 = (uni_n - d1) / total + rest
        d2 = discount(bi_n)
        heads, at, kinds = np.unique(bi >> 21, return_inverse=True, return_counts=True)
        head_n = np.bincount(at, bi_n)
        w2 = d2 * kinds / head_n
        p2 = (bi_n - d2) / head_n[at] + w2[at] * p1[np.searchsorted(uni, bi & ONE)]
        d3 = discount(n)
        contexts, at, kinds = np.unique(gram >> 21, return_inverse=True, return_counts=True)
        context_n = np.bincount(at, n)
        w3 = d3 * kinds / context_n
        p3 = (n - d3) / context_n[at] + w3[at] * p2[np.searchsorted(bi, gram & TWO)]
        return {"uni": (uni, p1), "rest": rest, "head": (heads, w2), "bi": (bi, p2), "context": (contexts, w3), "tri": p3}

    def _symbol(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.symbol, symbol), max(len(self.symbol) - 1, 0))
        return at, (self.symbol[at] == symbol if len(self.symbol) else np.zeros(len(symbol), bool))

    def _first(self, bigram: np.ndarray) -> np.ndarray:
        """Probability of bigrams from their second symbol alone."""
        if not len(self.symbol):
            return np.zeros((len(bigram), len(self.languages)))
        at, found = self._symbol(bigram & ONE)
        head, known = self._symbol(bigram >> 21)
        return np.where(found[:, None], self.uni[at], self.rest) * np.where(known[:, None], self.weight[head], 1)

    def _find(self, keys: np.ndarray, gram: np.ndarray):
        h = self.hashed(gram)
        at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
        return at, (keys[at] == h) if len(keys) else np.zeros(len(gram), bool)

    def _lower(self, gram: np.ndarray) -> np.ndarray:
        """Probability of trigrams that a language hasn't seen."""
        if not len(self.bi):
            return np.zeros((len(gram), len(self.languages)))
        at, found = self._find(self.bi, gram & TWO)
        p = np.where(found[:, None], self.bi_prob[at], self._first(gram & TWO))
        at, found = self._find(self.bi, gram >> 21)
        return p * np.where(found[:, None], self.bi_weight[at], 1)

    def logs(self, gram: np.ndarray) -> np.ndarray:
        at, found = self._find(self.tri, gram)
        logs = self.tri_log[at] if len(self.tri) else np.zeros((len(gram), len(self.languages)), np.float32)
        rest = np.flatnonzero(~found)
        if len(rest):
            logs[rest] = np.log(self._lower(gram[rest]))
        return logs

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(trigrams, cross-entropy by language) of every text."""
        text, gram = trigrams(texts)
        return averaged(text, self.logs(gram), len(texts))


def averaged(text: np.ndarray, logs: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(trigrams, cross-entropy by language) of texts whose trigrams' logs stand together."""
    n = np.bincount(text, minlength=texts)
    total = np.zeros((texts, logs.shape[1]))
    if len(text):
        begin = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
        total[text[begin]] = np.add.reduceat(logs, begin, axis=0, dtype=np.float64)
    return n, -total / np.maximum(n, 1)[:, None]


class Tables:
    """The model as tables, for more grams than a worker should hold."""

    def __init__(self, counts: DataFrame, languages: list[str]):
        spark = counts.sparkSession
        self.languages = languages
        index = spark.createDataFrame(list(enumerate(languages)), "i int, lang string")
        self.tri = stage(counts.join(F.broadcast(index), "lang").select("i", "gram", "n"), "trigrams")
        low = lambda c, bits: F.col(c).bitwiseAND(F.lit(bits))
        self.bi = stage(self.tri.groupBy("i", low("gram", TWO).alias("bc")).agg(F.count("*").alias("k")), "bigrams")
        self.uni = stage(self.bi.groupBy("i", low("bc", ONE).alias("c")).agg(F.count("*").alias("k")), "symbols")
        self.context = stage(self.tri.groupBy("i", F.shiftright("gram", 21).alias("ab")).agg(
            F.sum("n").alias("all3"), F.count("*").alias("kinds3")), "contexts")
        self.head = stage(self.bi.groupBy("i", F.shiftright("bc", 21).alias("b")).agg(
            F.sum("k").alias("all2"), F.count("*").alias("kinds2")), "heads")
        size = self.uni.select("c").distinct().count() + 1
        # one row a language
        seen = {name: {r.i: r for r in df.groupBy("i").agg(
            F.count_if(F.col(c) == 1).alias("one"), F.count_if(F.col(c) == 2).alias("two"), F.sum(c).alias("total"),
            F.count("*").alias("kinds")).collect()} for name, df, c in (("tri", self.tri, "n"), ("bi", self.bi, "k"),
                                                                        ("uni", self.uni, "k"))}
        rows = []
        for i in range(len(languages)):
            d1, d2, d3 = (_discount(seen[x][i].one, seen[x][i].two) for x in ("uni", "bi", "tri"))
            u = seen["uni"][i]
            rows.append((i, d1, d2, d3, float(u.total), d1 * u.kinds / u.total / size))
        self.scalars = rows

    def logs(self, grams: DataFrame) -> DataFrame:
        """``grams`` (p, gram; distinct) with ``logs``: log probability by language."""
        low = lambda c, bits: F.col(c).bitwiseAND(F.lit(bits))
        names = ("i", "d1", "d2", "d3", "total", "rest")
        each = F.array(*(F.struct(*(F.lit(v).alias(c) for c, v in zip(names, r))) for r in self.scalars))
        asked = grams.select("*", F.inline(each)).select(   # a row for each language
            "*", low("gram", TWO).alias("bc"), low("gram", ONE).alias("c"),
            F.shiftright("gram", 21).alias("ab")).withColumn("b", F.shiftright("bc", 21))
        bi, uni = (df.withColumnRenamed("k", k) for df, k in ((self.bi, "k2"), (self.uni, "k1")))
        for df, key in ((self.tri, "gram"), (self.context, "ab"), (bi, "bc"), (self.head, "b"), (uni, "c")):
            asked = asked.join(df, ["i", key], "left")
        part = lambda c, d, all_: F.coalesce((F.col(c) - F.col(d)) / F.col(all_), F.lit(0.0))
        weight = lambda d, kinds, all_: F.coalesce(F.col(d) * F.col(kinds) / F.col(all_), F.lit(1.0))
        p1 = part("k1", "d1", "total") + F.col("rest")
        p2 = part("k2", "d2", "all2") + weight("d2", "kinds2", "all2") * p1
        p3 = part("n", "d3", "all3") + weight("d3", "kinds3", "all3") * p2
        return asked.select("p", "gram", "i", F.log(p3).cast("float").alias("log")).groupBy("p", "gram").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("i", "log"))), lambda x: x["log"]).alias("logs"))


def _dealt(gram: np.ndarray, count: int) -> np.ndarray:
    return (mix64(gram.astype(np.uint64) + np.uint64(1)) % np.uint64(count)).astype(np.int64)


def _asked(texts: list[str], count: int) -> tuple[np.ndarray, np.ndarray]:
    """(partition, gram) of the distinct trigrams of the texts, in that order."""
    gram = np.unique(np.concatenate([trigrams(some)[1] for some in portions(texts)] or [np.zeros(0, np.int64)]))
    p = _dealt(gram, count)
    order = np.lexsort((gram, p))
    return p[order], gram[order]


def table_entropies(data: DataFrame, tables: Tables) -> DataFrame:
    """``data`` (doc_id, text, ...) without its text, with n (trigrams) and h (cross-entropy by language)."""
    kept = [f for f in data.schema.fields if f.name != "text"]
    count = blocks.ranges_for(data)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, waiting, size = TaskContext.get().partitionId() << 40, 0, [], 0

        def block():
            nonlocal made
            made += 1
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, waiting[0].schema) as writer:
                for part in waiting:
                    writer.write_batch(part)
            z = zstandard.ZstdCompressor(level=3).compress(out.getvalue().to_pybytes())
            return pa.RecordBatch.from_arrays([pa.array([task + made]), pa.array([z], pa.binary())], ["t", "z"])

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                size += batch.nbytes
            if size >= BLOCK_BYTES:
                yield block()
                waiting, size = [], 0
        if waiting:
            yield block()

    def unpack(z: bytes) -> pa.Table:
        return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(z)).read_all()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, z in zip(batch.column("t").to_pylist(), batch.column("z").to_pylist()):
                p, gram = _asked(unpack(z).column("text").to_pylist(), count)
                edge = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1], [True]))) if len(p) else np.zeros(1, int)
                parts = list(zip(edge[:-1].tolist(), edge[1:].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t] * len(parts), pa.int64()), pa.array([int(p[a]) for a, _ in parts], pa.int64()),
                     pa.array([blocks.pack_keys(gram[a:b].astype(np.uint64)) for a, b in parts], pa.binary())],
                    ["t", "p", "keys"])

    def distinct(table: pa.Table) -> pa.Table:
        gram = np.unique(np.concatenate([blocks.unpack_keys(k.as_py()) for k in table.column("keys")])).astype(np.int64)
        return pa.table([pa.array([table.column("p")[0].as_py()] * len(gram), pa.int64()), pa.array(gram)], ["p", "gram"])

    def answer(table: pa.Table) -> pa.Table:
        model = table.filter(table.column("gram").is_valid())
        gram = model.column("gram").to_numpy()
        order = np.argsort(gram)
        logs = np.array(model.column("logs").to_pylist(), np.float32).reshape(len(gram), -1)[order]
        gram, rows = gram[order], []
        for t, p, keys in zip(*(table.column(c).to_pylist() for c in ("t", "p", "keys"))):
            if keys is not None:
                own = np.searchsorted(gram, blocks.unpack_keys(keys).astype(np.int64))
                rows.append((t, p, zstandard.ZstdCompressor(level=1).compress(logs[own].tobytes())))
        return pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))],
                        ["t", "p", "logs"])

    k = len(tables.languages)
    out_schema = schema("", kept, "n long, h array<double>")

    def add_up(table: pa.Table) -> pa.Table:
        (z,) = [x.as_py() for x in table.column("z") if x.is_valid]
        parts = sorted((p, x) for p, x in zip(table.column("p").to_pylist(), table.column("logs").to_pylist()) if x is not None)
        rows = unpack(z)
        texts = rows.column("text").to_pylist()
        p, gram = _asked(texts, count)
        logs = np.frombuffer(b"".join(zstandard.ZstdDecompressor().decompress(x) for _, x in parts), np.float32).reshape(-1, k)
        order = np.argsort(gram)
        gram, logs = gram[order], logs[order]
        n, h = [], []
        for some in portions(texts):
            text, own = trigrams(some)
            own_n, own_h = averaged(text, logs[np.searchsorted(gram, own)], len(some))
            n.append(own_n)
            h.append(own_h)
        h = np.concatenate(h)
        return pa.table([*(rows.column(f.name) for f in kept), pa.array(np.concatenate(n).astype(np.int64)),
                         pa.array(list(h), pa.list_(pa.float64()))], [*(f.name for f in kept), "n", "h"])

    staged = stage(data.mapInArrow(lean(pack), "t long, z binary"), "language-blocks")
    asked = stage(staged.mapInArrow(lean(ask), "t long, p long, keys binary"), "language-asked")
    model = tables.logs(asked.groupBy("p").applyInArrow(distinct, "p long, gram long"))
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    told = (asked.select("t", "p", "keys", none("long", "gram"), none("array<float>", "logs"))
            .unionByName(model.select(none("long", "t"), "p", none("binary", "keys"), "gram", "logs"))
            .groupBy("p").applyInArrow(answer, "t long, p long, logs binary"))
    return (staged.select("t", "z", none("long", "p"), none("binary", "logs"))
            .unionByName(told.select("t", none("binary", "z"), "p", "logs"))
            .groupBy("t").applyInArrow(add_up, out_schema))


class Identifier:
    """A model (``Model`` or ``Tables``) and its calibration."""

    def __init__(self, model, slope: float = 1.0, offset: float = 0.0, bounds: list[float] | None = None):
        self.model, self.slope, self.offset = model, slope, offset
        self.bounds = bounds or []      # by the length's power of two

    @staticmethod
    def margin(n: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Nats by which the best language leads, on a logarithmic scale."""
        if h.shape[1] < 2:
            return np.log1p(n)
        two = np.partition(h, 1, axis=1)
        return np.log1p((two[:, 1] - two[:, 0]) * n)

    def decide(self, n: np.ndarray, h: np.ndarray):
        """(language, score, cross-entropy, rejected) from trigrams and cross-entropies."""
        languages = self.model.languages
        if not languages:
            k = len(n)
            return [UND] * k, np.zeros(k), np.zeros(k), np.ones(k, bool)
        best, least, none = h.argmin(1), h.min(1), n == 0
        score = 1 / (1 + np.exp(-np.clip(self.slope * self.margin(n, h) + self.offset, -30, 30)))
        bounds = np.array([*self.bounds, float("inf")])
        power = np.log2(np.maximum(n, 1)).astype(int)
        bound = bounds[np.minimum(power, max(len(bounds) - 2, 0))]
        rejected = none | (least > bound)
        score[rejected] = 0
        return [UND if z else languages[b] for b, z in zip(best, none)], score, np.where(none, 0, least), rejected


def calibrate(model, right: np.ndarray, n: np.ndarray, margin: np.ndarray, least: np.ndarray) -> Identifier:
    """Logistic regression (Newton steps, slightly damped) of being right on the
    margin; bounds by length from the right ones."""
    if not len(right):
        return Identifier(model)
    x = np.stack([margin, np.ones(len(margin))], 1)
    target = np.where(right > 0, 1 - 1 / (right.sum() + 2), 1 / (len(right) - right.sum() + 2))
    w = np.array([1.0, 0.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2), x.T @ (target - p) - 0.1 * w * [1, 1])
    n, least = n[right > 0], least[right > 0]
    bounds = []
    if len(n):
        # shorter texts vary more: a bound holds for its length and all greater ones that calibration saw;
        # none is known for texts shorter than all of calibration
        for power in range(int(np.log2(n.max())) + 1):
            bounds.append(float(least[n >= 1 << power].max() * REJECT_BEYOND) if n.min() < 2 << power else float("inf"))
    return Identifier(model, max(float(w[0]), 1e-3), float(w[1]), bounds)


def entropies(data: DataFrame, model) -> DataFrame:
    """``data`` (doc_id, text, ...) without its text, with n and h."""
    if isinstance(model, Tables):
        return table_entropies(data, model)
    shared = data.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in data.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.entropies(some) for some in portions(batch.column("text").to_pylist())]
            n = np.concatenate([x for x, _ in found] or [np.zeros(0, np.int64)])
            h = [row for _, x in found for row in x]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(n.astype(np.int64)), pa.array(h, pa.list_(pa.float64()))],
                [*(f.name for f in kept), "n", "h"])

    return data.mapInArrow(lean(run), schema("", kept, "n long, h array<double>"))


def _matrix(column, languages: int) -> np.ndarray:
    return np.array(column.to_pylist(), float).reshape(-1, max(languages, 1))


def train(docs: DataFrame, local: bool | None = None) -> Identifier:
    """Learn from the rows with a lang that aren't held out. ``local`` overrides
    the size check that decides where the model is kept."""
    rows = documents(docs, F.col("lang").cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & (F.col("lang") != UND) & ~held_out(F.col("doc_id")))
    share = min(CALIBRATION_SHARE, CALIBRATION_ROWS / max(rows.select("lang").count(), 1))
    # by id: about CALIBRATION_ROWS rows at any size, left out of the counts
    apart = F.xxhash64("doc_id") < F.lit(int((share - 0.5) * 2.0 ** 64))
    counts = stage(count_trigrams(rows.filter(~apart)), "trigram-counts")
    size = counts.agg(F.count("*").alias("rows"), F.count_distinct("gram").alias("grams"),
                      F.collect_set("lang").alias("languages")).first()
    languages = sorted(size.languages)
    if local is None:
        local = size.rows <= LOCAL_GRAMS and size.grams * len(languages) <= LOCAL_NUMBERS
    if local:   # bounded by the check above
        table = counts.orderBy("lang", "gram").toArrow()
        langs = table.column("lang").to_numpy()
        gram, n = table.column("gram").to_numpy(), table.column("n").to_numpy()
        model = Model(languages, [(gram[langs == x], n[langs == x]) for x in languages])
    else:
        model = Tables(counts, languages)
    if not languages:
        return Identifier(Model([], []))
    found = entropies(rows.filter(apart).select("doc_id", "text", "lang"), model).select("lang", "n", "h").toArrow()
    n, h = found.column("n").to_numpy(), _matrix(found.column("h"), len(languages))
    use = n > 0
    right = np.array([languages[b] == own for b, own in zip(h.argmin(1), found.column("lang").to_pylist())], float) \
        if len(n) else np.zeros(0)
    return calibrate(model, right[use], n[use], Identifier.margin(n, h)[use], h.min(1)[use])


def identify(docs: DataFrame, identifier: Identifier, *keep) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cross_entropy, rejected and the columns kept."""
    data = documents(docs, held_out(F.col("doc_id").cast("long")).alias("held_out"), *keep)
    found = entropies(data, identifier.model)
    names = [f.name for f in data.schema.fields[2:]]
    k = len(identifier.model.languages)
    rule = Identifier(_Names(identifier.model.languages), identifier.slope, identifier.offset, identifier.bounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, entropy, rejected = rule.decide(batch.column("n").to_numpy(), _matrix(batch.column("h"), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(batch.column(c) for c in names), pa.array(lang, pa.string()),
                 pa.array(score), pa.array(entropy), pa.array(np.asarray(rejected, bool))],
                ["doc_id", *names, "lang_pred", "score", "cross_entropy", "rejected"])

    return found.mapInArrow(lean(run), schema("doc_id long", data.schema.fields[2:],
                                              "lang_pred string, score double, cross_entropy double, rejected boolean"))


class _Names:
    """The languages of a model, without it."""

    def __init__(self, languages: list[str]):
        self.languages = languages
