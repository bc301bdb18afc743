"""Toxicity by gradient-boosted trees over dense features, calibrated.

Features of a whole text: densities of a learned lexicon, hits near a second
person, capitals, punctuation and obfuscation rates. The lexicon are the words,
and the stems of words, whose share of toxic documents speaks most clearly for toxicity, counted over
all labelled training documents. The trees (histogram splits, logistic loss)
and the isotonic calibration are fitted on a bounded sample of these.

An empty or null text has features of zero and a score like any other. Labels
that are null are left out; with no labelled rows every score is 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstar.llm.common import documents, held_out, lean, schema, stage

#: Labelled training documents that the trees and the calibration are fitted on.
SAMPLE_ROWS = 12_000
#: Words of the lexicon, least toxic documents with a word, and least ratio of
#: its share among toxic to that among other documents.
LEXICON, MIN_DOCUMENTS, MIN_RATIO = 256, 5, 8.0
#: Letters that begin a word and count for it, as inflected words share a stem.
STEM = 5
TREES, DEPTH, RATE, BINS = 60, 3, 0.15, 32
#: Words between a hit and a second-person word that count as near.
NEAR = 4

#: Second-person words (fixed values).
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros vuestro".split())
#: Signs written for letters (fixed values).
DISGUISE = str.maketrans("013457@$!", "oieastasi")

FEATURES = ("hits", "hits_per_word", "distinct_hits", "near_person", "near_per_word", "person_per_word",
            "hidden_hits", "hidden_per_word", "capital_words", "capitals", "exclamations", "questions",
            "punctuation", "symbols", "digits", "repeats", "log_words")

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = ".,;:!?\"'()[]{}<>«»“”„…-*#&%$|"
_REPEAT = re.compile(r"([^\W\d_])\1\1")


def features(text: str, lexicon: frozenset[str]) -> list[float]:
    words = _WORD.findall(text)
    n = max(len(words), 1)
    size = max(len(text), 1)
    low = [w.strip(_EDGE) for w in text.lower().split()] if len(words) else []
    hits = [i for i, w in enumerate(low) if w in lexicon or w[:STEM] + "*" in lexicon]
    person = [i for i, w in enumerate(low) if w in SECOND_PERSON]
    near = 0
    if hits and person:
        people = np.array(person)
        after = np.searchsorted(people, hits)
        for h, k in zip(hits, after.tolist()):
            near += any(abs(h - people[j]) <= NEAR for j in (k - 1, k) if 0 <= j < len(people))
    # words that only their disguise keeps out of the lexicon
    hidden = sum(1 for w in low if not w.isalpha() and w not in lexicon and w.translate(DISGUISE) in lexicon)
    capital = sum(1 for w in words if len(w) > 2 and w.isupper())
    count = text.count
    signs = {c: count(c) for c in ".,;:!?-#*$%&|<>"}
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    upper = int(np.count_nonzero((raw >= 65) & (raw <= 90)))
    digits = int(np.count_nonzero((raw >= 48) & (raw <= 57)))
    return [len(hits), len(hits) / n, len({low[i] for i in hits}), near, near / n, len(person) / n,
            hidden, hidden / n, capital / n, upper / size, signs["!"] / n, signs["?"] / n,
            sum(signs[c] for c in ".,;:!?-") / size, sum(signs[c] for c in "#*$%&|<>") / size, digits / size,
            len(_REPEAT.findall(text)) / n, float(np.log1p(len(words)))]


class Trees:
    """Boosted regression trees on binned features; ``DEPTH`` levels each."""

    def __init__(self):
        self.cuts, self.trees, self.base = [], [], 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Fit, and return the raw scores of the fitted rows."""
        for j in range(x.shape[1]):
            values = np.unique(x[:, j])
            if len(values) > BINS:
                values = np.unique(np.quantile(x[:, j][x[:, j] > values[0]], np.linspace(0, 1, BINS - 1)))
                self.cuts.append(np.concatenate((values[:1], (values[:-1] + values[1:]) / 2)))
            else:
                self.cuts.append((values[:-1] + values[1:]) / 2)
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)], 1)
        rate = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        self.base = float(np.log(rate / (1 - rate)))
        raw = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-raw))
            tree = self._grow(binned, y - p, p * (1 - p))
            self.trees.append(tree)
            raw += tree[2][self._leaves(tree, binned)]
        return raw

    def _grow(self, binned, gradient, weight):
        """(feature, cut bin) of every inner node, heap order; leaf values."""
        k = binned.shape[1]
        feature, cut = np.zeros(2 ** DEPTH - 1, int), np.full(2 ** DEPTH - 1, BINS + 1)
        node = np.zeros(len(binned), int)
        for level in range(DEPTH):
            first, width = 2 ** level - 1, 2 ** level
            best = np.zeros(width)
            for j in range(k):
                cell = (node - first) * (BINS + 2) + binned[:, j]
                g = np.bincount(cell, gradient, width * (BINS + 2)).reshape(width, -1).cumsum(1)
                h = np.bincount(cell, weight, width * (BINS + 2)).reshape(width, -1).cumsum(1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = g ** 2 / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all ** 2 / (h_all + 1)
                gain[(h < 1) | (h_all - h < 1)] = 0
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                better = top > best + 1e-9
                best[better] = top[better]
                feature[first:first + width][better] = j
                cut[first:first + width][better] = at[better]
            node = 2 * node + 1 + (binned[np.arange(len(node)), feature[node]] > cut[node])
        leaf = node - (2 ** DEPTH - 1)
        g, h = np.bincount(leaf, gradient, 2 ** DEPTH), np.bincount(leaf, weight, 2 ** DEPTH)
        return feature, cut, RATE * g / (h + 1)

    @staticmethod
    def _leaves(tree, binned):
        node = np.zeros(len(binned), int)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (binned[np.arange(len(node)), tree[0][node]] > tree[1][node])
        return node - (2 ** DEPTH - 1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)], 1)
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += tree[2][self._leaves(tree, binned)]
        return out


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the non-decreasing curve of least squares, pooling neighbours."""
    order = np.argsort(raw, kind="stable")
    x, first = np.unique(raw[order], return_index=True)
    weight = np.diff(np.append(first, len(raw))).astype(float)
    value = np.add.reduceat(y[order].astype(float), first) / weight
    pools: list[list[float]] = []   # value, weight, rows of x
    for v, w in zip(value.tolist(), weight.tolist()):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v2, w2, k2 = pools.pop()
            v1, w1, k1 = pools.pop()
            pools.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, k1 + k2])
    return x, np.repeat([p[0] for p in pools], [int(p[2]) for p in pools])


class Classifier:
    def __init__(self, lexicon: frozenset[str], trees: Trees | None, curve):
        self.lexicon, self.trees, self.curve = lexicon, trees, curve

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.trees is None or not texts:
            return np.zeros(len(texts))
        x = np.array([features(t, self.lexicon) for t in texts], float)
        return np.interp(self.trees.raw(x), *self.curve)


def fit(x: np.ndarray, y: np.ndarray, lexicon: frozenset[str]) -> Classifier:
    """Trees on all rows; the curve on scores that trees of the other half gave."""
    if not len(y) or y.min() == y.max():
        return Classifier(lexicon, None, None)
    half = np.arange(len(y)) % 2 == 0
    out = np.empty(len(y))
    for side in (half, ~half):
        if not side.any() or y[side].min() == y[side].max():
            return Classifier(lexicon, None, None)
        other = Trees()
        other.fit(x[side], y[side])
        out[~side] = other.raw(x[~side])
    trees = Trees()
    trees.fit(x, y)
    return Classifier(lexicon, trees, isotonic(out, y))


def learn_lexicon(once: DataFrame) -> frozenset[str]:
    """Words of toxic documents, by their share there against elsewhere, from
    rows (toxic, z), one for each different text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        toxic: dict[str, list[int]] = {}
        for batch in batches:
            for z, y in zip(batch.column("z").to_pylist(), batch.column("toxic").to_pylist()):
                text = unpack(z).decode("utf-8", "surrogatepass")
                own = {w.strip(_EDGE) for w in text.lower().split()}
                own = {w for w in own if w.isalpha()}
                for w in own | {w[:STEM] + "*" for w in own if len(w) > STEM}:
                    toxic.setdefault(w, [0, 0])[y] += 1
            if len(toxic) > 200_000:
                yield pack(toxic)
                toxic = {}
        yield pack(toxic)

    def pack(counts):
        pairs = np.array(list(counts.values()), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(pairs[:, 0].copy()),
                                           pa.array(pairs[:, 1].copy())], ["word", "clean", "toxic"])

    total = once.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    if not total.t or total.t == total.n:
        return frozenset()
    ratio = ((F.col("toxic") + 0.5) / F.lit(total.t + 1.0)) / ((F.col("clean") + 0.5) / F.lit(total.n - total.t + 1.0))
    words = (once.select("z", "toxic").mapInArrow(lean(run), "word string, clean long, toxic long").groupBy("word")
             .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
             .filter((F.col("toxic") >= MIN_DOCUMENTS) & (ratio >= MIN_RATIO))
             .orderBy((F.col("toxic") * F.log(ratio)).desc(), "word").limit(LEXICON).collect())
    return frozenset(r.word for r in words)


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Learn from the labelled documents that aren't held out."""
    known = labels.filter(F.col("toxic").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"),
                 pa.array([z(t.encode("utf-8", "surrogatepass")) for t in batch.column("text").to_pylist()],
                          pa.binary())], ["doc_id", "digest", "z"])

    data = documents(docs).filter(~held_out(F.col("doc_id"))).select(
        "doc_id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), "text")
    # ids, digests and labels first: they say which texts are needed
    rows = stage(data.select("doc_id", "digest").join(known, "doc_id").distinct(), "labelled")
    # copies of a text count once, or a copied document's words would stand out; toxic where one of them is
    first = rows.groupBy("digest").agg(F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id"))
    packed = data.mapInArrow(lean(pack), "doc_id long, digest binary, z binary")
    # the one exchange of texts, compressed, of one plan at every size
    once = stage(packed.join(first.hint("merge"), ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest"]), "once")
    lexicon = learn_lexicon(once.select("toxic", "z"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            x = [features(unpack(z).decode("utf-8", "surrogatepass"), lexicon) for z in batch.column("z").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"),
                                              pa.array(x, pa.list_(pa.float64()))], ["doc_id", "toxic", "x"])

    # fitted on the documents of least id hash; hashes far above the bound aren't sorted
    share = 1.2 * SAMPLE_ROWS / max(rows.count(), 1)
    least = F.xxhash64("doc_id")
    near = rows if share >= 1 else rows.filter(least < F.lit(int((share - 0.5) * 2.0 ** 64)))
    chosen = near.orderBy(least, "doc_id", "digest").limit(SAMPLE_ROWS)
    sample = once.select("digest", "z").join(F.broadcast(chosen), "digest")
    # at most SAMPLE_ROWS rows of numbers
    found = sample.select("doc_id", "toxic", "z").mapInArrow(
        lean(run), "doc_id long, toxic int, x array<double>").orderBy("doc_id", "x").toArrow()
    x = np.array(found.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    return fit(x, found.column("toxic").to_numpy().astype(float), lexicon)


def score(docs: DataFrame, classifier: Classifier, *keep) -> DataFrame:
    """doc_id, held_out, score, predicted and the columns kept, of every document."""
    data = documents(docs, held_out(F.col("doc_id").cast("long")).alias("held_out"), *keep)
    model = docs.sparkSession.sparkContext.broadcast(classifier)
    names = [f.name for f in data.schema.fields[2:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.clip(model.value.scores(batch.column("text").to_pylist()), 0, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(batch.column(k) for k in names), pa.array(s),
                 pa.array((s >= 0.5).astype(np.int32))], ["doc_id", *names, "score", "predicted"])

    return data.mapInArrow(lean(run), schema("doc_id long", data.schema.fields[2:], "score double, predicted int"))
