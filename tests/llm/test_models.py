"""Language ID and toxicity: probabilities, calibration and held-out accuracy."""

import numpy as np

from cellstar.llm import kneser_ney as kn
from cellstar.llm import toxicity as tx

SF = "/root/testdata/sf0.01"


def gram(text):
    a, b, c = (0 if x == " " else ord(x) for x in text)
    return a << 42 | b << 21 | c


def test_trigrams():
    text, found = kn.trigrams(["Ab, c", "", "12 3", "éЖ漢"])
    assert found[text == 0].tolist() == [gram(x) for x in (" ab", "ab ", "b c", " c ")]
    assert found[text == 3].tolist()[:2] == [gram(" éж"), gram("éж漢")]
    assert set(text.tolist()) == {0, 3}


def counted(texts):
    return [np.unique(kn.trigrams([t])[1], return_counts=True) for t in texts]


def test_probabilities_sum_to_one():
    m = kn.Model(["x", "y"], counted(["the cat and the dog and the bird " * 20, "der hund und die katze und das tier " * 20]))
    unseen = ord("ж")
    for context in (" t", "th", "qz", "ж ", "жж", "nd"):
        head = gram(context + " ") >> 21 << 21
        follow = head | np.append(m.symbol[np.isin(m.symbol, np.unique(m.symbol))], unseen)
        assert np.allclose(np.exp(m.logs(follow)).sum(0), 1, atol=1e-4), context
    assert (np.diff(m.tri.astype(object)) > 0).all()


def test_probabilities_equal_the_plain_formula():
    """Interpolated Kneser-Ney with plain counters."""
    import collections
    texts = ["the cat and the dog and then the bird", "der hund und die katze und das tier dort", "кот и пёс и кит"]
    m = kn.Model(["a", "b", "c"], counted(texts))
    every = {x for t in texts for x in kn.trigrams([t])[1].tolist()}
    size = len({g & kn.ONE for g in every}) + 1
    asked = sorted(every | {gram(x) for x in ("zzz", " кo", "th ", "жжж", "e t", "а б")})
    got = m.logs(np.array(asked))
    for i, t in enumerate(texts):
        c3 = collections.Counter(kn.trigrams([t])[1].tolist())
        c2 = collections.Counter(g & kn.TWO for g in c3)
        c1 = collections.Counter(g & kn.ONE for g in c2)

        def level(counts, context, g, lower):
            ones, twos = (sum(v == k for v in counts.values()) for k in (1, 2))
            d = ones / (ones + 2 * twos) if ones and twos else 0.5
            own = {x: v for x, v in counts.items() if x >> 21 == context}
            if not own:
                return lower
            return max(counts.get(g, 0) - d, 0) / sum(own.values()) + d * len(own) / sum(own.values()) * lower

        for g, p in zip(asked, np.exp(got[:, i])):
            ones, twos = (sum(v == k for v in c1.values()) for k in (1, 2))
            d = ones / (ones + 2 * twos) if ones and twos else 0.5
            p1 = max(c1.get(g & kn.ONE, 0) - d, 0) / sum(c1.values()) + d * len(c1) / sum(c1.values()) / size
            p2 = level(c2, (g & kn.TWO) >> 21, g & kn.TWO, p1)
            assert abs(level(c3, g >> 21, g, p2) / p - 1) < 1e-4


def test_scripts_beyond_latin(spark):
    """Two languages of one alphabet, and two samples of ideographs, are told apart by their letters."""
    import random
    rng = random.Random(3)
    pools = {"ru": "что это как его она они был для мы по из за так вы же от ещё бы".split(),
             "bg": "че това как той тя те беше за ние по от със така вие още щеше във към".split(),
             "zh": [chr(0x4E00 + k) for k in range(0, 3000, 3)], "ja": [chr(0x4E00 + k) for k in range(1, 3000, 3)]}
    rows = []
    for i in range(400):
        lang = list(pools)[i % 4]
        rows.append((i, ("" if lang in ("zh", "ja") else " ").join(rng.choice(pools[lang]) for _ in range(120)), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = kn.identify(docs, kn.train(docs), "lang").collect()
    assert all(r.lang == r.lang_pred and not r.rejected for r in out)
    counts = [kn.count_trigrams(docs.filter(f"doc_id < {n}")).count() for n in (100, 400)]
    assert counts[1] > 2 * counts[0]        # what is learned grows with the texts


def test_tables_equal_arrays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = spark.createDataFrame([(-1, None, "en"), (-2, "", "fr"), (-3, "漢字 ж", None)], "doc_id long, text string, lang string")
    docs = docs.select("doc_id", "text", "lang").union(rows)
    one, two = (kn.train(docs, local=x) for x in (True, False))
    assert isinstance(two.model, kn.Tables) and np.allclose(one.bounds, two.bounds, rtol=1e-5)
    key = lambda r: r.doc_id
    a, b = (sorted(kn.identify(docs, x, "lang").collect(), key=key) for x in (one, two))
    assert [(r.doc_id, r.held_out, r.lang, r.lang_pred, r.rejected) for r in a] == \
        [(r.doc_id, r.held_out, r.lang, r.lang_pred, r.rejected) for r in b]
    assert np.allclose([(r.score, r.cross_entropy) for r in a], [(r.score, r.cross_entropy) for r in b], atol=1e-4)


def test_language_held_out(spark):
    docs = spark.read.parquet(SF + "/documents.parquet")
    out = kn.identify(docs, kn.train(docs), "lang").collect()
    held = [r for r in out if r.held_out]
    assert len(out) == docs.count() and held
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in out) and not any(r.rejected for r in out if r.lang_pred != "und")


def test_language_rejection(spark):
    docs = spark.read.parquet(SF + "/documents.parquet")
    odd = spark.createDataFrame([(1, None), (2, "12 !"), (3, "щжюя ъыэх щщжж " * 30)], "doc_id long, text string")
    out = {r.doc_id: r for r in kn.identify(odd, kn.train(docs)).collect()}
    assert out[1].lang_pred == out[2].lang_pred == "und" and out[1].rejected and out[2].rejected
    assert out[3].rejected and out[3].lang_pred != "und" and out[3].score == 0


def test_isotonic():
    rng = np.random.default_rng(1)
    raw = rng.normal(size=400).round(1)
    y = (rng.random(400) < 1 / (1 + np.exp(-2 * raw))).astype(float)
    x, v = tx.isotonic(raw, y)
    assert (np.diff(v) >= 0).all() and abs(np.interp(raw, x, v).mean() - y.mean()) < 1e-9


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    t = tx.Trees()
    t.fit(x[:2000], y[:2000])
    assert ((t.raw(x[2000:]) > 0) == (y[2000:] > 0)).mean() > 0.95


def test_features():
    lexicon = frozenset(["idiot", "lowei*"])
    f = dict(zip(tx.FEATURES, tx.features("You IDIOT! an 1d10t, loweisch xx", lexicon)))
    assert (f["hits"], f["near_person"], f["hidden_hits"], f["exclamations"]) == (2, 2, 1, 1 / 6)
    assert tx.features("", lexicon)[:3] == [0, 0, 0]


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = tx.score(docs, tx.train(docs, labels)).join(labels, "doc_id").collect()
    assert all(0 <= r.score <= 1 for r in out)
    unseen = [r for r in out if r.held_out]
    found, toxic = [r for r in unseen if r.predicted], [r for r in unseen if r.toxic]
    right = sum(r.toxic for r in found)
    assert toxic and right / len(toxic) > 0.6       # recall
    assert right / len(found) > 0.9                 # precision


def test_tree_scores_equal_a_plain_walk():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 5))
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0.3).astype(float)
    t = tx.Trees()
    t.fit(x[:400], y[:400])

    def walk(row):
        total = t.base
        for feature, cut, leaf in t.trees:
            node = 0
            for _ in range(tx.DEPTH):
                j = feature[node]
                node = 2 * node + (2 if sum(c < row[j] for c in t.cuts[j]) > cut[node] else 1)
            total += leaf[node - (2 ** tx.DEPTH - 1)]
        return total

    assert np.allclose(t.raw(x[400:]), [walk(r) for r in x[400:]])


def test_lexicon_counts_all_labelled_documents(spark, monkeypatch):
    """A toxic word of few documents, far more labels than the sample, most of them without a document."""
    import random
    from cellstar.llm.common import held_out
    from pyspark.sql import functions as F
    monkeypatch.setattr(tx, "SAMPLE_ROWS", 40)
    rng = random.Random(6)
    ids = [r.id for r in spark.range(3000).filter(~held_out(F.col("id"))).orderBy("id").limit(1200).collect()]
    texts, toxic = [], []
    for k, i in enumerate(ids):
        rare = k % 100 < 2
        common = not rare and k % 4 == 0
        texts.append(" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + "xyzw"[rng.randrange(4)] for _ in range(20))
                     + (" zqrare" if rare else " grumbl" if common else ""))
        toxic.append(int(rare or common))
    seen = []
    learn = tx.learn_lexicon
    monkeypatch.setattr(tx, "learn_lexicon", lambda rows: seen.append(learn(rows)) or seen[-1])
    fitted = []
    fit = tx.fit
    monkeypatch.setattr(tx, "fit", lambda x, y, lexicon: fitted.append(len(y)) or fit(x, y, lexicon))
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    labels = spark.createDataFrame(list(zip(ids, toxic)), "doc_id long, toxic int").union(
        spark.range(10 ** 6, 10 ** 6 + 4000).selectExpr("id", "0"))
    classifier = tx.train(docs, labels)
    assert {"zqrare", "grumbl"} <= seen[0] and fitted == [40]
    assert classifier.trees is not None
