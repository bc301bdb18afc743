"""Every stage of the pipeline against its operator, on its own input."""

import hashlib
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as cp  # noqa: E402
from cellstar.llm import kneser_ney, toxicity  # noqa: E402
from test_parity_join import shingle  # noqa: E402
from test_suffix_dedup import brute  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(SF + "/documents.parquet")
    out = [docs.collect()]
    for name, stage in cp.STAGES:
        docs = cp.stage(stage(spark, docs, SF), "test")
        out.append(docs.collect())
    return out


def test_filters(spark, steps):
    docs = spark.read.parquet(SF + "/documents.parquet")
    scores = toxicity.score(docs, toxicity.train(docs, spark.read.parquet(SF + "/labels.parquet")))
    clean = {r.doc_id for r in scores.collect() if not r.predicted}
    assert {r.doc_id for r in steps[1]} == clean
    first = spark.createDataFrame(steps[1], docs.schema)
    found = kneser_ney.identify(first, kneser_ney.train(first)).collect()
    assert {r.doc_id for r in steps[2]} == {r.doc_id for r in found if not r.rejected}
    assert all(r == next(x for x in steps[0] if x.doc_id == r.doc_id) for r in steps[2])


def test_one_of_each_group_stays(steps):
    rows = sorted(steps[2], key=lambda r: r.doc_id)
    sets = {r.doc_id: shingle(r.text, 5) for r in rows}
    kept = {r.doc_id for r in steps[3]}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = list(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            k = len(x & y)
            if k and 100 * k >= 80 * (len(x) + len(y) - k):
                u, v = sorted((root(a), root(b)))
                parent[v] = u
    assert kept == {d for d in ids if root(d) == d}


def test_passages_and_packing(steps):
    want = brute([(r.doc_id, r.text) for r in steps[3]], 100)
    before = {r.doc_id: r for r in steps[3]}
    assert [f for f in steps[4][0].asDict()] == [f for f in steps[0][0].asDict()]
    for r in steps[4]:
        assert r.n_chars == len(r.text) and (r.lang, r.source) == (before[r.doc_id].lang, before[r.doc_id].source)
        assert (r.text == before[r.doc_id].text) == (want[r.doc_id][1] == 0)
    assert {r.doc_id for r in steps[5]} == {r.doc_id for r in steps[4]}


def test_stages_take_edges(spark, edge_docs, no_docs):
    columns = ["doc_id", "text", "lang", "source", "n_chars", "key", "z", "rank_"]
    for docs in (edge_docs.select(columns), no_docs.select(columns)):
        for name, stage in cp.STAGES:
            docs = cp.stage(stage(spark, docs, SF), "test")
            if name != "packing":
                assert docs.columns == columns


def test_passages_sorted_in_bounded_runs(spark, monkeypatch):
    """However much text a shard of repeated_passages has, little of it is sorted
    at a time; one partition holds the whole here."""
    import random

    from cellstar.llm import induced, suffix_dedup
    from test_suffix_dedup import edges_of_a_passage

    def bounded(text, length, real=induced.equal_windows):
        assert len(text) < 8_000
        return real(text, length)

    monkeypatch.setattr(suffix_dedup, "equal_windows", bounded)
    monkeypatch.setattr(suffix_dedup, "RUN", 1_000, raising=False)
    rows = edges_of_a_passage(random.Random(6), 90)
    docs = spark.createDataFrame([(d, t, "en", "src", len(t)) for d, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = {r.doc_id: r.text for r in cp.repeated_passages(spark, docs, SF).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = brute(rows, 100)
    assert {d: hashlib.sha256(t.encode()).hexdigest() for d, t in got.items()} == {d: w[3] for d, w in want.items()}
