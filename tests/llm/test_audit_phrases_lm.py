"""Filter audit, phrase mining and language-model scoring against plain versions."""

import collections
import itertools
import math
import os
import random
import re
import time
import zlib

import numpy as np
import pytest

from cellstar.llm import backoff_lm, blocks, filter_audit, phrases, registry
from oracle_check import compare

TABLES = "/root/testdata/sf0.001"


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    status, a, b, _, info = compare(spark, duck, name, registry.QUERIES[name], registry.ORACLES[name], TABLES)
    assert status == "ok", f"{name}: {a} {b} {info}"


# --- blocks

def test_normalised_text_and_keys():
    rng = random.Random(1)
    for breaks in ("", phrases.BREAKS):
        for _ in range(300):
            texts = ["".join(rng.choice("aB \t\n.;é") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 6))]
            raw = [t.encode() for t in texts]
            ends = np.concatenate(([0], np.cumsum([len(b) for b in raw]))).astype(np.int64)
            out, new = blocks.normalise(np.frombuffer(b"".join(raw), np.uint8), ends, breaks)
            wanted = []
            for t in texts:
                pieces = re.split(r"[.,;:!?\x0A-\x0D]", lower(t)) if breaks else [lower(t)]
                pieces = [re.findall(r"[^\x20\x09]+" if breaks else r"[^\x20\x09-\x0D]+", p) for p in pieces]
                wanted.append("".join(" ".join(p) + "\n" for p in pieces if p))
            assert [out[a:b].tobytes().decode() for a, b in zip(new, new[1:])] == wanted
    for bits, count in ((32, 51), (48, 8), (48, 1), (64, 3)):
        ranges = blocks.Ranges(count, bits)
        keys = np.sort(ranges.cut(np.random.default_rng(1).integers(0, 2**64, 500, dtype=np.uint64)))
        parts = ranges.split(keys)
        assert [a for _, a, _ in parts] == [0, *(b for _, _, b in parts[:-1])] and parts[-1][2] == 500
        assert len({p for p, _, _ in parts}) == len(parts) <= count
        assert (blocks.unpack_keys(blocks.pack_keys(keys)) == keys).all()


# --- filter audit

def audit_plainly(rows, labels):
    good, toxic = collections.Counter(), collections.Counter()
    for d, q, t in labels:
        if d is not None:
            good[d] |= q == 1
            toxic[d] |= t == 1
    place = lambda d: (0, 0) if d is None else (1, d)
    first = {}
    for d, t, _ in rows:
        first[t or ""] = min(first.get(t or "", (2, 0)), place(d))
    parts = collections.defaultdict(list)
    for d, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {f for f, no in (("A", len(w) < 200), ("B", 100 * len(set(w)) < 50 * len(w)),
                                 ("C", 100 * len(re.findall("[A-Z]", t)) > 2 * len(t)),
                                 ("D", re.search(r"[#$%&*|]", t)), ("E", first[t] < place(d))) if no}
        parts[s or ""].append((fails, good[d], toxic[d]))
    out = []
    for part, docs in parts.items():
        cells, shapley = {}, collections.Counter()
        for order in itertools.permutations("ABCDE"):
            alive = docs
            for step, f in enumerate(order, 1):
                gone = [x for x in alive if f in x[0]]
                alive = [x for x in alive if f not in x[0]]
                cells["".join(order), step] = (
                    len(alive), len(gone), sum(f in x[0] for x in docs) - len(gone), sum(x[0] == {f} for x in docs),
                    sum(x[1] for x in gone), sum(x[2] for x in gone))
                shapley[f] += len(gone)
        out += [(part, o, k, *v, shapley[o[k - 1]]) for (o, k), v in cells.items()]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_applying_every_order(spark, seed):
    rng = random.Random(seed)
    texts = [None, ""] + [" ".join(rng.choice(["a", "B", "c#", "e%", "Foo"] + [f"w{i}" for i in range(rng.choice([1, 400]))])
                                   for _ in range(rng.choice([1, 5, 220, 400]))) for _ in range(25)]
    ids = [None, *range(60)]
    rows = [(rng.choice(ids), rng.choice(texts), rng.choice([None, "", "s1", "s2"])) for _ in range(120)]
    labels = [(rng.choice(ids), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'x' as mask", "1 as n")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "1 as part", "2 as good")
    assert sorted(map(tuple, filter_audit.audit(docs, known).collect())) == audit_plainly(rows, labels)
    assert filter_audit.audit(docs.limit(0), known).collect() == []
    no_labels = audit_plainly(rows, [])
    assert sorted(map(tuple, filter_audit.audit(docs, known.limit(0)).collect())) == no_labels


def test_audit_of_odd_rows(edge_docs, edge_rows, spark):
    labels = spark.createDataFrame([(1, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = sorted(map(tuple, filter_audit.audit(edge_docs, labels).collect()))
    assert got == audit_plainly([(r[0], r[1], r[3]) for r in edge_rows], [(1, 1, None), (None, 1, 1)])


def test_audit_intervals_cover_each_order_once():
    for mask in range(1, 32):
        cover = [0] * 121
        for m, _, rank, sign in filter_audit.intervals():
            if m == mask:
                cover[rank] += sign
        assert list(itertools.accumulate(cover[:120])) == [1] * 120


# --- phrases

def phrases_plainly(rows, at_least, top):
    f, n = collections.Counter(), collections.Counter()
    for _, t, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(t)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    found = {key: v for key, v in f.items() if v >= at_least and len(key[1]) > 1}
    gone = {(lang, w[i:i + k]) for (lang, w), v in found.items() for k in range(2, len(w))
            for i in range(len(w) - k + 1) if 100 * v >= 80 * f[lang, w[i:i + k]]}
    out = []
    for own in n:
        ranked = []
        for (lang, w), a in found.items():
            if lang == own and (lang, w) not in gone:
                cuts = [(f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
                score, _, lr = min((2000000 * a // (lr[0] + lr[1]), k, lr) for k, lr in enumerate(cuts))
                ranked.append((-score, -a, " ".join(w).encode(), *lr))
        out += [(own, i, p.decode(), -a, lf, r, n[own], -s)
                for i, (s, a, p, lf, r) in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("at_least,top,block_words", [(3, 50, 40), (30, 2000, 40), (1, 10**6, 10**6)])
def test_phrases_equal_counting_all(spark, at_least, top, block_words):
    rng = random.Random(3)
    words = ["a", "b", "C", "c", "ab", "é", "日", "z"]
    rows = [(i, None if i % 17 == 0 else "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ""])
                                                 for _ in range(rng.randint(0, 60))),
             rng.choice(["en", "de", None, "und", ""])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr(
        "*", "1 as t", "2 as p", "3 as f", "'x' as phrase").repartition(5)
    got = sorted(map(tuple, phrases.collocations(docs, at_least, top, block_words).collect()))
    assert got == phrases_plainly(rows, at_least, top)


def test_phrases_of_odd_rows(edge_docs, edge_rows, no_docs):
    got = sorted(map(tuple, phrases.collocations(edge_docs).collect()))
    assert got == phrases_plainly([(r[0], r[1], r[2]) for r in edge_rows], 30, 2000) and got
    assert phrases.collocations(no_docs).collect() == []


def test_summary_keeps_every_frequent_key():
    rng = np.random.default_rng(2)
    parts = [rng.zipf(1.3, 2000).astype(np.uint64) % np.uint64(5000) for _ in range(40)]
    everything = np.concatenate(parts)
    keys, n = np.unique(everything, return_counts=True)
    for at_least in (5, 30, 200):
        summary = phrases.Summary(len(everything) // at_least + 1)
        for part in parts:
            k, c = np.unique(part, return_counts=True)
            summary.merge([k], [c.astype(np.uint64)])
        assert summary.lost < at_least and len(summary.keys) <= summary.capacity
        assert set(keys[n >= at_least]) <= set(summary.keys)


def many_words(spark, n_docs, seed=5):
    rng = np.random.default_rng(seed)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.4, 500) % 20000) for _ in range(n_docs)]
    return spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string").coalesce(1)


def test_units_send_each_key_once_and_packed(spark):
    staged = phrases.stage(phrases.language_blocks(many_words(spark, 600), 12_000), "test-units")
    sizes = [r.n_words for r in staged.select("n_words").collect()]
    assert sum(sizes) == 300_000 and sum(n < 12_000 for n in sizes) <= 1     # none but the last is short
    ranges = blocks.Ranges(8, phrases.KEY_BITS)
    sent = phrases.summaries(staged, ranges).collect()
    assert len({(r.t, r.p) for r in sent}) == len(sent) and len({r.t for r in sent}) < len(sizes)
    distinct = sum(len(blocks.unpack_keys(r.keys)) for r in sent)
    assert sum(r.mass for r in sent) == 600 * (500 + 499 + 498 + 497)
    assert sum(len(r.keys) + len(r.counts) for r in sent) < 2.6 * distinct


def test_a_unit_sends_no_row_for_a_single_phrase(spark):
    docs = many_words(spark, 200)
    staged = phrases.stage(phrases.language_blocks(docs, 12_000), "test-units")
    ranges = blocks.Ranges(8, phrases.KEY_BITS)
    named = phrases.frequent_keys(phrases.summaries(staged, ranges), 5).selectExpr(
        "t", "cast(null as string) as lang", "cast(null as binary) as z", "named")
    told = staged.selectExpr("t", "lang", "z", "cast(null as binary) as named").unionByName(named)
    sent = phrases.phrase_counts(told, ranges).collect()
    assert 0 < len(sent) <= 8 * staged.select("t").distinct().count()
    counts = phrases.exact_counts(spark.createDataFrame(sent), 5)
    texts = [tuple(r.text.split(" ")) for r in docs.collect()]
    plain = collections.Counter(w[i:i + k] for w in texts for k in range(1, 5) for i in range(len(w) - k + 1))
    assert {(r.lang, r.words, r.phrase, r.f) for r in counts.collect()} == {
        ("en", len(w), " ".join(w), f) for w, f in plain.items() if f >= 5}


def test_a_unit_read_apart_counts_once(spark):
    docs = many_words(spark, 40)
    staged = phrases.stage(phrases.language_blocks(docs, 2_000), "test-units")
    apart = staged.repartition(7, "z")
    ranges = blocks.Ranges(8, phrases.KEY_BITS)

    def counts(one):
        named = phrases.frequent_keys(phrases.summaries(one, ranges), 3).selectExpr(
            "t", "cast(null as string) as lang", "cast(null as binary) as z", "named")
        told = one.selectExpr("t", "lang", "z", "cast(null as binary) as named").unionByName(named)
        return sorted(map(tuple, phrases.exact_counts(phrases.phrase_counts(told, ranges), 3).collect()))

    assert counts(apart) == counts(staged) != []


def test_shuffle_files_go_with_their_step(spark):
    def held():
        dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for top in dirs for _, _, names in os.walk(top) for f in names if re.match(r"shuffle_.*[.]data$", f)}

    before = held()
    counts, _ = phrases.count_phrases(many_words(spark, 100), 5, 12_000)
    for _ in range(40):     # they are removed in the background
        if not (left := held() - before):
            break
        time.sleep(0.25)
    assert not left and counts.count() > 0


# --- language model

def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 5 == 1


def scores_plainly(rows, mu):
    def tokens(t):
        return ["<s>", *re.findall(r"[^\x20\x09-\x0D]+", lower(t)), None]

    c, total, kinds = collections.Counter(), 0, set()
    for d, t in rows:
        if not held(d):
            w = tokens(t)
            total += len(w) - 1
            kinds |= set(w[1:])
            c.update(tuple(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1))

    def p(w, h):
        if not h:
            return (c[(w,)] + 0.5) / (total + 0.5 * (len(kinds) + 1))
        return (c[h + (w,)] + mu * p(w, h[1:])) / (c[h] + mu) if c[h] else p(w, h[1:])

    out = []
    for d, t in rows:
        w = tokens(t)
        out.append((d, held(d), len(w) - 1, sum(x in kinds for x in w[1:]), total,
                    sum(math.log10(p(x, ())) for x in w[1:]),
                    sum(math.log10(p(w[i], tuple(w[max(0, i - 2):i]))) for i in range(1, len(w)))))
    return out


def same_scores(got, wanted):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6), round(r[6], 6))
    got, wanted = sorted(map(tuple, got), key=key), sorted(wanted, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in wanted]
    assert [r[5:] for r in got] == [pytest.approx(r[5:], rel=1e-9, abs=1e-9) for r in wanted]


@pytest.mark.parametrize("block_words", [7, 25, 10**6])
def test_automaton_equals_the_formula(spark, block_words):
    rng = random.Random(4)
    words = ["a", "b", "C", "c", "ab", "é", "日", "x.", "z"]
    rows = [(rng.choice([None, *range(50)]),
             rng.choice([None, "", " \n", "".join(rng.choice(words) + rng.choice([" ", "\n", "  ", "\t"])
                                                  for _ in range(rng.randint(0, 90)))])) for _ in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 as t", "2 as p", "3 as row").repartition(5)
    same_scores(backoff_lm.score(docs, block_words).collect(), scores_plainly(rows, backoff_lm.MU))


def test_scores_of_odd_rows_and_without_training(edge_docs, edge_rows, no_docs, spark):
    same_scores(backoff_lm.score(edge_docs).collect(), scores_plainly([(r[0], r[1]) for r in edge_rows], backoff_lm.MU))
    assert backoff_lm.score(no_docs).collect() == []
    only = [d for d in range(40) if held(d)]
    rows = [(d, "a b c") for d in only]
    same_scores(backoff_lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect(),
                scores_plainly(rows, backoff_lm.MU))


def test_model_beats_its_base_on_held_out_texts(spark):
    rows = [r for r in registry.op13_backoff_lm(spark, TABLES).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
