import random
import re

import numpy as np
import pytest

from cellstar.llm import parity_join, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle(text, width):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else \
        frozenset([tuple(w)] if w else [])


def test_shingle_sets():
    texts = ["", "A b c d e", "a B c d e", "a\tb\nc", "a b c", " x ", "é É x y z é É x y", "one two three four"]
    raw = "".join(texts).encode()
    ends = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    text, h = shingles.shingle_sets(np.frombuffer(raw, np.uint8), ends, 4)
    sets = [frozenset(h[text == i].tolist()) for i in range(len(texts))]
    want = [shingle(t, 4) for t in texts]
    assert list(map(len, sets)) == list(map(len, want))
    assert all((sets[i] & sets[j] == frozenset()) == (want[i] & want[j] == frozenset())
               for i in range(len(texts)) for j in range(i))


def test_linked_pairs_always_share_a_part():
    """The sketch argument by itself: any pair at the threshold meets in a scheme."""
    rng = np.random.default_rng(2)
    bands = parity_join.Bands(85, 10_000)
    for _ in range(300):
        n = int(rng.integers(1, 800))
        a = rng.integers(0, 2 ** 63, n).astype(np.uint64)
        keep = a[rng.random(n) < rng.uniform(0.85, 1)]
        b = np.concatenate((keep, rng.integers(0, 2 ** 63, int(rng.integers(0, n // 10 + 1))).astype(np.uint64)))
        x, y = set(a.tolist()), set(b.tolist())
        if x == y or 100 * len(x & y) < 85 * len(x | y):
            continue
        keys = []
        for s in (x, y):
            h = np.array(sorted(s), np.uint64)
            count = np.array([len(h)])
            zero = np.zeros(len(h), np.int64)
            keys.append(set().union(*(parity_join.signatures(zero, h, count, bands, below)[1].tolist()
                                      for below in (False, True))))
        assert keys[0] & keys[1]


@pytest.mark.parametrize("common, flush, percent, width", [(64, 400_000, 85, 4), (3, 2000, 80, 5)])
def test_against_all_pairs(spark, monkeypatch, common, flush, percent, width):
    monkeypatch.setattr(parity_join, "COMMON", common)
    monkeypatch.setattr(parity_join, "FLUSH", flush)
    monkeypatch.setattr(parity_join, "BLOCK", 3 if common == 3 else 2048)
    rng = random.Random(3)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for k in range(10):  # chains and stars of near copies around the threshold
        base = rows[20 + k][1].split()
        for c in range(14):
            w = list(base)
            for _ in range(max(1, len(w) * c // 220)):
                w[rng.randrange(len(w))] = f"zz{rng.randrange(999)}"
            rows.append((3 * 10 ** 6 + 100 * k + c, " ".join(w)))
    passage = " ".join(f"w{i}" for i in range(60))
    rows += [(4 * 10 ** 6 + i, passage + " " + " ".join(f"v{rng.randrange(10 ** 6)}" for _ in range(90))) for i in range(40)]
    rows += [(5 * 10 ** 6, "A b  c"), (5 * 10 ** 6 + 1, "a\tB c"), (5 * 10 ** 6 + 2, "a b"), (6 * 10 ** 6, None)]
    sets = [(d, shingle(t, width)) for d, t in rows]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and percent * max(len(x), len(y)) <= 100 * min(len(x), len(y)):
                k = len(x & y)
                if 100 * k >= percent * (len(x) + len(y) - k):
                    u, v = sorted((root(a), root(b)))
                    parent[v] = u
    want = {d: (len(x), root(d)) for d, x in sets}
    docs = spark.createDataFrame(rows + [rows[4]], "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in parity_join.similarity_components(docs, percent, width).collect()}
    assert got == want


def test_sketches_never_drop_a_linked_pair():
    rng = np.random.default_rng(4)
    for _ in range(60):
        base = rng.integers(0, 2 ** 63, int(rng.integers(1, 400))).astype(np.uint64)
        sets = [np.unique(np.concatenate((base[rng.random(len(base)) < rng.uniform(0.8, 1)],
                                          rng.integers(0, 2 ** 63, int(rng.integers(0, 20))).astype(np.uint64))))
                for _ in range(8)]
        sets = [x for x in sets if len(x)]
        if not sets:
            continue
        n = np.array([len(x) for x in sets])
        no = parity_join.unlike(n, [parity_join.dense_sketch(x) for x in sets], 85)
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                both = len(np.intersect1d(x, y))
                if 100 * both >= 85 * (len(x) + len(y) - both):
                    assert not no[i, j]


def test_components(spark):
    rng = random.Random(7)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(150)]
    got = {r.id: r.component for r in parity_join.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        u, v = sorted((root(a), root(b)))
        parent[v] = u
    assert got == {x: root(x) for a, b in pairs if a != b for x in (a, b)}


@pytest.mark.parametrize("sets, rare, columns", [(4096, 4096, 2048), (16, 4, 8)])
def test_links_are_counted_exactly(spark, monkeypatch, sets, rare, columns):
    """A group of near copies, a chain and a pair: every set's number of links."""
    for name, value in (("COUNT_SETS", sets), ("RARE", rare), ("COLUMNS", columns)):
        monkeypatch.setattr(parity_join, name, value)
    rng = random.Random(12)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(200)]
    rows = []
    for i in range(70):   # differently edited, so some pairs are linked and some are not
        w = list(base)
        for _ in range(i % 5):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    for i in range(30):   # each is like its neighbours only
        rows.append((1000 + i, " ".join(f"c{k}" for k in range(8 * i, 8 * i + 150))))
    rows += [(2000, " ".join(base[:90]) + " x"), (2001, " ".join(base[:90]) + " y"), (2002, "by itself"), (2003, None)]
    rows += [(3000, rows[3][1]), rows[4]]
    by_set = {}
    for d, t in rows:
        by_set.setdefault(shingle(t, 4), set()).add(d)
    distinct = [x for x in by_set if x]
    want = {d: sum(y != x and 100 * len(x & y) >= 85 * len(x | y) for y in distinct) for x in by_set for d in by_set[x]}
    assert max(want.values()) > 20
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = parity_join.similarity_components(docs).collect()
    assert len(got) == len(rows) and {r.doc_id: r.n_links for r in got} == want


@pytest.mark.parametrize("seed", [0, 1])
def test_shared_and_missing_ids_equal_all_pairs(spark, seed):
    """Ids are names only: components and links follow the sets."""
    rng = random.Random(seed)
    q, r, s, t = ([f"{c}{k}" for k in range(60)] for c in "qrst")
    rows = [(3, " ".join(q)), (10, " ".join(q[:-1] + ["x"])), (4, " ".join(r)), (10, " ".join(r[:-1] + ["x"])),
            (5, " ".join(s)), (None, " ".join(s[:-1] + ["x"])), (None, " ".join(t)), (None, " ".join(t[:-1] + ["x"]))]
    for k in range(12):
        base = [f"b{k}_{i}" for i in range(rng.randint(6, 120))]
        for _ in range(rng.randint(1, 9)):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
            rows.append((rng.choice([None, *range(20, 40)]), " ".join(w)))
    rows += [(7, None), (7, "")] + [rng.choice(rows) for _ in range(5)]
    sets = [shingle(text, 4) for _, text in rows]
    distinct = sorted({x for x in sets if x}, key=sorted)
    like = {x: [y for y in distinct if y != x and 100 * len(x & y) >= 85 * len(x | y)] for x in distinct}
    of = {}
    for x in distinct:
        if x not in of:
            of[x], left = x, [x]
            while left:
                for y in like[left.pop()]:
                    if y not in of:
                        of[y] = x
                        left.append(y)
    least = {}
    for (d, _), x in zip(rows, sets):
        if x and d is not None:
            least[of[x]] = min(d, least.get(of[x], d))
    want = [(d, len(x), least.get(of[x]) if x else d, len(like[x]) if x else 0) for (d, _), x in zip(rows, sets)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in parity_join.similarity_components(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sorted((tuple(r) for r in parity_join.similarity_components(docs, links=False).collect()), key=repr) \
        == sorted((w[:3] for w in want), key=repr)
