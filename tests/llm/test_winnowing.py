import hashlib
import random

import numpy as np

from cellstar.llm import winnowing as wn


def test_windows_against_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("abé🙂 ") for _ in range(rng.randint(0, 120)))
        points = wn.code_points(text)
        at, hashes = wn.winnow(points, 4, 6)
        if len(text) < 4:
            assert len(at) == bool(text)
            continue
        h = wn.rolling_hashes(points, 4).tolist()
        assert all((h[i] == h[j]) == (text[i:i + 4] == text[j:j + 4]) for i in range(len(h)) for j in range(i))
        want = []
        for s in range(max(1, len(h) - 5)):
            window = h[s:s + 6]
            best = s + max(i for i, x in enumerate(window) if x == min(window))
            if best not in want:
                want.append(best)
        assert at.tolist() == sorted(want) and hashes.tolist() == [h[i] for i in sorted(want)]


def test_match_guarantee():
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    for _ in range(50):
        shared = word(wn.W + wn.K - 1)
        a, b = (set(wn.winnow(wn.code_points(word(rng.randint(0, 300)) + shared + word(rng.randint(0, 300))))[1].tolist())
                for _ in range(2))
        assert a & b


def test_neighbours_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(3 * i, "".join(rng.choice("abcdefgh \n") for _ in range(rng.randint(0, 900)))) for i in range(60)]
    rows[10] = (30, rows[9][1])
    rows[20] = (60, None)
    got = {r.doc_id: r for r in wn.compare_neighbours(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    texts = [(i, t or "") for i, t in rows]
    for k, (i, text) in enumerate(texts):
        following = texts[k - 1][1]     # the first id's next one is the last
        m = len(text) // 3
        edited = text[:len(text) - m] + following[:m]
        own, other = (wn.winnow(wn.code_points(t)) for t in (text, edited))
        sets = [set(wn.winnow(wn.code_points(t))[1].tolist()) for t in (text, edited, following)]
        near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (wn.encode(*own), wn.encode(*other))
        assert np.allclose([r.near_edited, r.near_next], near)


def test_single_document_is_its_own_neighbour(spark):
    r = wn.compare_neighbours(spark.createDataFrame([(5, "abc" * 50)], "doc_id long, text string")).collect()
    assert len(r) == 1 and r[0].near_next == 1.0
