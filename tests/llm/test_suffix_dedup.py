import collections
import hashlib
import random

import numpy as np
import pytest

from cellstar.llm import induced, suffix_dedup


def windows(text, length):
    found = collections.defaultdict(list)
    raw = text.tobytes()
    for i in range(len(raw) - length + 1):
        found[raw[i:i + length]].append(i)
    return sorted(map(tuple, found.values()))


@pytest.mark.parametrize("memory", [1 << 20, 32])
def test_induced_sorting_groups(memory, monkeypatch):
    """Groups of equal windows, with all queues in memory and with nearly all on disk."""
    monkeypatch.setattr(induced, "BLOCK", 64)
    rng = np.random.default_rng(1)
    for trial in range(150):
        n, size, length = int(rng.integers(1, 500)), int(rng.integers(1, 6)), int(rng.integers(1, 40))
        t = rng.integers(97, 97 + size, n).astype(np.uint8)
        if trial % 3 == 0 and n > 50:
            k = int(rng.integers(5, n // 2))
            t = np.concatenate([t, t[:k], t[k // 2:k], np.full(int(rng.integers(0, 150)), 97, np.uint8), t[:k]])
        if trial % 7 == 0:
            t[rng.integers(0, len(t))] = 255
            t[rng.integers(0, len(t))] = 0
        found = collections.defaultdict(list)
        for pos, group in induced.equal_windows(t, length, memory):
            for p, g in zip(pos.tolist(), group.tolist()):
                if p + length <= len(t):
                    found[g].append(p)
        assert sorted(tuple(sorted(v)) for v in found.values()) == windows(t, length)


def brute(rows, length):
    first = {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        for i in range(len(raw) - length + 1):
            first.setdefault(raw[i:i + length], (d, i))
    out = {}
    for d, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if first[raw[i:i + length]] < (d, i):
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot, flush", [(5000, 200_000), (10, 500)])
def test_against_brute_force(spark, monkeypatch, hot, flush):
    """Whole documents, and planted copies, runs, overlaps and a passage with a
    different context in each of many documents (beyond HOT in the second run)."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "FLUSH", flush)
    rng = random.Random(3)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    text = [r[1] for r in rows]
    noise = lambda: "".join(rng.choice("abcdefg hij") for _ in range(120))
    rows += [(10 ** 6 + i, None if i == 0 else "" if i == 1 else "a" * 350 if i < 4 else "ab" * 200 + "x" * i if i < 8
              else text[i][:300] + "é" * i + text[5][50:700] + "-" * 130) for i in range(40)]
    rows += [(2 * 10 ** 6 + i, noise() + text[7][:400] + noise()) for i in range(60)]
    docs = spark.createDataFrame(rows + [rows[3]], "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
           for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == brute(rows, 100)


def test_long_text_in_slices(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 1000)
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefghij klmno") for _ in range(7000))
    rows = [(1, base), (2, base[3000:5000] + "q" * 10 + base[100:350]), (3, base[:90])]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
           for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows, 100)


def test_rows_without_an_id_are_documents_of_their_own(spark):
    """Null and shared ids with texts of different lengths: each row by itself."""
    from pyspark.sql import functions as F
    rng = random.Random(11)
    noise = lambda k: "".join(rng.choice("abcdefg hij") for _ in range(k))
    shared = [noise(300) for _ in range(4)]
    rows = [(None, None), (None, ""), (None, "short"), (None, noise(150))]
    rows += [(None, noise(100 + 50 * i) + shared[i % 4] + noise(80 * i)) for i in range(8)]
    rows += [(5, shared[1][:250] + noise(40)), (5, noise(700) + shared[2] + noise(10)), (5, "tiny")]
    rows += [(100 + i, noise(60 * i) + shared[i % 4][20:] + noise(90)) for i in range(8)]
    rows += [(200 + i, noise(400)) for i in range(4)]
    rows += [rows[6], rows[12]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    text = F.coalesce("text", F.lit(""))
    order = {(r.doc_id, r.text): r.ver for r in docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("ver"))
             .collect()}
    place = sorted(order, key=lambda k: (k[0] is not None, k[0] or 0, order[k]))
    want = brute(list(enumerate(t for _, t in place)), 100)
    want = sorted(want[place.index((d, t or ""))] for d, t in rows)
    got = [(r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
           for r in suffix_dedup.remove_repeats(docs).collect()]
    assert sorted(got) == want


def edges_of_a_passage(rng, copies):
    """Documents that share passages, each between texts of its own; some come twice."""
    noise = lambda k: "".join(rng.choice("abcdefg hij") for _ in range(k))
    shared = [noise(260) for _ in range(3)]
    rows = [(i, noise(rng.randrange(90, 160)) + shared[i % 3] + noise(rng.randrange(40, 130))) for i in range(copies)]
    return rows + [(copies + i, rows[i][1][30:400]) for i in range(0, copies, 5)]


@pytest.mark.parametrize("hot", [5000, 8])
def test_bounds_change_no_result(spark, monkeypatch, hot):
    """Small bounds on what a worker holds: the same bytes go."""
    for name, value in {"HOT": hot, "FLUSH": 300, "PACKED": 7, "HELD": 60, "RUN": 500, "CUT": 1000}.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    rows = edges_of_a_passage(random.Random(5), 60)
    docs = spark.createDataFrame(rows + rows[:9] * 20, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
           for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == brute(rows, 100)


def test_sorted_together():
    """A shard's text is sorted in runs of whole minimisers, whatever the shard has,
    and a row that comes often adds nothing to it."""
    import pyarrow as pa

    rng = random.Random(2)
    m = np.sort(np.array([rng.randrange(500) for _ in range(6000)]))
    rows = [(int(x), i, 0, 0, 1, bytes([97 + i % 20]) * 100) for i, x in enumerate(m) for _ in range(1 + 300 * (i == 7))]
    table = pa.table([pa.array(list(c), t) for c, t in zip(zip(*rows), (
        pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
        ["m", "doc", "ver", "start", "n", "bytes"])
    runs = [pa.Table.from_batches(r) for r in suffix_dedup.whole_minimisers(iter(table.to_batches(max_chunksize=256)), 4000)]
    most = max(np.bincount(m)) * 100
    assert len(runs) > 50 and max(sum(map(len, r["bytes"].to_pylist())) for r in runs) < 4000 + 2 * most
    of = [set(r["m"].to_pylist()) for r in runs]
    assert sum(map(len, of)) == len(set.union(*of)) == len(set(m.tolist()))
    assert [d for r in runs for d in r["doc"].to_pylist()] == list(range(6000))


def test_bucket_holds_little():
    """A minimiser that very many segments share doesn't stay in the worker that meets it."""
    bucket, rng, sent, most = suffix_dedup.Bucket(100, 50, 1000), np.random.default_rng(4), [], 0
    for at in range(0, 40_000, 200):
        rows = np.zeros(200, suffix_dedup._ROW)
        rows["doc"], rows["m"], rows["dig"], rows["n"] = np.arange(at, at + 200), 5, np.arange(at, at + 200), 1
        rows["dig"][::4], rows["m"][1::4], rows["dig"][1::4] = 1, rng.integers(10, 20), 2
        sent += bucket.add(rows)
        most = max(most, bucket.held)
    sent += bucket.end()
    assert most <= 1200
    kinds = collections.Counter(k for b in sent for k in b.column("kind").to_pylist())
    assert 2 in kinds and sum(kinds.values()) >= 40_000 - 11
    docs = [d for b in sent for d in b.column("doc").to_pylist()]
    assert len(docs) == len(set(docs))
