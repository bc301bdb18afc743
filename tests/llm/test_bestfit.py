import random
import re

from cellstar.llm import bestfit


def brute(length, source, cluster, capacity):
    bins, where = [], []
    for n, s, c in zip(length, source, cluster):
        fit = [(b[0], i) for i, b in enumerate(bins) if b[0] >= n and s not in b[1] and c not in b[2]]
        if not fit:
            bins.append([capacity, set(), set()])
            fit = [(capacity, len(bins) - 1)]
        i = min(fit)[1]
        where.append(i)
        bins[i][0] -= n
        bins[i][1].update([s] if s is not None else [])
        bins[i][2].update([c] if c is not None else [])
    return where


def test_tightest_compatible_bin():
    rng = random.Random(1)
    for _ in range(300):
        n, cap = rng.randint(0, 150), rng.choice([1, 7, 64, 100])
        length = sorted((rng.randint(0, cap) for _ in range(n)), reverse=True)
        source = [rng.choice([None, "a", "a", "b", "c", "d"]) for _ in length]
        cluster = [rng.choice([None, rng.randint(0, n)]) for _ in length]
        assert bestfit.pack_shard(length, source, cluster, cap)[0] == brute(length, source, cluster, cap)


def test_documents_are_packed_whole(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = bestfit.pack(docs, capacity=512, shard_pieces=200).collect()
    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs.collect()}
    pieces, bins = {}, {}
    for r in out:
        pieces.setdefault(r.doc_id, []).append((r.start_word, r.n_words))
        bins.setdefault(r.bin, []).append(r)
    assert {d: sum(n for _, n in p) for d, p in pieces.items()} == words
    for own in bins.values():
        own.sort(key=lambda r: (r.offset, r.n_words))
        assert own[0].offset == 0 and all(a.offset + a.n_words == b.offset for a, b in zip(own, own[1:]))
        assert own[-1].offset + own[-1].n_words <= 512
        assert len({r.source for r in own}) == len(own) == len({r.cluster for r in own})


def test_repeated_long_rows_never_share_a_bin(spark):
    """Copies of long rows, with one id and with none: capacity and conflicts of every bin."""
    long, other = " ".join(f"w{i}" for i in range(250)), " ".join(f"v{i}" for i in range(200))
    rows = [(7, long, "a")] * 3 + [(7, long, "b")] + [(None, long, "a")] * 2 + [(None, other, None)] * 2 + [(8, "x y", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    out = bestfit.pack(docs, capacity=100).collect()
    assert sum(r.n_words for r in out) == 6 * 250 + 2 * 200 + 2
    bins = {}
    for r in out:
        bins.setdefault(r.bin, []).append(r)
    for own in bins.values():
        own.sort(key=lambda r: r.offset)
        assert all(a.offset + a.n_words == b.offset for a, b in zip(own, own[1:]))
        assert sum(r.n_words for r in own) <= 100
        sources = [r.source for r in own if r.source is not None]
        assert len(set(sources)) == len(sources) and len({r.cluster for r in own}) == len(own)


def test_copies_of_one_row_are_spread(spark):
    """100,000 copies of a row without an id: no shard holds more than its portion."""
    from pyspark.sql import functions as F
    rows = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b c").alias("text"),
                                       F.lit(None).cast("string").alias("source")).repartition(6)
    numbers = bestfit.number_copies(bestfit.lengths(rows, "source")).select("copy")
    assert numbers.agg(F.min("copy"), F.max("copy"), F.count_distinct("copy")).first()[:] == (1, 100_000, 100_000)
    out = bestfit.pack(rows, capacity=64, shard_pieces=2000)
    shards = out.groupBy(F.substring_index("bin", "-", 1).alias("s")).count().collect()
    assert len(shards) == 50 and max(r["count"] for r in shards) < 3000
    assert out.select("bin").distinct().count() == 100_000      # one cluster: no two in a bin
