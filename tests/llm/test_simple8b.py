import random
import zlib

import numpy as np
import pytest

from cellstar.llm import registry
from cellstar.llm import simple8b as sb

ADDED = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y", "a<|endoftext|><|endof text|>", "",
         " <|endoftext|>\n\nnext one  two", "plain words"]


@pytest.mark.parametrize("ids", [
    [], [0] * 5000, [2 ** 63, 1, 2 ** 64 - 1] * 700, list(range(3000)), [1] * 239 + [0] * 500 + [2 ** 61],
    [2 ** 60 - 1, 2 ** 60], [7] * 1023 + [50256] * 3])
def test_exact_round_trip(ids):
    ids = np.array(ids, np.uint64)
    blob = sb.pack_chunk([len(ids)], ids)
    counts, back = sb.unpack_chunk(blob)
    assert counts.tolist() == [len(ids)] and (back == ids).all()
    for k in range(-(-len(ids) // sb.BLOCK)):
        assert (sb.read_block(blob, k) == ids[k * sb.BLOCK:(k + 1) * sb.BLOCK]).all()


def test_random_widths():
    rng = np.random.default_rng(1)
    for _ in range(40):
        n = int(rng.integers(1, 4000))
        ids = rng.integers(0, 2 ** 63, n, dtype=np.uint64) >> rng.integers(0, 64, n).astype(np.uint64)
        assert (sb.decode(sb.encode(ids)[1], n) == ids).all()


def test_packs_tightly():
    ids = np.full(sb.BLOCK * 4, 40000, np.uint64)
    assert len(sb.encode(ids)[1]) <= 4 * -(-sb.BLOCK // 3)


def test_encoder_equals_library():
    import public_tokenizers as P
    rng = random.Random(4)
    letters = "ab \t\n\n  ▁éß漢字🙂́\x00theingon's 123,.<>"
    texts = ["", " ", "a  b", "a \n b", " \nb", "x\n\ny ", "don't we'll I'VE 3rd ½ x² _a_ a_b", "x<|endoftext|>y",
             "\x1c\x1d a\x85b", "aµb ªº ŉ'sx ''s", "a.b, c. d."] + [
        "".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    e = sb.PieceEncoder(registry.vocabulary("byte_bpe_50k.json"), P.PATTERN)
    for t in texts:
        assert np.frombuffer(e.encode(t), "<u4").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids, t


def test_query(spark):
    import public_tokenizers as P
    e = sb.PieceEncoder(registry.vocabulary("byte_bpe_50k.json"), P.PATTERN)
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect())
    got = {r.doc_id: r for r in registry.QUERIES["op6_simple8b"](spark, "/root/testdata/sf0.001").collect()}
    start = 0
    for i, text in docs:
        ids = e.tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        r = got[i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_added_tokens_equal_fresh_library(spark):
    """A text that holds an added token's literal, against a tokenizer as it is loaded."""
    import public_tokenizers as P
    from tokenizers import Tokenizer
    path = registry.vocabulary("byte_bpe_50k.json")
    fresh = Tokenizer.from_file(path)
    ids = [fresh.encode(t, add_special_tokens=False).ids for t in ADDED]
    assert ids[0] == [64, 220, 50256, 275]
    e = sb.PieceEncoder(path, P.PATTERN)
    assert [np.frombuffer(e.encode(t), "<u4").tolist() for t in ADDED] == ids
    docs = spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string")
    got = {r.doc_id: r for r in sb.read_ids(sb.write_ids(docs, path, P.PATTERN, 0)).collect()}
    start = 0
    for i, own in enumerate(ids):
        own = own + [0]
        assert (got[i].start, got[i].n_tokens) == (start, len(own))
        assert got[i].ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        start += len(own)


def test_random_texts_equal_fresh_library():
    import public_tokenizers as P
    from tokenizers import Tokenizer
    path = registry.vocabulary("byte_bpe_50k.json")
    fresh, e = Tokenizer.from_file(path), sb.PieceEncoder(path, P.PATTERN)
    rng = random.Random(8)
    pieces = ["<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "a", "don't", "é", "漢", "."]
    for _ in range(1500):
        t = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(e.encode(t), "<u4").tolist() == fresh.encode(t, add_special_tokens=False).ids, t


def test_memory_is_bounded_by_bytes(monkeypatch):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    path = registry.vocabulary("byte_bpe_50k.json")
    monkeypatch.setattr(sb.PieceEncoder, "PIECES", 20_000)
    monkeypatch.setattr(sb.PieceEncoder, "UNITS", 20_000)
    fresh, e = Tokenizer.from_file(path), sb.PieceEncoder(path, P.PATTERN)
    rng = random.Random(9)
    for size in (3, 30, 64, 65, 3000):
        for _ in range(60):
            t = "and " + "".join(rng.choice("abcdeé漢🙂0/+") for _ in range(size)) + " the"
            assert np.frombuffer(e.encode(t), "<u4").tolist() == fresh.encode(t, add_special_tokens=False).ids, t
            for kept in (e.pieces, e.pieces.former, e.units, e.units.former):
                assert all(len(k) <= 64 for k in kept)
                assert sum(4 * len(k) + len(v) + 150 for k, v in kept.items()) <= 20_000


def test_mixed_white_space_equals_library():
    """A run of different white space is one piece, and its signs may merge."""
    import public_tokenizers as P
    e = sb.PieceEncoder(registry.vocabulary("byte_bpe_50k.json"), P.PATTERN)
    for t in ["a \xa0 \xa0 b", "a\n\xa0 b c", "a \xa0 \xa0", "x\n\n\xa0\xa0 y z"]:
        assert np.frombuffer(e.encode(t), "<u4").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids, t


def test_many_texts_equal_fresh_library():
    import public_tokenizers as P
    import pyarrow as pa
    from tokenizers import Tokenizer
    path = registry.vocabulary("byte_bpe_50k.json")
    fresh, e = Tokenizer.from_file(path), sb.PieceEncoder(path, P.PATTERN)
    rng = random.Random(10)
    parts = [" ", " ", " ", "\n", "\t", "\r\n", "\xa0", "\u3000", "\x1c", "the", "The", "né", "漢", "🙂", "12", "don't", "'s", ".",
             ",", "###", "'", "<|endoftext|>", "²", "\x00"]
    texts = ADDED + ["", " ", "\n", "  ", "\n\n", "  a", "\n\nb", " \nc ", "a\n", "a \n", "a\n\n", "a  b", "a\n b\n\nc", "\r"] + [
        "".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    want = [fresh.encode(t, add_special_tokens=False).ids + [7] for t in texts]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    for limit in (1, 100, 1 << 23):
        some = list(sb.groups(iter([batch.slice(0, 5), batch.slice(5, 0), batch.slice(5)]), limit))
        assert [i for b in some for i in b.column("doc_id").to_pylist()] == list(range(len(texts)))
        found = [e.encode_all(b.column("text"), 7) for b in some]
        assert [n for sizes, _ in found for n in sizes.tolist()] == [len(w) for w in want]
        assert np.concatenate([ids for _, ids in found]).tolist() == [i for w in want for i in w]


def test_each_distinct_unit_is_found_once(monkeypatch):
    """Texts of a group share the work on their units, whatever the tables can hold."""
    import public_tokenizers as P
    import pyarrow as pa
    monkeypatch.setattr(sb.PieceEncoder, "PIECES", 1)
    monkeypatch.setattr(sb.PieceEncoder, "UNITS", 1)
    e, calls = sb.PieceEncoder(registry.vocabulary("byte_bpe_50k.json"), P.PATTERN), []
    e.units.find = lambda unit: calls.append(unit) or e._unit(unit)
    e.encode_all(pa.array([" ".join(["", *map(str, range(50))])] * 40), 0)
    assert sorted(calls) == sorted(["\r", *map(str, range(50))])
