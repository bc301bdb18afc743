import hashlib
import random

import pytest
import sentencepiece

from cellstar.llm import piece_codec, registry


@pytest.fixture(scope="module")
def both():
    model = registry.vocabulary("piece_bpe_32k.model")
    return sentencepiece.SentencePieceProcessor(model_file=model), piece_codec.PieceCodec(model)


def test_equals_library(both):
    sp, own = both
    rng = random.Random(4)
    letters = "ab \t\n\n  ▁éß漢字🙂́\x00<s></s>theingon's 123,.<unk><0x41>"
    texts = ["", " ", "  ", "▁▁a  b", "<s> hello </s>", "\x00\x01", "漢字漢字", "a" * 300, " " * 100 + "x", "<0x41>",
             "x\n\ny ", "�", "​ abc def"] + [
        "".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    for t in texts:
        ids = sp.encode(t)
        assert own.encode(t) == ids, t
        text = sp.decode(ids + [2])
        assert own.decode(ids + [2]) == text, t
        assert own.digest(t) == (len(ids) + 1, hashlib.sha256(" ".join(map(str, ids + [2])).encode()).hexdigest(),
                                 hashlib.sha256(text.encode()).hexdigest())


def test_compatibility_equals_merging(both):
    _, own = both
    rng = random.Random(5)
    pieces = rng.sample(sorted(own.id_of), 600)
    for a, b in zip(pieces, pieces[1:]):
        if not b.startswith(piece_codec.MARK) and own.stands(a) and own.stands(b):
            assert own.compatible(a, b) == (own.merge(a + b) == [a, b]), (a, b)


def test_query(spark, both):
    sp, _ = both
    rows = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in registry.QUERIES["op8_piece_codec"](spark, "/root/testdata/sf0.001").collect():
        ids = sp.encode(rows[r.doc_id] or "") + [2]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_memory_is_bounded_by_bytes(both, monkeypatch):
    """Words of every length: results as the library's, what is remembered stays below its bound."""
    sp, _ = both
    monkeypatch.setattr(piece_codec.PieceCodec, "REMEMBER", 40_000)
    own = piece_codec.PieceCodec(registry.vocabulary("piece_bpe_32k.model"))
    rng = random.Random(7)
    for size in (3, 30, 64, 65, 3000):
        for _ in range(60):
            t = "".join(rng.choice("abcdeé漢🙂0/+") for _ in range(size)) + " and the"
            assert own.encode(t) == sp.encode(t)
            assert max(map(len, own.words)) <= 64
            for kept in (own.words, own.former):
                assert sum(4 * len(w) + len(ids) + 150 for w, ids in kept.items()) <= 40_000
