"""Every operator on null, empty, tied, repeated, long and clashing input, and on no rows."""

import pytest

from cellstar.llm import (bestfit, html_extract, kneser_ney, parity_join, piece_codec, quality_rules, registry,
                          simple8b, suffix_dedup, toxicity, winnowing)


def _ids(docs):
    import public_tokenizers
    return simple8b.read_ids(simple8b.write_ids(docs, registry.vocabulary("byte_bpe_50k.json"),
                                                public_tokenizers.PATTERN, 0))


def _toxicity(docs):
    return toxicity.score(docs, toxicity.train(docs, docs.selectExpr("doc_id", "cast(n_chars % 2 as int) as toxic")))


OPERATORS = {
    "suffix_dedup": suffix_dedup.remove_repeats,
    "html": lambda d: html_extract.extract(d.selectExpr("doc_id as page_id", "lang as url", "text as html", "key")),
    "quality_rules": quality_rules.clean_lines,
    "winnowing": winnowing.compare_neighbours,
    "kneser_ney": lambda d: kneser_ney.identify(d, kneser_ney.train(d)),
    "simple8b": _ids,
    "toxicity": _toxicity,
    "piece_codec": lambda d: piece_codec.round_trip(d, registry.vocabulary("piece_bpe_32k.model")),
    "parity_join": parity_join.similarity_components,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_once(name, edge_docs, edge_rows):
    out = OPERATORS[name](edge_docs).collect()
    assert len(out) == len(edge_rows)
    ids = sorted((r[0] is None, r[0] or 0) for r in out)
    assert ids == sorted((r[0] is None, r[0] or 0) for r in edge_rows)
    twins = [r for r in out if r[0] == 6]
    if name not in ("simple8b", "winnowing"):  # there each row has a start, or a next row, of its own
        assert len(twins) == 2 and twins[0] == twins[1]


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(name, no_docs):
    assert OPERATORS[name](no_docs).collect() == []


def test_packing_edges(edge_docs, edge_rows, no_docs):
    out = bestfit.pack(edge_docs, capacity=100).collect()
    assert {r.doc_id for r in out} == {r[0] for r in edge_rows}
    assert bestfit.pack(no_docs).collect() == []
