import random

import pytest

from cellstar.llm.common import prepare

#: Columns that clash with names used inside the operators.
CLASHING = ["key", "z", "bin", "node", "n", "a", "b", "shard", "spans", "rank_"]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    prepare(spark)


@pytest.fixture(scope="session")
def edge_rows():
    """Null, empty, blank, tiny, repeated, tied and long texts; null columns."""
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "you", "idiot", "straße", "né", "東京", "🙂"]
    long = " ".join(rng.choice(words) for _ in range(30_000)) + ".\n"
    same = " ".join(rng.choice(words) for _ in range(80)) + "."
    texts = [None, "", " \t\n", "a", "a b", "a b c d", same, same, same.upper(), long, long + "tail", "x" * 300,
             "\x00 \x1c\x85  é́", "12 34 !!"]
    rows = [(i, t, None if i % 5 == 0 else "en" if i % 2 else "de", None if i % 4 == 0 else "src", i) for i, t in
            enumerate(texts)]
    return rows + [rows[6], (None, same, "en", "src", 1), (None, None, None, None, None)]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(edge_rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *(F.lit("x").alias(c) for c in CLASHING)).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
