"""Pseudonymisation fixes: whole names with blanks, no prefix corruption, stable keys."""

from pyspark.sql import Row

from cellstar.operators import pseudonym as P


def test_replace_whole_names_and_prefixes(spark):
    texts = spark.createDataFrame([
        Row(file_stem="a", text="Operator:\tAnn Lee\nx: 1\nOperator:\tAnn\n"),
        Row(file_stem="b", text="Operator:\tAnn\r\nMeasurement Data:\r\n"),
    ])
    keys = P.key_table(P.operator_names(texts), "s")
    k = {r.original: r.pseudonym for r in keys.collect()}
    assert set(k) == {"Ann Lee", "Ann"} and k["Ann Lee"] != k["Ann"]
    out = {r.file_stem: r.pseudonymized for r in P.replace_operators(texts, keys).collect()}
    assert out["a"] == f"Operator:\t{k['Ann Lee']}\nx: 1\nOperator:\t{k['Ann']}\n"
    assert out["b"] == f"Operator:\t{k['Ann']}\r\nMeasurement Data:\r\n"
    again = {r.original: r.pseudonym for r in P.key_table(P.operator_names(texts), "s").collect()}
    assert again == k  # same salt, same pseudonyms on a re-run
    hashed = {r.file_stem: r.pseudonymized for r in P.replace_operators(texts, salt="s").collect()}
    assert hashed == out  # the narrow (no join) path gives the same texts
