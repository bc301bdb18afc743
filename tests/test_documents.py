"""Documents of unknown shape: fields survive reading, merging and storing; broken lines are reported."""

import json
import random
import tempfile

from cellstar.operators import documents as D


def lines(spark, values):
    return spark.createDataFrame([(v if v is None or isinstance(v, str) else json.dumps(v),) for v in values], "value string")


def plain(docs):
    return {r.document: json.loads(r.j) for r in docs.selectExpr("document", "to_json(doc) AS j").collect()}


def test_unknown_and_type_changing_fields_survive(spark):
    first = [{"json_name": "a", "x": 1, "deep": {"p": [1, {"q": None}], "é \"quoted\"": 2.5}}, {"json_name": "b", "x": "one"},
             {"json_name": "c"}]
    second = [{"json_name": "a", "x": ["now", "a", "list"], "new.field": True, "we\\ird\n": "t\tx"}, {"json_name": "b", "x": None},
              {"json_name": "d", "x": {"y": 1}}]
    stored = D.read(lines(spark, first), "2024-01-01 00:00:00")
    path = tempfile.mkdtemp(prefix="documents-") + "/docs"
    D.merge(stored, D.read(lines(spark, second), "2024-02-01 00:00:00")).write.parquet(path)
    merged = spark.read.parquet(path)
    want = {"a": {**first[0], **second[0]}, "b": {**first[1], **second[1]}, "c": first[2], "d": second[2]}
    assert plain(merged) == want
    assert plain(D.merge(merged, merged)) == want
    # an older load changes nothing but fields that nobody had named
    old = D.read(lines(spark, [{"json_name": "a", "x": "old", "older": 3}]), "2023-01-01 00:00:00")
    assert plain(D.merge(merged, old))["a"] == {**want["a"], "older": 3}


def test_merge_equals_plain_merge(spark):
    r = random.Random(2)
    loads = [[{"json_name": str(r.randrange(6)), **{f"f{r.randrange(5)}": r.choice([1, "1", None, [1], {"z": 2.5}, True])
                                                    for _ in range(r.randrange(4))}} for _ in range(30)] for _ in range(3)]
    want = {}
    for load in loads:
        newest = {}
        for doc in load:  # of one load the greater JSON text wins
            for k, v in doc.items():
                text = json.dumps(v, separators=(",", ":"))
                newest[doc["json_name"], k] = max(newest.get((doc["json_name"], k), ""), text)
        for (name, k), text in newest.items():
            want.setdefault(name, {})[k] = json.loads(text)
    merged = None
    for i, load in enumerate(loads):
        new = D.read(lines(spark, load), f"2024-01-0{i + 1} 00:00:00")
        merged = D.merge(new, new) if merged is None else D.merge(merged, new)
    assert plain(merged) == want


def test_broken_lines_are_reported(spark):
    bad = lines(spark, ["{", "[1]", "3", None, '{"json_name": "a", "x": 1, "x": 2}', '{"x": 1}', '{"json_name": "ok"}', ""])
    found = {(r.value, r.reason) for r in D.rejected(bad).collect()}
    assert len(found) == 7 and ("[1]", "not an object") in found and ('{"x": 1}', "no json_name") in found
    assert plain(D.read(bad, "2024-01-01 00:00:00")) == {"ok": {"json_name": "ok"}}


def test_shape_and_empty(spark):
    docs = D.read(lines(spark, [{"json_name": "a", "x": 1}, {"json_name": "b", "x": 2.5}, {"json_name": "c", "y": {"z": "t"}}]),
                  "2024-01-01 00:00:00")
    found = {r.field: (r.n_documents, r.type) for r in D.shape(docs).collect()}
    assert found["json_name"] == (3, "STRING") and found["x"][0] == 2 and found["y"] == (1, "OBJECT<z: STRING>")
    none = D.read(lines(spark, []), "2024-01-01 00:00:00")
    assert D.merge(none, none).count() == D.shape(none).count() == D.rejected(lines(spark, [])).count() == 0
