"""Metadata documents of any shape.

``operators/metadata`` reads documents with the fields of the metadata sheet; a
field that it doesn't know is not kept. Here a document is a VARIANT: every
field survives whatever its name, depth or type, and a later document replaces
the fields it names and leaves the others (``merge``). A document's key is one of
its top-level fields. Lines that are no JSON object, repeat a field, or lack the
key go to ``rejected`` with their reason.

A JSON null is a value and replaces an older one. Documents of one key and time
are merged field by field, the greater JSON text winning, so repeated rows and
any order of lines give the same result. Empty input gives empty tables; an
object with the key alone is a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _parsed(lines: DataFrame, key: str) -> DataFrame:
    doc = F.try_parse_json("value")
    is_object = F.schema_of_variant(doc).startswith("OBJECT")
    name = F.when(is_object, F.try_variant_get(doc, f"$['{key}']", "string"))
    reason = (F.when(F.col("value").isNull(), "empty line").when(doc.isNull(), "not JSON, or a field twice")
              .when(~is_object, "not an object").when(name.isNull(), f"no {key}"))
    return lines.select("value", doc.alias("doc"), name.alias("document"), reason.alias("reason"))


def read(lines: DataFrame, loaded_at, key: str = "json_name") -> DataFrame:
    """(document, doc VARIANT, loaded_at) of the JSON lines in ``value``."""
    return _parsed(lines, key).filter("reason is null").select(
        "document", "doc", F.lit(loaded_at).cast("timestamp").alias("loaded_at"))


def rejected(lines: DataFrame, key: str = "json_name") -> DataFrame:
    """(value, reason) of the lines that are no document."""
    return _parsed(lines, key).filter("reason is not null").select("value", "reason")


def fields(docs: DataFrame) -> DataFrame:
    """One row a top-level field: document, loaded_at, field, value (its JSON
    text); a document without fields has one row of nulls."""
    return docs.sparkSession.sql(
        "SELECT d.document, d.loaded_at, f.key AS field, to_json(f.value) AS value "
        "FROM {docs} d, LATERAL variant_explode_outer(d.doc) AS f", docs=docs)


def merge(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Upsert field by field. Newest values are chosen by a partial aggregate
    on (document, field), so many versions of one document are reduced where they
    lie; a document's own fields are then put together in one row."""
    columns = ["document", "doc", "loaded_at"]
    every = fields(stored.select(columns).unionByName(incoming.select(columns)))
    newest = every.groupBy("document", "field").agg(
        F.max_by("value", F.struct("loaded_at", "value")).alias("value"), F.max("loaded_at").alias("loaded_at"))
    quoted = F.to_json(F.struct(F.col("field").alias("k")))  # {"k":"name"}
    pair = F.when(F.col("field").isNotNull(), F.concat(
        F.substr(quoted, F.lit(6), F.length(quoted) - 6), F.lit(":"), F.col("value")))
    return newest.groupBy("document").agg(
        F.array_join(F.sort_array(F.collect_list(pair)), ",").alias("_pairs"), F.max("loaded_at").alias("loaded_at")).select(
        "document", F.parse_json(F.concat(F.lit("{"), F.col("_pairs"), F.lit("}"))).alias("doc"), "loaded_at")


def shape(docs: DataFrame) -> DataFrame:
    """What fields there are: per top-level field the documents that have it and
    the one type that holds all its values (VARIANT where they differ in kind)."""
    return (docs.sparkSession.sql("SELECT f.key AS field, f.value FROM {docs} d, LATERAL variant_explode(d.doc) AS f", docs=docs)
            .groupBy("field").agg(F.count(F.lit(1)).alias("n_documents"), F.schema_of_variant_agg("value").alias("type")))
