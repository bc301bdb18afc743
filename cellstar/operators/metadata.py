"""Metadata documents: build, serialise, upsert, group and join.

A document store becomes a JSON-lines table keyed by ``_id``. Upsert is a
merge by key: the union of the stored and the new documents, keeping the
latest batch per key with ``max_by`` -- an aggregation with map-side partial
results, so no key group is ever collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

DOC_FIELDS = ["operator_name", "operator_level", "machine_name", "machine_type",
              "electrode_material", "measurement_name"]
DOCUMENT_SCHEMA = StructType(
    [StructField("_id", StringType(), False)]
    + [StructField(f, StringType(), True) for f in DOC_FIELDS]
    + [StructField("filename", StringType(), True), StructField("created_at", TimestampNTZType(), True)])


def documents(rows: DataFrame, created_at: Column | None = None) -> DataFrame:
    """One document per metadata row: ``_id`` = json_name, the six fields,
    ``filename`` and the load time (C19; a fixed value can be passed for
    repeatable runs)."""
    created = created_at if created_at is not None else F.localtimestamp()
    return rows.select(F.col("json_name").alias("_id"), *DOC_FIELDS,
                       F.concat(F.col("json_name"), F.lit(".json")).alias("filename"),
                       created.cast("timestamp_ntz").alias("created_at"))


def to_json_documents(docs: DataFrame) -> DataFrame:
    """B2: the JSON text of each document without the store's own fields."""
    return docs.select(F.col("_id").alias("json_name"),
                       F.to_json(F.struct(*DOC_FIELDS)).alias("json"))


def write_documents(docs: DataFrame, path: str, mode: str = "errorifexists") -> str:
    docs.write.mode(mode).json(path)
    return path


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """A10: scan a document collection with its declared schema."""
    return spark.read.schema(DOCUMENT_SCHEMA).json(path)


def upsert(stored: DataFrame | None, incoming: DataFrame, key: str = "_id") -> DataFrame:
    """Insert new keys, replace the whole document of existing keys.

    ``incoming`` wins over ``stored``; inside one batch a repeated key keeps
    its last document in the batch's ``_seq`` order when given.
    """
    cols = [c for c in incoming.columns if c != "_seq"]
    parts = [incoming.select(*cols, F.lit(1).alias("_batch"),
                             (F.col("_seq") if "_seq" in incoming.columns else F.lit(0)).alias("_seq"))]
    if stored is not None:
        parts.insert(0, stored.select(*cols, F.lit(0).alias("_batch"), F.lit(0).alias("_seq")))
    u = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    rest = [c for c in cols if c != key]
    latest = u.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("_batch", "_seq")).alias("d"))
    return latest.select(key, *[F.col(f"d.{c}").alias(c) for c in rest])


def by_measurement(docs: DataFrame) -> DataFrame:
    """Documents grouped by machine, then measurement, without the store's fields."""
    return docs.select(*DOC_FIELDS).repartition("machine_name", "measurement_name")


def enrich(rows: DataFrame, docs: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """Attach operator, level and material per measurement (left join),
    the fixed values only where no document names them."""
    from cellstar.operators.lookup import broadcast_if_small
    # one document per measurement (the first by document name), so the join
    # never multiplies readings when two documents name the same measurement
    order = "json_name" if "json_name" in docs.columns else ("_id" if "_id" in docs.columns else None)
    pick = F.struct(*[F.col(c) for c in defaults])
    one = docs.groupBy("measurement_name").agg(
        (F.min_by(pick, F.col(order)) if order else F.min(pick)).alias("_d"))
    meta = broadcast_if_small(one.select(
        "measurement_name", *[F.col(f"_d.{c}").alias(f"_d_{c}") for c in defaults]))
    out = rows.join(meta, "measurement_name", "left")
    for c, v in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(f"_d_{c}"), F.lit(v))).drop(f"_d_{c}")
    return out
