"""Corpus pipeline: toxicity, language, near duplicates, repeated passages, packing.

Every stage is a function (spark, docs, sf_dir) -> DataFrame over all that its
predecessor kept; all but the last return the columns of ``docs``. The result
of each stage is written as Parquet to the shared folder and read again, so
lineage ends there.

* toxicity: learns from the rows of ``docs`` that ``labels`` covers and drops
  documents scored 0.5 or more;
* language: drops documents without a letter and those that resemble no
  learned language;
* near_duplicates: of each component of five-word shingle sets with a Jaccard
  similarity of 0.8 or more, the document of least id stays (of rows that share
  an id, too; rows without an id all stay);
* repeated_passages: removes passages of 100 bytes that start earlier too; what
  is left of a character cut in two goes as well, and n_chars is counted anew;
* packing: the pieces and bins of the documents.

Empty tables pass through. Columns beyond those of documents are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellstar.llm import bestfit, kneser_ney, parity_join, suffix_dedup
from cellstar.llm import toxicity as toxicity_trees
from cellstar.llm.common import stage, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    classifier = toxicity_trees.train(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row_"))
    scored = toxicity_trees.score(rows, classifier, "row_")
    return scored.filter("predicted = 0").select("row_.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    identifier = kneser_ney.train(docs)
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row_"))
    return kneser_ney.identify(rows, identifier, "row_").filter(~F.col("rejected")).select("row_.*")


def free(name: str, docs: DataFrame) -> str:
    """A column name that ``docs`` doesn't have."""
    while name in docs.columns:
        name += "_"
    return name


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = parity_join.similarity_components(docs, percent=80, width=5, links=False)
    keep = found.filter(F.col("component_id") == F.col("doc_id")).select("doc_id").distinct()
    kept = docs.join(keep, "doc_id", "left_semi")
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    rank = free("rank_", docs)
    kept = kept.withColumn(rank, F.row_number().over(one)).filter(F.col(rank) == 1).drop(rank)
    return kept.unionByName(docs.filter(F.col("doc_id").isNull())).select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    none = free("none_", docs)
    rows = docs.select("doc_id", "text", F.struct(F.lit(0).alias(none), *others).alias("row_"))
    left = suffix_dedup.remove_repeats(rows, keep=("row_",))
    kind = docs.schema["n_chars"].dataType if "n_chars" in docs.columns else None
    out = left.select("doc_id", suffix_dedup.whole_characters(F.col("kept")).alias("text"), "row_.*").drop(none)
    if kind is not None:
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out.select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bestfit.pack(docs)


STAGES = [("toxicity", toxicity), ("language", language), ("near_duplicates", near_duplicates),
          ("repeated_passages", repeated_passages), ("packing", packing)]

#: The stages learn, merge components and sort suffixes: SQL expresses none of this.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
