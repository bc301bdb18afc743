"""Pseudonymisation of operators and files (C18, F5, F8, G3, M-1 ... M-3).

Names are found with a regex over whole file texts, mapped to stable
pseudonyms through a key table (salted SHA-256, so a re-run gives the same
pseudonym and the key table allows re-identification), and replaced line by
line -- the whole value after ``Operator:<tab>``, so a name with a blank is
replaced entirely and a name that starts another one is not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPERATOR_LINE = r"Operator:\t([^\r\n]+)"
PSEUDONYM_PREFIX = "Operator_"


def pseudonym(name: Column, salt: str) -> Column:
    """The whole digest, so that two names never share a pseudonym."""
    return F.concat(F.lit(PSEUDONYM_PREFIX), F.sha2(F.concat(F.lit(salt), name), 256))


def operator_names(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """(file, name) for every operator line of every text."""
    names = F.regexp_extract_all(F.col(text_col), F.lit(OPERATOR_LINE), 1)
    return (texts.select("file_stem", F.explode(names).alias("raw"))
            .select("file_stem", F.btrim("raw", F.lit(" \t")).alias("original"))
            .distinct())


def key_table(names: DataFrame, salt: str) -> DataFrame:
    """M-1: original -> pseudonym, one row per distinct name."""
    return (names.select("original").distinct()
            .select("original", pseudonym(F.col("original"), salt).alias("pseudonym")))


def replace_operators(texts: DataFrame, keys: DataFrame | None = None, text_col: str = "text",
                      salt: str | None = None) -> DataFrame:
    """Replace each operator line's value by its pseudonym.

    With ``salt`` the pseudonym is computed on the line itself (the same salted
    hash the key table holds): a narrow map, no join, no shuffle. With a
    ``keys`` table (e.g. one kept from earlier runs) the names of each file are
    looked up: the per-file map is small (names in one file) and joined to the
    file, so no global map reaches the driver.
    """
    lines = F.split(F.col(text_col), "\n")
    eol = lambda line: F.when(line.endswith("\r"), F.lit("\r")).otherwise(F.lit(""))

    if salt is not None:
        def fix_hashed(line):
            m = F.regexp_extract(line, OPERATOR_LINE, 1)
            new = pseudonym(F.btrim(m, F.lit(" \t")), salt)
            return F.when(F.length(m) > 0, F.concat(F.lit("Operator:\t"), new, eol(line))).otherwise(line)
        return texts.select("*", F.array_join(F.transform(lines, fix_hashed), "\n").alias("pseudonymized"))

    per_file = (operator_names(texts, text_col).join(keys, "original")
                .groupBy("file_stem").agg(F.map_from_entries(
                    F.collect_list(F.struct("original", "pseudonym"))).alias("names")))

    def fix(line):
        m = F.regexp_extract(line, OPERATOR_LINE, 1)
        new = F.element_at(F.col("names"), F.btrim(m, F.lit(" \t")))
        return F.when((F.length(m) > 0) & new.isNotNull(),
                      F.concat(F.lit("Operator:\t"), new, eol(line))).otherwise(line)

    out = texts.join(per_file, "file_stem", "left")
    return out.select("*", F.array_join(F.transform(lines, fix), "\n").alias("pseudonymized")).drop("names")


def file_key_table(sequenced: DataFrame, at: str) -> DataFrame:
    """M-2: original file name, artificial name (sequence + extension), date."""
    return sequenced.select(
        F.col("file_name").alias("original_filename"),
        F.concat(F.col("sequence").cast("string"), F.col("extension")).alias("anonymized_filename"),
        F.lit(at).alias("date_anonymized"))
