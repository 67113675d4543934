"""The documents made ready for training: language, repeated lines, near-duplicates, packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairwait.llm import langid, line_dedup, near_dedup, packing
from fairwait.llm.common import stored, table
from fairwait.llm.queries import VOCABULARY

# Documents go whose share of n-grams known from the labelled ones is under this part of what nearly all labelled ones reach, as do
# those without a letter. README.md has the shares of learned and unlearned languages.
MIN_KNOWN = 0.8
# Score from which a predicted language counts more than the given one; short texts stay below it.
SURE = 0.75


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognisable language, and puts the predicted one in the place of ``lang`` where it is sure.

    The documents are packed by it.
    """
    return langid.accepted(docs, MIN_KNOWN, sure=SURE)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes runs of lines that stand earlier, and documents of which nothing is left by that."""
    done = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_dropped") > 0) & (F.trim("text", F.lit(" \t\r\n\f\x0b")) == "")
    chars = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return done.filter(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", chars).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles: the one with the smallest id."""
    groups = stored(near_dedup.near_groups(docs, words=5, percent=80).filter("kept"), "kept")
    grouped = (F.col("n_shingles") > 0) & F.col("component_id").isNotNull()
    first = groups.filter(grouped).groupBy("component_id").agg(F.min("text_hash").alias("text_hash"))
    keep = first.select(F.col("component_id").alias("doc_id"), "text_hash").union(groups.filter(~grouped).select("doc_id", "text_hash"))
    keyed = docs.withColumn("_hash", F.xxhash64("text"))
    same = keyed["doc_id"].eqNullSafe(keep["doc_id"]) & (keyed["_hash"] == keep["text_hash"])
    # Rows equal in id and text are one document.
    return keyed.join(keep, same, "left_semi").dropDuplicates(["doc_id", "_hash"]).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents in sequences of 1024 tokens of one language, piece by piece with the token ids."""
    return packing.pack(docs, VOCABULARY, 1024, by="lang")


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("pack", pack)]

# Kernels, similarity and merges of tokens are beyond SQL; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
