"""Exact duplicates by progressive refinement.

Texts are compared without white space. One pass keeps two numbers a row, the length of that text and a hash of its
beginning; only lengths that occur twice go on to the beginnings, and only beginnings that occur twice there to the
whole texts. A second pass takes the digest of the whole text for the rows of those groups alone. Both passes leave the texts where
they are, unless the list of groups is too long for Spark to broadcast.

DataFrame functions only. Counts are combined before they are shuffled, and a group's rows are never brought
together: each looks up who stays, so a group may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, unused

PREFIX = 256  # characters of a text's beginning


def squeezed(text: Column) -> Column:
    """The text without any of tab, line feed, vertical tab, form feed, carriage return and space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def suspects(docs: DataFrame, text: str = "text", prefix: int = PREFIX) -> DataFrame:
    """(length, start): the lengths and hashed beginnings of squeezed texts that two rows or more have."""
    rows = docs.select(squeezed(F.col(text)).alias("squeezed"))
    rows = rows.select(F.octet_length("squeezed").alias("length"), F.xxhash64(F.substring("squeezed", 1, prefix)).alias("start"))
    # Counted together first, so that no length's rows meet in one task; each step then cuts the list for the next.
    counts = stored(rows.groupBy("length", "start").count(), "counts")
    lengths = counts.groupBy("length").agg(F.sum("count").alias("rows")).filter("rows > 1").select("length")
    return counts.join(lengths, "length", "left_semi").filter("count > 1").select("length", "start")


def dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    columns: Sequence[str] | None = None,
    digests: bool = False,
    prefix: int = PREFIX,
) -> DataFrame:
    """``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``digest``, one row per row.

    Texts are equal when they are so without white space; null counts as empty, and all empty texts are equal. Of equal texts the row with the most
    characters stays, then that with the smallest id (null last); of rows equal in both exactly one. ``keep_id`` is the id of the
    row that stays. ``digest`` is the SHA-256 of the text without white space, in hex; rows that were told apart without
    it have none unless ``digests`` asks for it. ``columns`` names what comes back of ``docs`` (all, by default); the
    four columns replace others of their names. No length is too long: digests run over whole texts.
    """
    out = ["keep_id", "group_size", "kept", "digest"]
    columns = [c for c in (docs.columns if columns is None else columns) if c.lower() not in out]
    flat, length, start, again, chars, row, digest = unused(docs, "_flat", "_length", "_start", "_again", "_chars", "_row", "_digest")
    key = F.col(id_col).alias("_id")
    found = stored(suspects(docs, text, prefix).toDF(length, start).withColumn(again, F.lit(True)), "suspects")
    rows = docs.select(*columns, key, F.char_length(F.coalesce(F.col(text), F.lit(""))).alias(chars), squeezed(F.col(text)).alias(flat))
    rows = rows.withColumns({length: F.octet_length(flat), start: F.xxhash64(F.substring(flat, 1, prefix))})
    rows = rows.join(found, [length, start], "left").withColumn(again, F.coalesce(F.col(again), F.lit(False)))
    whole = F.sha2(F.col(flat).cast("binary"), 256)
    rows = rows.withColumn(digest, whole if digests else F.when(F.col(again), whole))
    # Written once with a number for each row, by which rows equal in everything are told apart.
    rows = stored(rows.select(*columns, "_id", chars, again, digest).withColumn(row, F.monotonically_increasing_id()), "digests")
    first = F.min(F.struct((-F.col(chars)).alias("c"), F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col(row).alias("r")))
    # Written apart, so that the look-up below is a join whose large keys Spark can split.
    groups = stored(rows.filter(again).groupBy(digest).agg(F.count("*").alias("group_size"), first.alias("_first")), "groups")
    shared = rows.filter(again).join(groups, digest)
    one = rows.filter(~F.col(again))
    result = [F.col(c) for c in columns]
    return shared.select(
        *result, F.col("_first")["i"].alias("keep_id"), "group_size", (F.col("_first")["r"] == F.col(row)).alias("kept"), F.col(digest).alias("digest")
    ).unionByName(
        one.select(*result, F.col("_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), F.col(digest).alias("digest"))
    )
