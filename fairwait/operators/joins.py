"""Joins. None forces a broadcast: Spark broadcasts a side whose size it knows to be under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where adaptive execution
splits skewed partitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matched_fact(requests: DataFrame, dim: DataFrame, key: str = "tract_geoid") -> DataFrame:
    """Requests whose tract is in the dimension; no dimension column is taken."""
    return requests.join(dim.select(key), key, "left_semi")


def enrich_dim(fact: DataFrame, dim: DataFrame, key: str | Sequence[str] = "tract_geoid") -> DataFrame:
    return fact.join(dim, key if isinstance(key, str) else list(key), "inner")


def join_baseline(stats: DataFrame, base: DataFrame, keys: Sequence[str]) -> DataFrame:
    return stats.join(base, list(keys), "inner")


def quintile_self_join(
    summary: DataFrame,
    key: str,
    measures: Mapping[str, str],
    lo: int = 1,
    hi: int = 5,
    bucket: str = "income_quintile",
) -> DataFrame:
    """Lowest and highest bucket side by side, keys with both only.

    ``summary`` has one row per key and bucket, so joining the two filtered halves equals
    one conditional aggregation, which scans once. ``measures`` maps a suffix to a column:
    {"n": "n_complaints"} gives ``q1_n`` and ``q5_n``.
    """
    aggs = []
    for tag in (lo, hi):
        here = F.col(bucket) == tag
        aggs.append(F.count_if(here).alias(f"_has{tag}"))
        aggs += [F.max(F.when(here, F.col(c))).alias(f"q{tag}_{s}") for s, c in measures.items()]
    both = (
        summary.filter(F.col(key).isNotNull() & F.col(bucket).isin(lo, hi)).groupBy(key).agg(*aggs)
    )
    return both.filter((F.col(f"_has{lo}") > 0) & (F.col(f"_has{hi}") > 0)).drop(f"_has{lo}", f"_has{hi}")


def lookup_default(
    df: DataFrame, key: str, lookup: DataFrame, value: str, default: str | Column, lookup_key: str | None = None
) -> DataFrame:
    """Add ``value`` from ``lookup`` by ``key``; ``default`` where the key is unknown.

    A key listed twice in the lookup counts once, so rows never multiply.
    """
    table = (
        lookup.select(F.col(lookup_key or key).alias("_k"), F.col(value).alias("_v"))
        .groupBy("_k")
        .agg(F.max("_v").alias("_v"))
    )
    fallback = F.lit(default) if isinstance(default, str) else default
    return (
        df.join(table, F.col(key) == F.col("_k"), "left")
        .withColumn(value, F.coalesce("_v", fallback))
        .drop("_k", "_v")
    )


def enrich_neighborhood(
    df: DataFrame, crosswalk: DataFrame, fallback: str = "county", key: str = "tract_geoid"
) -> DataFrame:
    """Neighborhood of each tract, its county where the crosswalk has none."""
    return lookup_default(df, key, crosswalk, "neighborhood", F.col(fallback))


def align_aggregates(dfs: Sequence[DataFrame], key: str, required: Sequence[str]) -> DataFrame:
    """Several aggregates side by side on one key; rows lacking a required column go."""
    wide = reduce(lambda a, b: a.join(b, key, "full"), dfs)
    return wide.dropna(subset=list(required))


def reindex_spine(df: DataFrame, spine: DataFrame, key: str, fill: Mapping[str, float] | None = None) -> DataFrame:
    """``df`` aligned to every key of ``spine``; gaps are NULL, or ``fill``'s value."""
    aligned = spine.join(df, key, "left")
    return aligned.fillna(dict(fill)) if fill else aligned


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the same one in every run: the largest in the order of the other columns."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    largest = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
    return largest.select(*[F.col(f"_row.{c}").alias(c) if c in rest else c for c in df.columns])


def categorize_types(
    types: DataFrame,
    reference: DataFrame,
    key: str = "complaint_type",
    category: str = "Other / Uncategorized",
    description: str = "A valid request type without a description yet.",
    agency: str = "Various",
) -> DataFrame:
    """Category, description and agency of each live type, with defaults for unknown ones.

    Of several reference rows for a type the largest in the order of its columns counts.
    """
    known = one_per_key(reference, [key]).withColumn("is_known", F.lit(True))
    return types.join(known, key, "left").select(
        key,
        F.coalesce("category", F.lit(category)).alias("category"),
        F.coalesce("description", F.lit(description)).alias("description"),
        F.coalesce("agency", F.lit(agency)).alias("agency"),
        F.coalesce("is_known", F.lit(False)).alias("is_known"),
    )


def insert_if_absent(target: DataFrame, rows: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The rows of ``rows`` whose key ``target`` lacks: append them, and their count is the
    number inserted. Of several rows for a key the largest in the order of its columns counts."""
    keys = [key] if isinstance(key, str) else list(key)
    return one_per_key(rows, keys).join(target.select(*keys), keys, "left_anti")
