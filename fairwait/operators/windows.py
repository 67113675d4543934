from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Rows drawn per range to find the bounds between ranges.
DRAWN = 20


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str | Column] = (),
) -> DataFrame:
    """The newest row per key: ``order`` descending with NULLs last, then ``ties``.

    Name enough ``ties`` to make the result deterministic. The rank filter reaches the map
    side as a group limit, so each task ships at most one row per key and a hot key does
    not pile up.
    """
    by = [F.col(c).desc_nulls_last() for c in order]
    by += [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in ties]
    ranked = df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*by)))
    return ranked.filter("_rn = 1").drop("_rn")


def ntile_bucket(
    df: DataFrame,
    value: str,
    n: int,
    ties: Sequence[str],
    out: str = "bucket",
    null_policy: str = "last",
    partition_by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Split rows into ``n`` buckets of equal size by ``value``, lowest first.

    ``null_policy``: "last" puts NULL values behind all others, so they share the top
    bucket; "exclude" leaves them out of the ranking with a NULL bucket.

    The ranking is global, or within each group of ``partition_by``. Rows are cut into ``ranges`` (as
    many as there are shuffle partitions) at bounds drawn from the rows by a small job of its own, ranked within
    their range, and moved up by the sizes of the ranges before. The bounds are literals, so a row
    falls into the same range whenever it is worked out again. A hot group spans many ranges.
    """
    if null_policy not in ("last", "exclude"):
        raise ValueError(f"unknown null_policy {null_policy!r}")
    missing = F.col(value).isNull()
    ranked_rows = df.filter(~missing) if null_policy == "exclude" else df
    by = [F.col(value).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]]

    groups = list(partition_by)
    done = _ranged_ntile(ranked_rows, groups, [value, *ties], by, n, out, ranges)
    if null_policy == "exclude":
        done = done.unionByName(df.filter(missing).withColumn(out, F.lit(None).cast("int")))
    return done


def _place(df: DataFrame, cols: list[str]) -> Column:
    """A struct that sorts as the columns do, NULLs last."""
    parts = []
    for i, c in enumerate(cols):
        parts += [F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}")]
    return F.struct(*parts)


def range_of(df: DataFrame, cols: list[str], ranges: int) -> Column:
    """The number of a row's range in the order of ``cols``, from bounds drawn by hash."""
    drawn = (
        df.select(_place(df, cols).alias("place"))
        .orderBy(F.xxhash64("place"), "place")
        .limit(DRAWN * ranges)
        .orderBy("place")
        .collect()
    )
    step = max(1, -(-len(drawn) // ranges))
    bounds = [r["place"] for r in drawn[step::step]]
    types = dict(df.dtypes)
    here = _place(df, cols)

    def literal(place) -> Column:
        parts = []
        for i, c in enumerate(cols):
            parts += [F.lit(place[f"n{i}"]).alias(f"n{i}"), F.lit(place[f"v{i}"]).cast(types[c]).alias(f"v{i}")]
        return F.struct(*parts)

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(here < literal(bounds[mid]), search(lo, mid)).otherwise(search(mid + 1, hi))

    return search(0, len(bounds))


def _ranged_ntile(
    df: DataFrame, groups: list[str], cols: list[str], by: list[Column], n: int, out: str, ranges: int | None
) -> DataFrame:
    parts = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn("_part", range_of(df, [*groups, *cols], parts))
    # One row per range and group in it; per group at most one row per range.
    sizes = placed.groupBy(*groups, "_part").agg(F.count(F.lit(1)).alias("_size"))
    ordered = W.partitionBy(*groups).orderBy("_part")
    upto = ordered.rowsBetween(W.unboundedPreceding, -1)
    every = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    offsets = sizes.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        F.col("_part").alias("_p"),
        F.coalesce(F.sum("_size").over(upto), F.lit(0)).alias("_before"),
        F.sum("_size").over(every).alias("_all"),
    )
    if not groups:  # as many rows as there are ranges: small whatever the data
        offsets = F.broadcast(offsets)
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    local = placed.withColumn("_rn", F.row_number().over(W.partitionBy(*groups, "_part").orderBy(*by)))
    joined = local.join(offsets, same)
    rank = F.col("_before") + F.col("_rn") - 1
    # With N = q * n + r the first r buckets hold q + 1 rows and the others q.
    q, r = F.expr(f"_all div {n}"), F.col("_all") % n
    wide = r * (q + 1)
    bucket = F.when(rank < wide, F.floor(rank / (q + 1))).otherwise(
        r + F.floor((rank - wide) / F.greatest(q, F.lit(1)))
    )
    return joined.select(*df.columns, (bucket + 1).cast("int").alias(out))


def top_n_per_group(
    df: DataFrame, group: Sequence[str], by: str, n: int, ties: Sequence[str] = ()
) -> DataFrame:
    """The ``n`` rows with the largest ``by`` in each group, with their rank ``rn``."""
    order = [F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]]
    return df.withColumn("rn", F.row_number().over(W.partitionBy(*group).orderBy(*order))).filter(
        F.col("rn") <= n
    )
