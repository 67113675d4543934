"""Exact and approximate quantiles per group, safe for groups that hold most of the rows.

The exact form counts equal values first. That aggregation combines on the map side and
spreads one hot group over all its distinct values, so what later meets in one place is the
group's distinct values, not its rows: for waiting times in hours that is the length of the
time axis, however many requests there are. Running counts over the distinct values then
locate the two order statistics around each quantile. The sort and the window spill to disk.

Values without such a bound take the ``wide`` form. It counts per bucket of nearby values
first, of which there is a fixed number, finds the buckets that hold the wanted ranks, and
looks into those alone; they are cut once more in the same way, so that values that lie close
together, as latitudes or the timestamps of a month do, do not stay in one bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# What may ride along: name -> (first-level aggregate, second-level aggregate).
_CARRY = {
    "count": (lambda c: F.count(c), F.sum),
    "sum": (lambda c: F.sum(c), F.sum),
    "max": (lambda c: F.max(c), F.max),
    "min": (lambda c: F.min(c), F.min),
}


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    quantiles: Mapping[str, tuple[str, float]],
    carry: Mapping[str, tuple[str, str]] | None = None,
    approx: bool = False,
    accuracy: int = 10000,
    wide: bool = False,
    weight: str | None = None,
    ranges: Sequence[str] = (),
) -> DataFrame:
    """Quantiles of one or more columns per group, in one pass over ``df``.

    ``quantiles`` maps an output name to (value column, probability). The exact result
    interpolates linearly between neighbours and ignores NULLs. ``carry`` maps an output
    name to ("count" | "sum" | "max" | "min", column); ("count", "*") counts rows.
    ``approx=True`` uses mergeable sketches and returns an element of the group.
    ``wide=True`` is for few groups with any number of distinct values; same result.
    ``weight`` names a column that says for how many equal rows a row stands, as in stored counts (``value_counts``),
    for the exact result; what rides along, but for ("count", "*"), is not multiplied.
    ``ranges`` names some of ``keys``: groups are ranked in ranges of these, in this order, and the result lies so. To folders by the first it
    can be written as it is.
    """
    carry = dict(carry or {})
    if approx and weight is not None:
        raise ValueError("sketches take rows, not counts")
    if ranges and (approx or wide):
        raise ValueError("ranges are for the plain exact form")
    if not set(ranges) <= set(keys):
        raise ValueError(f"ranges of {[c for c in ranges if c not in keys]}, which are no keys")
    if approx:
        aggs = [
            F.percentile_approx(value, F.lit(p), F.lit(accuracy)).cast("double").alias(out)
            for out, (value, p) in quantiles.items()
        ]
        aggs += [_CARRY[kind][0](_source(col)).alias(out) for out, (kind, col) in carry.items()]
        return df.groupBy(*keys).agg(*aggs)

    values = list(dict.fromkeys(value for value, _ in quantiles.values()))
    hist = _value_counts(df, keys, values, carry, weight)
    if ranges:
        hist = hist.repartitionByRange(*ranges)
    part = [*keys, "_m"] if len(values) > 1 else list(keys)
    ranked = (_rank_wide if wide else _rank)(hist, part, values, quantiles, carry)
    return _pick(ranked, keys, values, quantiles, carry)


def _source(col: str) -> Column:
    return F.lit(1) if col == "*" else F.col(col)


def _value_counts(df, keys, values, carry, weight=None) -> DataFrame:
    """One row per (keys, measure, value) with its number of rows ``_n``.

    Row counts are not carried apart, ``_n`` has them: so two branches over the same groups
    ask for the same columns, and Spark reuses the shuffles of the first for the second.
    """
    carry = {out: how for out, how in carry.items() if how != ("count", "*")}
    carried = [F.col(col).alias(f"_c_{out}") for out, (_, col) in carry.items()]
    held = [] if weight is None else [F.col(weight).alias("_w")]
    if len(values) == 1:
        long = df.select(*keys, F.col(values[0]).alias("_v"), *carried, *held)
        by = [*keys, "_v"]
    else:
        # Carried columns go with the first measure only, so they count once.
        pairs = F.array(
            *[
                F.struct(F.lit(i).alias("_m"), F.col(v).cast("double").alias("_v"))
                for i, v in enumerate(values)
            ]
        )
        long = df.select(*keys, F.explode(pairs).alias("_p"), *carried, *held).select(
            *keys,
            *[c for c in ("_w",) if held],
            "_p._m",
            "_p._v",
            *[F.when(F.col("_p._m") == 0, F.col(f"_c_{o}")).alias(f"_c_{o}") for o in carry],
        )
        by = [*keys, "_m", "_v"]
    aggs = [_CARRY[kind][0](F.col(f"_c_{o}")).alias(f"_c_{o}") for o, (kind, _) in carry.items()]
    number = F.count(F.lit(1)) if weight is None else F.sum("_w")
    return long.groupBy(*by).agg(number.alias("_n"), *aggs)


def value_counts(df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None, out: str = "n_rows") -> DataFrame:
    """One row per group and value with its number of rows (``out``): a state from which all quantiles of the value follow exactly.

    States of separate rows are merged by counting again with ``weight=out``; a state less that of some of its rows is the state of the
    others. NULL groups and values are kept.
    """
    return df.groupBy(*keys, value).agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).alias(out))


def _running(df: DataFrame, part: Sequence[str], order: str) -> DataFrame:
    """Rows up to and including each, and the total, over rows where ``order`` is known.

    NULLs come last, so they never enter the running count of a known value. Both windows
    share one sort, and refer to plain columns: nothing is added to what is shuffled.
    """
    ordered = W.partitionBy(*part).orderBy(F.col(order).asc_nulls_last())
    upto = F.sum("_n").over(ordered.rowsBetween(W.unboundedPreceding, W.currentRow))
    known = F.max(F.when(F.col(order).isNotNull(), F.col("_upto")))
    return df.withColumn("_upto", upto).withColumn(
        "_total", known.over(ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    )


def _position(p: float) -> str:
    return f"{float(p)!r}D * (_total - 1)"


def _of(value: str, values: Sequence[str]) -> str:
    """Whether a row belongs to the measure."""
    return f"_m = {values.index(value)}" if len(values) > 1 else "true"


def _rank(hist, part, values, quantiles, carry) -> DataFrame:
    return _running(hist, part, "_v")


# Buckets per factor of e. A double has at most 2 * 709 * 256 buckets, each cut into so many parts.
_FINENESS = 256
_PARTS = 65_536


def _rank_wide(hist, part, values, quantiles, carry) -> DataFrame:
    v = F.col("_v")
    scale = F.log1p(F.abs(v)) * _FINENESS
    cut = F.signum(v) * F.floor((scale - F.floor(scale)) * _PARTS)
    fine = hist.withColumns({"_b": (F.signum(v) * F.floor(scale)).cast("bigint"), "_b2": cut.cast("bigint")})
    kinds = {o: kind for o, (kind, col) in carry.items() if (kind, col) != ("count", "*")}
    carried = [_CARRY[kind][1](F.col(f"_c_{o}")).alias(f"_c_{o}") for o, kind in kinds.items()]
    coarse = _running(fine.groupBy(*part, "_b").agg(F.sum("_n").alias("_n"), *carried), part, "_b")

    # What rides along is settled here, where no bucket is left out.
    whole = (
        W.partitionBy(*part)
        .orderBy(F.col("_b").asc_nulls_last())
        .rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    totals = {"_t_rows": F.sum("_n").over(whole)}
    totals |= {f"_t_{o}": _CARRY[kind][1](F.col(f"_c_{o}")).over(whole) for o, kind in kinds.items()}

    # The buckets that hold a wanted rank; of a group without known values its only one.
    wanted = ["_total is null"]
    for value, p in quantiles.values():
        for rank in (f"floor({_position(p)})", f"ceil({_position(p)})"):
            here = f"_upto > {rank} and _upto - _n <= {rank}"
            wanted.append(f"(_b is not null and {_of(value, values)} and {here})")
    buckets = coarse.withColumns(totals).filter(" or ".join(wanted)).select(
        *part, "_b", (F.col("_upto") - F.col("_n")).alias("_before"), "_total", *totals
    )
    there = _null_safe_join(fine, buckets, [*part, "_b"])
    # The same once more inside the buckets found.
    parts = there.groupBy(*part, "_b", "_b2").agg(
        F.sum("_n").alias("_n"), F.first("_before").alias("_before"), F.first("_total").alias("_total")
    )
    upto = W.partitionBy(*part, "_b").orderBy(F.col("_b2").asc_nulls_last()).rowsBetween(W.unboundedPreceding, W.currentRow)
    parts = parts.withColumn("_upto", F.col("_before") + F.sum("_n").over(upto)).filter(" or ".join(wanted))
    starts = parts.select(*part, "_b", "_b2", (F.col("_upto") - F.col("_n")).alias("_from"))
    within = W.partitionBy(*part, "_b", "_b2").orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow)
    found = _null_safe_join(there, starts, [*part, "_b", "_b2"])
    return found.withColumn("_upto", F.col("_from") + F.sum("_n").over(within))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on all keys: NULL keys are groups too, and no filter sets the two sides apart."""
    named = right.withColumnsRenamed({c: f"_k{i}" for i, c in enumerate(keys)})
    same = F.lit(True)
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    return left.join(named, same).drop(*[f"_k{i}" for i in range(len(keys))])


def _totals(ranked: DataFrame, values, out: str, kind: str, col: str) -> Column:
    """A column that rode along, summed up per group."""
    first, second = _of(values[0], values), _CARRY[kind][1]
    if (kind, col) == ("count", "*"):
        if "_t_rows" in ranked.columns:
            return F.expr(f"max(case when {first} then _t_rows end)")
        return F.expr(f"sum(case when {first} then _n end)")
    if f"_t_{out}" in ranked.columns:
        # The second form is NULL whenever the first is. It makes both sides of the join ask
        # for the same columns, so that Spark runs the shuffle they share once.
        return F.coalesce(F.max(f"_t_{out}"), second(F.col(f"_c_{out}")))
    return second(F.col(f"_c_{out}"))


def _pick(ranked, keys, values, quantiles, carry) -> DataFrame:
    """The order statistics around each quantile, and what rode along."""
    aggs, result = [], []
    for i, (out, (value, p)) in enumerate(quantiles.items()):
        pos, mine = _position(p), _of(value, values)
        aggs += [
            F.expr(f"double(min(case when {mine} and _upto > floor({pos}) then _v end)) as _lo{i}"),
            F.expr(f"double(min(case when {mine} and _upto > ceil({pos}) then _v end)) as _hi{i}"),
            F.expr(f"max(case when {mine} then {pos} - floor({pos}) end) as _w{i}"),
        ]
        result.append(F.expr(f"_lo{i} + (_hi{i} - _lo{i}) * _w{i}").alias(out))
    for out, (kind, col) in carry.items():
        aggs.append(_totals(ranked, values, out, kind, col).alias(out))
        result.append(F.col(out))
    return ranked.groupBy(*keys).agg(*aggs).select(*keys, *result)
