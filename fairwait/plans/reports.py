"""Report queries over the marts. Columns called ``avg_*`` hold what the report shows under
that name, which is a median unless the docstring says mean.

Medians of scores over a few groups (quintiles, types) use the ``wide`` form of the quantiles:
scores take any number of distinct values. Per tract there are at most its types and months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geoid_county, ntz, round_exact, season_of
from ..lookups import NO_BOROUGH, NOISE_TYPES
from ..operators.filters import in_set, min_count, not_in_set
from ..operators.joins import lookup_default, reindex_spine
from ..operators.quantiles import grouped_quantiles
from ..operators.windows import top_n_per_group

ROW_FLOOR = 10
VOLUME = {"total_requests": ("sum", "request_count")}


# -- map ---------------------------------------------------------------------------------


def map_rollup(
    splits: DataFrame,
    mode: str,
    boroughs: Sequence[str],
    complaint_type: str | None = None,
    quintiles: Sequence[int] = (),
    floor: int = ROW_FLOOR,
) -> DataFrame:
    """Medians, volume, income and county per tract, for one type or for some quintiles."""
    if mode == "type":
        rows, keys = splits.filter(F.col("complaint_type") == complaint_type), ["tract_geoid", "complaint_type"]
    elif mode == "quintile":
        rows, keys = in_set(splits, "income_quintile", quintiles), ["tract_geoid"]
    else:
        raise ValueError(f"unknown mode {mode!r}")
    rows = min_count(in_set(rows, "borough", boroughs), n=floor)
    measures = ("p50_hours", "p90_hours", "equity_score", "city_p90")
    return grouped_quantiles(
        rows,
        keys,
        {m: (m, 0.5) for m in measures},
        {
            "complaint_count": ("sum", "request_count"),
            "median_household_income": ("max", "median_household_income"),
            "income_quintile": ("max", "income_quintile"),
        },
    ).withColumn("county", geoid_county("tract_geoid"))


# -- income ------------------------------------------------------------------------------


def quintile_rollup(splits: DataFrame, complaint_type: str, floor: int = ROW_FLOOR) -> DataFrame:
    """Median score and P90 per quintile for one type."""
    rows = min_count(splits.filter(F.col("complaint_type") == complaint_type), n=floor)
    return grouped_quantiles(
        rows,
        ["income_quintile"],
        {"avg_equity_score": ("equity_score", 0.5), "avg_p90_hours": ("p90_hours", 0.5)},
        {"total_complaints": ("sum", "request_count")},
        wide=True,
    )


def quintile_ratio(rollup: DataFrame) -> DataFrame:
    """Lowest over highest quintile's P90 from ``quintile_rollup``; no row unless both exist
    and the divisor is not zero."""
    q = {i: F.max(F.when(F.col("income_quintile") == i, F.col("avg_p90_hours"))) for i in (1, 5)}
    sides = rollup.agg(q[1].alias("q1_p90_hours"), q[5].alias("q5_p90_hours"))
    return sides.filter(F.col("q1_p90_hours").isNotNull() & (F.col("q5_p90_hours") != 0)).withColumn(
        "p90_ratio", F.col("q1_p90_hours") / F.col("q5_p90_hours")
    )


def quintile_profile(splits: DataFrame, floor: int = ROW_FLOOR) -> DataFrame:
    rows = min_count(splits.filter(F.col("income_quintile").isNotNull()), n=floor)
    medians = grouped_quantiles(
        rows, ["income_quintile"], {"p90": ("p90_hours", 0.5), "score": ("equity_score", 0.5)}, wide=True
    )
    return medians.select(
        "income_quintile",
        round_exact("p90", 1).alias("avg_p90_hours"),
        round_exact("score", 3).alias("avg_equity_score"),
    )


def tract_scatter(splits: DataFrame, complaint_type: str, floor: int = ROW_FLOOR) -> DataFrame:
    """Income against waiting time per tract and borough for one type."""
    rows = splits.filter((F.col("complaint_type") == complaint_type) & F.col("p90_hours").isNotNull())
    return grouped_quantiles(
        min_count(rows, n=floor),
        ["tract_geoid", "complaint_type", "borough"],
        {"p90_hours": ("p90_hours", 0.5), "equity_score": ("equity_score", 0.5)},
        {
            "median_household_income": ("max", "median_household_income"),
            "complaint_count": ("sum", "request_count"),
        },
    )


def trend_fit(df: DataFrame, x: str = "median_household_income", y: str = "p90_hours") -> DataFrame:
    """Least-squares slope and intercept over complete pairs; no row with fewer than two."""
    pairs = df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).dropna()
    return pairs.agg(
        F.count(F.lit(1)).alias("n_points"),
        F.regr_slope("_y", "_x").alias("slope"),
        F.regr_intercept("_y", "_x").alias("intercept"),
        F.min("_x").alias("x_min"),
        F.max("_x").alias("x_max"),
    ).filter("n_points > 1")


def income_trend_line(
    df: DataFrame, x: str = "median_household_income", y: str = "p90_hours", n: int = 200
) -> DataFrame:
    """``n`` evenly spaced points of the fitted line."""
    step = (F.col("x_max") - F.col("x_min")) / (n - 1)
    at = trend_fit(df, x, y).select(
        "slope", "intercept", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.col("x_min") + i * step))
    )
    return at.select(
        F.col("pos").alias("i"), F.col("col").alias("x"), (F.col("slope") * F.col("col") + F.col("intercept")).alias("y")
    )


# -- boroughs and types ------------------------------------------------------------------


def borough_type_rollup(splits: DataFrame) -> DataFrame:
    """Means and volume per borough and type; no row floor."""
    return splits.groupBy("borough", "complaint_type").agg(
        F.avg("p50_hours").alias("p50_hours"),
        F.avg("p90_hours").alias("p90_hours"),
        F.sum("request_count").alias("complaint_count"),
        F.avg("equity_score").alias("avg_equity_score"),
    )


def pivot_matrix(
    df: DataFrame,
    index: str,
    columns: str,
    value: str,
    names: Sequence,
    prefix: str = "",
    rows: DataFrame | None = None,
) -> DataFrame:
    """Mean of ``value`` with one column per entry of ``names``; ``rows`` fixes which index
    values appear."""
    wide = df.groupBy(index).pivot(columns, list(names)).agg(F.avg(value))
    wide = wide.select(index, *[F.col(f"`{n}`").alias(f"{prefix}{n}") for n in names])
    return wide if rows is None else reindex_spine(wide, rows, index)


def borough_quintile_score(splits: DataFrame, floor: int = ROW_FLOOR) -> DataFrame:
    rows = not_in_set(splits, "borough", NO_BOROUGH).filter(F.col("income_quintile").isNotNull())
    medians = grouped_quantiles(
        min_count(rows, n=floor), ["borough", "income_quintile"], {"score": ("equity_score", 0.5)}, wide=True
    )
    return medians.select("borough", "income_quintile", round_exact("score", 3).alias("avg_equity_score"))


def top_k_types(rollup: DataFrame, k: int = 10) -> DataFrame:
    """Busiest types of ``borough_type_rollup`` with the mean score over boroughs."""
    return (
        rollup.groupBy("complaint_type")
        .agg(F.sum("complaint_count").alias("total_complaints"), F.avg("avg_equity_score").alias("avg_equity"))
        .orderBy(F.col("total_complaints").desc_nulls_last(), "complaint_type")
        .limit(k)
    )


def top_complaints(splits: DataFrame, k: int = 10, floor: int = ROW_FLOOR) -> DataFrame:
    medians = grouped_quantiles(
        min_count(splits, n=floor),
        ["complaint_type"],
        {"p90": ("p90_hours", 0.5), "score": ("equity_score", 0.5)},
        VOLUME,
        wide=True,
    )
    return (
        medians.orderBy(F.col("total_requests").desc_nulls_last(), "complaint_type")
        .limit(k)
        .select(
            "complaint_type",
            "total_requests",
            round_exact("p90", 1).alias("avg_p90_hours"),
            round_exact("score", 3).alias("avg_equity_score"),
        )
    )


def slowest_types(splits: DataFrame, n: int = 3, floor: int = 500) -> DataFrame:
    """The ``n`` types with the largest mean P90 per borough, among those with volume."""
    totals = (
        not_in_set(splits, "borough", NO_BOROUGH)
        .groupBy("borough", "complaint_type")
        .agg(F.avg("p90_hours").alias("_p90"), F.sum("request_count").alias("total_requests"))
        .filter(F.col("total_requests") >= floor)
        # Rank what is reported to ten places, so that summation order cannot swap a tie.
        .withColumn("_p90", round_exact("_p90", 10))
    )
    return top_n_per_group(totals, ["borough"], "_p90", n, ["complaint_type"]).select(
        "borough", "complaint_type", round_exact("_p90", 1).alias("avg_p90_hours"), "total_requests", "rn"
    )


# -- agencies ----------------------------------------------------------------------------


def type_quintile_medians(splits: DataFrame, floor: int = ROW_FLOOR) -> DataFrame:
    return grouped_quantiles(
        min_count(splits, n=floor),
        ["complaint_type", "income_quintile"],
        {"avg_equity_score": ("equity_score", 0.5)},
        VOLUME,
        wide=True,
    )


def agency_rollup(
    splits: DataFrame,
    lookup: DataFrame,
    agencies: Sequence[str] | None = None,
    sort: str = "gap",
    floor: int = ROW_FLOOR,
    default: str = "Other",
) -> DataFrame:
    """Volume and unweighted mean of the types' medians for the lowest and highest quintile
    per agency; agencies without either are left out."""
    if sort not in ("gap", "total_requests"):
        raise ValueError(f"unknown sort {sort!r}")
    named = lookup_default(type_quintile_medians(splits, floor), "complaint_type", lookup, "agency", default)
    sides = {
        q: F.avg(F.when(F.col("income_quintile") == q, F.col("avg_equity_score"))).alias(f"q{q}_avg_equity")
        for q in (1, 5)
    }
    table = (
        named.groupBy("agency")
        .agg(F.sum("total_requests").alias("total_requests"), sides[1], sides[5])
        .dropna(subset=["q1_avg_equity", "q5_avg_equity"])
        .withColumn("gap", F.col("q1_avg_equity") - F.col("q5_avg_equity"))
    )
    if agencies is not None:
        table = in_set(table, "agency", agencies)
    return table.orderBy(F.col(sort).desc_nulls_last(), "agency")


# -- trends ------------------------------------------------------------------------------


def score_trend(splits: DataFrame, quintiles: Sequence[int] = (1, 5), floor: int = ROW_FLOOR) -> DataFrame:
    """Median score and volume by month for the outer quintiles."""
    return grouped_quantiles(
        min_count(in_set(splits, "income_quintile", quintiles), n=floor),
        ["request_month", "income_quintile"],
        {"avg_equity_score": ("equity_score", 0.5)},
        VOLUME,
        wide=True,
    )


def season_trend(trend: DataFrame) -> DataFrame:
    """``score_trend`` by season: mean of the monthly medians, and volume."""
    return (
        trend.withColumns(season_of("request_month"))
        .groupBy("yr", "season", "season_order", "period", "income_quintile")
        .agg(F.avg("avg_equity_score").alias("avg_equity_score"), F.sum("total_requests").alias("total_requests"))
    )


def volume_compare(trend: DataFrame, period: str, spine: DataFrame | None = None) -> DataFrame:
    """Volume of the lowest and highest quintile and their difference per period; a period
    without requests counts zero."""
    by = {q: F.coalesce(F.sum(F.when(F.col("income_quintile") == q, F.col("total_requests"))), F.lit(0)) for q in (1, 5)}
    table = trend.groupBy(period).agg(by[1].alias("q1_requests"), by[5].alias("q5_requests"))
    if spine is not None:
        table = reindex_spine(table, spine, period, {"q1_requests": 0, "q5_requests": 0})
    return table.withColumn("q1_minus_q5", F.col("q1_requests") - F.col("q5_requests"))


# -- headline ----------------------------------------------------------------------------


def headline_kpis(gap: DataFrame, cluster: Sequence[str] = NOISE_TYPES) -> DataFrame:
    """The largest gap with its type, and the cluster's median gap and volume."""
    named = F.col("complaint_type").isin(list(cluster))
    largest_first = F.struct(
        (-F.col("q1_over_q5_gap")).alias("neg"), "complaint_type", "q1_p90_hours", "q5_p90_hours",
        "q1_n_complaints", "q5_n_complaints",
    )
    one = gap.agg(
        F.min(F.when(F.col("q1_over_q5_gap").isNotNull(), largest_first)).alias("top"),
        F.median(F.when(named, F.col("q1_over_q5_gap"))).alias("cluster_gap"),
        F.sum(F.when(named, F.col("q1_n_complaints"))).alias("cluster_q1_complaints"),
    )
    return one.select(
        F.col("top.complaint_type").alias("top_type"),
        (-F.col("top.neg")).alias("top_gap"),
        F.col("top.q1_p90_hours").alias("top_q1_p90_hours"),
        F.col("top.q5_p90_hours").alias("top_q5_p90_hours"),
        "cluster_gap",
        "cluster_q1_complaints",
    )


def ranked_gaps(
    gap: DataFrame, lookup: DataFrame, order: str = "volume", k: int = 10, floor: int = 5000
) -> DataFrame:
    """The ``k`` first types by volume or by gap, with their agency. The volume floor acts
    after the limit, so fewer rows may remain; ``floor=0`` shows thin types too."""
    total = F.col("q1_n_complaints") + F.col("q5_n_complaints")
    first = {"volume": F.col("total_requests"), "gap": F.col("q1_over_q5_gap")}[order]
    top = gap.withColumn("total_requests", total).orderBy(first.desc_nulls_last(), "complaint_type").limit(k)
    return lookup_default(top.filter(F.col("q1_n_complaints") >= floor), "complaint_type", lookup, "agency", "Various")


# -- looking around ----------------------------------------------------------------------


def coverage_rate(df: DataFrame, x: str = "longitude", y: str = "latitude", tract: str = "tract_geoid") -> DataFrame:
    """Rows, rows with coordinates, rows with a tract, and the share of the latter."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(x).isNotNull() & F.col(y).isNotNull()).alias("n_coords"),
        F.count(tract).alias("n_matched"),
        F.avg(F.col(tract).isNotNull().cast("double")).alias("coverage"),
    )


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def distinct_count(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.countDistinct(col).alias("n_distinct"))


def load_counts(raw: DataFrame, stamp: str = "ingestion_timestamp") -> DataFrame:
    """Rows per day of ingestion, newest first."""
    return (
        raw.groupBy(F.to_date(stamp).alias("load_date"))
        .agg(F.count(F.lit(1)).alias("rows_loaded"))
        .orderBy(F.col("load_date").desc_nulls_first())
    )


def score_histogram(splits: DataFrame, digits: int = 1) -> DataFrame:
    return (
        splits.groupBy(round_exact("equity_score", digits).alias("score_bucket"))
        .agg(F.count(F.lit(1)).alias("tract_months"))
        .orderBy("score_bucket")
    )


def type_ranking(splits: DataFrame, n: int = 10) -> DataFrame:
    """Types with the largest mean score."""
    means = splits.groupBy("complaint_type").agg(
        F.avg("city_p90").alias("avg_city_p90"), round_exact(F.avg("equity_score"), 10).alias("avg_score")
    )
    return means.orderBy(F.col("avg_score").desc_nulls_last(), "complaint_type").limit(n)


def month_extent(splits: DataFrame, quintiles: Sequence[int] = (1, 5)) -> DataFrame:
    return in_set(splits, "income_quintile", quintiles).agg(
        F.min("request_month").alias("first_month"), F.max("request_month").alias("last_month")
    )


def last_refresh(raw: DataFrame, stamp: str = "ingestion_timestamp") -> DataFrame:
    """The newest stamp to the minute, "Unknown" when there is none."""
    text = F.substring(F.max(stamp).cast("string"), 1, 16)
    return raw.agg(F.coalesce(text, F.lit("Unknown")).alias("last_refresh"))


def freshness_check(df: DataFrame, stamp: str, warn_hours: int = 25, error_hours: int = 49, now=None) -> DataFrame:
    """Age of the newest load in hours and its status: pass, warn or error."""
    at = F.current_timestamp().cast("timestamp_ntz") if now is None else ntz(now)
    newest = df.agg(F.max(stamp).alias("newest"))
    seconds = F.timestamp_diff("SECOND", F.col("newest"), at)
    return newest.select(
        "newest",
        (seconds / 3600.0).alias("age_hours"),
        F.when(F.col("newest").isNull() | (seconds > error_hours * 3600), "error")
        .when(seconds > warn_hours * 3600, "warn")
        .otherwise("pass")
        .alias("status"),
    )
