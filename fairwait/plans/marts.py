"""The marts: from cleaned requests and demographics to scores, summaries, gaps and trends."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import month_of, pct_of, resolution_status, response_hours, round_exact, safe_ratio
from ..operators.cleaning import stamp_refresh
from ..operators.filters import closed_requests
from ..operators.joins import enrich_dim, join_baseline, matched_fact, quintile_self_join
from ..operators.quantiles import grouped_quantiles, value_counts
from ..operators.upsert import incremental_filter, upsert_latest
from ..operators.windows import ntile_bucket

CELL_FLOOR = 30
QUINTILE_FLOOR = 500
TRACT_KEYS = ("tract_geoid", "complaint_type", "request_month", "borough")
BASELINE_KEYS = ("complaint_type", "request_month")
INTERMEDIATE_COLUMNS = [
    "unique_key", "created_at", "closed_at", "updated_at", "agency_code", "agency_name",
    "complaint_type", "descriptor", "location_type", "incident_zip", "incident_address", "borough",
    "status", "channel_type", "resolution_description", "latitude", "longitude", "tract_geoid",
]
FACT_COLUMNS = [
    "unique_key", "created_at", "closed_at", "request_month", "complaint_type", "descriptor",
    "agency_code", "borough", "incident_zip", "channel_type", "tract_geoid", "latitude", "longitude",
    "response_time_hours",
]


def build_intermediate(
    stg: DataFrame, target: DataFrame | None = None, hours: int = 48, also: Sequence[str] = ()
) -> DataFrame:
    """Staged requests with response hours and status, and the columns ``also``; merged into ``target`` when given."""
    have = [c for c in INTERMEDIATE_COLUMNS if c in stg.columns]
    rows = incremental_filter(stg, target, "updated_at", hours).select(
        *have,
        *[how.alias(c) for c, how in outcomes().items()],
        *also,
    )
    return rows if target is None else upsert_latest(target, rows, ["unique_key"])


def outcomes() -> dict[str, Column]:
    """What ``build_intermediate`` adds to staged requests, as expressions of their columns."""
    return {
        "response_time_hours": response_hours("created_at", "closed_at"),
        "resolution_status": resolution_status("created_at", "closed_at", "status"),
    }


def dim_tract(stg: DataFrame, n: int = 5, null_policy: str = "last") -> DataFrame:
    """Tracts with poverty share and income quintile, 1 the poorest."""
    shared = stg.withColumn(
        "pct_below_poverty", pct_of("population_below_poverty", "total_population")
    )
    ranked = ntile_bucket(
        shared, "median_household_income", n, ["tract_geoid"], "income_quintile", null_policy
    )
    return ranked.select(
        "tract_geoid", "fips_full", "state_fips", "county_fips", "tract_code",
        "median_household_income", "total_population", "population_below_poverty",
        "pct_below_poverty", "pop_white_non_hispanic", "pop_hispanic", "pop_black",
        "income_quintile", "vintage_year",
    )


def request_facts(intermediate: DataFrame, dim: DataFrame) -> DataFrame:
    """One row per closed request with a known tract."""
    closed = closed_requests(intermediate)
    matched = matched_fact(closed, dim)
    facts = matched.withColumns(
        {
            "request_month": month_of("created_at"),
            "response_time_hours": response_hours("created_at", "closed_at"),
        }
    )
    return facts.select(*[c for c in FACT_COLUMNS if c in facts.columns])


def tract_stats(
    fact: DataFrame,
    keys: Sequence[str] = TRACT_KEYS,
    probs: Sequence[float] = (0.50, 0.75, 0.90),
    hours: str = "response_time_hours",
    ranges: Sequence[str] = (),
) -> DataFrame:
    """Request count and exact percentiles of the waiting time per cell; ``ranges`` as in ``grouped_quantiles``."""
    named = {f"p{round(p * 100)}_hours": (hours, p) for p in probs}
    return grouped_quantiles(fact, keys, named, {"request_count": ("count", "*")}, ranges=ranges)


def city_baseline(stats: DataFrame, keys: Sequence[str] = BASELINE_KEYS) -> DataFrame:
    """Median of the tracts' P90s: every tract weighs the same."""
    return grouped_quantiles(stats, keys, {"city_p90": ("p90_hours", 0.5)})


def equity_score(fact: DataFrame, dim: DataFrame, refreshed_at: datetime | None = None) -> DataFrame:
    """The splits mart: each tract's P90 over the median tract's, by type and month.

    The baseline needs the same counts per cell as the statistics themselves; rows that one
    of the joins would drop go first, so that both ask for the same shuffles and Spark runs
    them once.
    """
    stats = tract_stats(fact.dropna(subset=["tract_geoid", *BASELINE_KEYS]))
    return score_stats(stats, city_baseline(stats), dim, refreshed_at)


def score_stats(stats: DataFrame, baseline: DataFrame, dim: DataFrame, refreshed_at: datetime | None = None) -> DataFrame:
    """Cell statistics with their tract's figures, baseline and score, and the time of refresh."""
    tracts = dim.select(
        "tract_geoid", "income_quintile", "median_household_income", "pct_below_poverty",
        "total_population", "pop_black", "pop_hispanic",
    )
    joined = join_baseline(enrich_dim(stats, tracts), baseline, BASELINE_KEYS)
    scored = joined.select(
        *TRACT_KEYS,
        "income_quintile", "median_household_income", "pct_below_poverty", "total_population",
        "pop_black", "pop_hispanic", "request_count", "p50_hours", "p75_hours", "p90_hours",
        "city_p90",
        safe_ratio("p90_hours", "city_p90", 4).alias("equity_score"),
    )
    return stamp_refresh(scored, refreshed_at)


STATE_KEYS = ("request_month", "tract_geoid", "complaint_type")


def hour_counts(fact: DataFrame) -> DataFrame:
    """The facts as exact counts per month, tract, type and waiting time: ``quintile_summary`` and ``pooled_trend`` take them with
    ``weight="n_rows"`` and give what they would for the facts. Months are counted apart, so stored counts of months that did not
    change stay as they are, and the quintiles are not in them, so a new dimension does not change them."""
    return value_counts(fact, STATE_KEYS, "response_time_hours")


def with_quintile(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Facts with a waiting time and the quintile of their tract."""
    known = dim.filter(F.col("income_quintile").isNotNull()).select("tract_geoid", "income_quintile")
    return enrich_dim(fact.filter(F.col("response_time_hours").isNotNull()), known)


def cell_percentiles(
    df: DataFrame,
    keys: Sequence[str] = ("tract_geoid", "complaint_type", "income_quintile"),
    floor: int = CELL_FLOOR,
    approx: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """Count, P90 and P50 per tract and type; cells with fewer requests than ``floor`` go."""
    cells = grouped_quantiles(
        df,
        keys,
        {"tract_p90_hours": ("response_time_hours", 0.90), "tract_p50_hours": ("response_time_hours", 0.50)},
        {"tract_complaint_n": ("count", "*")},
        approx=approx,
        weight=weight,
    )
    return cells.filter(F.col("tract_complaint_n") >= floor)


def median_of_cells(
    cells: DataFrame, keys: Sequence[str] = ("complaint_type", "income_quintile")
) -> DataFrame:
    """The summary mart: medians over tracts of their percentiles, in hours."""
    medians = grouped_quantiles(
        cells,
        keys,
        {"p90": ("tract_p90_hours", 0.5), "p50": ("tract_p50_hours", 0.5)},
        {"n_tracts": ("count", "*"), "n_complaints": ("sum", "tract_complaint_n")},
    )
    return medians.select(
        *keys,
        "n_tracts",
        "n_complaints",
        round_exact("p90", 1).alias("median_tract_p90_hours"),
        round_exact("p50", 1).alias("median_tract_p50_hours"),
    )


def quintile_summary(
    fact: DataFrame, dim: DataFrame, floor: int = CELL_FLOOR, approx: bool = False, weight: str | None = None
) -> DataFrame:
    return median_of_cells(cell_percentiles(with_quintile(fact, dim), floor=floor, approx=approx, weight=weight))


def gap_by_type(summary: DataFrame, floor: int = QUINTILE_FLOOR) -> DataFrame:
    """Ratio of the poorest to the richest quintile's waiting time per type, where both have
    at least ``floor`` requests behind them."""
    both = quintile_self_join(
        summary,
        "complaint_type",
        {"n_complaints": "n_complaints", "p90_hours": "median_tract_p90_hours"},
    )
    return both.filter((F.col("q1_n_complaints") >= floor) & (F.col("q5_n_complaints") >= floor)).select(
        "complaint_type",
        "q1_n_complaints",
        "q5_n_complaints",
        "q1_p90_hours",
        "q5_p90_hours",
        safe_ratio("q1_p90_hours", "q5_p90_hours", 2).alias("q1_over_q5_gap"),
    )


def pooled_trend(fact: DataFrame, dim: DataFrame, approx: bool = False, weight: str | None = None) -> DataFrame:
    """P90 and P50 per month and quintile over all requests together."""
    rows = with_quintile(fact.filter(F.col("request_month").isNotNull()), dim)
    pooled = grouped_quantiles(
        rows,
        ["request_month", "income_quintile"],
        {"p90": ("response_time_hours", 0.90), "p50": ("response_time_hours", 0.50)},
        {"n_complaints": ("count", "*")},
        approx=approx,
        weight=weight,
    )
    return pooled.select(
        F.col("request_month").alias("month"),
        "income_quintile",
        "n_complaints",
        round_exact("p90", 1).alias("p90_hours"),
        round_exact("p50", 1).alias("p50_hours"),
    )
