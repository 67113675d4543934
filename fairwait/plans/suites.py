"""The check suites of the tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ntz
from ..lookups import BOROUGHS
from ..operators.quality import (
    Check,
    check_accepted_range,
    check_accepted_values,
    check_between_mostly,
    check_column_type,
    check_columns_present,
    check_in_set,
    check_not_in_set,
    check_not_null,
    check_percentile_order,
    check_row_count,
    check_unique,
    check_unique_combination,
    run_checks,
)
from ..sinks.tables import append_raw

QUINTILES = (1, 2, 3, 4, 5)


def _not_null(*cols: str) -> list[Check]:
    return [check_not_null(c) for c in cols]


# What each table must satisfy.
SUITES: dict[str, list[Check]] = {
    "raw_requests": [
        check_columns_present(
            [
                "unique_key", "created_date", "closed_date", "resolution_action_updated_date", "agency",
                "complaint_type", "borough", "latitude", "longitude", "tract_geoid", "status",
                "ingestion_timestamp",
            ]
        ),
        check_not_null("unique_key"),
        check_unique("unique_key", severity="warn"),
        check_not_null("created_date"),
        check_between_mostly("latitude", 40.4, 41.0, 0.9),
        check_between_mostly("longitude", -74.3, -73.7, 0.9),
        check_row_count(1),
    ],
    "staging_requests": [
        check_unique("unique_key"),
        check_not_null("unique_key"),
        check_not_null("created_at"),
        check_not_null("borough", severity="warn"),
        check_accepted_values("borough", [*BOROUGHS, "UNSPECIFIED"], severity="warn"),
        check_column_type("latitude", "double"),
        check_column_type("created_at", "timestamp_ntz"),
        check_between_mostly("latitude", 40.4, 41.0, 0.9),
        check_not_in_set("borough", [None, ""], 0.95),
    ],
    "staging_demographics": [
        check_unique("tract_geoid"),
        check_not_null("tract_geoid"),
        check_not_null("median_household_income", severity="warn"),
    ],
    "intermediate": [
        check_unique("unique_key"),
        check_not_null("unique_key"),
        check_not_null("response_time_hours", severity="warn"),
    ],
    "dim_tract": [
        check_unique("tract_geoid"),
        check_not_null("tract_geoid"),
        check_not_null("median_household_income"),
        check_between_mostly("median_household_income", 1),
        check_row_count(2100, 2500),
        check_between_mostly("pct_below_poverty", 0, 100),
        check_in_set("income_quintile", QUINTILES),
    ],
    "request_facts": [
        check_unique("unique_key"),
        *_not_null("unique_key", "response_time_hours", "tract_geoid"),
    ],
    "equity_splits": [
        *_not_null(
            "tract_geoid", "complaint_type", "request_month", "p50_hours", "p75_hours", "p90_hours",
            "request_count", "income_quintile",
        ),
        check_between_mostly("equity_score", 0.01, 100),
        check_in_set("income_quintile", QUINTILES),
        check_between_mostly("request_count", 1),
        check_row_count(10000),
        check_percentile_order(),
        check_unique_combination(["tract_geoid", "complaint_type", "request_month"]),
    ],
    "quintile_summary": [
        *_not_null(
            "complaint_type", "income_quintile", "n_tracts", "n_complaints", "median_tract_p90_hours",
            "median_tract_p50_hours",
        ),
        check_accepted_values("income_quintile", QUINTILES),
        check_unique_combination(["complaint_type", "income_quintile"]),
    ],
    "gap_by_type": [
        *_not_null("complaint_type", "q1_over_q5_gap", "q1_p90_hours", "q5_p90_hours"),
        check_unique("complaint_type"),
        check_accepted_range("q1_over_q5_gap", 0, 25),
    ],
    "trend_monthly": [
        *_not_null("month", "income_quintile", "p90_hours"),
        check_accepted_values("income_quintile", QUINTILES),
        check_unique_combination(["month", "income_quintile"]),
    ],
}


def run_checkpoint(
    df: DataFrame,
    suite: str,
    results_path: str | None = None,
    run_at: datetime | None = None,
    suites: dict[str, list[Check]] | None = None,
) -> DataFrame:
    """Run a table's suite; with ``results_path`` the results are appended there and read
    back from the run's own rows, so the checks run once."""
    return keep_results(run_checks(df, (suites or SUITES)[suite], suite), suite, results_path, run_at)


def keep_results(results: DataFrame, suite: str, results_path: str | None, run_at: datetime | None) -> DataFrame:
    """Results with the time of the run, appended to ``results_path`` (if given) and read back."""
    at = ntz(run_at or datetime.now(timezone.utc))
    results = results.withColumn("run_at", at)
    if results_path is None:
        return results
    append_raw(results, results_path)
    stored = results.sparkSession.read.parquet(results_path)
    return stored.filter((F.col("table_name") == suite) & (F.col("run_at") == at))
