from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean_text, ntz
from ..schemas import DEMOGRAPHIC_MEASURES
from .windows import dedup_latest

# Cleaned name -> (raw column, treatment), in output order.
REQUEST_SPEC: dict[str, tuple[str, str]] = {
    "unique_key": ("unique_key", "as_is"),
    "created_at": ("created_date", "timestamp"),
    "closed_at": ("closed_date", "timestamp"),
    "updated_at": ("resolution_action_updated_date", "timestamp"),
    "agency_code": ("agency", "upper"),
    "agency_name": ("agency_name", "upper"),
    "complaint_type": ("complaint_type", "upper"),
    "descriptor": ("descriptor", "upper"),
    "location_type": ("location_type", "upper"),
    "incident_zip": ("incident_zip", "trim"),
    "incident_address": ("incident_address", "trim"),
    "borough": ("borough", "upper"),
    "status": ("status", "upper"),
    "channel_type": ("open_data_channel_type", "trim"),
    "resolution_description": ("resolution_description", "as_is"),
    "latitude": ("latitude", "double"),
    "longitude": ("longitude", "double"),
    "tract_geoid": ("tract_geoid", "as_is"),
    "ingestion_timestamp": ("ingestion_timestamp", "as_is"),
}

# What tells the newest version of a request; ties are broken by content.
VERSION_ORDER = ("updated_at", "ingestion_timestamp")


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text to double; whatever is not a number becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols})


def null_sentinel(df: DataFrame, cols: Sequence[str], sentinel: float = -666_666_666) -> DataFrame:
    """Values at or below the sentinel mean "suppressed" and become NULL."""
    return df.withColumns({c: F.when(F.col(c) > F.lit(sentinel), F.col(c)) for c in cols})


def _treat(raw: str, how: str, on_error: str) -> Column:
    c = F.col(raw)
    if how in ("timestamp", "double"):
        to = "timestamp_ntz" if how == "timestamp" else "double"
        return c.try_cast(to) if on_error == "null" else c.cast(to)
    if how in ("upper", "trim"):
        return clean_text(c, upper=how == "upper")
    return c


def normalize_requests(
    df: DataFrame,
    spec: dict[str, tuple[str, str]] = REQUEST_SPEC,
    key: str = "unique_key",
    on_error: str = "raise",
) -> DataFrame:
    """Typed, trimmed and renamed requests with a key. A malformed timestamp fails the job
    unless ``on_error="null"``."""
    if on_error not in ("raise", "null"):
        raise ValueError(f"unknown on_error {on_error!r}")
    return df.filter(F.col(key).isNotNull()).select(
        *[_treat(raw, how, on_error).alias(name) for name, (raw, how) in spec.items()]
    )


def stage_requests(
    raw: DataFrame,
    ties: Sequence[str] | None = None,
    on_error: str = "raise",
    since: datetime | str | None = None,
) -> DataFrame:
    """Cleaned requests, the latest version of each key.

    Equal or NULL update times fall back to the newest load, then to ``ties``; by default
    all remaining columns, so that the outcome never depends on row order. ``since`` keeps
    keys whose latest update is at or after it; older versions drop out before the shuffle,
    which gives the same rows as filtering afterwards.
    """
    clean = request_versions(raw, on_error, since)
    if ties is None:
        ties = [c for c in clean.columns if c not in ("unique_key", *VERSION_ORDER)]
    return dedup_latest(clean, ["unique_key"], VERSION_ORDER, ties)


def request_versions(raw: DataFrame, on_error: str = "raise", since: datetime | str | None = None) -> DataFrame:
    """Cleaned requests in all their versions, those updated ``since`` if it is given."""
    if since is not None:
        # The same bound on the raw text, a day earlier for zones, reaches the Parquet reader.
        source = REQUEST_SPEC["updated_at"][0]
        bound = since if isinstance(since, datetime) else datetime.fromisoformat(since)
        if dict(raw.dtypes)[source] == "string":
            raw = raw.filter(F.col(source) >= (bound - timedelta(days=1)).date().isoformat())
    clean = normalize_requests(raw, on_error=on_error)
    if since is not None:
        clean = clean.filter(F.col("updated_at") >= ntz(since))
    return clean


def normalize_demographics(
    df: DataFrame, id_prefix: str = "1400000US", state_code: str = "36"
) -> DataFrame:
    """Tract ids and whole-number measures; rows without an id are dropped."""
    measures = [F.round(F.col(code)).cast("int").alias(name) for code, name in DEMOGRAPHIC_MEASURES.items()]
    return df.filter(F.col("geo_id").isNotNull()).select(
        F.replace(F.col("geo_id"), F.lit(id_prefix), F.lit("")).alias("tract_geoid"),
        F.concat(F.lit(state_code), F.col("county"), F.col("tract")).alias("fips_full"),
        F.col("state").alias("state_fips"),
        F.col("county").alias("county_fips"),
        F.col("tract").alias("tract_code"),
        F.col("county_fips").alias("nyc_county_fips"),
        *measures,
        "vintage_year",
    )


def rename_case(df: DataFrame, how: str = "lower") -> DataFrame:
    """All column names in lower or upper case."""
    change = {"lower": str.lower, "upper": str.upper}[how]
    return df.toDF(*[change(c) for c in df.columns])


def stamp_refresh(df: DataFrame, ts: datetime | None = None, col: str = "mart_refreshed_at") -> DataFrame:
    """Add the time of refresh; ``ts`` fixes it for repeatable runs."""
    stamp = F.current_timestamp().cast("timestamp_ntz") if ts is None else ntz(ts)
    return df.withColumn(col, stamp)
