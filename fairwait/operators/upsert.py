from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ntz
from .windows import dedup_latest


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def instant(df: DataFrame, col: str) -> Column:
    """``col`` as UTC time without zone. ISO text may end in a zone, "Z" or an offset; text
    without one is UTC already."""
    c = F.col(col)
    if dict(df.dtypes)[col] != "string":
        return c.cast("timestamp_ntz")
    # A zone has six characters at most, and a line may end behind it: most text is told by a look at its end.
    end = F.substring(c, -8, 8)
    zoned = (end.contains("Z") | end.contains("+") | end.contains("-")) & c.rlike(r"[0-9][T ].*(Z|[+-][0-9]{2}(:?[0-9]{2})?)$")
    there = F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.try_cast("timestamp").cast("timestamp_ntz"))
    return F.when(zoned, there).otherwise(c.try_cast("timestamp_ntz"))


def since_filter(df: DataFrame, col: str, since: datetime) -> Column:
    """Rows whose ``col`` is at or after ``since``. ISO text is bounded as text first, a day
    earlier for zones, so that the bound reaches the Parquet reader."""
    exact = instant(df, col) >= ntz(since)
    if dict(df.dtypes)[col] != "string":
        return exact
    return (F.col(col) >= (since - timedelta(days=1)).date().isoformat()) & exact


def watermark_frame(df: DataFrame, col: str, hours: int = 48, now: datetime | None = None) -> DataFrame:
    """One row, ``watermark``: the newest ``col`` less the buffer; ``now`` less the buffer
    when there is none."""
    newest = F.coalesce(F.max(instant(df, col)), ntz(now or utc_now()))
    return df.agg((newest - F.expr(f"interval {int(hours)} hours")).alias("watermark"))


def get_watermark(df: DataFrame | None, col: str, hours: int = 48, now: datetime | None = None) -> datetime:
    """The watermark as a value, so that filters built on it are literals and push down.

    ``df=None`` stands for a missing table.
    """
    if df is None:
        return (now or utc_now()) - timedelta(hours=hours)
    return watermark_frame(df, col, hours, now).first()["watermark"]


def incremental_filter(
    src: DataFrame,
    target: DataFrame | None,
    col: str = "updated_at",
    hours: int = 48,
    include_null: bool = False,
) -> DataFrame:
    """Source rows at or after the target's newest ``col`` less ``hours``.

    A missing or empty target lets everything pass (a full build). Rows with NULL ``col``
    pass a later build only with ``include_null``.
    """
    newest = None if target is None else target.agg(F.max(col).alias("m")).first()["m"]
    if newest is None:
        return src
    keep = F.col(col) >= ntz(newest - timedelta(hours=hours))
    return src.filter(keep | F.col(col).isNull() if include_null else keep)


def upsert_latest(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Target with updates merged in by key; new columns are appended, NULL for old rows.

    Without ``order`` an update replaces its key's row, and ``updates`` must hold each key
    once. With ``order`` the newest version wins whichever side it is on, and the update
    where both are equally new.
    """
    keys = list(keys)
    if order is None:
        kept = target.join(updates.select(*keys), keys, "left_anti")
        return kept.unionByName(updates, allowMissingColumns=True)
    return dedup_latest(versions_of(target, updates), keys, order, ["_new", *ties]).drop("_new")


def versions_of(target: DataFrame, updates: DataFrame) -> DataFrame:
    """The rows of both sides; ``_new`` is 1 for updates."""
    return target.withColumn("_new", F.lit(0)).unionByName(updates.withColumn("_new", F.lit(1)), allowMissingColumns=True)
