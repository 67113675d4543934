from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import _col


def ntz(value: datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal, whatever the time zone of driver or session."""
    text = value if isinstance(value, str) else value.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def _hour_boundaries(start: Column, end: Column) -> Column:
    # 10:59 -> 11:01 crosses one boundary. Day difference times 24 plus clock hours says
    # so without going through a zoned timestamp, so the session time zone plays no part.
    days = F.datediff(end.cast("date"), start.cast("date")).cast("bigint")
    return days * 24 + F.hour(end) - F.hour(start)


def response_hours(created: Column | str, closed: Column | str) -> Column:
    """Clock-hour boundaries between creation and closing; NULL unless closed after created."""
    created, closed = _col(created), _col(closed)
    return F.when(closed > created, _hour_boundaries(created, closed))


def resolution_status(created: Column | str, closed: Column | str, status: Column | str) -> Column:
    created, closed = _col(created), _col(closed)
    return (
        F.when(closed > created, "closed")
        .when(F.upper(_col(status)) == "OPEN", "open")
        .otherwise("other")
    )


def month_of(ts: Column | str) -> Column:
    """First instant of the month as TIMESTAMP_NTZ (``date_trunc`` would give a zoned one)."""
    return F.trunc(_col(ts).cast("date"), "month").cast("timestamp_ntz")


def season_of(ts: Column | str) -> dict[str, Column]:
    """Columns ``yr``, ``season``, ``season_order`` and ``period`` ("2024 Winter").

    December is Winter of its own calendar year.
    """
    day = _col(ts).cast("date")
    order = (F.floor(F.month(day) % 12 / 3) + 1).cast("int")
    season = F.element_at(F.array(*[F.lit(s) for s in ("Winter", "Spring", "Summer", "Fall")]), order)
    year = F.year(day)
    return {
        "yr": year,
        "season": season,
        "season_order": order,
        "period": F.concat_ws(" ", year.cast("string"), season),
    }
