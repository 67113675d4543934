from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ntz

DEFAULT_START = "2020-01-01"
_ISO_DAY = re.compile(r"^\d{4}-\d{2}-\d{2}$")


def closed_requests(df: DataFrame, created: str = "created_at", closed: str = "closed_at") -> DataFrame:
    """Requests closed after they were created."""
    return df.filter(F.col(closed).isNotNull() & (F.col(closed) > F.col(created)))


def date_range(
    df: DataFrame,
    col: str,
    start: str | None = None,
    end: str | None = None,
    default_start: str = DEFAULT_START,
    default_end: str | None = None,
) -> DataFrame:
    """Rows from ``start`` to ``end``, both included.

    Input that does not look like yyyy-mm-dd is replaced by its default (end: today).
    """
    lo = start if start and _ISO_DAY.match(start) else default_start
    hi = end if end and _ISO_DAY.match(end) else (default_end or date.today().isoformat())
    return df.filter(F.col(col).between(ntz(lo), ntz(hi)))


def in_set(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(col).isin(list(values)))


def not_in_set(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose value is known and not listed; NULL is dropped as SQL's NOT IN does."""
    return df.filter(~F.col(col).isin(list(values)))


def min_count(df: DataFrame, col: str = "request_count", n: int = 10) -> DataFrame:
    return df.filter(F.col(col) >= n)


def search_reference(
    df: DataFrame, term: str | None, type_col: str = "complaint_type", text_col: str | None = "description"
) -> DataFrame:
    """Case-insensitive substring search in type or text; an empty term keeps all rows.

    ``text_col=None`` searches the type only, as for types without a description.
    """
    needle = (term or "").strip().lower()
    if not needle:
        return df
    hit = F.lower(type_col).contains(needle)
    if text_col:
        hit = hit | F.coalesce(F.lower(text_col).contains(needle), F.lit(False))
    return df.filter(hit)
