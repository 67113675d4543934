from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nullif(c: Column | str, value) -> Column:
    """NULL where ``c`` equals ``value``."""
    return F.when(_col(c) != F.lit(value), _col(c))


def round_exact(c: Column | str, digits: int) -> Column:
    """Half-up rounding of a double through decimal, so binary noise cannot flip a tie."""
    return F.round(_col(c).cast("decimal(38,10)"), digits).cast("double")


def safe_ratio(a: Column | str, b: Column | str, digits: int) -> Column:
    """``a / b`` rounded; NULL when ``b`` is zero or either side is NULL."""
    return round_exact(_col(a).cast("double") / nullif(_col(b).cast("double"), 0.0), digits)


def pct_of(a: Column | str, b: Column | str, digits: int = 2) -> Column:
    """``100 * a / b`` in decimal arithmetic, six places of either kept; NULL when ``b`` is zero."""
    share = F.lit(100) * _col(a).cast("decimal(18,6)") / nullif(_col(b).cast("decimal(18,6)"), 0)
    return F.round(share, digits).cast(f"decimal(20,{digits})")
