"""Column helpers. All are built-in expressions, so they stay inside generated code."""

from .numbers import nullif, pct_of, round_exact, safe_ratio
from .text import clean_text, geoid_county
from .times import month_of, ntz, resolution_status, response_hours, season_of

__all__ = [
    "clean_text",
    "geoid_county",
    "month_of",
    "ntz",
    "nullif",
    "pct_of",
    "resolution_status",
    "response_hours",
    "round_exact",
    "safe_ratio",
    "season_of",
]
