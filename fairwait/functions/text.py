from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..lookups import COUNTY_BOROUGH, OTHER_COUNTY
from .numbers import _col


def clean_text(c: Column | str, upper: bool = True) -> Column:
    trimmed = F.trim(_col(c))
    return F.upper(trimmed) if upper else trimmed


def geoid_county(
    geoid: Column | str,
    names: dict[str, str] = COUNTY_BOROUGH,
    other: str = OTHER_COUNTY,
) -> Column:
    """Name of the county coded in characters 3-5 of a tract id.

    Ids shorter than five characters come back unchanged; unknown codes give ``other``.
    """
    geoid = _col(geoid)
    code = F.substring(geoid, 3, 3)
    name = F.lit(other)
    for key, label in names.items():
        name = F.when(code == key, label).otherwise(name)
    return F.when(F.length(geoid) < 5, geoid).when(geoid.isNotNull(), name)
