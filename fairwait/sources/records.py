from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ntz
from ..operators.cleaning import coerce_numeric
from ..schemas import RAW_REQUESTS


def read_request_records(
    spark: SparkSession,
    path: str | Sequence[str],
    stamp: datetime | str | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """JSON request records, one per line, in the landed schema.

    The schema is fixed, so a batch without some field still yields that column as NULL.
    Coordinates that are not numbers become NULL. ``stamp`` is the time of ingestion.
    """
    text = T.StructType(
        [T.StructField(f.name, T.StringType()) for f in RAW_REQUESTS if f.name != "ingestion_timestamp"]
    )
    records = coerce_numeric(
        spark.read.schema(text).option("mode", mode).json(path), ["latitude", "longitude"]
    )
    when = F.current_timestamp().cast("timestamp_ntz") if stamp is None else ntz(stamp)
    return records.withColumn("ingestion_timestamp", when).select(*RAW_REQUESTS.names)


def union_sources(
    by_tag: Mapping[str, DataFrame], tag_col: str = "county_fips", vintage_year: int | None = None
) -> DataFrame:
    """One frame per tag, stacked by column name and labelled with the tag."""
    tagged = [df.withColumn(tag_col, F.lit(tag)) for tag, df in by_tag.items()]
    stacked = concat_batches(tagged)
    return stacked if vintage_year is None else stacked.withColumn("vintage_year", F.lit(vintage_year))


def concat_batches(dfs: Sequence[DataFrame]) -> DataFrame:
    """Batches stacked by column name; columns a batch lacks are NULL in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
