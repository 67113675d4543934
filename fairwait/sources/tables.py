from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ntz


def scan_since(df: DataFrame, ts_col: str, watermark: datetime | str, ordered: bool = False) -> DataFrame:
    """Rows at or after the watermark, a literal that reaches the Parquet reader.

    ``ordered`` sorts them ascending; leave it off unless something reads in order, since a
    global sort shuffles the whole increment.
    """
    hits = df.filter(F.col(ts_col) >= ntz(watermark))
    return hits.orderBy(ts_col) if ordered else hits


def scan_month(df: DataFrame, ts_col: str, year: int, month: int) -> DataFrame:
    """Rows of one calendar month, half-open, so the last second keeps its fractions."""
    after = date(year + month // 12, month % 12 + 1, 1)
    start = date(year, month, 1).isoformat()
    return df.filter((F.col(ts_col) >= ntz(start)) & (F.col(ts_col) < ntz(after.isoformat())))


def month_spine(spark: SparkSession, start: date | str, end: date | str, out: str = "month") -> DataFrame:
    """The first instant of every month from ``start`` to ``end``."""
    bounds = [F.trunc(F.lit(str(d)).cast("date"), "month") for d in (start, end)]
    months = F.sequence(*bounds, F.expr("interval 1 month"))
    spine = spark.range(1).select(F.explode(months).alias(out))
    return spine.select(F.col(out).cast("timestamp_ntz"))


def read_parquet_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table by column name, whatever its case, in the given schema.

    Extra columns are left unread; absent ones are NULL.
    """
    found = spark.read.parquet(path)
    by_name = {c.lower(): c for c in found.columns}
    return found.select(
        *[
            (F.col(by_name[f.name.lower()]) if f.name.lower() in by_name else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )


def explore_raw(df: DataFrame, stamp_col: str, n: int = 5) -> tuple[DataFrame, DataFrame]:
    """A preview of ``n`` rows, and the row count with the latest stamp."""
    summary = df.agg(F.count(F.lit(1)).alias("n_rows"), F.max(stamp_col).alias("latest"))
    return df.limit(n), summary
