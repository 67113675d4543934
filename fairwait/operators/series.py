from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import round_exact


def series_text(
    df: DataFrame, group: Sequence[str], order: str, value: str, digits: int = 2, out: str = "series"
) -> DataFrame:
    """"2024-01=0.98, 2024-02=1.02, ..." per group, in time order.

    The input is a monthly report, so a group has one entry per month.
    """
    entry = F.concat(
        F.date_format(order, "yyyy-MM"),
        F.lit("="),
        F.format_string(f"%.{digits}f", round_exact(value, digits)),
    )
    return (
        df.select(*group, F.col(order).alias("_ord"), entry.alias("_entry"))
        .groupBy(*group)
        .agg(F.expr("listagg(_entry, ', ') within group (order by _ord)").alias(out))
    )


def row_text(df: DataFrame, digits: int = 6) -> Column:
    """Every column of a row with its name, in the order of the names, and a mark of its own for NULL.

    Numbers with fractions are written with ``digits`` places, times to the microsecond.
    """

    def shown(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            return F.format_string(f"%.{digits}f", round_exact(c, digits))
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return c.cast("string")

    parts = [F.when(F.col(f"`{f.name}`").isNull(), f"{f.name} null").otherwise(F.concat(F.lit(f"{f.name}="), shown(f))) for f in sorted(df.schema, key=lambda f: f.name)]
    return F.concat_ws("\x1f", *parts)


def result_fingerprint(dfs: Mapping[str, DataFrame]) -> DataFrame:
    """One row, ``fingerprint``: equal for equal tables whatever their row order.

    Names of tables and columns count, and so does the place of a NULL. Each table folds to a count and a
    sum of 60-bit row hashes before anything meets.
    """
    parts = []
    for name, df in sorted(dfs.items()):
        hashed = F.conv(F.substring(F.md5(row_text(df)), 1, 15), 16, 10).cast("decimal(38,0)")
        rows = df.select(hashed.alias("_h"))
        parts.append(
            rows.agg(F.count(F.lit(1)).alias("_n"), F.coalesce(F.sum("_h"), F.lit(0)).alias("_s")).select(
                F.concat_ws(":", F.lit(name), F.col("_n"), F.col("_s")).alias("_p")
            )
        )
    folded = parts[0]
    for part in parts[1:]:
        folded = folded.unionAll(part)
    return folded.agg(F.md5(F.expr("listagg(_p, '|') within group (order by _p)")).alias("fingerprint"))
