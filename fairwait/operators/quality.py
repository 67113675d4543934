"""Data-quality checks. All checks on values, counts and schema of a table share one
aggregation pass; each uniqueness check adds one grouped count."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """One check. Build it with the ``check_*`` functions below."""

    kind: str
    columns: tuple[str, ...] = ()
    values: tuple = ()
    lo: float | None = None
    hi: float | None = None
    mostly: float = 1.0
    severity: str = "error"
    condition: str | None = None
    null_fails: bool = False

    @property
    def label(self) -> str:
        return ",".join(self.columns) or "*"


def check_not_null(col: str, severity: str = "error", mostly: float = 1.0) -> Check:
    return Check("not_null", (col,), severity=severity, mostly=mostly)


def check_unique(col: str, severity: str = "error") -> Check:
    """No value twice; NULLs are ignored."""
    return Check("unique", (col,), severity=severity)


def check_unique_combination(cols: Sequence[str], severity: str = "error") -> Check:
    """No combination twice; NULLs count as values."""
    return Check("unique_combination", tuple(cols), severity=severity)


def check_accepted_values(col: str, values: Sequence, severity: str = "error") -> Check:
    """Every known value is listed; NULL passes."""
    return Check("accepted_values", (col,), tuple(values), severity=severity)


def check_in_set(col: str, values: Sequence, mostly: float = 1.0, severity: str = "error") -> Check:
    return Check("in_set", (col,), tuple(values), mostly=mostly, severity=severity)


def check_not_in_set(
    col: str, values: Sequence, mostly: float = 1.0, severity: str = "error", null_fails: bool = False
) -> Check:
    """No known value is listed. NULLs are not judged unless ``null_fails``."""
    return Check(
        "not_in_set", (col,), tuple(v for v in values if v is not None),
        mostly=mostly, severity=severity, null_fails=null_fails,
    )


def check_accepted_range(col: str, lo=None, hi=None, severity: str = "error") -> Check:
    """Known values within inclusive bounds; either bound may be absent."""
    return Check("accepted_range", (col,), lo=lo, hi=hi, severity=severity)


def check_between_mostly(col: str, lo=None, hi=None, mostly: float = 1.0, severity: str = "error") -> Check:
    """At least the fraction ``mostly`` of the known values within inclusive bounds."""
    return Check("between_mostly", (col,), lo=lo, hi=hi, mostly=mostly, severity=severity)


def check_columns_present(cols: Sequence[str], severity: str = "error") -> Check:
    """All listed columns exist; more may."""
    return Check("columns_present", tuple(cols), severity=severity)


def check_column_type(col: str, type_name: str, severity: str = "error") -> Check:
    """The column has this Spark type, as ``df.dtypes`` names it."""
    return Check("column_type", (col,), (type_name,), severity=severity)


def check_row_count(lo: int | None = None, hi: int | None = None, severity: str = "error") -> Check:
    return Check("row_count", lo=lo, hi=hi, severity=severity)


def check_percentile_order(cols: Sequence[str] = ("p50_hours", "p75_hours", "p90_hours"), severity: str = "error") -> Check:
    """Percentile columns never decrease from left to right."""
    broken = " or ".join(f"`{a}` > `{b}`" for a, b in zip(cols, cols[1:]))
    return Check("percentile_order", tuple(cols), severity=severity, condition=broken)


def _outside(value: Column, lo, hi) -> Column:
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (value < F.lit(lo))
    if hi is not None:
        bad = bad | (value > F.lit(hi))
    return bad


def _judge(df: DataFrame, check: Check) -> tuple[Column, Column]:
    """(number judged, number failed) as aggregates over the table."""
    every = F.count(F.lit(1))
    if check.kind == "columns_present":
        have = {c.lower() for c in df.columns}
        missing = [c for c in check.columns if c.lower() not in have]
        return F.lit(len(check.columns)), F.lit(len(missing))
    if check.kind == "column_type":
        return F.lit(1), F.lit(int(dict(df.dtypes).get(check.columns[0]) != check.values[0]))
    if check.kind == "row_count":
        return F.lit(1), _outside(every, check.lo, check.hi).cast("int")
    if check.kind == "percentile_order":
        return every, F.count_if(F.expr(check.condition))

    value = F.col(check.columns[0])
    if check.kind == "not_null":
        return every, F.count_if(value.isNull())
    if check.kind in ("accepted_values", "in_set"):
        return F.count(value), F.count_if(~value.isin(list(check.values)))
    if check.kind == "not_in_set":
        listed = value.isin(list(check.values))
        if check.null_fails:
            return every, F.count_if(listed | value.isNull())
        return F.count(value), F.count_if(listed)
    if check.kind in ("accepted_range", "between_mostly"):
        return F.count(value), F.count_if(_outside(value, check.lo, check.hi))
    raise ValueError(f"unknown check {check.kind!r}")


def _verdict(table: str, check: Check, n_rows: Column, judged: Column, failed: Column) -> Column:
    good = F.when(judged > 0, (judged - failed) / judged).otherwise(F.lit(1.0))
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check.kind).alias("check_name"),
        F.lit(check.label).alias("column_name"),
        n_rows.cast("bigint").alias("n_rows"),
        failed.cast("bigint").alias("n_failed"),
        good.cast("double").alias("fraction"),
        F.lit(check.severity).alias("severity"),
        (good >= F.lit(check.mostly)).alias("passed"),
    )


def run_checks(df: DataFrame, checks: Sequence[Check], table: str = "table") -> DataFrame:
    """One row per check: (table_name, check_name, column_name, n_rows, n_failed, fraction,
    severity, passed); ``fraction`` is the share of judged values that are good."""
    results = []
    flat = [c for c in checks if c.kind not in ("unique", "unique_combination")]
    if flat:
        aggs = [F.count(F.lit(1)).alias("_rows")]
        for i, check in enumerate(flat):
            judged, failed = _judge(df, check)
            aggs += [judged.alias(f"_j{i}"), failed.alias(f"_f{i}")]
        one = df.agg(*aggs)
        rows = [
            _verdict(table, c, F.col("_rows"), F.col(f"_j{i}"), F.col(f"_f{i}")) for i, c in enumerate(flat)
        ]
        results.append(one.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
    for check in checks:
        if check in flat:
            continue
        counted = df.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("_n"))
        known = F.lit(True) if check.kind == "unique_combination" else F.col(check.columns[0]).isNotNull()
        one = counted.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
            F.coalesce(F.sum(F.when(known, F.col("_n"))), F.lit(0)).alias("_j"),
            F.coalesce(F.sum(F.when(known & (F.col("_n") > 1), F.col("_n"))), F.lit(0)).alias("_f"),
        )
        verdict = _verdict(table, check, F.col("_rows"), F.col("_j"), F.col("_f"))
        results.append(one.select(verdict.alias("r")).select("r.*"))
    out = results[0]
    for more in results[1:]:
        out = out.unionAll(more)
    return out
