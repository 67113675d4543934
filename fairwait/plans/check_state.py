"""Checks of versioned tables that read changed partitions only.

What a check judged and failed is kept per partition and summed up for the whole table, so a run works out the partitions that
changed since the last one. Uniqueness over several partitions is kept as the keys that occur more than once, with their rows per
partition: a run looks up the changed partitions' keys in the others (a semi-join on the key columns) and groups no more than these.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import Check, _judge, _outside, _verdict
from ..sinks.tables import batches, partitions, read_or_none, read_partitions, replace_partitions
from .suites import SUITES, keep_results

_UNIQUE = ("unique", "unique_combination")
_WHOLE = ("columns_present", "column_type", "row_count")  # told from the schema and the sum of rows


def run_checkpoint_changed(
    spark: SparkSession,
    path: str,
    part_col: str,
    state_path: str,
    suite: str,
    results_path: str | None = None,
    run_at: datetime | None = None,
    suites: dict[str, list[Check]] | None = None,
) -> DataFrame:
    """``run_checkpoint`` of the versioned table at ``path``, reading the partitions that changed since the last run of the same suite.

    The state is written to ``state_path``; a changed suite or schema starts it anew. The same rows come back as from a full check.
    A table without partitions passes as an empty one. A run that fails before its state is written is done again by the next.
    """
    checks = (suites or SUITES)[suite]
    table = read_or_none(spark, path)
    version, here = partitions(spark, path)
    mark = sha256((repr(checks) + table.schema.json()).encode()).hexdigest()[:16]
    counts = f"{state_path}/counts-{mark}"
    built = (batches(spark, counts) or ["0"])[-1]
    held = partitions(spark, counts)[1]
    changed = [p for p, v in here.items() if v > int(built)]
    gone = [p for p in held if p not in here]
    across = [i for i, c in enumerate(checks) if c.kind in _UNIQUE and part_col not in c.columns]
    if changed or gone or not batches(spark, counts):
        fresh = read_partitions(spark, path, changed)
        rest = [p for p in here if p not in changed]
        for i in across:
            _keep_repeated(spark, path, f"{state_path}/repeated-{mark}-{i}", fresh, rest, part_col, checks[i], version)
        replace_partitions(_per_part(fresh, checks, part_col), counts, part_col, version, [*changed, *gone])
    every = [F.struct(F.lit(i).alias("i"), "n_rows", F.col(f"j{i}").alias("judged"), F.col(f"f{i}").alias("failed")) for i in range(len(checks))]
    sums = read_or_none(spark, counts).select(F.explode(F.array(*every)).alias("s")).select("s.*")
    none = spark.range(len(checks)).select(F.col("id").cast("int").alias("i"), *[F.lit(0).cast("bigint").alias(c) for c in ("n_rows", "judged", "failed")])
    sums = sums.unionByName(none)
    for i in across:
        again = read_or_none(spark, f"{state_path}/repeated-{mark}-{i}")
        zero = F.lit(0).cast("bigint")
        sums = sums.unionByName(again.select(F.lit(i).alias("i"), zero.alias("n_rows"), zero.alias("judged"), F.col("n").alias("failed")))
    total = sums.groupBy("i").agg(*[F.sum(c).alias(c) for c in ("n_rows", "judged", "failed")])
    verdict = F.lit(None)
    for i, check in reversed(list(enumerate(checks))):
        verdict = F.when(F.col("i") == i, _total(table, suite, check)).otherwise(verdict)
    return keep_results(total.select(verdict.alias("r")).select("r.*"), suite, results_path, run_at)


def _total(table: DataFrame, suite: str, check: Check) -> Column:
    judged, failed = F.col("judged"), F.col("failed")
    if check.kind == "row_count":
        judged, failed = F.lit(1), _outside(F.col("n_rows"), check.lo, check.hi).cast("int")
    elif check.kind in _WHOLE:
        judged, failed = _judge(table, check)
    return _verdict(suite, check, F.col("n_rows"), judged, failed)


def _per_part(rows: DataFrame, checks: Sequence[Check], part_col: str) -> DataFrame:
    """(n_rows, j0, f0, j1, ...) per partition: one pass for all values, and one grouped count per uniqueness inside a partition."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    inside = []
    for i, check in enumerate(checks):
        judged, failed = F.lit(0), F.lit(0)
        if check.kind in _UNIQUE:
            judged = F.count(F.lit(1)) if check.kind == "unique_combination" else F.count(check.columns[0])
            if part_col in check.columns:
                inside.append((i, check))
        elif check.kind not in _WHOLE:
            judged, failed = _judge(rows, check)
        aggs += [judged.cast("bigint").alias(f"j{i}"), failed.cast("bigint").alias(f"f{i}")]
    out = rows.groupBy(part_col).agg(*aggs)
    for i, check in inside:
        counted = _known(rows, check).groupBy(*check.columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        twice = counted.groupBy(F.col(part_col).alias("_part")).agg(F.sum("_n").alias("_twice"))
        out = out.join(twice, F.col(part_col).eqNullSafe(F.col("_part")), "left").withColumn(f"f{i}", F.coalesce("_twice", F.lit(0).cast("bigint")))
        out = out.drop("_part", "_twice")
    return out


def _known(rows: DataFrame, check: Check) -> DataFrame:
    return rows if check.kind == "unique_combination" else rows.filter(F.col(check.columns[0]).isNotNull())


def _keep_repeated(
    spark: SparkSession, path: str, target: str, fresh: DataFrame, rest: list[str], part_col: str, check: Check, version: int
) -> None:
    """Replace the repeated keys at ``target``: (key columns, partition, n) for every key with more than one row."""
    keys = list(check.columns)

    def counted(rows: DataFrame) -> DataFrame:
        return _known(rows, check).groupBy(part_col, *keys).agg(F.count(F.lit(1)).alias("n"))

    now = counted(fresh)
    wanted = now.select(*[F.col(k).alias(f"_k{j}") for j, k in enumerate(keys)]).distinct()
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k{j}")) for j, k in enumerate(keys)])
    others = counted(read_partitions(spark, path, rest).select(part_col, *keys).join(wanted, same, "left_semi"))
    if rest and partitions(spark, target)[0]:
        # Keys repeated before, as far as their rows are in partitions that have not changed.
        others = others.unionByName(read_partitions(spark, target, rest).select(*others.columns)).distinct()
    rows = now.unionByName(others)
    total = rows.groupBy(*keys).agg(F.sum("n").alias("_n")).filter("_n > 1").select(*[F.col(k).alias(f"_k{j}") for j, k in enumerate(keys)])
    replace_partitions(rows.join(total, same, "left_semi"), target, part_col, version)
