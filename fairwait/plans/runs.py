"""Whole runs: daily increment, backfill and the mart build."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import month_of, ntz
from ..operators.cleaning import REQUEST_SPEC, VERSION_ORDER, normalize_demographics, request_versions
from ..operators.quality import Check
from ..operators.spatial import point_in_polygon_join
from ..operators.series import result_fingerprint
from ..operators.upsert import instant, since_filter, utc_now
from ..sinks.tables import (
    DENSE,
    batches,
    by_name,
    committed,
    expire_versions,
    high_water_mark,
    materialise,
    names,
    partition_sizes,
    partitions,
    read_or_none,
    read_text,
    replace_latest,
    replace_partitions,
    upsert_table,
    write_folder,
    write_partition,
    write_text,
)
from . import marts
from .suites import SUITES, run_checkpoint

# Up to so many tracts are sent to all tasks.
BROADCAST_TRACTS = 500_000
# What a cell of the statistics is, within its month.
CELL = [c for c in marts.TRACT_KEYS if c != "request_month"]
# Column by which raw and landed rows tell their load; run dates and backfills.
LOAD = "ingestion_date"


@dataclass(frozen=True)
class LoadResult:
    watermark: datetime
    rows: int


@dataclass(frozen=True)
class Load:
    """A load of raw as its manifest has it: rows, range of update times, rows without one, and a mark that a rerun changes."""

    load: str
    rows: int
    oldest: str | None
    newest: str | None
    undated: int
    mark: str


def load_raw(rows: DataFrame, raw_path: str, load: str, updated: str) -> int:
    """Write ``rows`` as one load into the raw table, a partition of its own which a rerun
    replaces, and its row of the manifest after it. What the manifest says is observed while the rows are written."""
    spark = rows.sparkSession
    if read_or_none(spark, raw_path) is not None:
        have = spark.read.parquet(raw_path).drop(LOAD).schema
        rows = by_name(rows.drop(LOAD), have, "widen")
    at = instant(rows, updated)
    # One folder: there is nothing to bring together.
    found = write_folder(
        rows.drop(LOAD), raw_path, LOAD, load,
        {"oldest": F.min(at).cast("string"), "newest": F.max(at).cast("string"), "undated": F.count_if(at.isNull())}, DENSE,
    )
    row = Load(load, found["n"], found["oldest"], found["newest"], found["undated"] or 0, uuid.uuid4().hex)
    write_text(spark, f"{raw_path}/_loads/{load}", json.dumps(asdict(row)))
    return found["n"]


def manifest(spark: SparkSession, raw_path: str) -> dict[str, Load]:
    """The loads of a raw table; one row each, whatever they hold."""
    if not names(spark, f"{raw_path}/_loads"):
        return {}
    schema = "load string, rows bigint, oldest string, newest string, undated bigint, mark string"
    return {r["load"]: Load(**r.asDict()) for r in spark.read.schema(schema).json(f"{raw_path}/_loads").collect()}


def scanned_manifest(raw: DataFrame, updated: str) -> dict[str, Load]:
    """The same from the rows of a raw table that has no manifest, which takes a scan of it; the null load is named ""."""
    if LOAD not in raw.columns:
        return {}
    at = instant(raw, updated)
    found = raw.groupBy(F.coalesce(F.col(LOAD).cast("string"), F.lit("")).alias("load")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(at).cast("string").alias("oldest"), F.max(at).cast("string").alias("newest"),
        F.count_if(at.isNull()).alias("undated"), F.sum(F.xxhash64(*raw.columns).cast("decimal(38,0)")).cast("string").alias("mark"),
    )
    return {r["load"]: Load(**r.asDict()) for r in found.collect()}


def newest_before(spark: SparkSession, raw_path: str, load: str) -> datetime | None:
    """The newest update time of the loads before ``load`` in the order of their names."""
    marks = [x.newest for x in manifest(spark, raw_path).values() if x.load < load]
    return max((datetime.fromisoformat(m) for m in marks if m), default=None)


def run_incremental(
    source: DataFrame,
    boundaries: DataFrame,
    raw_path: str,
    landing_path: str,
    run_date: str,
    updated: str = "resolution_action_updated_date",
    hours: int = 48,
    now: datetime | None = None,
) -> LoadResult:
    """Land what changed since the newest update loaded before ``run_date``, less ``hours``.

    Rows get their tract, go to ``landing_path`` under the run date, and from there to ``raw_path``, both
    partitioned by ingestion date. Where no load came before, ``now`` less ``hours`` is the bound. A rerun of the day starts from
    the first run's bound, which is kept beside the loads, or an earlier one, so it fetches no less, and replaces that day's
    partitions. Overlap with earlier loads is settled when the requests are staged. No news is a no-op.
    """
    spark = source.sparkSession
    newest = newest_before(spark, raw_path, run_date)
    since = (newest or now or utc_now()) - timedelta(hours=hours)
    # Until there is a load, the bounds of all runs that found nothing hold on.
    kept = [n for n in names(spark, f"{raw_path}/_since") if n == run_date or (newest is None and n < run_date)]
    since = min([since, *[datetime.fromisoformat(read_text(spark, f"{raw_path}/_since/{n}")) for n in kept]])
    write_text(spark, f"{raw_path}/_since/{run_date}", since.isoformat())
    located = point_in_polygon_join(source.filter(since_filter(source, updated, since)), boundaries)
    if write_partition(located.withColumn(LOAD, F.lit(run_date)), landing_path, LOAD, rebalance=False) == 0:
        return LoadResult(since, 0)
    landed = spark.read.schema(located.schema).parquet(f"{landing_path}/{LOAD}={run_date}")
    return LoadResult(since, load_raw(landed, raw_path, run_date, updated))


def run_backfill(
    source: DataFrame,
    boundaries: DataFrame,
    landing_path: str,
    start: str,
    end: str,
    created: str = "created_date",
    raw_path: str | None = None,
    updated: str = "resolution_action_updated_date",
) -> DataFrame:
    """Land all months from ``start`` to ``end`` (both included) in one job, and load them into ``raw_path``.

    Each month is a partition, replaced on a rerun; months without rows write nothing, and
    a failure anywhere fails the job. Raw gets one load per range, named before any run date, so daily runs go on
    from its newest update. Returns rows per month as written, of these months only.
    """
    first = date.fromisoformat(start).replace(day=1).isoformat()
    last = date.fromisoformat(end)
    after = date(last.year + last.month // 12, last.month % 12 + 1, 1).isoformat()
    # ISO text sorts as time does, so text bounds reach the Parquet reader as they are.
    bounds = (first, after) if dict(source.dtypes)[created] == "string" else (ntz(first), ntz(after))
    rows = source.filter((F.col(created) >= bounds[0]) & (F.col(created) < bounds[1]))
    located = point_in_polygon_join(rows, boundaries)
    month = month_of(F.col(created).cast("timestamp_ntz")).cast("date").cast("string")
    write_partition(located.withColumn("created_month", month), landing_path, "created_month")
    landed = source.sparkSession.read.schema(f"{_ddl(located)}, created_month string").parquet(landing_path)
    landed = landed.filter((F.col("created_month") >= first) & (F.col("created_month") < after))
    if raw_path is not None:
        load_raw(landed.drop("created_month"), raw_path, f"0-backfill-{first}-{after}", updated)
    return landed.groupBy("created_month").agg(F.count(F.lit(1)).alias("n_rows"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


class CheckFailed(RuntimeError):
    """A stored table broke checks of severity "error"."""


def build_marts(
    raw: DataFrame,
    demographics: DataFrame,
    root: str,
    run_id: str,
    cell_floor: int = marts.CELL_FLOOR,
    quintile_floor: int = marts.QUINTILE_FLOOR,
    hours: int = 48,
    suites: dict[str, list[Check]] | None = None,
    refreshed_at: datetime | None = None,
    keep: int = 2,
    raw_path: str | None = None,
    full_refresh: bool = False,
) -> dict[str, DataFrame]:
    """All marts from the raw tables, each stored under ``root`` and checked.

    The intermediate table grows by merge, rewriting only the months with changes; a ``run_id`` that was
    merged before is not merged again. Raw is read from the table's own high-water mark on, and loads (``ingestion_date``) not merged
    yet, or written anew since, whatever their update times; raw without loads only from the mark on. ``raw_path`` is the folder of
    raw with the manifest of its loads; without it they are told by a scan. ``full_refresh`` stages all of raw and
    replaces every table, as after a change of rules or columns.

    Facts, waiting-time counts, statistics, baseline and splits are versioned tables by month. Each knows the version of the
    intermediate table and the dimension that it was built from, and replaces the months that changed since then; a new dimension
    has all months replaced. Summary and trend are quantiles of the counts, so they need no facts of a month that did not change; the
    check suites do read whole tables.

    ``suites`` (``SUITES`` by default; an empty dict checks nothing) run on the stored tables. Their results are kept
    in ``checks``; a failed check of severity "error" stops the run. All but ``keep`` versions
    of each mart expire at the end.
    """
    spark = raw.sparkSession
    suites = SUITES if suites is None else suites
    path = f"{root}/intermediate"
    loads = scanned_manifest(raw, REQUEST_SPEC["updated_at"][0]) if raw_path is None else manifest(spark, raw_path)
    if full_refresh:
        fresh = _intermediate(request_versions(raw))
        batch = f"{run_id}-full-{len(batches(spark, path))}"
        sizes = None if raw_path is None else partition_sizes(fresh, "created_month")[0]
        replace_latest(fresh, path, *_merge(), batch, *_settled(), keep=keep, observe="updated_at", derived=_derived(), sizes=sizes)
    elif not committed(spark, path, run_id):
        newest = high_water_mark(spark, path)
        since = None if newest is None else datetime.fromisoformat(newest) - timedelta(hours=hours)
        merged = json.loads(read_text(spark, f"{root}/_loads") or "{}")
        new = [x for x in loads.values() if merged.get(x.load) != x.mark]
        # A table without a mark holds no update time; where loads tell what is new, rows with one are all newer.
        whole = newest is None and not (loads and merged and batches(spark, path))
        versions, joined = (request_versions(raw), False) if whole else _unmerged(raw, since, new)
        ties, aside = _settled()
        upsert_table(
            _intermediate(versions), path, *_merge(), run_id, ties, high_water="updated_at", keep=keep, aside=aside, derived=_derived(),
            stored=raw_path is not None and not joined,
        )
    else:
        loads = None
    if loads is not None:
        write_text(spark, f"{root}/_loads", json.dumps({x.load: x.mark for x in loads.values()}))
    tables = {"intermediate": read_or_none(spark, path)}

    def check(name: str) -> None:
        if not suites.get(name):
            return
        results = run_checkpoint(tables[name], name, f"{root}/checks", refreshed_at, suites)
        broken = results.filter("NOT passed AND severity = 'error'").collect()  # at most one row per check
        if broken:
            raise CheckFailed("; ".join(f"{r['table_name']}: {r['check_name']}({r['column_name']})" for r in broken))

    check("intermediate")

    def store(name: str, df: DataFrame) -> DataFrame:
        tables[name] = materialise(df, name, "table", root)
        check(name)
        return tables[name]

    dim = store("dim_tract", marts.dim_tract(normalize_demographics(demographics)))
    mark = result_fingerprint({"dim": dim}).first()[0]
    # Joined to tracts that every task has, rows stay in the month that they were read from, and are written without a shuffle.
    placed = dim.count() <= BROADCAST_TRACTS
    tracts = F.broadcast(dim) if placed else dim
    version, here = partitions(spark, path)

    def monthly(name: str, rows: Callable[[Callable[[DataFrame], DataFrame]], DataFrame], placed: bool = False) -> DataFrame:
        """A table by ``request_month``; ``rows`` gets a function that cuts inputs to the months to be worked out."""
        target = f"{root}/{name}"
        built = (batches(spark, target) or [""])[-1]
        _, held = partitions(spark, target)
        done, _, of = built.partition("@")
        if full_refresh or of != mark:
            months = None
        else:
            months = {m for m, v in here.items() if v > int(done)} | {m[:10] for m in held if m[:10] not in here}
        if months is None:
            replace_partitions(rows(lambda df: df), target, "request_month", f"{version}@{mark}", keep=keep, placed=placed)
        elif months:
            asked = sorted(m for m in months if m[:4].isdigit())
            # Months are folders of the inputs too, so the cut reaches the scan.
            def cut(df: DataFrame) -> DataFrame:
                by = "created_month" if "created_month" in df.columns else "request_month"
                return df.filter(F.col(by).isin([F.lit(m).cast(df.schema[by].dataType) for m in asked]))

            replace_partitions(rows(cut), target, "request_month", f"{version}@{mark}", [f"{m} 00:00:00" for m in asked], keep=keep, placed=placed)
        tables[name] = read_or_none(spark, target)
        check(name)
        return tables[name]

    facts = monthly("request_facts", lambda cut: marts.request_facts(cut(tables["intermediate"]), tracts), placed)
    counts = monthly("hour_counts", lambda cut: marts.hour_counts(cut(facts)))
    # Ranked in ranges of month and cell, they lie as their folders do.
    stats = monthly("tract_stats", lambda cut: marts.tract_stats(cut(facts), ranges=["request_month", *CELL]), placed=True)
    baseline = monthly("city_baseline", lambda cut: marts.city_baseline(cut(stats)))
    monthly("equity_splits", lambda cut: marts.score_stats(cut(stats), cut(baseline), tracts, refreshed_at), placed)
    summary = store("quintile_summary", marts.quintile_summary(counts, tracts, cell_floor, weight="n_rows"))
    store("gap_by_type", marts.gap_by_type(summary, quintile_floor))
    store("trend_monthly", marts.pooled_trend(counts, tracts, weight="n_rows"))
    for name in ("dim_tract", "quintile_summary", "gap_by_type", "trend_monthly"):
        expire_versions(spark, f"{root}/{name}", keep)
    return tables


def _intermediate(versions: DataFrame) -> DataFrame:
    """Versions of requests as the table has them, and the time of their load, which settles equal update times."""
    rows = marts.build_intermediate(versions, also=VERSION_ORDER[1:])
    return rows.withColumn("created_month", _derived()["created_month"])


def _derived() -> dict[str, Column]:
    """What follows from the other columns of the intermediate table, so that merges need not move it."""
    return {**marts.outcomes(), "created_month": month_of("created_at").cast("date").cast("string")}


def _merge() -> tuple[list[str], list[str], str]:
    """Key, order and partition of the intermediate table."""
    return ["unique_key"], list(VERSION_ORDER[:1]), "created_month"


def _settled() -> tuple[list[str], list[str]]:
    """What settles equal update times, as in ``stage_requests``, and which of it is not stored."""
    rest = [c for c in REQUEST_SPEC if c not in ("unique_key", *VERSION_ORDER)]
    return [*VERSION_ORDER[1:], *rest], list(VERSION_ORDER[1:])


def _unmerged(raw: DataFrame, since: datetime | None, new: list[Load]) -> tuple[DataFrame, bool]:
    """Versions of requests that may change the table: those updated ``since`` (with any update time if it is None), and all keys with other
    rows in the ``new`` loads. Also whether it took a join to tell these.

    Such keys come with all their rows, so that equal update times are settled as in a full build. Only they take a scan of
    whole raw; a daily load has none but by accident, and the manifest says so.
    """
    key, updated = REQUEST_SPEC["unique_key"][0], REQUEST_SPEC["updated_at"][0]
    late = instant(raw, updated).isNotNull() if since is None else since_filter(raw, updated, since)
    earlier = [x.load for x in new if x.undated or (x.oldest and since is not None and datetime.fromisoformat(x.oldest) < since)]
    if not earlier:
        return request_versions(raw.filter(late)) if since is None else request_versions(raw, since=since), False
    recent = F.coalesce(late, F.lit(False))
    held = F.col(LOAD).isin(earlier)
    older = raw.filter((held | F.col(LOAD).isNull() if "" in earlier else held) & ~recent)
    again = raw.filter(~recent).join(older.select(key).distinct(), key, "left_semi").select(*raw.columns)
    return request_versions(raw.filter(late).unionByName(again)), True
