"""Incremental loads, streams, whole runs, checks and fingerprints."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from fairwait import operators as op
from fairwait import sinks
from fairwait.operators import quality as qc
from fairwait.plans import marts, runs
from fairwait.plans import reports as r
from fairwait.plans.check_state import run_checkpoint_changed
from fairwait.plans.suites import run_checkpoint
from fairwait.session import scratch_path
from fairwait.sinks.tables import replace_partitions
from fairwait.streaming import stream_upsert

from . import bindings as b
from .q_marts import gap
from .q_tables import CLEAN_SQL, LATEST_SQL, PLACES_SQL, grid_boundaries, raw_requests
from .registry import ORACLE, SPECS, query

KEYS = ["user_id", "event_type"]
EVENT = "user_id:i event_type:s ts:t value:d"
LATEST_EVENTS = """
  SELECT user_id, event_type, ts, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""


@query("get_watermark", "watermark:t", "SELECT max(ts) - INTERVAL 48 HOUR AS watermark FROM events")
def _(spark, sf):
    return op.watermark_frame(b.table(spark, sf, "events"), "ts")


@query("incremental_filter", "event_id:i ts:t", """
  SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) - INTERVAL 48 HOUR FROM events WHERE event_type = 'error')""")
def _(spark, sf):
    events = b.table(spark, sf, "events")
    return op.incremental_filter(events, events.filter("event_type = 'error'"), "ts")


@query("upsert_latest", EVENT + " props:s", """
  SELECT user_id, event_type, ts, value, CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN props ELSE 'none' END AS props FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def _(spark, sf):
    events = b.table(spark, sf, "events")
    old = op.dedup_latest(events.filter("ts < timestamp_ntz'2024-01-20'"), KEYS, ["ts"], ["event_id"]).drop("props")
    new = op.dedup_latest(events.filter("ts >= timestamp_ntz'2024-01-20'"), KEYS, ["ts"], ["event_id"])
    # The updates bring a column the target did not have.
    return op.upsert_latest(old, new, KEYS).fillna({"props": "none"})


@query("upsert_table", EVENT, LATEST_EVENTS)
def _(spark, sf):
    events = b.table(spark, sf, "events").withColumn("day", F.to_date("ts").cast("string"))
    path = scratch_path(spark, "upserted")
    args = (path, KEYS, ["ts"], "day")
    sinks.upsert_table(events.filter("ts < timestamp_ntz'2024-01-20'"), *args, "a", ["event_id"])
    # Later batches move keys to other days; a batch that comes twice counts once.
    for _ in range(2):
        sinks.upsert_table(events.filter("ts >= timestamp_ntz'2024-01-15'"), *args, "b", ["event_id"])
    return sinks.read_or_none(spark, path)


@query("stream_upsert", EVENT, LATEST_EVENTS)
def _(spark, sf):
    whole = b.table(spark, sf, "events")
    landing, path, checkpoint = (scratch_path(spark, n) for n in ("landing", "stream-table", "stream-log"))
    # Several files, newest last and first, so micro-batches see versions out of order.
    whole.repartition(3, "event_id").write.parquet(landing)
    stream = (
        spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 2).parquet(landing)
        .withColumn("day", F.to_date("ts").cast("string"))
    )
    query_ = stream_upsert(stream, path, KEYS, ["ts"], "day", checkpoint, ["event_id"])
    query_.awaitTermination()
    return sinks.read_or_none(spark, path)


@query("upsert_streams", EVENT, LATEST_EVENTS)
def _(spark, sf):
    """Two streams with logs of their own into one table."""
    whole, path = b.table(spark, sf, "events"), scratch_path(spark, "stream-table")
    for part in (0, 1):
        landing = scratch_path(spark, "landing")
        whole.filter(F.col("event_id") % 2 == part).repartition(2, "event_id").write.parquet(landing)
        stream = spark.readStream.schema(whole.schema).parquet(landing).withColumn("day", F.to_date("ts").cast("string"))
        stream_upsert(stream, path, KEYS, ["ts"], "day", scratch_path(spark, "stream-log"), ["event_id"]).awaitTermination()
    return sinks.read_or_none(spark, path)


@query("upsert_after_failure", EVENT, LATEST_EVENTS)
def _(spark, sf):
    """A batch that failed after it had written its version, another batch, then the first one again."""
    events = b.table(spark, sf, "events").withColumn("day", F.to_date("ts").cast("string"))
    path = scratch_path(spark, "upserted")
    args = (path, KEYS, ["ts"], "day")
    parts = [events.filter(F.col("event_id") % 3 == i) for i in range(3)]
    sinks.upsert_table(parts[0], *args, "a", ["event_id"])
    parts[1].write.partitionBy("day").parquet(f"{path}/table_version=2")  # what it leaves: a version without its commit
    sinks.upsert_table(parts[2], *args, "c", ["event_id"])
    sinks.upsert_table(parts[1], *args, "b", ["event_id"])
    return sinks.read_or_none(spark, path)


INTERMEDIATE = "unique_key:s updated_at:t response_time_hours:i resolution_status:s"


# The early load holds all rows without update time; a later one never lets such rows pass.
@query("build_intermediate", INTERMEDIATE, f"""
  WITH early AS (SELECT * FROM ({LATEST_SQL.replace(CLEAN_SQL, f"SELECT * FROM ({CLEAN_SQL}) WHERE updated_at IS NULL OR updated_at < TIMESTAMP '1998-01-01'")})),
  late AS (SELECT * FROM ({LATEST_SQL}) WHERE updated_at >= (SELECT max(updated_at) - INTERVAL 48 HOUR FROM early)),
  merged AS (SELECT * FROM late UNION ALL SELECT * FROM early WHERE unique_key NOT IN (SELECT unique_key FROM late))
  SELECT *, CASE WHEN closed_at > created_at THEN date_diff('hour', created_at, closed_at) END AS response_time_hours,
         CASE WHEN closed_at > created_at THEN 'closed' WHEN status = 'OPEN' THEN 'open' ELSE 'other' END AS resolution_status
  FROM merged""")
def _(spark, sf):
    raw = raw_requests(spark, sf)
    updated = F.col("resolution_action_updated_date")
    target = marts.build_intermediate(op.stage_requests(raw.filter(updated.isNull() | (updated < "1998"))))
    return marts.build_intermediate(op.stage_requests(raw), target)


@query("run_incremental", "unique_key:s tract_geoid:s n_loads:i", f"""
  WITH p AS (SELECT l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS unique_key, l_shipdate AS d,
           CASE WHEN l_returnflag <> 'R' THEN l_discount + l_quantity / 500 END AS x, l_tax + l_linenumber / 1000 AS y
           FROM lineitem), {PLACES_SQL},
  edge AS (SELECT max(l_shipdate) - INTERVAL 48 HOUR AS since FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'),
  loads AS (SELECT *, 1 AS n_loads FROM p WHERE d < TIMESTAMP '1998-01-01'
            UNION ALL SELECT *, 2 AS n_loads FROM p WHERE d >= (SELECT since FROM edge))
  SELECT unique_key, s_suppkey::VARCHAR AS tract_geoid, n_loads FROM loads LEFT JOIN m USING (x, y)""")
def _(spark, sf):
    rows = b.table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("unique_key"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("resolution_action_updated_date"),
        F.when(F.col("l_returnflag") != "R", F.col("l_discount") + F.col("l_quantity") / 500).alias("longitude"),
        (F.col("l_tax") + F.col("l_linenumber") / 1000).alias("latitude"),
    )
    raw, landing = scratch_path(spark, "raw"), scratch_path(spark, "landing")
    shapes = grid_boundaries(spark, sf)
    # The first day finds no table; its watermark lies before all data, and holds for a later rerun.
    for now in (datetime(1900, 1, 3), datetime(1997, 1, 1)):
        runs.run_incremental(
            rows.filter("resolution_action_updated_date < '1998'"), shapes, raw, landing, "2024-01-01", now=now,
        )
    for _ in range(2):  # a rerun of the day loads the same again, once
        runs.run_incremental(rows, shapes, raw, landing, "2024-01-02")
    loaded = spark.read.parquet(raw)
    return loaded.withColumn("n_loads", F.dayofmonth("ingestion_date"))


@query("run_backfill", "created_month:s n_rows:i", """
  SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS created_month, count(*) AS n_rows
  FROM orders WHERE o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '1998-08-01' GROUP BY ALL""")
def _(spark, sf):
    rows = b.table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("created_date"),
        (F.col("o_custkey") % 100 / 500).alias("longitude"),
        (F.col("o_custkey") % 9 / 1000).alias("latitude"),
    )
    landing = scratch_path(spark, "backfill")
    shapes = grid_boundaries(spark, sf)
    runs.run_backfill(rows, shapes, landing, "1995-01-01", "1995-02-01")
    for _ in range(2):  # a rerun changes nothing, and earlier months are not counted again
        months = runs.run_backfill(rows, shapes, landing, "1996-03-15", "1998-07-02")
    return months


@query("backfill_then_daily", "o_orderkey:i tract_geoid:s load:s", f"""
  WITH p AS (SELECT o_orderkey, o_orderdate AS d, o_custkey % 100 / 500 AS x, o_custkey % 9 / 1000 AS y FROM orders), {PLACES_SQL},
  old AS (SELECT * FROM p WHERE (d >= DATE '1994-02-01' AND d < DATE '1994-04-01') OR (d >= DATE '1996-03-01' AND d < DATE '1998-01-01')),
  loads AS (SELECT *, CASE WHEN d < DATE '1995-01-01' THEN 'first' ELSE 'second' END AS load FROM old
            UNION ALL SELECT *, 'daily' FROM p WHERE d >= (SELECT max(d) - INTERVAL 48 HOUR FROM old))
  SELECT o_orderkey, s_suppkey::VARCHAR AS tract_geoid, load FROM loads LEFT JOIN m USING (x, y)""")
def _(spark, sf):
    rows = b.table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("created_date"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("resolution_action_updated_date"),
        (F.col("o_custkey") % 100 / 500).alias("longitude"),
        (F.col("o_custkey") % 9 / 1000).alias("latitude"),
    )
    landing, months, raw = (scratch_path(spark, n) for n in ("landing", "months", "raw"))
    shapes = grid_boundaries(spark, sf)
    for start, end in (("1994-02-01", "1994-03-31"), ("1996-03-15", "1997-12-02"), ("1996-03-15", "1997-12-02")):
        runs.run_backfill(rows, shapes, months, start, end, raw_path=raw)
    runs.run_incremental(rows, shapes, raw, landing, "2024-01-01")
    load = F.when(F.col("ingestion_date").startswith("0-backfill-1994"), "first").when(F.col("ingestion_date").startswith("0-"), "second").otherwise("daily")
    return spark.read.parquet(raw).withColumn("load", load)


MARTS_SQL = b.ctes(
    b.DEMOGRAPHICS_SQL,
    f"requests AS ({LATEST_SQL})",
    """hours AS (SELECT *, CASE WHEN closed_at > created_at THEN date_diff('hour', created_at, closed_at) END AS h FROM requests),
    fact AS (SELECT *, date_trunc('month', created_at) AS request_month, h AS response_time_hours
        FROM hours WHERE h IS NOT NULL AND tract_geoid IN (SELECT tract_geoid FROM dim))""",
    b.SPLITS_SQL,
    b.SUMMARY_SQL.format(floor=20, guard=100),
) + """
  SELECT 'intermediate' AS mart, unique_key AS k1, complaint_type AS k2, created_at AS at, h AS v1, NULL AS v2, NULL AS v3 FROM hours
  UNION ALL SELECT 'dim_tract', tract_geoid, county_fips, NULL, income_quintile, median_household_income, pct_below_poverty FROM dim
  UNION ALL SELECT 'request_facts', unique_key, tract_geoid, request_month, response_time_hours, latitude, longitude FROM fact
  UNION ALL SELECT 'tract_stats', tract_geoid, complaint_type || coalesce(borough, ''), request_month, p50_hours, p75_hours, p90_hours FROM stats
  UNION ALL SELECT 'city_baseline', complaint_type, NULL, request_month, city_p90, NULL, NULL FROM baseline
  UNION ALL SELECT 'equity_splits', tract_geoid, complaint_type || coalesce(borough, ''), request_month, equity_score, city_p90, request_count FROM splits
  UNION ALL SELECT 'quintile_summary', complaint_type, income_quintile::VARCHAR, NULL, n_tracts, median_tract_p90_hours, n_complaints FROM summary
  UNION ALL SELECT 'gap_by_type', complaint_type, NULL, NULL, q1_p90_hours, q5_p90_hours, q1_over_q5_gap FROM gap
  UNION ALL SELECT 'trend_monthly', income_quintile::VARCHAR, NULL, request_month,
    round(quantile_cont(response_time_hours, 0.9)::DECIMAL(38,10), 1)::DOUBLE, round(quantile_cont(response_time_hours, 0.5)::DECIMAL(38,10), 1)::DOUBLE, count(*)
    FROM fact JOIN dim USING (tract_geoid) GROUP BY income_quintile, request_month"""
WHERE = "complaint_type || coalesce(borough, '')"
SHOWN = {  # mart -> k1, k2, at, v1, v2, v3
    "intermediate": ("unique_key", "complaint_type", "created_at", "response_time_hours", "null", "null"),
    "dim_tract": ("tract_geoid", "county_fips", "null", "income_quintile", "median_household_income", "pct_below_poverty"),
    "request_facts": ("unique_key", "tract_geoid", "request_month", "response_time_hours", "latitude", "longitude"),
    "tract_stats": ("tract_geoid", WHERE, "request_month", "p50_hours", "p75_hours", "p90_hours"),
    "city_baseline": ("complaint_type", "null", "request_month", "city_p90", "null", "null"),
    "equity_splits": ("tract_geoid", WHERE, "request_month", "equity_score", "city_p90", "request_count"),
    "quintile_summary": ("complaint_type", "income_quintile", "null", "n_tracts", "median_tract_p90_hours", "n_complaints"),
    "gap_by_type": ("complaint_type", "null", "null", "q1_p90_hours", "q5_p90_hours", "q1_over_q5_gap"),
    "trend_monthly": ("income_quintile", "null", "month", "p90_hours", "p50_hours", "n_complaints"),
}
MART_SUITES = {
    "intermediate": [qc.check_unique("unique_key"), qc.check_not_null("response_time_hours", "warn")],
    "dim_tract": [qc.check_unique("tract_geoid"), qc.check_in_set("income_quintile", [1, 2, 3, 4, 5])],
    "equity_splits": [qc.check_percentile_order()],
}


# Two runs: the later one brings newer versions and redoes the months they fall into.
@query("build_marts", "mart:s k1:s k2:s at:t v1:d v2:d v3:d", MARTS_SQL)
def _(spark, sf):
    raw, root = raw_requests(spark, sf), scratch_path(spark, "marts")
    updated = F.col("resolution_action_updated_date")
    for day, rows in (("1", raw.filter(updated.isNull() | (updated < "1994"))), ("2", raw)):
        tables = runs.build_marts(rows, b.raw_demographics(spark, sf), root, day, 20, 100, suites=MART_SUITES)
    return shown_marts(tables)


# The newest load first, older ones after it: as a backfill does that comes after a run.
@query("build_marts_backfilled", "mart:s k1:s k2:s at:t v1:d v2:d v3:d", MARTS_SQL)
def _(spark, sf):
    raw, root = raw_requests(spark, sf), scratch_path(spark, "marts")
    updated = F.col("resolution_action_updated_date")
    load = F.when(updated >= "1996", "0-backfill-c").when(updated >= "1994", "0-backfill-b").otherwise("0-backfill-a")
    # Landed once, as loads are; the runs read it several times.
    landed, raw = scratch_path(spark, "raw"), raw.withColumn(runs.LOAD, load)
    raw.write.partitionBy(runs.LOAD).parquet(landed)
    raw = spark.read.schema(raw.schema).parquet(landed)
    for day, first in (("1", "0-backfill-c"), ("2", "0-backfill-b"), ("3", "0-backfill-a")):
        rows = raw.filter(F.col(runs.LOAD) >= first)
        tables = runs.build_marts(rows, b.raw_demographics(spark, sf), root, day, 20, 100, suites=MART_SUITES)
    return shown_marts(tables)


DAYS = (("2024-01-01", None, "1994"), ("2024-01-02", "1994", "1996"), ("2024-01-03", "1996", None))


def daily_marts(spark, sf, days, root, rows=None, **more):
    """Loads with a manifest, and a mart run after each."""
    raw, path = raw_requests(spark, sf) if rows is None else rows, scratch_path(spark, "raw")
    updated = F.col("resolution_action_updated_date")
    for day, since, before in days:
        recent = F.lit(True) if since is None else updated >= since
        load = raw.filter((recent & (updated < before) if before else recent) | (updated.isNull() if since is None else F.lit(False)))
        runs.load_raw(load, path, day, "resolution_action_updated_date")
        tables = runs.build_marts(
            spark.read.parquet(path), b.raw_demographics(spark, sf), root, day, 20, 100, suites=MART_SUITES, raw_path=path, **more
        )
    return tables


# Three daily runs, each of which reads its own load and works out the months it touches.
@query("build_marts_incremental", "mart:s k1:s k2:s at:t v1:d v2:d v3:d", MARTS_SQL)
def _(spark, sf):
    return shown_marts(daily_marts(spark, sf, DAYS, scratch_path(spark, "marts")))


# Marts that were built from other rows (every waiting time a day shorter), then refreshed from the right ones.
@query("build_marts_refreshed", "mart:s k1:s k2:s at:t v1:d v2:d v3:d", MARTS_SQL)
def _(spark, sf):
    root, day, path = scratch_path(spark, "marts"), "2024-01-01", scratch_path(spark, "raw")
    # The right rows are landed once; the others are made of them, and the refresh reads them.
    runs.load_raw(raw_requests(spark, sf), path, day, "resolution_action_updated_date")
    raw = spark.read.parquet(path)
    shorter = F.date_format(F.col("closed_date").cast("timestamp_ntz") - F.expr("interval 1 day"), "yyyy-MM-dd'T'HH:mm:ss")
    daily_marts(spark, sf, [(day, None, None)], root, raw.drop(runs.LOAD).withColumn("closed_date", shorter))
    return shown_marts(
        runs.build_marts(raw, b.raw_demographics(spark, sf), root, day, 20, 100, suites=MART_SUITES, raw_path=path, full_refresh=True)
    )


def shown_marts(tables):
    out = None
    for mart, (k1, k2, at, *values) in SHOWN.items():
        shown = tables[mart].select(
            F.lit(mart).alias("mart"), F.expr(f"cast({k1} as string)").alias("k1"), F.expr(f"cast({k2} as string)").alias("k2"),
            F.expr(f"cast({at} as timestamp_ntz)").alias("at"), *[F.expr(f"cast({v} as double)").alias(f"v{i}") for i, v in enumerate(values, 1)],
        )
        out = shown if out is None else out.unionByName(shown)
    return out


# -- checks ------------------------------------------------------------------------------

CHECK = "table_name:s check_name:s column_name:s n_rows:i n_failed:i fraction:d severity:s passed:b"


def check_sql(table: str, name: str, col: str, judged: str, failed: str, mostly: float = 1.0,
              severity: str = "error", source: str | None = None) -> str:
    return f"""
      SELECT '{table}' AS table_name, '{name}' AS check_name, '{col}' AS column_name, n_rows, f AS n_failed,
             CASE WHEN j > 0 THEN (j - f) / j ELSE 1.0 END AS fraction, '{severity}' AS severity,
             CASE WHEN j > 0 THEN (j - f) / j ELSE 1.0 END >= {mostly} AS passed
      FROM (SELECT count(*) AS n_rows, {judged} AS j, {failed} AS f FROM {source or table})"""


def one_check(key: str, check: qc.Check, table: str, sql: str):
    @query(key, CHECK, sql)
    def _(spark, sf):
        return op.run_checks(b.table(spark, sf, table), [check], table)


def unique_sql(table: str, name: str, cols: str, judged: str, severity: str = "error") -> str:
    return f"""
      SELECT '{table}' AS table_name, '{name}' AS check_name, '{cols}' AS column_name, n_rows, f AS n_failed,
             (j - f) / j AS fraction, '{severity}' AS severity, f = 0 AS passed
      FROM (SELECT sum(n) AS n_rows, sum(n) FILTER ({judged}) AS j, coalesce(sum(n) FILTER ({judged} AND n > 1), 0) AS f
            FROM (SELECT {cols}, count(*) AS n FROM {table} GROUP BY ALL))"""


one_check("check_unique", qc.check_unique("o_orderkey"), "orders", unique_sql("orders", "unique", "o_orderkey", "o_orderkey IS NOT NULL"))
one_check("check_unique_combination", qc.check_unique_combination(["l_orderkey", "l_linenumber"], "warn"), "lineitem",
          unique_sql("lineitem", "unique_combination", "l_orderkey,l_linenumber", "true", "warn"))
one_check("check_accepted_values", qc.check_accepted_values("o_orderstatus", ["F", "O"]), "orders",
          check_sql("orders", "accepted_values", "o_orderstatus", "count(o_orderstatus)", "count(*) FILTER (o_orderstatus NOT IN ('F', 'O'))"))
one_check("check_in_set", qc.check_in_set("l_linenumber", [1, 2, 3, 4, 5, 6, 7]), "lineitem",
          check_sql("lineitem", "in_set", "l_linenumber", "count(l_linenumber)", "count(*) FILTER (l_linenumber NOT BETWEEN 1 AND 7)"))
one_check("check_accepted_range", qc.check_accepted_range("c_acctbal", 0), "customer",
          check_sql("customer", "accepted_range", "c_acctbal", "count(c_acctbal)", "count(*) FILTER (c_acctbal < 0)"))
one_check("check_between_mostly", qc.check_between_mostly("l_quantity", 2, 49, 0.9), "lineitem",
          check_sql("lineitem", "between_mostly", "l_quantity", "count(l_quantity)", "count(*) FILTER (l_quantity < 2 OR l_quantity > 49)", 0.9))
one_check("check_not_in_set", qc.check_not_in_set("o_orderstatus", [None, "", "P"], 0.95), "orders",
          check_sql("orders", "not_in_set", "o_orderstatus", "count(o_orderstatus)", "count(*) FILTER (o_orderstatus IN ('', 'P'))", 0.95))
one_check("check_row_count", qc.check_row_count(1, 20000), "orders",
          check_sql("orders", "row_count", "*", "1", "CASE WHEN count(*) BETWEEN 1 AND 20000 THEN 0 ELSE 1 END"))
one_check("check_columns_present", qc.check_columns_present(["o_orderkey", "o_nothing"]), "orders",
          check_sql("orders", "columns_present", "o_orderkey,o_nothing", "2", "1"))
one_check("check_column_type", qc.check_column_type("o_totalprice", "double"), "orders",
          check_sql("orders", "column_type", "o_totalprice", "1", "0"))


@query("check_not_null", CHECK, check_sql(
    "requests", "not_null", "hours", "count(*)", "count(*) FILTER (closed_at <= created_at)", 1.0, "warn",
    "(SELECT o_orderdate AS created_at, l_shipdate AS closed_at FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"))
def _(spark, sf):
    from fairwait.functions import response_hours

    rows = b.requests(spark, sf).select(response_hours("created_at", "closed_at").alias("hours"))
    return op.run_checks(rows, [qc.check_not_null("hours", "warn")], "requests")


@query("check_percentile_order", CHECK, b.splits_ctes() + check_sql(
    "splits", "percentile_order", "p50_hours,p75_hours,p90_hours", "count(*)", "count(*) FILTER (p50_hours > p75_hours OR p75_hours > p90_hours)"))
def _(spark, sf):
    return op.run_checks(b.splits(spark, sf), [qc.check_percentile_order()], "splits")


ORDER_SUITE = [
    qc.check_not_null("o_orderkey"),
    qc.check_accepted_values("o_orderstatus", ["F", "O"], "warn"),
    qc.check_between_mostly("o_totalprice", 1000, 400000, 0.5),
    qc.check_row_count(1),
    qc.check_unique("o_orderkey"),
]


ORDER_CHECKS = " UNION ALL ".join([
    check_sql("orders", "not_null", "o_orderkey", "count(*)", "count(*) FILTER (o_orderkey IS NULL)"),
    check_sql("orders", "accepted_values", "o_orderstatus", "count(o_orderstatus)", "count(*) FILTER (o_orderstatus NOT IN ('F', 'O'))", 1.0, "warn"),
    check_sql("orders", "between_mostly", "o_totalprice", "count(o_totalprice)", "count(*) FILTER (o_totalprice < 1000 OR o_totalprice > 400000)", 0.5),
    check_sql("orders", "row_count", "*", "1", "CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END"),
    unique_sql("orders", "unique", "o_orderkey", "o_orderkey IS NOT NULL"),
])


@query("run_checkpoint", CHECK, ORDER_CHECKS)
def _(spark, sf):
    path = scratch_path(spark, "check-results")
    orders = b.table(spark, sf, "orders")
    run_checkpoint(orders, "orders", path, datetime(2024, 1, 1), {"orders": ORDER_SUITE})
    return run_checkpoint(orders, "orders", path, datetime(2024, 1, 2), {"orders": ORDER_SUITE})


# Orders by year: a first state with every order of 1995 twice and without price, then 1995 as it is; the second check reads 1995 alone,
# and the keys of the other years.
@query("run_checkpoint_changed", CHECK, ORDER_CHECKS)
def _(spark, sf):
    path, state, suite = scratch_path(spark, "orders-by-year"), scratch_path(spark, "check-state"), {"orders": ORDER_SUITE}
    orders = b.table(spark, sf, "orders").withColumn("order_year", F.year("o_orderdate"))
    year = orders.filter("order_year = 1995")
    wrong = year.withColumn("o_totalprice", F.lit(-1).cast(orders.schema["o_totalprice"].dataType))
    replace_partitions(orders.filter("order_year <> 1995 OR order_year IS NULL").unionByName(wrong).unionByName(wrong), path, "order_year", "first")
    run_checkpoint_changed(spark, path, "order_year", state, "orders", None, datetime(2024, 1, 1), suite)
    replace_partitions(year, path, "order_year", "second", ["1995"])
    return run_checkpoint_changed(spark, path, "order_year", state, "orders", None, datetime(2024, 1, 2), suite)


def splits_check(name: str, col: str, judged: str, failed: str) -> str:
    return check_sql("equity_splits", name, col, judged, failed, source="splits")


KNOWN = "tract_geoid complaint_type request_month p50_hours p75_hours p90_hours request_count income_quintile".split()
GRAIN = "tract_geoid,complaint_type,request_month"


# One pass for all the checks of a mart's own suite.
@query("run_checks", CHECK, b.splits_ctes() + " UNION ALL ".join([
    *[splits_check("not_null", c, "count(*)", f"count(*) FILTER ({c} IS NULL)") for c in KNOWN],
    splits_check("between_mostly", "equity_score", "count(equity_score)", "count(*) FILTER (equity_score < 0.01 OR equity_score > 100)"),
    splits_check("in_set", "income_quintile", "count(income_quintile)", "count(*) FILTER (income_quintile NOT IN (1, 2, 3, 4, 5))"),
    splits_check("between_mostly", "request_count", "count(request_count)", "count(*) FILTER (request_count < 1)"),
    splits_check("row_count", "*", "1", "CASE WHEN count(*) >= 10000 THEN 0 ELSE 1 END"),
    splits_check("percentile_order", "p50_hours,p75_hours,p90_hours", "count(*)", "count(*) FILTER (p50_hours > p75_hours OR p75_hours > p90_hours)"),
    unique_sql("splits", "unique_combination", GRAIN, "true").replace("'splits'", "'equity_splits'"),
]))
def _(spark, sf):
    return run_checkpoint(b.splits(spark, sf), "equity_splits")


def fingerprint_sql(tables: dict[str, str]) -> str:
    """The fingerprint of registered queries' results; the tables' names lead to the queries'."""
    kinds = {"d": "printf('%.6f', {c})", "t": "{c}", "s": "{c}", "i": "{c}::VARCHAR", "b": "{c}::VARCHAR"}
    parts = []
    for table, name in sorted(tables.items()):
        texts = [
            f"CASE WHEN {c} IS NULL THEN '{c} null' ELSE '{c}=' || {kinds[k].format(c=c)} END" for c, k in sorted(SPECS[name])
        ]
        row = " || chr(31) || ".join(texts)
        parts.append(
            f"SELECT '{table}:' || count(*) || ':' || coalesce(sum(('0x' || substr(md5({row}), 1, 15))::BIGINT), 0)::VARCHAR AS p FROM ({ORACLE[name]})"
        )
    return f"SELECT md5(string_agg(p, '|' ORDER BY p)) AS fingerprint FROM ({' UNION ALL '.join(parts)})"


@query("result_fingerprint", "fingerprint:s", fingerprint_sql({"gap": "gap_by_type", "trend": "score_trend"}))
def _(spark, sf):
    splits = b.splits(spark, sf)
    return op.result_fingerprint({"gap": gap(spark, sf), "trend": r.score_trend(splits, floor=b.ROW_FLOOR)})
