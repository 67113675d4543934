"""Report queries. Splits cells of the given tables are small, so their row floor is 2."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from fairwait.operators import min_count, series_text
from fairwait.plans import reports as r

from . import bindings as b
from .bindings import ROW_FLOOR
from .q_marts import gap
from .registry import query

SPLITS = b.splits_ctes()
BRANDS = b.splits_ctes("brand")
REGIONS = ["AFRICA", "ASIA", "EUROPE"]
MAP = (
    "p50_hours:d p90_hours:d equity_score:d city_p90:d complaint_count:i median_household_income:i "
    "income_quintile:i county:s"
)
MAP_SQL = """
  median(p50_hours) AS p50_hours, median(p90_hours) AS p90_hours, median(equity_score) AS equity_score,
  median(city_p90) AS city_p90, sum(request_count) AS complaint_count,
  max(median_household_income) AS median_household_income, max(income_quintile) AS income_quintile,
  CASE WHEN length(tract_geoid) < 5 THEN tract_geoid ELSE 'NYC' END AS county
  FROM splits WHERE request_count >= 2 AND borough IN ('AFRICA', 'ASIA', 'EUROPE')"""


@query("map_rollup", "tract_geoid:s complaint_type:s " + MAP,
       SPLITS + f"SELECT tract_geoid, complaint_type, {MAP_SQL} AND complaint_type = '1-URGENT' GROUP BY ALL")
def _(spark, sf):
    return r.map_rollup(b.splits(spark, sf), "type", REGIONS, "1-URGENT", floor=ROW_FLOOR)


@query("map_rollup_quintiles", "tract_geoid:s " + MAP,
       SPLITS + f"SELECT tract_geoid, {MAP_SQL} AND income_quintile IN (1, 2, 5) GROUP BY ALL")
def _(spark, sf):
    return r.map_rollup(b.splits(spark, sf), "quintile", REGIONS, quintiles=[1, 2, 5], floor=ROW_FLOOR)


QUINTILE_SQL = """
  SELECT income_quintile, median(equity_score) AS avg_equity_score, median(p90_hours) AS avg_p90_hours,
         sum(request_count) AS total_complaints
  FROM splits WHERE complaint_type = '2-HIGH' AND request_count >= 2 GROUP BY ALL"""


@query("quintile_rollup", "income_quintile:i avg_equity_score:d avg_p90_hours:d total_complaints:i", SPLITS + QUINTILE_SQL)
def _(spark, sf):
    return r.quintile_rollup(b.splits(spark, sf), "2-HIGH", ROW_FLOOR)


@query("quintile_ratio", "q1_p90_hours:d q5_p90_hours:d p90_ratio:d", SPLITS + f"""
  SELECT a.avg_p90_hours AS q1_p90_hours, z.avg_p90_hours AS q5_p90_hours, a.avg_p90_hours / z.avg_p90_hours AS p90_ratio
  FROM ({QUINTILE_SQL}) a, ({QUINTILE_SQL}) z
  WHERE a.income_quintile = 1 AND z.income_quintile = 5 AND z.avg_p90_hours <> 0""")
def _(spark, sf):
    return r.quintile_ratio(r.quintile_rollup(b.splits(spark, sf), "2-HIGH", ROW_FLOOR))


def R(x: str, n: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {n}) AS DOUBLE)"


@query("quintile_profile", "income_quintile:i avg_p90_hours:d avg_equity_score:d", SPLITS + f"""
  SELECT income_quintile, {R('median(p90_hours)', 1)} AS avg_p90_hours, {R('median(equity_score)', 3)} AS avg_equity_score
  FROM splits WHERE request_count >= 2 AND income_quintile IS NOT NULL GROUP BY ALL""")
def _(spark, sf):
    return r.quintile_profile(b.splits(spark, sf), ROW_FLOOR)


SCATTER_SQL = """
  SELECT tract_geoid, complaint_type, borough, median(p90_hours) AS p90_hours, median(equity_score) AS equity_score,
         max(median_household_income) AS median_household_income, sum(request_count) AS complaint_count
  FROM splits WHERE complaint_type = '5-LOW' AND p90_hours IS NOT NULL AND request_count >= 2 GROUP BY ALL"""


@query("tract_scatter", (
    "tract_geoid:s complaint_type:s borough:s p90_hours:d equity_score:d median_household_income:i complaint_count:i"
), SPLITS + SCATTER_SQL)
def _(spark, sf):
    return r.tract_scatter(b.splits(spark, sf), "5-LOW", ROW_FLOOR)


# Four places: slope and intercept are sums of products of doubles.
@query("income_trend_line", "i:i x:d y:d", SPLITS + f"""
  , fit AS (SELECT regr_slope(p90_hours, median_household_income) AS m, regr_intercept(p90_hours, median_household_income) AS k,
            min(median_household_income) AS lo, max(median_household_income) AS hi FROM ({SCATTER_SQL})
            WHERE p90_hours IS NOT NULL AND median_household_income IS NOT NULL)
  SELECT i, {R('lo + i * (hi - lo) / 199.0', 4)} AS x, {R('k + m * (lo + i * (hi - lo) / 199.0)', 4)} AS y
  FROM fit, range(200) AS t(i)""")
def _(spark, sf):
    from fairwait.functions import round_exact

    line = r.income_trend_line(r.tract_scatter(b.splits(spark, sf), "5-LOW", ROW_FLOOR))
    return line.select("i", round_exact("x", 4).alias("x"), round_exact("y", 4).alias("y"))


BOROUGH_TYPE_SQL = """
  SELECT borough, complaint_type, avg(p50_hours) AS p50_hours, avg(p90_hours) AS p90_hours,
         sum(request_count) AS complaint_count, avg(equity_score) AS avg_equity_score
  FROM splits WHERE request_month BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-06-01' GROUP BY ALL"""


def borough_types(spark, sf, types="priority"):
    from fairwait.operators import date_range

    return r.borough_type_rollup(date_range(b.splits(spark, sf, types), "request_month", "1996-01-01", "1999-06-01"))


@query("borough_type_rollup", "borough:s complaint_type:s p50_hours:d p90_hours:d complaint_count:i avg_equity_score:d",
       SPLITS + BOROUGH_TYPE_SQL)
def _(spark, sf):
    return borough_types(spark, sf)


ALL_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("pivot_matrix", "complaint_type:s africa:d america:d asia:d europe:d middle_east:d", SPLITS + f"""
  SELECT complaint_type, avg(p90_hours) FILTER (borough = 'AFRICA') AS africa,
         avg(p90_hours) FILTER (borough = 'AMERICA') AS america, avg(p90_hours) FILTER (borough = 'ASIA') AS asia,
         avg(p90_hours) FILTER (borough = 'EUROPE') AS europe, avg(p90_hours) FILTER (borough = 'MIDDLE EAST') AS middle_east
  FROM ({BOROUGH_TYPE_SQL}) GROUP BY ALL""")
def _(spark, sf):
    wide = r.pivot_matrix(borough_types(spark, sf), "complaint_type", "borough", "p90_hours", ALL_REGIONS)
    return wide.toDF("complaint_type", *[c.lower().replace(" ", "_") for c in ALL_REGIONS])


BOROUGH_QUINTILE_SQL = f"""
  SELECT borough, income_quintile, {R('median(equity_score)', 3)} AS avg_equity_score
  FROM splits WHERE borough NOT IN ('UNSPECIFIED', '') AND income_quintile IS NOT NULL AND request_count >= 2
  GROUP BY ALL"""


@query("borough_quintile_score", "borough:s income_quintile:i avg_equity_score:d", SPLITS + BOROUGH_QUINTILE_SQL)
def _(spark, sf):
    return r.borough_quintile_score(b.splits(spark, sf), ROW_FLOOR)


# The fixed row order names one borough that has no data.
@query("pivot_matrix_quintiles", "borough:s Q1:d Q2:d Q3:d Q4:d Q5:d", SPLITS + f"""
  SELECT s.r_name AS borough, avg(v) FILTER (q = 1) AS "Q1", avg(v) FILTER (q = 2) AS "Q2", avg(v) FILTER (q = 3) AS "Q3",
         avg(v) FILTER (q = 4) AS "Q4", avg(v) FILTER (q = 5) AS "Q5"
  FROM (SELECT r_name FROM region UNION ALL SELECT 'NOWHERE') s
  LEFT JOIN (SELECT borough, income_quintile AS q, avg_equity_score AS v FROM ({BOROUGH_QUINTILE_SQL})) t
    ON s.r_name = t.borough GROUP BY ALL""")
def _(spark, sf):
    rows = b.table(spark, sf, "region").select(F.col("r_name").alias("borough"))
    rows = rows.unionByName(spark.createDataFrame([("NOWHERE",)], "borough string"))
    scores = r.borough_quintile_score(b.splits(spark, sf), ROW_FLOOR)
    return r.pivot_matrix(scores, "borough", "income_quintile", "avg_equity_score", [1, 2, 3, 4, 5], "Q", rows)


@query("top_k_types", "complaint_type:s total_complaints:i avg_equity:d", BRANDS + f"""
  SELECT complaint_type, sum(complaint_count) AS total_complaints, avg(avg_equity_score) AS avg_equity
  FROM ({BOROUGH_TYPE_SQL}) GROUP BY ALL ORDER BY total_complaints DESC NULLS LAST, complaint_type LIMIT 10""")
def _(spark, sf):
    return r.top_k_types(borough_types(spark, sf, "brand"))


@query("top_complaints", "complaint_type:s total_requests:i avg_p90_hours:d avg_equity_score:d", BRANDS + f"""
  SELECT complaint_type, sum(request_count) AS total_requests, {R('median(p90_hours)', 1)} AS avg_p90_hours,
         {R('median(equity_score)', 3)} AS avg_equity_score
  FROM splits WHERE request_count >= 2 GROUP BY ALL ORDER BY total_requests DESC NULLS LAST, complaint_type LIMIT 10""")
def _(spark, sf):
    return r.top_complaints(b.splits(spark, sf, "brand"), floor=ROW_FLOOR)


@query("top_n_per_group", "borough:s complaint_type:s avg_p90_hours:d total_requests:i rn:i", BRANDS + f"""
  , totals AS (SELECT borough, complaint_type, {R('avg(p90_hours)', 10)} AS p, sum(request_count) AS total_requests
     FROM splits WHERE borough NOT IN ('UNSPECIFIED', '') GROUP BY ALL HAVING sum(request_count) >= 200)
  SELECT borough, complaint_type, {R('p', 1)} AS avg_p90_hours, total_requests,
         row_number() OVER (PARTITION BY borough ORDER BY p DESC NULLS LAST, complaint_type) AS rn
  FROM totals QUALIFY rn <= 3""")
def _(spark, sf):
    return r.slowest_types(b.splits(spark, sf, "brand"), floor=200)


def agencies(spark):
    return spark.createDataFrame(
        [("Brand#1", "North"), ("Brand#2", "North"), ("Brand#3", "South"), ("Brand#4", "South"), ("Brand#5", "East")],
        "complaint_type string, agency string",
    )


AGENCY_SQL = """
  CASE WHEN complaint_type IN ('Brand#1', 'Brand#2') THEN 'North' WHEN complaint_type IN ('Brand#3', 'Brand#4') THEN 'South'
       WHEN complaint_type = 'Brand#5' THEN 'East' ELSE '{other}' END"""


@query("agency_rollup", "agency:s total_requests:i q1_avg_equity:d q5_avg_equity:d gap:d", BRANDS + f"""
  , med AS (SELECT complaint_type, income_quintile AS q, sum(request_count) AS n, median(equity_score) AS s
     FROM splits WHERE request_count >= 2 GROUP BY ALL),
  sides AS (SELECT {AGENCY_SQL.format(other='Other')} AS agency, sum(n) AS total_requests,
     avg(s) FILTER (q = 1) AS q1_avg_equity, avg(s) FILTER (q = 5) AS q5_avg_equity FROM med GROUP BY ALL)
  SELECT *, q1_avg_equity - q5_avg_equity AS gap FROM sides
  WHERE q1_avg_equity IS NOT NULL AND q5_avg_equity IS NOT NULL AND agency IN ('North', 'South', 'Other')""")
def _(spark, sf):
    return r.agency_rollup(
        b.splits(spark, sf, "brand"), agencies(spark), ["North", "South", "Other"], floor=ROW_FLOOR
    )


TREND_SQL = """
  SELECT request_month, income_quintile, median(equity_score) AS avg_equity_score, sum(request_count) AS total_requests
  FROM splits WHERE income_quintile IN (1, 5) AND request_count >= 2 GROUP BY ALL"""
SEASON = """CASE WHEN month({m}) IN (12, 1, 2) THEN 'Winter' WHEN month({m}) IN (3, 4, 5) THEN 'Spring'
  WHEN month({m}) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END"""
SEASON_ORDER = "CASE WHEN month({m}) IN (12, 1, 2) THEN 1 WHEN month({m}) IN (3, 4, 5) THEN 2 WHEN month({m}) IN (6, 7, 8) THEN 3 ELSE 4 END"


def trend(spark, sf):
    return r.score_trend(b.splits(spark, sf), floor=ROW_FLOOR)


@query("score_trend", "request_month:t income_quintile:i avg_equity_score:d total_requests:i", SPLITS + TREND_SQL)
def _(spark, sf):
    return trend(spark, sf)


@query("season_trend", "yr:i season:s season_order:i period:s income_quintile:i avg_equity_score:d total_requests:i", SPLITS + f"""
  SELECT year(request_month) AS yr, {SEASON.format(m='request_month')} AS season,
         {SEASON_ORDER.format(m='request_month')} AS season_order,
         year(request_month)::VARCHAR || ' ' || {SEASON.format(m='request_month')} AS period, income_quintile,
         avg(avg_equity_score) AS avg_equity_score, sum(total_requests) AS total_requests
  FROM ({TREND_SQL}) GROUP BY ALL""")
def _(spark, sf):
    return r.season_trend(trend(spark, sf))


@query("volume_compare", "request_month:t q1_requests:i q5_requests:i q1_minus_q5:i", SPLITS + f"""
  , sides AS (SELECT date_trunc('month', o_orderdate) AS request_month FROM orders GROUP BY ALL),
  vol AS (SELECT request_month, coalesce(sum(total_requests) FILTER (income_quintile = 1), 0) AS a,
          coalesce(sum(total_requests) FILTER (income_quintile = 5), 0) AS z FROM ({TREND_SQL}) GROUP BY ALL)
  SELECT request_month, coalesce(a, 0) AS q1_requests, coalesce(z, 0) AS q5_requests,
         coalesce(a, 0) - coalesce(z, 0) AS q1_minus_q5 FROM sides LEFT JOIN vol USING (request_month)""")
def _(spark, sf):
    from fairwait.functions import month_of

    months = b.table(spark, sf, "orders").select(month_of("o_orderdate").alias("request_month")).distinct()
    return r.volume_compare(trend(spark, sf), "request_month", months)


BRAND_GAP = partial(gap, floor=8, guard=50, types="brand")
BRAND_GAP_SQL = b.gap_ctes(8, 50, "brand")
CLUSTER = ["Brand#1", "Brand#2", "Brand#3"]


@query("headline_kpis", (
    "top_type:s top_gap:d top_q1_p90_hours:d top_q5_p90_hours:d cluster_gap:d cluster_q1_complaints:i"
), BRAND_GAP_SQL + """
  , top AS (SELECT * FROM gap ORDER BY q1_over_q5_gap DESC NULLS LAST, complaint_type LIMIT 1)
  SELECT (SELECT complaint_type FROM top) AS top_type, (SELECT q1_over_q5_gap FROM top) AS top_gap,
         (SELECT q1_p90_hours FROM top) AS top_q1_p90_hours, (SELECT q5_p90_hours FROM top) AS top_q5_p90_hours,
         median(q1_over_q5_gap) FILTER (complaint_type IN ('Brand#1', 'Brand#2', 'Brand#3')) AS cluster_gap,
         sum(q1_n_complaints) FILTER (complaint_type IN ('Brand#1', 'Brand#2', 'Brand#3')) AS cluster_q1_complaints
  FROM gap""")
def _(spark, sf):
    return r.headline_kpis(BRAND_GAP(spark, sf), CLUSTER)


RANKED = (
    "complaint_type:s q1_n_complaints:i q5_n_complaints:i total_requests:i q1_p90_hours:d q5_p90_hours:d "
    "q1_over_q5_gap:d agency:s"
)
RANKED_SQL = """
  SELECT *, {agency} AS agency FROM (
    SELECT *, q1_n_complaints + q5_n_complaints AS total_requests FROM gap
    ORDER BY {order} DESC NULLS LAST, complaint_type LIMIT 10) WHERE q1_n_complaints >= 210"""


@query("ranked_gaps", RANKED, BRAND_GAP_SQL + RANKED_SQL.format(
    agency=AGENCY_SQL.format(other="Various"), order="q1_n_complaints + q5_n_complaints"))
def _(spark, sf):
    return r.ranked_gaps(BRAND_GAP(spark, sf), agencies(spark), "volume", floor=210)


@query("ranked_gaps_by_gap", RANKED, BRAND_GAP_SQL + RANKED_SQL.format(
    agency=AGENCY_SQL.format(other="Various"), order="q1_over_q5_gap"))
def _(spark, sf):
    return r.ranked_gaps(BRAND_GAP(spark, sf), agencies(spark), "gap", floor=210)


@query("coverage_rate", "n_rows:i n_coords:i n_matched:i coverage:d", """
  SELECT count(*) AS n_rows, count(*) FILTER (l_discount > 0 AND l_tax > 0) AS n_coords,
         count(*) FILTER (l_suppkey % 10 <> 0) AS n_matched,
         avg(CASE WHEN l_suppkey % 10 <> 0 THEN 1.0 ELSE 0.0 END) AS coverage FROM lineitem""")
def _(spark, sf):
    rows = b.table(spark, sf, "lineitem").select(
        F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("longitude"),
        F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("latitude"),
        F.when(F.col("l_suppkey") % 10 != 0, F.col("l_suppkey").cast("string")).alias("tract_geoid"),
    )
    return r.coverage_rate(rows)


@query("distinct_values", "complaint_type:s", BRANDS + "SELECT DISTINCT complaint_type FROM splits")
def _(spark, sf):
    return r.distinct_values(b.splits(spark, sf, "brand"), "complaint_type")


@query("distinct_count", "n_distinct:i", "SELECT count(DISTINCT l_partkey) AS n_distinct FROM lineitem")
def _(spark, sf):
    return r.distinct_count(b.table(spark, sf, "lineitem"), "l_partkey")


@query("load_counts", "load_date:t rows_loaded:i", "SELECT ts::DATE AS load_date, count(*) AS rows_loaded FROM events GROUP BY ALL")
def _(spark, sf):
    return r.load_counts(b.table(spark, sf, "events"), "ts")


@query("score_histogram", "score_bucket:d tract_months:i", SPLITS + f"""
  SELECT {R('equity_score', 1)} AS score_bucket, count(*) AS tract_months FROM splits GROUP BY ALL""")
def _(spark, sf):
    return r.score_histogram(b.splits(spark, sf))


@query("type_ranking", "complaint_type:s avg_city_p90:d avg_score:d", BRANDS + f"""
  SELECT complaint_type, avg(city_p90) AS avg_city_p90, {R('avg(equity_score)', 10)} AS avg_score FROM splits
  GROUP BY ALL ORDER BY avg_score DESC NULLS LAST, complaint_type LIMIT 10""")
def _(spark, sf):
    return r.type_ranking(b.splits(spark, sf, "brand"))


@query("month_extent", "first_month:t last_month:t", SPLITS + """
  SELECT min(request_month) AS first_month, max(request_month) AS last_month FROM splits WHERE income_quintile IN (1, 5)""")
def _(spark, sf):
    return r.month_extent(b.splits(spark, sf))


@query("last_refresh", "last_refresh:s", "SELECT coalesce(left(strftime(max(ts), '%Y-%m-%d %H:%M:%S'), 16), 'Unknown') AS last_refresh FROM events")
def _(spark, sf):
    return r.last_refresh(b.table(spark, sf, "events"), "ts")


@query("freshness_check", "event_type:s newest:t age_hours:d status:s", """
  SELECT event_type, date_trunc('second', max(ts)) AS newest, date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-02-01 06:00:00') / 3600.0 AS age_hours,
         CASE WHEN max(ts) < TIMESTAMP '2024-02-01 06:00:00' - INTERVAL 49 HOUR THEN 'error'
              WHEN max(ts) < TIMESTAMP '2024-02-01 06:00:00' - INTERVAL 25 HOUR THEN 'warn' ELSE 'pass' END AS status
  FROM (SELECT 'all' AS event_type, ts FROM events UNION ALL
        SELECT 'old' AS event_type, ts FROM events WHERE ts < TIMESTAMP '2024-01-29') GROUP BY ALL""")
def _(spark, sf):
    events = b.table(spark, sf, "events").withColumn("ts", F.date_trunc("SECOND", "ts").cast("timestamp_ntz"))
    now = "2024-02-01 06:00:00"
    every = r.freshness_check(events, "ts", now=now).withColumn("event_type", F.lit("all"))
    old = r.freshness_check(events.filter(F.col("ts") < "2024-01-29"), "ts", now=now)
    return every.unionByName(old.withColumn("event_type", F.lit("old")))


@query("series_text", "income_quintile:i series:s", SPLITS + f"""
  SELECT income_quintile, string_agg(strftime(request_month, '%Y-%m') || '=' ||
         printf('%.2f', {R('avg_equity_score', 2)}), ', ' ORDER BY request_month) AS series
  FROM ({TREND_SQL}) GROUP BY ALL""")
def _(spark, sf):
    return series_text(trend(spark, sf), ["income_quintile"], "request_month", "avg_equity_score")


@query("min_count", "tract_geoid:s complaint_type:s request_month:t request_count:i", SPLITS + """
  SELECT * FROM splits WHERE request_count >= 2""")
def _(spark, sf):
    return min_count(b.splits(spark, sf), n=ROW_FLOOR)
