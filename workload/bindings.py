"""The given tables seen as service requests and tracts.

A line item is a request: ordered = created, shipped = closed, order priority = type,
supplier = tract. A supplier's balance stands for its tract's income; balances at or below
zero count as suppressed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairwait.operators import normalize_demographics, null_sentinel
from fairwait.plans import marts

ROW_FLOOR = 2  # cells of the given tables hold at most a handful of requests


# Given, so that no job has to look into the files before a query is planned.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def requests(spark, sf, types: str = "priority") -> DataFrame:
    """Cleaned requests; ``types`` is "priority" (5 types) or "brand" (25)."""
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    # One after the other, so that each small table is broadcast on its own known size.
    rows = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    kind = "o_orderpriority"
    if types == "brand":
        kind = "p_brand"
        rows = rows.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("unique_key"),
        F.col("o_orderdate").alias("created_at"),
        F.col("l_shipdate").alias("closed_at"),
        F.col("l_shipdate").alias("updated_at"),
        F.col("o_orderstatus").alias("agency_code"),
        F.col(kind).alias("complaint_type"),
        F.when(F.col("l_linestatus") == "O", "OPEN").otherwise("CLOSED").alias("status"),
        F.col("r_name").alias("borough"),
        F.col("l_suppkey").cast("string").alias("tract_geoid"),
    )


REQUESTS_SQL = """
boroughs AS (
  SELECT s_suppkey, r_name AS borough FROM supplier
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
requests AS (
  SELECT l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS unique_key,
         o_orderdate AS created_at, l_shipdate AS closed_at, l_shipdate AS updated_at,
         o_orderstatus AS agency_code, {kind} AS complaint_type,
         CASE WHEN l_linestatus = 'O' THEN 'OPEN' ELSE 'CLOSED' END AS status,
         borough, l_suppkey::VARCHAR AS tract_geoid
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN boroughs ON l_suppkey = s_suppkey {more})
"""


def requests_sql(types: str = "priority") -> str:
    if types == "brand":
        return REQUESTS_SQL.format(kind="p_brand", more="JOIN part ON l_partkey = p_partkey")
    return REQUESTS_SQL.format(kind="o_orderpriority", more="")


def raw_demographics(spark, sf) -> DataFrame:
    key = F.col("s_suppkey")
    raw = table(spark, sf, "supplier").select(
        F.concat(F.lit("1400000US"), key.cast("string")).alias("geo_id"),
        F.col("s_acctbal").alias("b19013_001e"),
        (F.col("s_nationkey") * 40.0).alias("b01003_001e"),
        (F.col("s_nationkey") * 7.0 + key % 5).alias("b17001_002e"),
        (key % 101 + 0.5).alias("b03002_003e"),
        (key % 103 + 0.25).alias("b03002_012e"),
        (key % 107 + 0.75).alias("b03002_004e"),
        F.lit("36").alias("state"),
        F.lpad(F.col("s_nationkey").cast("string"), 3, "0").alias("county"),
        F.lpad(key.cast("string"), 6, "0").alias("tract"),
        F.lpad(F.col("s_nationkey").cast("string"), 3, "0").alias("county_fips"),
        F.lit(2022).alias("vintage_year"),
    )
    return null_sentinel(raw, ["b19013_001e"], 0.0)


DEMOGRAPHICS_SQL = """
demographics AS (
  SELECT s_suppkey::VARCHAR AS tract_geoid,
         '36' || lpad(s_nationkey::VARCHAR, 3, '0') || lpad(s_suppkey::VARCHAR, 6, '0') AS fips_full,
         '36' AS state_fips, lpad(s_nationkey::VARCHAR, 3, '0') AS county_fips,
         lpad(s_suppkey::VARCHAR, 6, '0') AS tract_code,
         CASE WHEN s_acctbal > 0 THEN round(s_acctbal)::INTEGER END AS median_household_income,
         round(s_nationkey * 40.0)::INTEGER AS total_population,
         round(s_nationkey * 7.0 + s_suppkey % 5)::INTEGER AS population_below_poverty,
         round(s_suppkey % 101 + 0.5)::INTEGER AS pop_white_non_hispanic,
         round(s_suppkey % 103 + 0.25)::INTEGER AS pop_hispanic,
         round(s_suppkey % 107 + 0.75)::INTEGER AS pop_black, 2022 AS vintage_year
  FROM supplier),
dim AS (
  SELECT *, CAST(round(CAST(100.0 * population_below_poverty / nullif(total_population, 0)
                 AS DECIMAL(38,10)), 2) AS DOUBLE) AS pct_below_poverty,
         ntile(5) OVER (ORDER BY median_household_income NULLS LAST, tract_geoid) AS income_quintile
  FROM demographics)
"""


def dim(spark, sf) -> DataFrame:
    return marts.dim_tract(normalize_demographics(raw_demographics(spark, sf)))


def known_dim(spark, sf) -> DataFrame:
    """Tracts with an income, so that some requests have no tract."""
    return dim(spark, sf).filter(F.col("median_household_income").isNotNull())


def fact(spark, sf, types: str = "priority") -> DataFrame:
    # The same tracts as ``known_dim``, which ranks them as well.
    tracts = normalize_demographics(raw_demographics(spark, sf))
    return marts.request_facts(
        requests(spark, sf, types), tracts.filter(F.col("median_household_income").isNotNull())
    )


FACT_SQL = """
fact AS (
  SELECT *, date_trunc('month', created_at) AS request_month,
         date_diff('hour', created_at, closed_at) AS response_time_hours
  FROM requests WHERE closed_at > created_at
  AND tract_geoid IN (SELECT tract_geoid FROM dim WHERE median_household_income IS NOT NULL))
"""


def splits(spark, sf, types: str = "priority") -> DataFrame:
    return marts.equity_score(fact(spark, sf, types), dim(spark, sf))


SPLITS_SQL = """
stats AS (
  SELECT tract_geoid, complaint_type, request_month, borough, count(*) AS request_count,
         quantile_cont(response_time_hours, 0.50) AS p50_hours,
         quantile_cont(response_time_hours, 0.75) AS p75_hours,
         quantile_cont(response_time_hours, 0.90) AS p90_hours
  FROM fact GROUP BY ALL),
baseline AS (
  SELECT complaint_type, request_month, median(p90_hours) AS city_p90 FROM stats GROUP BY ALL),
splits AS (
  SELECT stats.*, income_quintile, median_household_income, pct_below_poverty, total_population,
         pop_black, pop_hispanic, city_p90,
         CAST(round(CAST(p90_hours / nullif(city_p90, 0) AS DECIMAL(38,10)), 4) AS DOUBLE) AS equity_score
  FROM stats JOIN dim USING (tract_geoid) JOIN baseline USING (complaint_type, request_month))
"""

SUMMARY_SQL = """
cells AS (
  SELECT tract_geoid, complaint_type, income_quintile, count(*) AS n,
         quantile_cont(response_time_hours, 0.90) AS p90, quantile_cont(response_time_hours, 0.50) AS p50
  FROM fact JOIN dim USING (tract_geoid) GROUP BY ALL HAVING count(*) >= {floor}),
summary AS (
  SELECT complaint_type, income_quintile, count(*) AS n_tracts, sum(n)::BIGINT AS n_complaints,
         CAST(round(CAST(median(p90) AS DECIMAL(38,10)), 1) AS DOUBLE) AS median_tract_p90_hours,
         CAST(round(CAST(median(p50) AS DECIMAL(38,10)), 1) AS DOUBLE) AS median_tract_p50_hours
  FROM cells GROUP BY ALL),
gap AS (
  SELECT a.complaint_type, a.n_complaints AS q1_n_complaints, b.n_complaints AS q5_n_complaints,
         a.median_tract_p90_hours AS q1_p90_hours, b.median_tract_p90_hours AS q5_p90_hours,
         CAST(round(CAST(a.median_tract_p90_hours / nullif(b.median_tract_p90_hours, 0)
              AS DECIMAL(38,10)), 2) AS DOUBLE) AS q1_over_q5_gap
  FROM summary a JOIN summary b USING (complaint_type)
  WHERE a.income_quintile = 1 AND b.income_quintile = 5
    AND a.n_complaints >= {guard} AND b.n_complaints >= {guard})
"""


def ctes(*parts: str) -> str:
    return "WITH " + ", ".join(p.strip() for p in parts) + " "


def fact_ctes(types: str = "priority") -> str:
    return ctes(requests_sql(types), DEMOGRAPHICS_SQL, FACT_SQL)


def splits_ctes(types: str = "priority", *more: str) -> str:
    return ctes(requests_sql(types), DEMOGRAPHICS_SQL, FACT_SQL, SPLITS_SQL, *more)


def gap_ctes(floor: int, guard: int, types: str = "priority") -> str:
    return ctes(
        requests_sql(types), DEMOGRAPHICS_SQL, FACT_SQL, SUMMARY_SQL.format(floor=floor, guard=guard)
    )
