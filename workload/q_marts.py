"""Marts, aggregations and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from fairwait.operators import dedup_latest, grouped_quantiles, ntile_bucket, quintile_self_join
from fairwait.plans import marts

from . import bindings as b
from .registry import query

FLOOR, GUARD = 30, 500

GAP = "complaint_type:s q1_n_complaints:i q5_n_complaints:i q1_p90_hours:d q5_p90_hours:d q1_over_q5_gap:d"


def summary(spark, sf, floor=FLOOR, types="priority"):
    return marts.quintile_summary(b.fact(spark, sf, types), b.dim(spark, sf), floor)


def gap(spark, sf, floor=FLOOR, guard=GUARD, types="priority"):
    return marts.gap_by_type(summary(spark, sf, floor, types), guard)


@query("gap_by_type", GAP, b.gap_ctes(FLOOR, GUARD) + "SELECT * FROM gap")
def _(spark, sf):
    return gap(spark, sf)


# A floor that really removes cells.
@query("gap_by_type_floor_60", GAP, b.gap_ctes(60, GUARD) + "SELECT * FROM gap")
def _(spark, sf):
    return gap(spark, sf, floor=60)


@query("dim_tract", (
    "tract_geoid:s fips_full:s state_fips:s county_fips:s tract_code:s median_household_income:i "
    "total_population:i population_below_poverty:i pct_below_poverty:d pop_white_non_hispanic:i "
    "pop_hispanic:i pop_black:i income_quintile:i vintage_year:i"
), b.ctes(b.DEMOGRAPHICS_SQL) + "SELECT * FROM dim")
def _(spark, sf):
    return b.dim(spark, sf)


@query("ntile_bucket", "s_suppkey:i bucket:i",
       "SELECT s_suppkey, ntile(7) OVER (ORDER BY s_acctbal NULLS LAST, s_suppkey) AS bucket FROM supplier")
def _(spark, sf):
    return ntile_bucket(b.table(spark, sf, "supplier"), "s_acctbal", 7, ["s_suppkey"])


# Many ranges over a large table with many equal values.
@query("ntile_bucket_ranged", "o_orderkey:i bucket:i", """
  SELECT o_orderkey, ntile(11) OVER (ORDER BY v NULLS LAST, o_orderkey) AS bucket
  FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice / 1000) END AS v FROM orders)""")
def _(spark, sf):
    value = F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 1000))
    rows = b.table(spark, sf, "orders").select("o_orderkey", value.alias("v"))
    return ntile_bucket(rows, "v", 11, ["o_orderkey"], ranges=40)


STATS = (
    "tract_geoid:s complaint_type:s request_month:t borough:s request_count:i "
    "p50_hours:d p75_hours:d p90_hours:d"
)


@query("tract_stats", STATS, b.splits_ctes() + "SELECT * FROM stats")
def _(spark, sf):
    return marts.tract_stats(b.fact(spark, sf))


@query("city_baseline", "complaint_type:s request_month:t city_p90:d", b.splits_ctes() + "SELECT * FROM baseline")
def _(spark, sf):
    return marts.city_baseline(marts.tract_stats(b.fact(spark, sf)))


@query("equity_score", STATS + (
    " income_quintile:i median_household_income:i pct_below_poverty:d total_population:i pop_black:i "
    "pop_hispanic:i city_p90:d equity_score:d"
), b.splits_ctes() + "SELECT * FROM splits")
def _(spark, sf):
    return b.splits(spark, sf)


@query("cell_percentiles", (
    "tract_geoid:s complaint_type:s income_quintile:i tract_complaint_n:i tract_p90_hours:d tract_p50_hours:d"
), b.gap_ctes(FLOOR, GUARD) + """
  SELECT tract_geoid, complaint_type, income_quintile, n AS tract_complaint_n, p90 AS tract_p90_hours,
         p50 AS tract_p50_hours FROM cells""")
def _(spark, sf):
    return marts.cell_percentiles(marts.with_quintile(b.fact(spark, sf), b.dim(spark, sf)))


# Sketches instead of exact values. A cell is smaller than the sketch here, so the element it
# returns is the one at the exact rank.
@query("cell_percentiles_approx", (
    "tract_geoid:s complaint_type:s income_quintile:i tract_complaint_n:i tract_p90_hours:d tract_p50_hours:d"
), b.fact_ctes() + """
  SELECT tract_geoid, complaint_type, income_quintile, count(*) AS tract_complaint_n,
         quantile_disc(response_time_hours, 0.90) AS tract_p90_hours, quantile_disc(response_time_hours, 0.50) AS tract_p50_hours
  FROM fact JOIN dim USING (tract_geoid) GROUP BY ALL HAVING count(*) >= 30""")
def _(spark, sf):
    return marts.cell_percentiles(marts.with_quintile(b.fact(spark, sf), b.dim(spark, sf)), approx=True)


@query("median_of_cells", (
    "complaint_type:s income_quintile:i n_tracts:i n_complaints:i median_tract_p90_hours:d "
    "median_tract_p50_hours:d"
), b.gap_ctes(FLOOR, GUARD) + "SELECT * FROM summary")
def _(spark, sf):
    return summary(spark, sf)


@query("quintile_self_join", "complaint_type:s q1_n:i q5_n:i q1_p50:d q5_p50:d", b.gap_ctes(8, GUARD, "brand") + """
  SELECT complaint_type, a.n_complaints AS q1_n, z.n_complaints AS q5_n,
         a.median_tract_p50_hours AS q1_p50, z.median_tract_p50_hours AS q5_p50
  FROM summary a JOIN summary z USING (complaint_type)
  WHERE a.income_quintile = 1 AND z.income_quintile = 5""")
def _(spark, sf):
    return quintile_self_join(
        summary(spark, sf, 8, "brand"), "complaint_type",
        {"n": "n_complaints", "p50": "median_tract_p50_hours"},
    )


@query("pooled_trend", "month:t income_quintile:i n_complaints:i p90_hours:d p50_hours:d", b.fact_ctes() + """
  SELECT request_month AS month, income_quintile, count(*) AS n_complaints,
         CAST(round(CAST(quantile_cont(response_time_hours, 0.90) AS DECIMAL(38,10)), 1) AS DOUBLE) AS p90_hours,
         CAST(round(CAST(quantile_cont(response_time_hours, 0.50) AS DECIMAL(38,10)), 1) AS DOUBLE) AS p50_hours
  FROM fact JOIN dim USING (tract_geoid) GROUP BY ALL""")
def _(spark, sf):
    return marts.pooled_trend(b.fact(spark, sf), b.dim(spark, sf))


# Few groups over a column of doubles, several measures at once.
@query("grouped_quantiles", "l_returnflag:s n:i price_p90:d price_p50:d tax_p50:d max_qty:d", """
  SELECT l_returnflag, count(*) AS n, quantile_cont(l_extendedprice, 0.90) AS price_p90,
         quantile_cont(l_extendedprice, 0.50) AS price_p50,
         quantile_cont(CASE WHEN l_linestatus = 'O' THEN l_tax END, 0.50) AS tax_p50,
         max(l_quantity) AS max_qty
  FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    rows = b.table(spark, sf, "lineitem").withColumn("tax", F.when(F.col("l_linestatus") == "O", F.col("l_tax")))
    return grouped_quantiles(
        rows, ["l_returnflag"],
        {"price_p90": ("l_extendedprice", 0.9), "price_p50": ("l_extendedprice", 0.5), "tax_p50": ("tax", 0.5)},
        {"n": ("count", "*"), "max_qty": ("max", "l_quantity")}, wide=True,
    )


# Values in a narrow band, as latitudes are.
@query("grouped_quantiles_narrow", "l_returnflag:s p50:d p90:d", """
  SELECT l_returnflag, quantile_cont(40.5::DOUBLE + l_extendedprice / 1000000, 0.50) AS p50,
         quantile_cont(40.5::DOUBLE + l_extendedprice / 1000000, 0.90) AS p90 FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    rows = b.table(spark, sf, "lineitem").withColumn("latitude", F.lit(40.5) + F.col("l_extendedprice") / 1_000_000)
    return grouped_quantiles(rows, ["l_returnflag"], {"p50": ("latitude", 0.5), "p90": ("latitude", 0.9)}, wide=True)


@query("dedup_latest", "l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i l_quantity:d l_shipdate:t", """
  SELECT * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
    l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC,
    l_returnflag DESC, l_linestatus DESC) = 1""")
def _(spark, sf):
    return dedup_latest(
        b.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"],
        ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
         "l_linestatus"],
    )


@query("request_facts", "unique_key:s request_month:t complaint_type:s tract_geoid:s response_time_hours:i",
       b.fact_ctes() + "SELECT * FROM fact")
def _(spark, sf):
    return b.fact(spark, sf)
