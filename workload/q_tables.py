"""Sources, sinks, cleaning, filters and joins."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairwait import functions as fn
from fairwait import operators as op
from fairwait import sinks, sources
from fairwait.plans import marts
from fairwait.session import scratch_path

from . import bindings as b
from .registry import query

# -- sources -----------------------------------------------------------------------------


def order_records(spark, sf):
    """Orders as request records: some fields absent, some coordinates not numbers."""
    return b.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("unique_key"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("created_date"),
        F.when(F.col("o_orderstatus") != "O", F.lit("1999-01-01T00:00:00")).alias("closed_date"),
        F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit(" ")).alias("complaint_type"),
        F.when(F.col("o_custkey") % 7 == 0, "n/a").otherwise((F.col("o_custkey") / 8).cast("string")).alias("latitude"),
        (F.col("o_custkey") / 16).alias("longitude"),
        F.lit("ignored").alias("extra_field"),
    )


@query("read_request_records", (
    "unique_key:s created_date:s closed_date:s complaint_type:s borough:s latitude:d longitude:d ingestion_timestamp:t"
), """
  SELECT o_orderkey::VARCHAR AS unique_key, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS created_date,
         CASE WHEN o_orderstatus <> 'O' THEN '1999-01-01T00:00:00' END AS closed_date,
         '  ' || lower(o_orderpriority) || ' ' AS complaint_type, 'absent' AS borough,
         CASE WHEN o_custkey % 7 <> 0 THEN o_custkey / 8 END AS latitude, o_custkey / 16 AS longitude,
         TIMESTAMP '2024-05-01 12:00:00' AS ingestion_timestamp FROM orders""")
def _(spark, sf):
    path = scratch_path(spark, "records")
    order_records(spark, sf).write.json(path)
    return sources.read_request_records(spark, path, "2024-05-01 12:00:00").withColumn(
        "borough", F.coalesce("borough", F.lit("absent"))
    )


@query("scan_since", "event_id:i user_id:i ts:t", "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15 12:00:00'")
def _(spark, sf):
    return sources.scan_since(b.table(spark, sf, "events"), "ts", "2024-01-15 12:00:00", ordered=True)


@query("scan_month", "o_orderkey:i o_orderdate:t",
       "SELECT * FROM orders WHERE o_orderdate >= DATE '1997-12-01' AND o_orderdate < DATE '1998-01-01'")
def _(spark, sf):
    return sources.scan_month(b.table(spark, sf, "orders"), "o_orderdate", 1997, 12)


@query("month_spine", "month:t", """
  SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS month
  FROM orders""")
def _(spark, sf):
    first, last = b.table(spark, sf, "orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    return sources.month_spine(spark, first.date(), last.date())


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("union_sources", "c_custkey:i c_acctbal:d county_fips:s vintage_year:i", """
  SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS c_acctbal,
         c_mktsegment AS county_fips, 2022 AS vintage_year FROM customer
  WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')""")
def _(spark, sf):
    customers = b.table(spark, sf, "customer")
    parts = {s: customers.filter(F.col("c_mktsegment") == s).select("c_custkey", "c_acctbal") for s in SEGMENTS}
    parts["BUILDING"] = parts["BUILDING"].drop("c_acctbal")
    return sources.union_sources(parts, vintage_year=2022)


@query("concat_batches", "o_orderkey:i o_totalprice:d o_custkey:i", """
  SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS o_totalprice,
         CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS o_custkey FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')""")
def _(spark, sf):
    orders = b.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey", "o_orderstatus")
    parts = {s: orders.filter(F.col("o_orderstatus") == s) for s in "FOP"}
    return sources.concat_batches([parts["F"].drop("o_totalprice"), parts["O"].drop("o_custkey"), parts["P"]])


@query("read_boundaries", "tract_geoid:s n_rings:i n_points:i x_max:d", """
  SELECT s_suppkey::VARCHAR AS tract_geoid, CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 1 END AS n_rings,
         CASE WHEN s_suppkey % 3 = 0 THEN 10 ELSE 5 END AS n_points, s_suppkey + 1.0 AS x_max FROM supplier""")
def _(spark, sf):
    key = F.col("s_suppkey")
    square = "[[{0},0],[{0}.5,0],[{0}.5,1],[{0},1],[{0},0]]"
    one = F.concat(F.lit("["), _fill(square, key), F.lit("]"))
    two = F.concat(F.lit("[["), _fill(square, key), F.lit("],["), _fill(square, key), F.lit("]]"))
    is_multi = key % 3 == 0
    # One feature per line, so that the file splits.
    line = F.concat(
        F.lit('{"type":"Feature","properties":{"tract_geoid":" '), key.cast("string"),
        F.lit(' "},"geometry":{"type":"'), F.when(is_multi, "MultiPolygon").otherwise("Polygon"),
        F.lit('","coordinates":'), F.when(is_multi, two).otherwise(one), F.lit("}}"),
    )
    path = scratch_path(spark, "boundaries")
    b.table(spark, sf, "supplier").select(line.alias("value")).write.text(path)
    points = F.flatten("rings")
    return sources.read_boundaries(spark, path, lines=True).select(
        "tract_geoid",
        F.size("rings").alias("n_rings"),
        F.size(points).alias("n_points"),
        (F.array_max(F.transform(points, lambda p: p["x"])) + 0.5).alias("x_max"),
    )


# As published: a feature collection per file, several files, one order over all of them.
@query("read_boundaries_collections", "tract_geoid:s ord:i n_points:i", """
  WITH f AS (SELECT s_suppkey, s_nationkey % 3 AS part FROM supplier)
  SELECT s_suppkey::VARCHAR AS tract_geoid, row_number() OVER (ORDER BY part, s_suppkey) - 1 AS ord, 5 AS n_points FROM f""")
def _(spark, sf):
    key = F.col("s_suppkey")
    feature = F.concat(
        F.lit('{"type":"Feature","properties":{"tract_geoid":"'), key.cast("string"),
        F.lit('"},"geometry":{"type":"Polygon","coordinates":['), _fill("[[{0},0],[{0}.5,0],[{0}.5,1],[{0},1],[{0},0]]", key), F.lit("]}}"),
    )
    features = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, feature.alias("f")))), lambda x: x["f"]), ",")
    files = b.table(spark, sf, "supplier").groupBy((F.col("s_nationkey") % 3).alias("part")).agg(features.alias("f"))
    path = scratch_path(spark, "collections")
    whole = F.concat(F.lit('{"type":"FeatureCollection","features":['), "f", F.lit("]}"))
    files.select("part", whole.alias("value")).repartition("part").write.partitionBy("part").text(path)
    return sources.read_boundaries(spark, path).select("tract_geoid", "ord", F.size(F.flatten("rings")).alias("n_points"))


def _fill(pattern: str, key):
    pieces = pattern.split("{0}")
    cols = [F.lit(pieces[0])]
    for piece in pieces[1:]:
        cols += [key.cast("string"), F.lit(piece)]
    return F.concat(*cols)


@query("read_crosswalk", "tract_geoid:s neighborhood:s", """
  SELECT c_nationkey::VARCHAR AS tract_geoid, max(c_mktsegment) AS neighborhood FROM customer
  WHERE c_nationkey % 4 <> 0 AND c_mktsegment <> 'MACHINERY' GROUP BY ALL""")
def _(spark, sf):
    return crosswalk(spark, sf)


def crosswalk(spark, sf):
    rows = b.table(spark, sf, "customer").select(
        F.when(F.col("c_nationkey") % 4 != 0, F.col("c_nationkey").cast("string")).alias("geoid"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("ntaname"),
    )
    return sources.read_crosswalk(rows)


@query("read_parquet_table", "ORDER_KEY:s L_QUANTITY:i NOTE:s", """
  SELECT l_orderkey::VARCHAR AS "ORDER_KEY", l_quantity AS "L_QUANTITY", 'absent' AS "NOTE" FROM lineitem""")
def _(spark, sf):
    schema = T.StructType(
        [
            T.StructField("L_ORDERKEY", T.StringType()),
            T.StructField("L_QUANTITY", T.IntegerType()),
            T.StructField("NOTE", T.StringType()),
        ]
    )
    read = sources.read_parquet_table(spark, f"{sf}/lineitem.parquet", schema)
    return read.select(
        F.col("L_ORDERKEY").alias("ORDER_KEY"), "L_QUANTITY", F.coalesce("NOTE", F.lit("absent")).alias("NOTE")
    )


# The preview may be any five rows: each must be one of the table's.
@query("explore_raw", "n_rows:i latest:t n_preview:i n_known:i",
       "SELECT count(*) AS n_rows, max(ts) AS latest, 5 AS n_preview, 5 AS n_known FROM events")
def _(spark, sf):
    events = b.table(spark, sf, "events")
    preview, summary = sources.explore_raw(events, "ts")
    known = events.join(preview, events.columns, "left_semi").count()
    return summary.withColumns({"n_preview": F.lit(preview.count()), "n_known": F.lit(known)})


# -- sinks -------------------------------------------------------------------------------


@query("write_partition", "o_orderkey:i o_totalprice:d o_orderstatus:s",
       "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice, o_orderstatus FROM orders")
def _(spark, sf):
    path = scratch_path(spark, "partitioned")
    orders = b.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    sinks.write_partition(orders, path, "o_orderstatus")
    # A rerun of one partition replaces that one only.
    again = orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", -F.col("o_totalprice"))
    sinks.write_partition(again, path, "o_orderstatus")
    return spark.read.parquet(path)


@query("append_raw", "c_custkey:i c_acctbal:d loaded:i", """
  SELECT c_custkey, CASE WHEN c_nationkey < 10 THEN c_acctbal END AS c_acctbal,
         (SELECT count(*) FROM customer WHERE c_nationkey >= 10) AS loaded FROM customer""")
def _(spark, sf):
    path = scratch_path(spark, "raw")
    customers = b.table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    sinks.append_raw(customers.filter("c_nationkey < 10"), path)
    # By name: other order and case, one column missing.
    more = customers.filter("c_nationkey >= 10").select(F.col("c_nationkey").alias("C_NATIONKEY"), "c_custkey")
    loaded = sinks.append_raw(more, path)
    return spark.read.parquet(path).withColumn("loaded", F.lit(loaded))


@query("replace_table", "c_custkey:i c_acctbal:d", "SELECT c_custkey, c_acctbal * 2 AS c_acctbal FROM customer WHERE c_acctbal > 0")
def _(spark, sf):
    path = scratch_path(spark, "snapshot")
    sinks.replace_table(b.table(spark, sf, "customer").select("c_custkey", "c_acctbal"), path)
    # The new version reads the old one.
    better = sinks.read_snapshot(spark, path).filter("c_acctbal > 0").withColumn("c_acctbal", F.col("c_acctbal") * 2)
    sinks.replace_table(better, path)
    return sinks.read_snapshot(spark, path)


@query("ensure_table", "s_suppkey:i s_name:s", "SELECT s_suppkey, s_name FROM supplier")
def _(spark, sf):
    path = scratch_path(spark, "ensured")
    suppliers = b.table(spark, sf, "supplier").select("s_suppkey", "s_name")
    assert sinks.ensure_table(spark, path, suppliers.schema)
    sinks.append_raw(suppliers, path)
    assert not sinks.ensure_table(spark, path, suppliers.schema)
    return spark.read.parquet(path)


@query("materialise", "user_id:i event_type:s ts:t value:d", """
  SELECT user_id, event_type, ts, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1""")
def _(spark, sf):
    root = scratch_path(spark, "models")
    events = op.dedup_latest(b.table(spark, sf, "events"), ["user_id", "event_type"], ["ts"])
    staged = sinks.materialise(events, "stg_events", "view")
    early = op.dedup_latest(b.table(spark, sf, "events").filter("ts < timestamp_ntz'2024-01-16'"), ["user_id", "event_type"], ["ts"])
    sinks.materialise(early, "int_events", "incremental", root, ["user_id", "event_type"])
    merged = sinks.materialise(staged, "int_events", "incremental", root, ["user_id", "event_type"])
    return sinks.materialise(merged, "mart_events", "table", root)


# -- cleaning ----------------------------------------------------------------------------


@query("coerce_numeric", "p_partkey:i v:d",
       "SELECT p_partkey, CASE WHEN p_size % 3 <> 0 THEN p_retailprice END AS v FROM part")
def _(spark, sf):
    text = F.when(F.col("p_size") % 3 == 0, F.col("p_name")).otherwise(F.col("p_retailprice").cast("string"))
    return op.coerce_numeric(b.table(spark, sf, "part").select("p_partkey", text.alias("v")), ["v"])


@query("null_sentinel", "c_custkey:i c_acctbal:d",
       "SELECT c_custkey, CASE WHEN c_acctbal > 100.0 THEN c_acctbal END AS c_acctbal FROM customer")
def _(spark, sf):
    return op.null_sentinel(b.table(spark, sf, "customer"), ["c_acctbal"], 100.0)


def raw_requests(spark, sf):
    """Line items in the landed form: ISO text, stray blanks, mixed case, repeated keys."""
    rows = b.table(spark, sf, "lineitem").join(b.table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSS"
    cols = {
        "unique_key": F.when(F.col("l_linenumber") < 7, F.concat_ws("-", "l_orderkey", "l_linenumber")),
        "created_date": F.date_format("o_orderdate", iso),
        "closed_date": F.date_format("l_shipdate", iso),
        "resolution_action_updated_date": F.when(F.col("l_returnflag") != "N", F.date_format("l_shipdate", iso)),
        "agency": F.concat(F.lit(" "), F.lower("o_orderstatus"), F.lit("  ")),
        "agency_name": F.concat(F.lit(" dept "), "l_linestatus"),
        "complaint_type": F.concat(F.lower("o_orderpriority"), F.lit(" ")),
        "location_type": F.when(F.col("l_linenumber") % 2 == 0, "Street "),
        "incident_zip": F.concat(F.lit(" "), F.col("o_custkey").cast("string")),
        "incident_address": F.concat(F.col("l_partkey").cast("string"), F.lit(" Main St ")),
        "borough": F.when(F.col("l_suppkey") % 3 == 0, "Bronx").when(F.col("l_suppkey") % 3 == 1, " queens"),
        "open_data_channel_type": F.lit(" PHONE "),
        "descriptor": F.col("l_returnflag"),
        "status": F.when(F.col("l_linestatus") == "O", " Open ").otherwise("closed"),
        "latitude": F.col("l_discount") + 40,
        "longitude": F.col("l_tax") - 74,
        "tract_geoid": F.col("l_suppkey").cast("string"),
        "resolution_description": F.concat_ws("/", "l_partkey", F.col("l_quantity").cast("int"), F.round(F.col("l_extendedprice") * 100).cast("bigint")),
        "ingestion_timestamp": F.col("l_shipdate"),
    }
    from fairwait.schemas import RAW_REQUESTS

    return rows.select(
        *[cols.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RAW_REQUESTS]
    )


CLEAN = (
    "unique_key:s created_at:t closed_at:t updated_at:t agency_code:s agency_name:s complaint_type:s descriptor:s location_type:s "
    "incident_zip:s incident_address:s borough:s status:s channel_type:s resolution_description:s latitude:d longitude:d "
    "tract_geoid:s ingestion_timestamp:t"
)
CLEAN_SQL = """
  SELECT l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS unique_key, o_orderdate AS created_at,
         l_shipdate AS closed_at, CASE WHEN l_returnflag <> 'N' THEN l_shipdate END AS updated_at,
         upper(o_orderstatus) AS agency_code, 'DEPT ' || l_linestatus AS agency_name, upper(o_orderpriority) AS complaint_type,
         l_returnflag AS descriptor, CASE WHEN l_linenumber % 2 = 0 THEN 'STREET' END AS location_type,
         o_custkey::VARCHAR AS incident_zip, l_partkey::VARCHAR || ' Main St' AS incident_address,
         CASE l_suppkey % 3 WHEN 0 THEN 'BRONX' WHEN 1 THEN 'QUEENS' END AS borough, 'PHONE' AS channel_type,
         l_partkey::VARCHAR || '/' || l_quantity::INTEGER || '/' || round(l_extendedprice * 100)::BIGINT AS resolution_description,
         CASE WHEN l_linestatus = 'O' THEN 'OPEN' ELSE 'CLOSED' END AS status, l_discount + 40 AS latitude,
         l_tax - 74 AS longitude, l_suppkey::VARCHAR AS tract_geoid, l_shipdate AS ingestion_timestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber < 7"""


@query("normalize_requests", CLEAN, CLEAN_SQL)
def _(spark, sf):
    return op.normalize_requests(raw_requests(spark, sf))


# The latest version of every request; equal ones are settled by all other columns in turn.
TIES = CLEAN.replace("unique_key:s ", "").replace(" updated_at:t", "").replace(" ingestion_timestamp:t", "").split()
LATEST_SQL = f"""
  SELECT * FROM ({CLEAN_SQL}) QUALIFY row_number() OVER (PARTITION BY unique_key
    ORDER BY updated_at DESC NULLS LAST, ingestion_timestamp DESC, {", ".join(c.split(":")[0] + " DESC NULLS LAST" for c in TIES)}) = 1"""


@query("stage_requests", CLEAN, LATEST_SQL)
def _(spark, sf):
    return op.stage_requests(raw_requests(spark, sf))


@query("normalize_demographics", (
    "tract_geoid:s fips_full:s state_fips:s county_fips:s tract_code:s median_household_income:i total_population:i "
    "population_below_poverty:i pop_white_non_hispanic:i pop_hispanic:i pop_black:i vintage_year:i"
), b.ctes(b.DEMOGRAPHICS_SQL) + "SELECT * FROM demographics")
def _(spark, sf):
    return op.normalize_demographics(b.raw_demographics(spark, sf))


MINUTES = """
  SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate + (o_custkey % 1440)::INTEGER * INTERVAL 1 MINUTE AS created_at,
         l_shipdate + (l_partkey % 1440)::INTEGER * INTERVAL 1 MINUTE AS closed_at,
         CASE WHEN l_linestatus = 'O' THEN 'Open' ELSE 'Closed' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def minute_requests(spark, sf):
    """Requests created and closed within the day, so hour boundaries matter."""
    rows = b.table(spark, sf, "lineitem").join(b.table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))

    def plus(ts, key):
        return F.col(ts) + F.make_dt_interval(mins=(F.col(key) % 1440).cast("int"))

    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        plus("o_orderdate", "o_custkey").alias("created_at"),
        plus("l_shipdate", "l_partkey").alias("closed_at"),
        F.when(F.col("l_linestatus") == "O", "Open").otherwise("Closed").alias("status"),
    )


@query("response_hours", "l_orderkey:i l_linenumber:i hours:i", f"""
  SELECT l_orderkey, l_linenumber, CASE WHEN closed_at > created_at THEN date_diff('hour', created_at, closed_at) END AS hours
  FROM ({MINUTES})""")
def _(spark, sf):
    return minute_requests(spark, sf).withColumn("hours", fn.response_hours("created_at", "closed_at"))


@query("resolution_status", "l_orderkey:i l_linenumber:i resolution_status:s", f"""
  SELECT l_orderkey, l_linenumber, CASE WHEN closed_at > created_at THEN 'closed' WHEN upper(status) = 'OPEN' THEN 'open' ELSE 'other' END
    AS resolution_status FROM ({MINUTES})""")
def _(spark, sf):
    return minute_requests(spark, sf).withColumn(
        "resolution_status", fn.resolution_status("created_at", "closed_at", "status")
    )


@query("month_of", "event_id:i month:t", "SELECT event_id, date_trunc('month', ts) AS month FROM events")
def _(spark, sf):
    return b.table(spark, sf, "events").withColumn("month", fn.month_of("ts"))


@query("pct_of", "s_suppkey:i pct:d", """
  SELECT s_suppkey, CAST(round(CAST(100.0 * (s_suppkey % 97) / nullif(s_nationkey, 0) AS DECIMAL(38,10)), 2) AS DOUBLE) AS pct FROM supplier""")
def _(spark, sf):
    return b.table(spark, sf, "supplier").withColumn("pct", fn.pct_of(F.col("s_suppkey") % 97, "s_nationkey"))


@query("safe_ratio", "l_orderkey:i l_linenumber:i ratio:d", """
  SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice / nullif(l_quantity - 1, 0) AS DECIMAL(38,10)), 4) AS DOUBLE) AS ratio FROM lineitem""")
def _(spark, sf):
    return b.table(spark, sf, "lineitem").withColumn(
        "ratio", fn.safe_ratio("l_extendedprice", F.col("l_quantity") - 1, 4)
    )


@query("geoid_county", "c_custkey:i county:s", """
  SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN '36' WHEN 1 THEN 'Bronx' WHEN 2 THEN 'Brooklyn' WHEN 3 THEN 'Manhattan'
         WHEN 4 THEN 'Queens' WHEN 5 THEN 'Staten Island' ELSE 'NYC' END AS county FROM customer""")
def _(spark, sf):
    codes = F.array(*[F.lit(c) for c in ("36", "36005000", "36047000", "36061000", "36081000", "36085000", "36099000")])
    rows = b.table(spark, sf, "customer").withColumn("g", F.get(codes, (F.col("c_custkey") % 7).cast("int")))
    return rows.withColumn("county", fn.geoid_county("g"))


def priorities(spark):
    return spark.createDataFrame(
        [("1-URGENT", "Fire"), ("2-HIGH", "Police"), ("2-HIGH", "Police"), ("5-LOW", "Parks")], "type string, agency string"
    )


PRIORITY_SQL = "CASE o_orderpriority WHEN '1-URGENT' THEN 'Fire' WHEN '2-HIGH' THEN 'Police' WHEN '5-LOW' THEN 'Parks' ELSE 'Other' END"


@query("lookup_default", "o_orderkey:i agency:s", f"SELECT o_orderkey, {PRIORITY_SQL} AS agency FROM orders")
def _(spark, sf):
    return op.lookup_default(b.table(spark, sf, "orders"), "o_orderpriority", priorities(spark), "agency", "Other", "type")


@query("season_of", "o_orderkey:i yr:i season:s season_order:i period:s", """
  SELECT o_orderkey, year(o_orderdate) AS yr, s.name AS season, s.ord AS season_order, year(o_orderdate)::VARCHAR || ' ' || s.name AS period
  FROM orders JOIN (VALUES (12,'Winter',1),(1,'Winter',1),(2,'Winter',1),(3,'Spring',2),(4,'Spring',2),(5,'Spring',2),(6,'Summer',3),
    (7,'Summer',3),(8,'Summer',3),(9,'Fall',4),(10,'Fall',4),(11,'Fall',4)) s(m, name, ord) ON month(o_orderdate) = s.m""")
def _(spark, sf):
    return b.table(spark, sf, "orders").withColumns(fn.season_of("o_orderdate"))


@query("rename_case", "O_ORDERKEY:i O_ORDERSTATUS:s",
       'SELECT o_orderkey AS "O_ORDERKEY", o_orderstatus AS "O_ORDERSTATUS" FROM orders')
def _(spark, sf):
    return op.rename_case(b.table(spark, sf, "orders"), "upper")


@query("stamp_refresh", "c_custkey:i mart_refreshed_at:t",
       "SELECT c_custkey, TIMESTAMP '2024-06-01 08:30:00' AS mart_refreshed_at FROM customer")
def _(spark, sf):
    return op.stamp_refresh(b.table(spark, sf, "customer"), "2024-06-01 08:30:00")


# -- filters -----------------------------------------------------------------------------


@query("closed_requests", "l_orderkey:i l_linenumber:i closed_at:t", f"SELECT * FROM ({MINUTES}) WHERE closed_at > created_at")
def _(spark, sf):
    return op.closed_requests(minute_requests(spark, sf))


@query("date_range", "o_orderkey:i o_orderdate:t",
       "SELECT * FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-06-01'")
def _(spark, sf):
    return op.date_range(b.table(spark, sf, "orders"), "o_orderdate", "01/02/1997", "1998-06-01", default_start="1997-01-01")


@query("in_set", "o_orderkey:i", "SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def _(spark, sf):
    return op.in_set(b.table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "5-LOW"])


@query("not_in_set", "o_orderkey:i status:s", """
  SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders WHERE nullif(o_orderstatus, 'P') NOT IN ('O', '')""")
def _(spark, sf):
    rows = b.table(spark, sf, "orders").withColumn("status", fn.nullif("o_orderstatus", "P"))
    return op.not_in_set(rows, "status", ["O", ""])


@query("search_reference", "p_partkey:i", "SELECT p_partkey FROM part WHERE contains(lower(p_name), 'ing') OR contains(lower(p_type), 'ing')")
def _(spark, sf):
    return op.search_reference(b.table(spark, sf, "part"), " ING ", "p_name", "p_type")


# -- joins -------------------------------------------------------------------------------


@query("matched_fact", "unique_key:s tract_geoid:s", b.ctes(b.requests_sql(), b.DEMOGRAPHICS_SQL) + """
  SELECT * FROM requests WHERE tract_geoid IN (SELECT tract_geoid FROM dim WHERE median_household_income IS NOT NULL)""")
def _(spark, sf):
    return op.matched_fact(b.requests(spark, sf), b.known_dim(spark, sf))


@query("enrich_dim", "unique_key:s income_quintile:i pct_below_poverty:d", b.fact_ctes() + "SELECT * FROM fact JOIN dim USING (tract_geoid)")
def _(spark, sf):
    return op.enrich_dim(b.fact(spark, sf), b.dim(spark, sf).select("tract_geoid", "income_quintile", "pct_below_poverty"))


@query("join_baseline", "tract_geoid:s complaint_type:s request_month:t p90_hours:d city_p90:d",
       b.splits_ctes() + "SELECT * FROM stats JOIN baseline USING (complaint_type, request_month)")
def _(spark, sf):
    stats = marts.tract_stats(b.fact(spark, sf))
    return op.join_baseline(stats, marts.city_baseline(stats), marts.BASELINE_KEYS)


@query("enrich_neighborhood", "c_custkey:i neighborhood:s", """
  SELECT c_custkey, coalesce(n, c_nationkey::VARCHAR) AS neighborhood FROM customer LEFT JOIN (
    SELECT c_nationkey AS k, max(c_mktsegment) AS n FROM customer WHERE c_nationkey % 4 <> 0 AND c_mktsegment <> 'MACHINERY' GROUP BY ALL)
  ON k = c_nationkey""")
def _(spark, sf):
    rows = b.table(spark, sf, "customer").withColumn("tract_geoid", F.col("c_nationkey").cast("string"))
    return op.enrich_neighborhood(rows.withColumn("county", fn.geoid_county("tract_geoid")), crosswalk(spark, sf))


@query("align_aggregates", "l_suppkey:i volume:i q1:d q5:d", """
  SELECT l_suppkey, count(*) AS volume, avg(l_quantity) FILTER (l_discount < 0.01) AS q1, avg(l_quantity) FILTER (l_discount > 0.09) AS q5
  FROM lineitem GROUP BY ALL HAVING q1 IS NOT NULL AND q5 IS NOT NULL""")
def _(spark, sf):
    lines = b.table(spark, sf, "lineitem")
    parts = [
        lines.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("volume")),
        lines.filter("l_discount < 0.01").groupBy("l_suppkey").agg(F.avg("l_quantity").alias("q1")),
        lines.filter("l_discount > 0.09").groupBy("l_suppkey").agg(F.avg("l_quantity").alias("q5")),
    ]
    return op.align_aggregates(parts, "l_suppkey", ["q1", "q5"])


@query("reindex_spine", "month:t n:i total:d", """
  SELECT m AS month, coalesce(n, 0) AS n, total FROM
    (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders)
  LEFT JOIN (SELECT date_trunc('month', o_orderdate) AS k, count(*) AS n, sum(o_totalprice) AS total FROM orders
             WHERE month(o_orderdate) % 3 <> 0 GROUP BY ALL) ON k = m""")
def _(spark, sf):
    orders = b.table(spark, sf, "orders")
    first, last = orders.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    spine = sources.month_spine(spark, first.date(), last.date())
    series = (
        orders.filter(F.month("o_orderdate") % 3 != 0)
        .groupBy(fn.month_of("o_orderdate").alias("month"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))
    )
    return op.reindex_spine(series, spine, "month", {"n": 0})


@query("categorize_types", "complaint_type:s category:s agency:s is_known:b", """
  SELECT complaint_type, CASE WHEN k < 6 THEN 'Known' ELSE 'Other / Uncategorized' END AS category,
         CASE WHEN k < 6 THEN 'Agency' || k ELSE 'Various' END AS agency, k < 6 AS is_known
  FROM (SELECT DISTINCT p_brand AS complaint_type, replace(p_brand, 'Brand#', '')::INTEGER AS k FROM part)""")
def _(spark, sf):
    reference = spark.createDataFrame(
        [(f"Brand#{k}", "Known", f"Our text {k}", f"Agency{k}") for k in range(6)],
        "complaint_type string, category string, description string, agency string",
    )
    types = b.table(spark, sf, "part").select(F.col("p_brand").alias("complaint_type")).distinct()
    return op.categorize_types(types, reference)


@query("insert_if_absent", "o_custkey:i", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def _(spark, sf):
    keys = b.table(spark, sf, "orders").select("o_custkey", "o_orderstatus")
    return op.insert_if_absent(keys.filter("o_orderstatus = 'F'"), keys, "o_custkey")


# -- points in polygons ------------------------------------------------------------------


def grid_boundaries(spark, sf):
    """One rectangle per supplier on a grid 40 wide; every 7th has a hole."""
    key = F.col("s_suppkey")
    x0, y0 = (key % 40) * 0.005, F.floor(key / 40) * 0.004

    def ring(dx0, dy0, dx1, dy1):
        corners = [(dx0, dy0), (dx1, dy0), (dx1, dy1), (dx0, dy1), (dx0, dy0)]
        return F.array(*[F.struct((x0 + dx).alias("x"), (y0 + dy).alias("y")) for dx, dy in corners])

    outer, hole = ring(0.0, 0.0, 0.005, 0.004), ring(0.001, 0.001, 0.002, 0.003)
    return b.table(spark, sf, "supplier").select(
        key.cast("string").alias("tract_geoid"),
        key.alias("ord"),
        F.when(key % 7 == 0, F.array(outer, hole)).otherwise(F.array(outer)).alias("rings"),
    )


def line_points(spark, sf):
    return b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_returnflag") != "R", F.col("l_discount") + F.col("l_quantity") / 500).alias("longitude"),
        (F.col("l_tax") + F.col("l_linenumber") / 1000).alias("latitude"),
    )


# Settled per place: an outer join on ranges alone repeats unmatched rows in DuckDB.
PLACES_SQL = """
  s AS (SELECT s_suppkey, (s_suppkey % 40) * 0.005::DOUBLE AS x0, floor(s_suppkey / 40) * 0.004::DOUBLE AS y0 FROM supplier),
  m AS (SELECT x, y, min(s_suppkey) AS s_suppkey FROM (SELECT DISTINCT x, y FROM p WHERE x IS NOT NULL) JOIN s
    ON x > x0 AND x < x0 + 0.005::DOUBLE AND y > y0 AND y < y0 + 0.004::DOUBLE
    AND NOT (s_suppkey % 7 = 0 AND x >= x0 + 0.001::DOUBLE AND x <= x0 + 0.002::DOUBLE
             AND y >= y0 + 0.001::DOUBLE AND y <= y0 + 0.003::DOUBLE) GROUP BY x, y)"""
POLYGONS_SQL = f"""
  WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag <> 'R' THEN l_discount + l_quantity / 500 END AS x,
                    l_tax + l_linenumber / 1000 AS y FROM lineitem), {PLACES_SQL}
  SELECT l_orderkey, l_linenumber, l_partkey, s_suppkey::VARCHAR AS tract_geoid FROM p LEFT JOIN m USING (x, y)"""


@query("point_in_polygon_join", "l_orderkey:i l_linenumber:i l_partkey:i tract_geoid:s", POLYGONS_SQL)
def _(spark, sf):
    return op.point_in_polygon_join(line_points(spark, sf), grid_boundaries(spark, sf))


# Every tract twice, under one order: the lowest id counts, however the join is done.
@query("point_in_polygon_join_shuffled", "l_orderkey:i l_linenumber:i l_partkey:i tract_geoid:s", POLYGONS_SQL)
def _(spark, sf):
    shapes = grid_boundaries(spark, sf).withColumn("ord", F.lit(0).cast("long"))
    twice = shapes.withColumn("tract_geoid", F.concat(F.lit("z"), "tract_geoid")).unionByName(shapes)
    return op.point_in_polygon_join(line_points(spark, sf), twice)
