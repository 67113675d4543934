"""Cleaning, filters, joins, text."""

import pytest
from pyspark.sql import functions as F

from fairwait import operators as op
from fairwait.lookups import AGENCY_OF_TYPE, agency_lookup
from fairwait.schemas import RAW_DEMOGRAPHICS, RAW_REQUESTS


def raw(spark, *records):
    from datetime import datetime

    data = []
    for r in records:
        r = {"ingestion_timestamp": datetime(2024, 1, 1), **r}
        data.append(tuple(r.get(n) for n in RAW_REQUESTS.names))
    return spark.createDataFrame(data, RAW_REQUESTS)


def test_normalize_requests(spark):
    df = op.normalize_requests(raw(
        spark,
        {"unique_key": "1", "created_date": "2024-01-01T10:00:00.000", "agency": " nypd ", "borough": "Queens ",
         "incident_zip": " 11101 ", "open_data_channel_type": " Phone", "latitude": 40.7},
        {"unique_key": None, "created_date": "2024-01-01T10:00:00.000"},
    ))
    assert len(df.columns) == 19 and dict(df.dtypes)["created_at"] == "timestamp_ntz"
    row, = df.collect()
    assert (row["agency_code"], row["borough"], row["incident_zip"], row["channel_type"]) == ("NYPD", "QUEENS", "11101", "Phone")
    assert row["closed_at"] is None and row["latitude"] == 40.7


def test_malformed_timestamp(spark):
    bad = raw(spark, {"unique_key": "1", "created_date": "yesterday"})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        op.normalize_requests(bad).collect()
    assert op.normalize_requests(bad, on_error="null").first()["created_at"] is None


def test_stage_keeps_the_latest_version(spark, rows):
    from datetime import datetime

    df = raw(
        spark,
        {"unique_key": "1", "resolution_action_updated_date": "2024-01-02T00:00:00", "status": "Open"},
        {"unique_key": "1", "resolution_action_updated_date": "2024-01-03T00:00:00", "status": "Closed"},
        {"unique_key": "2", "status": "Open"},
        {"unique_key": "2", "status": "Closed", "ingestion_timestamp": datetime(2024, 2, 1)},
        {"unique_key": "3", "resolution_action_updated_date": "2024-01-01T00:00:00", "status": "Pending"},
    )
    assert rows(op.stage_requests(df), "unique_key", "status") == [("1", "CLOSED"), ("2", "CLOSED"), ("3", "PENDING")]
    # Filtering versions first gives what filtering the latest ones gives.
    assert rows(op.stage_requests(df, since="2024-01-02"), "unique_key", "status") == [("1", "CLOSED")]


def test_demographics_round_and_sentinel(spark):
    data = [("1400000US36005000100", 2.7, -666666666.0, 3.5, 0.4, 1.0, 1.0, "36", "005", "000100", "005", 2022),
            (None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, "36", "005", "000200", "005", 2022)]
    df = op.null_sentinel(spark.createDataFrame(data, RAW_DEMOGRAPHICS), ["b01003_001e", "b19013_001e"])
    row, = op.normalize_demographics(df).collect()
    assert (row["tract_geoid"], row["fips_full"]) == ("36005000100", "36005000100")
    assert (row["median_household_income"], row["total_population"], row["population_below_poverty"]) == (3, None, 4)


def test_coerce_and_rename(spark):
    df = op.coerce_numeric(spark.createDataFrame([("1.5", "x"), ("", None)], "a string, b string"), ["a", "b"])
    assert [tuple(r) for r in df.collect()] == [(1.5, None), (None, None)]
    assert op.rename_case(df, "upper").columns == ["A", "B"]
    assert op.stamp_refresh(df, "2024-01-01").first()["mart_refreshed_at"].year == 2024


def test_sets_and_null(spark, rows):
    df = spark.createDataFrame([("A",), ("",), ("UNSPECIFIED",), (None,)], "b string")
    assert rows(op.not_in_set(df, "b", ["UNSPECIFIED", ""])) == [("A",)]
    assert rows(op.in_set(df, "b", ["A", ""])) == [("",), ("A",)]


def test_date_range_falls_back(spark, rows):
    df = spark.createDataFrame([("2020-01-01",), ("2020-06-01",), ("2021-01-01",)], "m string").select(F.col("m").cast("timestamp_ntz").alias("m"))
    assert op.date_range(df, "m", "2020-06-01", "2021-01-01").count() == 2
    assert op.date_range(df, "m", "June 2020", "2020-06-01").count() == 2  # default start 2020-01-01
    assert op.date_range(df, "m", "2020-06-01", "'; drop").count() == 2  # default end today
    assert op.date_range(df, "m", None, None, default_end="2020-01-31").count() == 1


def test_search(spark, rows):
    df = spark.createDataFrame([("NOISE", "Loud music"), ("HEAT", "No warm water"), ("X", None)], "complaint_type string, description string")
    assert rows(op.search_reference(df, " MUSIC "), "complaint_type") == [("NOISE",)]
    assert op.search_reference(df, "  ").count() == 3
    assert rows(op.search_reference(df, "x", text_col=None), "complaint_type") == [("X",)]
    assert op.search_reference(df, "50%").count() == 0


def test_agencies(spark, rows):
    assert len(AGENCY_OF_TYPE) == 79
    df = spark.createDataFrame([("NOISE",), ("UNHEARD OF",), (None,)], "complaint_type string")
    got = op.lookup_default(df, "complaint_type", agency_lookup(spark), "agency", "Other")
    assert rows(got) == [("NOISE", "NYPD"), ("UNHEARD OF", "Other"), (None, "Other")]


def test_categorize(spark, rows):
    reference = spark.createDataFrame([("NOISE", "Sound", "Loud", "NYPD")], "complaint_type string, category string, description string, agency string")
    types = spark.createDataFrame([("NOISE",), ("NEW",)], "complaint_type string")
    got = op.categorize_types(types, reference)
    assert rows(got, "complaint_type", "category", "agency", "is_known") == [("NEW", "Other / Uncategorized", "Various", False), ("NOISE", "Sound", "NYPD", True)]


def test_neighborhood_falls_back(spark, rows):
    df = spark.createDataFrame([("1", "Queens"), ("2", "Bronx")], "tract_geoid string, county string")
    crosswalk = spark.createDataFrame([("1", "Astoria")], "tract_geoid string, neighborhood string")
    assert rows(op.enrich_neighborhood(df, crosswalk), "tract_geoid", "neighborhood") == [("1", "Astoria"), ("2", "Bronx")]


def test_align_and_reindex(spark, rows):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, a int")
    b = spark.createDataFrame([("y", 3), ("z", 4)], "k string, b int")
    assert rows(op.align_aggregates([a, b], "k", ["a", "b"])) == [("y", 2, 3)]
    spine = spark.createDataFrame([("x",), ("w",)], "k string")
    assert rows(op.reindex_spine(a, spine, "k", {"a": 0})) == [("w", 0), ("x", 1)]


def test_insert_if_absent_counts(spark):
    target = spark.createDataFrame([("h1", "done")], "hash string, status string")
    new = spark.createDataFrame([("h1", "pending"), ("h2", "pending"), ("h2", "pending")], "hash string, status string")
    assert op.insert_if_absent(target, new, "hash").count() == 1


def test_series_text(spark, rows):
    df = spark.createDataFrame([(1, "2024-02-01", 1.005), (1, "2024-01-01", 0.5), (5, "2024-01-01", 2.0)], "q int, m string, v double")
    got = op.series_text(df.withColumn("m", F.col("m").cast("timestamp_ntz")), ["q"], "m", "v")
    assert rows(got) == [(1, "2024-01=0.50, 2024-02=1.01"), (5, "2024-01=2.00")]


def test_fingerprint_ignores_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "a int, b string")

    def mark(df):
        return op.result_fingerprint({"t": df}).first()["fingerprint"]

    assert mark(a) == mark(a.orderBy(F.desc("a")).repartition(3))
    assert mark(a) != mark(a.distinct()) != mark(a.withColumn("a", F.lit(1)))
    assert len(mark(a.filter("false"))) == 32
    # The place of a NULL and the names of the columns count.
    pair = "a string, b string"
    assert mark(spark.createDataFrame([("x", None)], pair)) != mark(spark.createDataFrame([(None, "x")], pair))
    assert mark(a) != mark(a.withColumnRenamed("a", "c")) and mark(a) == mark(a.select("b", "a"))


def test_one_row_per_key_is_the_same_in_every_run(spark, rows):
    types = spark.createDataFrame([("NOISE",)], "complaint_type string")
    known = [("NOISE", "b", "x", "2"), ("NOISE", "b", "a", "3"), ("NOISE", "a", "z", "1")]
    schema = "complaint_type string, category string, description string, agency string"
    target = spark.createDataFrame([], "k int, v int")
    for data in (known, known[::-1]):
        got = op.categorize_types(types, spark.createDataFrame(data, schema).repartition(3))
        assert rows(got) == [("NOISE", "b", "x", "2", True)]
    for data in ([(1, 5), (1, 7)], [(1, 7), (1, 5)]):
        assert rows(op.insert_if_absent(target, spark.createDataFrame(data, "k int, v int"), "k")) == [(1, 7)]


def test_pct_of_keeps_fractions(spark, rows):
    from fairwait.functions import pct_of

    df = spark.createDataFrame([(2.5, 10.0), (1.0, 0.0)], "a double, b double")
    assert [r[0] if r[0] is None else float(r[0]) for r in df.select(pct_of("a", "b")).collect()] == [25.0, None]
