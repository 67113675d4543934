"""Marts, reports, checks and whole runs on small hand-made frames."""

import json
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairwait import operators as op
from fairwait.lookups import BOROUGHS
from fairwait.operators import quality as qc
from fairwait.plans import marts, reports, runs
from fairwait.sinks.tables import partitions
from fairwait.plans.suites import SUITES, run_checkpoint
from fairwait.schemas import RAW_DEMOGRAPHICS, RAW_REQUESTS
from tests.test_spatial import shapes, square

FACT = "tract_geoid string, complaint_type string, request_month timestamp_ntz, borough string, response_time_hours long"
JAN, FEB, DEC = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2023, 12, 1)


def dim(spark, *quintiles):
    data = [(t, q, 1000 * (q or 0), 10.0, 100, 5, 6) for t, q in quintiles]
    return spark.createDataFrame(
        data,
        "tract_geoid string, income_quintile int, median_household_income int, pct_below_poverty double, "
        "total_population int, pop_black int, pop_hispanic int",
    )


def test_suppressed_income_joins_the_top_quintile(spark):
    data = [(f"1400000US{i}", float(i) if i < 9 else None, 0.0 if i == 1 else 100.0, 12.0, 1.0, 1.0, 1.0, "36", "005", str(i), "005", 2022) for i in range(1, 11)]
    stg = op.normalize_demographics(spark.createDataFrame(data, RAW_DEMOGRAPHICS))
    got = {r["tract_geoid"]: r for r in marts.dim_tract(stg).collect()}
    assert (got["9"]["income_quintile"], got["10"]["income_quintile"]) == (5, 5)
    assert got["1"]["income_quintile"] == 1 and got["1"]["pct_below_poverty"] is None
    assert float(got["2"]["pct_below_poverty"]) == 12.0
    left_out = {r["tract_geoid"]: r["income_quintile"] for r in marts.dim_tract(stg, null_policy="exclude").collect()}
    assert left_out["9"] is None and left_out["8"] == 5


def test_equity_score(spark):
    hours = {"t1": [1, 2, 3, 4, 10], "t2": [5, 5, 5], "t3": [2]}
    data = [(t, "NOISE", JAN, "BRONX", h) for t, hs in hours.items() for h in hs]
    got = {r["tract_geoid"]: r for r in marts.equity_score(spark.createDataFrame(data, FACT), dim(spark, ("t1", 1), ("t2", 3), ("t3", 5))).collect()}
    p90 = {t: np.percentile(hs, 90) for t, hs in hours.items()}
    city = np.median(list(p90.values()))
    assert got["t1"]["p90_hours"] == pytest.approx(7.6) and got["t1"]["request_count"] == 5
    for t, row in got.items():
        assert row["city_p90"] == pytest.approx(city)
        assert row["equity_score"] == pytest.approx(round(p90[t] / city, 4))
    assert len(got["t1"]) == 17 and "mart_refreshed_at" in got["t1"]


def test_two_boroughs_count_twice_and_are_reported(spark):
    data = [("t1", "A", JAN, "BRONX", 1), ("t1", "A", JAN, "QUEENS", 9), ("t2", "A", JAN, "BRONX", 5)]
    splits = marts.equity_score(spark.createDataFrame(data, FACT), dim(spark, ("t1", 1), ("t2", 5)))
    assert splits.count() == 3
    check = qc.check_unique_combination(["tract_geoid", "complaint_type", "request_month"])
    row, = op.run_checks(splits, [check]).collect()
    assert (row["n_failed"], row["passed"]) == (2, False)


def test_zero_baseline_gives_no_score(spark):
    data = [("t1", "A", JAN, "BRONX", 0), ("t2", "A", JAN, "BRONX", 0), ("t2", "B", JAN, "BRONX", 0), ("t1", "B", JAN, "BRONX", 4)]
    rows = marts.equity_score(spark.createDataFrame(data, FACT), dim(spark, ("t1", 1), ("t2", 5))).collect()
    found = {(r["tract_geoid"], r["complaint_type"]): r["equity_score"] for r in rows}
    assert found == {("t1", "A"): None, ("t2", "A"): None, ("t2", "B"): 0.0, ("t1", "B"): 2.0}


def test_summary_and_gap_floors(spark):
    data = []
    for tract, n, wait in (("p1", 30, 10), ("p2", 29, 99), ("r1", 31, 4), ("r2", 30, 6)):
        data += [(tract, "NOISE", JAN, "B", wait)] * n
    data += [("p1", "HEAT", JAN, "B", 5)] * 40
    fact = spark.createDataFrame(data, FACT)
    summary = marts.quintile_summary(fact, dim(spark, ("p1", 1), ("p2", 1), ("r1", 5), ("r2", 5)))
    found = {(r["complaint_type"], r["income_quintile"]): r for r in summary.collect()}
    assert (found["NOISE", 1]["n_tracts"], found["NOISE", 1]["n_complaints"]) == (1, 30)  # p2 lacks one request
    assert (found["NOISE", 5]["n_tracts"], found["NOISE", 5]["median_tract_p90_hours"]) == (2, 5.0)
    assert marts.gap_by_type(summary).count() == 0
    row, = marts.gap_by_type(summary, 30).collect()  # HEAT has no richest quintile
    assert (row["complaint_type"], row["q1_over_q5_gap"], row["q5_n_complaints"]) == ("NOISE", 2.0, 61)
    assert marts.gap_by_type(summary, 31).count() == 0


def test_pooled_trend_drops_unknowns(spark, rows):
    data = [("t1", "A", JAN, "B", 1), ("t1", "A", JAN, "B", None), ("t1", "A", None, "B", 7), ("t2", "A", JAN, "B", 3), ("t9", "A", JAN, "B", 3)]
    got = marts.pooled_trend(spark.createDataFrame(data, FACT), dim(spark, ("t1", 1), ("t2", None)))
    assert rows(got) == [(JAN, 1, 1, 1.0, 1.0)]


def staged(spark, data):
    return spark.createDataFrame(data, "unique_key string, created_at timestamp_ntz, closed_at timestamp_ntz, updated_at timestamp_ntz, status string, tract_geoid string")


def test_intermediate_merges_late_closings(spark, rows):
    t = datetime(2024, 1, 1, 10)
    day = timedelta(days=1)
    old = staged(spark, [("1", t, None, t, "OPEN", "t1"), ("2", t, t, t + 5 * day, "CLOSED", "t1"), ("3", t, None, None, "OPEN", "t1")])
    first = marts.build_intermediate(old)
    assert rows(first, "unique_key", "response_time_hours", "resolution_status") == [("1", None, "open"), ("2", None, "other"), ("3", None, "open")]
    new = staged(spark, [("1", t, t + day, t + 6 * day, "CLOSED", "t1"), ("2", t, t + day, t + 2 * day, "CLOSED", "t1"), ("4", t, None, t + 3 * day, "OPEN", "t1")])
    second = marts.build_intermediate(new, first)
    # The update of 2 is more than 48 hours before the newest one known, so it is not seen.
    assert rows(second, "unique_key", "response_time_hours", "resolution_status") == [
        ("1", 24, "closed"), ("2", None, "other"), ("3", None, "open"), ("4", None, "open")]


def test_facts_need_a_known_tract(spark, rows):
    t = datetime(2024, 1, 31, 23, 30)
    later = t + timedelta(minutes=40)
    rows_ = staged(spark, [("1", t, later, t, "CLOSED", "t1"), ("2", t, later, t, "CLOSED", "t9"), ("3", t, later, t, "CLOSED", None), ("4", t, t, t, "CLOSED", "t1")])
    got = marts.request_facts(rows_, dim(spark, ("t1", 1), ("t1", 1)))
    assert rows(got, "unique_key", "request_month", "response_time_hours") == [("1", JAN, 1)]


# -- reports -----------------------------------------------------------------------------

SPLITS = (
    "tract_geoid string, complaint_type string, request_month timestamp_ntz, borough string, income_quintile int, "
    "median_household_income int, request_count long, p50_hours double, p90_hours double, city_p90 double, equity_score double"
)


def splits(spark, *cells):
    data = [("36005" + t, c, m, b, q, 1000 * (q or 0), n, s, s * 2, 2.0, s) for t, c, m, b, q, n, s in cells]
    return spark.createDataFrame(data, SPLITS)


@pytest.fixture(scope="module")
def cells(spark):
    return splits(
        spark,
        ("1", "NOISE", DEC, "BRONX", 1, 10, 2.0), ("1", "NOISE", JAN, "BRONX", 1, 11, 4.0), ("2", "NOISE", JAN, "QUEENS", 1, 9, 99.0),
        ("3", "NOISE", JAN, "QUEENS", 5, 20, 1.0), ("3", "HEAT", FEB, "UNSPECIFIED", 5, 12, 0.5), ("1", "HEAT", FEB, "", 1, 12, 1.5),
        ("4", "ODD", FEB, None, 3, 600, 3.0), ("4", "ODD", JAN, "BRONX", 3, 600, 5.0),
    ).cache()


def test_row_floor_of_reports(cells, rows):
    assert rows(reports.quintile_rollup(cells, "NOISE")) == [(1, 3.0, 6.0, 21), (5, 1.0, 2.0, 20)]
    ratio, = reports.quintile_ratio(reports.quintile_rollup(cells, "NOISE")).collect()
    assert ratio["p90_ratio"] == 3.0
    assert reports.quintile_ratio(reports.quintile_rollup(cells, "ODD")).count() == 0


def test_map(cells, rows):
    by_type = reports.map_rollup(cells, "type", BOROUGHS, "NOISE")
    assert rows(by_type, "tract_geoid", "equity_score", "complaint_count", "county") == [("360051", 3.0, 21, "Bronx"), ("360053", 1.0, 20, "Bronx")]
    assert rows(reports.map_rollup(cells, "quintile", ["BRONX"], quintiles=[1, 3]), "tract_geoid", "income_quintile") == [("360051", 1), ("360054", 3)]
    with pytest.raises(ValueError):
        reports.map_rollup(cells, "agency", [])


def test_borough_matrix_has_all_rows(spark, cells):
    spine = spark.createDataFrame([(b,) for b in BOROUGHS], "borough string")
    scores = reports.borough_quintile_score(cells)
    got = {r["borough"]: tuple(r)[1:] for r in reports.pivot_matrix(scores, "borough", "income_quintile", "avg_equity_score", [1, 3, 5], "Q", spine).collect()}
    assert set(got) == set(BOROUGHS)
    assert got["BRONX"] == (3.0, 5.0, None) and got["BROOKLYN"] == (None, None, None)


def test_slowest_types(cells, rows):
    assert rows(reports.slowest_types(cells), "borough", "complaint_type", "rn") == [("BRONX", "ODD", 1)]
    assert rows(reports.slowest_types(cells, n=1, floor=5), "borough", "complaint_type") == [("BRONX", "ODD"), ("QUEENS", "NOISE")]


def test_trend_by_season(spark, cells, rows):
    trend = reports.score_trend(cells)
    assert rows(trend, "request_month", "income_quintile", "avg_equity_score") == [(DEC, 1, 2.0), (JAN, 1, 4.0), (JAN, 5, 1.0), (FEB, 1, 1.5), (FEB, 5, 0.5)]
    seasons = reports.season_trend(trend)
    assert rows(seasons, "period", "income_quintile", "avg_equity_score", "total_requests") == [
        ("2023 Winter", 1, 2.0, 10), ("2024 Winter", 1, 2.75, 23), ("2024 Winter", 5, 0.75, 32)]
    volumes = reports.volume_compare(seasons, "period")
    assert rows(volumes) == [("2023 Winter", 10, 0, 10), ("2024 Winter", 23, 32, -9)]


def test_agencies_need_both_ends(spark, cells, rows):
    lookup = spark.createDataFrame([("NOISE", "NYPD"), ("ODD", "Parks")], "complaint_type string, agency string")
    assert rows(reports.agency_rollup(cells, lookup)) == [("NYPD", 41, 3.0, 1.0, 2.0), ("Other", 24, 1.5, 0.5, 1.0)]
    assert [r["agency"] for r in reports.agency_rollup(cells, lookup, ["Other"]).collect()] == ["Other"]


def test_trend_line(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 5.0), (4, 9.0), (None, 1.0), (7, None)], "median_household_income int, p90_hours double")
    line = reports.income_trend_line(df, n=4).orderBy("i").collect()
    assert [(r["x"], pytest.approx(r["y"])) for r in line] == [(1.0, 3.0), (2.0, 5.0), (3.0, 7.0), (4.0, 9.0)]
    assert reports.income_trend_line(df.limit(1)).count() == 0


def test_limit_comes_before_the_floor(spark):
    gap = spark.createDataFrame(
        [(f"T{i:02d}", 4999 if i < 3 else 5000, 1, 2.0, 1.0, float(20 - i)) for i in range(15)],
        "complaint_type string, q1_n_complaints long, q5_n_complaints long, q1_p90_hours double, q5_p90_hours double, q1_over_q5_gap double",
    )
    lookup = spark.createDataFrame([("T05", "X")], "complaint_type string, agency string")
    got = reports.ranked_gaps(gap, lookup, "gap").collect()
    assert len(got) == 7 and {r["agency"] for r in got if r["complaint_type"] != "T05"} == {"Various"}
    assert reports.ranked_gaps(gap, lookup, "gap", floor=0).count() == 10
    kpi = reports.headline_kpis(gap, ["T01", "T02"]).first()
    assert (kpi["top_type"], kpi["top_gap"], kpi["cluster_gap"], kpi["cluster_q1_complaints"]) == ("T00", 20.0, 18.5, 9998)


def test_freshness(spark):
    now = datetime(2024, 1, 3, 12)
    df = spark.createDataFrame([(datetime(2024, 1, 2, 11),)], "ts timestamp_ntz")

    def status(hours):
        return reports.freshness_check(df, "ts", now=datetime(2024, 1, 2, 11) + timedelta(hours=hours)).first()["status"]

    assert [status(h) for h in (24, 25, 25.5, 49, 49.5)] == ["pass", "pass", "warn", "warn", "error"]
    assert reports.freshness_check(df.filter("false"), "ts", now=now).first()["status"] == "error"
    assert reports.last_refresh(df, "ts").first()[0] == "2024-01-02 11:00"
    assert reports.last_refresh(df.filter("false"), "ts").first()[0] == "Unknown"


# -- checks ------------------------------------------------------------------------------


def test_checks(spark):
    df = spark.createDataFrame([(1, "A", 10.0), (1, "B", 30.0), (2, None, None), (None, "", 99.0)], "k int, s string, v double")
    checks = [
        qc.check_not_null("k"), qc.check_unique("k"), qc.check_unique_combination(["k", "s"]), qc.check_accepted_values("s", ["A", "B"]),
        qc.check_accepted_range("v", 0, 30), qc.check_between_mostly("v", 0, 30, 0.6), qc.check_between_mostly("v", lo=20),
        qc.check_not_in_set("s", [None, ""], 0.6), qc.check_not_in_set("s", [None, ""], 0.6, null_fails=True),
        qc.check_columns_present(["K", "missing"]), qc.check_column_type("v", "double"), qc.check_row_count(1, 3, severity="warn"),
        qc.check_percentile_order(["k", "v"]),
    ]
    got = [(r["check_name"], r["n_rows"], r["n_failed"], r["passed"]) for r in op.run_checks(df, checks).collect()]
    assert sorted(got) == sorted([
        ("not_null", 4, 1, False), ("unique", 4, 2, False), ("unique_combination", 4, 0, True), ("accepted_values", 4, 1, False),
        ("accepted_range", 4, 1, False), ("between_mostly", 4, 1, True), ("between_mostly", 4, 1, False), ("not_in_set", 4, 1, True),
        ("not_in_set", 4, 2, False), ("columns_present", 4, 1, False), ("column_type", 4, 0, True), ("row_count", 4, 1, False),
        ("percentile_order", 4, 0, True),
    ])


def test_value_checks_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id as k", "id as v").write.parquet(path)
    df = op.run_checks(spark.read.parquet(path), [qc.check_not_null("k"), qc.check_accepted_range("v", 0), qc.check_row_count(1)])
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert all(r["passed"] for r in df.collect())


def test_empty_table(spark):
    df = spark.createDataFrame([], "k int, s string")
    got = {r["check_name"]: r["passed"] for r in op.run_checks(df, [qc.check_not_null("k"), qc.check_unique("k"), qc.check_row_count(1)]).collect()}
    assert got == {"not_null": True, "unique": True, "row_count": False}


# -- whole runs --------------------------------------------------------------------------


def record(key, created, closed, updated, x, y, kind="Noise"):
    r = {"unique_key": key, "created_date": created, "closed_date": closed, "resolution_action_updated_date": updated,
         "complaint_type": kind, "borough": "Bronx", "status": "Closed" if closed else "Open", "longitude": x, "latitude": y,
         "ingestion_timestamp": datetime(2024, 1, 1)}
    return tuple(r.get(n) for n in RAW_REQUESTS.names)


NO_CHECKS: dict = {}


def test_from_landing_to_marts(spark, tmp_path, rows):
    tracts = shapes(spark, [("1", [square(0, 0)]), ("2", [square(1, 0)])])
    source = [
        record("a", "2024-01-01T10:00:00", None, "2024-01-01T10:00:00", 0.5, 0.5),
        record("b", "2024-01-01T10:30:00", "2024-01-01T12:10:00", "2024-01-02T00:00:00", 1.5, 0.5),
        record("c", "2024-01-05T10:00:00", "2024-01-05T11:00:00", "2024-01-05T11:00:00", None, 0.5),
    ]
    raw_path, landing, root = (str(tmp_path / n) for n in ("raw", "landing", "marts"))

    def load(data, day):
        df = spark.createDataFrame(data, RAW_REQUESTS)
        return runs.run_incremental(df, tracts, raw_path, landing, day, now=datetime(2024, 1, 3)).rows

    assert load(source[:2], "2024-01-03") == 2
    assert load(source[:1], "2024-01-04") == 1  # within the 48 hours before the newest update
    assert load([record("z", *["2023-01-01T00:00:00"] * 3, 0.5, 0.5)], "2024-01-04") == 0  # no news: no-op
    closed = record("a", "2024-01-01T10:00:00", "2024-01-05T10:00:00", "2024-01-05T10:00:00", 0.5, 0.5)
    assert load([closed, source[2]], "2024-01-05") == 2
    raw = spark.read.parquet(raw_path)
    assert rows(raw, "unique_key", "tract_geoid") == [("a", "1"), ("a", "1"), ("a", "1"), ("b", "2"), ("c", None)]

    demo = spark.createDataFrame(
        [("1400000US1", 10.0, 100.0, 5.0, 1.0, 1.0, 1.0, "36", "005", "1", "005", 2022), ("1400000US2", 90.0, 100.0, 5.0, 1.0, 1.0, 1.0, "36", "005", "2", "005", 2022)],
        RAW_DEMOGRAPHICS)
    tables = runs.build_marts(raw.filter("resolution_action_updated_date < '2024-01-03'"), demo, root, "day-1", 1, 1, suites=NO_CHECKS)
    assert rows(tables["request_facts"], "unique_key", "response_time_hours") == [("b", 2)]
    stamp = datetime(2024, 1, 6)
    tables = runs.build_marts(raw, demo, root, "day-2", 1, 1, suites=NO_CHECKS, refreshed_at=stamp)
    assert rows(tables["request_facts"], "unique_key", "response_time_hours") == [("a", 96), ("b", 2)]
    assert rows(tables["intermediate"], "unique_key", "resolution_status") == [("a", "closed"), ("b", "closed"), ("c", "closed")]
    assert tables["equity_splits"].count() == 2 and tables["trend_monthly"].count() == 2
    again = runs.build_marts(raw, demo, root, "day-2", 1, 1, suites=NO_CHECKS, refreshed_at=stamp)
    assert rows(again["equity_splits"]) == rows(tables["equity_splits"])


def test_reports_read_only_the_months_asked_for(spark, cells, tmp_path):
    from fairwait.sinks import materialise

    stored = materialise(cells, "equity_splits", "table", str(tmp_path), part_col="request_month")
    assert stored.schema == cells.schema
    df = reports.score_trend(op.date_range(stored, "request_month", "2024-01-01", "2024-01-31"))
    scan = next(line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(request_month" in scan and "p50_hours" not in scan.split("ReadSchema")[1]
    assert df.count() == 2


def test_backfill(spark, tmp_path, rows):
    data = [record(str(i), f"2024-{m:02d}-{d:02d}T23:59:59.900", None, None, 0.5, 0.5) for i, (m, d) in enumerate([(1, 31), (2, 1), (4, 30), (5, 1)])]
    df = spark.createDataFrame(data, RAW_REQUESTS)
    args = (df, shapes(spark, [("1", [square(0, 0)])]), str(tmp_path / "landing"), "2024-01-01", "2024-04-15")
    expected = [("2024-01-01", 1), ("2024-02-01", 1), ("2024-04-01", 1)]
    assert rows(runs.run_backfill(*args)) == expected
    assert rows(runs.run_backfill(*args)) == expected


def test_a_rerun_of_a_day_keeps_what_was_landed(spark, tmp_path, rows):
    tracts = shapes(spark, [("1", [square(0, 0)])])
    raw_path, landing = str(tmp_path / "raw"), str(tmp_path / "landing")
    days = ["2024-01-01", "2024-01-04", "2024-01-08", "2024-01-09"]
    df = spark.createDataFrame([record(d, *[f"{d}T10:00:00"] * 3, 0.5, 0.5) for d in days], RAW_REQUESTS)
    for _ in range(2):
        got = runs.run_incremental(df, tracts, raw_path, landing, "2024-01-10", now=datetime(2024, 1, 2))
        assert got.rows == 4
        assert rows(spark.read.parquet(landing), "unique_key") == rows(spark.read.parquet(raw_path), "unique_key") == [(d,) for d in days]
    late = runs.run_incremental(df, tracts, raw_path, landing, "2024-01-11")
    assert late.rows == 2 and late.watermark == datetime(2024, 1, 7, 10)


def test_a_later_rerun_of_the_first_day_fetches_no_less(spark, tmp_path, rows):
    tracts = shapes(spark, [("1", [square(0, 0)])])
    raw_path, landing = str(tmp_path / "raw"), str(tmp_path / "landing")
    df = spark.createDataFrame([record(d, *[f"2024-01-{d}T10:00:00"] * 3, 0.5, 0.5) for d in ("01", "02", "03", "04")], RAW_REQUESTS)
    for now in (datetime(2024, 1, 4), datetime(2024, 1, 5), datetime(2024, 1, 9)):
        got = runs.run_incremental(df, tracts, raw_path, landing, "2024-01-04", now=now)
        assert got.watermark == datetime(2024, 1, 2) and got.rows == 3
        assert rows(spark.read.parquet(landing), "unique_key") == rows(spark.read.parquet(raw_path), "unique_key") == [("02",), ("03",), ("04",)]


def test_daily_run_goes_on_from_a_backfill(spark, tmp_path, rows):
    tracts = shapes(spark, [("1", [square(0, 0)])])
    raw_path, landing = str(tmp_path / "raw"), str(tmp_path / "landing")
    df = spark.createDataFrame([record(str(m), *[f"2024-{m:02d}-10T10:00:00"] * 3, 0.5, 0.5) for m in range(1, 7)], RAW_REQUESTS)
    backfill = (df, tracts, str(tmp_path / "months"))
    assert rows(runs.run_backfill(*backfill, "2024-01-01", "2024-02-15", raw_path=raw_path)) == [("2024-01-01", 1), ("2024-02-01", 1)]
    for _ in range(2):  # a rerun replaces its own load
        assert rows(runs.run_backfill(*backfill, "2024-03-01", "2024-04-15", raw_path=raw_path)) == [("2024-03-01", 1), ("2024-04-01", 1)]
    got = runs.run_incremental(df, tracts, raw_path, landing, "2024-06-30")
    assert got.watermark == datetime(2024, 4, 8, 10) and got.rows == 3
    assert rows(spark.read.parquet(raw_path), "unique_key") == [("1",), ("2",), ("3",), ("4",), ("4",), ("5",), ("6",)]


def test_failed_checks_stop_the_marts(spark, tmp_path):
    demo = spark.createDataFrame([("1400000US1", 10.0, 100.0, 5.0, 1.0, 1.0, 1.0, "36", "005", "1", "005", 2022)], RAW_DEMOGRAPHICS)
    raw = spark.createDataFrame([record("a", "2024-01-01T10:00:00", "2024-01-02T10:00:00", "2024-01-02T10:00:00", 0.5, 0.5)], RAW_REQUESTS)
    with pytest.raises(runs.CheckFailed, match="dim_tract: row_count"):
        runs.build_marts(raw, demo, str(tmp_path / "m"), "1", 1, 1)
    assert spark.read.parquet(str(tmp_path / "m" / "checks")).filter("NOT passed").count() >= 1


def test_only_changed_months_are_redone(spark, tmp_path, rows):
    demo = spark.createDataFrame(
        [("1400000US1", 10.0, 100.0, 5.0, 1.0, 1.0, 1.0, "36", "005", "1", "005", 2022), ("1400000US2", 90.0, 100.0, 5.0, 1.0, 1.0, 1.0, "36", "005", "2", "005", 2022)],
        RAW_DEMOGRAPHICS)

    def raw(records):
        df = spark.createDataFrame(records, RAW_REQUESTS)
        return df.withColumn("tract_geoid", F.when(F.col("longitude") < 1, "1").otherwise("2"))

    def request(key, month, hours, updated, x=0.5):
        return record(key, f"2024-{month:02d}-01T00:00:00", f"2024-{month:02d}-01T{hours:02d}:00:00", updated, x, 0.5)

    old = [request(f"{m}{x}", m, 5, "2024-05-01T00:00:00", x) for m in (1, 2, 3) for x in (0.5, 1.5)] + [request("5", 5, 1, "2024-05-20T00:00:00")]
    new = [request("20.5", 2, 9, "2024-06-01T00:00:00"), request("30.5", 3, 7, "2024-06-01T00:00:00"), request("4", 4, 3, "2024-06-01T00:00:00")]
    first, second = datetime(2024, 5, 2), datetime(2024, 6, 2)
    root = str(tmp_path / "m")
    runs.build_marts(raw(old), demo, root, "1", 1, 1, suites=NO_CHECKS, refreshed_at=first)
    tables = runs.build_marts(raw(old + new), demo, root, "2", 1, 1, suites=NO_CHECKS, refreshed_at=second)
    whole = runs.build_marts(raw(old + new), demo, str(tmp_path / "w"), "1", 1, 1, suites=NO_CHECKS, refreshed_at=second)
    for name in ("request_facts", "tract_stats", "city_baseline", "quintile_summary", "gap_by_type", "trend_monthly"):
        assert rows(tables[name].select(sorted(tables[name].columns))) == rows(whole[name].select(sorted(whole[name].columns))), name
    stamps = {(r["request_month"].month, r["mart_refreshed_at"]) for r in tables["equity_splits"].collect()}
    assert stamps == {(1, first), (2, second), (3, second), (4, second), (5, second)}
    # January stays where the first run wrote it; the fifth month lies within the 48 hours.
    for name in ("intermediate", "request_facts", "hour_counts", "tract_stats", "equity_splits"):
        version, months = partitions(spark, f"{root}/{name}")
        assert version == 2 and {m[:7]: v for m, v in months.items()} == {"2024-01": 1, "2024-02": 2, "2024-03": 2, "2024-04": 2, "2024-05": 2}, name
    # The same run again writes nothing; a refresh replaces all.
    runs.build_marts(raw(old + new), demo, root, "2", 1, 1, suites=NO_CHECKS, refreshed_at=first)
    assert partitions(spark, f"{root}/hour_counts")[0] == 2
    shorter = raw(old).withColumn("closed_date", F.replace("closed_date", F.lit("T05"), F.lit("T02")))
    tables = runs.build_marts(shorter, demo, root, "2", 1, 1, suites=NO_CHECKS, refreshed_at=first, full_refresh=True)
    whole = runs.build_marts(shorter, demo, str(tmp_path / "x"), "1", 1, 1, suites=NO_CHECKS, refreshed_at=first)
    for name in ("intermediate", "request_facts", "equity_splits", "quintile_summary", "trend_monthly"):
        assert rows(tables[name].select(sorted(tables[name].columns))) == rows(whole[name].select(sorted(whole[name].columns))), name


def test_manifest_of_loads(spark, tmp_path):
    raw, path = spark.createDataFrame([record("a", "2024-01-01T10:00:00", None, "2024-01-02T00:00:00", 0.5, 0.5), record("b", "2024-01-01T10:00:00", None, None, 0.5, 0.5)], RAW_REQUESTS), str(tmp_path / "raw")
    updated = "resolution_action_updated_date"
    assert runs.manifest(spark, path) == {} and runs.newest_before(spark, path, "x") is None
    assert runs.load_raw(raw, path, "2024-01-02", updated) == 2
    assert runs.load_raw(raw.filter("unique_key = 'b'"), path, "2024-01-03", updated) == 1
    loads = runs.manifest(spark, path)
    one, two = loads["2024-01-02"], loads["2024-01-03"]
    assert (one.rows, one.oldest, one.newest, one.undated) == (2, "2024-01-02 00:00:00", "2024-01-02 00:00:00", 1)
    assert (two.rows, two.oldest, two.newest, two.undated) == (1, None, None, 1)
    assert runs.newest_before(spark, path, "2024-01-04") == datetime(2024, 1, 2)
    scanned = runs.scanned_manifest(spark.read.parquet(path), updated)
    assert {k: (x.rows, x.oldest, x.newest, x.undated) for k, x in scanned.items()} == {k: (x.rows, x.oldest, x.newest, x.undated) for k, x in loads.items()}
    runs.load_raw(raw, path, "2024-01-03", updated)  # a rerun gets a mark of its own
    assert runs.manifest(spark, path)["2024-01-03"].mark != two.mark
    assert runs.scanned_manifest(spark.read.parquet(path), updated)["2024-01-03"].mark != scanned["2024-01-03"].mark


def test_loads_of_older_rows_reach_the_marts(spark, tmp_path, rows):
    tracts = shapes(spark, [("1", [square(0, 0)])])
    raw_path, months = str(tmp_path / "raw"), str(tmp_path / "months")
    demo = spark.createDataFrame([("1400000US1", 10.0, 100.0, 5.0, 1.0, 1.0, 1.0, "36", "005", "1", "005", 2022)], RAW_DEMOGRAPHICS)

    def request(key, month, hours=5, updated=True):
        return record(key, f"2024-{month:02d}-01T00:00:00", f"2024-{month:02d}-01T{hours:02d}:00:00", f"2024-{month:02d}-02T00:00:00" if updated else None, 0.5, 0.5)

    def build(source, start, end, run):
        df = spark.createDataFrame(source, RAW_REQUESTS)
        runs.run_backfill(df, tracts, months, start, end, raw_path=raw_path)
        return runs.build_marts(spark.read.parquet(raw_path), demo, str(tmp_path / "m"), run, 1, 1, suites=NO_CHECKS)

    first = [request("5", 5), request("6", 6)]
    build(first, "2024-05-01", "2024-06-30", "1")
    older = [request("1", 1), request("2", 2, updated=False)]
    tables = build(older, "2024-01-01", "2024-02-28", "2")
    assert rows(tables["request_facts"], "unique_key") == [("1",), ("2",), ("5",), ("6",)]
    # The same months again, with one row more.
    tables = build([*older, request("1b", 1)], "2024-01-01", "2024-02-28", "3")
    whole = runs.build_marts(spark.read.parquet(raw_path), demo, str(tmp_path / "w"), "1", 1, 1, suites=NO_CHECKS)
    for name in ("intermediate", "request_facts", "tract_stats", "quintile_summary", "trend_monthly"):
        assert rows(tables[name].select(sorted(tables[name].columns))) == rows(whole[name].select(sorted(whole[name].columns))), name
    assert tables["request_facts"].count() == 5


def test_the_first_update_times_do_not_stage_older_loads_again(spark, tmp_path, rows, monkeypatch):
    """A table without any update time: a load with them is merged by itself, and its rows without one bring the other rows of their keys."""
    demo = spark.createDataFrame([("1400000US1", 10.0, 100.0, 5.0, 1.0, 1.0, 1.0, "36", "005", "1", "005", 2022)], RAW_DEMOGRAPHICS)
    staged, upsert = [], runs.upsert_table

    def seen(updates, *args, **more):
        staged.append((rows(updates, "unique_key"), more["stored"]))
        return upsert(updates, *args, **more)

    monkeypatch.setattr(runs, "upsert_table", seen)

    def build(name, day, stamp, data):
        path = f"{tmp_path}/raw-{name}"
        df = spark.createDataFrame(data, RAW_REQUESTS).withColumn("tract_geoid", F.lit("1")).withColumn("ingestion_timestamp", F.lit(stamp))
        runs.load_raw(df, path, day, "resolution_action_updated_date")
        return runs.build_marts(spark.read.parquet(path), demo, f"{tmp_path}/{name}", day, 1, 1, suites=NO_CHECKS, raw_path=path)

    def request(key, hours, updated=None):
        return record(key, "2024-01-01T00:00:00", f"2024-01-01T{hours:02d}:00:00", updated, 0.5, 0.5)

    early, later = datetime(2024, 1, 2), datetime(2024, 1, 3)
    build("m", "1", later, [request(k, 5) for k in ("a", "b", "c")])
    build("m", "2", early, [request("a", 7, "2024-01-02T00:00:00"), request("d", 8, "2024-01-02T00:00:00")])
    assert staged == [([("a",), ("b",), ("c",)], True), ([("a",), ("d",)], True)]
    # With a row without update time in the later load, b is staged with its other row, which was loaded later and stays.
    build("n", "1", later, [request(k, 5) for k in ("a", "b", "c")])
    tables = build("n", "2", early, [request("b", 9), request("c", 9, "2024-01-02T00:00:00")])
    assert staged[-1] == ([("b",), ("b",), ("c",)], False)
    whole = runs.build_marts(spark.read.parquet(f"{tmp_path}/raw-n"), demo, str(tmp_path / "w"), "1", 1, 1, suites=NO_CHECKS)
    for name in ("intermediate", "request_facts", "tract_stats"):
        assert rows(tables[name].select(sorted(tables[name].columns))) == rows(whole[name].select(sorted(whole[name].columns))), name
    assert rows(tables["request_facts"], "unique_key", "response_time_hours") == [("a", 5), ("b", 5), ("c", 9)]


def test_a_load_is_not_sorted_by_its_name(spark, tmp_path):
    schema = "unique_key string, resolution_action_updated_date string"
    load = lambda data: runs.load_raw(spark.createDataFrame(data, schema), f"{tmp_path}/raw", "2024-02-01", "resolution_action_updated_date")
    assert load([("1", "2024-01-05T00:00:00Z"), ("2", None), ("3", "2024-01-04T00:00:00")]) == 3
    done = spark._jsparkSession.sharedState().statusStore().executionsList()
    write = [p for p in (done.apply(i).physicalPlanDescription() for i in range(done.size())) if f"{tmp_path}/raw" in p and "WriteFiles" in p][-1]
    assert "Sort" not in write and write.split("(1)")[0].count("CollectMetrics") == 1
    found = runs.manifest(spark, f"{tmp_path}/raw")["2024-02-01"]
    assert (found.rows, found.oldest, found.newest, found.undated) == (3, "2024-01-04 00:00:00", "2024-01-05 00:00:00", 1)
    # A rerun that finds nothing leaves the rows, as before.
    assert load([]) == 0 and spark.read.parquet(f"{tmp_path}/raw").count() == 3
    assert runs.manifest(spark, f"{tmp_path}/raw")["2024-02-01"].rows == 0


def test_the_bound_of_a_daily_run_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([record("a", *["2024-01-01T10:00:00"] * 3, 0.5, 0.5)], RAW_REQUESTS).write.parquet(path)
    df = op.stage_requests(spark.read.parquet(path), since=datetime(2024, 1, 1))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(resolution_action_updated_date,2023-12-31)" in scan
    assert df.count() == 1


def test_checkpoint_stores_each_run(spark, tmp_path):
    path = str(tmp_path / "results")
    df = spark.createDataFrame([("NOISE", 1.5, 3.0, 2.0), ("HEAT", 30.0, 3.0, None)], "complaint_type string, q1_over_q5_gap double, q1_p90_hours double, q5_p90_hours double")
    for day in (1, 2):
        got = run_checkpoint(df, "gap_by_type", path, datetime(2024, 1, day))
    failed = {(r["check_name"], r["column_name"]) for r in got.collect() if not r["passed"]}
    assert failed == {("not_null", "q5_p90_hours"), ("accepted_range", "q1_over_q5_gap")}
    assert spark.read.parquet(path).count() == 2 * len(SUITES["gap_by_type"])


def test_suites_name_no_unknown_check():
    assert json.dumps(sorted(SUITES)) and all(SUITES.values())


def test_a_load_is_written_where_its_rows_are(spark, tmp_path):
    """One folder: shuffling its rows to one place first would bring all of them to one task."""
    schema = "unique_key string, resolution_action_updated_date string"
    rows = spark.createDataFrame([(str(i), f"2024-01-{i % 20 + 1:02d}T00:00:00") for i in range(90)], schema).repartition(3, "unique_key")
    assert runs.load_raw(rows, f"{tmp_path}/raw", "2024-02-01", "resolution_action_updated_date") == 90
    loaded = spark.read.parquet(f"{tmp_path}/raw")
    assert loaded.count() == 90 and loaded.select(F.input_file_name()).distinct().count() == 3


def test_refreshed_marts_land_the_joined_rows_once(spark, tmp_path, monkeypatch):
    from workload import QUERIES, bindings, q_runs

    day = datetime(1995, 3, 1)
    given = {
        "orders": [(i, 7, "O", 10.0, day, "1-URGENT") for i in range(4)],
        "lineitem": [(i % 4, i, 1 + i % 2, 1 + i // 4, 1.0, float(i), 0.1, 0.1, "R", "F", day + timedelta(days=i)) for i in range(12)],
        "supplier": [(1, "a", 1, 10.0), (2, "b", 2, 20.0)],
    }
    for name, data in given.items():
        spark.createDataFrame(data, bindings.SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    load, landed, built = runs.load_raw, [], []
    monkeypatch.setattr(runs, "load_raw", lambda df, *args: landed.append(df) or load(df, *args))
    monkeypatch.setattr(runs, "build_marts", lambda raw, *args, **more: built.append((raw, more)))
    shown = "mart string, k1 string, k2 string, at timestamp_ntz, v1 double, v2 double, v3 double"
    monkeypatch.setattr(q_runs, "shown_marts", lambda tables: spark.createDataFrame([], shown))
    QUERIES["build_marts_refreshed"](spark, str(tmp_path))
    joins = ["Join" in df._jdf.queryExecution().optimizedPlan().toString() for df in landed]
    assert joins == [True, False]
    # Each build reads a load of its own with all rows; the refresh those as they were given, the first others a day shorter.
    (first, _), (second, more) = built
    assert more["full_refresh"] and first.count() == second.count() == 12
    early = first.select("unique_key", F.col("closed_date").alias("early"))
    days = second.join(early, "unique_key").select(F.datediff(F.col("closed_date").cast("date"), F.col("early").cast("date")))
    assert [r[0] for r in days.collect()] == [1] * 12
