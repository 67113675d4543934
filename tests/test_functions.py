from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fairwait import functions as fn


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


@pytest.mark.parametrize(
    "created, closed, hours",
    [
        ("2024-01-01 10:59:00", "2024-01-01 11:01:00", 1),  # one boundary in two minutes
        ("2024-01-01 10:00:00", "2024-01-01 10:59:59", 0),  # same clock hour
        ("2024-02-28 23:30:00", "2024-03-01 00:10:00", 25),  # leap day
        ("2024-01-01 10:00:00", "2024-01-01 10:00:00", None),  # not after
        ("2024-01-02 10:00:00", "2024-01-01 10:00:00", None),
        ("2024-01-01 10:00:00", None, None),
        ("2024-03-10 01:30:00", "2024-03-10 03:30:00", 2),  # no summer time in the data
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_response_hours(spark, created, closed, hours, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = one(spark, h=fn.response_hours(fn.ntz(created), fn.ntz(closed) if closed else F.lit(None).cast("timestamp_ntz")))
        assert got["h"] == hours
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_resolution_status(spark):
    at = [fn.ntz("2024-01-01 10:00:00"), fn.ntz("2024-01-01 12:00:00"), F.lit(None).cast("timestamp_ntz")]
    got = one(
        spark,
        a=fn.resolution_status(at[0], at[1], F.lit("open")),
        b=fn.resolution_status(at[0], at[2], F.lit("Open")),
        c=fn.resolution_status(at[1], at[0], F.lit("CLOSED")),
        d=fn.resolution_status(at[0], at[2], F.lit(None).cast("string")),
    )
    assert tuple(got) == ("closed", "open", "other", "other")


def test_month_is_timestamp_without_zone(spark):
    df = spark.range(1).select(fn.month_of(fn.ntz("2024-12-31 23:59:59.999999")).alias("m"))
    assert dict(df.dtypes)["m"] == "timestamp_ntz"
    assert df.first()["m"] == datetime(2024, 12, 1)


def test_december_is_winter_of_its_own_year(spark):
    got = one(spark, **fn.season_of(fn.ntz("2023-12-05 00:00:00")))
    assert tuple(got) == (2023, "Winter", 1, "2023 Winter")
    seasons = [one(spark, **fn.season_of(fn.ntz(f"2024-{m:02d}-01")))["season"] for m in (2, 3, 6, 9, 11)]
    assert seasons == ["Winter", "Spring", "Summer", "Fall", "Fall"]


def test_rounding_does_not_see_binary_noise(spark):
    got = one(spark, a=fn.round_exact(F.lit(1.005), 2), b=fn.round_exact(F.lit(2.675), 2), c=fn.round_exact(F.lit(-1.005), 2))
    assert tuple(got) == (1.01, 2.68, -1.01)


def test_ratios_guard_zero(spark):
    got = one(
        spark,
        a=fn.safe_ratio(F.lit(1), F.lit(0), 2),
        b=fn.safe_ratio(F.lit(0), F.lit(3), 2),
        c=fn.safe_ratio(F.lit(10), F.lit(3), 4),
        d=fn.pct_of(F.lit(1), F.lit(0)),
        e=fn.pct_of(F.lit(1), F.lit(800)).cast("double"),
    )
    assert tuple(got) == (None, 0.0, 3.3333, None, 0.13)


def test_geoid_county(spark):
    ids = ["36005000100", "36085000100", "36099000100", "3608", None]
    df = spark.createDataFrame([(i,) for i in ids], "g string").select(fn.geoid_county("g").alias("c"))
    assert [r["c"] for r in df.collect()] == ["Bronx", "Staten Island", "NYC", "3608", None]
