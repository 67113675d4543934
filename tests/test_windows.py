import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fairwait.operators import dedup_latest, ntile_bucket, top_n_per_group

QUIET = dict(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def expected_ntile(values, n, nulls_last=True):
    order = sorted(range(len(values)), key=lambda i: (values[i] is None, values[i] or 0, i))
    q, r = divmod(len(order), n)
    bucket, at = {}, 0
    for b in range(n):
        for _ in range(q + (b < r)):
            bucket[order[at]] = b + 1
            at += 1
    return bucket


@settings(**QUIET)
@given(values=st.lists(st.one_of(st.none(), st.integers(-3, 3)), min_size=1, max_size=30), n=st.integers(1, 7))
@pytest.mark.parametrize("ranges", [None, 1, 9])
def test_ntile_both_ways(spark, values, n, ranges):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int")
    got = ntile_bucket(df, "v", n, ["id"], ranges=ranges)
    found = {r["id"]: r["bucket"] for r in got.collect()}
    assert found == expected_ntile(values, n)
    sizes = [list(found.values()).count(b) for b in range(1, n + 1)]
    assert max(sizes) - min(sizes) <= 1


def test_null_policy(spark):
    df = spark.createDataFrame([(1, 10), (2, None), (3, 20), (4, 30)], "id int, v int")
    last = {r["id"]: r["bucket"] for r in ntile_bucket(df, "v", 2, ["id"]).collect()}
    out = {r["id"]: r["bucket"] for r in ntile_bucket(df, "v", 2, ["id"], null_policy="exclude").collect()}
    assert last == {1: 1, 3: 1, 4: 2, 2: 2}
    assert out == {1: 1, 3: 1, 4: 2, 2: None}


@pytest.mark.parametrize("ranges", [None, 1, 9])
def test_ntile_within_groups(spark, ranges):
    data = [(None if i % 3 == 0 else f"g{i % 3}", i * 37 % 101) for i in range(60)]
    df = spark.createDataFrame(data, "g string, v int")
    got = ntile_bucket(df, "v", 4, ["v"], partition_by=["g"], ranges=ranges)
    assert got.columns == ["g", "v", "bucket"]
    found = {(r["g"], r["v"]): r["bucket"] for r in got.collect()}
    for group in (None, "g1", "g2"):
        values = [v for g, v in data if g == group]
        expected = expected_ntile(values, 4)
        assert {v: expected[i] for i, v in enumerate(values)} == {v: b for (g, v), b in found.items() if g == group}


def test_dedup_latest(spark, rows):
    data = [("k1", "2024-01-02", "old load", "x"), ("k1", "2024-01-03", "a", "y"), ("k2", None, "a", "p"),
            ("k2", None, "b", "q"), ("k3", "2024-01-01", "a", "m"), ("k3", None, "z", "n")]
    df = spark.createDataFrame(data, "k string, updated string, loaded string, v string")
    assert rows(dedup_latest(df, ["k"], ["updated", "loaded"], ["v"]), "k", "v") == [("k1", "y"), ("k2", "q"), ("k3", "m")]


def test_dedup_cuts_rows_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as v")
    plan = dedup_latest(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_top_n_per_group(spark, rows):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 3.0), ("a", "z", 3.0), ("b", "x", None)], "g string, t string, v double")
    assert rows(top_n_per_group(df, ["g"], "v", 2, ["t"]), "g", "t", "rn") == [("a", "y", 1), ("a", "z", 2), ("b", "x", 1)]
