import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fairwait.operators import grouped_quantiles

VALUES = st.lists(st.one_of(st.none(), st.integers(0, 50)), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=VALUES, b=VALUES)
@pytest.mark.parametrize("wide", [False, True])
def test_equals_linear_interpolation(spark, wide, a, b):
    data = [("a", v) for v in a] + [("b", v) for v in b]
    df = spark.createDataFrame(data, "k string, v int")
    got = grouped_quantiles(
        df, ["k"], {f"p{p}": ("v", p / 100) for p in (0, 50, 75, 90, 100)}, {"n": ("count", "*"), "m": ("count", "v")},
        wide=wide,
    )
    for row in got.collect():
        group = a if row["k"] == "a" else b
        known = [v for v in group if v is not None]
        assert row["n"] == len(group) and row["m"] == len(known)
        quantiles = [row[f"p{p}"] for p in (0, 50, 75, 90, 100)]
        if not known:
            assert quantiles == [None] * 5
            continue
        assert quantiles == pytest.approx([np.percentile(known, p) for p in (0, 50, 75, 90, 100)])
        assert quantiles == sorted(quantiles)


@pytest.mark.parametrize("wide", [False, True])
def test_several_measures_and_carried_aggregates(spark, wide):
    data = [("a", 1.0, None, 10, 5), ("a", 2.0, 4.0, 20, 7), ("a", 4.0, 8.0, 30, None), ("b", None, 1.0, 1, 1)]
    df = spark.createDataFrame(data, "k string, x double, y double, n int, m int")
    got = grouped_quantiles(
        df, ["k"], {"x50": ("x", 0.5), "y50": ("y", 0.5), "x90": ("x", 0.9)},
        {"rows": ("count", "*"), "total": ("sum", "n"), "top": ("max", "m")}, wide=wide,
    )
    found = {r["k"]: r.asDict() for r in got.collect()}
    assert found["a"] == {"k": "a", "x50": 2.0, "y50": 6.0, "x90": pytest.approx(3.6), "rows": 3, "total": 60, "top": 7}
    assert found["b"] == {"k": "b", "x50": None, "y50": 1.0, "x90": None, "rows": 1, "total": 1, "top": 1}


@pytest.mark.parametrize("wide", [False, True])
def test_null_keys_form_a_group(spark, wide):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 5)], "k string, v int")
    got = {r["k"]: r["p"] for r in grouped_quantiles(df, ["k"], {"p": ("v", 0.5)}, wide=wide).collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_approximate_returns_an_element(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (10,)], "v int").withColumn("k", F.lit("a"))
    exact = grouped_quantiles(df, ["k"], {"p": ("v", 0.9)}).first()["p"]
    approx = grouped_quantiles(df, ["k"], {"p": ("v", 0.9)}, approx=True).first()["p"]
    assert exact == pytest.approx(7.6) and approx == 10.0


def test_a_hot_group_is_counted_before_it_meets(spark):
    """A third of all rows in one group: what is shuffled to the group's task is its
    distinct values."""
    df = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 1000).cast("string")).alias("k"),
        (F.col("id") % 97).cast("int").alias("v"),
    )
    out = grouped_quantiles(df, ["k"], {"p50": ("v", 0.5)}, {"n": ("count", "*")})
    hot = out.filter("k = 'hot'").first()
    assert (hot["n"], hot["p50"]) == (100_000, 48.0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_count(1)" in plan


def test_wide_looks_into_few_buckets(spark):
    """Doubles without repeats: exact, and only the buckets around the quantiles are read."""
    values = [((i * 7919) % 20011 - 5000) * 1.37 for i in range(20011)]
    df = spark.createDataFrame([("a" if i % 3 else "b", v) for i, v in enumerate(values)], "k string, v double")
    got = grouped_quantiles(df, ["k"], {"p10": ("v", 0.1), "p50": ("v", 0.5), "p99": ("v", 0.99)}, {"n": ("count", "*")}, wide=True)
    for row in got.collect():
        group = [v for i, v in enumerate(values) if ("a" if i % 3 else "b") == row["k"]]
        assert row["n"] == len(group)
        assert [row["p10"], row["p50"], row["p99"]] == pytest.approx(list(np.percentile(group, [10, 50, 99])))


@pytest.mark.parametrize("low,high", [(40.5, 40.9), (1.7e15, 1.7e15 + 2.6e12), (-74.3, -73.7), (-0.003, 0.003)])
def test_wide_form_over_a_narrow_band(spark, low, high):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.uniform(low, high, 3000), [0.0, 1e18, -1e18]])
    df = spark.createDataFrame([("a", float(v)) for v in values], "k string, v double")
    named = {f"p{p}": ("v", p / 100) for p in (0, 1, 50, 90, 100)}
    got = grouped_quantiles(df, ["k"], named, wide=True).first()
    for p in (0, 1, 50, 90, 100):
        assert got[f"p{p}"] == pytest.approx(np.percentile(values, p), rel=1e-12)


def test_no_part_of_a_narrow_band_holds_many_values(spark):
    from fairwait.operators import quantiles as q

    v = F.lit(40.5) + F.col("id") * 0.4 / 100_000
    hist = spark.range(100_000).select(v.alias("_v"))
    scale = F.log1p(F.abs("_v")) * q._FINENESS
    parts = hist.groupBy(F.floor((scale - F.floor(scale)) * q._PARTS)).count()
    assert parts.agg(F.max("count")).first()[0] <= 20


def test_stored_counts_merge_to_the_quantiles_of_all_rows(spark, rows):
    from fairwait.operators.quantiles import value_counts

    data = [(m, g, None if (m + i) % 11 == 0 else (i * i * m) % 37, f"t{i % 3}") for m in range(1, 5) for g in ("a", "b", None) for i in range(40)]
    df = spark.createDataFrame(data, "month int, g string, v int, t string")
    wanted = {"p9": ("v", 0.9), "p5": ("v", 0.5)}
    whole = grouped_quantiles(df, ["g", "t"], wanted, {"n": ("count", "*")})
    states = [value_counts(df.filter(f"month = {m}"), ["month", "g", "t"], "v") for m in range(1, 5)]
    merged = states[0].union(states[1]).union(states[2]).union(states[3])
    for wide in (False, True):
        assert rows(grouped_quantiles(merged, ["g", "t"], wanted, {"n": ("count", "*")}, weight="n_rows", wide=wide)) == rows(whole)
    # Merged states are states: fewer keys, or a later month that takes the place of an earlier one.
    again = value_counts(merged.filter("month <> 2").union(states[1]), ["g", "t"], "v", weight="n_rows")
    assert rows(grouped_quantiles(again, ["g", "t"], wanted, {"n": ("count", "*")}, weight="n_rows")) == rows(whole)
    with pytest.raises(ValueError):
        grouped_quantiles(merged, ["g"], wanted, weight="n_rows", approx=True)


def test_ranked_in_ranges(spark, rows):
    """The same figures, in ranges of the keys named, without a shuffle more than for ranking them."""
    data = [(f"m{i % 3}" if i % 7 else None, f"t{i % 5}", None if i % 11 == 0 else i * i % 13) for i in range(200)]
    df = spark.createDataFrame(data, "m string, t string, v int")
    how = (["t", "m"], {"p50": ("v", 0.5), "p90": ("v", 0.9)}, {"n": ("count", "*")})
    ranged = grouped_quantiles(df, *how, ranges=["m", "t"])
    assert rows(ranged) == rows(grouped_quantiles(df, *how))
    plan = ranged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange") == 2 and plan.count("rangepartitioning(m") == 1
    # A month lies in one place or next to itself.
    months = [[r["m"] for r in part] for part in ranged.rdd.glom().collect()]
    assert sum(len(set(part)) for part in months) <= 4 + len(months)
    for bad in ({"wide": True}, {"approx": True}):
        with pytest.raises(ValueError, match="ranges"):
            grouped_quantiles(df, *how, ranges=["m"], **bad)
    with pytest.raises(ValueError, match="no keys"):
        grouped_quantiles(df, *how, ranges=["x"])
