"""Top-k products and nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairwait.llm import ann, norm_search

VECTORS = "vec_id bigint, embedding array<float>, rank string"


def vectors(spark, n=300, d=8, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.standard_normal(d) * rng.uniform(0.2, 3)).astype(float).tolist(), "x") for i in range(n)]
    same = rows[5][1]
    rows += [(n + i, same, "copy") for i in range(40)]  # one vector many times
    bad = [(900, None, "a"), (901, [float("nan")] * d, "b"), (902, [None] + [1.0] * (d - 1), "c"), (903, [float("inf")] * d, "d"),
           (904, [0.0] * d, "zero"), (None, [1.0] * d, "no id"), (0, rows[0][1], "again"), (905, [1.0, 2.0], "short"), (906, [], "empty")]
    return rows + bad, spark.createDataFrame(rows + bad, VECTORS).repartition(5)


def whole(df):
    v = F.transform("embedding", lambda x: F.floor(F.lit(64) * x.cast("double")).cast("double"))
    return df.filter(norm_search.finite(F.col("embedding"))).select("vec_id", v.alias("v"), "rank")


def usable(rows, d):
    out = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            out[i] = np.array([*np.float32(v).astype(float), *[0.0] * (d - len(v))])
    return out


@pytest.mark.parametrize("part,query", [(8192, 4096), (16, 7)])
def test_products_are_exact(spark, monkeypatch, part, query):
    monkeypatch.setattr(norm_search, "PART_ROWS", part)
    monkeypatch.setattr(norm_search, "QUERY_ROWS", query)
    monkeypatch.setattr(norm_search, "SEEDS", 24)
    rows, df = vectors(spark)
    got = norm_search.top_products(whole(df), F.col("vec_id") % 3 == 0, 7).collect()
    known = {i: np.floor(64 * v).astype(int) for i, v in usable(rows, 8).items()}
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {i for i in known if i % 3 == 0}
    for q, rest in found.items():
        every = sorted((-int(known[q] @ v), i) for i, v in known.items() if i != q)[:7]
        assert sorted(rest) == [(n + 1, i, -s) for n, (s, i) in enumerate(every)]


def test_products_beyond_doubles_and_few_rows(spark):
    big = [(1, [2.0**31, 1.0]), (2, [2.0**31 - 1, 3.0]), (3, [-(2.0**40), 2.0**33])]
    df = spark.createDataFrame(big, "vec_id bigint, v array<double>")
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in norm_search.top_products(df, F.lit(True), 5).collect()}
    assert len(got) == 6
    assert got[1, 2] == 2**31 * (2**31 - 1) + 3
    assert got[1, 3] == max(-(2**71) + 2**33, -(2**63))
    assert norm_search.top_products(df.filter("false"), F.lit(True), 5).count() == 0
    assert norm_search.top_products(df.limit(1), F.lit(True), 5).count() == 0


@pytest.mark.parametrize("shard", [4096, 60])
def test_nearest_finds_nearly_all(spark, monkeypatch, shard):
    monkeypatch.setattr(ann, "SHARD_ROWS", shard)
    monkeypatch.setattr(ann, "QUERY_ROWS", 50)
    rows, df = vectors(spark, 400)
    got = ann.nearest(df, F.col("vec_id") % 4 == 0, 5).collect()
    known = {i: v for i, v in usable(rows, 8).items() if v.any()}
    hits = total = 0
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {i for i in known if i % 4 == 0}
    for q, rest in found.items():
        cosine = {i: float(known[q] @ v / (np.linalg.norm(known[q]) * np.linalg.norm(v))) for i, v in known.items() if i != q}
        rest = sorted(rest)
        assert [n for n, _, _ in rest] == [1, 2, 3, 4, 5]
        assert all(abs(cosine[i] - s) < 1e-12 for _, i, s in rest)
        assert rest == sorted(rest, key=lambda x: (-x[2], x[1]))
        best = sorted(cosine.values(), reverse=True)[4]
        hits += sum(s >= best - 1e-12 for _, _, s in rest)
        total += 5
    assert hits / total >= 0.95
    copies = sorted([5, *range(400, 440)])
    asked = next(i for i in copies if i % 4 == 0)
    assert [i for _, i, _ in sorted(found[asked])] == [i for i in copies if i != asked][:5]  # ties to smaller ids


def test_nearest_with_few_or_no_rows(spark):
    df = spark.createDataFrame([(50, [1.0, 0.0], "q"), (1, [1.0, 1.0], "c")], VECTORS)
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in ann.nearest(df, F.col("vec_id") == 50, 5).collect()] == [(50, 1, 1)]
    assert ann.nearest(df.filter("false"), F.col("vec_id") == 50, 5).count() == 0


def test_every_vector_is_in_the_index(spark):
    rows, df = vectors(spark, 100)
    index = ann.build(df, 5).collect()
    known = {i: v for i, v in usable(rows, 8).items() if v.any()}
    assert {tuple(r["v"]) for r in index} >= {tuple(np.trim_zeros(v, "b")) for v in known.values() if len(np.trim_zeros(v, "b")) == 2}
    assert sum(len(r["vec_ids"]) for r in index) == len(known) - 41 + 6  # of 41 equal vectors six ids are listed
    assert all(max(r["edges"]) < len(index) for r in index)
