import json
import math
import random

import pytest
from pyspark.sql import functions as F

from fairwait.operators import point_in_polygon_join, spatial
from fairwait.operators.spatial import grid_polygons
from fairwait.schemas import BOUNDARIES
from fairwait.sources import read_boundaries

POINTS = "id int, longitude double, latitude double, tract_geoid string"


def square(x, y, w=1.0):
    return [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]


def shapes(spark, polygons):
    data = [(name, i, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]) for i, (name, rings) in enumerate(polygons)]
    return spark.createDataFrame(data, BOUNDARIES)


def assign(spark, polygons, points):
    df = spark.createDataFrame([(i, x, y, "stale") for i, (x, y) in enumerate(points)], POINTS)
    got = point_in_polygon_join(df, shapes(spark, polygons))
    assert set(got.columns) == {"id", "longitude", "latitude", "tract_geoid"}
    found = {r["id"]: r["tract_geoid"] for r in got.collect()}
    assert len(found) == len(points)
    return [found[i] for i in range(len(points))]


def test_cases(spark):
    polygons = [
        ("a", [square(0, 0)]),
        ("b", [square(1, 0)]),  # shares an edge with a
        ("hole", [square(0, 2, 3), square(1, 3)]),
        ("parts", [square(5, 0), square(7, 0)]),
        ("over", [square(0.5, 0.5, 0.4)]),  # inside a, comes later
    ]
    points = [
        (0.5, 0.25), (1.5, 0.5), (1.0, 0.5), (0.0, 0.0), (0.5, 1.0), (0.7, 0.7), (9.0, 9.0), (None, 1.0), (1.0, None),
        (0.5, 2.5), (1.5, 3.5), (1.0, 3.5), (2.5, 4.5), (5.5, 0.5), (6.5, 0.5), (7.5, 0.5), (0.9999999, 0.5),
    ]
    expected = [
        "a", "b", None, None, None, "a", None, None, None,
        "hole", None, None, "hole", "parts", None, "parts", "a",
    ]
    assert assign(spark, polygons, points) == expected


def inside(rings, x, y):
    """Textbook even-odd test with division, boundary excluded by construction."""
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


@pytest.mark.parametrize("edges", [0, 2, 100])
def test_against_brute_force(spark, monkeypatch, edges):
    monkeypatch.setattr(spatial, "MAX_EDGES", edges)
    rng = random.Random(7)

    def blob(cx, cy):
        n = rng.randint(3, 12)
        ring = [(cx + rng.uniform(0.2, 0.9) * math.cos(2 * math.pi * k / n), cy + rng.uniform(0.2, 0.9) * math.sin(2 * math.pi * k / n)) for k in range(n)]
        return ring + ring[:1]

    polygons = [(f"t{i}", [blob(rng.uniform(-2, 2), rng.uniform(-2, 2))]) for i in range(12)]
    polygons.append(("wide", [[(1000 * x, 1000 * y) for x, y in blob(0.0, 0.0)]]))
    points = [(rng.uniform(-3, 3), rng.uniform(-3, 3)) for _ in range(400)]
    points += [(rng.uniform(-900, 900), rng.uniform(-900, 900)) for _ in range(100)]
    points += points[:100]  # many requests from one place
    expected = [next((name for name, rings in polygons if inside(rings, x, y)), None) for x, y in points]
    assert any(expected) and not all(expected)
    assert assign(spark, polygons, points) == expected
    # The same whether Spark broadcasts or shuffles.
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert assign(spark, polygons, points) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_grid_of_tracts_takes_each_inner_point_once(spark):
    polygons = [(f"{x}-{y}", [square(x, y)]) for x in range(4) for y in range(4)]
    points = [(x + 0.25, y + 0.75) for x in range(4) for y in range(4)]
    assert assign(spark, polygons, points) == [n for n, _ in polygons]


def feature(name, kind, coordinates):
    return {"type": "Feature", "properties": {"tract_geoid": name}, "geometry": {"type": kind, "coordinates": coordinates}}


@pytest.mark.parametrize("lines", [False, True])
def test_read_geojson(spark, tmp_path, lines):
    ring = [list(p) for p in square(0, 0)]
    far = [list(p) for p in square(4, 4)]
    features = [feature(" 360 ", "Polygon", [ring]), feature("361", "MultiPolygon", [[ring], [far]])]
    path = tmp_path / "tracts.geojson"
    if lines:
        path.write_text("\n".join(json.dumps(f) for f in features))
    else:
        path.write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    got = read_boundaries(spark, str(path), lines=lines).orderBy("ord").collect()
    assert [r["tract_geoid"] for r in got] == ["360", "361"]
    assert [len(r["rings"]) for r in got] == [1, 2]
    assert tuple(got[1]["rings"][1][0]) == (4.0, 4.0)


def test_equal_ord_takes_the_lowest_id(spark):
    df = spark.createDataFrame([(1, 0.5, 0.5, None)], POINTS)
    both = shapes(spark, [("b", [square(0, 0)]), ("a", [square(0, 0)])]).withColumn("ord", F.lit(0).cast("long"))
    for given in (both, both.orderBy("tract_geoid"), both.orderBy(F.desc("tract_geoid"))):
        assert point_in_polygon_join(df, given).first()["tract_geoid"] == "a"


def ring_of(n, x, y, radius):
    at = [2 * math.pi * k / n for k in range(n)]
    ring = [(x + radius * math.cos(a) * (1 + (k % 2) / 50), y + radius * math.sin(a) * (1 + (k % 2) / 50)) for k, a in enumerate(at)]
    return ring + ring[:1]


def test_a_country_takes_no_more_squares_than_a_block(spark):
    polygons = [("country", [ring_of(1000, 10, 50, 20.0)]), ("block", [ring_of(1000, 10, 50, 0.0005)]), ("square", [square(-700, 3, 512)])]
    squares = {r["tract_geoid"]: r for r in grid_polygons(shapes(spark, polygons)).groupBy("tract_geoid").agg(
        F.count("*").alias("n"), F.min("level").alias("least"), F.max("level").alias("most"), F.count_if("full").alias("full"), F.max(F.size("edges")).alias("edges")).collect()}
    assert squares["square"]["n"] <= 4 and squares["country"]["full"] > 10
    # The number follows the edges, not the size, but for where the powers of two happen to lie.
    assert all(squares[n]["n"] < 3 * 1000 and squares[n]["most"] - squares[n]["least"] <= 2 * spatial.ROUNDS for n in ("country", "block"))
    assert 0.25 < squares["country"]["n"] / squares["block"]["n"] < 4
    assert squares["country"]["most"] - squares["block"]["most"] in (14, 16)
    points = [(10.0, 50.0), (10.0004, 50.0), (10.001, 50.0), (29.9, 50.0), (31.0, 50.0), (-500.0, 100.0), (1e200, 1.0)]
    assert assign(spark, polygons[1:] + polygons[:1], points) == ["block", "block", "country", "country", None, "square", None]


def test_polygons_without_an_inside_and_no_polygons(spark):
    flat = [("line", [[(0, 0), (1, 0), (0, 0)]]), ("point", [[(0, 0), (0, 0)]])]
    assert assign(spark, flat, [(0.5, 0.0), (0.0, 0.0), (0.5, 0.5)]) == [None] * 3
    assert assign(spark, [], [(0.5, 0.0)]) == [None]


def test_order_is_unique_over_files(spark, tmp_path):
    ring = [list(p) for p in square(0, 0)]
    for name in ("one", "two"):
        features = [feature(f"{name}-{i}", "Polygon", [ring]) for i in range(3)]
        (tmp_path / f"{name}.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    got = read_boundaries(spark, str(tmp_path)).orderBy("ord").collect()
    assert [r["ord"] for r in got] == list(range(6))
    assert [r["tract_geoid"] for r in got] == [f"{n}-{i}" for n in ("one", "two") for i in range(3)]


def test_a_feature_collection_is_read_once(spark, tmp_path):
    """The JSON reader for whole documents went through each many times; a byte order mark and broken files are still passed over."""
    shape = '{"type":"Feature","properties":{"tract_geoid":" %s "},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}}'
    texts = ["﻿" + '{"features": [\n%s,\n%s]}' % (shape % "a", shape % "b"), '{"features":[%s]}' % (shape % "c"), "no json", '{"features":null}']
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.json").write_text(text, encoding="utf-8")
    got = read_boundaries(spark, str(tmp_path))
    assert [(r["tract_geoid"], r["ord"], len(r["rings"][0])) for r in got.orderBy("ord").collect()] == [("a", 0, 4), ("b", 1, 4), ("c", 2, 4)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Scan text" in plan and "Scan json" not in plan
