"""Assign points to the polygon that contains them.

Every polygon is cut into squares of its own quadtree. The first squares are about as large as the polygon; those that more than a few
edges come near are cut into sixteen, a few times over. So the number of squares follows the edges of a polygon and not its area, and a
country takes no more rows than a city block. A square no edge comes near lies wholly inside
or outside, which is settled once; for the others the row keeps the edges that can decide a point of it. Each distinct
place meets the polygons of its square on each level that is in use through one equality join, and an even-odd count of edges crossed to its right settles
containment, so holes and multi-part polygons need no special case. Points on an edge are
not inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

# A square that more edges come near is cut, at most so many times. Its side is 2 to the power of its level, which a cut
# lowers by two; powers of two make squares that touch without gap or overlap.
MAX_EDGES = 8
ROUNDS = 4


def polygon_edges(boundaries: DataFrame) -> DataFrame:
    """(tract_geoid, ord, edges, bounding box), edges over all rings of all parts, each from
    its lower to its upper end."""

    def edge(p: Column, q: Column) -> Column:
        rises = p["y"] <= q["y"]
        ends = {
            "x1": F.when(rises, p["x"]).otherwise(q["x"]),
            "y1": F.least(p["y"], q["y"]),
            "x2": F.when(rises, q["x"]).otherwise(p["x"]),
            "y2": F.greatest(p["y"], q["y"]),
            "xlo": F.least(p["x"], q["x"]),
            "xhi": F.greatest(p["x"], q["x"]),
        }
        return F.struct(*[c.alias(n) for n, c in ends.items()])

    def ring_edges(ring: Column) -> Column:
        return F.transform(ring, lambda p, i: edge(p, F.get(ring, (i + 1) % F.size(ring))))

    edges = boundaries.select(
        "tract_geoid", "ord", F.flatten(F.transform("rings", ring_edges)).alias("edges")
    )
    return edges.withColumns(
        {
            "xmin": F.array_min(F.transform("edges", lambda e: e["xlo"])),
            "xmax": F.array_max(F.transform("edges", lambda e: e["xhi"])),
            "ymin": F.array_min(F.transform("edges", lambda e: e["y1"])),
            "ymax": F.array_max(F.transform("edges", lambda e: e["y2"])),
        }
    )


def grid_polygons(boundaries: DataFrame) -> DataFrame:
    """(level, cx, cy, full, near, edges, ...) per polygon and square it reaches into. ``full`` marks squares wholly inside; the others
    hold the edges level with the square and not wholly to its left, of which ``near`` come near it. Polygons without
    an inside have no square."""
    shapes = polygon_edges(boundaries).filter("xmax > xmin AND ymax > ymin")
    widest = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    # Far from zero, numbers of squares have to stay whole.
    farthest = F.greatest(*[F.abs(F.col(c)) for c in ("xmin", "xmax", "ymin", "ymax")])
    level = (F.ceil(F.greatest(F.log2(widest), F.log2(farthest) - 40) / 2) * 2).cast("int")

    def squares(lo: str, hi: str) -> Column:
        return F.sequence(F.floor(F.col(lo) / _side()), F.floor(F.col(hi) / _side()))

    cut = (
        shapes.withColumn("level", level)
        .withColumn("cx", F.explode(squares("xmin", "xmax")))
        .withColumn("cy", F.explode(squares("ymin", "ymax")))
    )
    cut = _settled(cut.withColumn("full", F.lit(False)))
    # Polygons of a few edges, as in a plain grid, have no square to cut, and the plan is short.
    most = shapes.agg(F.max(F.size("edges"))).first()[0] or 0
    for _ in range(ROUNDS if most > MAX_EDGES else 0):
        cut = _settled(_split(cut))
    return cut


def _side() -> Column:
    return F.pow(F.lit(2.0), F.col("level"))


def _split(squares: DataFrame) -> DataFrame:
    """Squares with too many edges as the sixteen that they consist of, the others as they are."""
    part = lambda i, j: F.struct((F.col("level") - 2).alias("level"), (F.col("cx") * 4 + i).alias("cx"), (F.col("cy") * 4 + j).alias("cy"))
    parts = F.when(F.col("near") > MAX_EDGES, F.array(*[part(i, j) for i in range(4) for j in range(4)]))
    kept = [c for c in squares.columns if c not in ("level", "cx", "cy")]
    return squares.select(*kept, F.explode(F.coalesce(parts, F.array(F.struct("level", "cx", "cy")))).alias("_at")).select(*kept, "_at.*")


def _settled(squares: DataFrame) -> DataFrame:
    """Squares that a polygon reaches into, with the edges that matter there and whether it is full."""
    slack = _side() * 1e-6
    left, right = F.col("cx") * _side() - slack, (F.col("cx") + 1) * _side() + slack
    low, high = F.col("cy") * _side() - slack, (F.col("cy") + 1) * _side() + slack
    bounded = squares.withColumns({"_left": left, "_right": right, "_low": low, "_high": high})

    def matters(e: Column) -> Column:
        return (e["y2"] >= F.col("_low")) & (e["y1"] <= F.col("_high")) & (e["xhi"] >= F.col("_left"))

    middle = (F.col("cx") + 0.5) * _side(), (F.col("cy") + 0.5) * _side()
    cut = (
        bounded.withColumn("edges", F.filter("edges", matters))
        .withColumn("near", F.size(F.filter("edges", lambda e: e["xlo"] <= F.col("_right"))))
        .withColumn("full", F.col("full") | ((F.col("near") == 0) & contains(F.col("edges"), *middle)))
    )
    nothing = F.filter("edges", lambda e: F.lit(False))
    return (
        cut.filter("near > 0 OR full")
        .withColumn("edges", F.when(F.col("full"), nothing).otherwise(F.col("edges")))
        .drop("_left", "_right", "_low", "_high")
    )


def contains(edges: Column, x: Column, y: Column) -> Column:
    """Even-odd test of a point against a list of rising edges, boundary excluded. No
    division, so level edges need no guard."""

    def side(e: Column) -> Column:
        return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])

    def crossed(e: Column) -> Column:
        return (y < e["y2"]) & (y >= e["y1"]) & (x <= e["xhi"]) & (side(e) > 0)

    def touched(e: Column) -> Column:
        level = (y <= e["y2"]) & (y >= e["y1"])
        return level & (x <= e["xhi"]) & (x >= e["xlo"]) & (side(e) == 0)

    return (F.size(F.filter(edges, crossed)) % 2 == 1) & ~F.exists(edges, touched)


def _inside(p, x: Column, y: Column) -> Column:
    in_box = x.between(p["xmin"], p["xmax"]) & y.between(p["ymin"], p["ymax"])
    return p["full"] | (in_box & contains(p["edges"], x, y))


def point_in_polygon_join(
    points: DataFrame,
    boundaries: DataFrame,
    x: str = "longitude",
    y: str = "latitude",
    out: str = "tract_geoid",
) -> DataFrame:
    """All points with the id of the polygon strictly containing them in ``out``.

    NULL without coordinates or without a polygon; where several match, the lowest ``ord`` wins and
    then the lowest id. Each distinct place is settled once, however many points share it. The squares are stored in the scratch
    folder; Spark broadcasts them or the places if it finds them small, and else shuffles both; the result is the same.
    """
    points = points.drop(out)
    spark, path = points.sparkSession, scratch_path(points.sparkSession, "squares")
    squares = grid_polygons(boundaries).drop("near")
    squares.write.parquet(path)
    squares = spark.read.schema(squares.schema).parquet(path)
    # Every other power of two from the smallest square to the largest at most.
    levels = [r["level"] for r in squares.select("level").distinct().collect()]
    px, py = F.col("_x"), F.col("_y")
    places = points.select(F.col(x).alias("_x"), F.col(y).alias("_y")).dropna().distinct()
    at = lambda n: F.struct(F.lit(n).alias("level"), F.floor(px / 2.0**n).alias("cx"), F.floor(py / 2.0**n).alias("cy"))
    asked = places.select("_x", "_y", F.explode(F.array(*[at(n) for n in sorted(levels) or [0]])).alias("_at")).select("_x", "_y", "_at.*")
    polygon = {c: F.col(c) for c in ("full", "xmin", "xmax", "ymin", "ymax", "edges")}
    found = (
        asked.join(squares, ["level", "cx", "cy"])
        .filter(_inside(polygon, px, py))
        .groupBy("_x", "_y")
        .agg(F.min(F.struct("ord", "tract_geoid"))["tract_geoid"].alias(out))
    )
    # Points without coordinates match nothing; spread them instead of hashing all to one task.
    missing = F.col(x).isNull() | F.col(y).isNull()
    spread = F.when(missing, F.spark_partition_id() + 1).otherwise(F.lit(0))
    same = (F.col(x) == px) & (F.col(y) == py) & (F.col("_spread") == F.col("_zero"))
    return (
        points.withColumn("_spread", spread)
        .join(found.withColumn("_zero", F.lit(0)), same, "left")
        .drop("_x", "_y", "_spread", "_zero")
    )
