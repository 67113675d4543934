"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import met_by_sort, stored


def components(links: DataFrame, u: str, v: str) -> DataFrame:
    """(node, root) for every node with a link; root is the component's smallest node.

    Alternates two steps that hang every node's larger, then its smaller neighbours under its smallest one, until
    only stars are left. Each step is a grouping and a join; rounds grow with the logarithm of the size, and
    each round is written to the shared folder.
    """
    a, b = F.greatest(u, v).alias("u"), F.least(u, v).alias("v")
    edges = stored(links.filter(F.col(u) != F.col(v)).select(a, b).distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(met_by_sort(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(met_by_sort(lowest), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.union(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
        # Stars only: every node hangs under one other, and none hangs under a node that hangs itself.
        hangs = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
        if hangs.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR up > 0 AND down > 0").isEmpty():
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
