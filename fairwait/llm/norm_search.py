"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length into classes of a fixed ratio and classes into parts of bounded
size. The longest vectors give every query a first threshold: its k-th best product there. A part
is visited only by queries that its longest vector could lift over their threshold. Inside, the
threshold divided by both lengths is a bound on the cosine; by its height the part is cut by
length alone (a prefix of the vectors sorted by length) or by a coordinate as well (on the
query's largest coordinate, only an interval of direction values is feasible). What remains is
verified by exact products.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

RATIO = 1.05  # lengths in a class differ by less than this factor
PART_ROWS = 8192  # vectors in a part
QUERY_ROWS = 4096  # queries in a block
SEEDS = 1024  # longest vectors that give the first thresholds
COORDINATE_FROM = 0.6  # local cosine thresholds above this are cut by a coordinate too
_LONG = np.iinfo(np.int64)


def finite(vector: Column) -> Column:
    """Neither null nor holding a null, NaN or infinite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def padded(rows: list) -> np.ndarray:
    """Vectors as a matrix; shorter ones are filled with zeros."""
    width = max((len(r) for r in rows), default=0)
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Whole-number inner products, exact: in doubles while they cannot round, else in Python integers
    (held to the range of a long)."""
    width = min(q.shape[1], p.shape[1])
    q, p = q[:, :width], p[:, :width]
    if width == 0 or not q.size or not p.size:
        return np.zeros((len(q), len(p)), dtype=np.int64)
    if float(np.abs(q).max()) * float(np.abs(p).max()) * width < 2.0**53:
        return (q @ p.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in r] for r in m], dtype=object)
    return np.clip(whole(q).dot(whole(p).T), _LONG.min, _LONG.max).astype(np.int64)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= floor)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def visit(q: pd.DataFrame, p: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of one part for each query of one block."""
    p = p.sort_values("norm", ascending=False, kind="stable")
    ids, lengths, both = p["vec_id"].to_numpy(), p["norm"].to_numpy(), padded([*p["v"], *q["v"]])
    vectors, asked = both[: len(p)], both[len(p) :]
    with np.errstate(divide="ignore", invalid="ignore"):
        directions = np.where(lengths[:, None] > 0, vectors / lengths[:, None], 0.0)
    exact_in_doubles = not len(p) or float(np.abs(vectors).max(initial=0)) < 2.0**22
    found = []
    for own, length, floor, v in zip(q["vec_id"], q["norm"], q["floor"], asked):
        keep = len(ids)
        near = slice(0, keep)
        if floor > 0 and length > 0:
            # Length: the product is at most the product of the lengths.
            keep = int(np.searchsorted(-lengths, -(floor / length) * (1 - 1e-9), side="right"))
            near = slice(0, keep)
            cosine = floor / (length * lengths[0]) if keep else 0.0
            if keep > 64 and COORDINATE_FROM < cosine < 1:
                # Coordinate: with unit directions x and y, x.y >= c bounds every y_f to
                # x_f c -+ sqrt((1 - x_f^2)(1 - c^2)).
                f = int(np.argmax(np.abs(v)))
                x = min(max(v[f] / length, -1.0), 1.0)
                spread = float(np.sqrt((1 - x * x) * (1 - cosine * cosine))) + 1e-9
                column = directions[:keep, f]
                low = -1.0 if -x >= cosine else x * cosine - spread
                high = 1.0 if x >= cosine else x * cosine + spread
                near = np.flatnonzero((column >= low) & (column <= high))
        rows = vectors[near]
        if not len(rows):
            continue
        if exact_in_doubles and float(np.abs(v).max(initial=0)) * 2.0**22 * len(v) < 2.0**53:
            scores = (rows @ v).astype(np.int64)
        else:
            scores = products(v[None, :], rows)[0]
        kept = ids[near]
        other = kept != own
        if floor > -np.inf:
            other &= scores >= floor
        kept, scores = kept[other], scores[other]
        top = best(kept, scores, k)
        found.append(pd.DataFrame({"query_id": own, "vec_id": kept[top], "score": scores[top]}))
    if not found:
        return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="int64")})
    return pd.concat(found, ignore_index=True)


def top_products(vectors: DataFrame, queries: Column, k: int, id_col: str = "vec_id", vector_col: str = "v") -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows that ``queries`` picks, the k rows of largest inner
    product among all others, ties to the smaller id.

    ``vector_col`` holds whole numbers as doubles. Null vectors, vectors with null or non-finite
    components and rows without id take no part. Rows that repeat an id count once: the smallest vector stands
    for it. Vectors of unequal length are compared as if filled with zeros; products beyond a long are held to
    its range. Fewer than k other rows give fewer results.
    """
    rows = vectors.filter(F.col(id_col).isNotNull() & finite(F.col(vector_col)))
    rows = rows.withColumn("_q", F.coalesce(queries, F.lit(False))).select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), "_q"
    )
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"), F.max("_q").alias("is_query"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    level = F.when(F.col("norm") > 0, F.floor(F.log("norm") / np.log(RATIO))).otherwise(-1_000_000).cast("int")
    rows = stored(rows.withColumn("norm", norm).withColumn("level", level), "lengths")

    # Classes are few whatever the rows: the range of doubles holds about 30,000 of them.
    part = F.ceil(F.col("count") / PART_ROWS).cast("int").alias("parts")
    classes = rows.groupBy("level").agg(F.count("*").alias("count"), F.max("norm").alias("longest")).select("level", "longest", part)
    listed = classes.toPandas()
    level_of = np.repeat(listed["level"].to_numpy(dtype="int32"), listed["parts"].to_numpy(dtype="int64"))
    longest = np.repeat(listed["longest"].to_numpy(dtype="float64"), listed["parts"].to_numpy(dtype="int64"))
    part_of = np.concatenate([np.arange(n, dtype="int32") for n in listed["parts"]] or [np.zeros(0, "int32")])
    n_blocks = max(1, -(-rows.filter("is_query").count() // QUERY_ROWS))

    seeds = rows.orderBy(F.desc("norm"), "vec_id").select("vec_id", "v").limit(SEEDS).toPandas()
    ids, seed = seeds["vec_id"].to_numpy(dtype="int64"), padded(list(seeds["v"]))

    def route(batches):
        """Each query's threshold and the parts whose longest vector can reach it."""
        for q in batches:
            scores = products(padded(list(q["v"])), seed).astype(np.float64)
            scores[q["vec_id"].to_numpy()[:, None] == ids[None, :]] = -np.inf
            floor = np.full(len(q), -np.inf)
            if scores.shape[1] >= k:
                floor = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
            # a product beyond 2^53 is rounded here; the margin keeps the threshold below it
            floor = np.where(np.abs(floor) > 2.0**50, floor - np.abs(floor) * 1e-12, floor)
            need = np.where(floor > 0, floor * (1 - 1e-9), -1.0)
            reached = [np.flatnonzero(longest * n >= f) for n, f in zip(q["norm"], need)]
            yield q.assign(floor=floor, levels=[level_of[r] for r in reached], parts=[part_of[r] for r in reached])

    routed = (
        rows.filter("is_query")
        .select("vec_id", "v", "norm")
        .mapInPandas(route, "vec_id bigint, v array<double>, norm double, floor double, levels array<int>, parts array<int>")
        .withColumn("visit", F.explode(F.arrays_zip("levels", "parts")))
        .select("vec_id", "v", "norm", "floor", "visit.levels", "visit.parts")
        .toDF("vec_id", "v", "norm", "floor", "level", "part")
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int"))
    )
    parts = (
        rows.join(F.broadcast(classes), "level")
        .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
        .select("vec_id", "v", "norm", "level", "part", "block")
    )
    keys = ["level", "part", "block"]
    pairs = routed.groupBy(*keys).cogroup(parts.groupBy(*keys)).applyInPandas(
        lambda q, p: visit(q, p, k), "query_id bigint, vec_id bigint, score bigint"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
