"""Approximate nearest neighbours by cosine on robust-pruned directed graphs.

Vectors are dealt at random to shards of bounded size. In each shard greedy searches propose neighbours for every
vector, and relaxed distance pruning keeps edges that point in different directions: a candidate goes if some
nearer, kept one is ``ALPHA`` times closer to it than the vector itself. Queries search every shard by a beam; the
shards' answers are scored on the original vectors in double precision and merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored
from .norm_search import finite, padded

SHARD_ROWS = 4096
QUERY_ROWS = 4096  # queries in a block
DEGREE = 24
BEAM = 48  # while building
SEARCH_BEAM = 128
ALPHA = 1.2
ENTRIES = 16  # random places where searches begin, beside the most central vector
_BATCH = 512
_EXPAND = 4  # vectors of the beam whose neighbours are looked at in a step


def unit(rows: np.ndarray) -> np.ndarray:
    return (rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(np.float32)


class Graph:
    """A directed graph over unit vectors; rows of ``edges`` end with -1 where there are fewer."""

    def __init__(self, x: np.ndarray, edges: np.ndarray | None = None):
        self.x, self.n = x, len(x)
        draw = np.random.default_rng(5)
        centre = int(np.argmax(x @ x.mean(0))) if self.n else 0
        self.entries = np.unique(np.r_[centre, draw.integers(0, max(self.n, 1), min(ENTRIES, self.n))])
        self.edges = edges if edges is not None else self._build(draw)

    def _build(self, draw) -> np.ndarray:
        degree = min(DEGREE, max(self.n - 1, 0))
        self.edges = np.full((self.n, DEGREE), -1, np.int32)
        if not degree:
            return self.edges
        # Random neighbours to begin with: steps around the circle of all vectors.
        steps = draw.integers(1, self.n, (self.n, degree)) if self.n > degree + 1 else np.tile(np.arange(1, degree + 1), (self.n, 1))
        self.edges[:, :degree] = (np.arange(self.n)[:, None] + steps) % self.n
        for alpha in (1.0, ALPHA):
            order = draw.permutation(self.n)
            for at in range(0, self.n, _BATCH):
                self._insert(order[at : at + _BATCH], alpha)
        return self.edges

    def _insert(self, nodes: np.ndarray, alpha: float) -> None:
        _, found, seen = self.search(self.x[nodes], BEAM, keep=True)
        pool = np.concatenate([found, seen, self.edges[nodes]], axis=1)
        self.edges[nodes] = self.prune(nodes, pool, alpha)
        # The other way round: every new edge may be wanted back.
        source = np.repeat(nodes, DEGREE)
        target = self.edges[nodes].ravel()
        source, target = source[target >= 0], target[target >= 0]
        near = np.einsum("ij,ij->i", self.x[source], self.x[target])
        order = np.lexsort((-near, target))
        source, target = source[order], target[order]
        first = np.r_[True, target[1:] != target[:-1]]
        place = np.arange(len(target)) - np.maximum.accumulate(np.where(first, np.arange(len(target)), 0))
        hubs = target[first]
        row = np.cumsum(first) - 1
        offered = np.full((len(hubs), min(int(place.max(initial=0)) + 1, 2 * DEGREE)), -1, np.int32)
        fits = place < offered.shape[1]
        offered[row[fits], place[fits]] = source[fits]
        for a in range(0, len(hubs), _BATCH):
            part = slice(a, a + _BATCH)
            self.edges[hubs[part]] = self.prune(hubs[part], np.concatenate([self.edges[hubs[part]], offered[part]], axis=1), alpha)

    def prune(self, nodes: np.ndarray, pool: np.ndarray, alpha: float) -> np.ndarray:
        """Diverse neighbours for each node out of its pool (-1 is none)."""
        pool = np.sort(pool, axis=1)
        bad = (pool < 0) | (pool == nodes[:, None])
        bad[:, 1:] |= pool[:, 1:] == pool[:, :-1]
        vectors = self.x[np.where(bad, 0, pool)]
        distance = 2 - 2 * np.einsum("nmd,nd->nm", vectors, self.x[nodes])
        distance[bad] = np.inf
        out = np.full((len(nodes), DEGREE), -1, np.int32)
        rows = np.arange(len(nodes))
        alive = ~bad
        for k in range(DEGREE):
            pick = np.where(alive, distance, np.inf).argmin(1)
            some = alive[rows, pick]
            if not some.any():
                break
            out[some, k] = pool[rows, pick][some]
            between = 2 - 2 * np.einsum("nmd,nd->nm", vectors, vectors[rows, pick])
            alive &= ~((alpha * alpha * np.maximum(between, 0) <= distance) & some[:, None])
            alive[rows, pick] = False
        return out

    def search(self, q: np.ndarray, beam: int, keep: bool = False):
        """Beam search of a batch: (cosines, nodes) of each query's beam, best first, -1 for none; with ``keep`` also all
        nodes whose neighbours were looked at."""
        b = len(q)
        ids = np.tile(self.entries, (b, 1)).astype(np.int32)
        near = (q @ self.x[self.entries].T).astype(np.float32)
        open_ = np.ones(ids.shape, bool)
        seen = np.zeros((b, self.n + 1), bool)
        seen[:, self.entries] = True
        seen[:, self.n] = True  # stands for no node
        looked = []
        rows = np.arange(b)
        while len(rows):
            score = np.where(open_[rows], near[rows], -np.inf)
            take = np.argsort(-score, axis=1)[:, :_EXPAND]
            some = np.take_along_axis(score, take, 1) > -np.inf
            rows, take, some = rows[some[:, 0]], take[some[:, 0]], some[some[:, 0]]
            if not len(rows):
                break
            picked = np.where(some, np.take_along_axis(ids[rows], take, 1), self.n)
            mark = open_[rows]
            np.put_along_axis(mark, take, False, 1)
            open_[rows] = mark
            if keep:
                log = np.full((b, picked.shape[1]), -1, np.int32)
                log[rows] = np.where(picked < self.n, picked, -1)
                looked.append(log)
            next_ = np.where((picked < self.n)[:, :, None], self.edges[np.minimum(picked, self.n - 1)], -1).reshape(len(rows), -1)
            next_ = np.sort(np.where(next_ < 0, self.n, next_), axis=1)
            next_[:, 1:] = np.where(next_[:, 1:] == next_[:, :-1], self.n, next_[:, 1:])
            next_ = np.where(seen[rows[:, None], next_], self.n, next_)
            seen[rows[:, None], next_] = True
            cosine = np.einsum("nmd,nd->nm", self.x[np.minimum(next_, self.n - 1)], q[rows])
            cosine[next_ == self.n] = -np.inf
            all_ids = np.concatenate([ids[rows], np.where(next_ == self.n, -1, next_).astype(np.int32)], axis=1)
            all_near = np.concatenate([near[rows], cosine], axis=1)
            all_open = np.concatenate([open_[rows], next_ < self.n], axis=1)
            width = min(beam, all_ids.shape[1])
            order = np.argsort(-all_near, axis=1, kind="stable")[:, :width]
            if ids.shape[1] < width:
                grow = ((0, 0), (0, width - ids.shape[1]))
                ids, near, open_ = np.pad(ids, grow, constant_values=-1), np.pad(near, grow, constant_values=-np.inf), np.pad(open_, grow)
            ids[rows, :width], near[rows, :width] = np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_near, order, 1)
            open_[rows, :width] = np.take_along_axis(all_open, order, 1)
        order = np.argsort(-near, axis=1, kind="stable")
        ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
        return near, ids, (np.concatenate(looked, axis=1) if looked else np.zeros((b, 0), np.int32)) if keep else None


def build(vectors: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The index: (shard, place, vec_ids, v, edges) per distinct vector, written to the shared folder.

    Every row is indexed under its vector. Of equal vectors the ``k + 1`` smallest ids are listed: ties go to the
    smaller id and a query skips its own, so no other could be among ``k`` nearest.
    """
    rows = usable(vectors, id_col, vector_col).withColumn("h", F.xxhash64("v"))
    rank = F.row_number().over(Window.partitionBy("h", "v").orderBy("vec_id"))
    few = rows.withColumn("rank", rank).filter(F.col("rank") <= k + 1)
    distinct = stored(few.groupBy("h", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("vec_ids")), "vectors")
    shards = max(1, -(-distinct.count() // SHARD_ROWS))
    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards)).cast("int"))

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("h", kind="stable").reset_index(drop=True)
        graph = Graph(unit(padded(list(p["v"]))))
        return pd.DataFrame({"shard": p["shard"], "place": np.arange(len(p), dtype=np.int32), "vec_ids": p["vec_ids"], "v": p["v"], "edges": list(graph.edges)})

    return stored(dealt.groupBy("shard").applyInPandas(run, "shard int, place int, vec_ids array<bigint>, v array<double>, edges array<int>"), "index")


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): one row per id, the smallest vector of repeated ids; null, zero and non-finite vectors and null ids out."""
    good = F.col(id_col).isNotNull() & finite(F.col(vector_col)) & F.exists(vector_col, lambda x: x != 0)
    rows = vectors.filter(good).select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def search(index: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH_BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found for the queries (vec_id, v), their own id left out.

    Each block of queries meets each shard in a task of its own, so memory stays bounded on both sides.
    """
    shards = index.agg(F.max("shard")).first()[0]
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    asked = queries.select("vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards or 0)))
    )
    parts = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(p):
            p = p.sort_values("place")
            both = padded([*p["v"], *q["v"]])
            raw, asked_raw = both[: len(p)], both[len(p) :]
            graph = Graph(unit(raw), np.stack(p["edges"].to_list()).astype(np.int32))
            lists, lengths = p["vec_ids"].to_list(), np.linalg.norm(raw, axis=1)
            for at in range(0, len(q), _BATCH):
                some = asked_raw[at : at + _BATCH]
                _, nodes, _ = graph.search(unit(some), max(beam, 2 * k))
                for own, v, found in zip(q["vec_id"].to_numpy()[at : at + _BATCH].tolist(), some, nodes):
                    found = found[found >= 0]
                    score = (raw[found] * v).sum(1) / (lengths[found] * np.linalg.norm(v))
                    each = [(s, i) for s, f in zip(score.tolist(), found.tolist()) for i in lists[f] if i != own]
                    each.sort(key=lambda x: (-x[0], x[1]))
                    out += [(own, i, s) for s, i in each[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    keys = ["shard", "block"]
    met = asked.groupBy(*keys).cogroup(parts.groupBy(*keys)).applyInPandas(run, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, queries: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for the rows that ``queries`` picks, among all others.

    Vectors of unequal length are compared as if filled with zeros. Fewer than k other rows give fewer results.
    """
    index = build(vectors, k, id_col, vector_col)
    return search(index, usable(vectors.filter(queries), id_col, vector_col), k)
