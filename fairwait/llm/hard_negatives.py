"""Hard negatives by rotated one-bit codes.

Vectors are rotated at random (signs and Hadamard transforms) and coded bit by bit: the signs of all components are a one-bit code,
whose alignment, the weight that brings it nearest to the vector, is stored; what is left over is coded in the same way, a few
times, and the weights of all codes are fitted together. The product of two vectors is estimated from the alignments and the numbers
of bits in which their codes differ. What the codes leave over has a known length, so by Cauchy and Schwarz the estimate is off by
no more than a bound: every candidate has an interval, by its first code and then by all of them, and those whose interval cannot
reach a threshold (k-th best exact score so far, or a window) go without being scored. The others are scored exactly, in whole numbers.

Anchors are a stated share of the rows and meet all others, in cells of a block of anchors and a part of the rows, both of bounded size.
Cells return their own best only. Positives need only the cells of their label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import list_array, stored
from .norm_search import best, finite, products

LEVELS, ANCHOR_LEVELS = 6, 8  # codes of a candidate and of an anchor
CELL = 1 << 20  # components of all vectors on one side of a cell
SEED = 20


def rotation(width: int) -> np.ndarray:
    """Two rows of signs for vectors of ``width`` components, filled up to a power of two, 64 at least."""
    size = max(64, 1 << (max(width, 1) - 1).bit_length())
    return np.random.default_rng(SEED).choice([-1.0, 1.0], size=(2, size))


def rotate(vectors: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Each vector, filled with zeros, turned without change of length: signs, then a Hadamard transform, twice."""
    rows, size = len(vectors), signs.shape[1]
    out = np.zeros((rows, size))
    out[:, : vectors.shape[1]] = vectors
    for s in signs:
        out *= s
        step = 1
        while step < size:
            pairs = out.reshape(rows, -1, 2, step)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, size)
            step *= 2
        out /= np.sqrt(size)
    return out


def encode(vectors: np.ndarray, signs: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (row, level, words of 64 bits), alignments (row; of the first code alone, then of all codes together) and
    lengths (row; of the vector, of what the first code leaves over, of what all leave over)."""
    whole = rotate(vectors, signs)
    rows, size = whole.shape
    bits = np.empty((rows, levels, size))
    aligned, lengths = np.empty((rows, 1 + levels)), np.empty((rows, 3))
    left, lengths[:, 0] = whole, np.linalg.norm(whole, axis=1)
    for level in range(levels):
        bits[:, level] = np.where(left >= 0, 1.0, -1.0) / np.sqrt(size)
        taken = bits[:, : level + 1]
        # The nearest combination of the codes so far. Any weights are right, as what is left is measured; the small
        # number keeps equal codes (of a zero vector, say) solvable.
        weights = np.linalg.solve(taken @ taken.transpose(0, 2, 1) + 1e-9 * np.eye(level + 1), taken @ whole[:, :, None])
        left = whole - (taken * weights).sum(axis=1)
        if level == 0:
            aligned[:, 0], lengths[:, 1] = weights[:, 0, 0], np.linalg.norm(left, axis=1)
    aligned[:, 1:], lengths[:, 2] = weights[:, :, 0], np.linalg.norm(left, axis=1)
    return np.packbits(bits > 0, axis=2).view(np.uint64), aligned, lengths


class Side:
    """One side of a cell (a row or more): ids, whole-number vectors and their codes."""

    def __init__(self, table: pa.Table):
        n = table.num_rows
        self.ids = table["vec_id"].to_numpy()
        numbers = lambda c: table[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        self.vectors, self.aligned, self.lengths = numbers("v"), numbers("aligned"), numbers("lengths")
        codes = np.frombuffer(b"".join(table["codes"].to_pylist()), dtype=np.uint64)
        self.codes = codes.reshape(n, self.aligned.shape[1] - 1, -1)


def intervals(q: Side, i: int, p: Side, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The rows still asked for with bounds on their products with anchor ``i``, by their first codes and then by all; send the places
    to go on with."""
    size = 64 * q.codes.shape[2]
    length, unseen = q.lengths[i, 0], q.lengths[i, 2]
    for codes, weights, rest in ((p.codes[:, :1], p.aligned[:, :1], p.lengths[:, 1]), (p.codes, p.aligned[:, 1:], p.lengths[:, 2])):
        estimate = np.zeros(len(rows))
        for level in range(codes.shape[1]):
            mine, met = codes[rows, level], np.zeros(len(rows))
            for code, weight in zip(q.codes[i], q.aligned[i, 1:]):
                differing = np.bitwise_count(mine ^ code).sum(axis=1, dtype=np.int64)
                met += weight / size * (size - 2 * differing)
            estimate += weights[rows, level] * met
        left, own = rest[rows], p.lengths[rows, 0]
        # <x, q> = <coded x, coded q> + <x left, q> + <coded x, q left>
        off = left * length + (own + left) * unseen + 1e-9 * own * length
        go_on = yield rows, estimate - off, estimate + off
        rows = rows[go_on]


def scored(q: Side, i: int, p: Side, rows: np.ndarray) -> np.ndarray:
    return products(q.vectors[i : i + 1], p.vectors[rows])[0]


def nearest(q: Side, i: int, p: Side, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k best of ``rows``, ties to the smaller id."""
    floor, level = -np.inf, intervals(q, i, p, rows)
    rows, low, high = next(level)
    while True:
        if len(rows) > 4 * k:
            seeds = rows[np.argpartition(-(low + high), k)[: 2 * k]]
            floor = max(floor, float(np.partition(scored(q, i, p, seeds), -k)[-k]))
        keep = np.flatnonzero(high >= floor)
        try:
            rows, low, high = level.send(keep)
        except StopIteration:
            rows = rows[keep]
            break
    scores = scored(q, i, p, rows)
    top = best(p.ids[rows], scores, k)
    return rows[top], scores[top]


def between(q: Side, i: int, p: Side, rows: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window (lowest, highest score), the places and scores of the k best of ``rows`` in it, ties to the smaller id."""
    least, most = min(w[0] for w in windows), max(w[1] for w in windows)
    level = intervals(q, i, p, rows)
    rows, low, high = next(level)
    while True:
        keep = (high >= least) & (low <= most)
        try:
            rows, low, high = level.send(np.flatnonzero(keep))
        except StopIteration:
            rows, low, high = rows[keep], low[keep], high[keep]
            break
    asked = np.zeros(len(rows), dtype=bool)
    for lowest, highest in windows:
        floor, sure = lowest, np.flatnonzero(high <= highest)  # surely not above the window
        if len(sure) >= k:
            seeds = sure[np.argpartition(-low[sure], min(2 * k, len(sure)) - 1)[: 2 * k]]
            floor = max(floor, int(np.partition(scored(q, i, p, rows[seeds]), -k)[-k]))
        asked |= (low <= highest) & (high >= floor)
    rows = rows[asked]
    scores, found = scored(q, i, p, rows), []
    for lowest, highest in windows:
        inside = np.flatnonzero((scores >= lowest) & (scores <= highest))
        top = inside[best(p.ids[rows[inside]], scores[inside], k)]
        found.append((rows[top], scores[top]))
    return found


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Whole numbers from ``low`` to ``high`` percent of a score, both included."""
    return -(-low * score // 100), high * score // 100


CODE = ["vec_id", "v", "codes", "aligned", "lengths", "label"]


def coded(rows: DataFrame, width: int, levels: int) -> DataFrame:
    """(vec_id, v, codes, aligned, lengths, label): vectors filled to ``width``, with their codes."""
    signs = rotation(width)
    step = max(1, (1 << 18) // signs.shape[1])  # vectors coded at once

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, step) for b in batches for i in range(0, b.num_rows, step)):
            n, v = batch.num_rows, batch["v"]
            sizes, values = np.diff(v.offsets.to_numpy()), v.flatten().to_numpy(zero_copy_only=False)
            full = np.zeros((n, max(width, 1)))
            full[np.arange(full.shape[1])[None, :] < sizes[:, None]] = values
            codes, aligned, lengths = encode(full, signs, levels)
            lists = lambda m: list_array(m.ravel(), np.arange(n + 1) * m.shape[1])
            made = {"v": lists(full), "codes": pa.array([c.tobytes() for c in codes], type=pa.binary()), "aligned": lists(aligned), "lengths": lists(lengths)}
            yield pa.RecordBatch.from_arrays([made[c] if c in made else batch[c] for c in CODE], names=CODE)

    schema = f"vec_id bigint, v array<double>, codes binary, aligned array<double>, lengths array<double>, label {rows.schema['label'].dataType.simpleString()}"
    return stored(rows.select("vec_id", "v", "label").mapInArrow(code, schema), "coded")


def mine(
    rows: DataFrame,
    anchors: Column,
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "v",
    cell: int = CELL,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vector_col`` holds whole numbers as doubles; scores are their products, exact (beyond a long, held to its range). The
    positives of an anchor (rows that ``anchors`` picks) are its ``n_positives`` best other rows of the same label; its negatives for
    a positive are the best ``n_negatives`` rows of other labels with a score of ``low`` to ``high`` percent of the positive's. Ties go
    to the smaller id; fewer rows give fewer results, a positive of negative score none.

    Null ids, labels and vectors, and vectors with null or non-finite components take no part. Of rows that repeat an id the smallest
    (label, vector) stands for it. Vectors of unequal length are compared as if filled with zeros; equal vectors are all compared.
    Other columns are not looked at. ``cell`` bounds the components that a task holds of either side.
    """
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & finite(F.col(vector_col))
    found = rows.filter(usable).select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.struct(F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v")).alias("row"),
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
    )
    found = found.groupBy("vec_id").agg(F.min("row").alias("row"), F.max("is_anchor").alias("is_anchor"))
    found = stored(found.select("vec_id", "row.label", "row.v", "is_anchor"), "points")
    n, n_anchors, width = found.agg(F.count("*"), F.count_if("is_anchor"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    points, anchors = coded(found, width, LEVELS), coded(found.filter("is_anchor"), width, ANCHOR_LEVELS)
    side = max(1, cell // max(width, 1))
    part_of = lambda n: F.pmod(F.xxhash64("vec_id"), n).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), (n - 1).cast("int")))

    # Positives: cells of one label. A label's anchors and rows are cut into blocks and parts by their own counts.
    sizes = found.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_anchor").alias("a")).filter("a > 0")
    sizes = stored(sizes.select("label", F.ceil(F.col("n") / side).alias("parts"), F.ceil(F.col("a") / side).alias("blocks")), "sizes")
    asked = anchors.join(sizes, "label").select(*CODE, part_of(F.col("blocks")).alias("block"), spread(F.col("parts")).alias("part"))
    given = points.join(sizes, "label").select(*CODE, part_of(F.col("parts")).alias("part"), spread(F.col("blocks")).alias("block"))

    def answer(out: list[tuple], names: list[str]) -> pa.Table:
        return pa.table({n: pa.array([r[c] for r in out], type=pa.int64()) for c, n in enumerate(names)})

    def positive(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        names = ["anchor_id", "positive_id", "positive_score"]
        if not left.num_rows or not right.num_rows:
            return answer(out, names)
        q, p = Side(left), Side(right)
        for i in range(len(q.ids)):
            at, scores = nearest(q, i, p, np.flatnonzero(p.ids != q.ids[i]), n_positives)
            out += [(int(q.ids[i]), int(x), int(s)) for x, s in zip(p.ids[at], scores)]
        return answer(out, names)

    keys = ["label", "block", "part"]
    pairs = asked.groupBy(*keys).cogroup(given.groupBy(*keys)).applyInArrow(positive, "anchor_id bigint, positive_id bigint, positive_score bigint")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    pairs = pairs.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= n_positives)
    # A handful for each anchor.
    pairs = pairs.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.array_sort(F.collect_list(F.struct("positive_id", "positive_score"))).alias("positives"))

    # Negatives: every block of anchors meets every part of the rows.
    n_parts, n_blocks = F.lit(max(1, -(-n // side))), F.lit(max(1, -(-n_anchors // side)))
    asked = anchors.join(stored(pairs, "positives"), "vec_id")
    asked = asked.select(*CODE, "positives", part_of(n_blocks).alias("block"), spread(n_parts).alias("part"))
    given = points.select(*CODE, part_of(n_parts).alias("part"), spread(n_blocks).alias("block"))

    def negative(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        if not left.num_rows or not right.num_rows:
            return answer(out, names)
        q, p = Side(left), Side(right)
        labels = pa.chunked_array([*left["label"].chunks, *right["label"].chunks]).combine_chunks().dictionary_encode().indices.to_numpy()
        own, theirs = labels[: len(q.ids)], labels[len(q.ids) :]
        for i, positives in enumerate(left["positives"].to_pylist()):
            asked = [(x, window(x["positive_score"], low, high)) for x in positives if x["positive_score"] >= 0]
            rows = np.flatnonzero(theirs != own[i])
            if not asked or not len(rows):
                continue
            for (x, _), (at, scores) in zip(asked, between(q, i, p, rows, [w for _, w in asked], n_negatives)):
                out += [(int(q.ids[i]), x["positive_id"], x["positive_score"], int(y), int(s)) for y, s in zip(p.ids[at], scores)]
        return answer(out, names)

    keys = ["block", "part"]
    schema = "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
    mined = asked.groupBy(*keys).cogroup(given.groupBy(*keys)).applyInArrow(negative, schema)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    mined = mined.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= n_negatives)
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
