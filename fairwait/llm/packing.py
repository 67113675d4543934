"""Packing documents into token sequences along a Hilbert curve.

Each document's tokens are hashed into a vector of few dimensions, whose place on a Hilbert curve is its
key. Documents are range-sorted by key; running totals per range give every document its place in one
long row of tokens, which is cut every ``length`` tokens. Neighbours on the curve so share sequences. What remains at the
end of the row is cut into powers of two, which need no padding. Documents may be packed by a column, as their language: each of its
values has a row of tokens of its own, so no sequence holds two of them.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .bpe import vocabulary
from .common import slices, stored, texts, tidy

DIMENSIONS = 4
BITS = 12  # per dimension
RANGES = 64  # ranges of the curve that are sorted apart, at least


def directions(size: int) -> np.ndarray:
    """A fixed random direction for every token id."""
    return np.random.Generator(np.random.PCG64(7)).standard_normal((size, DIMENSIONS)).astype(np.float32)


def points(ids: np.ndarray, lengths: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Grid cells of the documents: mean direction of their tokens, scaled by the root of the length so that
    every dimension is spread like a normal variable, then by its distribution function to the grid."""
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    sums = np.add.reduceat(table[ids], starts, axis=0)
    scaled = sums / np.sqrt(np.maximum(lengths, 1))[:, None]
    share = 1 / (1 + np.exp(-1.702 * np.clip(scaled / 2, -8, 8)))  # logistic form of the normal distribution
    return np.minimum((share * (1 << BITS)).astype(np.uint64), np.uint64((1 << BITS) - 1))


def hilbert(cells: np.ndarray) -> np.ndarray:
    """Place on the Hilbert curve, by Skilling's transform (2004) for all cells at once."""
    x = cells.T.copy()
    one = np.uint64(1)
    q = np.uint64(1 << (BITS - 1))
    while q > one:
        p = q - one
        for i in range(len(x)):
            high = (x[i] & q) > 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= one
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = np.uint64(1 << (BITS - 1))
    while q > one:
        t = np.where((x[-1] & q) > 0, t ^ (q - one), t)
        q >>= one
    x ^= t
    key = np.zeros(len(cells), np.uint64)
    for bit in range(BITS - 1, -1, -1):
        for i in range(len(x)):
            key = (key << one) | ((x[i] >> np.uint64(bit)) & one)
    return key.astype(np.int64)


def id_bytes(size: int, end_id: int) -> int:
    """Bytes for a token id while documents are moved: two are enough for most vocabularies."""
    return 2 if max(size - 1, end_id) < 1 << 16 else 4


def tokenised(docs: DataFrame, path: str, id_col: str, text: str, end_id: int, by: str | None = None) -> DataFrame:
    """(doc_id, key, n, ids) per row, and its group if packed by a column: token ids with ``end_id`` last, as little-endian integers of ``id_bytes`` bytes."""
    group = [] if by is None else [F.col(by).cast("string").alias("group")]
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).alias("text"), *group)
    more = rows.columns[2:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        table = directions(max(v.size, end_id + 1))
        for batch in slices(batches, "text"):
            flat, cuts = v.encode_flat(texts(batch.column("text")))
            flat, n = np.insert(flat, cuts[1:], end_id), np.diff(cuts) + 1
            key = hilbert(points(flat, n, table))
            width = id_bytes(v.size, end_id)
            raw, cuts = flat.astype(f"<u{width}").tobytes(), (np.r_[0, np.cumsum(n)] * width).tolist()
            ids = [raw[a:z] for a, z in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(key), pa.array(n), pa.array(ids, pa.binary()), *[batch.column(c) for c in more]],
                ["doc_id", "key", "n", "ids", *more],
            )
        v.forget()

    return rows.mapInArrow(tidy(run), ", ".join(["doc_id bigint, key bigint, n bigint, ids binary", *[f"{c} string" for c in more]]))


def starts(rows: DataFrame, length: int) -> tuple[DataFrame, list[int]]:
    """(row, at) with the place of each row's tokens in the order of (group, key, doc_id, row), and the total of each group.

    A group begins at the next multiple of ``length``; without groups all rows are one. Rows are range-sorted, totals of the ranges (one
    short row each and group in it) are summed up, and a running sum inside each
    range adds the rest. The ranges are written first: a second sampling could cut them elsewhere.
    """
    parts = max(RANGES, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    group = [c for c in rows.columns if c == "group"]
    ordered = rows.select("row", "key", "doc_id", "n", *group).repartitionByRange(parts, *group, "key", "doc_id", "row")
    ranged = stored(ordered.withColumn("part", F.spark_partition_id()), "curve")
    totals = ranged.groupBy(*group, "part").agg(F.sum("n").alias("total")).orderBy(*group, "part").collect()
    before, sums, base = [], [], 0
    for i, r in enumerate(totals):
        if i == 0 or (group and r["group"] != totals[i - 1]["group"]):
            base += -(-sums[-1] // length) * length if sums else 0
            sums.append(0)
        before.append((r["part"], base + sums[-1], *[r[c] for c in group]))
        sums[-1] += r["total"]
    schema = [T.StructField("_part", T.IntegerType()), T.StructField("before", T.LongType()), *[T.StructField("_group", T.StringType()) for _ in group]]
    offsets = rows.sparkSession.createDataFrame(before, T.StructType(schema))
    order = Window.partitionBy(*group, "part").orderBy("key", "doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum("n").over(order), F.lit(0)) + F.col("before")
    same = F.col("part") == F.col("_part")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col("_group"))
    return ranged.join(F.broadcast(offsets), same).select("row", at.alias("at")), sums


def tails(totals: list[int], length: int) -> list[tuple[int, int, list[int]]]:
    """(place of its first token, sequences before it less its place in lengths, edges of its last sequences) per group."""
    out, base, shift = [], 0, 0
    for total in totals:
        edges = [base + total - total % length]
        for bit in range(length.bit_length() - 2, -1, -1):
            if total % length & (1 << bit):
                edges.append(edges[-1] + (1 << bit))
        out.append((base, shift, edges))
        base += -(-total // length) * length
        shift += len(edges) - 1 - (len(edges) > 1)
    return out


def pack(
    docs: DataFrame, path: str, length: int = 1024, id_col: str = "doc_id", text: str = "text", end_id: int = 0, by: str | None = None
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) per piece.

    ``ids`` holds the piece's token ids as little-endian 32-bit integers. Every document ends with ``end_id``, so an
    empty or null text is one token. Rows that repeat an id are documents of their own. Sequences hold ``length`` tokens,
    but for the end of the row, which is cut into powers of two; nothing is padded. ``length`` must be a power of two.
    ``by`` names a column of few values, such as the language: no sequence holds documents of two of them.
    """
    if length < 1 or length & (length - 1):
        raise ValueError("length must be a power of two")
    rows = stored(tokenised(docs, path, id_col, text, end_id, by).withColumn("row", F.monotonically_increasing_id()), "tokens")
    at, totals = starts(rows, length)
    groups = tails(totals, length)
    bases = [g[0] for g in groups]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = f"<u{id_bytes(vocabulary(path).size, end_id)}"
        for batch in slices(batches, "ids"):
            out: list[tuple] = []
            for doc, n, ids, first in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "ids", "at"))):
                here, end, ids = first, first + n, np.frombuffer(ids, kind).astype("<u4")
                _, shift, edges = groups[bisect_right(bases, first) - 1]
                while here < end:
                    if here < edges[0]:
                        seq, begin = here // length + shift, here - here % length
                        stop = begin + length
                    else:
                        k = bisect_right(edges, here) - 1
                        seq, begin, stop = edges[0] // length + shift + k, edges[k], edges[k + 1]
                    stop = min(stop, end)
                    out.append((doc, here - first, stop - here, ids[here - first : stop - first].tobytes(), n, seq, here - begin))
                    here = stop
            columns = list(zip(*out)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    placed = rows.select("row", "doc_id", "n", "ids").join(at, "row")
    return placed.mapInArrow(tidy(run), "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")
