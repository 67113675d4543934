"""A dataset manifest as a tree of SHA-256 digests whose parents keep the hash state before each child.

A parent is the digest of its children's digests in hex. One such digest fills one block of SHA-256, so the state before a
child's slot is a chaining value of 32 bytes: parents keep one for every slot. To see what a changed leaf does to
the root, hashing goes on from the kept state with the new child and the siblings to its right; nothing to its left is read again.

Leaves are numbered by sorted ranges and cut into aligned blocks of 4096 or less, each a tree in one task; the tops of the blocks are
leaves of the next round, so that rounds are few (three for 68 billion leaves) and no task holds more than a block. Every block top
gets its way up, states and siblings, and the rows of a block climb it together, whole arrays at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import stored

BLOCK = 4096  # leaves in a block at most


def _cube_root(n: int) -> int:
    x = 1 << -(-n.bit_length() // 3)
    while True:
        y = (2 * x + n // (x * x)) // 3
        if y >= x:
            return x
        x = y


# The constants of SHA-256: the first 32 bits behind the point of the cube and square roots of the first primes.
_PRIMES = [p for p in range(2, 312) if all(p % d for d in range(2, isqrt(p) + 1))]
ROUNDS = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _PRIMES], dtype=np.uint32)
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _PRIMES[:8]], dtype=np.uint32)
# Four hex digits in ASCII, as one word, of every number of 16 bits.
_HEX = np.frombuffer("".join(f"{x:04x}" for x in range(1 << 16)).encode(), dtype=">u4").astype(np.uint32)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def absorb(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """SHA-256's compression of one block (16 words by rows) each into the states (8 words by rows)."""
    w = list(block)
    for t in range(16, 64):
        x, y = w[t - 15], w[t - 2]
        w.append(w[t - 16] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))) + w[t - 7] + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))))
    a, b, c, d, e, f, g, h = state
    for k, x in zip(ROUNDS, w):
        first = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + k + x
        second = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = first + second, a, b, c, d + first, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def absorb_hex(state: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """The states after the digests (8 words by rows) as hex text."""
    block = np.empty((16, digests.shape[1]), dtype=np.uint32)
    block[0::2], block[1::2] = _HEX[digests >> np.uint32(16)], _HEX[digests & np.uint32(0xFFFF)]
    return absorb(state, block)


def finish(state: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """The digests of the states that have taken in ``digests`` hex digests each."""
    block = np.zeros((16, state.shape[1]), dtype=np.uint32)
    block[0] = 1 << 31
    bits = digests.astype(np.uint64) * np.uint64(512)
    block[14], block[15] = bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return absorb(state, block)


def fresh(rows: int) -> np.ndarray:
    return np.repeat(START[:, None], rows, axis=1)


class Level:
    """One level of nodes, in runs of ``arity``, with the states that their parents keep."""

    def __init__(self, nodes: np.ndarray, arity: int):
        self.nodes, self.arity, self.count = nodes, arity, nodes.shape[1]
        parents = -(-self.count // arity)
        self.children = np.minimum(arity, self.count - np.arange(parents) * arity)
        state = fresh(parents)
        self.before = []  # by slot: the states of all parents before that child
        for slot in range(arity):
            self.before.append(state)
            there = np.flatnonzero(self.children > slot)
            state = state.copy()
            state[:, there] = absorb_hex(state[:, there], nodes[:, there * arity + slot])
        self.parents = finish(state, self.children)


def climb(levels: list[Level], held: np.ndarray, proof: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tops that the leaves' digests ``held`` lead to by the kept states, and the states of the siblings' hash with their number."""
    at = np.arange(held.shape[1])
    for level in levels:
        parent, slot = np.divmod(at, level.arity)
        state = np.stack(level.before)[slot, :, parent].T
        state = absorb_hex(state, held)
        for s in range(level.arity):
            theirs = parent * level.arity + s
            other = np.flatnonzero((theirs < level.count) & (slot != s))
            proof[:, other] = absorb_hex(proof[:, other], level.nodes[:, theirs[other]])
            links[other] += 1
            right = other[slot[other] < s]
            state[:, right] = absorb_hex(state[:, right], level.nodes[:, theirs[right]])
        held, at = finish(state, level.children[parent]), parent
    return held, proof, links


def way(levels: list[Level], leaf: int) -> bytes:
    """A leaf's way up: at each level the number of children, its slot, the state kept before it and its siblings."""
    out, at = [], leaf
    for level in levels:
        parent, slot = divmod(at, level.arity)
        first = parent * level.arity
        others = [i for i in range(first, first + int(level.children[parent])) if i != at]
        out += [np.array([len(others) + 1, slot], dtype=np.uint32), level.before[slot][:, parent], level.nodes[:, others].T.ravel()]
        at = parent
    return b"".join(x.astype("<u4").tobytes() for x in out)


def climb_way(path: bytes, held: np.ndarray, proof: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like ``climb`` for rows that share one way."""
    words, at, rows = np.frombuffer(path, dtype="<u4").astype(np.uint32), 0, held.shape[1]
    spread = lambda x: np.repeat(x[:, None], rows, axis=1)
    while at < len(words):
        children, slot = int(words[at]), int(words[at + 1])
        state, at = absorb_hex(spread(words[at + 2 : at + 10]), held), at + 10
        for s in range(children - 1):
            other, at = spread(words[at : at + 8]), at + 8
            proof, links = absorb_hex(proof, other), links + 1
            if s >= slot:
                state = absorb_hex(state, other)
        held = finish(state, np.full(rows, children))
    return held, proof, links


def _words(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Digests or states of 32 bytes as 8 words by rows."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=">u4").astype(np.uint32).reshape(-1, 8).T.copy()


def _bytes(words: np.ndarray) -> pa.Array:
    data = words.T.astype(">u4").tobytes()
    return pa.array([data[i : i + 32] for i in range(0, len(data), 32)], type=pa.binary())


def _rounds(arity: int, block: int) -> tuple[int, int]:
    """Levels of a block of at most ``block`` leaves and its number of leaves."""
    if arity < 2 or arity > block:
        raise ValueError("arity must lie between 2 and the block size")
    levels = 1
    while arity ** (levels + 1) <= block:
        levels += 1
    return levels, arity**levels


def _height(nodes: int, arity: int) -> int:
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // arity), levels + 1
    return levels


def _tree(table: pa.Table, arity: int, rounds: int) -> tuple[pa.Table, list[Level], np.ndarray]:
    """A block's rows in order, its levels and its top."""
    table = table.sort_by("pos")
    nodes = _words(table["node"])
    levels: list[Level] = []
    for _ in range(min(rounds, _height(table["n"][0].as_py(), arity))):
        levels.append(Level(nodes, arity))
        nodes = levels[-1].parents
    return table, levels, nodes


def numbered(nodes: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``nodes`` with ``pos``, the place in their group by ``order`` from 0, and ``n``, the group's size.

    Sorted ranges cut groups of any size; places are those in a range plus the counts of the ranges before. Rows equal
    in ``order`` are told apart by a number, so they too are spread over ranges.
    """
    keys = [group, *order, "_tie"]
    tied = nodes.withColumn("_tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()).drop("_tie")
    rows = stored(ranged, "ranges").withColumn("_range", F.shiftright("_at", 33))
    counts = rows.groupBy(group, "_range").agg(F.count("*").alias("_count"), F.min("_at").alias("_least"))
    # As many rows as there are ranges and groups together.
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        group, "_range", "_least", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_offset"), F.sum("_count").over(Window.partitionBy(group)).alias("n")
    )
    placed = rows.join(offsets, [group, "_range"])
    return placed.withColumn("pos", F.col("_offset") + F.col("_at") - F.col("_least")).select(*nodes.columns, "pos", "n")


def ways(nodes: DataFrame, arity: int, block_rows: int = BLOCK) -> DataFrame:
    """(tree, pos, way, top) of the nodes (tree, pos, n, node): the way from each to its tree's top."""
    rounds, size = _rounds(arity, block_rows)

    def block(table: pa.Table) -> pa.Table:
        table, levels, top = _tree(table, arity, rounds)
        found = pa.array([way(levels, i) for i in range(table.num_rows)], type=pa.binary())
        return pa.table({"tree": table["tree"], "pos": table["pos"], "way": found, "top": pa.repeat(_bytes(top)[0], table.num_rows), "n": table["n"]})

    blocks = nodes.select("tree", "pos", "n", "node", F.expr(f"pos DIV {size}").alias("block")).groupBy("tree", "block")
    found = stored(blocks.applyInArrow(block, "tree string, pos bigint, way binary, top binary, n bigint"), "ways")
    largest = found.agg(F.max("n")).first()[0]
    if largest is None or largest <= size:
        return found.drop("n")
    tops = found.filter(f"pos % {size} = 0").select("tree", F.expr(f"pos DIV {size}").alias("pos"), F.ceil(F.col("n") / size).alias("n"), F.col("top").alias("node"))
    above = ways(tops, arity, block_rows).select("tree", F.col("pos").alias("block"), F.col("way").alias("further"), F.col("top").alias("last"))
    joined = found.drop("top").withColumn("block", F.expr(f"pos DIV {size}")).join(above, ["tree", "block"])
    return joined.select("tree", "pos", F.concat("way", "further").alias("way"), F.col("last").alias("top"))


def leaf(columns: Sequence[str | Column]) -> Column:
    """The digest, as hex, of the values put together, each its number of UTF-8 bytes, a colon and itself, or "-" if null."""
    parts = []
    for c in columns:
        value = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


ROWS = T.StructType(
    [T.StructField(n, t) for n, t in [("tree", T.StringType()), ("block", T.LongType()), ("pos", T.LongType())]]
    + [T.StructField(n, T.BinaryType()) for n in ("node", "held", "proof", "top")]
    + [T.StructField("links", T.LongType()), T.StructField("n", T.LongType())]
)


def manifest(
    docs: DataFrame,
    columns: Sequence[str],
    group: str | None,
    id_col: str = "doc_id",
    held: Column | None = None,
    arity: int = 2,
    block_rows: int = BLOCK,
) -> DataFrame:
    """(id, group, pos, leaf, subroot, root, proof_sha256, folded_root, verified), one row per row; digests are hex.

    A row's leaf is the digest of ``columns``. The leaves of a group, ascending by id, are taken in runs of ``arity`` whose digests are
    the next nodes, until one remains, the subroot; the subroots, by group, lead to the root likewise. ``group=None`` makes one
    group. ``held`` is the leaf digest to be verified, as hex, by default (and where null) the row's own: with the other rows as
    they were, it leads to ``folded_root``. ``proof_sha256`` is the digest of all siblings on the way.

    The null group comes before the others, which are in the order of their UTF-8 bytes. Null ids come last;
    rows with the same id (or none) are in the order of their leaves, and equal rows are leaves of their own. Empty texts and
    long ones are hashed whole. No rows give no result. Other columns are not looked at, whatever their names. ``block_rows`` bounds the
    leaves that a task takes as one block.
    """
    rounds, size = _rounds(arity, block_rows)
    own = leaf(columns)
    tree = F.lit("1") if group is None else F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    rows = docs.select(tree.alias("tree"), F.col(id_col).alias("id"), own.alias("leaf"), (own if held is None else F.coalesce(held, own)).alias("claim"))
    rows = stored(rows.withColumns({"noid": F.col("id").isNull(), "node": F.unhex("leaf"), "held": F.unhex("claim")}).drop("claim"), "leaves")
    rows = numbered(rows, "tree", ["noid", "id", "leaf"]).drop("leaf", "noid")
    id_field = next(f for f in rows.schema if f.name == "id")

    def block(table: pa.Table) -> pa.Table:
        table, levels, top = _tree(table, arity, rounds)
        m = table.num_rows
        climbed, proof, links = climb(levels, _words(table["held"]), fresh(m), np.zeros(m, dtype=np.int64))
        made = {"held": _bytes(climbed), "proof": _bytes(proof), "top": pa.repeat(_bytes(top)[0], m), "links": pa.array(links)}
        return pa.table({c: made[c] if c in made else table[c] for c in [*ROWS.names, "id"]})

    blocks = rows.withColumn("block", F.expr(f"pos DIV {size}")).groupBy("tree", "block")
    schema = T.StructType([*ROWS.fields, id_field])
    rows = stored(blocks.applyInArrow(block, schema), "blocks")

    # The tops of the blocks lead to the subroots, those to the root.
    tops = rows.filter(f"pos % {size} = 0").select("tree", F.col("block").alias("pos"), F.ceil(F.col("n") / size).alias("n"), F.col("top").alias("node"))
    up = ways(tops, arity, block_rows).withColumnRenamed("top", "subroot")
    subroots = numbered(up.filter("pos = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("subroot").alias("node")), "tree", ["name"])
    subroots = stored(subroots, "subroots")
    over = subroots.join(ways(subroots, arity, block_rows), ["tree", "pos"]).select(F.col("name").alias("tree"), F.col("way").alias("further"), F.col("top").alias("root"))
    up = up.join(over, "tree").select("tree", F.col("pos").alias("block"), F.concat("way", "further").alias("way"), "subroot", "root")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            held, proof = _words(batch["held"]), _words(batch["proof"])
            links = batch["links"].to_numpy(zero_copy_only=False).copy()
            paths: dict[bytes, list[int]] = {}
            for i, path in enumerate(batch["way"].to_pylist()):
                paths.setdefault(path, []).append(i)
            for path, at in paths.items():
                held[:, at], proof[:, at], links[at] = climb_way(path, held[:, at], proof[:, at], links[at])
            made = {"folded": _bytes(held), "proof": _bytes(finish(proof, links))}
            names = ["tree", "id", "pos", "node", "subroot", "root", "proof", "folded"]
            yield pa.RecordBatch.from_arrays([made[c] if c in made else batch[c] for c in names], names=names)

    fields = [T.StructField(n, T.BinaryType()) for n in ("node", "subroot", "root", "proof", "folded")]
    folded = rows.drop("top").join(up, ["tree", "block"]).select("tree", "id", "pos", "node", "held", "proof", "links", "way", "subroot", "root")
    folded = folded.mapInArrow(fold, T.StructType([ROWS["tree"], id_field, ROWS["pos"], *fields]))
    text = lambda c: F.lower(F.hex(c))
    return folded.select(
        F.col("id").alias(id_col),
        F.when(F.col("tree") != "0", F.substr("tree", F.lit(2))).alias("group"),
        "pos",
        text("node").alias("leaf"),
        text("subroot").alias("subroot"),
        text("root").alias("root"),
        text("proof").alias("proof_sha256"),
        text("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
