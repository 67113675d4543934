"""Near-duplicate documents by SetSketch registers, verified on whole shingle sets.

1. A document becomes its set of word shingles, a digest of that set and SetSketch registers: for each
   register the smallest of exponential variables drawn by hashing the shingles, on a logarithmic scale of base
   ``BASE`` and truncated. Registers of a union are the larger ones, and two sets agree in a register with
   about the probability of their similarity. Equal sets go on as one node.
2. Bands of registers are buckets. A bucket's hub is the member that meets most others. Every member is paired with
   its hubs only, so pairs stay linear in the members however large a group of copies is.
3. Pairs are estimated by the joint likelihood of their registers; those clearly below the threshold go. The rest is
   verified on the whole sets.
4. Buckets that still hold several components are contested. There, what a node shares with the hub, and with any other node
   outside it, bounds its similarity to every other member; whatever pairs this leaves open is estimated and verified too. So
   no link between nodes of a bucket is lost, up to the estimate's margin of ``MARGIN`` standard errors.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import met_by_sort, slices, stored, tidy
from .graph import components

REGISTERS = 128
ROWS = 4  # registers in a band: 32 bands miss a pair of similarity 0.8 once in 20 million times
BASE = 1.001
RATE = 20.0
TOP = 65534  # registers lie between 0 and TOP + 1
MARGIN = 5.0
SIZE_STEP = 1.05  # ratio of neighbouring size classes
_SLICE = 512 << 10  # bytes of text at once, so that hashes stay in the processor's cache

_draw = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _draw.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = _draw.integers(1, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _draw.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)
_PLACE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number spread over all others."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    out[1:] = _PLACE
    return np.multiply.accumulate(out) if n else out


_INVERSE = np.uint64(pow(int(_PLACE), -1, 1 << 64))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of UTF-8 bytes; words are parted by space and \\t..\\r, A-Z count as a-z."""
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    low = np.where((data >= 65) & (data <= 90), data + 32, data)
    inside = np.r_[False, ~gap, False]
    starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    ends = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    with np.errstate(over="ignore"):
        # Sum of letter values times powers of an odd number, made independent of the place by the inverse power.
        power = powers(len(data))
        total = np.r_[np.uint64(0), np.cumsum(_BYTE[low] * power, dtype=np.uint64)]
        back = np.full(len(data), _INVERSE, np.uint64)
        back[0] = 1
        back = np.multiply.accumulate(back)
        sums = (total[ends] - total[starts]) * back[starts]
        return mixed(sums + mixed((ends - starts).astype(np.uint64))), starts


def shingle_sets(raw: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: ``words`` words, or the whole sequence if there are fewer."""
    offsets = np.cumsum([0] + [len(r) + 1 for r in raw])
    hashes, starts = word_hashes(np.frombuffer(b" ".join(raw) + b" ", np.uint8))
    cuts = np.searchsorted(starts, offsets)
    out = []
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
        for k in range(words):
            rolled = rolled * _PLACE + hashes[k : k + len(rolled)]
        rolled = mixed(rolled)
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if z - a >= words:
                out.append(np.unique(rolled[a : z - words + 1]))
            elif z > a:
                one = np.uint64(z - a)
                for h in hashes[a:z]:
                    one = one * _PLACE + h
                out.append(mixed(np.array([one ^ np.uint64(0x5555)], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers (one row per set, none of them empty)."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    largest = np.empty((REGISTERS, len(sets)), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(REGISTERS):
            largest[i] = np.maximum.reduceat(flat * _FACTOR[i] + _SHIFT[i], starts)
    uniform = (largest.astype(np.float64) + 1) / 2.0**64
    # -log(uniform) without losing digits near 1
    exponential = -np.log1p(np.minimum(uniform - 1, -(2.0**-53))) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / math.log(BASE)), 0, TOP + 1).astype("<u2").T.copy()


def estimates(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, grid: int = 201) -> np.ndarray:
    """Most likely similarity given both registers and the exact set sizes.

    With u and v the shares of the sizes, a register is larger on the left with probability p(u - v J) and on the
    right with p(v - u J), where p(x) = -log_b(1 - x (b - 1) / b).
    """
    above, below = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    even = a.shape[1] - above - below
    u = (na / (na + nb))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, grid)[None, :] * np.minimum(u / v, v / u)
    p = lambda x: -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / math.log(BASE)
    more, less = p(u - v * j), p(v - u * j)
    with np.errstate(divide="ignore", invalid="ignore"):
        part = lambda n, q: np.where(n > 0, n * np.log(np.maximum(q, 1e-12)), 0.0)
        score = part(above, more) + part(below, less) + part(even, 1 - more - less)
    return j[np.arange(len(j)), score.argmax(1)]


def sketches(docs: DataFrame, id_col: str, text: str, words: int) -> DataFrame:
    """(doc_id, text_hash, n, node, registers) per row; node and registers are null for a text without words."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            sets = shingle_sets([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()], words)
            full = [i for i, s in enumerate(sets) if len(s)]
            node, regs = [None] * len(sets), [None] * len(sets)
            if full:
                for i, r in zip(full, registers([sets[i] for i in full])):
                    node[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                    regs[i] = r.tobytes()
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), sizes, pa.array(node, pa.binary()), pa.array(regs, pa.binary())],
                ["doc_id", "text_hash", "n", "node", "registers"],
            )

    return rows.mapInArrow(tidy(run), "doc_id bigint, text_hash bigint, n bigint, node binary, registers binary")


def likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose estimate does not rule out the threshold."""
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb"))
    both = pairs.join(met_by_sort(left), "a").join(met_by_sort(right), "b").select("a", "b", "na", "nb", "ra", "rb")
    wanted = percent / 100
    floor = wanted - MARGIN * math.sqrt(wanted * (1 - wanted) / REGISTERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                ra, rb = (np.frombuffer(b"".join(part.column(c).to_pylist()), "<u2").reshape(part.num_rows, REGISTERS) for c in ("ra", "rb"))
                na, nb = (part.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("na", "nb"))
                keep = pa.array(estimates(ra, rb, na, nb) >= floor)
                yield pa.RecordBatch.from_arrays([part.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])

    return both.mapInArrow(tidy(run), "a binary, b binary")


def set_table(docs: DataFrame, id_col: str, text: str, words: int, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted nodes, each from the text of one document (doc_id, text_hash, node)."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    same = rows["doc_id"].eqNullSafe(wanted["doc_id"]) & (rows["text_hash"] == wanted["text_hash"])
    chosen = rows.join(wanted, same, "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            sets = shingle_sets([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()], words)
            node = pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary())
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(s) for s in sets]), pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
            yield pa.RecordBatch.from_arrays([node, lists], ["node", "shingles"])

    found = chosen.mapInArrow(tidy(run), "node binary, shingles array<bigint>")
    return found.groupBy("node").agg(F.first("shingles").alias("shingles"))


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, inter, na, nb) from the whole sets of each pair."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    met = pairs.join(met_by_sort(left), "a").join(met_by_sort(right), "b")
    inter = F.size(F.array_intersect("sa", "sb"))
    return met.select("a", "b", inter.alias("inter"), F.size("sa").alias("na"), F.size("sb").alias("nb"))


def links_of(pairs: DataFrame, percent: int) -> DataFrame:
    """The measured pairs that reach the threshold."""
    return pairs.filter(F.col("inter") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("inter"))).select("a", "b")


def sizes_fit(x: Column, y: Column, percent: int) -> Column:
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def ordered(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node, n, mass) for the buckets with several nodes; mass counts the meetings of a node."""
    width = 2 * ROWS
    band = F.transform(
        F.sequence(F.lit(0), F.lit(REGISTERS // ROWS - 1)), lambda k: F.xxhash64(k, F.substr("registers", k * width + 1, F.lit(width)))
    )
    rows = nodes.select("node", "n", F.explode(band).alias("bucket"))
    several = rows.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    met = rows.join(met_by_sort(several), "bucket")
    mass = met.groupBy("node").agg(F.sum("size").alias("mass"))
    return met.select("bucket", "node", "n").join(met_by_sort(mass), "node")


def contested_pairs(grouped: DataFrame, shared: DataFrame, tried: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes under one hub that are in different components and that no bound rules out.

    ``grouped`` holds (hub, node, n, root), ``shared`` (node, common), the number of a node's shingles that any other node
    has too, and ``tried`` the measured pairs with hubs. Two nodes share at most the smaller of their
    intersections with the hub, and outside it at most the smaller number of other common shingles; so nearly all
    members that only resemble the hub are settled by counts. The common number also leaves an interval of sizes for a
    partner: nodes are met by hub and size class, so only classes inside the interval are looked at.
    """
    seen = tried.select("a", "b", "inter").union(tried.select("b", "a", "inter")).toDF("hub", "node", "inter")
    placed = grouped.join(met_by_sort(shared), "node").join(met_by_sort(seen), ["hub", "node"], "left")
    own = F.col("node") == F.col("hub")
    placed = placed.withColumns(
        {
            "core": F.when(own, F.col("n")).otherwise(F.coalesce("inter", "common")),
            "rest": F.when(own, F.lit(0)).otherwise(F.col("common") - F.coalesce("inter", F.lit(0))),
        }
    )
    share = placed.groupBy("hub", "root").agg(F.count("*").alias("size"))
    main = share.groupBy("hub").agg(F.max(F.struct("size", "root"))["root"].alias("main"))
    placed = placed.join(met_by_sort(main), "hub").filter(F.col("common") * 100 >= F.col("n") * percent)
    low = F.ceil(F.col("n") * percent / 100)
    high = F.floor(F.least(F.col("n") * 100 / percent, F.col("common") * (100 + percent) / percent - F.col("n")))
    level = lambda c: F.floor(F.log(c.cast("double")) / math.log(SIZE_STEP)).cast("int")
    columns = ("node", "n", "core", "rest", "root")
    seekers = (
        placed.filter("root <> main")
        .withColumns({"low": low, "high": high})
        .filter("low <= high")
        .withColumn("level", F.explode(F.sequence(level(F.col("low")) - 1, level(F.col("high")) + 1)))
        .select("hub", "level", "low", "high", *[F.col(c).alias("x_" + c) for c in columns])
    )
    sought = placed.withColumn("level", level(F.col("n"))).select("hub", "level", "main", *[F.col(c).alias("y_" + c) for c in columns])
    most = F.least("x_core", "y_core") + F.least("x_rest", "y_rest")
    open_ = (
        (F.col("x_root") != F.col("y_root"))
        & F.col("y_n").between(F.col("low"), F.col("high"))
        & (most * 100 >= percent * (F.col("x_n") + F.col("y_n") - most))
        & ((F.col("y_root") == F.col("main")) | (F.col("x_node") < F.col("y_node")))
    )
    keys = (seekers["hub"] == sought["hub"]) & (seekers["level"] == sought["level"])
    found = seekers.join(met_by_sort(sought), keys & open_).select(*ordered(F.col("x_node"), F.col("y_node"))).distinct()
    return found.join(met_by_sort(tried), ["a", "b"], "left_anti")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) per row of ``docs``.

    Documents are linked if their sets of ``words``-word shingles have a similarity of at least ``percent`` in a hundred;
    component_id is the smallest id reachable, kept marks the documents with that id. Texts that are null or without words
    are linked with nothing. Rows that repeat an id are documents of that id each. A row without id can be in a component
    and is kept only if nothing in it has an id. Other columns are not looked at.
    """
    rows = stored(sketches(docs, id_col, text, words), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("of")
    nodes = stored(
        rows.filter("node IS NOT NULL").groupBy("node").agg(first, F.first("n").alias("n"), F.first("registers").alias("registers")), "nodes"
    )
    members = stored(buckets(nodes), "buckets")
    hub = members.groupBy("bucket").agg(F.max(F.struct("mass", "n", "node")).alias("hub"))
    stars = stored(
        members.join(met_by_sort(hub), "bucket")
        .filter(F.col("node") != F.col("hub.node"))
        .filter(sizes_fit(F.col("n"), F.col("hub.n"), percent))
        .select(*ordered(F.col("node"), F.col("hub.node")))
        .distinct(),
        "stars",
    )
    open_ = stored(likely(stars, nodes, percent), "likely")

    def sets_for(of: DataFrame) -> DataFrame:
        wanted = nodes.join(met_by_sort(of), "node", "left_semi").select(F.col("of.doc_id").alias("doc_id"), F.col("of.text_hash").alias("text_hash"))
        return stored(set_table(docs, id_col, text, words, wanted), "sets")

    ends = open_.select(F.col("a").alias("node")).union(open_.select(F.col("b").alias("node"))).distinct()
    tried = stored(measured(open_, sets_for(ends)), "measured")
    links = links_of(tried, percent)
    grown = nodes.select("node").join(met_by_sort(components(links, "a", "b")), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    roots = stored(grown, "roots")

    several = (
        members.join(met_by_sort(roots), "node").groupBy("bucket").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least <> most").select("bucket")
    )
    under = members.join(met_by_sort(several), "bucket", "left_semi").join(met_by_sort(hub), "bucket").select(F.col("hub.node").alias("hub"), "node", "n").distinct()
    contested = stored(under.join(met_by_sort(roots), "node"), "contested")
    sets = sets_for(contested.select("node").distinct())
    spread = sets.select("node", F.explode("shingles").alias("shingle"))
    lone = spread.groupBy("shingle").agg(F.count("*").alias("times"), F.first("node").alias("node")).filter("times = 1")
    alone = lone.groupBy("node").agg(F.count("*").alias("lone"))
    shared = sets.join(met_by_sort(alone), "node", "left").select("node", (F.size("shingles") - F.coalesce("lone", F.lit(0))).alias("common"))
    left_open = stored(contested_pairs(contested, shared, tried, percent), "contested_pairs")
    late = links_of(measured(likely(left_open, nodes, percent), sets), percent)
    # The components so far are stars already, so only the late links take rounds.
    final = components(roots.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).union(late), "a", "b")

    placed = rows.join(met_by_sort(final), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
    out = placed.join(met_by_sort(least), "root", "left").withColumn("component_id", F.coalesce("least", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))
