"""The manifest against hashlib and a plain tree, and its SQL."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairwait.llm import merkle, queries
from tests import oracle

SF = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, `group` string, Pos int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + arity]) for i in range(0, len(levels[-1]), arity)])
    return levels


def plain_fold(levels, at, held, arity):
    siblings = []
    for nodes in levels[:-1]:
        first = at - at % arity
        run = list(nodes[first : first + arity])
        siblings += [x for i, x in enumerate(run) if i != at % arity]
        run[at % arity] = held
        held, at = h(*run), at // arity
    return held, siblings


def plain(rows, arity, changed):
    """(doc_id, leaf, subroot, root, proof, folded root) of rows (doc_id, text, lang, source, n_chars, ...)."""
    leaf_of = lambda r, add=0: plain_leaf([r[0], r[3], r[2], None if r[4] is None else r[4] + add, r[1]])
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is None, r[0] or 0, leaf_of(r)))
        trees[g] = plain_tree([leaf_of(r) for r in groups[g]], arity)
    top, out = plain_tree([trees[g][-1][0] for g in order], arity), []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            held, low = plain_fold(trees[g], i, leaf_of(r, 1 if changed(r) else 0), arity)
            held, high = plain_fold(top, k, held, arity)
            out.append((r[0], leaf_of(r), trees[g][-1][0], top[-1][0], h(*low, *high), held, held == top[-1][0]))
    return sorted(out, key=repr)


def test_digests_equal_hashlib():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 5):
        digests = [rng.bytes(32) for _ in range(n)]
        state = merkle.fresh(1)
        for d in digests:
            state = merkle.absorb_hex(state, merkle._words(merkle.pa.array([d], type="binary")))
        got = merkle._bytes(merkle.finish(state, np.array([n])))[0].as_py().hex()
        assert got == hashlib.sha256(b"".join(d.hex().encode() for d in digests)).hexdigest()


def rows_of(n):
    rng = np.random.default_rng(n)
    langs = ["en", "de", None, "", "é", "Z", "zu"]
    rows = [(i, "text " * int(rng.integers(0, 9)), langs[int(rng.integers(0, 3)) if i % 9 else int(rng.integers(0, 7))], "s", i, "x", 1) for i in range(n)]
    odd = [(None, None, None, None, None, None, None), (None, "a", "en", "s", 1, "x", 1), (0, rows[0][1], rows[0][2], "s", 0, "x", 1) if n else (0, "", "en", "s", 0, "x", 1),
           (3, "other text", "de", "s", None, "x", 1), (n + 1, "ü" * 100_000, "only", "ß", 5, "x", 1)]
    return rows + odd


@pytest.mark.parametrize("n,arity,block", [(0, 2, 4096), (60, 2, 4), (150, 2, 8), (70, 3, 9), (90, 2, 4096), (40, 7, 7)])
def test_equals_plain_tree(spark, n, arity, block):
    rows = rows_of(n)
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    held = F.when(F.col("doc_id") % 3 == 0, merkle.leaf(["doc_id", "source", "lang", F.col("n_chars") + 1, "text"]))
    got = merkle.manifest(df, queries.LEAF, "lang", held=held, arity=arity, block_rows=block)
    assert got.columns == ["doc_id", "group", "pos", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = [tuple(r) for r in got.drop("group", "pos").collect()]
    assert sorted(got, key=repr) == plain(rows, arity, lambda r: r[0] is not None and r[0] % 3 == 0)


def test_levels_equal_plain_tree():
    leaves = [h(str(i)) for i in range(9000)]
    nodes = merkle._words(merkle.pa.array([bytes.fromhex(x) for x in leaves], type="binary"))
    while nodes.shape[1] > 1:
        nodes = merkle.Level(nodes, 2).parents
    assert merkle._bytes(nodes)[0].as_py().hex() == plain_tree(leaves, 2)[-1][0]


def test_one_group_equal_rows_and_own_leaves(spark):
    rows = [(7, "same", "en", "s", 4, "x", 1)] * 300 + [(None, None, None, None, None, None, None)]
    got = merkle.manifest(spark.createDataFrame(rows, DOCS), queries.LEAF, None)
    found = got.agg(F.count("*"), F.countDistinct("pos"), F.min("verified"), F.countDistinct("root")).first()
    assert tuple(found) == (301, 301, True, 1)


def test_empty_table_and_bad_arity(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCS), queries.LEAF, "lang").count() == 0
    with pytest.raises(ValueError):
        merkle._rounds(1, 64)


def test_equals_sql(spark):
    df, sql = queries.QUERIES["op12_merkle_manifest"](spark, SF), queries.ORACLE["op12_merkle_manifest"]
    assert oracle.difference(oracle.spark_result(df), oracle.duck_result(oracle.connect(SF), sql)) is None
