"""Exact duplicates against a plain version, and their SQL."""

import hashlib
import re

import pytest

from fairwait.llm import exact_dedup, queries
from tests import oracle

SF = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, _row string, digest string, Kept int"

LONG = "word " * 40_000
ROWS = [
    (5, "a b", "x", "old", 1), (3, "ab", "x", "old", 1), (4, "a  b", "x", "old", 1), (6, "A b", "x", None, 2),
    (7, None, None, None, None), (2, "", "e", "o", 0), (9, " \t\n\x0b\f\r", "e", "o", 0), (None, None, "e", "o", 0),
    (8, "a b", "nbsp", "o", 0), (10, LONG + "x", "l", "o", 0), (11, LONG + "y", "l", "o", 0), (12, LONG + " x", "l", "o", 0),
    (13, "one", "s", "o", 0), (13, "one", "s", "o", 0), (13, "two", "s", "o", 0), (None, "three", "n", "o", 0), (14, "t hree", "n", "o", 0),
    (15, "😀 😀", "m", "o", 0), (16, "😀😀", "m", "o", 0),
]


def flat(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def plain(rows):
    """(doc_id, keep_id, group size, sha256) of every row, and how many rows of each text stay (one)."""
    out = []
    for i, t, *_ in rows:
        same = [(-len(u or ""), j is None, j or 0, j) for j, u, *_ in rows if flat(u) == flat(t)]
        out.append((i, min(same)[3], len(same), hashlib.sha256(flat(t).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("prefix", [256, 1])
def test_equals_plain_version(spark, prefix):
    df = spark.createDataFrame(ROWS, DOCS).repartition(5)
    got = exact_dedup.dedup(df, digests=True, prefix=prefix)
    assert got.columns == ["doc_id", "text", "_row", "keep_id", "group_size", "kept", "digest"]
    got = got.collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["digest"]) for r in got), key=repr) == plain(ROWS)
    stay = {}
    for r in got:
        stay.setdefault(flat(r["text"]), []).append(r)
    for same in stay.values():
        kept = [r for r in same if r["kept"]]
        assert len(kept) == 1 and kept[0]["doc_id"] == kept[0]["keep_id"]
        assert len(kept[0]["text"] or "") == max(len(r["text"] or "") for r in same)


def test_digests_only_where_needed(spark):
    df = spark.createDataFrame(ROWS, DOCS)
    got = exact_dedup.dedup(df, columns=["doc_id"]).collect()
    assert all((r["digest"] is None) == (r["group_size"] == 1) for r in got if r["doc_id"] not in (10, 11, 12))
    assert {r["doc_id"] for r in got if r["digest"] is None} == {6, 8, 13} and len(got) == len(ROWS)


def test_equal_lengths_and_beginnings_are_told_apart(spark):
    df = spark.createDataFrame([(1, LONG + "x"), (2, LONG + "y")], "doc_id bigint, text string")
    assert [r["group_size"] for r in exact_dedup.dedup(df).collect()] == [1, 1]
    assert exact_dedup.suspects(df).count() == 1


def test_one_text_in_most_rows(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 < 2, 'the same  text', concat('own', id)) AS text").repartition(7)
    got = exact_dedup.dedup(df).filter("group_size > 1")
    assert got.agg({"group_size": "min"}).first()[0] == 2000 and got.filter("kept").count() == 1 and got.filter("keep_id = 0").count() == 2000


def test_empty_table(spark):
    assert exact_dedup.dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_equals_sql(spark):
    df, sql = queries.QUERIES["op13_exact_dedup"](spark, SF), queries.ORACLE["op13_exact_dedup"]
    assert oracle.difference(oracle.spark_result(df), oracle.duck_result(oracle.connect(SF), sql)) is None
