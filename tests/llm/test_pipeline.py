"""The stages one after the other, each against a plain version of its rule on its own input."""

import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from fairwait.llm import line_dedup
from fairwait.llm.common import stored
from tests import oracle
from tests.llm.test_near_dedup import brute
from tests.llm.test_packing import tokens

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """(name, what went in, what came out) of every stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    odd = [(-1, None, "en", "odd", 0), (-2, "", "en", "odd", 0), (-3, "12 34 ?", None, "odd", 7), (None, "no id at all but plain words", None, None, None)]
    first = docs.orderBy("doc_id").limit(1)
    docs = docs.union(spark.createDataFrame(odd, docs.schema)).union(first)
    for name, stage in corpus_pipeline.STAGES:
        done = stored(stage(spark, docs, SF), name)
        out.append((name, docs, done))
        docs = done
    return out


def test_stages_in_order(steps):
    assert [name for name, *_ in steps] == ["language", "lines", "near_duplicates", "pack"]
    assert all(after.columns == before.columns for _, before, after in steps[:-1])


def test_language_drops_only_texts_without_letters(steps):
    _, before, after = steps[0]
    letters = F.col("text").rlike(r"\p{L}")
    assert sorted(map(repr, after.collect())) == sorted(map(repr, before.filter(letters).collect()))


def test_lines_keep_what_stands_first(steps):
    _, before, after = steps[1]
    done = {(r["doc_id"], r["text"]): r for r in line_dedup.dedup_lines(before).collect()}
    assert {(r["doc_id"], r["text"]) for r in after.collect()} == {k for k, r in done.items() if not r["n_dropped"] or r["text"].strip()}
    changed = {(i, t) for (i, t), r in done.items() if r["n_dropped"]}
    assert changed and all(r["n_chars"] == len(r["text"]) for r in after.collect() if (r["doc_id"], r["text"]) in changed)
    whole = {x.strip() for r in before.collect() for x in r["text"].split("\n")}
    missing = {x for x in whole if len(x.split()) >= 40} - {x.strip() for r in after.collect() for x in r["text"].split("\n")}
    assert not missing  # every long line stands somewhere once


def test_one_document_of_each_group_stays(steps):
    _, before, after = steps[2]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    groups = brute(rows, 5, 80)
    expected = {(i, t) for (i, t), (_, _, c) in zip(rows, groups) if c is None or i == c}
    assert {(r["doc_id"], r["text"]) for r in after.collect()} == expected
    assert after.count() == len(expected)


def test_every_token_is_packed_once(steps):
    _, before, after = steps[3]
    want, got = {}, {}
    for r in before.collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + len(tokens(r["text"]))
    for r in after.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want


def test_run_applies_all_stages(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def test_every_operator_is_registered():
    names = [q for q in entry_point.queries() if re.match(r"op\d+_", q)]
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in names) == list(range(1, 14))
    assert entry_point.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(q for q in entry_point.oracle_sql() if re.match(r"op\d+_", q)))
def test_operators_equal_their_sql(spark, name):
    df = entry_point.queries()[name](spark, SF)
    assert oracle.difference(oracle.spark_result(df), oracle.duck_result(oracle.connect(SF), entry_point.oracle_sql()[name])) is None
