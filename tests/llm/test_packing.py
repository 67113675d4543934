"""Packed sequences against the tokenizers library."""

import itertools
from collections import defaultdict

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from fairwait.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
DOCS = "doc_id bigint, text string, key string, n int"


def tokens(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("length", [16, 1024])
def test_every_token_once(spark, length):
    rows = [(i, f"document {i} " * (i % 9 + 1), "x", 1) for i in range(150)]
    rows += [(900, None, "x", 1), (901, "", "x", 1), (902, "long words " * 20_000, "x", 1), (3, rows[3][1], "x", 1), (None, "no id", "x", 1)]
    got = packing.pack(spark.createDataFrame(rows, DOCS).repartition(6), PATH, length).collect()
    # Pieces of a document: those of equal ids are told apart by their place.
    expected = defaultdict(list)
    for i, t, *_ in rows:
        expected[i].append(tokens(t))
    spread = defaultdict(list)
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        spread[r["doc_id"]].append((r["start"], ids, r["doc_tokens"]))
    for i, copies in expected.items():
        joined = sorted(spread[i])
        assert sum(len(x) for _, x, _ in joined) == sum(map(len, copies))
        assert {n for *_, n in joined} == set(map(len, copies))
        if len(copies) == 1:
            assert list(itertools.chain.from_iterable(x for _, x, _ in joined)) == copies[0]
            assert [s for s, _, _ in joined] == list(np.cumsum([0] + [len(x) for _, x, _ in joined])[:-1])
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    sizes = []
    for _, parts in sorted(sequences.items()):
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        sizes.append(at)
    whole = sum(len(x) for c in expected.values() for x in c)
    assert sizes[: whole // length] == [length] * (whole // length)
    rest = sizes[whole // length :]
    assert rest == sorted(rest, reverse=True) and all(n & (n - 1) == 0 and n < length for n in rest) and len(set(rest)) == len(rest)


def test_empty_table_and_bad_length(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([], DOCS), PATH, 1000)


def test_the_curve_visits_every_cell_once_step_by_step(monkeypatch):
    monkeypatch.setattr(packing, "BITS", 3)
    cells = np.array(list(itertools.product(range(8), repeat=3)), np.uint64)
    keys = packing.hilbert(cells)
    assert sorted(keys.tolist()) == list(range(8**3))
    path = cells[np.argsort(keys)].astype(int)
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_like_documents_are_neighbours():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 400, 600), rng.integers(400, 800, 600)
    near = a.copy()
    near[:5] = 7
    lengths = np.array([600] * 3)
    cells = packing.points(np.concatenate([a, near, b]), lengths, packing.directions(800)).astype(int)
    assert np.abs(cells[0] - cells[1]).max() < np.abs(cells[0] - cells[2]).max()


def test_no_sequence_holds_two_values_of_a_column(spark):
    rows = [(i, f"document {i} " * (i % 9 + 1), ["de", "en", None][i % 3], 1) for i in range(150)] + [(900, "words " * 3_000, "en", 1), (901, "", "xx", 1)]
    of = {i: k for i, _, k, _ in rows}
    got = packing.pack(spark.createDataFrame(rows, DOCS).repartition(6), PATH, 64, by="key").collect()
    spread, values, sizes = defaultdict(list), defaultdict(set), defaultdict(list)
    for r in got:
        spread[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
        values[r["sequence_id"]].add(of[r["doc_id"]])
        sizes[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {i: list(itertools.chain.from_iterable(x for _, x in sorted(p))) for i, p in spread.items()} == {i: tokens(t) for i, t, *_ in rows}
    assert sorted(values) == list(range(len(values))) and all(len(v) == 1 for v in values.values())
    ends = {s: [0, *itertools.accumulate(n for _, n in sorted(p))] for s, p in sizes.items()}
    assert all([o for o, _ in sorted(p)] == ends[s][:-1] for s, p in sizes.items())
    lengths = defaultdict(list)
    for s, (v,) in sorted(values.items()):
        lengths[v].append(ends[s][-1])
    for v, found in lengths.items():
        whole = sum(len(tokens(t)) for _, t, k, _ in rows if k == v)
        rest = found[whole // 64 :]
        assert found[: whole // 64] == [64] * (whole // 64) and sum(rest) == whole % 64
        assert rest == sorted(rest, reverse=True) and all(n & (n - 1) == 0 for n in rest) and len(set(rest)) == len(rest)
