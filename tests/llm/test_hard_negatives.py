"""Hard negatives against brute force, their intervals, and their SQL."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairwait.llm import hard_negatives as hn
from fairwait.llm import queries
from tests import oracle

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id bigint, v array<double>, label int, rank string, codes int"


def brute(rows, anchor, width, n_positives, n_negatives, low, high):
    known = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        known[i] = min(known.get(i, (label, v)), (label, v))
    known = {i: (label, [int(x) for x in v] + [0] * (width - len(v))) for i, (label, v) in known.items()}
    out = []
    for a, (label, v) in known.items():
        if not anchor(a):
            continue
        scores = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in known.items() if i != a)
        for ps, p, _ in [s for s in scores if s[2] == label][:n_positives]:
            fit = [(-s, i) for s, i, other in scores if other != label and low * -ps <= 100 * -s <= high * -ps]
            out += [(a, p, n + 1, i, -ps, s) for n, (s, i) in enumerate(fit[:n_negatives])]
    return sorted(out)


def vectors(n=400, width=20, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, width)) * 20
    rows = [(i, np.floor(centres[rng.integers(0, 4)] + rng.standard_normal(width) * 30).tolist(), int(rng.integers(0, 3)), "x", 1) for i in range(n)]
    rows += [(n + i, rows[5][1], i % 3, "copy", 1) for i in range(60)]  # one vector many times
    odd = [(900, None, 1, "a", 1), (901, [float("nan")] * width, 1, "b", 1), (902, [None] + [1.0] * (width - 1), 1, "c", 1), (903, [float("inf")] * width, 1, "d", 1),
           (904, [0.0] * width, 1, "zero", 1), (None, [1.0] * width, 1, "no id", 1), (0, [9.0] * width, 0, "again", 1), (905, [90.0, 20.0], 2, "short", 1),
           (906, [], 2, "empty", 1), (907, [50.0] * width, None, "no label", 1), (908, [70.0] * width, 77, "alone", 1), (910, [60.0] * width, 78, "alone", 1)]
    return rows + odd


@pytest.mark.parametrize("cell", [1 << 20, 400])
@pytest.mark.parametrize("low,high", [(30, 90), (-50, 100)])
def test_equals_brute_force(spark, cell, low, high):
    rows = vectors()
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    got = hn.mine(df, F.col("vec_id") % 5 == 0, low=low, high=high, cell=cell)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, lambda i: i % 5 == 0, 20, 5, 10, low, high)


def test_large_numbers_few_and_no_rows(spark):
    rows = [(0, [2.0**31, 1.0], 1, "", 1), (1, [2.0**31 - 1, 3.0], 1, "", 1), (2, [2.0**30 + 1, 5.0], 2, "", 1), (3, [2.0**30 + 1, 5.0], 2, "", 1)]
    df = spark.createDataFrame(rows, VECTORS)
    assert sorted(tuple(r) for r in hn.mine(df, F.lit(True)).collect()) == brute(rows, lambda i: True, 2, 5, 10, 30, 90)
    assert hn.mine(df.filter("vec_id = 0"), F.lit(True)).count() == 0
    assert hn.mine(df, F.lit(False)).count() == 0
    assert hn.mine(df.filter("false"), F.lit(True)).count() == 0


def side(v, levels):
    codes, aligned, lengths = hn.encode(v, hn.rotation(v.shape[1]), levels)
    made = hn.Side.__new__(hn.Side)
    made.ids, made.vectors, made.codes, made.aligned, made.lengths = np.arange(len(v)), v, codes, aligned, lengths
    return made


@pytest.mark.parametrize("width", [1, 64, 100])
def test_intervals_hold_and_shrink(width):
    rng = np.random.default_rng(width)
    v = np.floor(rng.standard_normal((500, width)) * 100)
    v[7] = 0
    assert np.allclose(np.linalg.norm(hn.rotate(v, hn.rotation(width)), axis=1), np.linalg.norm(v, axis=1))
    q, p = side(v, hn.ANCHOR_LEVELS), side(v, hn.LEVELS)
    for i in (0, 7, 33):
        level, widths = hn.intervals(q, i, p, np.arange(500)), []
        rows, low, high = next(level)
        while True:
            exact = v[rows] @ v[i]
            assert (low <= exact).all() and (exact <= high).all()
            widths.append(float(np.median(high - low)))
            try:
                rows, low, high = level.send(np.arange(len(rows)))
            except StopIteration:
                break
        assert widths == sorted(widths, reverse=True)
        if i != 7 and width > 1:
            assert widths[-1] < 0.25 * widths[0]


def test_few_candidates_are_scored(monkeypatch):
    """Intervals decide most: of 20,000 vectors under a tenth is scored for an anchor's five best."""
    rng = np.random.default_rng(5)
    v = np.floor(rng.standard_normal((20_000, 64)) * 100)
    q, p, n = side(v[:20], hn.ANCHOR_LEVELS), side(v, hn.LEVELS), []
    plain = hn.scored
    monkeypatch.setattr(hn, "scored", lambda q, i, p, rows: n.append(len(rows)) or plain(q, i, p, rows))
    for i in range(20):
        at, scores = hn.nearest(q, i, p, np.flatnonzero(p.ids != i), 5)
        exact = np.sort(np.delete(v @ v[i], i))[::-1][:5]
        assert scores.tolist() == exact.tolist()
    assert sum(n) < 0.1 * 20 * 20_000


def test_equals_sql(spark):
    df, sql = queries.QUERIES["op11_hard_negatives"](spark, SF), queries.ORACLE["op11_hard_negatives"]
    assert oracle.difference(oracle.spark_result(df), oracle.duck_result(oracle.connect(SF), sql)) is None
