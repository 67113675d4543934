"""Near-duplicates against all pairs, and the registers' estimates."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from fairwait.llm import graph, near_dedup

DOCS = "doc_id bigint, text string, node string, component_id int"


def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1)))


def brute(rows, words, percent):
    sets = [shingles(t, words) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            m = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * m >= percent * (len(sets[a]) + len(sets[b]) - m):
                root[find(a)] = find(b)
    out = []
    for k, (i, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        out.append((i, len(sets[k]), min(ids) if ids else None))
    return out


def corpus(seed=4):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(6):  # families of edited copies around the threshold
        base = [rng.choice(vocabulary) for _ in range(rng.choice([20, 60, 150]))]
        for _ in range(22):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 18))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    chain = [rng.choice(vocabulary) for _ in range(80)]  # each like the one before, the ends unlike
    for k in range(12):
        chain[k * 6] = f"new{k}"
        texts.append("\n".join(chain))
    texts += [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 40))) for _ in range(30)]
    texts += ["Same Text\there", "same text here", "SAME  text here", None, "", " \n ", "one", "One", "É é", "é é"]
    rng.shuffle(texts)
    rows = [(i * 3, t, "x", 7) for i, t in enumerate(texts)]
    return rows + [rows[0], rows[5], (3, "no copy of any other text at all", "x", 7), (None, texts[10], "x", 7), (None, "alone without an id here", "x", 7)]


def test_components_equal_all_pairs(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, DOCS).repartition(7)
    for words, percent in ((4, 80), (5, 80), (2, 90)):
        got = near_dedup.near_groups(df, words=words, percent=percent)
        assert got.columns == ["doc_id", "text_hash", "n_shingles", "component_id", "kept"]
        found = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=repr)
        assert found == sorted(brute(rows, words, percent), key=repr)
        kept = {(r["doc_id"], r["component_id"], r["kept"]) for r in got.collect()}
        assert all(k == (i == c) for i, c, k in kept if c is not None)
        assert all(k for i, c, k in kept if c is None)


def test_a_large_family_of_copies(spark):
    rng = random.Random(9)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(300):
        copy = list(base)
        for at in rng.sample(range(100), i % 7):
            copy[at] = f"n{rng.randrange(40)}"
        rows.append((i, " ".join(copy), "x", 0))
    rows += [(1000 + i, " ".join(base), "x", 0) for i in range(400)]
    got = near_dedup.near_groups(spark.createDataFrame(rows, DOCS), words=4, percent=80)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == sorted(brute(rows, 4, 80))


def test_empty_table_and_no_links(spark):
    df = spark.createDataFrame([], DOCS)
    assert near_dedup.near_groups(df).count() == 0
    alone = spark.createDataFrame([(1, "a b c", "x", 0), (2, None, "x", 0)], DOCS)
    assert sorted(tuple(r)[2:] for r in near_dedup.near_groups(alone).collect()) == [(0, 2, True), (1, 1, True)]


def test_very_long_text(spark):
    long = " ".join(f"word{i % 7919} x{i}" for i in range(60_000))
    rows = [(1, long, "x", 0), (2, long + " end", "x", 0)]
    got = near_dedup.near_groups(spark.createDataFrame(rows, DOCS), words=4)
    assert {(r["doc_id"], r["component_id"]) for r in got.collect()} == {(1, 1), (2, 1)}


def test_estimates_follow_the_similarity():
    rng = np.random.default_rng(2)
    for share in (0.0, 0.5, 0.8, 1.0):
        a, b = [], []
        for _ in range(30):
            both = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
            m = round(300 * 2 * share / (1 + share))
            a.append(both)
            b.append(np.concatenate([both[:m], rng.integers(0, 1 << 63, 300 - m, dtype=np.uint64)]))
        n = np.full(30, 300.0)
        found = near_dedup.estimates(near_dedup.registers(a), near_dedup.registers(b), n, n)
        assert abs(found.mean() - share) < 0.03 and abs(found - share).max() < 0.17


def test_registers_merge():
    rng = np.random.default_rng(3)
    a, b = (rng.integers(0, 1 << 63, 500, dtype=np.uint64) for _ in range(2))
    merged = near_dedup.registers([np.concatenate([a, b])])
    assert (merged == np.maximum(near_dedup.registers([a]), near_dedup.registers([b]))).all()


def test_components_of_a_graph(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(50)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    links += [(7, 7), (500, 499)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(links, "a int, b int"), "a", "b").collect()}
    root = {x: x for pair in links for x in pair}
    for _ in range(100):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: root[x] for x in linked}
    assert graph.components(spark.createDataFrame([], "a int, b int"), "a", "b").count() == 0


def test_tables_between_steps_are_not_broadcast(spark, monkeypatch):
    plans = {}

    def kept(df, name):
        out = stored(df, name)
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return out

    stored = near_dedup.stored
    for module in (graph, near_dedup):
        monkeypatch.setattr(module, "stored", kept)
    rng = random.Random(2)
    base = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(80)) for _ in range(6)]
    rows = [(i, base[i % 6] + f" more{i // 12}", None, None) for i in range(36)]
    found = near_dedup.near_groups(spark.createDataFrame(rows, DOCS), words=4)
    assert found.select("component_id").distinct().count() == 6
    # Texts are met with the documents that are asked for; that side is short rows and may be small.
    assert {"links", "stars", "likely", "measured", "roots", "contested"} <= set(plans)
    assert [n for n, some in plans.items() if n != "sets" and any("Broadcast" in p for p in some)] == []
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
