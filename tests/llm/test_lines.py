"""Line dedup against a plain version, and what it must and must not delete."""

import random

import pytest

from fairwait.llm import line_dedup

DOCS = "doc_id bigint, text string, n_dropped string, _id string"
BLANK = " \t\r\f\x0b"


def words(line):
    return len(line.split())


def plain(rows, noise, guarantee):
    """Per document, in order: its non-blank lines, and its windows of ``guarantee`` and of ``noise`` words that stand earlier."""
    docs = {(i, t): [x.strip(BLANK) for x in t.split("\n") if x.strip(BLANK)] for i, t, *_ in rows if t is not None}
    seen, out = set(), {}
    for d in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        lines, found = docs[d], {noise: [], guarantee: []}
        for p in range(len(lines)):
            for level in (guarantee, noise):
                n, q = 0, p
                while q < len(lines) and n < level:
                    n += words(lines[q])
                    q += 1
                if n >= level:
                    gram = (level, *lines[p:q])
                    if gram in seen:
                        found[level].append(range(p, q))
                    seen.add(gram)
        out[d] = (lines, found[guarantee], found[noise])
    return out


def corpus(seed):
    rng = random.Random(seed)
    sentence = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    passages = ["\n".join(sentence(rng.choice([3, 9, 20, 55])) for _ in range(rng.randint(1, 6))) for _ in range(8)]
    passages.append(sentence(51))
    rows = []
    for i in range(60):
        parts = [sentence(rng.choice([2, 8, 30, 60])) for _ in range(rng.randint(1, 6))]
        for _ in range(rng.randint(0, 3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(passages))
        parts.insert(rng.randrange(len(parts) + 1), rng.choice(["", "All rights reserved.", "   "]))
        rows.append((i, "\n".join(parts), "x", "y"))
    line = sentence(4)
    rows += [(200, "\n".join([line] * 900), "x", "y"), (201, None, "x", "y"), (202, "", "x", "y"), (203, "\n \n", "x", "y")]
    return rows + [rows[3], rows[3], (None, rows[8][1], "x", "y"), (300, " " + rows[9][1].replace("\n", "\r\n"), "x", "y")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_guarantees(spark, seed):
    noise, guarantee = 40, 50
    rows = corpus(seed)
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    keyed = df.filter("text IS NOT NULL").selectExpr("doc_id IS NULL AS none", "coalesce(doc_id, 0) AS id", "xxhash64(text) AS mark", "text")
    key = ["none", "id", "mark"]
    gone = {}
    for r in line_dedup.repeats(line_dedup.grams(keyed, key, "text", noise, guarantee), key, noise, guarantee).collect():
        gone.setdefault(None if r["none"] else r["id"], set()).add(r["pos"] - 1)
    before = set()
    for (i, text), (lines, must, sure) in plain(rows, noise, guarantee).items():
        mine = gone.get(i, set())
        for window in must:  # a fingerprint of ``noise`` words lies inside, so that much goes
            assert sum(words(lines[k]) for k in window if k in mine) >= noise, (i, window)
        if not sure:
            assert not mine, i
        for k in mine:  # whatever goes stands earlier
            assert lines[k] in before or lines.index(lines[k]) < k
        before |= set(lines)
    texts = {}
    for r in line_dedup.dedup_lines(df, noise=noise, guarantee=guarantee).collect():
        texts.setdefault(r["doc_id"], set()).add((r["text"], r["n_dropped"]))
    for i, t, *_ in rows:
        mine = gone.get(i, set())
        kept, pos = [], 0
        for x in (t or "").split("\n"):
            kept += [x] if not x.strip(BLANK) or pos not in mine else []
            pos += bool(x.strip(BLANK))
        assert texts[i] == {(None if t is None else "\n".join(kept), len(mine))}


def test_long_passages_go_and_short_lines_stay(spark):
    passage = " ".join(f"p{i}" for i in range(51))
    notice = "Licensed under the MIT License."
    rows = [(i, f"{notice}\nown words of document {i}\n{passage}", "x", "y") for i in range(200)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[0] == rows[0][1]
    assert all(got[i] == f"{notice}\nown words of document {i}" for i in range(1, 200))


def test_runs_are_extended_over_short_neighbours(spark):
    run = "\n".join(["head one", " ".join(f"a{i}" for i in range(45)), "tail two", "tail three"])
    rows = [(1, "x\n" + run + "\ny", "x", "y"), (2, "other\n" + run + "\nelse", "x", "y")]
    got = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("other\nelse", 4)}


def test_native_plan_and_empty_table(spark):
    df = line_dedup.dedup_lines(spark.createDataFrame(corpus(1), DOCS))
    plan = df._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    assert line_dedup.dedup_lines(spark.createDataFrame([], DOCS)).count() == 0
