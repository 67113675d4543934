"""Language by held-out accuracy, and defined results for odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairwait.llm import langid
from fairwait.llm.queries import op4_language

DOCS = "doc_id bigint, text string, lang string, score string, lang_pred int"


def corpus():
    words = {"en": "the and of shore thing with that other", "fr": "été où que très après dans leur être", "de": "über die straße und mit nicht größe für"}
    rng = np.random.default_rng(3)
    rows = []
    for i in range(240):
        lang = list(words)[i % 3]
        rows.append((i, " ".join(rng.choice(words[lang].split(), 12)), lang, "x", 1))
    return rows


def test_held_out_accuracy_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    got = op4_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    asked = [r for r in got if r["held_out"] and r["lang"] is not None]
    assert sum(r["lang_pred"] == r["lang"] for r in asked) / len(asked) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def test_odd_rows(spark):
    odd = [(500, None, "en", "x", 1), (501, "", "en", "x", 1), (502, "12 + 34 ?!", None, "x", 1), (None, "the shore and the thing", None, "x", 1),
           (503, "the other thing with that " * 20_000, "fr", "x", 1), (504, "où", None, "x", 1), (5, "même id", None, "x", 1)]
    df = spark.createDataFrame(corpus() + odd + odd[3:4], DOCS).repartition(4)
    model = langid.fit(df, ~langid.held_out())
    got = langid.predict(df, model)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    by = {}
    for r in got.collect():
        by.setdefault(r["doc_id"], set()).add((r["lang_pred"], r["score"]))
    assert by[500] == by[501] == by[502] == {("und", 0.0)}
    assert [x for x, _ in by[None]] == ["en"] and [x for x, _ in by[503]] == ["en"] and [x for x, _ in by[504]] == ["fr"]


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "some words", None, "x", 1)], DOCS)
    assert [(r["lang_pred"], r["score"]) for r in langid.predict(df, langid.fit(df, F.lit(True))).collect()] == [("und", 0.0)]
    empty = df.filter("false")
    assert langid.predict(empty, langid.fit(empty, F.lit(True))).count() == 0
    one = spark.createDataFrame([(i, "only english here", "en", "x", 1) for i in range(5)], DOCS)
    assert {r["lang_pred"] for r in langid.predict(one, langid.fit(one, F.lit(True))).collect()} == {"en"}


def test_accepted_keeps_rows_as_they_are(spark):
    df = spark.createDataFrame([*corpus(), (700, "!!", "en", "kept?", 2)], DOCS)
    got = langid.accepted(df, 0.2)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.filter("doc_id <> 700").collect()))


def test_the_sample_is_bounded_and_the_kernel_counts_shared_grams(spark, monkeypatch):
    monkeypatch.setattr(langid, "ROWS_PER_LANGUAGE", 7)
    df = spark.createDataFrame(corpus(), DOCS)
    assert len(langid.fit(df, F.lit(True)).landmarks) <= 21 * langid.WIDTH // 8
    a, b = langid.presence(["abc"]), langid.presence(["abd"])
    grams = lambda w: {f" {w} "[i : i + n] for n in (1, 2, 3) for i in range(len(w) + 3 - n)} - {" "}
    assert a.sum() == len(grams("abc"))
    assert langid.normalised(a, b.astype(np.float32))[0, 0] == pytest.approx(len(grams("abc") & grams("abd")) / len(grams("abc")))
    assert (langid.presence(["Ab  1 c"]) == langid.presence(["ab\nC"])).all()


def test_accepted_drops_unlearned_scripts_and_noise_but_no_clean_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    held = docs.filter(langid.held_out() & F.col("lang").isNotNull())
    words = sorted({r["text"].split()[0] for r in held.collect()})
    assert len(words) > 20
    odd = ["Это русский текст о погоде и природе", "Москва", "这是一个中文句子，关于天气", "日本語のテキストです", "שלום עולם", "asdkjfh qwoeiru zxmcnbv",
           "xkcd zzxqj vbnmkl", "qwrtzpsdfg hjklyxcvbnm " * 50]
    rows = [(-1 - i, t, None) for i, t in enumerate(words + odd)]
    rows.append((-99, "Это русский текст", "en"))  # a wrong label alone makes nothing known
    got = langid.accepted(docs.union(spark.createDataFrame(rows, docs.schema)), 0.8).collect()
    assert sorted(r["text"] for r in got if r["doc_id"] < 0) == words
    assert sum(r["doc_id"] >= 0 for r in got) == docs.count()


def test_many_rows_of_one_id_leave_the_other_languages_in(spark, monkeypatch):
    monkeypatch.setattr(langid, "ROWS_IN_ALL", 30)
    # The copies come first, far more than the sample has rows.
    rows = [(0, "the shore and the thing", "en", "x", 1)] * 2000 + corpus()
    df = spark.createDataFrame(rows, DOCS).coalesce(1)
    model = langid.fit(df, F.lit(True))
    assert model.languages == ["de", "en", "fr"] and model.landmarks == langid.fit(df.orderBy(F.desc("doc_id")), F.lit(True)).landmarks
    assert len(model.landmarks) == 30 * langid.WIDTH // 8


@pytest.mark.parametrize("sf, floor", [("0.01", 0.8), ("0.1", 0.8)])
def test_accepted_drops_unlearned_languages_in_the_learned_script(spark, sf, floor):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet").select("doc_id", "text", "lang")
    unlearned = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
        "Alla människor är födda fria och lika i värde och rättigheter. De har utrustats med förnuft och samvete.",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler.",
        "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván.",
    ]
    # Sentences in learned languages from outside the tables.
    learned = [
        "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience.",
        "Alle Menschen sind frei und gleich an Würde und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt.",
        "Tous les êtres humains naissent libres et égaux en dignité et en droits. Ils sont doués de raison et de conscience.",
    ]
    rows = [(-1 - i, t, None) for i, t in enumerate(unlearned + learned)]
    got = langid.accepted(docs.union(spark.createDataFrame(rows, docs.schema)), floor)
    found = [r["text"] for r in got.filter("doc_id < 0").collect()]
    assert sorted(found) == sorted(learned)
    letters = docs.filter(F.col("text").rlike(r"\p{L}")).count()
    assert got.filter("doc_id >= 0").count() == letters


def test_scores_equal_a_plain_kernel_ridge(spark):
    """An independent version: n-gram sets of Python strings, and ridge regression over all landmarks by its normal equations."""
    rows = [(t, x) for _, t, x, *_ in corpus()][:90]
    asked = ["the shore and that", "straße und größe", "très où leur", "the été mit"]

    def grams(text):
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        joined = " " + " ".join(words) + " "
        return {joined[i : i + n] for n in (1, 2, 3) for i in range(len(joined) + 1 - n)} - {" "}

    kernel = lambda xs, ys: np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in ys] for a in xs])
    marks = [grams(t) for t, _ in rows]
    languages = sorted({x for _, x in rows})
    y = np.array([[float(x == l) for l in languages] for _, x in rows])
    k, one = kernel(marks, marks), np.full(len(rows), 1 / len(rows))
    # All rows are landmarks and languages weigh the same, so dual weights a and a bias solve the centred problem.
    centred = k - one @ k
    dual = np.linalg.lstsq(centred.T @ centred / len(rows) + langid.RIDGE / len(languages) * k, centred.T @ (y - one @ y) / len(rows), rcond=1e-12)[0]
    plain = kernel([grams(t) for t in asked], marks) @ dual + one @ y - one @ k @ dual
    model = langid.learn(langid.sets([t for t, _ in rows]), [x for _, x in rows])
    got = model.scores(langid.presence(asked))
    assert np.abs(got - plain).max() < 0.02
    assert (got.argmax(1) == plain.argmax(1)).all()


def test_a_sure_prediction_takes_the_place_of_the_label(spark):
    rows = corpus()
    odd = [(700, rows[0][1], None, "x", 1), (701, rows[0][1], "fi", "x", 1), (702, rows[0][1].split()[0], "zz", "x", 1)]
    df = spark.createDataFrame(rows + odd, DOCS)
    model = langid.fit(df, ~langid.held_out())
    said = {r["doc_id"]: r for r in langid.predict(df, model).collect()}
    edge = (said[700]["score"] + said[702]["score"]) / 2
    assert said[702]["score"] < edge <= said[700]["score"]
    got = langid.accepted(df, 0.0, sure=edge)
    assert got.schema == df.schema
    expected = {i: said[i]["lang_pred"] if said[i]["score"] >= edge else lang for i, _, lang, *_ in rows + odd}
    assert {r["doc_id"]: r["lang"] for r in got.collect()} == expected
    assert expected[700] == expected[701] == rows[0][2] and expected[702] == "zz"
