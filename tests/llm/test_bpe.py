"""Encoding against the tokenizers library, and the exact round trip."""

import random

import numpy as np
import pytest
import public_tokenizers
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fairwait.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
CASES = [
    "", " ", "\n\n  x", "It's we'll they'd", "a<|endoftext|> b<|endoftext|><|endoftext|>", "ab" * 3000, "a" * 1001, "  trailing  ",
    "naïve café — 東京 🙂🙂 ٣٤ \x1c\x85᠎", "\x00\x01", "x" * 70 + "y" * 70, "1234567890" * 20, "=" * 300,
    "".join(random.Random(1).choice("abcdefghij") for _ in range(5000)),
]


def mine(texts):
    return [np.frombuffer(x, np.int32).tolist() for x in bpe.vocabulary(PATH).encode(texts)]


@pytest.mark.parametrize("text", CASES)
def test_like_the_library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert mine([text]) == [ids]
    assert bpe.vocabulary(PATH).decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.one_of(st.text(max_size=60), st.text("aeinrsthlo 'THE01.\n", max_size=80)))
def test_random_texts(text):
    assert mine([text])[0] == LIBRARY.encode(text, add_special_tokens=False).ids


def test_speculation_and_exact_merging_agree():
    v = bpe.vocabulary(PATH)
    rng = random.Random(3)
    words = ["".join(rng.choice("aeinrsthlo") for _ in range(rng.randint(1, 14))).encode() for _ in range(800)]
    batch = v.exact_batch(words)
    owner, ids, none = v.propose_batch(words)
    assert not none.any() and [ids[owner == i].tolist() for i in range(len(words))] == [v.propose(w) for w in words]
    for word, found in zip(words, batch):
        found = np.frombuffer(found, np.int32)
        assert v.exact(word) == found.tolist()
        guess = v.propose(word)
        pairs = np.array(list(zip(guess, guess[1:])), dtype=np.int64).reshape(-1, 2)
        assert bool(v.apart(pairs[:, 0], pairs[:, 1]).all()) == (guess == found.tolist())


def test_batches_are_cut_as_text_by_text():
    v, rng = bpe.vocabulary(PATH), random.Random(7)
    parts = [*"  \t\n\r\x00'stremvld.S19é中１²’🙂𝒜İ", "'s", "'re", "'ll", " 've", "\u2003"]
    for _ in range(500):
        batch = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(rng.randint(0, 12))]
        code, met, cuts = v.cut_all(batch)
        assert [[met[c] for c in code[a:z]] for a, z in zip(cuts, cuts[1:])] == [v.cut_up(t) for t in batch]


def test_texts_are_cut_together_but_for_special_tokens_and_long_ones(monkeypatch):
    v, cut = bpe.vocabulary(PATH), []
    monkeypatch.setattr(v, "cut_up", lambda text: cut.append(text) or type(v).cut_up(v, text))
    assert mine(["one text", "", "it's  another\n"]) == [LIBRARY.encode(t, add_special_tokens=False).ids for t in ("one text", "", "it's  another\n")]
    assert cut == []
    monkeypatch.setattr(bpe, "_WHOLE_CHARS", 20)
    for texts in (["x<|endoftext|>"], ["a text of more than 20 characters"]):
        assert mine(texts) == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(cut) == 2


def test_table_of_numbers():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 3000))
    table = bpe.Table(keys, np.arange(len(keys)))
    assert (table.get(keys) == np.arange(len(keys))).all() and (table.get(keys[:-1][np.diff(keys) > 1] + 1) == -1).all()


def test_any_ids_decode_like_the_library():
    rng = random.Random(5)
    for _ in range(50):
        ids = [rng.randrange(50257) for _ in range(20)]
        assert bpe.vocabulary(PATH).decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_the_store_of_words_stays_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_WORDS", 50)
    v = bpe.Vocabulary(PATH)
    for i in range(20):
        text = " ".join(f"w{i}x{j}" for j in range(20))
        assert np.frombuffer(v.encode([text])[0], np.int32).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
        assert len(v.words) < 200


def test_frames(spark):
    long = "word " * 60_000
    rows = [(1, "same text", "keep"), (1, "same text", "keep"), (2, None, None), (3, "", "e"), (None, long, "l")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, decoded string")
    coded = bpe.encode(df, PATH)
    assert coded.columns == ["doc_id", "decoded", "ids"]
    back = bpe.decode(coded, PATH).collect()  # the clashing column is replaced
    assert sorted((r["doc_id"] or 0, r["decoded"]) for r in back) == sorted([(1, "same text")] * 2 + [(2, ""), (3, ""), (0, long)])
    assert {len(r["ids"]) for r in back if r["doc_id"] in (2, 3)} == {0}
    assert bpe.decode(bpe.encode(df.filter("false"), PATH, keep_text=True), PATH).columns == ["doc_id", "text", "ids", "decoded"]
    assert bpe.encode(df.filter("false"), PATH).count() == 0
