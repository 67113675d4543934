"""Language of texts by a string kernel.

A text is the set of its letter n-grams (a blended spectrum: lengths 1 to 3, presence only, hashed to ``WIDTH`` places).
The kernel of two texts is the size of their sets' intersection over the root of the product of their sizes. Nyström landmarks turn it into
features, on which ridge regression learns one score per language against the rest. Whole batches of texts are
scored by matrix products.

The scores of all languages add up to 1, so the best one cannot tell an unknown text. That is told by the share of a text's
n-grams that two rows or more of the sample have, hashed to eight times as many places: a language or script that was not learned, or
noise, has fewer of them. The rows of the sample, each measured by the others, tell how many a known text has.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import give_back, slices, texts, tidy

GRAMS = 3
WIDTH = 1 << 15
LANDMARKS = 96
RIDGE = 1e-3
# Labelled rows to fit on, at most: for one language, and in all. More languages than rows in all are not learned.
ROWS_PER_LANGUAGE = 400
ROWS_IN_ALL = 4096
UNKNOWN = "und"
# A known text's share of known n-grams: what so large a part of the sample's rows reach, each measured by the others.
CLEAN = 0.99
_TEXTS = 64  # texts in a matrix product
_RANGE_BITS = 52  # of 64: hashed ids fall into 4,096 ranges
_STEP = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For every code point its lower-case letter, 0 where it is none."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def sets(batch: list[str]) -> np.ndarray:
    """One row of ``WIDTH`` bytes per text: the n-grams of its words (runs of letters, with one blank on either side).

    Each n-gram sets a bit of a byte. The kernel counts bytes, known n-grams are told by bits.
    """
    out = np.zeros((len(batch), WIDTH), np.uint8)
    table, bits = letters(), np.zeros(8 * WIDTH, np.uint8)
    for row, text in zip(out, batch):
        code = table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
        code = np.r_[np.uint32(0), code, np.uint32(0)]
        # Blanks in a row count once.
        code = code[np.r_[True, (code[1:] > 0) | (code[:-1] > 0)]].astype(np.uint64)
        if len(code) < 3:
            continue
        bits[:] = 0
        with np.errstate(over="ignore"):
            gram = code + np.uint64(1)
            for n in range(1, GRAMS + 1):
                if n > 1:
                    gram = gram[:-1] * _STEP + code[n - 1 :] + np.uint64(n)
                place = (gram * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - 18)
                bits[place if n > 1 else place[code > 0]] = 1
        row[:] = np.packbits(bits)
    return out


def presence(batch: list[str]) -> np.ndarray:
    """``sets`` as 0 and 1 per byte, as the kernel takes them."""
    return (sets(batch) > 0).view(np.uint8)


@dataclass
class Model:
    languages: list[str]
    landmarks: bytes  # packed rows of 0 and 1
    weights: np.ndarray  # landmarks x languages
    bias: np.ndarray
    known: bytes  # a bit per n-gram: whether two rows or more have it
    clean: float  # share of known n-grams that nearly all rows reach

    def kernel(self, x: np.ndarray) -> np.ndarray:
        marks = np.unpackbits(np.frombuffer(self.landmarks, np.uint8).reshape(-1, WIDTH // 8), axis=1).astype(np.float32)
        return normalised(x, marks)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.kernel(x) @ self.weights + self.bias

    def familiar(self, x: np.ndarray) -> np.ndarray:
        """Share of known n-grams in each row of ``sets``."""
        return share(x, np.frombuffer(self.known, np.uint8))


def share(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x & known).sum(1, dtype=np.float64) / np.maximum(np.bitwise_count(x).sum(1, dtype=np.float64), 1)


def normalised(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x = x.astype(np.float32)
    both = (x @ y.T).astype(np.float64)
    return both / np.sqrt(np.maximum(x.sum(1, dtype=np.float64), 1)[:, None] * np.maximum(y.sum(1, dtype=np.float64), 1)[None, :])


def learn(found: np.ndarray, labels: list[str], ridge: float = RIDGE, landmarks: int = LANDMARKS) -> Model:
    """Nyström features and one-versus-rest kernel ridge regression on rows of ``sets``; no rows give a model without languages."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], b"", np.zeros((0, 0)), np.zeros(0), bytes(WIDTH), 0.0)
    # What one row alone has is not known, so every row is measured by the others.
    once, twice = np.zeros(WIDTH, np.uint8), np.zeros(WIDTH, np.uint8)
    for row in found:
        twice |= once & row
        once |= row
    clean = float(np.quantile([share(row[None, :], twice)[0] for row in found], 1 - CLEAN, method="lower"))
    # Landmarks: the languages in turn, in the order of the sample.
    turn, seen = [], dict.fromkeys(languages, 0)
    for x in labels:
        turn.append(seen[x])
        seen[x] += 1
    chosen = sorted(range(len(labels)), key=lambda i: (turn[i], labels[i]))[:landmarks]
    marks = (found[chosen] > 0).view(np.uint8)
    # A few rows at once: as numbers the whole sample would take four times its size.
    x = np.concatenate([normalised(found[at : at + _TEXTS] > 0, marks.astype(np.float32)) for at in range(0, len(found), _TEXTS)])
    values, vectors = np.linalg.eigh(normalised(marks, marks.astype(np.float32)))
    root = vectors @ np.diag(np.where(values > 1e-6, 1 / np.sqrt(np.maximum(values, 1e-6)), 0)) @ vectors.T
    z = x @ root
    y = np.array([[float(a == b) for b in languages] for a in labels])
    # Every language weighs the same, however many rows it has.
    weight = np.array([1 / seen[a] for a in labels])[:, None]
    weight /= weight.sum()
    z_mean, y_mean = (weight * z).sum(0), (weight * y).sum(0)
    zc, yc = z - z_mean, y - y_mean
    solved = np.linalg.solve(zc.T @ (weight * zc) + ridge / len(languages) * np.eye(z.shape[1]), zc.T @ (weight * yc))
    return Model(languages, np.packbits(marks, axis=1).tobytes(), root @ solved, y_mean - z_mean @ solved, twice.tobytes(), clean)


def fit(docs: DataFrame, usable: Column, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model from rows that are ``usable`` and have id, text and language.

    The sample is bounded: per language the ``ROWS_PER_LANGUAGE`` rows whose hashed id comes first, ``ROWS_IN_ALL`` in
    all. Only their n-gram sets come to the driver, of fixed size whatever the texts' length, and one for each of these ids and
    languages: of several texts the one whose set is the least as bytes.
    """
    good = F.coalesce(usable, F.lit(False)) & F.col(id_col).isNotNull() & F.col(lang).isNotNull() & F.col(text).isNotNull()
    order = F.xxhash64(F.col(id_col))
    ranked = docs.filter(good).select(F.col(id_col).alias("id"), F.col(lang).alias("lang"), order.alias("order")).distinct()
    # Counts per range of the order tell which ranges hold a language's first rows, so that no more than these are ranked.
    ranked = ranked.withColumn("range", F.shiftright("order", _RANGE_BITS))
    counted = ranked.groupBy("lang", "range").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    first = counted.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < ROWS_PER_LANGUAGE).select("lang", "range")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order", "id"))
    ranked = ranked.join(first, ["lang", "range"]).withColumn("rank", rank).filter(F.col("rank") <= ROWS_PER_LANGUAGE)
    chosen = ranked.orderBy("rank", "lang").limit(ROWS_IN_ALL)
    taken = chosen.select("id", "order", "lang").collect()
    ids, pairs = sorted({r["id"] for r in taken}), {(r["order"], r["lang"]) for r in taken}
    if not ids:
        return learn(np.zeros((0, WIDTH), np.uint8), [])
    sample = docs.filter(good & F.col(id_col).isin(ids)).select(order.alias("order"), F.col(lang).alias("lang"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            asked = [x in pairs for x in zip(batch.column("order").to_pylist(), batch.column("lang").to_pylist())]
            batch = batch.filter(pa.array(asked))
            bits = [zlib.compress(sets([t]).tobytes(), 1) for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("order"), batch.column("lang"), pa.array(bits, pa.binary())], ["order", "lang", "bits"])

    empty = F.lit(zlib.compress(bytes(WIDTH), 1))
    grams = sample.mapInArrow(tidy(run), "order bigint, lang string, bits binary").filter(F.col("bits") != empty)
    least = grams.groupBy("order", "lang").agg(F.min("bits").alias("bits")).collect()
    found = sorted((r["order"], r["lang"], bytes(r["bits"])) for r in least)
    rows = np.empty((len(found), WIDTH), np.uint8)
    for row, (_, _, bits) in zip(rows, found):
        row[:] = np.frombuffer(zlib.decompress(bits), np.uint8)
    model = learn(rows, [x for _, x, _ in found])
    del rows, found, least, sample
    give_back()
    return model


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (0 to 1); columns of those names are replaced.

    Null texts, texts without a letter and models without languages give ``und`` and 0. Ties go to the first language.
    """
    kept = df.drop("lang_pred", "score")
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            said, sure = [], []
            whole = texts(batch.column(text))
            for at in range(0, len(whole), _TEXTS):
                x = presence(whole[at : at + _TEXTS])
                known = x.any(1) & bool(model.languages)
                if model.languages:
                    f = model.scores(x)
                    best = f.argmax(1)
                    top = np.clip(f[np.arange(len(f)), best], 0, 1)
                else:
                    best, top = np.zeros(len(x), int), np.zeros(len(x))
                said += [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
                sure += np.where(known, top, 0.0).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(said), pa.array(sure, pa.float64())], [*names, "lang_pred", "score"])

    return kept.mapInArrow(tidy(run), schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves 2 on division by 4 (null ids do not)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def accepted(
    docs: DataFrame, floor: float, id_col: str = "doc_id", text: str = "text", lang: str = "lang", sure: float | None = None
) -> DataFrame:
    """The documents in a language of the labelled ones, unchanged but for ``lang``.

    A document stays if it has a letter, so that the classifier names a language for it, and its share of known n-grams is at least ``floor`` times what ``CLEAN``
    of the labelled sample's rows reach. Null and empty texts, texts without a letter, and all texts if no language was learned, go.
    Where the score of the predicted language is ``sure`` or more, it takes the place of the given one, which may be missing or wrong; otherwise the given one stays.
    Very long texts are read whole, one at a time.
    """
    model = fit(docs, ~held_out(id_col), id_col, text, lang)
    if not model.languages:
        return docs.filter("false")
    least, place = floor * model.clean, docs.columns.index(lang)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            whole, keep, named = texts(batch.column(text)), [], batch.column(lang).to_pylist()
            for at in range(0, len(whole), _TEXTS):
                x = sets(whole[at : at + _TEXTS])
                keep += (x.any(1) & (model.familiar(x) >= least)).tolist()
                if sure is not None:
                    f = model.scores((x > 0).view(np.uint8))
                    best = f.argmax(1)
                    for i in np.flatnonzero(f.max(1) >= sure).tolist():
                        named[at + i] = model.languages[best[i]]
            yield batch.set_column(place, batch.schema.field(place), pa.array(named, batch.schema.field(place).type)).filter(pa.array(keep))

    return docs.mapInArrow(tidy(run), docs.schema)
