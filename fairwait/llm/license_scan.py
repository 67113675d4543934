"""Licences of files by sparse TF-IDF cosine to templates, and inheritance from directories.

DataFrame functions only. Every line of every text is looked at. A template's heaviest words, taken until the others
together weigh too little to reach the threshold, are its cues: a segment without any of them cannot match, nor can one that
consists too little of words of templates. Segments are the other lines, runs of neighbouring lines that are mostly words of templates, and whole licence files. A segment's words are joined to the
templates' words, and products add up to the cosine. A file takes its best segment's licence; a file without one takes that of
the nearest directory above it that has a licence file.

Whole licence texts, their standard headers, SPDX tags, and notices inside prose are far from every template. They are told by forms: phrases of
which all must stand in the text word for word, whatever wraps them (line ends, comment marks, punctuation). A form scores 1. Headers
and bodies go before equal cosines, as they say more than one line; notices and copyright lines count where no segment matches.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

THRESHOLD = 0.6
FILE_SHARE = 0.5  # a file is a licence file if its name says so or so much of its characters stand in matched segments
FILE_NAME = r"(?i)(^|/)(licen[sc]e|copying|copyright|unlicense|notice)([-._][^/]*)?$"

# Licence notices as they stand in files, fixed values.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Use of this source code is governed by the BSD 2-Clause License.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license, the BSD 3-Clause License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under the CC0 1.0 Universal Public Domain Dedication.",
    "EPL-2.0": "This program is made available under the terms of the Eclipse Public License 2.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This file is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

_GNU = {"GPL": "gnu general public license", "LGPL": "gnu lesser general public license"}
_PUBLISHED = "as published by the free software foundation"
_CC = {"CC-BY-4.0": "attribution", "CC-BY-NC-4.0": "attribution noncommercial", "CC-BY-SA-4.0": "attribution sharealike"}
_REDISTRIBUTION = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
# (licence, phrases that must all be there): headings, bodies and file headers; of several the one with the most words counts.
FORMS = [
    ("Apache-2.0", ["apache license version 2 0 january 2004"]),
    ("Apache-2.0", ["licensed under the apache license version 2 0", "you may not use this file except in compliance with the license"]),
    ("MIT", ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"]),
    ("BSD-2-Clause", [_REDISTRIBUTION]),
    ("BSD-3-Clause", [_REDISTRIBUTION, "endorse or promote products derived from this software without specific prior written permission"]),
    *[(f"{k}-{n}.0", [f"{_GNU[k]} version {n} {day}"]) for k, n, day in [("GPL", 2, "june 1991"), ("GPL", 3, "29 june 2007"), ("LGPL", 3, "29 june 2007")]],
    *[(f"{k}-{n}.0", [f"{_GNU[k]} {by}version {n}", "free software"]) for k, n in [("GPL", 2), ("GPL", 3), ("LGPL", 3)] for by in (f"{_PUBLISHED} ", f"{_PUBLISHED} either ")],
    *[(f"{k}-{n}.0", [f"{_GNU[k]} {_PUBLISHED}", f"either version {n} of the license"]) for k, n in [("GPL", 2), ("GPL", 3), ("LGPL", 3)]],
    ("MPL-2.0", ["subject to the terms of the mozilla public license v 2 0", "this source code form"]),
    ("MPL-2.0", ["mozilla public license version 2 0 1 definitions"]),
    ("EPL-2.0", ["this program and the accompanying materials are made available under the terms of the eclipse public license"]),
    ("EPL-2.0", ["eclipse public license v 2 0 the accompanying program is provided under the terms of this eclipse public license"]),
    ("CC0-1.0", ["creative commons legal code cc0 1 0 universal"]),
    *[(k, [f"creative commons {x} 4 0 international public license"]) for k, x in _CC.items()],
    ("Unlicense", ["this is free and unencumbered software released into the public domain anyone is free to copy"]),
]
# Notices as they stand inside prose; the templates' sentences are such as well.
NOTICES = [
    *[(k, f"{x} under the {y}") for k, y in [("MIT", "mit license"), ("Apache-2.0", "apache license version 2 0"), ("BSD-2-Clause", "bsd 2 clause license"), ("BSD-3-Clause", "bsd 3 clause license")]
      for x in ("licensed", "released", "distributed", "available")],
    *[(f"{k}-{n}.0", f"under the {terms}{_GNU[k]} {x} {n}") for k, n in [("GPL", 2), ("GPL", 3), ("LGPL", 3)] for terms in ("", "terms of the ") for x in ("version", "v")],
]
_SPDX = r"(?i)spdx-license-identifier:[ \t(]*([a-z0-9.+-]+)"
# Every form, notice and tag has one of these words.
_ANCHORS = r"(?i)licen[sc]e|copyright|reserved|domain|permission|redistribution|creative"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def weighted(templates: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """(license, word, weight) with unit length per template, (word, idf), and the idf of a word in no template."""
    counts = templates.select("license", F.explode(words_of(F.col("text"))).alias("word")).groupBy("license", "word").agg(F.count("*").alias("tf"))
    n = templates.agg(F.countDistinct("license")).first()[0]
    idf = counts.groupBy("word").agg((F.log((F.lit(1 + n)) / (1 + F.count("*"))) + 1).alias("idf"))
    raw = counts.join(idf, "word").withColumn("raw", F.col("tf") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("license")))
    return raw.withColumn("weight", F.col("raw") / length).select("license", "word", "weight"), idf, F.log(F.lit(1.0 + n)) + 1


def cues(weights: DataFrame, threshold: float) -> list[str]:
    """Words of which a matching segment must hold one; as few as the templates' words at most.

    A segment that shares only lighter words has at most their length as its cosine (Cauchy and Schwarz).
    """
    order = Window.partitionBy("license").orderBy("weight", F.desc("word")).rowsBetween(Window.unboundedPreceding, 0)
    lighter = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(order))
    rows = weights.withColumn("reach", lighter).filter(F.col("reach") >= threshold - 1e-9).select("word").distinct().collect()
    return sorted(r["word"] for r in rows)


def segments(files: DataFrame, key: list[str], text: str, cue_words: list[str], idf: dict[str, float], unseen: float, threshold: float, license_file: Column) -> DataFrame:
    """(*key, segment, chars, words): lines that may match, runs of several lines, and whole licence files.

    A line may match if it has a cue and words of templates make up enough of its length as a vector: words outside
    count for nothing in a product, so their share bounds the cosine. A notice may be wrapped: neighbouring
    lines of which at least half the words are known from templates make a run, if one of them has a cue.
    """
    vocabulary = sorted(idf)
    table = F.create_map(*[F.lit(x) for w in vocabulary for x in (w, idf[w])])
    lines = F.transform(F.split(F.col(text), "\n", -1), lambda x, i: F.struct(i.alias("at"), x.alias("line"), words_of(x).alias("words")))
    lines = F.transform(
        lines, lambda x: F.struct(x["at"], x["line"], x["words"], F.filter(x["words"], lambda w: w.isin(vocabulary)).alias("known"))
    )
    cue = lambda x: F.exists(x["known"], lambda w: w.isin(cue_words))
    mostly = lambda x: F.size(x["known"]) * 2 >= F.greatest(F.size(x["words"]), F.lit(1))

    def known_mass(x: Column) -> Column:
        """Squared length of the known words: the sum over their occurrences of count times squared idf."""
        times = lambda w: F.size(F.filter(x["known"], lambda o: o == w))
        return F.aggregate(x["known"], F.lit(0.0), lambda s, w: s + times(w) * F.pow(F.element_at(table, w), F.lit(2.0)))

    def enough(x: Column) -> Column:
        others = F.size(F.array_distinct(x["words"])) - F.size(F.array_distinct(x["known"]))
        mass = known_mass(x)
        return mass >= (threshold - 1e-6) ** 2 * (mass + others * unseen**2)

    marked = F.transform(
        F.filter(lines, lambda x: F.size(x["known"]) > 0),
        lambda x: F.struct(x["at"], x["line"], x["words"], x["known"], cue(x).alias("cue"), mostly(x).alias("mostly")),
    )
    marked = F.transform(
        F.filter(marked, lambda x: x["cue"] | x["mostly"]),
        lambda x: F.struct(x["at"], x["line"], x["words"], x["cue"], x["mostly"], (x["cue"] & enough(x)).alias("alone")),
    )
    near = F.filter(marked, lambda x: x["alone"] | x["mostly"])
    # Bound once, and stored once for lines and runs: texts are split a single time.
    near = F.transform(F.array(near), lambda found: F.when(F.exists(found, lambda x: x["cue"]), found))[0]
    rows = stored(files.select(*key, F.explode(near).alias("x")).select(*key, "x.*").distinct(), "near")
    place = Window.partitionBy(*key).orderBy("at")
    single = rows.filter("alone").select(*key, F.format_string("line %d", "at").alias("segment"), F.length("line").alias("chars"), "words")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n")
    close = rows.filter("mostly").withColumn("run", F.col("at") - F.row_number().over(place))
    runs = close.groupBy(*key, "run").agg(F.min("at").alias("at"), F.count("*").alias("n"), F.max("cue").alias("cue"), joined.alias("line")).filter("n > 1 AND cue")
    several = runs.select(*key, F.format_string("run %d", "at").alias("segment"), F.length("line").alias("chars"), words_of(F.col("line")).alias("words"))
    whole = files.filter(license_file).select(*key, F.lit("file").alias("segment"), F.length(text).alias("chars"), words_of(F.col(text)).alias("words")).distinct()
    return single.unionByName(several).unionByName(whole)


def _phrase(text: str) -> str:
    return " " + re.sub("[^a-z0-9]+", " ", text.lower()).strip() + " "


def formed(files: DataFrame, key: list[str], text: str, templates: Mapping[str, str]) -> DataFrame:
    """(*key, f_own, strong, f_chars) of files in which an SPDX tag, a form, a notice or a template's sentence stands word for word.

    ``strong`` tells tags and forms from the rest. Of several kinds tags go first, then forms, notices, and rights reserved at last; of one kind
    the one with the most words, then the first name. Of an SPDX expression the first licence counts.
    """
    tags = {name.lower() + end: name for name in templates for end in ("", "+", "-only", "-or-later")}
    tag = F.lower(F.regexp_extract(text, _SPDX, 1))
    named = F.element_at(F.create_map(*[F.lit(x) for pair in tags.items() for x in pair]), tag)
    plain = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), F.lit(" "))
    plain = F.regexp_replace(plain, "  +", " ")
    kinds = [(1, name, phrases) for name, phrases in FORMS if name in templates]
    kinds += [(2, name, [x]) for name, x in NOTICES if name in templates]
    kinds += [(3 if name == "Proprietary" else 2, name, [x]) for name, x in templates.items() if _phrase(x).strip()]

    def standing(x: Column) -> Column:
        """The best of what stands in a normalised text, which is bound here: normalised once, not once a phrase."""
        found = []
        for kind, name, phrases in kinds:
            phrases = [_phrase(y) for y in phrases]
            there = reduce(and_, [x["plain"].contains(y) for y in phrases])
            size = sum(len(y) for y in phrases)
            found.append(F.when(there, F.struct(F.lit(kind).alias("kind"), F.lit(-size).alias("minus"), F.lit(name).alias("license"))))
        tagged = F.struct(F.lit(0).alias("kind"), (-25 - F.length(x["named"])).alias("minus"), x["named"].alias("license"))
        return F.array_min(F.array_compact(F.array(*found, F.when(x["named"].isNotNull(), tagged))))

    likely = files.filter(F.col(text).rlike(_ANCHORS))
    bound = F.transform(F.array(F.struct(plain.alias("plain"), named.alias("named"))), standing)[0]
    best = likely.select(*key, bound.alias("b")).filter("b IS NOT NULL").distinct()
    return best.select(*key, F.col("b.license").alias("f_own"), (F.col("b.kind") < 2).alias("strong"), (-F.col("b.minus")).alias("f_chars"))


def scan(
    files: DataFrame,
    path: str = "path",
    text: str = "text",
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    file_share: float = FILE_SHARE,
) -> DataFrame:
    """``files`` with ``license``, ``score``, ``origin`` (own, inherited or null) and ``origin_path``.

    Null texts match nothing; files with null path have no directory. Rows equal in path and text are one file and
    get the same result. Best is the highest cosine, ties to the first licence in order of name; of several licence files in a directory the
    one with the best score, then the first path, counts. Columns of ``files`` with the names of results are replaced.
    """
    spark = files.sparkSession
    files = files.drop(*[c for c in ("license", "score", "origin", "origin_path") if c not in (path, text)])
    known = spark.createDataFrame(list(templates.items()), "license string, text string")
    weights, idf, unseen = weighted(known)
    weights, idf = stored(weights, "weights"), stored(idf, "idf")
    key = ["_path", "_hash"]
    keyed = files.withColumns({"_path": F.coalesce(F.col(path), F.lit("")), "_hash": F.xxhash64(F.col(text))})
    named = F.col("_path").rlike(FILE_NAME)
    known_idf = {r["word"]: r["idf"] for r in idf.collect()}  # the templates' own words
    off = math.log(1.0 + len(templates)) + 1
    parts = stored(segments(keyed.filter(F.col(text).isNotNull()), key, text, cues(weights, threshold), known_idf, off, threshold, named), "segments")

    # Counts of a segment's words, then their weights; words outside the templates count for the length only.
    listed = parts.select(*key, "segment", "chars", F.explode("words").alias("word"))
    counted = listed.groupBy(*key, "segment", "chars", "word").agg(F.count("*").alias("tf"))
    valued = counted.join(idf, "word", "left").withColumn("raw", F.col("tf") * F.coalesce("idf", unseen))
    valued = stored(valued.select(*key, "segment", "chars", "word", "raw"), "words")
    length = valued.groupBy(*key, "segment").agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("length"), F.first("chars").alias("chars"))
    dot = valued.join(weights, "word").groupBy(*key, "segment", "license").agg(F.sum(F.col("raw") * F.col("weight")).alias("dot"))
    matched = dot.join(length, [*key, "segment"]).withColumn("score", F.round(F.col("dot") / F.col("length"), 9)).filter(F.col("score") >= threshold)
    of_segment = matched.groupBy(*key, "segment").agg(
        F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("best"), F.first("chars").alias("chars")
    )
    own = of_segment.groupBy(*key).agg(
        F.min("best").alias("best"),
        # A run's characters stand in its lines as well; the larger of the two sums counts.
        F.greatest(
            F.sum(F.when(F.col("segment").startswith("line"), F.col("chars")).otherwise(0)),
            F.sum(F.when(F.col("segment").startswith("run"), F.col("chars")).otherwise(0)),
        ).alias("licensed"),
    )
    own = own.select(*key, F.col("best.license").alias("license"), (-F.col("best.minus")).alias("score"), "licensed")
    forms = formed(keyed.filter(F.col(text).isNotNull()), key, text, templates)
    by_form = F.col("f_own").isNotNull() & (F.col("strong") | F.col("license").isNull())
    own = own.join(forms, key, "full").select(
        *key,
        F.when(by_form, F.col("f_own")).otherwise(F.col("license")).alias("license"),
        F.when(by_form, 1.0).otherwise(F.col("score")).alias("score"),
        F.greatest("licensed", "f_chars").alias("licensed"),
    )
    own = stored(own, "own")

    folder = F.regexp_extract("_path", r"(?s)\A(.*)/", 1)
    # Only files with a licence of their own can be licence files.
    sized = keyed.select(*key, F.length(text).alias("chars"), folder.alias("folder"), named.alias("named"))
    holders = sized.join(own, key).filter(F.col("named") | (F.col("licensed") >= file_share * F.col("chars")))
    best = F.min(F.struct((-F.col("score")).alias("minus"), "_path", "license", "score"))
    folders = stored(holders.filter("_path <> ''").groupBy("folder").agg(best.alias("b")).select("folder", F.col("b.license").alias("f_license"), F.col("b.score").alias("f_score"), F.col("b._path").alias("f_path")), "folders")
    above = F.transform(
        F.sequence(F.lit(0), F.size(F.split("_path", "/")) - 1), lambda n: F.array_join(F.slice(F.split("_path", "/"), F.lit(1), n), "/")
    )
    paths = keyed.select(*key).filter("_path <> ''").distinct().join(own, key, "left_anti").select("_path").distinct()
    inherited = (
        paths.select("_path", F.explode(above).alias("folder"))
        .join(folders, "folder")
        .groupBy("_path")
        .agg(F.max(F.struct(F.length("folder").alias("depth"), "f_license", "f_score", "f_path")).alias("up"))
    )
    out = keyed.join(own, key, "left").join(inherited, "_path", "left")
    mine = F.col("license").isNotNull()
    return out.select(
        *files.columns,
        F.coalesce("license", "up.f_license").alias("license"),
        F.coalesce("score", "up.f_score").alias("score"),
        F.when(mine, "own").when(F.col("up").isNotNull(), "inherited").alias("origin"),
        F.when(mine, F.col(path)).otherwise(F.col("up.f_path")).alias("origin_path"),
    )
