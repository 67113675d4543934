"""Licence scan against a plain TF-IDF, and inheritance along paths."""

import math
import re
from collections import Counter

import pytest

from fairwait.llm import license_scan

FILES = "path string, text string, license int, note string"


def vector(text):
    return Counter(w for w in re.split("[^a-z0-9]+", text.lower()) if w)


def plain(segment):
    n = len(license_scan.TEMPLATES)
    df = Counter(w for t in license_scan.TEMPLATES.values() for w in vector(t))
    weight = lambda v: {w: c * (math.log((1 + n) / (1 + df.get(w, 0))) + 1) for w, c in v.items()}
    x = weight(vector(segment))
    best = []
    for name, t in license_scan.TEMPLATES.items():
        y = weight(vector(t))
        dot = sum(v * y.get(w, 0) for w, v in x.items())
        best.append((-round(dot / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values())), 9), name))
    score, name = min(best)
    return name, -score


LINES = [
    "Licensed under the Apache License, Version 2.0.", "// licensed under the apache license version 2.0 (the License)", "Released under the MIT License.",
    "released under mit", "All rights reserved.", "The rights of all were not reserved by anyone at all in this long line.", "words without any of them",
    "This work is licensed under the GNU General Public License, version 3.", "Public domain", "",
]


@pytest.mark.parametrize("threshold", [0.4, 0.6, 0.9])
def test_every_line_like_a_plain_version(spark, threshold):
    rows = [(f"d{i}/f", f"some text\n\n{line}\nmore text", 1, "x") for i, line in enumerate(LINES)]
    got = {r["path"]: r for r in license_scan.scan(spark.createDataFrame(rows, FILES), threshold=threshold).collect()}
    for i, line in enumerate(LINES):
        name, score = plain(line) if line else (None, 0)
        if score >= threshold:
            assert (got[f"d{i}/f"]["license"], got[f"d{i}/f"]["origin"], got[f"d{i}/f"]["origin_path"]) == (name, "own", f"d{i}/f")
            assert got[f"d{i}/f"]["score"] == pytest.approx(score)
        else:
            assert got[f"d{i}/f"]["license"] is None and got[f"d{i}/f"]["origin"] is None


def test_wrapped_notices_and_licence_files(spark):
    wrapped = "code\n# This work is licensed under the GNU\n# General Public License,\n# version 3.\ncode " + "x " * 50_000
    rows = [("src/a.py", wrapped, 1, "x"), ("LICENSE", "Released under the MIT License.\n" + "more terms\n" * 3, 1, "x")]
    got = {r["path"]: (r["license"], r["origin"]) for r in license_scan.scan(spark.createDataFrame(rows, FILES)).collect()}
    assert got == {"src/a.py": ("GPL-3.0", "own"), "LICENSE": ("MIT", "own")}


def test_nearest_folder_counts(spark):
    rows = [
        ("LICENSE", "Released under the MIT License.", 1, "x"), ("lib/COPYING", "Licensed under the Apache License, Version 2.0.", 1, "x"),
        ("a.py", "code", 1, "x"), ("lib/b.py", "code", 1, "x"), ("lib/deep/er/c.py", "code", 1, "x"), ("library/d.py", "code", 1, "x"),
        ("lib/own.py", "All rights reserved.\n" + "code " * 100, 1, "x"), ("lib/b.py", "code", 1, "x"), ("lib/null.py", None, 1, "x"), (None, "code", 1, "x"),
        ("other/long.py", "Released under the MIT License.\n" + "code " * 100, 1, "x"), ("other/e.py", "code", 1, "x"),
    ]
    got = license_scan.scan(spark.createDataFrame(rows, FILES).repartition(5))
    assert got.columns == ["path", "text", "note", "license", "score", "origin", "origin_path"]  # the clashing column is replaced
    assert got.count() == len(rows)
    found = {r["path"]: (r["license"], r["origin"], r["origin_path"]) for r in got.collect()}
    assert found["a.py"] == found["library/d.py"] == found["other/e.py"] == ("MIT", "inherited", "LICENSE")
    assert found["lib/b.py"] == found["lib/deep/er/c.py"] == found["lib/null.py"] == ("Apache-2.0", "inherited", "lib/COPYING")
    assert found["lib/own.py"] == ("Proprietary", "own", "lib/own.py")
    assert found[None] == (None, None, None)


def test_native_plan_and_empty_table(spark):
    rows = [("a", "Released under the MIT License.", 1, "x")]
    plan = license_scan.scan(spark.createDataFrame(rows, FILES))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    assert license_scan.scan(spark.createDataFrame([], FILES)).count() == 0


GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice.
2. Redistributions in binary form must reproduce the above copyright notice."""
THIRD = """
3. Neither the name of the X nor the names of its contributors may be used to
   endorse or promote products derived from this software without
   specific prior written permission."""
AGAIN = {
    "MIT": [f"MIT License\n\nCopyright (c) 2009 X\n\n{GRANT}", "SPDX-License-Identifier: MIT", "x = 1  # by X, this is released under the MIT License. See below for what it does."],
    "BSD-2-Clause": [f"Copyright (c) 2009, X\nAll rights reserved.\n\n{BSD}"],
    "BSD-3-Clause": [f"Copyright (c) 2009, X\nAll rights reserved.\n\n{BSD}{THIRD}", "// SPDX-License-Identifier: (BSD-3-Clause OR MIT)"],
    "Apache-2.0": [
        "\n    Apache License\n    Version 2.0, January 2004\n    http://www.apache.org/licenses/\n\nTERMS AND CONDITIONS", "/* SPDX-License-Identifier: Apache-2.0 */",
        "# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance with the License.\n# You may obtain a copy",
    ],
    "GPL-3.0": [
        "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\nEveryone is permitted to copy", "SPDX-License-Identifier: GPL-3.0-or-later",
        " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n"
        " * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.",
    ],
    "GPL-2.0": ["GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991\n\nEveryone is permitted to copy"],
    "Proprietary": ["Copyright (c) 2009 X. All rights reserved."],
}


def test_headers_bodies_tags_and_notices_in_prose(spark):
    want = {f"{name}/{i}/f": name for name, found in AGAIN.items() for i in range(len(found))}
    rows = [(f"{name}/{i}/f", f"{text}\n" + "code of its own\n" * 20, 1, "x") for name, found in AGAIN.items() for i, text in enumerate(found)]
    rows += [("no/f", "The licence of a driver is all that is reserved here, and the copyright of nothing.", 1, "x")]
    got = {r["path"]: (r["license"], r["origin"]) for r in license_scan.scan(spark.createDataFrame(rows, FILES)).collect()}
    assert got == {k: (v, "own") for k, v in want.items()} | {"no/f": (None, None)}


def test_every_form_has_an_anchor():
    texts = [x for _, phrases in license_scan.FORMS for x in [" ".join(phrases)]] + [x for _, x in license_scan.NOTICES] + list(license_scan.TEMPLATES.values())
    assert all(re.search(license_scan._ANCHORS, x) for x in texts) and re.search(license_scan._ANCHORS, "SPDX-License-Identifier")
