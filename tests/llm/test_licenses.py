import math
import random
import re
import textwrap
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tunehouse.llm import licenses as L

APACHE, MIT, GRANT = L.TEMPLATES[0][1], L.TEMPLATES[2][1], L.TEMPLATES[3][1]
FILES = [
    (1, "a/LICENSE", GRANT + "\n\nTHE SOFTWARE IS PROVIDED AS IS. " + "filler words " * 30),
    (2, "a/x.py", "code only"),
    (3, "a/b/c/y.py", None),
    (4, "a/b/COPYING", APACHE),
    (5, "a/b/z.py", f"# {MIT}\ncode " + "more code " * 500),
    (6, "q/w.py", ""),
    (7, "q/w.py", ""),
    (None, None, "text " * 10),
    (8, "r/one/LICENSE.txt", MIT),
    (9, "r/one/UNLICENSE", "This is free and unencumbered software released into the public domain."),
    (10, "r/one/deep/er/f", "x"),
    (11, "ab/g", "y"),
    (12, "m/h.c", "prose " * 20_000 + "\nlast words. " + APACHE),
    (13, "m/i.c", "We discuss the licence at length, with no licence given to anyone for any reason whatever."),
    (13, "m/i.c", "Permission denied."),
    (14, "m/j.c", "/* SPDX-License-Identifier: MIT */\nint main() { return 0; } // and more of it"),
]


def plain_scores(texts, segment):
    """TF-IDF cosine of a segment to each template, from dictionaries."""
    words = lambda t: re.findall(L.WORD, (t or "").lower())
    vocabulary = {w for _, t in L.TEMPLATES for w in words(t)}
    df = Counter(w for t in texts for w in set(words(t)) & vocabulary)
    n = len(texts) + 1

    def vector(t):
        return {w: c * (math.log(n / (df[w] + 1)) + 1) for w, c in Counter(words(t)).items()}

    a = vector(segment)
    out = {}
    for name, text in L.TEMPLATES:
        b = vector(text)
        dot = sum(v * b.get(w, 0) for w, v in a.items())
        size = math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
        out[name] = max(out.get(name, 0), dot / size if size else 0)
    return out


@pytest.fixture(scope="module")
def scanned(spark):
    df = spark.createDataFrame([(*f, 1, 2, 3) for f in FILES], "key int, path string, text string, license int, __row int, term int")
    return L.license_scan(df).collect()


def test_one_row_per_file(scanned):
    assert Counter(r["key"] for r in scanned) == Counter(f[0] for f in FILES)


def test_origins(scanned):
    got = {(r["key"], r["license"], r["origin"], r["inherited_from"]) for r in scanned}
    assert (1, "MIT", "file", None) in got  # by its name: a paragraph matches, the whole text does not
    assert (2, "MIT", "inherited", "a") in got
    assert (3, "Apache-2.0", "inherited", "a/b") in got  # the nearest directory wins
    assert (4, "Apache-2.0", "file", None) in got
    assert (5, "MIT", "header", None) in got  # its own notice wins over the directory's
    assert (6, None, None, None) in got and (7, None, None, None) in got and (None, None, None, None) in got
    assert (11, None, None, None) in got  # ab is not below a
    assert (12, "Apache-2.0", "header", None) in got  # at the end of a long text
    assert (13, None, None, None) in got and (14, "MIT", "header", None) in got
    shared = {r["license"] for r in scanned if r["key"] == 10}
    assert shared <= {"MIT", "Unlicense"} and len(shared) == 1


def test_scores_equal_dictionaries(scanned):
    texts = [f[2] for f in FILES]
    by_key = {r["key"]: r for r in scanned if r["origin"] in ("header", "file")}
    for key, segment in ((4, APACHE), (5, f"# {MIT}"), (8, MIT)):
        assert by_key[key]["score"] == pytest.approx(max(plain_scores(texts, segment).values()), abs=2e-6)
    assert by_key[14]["score"] == 1


def test_variants_are_told_apart(spark):
    notices = [(i, f"f{i}/x", f"Some prose before. {t}") for i, (_, t) in enumerate(L.TEMPLATES)]
    got = {r["key"]: r["license"] for r in L.license_scan(spark.createDataFrame(notices, "key int, path string, text string")).collect()}
    assert got == {i: k for i, (k, _) in enumerate(L.TEMPLATES)}


def test_paths(one):
    for path, folder in (("a/b/c", "a/b"), ("a", ""), ("", ""), ("/x", ""), ("a/b/", "a/b")):
        assert one(L.directory(F.lit(path))) == folder
    assert one(L.ancestors(F.lit("a/b"))) == ["a", "a/b", ""] and one(L.ancestors(F.lit(""))) == [""]


def test_awkward_documents(awkward, nothing):
    rows = L.license_scan(L.document_files(awkward)).collect()
    assert len(rows) == awkward.count()
    assert {r["key"] for r in rows if r["license"] == "MIT"} == {11}
    assert L.license_scan(L.document_files(nothing)).count() == 0


GPL3_HEADER = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
MIT_TEXT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla
Public License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
SHORT = "Licensed under the\nApache License,\nVersion 2.0."
CODE = "\n\nint main(int argc, char **argv) {\n" + "    total += price[i] * count[i];\n" * 60 + "}\n"


def commented(text, first, mark, last):
    return "\n".join([*([first] if first else []), *((f"{mark} {line}".rstrip()) for line in text.split("\n")), *([last] if last else [])])


def test_wrapped_headers(spark):
    marks = (("", "#", ""), ("", "//", ""), ("/*", " *", " */"), ("<!--", "", "-->"), ("", "--", ""), ("", ";;", ""))
    texts = {"GPL-3.0": GPL3_HEADER, "MIT": MIT_TEXT, "Apache-2.0": APACHE_HEADER, "MPL-2.0": MPL_HEADER}
    rows, want = [], []
    for license, text in [*texts.items(), ("Apache-2.0", SHORT)]:
        copyright = "Copyright (C) 2020 A. Author\n\n"
        for mark in marks:
            rows.append((len(rows), f"d{len(rows)}/x.c", commented(copyright + text, *mark) + CODE))
            want.append(license)
        for one in (text.replace("\n", " "), "# " + text.replace("\n", "\r\n# ")):
            rows.append((len(rows), f"d{len(rows)}/x.c", "first line\n" + one + CODE))
            want.append(license)
    rows += [(len(rows) + i, f"e{i}/x.c", "# prose on the licence and\n# on copyright and warranty\n# in general terms" + CODE) for i in range(40)]
    got = {r["key"]: (r["license"], r["origin"]) for r in L.license_scan(spark.createDataFrame(rows, "key int, path string, text string")).collect()}
    assert [got[i] for i in range(len(want))] == [(license, "header") for license in want]
    assert all(got[i] == (None, None) for i in range(len(want), len(rows)))


GPL2_HEADER = """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version."""


def scan(spark, rows):
    return {r["key"]: r for r in L.license_scan(spark.createDataFrame(rows, "key int, path string, text string")).collect()}


def test_only_licence_files_are_inherited_from(spark):
    """A source file that is nothing but a notice is no licence file; versions are told apart."""
    rows = [
        (0, "f/n.js", "/* SPDX-License-Identifier: (MIT OR Apache-2.0) */"),
        (1, "f/go.go", "package main"),
        (2, "g/a.c", commented(GPL2_HEADER, "/*", " *", " */")),
        (3, "g/b.c", "int x;"),
        (4, "h/a.c", commented(GPL3_HEADER, "/*", " *", " */")),
        (5, "h/c.c", commented(GPL2_HEADER.replace("version 2", "version 3"), "", "//", "")),
    ]
    got = scan(spark, rows)
    assert (got[0]["license"], got[0]["origin"], got[0]["score"]) == ("MIT OR Apache-2.0", "header", 1)
    assert got[1]["origin"] is None and got[3]["origin"] is None
    assert (got[2]["license"], got[2]["origin"]) == ("GPL-2.0", "header")
    assert (got[4]["license"], got[4]["origin"]) == ("GPL-3.0", "header") and got[5]["license"] == "GPL-3.0"


TAGS = {
    "// SPDX-License-Identifier: LGPL-2.1-only": "LGPL-2.1",
    "# SPDX-License-Identifier: BSD-3-Clause": "BSD-3-Clause",
    "/* SPDX-License-Identifier: GPL-2.0+ */": "GPL-2.0",
    "<!-- SPDX-License-Identifier: GPL-3.0-or-later -->": "GPL-3.0",
    ";; spdx-license-identifier: GPL-2.0-only WITH Classpath-exception-2.0": "GPL-2.0-only WITH Classpath-exception-2.0",
    "SPDX-License-Identifier: (MIT AND ISC) OR Zlib": "(MIT AND ISC) OR Zlib",
    "SPDX-License-Identifier:": None,
    "SPDX-License-Identifier: \nMIT": None,
}


def test_spdx_tags(spark):
    got = scan(spark, [(i, f"d{i}/x", f"{t}\ncode") for i, t in enumerate(TAGS)])
    assert [got[i]["license"] for i in range(len(TAGS))] == list(TAGS.values())


def test_headers_wrapped_at_any_width_are_found(spark):
    """The recall of windows: every long notice, wrapped at random widths in comments amid code."""
    rng = random.Random(4)
    rows, want = [], []
    for license, text in L.TEMPLATES:
        if len(re.findall(L.WORD, text.lower())) < L.LONG:
            continue
        for _ in range(12):
            mark = rng.choice(["# ", "// ", " * ", "-- ", "% ", ";; ", ""])
            lines = textwrap.wrap("Copyright 2020 A. Author. " + text + " See the file for more.", rng.randint(24, 100))
            rows.append((len(rows), f"d{len(rows)}/x.c", "x = 1\n" + "\n".join(mark + x for x in lines) + CODE))
            want.append(license)
    got = scan(spark, rows)
    right = sum(got[i]["license"] == k for i, k in enumerate(want))
    assert right / len(want) >= 0.9, right / len(want)
    print(f"recall of wrapped headers {right / len(want):.3f} of {len(want)}")


def test_whole_licences(spark):
    """A document that is a complete licence is a licence file whatever its name, and its directory inherits."""
    rows, want = [], []
    for i, (license, text) in enumerate(L.WHOLE_TEXTS):
        own = "\n".join(f"  {line}" for line in ["Copyright (c) 2020 A. Author", "", *text.split("\n")])
        rows += [(2 * i, f"d{i}/{i}.txt", own), (2 * i + 1, f"d{i}/code.py", "code only")]
        want += [(license, "file"), (license, "inherited")]
    got = {r["key"]: (r["license"], r["origin"]) for r in L.license_scan(spark.createDataFrame(rows, "key int, path string, text string")).collect()}
    assert {k for k, _ in L.WHOLE_TEXTS} >= {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "Unlicense"}
    assert [got[i] for i in range(len(want))] == want
