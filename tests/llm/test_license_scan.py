import math
import re
from collections import Counter

import pytest

from tickloom.llm import license_scan as L

ROWS = [
    (1, "a/LICENSE", "The MIT text\nReleased under the MIT License."), (2, "a/b/x.py", "code"), (3, "a/b/LICENSE.txt", "Licensed under CC BY-NC 4.0."), (4, "a/b/c/d/y.py", None),
    (5, "a/z.py", "// Licensed under the Apache\n// License, Version 2.0.\nint x;"), (6, "other/w.py", ""), (7, None, "released UNDER the mit license"), (8, "top.txt", "x"), (9, "ab/x.py", "not a/"),
    (10, "a/b/COPYING", "word " * 50 + "licence"), (3, "a/b/LICENSE.txt", "Licensed under CC BY-NC 4.0."), (11, "a//odd.py", "x"), (12, "long/x", "text of words. " * 50000 + "\nThis work is licensed under the GNU General Public License, version 3.\n"),
]


def brute(rows):
    words = lambda t: re.findall(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*", t.lower())
    n = len(rows)
    df = Counter(w for _, _, t in rows for w in set(words(t or "")))
    idf = lambda w: math.log((1 + n) / (1 + (df[w] if w in vocabulary else 0))) + 1
    vocabulary = {w for ts in L.TEMPLATES.values() for t in ts for w in words(t)}

    def cosine(a, b):
        x, y = ({w: k * idf(w) for w, k in Counter(words(t)).items()} for t in (a, b))
        s = sum(v * y.get(w, 0) for w, v in x.items())
        return s / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values())) if s else 0.0

    own = []
    for _, p, t in rows:
        lines = (t or "").split("\n")
        parts = [*lines, " ".join(x for x in lines if x.startswith("//"))]
        if p and re.match(L.LICENCE_FILE, p.split("/")[-1]):
            parts.append(t or "")
        x, name = max(((cosine(b, s), k) for b in parts for k, ss in L.TEMPLATES.items() for s in ss), key=lambda m: m[0])
        own.append((name, round(x, 6)) if x >= 0.8 else None)
    given = {p.rpartition("/")[0]: o for (_, p, _), o in zip(rows, own, strict=True) if p and o and re.match(L.LICENCE_FILE, p.split("/")[-1])}
    out = []
    for (i, p, _), o in zip(rows, own, strict=True):
        row = (i, p, *o, "own", None) if o else (i, p, None, None, "none", None)
        if not o and p is not None:
            d = p.rpartition("/")[0]
            while True:
                if d in given:
                    row = (i, p, *given[d], "inherited", d)
                    break
                if not d:
                    break
                d = d.rpartition("/")[0]
        out.append(row)
    return sorted(map(str, out))


def test_equals_brute_force(spark):
    df = spark.createDataFrame([(*r, "z") for r in ROWS], "file_id long, path string, text string, licence string").repartition(3)
    got = L.scan(df).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(ROWS)
    by = {r.file_id: (r.licence, r.origin) for r in got}
    assert by[5] == ("Apache-2.0", "own") and by[4] == ("CC-BY-NC-4.0", "inherited") and by[2] == ("CC-BY-NC-4.0", "inherited") and by[7] == ("MIT", "own") and by[12][0] == "GPL-3.0" and by[11] == ("MIT", "inherited")


def test_empty_table(spark):
    assert L.scan(spark.createDataFrame([], "file_id long, path string, text string")).count() == 0


def test_statements_of_documents(spark):
    from tickloom.llm.queries import op2_license_scan

    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = op2_license_scan(spark, "/root/testdata/sf0.01").collect()
    stated = {d for d, t in docs.items() if re.search("Licensed under|licensed under the GNU|Released under the MIT", t)}
    assert len(rows) == len(docs) and {r.doc_id for r in rows if r.origin == "own"} == stated and stated


@pytest.mark.parametrize("name", sorted(L.TEMPLATES))
def test_templates_find_themselves(name):
    m = L.Matcher(L.TEMPLATES, {}, 10)
    for t in L.TEMPLATES[name]:
        x, got = m.best(t.encode())
        assert got == name and abs(x - 1) < 1e-9


GPL_HEADER = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""


def test_whole_licences_and_headers(spark):
    """Licence files with a notice before the text, wrapped headers among code, among very many and few files; the same result for both."""
    text = lambda name: next(t for t in L.TEMPLATES[name][::-1] if len(t) > 900)
    mit = "MIT License\n\nCopyright (c) 2019 Some Person\n\n" + text("MIT")
    bsd = "Copyright (c) 2007, Somebody and others\nAll rights reserved.\n\n" + text("BSD-3-Clause")
    code = "\n".join(f"value{i} = compute{i}(left{i}, right{i})" for i in range(300))
    rows = [
        (1, "m/LICENSE", mit), (2, "m/x.py", "code"), (3, "b/COPYING", bsd), (4, "b/y.py", "code"), (5, "g/a.py", "\n".join("# " + x for x in GPL_HEADER.split("\n")) + "\n" + code),
        (6, "g/b.py", code + "\n" + GPL_HEADER + "\n" + code), (7, "h/LICENSE", text("GPL-3.0") + "\n" + code), (8, "h/z.py", "code"), (9, "n/w.py", code),
    ]
    want = {1: "MIT", 2: "MIT", 3: "BSD-3-Clause", 4: "BSD-3-Clause", 5: "GPL-3.0", 6: "GPL-3.0", 7: "GPL-3.0", 8: "GPL-3.0", 9: None}
    for more in (0, 3000):
        df = spark.createDataFrame(rows + [(100 + i, f"o/{i}.txt", "invented words") for i in range(more)], "file_id long, path string, text string")
        assert {r.file_id: r.licence for r in L.scan(df).filter("file_id < 100").collect()} == want
