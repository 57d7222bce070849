"""License scan (operator 2): licence statements in files, inherited from the nearest directory that has one.

Method: a file's blocks (each line, each run of comment lines joined, each window of as many words as a template has, wherever its
lines break, and the whole of a licence file) are compared with templates by the cosine of sparse TF-IDF vectors; document frequencies
of the templates' words are counted over all files, other words weigh `UNKNOWN`, however many files there are. Templates are
statements, headers and whole texts (`licences/`). No block of a file has a larger cosine to a template than the root of the share of
the template's squared weights that the file's words hold: templates below the threshold by that are left out for the file, without loss. The
template with the largest cosine of at least `threshold` is the file's own
licence. A licence file (LICENSE, COPYING, ...) licenses its directory. Files without a licence of their own inherit: each
distinct directory is joined with its own ancestors' licences by path and keeps the deepest, then files join their directory. So the
path joins see directories, not files, and a directory with very many files is one row in them.

Nulls and edges: a null or empty text has no licence; a null path is a file without directory, it inherits nothing; two licence files
of one directory: the larger cosine licenses it, then the smaller name; ties between templates go to the first name; repeated
rows give a row each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import keep, map_texts, small_batches

THRESHOLD = 0.8
#: The weight of a word that no template has: about that of a template's word which one file in 150 has.
UNKNOWN = 6.0
WORD = re.compile(rb"[a-z0-9]+(?:[.\-][a-z0-9]+)*")
COMMENT = re.compile(rb"[ \t]*(?:#|//|/?\*|--|;|%|<!--)")
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|notice|unlicense)([.-].*)?$"

HEADER = "This program is free software: you can redistribute it and/or modify it under the terms of the {0} Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {0} Public License for more details. You should have received a copy of the {0} Public License along with this program. If not, see <https://www.gnu.org/licenses/>."
ISC_REST = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'

# The usual statements and headers of common licences.
TEMPLATES: dict[str, list[str]] = {
    "AGPL-3.0": ["This program is licensed under the GNU Affero General Public License, version 3.", HEADER.format("GNU Affero General")],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related rights to this work.", "SPDX-License-Identifier: CC0-1.0"],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        HEADER.format("GNU General"),
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. " + ISC_REST],
    "LGPL-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3.", HEADER.format("GNU Lesser General")],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

for _file in sorted((Path(__file__).parent / "licences").glob("*.txt")):  # whole texts
    TEMPLATES[_file.stem].append(_file.read_text(encoding="utf-8"))


def words(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


def blocks(text: bytes) -> list[bytes]:
    """Each line, and each run of two or more comment lines joined."""
    lines = text.split(b"\n")
    out, run = list(lines), []
    for line in [*lines, b""]:
        if COMMENT.match(line):
            run.append(line)
        else:
            if len(run) > 1:
                out.append(b" ".join(run))
            run = []
    return out


class Matcher:
    """Sparse TF-IDF vectors of the templates, and the best one for a block."""

    def __init__(self, templates: dict[str, list[str]], df: dict[bytes, int], n: int):
        self.idf = {w: math.log((1 + n) / (1 + k)) + 1 for w, k in df.items()}
        self.rare = math.log(1 + n) + 1
        self.names: list[str] = []
        self.weights: list[dict[bytes, float]] = []
        self.lengths: list[int] = []
        self.of_word: dict[bytes, list[tuple[int, float]]] = {}
        for name in sorted(templates):
            for text in templates[name]:
                ws = words(text.encode())
                for w in ws:
                    self.idf.setdefault(w, self.rare)
                v = {w: k * self.idf[w] for w, k in Counter(ws).items()}
                norm = math.sqrt(sum(x * x for x in v.values()))
                for w, x in v.items():
                    self.of_word.setdefault(w, []).append((len(self.names), (x / norm) ** 2))
                self.weights.append({w: x / norm for w, x in v.items()})
                self.lengths.append(len(ws))
                self.names.append(name)

    def candidates(self, ws: list[bytes], threshold: float) -> list[int]:
        """Templates that some block of these words can reach: by Cauchy-Schwarz, those whose weights are in them to threshold**2."""
        share = [0.0] * len(self.names)
        for w in self.of_word.keys() & set(ws):
            for i, y in self.of_word[w]:
                share[i] += y
        return [i for i, x in enumerate(share) if x >= threshold * threshold - 1e-9]

    def best(self, block: bytes, among: list[int] | None = None) -> tuple[float, str | None]:
        return self.best_words(words(block), among)

    def best_words(self, ws: list[bytes], among: list[int] | None = None) -> tuple[float, str | None]:
        if not any(w in self.of_word for w in ws):
            return 0.0, None
        v = {w: k * self.idf.get(w, UNKNOWN) for w, k in Counter(ws).items()}
        square = sum(x * x for x in v.values())
        dots = [(sum(x * self.weights[i].get(w, 0.0) for w, x in v.items()), -i) for i in (range(len(self.names)) if among is None else among)]
        top, i = max(dots, default=(0.0, 0))
        return top / math.sqrt(square), self.names[-i] if dots else None

    def windows(self, ws: list[bytes], i: int) -> tuple[float, str | None]:
        """The best window of template i's length, by a sum that slides over the words."""
        n, y = self.lengths[i], self.weights[i]
        if len(ws) <= n:
            return self.best_words(ws, [i])
        idf, count = [self.idf.get(w, UNKNOWN) for w in ws], {}
        dot = square = best = 0.0
        at = 0
        for j, w in enumerate(ws):
            x, c = idf[j], count.get(w, 0)
            count[w] = c + 1
            dot += x * y.get(w, 0.0)
            square += (2 * c + 1) * x * x
            if j >= n:
                old, x = ws[j - n], idf[j - n]
                c = count[old]
                count[old] = c - 1
                dot -= x * y.get(old, 0.0)
                square -= (2 * c - 1) * x * x
            if j >= n - 1 and dot > 0 and dot * dot > best * square:
                best, at = dot * dot / square, j - n + 1
        return self.best_words(ws[at : at + n], [i])


def document_frequencies(files: DataFrame, templates: dict[str, list[str]]) -> tuple[dict[bytes, int], int]:
    """In how many files each word of the templates occurs, and the number of files; over all of them."""
    vocabulary = sorted({w for ts in templates.values() for t in ts for w in words(t.encode())})
    known = set(vocabulary)
    small_batches(files.sparkSession)

    def run(batches):
        total, n = Counter(), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n += 1
                if text:
                    total.update(known.intersection(words(text.encode())))
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in vocabulary] + [None], pa.string()), pa.array([total[w] for w in vocabulary] + [n], pa.int64())], names=["word", "n"])

    rows = files.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()  # a row a template word
    df = {r["word"].encode(): r["n"] for r in rows if r["word"] is not None}
    return df, next((r["n"] for r in rows if r["word"] is None), 0)


OWN = T.StructType([T.StructField("file_id", T.LongType()), T.StructField("path", T.StringType()), T.StructField("own", T.StringType()), T.StructField("cosine", T.DoubleType())])


def own_licences(files: DataFrame, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """file_id, path, own (the licence that the file states, or null) and its cosine, of files (file_id, path, text)."""
    df, n = document_frequencies(files, templates)
    matcher = Matcher(templates, df, n)
    licence_file = re.compile(LICENCE_FILE)

    def step(rows, texts):
        own, cosine = [], []
        for path, text in zip(rows.column("path").to_pylist(), texts, strict=True):
            ws = words(text)
            among = matcher.candidates(ws, threshold)
            if not among:
                own.append(None)
                cosine.append(None)
                continue
            found = [matcher.best(b, among) for b in blocks(text)] + [matcher.windows(ws, i) for i in among]
            if path is not None and licence_file.match(path.rpartition("/")[2]):
                found.append(matcher.best_words(ws, among))
            x, name = max(found, key=lambda m: (round(m[0], 9), [-c for c in (m[1] or "").encode()]))
            own.append(name if x >= threshold else None)
            cosine.append(round(x, 6) if x >= threshold else None)
        return {"file_id": rows.column("file_id"), "path": rows.column("path"), "own": own, "cosine": cosine}

    return map_texts(files.select("file_id", "path", "text"), "text", OWN, step)


def scan(files: DataFrame, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """file_id, path, licence, cosine, origin (own, inherited or none) and licensed_by (the directory that an inherited one is from)."""
    own, _ = keep(own_licences(files, templates, threshold), "own-licences")  # read three times below
    own = own.withColumn("dir", F.when(F.instr("path", "/") > 0, F.regexp_replace("path", "/[^/]*$", "")).when(F.col("path").isNotNull(), F.lit("")))
    named = F.regexp_extract("path", "[^/]*$", 0).rlike(LICENCE_FILE)
    licensed = own.filter(F.col("own").isNotNull() & named).groupBy(F.col("dir").alias("licensed_by"))
    licensed = licensed.agg(F.min_by(F.struct("own", "cosine"), F.struct(-F.col("cosine"), "own")).alias("l")).select("licensed_by", F.col("l.own").alias("given"), F.col("l.cosine").alias("given_cosine"))
    parts = F.split("dir", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    dirs = own.select("dir").filter("dir IS NOT NULL").distinct().withColumn("licensed_by", F.explode(F.array_distinct(ancestors)))
    nearest = dirs.join(licensed, "licensed_by").groupBy("dir").agg(F.max_by(F.struct("licensed_by", "given", "given_cosine"), F.length("licensed_by")).alias("n"))
    out = own.join(nearest, "dir", "left")
    inherits = F.col("own").isNull() & F.col("n").isNotNull()
    return out.select(
        "file_id", "path", F.coalesce("own", "n.given").alias("licence"), F.coalesce("cosine", "n.given_cosine").alias("cosine"),
        F.when(F.col("own").isNotNull(), "own").when(inherits, "inherited").otherwise("none").alias("origin"),
        F.when(inherits, F.col("n.licensed_by")).alias("licensed_by"),
    )
