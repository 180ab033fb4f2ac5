"""License scans by TF-IDF similarity to templates, with inheritance down directories.

Whole licence texts, standard headers and short notices are sparse TF-IDF
vectors. Runs of as many words of a file, and its lines, are compared with them
by cosine; a file that is mostly license text is a licence file of its directory. Files without a license of their own take that
of the nearest ancestor directory with a licence file, found by joining their
ancestor paths.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from importlib.resources import files

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, grown, no_null, sheltered

#: Notices by SPDX id, compared with lines and with runs of words.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("Proprietary", "All rights reserved."),
)
_GNU = "%s is free software; you can redistribute it and/or modify it under the terms of the GNU %s General Public License as published by the Free Software Foundation; either version %s of the License, or (at your option) any later version. %s is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU %s General Public License for more details. You should have received a copy of the GNU %s General Public License along with %s."
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted%s. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
#: Headers, names and short texts, compared with runs of words only.
HEADERS = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    *((f"GPL-{v}.0", " ".join((_GNU % (("This program", "", v, "This program", "", "", "this program"))).split())) for v in "23"),
    *((f"LGPL-{v}", _GNU % ("This library", "Lesser", v, "This library", "Lesser", "Lesser", "this library")) for v in ("2.1", "3.0")),
    *((f"AGPL-{v}.0", _GNU % ("This program", "Affero", v, "This program", "Affero", "Affero", "this program")) for v in "3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("ISC", _ISC % ", provided that the above copyright notice and this permission notice appear in all copies"),
    ("0BSD", _ISC % ""),
    ("MIT", "MIT License"),
    ("MIT", "Licensed under the MIT license"),
    ("ISC", "ISC License"),
    ("Apache-2.0", "Apache License Version 2.0"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("GPL-1.0-or-later", "GNU General Public License"),
    ("GPL-2.0", "GNU General Public License Version 2"),
    ("GPL-3.0", "GNU General Public License Version 3"),
    ("LGPL-2.0-or-later", "GNU Lesser General Public License"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3"),
    ("AGPL-3.0", "GNU Affero General Public License"),
    *((f"CC-{a}-4.0", f"This work is licensed under a Creative Commons {b} 4.0 International License.") for a, b in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))),
    *((f"CC-{a}-4.0", f"CC {a} 4.0") for a in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")),
    ("CC0-1.0", "CC0 1.0 Universal"),
)
#: Whole texts, by file name.
TEXTS = tuple(sorted((f.name.removesuffix(".txt"), f.read_text()) for f in (files(__package__) / "license_texts").iterdir() if f.name.endswith(".txt")))
TEMPLATES = (*NOTICES, *HEADERS, *TEXTS)
SIMILARITY = 0.75
#: A run of words is a template of at most so many terms only where it has all of them.
SHORT = 8
#: All rights reserved, after copyright and at most so many words before a license, is part of its copyright line.
NEAR = 12
#: Share of its words in license lines that makes a text a licence file.
FILE_SHARE = 0.5
_WORD = re.compile(r"[a-z]+|\d+(?:\.\d+)*")
_SPDX = re.compile(r"spdx-license-identifier:[ \t]*((?:\(+[ \t]*)?[\w.+-]+(?:[ \t]+(?:and|or|with)[ \t]+[\w.+()-]+|[ \t]*\))*)", re.I)
_FILE = r"(?i)^(licen[cs]e|copying|notice|unlicense)([.\-_].*)?$"


def _terms(line: str) -> list[str]:
    return _WORD.findall(line.lower())


VOCABULARY = frozenset(["spdx", *(t for _, text in TEMPLATES for t in _terms(text))])


def line_counts(docs: DataFrame, text: str = "text") -> dict[str, int]:
    """How many lines of all files have each term of the templates; under the empty name, how many lines there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                for line in (t.as_py() or "").splitlines():
                    total[""] += 1
                    total.update(VOCABULARY.intersection(_terms(line)))
        yield pa.RecordBatch.from_arrays([pa.array([*total], pa.string()), pa.array([*total.values()], pa.int64())], names=["term", "n"])

    counts = docs.select(text).mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r["term"]: r["n"] for r in counts.collect()}  # no more than the templates' terms


class Matcher:
    """Templates as unit TF-IDF vectors; terms outside of them have the largest idf."""

    def __init__(self, counts: dict[str, int]) -> None:
        lines = counts.get("", 0) + len(TEMPLATES)
        self.idf = {t: math.log((1 + lines) / (1 + counts.get(t, 0))) + 1 for t in VOCABULARY}
        self.rare = math.log(1 + lines) + 1
        self.names, terms = [name for name, _ in TEMPLATES], [_terms(text) for _, text in TEMPLATES]
        self.units, self.lengths = [self._unit(Counter(t)) for t in terms], [len(t) for t in terms]
        #: By template, the terms without one of which a text cannot reach the threshold.
        self.telling = []
        for w in self.units:
            rest, needed = 0.0, set()
            for t, x in sorted(w.items(), key=lambda i: (i[1], i[0])):
                rest += x * x
                if rest >= SIMILARITY**2 * 0.999:
                    needed.add(t)
            self.telling.append(needed)
        self.any = frozenset({"spdx"}.union(*self.telling))
        self.holders: dict[str, list[tuple[int, float]]] = {}
        for k, w in enumerate(self.units):
            for t, x in w.items():
                self.holders.setdefault(t, []).append((k, x * x))
        self.templates = [*zip(self.names, self.units, strict=True)][: len(NOTICES)]

    def _unit(self, tf: Counter) -> dict[str, float]:
        v = {t: (1 + math.log(n)) * self.idf.get(t, self.rare) for t, n in tf.items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {t: x / norm for t, x in v.items()}

    def line(self, line: str) -> tuple[str, float] | None:
        terms = _terms(line)
        if not VOCABULARY.intersection(terms):
            return None
        tf = Counter(terms)
        known = sum(((1 + math.log(n)) * self.idf[t]) ** 2 for t, n in tf.items() if t in VOCABULARY)
        other = sum(((1 + math.log(n)) * self.rare) ** 2 for t, n in tf.items() if t not in VOCABULARY)
        if known < SIMILARITY**2 * (known + other):  # no template can reach the threshold
            return None
        v = self._unit(tf)
        score, name = max((sum(x * v.get(t, 0.0) for t, x in w.items()), name) for name, w in self.templates)
        return (name, score) if score >= SIMILARITY else None

    def runs(self, k: int, terms: list[str]) -> list[tuple[float, int, int]]:
        """Similarity and range of the best runs of terms, as many as template k has, that reach the threshold and do not overlap."""
        w, size, telling = self.units[k], min(self.lengths[k], len(terms)), self.telling[k]
        found: list[tuple[float, int, int]] = []
        starts: list[list[int]] = []  # ranges of starts whose runs hold a telling term
        for at in (i for i, t in enumerate(terms) if t in telling):
            first, last = max(0, at - size + 1), min(at, len(terms) - size)
            if starts and first <= starts[-1][1] + size:
                starts[-1][1] = max(starts[-1][1], last)
            elif first <= last:
                starts.append([first, last])
        for first, last in starts:
            tf: Counter = Counter()
            dot = norm = 0.0
            for i in range(first, last + size):
                steps = ((terms[i], 1),) if i - first < size else ((terms[i - size], -1), (terms[i], 1))
                for t, d in steps:
                    n, idf = tf[t], self.idf.get(t, self.rare)
                    tf[t] = n + d
                    a, b = 1 + math.log(n) if n else 0.0, 1 + math.log(n + d) if n + d else 0.0
                    dot += (b - a) * idf * w.get(t, 0.0)
                    norm += (b * b - a * a) * idf * idf
                start = i - size + 1
                if start >= first and norm > 0 and dot >= SIMILARITY * math.sqrt(norm) and (self.lengths[k] > SHORT or all(tf[t] for t in w)):
                    found.append((min(dot / math.sqrt(norm), 1.0), start, start + size))
        best: list[tuple[float, int, int]] = []
        taken = bytearray(len(terms))
        for score, a, b in sorted(found, key=lambda f: (-round(f[0], 9), f[1])):
            if not (taken[a] or taken[b - 1]):
                best.append((score, a, b))
                taken[a:b] = b"\1" * (b - a)
        return best

    def file(self, text: str | None) -> tuple[list[str], float, bool]:
        """Licenses by place, the best similarity, and whether most words are license text.

        Of matches that overlap by half the one of most words counts, less for
        each lack of similarity.
        """
        low = (text or "").lower()
        have = set(_WORD.findall(low))
        if not have & self.any:
            return [], 0.0, False
        places = [(m[0], m.start(), m.end()) for m in _WORD.finditer(low)]
        terms, index = [p[0] for p in places], [p[1] for p in places]
        reach = [0.0] * len(self.units)
        for t in have & VOCABULARY:
            for k, x in self.holders.get(t, ()):
                reach[k] += x
        matches = [(score, a, b, self.names[k]) for k, r in enumerate(reach) if r >= SIMILARITY**2 * 0.999 for score, a, b in self.runs(k, terms)]
        at = 0
        for line in low.splitlines(keepends=True):
            a, b = bisect_left(index, at), bisect_left(index, at + len(line))
            at += len(line)
            if a < b and (found := self.line(line)):
                matches.append((found[1], a, b, found[0]))
        if "spdx" in have:
            for m in _SPDX.finditer(text or ""):
                a = bisect_left(index, m.start())
                name = " ".join(m[1].split())
                matches.append((1.0, a, max(a + 1, bisect_left(index, m.end())), f"({name})" if " " in name and name[0] != "(" else name))
        taken, kept = bytearray(len(terms)), []
        for score, a, b, name in sorted(matches, key=lambda m: (-(m[2] - m[1]) * round(m[0], 9) ** 8, m[1], m[3])):
            if 2 * sum(taken[a:b]) < b - a:
                taken[a:b] = b"\1" * (b - a)
                kept.append((a, b, name, score))
        kept.sort()
        kept = [m for i, m in enumerate(kept) if not (m[2] == "Proprietary" and i + 1 < len(kept) and kept[i + 1][0] - m[1] <= NEAR and "copyright" in terms[max(0, m[0] - NEAR) : m[1]])]
        spans = [low[index[a] : places[b - 1][2]] for a, b, _, _ in kept]
        inside, words = sum(len(x.split()) for x in spans), len(low.split())
        return [*dict.fromkeys(m[2] for m in kept)], max((m[3] for m in kept), default=0.0), bool(kept) and inside >= FILE_SHARE * words


def scan(docs: DataFrame, path: str = "path", text: str = "text", with_text: bool = True) -> DataFrame:
    """docs (files) with found (licenses in the text), similarity, is_license_file, license and inherited_from.

    license is the file's own licenses joined by AND, else those of the nearest
    ancestor directory (its own first) with a licence file: one that is mostly
    license text or, having a license, is named like one. Several licence files
    of one directory are joined by AND. inherited_from is that directory; null
    where nothing is inherited. Null or empty texts have no license; null paths
    neither give nor inherit; repeated rows fare alike, an empty table stays
    empty. Columns with these names are replaced, others may have any names.
    Without with_text the texts go, and what was found in them is written once;
    else they are searched once more for the rows of the result.
    """
    kept = docs.drop("found", "similarity", "is_license_file", "license", "inherited_from").withColumnsRenamed({path: "path", text: "text"} if (path, text) != ("path", "text") else {})
    out = sheltered(kept, ("path", "text"), lambda d: _scanned(d, "path", "text", with_text))
    return out if (path, text) == ("path", "text") else out.withColumnsRenamed({"path": path, "text": text})


def _scanned(kept: DataFrame, path: str, text: str, with_text: bool) -> DataFrame:
    matcher = Matcher(line_counts(kept, text))
    at = kept.columns.index(text)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [matcher.file(t.as_py()) for t in b.column(at)]
            new = [pa.array([g[0] for g in got], pa.list_(pa.string())), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, "found", "similarity", "is_license_file"])

    out = kept.mapInArrow(match, grown(kept.schema, "found array<string>, similarity double, is_license_file boolean"))
    name, directory = F.regexp_extract(path, r"([^/]*)$", 1), F.regexp_replace(F.regexp_replace(F.col(path), r"[^/]*$", ""), r"/+$", "")
    if not with_text:
        out = Scratch(kept.sparkSession, "licenses").keep(out.drop(text))
    out = out.withColumn("is_license_file", F.col("is_license_file") | (no_null(name).rlike(_FILE) & (F.size("found") > 0))).withColumn("_dir", directory)
    given = out.where("is_license_file and _dir is not null").select("_dir", F.explode("found").alias("l")).groupBy(F.col("_dir").alias("_from")).agg(F.array_join(F.array_sort(F.collect_set("l")), " AND ").alias("_given"))
    # Directories, not files, are joined with their ancestors: a directory of any number of files is one row.
    parts = F.split("_dir", "/")
    dirs = (kept if with_text else out).select(directory.alias("_dir")).where("_dir is not null").select("_dir").distinct().withColumn("_depth", F.explode(F.sequence(F.lit(0), F.size(parts))))
    dirs = dirs.withColumn("_up", F.array_join(F.slice(parts, 1, F.col("_depth")), "/")).dropDuplicates(["_dir", "_up"])
    nearest = dirs.join(given, F.col("_up") == F.col("_from")).groupBy("_dir").agg(F.max(F.struct("_depth", "_from", "_given")).alias("_n"))
    out = out.join(nearest.withColumnRenamed("_dir", "_d"), F.col("_dir") == F.col("_d"), "left")
    own = F.size("found") > 0
    return out.withColumn("license", F.when(own, F.array_join("found", " AND ")).otherwise(F.col("_n._given"))).withColumn("inherited_from", F.when(~own, F.col("_n._from"))).drop("_d", "_n", "_dir")


def op6(docs: DataFrame) -> DataFrame:
    """Documents as files source/lang/doc_id."""
    path = F.concat_ws("/", no_null(F.col("source")), no_null(F.col("lang")), F.col("doc_id").cast("string"))
    out = scan(docs.select("doc_id", "text", path.alias("path")), with_text=False)
    return out.select("doc_id", "path", F.array_join("found", ",").alias("found"), "similarity", "is_license_file", "license", "inherited_from")
