"""License scans: TF-IDF cosine of headers and license files to templates, then inheritance.

Everything is DataFrame expressions. Terms are runs of a-z, 0-9, dots and
characters beyond ASCII after lower-casing; every term has its counted document
frequency over all texts. A header is a line of a text, a window of up to 16
consecutive lines that hold terms, or a longer paragraph (lines with at most one
without terms between two) as a whole, with copyright statements left out; its best
template or notice at ``header_cut`` or above is the file's license, and its line is
the first. A text that as a whole reaches ``file_cut`` for a template, a full text or
a full text's profile (its weightiest terms) is a license file; a text is compared
if it allows the cut for a template or full text, or holds half of the terms of a
profile that are no function words. A license file is under that license, and speaks
for its directory and all below. A file without a license of its own inherits from the
nearest directory above it, its own first, that holds a license file.

Each text is cut into terms once for the terms of the templates. By the
Cauchy-Schwarz inequality a unit needs one of a template's heaviest terms, and enough
of them: only texts that allow the cut are read again, and only units whose cosine over
known terms reaches it are scored in full. The frequencies of their other terms are
aggregated on each task before they meet the terms that are wanted.

A null or empty text has no license of its own; a null path is a file in the root.
Texts under one path are versions of a file, and the best counts. Of equal scores
the template named first in the alphabet wins, then the first line. Several license
files in a directory: the best score, then the first path. Repeated rows get equal
results. Result columns replace input columns of the same name; the others pass
through.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwatch.runtime import Scratch

# License ids and the usual wording of their notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

_GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version."
_GNU_REST = " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details."
_APACHE = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'
_APACHE_REST = ' Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'
# Longer wordings of notices, and the marks of SPDX.
NOTICES = [
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", _APACHE + _APACHE_REST),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    *[
        (name, (_GNU + rest).format(*of))
        for name, of in [
            ("GPL-2.0", ("General Public License", "2")),
            ("GPL-3.0", ("General Public License", "3")),
            ("LGPL-3.0", ("Lesser General Public License", "3")),
        ]
        for rest in ("", _GNU_REST)
    ],
    ("MPL-2.0", TEMPLATES[-1][1] + " If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    *[(name, f"SPDX-License-Identifier: {name}") for name in sorted({n for n, _ in TEMPLATES})],
    *[(name, f"SPDX-License-Identifier: {name}-or-later") for name in ("GPL-2.0", "GPL-3.0", "LGPL-3.0")],
    *[(name, f"SPDX-License-Identifier: {name}-only") for name in ("GPL-2.0", "GPL-3.0", "LGPL-3.0")],
]
# Texts of whole license files. A notice is none: source files that begin with one are no license files.
FULL_TEXTS = [
    ("BSD-3-Clause", TEMPLATES[1][1][:-1] + """ provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("MIT", """MIT License
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
]
# Whole license files by their weightiest terms: how often each occurs in the published text.
PROFILES = [
    ("Apache-2.0", "the 100 or 69 of 67 and 46 to 40 license 35 work 34 works 19 derivative 18 such 18 shall 15 conditions 13 copyright 13 form 13 source 12 contributor 10 entity 10 licensor 10 mean 10 use 10 including 9 may 9"),
    ("CC0-1.0", "the 66 and 55 of 50 or 45 to 29 work 26 rights 22 affirmer 17 copyright 11 related 11 s 11 including 9 commons 8 law 8 purpose 8 applicable 7 cc0 7 creative 7 other 7 use 7 waiver 7 without 7"),
    ("GPL-2.0", "the 194 to 108 of 104 or 77 you 76 and 72 program 71 a 57 license 46 software 35 free 28 work 24 distribute 19 copy 18 other 18 terms 18 may 17 code 16 distribution 16 public 16 source 16 general 15"),
    ("GPL-3.0", "the 345 of 221 to 192 a 184 or 151 you 128 license 102 work 97 program 52 source 42 covered 41 code 34 terms 32 may 31 copyright 30 other 30 software 27 an 26 convey 26 copy 25 public 25 version 25"),
    ("LGPL-2.1", "the 349 of 160 library 140 to 140 a 123 and 91 you 88 license 76 work 58 free 36 software 35 copy 30 public 29 general 27 use 27 other 26 terms 26 version 25 code 23 distribute 23 must 23 may 21"),
    ("LGPL-3.0", "the 114 of 60 a 44 library 34 version 27 license 25 work 24 combined 21 gnu 21 application 14 public 12 code 11 general 11 copy 10 gpl 10 an 9 corresponding 9 lesser 9 may 9 3 8 source 8 terms 8"),
    ("MPL-1.1", "the 229 of 158 or 123 code 98 to 95 license 81 a 77 you 74 contributor 54 covered 42 such 41 version 39 initial 27 modifications 27 developer 26 which 25 original 24 rights 24 source 24 terms 24 may 21 must 20"),
    ("MPL-2.0", "the 130 of 115 license 69 or 67 to 62 a 55 you 50 this 49 software 39 covered 36 contributor 35 such 32 form 29 code 21 source 20 terms 20 means 18 version 17 may 16 its 14 rights 14 licenses 13"),
]
# Function words among them: they tell nothing about a license by themselves.
FUNCTION_WORDS = set(
    "a and any are as be by for from if in is it not of on or that the this to under with you your".split()
)
#: Lines with terms in the windows that are taken at every place; longer paragraphs count as a whole.
LONGEST = 16
_COPYRIGHT = r"(?i)\b(?:copyright|\(c\))[^.\n]*[.]?"

_BREAK = r"[^a-z0-9.\x{80}-\x{10FFFF}]+"


def _terms_of(text: str) -> list[str]:
    """The terms of a template (ASCII), as :func:`_terms` cuts a column."""
    return [t for t in (re.sub(r"^\.+|\.+$", "", t) for t in re.split(r"[^a-z0-9.]+", text.lower())) if t]


def _terms(text: Column) -> Column:
    bare = F.transform(F.split(F.lower(text), _BREAK), lambda t: F.btrim(t, F.lit(".")))
    return F.filter(bare, lambda t: t != "")


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _counts(body: str, profile: bool) -> Counter:
    """Terms of a template with their numbers."""
    parts = body.split()
    return Counter(dict(zip(parts[::2], map(int, parts[1::2])))) if profile else Counter(_terms_of(body))


def _vectors(templates: list[Counter], weight: dict[str, float]) -> list[dict[str, float]]:
    """Unit vectors of the templates."""
    out = []
    for counts in templates:
        raw = {t: n * weight[t] for t, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        out.append({t: w / norm for t, w in raw.items()})
    return out


def _needed(vectors: list[dict[str, float]], cut: float) -> list[str]:
    """Terms of which a text has one at least if its cosine to any template reaches *cut*."""
    needed = set()
    for v in vectors:
        rest = 1.0
        for term, w in sorted(v.items(), key=lambda x: (-x[1], x[0])):
            if rest < (0.999 * cut) ** 2:
                break
            needed.add(term)
            rest -= w * w
    return sorted(needed)


def _vocabulary(spark: SparkSession, weight: dict[str, float], vectors: list[dict[str, float]]) -> DataFrame:
    """term, weight, and its entry in each template; as many rows as the templates have terms."""
    rows = ", ".join(
        f"({_quoted(t)}, {w!r}D, array({', '.join(f'{v.get(t, 0.0)!r}D' for v in vectors)}))"
        for t, w in sorted(weight.items())
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS v(term, weight, entries)")


def directory(path: Column) -> Column:
    """The directory of a path, without a slash at its end; the root is empty."""
    return F.regexp_replace(F.coalesce(path, F.lit("")), "/*[^/]*$", "")


def _bounded(
    rows: DataFrame, keys: list[str], terms: str, vocabulary: DataFrame, heads: tuple[int, float], rest: tuple[int, float]
) -> DataFrame:
    """Keys of the rows whose terms allow a cosine of at least its cut to one of the templates.

    The first ``heads[0]`` templates have one cut, the *rest* another: ``heads`` and ``rest`` tell which.

    By Cauchy and Schwarz it is at most the length of the template's vector over these terms.
    """
    of, n = heads[0], heads[0] + rest[0]
    sums = [F.sum(F.col("entries")[k] * F.col("entries")[k]).alias(f"s{k}") for k in range(n)]
    known = rows.select(*keys, F.explode(F.array_distinct(terms)).alias("term"))
    known = known.join(F.broadcast(vocabulary), "term").groupBy(*keys).agg(*sums)

    def reach(ks, cut):
        return F.greatest(F.lit(0.0), F.lit(0.0), *[F.col(f"s{k}") for k in ks]) >= (0.999 * cut) ** 2

    known = known.select(*keys, reach(range(of), heads[1]).alias("heads"), reach(range(of, n), rest[1]).alias("rest"))
    return known.filter("heads or rest")


def _promising(
    units: DataFrame, keys: list[str], vocabulary: DataFrame, first: int, last: int, cut: float
) -> DataFrame:
    """Keys of the units that may reach *cut* for one of the templates from *first* to before *last*.

    ``terms`` holds a unit's known terms. The others can only make it longer, so the
    cosine over the known ones is never less than the true one.
    """
    counted = units.select(*keys, F.explode("terms").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("n"))
    w = F.col("n") * F.col("weight")
    sums = [F.sum(w * F.col("entries")[k]).alias(f"d{k}") for k in range(first, last)]
    known = counted.join(F.broadcast(vocabulary), "term").groupBy(*keys).agg(F.sum(w * w).alias("square"), *sums)
    most = F.greatest(F.lit(0.0), *[F.col(f"d{k}") for k in range(first, last)])
    return known.filter(most >= 0.999 * cut * F.sqrt("square")).select(*keys)


def _idf(total: int, count: int) -> float:
    return math.log((1 + total) / (1 + count)) + 1


def _windows(lines: DataFrame, key: list[str], known: list[str]) -> DataFrame:
    """Windows at every place, and long paragraphs: first line, size, lines, and their known terms."""
    # Windows over known terms only. One with a line that holds none at an end scores less
    # than the window without that line.
    hits = lines.select(*key, "line", F.filter("terms", lambda t: t.isin(known)).alias("hits"))
    order = Window.partitionBy(*key).orderBy("line")
    marked = (
        hits.withColumn("gap", F.col("line") - F.lag("line").over(order))
        .withColumn("paragraph", F.sum(F.when(F.col("gap") > 2, 1).otherwise(0)).over(order))
        .withColumn("ahead", F.collect_list(F.struct("line", "hits")).over(order.rowsBetween(0, LONGEST - 1)))
    )
    windows = (
        marked.filter(F.size("hits") > 0)
        .select(*key, "line", "ahead", F.explode(F.sequence(F.lit(1), F.size("ahead"))).alias("size"))
        .filter(F.size(F.element_at("ahead", F.col("size"))["hits"]) > 0)
        .select(*key, "line", "size", F.slice("ahead", F.lit(1), F.col("size")).alias("ahead"))
    )
    paragraphs = (
        marked.groupBy(*key, "paragraph")
        .agg(F.min("line").alias("line"), F.sort_array(F.collect_list(F.struct("line", "hits"))).alias("ahead"))
        .withColumn("size", F.size("ahead"))
        .filter(F.col("size") > LONGEST)
        .select(*key, "line", "size", "ahead")
    )
    return windows.unionByName(paragraphs).select(
        *key, "line", "size", F.col("ahead.line").alias("parts"), F.flatten("ahead.hits").alias("terms")
    )


def _scored(
    files: DataFrame, path: str, text: str, templates: list[tuple[str, str]],
    header_cut: float, file_cut: float, job: Scratch,
) -> DataFrame:
    """path and best (minus, name, line) of lines, windows and paragraphs, and of whole texts under line -1."""
    spark = files.sparkSession
    notices = [(name, _counts(body, False)) for name, body in [*templates, *NOTICES]]
    whole = [(name, _counts(body, False)) for name, body in [*templates, *FULL_TEXTS]]
    whole += [(name, _counts(body, True)) for name, body in PROFILES]
    of, bodies = len(notices), [*notices, *whole]
    known = sorted({t for _, counts in bodies for t in counts})
    key = ["path", "version"]
    named = files.select(
        F.coalesce(path, F.lit("")).alias("path"), F.xxhash64(text).alias("version"), F.col(text).alias("text")
    )
    # The one pass over all texts: which known terms each has.
    found = F.array_distinct(F.filter(_terms(F.coalesce("text", F.lit(""))), lambda t: t.isin(known)))
    found = job.write(named.select(*key, found.alias("terms")), "found")
    total = found.count()
    # At most as many rows as the templates have terms.
    rows = found.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    count = {r["term"]: r["count"] for r in rows}
    weight = {t: _idf(total, count.get(t, 0)) for t in known}
    vectors = _vectors([counts for _, counts in bodies], weight)
    vocabulary = _vocabulary(spark, weight, vectors)
    texts_end = len(bodies) - len(PROFILES)
    needed = sorted({*_needed(vectors[:of], header_cut), *_needed(vectors[of:texts_end], file_cut)})
    maybe = found.filter(F.arrays_overlap("terms", F.array(*[F.lit(t) for t in needed])))
    heads, rest = (of, header_cut), (texts_end - of, file_cut)
    told = [sorted(counts.keys() - FUNCTION_WORDS) for _, counts in bodies[texts_end:]]
    half = [F.size(F.array_intersect("terms", F.array(*[F.lit(t) for t in some]))) * 2 >= len(some) for some in told]
    alike = found.filter(reduce(Column.__or__, half)).select(*key, F.lit(True).alias("alike")).distinct()
    able = _bounded(maybe, key, "terms", vocabulary, heads, rest).join(alike, key, "full")
    able = able.select(
        *key, F.coalesce("heads", F.lit(False)).alias("heads"), F.coalesce("rest", "alike").alias("rest"),
        F.coalesce("alike", F.lit(False)).alias("alike"),
    )
    able = job.write(able.select(*key, "heads", (F.col("rest") | F.col("alike")).alias("rest")), "able")
    texts = job.write(named.join(able, key).dropDuplicates(key), "able-texts")
    lines = (
        texts.filter("heads").select(*key, F.posexplode(F.split("text", "\n")).alias("line", "unit"))
        .select(*key, "line", _terms(F.regexp_replace("unit", _COPYRIGHT, " ")).alias("terms"))
        .filter(F.size("terms") > 0)
    )
    unit = [*key, "line", "size"]
    windows = _promising(_windows(lines, key, known), [*unit, "parts"], vocabulary, 0, of, header_cut)
    windows = job.write(windows.select(*unit, F.explode("parts").alias("part")), "windows")
    all_ = texts.filter("rest").select(
        *key, F.lit(-1).alias("line"), F.lit(0).alias("size"), _terms(F.col("text")).alias("terms")
    )
    hits = all_.withColumn("terms", F.filter("terms", lambda t: t.isin(known)))
    some = job.write(_promising(hits, key, vocabulary, of, len(bodies), file_cut), "whole-texts")
    all_ = all_.join(some, key, "left_semi")
    parts = lines.withColumnRenamed("line", "part")
    units = windows.join(parts, [*key, "part"]).select(*unit, "terms").unionByName(all_)
    terms = units.select(*unit, F.explode("terms").alias("term")).groupBy(*unit, "term")
    terms = job.write(terms.agg(F.count("*").alias("n")), "unit-terms")
    # Document frequencies of the other terms of these units, over all texts.
    others = job.write(terms.select("term").distinct().join(F.broadcast(vocabulary), "term", "left_anti"), "others")
    seen = named.select(F.explode(F.array_distinct(_terms(F.col("text")))).alias("term")).groupBy("term").count()
    other = seen.join(others, "term").select(
        "term", (F.log((F.lit(1.0) + total) / (F.lit(1.0) + F.col("count"))) + 1).alias("seen")
    )
    frequencies = job.write(other, "frequencies")
    weighed = terms.join(F.broadcast(vocabulary), "term", "left").join(frequencies, "term", "left")
    w = F.col("n") * F.coalesce("weight", "seen")
    sums = [F.sum(F.coalesce(w * F.col("entries")[k], F.lit(0.0))).alias(f"dot{k}") for k in range(len(bodies))]
    scored = weighed.groupBy(*unit).agg(F.sum(w * w).alias("square"), *sums)
    # Scores are rounded, so that ties are ties whatever the order of the sums.
    options = [
        F.struct((-F.round(F.col(f"dot{k}") / F.sqrt("square"), 9)).alias("minus"), F.lit(name).alias("name"))
        for k, (name, _) in enumerate(bodies)
    ]
    best = F.when(F.col("line") < 0, F.array_min(F.array(*options[of:]))).otherwise(F.array_min(F.array(*options[:of])))
    scored = scored.select("path", "line", best.alias("b")).select(
        "path", F.struct("b.minus", "b.name", "line").alias("best")
    )
    scored = job.write(scored, "scored")
    job.drop(found, able, texts, windows, some, terms, others, frequencies)
    return scored


def scan(
    files: DataFrame,
    path: str = "path",
    text: str = "text",
    header_cut: float = 0.8,
    file_cut: float = 0.5,
    templates: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """Add each file's own license, whether it is a license file, and the license in force."""
    job = Scratch(files.sparkSession, "licenses")
    added = ["own_license", "own_score", "own_line", "is_license_file", "license", "inherited_from"]
    scored = _scored(files, path, text, templates or TEMPLATES, header_cut, file_cut, job)
    header = F.when((F.col("best.line") >= 0) & (-F.col("best.minus") >= header_cut), F.col("best"))
    whole = F.when((F.col("best.line") < 0) & (-F.col("best.minus") >= file_cut), F.col("best"))
    own = job.write(
        scored.groupBy("path").agg(F.min(header).alias("header"), F.min(whole).alias("whole")), "own"
    )
    job.drop(scored)

    holders = own.filter("whole is not null").select(
        directory(F.col("path")).alias("holder"), F.struct("whole.minus", "whole.name", "path").alias("best")
    )
    holders = job.write(holders.groupBy("holder").agg(F.min("best").alias("best")), "holders")
    folders = files.select(directory(F.col(path)).alias("folder")).distinct()
    parts = F.split("folder", "/")
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("holder"))
    )
    inherited = job.write(
        folders.select("folder", F.explode(F.array_distinct(above)).alias("a"))
        .select("folder", "a.depth", "a.holder")
        .join(holders, "holder")
        .groupBy("folder")
        .agg(F.max_by(F.struct("best.name", "holder"), F.col("depth")).alias("from_above")),
        "inherited",
    )
    rest = [c for c in files.columns if c != text and c not in added]
    rows = files.select(
        *rest, F.coalesce(path, F.lit("")).alias("__path"), directory(F.col(path)).alias("__folder")
    )
    own = own.select(F.col("path").alias("__path"), F.col("header").alias("__header"), F.col("whole").alias("__whole"))
    inherited = inherited.select(F.col("folder").alias("__folder"), F.col("from_above").alias("__above"))
    rows = rows.join(own, "__path", "left").join(inherited, "__folder", "left")
    own_name = F.coalesce("__whole.name", "__header.name")
    return rows.select(
        *rest,
        own_name.alias("own_license"),
        F.round(-F.coalesce("__whole.minus", "__header.minus"), 6).alias("own_score"),
        F.col("__header.line").cast("bigint").alias("own_line"),
        F.col("__whole").isNotNull().alias("is_license_file"),
        F.coalesce(own_name, F.col("__above.name")).alias("license"),
        F.when(own_name.isNull(), F.col("__above.holder")).alias("inherited_from"),
    )
