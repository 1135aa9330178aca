"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory; built-ins only.

* **Candidates.** The lines of a file that speak of licensing, the few
  words (``NEAR``) around each word that does, and long windows of ``LONG`` words from
  every run of ``STEP`` words that does, over the whole text.  Equal candidates
  are scored once: they are grouped first, so a line that a third of all files
  share is one row.
* **Cosine.** Terms are lower-case runs of letters and digits.  Document
  frequencies count all distinct candidates and templates.  Template weights
  are a table of fixed size and are broadcast; all else joins on terms.
* **Inheritance.** A file is a licence file of its directory if a long window
  matches a licence's own text, if the whole file is one window that matches a
  short form, or if it has a match and is named as licences are; the commonest licence of a directory's licence files (ties:
  first by name) is the directory's.  A file without a licence of its own
  takes that of its nearest ancestor directory that has one, by joining the
  ancestors of each distinct directory once.

Defined cases: null or empty text has no licence of its own; null path parts
are left out of the path; a null path has no directory; ties between templates
go to the first by name; repeated rows are scanned each; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.session import materialize

#: Short forms by which licences are declared.
TEMPLATES = {
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "CC-BY-4.0": ["Licensed under the Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC0-1.0": ["Dedicated to the public domain under the CC0 1.0 Universal license.", "SPDX-License-Identifier: CC0-1.0"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0"],
    "ISC": ["Released under the ISC License.", "SPDX-License-Identifier: ISC"],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0"],
    "MIT": ["Released under the MIT License.", "SPDX-License-Identifier: MIT"],
    "MPL-2.0": ["Subject to the terms of the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "Proprietary": ["Copyright. All rights reserved.", "Proprietary and confidential. All rights reserved."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
}
_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
    "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_FREE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {0} as published by the Free "
    "Software Foundation, either version {1} of the License, or (at your option) any later version. This program is distributed in "
    "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
    "PARTICULAR PURPOSE. See the {0} for more details. You should have received a copy of the {0} along with this program.")
#: The licences' own texts, or where those run to thousands of words the notice that stands for them in files.
TEXTS = {
    "AGPL-3.0": _FREE.format("GNU Affero General Public License", 3),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
        "or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."),
    "BSD-2-Clause": _GRANT + _DISCLAIMER,
    "BSD-3-Clause": _GRANT + (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission. ") + _DISCLAIMER,
    "GPL-2.0": _FREE.format("GNU General Public License", 2),
    "GPL-3.0": _FREE.format("GNU General Public License", 3),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" "
        "AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
        "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "LGPL-3.0": _FREE.format("GNU Lesser General Public License", 3),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE."),
}
CUE = r"(?i)licen[sc]e|copyright|public domain|rights reserved|permission|redistribut"
CUE_WORD = r"(?i)licen[sc]e|copyright|domain|reserved"
#: How licence files are named: last part of a path.
NAMED = r"(?i)(^|/)(un)?(licen[sc]e|copying|copyright)[^/]*$"
#: Windows around a word that speaks of licensing, as (words before it, words in all): declarations end with it, begin with it or hold it.
NEAR = ((5, 7), (0, 8), (3, 12))
LONG, STEP, COSINE = 192, 32, 0.6


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _template_lines(spark: SparkSession) -> DataFrame:
    rows = [(name, line, False) for name, lines in TEMPLATES.items() for line in lines]
    return spark.createDataFrame(rows + [(name, text, True) for name, text in TEXTS.items()], "licence string, line string, full boolean")


def _best_match(lines: DataFrame) -> DataFrame:
    """``(key, licence, cosine, full)`` of each distinct candidate ``(key, line)`` that reaches the threshold; keys digest lines."""
    spark = lines.sparkSession
    templates = _template_lines(spark)
    tf = lambda df, *keys: df.select(*keys, F.explode(_terms(F.col("line"))).alias("term")).groupBy(*keys, "term").agg(
        F.count(F.lit(1)).alias("tf"))
    line_terms = materialize(tf(lines, "key"), "licence-terms")
    template_terms = tf(templates, "licence", "line", "full")
    total = lines.count() + sum(map(len, TEMPLATES.values())) + len(TEXTS)
    df = line_terms.select("term").unionByName(template_terms.select("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = df.select("term", (F.log(F.lit(float(1 + total)) / (1 + F.col("df"))) + 1).alias("idf"))

    weigh = lambda terms: terms.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    own = weigh(template_terms)
    length = own.groupBy("licence", "line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    own = own.join(length, ["licence", "line"]).select("licence", F.col("line").alias("template"), "full", "term",
                                                       (F.col("w") / F.col("length")).alias("share"))
    weighed = weigh(line_terms)
    lengths = weighed.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    dots = weighed.join(F.broadcast(own), "term").groupBy("key", "licence", "template", "full").agg(
        F.sum(F.col("w") * F.col("share")).alias("dot"))  # the terms of the templates: a fixed size
    best = dots.join(lengths, "key").select(
        "key", F.struct((-F.round(F.col("dot") / F.col("length"), 6)).alias("minus"), "licence", "full").alias("m")).groupBy("key").agg(
        F.min("m").alias("m"))
    return best.select("key", F.col("m.licence").alias("licence"), (-F.col("m.minus")).alias("cosine"), F.col("m.full").alias("full")).where(
        F.col("cosine") >= COSINE)


def scan_licenses(files: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, path, licence, origin, cosine, directory``; origin is file, header, inherited or none."""
    rows = files.select(files[id_col].cast("long").alias("doc_id"), path.cast("string").alias("path"),
                        files[text_col].cast("string").alias("text"))
    tidy = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    headers = F.transform(F.filter(F.split("text", r"\n"), lambda x: x.rlike(CUE)), tidy)
    cued = F.col("text").rlike(CUE)
    rows = rows.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", "path",
        F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("dir"), F.coalesce(F.col("path").rlike(NAMED), F.lit(False)).alias("named"),
        F.when(cued, F.array_distinct(headers)).alias("headers"), F.when(cued, F.split(F.trim("text"), r"\s+")).alias("words"))
    rows = materialize(rows, "licence-candidates")  # words are split once: what follows reads them

    piece = lambda line, kind: F.struct(line.alias("line"), F.lit(kind).alias("kind"))
    cut = lambda at, n: F.array_join(F.slice("words", at, n), " ")
    n = F.size("words")
    spots = F.filter(F.transform("words", lambda w, i: F.when(w.rlike(CUE_WORD), i)), lambda i: i.isNotNull())
    near = lambda before, size: F.transform(
        spots, lambda i: piece(cut(F.greatest(i + 1 - before, F.lit(1)), size), "line"))
    starts = F.filter(F.sequence(F.lit(1), n, F.lit(STEP)), lambda i: cut(i, STEP).rlike(CUE) & (n > LONG))
    cues = rows.where("headers is not null").select("rid", "dir", "named", F.explode(F.array_distinct(F.concat(
        F.transform("headers", lambda x: piece(x, "line")),
        *(near(*around) for around in NEAR),
        F.transform(starts, lambda i: piece(cut(i, LONG), "window")),
        F.when(n <= LONG, F.array(piece(cut(F.lit(1), LONG), "whole"))).otherwise(F.array())))).alias("c"))
    cues = cues.select("rid", "dir", "named", F.unhex(F.md5("c.line")).alias("key"), "c.line", "c.kind")
    lines = materialize(cues.groupBy("key").agg(F.first("line").alias("line")), "licence-lines")
    best = materialize(_best_match(lines), "licence-matches")
    hits = cues.drop("line").join(best, "key").where("kind <> 'window' or full").withColumn("file", (F.col("kind") == "whole") | F.col("full"))
    own = hits.groupBy("rid").agg(F.min(F.struct(
        (-F.col("cosine")).alias("minus"), (~F.col("file")).alias("header"), "licence")).alias("own"))

    # One vote a file: its best match of those that make it a licence file.
    votes = hits.where("file or named").groupBy("rid", "dir").agg(F.min(F.struct((-F.col("cosine")).alias("minus"), "licence")).alias("b"))
    votes = votes.groupBy("dir", F.col("b.licence").alias("licence")).agg(F.count(F.lit(1)).alias("n")).groupBy("dir").agg(
        F.min(F.struct((-F.col("n")).alias("minus"), "licence")).alias("v")).select(
        F.col("dir").alias("holder"), F.col("v.licence").alias("licence"))
    parts = F.split("dir", "/")
    chain = rows.select("dir").where("dir <> ''").distinct().select("dir", F.posexplode(F.transform(
        F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).alias("up", "holder"))
    given = chain.join(votes, "holder").groupBy("dir").agg(
        F.min(F.struct("up", "holder", "licence")).alias("given"))

    return rows.select("rid", "doc_id", "path", "dir").join(own, "rid", "left").join(given, "dir", "left").select(
        "doc_id", "path", F.coalesce("own.licence", "given.licence").alias("licence"),
        F.when(F.col("own").isNotNull(), F.when(F.col("own.header"), "header").otherwise("file"))
        .when(F.col("given").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(F.col("own").isNotNull(), -F.col("own.minus")).alias("cosine"),
        F.when(F.col("own").isNull(), F.col("given.holder")).alias("directory"))
