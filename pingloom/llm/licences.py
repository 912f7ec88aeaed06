"""Licence scan: sparse TF-IDF cosine of lines to templates, then inheritance from the nearest ancestor directory.

Each line of a text is a candidate header, and so is each run of two or three lines where no single line is a notice.  Words are
runs of ASCII letters and digits in lower case.  A word's weight is its count times ln((1 + N) / (1 + df)) + 1, N and df over
all documents for the words of the templates; other words have df 0, so noise beside a notice lowers the cosine.  By the
templates' weights, lines can reach THRESHOLD only with one of a few telling words (without them the rest of a template's vector is
too short); lines without any are not weighed.  A text that has telling words of the full templates is held against these as a
whole.

A document's own licence is that of its whole text, if that reaches THRESHOLD, else its best header's (ties: the first name).
It is the licence file of its directory (several: the first path) if its whole text is a licence, or its best header is at
least FILE_SHARE of its words.  A document without a licence of its own takes that of the nearest directory above it that
has a licence file.

Nulls and empty texts: no licence of their own, they may inherit.  A null path lies in no directory.  Repeated rows are each
reported.  A very long text is one row; its words are counted in place.  No documents: no rows.  No templates: no licences.  Extra columns are not read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import save

THRESHOLD = 0.6
FILE_SHARE = 0.25
WORD = "[^a-z0-9]+"

#: Short notices by which works name their licence.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 2-Clause License",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License",
    "CC-BY-4.0": "Licensed under the Creative Commons Attribution 4.0 International License CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3",
    "AGPL-3.0": "Licensed under the GNU Affero General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


#: Licence texts, without names and years.
FULL_TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do
so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR
DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS
OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the
copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without
specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY,
OR CONSEQUENTIAL DAMAGES HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT ARISING IN ANY
WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed
to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is
distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU
General Public License along with this program.""",
}


def template_words(text: str) -> list[str]:
    return [w for w in re.split(WORD, text.lower()) if w]


def document_frequencies(docs: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """The number of documents, and of those with each word of the templates."""
    known = F.array(*(F.lit(w) for w in vocabulary))
    found = docs.select(F.explode(F.array_intersect(F.split(F.lower("text"), WORD), known)).alias("word"))
    return docs.count(), {r["word"]: r["count"] for r in found.groupBy("word").count().collect()}


def telling_words(vectors: dict[str, dict[str, float]], threshold: float, idf: dict[str, float]) -> list[str]:
    """Words of which a text must have one to reach the threshold with any template; rare ones first, so that few texts have any."""
    out: set[str] = set()
    for vector in vectors.values():
        left = sum(w * w for w in vector.values())
        bound = threshold * threshold * left
        for word, w in sorted(vector.items(), key=lambda kv: (-idf[kv[0]], kv[0])):
            if left < bound:
                break
            out.add(word)
            left -= w * w
    return sorted(out)


def word_vectors(templates: dict[str, str], idf: dict[str, float]) -> dict[str, dict[str, float]]:
    return {name: {w: found.count(w) * idf[w] for w in found} for name, text in templates.items() for found in [template_words(text)]}


def cosine_to(vectors: dict[str, dict[str, float]], idf: dict[str, float], top: float):
    """words (an array) -> the best of struct<score, rank, licence, words> over the templates."""
    weights = F.create_map(*(x for w, v in idf.items() for x in (F.lit(w), F.lit(v))))
    names = sorted(vectors)

    def square(a):
        return F.coalesce(F.pow(a["n"] * F.coalesce(weights[a["w"]], F.lit(top)), F.lit(2)), F.lit(0.0))

    def count(a, w):
        """Over sorted words: the word, how often it has come, and the sum of squares of the words before it."""
        same = a["w"] == w
        return F.struct(w.alias("w"), F.when(same, a["n"] + 1).otherwise(1).alias("n"), F.when(same, a["sum"]).otherwise(a["sum"] + square(a)).alias("sum"))

    def best(words):
        none = F.struct(F.lit(None).cast("string").alias("w"), F.lit(0).alias("n"), F.lit(0.0).alias("sum"))
        norm = F.sqrt(F.aggregate(F.array_sort(words), none, count, lambda a: a["sum"] + square(a)))
        scores = []
        for rank, name in enumerate(names):
            size = math.sqrt(sum(v * v for v in vectors[name].values()))
            dot = _sum_of(words, {w: idf[w] * v for w, v in vectors[name].items()})
            scores.append(F.struct((dot / (norm * F.lit(size))).alias("score"), F.lit(-rank).alias("rank"), F.lit(name).alias("licence"), F.size(words).alias("words")))
        return F.array_max(F.array(*scores))

    return best


def _sum_of(words, values: dict[str, float]):
    """The sum of the words' values; words without one count nothing."""
    known = F.create_map(*(x for w, v in values.items() for x in (F.lit(w), F.lit(v))))
    return F.aggregate(words, F.lit(0.0), lambda a, w: a + F.coalesce(known[w], F.lit(0.0)))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD, full: dict[str, str] = FULL_TEMPLATES) -> DataFrame:
    """row, path, doc_id, n_words, licence, score, notice_words and whole of each row; docs: doc_id, path, text."""
    text = F.coalesce("text", F.lit(""))
    split = lambda t: F.filter(F.split(F.lower(t), WORD), lambda w: w != "")
    vocabulary = sorted({w for t in (*templates.values(), *full.values()) for w in template_words(t)})
    if not vocabulary:
        return docs.select("doc_id", "path", F.size(split(text)).alias("n_words"), F.lit(None).cast("string").alias("licence"), F.lit(None).cast("double").alias("score"), F.lit(0).alias("notice_words"), F.lit(False).alias("whole"))
    n, df = document_frequencies(docs, vocabulary)
    idf = {w: math.log((1 + n) / (1 + df.get(w, 0))) + 1 for w in vocabulary}
    top = math.log(1 + n) + 1
    headers, texts = word_vectors(templates, idf), word_vectors(full, idf)
    telling, telling_full = telling_words(headers, threshold, idf), telling_words(texts, threshold, idf)
    none = F.lit(None).cast("struct<score:double,rank:int,licence:string,words:int>")

    def any_of(words: list[str]):
        """A cheap look at the whole text first: most have none of the telling words."""
        by: dict[str, list[str]] = {}
        for w in words:
            by.setdefault(w[0], []).append(w[1:])
        pattern = f"(?<![a-z0-9])(?=[{''.join(by)}])(?:{'|'.join(f'{k}(?:{"|".join(v)})' for k, v in by.items())})(?![a-z0-9])"
        return F.coalesce(F.lower("text").rlike(pattern), F.lit(False)) if words else F.lit(False)

    rows = docs.select("doc_id", "path", F.size(split(text)).alias("n_words"), F.when(any_of(telling), F.filter(F.transform(F.split(text, "\n"), split), lambda ws: F.size(ws) > 0)).alias("lines"), F.when(any_of(telling_full), split(text)).alias("all_words"))
    wanted = F.array(*map(F.lit, telling)).cast("array<string>")
    told = lambda runs: F.filter(runs, lambda ws: F.arrays_overlap(ws, wanted))
    score = cosine_to(headers, idf, top) if headers else lambda _: none
    rows = rows.withColumn("line", F.array_max(F.transform(told(F.col("lines")), score)))
    # A notice that is wrapped: runs of two and three lines, only where no line is a notice and a run is no longer than one may be.
    longest = 3 * max((len(template_words(t)) for t in templates.values()), default=0)
    at = F.sequence(F.lit(1), F.size("lines") - 1)
    runs = F.flatten(F.transform(at, lambda k: F.array(F.flatten(F.slice("lines", k, F.lit(2))), F.flatten(F.slice("lines", k, F.lit(3))))))
    short = F.filter(runs, lambda ws: F.size(ws) <= longest)
    wrapped = F.when((F.size("lines") > 1) & ~F.coalesce(F.col("line.score") >= threshold, F.lit(False)), F.array_max(F.transform(told(short), score)))
    rows = rows.withColumn("header", F.greatest(F.col("line"), wrapped))
    # The whole text: only if enough of a full template's vector is there at all (a bound on the cosine).
    enough = F.lit(False)
    for vector in texts.values():
        size = sum(v * v for v in vector.values())
        there = _sum_of(F.array_distinct("all_words"), {w: v * v for w, v in vector.items()})
        enough = enough | (there >= threshold * threshold * size)
    rows = rows.withColumn("body", F.when(F.coalesce(enough, F.lit(False)), cosine_to(texts, idf, top)(F.col("all_words"))) if texts else none)
    good = lambda c: F.coalesce(F.col(f"{c}.score") >= threshold, F.lit(False))
    pick = lambda field: F.when(good("body"), F.col(f"body.{field}")).when(good("header"), F.col(f"header.{field}"))
    return rows.select("doc_id", "path", "n_words", pick("licence").alias("licence"), pick("score").alias("score"), F.when(good("header"), F.col("header.words")).otherwise(0).alias("notice_words"), good("body").alias("whole"))


def inherit(scanned: DataFrame, file_share: float = FILE_SHARE) -> DataFrame:
    """Adds directory, source ('own', 'inherited' or null) and licence_dir, and fills licence from above."""
    placed = scanned.withColumn("directory", F.when(F.locate("/", F.col("path")) > 0, F.regexp_replace("path", "/[^/]*$", "")).when(F.col("path").isNotNull(), ""))
    placed = save(placed, "placed")
    files = placed.where(F.col("licence").isNotNull() & (F.col("whole") | (F.col("notice_words") >= file_share * F.col("n_words")))).groupBy("directory").agg(F.min(F.struct("path", "licence"))["licence"].alias("from_above"))
    parts = F.split("directory", "/")
    above = placed.where("directory is not null").select("directory").distinct().withColumn("up", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))))
    nearest = above.join(files.withColumnRenamed("directory", "up"), "up").groupBy("directory").agg(F.max(F.struct(F.length("up").alias("n"), F.col("up"), F.col("from_above"))).alias("near"))
    out = placed.join(nearest.select("directory", F.col("near.up").alias("licence_dir"), F.col("near.from_above").alias("from_above")), "directory", "left")
    own = F.col("licence").isNotNull()
    return out.select("doc_id", "path", "n_words", F.coalesce("licence", "from_above").alias("licence"), F.when(own, "own").when(F.col("from_above").isNotNull(), "inherited").alias("source"), "score", F.when(~own, F.col("licence_dir")).alias("licence_dir"))


def document_paths(docs: DataFrame) -> DataFrame:
    """Documents have no paths: source, thousands and fifties of doc_id stand for directories."""
    step = lambda n: F.floor(F.col("doc_id") / n).cast("string")
    return docs.select("doc_id", "text", F.concat_ws("/", F.coalesce("source", F.lit("none")), step(1000), step(50), F.col("doc_id").cast("string")).alias("path"))


def licence_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inherit(scan(document_paths(spark.read.parquet(f"{sf_dir}/documents.parquet"))))
