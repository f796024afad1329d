"""License scans [native]: sparse TF-IDF cosine of headers and licence files to templates, then inheritance from the nearest directory.

* Words are runs of ``a-z0-9`` of the lower-cased text.  ``idf`` of a word is ``ln((1 + n) / (1 + df)) + 1`` over the ``n`` texts that are not
  null.  The document frequencies of all words are one grouped count, combined map-side; only those of the template words reach the driver.
* *Units* of a text are compared: every line, every block (lines without a blank or wordless line between them, so a wrapped header is one
  block), every sentence of a block, and the whole text.
* A unit is passed over only if it cannot reach the threshold.  By Cauchy and Schwarz the cosine to a template is at most the root of the share of
  the template's squared weight that lies on words the unit holds, whatever else stands in the unit.  The *cues* are template words without any of
  which this share is too small for every template; units without a cue are passed over first.  The same bound holds for a text and all its units.
* The words of the remaining units are counted, joined to their document frequencies and to the templates, and summed by unit.
* A text's statement is its best unit: of a licence before one of a mere reservation (``WEAK``, so that 'All rights reserved.' above a licence does not hide
  it), then by score, template name and unit.  A file is a *licence file* if it is named so or if its statement
  makes up ``FILE_SHARE`` of its words or more.  A directory has the licence of its best licence file (score, then path).
* A file without a statement inherits from the nearest directory on its path that has a licence.  Directories, not files, are
  expanded to their ancestors and joined, and each file meets its directory's result in one join that AQE may split.

Defined results: a null or empty text has no statement; a null path has the empty path's directory; repeated rows are judged alike (statements are
found once for each different text); an empty table gives an empty result; all columns are kept, and input columns named like a result are replaced.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from math import log, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: one-line notices
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved.",
}
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions:"""
_GNU_HEADER = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published
by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."""
#: fixed values: standard headers and licence texts
TEXTS: tuple[tuple[str, str], ...] = (
    ("MIT", _MIT_GRANT),
    ("MIT", _MIT_GRANT + """
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE
LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS
OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the
above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""),
    ("Apache-2.0", """Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations
under the License."""),
    ("GPL-2.0", _GNU_HEADER.format(name="General Public License", version=2)),
    ("GPL-3.0", _GNU_HEADER.format(name="General Public License", version=3)),
    ("LGPL-3.0", _GNU_HEADER.format(name="Lesser General Public License", version=3)),
    ("AGPL-3.0", _GNU_HEADER.format(name="Affero General Public License", version=3)),
)
ALL: tuple[tuple[str, str], ...] = (*TEMPLATES.items(), *TEXTS)
#: a reservation of rights says less than any licence beside it
WEAK = ("Proprietary",)
THRESHOLD = 0.6
FILE_SHARE = 0.1
FILE_NAMES = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"
RESULTS = ("own_license", "score", "license_file", "license", "basis")
#: a new line, anything without a word, and the last new line before the next word
BLOCK_END = r"\n[^A-Za-z0-9]*\n"
SENTENCE_END = r"[.!?][ \t\r\n]+"


def template_words(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def units(text: Column) -> Column:
    """Different lines, blocks, sentences of blocks and the whole of a text."""
    blocks = F.split(text, BLOCK_END)
    sentences = F.flatten(F.transform(blocks, lambda b: F.split(b, SENTENCE_END)))
    return F.array_distinct(F.concat(F.split(text, "\n"), blocks, sentences, F.array(text)))


def vectors(idf: dict[str, float], templates: Sequence[tuple[str, str]]) -> list[dict[str, float]]:
    return [{w: c * idf[w] for w, c in Counter(template_words(t)).items()} for _, t in templates]


def template_idf(frequencies: DataFrame, n: int, templates: Sequence[tuple[str, str]]) -> dict[str, float]:
    """idf of the template words."""
    vocab = sorted({w for _, t in templates for w in template_words(t)})
    counts = dict(frequencies.filter(F.col("w").isin(vocab)).collect())      # at most the words of the templates
    return {w: log((1 + n) / (1 + counts.get(w, 0))) + 1 for w in vocab}


def cues(idf: dict[str, float], templates: Sequence[tuple[str, str]], threshold: float) -> list[str]:
    """Template words without any of which no unit reaches the threshold: the commonest words are left out while that holds."""
    size = [(vec, threshold * sqrt(sum(v * v for v in vec.values()))) for vec in vectors(idf, templates)]
    out = set(idf)
    for w in sorted(idf, key=lambda w: (idf[w], w)):
        rest = out - {w}
        if all(sqrt(sum(v * v for x, v in vec.items() if x not in rest)) < least for vec, least in size):
            out = rest
    return sorted(out)


def may_reach(ws: Column, idf: dict[str, float], templates: Sequence[tuple[str, str]], threshold: float) -> Column:
    """False only for words that no text holding no others of the templates' words can reach the threshold with."""
    shares = []
    for vec in vectors(idf, templates):
        whole = sum(v * v for v in vec.values())
        shares.append(F.array(*[F.struct(F.lit(w).alias("w"), F.lit(v * v / whole).alias("s")) for w, v in sorted(vec.items())]))
    least = threshold * threshold * (1 - 1e-6)
    cue = F.array(*map(F.lit, cues(idf, templates, threshold)))

    def fits(held: Column) -> Column:
        return F.arrays_overlap(held, cue) & F.exists(F.array(*shares), lambda t: F.aggregate(
            t, F.lit(0.0), lambda acc, x: acc + F.when(F.array_contains(held, x["w"]), x["s"]).otherwise(0.0)) >= least)

    # the one-element array names the shared words once for all templates
    return F.exists(F.array(F.array_intersect(ws, F.array(*map(F.lit, sorted(idf))))), fits)


def statements(df: DataFrame, text: str, templates: Sequence[tuple[str, str]], threshold: float, scratch: Scratch) -> DataFrame:
    """(_ls_text, own_license, score, share): the statement of every different text that has one, by the text's digest."""
    spark = df.sparkSession
    texts = df.select(F.col(text).alias("text")).filter(F.col("text").isNotNull())
    df_words = scratch.write(texts.select(F.explode(F.array_distinct(words(F.col("text")))).alias("w"))
                             .groupBy("w").agg(F.count("*").alias("df")), "frequencies")
    n = texts.count()
    idf = template_idf(df_words, n, templates)
    found = scratch.write(
        texts.filter(may_reach(words(F.col("text")), idf, templates, threshold))
        .select(F.sha2("text", 256).alias("_ls_text"), F.size(words(F.col("text"))).alias("total"), F.explode(units(F.col("text"))).alias("unit"))
        .filter(may_reach(words(F.col("unit")), idf, templates, threshold))
        .withColumn("u", F.sha2("unit", 256)).distinct(), "units")
    counted = (found.groupBy("u").agg(F.min("unit").alias("unit")).select("u", F.explode(words(F.col("unit"))).alias("w"))
               .groupBy("u", "w").agg(F.count("*").alias("c")))
    # the frequencies are a written table, so AQE can split a word that very many units hold
    weighed = scratch.write(counted.join(df_words, "w").select(
        "u", "w", "c", (F.col("c") * (F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1)).alias("v")), "words")
    sizes = weighed.groupBy("u").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"), F.sum("c").alias("n"))
    rows = [(i, w, v) for i, vec in enumerate(vectors(idf, templates)) for w, v in vec.items()]
    named = [(i, name, name in WEAK, sqrt(sum(v * v for v in vec.values())))
             for i, ((name, _), vec) in enumerate(zip(templates, vectors(idf, templates)))]
    # both are as large as the templates
    tw = F.broadcast(spark.createDataFrame(rows, "t int, w string, tv double"))
    tn = F.broadcast(spark.createDataFrame(named, "t int, license string, weak boolean, size double"))
    scores = (weighed.join(tw, "w").groupBy("u", "t").agg(F.sum(F.col("v") * F.col("tv")).alias("dot"))
              .join(sizes, "u").join(tn, "t").withColumn("score", F.round(F.col("dot") / (F.col("norm") * F.col("size")), 6))
              .filter(F.col("score") >= threshold)
              .groupBy("u").agg(F.min(F.struct("weak", (-F.col("score")).alias("neg"), "license")).alias("s"), F.min("n").alias("n")))
    return scratch.write(
        found.join(scores, "u").groupBy("_ls_text").agg(F.min(F.struct("s.weak", "s.neg", "s.license", "unit", "n", "total")).alias("b"))
        .select("_ls_text", F.col("b.license").alias("own_license"), (-F.col("b.neg")).alias("score"),
                (F.col("b.n") / F.greatest(F.col("b.total"), F.lit(1))).alias("_ls_share")), "statements")


def scan(df: DataFrame, path: str = "path", text: str = "text", templates: Sequence[tuple[str, str]] = ALL,
         threshold: float = THRESHOLD, file_share: float = FILE_SHARE) -> DataFrame:
    """``df`` with own_license, score, license_file, license and basis ('own', 'inherited' or 'none')."""
    scratch = Scratch(df.sparkSession, "license-scan")
    df = df.drop(*RESULTS)
    own = statements(df, text, templates, threshold, scratch)
    where = F.coalesce(F.col(path), F.lit(""))
    out = (df.withColumn("_ls_text", F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).join(own, "_ls_text", "left")
           .withColumn("license_file", F.col("own_license").isNotNull() & (where.rlike(FILE_NAMES) | (F.col("_ls_share") >= file_share)))
           .withColumn("_ls_dir", F.regexp_extract(where, "(?s)^(.*)/[^/]*$", 1)).drop("_ls_text", "_ls_share"))
    named = scratch.write(out.filter("license_file").groupBy("_ls_dir").agg(
        F.min(F.struct(-F.col("score"), where.alias("p"), "own_license")).getField("own_license").alias("dir_license")), "directories")
    # every directory that holds a file, and its ancestors by path
    dirs = df.select(F.regexp_extract(where, "(?s)^(.*)/[^/]*$", 1).alias("_ls_dir")).distinct()
    parts = F.split("_ls_dir", "/")
    up = dirs.select("_ls_dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth")).withColumn(
        "up", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/"))
    near = scratch.write(up.join(named.withColumnRenamed("_ls_dir", "up"), "up").groupBy("_ls_dir")
                         .agg(F.max(F.struct("depth", "dir_license")).getField("dir_license").alias("_ls_near")), "nearest")
    return (out.join(near, "_ls_dir", "left").withColumn("license", F.coalesce("own_license", "_ls_near"))
            .withColumn("basis", F.when(F.col("own_license").isNotNull(), "own").when(F.col("_ls_near").isNotNull(), "inherited")
                        .otherwise("none")).drop("_ls_dir", "_ls_near"))
