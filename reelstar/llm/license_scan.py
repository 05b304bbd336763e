"""License scan: TF-IDF cosine to licence templates, then inheritance by path.

Units are the windows of one to ``WINDOW_LINES`` lines of every text (headers and
notices, wrapped or not) and the whole text (a licence file).  A unit's vector has
all of its words; the inverse document frequencies are counted over all
documents.  Two prunings lose nothing: a unit that has none of a template's
*anchor* words cannot reach the threshold (the remaining weights bound its
cosine, by Cauchy-Schwarz), and as a word weighs at least one, the number of a
unit's words outside of the templates bounds its norm from below.  Only what is
left needs the frequencies of those words.  Files without a licence of their own
inherit that of the nearest ancestor folder with a licence file: every distinct
folder is joined with its ancestors, not every file.

DataFrame operations only.  What is broadcast are the template weights: as
many rows as the templates have distinct words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, settled
from .line_dedup import lower_ascii

# Names, usual notices and texts of the licences that are looked for.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or any later version."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("MIT", """MIT License. Copyright. Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
conditions: The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("BSD-3-Clause", """BSD 3-Clause License. Copyright. All rights reserved. Redistribution and use in source and
binary forms, with or without modification, are permitted provided that the following conditions are met:
Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the
name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND
CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF
SUCH DAMAGE."""),
]
THRESHOLD = 0.8
#: Lines that a wrapped notice may stand on.
WINDOW_LINES = 6
_GAP = r"[^a-z0-9\x{80}-\x{10FFFF}]+"


def words_of(text: Column) -> Column:
    """Runs of a-z, 0-9 and characters beyond ASCII, A-Z lower-cased."""
    return F.array_remove(F.split(lower_ascii(text), _GAP), "")


def template_terms(docs: DataFrame, templates: list[tuple[str, str]]) -> DataFrame:
    """``(template, license, term, tf)`` with tf = 1 + ln(count)."""
    spark = docs.sparkSession
    given = spark.createDataFrame([(k, name, text) for k, (name, text) in enumerate(templates)],
                                  "template int, license string, text string")
    return (
        given.select("template", "license", F.explode(words_of(F.col("text"))).alias("term"))
        .groupBy("template", "license", "term").agg((1 + F.log(F.count(F.lit(1)))).alias("tf"))
    )


def frequencies(texts: DataFrame) -> DataFrame:
    """``(term, df)``: in how many rows each word occurs."""
    words = F.array_distinct(words_of(F.col("text")))
    return texts.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def weights(held: DataFrame, n: int, terms: DataFrame) -> list[tuple]:
    """``(template, license, term, idf, weight)`` with the idf
    ln((1 + n) / (1 + df)) + 1 and each template's weights scaled to length one.
    As many rows as the templates have words."""
    df = {r["term"]: r["df"] for r in held.join(terms.select("term").distinct(), "term").collect()}
    given = terms.collect()
    idf = {r["term"]: math.log((1 + n) / (1 + df.get(r["term"], 0))) + 1 for r in given}
    rows = [(r["template"], r["license"], r["term"], r["tf"] * idf[r["term"]]) for r in given]
    norm: dict[int, float] = {}
    for k, _, _, w in rows:
        norm[k] = norm.get(k, 0.0) + w * w
    return [(k, name, t, idf[t], w / math.sqrt(norm[k])) for k, name, t, w in sorted(rows)]


def anchors(rows: list[tuple], threshold: float) -> list[str]:
    """Words of which a unit must have one to reach the threshold with any
    template: without a template's heaviest words the rest of its weights,
    squared, sum to less than the threshold squared."""
    found: set[str] = set()
    for template in {r[0] for r in rows}:
        mine = sorted(((w, t) for k, _, t, _, w in rows if k == template), reverse=True)
        left = 1.0
        for w, t in mine:
            if left < threshold * threshold * (1 - 1e-9):
                break
            found.add(t)
            left -= w * w
    return sorted(found)


#: A text's name in the shuffles: 128 bits of hash.
_TEXT = ["h", "g"]


def named(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"h": F.xxhash64("text"), "g": F.xxhash64(F.lit(7), "text")})


def units_of(rows: DataFrame, anchor: Column, window_lines: int) -> DataFrame:
    """``(h, g, first, n_lines, words)`` of the units with an anchor word of
    every distinct text of ``rows``: windows of lines (first line, number of
    lines) and the whole text (first line -1).  A window's lines pass through
    a sliding frame, so a text of any length is sorted, never held."""
    some = named(rows.filter(F.arrays_overlap(words_of(F.col("text")), anchor)).select("text")).dropDuplicates(_TEXT)
    lines = some.select(*_TEXT, F.posexplode(F.split("text", "\n", -1)).alias("first", "line"))
    hit = F.arrays_overlap(words_of(F.col("line")), anchor).cast("int")
    ahead = Window.partitionBy(*_TEXT).orderBy("first").rowsBetween(0, window_lines - 1)
    framed = lines.withColumn("hit", hit).select(
        *_TEXT, "first", F.collect_list("line").over(ahead).alias("lines"), F.max("hit").over(ahead).alias("hit"),
    ).filter("hit = 1")
    windows = framed.select(*_TEXT, "first", "lines", F.explode(F.sequence(F.lit(1), F.size("lines"))).alias("n_lines"))
    windows = windows.select(*_TEXT, "first", "n_lines", F.concat_ws("\n", F.slice("lines", 1, F.col("n_lines"))).alias("body"))
    whole = some.select(*_TEXT, F.lit(-1).alias("first"), F.lit(0).alias("n_lines"), F.col("text").alias("body"))
    units = windows.unionByName(whole).withColumn("words", words_of(F.col("body"))).drop("body")
    return units.filter(F.arrays_overlap("words", anchor))


def license_scan(files: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "path",
                 templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD,
                 window_lines: int = WINDOW_LINES) -> DataFrame:
    """One row per row of ``files``: ``id, path, n_notices, own_license,
    own_score, is_license_file, license, inherited_from``.

    ``n_notices``: windows of up to ``window_lines`` lines with a cosine of at
    least ``threshold`` to a template that hold no smaller such window;
    ``own_license``: the template's licence of the best window or of the whole
    text (equal scores: the first name); ``own_score``: that cosine, rounded to
    6 digits.  ``is_license_file``: the whole text reaches the threshold; it
    then licenses its folder (of several in a folder the best score, then the
    first name).  ``license``: the own one, else that of the nearest ancestor
    folder, named in ``inherited_from`` ("" is the root).

    Null or empty text has no licence of its own; a null path inherits
    nothing and is no folder's licence file.  Rows are judged each on its own,
    also where ids or paths are equal.  An empty table gives an empty table.
    Other columns are not read.
    """
    spark = files.sparkSession
    rows = files.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(path_col)).alias("path"),
                        F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text"))
    terms = template_terms(files, templates)
    held, n = settled(frequencies(rows)), rows.count()
    weighted = weights(held, n, terms)
    table = spark.createDataFrame(weighted, "template int, license string, term string, idf double, weight double")
    anchor = F.array(*map(F.lit, anchors(weighted, threshold)))
    idf = table.select("term", "idf").distinct()

    # equal texts have equal units
    unit = [*_TEXT, "first", "n_lines"]
    counted = units_of(rows, anchor, window_lines).select(*unit, F.explode("words").alias("term")).groupBy(
        *unit, "term").agg((1 + F.log(F.count(F.lit(1)))).alias("tf"))
    # the template tables have a few hundred rows: a word of a template each
    vectors = settled(counted.join(F.broadcast(idf), "term", "left"))
    w = F.col("tf") * F.col("idf")
    norms = vectors.groupBy(*unit).agg(F.sum(F.coalesce(w * w, F.lit(0.0))).alias("inside"),
                                       F.count(F.when(F.col("idf").isNull(), 1)).alias("n_outside"))
    dots = (
        vectors.filter("idf IS NOT NULL").withColumn("w", w).join(F.broadcast(table.drop("idf")), "term")
        .groupBy(*unit, "template", "license").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    )

    # a word weighs at least one, as its idf does
    near = settled(
        dots.join(norms, unit).select(*unit, "license", "dot", "inside", "n_outside")
        .filter(F.col("dot") >= (threshold - 1e-6) * F.sqrt(F.col("inside") + F.col("n_outside")))
    )
    outside = (
        vectors.filter("idf IS NULL")
        .join(near.filter("n_outside > 0").select(*unit).distinct(), unit, "left_semi")
        .join(held, "term")
        .withColumn("w", F.col("tf") * (F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1))
        .groupBy(*unit).agg(F.sum(F.col("w") * F.col("w")).alias("outside"))
    )
    scored = settled(
        near.join(outside, unit, "left")
        .select(*unit, "license",
                F.round(F.col("dot") / F.sqrt(F.col("inside") + F.coalesce("outside", F.lit(0.0))), 6).alias("score"))
        .filter(F.col("score") >= threshold)
    )
    # windows that hold no smaller one: none that begins no earlier ends no later
    end = F.col("first") + F.col("n_lines")
    later = Window.partitionBy(*_TEXT).orderBy(F.col("first").desc(), "n_lines").rowsBetween(
        Window.unboundedPreceding, -1)
    least = (
        scored.filter("first >= 0").select(*unit).distinct().withColumn("below", F.min(end).over(later))
        .filter(F.col("below").isNull() | (F.col("below") > end))
        .groupBy(*_TEXT).agg(F.count(F.lit(1)).alias("n_notices"))
    )
    rank = F.struct((-F.col("score")).alias("s"), F.col("license").alias("license"))
    best = scored.groupBy(*_TEXT).agg(
        F.min(rank).alias("best"), F.min(F.when(F.col("first") < 0, rank)).alias("file"))
    own = settled(best.join(least, _TEXT, "left").withColumn("n_notices", F.coalesce("n_notices", F.lit(0))))
    base = named(rows).drop("text")

    def folder(path: Column) -> Column:
        return F.regexp_replace(path, r"/?[^/]*$", "")

    licensed = (
        base.filter("path IS NOT NULL").join(own.filter("file IS NOT NULL").select(*_TEXT, "file"), _TEXT)
        .groupBy(folder(F.col("path")).alias("at")).agg(F.min("file").alias("file"))
        .select("at", F.col("file.license").alias("given"))
    )
    folders = rows.filter("path IS NOT NULL").select(folder(F.col("path")).alias("folder")).distinct()
    parts = F.split("folder", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)),
                            lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    inherited = (
        folders.select("folder", F.posexplode(ancestors).alias("depth", "at"))
        .join(licensed, "at").groupBy("folder")
        .agg(F.max(F.struct("depth", "at", "given")).alias("near"))
        .select("folder", "near.at", "near.given")
    )
    joined = base.withColumn("folder", folder(F.col("path"))).join(own, _TEXT, "left").join(inherited, "folder", "left")
    has = F.col("best").isNotNull()
    return joined.select(
        F.col("id").alias(id_col), F.col("path").alias(path_col),
        F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
        F.col("best.license").alias("own_license"), (-F.col("best.s")).alias("own_score"),
        F.col("file").isNotNull().alias("is_license_file"),
        F.coalesce("best.license", "given").alias("license"),
        F.when(~has, F.col("at")).alias("inherited_from"),
    )
