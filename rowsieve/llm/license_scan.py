"""Licences of files: sparse TF-IDF cosine to templates, then inheritance by directory.

There are two kinds of template. A notice is a line by which a file names its licence; it
is compared with every line, and a line that reaches ``HEADER`` is the file's header. A
licence's full text is compared with whole files; one that reaches ``FILE`` is a licence
file. So is a file named like one (``LICENSE``, ``COPYING``, with any extension) that has a
header; other files with a header license nothing but themselves.

Words (runs of a-z and 0-9, with decimal parts, lower-cased) weigh their count times
``ln((1 + files) / (1 + files with the word)) + 1``. The files with each word are counted
over the whole table, for every word of it, so that a score does not depend on how large
the table is.

A cosine of some height needs a word that weighs much in a template. These anchor words
follow from the weights (what is left without them has too small a norm). Files and lines
without one are not taken apart, nor are files whose template words together have too small
a norm; the result is the same.

A file with a header, or one that is a licence file, has that licence. Any other has the
licence of the nearest directory above it that holds a licence file, found by joining
distinct directories with their ancestors. Of several licence files in a directory a full
text counts before a name, then the best match, then the first by path.

Only DataFrame functions are used. What is sent to all tasks is a row a template word and
the weights of words that hold more than one part in ``HOT_PARTS`` of all, of which there
are fewer than that; the weights of other words are joined. Null and empty texts have no
words; null paths inherit nothing. Rows that repeat a path are files of their own. Texts are
taken whole, whatever their length. Columns may have any names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.common import stored

HEADER = 0.7
FILE = 0.8
HOT_PARTS = 1000
# Names of files that hold a project's licence.
FILE_NAME = r"(?i)(^|/)(un)?(licen[cs]e|copying)([.-][^/]*)?$"

# Short notices by which works name their licence.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "proprietary": "All rights reserved.",
}

# Full texts of public licences.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
)
_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEXTS = {
    "BSD-2-Clause": _BSD_TERMS + _BSD_END,
    "BSD-3-Clause": _BSD_TERMS
    + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. " + _BSD_END,
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
    'SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
    "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    "Software. " + _AS_IS + "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
    "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
    "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for "
    "any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the "
    "author or authors of this software dedicate any and all copyright interest in the software to the public domain. "
    "We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. "
    "We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to "
    "this software under copyright law. " + _AS_IS + "IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
    "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
}

_WORD = r"[a-z0-9]+(?:\.[0-9]+)*"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({_WORD})"), F.lit(1))


@dataclass(frozen=True)
class Templates:
    """The normed weights of each template's words over a set of files."""

    weights: dict[str, dict[str, float]]

    def anchors(self, threshold: float) -> list[str]:
        """Words of which a text must hold one to reach the threshold with a template."""
        out: set[str] = set()
        for weights in self.weights.values():
            left = 0.0
            for word, w in sorted(weights.items(), key=lambda x: (x[1], x[0])):
                left += w * w
                if math.sqrt(left) >= threshold - 1e-6:
                    out.add(word)
        return sorted(out)

    def within_reach(self, held: Column, threshold: float) -> Column:
        """Whether a text with these distinct words could reach the threshold."""
        out = F.lit(False)
        for weights in self.weights.values():
            squares = F.create_map(*[F.lit(x) for w, v in sorted(weights.items()) for x in (w, v * v)])
            mine = F.array_intersect(held, F.array(*[F.lit(w) for w in sorted(weights)]))
            norm = F.aggregate(mine, F.lit(0.0), lambda total, w: total + F.try_element_at(squares, w))
            out = out | (norm >= F.lit((threshold - 1e-6) ** 2))
        return out


class Weights:
    """The weight of every word of a set of files."""

    def __init__(self, files: DataFrame):
        """Count the files with each word, in one pass; the empty word is in every file."""
        held = F.array_union(F.coalesce(words(F.col("text")), F.array().cast("array<string>")), F.array(F.lit("")))
        counts = files.select(F.explode(held).alias("word")).groupBy("word").agg(F.count("*").alias("files"))
        counts = stored(counts, "words")
        self.total = (counts.where("word = ''").agg(F.sum("files")).first()[0]) or 0
        sums = counts.where("word <> ''").agg(F.sum("files")).first()[0] or 0
        self.idf = counts.where("word <> ''").select("word", "files", self._weight(F.col("files")).alias("idf"))
        self.hot = F.col("files") * HOT_PARTS > sums

    def _weight(self, files: Column) -> Column:
        return F.log(F.lit(1.0 + self.total) / (1 + files)) + 1

    def templates(self, texts: dict[str, str]) -> Templates:
        spark = self.idf.sparkSession
        names = sorted(texts)
        split = spark.range(1).select(*[words(F.lit(texts[n])).alias(f"t{i}") for i, n in enumerate(names)]).first()
        counts = {n: {w: split[i].count(w) for w in split[i]} for i, n in enumerate(names)}
        vocabulary = sorted({w for c in counts.values() for w in c})
        idf = {r["word"]: r["idf"] for r in self.idf.where(F.col("word").isin(vocabulary)).collect()}
        unseen = math.log(1 + self.total) + 1
        out = {}
        for name, c in counts.items():
            weights = {w: n * idf.get(w, unseen) for w, n in c.items()}
            norm = math.sqrt(sum(x * x for x in weights.values()))
            out[name] = {w: x / norm for w, x in weights.items()}
        return Templates(out)

    def of(self, counted: DataFrame) -> DataFrame:
        """``unit, word, weight`` of ``unit, word, count``. Words in very many files meet
        their weight without a shuffle, so that no task gets all rows of one."""
        common = F.broadcast(self.idf.where(self.hot).select("word", F.col("idf").alias("common")))
        met = counted.join(common, "word", "left")
        known = met.where(F.col("common").isNotNull()).select("unit", "word", (F.col("count") * F.col("common")).alias("weight"))
        rest = met.where(F.col("common").isNull()).join(self.idf.where(~self.hot).select("word", "idf"), "word")
        return known.union(rest.select("unit", "word", (F.col("count") * F.col("idf")).alias("weight")))


def cosines(units: DataFrame, weights: Weights, templates: Templates) -> DataFrame:
    """``unit, licence, score``: the best template of each unit ``(unit, text)``; units
    are distinct. Scores are rounded to six places, so that the order of sums is of no
    account."""
    spark = units.sparkSession
    counted = units.select("unit", F.explode(words(F.col("text"))).alias("word")).groupBy("unit", "word").count()
    names = sorted(templates.weights)
    rows = [
        (word, [templates.weights[n].get(word, 0.0) for n in names])
        for word in sorted({w for t in templates.weights.values() for w in t})
    ]
    # As many rows as the templates have words.
    parts = F.broadcast(spark.createDataFrame(rows, "word string, parts array<double>"))
    hits = weights.of(counted).join(parts, "word", "left")
    sums = hits.groupBy("unit").agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"),
        *[F.coalesce(F.sum(F.col("weight") * F.col("parts")[i]), F.lit(0.0)).alias(f"s{i}") for i in range(len(names))],
    )
    scores = F.array(*[
        F.struct(F.round(F.col(f"s{i}") / F.col("norm"), 6).alias("score"), F.lit(-i).alias("rank"), F.lit(name).alias("licence"))
        for i, name in enumerate(names)
    ])
    best = sums.select("unit", F.array_max(scores).alias("best"))
    return best.select("unit", "best.licence", "best.score")


def parent(path: Column) -> Column:
    """The directory of a path; the topmost is the empty string."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(
    files: DataFrame,
    notices: dict[str, str] | None = None,
    texts: dict[str, str] | None = None,
    header: float = HEADER,
    file: float = FILE,
) -> DataFrame:
    """``files`` (with ``path`` and ``text``) and ``licence, licence_source, score``.

    ``licence_source`` is ``header``, ``text`` for a file that is a licence's full text, or
    the directory that the licence comes from. It and the licence are null where none is
    found; ``score`` is that of the header or the licence file. Columns of these names are
    replaced, all others stay.
    """
    kept = [F.col(f"`{c.replace('`', '``')}`") for c in files.columns if c.lower() not in ("licence", "licence_source", "score")]
    weights = Weights(files.select("text"))
    notices, texts = weights.templates(notices or NOTICES), weights.templates(texts or TEXTS)
    marks = F.array(*[F.lit(w) for w in notices.anchors(header)])
    signs = F.array(*[F.lit(w) for w in texts.anchors(file)])

    held = files.select("path", "text", F.array_distinct(words(F.col("text"))).alias("held"))
    held = held.select("path", "text", "held", F.arrays_overlap("held", marks).alias("lined"), F.arrays_overlap("held", signs).alias("whole"))
    held = held.where("lined OR whole").withColumn("whole", F.when(F.col("whole"), texts.within_reach(F.col("held"), file)).otherwise(False))
    found = held.where("lined OR whole").select(F.monotonically_increasing_id().alias("unit"), "path", "text", "lined", "whole")
    found = stored(found, "candidates")

    lines = found.where("lined").select("unit", F.posexplode(F.split("text", "\n", -1)).alias("line", "text"))
    lines = lines.where(F.arrays_overlap(words(F.col("text")), marks))
    lines = stored(lines.select(F.struct("unit", "line").alias("unit"), "text"), "lines")
    headers = cosines(lines, weights, notices).where(F.col("score") >= header)
    headers = headers.groupBy("unit.unit").agg(
        F.max(F.struct("score", (-F.col("unit.line")).alias("first"), "licence")).alias("best")
    )
    headers = headers.select("unit", F.struct(F.lit(0).alias("full"), "best.score", "best.licence").alias("own"))
    whole = cosines(found.where("whole").select("unit", "text"), weights, texts).where(F.col("score") >= file)
    whole = whole.select("unit", F.struct(F.lit(1).alias("full"), "score", "licence").alias("own"))
    matched = headers.union(whole).groupBy("unit").agg(F.max("own").alias("own"))
    places = found.select("unit", "path", F.xxhash64("text").alias("hash"))
    matched = stored(places.join(matched, "unit").select("path", "hash", "own"), "matched")

    own = matched.groupBy("path", "hash").agg(F.max("own").alias("own"))
    placed = matched.where("path IS NOT NULL").where((F.col("own.full") == 1) | F.col("path").rlike(FILE_NAME))
    first = F.struct((-F.col("own.full")).alias("worse"), (-F.col("own.score")).alias("less"), "path", "own")
    directories = placed.groupBy(parent(F.col("path")).alias("dir")).agg(F.min(first).alias("best"))
    directories = stored(directories.select("dir", "best.own.licence", "best.own.score"), "licensed")
    nearest = stored(_nearest(files.select("path"), directories), "nearest")

    # The row as one value, so that no name of its columns clashes.
    rows = files.select(F.struct(*kept).alias("row"), F.col("path").alias("at"), parent(F.col("path")).alias("dir"), F.xxhash64("text").alias("hash"))
    own = own.select(F.col("path").alias("mine"), F.col("hash").alias("same"), "own")
    rows = rows.join(own, F.col("at").eqNullSafe(F.col("mine")) & (F.col("hash") == F.col("same")), "left")
    rows = rows.join(nearest.withColumnsRenamed({"dir": "of"}), F.col("dir") == F.col("of"), "left")
    source = F.when(F.col("own.full") == 1, "text").when(F.col("own").isNotNull(), "header").otherwise(F.col("from"))
    return rows.select(
        "row.*",
        F.coalesce("own.licence", "licence").alias("licence"),
        source.alias("licence_source"),
        F.coalesce("own.score", "score").alias("score"),
    )


def _nearest(files: DataFrame, directories: DataFrame) -> DataFrame:
    """``dir, from, licence, score`` for each directory of files below a licence."""
    dirs = files.where("path IS NOT NULL").select(parent(F.col("path")).alias("dir")).distinct()
    parts = F.split("dir", "/", -1)
    # The directory itself, those above it, and the topmost.
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("from")))
    steps = dirs.select("dir", F.explode(above).alias("a")).select("dir", "a.depth", "a.from").distinct()
    met = steps.join(directories.withColumnRenamed("dir", "from"), "from")
    best = met.groupBy("dir").agg(F.max(F.struct("depth", "from", "licence", "score")).alias("best"))
    return best.select("dir", "best.from", "best.licence", "best.score")
