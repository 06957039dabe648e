"""Licence scan with DataFrame functions only.

Statements are the sentences and lines of a file that mention a licence, its
paragraphs and their sentences with line ends joined, and whole: the leading comment
and a licence file's text. Each distinct statement is a sparse TF-IDF vector of its
words (document frequencies over all statements of the corpus), compared by cosine
with the templates, from ``MIN_COSINE`` up; a template that names another version or
variant than the statement is no match. A file's own licence is its best statement's,
a whole one that reaches ``WHOLE_COSINE`` before all others. A licence file is one
named so, or one that opens with its statement: it speaks for its directory. A
file without a licence of its own inherits from the nearest ancestor directory
that has one, by joins of the distinct directories with their ancestors.

Equal statements are scored once, so hot statements shrink before any join.
Ties: the larger cosine (at nine digits), then the licence later by code point.
Null or empty text has no licence of its own; a null path has no directory.
Rows that share a path each get that path's result by their own text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored

# Usual notices of public licences. The SQL statement compares with these alone.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "Released under the MIT License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to
deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of
the Software, and to permit persons to whom the Software is furnished to do so"""
MIT_KEEP = ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
AS_IS = """ THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce
the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_NAMES = """ Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific
prior written permission."""
BSD_AS_IS = """ THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice
and this permission notice appear in all copies."""
ISC_AS_IS = """ THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the
License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations
under the License."""
FREE = ("This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free Software Foundation, "
        "either version {v} of the License, or (at your option) any later version.")
FREE_ONLY = ("This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {kind} version {v} as published by the Free Software Foundation.")
NO_WARRANTY = (" This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
               "PARTICULAR PURPOSE. See the GNU {kind} for more details. You should have received a copy of the GNU {kind} along with this {what}.")
GNU = [("GPL-2.0", "General Public License", "2", "June 1991"), ("GPL-3.0", "General Public License", "3", "29 June 2007"),
       ("LGPL-2.1", "Lesser General Public License", "2.1", "February 1999"), ("LGPL-3.0", "Lesser General Public License", "3", "29 June 2007"),
       ("AGPL-3.0", "Affero General Public License", "3", "19 November 2007")]
CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
      "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
SPDX = "SPDX-License-Identifier: "


def _notices() -> list[tuple[str, str]]:
    """Notices in the forms in use: line, header, title, full text (of the short licences) and SPDX line."""
    out = [*TEMPLATES, ("MIT", "Licensed under the MIT License"), ("MIT", "The MIT License (MIT)"), ("MIT", MIT), ("MIT", MIT + MIT_KEEP),
           ("MIT", "MIT License Copyright (c) " + MIT + MIT_KEEP + AS_IS), ("MIT-0", "MIT No Attribution Copyright " + MIT + "." + AS_IS),
           ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"), ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
           ("BSD-2-Clause", "Copyright (c) All rights reserved. " + BSD + BSD_AS_IS), ("BSD-3-Clause", "Copyright (c) All rights reserved. " + BSD + BSD_NAMES + BSD_AS_IS),
           ("ISC", "Licensed under the ISC License"), ("ISC", ISC), ("ISC", "ISC License Copyright (c) " + ISC + ISC_AS_IS),
           ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"), ("Apache-2.0", APACHE),
           ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
           ("MPL-2.0", "Mozilla Public License Version 2.0"),
           ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
                       "You can obtain one at http://mozilla.org/MPL/2.0/."),
           ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
           ("CC0-1.0", "CC0 1.0 Universal License"), ("CC0-1.0", "Released under the Creative Commons CC0 1.0 Universal Public Domain Dedication license"),
           ("Unlicense", "This is free and unencumbered software released into the public domain, see the Unlicense")]
    for name, kind, v, date in GNU:
        out += [(name, f"This work is licensed under the GNU {kind}, version {v}"), (name, f"Licensed under the {name.split('-')[0]} version {v}"), (name, f"GNU {kind} Version {v}, {date}")]
        for what in ("program", "library"):
            out += [(name, form.format(what=what, kind=kind, v=v) + more.format(what=what, kind=kind)) for form in (FREE, FREE_ONLY) for more in ("", NO_WARRANTY)]
        out += [(name, f"{SPDX}{name}{more}") for more in ("", "-only", "-or-later")]
    for short, long in CC.items():
        for v, port in (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic")):
            name = f"CC-{short}-{v}"
            out += [(name, f"Licensed under CC {short} {v}"), (name, f"This work is licensed under a Creative Commons {long} {v} {port} License"), (name, SPDX + name)]
    out += [(name, SPDX + name) for name in ("MIT", "MIT-0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "EPL-2.0", "CC0-1.0", "Unlicense")]
    return list(dict.fromkeys(out))


CUES = ("licen", "copyright", "redistribution", "spdx")
SENTENCE = r"[\r\n]+|(?<=[.;!?])[ \t]+"
GAP = r"[^a-z0-9]+"
PARAGRAPH = r"\r?\n[^\p{L}\p{N}]*\n"
LINE_END = r"[\r\n]+[ \t#*/;%!-]*"
SENTENCE_END = r"(?<=[.;!?])[ \t]+"
COMMENT = r"^\s*($|#|//|\*|--|;|%|dnl\b)"
BLOCKS = (("/*", "*/"), ("<!--", "-->"), ('"""', '"""'))
MIN_COSINE = 0.6
WHOLE_COSINE = 0.9
NAMED = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), GAP), lambda w: w != "")


def _mentions(text: Column) -> Column:
    low = F.lower(text)
    found = low.contains(CUES[0])
    for cue in CUES[1:]:
        found = found | low.contains(cue)
    return F.coalesce(found, F.lit(False))


def templates_table(spark: SparkSession, templates=None) -> DataFrame:
    rows = [F.struct(F.lit(n).alias("license"), F.lit(t).alias("notice")) for n, t in templates or _notices()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def document_paths(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: source / ten thousands / hundreds / id."""
    number = F.coalesce(F.col("doc_id"), F.lit(0))
    return docs.select(F.col("doc_id"), "text", F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.floor(number / 10000).cast("string"),
                                                            F.floor(number / 100).cast("string"), F.concat(number.cast("string"), F.lit(".txt"))).alias("path"))


def leading_comment(text: Column) -> Column:
    """A block comment at the start of a text, or its leading comment lines; without any, an empty text."""
    lines = F.split(text, r"\r?\n")
    code = F.array_position(F.transform(lines, lambda x: x.rlike(COMMENT)), F.lit(False))
    out = F.array_join(F.slice(lines, F.lit(1), F.when(code > 0, code - 1).otherwise(F.size(lines)).cast("int")), "\n")
    body = F.ltrim(F.regexp_replace(text, r"^\s+", ""))
    for opening, closing in BLOCKS:
        inside = F.substring_index(F.substr(body, F.lit(len(opening) + 1)), closing, 1)
        out = F.when(body.startswith(opening), inside).otherwise(out)
    return out


def statements(files: DataFrame) -> DataFrame:
    """(file, opens, whole, words: text of a statement's words, kind: their digest) of every statement of ``files`` (file, text, named).

    ``opens``: it stands first; a paragraph or a whole text opens a file only if it is all of a notice (``whole``).
    """
    files = files.where(_mentions(F.col("text")))
    told = lambda s, at, whole: F.struct(s.alias("sentence"), at.alias("opens"), F.lit(whole).alias("whole"))
    lines = files.select("file", F.posexplode(F.filter(F.split("text", SENTENCE), lambda s: s != "")).alias("at", "sentence"))
    lines = lines.select("file", told(F.col("sentence"), F.col("at") == 0, False).alias("s"))
    paragraphs = files.select("file", F.posexplode(F.filter(F.split("text", PARAGRAPH), lambda s: s != "")).alias("at", "part")).where(_mentions(F.col("part")))
    joined = paragraphs.select("file", "at", F.trim(F.regexp_replace("part", LINE_END, " ")).alias("part"), F.rlike("part", F.lit(r"[\r\n]")).alias("wrapped"))
    sentences = joined.where("wrapped").select("file", "at", F.posexplode(F.split("part", SENTENCE_END)).alias("n", "sentence"))
    sentences = sentences.select("file", told(F.col("sentence"), (F.col("at") == 0) & (F.col("n") == 0), False).alias("s"))
    passages = joined.select("file", told(F.col("part"), F.col("at") == 0, True).alias("s"))
    texts = files.select("file", F.explode(F.array(leading_comment(F.col("text")), F.when(F.col("named"), F.col("text")))).alias("part"))
    texts = texts.select("file", told(F.col("part"), F.lit(True), True).alias("s"))
    every = lines.unionAll(sentences).unionAll(passages).unionAll(texts).select("file", "s.*")
    return (every.where(_mentions(F.col("sentence"))).select("file", "opens", "whole", F.array_join(_words(F.col("sentence")), " ").alias("words"))
            .where("words <> ''").withColumn("kind", F.md5("words")))


def _agrees() -> Column:
    """Whether the statement ``words`` can be the template's: same version numbers (or none said), SPDX id and variant."""
    said = F.split("words", " ")
    numbers = F.filter(said, lambda w: w.rlike("^[0-9]+$"))
    holds = F.size(F.array_except("must", said)) == 0
    version = F.when(F.size("spdx") > 0, F.size(F.array_except("spdx", said)) == 0).otherwise(holds | (F.size(numbers) == 0))
    marks = lambda c: [F.array_contains(c, x) | F.array_contains(c, y) for x, y in (("nc", "noncommercial"), ("sa", "sharealike"), ("nd", "noderivatives"))]
    variant = F.lit(True)
    for ours, theirs in zip(marks(said), marks(F.col("notice_words"))):
        variant = variant & (ours == theirs)
    named = F.lit(True)
    for word in ("lesser", "affero"):
        named = named & (F.array_contains(said, word) == F.array_contains("notice_words", word))
    return version & F.when(F.col("license").startswith("CC-BY"), variant).otherwise(F.when(F.array_contains("notice_words", "gnu"), named).otherwise(True))


def score(found: DataFrame, templates: DataFrame) -> DataFrame:
    """(kind, license, cosine) of each distinct statement that reaches MIN_COSINE: its best template."""
    kinds = stored(found.groupBy("kind").agg(F.count("*").alias("n"), F.min("words").alias("words")), "statements")
    terms = kinds.select("kind", "n", F.explode(F.split("words", " ")).alias("term")).groupBy("kind", "n", "term").agg(F.count("*").alias("tf"))
    total = kinds.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequency = stored(terms.groupBy("term").agg(F.sum("n").alias("df")), "term-frequencies")
    weight = lambda: F.col("tf") * (F.log((1.0 + total) / (1.0 + F.coalesce("df", F.lit(0)))) + 1.0)
    ours = terms.join(frequency, "term").withColumn("w", weight())
    norms = ours.groupBy("kind").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    notices = templates.select("license", "notice", _words(F.col("notice")).alias("notice_words"))
    spdx = F.when(F.col("notice").startswith(SPDX), F.slice("notice_words", 4, 1 << 30)).otherwise(F.array().cast("array<string>"))
    notices = stored(notices.select("license", "notice", "notice_words", spdx.alias("spdx"), F.filter("notice_words", lambda w: w.rlike("^[0-9]+$")).alias("must")), "notices")
    theirs = (notices.select("license", "notice", F.explode("notice_words").alias("term")).groupBy("license", "notice", "term").agg(F.count("*").alias("tf"))
              .join(frequency, "term", "left").withColumn("tw", weight()))
    sizes = theirs.groupBy("license", "notice").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tnorm"))
    theirs = stored(theirs.select("license", "notice", "term", "tw").join(sizes, ["license", "notice"])
                    .select("license", F.xxhash64("notice").alias("form"), "term", "tw", "tnorm"), "templates")
    dots = (ours.join(F.broadcast(theirs), "term")  # the words of the templates: a fixed list
            .groupBy("kind", "license", "form", "tnorm").agg(F.sum(F.col("w") * F.col("tw")).alias("dot")).join(norms, "kind"))
    near = dots.select("kind", "license", "form", F.round(F.col("dot") / (F.col("norm") * F.col("tnorm")), 9).alias("cosine")).where(F.col("cosine") >= MIN_COSINE)
    near = near.join(F.broadcast(notices.withColumn("form", F.xxhash64("notice"))), ["license", "form"]).join(kinds.select("kind", "words"), "kind").where(_agrees())
    return near.groupBy("kind").agg(F.max(F.struct("cosine", "license")).alias("best")).select("kind", "best.license", "best.cosine")


def scan(files: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """``files`` (path, text, others) plus license, cosine, origin (own, inherited or none) and licensed_by (a directory)."""
    spark = files.sparkSession
    names = [c for c in files.columns if c != "text"]
    files = files.select(*[F.col(c).alias(f"in_{c}") for c in names], F.col("path").alias("_path"), "text", F.xxhash64("path", "text").alias("file"))
    named = F.coalesce(F.col("_path").rlike(NAMED), F.lit(False)).alias("named")
    found = stored(statements(files.where(_mentions(F.col("text"))).select("file", "text", named).dropDuplicates(["file"])), "found")
    scored = stored(score(found, templates if templates is not None else templates_table(spark)), "scored")
    full = F.col("whole") & (F.col("cosine") >= WHOLE_COSINE)  # all of a text or paragraph comes before a sentence of it
    best = found.drop("words").join(scored, "kind").groupBy("file").agg(F.max(F.struct(full.alias("full"), "cosine", "license")).alias("own"),
                                                           F.max(F.col("opens") & (full | ~F.col("whole"))).alias("opens"))
    told = stored(files.drop("text").join(best, "file", "left")
                  .withColumn("_dir", directory(F.col("_path"))), "own-licences")
    speaks = F.col("opens") | F.col("_path").rlike(NAMED)
    spoken = told.where(F.col("own").isNotNull() & speaks & F.col("_dir").isNotNull()).groupBy(F.col("_dir").alias("parent")).agg(F.max("own").alias("given"))
    parts = F.split("_dir", "/")
    above = (told.where("_dir is not null").select("_dir").distinct()
             .select("_dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("parent")))).alias("a")))
    nearest = (above.select("_dir", "a.*").join(spoken, "parent").groupBy("_dir")
               .agg(F.max(F.struct("depth", "parent", "given")).alias("near")))
    both = told.join(nearest, "_dir", "left")
    own = F.col("own").isNotNull()
    return both.select(*[F.col(f"in_{c}").alias(c) for c in names],
                       F.coalesce("own.license", "near.given.license").alias("license"),
                       F.coalesce("own.cosine", "near.given.cosine").alias("cosine"),
                       F.when(own, "own").when(F.col("near").isNotNull(), "inherited").otherwise("none").alias("origin"),
                       F.when(~own, F.col("near.parent")).alias("licensed_by"))


def _oracle() -> str:
    quoted = ", ".join(f"('{n}', '{t}')" for n, t in TEMPLATES)
    cue = lambda c: " OR ".join(f"contains(lower({c}), '{x}')" for x in CUES)
    words = lambda c: f"list_filter(string_split_regex(lower({c}), '[^a-z0-9]+'), lambda x: x <> '')"
    return rf"""
WITH f AS (SELECT doc_id, text, coalesce(source, 'unknown') || '/' || (doc_id // 10000) || '/' || (doc_id // 100) AS dir FROM documents),
-- RE2 has no look-behind: a mark ends each sentence before the split
s0 AS (SELECT doc_id, list_filter(string_split_regex(regexp_replace(text, '([.;!?])[ \t]+', '\1' || chr(1), 'g'), '[\r\n\x01]+'), lambda x: x <> '') AS parts
       FROM f WHERE {cue('text')}),
s1 AS (SELECT doc_id, parts[i] AS sentence, i = 1 AS opens FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM s0)),
s AS (SELECT doc_id, opens, array_to_string({words('sentence')}, ' ') AS words FROM s1 WHERE {cue('sentence')}),
k AS (SELECT words, count(*) AS n FROM s WHERE words <> '' GROUP BY words),
e AS (SELECT words, n, term, count(*) AS tf FROM (SELECT words, n, unnest(string_split(words, ' ')) AS term FROM k) GROUP BY ALL),
df AS (SELECT term, sum(n) AS df FROM e GROUP BY term),
tot AS (SELECT coalesce(sum(n), 0) AS total FROM k),
o AS (SELECT words, e.term, tf * (ln((1.0::DOUBLE + total) / (1.0::DOUBLE + df)) + 1) AS w FROM e JOIN df ON e.term = df.term, tot),
nrm AS (SELECT words, sqrt(sum(w * w)) AS norm FROM o GROUP BY words),
t0 AS (SELECT license, term, count(*) AS tf FROM (SELECT license, unnest({words('notice')}) AS term FROM (VALUES {quoted}) v(license, notice)) GROUP BY ALL),
t AS (SELECT license, t0.term, tf * (ln((1.0::DOUBLE + total) / (1.0::DOUBLE + coalesce(df, 0))) + 1) AS tw FROM t0 LEFT JOIN df ON t0.term = df.term, tot),
tn AS (SELECT license, sqrt(sum(tw * tw)) AS tnorm FROM t GROUP BY license),
c AS (SELECT o.words, t.license, round(sum(w * tw) / (any_value(norm) * any_value(tnorm)), 9) AS cosine
      FROM o JOIN t ON o.term = t.term JOIN nrm ON o.words = nrm.words JOIN tn ON t.license = tn.license GROUP BY o.words, t.license),
b AS (SELECT words, cosine, license FROM c WHERE cosine >= {MIN_COSINE} QUALIFY row_number() OVER (PARTITION BY words ORDER BY cosine DESC, license DESC) = 1),
own AS (SELECT doc_id, max(opens) OVER (PARTITION BY doc_id) AS opens, cosine, license FROM s JOIN b ON s.words = b.words
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, license DESC) = 1),
g AS (SELECT dir, cosine, license FROM own JOIN f ON own.doc_id = f.doc_id WHERE opens QUALIFY row_number() OVER (PARTITION BY dir ORDER BY cosine DESC, license DESC) = 1),
near AS (SELECT f.doc_id, g.* FROM f JOIN g ON f.dir = g.dir OR starts_with(f.dir, g.dir || '/')
         QUALIFY row_number() OVER (PARTITION BY f.doc_id ORDER BY len(string_split(g.dir, '/')) DESC) = 1)
SELECT f.doc_id, f.dir || '/' || f.doc_id || '.txt' AS path, coalesce(own.license, near.license) AS license, coalesce(own.cosine, near.cosine) AS cosine,
       CASE WHEN own.license IS NOT NULL THEN 'own' WHEN near.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN own.license IS NULL THEN near.dir END AS licensed_by
FROM f LEFT JOIN own ON f.doc_id = own.doc_id LEFT JOIN near ON f.doc_id = near.doc_id
"""


ORACLE = _oracle()
