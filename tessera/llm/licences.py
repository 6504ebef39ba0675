"""Licence scan by canonical digest lookup.

A text is normalised (case, copyright lines, equivalent spellings, punctuation, white space) and its digest is hash-joined
to the digests of known licence texts: an entire text matches or does not. The same is done with each of its lines, so that
a notice that stands alone on a line is found in a longer text.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored
from .licence_digests import DIGESTS

# Licence texts and notices, as their authors publish them.
_WARRANTY_MIT = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_WARRANTY_ISC = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. '
    "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_WARRANTY_BSD = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_1 = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_2 = "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without '
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom "
    "the Software is furnished to do so, subject to the following conditions:\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n" + _WARRANTY_MIT
)
_USE = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
LICENCES = {
    "MIT": ("MIT License\n" + _MIT, _MIT, "Released under the MIT License.", "Licensed under the MIT License."),
    "ISC": ("ISC License\n" + _USE + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + _WARRANTY_ISC,),
    "0BSD": (_USE + ".\n" + _WARRANTY_ISC,),
    "BSD-2-Clause": ("\n".join((_BSD_HEAD, _BSD_1, _BSD_2, _WARRANTY_BSD)), "Licensed under the BSD 2-Clause License."),
    "BSD-3-Clause": ("\n".join((_BSD_HEAD, _BSD_1, _BSD_2, _BSD_3, _WARRANTY_BSD)), "Licensed under the BSD 3-Clause License."),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3."),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
}

#: Steps of the normal form: pattern and replacement, for Java's and RE2's regular expressions alike, and literals of which a
#: text that the pattern matches holds one at least (none: any text may match).
STEPS = (
    # Copyright lines go whole, with what marks a comment before them.
    (r"(^|\n)[ \t*#/;-]*((copyright[ \t]*(\(c\)|©|[0-9]|by |<|\[)|\(c\)[ \t]*[0-9]|©)|all rights reserved)[^\n]*", "\n", ("copyright", "(c)", "©", "all rights reserved")),
    (r"\bsub-licen[cs]e", "sublicense", ("sub-licen",)),
    (r"\blicence", "license", ("licence",)),
    (r"\bnon-(commercial|infringement)", r"non{1}", ("non-commercial", "non-infringement")),
    (r"\bcopyright-holder", "copyright holder", ("copyright-holder",)),
    (r"\borganisation", "organization", ("organisation",)),
    (r"http://", "https://", ("http://",)),
    # Everything but letters, digits and line feeds is one space.
    (r"[^\p{L}\p{N}\n]+", " ", ()),
    (r" ?\n[ \n]*", "\n", ()),
)
#: Known texts that a plan holds as a literal at most.
INLINE = 4096
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _stepper(pattern: str, to: str, literals: tuple[str, ...]):
    def run(x):
        done = F.regexp_replace(x, pattern, to.replace("{1}", "$1"))
        return F.when(reduce(or_, [F.contains(x, F.lit(y)) for y in literals]), done).otherwise(x) if literals else done

    return run


def canonical(text):
    """Column of the normal form; its lines are those of the text that are left, without empty ones. A search for literals,
    far cheaper than one for a pattern, tells which steps a text can do without. The text goes from step to step as the one
    element of an array, so that the expression names it once and stays small wherever a filter is pushed."""
    held = F.array(F.translate(text, _UPPER, _LOWER))
    for step in STEPS:
        held = F.transform(held, _stepper(*step))
    return F.regexp_replace(F.element_at(held, 1), r"^[ \n]+|[ \n]+$", "")


def _digest(form):
    return F.md5(F.replace(form, F.lit("\n"), F.lit(" ")))


def known_digests(spark: SparkSession, licences: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(digest, licence) of the given texts, else of LICENCES and DIGESTS. Two licences with one normal form: the name that
    sorts first. The SQL equivalent knows LICENCES alone."""
    rows = [(name, text) for name, texts in (LICENCES if licences is None else licences).items() for text in texts]
    texts = spark.createDataFrame(rows, "licence string, text string")
    digests = texts.select(_digest(canonical(F.col("text"))).alias("digest"), "licence")
    if licences is None:
        digests = digests.union(spark.createDataFrame([(d, name) for name, ds in DIGESTS.items() for d in ds], "digest string, licence string"))
    return digests.groupBy("digest").agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, licence, n_notices, notices), one row per row of docs.

    digest is of the whole normal form, licence the known one with that digest, else null. notices lists, sorted and joined
    by commas, the licences that a line of the text is a known text of; n_notices counts such lines. A null text has a null
    digest and no notices, an empty or blank one the digest of the empty string. Repeated rows give equal rows; an empty
    table gives an empty result; other columns are ignored. known holds a digest once. Up to INLINE known texts are looked up
    as a literal; with more, lines are joined to them, and a job runs while the result is built."""
    names = known.select("digest", "licence")
    rows = docs.select(F.col(id_col).alias("doc_id"), canonical(F.col(text_col)).alias("form"))
    whole = rows.withColumn("digest", _digest(F.col("form")))
    lines = F.split(F.coalesce("form", F.lit("")), "\n")
    pairs = {r["digest"]: r["licence"] for r in names.limit(INLINE + 1).collect()}
    if len(pairs) <= INLINE:  # a line is looked up where it stands, and no line is moved
        table = F.create_map(*[F.lit(x) for kv in sorted(pairs.items()) for x in kv]) if pairs else F.create_map().cast("map<string,string>")
        found = whole.withColumn("lines", F.filter(F.transform(lines, lambda x: F.element_at(table, F.md5(x))), lambda x: x.isNotNull()))
    else:
        whole = stored(whole.withColumn("row", F.monotonically_increasing_id()), "licence-forms")
        held = whole.select("row", F.explode(lines).alias("line")).select("row", F.md5("line").alias("digest"))
        hits = held.join(names, "digest").groupBy("row").agg(F.collect_list("licence").alias("lines"))
        found = whole.join(hits, "row", "left").withColumn("lines", F.coalesce("lines", F.array().cast("array<string>")))
    joined = found.join(names, "digest", "left")
    return joined.select("doc_id", "digest", "licence", F.size("lines").cast("long").alias("n_notices"), F.array_join(F.array_sort(F.array_distinct("lines")), ",").alias("notices"))


def oracle() -> str:
    """The same in DuckDB SQL."""

    def form(text: str) -> str:
        out = f"translate({text}, '{_UPPER}', '{_LOWER}')"
        for pattern, to, _ in STEPS:
            to = "' || chr(10) || '" if to == "\n" else to.replace("{1}", r"\1")
            out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')"
        return rf"regexp_replace({out}, '^[ \n]+|[ \n]+$', '', 'g')"

    quoted = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, ts in LICENCES.items() for t in ts)
    return f"""
WITH k AS (SELECT md5(replace({form("t")}, chr(10), ' ')) AS digest, min(n) AS licence FROM (VALUES {quoted}) v(n, t) GROUP BY 1),
d AS (SELECT row_number() OVER () AS row_id, doc_id, {form("text")} AS form FROM documents),
l AS (SELECT row_id, unnest(string_split(form, chr(10))) AS line FROM d),
m AS (SELECT row_id, count(*)::BIGINT AS n_notices, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices FROM l JOIN k ON md5(l.line) = k.digest GROUP BY row_id)
SELECT doc_id, md5(replace(form, chr(10), ' ')) AS digest, k.licence, coalesce(n_notices, 0) AS n_notices, coalesce(notices, '') AS notices
FROM d LEFT JOIN k ON md5(replace(form, chr(10), ' ')) = k.digest LEFT JOIN m USING (row_id)
"""
