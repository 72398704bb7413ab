"""Licence scan by canonical digests: entire texts are normalised and hash-joined to known licences.

Canonical form: lower case; copyright lines, title lines, list markers and the appendix of
Apache-2.0 dropped; equivalent spellings made one; everything but letters and digits made
a blank. A text is the licence when the digests of
both canonical forms are equal. Besides the whole text, each of its lines is looked up
among known one-line notices, in the same way.

The known texts are a table whose size is checked before it is broadcast; beyond the
bound the join is shuffled on the digest.

Defined cases: a null or empty text, and one that is nothing but dropped lines, has the
digest of the empty text and no licence; two known texts with one digest give the smaller
licence id; repeated rows get equal results; an empty table, or no known texts, gives no
licence; a notice that no line lookup could find raises an error; a column of the input
that has the name of a result is replaced by the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from umbra.llm import licence_texts

#: Known licence texts that may be broadcast, and their digests' bytes with it.
BROADCAST_ROWS = 100_000
#: One-line notices that are looked up within a row.
NOTICES_AT_MOST = 500

#: Public licence texts: those of `licence_texts` and three short ones without their copyright lines.
TEXTS = licence_texts.TEXTS | {
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "FSFAP": """Copying and distribution of this file, with or without modification, are permitted in any medium without royalty provided the copyright notice and this notice are preserved. This file is offered as-is, without any warranty.""",
}
#: One-line notices that name a licence, one wording each; a table passed in may have several.
NOTICES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Licensed under CC0 1.0.",
    "EPL-2.0": "Licensed under the Eclipse Public License, Version 2.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Released under the ISC License.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "Released under the Unlicense.",
}
#: Spellings that count as one, as whole words.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"), ("non infringement", "noninfringement"),
    ("merchantibility", "merchantability"), ("organisation", "organization"), ("organisations", "organizations"), ("recognised", "recognized"),
    ("authorised", "authorized"), ("favour", "favor"), ("behaviour", "behavior"), ("and or", "or"), ("v 2 0", "version 2 0"), ("v 3", "version 3"),
)
#: The name of a licence alone on a line.
TITLE = (
    r"(?:the[ \t]+)?(?:mit|expat|isc|zlib|unlicense|(?:(?:new|modified|revised|simplified)[ \t]+)?bsd|0bsd|bsd[ \t-]+(?:zero|[0-3])[ \t-]*clause|(?:zero|[0-3])[ \t-]*clause[ \t]+bsd)"
    r"""(?:[ \t]+["'(]?(?:new|modified|revised|simplified)["')]?)?[ \t]+licen[sc]e(?:[ \t]*\([a-z0-9 \t-]*\))?[ \t.:=)*/-]*"""
)
#: A copyright line has a year, a sign, a place to fill in, or a holder that is named as one; prose on copyright notices and holders has none.
HOLDER = (
    r"(?:copyright|\(c\)|©)[^\n]*[0-9]{4}[^\n]*|copyright[ \t]*(?:\(c\)|[©:<{\[])[^\n]*|©[^\n]*|\(c\)[ \t]*copyright[ \t][^\n]*|copyright[ \t]+by[ \t][^\n]*|"
    r"copyright[ \t]+the[ \t][^\n]*(?:authors|contributors|developers|team|project)[ \t.]*|copyright[ \t]+(?:individual[ \t]+)?contributors[^\n]*|"
    r"copyright[ \t][^\n]*[ ,](?:inc|llc|ltd|limited|gmbh|corp|corporation|company|foundation)[ \t.,]*(?:all rights reserved)?[ \t.]*"
)
#: What is no part of the terms: copyright lines, titles, the appendix on how to apply Apache-2.0, and the markers of lists.
#: ASCII punctuation, blanks and tabs may stand before a line.
COPYRIGHT = (
    r"(?m)^[ \t!-/:-@\[-`{-~]*(?:" + HOLDER + r"|all rights reserved\.?[ \t]*|" + TITLE + r")$"
    r"|appendix: how to apply the apache license to your work\.(?s:.*?)limitations under the license\."
    r"|^[ \t]*(?:[0-9]{1,2}[.)]|\([a-z0-9]\))[ \t]+"
)
OTHER = r"[^\p{L}\p{N}]+"
#: Every known notice has this in lower case, so that only such lines are digested.
MARK = "licen[sc]"


def canonical(text: Column) -> Column:
    """The canonical form, words parted by one blank."""
    t = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT, "")
    t = F.concat(F.lit(" "), F.trim(F.regexp_replace(t, OTHER, " ")), F.lit(" "))
    for given, one in SPELLINGS:
        t = F.replace(t, F.lit(f" {given} "), F.lit(f" {one} "))
    return F.trim(t)


def known(spark: SparkSession, texts: dict[str, str] = TEXTS) -> DataFrame:
    """license_id and text."""
    return spark.createDataFrame(sorted(texts.items()), "license_id string, text string")


def digests(texts: DataFrame, text: str = "text") -> DataFrame:
    """digest and license_id of the known texts, one row for each digest."""
    rows = texts.select("license_id", F.sha2(canonical(texts[text]), 256).alias("digest")).where(F.col("digest") != F.sha2(F.lit(""), 256))
    return rows.groupBy("digest").agg(F.min("license_id").alias("license_id"))


def _sized(table: DataFrame) -> DataFrame:
    """The table, broadcast if it is within the bound."""
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def licenses(docs: DataFrame, texts: DataFrame, notices: DataFrame | None = None, text: str = "text") -> DataFrame:
    """`docs` with digest, license_id of the entire text, and the sorted ids of its notice lines."""
    results = ("digest", "license_id", "notices")
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in results]).alias("d"), docs[text].alias("_t"))
    held = held.withColumn("digest", F.sha2(canonical(F.col("_t")), 256))
    out = held.join(_sized(digests(texts)), "digest", "left")
    ids = F.array().cast("array<string>")
    if notices is not None:
        odd = notices.where(~F.coalesce(F.lower("text").rlike(MARK), F.lit(False))).limit(1).collect()
        if odd:
            raise ValueError(f"a notice must name a licence, as only lines with {MARK} are looked up: {odd[0]['text']!r}")
        table = digests(notices).orderBy("digest").limit(NOTICES_AT_MOST + 1).collect()
        if len(table) > NOTICES_AT_MOST:
            raise ValueError(f"more than {NOTICES_AT_MOST} notices; join their digests as texts")
        if table:
            # So few are looked up in a map within the row, without a shuffle of lines.
            by = F.create_map(*[F.lit(v) for r in table for v in (r["digest"], r["license_id"])])
            lines = F.filter(F.split(F.coalesce("_t", F.lit("")), "\n"), lambda x: F.lower(x).rlike(MARK))
            ids = F.array_sort(F.array_distinct(F.filter(F.transform(lines, lambda x: by[F.sha2(canonical(x), 256)]), lambda x: x.isNotNull())))
    return out.select("d.*", "digest", "license_id", ids.alias("notices"))
