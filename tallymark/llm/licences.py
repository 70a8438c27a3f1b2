"""Known licence texts found by digest.

A text is put into a canonical form (case, punctuation, copyright lines, equivalent
spellings) and its digest is joined with those of known licences, put into the same form
by the same columns. Four scopes are looked up: the whole document, each paragraph (lines
between blank ones), each line, and passages: runs of paragraphs that start like a known
text and are as long as it, wherever they stand in a document. Passages are cut without
title lines and lines that only name a copyright holder. Nothing is compared but digests:
the join carries 16-byte keys, and the known side is the list of licences.
"""

from __future__ import annotations

from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .texts import whole_text

# Spellings that count as the same, from the SPDX matching guidelines; whole words, lower case, without
# punctuation. Plurals and past forms follow from the stem.
SPELLINGS = [
    ("licence", "license"), ("sublicence", "sublicense"), ("sub license", "sublicense"), ("organisation", "organization"),
    ("favour", "favor"), ("fulfil", "fulfill"), ("initialise", "initialize"),
    ("non commercial", "noncommercial"), ("per cent", "percent"), ("copyright owner", "copyright holder"),
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("behaviour", "behavior"), ("https", "http"),
]

# Texts of short public licences, as their stewards publish them, without copyright lines.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
}

# Names that notices use, and what notices say before a name.
NAMES = {
    "MIT": ["the MIT License", "MIT"],
    "Apache-2.0": ["the Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0"],
    "GPL-3.0": ["the GNU General Public License, version 3", "the GNU General Public License v3.0", "GPLv3", "GPL 3.0"],
    "GPL-2.0": ["the GNU General Public License, version 2", "the GNU General Public License v2.0", "GPLv2", "GPL 2.0"],
    "LGPL-3.0": ["the GNU Lesser General Public License, version 3", "LGPLv3"],
    "AGPL-3.0": ["the GNU Affero General Public License, version 3", "AGPLv3"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0", "MPL 2.0"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "BSD 3-Clause"],
    "BSD-2-Clause": ["the BSD 2-Clause License", "BSD 2-Clause"],
    "CC-BY-4.0": ["CC BY 4.0", "the Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "the Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "the Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
}
SUBJECTS = [
    "", "This work is ", "This software is ", "This project is ", "This file is ", "This document is ", "This code is ", "This program is ",
    "This library is ", "This package is ", "This module is ", "This repository is ", "The code is ", "The source code is ",
]
VERBS = ["licensed under ", "released under ", "distributed under ", "available under "]

# Lines that say no more than a licence's name.
TITLE_LINES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "License: MIT"],
    "Apache-2.0": ["Apache License", "Apache License 2.0", "Apache License, Version 2.0", "License: Apache-2.0"],
    "GPL-3.0": ["GNU General Public License v3.0", "GNU General Public License, version 3", "GNU GPLv3", "License: GPL-3.0"],
    "GPL-2.0": ["GNU General Public License v2.0", "GNU General Public License, version 2", "GNU GPLv2", "License: GPL-2.0"],
    "LGPL-3.0": ["GNU Lesser General Public License v3.0", "GNU LGPLv3"],
    "AGPL-3.0": ["GNU Affero General Public License v3.0", "GNU AGPLv3"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License Version 2.0"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", "License: BSD-3-Clause"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License"],
    "ISC": ["ISC License", "The ISC License"],
    "CC0-1.0": ["CC0 1.0 Universal"],
}

# The notices that two stewards ask to be put at the head of files.
HEADERS = {
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}

# Further identifiers of the SPDX list, and the families whose identifiers come with two endings.
SPDX_IDS = (
    "AFL-2.1 AFL-3.0 APSL-2.0 Artistic-1.0 Artistic-2.0 BlueOak-1.0.0 BSD-1-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 "
    "CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-NC-3.0 CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0 "
    "CC-BY-ND-3.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 "
    "FTL IJG MIT-0 MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.0 OFL-1.1 OpenSSL OSL-3.0 PHP-3.01 PostgreSQL PSF-2.0 "
    "Python-2.0 QPL-1.0 Ruby SSPL-1.0 TCL Unicode-DFS-2016 Unlicense UPL-1.0 Vim W3C WTFPL X11 Xnet ZPL-2.1"
).split()
SPDX_FAMILIES = "AGPL-3.0 GFDL-1.2 GFDL-1.3 GPL-1.0 GPL-2.0 GPL-3.0 LGPL-2.0 LGPL-2.1 LGPL-3.0".split()


# Fixed value: canonical lines that say whose copyright it is.
RIGHTS = r"^ *(copyright (c )?|c )\d{4}|^ *all rights reserved *$"

# Canonical lines that passages are cut at: titles, and rights without a year. A holder's name is no word that
# follows "copyright" within the texts of licences.
TITLES = (
    r"^(the )?(mit|expat|x11|isc|zlib|zlib libpng|0bsd|(zero clause |simplified |new |modified |revised )?bsd( (zero|[0-4]|two|three) clause)?"
    r"|apache|mozilla public|gnu (lesser |library |affero )?general public)( software)? license"
    r"( (mit|expat|isc|zlib|0bsd|bsd|bsd [0-4] clause|v?\d( \d)*|version \d( \d)*))?$"
)
NO_HOLDER = (
    r"(a|also|an|and|are|as|assignment|by|c|claim|conditions|disclaimer|doctrines?|for|given|holders?|if|in|interests?|is|it|laws?|licen[cs]es?|licensed"
    r"|like|line|notices?|of|on|or|owners?|owned|ownership|patent|permission|protection|related|resulting|rights?|statements?|status|that|the copyright|those"
    r"|terms|this|to|treaty|under|with|works?)\b"
)
HOLDERS = rf"^copyright (c |by )?(?!{NO_HOLDER})[\p{{L}}\p{{N}}]"
HEAD = 32  # letters by which the first paragraph of a known text is recognised before anything is digested


def known_texts() -> list[tuple[str, str]]:
    """``(licence, text)``: the texts above and those of ``licence_texts``, headers of files, titles, identifiers, and all
    notices that subjects, verbs and names make."""
    whole = [(p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))]
    notices = [
        (licence, f"{subject}{verb}{name}")
        for licence, names in NAMES.items() for name in names for subject in SUBJECTS for verb in VERBS
    ]
    titles = [(licence, title) for licence, some in TITLE_LINES.items() for title in some]
    ids = {licence: licence for licence in (*TEXTS, *NAMES, *SPDX_IDS, *SPDX_FAMILIES, *(name for name, _ in whole))}
    ids |= {f"{licence}-{end}": licence for licence in SPDX_FAMILIES for end in ("only", "or-later")} | {f"{licence}+": licence for licence in SPDX_FAMILIES}
    marks = [(licence, f"SPDX-License-Identifier: {name}") for name, licence in sorted(ids.items())]
    return [*TEXTS.items(), *whole, *HEADERS.items(), *notices, *titles, *marks]


def canonical_lines(text: Column) -> Column:
    """The lines of a text: lower case, letters and digits only, one blank between words, one spelling of each word.

    Lines that say whose copyright it is, or that all rights are reserved, become null.
    """
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")
    plain = F.concat(F.lit(" "), F.replace(plain, F.lit("\n"), F.lit(" \n ")))
    for word, same in SPELLINGS:  # a blank stands before every word now, so a search by bytes finds its start
        plain = F.replace(plain, F.lit(f" {word}"), F.lit(f" {same}"))
    return F.transform(
        F.split(plain, "\n", -1),
        lambda x: F.when(~F.rlike(x, F.lit(RIGHTS)), F.trim(x)),
    )


def _digest(text: Column) -> Column:
    return F.md5(F.encode(text, "UTF-8"))


def scopes(lines: Column) -> Column:
    """All stretches of canonical lines to look up: ``scope``, ``nth`` (line or paragraph, from 0; -1: all) and ``digest``."""
    said = F.filter(lines, lambda x: F.coalesce(x != "", F.lit(False)))
    joined = F.array_join(F.filter(lines, lambda x: x.isNotNull()), "\n")
    paragraphs = F.filter(F.split(joined, "\n{2,}", -1), lambda x: x != "")
    whole = F.array(F.struct(F.lit("document").alias("scope"), F.lit(-1).alias("nth"), _digest(F.array_join(said, " ")).alias("digest")))
    parts = F.transform(paragraphs, lambda x, i: F.struct(
        F.lit("paragraph").alias("scope"), i.cast("int").alias("nth"), _digest(F.trim(F.translate(x, "\n", " "))).alias("digest")
    ))
    single = F.filter(
        F.transform(lines, lambda x, i: F.struct(
            F.lit("line").alias("scope"), i.cast("int").alias("nth"), F.when(x != "", _digest(x)).alias("digest")
        )),
        lambda s: s["digest"].isNotNull(),
    )
    return F.concat(whole, parts, single)


def bodies(lines: Column) -> Column:
    """The paragraphs of canonical lines, each as one line, without titles and rights; these end a paragraph."""
    cut = F.transform(F.filter(lines, lambda x: x.isNotNull()), lambda x: F.when(~F.rlike(x, F.lit(f"{TITLES}|{HOLDERS}")), x).otherwise(""))
    parts = F.transform(F.split(F.array_join(cut, "\n"), "\n{2,}", -1), lambda x: F.trim(F.translate(x, "\n", " ")))
    return F.filter(parts, lambda x: x != "")


def passages(parts: Column, lengths: dict[str, list[int]]) -> Column:
    """The runs of paragraphs to look up, as in ``scopes``; ``nth`` is the first paragraph of ``parts``.

    ``lengths`` are those of the known texts (letters, one blank between paragraphs), by the head of their first
    paragraph. A run ends where a paragraph does; how it is parted within does not matter.
    """
    nothing = F.array().cast("array<struct<scope:string,nth:int,digest:string>>")
    if not lengths:
        return nothing
    by_head = F.create_map(*[F.lit(x) for head, some in lengths.items() for x in (head, some)])

    def run(nth: Column, length: Column) -> Column:
        rest = F.array_join(F.slice(parts, nth + 1, length), "\n")  # no paragraph is empty
        ends = (F.length(rest) >= length) & F.substring(rest, length + 1, F.lit(1)).isin("", "\n")
        said = F.translate(F.substring(rest, F.lit(1), length), "\n", " ")
        return F.struct(F.lit("passage").alias("scope"), nth.alias("nth"), F.when(ends, _digest(said)).alias("digest"))

    heads = F.transform(parts, lambda x, i: F.struct(i.cast("int").alias("nth"), F.substring(x, 1, HEAD).alias("head")))
    starts = F.filter(heads, lambda s: s["head"].isin(list(lengths)))
    runs = F.flatten(F.transform(starts, lambda s: F.transform(by_head[s["head"]], lambda n: run(s["nth"], n))))
    return F.coalesce(F.filter(runs, lambda r: r["digest"].isNotNull()), nothing)


def known_digests(spark: SparkSession, known: Iterable[tuple[str, str]]) -> tuple[DataFrame, dict[str, list[int]]]:
    """``(digest, licence)``, one row per canonical form, and the lengths that ``passages`` asks for.

    Of several names of one form the first in order stands. A text has two forms, with and without titles and rights.
    """
    texts = spark.createDataFrame(list(known), "licence string, text string")
    forms = texts.select("licence", canonical_lines(F.col("text")).alias("lines")).select("licence", "lines", bodies(F.col("lines")).alias("parts"))
    said = F.array_join(F.filter("lines", lambda x: F.coalesce(x != "", F.lit(False))), " ")
    body = F.array_join("parts", " ")
    long = F.size("parts") > 1  # a text of one paragraph is found as that
    lengths: dict[str, list[int]] = {}
    found = forms.where(long).select(F.substring(F.col("parts")[0], 1, HEAD).alias("head"), F.length(body).alias("n")).distinct()
    for r in found.orderBy("head", "n").collect():  # at most one row per known text
        lengths.setdefault(r["head"], []).append(r["n"])
    every = forms.select(F.explode(F.array(_digest(said), F.when(long, _digest(body)))).alias("digest"), "licence")
    return every.where("digest is not null").groupBy("digest").agg(F.min("licence").alias("licence")), lengths


def scan(docs: DataFrame, known: Iterable[tuple[str, str]] | None = None) -> DataFrame:
    """``(doc_id, scope, nth, licence)`` of every known licence text in ``docs``.

    ``scope`` is ``document``, ``paragraph``, ``line`` or ``passage``; what matches in
    several comes back in each. ``nth`` of a passage counts paragraphs without titles. Null and empty texts match nothing. Rows with equal
    or null ids each come back. Other columns are not read. ``known`` are pairs of
    licence and text, by default ``known_texts()``.
    """
    spark = docs.sparkSession
    digests, lengths = known_digests(spark, known_texts() if known is None else known)
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), canonical_lines(whole_text("text")).alias("lines"))
    parted = lines.select("doc_id", "lines", bodies(F.col("lines")).alias("parts"))
    found = parted.select("doc_id", F.explode(F.concat(scopes(F.col("lines")), passages(F.col("parts"), lengths))).alias("s")).select(
        "doc_id", "s.scope", "s.nth", "s.digest"
    )
    return found.join(digests, "digest").select("doc_id", "scope", "nth", "licence")


def sql() -> str:
    """The same rows in DuckDB, over the whole ``documents``."""

    def lines(text: str) -> str:
        line = "concat(' ', x, ' ')"
        for word, same in SPELLINGS:
            line = f"replace({line}, ' {word}', ' {same}')"
        line = f"CASE WHEN NOT regexp_matches({line}, '{RIGHTS}') THEN trim({line}) END"
        return f"list_transform(string_split(regexp_replace(lower({text}), '[^\\pL\\pN\\n]+', ' ', 'g'), chr(10)), lambda x: {line})"

    def said(name: str) -> str:
        return f"coalesce(array_to_string(list_filter({name}, lambda x: x <> ''), ' '), '')"

    # Without lookahead: a holder's name is what follows the word and is none of the words that do within licences.
    name = "regexp_replace(x, '^copyright (c |by )?', '')"
    gone = f"regexp_matches(x, '{TITLES}') OR (x LIKE 'copyright %' AND regexp_matches({name}, '^[\\pL\\pN]') AND NOT regexp_matches({name}, '^{NO_HOLDER}'))"
    bodies = (
        f"list_filter(list_transform(string_split_regex(coalesce(array_to_string(list_transform(list_filter(lines, lambda x: x IS NOT NULL), "
        f"lambda x: CASE WHEN {gone} THEN '' ELSE x END), chr(10)), ''), '\n{{2,}}'), lambda x: trim(replace(x, chr(10), ' '))), lambda x: x <> '')"
    )
    known = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in pair)) for pair in known_texts())
    return f"""
WITH forms AS (
  SELECT *, {bodies} AS parts FROM (SELECT licence, {lines("text")} AS lines FROM (VALUES {known}) AS t(licence, text))
), known AS (
  SELECT digest, min(licence) AS licence FROM (
    SELECT md5({said("lines")}) AS digest, licence FROM forms
    UNION ALL SELECT md5(array_to_string(parts, ' ')), licence FROM forms WHERE len(parts) > 1) GROUP BY 1
), heads AS (
  SELECT DISTINCT left(parts[1], {HEAD}) AS head, length(array_to_string(parts, ' ')) AS n FROM forms WHERE len(parts) > 1
), held AS (
  SELECT doc_id, {lines("coalesce(text, '')")} AS lines FROM documents
), paragraphs AS (
  SELECT doc_id, list_filter(string_split_regex(
    coalesce(array_to_string(list_filter(lines, lambda x: x IS NOT NULL), chr(10)), ''), '\n{{2,}}'), lambda x: x <> '') AS parts FROM held
), stretches AS (
  SELECT doc_id, 'document' AS scope, -1 AS nth, {said("lines")} AS said FROM held
  UNION ALL
  SELECT doc_id, 'paragraph', unnest(range(len(parts))), unnest(list_transform(parts, lambda x: trim(replace(x, chr(10), ' ')))) FROM paragraphs
  UNION ALL
  SELECT doc_id, 'passage', nth, replace(left(rest, n), chr(10), ' ') FROM (
    SELECT doc_id, nth, n, array_to_string(parts[nth + 1:], chr(10)) AS rest
    FROM (SELECT doc_id, parts, unnest(range(len(parts))) AS nth FROM (SELECT doc_id, {bodies} AS parts FROM held)) JOIN heads ON left(parts[nth + 1], {HEAD}) = head)
  WHERE length(rest) >= n AND substr(rest, n + 1, 1) IN ('', chr(10))
  UNION ALL
  SELECT * FROM (SELECT doc_id, 'line', unnest(range(len(lines))), unnest(lines) AS said FROM held) WHERE said <> ''
)
SELECT doc_id, scope, CAST(nth AS INT) AS nth, licence FROM stretches JOIN known ON md5(said) = digest
"""
