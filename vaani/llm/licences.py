"""Licence scans by the Dice coefficient over word bigrams (built-in functions only).

Each line and each paragraph of several lines (between blank lines) of a text is normalised
to lower-case words of letters and digits and compared with licence notices.
A notice of ``t`` distinct bigrams can reach the coefficient ``d`` only with
texts of ``t*d/(2-d)`` to ``t*(2-d)/d`` bigrams, of which at least
``t*d/(2-d)`` occur in some notice; only notices that fit are compared.
``windows`` looks for them anywhere in the text, for notices that share their
line or comment block with other text.

Defined results: null and empty texts match nothing; a notice or line of one
word has no bigram and matches nothing; of notices with equal coefficients
the first by name is reported; repeated rows are scanned one by one; other
columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, functions as F

DICE = 0.8
#: Templates are literals of the plan; more text than this in all is refused.
MOST_TEMPLATE_CHARS = 1_000_000

#: Public licence notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "This work has been dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
)
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
)
_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain.",
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
)
_MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."


def _gnu(kind: str, version: str, what: str = "program") -> tuple[str, str]:
    """The permission paragraph of a GNU notice, and the whole notice."""
    first = (f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free Software Foundation, "
             f"either version {version} of the License, or (at your option) any later version.")
    return first, (f"{first} This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
                   f"See the GNU {kind} for more details. You should have received a copy of the GNU {kind} along with this {what}. If not, see <https://www.gnu.org/licenses/>.")


#: Whole notice paragraphs, notices and licence bodies, written out by hand and
#: not compared with the published files.  What several licences share (the disclaimer of BSD, the later
#: paragraphs of GNU notices) is only in the wholes.  The bodies of Apache, GNU
#: and Mozilla licences are known by their titles.
TEMPLATES += (
    ("MIT", "The MIT License (MIT)"), *(("MIT", t) for t in _MIT), ("MIT", " ".join(_MIT)),
    ("Apache-2.0", _APACHE[0]), ("Apache-2.0", _APACHE[1]), ("Apache-2.0", " ".join(_APACHE)),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-2-Clause", _BSD_TERMS), ("BSD-2-Clause", f"{_BSD_TERMS} {_BSD_DISCLAIMER}"),
    ("BSD-3-Clause", f"3. {_BSD_NAMES}"), ("BSD-3-Clause", f"{_BSD_TERMS} 3. {_BSD_NAMES}"), ("BSD-3-Clause", f"{_BSD_TERMS} 3. {_BSD_NAMES} {_BSD_DISCLAIMER}"),
    *(("ISC", t) for t in _ISC), ("ISC", " ".join(_ISC)),
    *(("Unlicense", t) for t in _UNLICENSE), ("Unlicense", " ".join(_UNLICENSE)),
    ("MPL-2.0", _MPL), ("MPL-2.0", "Mozilla Public License Version 2.0"),
    *(("GPL-2.0", t) for t in _gnu("General Public License", "2")), ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", _gnu("General Public License", "3")[1]), ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    *(("LGPL-2.1", t) for t in _gnu("Lesser General Public License", "2.1", "library")), ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    *(("LGPL-3.0", t) for t in _gnu("Lesser General Public License", "3")), ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    *(("AGPL-3.0", t) for t in _gnu("Affero General Public License", "3")), ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
)

NOT_WORD = r"[^\p{L}\p{N}]+"
PARAGRAPH = r"\n[ \t]*\n"


def template_bigrams(text: str) -> list[str]:
    words = re.sub(r"[\W_]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def scan(docs: DataFrame, templates=TEMPLATES, dice: float = DICE) -> DataFrame:
    """Per document: n_matches (lines and paragraphs), licences, best, best_dice."""
    if sum(len(t) for _, t in templates) > MOST_TEMPLATE_CHARS:
        raise ValueError("the templates are too long for one plan; scan with fewer at a time")
    known = [(name, b) for name, text in templates if (b := template_bigrams(text))]
    least = lambda t: math.ceil(t * dice / (2 - dice) - 1e-9)       # noqa: E731
    most = lambda t: math.floor(t * (2 - dice) / dice + 1e-9)       # noqa: E731
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    units = F.concat(F.split(text, "\n"), F.filter(F.split(text, PARAGRAPH), lambda p: F.contains(p, F.lit("\n"))))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", units.alias("units"))
    rows = rows.select("row", "doc_id", F.explode("units").alias("unit"))
    rows = rows.select("row", "doc_id", F.split(F.trim(F.regexp_replace(F.lower("unit"), NOT_WORD, " ")), " ").alias("words"))
    vocabulary = sorted({w for _, b in known for g in b for w in g.split()})
    floor = min((least(len(b)) for _, b in known), default=1)
    # each shared bigram starts at a word of some notice
    near = F.size(F.filter("words", lambda w: w.isin(vocabulary))) >= max(2, floor)
    pairs = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda i: F.concat_ws(" ", F.get("words", i - 1), F.get("words", i)))
    rows = rows.select("row", "doc_id", F.when(near & (F.size("words") > 1), F.array_distinct(pairs)).alias("bigrams"))
    every = sorted({g for _, b in known for g in b})
    rows = rows.withColumn("n", F.size("bigrams")).withColumn(
        "shared", F.size(F.filter("bigrams", lambda g: g.isin(every))))

    def compare(name: str, b: list[str]) -> Column:
        fits = (F.col("n") >= least(len(b))) & (F.col("n") <= most(len(b))) & (F.col("shared") >= least(len(b)))
        value = 2 * F.size(F.array_intersect("bigrams", F.array(*(F.lit(g) for g in b)))) / (F.col("n") + len(b))
        return F.when(fits, F.struct(value.alias("dice"), F.lit(name).alias("name")))

    found = F.filter(F.array(*(compare(*t) for t in known)), lambda x: x["dice"] >= dice)
    # the largest coefficient, then the first name
    best = F.aggregate(found, F.lit(None).cast("struct<dice:double,name:string>"),
                       lambda a, x: F.when(a.isNull() | (x["dice"] > a["dice"]) | ((x["dice"] == a["dice"]) & (x["name"] < a["name"])), x).otherwise(a))
    rows = rows.select("row", "doc_id", F.when(F.col("shared") >= floor, best).alias("hit"))
    return rows.groupBy("row", "doc_id").agg(
        F.count("hit").alias("n_matches"),
        F.array_join(F.array_sort(F.collect_set("hit.name")), ",").alias("licences"),
        F.min(F.when(F.col("hit").isNotNull(), F.struct((-F.col("hit.dice")).alias("d"), F.col("hit.name").alias("name")))).alias("first"),
    ).select("doc_id", "n_matches", "licences", F.col("first.name").alias("best"), F.round(-F.col("first.d"), 6).alias("best_dice"))


def windows(docs: DataFrame, templates=TEMPLATES, dice: float = DICE) -> DataFrame:
    """Per document: n_windows, licences, best, best_dice over the whole normalised text, lines and marks aside.

    A window has as many words as the notice and starts at a bigram of the
    notice.  Of overlapping windows that reach the coefficient, only those
    are kept that share the most bigrams (then the larger coefficient, the
    first name, the first place).
    """
    if sum(len(t) for _, t in templates) > MOST_TEMPLATE_CHARS:
        raise ValueError("the templates are too long for one plan; scan with fewer at a time")
    known = [(name, b, len(re.sub(r"[\W_]+", " ", text.lower()).split()) - 1) for name, text in templates if (b := template_bigrams(text))]
    least = lambda t: math.ceil(t * dice / (2 - dice) - 1e-9)       # noqa: E731
    floor = min((least(len(b)) for _, b, _ in known), default=1)
    every = sorted({g for _, b, _ in known for g in b})
    words = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), NOT_WORD, " ")), " ")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words.alias("words"))
    pairs = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda i: F.concat_ws(" ", F.get("words", i - 1), F.get("words", i)))
    rows = rows.select("row", "doc_id", F.when(F.size("words") > 1, pairs).alias("pairs"))
    rows = rows.withColumn("shared", F.array_distinct(F.filter("pairs", lambda g: g.isin(every))))
    # few texts share enough with any notice; only they are looked at place by place
    rows = rows.withColumn("pairs", F.when(F.size("shared") >= floor, F.col("pairs")))

    def found(name: str, b: list[str], n: int) -> Column:
        mine = F.array(*(F.lit(g) for g in b))
        starts = F.filter(F.sequence(F.lit(1), F.size("pairs")), lambda i: F.array_contains(mine, F.get("pairs", i - 1)))

        def at(i: Column) -> Column:
            window = F.array_distinct(F.slice("pairs", i, n))
            both = F.size(F.array_intersect(window, mine))
            return F.struct((-both).alias("less"), (-2 * both / (F.size(window) + len(b))).alias("d"), F.lit(name).alias("name"),
                            i.alias("start"), (i + F.least(F.lit(n), F.size("pairs") - i + 1)).alias("end"))
        fits = F.size(F.array_intersect("shared", mine)) >= least(len(b))
        return F.when(fits & F.col("pairs").isNotNull(), F.filter(F.transform(starts, at), lambda x: x["d"] <= -dice))

    kind = "array<struct<less:int,d:double,name:string,start:int,end:int>>"
    hits = F.array_sort(F.flatten(F.filter(F.array(*(found(*t).cast(kind) for t in known)), lambda x: x.isNotNull())))
    # the best first; each takes its place
    kept = F.aggregate(hits, F.array().cast(kind), lambda a, x: F.when(
        F.exists(a, lambda k: (k["start"] < x["end"]) & (x["start"] < k["end"])), a).otherwise(F.concat(a, F.array(x))))
    rows = rows.select("doc_id", F.when(F.col("pairs").isNotNull(), kept).otherwise(F.array().cast(kind)).alias("hits"))
    best = F.array_min(F.transform("hits", lambda h: F.struct(h["d"].alias("d"), h["name"].alias("name"))))
    return rows.select("doc_id", F.size("hits").cast("long").alias("n_windows"), F.array_join(F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["name"]))), ",").alias("licences"),
                       best["name"].alias("best"), F.round(-best["d"], 6).alias("best_dice"))


def oracle(templates=TEMPLATES, dice: float = DICE) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"      # noqa: E731
    known = ", ".join(f"({quote(n)}, [{', '.join(map(quote, b))}])" for n, t in templates if (b := template_bigrams(t)))
    return rf"""
WITH t(name, tb) AS (VALUES {known}),
rows AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
units AS (
  SELECT id, unnest(string_split(text, chr(10))
    || list_filter(regexp_split_to_array(text, '\n[ \t]*\n'), lambda p: contains(p, chr(10)))) AS unit FROM rows),
ws AS (SELECT id, string_split(trim(regexp_replace(lower(unit), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w FROM units),
bs AS (
  SELECT id, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM ws WHERE len(w) > 1),
d AS (
  SELECT row_number() OVER () AS unit, id, b FROM bs
  WHERE list_has_any(b, (SELECT flatten(list(tb)) FROM t))),
hits AS (
  SELECT unit, id, name, 2.0::DOUBLE * len(list_intersect(b, tb)) / (len(b) + len(tb)) AS dice FROM d, t),
best AS (
  SELECT unit, id, first(name ORDER BY dice DESC, name) AS name, max(dice) AS dice FROM hits WHERE dice >= {dice} GROUP BY unit, id),
agg AS (
  SELECT id, count(*) AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS licences,
         first(name ORDER BY dice DESC, name) AS best, max(dice) AS dice FROM best GROUP BY id)
SELECT doc_id, coalesce(n, 0) AS n_matches, coalesce(licences, '') AS licences, best, round(dice, 6) AS best_dice
FROM rows LEFT JOIN agg USING (id)
"""
