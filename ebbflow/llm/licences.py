"""License scans: canonical digest lookup, with DataFrame functions only.

Texts are reduced to a canonical form: lower case, copyright lines (with a year, a sign or a
holder) dropped, equivalent spellings replaced, punctuation and white space reduced to single spaces. Its SHA-256 is
hash-joined to the digests of known licences. Looked up are the whole text of a document and
each of its lines (licence notices stand on a line of their own). A text that holds copyright
lines of its own (the GNU family does) is known with its lines as published; any other may be wrapped anew. Known are the full standard texts
(``licence_texts`` and ``SHORT``) with and without their titles, and with and without what
follows "END OF TERMS AND CONDITIONS".

A canonical text can only equal a known one if it holds one of the marker words that every
known text has (taken from the table, and checked), so only such texts and lines are reduced.
The table of digests is about a hundred constants and is broadcast.

Defined results: null and empty texts have no licence; repeated rows have equal results; a
null doc_id is looked up like any other; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Spellings that count as equal (first is replaced by second).
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("organisation", "organization"),
    ("favour", "favor"), ("honour", "honor"), ("merchantibility", "merchantability"), ("non commercial", "noncommercial"),
    ("per cent", "percent"), ("copyright owner", "copyright holder"), ("http", "https"), ("and or", "and/or"),
    ("acknowledgement", "acknowledgment"), ("authorisation", "authorization"), ("modelled", "modeled"),
    ("recognised", "recognized"), ("whilst", "while"), ("wilful", "willful"),
)

# Public licence texts and notices, by SPDX identifier.
SHORT: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.
If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is
not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.

3. This notice may not be removed or altered from any source distribution."""),
)

# Titles that may stand before a text that has none itself.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "ISC"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "BSD Zero Clause License (0BSD)", "0BSD"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License", "Zlib"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License',
                     "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License',
                     "New BSD License", "Modified BSD License"),
}
#: Lines with words that are the title of a file in ``licence_texts``.
TITLE_LINES = {"Apache-2.0": 3, "GPL-2.0-only": 2, "GPL-3.0-only": 2, "LGPL-2.1-only": 2, "LGPL-3.0-only": 2, "MPL-2.0": 1,
               "CC0-1.0": 2, "CC-BY-SA-4.0": 1}
FULL = tuple((f.stem, f.read_text("utf-8")) for f in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")))


def variants(name: str, text: str) -> list[str]:
    """A known text with and without title, what follows its terms, and clause numbers."""
    out = [text]
    if len(text) <= 300:  # a notice
        return out
    if name in TITLE_LINES:
        lines = text.splitlines()
        worded = [k for k, line in enumerate(lines) if re.search(r"\w", line)]
        out.append("\n".join(lines[worded[TITLE_LINES[name]]:]))
        out += [cut for x in out for end in re.finditer(r"END OF TERMS AND CONDITIONS", x)
                for cut in (x[:end.start()], x[:end.end()])]
    else:
        if name.startswith("BSD-"):
            out.append(re.sub(r"(?m)^\d\. ", "", text))
        out += [f"{title}\n\n{x}" for x in out for title in TITLES[name]]
    return out


KNOWN: tuple[tuple[str, str], ...] = tuple((n, v) for n, t in (*SHORT, *FULL) for v in variants(n, t))


def markers_of(known, first=("licen", "permission")) -> tuple[str, ...]:
    """``first``, and a long word of each known text that holds none of the others."""
    out = list(first)
    for _, text in known:
        if not any(m in text.lower() for m in out):
            out.append(max(re.findall(r"[a-z]+", text.lower())[:20], key=len))
    return tuple(out)


MARKERS = markers_of(KNOWN)

#: "copyright" before these words does not state one; it is set aside while copyright lines are dropped.
NOT_STATED = r"\bcopyright([ \t]+(holders?|owners?|notices?|licen[cs]\w+|laws?|statements?|and|or)\b)"
ASIDE = "copyrightaside"
#: Lines that state a copyright, whole: the word with a year, a sign, a placeholder, an address or a
#: holder, or those alone. No pattern looks ahead, so other engines read it the same way.
COPYRIGHT_LINE = (r"(?m)^[ \t\W]*(copyright\b([^\n]*(\b(19|20)\d\d\b|\(c\)|©|[\[<{][ \t]*(yyyy|year|name|owner)|all rights reserved"
                  r"|[^ \t\n]@[^ \t\n])[^\n]*|[^\n]*\b(authors|contributors|developers|inc|llc|ltd|gmbh|foundation|university)\W*"
                  r"|[ \t]+by\b[^\n]*)|\(c\)[^\n]*|©[^\n]*|all rights reserved\b[^\n]*)$")


def canonical(text: Column) -> Column:
    """Canonical form of a text column; see the module text."""
    t = F.regexp_replace(F.regexp_replace(F.lower(text), "\r", ""), NOT_STATED, ASIDE + "$1")
    t = F.regexp_replace(t, COPYRIGHT_LINE, " ")
    t = F.replace(t, F.lit(ASIDE), F.lit("copyright"))
    t = F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " "))
    for was, now in SPELLINGS:
        plain = now.replace("/", " ")
        if plain != was:
            t = F.regexp_replace(t, rf"\b{was}\b", plain)
    return t


def holds_marker(text: Column) -> Column:
    return F.lower(text).rlike("|".join(MARKERS))


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """(digest, licence) of the known texts: a constant table."""
    for name, text in known:
        if not any(m in text.lower() for m in MARKERS):
            raise ValueError(f"no marker word in a text of {name}")
    rows = spark.createDataFrame(list(known), "licence string, text string")
    return rows.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "licence").groupBy("digest").agg(
        F.min("licence").alias("licence"))


#: What stands for a text in the join: two texts of one length with one hash are not expected in any corpus.
KEY = ["text_hash", "n_bytes"]


def scan(docs: DataFrame, known=KNOWN) -> DataFrame:
    """doc_id, whole_licence (of the entire text, or null) and notices (licences named by
    whole lines, sorted and joined by commas, or null) of every row."""
    digests = F.broadcast(known_digests(docs.sparkSession, known))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_bytes"),
                       F.when(holds_marker(F.col("text")), F.sha2(canonical(F.col("text")), 256)).alias("digest"),
                       F.when(holds_marker(F.col("text")), F.col("text")).alias("text"))
    whole = rows.drop("text").join(digests, "digest", "left").select("doc_id", *KEY, F.col("licence").alias("whole_licence"))
    lines = rows.where("text is not null").select(*KEY, F.explode(F.split("text", "\n")).alias("line")).where(holds_marker(F.col("line")))
    notices = (lines.select(*KEY, F.sha2(canonical(F.col("line")), 256).alias("digest")).join(digests, "digest")
               .groupBy(*KEY).agg(F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("notices")))
    return whole.join(notices, KEY, "left").select("doc_id", "whole_licence", "notices")
