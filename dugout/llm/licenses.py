"""Licence scans by canonical digest lookup, in column functions only.

A text is brought to a canonical form: copyright lines go, letters become lower case, spellings that
mean the same become one, and punctuation and white space become single spaces. The digest of the whole
form is hash-joined to those of known licence texts. Notices, short sentences that name a
licence, are looked up the same way, each line of a text, and each sentence even if it wraps, being
an entire unit. Standard notices, the long ones that licences ask for, count wherever their words
stand in a row in the canonical form.

Known texts are a small table given by the caller; the defaults are below and in the folder
``license_texts``, as published, and in their other usual forms. It is bounded by the
number of licences, not by the data, so Spark may broadcast it.

Defined results: NULL texts and texts without a letter or digit have no digest and no licence;
repeated rows are each scanned; notices are listed once each, in order of name; an empty table
gives no rows; other columns are kept on request, but
a result hides one of its name. If two known texts have one digest, the
first name in order counts.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence texts and notices, as published. {year} and the like lie in copyright lines.
_GRANT_BSD = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution.
"""
_END_BSD = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER
IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
_GRANT_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with
or without fee is hereby granted"""
_END_ISC = """

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE.
"""
LICENSES = {
    "0BSD": _GRANT_ISC + "." + _END_ISC,
    "BSD-2-Clause": _GRANT_BSD + _END_BSD,
    "BSD-3-Clause": _GRANT_BSD
    + """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission.
"""
    + _END_BSD,
    "ISC": _GRANT_ISC + ", provided that the above copyright notice and this permission notice appear in all copies." + _END_ISC,
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event
will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial
applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the
original software. If you use this software in a product, an acknowledgment in the product
documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
the original software.
3. This notice may not be removed or altered from any source distribution.
""",
}
NOTICES = {
    "All-Rights-Reserved": "All rights reserved.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
}
_GNU = "This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation; "
# Notices as the licences or their publishers word them, without the sentences that follow.
STANDARD_NOTICES = {
    "AGPL-3.0": tuple(_GNU.format(x, "Affero General Public License") + "either version 3" for x in ("program", "library", "software")),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License',
        "licenses this file to you under the Apache License, Version 2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "BSD-2-Clause": ("SPDX-License-Identifier: BSD-2-Clause",),
    "BSD-3-Clause": ("SPDX-License-Identifier: BSD-3-Clause",),
    "CC-BY-4.0": ("licensed under a Creative Commons Attribution 4.0 International License", "SPDX-License-Identifier: CC-BY-4.0"),
    "CC-BY-NC-4.0": ("licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "CC-BY-SA-4.0": ("licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "EPL-1.0": ("made available under the terms of the Eclipse Public License v1.0",),
    "EPL-2.0": ("made available under the terms of the Eclipse Public License v. 2.0", "made available under the terms of the Eclipse Public License 2.0"),
    "GPL-2.0": tuple(_GNU.format(x, "General Public License") + "either version 2" for x in ("program", "library", "software"))
    + ("SPDX-License-Identifier: GPL-2.0",),
    "GPL-3.0": tuple(_GNU.format(x, "General Public License") + "either version 3" for x in ("program", "library", "software"))
    + ("SPDX-License-Identifier: GPL-3.0",),
    "ISC": ("SPDX-License-Identifier: ISC",),
    "LGPL-2.1": tuple(_GNU.format(x, "Lesser General Public License") + "either version 2.1" for x in ("program", "library", "software")),
    "LGPL-3.0": tuple(_GNU.format(x, "Lesser General Public License") + "either version 3" for x in ("program", "library", "software")),
    "MIT": ("SPDX-License-Identifier: MIT",),
    "MPL-2.0": ("subject to the terms of the Mozilla Public License, v. 2.0", "SPDX-License-Identifier: MPL-2.0"),
}
TEXTS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "license_texts")
# What follows these in a text as published is often left out.
ENDS = ("END OF TERMS AND CONDITIONS", "How to Apply These Terms", "ADDENDUM: How to use", "For more information, please refer to")
# Spellings that count as equal, each after punctuation has become spaces.
SAME = (
    ("acknowledgement", "acknowledgment"),
    ("authorisation", "authorization"),
    ("copyright owner", "copyright holder"),
    ("favour", "favor"),
    ("licence", "license"),
    ("merchantibility", "merchantability"),
    ("non infringement", "noninfringement"),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("sub license", "sublicense"),
    ("while", "whilst"),
)
COPYRIGHT_LINE = r"(?m)^[ \t#*/;%-]*(copyright[ \t]+(\(c\)|©|[0-9<\[{])|\(c\)[ \t]|©)[^\n]*$"
PUNCTUATION = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F©«»‐‑‒–—―‘’‚“”„…]+"
UNITS = r"\. |\n"
# Ends of sentences, which may wrap, and of paragraphs, also in comments; 'v. 2' is not an end.
SENTENCES = r"(?<![ (][vV])[.!?][\"')”’]*\s+|\n[ \t#*/;%-]*(?=\n)"
# A private character, which the canonical form leaves alone.
MARK = "\uE000"


@cache
def texts() -> tuple[tuple[str, str], ...]:
    """(license_id, text) of the folder, each also without what follows its terms, and with http links."""
    found = []
    for file in sorted(os.listdir(TEXTS)):
        with open(os.path.join(TEXTS, file), encoding="utf-8") as f:
            whole = f.read()
        forms = {whole}
        for end in ENDS:
            at = whole.rfind(end)
            if at > 0:
                forms |= {whole[:at], whole[: at + len(end)]} if end.isupper() else {whole[:at]}
        forms |= {x.replace("https://", "http://") for x in forms}
        found += [(file.removesuffix(".txt"), x) for x in sorted(forms)]
    return tuple(found)


def canonical(text: Column) -> Column:
    """The form whose digest is compared; empty for NULL."""
    return _spelt(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, ""))


def _spelt(out: Column) -> Column:
    out = F.concat(F.lit(" "), F.regexp_replace(out, PUNCTUATION, " "), F.lit(" "))
    for one, other in SAME:
        out = F.replace(out, F.lit(f" {one}"), F.lit(f" {other}"))
    return F.trim(F.regexp_replace(out, " +", " "))


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form, NULL if that is empty."""
    form = canonical(text)
    return F.when(form != "", F.sha2(form, 256))


def units(text: Column, ends: str, longest: int) -> Column:
    """Digests of the parts between ``ends`` whose canonical form is no longer than ``longest``."""
    marked = _spelt(F.regexp_replace(F.lower(text), ends, f" {MARK} "))
    parts = F.transform(F.split(marked, MARK), lambda u: F.trim(u))
    return F.transform(F.filter(parts, lambda u: (u != "") & (F.length(u) <= longest)), lambda u: F.sha2(u, 256))


def anchors(notices: Iterable[str]) -> set[str] | None:
    """A few beginnings of words of which every text with one of the notices holds one in lower case.

    A word with several spellings counts by what they share. None if some notice has no such word.
    """
    stems = {side: os.path.commonprefix(pair) for pair in SAME for side in pair if not any(" " in x for x in pair)}
    parts = {word for pair in SAME if any(" " in x for x in pair) for side in pair for word in side.split()} - stems.keys()
    choices = []
    for notice in notices:
        own = set()
        for word in re.sub(PUNCTUATION, " ", notice.lower()).split():
            stem = next((stem for side, stem in stems.items() if word.startswith(side)), word)
            if len(stem) > 3 and not any(x in word for x in parts):
                own.add(stem)
        choices.append(own)
    found = set()
    while choices:
        # The word that most of the notices left have; a long one among equals.
        best = max({w for own in choices for w in own}, key=lambda w: (sum(w in own for own in choices), len(w), w), default=None)
        if best is None or not all(choices):
            return None
        found.add(best)
        choices = [own for own in choices if best not in own]
    return found


def known(like: DataFrame, rows: list[tuple[str, str]]) -> DataFrame:
    """(digest, license_id), one row per digest."""
    rows = like.sparkSession.createDataFrame(sorted(rows), "license_id string, _text string")
    return rows.groupBy(digest(F.col("_text")).alias("_known")).agg(F.min("license_id").alias("license_id"))


def scan(
    docs: DataFrame,
    columns: tuple[str, ...] = ("doc_id",),
    licenses: dict[str, str] = LICENSES,
    notices: dict[str, str] = NOTICES,
    standard: dict[str, tuple[str, ...]] = STANDARD_NOTICES,
) -> DataFrame:
    """``columns`` of ``docs`` with digest, license_id of the whole text, and notices found in it.

    ``licenses`` are known besides those of the folder.
    """
    kept = [c for c in columns if c not in ("digest", "license_id", "notices")]
    text = F.coalesce(docs["text"], F.lit(""))
    # No unit longer than the longest notice can be one; spellings may add a letter a word.
    longest = 2 * max((len(n) for n in notices.values()), default=0)
    bare = F.regexp_replace(text, f"(?i){COPYRIGHT_LINE}", "\n")
    found = F.array_union(units(text, UNITS, longest), units(bare, SENTENCES, longest))
    # Few texts hold a word of a notice; only those are cut and searched.
    words = anchors([*notices.values(), *(n for own in standard.values() for n in own)])
    likely = F.lit(True) if words is None else F.lower(text).rlike("|".join(sorted(map(re.escape, words))))
    scanned = docs.select(*kept, canonical(F.col("text")).alias("_form"), likely.alias("_likely"), F.when(likely, found).alias("_units"))
    named = F.lit("")
    for name in sorted({*notices, *standard}):
        hit = F.array_contains(F.col("_units"), digest(F.lit(notices[name]))) if name in notices else F.lit(False)
        for notice in standard.get(name, ()):
            words = F.concat(F.lit(" "), canonical(F.lit(notice)), F.lit(" "))
            hit = hit | F.contains(F.concat(F.lit(" "), F.col("_form"), F.lit(" ")), words)
        named = F.concat(named, F.when(hit, F.lit(f"{name} ")).otherwise(""))
    own = F.when(F.col("_form") != "", F.sha2("_form", 256))
    named = F.when(F.col("_likely"), F.rtrim(named)).otherwise("")
    scanned = scanned.select(*kept, own.alias("digest"), named.alias("notices"))
    table = known(docs, [*licenses.items(), *texts()])
    joined = scanned.join(table, F.col("digest") == F.col("_known"), "left")
    return joined.select(*kept, "digest", "license_id", "notices")


def scan_sql(licenses: dict[str, str] = LICENSES, notices: dict[str, str] = NOTICES) -> str:
    """The same as check SQL over ``documents``."""

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def sql_digest(x: str) -> str:
        out = f"regexp_replace(lower(coalesce({x}, '')), '{COPYRIGHT_LINE}', '', 'g')"
        out = f"' ' || regexp_replace({out}, '{PUNCTUATION}', ' ', 'g') || ' '"
        for one, other in SAME:
            out = f"replace({out}, ' {one}', ' {other}')"
        return f"nullif(sha256(trim(regexp_replace({out}, ' +', ' ', 'g'))), sha256(''))"

    longest = 4 * max((len(n) for n in notices.values()), default=0)
    table = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in sorted(licenses.items()))
    hits = " || ".join(
        f"CASE WHEN list_contains(units, {sql_digest(quoted(v))}) THEN '{k} ' ELSE '' END" for k, v in sorted(notices.items())
    )
    return f"""
    WITH known AS (SELECT {sql_digest('t')} AS d, min(license_id) AS license_id FROM (VALUES {table}) x(license_id, t) GROUP BY 1),
    cut AS (SELECT doc_id, {sql_digest('text')} AS digest,
      list_transform(list_filter(regexp_split_to_array(coalesce(text, ''), '{UNITS}'), lambda u: length(u) <= {longest}),
                     lambda u: {sql_digest('u')}) AS units FROM documents)
    SELECT doc_id, digest, license_id, rtrim({hits}) AS notices FROM cut LEFT JOIN known ON digest = d"""
