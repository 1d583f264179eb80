"""Licence scan: digests of canonical texts, looked up among those of known licences.

Canonical form: lower case, copyright lines removed, equivalent spellings made one, every run of
characters that are neither letters nor digits one blank. Whole texts are looked up, and every line by itself, as
licence notices often stand alone in a line. The texts of more than a page are in ``licence_texts``.
"""

from __future__ import annotations

import re
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.llm.common import has

# Spellings that licence matching treats as equal.
SPELLINGS = [
    ("licence", "license"),
    ("licenced", "licensed"),
    ("licences", "licenses"),
    ("licencing", "licensing"),
    ("acknowledgement", "acknowledgment"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("copyright holder", "copyright owner"),
    ("copyright holders", "copyright owners"),
    ("distributions", "distribution"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("merchantibility", "merchantability"),
    ("noncommercial", "non commercial"),
    ("organisation", "organization"),
    ("percent", "per cent"),
    ("sub license", "sublicense"),
    ("wilful", "willful"),
]

# Licence identifiers with their public texts and the notices in common use.
MIT = """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
ISC = """ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""
BSD_2 = """BSD 2-Clause License

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
CLAUSE_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

"""
BSD_3 = BSD_2.replace("BSD 2-Clause", "BSD 3-Clause").replace("THIS SOFTWARE IS PROVIDED", CLAUSE_3 + "THIS SOFTWARE IS PROVIDED")
#: Headings that the short texts have or lack.
TITLES = {
    "MIT": (MIT, ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "License: MIT"]),
    "ISC": (ISC, ["ISC License", "The ISC License", "ISC License (ISC)"]),
    "BSD-2-Clause": (BSD_2, ["BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License",
                             'BSD 2-Clause "Simplified" License', "Simplified BSD License", "BSD License"]),
    "BSD-3-Clause": (BSD_3, ["BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License",
                             'BSD 3-Clause "New" or "Revised" License', "New BSD License", "BSD License"]),
}
SPDX = {
    "Apache-2.0": [], "BSD-3-Clause": [], "CC-BY-4.0": [], "CC-BY-SA-4.0": [], "CC-BY-NC-4.0": [], "CC-BY-ND-4.0": [],
    "CC-BY-NC-SA-4.0": [], "CC0-1.0": [], "MPL-1.1": [], "MPL-2.0": [], "Unlicense": [],
    **{name: ["-only", "-or-later", "+"] for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")},
}
GNU = [
    ("GPL-2.0", "General", "2"), ("GPL-3.0", "General", "3"), ("LGPL-2.1", "Lesser General", "2.1"),
    ("LGPL-3.0", "Lesser General", "3"), ("AGPL-3.0", "Affero General", "3"),
]
CREATIVE_COMMONS = [
    ("CC-BY-4.0", "Attribution"), ("CC-BY-SA-4.0", "Attribution-ShareAlike"), ("CC-BY-NC-4.0", "Attribution-NonCommercial"),
    ("CC-BY-ND-4.0", "Attribution-NoDerivatives"), ("CC-BY-NC-SA-4.0", "Attribution-NonCommercial-ShareAlike"),
]
APACHE = 'Licensed under the Apache License, Version 2.0 (the "License");'
MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
HEADERS = [
    ("Apache-2.0", APACHE),
    ("Apache-2.0", f"{APACHE} you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License);"),
    ("Apache-2.0", "Licensed under the Apache License 2.0."),
    ("Apache-2.0", "The ASF licenses this file to You under the Apache License, Version 2.0"),
    ("MPL-2.0", MPL),
    ("MPL-2.0", "License, v. 2.0. If a copy of the MPL was not distributed with this"),
    ("MPL-2.0", f"{MPL} If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", f"{MPL} If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def _titled() -> list[tuple[str, str]]:
    """The short texts under each heading or none, with numbers or other marks before their clauses."""
    out = []
    for name, (text, titles) in TITLES.items():
        body = text.split("\n", 1)[1]
        for form in dict.fromkeys([body, re.sub(r"(?m)^[0-9]\. ", "* ", body)]):
            out += [(name, f"{title}\n{rights}\n{form}") for title in ["", *titles] for rights in ("", "All rights reserved.")]
    return out


def _long() -> list[tuple[str, str]]:
    """The texts of ``licence_texts`` in their forms; a file is named by its licence and, after a plus, its edition.

    Forms are with and without the instructions after the terms, with the place for a copyright line filled in,
    and with either scheme of web addresses.
    """
    out = []
    for file in sorted(files("clearwell.llm").joinpath("licence_texts").iterdir(), key=lambda f: f.name):
        text = file.read_text(encoding="utf-8")
        forms = [text, re.sub(r"(?m)^.*Copyright \[yyyy\].*\n", "", text)]
        forms += [text[: end.end()] for end in re.finditer("END OF TERMS AND CONDITIONS", text)][:1]
        forms += [form.replace(one, other) for form in forms for one, other in
                  (("http://", "https://"), ("https://", "http://"))]
        out += [(file.name.removesuffix(".txt").split("+")[0], form) for form in dict.fromkeys(forms)]
    return out


def _notices() -> list[tuple[str, str]]:
    """Identifiers and standard headers, each in one line."""
    out = [(name, f"SPDX-License-Identifier: {name}{end}") for name, ends in SPDX.items() for end in ["", *ends]]
    for name, kind, version in GNU:
        terms = f"under the terms of the GNU {kind} Public License"
        out.append((name, f"This work is licensed under the GNU {kind} Public License, version {version}."))
        for what in ("program", "library", "software", "file"):
            out += [
                (name, f"This {what} is free software; you can redistribute it and/or modify it {terms} {which}")
                for which in (
                    f"as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version.",
                    f"as published by the Free Software Foundation; version {version} of the License.",
                    f"version {version} as published by the Free Software Foundation.",
                )
            ]
    for name, kind in CREATIVE_COMMONS:
        out += [(name, f"This work is licensed under {a} Creative Commons {kind} 4.0 International License.") for a in ("a", "the")]
    return out + HEADERS


KNOWN = [
    ("MIT", MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", ISC),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("BSD-2-Clause", BSD_2),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
]
KNOWN = list(dict.fromkeys([*KNOWN, *_titled(), *_long(), *_notices()]))
#: Letters of a word that tell a line apart before it is brought in canonical form.
MARKER = 5
#: A line that only says who holds the copyright.
COPYRIGHT_LINE = r"(^|\n)[^\p{L}\p{N}\n]*(copyright[^\p{L}\p{N}\n]*(\(c\)|©|[0-9])|©|\(c\))[^\n]*"


def canonical(text: Column) -> Column:
    """The canonical form; NULL is the empty text."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "$1")
    out = F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))
    # With two blanks between words each has its own pair of blanks around it.
    out = F.concat(F.lit(" "), F.replace(out, F.lit(" "), F.lit("  ")), F.lit(" "))
    for other, one in SPELLINGS:
        other, one = (f" {s.replace(' ', '  ')} " for s in (other, one))
        out = F.replace(out, F.lit(other), F.lit(one))
    return F.trim(F.replace(out, F.lit("  "), F.lit(" ")))


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form; NULL where that is empty."""
    return F.nullif(F.sha2(canonical(text), 256), F.sha2(F.lit(""), 256))


def marker(text: Column) -> Column:
    """The first letters of the longest word that every spelling of a known text has; NULL if there is none."""
    written = [w for _, one in SPELLINGS for w in one.split() if not w.startswith("licen")]
    fixed = F.filter(F.split(canonical(text), " "), lambda w: (F.length(w) >= MARKER) & ~w.isin(written))
    longest = F.array_max(F.transform(fixed, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))
    return F.substring(longest["w"], 1, MARKER)


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """``licence, digest, marker`` of known texts, one row per digest."""
    rows = spark.createDataFrame(known or KNOWN, "licence string, text string")
    return rows.groupBy(digest(F.col("text")).alias("digest")).agg(
        F.min("licence").alias("licence"), F.min(marker(F.col("text"))).alias("marker")
    ).where("digest IS NOT NULL AND licence IS NOT NULL")


def licences(documents: DataFrame, known: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, digest, licence, n_notices, notices`` of every row.

    ``licence`` is that of the whole text, NULL if its digest is not known. ``n_notices`` counts the different
    lines that are known by themselves, ``notices`` names their licences, each once, in order, joined by commas;
    rows that share a key share these.
    NULL, empty and wordless texts have no digest and no licence. Repeated rows are each returned; an empty
    table gives an empty result; other columns are not read. ``known`` is joined by its measured size.
    """
    has(documents, key=key, text=text)
    known = known if known is not None else known_digests(documents.sparkSession)
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    whole = rows.select("key", digest(F.col("text")).alias("digest"))
    # Only a line with the marker of a known text can be equal to it: few are left to bring in canonical form.
    markers = {r["marker"] for r in known.select("marker").distinct().collect()}  # one per known text
    pattern = "" if None in markers else "|".join(sorted(markers))
    lines = rows.select("key", F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.where(F.col("line").rlike(f"(?i){pattern}"))
    hits = lines.select("key", digest(F.col("line")).alias("digest")).join(known.drop("marker"), "digest").distinct()
    found = hits.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.sort_array(F.collect_set("licence")), ",").alias("notices")
    )
    named = whole.join(known.drop("marker"), "digest", "left").alias("w")
    joined = named.join(found.alias("f"), F.col("w.key").eqNullSafe(F.col("f.key")), "left")
    return joined.select(
        F.col("w.key").alias(key), "digest", "licence", F.coalesce("n", F.lit(0)).cast("long").alias("n_notices"),
        F.coalesce("notices", F.lit("")).alias("notices"),
    )
