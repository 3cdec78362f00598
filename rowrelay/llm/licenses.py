"""Licence scan: normalised text against licence templates, by Dice coefficient over word bigrams.

All in DataFrame functions, in one projection: no shuffle, so no document or licence
can become a hot key.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowrelay.llm.common import column

LEAST = 0.8
# The letters that are folded, and the wording of licences.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
    "THE SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. "
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission. "
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
    "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS "
    "OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, "
    "OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} General Public License as published by the Free "
    "Software Foundation, either version {version} of the License, or (at your option) any later version. This program is distributed in the hope that it will be "
    "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} General Public "
    "License for more details. You should have received a copy of the GNU {name} General Public License along with this program."
)
TEMPLATES = {
    "AGPL-3.0-notice": _GNU.format(name="Affero", version=3),
    "BSD-2-Clause": _BSD + _BSD_WARRANTY,
    "BSD-3-Clause": _BSD + _BSD_THIRD + _BSD_WARRANTY,
    "LGPL-3.0-notice": _GNU.format(name="Lesser", version=3),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
        "software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope "
        "that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        "See the GNU General Public License for more details."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
}
TEMPLATES["MIT-full"] = f"{TEMPLATES['MIT-text']} {_WARRANTY}"


def words_of(text: str) -> list[str]:
    """Words of a template: runs of ASCII letters and digits, lower-cased."""
    return "".join(c.lower() if c.isascii() and c.isalnum() else " " for c in text).split()


def bigrams_of(templates: dict[str, str]) -> list[str]:
    """All bigrams of the templates."""
    words = map(words_of, templates.values())
    return sorted({f"{a} {b}" for w in words for a, b in zip(w, w[1:], strict=False)})


def _known(templates: dict[str, str]) -> Column:
    """The templates as one literal array: id, number of bigrams, how often each occurs, and the most that one does."""
    rows = []
    for name, text in sorted(templates.items()):
        words = words_of(text)
        grams = Counter(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))
        if grams:
            each = F.array(*[F.struct(F.lit(g).alias("gram"), F.lit(n).alias("times")) for g, n in sorted(grams.items())])
            names = F.array(*[F.lit(g) for g in sorted(grams)])
            rows.append(F.struct(F.lit(name).alias("license"), F.lit(len(words) - 1).alias("size"), each.alias("grams"), names.alias("names"), F.lit(max(grams.values())).alias("most")))
    if not rows:
        raise ValueError("no template has two words")
    return F.array(*rows)


def bigrams(words: Column) -> Column:
    size = F.size(words) - 1
    return F.zip_with(F.slice(words, 1, size), F.slice(words, 2, size), lambda a, b: F.concat(a, F.lit(" "), b))


def units(rows: DataFrame, grams: list[str]) -> DataFrame:
    """(doc_id, units) from (doc_id, text): the normalised parts of a text that may be a licence.

    They are each line, each paragraph of several lines, each stretch of lines that have
    half of their bigrams at least in ``grams``, those of the templates, and all of the text,
    as structs of words and size, the number of bigrams; parts without words are left out.
    A stretch finds a wrapped licence between other lines, also one of several paragraphs, as
    lines without words don't end it. Each step is a projection of its own, as what stands
    in one expression twice is computed twice.
    """
    plain = F.lower(F.regexp_replace("text", r"[^A-Za-z0-9\n]+", " "))
    rows = rows.select("doc_id", plain.alias("plain"))
    lines = F.filter(F.transform(F.split("plain", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    flat = lambda part: F.trim(F.regexp_replace(part, "[ \n]+", " "))
    blank = F.contains("plain", F.lit("\n\n")) | F.contains("plain", F.lit("\n \n"))
    several = F.transform(F.filter(F.split("plain", "\n *\n"), lambda p: F.contains(p, F.lit("\n"))), flat)
    rows = rows.select("doc_id", lines.alias("lines"), F.when(blank, several).otherwise(F.array().cast("array<string>")).alias("paragraphs"))
    rows = rows.withColumn("line_grams", F.transform("lines", lambda x: bigrams(F.split(x, " "))))
    rows = rows.withColumn("hits", F.array_intersect(F.flatten("line_grams"), F.array(*map(F.lit, grams))))
    alike = lambda own: (F.size(own) > 0) & (2 * F.size(F.filter(own, lambda g: F.array_contains("hits", g))) >= F.size(own))
    marked = F.array_join(F.zip_with("lines", "line_grams", lambda x, own: F.when(alike(own), x).otherwise("")), "\n")
    rows = rows.select("doc_id", "lines", "paragraphs", F.when(F.size("hits") > 0, marked).otherwise("").alias("marked"))
    stretches = F.transform(F.filter(F.split("marked", "\n\n+"), lambda p: F.contains(p, F.lit("\n"))), flat)
    parts = F.array_distinct(F.concat("lines", "paragraphs", F.filter(stretches, lambda p: p != ""), F.array(F.array_join("lines", " "))))
    gaps = lambda u: F.octet_length(u) - F.octet_length(F.replace(u, F.lit(" "), F.lit("")))
    return rows.select("doc_id", F.transform(parts, lambda u: F.struct(u.alias("words"), gaps(u).alias("size"))).alias("units"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """(doc_id, n_units, matches) of every row.

    A unit is a line, a paragraph of several lines, a stretch of lines that look like a
    template's (:func:`units`), or the whole text, normalised to lower-case ASCII words; equal
    units of a document count once. A unit is compared
    with a template only if their numbers of bigrams allow a Dice coefficient of
    ``least``: the smaller must be at least least / (2 - least) of the larger. Bigrams
    count as often as they occur. n_units are the units that are compared with some
    template; matches are those of at least ``least``: (license, dice, words), by
    license and words. Null texts and texts without words have no unit. Repeated rows
    each get a row; an empty table gives none. Other columns are not read.
    """
    templates = TEMPLATES if templates is None else templates
    known = _known(templates)
    ratio = least / (2 - least)
    text = F.coalesce(column(docs, text_col).cast("string"), F.lit(""))
    sizes = [len(words_of(t)) - 1 for t in templates.values()]
    low, high = min(n for n in sizes if n > 0) * ratio, max(sizes) / ratio
    near = lambda n, m: (F.least(n, m) >= ratio * F.greatest(n, m)) & (n > 0)
    rows = units(docs.select(column(docs, id_col).alias("doc_id"), text.alias("text")), bigrams_of(templates))
    some = F.filter("units", lambda u: (u["size"] >= low) & (u["size"] <= high))
    some = F.filter(some, lambda u: F.exists(known, lambda t: near(u["size"], t["size"])))
    rows = rows.select("doc_id", some.alias("units"))

    def compared(u: Column) -> Column:
        grams = bigrams(F.split(u["words"], " "))

        def one(own: Column, t: Column) -> Column:
            shared = F.aggregate(t["grams"], F.lit(0), lambda total, g: total + F.least(g["times"], F.size(F.filter(own, lambda x: x == g["gram"]))))
            return F.struct(t["license"].alias("license"), F.round(2.0 * shared / (u["size"] + t["size"]), 6).alias("dice"), u["words"].alias("words"))

        # The different bigrams in common bound the coefficient, before they are counted.
        hopeful = lambda own, t: 2 * F.size(F.array_intersect(own, t["names"])) * t["most"] >= least * (u["size"] + t["size"]) - 1e-6
        chosen = lambda own: F.filter(F.filter(known, lambda t: near(u["size"], t["size"])), lambda t: hopeful(own, t))
        return F.flatten(F.transform(F.array(grams), lambda own: F.transform(chosen(own), lambda t: one(own, t))))

    matches = F.filter(F.flatten(F.transform("units", compared)), lambda m: m["dice"] >= least)
    return rows.select("doc_id", F.size("units").cast("long").alias("n_units"), F.array_sort(matches).alias("matches"))
