"""Licence scan: normalised text against licence templates by the Dice coefficient of word bigrams.

Units of a text are its lines, its paragraphs of several lines (lines without a letter or digit
part them, so comment marks do too), and the whole.  A unit with n distinct bigrams can reach a
coefficient t with a template of m only if m lies between t / (2 - t) * n and (2 - t) / t * n,
so other templates are not compared.  It must also share t / (2 - t) * m bigrams with the
template, so it holds a word of any set of words that touches more than the rest; texts without
a word of these sets are not cut in units at all.

So that matches do not hang on line breaks, windows of a template's length are compared too,
wherever the text has one of a template's anchor words, placed as the template places it.

Everything is DataFrame and SQL expressions, without a shuffle.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- Fixed values: texts of short licences ----
_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"
_BSD_START = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
_BSD_TWO = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_ZLIB = "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
#: Notices by which texts declare a licence, and the short licences themselves.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the MIT License."),
    ("mit", _MIT_GRANT),
    ("mit", f"{_MIT_GRANT}: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_AS_IS}"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("bsd-3-clause", "Released under the BSD 3-Clause License."),
    ("bsd-3-clause", _BSD_START),
    ("bsd-3-clause", f"{_BSD_START}: {_BSD_TWO} {_BSD_THIRD} {_BSD_END}"),
    ("bsd-2-clause", f"{_BSD_START}: {_BSD_TWO} {_BSD_END}"),
    ("isc", _ISC),
    ("zlib", _ZLIB),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-sa-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)
# ---- End of fixed values ----
#: Words that say little about a text.
COMMON = set("the and of to in or this is a be by for with you not under it that are at as any on use all from may must shall other without free general following mit".split())
#: Least coefficient of a match, and anchor words of a template.
THRESHOLD, ANCHORS = 0.8, 4


def words_of(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def bigrams_of(text: str) -> set[str]:
    words = words_of(text)
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def telling_words(text: str, threshold: float) -> list[str]:
    """Words of which a unit must hold one to match a template: few and, where there is a choice, long ones."""
    pairs = [g.split(" ") for g in bigrams_of(text)]
    touched, out = set(), []
    enough = len(pairs) - math.ceil(len(pairs) * threshold / (2 - threshold) - 1e-9) + 1
    for word in sorted({w for p in pairs for w in p}, key=lambda w: (w in COMMON, -sum(w in p for p in pairs), -len(w), w)):
        if len(touched) >= enough:
            break
        touched |= {i for i, p in enumerate(pairs) if word in p}
        out.append(word)
    return out


def spelt(words: list[str]) -> str:
    """A pattern for any of the words, branching letter by letter."""
    rest: dict[str, list[str]] = {}
    for word in words:
        rest.setdefault(word[:1], []).append(word[1:])
    ends = rest.pop("", None) is not None
    branches = [letter + (spelt(tails) if tails != [""] else "") for letter, tails in sorted(rest.items())]
    return branches[0] if len(branches) == 1 and not ends else "(?:" + "|".join(branches) + ")" + "?" * ends


def anchors(templates, threshold: float) -> list[tuple[int, str, int, int]]:
    """(template, word, words before its first place, words) of each template's first ANCHORS telling words."""
    out = []
    for t, (_, text) in enumerate(templates):
        words = words_of(text)
        out += [(t, w, words.index(w), len(words)) for w in telling_words(text, threshold)[:ANCHORS]]
    return out


def _words(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), " "), lambda w: w != "")


def _bigrams(words: Column) -> Column:
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.filter(pairs, lambda p: p.isNotNull()))


def _literal(grams: set[str]) -> Column:
    return F.array(*map(F.lit, sorted(grams)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, license, dice, n_matches, licenses): the best licence of every text, the number of templates that match, and all licences found.

    Of equal coefficients the first licence in the alphabet wins.  Null and empty texts, and
    texts without a match, have a null licence, a null coefficient and no match.  A row a
    document; repeated rows are scanned each.  An empty table gives no row.
    """
    names = [name for name, _ in templates]
    grams = [bigrams_of(text) for _, text in templates]
    low = min(map(len, grams)) * threshold / (2 - threshold)
    high = max(map(len, grams)) * (2 - threshold) / threshold
    known = _literal(set().union(*grams))
    text = F.coalesce(F.col(text_col), F.lit(""))
    telling = sorted(set().union(*(telling_words(t, threshold) for _, t in templates)))
    initials = "".join(sorted({w[0] for w in telling}))
    tells = F.lower(text).rlike(f"(?<![a-z0-9])(?=[{initials}]){spelt(telling)}(?![a-z0-9])")
    paragraphs = F.filter(F.split(text, r"\n(?:[^0-9A-Za-z\n]*\n)+"), lambda p: F.contains(p, F.lit("\n")))
    units = F.concat(F.split(text, "\n"), paragraphs, F.filter(F.array(text), lambda t: F.contains(t, F.lit("\n"))))
    none = F.array().cast("array<string>")
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.when(tells, F.array_distinct(units)).otherwise(none).alias("units"), F.when(tells, _words(text)).otherwise(none).alias("words"))

    sized = F.transform("units", lambda u: F.struct(_words(u).alias("words")))
    sized = F.transform(sized, lambda u: F.struct(_bigrams(u["words"]).alias("grams")))
    sized = F.filter(sized, lambda u: F.size(u["grams"]).between(low - 1e-9, high + 1e-9))
    shared = F.transform(sized, lambda u: F.struct(F.size(u["grams"]).alias("n"), F.array_intersect(u["grams"], known).alias("grams")))
    shared = F.filter(shared, lambda u: 2 * F.size(u["grams"]) >= F.lit(threshold) * u["n"] - 1e-9)

    places = anchors(templates, threshold)
    entries = F.array(*(F.struct(F.lit(t).alias("t"), F.lit(w).alias("w"), F.lit(o).alias("o"), F.lit(m).alias("m")) for t, w, o, m in places))
    marked = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(sorted({w for _, w, _, _ in places})))

    def hit(t: Column, name: Column, both: Column, n: Column, m: Column) -> Column:
        return F.struct((-F.round(2.0 * both / (n + m), 6)).alias("order"), name.alias("license"), t.alias("t"))

    def compare(unit: Column) -> Column:
        rows = []
        for t, template in enumerate(grams):
            m = len(template)
            near = unit["n"].between(m * threshold / (2 - threshold) - 1e-9, m * (2 - threshold) / threshold + 1e-9)
            both = F.when(near, F.size(F.array_intersect(unit["grams"], _literal(template)))).otherwise(0)
            rows.append(hit(F.lit(t), F.lit(names[t]), both, unit["n"], F.lit(m)))
        return F.filter(F.array(*rows), lambda r: r["order"] <= -threshold)

    def windows(mark: Column) -> Column:
        return F.transform(F.filter(entries, lambda e: e["w"] == mark["w"]), lambda e: F.struct(e["t"].alias("t"), F.slice("words", F.greatest(mark["i"] - e["o"] + 1, F.lit(1)), e["m"]).alias("words")))

    def judge(window: Column) -> Column:
        template = F.element_at(F.array(*map(_literal, grams)), window["t"] + 1)
        return hit(window["t"], F.element_at(F.array(*map(F.lit, names)), window["t"] + 1), F.size(F.array_intersect(window["grams"], template)), F.size(window["grams"]), F.size(template))

    cut = F.transform(F.flatten(F.transform(marked, windows)), lambda w: F.struct(w["t"].alias("t"), _bigrams(w["words"]).alias("grams")))
    judged = F.filter(F.transform(cut, judge), lambda r: r["order"] <= -threshold)
    empty = F.array().cast("array<struct<order:double,license:string,t:int>>")
    hits = found.select("doc_id", "words", shared.alias("units"))
    hits = hits.select("doc_id", F.concat(F.when(F.size("units") > 0, F.flatten(F.transform("units", compare))).otherwise(empty), F.when(F.size("words") > 0, judged).otherwise(empty)).alias("hits"))
    best = F.array_min("hits")
    return hits.select(
        "doc_id",
        best["license"].alias("license"),
        (-best["order"]).alias("dice"),
        F.size(F.array_distinct(F.transform("hits", lambda h: h["t"]))).cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["license"]))), ",").alias("licenses"),
    )
