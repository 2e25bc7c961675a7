"""Licence scans: normalised text against licence templates by Dice coefficient over word bigrams.

A document is compared run by run: lines are cut at the ends of sentences, and every run of
consecutive cuts is a segment, from one sentence over lines and paragraphs to the whole, all
in column expressions of its own row. A template is searched for only in a document that has
enough of its bigrams for the threshold, there only in runs whose number of bigrams lies
within the template's bounds, and of these only in those with enough of its bigrams close
together.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guichet.llm.store import carried, restored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Public licence notices, as (SPDX identifier, text).
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
        "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
        "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
        "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor "
        "the names of its contributors may be used to endorse or promote products derived from this software without specific prior written "
        "permission. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
        "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
        "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
        "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS "
        "ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
        "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA "
        "OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must "
        "not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly "
        "marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any "
        "source distribution.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "EUPL-1.2",
        "Licensed under the EUPL, Version 1.2 or - as soon they will be approved by the European Commission - subsequent versions of the EUPL "
        "(the \"Licence\"); You may not use this work except in compliance with the Licence.",
    ),
)


def normalised_words(text: str) -> list[str]:
    return "".join(c if c in LOWER or c.isascii() and c.isdigit() else " " for c in text.translate(str.maketrans(UPPER, LOWER))).split()


def _bound(name: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(name), use)[0]


def _words(text: Column) -> Column:
    """Normalised words; those that begin a segment's unit, a line or what follows the end of a sentence, carry a line end in front."""
    cut = F.regexp_replace(F.translate(text, UPPER, LOWER), "[.!?;:]+[ \t\r]", "\n")
    units = F.regexp_replace(F.regexp_replace(cut, "[^a-z0-9\n]+", " "), " ?\n[ \n]*", " \n")
    return F.filter(F.split(F.concat(F.lit("\n"), F.ltrim(units, F.lit(" \n"))), " "), lambda w: (w != "") & (w != "\n"))


def _bigrams(words: Column) -> Column:
    """The hash of each word and the next."""
    plain = F.transform(words, lambda w: F.ltrim(w, F.lit("\n")))
    none = F.array().cast("array<bigint>")
    return _bound(plain, lambda w: F.when(F.size(w) > 1, F.zip_with(F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w) - 1), lambda a, b: F.xxhash64(a, b))).otherwise(none))


def bounds(text: str, threshold: float) -> tuple[list[tuple[str, str]], int, int]:
    """A template's different bigrams, and the least and largest number of bigrams of a run that is compared with it.

    No run with fewer reaches the threshold. One with more would have to repeat its bigrams
    more often than the template does.
    """
    words = normalised_words(text)
    pairs = list(zip(words, words[1:], strict=False))
    different = sorted(set(pairs))
    return different, math.ceil(threshold / (2 - threshold) * len(different) - 1e-9), math.floor((2 - threshold) / threshold * len(pairs) + 1e-9)


def _hashes(pairs: list[tuple[str, str]]) -> Column:
    return F.expr("array(" + ", ".join(f"xxhash64('{a}', '{b}')" for a, b in pairs) + ")")


def _best(template: Column, grams: Column, starts: Column, ends: Column, threshold: float) -> Column:
    """(dice, first word, number of words) of the best run for a template; null if none reaches the threshold.

    Positions count from 0. ``starts`` holds the first words of all units, ``ends`` the words behind their last ones.
    """
    least, most = template["least"], template["most"]
    hits = F.filter(F.transform(grams, lambda g, k: F.when(F.array_contains(template["grams"], g), k)), lambda k: k.isNotNull())

    def dense(at: Column) -> Column:
        # The first of ``least`` hits that fit into one run.
        n = F.greatest(F.size(at) - least + 1, F.lit(0))
        return F.filter(F.transform(F.slice(at, F.lit(1), n), lambda k, i: F.when(F.get(at, i + least - 1) - k < most, k)), lambda k: k.isNotNull())

    def score(start: Column, end: Column) -> Column:
        run = F.array_distinct(F.slice(grams, start + 1, end - start - 1))
        both = F.size(F.array_intersect(run, template["grams"]))
        return F.struct((2.0 * both / (F.size(run) + template["n"])).alias("dice"), (-start).alias("from"), (end - start).alias("words"))

    def of_start(start: Column) -> Column:
        fits = F.filter(ends, lambda end: (end - start - 1 >= least) & (end - start - 1 <= most))
        return F.transform(fits, lambda end: score(start, end))

    def of_dense(first: Column) -> Column:
        some = F.filter(starts, lambda s: F.exists(first, lambda k: (s <= k) & (k < s + most)))
        return F.array_max(F.flatten(F.transform(some, of_start)))

    best = _bound(_bound(hits, dense), of_dense)
    return F.get(F.filter(F.array(best), lambda b: b["dice"] >= threshold), F.lit(0))


def matches(text: Column, *, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = 0.8) -> Column:
    """Array of (dice, template, licence, first, words): the best run for every template that reaches the threshold.

    A run is a number of consecutive lines or sentences whose bigrams are at least as many
    as the threshold asks for, and at most as many times the template's as it allows. first
    and words say which words of the normalised text it has; of equal runs it is the first
    one, the longest there. template counts from 0 in the order of ``templates``. Null text
    gives null; empty text and text with fewer than two words give no match.
    """
    known, every = [], set()
    for i, (licence, body) in enumerate(templates):
        pairs, least, most = bounds(body, threshold)
        every.update(pairs)
        known.append(F.struct(F.lit(i).alias("template"), F.lit(licence).alias("licence"), F.lit(len(pairs)).alias("n"), F.lit(least).alias("least"), F.lit(most).alias("most"), _hashes(pairs).alias("grams")))
    known_grams = _hashes(sorted(every))

    def search(words: Column, grams: Column, possible: Column) -> Column:
        starts = F.filter(F.transform(words, lambda w, k: F.when(F.startswith(w, F.lit("\n")), k)), lambda k: k.isNotNull())

        def of_starts(s: Column) -> Column:
            ends = F.concat(F.slice(s, F.lit(2), F.size(s)), F.array(F.size(words)))

            def of_template(t: Column) -> Column:
                b = _best(t, grams, s, ends, threshold)
                return _bound(b, lambda x: F.when(x.isNotNull(), F.struct(x["dice"].alias("dice"), t["template"].alias("template"), t["licence"].alias("licence"), (-x["from"]).alias("first"), x["words"].alias("words"))))

            return F.filter(F.transform(possible, of_template), lambda m: m.isNotNull())

        return _bound(starts, of_starts)

    def of_grams(words: Column, grams: Column) -> Column:
        def of_common(common: Column) -> Column:
            possible = F.filter(F.array(*known), lambda t: F.when(F.size(common) >= t["least"], F.size(F.array_intersect(common, t["grams"])) >= t["least"]).otherwise(False))
            return _bound(possible, lambda p: search(words, grams, p))

        return _bound(F.array_intersect(grams, known_grams), of_common)

    return _bound(_words(text), lambda words: _bound(_bigrams(words), lambda grams: of_grams(words, grams)))


def scan(docs: DataFrame, *, text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """``docs`` with licence, licence_dice (of the best match) and licence_matches (how many templates match somewhere).

    The best match has the highest coefficient; of equals, the first template's. Without a
    match licence and licence_dice are null and licence_matches is 0, as for null and empty
    text. Rows are treated by themselves, repeated ones and an empty table too, and very long
    texts are read whole; columns with these names are replaced.
    """
    made = ("licence", "licence_dice", "licence_matches")
    found = docs.select(carried(docs, *made), F.coalesce(matches(F.col(f"`{text}`"), templates=templates, threshold=threshold), F.array()).alias("_found"))
    best = F.array_max(F.transform("_found", lambda m: F.struct(m["dice"], (-m["template"]).alias("t"), m["licence"].alias("licence"))))
    found = found.withColumn("_best", best)
    return found.select(*restored(docs, *made), F.col("_best.licence").alias("licence"), F.col("_best.dice").alias("licence_dice"), F.size("_found").cast("long").alias("licence_matches"))
