"""Licence scan: Dice coefficient over word bigrams against licence templates.

Units of a document are its whole text, its paragraphs (cut at blank lines), its
lines and its passages: where the two words that open a template stand, as many words as
the template has, across lines, paragraphs and sentences. A passage counts if no other
unit of its document shows its licence; a short one must equal its template. A unit is normalised to lower-case words of letters and digits, and its set of
word bigrams is compared with each template's: 2 |A and B| / (|A| + |B|). For a
threshold t only templates with |B| between |A| t / (2 - t) and |A| (2 - t) / t can
reach it: a unit meets only those. The same bounds limit how many words a unit may
have that no template has, which drops nearly all units before any bigram is built.
A unit's best licence counts (ties: the first name). Everything is one pass of built-in
functions, and a shuffle of the rows found; the templates are literals.

Null and empty texts have no units. Rows with null or repeated ids are scanned like
any other. A unit of one word has no bigrams and matches nothing.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence notices and short licence texts, as published.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
}

#: Smallest Dice coefficient of a match.
THRESHOLD = 0.8
#: A passage of fewer bigrams must have all of its template's: one other word may name another licence or version.
SHORT = 15


def bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a template, as the scan builds them."""
    words = re.findall(r"[^\W_]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def _once(value: Column, then) -> Column:
    """``then(value)`` with the value computed once per row."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _own_bigrams(words: Column) -> Column:
    size = F.greatest(F.size(words) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(words, F.lit(1), size), F.slice(words, F.lit(2), size), lambda x, y: F.concat_ws(" ", x, y)))


def _passages(text: Column, templates: dict[str, list[str]]) -> Column:
    """Runs of words as long as a template, from each place where its first two words stand; ``unit_no`` is the first word."""
    known = sorted({(" ".join(w[:2]), len(w)) for texts in templates.values() for t in texts if len(w := re.findall(r"[^\W_]+", t.lower())) > 1})
    listed = F.array(*[F.struct(F.lit(o).alias("opening"), F.lit(n).alias("n")) for o, n in known])
    openings = sorted({o for o, _ in known})
    opens = "(?iU)" + "|".join(r"\b" + r"[^\p{L}\p{N}]+".join(o.split(" ")) + r"\b" for o in openings)
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def runs(w: Column) -> Column:
        pair = lambda i: F.concat_ws(" ", F.element_at(w, i), F.element_at(w, i + 1))
        at = F.filter(F.sequence(F.lit(1), F.greatest(F.size(w) - 1, F.lit(1))), lambda i: (i < F.size(w)) & F.when(i < F.size(w), pair(i).isin(openings)))
        run = lambda i, t: F.struct(F.lit("passage").alias("unit"), i.alias("unit_no"), F.array_join(F.slice(w, i, t["n"]), " ").alias("part"))
        return F.flatten(F.transform(at, lambda i: F.transform(F.filter(listed, lambda t: t["opening"] == pair(i)), lambda t: run(i, t))))

    return F.when(text.rlike(opens), _once(words, runs)).otherwise(F.array().cast("array<struct<unit:string,unit_no:int,part:string>>"))


def scan(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, unit, unit_no, licence, dice) of every unit of ``docs`` that reaches the threshold.

    ``unit`` is line, paragraph (of several lines), text (of several paragraphs) or passage,
    ``unit_no`` counts from 1 within the document, for a passage by words.
    """
    known = [(name, b) for name, texts in sorted(templates.items()) for b in map(bigrams, texts) if b]
    vocabulary = sorted({w for _, b in known for x in b for w in x.split(" ")})
    most = (2 - threshold) / threshold * (1 + 1e-9)  # a bound met exactly must not fail by rounding
    longest = most * max(len(b) for _, b in known)
    text = F.col("text").cast("string")
    cut = lambda kind, pattern: F.transform(F.split(text, pattern), lambda x, i: F.struct(F.lit(kind).alias("unit"), (i + 1).alias("unit_no"), x.alias("part")))
    lines, paragraphs = cut("line", r"\r\n|\r|\n"), cut("paragraph", r"(?:\r\n|\r|\n)[ \t]*(?:\r\n|\r|\n)\s*")
    # a paragraph of one line is that line, a text of one paragraph that paragraph
    cuts = _once(
        paragraphs,
        lambda all_: F.concat(
            lines,
            F.filter(all_, lambda p: p["part"].rlike("[\r\n]")),
            F.filter(F.array(F.struct(F.lit("text").alias("unit"), F.lit(1).alias("unit_no"), text.alias("part"))), lambda x: F.size(all_) > 1),
            _passages(text, templates),
        ),
    )
    units = docs.where(text.isNotNull()).select(F.struct("doc_id", F.monotonically_increasing_id().alias("row")).alias("doc"), "text")
    units = units.select("doc", F.explode(cuts).alias("u")).select("doc", "u.unit", "u.unit_no", "u.part")
    # At least t / (2 - t) of a matching unit's bigrams are the template's, and it has at most one bigram a word
    # and (2 - t) / t times the longest template's; so other words than the templates' are at most this many.
    words = F.filter(F.split(F.lower("part"), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    strange = lambda w: F.size(F.array_distinct(F.filter(w, lambda x: ~x.isin(vocabulary))))
    may = lambda w: (F.size(w) > 1) & (strange(w) - 1 <= F.least(F.size(w) - 1, F.lit(longest)) * (1 - 1 / most))
    # explode keeps later filters from repeating the split
    units = units.select("doc", "unit", "unit_no", F.explode(F.filter(F.array(words), may)).alias("words"))
    units = units.select("doc", "unit", "unit_no", F.explode(F.array(_own_bigrams(F.col("words")))).alias("own"))
    listed = F.array(*[F.struct(F.lit(name).alias("licence"), F.array(*map(F.lit, b)).alias("b")) for name, b in known])
    fits = lambda t: (F.size("own") >= F.size(t["b"]) / most) & (F.size("own") <= F.size(t["b"]) * most)
    dice = lambda t: F.struct((2.0 * F.size(F.array_intersect("own", t["b"])) / (F.size("own") + F.size(t["b"]))).alias("dice"), t["licence"].alias("licence"))
    top = F.aggregate(
        F.transform(F.filter(listed, fits), dice),
        F.struct(F.lit(-1.0).alias("dice"), F.lit("").alias("licence")),
        lambda a, x: F.when(x["dice"] > a["dice"], x).otherwise(a),
    )
    found = units.select("doc", "unit", "unit_no", F.size("own").alias("size"), F.explode(F.filter(F.array(top), lambda x: x["dice"] >= threshold)).alias("top"))
    found = found.where((F.col("unit") != "passage") | (F.col("size") >= SHORT) | (F.col("top.dice") >= 1))
    found = found.groupBy("doc").agg(F.array_distinct(F.collect_list(F.struct("unit", "unit_no", "top.licence", "top.dice"))).alias("all"))
    passage = lambda x: x["unit"] == "passage"
    better = lambda x, y: (y["unit_no"] == x["unit_no"]) & ((y["dice"] > x["dice"]) | ((y["dice"] == x["dice"]) & (y["licence"] < x["licence"])))
    needless = lambda x: F.exists("all", lambda y: F.when(passage(y), better(x, y)).otherwise(y["licence"] == x["licence"]))
    return found.select("doc.doc_id", F.explode(F.filter("all", lambda x: ~passage(x) | ~needless(x))).alias("u")).select("doc_id", "u.*")
