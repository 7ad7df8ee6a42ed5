"""License scan: Dice coefficient over word bigrams (operator 2).

A text is normalised to its words (lower case, runs of letters and digits), so
line breaks, paragraphs, comment marks and punctuation make no difference.  A
licence template of n words is compared with every run of n consecutive words of
the text (the whole text, if it has fewer): run and template are sets of word
bigrams, and their Dice coefficient is 2 |A and B| / (|A| + |B|).  A template's
hit is its best run, the first of equals, if it reaches ``THRESHOLD``.  A hit that
overlaps a better hit of another licence does not count, so a notice is reported
once, under the licence that fits best.

Pruning, all of it exact:

* anchors: every template has a set of words such that too few of its
  bigrams are without them to reach the threshold.  A text without an
  anchor word matches no template, and most texts contain none at all;
* sizes: a Dice coefficient t needs t/(2-t) of the template's bigrams in common.
  Templates with fewer in the whole text are skipped.  So are the runs that
  begin in a stretch of n words that, with the next stretch, has fewer: a text of
  any length is cut into such stretches, and only runs near a notice are rated.

One expression per document (higher-order functions), no shuffle.

Defined results: null and empty texts have no licence; ties go to the
smaller licence name; every row is judged by itself; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

THRESHOLD = 0.8

# Public licence notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
     except in compliance with the License. You may obtain a copy of the License at
     http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software
     distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
     either express or implied. See the License for the specific language governing permissions and limitations under
     the License."""),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted
     provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
     notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
     above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
     materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its
     contributors may be used to endorse or promote products derived from this software without specific prior written
     permission."""),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0",
     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
     General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
     option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
     WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
     General Public License for more details."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "SPDX-License-Identifier: CC-BY-4.0"),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-SA-4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
     associated documentation files (the "Software"), to deal in the Software without restriction, including without
     limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
     Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
     The above copyright notice and this permission notice shall be included in all copies or substantial portions of
     the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
     LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
     SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
     CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
     IN THE SOFTWARE."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
     MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
)


def plain_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def bigram_set(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def anchors(bigrams: list[str], threshold: float) -> set[str]:
    """Words such that the bigrams without them are too few for the threshold:
    Dice >= t needs at least t/(2-t) of the template's bigrams in common."""
    need = threshold / (2 - threshold) * len(bigrams)
    left, chosen = set(bigrams), set()
    while len(left) >= need:
        counts = Counter(w for b in left for w in set(b.split()))
        # prefer long words, they are rarer in other texts
        word = max(counts, key=lambda w: (min(len(w), 7), counts[w], w))
        chosen.add(word)
        left = {b for b in left if word not in b.split()}
    return chosen


def _bigrams(words: Column) -> Column:
    """The bigrams of a word list, place by place."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _best_run(grams: Column, t: Column, threshold: float) -> Column:
    """(d, name, first, after) of the template's best run; null below the threshold.
    ``d`` is the negative coefficient, so the smallest struct is the best."""
    total = F.size(grams)
    long = F.least(t["places"], total)  # places of a run

    def rated(stretches: Column) -> Column:
        held = lambda k: F.coalesce(F.get(stretches, k), F.lit(0))
        near = F.filter(F.sequence(F.lit(0), F.size(stretches) - 1), lambda k: held(k) + held(k + 1) >= t["need"])
        near = F.filter(near, lambda k: k * long + 1 <= total - long + 1)
        starts = F.flatten(F.transform(near, lambda k: F.sequence(
            k * long + 1, F.least((k + 1) * long, total - long + 1))))

        def rate(at: Column) -> Column:
            run = F.slice(grams, at, long)
            same = F.size(F.array_intersect(run, t["grams"]))
            return F.struct((-(same * 2.0) / (F.size(F.array_distinct(run)) + F.size(t["grams"]))).alias("d"),
                            t["name"].alias("name"), at.alias("first"), (at + long).alias("after"))
        return F.array_min(F.filter(F.transform(starts, rate), lambda h: h["d"] <= -threshold))

    stretches = F.transform(
        F.sequence(F.lit(0), F.call_function("div", total - 1, long).cast("int")),
        lambda k: F.size(F.array_intersect(F.slice(grams, k * long + 1, long), t["grams"])))
    return _let(stretches, rated)


def scan_licenses(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license (best, null if none), dice, licenses (all that count, joined by commas)."""
    packed = [(name, len(w) - 1, bigram_set(w)) for name, w in ((n, plain_words(t)) for n, t in templates) if len(w) > 1]
    words = sorted(set().union(*(anchors(b, threshold) for *_, b in packed)))
    anchored = rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(words)})(?![\p{{L}}\p{{N}}])"
    known = F.array(*[F.struct(
        F.lit(name).alias("name"), F.lit(places).alias("places"),
        F.lit(math.ceil(threshold / (2 - threshold) * len(b) - 1e-9)).alias("need"),
        F.lit(b).alias("grams")) for name, places, b in packed])

    text = F.lower(text_of())
    lists = docs.select("doc_id", F.when(text.rlike(anchored), F.array_remove(
        F.split(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "), " "), "")).alias("_words"))
    grams = lists.select("doc_id", _bigrams(F.col("_words")).alias("_grams"))
    fit = F.filter(known, lambda t: F.size(F.array_intersect("_grams", t["grams"])) >= t["need"])
    hits = grams.select("doc_id", F.when(F.size("_grams") > 0, F.filter(
        F.transform(fit, lambda t: _best_run(F.col("_grams"), t, threshold)), lambda h: h.isNotNull())).alias("_hits"))
    rank = lambda h: F.struct(h["d"], h["name"])
    covered = lambda h, g: ((g["name"] != h["name"]) & (rank(g) < rank(h))
                            & (g["first"] < h["after"]) & (h["first"] < g["after"]))
    counted = hits.select("doc_id", F.filter("_hits", lambda h: ~F.exists("_hits", lambda g: covered(h, g))).alias("_hits"))
    top = F.array_min("_hits")
    return counted.select(
        "doc_id", top["name"].alias("license"), (-top["d"]).alias("dice"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.col("_hits.name"))), ","), F.lit("")).alias("licenses"))
