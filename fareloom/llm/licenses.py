"""Licence notices by Dice coefficient over word bigrams, from DataFrame functions only.

A text is compared stretch by stretch: each of its lines, the whole text where it has several, and
runs of words that need not follow its lines. Stretches and templates are normalised alike (case and
punctuation) and become sets of word bigrams. With threshold t, sizes a and b can only reach t if
t * (a + b) <= 2 * min(a, b); stretches too short or too long for every template are dropped before
their bigrams are made, and templates whose size does not fit before they are compared.

A run can only reach t if it holds t / (2 - t) of a template's bigrams. Most texts do not, and are
done with after one look at each word pair; the others are searched, per template, from every place
of one of its bigrams. Of runs that overlap only the nearest to its template counts.
"""

from __future__ import annotations

import math
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# The wording of common licence notices and short licences.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR "
        "A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
        "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING "
        "FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, or "
        "(at your option) any later version.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

# Up to so many bigrams of a template, runs start at every place of one; in longer templates places
# nearer to each other than this part of the template are merged, which moves a start by less.
MERGED_FROM = 256
MERGED_PART = 128


def full_texts() -> dict[str, list[str]]:
    """The whole licences, from the package's own folder. Read on the driver."""
    folder = Path(__file__).parent / "license_texts"
    return {f.name.removesuffix(".txt"): [f.read_text("utf-8")] for f in sorted(folder.glob("*.txt"))}


def normalised_words(text: str) -> list[str]:
    """Lower-case ASCII letters and digits; everything else separates words."""
    import re

    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return [w for w in re.split("[^a-z0-9\u0080-\U0010ffff]+", lowered) if w]


def template_bigrams(templates: dict[str, list[str]] = TEMPLATES) -> list[tuple[str, int, list[str]]]:
    """(licence, number, distinct bigrams) of each template, in order of name."""
    out = []
    for name in sorted(templates):
        for k, text in enumerate(templates[name]):
            w = normalised_words(text)
            out.append((name, k, list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:])))))
    return out


def _words(stretch: Column) -> Column:
    lowered = F.translate(stretch, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lowered, "[^a-z0-9\\x{80}-\\x{10FFFF}]+"), lambda w: w != "")


def _all_bigrams(words: Column) -> Column:
    pairs = F.zip_with(
        words, F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b)
    )
    return F.filter(pairs, lambda p: p.isNotNull())


def _bigrams(words: Column) -> Column:
    return F.array_distinct(_all_bigrams(words))


def _among(name: str, grams: list[str]) -> str:
    # Bigrams are letters, digits and a blank: nothing to escape. A long list becomes a hash set.
    return f"{name} IN ({', '.join(repr(g) for g in grams)})"


def _least_common(size: int, threshold: float) -> int:
    """Bigrams that any stretch has to share with a template of that size."""
    return math.ceil(size * threshold / (2 - threshold) - 1e-9)


def _runs(number: int, name: str, words: int, own: list[str], threshold: float) -> str:
    """SQL: the best run from every start, as structs (minus, name, s, e), for one template.

    A bigram counts at its first place in the run, that is where the place before it (p) lies ahead
    of the start. A best run ends on a bigram of the template; one that did not would gain by ending
    earlier.
    """
    b = len(own)
    need = _least_common(b, threshold)
    longest = int(max(words - 1, b) * (2 - threshold) / threshold)
    step = 1 if b <= MERGED_FROM else b // MERGED_PART
    fresh = "IF(x.p < s, 1, 0)"
    dice = f"2.0D * (y.c + {fresh}) / (y.a + {fresh} + {b})"
    better = f"x.h AND x.p < s AND {dice} > y.b"
    return f"""
    IF(array_contains(_near, {number}),
      flatten(transform(
        array(transform(_grams, (g, i) -> named_struct('p', _before[i], 'h', {_among("g", own)}, 'i', i))),
        z -> flatten(transform(array(transform(filter(z, x -> x.h), x -> x.i)), hits -> filter(transform(
          filter(hits, (s, j) -> (s % {step} = 0 OR j = 0 OR hits[greatest(j - 1, 0)] < s - 1)
            AND j + {need} <= size(hits) AND hits[least(j + {need}, size(hits)) - 1] - s < {longest}),
          s -> transform(array(aggregate(
            slice(z, s + 1, {longest}),
            named_struct('i', 0, 'a', 0, 'c', 0, 'b', 0.0D, 'n', 0),
            (y, x) -> named_struct(
              'i', y.i + 1,
              'a', y.a + {fresh},
              'c', y.c + IF(x.h, {fresh}, 0),
              'b', IF({better}, {dice}, y.b),
              'n', IF({better}, y.i + 1, y.n)))),
            y -> named_struct('minus', -y.b, 'name', '{name}', 's', s, 'e', s + y.n))[0]),
          w -> w.minus <= -{threshold}D))))),
      CAST(array() AS array<struct<minus: double, name: string, s: int, e: int>>))"""


def _with_runs(grams: DataFrame, known: list[tuple[str, int, int, list[str]]], threshold: float) -> DataFrame:
    """Adds `runs`, the best runs that do not overlap, to rows with `_grams`, all bigrams in order."""
    every = list(dict.fromkeys(g for *_, own in known for g in own))
    shared = grams.withColumn("_shared", F.expr(f"array_distinct(filter(_grams, g -> {_among('g', every)}))"))
    reach = []
    for number, (_, _, _, own) in enumerate(known):
        need = _least_common(len(own), threshold)
        reach.append(
            f"IF(size(_shared) >= {need} AND size(filter(_shared, g -> {_among('g', own)})) >= {need}, {number}, NULL)"
        )
    near = shared.withColumn("_near", F.expr(f"filter(array({', '.join(reach)}), k -> k IS NOT NULL)"))
    # Each bigram's last place before this one, or -1: neighbours in the order of (bigram, place).
    before = near.withColumn("_before", F.expr("""
      IF(size(_near) = 0, CAST(array() AS array<int>),
        transform(array(sort_array(transform(_grams, (g, i) -> named_struct('g', g, 'i', i)))), o ->
          transform(sort_array(transform(o, (x, k) -> named_struct('i', x.i, 'p',
            IF(k > 0 AND o[greatest(k - 1, 0)].g = x.g, o[greatest(k - 1, 0)].i, -1)))), x -> x.p))[0])"""))
    each = [_runs(k, name, words, own, threshold) for k, (name, _, words, own) in enumerate(known)]
    found = before.withColumn("_found", F.expr(f"IF(size(_near) = 0, NULL, array_sort(flatten(array({', '.join(each)}))))"))
    return found.withColumn("runs", F.expr("""
      IF(_found IS NULL, CAST(array() AS array<struct<minus: double, name: string, s: int, e: int>>),
        aggregate(_found, slice(_found, 1, 0),
          (kept, w) -> IF(exists(kept, v -> v.s < w.e AND w.s < v.e), kept, concat(kept, array(w)))))"""))


def license_scan(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    templates: dict[str, list[str]] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
    whole_licenses: dict[str, list[str]] | None = None,
) -> DataFrame:
    """doc_id, license, score and n_licenses of every row.

    `license` is the licence of the best stretch (the first by name among equals) with its Dice
    coefficient `score`; n_licenses counts the different licences of all stretches, each taken for its
    nearest template if that reaches `threshold`.
    `whole_licenses` (by default those in `license_texts`) are looked for as runs of words only.
    Rows without one have null, null and 0: among them null, empty and blank texts. Repeated rows
    and null ids are kept as they are; an empty table stays empty. No shuffle, nothing but the row.
    """
    known = [t for t in template_bigrams(templates) if t[2]]
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    fewest = min(int(-(-len(g) * low // 1)) for _, _, g in known)
    most = max(int(len(g) * high) for _, _, g in known)

    # A bigram takes at least three characters and a set has no more bigrams than the text has words,
    # so a line too short for any template is dropped by its length, one too long only by its words.
    lines = F.split(F.coalesce(F.col("_text"), F.lit("")), "\r\n|\r|\n")
    whole = F.when(F.size(lines) > 1, F.array(F.col("_text"))).otherwise(F.array().cast("array<string>"))
    long_enough = F.filter(F.concat(lines, whole), lambda s: F.length(s) >= 2 * fewest + 1)
    worded = F.filter(F.transform(long_enough, _words), lambda w: F.size(w) > fewest)
    sets = F.filter(
        F.transform(worded, _bigrams), lambda g: (F.size(g) >= fewest) & (F.size(g) <= most)
    )

    def best_of(grams: Column) -> Column:
        each = []
        for name, _, own in known:
            a, b = F.size(grams), len(own)
            possible = F.least(a, F.lit(b)) * 2.0 >= F.lit(threshold) * (a + b)
            common = F.size(F.array_intersect(grams, F.array(*[F.lit(g) for g in own])))
            dice = common * 2.0 / (a + b)
            each.append(F.when(possible & (dice >= threshold), F.struct((-dice).alias("minus"), F.lit(name).alias("name"))))
        return F.array_min(F.array(*each))  # of all templates, the nearest counts

    hits = F.filter(F.transform(sets, best_of), lambda s: s.isNotNull())
    texts = full_texts() if whole_licenses is None else whole_licenses
    sized = []
    for group in (templates, texts):
        for name, k, own in template_bigrams(group):
            if own:
                sized.append((name, k, len(normalised_words(group[name][k])), own))
    grams = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("_text"),
        _all_bigrams(_words(F.coalesce(F.col(text_col), F.lit("")))).alias("_grams"),
    )
    # Lines, the whole text and runs are all stretches of the row. A row near no template has no hit in any.
    none = F.array().cast("array<struct<minus: double, name: string>>")
    by_line = F.when(F.size("_near") > 0, hits).otherwise(none)
    runs = F.transform("runs", lambda r: F.struct(r["minus"].alias("minus"), r["name"].alias("name")))
    found = _with_runs(grams, sized, threshold).select("doc_id", F.concat(by_line, runs).alias("hits"))
    best = F.array_min("hits")
    return found.select(
        "doc_id",
        best["name"].alias("license"),
        (-best["minus"]).alias("score"),
        F.size(F.array_distinct(F.transform("hits", lambda h: h["name"]))).cast("long").alias("n_licenses"),
    )
