"""Operator 8: licence scan by Dice coefficient over word bigrams.

Every line of a document, and the document as a whole, is normalised (lower
case, runs of other characters than letters and digits become one blank) and
compared with the licence templates by the Dice coefficient of their sets of
word bigrams: 2 |A and B| / (|A| + |B|). Sizes alone bound the coefficient, so
a unit is compared only with templates of which 2 min(|A|, |B|) / (|A| + |B|)
can reach the threshold, and units too small or too large for every template
are left out before anything is compared.

A notice that wraps over lines, or stands within a longer line, fills neither
unit. With ``windows`` runs of consecutive words are compared too, across lines:
those that begin and end with a bigram of the template and whose number of
bigrams can reach the threshold. A window of coefficient c has at least
c / (2 - c) of the template's bigrams, so only documents with so many are
looked at closely.

DataFrame functions only; no shuffle, each document is scanned where it lies.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kassa.llm.common import whole

LEAST = 0.8
# --- fixed values: licence templates (id, text) --------------------------------
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                 "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                 "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
                 "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
                 "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
]


def normalised(text: Column) -> Column:
    """Lower case, other characters than letters, digits and line feeds as one blank."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")


def bigrams(words: Column) -> Column:
    """Distinct pairs of adjacent words."""
    n = F.size(words)
    pairs = F.zip_with(F.slice(words, 1, F.greatest(n - 1, F.lit(0))), F.slice(words, 2, F.greatest(n - 1, F.lit(0))),
                       lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(pairs)


def template_bigrams(text: str) -> list[str]:
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def let(value: Column, use) -> Column:
    """``use(value)`` with the value reckoned once for each row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def dice_of(grams: Column, template: list[str], of: Column) -> Column:
    return F.lit(2.0) * F.size(F.array_intersect(grams, of)) / (F.size(grams) + len(template))


def placed_bigrams(raw: Column) -> Column:
    """Every pair of adjacent words of the document, with the lines of both."""
    words = F.flatten(F.transform(raw, lambda x, i: F.transform(F.filter(F.split(normalised(x), " "), lambda w: w != ""),
                                                                lambda w: F.struct(w.alias("w"), (i + 1).alias("line")))))
    n = lambda w: F.greatest(F.size(w) - 1, F.lit(0))
    return let(words, lambda w: F.zip_with(F.slice(w, 1, n(w)), F.slice(w, 2, n(w)), lambda a, b: F.struct(
        F.concat(a["w"], F.lit(" "), b["w"]).alias("gram"), a["line"].alias("first"), b["line"].alias("last"))))


def window_hits(raw: Column, pairs: Column, name: str, template: list[str], least: float) -> Column:
    """The template's windows of a document, of overlapping ones the best (then the first, then the shortest).

    None that shares a line with one that reaches the threshold by itself, and
    none where the whole document does.
    """
    t, of = len(template), F.array(*map(F.lit, template))
    low, high = math.ceil(round(least / (2 - least) * t, 9)), math.floor(round((2 - least) / least * t, 9))

    def scored(p: Column, s: Column, e: Column) -> Column:
        grams = F.array_distinct(F.transform(F.slice(p, s, e - s + 1), lambda x: x["gram"]))
        return let(grams, lambda g: F.struct((-dice_of(g, template, of)).alias("low"), s.alias("s"), e.alias("e"),
                                             F.element_at(p, s)["first"].alias("first"), F.element_at(p, e)["last"].alias("last")))

    def found(p: Column) -> Column:
        own = F.filter(F.transform(p, lambda x, i: F.when(x["match"], i + 1)), lambda i: i.isNotNull())
        ends = lambda s: F.filter(F.sequence(s + (low - 1), F.greatest(F.least(s + (high - 1), F.size(p)), s + (low - 1))),
                                  lambda e: (e <= F.size(p)) & F.element_at(p, F.least(e, F.size(p)))["match"])
        every = F.flatten(F.transform(own, lambda s: F.transform(ends(s), lambda e: scored(p, s, e))))
        return F.filter(every, lambda x: x["low"] <= -least)

    def units(lines: Column) -> Column:
        """Lines that are hits by themselves; 0 is the whole."""
        return F.filter(F.transform(lines, lambda x, i: F.when(let(bigrams(F.split(F.trim(normalised(x)), " +")), lambda g: dice_of(g, template, of)) >= least, i)),
                        lambda i: i.isNotNull())

    whole_and_lines = F.concat(F.array(F.array_join(raw, " ")), raw)
    matched = F.transform(pairs, lambda x: x.withField("match", F.array_contains(of, x["gram"])))
    free = let(units(whole_and_lines), lambda u: F.filter(let(matched, found), lambda x: ~F.exists(u, lambda i: (i == 0) | i.between(x["first"], x["last"]))))
    best = let(F.array_sort(free), lambda c: F.aggregate(c, F.slice(c, 1, 0), lambda acc, x: F.when(
        F.exists(acc, lambda y: (y["s"] <= x["e"]) & (x["s"] <= y["e"])), acc).otherwise(F.concat(acc, F.array(x)))))
    return F.transform(best, lambda x: F.struct(x["first"].alias("line"), F.lit(name).alias("license"), (-x["low"]).alias("dice"),
                                                F.array_join(F.slice(raw, x["first"], x["last"] - x["first"] + 1), "\n").alias("text")))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, least: float = LEAST,
                  windows: bool = False) -> DataFrame:
    """One row for each unit and template whose Dice coefficient is at least ``least``.

    Columns ``doc_id, line`` (from 1; 0 is the whole document, compared when it
    has several lines), ``license, dice, text`` (the line as it stands; null for
    the document). Null and empty texts have no units. Equal coefficients all
    return a row, and so does every repeated document row. Templates of fewer
    than two words match nothing. With ``windows`` a notice inside a line, or
    over several, is a row as well: ``line`` is the one in which it begins,
    ``text`` all lines that it touches.
    """
    grams = {name: g for name, text in templates if (g := template_bigrams(text))}
    if not grams:
        grams = {"": ["\n"]}
    sizes = [len(g) for g in grams.values()]
    low, high = least / (2 - least) * min(sizes), (2 - least) / least * max(sizes)
    lines = docs.select(F.col(id_col).alias("doc_id"), F.split(whole(text_col), "\n", -1).alias("raw"),
                        F.split(normalised(whole(text_col)), "\n", -1).alias("clean"))
    # a unit takes its own text along, so that no row made of it carries the document
    units = F.transform("clean", lambda x, i: F.struct((i + 1).alias("line"), x.alias("unit"), F.element_at("raw", i + 1).alias("text")))
    both = F.struct(F.lit(0).alias("line"), F.array_join("clean", " ").alias("unit"), F.lit(None).cast("string").alias("text"))
    units = F.when(F.size("clean") > 1, F.concat(F.array(both), units)).otherwise(units)
    # the number of words bounds the number of bigrams: too short for every template goes before anything else
    units = F.filter(F.transform(units, lambda u: F.struct(u["line"].alias("line"), F.split(F.trim(u["unit"]), " +").alias("words"), u["text"].alias("text"))),
                     lambda u: F.size(u["words"]) - 1 >= low)
    # the unit that is the whole document also stands for its windows
    pool = F.array(*map(F.lit, sorted({x for g in grams.values() for x in g})))

    def wide(line: Column, g: Column) -> Column:
        return ((line == 0) | (F.size("clean") == 1)) & (F.size(F.array_intersect(g, pool)) >= low) if windows else F.lit(False)

    units = F.transform(units, lambda u: let(bigrams(u["words"]), lambda g: F.struct(
        u["line"].alias("line"), g.alias("grams"), F.size(g).alias("n"), wide(u["line"], g).alias("wide"), u["text"].alias("text"))))
    units = F.filter(units, lambda u: u["n"].between(low, high) | u["wide"])
    # of a document's units one at most is wide and needs all lines
    units = F.transform(units, lambda u: u.withField("raw", F.when(u["wide"], F.col("raw"))))
    one = lines.select("doc_id", F.explode(units).alias("u")).select("doc_id", "u.*")
    scores = [F.when(F.lit(2.0) * F.least("n", F.lit(len(g))) >= least * (F.col("n") + len(g)),
                     F.struct(F.lit(name).alias("license"),
                              (F.lit(2.0) * F.size(F.array_intersect("grams", F.array(*map(F.lit, g)))) / (F.col("n") + len(g))).alias("dice")))
              for name, g in grams.items()]
    text = F.col("text")
    hits = F.transform(F.filter(F.array(*scores), lambda s: s["dice"] >= least),
                       lambda s: F.struct(F.col("line").alias("line"), s["license"].alias("license"), s["dice"].alias("dice"), text.alias("text")))
    if windows:
        none = F.slice(hits, 1, 0)
        inside = let(placed_bigrams(F.col("raw")), lambda p: F.flatten(F.array(*[
            F.when(F.size(F.array_intersect("grams", F.array(*map(F.lit, g)))) >= least / (2 - least) * len(g) - 1e-9, window_hits(F.col("raw"), p, name, g, least)).otherwise(none)
            for name, g in grams.items()])))
        hits = F.when(F.col("wide"), F.concat(hits, inside)).otherwise(hits)
    return one.select("doc_id", F.explode(hits).alias("hit")).select("doc_id", "hit.line", "hit.license", "hit.dice", "hit.text")
