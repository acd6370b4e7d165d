"""License scan: normalised text against license templates by the Dice coefficient over word bigrams, in one projection.

A unit (the whole text, one of its lines, or a stretch of its words) is lower-cased, other signs than letters and digits become spaces, and its distinct
word bigrams B are compared with a template's bigrams T: Dice = 2 |B and T| / (|B| + |T|).  A Dice of d or more needs
d / (2 - d) * |T| <= |B| <= (2 - d) / d * |T|, so a template is compared only with units within these bounds, and units too
short for every template are not even split.  Templates are literals of the plan, so nothing is joined or shuffled.

A match holds at least d / (2 - d) * |T| of T, so of any more than the other bigrams of T it holds one: a text without
any of these few of each template, which one pattern tells, has no match and is not looked at further.

Stretches find a notice inside a line, over several lines, and a whole license text by a passage of it that no other
license has.  They begin and end with bigrams of T, since others at the ends only lower the coefficient, and have 1.5 |T|
bigrams at most.  Of stretches that share a word the best counts, and none where a line that it touches, or the whole text,
is a unit that matches the same template.  A stretch has the line that it begins in.

Null and blank texts have no license.  Ties go to the template that comes first, then to the earlier line.  Every row is
judged alone.  Columns of ``docs`` named like a result are replaced.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rules import STOP_WORDS, let

DICE = 0.8
#: Fixed values: (license, permissive, notice).
TEMPLATES = (
    ("Apache-2.0", True, "Licensed under the Apache License, Version 2.0."),
    ("MIT", True, "Released under the MIT License."),
    ("GPL-3.0", False, "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", False, "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", True, "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", False, "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD-3-Clause", True, "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", False, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC0-1.0", True, "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)

#: Passages of the license texts themselves; they are looked for as stretches.
TEXTS = (
    ("Apache-2.0", True, "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("MIT", True, 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("GPL-3.0", False, "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("GPL-3.0", False, "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("CC-BY-NC-4.0", False, "You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-4.0", True, "You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-SA-4.0", False, "You accept and agree to be bound by the terms and conditions of this Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("BSD-3-Clause", True, "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("MPL-2.0", False, 'Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software.'),
    ("CC0-1.0", True, "Creative Commons Legal Code CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES"),
)
#: A notice that grants nothing, but that permissive licenses carry too: it comes after all others, and says that a text is not
#: permissive only where nothing else is found.
RESERVED = ("proprietary", None, "All rights reserved.")


@dataclass(frozen=True)
class Template:
    name: str
    permissive: bool | None  # None: of no consequence beside another license
    bigrams: tuple[str, ...]

    @classmethod
    def of(cls, name: str, permissive: bool | None, notice: str) -> Template:
        words = re.sub("[^a-z0-9]+", " ", notice.lower()).split()
        return cls(name, permissive, tuple(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:]))))

    def sizes(self, dice: float) -> tuple[float, float]:
        """Least and most bigrams of a unit that can reach the coefficient."""
        return dice / (2 - dice) * len(self.bigrams), (2 - dice) / dice * len(self.bigrams)

    def least(self, dice: float) -> int:
        """Bigrams that a unit must share to reach the coefficient."""
        return max(1, math.ceil(self.sizes(dice)[0] - 1e-9))

    def telling(self, dice: float) -> list[str]:
        """Bigrams of which every match has one, the rarer ones as far as their words tell."""
        rare = sorted(self.bigrams, key=lambda x: (sum(w in STOP_WORDS for w in x.split()), -len(x)))
        return rare[:len(rare) - self.least(dice) + 1]


def _words(unit: Column) -> Column:
    return F.split(F.btrim(F.regexp_replace(F.lower(unit), "[^a-z0-9]+", " ")), " ")


def _best(unit: Column, place: Column, templates: Sequence[tuple[int, Template]], dice: float) -> Column:
    """The unit's best match: (dice, -template, -place, template), or null."""
    def match(bigrams: Column) -> Column:
        n = F.size(bigrams)
        found = []
        for number, t in templates:
            low, high = t.sizes(dice)
            value = 2.0 * F.size(F.array_intersect(bigrams, F.array(*map(F.lit, t.bigrams)))) / (n + len(t.bigrams))
            found.append(F.when((n >= low) & (n <= high), F.struct(
                value.alias("dice"), F.lit(-number).alias("template"), (-place).alias("place"))))
        return F.array_max(F.filter(F.array(*found), lambda x: x.isNotNull() & (x.dice >= dice)))

    # two or more words, else there is no bigram
    bigrams = let(_words(unit), lambda w: F.array_distinct(F.transform(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: F.concat(x, F.lit(" "), F.get(w, i + 1)))))
    return let(bigrams, match)


def _telling(text: Column, templates: Sequence[Template], dice: float) -> Column:
    """Whether the text has one of the bigrams without which no template matches."""
    after = defaultdict(dict)
    for x in (x for t in templates for x in t.telling(dice)):
        first, second = x.split()
        after[first][second] = None
    some = "|".join(f"{first}[^a-z0-9]+(?:{'|'.join(seconds)})" for first, seconds in after.items())
    return F.lower(text).rlike(f"(?<![a-z0-9])(?:{some})(?![a-z0-9])")


def _stretches(text: Column, units: Column, templates: Sequence[Template], dice: float) -> Column:
    """Matches of stretches of words that the matches of ``units`` leave: (dice, -template, -place) each."""
    known = F.array(*(F.struct(
        F.lit(-i).alias("template"), F.lit(len(t.bigrams)).alias("size"), F.lit(t.least(dice)).alias("least"), F.lit(int(t.sizes(dice)[1] + 1e-9)).alias("most"),
        F.array(*map(F.lit, t.bigrams)).alias("bigrams")) for i, t in enumerate(templates) if t.bigrams))
    every = {x for t in templates for x in t.bigrams}

    def bigrams(w: Column) -> Column:
        return F.transform(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: F.struct(
            F.concat(x.word, F.lit(" "), F.get(w, i + 1).word).alias("bigram"), i.alias("i"), x.line.alias("line"), F.get(w, i + 1).line.alias("last")))

    def from_hit(t: Column, first: Column, window: Column, names: Column) -> Column:
        """The best stretch that begins with the hit ``first``; ``window`` has the hits that it may end with."""
        def upto(end: Column, k: Column) -> Column:
            common = F.size(F.array_distinct(F.transform(F.slice(window, 1, k + t.least), lambda x: x.bigram)))
            n = F.size(F.array_distinct(F.slice(names, first.i + 1, end.i - first.i + 1)))
            return F.struct((2.0 * common / (n + t.size)).alias("dice"), t.template.alias("template"), (-first.line).alias("place"),
                            (first.i - end.i).alias("width"), first.i.alias("start"), end.i.alias("end"), end.last.alias("last"))

        return F.when(F.size(window) >= t.least, F.array_max(F.transform(F.slice(window, t.least, t.most), upto)))

    def of_template(t: Column, hits: Column, names: Column) -> Column:
        return F.transform(hits, lambda first, j: let(
            F.filter(F.slice(hits, j + 1, t.most), lambda x: x.i < first.i + t.most), lambda window: from_hit(t, first, window, names)))

    def apart(found: Column) -> Column:
        return F.aggregate(found, F.filter(found, lambda x: F.lit(False)), lambda kept, x: F.when(
            F.exists(kept, lambda y: (y.start <= x.end + 1) & (x.start <= y.end + 1)), kept).otherwise(F.concat(kept, F.array(x))))

    words = F.flatten(F.transform(F.split(text, "\n"), lambda x, i: F.transform(
        F.filter(_words(x), lambda w: w != ""), lambda w: F.struct(w.alias("word"), (i + 1).alias("line")))))
    found = let(let(words, bigrams), lambda b: let(F.transform(b, lambda x: x.bigram), lambda names: let(
        F.filter(b, lambda x: x.bigram.isin(*sorted(every))), lambda hits: F.flatten(F.transform(known, lambda t: let(
            F.filter(hits, lambda x: F.array_contains(t.bigrams, x.bigram)), lambda mine: of_template(t, mine, names)))))))
    found = F.sort_array(F.filter(found, lambda x: x.isNotNull() & (x.dice >= dice)), asc=False)
    left = F.filter(let(found, apart), lambda x: ~F.exists(units, lambda y: (y.template == x.template) & (
        (y.place == 0) | (-y.place).between(-x.place, x.last))))
    return F.transform(left, lambda x: F.struct(x.dice.alias("dice"), x.template.alias("template"), x.place.alias("place")))


def scan_licenses(docs: DataFrame, templates: Sequence[tuple[str, bool | None, str]] = (*TEMPLATES, RESERVED), dice: float = DICE,
                  texts: Sequence[tuple[str, bool | None, str]] = TEXTS) -> DataFrame:
    """``docs`` with license (the best one's name), dice, license_line (0: the whole text, else a line from 1), n_licenses (units
    that match a template) and permissive (null without license, false if any unit matches a license that is not, or if only
    notices without consequence match).

    ``templates`` are compared with all units, ``texts`` with stretches only.  Ties go to templates, then texts, then what is without
    consequence."""
    mine = ("license", "dice", "license_line", "n_licenses", "permissive")
    every = sorted([(t, True) for t in templates] + [(t, False) for t in texts], key=lambda x: x[0][1] is None)
    known = [Template.of(*t) for t, _ in every]
    lined = [(i, known[i]) for i, (_, is_lined) in enumerate(every) if is_lined]
    least = min(t.sizes(dice)[0] for _, t in lined)
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(x.alias("unit"), (i + 1).alias("place")))
    whole = F.when(F.instr(text, "\n") > 0, F.array(F.struct(text.alias("unit"), F.lit(0).alias("place")))).otherwise(F.array())
    # n bigrams need n + 1 words, and so 2 * n + 1 characters
    units = F.filter(F.concat(whole, lines), lambda x: F.length(x.unit) >= 2 * least + 1)
    found = F.filter(F.transform(units, lambda x: _best(x.unit, x.place, lined, dice)), lambda x: x.isNotNull())
    found = let(found, lambda x: F.concat(x, _stretches(text, x, known, dice)))
    none = F.array().cast("array<struct<dice:double,template:int,place:int>>")
    found = F.when(_telling(text, known, dice), found).otherwise(none)
    names = F.array(*(F.lit(t.name) for t in known))
    strict, free = ([F.lit(-i) for i, t in enumerate(known) if t.permissive is kind] for kind in (False, True))
    rows = docs.drop(*mine).withColumn("_found", found).withColumn("_best", F.array_max("_found"))
    return rows.withColumns({
        "license": F.get(names, -F.col("_best.template")), "dice": F.col("_best.dice"), "license_line": -F.col("_best.place"),
        "n_licenses": F.size("_found"),
        "permissive": F.when(F.col("_best").isNotNull(), F.exists("_found", lambda x: x.template.isin(*free)) & ~F.exists("_found", lambda x: x.template.isin(*strict))),
    }).select(*(c for c in docs.columns if c not in mine), *mine)
