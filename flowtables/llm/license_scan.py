"""Licence scan by Dice coefficient over word bigrams (operator 7), DataFrame functions only."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.llm.license_texts import LONG_TEMPLATES

THRESHOLD = 80
# Most characters of all templates together; they travel inside the expressions.
MOST_CHARS = 1 << 20
# A place behind every text.
NEVER = (1 << 31) - 1
# Public licence notices, (name, text).
TEMPLATES = [
    ("all-rights-reserved", "All rights reserved"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    (
        "cc-by-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    (
        "cc-by-nc-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies.",
    ),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
        "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
# Frequent words of some language, which make poor anchors.
FREQUENT = set(
    "a all an and any are as at be by can code copy for if in into is it may mit of on or the this to "
    "under with you work".split()
)


def plain_words(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def pairs(words: Sequence[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def anchors(bigrams: Sequence[str], threshold: int = THRESHOLD) -> list[str]:
    """Words of which every text as similar as ``threshold`` to the template holds at least one.

    Such a text shares b * t / (2 - t) of the template's b bigrams or more, so it is enough that the bigrams
    without one of these words are fewer.
    """
    least, left, chosen = len(bigrams) * threshold / (200 - threshold), list(bigrams), []
    while len(left) >= least:
        words = sorted({w for pair in left for w in pair.split()})
        best = max(
            words,
            key=lambda w: (w not in FREQUENT and not w.isdigit(), sum(w in p.split() for p in left)),
        )
        chosen.append(best)
        left = [p for p in left if best not in p.split()]
    return chosen


def normalised(text: Column) -> Column:
    """Words of letters and digits in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out one time."""
    return F.element_at(F.transform(F.array(value), use), 1)


def bigrams(words: Column) -> Column:
    """Word bigrams in order, repeated ones too."""
    return F.transform(
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda w, i: F.concat_ws(" ", F.get(words, i), w),
    )


def linked(part: Column, template: Column) -> Column:
    """Bigrams in order as (at, prev, next, hit): the places of the same bigram before and behind, if any.

    One sort brings equal bigrams together, another one puts them back in order.
    """
    by_pair = F.sort_array(F.transform(part, lambda p, i: F.struct(p.alias("pair"), i.alias("at"))))

    def neighbours(found: Column) -> Column:
        def place(mark: Column, i: Column, step: int, without: int) -> Column:
            other = F.get(found, i + step)
            return F.when(other["pair"] == mark["pair"], other["at"]).otherwise(F.lit(without))

        return F.transform(
            found,
            lambda m, i: F.struct(
                m["at"].alias("at"),
                place(m, i, -1, -1).alias("prev"),
                place(m, i, 1, NEVER).alias("next"),
                F.array_contains(template["pairs"], m["pair"]).alias("hit"),
            ),
        )

    return F.sort_array(once(by_pair, neighbours))


def best_window(said: Column, hits: Column, template: Column) -> Column:
    """Best Dice coefficient of a template and any run of the bigrams ``said``, at most ``reach`` long.

    ``hits`` are the places of the template's bigrams in order; a run that counts holds at least ``need`` of
    them. A bigram of the template at either side of a run never makes it worse, so a best run is as long as
    it may be, or begins behind a place that is no hit. Runs of full length come from one slide over the
    places, the others from these few beginnings, unless the hits from there on cannot beat the best so far.
    """
    reach, need, size = template["reach"], template["need"], template["size"]

    def enough(i: Column, at: Column, wanted: Column) -> Column:
        return F.coalesce(F.get(hits, i + wanted - 1) < at + reach, F.lit(False))

    starts = F.filter(hits, lambda at, i: enough(i, at, need))
    heads = F.filter(
        F.transform(hits, lambda at, i: F.struct(at.alias("at"), i.alias("i"))),
        lambda h: enough(h["i"], h["at"], need)
        & F.coalesce(F.get(hits, h["i"] - 1) < h["at"] - 1, F.lit(True)),
    )
    empty = F.struct(F.lit(0).alias("own"), F.lit(0).alias("shared"), F.lit(0.0).alias("dice"))

    def counted(run: Column, own: Column, shared: Column) -> Column:
        dice = F.greatest(run["dice"], 2.0 * shared / (own + size))
        return F.struct(own.alias("own"), shared.alias("shared"), dice.alias("dice"))

    def slide(marks: Column) -> Column:
        def moved(run: Column, mark: Column) -> Column:
            gone = F.get(marks, mark["at"] - reach)
            left = F.coalesce(gone["next"] >= mark["at"], F.lit(False))
            new = (mark["prev"] < 0) | (mark["prev"] <= mark["at"] - reach)
            return counted(
                run,
                run["own"] + new.cast("int") - left.cast("int"),
                run["shared"] + (new & mark["hit"]).cast("int") - (left & gone["hit"]).cast("int"),
            )

        return F.aggregate(marks, empty, moved, lambda r: r["dice"])

    def run_from(marks: Column, start: Column) -> Column:
        def grown(run: Column, mark: Column) -> Column:
            new = mark["prev"] < start
            return counted(
                run, run["own"] + new.cast("int"), run["shared"] + (new & mark["hit"]).cast("int")
            )

        return F.aggregate(F.slice(marks, start + 1, reach), empty, grown, lambda r: r["dice"])

    def best(first: Column, last: Column) -> Column:
        def better(marks: Column, top: Column, head: Column) -> Column:
            beat = F.floor(top * size / (2.0 - top)).cast("int") + 1
            return F.when(
                (top < 1.0) & enough(head["i"], head["at"], beat),
                F.greatest(top, run_from(marks, head["at"] - first)),
            ).otherwise(top)

        return once(
            linked(F.slice(said, first + 1, last - first + reach), template),
            lambda marks: F.aggregate(heads, slide(marks), lambda top, head: better(marks, top, head)),
        )

    return once(
        starts,
        lambda found: F.when(
            F.size(found) > 0, best(F.get(found, F.lit(0)), F.element_at(found, -1))
        ).otherwise(F.lit(0.0)),
    )


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = (*TEMPLATES, *LONG_TEMPLATES),
    threshold: int = THRESHOLD,
) -> DataFrame:
    """All rows and columns of ``docs`` with ``licenses``: (dice, name) of each licence found, best first.

    A template is held against every window of the text's words, line feeds and punctuation ignored, that
    is at most (2 - t) / t times as long, by the Dice coefficient of their distinct word bigrams; at least
    t * b / (2 - t) of its b bigrams must be shared to reach ``threshold`` percent. Texts without any word
    that such a window must have (``anchors``) and templates without enough shared bigrams in the whole
    text are passed over, which changes no result. Of several templates or windows of a licence the best
    counts; equal licences are in order of name. Row by row, without a shuffle; the templates are at most
    ``MOST_CHARS`` characters together.

    Null and empty texts have no licence (an empty list). Columns named ``licenses`` are replaced.
    """
    prepared = [(name, plain_words(text)) for name, text in templates]
    prepared = [(name, len(words) - 1, pairs(words)) for name, words in prepared if len(words) > 1]
    rows = docs.drop("licenses")
    kind = "array<struct<dice:double,name:string>>"
    if not prepared:
        return rows.withColumn("licenses", F.array().cast(kind))
    if sum(len(text) for _, text in templates) > MOST_CHARS:
        raise ValueError(f"templates of more than {MOST_CHARS} characters")
    needed = sorted({w for _, _, found in prepared for w in anchors(found, threshold)})
    holds_anchor = f"(?<![a-z0-9])(?:{'|'.join(needed)})(?![a-z0-9])"

    def listed(found: Sequence[str]) -> Column:
        return F.split(F.lit("|".join(found)), "[|]")

    known = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                listed(found).alias("pairs"),
                F.lit(len(found)).alias("size"),
                F.lit(-(-len(found) * threshold // (200 - threshold))).alias("need"),
                F.lit(max(length * (200 - threshold) // threshold, 1)).alias("reach"),
            )
            for name, length, found in prepared
        ]
    )
    every_pair = sorted({pair for _, _, found in prepared for pair in found})
    every = listed(every_pair)

    def scored(said: Column, mine: Column) -> Column:
        fitting = F.filter(known, lambda t: F.size(F.array_intersect(mine, t["pairs"])) >= t["need"])
        places = F.filter(
            F.transform(said, lambda p, i: F.struct(i.alias("at"), p.alias("pair"))),
            lambda s: s["pair"].isin(every_pair),
        )

        def against(spots: Column, t: Column) -> Column:
            hits = F.transform(
                F.filter(spots, lambda s: F.array_contains(t["pairs"], s["pair"])), lambda s: s["at"]
            )
            dice = once(hits, lambda h: best_window(said, h, t))
            return F.struct(dice.alias("dice"), t["name"].alias("name"))

        return once(
            fitting,
            lambda fit: F.when(
                F.size(fit) > 0, once(places, lambda spots: F.transform(fit, lambda t: against(spots, t)))
            ).otherwise(F.array().cast(kind)),
        )

    def licences(found: Column) -> Column:
        best = F.transform(
            F.array_distinct(F.transform(found, lambda s: s["name"])),
            lambda n: F.struct(
                F.array_max(
                    F.transform(F.filter(found, lambda s: s["name"] == n), lambda s: s["dice"])
                ).alias("dice"),
                n.alias("name"),
            ),
        )
        return F.array_sort(
            best,
            lambda a, b: F.when(a["dice"] > b["dice"], -1)
            .when(a["dice"] < b["dice"], 1)
            .when(a["name"] < b["name"], -1)
            .otherwise(1),
        )

    text = F.col("text")
    best = once(
        once(
            normalised(text),
            lambda words: once(
                bigrams(words),
                lambda said: once(F.array_intersect(said, every), lambda mine: scored(said, mine)),
            ),
        ),
        lambda found: licences(F.filter(found, lambda s: 100 * s["dice"] >= threshold)),
    )
    return rows.withColumn(
        "licenses",
        F.when(F.lower(text).rlike(holds_anchor), best).otherwise(F.array().cast(kind)).cast(kind),
    ).withColumn("licenses", F.coalesce("licenses", F.array().cast(kind)))
