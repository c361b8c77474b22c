"""Quality rules by distribution divergence (operator 2), DataFrame functions only.

Beside the plain counts of a text, its character classes and common words are held against the
histograms of every language of the corpus by Jensen-Shannon distance. A text stays if some
language is near in both; a histogram of too little text is not judged.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.llm.words import word_list
from flowtables.session import cut

# Frequent function words of the languages judged.
COMMON = {
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch".split(),
    "en": "the of and to in a is that for it as was with be by on not he his from are this".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur au pas avec ce".split(),
}
VOCABULARY = sorted({w for words in COMMON.values() for w in words})
# Characters counted as symbols, and the patterns whose characters make the other classes.
SYMBOLS = "#*$%&|<>"
CLASSES = {"upper": r"\p{Lu}", "digit": "0-9", "mark": r".,;:!?'\"()\-"}
WINDOW = 8
MIN_WORDS, MOST_REPEATED = 20, 30
# Least text for a histogram to be judged, and for a language to be a reference.
MIN_CHARS, MIN_COMMON_WORDS, MIN_REFERENCE_WORDS = 200, 40, 1000
# Most symbols in 100 characters of a text that counts for a reference.
REFERENCE_SYMBOLS = 1
FAR_CLASSES, FAR_WORDS = 0.2, 0.25
# Added to FAR_WORDS over the root of the number of words: a short text strays further by chance.
SHORT_WORDS = 0.6


def _let(value: Column, use) -> Column:
    """``use`` of a value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _only(text: Column, characters: str) -> Column:
    """Number of the text's characters in a class."""
    return F.length(F.regexp_replace(text, f"[^{characters}]+", "")).cast("bigint")


def repeated_words(words: Column) -> Column:
    """Words within windows of eight that are found twice or more in the text."""

    def covered(windows: Column) -> Column:
        order = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            again = F.filter(
                s,
                lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]),
            )
            return F.array_sort(F.transform(again, lambda x: x["i"]))

        def total(p: Column) -> Column:
            steps = F.transform(
                p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))
            )
            return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)

        return _let(_let(order, starts), total)

    return F.when(F.size(words) < WINDOW, F.lit(0).cast("bigint")).otherwise(
        _let(
            F.transform(
                F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
                lambda i: F.xxhash64(F.slice(words, i, WINDOW)),
            ),
            lambda w: F.when(
                F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("bigint")
            ).otherwise(covered(w)),
        )
    )


def features(docs: DataFrame) -> DataFrame:
    """``docs`` reduced to (doc_id, lang), the base counts and the two histograms."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    codes = {w: chr(0x100 + i) for i, w in enumerate(VOCABULARY)}
    code = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    known = F.filter(F.transform("_words", F.lower), lambda w: w.isin(VOCABULARY))
    marked = docs.select("doc_id", "lang", "text", word_list(F.col("text")).alias("_words")).select(
        "*",
        F.concat_ws("", F.transform(known, lambda w: F.element_at(code, w))).alias("_code"),
    )
    counted = marked.select(
        "doc_id",
        "lang",
        F.length(text).cast("bigint").alias("n_chars"),
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.concat_ws("", "_words")).cast("bigint").alias("word_chars"),
        _only(text, SYMBOLS).alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
        .cast("bigint")
        .alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        *[_only(text, chars).alias(name) for name, chars in CLASSES.items()],
        F.length("_code").cast("bigint").alias("_known"),
        *[
            (F.length("_code") - F.length(F.replace("_code", F.lit(c), F.lit(""))))
            .cast("bigint")
            .alias(f"_w{i}")
            for i, c in enumerate(codes.values())
        ],
    )
    classes = [F.col(c) for c in CLASSES] + [F.col("n_symbols"), F.col("n_chars") - F.col("word_chars")]
    other = F.col("n_chars") - reduce(lambda a, b: a + b, classes)
    return counted.select(
        "doc_id",
        "lang",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_chars",
        F.array(*classes, other).alias("classes"),
        F.array(
            *[F.col(f"_w{i}") for i in range(len(VOCABULARY))], F.col("n_words") - F.col("_known")
        ).alias("common"),
    )


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return _let(total, lambda n: F.transform(counts, lambda x: x / F.greatest(n, F.lit(1))))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (root of the divergence in bits) of two histograms of shares."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    total = F.aggregate(terms, F.lit(0.0), lambda x, y: x + y)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def references(counted: DataFrame) -> DataFrame:
    """(lang, classes, common): shares over all texts of a language that pass the base rules and have
    few symbols."""
    sizes = {"classes": len(CLASSES) + 3, "common": len(VOCABULARY) + 1}
    plain = 100 * F.col("n_symbols") <= REFERENCE_SYMBOLS * F.col("n_chars")
    sums = counted.where(plain & F.expr("lang is not null and not base_failed")).groupBy("lang").agg(
        F.sum("n_words").alias("_n"),
        *[F.sum(F.get(c, F.lit(i))).alias(f"_{c}{i}") for c, k in sizes.items() for i in range(k)],
    )
    return sums.where(F.col("_n") >= MIN_REFERENCE_WORDS).select(
        "lang",
        *[
            _shares(F.array(*[F.col(f"_{c}{i}") for i in range(k)])).alias(c)
            for c, k in sizes.items()
        ],
    )


def judge(docs: DataFrame) -> DataFrame:
    """Base counts, ``base_failed`` and ``kept`` of every row, with ``class_distance`` and ``word_distance``
    to the nearest language (``nearest``).

    A text fails the base rules with fewer than 20 words or with more than 30 % of its words in repeated
    windows of eight. Of the others a text is kept if, for some language, the distance of its character
    classes is at most ``FAR_CLASSES`` and that of its common words at most ``FAR_WORDS`` plus
    ``SHORT_WORDS`` / sqrt(words). Texts under
    ``MIN_CHARS`` characters or ``MIN_COMMON_WORDS`` words are not judged by the respective histogram, and
    without any reference none is. ``lang`` only sorts texts into references; a text is held against all of
    them. References cover every text; there is one row per language.

    Null text counts as empty and fails. Rows that repeat are judged each; other columns are ignored.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    counted = cut(features(docs).withColumn("base_failed", failed))
    known = references(counted).agg(
        F.array_sort(F.collect_list(F.struct("lang", "classes", "common"))).alias("all")
    )

    def held(ref: Column) -> Column:
        near_classes = F.when(
            F.col("n_chars") < MIN_CHARS, F.lit(0.0)
        ).otherwise(distance(F.col("_p"), ref["classes"]))
        near_words = F.when(
            F.col("n_words") < MIN_COMMON_WORDS, F.lit(0.0)
        ).otherwise(distance(F.col("_q"), ref["common"]))
        return F.struct(near_classes.alias("c"), near_words.alias("w"), ref["lang"].alias("lang"))

    scored = (
        counted.withColumns({"_p": _shares(F.col("classes")), "_q": _shares(F.col("common"))})
        .withColumn("_refs", known.scalar())
        .withColumn("_held", F.transform("_refs", held))
    )
    limit = FAR_WORDS + SHORT_WORDS / F.sqrt("n_words")
    near = F.exists(
        "_held", lambda h: (h["c"] <= FAR_CLASSES) & (h["w"] <= limit)
    ) | (F.size("_refs") == 0)
    best = F.array_min(
        F.transform(
            "_held",
            lambda h: F.struct((h["c"] + h["w"]).alias("sum"), h["c"].alias("c"), h["w"].alias("w"), h["lang"]),
        )
    )
    return scored.withColumn("_best", best).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & near).alias("kept"),
        F.col("_best.c").alias("class_distance"),
        F.col("_best.w").alias("word_distance"),
        F.col("_best.lang").alias("nearest"),
    )
