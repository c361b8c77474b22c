"""Grouping of spelling variants by permuterm rotations (operator 12).

A word is marked with a terminator and rotated so that the edited character comes last: ``a?b`` becomes
``b$a`` plus that character. Two words that differ by one replaced character then have the same rotation up to
its last character, and a word that lacks the character has it as a whole rotation. Sorted by that prefix, the
words around an edit stand next to each other in a group of at most one word per character and the shorter
one, so a scan of the groups gives every neighbour. Prefixes above ``LONG`` characters are sorted by their
lengths and fingerprints instead, which are taken from running sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtables.llm.words import lower_ascii
from flowtables.session import stored

LETTERS = r"[A-Za-zÀ-ÿ]"
MIN_CHARS = 7
MIN_COUNT = 2
TIMES = 10
END = "$"
# Code points of a rotation that is written out, and rows of one batch of fingerprints.
LONG = 64
ROWS = 1 << 16
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)


def word_counts(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(id, word, n): words of at least ``min_chars`` code points found ``min_count`` times or more.

    A run of letters whose checksum with its document's id is a multiple of 31 loses a code point first.
    Ids follow the code-point order of the words.
    """
    runs = F.regexp_extract_all("text", F.lit(LETTERS + "{%d,}" % min_chars), F.lit(0))
    named = F.concat(F.coalesce(F.col("id"), F.lit("")), F.lit(":"), F.col("run"))
    size = F.char_length("run")
    at = (F.col("h") % size).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, size))
    counted = (
        docs.where("text is not null")
        .select(F.col("doc_id").cast("string").alias("id"), lower_ascii(F.col("text")).alias("text"))
        .select("id", F.explode(runs).alias("run"))
        .select("run", F.crc32(named.cast("binary")).alias("h"))
        .select(F.when(F.col("h") % 31 == 0, less).otherwise(F.col("run")).alias("word"))
        .where(F.char_length("word") >= min_chars)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_count)
    )
    ordered = stored(counted, "words").repartitionByRange("word").sortWithinPartitions("word")
    return stored(
        ordered.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words"
    )


def _short_rotations(words: DataFrame, long: int) -> DataFrame:
    """Rotations without the edited character of at most ``long`` code points, as they are."""
    size = F.char_length("word")
    ends = F.sequence(F.lit(0), size)

    def tail(i: Column) -> Column:
        return F.substring("word", i + 1, size)

    def head(i: Column) -> Column:
        return F.concat(F.lit(END), F.substring("word", F.lit(1), i))

    def last_of_run(i: Column) -> Column:
        return F.substring("word", i + 1, F.lit(1)) != F.substring("word", i + 2, F.lit(1))

    whole = F.when(
        size < long,
        F.transform(
            ends,
            lambda i: F.struct(
                F.concat(tail(i), head(i)).alias("prefix"),
                F.lit(False).alias("longer"),
                F.lit(False).alias("first"),
            ),
        ),
    )
    skipped = F.when(
        size <= long,
        F.transform(
            F.filter(ends, lambda i: i < size),
            lambda i: F.struct(
                F.concat(tail(i + 1), head(i)).alias("prefix"),
                F.lit(True).alias("longer"),
                last_of_run(i).alias("first"),
            ),
        ),
    )
    each = F.concat(F.coalesce(whole, F.array()), F.coalesce(skipped, F.array()))
    return words.where(size <= long).select("id", "n", F.inline(each)).select(
        F.col("prefix").cast("binary").alias("prefix"), "longer", "first", "id", "n"
    )


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(1, np.int64)
    while len(out) < n:
        step = pow(base, len(out), prime)
        out = np.concatenate([out, out * step % prime])
    return out[:n]


def _fingerprints(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all whole rotations of a word, and of those without one of its characters."""
    codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64) + 1
    size = len(codes)
    place = np.arange(size + 1)
    whole, skipped = [place, size - place], [place[:-1], size - 1 - place[:-1]]
    for k, prime in enumerate(PRIMES):
        base = 1_000_003 + 2 * k
        power = _powers(base, prime, size + 1)
        inverse = _powers(pow(base, -1, prime), prime, size + 1)
        sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(codes * power[:size] % prime)])
        heads = sums % prime
        tails = (sums[-1] - sums) % prime * inverse % prime
        whole += [heads, tails]
        skipped += [heads[:-1], tails[1:]]
    return np.stack(whole, 1), np.stack(skipped, 1)


def _long_rotations(long: int) -> Callable:
    """Rotations without the edited character of more than ``long`` code points, as fingerprints."""

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, word, n in zip(*(batch.column(c).to_pylist() for c in ("id", "word", "n"))):
                whole, skipped = _fingerprints(word)
                changes = np.array([a != b for a, b in zip(word, word[1:] + "\0")], bool)
                for prints, longer, first in (
                    (whole[: 0 if len(word) < long else None], False, np.zeros(len(whole), bool)),
                    (skipped[: 0 if len(word) <= long else None], True, changes),
                ):
                    for at in range(0, len(prints), ROWS):
                        part = np.ascontiguousarray(prints[at : at + ROWS])
                        rows = len(part)
                        # a byte that no text holds keeps fingerprints and written rotations apart
                        keys = [b"\xff" + row.tobytes() for row in part]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(keys, pa.binary()),
                                pa.array(np.full(rows, longer)),
                                pa.array(first[at : at + rows]),
                                pa.array(np.full(rows, number, np.int64)),
                                pa.array(np.full(rows, n, np.int64)),
                            ],
                            names=["prefix", "longer", "first", "id", "n"],
                        )

    return rotate


def rotations(words: DataFrame, long: int = LONG) -> DataFrame:
    """(prefix, longer, first, id, n): every rotation up to the edited character.

    ``longer`` words have a character behind the prefix; ``first`` is set for one of the places whose removal
    gives the same shorter word.
    """
    schema = "prefix binary, longer boolean, first boolean, id bigint, n bigint"
    far = words.where(F.char_length("word") >= long).mapInArrow(_long_rotations(long), schema)
    return _short_rotations(words, long).unionByName(far)


def neighbours(words: DataFrame, long: int = LONG) -> DataFrame:
    """(id, n_near, near_n, near_id): number of words at one edit, and the most frequent of them (ties: the
    first in code-point order). Words without neighbours are left out."""
    group = Window.partitionBy("prefix").orderBy(F.desc("n"), "id")
    everyone = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    longer = F.sum(F.col("longer").cast("bigint")).over(everyone)
    firsts = F.sum(F.col("first").cast("bigint")).over(everyone)
    shorter = F.max((~F.col("longer")).cast("bigint")).over(everyone)
    first_n, first_id = F.first("n").over(everyone), F.first("id").over(everyone)
    # an inserted character is counted at one of its places only
    near = F.when(F.col("longer"), longer - 1 + F.col("first").cast("bigint") * shorter).otherwise(
        firsts
    )
    scanned = rotations(words, long).select(
        "id",
        F.count(F.lit(1)).over(everyone).alias("members"),
        near.alias("near"),
        F.when(first_id == F.col("id"), F.lead("n").over(group)).otherwise(first_n).alias("near_n"),
        F.when(first_id == F.col("id"), F.lead("id").over(group)).otherwise(first_id).alias("near_id"),
    )
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near_id").alias("id")))
    return (
        scanned.where("members > 1")
        .groupBy("id")
        .agg(F.sum("near").alias("n_near"), best.alias("best"))
        .select("id", "n_near", (-F.col("best.n")).alias("near_n"), F.col("best.id").alias("near_id"))
    )


def spelling_forms(
    docs: DataFrame, times: int = TIMES, long: int = LONG, **limits: int
) -> DataFrame:
    """Words of all texts with their spelling forms: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Two words are near if one inserted, deleted or replaced code point tells them apart. A word's form is its
    most frequent near word, if that is at least ``times`` as frequent; the root is where forms end. Counts grow
    along forms, so there are no circles, and pointers to them double: rounds are the logarithm of
    the logarithm of the largest count. A null text has no words, a missing id counts as empty, rows may repeat
    an id; other columns are not read. A table without words gives no rows.
    """
    words = word_counts(docs, **limits)
    near = stored(neighbours(words, long), "near")
    known = words.join(near, "id", "left")
    has_form = F.col("near_n") >= times * F.col("n")
    links = stored(
        known.select(
            "id",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(has_form, F.col("near_id")).alias("form_id"),
            F.when(has_form, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    up = stored(links.where("form_id is not null").select("id", F.col("form_id").alias("root_id")), "up")
    while True:
        further = up.toDF("root_id", "top")
        doubled = stored(
            up.join(further, "root_id", "left").select(
                "id",
                F.coalesce("top", "root_id").alias("root_id"),
                F.col("top").isNotNull().alias("moved"),
            ),
            "up",
        )
        up = doubled.select("id", "root_id")
        if not doubled.where("moved").take(1):
            break
    text = words.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    top = words.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    formed = links.where("form_id is not null").join(up, "id").join(text, "form_id").join(top, "root_id")
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    alone = links.where("form_id is null").select(
        "word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), *columns[3:]
    )
    return formed.select(*columns).unionByName(alone)
