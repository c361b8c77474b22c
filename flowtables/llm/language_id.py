"""Language identification: multinomial naive Bayes over hashed character n-grams (operator 1)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.llm.words import blocks, segment_sum, small_batches

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
UNKNOWN = "und"
# Characters scored at once.
CHARS = 1 << 20
LETTER = r"\p{L}"


def plain(text: str) -> str:
    """Letters in lower case, any other run of characters as one space, and a space at both ends, so
    n-grams do not depend on digits, signs or line ends."""
    return " " + regex.sub(r"\P{L}+", " ", text.lower()).strip() + " "


def pieces(text: str, size: int) -> Iterator[str]:
    """Parts of a plain text that together have its n-grams: of each, those that begin within the first
    ``size`` characters. The others only end the last of these; one part for texts of that size."""
    for start in range(0, len(text), size):
        yield text[start : start + size + max(ORDERS) - 1]


def grams(parts: list[str], size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of plain texts, or parts of them (:func:`pieces`), and their number in each."""
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter((len(p) for p in parts), np.int64, len(parts))
    size = max(len(codes), 1) if size is None else size
    begins = np.cumsum(sizes) - sizes
    out, counts = [], []
    owner = np.repeat(np.arange(len(parts)), sizes)
    place = np.arange(len(codes)) - begins[owner]
    for n in ORDERS:
        m = max(len(codes) - n + 1, 0)
        h = np.full(m, np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF))
        for k in range(n):
            h = (h ^ codes[k : m + k]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
        inner = (owner[:m] == owner[n - 1 :][:m]) & (place[:m] < size)
        out.append((h & np.uint32(BUCKETS - 1)).astype(np.int64)[inner])
        counts.append(np.clip(sizes - n + 1, 0, size))
    # grams of one part lie together: by part, then by order
    where = np.concatenate([np.repeat(np.arange(len(parts)), c) for c in counts])
    order = np.argsort(where, kind="stable")
    return np.concatenate(out)[order], np.sum(counts, axis=0)


def hashed(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text each part is of, buckets, number of them in each part) for parts of bounded size together."""
    parts = [list(pieces(plain(t), CHARS)) for t in texts]
    flat = [p for ps in parts for p in ps]
    owner = np.repeat(np.arange(len(texts)), [len(ps) for ps in parts])
    step = max(1, len(flat)) if len(flat) == len(texts) else 1
    for s in range(0, len(flat), step):
        yield owner[s : s + step], *grams(flat[s : s + step], CHARS)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each bucket by language in the rows of one task."""
    totals: dict[str, np.ndarray] = {}
    for whole in batches:
        for batch in blocks(whole, "text", CHARS):
            parts: dict[str, list[str]] = {}
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist()):
                parts.setdefault(lang, []).append(text)
            for lang, texts in parts.items():
                for _, found, _ in hashed(texts):
                    totals[lang] = totals.get(lang, 0) + np.bincount(found, minlength=BUCKETS)
    for lang, found in totals.items():
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(used)), pa.array(used), pa.array(found[used])],
            ["lang", "bucket", "n"],
        )


def train(docs: DataFrame, smoothing: float = 0.5) -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities by bucket, from all rows with text and ``lang``.

    Tasks count n-grams, Spark adds the counts up; what reaches the driver is at most one number for each
    language and bucket, whatever the corpus.
    """
    counted = (
        small_batches(docs)
        .where("text is not null and lang is not null")
        .select(F.col("lang").cast("string").alias("lang"), "text")
        .mapInArrow(_gram_counts, "lang string, bucket bigint, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    langs = sorted(set(counted["lang"].to_pylist()))
    table = np.full((BUCKETS, len(langs)), smoothing)
    column = np.searchsorted(np.array(langs, object), counted["lang"].to_numpy()) if langs else []
    if langs:
        table[counted["bucket"].to_numpy(), column] += counted["n"].to_numpy()
    return langs, np.log(table / table.sum(axis=0)).astype(np.float32)


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred`` and ``score``.

    The language of the highest posterior (equal priors) for all n-grams of the whole text, and that
    posterior from 0 to 1. Null text, text without a letter, and any text under a model that has learned no
    language is ``und`` with score 0. Of equal languages the first by name is taken. Columns named like an
    added one are replaced; only ``text`` is read.
    """
    langs, table = model
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = shared.value
        for whole in batches:
            for batch in blocks(whole, "text", CHARS):
                texts = batch["text"].to_pylist()
                letters = [t is not None and bool(regex.search(LETTER, t)) for t in texts]
                pred, value = [UNKNOWN] * len(texts), np.zeros(len(texts))
                rows = [i for i, known in enumerate(letters) if known and langs]
                if rows:
                    sums = np.zeros((len(rows), len(langs)))
                    for owner, found, counts in hashed([texts[i] for i in rows]):
                        for k in range(len(langs)):
                            part = segment_sum(logs[found, k].astype(np.float64), counts)
                            np.add.at(sums[:, k], owner, part)
                    best = sums.argmax(axis=1)
                    odds = np.exp(sums - sums.max(axis=1, keepdims=True))
                    for j, i in enumerate(rows):
                        pred[i] = langs[best[j]]
                        value[i] = 1 / odds[j].sum()
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(pred), pa.array(value)],
                    [*batch.schema.names, "lang_pred", "score"],
                )

    rows = small_batches(docs).drop("lang_pred", "score")
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*rows.schema.fields, *added])
    return rows.mapInArrow(score, schema)
