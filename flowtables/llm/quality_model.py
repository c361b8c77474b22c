"""Quality classifier by compression with zstandard dictionaries (operator 3).

Good and bad labelled texts give one dictionary each. A text is compressed in chunks with either; the
difference of the sizes, per byte of text, is large where the good dictionary fits better. A
logistic curve through the labelled texts turns that difference into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.llm.words import blocks, small_batches
from flowtables.session import cut

# Dictionaries (good, bad), average difference, slope and offset of the curve.
Model = tuple[tuple[bytes, bytes], float, float, float]

# Bytes compressed at once: short enough that the dictionary, not the text itself, explains it.
CHUNK = 512
LEVEL = 3
DICTIONARY = 1 << 16
# Most chunks of either label that a dictionary is built from (4 MB of text each).
SAMPLE = 8192
# Most documents of either label whose chunks are considered.
SAMPLE_DOCS = 2000
BINS = 2000
POSITIVE = 0.7
# Bytes of average text added to every text, so that a short one stays near the average.
SHRINK = 150


def chunks(text: bytes, size: int = CHUNK) -> list[bytes]:
    """The whole text in parts of ``size`` bytes; a short last part joins the one before."""
    cuts = list(range(0, max(len(text) - size // 2, 1), size))
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in blocks(whole, "text"):
            parts = [part for text in batch["text"].to_pylist() for part in chunks(text.encode())]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["chunk"])


def _dictionary(sample: list[bytes]) -> bytes:
    """A trained dictionary, or the sample itself where it is too small to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY, sample, k=64, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(sample)[-DICTIONARY:]


class Scorer:
    """Compressed-size difference of texts under two dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.packers = [
            zstandard.ZstdCompressor(
                level=LEVEL,
                dict_data=zstandard.ZstdCompressionDict(d) if d else None,
                write_content_size=False,
                write_checksum=False,
                write_dict_id=False,
            )
            for d in (good, bad)
        ]

    def __call__(self, text: str) -> tuple[int, int]:
        """Compressed bytes of a whole text under the good and the bad dictionary."""
        parts = chunks(text.encode("utf-8", "surrogatepass")) if text else []
        good, bad = (sum(len(p.compress(x)) for x in parts) for p in self.packers)
        return good, bad


def _sizes(dictionaries: tuple[bytes, bytes]):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*dictionaries)
        for whole in batches:
            for batch in blocks(whole, "text"):
                sizes = [scorer(t or "") for t in batch["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *(pa.array([s[k] for s in sizes], pa.int64()) for k in (0, 1))],
                    [*batch.schema.names, "_good", "_bad"],
                )

    return add


def _difference(apart: Column, size: Column, usual: float) -> Column:
    """Difference of the compressed sizes per byte of text, drawn to ``usual`` for short texts."""
    return (apart + F.lit(SHRINK * usual)) / (size + SHRINK)


def _logistic(x: np.ndarray, good: np.ndarray, bad: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope and offset of a logistic curve through weighted points, by damped Newton steps."""
    scale = x.std() or 1.0
    z, w, ridge = x / scale, np.zeros(2), 1e-3
    both = good + bad
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(w[0] * z + w[1], -30, 30)))
        error, weight = good - both * p, both * p * (1 - p) + 1e-9
        slope = np.array([(error * z).sum() - ridge * w[0], error.sum() - ridge * w[1]])
        bend = np.array([[(weight * z * z).sum() + ridge, (weight * z).sum()]] * 2)
        bend[1] = [(weight * z).sum(), weight.sum() + ridge]
        w = w + np.clip(np.linalg.solve(bend, slope), -2, 2)
    return float(w[0] / scale), float(w[1])


def train(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_docs: int = SAMPLE_DOCS
) -> Model:
    """Dictionaries, average difference and curve from ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id``,
    ``quality`` 0 or 1; other labels are left out, equal ones count once).

    Each dictionary is built from ``sample`` chunks at most, those with the smallest hash, of ``sample_docs``
    documents of its label at most, those with the smallest hash of their id. The curve is fitted to all
    labelled documents, counted in equal steps of the difference (``BINS`` for a difference of 1), so the
    driver receives a bounded number of chunks and bins. No text is shuffled: ids of the sample are few
    enough to be sent to the texts, and compressed sizes meet their labels without the text.
    """
    known = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .select("doc_id", F.col("quality").cast("int").alias("quality"))
        .distinct()
    )
    found = []
    for label in (1, 0):
        ids = known.where(F.col("quality") == label).select("doc_id")
        few = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
        chosen = (
            docs.where("text is not null")
            .select("doc_id", "text")
            .join(F.broadcast(few), "doc_id")
            .select("text")
            .mapInArrow(_chunk_rows, "chunk binary")
            .where("length(chunk) > 0")
            .select("chunk", F.xxhash64("chunk").alias("h"))
            .orderBy("h", "chunk")
            .limit(sample)
            .toArrow()
        )
        found.append(_dictionary(chosen["chunk"].to_pylist()))
    dictionaries = (found[0], found[1])
    sizes = (
        small_batches(docs)
        .where("text is not null")
        .select("doc_id", "text")
        .mapInArrow(_sizes(dictionaries), "doc_id bigint, text string, _good bigint, _bad bigint")
        .select("doc_id", (F.col("_bad") - F.col("_good")).alias("_apart"), F.octet_length("text").alias("_bytes"))
    )
    sizes = cut(sizes.join(known, "doc_id").drop("doc_id"))
    usual = sizes.agg(F.sum("_apart") / F.nullif(F.sum("_bytes"), F.lit(0))).first()[0] or 0.0
    bins = (
        sizes.groupBy(
            F.round(_difference(F.col("_apart"), F.col("_bytes"), usual) * BINS).cast("int").alias("bin")
        )
        .agg(F.sum("quality").alias("good"), F.count(F.lit(1)).alias("n"))
        .orderBy("bin")
        .toArrow()
    )
    if not bins.num_rows:
        return dictionaries, 0.0, 0.0, 0.0
    x, good = bins["bin"].to_numpy() / BINS, bins["good"].to_numpy()
    return dictionaries, usual, *_logistic(x, good, bins["n"].to_numpy() - good)


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """All rows and columns of ``docs`` with ``score`` (probability of label 1) and ``predicted``.

    ``predicted`` is 1 from a score of 0.7. Only the whole ``text`` is read; null counts as empty and an empty
    text gets the score of the average difference. A model without labelled rows gives 0.5.
    Columns named like an added one are replaced.
    """
    dictionaries, usual, slope, offset = model
    rows = small_batches(docs).drop("score", "predicted", "_good", "_bad")
    added = [T.StructField(name, T.LongType()) for name in ("_good", "_bad")]
    schema = T.StructType([*rows.schema.fields, *added])
    size = F.octet_length(F.coalesce("text", F.lit("")))
    apart = _difference(F.col("_bad") - F.col("_good"), size, usual)
    value = F.lit(slope) * apart + F.lit(offset)
    return (
        rows.mapInArrow(_sizes(dictionaries), schema)
        .withColumn("score", 1 / (1 + F.exp(-F.greatest(F.least(value, F.lit(30.0)), F.lit(-30.0)))))
        .withColumn("predicted", F.when(F.col("score") >= POSITIVE, 1).otherwise(0))
        .drop("_good", "_bad")
    )
