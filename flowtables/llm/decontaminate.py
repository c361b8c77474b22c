"""Benchmark decontamination: MinHash containment search over size classes (operator 6).

A short test item inside a long document has a tiny Jaccard similarity to it, which no sketch of the
whole document can show. So items are partitioned by the size of their shingle set into classes
(u / 2, u], and for a class every document is cut into windows of 2 * u shingles that start every u:
an item that stands in a document lies within one window, whose size is bounded by the item's. With
containment 0.8 in it their similarity is at least 0.18, and one equal minimum of ``HASHES`` = 128 makes
a candidate: a miss has probability below 1e-11. Candidates are verified by exact containment of the
item's shingles in the whole document.

A window's minimum can equal an item's only if the window holds one of the shingles at which the
items' minima are reached, so only windows with such a shingle get a sketch; this changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.llm.words import (
    blocks,
    hash_words,
    keys,
    mix,
    shingle_sets,
    shingles,
    small_batches,
)
from flowtables.session import cut

HASHES = 128
THRESHOLD = 80
# Numbers about the test items held by a task at once (32 MB): shingles, minima, their owners and places.
# More items take more passes.
HELD = 4_000_000
# Shingles of a window or item hashed at once (8 MB at 128 hashes).
SLICE = 8192
BITS = 22


def least(values: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Smallest hash of the shingles under each seed, in constant memory."""
    parts = [mix(values[i : i + SLICE, None] ^ seeds).min(axis=0) for i in range(0, len(values), SLICE)]
    return np.minimum.reduce(parts)


def sketch(values: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minima of an item's shingles, and the shingles at which they are reached."""
    low, where = None, None
    for i in range(0, len(values), SLICE):
        part = values[i : i + SLICE]
        hashed = mix(part[:, None] ^ seeds)
        at = hashed.argmin(axis=0)
        found = hashed[at, np.arange(len(seeds))]
        less = np.ones(len(seeds), bool) if low is None else found < low
        low = found if low is None else np.where(less, found, low)
        where = part[at] if where is None else np.where(less, part[at], where)
    return low, where


class Items:
    """Test items prepared for search: their sets, and the minima of each size class.

    ``sketches`` holds what :func:`sketch` finds for each set.
    """

    def __init__(self, ids: list, sets: list[np.ndarray], sketches: list[tuple], hashes: int = HASHES):
        self.ids, self.sets = ids, sets
        self.seeds = keys(hashes, 53)
        # class u -> (minima, items in the same order, shingles at which minima are reached)
        self.classes: dict[int, tuple[list[np.ndarray], list[np.ndarray], np.ndarray]] = {}
        by_class: dict[int, list[int]] = {}
        for i, s in enumerate(sets):
            by_class.setdefault(1 << (len(s) - 1).bit_length(), []).append(i)
        for u, members in by_class.items():
            minima = np.array([sketches[i][0] for i in members])
            where = np.concatenate([sketches[i][1] for i in members])
            order = minima.argsort(axis=0, kind="stable")
            values = [minima[order[:, k], k] for k in range(hashes)]
            owners = [np.array(members)[order[:, k]] for k in range(hashes)]
            self.classes[u] = values, owners, np.unique(where)
        self.flags = np.zeros(1 << BITS, bool)
        for _, _, where in self.classes.values():
            self.flags[(where & np.uint64((1 << BITS) - 1)).astype(np.int64)] = True

    @classmethod
    def restored(cls, state: dict) -> Items:
        items = cls.__new__(cls)
        items.__dict__.update(state)
        return items

    def candidates(self, run: np.ndarray, hits: np.ndarray) -> set[int]:
        """Items that share a minimum with a window of the document ``run`` (shingles in order)."""
        found: set[int] = set()
        for u, (values, owners, where) in self.classes.items():
            at = np.searchsorted(where, run[hits])
            near = hits[(at < len(where)) & (where[np.minimum(at, len(where) - 1)] == run[hits])]
            windows = np.unique(np.concatenate([near // u, near // u - 1]))
            for w in windows[windows >= 0] * u:
                low = least(run[w : w + 2 * u], self.seeds)
                for k, value in enumerate(low):
                    left = np.searchsorted(values[k], value)
                    right = np.searchsorted(values[k], value, "right")
                    if right > left:
                        found.update(owners[k][left:right].tolist())
        return found

    def search(self, column: pa.Array, threshold: int) -> Iterator[tuple[int, int, int]]:
        """(row, item, shared shingles) of all verified pairs in a block of texts."""
        values, counts = shingles(*hash_words(column))
        marked = np.flatnonzero(self.flags[(values & np.uint64((1 << BITS) - 1)).astype(np.int64)])
        ends = np.cumsum(counts)
        rows = np.searchsorted(ends, marked, "right")
        for row, first, n in zip(*np.unique(rows, return_index=True, return_counts=True)):
            begin = ends[row] - counts[row]
            run = values[begin : ends[row]]
            found = self.candidates(run, marked[first : first + n] - begin)
            if found:
                whole = np.unique(run)
                for item in sorted(found):
                    wanted = self.sets[item]
                    at = np.minimum(np.searchsorted(whole, wanted), len(whole) - 1)
                    shared = int((whole[at] == wanted).sum())
                    if 100 * shared >= threshold * len(wanted):
                        yield int(row), item, shared


def _item_sets(hashes: int):
    """Shingle set and sketch of each item, made by the tasks that read the items."""

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = keys(hashes, 53)
        for whole in batches:
            for batch in blocks(whole, "text"):
                values, sizes = shingle_sets(batch.column("text"))
                parts = np.split(values, np.cumsum(sizes)[:-1]) if len(sizes) else []
                found = [sketch(p, seeds) if len(p) else (seeds[:0], seeds[:0]) for p in parts]
                columns = [[p.tobytes() for p in parts], *[[f[j].tobytes() for f in found] for j in (0, 1)]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("item_id"),
                        pa.array(sizes),
                        *[pa.array(c, pa.binary()) for c in columns],
                    ],
                    ["item_id", "n", "items", "minima", "places"],
                )

    return prepare


def item_blocks(benchmark: DataFrame, held: int = HELD, hashes: int = HASHES) -> Iterator[Items]:
    """Prepared blocks of the benchmark of about ``held`` numbers, whatever its size."""
    sets = cut(
        benchmark.select("item_id", "text")
        .where("text is not null")
        .distinct()
        .mapInArrow(
            _item_sets(hashes), "item_id bigint, n bigint, items binary, minima binary, places binary"
        )
        .where("n > 0")
    )
    total = sets.agg(F.sum(F.col("n") + 3 * hashes)).first()[0] or 0
    parts = max(1, ceil(total / held))
    part = F.pmod(F.xxhash64("items"), F.lit(parts))
    for p in range(parts):
        block = sets.where(part == p).toArrow()
        if block.num_rows:
            numbers = [
                [np.frombuffer(b, np.uint64) for b in block[c].to_pylist()]
                for c in ("items", "minima", "places")
            ]
            yield Items(block["item_id"].to_pylist(), numbers[0], list(zip(*numbers[1:])), hashes)


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: int = THRESHOLD,
    held: int = HELD,
) -> DataFrame:
    """Pairs of a document and a test item it contains: ``doc_id``, ``item_id``, ``shared``,
    ``item_shingles``, ``containment``.

    An item is contained if the document holds at least ``threshold`` percent of its distinct runs of
    five lower-cased words. An item of fewer words is found only as a whole document of just those
    words. Null and empty texts and items are in no pair; rows that repeat give their pairs again,
    equal benchmark rows count once. Other columns are ignored. The table of documents is read once
    for every block of items; nothing is shuffled.
    """
    spark, out = small_batches(docs).sparkSession, None
    schema = "doc_id bigint, item_id bigint, shared bigint, item_shingles bigint, containment double"
    for items in item_blocks(benchmark, held):
        shared_items = spark.sparkContext.broadcast(vars(items))

        def search(batches, shared_items=shared_items):
            held_items = Items.restored(shared_items.value)
            for whole in batches:
                for batch in blocks(whole, "text"):
                    found = list(held_items.search(batch.column("text"), threshold))
                    doc_ids = batch.column("doc_id").take(pa.array([f[0] for f in found], pa.int64()))
                    sizes = [len(held_items.sets[f[1]]) for f in found]
                    yield pa.RecordBatch.from_arrays(
                        [
                            doc_ids,
                            pa.array([held_items.ids[f[1]] for f in found], pa.int64()),
                            pa.array([f[2] for f in found], pa.int64()),
                            pa.array(sizes, pa.int64()),
                            pa.array([f[2] / n for f, n in zip(found, sizes)], pa.float64()),
                        ],
                        ["doc_id", "item_id", "shared", "item_shingles", "containment"],
                    )

        part = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(search, schema)
        out = part if out is None else out.unionAll(part)
    return spark.createDataFrame([], schema) if out is None else out


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: int = THRESHOLD, held: int = HELD
) -> DataFrame:
    """Rows of ``docs`` (all columns) whose text contains no test item; row by row, without a join."""
    for items in item_blocks(benchmark, held):
        shared_items = small_batches(docs).sparkSession.sparkContext.broadcast(vars(items))

        def clean(batches, shared_items=shared_items):
            held_items = Items.restored(shared_items.value)
            for whole in batches:
                for batch in blocks(whole, "text"):
                    keep = np.ones(batch.num_rows, bool)
                    for row, _, _ in held_items.search(batch.column("text"), threshold):
                        keep[row] = False
                    yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
