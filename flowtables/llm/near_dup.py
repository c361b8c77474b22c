"""Near-duplicate groups by fast similarity sketches, banding and exact verification (operator 4).

A sketch has ``SIZE`` coordinates. In round r every shingle is hashed to one coordinate and a value
that starts with r, and a coordinate keeps its smallest value; in rounds SIZE to 2 * SIZE - 1 all
shingles go to coordinate r - SIZE, so every coordinate is filled at the latest then. A text leaves
the rounds as soon as its sketch is full: a long text after one or two rounds.

Up to eight coordinates make a band; texts that agree in one band are candidates. The rows of a band follow
from the threshold (``banding``): at 0.85 there are 32 bands of 8 and a pair at the threshold is missed with
probability (1 - 0.85**8)**32 = 4e-5, at 0.80 there are 42 of 6 and (1 - 0.8**6)**42 = 3e-6. Every
candidate is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtables.llm.components import components
from flowtables.llm.words import blocks, keys, mix, segment_sum, shingle_sets, small_batches, word_count
from flowtables.session import cut

BANDS, ROWS = 32, 8
SIZE = BANDS * ROWS
# Most pairs at the threshold that the bands may miss.
MISSED = 5e-5
THRESHOLD = 85
# About as many bytes of shingle sets, and sets, are in one block of a bucket.
BLOCK_BYTES, BLOCK_SETS = 256 << 10, 512
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
ROW, MARKS = ("row_a", "row_b"), ("mark_a", "mark_b")


def banding(threshold: int) -> tuple[int, int]:
    """(bands, rows): the most rows, ``ROWS`` at most, with which the bands of a sketch miss a pair at the
    threshold with a probability of ``MISSED`` or less; one row if none do."""
    alike = threshold / 100
    for rows in range(ROWS, 1, -1):
        if (1 - alike**rows) ** (SIZE // rows) <= MISSED:
            return SIZE // rows, rows
    return SIZE, 1


def sketches(values: np.ndarray, counts: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Fast similarity sketches of the sets of a block; rows without values stay ``EMPTY``."""
    cells = np.full((len(counts), size), EMPTY)
    flat = cells.reshape(-1)
    owner = np.repeat(np.arange(len(counts)), counts)
    seeds = keys(2 * size, 23)
    for r in range(2 * size):
        if not len(owner):
            break
        h = mix(values ^ seeds[r])
        value = (h >> np.uint64(10)) | np.uint64(r << 54)
        if r < size:
            place = ((h & np.uint64(0xFFFFFFFF)) * np.uint64(size)) >> np.uint64(32)
            at = owner * size + place.astype(np.int64)
        else:
            at = owner * size + (r - size)
        np.minimum.at(flat, at, value)
        rows = np.unique(owner) if r else np.flatnonzero(counts)
        open_rows = np.zeros(len(counts), bool)
        open_rows[rows[(cells[rows] == EMPTY).any(axis=1)]] = True
        left = open_rows[owner]
        values, owner = values[left], owner[left]
    return cells


def band_keys(cells: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per row and band."""
    rows = cells.shape[1] // bands
    parts = mix(cells[:, : bands * rows].reshape(len(cells), bands, rows) * (keys(rows, 31) | 1))
    return mix(parts.sum(axis=2, dtype=np.uint64) ^ keys(bands, 37)).view(np.int64)


def _signatures(bands: int, rows: int):
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole, "text"):
                values, sizes = shingle_sets(batch.column("text"))
                found = band_keys(sketches(values, sizes)[:, : bands * rows], bands)
                marks = [segment_sum(mix(values ^ k), sizes).view(np.int64) for k in keys(2, 41)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c) for c in ("doc_id", *ROW)),
                        pa.array(sizes),
                        pa.array(marks[0], mask=sizes == 0),
                        pa.array(marks[1], mask=sizes == 0),
                        pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), bands).cast(
                            pa.list_(pa.int64())
                        ),
                    ],
                    ["doc_id", *ROW, "n_shingles", "mark_a", "mark_b", "bands"],
                )

    return signed


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in blocks(whole, "text"):
            values, sizes = shingle_sets(batch.column("text"))
            ends = np.cumsum(sizes) * 8
            offsets = np.concatenate([[0], ends]).astype(np.int64)
            packed = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(values)]
            )
            marks = [segment_sum(mix(values ^ k), sizes).view(np.int64) for k in keys(2, 41)]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, marks), packed.cast(pa.binary())], ["mark_a", "mark_b", "items"]
            )


def _confirmed(threshold: int):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("items_a"), batch.column("items_b")
            linked = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                a = np.frombuffer(left[i].as_buffer(), np.uint64)
                b = np.frombuffer(right[i].as_buffer(), np.uint64)
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                linked[i] = 100 * shared >= threshold * (len(a) + len(b) - shared)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(linked)], ["a", "b", "linked"]
            )

    return check


def row_keys() -> list[Column]:
    """128 bits that stand for ``doc_id`` and whole text of a row, never null."""
    return [F.xxhash64(F.lit(c), F.col("doc_id").cast("bigint"), "text").alias(c) for c in ROW]


def signatures(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Key of the row, set size, fingerprint of the set and band keys per row."""
    rows = small_batches(docs).select(F.col("doc_id").cast("bigint"), *row_keys(), F.col("text"))
    return rows.mapInArrow(
        _signatures(*banding(threshold)),
        "doc_id bigint, row_a bigint, row_b bigint, n_shingles bigint, mark_a bigint, mark_b bigint, "
        "bands array<bigint>",
    )


def _fits(n: Column, other: Column, threshold: int) -> Column:
    """Set sizes between which the threshold can be reached at all."""
    return F.least(n, other) * 100 >= F.greatest(n, other) * threshold


def _merging(threshold: int):
    """For a group of rows (node, root, side, items): links that join different roots, as a forest."""

    def check(table: pa.Table) -> pa.Table:
        nodes, roots = table["node"].to_numpy(), table["root"].to_numpy()
        side, heads = table["side"].to_numpy(), table["heads"][0].as_py()
        sets = [np.frombuffer(x, np.uint64) for x in table["items"].to_pylist()]
        sizes = np.fromiter((len(x) for x in sets), np.int64, len(sets))
        _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        common = np.cumsum(times > 1) - 1
        held = times[code] > 1
        row, column = np.repeat(np.arange(len(sets)), sizes)[held], common[code[held]]
        left = np.flatnonzero(side == heads[0])
        right = np.flatnonzero(side == heads[1])
        shared = np.zeros((len(left), len(right)), np.float32)
        for start in range(0, int(common[-1]) + 1 if len(common) else 0, 4096):
            part = (column >= start) & (column < start + 4096)
            dense = np.zeros((len(sets), 4096), np.float32)
            dense[row[part], column[part] - start] = 1
            shared += dense[left] @ dense[right].T
        union = sizes[left][:, None] + sizes[right][None, :] - shared
        linked = (100 * shared >= threshold * union) & (roots[left][:, None] != roots[right][None, :])
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        forest = []
        for i, j in np.argwhere(linked):
            x, y = left[i], right[j]
            a, b = top(int(roots[x])), top(int(roots[y]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                forest.append((nodes[x], nodes[y]))
        return pa.table(
            {
                "a": pa.array([f[0] for f in forest], pa.int64()),
                "b": pa.array([f[1] for f in forest], pa.int64()),
            }
        )

    return check


def links(docs: DataFrame, reps: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Confirmed pairs between nodes (``node``, key of a row with the set, marks, ``n``, ``bands``): enough
    for components.

    Every member of a bucket is first held against its smallest node. Buckets whose members then
    are in one group need no more. The others are cut into blocks of bounded size, and every pair of
    blocks of a bucket is one group of rows in which all pairs of different groups are counted at once;
    it returns the links that join groups. No candidate is left out and no list of pairs is made.
    """
    spread = reps.select("node", "n", F.explode("bands").alias("key"))
    heads = (
        spread.groupBy("key")
        .agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("head"))
        .where("members > 1")
        .select("key", "head")
    )
    buckets = cut(spread.join(heads, "key"))
    used = reps.join(buckets.select("node").distinct(), "node", "left_semi")
    sets = cut(
        docs.select(*row_keys(), "text")
        .join(used.select(*ROW), [*ROW], "left_semi")
        .select("text")
        .mapInArrow(_sets, "mark_a bigint, mark_b bigint, items binary")
        .join(used.select(*MARKS, "node"), [*MARKS])
        .dropDuplicates(["node"])
        .select("node", "items")
    )
    sizes = buckets.select(F.col("node").alias("head"), F.col("n").alias("head_n")).distinct()
    pairs = (
        buckets.where("node > head")
        .select("head", "node", "n")
        .distinct()
        .join(sizes, "head")
        .where(_fits(F.col("n"), F.col("head_n"), threshold))
        .select(F.col("head").alias("a"), F.col("node").alias("b"))
    )
    held = pairs.join(sets.toDF("a", "items_a"), "a").join(sets.toDF("b", "items_b"), "b")
    near = cut(
        held.mapInArrow(_confirmed(threshold), "a bigint, b bigint, linked boolean")
        .where("linked")
        .drop("linked")
    )
    groups = components(near, "a", "b")
    rooted = (
        buckets.drop("head")
        .join(groups.toDF("node", "root"), "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    mixed = (
        rooted.groupBy("key")
        .agg(
            F.min("root").alias("lo"),
            F.max("root").alias("hi"),
            F.ceil(
                F.greatest(8 * F.sum("n") / BLOCK_BYTES, F.count(F.lit(1)) / BLOCK_SETS)
            ).alias("parts"),
        )
        .where("lo < hi")
        .select("key", "parts")
    )
    placed = (
        rooted.join(mixed, "key")
        .withColumn("side", F.pmod(F.xxhash64("node", F.lit("side")), F.col("parts")))
        .join(sets.toDF("node", "items"), "node")
    )
    pair = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1),
        lambda j: F.array(F.least(F.col("side"), j), F.greatest(F.col("side"), j)),
    )
    more = (
        placed.select("key", "node", "root", "side", "items", F.explode(pair).alias("heads"))
        .groupBy("key", "heads")
        .applyInArrow(_merging(threshold), "a bigint, b bigint")
    )
    return near.unionAll(cut(more))


def _numbered(nodes: DataFrame) -> DataFrame | None:
    """``nodes`` with a number of their own as ``node``, if ``doc`` is missing or repeated among them."""
    unclear = nodes.groupBy("doc").count().where("count > 1 or doc is null")
    if unclear.isEmpty():
        return None
    return cut(nodes.withColumn("node", F.monotonically_increasing_id()))


def grouped(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of :func:`near_dup_groups` with ``row_a`` and ``row_b`` (:func:`row_keys`) and the
    fingerprint of the set (``mark_a``, ``mark_b``; null without words)."""
    rows = cut(signatures(docs, threshold))
    full = rows.where("n_shingles > 0")
    # one node for each set: named by the smallest document that has it
    nodes = cut(
        full.groupBy(*MARKS).agg(F.min("doc_id").alias("doc"), F.max("n_shingles").alias("n"))
    )
    numbered = _numbered(nodes)
    nodes = nodes.withColumn("node", F.col("doc")) if numbered is None else numbered
    # a row of that document, whose text is read again for the set
    named = nodes.toDF(*["node_" + c for c in nodes.columns])
    same = [full[c] == named["node_" + c] for c in MARKS]
    held = full.join(named, [*same, full["doc_id"].eqNullSafe(named["node_doc"])])
    reps = (
        held.groupBy(F.col("node_node").alias("node"))
        .agg(F.min(F.struct(*ROW, *MARKS, F.col("node_n").alias("n"), "bands")).alias("row"))
        .select("node", "row.*")
    )
    groups = components(links(docs, reps, threshold), "a", "b")
    rooted = nodes.join(groups.toDF("node", "root"), "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    if numbered is None:
        found = rooted.select(*MARKS, F.col("root").alias("component_id"), F.lit(True).alias("first"))
    else:
        best = rooted.groupBy(F.col("root").alias("best_root")).agg(
            F.min(F.struct(F.col("doc").isNull(), "doc", *MARKS)).alias("best")
        )
        found = rooted.join(best, F.col("root") == F.col("best_root")).select(
            *MARKS,
            F.col("best.doc").alias("component_id"),
            ((F.col("mark_a") == F.col("best.mark_a")) & (F.col("mark_b") == F.col("best.mark_b"))).alias(
                "first"
            ),
        )
    return (
        rows.drop("bands")
        .join(found, [*MARKS], "left")
        .withColumn("component_id", F.coalesce("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id"))))
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            (F.coalesce("first", F.lit(True)) & F.col("doc_id").eqNullSafe(F.col("component_id"))).alias(
                "kept"
            ),
            *ROW,
            *MARKS,
        )
    )


def near_dup_groups(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Size of the shingle set and near-duplicate group of every row: ``doc_id``, ``n_shingles``,
    ``component_id``, ``kept``.

    A set holds the distinct runs of five lower-cased words (fewer words: the whole sequence). Rows
    are linked when 100 * intersection >= ``threshold`` * union; groups are the components of the links and
    named by their smallest ``doc_id``. Rows with equal sets are one node, so a group of copies costs
    one row each and no pairs.

    A null or empty text has no shingle and is linked with nothing. Nodes are sets, not ids: rows that repeat
    a ``doc_id`` with different texts, and rows with a null one, are linked by their texts like all others. A
    group without any ``doc_id`` has a null name. ``kept`` rows have the name of their group as ``doc_id``; if that
    document has several texts in the group, only the text of the smallest fingerprint is kept. Rows that
    repeat id and text are kept together (:func:`drop_near_dups` leaves one). Other columns are ignored.
    """
    return grouped(docs, threshold).select("doc_id", "n_shingles", "component_id", "kept")


def drop_near_dups(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One row of each near-duplicate group, of the smallest ``doc_id``; columns as in ``docs``, none of
    which may be called ``row_a`` or ``row_b``.

    Texts without words are no copies of each other: of those a ``doc_id`` has one row, and rows
    without an id all stay.
    """
    kept = (
        grouped(docs, threshold)
        .where("kept and (n_shingles > 0 or doc_id is not null)")
        .groupBy("doc_id", *MARKS)
        .agg(F.min(F.struct(*ROW)).alias("row"))
        .select("row.*")
        .hint("merge")
    )
    once = Window.partitionBy(*ROW).orderBy(F.lit(0))
    rows = docs.select("*", *row_keys())
    named = (
        rows.join(kept, [*ROW], "left_semi")
        .withColumn("row_b", F.row_number().over(once))
        .where("row_b = 1")
        .select(*docs.columns)
    )
    return named.unionByName(docs.where(F.col("doc_id").isNull() & (word_count(F.col("text")) == 0)))
