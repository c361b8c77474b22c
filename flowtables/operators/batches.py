"""Batches closed by the first of several limits (rows, bytes, fixed time windows).

Where a batch ends depends on where it began, so a unit (key and window) has to be read in order.
Usual units are read once, with constant state. A unit too large for one task is cut into blocks of
consecutive rows instead. What a block does to the batch that is open before it is a step function of
one number: with a row limit, how far into the block the next batch begins (at most ``count`` rows);
without one, the bytes the open batch holds already (less than ``limit``). A block's function has few
steps, no more than a batch has rows; functions of neighbouring blocks are joined into one, ``FAN`` at a
time, up to one for the unit, and then the true beginning is handed down the same tree to every block.
So no task holds more than ``FAN`` functions, and the blocks number their rows independently.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.operators.spread import hot_keys, numbered, small
from flowtables.session import cut

BLOCK_ROWS = 200_000
# Blocks, or groups of them, that are joined into one step function at a time.
FAN = 16
STEPS = "_unit string, _node long, _lo long, _hi long, _slope long, _out long, _batches long"


def _unit_text(unit: Sequence[str]):
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in unit]
    return F.concat_ws("\x1f", *parts)


def close_batches(
    df: DataFrame,
    unit: Sequence[str],
    order: Sequence[str],
    size: str,
    count: int | None,
    limit: int | None,
    hot_rows: int | None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``batch``, numbered from 0 per unit; ``size`` is a bigint column without negatives."""
    hot = hot_keys(df, unit, hot_rows) if count or limit else None
    if hot is None:
        return _in_turn(df, unit, order, size, count, limit)
    keys = small(hot.select(_unit_text(unit).alias("_unit")))
    marked = df.withColumn("_unit", _unit_text(unit))
    cold = _in_turn(marked.join(keys, "_unit", "left_anti").drop("_unit"), unit, order, size, count, limit)
    large = marked.join(keys, "_unit", "left_semi")
    # with a row limit a batch must not reach over a whole block
    rows = max(block_rows, 4 * count) if count else block_rows
    split = _in_blocks(large, order, size, count, limit, hot_rows, rows)
    return cold.unionByName(split.drop("_unit").select(*cold.columns))


def _in_turn(df, unit, order, size, count, limit):
    """Sorted rows of each unit read once; only the open batch is carried along."""
    prepared = df.withColumns({"_unit": _unit_text(unit), "batch": F.lit(0).cast("bigint")})
    at_column = prepared.columns.index("batch")

    def close(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, number, rows, held = None, 0, 0, 0
        for piece in pieces:
            units = piece["_unit"].to_pandas().to_numpy()
            sizes = piece[size].to_numpy()
            edges = np.flatnonzero(units[1:] != units[:-1]) + 1 if len(units) else []
            numbers = np.empty(len(units), np.int64)
            for begin, end in zip([0, *edges], [*edges, len(units)]):
                if begin == end:
                    continue
                if units[begin] != current:
                    current, number, rows, held = units[begin], 0, 0, 0
                filled, at = np.concatenate([[0], np.cumsum(sizes[begin:end])]), 0
                while at < end - begin:
                    # the row that closes the open batch, of which some rows may be in earlier pieces
                    stop = at + count - rows if count else len(filled)
                    if limit:
                        full = np.searchsorted(filled[at + 1 :], filled[at] + limit - held, "left")
                        stop = min(stop, at + 1 + int(full))
                    last = min(stop, end - begin)
                    numbers[begin + at : begin + last] = number
                    if stop <= end - begin:
                        number, rows, held = number + 1, 0, 0
                    else:
                        rows, held = rows + last - at, held + int(filled[last] - filled[at])
                    at = last
            yield piece.set_column(at_column, "batch", pa.array(numbers))

    return (
        prepared.repartition(*unit)
        .sortWithinPartitions("_unit", *order)
        .mapInArrow(close, prepared.schema)
        .drop("_unit")
    )


def _next_starts(sizes: np.ndarray, count: int | None, limit: int | None) -> np.ndarray:
    """For a batch that begins at each row, the row at which the next one begins; behind all rows if open."""
    ends = np.arange(len(sizes)) + (count or len(sizes) + 1)
    if limit:
        filled = np.concatenate([[0], np.cumsum(sizes)])
        full = np.searchsorted(filled, filled[:-1] + limit, side="left")
        ends = np.minimum(ends, full)
    return ends


def _followed(leave: np.ndarray, batches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps from place to place followed to their end, with the batches on the way."""
    while (leave[leave] != leave).any():
        # every round doubles the batches jumped over
        batches, leave = batches + batches[leave], leave[leave]
    return leave, batches


def _merged(lo, hi, slope, out, batches) -> list[np.ndarray]:
    """Steps in order without empty ones, neighbours with the same result joined."""
    order = np.argsort(lo, kind="stable")
    order = order[(hi > lo)[order]]
    lo, hi, slope, out, batches = (c[order] for c in (lo, hi, slope, out, batches))
    new = np.ones(len(lo), bool)
    new[1:] = (slope[1:] != slope[:-1]) | (out[1:] != out[:-1]) | (batches[1:] != batches[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(lo)) - 1
    return [lo[first], hi[last], slope[first], out[first], batches[first]]


def _steps_by_place(
    sizes: np.ndarray, rows: int, count: int, limit: int | None, block_rows: int
) -> list[np.ndarray]:
    """Step function of a block: the first batch begins at row x of it -> the same of the next block."""
    following = _next_starts(sizes, count, limit)[:rows]
    places = max(int(following.max()), rows, count) + 1
    leave, batches = np.arange(places), np.zeros(places, dtype=np.int64)
    leave[:rows], batches[:rows] = following, 1
    leave, batches = _followed(leave, batches)
    x = np.arange(count)
    return _merged(x, x + 1, np.zeros(count, np.int64), leave[:count] - block_rows, batches[:count])


def _steps_by_bytes(sizes: np.ndarray, limit: int) -> list[np.ndarray]:
    """Step function of a block: bytes in the open batch -> the same behind the block.

    The more bytes it holds, the earlier the row that closes it; behind that row all is fixed. If the whole
    block does not close it, the bytes of the block are added (slope 1).
    """
    rows, filled = len(sizes), np.concatenate([[0], np.cumsum(sizes)])
    following = _next_starts(sizes, None, limit)
    closes = following <= rows
    leave, batches = np.arange(rows + 1), np.zeros(rows + 1, dtype=np.int64)
    leave[:rows][closes], batches[:rows][closes] = following[closes], 1
    leave, batches = _followed(leave, batches)
    # places behind the rows that may close the open batch, by what it holds
    behind = np.arange(1, min(int(np.searchsorted(filled[1:], limit)) + 1, rows) + 1)
    lo, hi = np.maximum(limit - filled[behind], 0), limit - filled[behind - 1]
    out, closed = filled[-1] - filled[leave[behind]], 1 + batches[behind]
    whole = [[0], [limit - filled[-1]], [1], [filled[-1]], [0]] if filled[-1] < limit else [[]] * 5
    parts = [lo, hi, np.zeros(len(lo), np.int64), out, closed]
    return _merged(*[np.concatenate([np.array(w, np.int64), p]) for w, p in zip(whole, parts)])


def _composed(first: list[np.ndarray], second: list[np.ndarray]) -> list[np.ndarray]:
    """The step function that applies ``first`` and then ``second``."""
    lo, hi, slope, out, batches = first
    lo2, hi2, slope2, out2, batches2 = second

    fixed = slope == 0
    at = np.clip(np.searchsorted(lo2, out[fixed], "right") - 1, 0, len(lo2) - 1)
    parts = [
        [
            lo[fixed],
            hi[fixed],
            np.zeros(len(at), np.int64),
            out2[at] + slope2[at] * out[fixed],
            batches[fixed] + batches2[at],
        ]
    ]
    for i in np.flatnonzero(~fixed):
        more = out[i]
        parts.append(
            [
                np.maximum(lo[i], lo2 - more),
                np.minimum(hi[i], hi2 - more),
                slope2,
                out2 + slope2 * more,
                batches[i] + batches2,
            ]
        )
    return _merged(*[np.concatenate(c) for c in zip(*parts)])


def _functions(table: pa.Table) -> list[tuple[int, list[np.ndarray]]]:
    """(node, step function) in order of the nodes."""
    table = table.sort_by([("_node", "ascending"), ("_lo", "ascending")])
    nodes = table["_node"].to_numpy()
    columns = [table[c].to_numpy() for c in ("_lo", "_hi", "_slope", "_out", "_batches")]
    edges = [0, *(np.flatnonzero(nodes[1:] != nodes[:-1]) + 1), len(nodes)]
    return [(int(nodes[a]), [c[a:b] for c in columns]) for a, b in zip(edges, edges[1:])]


def _step_table(unit: str | None, node: int, steps: list[np.ndarray]) -> pa.Table:
    n = len(steps[0])
    return pa.table(
        {
            "_unit": pa.array([unit] * n, pa.string()),
            "_node": pa.array(np.full(n, node, np.int64)),
            **{c: pa.array(v) for c, v in zip(("_lo", "_hi", "_slope", "_out", "_batches"), steps)},
        }
    )


def _join_neighbours(table: pa.Table) -> pa.Table:
    functions = _functions(table)
    steps = functions[0][1]
    for _, behind in functions[1:]:
        steps = _composed(steps, behind)
    return _step_table(table["_unit"][0].as_py(), functions[0][0] // FAN, steps)


def _hand_down(table: pa.Table) -> pa.Table:
    """Beginning and first batch number of each node below one whose own are known."""
    x, number = table["_begin"][0].as_py(), table["_first"][0].as_py()
    found = []
    for node, (lo, _, slope, out, batches) in _functions(table):
        found.append((node, x, number))
        at = max(int(np.searchsorted(lo, x, "right")) - 1, 0)
        x, number = int(out[at] + slope[at] * x), number + int(batches[at])
    nodes, begins, firsts = (pa.array(c, pa.int64()) for c in zip(*found))
    units = pa.array([table["_unit"][0].as_py()] * len(found), pa.string())
    return pa.table({"_unit": units, "_node": nodes, "_begin": begins, "_first": firsts})


def _beginnings(steps: DataFrame, blocks: int) -> DataFrame:
    """Per unit and block: ``_begin``, the argument of its step function, and its first batch number."""
    levels = [steps]
    while blocks > 1:
        above = F.floor(F.col("_node") / FAN).cast("bigint")
        joined = levels[-1].groupBy("_unit", above).applyInArrow(_join_neighbours, STEPS)
        levels.append(cut(joined))
        blocks = -(-blocks // FAN)
    known = levels.pop().select(
        "_unit", "_node", F.lit(0).cast("bigint").alias("_begin"), F.lit(0).cast("bigint").alias("_first")
    ).distinct()
    for level in reversed(levels):
        above = level.withColumn("_above", F.floor(F.col("_node") / FAN).cast("bigint"))
        known = (
            above.join(known.withColumnRenamed("_node", "_above"), ["_unit", "_above"])
            .groupBy("_unit", "_above")
            .applyInArrow(_hand_down, "_unit string, _node long, _begin long, _first long")
        )
    return known


def _in_blocks(df, order, size, count, limit, hot_rows, block_rows):
    placed = numbered(df, ["_unit"], order, "_rn", hot_rows).withColumns(
        {
            "_block": F.floor((F.col("_rn") - 1) / block_rows).cast("bigint"),
            "_at": F.pmod(F.col("_rn") - 1, F.lit(block_rows)).cast("bigint"),
        }
    )
    # written once: row numbers must not change between the steps below
    placed = cut(placed)
    places = [F.struct(F.col("_block").alias("_block"), F.col("_at").alias("_at"))]
    if count:
        # the first rows of a block are also shown to the block before, in which a batch may begin
        # that ends among them
        before = F.struct((F.col("_block") - 1).alias("_block"), (F.col("_at") + block_rows).alias("_at"))
        places.append(F.when((F.col("_at") < count) & (F.col("_block") > 0), before))
    seen = placed.select("_unit", F.inline(F.array_compact(F.array(*places))), F.col(size).alias("_size"))

    def ordered(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
        table = table.sort_by("_at")
        return table, table["_size"].to_numpy()

    def summed_up(table: pa.Table) -> pa.Table:
        table, sizes = ordered(table)
        if count:
            steps = _steps_by_place(sizes, min(len(sizes), block_rows), count, limit, block_rows)
        else:
            steps = _steps_by_bytes(sizes, limit)
        return _step_table(table["_unit"][0].as_py(), table["_block"][0].as_py(), steps)

    steps = cut(seen.groupBy("_unit", "_block").applyInArrow(summed_up, STEPS))
    blocks = (placed.agg(F.max("_block")).first()[0] or 0) + 1
    begins = _beginnings(steps, blocks).withColumnRenamed("_node", "_block")
    # the block's own rows are numbered with the same look ahead as before
    shown = seen.join(begins, ["_unit", "_block"])

    def number_rows(table: pa.Table) -> pa.Table:
        table, sizes = ordered(table)
        following = _next_starts(sizes, count, limit)
        rows = min(len(sizes), block_rows)
        start, number = table["_begin"][0].as_py(), table["_first"][0].as_py()
        if count:
            numbers = np.full(rows, number - 1, dtype=np.int64)
        else:
            # the batch that is open before the block goes on to the row that fills it
            numbers = np.full(rows, number, dtype=np.int64)
            start, number = int(np.searchsorted(np.cumsum(sizes), limit - start)) + 1, number + 1
        while start < rows:
            numbers[start : following[start]] = number
            start, number = following[start], number + 1
        own = table.slice(0, rows)
        return pa.table(
            {
                "_unit": own["_unit"],
                "_block": own["_block"],
                "_at": own["_at"],
                "batch": pa.array(numbers),
            }
        )

    numbers = shown.groupBy("_unit", "_block").applyInArrow(
        number_rows, "_unit string, _block long, _at long, batch long"
    )
    return placed.join(numbers, ["_unit", "_block", "_at"]).drop("_rn", "_block", "_at")
