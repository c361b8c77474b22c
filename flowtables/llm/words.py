"""Words, shingles and set fingerprints of whole texts, as Spark columns and as numpy arrays.

A word is a longest run of characters other than U+0020 and U+0009 to U+000D. The numpy side works
on the UTF-8 bytes of an Arrow string column, all rows of a batch at once: a word's hash is a
polynomial in its bytes, taken from running sums, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Bytes of text hashed at once, and bytes of text put into one block of rows.
PIECE = 1 << 19
BLOCK = 2 << 20
# Rows sent to Python at once: a few MB of usual texts, where Spark's own 10,000 would be tens of them.
BATCH_ROWS = 512
WIDTH = 5


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on sends at most ``BATCH_ROWS`` rows to Python at once."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def word_list(text: Column) -> Column:
    """Words of a text in order; no words for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and all other characters as they are."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing (SplitMix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def keys(n: int, seed: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit numbers that depend on ``seed`` only."""
    step = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * step)


def byte_tables(fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """Random number and is-part-of-a-word flag per byte; ``fold`` maps A-Z to a-z."""
    codes = np.arange(256)
    inside = ~((codes == 32) | ((codes >= 9) & (codes <= 13)))
    if fold:
        codes = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    return keys(256, 7)[codes], inside


def blocks(batch: pa.RecordBatch, column: str, size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``size`` bytes of text; a longer text is a slice alone."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + size, "right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the offsets of the rows in them; null counts as empty."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    buffers, n = column.buffers(), len(column)
    if n == 0 or buffers[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + n + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def hash_words(column: pa.Array, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows in order, and the number of words of each row."""
    data, offsets = text_bytes(column)
    table, inside = byte_tables(fold)
    base = np.uint64(0xD6E8FEB86659FD93)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    longest = min(PIECE, max(len(data), 1))
    power = unpower = np.ones(0, np.uint64)
    hashes, places, start = [], [], 0
    while start < len(data):
        stop, size = min(start + PIECE, len(data)), PIECE
        while stop < len(data):  # cut after a gap or between rows, whatever the length of a word
            gaps = np.flatnonzero(~inside[data[start:stop]])
            edge = offsets[np.searchsorted(offsets, stop, "right") - 1]
            cut = max(start + gaps[-1] + 1 if len(gaps) else start, edge)
            if cut > start:
                stop = cut
                break
            size *= 2
            stop = min(start + size, len(data))
        n = stop - start
        if len(power) < n:
            longest = max(longest, n)
            power = np.full(longest, base)
            unpower = np.full(longest, inverse)
            power[0] = unpower[0] = 1
            np.multiply.accumulate(power, out=power)
            np.multiply.accumulate(unpower, out=unpower)
        piece = data[start:stop]
        word = inside[piece]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        rows = offsets[np.searchsorted(offsets, start, "right") : np.searchsorted(offsets, stop)]
        rows = rows - start
        first[rows] |= word[rows]
        last[rows - 1] |= word[rows - 1]
        begin, end = np.flatnonzero(first), np.flatnonzero(last)
        sums = table[piece]
        sums *= power[:n]
        np.cumsum(sums, out=sums)
        value = sums[end]
        value[1:] -= sums[begin[1:] - 1]
        if len(begin) and begin[0] > 0:
            value[:1] -= sums[begin[0] - 1]
        hashes.append(mix(value * unpower[begin] + (end - begin + 1).astype(np.uint64)))
        places.append(begin + start)
        start = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(column), np.int64)
    at = np.concatenate(places)
    return np.concatenate(hashes), np.diff(np.searchsorted(at, offsets))


def shingles(
    hashes: np.ndarray, counts: np.ndarray, width: int = WIDTH
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words per row, in order, and their number per row.

    A row with fewer words has its whole sequence as one shingle; a row without words has none.
    """
    factor = keys(width, 11) | np.uint64(1)
    starts = np.cumsum(counts) - counts
    total = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out = np.zeros(int(total.sum()), np.uint64)
    to = np.cumsum(total) - total
    full = counts >= width
    if full.any():
        n = len(hashes) - width + 1
        rolled = hashes[:n] * factor[0]
        for k in range(1, width):
            rolled += hashes[k : n + k] * factor[k]
        inner = np.ones(n, bool)
        ends = (starts + counts)[counts > 0]
        for k in range(1, width):
            at = ends - k
            inner[at[(at >= 0) & (at < n)]] = False
        # rows shorter than the width have no complete run inside them
        target = np.ones(len(out), bool)
        target[to[(counts > 0) & ~full]] = False
        out[target] = rolled[inner]
    for n in range(1, width):
        rows = np.flatnonzero(counts == n)
        if len(rows):
            value = np.full(len(rows), np.uint64(n))
            for k in range(n):
                value += hashes[starts[rows] + k] * factor[k]
            out[to[rows]] = value
    return mix(out), total


def distinct_sets(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, concatenated, and their number per row."""
    ends = np.cumsum(counts)
    sets = [np.unique(values[e - c : e]) for e, c in zip(ends, counts)]
    sizes = np.fromiter((len(s) for s in sets), np.int64, len(sets))
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), sizes


def shingle_sets(column: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of lower-cased whole texts: sorted per row, concatenated, with sizes."""
    return distinct_sets(*shingles(*hash_words(column), width))


def segment_sum(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments; empty segments give 0."""
    running = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    ends = np.cumsum(counts)
    return running[ends] - running[ends - counts]
