"""Exact deduplication by an extendible-hash index (operator 11), DataFrame functions only.

The index lies in Parquet files of the shared folder: one entry per row, addressed by the leading bits of
its text's 64-bit key. Its directory starts small and doubles while a bucket is overfull; only the keys of
overfull buckets are counted again, one bit deeper. A bucket is a range of keys and goes to one owner task,
which chains texts that share a key and tells them apart by their bytes. A key with more rows than a bucket
holds cannot be split by further bits: it gets a chain of its own, dealt over several owners as pages whose
results are added up.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.llm.words import lower_ascii
from flowtables.operators.spread import small
from flowtables.session import stored

# Rows of a bucket; more where the index would have over MAX_BUCKETS of them, so that its directory and its
# list of chains stay small enough for a broadcast at every size.
CAPACITY = 4096
MAX_BUCKETS = 1 << 17
# Doublings beyond the depth that evenly spread keys would need; a bucket still overfull then stays so.
EXTRA_DEPTH = 8
# Stands for a missing id where ids are compared.
FIRST_ID = -(1 << 63)


def _prefix(depth: int) -> Column:
    """The leading bits of a key."""
    return F.shiftrightunsigned("key", 64 - depth)


def _norm() -> Column:
    return lower_ascii(F.coalesce("text", F.lit("")))


def _digest(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


def entries(docs: DataFrame, hashed: Callable[[Column], Column]) -> DataFrame:
    """One index entry per row: its other columns, a number, its key, and the digest that names its text."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return stored(
        docs.select(
            F.struct(*others).alias("doc"),
            F.col("doc_id").cast("bigint").alias("id"),
            F.monotonically_increasing_id().alias("row"),
            hashed(_norm()).alias("key"),
            _digest(_norm()).alias("digest"),
        ),
        "entries",
    )


def directory(keys: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """Directory (slot, bucket, depth) over the stored counts ``keys`` (key, n), and its global depth.

    Buckets of more than ``capacity`` rows are split by their next bit until there is none. Several slots may
    share a bucket, as in any extendible hash.
    """
    rows = keys.agg(F.sum("n")).first()[0] or 0
    depth = max(1, ceil(log2(max(rows, 1) / capacity)) - 1)
    last = min(depth + EXTRA_DEPTH, 63)
    rest, leaves = keys, []
    while True:
        counted = stored(
            rest.groupBy(_prefix(depth).alias("bucket")).agg(F.sum("n").alias("n")), "buckets"
        )
        overfull = F.col("n") > capacity
        if depth == last or not counted.where(overfull).take(1):
            leaves.append((depth, counted))
            break
        leaves.append((depth, counted.where(~overfull)))
        split = small(counted.where(overfull).select("bucket"))
        rest = rest.join(split, _prefix(depth) == F.col("bucket"), "left_semi")
        depth += 1
    slots = None
    for local, buckets in leaves:
        times = 1 << (depth - local)
        first = F.col("bucket") * times
        own = buckets.select(
            F.explode(F.sequence(first, first + (times - 1))).alias("slot"),
            "bucket",
            F.lit(local).alias("depth"),
        )
        slots = own if slots is None else slots.unionAll(own)
    return stored(slots, "directory"), depth


def chains(
    docs: DataFrame, keys: DataFrame, capacity: int, hashed: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """(key, digest, group_size, keep_id) of every distinct text, from the owners of the buckets.

    ``keys`` are the stored counts (key, n) of all rows.
    """
    hot = stored(
        keys.where(F.col("n") > capacity).select(
            "key", F.ceil(F.col("n") / capacity).alias("pages")
        ),
        "hot",
    )
    listed = small(hot, 2 * MAX_BUCKETS)
    slots, depth = directory(stored(keys.join(listed, "key", "left_anti"), "keys"), capacity)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), _norm().alias("norm"))
    texts = texts.select("id", "norm", hashed(F.col("norm")).alias("key"))
    placed = (
        texts.withColumn("slot", _prefix(depth))
        .join(listed, "key", "left")
        .join(small(slots, 8 * MAX_BUCKETS), "slot", "left")
        .select(
            "id",
            "norm",
            "key",
            "pages",
            F.when(F.col("pages").isNull(), F.col("bucket")).otherwise(F.col("key")).alias("place"),
            F.when(F.col("pages").isNull(), F.col("depth")).alias("depth"),
            F.pmod(F.monotonically_increasing_id(), F.coalesce("pages", F.lit(1))).alias("page"),
        )
    )
    owned = placed.repartition("depth", "place", "page")
    # the chain of a key in its bucket: its texts, told apart by their bytes
    links = owned.groupBy("depth", "place", "page", "pages", "key", "norm").agg(
        F.count(F.lit(1)).alias("n"), F.max("id").alias("keep_id")
    )
    links = stored(
        links.select(
            "key",
            _digest(F.col("norm")).alias("digest"),
            "n",
            "keep_id",
            F.when(F.col("pages").isNotNull(), F.col("norm")).alias("norm"),
        ),
        "chains",
    )
    paged = (
        links.where("norm is not null")
        .groupBy("key", "digest", "norm")
        .agg(F.sum("n").alias("n"), F.max("keep_id").alias("keep_id"))
        .drop("norm")
    )
    whole = links.where("norm is null").drop("norm").unionByName(paged)
    return stored(whole.withColumnRenamed("n", "group_size"), "texts")


def exact_groups(
    docs: DataFrame,
    capacity: int = CAPACITY,
    max_buckets: int = MAX_BUCKETS,
    hashed: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """All rows of ``docs`` without ``text``, with ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal if they are identical after lower-casing A-Z; a null text counts as empty. Of the rows of
    equal texts one stays: the one of the largest ``doc_id``, a missing id being smaller than any. Rows that
    repeat text and id are one group, and one of them stays. ``keep_id`` is null if no row of the group has an
    id. ``text_sha256`` is that of the normalised text. Columns of ``docs`` may have any name; those named like
    an added one are replaced. An empty table gives no rows.
    """
    listed = entries(docs, hashed)
    named = stored(
        listed.groupBy("key", "digest").agg(
            F.count(F.lit(1)).alias("n"),
            F.max_by("row", F.coalesce("id", F.lit(FIRST_ID))).alias("keep_row"),
        ),
        "digests",
    )
    keys = stored(named.groupBy("key").agg(F.sum("n").alias("n")), "keys")
    rows = keys.agg(F.sum("n")).first()[0] or 0
    texts = chains(docs, keys, max(capacity, ceil(rows / max_buckets)), hashed)
    if texts.groupBy("key", "digest").count().where("count > 1").take(1):
        raise RuntimeError("two texts of one key have the same SHA-256")
    # written, so that the rows of a hot group can be split in the join below
    groups = stored(texts.join(named.select("key", "digest", "keep_row"), ["key", "digest"]), "groups")
    added = {"keep_id", "group_size", "kept", "text_sha256", "text"}
    return listed.join(groups, ["key", "digest"], "left").select(
        *[F.col(f"doc.`{c}`") for c in docs.columns if c not in added],
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
