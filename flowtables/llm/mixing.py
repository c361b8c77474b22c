"""Mixing sources to target weights by distributed prefix sums (operator 5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtables.llm.words import word_count
from flowtables.session import cut

WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
# Words of a source in one range (some 12 MB of text), and the hex digits that may name ranges.
RANGE_WORDS = 2_000_000
DIGITS = (3, 4, 5)


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """Add ``place`` and ``target`` to one row per source (``source``, ``source_size``).

    Sources in code point order, null last, weigh ``weights`` in turn and share the sum of all sizes by
    weight; a target ends at ``most`` times the source's size and the excess is shared again. That is
    the smaller of the cap and one common level times the weight: caps are met in order of cap / weight,
    so the level follows from prefix sums over the sources. One row per source meets in one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy("ratio", "place")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(0, Window.unboundedFollowing)
    everywhere = Window.partitionBy()
    cycle = F.array(*[F.lit(w).cast("bigint") for w in weights])
    ranked = sources.withColumn("place", F.row_number().over(by_name)).select(
        "source",
        "source_size",
        "place",
        F.get(cycle, (F.col("place") - 1) % len(weights)).alias("weight"),
        (F.col("source_size") * most).alias("cap"),
    )
    shared = ranked.withColumn("ratio", F.col("cap").cast("double") / F.col("weight")).select(
        "*",
        F.row_number().over(by_cap).alias("turn"),
        (
            F.sum("source_size").over(everywhere) - F.coalesce(F.sum("cap").over(before), F.lit(0))
        ).alias("rest"),
        F.sum("weight").over(onward).alias("open_weight"),
    )
    open_turn = F.when(
        F.col("ratio") > F.col("rest").cast("double") / F.col("open_weight"),
        F.struct("turn", "rest", "open_weight"),
    )
    level = F.min(open_turn).over(everywhere)
    return shared.withColumn("level", level).select(
        "source",
        "source_size",
        "place",
        F.when(
            F.col("level").isNull() | (F.col("turn") < F.col("level.turn")),
            F.col("cap").cast("double"),
        )
        .otherwise(
            F.col("weight").cast("double") * F.col("level.rest") / F.col("level.open_weight")
        )
        .alias("target"),
    )


def _digits(largest: int | None) -> int:
    """Hex digits of the keys that make a range, for a largest source of so many words."""
    fit = (d for d in DIGITS if (largest or 0) <= RANGE_WORDS * 16**d)
    return next(fit, max(DIGITS))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_EPOCHS,
    seed: str = "mix",
) -> DataFrame:
    """All rows and columns of ``docs`` with ``size``, ``source_size``, ``target`` and ``taken`` (words).

    Every document gets a key from a hash of ``seed`` and its ``doc_id``; a source's documents in key order
    are taken until its budget, the whole part of its target, is used up to the word, over and over if
    the target is above the source's size. The keys are uniform, so their first hex digits cut every
    source into ranges of like size: ranges are summed, the sums before each range are carried into it, and
    a range is sorted by itself. There are 4,096 ranges, and 16 times as many whenever the largest source
    has more than ``RANGE_WORDS`` words for each; ranges never change the result.

    Null text has size 0, a null source is a source of its own (last). A null ``doc_id`` has the key of its
    text; rows that repeat a ``doc_id``, or a text without one, are one key and stay in one range.
    Ties of keys are ordered by id and size, so reruns agree; equal rows may swap. Columns of ``docs`` with
    the names of the added ones are replaced, those of ``working`` dropped.
    """
    added = ("size", "source_size", "target", "taken")
    working = ("_key", "_range", "_place", "_carry", "_source", "_in_range")
    text = F.concat(F.lit("text:"), F.md5(F.coalesce("text", F.lit(""))))
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), text)))
    rows = docs.drop(*added, *working).withColumns({"size": word_count(F.col("text")), "_key": key})
    fine = rows.groupBy("source", F.substring("_key", 1, max(DIGITS)).alias("_range"))
    fine = cut(fine.agg(F.sum("size").alias("range_size")))
    digits = _digits(fine.groupBy("source").agg(F.sum("range_size").alias("n")).agg(F.max("n")).first()[0])
    rows = rows.withColumn("_range", F.substring("_key", 1, digits))
    ranges = fine.groupBy("source", F.substring("_range", 1, digits).alias("_range")).agg(
        F.sum("range_size").alias("range_size")
    )
    sources = targets(
        ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, most
    )
    before = (
        Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = ranges.withColumn(
        "_carry", F.coalesce(F.sum("range_size").over(before), F.lit(0))
    ).join(
        sources.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))
    )
    carried = cut(
        carried.select(
            F.col("source").alias("_source"),
            F.col("_range").alias("_in_range"),
            "_carry",
            "source_size",
            "target",
            F.col("place").alias("_place"),
        )
    )
    inside = (
        Window.partitionBy("_place", "_range")
        .orderBy("_key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    budget = F.floor("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size"))
    left = budget - F.coalesce(epochs, F.lit(0)) * F.col("source_size")
    start = F.col("_carry") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    joined = rows.join(
        carried,
        rows["source"].eqNullSafe(carried["_source"]) & (rows["_range"] == carried["_in_range"]),
    )
    return joined.withColumn(
        "taken",
        F.col("size") * F.coalesce(epochs, F.lit(0))
        + F.greatest(F.lit(0), F.least(F.col("size"), left - start)),
    ).drop(*working)
