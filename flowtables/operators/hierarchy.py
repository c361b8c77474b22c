"""Expansion of the group tree.

The first levels are taken one by one. Deeper trees go on by path doubling: segments of 1, 2, 4, ... links are
joined with themselves, and all places above a depth m with the segments of m links give those down to 2 m, so
rounds grow with the logarithm of the depth.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.operators.spread import lookup
from flowtables.session import cut, stored

# Places of one level that may be broadcast; each carries its path, of a few levels.
BROADCAST_PLACES = 20_000
# Levels taken one by one before paths are doubled.
LEVELS = 4


def _longer(links: DataFrame, scope: list[str], length: int) -> DataFrame:
    """Segments (scope..., top, bottom, ids, ords) of ``length`` links without an id twice."""
    segments = links.select(
        *scope,
        F.col("parent_id").alias("top"),
        F.col("_child").alias("bottom"),
        F.array("_child").alias("ids"),
        F.array("_ord").alias("ords"),
    ).where("top <> bottom")
    done = 1
    while done < length:
        segments, done = _doubled(segments, scope), 2 * done
    return segments


def _doubled(segments: DataFrame, scope: list[str]) -> DataFrame:
    """Segments of twice as many links, written to the shared folder."""
    lower = segments.select(
        *scope,
        F.col("top").alias("bottom"),
        F.col("bottom").alias("_end"),
        F.col("ids").alias("_ids"),
        F.col("ords").alias("_ords"),
    )
    joined = segments.join(lower, [*scope, "bottom"]).where(
        ~F.arrays_overlap("ids", "_ids") & ~F.array_contains("_ids", F.col("top"))
    )
    return stored(
        joined.select(
            *scope,
            "top",
            F.col("_end").alias("bottom"),
            F.concat("ids", "_ids").alias("ids"),
            F.concat("ords", "_ords").alias("ords"),
        ),
        "segments",
    )


def expand_hierarchy(
    refs: DataFrame,
    roots: DataFrame,
    scope: Sequence[str] = (),
    nodes: DataFrame | None = None,
    max_depth: int | None = None,
) -> DataFrame:
    """Rows (scope..., id, parent_id, depth, path, ords, status) of every place in the tree.

    ``refs`` (scope..., parent_id, id, ord) says which group contains which; ``roots`` (scope...,
    id) where to begin; ``nodes`` (scope..., id) which ids exist. ``ords`` is the position on
    every level, so sorting by it gives the depth-first order.

    ``status`` is ``ok``, ``cycle`` (the id is already on its own path), ``missing`` (not in
    ``nodes``) or ``depth`` (below ``max_depth``, if one is given); only ``ok`` places are expanded further, the
    others are kept as a report. Each of the first ``LEVELS`` levels is one join of the last level with
    ``refs``, deeper ones are found by doubling; every round is written to the shared folder once and never
    collected.
    """
    scope = list(scope)
    # written once: every level reads them again
    links = cut(
        refs.where("parent_id is not null").select(
            *scope,
            F.col("parent_id"),
            F.col("id").alias("_child"),
            F.col("ord").cast("bigint").alias("_ord"),
        )
    )
    level = cut(
        roots.select(
            *scope,
            F.col("id"),
            F.lit(None).cast(roots.schema["id"].dataType).alias("parent_id"),
            F.lit(0).alias("depth"),
            F.array("id").alias("path"),
            F.array().cast("array<bigint>").alias("ords"),
            F.lit("ok").alias("status"),
        )
    )
    names = level.columns

    def status(depth: Column) -> Column:
        found = F.when(F.array_contains("path", F.col("_child")), "cycle")
        if max_depth is not None:
            found = found.when(depth > max_depth, "depth")
        return found.otherwise("ok")

    def children(places: DataFrame) -> DataFrame:
        above = places.select(*scope, F.col("id").alias("parent_id"), "depth", "path", "ords")
        return links.join(above, [*scope, "parent_id"]).select(
            *scope,
            F.col("_child").alias("id"),
            "parent_id",
            (F.col("depth") + 1).alias("depth"),
            F.array_append("path", F.col("_child")).alias("path"),
            F.array_append("ords", F.col("_ord")).alias("ords"),
            status(F.col("depth") + 1).alias("status"),
        )

    levels, rows = [level], 1
    for _ in range(1, LEVELS):
        open_places = level.where("status = 'ok'")
        rows = open_places.count()
        if rows == 0:
            break
        level = cut(children(F.broadcast(open_places) if rows <= BROADCAST_PLACES else open_places))
        levels.append(level)
    places = reduce(DataFrame.unionByName, levels)
    if rows and level.where("status = 'ok'").take(1):
        places = _deeper(places, links, scope, max_depth, children).select(*names)
    if nodes is None:
        return places
    known = nodes.select(*scope, "id").distinct().withColumn("_known", F.lit(True))
    return (
        lookup(places, known, [F.col(c) for c in [*scope, "id"]], [*scope, "id"], ["_known"])
        .withColumn(
            "status",
            F.when(F.col("_known").isNull() & (F.col("status") == "ok"), "missing").otherwise(
                F.col("status")
            ),
        )
        .drop("_known")
    )


def _deeper(places, links, scope, max_depth, children) -> DataFrame:
    """All places of a tree whose first ``LEVELS`` levels are ``places``."""
    known = [places.where("status = 'ok'")]
    reported = [places.where("status <> 'ok'")]
    segments, length = _longer(links, scope, LEVELS), LEVELS
    while max_depth is None or length <= max_depth:
        above = reduce(DataFrame.unionByName, known).withColumnRenamed("id", "top")
        joined = above.join(
            segments.withColumnsRenamed({"ids": "_ids", "ords": "_ords"}), [*scope, "top"]
        ).where(~F.arrays_overlap("path", "_ids"))
        further = joined.select(
            *scope,
            F.col("bottom").alias("id"),
            F.coalesce(F.get("_ids", F.lit(length - 2)), "top").alias("parent_id")
            if length > 1
            else F.col("top").alias("parent_id"),
            (F.col("depth") + length).alias("depth"),
            F.concat("path", "_ids").alias("path"),
            F.concat("ords", "_ords").alias("ords"),
            "status",
        )
        if max_depth is not None:
            further = further.where(F.col("depth") <= max_depth)
        further = stored(further, "places")
        if not further.take(1):
            break
        known.append(further)
        segments, length = _doubled(segments, scope), 2 * length
    whole = reduce(DataFrame.unionByName, known)
    # what is not expanded, below the levels that were taken one by one
    below = children(whole.where(F.col("depth") >= LEVELS - 1)).where("status <> 'ok'")
    return reduce(DataFrame.unionByName, [whole, *reported, below])
