"""Collision-free short names and the nested dependency tables they are stored in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.operators.spread import HOT_ROWS, PAGE_ROWS, numbered


def short_name(column: Column) -> Column:
    """Last dotted segment of a type name."""
    return F.substring_index(F.rtrim(column, F.lit(".")), ".", -1)


def canonical_names(
    df: DataFrame,
    scope: Sequence[str],
    type_column: str,
    identity: Sequence[str],
    ord_columns: Sequence[str],
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """One row per distinct (scope, type, identity) with its name in that scope.

    The first one met in ``ord_columns`` order keeps the short name, the k-th further one gets
    ``name#k``. Repeats are merged before any row is numbered.
    """
    # one plain column keeps the aggregation hash-based; a struct would have to be sorted
    first = F.col(ord_columns[0]) if len(ord_columns) == 1 else F.struct(*ord_columns)
    distinct = df.groupBy(*scope, type_column, *identity).agg(F.min(first).alias("_first"))
    shorted = distinct.withColumn("short", short_name(F.col(type_column)))
    placed = numbered(
        shorted, [*scope, "short"], ["_first", type_column, *identity], "_rn", hot_rows
    )
    suffix = F.when(F.col("_rn") > 1, F.concat(F.lit("#"), (F.col("_rn") - 1).cast("string")))
    return placed.withColumn("name", F.concat("short", F.coalesce(suffix, F.lit("")))).drop(
        "_rn", "_first"
    )


def attach_names(
    df: DataFrame, names: DataFrame, scope: Sequence[str], type_column: str, identity: Sequence[str]
) -> DataFrame:
    """Add ``name`` to every component by its identity; nulls in the identity match nulls."""
    key = [*scope, type_column, *identity]
    table = names.select(*[F.col(c).alias("_n_" + c) for c in key], "name")
    match = F.lit(True)
    for c in key:
        match = match & F.col(c).eqNullSafe(F.col("_n_" + c))
    return df.join(table, match, "left").drop(*["_n_" + c for c in key])


def nest(
    df: DataFrame,
    scope: Sequence[str],
    levels: Sequence[str],
    value: str,
    name: str = "tree",
    page_rows: int = PAGE_ROWS,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Nested map per scope, keys sorted on every level: (scope, page, tree).

    A repeated path keeps its greatest value. A scope with more than ``page_rows`` entries goes on
    in further pages in key order, so that no row holds an unbounded map.
    """
    scope, levels = list(scope), list(levels)
    paths = df.groupBy(*scope, *levels).agg(F.max(value).alias("_value"))
    current = numbered(paths, scope, levels, "_rn", hot_rows).withColumn(
        "page", F.floor((F.col("_rn") - 1) / page_rows).cast("bigint")
    )
    for depth in range(len(levels) - 1, -1, -1):
        # ordered by key alone: the values of outer levels are maps, which have no order
        entries = F.array_sort(
            F.collect_list(F.struct(F.col(levels[depth]).alias("k"), "_value")),
            lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0),
        )
        current = current.groupBy(*scope, "page", *levels[:depth]).agg(
            F.map_from_entries(entries).alias("_value")
        )
    return current.withColumnRenamed("_value", name)


def unnest(
    df: DataFrame, scope: Sequence[str], tree: str, levels: Sequence[str], value: str
) -> DataFrame:
    """Rows of a nested map, one column per level; the inverse of :func:`nest`."""
    current = df.select(*scope, F.col(tree).alias("_value"))
    for depth, level in enumerate(levels):
        current = current.select(
            *scope, *levels[:depth], F.explode("_value").alias(level, "_value")
        )
    return current.withColumnRenamed("_value", value)


def flat_names(
    df: DataFrame, scope: Sequence[str], tree: str, levels: Sequence[str], value: str
) -> DataFrame:
    """Names of the innermost level with their value: (scope..., name, ``value``, ``copies``).

    A name found under several paths stands for the last of them in path order; ``copies`` is the number of
    paths, so repeated names are those with more than one.
    """
    *outer, name = levels
    rows = unnest(df, scope, tree, levels, value).withColumn("_path", F.struct(*outer))
    return last_by(rows, [*scope, name], "_path", [value])


def last_by(
    df: DataFrame, key: Sequence[str], ord_column: str, values: Sequence[str]
) -> DataFrame:
    """Last row per key by ``ord_column`` with the number of rows it stands for (``copies``).

    Combined map-side, so a key repeated many times does not gather in one task.
    """
    return (
        df.groupBy(*key)
        .agg(
            F.max_by(F.struct(*values), F.struct(ord_column, *values)).alias("_last"),
            F.count(F.lit(1)).alias("copies"),
        )
        .select(*key, "_last.*", "copies")
    )
