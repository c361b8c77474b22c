"""Keyed building blocks that stay balanced when one key holds a large part of the rows.

Window functions put a whole key into one task. ``running`` therefore counts rows per key first
(a column-pruned aggregation) and, only for keys above ``hot_rows``, cuts the key's ordered rows
into range partitions, sums each block and adds the totals of the blocks before it. The result is
the same as that of a plain window.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.session import cut, stored

# Rows of one key that one task sorts comfortably (about 1 GB at a few hundred bytes a row).
HOT_ROWS = 2_000_000
# Longest list put into one row; longer lists continue on the next page.
PAGE_ROWS = 10_000
# Rows of a helper table that may be broadcast (tens of MB); larger ones are shuffled.
BROADCAST_ROWS = 200_000
# Rows that cost about a tenth of a millisecond each and may stay in one task.
DEAL_ROWS = 10_000
# Buckets over which rows that cannot find a partner are spread in a lookup join.
SPREAD = 1024


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a materialised table, if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= rows else df


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt over as many tasks as the session shuffles to, however few bytes they are.

    For rows that become many, or cost much time each: Spark sizes tasks by bytes, so a small table would be
    one task's work.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def dealt_if_many(df: DataFrame, rows: int = DEAL_ROWS) -> DataFrame:
    """:func:`dealt` if there are more than ``rows`` rows, else ``df`` as it is, without a shuffle.

    For tables read from files: a Parquet file is cut between its row groups only, and those hold up to a million
    rows, so a scan may be one task. The rows of plain Parquet are counted from the files' footers.
    """
    return dealt(df) if df.count() > rows else df


def hot_keys(df: DataFrame, key: Sequence[str], hot_rows: int | None) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, or None; at most ``rows / hot_rows`` of them exist."""
    if not hot_rows:
        return None
    heavy = (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
    )
    return cut(heavy) if heavy.take(1) else None


def same_keys(left: DataFrame, right: DataFrame, key: Sequence[str], prefix: str = "_of_"):
    """Right side with prefixed keys and the null-safe condition that joins it."""
    renamed = right.withColumnsRenamed({c: prefix + c for c in key})
    condition = F.lit(True)
    for c in key:
        condition = condition & left[c].eqNullSafe(renamed[prefix + c])
    return renamed, condition


def _total(value: Column, window) -> Column:
    return F.sum(value).over(window)


def running(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str | Column],
    values: dict[str, Column],
    hot_rows: int | None = HOT_ROWS,
    sizes: DataFrame | None = None,
    once: bool = False,
) -> DataFrame:
    """Add running sums per key (nulls form one key); ``order`` should end in a unique column.

    ``sizes`` is an optional cheaper table to count instead of ``df``: it has the key columns and at
    least as many rows per key. With hot keys ``df`` is sampled, cut into blocks and searched for the
    other keys; ``once`` stores it before, for rows that take joins to work out.
    """
    key, order = list(key), list(order)
    window = (
        Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    plain = {name: _total(value, window) for name, value in values.items()}
    hot = hot_keys(df if sizes is None else sizes, key, hot_rows)
    if hot is None:
        return df.withColumns(plain)

    if once:
        df = stored(df, "rows")
    keys, match = same_keys(df, small(hot.drop("_rows")), key, "_hot_")
    cold = df.join(keys, match, "left_anti").withColumns(plain)

    rows = hot.agg(F.sum("_rows")).first()[0]
    pieces = 2 * ceil(rows / hot_rows)
    blocks = cut(
        df.join(keys, match, "left_semi")
        .repartitionByRange(pieces, *key, *order)
        .withColumn("_block", F.spark_partition_id())
    )
    before = Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        blocks.groupBy(*key, "_block")
        .agg(*[F.sum(value).alias("_sum_" + name) for name, value in values.items()])
        .withColumns({"_carry_" + name: _total(F.col("_sum_" + name), before) for name in values})
        .drop(*["_sum_" + name for name in values])
    )
    inside = (
        Window.partitionBy(*key, "_block")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    local = blocks.withColumns({name: _total(value, inside) for name, value in values.items()})
    carried, match = same_keys(local, small(cut(carried)), [*key, "_block"], "_of_")
    joined = local.join(carried, match, "left").withColumns(
        {
            name: F.coalesce(
                F.col(name) + F.col("_carry_" + name), F.col(name), F.col("_carry_" + name)
            )
            for name in values
        }
    )
    return cold.unionByName(joined.select(*cold.columns))


def numbered(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str | Column],
    name: str,
    hot_rows: int | None = HOT_ROWS,
    sizes: DataFrame | None = None,
    once: bool = False,
) -> DataFrame:
    """Row number per key from 1 as bigint; like ``row_number`` but split for hot keys."""
    return running(df, key, order, {name: F.lit(1).cast("bigint")}, hot_rows, sizes, once)


def paged_lists(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    item: Column,
    name: str,
    page_rows: int = PAGE_ROWS,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Collect ``item`` per key in order into lists of at most ``page_rows`` (key, page, list).

    A key with more items continues on page 1, 2, ...: nothing is dropped and no row or task has
    to hold an unbounded list.
    """
    placed = numbered(
        df.select(*key, *order, item.alias("_item")), key, order, "_rn", hot_rows
    ).withColumn("page", F.floor((F.col("_rn") - 1) / page_rows).cast("bigint"))
    packed = F.sort_array(F.collect_list(F.struct("_rn", "_item")))
    return placed.groupBy(*key, "page").agg(
        F.transform(packed, lambda p: p["_item"]).alias(name)
    )


def _hashable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType))


def lookup(
    left: DataFrame,
    right: DataFrame,
    left_key: Sequence[Column | str],
    right_key: Sequence[str],
    take: Sequence[str],
) -> DataFrame:
    """Left join to a table that is unique by ``right_key``; adds the columns ``take``.

    A key given by the name of a column travels once; one given as an expression travels beside its columns.

    Rows whose key is null find nothing. They would all meet in one shuffle partition, so a
    second join key spreads them; matching hot keys are split by the adaptive skew join, which
    may always split the left side here. The partner's second key is always 0, but worked out from
    its key: Catalyst takes a literal out of the join keys, and with it the spreading.
    """
    names = [k if isinstance(k, str) else f"_key{i}" for i, k in enumerate(left_key)]
    copies = {n: k for n, k in zip(names, left_key) if not isinstance(k, str)}
    flat = [f.name for f in left.schema.fields if _hashable(f.dataType)]
    keyed = left.withColumns(copies)
    absent = F.lit(False)
    for name in names:
        absent = absent | F.col(name).isNull()
    keyed = keyed.withColumn(
        "_spread", F.when(absent, F.pmod(F.xxhash64(*flat), F.lit(SPREAD))).otherwise(F.lit(0))
    )
    partner = right.select(
        *[F.col(c).alias(n) for c, n in zip(right_key, names)],
        F.pmod(F.xxhash64(*right_key), F.lit(1).cast("bigint")).alias("_spread"),
        *take,
    )
    joined = keyed.join(partner, [*names, "_spread"], "left")
    if len(copies) < len(names):
        return joined.select(*left.columns, *take)
    return joined.drop(*names, "_spread")
