"""Operations on the records that pass through a flow: routing, order, expiry, batches, state."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.functions.values import stable_uuid
from flowtables.operators.batches import close_batches
from flowtables.operators.rules import condition_column
from flowtables.operators.spread import HOT_ROWS, numbered, running

# Routing --------------------------------------------------------------------------------------

# Tasks in which a queue's first rows meet before its last one.
SALTS = 16


def route(
    df: DataFrame,
    relationship: str,
    edges: DataFrame,
    edge: str = "edge_id",
    relationships: str = "relationships",
    terminated: Sequence[str] = (),
) -> DataFrame:
    """One copy of a row per edge whose relationship list holds the row's relationship.

    A relationship no edge has, or that is terminated, ends there. The edge list is a small table
    that Catalyst broadcasts by its size; a larger one is shuffled with an adaptive skew split.
    """
    exits = edges.select(F.col(edge), F.explode(relationships).alias(relationship)).distinct()
    if terminated:
        exits = exits.where(~F.col(relationship).isin(*terminated))
    return df.join(exits, relationship)


def funnel(inputs: Mapping[str, DataFrame], tag: str | None = None) -> DataFrame:
    """Many inputs to one output, duplicates kept; ``tag`` adds the name of the input."""
    frames = [df.withColumn(tag, F.lit(n)) if tag else df for n, df in inputs.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


@dataclass(frozen=True)
class FlowGroup:
    """Reusable part of a flow: named input ports to named output ports."""

    inputs: Sequence[str]
    outputs: Sequence[str]
    body: Callable[[Mapping[str, DataFrame]], Mapping[str, DataFrame]]

    def apply(self, **frames: DataFrame) -> dict[str, DataFrame]:
        if set(frames) != set(self.inputs):
            raise ValueError(f"inputs are {sorted(self.inputs)}, given {sorted(frames)}")
        made = self.body(frames)
        if set(made) != set(self.outputs):
            raise ValueError(f"outputs are {sorted(self.outputs)}, made {sorted(made)}")
        return dict(made)


# Order and expiry -----------------------------------------------------------------------------


def prioritized(
    df: DataFrame, queue: Sequence[str], order: Sequence[str | Column], k: int | None = None
) -> DataFrame:
    """Place of each row in its queue (``place`` from 1); with ``k`` only the first ones.

    ``order`` is the chain of prioritisers and ends in a unique column. For a small ``k`` every task
    keeps its own first ``k`` before the exchange (window group limit, which Spark applies up to its
    threshold), and these meet in ``SALTS`` tasks per queue first, so that a hot queue brings ``k`` rows for each
    of those to its last task, however many tasks have read it. A larger ``k``, and the full order, split
    hot queues instead.
    """
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if k is None or k > threshold:
        placed = numbered(df, queue, order, "place")
        return placed if k is None else placed.where(F.col("place") <= k)
    salted = df.withColumn("_salt", F.spark_partition_id() % SALTS)
    for key in ([*queue, "_salt"], queue):
        window = Window.partitionBy(*key).orderBy(*order)
        salted = salted.withColumn("place", F.row_number().over(window)).where(F.col("place") <= k)
    return salted.withColumn("place", F.col("place").cast("bigint")).drop("_salt")


def expire(df: DataFrame, ts: str, ttl_seconds: Column | float, as_of: Column) -> DataFrame:
    """Rows not older than the time to live at ``as_of``; 0 or null means for ever.

    A row without a timestamp has no age and is kept. A literal limit becomes a comparison with a
    constant that reaches the scan.
    """
    if not isinstance(ttl_seconds, Column):
        if not ttl_seconds:
            return df
        limit = as_of - F.make_dt_interval(secs=F.lit(float(ttl_seconds)))
        return df.where(F.col(ts).isNull() | (F.col(ts) >= limit))
    limit = as_of - F.make_dt_interval(secs=F.nullif(ttl_seconds, F.lit(0.0)))
    return df.where(F.coalesce(F.col(ts) >= limit, F.lit(True)))


# Balance --------------------------------------------------------------------------------------


def balance(df: DataFrame, n: int, attribute: str | None = None, parts: int = 1) -> DataFrame:
    """Spread rows over ``n`` partitions, those of one attribute value together.

    A value too large for one partition is spread over ``parts`` by a hash of the row; the column ``part``
    then tells which of them a row is in, and rows of one value and part are together.
    """
    if attribute is None:
        return df.repartition(n)
    if parts == 1:
        return df.repartition(n, attribute)
    flat = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    part = F.pmod(F.xxhash64(*flat), F.lit(parts))
    return df.withColumn("part", part).repartition(n, attribute, "part")


# Batches --------------------------------------------------------------------------------------


def duration_bucket(df: DataFrame, ts: str, seconds: int) -> Column:
    """Number of the fixed window a timestamp falls in, counted from 1970-01-01.

    A timestamp without time zone is taken as it stands, whatever the session's zone.
    """
    time = F.col(ts)
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        in_day = F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
        epoch = F.unix_date(F.to_date(time)).cast("bigint") * 86400 + in_day
    else:
        epoch = F.unix_seconds(time)
    return F.floor(epoch / F.lit(seconds)).cast("bigint")


def _amount(column: str | Column) -> Column:
    """Size of a row; null and negative sizes count as 0."""
    size = F.col(column) if isinstance(column, str) else column
    return F.greatest(F.coalesce(size.cast("bigint"), F.lit(0)), F.lit(0)).cast("bigint")


def assign_batches(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    count: int | None = None,
    size: tuple[str | Column, int] | None = None,
    duration: tuple[str, int] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add ``batch``, the number of the batch a row belongs to within its key.

    One limit: by ``count`` rows; by ``size`` (bytes column, bytes per batch; the batch is that in
    which the row's first byte falls); or by ``duration`` (timestamp column, seconds; the number of
    the fixed window). Several limits, the first one reached closing the batch: see
    :func:`combined_batches`; a duration then adds the column ``window`` and ``batch`` counts in it.
    """
    if sum(limit is not None for limit in (count, size, duration)) != 1:
        if size is not None:
            return combined_batches(df, key, order, count, size, duration, hot_rows)
        if count is None:
            raise ValueError("give at least one limit")
        # windows have fixed edges, so counting within them is the same as closing in turn
        windowed = df.withColumn("window", duration_bucket(df, *duration))
        return assign_batches(windowed, [*key, "window"], order, count=count, hot_rows=hot_rows)
    if duration is not None:
        return df.withColumn("batch", duration_bucket(df, *duration))
    if count is not None:
        return (
            numbered(df, key, order, "_rn", hot_rows)
            .withColumn("batch", F.floor((F.col("_rn") - 1) / count).cast("bigint"))
            .drop("_rn")
        )
    column, limit = size
    amount = _amount(column)
    return (
        running(df.withColumn("_bytes", amount), key, order, {"_sum": F.col("_bytes")}, hot_rows)
        .withColumn("batch", F.floor((F.col("_sum") - F.col("_bytes")) / limit).cast("bigint"))
        .drop("_sum", "_bytes")
    )


def combined_batches(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    count: int | None,
    size: tuple[str | Column, int],
    duration: tuple[str, int] | None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """First limit reached closes the batch: (..., ``window``, ``batch``), numbered per window.

    A duration closes batches at fixed window edges, so (key, window) is the unit of work: a hot
    key is split by its windows first, and a hot unit by blocks (see :mod:`.batches`). A row that is
    over the size alone is a batch of its own or ends the open one.
    """
    column, limit = size
    prepared = df.withColumns(
        {
            "window": duration_bucket(df, *duration) if duration else F.lit(0).cast("bigint"),
            "_bytes": _amount(column),
        }
    )
    return close_batches(
        prepared, [*key, "window"], order, "_bytes", count, limit, hot_rows
    ).drop("_bytes")


# State ----------------------------------------------------------------------------------------


def queue_pressure(
    moves: DataFrame,
    queue: Sequence[str],
    order: Sequence[str],
    objects: Column,
    size: Column | None = None,
    max_objects: int = 10_000,
    max_size: int = 1024**3,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Depth of a queue after every move in or out, and whether a threshold is exceeded.

    ``objects`` and ``size`` are signed changes. Adds ``depth``, ``depth_bytes`` and ``over``.
    """
    size = F.lit(0) if size is None else size
    changes = {
        "depth": F.coalesce(objects, F.lit(0)).cast("bigint"),
        "depth_bytes": F.coalesce(size, F.lit(0)).cast("bigint"),
    }
    over = (F.col("depth") > max_objects) | (F.col("depth_bytes") > max_size)
    return running(moves, queue, order, changes, hot_rows).withColumn("over", over)


def running_state(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    value: Column,
    initial: float = 0.0,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """State of a key after each of its rows: ``seen`` rows and ``state`` = initial + sum."""
    sums = {"seen": F.lit(1).cast("bigint"), "state": F.coalesce(value, F.lit(0.0))}
    return running(df, key, order, sums, hot_rows).withColumn(
        "state", F.col("state") + F.lit(initial)
    )


# Attributes -----------------------------------------------------------------------------------


def set_attributes(
    df: DataFrame, values: Mapping[str, str | Column], key: Sequence[str] = ()
) -> DataFrame:
    """Set attributes from columns or text.

    Text is a literal, except ``${uuid}`` (stable per ``key``) and ``${a:equals("v")}`` (boolean).
    All see the original row.
    """

    def value(given: str | Column) -> Column:
        if isinstance(given, Column):
            return given
        if given == "${uuid}":
            if not key:
                raise ValueError("${uuid} needs the key that tells rows apart")
            return stable_uuid(*[F.col(k) for k in key])
        if given.startswith("${"):
            return condition_column(given)
        return F.lit(given)

    return df.withColumns({name: value(given) for name, given in values.items()})
