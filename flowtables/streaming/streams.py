"""Streaming forms of the record flow operators.

Routing, funnels, rules and literal attributes are row-wise, so the batch functions take a streaming
DataFrame as it is (``route`` joins a static edge table). Here are the forms that need event time,
state or a sink.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from flowtables.operators.flow import prioritized
from flowtables.operators.spread import HOT_ROWS, lookup, running


def event_time(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time as a timestamp with a watermark; later rows are dropped by stateful operators
    and counted in the metric ``numRowsDroppedByWatermark``."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def expire_stream(stream: DataFrame, ts: str, ttl_seconds: float) -> DataFrame:
    """Rows not older than the time to live when they are processed; 0 means for ever.

    The age is taken at the start of each micro batch; a row without a timestamp has none and stays.
    """
    if not ttl_seconds:
        return stream
    limit = F.current_timestamp() - F.make_dt_interval(secs=F.lit(float(ttl_seconds)))
    return stream.where(F.col(ts).isNull() | (F.col(ts).cast("timestamp") >= limit))


def expired_waiting(
    stream: DataFrame, key: Sequence[str], ts: str, ttl_seconds: Column, left: Column, delay: str
) -> DataFrame:
    """Rows that waited in a queue beyond their time to live: ``key``..., ``arrived``, ``expired``.

    The stream holds arrivals and, where ``left`` is true, departures of rows named by ``key`` (edge and row id:
    state is one session per waiting row, so no edge is hot). A session is open from an arrival for its own
    time to live, of microseconds; a departure inside it, its end included, takes the row out. Sessions close by
    event time: the row comes out once the watermark, ``delay`` behind the newest row, is past the end.

    A row that arrives again waits anew from then on. A time to live of 0 or null is for ever and keeps no state; rows
    without a timestamp have no age. Departures of rows that do not wait change nothing.
    """
    gone = F.coalesce(left, F.lit(False))
    micros = F.round(F.coalesce(ttl_seconds.cast("double"), F.lit(0.0)) * 1000000).cast("bigint")
    at = F.col("_at")
    timed = stream.select(
        *key,
        F.col(ts).cast("timestamp").alias("_at"),
        gone.alias("_gone"),
        # one microsecond for a departure, and one more than the time to live to include its end
        F.when(gone, 0).otherwise(micros).alias("_micros"),
    ).where("_at is not null and (_gone or _micros > 0)")
    gap = F.concat((F.col("_micros") + 1).cast("string"), F.lit(" microseconds"))
    ended = (
        timed.withWatermark("_at", delay)
        .groupBy(*key, F.session_window("_at", gap).alias("_wait"))
        .agg(
            F.max(F.when(~F.col("_gone"), at)).alias("arrived"),
            F.max(F.when(F.col("_gone"), at)).alias("_left"),
        )
    )
    return ended.where(
        "arrived is not null and (_left is null or _left < arrived)"
    ).select(*key, "arrived", (F.col("_wait.end") - F.expr("interval 1 microsecond")).alias("expired"))


def batch_totals(
    stream: DataFrame,
    key: Sequence[str],
    ts: str,
    duration: str,
    delay: str,
    totals: dict[str, Column],
) -> DataFrame:
    """Closed batches (key..., window, totals) of fixed duration.

    Spark merges partial sums before the exchange; ``totals`` are expressions over all rows of a
    batch such as ``F.count(...)`` or ``F.sum(...)``.
    """
    return (
        event_time(stream, ts, delay)
        .groupBy(*key, F.window(ts, duration))
        .agg(*[value.alias(name) for name, value in totals.items()])
    )


class _Running(StatefulProcessor):
    """Rows seen and running sum of one key; rows are taken in ``order`` within a micro batch."""

    def __init__(self, value: str, order: Sequence[str], initial: float):
        self.value, self.order, self.initial = value, list(order), initial

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState(
            "held", T.StructType([T.StructField("seen", T.LongType()), T.StructField("state", T.DoubleType())])
        )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen, state = self.held.get() if self.held.exists() else (0, self.initial)
        frame = pd.concat(list(rows), ignore_index=True).sort_values(self.order)
        frame["seen"] = seen + pd.RangeIndex(1, len(frame) + 1)
        frame["state"] = state + frame[self.value].fillna(0.0).cumsum()
        self.held.update((int(frame["seen"].iloc[-1]), float(frame["state"].iloc[-1])))
        yield frame

    def close(self) -> None:
        pass


def running_state_stream(
    stream: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    value: str,
    initial: float = 0.0,
) -> DataFrame:
    """State of a key after each of its rows (``seen``, ``state``), kept in the state store.

    Needs the RocksDB state store provider. A key's rows of one micro batch are held by one task,
    so the source's rate limit bounds them.
    """
    schema = T.StructType(
        [
            *stream.schema.fields,
            T.StructField("seen", T.LongType()),
            T.StructField("state", T.DoubleType()),
        ]
    )
    return stream.groupBy(*key).transformWithStateInPandas(
        statefulProcessor=_Running(value, order, initial),
        outputStructType=schema,
        outputMode="Append",
        timeMode="None",
    )


def prioritized_sink(
    stream: DataFrame,
    queue: Sequence[str],
    order: Sequence[str | Column],
    k: int,
    write: Callable[[DataFrame, int], None],
) -> DataStreamWriter:
    """Writer that ranks each micro batch per queue and hands the first ``k`` to ``write``."""
    return stream.writeStream.foreachBatch(
        lambda batch, number: write(prioritized(batch, queue, order, k), number)
    )


def _before(batch: DataFrame, folder: str, number: int, schema: T.StructType) -> DataFrame | None:
    """What was carried up to the micro batch before this one."""
    if number == 0:
        return None
    return batch.sparkSession.read.schema(schema).parquet(f"{folder}/{number - 1}")


def carried_prioritized_sink(
    stream: DataFrame, queue: Sequence[str], order: Sequence[str | Column], k: int, folder: str
) -> DataStreamWriter:
    """Writer that keeps the first ``k`` rows of each queue over all micro batches.

    After micro batch n, ``folder/n`` has them with their ``place``: the best of what is in ``folder/(n-1)`` and of
    the batch. A batch that is run again writes the same again.
    """
    schema = T.StructType([*stream.schema.fields, T.StructField("place", T.LongType())])

    def step(batch: DataFrame, number: int) -> None:
        before = _before(batch, folder, number, schema)
        rows = batch if before is None else before.drop("place").unionByName(batch)
        prioritized(rows, queue, order, k).write.mode("overwrite").parquet(f"{folder}/{number}")

    return stream.writeStream.foreachBatch(step)


def carried_running_sink(
    stream: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    value: str,
    folder: str,
    initial: float = 0.0,
    hot_rows: int | None = HOT_ROWS,
) -> DataStreamWriter:
    """Writer of running states over micro batches in which a hot key is split.

    ``folder/rows/n`` has the rows of micro batch n with ``seen`` and ``state``, ``folder/states/n`` every
    key's (seen, state) after it. A batch takes the running sums of its own rows, split over tasks for keys above
    ``hot_rows``, and adds what is carried by one join; rows of later batches come later in ``order``. A
    batch that is run again writes the same again. Null values count as 0.
    """
    key = list(key)
    kinds = {f.name: f for f in stream.schema.fields}
    schema = T.StructType(
        [
            *[kinds[c] for c in key],
            T.StructField("seen", T.LongType()),
            T.StructField("state", T.DoubleType()),
        ]
    )

    def step(batch: DataFrame, number: int) -> None:
        before = _before(batch, f"{folder}/states", number, schema)
        amount = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
        batch = batch.persist()
        rows = running(
            batch, key, order, {"seen": F.lit(1).cast("bigint"), "state": amount}, hot_rows, batch.select(*key)
        )
        sums = batch.groupBy(*key).agg(
            F.count(F.lit(1)).alias("seen"), F.sum(amount).alias("state")
        )
        if before is None:
            rows, sums = (df.withColumn("state", F.col("state") + initial) for df in (rows, sums))
        else:
            had = before.withColumnsRenamed({"seen": "_seen", "state": "_state"})
            rows = lookup(rows, had, [F.col(c) for c in key], key, ["_seen", "_state"]).withColumns(
                {
                    "seen": F.col("seen") + F.coalesce("_seen", F.lit(0)),
                    "state": F.col("state") + F.coalesce("_state", F.lit(initial)),
                }
            )
            # a key seen for the first time begins with the initial state
            new = F.max(F.col("_old").cast("int")) == 0
            sums = (
                sums.withColumn("_old", F.lit(False))
                .unionByName(before.withColumn("_old", F.lit(True)))
                .groupBy(*key)
                .agg(
                    F.sum("seen").alias("seen"),
                    (F.sum("state") + F.when(new, F.lit(initial)).otherwise(0.0)).alias("state"),
                )
            )
        rows.select(*batch.columns, "seen", "state").write.mode("overwrite").parquet(
            f"{folder}/rows/{number}"
        )
        sums.select(*key, "seen", "state").write.mode("overwrite").parquet(f"{folder}/states/{number}")
        batch.unpersist()

    return stream.writeStream.foreachBatch(step)
