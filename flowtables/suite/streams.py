"""Streaming queries: the events as a file stream, written out and read back."""

from __future__ import annotations

from contextlib import contextmanager
from math import ceil

from pyspark.sql import functions as F

from flowtables.operators import flow, rules
from flowtables.session import SETTINGS, scratch_path, stored
from flowtables.sources.tables import literal_table, table
from flowtables.streaming import streams
from flowtables.suite.registry import SQL, query
from flowtables.suite.rules import EVENT_RULES

# Micro batches of the queries over files in time order.
BATCHES = 3
# Rows of a whole stream for one state store; a store costs time in every micro batch, however little it holds.
STATE_ROWS = 500_000
PARTITIONS = "spark.sql.shuffle.partitions"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def event_stream(spark, folder):
    schema = table(spark, folder, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)


def timed_files(spark, rows, *order):
    """A table as a stream of files one after the other in its order, one to a micro batch."""
    path = scratch_path(spark, "timed")
    ranges = stored(
        rows.repartitionByRange(BATCHES, *order).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    for number in range(BATCHES):
        one = ranges.where(F.col("_range") == number).drop("_range")
        one.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def timed_events(spark, folder):
    """The events as a stream of files in time order."""
    return timed_files(spark, table(spark, folder, "events"), "ts", "event_id")


def run(spark, writer):
    """Run a stream over what its source holds now; the number of its last micro batch."""
    writer = writer.option("checkpointLocation", scratch_path(spark, "progress"))
    running_query = writer.trigger(availableNow=True).start()
    running_query.awaitTermination()
    return running_query.lastProgress["batchId"]


def state_stores(spark, rows, state_rows=STATE_ROWS):
    """State stores for a stream of so many rows: one per core at least, the session's partitions at most."""
    wanted = max(spark.sparkContext.defaultParallelism, ceil(rows / state_rows))
    return min(int(spark.conf.get(PARTITIONS)), wanted)


@contextmanager
def shuffled_to(spark, partitions):
    """The session with this number of shuffle partitions; a stream started in it keeps the number."""
    before = spark.conf.get(PARTITIONS)
    spark.conf.set(PARTITIONS, str(partitions))
    try:
        yield
    finally:
        spark.conf.set(PARTITIONS, before)


def finished(spark, stream):
    """Run a stream over what its source holds now; the result as a table."""
    path = scratch_path(spark, "stream")
    query_ = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", scratch_path(spark, "progress"))
        .trigger(availableNow=True)
        .start()
    )
    query_.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query("stream_route", SQL["route_fanout"])
def stream_route(spark, folder):
    edges = literal_table(
        spark,
        [
            ("clicks", ["click"]),
            ("sales", ["purchase", "signup"]),
            ("all", ["click", "view", "purchase"]),
        ],
        "edge_id string, relationships array<string>",
    )
    events = event_stream(spark, folder).select("event_id", "event_type")
    return finished(spark, flow.route(events, "event_type", edges))


@query("stream_funnel", SQL["funnel_union"])
def stream_funnel(spark, folder):
    events = event_stream(spark, folder)
    clicks = events.where("event_type = 'click'").select("event_id", "value")
    errors = events.where("event_type = 'error'").select("event_id", "value", "props")
    again = event_stream(spark, folder).where("event_type = 'click'").select("event_id", "value")
    joined = flow.funnel({"clicks": clicks, "errors": errors, "again": again}, tag="input")
    return finished(spark, joined)


@query("stream_expire", SQL["expire_rows"])
def stream_expire(spark, folder):
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    events = event_stream(spark, folder).select("event_id", "event_type", "ts")
    return finished(spark, flow.expire(events, "ts", 10 * 86400, as_of)).drop("ts")


# Hours a row may wait on the edge of its event type; signups wait for ever.
WAIT_HOURS = {"click": 6, "error": 12, "purchase": 48, "signup": 0, "view": 24}
WAITS = ", ".join(f"('{kind}', {hours})" for kind, hours in WAIT_HOURS.items())


@query(
    "stream_waiting",
    f"""
    -- every event waits on the edge of its type and is taken as many half hours later as its id says
    WITH waits AS (
      SELECT event_id, event_type, ts, ts + to_seconds(event_id % 61 * 1800) AS taken,
        to_hours(w.hours) AS ttl, w.hours
      FROM events JOIN (VALUES {WAITS}) AS w(kind, hours) ON event_type = kind),
    mark AS (SELECT max(greatest(ts, taken)) - INTERVAL 1 HOUR AS past FROM waits)
    SELECT event_type, event_id, epoch_us(ts) AS arrived, epoch_us(ts + ttl) AS expired
    FROM waits, mark
    WHERE hours > 0 AND taken > ts + ttl AND ts + ttl + INTERVAL 1 MICROSECOND <= past
    """,
)
def stream_waiting(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "ts")
    half_hours = F.make_dt_interval(mins=(F.col("event_id") % 61 * 30).cast("int"))
    taken = events.withColumn("ts", F.col("ts") + half_hours)
    moves = events.withColumn("gone", F.lit(False)).unionByName(taken.withColumn("gone", F.lit(True)))
    pairs = [F.lit(v) for kind, hours in WAIT_HOURS.items() for v in (kind, hours * 3600)]
    ttl = F.create_map(*pairs)[F.col("event_type")]
    stream = timed_files(spark, moves, "ts", "event_id", "gone")
    waited = streams.expired_waiting(
        stream, ["event_type", "event_id"], "ts", ttl, F.col("gone"), "1 hour"
    )
    with shuffled_to(spark, state_stores(spark, 2 * events.count())):
        expired = finished(spark, waited)
    return expired.select(
        "event_type",
        "event_id",
        F.unix_micros("arrived").alias("arrived"),
        F.unix_micros("expired").alias("expired"),
    )


@query(
    "stream_prioritized",
    """
    SELECT user_id, event_id, place FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS place
        FROM events)
    WHERE place <= 3
    """,
)
def stream_prioritized(spark, folder):
    events = timed_events(spark, folder).select("user_id", "event_id", "value")
    path = scratch_path(spark, "ranked")
    order = [F.col("value").desc(), "event_id"]
    last = run(spark, streams.carried_prioritized_sink(events, ["user_id"], order, 3, path))
    return spark.read.parquet(f"{path}/{last}").select("user_id", "event_id", "place")


@query("stream_rules", SQL["apply_rules_clone"])
def stream_rules(spark, folder):
    events = event_stream(spark, folder).select("event_id", "user_id", "event_type", "value")
    return finished(spark, rules.apply_rules(events, EVENT_RULES))


@query(
    "stream_batch_totals",
    """
    SELECT user_id, CAST(floor(epoch_us(ts) / 86400000000) AS BIGINT) AS day,
           count(*) AS n, round(sum(value), 2) AS total
    FROM events
    -- a batch is closed once the watermark, an hour behind the newest event, is past its end
    WHERE (floor(epoch_us(ts) / 86400000000) + 1) * 86400000000
          <= (SELECT epoch_us(max(ts)) FROM events) - 3600000000
    GROUP BY ALL
    """,
)
def stream_batch_totals(spark, folder):
    totals = {"n": F.count(F.lit(1)), "total": F.round(F.sum("value"), 2)}
    events = event_stream(spark, folder)
    closed = streams.batch_totals(events, ["user_id"], "ts", "1 day", "1 hour", totals)
    day = F.floor(F.unix_seconds("window.start") / 86400).cast("bigint")
    return finished(spark, closed).select("user_id", day.alias("day"), "n", "total")


@query("stream_running_state", SQL["running_state"])
def stream_running_state(spark, folder):
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, SETTINGS[STATE_STORE])
    try:
        events = event_stream(spark, folder).select("event_id", "user_id", "ts", "value")
        stream = streams.running_state_stream(
            events, ["user_id"], ["ts", "event_id"], "value", 100.0
        )
        states = finished(spark, stream)
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)
    return states.select("event_id", "user_id", "seen", F.round("state", 2).alias("state"))


@query("stream_running_batches", SQL["running_state"])
def stream_running_batches(spark, folder):
    """The same over several micro batches, with hot users split and states carried in a table."""
    events = timed_events(spark, folder).select("event_id", "user_id", "ts", "value")
    path = scratch_path(spark, "running")
    run(
        spark,
        streams.carried_running_sink(
            events, ["user_id"], ["ts", "event_id"], "value", path, 100.0, hot_rows=1000
        ),
    )
    rows = spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/rows")
    return rows.select("event_id", "user_id", "seen", F.round("state", 2).alias("state"))
