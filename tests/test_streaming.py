"""Streaming forms agree with the batch operators on the same rows."""

import itertools
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from flowtables.operators import flow, rules
from flowtables.session import scratch_path
from flowtables.sources.tables import table
from flowtables.streaming import streams
from flowtables.suite import QUERIES
from flowtables.suite import streams as queries
from flowtables.suite.rules import EVENT_RULES

FOLDER = "/root/testdata/sf0.001"
NUMBER = itertools.count()


@pytest.fixture(scope="module")
def events(spark):
    return table(spark, FOLDER, "events").select("event_id", "ts", "user_id", "event_type", "value")


@pytest.fixture(scope="module")
def source(spark, events):
    """Events in time order, several files, read one file per micro batch."""
    path = scratch_path(spark, "events")
    rows = events.orderBy("ts").collect()
    for start in range(0, len(rows), 400):
        part = spark.createDataFrame(rows[start : start + 400], events.schema).coalesce(1)
        part.write.mode("append").parquet(path)
    return lambda: spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)


def finish(spark, stream, mode="append"):
    path = scratch_path(spark, "out")
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", scratch_path(spark, "log"))
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(path)


def bag(df):
    return sorted(map(repr, df.collect()))


def test_route(spark, events, source):
    edges = spark.createDataFrame(
        [("a", ["click", "view"]), ("b", ["click"])], "edge_id string, relationships array<string>"
    )
    got = finish(spark, flow.route(source(), "event_type", edges))
    wanted = flow.route(events, "event_type", edges)
    assert bag(got.select(*wanted.columns)) == bag(wanted)


def test_rules(spark, events, source):
    got = finish(spark, rules.apply_rules(source(), EVENT_RULES))
    wanted = rules.apply_rules(events, EVENT_RULES)
    assert bag(got.select(*wanted.columns)) == bag(wanted)


def test_funnel(spark, events, source):
    clicks = lambda df: df.where("event_type = 'click'")
    got = finish(spark, flow.funnel({"one": clicks(source()), "two": clicks(source())}, "input"))
    wanted = flow.funnel({"one": clicks(events), "two": clicks(events)}, "input")
    assert bag(got.select(*wanted.columns)) == bag(wanted)


def test_expire(spark, events, source):
    assert finish(spark, streams.expire_stream(source(), "ts", 0)).count() == events.count()
    century = 100 * 365 * 86400.0
    assert finish(spark, streams.expire_stream(source(), "ts", century)).count() == events.count()
    assert finish(spark, streams.expire_stream(source(), "ts", 60.0)).count() == 0


def test_waiting_rows_expire_by_event_time(spark, tmp_path):
    # one row per second and micro batch: (edge, id, second, gone, ttl)
    batches = [
        [("a", 1, 0, False, 10.0), ("a", 2, 0, False, 10.0), ("b", 1, 0, False, 30.0), ("a", 3, 0, False, 0.0),
         ("a", 4, 0, False, None), ("a", 5, None, False, 1.0), ("a", 6, 0, True, 10.0), ("a", 8, 0, False, 10.0)],
        [("a", 2, 10, True, None), ("a", 1, 11, True, 10.0), ("a", 7, 12, False, 0.5), ("a", 8, 8, False, 10.0)],
        [("b", 1, 29, None, 30.0), ("a", 7, 40, False, 100.0), ("b", 9, 100, True, None)],
    ]
    schema = "edge string, id int, second int, gone boolean, ttl double"
    for number, rows in enumerate(batches):
        one = spark.createDataFrame(rows, schema).coalesce(1)
        one.write.mode("append").parquet(f"{tmp_path}/in")
    source = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        .withColumn("ts", F.timestamp_seconds("second"))
    )
    stream = streams.expired_waiting(source, ["edge", "id"], "ts", F.col("ttl"), F.col("gone"), "5 seconds")
    got = finish(spark, stream).select(
        "edge", "id", F.unix_millis("arrived").alias("arrived"), F.unix_millis("expired").alias("expired")
    )
    # 2 left at its end, 8 and b1 arrived again, the second wait of 7 is still open
    assert sorted(map(tuple, got.collect())) == [
        ("a", 1, 0, 10000), ("a", 7, 12000, 12500), ("a", 8, 8000, 18000), ("b", 1, 29000, 59000),
    ]


def test_batch_totals(spark, events, source):
    totals = {"n": F.count(F.lit(1)), "total": F.round(F.sum("value"), 2)}
    stream = streams.batch_totals(source(), ["user_id"], "ts", "1 day", "1 hour", totals)
    got = finish(spark, stream).select("user_id", "window.start", "n", "total")
    last = events.agg(F.max("ts")).first()[0]
    wanted = (
        events.withColumn("ts", F.col("ts").cast("timestamp"))
        .groupBy("user_id", F.window("ts", "1 day"))
        .agg(*[v.alias(n) for n, v in totals.items()])
        # a batch still open when the input ends is not emitted
        .where(F.col("window.end") <= F.lit(last).cast("timestamp") - F.expr("INTERVAL 1 HOUR"))
        .select("user_id", "window.start", "n", "total")
    )
    assert bag(got) == bag(wanted)


def test_running_state(spark, events, source):
    stream = streams.running_state_stream(source(), ["user_id"], ["ts", "event_id"], "value", 100.0)
    got = finish(spark, stream).withColumn("state", F.round("state", 2))
    wanted = flow.running_state(
        events, ["user_id"], ["ts", "event_id"], F.col("value"), 100.0
    ).withColumn("state", F.round("state", 2))
    assert bag(got.select(*wanted.columns)) == bag(wanted)


def test_prioritized_sink(spark, events, source):
    path = scratch_path(spark, "top")
    query = (
        streams.prioritized_sink(
            source(),
            ["event_type"],
            [F.col("value").desc(), "event_id"],
            2,
            lambda df, number: df.withColumn("batch", F.lit(number)).write.mode("append").parquet(path),
        )
        .option("checkpointLocation", scratch_path(spark, "log"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    top = spark.read.parquet(path)
    sizes = top.groupBy("batch", "event_type").agg(F.max("place").alias("m"), F.count("*").alias("n"))
    assert sizes.where("m > 2 OR n > 2").count() == 0
    best = events.agg(F.max("value")).first()[0]
    assert top.agg(F.max("value")).first()[0] == best


def test_carried_sinks_over_micro_batches(spark, tmp_path):
    rows = [(u, i, float((i * 7) % 11) if i % 5 else None) for i in range(90) for u in ("hot", f"u{i % 4}")]
    table = spark.createDataFrame(rows, "u string, i int, v double")
    for part in range(3):
        table.where(f"i >= {part * 30} and i < {part * 30 + 30}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def source():
        return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")

    def run(writer, name):
        query = writer.option("checkpointLocation", f"{tmp_path}/{name}-progress").trigger(availableNow=True).start()
        query.awaitTermination()
        return query.lastProgress["batchId"]

    last = run(streams.carried_running_sink(source(), ["u"], ["i"], "v", f"{tmp_path}/run", 5.0, hot_rows=10), "run")
    assert last == 2
    got = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/run/rows").collect()
    state, wanted = {}, set()
    for u, i, v in sorted(rows, key=lambda r: r[1]):
        seen, held = state.get(u, (0, 5.0))
        state[u] = (seen + 1, held + (v or 0.0))
        wanted.add((u, i, *state[u]))
    assert {(r.u, r.i, r.seen, r.state) for r in got} == wanted and len(got) == len(rows)
    ends = spark.read.parquet(f"{tmp_path}/run/states/{last}").collect()
    assert {r.u: (r.seen, r.state) for r in ends} == state
    order = [F.col("v").desc_nulls_last(), "i"]
    last = run(streams.carried_prioritized_sink(source(), ["u"], order, 4, f"{tmp_path}/top"), "top")
    assert bag(spark.read.parquet(f"{tmp_path}/top/{last}").select("u", "i", "v", "place")) == bag(
        flow.prioritized(table, ["u"], order, 4).select("u", "i", "v", "place")
    )


def test_state_stores_follow_the_rows(spark, monkeypatch):
    """A stream of few rows keeps a store for each core, however many partitions the session shuffles to."""
    paths = []

    def noted(session, name):
        paths.append((name, scratch_path(session, name)))
        return paths[-1][1]

    monkeypatch.setattr(queries, "scratch_path", noted)
    partitions, cores = "spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism
    before = spark.conf.get(partitions)
    spark.conf.set(partitions, str(4 * cores))
    try:
        assert QUERIES["stream_waiting"](spark, FOLDER).count() > 0
        assert spark.conf.get(partitions) == str(4 * cores)
        assert queries.state_stores(spark, 10 * cores, state_rows=5) == 2 * cores
        assert queries.state_stores(spark, 1000 * cores, state_rows=5) == 4 * cores
    finally:
        spark.conf.set(partitions, before)
    (progress,) = [path for name, path in paths if name == "progress"]
    stores = Path(progress.removeprefix("file:")) / "state" / "0"
    assert len([store for store in stores.iterdir() if store.name.isdigit()]) == cores
