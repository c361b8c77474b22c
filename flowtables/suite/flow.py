"""Record flow queries over events and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtables.functions.values import parse_duration, parse_size
from flowtables.operators import flow
from flowtables.sources.tables import literal_table, table
from flowtables.suite.registry import query

IN_ORDER = ["ts", "event_id"]


def events_of(spark, folder, *columns):
    return table(spark, folder, "events").select(*columns)


@query(
    "route_fanout",
    """
    SELECT e.event_id, e.event_type, x.edge_id
    FROM events e JOIN (VALUES ('clicks', 'click'), ('sales', 'purchase'), ('sales', 'signup'),
                               ('all', 'click'), ('all', 'view'), ('all', 'purchase'))
         AS x(edge_id, event_type) ON x.event_type = e.event_type
    """,
)
def route_fanout(spark, folder):
    edges = literal_table(
        spark,
        [
            ("clicks", ["click"]),
            ("sales", ["purchase", "signup"]),
            ("all", ["click", "view", "purchase", "error"]),
        ],
        "edge_id string, relationships array<string>",
    )
    events = events_of(spark, folder, "event_id", "event_type")
    return flow.route(events, "event_type", edges, terminated=["error"])


@query(
    "funnel_union",
    """
    SELECT event_id, value, CAST(NULL AS VARCHAR) AS props, 'clicks' AS input
    FROM events WHERE event_type = 'click'
    UNION ALL SELECT event_id, value, props, 'errors' FROM events WHERE event_type = 'error'
    UNION ALL SELECT event_id, value, NULL, 'again' FROM events WHERE event_type = 'click'
    """,
)
def funnel_union(spark, folder):
    events = table(spark, folder, "events")
    clicks = events.where("event_type = 'click'").select("event_id", "value")
    errors = events.where("event_type = 'error'").select("event_id", "value", "props")
    return flow.funnel({"clicks": clicks, "errors": errors, "again": clicks}, tag="input")


def _split(frames):
    events = frames["in"]
    failed = F.col("event_type") == "error"
    return {
        "good": events.where(~failed).withColumn("value", F.round(F.col("value") * 10, 2)),
        "bad": events.where(failed),
    }


@query(
    "group_ports",
    """
    SELECT event_id, event_type, round(value * 10, 2) AS value, 'good' AS port FROM events
    WHERE event_type <> 'error' AND value > 5
    UNION ALL SELECT event_id, event_type, value, 'bad' FROM events
    WHERE event_type = 'error' AND value > 5
    """,
)
def group_ports(spark, folder):
    inner = flow.FlowGroup(["in"], ["good", "bad"], _split)
    outer = flow.FlowGroup(
        ["in"], ["good", "bad"], lambda f: inner.apply(**{"in": f["in"].where("value > 5")})
    )
    ports = outer.apply(**{"in": events_of(spark, folder, "event_id", "event_type", "value")})
    return flow.funnel(ports, tag="port")


@query(
    "prioritized_topk",
    """
    SELECT o_custkey, o_orderkey, o_orderpriority, place FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey
                  ORDER BY o_orderpriority, o_orderdate, o_orderkey) AS place FROM orders)
    WHERE place <= 3
    """,
)
def prioritized_topk(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate"
    )
    order = ["o_orderpriority", "o_orderdate", "o_orderkey"]
    return flow.prioritized(orders, ["o_custkey"], order, 3).drop("o_orderdate")


@query(
    "prioritized_all",
    """
    SELECT o_custkey, o_orderkey,
           row_number() OVER (PARTITION BY o_custkey
               ORDER BY o_totalprice DESC, o_orderkey) AS place
    FROM orders
    """,
)
def prioritized_all(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    order = [F.col("o_totalprice").desc(), "o_orderkey"]
    return flow.prioritized(orders, ["o_custkey"], order).drop("o_totalprice")


@query(
    "expire_rows",
    """
    SELECT event_id, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 10 DAY
    """,
)
def expire_rows(spark, folder):
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    events = events_of(spark, folder, "event_id", "event_type", "ts")
    return flow.expire(events, "ts", 10 * 86400, as_of).drop("ts")


@query(
    "expire_by_setting",
    """
    SELECT event_id, event_type FROM events
    WHERE event_type IN ('view', 'signup')
       OR (event_type = 'click' AND ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 5 DAY)
       OR (event_type NOT IN ('click', 'view', 'signup')
           AND ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 36 HOUR)
    """,
)
def expire_by_setting(spark, folder):
    setting = (
        F.when(F.col("event_type") == "click", "5 days")
        .when(F.col("event_type") == "view", "0 sec")
        .when(F.col("event_type") == "signup", "for ever")
        .otherwise("36 hours")
    )
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    events = events_of(spark, folder, "event_id", "event_type", "ts")
    return flow.expire(events, "ts", parse_duration(setting), as_of).drop("ts")


@query(
    "balance_by_attribute",
    """
    SELECT user_id, count(*) AS n, round(sum(value), 2) AS total, CAST(1 AS BIGINT) AS partitions
    FROM events GROUP BY user_id
    """,
)
def balance_by_attribute(spark, folder):
    balanced = flow.balance(events_of(spark, folder, "user_id", "value"), 8, "user_id")
    placed = balanced.withColumn("place", F.spark_partition_id())
    return placed.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("value"), 2).alias("total"),
        F.count_distinct("place").alias("partitions"),
    )


@query(
    "batch_by_count",
    """
    SELECT user_id, event_id,
           CAST(floor((row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) / 10)
                AS BIGINT) AS batch
    FROM events
    """,
)
def batch_by_count(spark, folder):
    events = events_of(spark, folder, "user_id", "event_id", "ts")
    return flow.assign_batches(events, ["user_id"], IN_ORDER, count=10).drop("ts")


@query(
    "batch_by_bytes",
    """
    SELECT user_id, event_id,
           CAST(floor((sum(length(props)) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                       - length(props)) / 100) AS BIGINT) AS batch
    FROM events
    """,
)
def batch_by_bytes(spark, folder):
    events = events_of(spark, folder, "user_id", "event_id", "ts", "props")
    size = (F.length("props"), 100)
    return flow.assign_batches(events, ["user_id"], IN_ORDER, size=size).drop("ts", "props")


@query(
    "batch_by_duration",
    """
    SELECT user_id, event_id, CAST(floor(epoch_us(ts) / 86400000000) AS BIGINT) AS batch FROM events
    """,
)
def batch_by_duration(spark, folder):
    events = events_of(spark, folder, "user_id", "event_id", "ts")
    return flow.assign_batches(events, ["user_id"], IN_ORDER, duration=("ts", 86400)).drop("ts")


@query(
    "batch_combined",
    """
    WITH RECURSIVE e AS (
        SELECT user_id, event_id, length(props) AS bytes,
               CAST(floor(epoch_us(ts) / 604800000000) AS BIGINT) AS win,
               row_number() OVER (PARTITION BY user_id, floor(epoch_us(ts) / 604800000000)
                                  ORDER BY ts, event_id) AS rn
        FROM events
    ), b AS (
        SELECT user_id, event_id, win, rn, CAST(0 AS BIGINT) AS batch, 1 AS held, bytes AS filled
        FROM e WHERE rn = 1
        UNION ALL
        SELECT e.user_id, e.event_id, e.win, e.rn,
               CASE WHEN b.held >= 4 OR b.filled >= 35 THEN b.batch + 1 ELSE b.batch END,
               CASE WHEN b.held >= 4 OR b.filled >= 35 THEN 1 ELSE b.held + 1 END,
               CASE WHEN b.held >= 4 OR b.filled >= 35 THEN e.bytes ELSE b.filled + e.bytes END
        FROM b JOIN e ON e.user_id = b.user_id AND e.win = b.win AND e.rn = b.rn + 1
    )
    SELECT user_id, event_id, win AS "window", batch FROM b
    """,
)
def batch_combined(spark, folder):
    events = events_of(spark, folder, "user_id", "event_id", "ts", "props")
    return flow.assign_batches(
        events,
        ["user_id"],
        IN_ORDER,
        count=4,
        size=(F.length("props"), 35),
        duration=("ts", 7 * 86400),
    ).drop("ts", "props")


@query(
    "batch_window_bytes",
    """
    WITH RECURSIVE e AS (
        SELECT user_id, event_id, length(props) AS bytes,
               CAST(floor(epoch_us(ts) / 1296000000000) AS BIGINT) AS win,
               row_number() OVER (PARTITION BY user_id, floor(epoch_us(ts) / 1296000000000)
                                  ORDER BY ts, event_id) AS rn
        FROM events
    ), b AS (
        SELECT user_id, event_id, win, rn, CAST(0 AS BIGINT) AS batch, bytes AS filled
        FROM e WHERE rn = 1
        UNION ALL
        SELECT e.user_id, e.event_id, e.win, e.rn,
               CASE WHEN b.filled >= 80 THEN b.batch + 1 ELSE b.batch END,
               CASE WHEN b.filled >= 80 THEN e.bytes ELSE b.filled + e.bytes END
        FROM b JOIN e ON e.user_id = b.user_id AND e.win = b.win AND e.rn = b.rn + 1
    )
    SELECT user_id, event_id, win AS "window", batch FROM b
    """,
)
def batch_window_bytes(spark, folder):
    """Bytes and time without a row limit."""
    events = events_of(spark, folder, "user_id", "event_id", "ts", "props")
    size = (F.length("props"), 80)
    batches = flow.assign_batches(events, ["user_id"], IN_ORDER, size=size, duration=("ts", 15 * 86400))
    return batches.drop("ts", "props")


@query(
    "queue_pressure",
    """
    SELECT event_id, user_id, CAST(depth AS BIGINT) AS depth, CAST(bytes AS BIGINT) AS depth_bytes,
           depth > 3 OR bytes > 100 AS over
    FROM (
        SELECT event_id, user_id, sum(move) OVER w AS depth, sum(move * length(props)) OVER w AS bytes
        FROM (SELECT *, CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN -1 ELSE 0 END AS move
              FROM events)
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    )
    """,
)
def queue_pressure(spark, folder):
    move = (
        F.when(F.col("event_type") == "signup", 1)
        .when(F.col("event_type") == "purchase", -1)
        .otherwise(0)
    )
    events = events_of(spark, folder, "event_id", "user_id", "ts", "event_type", "props")
    return flow.queue_pressure(
        events, ["user_id"], IN_ORDER, move, move * F.length("props"), 3, 100
    ).select("event_id", "user_id", "depth", "depth_bytes", "over")


@query(
    "running_state",
    """
    SELECT event_id, user_id, count(*) OVER w AS seen, round(100 + sum(value) OVER w, 2) AS state
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """,
)
def running_state(spark, folder):
    events = events_of(spark, folder, "event_id", "user_id", "ts", "value")
    return flow.running_state(events, ["user_id"], IN_ORDER, F.col("value"), 100.0).select(
        "event_id", "user_id", "seen", F.round("state", 2).alias("state")
    )


@query(
    "parse_literals",
    """
    WITH t AS (
        SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER) AS q FROM lineitem
    )
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE l_linenumber WHEN 1 THEN q * 1.0 WHEN 2 THEN q * 60.0 WHEN 3 THEN q * 3600.0
                WHEN 6 THEN q * 86400.0 END::DOUBLE AS seconds,
           CASE l_linenumber WHEN 4 THEN q * 1073741824.0 WHEN 5 THEN q * 1.0 END::DOUBLE AS bytes
    FROM t
    """,
)
def parse_literals(spark, folder):
    units = F.array(*[F.lit(u) for u in (" sec", " mins", "h", " GB", "b", "  days ", " parsecs")])
    text = F.concat(
        F.col("l_quantity").cast("int").cast("string"), F.get(units, F.col("l_linenumber") - 1)
    )
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", text.alias("text")
    )
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        parse_duration(F.col("text")).alias("seconds"),
        parse_size(F.col("text")).alias("bytes"),
    )


@query(
    "set_attributes",
    """
    SELECT event_id, 'web' AS source, user_id AS owner, event_type = 'click' AS clicked,
           substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-'
           || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS uuid
    FROM (SELECT *, sha256(CAST(event_id AS VARCHAR)) AS h FROM events)
    """,
)
def set_attributes(spark, folder):
    return flow.set_attributes(
        events_of(spark, folder, "event_id", "user_id", "event_type"),
        {
            "source": "web",
            "owner": F.col("user_id"),
            "clicked": '${event_type:equals("click")}',
            "uuid": "${uuid}",
        },
        key=["event_id"],
    ).select("event_id", "source", "owner", "clicked", "uuid")
