"""Sparse configuration queries: each order, customer or part stands for a component."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtables.functions.values import (
    classify_kind,
    elide,
    format_position,
    parse_position,
    prune_empty,
    restore,
)
from flowtables.operators import settings, sparse
from flowtables.sources.tables import literal_table, table
from flowtables.suite.registry import query

ORDER_DEFAULTS = {"status": ["O"], "priority": ["1-URGENT"], "clerk": [None]}
CUSTOMER_DEFAULTS = {"segment": ["MACHINERY"]}

ORDERS_LONG = """
    SELECT o_orderkey, 'status' AS key, o_orderstatus AS value FROM orders
    UNION ALL SELECT o_orderkey, 'priority', nullif(o_orderpriority, '5-LOW') FROM orders
"""
DESCRIBED = """
    SELECT * FROM (VALUES ('status', 'O'), ('priority', '1-URGENT'), ('clerk', NULL)) AS d(key, dflt)
"""


def order_settings(spark, folder):
    """Orders as a long table of settings; a low priority counts as not configured."""
    orders = table(spark, folder, "orders")
    return sparse.unpivot_text(
        orders,
        ["o_orderkey"],
        {
            "status": F.col("o_orderstatus"),
            "priority": F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")),
        },
    )


@query(
    "sparse_diff_described",
    f"""
    WITH v AS ({ORDERS_LONG}), d AS ({DESCRIBED})
    SELECT o.o_orderkey, d.key, v.value, v.value IS NULL AS cleared
    FROM orders o CROSS JOIN d LEFT JOIN v ON v.o_orderkey = o.o_orderkey AND v.key = d.key
    WHERE v.value IS DISTINCT FROM d.dflt
    """,
)
def sparse_diff_described(spark, folder):
    owners = table(spark, folder, "orders").select("o_orderkey")
    return sparse.sparse_diff(
        order_settings(spark, folder), ORDER_DEFAULTS, ["o_orderkey"], owners
    )


@query(
    "sparse_diff_wide",
    f"""
    WITH v AS ({ORDERS_LONG}), d AS ({DESCRIBED})
    SELECT o.o_orderkey, d.key, v.value, v.value IS NULL AS cleared
    FROM orders o CROSS JOIN d LEFT JOIN v ON v.o_orderkey = o.o_orderkey AND v.key = d.key
    WHERE v.value IS DISTINCT FROM d.dflt
    """,
)
def sparse_diff_wide(spark, folder):
    columns = {
        "status": F.col("o_orderstatus"),
        "priority": F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")),
    }
    return sparse.wide_diff(
        table(spark, folder, "orders"), ["o_orderkey"], columns, ORDER_DEFAULTS
    )


@query(
    "sparse_diff_present",
    f"""
    WITH v AS ({ORDERS_LONG}), d AS ({DESCRIBED})
    SELECT v.o_orderkey, v.key, v.value, false AS cleared
    FROM v JOIN d ON v.key = d.key
    WHERE v.value IS NOT NULL AND v.value IS DISTINCT FROM d.dflt
    """,
)
def sparse_diff_present(spark, folder):
    return sparse.sparse_diff(
        order_settings(spark, folder), ORDER_DEFAULTS, ["o_orderkey"], nulls="skip"
    )


@query(
    "sparse_diff_emit_null",
    """
    SELECT c_custkey, 'segment' AS key, nullif(c_mktsegment, 'BUILDING') AS value,
           nullif(c_mktsegment, 'BUILDING') IS NULL AS cleared
    FROM customer WHERE nullif(c_mktsegment, 'BUILDING') IS DISTINCT FROM 'MACHINERY'
    """,
)
def sparse_diff_emit_null(spark, folder):
    customers = table(spark, folder, "customer")
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    values = sparse.unpivot_text(customers, ["c_custkey"], {"segment": segment})
    return sparse.sparse_diff(
        values, CUSTOMER_DEFAULTS, ["c_custkey"], customers.select("c_custkey"), nulls="emit"
    )


@query(
    "sparse_diff_multi_default",
    """
    SELECT o_orderkey, 'priority' AS key, o_orderpriority AS value, false AS cleared
    FROM orders WHERE o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW')
    """,
)
def sparse_diff_multi_default(spark, folder):
    orders = table(spark, folder, "orders")
    values = sparse.unpivot_text(orders, ["o_orderkey"], {"priority": F.col("o_orderpriority")})
    return sparse.sparse_diff(
        values, {"priority": ["4-NOT SPECIFIED", "5-LOW"]}, ["o_orderkey"], nulls="skip"
    )


@query(
    "keep_present",
    """
    WITH v AS (
        SELECT event_id, 'type' AS key, event_type AS value FROM events
        UNION ALL
        SELECT event_id, 'level',
               CASE WHEN value < 10 THEN '' WHEN value > 100 THEN NULL ELSE 'x' END
        FROM events
    )
    SELECT * FROM v WHERE value IS NOT NULL AND value <> ''
    """,
)
def keep_present(spark, folder):
    level = F.when(F.col("value") < 10, "").when(F.col("value") > 100, None).otherwise("x")
    return sparse.keep_present(
        table(spark, folder, "events"), ["event_id"], {"type": F.col("event_type"), "level": level}
    )


@query(
    "sparse_diff_overlay",
    """
    WITH v AS (
        SELECT p_partkey, 'brand' AS key, p_brand AS value FROM part
        UNION ALL SELECT p_partkey, 'type', p_type FROM part
        UNION ALL SELECT p_partkey, 'size', CAST(p_size AS VARCHAR) FROM part
    )
    SELECT p_partkey, key, value, value IS NULL AS cleared FROM v
    WHERE NOT (key = 'type' AND value = 'PROMO')
    """,
)
def sparse_diff_overlay(spark, folder):
    values = sparse.unpivot_text(
        table(spark, folder, "part"),
        ["p_partkey"],
        {"brand": F.col("p_brand"), "type": F.col("p_type"), "size": F.col("p_size")},
    )
    return sparse.sparse_diff(values, {"type": ["PROMO"]}, ["p_partkey"], driver="values")


@query(
    "apply_overrides",
    """
    SELECT o_orderkey, 'status' AS key, o_orderstatus AS value FROM orders
    UNION ALL
    SELECT o_orderkey, 'priority',
           CASE WHEN o_orderpriority = '5-LOW' THEN '1-URGENT' ELSE o_orderpriority END
    FROM orders
    UNION ALL SELECT o_orderkey, 'clerk', NULL FROM orders
    """,
)
def apply_overrides(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey")
    defaults = [
        F.struct(F.lit(k).alias("key"), F.lit(v[0]).cast("string").alias("default"))
        for k, v in ORDER_DEFAULTS.items()
    ]
    base = orders.select("o_orderkey", F.inline(F.array(*defaults)))
    return sparse.apply_overrides(base, sparse_diff_present(spark, folder), ["o_orderkey", "key"])


@query(
    "non_default_rows",
    """
    WITH o AS (
        SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'O') AS status,
               nullif(o_orderpriority, '1-URGENT') AS priority
        FROM orders
    )
    SELECT o.* FROM o
    WHERE (status IS NOT NULL OR priority IS NOT NULL)
      AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    """,
)
def non_default_rows(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.nullif(F.col("o_orderstatus"), F.lit("O")).alias("status"),
        F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("priority"),
    )
    known = table(spark, folder, "customer").where("c_mktsegment = 'BUILDING'")
    return sparse.non_default_rows(
        orders, ["status", "priority"], known.withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"]
    )


@query(
    "prune_empty",
    """
    SELECT event_id, 'type' AS key, event_type AS value FROM events WHERE event_type <> 'view'
    UNION ALL SELECT event_id, 'big', 'yes' FROM events WHERE value > 100
    UNION ALL SELECT event_id, 'props', props FROM events WHERE props <> ''
    """,
)
def prune_empty_rows(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id",
        F.create_map(
            F.lit("type"),
            F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type")),
            F.lit("big"),
            F.when(F.col("value") > 100, "yes"),
            F.lit("props"),
            F.col("props"),
        ).alias("settings"),
    )
    return prune_empty(events, "settings").select("event_id", F.explode("settings"))


@query(
    "elide_restore",
    """
    SELECT p_partkey,
           nullif(p_type, upper(split_part(p_name, ' ', 1))) AS stored,
           p_type AS restored
    FROM part
    """,
)
def elide_restore(spark, folder):
    name = F.upper(F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)))
    stored = table(spark, folder, "part").select(
        "p_partkey", elide(F.col("p_type"), name).alias("stored"), name.alias("name")
    )
    return stored.select(
        "p_partkey", "stored", restore(F.col("stored"), F.col("name")).alias("restored")
    )


@query(
    "classify_kind",
    """
    SELECT CASE WHEN event_type = 'click' THEN 'click' WHEN event_type = 'view' THEN 'view'
                ELSE 'processor' END AS kind,
           count(*) AS n
    FROM events GROUP BY 1
    """,
)
def classify(spark, folder):
    mixed = F.when(F.col("value") > 20, F.upper("event_type")).otherwise(F.col("event_type"))
    kind = classify_kind(mixed, ("CLICK", "VIEW"))
    events = table(spark, folder, "events")
    return events.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "position_roundtrip",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST(CAST(round(l_quantity - 25) AS BIGINT) AS VARCHAR) || ','
           || CAST(CAST(round(l_extendedprice) AS BIGINT) AS VARCHAR) AS position,
           round(l_quantity - 25) + 0.0 AS x, round(l_extendedprice) AS y
    FROM lineitem
    """,
)
def position_roundtrip(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        format_position(F.col("l_quantity") - 25, F.col("l_extendedprice")).alias("position"),
    )
    return lines.withColumn("_p", parse_position(F.col("position"))).select(
        *lines.columns, F.col("_p.x").alias("x"), F.col("_p.y").alias("y")
    )


@query(
    "extent_margin",
    """
    SELECT l_returnflag, max(l_quantity) + 500 AS max_x, max(l_extendedprice) + 500 AS max_y
    FROM lineitem GROUP BY l_returnflag
    """,
)
def extent_margin(spark, folder):
    return sparse.extent(
        table(spark, folder, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice"
    )


def order_sections(spark, folder):
    """Orders with settings of several sections; low-priority ones are remote groups."""
    orders = table(spark, folder, "orders")
    priority, remote = F.col("o_orderpriority"), F.col("o_orderpriority") == "5-LOW"
    cell = lambda section, key, value, when=F.lit(True): F.when(
        when,
        F.struct(
            F.lit(section).alias("section"), F.lit(key).alias("key"), value.cast("string").alias("value")
        ),
    )
    level = F.when(priority == "1-URGENT", "WARN").when(priority != "2-HIGH", "ERROR")
    cells = F.array(
        cell("property", "priority", priority),
        cell("scheduling", "bulletinLevel", level),
        cell("style", "border", F.col("o_orderstatus")),
        cell("remote", "protocol", F.when(F.col("o_totalprice") < 200000, "RAW").otherwise("HTTP"), remote),
        cell("remote", "proxyHost", F.when(F.col("o_orderstatus") == "F", "").otherwise("h"), remote),
    )
    values = orders.select(
        F.col("o_orderkey").alias("owner_id"), F.inline(F.array_compact(cells))
    )
    owners = orders.select(
        F.col("o_orderkey").alias("owner_id"),
        F.concat(F.lit("T"), "o_orderstatus").alias("type"),
        F.when(remote, "REMOTE_PROCESS_GROUP").otherwise("PROCESSOR").alias("kind"),
    )
    return values, owners


REMOTE_PROTOCOL = "CASE WHEN o_totalprice < 200000 THEN 'RAW' ELSE 'HTTP' END"


@query(
    "sparse_settings",
    f"""
    SELECT o_orderkey AS owner_id, 'property' AS section, 'priority' AS key, o_orderpriority AS value,
           false AS cleared
    FROM orders
    WHERE (o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT') OR o_orderstatus = 'O'
    UNION ALL
    SELECT o_orderkey, 'property', 'note', NULL, true FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderkey, 'scheduling', 'bulletinLevel', 'ERROR', false FROM orders
    WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
    UNION ALL
    SELECT o_orderkey, 'style', 'border', o_orderstatus, false FROM orders
    UNION ALL
    SELECT o_orderkey, 'remote', 'protocol', 'HTTP', false FROM orders
    WHERE o_orderpriority = '5-LOW' AND {REMOTE_PROTOCOL} = 'HTTP'
    UNION ALL
    SELECT o_orderkey, 'remote', k, NULL, true
    FROM orders CROSS JOIN (VALUES ('timeout'), ('yieldDuration')) AS d(k)
    WHERE o_orderpriority = '5-LOW'
    UNION ALL
    SELECT o_orderkey, 'remote', 'proxyHost', 'h', false FROM orders
    WHERE o_orderpriority = '5-LOW' AND o_orderstatus <> 'F'
    """,
)
def sparse_settings_of_orders(spark, folder):
    values, owners = order_sections(spark, folder)
    described = literal_table(
        spark,
        [("TF", "priority", ["1-URGENT"]), ("TF", "note", ["none"]), ("TO", "priority", None)],
        "type string, key string, defaults array<string>",
    )
    return settings.sparse_settings(values, owners, described)


@query(
    "full_settings",
    f"""
    SELECT o_orderkey AS owner_id, 'protocol' AS key, {REMOTE_PROTOCOL} AS value FROM orders
    WHERE o_orderpriority = '5-LOW'
    UNION ALL
    SELECT o_orderkey, k, v
    FROM orders CROSS JOIN (VALUES ('timeout', '30 sec'), ('yieldDuration', '10 sec')) AS d(k, v)
    WHERE o_orderpriority = '5-LOW'
    UNION ALL
    SELECT o_orderkey, 'proxyHost', 'h' FROM orders
    WHERE o_orderpriority = '5-LOW' AND o_orderstatus <> 'F'
    """,
)
def full_settings_of_orders(spark, folder):
    values, owners = order_sections(spark, folder)
    stored = settings.sparse_settings(values, owners)
    remote_groups = owners.where("kind = 'REMOTE_PROCESS_GROUP'")
    return settings.full_settings(stored, remote_groups, "remote")
