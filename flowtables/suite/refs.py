"""Reference and connection queries: line items stand for connections, parts for components."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtables.functions.values import edge_labels, edge_target, effective_id, endpoint_kind
from flowtables.operators import refs
from flowtables.operators.sparse import unpivot_text
from flowtables.operators.spread import dealt
from flowtables.sources.tables import table
from flowtables.suite.registry import query

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@query(
    "effective_endpoint",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN l_returnflag = 'R' THEN l_suppkey ELSE l_partkey END AS endpoint
    FROM lineitem
    """,
)
def effective_endpoint(spark, folder):
    endpoint = effective_id(F.col("l_returnflag"), F.col("l_partkey"), F.col("l_suppkey"), ["R"])
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", endpoint.alias("endpoint")
    )


def line_targets(spark, folder):
    """Suppliers, and regions, into which no line item leads."""
    suppliers = table(spark, folder, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id")
    )
    regions = table(spark, folder, "region").select(
        F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("id")
    )
    return suppliers.unionByName(regions)


def supplier_edges(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("dest_id"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
    )


TARGETS = """
    SELECT 's' || CAST(s_suppkey AS VARCHAR) AS id, s_suppkey FROM supplier
    UNION ALL SELECT 'r' || CAST(r_regionkey AS VARCHAR), NULL FROM region
"""


@query(
    "attach_inputs",
    f"""
    WITH n AS (
        SELECT *, row_number() OVER (PARTITION BY l_suppkey
                  ORDER BY l_orderkey, l_linenumber, l_partkey) - 1 AS place FROM lineitem
    )
    SELECT id, CAST(coalesce(place // 10000, 0) AS BIGINT) AS page,
           CAST(count(l_orderkey) AS INTEGER) AS n,
           min(l_orderkey) AS first_key, max(l_orderkey) AS last_key,
           coalesce(string_agg(CAST(l_orderkey AS VARCHAR), ','
                    ORDER BY l_orderkey, l_linenumber, l_partkey), '') AS keys
    FROM ({TARGETS}) LEFT JOIN n ON l_suppkey = s_suppkey
    GROUP BY ALL
    """,
)
def attach_inputs(spark, folder):
    attached = refs.attach_inputs(
        line_targets(spark, folder),
        supplier_edges(spark, folder),
        ["id"],
        ["dest_id"],
        ["l_orderkey", "l_linenumber", "l_partkey"],
        F.col("l_orderkey"),
    )
    return attached.select(
        "id",
        "page",
        F.size("inputs").alias("n"),
        F.array_min("inputs").alias("first_key"),
        F.array_max("inputs").alias("last_key"),
        F.array_join("inputs", ",").alias("keys"),
    )


@query(
    "flat_inputs",
    f"""
    SELECT id, l_orderkey, l_linenumber, l_partkey
    FROM ({TARGETS}) LEFT JOIN lineitem ON l_suppkey = s_suppkey
    """,
)
def flat_inputs(spark, folder):
    return refs.flat_inputs(
        line_targets(spark, folder), supplier_edges(spark, folder), ["id"], ["dest_id"]
    )


@query(
    "edge_labels",
    """
    SELECT o_orderkey,
           'status,' || o_orderstatus
           || CASE WHEN o_orderpriority = '1-URGENT' THEN ',urgent' ELSE '' END AS labels
    FROM orders
    """,
)
def edge_label_lists(spark, folder):
    labels = edge_labels(
        F.array(F.lit("status"), F.col("o_orderstatus")),
        F.lit("urgent"),
        F.col("o_orderpriority") == "1-URGENT",
    )
    return table(spark, folder, "orders").select(
        "o_orderkey", F.array_join(labels, ",").alias("labels")
    )


@query(
    "edge_targets",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN l_returnflag IN ('R', 'A') THEN s_name END AS target
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
    """,
)
def edge_targets(spark, folder):
    """Returned and accepted lines end at ports of a group, which the connection then names."""
    flag = F.col("l_returnflag")
    kind = F.when(flag == "R", "input_port").when(flag == "A", "REMOTE_INPUT_PORT").otherwise("PROCESSOR")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    lines = table(spark, folder, "lineitem")
    return lines.join(suppliers, lines["l_suppkey"] == suppliers["s_suppkey"], "left").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        edge_target(F.col("s_name"), kind).alias("target"),
    )


# Two workspaces that hold the same ids, which stand for different things in each.
WORKSPACES = (("a", 1000000), ("b", 2000000))


def in_workspaces(df):
    """Every row once in each workspace (``workspace``, ``shift``)."""
    spaces = [F.struct(F.lit(w).alias("workspace"), F.lit(n).alias("shift")) for w, n in WORKSPACES]
    return df.select(F.inline(F.array(*spaces)), *df.columns)


SPACES = "(VALUES ('a', 1000000), ('b', 2000000)) AS w(workspace, shift)"


@query(
    "remap_ids",
    f"""
    SELECT workspace, o_orderkey, o_custkey + shift AS o_custkey FROM orders CROSS JOIN {SPACES}
    """,
)
def remap_ids(spark, folder):
    customers = in_workspaces(table(spark, folder, "customer").select("c_custkey"))
    tracked = customers.select(
        "workspace",
        F.col("c_custkey").alias("old_id"),
        # every id is tracked twice; the later entry counts
        F.inline(
            F.array(
                F.struct(F.lit(1).alias("ord"), F.lit(-1).cast("bigint").alias("new_id")),
                F.struct(F.lit(2).alias("ord"), (F.col("c_custkey") + F.col("shift")).alias("new_id")),
            )
        ),
    )
    orders = in_workspaces(table(spark, folder, "orders").select("o_orderkey", "o_custkey"))
    id_map = refs.latest_ids(tracked, scope=["workspace"])
    return refs.remap_ids(orders.drop("shift"), id_map, ["o_custkey"], scope=["workspace"])


@query(
    "remap_values",
    f"""
    SELECT workspace, o_orderkey, 'customer' AS key,
           CASE WHEN c.c_custkey IS NOT NULL THEN workspace || '-' || CAST(o_custkey AS VARCHAR)
                ELSE CAST(o_custkey AS VARCHAR) END AS value
    FROM orders CROSS JOIN {SPACES} LEFT JOIN customer c
      ON c.c_custkey = o_custkey AND (c.c_acctbal > 0) = (workspace = 'a')
    UNION ALL SELECT workspace, o_orderkey, 'note', 'see ' || CAST(o_custkey AS VARCHAR)
    FROM orders CROSS JOIN {SPACES}
    UNION ALL SELECT workspace, o_orderkey, 'status', nullif(o_orderstatus, 'P')
    FROM orders CROSS JOIN {SPACES}
    """,
)
def remap_values(spark, folder):
    customer = F.col("o_custkey").cast("string")
    properties = unpivot_text(
        in_workspaces(table(spark, folder, "orders")),
        ["workspace", "o_orderkey"],
        {
            "customer": customer,
            "note": F.concat(F.lit("see "), customer),
            "status": F.nullif(F.col("o_orderstatus"), F.lit("P")),
        },
    )
    key = F.col("c_custkey").cast("string")
    id_map = (
        in_workspaces(table(spark, folder, "customer").select("c_custkey", "c_acctbal"))
        .where((F.col("c_acctbal") > 0) == (F.col("workspace") == "a"))
        .select(
            "workspace", key.alias("old_id"), F.concat("workspace", F.lit("-"), key).alias("new_id")
        )
    )
    return refs.remap_values(properties, id_map, id_pattern="^[0-9]+$", scope=["workspace"])


@query(
    "resolve_named",
    """
    SELECT n_nationkey AS ref, n_nationkey AS resolved_id, CAST(1 AS BIGINT) AS matches FROM nation
    """,
)
def resolve_named(spark, folder):
    nation = table(spark, folder, "nation")
    references = nation.select(
        F.col("n_nationkey").alias("ref"), F.col("n_regionkey").alias("grp"), "n_name"
    )
    return refs.resolve_named(
        references, nation, ["grp", "n_name"], ["n_regionkey", "n_name"], "n_nationkey", "error"
    ).select("ref", "resolved_id", "matches")


@query(
    "resolve_named_ambiguous",
    """
    WITH k AS (
        SELECT p_brand, p_name, count(*) AS n, min(p_partkey) AS one FROM part GROUP BY ALL
    )
    SELECT o_orderkey, p.p_brand, p.p_name || s AS p_name,
           CASE WHEN s = '' AND n = 1 THEN one END AS resolved_id,
           CASE WHEN s = '' THEN n ELSE 0 END AS matches
    FROM (
        SELECT o_orderkey, o_custkey AS partkey,
               CASE WHEN o_orderpriority = '5-LOW' THEN '?' ELSE '' END AS s FROM orders
    ) o
    JOIN part p ON p.p_partkey = o.partkey
    JOIN k ON k.p_brand = p.p_brand AND k.p_name = p.p_name
    """,
)
def resolve_named_ambiguous(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_brand", "p_name")
    orders = table(spark, folder, "orders")
    unknown = F.when(F.col("o_orderpriority") == "5-LOW", "?").otherwise("")
    references = orders.join(part, orders.o_custkey == part.p_partkey).select(
        "o_orderkey", "p_brand", F.concat("p_name", unknown).alias("p_name")
    )
    return refs.resolve_named(
        references, part, ["p_brand", "p_name"], ["p_brand", "p_name"], "p_partkey"
    )


@query(
    "endpoint_kind",
    """
    SELECT CASE o_orderpriority WHEN '1-URGENT' THEN '1-URGENT' WHEN '2-HIGH' THEN '2-HIGH'
                WHEN '3-MEDIUM' THEN 'OUTPUT_PORT' WHEN '4-NOT SPECIFIED' THEN 'REMOTE_OUTPUT_PORT'
                ELSE 'PROCESSOR' END AS kind,
           count(*) AS n
    FROM orders GROUP BY 1
    """,
)
def endpoint_kinds(spark, folder):
    kind = endpoint_kind(
        F.col("o_orderpriority"),
        "source",
        ports=("1-URGENT",),
        group="3-MEDIUM",
        remote_group="4-NOT SPECIFIED",
        known=("2-HIGH",),
    )
    orders = table(spark, folder, "orders")
    return orders.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def flow_components(spark, folder):
    """Orders and parts as components of two workspaces with equal ids.

    Workspace ``a`` lacks the smaller parts and ``b`` the larger ones; parts of size 20 are groups.
    """
    orders = table(spark, folder, "orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "funnel")
        .when(F.col("o_orderpriority") == "2-HIGH", "process_group")
        .otherwise(F.col("o_orderstatus"))
        .alias("kind"),
    )
    parts = (
        in_workspaces(table(spark, folder, "part").select("p_partkey", "p_size"))
        .where((F.col("p_size") > 10) == (F.col("workspace") == "a"))
        .select(
            "workspace",
            F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"),
            F.when(F.col("p_size") == 20, "PROCESS_GROUP").otherwise("INPUT_PORT").alias("kind"),
        )
    )
    return in_workspaces(orders).drop("shift").unionByName(parts)


def flow_edges(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("source_id"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dest_id"),
        F.array("l_returnflag", "l_linestatus").alias("relationships"),
        F.col("l_linestatus").alias("from_port"),
        F.col("l_returnflag").alias("to_port"),
    )
    return in_workspaces(lines).drop("shift")


def group_ports(spark, folder):
    """Ports inside the groups: an output port ``O`` in orders, input ports ``N`` and (twice) ``R`` in parts."""
    orders = (
        in_workspaces(table(spark, folder, "orders").where("o_orderpriority = '2-HIGH'"))
        .select(
            "workspace",
            F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("group_id"),
            F.lit("O").alias("name"),
            F.lit("OUTPUT_PORT").alias("kind"),
            F.concat("workspace", F.lit("-out-"), F.col("o_orderkey").cast("string")).alias("port_id"),
        )
    )
    key = F.col("p_partkey").cast("string")
    inputs = [
        F.struct(F.lit(n).alias("name"), F.concat("workspace", F.lit(f"-{k}-"), key).alias("port_id"))
        for n, k in (("N", "n"), ("R", "r1"), ("R", "r2"))
    ]
    parts = (
        in_workspaces(table(spark, folder, "part").where("p_size = 20"))
        .select("workspace", F.concat(F.lit("p"), key).alias("group_id"), F.inline(F.array(*inputs)))
        .withColumn("kind", F.lit("INPUT_PORT"))
    )
    return orders.unionByName(parts)


@query(
    "build_edges",
    f"""
    WITH ends AS (
        SELECT workspace, l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus,
               o_orderpriority, p_partkey, coalesce(p_size = 20, false) AS grouped
        FROM lineitem CROSS JOIN {SPACES} JOIN orders ON o_orderkey = l_orderkey
        LEFT JOIN part ON p_partkey = l_partkey AND (p_size > 10) = (workspace = 'a')
    ), ports AS (
        SELECT *, CASE WHEN o_orderpriority = '2-HIGH'
                       THEN CAST(l_linestatus = 'O' AS BIGINT) END AS source_ports,
               CASE WHEN grouped THEN CAST(CASE l_returnflag WHEN 'N' THEN 1 WHEN 'R' THEN 2 ELSE 0 END
                    AS BIGINT) END AS dest_ports
        FROM ends
    )
    SELECT workspace, l_orderkey, l_linenumber, l_partkey,
           'o' || CAST(l_orderkey AS VARCHAR) AS source_id,
           'p' || CAST(l_partkey AS VARCHAR) AS dest_id,
           l_linestatus AS from_port, l_returnflag AS to_port,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'FUNNEL' WHEN '2-HIGH' THEN 'OUTPUT_PORT'
                ELSE 'PROCESSOR' END AS source_kind,
           CASE WHEN p_partkey IS NOT NULL THEN 'INPUT_PORT' ELSE 'PROCESSOR' END AS dest_kind,
           CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
                THEN l_returnflag || ',' || l_linestatus END AS relationships,
           CASE WHEN source_ports = 1 THEN workspace || '-out-' || CAST(l_orderkey AS VARCHAR) END
               AS source_port_id, source_ports,
           CASE WHEN dest_ports = 1 THEN workspace || '-n-' || CAST(l_partkey AS VARCHAR) END
               AS dest_port_id, dest_ports,
           p_partkey IS NOT NULL AND coalesce(source_ports, 1) = 1 AND coalesce(dest_ports, 1) = 1
               AS valid
    FROM ports
    """,
)
def build_edges(spark, folder):
    built = refs.build_edges(
        flow_edges(spark, folder),
        flow_components(spark, folder),
        scope=["workspace"],
        ports=group_ports(spark, folder),
    )
    return built.withColumn("relationships", F.array_join("relationships", ","))


@query(
    "dangling_edges",
    f"""
    SELECT workspace, l_orderkey, l_linenumber, l_partkey, 'destination' AS missing_side,
           'p' || CAST(l_partkey AS VARCHAR) AS missing_id
    FROM lineitem CROSS JOIN {SPACES}
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE (p_size > 10) = (workspace = 'a'))
    """,
)
def dangling_edges(spark, folder):
    lost = refs.dangling(
        flow_edges(spark, folder), flow_components(spark, folder), scope=["workspace"]
    )
    return lost.select(
        "workspace", "l_orderkey", "l_linenumber", "l_partkey", "missing_side", "missing_id"
    )


UNUSED = """
    SELECT u.user_id, r.relationship
    FROM (SELECT DISTINCT user_id FROM events) u
    CROSS JOIN (
        SELECT t || '-' || CAST(h AS VARCHAR) AS relationship
        FROM (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) AS k(t), range(24) AS h(h)
    ) AS r
    WHERE NOT EXISTS (
        SELECT 1 FROM events e WHERE e.user_id = u.user_id
        AND e.event_type || '-' || CAST(hour(e.ts) AS VARCHAR) = r.relationship)
"""


def declared_relationships(events):
    """Every relationship of every user: 120 rows of each, so the users are dealt out first."""
    declared = F.array(*[F.lit(f"{t}-{hour}") for t in EVENT_TYPES for hour in range(24)])
    users = dealt(events.select("user_id").distinct())
    return users.select("user_id", F.explode(declared).alias("relationship"))


def unused(spark, folder):
    """Relationships are event types by hour of the day; all events use one."""
    events = table(spark, folder, "events")
    used = F.concat("event_type", F.lit("-"), F.hour("ts").cast("string"))
    return refs.unused_relationships(
        declared_relationships(events),
        refs.used_relationships(
            events.select("user_id", F.array(used).alias("relationships")), "user_id", "relationships"
        ),
        ["user_id"],
    )


@query("unused_relationships", UNUSED)
def unused_relationships(spark, folder):
    return unused(spark, folder)


@query(
    "auto_terminate",
    f"""
    SELECT user_id, CAST(0 AS BIGINT) AS page,
           string_agg(relationship, ',' ORDER BY relationship) AS relationships,
           CAST(count(*) AS INTEGER) AS n
    FROM ({UNUSED}) GROUP BY user_id
    """,
)
def auto_terminate(spark, folder):
    lists = refs.auto_terminate(unused(spark, folder), ["user_id"])
    return lists.select(
        "user_id",
        "page",
        F.array_join("relationships", ",").alias("relationships"),
        F.size("relationships").alias("n"),
    )
