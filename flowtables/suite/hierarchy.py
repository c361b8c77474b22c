"""Hierarchy queries: region → nation → customer → order as one tree of groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtables.operators.hierarchy import expand_hierarchy
from flowtables.plans.lifecycle import state_plan, teardown_plan
from flowtables.sources.tables import table
from flowtables.suite.registry import query


def tree_refs(spark, folder):
    """Links (parent_id, id, ord) with the scope ``region``, and which nodes exist."""

    def node(letter, column):
        return F.concat(F.lit(letter), F.col(column).cast("string"))

    nations = table(spark, folder, "nation")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return (
        nations.select(
            node("R", "n_regionkey").alias("parent_id"),
            node("N", "n_nationkey").alias("id"),
            F.col("n_nationkey").cast("bigint").alias("ord"),
        )
        .unionByName(
            customers.select(
                node("N", "c_nationkey").alias("parent_id"),
                node("C", "c_custkey").alias("id"),
                F.col("c_custkey").alias("ord"),
            )
        )
        .unionByName(
            orders.select(
                node("C", "o_custkey").alias("parent_id"),
                node("O", "o_orderkey").alias("id"),
                F.col("o_orderkey").alias("ord"),
            )
        )
    )


def places(spark, folder):
    roots = table(spark, folder, "region").select(
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("id")
    )
    return expand_hierarchy(tree_refs(spark, folder), roots)


@query(
    "expand_hierarchy",
    """
    WITH RECURSIVE links AS (
        SELECT 'R' || CAST(n_regionkey AS VARCHAR) AS parent_id,
               'N' || CAST(n_nationkey AS VARCHAR) AS id, CAST(n_nationkey AS BIGINT) AS ord FROM nation
        UNION ALL
        SELECT 'N' || CAST(c_nationkey AS VARCHAR), 'C' || CAST(c_custkey AS VARCHAR), c_custkey
        FROM customer
        UNION ALL
        SELECT 'C' || CAST(o_custkey AS VARCHAR), 'O' || CAST(o_orderkey AS VARCHAR), o_orderkey
        FROM orders
    ), tree AS (
        SELECT 'R' || CAST(r_regionkey AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS parent_id,
               0 AS depth, 'R' || CAST(r_regionkey AS VARCHAR) AS path, '' AS ords FROM region
        UNION ALL
        SELECT l.id, l.parent_id, t.depth + 1, t.path || '/' || l.id,
               t.ords || '/' || CAST(l.ord AS VARCHAR)
        FROM tree t JOIN links l ON l.parent_id = t.id
    )
    SELECT id, parent_id, depth, path, ords, 'ok' AS status FROM tree
    """,
)
def expand(spark, folder):
    return places(spark, folder).select(
        "id",
        "parent_id",
        "depth",
        F.array_join("path", "/").alias("path"),
        F.array_join(F.transform("ords", lambda o: F.concat(F.lit("/"), o.cast("string"))), "").alias(
            "ords"
        ),
        "status",
    )


ORDER_KINDS = {
    "1-URGENT": "PROCESSOR",
    "2-HIGH": "INPUT_PORT",
    "3-MEDIUM": "OUTPUT_PORT",
    "4-NOT SPECIFIED": "CONTROLLER",
    "5-LOW": "REMOTE_PROCESS_GROUP",
}


def order_kind():
    kind = F.lit(None).cast("string")
    for priority, name in ORDER_KINDS.items():
        kind = F.when(F.col("o_orderpriority") == priority, name).otherwise(kind)
    return kind


@query(
    "state_plan",
    """
    WITH c AS (
        SELECT c_nationkey, c_custkey, o_orderkey AS id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'PROCESSOR' WHEN '2-HIGH' THEN 'INPUT_PORT'
                    WHEN '3-MEDIUM' THEN 'OUTPUT_PORT' WHEN '4-NOT SPECIFIED' THEN 'CONTROLLER'
                    ELSE 'REMOTE_PROCESS_GROUP' END AS kind,
               CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
                    WHEN '4-NOT SPECIFIED' THEN 4 ELSE 6 END AS rnk,
               CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'enabled' WHEN '5-LOW' THEN 'transmitting'
                    ELSE 'running' END AS word,
               o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' AS twice
        FROM orders JOIN customer ON c_custkey = o_custkey
    ), s AS (
        SELECT *, CAST(1 AS BIGINT) AS step, CASE WHEN twice THEN 'stopped' ELSE word END AS state FROM c
        UNION ALL SELECT *, 2, word FROM c WHERE twice
    )
    SELECT c_nationkey, id, kind, step, state,
           row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey, rnk, id, step) AS position
    FROM s
    """,
)
def state_steps(spark, folder):
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    components = orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        "c_nationkey",
        F.col("o_orderkey").alias("id"),
        order_kind().alias("kind"),
        F.when(F.col("o_orderstatus") == "F", "DISABLED").alias("status"),
        F.array("c_custkey").alias("group_ords"),
        F.col("o_orderkey").alias("ord"),
    )
    return state_plan(components, ["c_nationkey"], "enabled")


@query(
    "teardown_plan",
    """
    WITH p AS (
        SELECT n_regionkey AS region, n_nationkey AS n, NULL AS c, NULL AS o,
               'N' || CAST(n_nationkey AS VARCHAR) AS id, 'PROCESS_GROUP' AS kind FROM nation
        UNION ALL
        SELECT n_regionkey, n_nationkey, c_custkey, NULL,
               'C' || CAST(c_custkey AS VARCHAR), 'PROCESS_GROUP'
        FROM customer JOIN nation ON n_nationkey = c_nationkey
        UNION ALL
        SELECT n_regionkey, n_nationkey, c_custkey, o_orderkey,
               'O' || CAST(o_orderkey AS VARCHAR), 'PROCESSOR'
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    )
    SELECT 'R' || CAST(region AS VARCHAR) AS region, id, kind,
           row_number() OVER (PARTITION BY region
               ORDER BY n, c NULLS LAST, o NULLS LAST) AS position
    FROM p
    """,
)
def teardown(spark, folder):
    tree = places(spark, folder).where("depth > 0")
    components = tree.select(
        F.get("path", F.lit(0)).alias("region"),
        "id",
        F.when(F.col("id").startswith("O"), "PROCESSOR").otherwise("PROCESS_GROUP").alias("kind"),
        F.slice("ords", 1, F.col("depth") - 1).alias("group_ords"),
        F.element_at("ords", -1).alias("ord"),
    )
    return teardown_plan(components, ["region"])


@query(
    "teardown_all_kinds",
    """
    WITH c AS (
        SELECT n_regionkey AS region, n_nationkey AS n, c_custkey AS c
        FROM customer JOIN nation ON n_nationkey = c_nationkey
    ), o AS (
        SELECT region, n, c, o_orderkey AS id, o_orderpriority AS p FROM orders JOIN c ON c = o_custkey
    ), p AS (
        SELECT n_regionkey AS region, n_nationkey AS n, NULL AS r1, NULL AS o1, NULL AS r2, NULL AS o2,
               'N' || CAST(n_nationkey AS VARCHAR) AS id, 'PROCESS_GROUP' AS kind FROM nation
        UNION ALL
        SELECT n_regionkey, n_nationkey, CASE s_suppkey % 2 WHEN 0 THEN 3 ELSE 7 END, s_suppkey, NULL, NULL,
               'S' || CAST(s_suppkey AS VARCHAR), CASE s_suppkey % 2 WHEN 0 THEN 'FUNNEL' ELSE 'LABEL' END
        FROM supplier JOIN nation ON n_nationkey = s_nationkey
        UNION ALL
        SELECT region, n, 4, c, NULL, NULL, 'C' || CAST(c AS VARCHAR), 'PROCESS_GROUP' FROM c
        UNION ALL
        SELECT region, n, 4, c,
               CASE p WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 5 WHEN '3-MEDIUM' THEN 6
                    WHEN '4-NOT SPECIFIED' THEN 9 ELSE 8 END, id, 'O' || CAST(id AS VARCHAR),
               CASE p WHEN '1-URGENT' THEN 'PROCESSOR' WHEN '2-HIGH' THEN 'INPUT_PORT'
                    WHEN '3-MEDIUM' THEN 'OUTPUT_PORT' WHEN '4-NOT SPECIFIED' THEN 'CONTROLLER'
                    ELSE 'REMOTE_PROCESS_GROUP' END
        FROM o
        UNION ALL
        SELECT region, n, 4, c, 1, l_orderkey * 10 + l_linenumber,
               'L' || CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), 'CONNECTION'
        FROM lineitem JOIN o ON o.id = l_orderkey
    )
    SELECT region, id, kind, row_number() OVER (
        PARTITION BY region ORDER BY n, r1 NULLS LAST, o1 NULLS LAST, r2 NULLS LAST, o2 NULLS LAST, id
    ) AS position FROM p
    """,
)
def teardown_all_kinds(spark, folder):
    """Nations and customers as groups, suppliers, orders and their lines as what is in them."""
    nations = table(spark, folder, "nation").select(
        F.col("n_regionkey").alias("region"), F.col("n_nationkey").cast("bigint").alias("n")
    )

    def inside(rows, nation, *columns):
        return rows.join(nations, F.col(nation) == F.col("n")).select("region", "n", *columns)

    def component(rows, letter, ord_column, kind, *groups):
        ords = F.array(*groups) if groups else F.array().cast("array<bigint>")
        return rows.select(
            "region",
            F.concat(F.lit(letter), ord_column.cast("string")).alias("id"),
            kind.alias("kind"),
            ords.alias("group_ords"),
            ord_column.cast("bigint").alias("ord"),
        )

    suppliers = inside(table(spark, folder, "supplier"), "s_nationkey", "s_suppkey")
    customers = inside(table(spark, folder, "customer"), "c_nationkey", F.col("c_custkey").cast("bigint").alias("c"))
    orders = (
        table(spark, folder, "orders")
        .select("o_orderkey", "o_custkey", order_kind().alias("kind"))
        .join(customers, F.col("o_custkey") == F.col("c"))
    )
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    wired = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    group, line = F.lit("PROCESS_GROUP"), F.col("l_orderkey") * 10 + F.col("l_linenumber")
    supplied = F.when(F.col("s_suppkey") % 2 == 0, "FUNNEL").otherwise("LABEL")
    parts = [
        component(nations, "N", F.col("n"), group),
        component(suppliers, "S", F.col("s_suppkey"), supplied, "n"),
        component(customers, "C", F.col("c"), group, "n"),
        component(orders, "O", F.col("o_orderkey"), F.col("kind"), "n", "c"),
        component(wired, "L", line, F.lit("CONNECTION"), "n", "c"),
    ]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return teardown_plan(together, ["region"])
