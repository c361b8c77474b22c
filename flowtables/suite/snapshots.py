"""Snapshot, structure and document queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtables.operators import compare
from flowtables.operators.spread import numbered
from flowtables.schemas import TABLES, empty_table
from flowtables.session import scratch_path
from flowtables.sources import exports
from flowtables.sources.tables import table
from flowtables.suite.registry import query


@query(
    "diff_snapshots",
    """
    WITH b AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders),
    a AS (
        SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
               CASE WHEN o_totalprice > 400000 THEN NULL ELSE o_totalprice END AS o_totalprice,
               o_orderpriority
        FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P')
        UNION ALL
        SELECT o_orderkey + 1000000000, o_orderstatus, o_totalprice, o_orderpriority
        FROM orders WHERE o_orderstatus = 'P'
    )
    SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey,
           CASE WHEN b.o_orderkey IS NULL THEN 'added' WHEN a.o_orderkey IS NULL THEN 'removed'
                ELSE 'changed' END AS change,
           CASE WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL THEN concat_ws(',',
                CASE WHEN a.o_orderstatus IS DISTINCT FROM b.o_orderstatus THEN 'o_orderstatus' END,
                CASE WHEN a.o_totalprice IS DISTINCT FROM b.o_totalprice THEN 'o_totalprice' END)
                END AS changed_columns,
           b.o_totalprice AS old_price, a.o_totalprice AS new_price
    FROM b FULL JOIN a ON a.o_orderkey = b.o_orderkey
    WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL
       OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus
       OR a.o_totalprice IS DISTINCT FROM b.o_totalprice
    """,
)
def diff_snapshots(spark, folder):
    before = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )
    dropped = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    edited = before.where(~dropped).withColumns(
        {
            "o_orderstatus": F.when(urgent, "X").otherwise(F.col("o_orderstatus")),
            "o_totalprice": F.when(F.col("o_totalprice") <= 400000, F.col("o_totalprice")),
        }
    )
    new = before.where("o_orderstatus = 'P'").withColumn(
        "o_orderkey", F.col("o_orderkey") + 1000000000
    )
    return compare.diff_snapshots(before, edited.unionByName(new), ["o_orderkey"]).select(
        "o_orderkey",
        "change",
        F.array_join("changed_columns", ",").alias("changed_columns"),
        F.col("before.o_totalprice").alias("old_price"),
        F.col("after.o_totalprice").alias("new_price"),
    )


@query(
    "diff_within_customers",
    """
    SELECT o_custkey, o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'removed' ELSE 'changed' END AS change
    FROM orders WHERE o_custkey % 100 = 7 AND (o_orderpriority = '5-LOW' OR o_totalprice > 100000)
    """,
)
def diff_within_customers(spark, folder):
    """Orders of a few customers edited: the others are told apart by their sums only."""
    before = table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice"
    )
    edited, low = F.col("o_custkey") % 100 == 7, F.col("o_orderpriority") == "5-LOW"
    price = F.when(edited & (F.col("o_totalprice") > 100000), None).otherwise(F.col("o_totalprice"))
    after = before.where(~(edited & low)).withColumn("o_totalprice", price)
    changes = compare.diff_snapshots(before, after, ["o_custkey", "o_orderkey"], ["o_custkey"])
    return changes.select("o_custkey", "o_orderkey", "change")


@query(
    "merge_snapshots",
    """
    WITH c AS (SELECT c_custkey AS k, c_mktsegment AS seg, c_nationkey AS nat, c_acctbal AS bal FROM customer),
    m AS (
        SELECT k, seg AS b_seg, nat AS b_nat,
               CASE WHEN bal > 5000 THEN 'OURS' WHEN nat = 1 THEN 'SAME' ELSE seg END AS o_seg, nat AS o_nat,
               nat <> 3 AS o_here,
               CASE WHEN seg = 'BUILDING' THEN 'THEIRS' WHEN nat = 1 AND bal <= 5000 THEN 'SAME' ELSE seg END AS t_seg,
               CASE WHEN seg = 'MACHINERY' THEN -1 ELSE nat END AS t_nat, nat <> 2 AS t_here
        FROM c
    ), s AS (
        SELECT *, o_here AND o_seg = b_seg AND o_nat = b_nat AS o_is_b,
               t_here AND t_seg = b_seg AND t_nat = b_nat AS t_is_b,
               (NOT o_here AND NOT t_here) OR (o_here AND t_here AND o_seg = t_seg AND o_nat = t_nat) AS o_is_t,
               o_here AND t_here AS both_here,
               o_seg <> b_seg AND t_seg <> b_seg AND o_seg <> t_seg AS clash
        FROM m
    ), d AS (
        SELECT *, CASE WHEN o_is_b AND t_is_b THEN 'unchanged' WHEN t_is_b THEN 'ours'
                       WHEN o_is_b THEN 'theirs' WHEN o_is_t THEN 'same'
                       WHEN both_here AND NOT clash THEN 'merged' ELSE 'conflict' END AS status FROM s
    )
    SELECT k, status,
           CASE status WHEN 'ours' THEN o_here WHEN 'same' THEN o_here WHEN 'theirs' THEN t_here
                WHEN 'conflict' THEN CASE WHEN both_here THEN true END ELSE true END AS present,
           CASE WHEN status IN ('unchanged', 'ours', 'same') THEN CASE WHEN o_here THEN o_seg END
                WHEN status = 'theirs' THEN CASE WHEN t_here THEN t_seg END
                WHEN both_here THEN CASE WHEN o_seg = b_seg THEN t_seg
                     WHEN t_seg = b_seg OR o_seg = t_seg THEN o_seg END END AS seg,
           CASE WHEN status IN ('unchanged', 'ours', 'same') THEN CASE WHEN o_here THEN o_nat END
                WHEN status = 'theirs' THEN CASE WHEN t_here THEN t_nat END
                WHEN both_here THEN t_nat END AS nat,
           CASE WHEN status <> 'conflict' THEN '' WHEN both_here THEN 'seg' ELSE 'seg,nat' END AS conflicts
    FROM d
    """,
)
def merge_snapshots(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("k"),
        F.col("c_mktsegment").alias("seg"),
        F.col("c_nationkey").alias("nat"),
        F.col("c_acctbal").alias("bal"),
    )
    seg, rich, first = F.col("seg"), F.col("bal") > 5000, F.col("nat") == 1
    base = customers.drop("bal")
    ours = customers.where("nat <> 3").select(
        "k", F.when(rich, "OURS").when(first, "SAME").otherwise(seg).alias("seg"), "nat"
    )
    theirs = customers.where("nat <> 2").select(
        "k",
        F.when(seg == "BUILDING", "THEIRS").when(first & ~rich, "SAME").otherwise(seg).alias("seg"),
        F.when(seg == "MACHINERY", -1).otherwise(F.col("nat")).alias("nat"),
    )
    return compare.merge_snapshots(base, ours, theirs, ["k"]).select(
        "k", "status", "present", "seg", "nat", F.array_join("conflicts", ",").alias("conflicts")
    )


@query(
    "structural_groups",
    r"""
    SELECT min(doc_id) AS first_member, count(*) AS members FROM (
        SELECT doc_id, regexp_replace(regexp_replace(lower(text), '[0-9]', '0', 'g'),
                                      '[ \t\r\n]+', ' ', 'g') AS shape
        FROM documents)
    GROUP BY shape HAVING count(*) >= 2
    """,
)
def structural_groups(spark, folder):
    shape = F.regexp_replace(
        F.regexp_replace(F.lower("text"), "[0-9]", "0"), "[ \\t\\r\\n]+", " "
    )
    documents = table(spark, folder, "documents").select("doc_id", shape.alias("shape"))
    signatures = compare.structural_signatures(documents, ["doc_id"], ["shape"])
    return compare.structural_groups(signatures, "doc_id").drop("signature")


@query(
    "structural_template",
    """
    WITH s AS (
        SELECT conv_id, string_agg(CAST(turn AS VARCHAR) || role, ',' ORDER BY turn, role) AS sig
        FROM conversations GROUP BY conv_id
    ), g AS (
        SELECT sig, min(conv_id) AS first_member, count(*) AS members FROM s GROUP BY sig
        HAVING count(*) >= 2
    )
    SELECT g.first_member, g.members, c.turn AS slot,
           count(c.text) > 0 AND (min(c.text) <> max(c.text) OR count(c.text) < g.members) AS varies,
           CASE WHEN min(c.text) = max(c.text) AND count(c.text) = g.members THEN min(c.text) END AS value
    FROM g JOIN s ON s.sig = g.sig JOIN conversations c ON c.conv_id = s.conv_id
    GROUP BY g.first_member, g.members, g.sig, c.turn
    """,
)
def structural_template(spark, folder):
    turns = table(spark, folder, "conversations")
    signatures = compare.structural_signatures(turns, ["conv_id"], ["turn", "role"])
    groups = compare.structural_groups(signatures, "conv_id")
    values = turns.select("conv_id", F.col("turn").alias("slot"), F.col("text").alias("value"))
    slots, _ = compare.structural_template(values, signatures, groups, "conv_id")
    return slots.join(groups, "signature").select(
        "first_member", "members", "slot", "varies", "value"
    )


def order_flows(spark, folder):
    """Orders of two workspaces as flows: the order, then its lines one behind the other.

    The second workspace has the finished orders again, under other ids and without their last line.
    """
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    lines = numbered(
        table(spark, folder, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity"
        ),
        ["l_orderkey"],
        ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus"],
        "place",
    )
    # the lines of an order are numbered without gaps, so its last number is their count
    finished = orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    last = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("last"))
    lines = lines.join(last.join(finished, "l_orderkey", "left_semi"), "l_orderkey", "left")

    def spaces(again):
        return F.explode(F.when(again, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a"))))

    heads = orders.withColumn("workspace", spaces(F.col("o_orderstatus") == "F"))
    items = lines.withColumn("workspace", spaces(F.col("place") < F.col("last")))
    key, own = (
        F.concat("workspace", F.lit("/"), F.col(c).cast("string")) for c in ("o_orderkey", "l_orderkey")
    )
    number = F.col("place")

    def line(n):
        return F.when(n == 0, "order").otherwise(F.concat(F.lit("line"), n.cast("string")))

    components = heads.select(
        "workspace", key.alias("flow"), F.lit("order").alias("id"), F.col("o_orderpriority").alias("kind")
    ).unionByName(
        items.select("workspace", own.alias("flow"), line(number).alias("id"), F.col("l_returnflag").alias("kind"))
    )
    edges = items.select(
        "workspace", own.alias("flow"), line(number - 1).alias("source_id"),
        line(number).alias("dest_id"), F.array("l_linestatus").alias("relationships"),
    )
    values = items.select(
        "workspace", own.alias("flow"), line(number).alias("id"),
        F.col("l_quantity").cast("bigint").cast("string").alias("value"),
    )
    return components, edges, values


ORDER_TEXTS = """
    WITH placed AS (
        SELECT l_orderkey, l_returnflag, l_linestatus, l_quantity,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                                  l_quantity, l_returnflag, l_linestatus) AS place,
               count(*) OVER (PARTITION BY l_orderkey) AS last FROM lineitem),
    items AS (
        SELECT 'a/' || CAST(l_orderkey AS VARCHAR) AS flow, * FROM placed
        UNION ALL
        SELECT 'b/' || CAST(l_orderkey AS VARCHAR), p.*
        FROM placed p JOIN orders ON o_orderkey = l_orderkey
        WHERE o_orderstatus = 'F' AND place < last),
    heads AS (
        SELECT 'a/' || CAST(o_orderkey AS VARCHAR) AS flow, o_orderpriority FROM orders
        UNION ALL
        SELECT 'b/' || CAST(o_orderkey AS VARCHAR), o_orderpriority FROM orders WHERE o_orderstatus = 'F'),
    texts AS (
        SELECT flow, o_orderpriority || coalesce(lines, '') AS body FROM heads LEFT JOIN (
            SELECT flow, string_agg('>' || l_linestatus || l_returnflag, '' ORDER BY place) AS lines
            FROM items GROUP BY flow) USING (flow)),
    groups AS (
        SELECT body, min(flow) AS first_member, count(*) AS members FROM texts GROUP BY body
        HAVING count(*) >= 2)"""


@query("structural_wiring", ORDER_TEXTS + " SELECT first_member, members FROM groups")
def structural_wiring(spark, folder):
    components, edges, _ = order_flows(spark, folder)
    nothing = components.select("workspace", "flow", F.col("id").alias("owner_id"), F.lit("").alias("key"))
    scope = ["workspace", "flow"]
    shapes = compare.component_shapes(components, nothing.limit(0), edges, scope)
    signatures = compare.structural_signatures(shapes, ["flow"], ["shape"])
    return compare.structural_groups(signatures, "flow").drop("signature")


@query(
    "structural_variables",
    ORDER_TEXTS
    + """, slots AS (
        SELECT first_member, members, place, count(DISTINCT l_quantity) AS k
        FROM groups JOIN texts USING (body) JOIN items USING (flow) GROUP BY ALL)
    SELECT first_member, members, count(*) AS slots,
           CAST(count(*) FILTER (k > 1) AS BIGINT) AS varying FROM slots GROUP BY ALL
    """,
)
def structural_variables(spark, folder):
    """The variable table of same flows, by ordinals that the operator finds itself."""
    components, edges, values = order_flows(spark, folder)
    nothing = components.select("workspace", "flow", F.col("id").alias("owner_id"), F.lit("").alias("key"))
    ordinals, signatures = compare.component_ordinals(
        components, nothing.limit(0), edges, "flow", ["workspace", "flow"]
    )
    groups = compare.structural_groups(signatures, "flow")
    placed = values.join(ordinals, ["workspace", "flow", "id"])
    slots, _ = compare.structural_template(
        placed.select("flow", F.col("ordinal").alias("slot"), "value"), signatures, groups, "flow"
    )
    return (
        slots.join(groups, "signature")
        .groupBy("first_member", "members")
        .agg(F.count(F.lit(1)).alias("slots"), F.count_if("varies").alias("varying"))
    )


# Documents ------------------------------------------------------------------------------------


@query(
    "read_exports_json",
    """
    SELECT CAST(doc_id AS VARCHAR) AS template, lang AS name, 'Text' AS type, 'PROCESSOR' AS kind,
           text AS comment, 3.0::DOUBLE AS x, CAST(n_chars AS DOUBLE) AS y, source AS setting
    FROM documents
    """,
)
def read_exports_json(spark, folder):
    position = F.concat(F.lit("3,"), F.col("n_chars").cast("string"))
    component = F.struct(
        F.col("lang").alias("name"),
        F.lit("Text").alias("type"),
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"),
        position.alias("position"),
        F.col("text").alias("comment"),
        F.create_map(F.lit("source"), F.col("source")).alias("properties"),
    )
    name = F.col("doc_id").cast("string")
    texts = table(spark, folder, "documents").select(
        F.lit("w").alias("workspace"),
        F.concat(name, F.lit(".json")).alias("file"),
        F.to_json(F.struct(name.alias("name"), F.array(component).alias("components"))).alias("json"),
    )
    tables = exports.to_tables(exports.read_exports_json(texts))
    settings = tables["properties"].select(
        F.col("owner_id").alias("id"), F.col("value").alias("setting")
    )
    return (
        tables["components"]
        .join(settings, "id")
        .select("template", "name", "type", "kind", "comment", "x", "y", "setting")
    )


def order_tables(spark, folder):
    """Customers as templates, their orders as components with two settings."""
    orders = table(spark, folder, "orders")
    at = [
        F.lit("w").alias("workspace"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("template"),
    ]
    own_id = F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))
    blank = {
        name: empty_table(spark, schema)
        for name, schema in TABLES.items()
        if name not in ("templates", "components", "properties")
    }
    components = orders.select(
        *at,
        own_id.alias("id"),
        F.lit("").alias("name"),
        F.concat(F.lit("Order"), F.col("o_orderstatus")).alias("type"),
        F.lit("PROCESSOR").alias("kind"),
        F.lit(None).cast("string").alias("child_template"),
        F.lit(None).cast("double").alias("x"),
        F.lit(None).cast("double").alias("y"),
        F.lit("").alias("comment"),
        F.lit(None).cast("string").alias("policy"),
        F.col("o_orderkey").alias("ord"),
    )
    properties = orders.select(
        *at,
        own_id.alias("owner_id"),
        F.lit("property").alias("section"),
        F.explode(
            F.create_map(
                F.lit("status"),
                F.nullif(F.col("o_orderstatus"), F.lit("O")),
                F.lit("priority"),
                F.col("o_orderpriority"),
            )
        ).alias("key", "value"),
    )
    return {
        **blank,
        "templates": components.select("workspace", "template").distinct(),
        "components": components,
        "properties": properties,
    }


@query(
    "render_documents",
    """
    WITH o AS (
        SELECT o_custkey, o_orderkey,
               '{"type":"Order' || o_orderstatus || '","id":"o' || CAST(o_orderkey AS VARCHAR)
               || '","properties":{"priority":"' || o_orderpriority || '"'
               || CASE WHEN o_orderstatus = 'O' THEN '' ELSE ',"status":"' || o_orderstatus || '"' END
               || '}}' AS component
        FROM orders
    )
    SELECT 'w' AS workspace, 'c' || CAST(o_custkey AS VARCHAR) AS template, CAST(0 AS BIGINT) AS page,
           '{"name":"c' || CAST(o_custkey AS VARCHAR) || '","components":['
           || string_agg(component, ',' ORDER BY o_orderkey) || ']}' AS json
    FROM o GROUP BY o_custkey
    """,
)
def render_documents(spark, folder):
    return exports.to_documents(order_tables(spark, folder))


@query(
    "export_roundtrip",
    """
    WITH o AS (
        SELECT o_custkey, o_orderkey, o_orderstatus,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rule_no FROM orders)
    SELECT c_mktsegment AS template, 'c' || CAST(c_custkey AS VARCHAR) AS id,
           ord,
           'USE_CLONE' AS policy, rule_no, CAST(o_orderkey AS VARCHAR) AS rule_name,
           '${status:equals("' || o_orderstatus || '")}' AS condition
    FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1 AS ord
          FROM customer)
    LEFT JOIN o ON o_custkey = c_custkey
    """,
)
def export_roundtrip(spark, folder):
    """Customers as components, their orders as rules: written as YAML in several pages, read again."""
    at = ["workspace", "template"]
    blank = {name: empty_table(spark, kind) for name, kind in TABLES.items()}
    own_id = F.concat(F.lit("c"), F.col("c_custkey").cast("string"))
    customers = numbered(
        table(spark, folder, "customer").select("c_custkey", "c_mktsegment"),
        ["c_mktsegment"],
        ["c_custkey"],
        "_rn",
    )
    components = customers.select(
        F.lit("my flow").alias("workspace"),
        F.col("c_mktsegment").alias("template"),
        own_id.alias("id"),
        own_id.alias("name"),
        F.lit("Customer").alias("type"),
        F.lit("PROCESSOR").alias("kind"),
        F.lit("USE_CLONE").alias("policy"),
        (F.col("_rn") - 1).alias("ord"),
    )
    orders = numbered(
        table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"),
        ["o_custkey"],
        ["o_orderkey"],
        "rule_no",
    )
    places = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    rules = orders.join(places, orders.o_custkey == places.c_custkey).select(
        F.lit("my flow").alias("workspace"),
        F.col("c_mktsegment").alias("template"),
        own_id.alias("owner_id"),
        "rule_no",
        F.col("o_orderkey").cast("string").alias("rule_name"),
        F.lit("USE_CLONE").alias("policy"),
        F.array(F.concat(F.lit('${status:equals("'), "o_orderstatus", F.lit('")}'))).alias("conditions"),
    )
    tables = {
        **blank,
        "templates": components.select(*at).distinct(),
        "components": blank["components"].unionByName(components, allowMissingColumns=True),
        "rules": blank["rules"].unionByName(rules, allowMissingColumns=True),
    }
    path = scratch_path(spark, "exports")
    exports.write_exports(exports.to_yaml(exports.to_documents(tables, page_rows=500)), path)
    again = exports.to_tables(exports.read_written(spark, path))
    read = again["rules"].select(
        *at, F.col("owner_id").alias("id"), "rule_no", "rule_name", F.col("conditions")[0].alias("condition")
    )
    return again["components"].join(read, [*at, "id"], "left").select(
        "template", "id", "ord", "policy", "rule_no", "rule_name", "condition"
    )
