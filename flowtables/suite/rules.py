"""Rule queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtables.operators import rules
from flowtables.operators.sparse import unpivot_text
from flowtables.operators.spread import dealt_if_many
from flowtables.sources.tables import literal_table, table
from flowtables.suite.registry import query


def part_criteria(spark, folder):
    """Parts with a rule document: two rules, a repeated attribute, a rule without conditions.

    The largest parts have no document, and those of one brand a broken one.
    """
    action = lambda attribute, value: F.concat(
        F.lit(f"<actions><attribute>{attribute}</attribute><id>i</id><value>"),
        value.cast("string"),
        F.lit("</value></actions>"),
    )
    document = F.concat(
        F.lit("<criteria><flowFilePolicy>"),
        F.col("p_type"),
        F.lit("</flowFilePolicy><rules>"),
        action("size", F.lit("first")),
        action("brand", F.col("p_brand")),
        action("size", F.col("p_size")),
        F.lit('<conditions><expression>${brand:equals("'),
        F.col("p_brand"),
        F.lit('")}</expression><id>c</id></conditions>'),
        F.lit('<conditions><expression>${color:equals("red")}</expression><id>d</id></conditions>'),
        F.lit("<id>r1</id><name>"),
        F.col("p_name"),
        F.lit("</name></rules><rules>"),
        action("type", F.col("p_type")),
        F.lit("<id>r2</id><name>always</name></rules>"),
        F.when(F.col("p_brand") == "Brand#7", F.lit("<rules>")).otherwise(F.lit("</criteria>")),
    )
    # reading and writing XML takes long for its bytes
    parts = dealt_if_many(
        table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    )
    return parts.select("p_partkey", F.when(F.col("p_size") <= 40, document).alias("xml"))


FLAT = """
    SELECT p_partkey, r.rule_no, CASE r.rule_no WHEN 1 THEN p_name ELSE 'always' END AS rule_name,
           r.kind, r.item_no, r.item_key,
           CASE r.v WHEN 'brand?' THEN '${brand:equals("' || p_brand || '")}'
                    WHEN 'color?' THEN '${color:equals("red")}' WHEN 'brand' THEN p_brand
                    WHEN 'size' THEN CAST(p_size AS VARCHAR) ELSE p_type END AS item_value
    FROM part CROSS JOIN (VALUES
        (CAST(1 AS BIGINT), 'condition', CAST(1 AS BIGINT), NULL, 'brand?'),
        (1, 'condition', 2, NULL, 'color?'), (1, 'action', 1, 'brand', 'brand'),
        (1, 'action', 2, 'size', 'size'), (2, 'action', 1, 'type', 'type')
    ) AS r(rule_no, kind, item_no, item_key, v)
    WHERE p_size <= 40 AND p_brand <> 'Brand#7'
"""


@query(
    "parse_rules",
    """
    SELECT p_partkey, CASE WHEN p_size <= 40 AND p_brand <> 'Brand#7' THEN p_type END AS policy,
           CASE WHEN p_size > 40 OR p_brand = 'Brand#7' THEN '' ELSE p_name || ',always' END AS names,
           CASE WHEN p_size > 40 OR p_brand = 'Brand#7' THEN '' ELSE '2,0' END AS conditions,
           p_size <= 40 AND p_brand = 'Brand#7' AS corrupt
    FROM part
    """,
)
def parse_rules(spark, folder):
    parsed = rules.parse_rules(part_criteria(spark, folder), "xml")
    sizes = F.transform("rules", lambda r: F.size(r["conditions"]).cast("string"))
    return parsed.select(
        "p_partkey",
        "policy",
        F.array_join(F.transform("rules", lambda r: r["name"]), ",").alias("names"),
        F.array_join(sizes, ",").alias("conditions"),
        F.col("corrupt_xml").isNotNull().alias("corrupt"),
    )


@query("flatten_rules", FLAT)
def flatten_rules(spark, folder):
    parsed = rules.parse_rules(part_criteria(spark, folder), "xml")
    return rules.flatten_rules(parsed, ["p_partkey"])


@query("render_rules", FLAT)
def render_rules(spark, folder):
    parsed = rules.parse_rules(part_criteria(spark, folder), "xml")
    rendered = rules.render_rules(parsed, "policy", "rules", ["p_partkey"], "again")
    again = rules.parse_rules(rendered.select("p_partkey", "again"), "again")
    return rules.flatten_rules(again, ["p_partkey"])


EVENT_RULES = [
    {
        "name": "big click",
        "conditions": ["event_type = 'click'", "value > 50"],
        "actions": {"level": "'high'", "value": "value * 2"},
    },
    {
        "name": "error",
        "conditions": ['${event_type:equals("error")}'],
        "actions": {"level": "'bad'", "owner": "concat('user-', user_id)"},
    },
    {
        "name": "large",
        "conditions": ["nullif(value, 0) > 40"],
        "actions": {"level": "concat('large-', event_type)"},
    },
]


@query(
    "apply_rules_clone",
    """
    SELECT event_id, user_id, event_type, value * 2 AS value, 'high' AS level,
           CAST(NULL AS VARCHAR) AS owner, 'big click' AS matched_rule
    FROM events WHERE event_type = 'click' AND value > 50
    UNION ALL
    SELECT event_id, user_id, event_type, value, 'bad', 'user-' || CAST(user_id AS VARCHAR), 'error'
    FROM events WHERE event_type = 'error'
    UNION ALL
    SELECT event_id, user_id, event_type, value, 'large-' || event_type, NULL, 'large'
    FROM events WHERE value > 40
    UNION ALL
    SELECT event_id, user_id, event_type, value, NULL, NULL, NULL FROM events
    WHERE NOT (event_type = 'click' AND value > 50) AND event_type <> 'error' AND NOT value > 40
    """,
)
def apply_rules_clone(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    return rules.apply_rules(events, EVENT_RULES)


@query(
    "apply_rules_merge",
    """
    SELECT event_id, user_id, event_type,
           CASE WHEN event_type = 'click' AND value > 50 THEN value * 2 ELSE value END AS value,
           CASE WHEN value > 40 THEN 'large-' || event_type WHEN event_type = 'error' THEN 'bad'
                END AS level,
           CASE WHEN event_type = 'error' THEN 'user-' || CAST(user_id AS VARCHAR) END AS owner,
           concat_ws(',', CASE WHEN event_type = 'click' AND value > 50 THEN 'big click' END,
                     CASE WHEN event_type = 'error' THEN 'error' END,
                     CASE WHEN value > 40 THEN 'large' END) AS matched_rules
    FROM events
    """,
)
def apply_rules_merge(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    merged = rules.apply_rules(events, EVENT_RULES, "merge")
    return merged.withColumn("matched_rules", F.array_join("matched_rules", ","))


@query(
    "match_rules_table",
    """
    SELECT o_orderkey, 'late' AS rule FROM orders
    WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
    UNION ALL SELECT o_orderkey, 'open' FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT o_orderkey, 'high' FROM orders WHERE o_orderpriority = '2-HIGH'
    UNION ALL SELECT o_orderkey, 'mixed' FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000
    UNION ALL SELECT o_orderkey, 'text' FROM orders
    WHERE o_orderkey % 7 = 0 AND (o_orderpriority LIKE '4%' OR o_totalprice < 1000)
    UNION ALL SELECT NULL, 'free'
    """,
)
def match_rules_table(spark, folder):
    orders = table(spark, folder, "orders")
    attributes = unpivot_text(
        orders,
        ["o_orderkey"],
        {"status": F.col("o_orderstatus"), "priority": F.col("o_orderpriority")},
    ).withColumnRenamed("key", "attr")
    conditions = literal_table(
        spark,
        [
            ("late", "status", "F"),
            ("late", "priority", "1-URGENT"),
            ("open", "status", "O"),
            ("high", "priority", "2-HIGH"),
            ("high", "priority", "2-HIGH"),
            ("never", "status", "F"),
            ("never", "status", "O"),
            # conditions of other forms, one that fails and one that cannot be decided
            ("mixed", "status", "F"),
            ("mixed", None, "${price:gt(200000)}"),
            ("text", None, "o_orderkey % 7 = 0"),
            ("text", None, "priority LIKE '4%' OR price < 1000"),
            ("unmet", "status", "F"),
            ("unmet", None, "${priority:isEmpty()}"),
            ("wrong", None, "${price:unheard(5)}"),
        ],
        "rule string, attr string, value string",
    )
    wide = orders.select(
        "o_orderkey",
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("price"),
    )
    named = conditions.select("rule").unionAll(literal_table(spark, [("free",)], "rule string"))
    matched = rules.match_rules(attributes, conditions, ["o_orderkey"], ["rule"], True, wide)
    # rules without conditions hold for every row: they are listed once, without one
    free = rules.free_rules(named, conditions, ["rule"])
    nobody = F.lit(None).cast(orders.schema["o_orderkey"].dataType).alias("o_orderkey")
    return matched.unionByName(free.select(nobody, "rule"))
