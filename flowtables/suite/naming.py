"""Naming queries: each part stands for a component with a dotted type."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtables.operators import naming
from flowtables.sources.tables import table
from flowtables.suite.registry import query

PART_NAMES = """
    SELECT {scope} AS scope, 'x.' || p_type AS type, p_brand, p_name, p_type AS short,
           min(p_partkey) AS first_ord
    FROM part GROUP BY ALL
"""
NUMBERED = """
    SELECT *, short || CASE WHEN rn > 1 THEN '#' || CAST(rn - 1 AS VARCHAR) ELSE '' END AS name
    FROM (SELECT *, row_number() OVER (PARTITION BY scope, short ORDER BY first_ord) AS rn FROM n)
"""


def parts(spark, folder, scope):
    return table(spark, folder, "part").select(
        scope.alias("scope"),
        F.concat(F.lit("x."), "p_type").alias("type"),
        "p_brand",
        "p_name",
        "p_partkey",
    )


def part_names(rows):
    return naming.canonical_names(rows, ["scope"], "type", ["p_brand", "p_name"], ["p_partkey"])


@query(
    "canonical_names",
    f"WITH n AS ({PART_NAMES.format(scope='0')}) "
    f"SELECT scope, type, p_brand, p_name, short, name FROM ({NUMBERED})",
)
def canonical_names(spark, folder):
    return part_names(parts(spark, folder, F.lit(0)))


@query(
    "scoped_lookup",
    f"WITH n AS ({PART_NAMES.format(scope='p_size')}) "
    f"SELECT scope, type, p_brand, p_name, short, name FROM ({NUMBERED})",
)
def scoped_lookup(spark, folder):
    return part_names(parts(spark, folder, F.col("p_size")))


@query(
    "attach_names",
    f"""
    WITH n AS ({PART_NAMES.format(scope='0')}), m AS ({NUMBERED})
    SELECT p.p_partkey, m.name
    FROM part p JOIN m ON m.type = 'x.' || p.p_type AND m.p_brand = p.p_brand AND m.p_name = p.p_name
    """,
)
def attach_names(spark, folder):
    rows = parts(spark, folder, F.lit(0))
    return naming.attach_names(
        rows, part_names(rows), ["scope"], "type", ["p_brand", "p_name"]
    ).select("p_partkey", "name")


def market_tree(spark, folder):
    """Region → nation → segment → number of customers, as nested maps."""
    regions, nations = table(spark, folder, "region"), table(spark, folder, "nation")
    counts = (
        table(spark, folder, "customer")
        .groupBy("c_nationkey", "c_mktsegment")
        .agg(F.count(F.lit(1)).cast("string").alias("customers"))
    )
    rows = (
        counts.join(nations, counts.c_nationkey == nations.n_nationkey)
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("r_name", "n_name", F.col("c_mktsegment").alias("segment"), "customers")
    )
    return naming.nest(rows, ["r_name"], ["n_name", "segment"], "customers")


TREE_ROWS = """
    SELECT r_name, n_name, c_mktsegment AS segment, CAST(count(*) AS VARCHAR) AS customers
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY ALL
"""


@query(
    "nest_levels",
    f"""
    WITH t AS ({TREE_ROWS}), b AS (
        SELECT r_name, n_name,
               n_name || ':' || string_agg(segment || '=' || customers, ',' ORDER BY segment) AS branch
        FROM t GROUP BY r_name, n_name
    )
    SELECT r_name, CAST(0 AS BIGINT) AS page, string_agg(branch, ';' ORDER BY n_name) AS tree
    FROM b GROUP BY r_name
    """,
)
def nest_levels(spark, folder):
    leaf = lambda e: F.concat(e["key"], F.lit("="), e["value"])
    branch = lambda e: F.concat(
        e["key"], F.lit(":"), F.array_join(F.transform(F.map_entries(e["value"]), leaf), ",")
    )
    return market_tree(spark, folder).select(
        "r_name", "page", F.array_join(F.transform(F.map_entries("tree"), branch), ";").alias("tree")
    )


@query(
    "flat_names",
    f"""
    SELECT r_name, segment, arg_max(customers, n_name) AS customers, count(*) AS copies
    FROM ({TREE_ROWS}) GROUP BY r_name, segment
    """,
)
def flat_names(spark, folder):
    tree = market_tree(spark, folder)
    return naming.flat_names(tree, ["r_name"], "tree", ["n_name", "segment"], "customers")


@query("unnest_levels", TREE_ROWS)
def unnest_levels(spark, folder):
    return naming.unnest(
        market_tree(spark, folder), ["r_name"], "tree", ["n_name", "segment"], "customers"
    )
