"""Names against a plain loop on random input, and nested maps there and back."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowtables.operators import naming


def expected(rows):
    """First come first named, scope by scope."""
    names, taken = {}, {}
    for scope, type_, group, version in rows:
        identity = (scope, type_, group, version)
        if identity in names:
            continue
        short = type_.rstrip(".").rsplit(".", 1)[-1]
        count = taken.get((scope, short), 0)
        taken[(scope, short)] = count + 1
        names[identity] = f"{short}#{count}" if count else short
    return names


ROW = st.tuples(
    st.sampled_from(["s1", "s2"]),
    st.sampled_from(["a.Log", "b.Log", "Log", "c.Put.", "Put"]),
    st.sampled_from(["g", "h", None]),
    st.sampled_from(["1", "2"]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=1, max_size=40))
def test_names_match_a_loop(spark, rows):
    schema = "scope string, type string, grp string, version string, ord int"
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema).repartition(3)
    named = naming.canonical_names(df, ["scope"], "type", ["grp", "version"], ["ord"])
    got = {(r["scope"], r["type"], r["grp"], r["version"]): r["name"] for r in named.collect()}
    assert got == expected(rows)
    attached = naming.attach_names(df, named, ["scope"], "type", ["grp", "version"])
    assert attached.count() == len(rows)
    assert attached.where("name IS NULL").count() == 0


def test_processors_before_controllers(spark):
    df = spark.createDataFrame(
        [("s", "a.X", "g1", 2, 0), ("s", "b.X", "g1", 1, 9)],
        "scope string, type string, grp string, rank int, ord int",
    )
    named = naming.canonical_names(df, ["scope"], "type", ["grp"], ["rank", "ord"])
    assert {r["type"]: r["name"] for r in named.collect()} == {"b.X": "X", "a.X": "X#1"}


def test_nest_and_unnest(spark):
    pick = random.Random(3)
    rows = {(pick.choice("st"), pick.choice("ab"), pick.choice("cd"), f"n{i % 30}"): f"v{i}" for i in range(200)}
    df = spark.createDataFrame([(*k, v) for k, v in rows.items()], "scope string, g string, a string, n string, type string")
    for page_rows in (1000, 7):
        tree = naming.nest(df, ["scope"], ["g", "a", "n"], "type", page_rows=page_rows)
        for row in tree.select(F.map_keys("tree").alias("keys")).collect():
            assert row["keys"] == sorted(row["keys"])
        back = naming.unnest(tree, ["scope"], "tree", ["g", "a", "n"], "type")
        assert {(r["scope"], r["g"], r["a"], r["n"]): r["type"] for r in back.collect()} == rows
    assert tree.count() > 2


def test_last_by_reports_copies(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None)], "name string, ord int, type string")
    got = {r["name"]: (r["type"], r["copies"]) for r in naming.last_by(df, ["name"], "ord", ["type"]).collect()}
    assert got == {"a": ("z", 3), "b": (None, 1)}


def test_last_by_is_combined_before_the_exchange(spark):
    df = spark.range(1000).select(F.lit("k").alias("name"), F.col("id").alias("ord"), F.lit("t").alias("type"))
    plan = naming.last_by(df, ["name"], "ord", ["type"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max_by") >= 1
