"""Rule documents and rules applied to rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowtables.operators import batches, flow, rules

XML = """<criteria><flowFilePolicy>USE_CLONE</flowFilePolicy>
<rules><id>1</id><name>two &amp; more</name>
<conditions><id>c1</id><expression>${a:equals("1")}</expression></conditions>
<conditions><id>c2</id><expression>${b:equals("&lt;2&gt;")}</expression></conditions>
<actions><id>a1</id><attribute>z</attribute><value>old</value></actions>
<actions><id>a2</id><attribute>k</attribute><value>v</value></actions>
<actions><id>a3</id><attribute>z</attribute><value>new</value></actions></rules>
<rules><id>2</id><name>bare</name></rules></criteria>"""


def documents(spark):
    return spark.createDataFrame(
        [(1, XML), (2, None), (3, ""), (4, "<criteria><rules>"), (5, "<criteria></criteria>")], "id int, xml string"
    )


def test_parse(spark):
    parsed = rules.parse_rules(documents(spark), "xml")
    keys = parsed.where("id = 1").select(F.map_keys(F.col("rules")[0]["actions"])).first()[0]
    assert keys == ["k", "z"]
    got = {r["id"]: r for r in parsed.collect()}
    assert len(got) == 5
    first = got[1]["rules"]
    assert [r["name"] for r in first] == ["two & more", "bare"]
    assert first[0]["conditions"] == ['${a:equals("1")}', '${b:equals("<2>")}']
    assert first[0]["actions"] == {"k": "v", "z": "new"}
    assert first[1]["conditions"] == [] and first[1]["actions"] == {}
    assert [got[i]["rules"] for i in (2, 3, 4, 5)] == [[], [], [], []]
    assert [i for i in got if got[i]["corrupt_xml"] is not None] == [4]


def test_render_and_parse_again(spark):
    parsed = rules.parse_rules(documents(spark), "xml")
    one = rules.render_rules(parsed, "policy", "rules", ["id"], "again")
    two = rules.render_rules(parsed, "policy", "rules", ["id"], "again")
    texts = {r["id"]: r["again"] for r in one.collect()}
    assert texts == {r["id"]: r["again"] for r in two.collect()}
    again = rules.parse_rules(one.select("id", "again"), "again")
    assert [r["rules"] for r in again.orderBy("id").collect()] == [r["rules"] for r in parsed.orderBy("id").collect()]
    import re

    ids = re.findall(r"<id>([^<]+)</id>", texts[1])
    assert len(ids) == len(set(ids)) == 2 + 2 + 2
    assert all(re.fullmatch(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", i) for i in ids)


def test_flatten_to_table_rules(spark):
    flat = rules.flatten_rules(rules.parse_rules(documents(spark), "xml"), ["id"])
    assert flat.where("kind = 'condition'").count() == 2 and flat.where("kind = 'action'").count() == 2
    conditions = rules.rule_conditions(flat, ["id"])
    assert sorted((r["attr"], r["value"]) for r in conditions.collect()) == [("a", "1"), ("b", "<2>")]
    attributes = spark.createDataFrame(
        [("x", "a", "1"), ("x", "b", "<2>"), ("y", "a", "1"), ("z", "a", "1"), ("z", "b", "2"), ("w", "a", "1"), ("w", "a", "1")],
        "doc string, attr string, value string",
    )
    got = rules.match_rules(attributes, conditions, ["doc"], ["id", "rule_no"])
    assert [tuple(r) for r in got.collect()] == [("x", 1, 1)]


def test_policies(spark):
    df = spark.createDataFrame([(1, "x", 5), (2, "y", None), (3, None, 9)], "id int, a string, n int")
    given = [
        {"name": "big", "conditions": ["n > 4"], "actions": {"n": "n * 10", "tag": "'big'"}},
        {"name": "x", "conditions": ['${a:equals("x")}', "n > 0"], "actions": {"n": "n + 1"}},
        {"name": "never", "conditions": ["n > 4", "n < 4"], "actions": {"tag": "'no'"}},
    ]
    clone = rules.apply_rules(df, given)
    assert sorted((r["id"], r["matched_rule"], r["n"], r["tag"]) for r in clone.where("id <> 2").collect()) == [
        (1, "big", 50, "big"), (1, "x", 6, None), (3, "big", 90, "big"),
    ]
    passed = clone.where("id = 2").collect()
    assert [(r["matched_rule"], r["n"], r["tag"]) for r in passed] == [(None, None, None)]
    merged = {r["id"]: (r["n"], r["tag"], r["matched_rules"]) for r in rules.apply_rules(df, given, "merge").collect()}
    assert merged == {1: (6, "big", ["big", "x"]), 2: (None, None, []), 3: (90, "big", ["big"])}
    always = [{"name": "all", "conditions": [], "actions": {"n": "0"}}]
    assert {r["n"] for r in rules.apply_rules(df, always).collect()} == {0}
    assert rules.apply_rules(df, []).count() == 3
    with pytest.raises(ValueError):
        rules.apply_rules(df, given, "other")


def test_rules_need_no_shuffle(spark):
    df = spark.range(100).select(F.col("id"), F.lit("x").alias("a"))
    plan = rules.apply_rules(df, [{"name": "r", "conditions": ["id > 5"], "actions": {"a": "'y'"}}])
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_expiry_edges(spark):
    df = spark.sql("SELECT id, timestamp_ntz'2024-01-10 00:00:00' - make_dt_interval(id) AS ts FROM range(5)")
    as_of = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    assert flow.expire(df, "ts", 0, as_of).count() == 5
    assert sorted(r["id"] for r in flow.expire(df, "ts", 2 * 86400, as_of).collect()) == [0, 1, 2]
    ttl = F.when(F.col("id") == 4, 0.0).when(F.col("id") == 3, F.lit(None)).otherwise(86400.0)
    assert sorted(r["id"] for r in flow.expire(df, "ts", ttl, as_of).collect()) == [0, 1, 3, 4]


def test_combined_batches_match_a_loop(spark):
    import random

    pick = random.Random(5)
    rows = [(pick.choice("ab"), i // 3, i, pick.choice([1, 5, 40, 500])) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t int, id int, size int").withColumn(
        "ts", F.timestamp_seconds(F.col("t") * 7)
    )
    got = flow.assign_batches(df, ["k"], ["t", "id"], count=5, size=("size", 100), duration=("ts", 60))
    wanted, open_ = {}, {}
    for k, t, i, size in sorted(rows, key=lambda r: (r[1], r[2])):
        unit = (k, t * 7 // 60)
        number, held, filled = open_.get(unit, (0, 0, 0))
        wanted[i] = (unit[1], number)
        held, filled = held + 1, filled + size
        open_[unit] = (number + 1, 0, 0) if held >= 5 or filled >= 100 else (number, held, filled)
    assert {r["id"]: (r["window"], r["batch"]) for r in got.collect()} == wanted
    assert got.columns == ["k", "t", "id", "size", "ts", "window", "batch"]


@pytest.mark.parametrize(
    "count,limit,block",
    [(5, 100, 23), (3, 10_000, 12), (7, 3, 40), (4, 60, 1000), (None, 100, 23), (None, 700, 3), (None, 10**6, 40)],
)
def test_blocks_of_a_large_unit_match_reading_in_turn(spark, count, limit, block):
    import random

    pick = random.Random(count)
    rows = [("hot" if i % 5 else f"k{i % 4}", i, pick.choice([0, 1, 5, 40, 500])) for i in range(900)]
    rows += [(None, i, 7) for i in range(900, 1100)]
    df = spark.createDataFrame(rows, "k string, id int, size bigint").repartition(4)
    one = batches.close_batches(df, ["k"], ["id"], "size", count, limit, None)
    two = batches.close_batches(df, ["k"], ["id"], "size", count, limit, 90, block)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
    assert two.columns == one.columns


def test_step_functions_of_blocks():
    """Joined over blocks of any length they say what reading row by row from any beginning says."""
    pick = np.random.default_rng(7)
    for _ in range(200):
        limit, block = int(pick.integers(1, 60)), int(pick.integers(1, 20))
        sizes = pick.integers(0, int(pick.choice([1, 4, 90])), int(pick.integers(1, 100)))
        parts = [batches._steps_by_bytes(sizes[i : i + block], limit) for i in range(0, len(sizes), block)]
        steps = parts[0]
        for behind in parts[1:]:
            steps = batches._composed(steps, behind)
        lo, hi, slope, out, closed = steps
        assert lo[0] == 0 and hi[-1] == limit and (lo[1:] == hi[:-1]).all()
        for begin in range(limit):
            held, number = begin, 0
            for size in sizes.tolist():
                held += size
                if held >= limit:
                    held, number = 0, number + 1
            at = np.searchsorted(lo, begin, "right") - 1
            assert (out[at] + slope[at] * begin, closed[at]) == (held, number)


def test_group_ports(spark):
    group = flow.FlowGroup(["in"], ["out"], lambda f: {"out": f["in"]})
    with pytest.raises(ValueError):
        group.apply(other=spark.range(1))
    with pytest.raises(ValueError):
        flow.FlowGroup(["in"], ["missing"], lambda f: {"out": f["in"]}).apply(**{"in": spark.range(1)})


def test_attributes(spark):
    df = spark.createDataFrame([(1, "1"), (2, None)], "id int, a string")
    got = flow.set_attributes(df, {"b": '${a:equals("1")}', "u": "${uuid}", "t": "text"}, ["id"]).collect()
    assert [r["b"] for r in got] == [True, False]
    assert got[0]["u"] != got[1]["u"] and len(got[0]["u"]) == 36
    assert {r["t"] for r in got} == {"text"}


def test_undecided_and_free_rules(spark):
    conditions = spark.createDataFrame(
        [("mixed", "a", "1"), ("mixed", None, "b > 5"), ("plain", "a", "1"), ("form", None, "${b:le(5)}"),
         ("wrong", None, "b >"), ("nowhere", None, "c = 1"), ("odd", None, "${b:odd()}"), ("text", None, "a"),
         ("both", None, "b > 5"), ("both", None, "${a:startsWith(\"1\")}"), ("gone", None, None)],
        "rule string, attr string, value string",
    )
    entries = [("x", "a", "1"), ("x", "b", "0"), ("y", "a", "2"), ("z", "a", "1"), ("z", "b", "7")]
    rows = spark.createDataFrame(entries, "doc string, attr string, value string")
    known = conditions.select("rule").unionAll(spark.createDataFrame([("free",)], "rule string"))
    got = rules.match_rules(rows, conditions, ["doc"], ["rule"]).collect()
    assert sorted(map(tuple, got)) == [("x", "plain"), ("z", "plain")]
    assert [tuple(r) for r in rules.free_rules(known, conditions, ["rule"]).collect()] == [("free",)]
    report = rules.undecided_rules(conditions, ["rule"]).collect()
    assert {r["rule"]: r["undecided"] for r in report}["mixed"] == ["b > 5"]
    wide = spark.createDataFrame([("x", "1", 0), ("y", "2", None), ("z", "1", 7)], "doc string, a string, b int")
    got = rules.match_rules(rows, conditions, ["doc"], ["rule"], rows=wide).collect()
    assert sorted(map(tuple, got)) == [
        ("x", "form"), ("x", "plain"), ("z", "both"), ("z", "mixed"), ("z", "plain"),
    ]
    _, decided = rules.decide_conditions(wide, conditions, ["doc"])
    left = {r["rule"] for r in rules.undecided_rules(decided, ["rule"]).collect()}
    assert left == {"wrong", "nowhere", "odd", "text", "gone"}


def test_spaces_of_values_are_kept(spark):
    xml = (
        "<criteria><flowFilePolicy>USE_CLONE</flowFilePolicy><rules><name>r</name>"
        "<conditions><expression> a = 1 </expression></conditions>"
        "<actions><attribute>x</attribute><value> padded </value></actions></rules></criteria>"
    )
    row = rules.parse_rules(spark.createDataFrame([(xml,)], "xml string"), "xml").first()
    assert row["rules"][0]["conditions"] == [" a = 1 "] and row["rules"][0]["actions"] == {"x": " padded "}


def test_attributes_need_a_key_for_ids(spark):
    with pytest.raises(ValueError):
        flow.set_attributes(spark.range(2), {"id2": "${uuid}"})


def test_null_sizes_have_a_batch(spark):
    df = spark.createDataFrame([("k", 1, 5), ("k", 2, None), ("k", 3, 9)], "k string, t int, size int")
    got = flow.assign_batches(df, ["k"], ["t"], size=("size", 10)).orderBy("t").collect()
    assert [r["batch"] for r in got] == [0, 0, 0]
