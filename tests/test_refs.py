"""Edge cases of references, connections and the tree."""

import pytest
from pyspark.sql import functions as F

from flowtables.operators import refs
from flowtables.operators.hierarchy import expand_hierarchy
from flowtables.plans.lifecycle import teardown_plan


def test_repeated_old_id_last_wins(spark):
    id_map = spark.createDataFrame(
        [("a", "a1", 1), ("a", "a2", 2), ("b", "b1", 1), (None, "n", 1)], "old_id string, new_id string, ord int"
    )
    latest = refs.latest_ids(id_map)
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "n int, ref string")
    kept = {r["n"]: r["ref"] for r in refs.remap_ids(df, latest, ["ref"]).collect()}
    assert kept == {1: "a2", 2: "b1", 3: "c", 4: None}
    null = {r["n"]: r["ref"] for r in refs.remap_ids(df, latest, ["ref"], missing="null").collect()}
    assert null == {1: "a2", 2: "b1", 3: None, 4: None}


def test_values_are_rewritten_as_a_whole_only(spark):
    id_map = spark.createDataFrame([("id-1", "new-1"), ("", "never")], "old_id string, new_id string")
    df = spark.createDataFrame([("id-1",), ("id-12",), ("see id-1",), (None,), ("",)], "value string")
    got = [r["value"] for r in refs.remap_values(df, id_map).collect()]
    assert sorted(map(str, got)) == sorted(["new-1", "id-12", "see id-1", "None", ""])


def test_resolve(spark):
    objects = spark.createDataFrame(
        [("g", "in", "PORT", "1"), ("g", "twice", "PORT", "2"), ("g", "twice", "PORT", "3"),
         ("g", "same", "PORT", "4"), ("g", "same", "PORT", "4"), ("h", "in", "PORT", "5")],
        "grp string, name string, type string, id string",
    )
    asked = spark.createDataFrame(
        [("g", "in"), ("g", "twice"), ("g", "same"), ("g", "none"), (None, "in")], "grp string, name string"
    ).withColumn("type", F.lit("PORT"))
    key = ["grp", "name", "type"]
    got = {(r["grp"], r["name"]): (r["resolved_id"], r["matches"]) for r in refs.resolve_named(asked, objects, key, key).collect()}
    assert got == {
        ("g", "in"): ("1", 1), ("g", "twice"): (None, 2), ("g", "same"): ("4", 1),
        ("g", "none"): (None, 0), (None, "in"): (None, 0),
    }
    with pytest.raises(Exception, match="ambiguous reference"):
        refs.resolve_named(asked, objects, key, key, on_ambiguous="error").collect()
    single = asked.where("name <> 'twice'")
    assert refs.resolve_named(single, objects, key, key, on_ambiguous="error").count() == 4


def test_first_type_of_an_object_counts(spark):
    tracked = spark.createDataFrame(
        [("g", "n", "B", "1", 2), ("g", "n", "A", "1", 1), ("g", "n", "A", "2", 3)],
        "grp string, name string, type string, id string, ord int",
    )
    got = {r["id"]: r["type"] for r in refs.first_types(tracked, "grp", "name", "type", "id", "ord").collect()}
    assert got == {"1": "A", "2": "A"}


def test_build_edges_and_dangling(spark):
    components = spark.createDataFrame(
        [("p", "x.Log"), ("f", "funnel"), ("g", "PROCESS_GROUP"), ("r", "REMOTE_PROCESS_GROUP"), ("n", None)],
        "id string, kind string",
    )
    inputs = spark.createDataFrame(
        [("p", "g", ["ok"]), ("f", "p", ["ok"]), ("g", "p", ["out"]), ("r", "n", ["out"]), ("?", "p", ["ok"]),
         ("n", "?", []), ("?", "!", ["ok"])],
        "source_id string, dest_id string, relationships array<string>",
    )
    built = {(r["source_id"], r["dest_id"]): r for r in refs.build_edges(inputs, components).collect()}
    assert len(built) == 7
    kinds = {k: (r["source_kind"], r["dest_kind"], r["relationships"], r["valid"]) for k, r in built.items()}
    assert kinds[("p", "g")] == ("PROCESSOR", "INPUT_PORT", ["ok"], True)
    assert kinds[("f", "p")][2:] == (None, True)
    assert kinds[("g", "p")] == ("OUTPUT_PORT", "PROCESSOR", None, True)
    assert kinds[("r", "n")] == ("REMOTE_OUTPUT_PORT", "PROCESSOR", None, True)
    assert [k for k, r in built.items() if not r["valid"]] and not kinds[("?", "p")][3] and not kinds[("n", "?")][3]
    lost = sorted((r["source_id"], r["dest_id"], r["missing_side"]) for r in refs.dangling(inputs, components).collect())
    assert lost == [("?", "!", "destination"), ("?", "!", "source"), ("?", "p", "source"), ("n", "?", "destination")]


def test_unused_relationships(spark):
    declared = spark.createDataFrame(
        [("a", "ok"), ("a", "fail"), ("b", "ok"), ("c", "ok"), ("c", "ok")], "id string, relationship string"
    )
    edges = spark.createDataFrame(
        [("a", ["ok"]), ("a", ["ok", "other"]), ("c", ["ok"]), ("z", [])], "id string, relationships array<string>"
    )
    used = refs.used_relationships(edges, "id", "relationships")
    unused = refs.unused_relationships(declared, used, ["id"])
    assert sorted(map(tuple, unused.collect())) == [("a", "fail"), ("b", "ok")]
    lists = {r["id"]: r["relationships"] for r in refs.auto_terminate(unused, ["id"]).collect()}
    assert lists == {"a": ["fail"], "b": ["ok"]}


LINKS = "w string, parent_id string, id string, ord int"


def test_tree_reports_cycles_missing_and_depth(spark):
    links = [("w", "root", "a", 0), ("w", "root", "gone", 1), ("w", "a", "b", 0), ("w", "b", "a", 0), ("v", "root", "x", 0)]
    links += [("w", f"d{i}", f"d{i + 1}", 0) for i in range(12)] + [("w", "root", "d0", 2)]
    roots = spark.createDataFrame([("w", "root"), ("v", "root")], "w string, id string")
    known = {(w, i) for w, p, i, _ in links for i in (p, i)} - {("w", "gone")}
    nodes = spark.createDataFrame(sorted(known), "w string, id string")
    frame = spark.createDataFrame(links, LINKS)
    got = expand_hierarchy(frame, roots, ["w"], nodes).collect()
    by_id = {(r["w"], "/".join(r["path"])): r["status"] for r in got}
    assert by_id[("w", "root/a/b/a")] == "cycle"
    assert by_id[("w", "root/gone")] == "missing"
    assert by_id[("v", "root/x")] == "ok"
    assert by_id[("w", "root/" + "/".join(f"d{i}" for i in range(13)))] == "ok"
    assert len(got) == 2 + 1 + 3 + 1 + 13
    capped = {r["id"]: r["status"] for r in expand_hierarchy(frame, roots, ["w"], max_depth=4).where("w = 'w'").collect()}
    assert capped["d3"] == "ok" and capped["d4"] == "depth" and "d5" not in capped


def test_template_used_twice_is_expanded_twice(spark):
    links = [("w", "root", "a", 0), ("w", "root", "b", 1), ("w", "a", "shared", 0), ("w", "b", "shared", 0), ("w", "shared", "leaf", 0)]
    roots = spark.createDataFrame([("w", "root")], "w string, id string")
    got = expand_hierarchy(spark.createDataFrame(links, LINKS), roots, ["w"]).collect()
    assert sorted("/".join(r["path"]) for r in got if r["id"] == "leaf") == ["root/a/shared/leaf", "root/b/shared/leaf"]


def test_teardown_order(spark):
    rows = [
        ("c1", "CONNECTION", [], 0), ("p1", "x.Log", [], 0), ("f", "FUNNEL", [], 0), ("g", "PROCESS_GROUP", [], 3),
        ("gp", "PROCESSOR", [3], 0), ("gc", "CONNECTION", [3], 9), ("gg", "PROCESS_GROUP", [3], 1),
        ("ggp", "PROCESSOR", [3, 1], 0), ("i", "INPUT_PORT", [], 0), ("o", "OUTPUT_PORT", [], 0), ("l", "label", [], 0),
        ("r", "REMOTE_PROCESS_GROUP", [], 0), ("s", "CONTROLLER", [], 0), ("gs", "CONTROLLER", [3], 0),
        ("g2", "PROCESS_GROUP", [], 12),
    ]
    df = spark.createDataFrame([("w", *r) for r in rows], "w string, id string, kind string, group_ords array<bigint>, ord bigint")
    plan = [r["id"] for r in teardown_plan(df, ["w"]).orderBy("position").collect()]
    assert plan == ["c1", "p1", "f", "gc", "gp", "ggp", "gg", "gs", "g", "g2", "i", "o", "l", "r", "s"]


def test_ids_count_within_their_workspace(spark):
    components = spark.createDataFrame(
        [("w1", "1", "PROCESSOR"), ("w1", "2", "Funnel"), ("w2", "1", "process_group")],
        "w string, id string, kind string",
    )
    edges = spark.createDataFrame(
        [("w1", "1", "2", ["ok"], None, None), ("w2", "1", "2", ["ok"], "out", None)],
        "w string, source_id string, dest_id string, relationships array<string>, from_port string, to_port string",
    )
    built = refs.build_edges(edges, components, scope=["w"]).collect()
    assert len(built) == 2
    assert {(r["w"], r["source_kind"], r["dest_kind"], r["valid"]) for r in built} == {
        ("w1", "PROCESSOR", "FUNNEL", True), ("w2", "OUTPUT_PORT", "PROCESSOR", False),
    }
    lost = refs.dangling(edges, components, scope=["w"]).collect()
    assert [(r["w"], r["missing_side"], r["missing_id"]) for r in lost] == [("w2", "destination", "2")]
    ports = spark.createDataFrame(
        [("w2", "1", "out", "OUTPUT_PORT", "p"), ("w1", "1", "out", "OUTPUT_PORT", "q"), ("w2", "1", "out", "INPUT_PORT", "r")],
        "w string, group_id string, name string, kind string, port_id string",
    )
    ends = {r["w"]: r for r in refs.build_edges(edges, components, scope=["w"], ports=ports).collect()}
    assert (ends["w2"]["source_port_id"], ends["w2"]["source_ports"], ends["w2"]["dest_ports"]) == ("p", 1, None)
    assert (ends["w1"]["source_port_id"], ends["w1"]["source_ports"], ends["w1"]["valid"]) == (None, None, True)
    id_map = spark.createDataFrame([("w1", "1", "a"), ("w2", "1", "b")], "w string, old_id string, new_id string")
    moved = refs.remap_ids(edges, id_map, ["source_id"], scope=["w"]).collect()
    assert {(r["w"], r["source_id"]) for r in moved} == {("w1", "a"), ("w2", "b")}


def test_deep_trees_are_expanded_to_the_end(spark):
    links = spark.createDataFrame([("w", str(i), str(i + 1), 0) for i in range(70)], LINKS)
    roots = spark.createDataFrame([("w", "0")], "w string, id string")
    places = expand_hierarchy(links, roots, ["w"]).collect()
    assert len(places) == 71 and {r["status"] for r in places} == {"ok"}


def test_declared_relationships_are_made_in_several_tasks(spark):
    from flowtables.suite.refs import declared_relationships

    events = spark.range(100).select((F.col("id") % 40).alias("user_id"))
    made = declared_relationships(events)
    tasks = made.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 40 * 120


def _joins(node, column):
    """Joins of a plan into which a column comes from the left."""
    children = [node.children().apply(i) for i in range(node.children().size())]
    here = node.nodeName() == "Join" and column in children[0].output().mkString()
    return here + sum(_joins(c, column) for c in children)


def test_ports_are_found_beside_components_and_in_crowded_groups(spark):
    components = spark.createDataFrame(
        [("w", "big", "PROCESS_GROUP"), ("w", "few", "Process_Group"), ("w", "none", "PROCESS_GROUP"), ("w", "p", "X"),
         ("w", "twice", "X"), ("w", "twice", "X"), ("v", "few", "PROCESS_GROUP"), ("w", None, "PROCESS_GROUP")],
        "w string, id string, kind string",
    )
    crowd = [("w", "big", f"n{i}", "INPUT_PORT", f"b{i}") for i in range(refs.LISTED_PORTS + 6)]
    ports = [
        ("w", "big", "n7", "INPUT_PORT", "other"), ("w", "big", "n7", "INPUT_PORT", "b7"), ("w", "big", "n8", "OUTPUT_PORT", "o8"),
        ("w", "few", "a", "INPUT_PORT", "fa"), ("w", "few", "a", "OUTPUT_PORT", "oa"), ("w", "few", "a", "INPUT_PORT", "fa"),
        ("w", "few", None, "INPUT_PORT", "null"), ("w", "few", "d", "INPUT_PORT", "d1"), ("w", "few", "d", "INPUT_PORT", "d2"),
        ("w", None, "a", "INPUT_PORT", "lost"), ("v", "few", "a", "INPUT_PORT", "va"), ("w", "p", "a", "INPUT_PORT", "pa"),
    ]
    ends = [
        ("p", "big", None, "n3"), ("p", "big", None, "n7"), ("p", "big", None, "n8"), ("big", "few", "n8", "a"),
        ("few", "few", "a", "d"), ("p", "few", None, None), ("p", "none", "a", "a"), ("p", "p", "a", "a"),
        ("twice", "few", None, "a"), (None, "few", None, "a"), ("p", None, None, "a"),
    ]
    edges = spark.createDataFrame(
        [("w", s, d, ["ok"], a, b, i) for i, (s, d, a, b) in enumerate(ends)],
        "w string, source_id string, dest_id string, relationships array<string>, from_port string, to_port string, payload int",
    )
    expected = {
        0: (None, None, "b3", 1, True), 1: (None, None, None, 2, False), 2: (None, None, "b8", 1, True),
        3: ("o8", 1, "fa", 1, True), 4: ("oa", 1, None, 2, False), 5: (None, None, None, 0, False),
        6: (None, None, None, 0, False), 7: (None, None, None, None, True), 8: (None, None, "fa", 1, True),
        9: (None, None, "fa", 1, False), 10: (None, None, None, None, False),
    }
    at = "w string, group_id string, name string, kind string, port_id string"
    for crowded in (True, False):
        known = spark.createDataFrame(ports + (crowd if crowded else []), at)
        built = refs.build_edges(edges, components, scope=["w"], ports=known)
        rows = built.collect()
        assert sorted(r.payload for r in rows) == sorted([*range(11), 8])
        for r in rows:
            if crowded or r.payload not in (0, 1, 2):
                got = (r.source_port_id, r.source_ports, r.dest_port_id, r.dest_ports, r.valid)
                assert got == expected[r.payload], r
        # wide rows travel once for each end, and to the crowded groups only if there are some
        joins = _joins(built._jdf.queryExecution().optimizedPlan(), "payload")
        assert joins == (4 if crowded else 2)
