"""The operators together on one small workspace, from documents to plans."""

import pytest
from pyspark.sql import functions as F

from flowtables.operators import naming, refs, settings
from flowtables.operators.hierarchy import expand_hierarchy
from flowtables.plans.lifecycle import state_plan
from flowtables.session import cut
from flowtables.sources import exports
from tests.test_exports import INNER, ROOT


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame(
        [("w", "root.yaml", ROOT), ("w", "inner.yaml", INNER)], "workspace string, file string, text string"
    )
    return exports.to_tables(cut(exports.read_exports_yaml(docs)))


def test_settings_there_and_back(spark):
    owners = spark.createDataFrame(
        [("p", "x.Log", "PROCESSOR"), ("q", "x.Other", "PROCESSOR"), ("r", None, "REMOTE_PROCESS_GROUP")],
        "owner_id string, type string, kind string",
    )
    rows = [
        ("p", "property", "Level", "info"), ("p", "property", "Prefix", None), ("p", "property", "Gone", "x"),
        ("q", "property", "Level", "info"),
        ("p", "scheduling", "runSchedule", "0 sec"), ("p", "scheduling", "execution", "PRIMARY"),
        ("p", "scheduling", "penaltyDuration", None),
        ("p", "style", "background-color", "#fff7d7"), ("p", "style", "font-size", "14px"), ("p", "style", "border", "1"),
        ("r", "remote", "protocol", "HTTP"), ("r", "remote", "timeout", "30 sec"), ("r", "remote", "proxyHost", ""),
        ("r", "remote", "targetUris", "http://h"),
        ("e", "edge", "flowFileExpiration", "0 mins"), ("e", "edge", "labelIndex", "1"), ("e", "edge", "zIndex", "0"),
        ("e", "edge", "backPressureObjectThreshold", "10"), ("e", "edge", "name", ""),
    ]
    values = spark.createDataFrame(rows, "owner_id string, section string, key string, value string")
    described = spark.createDataFrame(
        [("x.Log", "Level", ["warn"]), ("x.Log", "Prefix", ["p"]), ("x.Log", "Free", None)],
        "type string, key string, defaults array<string>",
    )
    stored = cut(settings.sparse_settings(values, owners, described))
    got = {(r["owner_id"], r["section"], r["key"]): r["value"] for r in stored.collect()}
    assert got == {
        ("p", "property", "Level"): "info", ("p", "property", "Prefix"): None,
        ("p", "scheduling", "execution"): "PRIMARY",
        ("p", "style", "font-size"): "14px", ("p", "style", "border"): "1",
        ("r", "remote", "protocol"): "HTTP", ("r", "remote", "yieldDuration"): None,
        ("r", "remote", "targetUris"): "http://h",
        ("e", "edge", "zIndex"): "0", ("e", "edge", "backPressureObjectThreshold"): "10",
    }
    full = settings.full_settings(stored, owners.where("owner_id = 'r'"), "remote")
    assert {r["key"]: r["value"] for r in full.collect()} == {
        "protocol": "HTTP", "timeout": "30 sec", "yieldDuration": "10 sec", "targetUris": "http://h",
    }


def test_types_and_names(tables):
    attached = naming.unnest(
        naming.nest(
            tables["dependencies"], ["workspace", "template"], ["grp", "artifact", "version", "name"], "type"
        ),
        ["workspace", "template"],
        "tree",
        ["grp", "artifact", "version", "name"],
        "type",
    )
    full = tables["components"].join(
        attached.select("workspace", "template", F.col("name").alias("type"), F.col("type").alias("class")),
        ["workspace", "template", "type"],
        "left",
    )
    assert {r["id"]: r["class"] for r in full.where("class IS NOT NULL").collect()} == {"p1": "org.acme.Fetch"}


def test_import_steps(spark, tables):
    id_map = spark.createDataFrame(
        [("s1", "S-new", 1), ("p1", "P-old", 1), ("p1", "P-new", 2)], "old_id string, new_id string, ord int"
    )
    latest = refs.latest_ids(id_map)
    rewritten = refs.remap_values(tables["properties"], latest)
    service = rewritten.where("owner_id = 'p1' AND key = 'Service'").collect()
    assert [r["value"] for r in service] == ["S-new"]

    edges = refs.build_edges(tables["edges"], tables["components"])
    got = {(r["source_id"], r["dest_id"]): (r["source_kind"], r["dest_kind"], r["relationships"]) for r in edges.collect()}
    assert got == {
        ("p1", "f1"): ("PROCESSOR", "FUNNEL", ["ok", "fail"]),
        ("g1", "f1"): ("OUTPUT_PORT", "FUNNEL", None),
        ("f1", "g1"): ("FUNNEL", "INPUT_PORT", None),
    }
    assert refs.dangling(tables["edges"], tables["components"]).count() == 0
    moved = refs.remap_ids(edges, latest, ["source_id", "dest_id"])
    assert {r["source_id"] for r in moved.collect()} == {"P-new", "g1", "f1"}

    declared = spark.createDataFrame(
        [("p1", "ok"), ("p1", "retry"), ("p1", "fail")], "source_id string, relationship string"
    )
    used = refs.used_relationships(tables["edges"], "source_id", "relationships")
    unused = refs.unused_relationships(declared, used, ["source_id"])
    assert [tuple(r) for r in unused.collect()] == [("p1", "retry")]


@pytest.mark.parametrize("target,words", [
    ("enabled", ["stopped", "running", "running", "transmitting", "enabled"]),
    ("disabled", ["stopped", "stopped", "stopped", "disabled"]),
])
def test_start_and_stop(spark, tables, target, words):
    links = tables["components"].where("child_template IS NOT NULL").select(
        "workspace", F.col("template").alias("parent_id"), F.col("child_template").alias("id"), "ord"
    )
    roots = tables["templates"].where("template = 'root'").select("workspace", F.col("template").alias("id"))
    nodes = tables["templates"].select("workspace", F.col("template").alias("id"))
    places = expand_hierarchy(links, roots, ["workspace"], nodes)
    assert {r["id"]: (r["depth"], r["status"]) for r in places.collect()} == {"root": (0, "ok"), "inner": (1, "ok")}
    groups = places.select("workspace", F.col("id").alias("template"), F.col("ords").alias("group_ords"))
    members = tables["components"].select("workspace", "template", "id", "kind", "ord").unionByName(
        tables["controllers"].select("workspace", "template", "id", F.lit("CONTROLLER").alias("kind"), "ord")
    )
    plan = state_plan(
        members.join(groups, ["workspace", "template"]).withColumn("status", F.lit("DISABLED")), ["workspace"], target
    )
    steps = plan.orderBy("position").collect()
    # in its group: processor, then controller, then the child group's port, remote group last
    order = [r["id"] for r in steps]
    assert order == (["p1"] * (len(words) - 3) + ["s1", "i1", "r1"])
    assert sorted(r["state"] for r in steps) == sorted(words)
