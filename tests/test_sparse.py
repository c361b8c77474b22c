"""Null cases and round trips of the sparse operators."""

import pytest
from pyspark.sql import functions as F

from flowtables.functions import values as V
from flowtables.operators import sparse

CASES = [
    # key, defaults, configured value (absent: no row)
    ("nn", None, None),
    ("nv", None, "x"),
    ("dn", ["d"], None),
    ("dd", ["d"], "d"),
    ("dv", ["d"], "v"),
    ("de", ["d"], ""),
    ("multi", ["d", "e"], "e"),
    ("absent", ["d"], "absent"),
    ("absent_null", None, "absent"),
]


def tables(spark):
    described = spark.createDataFrame(
        [("t", k, d) for k, d, _ in CASES], "type string, key string, defaults array<string>"
    )
    values = spark.createDataFrame(
        [("o", "t", k, v) for k, _, v in CASES if v != "absent"] + [("o", "t", "unknown", "u")],
        "owner_id string, type string, key string, value string",
    )
    owners = spark.createDataFrame([("o", "t"), ("empty", "t")], "owner_id string, type string")
    return values, described, owners


def kept(df, owner="o"):
    return {r["key"]: r["value"] for r in df.collect() if r["owner_id"] == owner}


def test_described(spark):
    values, described, owners = tables(spark)
    got = sparse.sparse_diff(values, described, owners=owners, type_columns=["type"])
    wanted = {"nv": "x", "dn": None, "dv": "v", "de": "", "absent": None}
    assert kept(got) == wanted
    # an owner without any value: every non-null default has been cleared
    assert kept(got, "empty") == dict.fromkeys(["dn", "dd", "dv", "de", "multi", "absent"])
    assert {r["key"] for r in got.where("cleared AND owner_id = 'o'").collect()} == {"dn", "absent"}


def test_mapping_form_agrees(spark):
    values, described, owners = tables(spark)
    mapping = {k: d or [] for k, d, _ in CASES}
    a = sparse.sparse_diff(values, described, owners=owners, type_columns=["type"])
    b = sparse.sparse_diff(values, mapping, owners=owners)
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    with pytest.raises(ValueError):
        sparse.sparse_diff(values, described.drop("type"), owners=owners)


def test_present_only_and_emit(spark):
    values, described, owners = tables(spark)
    skip = sparse.sparse_diff(values, described, type_columns=["type"], nulls="skip")
    assert kept(skip) == {"nv": "x", "dv": "v", "de": ""}
    emit = sparse.sparse_diff(values, described, owners=owners, type_columns=["type"], nulls="emit")
    assert kept(emit) == {
        "nn": None, "nv": "x", "dn": None, "dv": "v", "de": "", "absent": None, "absent_null": None,
    }


def test_overlay_keeps_unknown_keys(spark):
    values, described, _ = tables(spark)
    got = sparse.sparse_diff(values, described, type_columns=["type"], driver="values")
    assert kept(got) == {"nv": "x", "dn": None, "dv": "v", "de": "", "unknown": "u"}


@pytest.mark.parametrize("nulls", ["keep", "skip", "emit"])
def test_wide_form_agrees(spark, nulls):
    wide = spark.createDataFrame(
        [("1", "d", None), ("2", None, "x"), ("3", "v", "y"), ("4", "", None)],
        "owner_id string, a string, b string",
    )
    defaults = {"a": ["d"], "b": [None], "c": []}
    columns = {"a": F.col("a"), "b": F.col("b")}
    long = sparse.unpivot_text(wide, ["owner_id"], columns)
    one = sparse.wide_diff(wide, ["owner_id"], columns, defaults, nulls)
    two = sparse.sparse_diff(
        long, defaults, owners=wide.select("owner_id"), nulls=nulls
    )
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))


def test_overrides_restore(spark):
    values, described, owners = tables(spark)
    diff = sparse.sparse_diff(values, described, type_columns=["type"], nulls="skip")
    base = owners.where("owner_id = 'o'").join(described, "type").select(
        "owner_id", "key", F.get("defaults", F.lit(0)).alias("default")
    )
    full = kept(sparse.apply_overrides(base, diff, ["owner_id", "key"]))
    assert full["dv"] == "v" and full["dd"] == "d" and full["nv"] == "x"
    assert full["de"] == "d"  # an empty override is none
    assert full["nn"] is None


def test_non_default_rows(spark):
    ports = spark.createDataFrame(
        [("a", None, None), ("b", 3, None), ("c", None, True)], "name string, tasks int, zip boolean"
    )
    known = spark.createDataFrame([("a",), ("b",)], "name string")
    got = sparse.non_default_rows(ports, ["tasks", "zip"], known, ["name"])
    assert [r["name"] for r in got.collect()] == ["b"]


def test_prune(spark):
    df = spark.createDataFrame(
        [("", [], {"a": "", "b": "1"}, ("", None)), ("x", ["", "y"], {"a": ""}, ("", 0))],
        "t string, l array<string>, m map<string,string>, s struct<u:string,n:int>",
    )
    first, second = V.prune_empty(df).collect()
    assert (first["t"], first["l"], first["m"], first["s"]) == (None, None, {"b": "1"}, None)
    assert second["l"] == ["", "y"] and second["m"] is None
    assert (second["s"]["u"], second["s"]["n"]) == (None, 0)


def test_positions_and_literals(spark):
    df = spark.createDataFrame(
        [("-0.4,2.5", "30 sec", "1 GB"), ("7", "10s", "1000b"), (None, "0 mins", "x"), ("a,3", "1 eon", None)],
        "p string, d string, s string",
    )
    parsed = df.withColumn("q", V.parse_position(F.col("p")))
    rows = parsed.select(
        V.format_position(F.col("q.x"), F.col("q.y")).alias("again"),
        F.col("q.x").alias("x"),
        V.parse_duration(F.col("d")).alias("d"),
        V.parse_size(F.col("s")).alias("s"),
    ).collect()
    assert rows[0]["again"] == "0,3" and rows[0]["x"] == -0.4
    assert [r["again"] for r in rows[1:]] == [None, None, None]
    assert [r["d"] for r in rows] == [30.0, 10.0, 0.0, None]
    assert [r["s"] for r in rows] == [1024.0**3, 1000.0, None, None]


def test_kinds(spark):
    df = spark.createDataFrame([("funnel",), ("Label",), (None,), ("x.Log",), ("PROCESS_GROUP",)], "t string")
    rows = df.select(
        V.classify_kind(F.col("t")).alias("k"),
        V.endpoint_kind(F.col("t"), "source").alias("s"),
        V.endpoint_kind(F.col("t"), "destination").alias("d"),
        V.is_group(F.col("t")).alias("g"),
        V.is_port(F.col("t")).alias("p"),
    ).collect()
    assert [r["k"] for r in rows] == ["funnel", "label", "processor", "processor", "process_group"]
    # kinds count in any spelling, at an endpoint as elsewhere
    assert [r["s"] for r in rows] == ["FUNNEL", "PROCESSOR", "PROCESSOR", "PROCESSOR", "OUTPUT_PORT"]
    assert rows[4]["d"] == "INPUT_PORT"
    assert [r["g"] for r in rows] == [False, False, False, False, True]


def test_extent_without_positions(spark):
    df = spark.createDataFrame(
        [("a", -5.0, -7.0), ("a", -9.0, -1.0), ("b", None, None)], "g string, x double, y double"
    )
    got = {r["g"]: (r["max_x"], r["max_y"]) for r in sparse.extent(df, ["g"], "x", "y").collect()}
    assert got == {"a": (495.0, 499.0), "b": (None, None)}


def test_numbers_that_do_not_fit_and_label_sizes(spark):
    from flowtables.functions.values import format_position
    from flowtables.operators.settings import label_sizes, sparse_settings

    df = spark.createDataFrame([(1, 1e20, float("nan")), (2, 1.5, -0.2)], "owner_id int, x double, y double")
    texts = [r[0] for r in df.orderBy("owner_id").select(format_position(F.col("x"), F.col("y"))).collect()]
    assert texts == [None, "2,0"]
    sizes = label_sizes(df, ["owner_id"], "x", "y")
    assert sorted((r["owner_id"], r["key"], r["value"]) for r in sizes.collect()) == [(2, "height", "0"), (2, "width", "2")]
    ports = spark.createDataFrame(
        [("w1", 1, "remote_port", "maxConcurrentTasks", "1"), ("w2", 1, "remote_port", "maxConcurrentTasks", "3"),
         ("w2", 1, "remote_port", "useCompression", None), ("w2", 1, "remote_port", "batchCount", "7")],
        "w string, owner_id int, section string, key string, value string",
    )
    owners = spark.createDataFrame([], "w string, owner_id int, type string, kind string")
    kept = sparse_settings(ports, owners, owner=["w", "owner_id"]).collect()
    assert sorted((r["w"], r["key"], r["value"]) for r in kept) == [("w2", "batchCount", "7"), ("w2", "maxConcurrentTasks", "3")]
