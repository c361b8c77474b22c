"""Snapshots and structure."""

from pyspark.sql import functions as F

from flowtables.operators import compare

COLUMNS = "id string, key string, value string"


def table(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


def test_diff(spark):
    before = table(spark, ("a", "k", "1"), ("b", "k", None), ("c", "k", "1"), ("d", "k", "x"), ("e", "k", None), ("f", "k", "1"), ("f", "k", "1"))
    after = table(spark, ("a", "k", "2"), ("b", "k", "1"), ("d", "k", "x"), ("e", "k", None), ("n", "k", None), ("f", "k", "1"))
    got = {r["id"]: r for r in compare.diff_snapshots(before, after, ["id", "key"]).collect()}
    assert {i: r["change"] for i, r in got.items()} == {
        "a": "changed", "b": "changed", "c": "removed", "n": "added", "f": "duplicate",
    }
    assert got["b"]["changed_columns"] == ["value"]
    assert (got["a"]["before"]["value"], got["a"]["after"]["value"]) == ("1", "2")
    assert got["n"]["before"] is None and got["n"]["changed_columns"] is None


def test_merge(spark):
    schema = "id string, x string, y string"
    base = [("same", "1", "1"), ("ours", "1", "1"), ("theirs", "1", "1"), ("both", "1", "1"), ("cols", "1", "1"),
            ("clash", "1", "1"), ("del", "1", "1"), ("deldel", "1", "1"), ("delchg", "1", "1")]
    ours = [("same", "1", "1"), ("ours", "2", "1"), ("theirs", "1", "1"), ("both", "2", None), ("cols", "2", "1"),
            ("clash", "2", "9"), ("del", "1", "1"), ("new", "n", "n"), ("newnew", "n", "n"), ("newclash", "a", "n")]
    theirs = [("same", "1", "1"), ("ours", "1", "1"), ("theirs", None, "1"), ("both", "2", None), ("cols", "1", "3"),
              ("clash", "3", "1"), ("delchg", "1", "2"), ("newnew", "n", "n"), ("newclash", "b", "n")]
    frames = [spark.createDataFrame(rows, schema) for rows in (base, ours, theirs)]
    got = {r["id"]: r for r in compare.merge_snapshots(*frames, ["id"]).collect()}
    summary = {i: (r["status"], r["present"], r["x"], r["y"]) for i, r in got.items()}
    assert summary == {
        "same": ("unchanged", True, "1", "1"),
        "ours": ("ours", True, "2", "1"),
        "theirs": ("theirs", True, None, "1"),
        "both": ("same", True, "2", None),
        "cols": ("merged", True, "2", "3"),
        "clash": ("conflict", True, None, "9"),
        "del": ("theirs", False, None, None),
        "deldel": ("same", False, None, None),
        "delchg": ("conflict", None, None, None),
        "new": ("ours", True, "n", "n"),
        "newnew": ("same", True, "n", "n"),
        "newclash": ("conflict", None, None, None),
    }
    assert got["clash"]["conflicts"] == ["x"] and got["newclash"]["conflicts"] == ["x", "y"]
    assert (got["clash"]["ours"]["x"], got["clash"]["theirs"]["x"]) == ("2", "3")


def flow(prefix, texts, swap=False):
    ids = [f"{prefix}{i}" for i in range(4)]
    components = [(prefix, ids[0], "A"), (prefix, ids[1], "B"), (prefix, ids[2], "B"), (prefix, ids[3], "C")]
    ends = [(0, 1), (1, 2), (2, 3)] if not swap else [(0, 1), (0, 2), (2, 3)]
    edges = [(ids[a], ids[b], ["ok"]) for a, b in ends]
    properties = [(ids[0], "url", texts[0]), (ids[3], "path", texts[1])]
    return components, edges, properties


def test_structure_ignores_ids_and_order(spark):
    parts = [flow("m", ("u1", "p")), flow("q", ("u2", "p")), flow("z", ("u1", "p"), swap=True)]
    components = [c for p in parts for c in reversed(p[0])]
    edges = [e for p in parts for e in p[1]]
    properties = [x for p in parts for x in p[2]]
    frame = spark.createDataFrame(components, "template string, id string, kind string")
    wires = spark.createDataFrame(edges, "source_id string, dest_id string, relationships array<string>")
    settings = spark.createDataFrame(properties, "owner_id string, key string, value string")
    shapes = compare.component_shapes(frame, settings, wires)
    elements = frame.join(shapes, "id")
    signatures = compare.structural_signatures(elements, ["template"], ["shape"])
    by_template = {r["template"]: r["signature"] for r in signatures.collect()}
    assert by_template["m"] == by_template["q"] != by_template["z"]
    groups = compare.structural_groups(signatures, "template")
    assert [(r["members"], r["first_member"]) for r in groups.collect()] == [(2, "m")]

    values = (
        settings.join(elements, F.col("owner_id") == F.col("id"))
        .select("template", F.concat_ws(".", F.col("shape").cast("string"), "key").alias("slot"), "value")
    )
    slots, variables = compare.structural_template(values, signatures, groups, "template")
    by_key = {r["slot"].split(".")[1]: (r["varies"], r["value"]) for r in slots.collect()}
    assert by_key == {"url": (True, None), "path": (False, "p")}
    assert sorted((r["template"], r["value"]) for r in variables.collect()) == [("m", "u1"), ("q", "u2")]


def test_signature_counts_repeats(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("c", "x"), ("c", "x")], "m string, s string")
    got = {r["m"]: r["signature"] for r in compare.structural_signatures(df, ["m"], ["s"]).collect()}
    assert got["a"] == got["c"] != got["b"]


def test_columns_of_either_snapshot_count(spark):
    before = spark.createDataFrame([(1, "a")], "id int, x string")
    after = spark.createDataFrame([(1, "a", 5)], "id int, x string, y int")
    changes = compare.diff_snapshots(before, after, ["id"]).collect()
    assert [(r["change"], r["changed_columns"]) for r in changes] == [("changed", ["y"])]
    merged = compare.merge_snapshots(before, before, after, ["id"]).first()
    assert (merged["status"], merged["y"]) == ("theirs", 5)


def test_structure_is_told_apart_at_any_distance(spark):
    rows, wires = [], []
    for flow_name, last in (("m", "B"), ("n", "C")):
        rows += [(flow_name, str(i), "A") for i in range(9)] + [(flow_name, "9", last)]
        wires += [(flow_name, str(i), str(i + 1), ["ok"]) for i in range(9)]
    components = spark.createDataFrame(rows, "flow string, id string, kind string")
    edges = spark.createDataFrame(wires, "flow string, source_id string, dest_id string, relationships array<string>")
    nothing = spark.createDataFrame([], "flow string, owner_id string, key string")
    shapes = compare.component_shapes(components, nothing, edges, ["flow"]).collect()
    by_place = {(r["flow"], r["id"]): r["shape"] for r in shapes}
    assert len(by_place) == 20 and by_place["m", "0"] != by_place["n", "0"]


def ring(flow_name, *cycles):
    """Directed cycles of components of one kind, all in one flow."""
    rows, wires, n = [], [], 0
    for size in cycles:
        rows += [(flow_name, f"c{n + i}", "A") for i in range(size)]
        wires += [(flow_name, f"c{n + i}", f"c{n + (i + 1) % size}", ["ok"]) for i in range(size)]
        n += size
    return rows, wires


def frames(spark, *flows):
    rows, wires = [sum((f[k] for f in flows), []) for k in (0, 1)]
    components = spark.createDataFrame(rows, "flow string, id string, kind string")
    edges = spark.createDataFrame(wires, "flow string, source_id string, dest_id string, relationships array<string>")
    return components, spark.createDataFrame([], "flow string, owner_id string, key string"), edges


def star(flow_name, leaves, names):
    rows = [(flow_name, "hub", "H")] + [(flow_name, f"{names}{i}", "L") for i in range(leaves)]
    return rows, [(flow_name, "hub", f"{names}{i}", ["ok"]) for i in range(leaves)]


def test_ordinals_map_members_onto_each_other(spark):
    parts = frames(
        spark, ring("two", 3, 3), ring("six", 6), ring("again", 6), star("s1", 40, "x"), star("s2", 40, "a"),
        star("s3", 39, "x"),
    )
    shapes = compare.component_shapes(*parts, ["flow"]).collect()
    assert len({r["shape"] for r in shapes if r["flow"] in ("two", "six", "again")}) == 1
    ordinals, signatures = compare.component_ordinals(*parts, "flow", ["flow"])
    by_flow = {r["flow"]: r["signature"] for r in signatures.collect()}
    assert by_flow["six"] == by_flow["again"] != by_flow["two"]
    assert by_flow["s1"] == by_flow["s2"] != by_flow["s3"]
    place = {(r["flow"], r["id"]): r["ordinal"] for r in ordinals.collect()}
    assert sorted(v for (f, _), v in place.items() if f == "six") == [1, 2, 3, 4, 5, 6]
    wires = {
        f: {(place[f, s], place[f, d]) for g, s, d, _ in ring(f, 6)[1] if g == f} for f in ("six", "again")
    }
    assert wires["six"] == wires["again"] and place["s1", "hub"] == place["s2", "hub"]


def test_a_round_writes_only_what_is_told_apart(spark):
    n = 10
    rows = [("m", f"c{i}", "A") for i in range(n)] + [("m", "end", "B")]
    wires = [("m", f"c{i}", f"c{i + 1}" if i + 1 < n else "end", ["ok"]) for i in range(n)]
    colouring = compare._coloured(*frames(spark, (rows, wires)), ["flow"])
    # both ends work inwards, two components a round at most
    assert max(colouring.rows[2:]) <= 2 and sum(colouring.rows) <= 3 * n + 2
    assert colouring.now().select("c1", "c2").distinct().count() == n + 1


def test_only_differing_groups_are_compared(spark):
    schema = "t string, k int, x string, y int"
    rows = [("a", 1, "p", 1), ("a", 2, None, 2), ("b", 1, "p", 1), (None, 1, "q", 1), (None, 2, "q", 1), ("c", 1, "p", 1)]
    before = spark.createDataFrame(rows, schema)
    after = spark.createDataFrame([("a", 1, "p", 1), ("a", 2, None, 2), ("b", 1, "p", 2), (None, 1, "r", 1), (None, 2, "q", 1), ("d", 1, "p", 1)], schema)
    names = {r["t"] for r in compare.differing(before, after, ["t"]).collect()}
    assert names == {"b", None, "c", "d"}
    got = compare.diff_snapshots(before, after, ["t", "k"], ["t"])
    plain = compare.diff_snapshots(before, after, ["t", "k"])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect())) and got.count() == 4
    wider = after.withColumn("z", F.lit(None).cast("int"))
    assert {r["t"] for r in compare.differing(before, wider, ["t"]).collect()} == names


def _copied_flows(spark, copies):
    """Flows of three contents, each ``copies`` times, and one of the same wiring under other ids."""
    components, edges = [], []
    for n in range(3 * copies + 1):
        ids = ["x", "y", "z"] if n == 3 * copies else ["p", "q", "r"]
        kinds = ["A", "B", "A" if n % 3 else None]
        components += [("w", f"f{n}", i, k) for i, k in zip(ids, kinds)]
        edges += [("w", f"f{n}", ids[0], ids[1], ["s"]), ("w", f"f{n}", ids[1], ids[n % 3], ["s", "t"])]
    at = "workspace string, flow string, "
    return (
        spark.createDataFrame(components, at + "id string, kind string"),
        spark.createDataFrame([], at + "owner_id string, key string"),
        spark.createDataFrame(edges, at + "source_id string, dest_id string, relationships array<string>"),
    )


def _classes(rows):
    """Rows (name, value) as the set of names that share a value."""
    found = {}
    for name, value in rows:
        found.setdefault(value, set()).add(name)
    return {frozenset(names) for names in found.values()}


def test_copies_of_a_flow_are_refined_once(spark, monkeypatch):
    scope, tables = ["workspace", "flow"], _copied_flows(spark, 5)
    seen, plain = [], compare._coloured

    def counted(components, *others):
        seen.append(components.count())
        return plain(components, *others)

    def results():
        shapes = compare.component_shapes(*tables, scope)
        places, signatures = compare.component_ordinals(*tables, "flow", scope)
        return (
            _classes(((r.workspace, r.flow, r.id), r.shape) for r in shapes.collect()),
            _classes(((r.flow, r.id), r.ordinal) for r in places.collect()),
            _classes((r.flow, r.signature) for r in signatures.collect()),
        )

    monkeypatch.setattr(compare, "_coloured", counted)
    folded = results()
    assert seen == [12, 12]  # three contents and the one under other ids, three components each
    monkeypatch.setattr(compare._Folded, "of", classmethod(lambda cls, *a: None))
    whole = results()
    assert seen[2:] == [48, 48]
    assert folded[0] == whole[0] and folded[2] == whole[2]
    assert len(folded[0]) == 9 and sum(map(len, folded[1])) == 48


def test_flows_in_two_workspaces_are_not_folded_by_member(spark):
    components, properties, edges = _copied_flows(spark, 3)
    twice = lambda df: df.unionAll(df.withColumn("workspace", F.lit("v")))
    scope = ["workspace", "flow"]
    tables = [twice(df) for df in (components, properties, edges)]
    assert compare._Folded.of(*tables, scope, ["flow"]) is None
    assert compare._Folded.of(*tables, scope, scope).firsts.count() == 4
    assert compare.component_ordinals(*tables, "flow", scope)[0].count() == 60
