"""Deep trees, shared groups and cycles, against a walk in plain Python."""

import pytest

from flowtables.operators import hierarchy

REFS = "parent_id string, id string, ord bigint"


def walk(links, roots, max_depth=None):
    below = {}
    for parent, child, place in links:
        below.setdefault(parent, []).append((child, place))
    out, stack = [], [(r, None, (r,), (), "ok") for r in roots]
    while stack:
        node, parent, path, ords, status = stack.pop()
        out.append((node, parent, len(path) - 1, path, ords, status))
        if status == "ok":
            for child, place in below.get(node, []):
                kind = "cycle" if child in path else "ok"
                if kind == "ok" and max_depth is not None and len(path) > max_depth:
                    kind = "depth"
                stack.append((child, node, (*path, child), (*ords, place), kind))
    return sorted(out, key=repr)


def found(df):
    return sorted(
        ((r.id, r.parent_id, r.depth, tuple(r.path), tuple(r.ords), r.status) for r in df.collect()), key=repr
    )


LINKS = (
    [(f"a{i}", f"a{i + 1}", i) for i in range(21)]
    + [("a3", "b", 7), ("b", "a5", 1), ("a9", "a9", 2), ("a20", "a4", 3), ("a2", "leaf", 0)]
    + [("u1", "u2", 0), ("u2", "u1", 0), ("x", "a1", 0)]
)


@pytest.mark.parametrize("max_depth", [None, 0, 2, 3, 4, 9, 16])
def test_deep_shared_and_cyclic_groups(spark, max_depth):
    links = spark.createDataFrame(LINKS, REFS)
    roots = spark.createDataFrame([("a0",), ("u1",)], "id string")
    got = hierarchy.expand_hierarchy(links, roots, max_depth=max_depth)
    assert found(got) == walk(LINKS, ["a0", "u1"], max_depth)


def test_scopes_and_missing_ids(spark):
    rows = [("s", *link) for link in LINKS[:8]] + [("t", "a0", "a1", 0)]
    links = spark.createDataFrame(rows, "w string, " + REFS)
    roots = spark.createDataFrame([("s", "a0"), ("t", "a0")], "w string, id string")
    nodes = spark.createDataFrame([("s", f"a{i}") for i in range(8)] + [("t", "a0")], "w string, id string")
    got = hierarchy.expand_hierarchy(links, roots, ["w"], nodes).collect()
    assert {(r.w, r.id): r.status for r in got if r.status != "ok"} == {("s", "a8"): "missing", ("t", "a1"): "missing"}
    assert len(got) == 11


def test_rounds_are_the_logarithm_of_the_depth(spark, monkeypatch):
    n, rounds = 500, []
    for name in ("cut", "stored"):
        kept = getattr(hierarchy, name)
        monkeypatch.setattr(hierarchy, name, lambda *a, kept=kept: rounds.append(1) or kept(*a))
    links = spark.range(n).selectExpr(
        "concat('n', id) AS parent_id", "concat('n', id + 1) AS id", "id AS ord"
    )
    places = hierarchy.expand_hierarchy(links, spark.createDataFrame([("n0",)], "id string"))
    got = places.selectExpr("depth", "size(path) AS p", "path[depth] AS last", "parent_id", "get(ords, depth - 1) AS o")
    rows = sorted(got.collect())
    assert [tuple(r) for r in rows[1:]] == [(d, d + 1, f"n{d}", f"n{d - 1}", d - 1) for d in range(1, n + 1)]
    assert len(rows) == n + 1 and len(rounds) < 30
