"""Structure of scopes refined inside tasks, held against the rounds over all of them."""

import random

import pytest
from pyspark.sql import functions as F

from flowtables.operators import compare, wiring
from tests.test_compare import _classes, ring

SCOPE = ["workspace", "flow"]
AT = "workspace string, flow string, "


def frames(spark, flows):
    """``flows``: (workspace, flow, [(id, kind)], [(owner, key)], [(source, dest, label)])."""
    components = [(w, f, *c) for w, f, nodes, _, _ in flows for c in nodes]
    keys = [(w, f, *k) for w, f, _, owned, _ in flows for k in owned]
    wires = [(w, f, a, b, x) for w, f, _, _, ends in flows for a, b, x in ends]
    return (
        spark.createDataFrame(components, AT + "id string, kind string"),
        spark.createDataFrame(keys, AT + "owner_id string, key string"),
        spark.createDataFrame(wires, AT + "source_id string, dest_id string, relationships array<string>"),
    )


def rings(name, *cycles, first="c"):
    rows, wires = ring(name, *cycles)
    return ("w", name, [(first + i, k) for _, i, k in rows], [], [(first + a, first + b, x) for _, a, b, x in wires])


def odd_flows():
    """Random flows, again under other ids; with nulls, repeated rows, unknown ends and look-alikes."""
    rnd, flows = random.Random(7), []
    for n in range(8):
        size = rnd.randint(1, 5)
        nodes = [(str(i), rnd.choice(["A", "B", None])) for i in range(size)]
        ends = [(rnd.randrange(size), rnd.randrange(size), rnd.choice([["x"], ["y", "x"], [None]])) for _ in range(size)]
        keys = [(rnd.randrange(size), rnd.choice("kl")) for _ in range(n % 3)]
        for flow, names in ((f"f{n}", "abcde"), (f"g{n}", "vutsr")):
            rows = [(names[int(i)], k) for i, k in nodes]
            flows.append(("w", flow, rows, [(names[i], k) for i, k in keys], [(names[a], names[b], x) for a, b, x in ends]))
    chain = [("o", "A"), ("p", "B"), ("q", "B")]
    line = [("o", "p", ["x"]), ("p", "q", ["x"])]
    flows += [("w", "c1", chain, [], line), ("w", "c2", [*chain, ("o", "A")], [], line), ("w", "c3", [*chain, ("o", "A")], [], line)]
    flows += [("w", "c4", chain, [("zz", "k")], [*line, ("o", "?", ["x"]), ("?", "o", ["x"]), (None, "o", ["x"]), ("o", None, ["x"])])]
    flows += [("w", None, [*chain, ("z", "A")], [], line), ("w", "c5", [("o", "A"), (None, "B"), (None, "B")], [], [("o", None, ["x"])])]
    flows += [("w", "one", [("x", "A")], [], []), ("w", "two", [("x", "A"), ("x", "A")], [], [])]
    return [*flows, rings("r33", 3, 3), rings("r6", 6), rings("r6b", 6, first="d"), rings("r4_2", 4, 2), rings("r2_4", 2, 4)]


def results(tables, by_task):
    """Classes of shapes and of signatures, and the connections between places for each member."""
    shape = compare.component_shapes if by_task else compare._shapes_by_rounds
    number = compare.component_ordinals if by_task else compare._ordinals_by_rounds
    shapes = shape(*tables, SCOPE).collect()
    places, signatures = number(*tables, "flow", SCOPE)
    rows = places.collect()
    signed = {r.flow: r.signature for r in signatures.collect()}
    wired = {f: [] for f in signed}
    at = {}
    for r in rows:
        at.setdefault((r.flow, r.id), []).append(r.ordinal)
    for r in tables[2].collect():
        for a in at.get((r.flow, r.source_id), []):
            wired[r.flow] += [(a, b, str(sorted(map(str, r.relationships)))) for b in at.get((r.flow, r.dest_id), [0])]
    return (
        _classes(((r.workspace, r.flow, r.id), r.shape) for r in shapes),
        len(shapes),
        _classes(signed.items()),
        {f: sorted(w) for f, w in wired.items()},
        {f: sorted(r.ordinal for r in rows if r.flow == f) for f in signed},
    )


@pytest.fixture
def tasks(monkeypatch):
    monkeypatch.setattr(wiring, "DEAL_ROWS", 0)
    monkeypatch.setattr(wiring, "TASK_ROWS", 40)
    return monkeypatch


def test_tasks_find_what_rounds_find(spark, tasks):
    tables = frames(spark, odd_flows())
    whole = results(tables, False)

    def never(*_):
        raise AssertionError("rounds over all components")

    tasks.setattr(compare, "_coloured", never)
    shapes, rows, signed, wired, placed = results(tables, True)
    assert (shapes, rows, placed) == (whole[0], whole[1], whole[4])
    # members that are the same may be kept apart if their places are ambiguous: the rings of r4_2 and r2_4
    plain = lambda classes: {c for c in classes if not c & {"r4_2", "r2_4"}}
    assert plain(signed) == plain(whole[2])
    assert {"f0", "g0"} in [c & {"f0", "g0"} for c in signed] and frozenset({"r6", "r6b"}) in signed
    for names in signed:
        assert len({str(wired[f]) for f in names}) == 1


def test_large_units_are_left_to_rounds(spark, tasks):
    tables = frames(spark, odd_flows())
    whole = results(tables, False)
    tasks.setattr(wiring, "UNIT_ROWS", 9)  # rings and some others are large
    assert wiring.Wiring.of(*tables, SCOPE, SCOPE).large.count() > 4
    shapes, rows, signed, wired, placed = results(tables, True)
    assert (shapes, rows, placed) == (whole[0], whole[1], whole[4])
    for names in signed:
        assert len({str(wired[f]) for f in names}) == 1


def test_a_unit_is_made_of_whole_scopes(spark, tasks):
    tables = frames(spark, [rings("a", 3)])
    assert wiring.Wiring.of(*tables, [], []) is None and wiring.Wiring.of(*tables, ["flow"], ["workspace"]) is None
    tasks.setattr(wiring, "DEAL_ROWS", 6)
    assert wiring.Wiring.of(*tables, SCOPE, SCOPE) is None
    empty = [df.where(F.lit(False)) for df in tables]
    tasks.setattr(wiring, "DEAL_ROWS", -1)
    assert wiring.Wiring.of(*empty, SCOPE, SCOPE).shapes().count() == 0


def test_order_flows_number_the_lines_once(spark, tmp_path):
    from flowtables.suite.snapshots import order_flows

    orders = [(1, "F", "p"), (2, "O", "q"), (3, "F", None), (None, "F", "p")]
    lines = [(1, 5, 1, n, "R", "O", 2.0) for n in (2, 1, 3)] + [(2, 5, 1, 1, "A", "F", 2.0), (None, 5, 1, 1, "N", "F", 1.0)]
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_quantity double"
    spark.createDataFrame(orders, "o_orderkey long, o_orderstatus string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    components, edges, values = order_flows(spark, str(tmp_path))
    assert sorted((r.flow or "", r.id) for r in components.collect()) == [
        *[("", "line1"), ("", "order"), ("", "order")],
        *[("a/1", "line1"), ("a/1", "line2"), ("a/1", "line3"), ("a/1", "order"), ("a/2", "line1"), ("a/2", "order"), ("a/3", "order")],
        *[("b/1", "line1"), ("b/1", "line2"), ("b/1", "order"), ("b/3", "order")],
    ]
    assert sorted((r.source_id, r.dest_id) for r in edges.where("flow = 'b/1'").collect()) == [("line1", "line2"), ("order", "line1")]
    assert values.count() == edges.count() == 7
    for df in (components, edges, values):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1
