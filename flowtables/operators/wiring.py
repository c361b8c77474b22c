"""Structure of scopes that fit into one task: refined there, in one shuffle of all rows.

Spark partitions rows by scope; a task works on all its scopes at once with numpy arrays of 64-bit hashes, two
for each value. Units with more than ``UNIT_ROWS`` rows are told apart before and left to the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.operators.spread import DEAL_ROWS, same_keys, small
from flowtables.session import stored

# Rows (components, property keys and connections) of a task, about 200 bytes each as arrays, and most of one unit.
TASK_ROWS = 200_000
UNIT_ROWS = 100_000
# Counters over which scopes are hashed, to find those that can be large.
COUNTERS = 1 << 16
COMPONENT, EDGE, PROPERTY = 0, 1, 2


class Wiring:
    """Components, property keys and connections as rows of one stored table, by ``unit`` columns.

    No connection leaves its ``scope``, and a unit holds whole scopes. ``large`` has the units with more than
    ``UNIT_ROWS`` rows, or is None.
    """

    def __init__(self, rows: DataFrame, total: int, large: DataFrame | None, scope: Sequence[str], unit: Sequence[str]):
        self.rows, self.total, self.large = rows, total, large
        self.scope, self.unit = list(scope), list(unit)

    @classmethod
    def of(
        cls,
        components: DataFrame,
        properties: DataFrame,
        edges: DataFrame,
        scope: Sequence[str],
        unit: Sequence[str],
    ) -> Wiring | None:
        """None for tables of few rows, and where a unit is not made of whole scopes."""
        if not unit or not set(unit) <= set(scope):
            return None
        kind = components.schema["id"].dataType

        def part(df: DataFrame, what: int, at: str, cell: Column, other: Column) -> DataFrame:
            hashes = [F.xxhash64(F.lit(seed), cell).alias(name) for seed, name in (("1", "a"), ("2", "b"))]
            ends = [F.col(at).cast(kind).alias("id"), other.cast(kind).alias("other")]
            return df.select(*scope, F.lit(what).alias("what"), *ends, *hashes)

        rows = stored(
            part(components, COMPONENT, "id", F.col("kind"), F.lit(None))
            .unionAll(part(properties, PROPERTY, "owner_id", F.col("key"), F.lit(None)))
            .unionAll(part(edges, EDGE, "source_id", F.sort_array("relationships"), F.col("dest_id"))),
            "wiring",
        )
        total = rows.count()
        if total <= DEAL_ROWS:
            return None
        return cls(rows, total, cls._large(rows, unit), scope, unit)

    @staticmethod
    def _large(rows: DataFrame, unit: Sequence[str]) -> DataFrame | None:
        counter = F.pmod(F.xxhash64(*unit), F.lit(COUNTERS)).alias("_counter")
        counts = rows.groupBy(counter).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > UNIT_ROWS)
        full = [r["_counter"] for r in counts.select("_counter").collect()]
        if not full:
            return None
        units = rows.where(counter.isin(full)).groupBy(*unit).agg(F.count(F.lit(1)).alias("_n"))
        large = stored(units.where(F.col("_n") > UNIT_ROWS).select(*unit), "large")
        return large if large.take(1) else None

    def _tasks(self, work: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
        rows = self.rows
        if self.large is not None:
            rows = rows.join(*same_keys(rows, small(self.large), self.unit), "left_anti")
        own = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*self.scope, "id").schema.fields]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [b for b in batches if b.num_rows]
            if held:
                yield from work(pa.Table.from_batches(held)).to_batches(max_chunksize=10_000)

        return rows.repartition(max(1, ceil(self.total / TASK_ROWS)), *self.unit).mapInArrow(
            run, ", ".join([*own, schema])
        )

    def shapes(self) -> DataFrame:
        """(scope..., id, c1, c2): colours of the components of small units, equal in all tasks for equal ones."""
        scope = self.scope
        return self._tasks(lambda rows: _shapes(rows, scope), "c1 bigint, c2 bigint")

    def ordinals(self) -> DataFrame:
        """(scope..., id, ordinal, s1, s2, n) of small units; the first of a unit bears its signature."""
        scope, unit = self.scope, self.unit
        return self._tasks(lambda rows: _ordinals(rows, scope, unit), "ordinal bigint, s1 bigint, s2 bigint, n bigint")


# In tasks: two hashes per value are arrays of the form (2, n) ---------------------------------


_SEEDS = np.array([[0x9E3779B97F4A7C15], [0xC2B2AE3D27D4EB4F]], np.uint64)


def _mix(word: int, *parts: np.ndarray) -> np.ndarray:
    """Two hashes (2, n) of ``word`` and columns of the form (n,) or (2, n), in order."""
    mixed = _SEEDS * np.uint64(2 * word + 1)
    for part in parts:
        mixed = (mixed ^ part.astype(np.uint64, copy=False)) * np.uint64(0xFF51AFD7ED558CCD)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)
        mixed = mixed ^ (mixed >> np.uint64(29))
    return mixed


def _sums(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Sums (2, size) of ``values`` (2, n) by place."""
    out = np.zeros((2, size), np.uint64)
    if len(at):
        order = np.argsort(at, kind="stable")
        places = at[order]
        starts = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
        out[:, places[starts]] = np.add.reduceat(values[:, order], starts, axis=1)
    return out


def _codes(rows: pa.Table, names: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each distinct row of columns, and where one of them is null."""
    codes, missing = np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows, bool)
    for name in names:
        column = rows[name].combine_chunks()
        coded = pc.dictionary_encode(column, null_encoding="encode")
        mixed = codes * (len(coded.dictionary) + 1) + coded.indices.to_numpy(zero_copy_only=False)
        codes = np.unique(mixed, return_inverse=True)[1]
        missing |= pc.is_null(column).to_numpy(zero_copy_only=False)
    return codes, missing


class _Graph:
    """Rows of whole scopes as arrays: ``node`` of each component row, wires and keys between nodes.

    A node is an id of a scope; one that comes in several rows counts as often for its neighbours at first.
    """

    def __init__(self, rows: pa.Table, scope: Sequence[str]):
        what = rows["what"].to_numpy()
        cells = np.stack([rows[c].to_numpy() for c in ("a", "b")]).view(np.uint64)
        places, no_scope = _codes(rows, scope)
        ends = pa.table({"e": pa.chunked_array([*rows["id"].chunks, *rows["other"].chunks])})
        ids, no_id = _codes(ends, ["e"])
        self.ids = int(ids.max()) + 1
        half, known = rows.num_rows, what == COMPONENT
        near, far = (places * self.ids + part for part in (ids[:half], ids[half:]))
        self.component = np.flatnonzero(known)
        keys, self.node = np.unique(near[known], return_inverse=True)
        self.size = len(keys)
        self.unknown = (no_scope | no_id[:half])[known]
        self.id_code, self.cells = ids[:half][known], cells[:, known]
        self.by_node = np.argsort(self.node, kind="stable")
        self.start = np.searchsorted(self.node[self.by_node], np.arange(self.size + 1))

        def nodes(key: np.ndarray, missing: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(keys, key), self.size - 1)
            return np.where((keys[at] == key) & ~missing, at, -1)

        if not self.size:
            return
        edge, owned = what == EDGE, what == PROPERTY
        self.source = nodes(near[edge], (no_scope | no_id[:half])[edge])
        self.dest = nodes(far[edge], (no_scope | no_id[half:])[edge])
        self.far_id, self.near_id = ids[half:][edge], ids[:half][edge]
        self.label = cells[:, edge]
        self.edge_row, self.key_row = np.flatnonzero(edge), np.flatnonzero(owned)
        self.owner, self.key = nodes(near[owned], (no_scope | no_id[:half])[owned]), cells[:, owned]
        # both directions of the connections whose ends are known
        both = (self.source >= 0) & (self.dest >= 0)
        self.own = np.r_[self.dest[both], self.source[both]]
        self.other = np.r_[self.source[both], self.dest[both]]
        self.ways = np.concatenate([_mix(1, self.label[:, both]), _mix(2, self.label[:, both])], axis=1)

    def rows_of(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``nodes``, and component rows of the node there, once for each such row."""
        many = self.start[nodes + 1] - self.start[nodes]
        at = np.repeat(np.arange(len(nodes)), many)
        inside = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        return at, self.by_node[self.start[nodes[at]] + inside]

    def begin(self) -> np.ndarray:
        """Colours by kind, property keys and the rows of all neighbours."""
        owned = self.owner >= 0
        bags = _sums(_mix(3, self.key[:, owned]), self.owner[owned], self.size)
        own = _mix(4, self.cells, bags[:, self.node])
        last = np.lexsort((own[1], own[0], self.node))[self.start[1:] - 1]
        at, row = self.rows_of(self.other)
        seen = _sums(_mix(5, self.ways[:, at], own[:, row]), self.own[at], self.size)
        return _mix(6, own[:, last], seen)


class _Rounds:
    """Colours of nodes, recoloured by their neighbours as long as a group of nodes has more colours each time."""

    def __init__(self, colours: np.ndarray, own: np.ndarray, other: np.ndarray, ways: np.ndarray):
        order = np.argsort(own, kind="stable")
        self.colours, self.own, self.other, self.ways = colours, own[order], other[order], ways[:, order]

    @staticmethod
    def firsts(colours: np.ndarray, group: np.ndarray) -> np.ndarray:
        """One node of each colour of a group."""
        order = np.lexsort((colours[0], group))
        c, g = colours[0][order], group[order]
        return order[np.r_[True, (c[1:] != c[:-1]) | (g[1:] != g[:-1])]] if len(order) else order

    def run(self, group: np.ndarray, settled: Callable | None = None) -> None:
        """Until no group has more colours than before. ``group``: of each node, or -1 to leave it out.

        ``settled(nodes, groups, before, after, firsts)`` is told the nodes that have their last colours.
        """
        at = np.flatnonzero(group >= 0)
        groups = group.max(initial=-1) + 1
        place = np.full(len(group), -1)
        place[at] = np.arange(len(at))
        inside = place[self.own] >= 0
        own, other, ways = place[self.own[inside]], place[self.other[inside]], self.ways[:, inside]
        before, group = self.colours[:, at], group[at]
        count = np.bincount(group[self.firsts(before, group)], minlength=groups)
        while len(at):
            seen = np.zeros_like(before)
            if len(own):
                starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                seen[:, own[starts]] = np.add.reduceat(_mix(5, ways, before[:, other]), starts, axis=1)
            after = _mix(6, before, seen)
            firsts = self.firsts(after, group)
            now = np.bincount(group[firsts], minlength=groups)
            grows = (now > count)[group]
            done = ~grows
            self.colours[:, at[done]] = after[:, done]
            if settled:
                settled(at[done], group[done], before[:, done], after[:, done], np.flatnonzero(np.isin(np.flatnonzero(done), firsts)))
            # what goes on is numbered anew
            place = np.cumsum(grows) - 1
            stays = grows[own]
            own, other, ways = place[own[stays]], place[other[stays]], ways[:, stays]
            at, group, before, count = at[grows], group[grows], after[:, grows], now


def _connected(size: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Number from 0 of the connected part of each node."""
    part = np.arange(size)
    while True:
        low = np.minimum(part[one], part[two])
        new = part.copy()
        for at in (one, two, part[one], part[two]):
            np.minimum.at(new, at, low)
        while (new[new] != new).any():
            new = new[new]
        if (new == part).all():
            return np.unique(part, return_inverse=True)[1]
        part = new


def _table(rows: pa.Table, names: Sequence[str], at: np.ndarray, added: dict[str, pa.Array]) -> pa.Table:
    picked = rows.select(list(names)).take(pa.array(at))
    for name, values in added.items():
        picked = picked.append_column(name, values)
    return picked


def _shapes(rows: pa.Table, scope: Sequence[str]) -> pa.Table:
    """Shapes that do not depend on the task: a connected part is refined until it is stable by itself.

    The colours before and after its last round say how its classes are wired to each other, so parts with the same
    set of them have the same classes, whatever else is in their scopes.
    """
    graph = _Graph(rows, scope)
    shape = np.zeros((2, graph.size), np.uint64)

    def settled(nodes, part, before, after, firsts):
        parts, part = np.unique(part, return_inverse=True)
        wired = _sums(_mix(7, before[:, firsts], after[:, firsts]), part[firsts], len(parts))
        shape[:, nodes] = _mix(8, after, wired[:, part])

    if graph.size:
        part = _connected(graph.size, graph.own, graph.other)
        _Rounds(graph.begin(), graph.own, graph.other, graph.ways).run(part, settled)
    first = graph.component[graph.by_node[graph.start[:-1]]]
    one, two = (pa.array(c.view(np.int64)) for c in shape)
    return _table(rows, [*scope, "id"], first, {"c1": one, "c2": two})


def _ordinals(rows: pa.Table, scope: Sequence[str], unit: Sequence[str]) -> pa.Table:
    """Places of components in their unit, and its signature: as :func:`compare.component_ordinals` has them."""
    graph = _Graph(rows, scope)
    where = np.zeros(0, np.int64)
    if graph.size:
        where = _codes(rows, unit)[0]
    unit_of = where[graph.component[graph.by_node[graph.start[:-1]]]] if graph.size else where
    # ids that are null, or in no scope, have no place
    known = ~graph.unknown
    alive = np.zeros(graph.size, bool)
    alive[graph.node[known]] = True
    ids = pa.chunked_array([rows["id"].take(pa.array(graph.component)).combine_chunks()])
    rank = pc.rank(ids, tiebreaker="dense").to_numpy().astype(np.int64) if len(ids) else np.zeros(0, np.int64)
    rank_of = np.zeros(graph.size, np.int64)
    rank_of[graph.node] = rank
    if graph.size:
        # the very connections of each node, by the ids at their other ends
        exact = np.zeros((2, graph.size), np.uint64)
        for way, own, ids_there in ((1, graph.dest, graph.near_id), (2, graph.source, graph.far_id)):
            has = own >= 0
            exact += _sums(_mix(9, _mix(way, graph.label[:, has]), ids_there[has]), own[has], graph.size)
        rounds = _Rounds(graph.begin(), graph.own, graph.other, graph.ways)
        group = np.where(alive, unit_of, -1)
        while (group >= 0).any():
            rounds.run(group)
            colours = rounds.colours
            order = np.lexsort((rank_of, colours[1], colours[0], group))
            order = order[group[order] >= 0]
            c, g, e = colours[:, order], group[order], exact[:, order]
            same = np.r_[False, (g[1:] == g[:-1]) & (c[:, 1:] == c[:, :-1]).all(axis=0)]
            begins = np.flatnonzero(~same)
            unlike = np.r_[False, (e[:, 1:] != e[:, :-1]).any(axis=0)] & same
            tied = begins[np.logical_or.reduceat(unlike, begins)] if len(begins) else begins
            # of the first tied class of each unit, the smallest id is singled out
            picked = tied[np.r_[True, g[tied][1:] != g[tied][:-1]]] if len(tied) else tied
            nodes = order[picked]
            colours[:, nodes] = _mix(10, colours[:, nodes])
            group = np.where(np.isin(group, g[picked]), group, -1)
    else:
        rounds = None
    live = np.flatnonzero(known)
    colours = rounds.colours[:, graph.node[live]] if rounds else np.zeros((2, 0), np.uint64)
    mine = where[graph.component[live]]
    order = np.lexsort((rank[live], colours[1], colours[0], mine))
    live, mine = live[order], mine[order]
    begins = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]]) if len(mine) else mine
    place = np.arange(len(live)) - np.repeat(begins, np.diff(np.r_[begins, len(live)])) + 1
    ordinal = np.zeros(len(graph.component), np.int64)
    ordinal[live] = place
    units = where.max(initial=-1) + 1
    total, count = np.zeros((2, units), np.uint64), np.zeros(units, np.int64)

    def add(hashes, at):
        total[:] = total + _sums(hashes, at, units)
        count[:] = count + np.bincount(at, minlength=units)

    if graph.size:
        add(_mix(11, ordinal[live], graph.cells[:, live]), mine)
        owned = np.flatnonzero(graph.owner >= 0)
        at, row = graph.rows_of(graph.owner[owned])
        at = owned[at]
        add(_mix(12, ordinal[row], graph.key[:, at]), where[graph.key_row[at]])
        led = np.flatnonzero(graph.source >= 0)
        at, row = graph.rows_of(graph.source[led])
        at, begin = led[at], ordinal[row]
        ends = np.flatnonzero(graph.dest[at] >= 0)
        lost = np.flatnonzero(graph.dest[at] < 0)
        again, row = graph.rows_of(graph.dest[at][ends])
        to = np.r_[ordinal[row], np.zeros(len(lost), np.int64)]
        pick = np.r_[ends[again], lost]
        add(_mix(13, begin[pick], to, graph.label[:, at[pick]]), where[graph.edge_row[at[pick]]])
    first = place == 1
    signature = {
        name: pa.array(values[mine], mask=~first)
        for name, values in (("s1", total[0].view(np.int64)), ("s2", total[1].view(np.int64)), ("n", count))
    }
    return _table(rows, [*scope, "id"], graph.component[live], {"ordinal": pa.array(place), **signature})
