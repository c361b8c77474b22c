"""Snapshots compared and merged, and groups of the same structure found."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.operators.spread import BROADCAST_ROWS, lookup, numbered, same_keys, small
from flowtables.operators.wiring import Wiring
from flowtables.session import scratch_path, stored


def _side_by_side(
    snapshots: dict[str, DataFrame], keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """One row per key with each snapshot's columns as a struct (null if absent) and its count.

    A union merged map-side instead of an outer join: one exchange, and a key repeated by mistake
    is folded before it travels and can neither multiply rows nor fill one task. Columns must be
    orderable (no maps).
    """
    tagged = None
    for name, df in snapshots.items():
        # a column that only another snapshot has is null here
        kinds = {f.name: f.dataType for other in snapshots.values() for f in other.schema.fields}
        row = [
            (F.col(c) if c in df.columns else F.lit(None).cast(kinds[c])).alias(c) for c in columns
        ]
        part = df.select(*keys, F.struct(*row).alias("_row"), F.lit(name).alias("_from"))
        tagged = part if tagged is None else tagged.unionByName(part)
    aggregates = []
    for name in snapshots:
        mine = F.col("_from") == name
        aggregates.append(F.max(F.when(mine, F.col("_row"))).alias(name))
        aggregates.append(F.count(F.when(mine, F.lit(1))).alias("_n_" + name))
    return tagged.groupBy(*keys).agg(*aggregates)


def _all_columns(snapshots: Sequence[DataFrame], keys: Sequence[str]) -> list[str]:
    """Columns of any snapshot, those of the first one first."""
    return [c for c in dict.fromkeys(c for df in snapshots for c in df.columns) if c not in keys]


def _names(columns: Sequence[str], test) -> Column:
    return F.array_compact(F.array(*[F.when(test(c), F.lit(c)) for c in columns]))


def differing(before: DataFrame, after: DataFrame, within: Sequence[str]) -> DataFrame:
    """Values of ``within`` whose rows are not the same bag in both snapshots.

    Rows are folded to sums of two hashes before they travel, positive for one snapshot and negative for the
    other, which cancel out where nothing has changed.
    """
    columns = _all_columns([before, after], within)
    signed = None
    for sign, df in ((1, before), (-1, after)):
        # a null says as much as a column that the snapshot does not have
        cells = [
            F.when(F.col(c).isNotNull(), F.struct(F.lit(c), F.col(c))) for c in columns if c in df.columns
        ]
        hashes = [
            (F.xxhash64(F.lit(seed), *cells).cast("decimal(20,0)") * sign).alias(name)
            for seed, name in (("1", "_h1"), ("2", "_h2"))
        ]
        part = df.select(*within, *hashes, F.lit(sign).cast("bigint").alias("_n"))
        signed = part if signed is None else signed.unionByName(part)
    sums = signed.groupBy(*within).agg(*[F.sum(c).alias(c) for c in ("_h1", "_h2", "_n")])
    return sums.where("_h1 <> 0 or _h2 <> 0 or _n <> 0").select(*within)


def diff_snapshots(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    within: Sequence[str] | None = None,
) -> DataFrame:
    """Changed keys: (keys..., change, changed_columns, before, after).

    ``change`` is ``added``, ``removed``, ``changed``, or ``duplicate`` where a snapshot holds the
    key more than once; columns are compared null-safely.

    With ``within``, some of the keys (a template's, say), only the rows of those that :func:`differing` finds
    are compared by key; rows of the others stay where they are. A key repeated alike in both snapshots is then
    no change and is not reported.
    """
    columns = _all_columns([before, after], keys)
    if within:
        changed = small(stored(differing(before, after, within), "differing"))
        before, after = (_inside(df, changed, within) for df in (before, after))
    pairs = _side_by_side({"before": before, "after": after}, keys, columns)
    differs = lambda c: ~F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}"))
    change = (
        F.when((F.col("_n_before") > 1) | (F.col("_n_after") > 1), "duplicate")
        .when(F.col("_n_before") == 0, "added")
        .when(F.col("_n_after") == 0, "removed")
        .when(~F.col("before").eqNullSafe(F.col("after")), "changed")
    )
    both = (F.col("_n_before") > 0) & (F.col("_n_after") > 0)
    return (
        pairs.withColumn("change", change)
        .where(F.col("change").isNotNull())
        .select(
            *keys,
            "change",
            F.when(both, _names(columns, differs)).alias("changed_columns"),
            "before",
            "after",
        )
    )


def _inside(df: DataFrame, chosen: DataFrame, within: Sequence[str]) -> DataFrame:
    names = {c: f"_of_{c}" for c in within}
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(F.col(n)) for c, n in names.items()])
    return df.join(chosen.withColumnsRenamed(names), same, "left_semi")


def merge_snapshots(
    base: DataFrame, ours: DataFrame, theirs: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Three-way merge: (keys..., status, present, columns..., conflicts, base, ours, theirs).

    ``status``: ``unchanged``; ``ours`` / ``theirs`` (one side changed, added or removed the row);
    ``same`` (both alike); ``merged`` (different columns of one row); ``conflict`` (``conflicts``
    names the columns, which are null in the result); ``duplicate``. ``present`` tells whether the
    row is in the result; null if undecided.
    """
    columns = _all_columns([base, ours, theirs], keys)
    rows = _side_by_side({"base": base, "ours": ours, "theirs": theirs}, keys, columns)
    b, o, t = F.col("base"), F.col("ours"), F.col("theirs")
    here = {n: F.col("_n_" + n) > 0 for n in ("base", "ours", "theirs")}
    all_present = here["base"] & here["ours"] & here["theirs"]
    clash = lambda c: (
        ~o[c].eqNullSafe(b[c]) & ~t[c].eqNullSafe(b[c]) & ~o[c].eqNullSafe(t[c])
    )
    rows = rows.withColumn(
        "_clashes",
        F.when(all_present, _names(columns, clash)).otherwise(
            F.array(*[F.lit(c) for c in columns])
        ),
    )
    repeated = (F.col("_n_base") > 1) | (F.col("_n_ours") > 1) | (F.col("_n_theirs") > 1)
    status = (
        F.when(repeated, "duplicate")
        .when(o.eqNullSafe(b) & t.eqNullSafe(b), "unchanged")
        .when(t.eqNullSafe(b), "ours")
        .when(o.eqNullSafe(b), "theirs")
        .when(o.eqNullSafe(t), "same")
        .when(all_present & (F.size("_clashes") == 0), "merged")
        .otherwise("conflict")
    )
    rows = rows.withColumn("status", status)
    decided = F.col("status")
    present = (
        F.when(decided == "duplicate", None)
        .when(decided.isin("ours", "same"), here["ours"])
        .when(decided == "theirs", here["theirs"])
        .when(decided == "conflict", F.when(all_present, F.lit(True)))
        .otherwise(F.lit(True))
    )

    def result(c: str) -> Column:
        by_column = F.when(o[c].eqNullSafe(b[c]), t[c]).when(
            t[c].eqNullSafe(b[c]) | o[c].eqNullSafe(t[c]), o[c]
        )
        return (
            F.when(decided.isin("unchanged", "ours", "same"), o[c])
            .when(decided == "theirs", t[c])
            .when(all_present & (decided != "duplicate"), by_column)
        )

    conflicts = F.when(decided.isin("conflict"), F.col("_clashes")).otherwise(
        F.array().cast("array<string>")
    )
    return rows.select(
        *keys,
        "status",
        present.alias("present"),
        *[result(c).alias(c) for c in columns],
        conflicts.alias("conflicts"),
        "base",
        "ours",
        "theirs",
    )


# Structure ------------------------------------------------------------------------------------


def _multiset(*shape: Column) -> list[Column]:
    """Order-free fingerprint of a bag of rows: two sums of 64-bit hashes, and the size.

    Sums are folded map-side, so a member with very many elements is never collected.
    """
    one = F.sum(F.xxhash64(F.lit("1"), *shape).cast("decimal(20,0)"))
    two = F.sum(F.xxhash64(F.lit("2"), *shape).cast("decimal(20,0)"))
    return [one.alias("_h1"), two.alias("_h2"), F.count(F.lit(1)).alias("_n")]


def structural_signatures(
    elements: DataFrame, member: Sequence[str], shape: Sequence[str]
) -> DataFrame:
    """(member..., signature): equal for members with the same bag of ``shape`` values."""
    folded = elements.groupBy(*member).agg(*_multiset(*[F.col(c) for c in shape]))
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in ("_h1", "_h2", "_n")])
    return folded.select(*member, F.sha2(text, 256).alias("signature"))


def structural_groups(signatures: DataFrame, member: str, at_least: int = 2) -> DataFrame:
    """(signature, members, first_member) of signatures several members share."""
    return (
        signatures.groupBy("signature")
        .agg(F.count(F.lit(1)).alias("members"), F.min(member).alias("first_member"))
        .where(F.col("members") >= at_least)
    )


class _Colouring:
    """Colours of components, kept as one table of changes by round in the shared folder.

    Equal colours mean that no round has told components apart yet. A round only reads the surroundings of the
    components whose class was split in the round before, and writes only those whose colour changes: what is not
    touched in a split class, or else its largest part, keeps its colour.
    """

    def __init__(self, scope: Sequence[str], edges: DataFrame, start: DataFrame):
        """``start``: scope..., id, c1, c2."""
        self.spark, self.own = start.sparkSession, [*scope, "id"]
        self.round, self.rows = 0, []
        label = F.sort_array("relationships")
        one, two = F.col("source_id"), F.col("dest_id")

        def ends(at: Column, other: Column, way: str) -> DataFrame:
            return edges.select(
                *scope,
                at.alias("id"),
                other.alias("other"),
                F.xxhash64(F.lit(way), label).alias("label"),
            )

        self.wires = stored(ends(two, one, "in").unionAll(ends(one, two, "out")), "wires")
        self.path = scratch_path(self.spark, "colours")
        self.sizes_path = scratch_path(self.spark, "classes")
        self.kind = start.withColumn("round", F.lit(0)).schema
        self._write(start)
        sizes = start.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("size"))
        sizes.withColumn("round", F.lit(0)).write.parquet(self.sizes_path)
        self.sizes_kind = self.spark.read.parquet(self.sizes_path).schema

    def _write(self, changes: DataFrame) -> DataFrame:
        folder = f"{self.path}/{self.round}"
        named = changes.select(*self.own, "c1", "c2").withColumn("round", F.lit(self.round))
        named.write.parquet(folder)
        written = self.spark.read.schema(self.kind).parquet(folder).drop("round")
        self.rows.append(written.count())
        return written

    def history(self) -> DataFrame:
        read = self.spark.read.schema(self.kind).option("recursiveFileLookup", "true")
        return read.parquet(self.path)

    def now(self) -> DataFrame:
        """(scope..., id, c1, c2): the last colour of every component."""
        return self.history().groupBy(*self.own).agg(*self._last())

    @staticmethod
    def _last() -> list[Column]:
        return [F.max_by(c, "round").alias(c) for c in ("c1", "c2")]

    def _sizes(self, classes: DataFrame) -> DataFrame:
        known = self.spark.read.schema(self.sizes_kind).parquet(self.sizes_path)
        return (
            known.join(classes.select("c1", "c2"), ["c1", "c2"], "left_semi")
            .groupBy("c1", "c2")
            .agg(F.max_by("size", "round").alias("size"))
        )

    def split(self, told: DataFrame) -> DataFrame | None:
        """Take new colours (own..., c1, c2, d1, d2) of whole parts of classes; the components that change.

        A class all of whose components get one and the same new colour is not split and keeps its own.
        """
        self.round += 1
        parts = stored(
            told.groupBy("c1", "c2", "d1", "d2").agg(F.count(F.lit(1)).alias("n")), "parts"
        )
        # the largest part keeps the colour if no untouched component does
        touched = parts.groupBy("c1", "c2").agg(
            F.sum("n").alias("touched"),
            F.count(F.lit(1)).alias("k"),
            F.max_by(F.struct("d1", "d2", "n"), "n").alias("largest"),
        )
        rest = F.col("size") - F.col("touched")
        keeper = F.when(rest == 0, F.col("largest"))
        classes = stored(
            touched.join(self._sizes(touched), ["c1", "c2"])
            .where((F.col("k") > 1) | (rest > 0))
            .select("c1", "c2", rest.alias("rest"), keeper.alias("keeper")),
            "split",
        )
        if not classes.take(1):
            return None
        stays = F.col("keeper.d1").eqNullSafe(F.col("d1")) & F.col("keeper.d2").eqNullSafe(F.col("d2"))
        made = [F.col("d1").alias("c1"), F.col("d2").alias("c2")]
        changed = self._write(
            told.join(classes, ["c1", "c2"]).where(~stays).select(*self.own, *made)
        )
        fresh = parts.join(classes, ["c1", "c2"]).where(~stays).select(*made, F.col("n").alias("size"))
        left = classes.select(
            "c1", "c2", F.when(F.col("rest") > 0, F.col("rest")).otherwise(F.col("keeper.n"))
        )
        fresh.unionAll(left).withColumn("round", F.lit(self.round)).write.mode("append").parquet(
            self.sizes_path
        )
        return changed

    def refine(self, frontier: DataFrame | None) -> None:
        """Recolour what is around changed components until no class is split any more."""
        scope = self.own[:-1]
        while frontier is not None:
            if self.rows[-1] <= BROADCAST_ROWS:
                frontier = F.broadcast(frontier)
            seen = self.wires.join(frontier.withColumnRenamed("id", "other"), [*scope, "other"])
            around = seen.groupBy(*self.own).agg(
                *_multiset(F.col("label"), F.col("c1"), F.col("c2"))
            )
            bag = ["_h1", "_h2", "_n"]
            known = (
                self.history()
                .join(around, self.own)
                .groupBy(*self.own, *bag)
                .agg(*self._last())
            )
            step = F.lit(self.round + 1)
            mixed = [
                F.xxhash64(F.lit(seed), step, "c1", "c2", *bag).alias(name)
                for seed, name in (("1", "d1"), ("2", "d2"))
            ]
            frontier = self.split(stored(known.select(*self.own, "c1", "c2", *mixed), "told"))


def _coloured(
    components: DataFrame, properties: DataFrame, edges: DataFrame, scope: Sequence[str]
) -> _Colouring:
    """Components coloured by kind and property keys, then refined."""
    scope = list(scope)
    own, bag = [*scope, "id"], ["_h1", "_h2", "_n"]
    keys = properties.groupBy(*scope, F.col("owner_id").alias("id")).agg(*_multiset(F.col("key")))
    first = [
        F.xxhash64(F.lit(seed), "kind", *bag).alias(name) for seed, name in (("1", "c1"), ("2", "c2"))
    ]
    start = stored(
        lookup(components, keys, [F.col(c) for c in own], own, bag).select(*own, *first), "start"
    )
    colouring = _Colouring(scope, edges, start)
    colouring.refine(start)
    return colouring


class _Folded:
    """Scopes with the very same content, ids included, stood for by one of them.

    What refinement tells apart depends on a scope's content alone, so it need only see every content once.
    ``units`` holds (scope..., _content) of all scopes. Without copies to fold, or where a unit (scope, or
    member) is not exactly one scope, :meth:`of` returns None.
    """

    def __init__(self, units: DataFrame, firsts: DataFrame, scope: Sequence[str], unit: Sequence[str]):
        self.units, self.firsts, self.scope, self.unit = units, firsts, list(scope), list(unit)

    @classmethod
    def of(
        cls,
        components: DataFrame,
        properties: DataFrame,
        edges: DataFrame,
        scope: Sequence[str],
        unit: Sequence[str],
    ) -> _Folded | None:
        if not unit or not set(unit) <= set(scope) or "_content" in scope:
            return None

        def part(df: DataFrame, name: str, *cells: Column) -> DataFrame:
            # hashes leave nulls out, so their places are told as well
            told = [x for c in cells for x in (c.isNull(), c)]
            hashes = [F.xxhash64(F.lit(seed), F.lit(name), *told).alias(seed) for seed in ("_p1", "_p2")]
            return df.select(*scope, *hashes)

        parts = (
            part(components, "component", F.col("id"), F.col("kind"))
            .unionAll(part(properties, "property", F.col("owner_id"), F.col("key")))
            .unionAll(
                part(
                    edges,
                    "edge",
                    F.col("source_id"),
                    F.col("dest_id"),
                    F.sort_array("relationships"),
                )
            )
        )
        rest = [c for c in scope if c not in unit]
        ends = [f(c).alias(n + c) for c in rest for f, n in ((F.min, "_low_"), (F.max, "_high_"))]
        ends += [F.count(c).alias("_filled_" + c) for c in rest]
        single = F.lit(True)
        for c in unit:
            single = single & F.col(c).isNotNull()
        for c in rest:
            single = single & (F.col("_low_" + c) == F.col("_high_" + c)) & (F.col("_filled_" + c) == F.col("_n"))
        units = stored(
            parts.groupBy(*unit)
            .agg(*_multiset(F.col("_p1"), F.col("_p2")), *ends)
            .select(
                *[F.col(c if c in unit else "_low_" + c).alias(c) for c in scope],
                F.concat_ws("|", *[F.col(c).cast("string") for c in ("_h1", "_h2", "_n")]).alias("_content"),
                F.coalesce(single, F.lit(False)).alias("_single"),
            ),
            "units",
        )
        if units.where("not _single").take(1):
            return None
        firsts = stored(
            units.groupBy("_content")
            .agg(F.min(F.struct(*unit)).alias("_first"))
            .select("_content", "_first.*"),
            "contents",
        )
        if 2 * firsts.count() > units.count():
            return None
        return cls(units.drop("_single"), firsts, scope, unit)

    def once(self, df: DataFrame) -> DataFrame:
        """Rows of the scopes that stand for a content, with ``_content`` for the columns of the scope."""
        return df.join(small(self.firsts), self.unit).drop(*self.scope)

    def all(self, found: DataFrame) -> DataFrame:
        """Rows found by ``_content`` for every scope that has it."""
        return self.units.join(found, "_content").drop("_content")


def component_shapes(
    components: DataFrame, properties: DataFrame, edges: DataFrame, scope: Sequence[str] = ()
) -> DataFrame:
    """(scope..., id, shape) of components, independent of ids and order.

    Starts from the kind and the property keys, then mixes in the shapes at the other ends of connections
    until no round tells more components apart (colour refinement), so the whole wiring counts but names do
    not. A shape is two 64-bit hashes, to be compared within one call. Scopes that fit into a task are refined
    there (:mod:`flowtables.operators.wiring`); larger ones, and tables of few rows, in rounds over all of them:
    a round works on the neighbours of what the last round told apart, and scopes that are copies of each other
    are refined once.
    ``components``: scope..., id, kind. ``properties``: scope..., owner_id, key. ``edges``: scope..., source_id,
    dest_id, relationships. Ids are unique within ``scope`` (workspace, template).
    """
    scope = list(scope)
    wiring = Wiring.of(components, properties, edges, scope, scope)
    if wiring is None:
        return _shapes_by_rounds(components, properties, edges, scope)
    shapes = wiring.shapes()
    if wiring.large is None:
        return shapes.select(*scope, "id", _as_text("c1", "c2").alias("shape"))
    # large scopes are refined together with one small scope of each structure, whose shapes stand for those of tasks
    shapes = stored(shapes, "shapes")
    structures = structural_signatures(shapes, scope, ["c1", "c2"])
    stand_ins = structures.groupBy("signature").agg(F.min(F.struct(*scope)).alias("_first")).select("_first.*")
    chosen = small(stored(wiring.large.unionAll(stand_ins), "chosen"))
    found = stored(
        _shapes_by_rounds(*[_inside(df, chosen, scope) for df in (components, properties, edges)], scope), "found"
    )
    own, task = [*scope, "id"], ["c1", "c2"]
    theirs, match = same_keys(shapes, found, own)
    known = shapes.join(theirs, match).groupBy(*task).agg(F.min("shape").alias("shape"))
    others = lookup(shapes, known, [F.col(c) for c in task], task, ["shape"]).select(*own, "shape")
    return _inside(found, small(wiring.large), scope).select(*own, "shape").unionAll(others)


def _as_text(*columns: str) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def _shapes_by_rounds(
    components: DataFrame, properties: DataFrame, edges: DataFrame, scope: Sequence[str]
) -> DataFrame:
    folded = _Folded.of(components, properties, edges, scope, scope)
    if folded:
        once = [folded.once(df) for df in (components, properties, edges)]
        return folded.all(_shapes_by_rounds(*once, ["_content"])).select(*scope, "id", "shape")
    shapes = _coloured(components, properties, edges, scope).now()
    return shapes.select(*scope, "id", _as_text("c1", "c2").alias("shape"))


def component_ordinals(
    components: DataFrame,
    properties: DataFrame,
    edges: DataFrame,
    member: str,
    scope: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Places of components that are the same in every member of one structure.

    Returns (scope..., id, ``member``, ordinal), numbered from 1 in each member, and (``member``, signature).
    ``components`` also has the column ``member``, to which a whole structure belongs; the other tables are as for
    :func:`component_shapes`.

    Components are numbered by shape. Of components of one member with one shape, those with the very same
    connections are interchangeable; of others one is singled out at a time and the rest refined again. Two
    members have one signature only if their numbering maps kinds, property keys and connections onto each
    other, so look-alikes that refinement cannot tell apart are kept apart. Members that are the same
    but have ambiguous places may get different signatures, never the other way round. Where ``member`` is one
    of the ``scope`` columns, members that fit into a task are numbered there; of larger ones, and in tables of few
    rows, members that are copies of each other are numbered once.
    """
    scope = list(scope)
    wiring = Wiring.of(components, properties, edges, scope, [member])
    if wiring is None:
        return _ordinals_by_rounds(components, properties, edges, member, scope)
    own = [*scope, "id"]
    placed = stored(wiring.ordinals(), "places")
    places = placed.select(*own, "ordinal")
    signatures = placed.where("ordinal = 1").select(member, F.sha2(_as_text("s1", "s2", "n"), 256).alias("signature"))
    if wiring.large is None:
        return places, signatures
    # members that are the same are of one size, so none is on both sides
    large = small(wiring.large)
    more, theirs = _ordinals_by_rounds(
        *[_inside(df, large, [member]) for df in (components, properties, edges)], member, scope
    )
    return places.unionAll(more.select(*own, "ordinal")), signatures.unionAll(theirs)


def _ordinals_by_rounds(
    components: DataFrame, properties: DataFrame, edges: DataFrame, member: str, scope: list[str]
) -> tuple[DataFrame, DataFrame]:
    folded = _Folded.of(components, properties, edges, scope, [member])
    if folded:
        once = [folded.once(df) for df in (components, properties, edges)]
        places, signatures = _ordinals_by_rounds(*once, "_content", ["_content"])
        return (
            folded.all(stored(places, "places")).select(*scope, "id", "ordinal"),
            folded.all(signatures).select(member, "signature"),
        )
    own = [*scope, "id"]
    mine = own if member in own else [*own, member]
    taken = [c for c in (member, "ordinal") if c not in own]
    colouring = _coloured(components, properties, edges, scope)
    exact = colouring.wires.groupBy(*own).agg(
        *[c.alias(n) for c, n in zip(_multiset(F.col("label"), F.col("other")), ("e1", "e2", "e3"))]
    )
    placed = stored(
        lookup(components, exact, [F.col(c) for c in own], own, ["e1", "e2", "e3"]), "members"
    )
    while True:
        now = stored(placed.join(colouring.now(), own), "coloured")
        alike = F.xxhash64("e1", "e2", "e3")
        ties = (
            now.groupBy(member, "c1", "c2")
            .agg(F.count(F.lit(1)).alias("k"), F.min(alike).alias("a"), F.max(alike).alias("b"), F.min("id").alias("id"))
            .where("k > 1 and a <> b")
        )
        first = stored(
            ties.groupBy(member).agg(F.min_by("id", F.struct("c1", "c2")).alias("id")), "picked"
        )
        if not first.take(1):
            break
        step = F.lit(colouring.round + 1)
        picked = now.join(first, [member, "id"]).select(
            *own,
            "c1",
            "c2",
            *[F.xxhash64(F.lit(seed), step, "c1", "c2").alias(d) for seed, d in (("one", "d1"), ("two", "d2"))],
        )
        colouring.refine(colouring.split(stored(picked, "told")))
    ordinals = stored(
        numbered(now.select(*mine, "kind", "c1", "c2"), [member], ["c1", "c2", "id"], "ordinal"),
        "ordinals",
    )
    places = ordinals.select(*own, "ordinal")
    keys = lookup(
        properties.select(*scope, "owner_id", "key"),
        ordinals.select(*mine, "ordinal"),
        [*[F.col(c) for c in scope], F.col("owner_id")],
        own,
        taken,
    ).where(F.col("ordinal").isNotNull())
    ends = edges.select(*scope, "source_id", "dest_id", F.sort_array("relationships").alias("rels"))
    at = [F.col(c) for c in scope]
    ends = lookup(
        ends, ordinals.select(*mine, "ordinal"), [*at, F.col("source_id")], own, taken
    ).withColumnRenamed("ordinal", "_from")
    ends = lookup(ends, places, [*at, F.col("dest_id")], own, ["ordinal"])
    parts = (
        ordinals.select(member, F.xxhash64(F.lit("kind"), "ordinal", "kind").alias("part"))
        .unionAll(keys.select(member, F.xxhash64(F.lit("key"), "ordinal", "key")))
        .unionAll(
            ends.where(F.col("_from").isNotNull()).select(
                member, F.xxhash64(F.lit("edge"), "_from", "ordinal", "rels")
            )
        )
    )
    return ordinals.select(*mine, "ordinal"), structural_signatures(parts, [member], ["part"])


def structural_template(
    values: DataFrame, signatures: DataFrame, groups: DataFrame, member: str
) -> tuple[DataFrame, DataFrame]:
    """Shared settings and variables of structural groups.

    ``values``: member, slot, value, where ``slot`` names the same place in every member. Returns
    (signature, slot, varies, value) with the constant value, and (signature, member, slot, value)
    of the slots that vary.
    """
    grouped = signatures.join(groups.select("signature"), "signature", "left_semi")
    placed = lookup(values, grouped, [F.col(member)], [member], ["signature"]).where(
        F.col("signature").isNotNull()
    )
    sizes = groups.select("signature", "members")
    slots = placed.groupBy("signature", "slot").agg(
        F.min("value").alias("_low"),
        F.max("value").alias("_high"),
        F.count("value").alias("_filled"),
    )
    # a slot some members leave out, or leave null, varies as well
    varies = (F.col("_filled") > 0) & (
        (F.col("_low") != F.col("_high")) | (F.col("_filled") < F.col("members"))
    )
    slots = slots.join(sizes, "signature").select(
        "signature",
        "slot",
        varies.alias("varies"),
        F.when(~varies, F.col("_low")).alias("value"),
    )
    varying = slots.where("varies").select("signature", "slot", F.lit(True).alias("_varies"))
    variables = lookup(
        placed,
        varying,
        [F.col("signature"), F.col("slot")],
        ["signature", "slot"],
        ["_varies"],
    ).where("_varies")
    return slots, variables.select("signature", member, "slot", "value")
