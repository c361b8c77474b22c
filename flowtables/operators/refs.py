"""References and connections: rewrite ids, resolve names, build, check and list connections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.functions.values import endpoint_kind, is_group
from flowtables.operators.naming import last_by
from flowtables.operators.spread import (
    HOT_ROWS,
    PAGE_ROWS,
    hot_keys,
    lookup,
    paged_lists,
    same_keys,
    small,
)
from flowtables.session import stored

# Ports of a group that are kept as a list beside its component; more are sought in a table of their own.
LISTED_PORTS = 64


def attach_inputs(
    components: DataFrame,
    edges: DataFrame,
    component_key: Sequence[str],
    edge_key: Sequence[str],
    order: Sequence[str],
    item: Column,
    page_rows: int = PAGE_ROWS,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Components with the ordered list of their incoming edges (``page``, ``inputs``).

    A component without edges has one row with an empty list; one with more than ``page_rows``
    edges has several rows, so a hot destination never becomes one huge list.
    """
    lists = paged_lists(edges, edge_key, order, item, "inputs", page_rows, hot_rows)
    empty = F.array().cast(lists.schema["inputs"].dataType)
    nothing = {"page": F.lit(0).cast("bigint"), "inputs": empty}
    return _with_partners(components, edges, lists, component_key, edge_key, nothing)


def flat_inputs(
    components: DataFrame, edges: DataFrame, component_key: Sequence[str], edge_key: Sequence[str]
) -> DataFrame:
    """Flat form of :func:`attach_inputs`: one row per component and edge, nulls without edges."""
    nothing = {
        f.name: F.lit(None).cast(f.dataType) for f in edges.schema.fields if f.name not in edge_key
    }
    return _with_partners(components, edges, edges, component_key, edge_key, nothing)


def _with_partners(components, edges, many, component_key, edge_key, nothing):
    """Left join from ``components`` to ``many`` as an inner join plus the rows left over.

    A left join cannot split its right side, which is the one a hot destination makes large; an
    inner join can, and the rest needs only the distinct destinations.
    """
    key, renames = list(component_key), dict(zip(edge_key, component_key))
    found = components.join(many.withColumnsRenamed(renames), key)
    ends = edges.select(*edge_key).distinct().withColumnsRenamed(renames)
    alone = components.join(ends, key, "left_anti").withColumns(nothing)
    return found.unionByName(alone)


def latest_ids(
    id_map: DataFrame,
    old: str = "old_id",
    new: str = "new_id",
    ord_column: str = "ord",
    scope: Sequence[str] = (),
) -> DataFrame:
    """Id map with one row per old id (of a ``scope``): the last one tracked wins."""
    known = id_map.where(F.col(old).isNotNull())
    return last_by(known, [*scope, old], ord_column, [new]).select(*scope, old, new)


def remap_ids(
    df: DataFrame,
    id_map: DataFrame,
    columns: Sequence[str],
    old: str = "old_id",
    new: str = "new_id",
    missing: str = "keep",
    scope: Sequence[str] = (),
) -> DataFrame:
    """Rewrite the id columns by the map; ids it does not hold stay, or become null.

    ``id_map`` is unique by ``scope`` and ``old`` (see :func:`latest_ids`); ``scope`` columns (workspace, template)
    are in both tables, since ids are unique only within them.
    """
    within = [F.col(c) for c in scope]
    for column in columns:
        df = lookup(df, id_map, [*within, F.col(column)], [*scope, old], [new])
        value = F.coalesce(new, column) if missing == "keep" else F.col(new)
        df = df.withColumn(column, value).drop(new)
    return df


def remap_values(
    properties: DataFrame,
    id_map: DataFrame,
    value: str = "value",
    old: str = "old_id",
    new: str = "new_id",
    id_pattern: str | None = None,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Rewrite values that are, as a whole, an old id (of the same ``scope``).

    Values that cannot be an id (null, empty, or not of ``id_pattern``) are kept out of the
    exchange on the value and spread evenly instead.
    """
    candidate = F.nullif(F.col(value), F.lit(""))
    if id_pattern:
        candidate = F.when(candidate.rlike(id_pattern), candidate)
    within = [F.col(c) for c in scope]
    joined = lookup(properties, id_map, [*within, candidate], [*scope, old], [new])
    return joined.withColumn(value, F.coalesce(new, value)).drop(new)


def resolve_named(
    refs: DataFrame,
    objects: DataFrame,
    ref_key: Sequence[str],
    object_key: Sequence[str],
    id_column: str = "id",
    on_ambiguous: str = "quarantine",
) -> DataFrame:
    """Add ``resolved_id`` and ``matches`` for references by (group, name, type).

    No object: null and 0. One: its id. Several: null with their number (``quarantine``), or the
    query that reads ``matches`` fails (``error``). Objects are merged per key before the join, so it cannot multiply rows.
    """
    counted = _counted(objects, object_key, id_column)
    joined = lookup(refs, counted, [F.col(c) for c in ref_key], object_key, ["_one", "_matches"])
    out = joined.withColumns(
        {
            "resolved_id": F.when(F.col("_matches") == 1, F.col("_one")),
            "matches": F.coalesce("_matches", F.lit(0).cast("bigint")),
        }
    ).drop("_one", "_matches")
    if on_ambiguous == "error":
        name = F.concat_ws(", ", *[F.col(c).cast("string") for c in ref_key])
        clash = F.raise_error(F.concat(F.lit("ambiguous reference: "), name)).cast("bigint")
        out = out.withColumn("matches", F.when(F.col("matches") > 1, clash).otherwise(F.col("matches")))
    return out


def _counted(objects: DataFrame, key: Sequence[str], id_column: str) -> DataFrame:
    """(key..., _one, _matches): an id of each key, and how many it has."""
    distinct = objects.select(*key, id_column).distinct()
    return distinct.groupBy(*key).agg(F.min(id_column).alias("_one"), F.count(F.lit(1)).alias("_matches"))


def _listed_ports(
    ports: DataFrame, scope: Sequence[str], listed: int = LISTED_PORTS
) -> tuple[DataFrame, DataFrame | None]:
    """Ports by group: (scope..., group_id, _ports), and those of groups with more than ``listed`` by themselves.

    The second table, (scope..., group_id, name, kind, _one, _matches), is None if there is no such group.
    """
    group, key = [*scope, "group_id"], [*scope, "group_id", "name", "kind"]
    counted = _counted(ports, key, "port_id").dropna(subset=key)
    crowded, many = hot_keys(counted, group, listed), None
    if crowded is not None:
        theirs, match = same_keys(counted, small(crowded.drop("_rows")), group)
        many = stored(counted.join(theirs, match, "left_semi"), "ports")
        counted = counted.join(theirs, match, "left_anti")
    port = F.struct("name", "kind", "_one", "_matches")
    return counted.groupBy(*group).agg(F.collect_list(port).alias("_ports")), many


def _listed_port(name: Column, kind: Column) -> Column:
    return F.get(F.filter("_ports", lambda port: (port["name"] == name) & (port["kind"] == kind)), 0)


def first_types(
    tracked: DataFrame, group: str, name: str, type_column: str, id_column: str, ord_column: str
) -> DataFrame:
    """Named objects tracked more than once under one name keep the type tracked first."""
    return tracked.groupBy(group, name, id_column).agg(
        F.min_by(type_column, F.struct(ord_column, type_column)).alias(type_column)
    )


def build_edges(
    inputs: DataFrame,
    components: DataFrame,
    source: str = "source_id",
    dest: str = "dest_id",
    key: str = "id",
    kind: str = "kind",
    relationships: str = "relationships",
    plain_source: Column | None = None,
    scope: Sequence[str] = (),
    ports: DataFrame | None = None,
    source_port: str = "from_port",
    dest_port: str = "to_port",
) -> DataFrame:
    """Inputs joined to both ends; ``valid`` is false where an end is unknown (quarantine).

    Adds ``source_kind``, ``dest_kind`` and keeps the relationships only if the source is neither
    a group nor a funnel (or ``plain_source``, a condition on ``_source_kind``, holds).
    ``components`` is unique by ``scope`` and ``key``; ends are sought in the same ``scope`` (workspace,
    template), whose columns are in both tables.

    With ``ports`` (``scope``, ``group_id``, ``name``, ``kind``, ``port_id``) an end at a group is the port inside
    it that the input names (columns ``source_port`` and ``dest_port``): ``source_port_id``, ``dest_port_id`` and the
    numbers of ports found, ``source_ports``, ``dest_ports`` (null for an end that is no group). An edge
    whose port is missing or ambiguous is not ``valid``.
    """
    scope = list(scope)
    ends = components.select(*scope, key, F.col(kind).alias("_kind"), F.lit(True).alias("_found"))
    many, take = None, ["_kind", "_found"]
    if ports is not None:
        # a component comes with its ports, so each end of an edge is sought once and rows travel once for it
        lists, many = _listed_ports(ports, scope)
        ends = lookup(ends, lists, [*scope, key], [*scope, "group_id"], ["_ports"])
        take = [*take, "_ports"]
    rows = inputs
    added: list[str] = []
    for side, end, name in ((source, "source", source_port), (dest, "dest", dest_port)):
        rows = lookup(rows, ends, [*scope, side], [*scope, key], take)
        rows = rows.withColumnsRenamed({"_kind": f"_{end}_kind", "_found": f"_{end}_found"})
        if ports is None:
            continue
        end_kind = F.col(f"_{end}_kind")
        grouped = is_group(end_kind)
        wanted = endpoint_kind(end_kind, "source" if end == "source" else "destination")
        port = _listed_port(F.col(name), wanted)
        one, matches = port["_one"], port["_matches"]
        if many is not None:
            at = [F.when(grouped, c) for c in (F.col(side), F.col(name), wanted)]
            rows = lookup(
                rows,
                small(many),
                [*[F.col(c) for c in scope], *at],
                [*scope, "group_id", "name", "kind"],
                ["_one", "_matches"],
            )
            one, matches = F.coalesce(one, "_one"), F.coalesce(matches, "_matches")
        rows = rows.withColumns(
            {
                f"{end}_port_id": F.when(grouped & (matches == 1), one),
                f"{end}_ports": F.when(grouped, F.coalesce(matches, F.lit(0).cast("bigint"))),
            }
        ).drop("_ports", "_one", "_matches")
        added += [f"{end}_port_id", f"{end}_ports"]
    if plain_source is None:
        source_kind = F.col("_source_kind")
        funnel = F.coalesce(F.upper(source_kind) == "FUNNEL", F.lit(False))
        plain_source = ~is_group(source_kind) & ~funnel
    found = F.col("_source_found").isNotNull() & F.col("_dest_found").isNotNull()
    for count in added[1::2]:
        found = found & F.coalesce(F.col(count) == 1, F.lit(True))
    return rows.select(
        *[c for c in inputs.columns if c != relationships],
        endpoint_kind(F.col("_source_kind"), "source").alias("source_kind"),
        endpoint_kind(F.col("_dest_kind"), "destination").alias("dest_kind"),
        F.when(plain_source, F.col(relationships)).alias(relationships),
        *added,
        found.alias("valid"),
    )


def dangling(
    edges: DataFrame,
    components: DataFrame,
    source: str = "source_id",
    dest: str = "dest_id",
    key: str = "id",
    scope: Sequence[str] = (),
) -> DataFrame:
    """Edges with an end unknown in their ``scope``, once per missing end: ``missing_side``, ``missing_id``.

    One pass over the edges: each is exploded to its two ends before a single anti join.
    """
    ends = edges.withColumn(
        "_end",
        F.explode(
            F.array(
                F.struct(F.lit("source").alias("side"), F.col(source).alias("id")),
                F.struct(F.lit("destination").alias("side"), F.col(dest).alias("id")),
            )
        ),
    ).select(
        *edges.columns,
        F.col("_end.side").alias("missing_side"),
        F.col("_end.id").alias("missing_id"),
    )
    ids = [*scope, "missing_id"]
    known = components.select(*scope, F.col(key).alias("missing_id")).distinct()
    known = known.withColumn("_known", F.lit(True))
    return (
        lookup(ends, known, [F.col(c) for c in ids], ids, ["_known"])
        .where(F.col("_known").isNull())
        .drop("_known")
    )


def used_relationships(
    edges: DataFrame, source: str | Sequence[str], relationships: str
) -> DataFrame:
    """Distinct (source..., relationship) pairs named by any edge."""
    owner = [source] if isinstance(source, str) else list(source)
    return edges.select(*owner, F.explode(relationships).alias("relationship")).distinct()


def unused_relationships(
    declared: DataFrame, used: DataFrame, owner: Sequence[str], relationship: str = "relationship"
) -> DataFrame:
    """Declared relationships no edge uses; an owner never used keeps all of them.

    Both sides are merged to distinct pairs first, which bounds them by the declarations.
    """
    on = [*owner, relationship]
    return declared.select(*on).distinct().join(used.select(*on).distinct(), on, "left_anti")


def auto_terminate(
    unused: DataFrame,
    owner: Sequence[str],
    relationship: str = "relationship",
    page_rows: int = PAGE_ROWS,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Sorted list of unused relationships per owner (owner..., page, relationships)."""
    return paged_lists(
        unused.select(*owner, relationship).distinct(),
        owner,
        [relationship],
        F.col(relationship),
        "relationships",
        page_rows,
        hot_rows,
    )
