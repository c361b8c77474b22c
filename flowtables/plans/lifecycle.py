"""Order in which a workspace is started, stopped or taken down, as plan tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.functions.values import reserved_kind
from flowtables.operators.spread import HOT_ROWS, numbered
from flowtables.schemas import RESERVED_KINDS

# Rank of each kind inside its group. Child groups come at their own rank, whole.
STATE_RANK = {
    "PROCESSOR": 1,
    "INPUT_PORT": 2,
    "OUTPUT_PORT": 3,
    "CONTROLLER": 4,
    "PROCESS_GROUP": 5,
    "REMOTE_PROCESS_GROUP": 6,
}
TEARDOWN_RANK = {
    "CONNECTION": 1,
    "PROCESSOR": 2,
    "FUNNEL": 3,
    "PROCESS_GROUP": 4,
    "INPUT_PORT": 5,
    "OUTPUT_PORT": 6,
    "LABEL": 7,
    "REMOTE_PROCESS_GROUP": 8,
    "CONTROLLER": 9,
}

_WIDTH = 19


def _kind() -> Column:
    """Known kind of a component; anything else, or none, is a processor."""
    known = reserved_kind(F.col("kind"), (*RESERVED_KINDS, "CONTROLLER", "CONNECTION"))
    return F.coalesce(known, F.lit("PROCESSOR"))


def _rank(kind: Column, ranks: dict[str, int]) -> Column:
    rank = F.lit(str(ranks["PROCESSOR"]))
    for name, value in ranks.items():
        rank = F.when(kind == name, F.lit(str(value))).otherwise(rank)
    return rank


def _segment(rank: Column, ord_column: Column) -> Column:
    """Fixed-width text, so that text order is numeric order; ``ord`` is not negative."""
    return F.concat(rank, F.lpad(ord_column.cast("string"), _WIDTH, "0"))


def _order_key(group_ords: Column, rank: Column, ord_column: Column, ranks: dict[str, int]):
    group = F.lit(str(ranks["PROCESS_GROUP"]))
    outer = F.transform(group_ords, lambda o: _segment(group, o))
    return F.array_join(F.array_append(outer, _segment(rank, ord_column)), "/")


def state_plan(
    components: DataFrame,
    scope: Sequence[str],
    target: str,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Steps (scope..., id, kind, step, state, position) that bring all components to ``target``.

    ``components``: scope..., id, kind, status, group_ords (see ``ords`` of the hierarchy), ord.
    ``target`` is ``enabled`` or ``disabled``. A disabled processor is stopped before it runs;
    everything else takes one step. Groups, funnels and labels have no state.
    """
    enable = target == "enabled"
    kind = _kind()
    restart = (kind == "PROCESSOR") & F.coalesce(
        F.upper(F.col("status")) == "DISABLED", F.lit(False)
    )
    words = (
        F.when(kind == "REMOTE_PROCESS_GROUP", "transmitting" if enable else "stopped")
        .when(kind == "CONTROLLER", "enabled" if enable else "disabled")
        .when(kind.isin("PROCESSOR", "INPUT_PORT", "OUTPUT_PORT"), "running" if enable else "stopped")
    )
    states = F.array(words)
    if enable:
        states = F.when(restart, F.array(F.lit("stopped"), words)).otherwise(states)
    steps = (
        components.where(words.isNotNull())
        .withColumn(
            "_order",
            _order_key(F.col("group_ords"), _rank(kind, STATE_RANK), F.col("ord"), STATE_RANK),
        )
        .select(*scope, "id", "kind", "_order", F.posexplode(states).alias("step", "state"))
        .withColumn("step", (F.col("step") + 1).cast("bigint"))
    )
    return numbered(steps, scope, ["_order", "id", "step"], "position", hot_rows, once=True).drop("_order")


def teardown_plan(
    components: DataFrame, scope: Sequence[str], hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Removal order (scope..., id, kind, position): contents of a group before the group.

    ``components``: scope..., id, kind, group_ords, ord, with connections among them. Nothing is
    removed here.
    """
    kind = _kind()
    key = _order_key(F.col("group_ords"), _rank(kind, TEARDOWN_RANK), F.col("ord"), TEARDOWN_RANK)
    # "~" sorts after every segment, so a group follows what is inside it
    key = F.when(kind == "PROCESS_GROUP", F.concat(key, F.lit("/~"))).otherwise(key)
    placed = components.select(*scope, "id", "kind", key.alias("_order"))
    return numbered(placed, scope, ["_order", "id"], "position", hot_rows, once=True).drop("_order")
