"""All settings of a flow at once: each section with the comparison it needs, and back again.

Settings are rows (owner..., section, key, value); sections are ``property``, ``scheduling``,
``style``, ``remote``, ``remote_port`` and ``edge``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.functions.values import format_number, has_text
from flowtables.operators.sparse import literal_default, sparse_diff
from flowtables.schemas import (
    CONNECTION_DEFAULTS,
    REMOTE_DEFAULTS,
    REMOTE_PORT_DEFAULTS,
    SCHEDULING_DEFAULTS,
    STYLE_DEFAULTS,
)

SECTION_DEFAULTS: dict[str, Mapping[str, Sequence[str]]] = {
    "scheduling": SCHEDULING_DEFAULTS,
    "style": STYLE_DEFAULTS,
    "remote": REMOTE_DEFAULTS,
    "remote_port": REMOTE_PORT_DEFAULTS,
    "edge": CONNECTION_DEFAULTS,
}


def sparse_settings(
    settings: DataFrame,
    owners: DataFrame,
    descriptors: DataFrame | None = None,
    owner: Sequence[str] = ("owner_id",),
) -> DataFrame:
    """Settings worth storing: (owner..., section, key, value, cleared).

    ``owners``: owner..., type, kind. ``descriptors``: type, key, defaults of the processor and
    controller properties; a type nobody described keeps nothing of this section. ``owner`` may hold
    the workspace and template beside the id, which is unique only within them.

    Properties follow their descriptors; scheduling, edge and remote port settings are kept when present
    and not at a default; styles when not at a default, whatever their key; of a remote group the settings
    with a default are kept when they differ from it, null included. Settings without a default
    are kept when they have text, but not those of scheduling.

    All that depends on a row alone is decided in one pass; only remote groups and properties, of
    which absent settings count as well, are joined.
    """
    owner, value = list(owner), F.col("value")

    def section(name: str) -> DataFrame:
        return settings.where(F.col("section") == name).select(*owner, "key", "value")

    kept = F.lit(False)
    for name, defaults in SECTION_DEFAULTS.items():
        known, at_default = F.col("key").isin(*defaults), F.lit(False)
        for key, allowed in defaults.items():
            at_default = F.when(F.col("key") == key, literal_default(value, allowed)).otherwise(
                at_default
            )
        present = known & value.isNotNull() & ~at_default
        rule = {
            "scheduling": present,
            "style": ~known | ~at_default,
            # those with a default are joined to the groups below
            "remote": ~known & has_text(value),
        }.get(name, F.when(known, present).otherwise(has_text(value)))
        kept = F.when(F.col("section") == name, rule).otherwise(kept)
    narrow = settings.where(kept).select(
        *owner, "section", "key", "value", value.isNull().alias("cleared")
    )

    remote_groups = owners.where(F.upper("kind") == "REMOTE_PROCESS_GROUP").select(*owner)
    joined = {
        "remote": sparse_diff(
            section("remote"), REMOTE_DEFAULTS, owner, owners=remote_groups, nulls="emit"
        )
    }
    if descriptors is not None:
        joined["property"] = sparse_diff(
            section("property"),
            descriptors,
            owner,
            owners=owners.select(*owner, "type"),
            type_columns=["type"],
        )
    for name, frame in joined.items():
        narrow = narrow.unionByName(frame.withColumn("section", F.lit(name)))
    return narrow


def label_sizes(labels: DataFrame, owner: Sequence[str], width: str, height: str) -> DataFrame:
    """Width and height of labels as style settings (owner..., section, key, value) in whole numbers."""
    sizes = F.array(
        *[
            F.struct(F.lit(key).alias("key"), format_number(F.col(column)).alias("value"))
            for key, column in (("width", width), ("height", height))
        ]
    )
    rows = labels.select(*owner, F.lit("style").alias("section"), F.inline(sizes))
    return rows.where("value is not null")


def full_settings(sparse: DataFrame, owners: DataFrame, section: str) -> DataFrame:
    """Every setting with a default for every owner: (owner_id, key, value).

    The stored value where it has text, the first default elsewhere. Stored settings without a
    default are added as they are.
    """
    stored = sparse.where((F.col("section") == section) & has_text(F.col("value"))).select(
        "owner_id", "key", F.col("value").alias("_stored")
    )
    defaults = F.array(
        *[
            F.struct(F.lit(key).alias("key"), F.lit(values[0]).alias("_default"))
            for key, values in SECTION_DEFAULTS[section].items()
        ]
    )
    base = owners.select("owner_id", F.inline(defaults))
    known = base.join(stored, ["owner_id", "key"], "left").select(
        "owner_id", "key", F.coalesce("_stored", "_default").alias("value")
    )
    others = stored.where(~F.col("key").isin(*SECTION_DEFAULTS[section])).select(
        "owner_id", "key", F.col("_stored").alias("value")
    )
    return known.unionByName(others)
