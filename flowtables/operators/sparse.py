"""Sparse configuration: keep what differs from the defaults, and put it back.

Configured values are a long table (owner, key, value); descriptors name the known keys of an
owner type with their default(s). Everything is an equi join on (type, key) or (owner, key), so a
hot owner spreads over its keys, and descriptor tables are broadcast only where Catalyst's own size
check allows it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.functions.values import has_text


def unpivot_text(df: DataFrame, owner: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    """Wide columns to (owner..., key, value) rows of text; a narrow step."""
    wide = df.select(*owner, *[c.cast("string").alias(n) for n, c in columns.items()])
    return wide.unpivot(list(owner), list(columns), "key", "value")


def _prepared(described: DataFrame, on: Sequence[str]) -> DataFrame:
    """Descriptors with the test for a null default worked out once, on the small side."""
    no_default = F.coalesce(F.size("defaults"), F.lit(0)) <= 0
    return described.select(
        *on,
        F.coalesce("defaults", F.array().cast("array<string>")).alias("_defaults"),
        (no_default | F.exists(F.col("defaults"), lambda d: d.isNull())).alias("_null_default"),
        F.lit(True).alias("_described"),
    )


def _stored_default() -> Column:
    """Whether ``value`` is at a default of the joined descriptor."""
    return F.when(F.col("value").isNull(), F.col("_null_default")).otherwise(
        F.coalesce(F.array_contains(F.col("_defaults"), F.col("value")), F.lit(False))
    )


def literal_default(value: Column, allowed: Sequence[str | None]) -> Column:
    """Whether ``value`` is one of the literal defaults; no default at all means null."""
    texts = [d for d in allowed if d is not None]
    null_default = F.lit(not texts or len(texts) < len(allowed))
    hit = value.isin(*texts) if texts else F.lit(False)
    return F.when(value.isNull(), null_default).otherwise(hit)


def _is_changed(value: Column, at_default: Column, nulls: str) -> Column:
    if nulls == "skip":
        return value.isNotNull() & ~at_default
    if nulls == "emit":
        return value.isNull() | ~at_default
    return ~at_default


def sparse_diff(
    values: DataFrame,
    described: DataFrame | Mapping[str, Sequence[str | None]],
    owner: Sequence[str] = ("owner_id",),
    owners: DataFrame | None = None,
    type_columns: Sequence[str] = (),
    driver: str = "descriptors",
    nulls: str = "keep",
) -> DataFrame:
    """Rows (owner..., key, value, cleared) whose value differs from the default.

    ``described`` is a table (type_columns..., key, defaults), or for owners of one type a mapping
    from key to its defaults; no default at all means null. A mapping needs no descriptor join.

    ``driver="descriptors"``: one candidate per owner and described key; keys nobody described are
    dropped. ``driver="values"``: one candidate per configured key; undescribed keys stay.

    ``nulls``: ``keep`` compares null-safely, so a cleared non-null default comes out as null;
    ``skip`` never emits null; ``emit`` counts null as different from every default.

    ``owners`` lists the owners (with ``type_columns``) when some have no value row at all.
    ``values`` is unique by owner and key.
    """
    owner, literal = list(owner), isinstance(described, Mapping)
    if not literal and not type_columns:
        raise ValueError("a descriptor table needs type columns; pass a mapping for one type")
    on = [*type_columns, "key"]
    # an absent value is emitted only when described keys drive and nulls count
    completed = driver == "descriptors" and nulls != "skip"
    rows = values
    if completed:
        if owners is None:
            owners = values.select(*owner, *type_columns).distinct()
        if literal:
            keys = F.explode(F.array(*[F.lit(k) for k in described])).alias("key")
            rows = owners.select(*owner, keys)
        else:
            rows = owners.select(*owner, *type_columns).join(
                _prepared(described, on), list(type_columns)
            )
        rows = rows.join(values.select(*owner, "key", "value"), [*owner, "key"], "left")
    elif not literal:
        rows = values.join(_prepared(described, on), on, "left" if driver == "values" else "inner")

    value = F.col("value")
    if literal:
        at_default, known = F.lit(False), F.lit(False)
        for key, allowed in described.items():
            at_default = F.when(F.col("key") == key, literal_default(value, allowed)).otherwise(
                at_default
            )
        known = F.col("key").isin(*described)
    else:
        at_default, known = _stored_default(), F.col("_described").isNotNull()
    changed = _is_changed(value, at_default, nulls)
    if driver == "values":
        changed = F.when(known, changed).otherwise(
            value.isNotNull() if nulls == "skip" else F.lit(True)
        )
    elif literal and not completed:
        changed = known & changed
    return rows.where(changed).select(*owner, "key", "value", value.isNull().alias("cleared"))


def wide_diff(
    df: DataFrame,
    owner: Sequence[str],
    columns: Mapping[str, Column],
    defaults: Mapping[str, Sequence[str | None]],
    nulls: str = "keep",
) -> DataFrame:
    """:func:`sparse_diff` for values held as columns of one row per owner: no join, no shuffle.

    Every key of ``defaults`` is compared, columns without a default entry are dropped.
    """

    cells = []
    for key, allowed in defaults.items():
        value = columns[key].cast("string") if key in columns else F.lit(None).cast("string")
        changed = _is_changed(value, literal_default(value, allowed), nulls)
        cells.append(
            F.struct(F.lit(key).alias("key"), value.alias("value"), changed.alias("_changed"))
        )
    return (
        df.select(*owner, F.inline(F.array(*cells)))
        .where("_changed")
        .select(*owner, "key", "value", F.col("value").isNull().alias("cleared"))
    )


def keep_present(df: DataFrame, owner: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    """Settings without any default: kept when neither null nor empty."""
    return unpivot_text(df, owner, columns).where(has_text(F.col("value")))


def apply_overrides(
    base: DataFrame, overrides: DataFrame, on: Sequence[str], default: str = "default"
) -> DataFrame:
    """Full value per (owner, key): the override where it has text, the default elsewhere."""
    given = overrides.select(*on, F.col("value").alias("_override"))
    return base.join(given, list(on), "left").select(
        *on,
        F.coalesce(F.nullif(F.col("_override"), F.lit("")), F.col(default)).alias("value"),
    )


def non_default_rows(
    df: DataFrame, columns: Sequence[str], known: DataFrame | None = None, on: Sequence[str] = ()
) -> DataFrame:
    """Rows with at least one setting; with ``known``, only those it lists by ``on``."""
    some = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns])
    rows = df.where(some)
    return rows if known is None else rows.join(known.select(*on).distinct(), list(on), "left_semi")


def extent(df: DataFrame, by: Sequence[str], x: str, y: str, margin: float = 500.0) -> DataFrame:
    """Largest x and y per group plus a margin; null when nothing has a position."""
    return df.groupBy(*by).agg(
        (F.max(x) + F.lit(margin)).alias("max_x"), (F.max(y) + F.lit(margin)).alias("max_y")
    )
