"""Column functions on configured values: text tests, positions, literals, kinds, endpoints."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.schemas import RESERVED_KINDS

# Unit spellings of duration and size literals, in seconds and bytes.
DURATION_UNITS = {
    0.001: ("ms", "milli", "millis", "millisecond", "milliseconds"),
    1.0: ("s", "sec", "secs", "second", "seconds"),
    60.0: ("m", "min", "mins", "minute", "minutes"),
    3600.0: ("h", "hr", "hrs", "hour", "hours"),
    86400.0: ("d", "day", "days"),
    604800.0: ("w", "wk", "wks", "week", "weeks"),
}
SIZE_UNITS = {
    1.0: ("b",),
    1024.0: ("kb",),
    1024.0**2: ("mb",),
    1024.0**3: ("gb",),
    1024.0**4: ("tb",),
}

_LITERAL = r"^\s*([0-9]+(?:\.[0-9]+)?)\s*([A-Za-z]+)\s*$"


def has_text(column: Column) -> Column:
    """Neither null nor empty."""
    return column.isNotNull() & (column != "")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def computed(array: Column) -> Column:
    """A computed array for a generator, as an expression rather than a plain column.

    For a plain column Catalyst adds a size filter and pushes it below the projection that computes
    the array, which would then parse every document twice.
    """
    return F.filter(array, lambda x: F.lit(True))


# Redundant columns ----------------------------------------------------------------------------


def elide(column: Column, same_as: Column) -> Column:
    """Null where the value only repeats ``same_as``."""
    return F.when(column.eqNullSafe(same_as), None).otherwise(column)


def restore(column: Column, same_as: Column) -> Column:
    """Inverse of :func:`elide`."""
    return F.coalesce(column, same_as)


# Component kinds ------------------------------------------------------------------------------


def reserved_kind(column: Column, reserved: Sequence[str] = RESERVED_KINDS) -> Column:
    """Upper-case reserved kind, or null for anything else."""
    upper = F.upper(column)
    return F.when(upper.isin(*[r.upper() for r in reserved]), upper)


def classify_kind(
    column: Column, reserved: Sequence[str] = RESERVED_KINDS, other: str = "processor"
) -> Column:
    """Reserved kind in lower case, matched without regard to case; otherwise ``other``."""
    return F.coalesce(F.lower(reserved_kind(column, reserved)), F.lit(other))


def is_group(column: Column) -> Column:
    return F.coalesce(F.upper(column).isin("PROCESS_GROUP", "REMOTE_PROCESS_GROUP"), F.lit(False))


def is_port(column: Column) -> Column:
    return F.coalesce(F.upper(column).isin("INPUT_PORT", "OUTPUT_PORT"), F.lit(False))


def endpoint_kind(
    kind: Column,
    side: str,
    ports: Sequence[str] = ("INPUT_PORT", "OUTPUT_PORT"),
    group: str = "PROCESS_GROUP",
    remote_group: str = "REMOTE_PROCESS_GROUP",
    known: Sequence[str] = ("FUNNEL",),
    side_port: Mapping[str, str] | None = None,
    other: str = "PROCESSOR",
) -> Column:
    """Kind of thing a connection really ends at: a group stands for one of its ports.

    ``side`` is ``source`` or ``destination``; ``side_port`` names the port kind of that side.
    """
    port = (side_port or {"source": "OUTPUT_PORT", "destination": "INPUT_PORT"})[side]
    upper = F.upper(kind)
    return (
        F.when(upper.isin(*ports), upper)
        .when(upper == group, F.lit(port))
        .when(upper == remote_group, F.lit("REMOTE_" + port))
        .when(upper.isin(*[k.upper() for k in known]), upper)
        .otherwise(F.lit(other))
    )


def effective_id(kind: Column, own_id: Column, group_id: Column, ports: Sequence[str]) -> Column:
    """Id a connection refers to: that of the group if the endpoint is one of its ports."""
    return F.when(kind.isin(*ports), group_id).otherwise(own_id)


def edge_labels(selected: Column, source_name: Column, source_is_port: Column) -> Column:
    """Relationships of a connection, followed by the source port's name if it is one."""
    return F.concat(
        F.coalesce(selected, F.array().cast("array<string>")),
        F.when(F.coalesce(source_is_port, F.lit(False)), F.array(source_name)).otherwise(
            F.array().cast("array<string>")
        ),
    )


def edge_target(
    dest_name: Column,
    dest_kind: Column,
    ports: Sequence[str] = ("INPUT_PORT", "REMOTE_INPUT_PORT"),
) -> Column:
    """Name of the port a connection ends at inside a group, null unless it ends at an input port."""
    return F.when(F.upper(dest_kind).isin(*ports), dest_name)


# Positions ------------------------------------------------------------------------------------


def format_number(column: Column) -> Column:
    """Whole number as text, half rounded away from zero; never ``-0``. Null where none fits."""
    return F.round(column).try_cast("bigint").cast("string")


def format_position(x: Column, y: Column) -> Column:
    """``"x,y"`` in whole numbers."""
    return F.concat(format_number(x), F.lit(","), format_number(y))


def parse_position(text: Column) -> Column:
    """Struct (x, y) of doubles; parts that are missing or no numbers become null."""
    parts = F.split(text, ",")
    return F.struct(
        F.get(parts, F.lit(0)).try_cast("double").alias("x"),
        F.get(parts, F.lit(1)).try_cast("double").alias("y"),
    )


# Literals -------------------------------------------------------------------------------------


def _parse_literal(text: Column, units: Mapping[float, Sequence[str]]) -> Column:
    # a literal map, so that number and unit are each extracted once per row
    scales = [F.lit(cell) for scale, names in units.items() for n in names for cell in (n, scale)]
    number = F.regexp_extract(text, _LITERAL, 1).try_cast("double")
    unit = F.lower(F.regexp_extract(text, _LITERAL, 2))
    return number * F.try_element_at(F.create_map(*scales), unit)


def parse_duration(text: Column) -> Column:
    """Seconds of a literal such as ``"30 sec"``, ``"0 mins"``, ``"10s"``; null if unknown."""
    return _parse_literal(text, DURATION_UNITS)


def parse_size(text: Column) -> Column:
    """Bytes of a literal such as ``"1 GB"`` or ``"1000b"``; null if unknown."""
    return _parse_literal(text, SIZE_UNITS)


# Empty values ---------------------------------------------------------------------------------


def pruned(column: Column, kind: T.DataType) -> Column:
    """Null for an empty text, list, map or struct of empties; empty map entries are removed."""
    if isinstance(kind, T.StringType):
        return F.nullif(column, F.lit(""))
    if isinstance(kind, T.MapType):
        # the value is pruned first, so that an entry holding only empties goes as well
        inner = F.transform_values(column, lambda k, v: pruned(v, kind.valueType))
        kept = F.map_filter(inner, lambda k, v: v.isNotNull())
        return F.when(F.size(kept) > 0, kept)
    if isinstance(kind, T.ArrayType):
        # list elements keep their place; only what is inside them is pruned
        inner = column
        if isinstance(kind.elementType, (T.StructType, T.MapType, T.ArrayType)):
            inner = F.transform(column, lambda e: pruned(e, kind.elementType))
        return F.when(F.size(column) > 0, inner)
    if isinstance(kind, T.StructType):
        fields = {f.name: pruned(column[f.name], f.dataType) for f in kind.fields}
        some = reduce(
            lambda a, b: a | b, [c.isNotNull() for c in fields.values()], F.lit(False)
        )
        return F.when(some, F.struct(*[c.alias(n) for n, c in fields.items()]))
    return column


def prune_empty(df: DataFrame, *columns: str) -> DataFrame:
    """Apply :func:`pruned` to the given columns (default: all)."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: pruned(F.col(c), kinds[c]) for c in columns or kinds})


# Attributes -----------------------------------------------------------------------------------


def stable_uuid(*key: Column) -> Column:
    """UUID-shaped text that is a function of the key, so that reruns agree."""
    text = [F.coalesce(k.cast("string"), F.lit("\x00")) for k in key]
    digits = F.substring(F.sha2(F.concat_ws("\x1f", *text), 256), 1, 32)
    return F.regexp_replace(
        digits, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"
    )


def equals_pattern() -> str:
    """Pattern of the condition form ``${attribute:equals("value")}``."""
    return r'^\s*\$\{\s*([^:${}\s]+)\s*:\s*equals\(\s*"([^"]*)"\s*\)\s*\}\s*$'
