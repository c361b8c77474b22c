"""Template documents: read from folders into flat tables, and written back.

A document is one template of one workspace. Only the YAML text itself is parsed in Python, file by
file inside the tasks that read them; everything else stays in Spark's own functions.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.functions.values import (
    computed,
    format_position,
    has_text,
    parse_position,
    pruned,
    reserved_kind,
)
from flowtables.operators.naming import nest
from flowtables.operators.spread import HOT_ROWS, PAGE_ROWS, dealt, lookup, running
from flowtables.schemas import COMPONENT, CONTROLLER, INPUT, REMOTE_PORT, TABLES, TEMPLATE
from flowtables.session import cut

# Document sections of a component and what the flat table calls them.
SECTIONS = {"properties": "property", "styles": "style", "scheduling": "scheduling"}


# The line that starts a document in a file of many, up to its name as JSON.
BEGIN = "--- # "
HEADER = "workspace string, template string, page bigint"


def as_text(kind: T.DataType) -> T.DataType:
    """The same shape with text leaves: documents are read as written and cast afterwards."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(as_text(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(T.StringType(), as_text(kind.valueType))
    return T.StringType()


# Reading --------------------------------------------------------------------------------------


def _yaml_to_json(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import yaml

    loader = getattr(yaml, "CBaseLoader", yaml.BaseLoader)  # scalars stay text
    for frame in frames:
        texts, errors = [], []
        for text in frame["text"]:
            try:
                value = yaml.load(text, Loader=loader)
                if not isinstance(value, dict):
                    raise ValueError("not a mapping")
                texts.append(json.dumps(value, ensure_ascii=False))
                errors.append(None)
            except (yaml.YAMLError, ValueError) as problem:
                texts.append(None)
                errors.append(str(problem))
        yield pd.DataFrame(
            {
                "workspace": frame["workspace"],
                "file": frame["file"],
                "json": pd.Series(texts, dtype=object, index=frame.index),
                "error": pd.Series(errors, dtype=object, index=frame.index),
            }
        )


def _parsed(rows: DataFrame) -> DataFrame:
    """(workspace, file, doc, error) of rows (workspace, file, json, error)."""
    bad = "_corrupt_record"
    schema = as_text(TEMPLATE).add(bad, "string")
    doc = F.from_json("json", schema, {"columnNameOfCorruptRecord": bad})
    return rows.withColumn("doc", doc).select(
        "workspace",
        "file",
        F.col("doc"),
        F.coalesce(
            "error",
            F.when(F.col(f"doc.{bad}").isNotNull(), F.lit("not a template")),
            F.when(~F.coalesce(has_text(F.col("doc.name")), F.lit(False)), F.lit("no name")),
        ).alias("error"),
    )


def read_exports(spark: SparkSession, path: str) -> DataFrame:
    """Documents (workspace, file, doc, error) of every ``*.yaml`` directly in the folder(s), and of
    the files :func:`write_exports` has put there.

    ``path`` may be a glob over many workspace folders; the folder's name is the workspace of a plain file,
    and written files name theirs. A document that cannot be parsed keeps its row with ``error``.
    """
    source = F.col("_metadata.file_path")

    def name(pattern: str) -> Column:
        # the path is encoded like a url, where a plus sign stands for itself
        return F.url_decode(F.replace(F.regexp_extract(source, pattern, 1), F.lit("+"), F.lit("%2B")))

    files = (
        spark.read.option("pathGlobFilter", "*.yaml")
        .text(path, wholetext=True)
        .select(
            name(r"([^/]+)/[^/]+$").alias("workspace"),
            name(r"([^/]+)$").alias("file"),
            F.col("value").alias("text"),
        )
    )
    return read_exports_yaml(files).unionByName(read_written(spark, path))


def read_written(spark: SparkSession, path: str) -> DataFrame:
    """The same from the files that :func:`write_exports` has written; ``file`` is template and page.

    Files are split at the line that begins a document, so a large one is read by several tasks.
    """
    records = (
        spark.read.option("pathGlobFilter", "part-*").option("lineSep", "\n" + BEGIN).text(path)
    )
    whole = F.when(F.col("value").startswith(BEGIN), F.substr("value", F.lit(len(BEGIN) + 1)))
    named = records.select(F.coalesce(whole, "value").alias("value")).select(
        F.from_json(F.substring_index("value", "\n", 1), HEADER).alias("head"),
        F.substr("value", F.locate("\n", F.col("value")) + 1).alias("text"),
    )
    pages = F.concat("head.template", F.lit("."), F.col("head.page").cast("string"), F.lit(".yaml"))
    return read_exports_yaml(
        named.select(F.col("head.workspace").alias("workspace"), pages.alias("file"), "text")
    )


def read_exports_yaml(documents: DataFrame) -> DataFrame:
    """The same from rows (workspace, file, YAML text as ``text``)."""
    texts = documents.select("workspace", "file", "text")
    return _parsed(
        texts.mapInPandas(_yaml_to_json, "workspace string, file string, json string, error string")
    )


def read_exports_json(documents: DataFrame, json_column: str = "json") -> DataFrame:
    """The same from rows (workspace, file, JSON text), without any Python."""
    return _parsed(
        documents.select(
            "workspace",
            "file",
            F.col(json_column).alias("json"),
            F.lit(None).cast("string").alias("error"),
        )
    )


def to_tables(documents: DataFrame) -> dict[str, DataFrame]:
    """Flat tables of the documents without an error.

    The documents are parsed once and written to the shared folder; every table is a pass over that.
    Fragments of one template (see :func:`to_documents`) add up: what continues a component is marked by
    ``part``, and elements keep their numbers by ``ord``.
    """
    docs = cut(documents).where(F.col("error").isNull()).select(
        "workspace", F.col("doc.name").alias("template"), "doc.*"
    )
    at = ["workspace", "template"]

    def each(column: str, name: str) -> DataFrame:
        return docs.select(*at, F.posexplode(computed(F.col(column))).alias("_ord", name))

    def place(element: str) -> Column:
        return F.coalesce(F.col(element)["ord"].try_cast("bigint"), F.col("_ord").cast("bigint"))

    component, controller = each("components", "c"), each("controllers", "c")
    c = F.col("c")
    ord_column = place("c").alias("ord")
    kind = F.coalesce(reserved_kind(c["type"]), F.lit("PROCESSOR"))
    position = parse_position(c["position"])

    def entries(rows: DataFrame, column: str, section: str) -> DataFrame:
        return rows.select(
            *at,
            c["id"].alias("owner_id"),
            F.lit(section).alias("section"),
            F.explode(c[column]).alias("key", "value"),
        )

    properties = entries(controller, "properties", "property")
    for column, section in SECTIONS.items():
        properties = properties.unionByName(entries(component, column, section))

    edge = component.select(*at, c["id"].alias("dest_id"), F.posexplode(c["inputs"]).alias("_ord", "e"))
    e = F.col("e")
    settings = F.when(
        e["properties"].isNotNull(),
        F.struct(
            *[
                e["properties"][f.name].try_cast(f.dataType).alias(f.name)
                if not isinstance(f.dataType, T.ArrayType)
                else e["properties"][f.name].alias(f.name)
                for f in TABLES["edges"]["settings"].dataType.fields
            ]
        ),
    )
    port = component.select(
        *at, c["id"].alias("component_id"), F.posexplode(c["remotePorts"]).alias("_ord", "p")
    )
    p = F.col("p")
    rule = component.select(
        *at,
        c["id"].alias("owner_id"),
        c["advanced"]["policy"].alias("policy"),
        F.posexplode(c["advanced"]["rules"]).alias("_ord", "r"),
    )
    r = F.col("r")
    return {
        "templates": docs.select(*at).distinct(),
        "dependencies": docs.select(*at, F.explode("dependencies").alias("grp", "v1"))
        .select(*at, "grp", F.explode("v1").alias("artifact", "v2"))
        .select(*at, "grp", "artifact", F.explode("v2").alias("version", "v3"))
        .select(*at, "grp", "artifact", "version", F.explode("v3").alias("name", "type")),
        "controllers": controller.where(c["part"].isNull()).select(
            *at,
            c["id"].alias("id"),
            c["name"].alias("name"),
            F.coalesce(c["type"], c["name"]).alias("type"),
            c["comment"].alias("comment"),
            ord_column,
        ),
        "components": component.where(c["part"].isNull()).select(
            *at,
            c["id"].alias("id"),
            c["name"].alias("name"),
            F.coalesce(c["type"], c["name"]).alias("type"),
            kind.alias("kind"),
            F.regexp_replace(c["template"], r"\.yaml$", "").alias("child_template"),
            position["x"].alias("x"),
            position["y"].alias("y"),
            c["comment"].alias("comment"),
            c["advanced"]["policy"].alias("policy"),
            ord_column,
        ),
        "properties": properties,
        "edges": edge.select(
            *at,
            e["source"].alias("source_id"),
            "dest_id",
            e["to"].alias("to_port"),
            F.coalesce(e["from"], F.array().cast("array<string>")).alias("relationships"),
            e["position"].alias("bends"),
            settings.alias("settings"),
            place("e").alias("ord"),
        ),
        "remote_ports": port.select(
            *at,
            "component_id",
            p["name"].alias("name"),
            p["type"].alias("type"),
            p["maxConcurrentTasks"].try_cast("int").alias("max_tasks"),
            p["useCompression"].try_cast("boolean").alias("compression"),
            p["batchCount"].try_cast("int").alias("batch_count"),
            p["batchSize"].alias("batch_size"),
            p["batchDuration"].alias("batch_duration"),
            place("p").alias("ord"),
        ),
        "rules": rule.select(
            *at,
            "owner_id",
            (place("r") + 1).alias("rule_no"),
            r["name"].alias("rule_name"),
            "policy",
            F.coalesce(r["conditions"], F.array().cast("array<string>")).alias("conditions"),
            r["actions"].alias("actions"),
        ),
    }


# Writing --------------------------------------------------------------------------------------


def _union(rows: Mapping[str, DataFrame], columns: list[str]) -> DataFrame:
    """Several kinds of parts under each other: the columns, and one named column per kind."""
    frames = [df.select(*columns, F.col("item").alias(n)) for n, df in rows.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, T.MapType)


def _packed(
    parts: DataFrame,
    kinds: list[str],
    key: list[str],
    order: list[str],
    page_rows: int,
    hot_rows: int | None,
    sizes: DataFrame,
    weight: Column | None = None,
) -> DataFrame:
    """Parts packed into one ordered list per kind and page.

    A page ends with the part whose ``weight`` (default 1) fills it, so it holds at most ``page_rows`` and one
    part more. On further pages elements keep their ``ord`` where it is not their index in the list.
    """
    weight = F.lit(1).cast("bigint") if weight is None else weight
    placed = running(parts, key, order, {"_rn": weight}, hot_rows, sizes).withColumn(
        "page", F.floor((F.col("_rn") - weight) / page_rows).cast("bigint")
    )

    held = F.collect_list(F.struct("_rn", *kinds))
    if all(_orderable(placed.schema[name].dataType) for name in kinds):
        held = F.sort_array(held)
    else:
        held = F.array_sort(held, lambda a, b: F.when(a["_rn"] < b["_rn"], -1).otherwise(1))

    def of_kind(name: str) -> Column:
        mine = F.transform(
            F.filter("_parts", lambda part: part[name].isNotNull()), lambda part: part[name]
        )
        if name in ("head", "controller", "entries"):
            return mine
        return F.transform(
            mine,
            lambda e, i: e.withField("ord", F.when((F.col("page") > 0) & (e["ord"] != i), e["ord"])),
        )

    return (
        placed.groupBy(*key, "page")
        .agg(held.alias("_parts"))
        .withColumns({name: of_kind(name) for name in kinds})
        .drop("_parts")
    )


def _section_map(entries: Column, section: str) -> Column:
    mine = F.filter(entries, lambda s: s["section"] == section)
    return F.map_from_entries(
        F.array_sort(F.transform(mine, lambda s: F.struct(s["key"], s["value"])))
    )


def to_documents(
    tables: Mapping[str, DataFrame], page_rows: int = PAGE_ROWS, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Documents (workspace, template, page, json) with empties removed and map keys sorted.

    One per template. A template or component with more than ``page_rows`` parts goes on in further
    fragments, each a document of the same form, so that no row grows beyond twice ``page_rows`` parts.
    What continues an element has its id and the fragment's number as ``part``, rules repeat their policy,
    and elements of further fragments whose place is not their index in the list have it as ``ord``.
    """
    at = ["workspace", "template"]
    owner = [*at, "owner_id"]

    def item(df: DataFrame, key: str, rank: int, ord_: Column, tie: Column, value: Column):
        return df.select(
            *at,
            F.col(key).alias("owner_id"),
            F.lit(rank).alias("rank"),
            ord_.cast("bigint").alias("ord"),
            tie.cast("string").alias("tie"),
            value.alias("item"),
        )

    zero, none = F.lit(0), F.lit("")
    # the head keeps the type even if it equals the name, so that a head is told from a fragment
    head = item(
        tables["components"],
        "id",
        0,
        zero,
        none,
        F.struct(
            "name",
            F.when(F.col("kind") == "PROCESSOR", F.col("type"))
            .otherwise(F.col("kind"))
            .alias("type"),
            F.concat("child_template", F.lit(".yaml")).alias("template"),
            format_position(F.col("x"), F.col("y")).alias("position"),
            "comment",
            "policy",
            F.col("ord"),
        ),
    )
    # whose properties these are: controllers share the table with components
    services = tables["controllers"].select(*at, F.col("id").alias("_id")).distinct()
    properties = lookup(
        tables["properties"],
        services.withColumn("service", F.lit(True)),
        [F.col(c) for c in (*at, "owner_id")],
        [*at, "_id"],
        ["service"],
    )
    entry = item(
        properties,
        "owner_id",
        1,
        zero,
        F.concat_ws("\x1f", "section", "key"),
        F.struct("section", "key", "value", "service"),
    )
    edge = item(
        tables["edges"],
        "dest_id",
        2,
        F.col("ord"),
        F.col("source_id"),
        F.struct(
            F.col("source_id").alias("source"),
            F.col("relationships").alias("from"),
            F.col("to_port").alias("to"),
            F.col("bends").alias("position"),
            F.col("settings").alias("properties"),
            F.col("ord"),
        ).cast(INPUT),
    )
    port = item(
        tables["remote_ports"],
        "component_id",
        3,
        F.col("ord"),
        F.col("name"),
        F.struct(
            "name",
            "type",
            F.col("max_tasks").alias("maxConcurrentTasks"),
            F.col("compression").alias("useCompression"),
            F.col("batch_count").alias("batchCount"),
            F.col("batch_size").alias("batchSize"),
            F.col("batch_duration").alias("batchDuration"),
            F.col("ord"),
        ).cast(REMOTE_PORT),
    )
    rule = item(
        tables["rules"],
        "owner_id",
        4,
        F.col("rule_no"),
        none,
        F.struct(
            F.col("rule_name").alias("name"),
            "conditions",
            # entries until the end: a list of them has an order, a map has none
            F.array_sort(F.map_entries("actions")).alias("actions"),
            (F.col("rule_no") - 1).cast("bigint").alias("ord"),
            "policy",
        ),
    )
    controller = item(
        tables["controllers"],
        "id",
        5,
        F.col("ord"),
        none,
        F.struct("name", "type", "comment", F.col("ord")),
    )
    kinds = {
        "head": head,
        "entries": entry,
        "inputs": edge,
        "remotePorts": port,
        "rules": rule,
        "controller": controller,
    }
    order = ["rank", "ord", "tie"]
    parts = _union(kinds, [*owner, *order])
    packed = _packed(parts, list(kinds), owner, order, page_rows, hot_rows, parts)
    first = F.get("head", F.lit(0))
    service = F.get("controller", F.lit(0))
    is_controller = F.coalesce(
        service.isNotNull() | F.get("entries", F.lit(0))["service"], F.lit(False)
    )
    packed = packed.withColumn("_service", is_controller)
    place = F.coalesce(first["ord"], service["ord"], F.lit(2**62))
    part = F.when(F.coalesce(first.isNull() & service.isNull(), F.lit(True)), F.col("_page"))
    rule_list = F.transform(
        F.col("rules"),
        lambda r: F.struct(
            r["name"].alias("name"),
            r["conditions"].alias("conditions"),
            F.map_from_entries(r["actions"]).alias("actions"),
            r["ord"].alias("ord"),
        ),
    )
    policy = F.coalesce(first["policy"], F.get("rules", F.lit(0))["policy"])
    component = F.struct(
        first["name"].alias("name"),
        first["type"].alias("type"),
        F.col("owner_id").alias("id"),
        first["template"].alias("template"),
        first["position"].alias("position"),
        first["comment"].alias("comment"),
        *[_section_map(F.col("entries"), s).alias(n) for n, s in SECTIONS.items()],
        F.col("inputs"),
        F.col("remotePorts"),
        F.when(
            has_text(policy) | (F.size("rules") > 0),
            F.struct(policy.alias("policy"), rule_list.alias("rules")),
        ).alias("advanced"),
        part.alias("part"),
        first["ord"].alias("ord"),
    ).cast(COMPONENT)
    controller_item = F.struct(
        service["name"].alias("name"),
        service["type"].alias("type"),
        F.col("owner_id").alias("id"),
        service["comment"].alias("comment"),
        _section_map(F.col("entries"), "property").alias("properties"),
        part.alias("part"),
        service["ord"].alias("ord"),
    ).cast(CONTROLLER)
    order = ["_service", "_place", "owner_id", "_page"]
    placed = packed.withColumn("_place", place).withColumnRenamed("page", "_page")
    weight = reduce(lambda a, b: a + b, [F.size(k) for k in kinds]).cast("bigint")
    elements = placed.select(
        *at,
        *order,
        weight.alias("_weight"),
        F.when(F.col("_service"), controller_item).alias("controllers"),
        F.when(~F.col("_service"), component).alias("components"),
    )
    lists = _packed(
        elements,
        ["controllers", "components"],
        at,
        order,
        page_rows,
        hot_rows,
        parts,
        F.col("_weight"),
    )
    tree = nest(
        tables["dependencies"],
        at,
        ["grp", "artifact", "version", "name"],
        "type",
        "dependencies",
        page_rows,
        hot_rows,
    )
    empty = tables["templates"].select(*at, F.lit(0).cast("bigint").alias("page"))
    whole = (
        lists.join(tree, [*at, "page"], "full_outer").join(empty, [*at, "page"], "full_outer")
    )
    doc = F.struct(
        F.col("template").alias("name"), "dependencies", "controllers", "components"
    ).cast(TEMPLATE)
    return whole.select(*at, "page", F.to_json(pruned(doc, TEMPLATE)).alias("json"))


def to_yaml(documents: DataFrame) -> DataFrame:
    """Documents with the JSON text turned into YAML text (column ``yaml``)."""

    def convert(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        dumper = getattr(yaml, "CSafeDumper", yaml.SafeDumper)
        for frame in frames:
            frame["yaml"] = [
                yaml.dump(json.loads(j), Dumper=dumper, sort_keys=False, allow_unicode=True)
                for j in frame["json"]
            ]
            yield frame.drop(columns="json")

    # writing YAML takes long for its bytes
    return dealt(documents.select("workspace", "template", "page", "json")).mapInPandas(
        convert, "workspace string, template string, page long, yaml string"
    )


def write_exports(documents: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write documents as YAML streams: many to a file, each behind a line that names it.

    That line starts a YAML document and has workspace, template and page in its comment, so any YAML reader
    reads a file as a stream, and :func:`read_exports` and :func:`read_written` split it there. No document
    holds such a line itself: it would end there. Files have about the size of Spark's advisory partition,
    whatever the number of documents; pages of one template are spread over them.
    """
    column = "yaml" if "yaml" in documents.columns else "json"
    head = F.to_json(F.struct("workspace", "template", F.col("page").cast("bigint").alias("page")))
    record = F.concat(F.lit(BEGIN), head, F.lit("\n"), F.rtrim(F.col(column), F.lit("\n")))
    named = documents.repartition("workspace", "template", "page").select(record.alias("value"))
    named.write.mode(mode).text(path, lineSep="\n")
