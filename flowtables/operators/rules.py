"""Rule documents (XML text), their flat form, and rules applied to rows."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.functions.values import bound, computed, equals_pattern, has_text, stable_uuid
from flowtables.schemas import RULE, RULE_XML

# Attribute under which decided conditions are entered, and conditions evaluated in one scan.
HOLDS = "\x00holds"
TEXTS = 200

# Parsing and rendering ------------------------------------------------------------------------


def _action_map(actions: Column) -> Column:
    """Attribute → value, sorted by attribute; of a repeated attribute the last one counts."""
    placed = F.transform(
        actions,
        lambda a, i: F.struct(
            a["attribute"].alias("attribute"), i.alias("i"), a["value"].alias("value")
        ),
    )
    ordered = F.sort_array(F.filter(placed, lambda a: a["attribute"].isNotNull()))

    def last_of_each(sorted_actions: Column) -> Column:
        following = lambda i: F.get(sorted_actions, i + 1)["attribute"]
        return F.filter(
            sorted_actions, lambda a, i: ~following(i).eqNullSafe(a["attribute"])
        )

    last = bound(ordered, last_of_each)
    return F.map_from_entries(F.transform(last, lambda a: F.struct(a["attribute"], a["value"])))


def parse_rules(df: DataFrame, xml_column: str) -> DataFrame:
    """Add ``policy``, ``rules`` (name, conditions, actions) and ``corrupt_xml`` to every row.

    No text: no rules. Broken XML: no rules and the text in ``corrupt_xml``, so nothing is lost. A
    rule without conditions or actions has an empty list or map.
    """
    parsed = F.from_xml(
        F.when(has_text(F.col(xml_column)), F.col(xml_column)),
        RULE_XML.simpleString(),
        {
            "columnNameOfCorruptRecord": "_corrupt_record",
            "mode": "PERMISSIVE",
            # spaces around a condition or a value belong to it
            "ignoreSurroundingSpaces": "false",
        },
    )
    none = F.array().cast("array<string>")
    no_actions = F.array().cast(RULE_XML["rules"].dataType.elementType["actions"].dataType)
    rules = F.transform(
        F.col("_criteria.rules"),
        lambda r: F.struct(
            r["name"].alias("name"),
            F.coalesce(F.transform(r["conditions"], lambda c: c["expression"]), none).alias(
                "conditions"
            ),
            _action_map(F.coalesce(r["actions"], no_actions)).alias("actions"),
        ),
    )
    return (
        df.withColumn("_criteria", parsed)
        .withColumns(
            {
                "policy": F.col("_criteria.flowFilePolicy"),
                "rules": F.coalesce(rules, F.array().cast(f"array<{RULE.simpleString()}>")),
                "corrupt_xml": F.col("_criteria._corrupt_record"),
            }
        )
        .drop("_criteria")
    )


def render_rules(df: DataFrame, policy: str, rules: str, key: Sequence[str], name: str) -> DataFrame:
    """Add rule XML as ``name``; ids derive from ``key`` and place, so that reruns agree."""
    owner = [F.col(k) for k in key]

    def build(rule: Column, i: Column) -> Column:
        conditions = F.transform(
            rule["conditions"],
            lambda c, j: F.struct(
                stable_uuid(*owner, i, F.lit("condition"), j).alias("id"), c.alias("expression")
            ),
        )
        actions = F.transform(
            F.sort_array(F.map_entries(rule["actions"])),
            lambda a, j: F.struct(
                stable_uuid(*owner, i, F.lit("action"), j).alias("id"),
                a["key"].alias("attribute"),
                a["value"].alias("value"),
            ),
        )
        return F.struct(
            stable_uuid(*owner, i, F.lit("rule")).alias("id"),
            rule["name"].alias("name"),
            conditions.alias("conditions"),
            actions.alias("actions"),
        )

    criteria = F.struct(
        F.col(policy).alias("flowFilePolicy"), F.transform(F.col(rules), build).alias("rules")
    )
    return df.withColumn(name, F.to_xml(criteria, {"rowTag": "criteria"}))


def flatten_rules(df: DataFrame, key: Sequence[str], rules: str = "rules") -> DataFrame:
    """Rows (key..., rule_no, rule_name, kind, item_no, item_key, item_value).

    A condition has its expression as ``item_value``; an action its attribute and value. Numbers
    start at 1.
    """
    each = df.select(*key, F.posexplode(computed(F.col(rules))).alias("_i", "_rule"))
    conditions = F.transform(
        F.col("_rule.conditions"),
        lambda c, j: F.struct(
            F.lit("condition").alias("kind"),
            (j + 1).cast("bigint").alias("item_no"),
            F.lit(None).cast("string").alias("item_key"),
            c.alias("item_value"),
        ),
    )
    actions = F.transform(
        F.sort_array(F.map_entries(F.col("_rule.actions"))),
        lambda a, j: F.struct(
            F.lit("action").alias("kind"),
            (j + 1).cast("bigint").alias("item_no"),
            a["key"].alias("item_key"),
            a["value"].alias("item_value"),
        ),
    )
    return each.select(
        *key,
        (F.col("_i") + 1).cast("bigint").alias("rule_no"),
        F.col("_rule.name").alias("rule_name"),
        F.inline(F.concat(conditions, actions)),
    )


# Applying -------------------------------------------------------------------------------------


def _number(value: Column) -> Column:
    return value.try_cast("double")


# Tests of the form ``${attribute:test("value")}``.
TESTS = {
    "equals": lambda v, a: v == a,
    "equalsIgnoreCase": lambda v, a: F.lower(v) == F.lower(a),
    "startsWith": lambda v, a: v.startswith(a),
    "endsWith": lambda v, a: v.endswith(a),
    "contains": lambda v, a: v.contains(a),
    "gt": lambda v, a: _number(v) > _number(a),
    "ge": lambda v, a: _number(v) >= _number(a),
    "lt": lambda v, a: _number(v) < _number(a),
    "le": lambda v, a: _number(v) <= _number(a),
    "isNull": lambda v, a: v.isNull(),
    "notNull": lambda v, a: v.isNotNull(),
    "isEmpty": lambda v, a: ~F.coalesce(has_text(v), F.lit(False)),
}
FORM = r'\s*\$\{\s*([^:${}\s]+)\s*:\s*(\w+)\(\s*(?:"([^"]*)"|([^")\s]*))\s*\)\s*\}\s*'


def condition_test(text: str) -> Column:
    """Boolean SQL text, or the form ``${attribute:test("value")}`` with one of ``TESTS``. Another text that
    begins like that form is an error."""
    form = re.fullmatch(FORM, text)
    if form and form.group(2) in TESTS:
        name, test, quoted, bare = form.groups()
        value = F.lit(bare if quoted is None else quoted)
        return TESTS[test](F.col(name).cast("string"), value)
    if text.lstrip().startswith("${"):
        raise ValueError(f"unknown condition {text!r}")
    return F.expr(text)


def condition_column(text: str) -> Column:
    """The same, with null counted as false."""
    return F.coalesce(condition_test(text), F.lit(False))


def apply_rules(df: DataFrame, rules: Sequence[Mapping], policy: str = "USE_CLONE") -> DataFrame:
    """Apply ordered rules (name, conditions, actions: attribute → SQL expression) to each row.

    Conditions see the original row and must all hold; no conditions always hold.

    ``USE_CLONE``: one output row per matching rule with only that rule's actions, and
    ``matched_rule``; a row no rule matches passes once with null. ``merge``: one output row, later
    rules override earlier ones, and ``matched_rules`` lists the names. Narrow: no shuffle.
    """
    attributes: dict[str, None] = {}
    for rule in rules:
        attributes.update(dict.fromkeys(rule["actions"]))

    def holds(rule: Mapping) -> Column:
        test = F.lit(True)
        for condition in rule["conditions"]:
            test = test & condition_column(condition)
        return test

    kinds = {f.name: f.dataType for f in df.schema.fields}

    def original(name: str) -> Column:
        return F.col(name) if name in kinds else F.lit(None)

    if policy == "merge":
        out, fired = {}, [F.when(holds(r), F.lit(r["name"])) for r in rules]
        for name in attributes:
            value = original(name)
            for rule in rules:
                if name in rule["actions"]:
                    value = F.when(holds(rule), F.expr(rule["actions"][name])).otherwise(value)
            out[name] = value.cast(kinds[name]) if name in kinds else value
        names = F.array_compact(F.array(*fired)) if rules else F.array().cast("array<string>")
        return df.withColumns({**out, "matched_rules": names})
    if policy != "USE_CLONE":
        raise ValueError(f"unknown policy {policy!r}")

    def copy(rule: Mapping | None) -> Column:
        cells = [F.lit(rule["name"] if rule else None).cast("string").alias("matched_rule")]
        for name in attributes:
            value = original(name)
            if rule and name in rule["actions"]:
                value = F.expr(rule["actions"][name])
            # one type for all copies: that of the existing column, or text for a new one
            cells.append(value.cast(kinds.get(name, "string")).alias(name))
        return F.struct(*cells)

    copies = F.array_compact(F.array(*[F.when(holds(r), copy(r)) for r in rules]))
    copies = F.when(F.size(copies) > 0, copies).otherwise(F.array(copy(None)))
    kept = [c for c in df.columns if c not in attributes]
    return df.select(*kept, F.inline(copies))


def rule_conditions(flat: DataFrame, key: Sequence[str]) -> DataFrame:
    """Conditions of flattened rules as (key..., rule_no, attr, value).

    A condition of another form than equality has a null ``attr`` and its text as ``value``: it cannot be
    decided here, nor can its rule (see :func:`undecided_rules`).
    """
    pattern = equals_pattern()
    text = F.col("item_value")
    known = text.rlike(pattern)
    return flat.where("kind = 'condition'").select(
        *key,
        "rule_no",
        F.when(known, F.regexp_extract(text, pattern, 1)).alias("attr"),
        F.when(known, F.regexp_extract(text, pattern, 2)).otherwise(text).alias("value"),
    )


def undecided_rules(conditions: DataFrame, rule: Sequence[str]) -> DataFrame:
    """Report of the rules :func:`match_rules` leaves out: (rule..., conditions that are no equality).

    Give it what :func:`decide_conditions` returns to have only those that it cannot evaluate either.
    """
    return (
        conditions.where("attr is null")
        .groupBy(*rule)
        .agg(F.sort_array(F.collect_set("value")).alias("undecided"))
    )


def free_rules(rules: DataFrame, conditions: DataFrame, rule: Sequence[str]) -> DataFrame:
    """Rules (rule...) without any condition: they hold for every row, so no row is listed with them."""
    return rules.select(*rule).distinct().join(conditions.select(*rule).distinct(), rule, "left_anti")


def decide_conditions(
    rows: DataFrame, conditions: DataFrame, row: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Conditions of any form, evaluated once per row and distinct text.

    ``rows``: row... and the columns that conditions name. ``conditions``: rule..., attr, value, where a null
    ``attr`` has the text as ``value``. Returns entries (row..., attr, value) of the texts that hold, and the
    conditions with these texts as equalities on such entries. A text that is wrong, or names no column, stays
    undecided. Texts are part of the plan, ``TEXTS`` to a scan of the rows; their number is that of
    different conditions, not of rules.
    """
    texts = [r["value"] for r in conditions.where("attr is null").select("value").distinct().collect()]
    tests = {}
    for text in sorted(t for t in texts if t is not None):
        try:
            test = condition_test(text)
            if rows.select(test.alias("test")).schema["test"].dataType.simpleString() == "boolean":
                tests[text] = test
        except (ValueError, AnalysisException):
            continue
    known, entries = sorted(tests), None
    for at in range(0, len(known), TEXTS):
        held = [F.when(tests[t], F.lit(t)) for t in known[at : at + TEXTS]]
        part = rows.select(
            *row, F.lit(HOLDS).alias("attr"), F.explode(F.array_compact(F.array(*held))).alias("value")
        )
        entries = part if entries is None else entries.unionAll(part)
    if entries is None:
        empty = F.lit(None).cast("string")
        entries = rows.select(*row, empty.alias("attr"), empty.alias("value")).where("false")
    decided = F.col("attr").isNull() & F.col("value").isin(known)
    return entries, conditions.withColumn("attr", F.when(decided, HOLDS).otherwise(F.col("attr")))


def match_rules(
    attributes: DataFrame,
    conditions: DataFrame,
    row: Sequence[str],
    rule: Sequence[str],
    unique: bool = False,
    rows: DataFrame | None = None,
) -> DataFrame:
    """(row..., rule...) pairs in which every condition of the rule holds.

    ``attributes``: row..., attr, value. ``conditions``: rule..., attr, value. With ``rows``, the same rows with a
    column for each attribute, conditions of any form are decided (:func:`decide_conditions`); without, a rule
    with a condition that is no equality (null ``attr``) is left out. Rules without conditions are
    :func:`free_rules`.

    Every rule is sought by the one of its conditions that the fewest rows meet, and only the rows found
    that way are held against its other conditions. With ``unique`` a row has an attribute once, and equal
    entries need not be merged.
    """
    row, rule = list(row), list(rule)
    held = attributes.select(*row, "attr", "value")
    if rows is not None:
        entries, conditions = decide_conditions(rows, conditions, row)
        held = held.unionByName(entries)
    if not unique:
        held = held.distinct()
    left_out = conditions.where("attr is null").select(*rule).distinct()
    wanted = (
        conditions.where("attr is not null")
        .select(*rule, "attr", "value")
        .distinct()
        .join(left_out, rule, "left_anti")
    )
    pairs = wanted.select("attr", "value").distinct()
    seen = (
        held.join(pairs, ["attr", "value"], "left_semi")
        .groupBy("attr", "value")
        .agg(F.count(F.lit(1)).alias("_seen"))
    )
    leading = (
        wanted.join(seen, ["attr", "value"], "left")
        .groupBy(*rule)
        .agg(
            F.min(F.struct(F.coalesce("_seen", F.lit(0)).alias("_seen"), "attr", "value")).alias("_lead"),
            F.count(F.lit(1)).alias("_needed"),
        )
        .select(*rule, "_needed", "_lead.attr", "_lead.value")
    )
    likely = held.join(leading, ["attr", "value"]).select(*row, *rule, "_needed")
    rest = likely.where("_needed > 1").join(wanted, rule)
    met = (
        rest.join(held, [*row, "attr", "value"])
        .groupBy(*row, *rule, "_needed")
        .agg(F.count(F.lit(1)).alias("_met"))
        .where(F.col("_met") == F.col("_needed"))
    )
    return likely.where("_needed = 1").select(*row, *rule).unionAll(met.select(*row, *rule))
