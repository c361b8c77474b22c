"""Line deduplication by a fixed-depth log-template tree (operator 10), DataFrame functions only.

A line's path in the tree is its number of tokens and its leading tokens, with runs of digits as
``<*>``. Within a leaf a position keeps a token that enough documents have there and becomes ``<*>``
otherwise, so lines that differ in variable fields share a template. Templates found in enough
documents are dropped everywhere but in the document of the smallest id; long lines are dropped from two
documents on, if they are the same but for digits.

Every text is turned into numbers and hashes of its lines in one pass. Tokens are read again, as hashes, from
one line of each variant whose leaf holds others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.llm.words import GAP, word_list
from flowtables.operators.spread import small
from flowtables.session import split_skew, stored

MIN_DOCS = 3
MIN_TOKENS = 5
DEPTH = 3
CONSTANT = 50
# Tokens of a line that is dropped from two documents on.
LONG_TOKENS = 50
# Most variable fields, as a percentage of the positions behind the path, of a line that keeps fewer than
# SURE of those positions.
VARIABLE = 25
SURE = 20
FIELD = "<*>"
KEYS = 1_000_000
LAST = (1 << 63) - 1


def _alike(behind: Column, variable: Column, constant: int) -> Column:
    """Whether lines of a template are alike in what their path does not fix."""
    kept = behind - variable
    few = 100 * variable <= VARIABLE * behind
    return (100 * kept >= constant * behind) & (few | (kept >= SURE))


def _masked_lines(text: Column) -> Column:
    return F.split(F.regexp_replace(text, "[0-9]+", FIELD), "\n")


def _row_key() -> list[Column]:
    """Document and mark of its text; rows without an id are one document that comes last."""
    return [
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc"),
        F.xxhash64("text").alias("mark"),
    ]


def _lines(docs: DataFrame, min_tokens: int, depth: int) -> DataFrame:
    """(doc, mark, line_no, size, leaf, va, vb, id): one row per line, known by hashes of its tokens."""
    tokens = F.transform(_masked_lines(F.col("text")), word_list)
    hashed = F.transform(
        tokens,
        lambda t, i: F.struct(
            i.alias("line_no"),
            F.size(t).alias("size"),
            F.when(
                F.size(t) >= min_tokens,
                F.struct(
                    F.xxhash64(F.size(t), F.slice(t, 1, depth)).alias("leaf"),
                    F.xxhash64(t).alias("va"),
                    F.xxhash64(F.lit(1), t).alias("vb"),
                ),
            ).alias("h"),
        ),
    )
    whole = docs.where("text is not null").select(
        *_row_key(), F.filter(hashed, lambda x: x["size"] >= min_tokens).alias("lines")
    )
    return stored(
        whole.select("doc", "mark", F.inline("lines")).select(
            "doc", "mark", "line_no", "size", "h.*", F.monotonically_increasing_id().alias("id")
        ),
        "lines",
    )


def _one_row_each(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """``docs``, once for each id and text if rows repeat both."""
    first = lines.groupBy("doc", "mark").agg(F.min("line_no").alias("line_no"))
    repeated = (
        lines.join(first, ["doc", "mark", "line_no"], "left_semi")
        .groupBy("doc", "mark")
        .agg(F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
    )
    return docs.dropDuplicates(["doc", "mark"]) if repeated.take(1) else docs


def _templates(
    docs: DataFrame, lines: DataFrame, variants: DataFrame, min_docs: int, depth: int, constant: int
) -> DataFrame:
    """(vid, leaf, template) of the variants whose leaf has enough in common with them."""
    mixed = (
        variants.groupBy("leaf")
        .agg(F.count(F.lit(1)).alias("k"), F.sum("docs").alias("all_docs"))
        .where((F.col("k") > 1) & (F.col("all_docs") >= min_docs))
    )
    wanted = stored(
        variants.join(mixed.select("leaf"), "leaf")
        .groupBy("doc", "mark")
        .agg(F.collect_list(F.struct("line_no", "vid", "docs", "leaf")).alias("wanted")),
        "wanted",
    )
    # keys of 16 bytes, broadcast up to KEYS of them: only texts with a wanted line are moved
    keys = small(wanted.select("doc", "mark"), KEYS)
    texts = docs.where("text is not null").select(*_row_key(), "text")
    texts = texts.join(keys, ["doc", "mark"], "left_semi")
    rows = _one_row_each(texts, lines).join(wanted, ["doc", "mark"])

    def marked(w: Column) -> Column:
        tokens = word_list(F.get("lines", w["line_no"]))
        return F.transform(
            tokens,
            lambda t, i: F.struct(
                w["vid"].alias("vid"),
                w["docs"].alias("docs"),
                # place and token; the last bit tells a field
                F.xxhash64(w["leaf"], i, t)
                .bitwiseAND(F.lit(-2))
                .bitwiseOR((t == FIELD).cast("bigint"))
                .alias("h"),
            ),
        )

    split = rows.select("wanted", _masked_lines(F.col("text")).alias("lines"))
    placed = stored(split.select(F.inline(F.flatten(F.transform("wanted", marked)))), "tokens")
    usual = (
        placed.groupBy("h").agg(F.sum("docs").alias("support")).where(F.col("support") >= min_docs)
    )
    kept = placed.join(usual.select("h"), "h").groupBy("vid").agg(
        F.count(F.lit(1)).alias("fixed"),
        # fields are the same whether enough documents have them or not
        F.bit_xor(F.when(F.col("h") % 2 == 0, F.col("h"))).alias("template"),
    )
    n, variable = F.col("size"), F.col("size") - F.col("fixed")
    return (
        variants.select("vid", "leaf", "size")
        .join(kept, "vid")
        .where(100 * F.col("fixed") >= constant * n)
        .where(_alike(n - depth, variable, constant))
        .select("vid", "leaf", F.coalesce("template", F.lit(0)).alias("template"))
    )


def dropped_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_tokens: int = MIN_TOKENS,
    depth: int = DEPTH,
    constant: int = CONSTANT,
    long_tokens: int = LONG_TOKENS,
) -> DataFrame:
    """(doc, mark, line_no) of the lines to drop."""
    lines = _lines(docs, min_tokens, depth)
    variant = ["leaf", "va", "vb"]
    variants = stored(
        lines.groupBy(*variant, "size").agg(
            F.countDistinct("doc").alias("docs"),
            F.min("doc").alias("first"),
            F.min("id").alias("vid"),
            # one of its lines
            *[F.min_by(c, "id").alias(c) for c in ("doc", "mark", "line_no")],
        ),
        "variants",
    )
    templates = stored(_templates(docs, lines, variants, min_docs, depth, constant), "templates")
    named = variants.select(*variant, "vid").join(templates.drop("leaf"), "vid").drop("vid")
    shared = (
        lines.select(*variant, "doc")
        .join(named, variant)
        .groupBy("leaf", "template")
        .agg(F.countDistinct("doc").alias("docs"), F.min("doc").alias("first"))
        .where(F.col("docs") >= min_docs)
    )
    by_template = named.join(shared, ["leaf", "template"]).select(*variant, "first")
    enough = (F.col("docs") >= min_docs) | ((F.col("docs") > 1) & (F.col("size") >= long_tokens))
    by_variant = variants.where(enough).join(by_template, variant, "left_anti")
    recurring = stored(by_template.unionByName(by_variant.select(*variant, "first")), "recurring")
    return lines.join(recurring, variant).where("doc <> first").select("doc", "mark", "line_no")


def dedup_lines(docs: DataFrame, **limits: int) -> DataFrame:
    """All rows and columns of ``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped``.

    Lines are what a split at line feeds gives. A line of at least ``min_tokens`` tokens is dropped if its
    template is found in ``min_docs`` documents or more and its own document is not the one of the smallest
    id among them. A leaf's position keeps tokens whose lines stand in ``min_docs`` documents; if fewer
    than ``constant`` percent of a line's positions keep theirs, the line stands for itself. So it does if that
    holds for the positions behind its path, which are not equal by the leaf alone, or if more than
    ``VARIABLE`` percent of these vary and fewer than ``SURE`` are kept. Digits are fields from the start.
    If its template is not found in enough documents, a line of ``long_tokens`` tokens or more is dropped from
    two documents on that have it, again but for the document of the smallest id.

    Null text has no lines and stays null. Rows that repeat a ``doc_id`` count as one document, rows without
    one as one that comes last. Columns of ``docs`` may have any name; those named like an added one are
    replaced.
    """
    split_skew(docs.sparkSession)
    drops = dropped_lines(docs, **limits).groupBy("doc", "mark").agg(
        F.collect_set("line_no").alias("gone")
    )
    added = ("kept_text", "n_lines", "n_dropped")
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("row"), "text", *_row_key())
    whole = F.split("text", "\n")
    places = F.sequence(F.lit(0), F.size(whole) - 1)
    left = F.transform(F.array_except(places, "gone"), lambda i: F.get("whole", i))
    joined = rows.join(drops.hint("merge"), ["doc", "mark"], "left").select(
        "row", "text", "gone", whole.alias("whole")
    )
    return joined.select(
        *[F.col("text" if c == "text" else f"row.`{c}`") for c in docs.columns if c not in added],
        F.when(F.col("gone").isNull(), F.col("text"))
        .otherwise(F.array_join(left, "\n"))
        .alias("kept_text"),
        F.coalesce(F.size("whole"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.array_size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )


def has_words(text: Column) -> Column:
    return F.coalesce(F.length(F.regexp_replace(text, GAP, "")) > 0, F.lit(False))
