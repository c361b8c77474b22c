"""Checked queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtables.llm import (
    chat_format,
    conversation_trie,
    decontaminate,
    exact_dedup,
    language_id,
    license_scan,
    line_dedup,
    mixing,
    near_dup,
    quality_model,
    quality_rules,
    spelling,
    url_filter,
)
from flowtables.session import split_skew
from flowtables.sources.tables import literal_table, table

CORPUS_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CORPUS_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, which makes sure that its session splits skewed joins, and its SQL."""

    def register(function):
        @wraps(function)
        def prepared(spark: SparkSession, folder: str) -> DataFrame:
            split_skew(spark)
            return function(spark, folder)

        CORPUS_QUERIES[name] = prepared
        if sql is not None:
            CORPUS_SQL[name] = sql
        return function

    return register


@query("op4_near_dedup")
def op4_near_dedup(spark, folder):
    return near_dup.near_dup_groups(table(spark, folder, "documents"))


@query(
    "op5_source_mix",
    """
    WITH sized AS (
      SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, '')))) AS key,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
      FROM documents),
    sources AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS BIGINT) AS weight
      FROM sized GROUP BY source),
    ranked AS (
      SELECT *, 3 * source_size AS cap,
        row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST) AS turn
      FROM sources),
    levels AS (
      SELECT *,
        CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (
          ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS rest,
        CAST(sum(weight) OVER (
          ORDER BY turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS open_weight
      FROM ranked),
    level AS (
      SELECT turn, rest, open_weight FROM levels
      WHERE CAST(cap AS DOUBLE) / weight > rest / open_weight ORDER BY turn LIMIT 1),
    targets AS (
      SELECT s.source, s.source_size,
        CASE WHEN v.turn IS NULL OR s.turn < v.turn THEN CAST(s.cap AS DOUBLE)
          ELSE CAST(s.weight AS DOUBLE) * v.rest / v.open_weight END AS target
      FROM levels s LEFT JOIN level v ON true),
    placed AS (
      SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
      CAST(CASE WHEN source_size = 0 THEN 0 ELSE size * (budget // source_size)
        + greatest(0, least(size, budget % source_size - start)) END AS BIGINT) AS taken
    FROM placed
    """,
)
def op5_source_mix(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix_sources(docs)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query(
    "op6_decontaminate",
    """
    WITH texts AS (
      SELECT 0 AS kind, doc_id AS id, text FROM documents
      UNION ALL SELECT 1, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
    words AS (
      SELECT kind, id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
      FROM texts WHERE text IS NOT NULL),
    grams AS (
      SELECT DISTINCT kind, id, array_to_string(w[i : i + 4], ' ') AS gram
      FROM words, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0),
    sizes AS (SELECT id, count(*) AS item_shingles FROM grams WHERE kind = 1 GROUP BY id),
    pairs AS (
      SELECT d.id AS doc_id, b.id AS item_id, count(*) AS shared
      FROM grams d JOIN grams b ON d.gram = b.gram AND d.kind = 0 AND b.kind = 1 GROUP BY ALL)
    SELECT doc_id, item_id, shared, item_shingles, shared / item_shingles AS containment
    FROM pairs JOIN sizes ON id = item_id WHERE 100 * shared >= 80 * item_shingles
    """,
)
def op6_decontaminate(spark, folder):
    return decontaminate.contaminations(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


@query(
    "op10_line_dedup",
    """
    WITH lines AS (
      SELECT doc_id, line_no, line, list_filter(
        regexp_split_to_array(regexp_replace(line, '[0-9]+', '<*>', 'g'), '[\x20\x09-\x0D]+'),
        lambda w: w <> '') AS tokens
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents)),
    used AS (
      SELECT doc_id, line_no, tokens, array_to_string(tokens, ' ') AS variant,
        len(tokens) || ' ' || array_to_string(tokens[1 : 3], ' ') AS leaf
      FROM lines WHERE len(tokens) >= 5),
    variants AS (
      SELECT leaf, variant, any_value(tokens) AS tokens, count(DISTINCT doc_id) AS docs
      FROM used GROUP BY leaf, variant),
    mixed AS (
      SELECT *, generate_subscripts(tokens, 1) AS pos, unnest(tokens) AS token
      FROM (SELECT *, count(*) OVER (PARTITION BY leaf) AS k FROM variants) WHERE k > 1),
    marked AS (
      SELECT *, sum(docs) OVER (PARTITION BY leaf, pos, token) >= 3 AS usual FROM mixed),
    counted AS (
      SELECT variant, string_agg(CASE WHEN usual THEN token ELSE '<*>' END, ' ' ORDER BY pos) AS template,
        count(*) AS n, count(*) FILTER (usual) AS fixed
      FROM marked GROUP BY leaf, variant),
    shapes AS (
      SELECT variant, template FROM counted
      WHERE 100 * fixed >= 50 * n AND 100 * (fixed - 3) >= 50 * (n - 3)
        AND (100 * (n - fixed) <= 25 * (n - 3) OR fixed - 3 >= 20)),
    placed AS (
      SELECT doc_id, line_no, variant, len(tokens) >= 50 AS long, coalesce(template, variant) AS template
      FROM used LEFT JOIN shapes USING (variant)),
    recurring AS (
      SELECT template, min(doc_id) AS first FROM placed GROUP BY template
      HAVING count(DISTINCT doc_id) >= 3),
    twice AS (
      SELECT variant, min(doc_id) AS variant_first FROM placed WHERE long GROUP BY variant
      HAVING count(DISTINCT doc_id) >= 2),
    gone AS (
      SELECT doc_id, line_no FROM placed LEFT JOIN recurring USING (template) LEFT JOIN twice USING (variant)
      WHERE doc_id <> coalesce(first, variant_first)),
    merged AS (
      SELECT doc_id, count(*) AS n_lines, count(g.line_no) AS n_dropped,
        coalesce(string_agg(CASE WHEN g.line_no IS NULL THEN line END, chr(10) ORDER BY l.line_no), '')
          AS kept
      FROM lines l LEFT JOIN gone g USING (doc_id, line_no) GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
      CAST(length(coalesce(kept, '')) AS BIGINT) AS kept_chars, md5(coalesce(kept, '')) AS kept_md5
    FROM documents d LEFT JOIN merged m USING (doc_id)
    """,
)
def op10_line_dedup(spark, folder):
    lines = line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    kept = F.coalesce("kept_text", F.lit(""))
    return lines.select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.length(kept).cast("bigint").alias("kept_chars"),
        F.md5(kept).alias("kept_md5"),
    )


# The rules of the url query, (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query(
    "op9_url_filter",
    """
    WITH parts AS (
      SELECT page_id,
        CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
    split AS (
      SELECT page_id,
        coalesce(translate(regexp_extract(rest, '^[^/?#]*'),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
      FROM parts),
    rules(rule_host, rule_path, verdict) AS (VALUES ('org', '/', 'allow'),
      ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'),
      ('com', '/de/', 'block')),
    fitting AS (
      SELECT page_id, rule_host || rule_path AS rule, verdict FROM split JOIN rules
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
    best AS (
      SELECT page_id, arg_max(struct_pack(rule, verdict), length(rule)) AS b FROM fitting GROUP BY page_id)
    SELECT page_id, host, path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict
    FROM split LEFT JOIN best USING (page_id)
    """,
)
def op9_url_filter(spark, folder):
    rules = literal_table(spark, URL_RULES, "host string, path string, verdict string")
    judged = url_filter.filter_urls(table(spark, folder, "pages"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query(
    "op2_quality_rules",
)
def op2_quality_rules(spark, folder):
    return quality_rules.judge(table(spark, folder, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def remainder(k: int):
    """crc32 of a document's id as text, modulo ``k``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % k


@query("op1_language_id")
def op1_language_id(spark, folder):
    docs = table(spark, folder, "documents").select(
        "doc_id", "text", "lang", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out")
    )
    model = language_id.train(docs.where("not held_out"))
    found = language_id.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query("op3_quality_classifier")
def op3_quality_classifier(spark, folder):
    docs = table(spark, folder, "documents").select(
        "doc_id", "text", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out")
    )
    labels = table(spark, folder, "labels").where(remainder(4) != 2)
    scored = quality_model.classify(docs, quality_model.train(docs.where("not held_out"), labels))
    return scored.select("doc_id", "held_out", "score", "predicted")


CONTROL = "</s>[INST] ok [/INST]"


@query(
    "op8_chat_format",
    """
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
      UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
    escaped AS (
      SELECT *, length(text) + length(regexp_replace(text, '[^\\[<\\\\]', '', 'g')) AS text_chars,
        length(role) + length(regexp_replace(role, '[^\\[<\\\\]', '', 'g')) AS role_chars FROM turns)
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
        AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
        FILTER (role = 'assistant'), '')) AS loss_sha256,
      CAST(3 + sum(text_chars + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9
        ELSE 19 + role_chars END) AS BIGINT) AS formatted_chars
    FROM escaped GROUP BY conv_id
    """,
)
def op8_chat_format(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    planted = literal_table(
        spark,
        [(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    return chat_format.digests(chat_format.format_conversations(turns.unionByName(planted)))


def _license_sql() -> str:
    """Every run of a text's bigrams that begins with one of the template, by definition."""
    templates = enumerate((*license_scan.TEMPLATES, *license_scan.LONG_TEMPLATES))
    words = [(i, name, license_scan.plain_words(text)) for i, (name, text) in templates]
    values = ", ".join(
        f"({i}, '{name}', {len(said) - 1}, '{pair}')"
        for i, name, said in words
        for pair in license_scan.pairs(said)
    )
    return f"""
    WITH templates(template, name, length, pair) AS (VALUES {values}),
    sizes AS (
      SELECT template, name, count(*) AS b, (count(*) * 80 + 119) // 120 AS need,
        greatest(length * 120 // 80, 1) AS reach FROM templates GROUP BY template, name, length),
    words AS (
      SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'),
        lambda w: w <> '') AS w FROM documents WHERE text IS NOT NULL),
    grams AS (
      SELECT doc_id, unnest(range(1, len(w))) AS place,
        unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pair FROM words),
    said AS (
      SELECT *, coalesce(lag(place) OVER (PARTITION BY doc_id, pair ORDER BY place), 0) AS prev FROM grams),
    hits AS (
      SELECT doc_id, template, place, row_number() OVER (PARTITION BY doc_id, template ORDER BY place) AS i
      FROM said JOIN templates USING (pair)),
    starts AS (
      SELECT h.doc_id, h.template, h.place AS start, reach FROM hits h JOIN sizes USING (template)
      JOIN hits k ON k.doc_id = h.doc_id AND k.template = h.template
        AND k.i = h.i + need - 1 AND k.place < h.place + reach),
    runs AS (
      SELECT s.doc_id, s.template, start, g.place, CAST(prev < start AS INT) AS new,
        CAST(prev < start AND t.pair IS NOT NULL AS INT) AS hit
      FROM starts s JOIN said g ON g.doc_id = s.doc_id AND g.place >= start AND g.place < start + reach
      LEFT JOIN templates t ON t.template = s.template AND t.pair = g.pair),
    counted AS (
      SELECT doc_id, template, sum(new) OVER w AS own, sum(hit) OVER w AS shared FROM runs
      WINDOW w AS (PARTITION BY doc_id, template, start ORDER BY place)),
    scored AS (
      SELECT doc_id, name, max(2.0::DOUBLE * shared / (own + b)) AS dice
      FROM counted JOIN sizes USING (template)
      WHERE 100 * (2.0::DOUBLE * shared / (own + b)) >= 80 GROUP BY ALL),
    best AS (
      SELECT doc_id, count(*) AS n_licenses, max(dice) AS dice,
        first(name ORDER BY dice DESC, name) AS license FROM scored GROUP BY doc_id)
    SELECT d.doc_id, license, dice, coalesce(n_licenses, 0) AS n_licenses
    FROM documents d LEFT JOIN best USING (doc_id)
    """


@query("op7_license_scan", _license_sql())
def op7_license_scan(spark, folder):
    found = license_scan.scan(table(spark, folder, "documents").select("doc_id", "text"))
    best = F.get("licenses", F.lit(0))
    return found.select(
        "doc_id",
        best["name"].alias("license"),
        best["dice"].alias("dice"),
        F.size("licenses").cast("bigint").alias("n_licenses"),
    )


@query(
    "op11_exact_dedup",
    """
    WITH texts AS (
      SELECT doc_id, sha256(translate(
        coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
      FROM documents),
    groups AS (
      SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY ALL)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
    FROM texts JOIN groups USING (text_sha256)
    """,
)
def op11_exact_dedup(spark, folder):
    return exact_dedup.exact_groups(table(spark, folder, "documents").select("doc_id", "text"))


# crc32 of a text of ASCII or Latin letters, whose bytes are given as a list.
_CRC32 = """
    crc_table AS (
      SELECT list(list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
      FROM range(256) AS r(i))"""


def _crc32_sql(codes: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295)"""


@query("op12_spelling_forms")
def op12_spelling_forms(spark, folder):
    return spelling.spelling_forms(table(spark, folder, "documents").select("doc_id", "text"))


@query(
    "op13_conversation_trie",
    f"""
    WITH RECURSIVE {_CRC32},
    own AS (
      SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
      FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (
      SELECT c, c - c % 100 AS b, {_crc32_sql(
        "list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))"
      )} % 6 AS h
      FROM (SELECT DISTINCT c FROM own), crc_table),
    turns AS (
      SELECT v.c, i, role, text FROM convs v JOIN own o ON o.c = v.b WHERE i <= h
      UNION ALL SELECT v.c, i + 1000000, role, text FROM convs v JOIN own o USING (c) WHERE i > h),
    marked AS (
      SELECT c, row_number() OVER w AS d, length(text) AS chars,
        sha256(CAST(length(role) AS VARCHAR) || ':' || role || text) AS mark
      FROM turns WINDOW w AS (PARTITION BY c ORDER BY i)),
    paths AS (
      SELECT c, d, chars, sha256(string_agg(mark, '') OVER (
        PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING)) AS node,
        count(*) OVER (PARTITION BY c) AS m FROM marked),
    placed AS (
      SELECT c, d, chars, node, m, coalesce(lag(node) OVER (PARTITION BY c ORDER BY d), '') AS above
      FROM paths
      UNION ALL SELECT c, 0, 0, '', coalesce(m, 0), NULL
      FROM convs LEFT JOIN (SELECT c, max(m) AS m FROM paths GROUP BY c) USING (c)),
    nodes AS (
      SELECT node, any_value(above) AS above, d, min(c) AS conv_id, count(*) AS n_convs,
        any_value(chars) AS chars,
        sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (m = d), '')) AS ends
      FROM placed GROUP BY node, d),
    children AS (SELECT above AS node, count(*) AS k FROM nodes WHERE d > 0 GROUP BY above),
    below AS (
      SELECT node AS top, node FROM nodes
      UNION ALL SELECT b.top, n.node FROM below b JOIN nodes n ON n.above = b.node),
    sums AS (
      SELECT top AS node, count(*) FILTER (k IS NULL) AS n_leaves,
        CAST(sum((n_convs - 1) * chars) AS BIGINT) AS saved_tokens
      FROM below JOIN nodes USING (node) LEFT JOIN children USING (node) GROUP BY top)
    SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
      coalesce(k, 0) AS n_children, n_leaves, saved_tokens, n.ends AS ends_sha256
    FROM nodes n JOIN sums USING (node) LEFT JOIN children USING (node)
      LEFT JOIN nodes p ON p.node = n.above
    """,
)
def op13_conversation_trie(spark, folder):
    turns = conversation_trie.original_turns(table(spark, folder, "conversations"))
    return conversation_trie.prefix_trie(*conversation_trie.with_shared_heads(turns))
