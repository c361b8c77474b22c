"""URL rules and redirect equivalence (operator 9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.llm.components import components
from flowtables.llm.license_scan import once
from flowtables.session import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"
# Character references and the sign each stands for; that of the ampersand is read last.
REFERENCES = (
    ("quot|#34|#x22", '"'), ("apos|#39|#x27", "'"), ("lt|#60|#x3c", "<"), ("gt|#62|#x3e", ">"),
    ("sol|#47|#x2f", "/"), ("colon|#58|#x3a", ":"), ("equals|#61|#x3d", "="), ("quest|#63|#x3f", "?"),
    ("period|#46|#x2e", "."), ("num|#35|#x23", "#"), ("amp|#38|#x26", "&"),
)
ATTRIBUTE = r"""\s*=\s*["']?([^"'\s>]+)"""


def _after_scheme(url: Column) -> Column:
    start = F.instr(url, "://")
    return F.when(start > 0, F.substr(url, start + F.lit(3)))


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def unescaped(value: Column) -> Column:
    """An attribute with the character references that addresses have in them read."""
    for codes, sign in REFERENCES:
        value = F.regexp_replace(value, f"(?i)&(?:{codes});", sign)
    return value


def _tag(html: Column, name: str, needed: str) -> Column:
    return F.regexp_extract(html, rf"(?i)(<{name}\b[^>]*{needed}[^>]*>)", 1)


def _href(tag: Column) -> Column:
    found = F.regexp_extract(tag, rf"(?i)\bhref{ATTRIBUTE}", 1)
    return F.when(found != "", unescaped(found))


def canonical(html: Column) -> Column:
    """Target of the page's canonical link, or null."""
    return _href(_tag(html, "link", r"\brel\s*=\s*[\"']?canonical\b"))


def base(html: Column) -> Column:
    """What the page names as the base of its links, or null."""
    return _href(_tag(html, "base", r"\bhref\b"))


def redirect(html: Column) -> Column:
    """Target of the page's refresh redirect, or null."""
    tag = _tag(html, "meta", r"\bhttp-equiv\s*=\s*[\"']?refresh\b")
    found = F.regexp_extract(tag, r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)""", 1)
    return F.when(found != "", unescaped(found))


def resolved(url: Column, target: Column) -> Column:
    """A link's target as a full address; a path is taken from the page's scheme and host."""
    root = F.regexp_extract(url, r"^[^:/?#]*://[^/?#]*", 0)
    scheme = F.regexp_extract(url, r"^[^:/?#]*:", 0)
    folder = F.regexp_extract(url, r"^([^:/?#]*://[^/?#]*)([^?#]*/)?", 0)
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, target))
        .when(target.startswith("/"), F.concat(root, target))
        .when(target.startswith("#") | target.startswith("?"), F.concat(F.regexp_extract(url, "^[^?#]*", 0), target))
        .otherwise(F.concat(folder, F.when(folder.endswith("/"), "").otherwise("/"), target))
    )


def without_dots(path: Column) -> Column:
    """A path without the segments ``.`` and ``..``, which go with the one before them."""
    parts = F.split(F.substr(path, F.lit(2)), "/")
    inside = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda kept, part: F.when(part == ".", kept)
        .when(part == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))))
        .otherwise(F.array_append(kept, part)),
    )
    whole = F.concat(F.lit("/"), F.array_join(inside, "/"))
    folder = path.rlike(r"/\.\.?$") & (F.size(inside) > 0)
    return F.when(path.contains("/."), F.concat(whole, F.when(folder, "/").otherwise(""))).otherwise(path)


def address(url: Column) -> Column:
    """The node of a url: host in lower case without the port its scheme has anyway, path without dot
    segments, and query; scheme and fragment do not count."""

    def joined(said: Column) -> Column:
        url, host, path = said["url"], said["host"], said["path"]
        query = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)?", 1)
        usual = url.rlike(r"^(?i)(http://[^/?#]*:80|https://[^/?#]*:443|https?://[^/?#]*:)([/?#]|$)")
        plain = F.when(usual, F.regexp_replace(host, ":[0-9]*$", "")).otherwise(host)
        folder = F.when(path == "", "/").otherwise(without_dots(path))
        return F.when(plain != "", F.concat(plain, folder, F.coalesce(query, F.lit(""))))

    parts = F.struct(url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    return once(parts, joined)


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``rule`` and ``verdict`` of the longest fitting rule to distinct (``host``, ``path``).

    A rule (``host``, ``path``, ``verdict``) fits its host and all subdomains where the path starts with
    the rule's. Every host is looked up under each of its suffixes, so rules are found by an equi-join.
    The longest host with path wins, then the rule that comes first, ``allow`` before ``block``.
    """
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    fitting = rules.select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("verdict").alias("_verdict")
    )
    name = F.concat("_host", "_path")
    best = (
        urls.select("host", "path", F.explode(suffixes).alias("_host"))
        .join(fitting, "_host")
        .where(F.col("path").startswith(F.col("_path")))
        .groupBy("host", "path")
        .agg(F.min(F.struct(-F.length(name), name.alias("rule"), "_verdict")).alias("best"))
    )
    return urls.join(
        best.select("host", "path", "best.rule", F.col("best._verdict").alias("verdict")),
        ["host", "path"],
        "left",
    )


def links(pages: DataFrame) -> DataFrame:
    """Edges (``u``, ``v``) between the addresses of pages and their redirect and canonical targets."""
    html, named = F.col("html"), F.col("named")
    # step by step, so that each part is worked out once and the plan stays small
    ends = pages.where("url is not null and html is not null").select(
        "url", base(html).alias("named"), F.array(canonical(html), redirect(html)).alias("targets")
    )
    ends = ends.select(
        "url",
        F.when(named.isNull(), F.col("url")).otherwise(resolved(F.col("url"), named)).alias("base"),
        F.explode(F.array_compact("targets")).alias("target"),
    )
    ends = ends.select("url", resolved(F.col("base"), F.col("target")).alias("target"))
    return ends.select(address(F.col("url")).alias("u"), address(F.col("target")).alias("v")).where(
        "u is not null and v is not null and u <> v"
    )


def filter_urls(pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """All rows and columns of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    A url with a fitting rule has that rule's verdict: an explicit ``allow`` holds even among blocked
    aliases. A url without a rule is blocked if an address equivalent to it is blocked by a rule and none is
    explicitly allowed; else it is allowed. Addresses are equivalent if redirects and canonical links
    (``edges``: columns ``u`` and ``v`` of addresses; by default those in ``html``) connect them in any number of
    steps, also through addresses that are no page; targets are judged by the rules as well.

    A null url, or one without ``://``, has empty host and path, no rule, and is allowed. Rows that repeat
    are judged alike. Columns of ``pages`` named like an added one are replaced.
    """
    url = F.col("url")
    rows = pages.drop("host", "path", "rule", "verdict", "_node", "_spread").withColumns(
        {"host": host_of(url), "path": path_of(url)}
    )
    found = cut((links(pages) if edges is None else edges).select("u", "v").distinct())
    groups = components(found, "u", "v")
    nodes = groups.select(
        "root",
        F.regexp_extract("node", r"^[^/?#]*", 0).alias("host"),
        F.regexp_extract("node", r"^[^/?#]*([^?#]*)", 1).alias("path"),
    )
    keys = rows.select("host", "path").unionAll(nodes.select("host", "path")).distinct()
    decided = cut(ruled(keys, rules).where("rule is not null"))
    judged = (
        nodes.join(decided, ["host", "path"])
        .groupBy("root")
        .agg(
            F.bool_or(F.col("verdict") == BLOCK).alias("blocked"),
            F.bool_or(F.col("verdict") == ALLOW).alias("allowed"),
        )
        .where("blocked and not allowed")
    )
    aliases = groups.join(judged, "root").select(
        F.col("node").alias("_node"), F.lit(BLOCK).alias("_spread")
    )
    return (
        rows.join(decided, ["host", "path"], "left")
        .withColumn("_node", address(url))
        .join(aliases, "_node", "left")
        .withColumn("verdict", F.coalesce("verdict", "_spread", F.lit(ALLOW)))
        .select(*rows.columns, "rule", "verdict")
    )
