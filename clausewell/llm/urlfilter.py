"""URL filters with redirect equivalence, in DataFrame operations only.

Rules name a host (with all its subdomains) and a path prefix; the longest that fits
decides.  Urls without a rule follow their aliases: redirect and canonical-link
edges are closed into components, and a blocked member blocks every alias that has
no rule of its own and whose page is not allowed by a rule.  So an explicit allow
always wins for the page it names.

A page is known by its url as browsers ask for it: no fragment, scheme and host in lower
case, no default port, no dot segments, a path of at least ``/``; two urls are aliases
only where an edge says so.  Edges come from the first ``<link rel=canonical>``, the first
``<meta http-equiv=refresh>`` if its delay is under a second and, if given, a table of
redirects.  Comments and scripts hold no links; links are seen from ``<base href>``.  Ends
of edges are judged by the rules whether or not they are pages, so a block spreads over
urls that were never fetched.

Edge cases: a null url or one without ``://`` has empty host and path, no rule, and
is allowed; repeated rows each get a row; rules that tie in length: allow wins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .common import materialize
from .graph import connected_components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: More rules than this are joined, not written into the expression.
MOST_INLINE = 64


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` segments taken out.

    Only what lies between two ``..`` is handled step by step, so the cost is that of the
    path once for each ``..``.
    """
    parts = F.split(F.regexp_replace(path, r"(?<=/)\.(?:/|\z)", ""), r"(?<=/)\.\.(?:/|\z)", -1)
    parent = lambda p: F.when(p == "/", p).otherwise(F.left(p, F.length(p) - F.length(F.substring_index(p, "/", -2))))
    short = F.aggregate(F.slice(parts, 2, F.size(parts)), F.element_at(parts, 1), lambda done, part: F.concat(parent(done), part))
    return F.when(path.contains("/."), short).otherwise(path)


def page_key(url: Column) -> Column:
    """The url as redirects see it; null if it has no host."""
    scheme = ascii_lower(F.regexp_extract(url, r"^(.*?)://", 1))
    port = F.when(scheme == "http", F.regexp_replace(host_of(url), r":(?:80)?\z", "")).when(scheme == "https", F.regexp_replace(host_of(url), r":(?:443)?\z", ""))
    path = F.when(path_of(url) == "", F.lit("/")).otherwise(without_dots(path_of(url)))
    query = F.regexp_extract(after_scheme(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(scheme, F.lit("://"), F.coalesce(port, host_of(url)), path, query))


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), where f uses the value many times and it is a long expression."""
    return F.element_at(F.transform(F.array(value), f), 1)


def resolve(link: Column, url: Column) -> Column:
    """A link as an absolute url, seen from ``url``; null if it names no place on the web
    (``mailto:`` and the like)."""
    scheme = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    root = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.regexp_extract(path_of(url), r"^(.*/)", 1)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.startswith("?"), F.concat(root, path_of(url), link))
        .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), link))
    )


#: What a browser doesn't read as markup, and the tags that make edges.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script|\z)"
CANONICAL = r"""(?is)<link\b[^>]*[\s"']rel\s*=\s*(?:"(?:[^">]*\s)?canonical[\s"]|'(?:[^'>]*\s)?canonical[\s']|canonical[\s>/])[^>]*>?"""
REFRESH = r"""(?is)<meta\b[^>]*[\s"']http-equiv\s*=\s*["']?refresh\b[^>]*>"""
BASE = r"""(?is)<base\b[^>]*[\s"']href\s*=[^>]*>"""
HREF = r"""(?i)[\s"']href\s*=\s*["']?\s*([^"'\s>]+)"""
AT_ONCE = r"""(?i)[\s"']content\s*=\s*["']?\s*0+(?:\.[0-9]*)?[\s;,]\s*url\s*=\s*["']?\s*([^"'\s>]+)"""


def alias_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst) page keys joined by a canonical link or an immediate refresh."""
    attribute = lambda tag, name: F.regexp_replace(F.regexp_extract(F.regexp_extract("html", tag, 0), name, 1), "&amp;", "&")
    linked = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html")).where(F.col("html").rlike("(?i)canonical|refresh"))
    seen = linked.select("url", F.regexp_replace("html", HIDDEN, "").alias("html"))
    tags = seen.select("url", attribute(BASE, HREF).alias("base"), F.filter(F.array(attribute(CANONICAL, HREF), attribute(REFRESH, AT_ONCE)), lambda x: x != "").alias("links"))
    found = tags.select("url", F.when(F.col("base") == "", F.col("url")).otherwise(F.coalesce(resolve(F.col("base"), F.col("url")), "url")).alias("base"), F.explode("links").alias("link"))
    ends = found.select(page_key(F.col("url")).alias("src"), bound(resolve(F.col("link"), F.col("base")), page_key).alias("dst"))
    return ends.where("src is not null and dst is not null and src <> dst")


def match_rules(pages: DataFrame, rules: list[tuple[str, str, str]], host: str = "host", path: str = "path") -> DataFrame:
    """Add rule (like ``net/``; null if none fits) and rule_verdict.

    ``rules`` holds (verdict, host, path).  Up to MOST_INLINE become one expression
    without a shuffle; more are joined on the host's suffixes.
    """
    if len(rules) > MOST_INLINE:
        return _join_rules(pages, rules, host, path)
    fits = [F.when(((F.col(host) == h) | F.col(host).endswith("." + h)) & F.col(path).startswith(p), F.struct(F.lit(len(h) + len(p)).alias("size"), F.lit(int(v == "allow")).alias("allow"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in rules]
    best = F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<size:int,allow:int,rule:string,verdict:string>")
    return pages.withColumn("_best", best).withColumns({"rule": F.col("_best.rule"), "rule_verdict": F.col("_best.verdict")}).drop("_best")


def _join_rules(pages: DataFrame, rules: list[tuple[str, str, str]], host: str, path: str) -> DataFrame:
    table = pages.sparkSession.createDataFrame([(v, h, p, len(h) + len(p), int(v == "allow")) for v, h, p in rules], "verdict string, rule_host string, rule_path string, size int, allow int")
    known = pages.select(F.col(host).alias("_h"), F.col(path).alias("_p")).distinct()
    labels = F.split("_h", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fit = known.select("_h", "_p", F.explode(suffixes).alias("rule_host")).join(table, "rule_host").where(F.col("_p").startswith(F.col("rule_path")))
    best = fit.groupBy("_h", "_p").agg(F.max(F.struct("size", "allow", F.concat("rule_host", "rule_path").alias("rule"), "verdict")).alias("_best"))
    joined = pages.join(best, (F.col(host) == F.col("_h")) & (F.col(path) == F.col("_p")), "left")
    return joined.select(*pages.columns, F.col("_best.rule").alias("rule"), F.col("_best.verdict").alias("rule_verdict"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], redirects: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict, component) of every row.

    ``redirects``: optional table of urls (source_url, target_url).
    """
    url = F.col("url")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rows = match_rules(rows.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), page_key(url).alias("node")), rules)
    links = alias_links(pages, url_col, html_col)
    if redirects is not None:
        ends = redirects.select(page_key(F.col("source_url")).alias("src"), page_key(F.col("target_url")).alias("dst"))
        links = links.union(ends.where("src is not null and dst is not null"))
    # What rules say of each end of an edge, then of each component.
    roots = connected_components(links, "url-aliases")
    ends = match_rules(roots.select("node", "component", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path")), rules)
    blocked = ends.groupBy("component").agg(F.coalesce(F.bool_or(F.col("rule_verdict") == "block"), F.lit(False)).alias("blocked"))
    aliases = materialize(roots.join(blocked, "component").select(F.col("node").alias("alias"), "component", "blocked"), "url-aliases")
    # Rows without a node meet nothing; a number spreads them over all tasks.
    rows = rows.withColumn("meets", F.coalesce("node", F.concat(F.lit(" "), (F.monotonically_increasing_id() % 4096).cast("string"))))
    verdict = F.coalesce("rule_verdict", F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow")))
    joined = rows.join(aliases, F.col("meets") == F.col("alias"), "left")
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.coalesce("component", "node").alias("component"))
