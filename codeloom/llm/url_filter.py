"""Operator 10: URL rules carried over redirects, with DataFrame operations only.

A page links to what it redirects to (``meta http-equiv=refresh``) and to its canonical URL
(``link rel=canonical``).  URLs that are the same but for scheme and fragment are one node.
The connected components of these links are groups of aliases.  A page that a rule fits gets
the verdict of its longest rule.  Any other page gets that of its component: allow if some
allow rule fits a URL of it, else block if some block rule does, else allow.

Defined results: host and path are empty for a null URL or one without ``://``, and such pages
have no aliases; a null html has no links; links to URLs that can't be resolved are ignored;
repeated rows are judged alike, a null page_id too; an empty table gives an empty result; of
two fitting rules of the same length the allowing one counts; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeloom.llm.components import connected_components
from codeloom.operators.broadcast import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path) of the contract's query.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
ALLOW, BLOCK = "allow", "block"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for null or without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def node_of(url: Column) -> Column:
    """A URL without scheme and fragment; null without a host."""
    query = F.regexp_extract(after_scheme(url), r"^[^?#]*(\?[^#]*)", 1)
    path = path_of(url)
    return F.when(host_of(url) != "", F.concat(host_of(url), F.when(path == "", "/").otherwise(path), query))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits as a struct (rule, verdict), or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == ALLOW)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def targets(html: Column) -> Column:
    """URLs (as written) of canonical links and refreshes."""
    html = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    tags = F.regexp_extract_all(html, F.lit(r"(?i)<(?:link|meta)\s[^>]*>"), F.lit(0))

    def attribute(tag: Column, name: str) -> Column:
        return F.coalesce(*[F.nullif(F.regexp_extract(tag, rf"(?i)\s{name}\s*=\s*{value}", 1), F.lit("")) for value in (r'"([^"]*)"', r"'([^']*)'", r"([^\s\"'>]+)")])

    def target(tag: Column) -> Column:
        canonical = F.when(F.lower(attribute(tag, "rel")).rlike(r"(^|\s)canonical(\s|$)"), attribute(tag, "href"))
        refresh = F.when(F.lower(attribute(tag, "http-equiv")) == "refresh", F.nullif(F.regexp_extract(attribute(tag, "content"), r"(?i)^\s*[0-9.]*\s*[;,]\s*url\s*=\s*['\"]?([^'\"]*)", 1), F.lit("")))
        return F.trim(F.replace(F.coalesce(canonical, refresh), F.lit("&amp;"), F.lit("&")))

    return F.filter(F.transform(tags, target), lambda x: x.isNotNull() & (x != ""))


def resolved(base: Column, link: Column) -> Column:
    """``link`` as a URL with scheme, seen from ``base``; null for other schemes than http and https."""
    start = F.concat(F.lit("http://"), host_of(base))
    folder = F.regexp_replace(path_of(base), r"[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    return (F.when(link.rlike(r"(?i)^https?://"), link)
            .when(link.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), F.lit(None))
            .when(link.startswith("//"), F.concat(F.lit("http:"), link))
            .when(host_of(base) == "", F.lit(None))
            .when(link.startswith("/"), F.concat(start, link))
            .when(link.startswith("?"), F.concat(start, path_of(base), link))
            .when(link.startswith("#"), F.lit(None))
            .otherwise(F.concat(start, folder, link)))


def alias_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Distinct links (a, b) of nodes."""
    may = F.col(f"`{html}`").rlike(r"(?i)canonical|http-equiv")
    links = pages.where(may).select(F.col(f"`{url}`").alias("from"), F.explode(targets(F.col(f"`{html}`"))).alias("link"))
    # Written between the steps, as the optimiser would put each step's patterns into the next one's, over and over.
    links = materialize(links, "page_links")
    links = materialize(links.select("from", resolved(F.col("from"), F.col("link")).alias("to")), "resolved_links")
    links = materialize(links.select(node_of(F.col("from")).alias("a"), node_of(F.col("to")).alias("b")), "node_links")
    return links.where("a is not null and b is not null and a != b").distinct()


def verdicts(pages: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", html: str = "html", page_id: str = "page_id") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict."""
    parts = connected_components(alias_links(pages, url, html))
    as_url = F.concat(F.lit("http://"), F.col("node"))
    judged = parts.withColumn("verdict", rule_of(host_of(as_url), path_of(as_url), rules)["verdict"])
    by_part = judged.groupBy("component").agg(F.max(F.when(F.col("verdict") == ALLOW, 1).otherwise(0)).alias("allowed"), F.max(F.when(F.col("verdict") == BLOCK, 1).otherwise(0)).alias("blocked"))
    blocked = by_part.where("allowed = 0 and blocked = 1").select("component")
    blocked = materialize(parts.join(blocked, "component").select(F.col("node").alias("__node"), F.lit(BLOCK).alias("__alias")), "blocked_aliases")
    u = F.col(f"`{url}`")
    p = pages.select(F.col(f"`{page_id}`").alias("page_id"), host_of(u).alias("host"), path_of(u).alias("path"), node_of(u).alias("__own"))
    p = p.withColumn("__rule", rule_of(F.col("host"), F.col("path"), rules))
    p = p.join(blocked, p["__own"] == blocked["__node"], "left")
    return p.select("page_id", "host", "path", F.col("__rule.rule").alias("rule"), F.coalesce("__rule.verdict", "__alias", F.lit(ALLOW)).alias("verdict"))
