"""URL filters with redirect equivalence.

A page's own rule decides: the longest rule whose host is the url's host or a parent domain of it, and whose path
starts the url's path. Pages without a rule take the decision of their aliases: urls that are tied by redirects
(``<meta http-equiv=refresh>``) or canonical links (``<link rel=canonical>``), directly or through others. If any
url of such a component is blocked by a rule, the pages of the component are blocked, except those that a rule
allows explicitly. Everything else is allowed.

Main path: DataFrame functions only. Components come from alternating large and small stars over the edges between
urls; no task holds a component, and nothing of it reaches the driver.

All such tags of a page count. Targets are resolved against the page's url in every form (absolute, ``//host``, ``/path``,
``path``, ``../path``, ``?query``, ``#fragment``; dot segments are removed), and pages and targets meet by a normalised
url: scheme and host in lower case, without fragment, an empty path as ``/``. ``component`` is a normalised url. A
``<base>`` is not looked at.

Defined results: a null url, or one without ``://``, has empty host and path, no rule and no aliases; null html has no
edges; targets with a scheme that has no ``://`` (``mailto:``) are no urls; repeated pages are judged one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from marketgrain.llm.components import connected


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: fixed values
RULES = (
    Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"),
)

_ATTRIBUTE = r"""\s*=\s*["']?\s*([^"'>\s]+)"""
_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*>"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*>"""


def ascii_lower(value: Column) -> Column:
    return F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def own_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct of text and verdict of the longest rule that fits, or null."""
    chosen = F.lit(None)
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(
            chosen
        )
    return chosen


def normalised(url: Column) -> Column:
    """Scheme and host A-Z lowered, without fragment, dot segments removed, an empty path as ``/``; null without ``://``."""
    plain = F.regexp_replace(url, r"(?s)#.*$", "")
    scheme = ascii_lower(F.regexp_extract(plain, r"(?s)^(.*?)://", 1))
    path, query = url_path(plain), F.regexp_extract(plain, r"(?s)(\?.*)$", 1)
    return F.when(plain.contains("://"), F.concat(scheme, F.lit("://"), url_host(plain), _without_dots(path), query))


def _without_dots(path: Column) -> Column:
    """A path from ``/`` on, without ``.`` and ``..`` segments (RFC 3986, 5.2.4)."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/", -1)
    # a dot segment at the end leaves a folder
    parts = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(parts, F.array(F.lit("")))).otherwise(parts)
    kept = F.aggregate(
        parts, F.expr("cast(array() as array<string>)"),
        lambda done, part: F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(part == ".", done).otherwise(F.concat(done, F.array(part))),
    )
    whole = F.concat(F.lit("/"), F.array_join(kept, "/"))
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), whole).when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))


def resolved(target: Column, page: Column) -> Column:
    """The absolute url of a target on a page; null where the target's scheme has no ``://``."""
    scheme, origin = F.regexp_extract(page, r"(?s)^(.*?)://", 1), F.regexp_extract(page, r"(?s)^.*?://[^/?#]*", 0)
    path = url_path(page)
    folder = F.concat(origin, F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"(?s)^(.*/)", 1)))
    return (
        F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(origin, target))
        .when(target.startswith("?"), F.concat(origin, path, target))
        .when(target.startswith("#"), page)
        .otherwise(F.concat(folder, target))
    )


def alias_edges(pages: DataFrame) -> DataFrame:
    """Pairs (a, b) of different normalised urls tied by redirects or canonical links of a page."""
    url, html = F.col("url"), F.col("html")

    def targets(tag: str, attribute: str) -> Column:
        found = F.regexp_extract_all(html, F.lit(tag), F.lit(0))
        return F.transform(found, lambda x: F.regexp_extract(x, attribute, 1))

    tags = pages.where(url.contains("://") & html.rlike(r"(?i)canonical|refresh")).select(
        "url", F.explode(F.concat(
            targets(_CANONICAL, rf"(?is)\bhref{_ATTRIBUTE}"),
            targets(_REFRESH, r"""(?is)\burl\s*=\s*["']?\s*([^"'>\s;]+)"""),
        )).alias("target"),
    ).where(F.col("target") != "")
    target = F.regexp_replace("target", "(?i)&amp;", "&")
    ties = tags.select(normalised(url).alias("a"), normalised(resolved(target, url)).alias("b"))
    return ties.where(F.col("b") != F.col("a"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, and the alias component's smallest url (null without aliases)."""
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    judged = pages.select("page_id", "url", host.alias("host"), path.alias("path")).withColumn(
        "_own", own_rule(F.col("host"), F.col("path"), rules)
    )
    judged = judged.withColumn("_url", normalised(F.col("url"))).drop("url")
    members = connected(alias_edges(pages)).withColumnsRenamed({"node": "_node", "component": "component"})
    # urls that are only named as targets have a rule as well
    node_rule = own_rule(url_host(F.col("_node")), url_path(F.col("_node")), rules)
    blocked = members.where(node_rule["verdict"] == "block").select(F.col("component").alias("_blocked")).distinct()
    marked = members.join(blocked, F.col("component") == F.col("_blocked"), "left")
    joined = judged.join(marked, judged["_url"] == marked["_node"], "left")
    inherited = F.when(F.col("_blocked").isNotNull(), "block").otherwise("allow")
    return joined.select(
        "page_id", "host", "path", F.col("_own.text").alias("rule"),
        F.coalesce(F.col("_own.verdict"), inherited).alias("verdict"), "component",
    )
