"""URL filter whose decisions follow redirects and canonical links.

A rule holds for its host and all subdomains where the path begins with the rule's; the longest
fitting rule decides (of equals the one that allows). A URL without a rule takes part in the
decision of its aliases: URLs tied together by canonical links, refresh redirects in the page or
a given redirect table are one class, found by distributed connected components. A class is
blocked if a rule blocks one of its members and none allows one: an explicit allow has precedence,
for the URL itself and for its class. Everything else is allowed.

A null URL, or one without ``://``, has an empty host and path, no rule and no aliases. Fragments
tell no URLs apart. Rules are a list of the caller's, compiled into the plan: some hundred at most.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from signalgrid.llm.components import connected_components
from signalgrid.llm.work import settle

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = [
    Rule(ALLOW, "org", "/"),
    Rule(BLOCK, "example.org", "/es/"),
    Rule(BLOCK, "example.org", "/en/1"),
    Rule(ALLOW, "com", "/fr/"),
    Rule(BLOCK, "com", "/de/"),
]

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(column: Column) -> Column:
    return F.translate(column, _CAPITALS, _SMALL)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _raw_host(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/ ? #``, capitals A-Z made small."""
    return F.coalesce(_lower(_raw_host(url)), F.lit(""))


def path_of(url: Column) -> Column:
    """What stands after the host up to ``? #``."""
    rest = _after_scheme(url)
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_number(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Index into ``rules`` of the rule that decides, null without one."""
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i].text), rules[i].verdict != ALLOW))
    fits = [
        F.when(
            ((host == rules[i].host) | host.endswith("." + rules[i].host)) & path.startswith(rules[i].path), F.lit(i)
        )
        for i in order
    ]
    return F.coalesce(*fits) if fits else F.lit(None).cast("int")


def _chosen(number: Column, values: list[str]) -> Column:
    return F.when(number.isNotNull(), F.get(F.array(*map(F.lit, values or [""])), number))


def node_of(url: Column) -> Column:
    """A URL as a node: without its fragment, scheme and host in small letters; null without
    ``://``."""
    at = F.instr(url, "://")
    scheme = F.substring(url, F.lit(1), at - 1)
    rest = F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^#]*)", 1)
    return F.when(at > 0, F.concat(_lower(scheme), F.lit("://"), host_of(url), rest))


def _resolved(target: Column, url: Column) -> Column:
    """A link target seen from a page; null for one within the page."""
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    scheme = F.substring(url, F.lit(1), F.instr(url, "://") - 1)
    site = F.concat(scheme, F.lit("://"), _raw_host(url))
    folder = F.regexp_extract(path_of(url), r"^(.*/)", 1)
    return (
        F.when((target == "") | target.startswith("#"), F.lit(None))
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .when(target.startswith("?"), F.concat(site, path_of(url), target))
        .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), target))
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(source, target) nodes of canonical links and refresh redirects."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    canonical = F.transform(
        F.filter(tags, lambda tag: tag.rlike(r"(?is)^<link\b.*\brel\s*=\s*[\"']?canonical\b")),
        lambda tag: F.regexp_extract(tag, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1),
    )
    refresh = F.transform(
        F.filter(tags, lambda tag: tag.rlike(r"(?is)^<meta\b.*\bhttp-equiv\s*=\s*[\"']?refresh\b")),
        lambda tag: F.regexp_extract(tag, r"(?is)\burl\s*=\s*([^\"'\s>]+)", 1),
    )
    found = pages.where(F.instr(url, "://") > 0).select(
        F.col(url).alias("from_url"), F.explode(F.concat(canonical, refresh)).alias("to")
    )
    return found.select(
        node_of(F.col("from_url")).alias("source"),
        node_of(_resolved(F.col("to"), F.col("from_url"))).alias("target"),
    ).where("source <> target")


def judge(
    pages: DataFrame,
    rules: list[Rule] = RULES,
    id_column: str = "page_id",
    url: str = "url",
    html: str = "html",
    redirects: DataFrame | None = None,
) -> DataFrame:
    """One row per page: id, host, path, rule (null without one), verdict.

    ``redirects`` has columns ``source`` and ``target`` with URLs that lead to one another.
    """
    links = page_links(pages, url, html)
    if redirects is not None:
        given = redirects.select(*(node_of(F.col(name)).alias(name) for name in ("source", "target")))
        links = links.union(given)
    members = connected_components(links, "source", "target")
    verdicts = [rule.verdict for rule in rules]
    own = _chosen(rule_number(host_of(F.col("node")), path_of(F.col("node")), rules), verdicts)
    classes = (
        members.groupBy("component")
        .agg(F.max(own == ALLOW).alias("allowed"), F.max(own == BLOCK).alias("blocked"))
        .where("blocked and not allowed")
        .select("component")
    )
    blocked, _ = settle(members.join(classes, "component", "left_semi").select(F.col("node").alias("bad_node")))
    number = F.col("number")
    judged = (
        pages.select(F.col(id_column), F.col(url).alias("own_url"))
        .withColumn("host", host_of(F.col("own_url")))
        .withColumn("path", path_of(F.col("own_url")))
        .withColumn("number", rule_number(F.col("host"), F.col("path"), rules))
    )
    return judged.join(blocked, node_of(F.col("own_url")) == F.col("bad_node"), "left").select(
        id_column,
        "host",
        "path",
        _chosen(number, [rule.text for rule in rules]).alias("rule"),
        F.coalesce(
            _chosen(number, verdicts), F.when(F.col("bad_node").isNotNull(), BLOCK), F.lit(ALLOW)
        ).alias("verdict"),
    )
