"""Operator 7, URL filters: rules on host and path, carried along redirects and canonical links.

A page without a rule of its own takes the decision of its aliases: the pages
joined to it by redirects and canonical links, directly or over others. Only
DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import components, cut, let, llm_query, table


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the contract.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
#: Host prefixes of the same site, and query parameters that only track.
SAME_SITE = "^(www|m)\\."
TRACKING = "&(utm_[a-z]+|ref|fbclid|gclid)=[^&]*"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The text of the longest rule that fits, else null.

    The url's host suffixes and path prefixes (of the lengths that rules have) are
    looked up in one hash set, so the work does not grow with the number of rules.
    """
    if not rules:
        return F.lit(None).cast("string")
    lengths = F.array(*[F.lit(n) for n in sorted({len(r.path) for r in rules})])
    labels = F.split(host, "\\.")
    suffixes = let(labels, lambda x: F.transform(F.sequence(F.lit(1), F.size(x)), lambda i: F.array_join(F.slice(x, i, F.size(x)), ".")))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(
        F.filter(lengths, lambda n: n <= F.length(path)), lambda n: F.concat(s, F.substring(path, F.lit(1), n)))))
    fits = F.filter(keys, lambda k: k.isin([r.text for r in rules]))
    return F.array_max(F.transform(fits, lambda k: F.struct(F.length(k).alias("n"), k.alias("rule"))))["rule"]


def node_of(url: Column) -> Column:
    """The name under which a url is a node: scheme, ``www.``/``m.``, default port, fragment,
    tracking parameters and a closing slash are dropped; null if there is no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), ":(80|443)$", ""), SAME_SITE, "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^[^#]*?\\?([^#]*)", 1)
    kept = F.regexp_replace(F.concat(F.lit("&"), query), TRACKING, "")
    kept = F.when(F.length(kept) > 1, F.concat(F.lit("?"), F.substring(kept, F.lit(2), F.length(kept)))).otherwise("")
    return F.when(host != "", F.concat(host, path, kept))


def links_of(url: Column, html: Column) -> Column:
    """Targets of the page's canonical link and of its meta refresh, made absolute."""
    page = F.coalesce(html, F.lit(""))
    tag = F.regexp_extract(page, "(?is)<link[^>]*\\brel=[\"']?canonical\\b[^>]*>", 0)
    href = F.regexp_extract(tag, "(?is)\\bhref=[\"']?([^\"'\\s>]+)", 1)
    refresh = F.regexp_extract(page, "(?is)<meta[^>]*\\bhttp-equiv=[\"']?refresh\\b[^>]*>", 0)
    target = F.regexp_extract(refresh, "(?is)\\burl=[\"']?([^\"'\\s>]+)", 1)
    base = F.concat(F.lit("http://"), host_of(url))

    def absolute(t: Column) -> Column:
        return F.when(t == "", None).when(t.rlike("(?s)^[A-Za-z][A-Za-z0-9+.-]*://"), t).when(
            t.startswith("//"), F.concat(F.lit("http:"), t)).when(t.startswith("/"), F.concat(base, t)).otherwise(
            F.concat(base, F.regexp_replace(path_of(url), "[^/]*$", ""), t))

    return F.filter(F.transform(F.array(href, target), absolute), lambda x: x.isNotNull())


def url_filter(pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """Judge every row of ``pages`` (url, html; other columns are kept).

    Adds host, path, rule and verdict. The verdict is the rule's if a rule fits.
    Else it is ``block`` if the page's component of redirects and canonical links
    holds a blocked page and no page that a rule allows, and ``allow`` otherwise:
    an explicit allow goes before a block that only came along a link.
    ``redirects`` (from_url, to_url) adds edges to those found in html. Spellings
    of one address (scheme, www., tracking parameters, closing slash) are one
    node. Null urls and urls without ``://`` have no node and no rule: allow.
    Repeated rows are judged alike; no pages, no rows.

    Decisions are summed to one row per node before anything is joined, and only
    nodes of linked components and of spellings with a decision take part, so
    pages without any rule or link are never shuffled by a hot key alone.
    """
    judged = pages.select(F.struct("*").alias("_all"), F.col("url"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("html"))
    judged = judged.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    blocked = F.col("rule").isin([r.text for r in rules if r.verdict == "block"])
    own = F.when(F.col("rule").isNull(), None).when(blocked, "block").otherwise("allow")
    judged = judged.withColumns({"own": own, "node": node_of(F.col("url"))})
    links = judged.select(F.col("node").alias("a"), F.explode(links_of(F.col("url"), F.col("html"))).alias("t"))
    edges = links.select("a", node_of(F.col("t")).alias("b"))
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node_of(F.col("from_url")).alias("a"), node_of(F.col("to_url")).alias("b")))
    roots = cut(components(edges.where("a IS NOT NULL AND b IS NOT NULL")))
    decided = judged.where("own IS NOT NULL AND node IS NOT NULL").groupBy("node").agg(
        F.max(F.col("own") == "allow").alias("allowed"), F.max(F.col("own") == "block").alias("blocked"))
    by_root = decided.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(
        F.max("allowed").alias("allowed"), F.max("blocked").alias("blocked")).where("blocked AND NOT allowed").select("root")
    bad = by_root.join(roots, "root", "left").select(F.coalesce("node", "root").alias("node"))
    bad = bad.distinct().withColumn("bad", F.lit(True))
    verdict = F.coalesce("own", F.when(F.col("bad"), "block"), F.lit("allow"))
    new = {"host": F.col("host"), "path": F.col("path"), "rule": F.col("rule"), "verdict": verdict}
    names = pages.columns + [c for c in new if c not in pages.columns]
    passed = judged.drop("url", "html").join(bad, "node", "left")
    return passed.select(*[new[c].alias(c) if c in new else F.col("_all")[c].alias(c) for c in names])


def _sql_node(url: str) -> str:
    host = f"regexp_replace(regexp_replace(translate(regexp_extract(coalesce({url}, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), ':(80|443)$', ''), '^(www|m)[.]', '')"
    path = f"regexp_replace(regexp_extract(coalesce({url}, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1), '/+$', '')"
    kept = f"regexp_replace('&' || regexp_extract(coalesce({url}, ''), '(?s)^[^#]*?[?]([^#]*)', 1), '{TRACKING}', '', 'g')"
    return f"CASE WHEN {host} <> '' THEN {host} || {path} || CASE WHEN length({kept}) > 1 THEN '?' || substr({kept}, 2) ELSE '' END END"


_SQL = f"""
WITH RECURSIVE rules(verdict, host, path) AS (VALUES {", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)}),
p AS (SELECT *, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS h,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS f, {_sql_node("url")} AS node FROM pages),
fit AS (SELECT page_id, r.host || r.path AS rule, r.verdict FROM p JOIN rules r ON (p.h = r.host OR ends_with(p.h, '.' || r.host)) AND starts_with(p.f, r.path)
    QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(r.host || r.path) DESC) = 1),
link AS (SELECT node AS a, h, f, unnest([
    regexp_extract(regexp_extract(coalesce(html, ''), '(?is)<link[^>]*\\brel=["'']?canonical\\b[^>]*>'), '(?is)\\bhref=["'']?([^"''\\s>]+)', 1),
    regexp_extract(regexp_extract(coalesce(html, ''), '(?is)<meta[^>]*\\bhttp-equiv=["'']?refresh\\b[^>]*>'), '(?is)\\burl=["'']?([^"''\\s>]+)', 1)]) AS t FROM p),
target AS (SELECT a, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t WHEN starts_with(t, '//') THEN 'http:' || t
    WHEN starts_with(t, '/') THEN 'http://' || h || t ELSE 'http://' || h || regexp_replace(f, '[^/]*$', '') || t END AS url FROM link WHERE t <> ''),
half AS (SELECT a, {_sql_node("url")} AS b FROM target),
edge AS (SELECT a, b FROM half WHERE a <> b UNION SELECT b, a FROM half WHERE a <> b),
reach(a, b) AS (SELECT a, a FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b),
root AS (SELECT a AS node, min(b) AS root FROM reach GROUP BY 1),
j AS (SELECT p.page_id, p.node, p.h, p.f, fit.rule, fit.verdict, coalesce(root.root, p.node) AS root FROM p LEFT JOIN fit USING (page_id) LEFT JOIN root ON root.node = p.node),
bad AS (SELECT root FROM j WHERE verdict IS NOT NULL GROUP BY 1 HAVING bool_or(verdict = 'block') AND NOT bool_or(verdict = 'allow'))
SELECT page_id, h AS host, f AS path, rule, coalesce(verdict, CASE WHEN root IN (SELECT root FROM bad WHERE root IS NOT NULL) THEN 'block' END, 'allow') AS verdict FROM j"""


@llm_query("op7_url_filters", _SQL)
def op7_url_filters(spark, sf_dir):
    return url_filter(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
