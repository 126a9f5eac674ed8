"""URL rules spread over redirect equivalence (native: DataFrame functions only).

A rule is a host and a path prefix with a verdict.  It fits its host and all
subdomains when the url's path starts with the rule's path; the longest
fitting rule (as ``host + path``) wins; equal lengths go by code point.

Urls that stand for one page are made equivalent: a url and its usual redirect
target (:func:`canonical_key`: scheme, ``www.``/``m.``, default document
suffix, trailing slash, tracking parameters and fragment make no difference)
share a node, and canonical links, ``og:url`` and meta refresh in the page, or
a table of observed redirects, are edges between nodes.  Targets may be
relative to the page's host, folder (``page2.html``, ``../a``) or path
(``?id=3``); OP7_SQL knows only those from ``/`` on.  Distributed connected
components join the nodes; a component that holds a url with a rule passes its
verdict to members without one, and an explicit allow takes precedence over a
block.  A url's own rule always wins.  Without any verdict a url is allowed.

Cases: a null url, or one without ``://``, has empty host and path, no node
and no alias, and is allowed; empty hosts fit no rule; repeated rows are judged
alike; null html has no links; an empty rule list allows everything; extra
columns are ignored.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.common import load
from tandem.llm.graph import connected_components

# The rules of the registered query, (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = (  # (tag, attribute that holds the url)
    (r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>""", r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""),
    (r"""(?is)<meta\b[^>]*\bproperty\s*=\s*["']?og:url\b[^>]*>""", r"""(?is)\bcontent\s*=\s*["']?([^"'\s>]+)"""),
    (r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>""", r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""),
)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; '' without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical_key(url: Column) -> Column:
    """The form that a url's usual redirects lead to; null without a host."""
    host = F.regexp_replace(url_host(url), r"^(?:www|m)\.", "")
    path = F.regexp_replace(url_path(url), r"(?:/index)?(?:\.html?)?/*$", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(?:utm_[^=]*|ref|fbclid|gclid)(?:=|$)"))
    key = F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(kept), "&")))
                   .otherwise(F.lit("")))
    return F.when(url_host(url) != "", key)


def _without_dots(path: Column) -> Column:
    """A path from the root without its ``.`` and ``..`` segments."""
    parts = F.split(F.regexp_replace(F.regexp_replace(path, r"^/", ""), r"(^|/)(\.\.?)$", "$1$2/"), "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, x: F.when(
        x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(x == ".", acc).otherwise(F.concat(acc, F.array(x))))
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst) urls: canonical, og:url and refresh targets, made absolute."""
    base = F.regexp_extract(F.col(url_col), r"^.*?://[^/?#]*", 0)
    found = [F.regexp_extract(F.regexp_extract(F.col(html_col), tag, 0), attribute, 1) for tag, attribute in _LINK]
    targets = (pages.where(F.col(url_col).isNotNull() & F.col(html_col).isNotNull())
               .select(F.col(url_col).alias("src"), base.alias("base"), url_path(F.col(url_col)).alias("path"),
                       F.array(*found).alias("found"))
               .select("src", "base", "path",
                       F.explode(F.filter(F.array_distinct("found"), lambda x: x != "")).alias("dst")))
    slashes = F.col("dst").startswith("//")
    path = F.when(F.col("path") == "", "/").otherwise(F.col("path"))
    folder = F.regexp_replace(path, r"[^/]*$", "")
    to, tail = F.regexp_extract("dst", r"^[^?#]*", 0), F.regexp_extract("dst", r"[?#].*$", 0)
    return targets.select("src", F.when(F.col("dst").rlike(r"^[^/?#]*://"), F.col("dst"))
                          .when(slashes, F.concat(F.lit("http:"), F.col("dst")))
                          .when(F.col("dst").startswith("/"), F.concat("base", "dst"))
                          .when(F.col("dst").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)  # mailto: and such
                          .when(to == "", F.concat("base", path, tail))
                          .otherwise(F.concat(F.col("base"), _without_dots(F.concat(folder, to)), tail)).alias("dst")
                          ).where("dst is not null")


def rule_table(spark: SparkSession, rules: tuple) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "rule_host string, rule_path string, rule_verdict string")


def rule_of(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct (host, path) -> (host, path, rule, rule_verdict) where a rule fits.

    Hosts are taken apart into their suffixes and joined with the rules by
    equality, so a rule table of any size is an ordinary equi-join.
    """
    labels = F.split("host", r"\.")
    n = F.size("labels")
    suffixes = F.transform(F.sequence(F.lit(1), n),
                           lambda i: F.array_join(F.slice("labels", i, n - i + 1), "."))
    parts = (urls.select("host", "path").distinct().where("host <> ''").withColumn("labels", labels)
             .select("host", "path", F.explode(suffixes).alias("rule_host")))
    name = F.concat("rule_host", "rule_path")
    fits = parts.join(rules, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    best = F.max(F.struct(F.length(name).alias("n"), name.alias("rule"), "rule_verdict")).alias("best")
    return fits.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.rule_verdict")


def judge_urls(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, id_col: str = "page_id",
               url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: (id, host, path, rule, verdict).

    ``redirects`` (src, dst) are observed redirects beyond the pages' own links.
    """
    links = page_links(pages, url_col, html_col)
    if redirects is not None:
        links = links.unionByName(redirects.select("src", "dst"))
    edges = (links.select(F.xxhash64(canonical_key(F.col("src"))).alias("u"),
                          F.xxhash64(canonical_key(F.col("dst"))).alias("v"),
                          canonical_key(F.col("src")).alias("ku"), canonical_key(F.col("dst")).alias("kv"))
             .where("ku is not null and kv is not null").select("u", "v"))
    comp = connected_components(edges, "url-alias")

    def located(urls: DataFrame, url: str) -> DataFrame:
        return urls.select("*", url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"),
                           F.when(canonical_key(F.col(url)).isNotNull(), F.xxhash64(canonical_key(F.col(url))))
                           .alias("node"))

    # every url that is known: pages, and the ends of links that are no page
    rows = located(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")), "url").drop("url")
    ends = links.select(F.explode(F.array("src", "dst")).alias("url")).distinct()
    known = rows.select("host", "path", "node").unionByName(located(ends, "url").select("host", "path", "node")).distinct()
    ruled = rule_of(known, rules)
    placed = (known.where("node is not null").join(ruled, ["host", "path"])
              .join(comp, "node", "left").select(F.coalesce("component", "node").alias("comp"), "rule_verdict"))
    verdict = placed.groupBy("comp").agg(
        F.when(F.bool_or(F.col("rule_verdict") == "allow"), "allow").otherwise("block").alias("inherited"))
    out = rows.join(comp, "node", "left").withColumn("comp", F.coalesce("component", "node"))
    out = out.join(verdict, "comp", "left").join(ruled, ["host", "path"], "left")
    return out.select(F.col("id").alias(id_col), "host", "path", "rule",
                      F.coalesce("rule_verdict", "inherited", F.lit("allow")).alias("verdict"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(load(spark, sf_dir, "pages"), rule_table(spark, RULES))


def _sql_key(u: str) -> str:
    """DuckDB text of :func:`canonical_key`."""
    rest = f"CASE WHEN instr({u}, '://') > 0 THEN substr({u}, instr({u}, '://') + 3) ELSE '' END"
    host = f"translate(regexp_extract({rest}, '^[^/?#]*'), '{_UPPER}', '{_LOWER}')"
    path = f"regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1)"
    query = f"regexp_extract({rest}, '^[^?#]*\\?([^#]*)', 1)"
    kept = (f"list_sort(list_filter(string_split({query}, '&'), lambda p: p <> '' AND NOT "
            f"regexp_matches(p, '^(?:utm_[^=]*|ref|fbclid|gclid)(?:=|$)')))")
    return (f"CASE WHEN {host} <> '' THEN regexp_replace({host}, '^(?:www|m)\\.', '') || "
            f"regexp_replace({path}, '(?:/index)?(?:\\.html?)?/*$', '') || "
            f"CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({kept}, '&') ELSE '' END END")


def _sql_link(tag: str, attribute: str) -> str:
    quoted = [x.replace("'", "''") for x in (tag, attribute)]
    return f"regexp_extract(regexp_extract(html, '{quoted[0]}'), '{quoted[1]}', 1)"


_REST = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END"
OP7_SQL = f"""
WITH RECURSIVE rules(rule_host, rule_path, rule_verdict) AS (VALUES {", ".join(map(str, RULES))}),
found AS (SELECT url AS src, regexp_extract(url, '^.*?://[^/?#]*') AS base,
                 unnest([{", ".join(_sql_link(*x) for x in _LINK)}]) AS t
          FROM pages WHERE url IS NOT NULL AND html IS NOT NULL),
links AS (SELECT src, dst FROM (
            SELECT src, CASE WHEN instr(t, '://') > 0 THEN t WHEN starts_with(t, '//') THEN 'http:' || t
                             WHEN starts_with(t, '/') THEN base || t END AS dst FROM found WHERE t <> '')
          WHERE dst IS NOT NULL),
e AS (SELECT DISTINCT {_sql_key("src")} AS u, {_sql_key("dst")} AS v FROM links),
edges AS (SELECT u, v FROM e WHERE u IS NOT NULL AND v IS NOT NULL UNION SELECT v, u FROM e
          WHERE u IS NOT NULL AND v IS NOT NULL),
known AS (SELECT DISTINCT url FROM (SELECT url FROM pages UNION SELECT src FROM links UNION SELECT dst FROM links)),
loc AS (SELECT url, translate(regexp_extract({_REST}, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
               regexp_extract({_REST}, '^[^/?#]*([^?#]*)', 1) AS path, {_sql_key("url")} AS node FROM known),
fit AS (SELECT url, max({{'n': length(rule_host || rule_path), 'rule': rule_host || rule_path, 'v': rule_verdict}}) AS best
        FROM loc JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        GROUP BY url),
reach(a, b) AS (SELECT DISTINCT node, node FROM loc WHERE node IS NOT NULL
                UNION SELECT a, v FROM reach JOIN edges ON b = u),
inherited AS (SELECT a AS node, bool_or(best.v = 'allow') AS allowed
              FROM reach JOIN loc ON b = loc.node JOIN fit USING (url) GROUP BY a)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, best.rule AS rule,
       coalesce(best.v, CASE WHEN allowed THEN 'allow' WHEN NOT allowed THEN 'block' ELSE 'allow' END) AS verdict
FROM pages LEFT JOIN loc ON pages.url IS NOT DISTINCT FROM loc.url
           LEFT JOIN fit ON pages.url = fit.url LEFT JOIN inherited ON loc.node = inherited.node
"""
