"""URL filters with redirect equivalence.

Rules block or allow a host (with its subdomains) below a path; the longest rule that fits decides. Redirects and canonical
links make URLs aliases: edges come from each page's canonical link and refresh redirect, from a table of redirects if one
is given, and from what servers redirect by convention (a URL's node leaves out scheme, fragment, default port and tracking
parameters). Connected components of these edges are classes of aliases. A URL that no rule fits follows its class:
allow if a rule allows any alias (allow has precedence), else block if a rule blocks one, else allow. A rule's own
verdict always stays.

Components are computed on the edges alone; pages without a link are not in them. Decisions are counted by node before classes, so
a host or a target with a third of all links is summed in parts.

Rules are parameters, matched as one expression; what grows with the data is never collected.

Defined cases: host and path of a null url, or one without ``://``, are empty and the verdict is allow; page_ids that
repeat give a row each; links that aren't absolute are resolved against the page's URL; null html has no links; empty
input gives empty output; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatloom.llm.graph import components
from seatloom.runtime import materialise

# The production rules, (verdict, rule).
RULES = (
    ("block", "com/en/"),
    ("allow", "example.com/en/7"),
    ("allow", "net/de/"),
    ("block", "example.net/de/8"),
    ("block", "org/es/"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRACKING = "utm_[^&]*|fbclid=[^&]*|gclid=[^&]*"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def ruling(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """The longest fitting rule as struct<verdict,rule>; null if none fits. Of equal rules, allow stands first."""
    found = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[0])):
        rule_host, slash, rule_path = rule.partition("/")
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(slash + rule_path)
        this = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        found = F.when(fits, this) if found is None else found.when(fits, this)
    return found if found is not None else F.lit(None).cast("struct<verdict:string,rule:string>")


def node_of(url: Column) -> Column:
    """Name of a URL shared by its conventional variants; null without ``://``."""
    host = F.regexp_replace(host_of(url), r":(80|443)$", "")
    query = F.regexp_extract(after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^(?:{TRACKING})")), "&")
    path = F.when(path_of(url) == "", "/").otherwise(path_of(url))
    return F.when(after_scheme(url).isNotNull(), F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def links_of(html: Column) -> Column:
    """Targets of canonical links and refresh redirects, as they stand in the page."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style|textarea|title)\b.*?</\1\s*>", "")
    tags = F.regexp_extract_all(bare, F.lit(r"(?i)(<(?:link|meta)\b[^>]*>)"), 1)
    canonical = F.filter(tags, lambda t: t.rlike(r"""(?i)^<link\b[^>]*\srel\s*=\s*["']?\s*canonical\b"""))
    refresh = F.filter(tags, lambda t: t.rlike(r"""(?i)^<meta\b[^>]*\shttp-equiv\s*=\s*["']?\s*refresh\b"""))
    hrefs = F.transform(canonical, lambda t: F.regexp_extract(t, r"""(?i)\shref\s*=\s*["']?\s*([^"'\s>]+)""", 1))
    urls = F.transform(refresh, lambda t: F.regexp_extract(t, r"""(?i)\bcontent\s*=\s*["']?[^"'>]*?url\s*=\s*["']?\s*([^"'\s>]+)""", 1))
    found = F.transform(F.concat(hrefs, urls), lambda u: F.regexp_replace(u, "(?i)&amp;", "&"))
    some = html.rlike(r"(?i)canonical|refresh")
    return F.when(some, F.filter(found, lambda u: u != "")).otherwise(F.array().cast("array<string>"))


def resolve(link: Column, url: Column) -> Column:
    """An absolute URL from a link on the page ``url``; null where there is no base."""
    scheme = F.concat(F.regexp_extract(url, r"^(.*?)://", 1), F.lit("://"))
    host = F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1)
    folder = F.regexp_replace(path_of(url), r"[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(url, r"^(.*?://)", 1), F.substring(link, 3, 1 << 30)))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(link.startswith("#"), url)
        .when(link.startswith("?"), F.concat(scheme, host, path_of(url), link))
        .when(link.startswith("/"), F.concat(scheme, host, link))
        .otherwise(F.concat(scheme, host, folder, link))
    )


def judge(pages: DataFrame, redirects: DataFrame | None = None, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """Pages (page_id, url, html) -> page_id, host, path, rule, verdict.

    ``redirects``: further edges, as (source, target) URLs.
    """
    url = F.col("url")
    read = pages.select("page_id", "url", F.transform(links_of(F.col("html")), lambda x: resolve(x, url)).alias("links"))
    read = read.withColumns({"host": host_of(url), "path": path_of(url), "node": node_of(url)})
    read = materialise(read.withColumn("ruling", ruling(F.col("host"), F.col("path"), rules)), "pages")

    linked = read.select("node", F.explode("links").alias("target")).filter("node IS NOT NULL")
    linked = linked.select("node", "target")
    if redirects is not None:
        linked = linked.unionByName(redirects.select(node_of(F.col("source")).alias("node"), "target"))
    target = F.col("target")
    edges = linked.select("node", node_of(target).alias("other"), ruling(host_of(target), path_of(target), rules)["verdict"].alias("verdict"))
    edges = materialise(edges.filter("node IS NOT NULL AND other IS NOT NULL"), "alias-edges")
    classes = materialise(components(edges.select("node", "other"), "node", "other").withColumnRenamed("node", "c_node"), "alias-classes")

    # what rules say about each node, then about each class
    said = read.filter("node IS NOT NULL AND ruling IS NOT NULL").select("node", "ruling.verdict").unionByName(
        edges.filter("verdict IS NOT NULL").select(F.col("other").alias("node"), "verdict")
    )
    by_node = materialise(said.groupBy("node").agg(F.min("verdict").alias("verdict")), "node-rulings")  # allow < block
    by_class = by_node.join(classes, F.col("node") == F.col("c_node"), "left").groupBy(F.coalesce("component", "node").alias("d_class"))
    decided = materialise(by_class.agg(F.min("verdict").alias("decision")), "class-decisions")

    placed = read.join(classes, F.col("node") == F.col("c_node"), "left").withColumn("class", F.coalesce("component", "node"))
    placed = placed.join(decided, F.col("class") == F.col("d_class"), "left")
    return placed.select(
        "page_id", "host", "path", F.col("ruling.rule").alias("rule"), F.coalesce(F.col("ruling.verdict"), F.col("decision"), F.lit("allow")).alias("verdict")
    )


#: For pages without canonical links or redirects, as the tables here are: classes are the conventional variants alone.
ORACLE_SQL = r"""
WITH u AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
p AS (
  SELECT page_id, rest,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query FROM u),
r(verdict, rule_host, rule_path) AS (
  VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
b AS (
  SELECT page_id, arg_max(verdict, length(rule_host || rule_path)) AS verdict, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule
  FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id),
n AS (
  SELECT p.*, b.verdict, b.rule,
         regexp_replace(host, ':(80|443)$', '') || CASE WHEN path = '' THEN '/' ELSE path END
           || coalesce('?' || nullif(array_to_string(list_filter(string_split(query, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_|fbclid=|gclid=)')), '&'), ''), '') AS node
  FROM p LEFT JOIN b USING (page_id)),
c AS (SELECT node, min(verdict) AS decision FROM n WHERE rest IS NOT NULL AND verdict IS NOT NULL GROUP BY node)
SELECT page_id, host, path, rule, coalesce(n.verdict, c.decision, 'allow') AS verdict
FROM n LEFT JOIN c ON n.node = c.node
"""
