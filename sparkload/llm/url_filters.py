"""URL filters: rules by host and path, and trust and distrust spread over
the links between hosts for the urls without a rule.  DataFrame operations
only.

A page's host is linked to every other host its ``href`` values name (one
edge per pair of hosts, weighted by its links; a link within a host says
nothing about it and is left out).  Two personalised PageRanks run over these
edges side by side: trust starts at the hosts with allowed urls and follows
the links, distrust starts at the hosts with blocked urls and follows them
backwards (who links to a bad host is suspect).  A host's seed is the share of
its urls with a rule that the rule allows or blocks, and seeds are not scaled to
a sum: a host's ranks depend on the hosts it is linked with and on nothing
else, so verdicts stay when the table has more hosts or every page more often.
A host is blocked when its distrust is above its trust and above ``least``; a
host reached by neither is allowed.

Ranks are one row per host and seed kind, edges one row per pair of hosts;
every round is a join and a partial aggregate, and its result is written to
the shared folder.  Rounds go on until the ranks are settled: until a round
changes them by at most ``TOLERANCE`` in sum.  As a round's change is at most
``FOLLOW`` times that of the one before, what is still missing then is below
``TOLERANCE * FOLLOW / (1 - FOLLOW)`` = 6e-10 over all hosts, less than
``LEAST``; for the same reason n seeded hosts take at most
142 + 6.2 ln(n) rounds on any graph.  A null url, or one without ``://``, has an empty host and
path and fits no rule; the empty host takes part like any other.  A null page
body has no links.  Repeated rows count as often as they occur.  Very long urls
and pages are read whole; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, col, lower_ascii, stored, table

#: (verdict, host, path) of the rules to apply.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
FOLLOW, LEAST, TOLERANCE = 0.85, 1e-9, 1e-10
HREF = r"""(?i)href\s*=\s*["']?([^"'\s>]+)"""


def host_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: the host up to ``/``, ``?``, ``#`` or the end,
    A-Z lower-cased; the path from there up to ``?``, ``#`` or the end."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    return lower_ascii(host), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """Name and verdict of the longest fitting rule, else null.  ``rules`` is
    a short list that becomes part of the expression."""
    name = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule and the rule's verdict (or null)."""
    host, path = host_path(col(pages, "url"))
    urls = pages.select(col(pages, "page_id").alias("page_id"), host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return urls.select("page_id", "host", "path", name.alias("rule"), verdict.alias("by_rule"))


def host_edges(pages: DataFrame) -> DataFrame:
    """from_host, to_host, links: one row per linked pair of different hosts."""
    host, _ = host_path(col(pages, "url"))
    links = pages.select(host.alias("from_host"), F.explode(F.regexp_extract_all(col(pages, "html"), F.lit(HREF), 1)).alias("link"))
    full = F.when(F.col("link").startswith("//"), F.concat(F.lit("x:"), F.col("link"))).otherwise(F.col("link"))
    to = links.where(F.col("link").contains("//")).select("from_host", host_path(full)[0].alias("to_host"))
    to = to.where((F.col("to_host") != "") & (F.col("to_host") != F.col("from_host")))
    return to.groupBy("from_host", "to_host").agg(F.count(F.lit(1)).alias("links"))


def spread(spark: SparkSession, seeds: DataFrame, edges: DataFrame, follow: float = FOLLOW, tolerance: float = TOLERANCE) -> DataFrame:
    """(kind, host, rank) after rounds of
    ``rank = (1 - follow) * seed + follow * (share of the ranks of the hosts
    that point here)``, until one changes the ranks by at most ``tolerance``
    in sum.  seeds: (kind, host, seed), edges: (kind, host, to_host, share)."""
    seeds, edges = stored(spark, seeds, "url_seeds"), stored(spark, edges, "url_edges")
    start = seeds.select("kind", "host", ((1 - follow) * F.col("seed")).alias("rank"), F.lit(0.0).alias("was"))
    rank = start.select("kind", "host", "rank")
    total = seeds.agg(F.sum("seed")).first()[0] or 0.0
    change = bound = (1 - follow) * total if edges.take(1) else 0.0  # bound: on the change of any graph, whatever the rounding
    while min(change, bound) > tolerance:
        flow = (rank.join(edges, ["kind", "host"])
                .select("kind", F.col("to_host").alias("host"), (F.lit(follow) * F.col("rank") * F.col("share")).alias("rank"), F.lit(0.0).alias("was")))
        before = rank.select("kind", "host", F.lit(0.0).alias("rank"), F.col("rank").alias("was"))
        both = flow.unionByName(start).unionByName(before).groupBy("kind", "host").agg(F.sum("rank").alias("rank"), F.sum("was").alias("was"))
        both = stored(spark, both, "url_rank")
        change, bound = both.agg(F.sum(F.abs(F.col("rank") - F.col("was")))).first()[0] or 0.0, bound * follow
        rank = both.select("kind", "host", "rank")
    return rank


def host_verdicts(spark: SparkSession, pages: DataFrame, urls: DataFrame, follow: float = FOLLOW,
                  least: float = LEAST, tolerance: float = TOLERANCE) -> DataFrame:
    """host, trust, distrust, by_links for each host with a rank."""
    kind = F.when(F.col("by_rule") == "allow", "trust").otherwise("distrust")
    counts = urls.where(F.col("by_rule").isNotNull()).groupBy(kind.alias("kind"), "host").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(spark, counts, "url_counts")
    sums = counts.groupBy("host").agg(F.sum("n").alias("all_n"))
    seeds = counts.join(sums, "host").select("kind", "host", (F.col("n") / F.col("all_n")).alias("seed"))
    pairs = stored(spark, host_edges(pages), "url_pairs")
    both = (pairs.select(F.lit("trust").alias("kind"), F.col("from_host").alias("host"), "to_host", "links")
            .unionByName(pairs.select(F.lit("distrust").alias("kind"), F.col("to_host").alias("host"), F.col("from_host").alias("to_host"), "links")))
    out = both.groupBy("kind", "host").agg(F.sum("links").alias("all_links"))
    edges = both.join(out, ["kind", "host"]).select("kind", "host", "to_host", (F.col("links") / F.col("all_links")).alias("share"))
    rank = spread(spark, seeds, edges, follow, tolerance)
    of = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("rank"))), F.lit(0.0))
    hosts = rank.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))
    bad = (F.col("distrust") > F.col("trust")) & (F.col("distrust") > F.lit(least))
    return hosts.withColumn("by_links", F.when(bad, "block").otherwise("allow"))


def filter_urls(spark: SparkSession, pages: DataFrame, rules=RULES, follow: float = FOLLOW,
                least: float = LEAST, tolerance: float = TOLERANCE) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for every row."""
    urls = judged(pages, rules)
    hosts = stored(spark, host_verdicts(spark, pages, urls, follow, least, tolerance), "url_hosts")
    verdict = F.coalesce(F.col("by_rule"), F.col("by_links"), F.lit("allow"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    return urls.join(hosts, "host", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"), zero("trust"), zero("distrust"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = filter_urls(spark, table(spark, sf_dir, "pages"))
    return out.select("page_id", "host", "path", "rule", "verdict")


def _op6_sql() -> str:
    host = lambda rest: f"translate(regexp_extract({rest}, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}')"
    longest = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = lambda r: f"(host = '{r[1]}' OR ends_with(host, '.{r[1]}')) AND starts_with(path, '{r[2]}')"
    case = lambda pick: "CASE " + " ".join(f"WHEN {fits(r)} THEN '{pick(r)}'" for r in longest) + " END"
    after = lambda u: f"CASE WHEN contains({u}, '://') THEN substr({u}, strpos({u}, '://') + 3) ELSE '' END"
    return f"""
WITH RECURSIVE u AS (SELECT page_id, html, {after("coalesce(url, '')")} AS rest FROM pages),
p AS (SELECT page_id, html, {host('rest')} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
j AS (SELECT page_id, html, host, path, {case(lambda r: r[1] + r[2])} AS rule, {case(lambda r: r[0])} AS by_rule FROM p),
n AS (SELECT CASE WHEN by_rule = 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS n FROM j WHERE by_rule IS NOT NULL GROUP BY 1, 2),
seeds AS (SELECT kind, host, n / sum(n) OVER (PARTITION BY host) AS seed FROM n),
h AS (SELECT host AS from_host, unnest(regexp_extract_all(html, '{HREF.replace("'", "''")}', 1)) AS link FROM p),
g AS (SELECT from_host, {host(after("CASE WHEN starts_with(link, '//') THEN 'x:' || link ELSE link END"))} AS to_host FROM h WHERE contains(link, '//')),
pairs AS (SELECT from_host, to_host, count(*) AS links FROM g WHERE to_host <> '' AND to_host <> from_host GROUP BY 1, 2),
b AS (SELECT 'trust' AS kind, from_host AS host, to_host, links FROM pairs UNION ALL SELECT 'distrust', to_host, from_host, links FROM pairs),
e AS (SELECT kind, host, to_host, links / sum(links) OVER (PARTITION BY kind, host) AS share FROM b),
r AS (SELECT 0 AS k, kind, host, {1 - FOLLOW} * seed AS part FROM seeds
  UNION ALL SELECT k + 1, e.kind, e.to_host, sum({FOLLOW} * part * share) FROM r JOIN e ON r.kind = e.kind AND r.host = e.host
  GROUP BY k, e.kind, e.to_host HAVING sum({FOLLOW} * part * share) > 1e-15),
v AS (SELECT host, coalesce(sum(part) FILTER (kind = 'trust'), 0) AS trust, coalesce(sum(part) FILTER (kind = 'distrust'), 0) AS distrust FROM r GROUP BY host)
SELECT page_id, j.host, path, rule, coalesce(by_rule, CASE WHEN distrust > trust AND distrust > {LEAST} THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN v ON j.host = v.host
"""


OP6_SQL = _op6_sql()
