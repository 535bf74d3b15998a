"""URL filter: rules first, then trust and distrust spread over the links between hosts.

A page whose url fits a rule takes the verdict of the longest. For the others the host decides. Pages with a rule make
their host a seed, of trust by its share of all allowed pages and of distrust by its share of all blocked ones. Trust
flows along links (a host that trusted hosts link to is trusted), distrust against them (a host that links to blocked hosts is
suspect): two personalised PageRanks, iterated in Spark over the distinct links between hosts until nothing moves. A host
is blocked where its distrust exceeds its trust by more than the share ``MARGIN`` of it, whatever their size; a host that neither reaches is allowed.

Links come from ``href`` attributes with a host of their own; links inside a host do not count. What flows into a host
without links ends there. Ranks are added up per host with map-side combine, so a host with a third of all pages or links is
no hot key; the verdicts are joined to pages by host, which Spark may split.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and is judged as the host ""
(allowed, unless linked otherwise); a null html has no links; repeated rows stay; an empty table gives an empty result;
added columns are the only ones returned besides the id.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.llm.common import forget, is_empty, store

DAMPING = 0.85
ROUNDS = 4000           # only an error: about as many links as a rank can cross before it underflows
STILL = 1e-12           # largest change of a host's rank in the last round, as a share of the rank
MARGIN = 1e-9
LINK = r"""(?i)href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def lowered(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return lowered(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null without one."""
    ordered = sorted(rules, key=lambda r: -len(r.text))
    fits = [((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path) for r in ordered]
    none = F.lit(None).cast("string")
    rule = reduce(lambda out, k: F.when(fits[k], ordered[k].text).otherwise(out), reversed(range(len(ordered))), none)
    verdict = reduce(lambda out, k: F.when(fits[k], ordered[k].verdict).otherwise(out), reversed(range(len(ordered))), none)
    return rule, verdict


def host_links(pages: DataFrame, html_col: str) -> DataFrame:
    """Distinct ``src``, ``dst`` between different hosts. ``pages``: ``host`` and the html."""
    found = F.regexp_extract_all(F.col(html_col), F.lit(LINK), F.lit(1))
    return (pages.select(F.col("host").alias("src"), F.explode(F.array_distinct(found)).alias("to"))
            .select("src", lowered(F.col("to")).alias("dst")).where("src != dst").distinct())


def propagated(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``host``, ``trust``, ``distrust``. ``seeds``: ``host``, ``st``, ``sb`` (teleport shares); ``links``: ``src``, ``dst``."""
    outs = links.groupBy("src").agg(F.count("*").alias("n_out"))
    ins = links.groupBy("dst").agg(F.count("*").alias("n_in"))
    edges = store(links.join(outs, "src").join(ins, "dst"), "host-links")
    hosts = store(seeds.select("host", "st", "sb").unionByName(
        links.selectExpr("explode(array(src, dst)) as host", "0d as st", "0d as sb"))
        .groupBy("host").agg(F.sum("st").alias("st"), F.sum("sb").alias("sb")), "hosts")
    ranks = hosts.select("host", F.col("st").alias("trust"), F.col("sb").alias("distrust"))
    for _ in range(rounds):
        along = edges.join(ranks, edges["src"] == ranks["host"]).select(
            F.col("dst").alias("host"), (F.col("trust") / F.col("n_out")).alias("t"), F.lit(0.0).alias("b"))
        against = edges.join(ranks, edges["dst"] == ranks["host"]).select(
            F.col("src").alias("host"), F.lit(0.0).alias("t"), (F.col("distrust") / F.col("n_in")).alias("b"))
        flow = along.unionByName(against).groupBy("host").agg(F.sum("t").alias("t"), F.sum("b").alias("b"))
        old = ranks.select("host", F.col("trust").alias("t0"), F.col("distrust").alias("b0"))
        moved = hosts.join(flow, "host", "left").join(old, "host")
        after = store(moved.select(
            "host", ((1 - damping) * F.col("st") + damping * F.coalesce("t", F.lit(0.0))).alias("trust"),
            ((1 - damping) * F.col("sb") + damping * F.coalesce("b", F.lit(0.0))).alias("distrust"), "t0", "b0"), "ranks")
        moving = after.where((F.abs(F.col("trust") - F.col("t0")) > STILL * F.col("trust"))
                             | (F.abs(F.col("distrust") - F.col("b0")) > STILL * F.col("distrust")))
        done = is_empty(moving)
        forget(ranks)
        ranks = after
        if done:
            break
    else:
        raise RuntimeError(f"host ranks still move after {rounds} rounds")
    forget(edges, hosts)
    return ranks.select("host", "trust", "distrust")


def judged(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The id, ``host``, ``path``, ``rule`` and ``verdict`` of every page, and its host's ``trust`` and ``distrust``."""
    url = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"),
                       path_of(F.col(url_col)).alias("path"), F.col(html_col).alias("html"))
    rule, verdict = matched(F.col("host"), F.col("path"), rules)
    links = store(host_links(url, "html"), "links")
    narrow = store(url.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict")), "judged")
    per_host = narrow.groupBy("host").agg(F.count_if(F.col("verdict") == "allow").cast("double").alias("a"),
                                          F.count_if(F.col("verdict") == "block").cast("double").alias("b"))
    sums = narrow.agg(F.count_if(F.col("verdict") == "allow"), F.count_if(F.col("verdict") == "block")).first()
    seeds = per_host.select("host", (F.col("a") / float(max(sums[0], 1))).alias("st"), (F.col("b") / float(max(sums[1], 1))).alias("sb"))
    ranks = propagated(seeds, links)
    of_host = F.when(F.col("distrust") > F.col("trust") * (1 + MARGIN), "block").otherwise("allow")
    return (narrow.join(ranks, "host", "left")
            .select("page_id", "host", "path", "rule", F.coalesce("verdict", of_host).alias("verdict"), "trust", "distrust"))


ORACLE_SQL = r"""
WITH RECURSIVE u AS (
  SELECT page_id, html,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
j AS (SELECT u.page_id, u.host, u.path, arg_max(r.h || r.p, length(r.h || r.p)) AS rule,
    arg_max(r.verdict, length(r.h || r.p)) AS ruled
  FROM u LEFT JOIN rules r ON (u.host = r.h OR ends_with(u.host, '.' || r.h)) AND starts_with(u.path, r.p)
  GROUP BY u.page_id, u.host, u.path),
links AS (SELECT DISTINCT src, dst FROM (SELECT host AS src, translate(unnest(regexp_extract_all(html,
    '(?i)href\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s>]+)', 1)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst
  FROM u) WHERE src <> dst),
edges AS (SELECT src, dst, count(*) OVER (PARTITION BY src) AS n_out, count(*) OVER (PARTITION BY dst) AS n_in FROM links),
seeds AS (SELECT host, sum(st) AS st, sum(sb) AS sb FROM (
    SELECT host, count(*) FILTER (ruled = 'allow') / greatest(1.0, (SELECT count(*) FROM j WHERE ruled = 'allow')) AS st,
      count(*) FILTER (ruled = 'block') / greatest(1.0, (SELECT count(*) FROM j WHERE ruled = 'block')) AS sb FROM j GROUP BY host
    UNION ALL SELECT src, 0, 0 FROM links UNION ALL SELECT dst, 0, 0 FROM links) GROUP BY host),
ranks(step, host, trust, distrust) AS (
  SELECT 0, host, st::DOUBLE, sb::DOUBLE FROM seeds
  UNION ALL
  SELECT any_value(f.step) + 1, s.host, 0.15 * any_value(s.st) + 0.85 * coalesce(sum(f.t), 0),
    0.15 * any_value(s.sb) + 0.85 * coalesce(sum(f.b), 0)
  FROM seeds s JOIN (
    SELECT r.step, r.host, 0.0 AS t, 0.0 AS b FROM ranks r
    UNION ALL SELECT r.step, e.dst, r.trust / e.n_out, 0.0 FROM ranks r JOIN edges e ON e.src = r.host
    UNION ALL SELECT r.step, e.src, 0.0, r.distrust / e.n_in FROM ranks r JOIN edges e ON e.dst = r.host) f ON f.host = s.host
  WHERE f.step < 400 GROUP BY s.host)
SELECT j.page_id, j.host, j.path, j.rule,
  coalesce(j.ruled, CASE WHEN k.distrust > k.trust * (1 + 1e-9) THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN (SELECT * FROM ranks WHERE step = 400) k ON k.host = j.host
"""
