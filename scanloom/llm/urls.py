"""URL filter: host/path rules first, then link-graph propagation for what no rule decides.

Trust is a personalised PageRank from hosts that allow-rules vouch for, along the links between hosts; distrust
starts at hosts that block-rules name and runs against the links, to those who link to them. A host without a
rule is blocked where its distrust is above the threshold and above its trust.

Built-in functions and joins only. Pages become (host, host) edge counts in one aggregation with map-side
combine, so what iterates is the host graph, never the pages; hub hosts are split by the adaptive skew join.
State is cut to checkpoint() in the shared folder every few rounds.

Cases: a null url, or one without `://`, has an empty host and path, fits no rule and is allowed; null html has
no links; repeated pages count as often as they occur; an empty table gives an empty result; columns other than
those named are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.llm.common import materialise, shared_dir

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Absolute and protocol-relative link targets; relative ones stay on their host and carry no score.
HREF = r"""(?i)href\s*=\s*["']?\s*((?:https?:)?//[^/?#"'\s<>]+)"""
#: Rules become one Column expression each; longer lists belong in a table joined on host suffixes.
MAX_RULES = 500


@dataclass(frozen=True)
class UrlRule:
    """`rule` is host/path-prefix, like example.net/en/; it fits the host and its subdomains."""

    rule: str
    verdict: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


DEFAULT_RULES = (UrlRule("net/", "block"), UrlRule("example.net/en/", "allow"), UrlRule("example.com/de/", "block"), UrlRule("org/fr/", "allow"))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


#: User before, port after a host; an address in brackets keeps its colons.
BARE = r"^(?:[^@]*@)?(\[[^\]]*\]|[^:]*)"


def node_of(host: Column) -> Column:
    """The host in the link graph: without user and port, as links name it with either or neither."""
    return F.regexp_extract(host, BARE, 1)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """struct(length, rule, verdict) of the longest rule that fits, else null. Ties go to the larger rule text."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    fitting = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(len(r.rule)).alias("length"), F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    return F.array_max(F.array(*fitting)) if fitting else F.lit(None).cast("struct<length:int,rule:string,verdict:string>")


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, n): links between different hosts."""
    return (
        pages.select(node_of(host_of(F.col(url_col))).alias("src"), F.explode(F.regexp_extract_all(F.col(html_col), F.lit(HREF), F.lit(1))).alias("link"))
        .select("src", node_of(F.translate(F.regexp_extract("link", r"//([^/?#]*)", 1), _UPPER, _LOWER)).alias("dst"))
        .filter("src <> '' AND dst <> '' AND src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("n"))
    )


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int = 12, cut_every: int = 3) -> DataFrame:
    """(host, trust, distrust). edges: (src, dst, n); seeds: (host, trust, distrust), each column summing to 1.

    Both walks run as one: an arc carries trust from src to dst by the link's share of src's links, and
    distrust from dst to src by its share of dst's. What reaches a host without arcs ends there."""
    shared_dir(edges.sparkSession)
    out_n = edges.groupBy("src").agg(F.sum("n").alias("total"))
    in_n = edges.groupBy("dst").agg(F.sum("n").alias("total"))
    arcs = materialise(
        edges.join(out_n, "src").select(F.lit("trust").alias("kind"), F.col("src").alias("at"), F.col("dst").alias("to"), (F.col("n") / F.col("total")).alias("p"))
        .unionByName(edges.join(in_n, "dst").select(F.lit("distrust").alias("kind"), F.col("dst").alias("at"), F.col("src").alias("to"), (F.col("n") / F.col("total")).alias("p"))),
        "url-arcs",
    )
    start = seeds.select("host", F.explode(F.create_map(F.lit("trust"), F.col("trust"), F.lit("distrust"), F.col("distrust"))).alias("kind", "score")).filter("score > 0")
    start = materialise(start.select("kind", "host", (F.col("score") * (1 - damping)).alias("score")), "url-seeds")
    state = start
    if not arcs.isEmpty():
        for k in range(1, rounds + 1):
            moved = arcs.join(state, (arcs["kind"] == state["kind"]) & (arcs["at"] == state["host"])).select(arcs["kind"], F.col("to").alias("host"), (F.col("score") * F.col("p") * damping).alias("score"))
            state = start.unionByName(moved).groupBy("kind", "host").agg(F.sum("score").alias("score"))
            if k % cut_every == 0 and k < rounds:
                state = state.checkpoint()
    score = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)).alias(kind)
    return state.groupBy("host").agg(score("trust"), score("distrust"))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[UrlRule] = DEFAULT_RULES,
    threshold: float = 1.0,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Per page: id, host, path, rule (or null) and verdict (allow or block).

    `threshold` is the distrust, in multiples of a host's even share of it, from which a host without a rule is
    blocked if its trust is lower."""
    places = pages.select(F.col(id_col).alias(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    places = places.withColumn("best", best_rule(F.col("host"), F.col("path"), rules)).withColumn("node", node_of(F.col("host")))
    vouched = places.filter("node <> ''").groupBy(F.col("node").alias("host")).agg(F.count_if(F.col("best.verdict") == "allow").alias("good"), F.count_if(F.col("best.verdict") == "block").alias("bad"))
    vouched = materialise(vouched, "url-hosts")
    total = vouched.agg(F.count("*").alias("hosts"), F.sum("good").alias("good"), F.sum("bad").alias("bad")).collect()[0]
    seeds = vouched.select("host", (F.col("good") / float(max(total["good"] or 0, 1))).alias("trust"), (F.col("bad") / float(max(total["bad"] or 0, 1))).alias("distrust"))
    scores = propagate(host_edges(pages, url_col, html_col), seeds)
    blocked = materialise(
        scores.filter((F.col("distrust") * float(max(total["hosts"], 1)) >= threshold) & (F.col("distrust") > F.col("trust"))).select("host", F.lit(True).alias("spam")),
        "url-blocked",
    )
    return places.join(blocked.withColumnRenamed("host", "node"), "node", "left").select(
        id_col, "host", "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.when(F.col("spam"), "block"), F.lit("allow")).alias("verdict"),
    )


def oracle(rounds: int = 12, damping: float = 0.85, threshold: float = 1.0, rules: Sequence[UrlRule] = DEFAULT_RULES) -> str:
    """The same verdicts in SQL, the rounds written out."""
    values = ", ".join(f"('{r.rule}', '{r.host}', '{r.path}', '{r.verdict}')" for r in rules)
    step = "\n".join(
        f""", s{k} AS (SELECT kind, host, sum(score) AS score FROM (
  SELECT kind, host, score FROM s0 UNION ALL
  SELECT a.kind, a."to", {damping} * s.score * p FROM arcs a JOIN s{k - 1} s ON a.kind = s.kind AND a."at" = s.host) GROUP BY ALL)"""
        for k in range(1, rounds + 1)
    )
    lower = f"translate(%s, '{_UPPER}', '{_LOWER}')"
    return rf"""
WITH rules(rule, rhost, rpath, verdict) AS (VALUES {values}), p AS (
  SELECT page_id, coalesce({lower % "regexp_extract(url, '://([^/?#]*)', 1)"}, '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path, html FROM pages
), q AS (
  SELECT page_id, host, path, max(CASE WHEN rule IS NOT NULL THEN lpad(CAST(length(rule) AS VARCHAR), 6, '0') || rule END) AS best
  FROM p LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY ALL
), j AS (SELECT q.*, rule, verdict FROM q LEFT JOIN rules ON rule = best[7:]),
h AS (SELECT regexp_extract(host, '{BARE}', 1) AS host, count(*) FILTER (verdict = 'allow') AS good, count(*) FILTER (verdict = 'block') AS bad FROM j WHERE regexp_extract(host, '{BARE}', 1) <> '' GROUP BY 1),
t AS (SELECT count(*) AS hosts, greatest(sum(good), 1) AS good, greatest(sum(bad), 1) AS bad FROM h),
links AS (SELECT regexp_extract(host, '{BARE}', 1) AS src, unnest(regexp_extract_all(html, '(?i)href\s*=\s*["'']?\s*((?:https?:)?//[^/?#"''\s<>]+)', 1)) AS link FROM p),
e AS (SELECT src, dst, count(*) AS n FROM (SELECT src, regexp_extract({lower % "regexp_extract(link, '//([^/?#]*)', 1)"}, '{BARE}', 1) AS dst FROM links)
      WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL),
arcs AS (SELECT 'trust' AS kind, src AS "at", dst AS "to", n / sum(n) OVER (PARTITION BY src) AS p FROM e
         UNION ALL SELECT 'distrust', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM e),
s0 AS (SELECT 'trust' AS kind, host, {1 - damping} * h.good / t.good AS score FROM h, t WHERE h.good > 0
       UNION ALL SELECT 'distrust', host, {1 - damping} * h.bad / t.bad FROM h, t WHERE h.bad > 0)
{step},
v AS (SELECT host, coalesce(sum(score) FILTER (kind = 'trust'), 0) AS trust, coalesce(sum(score) FILTER (kind = 'distrust'), 0) AS distrust FROM s{rounds} GROUP BY host)
SELECT page_id, j.host, path, rule,
       coalesce(verdict, CASE WHEN distrust * (SELECT hosts FROM t) >= {threshold} AND distrust > trust THEN 'block' END, 'allow') AS verdict
FROM j LEFT JOIN v ON regexp_extract(j.host, '{BARE}', 1) = v.host
"""
