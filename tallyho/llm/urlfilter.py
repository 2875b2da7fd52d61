"""Operator 9, URL filters with link-graph propagation, in DataFrame functions.

A URL is judged by the longest rule that fits its host (or a parent domain)
and begins its path. URLs that no rule fits are judged by their host's place
in the link graph: trust flows along links from hosts with allowed URLs,
distrust flows backwards along links to hosts with blocked URLs (personalised
PageRank both ways), and a host whose distrust is above ``LIMIT`` times its trust is
blocked.

A host's seeds are the shares of its URLs that rules allow and block. Scores
are sums of what arrives after 0, 1, 2, ... steps; every step passes on
``DAMPING`` of the one before. Steps end when the last one added at most
``TOLERANCE`` of what it has to any host's score; a host reached for the first
time has all its score from that step. So a host gets the same score whatever
hosts without a path to it the table holds. If a step adds no more than that
share anywhere, no later one does, as it passes on the same shares of less.
Each step is one join on the host and one sum, written to the shared folder.

Rules are joined by domain and path prefix, so their number doesn't matter;
pages and links are summed by host before anything is shuffled.

Defined results: a null URL, or one without ``://``, has an empty host and path,
fits no rule and is allowed. Links within a host don't count; relative links are
such. Null html has no links. Repeated pages count as often as they are there. Of
rules with equal text the last verdict by code point wins. An empty table gives an
empty result. URLs and html of any length are read whole; one page must fit in a
task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import written

# The rules of the registered query.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
DAMPING = 0.85
TOLERANCE = 1e-6
LIMIT = 2.0
_HREF = r"""(?i)href\s*=\s*["']?([^"'\s>]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    return spark.createDataFrame(RULES if rules is None else rules, "rule_host string, rule_path string, verdict string")


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), "^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), "^[^/?#]*([^?#]*)", 1)


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, rule_verdict) for the distinct (host, path) rows that
    a rule fits."""
    parts = F.split("host", r"\.", -1)
    parents = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")
    )
    lengths = rules.groupBy("rule_host").agg(F.collect_set(F.length("rule_path")).alias("lengths"))
    keys = (
        urls.where("host <> ''")
        .select("host", "path", F.explode(parents).alias("rule_host"))
        .join(lengths, "rule_host")
        .select("host", "path", "rule_host", F.explode("lengths").alias("n"))
        .where(F.length("path") >= F.col("n"))
        .select("host", "path", "rule_host", F.substring(F.col("path"), F.lit(1), F.col("n")).alias("rule_path"))
    )
    rule = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(rule).alias("n"), rule.alias("rule"), "verdict")).alias("best")
    return (
        keys.join(rules, ["rule_host", "rule_path"])
        .groupBy("host", "path")
        .agg(best)
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("rule_verdict"))
    )


def links(pages: DataFrame, url: str, html: str) -> DataFrame:
    """(source, target, n): pages of a host with a link to another host."""
    found = F.regexp_extract_all(F.col(html), F.lit(_HREF), F.lit(1))
    absolute = F.filter(found, lambda x: x.rlike("^([A-Za-z][A-Za-z0-9+.-]*:)?//"))
    hosts = F.transform(absolute, lambda x: host_of(F.when(x.startswith("//"), F.concat(F.lit("x:"), x)).otherwise(x)))
    return (
        pages.select(host_of(F.col(url)).alias("source"), F.explode(F.array_distinct(hosts)).alias("target"))
        .where("source <> '' and target <> '' and source <> target")
        .groupBy("source", "target")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def propagate(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(host, trust, distrust) from edges (source, target, n) and seeds (host,
    trust, distrust)."""
    out = edges.groupBy("source").agg(F.sum("n").alias("total"))
    into = edges.groupBy("target").agg(F.sum("n").alias("total"))
    share = F.col("n") / F.col("total")
    ahead = edges.join(out, "source").select(F.lit("trust").alias("kind"), F.col("source").alias("a"), F.col("target").alias("b"), share.alias("w"))
    back = edges.join(into, "target").select(F.lit("distrust").alias("kind"), F.col("target").alias("a"), F.col("source").alias("b"), share.alias("w"))
    flows = written(ahead.union(back), "link-flows")
    kinds = seeds.select("host", F.explode(F.create_map(F.lit("trust"), "trust", F.lit("distrust"), "distrust")).alias("kind", "x"))
    seeded = kinds.where("x > 0").withColumn("x", F.col("x") * (1 - DAMPING))
    scores = written(seeded.withColumn("total", F.col("x")), "link-step")
    change = F.max(F.col("x") / F.col("total"))  # x: what the last step added
    while (scores.agg(change).first()[0] or 0.0) > TOLERANCE:
        moved = (
            scores.where("x > 0")
            .join(flows, (F.col("host") == F.col("a")) & (scores["kind"] == flows["kind"]))
            .select(F.col("b").alias("host"), flows["kind"].alias("kind"), (DAMPING * F.col("x") * F.col("w")).alias("x"))
        )
        before = scores.select("host", "kind", F.lit(0.0).alias("x"), "total")
        scores = written(
            moved.withColumn("total", F.col("x"))
            .unionByName(before)
            .groupBy("host", "kind")
            .agg(F.sum("x").alias("x"), F.sum("total").alias("total")),
            "link-step",
        )
    return scores.groupBy("host").agg(
        *(F.sum(F.when(F.col("kind") == k, F.col("total")).otherwise(0.0)).alias(k) for k in ("trust", "distrust"))
    )


def judge(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of ``pages``."""
    urls = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    matched = written(match_rules(urls.select("host", "path").distinct(), rules), "rule-matches")
    seeds = (
        urls.where("host <> ''")
        .groupBy("host", "path")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(matched, ["host", "path"], "left")
        .groupBy("host")
        .agg(
            *(
                (F.sum(F.when(F.col("rule_verdict") == v, F.col("n")).otherwise(0)) / F.sum("n")).alias(k)
                for k, v in (("trust", "allow"), ("distrust", "block"))
            )
        )
    )
    scores = propagate(written(links(pages, url, html), "links"), written(seeds, "link-seeds"))
    bad = written(
        scores.where(F.col("distrust") > LIMIT * F.col("trust")).select("host", F.lit(True).alias("bad")), "bad-hosts"
    )
    host_verdict = F.when(F.col("bad"), "block").otherwise("allow")
    return (
        urls.join(matched, ["host", "path"], "left")
        .join(bad, "host", "left")
        .select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", host_verdict).alias("verdict"))
    )
