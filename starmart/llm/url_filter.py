"""URL filters: rules by host and path, and trust spread over the links between hosts.

Where no rule fits, the host decides. A host's seeds are the shares of its pages that the rules allow and block. Trust
is the personalised PageRank of the allowed seeds along the links, distrust that of the blocked seeds against them.
A PageRank is divided among a host's neighbours, so its size says little about one of them: hosts are judged by blame,
the damped mean blame of what their own links lead to, and their blocked seed at least. So who links to blocked hosts
shares their blame, however many others do, and linked to or not.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import cut, lowered

#: (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: A tag ends where the next begins, and white space is not given back: linear also in tags that never close.
LINK = r"""(?i)<[^<>]*?\s(?:href|src|action)\s*+=\s*+["']?\s*+([^"'\s<>]+)"""


@dataclass(frozen=True)
class TrustParams:
    """A host is blocked when its blame reaches ``threshold``, its trust and its allowed seed. Steps go on until no score moves by
    ``tolerance`` in ``per_cut`` of them, after which the plan is cut; ``steps`` ends them where that is already certain:
    damping ** steps is below it."""

    rules: tuple[tuple[str, str, str], ...] = RULES
    damping: float = 0.85
    tolerance: float = 1e-4
    steps: int = 60
    per_cut: int = 5
    threshold: float = 0.5
    broadcast_hosts: int = 100_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Null or no ``://``: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return lowered(host), path


def _fitting(rules, host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for action, of, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(prefix)
        rule, verdict = F.when(fits, of + prefix).otherwise(rule), F.when(fits, action).otherwise(verdict)
    return rule, verdict


def ruled(pages: DataFrame, params: TrustParams) -> DataFrame:
    """page_id, host, path, rule, and the rule's verdict or null."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = _fitting(params.rules, F.col("host"), F.col("path"))
    return rows.withColumns({"rule": rule, "verdict": verdict})


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, links) between different hosts, counted from every link of every page; relative links stay at home."""
    host, _ = host_and_path(F.col("url"))
    links = F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)))
    rows = pages.select(host.alias("src"), links.alias("link"))
    absolute = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link"))
    rows = rows.filter(F.col("link").rlike(r"^(?i:https?:)?//")).select("src", host_and_path(absolute)[0].alias("dst"))
    return rows.filter("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("links"))


def spread(seeds: DataFrame, edges: DataFrame, params: TrustParams) -> DataFrame:
    """(host, trust, distrust) for ``seeds`` (host, trust, distrust) and ``edges`` (src, dst, links).

    One edge list holds both directions: trust goes from src to dst, distrust from dst to src, each divided among a
    host's edges by links. Hosts without edges that way keep what they hold, so mass is never lost.
    """
    both = edges.select(F.lit("t").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "links").union(
        edges.select(F.lit("d").alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b"), "links")
    )
    out = both.groupBy("kind", "a").agg(F.sum("links").alias("all_links"))
    both = cut(both.join(out, ["kind", "a"]).select("kind", "a", "b", (F.col("links") / F.col("all_links")).alias("share")))
    if both.isEmpty():
        return seeds
    start = seeds.select(F.lit("t").alias("kind"), "host", F.col("trust").alias("seed")).union(
        seeds.select(F.lit("d").alias("kind"), "host", F.col("distrust").alias("seed"))
    )
    ends = both.select("kind", F.col("b").alias("host"), F.lit(0.0).alias("seed"))
    nodes = cut(start.union(ends).groupBy("kind", "host").agg(F.sum("seed").alias("seed")))
    d = params.damping
    # a host without edges that way is its own neighbour; then a step names the ranks once, and the plan grows by one join
    leaving = both.select("kind", F.col("a").alias("host")).distinct()
    stay = nodes.join(leaving, ["kind", "host"], "left_anti").select("kind", F.col("host").alias("a"), F.col("host").alias("b"), F.lit(1.0).alias("share"))
    both = cut(both.union(stay))
    given = nodes.select("kind", "host", ((1 - d) * F.col("seed")).alias("rank"))
    ranks = was = nodes.select("kind", "host", F.col("seed").alias("rank"))
    for step in range(1, params.steps + 1):
        sent = ranks.select("kind", F.col("host").alias("a"), "rank").join(both, ["kind", "a"])
        sent = sent.select("kind", F.col("b").alias("host"), (d * F.col("rank") * F.col("share")).alias("rank"))
        ranks = sent.union(given).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if step % params.per_cut == 0 or step == params.steps:
            ranks = cut(ranks)
            moved = ranks.join(was.withColumnRenamed("rank", "was"), ["kind", "host"]).agg(F.max(F.abs(F.col("rank") - F.col("was"))))
            if (moved.first()[0] or 0.0) < params.tolerance:
                break
            was = ranks
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("rank")).otherwise(0.0))
    return ranks.groupBy("host").agg(of("t").alias("trust"), of("d").alias("distrust"))


def blamed(seeds: DataFrame, edges: DataFrame, params: TrustParams) -> DataFrame:
    """(host, blame) of hosts with any: the blocked seed or, if greater, the damped mean over the host's own links."""
    all_links = edges.groupBy("src").agg(F.sum("links").alias("all_links"))
    shares = cut(edges.join(all_links, "src").select("src", "dst", (F.col("links") / F.col("all_links")).alias("share")))
    seeds = cut(seeds.filter("distrust > 0").select("host", F.col("distrust").alias("blame")))
    if shares.isEmpty():
        return seeds
    now = seeds
    for step in range(1, params.steps + 1):
        got = shares.join(now.select(F.col("host").alias("dst"), "blame"), "dst").groupBy(F.col("src").alias("host"))
        got = got.agg((F.lit(params.damping) * F.sum(F.col("share") * F.col("blame"))).alias("blame"))
        was, now = now, got.union(seeds).groupBy("host").agg(F.max("blame").alias("blame"))
        if step % params.per_cut == 0 or step == params.steps:
            was, now = cut(was), cut(now)
            moved = now.join(was.withColumnRenamed("blame", "was"), "host", "left").select(F.max(F.col("blame") - F.coalesce("was", F.lit(0.0))))
            if (moved.first()[0] or 0.0) < params.tolerance:
                break
    return now


def judge(pages: DataFrame, params: TrustParams = TrustParams()) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages``.

    Null urls and urls without ``://`` have an empty host, which no rule fits and no host decides: allowed. Null html
    has no links. Repeated rows count as often as they stand. Only page_id, url and html are read. An empty table
    gives an empty result.
    """
    rows = ruled(pages, params)
    of = lambda verdict: F.count_if(F.col("verdict") == verdict) / F.count("*")
    seeds = cut(rows.filter("host <> ''").groupBy("host").agg(of("allow").alias("trust"), of("block").alias("distrust")))
    edges = cut(host_edges(pages))
    hosts = spread(seeds, edges, params).select("host", "trust").join(blamed(seeds, edges, params), "host")
    hosts = hosts.join(seeds.select("host", F.col("trust").alias("seed")), "host", "left")
    bad = (F.col("blame") >= params.threshold) & (F.col("blame") >= F.greatest("trust", "seed"))
    blocked = cut(hosts.filter(bad).select("host", F.lit("block").alias("_host_verdict")))
    if blocked.count() <= params.broadcast_hosts:
        blocked = F.broadcast(blocked)
    judged = rows.join(blocked, "host", "left")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("verdict", "_host_verdict", F.lit("allow")).alias("verdict"))
