"""Operator 8: URL verdicts by rules and by trust that spreads over the host graph.

A URL is first held against path rules; the longest fitting rule decides. Where
no rule fits, its host's standing decides: hosts most of whose URLs the rules
allow are trusted seeds, hosts most of whose URLs they block are distrusted
seeds. Personalised PageRank carries trust along the links between hosts, each
host sharing out its trust by its links. Reversed personalised PageRank carries
distrust against them: a host that links to blocked hosts is suspect, and each host's
distrust is shared out among those that link to it. A host is blocked if distrust makes up
``threshold`` of its trust and distrust together. That is a ratio, so however many link to a
blocked host, each is as suspect as if it were alone: a host that no trust reaches is blocked by any
distrust (within ``ROUNDS`` links), one that trust reaches is weighed. A host that neither reaches is allowed.

Defined cases: a null URL, or one without ``://``, has empty host and path, no
rule, and is allowed; repeated rows are judged alike; null HTML has no links;
an empty table gives an empty result; only page_id, url and html are read, so
further columns of any name are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recoflow.llm.common import materialize

#: (verdict, host, path)
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
DAMPING = 0.85
ROUNDS = 10
THRESHOLD = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1))
    rest = F.when(rest.isNotNull(), url.substr(F.length(rest) + 4, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = rest.substr(F.length(host) + 1, F.length(rest))
    return F.translate(host, UPPER, LOWER), F.regexp_extract(tail, r"^[^?#]*", 0)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest fitting rule, else null; of rules of one
    length, the alphabetically first."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    for says, h, p in reversed(ordered):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, F.lit(h + p)).otherwise(text)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return text, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, links) between different hosts, from absolute hrefs."""
    href = F.explode(F.regexp_extract_all("html", F.lit(r"""(?i)href\s*=\s*["']?((?:https?:)?//[^"'\s>]*)"""), 1))
    found = pages.where(F.contains(F.lower("html"), F.lit("//"))).select("host", href.alias("href"))
    dst, _ = url_parts(F.when(F.col("href").startswith("//"), F.concat(F.lit("x:"), "href"))
                       .otherwise(F.col("href")))
    found = found.select(F.col("host").alias("src"), dst.alias("dst"))
    return (found.where("src <> '' and dst <> '' and src <> dst")
            .groupBy("src", "dst").agg(F.count("*").alias("links")))


def spread(hosts: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust). ``hosts``: (host, trusted, distrusted), seeds 0 or 1.

    Each round is two equi-joins of the edges with the current standing and one
    partial sum per host.
    """
    rank = hosts.select("host", F.col("trusted").cast("double").alias("trust"),
                        F.col("distrusted").cast("double").alias("distrust"))
    if edges.isEmpty():
        return rank
    out, into = (edges.groupBy(end).agg(F.sum("links").alias(n)) for end, n in (("src", "n_out"), ("dst", "n_in")))
    e = edges.join(out, "src").join(into, "dst")
    e = materialize(e.select("src", "dst", (F.col("links") / F.col("n_out")).alias("forward"), (F.col("links") / F.col("n_in")).alias("back")), "links")
    for i in range(rounds):
        gained = (e.join(rank, e.src == rank.host)
                  .select(F.col("dst").alias("host"), (F.col("trust") * F.col("forward")).alias("t"), F.lit(0.0).alias("d"))
                  .union(e.join(rank, e.dst == rank.host)
                         .select(F.col("src").alias("host"), F.lit(0.0).alias("t"),
                                 (F.col("distrust") * F.col("back")).alias("d")))
                  .groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d")))
        rank = hosts.join(gained, "host", "left").select(
            "host",
            ((1 - damping) * F.col("trusted") + damping * F.coalesce("t", F.lit(0.0))).alias("trust"),
            ((1 - damping) * F.col("distrusted") + damping * F.coalesce("d", F.lit(0.0))).alias("distrust"))
        if i % 3 == 2:
            rank = materialize(rank, "rank")
    return rank


def judge_urls(pages: DataFrame, rules=RULES, damping: float = DAMPING, rounds: int = ROUNDS,
               threshold: float = THRESHOLD) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, trust, distrust."""
    host, path = url_parts(F.col("url"))
    parsed = pages.select("page_id", "html", host.alias("host"), path.alias("path"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    judged = parsed.select("page_id", "host", "path", rule.alias("rule"), says.alias("says"))
    edges = materialize(host_links(parsed), "host-links")
    share = lambda v: F.sum((F.col("says") == v).cast("int"))
    known = judged.groupBy("host").agg(F.count("*").alias("n"), share("allow").alias("a"), share("block").alias("b"))
    hosts = known.select("host", (F.col("a") * 2 > F.col("n")).cast("int").alias("trusted"),
                         (F.col("b") * 2 > F.col("n")).cast("int").alias("distrusted"))
    linked = edges.select(F.col("src").alias("host")).union(edges.select("dst"))
    hosts = (hosts.union(linked.select("host", F.lit(0), F.lit(0))).groupBy("host")
             .agg(F.max(F.coalesce("trusted", F.lit(0))).alias("trusted"),
                  F.max(F.coalesce("distrusted", F.lit(0))).alias("distrusted")))
    standing = spread(materialize(hosts, "hosts"), edges, damping, rounds)
    # Rounded, so that the order of summation cannot show.
    part = F.round(F.try_divide(F.col("distrust"), F.col("trust") + F.col("distrust")), 9)
    by_host = F.when(part >= threshold, "block").otherwise("allow")
    return judged.join(standing, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("says", by_host).alias("verdict"), "trust", "distrust")
