"""URL filtering: host rules first, link-graph propagation for the rest.

A url that a rule fits takes the verdict of the longest such rule.  All other
urls take their host's verdict: the pages that rules allow or block are the
seeds (a host weighs the number of its seed pages), trust flows along links
and distrust against them (a host that links to blocked hosts is suspect).
Both are personalised PageRanks as sums over walks,
``score = (1 - d) * sum(d^k * P^k * seed)``, computed on host edges with
their link counts as weights.  A host is blocked when its distrust is at least ``threshold``
times the seed weight of a host whose pages are all blocked, and larger than its trust.

Defined cases: a null url, or one without ``://``, has empty host and path,
fits no rule and is allowed; a page without html has no links; links to the
own host do not count; repeated rows count as often as they occur; an empty
table gives an empty result; extra columns are kept.  DataFrame operations
only; the driver sees one convergence number per round.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialize, reserve

# Fixed values of the url rules: (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
LINK = r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]*)"""


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits (of equally long
    ones a blocking one), or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block")):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
                     ).otherwise(out)
    return out


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Add ``host``, ``path`` and ``rule``, ``rule_verdict`` (null: no rule)."""
    out = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    out = out.withColumn("_r", rule_of(F.col("host"), F.col("path"), rules))
    return out.withColumn("rule", F.col("_r.rule")).withColumn(
        "rule_verdict", F.col("_r.verdict")).drop("_r")


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, links) between different hosts, from absolute links in the html."""
    links = pages.select("host", F.explode(F.regexp_extract_all(
        F.col("html"), F.lit(LINK), F.lit(1))).alias("dst"))
    return (links.select(F.col("host").alias("src"), ascii_lower(F.col("dst")).alias("dst"))
            .filter("src != dst and src != '' and dst != ''")
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links")))


def propagate(hosts: DataFrame, edges: DataFrame, damping: float = 0.85,
              rounds: int | None = None, tolerance: float = 1e-6) -> DataFrame:
    """``hosts`` (host, trust_seed, distrust_seed) and their scores ``trust``,
    ``distrust``.  Stops when a round adds less than ``tolerance`` of the seeds,
    or after ``rounds``; by default after as many as that takes at most (a round
    adds at most ``damping`` of what the one before it added).

    Each round carries only the walks' newest step (a host reached by no walk
    of that length has no row) and adds it to the sums so far.
    """
    if rounds is None:
        rounds = max(1, math.ceil(math.log(tolerance / (1 - damping), damping)) + 1)
    out_sum = edges.groupBy("src").agg(F.sum("links").alias("_s")).withColumnRenamed("src", "_n")
    in_sum = edges.groupBy("dst").agg(F.sum("links").alias("_s")).withColumnRenamed("dst", "_n")
    share = F.col("links") / F.col("_s")
    zero = F.lit(0.0)
    steps = materialize(
        edges.join(out_sum, edges.src == F.col("_n")).select(
            F.col("src").alias("at"), F.col("dst").alias("to"), share.alias("t"), zero.alias("b"))
        .unionByName(edges.join(in_sum, edges.dst == F.col("_n")).select(
            F.col("dst").alias("at"), F.col("src").alias("to"), zero.alias("t"), share.alias("b"))),
        "url-steps")
    front = hosts.select("host", (F.col("trust_seed") * (1 - damping)).alias("trust"),
                         (F.col("distrust_seed") * (1 - damping)).alias("distrust"))
    total = front
    start = hosts.agg(F.sum(F.col("trust_seed") + F.col("distrust_seed"))).first()[0] or 0.0
    if start > 0 and not steps.isEmpty():
        for _ in range(rounds):
            front = materialize(
                steps.join(front, F.col("at") == F.col("host"))
                .groupBy(F.col("to").alias("host"))
                .agg((F.sum(F.col("t") * F.col("trust")) * damping).alias("trust"),
                     (F.sum(F.col("b") * F.col("distrust")) * damping).alias("distrust"))
                .filter("trust > 0 or distrust > 0"), "url-front")
            total = total.unionByName(front)
            added = front.agg(F.sum(F.col("trust") + F.col("distrust"))).first()[0] or 0.0
            if added < tolerance * start:
                break
    return total.groupBy("host").agg(F.sum("trust").alias("trust"),
                                     F.sum("distrust").alias("distrust"))


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
                threshold: float = 0.5, damping: float = 0.85) -> DataFrame:
    """``pages`` (url, html and any others) without html, with host, path,
    rule, verdict and the host's trust and distrust, none of which ``pages``
    may have yet (ValueError)."""
    reserve(pages, "host", "path", "rule", "rule_verdict", "verdict", "trust", "distrust", "n_pages",
            "_r", "_host", "_bad")
    seen = judged(pages, rules)
    edges = materialize(host_edges(seen), "url-edges")
    known = seen.filter("host != ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.sum(F.when(F.col("rule_verdict") == "allow", 1.0).otherwise(0.0)).alias("trust_seed"),
        F.sum(F.when(F.col("rule_verdict") == "block", 1.0).otherwise(0.0)).alias("distrust_seed"))
    known = materialize(known, "url-hosts")
    scores = propagate(known, edges, damping)
    alike = F.lit((1 - damping) * threshold) * F.col("n_pages")
    hosts = known.join(scores, "host").select(
        F.col("host").alias("_host"), "trust", "distrust",
        ((F.col("distrust") >= alike) & (F.col("distrust") > F.col("trust"))).alias("_bad"))
    by_host = F.when(F.coalesce(F.col("_bad"), F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))
    return (seen.drop("html").join(hosts, F.col("host") == F.col("_host"), "left")
            .withColumn("verdict", F.coalesce(F.col("rule_verdict"), by_host))
            .drop("_host", "_bad", "rule_verdict"))
