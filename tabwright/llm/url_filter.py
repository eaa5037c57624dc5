"""URL filters: longest rule first, link-graph propagation for the rest (DataFrame functions only).

A url that a rule covers gets the rule's verdict.  For all others the host decides.
Hosts most of whose pages fall under block rules are blocked seeds; hosts with pages
under allow rules (and that are no blocked seed) are trusted seeds.  Personalised
PageRank carries trust from the trusted seeds along links between hosts, and distrust
from the blocked seeds along reversed links (who links to blocked hosts is suspect).
A host is blocked when distrust makes up ``threshold`` or more of its score.

Mass is a double, so a share of any size keeps its relative precision whatever the number
of seeds (down to 1e-300).  Mass at a host without links leaves the graph.  A step adds the
mass that has walked one edge more, so masses only grow.  When the k-th step adds at most
the fraction e to each host's mass, all later steps together add at most e * (k + 1) of its
final mass.  The walk ends when this bound is within ``tolerance`` on every host and can
turn no verdict.  Scores are given in 1e-12 of a kind's seed mass and nine digits, and
shares within ``TIE`` of the threshold reach it, so the order of addition has no say.

Defined results: a null url, or one without ``://``, has empty host and path, fits no
rule and is allowed; null html has no links; repeated pages each get their row; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

UNITS, TIE = 10 ** 12, 1e-9
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path) of the query.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host behind the first ``://``, A-Z lower-cased; path up to ``?`` or ``#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # shortest first, so that the last `when` wrapped around is the longest
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, host: Column, html_col: str = "html") -> DataFrame:
    """(src, dst, links) between different hosts, from absolute links in the html."""
    href = r"(?i)href\s*=\s*[\"']?\s*([a-z][a-z0-9+.-]*://[^\"'\s>]+)"
    links = pages.select(host.alias("src"), F.explode(F.regexp_extract_all(F.col(html_col), F.lit(href), F.lit(1))).alias("_url"))
    edges = links.select("src", url_parts(F.col("_url"))[0].alias("dst"))
    edges = edges.filter((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links"))


def blocks(trust: Column, distrust: Column, threshold: float) -> Column:
    return (distrust > 0) & (distrust >= F.lit(threshold * (1 - TIE)) * (trust + distrust))


def by_host(mass: DataFrame) -> DataFrame:
    """(host, trust, distrust) of (kind, host, mass)."""
    return mass.groupBy("host").agg(*[F.sum(F.when(F.col("kind") == k, F.col("mass")).otherwise(0.0)).alias(k) for k in ("trust", "distrust")])


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.8, tolerance: float = 0.01, threshold: float = 0.5) -> DataFrame:
    """(kind, host, mass) from edges (kind, src, dst, links) and seeds (kind, host, weight).

    ``kind`` keeps trust and distrust apart, so both walk in one pass."""
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("_total"))
    base = materialise(seeds.join(total, "kind").select(
        "kind", "host", (F.lit(UNITS * (1 - damping)) * F.col("weight") / F.col("_total")).alias("mass")))
    out = edges.groupBy("kind", F.col("src").alias("_src"), ).agg(F.sum("links").alias("_out")).withColumnRenamed("kind", "_kind")
    shares = edges.join(out, (F.col("kind") == F.col("_kind")) & (F.col("src") == F.col("_src")))
    shares = materialise(shares.select(F.col("kind").alias("_kind"), F.col("src").alias("_src"), "dst", (F.col("links") / F.col("_out")).alias("_share")))
    if shares.isEmpty():  # nothing to walk along: all mass stays where it starts
        return base
    rank, steps, none = base, 0, F.lit(0.0)
    while True:
        walked = rank.join(shares, (F.col("kind") == F.col("_kind")) & (F.col("host") == F.col("_src"))).select(
            "kind", F.col("dst").alias("host"), (F.col("mass") * F.col("_share") * F.lit(damping)).alias("mass")).filter("mass > 0")
        new = base.unionByName(walked).withColumn("was", none).unionByName(rank.select("kind", "host", none.alias("mass"), F.col("mass").alias("was")))
        rank = materialise(new.groupBy("kind", "host").agg(F.sum("mass").alias("mass"), F.sum("was").alias("was")))
        steps += 1
        open_share = (steps + 1) * (rank.agg(F.max((F.col("mass") - F.col("was")) / F.col("mass"))).first()[0] or 0.0)
        if open_share <= tolerance:
            most = 1 / (1 - min(open_share, 0.5))
            least_bad = blocks(F.col("trust") * most, F.col("distrust"), threshold)
            most_bad = blocks(F.col("trust"), F.col("distrust") * most, threshold)
            if open_share <= TIE or by_host(rank).filter(least_bad != most_bad).isEmpty():
                return rank.select("kind", "host", "mass")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", threshold: float = 0.5, damping: float = 0.8, tolerance: float = 0.01) -> DataFrame:
    """(id, host, path, rule, verdict, trust, distrust), one row per page."""
    host, path = url_parts(F.col(url_col))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    seen = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    seen = seen.withColumn("rule", rule).withColumn("_ruled", verdict)
    per = materialise(seen.filter("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("_ruled") == "block").cast("long")).alias("blocked"),
        F.sum((F.col("_ruled") == "allow").cast("long")).alias("allowed")))
    per = per.select("host", (F.coalesce("blocked", F.lit(0)) * 2 >= F.col("n")).alias("bad"), (F.coalesce("allowed", F.lit(0)) > 0).alias("good"))
    seeds = per.filter("bad OR good").select(F.when(F.col("bad"), F.lit("distrust")).otherwise(F.lit("trust")).alias("kind"), "host",
                                             F.lit(1.0).alias("weight"))
    links = materialise(host_edges(pages, host, html_col))
    edges = links.select(F.lit("trust").alias("kind"), "src", "dst", "links").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links"))
    scores = by_host(propagate(edges, seeds, damping, tolerance, threshold))
    short = [F.format_string("%.8e", k).cast("double").alias(k) for k in ("trust", "distrust")]
    scores = materialise(scores.select(F.col("host").alias("_host"), *short, blocks(F.col("trust"), F.col("distrust"), threshold).alias("_bad")))
    # pages of a hot host meet its scores on (host, salt)
    salted = seen.withColumn("_salt", F.pmod(F.xxhash64(id_col, "path"), F.lit(64)).cast("int"))
    spots = salted.select("host", "_salt").distinct()
    spots = spots.join(scores, spots["host"] == scores["_host"]).select(F.col("host").alias("_r_host"), F.col("_salt").alias("_r__salt"),
                                                                       "trust", "distrust", "_bad")
    met = salted.join(spots, (salted["host"] == spots["_r_host"]) & (salted["_salt"] == spots["_r__salt"]), "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    return met.select(id_col, "host", "path", "rule", F.coalesce("_ruled", F.when(F.col("_bad"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                      trust.alias("trust"), distrust.alias("distrust"))
