"""URL verdicts by rules and by trust that flows along links between hosts. DataFrame operations only.

Hosts that the rules allow are trusted seeds, hosts they block are distrusted ones. Links of all pages become weighted edges
between hosts (self links too, as they keep a host's share at home). Personalised PageRank carries trust from the
trusted seeds along the links; distrust flows against them from the blocked seeds, to those who link there. A host
with more distrust than ``balance`` times its trust is blocked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.llm.storage import Scratch

# The rules, (host, path, verdict).
RULES = (
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
)
_HREF = r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING, ROUNDS, BALANCE = 0.85, 8, 1.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower-cased; path up to ``?``, ``#`` or the end.

    Both are empty for null and where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), _UPPER, _LOWER), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, written host and path together, and its verdict; nulls if none does."""
    ranked = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    name, verdict = F.when(F.lit(False), F.lit("")), F.when(F.lit(False), F.lit(""))
    for rule_host, rule_path, what in ranked:
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name, verdict = name.when(fits, rule_host + rule_path), verdict.when(fits, what)
    return name, verdict


def _links(pages: DataFrame) -> DataFrame:
    """``(source, target, weight)``: links between hosts; each page's links weigh one together."""
    found = pages.select("host", F.regexp_extract_all("html", F.lit(_HREF), F.lit(1)).alias("links")).where(
        (F.col("host") != "") & (F.size("links") > 0)
    )
    each = found.select("host", (1 / F.size("links")).alias("share"), F.explode("links").alias("link"))
    full = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link"))
    target = F.when(full.rlike(r"(?i)^https?://"), host_and_path(full)[0]).when(full.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), "").otherwise(F.col("host"))
    return (
        each.select(F.col("host").alias("source"), target.alias("target"), "share").where("target <> ''")
        .groupBy("source", "target").agg(F.sum("share").alias("weight"))
    )


def _spread(scratch: Scratch, hosts: DataFrame, edges: DataFrame, start: str, rounds: int, damping: float) -> DataFrame:
    """``(host, rank)`` after ``rounds`` steps of personalised PageRank from the column ``start`` of ``hosts``.

    What reaches a host without links returns to the seeds. That raises the ranks by a common factor only, so they are
    scaled to a sum of one at the end. Every round is one join and one sum, written every third.
    """
    out = edges.groupBy("source").agg(F.sum("weight").alias("total"))
    step = scratch.store(edges.join(out, "source").select("source", "target", (F.col("weight") / F.col("total")).alias("p")), "steps")
    total = hosts.agg(F.sum(start)).first()[0]
    if not total:
        return hosts.select("host", F.lit(0.0).alias("rank"))
    seeds = scratch.store(hosts.select("host", (F.col(start) / total).alias("seed")), "seeds")
    ranks = seeds.select("host", F.col("seed").alias("rank"))
    for k in range(rounds):
        moved = ranks.join(step, ranks.host == step.source).groupBy("target").agg(F.sum(F.col("rank") * F.col("p")).alias("got"))
        arrived = seeds.join(moved, seeds.host == moved.target, "left").select("host", "seed", F.coalesce("got", F.lit(0.0)).alias("got"))
        held = arrived.select("host", "seed", (F.lit(damping) * F.col("got") + F.lit(1 - damping) * F.col("seed")).alias("rank"))
        last = k % 3 == 2 or k == rounds - 1
        ranks = scratch.store(held, "ranks").select("host", "rank") if last else held.select("host", "rank")
    whole = ranks.agg(F.sum("rank")).first()[0]
    return ranks.select("host", (F.col("rank") / whole).alias("rank")) if whole else ranks


def judge_urls(
    spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    rules=RULES, balance: float = BALANCE, rounds: int = ROUNDS, damping: float = DAMPING,
) -> DataFrame:
    """``(id_col, host, path, rule, verdict, trust, distrust)`` of every row of ``pages``.

    A page that fits a rule gets the longest one's verdict, any other its host's: ``block`` where distrust exceeds
    ``balance`` times trust, else ``allow``. A host's seed weight is the share of its pages under allowing or blocking rules.
    Null urls and urls without ``://`` have an empty host, no seed and no links, and are allowed. Null pages have no links;
    repeated rows count as often as they occur; other columns are not read.
    """
    scratch = Scratch(spark, "links")
    host, path = host_and_path(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parts.withColumn("rule", name).withColumn("fixed", verdict)
    links = scratch.store(_links(parts), "links")
    seeds = ruled.where("host <> ''").groupBy("host").agg(
        F.avg(F.when(F.col("fixed") == "allow", 1.0).otherwise(0.0)).alias("good"),
        F.avg(F.when(F.col("fixed") == "block", 1.0).otherwise(0.0)).alias("bad"),
    )
    ends = links.select(F.col("target").alias("host")).distinct().join(seeds, "host", "left_anti")
    hosts = scratch.store(seeds.union(ends.select("host", F.lit(0.0), F.lit(0.0))), "hosts")
    trust = _spread(scratch, hosts, links, "good", rounds, damping)
    back = links.select(F.col("target").alias("source"), F.col("source").alias("target"), "weight")
    distrust = _spread(scratch, hosts, back, "bad", rounds, damping)
    judged = scratch.store(
        trust.select("host", F.col("rank").alias("trust")).join(distrust.select("host", F.col("rank").alias("distrust")), "host"), "judged"
    )
    # Per-host scores are few beside pages; a hot host's pages stay where they are if Spark finds them small.
    out = ruled.drop("html").join(judged, "host", "left").withColumn(
        "own", F.when(F.col("distrust") > F.lit(balance) * F.col("trust") + 1e-12, "block").otherwise("allow")
    )
    return out.select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("fixed", "own").alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
