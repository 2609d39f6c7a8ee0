"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.llm.storage import Scratch


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
    return tuple(row)


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``, root being its component's smallest node.

    Links of a node to itself and null ends are ignored. Every step is a join or a minimum with map-side
    combine; no component is gathered. Steps are written tables, and the number of rounds grows with the
    logarithm of the longest path.
    """
    scratch = Scratch(spark, "components")
    edges = scratch.store(
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
        "links",
    )
    mark = _fingerprint(edges)
    while mark[0]:
        both = edges.union(edges.select("lo", "hi")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        )
        small = large.groupBy("hi").agg(F.min("lo").alias("m"))
        turned = large.join(small, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        following = scratch.store(turned.union(small.select("hi", F.col("m").alias("lo"))).distinct(), "star")
        before, mark = mark, _fingerprint(following)
        scratch.drop(edges)
        edges = following
        if mark == before:
            break
    roots = edges.select(F.col("lo").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots)
