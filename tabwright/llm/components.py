"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, with_group_values


def _mins(edges: DataFrame) -> DataFrame:
    return with_group_values(edges, ["u"], ["v"], {"_low": F.min("v")}, {"m": F.min("_low")}, salts=16)


def _settled(edges: DataFrame) -> bool:
    """True when every edge leads to its star's centre: one parent a node, and no parent has a parent."""
    nodes = edges.select(F.col("u").alias("x"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("child"), F.lit(1).alias("parent")))
    nodes = nodes.groupBy("x").agg(F.sum("child").alias("ups"), F.max("parent").alias("parent"))
    return nodes.filter("ups > 1 OR (ups > 0 AND parent > 0)").isEmpty()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of ``edges`` (u, v: bigint); label is the component's smallest node.

    Each round moves edges only; the number of rounds grows with the logarithm of the
    longest path.  The star of a hot node is spread over salts in every join."""
    low, high = F.least("u", "v"), F.greatest("u", "v")
    edges = materialise(edges.filter("u <> v").select(high.alias("u"), low.alias("v")).distinct())
    for _ in range(most_rounds):
        if _settled(edges):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _mins(both).filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        large = materialise(large)
        small = _mins(large)
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))).distinct()
        edges = materialise(small)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.unionByName(stars.select(F.col("label").alias("node"), "label").distinct())
