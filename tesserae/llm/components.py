"""Connected components of a link table, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FEW, cut, join_hot


def connected_components(links: DataFrame, max_rounds: int = 60, few: int = FEW) -> DataFrame:
    """``links(u, v)`` of long ids to ``(node, root)``, root the smallest id reached.

    Alternates two star steps: every node hands its larger neighbours to its
    smallest one, then its smaller ones. Each round is two grouped passes over
    the links with partial minima, and two joins that broadcast what is few or
    part nodes of very many links from the others, so that no node's neighbours
    meet in one task; a written table ends each round's lineage. Rounds grow with the logarithm of
    a component's diameter and end when two 64-bit sums over the links stay the
    same. Nodes without a link aren't returned; no links give no rows.
    """
    links = cut(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    seen = (links.count(),)
    for _ in range(max_rounds):
        most = 2 * seen[0]  # nodes of the links
        keep = (lambda df, tag: df) if most <= few else cut
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = keep(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = join_hot(links.select(F.col("v").alias("u"), F.col("u").alias("v")), least, "u", few=few, most=most).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = keep(large.where("u <> v"), "large")  # at most the links before; one distinct a round will do
        low = keep(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = join_hot(large, low, "u", few=few, most=most).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        links = cut(small.where("u <> v").distinct(), "links")
        state = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.bit_xor(F.xxhash64("v", "u"))).first())
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
