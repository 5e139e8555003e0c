"""Section trees and property graphs as edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import cut


def paths(nodes: DataFrame, key: str, parent: str, item: str) -> DataFrame:
    """``(key, path)``: items from the top down to each node, by joins up the parent chain.

    Rounds double the stretch of path that a row holds, so that they follow the
    logarithm of the tree's depth; a parent that isn't there ends a path, and a
    cycle raises.
    """
    rows = nodes.select(F.col(key).alias("_k"), F.col(parent).alias("_p"), F.array(F.col(item)).alias("_path"))
    known = rows.select(F.col("_k").alias("_p")).distinct()
    rows = rows.join(known.withColumn("_there", F.lit(True)), "_p", "left").select("_k", F.when(F.col("_there"), F.col("_p")).alias("_p"), "_path")
    return _doubled(rows, lambda own, up: F.concat(up, own)).select(F.col("_k").alias(key), F.col("_path").alias("path"))


def levels_to_root(nodes: DataFrame, key: str, parent: str, label: str) -> DataFrame:
    """Breadcrumb and depth of each node."""
    return paths(nodes, key, parent, label).select(key, F.array_join("path", " > ").alias("breadcrumb"), F.size("path").alias("depth"))


def chain_roots(nodes: DataFrame) -> DataFrame:
    """``nodes(id, parent)`` to ``(id, root, depth)``; a parent that isn't there ends a chain, and a cycle raises."""
    known = nodes.select(F.col("id").alias("parent")).distinct().withColumn("_there", F.lit(True))
    rows = nodes.join(known, "parent", "left").select(F.col("id").alias("_k"), F.when(F.col("_there"), F.col("parent")).alias("_p"))
    rows = rows.withColumn("_path", F.struct(F.coalesce("_p", "_k").alias("at"), F.col("_p").isNotNull().cast("int").alias("n")))
    rows = _doubled(rows, lambda own, up: F.struct(up["at"].alias("at"), (own["n"] + up["n"]).alias("n")))
    return rows.select(F.col("_k").alias("id"), F.col("_path.at").alias("root"), F.col("_path.n").alias("depth"))


def _doubled(rows: DataFrame, joined) -> DataFrame:
    """``rows(_k, _p, _path)``: each row's path joined with its parent's until no row has a parent, by pointer doubling."""
    rows = cut(rows, "paths")
    for _ in range(rows.count().bit_length() + 1):
        if rows.where("_p is not null").isEmpty():
            return rows
        up = rows.select(F.col("_k").alias("_p"), F.col("_p").alias("_pp"), F.col("_path").alias("_up"))
        path = F.when(F.col("_up").isNotNull(), joined(F.col("_path"), F.col("_up"))).otherwise(F.col("_path"))
        rows = cut(rows.join(up, "_p", "left").select("_k", F.col("_pp").alias("_p"), path.alias("_path")), "paths")
    raise ValueError("parents form a cycle")


def parents_by_level(sections: DataFrame, doc: str, most: int) -> DataFrame:
    """Parent of each section: the last one before it of a lower level.

    A running last of each level, one window over the document, gives the
    candidates; the latest one of a lower level is the parent.
    """
    w = Window.partitionBy(doc).orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    for k in range(1, most):
        sections = sections.withColumn(f"_last{k}", F.last(F.when(F.col("level") == k, F.col("ord")), ignorenulls=True).over(w))
    up = F.greatest(F.lit(-1), *[F.when(F.col("level") > k, F.col(f"_last{k}")) for k in range(1, most)])
    out = sections.withColumn("parent", F.when(up >= 0, up))
    return out.drop(*[f"_last{k}" for k in range(1, most)])


def subtree_ends(sections: DataFrame, doc: str, most: int) -> DataFrame:
    """Place of the last descendant: just before the next section of the same or a lower level."""
    w = Window.partitionBy(doc).orderBy("ord").rowsBetween(1, Window.unboundedFollowing)
    nexts = [F.first(F.when(F.col("level") <= k, F.col("ord")), ignorenulls=True).over(w) for k in range(1, most + 1)]
    for k, n in enumerate(nexts, 1):
        sections = sections.withColumn(f"_next{k}", n)
    last = F.max("ord").over(Window.partitionBy(doc))
    mine = F.coalesce(*[F.when(F.col("level") == k, F.col(f"_next{k}") - 1) for k in range(1, most + 1)], last)
    return sections.withColumn("until", mine).drop(*[f"_next{k}" for k in range(1, most + 1)])


def neighbourhood(edges: DataFrame, start: DataFrame, radius: int) -> DataFrame:
    """Nodes within ``radius`` undirected steps of the start nodes, with their distance."""
    both = edges.select("src", "dst").union(edges.select(F.col("dst"), F.col("src"))).distinct()
    found = start.select("node").distinct().withColumn("hops", F.lit(0))
    for k in range(1, radius + 1):
        front = found.where(F.col("hops") == k - 1)
        step = front.join(both, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
        found = found.unionByName(step.join(found, "node", "left_anti").withColumn("hops", F.lit(k)))
    return found
