"""Losses rolled up to the branches of an outline, and the node that a page belongs to, by interval labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Levels of an outline.
LEVELS = 12
#: Sections named for each branch. Fixed value.
NAMED = 3


def spans(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``nodes(key, ord, level, ...)`` in order with ``stop``, the first node behind its branch (null at the end), and ``above``, its ancestors from the top.

    For each level a window knows the next node of it and the last one: a
    branch stops at the nearest node of its own level or an outer one, and the
    last node of an outer level is an ancestor if it is behind those of all
    levels still further out.
    """
    order = Window.partitionBy("key").orderBy("ord")
    after, before = order.rowsBetween(1, Window.unboundedFollowing), order.rowsBetween(Window.unboundedPreceding, -1)
    level = F.least(F.greatest(F.col("level"), F.lit(1)), F.lit(levels))
    rows = nodes.withColumn("level", level)
    at = [F.when(F.col("level") == n, F.col("ord")) for n in range(1, levels + 1)]
    rows = rows.withColumn("next", F.array(*[F.first(x, ignorenulls=True).over(after) for x in at])).withColumn("last", F.array(*[F.last(x, ignorenulls=True).over(before) for x in at]))
    outer = F.slice("last", 1, F.col("level") - 1)
    open_ = F.filter(F.transform(outer, lambda x, k: F.when(x > F.coalesce(F.array_max(F.slice(outer, 1, k)), x - 1), x)), lambda x: x.isNotNull())
    return rows.withColumn("stop", F.array_min(F.slice("next", 1, F.col("level")))).withColumn("above", open_).drop("next", "last")


def roll_up(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``nodes(key, ord, level, title, status, absorbed_by)`` with what happened below each: ``children``, ``defective``, ``absorbers``, ``absorbed``.

    defective counts the nodes of a branch that aren't ``built``; absorbers are
    the first sections, by number, that took the content of hollow ones among
    them; absorbed are the titles of all that a node itself took. Counts are
    differences of running sums at the two ends of a branch.
    """
    rows = spans(nodes, levels)
    order = Window.partitionBy("key").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    bad = (F.col("status") != "built").cast("long")
    rows = rows.withColumn("n", F.count("*").over(order)).withColumn("bad", F.sum(bad).over(order))
    ends = rows.select("key", F.col("ord").alias("stop"), (F.col("n") - 1).alias("n_end"), (F.col("bad") - bad).alias("bad_end"))
    whole = rows.groupBy("key").agg(F.max("n").alias("n_all"), F.max("bad").alias("bad_all"))
    out = rows.join(ends, ["key", "stop"], "left").join(whole, "key")
    out = out.withColumn("children", F.coalesce("n_end", "n_all") - F.col("n")).withColumn("defective", F.coalesce("bad_end", "bad_all") - F.col("bad"))
    lost = rows.where("status = 'hollow' and absorbed_by is not null")
    below = lost.select("key", F.explode("above").alias("ord"), "absorbed_by").groupBy("key", "ord").agg(F.slice(F.array_sort(F.collect_set("absorbed_by")), 1, NAMED).alias("absorbers"))
    took = lost.select("key", F.col("absorbed_by").alias("took"), F.struct("ord", "title").alias("t")).groupBy("key", "took").agg(F.transform(F.array_sort(F.collect_list("t")), lambda t: t["title"]).alias("absorbed")).withColumnRenamed("took", "ord")
    out = out.join(below, ["key", "ord"], "left").join(took, ["key", "ord"], "left")
    none = F.array()
    return out.select("key", "ord", "level", "title", "status", "children", "defective", F.coalesce("absorbers", none.cast(out.schema["absorbers"].dataType)).alias("absorbers"), F.coalesce("absorbed", none.cast("array<string>")).alias("absorbed"))


def page_ranges(nodes: DataFrame, pages: DataFrame) -> DataFrame:
    """``nodes(key, ord, level, page)`` and ``pages(key, n_pages)`` to ``(key, ord, level, page, end, own_end)``.

    A node ends before the page of the next one, whatever its level, but not
    before its own; its own content ends before the page of its first child.
    Pages before the first node are a node of their own, with ord -1.
    """
    order = Window.partitionBy("key").orderBy("ord")
    rows = nodes.join(pages, "key").withColumn("next_page", F.lead("page").over(order)).withColumn("next_level", F.lead("level").over(order)).withColumn("first", F.first("page").over(order))
    end = F.greatest(F.coalesce(F.col("next_page") - 1, F.col("n_pages")), F.col("page"))
    own = F.when(F.col("next_level") > F.col("level"), F.greatest(F.col("next_page") - 1, F.col("page"))).otherwise(end)
    out = rows.select("key", "ord", "level", "page", end.alias("end"), own.alias("own_end"))
    front = rows.where("first > 1").groupBy("key").agg(F.lit(-1).alias("ord"), F.min_by("level", "ord").alias("level"), F.lit(1).alias("page"), (F.min("first") - 1).alias("end")).withColumn("own_end", F.col("end"))
    return out.unionByName(front.select(*[F.col(c).cast(out.schema[c].dataType).alias(c) for c in out.columns]))


def page_owners(ranges: DataFrame, pages: DataFrame) -> DataFrame:
    """``(key, page, ord)``: the most specific node of each page, the last one at a tie; the last outermost node where none has it."""
    own = ranges.select("key", "ord", "level", F.explode(F.sequence("page", F.greatest("own_end", "page"))).alias("page"))
    best = own.groupBy("key", "page").agg(F.max_by("ord", F.struct("level", "ord")).alias("ord"))
    every = pages.where("n_pages > 0").select("key", F.explode(F.sequence(F.lit(1), F.col("n_pages").cast("int"))).alias("page"))
    top = ranges.where("ord >= 0").groupBy("key").agg(F.max_by("ord", F.struct(-F.col("level"), "ord")).alias("last"))
    return every.join(best, ["key", "page"], "left").join(top, "key").select("key", "page", F.coalesce("ord", "last").alias("ord"))
