"""Relational shapes: latest rows, diffs, rollups, gates, spans, intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """The newest row of each key; a struct maximum needs no sort of the group."""
    rest = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*by)).alias("_best")
    return rows.groupBy(*keys).agg(best).select(*keys, "_best.*")


def full_diff(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of either side by key with ``state``: fixed, persisting or introduced."""
    a = before.select(*keys).distinct().withColumn("_b", F.lit(True))
    b = after.select(*keys).distinct().withColumn("_a", F.lit(True))
    state = F.when(F.col("_a").isNull(), "fixed").when(F.col("_b").isNull(), "introduced").otherwise("persisting")
    return a.join(b, keys, "full").select(*keys, state.alias("state"))


def gate(score: Column, good: float = 90, fair: float = 70) -> Column:
    return F.when(score >= good, "pass").when(score >= fair, "review").otherwise("fail")


def gate_rollup(docs: DataFrame, levels: list[str]) -> DataFrame:
    """Counts by gate, least score and mean of ``docs(gate, score, *levels)`` at each level of the hierarchy."""
    counts = [F.count_if(F.col("gate") == g).alias(f"n_{g}") for g in ("pass", "review", "fail")]
    out = docs.rollup(*levels).agg(F.count("*").alias("n_docs"), *counts, F.min("score").alias("least"), F.round(F.avg("score"), 6).alias("mean"), F.grouping_id().cast("int").alias("level"))
    verdict = F.when((F.col("least") > 90) & (F.col("mean") > 90), "pass").when(F.col("n_fail") > 0, "fail").when(F.col("n_review") > 0, "review").otherwise("mixed")
    return out.withColumn("verdict", verdict)


def islands(rows: DataFrame, keys: list[str], position: str, gap: int) -> DataFrame:
    """Merge positions at most ``gap`` apart into spans ``(first, last, n)``."""
    w = Window.partitionBy(*keys).orderBy(position)
    new = F.when(F.col(position) - F.lag(position).over(w) <= gap, 0).otherwise(1)
    marked = rows.withColumn("_new", new).withColumn("_span", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_span").agg(F.min(position).alias("first"), F.max(position).alias("last"), F.count("*").alias("n")).drop("_span")


def carry_forward(rows: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """The last known ``value`` at each row."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out, F.last(value, ignorenulls=True).over(w))


def as_of(left: DataFrame, right: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """``left`` with the ``value`` of the last row of ``right`` at or before ``at``.

    Both sides go through one shuffle and one ordered pass: no row pairs are made.
    """
    cols = [c for c in left.columns if c not in keys]
    l = left.select(*keys, F.struct(*cols).alias("_l"), F.col(at).alias("_at"), F.lit(None).cast(right.schema[value].dataType).alias("_v"), F.lit(1).alias("_side"))  # noqa: E741
    r = right.select(*keys, F.lit(None).cast(l.schema["_l"].dataType).alias("_l"), F.col(at).alias("_at"), F.col(value).alias("_v"), F.lit(0).alias("_side"))
    w = Window.partitionBy(*keys).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = l.unionByName(r).withColumn("_v", F.last("_v", ignorenulls=True).over(w))
    return both.where("_side = 1").select(*keys, "_l.*", F.col("_v").alias(value))


def attach_ranges(points: DataFrame, ranges: DataFrame, keys: list[str], point: str, low: str, high: str) -> DataFrame:
    """Points with the ranges that cover them: ranges expand to their members, then an equi-join.

    Without keys all rows meet at few places, so the join is dealt in slices.
    """
    members = ranges.withColumn(point, F.explode(F.sequence(low, high)))
    return points.join(members, [*keys, point]) if keys else join_sliced(points, members, point)


#: Rows of either side in a slice, pairs that one task makes, and the most partitions that they are dealt to.
SLICE, TASK_PAIRS, MOST_PARTS = 1_000, 2_000_000, 10_000


def join_sliced(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left`` and ``right`` joined by ``key``, a key of very many pairs shared out among tasks.

    Of each key both sides go into slices by hash, and each pair of slices is a
    group of its own; rows are copied once for each slice of the other side,
    which is two copies for ``SLICE`` pairs at most. Few pairs make one join.
    """
    met = left.groupBy(key).agg(F.count("*").alias("_l")).join(right.groupBy(key).agg(F.count("*").alias("_r")), key)
    n_pairs = met.agg(F.sum(F.col("_l").cast("double") * F.col("_r"))).first()[0] or 0
    if n_pairs <= TASK_PAIRS:
        return left.join(right, key)
    n_parts = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MOST_PARTS, int(n_pairs // TASK_PAIRS) + 1))
    met = met.select(key, F.ceil(F.col("_l") / SLICE).alias("_l"), F.ceil(F.col("_r") / SLICE).alias("_r"))
    own = lambda side, n: F.pmod(F.xxhash64(*side.columns), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    a = left.join(met, key).select(*left.columns, own(left, "_l").alias("_i"), each("_r").alias("_j"))
    b = right.join(met, key).select(*right.columns, each("_l").alias("_i"), own(right, "_r").alias("_j"))
    on = [key, "_i", "_j"]
    return a.repartition(n_parts, *on).hint("shuffle_hash").join(b.repartition(n_parts, *on), on).drop("_i", "_j")


def kth_pairs(a: DataFrame, b: DataFrame, keys: list[str], order_a: list[str], order_b: list[str]) -> DataFrame:
    """Pair duplicates one for one: the k-th of a key here with the k-th of it there; what is left over stays alone."""
    x = a.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_a)))
    y = b.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_b)))
    return x.join(y, [*keys, "nth"], "full")
