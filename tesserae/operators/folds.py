"""Ordered operations over one document's rows, and the order of jobs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import cut
from .batches import planned


def pack(elements: DataFrame, budget: int) -> DataFrame:
    """``elements(doc_id, ord, size)`` to ``(doc_id, ord, chunk)``: filled in order, no element split.

    An element larger than the budget is a chunk of its own.
    """
    rows = elements.select(F.col("doc_id").alias("key"), "ord", "size", F.lit(None).cast("int").alias("page"))
    return planned(rows, most_rows=1 << 30, most_chars=budget).select(F.col("key").alias("doc_id"), "ord", F.col("batch").alias("chunk"))


def legal_levels(entries: DataFrame) -> DataFrame:
    """Outline levels clamped so that each rises by one at most; the first is 1.

    Level i becomes the least of level j plus the steps from j to i, so that a
    running minimum says it without a loop.
    """
    w = Window.partitionBy("doc_id").orderBy("ord")
    at = F.row_number().over(w)
    level = F.greatest(F.col("level"), F.lit(1))
    legal = F.least(at, F.min("_low").over(w.rowsBetween(Window.unboundedPreceding, 0)) + at)
    return entries.withColumn("_low", level - at).select("doc_id", "ord", legal.cast("int").alias("legal"))


def tiers(points: DataFrame, tolerance: float) -> DataFrame:
    """Distinct positions to tiers: a new one begins beyond the last tier's start by more than the tolerance."""
    xs = points.groupBy("doc_id").agg(F.array_sort(F.collect_set("x")).alias("xs"))
    start = F.array().cast("array<double>")
    kept = F.aggregate("xs", start, lambda a, x: F.when((F.size(a) == 0) | (x - F.element_at(a, -1) > tolerance), F.concat(a, F.array(x))).otherwise(a))
    return xs.select("doc_id", F.explode(kept).alias("tier"))


def filled(loads: np.ndarray, size: int, n: int) -> np.ndarray:
    """Loads after ``n`` jobs of one size went, one by one, to the shard with the least load, the first at a tie."""
    low, high = int(loads.min()), int(loads.max()) + size * (n + 1)
    while low < high:  # the least load that n jobs can all start from or below
        at = (low + high) // 2
        if np.maximum(0, (at - loads) // size + 1).sum() >= n:
            high = at
        else:
            low = at + 1
    jobs = np.maximum(0, (low - 1 - loads) // size + 1)
    more = np.flatnonzero((low >= loads) & ((low - loads) % size == 0))[: n - int(jobs.sum())]
    jobs[more] += 1
    return loads + size * jobs


def shard_of(loads: np.ndarray, size: int, place: np.ndarray) -> np.ndarray:
    """The shard of the jobs at ``place`` (from 0) in a run of jobs of one size that finds the shards with ``loads``.

    A shard takes jobs when its load is at ``loads + i * size``; the j-th job
    goes where the j-th of all those loads is, the first shard at a tie.
    """
    low, high = np.full(len(place), loads.min()), np.full(len(place), loads.max()) + size * (place + 1)
    while (low < high).any():
        at = (low + high) // 2
        enough = np.maximum(0, (at[:, None] - loads) // size + 1).sum(axis=1) > place
        low, high = np.where(enough, low, at + 1), np.where(enough, at, high)
    before = np.maximum(0, (low[:, None] - 1 - loads) // size + 1).sum(axis=1)
    here = (low[:, None] >= loads) & ((low[:, None] - loads) % size == 0)
    return ((np.cumsum(here, axis=1) == (place - before + 1)[:, None]) & here).argmax(axis=1)


def assign_shards(jobs: DataFrame, shards: int) -> DataFrame:
    """``jobs(job, pages)`` to ``(job, pages, shard)``: the largest first, by job at a tie, each to the shard with the fewest pages, the first at a tie.

    Jobs without pages count as one page. A job's place among those of its size
    comes from a range sort, written down, and the counts of its ranges. The
    driver sees a row a size, not a job: how a run of equal jobs fills the
    shards is reckoned at once, and each job finds its shard from the loads
    that its run met.
    """
    size = F.greatest(F.coalesce("pages", F.lit(1)), F.lit(1)).cast("long")
    ordered = jobs.select("job", "pages", size.alias("_size")).repartitionByRange(F.col("_size").desc(), "job").sortWithinPartitions(F.col("_size").desc(), "job")
    rows = cut(ordered.withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "jobs")
    starts, total = [], 0
    for r in sorted(rows.groupBy("_p").count().collect()):
        starts.append((r["_p"], total))
        total += r["count"]
    loads, at, plan = np.zeros(shards, np.int64), 0, []
    for r in sorted(rows.groupBy("_size").count().collect(), reverse=True):
        plan.append((r["_size"], at, loads.tolist()))
        loads, at = filled(loads, r["_size"], r["count"]), at + r["count"]

    @F.arrow_udf("int")
    def shard(sizes: pa.Array, places: pa.Array, met: pa.Array) -> pa.Array:
        each, place = sizes.to_numpy(zero_copy_only=False), places.to_numpy(zero_copy_only=False)
        out = np.zeros(len(each), np.int32)
        for s in np.unique(each):
            mine = np.flatnonzero(each == s)
            out[mine] = shard_of(np.array(met[int(mine[0])].as_py(), np.int64), int(s), place[mine])
        return pa.array(out)

    spark = jobs.sparkSession
    rows = rows.join(F.broadcast(spark.createDataFrame(starts, "_p int, _start bigint")), "_p")  # one row a range of the sort
    rows = rows.join(spark.createDataFrame(plan, "_size bigint, _first bigint, _met array<bigint>"), "_size")
    return rows.select("job", "pages", shard("_size", F.col("_start") + F.col("_i") - F.col("_first"), "_met").alias("shard"))
