"""Mixing sources to target weights by hash thresholds (operator 5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, cut, fresh, table, text_of

#: Bits of the 60-bit hash that each histogram resolves; 60 / BITS rounds find a threshold.
BITS, HASH_BITS = 12, 60


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def id_hash(doc_id: Column) -> Column:
    """A 60-bit hash of the id as text (null: empty); both engines have md5."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), total: float = 1.5, most: float = 2.0) -> DataFrame:
    """``sizes(source, source_size)`` with a ``target`` for each source.

    Sources by code point, null last, weigh ``weights`` in turn and share
    ``total`` times all sizes; no target exceeds ``most`` times its source, and
    the excess goes to the others by weight until none does. Ordered by how
    much of its limit a weight unit asks, sources fill up one after the other,
    so running sums give the level at which the rest share. One row a source.
    """
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*map(F.lit, weights))[F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))]
    rows = sizes.withColumn("w", w).withColumn("limit", most * F.col("source_size"))
    rows = rows.withColumn("all", total * F.sum("source_size").over(everything))
    rising = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("all") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("w").over(rising.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", level)
    rows = rows.withColumn("level", F.min(F.when(F.col("level") * F.col("w") <= F.col("limit"), F.struct(F.col("limit") / F.col("w"), "level"))).over(everything)["level"])
    share = F.col("level") * F.col("w")
    return rows.select("source", "source_size", F.when(share < F.col("limit"), share).otherwise(F.col("limit")).alias("target"))


def thresholds(narrow: DataFrame, budgets: DataFrame) -> DataFrame:
    """For ``budgets(source, budget)``, where the hash order of ``narrow(source, size, h)`` reaches it.

    Returns ``(source, low, rest, tie, tie_size)``: hashes below ``low`` fit the
    budget and leave ``rest`` of it; ``tie`` rows of ``tie_size`` together have
    the hash ``low`` itself. Each round sums sizes by source and bucket of the
    next bits, with partial sums before the shuffle, takes the bucket in which
    the budget ends, and looks only into that one in the next round. Nothing is
    sorted but one source's buckets.
    """
    state = budgets.select("source", F.col("budget").alias("rest"), F.lit(0).cast("long").alias("low"))
    shift = HASH_BITS
    while shift > 0:
        shift -= BITS
        width = 1 << shift
        inside = narrow.join(state, narrow["source"].eqNullSafe(state["source"])).select(state["source"], "rest", "low", "size", "h")
        inside = inside.where((F.col("h") >= F.col("low")) & (F.col("h") < F.col("low") + width * (1 << BITS)))
        bucket = F.shiftright(F.col("h") - F.col("low"), shift)
        sums = inside.groupBy("source", "low", "rest", bucket.alias("b")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        run = F.sum("size").over(Window.partitionBy("source").orderBy("b"))
        sums = sums.withColumn("run", run)
        # the first bucket that the budget doesn't cover
        first = F.min_by(F.struct("b", "run", "size", "n"), F.when(F.col("run") > F.col("rest"), F.col("b")))
        found = sums.groupBy("source", "low", "rest").agg(first.alias("x"))
        found = found.where("x is not null").select("source", (F.col("low") + F.col("x.b") * width).alias("low"), (F.col("rest") - F.col("x.run") + F.col("x.size")).alias("rest"), F.col("x.n").alias("tie"), F.col("x.size").alias("tie_size"))
        state = cut(found, "thresholds")
    return state


def mix(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), total: float = 1.5, most: float = 2.0) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken`` (words that the mix takes).

    Columns of these names that ``docs`` has are replaced. Every document goes
    in as often as its source's target holds it whole, and once more if its
    hash is below the source's threshold, the budgets of successive copies
    being nested. The document at the threshold goes in if that brings the
    source nearer to its target. Rows that share that hash (repeated ids) take
    equal parts of what is left, in words, so that copies of one row can't
    overshoot. Empty and null texts have size 0; a null source is a source; a
    source of size 0 takes nothing; an empty table gives no rows; other columns
    stay, whatever their names; reruns agree.
    """
    size, h = word_count(text_of()), id_hash(F.col("doc_id"))
    narrow = cut(docs.select("source", size.alias("size"), h.alias("h")), "mix")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = cut(targets(sizes, weights, total, most).withColumn("whole", F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))), "targets")
    ends = thresholds(narrow, goals.select("source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget")))
    plan = goals.join(ends, goals["source"].eqNullSafe(ends["source"]), "left").drop(ends["source"])
    named = {c: fresh(docs, f"mix_{c}") for c in (*plan.columns, "h")}
    plan = cut(plan.select(*[F.col(c).alias(named[c]) for c in plan.columns]), "mix-plan")
    rows = docs.withColumn("size", size).withColumn(named["h"], h).join(plan, F.col("source").eqNullSafe(F.col(named["source"])))
    c = {x: F.col(named[x]) for x in ("h", "low", "rest", "tie", "whole", "target", "source_size")} | {"size": F.col("size")}
    at_end = F.when(c["tie"] > 1, F.least(F.floor(c["rest"] / c["tie"]), c["size"])).when(2 * c["rest"] >= c["size"], c["size"]).otherwise(0)
    # without an end the source is covered whole before its budget ends
    whole = F.when(c["target"] > c["whole"] * c["source_size"], c["size"]).otherwise(0)
    extra = F.when(c["low"].isNull(), whole).when(c["h"] < c["low"], c["size"]).when(c["h"] == c["low"], at_end).otherwise(0)
    taken = F.least(c["whole"] * c["size"] + extra, (most * c["size"]).cast("long")).cast("long")
    out = rows.withColumn("source_size", c["source_size"]).withColumn("target", c["target"]).withColumn("taken", taken)
    return out.drop(*named.values())


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: what the mix takes of every document; null texts have size 0, repeated rows each get their row, rows of one hash share what is left at the threshold, an empty table gives no rows."""
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken")


#: The same by a full sort in hash order.
ORACLE = """
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS w
  FROM d GROUP BY source
), t AS (
  SELECT *, 2.0::DOUBLE * source_size AS lim, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM s
), v AS (
  SELECT *, (total - coalesce(sum(lim) OVER (ORDER BY lim / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY lim / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM t
), g AS (
  SELECT source, source_size, least(lim, w * (SELECT arg_min(level, lim / w) FROM v WHERE level * w <= lim)) AS target FROM v
), r AS (
  SELECT d.doc_id, d.size, g.source_size, g.target,
         CAST(floor(g.target / greatest(g.source_size, 1)) AS BIGINT) AS whole,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS run
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       CAST(least(2 * size, whole * size + CASE
         WHEN run <= target - whole * source_size THEN size
         WHEN run - size <= target - whole * source_size AND 2 * (target - whole * source_size - run + size) >= size THEN size
         ELSE 0 END) AS BIGINT) AS taken
FROM r
"""
