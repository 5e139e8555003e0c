"""Does a processed document still say what its source said?

All checks compare two token tables ``(doc_id, pos, token)`` or line tables
``(doc_id, pos, line)`` by grouped joins; none collects a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import islands


def multiset_difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, n_a, n_b, missing, extra)`` of two multisets."""
    x = a.groupBy(*keys).agg(F.count("*").alias("n_a"))
    y = b.groupBy(*keys).agg(F.count("*").alias("n_b"))
    both = x.join(y, keys, "full").na.fill(0, ["n_a", "n_b"])
    return both.withColumn("missing", F.greatest(F.col("n_a") - F.col("n_b"), F.lit(0))).withColumn("extra", F.greatest(F.col("n_b") - F.col("n_a"), F.lit(0)))


def word_coverage(source: DataFrame, output: DataFrame, least: float = 97.0) -> DataFrame:
    """Share of a document's words that its output has, counted as multisets."""
    return coverage_of(multiset_difference(source, output, ["doc_id", "token"]), least)


def marked_difference(rows: DataFrame, kept: Column, keys: list[str]) -> DataFrame:
    """``multiset_difference`` of rows and of those of them that are ``kept``: one pass, one grouping."""
    both = rows.groupBy(*keys).agg(F.count("*").alias("n_a"), F.count_if(kept).alias("n_b"))
    return both.withColumn("missing", F.col("n_a") - F.col("n_b")).withColumn("extra", F.lit(0).cast("bigint"))


def coverage_of(diff: DataFrame, least: float = 97.0) -> DataFrame:
    """Coverage of each document from a multiset difference by document and word."""
    sums = diff.groupBy("doc_id").agg(F.sum("n_a").alias("n_source"), F.sum("missing").alias("n_missing"), F.sum("extra").alias("n_extra"))
    cover = F.round(100.0 * (F.col("n_source") - F.col("n_missing")) / F.greatest("n_source", F.lit(1)), 6)
    return sums.withColumn("coverage", cover).withColumn("ok", F.col("coverage") >= least)


def unpaid_positions(source: DataFrame, output: DataFrame) -> DataFrame:
    """Source positions whose k-th use of a word the output's supply can't pay for."""
    nth = F.row_number().over(Window.partitionBy("doc_id", "token").orderBy("pos"))
    supply = output.groupBy("doc_id", "token").agg(F.count("*").alias("supply"))
    used = source.withColumn("nth", nth).join(supply, ["doc_id", "token"], "left")
    return used.where(F.col("nth") > F.coalesce("supply", F.lit(0))).select("doc_id", "pos", "token")


def lost_spans(source: DataFrame, output: DataFrame, gap: int = 3, least: int = 5) -> DataFrame:
    """Unpaid positions merged into spans; short ones are noise."""
    return islands(unpaid_positions(source, output), ["doc_id"], "pos", gap).where(F.col("n") >= least)


def rare_word_presence(source: DataFrame, output: DataFrame, page: str = "page", keep: int = 8, share: float = 0.5) -> DataFrame:
    """Is a page there? Half of its rarest words must be in the document's output.

    Rarity is document frequency over pages, ties by longer word, then by word.
    """
    words = source.select("doc_id", page, "token").distinct()
    df = words.groupBy("token").agg(F.count("*").alias("df"))
    order = [F.col("df"), F.length("token").desc(), F.col("token")]
    rare = words.join(df, "token").withColumn("r", F.row_number().over(Window.partitionBy("doc_id", page).orderBy(*order))).where(F.col("r") <= keep)
    there = output.select("doc_id", "token").distinct().withColumn("there", F.lit(1))
    found = rare.join(there, ["doc_id", "token"], "left").groupBy("doc_id", page).agg(F.count("*").alias("n_words"), F.count("there").alias("n_found"))
    return found.withColumn("present", F.col("n_found") >= share * F.col("n_words"))


#: Words whose counts every task holds.
COMMON = 100_000


def rare_words_kept(words: DataFrame, df: DataFrame, page: str = "page", keep: int = 8, share: float = 0.5, common: int = COMMON) -> DataFrame:
    """``rare_word_presence`` of ``words(doc_id, page, token, there)``, each word of a page once, and ``df(token, df)``.

    Every task holds the counts of the commonest words, so these stay where
    they lie and only a page's rarest of them go on. Words beyond, of which
    there are few, go to their counts.
    """
    order = Window.partitionBy("doc_id", page).orderBy(F.col("df"), F.length("token").desc(), F.col("token"))
    rarest = lambda rows: rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= keep).drop("r")
    columns = ["doc_id", page, "token", "there", "df"]
    more = df.count() > common
    rows = words.join(F.broadcast(df.orderBy(F.col("df").desc(), "token").limit(common) if more else df), "token", "left")
    rare = rarest(rows.where("df is not null").select(*columns))
    if more:
        rare = rarest(rare.unionByName(rows.where("df is null").drop("df").join(df, "token").select(*columns)))
    found = rare.groupBy("doc_id", page).agg(F.count("*").alias("n_words"), F.count_if("there").alias("n_found"))
    return found.withColumn("present", F.col("n_found") >= share * F.col("n_words"))


def window_containment(needles: DataFrame, hay: DataFrame, *keys: str) -> DataFrame:
    """Share of distinct windows ``(keys, w)`` that occur anywhere in ``hay(w)``.

    Windows join as hashes. Those of the needles meet the hay first, so that
    only windows which some needle has are made distinct.
    """
    mine = needles.select(*keys, F.xxhash64("w").alias("h")).distinct()
    there = hay.select(F.xxhash64("w").alias("h")).join(mine.select("h").distinct(), "h", "left_semi").distinct().withColumn("there", F.lit(1))
    joined = mine.join(there, "h", "left").groupBy(*keys).agg(F.count("*").alias("n_windows"), F.count("there").alias("n_found"))
    return joined.withColumn("containment", F.round(F.col("n_found") / F.col("n_windows"), 6))


def clamp(score: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.least(F.greatest(score, F.lit(low)), F.lit(high))


def row_split_severity(confirmed: Column, confidence: Column) -> Column:
    """A confirmed split counts whole; an unconfirmed one half, scaled by how sure it is (half again if unknown)."""
    scaled = 0.5 * F.coalesce(clamp(confidence / 100, 0.2, 1.0), F.lit(0.5))
    return F.when(confirmed, 1.0).otherwise(scaled)


def worst_gate(scores: list[Column], pages: Column) -> Column:
    """The weakest critical dimension decides; short documents by completeness (the first) alone."""
    worst = F.when(pages < 10, scores[0]).otherwise(F.least(*scores))
    return F.when(worst >= 90, "pass").when(worst >= 70, "review").otherwise("fail")
