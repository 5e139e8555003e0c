"""Rows of a table found on the pages that print them, and packed into batches under two budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import cut_together
from .chains import longest_chain

#: Words of a probe, and where in a row probes begin, in thirds of its words.
PROBE, OFFSETS = 6, (0, 1, 2)
#: Rows and characters of a batch at most. Fixed values.
MOST_ROWS, MOST_CHARS = 6, 9_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([0-9a-z]+)"), 1)


def probe_index(pages: DataFrame) -> DataFrame:
    """``(key, page, h)``: every run of ``PROBE`` words of each of ``pages(key, page, said)``, by hash."""
    words = pages.select("key", "page", F.posexplode(words_of(F.col("said"))).alias("k", "w"))
    order = Window.partitionBy("key", "page").orderBy("k")
    runs = words.select("key", "page", F.xxhash64("w", *[F.lead("w", j).over(order) for j in range(1, PROBE)]).alias("h"), F.lead("w", PROBE - 1).over(order).isNotNull().alias("whole"))
    return runs.where("whole").select("key", "page", "h").distinct()


def probes(rows: DataFrame) -> DataFrame:
    """``(key, ord, nth, h)``: the runs of a row's words at its start, a third and two thirds of it."""
    found = rows.select("key", "ord", words_of(F.col("said")).alias("w"))
    starts = F.array_distinct(F.array(*[F.floor(F.size("w") * n / 3).cast("int") for n in OFFSETS]))
    found = found.select("key", "ord", "w", F.posexplode(starts).alias("nth", "at")).where(F.col("at") + PROBE <= F.size("w"))
    return found.select("key", "ord", "nth", F.xxhash64(*[F.get("w", F.col("at") + j) for j in range(PROBE)]).alias("h"))


def located(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """``(key, ord, nth, page)``: the pages that hold a probe of ``rows(key, ord, said)``, met by hash and written down.

    Where both are dealt by key the runs of a page meet their probes as they come, and aren't shuffled.
    """
    return cut_together(probes(rows).join(probe_index(pages), ["key", "h"]).select("key", "ord", "nth", "page").distinct(), "located")


def attributed(rows: DataFrame, pages: DataFrame, in_order: bool = False, met: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``page``: the first page that holds the row's earliest known probe, else that of the row before, else the first page.

    With ``in_order`` pages never fall from one row to the next: of all pages
    that hold a probe of a row, those are taken that locate most rows that way.
    ``met`` is what ``located`` finds, if that is known.
    """
    met = located(rows, pages) if met is None else met
    if in_order:
        # a page may hold many rows: places rise within it by the row
        most = met.agg(F.max("ord")).first()[0] or 0
        chain = longest_chain(met.select("key", F.col("ord").alias("a"), (F.col("page").cast("long") * (most + 1) + F.col("ord")).alias("b")).distinct(), ["key"])
        found = chain.select("key", F.col("a").alias("ord"), F.floor((F.col("b") - F.col("a")) / (most + 1)).cast("long").alias("found"))
    else:
        found = met.groupBy("key", "ord").agg(F.min(F.struct("nth", "page")).alias("x")).select("key", "ord", F.col("x.page").cast("long").alias("found"))
    first = pages.groupBy("key").agg(F.min("page").cast("long").alias("first"))
    before = Window.partitionBy("key").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(found, ["key", "ord"], "left").join(first, "key", "left")
    return out.withColumn("page", F.coalesce(F.last("found", ignorenulls=True).over(before), F.col("first"))).drop("found", "first")


def planned(rows: DataFrame, most_rows: int = MOST_ROWS, most_chars: int = MOST_CHARS, by_page: bool = False) -> DataFrame:
    """``rows(key, ord, size, page)`` to ``(key, ord, batch)``: consecutive rows, filled in order under both budgets.

    A row beyond the size budget is a batch of its own; with ``by_page`` a
    batch never holds two pages. Sizes and pages alone meet in the fold.
    """
    lists = rows.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("ord", "size", "page"))).alias("r"))
    start = F.struct(F.lit(-1).alias("batch"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("chars"), F.lit(None).cast(rows.schema["page"].dataType).alias("page"), F.array().cast("array<int>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        turns = ~s["page"].eqNullSafe(x["page"]) if by_page else F.lit(False)
        new = (s["n"] == 0) | (s["n"] >= most_rows) | (s["chars"] + x["size"] > most_chars) | turns
        batch = s["batch"] + F.when(new, 1).otherwise(0)
        return F.struct(batch.alias("batch"), F.when(new, 1).otherwise(s["n"] + 1).alias("n"), F.when(new, x["size"].cast("long")).otherwise(s["chars"] + x["size"]).alias("chars"), F.when(new, x["page"]).otherwise(s["page"]).alias("page"), F.concat(s["out"], F.array(batch)).alias("out"))

    dealt = F.aggregate("r", start, step, lambda s: s["out"])
    return lists.select("key", F.explode(F.arrays_zip("r", dealt.alias("b"))).alias("z")).select("key", "z.r.ord", F.col("z.b").alias("batch"))
