"""Printed tables of contents: pages that are one, rows that wrap, and entries that a numbering convention folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A row that ends with leaders and a page, a label that stands alone, one in front of a title, and the heading of the listing itself.
ENTRY = r"^(.*?)\s*[.…·]{4,}\s*([0-9]{1,4})$"
#: A number of three digits or more is a label where a mark says so; without one it may be a year or a page.
ALONE = r"^\(?([A-Z]|[0-9]+(?:\.[0-9]+)+|[0-9]{1,2}|[0-9]{3,}(?=[.)]))[.)]?$"
IN_FRONT = r"^((?:[A-Z]|[0-9]+(?:\.[0-9]+){0,3})\.|[0-9]+(?:\.[0-9]+){1,3}|[0-9]{1,2})\s+(?=\S)"
OWN_HEADING = r"(?i)^(?:table of )?contents$"
#: Lines of title above the last one, rows of a page that is a listing, of one next to such a page, the share of numbered entries that makes a convention. Fixed values.
MOST_LINES, LISTING, EDGE, CONVENTION = 3, 6, 3, 0.8


def listings(lines: DataFrame, listing: int = LISTING, edge: int = EDGE) -> DataFrame:
    """``(key, page, n)`` of ``lines(key, page, ord, line)``: pages with many rows that end with a page, and weaker ones next to them."""
    rows = lines.groupBy("key", "page").agg(F.count_if(F.trim("line").rlike(ENTRY)).alias("n"))
    order = Window.partitionBy("key").orderBy("page")
    near = lambda step: (step("n", 1).over(order) >= listing) & (F.abs(step("page", 1).over(order) - F.col("page")) == 1)
    weak = (F.col("n") >= edge) & (F.coalesce(near(F.lag), F.lit(False)) | F.coalesce(near(F.lead), F.lit(False)))
    return rows.withColumn("is_one", (F.col("n") >= listing) | weak).where("is_one").drop("is_one")


def label_depth(label: Column) -> Column:
    return F.when(label.rlike("^[A-Z]$"), 1).when(label != "", F.size(F.split(label, r"\.")))


def entries(lines: DataFrame, most_lines: int | None = MOST_LINES) -> DataFrame:
    """``(key, nth, label, title, page_to, depth)`` of the listing's ``lines(key, page, ord, line)``.

    A row that ends with leaders and a page ends an entry; the lines since the
    one before it are its own: a label alone on a line, then as many as
    ``most_lines`` lines of title (None: all). A row with a label in front of
    its title is an entry by itself, unless a title that has its label alone
    goes on in it. Where letters number parts, numbers are one deeper; an
    entry without a label is as deep as the one above it. Rows without any
    title aren't entries.
    """
    said = F.trim(F.regexp_replace("line", r"[ \t]+$", ""))
    order = Window.partitionBy("key").orderBy("page", "ord")
    rows = lines.withColumn("line", said).where("line <> ''").withColumn("ends", F.col("line").rlike(ENTRY))
    rows = rows.withColumn("entry", F.count_if("ends").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    own = Window.partitionBy("key", "entry").orderBy(F.col("page").desc(), F.col("ord").desc())
    rows = rows.withColumn("back", F.row_number().over(own) - 1)
    title = F.trim(F.regexp_extract("line", ENTRY, 1))
    # what belongs to the entry stops, seen from its end, at a label alone or the listing's heading; a row with a label stands by itself
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    alone = ~F.col("ends") & F.col("line").rlike(ALONE)
    stops = alone | ~F.col("ends") & F.col("line").rlike(OWN_HEADING)
    within = F.lit(True) if most_lines is None else F.col("back") <= most_lines
    # the stop next to the end: a label with lines of title below it has begun what the last row ends
    nearest = F.min(F.when(stops, F.struct("back", alone.alias("alone")))).over(Window.partitionBy("key", "entry"))
    far = F.lit(True) if most_lines is None else nearest["back"] <= most_lines + 1
    begun = F.coalesce(nearest["alone"] & (nearest["back"] >= 2) & far, F.lit(False))
    whole = F.col("ends") & title.rlike(IN_FRONT) & ~begun
    rows = rows.withColumn("title", title).withColumn("stops", stops).withColumn("whole", whole)
    rows = rows.withColumn("over", F.coalesce(F.max(F.col("stops") | F.col("whole")).over(before), F.lit(False)))
    part = F.when(F.col("ends"), F.col("title")).when(~F.col("stops") & within, F.col("line"))
    label = F.when(~F.col("ends") & ~F.col("over") & F.col("line").rlike(ALONE), F.regexp_extract("line", ALONE, 1))
    found = rows.groupBy("key", "entry").agg(
        F.array_sort(F.collect_list(F.when(~F.col("over") & part.isNotNull(), F.struct("page", "ord", part.alias("t"))))).alias("parts"), F.max(label).alias("label"),
        F.max(F.when(F.col("ends"), F.regexp_extract("line", ENTRY, 2).cast("int"))).alias("page_to"), F.max(F.when(F.col("whole"), F.regexp_extract("title", IN_FRONT, 1))).alias("front"),
    ).where("page_to is not null")
    text = F.trim(F.array_join(F.filter(F.transform("parts", lambda x: x["t"]), lambda t: t != ""), " "))
    found = found.withColumn("title", F.when(F.col("front").isNull() & F.col("label").isNotNull(), text).otherwise(F.trim(F.regexp_replace(text, IN_FRONT, "")))).withColumn("label", F.coalesce("label", F.regexp_replace("front", r"\.$", "")))
    found = found.where(F.col("title").rlike(r"[\p{L}\p{N}]"))
    by = Window.partitionBy("key").orderBy("entry")
    letters = F.max(F.coalesce(F.col("label").rlike("^[A-Z]$"), F.lit(False))).over(Window.partitionBy("key"))
    depth = F.when(F.col("label").isNotNull(), label_depth(F.col("label")) + F.when(letters & ~F.col("label").rlike("^[A-Z]$"), 1).otherwise(0))
    depth = F.coalesce(F.last(depth, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0)), F.lit(1))
    return found.select("key", F.row_number().over(by).alias("nth"), "label", "title", "page_to", depth.alias("depth"))


def folded(found: DataFrame, max_depth: int, convention: float = CONVENTION) -> DataFrame:
    """``found(key, label, ...)`` with ``why`` an entry is no section of its own, null where it is.

    ``deeper`` says that its own number is deeper than ``max_depth``, ``fragment``
    that it has none in a document which numbers nearly all of them.
    """
    level = F.when(F.col("label").rlike("^[0-9]"), F.size(F.split("label", r"\.")))
    share = F.avg(F.when(level.isNotNull(), 1.0).otherwise(0.0)).over(Window.partitionBy("key"))
    return found.withColumn("why", F.when(level > max_depth, "deeper").when(level.isNull() & (share >= convention), "fragment"))
