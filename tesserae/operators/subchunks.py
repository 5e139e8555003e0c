"""Sections cut at the sub-headings that extend their own number, the pieces adding up to the text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A section's own heading with its number, and the number of a sub-heading.
OWN = r"(?im)^#\s+(?:Appendix\s+)?(\d+)\.?\s"
SUB = r"^#{2,4}[ \t]+(\d+(?:\.\d+)+)[ \t]*(.*)"
#: Words that name back matter as a page prints them, with the letter of their numbers. Fixed values.
LABELS = (("A", ("appendices", "appendix")), ("N", ("annexures", "annexure", "annexes", "annexe", "annex")), ("S", ("schedules", "schedule")), ("E", ("exhibits", "exhibit")))
#: Marks of back matter in a section's name, and the lines at its top that may hold a printed label. Fixed values.
MARKS, TOP_LINES = ("disclaimer", "finsa"), 12

_WORDS = "|".join(w for _, words in LABELS for w in words)
HEAD_LABEL = rf"(?i)^#\s+(?:\*\*)?\s*({_WORDS})\s+(\d{{1,3}})\b"
LINE_LABEL = rf"(?i)^\s*(?:\*\*|__)?\s*({_WORDS})\s+(\d{{1,3}})\s*[:.\-–—]?\s*(?:\*\*|__)?\s*$"


def own_number(text: Column) -> Column:
    """The number in a section's own heading, null without one."""
    return F.nullif(F.regexp_extract(text, OWN, 1), F.lit(""))


def pieces(text: Column) -> Column:
    """The text cut right before each sub-heading that extends its own number, or before each numbered one if it has none.

    Cuts have no width: the pieces put together are the text.
    """
    own = F.coalesce(own_number(text), F.lit(r"\d+"))
    return F.split(text, F.concat(F.lit(r"(?m)^(?=#{2,4}[ \t]+"), own, F.lit(r"(?:\.\d+)+)")))


def split_sections(rows: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, part, id, title, start, body)``: a section's own text as part 0, then each sub-section, its heading included.

    A heading under another section's number stays in the piece that holds it.
    A section that begins with a sub-heading has no part 0; a null text has no parts.
    """
    found = rows.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), pieces(F.col(text)).alias("pieces"), own_number(F.col(text)).alias("own"))
    found = found.select("key", "own", F.posexplode("pieces").alias("at", "body"))
    before = Window.partitionBy("key").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    sub = F.col("body").rlike(SUB) & (F.col("own").isNull() | F.startswith(F.regexp_extract("body", SUB, 1), F.concat("own", F.lit("."))))
    named = lambda k: F.when(sub, F.rtrim(F.regexp_extract("body", SUB, k)))
    found = found.withColumn("start", F.coalesce(F.sum(F.length("body")).over(before), F.lit(0))).withColumn("id", named(1)).withColumn("title", named(2))
    headed = F.max(F.when(F.col("at") == 0, F.col("id").isNotNull())).over(Window.partitionBy("key"))
    return found.select("key", (F.col("at") + headed.cast("int")).alias("part"), "id", "title", "start", "body")


def conserved(rows: DataFrame, key: str, text: str, parts: DataFrame) -> DataFrame:
    """``(key, ok)``: whether the parts of each text, put together, are the text."""
    whole = parts.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "body"))), lambda x: x["body"]), "").alias("whole"))
    texts = rows.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    return texts.join(whole, "key", "left").select("key", F.coalesce(F.col("whole") == F.col("text"), F.lit(False)).alias("ok"))


def printed_label(text: Column) -> Column:
    """``A5``, ``S1``: the division that a page prints, in the first line or alone on one of the first, else null."""
    lines = F.slice(F.split(text, "\n"), 1, TOP_LINES)
    alone = F.get(F.filter(lines, lambda x: x.rlike(LINE_LABEL)), 0)
    first = lines[0]

    def label(line: Column, pattern: str) -> Column:
        word, letter = F.lower(F.regexp_extract(line, pattern, 1)), F.lit(None)
        for name, words in LABELS:
            letter = F.when(word.isin(*words), name).otherwise(letter)
        return F.concat(letter, F.regexp_extract(line, pattern, 2).cast("int").cast("string"))

    return F.when(first.rlike(HEAD_LABEL), label(first, HEAD_LABEL)).when(alone.isNotNull(), label(alone, LINE_LABEL))


def prefixes(rows: DataFrame, key: str, order: str, text: str, name: str, earlier: str | None = None) -> DataFrame:
    """``rows`` with ``prefix``, what a section is filed under within its document.

    The label that its page prints, in ``text`` or in the ``earlier`` version
    of it; else, by a mark in its name, an appendix of its own number, or of
    its place; else its own number in two digits, or an appendix of that number
    where an earlier section has it; 00 without a number.
    """
    label = printed_label(F.col(text)) if earlier is None else F.coalesce(printed_label(F.col(text)), printed_label(F.col(earlier)))
    number, marked = own_number(F.col(text)), F.lower(F.col(name)).rlike("|".join(MARKS))
    found = rows.withColumn("_label", label).withColumn("_n", number.cast("int")).withColumn("_place", F.row_number().over(Window.partitionBy(key).orderBy(order)))
    found = found.withColumn("_plain", F.col("_label").isNull() & ~marked & F.col("_n").isNotNull())
    nth = F.row_number().over(Window.partitionBy(key, "_plain", "_n").orderBy(order))
    prefix = (
        F.when(F.col("_label").isNotNull(), F.col("_label")).when(marked, F.concat(F.lit("A"), F.coalesce(F.nullif(number, F.lit("")), F.col("_place").cast("string"))))
        .when(F.col("_n").isNull(), "00").when(nth > 1, F.concat(F.lit("A"), F.col("_n").cast("string"))).otherwise(F.format_string("%02d", "_n"))
    )
    return found.withColumn("prefix", prefix).drop("_label", "_n", "_place", "_plain")
