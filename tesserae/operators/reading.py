"""A clause as it is read: the text of its whole branch, guidance on it, and what to read next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .branches import LEVELS, spans

#: Characters of text and of guidance that a reading holds. Fixed values.
MOST_TEXT, MOST_GUIDANCE = 12_000, 4_000
#: A pointer to a part in running text.
PART = r"\bPart ([A-K])\b"


def joined(rows: DataFrame, keys: list[str], order: list[str], line: Column, most: int, name: str) -> DataFrame:
    """Lines of each key in order, by line breaks, up to ``most`` characters: lines that begin beyond that aren't gathered."""
    rows = rows.withColumn("_line", line).where("_line is not null")
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_start", F.coalesce(F.sum(F.length("_line") + 1).over(before), F.lit(0))).where(F.col("_start") <= most)
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "_line"))), lambda x: x["_line"]), "\n")
    return rows.groupBy(*keys).agg(F.substring(said, 1, most).alias(name))


def readings(sections: DataFrame, guidance: DataFrame, levels: int = LEVELS, most_text: int = MOST_TEXT, most_guidance: int = MOST_GUIDANCE) -> DataFrame:
    """``(key, id, text, guidance, related)`` for every one of ``sections(key, ord, level, id, parent_id, title, body, cites)``.

    text has the section and all below it, ``[id] title: body`` each, sections
    without a body left out, or just its title if none has one; guidance the
    answers of ``guidance(key, id, ord, subject, answer)`` on any of them;
    related, in order, what they cite, the parts that their texts point to and
    the section's siblings, less what was read. Both texts are cut at their
    limits, and what lies beyond isn't gathered. Null bodies and answers are empty.
    """
    rows = spans(sections, levels)
    ids = rows.select("key", F.col("ord").alias("of"), F.col("id").alias("of_id"), F.col("title").alias("of_title"))
    # each section is read with every section above it
    read = rows.select("key", "ord", "id", "title", "body", "cites", F.explode(F.concat("above", F.array("ord"))).alias("of"))
    body = F.coalesce(F.col("body"), F.lit(""))
    text = joined(read, ["key", "of"], ["ord"], F.when(body != "", F.concat(F.lit("["), "id", F.lit("] "), "title", F.lit(": "), body)), most_text, "text")
    answer = F.trim(F.coalesce(F.col("answer"), F.lit("")))
    said = F.when(answer != "", F.concat(F.lit("["), "id", F.lit("] "), F.coalesce("subject", F.lit("")), F.lit(": "), answer))
    told = read.select("key", "of", "id", F.col("ord").alias("at")).join(guidance.select("key", "id", "ord", "subject", "answer"), ["key", "id"])
    guided = joined(told, ["key", "of"], ["at", "ord"], said, most_guidance, "guidance")
    cited = read.select("key", "of", F.explode(F.array_union(F.coalesce("cites", F.array().cast("array<string>")), F.regexp_extract_all(body, F.lit(PART), 1))).alias("ref"))
    brothers = rows.where("parent_id is not null").select("key", "parent_id", F.col("id").alias("ref"))
    beside = rows.where("parent_id is not null").select("key", F.col("ord").alias("of"), "parent_id").join(brothers, ["key", "parent_id"]).select("key", "of", "ref")
    refs = cited.unionByName(beside).distinct().join(read.select("key", "of", F.col("id").alias("ref")), ["key", "of", "ref"], "left_anti")
    related = refs.groupBy("key", "of").agg(F.array_sort(F.collect_set("ref")).alias("related"))
    out = ids.join(text, ["key", "of"], "left").join(guided, ["key", "of"], "left").join(related, ["key", "of"], "left")
    return out.select("key", F.col("of_id").alias("id"), F.coalesce("text", "of_title").alias("text"), F.coalesce("guidance", F.lit("")).alias("guidance"), F.coalesce("related", F.array().cast("array<string>")).alias("related"))
