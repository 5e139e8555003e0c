"""Section trees of markdown documents and what an output lost of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import gaps, outline, tables
from ..sources.shared import cut, dealt
from .catalog import query
from .markup import MD, kind_of, markdown


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of markdown as layout blocks: a dozen to a page, headings with a hint of their level."""
    line = F.col("line")
    kind = kind_of(line)
    as_kind = F.when(kind == "bullet", "list").when(kind == "note", "footnote").when(kind.isin("heading", "text"), "text").otherwise(kind)
    text = F.when(kind == "heading", F.regexp_replace(line, "^#{1,6} +", "")).when(kind == "bullet", F.regexp_replace(line, "^[-*•] ", "")).otherwise(line)
    rows = markdown(spark, sf_dir).where("line <> ''")
    return rows.select("doc_id", "ord", as_kind.alias("kind"), F.when(kind == "heading", F.length(F.regexp_extract(line, "^(#{1,6}) ", 1))).otherwise(0).alias("hint"), text.alias("text"), F.floor(F.col("ord") / 12).cast("int").alias("page"))


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut(outline.section_tree(outline.demoted(cut(blocks(spark, sf_dir), "blocks"))), "section-tree")


@query("block_sections")
def block_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every block with the section that it stands under; an ordered fold that SQL doesn't have."""
    return tree(spark, sf_dir).select("doc_id", "ord", "kind", "section", "level", "parent", "family", "literal")


@query("ranked_sections")
def ranked_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings under the innermost open section of an outer family, headings without a number being outermost."""
    rows = outline.section_tree(blocks(spark, sf_dir), by_rank=True).where("level is not null")
    return rows.select("doc_id", "ord", "level", "parent", "family")


@query("clause_sections")
def clause_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections with the clause keys that their numbers make, and those that fold into one above."""
    return outline.clause_sections(tree(spark, sf_dir)).drop("text")


@query("section_contents")
def section_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks, characters and pages of each clause, content of folded sections included."""
    rows = tree(spark, sf_dir)
    owner = outline.clause_sections(rows).select("doc_id", F.col("ord").alias("section"), "owner")
    body = rows.where("level is null and kind <> 'footnote'").join(owner, ["doc_id", "section"], "left").withColumn("owner", F.coalesce("owner", F.lit(-1)))
    return body.groupBy("doc_id", "owner").agg(F.count("*").alias("n_blocks"), F.sum("size").alias("n_chars"), F.min("page").alias("page_start"), F.max("page").alias("page_end"))


@query("section_notes")
def section_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Footnotes of a page go to every section whose pages cover it."""
    rows = tree(spark, sf_dir)
    pages = rows.where("section >= 0").groupBy("doc_id", "section").agg(F.min("page").alias("lo"), F.max("page").alias("hi"))
    notes = rows.where("kind = 'footnote'").select("doc_id", "page", F.col("ord").alias("note"))
    return tables.attach_ranges(notes, pages, ["doc_id"], "page", "lo", "hi").select("doc_id", "section", "note")


def line_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, ord, section, bar, words)`` of lines with text, words one string; read once."""
    line = F.col("line")
    rows = markdown(spark, sf_dir).where(line != "").select("doc_id", "ord", F.floor(F.col("ord") / 9).cast("int").alias("section"), line.startswith("|").alias("bar"), F.array_join(T.tokens(T.clean_markdown(line)), " ").alias("words"))
    return cut(rows, "line-words")


def tokens_of(rows: DataFrame, place: Column, output: Column) -> DataFrame:
    """``(doc_id, side, section, pos, line, token)``: the words of lines in the source, and where ``output(side, section, o)`` isn't null there too.

    A line's words are one row: places of a line, then of a word in it.
    """
    sides = F.filter(F.array(F.struct(F.lit(0).alias("side"), F.col("section"), place.alias("o")), output), lambda x: x.isNotNull())
    rows = rows.where("words <> ''").select("doc_id", "words", "ord", F.explode(sides).alias("x"))
    return rows.select("doc_id", "x.side", "x.section", (F.col("x.o") * F.lit(1 << 32)).alias("pos"), F.col("ord").alias("line"), F.col("words").alias("token"))


def both_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of documents and of a damaged output: lines gone, moved to the next section, or shuffled in place."""
    moved = F.when(F.col("ord") % 13 == 5, F.col("section") + 1).otherwise(F.col("section"))
    place = F.when(F.col("ord") % 11 == 4, F.col("ord") - 3).otherwise(F.col("ord")).cast("bigint")
    output = F.when(F.col("ord") % 7 != 3, F.struct(F.lit(1).alias("side"), moved.alias("section"), place.alias("o")))
    return tokens_of(line_words(spark, sf_dir), F.col("ord").cast("bigint"), output)


def emptied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides again, but where a section has no table all of its output stands at the end of the section before it."""
    rows = dealt(line_words(spark, sf_dir), "doc_id", "words").withColumn("has_table", F.max("bar").over(Window.partitionBy("doc_id", "section")))
    section = F.when(F.col("has_table") | (F.col("section") == 0), F.col("section")).otherwise(F.col("section") - 1)
    place = F.col("ord").cast("bigint")
    return tokens_of(rows, place, F.struct(F.lit(1).alias("side"), section.alias("section"), place.alias("o")))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table cells and note bodies of three words or more, as token lists."""
    md = markdown(spark, sf_dir)
    parts = F.when(F.col("line").rlike(r"^\|.*\|$"), F.split("line", r"\|")).when(F.col("line").rlike(r"^\[\^[0-9]+\]:"), F.array(F.regexp_replace("line", r"^\[\^[0-9]+\]:", "")))
    return md.select("doc_id", F.explode(parts).alias("c")).select("doc_id", T.tokens(F.col("c")).alias("words")).where(F.size("words") >= 3)


@query("localized_gaps")
def localized_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each section lost, and whether it stands elsewhere after all."""
    return gaps.localized_gaps(both_sides(spark, sf_dir), cells(spark, sf_dir))


@query("hollow_sections")
def hollow_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections whose body went to another one, the heading left behind."""
    rows = emptied(spark, sf_dir)
    return gaps.hollow(rows, gaps.localized_gaps(rows, cells(spark, sf_dir)))


@query("restructured_units", MD + """, c AS (SELECT doc_id, trim(unnest(string_split(trim(line, '|'), '|'))) AS c FROM md WHERE regexp_matches(line, '^\\|.*\\|$') UNION ALL SELECT doc_id, regexp_replace(line, '^\\[\\^[0-9]+\\]:', '') FROM md WHERE regexp_matches(line, '^\\[\\^[0-9]+\\]:')),
w AS (SELECT DISTINCT doc_id, regexp_extract_all(lower(c), '[\\p{L}\\p{N}]+') AS words FROM c) SELECT doc_id, words FROM w WHERE len(words) >= 3
""")
def restructured_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells and notes as units of words."""
    return cells(spark, sf_dir).distinct()
