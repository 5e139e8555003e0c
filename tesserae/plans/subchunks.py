"""Documents as numbered sections of the book that their source is, cut into sub-sections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import subchunks
from ..sources.tables import read
from .catalog import query

#: A section is a document, numbered by its place among those of its language in its source: the first line is its heading,
#: every line of one sentence a sub-heading, one that begins as the line before it a sub-heading of the next section's.
MD = r"""
WITH b AS (SELECT doc_id, source, lang, text, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS n FROM documents WHERE text IS NOT NULL),
l0 AS (SELECT doc_id, n, unnest(string_split(text, chr(10))) AS said, generate_subscripts(string_split(text, chr(10)), 1) AS ord FROM b),
l1 AS (SELECT *, ord > 1 AND said <> '' AND NOT contains(said, '. ') AS sub, ord > 1 AND said <> '' AND left(said, 1) = lag(left(said, 1)) OVER (PARTITION BY doc_id ORDER BY ord) AS stray FROM l0),
l2 AS (SELECT *, sum(CASE WHEN sub AND NOT stray THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ord) AS k, count(*) OVER (PARTITION BY doc_id) AS n_lines FROM l1),
l AS (SELECT doc_id, n, ord, k, sub AND NOT stray AS own, said, n_lines, CASE WHEN ord = 1 THEN '# ' || n || ' ' || said WHEN sub AND stray THEN '### ' || (n + 1) || '.1 ' || said WHEN sub THEN '### ' || n || '.' || k || ' ' || said ELSE said END AS line FROM l2)
"""


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, book, name, text)``: documents as sections of their source."""
    docs = read(spark, sf_dir, "documents").where("text is not null")
    docs = docs.select("doc_id", "source", "lang", "text", F.row_number().over(Window.partitionBy("source", "lang").orderBy("doc_id")).alias("n"))
    lines = docs.select("doc_id", "source", "lang", "n", F.posexplode(F.split("text", "\n")).alias("ord", "said"))
    order = Window.partitionBy("doc_id").orderBy("ord")
    body = (F.col("ord") > 0) & (F.col("said") != "")
    lines = lines.withColumn("sub", body & ~F.contains("said", F.lit(". "))).withColumn("stray", body & (F.left("said", F.lit(1)) == F.lag(F.left("said", F.lit(1))).over(order)))
    lines = lines.withColumn("k", F.count_if(F.col("sub") & ~F.coalesce("stray", F.lit(False))).over(order))
    n = F.col("n")
    line = (
        F.when(F.col("ord") == 0, F.concat(F.lit("# "), n.cast("string"), F.lit(" "), "said")).when(F.col("sub") & F.col("stray"), F.concat(F.lit("### "), (n + 1).cast("string"), F.lit(".1 "), "said"))
        .when(F.col("sub"), F.concat(F.lit("### "), n.cast("string"), F.lit("."), F.col("k").cast("string"), F.lit(" "), "said")).otherwise(F.col("said"))
    )
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", line.alias("line")))), lambda x: x["line"]), "\n")
    return lines.groupBy("doc_id").agg(F.first("source").alias("book"), F.first("lang").alias("name"), text.alias("text"))


@query("subchunks", MD + """, p AS (SELECT doc_id, k::BIGINT AS part, string_agg(line, chr(10) ORDER BY ord) || CASE WHEN max(ord) < max(n_lines) THEN chr(10) ELSE '' END AS body, max(CASE WHEN own THEN n || '.' || k END) AS id, max(CASE WHEN own THEN rtrim(said, ' ') END) AS title FROM l GROUP BY doc_id, k)
SELECT doc_id, part::INTEGER AS part, id, title, coalesce(sum(length(body)) OVER (PARTITION BY doc_id ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start, body FROM p""")
def subchunks_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections cut before the sub-headings of their own number, every character in one piece."""
    found = subchunks.split_sections(sections(spark, sf_dir), "doc_id", "text")
    return found.select(F.col("key").alias("doc_id"), "part", "id", "title", F.col("start").cast("bigint").alias("start"), "body")


@query("subchunks_conserved", "SELECT doc_id, true AS ok FROM documents WHERE text IS NOT NULL")
def subchunks_conserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces put together are the section, character for character."""
    rows = sections(spark, sf_dir)
    return subchunks.conserved(rows, "doc_id", "text", subchunks.split_sections(rows, "doc_id", "text")).select(F.col("key").alias("doc_id"), "ok")


@query("section_prefixes", """
WITH b AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS n FROM documents WHERE text IS NOT NULL), c AS (SELECT *, row_number() OVER (PARTITION BY source, n ORDER BY doc_id) AS nth FROM b)
SELECT doc_id, source AS book, CASE WHEN nth > 1 THEN 'A' || n ELSE lpad(n::VARCHAR, greatest(2, length(n::VARCHAR))::INTEGER, '0') END AS prefix FROM c""")
def section_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each section of a book is filed under; numbers start anew with each language, so repeated ones are appendices."""
    return subchunks.prefixes(sections(spark, sf_dir), "book", "doc_id", "text", "name").select("doc_id", "book", "prefix")
