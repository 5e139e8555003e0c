"""Headings found in their source, the source that is a section's own, and lists aligned in sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import chains
from ..sources.tables import read
from .catalog import query

WORD = "[0-9a-z]+"
#: Words of each text with the line that they stand on; lines of three to nine words are headings.
SOURCE = r"""
WITH l0 AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS said, generate_subscripts(string_split(text, chr(10)), 1) AS ord FROM documents),
l AS (SELECT doc_id, ord, regexp_extract_all(lower(said), '[0-9a-z]+') AS words FROM l0),
o AS (SELECT *, coalesce(sum(len(words)) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM l),
h AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS i, start, words, len(words) AS n FROM o WHERE len(words) BETWEEN 3 AND 9)
"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "said"))
    rows = rows.select("doc_id", "ord", F.regexp_extract_all(F.lower("said"), F.lit(f"({WORD})"), 1).alias("words"))
    before = Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("start", F.coalesce(F.sum(F.size("words")).over(before), F.lit(0)))


def source(rows: DataFrame) -> DataFrame:
    words = rows.select("doc_id", "start", F.posexplode("words").alias("k", "word"))
    return words.select("doc_id", (F.col("start") + F.col("k")).alias("pos"), "word", (F.col("k") == 0).alias("line_start"))


def headings(rows: DataFrame) -> DataFrame:
    """Lines of three to nine words, numbered."""
    found = rows.where(F.size("words").between(3, 9))
    return found.select("doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy("ord")).alias("i"), "words")


def next_of_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, other)``: the next document of the same source, if there is one."""
    ids = read(spark, sf_dir, "documents").select("source", "doc_id").distinct()
    return ids.select("doc_id", F.lead("doc_id").over(Window.partitionBy("source").orderBy("doc_id")).alias("other")).where("other is not null")


def with_lost(asked: DataFrame, after: DataFrame) -> DataFrame:
    """Behind each heading the one that the next document has there, numbered between: it may not be in the source."""
    others = asked.select(F.col("doc_id").alias("other"), (F.col("i") * 2).alias("i"), "words").join(after, "other")
    return asked.select("doc_id", (F.col("i") * 2 - 1).alias("i"), "words").unionByName(others.select("doc_id", "i", "words"))


@query("headings_located", SOURCE + "SELECT doc_id, count(*) AS n_headings, count(*) AS n_located, count(*) AS n_on_lines FROM h GROUP BY doc_id")
def headings_located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings of each text found again in its running words, all of them at the start of a line."""
    rows = lines(spark, sf_dir)
    words = source(rows)
    found = chains.located(headings(rows), words)
    starts = words.where("line_start").select("doc_id", F.col("pos").alias("at"))
    found = found.join(starts.withColumn("on_line", F.lit(1)), ["doc_id", "at"], "left")
    return found.groupBy("doc_id").agg(F.count("*").alias("n_headings"), F.count("at").alias("n_located"), F.count("on_line").alias("n_on_lines"))


@query("headings_among_lost", SOURCE + "SELECT doc_id, count(*) AS n_own FROM h GROUP BY doc_id")
def headings_among_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same among headings of another text: those that the source lacks take none of the others with them."""
    rows = lines(spark, sf_dir)
    own = headings(rows)
    found = chains.located(with_lost(own, next_of_source(spark, sf_dir)), source(rows))
    met = found.where("at is not null").groupBy("doc_id").agg(F.count("*").alias("n_met"))
    sizes = own.groupBy("doc_id").agg(F.count("*").alias("n"))
    return sizes.join(met, "doc_id", "left").select("doc_id", F.least("n", F.coalesce("n_met", F.lit(0))).alias("n_own"))


@query("own_slices")
def own_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source between each located heading and the next; which place a repeated heading has is the chain's choice."""
    rows = lines(spark, sf_dir)
    words = source(rows)
    sizes = words.groupBy("doc_id").agg(F.count("*").alias("n"))
    return chains.own_slices(chains.located(headings(rows), words), sizes)


#: Unique lines only: their common order has one longest chain's length, which SQL finds by counting steps.
@query("lines_aligned", r"""
WITH RECURSIVE t AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS said, generate_subscripts(string_split(text, chr(10)), 1) AS ord FROM documents WHERE text IS NOT NULL),
u AS (SELECT source, doc_id, said, min(ord) AS ord FROM t GROUP BY ALL),
n AS (SELECT source, doc_id, lead(doc_id) OVER (PARTITION BY source ORDER BY doc_id) AS other FROM (SELECT DISTINCT source, doc_id FROM u)),
p AS (SELECT n.doc_id, a.ord AS a, b.ord AS b FROM n JOIN u a ON a.source = n.source AND a.doc_id = n.doc_id JOIN u b ON b.source = n.source AND b.doc_id = n.other AND b.said = a.said),
c(doc_id, a, b, n) AS (SELECT doc_id, a, b, 1 FROM p UNION SELECT p.doc_id, p.a, p.b, c.n + 1 FROM c JOIN p ON p.doc_id = c.doc_id AND p.a > c.a AND p.b > c.b)
SELECT doc_id, max(n)::BIGINT AS n_aligned FROM c GROUP BY doc_id
""")
def lines_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that a document and the next one of its source have in the same order."""
    docs = read(spark, sf_dir, "documents").where("text is not null").select("source", "doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "said"))
    first = docs.groupBy("source", "doc_id", "said").agg(F.min("ord").alias("ord"))
    after = first.select("source", "doc_id").distinct().withColumn("other", F.lead("doc_id").over(Window.partitionBy("source").orderBy("doc_id")))
    right = first.withColumnRenamed("doc_id", "other").join(after, ["source", "other"]).select("doc_id", "ord", "said")
    return chains.aligned(first.select("doc_id", "ord", "said"), right, ["doc_id"], "ord", "said").groupBy("doc_id").agg(F.count("*").alias("n_aligned"))
