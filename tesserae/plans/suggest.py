"""Spelling, chunking and boosted entity search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import lexicon
from ..sources.shared import cut
from ..sources.tables import read
from .catalog import query


@query("close_matches")
def close_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words seen once, with the common word that they resemble most; the measure has no SQL twin."""
    words = read(spark, sf_dir, "documents").select(F.explode(T.tokens(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("freq"))
    words = cut(words.where("freq = 1 and length(word) >= 6 or freq >= 20 and length(word) >= 4"), "word-counts")
    rare = words.where("freq = 1 and length(word) >= 6").select("word")
    return lexicon.close_matches(rare, words.where("freq >= 20 and length(word) >= 4").withColumnRenamed("word", "term"))


@query("paragraph_chunks")
def paragraph_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as overlapping chunks of whole paragraphs; an ordered fold."""
    rows = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(lexicon.chunk_text(F.col("text"))).alias("i", "chunk"))
    return rows.select("doc_id", "i", F.length("chunk").alias("n"), F.md5("chunk").alias("digest"))


@query("boosted_entity_search", """
WITH q AS (SELECT unnest(['red', 'ring', 'blue gear']) AS q), w AS (SELECT q, unnest(string_split(q, ' ')) AS t FROM q), p AS (SELECT p_partkey, p_name, p_type, string_split(p_name, ' ') AS n FROM part),
s AS (SELECT q.q, p_partkey, (p_name = q.q)::INT * 8 + starts_with(p_name, q.q)::INT * 5 + 3 * (SELECT count(*) FROM w WHERE w.q = q.q AND list_contains(n, t)) + (lower(p_type) = q.q)::INT AS score FROM q CROSS JOIN p)
SELECT q, p_partkey, CAST(score AS INTEGER) AS score, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, p_partkey) AS INTEGER) AS rk FROM s WHERE score > 0 QUALIFY rk <= 10
""")
def boosted_entity_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ladder of matches: whole title, beginning, words. A stated set of three questions against all rows."""
    asked = F.explode(F.array(*[F.struct(F.lit(x).alias("q"), F.array(*map(F.lit, x.split())).alias("t")) for x in ("red", "ring", "blue gear")])).alias("a")
    rows = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", F.split("p_name", " ").alias("n"), asked)
    q = F.col("a.q")
    score = (F.col("p_name") == q).cast("int") * 8 + F.startswith("p_name", q).cast("int") * 5 + 3 * F.size(F.filter("a.t", lambda t: F.array_contains("n", t))) + (F.lower("p_type") == q).cast("int")
    rows = rows.select(q.alias("q"), "p_partkey", score.alias("score")).where("score > 0")
    return rows.withColumn("rk", F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "p_partkey"))).where("rk <= 10")
