"""Documents' lines as entries of a printed table of contents, long titles wrapped, and the entries read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import contents
from .catalog import query
from .stitch import PAGE, ROWS, lines

#: Entries: first sentences of two words of letters or more, numbered; the page is the one that the line starts on.
WANTED = ROWS + r""", w AS (SELECT doc_id, line, start, regexp_replace(trim(first), '[.…\s]+$', '') AS title FROM l), x AS (SELECT * FROM w WHERE regexp_matches(title, '^\p{L}{2,} .*\p{L}$')),
e AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS nth, title, (1 + start // 1500)::INTEGER AS page_to FROM x),
y AS (SELECT *, 1 + (nth - 1) // 5 AS a, (nth - 1) % 5 AS b FROM e), z AS (SELECT *, CASE WHEN b = 0 THEN a::VARCHAR ELSE a || '.' || b END AS label FROM y)
"""


def wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir).withColumn("title", F.regexp_replace(F.trim("first"), r"[.…\s]+$", "")).where(F.col("title").rlike(r"^\p{L}{2,} .*\p{L}$"))
    rows = rows.select("doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy("line")).alias("nth"), "title", (1 + F.floor(F.col("start") / PAGE)).cast("int").alias("page_to"))
    a, b = 1 + F.floor((F.col("nth") - 1) / 5), (F.col("nth") - 1) % 5
    return rows.withColumn("label", F.when(b == 0, a.cast("string")).otherwise(F.concat(a.cast("string"), F.lit("."), b.cast("string"))))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(key, page, ord, line)``: ten entries a page; a title of over forty characters wraps at words, its label on a line of its own."""
    rows = wanted(spark, sf_dir)
    cut = F.split(F.regexp_replace("title", r"(.{30,}?) ", "$1\n"), "\n")
    end = F.concat(F.element_at("parts", -1), F.lit(" ........ "), F.col("page_to").cast("string"))
    body = F.concat(F.slice("parts", 1, F.size("parts") - 1), F.array(end))
    rows = rows.withColumn("parts", cut)
    said = F.when(F.length("title") > 40, F.concat(F.array(F.concat("label", F.lit("."))), body)).otherwise(F.array(F.concat("label", F.when(F.contains("label", F.lit(".")), "").otherwise("."), F.lit(" "), body[0], *[F.when(F.size(body) > k, F.concat(F.lit(" "), F.get(body, k))).otherwise("") for k in (1, 2)])))
    rows = rows.select(F.col("doc_id").alias("key"), F.floor((F.col("nth") - 1) / 10).alias("page"), "nth", F.posexplode(said).alias("k", "line"))
    return rows.select("key", "page", (F.col("nth").cast("bigint") * F.lit(1 << 32) + F.col("k")).alias("ord"), "line")


@query("contents_entries", WANTED + "SELECT doc_id, nth::INTEGER AS nth, label, title, page_to, CASE WHEN b = 0 THEN 1 ELSE 2 END AS depth FROM z")
def contents_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of the printed listing, whole titles however they wrapped."""
    return contents.entries(listing(spark, sf_dir), most_lines=None).withColumnRenamed("key", "doc_id")


@query("contents_pages", WANTED + "SELECT doc_id, page, n FROM (SELECT doc_id, (nth - 1) // 10 AS page, count(*) AS n FROM e GROUP BY ALL) WHERE n >= 6 OR n >= 3 AND page > 0")
def contents_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that are a listing, and thin ones after such a page."""
    return contents.listings(listing(spark, sf_dir)).withColumnRenamed("key", "doc_id")


@query("folded_entries", WANTED + "SELECT doc_id, nth::INTEGER AS nth, CASE WHEN b > 0 THEN 'deeper' END AS why FROM z")
def folded_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries that a tree of one level folds into the one above."""
    found = contents.folded(contents.entries(listing(spark, sf_dir), most_lines=None), 1)
    return found.select(F.col("key").alias("doc_id"), "nth", "why")
