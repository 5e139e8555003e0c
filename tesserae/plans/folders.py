"""Documents as files of folder trees: the tree as sections, and the parts of trees without letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import folders
from ..sources.tables import read
from .catalog import query

#: A tree for each source and language; a document's first word is its folder, lettered by its length where the source's number
#: is even, else numbered within a wrapper; its second word is the file.
FILES = r"""
WITH w AS (SELECT doc_id, source || '-' || lang AS key, source, text, regexp_extract_all(lower(text), '\p{L}+') AS w FROM documents),
d AS (SELECT doc_id, key, regexp_matches(source, '[02468]$') AS lettered, text, w[1] AS a, coalesce(w[2], 'x') AS b, row_number() OVER (PARTITION BY key ORDER BY doc_id) AS page FROM w WHERE len(w) > 0),
f AS (SELECT *, CASE WHEN lettered THEN chr((65 + length(a) % 11)::INTEGER) || '-' || a ELSE '02-' || key || '/' || page || '-' || a END AS folder FROM d)
"""


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(key, path, page, text)``."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1)
    rows = read(spark, sf_dir, "documents").select("doc_id", F.concat("source", F.lit("-"), "lang").alias("key"), "source", "text", words.alias("w")).where("size(w) > 0")
    page = F.row_number().over(Window.partitionBy("key").orderBy("doc_id"))
    rows = rows.withColumn("page", page).withColumn("a", F.col("w")[0]).withColumn("b", F.coalesce(F.get("w", 1), F.lit("x")))
    letter = F.char(65 + F.length("a") % 11)
    folder = F.when(F.col("source").rlike("[02468]$"), F.concat(letter, F.lit("-"), "a")).otherwise(F.concat(F.lit("02-"), "key", F.lit("/"), F.col("page").cast("string"), F.lit("-"), "a"))
    return rows.select("key", F.concat(folder, F.lit("/"), F.col("page").cast("string"), F.lit("-"), "b", F.lit(".md")).alias("path"), "page", "text")


@query("tree_sections", FILES + r""", p AS (SELECT key, folder || '/' || page || '-' || b AS node, text FROM f),
n AS (SELECT key, node, text FROM p UNION ALL SELECT DISTINCT key, folder, NULL FROM f UNION ALL SELECT DISTINCT key, '02-' || key, NULL FROM f WHERE NOT lettered)
SELECT key, node, CASE WHEN contains(node, '/') THEN regexp_replace(node, '/[^/]*$', '') END AS parent, (1 + length(node) - length(replace(node, '/', '')))::INTEGER AS level, length(text) AS n_chars FROM n""")
def tree_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file and folder as a section of its tree."""
    return folders.model(files(spark, sf_dir)).select("key", "node", "parent", "level", F.length("text").cast("bigint").alias("n_chars"))


@query("inferred_parts", FILES + r""", v AS (SELECT DISTINCT key, chr((65 + length(a) % 11)::INTEGER) AS letter, a AS name, true AS is_part FROM f WHERE lettered UNION ALL SELECT DISTINCT key, chr((65 + length(a) % 11)::INTEGER), b, false FROM f WHERE lettered),
c AS (SELECT name, is_part, letter, count(*) AS n FROM v GROUP BY ALL), x AS (SELECT name, is_part, arg_max(letter, [n, -ascii(letter)]) AS letter, max(n) AS n, sum(n) AS total FROM c GROUP BY name, is_part HAVING max(n) >= 3 AND max(n) >= 0.6 * sum(n)),
lex AS (SELECT name, arg_max(letter, is_part::INTEGER) AS letter, bool_or(is_part) AS is_part FROM x GROUP BY name),
u AS (SELECT f.key, f.page, f.page || '-' || a AS name, lex.letter, coalesce(lex.is_part, false) AS is_part FROM f LEFT JOIN lex ON lex.name = a WHERE NOT lettered),
z AS (SELECT key, name, last_value(letter IGNORE NULLS) OVER (PARTITION BY key ORDER BY page, name ROWS UNBOUNDED PRECEDING) AS letter, is_part, '02-' || key AS wrapper FROM u)
SELECT * FROM z WHERE letter IS NOT NULL""")
def inferred_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of folders in trees that don't letter them, by the names that lettered trees have."""
    rows = files(spark, sf_dir)
    return folders.inferred(rows, folders.learned(rows))
