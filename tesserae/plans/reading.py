"""Headings of documents read as clauses: whole branches, notes as guidance, and what to read next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import reading, trees
from ..sources.shared import cut
from .catalog import query
from .markup import _HEADS, markdown

#: Sections are headings with the lines up to the next one; notes in a section are guidance on it.
_READ = _HEADS + r""", b AS (SELECT doc_id, ord, line, last_value(CASE WHEN regexp_matches(line, '^#{1,6} ') THEN ord END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS head FROM md),
t AS (SELECT doc_id, head AS ord, string_agg(line, ' ' ORDER BY ord) AS body FROM b WHERE head IS NOT NULL AND head <> ord AND line <> '' AND NOT regexp_matches(line, '^\[\^[0-9]+\]:') GROUP BY ALL),
g AS (SELECT doc_id, head AS sec, ord, regexp_extract(line, '^\[\^([0-9]+)\]:', 1) AS subject, trim(regexp_replace(line, '^\[\^[0-9]+\]:', '')) AS answer FROM b WHERE head IS NOT NULL AND regexp_matches(line, '^\[\^[0-9]+\]:')),
p AS (SELECT c.doc_id, c.ord, max(q.ord) AS up FROM h c LEFT JOIN h q ON q.doc_id = c.doc_id AND q.ord < c.ord AND q.level < c.level GROUP BY c.doc_id, c.ord),
s AS (SELECT h.doc_id, h.ord, h.level, 's' || h.ord AS id, p.up, h.title, coalesce(t.body, '') AS body FROM h JOIN p USING (doc_id, ord) LEFT JOIN t USING (doc_id, ord)),
e AS (SELECT a.*, coalesce((SELECT min(z.ord) FROM s z WHERE z.doc_id = a.doc_id AND z.ord > a.ord AND z.level <= a.level), 2147483647) AS stop FROM s a),
r AS (SELECT e.doc_id, e.ord AS head, k.* EXCLUDE (doc_id) FROM e JOIN s k ON k.doc_id = e.doc_id AND k.ord >= e.ord AND k.ord < e.stop),
x AS (SELECT doc_id, head, left(string_agg('[' || id || '] ' || title || ': ' || body, chr(10) ORDER BY ord) FILTER (body <> ''), 12000) AS text FROM r GROUP BY ALL),
y AS (SELECT r.doc_id, r.head, left(string_agg('[' || r.id || '] ' || g.subject || ': ' || g.answer, chr(10) ORDER BY g.sec, g.ord), 4000) AS guidance FROM r JOIN g ON g.doc_id = r.doc_id AND g.sec = r.ord AND g.answer <> '' GROUP BY ALL),
f AS (SELECT DISTINCT doc_id, head, ref FROM (SELECT doc_id, head, unnest(regexp_extract_all(body, '\b([A-K][0-9]+(?:\.[0-9]+)*(?:\([a-z]\))?)', 1)) AS ref FROM r UNION ALL SELECT doc_id, head, unnest(regexp_extract_all(body, '\bPart ([A-K])\b', 1)) FROM r
  UNION ALL SELECT a.doc_id, a.ord, c.id FROM s a JOIN s c ON c.doc_id = a.doc_id AND c.up = a.up)),
v AS (SELECT doc_id, head, list_sort(list(ref)) AS related FROM f WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = f.doc_id AND r.head = f.head AND r.id = f.ref) GROUP BY ALL)
"""


def clauses(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sections and guidance of every document."""
    md = cut(markdown(spark, sf_dir), "reading-lines").withColumn("is_head", F.col("line").rlike("^#{1,6} "))
    order = Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    md = md.withColumn("head", F.last(F.when(F.col("is_head"), F.col("ord")), ignorenulls=True).over(order)).where("head is not null").withColumn("note", F.col("line").rlike(r"^\[\^[0-9]+\]:"))
    body = md.where("not is_head and line <> '' and not note").groupBy("doc_id", F.col("head").alias("ord")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "line"))), lambda x: x["line"]), " ").alias("body"))
    heads = md.where("is_head").select("doc_id", "ord", F.length(F.regexp_extract("line", "^(#{1,6}) ", 1)).alias("level"), F.regexp_extract("line", "^#{1,6} +(.*)$", 1).alias("title"))
    heads = trees.parents_by_level(heads, "doc_id", 6).join(body, ["doc_id", "ord"], "left")
    name = lambda c: F.concat(F.lit("s"), F.col(c).cast("string"))
    cites = F.regexp_extract_all(F.coalesce("body", F.lit("")), F.lit(r"\b([A-K][0-9]+(?:\.[0-9]+)*(?:\([a-z]\))?)"), 1)
    sections = heads.select(F.col("doc_id").alias("key"), "ord", "level", name("ord").alias("id"), name("parent").alias("parent_id"), "title", "body", cites.alias("cites"))
    guidance = md.where("note").select(F.col("doc_id").alias("key"), name("head").alias("id"), "ord", F.regexp_extract("line", r"^\[\^([0-9]+)\]:", 1).alias("subject"), F.regexp_replace("line", r"^\[\^[0-9]+\]:", "").alias("answer"))
    return sections, guidance


@query("clause_readings", _READ + "SELECT s.doc_id, s.id, coalesce(x.text, s.title) AS text, coalesce(y.guidance, '') AS guidance, coalesce(v.related, []) AS related FROM s LEFT JOIN x ON x.doc_id = s.doc_id AND x.head = s.ord LEFT JOIN y ON y.doc_id = s.doc_id AND y.head = s.ord LEFT JOIN v ON v.doc_id = s.doc_id AND v.head = s.ord")
def clause_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every heading read with all that is below it, the notes on it, and what to read next."""
    return reading.readings(*clauses(spark, sf_dir), levels=6).withColumnRenamed("key", "doc_id")
