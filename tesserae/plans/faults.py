"""Faults put into every document that offers a target, and what the checks notice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import faults
from ..sources.shared import cut
from .catalog import query
from .markup import MD, markdown

#: Documents that offer each fault a target; a fault with a stated effect is caught in all of them.
TARGETS = MD + r"""
, w AS (SELECT doc_id, ord, line, regexp_matches(line, '^#{1,6} ') AS head, regexp_matches(line, '^\|.*\|\s*$') AS tab FROM md),
n0 AS (SELECT doc_id, ord, unnest(regexp_extract_all(line, '(?:^|[^0-9.,])([0-9]+(?:[.,][0-9]+)*)', 1)) AS raw FROM md),
n1 AS (SELECT doc_id, ord, raw AS x FROM n0 WHERE regexp_matches(raw, '^[0-9]+(\.[0-9]+)?$')),
once AS (SELECT doc_id, x FROM n1 GROUP BY ALL HAVING count(*) = 1),
new AS (SELECT doc_id, x, CASE WHEN contains(x, '.') THEN replace(x, '.', '') WHEN length(x) >= 3 THEN left(x, length(x) - 2) || x[-1] || x[-2] END AS y, contains(x, '.') AS decimal FROM once),
good AS (SELECT DISTINCT doc_id, decimal FROM new WHERE y IS NOT NULL AND y <> x AND NOT EXISTS (SELECT 1 FROM n1 WHERE n1.doc_id = new.doc_id AND n1.x = new.y)),
d AS (SELECT 'drop_paragraph' AS fault, doc_id FROM w WHERE NOT head AND NOT tab AND len(list_filter(regexp_split_to_array(line, '[^\p{L}]+'), lambda z: z <> '')) >= 8
 UNION SELECT CASE WHEN decimal THEN 'drop_decimal' ELSE 'swap_digits' END, doc_id FROM good
 UNION SELECT 'flip_negation', doc_id FROM md WHERE regexp_matches(line, '(?i)\b(must|shall|may|is|are|was|does|do|did|of|in|the) not\b')
 UNION SELECT 'delete_table', doc_id FROM w WHERE tab
 UNION SELECT 'move_table', t.doc_id FROM (SELECT doc_id, min(ord) AS first FROM w WHERE tab GROUP BY doc_id) t JOIN w h ON h.doc_id = t.doc_id AND h.head AND h.ord > t.first
 UNION SELECT 'move_heading', a.doc_id FROM w a JOIN w b ON b.doc_id = a.doc_id AND a.head AND b.head AND b.ord > a.ord WHERE (SELECT count(*) FROM w c WHERE c.doc_id = a.doc_id AND c.line = a.line) = 1)
"""


@query("faults_caught", TARGETS + "SELECT fault, count(*) AS n_docs, count(*) AS n_caught FROM d GROUP BY fault")
def faults_caught(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that took each fault, and in how many the check that has to notice it did."""
    found = faults.fault_matrix(cut(markdown(spark, sf_dir), "fault-lines"))
    return found.groupBy("fault").agg(F.count("*").alias("n_docs"), F.count_if("caught").alias("n_caught"))


@query("fault_matrix")
def fault_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents each check speaks up in for each fault; which target a seed picks has no SQL twin."""
    found = faults.fault_matrix(cut(markdown(spark, sf_dir), "fault-lines"))
    names = sorted(set(faults.EFFECTS.values()))
    return found.groupBy("fault").agg(F.count("*").alias("n_docs"), *[F.count_if(F.col(c) > 0).alias(c) for c in names])
