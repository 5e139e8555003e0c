"""Scores of each document's damaged version, every term counted from the two texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import text as T
from ..operators import faults, trees
from ..sources.shared import cut
from .catalog import query
from .markup import _NUM, MD, damaged, markdown, swapped_digits

#: The version that lost every seventh line and has digits swapped, as in the number checks; its tables, headings, words and notes against the source's.
_COUNTS = MD + _NUM + r""", da AS (SELECT doc_id, ord, CASE WHEN ord % 7 = 3 THEN '' WHEN ord % 18 = 2 THEN regexp_replace(line, 'section ([0-9])([0-9])', 'section \2\1') ELSE line END AS line FROM md),
sw AS (SELECT p.doc_id, count(*) AS n FROM m p JOIN m q ON p.doc_id = q.doc_id AND p.na > p.nb AND q.nb > q.na AND p.x <> q.x AND list_sort(string_split(p.x, '')) = list_sort(string_split(q.x, '')) AND (ends_with(p.x, '%') OR length(p.x) >= 3) GROUP BY p.doc_id),
nd AS (SELECT DISTINCT doc_id, regexp_extract(line, '^\[\^([0-9]+)\]:', 1) AS id FROM da WHERE regexp_matches(line, '^\[\^[0-9]+\]:')), nr AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(line, '\[\^([0-9]+)\](?:[^:]|$)', 1)) AS id FROM da),
un AS (SELECT doc_id, count(*) AS n FROM nr ANTI JOIN nd USING (doc_id, id) GROUP BY doc_id),
ta AS (SELECT doc_id, ord, line, last_value(CASE WHEN regexp_matches(line, '^#{1,6} ') THEN line END IGNORE NULLS) OVER w AS u, regexp_matches(line, '^\|.*\|\s*$') AS r FROM md WINDOW w AS (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING)),
tb AS (SELECT doc_id, ord, line, last_value(CASE WHEN regexp_matches(line, '^#{1,6} ') THEN line END IGNORE NULLS) OVER w AS u, regexp_matches(line, '^\|.*\|\s*$') AS r FROM da WINDOW w AS (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING)),
tf AS (SELECT a.doc_id, count(*) AS n_rows, count(*) FILTER (coalesce(a.u, '') <> coalesce(b.u, '')) AS n FROM ta a JOIN tb b ON a.doc_id = b.doc_id AND a.ord = b.ord AND a.r AND b.r GROUP BY a.doc_id),
ha AS (SELECT doc_id, ord, length(regexp_extract(line, '^(#{1,6}) ', 1)) AS level FROM md WHERE regexp_matches(line, '^#{1,6} ')), hb AS (SELECT doc_id, ord, level FROM ha WHERE ord % 7 <> 3),
pa AS (SELECT c.doc_id, c.ord, max(p.ord) AS up FROM ha c LEFT JOIN ha p ON p.doc_id = c.doc_id AND p.ord < c.ord AND p.level < c.level GROUP BY c.doc_id, c.ord), pb AS (SELECT c.doc_id, c.ord, max(p.ord) AS up FROM hb c LEFT JOIN hb p ON p.doc_id = c.doc_id AND p.ord < c.ord AND p.level < c.level GROUP BY c.doc_id, c.ord),
hw AS (SELECT a.doc_id, count(b.ord) AS n_heads, count(*) AS promised, count(b.ord) FILTER (a.up IS DISTINCT FROM b.up) AS n FROM pa a LEFT JOIN pb b USING (doc_id, ord) GROUP BY a.doc_id),
wa AS (SELECT doc_id, t, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(line), '[\p{L}\p{N}]+')) AS t FROM md) GROUP BY ALL), wb AS (SELECT doc_id, t, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(line), '[\p{L}\p{N}]+')) AS t FROM da) GROUP BY ALL),
ex AS (SELECT wb.doc_id, sum(wb.n) AS n_words, sum(greatest(wb.n - coalesce(wa.n, 0), 0)) AS n FROM wb LEFT JOIN wa USING (doc_id, t) GROUP BY wb.doc_id),
i AS (SELECT DISTINCT doc_id FROM md),
s AS (SELECT i.doc_id, coalesce(sw.n, 0) AS swapped, coalesce(un.n, 0) AS uncited, coalesce(tf.n, 0) AS moved, coalesce(tf.n_rows, 0) AS n_rows, coalesce(hw.n, 0) AS wrong, coalesce(hw.n_heads, 0) AS n_heads, coalesce(hw.promised, 0) AS promised, coalesce(ex.n, 0) AS extra, coalesce(ex.n_words, 0) AS n_words
  FROM i LEFT JOIN sw USING (doc_id) LEFT JOIN un USING (doc_id) LEFT JOIN tf USING (doc_id) LEFT JOIN hw USING (doc_id) LEFT JOIN ex USING (doc_id))
"""


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defects of each document's damaged version, by kind."""
    md = cut(markdown(spark, sf_dir), "score-lines")
    da = damaged(md)
    swapped = swapped_digits(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("swapped"))
    bodies = da.where(F.col("line").rlike(r"^\[\^[0-9]+\]:")).select("doc_id", F.regexp_extract("line", r"^\[\^([0-9]+)\]:", 1).alias("id")).distinct()
    cited = da.select("doc_id", F.explode(F.regexp_extract_all("line", F.lit(r"\[\^([0-9]+)\](?:[^:]|$)"), 1)).alias("id")).distinct()
    uncited = cited.join(bodies, ["doc_id", "id"], "left_anti").groupBy("doc_id").agg(F.count("*").alias("uncited"))

    def under(x: DataFrame, name: str) -> DataFrame:
        head = F.last(F.when(F.col("line").rlike(faults.HEADING), F.col("line")), ignorenulls=True).over(Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0))
        return x.withColumn(name, F.coalesce(head, F.lit(""))).where(F.col("line").rlike(faults.ROW)).select("doc_id", "ord", name)

    moved = under(md, "a").join(under(da, "b"), ["doc_id", "ord"]).groupBy("doc_id").agg(F.count_if(F.col("a") != F.col("b")).alias("moved"), F.count("*").alias("n_rows"))
    heads = lambda x: trees.parents_by_level(x.where(F.col("line").rlike(faults.HEADING)).select("doc_id", "ord", F.length(F.regexp_extract("line", "^(#{1,6}) ", 1)).alias("level")), "doc_id", 6)
    both = heads(md).select("doc_id", "ord", F.col("parent").alias("pa")).join(heads(da).select("doc_id", "ord", F.col("parent").alias("pb"), F.lit(1).alias("there")), ["doc_id", "ord"], "left")
    wrong = both.groupBy("doc_id").agg(F.count_if(F.col("there").isNotNull() & ~F.col("pa").eqNullSafe(F.col("pb"))).alias("wrong"), F.count("there").alias("n_heads"), F.count("*").alias("promised"))
    words = lambda x, n: x.select("doc_id", F.explode(T.tokens(F.col("line"))).alias("t")).groupBy("doc_id", "t").agg(F.count("*").alias(n))
    extra = words(da, "nb").join(words(md, "na"), ["doc_id", "t"], "left").groupBy("doc_id").agg(F.sum(F.greatest(F.col("nb") - F.coalesce("na", F.lit(0)), F.lit(0))).alias("extra"), F.sum("nb").alias("n_words"))
    out = md.select("doc_id").distinct()
    for part in (swapped, uncited, moved, wrong, extra):
        out = out.join(part, "doc_id", "left")
    return out.na.fill(0)


@query("dimension_scores", _COUNTS + """SELECT doc_id, round(greatest(0, 100.0::DOUBLE - 15 * swapped - 3 * least(uncited, 10)), 1) AS integrity, round(greatest(0, 100.0::DOUBLE - 100.0 * moved / greatest(n_rows, 1) - 100.0 * wrong / greatest(n_heads, 1)), 1) AS placement,
round(greatest(0, 100.0::DOUBLE - 500.0 * extra / greatest(n_words, 1)), 1) AS uniqueness, CASE WHEN n_heads >= 2 THEN round(greatest(0, 100.0::DOUBLE - 100.0 * (promised - n_heads) / greatest(promised, 1)), 1) ELSE least(40.0::DOUBLE, round(greatest(0, 100.0::DOUBLE - 100.0 * (promised - n_heads) / greatest(promised, 1)), 1)) END AS sectioning FROM s""")
def dimension_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integrity, placement, uniqueness and sectioning from what each text lost."""
    c, none = F.col, F.lit(0)
    return counts(spark, sf_dir).select(
        "doc_id", R.integrity_score(c("swapped"), c("uncited")).alias("integrity"), R.placement_score(c("moved"), c("n_rows"), c("wrong"), c("n_heads"), none).alias("placement"), R.uniqueness_score(c("extra"), c("n_words"), none).alias("uniqueness"),
        R.sectioning_score(c("promised") - c("n_heads"), c("promised"), none, none, c("n_heads") >= 2).alias("sectioning"),
    )
