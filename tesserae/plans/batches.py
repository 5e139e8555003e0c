"""Lines of documents found again on the pages that print them, and dealt into batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import batches
from .catalog import query
from .stitch import PIECES, lines, pieces


def printed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(key, page, said)``: running text, each line's first sentence before the piece of the rest that a page has."""
    rows = pieces(spark, sf_dir).select("doc_id", "line", "page", F.concat(F.when(F.col("piece") == 1, F.concat("first", F.lit(" "))).otherwise(""), "said").alias("said"))
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "said"))), lambda x: x["said"]), " ")
    return rows.groupBy(F.col("doc_id").alias("key"), "page").agg(said.alias("said"))


def whole_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).select(F.col("doc_id").alias("key"), F.col("line").cast("long").alias("ord"), F.concat("first", F.lit(" "), "rest").alias("said"))


_WORDS = "regexp_extract_all(lower(%s), '[0-9a-z]+')"
_FOUND = PIECES + f""", g AS (SELECT q.doc_id, q.page, string_agg(CASE WHEN piece = 1 THEN l.first || ' ' ELSE '' END || q.said, ' ' ORDER BY q.line) AS said FROM q JOIN l USING (doc_id, line) GROUP BY q.doc_id, q.page),
h AS (SELECT doc_id, page, ' ' || array_to_string({_WORDS % 'said'}, ' ') || ' ' AS hay FROM g),
r AS (SELECT doc_id, line AS ord, {_WORDS % "first || ' ' || rest"} AS w FROM l),
k AS (SELECT doc_id, ord, w, unnest([0, 1, 2]) AS nth FROM r), o AS (SELECT doc_id, ord, nth, w[(len(w) * nth // 3 + 1):(len(w) * nth // 3 + 6)] AS run FROM k),
m AS (SELECT DISTINCT o.doc_id, o.ord, o.nth, h.page FROM o JOIN h ON h.doc_id = o.doc_id AND len(o.run) = 6 AND contains(h.hay, ' ' || array_to_string(o.run, ' ') || ' '))
"""


@query("row_pages", _FOUND + """, f AS (SELECT doc_id, ord, arg_min(page, [nth, page]) AS page FROM m GROUP BY doc_id, ord), z AS (SELECT doc_id, min(page) AS first FROM h GROUP BY doc_id)
SELECT r.doc_id, r.ord, coalesce(last_value(f.page IGNORE NULLS) OVER (PARTITION BY r.doc_id ORDER BY r.ord ROWS UNBOUNDED PRECEDING), z.first)::BIGINT AS page FROM r LEFT JOIN f USING (doc_id, ord) LEFT JOIN z ON z.doc_id = r.doc_id""")
def row_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page that each line is from, by probes of its words, else by the line before."""
    return batches.attributed(whole_rows(spark, sf_dir), printed_pages(spark, sf_dir)).select(F.col("key").alias("doc_id"), "ord", "page")


@query("row_pages_in_order", _FOUND + """, d AS (SELECT DISTINCT doc_id, ord, page FROM m) SELECT doc_id, count(DISTINCT ord) AS n_located, true AS rising FROM d GROUP BY doc_id""")
def row_pages_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, pages never falling: as documents are printed in order, no row with a probe on a page is lost by that."""
    rows, pages = whole_rows(spark, sf_dir), printed_pages(spark, sf_dir)
    found = batches.located(rows, pages)
    met = found.select("key", "ord").distinct()
    out = batches.attributed(rows, pages, in_order=True, met=found)
    rising = out.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "page"))), lambda x: x["page"]).alias("p")).select("key", (F.col("p") == F.array_sort("p")).alias("rising"))
    return met.groupBy("key").agg(F.count("*").alias("n_located")).join(rising, "key").select(F.col("key").alias("doc_id"), "n_located", "rising")


@query("planned_batches", PIECES + """, p1 AS (SELECT doc_id, line, min(page) AS page FROM q GROUP BY doc_id, line), b AS (SELECT l.doc_id, line AS ord, length(first) + 1 + length(rest) AS size, page FROM l JOIN p1 USING (doc_id, line)),
x AS (SELECT a.doc_id, a.ord, a.ord + count(*) FILTER (ok) AS next FROM (SELECT a.doc_id, a.ord, bool_and(c.page = a.page AND c.ord < a.ord + 6) OVER w AND (sum(c.size) OVER w <= 2000 OR c.ord = a.ord) AS ok FROM b a JOIN b c ON c.doc_id = a.doc_id AND c.ord BETWEEN a.ord AND a.ord + 5 WINDOW w AS (PARTITION BY a.doc_id, a.ord ORDER BY c.ord)) a GROUP BY a.doc_id, a.ord)
, starts AS (WITH RECURSIVE c(doc_id, ord, batch) AS (SELECT doc_id, 1::BIGINT, 0 FROM b WHERE ord = 1 UNION ALL SELECT c.doc_id, x.next, c.batch + 1 FROM c JOIN x USING (doc_id, ord) JOIN b y ON y.doc_id = x.doc_id AND y.ord = x.next) SELECT * FROM c)
SELECT b.doc_id, b.ord, max(t.batch)::INTEGER AS batch FROM b JOIN starts t ON t.doc_id = b.doc_id AND t.ord <= b.ord GROUP BY b.doc_id, b.ord""")
def planned_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in batches of six and two thousand characters at most, never of two pages."""
    page = pieces(spark, sf_dir).groupBy("doc_id", "line").agg(F.min("page").alias("page"))
    rows = lines(spark, sf_dir).join(page, ["doc_id", "line"]).select(F.col("doc_id").alias("key"), F.col("line").cast("long").alias("ord"), (F.length("first") + 1 + F.length("rest")).alias("size"), "page")
    return batches.planned(rows, 6, 2000, by_page=True).select(F.col("key").alias("doc_id"), "ord", "batch")
