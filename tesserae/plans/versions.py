"""Tables of sentences before and after a stage that joins cells and moves questions, and outlines with what their branches lost."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import branches, versions
from ..sources.shared import cut_together
from .catalog import query
from .grids import LINES, shaped
from .markup import _HEADS, headings

#: The later stage: a second and a third sentence of four or more that begin alike become one cell, and a first sentence goes to
#: the end of the row above where the second ones begin alike.
STAGES = LINES + r"""
, m AS (SELECT doc_id, line, parts, len(parts) >= 2 AND lag(len(parts)) OVER w >= 2 AND left(parts[2], 1) = left(lag(parts[2]) OVER w, 1) AS gone, len(parts) >= 4 AND left(parts[2], 1) = left(parts[3], 1) AS joined FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY line)),
n AS (SELECT *, lead(CASE WHEN gone THEN parts[1] END) OVER (PARTITION BY doc_id ORDER BY line) AS gets FROM m),
x AS (SELECT doc_id, line, CASE WHEN joined THEN list_concat([parts[1], parts[2] || ' ' || parts[3]], parts[4:]) ELSE parts END AS p, gone, gets FROM n),
y AS (SELECT doc_id, line, list_concat(list_concat([CASE WHEN gone THEN '' ELSE p[1] END], p[2:-2]), CASE WHEN len(p) > 1 THEN [p[-1] || CASE WHEN gets IS NOT NULL THEN ' ' || gets ELSE '' END] ELSE [] END) AS q FROM x),
e AS (SELECT doc_id, line, unnest(range(0, len(parts))) AS item, unnest(parts) AS said, len(parts) AS width FROM t), after AS (SELECT doc_id, line, unnest(range(0, len(q))) AS item, unnest(q) AS said, len(q) AS width FROM y),
early AS (SELECT *, regexp_replace(lower(said), '[^0-9a-z]+', '', 'g') AS s, len(list_filter(regexp_split_to_array(lower(said), '[^0-9a-z]+'), lambda z: z <> '')) AS n, CASE WHEN item = width - 1 AND width > 1 THEN 'answer' ELSE 'question' END AS role FROM e),
late AS (SELECT *, regexp_replace(lower(said), '[^0-9a-z]+', '', 'g') AS s, len(list_filter(regexp_split_to_array(lower(said), '[^0-9a-z]+'), lambda z: z <> '')) AS n, CASE WHEN item = width - 1 AND width > 1 THEN 'answer' ELSE 'question' END AS role FROM after)
"""


def stages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(key, tab, line, item, said)`` of both."""
    rows = shaped(spark, sf_dir).select(F.col("doc_id").alias("key"), "line", "parts")
    order = Window.partitionBy("key").orderBy("line")
    p, n = F.col("parts"), F.size("parts")
    begins = lambda c: F.left(F.get(c, 1), F.lit(1))
    rows = rows.withColumn("gone", F.coalesce((n >= 2) & (F.lag(n).over(order) >= 2) & (begins(p) == F.lag(begins(p)).over(order)), F.lit(False)))
    rows = rows.withColumn("gets", F.lead(F.when(F.col("gone"), F.get(p, 0))).over(order))
    joined = F.when((n >= 4) & (begins(p) == F.left(F.get(p, 2), F.lit(1))), F.concat(F.array(p[0], F.concat(F.get(p, 1), F.lit(" "), F.get(p, 2))), F.slice(p, 4, n))).otherwise(p)
    rows = rows.withColumn("p", joined)
    last = F.when(F.size("p") > 1, F.array(F.concat(F.element_at("p", -1), F.when(F.col("gets").isNotNull(), F.concat(F.lit(" "), "gets")).otherwise("")))).otherwise(F.array().cast("array<string>"))
    later = F.concat(F.array(F.when(F.col("gone"), "").otherwise(F.col("p")[0])), F.slice("p", 2, F.greatest(F.size("p") - 2, F.lit(0))), last)
    cells = lambda c: rows.select("key", F.lit(0).alias("tab"), "line", F.posexplode(c).alias("item", "said"))
    return cells(p), cells(later)


@query("cell_merges", STAGES + """, r AS (
SELECT a.doc_id, 1 AS rank, 'column' AS kind, a.line AS l1, a.item AS i1, b.line AS l2, b.item AS i2, a.s || b.s AS s, a.s AS sa, b.s AS sb FROM early a JOIN early b ON a.doc_id = b.doc_id AND a.line = b.line AND b.item = a.item + 1 WHERE a.n >= 4 AND b.n >= 4
UNION ALL SELECT a.doc_id, 2, 'row', a.line, a.item, b.line, b.item, a.s || b.s, a.s, b.s FROM early a JOIN early b ON a.doc_id = b.doc_id AND b.line = a.line + 1 AND b.item = a.item WHERE a.n >= 4 AND b.n >= 4
UNION ALL SELECT a.doc_id, 3, 'block', a.line, a.item, b.line, b.item, a.s || b.s, a.s, b.s FROM early a JOIN early b ON a.doc_id = b.doc_id AND b.line = a.line + 1 AND b.item = 0 AND a.item = a.width - 1 AND a.item <> 0 WHERE a.n >= 4 AND b.n >= 4),
f AS (SELECT * FROM r WHERE NOT contains(sa, sb) AND NOT contains(sb, sa))
SELECT l.doc_id, l.line, l.item, arg_min(f.kind, [f.rank, f.l1, f.i1, f.l2, f.i2]) AS kind, arg_min([f.l1, f.i1, f.l2, f.i2], [f.rank, f.l1, f.i1, f.l2, f.i2]) AS slots FROM late l JOIN f ON f.doc_id = l.doc_id AND f.s = l.s
WHERE l.n >= 8 AND NOT EXISTS (SELECT 1 FROM early x WHERE x.doc_id = l.doc_id AND x.s = l.s) GROUP BY l.doc_id, l.line, l.item""")
def cell_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the later stage that hold two neighbours of the earlier one."""
    found = versions.cell_merges(*stages(spark, sf_dir), longest=2)
    slots = F.flatten(F.transform("slots", lambda x: F.array(x["line"].cast("bigint"), x["item"].cast("bigint"))))
    return found.select(F.col("key").alias("doc_id"), F.col("line").cast("bigint").alias("line"), F.col("item").cast("bigint").alias("item"), "kind", slots.alias("slots"))


_MOVED = STAGES + """, h AS (SELECT a.doc_id, a.line, a.item, a.role, a.width, a.s, min([b.line, b.item]) AS at FROM early a JOIN late b ON a.doc_id = b.doc_id AND contains(b.s, a.s) WHERE length(a.s) >= 25 AND %s GROUP BY ALL),
v AS (SELECT h.*, b.line AS to_line, b.item AS to_item, b.role AS to_role, b.s AS whole, CASE WHEN b.width <> h.width THEN 'reshaped' WHEN b.role <> h.role THEN 'moved' END AS change FROM h JOIN late b ON b.doc_id = h.doc_id AND b.line = h.at[1] AND b.item = h.at[2])
"""
#: A later cell that holds an earlier one's letters holds its first words too, unless letters of other words make them up.
_WORDS = "contains(' ' || array_to_string(list_filter(regexp_split_to_array(lower(b.said), '[^0-9a-z]+'), lambda z: z <> ''), ' ') || ' ', ' ' || array_to_string(list_filter(regexp_split_to_array(lower(a.said), '[^0-9a-z]+'), lambda z: z <> '')[1:4], ' ') || ' ')"


@query("moved_text", _MOVED % _WORDS + "SELECT doc_id, line, item, role, to_line, to_item, to_role, change FROM v WHERE change IS NOT NULL")
def moved_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences that the later stage holds on the other side of its table, or in a row of another shape."""
    found = cut_together(versions.moved_text(*stages(spark, sf_dir)), "moved-text")
    long = lambda c: F.col(c).cast("bigint").alias(c)
    return found.select(F.col("key").alias("doc_id"), long("line"), long("item"), "role", long("to_line"), long("to_item"), "to_role", "change")


@query("column_repairs", _MOVED % _WORDS + """SELECT v.doc_id, v.line, v.item, v.to_line, v.to_item, CASE WHEN v.role <> 'question' OR v.to_role <> 'answer' THEN 'not a question in an answer' WHEN NOT ends_with(v.whole, v.s) THEN 'not at the answer''s end' WHEN b.s IS NULL THEN 'no row below' WHEN b.s <> '' THEN 'the row below has a first cell' END AS why
FROM v LEFT JOIN late b ON b.doc_id = v.doc_id AND b.line = v.to_line + 1 AND b.item = 0 WHERE change = 'moved'""")
def column_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of them can be put back, and why the others can't."""
    found = cut_together(versions.column_repairs(*stages(spark, sf_dir)), "column-repairs")
    long = lambda c: F.col(c).cast("bigint").alias(c)
    return found.select(F.col("key").alias("doc_id"), long("line"), long("item"), long("to_line"), long("to_item"), "why")


@query("repaired_rest", _MOVED % _WORDS + """, good AS (SELECT v.doc_id, v.line, v.item FROM v LEFT JOIN late b ON b.doc_id = v.doc_id AND b.line = v.to_line + 1 AND b.item = 0 WHERE change = 'moved' AND v.role = 'question' AND v.to_role = 'answer' AND ends_with(v.whole, v.s) AND b.s = '')
SELECT doc_id, count(*) AS n_repairs, 0::BIGINT AS n_left FROM good GROUP BY doc_id""")
def repaired_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repairs of each document, and how many are left to make once they are made: none."""
    before, after = stages(spark, sf_dir)
    repairs = cut_together(versions.column_repairs(before, after).where("why is null"), "repairs")
    mine = repairs.select("key").distinct()  # nothing is asked of other documents
    before, after = (cells.join(mine, "key", "left_semi") for cells in (before, after))
    again = cut_together(versions.column_repairs(before, versions.repaired(after, repairs)).where("why is null"), "repairs-left").groupBy("key").agg(F.count("*").alias("n_left"))
    out = repairs.groupBy("key").agg(F.count("*").alias("n_repairs")).join(again, "key", "left")
    return out.select(F.col("key").alias("doc_id"), "n_repairs", F.coalesce("n_left", F.lit(0)).cast("bigint").alias("n_left"))


#: Headings are hollow or missing by what their title holds; the heading before took the text of hollow ones.
_NODES = _HEADS + """, o AS (SELECT h.doc_id, h.ord, h.level, h.title, lag(h.ord) OVER w AS before, sum(length(h.title)) OVER w AS run FROM h WINDOW w AS (PARTITION BY h.doc_id ORDER BY h.ord)),
n AS (SELECT doc_id, ord, level, title, run, CASE WHEN title ILIKE '%on%' AND before IS NOT NULL THEN 'hollow' WHEN title ILIKE '%er%' THEN 'missing' ELSE 'built' END AS status, CASE WHEN title ILIKE '%on%' THEN before END AS absorbed_by FROM o)
"""


def outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(key, ord, level, title, run, status, absorbed_by)``: headings, hollow or missing by what their title holds, the heading before as the one that took their text."""
    order = Window.partitionBy("doc_id").orderBy("ord")
    rows = headings(spark, sf_dir).withColumn("before", F.lag("ord").over(order)).withColumn("run", F.sum(F.length("title")).over(order))
    holds = lambda w: F.contains(F.lower("title"), F.lit(w))
    status = F.when(holds("on") & F.col("before").isNotNull(), "hollow").when(holds("er"), "missing").otherwise("built")
    return rows.select(F.col("doc_id").alias("key"), "ord", "level", "title", "run", status.alias("status"), F.when(holds("on"), F.col("before")).alias("absorbed_by"))


@query("branch_losses", _NODES + """, e AS (SELECT a.*, coalesce((SELECT min(b.ord) FROM n b WHERE b.doc_id = a.doc_id AND b.ord > a.ord AND b.level <= a.level), 2147483647) AS stop FROM n a)
SELECT e.doc_id, e.ord, count(k.ord) AS children, count(k.ord) FILTER (k.status <> 'built') AS defective, list_sort(coalesce(list(DISTINCT k.absorbed_by) FILTER (k.status = 'hollow' AND k.absorbed_by IS NOT NULL), []))[1:3]::BIGINT[] AS absorbers,
  (SELECT coalesce(list(t.title ORDER BY t.ord), []) FROM n t WHERE t.doc_id = e.doc_id AND t.status = 'hollow' AND t.absorbed_by = e.ord) AS absorbed
FROM e LEFT JOIN n k ON k.doc_id = e.doc_id AND k.ord > e.ord AND k.ord < e.stop GROUP BY e.doc_id, e.ord""")
def branch_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each heading's branch lost and who took it."""
    found = branches.roll_up(outline(spark, sf_dir))
    return found.select(F.col("key").alias("doc_id"), "ord", "children", "defective", F.col("absorbers").cast("array<bigint>").alias("absorbers"), "absorbed")


_PAGES = _NODES + """, g AS (SELECT doc_id, ord, level, 2 + run // 400 AS page FROM n), s AS (SELECT doc_id, 3 + max(run) // 400 AS n_pages FROM n GROUP BY doc_id),
r0 AS (SELECT doc_id, ord, level, page, greatest(page, coalesce(lead(page) OVER w - 1, n_pages)) AS "end", CASE WHEN lead(level) OVER w > level THEN greatest(page, lead(page) OVER w - 1) END AS own FROM g JOIN s USING (doc_id) WINDOW w AS (PARTITION BY doc_id ORDER BY ord)),
r AS (SELECT doc_id, ord, level, page, "end", coalesce(own, "end") AS own_end FROM r0 UNION ALL SELECT doc_id, -1, arg_min(level, ord), 1, min(page) - 1, min(page) - 1 FROM r0 GROUP BY doc_id HAVING arg_min(page, ord) > 1)
"""


def pages_of(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = nodes.select("key", "ord", "level", "run", (2 + F.floor(F.col("run") / 400)).cast("bigint").alias("page"))
    return rows.drop("run"), rows.groupBy("key").agg((3 + F.floor(F.max("run") / 400)).cast("bigint").alias("n_pages"))


@query("outline_ranges", _PAGES + 'SELECT doc_id, ord, page::BIGINT AS page, "end"::BIGINT AS "end", own_end::BIGINT AS own_end FROM r')
def outline_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of each heading, with and without its children; pages before the first one are front matter."""
    return branches.page_ranges(*pages_of(outline(spark, sf_dir))).select(F.col("key").alias("doc_id"), "ord", "page", "end", "own_end")


@query("page_owners", _PAGES + """, p AS (SELECT doc_id, unnest(range(1, n_pages::BIGINT + 1)) AS page FROM s)
SELECT p.doc_id, p.page, coalesce(arg_max(r.ord, [r.level, r.ord]), (SELECT arg_max(q.ord, [-q.level, q.ord]) FROM r q WHERE q.doc_id = p.doc_id AND q.ord >= 0)) AS ord FROM p LEFT JOIN r ON r.doc_id = p.doc_id AND p.page BETWEEN r.page AND r.own_end GROUP BY p.doc_id, p.page""")
def page_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most specific heading of each page."""
    nodes, pages = pages_of(outline(spark, sf_dir))
    return branches.page_owners(branches.page_ranges(nodes, pages), pages).select(F.col("key").alias("doc_id"), F.col("page").cast("bigint").alias("page"), "ord")
