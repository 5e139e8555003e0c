"""Tables as markup: grids with spans, pipe text, cleaning, splits at the rows that name a part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import grids
from ..sources.shared import dealt
from ..sources.tables import read
from .catalog import query

#: Documents as tables: a row for each line, a cell for each of its sentences, the last one as wide as what is left;
#: lines in a row that begin alike share a first cell.
LINES = r"""
WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL),
l0 AS (SELECT doc_id, unnest(a) AS said, generate_subscripts(a, 1) AS ord FROM s),
l1 AS (SELECT doc_id, trim(regexp_replace(said, '[\x09-\x0D\x20]+', ' ', 'g')) AS said, ord FROM l0),
l AS (SELECT doc_id, said, row_number() OVER (PARTITION BY doc_id ORDER BY ord) - 1 AS line, left(said, 1) AS letter, string_split(said, '. ') AS parts FROM l1 WHERE said <> ''),
g AS (SELECT *, sum(CASE WHEN letter IS NOT DISTINCT FROM prev THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY line) AS run, max(len(parts)) OVER (PARTITION BY doc_id) AS width FROM (SELECT *, lag(letter) OVER (PARTITION BY doc_id ORDER BY line) AS prev FROM l)),
t AS (SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY line) AS nth, count(*) OVER (PARTITION BY doc_id, run) AS n_run FROM g)
"""
_CELLS = LINES + r""", c AS (
SELECT doc_id, line, 0 AS col, n_run AS rowspan, 1 AS colspan, letter AS said FROM t WHERE nth = 1
UNION ALL SELECT doc_id, line, k AS col, 1, CASE WHEN k = len(parts) THEN least(1000, width - k + 1) ELSE 1 END, trim(parts[k]) FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS k FROM t))
"""


def shaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, line, said, parts, nth, n_run, width)``: the lines of documents as rows of a table."""
    docs = dealt(read(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text"), "doc_id", "text")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "said"))
    lines = lines.withColumn("said", F.trim(F.regexp_replace("said", r"[\x09-\x0D\x20]+", " "))).where("said <> ''")
    doc = Window.partitionBy("doc_id").orderBy("ord")
    lines = lines.select("doc_id", "said", (F.row_number().over(doc) - 1).alias("line"), F.substring("said", 1, 1).alias("letter"), F.split("said", r"\. ").alias("parts"))
    by = Window.partitionBy("doc_id").orderBy("line")
    new = F.when(F.col("letter").eqNullSafe(F.lag("letter").over(by)), 0).otherwise(1)
    lines = lines.withColumn("new", new).withColumn("run", F.sum("new").over(by)).withColumn("width", F.max(F.size("parts")).over(Window.partitionBy("doc_id")))
    run = Window.partitionBy("doc_id", "run")
    return lines.withColumn("nth", F.row_number().over(run.orderBy("line"))).withColumn("n_run", F.count("*").over(run))


def escaped(text):
    for char, name in (("&", "amp"), ("<", "lt"), (">", "gt"), ('"', "quot")):
        text = F.replace(text, F.lit(char), F.lit(f"&{name};"))
    return text


def html(spark: SparkSession, sf_dir: str, below: int | None = None) -> DataFrame:
    """``(doc_id, html)``: documents as tables in markup, all of them or those of less than ``below`` columns."""
    rows = shaped(spark, sf_dir)
    if below is not None:
        rows = rows.where(F.col("width") < below)
    shared = F.when(F.col("nth") == 1, F.concat(F.lit('<th rowspan="'), F.col("n_run").cast("string"), F.lit('">'), escaped(F.col("letter")), F.lit("</th>"))).otherwise("")
    cell = lambda x, k: F.concat(F.when(k == F.size("parts") - 1, F.concat(F.lit('<td colspan="'), (F.col("width") - k).cast("string"), F.lit('">'))).otherwise("<td>"), escaped(x), F.lit("</td>"))
    rows = rows.select("doc_id", "line", F.concat(F.lit("<tr>"), shared, F.array_join(F.transform("parts", cell), ""), F.lit("</tr>")).alias("tr"))
    out = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("line", "tr"))).alias("rows"))
    return out.select("doc_id", F.concat(F.lit("<table>"), F.array_join(F.transform("rows", lambda r: r["tr"]), "\n"), F.lit("</table>")).alias("html"))


@query("table_grid", _CELLS + "SELECT doc_id, line, col::INTEGER AS col, rowspan::INTEGER AS rowspan, colspan::INTEGER AS colspan, said FROM c")
def table_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the tables in markup with their places in the grid; whole documents go into markup and come back."""
    grid = grids.placed(grids.cells(html(spark, sf_dir), "doc_id", "html"))
    return grid.select(F.col("key").alias("doc_id"), "line", "col", "rowspan", "colspan", "said")


@query("table_pipes", _CELLS + r""", w AS (SELECT doc_id, max(col + colspan) AS n_cols, max(line) AS last FROM c GROUP BY doc_id HAVING max(line) > 0),
f AS (SELECT doc_id, line, string_agg(replace(said, '|', '\|') || repeat(' | ', (colspan - 1)::INTEGER), ' | ' ORDER BY col) AS said, max(col + colspan) AS n, min(col) AS first FROM c GROUP BY doc_id, line),
p AS (SELECT doc_id, line, '| ' || CASE WHEN first = 1 THEN ' | ' ELSE '' END || said || repeat(' | ', (n_cols - n)::INTEGER) || ' |' AS said, n_cols FROM f JOIN w USING (doc_id))
SELECT doc_id, string_agg(said || CASE WHEN line = 0 THEN chr(10) || '| ' || repeat('--- | ', (n_cols - 1)::INTEGER) || '--- |' ELSE '' END, chr(10) ORDER BY line) AS said FROM p GROUP BY doc_id""")
def table_pipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tables as pipe text, a span's further slots empty."""
    grid = grids.placed(grids.cells(html(spark, sf_dir), "doc_id", "html"))
    return grids.pipe_text(grids.slots(grid)).select(F.col("key").alias("doc_id"), "said")


@query("table_cleaned", LINES + r""", p AS (SELECT doc_id, line, unnest(range(1, width + 1)) AS col, parts, letter FROM t WHERE width < 1000),
x AS (SELECT doc_id, line, 0 AS col, letter AS said FROM t WHERE width < 1000 UNION ALL SELECT doc_id, line, col, trim(parts[least(col, len(parts))]) FROM p),
y AS (SELECT doc_id, line, col, CASE WHEN lag(said) OVER (PARTITION BY doc_id, line ORDER BY col) = said THEN '' ELSE said END AS said FROM x),
z AS (SELECT *, bool_or(said <> '') OVER (PARTITION BY doc_id, line) AS l, bool_or(said <> '') OVER (PARTITION BY doc_id, col) AS k FROM y),
n AS (SELECT doc_id, dense_rank() OVER (PARTITION BY doc_id ORDER BY line) - 1 AS line, dense_rank() OVER (PARTITION BY doc_id ORDER BY col) - 1 AS col, said FROM z WHERE l AND k)
SELECT doc_id, line::INTEGER AS line, col::INTEGER AS col, said FROM n WHERE said <> ''""")
def table_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots with each span's text repeated, then cleaned of the repeats and of what is empty; tables below HTML's limit of columns."""
    grid = grids.placed(grids.cells(html(spark, sf_dir, 1000), "doc_id", "html"))
    return grids.cleaned(grids.slots(grid, repeat=True)).where("said <> ''").select(F.col("key").alias("doc_id"), "line", "col", "said")


#: Lines of one sentence name the part that follows them: they take the next number of the document.
_PARTS = LINES + r""", q AS (SELECT doc_id, line, said, len(parts) = 1 AS names, parts,
  sum(CASE WHEN len(parts) = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line) AS part, bool_or(len(parts) = 1) OVER (PARTITION BY doc_id) AS has FROM t)
"""


def parted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, html)``: tables whose rows of one sentence are numbered and name the rows after them."""
    rows = shaped(spark, sf_dir).withColumn("names", F.size("parts") == 1)
    part = F.count_if("names").over(Window.partitionBy("doc_id").orderBy("line"))
    number = F.when(F.col("names"), F.concat(F.lit("3."), part.cast("string"), F.lit(" "))).otherwise("")
    cells = F.array_join(F.transform("parts", lambda x: F.concat(F.lit("<td>"), escaped(x), F.lit("</td>"))), "")
    named = F.concat(F.lit('<td colspan="2">'), number, escaped(F.col("said")), F.lit("</td>"))
    rows = rows.select("doc_id", "line", F.concat(F.lit("<tr>"), F.when(F.col("names"), named).otherwise(cells), F.lit("</tr>")).alias("tr"))
    out = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("line", "tr"))).alias("rows"))
    return out.select("doc_id", F.concat(F.lit("<table>"), F.array_join(F.transform("rows", lambda r: r["tr"]), ""), F.lit("</table>")).alias("html"))


@query("table_parts", _PARTS + "SELECT doc_id, greatest(part, 1)::BIGINT AS part, '3.' || greatest(part, 1) AS id, max(CASE WHEN names THEN said END) AS title, count(*) FILTER (NOT names)::INTEGER AS n_rows, sum(CASE WHEN names THEN 0 ELSE len(parts) END)::BIGINT AS n_cells FROM q WHERE has GROUP BY doc_id, greatest(part, 1)")
def table_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables split at the rows that name a part, rows above the first one with it."""
    found = grids.split_tables(parted(spark, sf_dir), "doc_id", "html")
    return found.select(F.col("key").alias("doc_id"), "part", "id", "title", "n_rows", F.regexp_count("said", F.lit("<td")).cast("bigint").alias("n_cells"))


@query("table_split_verified", _PARTS + "SELECT doc_id, true AS ok, 'ok' AS reason FROM q WHERE has GROUP BY doc_id")
def table_split_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each split parsed anew and held against the table: no row lost, repeated, reworded or moved."""
    rows = parted(spark, sf_dir)
    return grids.verify_split(rows, "doc_id", "html", grids.split_tables(rows, "doc_id", "html")).select(F.col("key").alias("doc_id"), "ok", "reason")
