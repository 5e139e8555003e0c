"""Blocks, tables, findings, publication and entity records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.tables import read
from .catalog import query

#: Layout blocks, made from line items: a page, a height on it, a box, a kind.
_BLOCKS = """
WITH b AS (SELECT o_orderkey AS ord, o_custkey AS doc, CAST(o_orderkey % 9 AS INTEGER) AS page, CAST(o_orderkey * 37 % 1000 AS DOUBLE) AS y0, CAST(o_orderkey * 53 % 700 AS DOUBLE) AS x0,
  CASE o_orderkey % 5 WHEN 0 THEN 'heading' WHEN 1 THEN 'list' WHEN 2 THEN 'table' ELSE 'text' END AS kind, o_orderpriority AS said FROM orders)
"""


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    kind = F.when(k % 5 == 0, "heading").when(k % 5 == 1, "list").when(k % 5 == 2, "table").otherwise("text")
    return read(spark, sf_dir, "orders").select(k.alias("ord"), F.col("o_custkey").alias("doc"), (k % 9).cast("int").alias("page"), (k * 37 % 1000).cast("double").alias("y0"), (k * 53 % 700).cast("double").alias("x0"), kind.alias("kind"), F.col("o_orderpriority").alias("said"))


@query("page_texts", _BLOCKS + "SELECT doc, page, string_agg(said, ' ' ORDER BY y0, ord) AS said, count(*) AS n FROM b GROUP BY doc, page")
def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of a page from top to bottom as one text."""
    rows = blocks(spark, sf_dir).groupBy("doc", "page").agg(F.array_sort(F.collect_list(F.struct("y0", "ord", "said"))).alias("b"), F.count("*").alias("n"))
    return rows.select("doc", "page", F.array_join(F.transform("b", lambda x: x["said"]), " ").alias("said"), "n")


@query("render_blocks", _BLOCKS + "SELECT doc, string_agg(CASE kind WHEN 'heading' THEN '## ' || said WHEN 'list' THEN '- ' || said WHEN 'table' THEN '| ' || said || ' |' ELSE said END, chr(10) ORDER BY page, y0, ord) AS markdown FROM b GROUP BY doc")
def render_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks in reading order as markdown."""
    kind, said = F.col("kind"), F.col("said")
    line = F.when(kind == "heading", F.concat(F.lit("## "), said)).when(kind == "list", F.concat(F.lit("- "), said)).when(kind == "table", F.concat(F.lit("| "), said, F.lit(" |"))).otherwise(said)
    rows = blocks(spark, sf_dir).groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("page", "y0", "ord", line.alias("line")))).alias("b"))
    return rows.select("doc", F.array_join(F.transform("b", lambda x: x["line"]), "\n").alias("markdown"))


@query("expand_list_blocks", _BLOCKS + ", l AS (SELECT ord, doc, y0, string_split(said, '-') AS items FROM b WHERE kind = 'list') SELECT ord, doc, CAST(i - 1 AS INTEGER) AS i, items[i] AS item, round(y0 + (i - 1) * 40.0 / len(items), 4) AS top FROM l, range(1, 10) r(i) WHERE i <= len(items)")
def expand_list_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List items as blocks of their own, the list's box cut into bands."""
    rows = blocks(spark, sf_dir).where("kind = 'list'").withColumn("items", F.split("said", "-"))
    rows = rows.select("ord", "doc", "y0", F.size("items").alias("n"), F.posexplode("items").alias("i", "item"))
    return rows.select("ord", "doc", "i", "item", F.round(F.col("y0") + F.col("i") * 40.0 / F.col("n"), 4).alias("top"))


@query("repeating_headers", _BLOCKS + "SELECT doc, said, count(DISTINCT page) AS n_pages FROM b WHERE kind IN ('heading', 'text') AND length(said) < 40 GROUP BY doc, said HAVING count(DISTINCT page) >= 3")
def repeating_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short texts on three pages or more are furniture."""
    rows = blocks(spark, sf_dir).where("kind in ('heading', 'text') and length(said) < 40")
    return rows.groupBy("doc", "said").agg(F.count_distinct("page").alias("n_pages")).where("n_pages >= 3")


@query("reading_order_owner", _BLOCKS + ", o AS (SELECT *, max(CASE WHEN kind = 'heading' THEN (page, y0, ord) END) OVER (PARTITION BY doc ORDER BY page, y0, ord ROWS UNBOUNDED PRECEDING) AS h FROM b) SELECT doc, ord, h[3] AS owner FROM o WHERE kind <> 'heading'")
def reading_order_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The heading that owns each block, by page and height."""
    w = Window.partitionBy("doc").orderBy("page", "y0", "ord").rowsBetween(Window.unboundedPreceding, 0)
    owner = F.last(F.when(F.col("kind") == "heading", F.col("ord")), ignorenulls=True).over(w)
    return blocks(spark, sf_dir).withColumn("owner", owner).where("kind <> 'heading'").select("doc", "ord", "owner")


@query("box_overlap", _BLOCKS + """, p AS (SELECT a.doc, a.ord AS a, b.ord AS b, greatest(0, least(a.x0, b.x0) + 300 - greatest(a.x0, b.x0)) * greatest(0, least(a.y0, b.y0) + 200 - greatest(a.y0, b.y0)) AS i FROM b a JOIN b ON a.doc = b.doc AND a.page = b.page AND a.kind = 'table' AND b.kind <> 'table')
SELECT doc, a, b, round(i / (120000 - i), 6) AS iou FROM p WHERE i / (120000 - i) >= 0.1 QUALIFY row_number() OVER (PARTITION BY a ORDER BY i DESC, b) = 1
""")
def box_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The block that overlaps each table's box most, on the same page."""
    rows = blocks(spark, sf_dir)
    a = rows.where("kind = 'table'").select("doc", "page", F.col("ord").alias("a"), F.col("x0").alias("ax"), F.col("y0").alias("ay"))
    b = rows.where("kind <> 'table'").select("doc", "page", F.col("ord").alias("b"), F.col("x0").alias("bx"), F.col("y0").alias("by"))
    side = lambda p, q, n: F.greatest(F.lit(0.0), F.least(p, q) + n - F.greatest(p, q))
    inter = side("ax", "bx", 300.0) * side("ay", "by", 200.0)
    pairs = a.join(b, ["doc", "page"]).withColumn("i", inter).where("i / (120000 - i) >= 0.1")
    best = F.row_number().over(Window.partitionBy("a").orderBy(F.col("i").desc(), "b"))
    return pairs.withColumn("r", best).where("r = 1").select("doc", "a", "b", F.round(F.col("i") / (120000 - F.col("i")), 6).alias("iou"))


@query("column_gutters", _BLOCKS + """, s AS (SELECT doc, x0 AS lo, x0 + 30 AS hi, max(x0 + 30) OVER (PARTITION BY doc ORDER BY x0, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM b)
SELECT doc, reach AS gap_from, lo AS gap_to FROM s WHERE lo - reach >= 12
""")
def column_gutters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stripes of a page that no text covers, wide enough to part columns."""
    w = Window.partitionBy("doc").orderBy("x0", "ord").rowsBetween(Window.unboundedPreceding, -1)
    rows = blocks(spark, sf_dir).withColumn("reach", F.max(F.col("x0") + 30).over(w))
    return rows.where("x0 - reach >= 12").select("doc", F.col("reach").alias("gap_from"), F.col("x0").alias("gap_to"))


@query("style_runs", _BLOCKS + ", c AS (SELECT *, CASE WHEN kind = lag(kind) OVER (PARTITION BY doc ORDER BY ord) THEN 0 ELSE 1 END AS new FROM b), r AS (SELECT *, sum(new) OVER (PARTITION BY doc ORDER BY ord ROWS UNBOUNDED PRECEDING) AS run FROM c) SELECT doc, min(ord) AS first, any_value(kind) AS kind, count(*) AS n, string_agg(said, '' ORDER BY ord) AS said FROM r GROUP BY doc, run")
def style_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours of one style merged into runs."""
    w = Window.partitionBy("doc").orderBy("ord")
    new = F.when(F.col("kind") == F.lag("kind").over(w), 0).otherwise(1)
    rows = blocks(spark, sf_dir).withColumn("new", new).withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = rows.groupBy("doc", "run", "kind").agg(F.min("ord").alias("first"), F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("ord", "said"))).alias("s"))
    return out.select("doc", "first", "kind", "n", F.array_join(F.transform("s", lambda x: x["said"]), "").alias("said"))


#: Table markup, rendered from orders; the later version joins two cells of some rows.
_HTML = """
WITH c AS (SELECT o_custkey AS tbl, o_orderkey AS ord, '<tr><td>' || o_orderstatus || '</td><td colspan="' || (1 + o_orderkey % 2) || '">' || CAST(floor(o_totalprice) AS BIGINT) || '</td><td>' || o_orderpriority || '</td></tr>' AS tr,
  CASE WHEN o_orderkey % 11 = 0 THEN '<tr><td>' || o_orderstatus || CAST(floor(o_totalprice) AS BIGINT) || '</td><td colspan="2">' || o_orderpriority || '</td></tr>' END AS merged FROM orders),
h AS (SELECT tbl, string_agg(tr, '' ORDER BY ord) AS before, string_agg(coalesce(merged, tr), '' ORDER BY ord) AS after FROM c GROUP BY tbl)
"""


def markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s, p = F.col("o_orderkey"), F.col("o_orderstatus"), F.floor("o_totalprice").cast("string")
    tr = F.concat(F.lit("<tr><td>"), s, F.lit('</td><td colspan="'), (1 + k % 2).cast("string"), F.lit('">'), p, F.lit("</td><td>"), "o_orderpriority", F.lit("</td></tr>"))
    merged = F.concat(F.lit("<tr><td>"), s, p, F.lit('</td><td colspan="2">'), "o_orderpriority", F.lit("</td></tr>"))
    rows = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("tbl"), k.alias("ord"), tr.alias("a"), F.when(k % 11 == 0, merged).otherwise(tr).alias("b"))
    both = rows.groupBy("tbl").agg(F.array_sort(F.collect_list(F.struct("ord", "a", "b"))).alias("r"))
    return both.select("tbl", F.array_join(F.transform("r", lambda x: x["a"]), "").alias("before"), F.array_join(F.transform("r", lambda x: x["b"]), "").alias("after"))


_CS = "regexp_replace(lower(regexp_replace({x}, '<[^>]*>', ' ', 'g')), '[^0-9a-z]+', '', 'g')"


@query("edit_verdict", _HTML + f"SELECT tbl, CASE WHEN before = after THEN 'clean' WHEN {_CS.format(x='before')} <> {_CS.format(x='after')} THEN 'reject' WHEN list_sort(list_distinct(regexp_extract_all(lower(before), '<([a-z][a-z0-9]*)', 1))) = list_sort(list_distinct(regexp_extract_all(lower(after), '<([a-z][a-z0-9]*)', 1))) THEN 'spacing' ELSE 'structural' END AS verdict FROM h")
def edit_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is an edited table still the same table? Ordered tests."""
    a, b = F.col("before"), F.col("after")
    verdict = F.when(a == b, "clean").when(T.content_stream(a) != T.content_stream(b), "reject").when(T.markup_signature(a) == T.markup_signature(b), "spacing").otherwise("structural")
    return markup(spark, sf_dir).select("tbl", verdict.alias("verdict"))


@query("table_widths", _HTML + ", r AS (SELECT tbl, unnest(regexp_extract_all(after, '<tr>.*?</tr>')) AS tr FROM h), w AS (SELECT tbl, len(regexp_extract_all(tr, '<td')) + list_sum(list_transform(regexp_extract_all(tr, 'colspan=\"([0-9]+)\"', 1), lambda x: CAST(x AS BIGINT) - 1)) AS width FROM r) SELECT tbl, count(*) AS n_rows, CAST(max(width) AS BIGINT) AS width, count(DISTINCT width) AS n_widths FROM w GROUP BY tbl")
def table_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a table and their logical widths, spans counted."""
    rows = markup(spark, sf_dir).select("tbl", F.explode(F.regexp_extract_all("after", F.lit("(<tr>.*?</tr>)"), 1)).alias("tr"))
    spans = F.regexp_extract_all("tr", F.lit('colspan="([0-9]+)"'), 1)
    width = F.regexp_count("tr", F.lit("<td")).cast("bigint") + F.aggregate(F.transform(spans, lambda x: x.cast("bigint") - 1), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return rows.withColumn("w", width).groupBy("tbl").agg(F.count("*").alias("n_rows"), F.max("w").alias("width"), F.count_distinct("w").alias("n_widths"))


@query("cell_presence", _HTML + ", a AS (SELECT tbl, unnest(regexp_extract_all(before, '<td[^>]*>([^<]*)</td>', 1)) AS cell FROM h), b AS (SELECT DISTINCT tbl, unnest(regexp_extract_all(after, '<td[^>]*>([^<]*)</td>', 1)) AS cell, 1 AS there FROM h) SELECT tbl, count(*) AS n_cells, count(there) AS n_present, round(100.0::DOUBLE - 12 * (count(*) - count(there)), 4) AS score FROM a LEFT JOIN b USING (tbl, cell) GROUP BY tbl")
def cell_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of a table that a later stage still has."""
    cells = lambda c: F.explode(F.regexp_extract_all(c, F.lit("<td[^>]*>([^<]*)</td>"), 1)).alias("cell")
    h = markup(spark, sf_dir)
    b = h.select("tbl", cells("after")).distinct().withColumn("there", F.lit(1))
    out = h.select("tbl", cells("before")).join(b, ["tbl", "cell"], "left").groupBy("tbl").agg(F.count("*").alias("n_cells"), F.count("there").alias("n_present"))
    return out.withColumn("score", F.round(100.0 - 12 * (F.col("n_cells") - F.col("n_present")), 4))


@query("grid_slots", _HTML + ", r AS (SELECT tbl, unnest(regexp_extract_all(before, '<tr>.*?</tr>')) AS tr FROM h), d AS (SELECT tbl, unnest(regexp_extract_all(tr, '<td[^>]*>[^<]*</td>')) AS td FROM r), s AS (SELECT tbl, coalesce(nullif(regexp_extract(td, 'colspan=\"([0-9]+)\"', 1), ''), '1')::BIGINT AS span, regexp_extract(td, '>([^<]*)<', 1) AS said FROM d) SELECT tbl, said, CAST(sum(span) AS BIGINT) AS n_slots FROM s GROUP BY tbl, said")
def grid_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid slots that each cell text fills, spans expanded."""
    cells = markup(spark, sf_dir).select("tbl", F.explode(F.regexp_extract_all("before", F.lit("(<td[^>]*>[^<]*</td>)"), 1)).alias("td"))
    span = F.coalesce(F.nullif(F.regexp_extract("td", 'colspan="([0-9]+)"', 1), F.lit("")), F.lit("1")).cast("int")
    slots = cells.select("tbl", F.regexp_extract("td", ">([^<]*)<", 1).alias("said"), F.explode(F.sequence(F.lit(1), span)).alias("slot"))
    return slots.groupBy("tbl", "said").agg(F.count("*").alias("n_slots"))


@query("empty_answer_runs", "WITH t AS (SELECT page_id, regexp_replace(html, '[.] ', '<br><br><br>', 'g') AS h FROM pages), r AS (SELECT page_id, unnest(regexp_extract_all(h, '(?:<br>)+')) AS run FROM t) SELECT page_id, CAST(sum(greatest(0, length(run) // 4 // 2 - 1)) AS BIGINT) AS n_empty, count(*) AS n_runs FROM r GROUP BY page_id")
def empty_answer_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers left empty between line breaks."""
    runs = read(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all(F.regexp_replace("html", "[.] ", "<br><br><br>"), F.lit("((?:<br>)+)"), 1)).alias("run"))
    n = F.greatest(F.lit(0), F.floor(F.floor(F.length("run") / 4) / 2) - 1)
    return runs.groupBy("page_id").agg(F.sum(n).cast("bigint").alias("n_empty"), F.count("*").alias("n_runs"))


#: Findings from events: a key, a kind, a severity, sometimes dismissed.
_FOUND = "WITH f AS (SELECT event_id, user_id AS file, event_type AS kind, 'f' || (event_id % 700) AS key, round(value, 1) AS severity, event_id % 9 = 0 AS dismissed FROM events)\n"


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("file"), F.col("event_type").alias("kind"), F.concat(F.lit("f"), (F.col("event_id") % 700).cast("string")).alias("key"), F.round("value", 1).alias("severity"), (F.col("event_id") % 9 == 0).alias("dismissed"))


@query("finding_dedupe", _FOUND + "SELECT key, arg_max(event_id, (severity, -event_id)) AS event_id, max(severity) AS severity, count(*) AS n_seen, CASE WHEN bool_or(dismissed) THEN 0.0::DOUBLE ELSE max(severity) END AS charge FROM f GROUP BY key")
def finding_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each finding once, the gravest; dismissed ones stay listed but cost nothing."""
    charge = F.when(F.bool_or("dismissed"), 0.0).otherwise(F.max("severity"))
    return found(spark, sf_dir).groupBy("key").agg(F.max_by("event_id", F.struct("severity", -F.col("event_id"))).alias("event_id"), F.max("severity").alias("severity"), F.count("*").alias("n_seen"), charge.alias("charge"))


@query("symptoms_absorbed", _FOUND + "SELECT kind, count(*) AS n FROM f WHERE NOT (kind = 'click' AND file IN (SELECT file FROM f WHERE kind = 'error' AND severity > 40)) GROUP BY kind")
def symptoms_absorbed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symptoms go where their cause is listed."""
    f = found(spark, sf_dir)
    cause = f.where("kind = 'error' and severity > 40").select("file").distinct()
    kept = f.where("kind <> 'click'").unionByName(f.where("kind = 'click'").join(cause, "file", "left_anti"))
    return kept.groupBy("kind").agg(F.count("*").alias("n"))


@query("finding_tally", _FOUND + "SELECT kind, count(*) AS n, count(*) FILTER (dismissed) AS n_dismissed, round(avg(severity), 6) AS mean FROM f GROUP BY kind")
def finding_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings by kind."""
    return found(spark, sf_dir).groupBy("kind").agg(F.count("*").alias("n"), F.count_if("dismissed").alias("n_dismissed"), F.round(F.avg("severity"), 6).alias("mean"))


@query("effective_gate", "SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'pass' WHEN o_orderkey % 17 = 0 THEN 'fail' ELSE CASE WHEN o_totalprice >= 300000 THEN 'pass' WHEN o_totalprice >= 100000 THEN 'review' ELSE 'fail' END END AS gate, o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 AS overridden FROM orders")
def effective_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reviewer's word over the computed gate."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    k, p = F.col("o_orderkey"), F.col("o_totalprice")
    reviews = orders.where("o_orderkey % 13 = 0 or o_orderkey % 17 = 0").select("o_orderkey", F.when(k % 13 == 0, "pass").otherwise("fail").alias("said"))
    own = F.when(p >= 300000, "pass").when(p >= 100000, "review").otherwise("fail")
    return orders.join(reviews, "o_orderkey", "left").select("o_orderkey", F.coalesce("said", own).alias("gate"), F.col("said").isNotNull().alias("overridden"))


@query("baseline_compare", """
WITH m AS (SELECT event_type AS metric, round(avg(value) FILTER (event_id % 2 = 0), 6) AS before, round(avg(value) FILTER (event_id % 2 = 1), 6) AS after FROM events GROUP BY 1)
SELECT metric, before, after, round(after - before, 6) AS delta, CASE WHEN abs(after - before) < 0.5 THEN 'same' WHEN (after > before) = (metric <> 'error') THEN 'better' ELSE 'worse' END AS trend FROM m
""")
def baseline_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics against a baseline; for some less is better."""
    e = read(spark, sf_dir, "events")
    half = lambda r: F.round(F.avg(F.when(F.col("event_id") % 2 == r, F.col("value"))), 6)
    m = e.groupBy(F.col("event_type").alias("metric")).agg(half(0).alias("before"), half(1).alias("after"))
    trend = F.when(F.abs(F.col("after") - F.col("before")) < 0.5, "same").when((F.col("after") > F.col("before")) == (F.col("metric") != "error"), "better").otherwise("worse")
    return m.select("metric", "before", "after", F.round(F.col("after") - F.col("before"), 6).alias("delta"), trend.alias("trend"))


@query("timing_block", "SELECT user_id % 20 AS job, round(sum(value), 4) AS total, round(coalesce(sum(value) FILTER (event_type = 'error'), 0), 4) AS fallback, round(sum(value) / count(*), 6) AS per_page, arg_max(event_type, value * 1000000 + event_id) AS slowest FROM events GROUP BY 1")
def timing_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a job's time went."""
    e = read(spark, sf_dir, "events")
    part = F.coalesce(F.sum(F.when(F.col("event_type") == "error", F.col("value"))), F.lit(0.0))
    return e.groupBy((F.col("user_id") % 20).alias("job")).agg(F.round(F.sum("value"), 4).alias("total"), F.round(part, 4).alias("fallback"), F.round(F.sum("value") / F.count("*"), 6).alias("per_page"), F.max_by("event_type", F.col("value") * 1000000 + F.col("event_id")).alias("slowest"))


@query("cost_estimate", "SELECT event_type AS model, count(*) AS n_calls, round(sum(value * 3.0 + length(props) * 15.0) / 1000000, 8) AS usd FROM events GROUP BY 1")
def cost_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens times configured prices."""
    return read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("model")).agg(F.count("*").alias("n_calls"), F.round(F.sum(F.col("value") * 3.0 + F.length("props") * 15.0) / 1000000, 8).alias("usd"))


@query("props_flatten", "SELECT event_id, 'props.k' AS path, regexp_extract(props, ': ([0-9]+)', 1) AS value FROM events UNION ALL SELECT event_id, 'type', event_type FROM events")
def props_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested fields as dotted paths."""
    e = read(spark, sf_dir, "events").withColumn("m", F.from_json("props", "map<string,string>"))
    inner = e.select("event_id", F.explode("m").alias("k", "value")).select("event_id", F.concat(F.lit("props."), "k").alias("path"), "value")
    return inner.unionByName(e.select("event_id", F.lit("type").alias("path"), F.col("event_type").alias("value")))


@query("alias_resolution", """
WITH canon AS (SELECT n_name AS name FROM nation), a AS (SELECT s_suppkey, unnest(string_split('NATION_' || (s_suppkey % 30) || ',nation_1,X' || (s_suppkey % 3), ',')) AS said FROM supplier)
SELECT s_suppkey, coalesce(list_sort(list(DISTINCT name) FILTER (name IS NOT NULL)), []) AS names, count(DISTINCT said) FILTER (name IS NULL) AS n_unknown FROM a LEFT JOIN canon ON upper(said) = name GROUP BY s_suppkey
""")
def alias_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma-separated names resolved to canonical ones."""
    canon = read(spark, sf_dir, "nation").select(F.col("n_name").alias("name"))
    k = F.col("s_suppkey")
    said = F.split(F.concat(F.lit("NATION_"), (k % 30).cast("string"), F.lit(",nation_1,X"), (k % 3).cast("string")), ",")
    rows = read(spark, sf_dir, "supplier").select("s_suppkey", F.explode(said).alias("said")).join(canon, F.upper("said") == F.col("name"), "left")
    names = F.array_sort(F.collect_set("name"))
    return rows.groupBy("s_suppkey").agg(names.alias("names"), F.count_distinct(F.when(F.col("name").isNull(), F.col("said"))).alias("n_unknown"))


@query("agnostic_filter", "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN [] WHEN 1 THEN ['en', 'fr'] WHEN 2 THEN ['de'] ELSE ['es', 'fr'] END AS places FROM customer WHERE c_custkey % 4 <> 2")
def agnostic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the asked places, and those that name none."""
    k = F.col("c_custkey")
    places = F.when(k % 4 == 0, F.array().cast("array<string>")).when(k % 4 == 1, F.array(F.lit("en"), F.lit("fr"))).when(k % 4 == 2, F.array(F.lit("de"))).otherwise(F.array(F.lit("es"), F.lit("fr")))
    rows = read(spark, sf_dir, "customer").select("c_custkey", places.alias("places"))
    return rows.where((F.size("places") == 0) | F.arrays_overlap("places", F.array(F.lit("fr"), F.lit("en"))))


@query("unique_title_join", """
WITH t AS (SELECT p_size AS scope, regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g') AS title, min(p_partkey) AS key FROM part GROUP BY ALL HAVING count(*) = 1), q AS (SELECT s_suppkey, CAST(s_suppkey % 50 AS INTEGER) AS scope, (SELECT regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g') FROM part WHERE p_partkey = s_suppkey) AS title FROM supplier)
SELECT s_suppkey, key FROM q LEFT JOIN t USING (scope, title)
""")
def unique_title_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A title within its scope, accepted only if just one row has it."""
    part = read(spark, sf_dir, "part")
    norm = F.regexp_replace(F.lower("p_name"), "[^a-z0-9]+", "").alias("title")
    t = part.groupBy(F.col("p_size").alias("scope"), norm).agg(F.count("*").alias("n"), F.min("p_partkey").alias("key")).where("n = 1").drop("n")
    asked = read(spark, sf_dir, "supplier").join(part, F.col("p_partkey") == F.col("s_suppkey")).select("s_suppkey", (F.col("s_suppkey") % 50).cast("int").alias("scope"), norm)
    return asked.join(t, ["scope", "title"], "left").select("s_suppkey", "key")


@query("guidance_cascade", """
WITH g AS (SELECT c_custkey AS id FROM customer), e AS (SELECT id FROM g WHERE id % 5 = 0), s AS (SELECT id FROM g WHERE id % 3 = 0 AND id NOT IN (SELECT id FROM e)), m AS (SELECT id FROM g WHERE id % 2 = 0 AND id NOT IN (SELECT id FROM e) AND id NOT IN (SELECT id FROM s))
SELECT id, 'explicit' AS via FROM e UNION ALL SELECT id, 'structural' FROM s UNION ALL SELECT id, 'semantic' FROM m UNION ALL SELECT id, 'standalone' FROM g WHERE id NOT IN (SELECT id FROM e UNION SELECT id FROM s UNION SELECT id FROM m)
""")
def guidance_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each entry once, by the first way that places it."""
    rest = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    out = None
    for via, test in (("explicit", "id % 5 = 0"), ("structural", "id % 3 = 0"), ("semantic", "id % 2 = 0"), ("standalone", "true")):
        mine = rest.where(test)
        part = mine.withColumn("via", F.lit(via))
        out = part if out is None else out.unionByName(part)
        rest = rest.join(mine, "id", "left_anti")
    return out


@query("alert_rows", "SELECT 'ALERT:' || o_orderkey AS key, o_orderpriority AS said FROM orders UNION ALL SELECT 'ALERT:' || o_orderkey || '#a' || (i - 1), string_split(o_orderpriority, '-')[i] FROM orders, range(1, 4) r(i) WHERE i <= len(string_split(o_orderpriority, '-'))")
def alert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary row for each alert and one for each part of its attachment."""
    a = read(spark, sf_dir, "orders").select(F.concat(F.lit("ALERT:"), F.col("o_orderkey").cast("string")).alias("key"), F.col("o_orderpriority").alias("said"))
    parts = a.select("key", F.posexplode(F.split("said", "-")).alias("i", "part"))
    return a.unionByName(parts.select(F.concat("key", F.lit("#a"), F.col("i").cast("string")).alias("key"), F.col("part").alias("said")))


@query("citation_repair", """
WITH have AS (SELECT DISTINCT 'A' || (o_orderkey % 40) || '.' || (o_orderkey % 7) AS key FROM orders), q AS (SELECT DISTINCT 'A' || (o_orderkey % 50) || '.' || (o_orderkey % 7) || '(' || chr(CAST(97 + o_orderkey % 3 AS INTEGER)) || ')' AS cited FROM orders)
SELECT cited, have.key AS repaired FROM q LEFT JOIN have ON have.key = regexp_replace(cited, '\\([a-z]\\)$', '')
""")
def citation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest existing key of a citation, brackets stripped."""
    k = F.col("o_orderkey")
    stem = lambda n: F.concat(F.lit("A"), (k % n).cast("string"), F.lit("."), (k % 7).cast("string"))
    orders = read(spark, sf_dir, "orders")
    have = orders.select(stem(40).alias("repaired")).distinct()
    cited = orders.select(F.concat(stem(50), F.lit("("), F.char((97 + k % 3).cast("int")), F.lit(")")).alias("cited")).distinct()
    return cited.join(have, T.parent_key(F.col("cited")) == F.col("repaired"), "left")


@query("index_rows", "SELECT n_name AS region, 'C:' || c_custkey AS key, left(c_name, 10) AS title, 'clause' AS kind FROM customer JOIN nation ON n_nationkey = c_nationkey UNION ALL SELECT n_name, 'G:' || s_suppkey, left(s_name, 10), 'guidance' FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clause and guidance rows of one index, titles capped."""
    nation = read(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("region"))
    row = lambda df, on, p, key, title, kind: df.join(nation, F.col(on) == F.col("n_nationkey")).select("region", F.concat(F.lit(p), F.col(key).cast("string")).alias("key"), F.substring(title, 1, 10).alias("title"), F.lit(kind).alias("kind"))
    return row(read(spark, sf_dir, "customer"), "c_nationkey", "C:", "c_custkey", "c_name", "clause").unionByName(row(read(spark, sf_dir, "supplier"), "s_nationkey", "G:", "s_suppkey", "s_name", "guidance"))


@query("promotion_plan", """
WITH d AS (SELECT doc_id, source AS product, n_chars, doc_id % 5 <> 0 AS has_card, doc_id % 7 <> 0 AS has_view, CASE WHEN n_chars % 100 >= 60 THEN 'pass' WHEN n_chars % 100 >= 20 THEN 'review' ELSE 'fail' END AS gate FROM documents)
SELECT product, CASE WHEN NOT has_card THEN 'no scorecard' WHEN gate = 'fail' THEN 'gate' WHEN NOT has_view THEN 'no viewer' ELSE 'eligible' END AS reason, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS bytes FROM d GROUP BY ALL
""")
def promotion_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What can be published, and what keeps the rest back."""
    d, n = F.col("doc_id"), F.col("n_chars")
    reason = F.when(d % 5 == 0, "no scorecard").when(n % 100 < 20, "gate").when(d % 7 == 0, "no viewer").otherwise("eligible")
    return read(spark, sf_dir, "documents").groupBy(F.col("source").alias("product"), reason.alias("reason")).agg(F.count("*").alias("n"), F.sum("n_chars").alias("bytes"))


@query("fully_published", "WITH a AS (SELECT o_custkey AS slug, o_orderkey % 3 AS artefact FROM orders) SELECT slug FROM a GROUP BY slug HAVING count(DISTINCT artefact) = 3")
def fully_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that have all three artefacts."""
    a = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("slug"), (F.col("o_orderkey") % 3).alias("artefact"))
    return a.groupBy("slug").agg(F.count_distinct("artefact").alias("n")).where("n = 3").select("slug")


@query("stratified_sample", "SELECT doc_id, source, lang FROM documents QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) = 1")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document of every product and place, the same on every run."""
    rows = read(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    best = F.min_by("doc_id", F.struct(F.md5(F.col("doc_id").cast("string")), "doc_id"))
    return rows.groupBy("source", "lang").agg(best.alias("doc_id")).select("doc_id", "source", "lang")
