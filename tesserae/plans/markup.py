"""Headings, notes, tables, links and clause keys parsed out of markdown text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import tables, trees
from ..sources.tables import read
from .catalog import query

#: Documents written as markdown: some lines become headings, statements with a number, notes, references to them, table rows and bullets.
MD = """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS said, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ord FROM documents),
md AS (SELECT doc_id, CAST(ord AS INTEGER) AS ord, CASE ord % 9
  WHEN 0 THEN repeat('#', CAST(1 + (ord // 9) % 3 AS INTEGER)) || ' ' || CASE ord % 27 WHEN 0 THEN chr(CAST(65 + (ord // 27) % 11 AS INTEGER)) || '. ' WHEN 9 THEN (1 + ord // 27) || '.' || (1 + doc_id % 3) || ' ' ELSE '(' || chr(CAST(97 + ord % 5 AS INTEGER)) || ') ' END || said
  WHEN 2 THEN said || ' under section ' || (1000 + (doc_id * 31 + ord * 17) % 9000) || ' of the act or ' || (1 + (doc_id + ord) % 9) || ',' || (100 + (doc_id * 7 + ord) % 900) || ' euro'
  WHEN 4 THEN said || '[^' || (1 + (doc_id + ord) % 23) || '] see ' || chr(CAST(65 + ord % 4 AS INTEGER)) || (1 + ord % 5) || '.' || (1 + ord % 3) || '(a)'
  WHEN 5 THEN '| ' || replace(said, '|', '/') || ' | ' || ord || CASE WHEN ord % 2 = 0 THEN ' | x |' ELSE ' |' END
  WHEN 6 THEN '| ' || replace(said, '|', '/') || ' | Yes |'
  WHEN 7 THEN '[^' || (1 + (doc_id + ord * 5) % 23) || ']: ' || said
  WHEN 8 THEN '- ' || said ELSE said END AS line FROM l)
"""


def markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, ord, line)`` of every document as markdown."""
    rows = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "said"))
    d, o, said = F.col("doc_id"), F.col("ord").cast("bigint"), F.col("said")
    whole = lambda c: c.cast("bigint").cast("string")
    letter = lambda base, n: F.char((base + n).cast("int"))
    number = F.when(o % 27 == 0, F.concat(letter(65, F.floor(o / 27) % 11), F.lit(". "))).when(o % 27 == 9, F.concat(whole(1 + F.floor(o / 27)), F.lit("."), whole(1 + d % 3), F.lit(" "))).otherwise(F.concat(F.lit("("), letter(97, o % 5), F.lit(") ")))
    line = (
        F.when(o % 9 == 0, F.concat(F.repeat(F.lit("#"), (1 + F.floor(o / 9) % 3).cast("int")), F.lit(" "), number, said))
        .when(o % 9 == 2, F.concat(said, F.lit(" under section "), whole(1000 + (d * 31 + o * 17) % 9000), F.lit(" of the act or "), whole(1 + (d + o) % 9), F.lit(","), whole(100 + (d * 7 + o) % 900), F.lit(" euro")))
        .when(o % 9 == 4, F.concat(said, F.lit("[^"), whole(1 + (d + o) % 23), F.lit("] see "), letter(65, o % 4), whole(1 + o % 5), F.lit("."), whole(1 + o % 3), F.lit("(a)")))
        .when(o % 9 == 5, F.concat(F.lit("| "), F.replace(said, F.lit("|"), F.lit("/")), F.lit(" | "), whole(o), F.when(o % 2 == 0, " | x |").otherwise(" |")))
        .when(o % 9 == 6, F.concat(F.lit("| "), F.replace(said, F.lit("|"), F.lit("/")), F.lit(" | Yes |"))).when(o % 9 == 7, F.concat(F.lit("[^"), whole(1 + (d + o * 5) % 23), F.lit("]: "), said))
        .when(o % 9 == 8, F.concat(F.lit("- "), said)).otherwise(said)
    )
    return rows.select("doc_id", "ord", line.alias("line"))


_HEADS = MD + ", h AS (SELECT doc_id, ord, CAST(length(regexp_extract(line, '^(#{1,6}) ', 1)) AS INTEGER) AS level, regexp_extract(line, '^#{1,6} +(.*)$', 1) AS title FROM md WHERE regexp_matches(line, '^#{1,6} '))\n"


def headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heading lines with their level and title."""
    rows = markdown(spark, sf_dir).where(F.col("line").rlike("^#{1,6} "))
    return rows.select("doc_id", "ord", F.length(F.regexp_extract("line", "^(#{1,6}) ", 1)).alias("level"), F.regexp_extract("line", "^#{1,6} +(.*)$", 1).alias("title"))


@query("heading_forest", _HEADS + "SELECT c.doc_id, c.ord, c.level, c.title, max(p.ord) AS parent, CAST(row_number() OVER (PARTITION BY c.doc_id ORDER BY c.ord) AS INTEGER) AS place FROM h c LEFT JOIN h p ON p.doc_id = c.doc_id AND p.ord < c.ord AND p.level < c.level GROUP BY c.doc_id, c.ord, c.level, c.title")
def heading_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings of a text as a forest in reading order: each under the last one of a lower level."""
    rows = trees.parents_by_level(headings(spark, sf_dir), "doc_id", 6)
    return rows.select("doc_id", "ord", "level", "title", "parent", F.row_number().over(Window.partitionBy("doc_id").orderBy("ord")).alias("place"))


#: Families of numbering, outermost first: A. / 1. 1.1 / (a) / (ii).
_MARK = "CASE WHEN regexp_matches({x}, ' [0-9]{{1,4}}$') THEN NULL WHEN regexp_matches({x}, '^([0-9]+(\\.[0-9]+)+\\.?|[0-9]+\\.)\\s+\\S') THEN 'decimal' WHEN regexp_matches({x}, '^[A-Z]\\.\\s+\\S') THEN 'upper_alpha' WHEN regexp_matches({x}, '^\\([ivxlcdmIVXLCDM]{{2,}}\\)\\s*\\S') THEN 'paren_roman' WHEN regexp_matches({x}, '^\\([a-zA-Z]+\\)\\s*\\S') THEN 'paren_alpha' END"


@query("heading_markers", _HEADS + f"SELECT doc_id, ord, {_MARK.format(x='title')} AS family, CAST(CASE WHEN {_MARK.format(x='title')} = 'decimal' THEN len(string_split(rtrim(regexp_extract(title, '^([0-9.]+)', 1), '.'), '.')) WHEN {_MARK.format(x='title')} IS NOT NULL THEN 1 END AS INTEGER) AS depth FROM h")
def heading_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind and depth of the number that a heading carries; a trailing page number makes it a contents entry."""
    return headings(spark, sf_dir).select("doc_id", "ord", T.heading_mark(F.col("title")).alias("family"), T.mark_depth(F.col("title")).alias("depth"))


_NOTES = MD + """, d AS (SELECT doc_id, ord, CAST(regexp_extract(line, '^\\[\\^([0-9]+)\\]:', 1) AS INTEGER) AS id, trim(regexp_extract(line, '^\\[\\^[0-9]+\\]: ?(.*)$', 1)) AS body FROM md WHERE regexp_matches(line, '^\\[\\^[0-9]+\\]:')),
r AS (SELECT doc_id, ord, CAST(unnest(regexp_extract_all(line, '\\[\\^([0-9]+)\\]', 1)) AS INTEGER) AS id FROM md WHERE NOT regexp_matches(line, '^\\[\\^[0-9]+\\]:'))
"""


def notes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Definitions ``(doc_id, ord, id, body)`` of footnotes and references ``(doc_id, ord, id)`` to them."""
    md = markdown(spark, sf_dir)
    defines = F.col("line").rlike(r"^\[\^[0-9]+\]:")
    defs = md.where(defines).select("doc_id", "ord", F.regexp_extract("line", r"^\[\^([0-9]+)\]:", 1).cast("int").alias("id"), F.trim(F.regexp_extract("line", r"^\[\^[0-9]+\]: ?(.*)$", 1)).alias("body"))
    refs = md.where(~defines).select("doc_id", "ord", F.explode(F.transform(F.regexp_extract_all("line", F.lit(r"\[\^([0-9]+)\]"), 1), lambda x: x.cast("int"))).alias("id"))
    return defs, refs


@query("note_integrity", _NOTES + """, x AS (SELECT DISTINCT doc_id, id FROM d), y AS (SELECT DISTINCT doc_id, id FROM r),
b AS (SELECT doc_id, sum(n) AS n_same FROM (SELECT doc_id, body, count(DISTINCT id) AS n FROM d WHERE length(body) >= 15 GROUP BY ALL HAVING count(DISTINCT id) > 1) GROUP BY doc_id),
e AS (SELECT doc_id, id FROM x UNION SELECT doc_id, id FROM y), g AS (SELECT doc_id, max(id) - min(id) + 1 - count(*) AS n_gaps FROM e GROUP BY doc_id HAVING count(*) >= 4)
SELECT e.doc_id, count(*) FILTER (x.id IS NULL) AS n_dangling, count(*) FILTER (y.id IS NULL) AS n_orphan, CAST(coalesce(any_value(b.n_same), 0) AS BIGINT) AS n_same_body, CAST(coalesce(any_value(g.n_gaps), 0) AS BIGINT) AS n_gaps
FROM e LEFT JOIN x USING (doc_id, id) LEFT JOIN y USING (doc_id, id) LEFT JOIN b USING (doc_id) LEFT JOIN g USING (doc_id) GROUP BY e.doc_id
""")
def note_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References without a note, notes without a reference, different notes of one text, holes in the numbering."""
    defs, refs = notes(spark, sf_dir)
    d, r = defs.select("doc_id", "id", F.lit(1).alias("d"), F.lit(0).alias("r")), refs.select("doc_id", "id", F.lit(0).alias("d"), F.lit(1).alias("r"))
    ids = d.unionByName(r).groupBy("doc_id", "id").agg(F.max("d").alias("d"), F.max("r").alias("r"))
    gaps = F.when(F.count("*") >= 4, F.max("id") - F.min("id") + 1 - F.count("*")).otherwise(0)
    out = ids.groupBy("doc_id").agg(F.count_if(F.col("d") == 0).alias("n_dangling"), F.count_if(F.col("r") == 0).alias("n_orphan"), gaps.cast("bigint").alias("n_gaps"))
    same = defs.where(F.length("body") >= 15).groupBy("doc_id", "body").agg(F.count_distinct("id").alias("n")).where("n > 1").groupBy("doc_id").agg(F.sum("n").alias("n_same_body"))
    return out.join(same, "doc_id", "left").withColumn("n_same_body", F.coalesce("n_same_body", F.lit(0).cast("bigint"))).select("doc_id", "n_dangling", "n_orphan", "n_same_body", "n_gaps")


@query("note_bodies", _NOTES + "SELECT r.doc_id, r.ord, r.id, d.body FROM r LEFT JOIN (SELECT doc_id, id, arg_min(body, ord) AS body FROM d GROUP BY doc_id, id) d USING (doc_id, id)")
def note_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each reference with the note that it names, the first of that number."""
    defs, refs = notes(spark, sf_dir)
    first = defs.groupBy("doc_id", "id").agg(F.min_by("body", "ord").alias("body"))
    return refs.join(first, ["doc_id", "id"], "left").select("doc_id", "ord", "id", "body")


_CELLS = MD + """, t AS (SELECT doc_id, ord, line, ord - row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS tbl, len(string_split(trim(line, '| '), '|')) AS n FROM md WHERE regexp_matches(line, '^\\|.*\\|$'))
"""


@query("pipe_tables", _CELLS + "SELECT doc_id, min(ord) AS ord, count(*) AS n_rows, CAST(max(n) AS INTEGER) AS width, count(DISTINCT n) > 1 AS ragged FROM t GROUP BY doc_id, tbl")
def pipe_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of table rows: how many, how wide, whether widths differ."""
    rows = markdown(spark, sf_dir).where(F.col("line").rlike(r"^\|.*\|$"))
    w = Window.partitionBy("doc_id").orderBy("ord")
    rows = rows.withColumn("tbl", F.col("ord") - F.row_number().over(w)).withColumn("n", F.size(F.split(F.trim("line", F.lit("| ")), r"\|")))
    return rows.groupBy("doc_id", "tbl").agg(F.min("ord").alias("ord"), F.count("*").alias("n_rows"), F.max("n").alias("width"), (F.count_distinct("n") > 1).alias("ragged")).drop("tbl")


_KIND = "CASE WHEN regexp_matches(line, '^#{1,6} ') THEN 'heading' WHEN regexp_matches(line, '^\\|.*\\|$') THEN 'table' WHEN regexp_matches(line, '^\\[\\^[0-9]+\\]:') THEN 'note' WHEN regexp_matches(line, '^[-*•] ') THEN 'bullet' WHEN trim(line) = '' THEN 'blank' ELSE 'text' END"


def kind_of(line: Column) -> Column:
    return F.when(line.rlike("^#{1,6} "), "heading").when(line.rlike(r"^\|.*\|$"), "table").when(line.rlike(r"^\[\^[0-9]+\]:"), "note").when(line.rlike("^[-*•] "), "bullet").when(F.trim(line) == "", "blank").otherwise("text")


@query("line_elements", MD + f", k AS (SELECT doc_id, ord, {_KIND} AS kind FROM md), s AS (SELECT *, CASE WHEN kind = lag(kind) OVER (PARTITION BY doc_id ORDER BY ord) THEN 0 ELSE 1 END AS new FROM k), g AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS run FROM s) SELECT doc_id, min(ord) AS ord, any_value(kind) AS kind, count(*) AS n_lines FROM g GROUP BY doc_id, run")
def line_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text's elements: headings, tables, lists, notes and paragraphs, neighbours of one kind together."""
    w = Window.partitionBy("doc_id").orderBy("ord")
    rows = markdown(spark, sf_dir).select("doc_id", "ord", kind_of(F.col("line")).alias("kind"))
    rows = rows.withColumn("new", F.when(F.col("kind") == F.lag("kind").over(w), 0).otherwise(1)).withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("doc_id", "run", "kind").agg(F.min("ord").alias("ord"), F.count("*").alias("n_lines")).drop("run")


@query("clean_markdown", MD + "SELECT doc_id, ord, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(line, '^#{1,6} +', ''), '\\[\\^[0-9]+\\]:?', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\\|', ' ', 'g'), '[ \\t]+', ' ', 'g')) AS said FROM md")
def clean_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines without marks of headings, notes, tags and tables."""
    return markdown(spark, sf_dir).select("doc_id", "ord", T.clean_markdown(F.col("line")).alias("said"))


_URLS = "WITH p AS (SELECT page_id, 'see ' || url || '. Or (' || url || '), not [x](' || url || ')' AS said FROM pages WHERE url IS NOT NULL)\n"


@query("linked_urls", _URLS + "SELECT page_id, regexp_replace(said, '(^|[\\s])(\\(?)(https?://[^\\s<>()\\[\\]\"]*[^\\s<>()\\[\\]\".,;:!?])', '\\1\\2[\\3](\\3)', 'g') AS said FROM p")
def linked_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bare urls as links, without the punctuation that follows them; what is a link stays."""
    u = F.col("url")
    said = F.concat(F.lit("see "), u, F.lit(". Or ("), u, F.lit("), not [x]("), u, F.lit(")"))
    return read(spark, sf_dir, "pages").where("url is not null").select("page_id", T.linkify(said).alias("said"))


_CITES = MD + ", c AS (SELECT doc_id, ord, unnest(regexp_extract_all(line, '\\b([A-K][0-9]+(?:\\.[0-9]+)*(?:\\([a-z]\\))?)', 1)) AS key FROM md)\n"


def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clause keys that lines cite."""
    rows = markdown(spark, sf_dir)
    return rows.select("doc_id", "ord", F.explode(F.regexp_extract_all("line", F.lit(r"\b([A-K][0-9]+(?:\.[0-9]+)*(?:\([a-z]\))?)"), 1)).alias("key"))


@query("normal_clause_keys", _CITES + "SELECT DISTINCT key, trim(replace(replace(key, '(', '.'), ')', ''), '.') AS normal, string_split(trim(replace(replace(key, '(', '.'), ')', ''), '.'), '.')[1] AS root FROM c")
def normal_clause_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clause keys with brackets as dots, and their first part."""
    return citations(spark, sf_dir).select("key").distinct().select("key", T.normal_key(F.col("key")).alias("normal"), F.split(T.normal_key(F.col("key")), r"\.")[0].alias("root"))


@query("family_hits", _CITES + """, n AS (SELECT DISTINCT doc_id, trim(replace(replace(key, '(', '.'), ')', ''), '.') AS key FROM c), g AS (SELECT DISTINCT doc_id, string_split(key, '.')[1] AS gold FROM n WHERE ascii(key) % 2 = 1)
SELECT g.doc_id, g.gold, count(n.key) AS n_hits FROM g LEFT JOIN n ON n.doc_id = g.doc_id AND (n.key = g.gold OR starts_with(n.key, g.gold || '.') OR starts_with(g.gold, n.key || '.')) GROUP BY ALL
""")
def family_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cited keys of the family of an expected one: itself, what is above it, what is below. Each key lists its ancestors, then equi-joins."""
    n = citations(spark, sf_dir).select("doc_id", T.normal_key(F.col("key")).alias("key")).distinct()
    g = n.where(F.ascii("key") % 2 == 1).select("doc_id", F.split("key", r"\.")[0].alias("gold")).distinct()
    up = lambda c: F.transform(F.sequence(F.lit(1), F.size(F.split(c, r"\."))), lambda i: F.array_join(F.slice(F.split(c, r"\."), 1, i), "."))
    below = n.select("doc_id", "key", F.explode(up("key")).alias("gold"))
    above = g.select("doc_id", "gold", F.explode(up("gold")).alias("key")).join(n, ["doc_id", "key"]).select("doc_id", "key", "gold")
    hits = below.join(g, ["doc_id", "gold"]).select("doc_id", "key", "gold").union(above).distinct().groupBy("doc_id", "gold").agg(F.count("*").alias("n"))
    return g.join(hits, ["doc_id", "gold"], "left").select("doc_id", "gold", F.coalesce("n", F.lit(0)).alias("n_hits"))


@query("citation_parts", "WITH q AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN n_name || ' Survey A' || (s_suppkey % 5) || '.1, B2 and C' || (s_suppkey % 3) || '.4(a) see note' WHEN 1 THEN n_name || ' survey D3; nothing' WHEN 2 THEN n_name || ' A1.1' ELSE '' END AS cite FROM supplier JOIN nation ON n_nationkey = s_nationkey), p AS (SELECT s_suppkey, regexp_extract(cite, '(?i)^(.+?)\\s+survey\\s+(.*)$', 1) AS place, regexp_extract(cite, '(?i)^(.+?)\\s+survey\\s+(.*)$', 2) AS rest FROM q), t AS (SELECT s_suppkey, place, regexp_extract(trim(unnest(string_split_regex(rest, '[,;]| and '))), '^([A-K][0-9][A-Za-z0-9_.()]*)', 1) AS key FROM p WHERE place <> '') SELECT s_suppkey, place, rtrim(key, '.') AS key FROM t WHERE key <> ''")
def citation_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A citation such as ``Name Survey A3.1, B2 and C1`` as rows of place and clause key."""
    k, n = F.col("s_suppkey"), F.col("n_name")
    s = lambda m: (k % m).cast("string")
    cite = F.when(k % 4 == 0, F.concat(n, F.lit(" Survey A"), s(5), F.lit(".1, B2 and C"), s(3), F.lit(".4(a) see note"))).when(k % 4 == 1, F.concat(n, F.lit(" survey D3; nothing"))).when(k % 4 == 2, F.concat(n, F.lit(" A1.1"))).otherwise("")
    rows = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey")).select("s_suppkey", T.cited(cite).alias("c"))
    return rows.select("s_suppkey", "c.place", F.explode("c.keys").alias("key"))


@query("path_keys", """
WITH f AS (SELECT DISTINCT chr(CAST(65 + p_partkey % 4 AS INTEGER)) || '-part/' || CASE p_partkey % 5 WHEN 0 THEN '0' || (1 + p_partkey % 7) || '-scope/(b)-who.md' WHEN 1 THEN (1 + p_partkey % 7) || '.' || (1 + p_partkey % 3) || '-rules/' || (1 + p_partkey % 7) || '.' || (1 + p_partkey % 3) || '.2-more.md' WHEN 2 THEN '0' || (1 + p_partkey % 7) || '-scope.md' WHEN 3 THEN '0' || (1 + p_partkey % 7) || '-scope/00-intro.md' ELSE 'README.md' END AS path FROM part),
x AS (SELECT path, left(path, 1) AS part, regexp_extract(path, '/([^/]*)$', 1) AS fn, regexp_extract(path, '^[^/]*/([0-9]+(?:\\.[0-9]+)+)-[^/]*/', 1) AS nm, regexp_extract(path, '^[^/]*/0*([0-9]+)-[^/]*/', 1) AS sec FROM f)
SELECT path, CASE WHEN regexp_matches(fn, '^(README|glossary)') THEN NULL WHEN regexp_matches(fn, '^[0-9]+(\\.[0-9]+)+-') THEN part || regexp_extract(fn, '^([0-9]+(?:\\.[0-9]+)+)-', 1) WHEN regexp_matches(fn, '^\\(?[a-z]{1,4}\\)?[-.]') AND coalesce(nullif(nm, ''), sec) <> '' THEN part || coalesce(nullif(nm, ''), sec) || '(' || regexp_extract(fn, '^\\(?([a-z]{1,4})\\)?[-.]', 1) || ')' WHEN starts_with(fn, '00-') THEN part || coalesce(nullif(nm, ''), sec) WHEN regexp_matches(fn, '^0*[0-9]+-') THEN part || regexp_extract(fn, '^0*([0-9]+)-', 1) END AS key FROM x
""")
def path_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clause keys from the paths of a tree's files."""
    k = F.col("p_partkey")
    s = lambda m: (1 + k % m).cast("string")
    tail = (
        F.when(k % 5 == 0, F.concat(F.lit("0"), s(7), F.lit("-scope/(b)-who.md"))).when(k % 5 == 1, F.concat(s(7), F.lit("."), s(3), F.lit("-rules/"), s(7), F.lit("."), s(3), F.lit(".2-more.md")))
        .when(k % 5 == 2, F.concat(F.lit("0"), s(7), F.lit("-scope.md"))).when(k % 5 == 3, F.concat(F.lit("0"), s(7), F.lit("-scope/00-intro.md"))).otherwise("README.md")
    )
    paths = read(spark, sf_dir, "part").select(F.concat(F.char((65 + k % 4).cast("int")), F.lit("-part/"), tail).alias("path")).distinct()
    return paths.select("path", T.path_key(F.col("path")).alias("key"))


_NUM = """, w AS (SELECT doc_id, unnest(regexp_extract_all(line, '[0-9][0-9,]*(?:\\.[0-9]+)?%?')) AS raw FROM md), a AS (SELECT doc_id, replace(raw, ',', '') AS x, count(*) AS n FROM w GROUP BY ALL),
v AS (SELECT doc_id, unnest(regexp_extract_all(CASE WHEN ord % 7 = 3 THEN '' WHEN ord % 18 = 2 THEN regexp_replace(line, 'section ([0-9])([0-9])', 'section \\2\\1') ELSE line END, '[0-9][0-9,]*(?:\\.[0-9]+)?%?')) AS raw FROM md), b AS (SELECT doc_id, replace(raw, ',', '') AS x, count(*) AS n FROM v GROUP BY ALL),
m AS (SELECT doc_id, x, coalesce(a.n, 0) AS na, coalesce(b.n, 0) AS nb FROM a FULL JOIN b USING (doc_id, x) WHERE coalesce(a.n, 0) <> coalesce(b.n, 0))
"""


def damaged(md: DataFrame) -> DataFrame:
    """Another version of the lines: every seventh is gone, some numbers have two digits the other way round."""
    line = F.when(F.col("ord") % 7 == 3, "").when(F.col("ord") % 18 == 2, F.regexp_replace("line", "section ([0-9])([0-9])", "section $2$1")).otherwise(F.col("line"))
    return md.withColumn("line", line)


def number_counts(md: DataFrame, name: str) -> DataFrame:
    return md.select("doc_id", F.explode(T.numeric_tokens(F.col("line"))).alias("x")).groupBy("doc_id", "x").agg(F.count("*").alias(name))


def number_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that one version of a document has more often than the other."""
    md = markdown(spark, sf_dir)
    both = number_counts(md, "na").join(number_counts(damaged(md), "nb"), ["doc_id", "x"], "full").na.fill(0, ["na", "nb"])
    return both.where("na <> nb")


@query("number_changes", MD + _NUM + "SELECT doc_id, x AS number, CAST(na AS BIGINT) AS n_source, CAST(nb AS BIGINT) AS n_output, na > nb AND nb = 0 AS absent, na > nb AND length(rtrim(x, '%')) > 4 AND EXISTS (SELECT 1 FROM b WHERE b.doc_id = m.doc_id AND b.x IN (left(rtrim(m.x, '%'), length(rtrim(m.x, '%')) - 1), left(rtrim(m.x, '%'), length(rtrim(m.x, '%')) - 2))) AS glued FROM m")
def number_changes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing and extra numbers; a long one that is there but for its last digits has a note's number glued on."""
    m = number_changes(spark, sf_dir)
    core = F.rtrim("x", F.lit("%"))
    shorter = m.where((F.col("na") > F.col("nb")) & (F.length(core) > 4)).select("doc_id", "x", F.explode(F.array(*[F.substring(core, F.lit(1), F.length(core) - k) for k in (1, 2)])).alias("y"))
    there = number_counts(damaged(markdown(spark, sf_dir)), "n").select("doc_id", F.col("x").alias("y"))
    glued = shorter.join(there, ["doc_id", "y"], "left_semi").select("doc_id", "x", F.lit(True).alias("glued")).distinct()
    rows = m.join(glued, ["doc_id", "x"], "left")
    return rows.select("doc_id", F.col("x").alias("number"), F.col("na").alias("n_source"), F.col("nb").alias("n_output"), ((F.col("na") > F.col("nb")) & (F.col("nb") == 0)).alias("absent"), F.coalesce("glued", F.lit(False)).alias("glued"))


@query("swapped_digits", MD + _NUM + "SELECT p.doc_id, p.x AS missing, q.x AS extra FROM m p JOIN m q ON p.doc_id = q.doc_id AND p.na > p.nb AND q.nb > q.na AND p.x <> q.x AND list_sort(string_split(p.x, '')) = list_sort(string_split(q.x, '')) AND (ends_with(p.x, '%') OR length(p.x) >= 3)")
def swapped_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number gone and one of the same digits come, in one document: joined on their sorted characters."""
    m = number_changes(spark, sf_dir).where("length(x) >= 3 or x like '%\\%'").withColumn("k", T.letter_signature(F.col("x")))
    gone, come = m.where("na > nb").select("doc_id", "k", F.col("x").alias("missing")), m.where("nb > na").select("doc_id", "k", F.col("x").alias("extra"))
    return gone.join(come, ["doc_id", "k"]).select("doc_id", "missing", "extra")


@query("number_contexts", MD + """, l2 AS (SELECT doc_id, regexp_extract_all(lower(string_agg(line, ' ' ORDER BY ord)), '[\\p{L}\\p{N}]+') AS w FROM md GROUP BY doc_id), o AS (SELECT doc_id, ' ' || array_to_string(regexp_extract_all(lower(string_agg(CASE WHEN ord % 7 = 3 THEN '' ELSE line END, ' ' ORDER BY ord)), '[\\p{L}\\p{N}]+'), ' ') || ' ' AS hay FROM md GROUP BY doc_id),
s AS (SELECT doc_id, i, w[i:i] AS me, w[i - 4:i - 1] AS b, w[i + 1:i + 4] AS n FROM (SELECT doc_id, w, unnest(range(5, CAST(len(w) AS BIGINT) - 3)) AS i FROM l2 WHERE len(w) >= 9) WHERE regexp_matches(w[i], '^[0-9]+$'))
SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, me[1] AS number, contains(o.hay, ' ' || array_to_string(b, ' ') || ' ' || me[1] || ' ' || array_to_string(n, ' ') || ' ') AS kept FROM s JOIN o USING (doc_id)
""")
def number_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is a number still there with the four words on either side? Windows of nine join as hashes."""
    md = markdown(spark, sf_dir)
    whole = lambda rows: rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("ord", "line"))).alias("r")).select("doc_id", T.tokens(F.array_join(F.transform("r", lambda x: x["line"]), " ")).alias("w"))
    source, output = whole(md), whole(md.withColumn("line", F.when(F.col("ord") % 7 == 3, "").otherwise(F.col("line"))))
    spans = lambda rows: rows.select("doc_id", F.posexplode(T.windows_of(F.col("w"), 9)).alias("i", "s"))
    asked = spans(source).withColumn("number", F.split("s", " ")[4]).where(F.col("number").rlike("^[0-9]+$"))
    hay = spans(output).where(F.split("s", " ")[4].rlike("^[0-9]+$")).select("doc_id", "s", F.lit(True).alias("kept")).distinct()
    return asked.join(hay, ["doc_id", "s"], "left").select("doc_id", (F.col("i") + 4).cast("int").alias("pos"), "number", F.coalesce("kept", F.lit(False)).alias("kept"))


@query("contents_rows", MD + """, p AS (SELECT doc_id, ord // 12 AS page, regexp_extract_all(lower(string_agg(line, ' ' ORDER BY ord)), '[\\p{L}\\p{N}]+') AS w FROM md GROUP BY ALL), d AS (SELECT doc_id, page, len(w) AS n, list_filter(w, lambda x: regexp_matches(x, '^[0-9]+$')) AS digits FROM p),
e AS (SELECT *, list_transform(list_filter(digits, lambda x: length(x) <= 4), lambda x: CAST(x AS INTEGER)) AS v FROM d)
SELECT doc_id, CAST(page AS BIGINT) AS page, n >= 8 AND len(digits) / n >= 0.15 AND len(v) >= 2 AND len(list_filter(range(1, CAST(len(v) AS BIGINT)), lambda i: v[i + 1] >= v[i])) / greatest(1, len(v) - 1) >= 0.4 AS contents FROM e
""")
def contents_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that read like a table of contents: many small numbers, and rising."""
    rows = markdown(spark, sf_dir).withColumn("page", F.floor(F.col("ord") / 12)).groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct("ord", "line"))).alias("r"))
    return rows.select("doc_id", "page", T.like_contents(T.tokens(F.array_join(F.transform("r", lambda x: x["line"]), " "))).alias("contents"))


@query("heading_likeness", _HEADS + """, t AS (SELECT doc_id, trim(title) AS t FROM h), g AS (SELECT doc_id, t, NOT (t = '' OR len(string_split(trim(regexp_replace(t, '\\s+', ' ', 'g')), ' ')) >= 10 OR regexp_matches(t, '[,;:]$') OR (regexp_matches(t, '\\.$') AND NOT regexp_matches(t, '^[0-9.]+$')) OR regexp_matches(t, '^[a-z]') OR regexp_matches(t, '^\\(?[a-z0-9ivx]{1,4}\\)\\s+[a-z]')) AS ok FROM t)
SELECT doc_id, count(*) AS n, count(*) FILTER (ok) AS n_kept, round(1 - count(*) FILTER (ok) / count(*), 6) AS prose_share, count(*) FILTER (ok) >= 8 AS usable FROM g GROUP BY doc_id
""")
def heading_likeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of an outline's entries are headings and not prose, and whether enough stay without the others."""
    g = headings(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(T.heading_like(F.col("title"))).alias("n_kept"))
    return g.select("doc_id", "n", "n_kept", F.round(1 - F.col("n_kept") / F.col("n"), 6).alias("prose_share"), (F.col("n_kept") >= 8).alias("usable"))


@query("outline_coverage", _HEADS + """, a AS (SELECT doc_id, regexp_replace(lower(title), '[^a-z0-9]+', '', 'g') AS t, count(*) AS n FROM h GROUP BY ALL), b AS (SELECT doc_id, regexp_replace(lower(title), '[^a-z0-9]+', '', 'g') AS t, count(*) AS n FROM h WHERE ord % 45 <> 9 GROUP BY ALL)
SELECT doc_id, CAST(sum(a.n) AS BIGINT) AS n_outline, CAST(sum(greatest(0, a.n - coalesce(b.n, 0))) AS BIGINT) AS n_missing, round(100.0::DOUBLE * (sum(a.n) - sum(greatest(0, a.n - coalesce(b.n, 0)))) / sum(a.n), 1) AS score FROM a LEFT JOIN b USING (doc_id, t) GROUP BY doc_id
""")
def outline_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of an outline's titles that the output has, repeated ones one for one."""
    norm = F.regexp_replace(F.lower("title"), "[^a-z0-9]+", "").alias("t")
    h = headings(spark, sf_dir)
    a = h.groupBy("doc_id", norm).agg(F.count("*").alias("n"))
    b = h.where("ord % 45 <> 9").groupBy("doc_id", norm).agg(F.count("*").alias("m"))
    lost = F.greatest(F.lit(0), F.col("n") - F.coalesce("m", F.lit(0)))
    out = a.join(b, ["doc_id", "t"], "left").groupBy("doc_id").agg(F.sum("n").alias("n_outline"), F.sum(lost).alias("n_missing"))
    return out.withColumn("score", F.round(100.0 * (F.col("n_outline") - F.col("n_missing")) / F.col("n_outline"), 1))


@query("section_census", _HEADS + """, a AS (SELECT doc_id, ord, level, title, row_number() OVER (PARTITION BY doc_id, title ORDER BY ord) AS nth FROM h), b AS (SELECT doc_id, ord AS landed, least(level, 2) AS built, title, row_number() OVER (PARTITION BY doc_id, title ORDER BY ord) AS nth FROM h WHERE ord % 45 <> 9)
SELECT doc_id, a.ord, title, landed, CASE WHEN landed IS NULL THEN 'missing' WHEN built <> level THEN 'moved' ELSE 'there' END AS state FROM a LEFT JOIN b USING (doc_id, title, nth)
""")
def section_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promised sections against built ones, the k-th of a title with the k-th of it: there, moved in depth, or missing."""
    h = headings(spark, sf_dir)
    a, b = h, h.where("ord % 45 <> 9").select("doc_id", "title", F.col("ord").alias("landed"), F.least("level", F.lit(2)).alias("built"))
    both = tables.kth_pairs(a, b, ["doc_id", "title"], ["ord"], ["landed"]).where("ord is not null")
    state = F.when(F.col("landed").isNull(), "missing").when(F.col("built") != F.col("level"), "moved").otherwise("there")
    return both.select("doc_id", "ord", "title", "landed", state.alias("state"))


@query("table_sections", _HEADS + """, t AS (SELECT doc_id, ord, ord // 6 AS page FROM md WHERE regexp_matches(line, '^\\|.*\\|$')), s AS (SELECT doc_id, ord, title, ord // 6 AS first, lead(ord // 6) OVER (PARTITION BY doc_id ORDER BY ord) - 1 AS last FROM h),
x AS (SELECT t.doc_id, t.ord, t.page, max(s.ord) AS section FROM t LEFT JOIN s ON s.doc_id = t.doc_id AND s.first <= t.page GROUP BY ALL)
SELECT x.doc_id, x.ord, section, section IS NULL OR NOT (page >= s.first - 1 AND (s.last IS NULL OR page <= s.last + 1)) AS flagged FROM x LEFT JOIN s ON s.doc_id = x.doc_id AND s.ord = x.section
""")
def table_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The section that is open on a table's page, and whether the table lies outside its pages by more than one."""
    page = F.floor(F.col("ord") / 6)
    md = markdown(spark, sf_dir)
    s = headings(spark, sf_dir).withColumn("first", page).withColumn("last", F.lead("first").over(Window.partitionBy("doc_id").orderBy("ord")) - 1)
    heads = s.groupBy("doc_id", F.col("first").alias("page")).agg(F.max_by(F.struct(F.col("ord").alias("section"), "first", "last"), "ord").alias("s"))
    rows = md.where(F.col("line").rlike(r"^\|.*\|$")).select("doc_id", "ord", page.alias("page"))
    placed = tables.as_of(rows, heads, ["doc_id"], "page", "s")
    inside = (F.col("page") >= F.col("s.first") - 1) & (F.col("s.last").isNull() | (F.col("page") <= F.col("s.last") + 1))
    return placed.select("doc_id", "ord", F.col("s.section").alias("section"), (F.col("s").isNull() | ~inside).alias("flagged"))
