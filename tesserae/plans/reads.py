"""Reads by key, citations of answers, suggestions, title links and index upkeep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import ann, titles, topk, trees
from ..sources.tables import read
from .catalog import query
from .graphs import _SECTIONS, sections
from .retrieval import _ALL, _SCOPED, SCOPE, hits, queries_of


@query("question_suggestions")
def question_suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark questions with a word misspelt in each, mended by the words of all texts, rare ones too."""
    docs = read(spark, sf_dir, "documents").select("text").unionByName(read(spark, sf_dir, "benchmark").select("text")).select(T.tokens(F.col("text")).alias("w"))
    words = docs.select(F.explode("w").alias("term")).where(F.length("term") >= 3).groupBy("term").agg(F.count("*").alias("freq"))
    pairs = docs.where(F.size("w") > 1).select(F.explode(F.arrays_zip(F.slice("w", 1, F.size("w") - 1).alias("a"), F.slice("w", 2, F.size("w") - 1).alias("b"))).alias("p")).select("p.a", "p.b").distinct()
    longest = F.array_max(F.transform(T.tokens(F.col("text")), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    asked = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("q"), F.array_join(T.tokens(F.col("text")), " ").alias("t"), longest.alias("l"))
    wrong = F.concat(F.substring("l", F.lit(1), F.length("l") - 2), F.reverse(F.right("l", F.lit(2))))
    return titles.suggest(asked.select("q", F.replace("t", F.col("l"), wrong).alias("text")), words, pairs)


@query("fuzzy_title_links")
def fuzzy_title_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paraphrased titles with the one title in scope that is like them; the measure has no SQL twin."""
    part = read(spark, sf_dir, "part")
    said = F.concat(F.lit("the "), F.col("p_name"), F.lit(" rules"))
    asked = part.where("p_partkey % 7 = 0").select(F.col("p_partkey").alias("q"), F.col("p_size").alias("scope"), said.alias("title"))
    return titles.fuzzy_titles(asked, part.select(F.col("p_partkey").alias("key"), F.col("p_size").alias("scope"), F.col("p_name").alias("title")))


@query("labels_in_order", """
WITH p AS (SELECT doc_id, CAST(i AS INTEGER) AS ord, w[i + 1] AS label FROM (SELECT doc_id, w, unnest(range(0, CAST(len(w) AS BIGINT))) AS i FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents))),
l AS (SELECT doc_id, 0 AS i, min(label) AS label FROM p GROUP BY doc_id UNION ALL SELECT doc_id, 1, max(label) FROM p GROUP BY doc_id),
a AS (SELECT doc_id, min(ord) AS ord FROM p JOIN l USING (doc_id, label) WHERE i = 0 GROUP BY doc_id), b AS (SELECT p.doc_id, min(p.ord) AS ord FROM p JOIN l ON l.doc_id = p.doc_id AND l.label = p.label AND l.i = 1 JOIN a ON a.doc_id = p.doc_id AND p.ord >= a.ord GROUP BY p.doc_id)
SELECT l.doc_id, l.i, l.label, CASE WHEN l.i = 0 THEN a.ord ELSE b.ord END AS ord FROM l JOIN a USING (doc_id) LEFT JOIN b USING (doc_id)
""")
def labels_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels located in a text one after the other."""
    places = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(T.tokens(F.col("text"))).alias("ord", "label"))
    ends = places.groupBy("doc_id").agg(F.min("label").alias("a"), F.max("label").alias("b"))
    labels = ends.select("doc_id", F.posexplode(F.array("a", "b")).alias("i", "label"))
    return titles.locate_in_order(labels, places.join(labels.select("doc_id", "label").distinct(), ["doc_id", "label"], "left_semi"))


@query("named_region_merge", _ALL + """, n AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS own FROM r WHERE label = qlabel), u AS (SELECT q, vec_id, label, score, FALSE AS named FROM r WHERE rk <= 8 UNION ALL SELECT q, vec_id, label, score, TRUE FROM n WHERE own <= 4),
d AS (SELECT q, vec_id, any_value(label) AS label, max(score) AS score, bool_or(named) AS named FROM u GROUP BY q, vec_id)
SELECT q, vec_id, label, named, score, CAST(row_number() OVER (PARTITION BY q ORDER BY named DESC, score DESC, vec_id) AS INTEGER) AS place FROM d
""")
def named_region_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions that a question names add their own best rows, which come first; a row counts once."""
    found = hits(spark, sf_dir, False, 8, 4)
    order = [F.col("score").desc(), F.col("vec_id")]
    best = topk.top_k(found, 8, ["q"], order).withColumn("named", F.lit(False))
    own = topk.top_k(found.where("label = qlabel"), 4, ["q"], order).withColumn("named", F.lit(True))
    both = best.unionByName(own).groupBy("q", "vec_id").agg(F.first("label").alias("label"), F.max("score").alias("score"), F.bool_or("named").alias("named"))
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.col("named").desc(), F.col("score").desc(), "vec_id"))
    return both.select("q", "vec_id", "label", "named", "score", place.alias("place"))


@query("degraded_rerank", _SCOPED + "SELECT q, vec_id, CAST(rk AS INTEGER) AS rk, round((9 - rk + 1)::DOUBLE / 9, 6) AS score FROM r WHERE rk <= 9")
def degraded_rerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When a reranker fails, rows keep their order and get evenly falling scores."""
    ranked = topk.top_k(hits(spark, sf_dir, True, 9), 9, ["q"], [F.col("score").desc(), F.col("vec_id")])
    return ranked.select("q", "vec_id", "rk", F.round((9 - F.col("rk") + 1) / 9.0, 6).alias("score"))


@query("missing_bundles", _ALL + ", have AS (SELECT DISTINCT label FROM embeddings WHERE label % 4 <> 1) SELECT label, count(*) AS n_dropped FROM r WHERE rk <= 10 AND label NOT IN (SELECT label FROM have) GROUP BY label")
def missing_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of regions that lost their bundle since: only theirs drop out, and are reported."""
    found = topk.top_k(hits(spark, sf_dir, False, 10), 10, ["q"], [F.col("score").desc(), F.col("vec_id")])
    have = read(spark, sf_dir, "embeddings").where("label % 4 <> 1").select("label").distinct()
    return found.join(have, "label", "left_anti").groupBy("label").agg(F.count("*").alias("n_dropped"))


@query("snippets", "SELECT doc_id, left(text, 220) || CASE WHEN length(text) > 220 THEN '…' ELSE '' END AS snippet, length(left(text, 500)) AS n_payload FROM documents")
def snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a list of hits shows of each text, and what its payload holds."""
    more = F.when(F.length("text") > 220, "…").otherwise("")
    return read(spark, sf_dir, "documents").select("doc_id", F.concat(F.substring("text", 1, 220), more).alias("snippet"), F.length(F.substring("text", 1, 500)).cast("bigint").alias("n_payload"))


@query("index_extension", "WITH old AS (SELECT doc_id FROM documents WHERE doc_id % 3 <> 0), new AS (SELECT doc_id, left(text, 1000) AS said FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM old)) SELECT doc_id, length(said) AS n_chars, md5(said) AS digest FROM new")
def index_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that an index lacks, the only ones to embed, up to a model's thousand characters."""
    docs = read(spark, sf_dir, "documents")
    said = F.substring("text", 1, 1000)
    return docs.join(docs.where("doc_id % 3 <> 0").select("doc_id"), "doc_id", "left_anti").select("doc_id", F.length(said).cast("bigint").alias("n_chars"), F.md5(said).alias("digest"))


@query("multi_index_report", "WITH m AS (SELECT label, CASE label % 4 WHEN 0 THEN 'm1' WHEN 1 THEN 'm0' ELSE 'm1' END AS model, count(*) FILTER (vec_id % 11 <> label) AS n FROM embeddings GROUP BY label), w AS (SELECT CAST(range AS INTEGER) AS label FROM range(0, 12)) SELECT w.label, CASE WHEN m.label IS NULL THEN 'missing' WHEN model <> 'm1' THEN 'other model' WHEN n = 0 THEN 'empty' ELSE 'used' END AS state, coalesce(CASE WHEN model = 'm1' THEN n END, 0) AS n_rows FROM w LEFT JOIN m ON m.label = w.label")
def multi_index_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions that go into one index: of the right model and not empty; what is left out, and why."""
    m = read(spark, sf_dir, "embeddings").groupBy(F.col("label").cast("int").alias("label")).agg(F.count_if(F.col("vec_id") % 11 != F.col("label")).alias("n")).withColumn("model", F.when(F.col("label") % 4 == 1, "m0").otherwise("m1"))
    w = spark.range(12).select(F.col("id").cast("int").alias("label"))
    state = F.when(F.col("model").isNull(), "missing").when(F.col("model") != "m1", "other model").when(F.col("n") == 0, "empty").otherwise("used")
    return w.join(m, "label", "left").select("label", state.alias("state"), F.coalesce(F.when(F.col("model") == "m1", F.col("n")), F.lit(0)).alias("n_rows"))


@query("augmented_texts", "WITH q AS (SELECT conv_id % 500 AS doc_id, string_agg(text, ' ' ORDER BY conv_id, turn) AS asked FROM conversations WHERE role = 'user' AND turn = 0 GROUP BY 1) SELECT doc_id, md5(coalesce(asked || chr(10), '') || text) AS digest, asked IS NOT NULL AS augmented FROM documents LEFT JOIN q USING (doc_id)")
def augmented_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions go before a text for the embedding alone."""
    q = read(spark, sf_dir, "conversations").where("role = 'user' and turn = 0").groupBy((F.col("conv_id") % 500).alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("conv_id", "turn", "text"))).alias("r"))
    q = q.select("doc_id", F.array_join(F.transform("r", lambda x: x["text"]), " ").alias("asked"))
    rows = read(spark, sf_dir, "documents").select("doc_id", "text").join(q, "doc_id", "left")
    return rows.select("doc_id", F.md5(F.concat(F.coalesce(F.concat("asked", F.lit("\n")), F.lit("")), "text")).alias("digest"), F.col("asked").isNotNull().alias("augmented"))


@query("thin_headings", _SECTIONS + """, u AS (SELECT a.doc_id, a.ord, a.n, coalesce(min(b.ord) - 1, (SELECT max(ord) FROM s z WHERE z.doc_id = a.doc_id)) AS until FROM s a LEFT JOIN s b ON b.doc_id = a.doc_id AND b.ord > a.ord AND b.level <= a.level GROUP BY a.doc_id, a.ord, a.n)
SELECT u.doc_id, u.ord, u.n < 40 AS thin, CAST(CASE WHEN u.n < 40 THEN least(2500, u.n + coalesce((SELECT sum(t.n) FROM s t WHERE t.doc_id = u.doc_id AND t.ord > u.ord AND t.ord <= u.until), 0)) ELSE u.n END AS BIGINT) AS n_embedded FROM u
""")
def thin_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A section with hardly any text borrows that of the sections below it, up to 2,500 characters."""
    rows = trees.subtree_ends(sections(spark, sf_dir), "doc_id", 3)
    rows = rows.withColumn("run", F.sum("n").over(Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.join(rows.select("doc_id", F.col("ord").alias("until"), F.col("run").alias("last")), ["doc_id", "until"])
    all_ = F.least(F.lit(2500).cast("bigint"), F.col("n") + F.col("last") - F.col("run"))
    return rows.select("doc_id", "ord", (F.col("n") < 40).alias("thin"), F.when(F.col("n") < 40, all_).otherwise(F.col("n")).alias("n_embedded"))


@query("section_reads", _SECTIONS + """, c AS (SELECT doc_id, CAST(o_orderkey % 7 AS INTEGER) AS ord, count(*) AS n FROM s JOIN orders ON o_custkey = doc_id WHERE s.ord = 0 GROUP BY ALL), a AS (SELECT doc_id, CAST(event_id % 7 AS INTEGER) AS ord, count(*) AS n FROM s JOIN events ON user_id = doc_id WHERE s.ord = 0 GROUP BY ALL)
SELECT s.doc_id, s.ord, s.level, coalesce(c.n, 0) AS n_guidance, coalesce(a.n, 0) AS n_alerts FROM s LEFT JOIN c USING (doc_id, ord) LEFT JOIN a USING (doc_id, ord)
""")
def section_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A section as it is read: with its guidance and alerts, which are mapped by key."""
    s = sections(spark, sf_dir).select("doc_id", "ord", "level")
    docs = s.where("ord = 0").select("doc_id")
    c = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), (F.col("o_orderkey") % 7).cast("int").alias("ord")).join(docs, "doc_id", "left_semi").groupBy("doc_id", "ord").agg(F.count("*").alias("g"))
    a = read(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), (F.col("event_id") % 7).cast("int").alias("ord")).join(docs, "doc_id", "left_semi").groupBy("doc_id", "ord").agg(F.count("*").alias("e"))
    return s.join(c, ["doc_id", "ord"], "left").join(a, ["doc_id", "ord"], "left").select("doc_id", "ord", "level", F.coalesce("g", F.lit(0)).alias("n_guidance"), F.coalesce("e", F.lit(0)).alias("n_alerts"))


@query("unmapped_alerts", "WITH k AS (SELECT DISTINCT c_custkey AS id FROM customer WHERE c_custkey % 4 <> 0) SELECT event_type AS kind, count(*) FILTER (k.id IS NOT NULL) AS n_mapped, count(*) FILTER (k.id IS NULL) AS n_unmapped FROM events LEFT JOIN k ON k.id = user_id GROUP BY 1")
def unmapped_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts that lead to a clause, and those that lead nowhere."""
    k = read(spark, sf_dir, "customer").where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("user_id"), F.lit(1).alias("k"))
    e = read(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("kind")).join(k, "user_id", "left")
    return e.groupBy("kind").agg(F.count("k").alias("n_mapped"), F.count_if(F.col("k").isNull()).alias("n_unmapped"))


_ANSWERS = "WITH a AS (SELECT o_orderkey AS id, 'See A' || (o_orderkey % 6) || '.1 and B' || (o_orderkey % 4) || ', not Z9.' AS said FROM orders), c AS (SELECT DISTINCT id, unnest(regexp_extract_all(said, '\\b([A-K][0-9]+(?:\\.[0-9]+)*)', 1)) AS key FROM a), have AS (SELECT DISTINCT 'A' || (p_partkey % 5) || '.1' AS key FROM part UNION SELECT DISTINCT 'B' || (p_partkey % 3) FROM part)\n"


def answers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Clause keys that answers cite, and the keys that exist."""
    k, p = F.col("o_orderkey"), F.col("p_partkey")
    said = F.concat(F.lit("See A"), (k % 6).cast("string"), F.lit(".1 and B"), (k % 4).cast("string"), F.lit(", not Z9."))
    cites = read(spark, sf_dir, "orders").select(k.alias("id"), F.explode(F.array_distinct(F.regexp_extract_all(said, F.lit(r"\b([A-K][0-9]+(?:\.[0-9]+)*)"), 1))).alias("key"))
    part = read(spark, sf_dir, "part")
    have = part.select(F.concat(F.lit("A"), (p % 5).cast("string"), F.lit(".1")).alias("key")).union(part.select(F.concat(F.lit("B"), (p % 3).cast("string")))).distinct()
    return cites, have


@query("cited_sources", _ANSWERS + "SELECT id, key FROM c JOIN have USING (key) WHERE NOT (id % 2 = 0 AND starts_with(key, 'B'))")
def cited_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that an answer cites and its list doesn't have yet."""
    cites, have = answers(spark, sf_dir)
    listed = (F.col("id") % 2 == 0) & F.startswith("key", F.lit("B"))
    return cites.join(have, "key", "left_semi").where(~listed).select("id", "key")


@query("unresolved_citations", _ANSWERS + "SELECT id, key FROM c WHERE key NOT IN (SELECT key FROM have)")
def unresolved_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations that lead to nothing."""
    cites, have = answers(spark, sf_dir)
    return cites.join(have, "key", "left_anti").select("id", "key")


@query("key_coverage_metrics", _ALL + ", k AS (SELECT q, min(rk) FILTER (label = qlabel) AS first, count(DISTINCT label) FILTER (rk <= 10) AS n_labels FROM r WHERE rk <= 10 GROUP BY q) SELECT count(*) AS n_queries, round(avg(CASE WHEN first <= 3 THEN 1.0::DOUBLE ELSE 0 END), 6) AS hit_3, round(avg(coalesce(1.0::DOUBLE / first, 0)), 6) AS mrr, round(100.0::DOUBLE * avg(n_labels) / (SELECT count(DISTINCT label) FROM embeddings), 4) AS coverage FROM k")
def key_coverage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits and reciprocal ranks of a chunker, and the share of keys that its results reach."""
    found = topk.top_k(hits(spark, sf_dir, False, 10), 10, ["q"], [F.col("score").desc(), F.col("vec_id")])
    k = found.groupBy("q").agg(F.min(F.when(F.col("label") == F.col("qlabel"), F.col("rk"))).alias("first"), F.count_distinct("label").alias("n"))
    labels = read(spark, sf_dir, "embeddings").agg(F.count_distinct("label").alias("all"))
    out = k.agg(F.count("*").alias("n_queries"), F.round(F.avg(F.when(F.col("first") <= 3, 1.0).otherwise(0.0)), 6).alias("hit_3"), F.round(F.avg(F.coalesce(1.0 / F.col("first"), F.lit(0.0))), 6).alias("mrr"), F.avg("n").alias("a"))
    return out.crossJoin(F.broadcast(labels)).select("n_queries", "hit_3", "mrr", F.round(100.0 * F.col("a") / F.col("all"), 4).alias("coverage"))


_PAGES = "WITH l AS (SELECT doc_id, ord // 8 AS page, ord % 8 AS k, trim(line) AS line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ord FROM documents)), s AS (SELECT doc_id, page, k, trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '#', 'g'), '[!?.,;:()]+', ' ', 'g')) AS shape FROM l WHERE line <> ''), n AS (SELECT doc_id, count(DISTINCT page) AS n FROM s GROUP BY doc_id)\n"


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line shapes of eight-line pages, with their place on the page."""
    rows = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "line")).where("trim(line) <> ''")
    shape = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim("line")), "[0-9]+", "#"), "[!?.,;:()]+", " "))
    return rows.select("doc_id", F.floor(F.col("ord") / 8).alias("page"), (F.col("ord") % 8).alias("k"), shape.alias("shape"))


@query("zone_boilerplate", _PAGES + "SELECT doc_id, shape, count(DISTINCT page) AS n_pages FROM s JOIN n USING (doc_id) WHERE k IN (0, 1, 6, 7) GROUP BY doc_id, shape, n.n HAVING count(DISTINCT page) >= 0.8 * n.n AND n.n >= 2")
def zone_boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes at the top or bottom of four pages in five."""
    rows = page_lines(spark, sf_dir)
    n = rows.groupBy("doc_id").agg(F.count_distinct("page").alias("n"))
    zone = rows.where("k in (0, 1, 6, 7)").groupBy("doc_id", "shape").agg(F.count_distinct("page").alias("n_pages"))
    return zone.join(n, "doc_id").where("n >= 2 and n_pages >= 0.8 * n").select("doc_id", "shape", "n_pages")


@query("floating_footers", _PAGES + "SELECT doc_id, shape, count(DISTINCT page) AS n_pages, round(count(DISTINCT page) / n.n, 6) AS share FROM s JOIN n USING (doc_id) WHERE k NOT IN (0, 1, 6, 7) GROUP BY doc_id, shape, n.n HAVING count(DISTINCT page) >= 2 AND count(DISTINCT page) >= 0.3 * n.n")
def floating_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes that come back in the middle of pages."""
    rows = page_lines(spark, sf_dir)
    n = rows.groupBy("doc_id").agg(F.count_distinct("page").alias("n"))
    mid = rows.where("k not in (0, 1, 6, 7)").groupBy("doc_id", "shape").agg(F.count_distinct("page").alias("n_pages"))
    return mid.join(n, "doc_id").where("n_pages >= 2 and n_pages >= 0.3 * n").select("doc_id", "shape", "n_pages", F.round(F.col("n_pages") / F.col("n"), 6).alias("share"))


@query("furniture_lines", _PAGES + "SELECT doc_id, shape, round(count(DISTINCT page) / n.n, 6) AS share FROM s JOIN n USING (doc_id) GROUP BY doc_id, shape, n.n HAVING count(DISTINCT page) >= 0.5 * n.n AND n.n >= 3")
def furniture_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes on half of a document's pages, wherever they stand."""
    rows = page_lines(spark, sf_dir)
    n = rows.groupBy("doc_id").agg(F.count_distinct("page").alias("n"))
    each = rows.groupBy("doc_id", "shape").agg(F.count_distinct("page").alias("k"))
    return each.join(n, "doc_id").where("n >= 3 and k >= 0.5 * n").select("doc_id", "shape", F.round(F.col("k") / F.col("n"), 6).alias("share"))


@query("split_punctuation", "WITH r AS (SELECT doc_id, unnest(regexp_extract_all(lower(text || ' don' || chr(39) || 't re-use closed-ended'), '[\\p{L}\\p{N}' || chr(39) || '-]+')) AS w FROM documents), w AS (SELECT doc_id, unnest(string_split(replace(w, chr(39), ''), '-')) AS token FROM r) SELECT doc_id, count(*) FILTER (token <> '') AS n, count(DISTINCT token) FILTER (token <> '') AS n_distinct FROM w GROUP BY doc_id")
def split_punctuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words without apostrophes, parted at hyphens, so that two spellings agree."""
    words = F.regexp_extract_all(F.lower(F.concat("text", F.lit(" don't re-use closed-ended"))), F.lit(r"([\p{L}\p{N}'-]+)"), 1)
    parts = F.flatten(F.transform(words, lambda w: F.split(F.replace(w, F.lit("'"), F.lit("")), "-")))
    rows = read(spark, sf_dir, "documents").select("doc_id", F.explode(parts).alias("token")).where("token <> ''")
    return rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_distinct("token").alias("n_distinct"))


@query("lsh_neighbours")
def lsh_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate neighbours of the query set, by codes of every row, the best forty for each scored exactly; no SQL twin."""
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    return ann.search(rows, queries_of(spark, sf_dir), "vec_id", 10).select("q", "vec_id", "label", "score", "rk")


@query("routed_scope", _SCOPED + "SELECT q, vec_id, label, score, CAST(rk AS INTEGER) AS rk, 'exact' AS backend FROM r WHERE rk <= 10")
def routed_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search within some labels goes to the exact backend, however large the table is."""
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    return ann.routed(rows, queries_of(spark, sf_dir), "vec_id", 10, scope=list(SCOPE), few=0)


@query("routed_floor")
def routed_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table by codes, with the two best of each label beside the best ten; no SQL twin."""
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    return ann.routed(rows, queries_of(spark, sf_dir), "vec_id", 10, few=0, floor=2)
