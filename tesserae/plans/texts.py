"""Token, markup and string queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.tables import read
from .catalog import query

_TOKENS = "WITH t AS (SELECT doc_id, lang, source, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS token FROM documents)\n"


def doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.explode(T.tokens(F.col("text"))).alias("token"))


@query("token_counts", _TOKENS + "SELECT token, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM t GROUP BY token")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words with their counts and document counts: one row a document before the global sums."""
    per = doc_tokens(spark, sf_dir).groupBy("doc_id", "token").count()
    return per.groupBy("token").agg(F.sum("count").alias("n"), F.count("*").alias("n_docs"))


@query("idf_terms", _TOKENS + "SELECT token, round(ln(1 + (SELECT count(*) FROM documents) / count(DISTINCT doc_id)), 6) AS idf FROM t GROUP BY token HAVING count(DISTINCT doc_id) >= 5")
def idf_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inverse document frequencies of words in five documents or more."""
    n = read(spark, sf_dir, "documents").agg(F.count("*").alias("n_all"))
    df = doc_tokens(spark, sf_dir).select("doc_id", "token").distinct().groupBy("token").agg(F.count("*").alias("df")).where("df >= 5")
    return df.crossJoin(F.broadcast(n)).select("token", F.round(F.log(1 + F.col("n_all") / F.col("df")), 6).alias("idf"))


@query("lexicon_terms", _TOKENS + "SELECT lang, token, count(*) AS freq FROM t WHERE length(token) >= 3 GROUP BY ALL HAVING count(*) >= 3")
def lexicon_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a language attests often enough."""
    return doc_tokens(spark, sf_dir).where(F.length("token") >= 3).groupBy("lang", "token").agg(F.count("*").alias("freq")).where("freq >= 3")


_LISTS = "WITH l AS (SELECT doc_id, lang, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents)\n"


@query("attested_bigrams", _LISTS + ", b AS (SELECT lang, unnest(list_zip(w[:-2], w[2:])) AS p FROM l WHERE len(w) > 1) SELECT lang, p[1] AS a, p[2] AS b, count(*) AS n FROM b WHERE length(p[1]) >= 4 AND length(p[2]) >= 4 GROUP BY ALL HAVING count(*) >= 2")
def attested_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring words seen twice or more."""
    docs = read(spark, sf_dir, "documents").select("lang", T.tokens(F.col("text")).alias("w")).where(F.size("w") > 1)
    pairs = docs.select("lang", F.explode(F.arrays_zip(F.slice("w", 1, F.size("w") - 1).alias("a"), F.slice("w", 2, F.size("w") - 1).alias("b"))).alias("p"))
    rows = pairs.select("lang", "p.a", "p.b").where((F.length("a") >= 4) & (F.length("b") >= 4))
    return rows.groupBy("lang", "a", "b").agg(F.count("*").alias("n")).where("n >= 2")


@query("anagram_candidates", _TOKENS + ", x AS (SELECT DISTINCT lang, token, array_to_string(list_sort(string_split(token, '')), '') AS k FROM t WHERE length(token) >= 4) SELECT lang, token, min(token) OVER w AS class, count(*) OVER w - 1 AS n_others FROM x WINDOW w AS (PARTITION BY lang, k) QUALIFY n_others > 0")
def anagram_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of one language with the same letters, each with the first of its class; no pairs are made."""
    words = doc_tokens(spark, sf_dir).where(F.length("token") >= 4).select("lang", "token").distinct()
    return T.classes(words, "token", T.letter_signature(F.col("token")), "lang")


@query("prefix_suggest", "WITH n AS (SELECT DISTINCT p_name AS title FROM part), p AS (SELECT title, left(title, k) AS prefix FROM n CROSS JOIN range(2, 16) r(k) WHERE k <= greatest(2, length(title))), r AS (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY length(title), title) AS rk FROM p) SELECT prefix, title, CAST(rk AS INTEGER) AS rk FROM r WHERE rk <= 3")
def prefix_suggest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shortest titles for each typed beginning."""
    titles = read(spark, sf_dir, "part").select(F.col("p_name").alias("title")).distinct()
    rows = titles.select("title", F.explode(T.edge_prefixes(F.col("title"))).alias("prefix"))
    w = Window.partitionBy("prefix").orderBy(F.length("title"), "title")
    return rows.withColumn("rk", F.row_number().over(w)).where("rk <= 3").select("prefix", "title", "rk")


_BM25 = _LISTS + """, d AS (SELECT doc_id, w, len(w) AS dl FROM l), a AS (SELECT avg(dl) AS avgdl, count(*) AS n FROM d),
q AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'))) AS token FROM benchmark),
tf AS (SELECT doc_id, dl, token, count(*) AS f FROM (SELECT doc_id, dl, unnest(w) AS token FROM d) WHERE token IN (SELECT token FROM q) GROUP BY ALL),
df AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
s AS (SELECT item_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS score FROM q JOIN tf USING (token) JOIN df USING (token), a GROUP BY ALL)
SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rk FROM s QUALIFY rk <= 5
"""


def best_by_words(docs: DataFrame, asked: DataFrame, weight, with_shared: bool = False, k: int = 5) -> DataFrame:
    """``docs(doc_id, w)`` and ``asked(item_id, token)`` to the ``k`` best documents of each item.

    weight(n, df, f, dl) is what a shared word adds: all documents, those with
    the word, its uses in this one and this one's length. Only rows of asked
    words leave a document, counted; frequent words spread over the documents
    that have them, for their few items are on every side.
    """
    docs = docs.withColumn("dl", F.size("w"))
    n = docs.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))
    tf = docs.select("doc_id", "dl", F.explode("w").alias("token")).join(asked.select("token").distinct(), "token", "left_semi").groupBy("doc_id", "dl", "token").agg(F.count("*").alias("f"))
    df = tf.groupBy("token").agg(F.count("*").alias("df"))
    items = asked.join(df, "token").crossJoin(F.broadcast(n))
    rows = tf.join(items, "token")
    s = rows.groupBy("item_id", "doc_id").agg(F.round(F.sum(weight(F.col("n"), F.col("df"), F.col("f"), F.col("dl"))), 6).alias("score"), F.count("*").alias("n_shared"))
    w = Window.partitionBy("item_id").orderBy(F.col("score").desc(), "doc_id")
    best = s.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= k)
    return best.drop("rk") if with_shared else best.drop("n_shared")


@query("bm25_topk", _BM25)
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lexical search with all words of each question."""
    docs = read(spark, sf_dir, "documents").select("doc_id", T.tokens(F.col("text")).alias("w"))
    asked = read(spark, sf_dir, "benchmark").select("item_id", F.explode(F.array_distinct(T.tokens(F.col("text")))).alias("token"))
    return best_by_words(docs, asked, lambda n, df, f, dl: F.log(1 + (n - df + 0.5) / (df + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl / F.col("avgdl"))))


#: Words that say nothing about a subject (fixed values).
STOP = ("the", "and", "of", "to", "in", "is", "it", "that", "on", "was", "for", "der", "die", "und", "le", "la", "et", "el", "de", "que")


@query("idf_overlap_topk", _TOKENS + f""", dt AS (SELECT DISTINCT doc_id, token FROM t WHERE token NOT IN {STOP}), df AS (SELECT token, count(*) AS df FROM dt GROUP BY token), dl AS (SELECT doc_id, count(*) AS dl FROM dt GROUP BY doc_id),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS token FROM benchmark),
s AS (SELECT item_id, doc_id, round(sum(ln(1 + (SELECT count(*) FROM documents) / df)) / (1 + ln(1 + any_value(dl))), 6) AS score, count(*) AS n_shared FROM q JOIN dt USING (token) JOIN df USING (token) JOIN dl USING (doc_id) GROUP BY ALL)
SELECT item_id, doc_id, score, n_shared FROM s QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 5
""")
def idf_overlap_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shared words weighted by rarity and by the document's length, the best five documents of each item.

    Items are a stated set: their words go to each document's distinct words,
    so scores are sums within one document and no word's rows meet in one task.
    """
    docs = read(spark, sf_dir, "documents").select("doc_id", F.array_distinct(F.filter(T.tokens(F.col("text")), lambda x: ~x.isin(*STOP))).alias("w"))
    asked = read(spark, sf_dir, "benchmark").select("item_id", F.explode(F.array_distinct(T.tokens(F.col("text")))).alias("token"))
    return best_by_words(docs, asked, lambda n, df, f, dl: F.log(1 + n / df) / (1 + F.log(1 + dl)), with_shared=True)


_UN = "replace(replace(replace(replace(replace(replace(replace({x}, '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"
_CLEAN = "trim(regexp_replace(" + _UN.format(x="regexp_replace(regexp_replace(regexp_replace(html, '(?s)<script\\b.*?</script>', ' ', 'g'), '(?s)<style\\b.*?</style>', ' ', 'g'), '<[^>]*>', ' ', 'g')") + ", '[ \\t\\r\\n]+', ' ', 'g'))"


@query("html_clean", f"SELECT page_id, nullif({_CLEAN}, '') AS body, length(nullif({_CLEAN}, '')) AS n_chars FROM pages")
def html_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of pages."""
    return read(spark, sf_dir, "pages").select("page_id", T.clean(F.col("html")).alias("body")).withColumn("n_chars", F.length("body").cast("bigint"))


@query("html_links", "WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*href=\"([^\"]*)\"', 1)) AS href FROM pages) SELECT page_id, href, count(*) AS n FROM l GROUP BY ALL")
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages."""
    rows = read(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a\\s[^>]*href="([^"]*)"'), 1)).alias("href"))
    return rows.groupBy("page_id", "href").agg(F.count("*").alias("n"))


@query("markup_signature", "SELECT page_id, list_sort(list_distinct(regexp_extract_all(lower(html), '<([a-z][a-z0-9]*)', 1))) AS tags FROM pages")
def markup_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The set of tags that a page uses."""
    return read(spark, sf_dir, "pages").select("page_id", T.markup_signature(F.col("html")).alias("tags"))


@query("content_stream", "SELECT page_id, md5(regexp_replace(lower(" + _UN.format(x="regexp_replace(html, '<[^>]*>', ' ', 'g')") + "), '[^0-9a-z]+', '', 'g')) AS content, md5(regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '[ \\t\\r\\n]+', '', 'g')) AS strict FROM pages")
def content_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two digests of what a page says, tolerant and strict."""
    return read(spark, sf_dir, "pages").select("page_id", F.md5(T.content_stream(F.col("html"))).alias("content"), F.md5(T.strict_stream(F.col("html"))).alias("strict"))


@query("title_slugs", "WITH t AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages), s AS (SELECT page_id, title, left(regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 12) AS slug FROM t) SELECT page_id, slug || CASE WHEN row_number() OVER (PARTITION BY slug ORDER BY page_id) > 1 THEN '-' || row_number() OVER (PARTITION BY slug ORDER BY page_id) ELSE '' END AS slug FROM s")
def title_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names from titles; repeated ones get a number."""
    rows = read(spark, sf_dir, "pages").select("page_id", T.slug(F.regexp_extract("html", "<title>([^<]*)</title>", 1), 12).alias("slug"))
    nth = F.row_number().over(Window.partitionBy("slug").orderBy("page_id"))
    return rows.withColumn("n", nth).select("page_id", F.when(F.col("n") > 1, F.concat_ws("-", "slug", F.col("n").cast("string"))).otherwise(F.col("slug")).alias("slug"))


@query("url_parts", "SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '://([^/?#]*)', 1) AS host, regexp_extract(url, '://[^/?#]*(/[^?#]*)', 1) AS path, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page FROM pages")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheme, host, path and one parameter."""
    ext = lambda p: F.regexp_extract("url", p, 1)
    return read(spark, sf_dir, "pages").select("page_id", ext("^([a-z]+)://").alias("scheme"), ext("://([^/?#]*)").alias("host"), ext("://[^/?#]*(/[^?#]*)").alias("path"), F.nullif(ext("[?&]page=([^&#]*)"), F.lit("")).alias("page"))


@query("numeric_tokens", "WITH n AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, unnest(regexp_extract_all('pays ' || CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) || ',000 or ' || CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) || '% of it', '[0-9][0-9,]*(?:\\.[0-9]+)?%?')) AS x FROM lineitem) SELECT l_orderkey, replace(x, ',', '') AS number, count(*) AS n FROM n GROUP BY ALL")
def numeric_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of a text, normalised."""
    said = F.concat(F.lit("pays "), F.floor("l_extendedprice").cast("string"), F.lit(",000 or "), F.floor("l_quantity").cast("string"), F.lit("% of it"))
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", F.explode(T.numeric_tokens(said)).alias("number"))
    return rows.groupBy("l_orderkey", "number").agg(F.count("*").alias("n"))


@query("number_transpositions", "WITH n AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS x FROM orders), k AS (SELECT x, array_to_string(list_sort(string_split(x, '')), '') AS digits FROM n WHERE length(x) >= 3) SELECT x AS number, min(x) OVER w AS class, count(*) OVER w - 1 AS n_others FROM k WINDOW w AS (PARTITION BY digits) QUALIFY n_others > 0")
def number_transpositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that differ by the order of their digits alone, each with the first of its class; no pairs are made."""
    n = read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("number")).distinct().where(F.length("number") >= 3)
    return T.classes(n, "number", T.digit_signature(F.col("number")))


@query("window_chunks", "SELECT doc_id, CAST(i AS INTEGER) AS i, md5(substr(text, CAST(i * 2100 + 1 AS BIGINT), 2500)) AS digest FROM (SELECT doc_id, text, unnest(range(0, CAST(greatest(1, ceil((length(text) - 400) / 2100.0)) AS BIGINT))) AS i FROM documents)")
def window_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping windows of whole texts for embedding: 2,500 characters, 400 shared."""
    rows = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(T.text_windows(F.col("text"), 2500, 400)).alias("i", "w"))
    return rows.select("doc_id", "i", F.md5("w").alias("digest"))


@query("line_shapes", "WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) SELECT doc_id, count(*) AS n_lines, count(*) FILTER (length(line) BETWEEN 3 AND 120 AND regexp_matches(line, '^[A-Z0-9]') AND NOT regexp_matches(line, '[.;,]$')) AS n_titles, count(*) FILTER (length(line) > 60) AS n_long, CAST(sum(greatest(1, length(line) // 4)) AS BIGINT) AS token_estimate FROM l GROUP BY doc_id")
def line_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents: how many could be titles, token estimates."""
    lines = read(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(T.plausible_title(F.col("line"))).alias("n_titles"), F.count_if(F.length("line") > 60).alias("n_long"), F.sum(T.token_estimate(F.col("line"))).alias("token_estimate"))


_KEYS = "WITH k AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN chr(CAST(65 + o_orderkey % 4 AS INTEGER)) || (o_orderkey % 7) WHEN 1 THEN chr(CAST(65 + o_orderkey % 4 AS INTEGER)) || (o_orderkey % 7) || '.' || (o_orderkey % 5) ELSE chr(CAST(65 + o_orderkey % 4 AS INTEGER)) || (o_orderkey % 7) || '.' || (o_orderkey % 5) || '(' || chr(CAST(97 + o_orderkey % 3 AS INTEGER)) || ')' END AS key FROM orders)\n"


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clause keys of up to three levels, made from order keys."""
    k = F.col("o_orderkey")
    top = F.concat(F.char((65 + k % 4).cast("int")), (k % 7).cast("string"))
    mid = F.concat(top, F.lit("."), (k % 5).cast("string"))
    low = F.concat(mid, F.lit("("), F.char((97 + k % 3).cast("int")), F.lit(")"))
    return read(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 3 == 0, top).when(k % 3 == 1, mid).otherwise(low).alias("key"))


@query("clause_parents", _KEYS + "SELECT DISTINCT key, CASE WHEN ends_with(key, ')') THEN regexp_replace(key, '\\([^()]*\\)$', '') WHEN contains(key, '.') THEN regexp_replace(key, '\\.[^.]*$', '') END AS parent FROM k")
def clause_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clause keys and the keys one level up."""
    rows = keys(spark, sf_dir).select("key").distinct()
    return rows.select("key", T.parent_key(F.col("key")).alias("parent"))


@query("clause_refs", _KEYS + "SELECT o_orderkey // 10 AS g, list_sort(list_distinct(regexp_extract_all('see ' || string_agg(key, ' and ' ORDER BY o_orderkey) || '; a2 Z', '\\b([A-Z][0-9]+(?:\\.[0-9]+)*(?:\\([a-z]\\))?)', 1))) AS refs FROM k GROUP BY 1")
def clause_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clause references of a text."""
    rows = keys(spark, sf_dir).groupBy(F.floor(F.col("o_orderkey") / 10).alias("g")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "key"))), lambda x: x["key"]), " and ").alias("t"))
    return rows.select("g", T.clause_refs(F.concat(F.lit("see "), F.col("t"), F.lit("; a2 Z"))).alias("refs"))


@query("ancestor_matches", _KEYS + ", u AS (SELECT DISTINCT key FROM k) SELECT a.key AS gold, b.key AS found FROM u a JOIN u b ON b.key = a.key OR (starts_with(b.key, a.key) AND substr(b.key, length(a.key) + 1, 1) IN ('.', '('))")
def ancestor_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key with itself and its descendants: each key lists its ancestors, then an equi-join."""
    rows = keys(spark, sf_dir).select("key").distinct()
    one, two = T.parent_key(F.col("key")), T.parent_key(T.parent_key(F.col("key")))
    up = rows.select(F.col("key").alias("found"), F.explode(F.array_compact(F.array(F.col("key"), one, two))).alias("gold"))
    return up.join(rows.withColumnRenamed("key", "gold"), "gold", "left_semi").select("gold", "found")


@query("scoped_definitions", "SELECT o_orderpriority, count(*) AS n, min(regexp_extract(o_orderpriority, '^([0-9])-(.*)$', 1)) AS rank, min(lower(regexp_extract(o_orderpriority, '^([0-9])-(.*)$', 2))) AS name FROM orders GROUP BY 1")
def scoped_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels parsed into rank and name."""
    rows = read(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return rows.select("o_orderpriority", "n", F.regexp_extract("o_orderpriority", "^([0-9])-(.*)$", 1).alias("rank"), F.lower(F.regexp_extract("o_orderpriority", "^([0-9])-(.*)$", 2)).alias("name"))


@query("named_terms", "WITH a AS (SELECT lower(n_name) AS alias, n_name AS name FROM nation UNION ALL SELECT lower(r_name), r_name FROM region), q AS (SELECT c_custkey, lower('ship from ' || n_name || ' to ' || r_name || ' soon') AS said FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey), w AS (SELECT c_custkey, unnest(list_distinct(regexp_extract_all(said, '[a-z0-9_]+'))) AS alias FROM q) SELECT c_custkey, list_sort(list(name)) AS named FROM w JOIN a USING (alias) GROUP BY c_custkey")
def named_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole words of a question that a dictionary of names knows."""
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    alias = nation.select(F.lower("n_name").alias("alias"), F.col("n_name").alias("name")).unionByName(region.select(F.lower("r_name").alias("alias"), F.col("r_name").alias("name")))
    said = read(spark, sf_dir, "customer").join(nation, F.col("n_nationkey") == F.col("c_nationkey")).join(region, F.col("r_regionkey") == F.col("n_regionkey"))
    said = said.select("c_custkey", F.lower(F.concat(F.lit("ship from "), "n_name", F.lit(" to "), "r_name", F.lit(" soon"))).alias("said"))
    words = said.select("c_custkey", F.explode(F.array_distinct(F.regexp_extract_all("said", F.lit("([a-z0-9_]+)"), 1))).alias("alias"))
    return words.join(alias, "alias").groupBy("c_custkey").agg(F.array_sort(F.collect_list("name")).alias("named"))


@query("failure_causes", "SELECT CASE WHEN event_type = 'error' AND value < 5 THEN 'timeout' WHEN event_type = 'error' AND props LIKE '%7%' THEN 'memory' WHEN event_type = 'error' THEN 'other' ELSE 'none' END AS cause, count(*) AS n, count(DISTINCT user_id) AS n_users FROM events GROUP BY 1")
def failure_causes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered patterns name a failure's cause."""
    failed = F.col("event_type") == "error"
    cause = F.when(failed & (F.col("value") < 5), "timeout").when(failed & F.col("props").contains("7"), "memory").when(failed, "other").otherwise("none")
    return read(spark, sf_dir, "events").groupBy(cause.alias("cause")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("n_users"))
