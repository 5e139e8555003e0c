"""Filters, validators, ladders, scores and interview rules as ordered expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..sources.tables import read
from .catalog import query

_PRODUCTS = "WITH p AS (SELECT c_custkey AS id, [{{'id': c_custkey % 4, 'name': 'P' || (c_custkey % 5)}}, {{'id': c_custkey % 7, 'name': c_mktsegment}}] AS products FROM customer)\n".replace("{{", "{").replace("}}", "}")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a nested list of products."""
    k = F.col("c_custkey")
    item = lambda i, n: F.struct(i.alias("id"), n.alias("name"))
    return read(spark, sf_dir, "customer").select(k.alias("id"), F.array(item(k % 4, F.concat(F.lit("P"), (k % 5).cast("string"))), item(k % 7, F.col("c_mktsegment"))).alias("products"))


@query("product_filter", _PRODUCTS + "SELECT id FROM p WHERE len(list_filter(products, lambda x: x.id IN (3, 5) OR x.name IN ('BUILDING', 'P1'))) > 0")
def product_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of any of some products; numbers mean ids, words mean names."""
    return products(spark, sf_dir).where(R.any_product("products", ["3", "BUILDING", "5", "P1"])).select("id")


@query("all_filters", _PRODUCTS + "SELECT id FROM p WHERE len(list_filter(products, lambda x: x.id IN (1, 2, 3))) > 0 AND len(list_filter(products, lambda x: x.name IN ('P1', 'P2'))) > 0 AND id % 3 <> 0")
def all_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is allowed and what is asked for, together."""
    return products(spark, sf_dir).where(R.any_product("products", ["1", "2", "3"]) & R.any_product("products", ["P1", "P2"]) & (F.col("id") % 3 != 0)).select("id")


@query("kinds_excluded", "SELECT 'C' || c_custkey AS key, CASE c_custkey % 4 WHEN 0 THEN 'alert' WHEN 1 THEN 'guidance' ELSE 'clause' END AS kind FROM customer WHERE c_custkey % 4 > 1")
def kinds_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows but for some kinds."""
    k = F.col("c_custkey")
    kind = F.when(k % 4 == 0, "alert").when(k % 4 == 1, "guidance").otherwise("clause")
    return read(spark, sf_dir, "customer").select(F.concat(F.lit("C"), k.cast("string")).alias("key"), kind.alias("kind")).where(~F.col("kind").isin("alert", "guidance"))


_STYLES = "WITH s AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'Heading ' || (1 + p_partkey % 4) WHEN 1 THEN 'heading' || (1 + p_partkey % 3) WHEN 2 THEN 'Title' WHEN 3 THEN 'List Bullet' ELSE 'Body Text ' || (p_partkey % 3) END AS style, p_name AS text FROM part)\n"


def styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs with a named style."""
    k = F.col("p_partkey")
    n = lambda m, b=1: (b + k % m).cast("string")
    style = F.when(k % 6 == 0, F.concat(F.lit("Heading "), n(4))).when(k % 6 == 1, F.concat(F.lit("heading"), n(3))).when(k % 6 == 2, "Title").when(k % 6 == 3, "List Bullet").otherwise(F.concat(F.lit("Body Text "), n(3, 0)))
    return read(spark, sf_dir, "part").select("p_partkey", style.alias("style"), F.col("p_name").alias("text"))


@query("style_levels", _STYLES + "SELECT style, CASE WHEN regexp_matches(style, '(?i)^heading *[0-9]') THEN CAST(regexp_extract(style, '([0-9]+)', 1) AS INTEGER) WHEN lower(style) = 'title' THEN 0 END AS level, count(*) AS n FROM s GROUP BY ALL")
def style_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heading levels by the names of styles."""
    return styles(spark, sf_dir).groupBy("style").agg(F.count("*").alias("n")).select("style", R.style_level(F.col("style")).alias("level"), "n")


@query("style_medians", _STYLES + "SELECT style, median(length(text)) AS middle, median(length(text)) <= 11 AS is_heading FROM s GROUP BY style")
def style_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A style is one of headings if its paragraphs are short in the median."""
    return styles(spark, sf_dir).groupBy("style").agg(F.median(F.length("text")).alias("middle")).withColumn("is_heading", F.col("middle") <= 11)


@query("valid_names", "SELECT s_suppkey, regexp_matches('v' || (s_suppkey % 7) || '.' || s_suppkey || CASE WHEN s_suppkey % 3 = 0 THEN '/x' ELSE '' END, '^[a-z0-9][a-z0-9._-]{0,48}$') AS version_ok, regexp_matches(s_name || CASE WHEN s_suppkey % 4 = 0 THEN ' ' ELSE '' END, '^[A-Za-z0-9][A-Za-z0-9._-]{0,63}$') AS run_ok FROM supplier")
def valid_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Are names of versions and runs well formed?"""
    k = F.col("s_suppkey")
    version = F.concat(F.lit("v"), (k % 7).cast("string"), F.lit("."), k.cast("string"), F.when(k % 3 == 0, "/x").otherwise(""))
    run = F.concat("s_name", F.when(k % 4 == 0, " ").otherwise(""))
    return read(spark, sf_dir, "supplier").select("s_suppkey", R.valid_version(version).alias("version_ok"), R.valid_run(run).alias("run_ok"))


#: Products whose name may follow that of a place.
PRODUCTS = ("Red Notes", "Blue Notes")
_NAMES = "WITH n AS (SELECT s_suppkey, n_name || CASE s_suppkey % 4 WHEN 0 THEN ' (Long Form)' WHEN 1 THEN ' - Red Notes' ELSE '' END AS name FROM supplier JOIN nation ON n_nationkey = s_nationkey)\n"


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of places with additions."""
    k = F.col("s_suppkey")
    rows = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    return rows.select("s_suppkey", F.concat("n_name", F.when(k % 4 == 0, " (Long Form)").when(k % 4 == 1, " - Red Notes").otherwise("")).alias("name"))


@query("canonical_names", _NAMES + "SELECT s_suppkey, trim(regexp_replace(regexp_replace(name, '\\s*\\([^)]*\\)$', ''), ' - (Red Notes|Blue Notes)$', '')) AS place FROM n")
def canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of places without what products add."""
    return names(spark, sf_dir).select("s_suppkey", R.canonical_place(F.col("name"), PRODUCTS).alias("place"))


@query("regions_of", _NAMES + "SELECT s_suppkey, CASE WHEN starts_with(name, 'NATION_1') THEN 'ones' WHEN regexp_replace(regexp_replace(name, '\\s*\\([^)]*\\)$', ''), ' - .*$', '') IN ('NATION_2', 'NATION_3') THEN 'listed' ELSE 'Other' END AS region FROM n")
def regions_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A region by prefix, then by dictionary, else another one."""
    place = R.canonical_place(F.col("name"), PRODUCTS)
    region = F.when(F.startswith("name", F.lit("NATION_1")), "ones").otherwise(F.coalesce(F.element_at(F.create_map(*[F.lit(x) for x in ("NATION_2", "listed", "NATION_3", "listed")]), place), F.lit("Other")))
    return names(spark, sf_dir).select("s_suppkey", region.alias("region"))


@query("ordered_union", "WITH u AS (SELECT c_custkey AS id, x.k AS name, x.p FROM customer, (VALUES (1), (2), (3)) v(p), LATERAL (SELECT CASE p WHEN 1 THEN 'n' || (c_custkey % 5) WHEN 2 THEN 'n' || (c_custkey % 3) ELSE 'n' || (c_custkey % 2) END AS k, p) x), m AS (SELECT id, name, min(p) AS p FROM u GROUP BY ALL) SELECT id, list(name ORDER BY p, name) AS names FROM m GROUP BY id")
def ordered_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact, fuzzy and bare matches together, each name where it came first."""
    k = F.col("c_custkey")
    n = lambda m: F.array(F.concat(F.lit("n"), (k % m).cast("string")))
    return read(spark, sf_dir, "customer").select(k.alias("id"), F.array_distinct(F.concat(n(5), n(3), n(2))).alias("names"))


@query("suggest_contexts", _PRODUCTS + "SELECT id, list_concat(CASE WHEN id % 3 = 0 THEN ['_all'] ELSE [x.name FOR x IN products] END, ['_any']) AS contexts FROM p")
def suggest_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contexts of a suggestion: its places or a mark for all, always one that matches any query."""
    own = F.when(F.col("id") % 3 == 0, F.array(F.lit("_all"))).otherwise(F.transform("products", lambda x: x["name"]))
    return products(spark, sf_dir).select("id", F.concat(own, F.array(F.lit("_any"))).alias("contexts"))


_JOBS = "WITH j AS (SELECT doc_id, source AS product, 100.0::DOUBLE - n_chars % 41 AS a, 100.0::DOUBLE - (n_chars * 7) % 53 AS b, 40.0::DOUBLE + doc_id % 61 AS cov, CAST(doc_id % 4 AS INTEGER) AS gone, CAST(doc_id % 3 AS INTEGER) AS depth, doc_id % 2 = 0 AS long_runs FROM documents)\n"


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two attempts at each document with scores, coverage, pages gone and how they were built."""
    d, n = F.col("doc_id"), F.col("n_chars")
    return read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("product"), (100.0 - n % 41).alias("a"), (100.0 - (n * 7) % 53).alias("b"), (40.0 + d % 61).alias("cov"), (d % 4).cast("int").alias("gone"), (d % 3).cast("int").alias("depth"), (d % 2 == 0).alias("long_runs"))


@query("tier_choice", _JOBS + "SELECT doc_id, CASE WHEN a >= 90 AND b < 90 THEN 'keep' WHEN b >= 90 AND a < 90 THEN 'replace' WHEN b > a + 2 THEN 'replace' WHEN b < a - 2 THEN 'keep' WHEN a <= 62 AND b <= 62 AND cov > 70 THEN 'replace' ELSE 'keep' END AS choice FROM j")
def tier_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Does another attempt replace what there is? Acceptable beats not, then the score by a margin, detail only at the floor."""
    a, b = F.col("a"), F.col("b")
    return jobs(spark, sf_dir).select("doc_id", R.better_tier(a, b, accept=90, margin=2, floor=(a <= 62) & (b <= 62), detail=F.col("cov") > 70).alias("choice"))


@query("build_mismatches", _JOBS + ", r AS (SELECT * FROM (VALUES ('src0', 2, true), ('src1', 1, false), ('src2', 2, false)) v(product, want_depth, want_runs)) SELECT doc_id, concat_ws('; ', CASE WHEN depth <> coalesce(want_depth, 2) THEN 'depth ' || depth || ' not ' || coalesce(want_depth, 2) END, CASE WHEN long_runs <> coalesce(want_runs, false) THEN 'clause tables' END) AS mismatch FROM j LEFT JOIN r USING (product)")
def build_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How a tree was built against its product's rule; a product without one has the default."""
    rule = F.create_map(*[y for p, d, t in (("src0", 2, True), ("src1", 1, False), ("src2", 2, False)) for y in (F.lit(p), F.struct(F.lit(d).alias("depth"), F.lit(t).alias("runs")))])
    own = F.try_element_at(rule, F.col("product"))
    want, runs = F.coalesce(own["depth"], F.lit(2)), F.coalesce(own["runs"], F.lit(False))
    said = F.concat_ws("; ", F.when(F.col("depth") != want, F.concat(F.lit("depth "), F.col("depth").cast("string"), F.lit(" not "), want.cast("string"))), F.when(F.col("long_runs") != runs, F.lit("clause tables")))
    return jobs(spark, sf_dir).select("doc_id", said.alias("mismatch"))


@query("table_credits", """
WITH t AS (SELECT page_id, length(html) AS n, regexp_matches(html, '<ul>') AS a, html LIKE '%<b>%' AS b, url LIKE '%?%' AS c, url LIKE '%#%' AS d, url LIKE 'https%' AS e FROM pages WHERE html IS NOT NULL AND url IS NOT NULL),
k AS (SELECT CASE WHEN NOT a THEN 'reclassified' WHEN c THEN CASE WHEN NOT e THEN 'failed' ELSE 'continuation' END WHEN d THEN 'absorbed' WHEN NOT b THEN 'failed' WHEN n > 6000 THEN 'unverified' WHEN n > 4000 THEN 'uncertain' ELSE 'confident' END AS bucket, c AND e AND b AS verified FROM t)
SELECT bucket, count(*) AS n, round(sum(CASE WHEN bucket IN ('reclassified', 'confident') OR bucket = 'continuation' AND verified THEN 1.0::DOUBLE WHEN bucket = 'failed' THEN 0.25 WHEN bucket = 'uncertain' THEN 0.6 ELSE 0.75 END), 4) AS credit FROM k GROUP BY bucket
""")
def table_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each table's state is worth, by bucket; a page's markup and url stand for the state."""
    html, url = F.col("html"), F.col("url")
    holds = lambda c, t: F.contains(c, F.lit(t))
    state = F.struct(
        (~holds(html, "<ul>")).alias("false_positive"), holds(url, "?").alias("continuation"), F.when(~F.startswith(url, F.lit("https")), False).when(holds(html, "<b>"), True).alias("verified"), holds(url, "#").alias("absorbed"),
        holds(html, "<b>").alias("ok"), F.when(F.length(html) > 6000, "rank").when(F.length(html) > 4000, "uncertain").otherwise("sure").alias("match"),
    )
    bucket, credit = R.table_credit(F.col("state"))
    rows = read(spark, sf_dir, "pages").where("html is not null and url is not null").select(state.alias("state"))
    return rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), F.round(F.sum(credit), 4).alias("credit"))


@query("accept_reasons", _JOBS + "SELECT doc_id, a >= 60 AND cov >= 50 AND gone < 3 AS accepted, concat_ws('; ', CASE WHEN a < 60 THEN 'score ' || CAST(a AS INTEGER) || ' < 60' END, CASE WHEN cov < 50 THEN 'coverage' END, CASE WHEN gone >= 3 THEN 'pages missing' END) AS reasons FROM j")
def accept_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is a result good enough to stop, and if not, why not?"""
    low, thin, holes = F.col("a") < 60, F.col("cov") < 50, F.col("gone") >= 3
    said = F.concat_ws("; ", F.when(low, F.concat(F.lit("score "), F.col("a").cast("int").cast("string"), F.lit(" < 60"))), F.when(thin, F.lit("coverage")), F.when(holes, F.lit("pages missing")))
    return jobs(spark, sf_dir).select("doc_id", (~low & ~thin & ~holes).alias("accepted"), said.alias("reasons"))


@query("trigger_causes", _JOBS + ", t AS (SELECT doc_id, concat_ws('; ', CASE WHEN a < 80 THEN 'completeness ' || CAST(a AS INTEGER) || ' < 80' END, CASE WHEN b < 80 THEN 'fidelity ' || CAST(b AS INTEGER) || ' < 80' END) AS reason FROM j), c AS (SELECT doc_id, unnest(string_split(reason, '; ')) AS c FROM t WHERE reason <> ''), p AS (SELECT doc_id, regexp_extract(c, '^([a-z]+) ([0-9]+) < ([0-9]+)$', 1) AS dim, CAST(regexp_extract(c, ' ([0-9]+) <', 1) AS DOUBLE) AS score FROM c) SELECT doc_id, arg_min(dim, (score, dim)) AS primary_cause, min(score) AS score, count(*) AS n_causes FROM p GROUP BY doc_id")
def trigger_causes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons such as ``completeness 35 < 60`` parsed; the lowest score is the primary cause."""
    part = lambda col, name: F.when(F.col(col) < 80, F.concat(F.lit(f"{name} "), F.col(col).cast("int").cast("string"), F.lit(" < 80")))
    reasons = jobs(spark, sf_dir).select("doc_id", F.concat_ws("; ", part("a", "completeness"), part("b", "fidelity")).alias("r")).where("r <> ''")
    causes = reasons.select("doc_id", F.explode(F.split("r", "; ")).alias("c")).select("doc_id", R.trigger(F.col("c")).alias("t"))
    return causes.groupBy("doc_id").agg(F.min_by("t.dimension", F.struct("t.score", "t.dimension")).alias("primary_cause"), F.min("t.score").alias("score"), F.count("*").alias("n_causes"))


@query("dismissed_findings", "WITH f AS (SELECT event_id, user_id AS file, event_type AS kind, 'k' || (event_id % 500) AS key FROM events), d AS (SELECT DISTINCT 'k' || (o_orderkey % 500) AS key FROM orders WHERE o_orderkey % 7 = 0) SELECT kind, count(*) AS n_listed, count(*) FILTER (d.key IS NULL) AS n_scored FROM f LEFT JOIN d USING (key) GROUP BY kind")
def dismissed_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings that a reviewer dismissed stay listed but aren't scored."""
    f = read(spark, sf_dir, "events").select(F.col("event_type").alias("kind"), F.concat(F.lit("k"), (F.col("event_id") % 500).cast("string")).alias("key"))
    d = read(spark, sf_dir, "orders").where("o_orderkey % 7 = 0").select(F.concat(F.lit("k"), (F.col("o_orderkey") % 500).cast("string")).alias("key")).distinct().withColumn("d", F.lit(1))
    return f.join(d, "key", "left").groupBy("kind").agg(F.count("*").alias("n_listed"), F.count_if(F.col("d").isNull()).alias("n_scored"))


@query("finding_union", "SELECT 'gap' AS kind, doc_id AS file, CAST(n_chars % 7 AS BIGINT) AS n, NULL::VARCHAR AS note FROM documents WHERE n_chars % 7 > 3 UNION ALL SELECT 'number', doc_id, 1, lang FROM documents WHERE doc_id % 6 = 0 UNION ALL SELECT 'table', page_id, NULL, 'html' FROM pages WHERE page_id % 5 = 0")
def finding_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All detectors' findings under one schema; what one doesn't know is null."""
    d = read(spark, sf_dir, "documents")
    gap = d.where("n_chars % 7 > 3").select(F.lit("gap").alias("kind"), F.col("doc_id").alias("file"), (F.col("n_chars") % 7).cast("bigint").alias("n"))
    number = d.where("doc_id % 6 = 0").select(F.lit("number").alias("kind"), F.col("doc_id").alias("file"), F.lit(1).cast("bigint").alias("n"), F.col("lang").alias("note"))
    table = read(spark, sf_dir, "pages").where("page_id % 5 = 0").select(F.lit("table").alias("kind"), F.col("page_id").alias("file"), F.lit("html").alias("note"))
    return gap.unionByName(number, allowMissingColumns=True).unionByName(table, allowMissingColumns=True)


_STAGES = "WITH s AS (SELECT o_orderkey, o_custkey, o_orderstatus AS status, o_totalprice AS total, CAST(o_orderkey % 11 AS INTEGER) AS done, CAST(o_orderkey % 3 AS INTEGER) AS failed, o_orderkey % 13 = 0 AS stop_asked, o_orderkey % 17 AS silent FROM orders)\n"


@query("stage_ladder", _STAGES + "SELECT o_orderkey, CASE WHEN failed = 2 AND done = 0 THEN 'failed' WHEN done >= 10 THEN 'complete' WHEN status = 'F' THEN 'skipped' WHEN done = 0 AND silent < 5 THEN 'waiting' WHEN silent >= 12 THEN 'stalled' WHEN stop_asked THEN 'stopping' WHEN done > 0 THEN 'running' ELSE 'queued' END AS state, round(least(1.0::DOUBLE, (done + failed) / 10.0), 4) AS share FROM s")
def stage_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage's state by the first rule that applies; silence is seen before a stop that was asked for."""
    k, c = F.col("o_orderkey"), F.col
    rows = read(spark, sf_dir, "orders").select("o_orderkey", c("o_orderstatus").alias("status"), (k % 11).cast("int").alias("done"), (k % 3).cast("int").alias("failed"), (k % 13 == 0).alias("stop"), (k % 17).alias("silent"))
    state = R.ladder([((c("failed") == 2) & (c("done") == 0), "failed"), (c("done") >= 10, "complete"), (c("status") == "F", "skipped"), ((c("done") == 0) & (c("silent") < 5), "waiting"), (c("silent") >= 12, "stalled"), (c("stop"), "stopping"), (c("done") > 0, "running")], "queued")
    return rows.select("o_orderkey", state.alias("state"), F.round(F.least(F.lit(1.0), (c("done") + c("failed")) / 10.0), 4).alias("share"))


@query("frozen_clock", "WITH w AS (SELECT user_id % 8 AS shard, min(ts) AS started, max(ts) AS seen, count(*) AS n, arg_max(event_type, (ts, event_id)) AS last FROM events GROUP BY 1) SELECT shard, CAST(epoch(CASE WHEN last IN ('purchase', 'error') THEN seen ELSE TIMESTAMP '2024-02-01' END - started) AS BIGINT) AS elapsed, CASE WHEN last NOT IN ('purchase', 'error') THEN round(1000.0::DOUBLE * epoch(TIMESTAMP '2024-02-01' - started) / n, 2) END AS eta FROM w")
def frozen_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A worker's clock stops with its last event once it has ended; then there is nothing left to estimate."""
    w = read(spark, sf_dir, "events").groupBy((F.col("user_id") % 8).alias("shard")).agg(F.min("ts").alias("started"), F.max("ts").alias("seen"), F.count("*").alias("n"), F.max_by("event_type", F.struct("ts", "event_id")).alias("last"))
    ended, now = F.col("last").isin("purchase", "error"), F.expr("timestamp_ntz '2024-02-01 00:00:00'")
    secs = lambda a, b: (F.unix_micros(a.cast("timestamp")) - F.unix_micros(b.cast("timestamp"))) / 1e6
    elapsed = secs(F.when(ended, F.col("seen")).otherwise(now), F.col("started"))
    return w.select("shard", F.round(elapsed).cast("bigint").alias("elapsed"), F.when(~ended, F.round(1000.0 * secs(now, F.col("started")) / F.col("n"), 2)).alias("eta"))


@query("heartbeat", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS beat, user_id % 8 AS shard, count(*) AS n, max(ts) AS seen FROM events GROUP BY ALL")
def heartbeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signs of life of each worker by hour."""
    rows = read(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour").alias("w"), (F.col("user_id") % 8).alias("shard")).agg(F.count("*").alias("n"), F.max("ts").alias("seen"))
    return rows.select(F.col("w.start").alias("beat"), "shard", "n", "seen")


@query("interrupted_jobs", "WITH e AS (SELECT user_id AS label, max(ts) FILTER (event_type = 'login') AS began, max(ts) FILTER (event_type = 'purchase') AS done FROM events GROUP BY 1) SELECT count(*) FILTER (done IS NOT NULL AND (began IS NULL OR done >= began)) AS n_done, count(*) FILTER (began IS NOT NULL AND (done IS NULL OR done < began)) AS n_again, count(*) FILTER (began IS NULL AND done IS NULL) AS n_fresh FROM e")
def interrupted_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was in flight when a worker ended is done again and not counted as done."""
    last = lambda t: F.max(F.when(F.col("event_type") == t, F.col("ts")))
    e = read(spark, sf_dir, "events").groupBy("user_id").agg(last("login").alias("began"), last("purchase").alias("done"))
    done, again = F.expr("done is not null and (began is null or done >= began)"), F.expr("began is not null and (done is null or done < began)")
    return e.agg(F.count_if(done).alias("n_done"), F.count_if(again).alias("n_again"), F.count_if(F.expr("began is null and done is null")).alias("n_fresh"))


@query("timing_passes", "WITH t AS (SELECT user_id % 20 AS job, event_type AS step, value, ts, event_id FROM events), p AS (SELECT job, CASE WHEN step IN ('purchase', 'logout') THEN step ELSE 'first' END AS pass, value, CASE WHEN step IN ('purchase', 'logout') THEN ts END AS began FROM t WHERE step <> 'view'), g AS (SELECT job, pass, round(sum(value), 4) AS seconds, min(began) AS began FROM p GROUP BY ALL) SELECT job, pass, seconds, CAST(row_number() OVER (PARTITION BY job ORDER BY pass <> 'first', began, pass) AS INTEGER) AS place FROM g")
def timing_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composite steps are passes of their own in the order they ran, all others together the first; totals are left out."""
    own = F.col("event_type").isin("purchase", "logout")
    rows = read(spark, sf_dir, "events").where("event_type <> 'view'").select((F.col("user_id") % 20).alias("job"), F.when(own, F.col("event_type")).otherwise("first").alias("pass"), "value", F.when(own, F.col("ts")).alias("at"))
    g = rows.groupBy("job", "pass").agg(F.round(F.sum("value"), 4).alias("seconds"), F.min("at").alias("at"))
    w = Window.partitionBy("job").orderBy(F.col("pass") != "first", F.col("at"), "pass")
    return g.select("job", "pass", "seconds", F.row_number().over(w).alias("place"))


_RULES = "WITH r AS (SELECT * FROM (VALUES ('category', 'DE', 'offer', 'fund'), ('category', 'DE', 'offer', 'share'), ('category', 'US', 'offer', 'share'), ('category', '*', 'advise', 'any'), ('investor', 'DE', '*', 'retail'), ('investor', '*', '*', 'professional')) v(field, place, activity, choice)), s AS (SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN 'FR' WHEN 1 THEN 'DE' ELSE 'US' END AS place, CASE c_custkey % 2 WHEN 0 THEN 'offer' ELSE 'advise' END AS activity FROM customer)\n"


@query("interview_options", _RULES + "SELECT id, field, list_sort(list(choice)) AS choices FROM s JOIN r ON r.place IN (s.place, '*') AND r.activity IN (s.activity, '*') GROUP BY id, field")
def interview_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Choices that a vocabulary offers for each field, by place and activity; a star stands for all."""
    rules = [("category", "DE", "offer", "fund"), ("category", "DE", "offer", "share"), ("category", "US", "offer", "share"), ("category", "*", "advise", "any"), ("investor", "DE", "*", "retail"), ("investor", "*", "*", "professional")]
    r = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(x, ("field", "place", "activity", "choice"), strict=True)]) for x in rules])
    k = F.col("c_custkey")
    s = read(spark, sf_dir, "customer").select(k.alias("id"), F.when(k % 3 == 0, "FR").when(k % 3 == 1, "DE").otherwise("US").alias("place"), F.when(k % 2 == 0, "offer").otherwise("advise").alias("activity"))
    fits = s.select("*", F.explode(r).alias("r")).where("r.place in (place, '*') and r.activity in (activity, '*')")
    return fits.groupBy("id", F.col("r.field").alias("field")).agg(F.array_sort(F.collect_list("r.choice")).alias("choices"))


@query("acknowledgements", "WITH s AS (SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'DE' ELSE 'US' END AS a0, CASE c_custkey % 4 WHEN 0 THEN 'FR' WHEN 1 THEN 'DE' END AS a1, CASE c_custkey % 5 WHEN 0 THEN 'fund' END AS b0, 'share' AS b1 FROM customer) SELECT id, concat_ws('; ', CASE WHEN a1 IS NOT NULL AND a1 IS DISTINCT FROM a0 THEN 'place: ' || a1 END, CASE WHEN b1 IS DISTINCT FROM b0 THEN 'category: ' || b1 END) AS said FROM s")
def acknowledgements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed in an interview, said back."""
    k = F.col("c_custkey")
    before = [("place", F.when(k % 3 == 1, "DE").when(k % 3 == 2, "US"), F.when(k % 4 == 0, "FR").when(k % 4 == 1, "DE")), ("category", F.when(k % 5 == 0, "fund"), F.lit("share"))]
    return read(spark, sf_dir, "customer").select(k.alias("id"), R.acknowledged(before).alias("said"))


@query("section_hints", "WITH s AS (SELECT c_custkey AS id, CASE c_custkey % 2 WHEN 0 THEN ['Scope', 'Offers'] ELSE ['Advice'] END AS a, CASE c_custkey % 3 WHEN 0 THEN ['Scope', 'Investors'] ELSE ['Penalties'] END AS b FROM customer) SELECT id, list_concat(a, list_filter(b, lambda x: NOT list_contains(a, x))) AS titles FROM s")
def section_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that the answers point to, in order, each once."""
    k = F.col("c_custkey")
    lit = lambda *x: F.array(*map(F.lit, x))
    return read(spark, sf_dir, "customer").select(k.alias("id"), F.array_distinct(F.concat(F.when(k % 2 == 0, lit("Scope", "Offers")).otherwise(lit("Advice")), F.when(k % 3 == 0, lit("Scope", "Investors")).otherwise(lit("Penalties")))).alias("titles"))


@query("titled_sections", "WITH t AS (SELECT lower(trim(p_name)) AS t, min(p_partkey) AS key FROM part GROUP BY 1), q AS (SELECT s_suppkey, '  ' || upper(p_name) || ' ' AS said FROM supplier JOIN part ON p_partkey = s_suppkey * 3) SELECT s_suppkey, key FROM q LEFT JOIN t ON lower(trim(said)) = t")
def titled_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections by title, whatever its case; of equal titles the first."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    t = part.groupBy(F.lower(F.trim("p_name")).alias("t")).agg(F.min("p_partkey").alias("key"))
    q = read(spark, sf_dir, "supplier").join(part, F.col("p_partkey") == F.col("s_suppkey") * 3).select("s_suppkey", F.lower(F.trim(F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")))).alias("t"))
    return q.join(t, "t", "left").select("s_suppkey", "key")


@query("lenient_json", "WITH r AS (SELECT event_id, 'Sure: ' || CASE event_id % 4 WHEN 0 THEN '{\"lane\": \"' || event_type || '\", \"score\": ' || (event_id % 9) || '} ok' WHEN 1 THEN '```json {\"lane\": \"view\"} ```' WHEN 2 THEN 'no object here' ELSE '{\"lane\": \"other\", \"score\": 1}' END AS reply FROM events), j AS (SELECT event_id, regexp_extract(reply, '(\\{[^{}]*\\})', 1) AS o FROM r) SELECT event_id, CASE WHEN json_extract_string(nullif(o, ''), '$.lane') IN ('login', 'logout', 'view', 'click', 'purchase') THEN json_extract_string(nullif(o, ''), '$.lane') END AS lane, CAST(json_extract_string(nullif(o, ''), '$.score') AS INTEGER) AS score FROM j")
def lenient_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object out of a talkative reply; values outside the list are dropped."""
    k = F.col("event_id")
    reply = F.when(k % 4 == 0, F.concat(F.lit('{"lane": "'), "event_type", F.lit('", "score": '), (k % 9).cast("string"), F.lit("} ok"))).when(k % 4 == 1, '```json {"lane": "view"} ```').when(k % 4 == 2, "no object here").otherwise('{"lane": "other", "score": 1}')
    found = R.json_object(F.concat(F.lit("Sure: "), reply), "lane string, score int")
    rows = read(spark, sf_dir, "events").select("event_id", found.alias("o"))
    return rows.select("event_id", F.when(F.col("o.lane").isin("login", "logout", "view", "click", "purchase"), F.col("o.lane")).alias("lane"), F.col("o.score").alias("score"))


@query("index_coverage_audit", "WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents), c AS (SELECT CASE WHEN trim(line) = '' THEN 'blank' WHEN length(line) < 20 THEN 'short' WHEN regexp_matches(line, '[{}<>]') THEN 'markup' ELSE 'kept' END AS reason, len(regexp_extract_all(line, '[^ ]+')) AS n FROM l) SELECT reason, count(*) AS n_lines, CAST(sum(n) AS BIGINT) AS n_words FROM c GROUP BY reason")
def index_coverage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that an index takes, and those that it leaves out, by reason."""
    line = F.col("line")
    reason = F.when(F.trim(line) == "", "blank").when(F.length(line) < 20, "short").when(line.rlike("[{}<>]"), "markup").otherwise("kept")
    rows = read(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    return rows.groupBy(reason.alias("reason")).agg(F.count("*").alias("n_lines"), F.sum(F.regexp_count("line", F.lit("[^ ]+")).cast("bigint")).alias("n_words"))


@query("keeper_files", "WITH f AS (SELECT p_partkey, p_brand AS region, p_name || CASE p_partkey % 3 WHEN 0 THEN ' (Long Form)' WHEN 1 THEN ' draft' ELSE '' END AS stem, p_size FROM part) SELECT region, arg_min(stem, (CASE WHEN contains(stem, 'Long Form') THEN 0 ELSE 1 END, -p_size, p_partkey)) AS stem FROM f WHERE NOT ends_with(stem, 'draft') GROUP BY region")
def keeper_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file to keep of each region: rules on names, then a rank."""
    k = F.col("p_partkey")
    rows = read(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("region"), F.concat("p_name", F.when(k % 3 == 0, " (Long Form)").when(k % 3 == 1, " draft").otherwise("")).alias("stem"), "p_size").where("not endswith(stem, 'draft')")
    order = F.struct(F.when(F.contains("stem", F.lit("Long Form")), 0).otherwise(1), -F.col("p_size"), "p_partkey")
    return rows.groupBy("region").agg(F.min_by("stem", order).alias("stem"))
