"""Rollups, gates, versions, diffs and bridge joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import tables
from ..sources.sinks import upsert
from ..sources.tables import fingerprint, read
from .catalog import query

_SCORED = """
WITH d AS (
  SELECT doc_id, source AS product, lang AS jurisdiction, quality, toxic,
         greatest(0, 100 - 40 * (1 - quality) - 25 * toxic - CAST(n_chars % 13 AS INTEGER)) AS score
  FROM documents JOIN labels USING (doc_id)
), g AS (SELECT *, CASE WHEN score >= 90 THEN 'pass' WHEN score >= 70 THEN 'review' ELSE 'fail' END AS gate FROM d)
"""


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a score and a gate."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("product"), F.col("lang").alias("jurisdiction"), "n_chars")
    rows = docs.join(read(spark, sf_dir, "labels"), "doc_id")
    score = F.greatest(F.lit(0), 100 - 40 * (1 - F.col("quality")) - 25 * F.col("toxic") - (F.col("n_chars") % 13).cast("int"))
    return rows.withColumn("score", score).withColumn("gate", tables.gate(F.col("score"))).drop("n_chars")


@query("gate_rollup", _SCORED + """
SELECT product, jurisdiction, count(*) AS n_docs, count(*) FILTER (gate = 'pass') AS n_pass, count(*) FILTER (gate = 'review') AS n_review,
       count(*) FILTER (gate = 'fail') AS n_fail, min(score) AS least, round(avg(score), 6) AS mean, CAST(grouping_id(product, jurisdiction) AS INTEGER) AS level,
       CASE WHEN min(score) > 90 AND round(avg(score), 6) > 90 THEN 'pass' WHEN count(*) FILTER (gate = 'fail') > 0 THEN 'fail' WHEN count(*) FILTER (gate = 'review') > 0 THEN 'review' ELSE 'mixed' END AS verdict
FROM g GROUP BY ROLLUP (product, jurisdiction)
""")
def gate_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document to jurisdiction to product: gates, least and mean score, verdict."""
    return tables.gate_rollup(scored_documents(spark, sf_dir), ["product", "jurisdiction"])


@query("weighted_mean_of_means", _SCORED + """, j AS (SELECT product, jurisdiction, count(*) AS n, avg(score) AS m FROM g GROUP BY ALL)
SELECT product, CAST(sum(n) AS BIGINT) AS n_docs, round(sum(m * n) / sum(n), 6) AS mean, min(m) < 60 AS weak FROM j GROUP BY product
""")
def weighted_mean_of_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of parts weighted by their counts."""
    parts = scored_documents(spark, sf_dir).groupBy("product", "jurisdiction").agg(F.count("*").alias("n"), F.avg("score").alias("m"))
    return parts.groupBy("product").agg(F.sum("n").alias("n_docs"), F.round(F.sum(F.col("m") * F.col("n")) / F.sum("n"), 6).alias("mean"), (F.min("m") < 60).alias("weak"))


@query("gate_histogram_merge", _SCORED + """, m AS (SELECT product, gate, count(*) AS n FROM g GROUP BY ALL)
SELECT gate, CAST(sum(n) AS BIGINT) AS n FROM m GROUP BY gate
""")
def gate_histogram_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter maps of workers, merged by key."""
    per = scored_documents(spark, sf_dir).groupBy("product", "gate").count()
    maps = per.groupBy("product").agg(F.map_from_entries(F.collect_list(F.struct("gate", "count"))).alias("gates"))
    return maps.select(F.explode("gates").alias("gate", "k")).groupBy("gate").agg(F.sum("k").alias("n"))


@query("eligibility_counts", _SCORED + """, e AS (
  SELECT *, CASE WHEN gate = 'fail' THEN 'skip' WHEN toxic = 1 THEN 'hold' ELSE 'publish' END AS decision FROM g)
SELECT product, gate, decision, count(*) AS n, list_slice(list_sort(list(doc_id)), 1, 5) AS examples FROM e GROUP BY ALL
""")
def eligibility_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions by product and gate, with the first few documents of each.

    Examples come from a rank, so that no group is collected whole.
    """
    decision = F.when(F.col("gate") == "fail", "skip").when(F.col("toxic") == 1, "hold").otherwise("publish")
    rows = scored_documents(spark, sf_dir).withColumn("decision", decision)
    keys = ["product", "gate", "decision"]
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    few = rows.withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy("doc_id"))).where("r <= 5")
    few = few.groupBy(*keys).agg(F.array_sort(F.collect_list("doc_id")).alias("examples"))
    return counts.join(few, keys)


@query("worst_first", _SCORED + "SELECT product, doc_id, score, CAST(row_number() OVER (PARTITION BY product ORDER BY score ASC NULLS LAST, doc_id) AS INTEGER) AS place FROM g QUALIFY place <= 3")
def worst_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weakest documents of each product."""
    w = Window.partitionBy("product").orderBy(F.col("score").asc_nulls_last(), "doc_id")
    return scored_documents(spark, sf_dir).withColumn("place", F.row_number().over(w)).where("place <= 3").select("product", "doc_id", "score", "place")


@query("cohort_profile", _SCORED + "SELECT doc_id, product, score, round(score - avg(score) OVER (PARTITION BY product), 6) AS off_mean, round(median(score) OVER (PARTITION BY product), 6) AS typical FROM g")
def cohort_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document against its product's mean and median."""
    rows = scored_documents(spark, sf_dir)
    stats = rows.groupBy("product").agg(F.avg("score").alias("m"), F.median("score").alias("typical"))
    return rows.join(stats, "product").select("doc_id", "product", "score", F.round(F.col("score") - F.col("m"), 6).alias("off_mean"), F.round("typical", 6).alias("typical"))


@query("collision_resolution", """
WITH c AS (
  SELECT left(md5(text), 2) AS slug, doc_id, score, CASE gate WHEN 'pass' THEN 0 WHEN 'review' THEN 1 ELSE 2 END AS rank FROM (""" + _SCORED + """ SELECT g.*, text FROM g JOIN documents USING (doc_id)))
SELECT slug, arg_min(doc_id, rank * 1e9 - score * 1e6 + doc_id) AS kept, count(*) - 1 AS n_dropped, CAST(sum(doc_id) AS BIGINT) - arg_min(doc_id, rank * 1e9 - score * 1e6 + doc_id) AS dropped_sum FROM c GROUP BY slug
""")
def collision_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several documents under one name: best gate, then score, then id."""
    slug = read(spark, sf_dir, "documents").select("doc_id", F.substring(F.md5("text"), 1, 2).alias("slug"))
    rank = F.when(F.col("gate") == "pass", 0).when(F.col("gate") == "review", 1).otherwise(2)
    rows = scored_documents(spark, sf_dir).join(slug, "doc_id").withColumn("rank", rank)
    kept = F.min_by("doc_id", F.struct("rank", -F.col("score"), "doc_id"))
    out = rows.groupBy("slug").agg(kept.alias("kept"), (F.count("*") - 1).alias("n_dropped"), F.sum("doc_id").alias("s"))
    return out.select("slug", "kept", "n_dropped", (F.col("s") - F.col("kept")).alias("dropped_sum"))


@query("latest_version_per_key", "SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, max(o_orderdate) AS o_orderdate FROM orders GROUP BY o_custkey")
def latest_version_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest version of each lineage; ties go to the larger id."""
    return tables.latest(read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


_VERSIONS = """
WITH v AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS version FROM orders)
"""


@query("version_lineage", _VERSIONS + "SELECT o_custkey, o_orderkey, CAST(version AS INTEGER) AS version, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY version) AS parent, first(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY version) AS root FROM v")
def version_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each version with its parent and the root of its chain."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    rows = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return rows.select("o_custkey", "o_orderkey", F.row_number().over(w).alias("version"), F.lag("o_orderkey").over(w).alias("parent"), F.first("o_orderkey").over(w).alias("root"))


_SLICES = """
WITH old AS (SELECT doc_id, lang, n_chars FROM documents WHERE doc_id % 10 < 7),
new AS (SELECT doc_id, lang, n_chars + 1 AS n_chars FROM documents WHERE doc_id % 10 >= 4)
"""


def slices(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two overlapping manifests, the later with changed payloads."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return docs.where("doc_id % 10 < 7"), docs.where("doc_id % 10 >= 4").withColumn("n_chars", F.col("n_chars") + 1)


@query("manifest_upsert", _SLICES + "SELECT * FROM old WHERE doc_id NOT IN (SELECT doc_id FROM new) UNION ALL SELECT * FROM new")
def manifest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace by key, keep the rest."""
    return upsert(*slices(spark, sf_dir), "doc_id")


@query("manifest_superset_missing", _SLICES + "SELECT lang, count(*) AS n_missing, min(doc_id) AS first_missing FROM old WHERE doc_id NOT IN (SELECT doc_id FROM new) GROUP BY lang")
def manifest_superset_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a new manifest lacks of the old one."""
    old, new = slices(spark, sf_dir)
    return old.join(new, "doc_id", "left_anti").groupBy("lang").agg(F.count("*").alias("n_missing"), F.min("doc_id").alias("first_missing"))


@query("stale_rows", _SLICES + "SELECT doc_id FROM old WHERE doc_id NOT IN (SELECT doc_id FROM new)")
def stale_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows that a run didn't touch."""
    old, new = slices(spark, sf_dir)
    return old.join(new.select("doc_id"), "doc_id", "left_anti").select("doc_id")


@query("snapshot_diff", _SLICES + """
SELECT coalesce(o.lang, n.lang) AS lang, count(*) FILTER (o.doc_id IS NULL) AS n_added, count(*) FILTER (n.doc_id IS NULL) AS n_removed,
       count(*) FILTER (o.n_chars <> n.n_chars) AS n_changed, CAST(sum(coalesce(n.n_chars, 0) - coalesce(o.n_chars, 0)) AS BIGINT) AS delta
FROM old o FULL JOIN new n USING (doc_id) GROUP BY 1
""")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of a corpus: added, removed and changed documents."""
    old, new = slices(spark, sf_dir)
    o = old.select("doc_id", F.col("lang").alias("l0"), F.col("n_chars").alias("c0"))
    n = new.select("doc_id", F.col("lang").alias("l1"), F.col("n_chars").alias("c1"))
    rows = o.join(n, "doc_id", "full").withColumn("lang", F.coalesce("l0", "l1"))
    delta = F.sum(F.coalesce("c1", F.lit(0)) - F.coalesce("c0", F.lit(0)))
    return rows.groupBy("lang").agg(F.count_if(F.col("l0").isNull()).alias("n_added"), F.count_if(F.col("l1").isNull()).alias("n_removed"), F.count_if(F.col("c0") != F.col("c1")).alias("n_changed"), delta.alias("delta"))


_FINDINGS = """
WITH pre AS (SELECT DISTINCT lang AS kind, left(md5(text), 2) AS title FROM documents WHERE doc_id % 3 < 2),
post AS (SELECT DISTINCT lang AS kind, left(md5(text), 2) AS title FROM documents WHERE doc_id % 3 > 0)
"""


def findings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("kind"), F.substring(F.md5("text"), 1, 2).alias("title"))
    return docs.where("doc_id % 3 < 2"), docs.where("doc_id % 3 > 0")


@query("finding_deltas", _FINDINGS + """
SELECT kind, title, CASE WHEN b.t IS NULL THEN 'fixed' WHEN a.t IS NULL THEN 'introduced' ELSE 'persisting' END AS state
FROM (SELECT *, 1 AS t FROM pre) a FULL JOIN (SELECT *, 1 AS t FROM post) b USING (kind, title)
""")
def finding_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings before and after: fixed, persisting, introduced."""
    return tables.full_diff(*findings(spark, sf_dir), ["kind", "title"])


@query("dimension_deltas", """
WITH a AS (SELECT lang, round(avg(n_chars), 6) AS s FROM documents WHERE doc_id % 2 = 0 AND lang <> 'de' GROUP BY lang),
b AS (SELECT lang, round(avg(n_chars), 6) AS s FROM documents WHERE doc_id % 2 = 1 AND lang <> 'es' GROUP BY lang)
SELECT lang, a.s AS before, b.s AS after, round(b.s - a.s, 6) AS delta FROM a FULL JOIN b USING (lang)
""")
def dimension_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of both sides; a side that lacks a dimension stays null."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    a = docs.where("doc_id % 2 = 0 and lang <> 'de'").groupBy("lang").agg(F.round(F.avg("n_chars"), 6).alias("before"))
    b = docs.where("doc_id % 2 = 1 and lang <> 'es'").groupBy("lang").agg(F.round(F.avg("n_chars"), 6).alias("after"))
    return a.join(b, "lang", "full").withColumn("delta", F.round(F.col("after") - F.col("before"), 6))


@query("metadata_inheritance", """
SELECT r_name, n_name, count(DISTINCT c_custkey) AS n_customers, count(DISTINCT p_brand) AS n_brands, list_sort(list(DISTINCT p_brand)) AS brands
FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey
JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY ALL
""")
def metadata_inheritance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names inherited from the top through five bridge tables; brands reduce to distinct rows before they are gathered."""
    t = lambda name: read(spark, sf_dir, name)
    places = t("region").join(t("nation"), F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", "n_name", "n_nationkey")
    buyers = t("customer").select("c_custkey", "c_nationkey").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name", "n_name")
    bought = t("orders").select("o_orderkey", "o_custkey").join(t("lineitem").select("l_orderkey", "l_partkey"), F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey", "l_partkey")
    bought = bought.join(t("part").select("p_partkey", "p_brand"), F.col("p_partkey") == F.col("l_partkey")).select("o_custkey", "p_brand").distinct()
    rows = bought.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    return rows.groupBy("r_name", "n_name").agg(F.count_distinct("c_custkey").alias("n_customers"), F.count_distinct("p_brand").alias("n_brands"), F.array_sort(F.collect_set("p_brand")).alias("brands"))


@query("entity_docs", """
SELECT c_custkey AS id, c_name AS title, n_name AS nation, count(o_orderkey) AS n_orders, list_sort(list(DISTINCT o_orderstatus) FILTER (o_orderstatus IS NOT NULL)) AS statuses
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL
""")
def entity_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One search document for each entity, its metadata gathered from bridges."""
    orders = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("o_orderstatus")).alias("s"))
    rows = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"), "left").join(orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    return rows.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"), F.col("n_name").alias("nation"), F.coalesce("n", F.lit(0)).alias("n_orders"), F.col("s").alias("statuses"))


@query("titles_shared", "SELECT p_name AS title, count(*) AS n, min(p_partkey) AS first_id FROM part GROUP BY p_name HAVING count(*) > 1")
def titles_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that several ids share."""
    return read(spark, sf_dir, "part").groupBy(F.col("p_name").alias("title")).agg(F.count("*").alias("n"), F.min("p_partkey").alias("first_id")).where("n > 1")


@query("source_fingerprints", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n_rows, CAST(max({c}) AS VARCHAR) AS newest FROM {t}" for t, c in (("orders", "o_orderkey"), ("documents", "doc_id"), ("events", "event_id"), ("labels", "doc_id"))))
def source_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count and newest stamp of each source."""
    out = None
    for name, stamp in (("orders", "o_orderkey"), ("documents", "doc_id"), ("events", "event_id"), ("labels", "doc_id")):
        df = read(spark, sf_dir, name).agg(F.count("*").alias("n_rows"), F.max(stamp).cast("string").alias("newest")).select(F.lit(name).alias("name"), "n_rows", "newest")
        out = df if out is None else out.unionByName(df)
    return out


@query("exact_duplicate_groups", "SELECT sha256(text) AS digest, count(*) AS n_docs, min(doc_id) AS kept, CAST(sum(n_chars) - min(n_chars) AS BIGINT) AS redundant_chars FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with one content: the one to keep and what the others cost."""
    docs = read(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("digest"), "doc_id", "n_chars")
    return docs.groupBy("digest").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("kept"), (F.sum("n_chars") - F.min("n_chars")).alias("redundant_chars")).where("n_docs > 1")


@query("clone_by_hash", "SELECT doc_id, min(doc_id) OVER (PARTITION BY sha256(text)) AS clone_of, doc_id <> min(doc_id) OVER (PARTITION BY sha256(text)) AS is_clone FROM documents")
def clone_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The finished result that each document can reuse."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    first = docs.groupBy("digest").agg(F.min("doc_id").alias("clone_of"))
    return docs.join(first, "digest").select("doc_id", "clone_of", (F.col("doc_id") != F.col("clone_of")).alias("is_clone"))


@query("scope_ids", """
WITH req AS (SELECT p.p AS product, j.j AS jurisdiction FROM (VALUES ('src1'), ('src2'), ('srcX')) p(p) CROSS JOIN (VALUES ('en'), ('fr'), ('xx')) j(j)),
have AS (SELECT DISTINCT source AS product, lang AS jurisdiction FROM documents)
SELECT product, jurisdiction FROM req WHERE (product, jurisdiction) IN (SELECT (product, jurisdiction) FROM have) AND jurisdiction IN ('en', 'fr', 'de')
""")
def scope_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested products by requested names, as far as they exist and are allowed."""
    req = spark.range(1).select(F.explode(F.array(*map(F.lit, ("src1", "src2", "srcX")))).alias("product")).select("product", F.explode(F.array(*map(F.lit, ("en", "fr", "xx")))).alias("jurisdiction"))
    have = read(spark, sf_dir, "documents").select(F.col("source").alias("product"), F.col("lang").alias("jurisdiction")).distinct()
    return req.join(have, ["product", "jurisdiction"], "left_semi").where(F.col("jurisdiction").isin("en", "fr", "de"))


@query("entitlement_filter", """
WITH e AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN ['BUILDING', 'MACHINERY'] ELSE ['HOUSEHOLD'] END AS entitled,
  CASE c_custkey % 2 WHEN 0 THEN ['BUILDING', 'HOUSEHOLD'] ELSE [] END AS requested, c_mktsegment FROM customer),
f AS (SELECT *, CASE WHEN entitled IS NULL THEN CASE WHEN len(requested) = 0 THEN NULL ELSE requested END WHEN len(requested) = 0 THEN entitled ELSE list_intersect(requested, entitled) END AS effective FROM e)
SELECT c_custkey, list_sort(effective) AS effective, effective IS NULL OR list_contains(effective, c_mktsegment) AS visible FROM f
""")
def entitlement_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request and entitlement: null entitlement is unrestricted, an empty request asks for all that is allowed."""
    none = F.lit(None).cast("array<string>")
    k = F.col("c_custkey")
    entitled = F.when(k % 3 == 0, none).when(k % 3 == 1, F.array(F.lit("BUILDING"), F.lit("MACHINERY"))).otherwise(F.array(F.lit("HOUSEHOLD")))
    requested = F.when(k % 2 == 0, F.array(F.lit("BUILDING"), F.lit("HOUSEHOLD"))).otherwise(F.array().cast("array<string>"))
    rows = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", entitled.alias("e"), requested.alias("r"))
    effective = F.when(F.col("e").isNull(), F.when(F.size("r") == 0, none).otherwise(F.col("r"))).when(F.size("r") == 0, F.col("e")).otherwise(F.array_intersect("r", "e"))
    rows = rows.withColumn("effective", F.array_sort(effective))
    return rows.select("c_custkey", "effective", (F.col("effective").isNull() | F.array_contains("effective", F.col("c_mktsegment"))).alias("visible"))


@query("score_ratio_pruning", "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, max(o_totalprice) OVER (PARTITION BY o_custkey) AS best FROM orders) WHERE o_totalprice >= 0.8 * best")
def score_ratio_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows within a share of the best of their group."""
    rows = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    best = F.max("o_totalprice").over(Window.partitionBy("o_custkey"))
    return rows.withColumn("best", best).where("o_totalprice >= 0.8D * best").drop("best")


@query("paging", "SELECT o_orderpriority, o_orderkey, CAST(rn AS INTEGER) AS rn, n > 20 AS has_more FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rn, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders) WHERE rn BETWEEN 11 AND 20")
def paging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of each type, and whether there is a third."""
    rows = read(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    counts = rows.groupBy("o_orderpriority").agg((F.count("*") > 20).alias("has_more"))
    w = Window.partitionBy("o_orderpriority").orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    page = rows.withColumn("rn", F.row_number().over(w)).where("rn <= 20").where("rn >= 11")
    return page.join(counts, "o_orderpriority").select("o_orderpriority", "o_orderkey", "rn", "has_more")


@query("feed_latest", """
WITH feed AS (SELECT o_custkey AS id, o_orderdate AS stamp, o_orderkey AS export FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_custkey, o_orderdate, o_orderkey FROM orders WHERE o_orderkey % 3 = 0)
SELECT id, max(export) AS export, arg_max(stamp, export) AS stamp FROM feed WHERE stamp >= TIMESTAMP '1999-07-01' GROUP BY id
""")
def feed_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds together, not older than a date, the latest export of each id."""
    rows = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("stamp"), F.col("o_orderkey").alias("export"))
    feed = rows.where("export % 2 = 0").unionByName(rows.where("export % 3 = 0")).where("stamp >= timestamp_ntz '1999-07-01'")
    return feed.groupBy("id").agg(F.max("export").alias("export"), F.max_by("stamp", "export").alias("stamp"))


@query("ordered_decisions", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'skip' WHEN o_totalprice < 50000 THEN 'hold' WHEN o_orderpriority LIKE '1%' THEN 'publish' ELSE 'queue' END AS decision,
  CASE WHEN o_orderstatus = 'F' THEN 'failed gate' WHEN o_totalprice < 50000 THEN 'too small' WHEN o_orderpriority LIKE '1%' THEN 'urgent' ELSE 'in turn' END AS reason FROM orders
""")
def ordered_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rule that applies decides, and says why."""
    rules = [(F.col("o_orderstatus") == "F", "skip", "failed gate"), (F.col("o_totalprice") < 50000, "hold", "too small"), (F.col("o_orderpriority").startswith("1"), "publish", "urgent")]
    decision, reason = F.lit("queue"), F.lit("in turn")
    for test, d, r in reversed(rules):
        decision, reason = F.when(test, d).otherwise(decision), F.when(test, r).otherwise(reason)
    return read(spark, sf_dir, "orders").select("o_orderkey", decision.alias("decision"), reason.alias("reason"))


@query("occurrence_pairs", """
WITH a AS (SELECT l_orderkey AS k, l_partkey AS x, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS nth FROM lineitem WHERE l_returnflag = 'A'),
b AS (SELECT l_orderkey AS k, l_partkey AS y, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS nth FROM lineitem WHERE l_returnflag = 'R')
SELECT k, CAST(nth AS INTEGER) AS nth, x, y FROM a FULL JOIN b USING (k, nth)
""")
def occurrence_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates on both sides matched one for one, in order."""
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag")
    order = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    w = Window.partitionBy("k").orderBy(*order)
    a = rows.where("l_returnflag = 'A'").select("k", F.col("l_partkey").alias("x"), F.row_number().over(w).alias("nth"))
    b = rows.where("l_returnflag = 'R'").select("k", F.col("l_partkey").alias("y"), F.row_number().over(w).alias("nth"))
    return a.join(b, ["k", "nth"], "full")


@query("asof_section", """
WITH h AS (SELECT o_custkey AS k, o_orderdate AS at, max(o_orderkey) AS heading FROM orders GROUP BY ALL), c AS (SELECT event_id, user_id AS k, CAST('1995-01-01' AS TIMESTAMP) + INTERVAL (event_id % 2500) DAY AS at FROM events)
SELECT c.k, c.event_id, c.at, h.heading FROM c ASOF LEFT JOIN h ON c.k = h.k AND c.at >= h.at
""")
def asof_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last heading at or before each point."""
    heads = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("at")).agg(F.max("o_orderkey").alias("heading"))
    at = F.expr("timestamp_ntz '1995-01-01' + make_dt_interval(cast(event_id % 2500 as int))")
    points = read(spark, sf_dir, "events").select(F.col("user_id").alias("k"), "event_id", at.alias("at"))
    return tables.as_of(points, heads, ["k"], "at", "heading")


@query("page_range_attach", """
WITH r AS (SELECT p_partkey AS chunk, p_size AS lo, p_size + CAST(p_partkey % 4 AS INTEGER) AS hi FROM part), p AS (SELECT s_suppkey AS note, CAST(s_suppkey % 50 AS INTEGER) AS page FROM supplier)
SELECT chunk, note, page FROM r JOIN p ON page BETWEEN lo AND hi
""")
def page_range_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes of a page with every chunk whose pages cover it."""
    ranges = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("chunk"), F.col("p_size").alias("lo"), (F.col("p_size") + (F.col("p_partkey") % 4).cast("int")).alias("hi"))
    notes = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("note"), (F.col("s_suppkey") % 50).cast("int").alias("page"))
    return tables.attach_ranges(notes, ranges, [], "page", "lo", "hi").select("chunk", "note", "page")


@query("pricing_summary", "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plain grouped summary; the date filter reaches the scan."""
    rows = read(spark, sf_dir, "lineitem").where("l_shipdate <= timestamp_ntz '1998-09-02'")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))
