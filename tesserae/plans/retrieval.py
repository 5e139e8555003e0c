"""Queries over the vector index: scope, floor, margin, banding, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import topk
from ..sources.tables import read
from .catalog import query

#: The stated query set, and the labels of a scoped search.
EVERY, SCOPE = 20, (0, 2, 4, 6)


def queries_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").where(F.col("vec_id") % EVERY == 0)
    return rows.select(F.col("vec_id").alias("q"), F.col("embedding").alias("qvec"), F.col("label").alias("qlabel"))


def hits(spark: SparkSession, sf_dir: str, scoped: bool, keep: int | None = None, floor: int | None = None, margin: float = 0.0) -> DataFrame:
    """Scores of all rows, or of those in scope, for each query; as many as are needed."""
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    if scoped:
        rows = rows.where(F.col("label").isin(*SCOPE))
    return topk.scored(rows, queries_of(spark, sf_dir), "vec_id", keep=keep, floor=floor, margin=margin).select("q", "vec_id", "label", "qlabel", "score")


_HITS = """
WITH s AS (
  SELECT a.vec_id AS q, b.vec_id, b.label, a.label AS qlabel,
         round(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE))), 6) AS score
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id{scope}
  WHERE a.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS rk,
         row_number() OVER (PARTITION BY q, label ORDER BY score DESC, vec_id) AS rl FROM s
)
"""
_SCOPED = _HITS.format(scope=" AND b.label IN (0, 2, 4, 6)")
_ALL = _HITS.format(scope="")


@query("scoped_topk_floor", _SCOPED + """
SELECT q, vec_id, label, score, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS INTEGER) AS rk
FROM r WHERE rk <= 8 OR rl <= 3
""")
def scoped_topk_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact search within a scope: the best eight, and three of each label at least."""
    return topk.top_k_with_floor(hits(spark, sf_dir, True, 8, 3), 8, 3, "label", "vec_id").select("q", "vec_id", "label", "score", "rk")


@query("global_topk", _ALL + "SELECT q, vec_id, label, score, CAST(rk AS INTEGER) AS rk FROM r WHERE rk <= 10")
def global_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact unscoped search; no floor applies."""
    found = topk.top_k(hits(spark, sf_dir, False, 10), 10, ["q"], [F.col("score").desc(), F.col("vec_id")])
    return found.select("q", "vec_id", "label", "score", "rk")


@query("margin_topk", _ALL + """, m AS (SELECT *, max(score) OVER (PARTITION BY q) AS best FROM r)
SELECT q, vec_id, score, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS INTEGER) AS rk
FROM m WHERE score >= 0.2 AND score >= round(best - 0.15, 6) QUALIFY rk <= 5
""")
def margin_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links that score well enough and close to the best."""
    return topk.within_margin(hits(spark, sf_dir, False, 5), 5, 0.2, 0.15, "vec_id").select("q", "vec_id", "score", "rk")


@query("clear_lead", _ALL + """, two AS (SELECT q, vec_id, score, rk, lead(score) OVER (PARTITION BY q ORDER BY rk) AS second FROM r WHERE rk <= 2)
SELECT q, vec_id, score FROM two WHERE rk = 1 AND (second IS NULL OR round(score - second, 6) >= 0.02)
""")
def clear_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best match, accepted only with a lead over the runner-up."""
    return topk.clear_lead(hits(spark, sf_dir, False, 2), 0.02, "vec_id").select("q", "vec_id", "score")


@query("listwise_band_scores", _ALL + """
SELECT q, vec_id, CAST(rk AS INTEGER) AS rk, round(CASE WHEN rk <= 6 THEN 1.0::DOUBLE - 0.5::DOUBLE * (rk - 1) / 6 ELSE 0.5::DOUBLE * (20 - rk + 1) / (20 - 6 + 1) END, 6) AS band
FROM r WHERE rk <= 20
""")
def listwise_band_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of a listwise judgement as scores, split at its relevance mark."""
    ranks = topk.top_k(hits(spark, sf_dir, False, 20), 20, ["q"], [F.col("score").desc(), F.col("vec_id")])
    return topk.band_scores(ranks, 6, 20).select("q", "vec_id", "rk", "band")


@query("cascade_scores", _ALL + """
SELECT q, vec_id, CAST(rk AS INTEGER) AS rk, round(CASE WHEN rk <= 15 THEN 1.0::DOUBLE - 0.5::DOUBLE * (rk - 1) / 14 ELSE 0.5::DOUBLE * (25 - rk + 1) / (25 - 15 + 1) END, 6) AS cascade
FROM r WHERE rk <= 25
""")
def cascade_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finalists of a cascade above one half, the tail below."""
    ranks = topk.top_k(hits(spark, sf_dir, False, 25), 25, ["q"], [F.col("score").desc(), F.col("vec_id")])
    return topk.cascade_scores(ranks, 15).select("q", "vec_id", "rk", "cascade")


@query("best_per_identity", _ALL + """
SELECT q, vec_id // 10 AS identity, arg_min(vec_id, rk) AS vec_id, max(score) AS score FROM r GROUP BY ALL
""")
def best_per_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of one text compete; the best stands for it."""
    rows = read(spark, sf_dir, "embeddings").select("vec_id", F.floor(F.col("vec_id") / 10).alias("identity"), "embedding")
    found = topk.scored(rows, queries_of(spark, sf_dir), "vec_id", keep=0, floor=1, group="identity")
    best = F.max_by("vec_id", F.struct("score", -F.col("vec_id"))).alias("vec_id")
    return found.groupBy("q", "identity").agg(best, F.max("score").alias("score"))


@query("union_keep_best", _ALL + """, u AS (
  SELECT q, vec_id, score FROM r WHERE rk <= 10 UNION ALL
  SELECT q, vec_id, round(score * 0.9, 6) FROM r WHERE label % 2 = 0 AND rk <= 30)
SELECT q, vec_id, max(score) AS score, count(*) AS n_lists FROM u GROUP BY ALL
""")
def union_keep_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw and expanded hit lists together, the best score of each row; raw hits never drop out."""
    order = [F.col("score").desc(), F.col("vec_id")]
    ranked = topk.top_k(hits(spark, sf_dir, False, 30), 30, ["q"], order)
    raw = ranked.where("rk <= 10").select("q", "vec_id", "score")
    # rounded in binary, as SQL does: Spark's own round goes by the decimal digits
    scaled = F.col("score") * 0.9 * 1e6
    less = F.signum(scaled) * F.floor(F.abs(scaled) + 0.5) / 1e6
    wide = ranked.where("label % 2 = 0").select("q", "vec_id", less.alias("score"))
    return raw.unionByName(wide).groupBy("q", "vec_id").agg(F.max("score").alias("score"), F.count("*").alias("n_lists"))


@query("floor_after_dedupe", _SCOPED + """, d AS (SELECT *, count(*) OVER (PARTITION BY q, label ORDER BY rk ROWS UNBOUNDED PRECEDING) AS nth FROM r WHERE rk <= 60)
SELECT q, vec_id, label, CAST(rk AS INTEGER) AS rk FROM d WHERE rk <= 10 OR nth <= 4
""")
def floor_after_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beyond the top, rows stay until their label has its floor."""
    ranked = topk.top_k(hits(spark, sf_dir, True, 60), 60, ["q"], [F.col("score").desc(), F.col("vec_id")])
    nth = F.count("*").over(Window.partitionBy("q", "label").orderBy("rk").rowsBetween(Window.unboundedPreceding, 0))
    return ranked.withColumn("nth", nth).where("rk <= 10 or nth <= 4").select("q", "vec_id", "label", "rk")


@query("named_first_bonus", _ALL + """, b AS (
  SELECT q, vec_id, label, label = qlabel AS boosted, round(score + CASE WHEN label = 3 THEN 0.1 ELSE 0 END, 6) AS score FROM r WHERE rk <= 40)
SELECT q, vec_id, label, boosted, score, CAST(row_number() OVER (PARTITION BY q ORDER BY boosted DESC, score DESC, vec_id) AS INTEGER) AS place FROM b QUALIFY place <= 12
""")
def named_first_bonus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the label that the query names come first; one kind of row has a bonus."""
    ranked = topk.top_k(hits(spark, sf_dir, False, 40), 40, ["q"], [F.col("score").desc(), F.col("vec_id")])
    rows = ranked.withColumn("boosted", F.col("label") == F.col("qlabel")).withColumn("score", F.round(F.col("score") + F.when(F.col("label") == 3, 0.1).otherwise(0.0), 6))
    return topk.top_k(rows, 12, ["q"], [F.col("boosted").desc(), F.col("score").desc(), F.col("vec_id")], "place").select("q", "vec_id", "label", "boosted", "score", "place")


_JUDGED = _ALL + """, j AS (
  SELECT q, qlabel, rk, label = qlabel AS relevant, sum((label = qlabel)::INT) OVER (PARTITION BY q) AS n_relevant FROM r
), p AS (
  SELECT q, qlabel, min(rk) FILTER (relevant) AS first, max(n_relevant) AS n, {n} FROM j WHERE rk <= 40 GROUP BY ALL
)
""".format(n=", ".join(f"count(*) FILTER (relevant AND rk <= {k}) AS n{k}" for k in (1, 3, 5, 10)))
_METRICS = "count(*) AS n_queries, " + ", ".join(f"round(avg(CASE WHEN first <= {k} THEN 1.0::DOUBLE ELSE 0 END), 6) AS hit_{k}, round(avg(n{k} / n), 6) AS recall_{k}" for k in (1, 3, 5, 10)) + ", round(avg(coalesce(1.0::DOUBLE / first, 0)), 6) AS mrr"


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best forty of each query, relevant where the label agrees."""
    found = hits(spark, sf_dir, False, 40)
    sizes = read(spark, sf_dir, "embeddings").groupBy("label").count()
    sizes = sizes.select(F.col("label").alias("qlabel"), (F.col("count") - 1).alias("n_relevant"))
    ranked = topk.top_k(found, 40, ["q"], [F.col("score").desc(), F.col("vec_id")])
    return ranked.join(sizes, "qlabel").withColumn("relevant", F.col("label") == F.col("qlabel"))


@query("retrieval_metrics", _JUDGED + f"SELECT {_METRICS} FROM p")
def retrieval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hit@k, recall@k and mean reciprocal rank over all queries."""
    return topk.retrieval_metrics(judged(spark, sf_dir), [])


@query("retrieval_metrics_by_label", _JUDGED + f"SELECT qlabel, {_METRICS} FROM p GROUP BY qlabel")
def retrieval_metrics_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the query's label."""
    return topk.retrieval_metrics(judged(spark, sf_dir), ["qlabel"])


@query("head_to_head", _SCOPED + """, a AS (SELECT q, bool_or(label = qlabel) AS a FROM r WHERE rk <= 3 GROUP BY q),
b AS (SELECT q, bool_or(label = qlabel) AS b FROM r WHERE rl <= 1 GROUP BY q)
SELECT count(*) FILTER (a AND b) AS n_both, count(*) FILTER (a AND NOT b) AS only_a, count(*) FILTER (NOT a AND b) AS only_b, count(*) FILTER (NOT a AND NOT b) AS neither FROM a JOIN b USING (q)
""")
def head_to_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rankers side by side: which of them answers a query."""
    found = hits(spark, sf_dir, True, 3, 1)
    order = [F.col("score").desc(), F.col("vec_id")]
    right = F.bool_or(F.col("label") == F.col("qlabel"))
    a = topk.top_k(found, 3, ["q"], order).groupBy("q").agg(right.alias("a"))
    b = topk.top_k(found, 1, ["q", "label"], order).groupBy("q").agg(right.alias("b"))
    return a.join(b, "q").agg(F.count_if(F.expr("a and b")).alias("n_both"), F.count_if(F.expr("a and not b")).alias("only_a"), F.count_if(F.expr("not a and b")).alias("only_b"), F.count_if(F.expr("not a and not b")).alias("neither"))


@query("backend_overlap", _ALL + """, x AS (SELECT q, vec_id FROM r WHERE rk <= 10),
y AS (SELECT q, vec_id FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(score, 1) DESC, vec_id) AS c FROM r) WHERE c <= 10)
SELECT x.q, count(y.vec_id) AS n_overlap, count(y.vec_id) >= 9 AS agrees FROM x LEFT JOIN y USING (q, vec_id) GROUP BY x.q
""")
def backend_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far a coarse ranking agrees with the exact one in its first ten."""
    # a row that a rounded score puts among the best ten is less than its rounding step behind them
    found = hits(spark, sf_dir, False, 10, margin=0.1)
    x = topk.top_k(found, 10, ["q"], [F.col("score").desc(), F.col("vec_id")]).select("q", "vec_id")
    y = topk.top_k(found.withColumn("score", F.round("score", 1)), 10, ["q"], [F.col("score").desc(), F.col("vec_id")]).select("q", "vec_id", F.lit(1).alias("hit"))
    joined = x.join(y, ["q", "vec_id"], "left").groupBy("q").agg(F.count("hit").alias("n_overlap"))
    return joined.withColumn("agrees", F.col("n_overlap") >= 9)


@query("pooled_recall", _ALL + """, pool AS (SELECT DISTINCT q, vec_id, label = qlabel AS relevant FROM r WHERE rk <= 10 OR rl <= 2),
good AS (SELECT q, count(*) AS n FROM pool WHERE relevant GROUP BY q),
got AS (SELECT q, count(*) FILTER (label = qlabel) AS k FROM r WHERE rk <= 10 GROUP BY q)
SELECT q, n AS n_pooled, k AS n_found, round(k / n, 6) AS recall FROM good JOIN got USING (q)
""")
def pooled_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall against what two systems together find."""
    found = hits(spark, sf_dir, False, 10, 2).withColumn("relevant", F.col("label") == F.col("qlabel"))
    order = [F.col("score").desc(), F.col("vec_id")]
    best, each = topk.top_k(found, 10, ["q"], order), topk.top_k(found, 2, ["q", "label"], order)
    pool = best.select("q", "vec_id", "relevant").union(each.select("q", "vec_id", "relevant")).distinct()
    good = pool.where("relevant").groupBy("q").agg(F.count("*").alias("n_pooled"))
    got = best.groupBy("q").agg(F.count_if("relevant").alias("n_found"))
    return good.join(got, "q").withColumn("recall", F.round(F.col("n_found") / F.col("n_pooled"), 6))


@query("tuning_sweep", _ALL + """SELECT k, least_score, count(*) AS n_kept, count(*) FILTER (label = qlabel) AS n_relevant
FROM r CROSS JOIN (VALUES (5), (10), (20)) c(k) CROSS JOIN (VALUES (0.1::DOUBLE), (0.3::DOUBLE)) d(least_score) WHERE rk <= k AND score >= least_score GROUP BY ALL
""")
def tuning_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ranking under a grid of settings: rows are scored once, whatever the grid's size."""
    ranked = topk.top_k(hits(spark, sf_dir, False, 20), 20, ["q"], [F.col("score").desc(), F.col("vec_id")])
    grid = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(t).alias("least_score")) for k in (5, 10, 20) for t in (0.1, 0.3)]))
    rows = ranked.withColumn("g", grid).where("rk <= g.k and score >= g.least_score")
    return rows.groupBy("g.k", "g.least_score").agg(F.count("*").alias("n_kept"), F.count_if(F.col("label") == F.col("qlabel")).alias("n_relevant"))
