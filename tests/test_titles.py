"""Title links, ordered labels, spelling of whole questions and approximate neighbours."""

import numpy as np
import pytest
from tesserae.operators import ann, titles, topk
from tesserae.sources.tables import read


def test_suggestions_mend_words_in_their_context(spark):
    lexicon = spark.createDataFrame([("perpetual", 40), ("binding", 30), ("bidding", 60), ("disclosure", 50), ("ferry", 9), ("gmta", 9), ("gtma", 2), ("kolv", 3), ("vlok", 90), ("rules", 70)], "term string, freq long")
    pairs = spark.createDataFrame([("perpetual", "binding"), ("ferry", "rules")], "a string, b string")
    asked = [(1, "perpstual bidning"), (2, "disclosuer rules"), (3, "mgta rules"), (4, "klov"), (5, "binding rules"), (6, "zzzzzzz"), (7, "")]
    out = {r.q: r.suggestion for r in titles.suggest(spark.createDataFrame(asked, "q int, text string"), lexicon, pairs).collect()}
    assert out == {1: "perpetual binding", 2: "disclosure rules", 3: "gmta rules", 4: "kolv", 5: None, 6: None, 7: None}


def test_fuzzy_titles_need_likeness_and_a_lead(spark):
    known = spark.createDataFrame([("k1", "A", "How to make a disclosure"), ("k2", "A", "Penalties"), ("k3", "A", "Penalty"), ("k4", "B", "How to make a disclosure")], "key string, scope string, title string")
    asked = spark.createDataFrame([(1, "A", "How to Make the Disclosure"), (2, "A", "penalties!"), (3, "A", "nothing alike"), (4, "C", "Penalties")], "q int, scope string, title string")
    out = {r.q: r.key for r in titles.fuzzy_titles(asked, known).collect()}
    assert out[1] == "k1" and out[3] is None and out[4] is None and out[2] in ("k2", None)


def test_labels_are_never_found_out_of_order(spark):
    labels = spark.createDataFrame([(1, 0, "6.1"), (1, 1, "6.2"), (1, 2, "6.3"), (1, 3, "6.4")], "doc_id long, i int, label string")
    places = spark.createDataFrame([(1, 5, "6.2"), (1, 10, "6.1"), (1, 12, "6.2"), (1, 13, "6.4")], "doc_id long, ord int, label string")
    out = {r.label: r.ord for r in titles.locate_in_order(labels, places).collect()}
    assert out == {"6.1": 10, "6.2": 12, "6.3": None, "6.4": None}


def exact_hits(rows, asked):
    order = [topk.F.col("score").desc(), topk.F.col("vec_id")]
    return {(r.q, r.vec_id): r.score for r in topk.top_k(topk.scored(rows, asked, "vec_id", keep=10), 10, ["q"], order).select("q", "vec_id", "score").collect()}


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_approximate_neighbours_reach_nine_in_ten(spark, sf_dir, size):
    sf_dir = sf_dir.replace("sf0.001", size)
    from tesserae.plans import retrieval

    rows, asked = read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"), retrieval.queries_of(spark, sf_dir)
    found = {(r.q, r.vec_id): r.score for r in ann.search(rows, asked, "vec_id", 10).collect()}
    exact = exact_hits(rows, asked)
    assert len(found.keys() & exact.keys()) >= 0.95 * len(exact)
    assert all(found[k] == exact[k] for k in found.keys() & exact.keys())
    # exact scores were worked out for fewer than a tenth of all rows
    assert 10 * ann.OVER < 0.1 * rows.count()


def test_codes_name_the_nearest_centers():
    rng = np.random.default_rng(1)
    book = ann.Codebook([rng.normal(size=(7, 2)).astype(np.float32), rng.normal(size=(5, 3)).astype(np.float32)])
    x = rng.normal(size=(40, 5)).astype(np.float32)
    near = lambda part, c: np.argmin(((part[:, None] - c[None]) ** 2).sum(axis=2), axis=1)
    assert (book.encode(x) == np.stack([near(x[:, :2], book.centers[0]), near(x[:, 2:], book.centers[1])], axis=1)).all()
    assert book.decode(book.encode(x)).shape == x.shape


def test_the_router_is_exact_where_it_must_be(spark, sf_dir):
    from tesserae.plans import retrieval

    rows, asked = read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"), retrieval.queries_of(spark, sf_dir)
    assert {r.backend for r in ann.routed(rows, asked, "vec_id", 3).collect()} == {"exact"}
    assert {r.backend for r in ann.routed(rows, asked, "vec_id", 3, few=0).collect()} == {"codes"}
    scoped = ann.routed(rows, asked, "vec_id", 3, scope=[2, 4], few=0).collect()
    assert {r.backend for r in scoped} == {"exact"} and {r.label for r in scoped} <= {2, 4}
    floored = ann.routed(rows, asked, "vec_id", 3, few=0, floor=1).groupBy("q").agg(topk.F.count_distinct("label").alias("n")).collect()
    assert all(r.n == rows.select("label").distinct().count() for r in floored)


def test_rows_without_embedding_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, 0, [1.0, 0.0]), (2, 0, None), (3, 1, [0.0, 1.0]), (4, 1, [1.0, 0.1])], "vec_id long, label int, embedding array<float>")
    asked = rows.where("vec_id = 1").selectExpr("vec_id as q", "embedding as qvec")
    assert [r.vec_id for r in ann.search(rows, asked, "vec_id", 2).orderBy("rk").collect()] == [4, 3]
    assert ann.search(rows.limit(0), asked, "vec_id", 2).count() == 0
    assert ann.search(rows, asked.limit(0), "vec_id", 2).count() == 0


def test_titles_that_many_rows_share_are_compared_once(spark):
    from pyspark.sql import functions as F

    asked = spark.range(2000).select(F.col("id").alias("q"), F.lit("a").alias("scope"), F.when(F.col("id") % 2 == 0, "the red ring rules").otherwise("the blue gear rules").alias("title"))
    known = spark.range(3000).select(F.col("id").alias("key"), F.lit("a").alias("scope"), F.when(F.col("id") == 7, "Blue gear rule").otherwise("red ring").alias("title"))
    found = titles.fuzzy_titles(asked, known)
    assert {(r.q % 2, r.key) for r in found.collect()} == {(0, None), (1, 7)} and found.count() == 2000
