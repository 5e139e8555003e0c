"""Operators on small literal inputs, and checks that must react to damage."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tesserae.plans import load_catalog
from tesserae.functions import text as T
from tesserae.operators import folds, quality, tables, topk, trees
from tesserae.sources import sinks
from tesserae.sources.tables import read_json


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_floor_keeps_weak_groups(spark):
    hits = spark.createDataFrame([(1, k, g, s) for k, (g, s) in enumerate([("a", 0.9), ("a", 0.8), ("a", 0.7), ("b", 0.2), ("c", 0.1), ("b", 0.15)])], "q int, id int, g string, score double")
    kept = topk.top_k_with_floor(hits, 2, 1, "g", "id")
    assert rows(kept, "rk", "id") == [(1, 0), (2, 1), (3, 3), (4, 4)]


def test_queries_beyond_the_broadcast_bound_go_in_slices(spark):
    data = spark.createDataFrame([(k, [1.0, float(k)]) for k in range(6)], "id int, embedding array<double>")
    asked = data.select(F.col("id").alias("q"), F.col("embedding").alias("qvec"))
    whole = rows(topk.scored(data, asked, "id"), "q", "id", "score")
    assert whole == rows(topk.scored(data, asked, "id", most_queries=2), "q", "id", "score")
    assert len(whole) == 30


def test_memory_of_scores_stays_as_queries_grow():
    vectors = np.random.default_rng(5).random((12_000, 8))

    def peak(n):
        asked = pa.table({"q": pa.array(range(n)), "qvec": pa.array(list(vectors[:n]))})
        batch = pa.RecordBatch.from_pydict({"id": pa.array(range(4000)), "embedding": pa.array(list(vectors[:4000]))})
        run = topk._block_scores(asked, "id", 10, None, "label")
        tracemalloc.start()
        n_rows = sum(found.num_rows for found in run(iter([batch])))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert n_rows >= 10 * n
        return most

    assert peak(12_000) < 1.5 * peak(3_000)


def test_clear_lead(spark):
    hits = spark.createDataFrame([(1, 1, 0.9), (1, 2, 0.7), (2, 1, 0.9), (2, 2, 0.85), (3, 9, 0.1)], "q int, id int, score double")
    assert rows(topk.clear_lead(hits, 0.1, "id"), "q", "id") == [(1, 1), (3, 9)]


def test_islands_merge_close_positions(spark):
    df = spark.createDataFrame([("d", x) for x in (1, 2, 5, 9, 10)], "k string, pos int")
    assert rows(tables.islands(df, ["k"], "pos", 3), "first", "last", "n") == [(1, 5, 3), (9, 10, 2)]


def test_as_of_takes_the_last_at_or_before(spark):
    left = spark.createDataFrame([("a", 1, "x"), ("a", 5, "y"), ("b", 5, "z")], "k string, at int, name string")
    right = spark.createDataFrame([("a", 2, 20), ("a", 5, 50)], "k string, at int, v int")
    assert sorted((r.name, r.v) for r in tables.as_of(left, right, ["k"], "at", "v").collect()) == [("x", None), ("y", 50), ("z", None)]


def test_sliced_join_is_the_join(spark, monkeypatch):
    a = spark.createDataFrame([(k, k % 3 if k < 40 else 7) for k in range(50)] + [(99, None)], "note int, page int")
    b = spark.createDataFrame([(k, k % 4, k % 4 + k % 2) for k in range(30)] + [(90, None, 3), (91, 8, 8)], "chunk int, lo int, hi int")
    want = sorted((x.note, y.chunk, x.page) for x in a.collect() for y in b.collect() if None not in (x.page, y.lo) and y.lo <= x.page <= y.hi)
    for name, n in (("SLICE", 3), ("TASK_PAIRS", 10)):
        monkeypatch.setattr(tables, name, n)
    assert rows(tables.attach_ranges(a, b, [], "page", "lo", "hi"), "note", "chunk", "page") == want
    assert rows(tables.join_sliced(b.withColumnRenamed("lo", "page"), a, "page"), "note", "chunk") == sorted((x.note, y.chunk) for x in a.collect() for y in b.collect() if x.page is not None and x.page == y.lo)


def test_a_page_that_all_share_is_dealt_to_tasks(spark):
    points = spark.range(0, 3000, 1, 1).select(F.col("id").alias("note"), F.expr("id div 9000").alias("page"))
    ranges = spark.range(0, 5000, 1, 1).select(F.col("id").alias("chunk"), F.expr("id div 9000").alias("lo"), F.expr("id div 9000").alias("hi"))
    made = tables.attach_ranges(points, ranges, [], "page", "lo", "hi").groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert made.sum() == 15_000_000 and made.max() <= 10_000_000


def test_gate_rollup_counts_every_level(spark):
    docs = spark.createDataFrame([("p", "x", "pass", 95.0), ("p", "y", "fail", 10.0)], "product string, jur string, gate string, score double")
    out = {(r.product, r.jur): (r.n_docs, r.verdict) for r in tables.gate_rollup(docs, ["product", "jur"]).collect()}
    assert out == {("p", "x"): (1, "pass"), ("p", "y"): (1, "fail"), ("p", None): (2, "fail"), (None, None): (2, "fail")}


@pytest.mark.parametrize("drop", [0, 3])
def test_word_coverage_reacts_to_dropped_words(spark, drop):
    words = [(1, k, f"w{k % 7}") for k in range(20)]
    a = spark.createDataFrame(words, "doc_id int, pos int, token string")
    b = spark.createDataFrame(words[drop:], "doc_id int, pos int, token string")
    r = quality.word_coverage(a, b).first()
    assert (r.n_missing, r.n_extra, r.ok) == (drop, 0, drop == 0)


def test_lost_spans_find_a_dropped_passage(spark):
    words = [(1, k, f"w{k}") for k in range(40)]
    a = spark.createDataFrame(words, "doc_id int, pos int, token string")
    b = spark.createDataFrame(words[:10] + words[18:], "doc_id int, pos int, token string")
    assert rows(quality.lost_spans(a, b), "first", "last", "n") == [(10, 17, 8)]


def test_windows(spark):
    df = spark.createDataFrame([("a b c",), ("a",), ("",), (None,)], "t string")
    got = [r.w for r in df.select(T.windows_of(T.tokens(F.col("t")), 2).alias("w")).collect()]
    assert got[:3] == [["a b", "b c"], [], []]


@pytest.mark.parametrize(("key", "parent"), [("A2.1(b)", "A2.1"), ("A2.1", "A2"), ("A2", None)])
def test_parent_key(spark, key, parent):
    assert spark.range(1).select(T.parent_key(F.lit(key)).alias("p")).first().p == parent


@pytest.mark.parametrize(("line", "family"), [("2.1 Scope", "decimal"), ("(iv) else", "roman"), ("(b) else", "alpha"), ("Schedule 2", "part"), ("plain", None)])
def test_marker_family(spark, line, family):
    assert spark.range(1).select(T.marker_family(F.lit(line)).alias("p")).first().p == family


def test_parents_and_subtrees(spark):
    s = spark.createDataFrame([(1, k, lv) for k, lv in enumerate([1, 2, 3, 2, 1, 3])], "doc_id int, ord int, level int")
    assert [r.parent for r in trees.parents_by_level(s, "doc_id", 3).orderBy("ord").collect()] == [None, 0, 1, 0, None, 4]
    assert [r.until for r in trees.subtree_ends(s, "doc_id", 3).orderBy("ord").collect()] == [3, 2, 2, 3, 5, 5]


def test_packing_never_splits_or_overfills(spark):
    rng = random.Random(3)
    sizes = [(1, k, rng.randint(1, 90)) for k in range(60)] + [(2, 0, 500)]
    out = folds.pack(spark.createDataFrame(sizes, "doc_id long, ord int, size int"), 100)
    full = {}
    for r in out.collect():
        full.setdefault((r.doc_id, r.chunk), []).append(r.ord)
    for (doc, _), ords in full.items():
        assert ords == list(range(min(ords), max(ords) + 1)) or sorted(ords) == list(range(min(ords), max(ords) + 1))
        assert doc == 2 or sum(sizes[o][2] for o in ords) <= 100
    assert sum(map(len, full.values())) == 61


def test_levels_rise_by_one(spark):
    df = spark.createDataFrame([(1, k, lv) for k, lv in enumerate([3, 5, 2, 4, 1])], "doc_id long, ord int, level int")
    assert [r.legal for r in folds.legal_levels(df).orderBy("ord").collect()] == [1, 2, 2, 3, 1]


def test_tiers_start_anew_beyond_the_last_kept(spark):
    df = spark.createDataFrame([(1, x) for x in (0.0, 4.0, 8.0, 12.0, 30.0)], "doc_id int, x double")
    assert sorted(r.tier for r in folds.tiers(df, 6.0).collect()) == [0.0, 8.0, 30.0]


def test_shards_are_balanced(spark):
    jobs = spark.createDataFrame([(k, k % 17 + 1) for k in range(400)], "job int, pages int")
    loads = [r["sum(pages)"] for r in folds.assign_shards(jobs, 4).groupBy("shard").sum("pages").collect()]
    assert len(loads) == 4 and max(loads) < 1.15 * min(loads)


def test_upsert_replaces_by_key(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert rows(sinks.upsert(old, new, "k"), "k", "v") == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(sinks.stale(old, new, "k"), "k") == [(1,)]


def test_publish_points_at_whole_versions(spark, tmp_path):
    root = f"file://{tmp_path}/idx"
    df = spark.range(5)
    sinks.publish(df, root, "v1", "2024-01-01")
    sinks.publish(df, root, "v2", "2024-01-02")
    assert sinks.latest_version(spark, root) == "v2"
    with pytest.raises(ValueError):
        sinks.verify_load(spark, f"{root}/version=v1", 6)


def test_index_by_model_and_region(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    df = spark.createDataFrame([("m", "r1", "k", [1.0]), ("n", "r2", "k", [2.0])], "model string, region string, key string, embedding array<float>")
    sinks.save_index(df, path)
    lean = sinks.load_index(spark, path, "m", with_vectors=False)
    assert "embedding" not in lean.columns and lean.count() == 1
    assert "PartitionFilters: [isnotnull(model" in lean._jdf.queryExecution().toString()


def test_json_lines_that_do_not_parse_are_left_out(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1}\n{"a": \n{"a": 3}\n')
    assert rows(read_json(spark, f"file://{tmp_path}/x.json", "a int"), "a") == [(1,), (3,)]


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    from tesserae.plans import load_catalog

    plan = load_catalog().QUERIES["pricing_summary"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThanOrEqual(l_shipdate" in plan
    assert "l_partkey" not in plan.split("== Physical Plan ==")[1]


def test_section_folds_read_every_document(spark, tmp_path):
    rows = [(1, "one\ntwo two", "en"), (2, "three", "de"), (3, "four\nfive", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("packed_chunks", "legal_outline_levels", "bullet_tiers"):
        found = load_catalog().QUERIES[name](spark, str(tmp_path))
        assert {r.doc_id for r in found.select("doc_id").collect()} == {1, 2, 3}, name


def test_approximate_neighbours_find_nine_of_ten(spark, sf_dir):
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    found = {}
    for r in load_catalog().QUERIES["lsh_neighbours"](spark, sf_dir).collect():
        found.setdefault(r.q, set()).add(r.vec_id)
    asked = [q for q in rows if q % 20 == 0]
    hits = 0
    for q in asked:
        scores = {i: sum(a * b for a, b in zip(v, rows[q], strict=True)) for i, v in rows.items() if i != q}
        hits += len(found.get(q, set()) & set(sorted(scores, key=lambda i: (-scores[i], i))[:10]))
    assert hits >= 0.9 * 10 * len(asked)


def test_scores_of_many_queries_come_in_bounded_batches_and_the_best_so_far_count():
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(3 * topk.BLOCK, 4)).astype("float32")
    vectors[topk.BLOCK :] *= 0.01  # later blocks have nothing near the best
    kind = pa.list_(pa.float32())
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(vectors))), pa.array(np.arange(len(vectors)) % 3), pa.array(list(vectors), kind)], ["id", "label", "embedding"])
    asked = pa.table({"q": pa.array(range(-1, -1201, -1)), "qvec": pa.array(list(rng.normal(size=(1200, 4)).astype("float32")), kind)})
    whole = list(topk._block_scores(asked, "id", None, None, "label")(iter([rows.slice(0, topk.BLOCK)])))
    assert sum(b.num_rows for b in whole) == topk.BLOCK * 1200 and max(b.num_rows for b in whole) <= topk.BLOCK * topk.QUERIES
    scores = np.array(asked.column("qvec").to_pylist()) @ vectors.astype(float).T
    for floor in (None, 2):
        found = pa.Table.from_batches(topk._block_scores(asked, "id", 5, floor, "label")(iter([rows])))
        got = set(zip(found.column("q").to_pylist(), found.column("id").to_pylist(), strict=True))
        best = [(x, np.argsort(-scores[-x - 1])[:5]) for x in range(-1, -1201, -1)]
        labels = [(x, np.flatnonzero(np.arange(scores.shape[1]) % 3 == g)) for x in range(-1, -1201, -1) for g in range(3)] if floor else []
        best += [(x, of[np.argsort(-scores[-x - 1][of])[:2]]) for x, of in labels]
        assert {(x, i) for x, ids in best for i in ids.tolist()} <= got
        assert max(i for _, i in got) < topk.BLOCK
    near = pa.Table.from_batches(topk._block_scores(asked, "id", 5, None, "label", 0.1)(iter([rows])))
    got = set(zip(near.column("q").to_pylist(), near.column("id").to_pylist(), strict=True))
    assert {(-k - 1, int(i)) for k in range(1200) for i in np.flatnonzero(scores[k] >= np.sort(scores[k])[-5] - 0.1)} <= got
