"""The pipeline: each stage's decisions take effect on all that the one before kept."""

from __future__ import annotations

import corpus_pipeline
import pytest
from tesserae.llm import decontaminate
from tesserae.llm.common import cut


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [("input", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"test-{name}")
        out.append((name, docs))
    return dict(out)


def ids(df):
    return [r.doc_id for r in df.select("doc_id").collect()]


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dups", "decontaminate", "pii", "mix"]
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].dtypes == stages["input"].dtypes


def test_quality_keeps_good_labels_and_drops_bad(spark, sf_dir, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = set(ids(stages["quality"]))
    known = [d for d in ids(stages["input"]) if d in labels]
    assert sum((d in kept) == (labels[d] == 1) for d in known) >= 0.95 * len(known)


def test_one_of_each_copy_stays(stages):
    before, after = stages["quality"].collect(), stages["near_dups"].collect()
    assert len({r.text for r in after}) == len(after) and len(after) <= len({r.text for r in before})
    for r in after:
        assert r.doc_id == min(x.doc_id for x in before if x.text == r.text)


def test_no_benchmark_passage_is_left(spark, sf_dir, stages):
    before = {r.doc_id: bool(r.hits) for r in decontaminate.overlaps(stages["near_dups"], spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert sorted(ids(stages["decontaminate"])) == sorted(d for d, bad in before.items() if not bad)


def test_personal_data_goes_and_nothing_else(stages):
    before = {r.doc_id: r.text for r in stages["decontaminate"].collect()}
    for r in stages["pii"].collect():
        assert "@" not in r.text or "@" in before[r.doc_id] and r.text != ""
        assert r.n_chars == len(r.text)
        if "<" not in r.text:
            assert r.text == before[r.doc_id]
    assert stages["pii"].count() == len(before)


def test_mix_is_near_its_targets(stages):
    by = {}
    for r in stages["mix"].collect():
        assert 0 < r.taken <= 2 * r.size
        by.setdefault(r.source, []).append(r)
    for rows in by.values():
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= max(r.size for r in rows) + 2_000


def test_run_is_the_stages_in_order(spark, sf_dir, stages):
    a = sorted((r.doc_id, r.text, r.taken) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert a == sorted((r.doc_id, r.text, r.taken) for r in stages["mix"].collect())


def test_awkward_rows_pass_every_stage(spark, sf_dir):
    rows = [(1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (2, None, None, None, None), (None, "", None, "t", 0), (None, "x y z " * 9000, "en", "t", 54000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, frame, sf_dir).count() <= len(rows)
