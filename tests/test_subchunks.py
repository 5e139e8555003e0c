"""Sub-sections under their own number, conservation, and what sections are filed under."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from tesserae.functions import rules as R
from tesserae.functions import text as T
from tesserae.operators import subchunks
from tesserae.plans import load_catalog


def split(spark, *texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    parts = subchunks.split_sections(rows, "k", "t")
    assert all(r.ok for r in subchunks.conserved(rows, "k", "t", parts).collect())
    return sorted((r.key, r.part, r.id, r.title, r.body) for r in parts.collect())


def test_only_sub_headings_of_the_own_number_cut(spark):
    text = "# 10 Boats\n\nintro\n### 8.12 Elsewhere\ntable\n### 10.1 Who\nbody\n#### 10.1.2 Deeper\nx\n## 101.1 Not mine\n### 10.2\nend"
    got = split(spark, text)
    assert [(g[1], g[2], g[3]) for g in got] == [(0, None, None), (1, "10.1", "Who"), (2, "10.1.2", "Deeper"), (3, "10.2", "")]
    assert got[0][4] == "# 10 Boats\n\nintro\n### 8.12 Elsewhere\ntable\n" and got[2][4].endswith("## 101.1 Not mine\n")


def test_without_an_own_number_every_numbered_heading_cuts(spark):
    assert [g[2] for g in split(spark, "# Front\n### 2.1 a\nx\n### 7.3 b\ny")] == [None, "2.1", "7.3"]
    assert [g[2] for g in split(spark, "# Appendix 4 Rest\n### 4.1 a\n### 5.1 b\n")] == [None, "4.1"]


def test_texts_without_cuts_stay_whole(spark):
    assert split(spark, "", "# 1 A\nno sub", "# 2 B\n# 2.1 one mark\n##### 2.2 five", None) == [(0, 0, None, None, ""), (1, 0, None, None, "# 1 A\nno sub"), (2, 0, None, None, "# 2 B\n# 2.1 one mark\n##### 2.2 five")]
    assert [(g[1], g[2]) for g in split(spark, "### 3.1 starts\nx\n### 3.2 y")] == [(1, "3.1"), (2, "3.2")]


def test_pieces_always_add_up(spark):
    rng = random.Random(5)
    lines = ["# 3 Own", "### 3.1 a", "### 3.2 b ", "## 4.1 c", "text. 3.1", "", "#### 3.1.1", "# 5 Other", "\t### 3.9 indented", "é𝒳 ### 3.1"]
    split(spark, *["\n".join(rng.choice(lines) for _ in range(rng.randint(0, 12))) for _ in range(80)])


def test_a_changed_piece_is_noticed(spark):
    rows = spark.createDataFrame([(1, "# 1 A\n### 1.1 b\nc")], "k long, t string")
    parts = subchunks.split_sections(rows, "k", "t").withColumn("body", F.replace("body", F.lit("c"), F.lit("")))
    assert [r.ok for r in subchunks.conserved(rows, "k", "t", parts).collect()] == [False]


def test_prefixes(spark):
    rows = [
        (1, 0, "cover", "cover", None), (1, 1, "# 1 Opening\nx", "opening", None), (1, 2, "# 5 Waiting", "waiting", None), (1, 3, "# 6 Doing", "doing", None), (1, 4, "# 1 Words for all", "disclaimers-first", None), (1, 5, "# DISCLAIMERS: more", "disclaimers-more", None),
        (1, 6, "# Appendix 2 Notes", "notes", None), (1, 7, "# 5 Again five\nx", "again", None), (1, 8, "# 9 Freed\n\n**SCHEDULE 3**\n", "freed", None), (1, 9, "# 7 Was labelled", "was", "# 7 Was\nANNEXES 4:\nx"), (1, 10, "# 5 Third", "third", None), (2, 0, "# 5 Other book", "o", None),
    ]
    df = spark.createDataFrame(rows, "b long, o int, t string, n string, e string")
    out = {(r.b, r.o): r.prefix for r in subchunks.prefixes(df, "b", "o", "t", "n", "e").collect()}
    assert [out[1, k] for k in range(11)] == ["00", "01", "05", "06", "A1", "A6", "A2", "A5", "S3", "N4", "A5"] and out[2, 0] == "05"


@pytest.mark.parametrize(("name", "version", "run"), [("v1.2", True, True), ("2026-02_a", True, True), ("V1", False, True), ("_progress", False, False), ("a#b", False, False), ("a b", False, False), ("", False, False), ("a" * 49, True, True), ("a" * 50, False, True), ("a" * 65, False, False), ("-a", False, False)])
def test_names_of_versions_and_runs(spark, name, version, run):
    r = spark.range(1).select(R.valid_version(F.lit(name)).alias("v"), R.valid_run(F.lit(name)).alias("r")).first()
    assert (r.v, r.r) == (version, run)


def test_suggestions_mend_nine_of_ten_planted_errors(spark, sf_dir):
    found = {r.q: r.suggestion for r in load_catalog().QUERIES["question_suggestions"](spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", T.tokens(F.col("text")).alias("w")).collect()
    whole = {r.item_id: r.w for r in rows}
    # the longest word has its last two letters the other way round; where they are alike nothing is wrong
    planted = [q for q, w in whole.items() if (x := max(w, key=lambda w: (len(w), w)))[-1] != x[-2]]
    assert len(planted) > 10 and sum(found[q] == " ".join(whole[q]) for q in planted) >= 0.9 * len(planted)
