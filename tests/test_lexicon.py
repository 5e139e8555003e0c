"""Suggestions against all pairs, and chunks."""

import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from tesserae.operators import lexicon
from tesserae.plans import load_catalog


def test_close_matches_equal_all_pairs(spark):
    terms = {"shareholding": 9, "disclosure": 30, "holding": 12, "closure": 3, "threshold": 7, "thresholds": 8}
    words = ["sharehodling", "disclosuer", "treshold", "hodling", "clsoure", "zzz", "thresold"]
    out = lexicon.close_matches(spark.createDataFrame([(w,) for w in words], "word string"), spark.createDataFrame(list(terms.items()), "term string, freq int"))
    got = {r.word: r.term for r in out.collect()}
    for w in words:
        fits = [(round(r, 1), f, r, t) for t, f in terms.items() if w[0] == t[0] and abs(len(w) - len(t)) <= 2 and (r := SequenceMatcher(None, w, t).ratio()) >= 0.8]
        assert got.get(w) == (max(fits)[3] if fits else None)


def test_chunks_keep_all_paragraphs(spark):
    paragraphs = [f"Paragraph {k} says so. " + "word " * (20 * k) for k in range(9)]
    rows = spark.createDataFrame([("\n".join(paragraphs),), ("",), (None,)], "t string").select(lexicon.chunk_text(F.col("t"), 400, 60).alias("c")).collect()
    assert [len(r.c) for r in rows[1:]] == [0, 0]
    joined = "\n".join(rows[0].c)
    assert all(p.strip() in joined for p in paragraphs)


def test_paragraph_chunks_keep_long_texts_whole(spark, tmp_path):
    paragraphs = [f"Paragraph {k} says so. " + "word " * 150 for k in range(40)]
    spark.createDataFrame([(1, "\n".join(paragraphs))], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert load_catalog().QUERIES["paragraph_chunks"](spark, str(tmp_path)).where("doc_id = 1").count() == len(paragraphs)
    rows = spark.createDataFrame([("\n".join(paragraphs),)], "t string").select(lexicon.chunk_text(F.col("t")).alias("c"), lexicon.chunk_text(F.col("t"), most=10).alias("few")).first()
    assert all(p.strip() in "\n".join(rows.c) for p in paragraphs) and rows.few == rows.c[:10]


def test_letters_that_one_word_has_alone_leave_no_close_pair_out(spark):
    rng = random.Random(4)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choices("abcdeféß\u0430\u0431", k=rng.randint(4, 12)))
        b = "".join(c for c in a if rng.random() < 0.9) + rng.choice(["", "x", "é"])
        pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", F.bit_count(lexicon.letter_set(F.col("a")).bitwiseXOR(lexicon.letter_set(F.col("b")))).alias("n"))
    for r in df.collect():
        assert r.n <= len(r.a) + len(r.b) - 2 * sum(m.size for m in SequenceMatcher(None, r.a, r.b).get_matching_blocks())


def test_common_letters_equal_the_table():
    rng = random.Random(5)
    for _ in range(300):
        p, q = ("".join(rng.choice("abcé𝒳") for _ in range(rng.randint(0, 9))) for _ in range(2))
        row = [0] * (len(q) + 1)
        for c in p:
            row = [0, *row]
            last, now = row[1:], [0]
            for j, d in enumerate(q):
                now.append(last[j] + 1 if c == d else max(now[j], last[j + 1]))
            row = now
        assert lexicon.common_letters(p, q) == row[-1]


def test_pairs_of_one_initial_and_length_are_shared_out(spark):
    words = [f"a{k:07d}" for k in range(0, 4000, 2)]
    rows = spark.createDataFrame([(w,) for w in words], "word string")
    terms = spark.createDataFrame([(f"a{k:07d}", k) for k in range(1, 4000, 2)], "term string, freq int")
    plan = lexicon.close_matches(rows, terms)._jdf.queryExecution().optimizedPlan().toString()
    assert "_i" in plan and "_j" in plan
