"""Operators 11 to 13 against brute force, held-out rows and SQL, and the awkward rows that each must survive."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tesserae.llm import common, divergence, importance, language

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"w{k % 977}" for k in range(30_000))
AWKWARD = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "a"), (2, "the quick brown fox jumps over the lazy dog", "en", "a"), (3, "", "en", None), (4, None, None, "b"), (None, "no id here at all", "en", "b"),
    (None, None, None, None), (5, "same row", "fr", "c"), (5, "same row", "fr", "c"), (5, "same id, other text", "fr", "c"), (6, LONG, "en", "a"), (7, "é𝒳 ü\t\n x ÀÉ", "de", "é"), (8, "x" * 5000 + " \0 " + "ÿ" * 300, "", "a"), (9, "12 3.4 -- !!", "en", ""),
]
DDL = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty and very long texts, repeats and ties, further columns that clash with inner names."""
    df = spark.createDataFrame(AWKWARD, DDL)
    for name in ("weight", "score", "rank", "part", "n", "k", "bucket", "spans", "term", "zero", "LANG_PRED", "n_words"):
        df = df.withColumn(name, F.lit(name))
    return df


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


def write(df, tmp_path, name="documents"):
    df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return f"{tmp_path}/{name}.parquet/*.parquet"


# 11 language


def brute_path(scores: np.ndarray, prior: np.ndarray, switch: float) -> float:
    """The best path's score by looking at every predecessor."""
    best = [float(scores[0][k] + prior[k]) for k in range(len(prior))]
    for row in scores[1:]:
        best = [max(b - (switch if j != k else 0) for j, b in enumerate(best)) + float(row[k]) for k in range(len(prior))]
    return max(best)


def test_path_is_the_best_of_all():
    rng = np.random.default_rng(3)
    for _ in range(30):
        sizes = rng.integers(0, 9, 6)
        first = np.concatenate([[0], np.cumsum(sizes)])
        scores = rng.normal(0, 4, (first[-1], 3)).astype(np.float32)
        prior = np.log(np.array([0.5, 0.3, 0.2])).astype(np.float32)
        model = language.Model(["a", "b", "c"], np.zeros((language.RUNS, 3), np.float32), np.ones((language.N_SCRIPTS + 1, 3), bool), prior)
        label = model.path(scores, first, 3.0)
        for low, high in zip(first, first[1:], strict=False):
            if low < high:
                got = prior[label[low]] + sum(scores[t][label[t]] for t in range(low, high)) - 3.0 * sum(label[t] != label[t - 1] for t in range(low + 1, high))
                assert got == pytest.approx(brute_path(scores[low:high], prior, 3.0), abs=1e-3)


def test_words_are_runs_of_letters_with_their_marks():
    texts = ["", "Zöe's ÄÖ 12x", "́a", "привет, мир—да", "漢字 かな", "𝒳y\0z"]
    words = language.Words.of(texts)
    for k, t in enumerate(texts):
        got = [(int(words.start[w] - words.base[k]), int(words.size[w])) for w in range(words.first[k], words.first[k + 1])]
        assert got == [(m.start(), len(m[0])) for m in re.finditer(r"[^\W\d_][^\W\d_̀-ͯ]*(?:[̀-ͯ]+[^\W\d_]*)*", t)]
    assert [language.SCRIPTS[s - 1][0] for s in words.script[words.first[3] : words.first[5]]] == ["cyrillic"] * 3 + ["han", "kana"]


def test_word_scores_equal_a_plain_sum(spark):
    rows = [(k, t, g) for k, (t, g) in enumerate([("the thing and the other", "en"), ("der andere und die", "de"), ("мир и дом", "ru")] * 2)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.names == ["de", "en", "ru"]
    text = "the мир ab"
    words = language.Words.of([text])
    scores = model.scores(words)
    for w, word in enumerate(text.split()):
        want = np.zeros(3)
        padded = "\0" + word + "\0"
        for k, order in enumerate(language.ORDERS):
            for p in range(len(padded) - order + 1):
                h = np.uint64(0)
                for c in padded[p : p + order]:
                    h = (h ^ np.uint64(ord(c))) * np.uint64(0x9E3779B1) & np.uint64(0xFFFFFFFF)
                    h ^= h >> np.uint64(15)
                want += model.runs[k * language.BUCKETS + int((h * np.uint64(0x85EBCA6B) & np.uint64(0xFFFFFFFF)) >> np.uint64(17))]
        want = want / 3 - language.FOREIGN * ~model.own[words.script[w]]
        assert scores[w] == pytest.approx(want, abs=1e-3)
    assert list(model.own[words.script[1]]) == [False, False, True]


def test_spans_of_mixed_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.train(docs)
    clean = [r.text for r in docs.where("lang = 'en' and length(text) between 300 and 900").orderBy("doc_id").limit(1).collect()]
    other = [r.text for r in docs.where("lang = 'de' and length(text) between 300 and 900").orderBy("doc_id").limit(1).collect()]
    text = clean[0] + "\n" + other[0]
    row = language.identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    cover = Counter()
    for s in row.spans:
        assert 0 <= s.start < s.end <= len(text) and text[s.start].isalpha()
        for p in range(s.start, s.end):
            cover[("en" if p < len(clean[0]) else "de") == s.lang] += 1
    assert cover[True] > 0.95 * sum(cover.values())
    assert all(a.end <= b.start and a.lang != b.lang for a, b in zip(row.spans, row.spans[1:], strict=False))


def test_language_on_held_out_documents(spark, sf_dir):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = language.op11_language(spark, sf_dir).collect()
    assert len(out) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in out)
    kept = [r for r in out if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in kept) >= 0.97 * len(kept)


def test_language_of_awkward_rows(spark, awkward, empty, tmp_path):
    model = language.train(awkward)
    assert model.names == ["", "de", "en", "fr"]
    out = language.identify(awkward, model).collect()
    assert len(out) == len(AWKWARD)
    for r, (doc, text, _, _) in zip(sorted(out, key=lambda r: (str(r.doc_id), r.lang_pred, r.score)), sorted(AWKWARD, key=lambda x: str(x[0])), strict=False):
        assert str(r.doc_id) == str(doc)
    by = {r.doc_id: r for r in out if r.doc_id is not None}
    assert by[3].lang_pred == by[4].lang_pred == by[9].lang_pred == "und" and by[3].score == 0 and by[3].spans == []
    assert by[1].lang_pred == by[2].lang_pred == "en"
    assert language.identify(empty, model).count() == 0
    nothing = language.train(empty)
    assert {r.lang_pred for r in language.identify(awkward, nothing).collect()} == {"und"}
    write(awkward.select("doc_id", "text", "lang", "source"), tmp_path)
    assert language.op11_language(spark, str(tmp_path)).count() == len(AWKWARD)


# 12 importance


def runs_of(text: str | None) -> tuple[int, list[int]]:
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute_importance(docs: list[tuple], target: list[str | None]) -> list[tuple]:
    source, wanted, own = Counter(), Counter(), []
    for doc, text in docs:
        own.append((doc, *runs_of(text)))
        source.update(own[-1][2])
    for text in target:
        wanted.update(runs_of(text)[1])
    s_all, t_all = sum(source.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10_000) / ((source[b] + 1) * (t_all + 10_000)))) for b in range(10_000)]
    rows = []
    for doc, n, found in own:
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    for k, r in enumerate(fit[: 5 * len(fit) // 100], 1):
        r[5] = k
    return sorted([(str(r[0]), *r[2:]) for r in rows], key=str)


def test_importance_equals_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    out = importance.op12_importance(spark, sf_dir).collect()
    assert sorted([(str(r.doc_id), r.n_features, r.weight, r.score, r["rank"]) for r in out], key=str) == brute_importance(docs, target)


@pytest.mark.parametrize("size", [1, 50, 1 << 22])
def test_runs_of_any_bytes(size):
    rng = random.Random(size)
    texts = [None, "", "a", "A b", "é" * 200, "x" * 5000 + " y", "\0a\0", "𝒳-𝒴 z"] + ["".join(rng.choice("aZ9 .é漢𝒳\n") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["skipped", *texts, "skipped"])}).slice(1, len(texts))
    low = 0
    for part in common.text_slices(batch, "text", size):
        met = defaultdict(list)
        for owner, found in importance.run_buckets(part.column("text"), 10_000):
            for k, b in zip(owner, found, strict=True):
                met[int(k)].append(int(b))
        for k in range(part.num_rows):
            assert sorted(met[k]) == sorted(runs_of(texts[low + k])[1])
        low += part.num_rows
    assert low == len(texts)


def test_blocks_of_starts_keep_every_run(monkeypatch):
    text = " ".join(f"w{k}" for k in range(1000))
    monkeypatch.setattr(importance, "BLOCK", 7)
    found = [int(b) for _, bs in importance.run_buckets(pa.array([text, None, "a b"]), 10_000) for b in bs]
    assert sorted(found) == sorted(runs_of(text)[1] + runs_of("a b")[1])


def test_ranks_do_not_depend_on_the_ranges(spark):
    rows = [(k if k % 9 else k // 2, 30 - (k % 4 == 0) * 15, 1, 0, (k * 7919) % 50) for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")
    fit = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0]))
    want = [(r[0], r[4], k) for k, r in enumerate(fit[: 40 * len(fit) // 100], 1)]
    for ranked in (10, 100, 10_000):
        out = importance.draw(df, 40, ranked=ranked).collect()
        assert len(out) == len(rows)
        assert sorted([(r.doc_id, r.score, r["rank"]) for r in out if r["rank"]], key=lambda r: r[2]) == want


def test_importance_of_awkward_rows(spark, awkward, empty, tmp_path):
    target = spark.createDataFrame([(1, "the quick brown fox"), (2, None), (None, "")], "item_id long, text string")
    scored = importance.importance(awkward, target).collect()
    want = brute_importance([(d, t) for d, t, _, _ in AWKWARD], ["the quick brown fox", None, ""])
    assert sorted([(str(r.doc_id), r.n_features, r.weight, r.score) for r in scored], key=str) == sorted([w[:4] for w in want], key=str)
    assert importance.resample(awkward, target, percent=100, least_words=1).columns == awkward.columns
    assert importance.resample(awkward, target, percent=100, least_words=1).count() == sum(d in {i for i, t, _, _ in AWKWARD if runs_of(t)[0]} for d, *_ in AWKWARD)
    write(empty, tmp_path)
    write(target, tmp_path, "benchmark")
    assert importance.op12_importance(spark, str(tmp_path)).count() == 0


# 13 divergence


def test_divergence_matches_sql(same_as_sql):
    assert same_as_sql(divergence.op13_divergence, divergence.ORACLE) > 0


def compare(spark, df, tmp_path, **limits):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{write(df, tmp_path)}'")
    told = sorted(map(tuple, con.sql(divergence.ORACLE.replace(">= 3", f">= {limits.get('least', 3)}").replace("rank <= 200", f"rank <= {limits.get('top', 200)}")).fetchall()))
    out = divergence.divergence(spark.read.parquet(f"{tmp_path}/documents.parquet"), **limits)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, out.collect())) == told
    return told


@pytest.mark.parametrize(("least", "top"), [(1, 200), (2, 3), (3, 200)])
def test_divergence_of_awkward_rows(spark, awkward, tmp_path, least, top):
    rows = compare(spark, awkward, tmp_path, least=least, top=top)
    assert any(lang == "" for lang, *_ in rows)


def test_divergence_in_many_small_runs(spark, tmp_path, monkeypatch):
    rng = random.Random(11)
    rows = [(k, " ".join(rng.choice(("ab", "Cd", "é", "x1y", "zz", "qq")) for _ in range(rng.randint(0, 40))), rng.choice(("en", "de", None)), rng.choice(("s", "t", "u", None))) for k in range(300)]
    monkeypatch.setattr(divergence, "HELD", 4)
    monkeypatch.setattr(divergence, "SHARD", 3)
    compare(spark, spark.createDataFrame(rows, DDL), tmp_path)


def test_divergence_of_an_empty_table(empty):
    assert divergence.divergence(empty).count() == 0
