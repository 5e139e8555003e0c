"""Chains against all chains, headings that are lost, mentioned early or spelt apart, and the slices between them."""

from __future__ import annotations

import random

import pytest
from tesserae.operators import chains


def brute_worth(pairs):
    best = 0
    done = {}
    for k in sorted(range(len(pairs)), key=lambda k: pairs[k][:2]):
        a, b, w = pairs[k]
        done[k] = w + max((done[j] for j in done if pairs[j][0] < a and pairs[j][1] < b), default=0)
        best = max(best, done[k])
    return best


def test_best_chain_equals_all_pairs():
    rng = random.Random(8)
    for _ in range(400):
        pairs = [(rng.randint(0, 9), rng.randint(0, 9), rng.choice((1, 1, 2, 5))) for _ in range(rng.randint(0, 25))]
        got = [pairs[k] for k in chains.best_chain(pairs)]
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:], strict=False))
        assert sum(x[2] for x in got) == brute_worth(pairs)


def test_chains_by_key(spark):
    rng = random.Random(1)
    rows = [(k, rng.randint(0, 30), rng.randint(0, 30)) for k in range(4) for _ in range(60)]
    out = chains.longest_chain(spark.createDataFrame(rows, "k long, a int, b int"), ["k"]).collect()
    for k in range(4):
        assert sum(r.k == k for r in out) == brute_worth([(a, b, 1) for x, a, b in rows if x == k])


def lcs(x, y):
    t = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, a in enumerate(x):
        for j, b in enumerate(y):
            t[i + 1][j + 1] = t[i][j] + 1 if a == b else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_aligned_lists_have_a_longest_common_subsequence(spark):
    rng = random.Random(6)
    lists = [[[rng.choice("abcdef") for _ in range(rng.randint(0, 12))] for _ in range(2)] for _ in range(25)]
    frame = lambda side: spark.createDataFrame([(k, i, v) for k, pair in enumerate(lists) for i, v in enumerate(pair[side])], "k long, i int, v string")
    out = chains.aligned(frame(0), frame(1), ["k"], "i", "v").collect()
    for k, (x, y) in enumerate(lists):
        got = [r for r in out if r.k == k]
        assert len(got) == lcs(x, y) and all(x[r.a] == y[r.b] for r in got)


def located(spark, headings, *text):
    source, pos = [], 0
    for line in text:
        for k, w in enumerate(line.lower().split()):
            source.append((1, pos, w, k == 0))
            pos += 1
    asked = spark.createDataFrame([(1, i, h.lower().split()) for i, h in enumerate(headings)], "doc_id long, i int, words array<string>")
    return chains.located(asked, spark.createDataFrame(source, "doc_id long, pos int, word string, line_start boolean")), source


def spots(found):
    return {r.i: (r.at, r.n) for r in found.collect()}


def test_a_lost_heading_takes_no_other_with_it(spark):
    found, _ = located(spark, ["Range of duties", "Not there at all", "Door sales", "Final notes"], "Range of duties", "some words", "Door sales", "more", "Final notes", "end")
    assert spots(found) == {0: (0, 3), 1: (None, None), 2: (5, 2), 3: (8, 2)}


def test_a_mention_before_the_heading_is_passed_over(spark):
    found, _ = located(spark, ["Short stays", "Notice boards", "Door sales"], "see Notice boards and Door sales below", "Short stays", "words", "Notice boards", "as said under Door sales", "Door sales", "words")
    assert spots(found) == {0: (7, 2), 1: (10, 2), 2: (17, 2)}


def test_headings_spelt_apart_or_without_their_number(spark):
    found, _ = located(spark, ["Co-ownership of boats", "4.2 Harbour masters", "Rest of it"], "Co owner ship of boats", "body", "Harbour masters", "restofit no", "Rest of it")
    assert spots(found) == {0: (0, 5), 1: (6, 2), 2: (10, 3)}


def test_only_whole_words_count(spark):
    found, _ = located(spark, ["art work", "no words"], "smart work", "art working", "x")
    assert spots(found) == {0: (None, None), 1: (None, None)}


def test_own_slices(spark):
    found, source = located(spark, ["One part", "Gone", "Two part", "Three part"], "intro", "One part", "a b c", "Two part", "d", "Three part", "e f")
    sizes = spark.createDataFrame([(1, len(source))], "doc_id long, n int")
    out = {r.i: ([w for _, _, w, _ in source][r.start : r.end], r.closed) for r in chains.own_slices(found, sizes).collect()}
    assert out == {0: (["a", "b", "c"], False), 2: (["d"], True), 3: (["e", "f"], True)}


@pytest.mark.parametrize("text", [["the plan", "x", "the plan", "y", "the plan"]])
def test_repeated_headings_each_get_a_place(spark, text):
    found, _ = located(spark, ["the plan"] * 3, *text)
    assert spots(found) == {0: (0, 2), 1: (3, 2), 2: (6, 2)}


def test_no_headings_or_no_source(spark):
    asked = spark.createDataFrame([(1, 0, ["a", "b"]), (2, 0, None)], "doc_id long, i int, words array<string>")
    none = spark.createDataFrame([], "doc_id long, pos int, word string, line_start boolean")
    assert {(r.doc_id, r.i, r["at"]) for r in chains.located(asked, none).collect()} == {(1, 0, None), (2, 0, None)}
    assert chains.located(asked.limit(0), none).count() == 0
