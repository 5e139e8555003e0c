"""Rows to pages and rows to batches, against plain loops."""

from __future__ import annotations

import random
import re

import pytest
from tesserae.operators import batches


def brute_batches(rows, most_rows, most_chars, by_page):
    out, n, chars, page, batch = [], 0, 0, None, -1
    for size, p in rows:
        if not n or n >= most_rows or chars + size > most_chars or by_page and p != page:
            batch, n, chars, page = batch + 1, 0, 0, p
        n, chars = n + 1, chars + size
        out.append(batch)
    return out


@pytest.mark.parametrize("by_page", [False, True])
def test_batches_equal_a_loop(spark, by_page):
    rng = random.Random(3)
    tables = [[(rng.choice((1, 40, 300, 1200)), rng.choice((1, 1, 2, None))) for _ in range(rng.randint(1, 40))] for _ in range(20)]
    df = spark.createDataFrame([(k, i, s, p) for k, t in enumerate(tables) for i, (s, p) in enumerate(t)], "key long, ord long, size int, page long")
    out = {(r.key, r.ord): r.batch for r in batches.planned(df, 4, 1000, by_page).collect()}
    for k, t in enumerate(tables):
        assert [out[k, i] for i in range(len(t))] == brute_batches(t, 4, 1000, by_page)


def words(text):
    return re.findall("[0-9a-z]+", (text or "").lower())


def brute_pages(rows, pages):
    hay = {p: f" {' '.join(words(t))} " for p, t in pages}
    out, last = [], min(hay)
    for text in rows:
        w, hit = words(text), None
        for at in dict.fromkeys(len(w) * n // 3 for n in (0, 1, 2)):
            run = w[at : at + 6]
            if len(run) == 6:
                hit = next((p for p in sorted(hay) if f" {' '.join(run)} " in hay[p]), None)
            if hit is not None:
                break
        last = last if hit is None else hit
        out.append(last)
    return out


def attributed(spark, rows, pages, **kw):
    r = spark.createDataFrame([(1, i, t) for i, t in enumerate(rows)], "key long, ord long, said string")
    p = spark.createDataFrame([(1, n, t) for n, t in pages], "key long, page long, said string")
    return [x.page for x in sorted(batches.attributed(r, p, **kw).collect(), key=lambda x: x.ord)]


def test_rows_stand_on_the_page_that_has_their_words(spark):
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(60)]
    for _ in range(4):
        rows = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 25))) for _ in range(25)]
        pages = [(n, " ".join(rows[n * 5 : n * 5 + 5])) for n in range(5)]
        asked = [r if rng.random() < 0.8 else "mangled " + r for r in rows] + [None, "!!"]
        assert attributed(spark, asked, pages) == brute_pages(asked, pages)


def test_in_order_a_row_that_repeats_does_not_go_back(spark):
    line = "the same words stand on every page"
    pages = [(1, f"{line} alpha one two three four five six"), (2, f"beta one two three four five six {line}"), (3, "gamma one two three four five six")]
    rows = ["alpha one two three four five six", "beta one two three four five six", line, "gamma one two three four five six"]
    assert attributed(spark, rows, pages) == [1, 2, 1, 3]
    assert attributed(spark, rows, pages, in_order=True) == [1, 2, 2, 3]


def test_a_later_probe_finds_a_row_whose_start_is_lost(spark):
    body = " ".join(f"b{k}" for k in range(20))
    assert attributed(spark, [f"zz yy xx {body}"], [(4, "other words"), (5, body)]) == [5]
