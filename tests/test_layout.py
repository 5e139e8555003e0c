"""Characters stay, layout moves, or the version is refused."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F
from tesserae.functions import layout


def reprojected(spark, *pairs):
    out = spark.createDataFrame([(k, b, a) for k, (b, a) in enumerate(pairs)], "k int, b string, a string").select("k", layout.reprojected(F.col("b"), F.col("a")).alias("r")).collect()
    return [r.r for r in sorted(out, key=lambda r: r.k)]


def bare(markup):
    return re.sub(r"<[^>]+>|\s", "", markup)


@pytest.mark.parametrize(("before", "after", "want"), [
    ("the “XQ” rules,apply", 'the ("XQ") rules', None), ("“XQ”rules", '"XQ" rules', "“XQ” rules"), ("a<b>bc</b>", "ab <i>c</i>", "ab <i>c</i>"), ("x&amp;y", "x & y", "x &amp; y"), ("x &#38; y", "x&amp;<br>y", "x&#38;<br>y"),
    ("abc", "abd", None), ("abc", "ab", None), ("1.2", "1,2", "1.2"), ("1.2", "1.3", None), ("", "", ""), ("", " <br> ", " <br> "), ("a < b", "a<br>< b", "a<br>< b"), (None, "x", None), ("é𝒳!", "é 𝒳?", "é 𝒳!"), ("&#233;a", "é a", "&#233; a"),
])
def test_layout_around_the_own_characters(spark, before, after, want):
    assert reprojected(spark, (before, after)) == [want]


def test_content_is_never_changed(spark):
    rng = random.Random(3)
    text = lambda: "".join(rng.choice(["a", "B", " ", "\n", "<br>", "&lt;", ".", ",", "é", "<", "1"]) for _ in range(rng.randint(0, 12)))
    pairs = [(b, text() if rng.random() < 0.4 else b.replace(",", ";<p>").replace("a", "a ")) for b in (text() for _ in range(300))]
    done = 0
    for (before, _), got in zip(pairs, reprojected(spark, *pairs), strict=True):
        if got is not None:
            done += 1
            assert bare(got) == bare(before)
    assert done > 100


def respaced(spark, cell, page):
    return spark.createDataFrame([(cell, page)], "c string, p string").select(layout.respaced(F.col("c"), F.col("p")).alias("r")).first().r


@pytest.mark.parametrize(("cell", "page", "want"), [
    ("lists:The firstSecond of", "it lists:\n*  x lists:\n The first\nSecond of it", "lists: The first Second of"), ("on<b>Page Q</b>or", "on Page Q or other", "on <b>Page Q</b> or"), ("a  b", "ab", "a  b"), ("a<br>b", "a b", "a<br>b"),
    ("abc", "xyz", "abc"), ("abc", None, "abc"), ("", "a b", ""), ("A&amp;B", "A & B", "A &amp; B"), ("ab", "xa by", "a b"), ("𝒳é", "z 𝒳 é", "𝒳 é"),
])
def test_spaces_come_back_and_nothing_else(spark, cell, page, want):
    assert respaced(spark, cell, page) == want


@pytest.mark.parametrize(("cell", "page", "want"), [("a bc", "ab c\n a bc\n", "a bc"), ("a b,cd", "ab, c d\na b, cd", "a b, cd"), ("abc", "x a b c\nab c", "a b c"), ("a bc", "ab c\nx a bc", "a b c")])
def test_a_line_that_agrees_with_the_own_spaces_goes_first(spark, cell, page, want):
    assert respaced(spark, cell, page) == want


def test_lines_that_differ_in_their_spaces_alone_come_back(spark, tmp_path):
    from tesserae.plans.layout import respaced_lines

    spark.createDataFrame([(1, "ab c. De\na bc. De")], "doc_id long, text string").unionByName(spark.createDataFrame([(2, "no tes of\nnot es of")], "doc_id long, text string")).write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(r.said for r in respaced_lines(spark, str(tmp_path)).collect()) == ["a bc. De", "ab c. De", "no tes of", "not es of"]


@pytest.mark.parametrize(("cell", "page", "place", "want"), [
    ("ab", "x a b\nab", "ab", "ab"), ("ab", "x ab\na  b ", "a  b ", "a b"), ("a &amp;b", "a& b\na & b", "a & b", "a &amp; b"), ("a<br>bc", "ab c\na b c", "a b c", "a<br>b c"), ("a b", "a b\nab", "ab", "a b"), ("abc", "a bc", "x", "a bc"),
    (r"a\Eb", r"a\E b", r"a\E b", r"a\E b"), ("a.b", "a.  b\nacb", "a.  b", "a. b"),
])
def test_a_known_place_goes_first(spark, cell, page, place, want):
    found = spark.createDataFrame([(cell, page, place)], "c string, p string, at string").select(layout.respaced(F.col("c"), F.col("p"), F.col("at")).alias("r"))
    assert found.first().r == want


def test_lines_keep_their_own_spaces_wherever_else_their_letters_stand(spark, tmp_path):
    from tesserae.plans.layout import respaced_lines

    text = "a taxi new here\nin\nit ends, b. Then\nit ends,b. Then\nit ends,b.Then\nq & <b> \"r\", S\nq & <b> \"r\",S"
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [r.said for r in sorted(respaced_lines(spark, str(tmp_path)).collect(), key=lambda r: r.ord)] == text.split("\n")


def test_a_line_may_have_any_number_of_words(spark):
    place = "Word, " * 20_000
    found = spark.createDataFrame([(place.strip().replace(" ", ""), place, place)], "c string, p string, at string").select(layout.respaced(F.col("c"), F.col("p"), F.col("at")).alias("r"))
    assert found.first().r == place.strip()
