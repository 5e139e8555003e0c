"""Section trees, clause keys and gaps on small shapes."""

from pyspark.sql import functions as F

import pytest

from tesserae.functions import text as T
from tesserae.operators import gaps, outline, trees


def shape(*lines):
    """Blocks from ``#`` marks (headings by hint), ``-`` (list items) and plain text."""
    out = []
    for k, x in enumerate(lines):
        if x.startswith("#"):
            mark, text = x.split(" ", 1)
            out.append((1, k, "text", len(mark), text, k // 5))
        else:
            out.append((1, k, "list", 0, x[2:], k // 5) if x.startswith("- ") else (1, k, "text", 0, x, k // 5))
    return out


def opened(spark, *lines, by_rank=False):
    df = spark.createDataFrame(shape(*lines), "doc_id long, ord int, kind string, hint int, text string, page int")
    return sorted(outline.section_tree(df, by_rank).where("level is not null").collect(), key=lambda r: r.ord)


def levels(spark, *lines, **kw):
    return {r.ord: (r.level, r.parent) for r in opened(spark, *lines, **kw)}


def test_families_nest_one_level_at_a_time(spark):
    assert levels(spark, "# A. Part", "# 1. Intro", "# 1.1 Scope", "- (a) first", "- (i) inner", "- (ii) more", "- (b) second", "# B. Next") == {0: (1, -1), 1: (2, 0), 2: (3, 1), 3: (4, 2), 4: (5, 3), 5: (5, 3), 6: (4, 2), 7: (1, -1)}


def test_numbers_without_a_letter_start_at_the_top(spark):
    assert levels(spark, "# 1. Methods", "# 1.1 Data", "# 1.1.1.1 Deep", "# 2. More") == {0: (1, -1), 1: (2, 0), 2: (4, 1), 3: (1, -1)}


def test_a_letter_that_comes_next_is_no_roman_number(spark):
    found = opened(spark, "# 1. X", "- (h) eight", "- (i) nine", "- (j) ten")
    assert [(r.family, r.level) for r in found] == [("decimal", 1), ("paren_alpha", 2), ("paren_alpha", 2), ("paren_alpha", 2)]
    found = opened(spark, "# 1. X", "- (b) two", "- (i) first", "- (ii) second", "- (v) fifth", "- (c) three")
    assert [(r.family, r.level) for r in found[1:]] == [("paren_alpha", 2), ("paren_roman", 3), ("paren_roman", 3), ("paren_roman", 3), ("paren_alpha", 2)]


def test_headings_without_a_number_are_siblings_below_the_numbered_one(spark):
    assert levels(spark, "# 2. Rules", "# Aviation", "# Shipping", "body", "# 3. End") == {0: (1, -1), 1: (2, 0), 2: (2, 0), 4: (1, -1)}


def test_by_rank_a_heading_without_a_number_holds_what_follows(spark):
    assert levels(spark, "# Part A", "# 1. Intro", "# 1.1 Scope", "- (ii) x", "# A. Next", by_rank=True) == {0: (1, -1), 1: (2, 0), 2: (3, 1), 3: (4, 2), 4: (2, 0)}


def test_dates_and_contents_entries_have_no_number(spark):
    titles = ["14 November 2025", "1 Queen Street", "1. Overview 3", "1. Overview", "3.2 Fees", "(iv) x", "B. Rest"]
    found = spark.createDataFrame([(t,) for t in titles], "t string").select(outline.number_of(F.col("t")).alias("n")).collect()
    assert [r.n and tuple(r.n) for r in found] == [None, None, None, ("decimal", "1"), ("decimal", "3.2"), ("paren", "iv"), ("upper", "B")]


def test_blocks_stand_under_the_last_heading(spark):
    df = spark.createDataFrame(shape("body", "# 1. X", "more", "- (a) y", "text"), "doc_id long, ord int, kind string, hint int, text string, page int")
    assert {r.ord: (r.section, r.size) for r in outline.section_tree(df).collect()} == {0: (-1, 4), 1: (1, 4), 2: (1, 4), 3: (3, 5), 4: (3, 4)}


def test_content_folds_into_the_nearest_clause_that_stays(spark):
    rows = shape("# A. Part", "# 1. Intro", "# 1.1 Scope", "- (a) first", "body of a", "# 1.1.1 Deep", "body", "# Contents", "# Fees 12", "# Aviation")
    df = spark.createDataFrame(rows, "doc_id long, ord int, kind string, hint int, text string, page int")
    out = {r.ord: (r.key, r.up, r.owner) for r in outline.clause_sections(outline.section_tree(df)).collect()}
    assert out[0] == ("A", None, 0) and out[1] == ("A1", "A", 1) and out[2] == ("A1.1", "A1", 2)
    assert out[3] == (None, "A1.1", 2)  # a bracketed point
    assert out[5][0] is None  # three parts are deeper than the cap
    assert out[7][0] is None and out[8][0] is None and out[9][0] is None  # on the page of the contents


def test_running_headers_open_no_section(spark):
    rows = [(1, k, "text", 1, "ACME Review" if k % 2 == 0 else f"{k}. Real", k // 2) for k in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, ord int, kind string, hint int, text string, page int")
    kinds = {r.text: r.kind for r in outline.demoted(df).collect()}
    assert kinds["ACME Review"] == "header" and kinds["1. Real"] == "text"


def words(text):
    return text.split()


def gap_rows(spark, source, output, others=(), units=()):
    rows = [(1, 0, 0, k, t) for k, t in enumerate(source)] + [(1, 1, 0, k, t) for k, t in enumerate(output)] + [(1, 1, 5, k, t) for k, t in enumerate(others)]
    df = spark.createDataFrame(rows, "doc_id long, side int, section int, pos long, token string")
    listed = spark.createDataFrame([(1, list(u)) for u in units], "doc_id long, words array<string>")
    return sorted((r.start, r.n, r.bucket, r.ratio, r.retention) for r in gaps.localized_gaps(df, listed).collect())


COLOURS = words("red orange yellow green blue indigo violet black white grey pink brown")
NUMBERS = words("one two three four five six seven eight nine ten eleven twelve")


@pytest.mark.parametrize(("source", "output", "others", "units", "want"), [
    ([*NUMBERS, *COLOURS], NUMBERS, COLOURS, [], [(12, 12, "elsewhere", 1.0, 0.5)]),
    ([*NUMBERS, *COLOURS], NUMBERS, COLOURS[:8], [], [(12, 12, "dropped", 0.6667, 0.5)]),  # two thirds elsewhere are a loss
    ([*COLOURS, *NUMBERS], [*NUMBERS, *COLOURS], (), [], [(0, 12, "relocated", 1.0, 0.5)]),
    ([*NUMBERS, *words("the cell holds these very words")], NUMBERS, (), [words("the cell holds"), words("very words")], [(12, 6, "restructured", 0.5, 0.6667)]),
    ([*NUMBERS, *words("lamp oak")], NUMBERS, (), [], [(0, 0, "none", 0.0, 0.8571)]),  # too short for a gap
    ([*NUMBERS, *words("nine one four two five")], NUMBERS, (), [], [(12, 5, "elsewhere", 1.0, 0.7059)]),  # every word is there
    ([*NUMBERS, *COLOURS, "end", "here"], [*NUMBERS, "end", "here"], (), [], [(12, 12, "dropped", 0.0, 0.5385)]),
    ([*COLOURS[:8], *NUMBERS], [*words("x y z"), *NUMBERS], COLOURS, [], [(0, 8, "changed", 0.0, 0.6)]),  # replaced ones are never excused
    ([*COLOURS[:7], *NUMBERS], [*words("x y z"), *NUMBERS], (), [], [(0, 0, "none", 0.0, 0.6316)]),  # and count from twice the size
    (words("a b c"), words("a b c"), (), [], [(0, 0, "none", 0.0, 1.0)]),
    (NUMBERS, [], (), [], [(0, 12, "dropped", 0.0, 0.0)]),
])
def test_gaps_say_where_a_span_went(spark, source, output, others, units, want):
    assert gap_rows(spark, source, output, others, units) == want


def test_rows_of_several_words_say_the_same_as_words(spark):
    kinds = "doc_id long, side int, section int, pos long, line int, token string"
    sides = [(0, 0, 0, 1, NUMBERS), (0, 0, 100, 2, COLOURS), (1, 0, 0, 2, COLOURS[:4]), (1, 0, 0, 1, NUMBERS[:4]), (1, 0, 50, 3, NUMBERS[4:]), (1, 2, 0, 4, COLOURS[4:])]
    single = [(1, side, section, 2 * (pos + k) + (line == 2), 0, w) for side, section, pos, line, said in sides for k, w in enumerate(said)]
    whole = [(1, side, section, pos, line, " ".join(said)) for side, section, pos, line, said in sides]
    none = spark.createDataFrame([], "doc_id long, words array<string>")
    one, many = (sorted(map(tuple, gaps.localized_gaps(spark.createDataFrame(rows, kinds), none).collect())) for rows in (single, whole))
    assert one == many and [r[2:5] for r in one] == [(12, 12, "dropped")]


def test_coverage_joins_runs_over_a_seam(spark):
    seam = [*COLOURS[:5], *COLOURS[7:12]]
    assert gap_rows(spark, [*NUMBERS, *seam], NUMBERS, [*COLOURS[:5], "x", "x", *COLOURS[7:12]]) == [(12, 10, "elsewhere", 1.0, 0.5455)]


def test_hollow_sections_need_a_holder_and_nothing_of_their_own(spark):
    body, own = [f"b{k}" for k in range(200)], [f"o{k}" for k in range(50)]
    def found(kept, held, size=200):
        rows = [(1, 0, 1, k, t) for k, t in enumerate(body[:size])] + [(1, 0, 2, k, t) for k, t in enumerate(own)]
        rows += [(1, 1, 1, k, t) for k, t in enumerate(kept)] + [(1, 1, 2, k, t) for k, t in enumerate([*own, *held])]
        df = spark.createDataFrame(rows, "doc_id long, side int, section int, pos long, token string")
        none = spark.createDataFrame([], "doc_id long, words array<string>")
        return [(r.section, r.absorbed_by, r.absorbed_ratio) for r in gaps.hollow(df, gaps.localized_gaps(df, none)).collect()]

    assert found(["see", "below"], body) == [(1, 2, 1.0)]
    assert found(["see", "below"], body[:90]) == []  # nobody holds most of it
    assert found(own[:30], body) == []  # what it has is the source's own text
    assert found(body[:60], body) == []  # enough of it stayed
    assert found(["see", "below"], body[:100], 100) == []  # no body worth having


def test_a_chain_of_two_hundred_has_one_root(spark):
    nodes = spark.createDataFrame([(k, k - 1 if k % 250 else None) for k in range(500)], "id long, parent long")
    out = {r.id: (r.root, r.depth) for r in trees.chain_roots(nodes).collect()}
    assert out[249] == (0, 249) and out[499] == (250, 249)
    with pytest.raises(ValueError):
        trees.chain_roots(spark.createDataFrame([(1, 2), (2, 1)], "id long, parent long"))


@pytest.mark.parametrize(("path", "key"), [("A-part/2.1-rules/2.1.2-more.md", "A2.1.2"), ("B-part/03-scope/(b)-who.md", "B3(b)"), ("C-part/04-scope.md", "C4"), ("C-part/04-scope/00-intro.md", "C4"), ("D-part/README.md", None)])
def test_keys_from_paths(spark, path, key):
    assert spark.range(1).select(T.path_key(F.lit(path)).alias("k")).first().k == key


@pytest.mark.parametrize(("title", "ok"), [("Scope of the rules", True), ("1.4.", True), ("and so it goes", False), ("(b) where nobody was asked", False), ("It ends like this.", False), ("one " * 10, False)])
def test_heading_like(spark, title, ok):
    assert spark.range(1).select(T.heading_like(F.lit(title)).alias("k")).first().k is ok
