"""Contents pages: wrapped titles, labels on lines of their own, entries that fold."""

from __future__ import annotations

from tesserae.operators import contents


def read_back(spark, *lines, **kw):
    df = spark.createDataFrame([(1, 0, k, x) for k, x in enumerate(lines)], "key long, page long, ord long, line string")
    return [(r.label, r.title, r.page_to, r.depth) for r in sorted(contents.entries(df, **kw).collect(), key=lambda r: r.nth)]


def test_plain_rows(spark):
    assert read_back(spark, "Table of Contents", "1. Scope ........ 3", "1.1 Who is meant …………  4", "2 Duties ....... 12 ", "body text", "no page here") == [("1", "Scope", 3, 1), ("1.1", "Who is meant", 4, 2), ("2", "Duties", 12, 1)]


def test_a_title_over_three_lines_with_its_label_alone(spark):
    got = read_back(spark, "6. First ..... 40", "7.4", "Limits that follow the plan (Advice and", "Management", "for others) ......... 48", "7.5", "Next ...... 51")
    assert got == [("6", "First", 40, 1), ("7.4", "Limits that follow the plan (Advice and Management for others)", 48, 2), ("7.5", "Next", 51, 2)]


def test_a_title_that_wrapped_before_its_leaders(spark):
    assert read_back(spark, "3.", "Rules on sales to the public", "............. 7", "........ 9") == [("3", "Rules on sales to the public", 7, 1)]


def test_a_row_with_its_own_label_takes_nothing_from_above(spark):
    assert read_back(spark, "stray words", "2.1 Whole entry ...... 5") == [("2.1", "Whole entry", 5, 2)]
    assert read_back(spark, "far", "a", "b", "c", "tail ..... 5", most_lines=2) == [(None, "b c tail", 5, 1)]


def test_letters_number_parts_and_unlabelled_rows_follow(spark):
    got = read_back(spark, "A. General ..... 1", "1.1 Scope ...... 2", "Notes on scope ..... 3", "B.", "Special ...... 4", "Annexed words ..... 9")
    assert got == [("A", "General", 1, 1), ("1.1", "Scope", 2, 3), (None, "Notes on scope", 3, 3), ("B", "Special", 4, 1), (None, "Annexed words", 9, 1)]


def test_listings_and_thin_pages_next_to_them(spark):
    rows = [(1, page, k, f"t{k} ...... {k}") for page, n in ((1, 2), (2, 3), (3, 7), (4, 3), (5, 3), (7, 3)) for k in range(n)]
    df = spark.createDataFrame(rows, "key long, page long, ord long, line string")
    assert sorted(r.page for r in contents.listings(df).collect()) == [2, 3, 4]


def test_entries_that_fold(spark):
    rows = [(1, n, label) for n, label in enumerate(["1", "2", "3", "4.1", "5", None])] + [(2, 0, "1"), (2, 1, None)]
    df = spark.createDataFrame(rows, "key long, nth int, label string")
    out = {(r.key, r.nth): r.why for r in contents.folded(df, 1).collect()}
    assert [out[1, n] for n in range(6)] == [None, None, None, "deeper", None, "fragment"] and out[2, 1] is None


def test_labels_of_three_digits(spark):
    got = read_back(spark, "99.4 Last of two ..... 7", "104. Scope ........ 8", "104.4 Who is meant ........ 9", "105.12.", "Limits that follow", "the plan ..... 10", "106.", "More ..... 11")
    assert got == [("99.4", "Last of two", 7, 2), ("104", "Scope", 8, 1), ("104.4", "Who is meant", 9, 2), ("105.12", "Limits that follow the plan", 10, 2), ("106", "More", 11, 1)]
    assert read_back(spark, "1. Scope ..... 3", "2024", "Report ..... 4") == [("1", "Scope", 3, 1), (None, "2024 Report", 4, 1)]


def test_a_wrapped_title_whose_last_line_starts_like_a_label(spark):
    assert read_back(spark, "7.4.", "Addresses of the hosts at", "97.33.30.60 and others ..... 12") == [("7.4", "Addresses of the hosts at 97.33.30.60 and others", 12, 2)]


def test_a_title_of_very_many_lines_is_whole(spark):
    rows = [f"line {k:04d} of the title" for k in range(1500)]
    assert read_back(spark, "1.", *rows, "end ..... 3", "2. Next ..... 4", most_lines=None) == [("1", " ".join([*rows, "end"]), 3, 1), ("2", "Next", 4, 1)]


def test_wrapped_lines_of_an_entry_stay_before_the_next_entry(spark, tmp_path):
    from tesserae.plans.contents import contents_entries, folded_entries

    title = " ".join(["wordsofthetitle"] * 3000)
    spark.createDataFrame([(1, f"{title}\nNext title")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted((r.nth, r.label, r.title) for r in contents_entries(spark, str(tmp_path)).collect())
    assert found == [(1, "1", title), (2, "1.1", "Next title")]
    assert sorted((r.nth, r.why) for r in folded_entries(spark, str(tmp_path)).collect()) == [(1, None), (2, "deeper")]
