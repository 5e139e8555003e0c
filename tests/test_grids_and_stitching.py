"""Table grids, proved splits, and stitching against plain loops over all offsets."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tesserae.operators import grids, stitch


def tables_of(spark, *markup):
    return spark.createDataFrame(list(enumerate(markup)), "k long, h string")


def cells_of(spark, *markup):
    out = grids.placed(grids.cells(tables_of(spark, *markup), "k", "h")).collect()
    return sorted((r.key, r.tab, r.line, r.col, r.rowspan, r.colspan, r.said) for r in out)


def test_spans_fill_the_grid(spark):
    html = '<table><tr><td rowspan="2">a</td><td colspan=2>b</td></tr><tr><td>c</td><td rowspan="9">d</td></tr><tr><td>e</td><td>f</td></tr></table>'
    assert [x[2:] for x in cells_of(spark, html)] == [(0, 0, 2, 1, "a"), (0, 1, 1, 2, "b"), (1, 1, 1, 1, "c"), (1, 2, 2, 1, "d"), (2, 0, 1, 1, "e"), (2, 1, 1, 1, "f")]


def test_nested_unclosed_and_stray_tags(spark):
    html = "x</table><TABLE><tr><td>one <b>two</b><br>three &lt;4&gt;<!-- <td>no</td> --><table><tr><td>in</td></tr></table> after</td><td>b</table><table><tr><th a='>'>h</table>"
    got = cells_of(spark, html)
    assert [x[2:] for x in got] == [(0, 0, 1, 1, "one two three <4> after"), (0, 1, 1, 1, "b"), (0, 0, 1, 1, "in"), (0, 0, 1, 1, "h")]
    up = {r.tab: r.up for r in grids.cells(tables_of(spark, html), "k", "h").collect()}
    tabs = sorted(up)
    assert [up[t] for t in tabs] == [None, tabs[0], None]


def test_no_tables_no_cells(spark):
    assert cells_of(spark, None, "", "plain < text", "<table></table>", "<td>loose</td>") == []


def brute_grid(cells):
    taken, out = {}, []
    for line, row in enumerate(cells):
        c = 0
        for n, (down, right) in enumerate(row):
            while (line, c) in taken:
                c += 1
            out.append((line, n, c))
            for r in range(line, line + down):
                for k in range(c, c + right):
                    taken[r, k] = True
            c += right
    return out


def test_layout_equals_a_filled_matrix():
    rng = random.Random(2)
    for _ in range(200):
        table = [[(rng.randint(1, 4), rng.randint(1, 3)) for _ in range(rng.randint(0, 5))] for _ in range(rng.randint(1, 6))]
        flat = [{"line": i, "rowspan": d, "colspan": r} for i, row in enumerate(table) for d, r in row]
        assert grids.columns_of(flat) == [c for _, _, c in brute_grid(table)]


def test_pipes_and_cleaning(spark):
    html = '<table><tr><td colspan="2">a|b</td><td></td></tr><tr><td>c</td><td>c</td><td></td></tr><tr><td> </td></tr></table>'
    grid = grids.placed(grids.cells(tables_of(spark, html, "<table><tr><td>one row</td></tr></table>"), "k", "h"))
    assert [r.said for r in grids.pipe_text(grids.slots(grid)).collect()] == ["| a\\|b |  |  |\n| --- | --- | --- |\n| c | c |  |\n|  |  |  |"]
    kept = [(r.line, r.col, r.said) for r in grids.cleaned(grids.slots(grid, repeat=True)).where("key = 0").collect()]
    assert sorted(kept) == [(0, 0, "a|b"), (1, 0, "c")]


PARTED = "<table><tr><td>Ask</td><td>Say</td></tr><tr><td colspan=2>4.1 Ways in</td></tr><tr><td>q1</td><td>a <table><tr><td>4.9 inner</td></tr></table></td></tr><tr><td colspan=2>4.2 Ways out &amp; on</td></tr><tr><td>4.3 x</td><td>two cells</td></tr></table>"


@pytest.mark.parametrize("shown", [lambda grid: grids.pipe_text(grids.slots(grid)), lambda grid: grids.cleaned(grids.slots(grid, repeat=True))])
def test_slots_are_not_shuffled(spark, shown):
    grid = grids.placed(grids.cells(tables_of(spark, "<table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td></tr></table>"), "k", "h"))
    assert "ENSURE_REQUIREMENTS" not in shown(grid)._jdf.queryExecution().executedPlan().toString()


def test_slots_are_dealt_by_what_they_hold(spark):
    wide = f'<table><tr><td colspan="1000">{"x" * 400}</td></tr></table>'
    filled = grids.slots(grids.placed(grids.cells(tables_of(spark, *[wide] * 60), "k", "h")), repeat=True)
    held = filled.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).toPandas()["n"]
    assert held.sum() == 60_000 and held.max() < 30_000


def test_split_at_rows_that_name_a_part(spark):
    rows = tables_of(spark, PARTED, "<table><tr><td>no part</td></tr></table>")
    for repeat, n in ((False, 1), (True, 2)):
        split = grids.split_tables(rows, "k", "h", repeat_header=repeat)
        got = {r.part: r for r in split.collect()}
        assert [(got[p].id, got[p].title, got[p].n_rows) for p in sorted(got)] == [("4.1", "Ways in", 2), ("4.2", "Ways out & on", 1)]
        assert got[1].said.startswith("### 4.1 Ways in\n\n<table><tr><td>Ask</td>") and got[1].said.endswith("</table></td></tr></table>")
        assert sum("Ask" in got[p].said for p in got) == n
    checked = grids.verify_split(rows, "k", "h", grids.split_tables(rows, "k", "h")).collect()
    assert [(r.ok, r.reason) for r in checked] == [(True, "ok")]


@pytest.mark.parametrize(("old", "new", "why"), [("<td>q1</td>", "<td>q2</td>", "a row is altered"), ("<tr><td>Ask</td><td>Say</td></tr>", "", "rows: 3 before, 2 after"), ("Ways in", "Ways", "a heading lacks its row's text"), ("### 4.2", "4.2", "headings and naming rows differ in number")])
def test_a_split_that_changed_anything_is_refused(spark, old, new, why):
    rows = tables_of(spark, PARTED)
    split = grids.split_tables(rows, "k", "h").withColumn("said", F.replace("said", F.lit(old), F.lit(new)))
    assert [(r.ok, r.reason) for r in grids.verify_split(rows, "k", "h", split).collect()] == [(False, why)]


# stitching


def open_end(t):
    return bool(t.strip()) and t.rstrip()[-1] not in stitch.CLOSING


def cut(t):
    return open_end(t) and (len(t.split()) >= 5 or t.split()[-1].lower() in stitch.OPEN_WORDS)


def brute_alignment(prev, cells):
    wide = len(cells) - len(prev)
    best = None
    for shift in range(min(wide, 0), max(wide, 0) + 1):
        score = -3 * sum(bool(c) for c in cells[: max(shift, 0)])
        for j, tail in enumerate(prev):
            head = cells[j + shift] if 0 <= j + shift < len(cells) else ""
            if tail and head:
                low = head[:1].islower()
                score += (4 if low else 2) if cut(tail) else -3 if low else 0
        if best is None or score > best[0]:
            best = (score, shift)
    return best


WORDS = ["the", "Fund", "a", "sells", "in", "units.", "and", "Yes", "no;", "of", "B"]


def test_alignments_equal_brute_force(spark):
    rng = random.Random(4)
    text = lambda: " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 7)))
    rows = [([text() for _ in range(rng.randint(1, 4))], [text() for _ in range(rng.randint(1, 4))]) for _ in range(300)]
    out = spark.createDataFrame(rows, "p array<string>, c array<string>").select("p", "c", stitch.best_alignment(F.col("p"), F.col("c")).alias("b")).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.b.score, -r.b.back) == brute_alignment(r.p, r.c)


def stitched(spark, *pages):
    rows = [(1, p, k, list(cells)) for p, page in enumerate(pages) for k, cells in enumerate(page)]
    out = stitch.stitched(spark.createDataFrame(rows, "t long, page long, line long, cells array<string>"), ["t"]).collect()
    return [r.cells for r in sorted(out, key=lambda r: r.row)], [x for r in sorted(out, key=lambda r: r.row) for x in r.joins]


HEAD = ("Topic", "Answer")


def test_repeated_headers_go_and_rows_join(spark):
    rows, joins = stitched(spark, [HEAD, ("Fees", "The charge is paid to the")], [("topic", "ANSWER "), ("", "agent each year."), ("Tax", "None.")], [HEAD, ("Law", "English.")])
    assert rows == [list(HEAD), ["Fees", "The charge is paid to the agent each year."], ["Tax", "None."], ["Law", "English."]]
    assert [(j.page, j.action) for j in joins] == [(1, "joined")]


def test_a_wider_row_is_realigned_widened_or_kept(spark):
    surplus_left = [HEAD, ("(a) May a fund be sold", "Only to those whom the")], [("", "", "rules admit and no others.")]
    rows, joins = stitched(spark, *surplus_left)
    assert rows[1] == ["(a) May a fund be sold", "Only to those whom the rules admit and no others."]
    assert (joins[0].action, joins[0].shift, joins[0].score, joins[0].evidence) == ("realigned", 1, 4, 100)
    rows, joins = stitched(spark, [HEAD, ("It is for the", "closed.")], [("", "", "Note")])
    assert rows[1:] == [["It is for the", "closed."], ["", "", "Note"]] and joins[0].action == "kept apart"
    rows, joins = stitched(spark, [HEAD, ("x", "they may be sold to the", )], [("", "public only", "see below")])
    assert rows[1] == ["x", "they may be sold to the public only", "see below"] and joins[0].action == "widened"


def test_blank_cells_within_a_page_stay(spark):
    rows, joins = stitched(spark, [HEAD, ("x", "one"), ("", "two")], [("y", "three"), ("", "four")])
    assert rows == [list(HEAD), ["x", "one"], ["", "two"], ["y", "three"], ["", "four"]] and joins == []


def test_a_row_over_many_pages(spark):
    rows, _ = stitched(spark, [HEAD, ("x", "w0")], *[[HEAD, ("", f"w{k}")] for k in range(1, 8)], [HEAD, ("y", "end")])
    assert rows == [list(HEAD), ["x", " ".join(f"w{k}" for k in range(8))], ["y", "end"]]


def test_no_token_is_lost_or_made(spark):
    rng = random.Random(9)
    rows = []
    for t in range(40):
        for page in range(rng.randint(1, 5)):
            rows += [(t, page, 0, ["h", "i"])] * (page == 0 or rng.random() < 0.5)
            rows += [(t, page, k + 1, [rng.choice(["", " ".join(rng.choices(WORDS, k=rng.randint(1, 6)))]) for _ in range(rng.randint(1, 4))]) for k in range(rng.randint(0, 4))]
    df = spark.createDataFrame(rows, "t long, page long, line long, cells array<string>")
    before, after = Counter(), Counter()
    seen = set()
    for t, _, _, cells in rows:
        if cells == ["h", "i"] and t in seen:
            continue
        seen.add(t) if cells == ["h", "i"] else None
        before.update((t, w) for c in cells for w in c.split())
    for r in stitch.stitched(df, ["t"]).collect():
        after.update((r.t, w) for c in r.cells for w in c.split())
    assert after == before


def detached(spark, rows, pages):
    out = stitch.detached_rows(spark.createDataFrame(rows, "key long, table long, page long, line long, cells array<string>"), spark.createDataFrame(pages, "key long, page long, said string"), "key")
    return sorted((r.to, r.table, r.n_rows, r["shift"]) for r in out.collect())


ROWS = [(1, 1, 1, 0, ["(f)", "May it be sold", "The key may be lent to the next"]), (1, 2, 2, 0, ["", "", "keeper and no one else."]), (1, 2, 2, 1, ["(g)", "And later?", "Yes, it may."]), (1, 2, 2, 2, ["Asked", "Told"]), (1, 2, 2, 3, ["(a)", "Who?", "All."])]
PAGES = [(1, 1, "(f) May it be sold The key may be lent to the next"), (1, 2, "keeper and no one else. (g) And later? Yes, it may. Asked Told (a) Who? All.")]


def test_detached_rows_go_back(spark):
    assert detached(spark, ROWS, PAGES) == [(1, 2, 2, 0)]
    rows = spark.createDataFrame(ROWS, "key long, table long, page long, line long, cells array<string>")
    moves = stitch.detached_rows(rows, spark.createDataFrame(PAGES, "key long, page long, said string"), "key")
    out = sorted((r.table, r.row, r.cells) for r in stitch.reattached(rows, moves).collect())
    assert out == [(1, 0, ["(f)", "May it be sold", "The key may be lent to the next keeper and no one else."]), (1, 1, ROWS[2][4]), (2, 0, ROWS[3][4]), (2, 1, ROWS[4][4])]


def test_rows_stay_where_anything_speaks_against_it(spark):
    closed = [(1, 1, 1, 0, ["(f)", "x", "It is closed."]), *ROWS[1:]]
    assert detached(spark, closed, PAGES) == []
    assert detached(spark, [*ROWS, (1, 3, 2, 9, ["", "another"])], PAGES) == []  # two tables open alike
    assert detached(spark, [r for r in ROWS if r[4] != ["Asked", "Told"]], PAGES) == []  # no caption row
    assert detached(spark, ROWS, [(1, 1, "all other words here"), (1, 2, "and nothing of the join")]) == []


@pytest.mark.parametrize("word", ["ñó", "ключ", "—"])
def test_rows_in_any_script_go_back(spark, word):
    tail, head = " ".join([word] * 9), f"{word} {word}"
    rows = [(1, 1, 1, 0, ["(f)", "x", tail]), (1, 2, 2, 0, ["", "", head]), *ROWS[2:]]
    assert detached(spark, rows, [(1, 1, f"(f) x {tail}"), (1, 2, f"{head} (g) And later?")]) == [(1, 2, 1 + 1, 0)]
