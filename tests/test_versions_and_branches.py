"""Joined cells, text that changed sides, repairs, and branches of outlines against plain loops."""

from __future__ import annotations

import random

from tesserae.operators import branches, versions

DDL = "key long, tab long, line long, item long, said string"


def cells(spark, *rows):
    return spark.createDataFrame([(1, 0, i, j, said) for i, row in enumerate(rows) for j, said in enumerate(row)], DDL)


A, B, C, D = "alpha one two three four", "beta five six seven eight", "gamma nine ten eleven", "delta twelve more words here"


def merges(spark, before, after, longest=6):
    out = versions.cell_merges(cells(spark, *before), cells(spark, *after), longest).collect()
    return sorted((r.line, r.item, r.kind, [(s.line, s.item) for s in r.slots]) for r in out)


def test_neighbours_that_became_one_cell(spark):
    table = [[A, B], [C, D]]
    assert merges(spark, table, [[f"{A} {B}"], [C, D]]) == [(0, 0, "column", [(0, 0), (0, 1)])]
    assert merges(spark, table, [[f"{A} {C}", B], ["", D]]) == [(0, 0, "row", [(0, 0), (1, 0)])]
    assert merges(spark, table, [[A, f"{B}; {C}"], ["", D]]) == [(0, 1, "block", [(0, 1), (1, 0)])]
    assert merges(spark, table, [[f"{A} {B} {C} {D}"]]) == [(0, 0, "block", [(0, 0), (0, 1), (1, 0), (1, 1)])]


def test_what_is_no_merge(spark):
    table = [[A, B], [C, D]]
    assert merges(spark, table, table) == []
    assert merges(spark, [[A, B], [f"{A} {B}", D]], [[f"{A} {B}"]]) == []  # it was a cell before
    assert merges(spark, table, [[f"{A} {D}"]]) == []  # no neighbours
    assert merges(spark, [["yes", "no"], [C, D]], [["yes no"], [C, D]]) == []  # too short to tell
    assert merges(spark, [[A, f"{A} again"], [C, D]], [[f"{A} {A} again"], [C, D]]) == []  # one says what the other says


Q1, Q2, ANS1, ANS2 = "May the fund be sold to the public?", "If so, please contact us before any sale", "Only with a licence from the regulator.", "No further steps are needed after that."


def test_a_question_in_an_answer_goes_back(spark):
    before, after = cells(spark, [Q1, ANS1], [Q2, ANS2]), cells(spark, [Q1, f"{ANS1} {Q2}."], ["", ANS2])
    moved = versions.moved_text(before, after).collect()
    assert [(r.line, r.item, r.role, r.to_line, r.to_item, r.to_role, r.change) for r in moved] == [(1, 0, "question", 0, 1, "answer", "moved")]
    repairs = versions.column_repairs(before, after)
    assert [r.why for r in repairs.collect()] == [None]
    out = sorted((r.line, r.item, r.said) for r in versions.repaired(after, repairs).collect())
    assert out == [(0, 0, Q1), (0, 1, ANS1), (1, 0, f"{Q2}."), (1, 1, ANS2)]
    assert versions.moved_text(before, versions.repaired(after, repairs)).count() == 0


def test_repairs_that_cannot_be_proved_are_declined(spark):
    def why(after, before=([Q1, ANS1], [Q2, ANS2])):
        return sorted(r.why for r in versions.column_repairs(cells(spark, *before), cells(spark, *after)).collect())

    assert why([[Q1, f"{ANS1} {Q2}"], ["(e)", ANS2]]) == ["the row below has a first cell"]
    assert why([[Q1, f"{ANS1} {Q2}"]]) == ["no row below"]
    assert why([[Q1, f"{Q2} {ANS1}"], ["", ANS2]]) == ["not at the answer's end"]
    assert why([[f"{Q1} {ANS1}", "x"], [Q2, ANS2]]) == ["not a question in an answer"]


def test_rows_of_another_shape_are_no_move(spark):
    out = versions.moved_text(cells(spark, [Q1, ANS1]), cells(spark, [Q1, "x", ANS1])).collect()
    assert {r.change for r in out} == {"reshaped"}


def tree(spark, rng, size):
    rows = []
    for ord_ in range(size):
        status = rng.choice(["built", "built", "hollow", "missing"])
        rows.append((1, ord_ * 3, rng.randint(1, 5), f"t{ord_}", status, rng.randrange(size) * 3 if status == "hollow" and rng.random() < 0.8 else None))
    return rows, spark.createDataFrame(rows, "key long, ord int, level int, title string, status string, absorbed_by int")


def test_branches_equal_a_walk(spark):
    rng = random.Random(4)
    for size in (1, 7, 40):
        rows, df = tree(spark, rng, size)
        out = {r.ord: r for r in branches.roll_up(df).collect()}
        assert len(out) == size
        for k, (_, ord_, level, _, _, _) in enumerate(rows):
            kids = []
            for r in rows[k + 1 :]:
                if r[2] <= level:
                    break
                kids.append(r)
            got = out[ord_]
            assert (got.children, got.defective) == (len(kids), sum(r[4] != "built" for r in kids))
            assert got.absorbers == sorted({r[5] for r in kids if r[4] == "hollow" and r[5] is not None})[:3]
            assert got.absorbed == [r[3] for r in rows if r[4] == "hollow" and r[5] == ord_]


def test_ranges_and_owners_equal_a_walk(spark):
    rng = random.Random(12)
    for _ in range(6):
        size, page, rows = rng.randint(1, 9), rng.randint(1, 3), []
        for ord_ in range(size):
            rows.append((1, ord_, rng.randint(1, 3) if ord_ else 1, page))
            page += rng.randint(0, 2)
        n_pages = rows[-1][3] + rng.randint(0, 2)
        ranges = branches.page_ranges(spark.createDataFrame(rows, "key long, ord int, level int, page long"), spark.createDataFrame([(1, n_pages)], "key long, n_pages long"))
        got = {r.ord: (r.page, r.end, r.own_end) for r in ranges.collect()}
        for k, (_, ord_, level, at) in enumerate(rows):
            after = rows[k + 1] if k + 1 < size else None
            end = max(after[3] - 1 if after else n_pages, at)
            own = max(after[3] - 1, at) if after and after[2] > level else end
            assert got[ord_] == (at, end, own)
        assert (-1 in got) == (rows[0][3] > 1)
        owners = {r.page: r.ord for r in branches.page_owners(ranges, spark.createDataFrame([(1, n_pages)], "key long, n_pages long")).collect()}
        for p in range(1, n_pages + 1):
            held = [(rows[o][2] if o >= 0 else 1, o) for o, (a, _, b) in got.items() if a <= p <= b]
            assert owners[p] == (max(held)[1] if held else max((-r[2], r[1]) for r in rows)[1])


def test_words_of_a_cell_are_not_made_rows(spark):
    many = " ".join(f"word{k}" for k in range(3000))
    before, after = cells(spark, [many, ANS1]), cells(spark, [Q1, "x", f"{many} {ANS1}"])
    found = versions.moved_text(before, after)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    assert {(r.item, r.to_item, r.change) for r in found.collect()} == {(0, 2, "reshaped"), (1, 2, "reshaped")}
