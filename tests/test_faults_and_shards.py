"""Faults have the effect that they state, checks notice them, and shards fill as a loop fills them."""

from __future__ import annotations

import random

import numpy as np
import pytest
from tesserae.operators import faults, folds

DOC = """# Scope of rules
The fund must not be sold to the public without a licence here
The fee is 1234 euro or 2.5 of all
| a | b |
| c | 77 |
## Selling
More words stand in this line than a paragraph needs to have
| x | y |
### Last part
end of it"""


@pytest.fixture
def lines(spark):
    rows = [(1, k, x) for k, x in enumerate(DOC.split("\n"))] + [(2, 0, "nothing here"), (3, 0, None)]
    return spark.createDataFrame(rows, "doc_id long, ord int, line string").where("line is not null")


def text(df):
    rows = df.collect()
    assert {r.doc_id for r in rows} <= {1}
    return [r.line for r in sorted(rows, key=lambda r: r.ord)]


def test_each_fault_changes_just_what_it_says(lines):
    whole = DOC.split("\n")
    assert text(faults.inject(lines, "swap_digits")) == [x.replace("1234", "1243") for x in whole]
    assert text(faults.inject(lines, "drop_decimal")) == [x.replace("2.5", "25") for x in whole]
    assert text(faults.inject(lines, "flip_negation")) == [x.replace("must not", "must") for x in whole]
    gone = text(faults.inject(lines, "drop_paragraph"))
    assert len(gone) == len(whole) - 1 and set(whole) - set(gone) <= {whole[1], whole[2], whole[6]}
    cut = text(faults.inject(lines, "delete_table"))
    assert set(whole) - set(cut) in ({"| a | b |", "| c | 77 |"}, {"| x | y |"})
    moved = text(faults.inject(lines, "move_table"))
    assert sorted(moved) == sorted(whole) and moved[-1] in ("| c | 77 |", "| x | y |")
    head = text(faults.inject(lines, "move_heading"))
    assert sorted(head) == sorted(whole) and head[-1] in ("# Scope of rules", "## Selling")


def test_seeds_pick_other_targets_and_the_same_seed_the_same(lines):
    found = [text(faults.inject(lines, "drop_paragraph", seed)) for seed in range(12)]
    assert found[3] == text(faults.inject(lines, "drop_paragraph", 3)) and len({str(f) for f in found}) > 1


def test_checks_notice_their_faults_and_a_sound_copy_has_none(lines):
    sound = faults.checks(lines, lines).drop("doc_id").collect()
    assert all(set(r) == {0} for r in sound)
    out = {r.fault: r for r in faults.fault_matrix(lines).collect()}
    assert set(out) == set(faults.EFFECTS) and all(r.caught for r in out.values())
    assert out["swap_digits"].words == 0 and out["move_table"].tables == 0 and out["move_table"].words == 0 and out["flip_negation"].numbers == 0


def test_numbers_that_repeat_or_would_collide_are_no_target(spark):
    rows = [(1, 0, "1234 and 1234"), (2, 0, "1234 and 1243"), (3, 0, "99 or 1.234,5 or 455"), (4, 0, "2.5 and 25")]
    df = spark.createDataFrame(rows, "doc_id long, ord int, line string")
    assert faults.inject(df, "swap_digits").count() == 0 and faults.inject(df, "drop_decimal").count() == 0


def loop(sizes, shards):
    loads, out = [0] * shards, {}
    for size, job in sorted(((s, j) for j, s in sizes.items()), key=lambda x: (-x[0], x[1])):
        k = min(range(shards), key=lambda i: (loads[i], i))
        loads[k] += size
        out[job] = k
    return out, loads


def test_runs_of_equal_jobs_fill_as_a_loop_does():
    rng = np.random.default_rng(5)
    for _ in range(200):
        loads, size, n = rng.integers(0, 30, int(rng.integers(1, 6))), int(rng.integers(1, 9)), int(rng.integers(1, 25))
        now, want = loads.copy(), []
        for _ in range(n):
            k = int(now.argmin())
            want.append(k)
            now[k] += size
        assert folds.shard_of(loads, size, np.arange(n)).tolist() == want
        assert folds.filled(loads, size, n).tolist() == now.tolist()


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_equal_a_loop(spark, shards):
    rng = random.Random(shards)
    sizes = {j: rng.choice([1, 1, 1, 2, 5, 40, 41, 300]) for j in range(400)}
    df = spark.createDataFrame(list(sizes.items()), "job long, pages long").repartition(7)
    out = {r.job: r.shard for r in folds.assign_shards(df, shards).collect()}
    assert out == loop(sizes, shards)[0]


def test_a_table_moved_under_a_heading_that_says_the_same_is_noticed(spark):
    said = ["# Terms", "| a | b |", "# Terms", "end of it"]
    rows = spark.createDataFrame([(1, k, x) for k, x in enumerate(said)], "doc_id long, ord int, line string")
    found = faults.fault_matrix(rows, ("move_table",)).collect()
    assert [(r.placement, r.caught) for r in found] == [(1, True)]
    assert [r.placement for r in faults.checks(rows, rows).collect()] == [0]
