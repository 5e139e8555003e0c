"""Folder trees as sections, lexicons of part names, and parts inferred in order."""

from __future__ import annotations

from tesserae.operators import folders


def test_every_folder_and_file_is_a_section(spark):
    files = [("t", "10-end.md", "# The end\nx"), ("t", "2-rules/README.md", "# Rules of it\nintro"), ("t", "2-rules/2.10-late.md", "x"), ("t", "2-rules/2.9-early_ones.md", None), ("t", "a/b/c.md", "text"), ("t", "a/b/c.pdf", "no"), ("t", "2-rules/00-more.md", "# Other")]
    out = sorted(folders.model(spark.createDataFrame(files, "key string, path string, text string")).collect(), key=lambda r: r.ord)
    assert [(r.node, r.parent, r.level, r.title) for r in out] == [
        ("2-rules", None, 1, "Other"), ("2-rules/2.9-early_ones", "2-rules", 2, "early ones"), ("2-rules/2.10-late", "2-rules", 2, "late"), ("10-end", None, 1, "The end"), ("a", None, 1, "a"), ("a/b", "a", 2, "b"), ("a/b/c", "a/b", 3, "c"),
    ]
    assert {r.node: r.text for r in out}["a"] is None


LETTERED = [(f"k{n}", p, k) for n in range(3) for k, p in enumerate(["A-scope/01-who-is-meant.md", "A-scope/02-notes.md", "B-losses/01-first-steps.md", "B-losses/02-notes.md", "README.md"])]


def lexicon(spark, more=()):
    return folders.learned(spark.createDataFrame([*LETTERED, *more], "key string, path string, page int"))


def test_names_that_trees_agree_on(spark):
    out = {r.name: (r.letter, r.is_part) for r in lexicon(spark).collect()}
    assert out == {"scope": ("A", True), "losses": ("B", True), "who-is-meant": ("A", False), "first-steps": ("B", False)}  # notes end both parts
    assert lexicon(spark).where("name = 'notes'").count() == 0
    assert folders.learned(spark.createDataFrame(LETTERED[:5], "key string, path string, page int")).count() == 0  # one tree alone


def parts(spark, *paths):
    files = spark.createDataFrame([("t", p, k) for k, p in enumerate(paths)], "key string, path string, page int")
    return {r.name: (r.letter, r.is_part, r.wrapper) for r in folders.inferred(files, lexicon(spark)).collect()}


def test_a_wrapper_hides_the_level_and_parts_carry_on(spark):
    got = parts(spark, "02-harbour/README.md", "02-harbour/01-who-is-meant/x.md", "02-harbour/02-notes/x.md", "02-harbour/03-loose.md", "02-harbour/01-first-steps/x.md", "02-harbour/02-notes-again/x.md")
    assert got == {"01-who-is-meant": ("A", False, "02-harbour"), "02-notes": ("A", False, "02-harbour"), "03-loose.md": ("A", False, "02-harbour"), "01-first-steps": ("B", False, "02-harbour"), "02-notes-again": ("B", False, "02-harbour")}


def test_a_single_folder_called_like_a_part_is_no_wrapper(spark):
    assert parts(spark, "01-losses/01-x/y.md", "01-losses/02-z.md") == {"01-losses": ("B", True, None)}


def test_mixed_trees_go_by_name_alone_and_lettered_ones_need_nothing(spark):
    assert parts(spark, "A-scope/x.md", "08-losses/x.md", "09-northern/x.md") == {"08-losses": ("B", True, None)}
    assert parts(spark, "A-scope/x.md", "B-losses/y.md") == {}
    assert parts(spark, "unknown/x.md", "other/y.md") == {}


def test_a_loose_file_may_state_its_part(spark):
    assert parts(spark, "01-scope/x.md", "I-changes.md", "02-later/x.md") == {"01-scope": ("A", True, None), "02-later": ("I", False, None)}
