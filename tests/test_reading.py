"""Clauses read with their branch, guidance and what comes next."""

from __future__ import annotations

from tesserae.operators import reading

SECTIONS = [
    ("t", 0, 1, "A", None, "Scope", None, []), ("t", 1, 2, "A1", "A", "Who", "All who sell. See Part G.", ["B2"]), ("t", 2, 3, "A1.1", "A1", "Agents", "Agents too", ["A1", "C3"]), ("t", 3, 2, "A2", "A", "Where", "", None),
    ("t", 4, 1, "B", None, "Rules", None, None), ("u", 0, 1, "A", None, "Other tree", "text", None),
]
GUIDANCE = [("t", "A1.1", 7, "agents", "Ask first"), ("t", "A1", 2, None, " Yes. "), ("t", "A1", 1, "x", None), ("t", "A2", 1, "where", "Here"), ("u", "B", 1, "no", "no such clause")]


def read(spark, **kw):
    s = spark.createDataFrame(SECTIONS, "key string, ord int, level int, id string, parent_id string, title string, body string, cites array<string>")
    g = spark.createDataFrame(GUIDANCE, "key string, id string, ord int, subject string, answer string")
    return {(r.key, r.id): (r.text, r.guidance, r.related) for r in reading.readings(s, g, **kw).collect()}


def test_a_branch_is_read_as_one(spark):
    out = read(spark)
    assert out["t", "A"] == ("[A1] Who: All who sell. See Part G.\n[A1.1] Agents: Agents too", "[A1] : Yes.\n[A1.1] agents: Ask first\n[A2] where: Here", ["B2", "C3", "G"])
    assert out["t", "A1"] == ("[A1] Who: All who sell. See Part G.\n[A1.1] Agents: Agents too", "[A1] : Yes.\n[A1.1] agents: Ask first", ["A2", "B2", "C3", "G"])
    assert out["t", "A1.1"] == ("[A1.1] Agents: Agents too", "[A1.1] agents: Ask first", ["A1", "C3"])


def test_clauses_without_text_show_their_title(spark):
    out = read(spark)
    assert out["t", "A2"] == ("Where", "[A2] where: Here", ["A1"]) and out["t", "B"] == ("Rules", "", []) and out["u", "A"] == ("[A] Other tree: text", "", [])
    assert len(out) == len(SECTIONS)


def test_limits_cut_whole_readings(spark):
    full = read(spark)["t", "A"]
    for n in (1, 10, 36, 37, 38, 60, 500):
        out = read(spark, most_text=n, most_guidance=n)["t", "A"]
        assert out[0] == full[0][:n] and out[1] == full[1][:n] and out[2] == full[2]
