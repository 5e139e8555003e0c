"""A table's cells before and after a stage: cells that were joined, text that changed sides, repairs that can be proved."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import content_stream

#: Words of a cell that tells where text is from, letters of one whose place is followed, words that anchor it. Fixed values.
LEAST_WORDS, LEAST_LETTERS, ANCHOR = 4, 25, 4
CELL = ["key", "tab", "line", "item"]


def streamed(cells: DataFrame) -> DataFrame:
    """``cells(key, tab, line, item, said)`` with their stream of letters and digits, their words, and the cells of their row."""
    said = F.coalesce("said", F.lit(""))
    words = F.filter(F.split(F.lower(said), "[^0-9a-z]+"), lambda w: w != "")
    row = Window.partitionBy("key", "tab", "line")
    placed = cells.select(*CELL, said.alias("said"), F.count("*").over(row).alias("width"), (F.row_number().over(row.orderBy("item")) - 1).alias("nth"))
    return placed.select(*CELL, "said", content_stream(said).alias("s"), words.alias("words"), "width", "nth")


def neighbours(cells: DataFrame, longest: int) -> DataFrame:
    """Runs of two to ``longest`` cells in a row, a column or reading order over rows: ``(key, tab, kind, slots, s)``.

    Two of them at least have words enough, and none says what another says.
    """
    part = F.struct("line", "item", "s", (F.size("words") >= LEAST_WORDS).alias("long"))

    def runs(order: Window, kind: str, holds) -> Column:
        found = [F.array(part, *[F.lead(part, k).over(order) for k in range(1, n)]) for n in range(2, longest + 1)]
        return F.transform(F.filter(F.array(*found), lambda r: F.forall(r, lambda x: x.isNotNull() & (x["s"] != "")) & holds(r)), lambda r: F.struct(F.lit(kind).alias("kind"), r.alias("run")))

    straight = lambda r: F.forall(F.sequence(F.lit(1), F.size(r) - 1), lambda k: F.get(r, k)["line"] == F.get(r, k - 1)["line"] + 1)
    crosses = lambda r: (r[0]["line"] < F.element_at(r, -1)["line"]) & F.exists(r, lambda x: x["item"] != r[0]["item"])
    across = runs(Window.partitionBy("key", "tab", "line").orderBy("item"), "column", lambda r: F.lit(True))
    down = runs(Window.partitionBy("key", "tab", "item").orderBy("line"), "row", straight)
    block = runs(Window.partitionBy("key", "tab").orderBy("line", "item"), "block", crosses)
    found = cells.withColumn("across", across).withColumn("down", down).withColumn("block", block)
    found = found.select("key", "tab", F.explode(F.concat("across", "down", "block")).alias("r"))
    inside = F.exists("r.run", lambda x: F.exists("r.run", lambda y: ((x["line"] != y["line"]) | (x["item"] != y["item"])) & F.contains(y["s"], x["s"])))
    found = found.where((F.size(F.filter("r.run", lambda x: x["long"])) >= 2) & ~inside)
    return found.select("key", "tab", "r.kind", F.transform("r.run", lambda x: F.struct(x["line"].alias("line"), x["item"].alias("item"))).alias("slots"), F.array_join(F.transform("r.run", lambda x: x["s"]), "").alias("s"))


def cell_merges(before: DataFrame, after: DataFrame, longest: int = 6) -> DataFrame:
    """``(key, tab, line, item, kind, slots)``: later cells that hold what neighbouring earlier cells said, one after the other.

    kind is ``column`` for cells side by side, ``row`` for one above the other,
    else ``block``. What runs of cells say meets what later cells say by hash;
    a later cell that was a cell before is none.
    """
    early, late = streamed(before), streamed(after)
    runs = neighbours(early, longest).withColumn("h", F.xxhash64("s"))
    fresh = late.where(F.size("words") >= 2 * LEAST_WORDS).join(early.select("key", "s").distinct(), ["key", "s"], "left_anti").withColumn("h", F.xxhash64("s"))
    met = fresh.select("key", "h", "s", F.col("tab").alias("to_tab"), "line", "item").join(runs.withColumnRenamed("s", "said"), ["key", "h"]).where("s = said")
    best = F.min_by(F.struct("kind", "slots"), F.struct(F.abs(F.col("tab") - F.col("to_tab")), F.when(F.col("kind") == "column", 0).when(F.col("kind") == "row", 1).otherwise(2), F.size("slots"), F.col("slots"))).alias("b")
    return met.groupBy("key", F.col("to_tab").alias("tab"), "line", "item").agg(best).select("key", "tab", "line", "item", "b.kind", "b.slots")


def role(cells: DataFrame) -> Column:
    """The last of several cells of a row is its answer, all others are questions."""
    return F.when((cells["nth"] == cells["width"] - 1) & (cells["width"] > 1), "answer").otherwise("question")


def first_holders(asked: list[dict], held: list[dict]) -> Iterator[tuple[dict, dict]]:
    """Cells with the first cell in order of ``held`` that has their first words, and all of their letters, in a row."""
    waiting: dict[tuple[str, ...], list[dict]] = {}
    for cell in asked:
        waiting.setdefault(tuple(cell["words"].split(" ")[:ANCHOR]), []).append(cell)
    sizes = {len(head) for head in waiting}
    for there in held:
        words = there["words"].split(" ") if there["words"] else []
        for head in {run for size in sizes for run in zip(*(words[k:] for k in range(size)), strict=False) if run in waiting}:
            left = []
            for cell in waiting[head]:
                if cell["s"] in there["s"]:
                    yield cell, there
                else:
                    left.append(cell)
            waiting[head] = left


def followed(before: DataFrame, after: DataFrame) -> DataFrame:
    """``moved_text`` with ``at_end``, whether the later cell ends with the text, and ``receives``, what the first cell of the row below it says.

    A document's cells are one row of each side; all that is asked of them is
    answered in one pass over its words, and nothing is shuffled that lies together.
    """
    early, late = streamed(before), streamed(after)
    part = lambda cells: F.struct("tab", "line", "item", role(cells).alias("role"), F.col("width").cast("int").alias("width"), F.col("nth").cast("int").alias("nth"), "s", F.array_join("words", " ").alias("words"))
    asked = early.where(F.length("s") >= LEAST_LETTERS).where(F.size("words") > 0).groupBy("key").agg(F.collect_list(part(early)).alias("early"))
    both = asked.join(late.groupBy("key").agg(F.array_sort(F.collect_list(part(late))).alias("late")), "key")
    kind = {c: before.schema[c].dataType.simpleString() for c in CELL} | {f"to_{c}": after.schema[c].dataType.simpleString() for c in CELL[1:]}
    schema = ", ".join([*(f"{c} {kind[c]}" for c in CELL), "role string", *(f"to_{c} {kind[f'to_{c}']}" for c in CELL[1:]), "to_role string, change string, s string, at_end boolean, receives string"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for key, early, late in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                firsts = {(x["tab"], x["line"]): x["s"] for x in late if x["nth"] == 0}
                for x, to in first_holders(early, late):
                    change = "reshaped" if to["width"] != x["width"] else "moved" if to["role"] != x["role"] else None
                    if change:
                        found.append((key, x["tab"], x["line"], x["item"], x["role"], to["tab"], to["line"], to["item"], to["role"], change, x["s"], to["s"].endswith(x["s"]), firsts.get((to["tab"], to["line"] + 1))))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found, strict=True), types, strict=True)], names)

    empty = before.sparkSession.createDataFrame([], schema)
    names, types = empty.columns, list(empty.toArrow().schema.types)
    return both.mapInArrow(find, schema)


def moved_text(before: DataFrame, after: DataFrame) -> DataFrame:
    """Text of earlier cells that a later cell holds in another place.

    ``(key, tab, line, item, role, to_tab, to_line, to_item, to_role, change, s)``:
    change is ``moved`` where the side of the table changed, ``reshaped`` where
    the row has another number of cells. The later cell is the first in order
    that has all of the earlier one's letters in a row, and its first words.
    """
    return followed(before, after).drop("at_end", "receives")


def column_repairs(before: DataFrame, after: DataFrame) -> DataFrame:
    """Text that moved, with ``why`` it can't be put back, null where it can: ``(key, tab, line, item, to_tab, to_line, to_item, s, why)``.

    It can where a question stands at the end of an answer and the row below
    has an empty first cell for it; anything else has no one place to go.
    """
    why = (
        F.when((F.col("role") != "question") | (F.col("to_role") != "answer"), "not a question in an answer").when(~F.col("at_end"), "not at the answer's end")
        .when(F.col("receives").isNull(), "no row below").when(F.col("receives") != "", "the row below has a first cell")
    )
    return followed(before, after).where("change = 'moved'").select(*CELL, "to_tab", "to_line", "to_item", "s", why.alias("why"))


def repaired(after: DataFrame, repairs: DataFrame) -> DataFrame:
    """``after`` with each provable repair made: the text's own characters go from the answer's end to the empty cell below."""
    done = repairs.where("why is null").groupBy("key", F.col("to_tab").alias("tab"), F.col("to_line").alias("line"), F.col("to_item").alias("item")).agg(F.max("s").alias("s"))
    gap = "[^0-9A-Za-z]*"
    rows = after.join(done, CELL, "left").withColumn("pattern", F.concat(F.lit("(?i)("), F.array_join(F.split("s", ""), gap), F.lit(f"{gap})$")))
    rows = rows.withColumn("cut", F.when(F.col("s").isNotNull(), F.call_function("regexp_extract", F.col("said"), F.col("pattern"), F.lit(1))))
    first = rows.where("cut is not null").select("key", "tab", (F.col("line") + 1).alias("line"), F.col("cut").alias("gets"))
    nth = F.row_number().over(Window.partitionBy("key", "tab", "line").orderBy("item"))
    out = rows.withColumn("first", nth == 1).join(first, ["key", "tab", "line"], "left")
    kept = F.when(F.col("cut").isNotNull(), F.rtrim(F.substring("said", F.lit(1), F.length("said") - F.length("cut")))).otherwise(F.col("said"))
    said = F.when(F.col("first") & F.col("gets").isNotNull(), F.col("gets")).otherwise(kept)
    return out.select(*CELL, said.alias("said"))
