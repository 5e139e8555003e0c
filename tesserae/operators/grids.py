"""HTML tables: cells out of markup, their places in the grid, cleaning, and splits that are proved."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import collapse, content_stream, unescape
from ..sources.shared import cut, dealt

#: A comment, a tag (quoted values may hold ``>``), text, or a stray ``<``.
PIECE = r"""((?s)<!--.*?-->|</?[A-Za-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^<]++|<)"""
#: The most that a cell may span (HTML's own limits).
MOST_COLUMNS, MOST_ROWS = 1_000, 65_534
#: What a slot takes besides its text.
SLOT_BYTES = 32


def pieces(rows: DataFrame, key: str, html: str) -> DataFrame:
    """Markup in reading order: ``(key, at, said, tag, opens, top, up, tab, line, item)``.

    tab is where the innermost open table starts (null outside tables), up the
    table around it, top the outermost one; line and item count rows and cells
    of tab from 0 and are null before the first. All come from running counts,
    so nested and unclosed elements need no stack; a closing tag without its
    opening one is passed over.
    """
    found = rows.select(F.col(key).alias("key"), F.posexplode(F.regexp_extract_all(html, F.lit(PIECE), 1)).alias("at", "said"))
    name = F.lower(F.regexp_extract("said", r"^</?([A-Za-z][A-Za-z0-9]*)", 1))
    found = found.withColumn("tag", F.when(F.col("said").startswith("<!--"), "!").otherwise(F.nullif(name, F.lit("")))).withColumn("opens", ~F.col("said").startswith("</"))
    in_order = Window.partitionBy("key").orderBy("at")
    so_far, before = in_order.rowsBetween(Window.unboundedPreceding, 0), in_order.rowsBetween(Window.unboundedPreceding, -1)
    step = F.when(F.col("tag") == "table", F.when(F.col("opens"), 1).otherwise(-1)).otherwise(0)
    found = found.withColumn("step", step).withColumn("net", F.sum("step").over(so_far))
    # stray closing tags so far: how far the running sum has been below zero
    found = found.withColumn("stray", F.greatest(F.lit(0), -F.min("net").over(so_far)))
    depth = F.coalesce(F.sum("step").over(before), F.lit(0)) + F.when(F.col("step") == 1, 1).otherwise(0) + F.coalesce(F.max("stray").over(before), F.lit(0))
    found = found.withColumn("depth", depth)
    start = F.when(F.col("step") == 1, F.col("at"))
    level = Window.partitionBy("key", "depth").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("tab", F.when(F.col("depth") > 0, F.last(start, ignorenulls=True).over(level)))
    found = found.withColumn("top", F.when(F.col("depth") > 0, F.last(F.when(F.col("depth") == 1, F.col("tab")), ignorenulls=True).over(so_far)))
    # a table lies in the one that was open a piece before it
    found = found.withColumn("outer", F.when((F.col("step") == 1) & (F.col("depth") > 1), F.lag("tab").over(in_order)))
    own = Window.partitionBy("key", "tab").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    is_row, is_cell = (F.col("tag") == "tr") & F.col("opens"), F.col("tag").isin("td", "th") & F.col("opens")
    found = found.withColumn("up", F.first("outer").over(own)).withColumn("line", F.count_if(is_row).over(own) - 1)
    row = Window.partitionBy("key", "tab", "line").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("item", F.count_if(is_cell).over(row) - 1)
    none = F.lit(None).cast("long")
    found = found.withColumn("line", F.when(F.col("tab").isNotNull(), F.greatest("line", F.lit(0))).otherwise(none))
    return found.select("key", "at", "said", "tag", "opens", "top", "up", "tab", "line", F.when(F.col("tab").isNotNull() & (F.col("item") >= 0), F.col("item")).alias("item"))


def span(said: Column, name: str, most: int) -> Column:
    """A span attribute as a number from 1 to ``most``; anything else is 1."""
    digits = F.regexp_extract(said, rf"""(?i)\b{name}\s*=\s*["']?\s*0*(\d{{1,9}})""", 1)
    return F.least(F.greatest(F.coalesce(F.nullif(digits, F.lit("")), F.lit("1")).cast("int"), F.lit(1)), F.lit(most))


def cells(rows: DataFrame, key: str, html: str) -> DataFrame:
    """``(key, tab, up, line, item, head, rowspan, colspan, said)`` of every cell of every table.

    said is the cell's own text, entities resolved, white space collapsed, a
    break as a space; a table within a cell has rows of its own. A null or
    empty markup, or one without a table, has no cells.
    """
    found = pieces(rows, key, html).where("item is not null")
    is_cell = F.col("tag").isin("td", "th")
    # text counts between a cell's opening and closing tag; one that is left open ends with the next cell or row
    own = Window.partitionBy("key", "tab", "line", "item").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("over", F.max(F.when((is_cell | F.col("tag").isin("tr")) & ~F.col("opens"), 1).otherwise(0)).over(own))
    text = F.when(F.col("over") == 0, F.when(F.col("tag").isNull(), F.struct("at", "said")).when(F.col("tag").isin("br", "p", "div", "li"), F.struct("at", F.lit(" ").alias("said"))))
    opening = F.min_by(F.struct("said", F.col("tag").alias("tag")), F.when(is_cell & F.col("opens"), F.col("at")))
    out = found.groupBy("key", "tab", "line", "item").agg(F.min("up").alias("up"), opening.alias("opening"), F.array_sort(F.collect_list(text)).alias("texts"))
    said = collapse(unescape(F.array_join(F.transform("texts", lambda x: x["said"]), "")))
    return out.select("key", "tab", "up", "line", "item", (F.col("opening.tag") == "th").alias("head"), span(F.col("opening.said"), "rowspan", MOST_ROWS).alias("rowspan"), span(F.col("opening.said"), "colspan", MOST_COLUMNS).alias("colspan"), said.alias("said"))


def columns_of(rows: Sequence[dict]) -> list[int]:
    """The column of each cell of one table, cells in reading order: the first that no cell above still fills."""
    until: dict[int, int] = {}
    places, line, at = [], None, 0
    for cell in rows:
        if cell["line"] != line:
            line, at = cell["line"], 0
        while until.get(at, -1) >= line:
            at += 1
        places.append(at)
        for c in range(at, at + cell["colspan"]):
            until[c] = max(until.get(c, -1), line + cell["rowspan"] - 1)
        at += cell["colspan"]
    return places


def layout(tables: Column) -> Column:
    """Columns of the cells of whole tables; a table is one row here, as its markup was."""

    @F.arrow_udf("array<int>")
    def found(tables: pa.Array) -> pa.Array:
        return pa.array([columns_of(t) for t in tables.to_pylist()], pa.list_(pa.int32()))

    return found(tables)


def placed(found: DataFrame) -> DataFrame:
    """Cells with ``col``, their first column in the occupancy grid; spans below the table's last row are cut."""
    order = F.struct("line", "item", "head", "rowspan", "colspan", "said")
    tables = found.groupBy("key", "tab").agg(F.min("up").alias("up"), F.array_sort(F.collect_list(order)).alias("cells"), (F.max("line") + 1).alias("n_lines"))
    shape = F.transform("cells", lambda c: F.struct(c["line"].cast("int").alias("line"), c["rowspan"].alias("rowspan"), c["colspan"].alias("colspan")))
    tables = tables.withColumn("cols", layout(shape))
    out = tables.select("key", "tab", "up", "n_lines", F.explode(F.arrays_zip("cells", "cols")).alias("c"))
    return out.select("key", "tab", "up", "c.cells.line", "c.cells.item", F.col("c.cols").alias("col"), F.least(F.col("c.cells.rowspan"), (F.col("n_lines") - F.col("c.cells.line")).cast("int")).alias("rowspan"), "c.cells.colspan", "c.cells.head", "c.cells.said")


def slots(grid: DataFrame, repeat: bool = False) -> DataFrame:
    """``(key, tab, line, col, said)``: each slot of the grid; a cell's text in its first one, or in all of them.

    Cells are written once and dealt by the bytes of their slots: Spark doesn't
    know how rows lie after Python laid them out, and would shuffle slots.
    """
    area = F.col("rowspan").cast("bigint") * F.col("colspan")
    bytes_of = SLOT_BYTES * area + F.octet_length("said") * (area if repeat else F.lit(1))
    grid = dealt(cut(grid.select("key", "tab", "line", "item", "col", "rowspan", "colspan", "said"), "cells"), "key", bytes_of)
    down, right = F.sequence(F.lit(0), F.col("rowspan") - 1), F.sequence(F.lit(0), F.col("colspan") - 1)
    out = grid.withColumn("dr", F.explode(down)).withColumn("dc", F.explode(right))
    said = F.col("said") if repeat else F.when((F.col("dr") == 0) & (F.col("dc") == 0), F.col("said")).otherwise("")
    # of overlapping spans the later cell shows
    best = F.max_by(said, F.struct(F.col("line"), F.col("item")))
    return out.groupBy("key", "tab", (F.col("line") + F.col("dr")).alias("to_line"), (F.col("col") + F.col("dc")).alias("col")).agg(best.alias("said")).withColumnRenamed("to_line", "line")


def cleaned(filled: DataFrame) -> DataFrame:
    """Slots without what looser detection leaves: a text that repeats the one to its left goes, then empty columns and rows do.

    Rows and columns that stay are numbered anew from 0.
    """
    across = Window.partitionBy("key", "tab", "line").orderBy("col")
    kept = filled.withColumn("said", F.when(F.lag("said").over(across) == F.col("said"), "").otherwise(F.col("said")))
    some = F.max(F.when(F.col("said") != "", 1).otherwise(0))
    lines, cols = Window.partitionBy("key", "tab", "line"), Window.partitionBy("key", "tab", "col")
    kept = kept.withColumn("some_line", some.over(lines)).withColumn("some_col", some.over(cols)).where("some_line = 1 and some_col = 1")
    by_line, by_col = Window.partitionBy("key", "tab").orderBy("line"), Window.partitionBy("key", "tab").orderBy("col")
    return kept.select("key", "tab", (F.dense_rank().over(by_line) - 1).alias("line"), (F.dense_rank().over(by_col) - 1).alias("col"), "said")


def pipe_text(filled: DataFrame) -> DataFrame:
    """``(key, tab, said)``: tables of two rows or more as pipe text, short rows filled up, bars escaped."""
    bare = F.replace(F.col("said"), F.lit("|"), F.lit("\\|"))
    wide = filled.withColumn("last", F.max("col").over(Window.partitionBy("key", "tab")))
    at = F.map_from_entries(F.collect_list(F.struct("col", bare.alias("said")))).alias("at")
    cols = F.sequence(F.lit(0), F.col("last"))
    piped = lambda inner: F.concat(F.lit("| "), F.array_join(inner, " | "), F.lit(" |"))
    shown = piped(F.transform(cols, lambda c: F.coalesce(F.element_at("at", c), F.lit(""))))
    lines = wide.groupBy("key", "tab", "line", "last").agg(at).select("key", "tab", "line", "last", shown.alias("shown"))
    tables = lines.groupBy("key", "tab", "last").agg(F.array_sort(F.collect_list(F.struct("line", "shown"))).alias("rows")).where(F.size("rows") > 1)
    shown = F.transform("rows", lambda r: r["shown"])
    rule = piped(F.transform(cols, lambda _: F.lit("---")))
    return tables.select("key", "tab", F.array_join(F.concat(F.slice(shown, 1, 1), F.array(rule), F.slice(shown, 2, F.size(shown))), "\n").alias("said"))


#: A row that names a part: a dotted number, then its title.
LABEL = r"^(\d+(?:\.\d+)+)[.)]?\s+(\S.*)$"


def raw_rows(rows: DataFrame, key: str, html: str) -> DataFrame:
    """``(key, tab, line, raw, id, title)``: rows of outermost tables byte for byte, tables inside them included.

    id and title are those of a row whose whole text is one cell that begins with a dotted number.
    """
    found = pieces(rows, key, html).where("top is not null")
    in_order = Window.partitionBy("key", "top").orderBy("at")
    own_row = F.col("tag").eqNullSafe("tr") & (F.col("tab") == F.col("top"))
    found = found.withColumn("row", F.count_if(own_row & F.col("opens")).over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    shut = F.max(F.when(own_row & ~F.col("opens"), 1).otherwise(0)).over(Window.partitionBy("key", "top", "row").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    inside = found.withColumn("shut", F.coalesce(shut, F.lit(0))).where("row >= 0 and shut = 0 and not (tag <=> 'table' and tab = top)")
    filled = F.count_distinct(F.when(F.col("tag").isNull() & (F.trim("said") != "") & F.col("item").isNotNull(), F.struct("tab", "line", "item")))
    out = inside.groupBy("key", F.col("top").alias("tab"), F.col("row").alias("line")).agg(F.array_sort(F.collect_list(F.struct("at", "said"))).alias("parts"), filled.alias("n_filled"))
    out = out.withColumn("raw", F.array_join(F.transform("parts", lambda x: x["said"]), "")).withColumn("text", collapse(unescape(F.regexp_replace("raw", "<[^>]*>", " "))))
    label = (F.col("n_filled") == 1) & F.col("text").rlike(LABEL)
    part = lambda k: F.when(label, F.regexp_extract("text", LABEL, k))
    return out.select("key", "tab", "line", "raw", part(1).alias("id"), part(2).alias("title"))


def split_tables(rows: DataFrame, key: str, html: str, heading: str = "###", repeat_header: bool = False) -> DataFrame:
    """``(key, tab, part, id, title, said, n_rows)``: a table as one piece for each row that names a part.

    The naming row becomes the piece's heading; rows above the first one go
    with it, and with ``repeat_header`` the first of them into every piece.
    Tables without such a row give no pieces.
    """
    found = raw_rows(rows, key, html)
    in_order = Window.partitionBy("key", "tab").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("part", F.greatest(F.count("id").over(in_order), F.lit(1))).withColumn("lead", F.count("id").over(in_order) == 0)
    found = found.withColumn("n_ids", F.count("id").over(Window.partitionBy("key", "tab"))).where("n_ids > 0")
    head = F.first(F.when((F.col("line") == 0) & F.col("lead"), F.col("raw")), ignorenulls=True).over(in_order)
    found = found.withColumn("first_row", head)
    body = F.array_sort(F.collect_list(F.when(F.col("id").isNull(), F.struct("line", "raw"))))
    out = found.groupBy("key", "tab", "part").agg(F.max("id").alias("id"), F.max("title").alias("title"), body.alias("body"), F.first("first_row").alias("first_row"))
    again = F.when(F.lit(repeat_header) & (F.col("part") > 1), F.coalesce("first_row", F.lit(""))).otherwise("")
    inner = F.concat(again, F.array_join(F.transform("body", lambda x: x["raw"]), ""))
    table = F.when(F.size("body") > 0, F.concat(F.lit("\n\n<table>"), inner, F.lit("</table>"))).otherwise("")
    return out.select("key", "tab", "part", "id", "title", F.concat(F.lit(f"{heading} "), "id", F.lit(" "), "title", table).alias("said"), F.size("body").alias("n_rows"))


def verify_split(rows: DataFrame, key: str, html: str, split: DataFrame) -> DataFrame:
    """``(key, tab, ok, reason)`` of each table that was split: every other row byte for byte in its order, every naming row in its heading.

    The pieces are parsed anew, so a row that was dropped, repeated, reworded
    or moved is refused, whoever made the pieces.
    """
    before = raw_rows(rows, key, html)
    kept = F.transform(F.array_sort(F.collect_list(F.when(F.col("id").isNull(), F.struct("line", "raw")))), lambda x: x["raw"])
    labels = F.transform(F.array_sort(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("line", content_stream(F.col("raw")).alias("s"))))), lambda x: x["s"])
    want = before.groupBy("key", "tab").agg(kept.alias("rows"), labels.alias("labels"))
    whole = split.groupBy("key", "tab").agg(F.array_sort(F.collect_list(F.struct("part", "said"))).alias("parts"))
    whole = whole.withColumn("said", F.array_join(F.transform("parts", lambda x: x["said"]), "\n\n")).select("key", "tab", "said", F.struct("key", "tab").alias("id"))
    whole = dealt(cut(whole, "split-tables"), "id", "said")
    after = raw_rows(whole, "id", "said").groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("tab", "line", "raw"))), lambda x: x["raw"]).alias("rows"))
    heads = F.transform(F.regexp_extract_all("said", F.lit(r"(?m)^#{2,4}\s+(.*)$"), 1), content_stream)
    got = whole.select("key", "tab", "id", heads.alias("heads")).join(after.withColumnRenamed("key", "id").withColumnRenamed("rows", "rows_after"), "id", "left")
    none = F.array().cast("array<string>")
    joined = got.join(want, ["key", "tab"]).withColumn("rows_after", F.coalesce("rows_after", none))
    reason = (
        F.when(F.size("rows") != F.size("rows_after"), F.concat(F.lit("rows: "), F.size("rows").cast("string"), F.lit(" before, "), F.size("rows_after").cast("string"), F.lit(" after")))
        .when(F.col("rows") != F.col("rows_after"), "a row is altered").when(F.size("heads") != F.size("labels"), "headings and naming rows differ in number").when(F.col("heads") != F.col("labels"), "a heading lacks its row's text").otherwise("ok")
    )
    return joined.select("key", "tab", reason.alias("reason")).select("key", "tab", (F.col("reason") == "ok").alias("ok"), "reason")
