"""Layout from one text, characters from another: column expressions that can add no character but white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, unescape

#: Layout (tags and white space), then one unit of content: an entity or a character.
UNIT = r"(?s)((?:<[^>]+>|\s++)*+)(&[#0-9a-zA-Z]+;|.)"
#: Words of a line that one pattern matches; longer ones go unit by unit.
MATCHED = 300
#: Layout at the end.
TAIL = r"((?:<[^>]+>|\s)++)\z"


def units(markup: Column) -> Column:
    """Content in order, an entity being one unit; tags and white space are none."""
    return F.regexp_extract_all(F.regexp_replace(markup, TAIL, ""), F.lit(UNIT), 2)


def gaps(markup: Column) -> Column:
    """The layout before each unit."""
    return F.regexp_extract_all(F.regexp_replace(markup, TAIL, ""), F.lit(UNIT), 1)


def tail(markup: Column) -> Column:
    """The layout behind the last unit."""
    return F.regexp_extract(markup, TAIL, 1)


def shown(unit: Column) -> Column:
    """What a unit shows: a numbered or named entity is the character that it stands for."""
    number = F.regexp_extract(unit, "^&#([0-9]{1,7});$", 1)
    return F.when(F.length(unit) == 1, unit).when(number != "", F.decode(F.unhex(F.lpad(F.hex(F.nullif(number, F.lit("")).cast("int")), 8, "0")), "utf-32")).otherwise(unescape(unit))


def reprojected(before: Column, after: Column) -> Column:
    """The layout of ``after`` around the characters of ``before``; null if their units aren't as many or differ in a letter or digit."""

    def build(x: Column) -> Column:
        ub, ua = x["ub"], x["ua"]
        alnum = r"[\p{L}\p{N}]"
        same = F.zip_with(ub, ua, lambda b, a: (b == a) | let(F.struct(shown(b).alias("b"), shown(a).alias("a")), lambda s: (s["b"] == s["a"]) | ~(s["b"].rlike(alnum) | s["a"].rlike(alnum))))
        laid = F.concat(F.array_join(F.zip_with(gaps(after), ub, lambda g, b: F.concat(g, b)), ""), tail(after))
        return F.when((F.size(ub) == F.size(ua)) & F.forall(same, lambda s: F.coalesce(s, F.lit(False))), laid)

    return let(F.struct(units(before).alias("ub"), units(after).alias("ua")), build)


def escape(text: Column) -> Column:
    for char, name in (("&", "amp"), ("<", "lt"), (">", "gt"), ('"', "quot")):
        text = F.replace(text, F.lit(char), F.lit(f"&{name};"))
    return text


def respaced(cell: Column, page: Column, place: Column | None = None) -> Column:
    """``cell`` with a space wherever it has none and the page has some between the same two characters.

    The cell's characters have to stand in the page one after the other, white
    space aside; else it stays as it is. Its own layout stays in any case.
    Where it is known at which ``place`` of the page the cell stands, and that
    has just these characters, its spaces count and the page isn't searched.
    Else the first such place does; where that lacks a space that the cell has,
    a line of the page that has just these characters and all the cell's
    spaces goes before.
    """
    plain = r"(\s*+)(\S)"
    white = " \t\n\x0b\f\r"
    laid = lambda text: F.regexp_extract_all(text, F.lit(plain), 1)
    more = lambda x: F.greatest(F.size(x["uc"]) - 1, F.lit(0))
    rest = lambda x, g: F.slice(g, 2, more(x))

    def spaced(x: Column, between: Column) -> Column:
        gap = F.zip_with(x["gc"], F.concat(F.array(F.lit("")), between), lambda own, there: F.when(own.rlike(r"\s|<br") | (there == ""), own).when(own.rlike("^<[^/]"), F.concat(F.lit(" "), own)).otherwise(F.concat(own, F.lit(" "))))
        return F.concat(F.array_join(F.zip_with(gap, x["uc"], lambda g, u: F.concat(g, u)), ""), tail(cell))

    def search(x: Column, y: Column) -> Column:
        at = F.instr(y["said"], x["want"])
        agrees = lambda g: F.forall(F.zip_with(rest(x, x["gc"]), g, lambda own, there: ~own.rlike(r"\s|<br") | (there != "")), lambda ok: F.coalesce(ok, F.lit(False)))
        # the page's gaps behind the first character, one before each of the others
        first = F.slice(y["gp"], at + 1, more(x))
        lines = F.filter(F.split(page, "\n"), lambda s: (F.length(s) >= F.length(x["want"])) & (F.translate(s, white, "") == x["want"]))
        fits = F.filter(F.transform(lines, lambda s: rest(x, laid(s))), agrees)
        between = let(first, lambda g: F.when(agrees(g), g).otherwise(F.coalesce(F.get(fits, 0), g)))
        return F.when(at > 0, spaced(x, between)).otherwise(cell)

    def build(x: Column) -> Column:
        found = let(F.struct(F.regexp_replace(page, r"\s+", "").alias("said"), laid(page).alias("gp")), lambda y: search(x, y))
        if place is not None:
            found = F.when(F.translate(place, white, "") == x["want"], spaced(x, rest(x, laid(place)))).otherwise(found)
        return F.when(F.size(x["uc"]) > 0, found).otherwise(cell)

    def at_place(p: Column) -> Column:
        # most cells are the place's words with some of its spaces: then the place says it all; a matcher goes one deeper with each word
        words = F.concat(F.lit(r"^\Q"), F.replace(p, F.lit(" "), F.lit(r"\E ?\Q")), F.lit(r"\E\z"))
        return F.when(~F.contains(p, F.lit(r"\E")) & (F.size(F.split(p, " ")) <= MATCHED) & F.call_function("rlike", cell, words), p).otherwise(by_units)

    page = F.coalesce(page, F.lit(""))
    by_units = let(let(units(cell), lambda u: F.struct(u.alias("uc"), gaps(cell).alias("gc"), F.array_join(F.transform(u, shown), "").alias("want"))), build)
    return by_units if place is None else let(escape(F.trim(F.regexp_replace(place, r"\s+", " "))), at_place)
