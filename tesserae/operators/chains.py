"""Longest rising chains over many candidate places: headings found in their source in order, lists aligned in sequence."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: What a place is worth beyond its being one: it starts a line, and its words are spelt as in the heading.
PLACE, LINE_START, SAME_WORDS = 1_000, 2, 1


def best_chain(pairs: Sequence[tuple[int, int, int]]) -> list[int]:
    """Indexes of the pairs ``(a, b, worth)`` in a chain that rises in both and is worth most, in order.

    Of chains worth the same, one that reaches low ``b`` first. Ends of chains
    are kept as a front on which ``b`` and worth both rise, so a pair finds its
    best predecessor by bisection.
    """
    order = sorted(range(len(pairs)), key=lambda k: (pairs[k][0], -pairs[k][1], pairs[k][2]))
    ends: list[int] = []  # b of the front
    front: list[tuple[int, int]] = []  # worth, pair
    before = [-1] * len(pairs)
    for k in order:
        _, b, worth = pairs[k]
        at = bisect_left(ends, b)
        if at:
            worth += front[at - 1][0]
            before[k] = front[at - 1][1]
        if at < len(ends) and ends[at] == b and front[at][0] >= worth:
            continue
        stop = at
        while stop < len(ends) and front[stop][0] <= worth:
            stop += 1
        ends[at:stop], front[at:stop] = [b], [(worth, k)]
    chain, k = [], front[-1][1] if front else -1
    while k >= 0:
        chain.append(k)
        k = before[k]
    return chain[::-1]


def longest_chain(pairs: DataFrame, keys: list[str], a: str = "a", b: str = "b", worth: str | None = None) -> DataFrame:
    """The rows ``(*keys, a, b)`` of ``pairs`` that make the best chain of their key: strictly rising in ``a`` and ``b``.

    Worths are positive, so where all pairs of a key rise they are its chain,
    and Spark sees that by a window. Of the other keys, one key's pairs, two
    numbers each, meet in a task.
    """

    def choose(found: pa.Table) -> pa.Table:
        rows = list(zip(found.column(a).to_pylist(), found.column(b).to_pylist(), found.column("_worth").to_pylist(), strict=True))
        return found.take(pa.array(best_chain(rows), pa.int64())).drop_columns(["_worth"])

    rows = pairs.select(*keys, a, b, (F.col(worth) if worth else F.lit(1)).cast("long").alias("_worth"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    order = Window.partitionBy(*keys).orderBy(a, b)
    falls = (F.col(a) <= F.lag(a).over(order)) | (F.col(b) <= F.lag(b).over(order))
    rows = rows.withColumn("_falls", F.coalesce(falls, F.lit(False))).withColumn("_falls", F.max("_falls").over(Window.partitionBy(*keys)))
    rising, others = rows.where("not _falls").select(*keys, a, b), rows.where("_falls").drop("_falls")
    return rising.unionByName(others.groupBy(*keys).applyInArrow(choose, kinds))


def aligned(left: DataFrame, right: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Rows of two ordered lists matched in sequence: ``(*keys, a, b)``, the positions of a longest common subsequence.

    Equal values of a key meet by an equi-join; values repeated on both sides meet in every combination.
    """
    x, y = left.select(*keys, F.col(order).alias("a"), F.xxhash64(value).alias("h"), F.col(value).alias("v")), right.select(*keys, F.col(order).alias("b"), F.xxhash64(value).alias("h"), F.col(value).alias("w"))
    return longest_chain(x.join(y, [*keys, "h"]).where("v = w"), keys)


def squashed(words: Sequence[str]) -> tuple[str, dict[int, int], dict[int, int]]:
    """Words without anything between them, hyphens and apostrophes gone too, and the words that start and end at each letter."""
    text, starts, ends, size = [], {}, {}, 0
    for k, w in enumerate(words):
        w = w.translate(_LOOSE)
        if w:
            starts[size], size = k, size + len(w)
            ends[size] = k + 1
            text.append(w)
    return "".join(text), starts, ends


_LOOSE = str.maketrans("", "", "-'’")


def titles_of(words: Sequence[str]) -> list[list[str]]:
    """A heading as it may be printed: whole, or without the number in front."""
    k = next((k for k, w in enumerate(words) if not w.strip("().").replace(".", "").isdigit()), len(words))
    return [list(words)] + ([list(words[k:])] if k and len(words) - k >= 2 else [])


def places(source: Sequence[str], line_starts: set[int], headings: Sequence[Sequence[str]]) -> Iterator[tuple[int, int, int, int]]:
    """``(heading, first word, words, worth)`` of every place where the source spells a heading's letters, from word to word."""
    text, starts, ends = squashed(source)
    for i, words in enumerate(headings):
        for spelt in titles_of(words):
            want = squashed(spelt)[0]
            at = text.find(want) if want else -1
            met = False
            while at >= 0:
                if at in starts and at + len(want) in ends:
                    first, last = starts[at], ends[at + len(want)]
                    met = True
                    yield i, first, last - first, PLACE + LINE_START * (first in line_starts) + SAME_WORDS * (list(source[first:last]) == spelt)
                at = text.find(want, at + 1)
            if met:
                break


def located(headings: DataFrame, source: DataFrame, key: str = "doc_id") -> DataFrame:
    """``headings(key, i, words)`` with the place of each in ``source(key, pos, word, line_start)``: ``(key, i, at, n)``, at null if it has none.

    All places of all headings are candidates, however the source spaces or
    hyphenates them; of the chains in which headings and places both rise, the
    one that locates most headings is taken, then the one with most on lines
    of their own. So a heading that is lost, or mentioned before it is reached,
    takes none of the others with it. One document is compared at a time.
    """

    def locate(left: pa.Table, right: pa.Table) -> pa.Table:
        order = sorted(range(left.num_rows), key=left.column("i").to_pylist().__getitem__)
        numbers, words = left.column("i").to_pylist(), left.column("words").to_pylist()
        right = right.sort_by("pos")
        tokens, lines = right.column("word").to_pylist(), right.column("line_start").to_pylist()
        pos = right.column("pos").to_pylist()
        found = list(places(tokens, {k for k, x in enumerate(lines) if x}, [words[k] or [] for k in order]))
        at = {found[k][0]: found[k] for k in best_chain([(f[0], f[1], f[3]) for f in found])}
        rows = [(numbers[k], pos[at[j][1]] if j in at else None, at[j][2] if j in at else None) for j, k in enumerate(order)]
        keys = left.column(key)[:1].to_pylist() * len(rows)
        return pa.table([pa.array(keys, left.schema.field(key).type), *(pa.array([r[c] for r in rows], pa.int64()) for c in range(3))], [key, "i", "at", "n"])

    kind = headings.schema[key].dataType.simpleString()
    left = headings.select(key, F.col("i").cast("long").alias("i"), "words")
    right = source.select(F.col(key).alias("of"), F.col("pos").cast("long").alias("pos"), "word", "line_start")
    return left.groupBy(key).cogroup(right.groupBy("of")).applyInArrow(locate, f"`{key}` {kind}, i long, at long, n long").where("i is not null")


def own_slices(places: DataFrame, sizes: DataFrame, key: str = "doc_id") -> DataFrame:
    """The source that is each located heading's own: ``(key, i, start, end, closed)``, from after the heading to the next located one.

    ``sizes(key, n)`` has the words of each source. closed says that the
    heading next in number is located too, or that there is none: else the
    slice may hold more than its own.
    """
    by = Window.partitionBy(key).orderBy("i")
    rows = places.withColumn("next_at", F.lead("at").over(by)).withColumn("last", F.lead("i").over(by).isNull())
    rows = rows.where("at is not null").withColumn("end", F.lead("at").over(by)).join(sizes.select(key, F.col("n").alias("whole")), key)
    return rows.select(key, "i", (F.col("at") + F.col("n")).alias("start"), F.coalesce("end", "whole").alias("end"), (F.col("last") | F.col("next_at").isNotNull()).alias("closed"))
