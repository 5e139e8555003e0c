"""What a section lost against its source and where it went: runs of words that both have, one chain keeps them in order, document by document."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import like_contents
from ..sources.shared import cut, dealt
from .chains import best_chain

#: Words of a gap worth a row (twice as many where other words stand instead), of a window and its stride, of a run. Fixed values.
LEAST, WINDOW, STRIDE, RUN = 4, 8, 4, 4
#: Shares that make a gap relocated (within its section), found elsewhere (in the whole output), restructured (in units). Fixed values.
MOVED, ELSEWHERE, UNITS = 0.6, 0.9, 0.5
#: A gap of so few words may have them anywhere; a unit has at least so many. Fixed values.
REORDERED, SHORTEST_UNIT = 10, 3
#: A hollow section: kept share at most, words of its body, share that another section holds, share of own text known to the source. Fixed values.
HOLLOW_KEPT, HOLLOW_BODY, HOLLOW_HELD, HOLLOW_OWN = 0.15, 150, 0.6, 0.8

#: Stands before and behind each section, so that its first and last words make whole runs.
EDGE = "\0"
AT = ["doc_id", "section"]
#: What rows of a document are besides its source and output: units of words, what is known of its sections.
SOURCE, OUTPUT, UNIT, KNOWN = range(4)
#: Rows that a task hands on at once.
BATCH = 4096

Words = list[str]


def grams(words: Words, size: int) -> Iterator[tuple[str, ...]]:
    """The run of ``size`` words from each word on, as far as they are whole."""
    return zip(*(words[k:] for k in range(size)), strict=False)


def matched_runs(source: Words, output: Words) -> list[tuple[int, int]]:
    """``(a, b)``: runs that both sides of a section have in the same order, edges included.

    The k-th time a run occurs meets the k-th time it does on the other side,
    counted from either end; of those the longest rising chain stays.
    """
    edge = [EDGE] * (RUN - 1)
    there: dict[tuple[str, ...], list[int]] = {}
    for b, run in enumerate(grams([*edge, *output, *edge], RUN), 1 - RUN):
        there.setdefault(run, []).append(b)
    here: dict[tuple[str, ...], list[int]] = {}
    for a, run in enumerate(grams([*edge, *source, *edge], RUN), 1 - RUN):
        if run in there:
            here.setdefault(run, []).append(a)
    met: set[tuple[int, int]] = set()
    for run, a in here.items():
        b = there[run]
        n = min(len(a), len(b))
        met.update(zip(a[:n], b[:n], strict=True))
        met.update(zip(a[-n:], b[-n:], strict=True))
    pairs = sorted(met)
    if all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False)):
        return pairs
    return [pairs[k] for k in best_chain([(a, b, 1) for a, b in pairs])]


def section_gaps(source: Words, output: Words) -> tuple[float, list[tuple[int, int, bool]]]:
    """The share of a section's words that it kept, and its gaps ``(first, last + 1, replaced)`` of some words."""
    chain = matched_runs(source, output) if output else []
    n, kept = len(source), bytearray(len(source))
    for a, _ in chain:
        for i in range(max(a, 0), min(a + RUN, n)):
            kept[i] = 1
    found, starts, i = [], [a for a, _ in chain], 0
    while (first := kept.find(0, i)) >= 0:
        i = kept.find(1, first)
        i = n if i < 0 else i
        if i - first >= LEAST:
            # output words between the matches on either side say that the gap was replaced
            at = bisect_left(starts, first)
            before, after = chain[at - 1][1] + RUN if at else 0, chain[at][1] if at < len(chain) else len(output)
            found.append((first, i, min(after, len(output)) > before))
    return sum(kept) / n, found


def windows(words: Words) -> list[tuple[str, ...]]:
    """Windows of a span; a short span is one window."""
    size = min(len(words), WINDOW)
    return [tuple(words[k : k + size]) for k in range(0, max(len(words) - size + 1, 1), STRIDE)]


def unit_share(words: Words, units: dict[tuple[str, ...], dict[int, set[tuple[str, ...]]]]) -> float:
    """Words of a span in units that stand in it whole, each unit once."""
    met = set()
    for k in range(len(words) - SHORTEST_UNIT + 1):
        for size, known in units.get(tuple(words[k : k + SHORTEST_UNIT]), {}).items():
            unit = tuple(words[k : k + size])
            if unit in known:
                met.add(unit)
    return min(1.0, sum(map(len, met)) / len(words))


def covered(words: Words, known: set[tuple[str, ...]]) -> float:
    """The share of a list's words in ``known`` runs; each run adds what the one before it doesn't cover."""
    end = n = 0
    for k, run in enumerate(grams(words, RUN)):
        if run in known:
            n += min(RUN, k + RUN - end)
            end = k + RUN
    return n / len(words) if words else 0.0


class Runs:
    """Runs of words of a document's sections and of all of it, made when they are asked for."""

    def __init__(self, sections: dict[Any, Words]) -> None:
        self.sections, self.made = sections, {}
        self.words = [w for words in sections.values() for w in words]

    def of(self, size: int, section: Any = None, whole: bool = True) -> set[tuple[str, ...]]:
        at = (size, whole, section)
        if at not in self.made:
            self.made[at] = set(grams(self.words if whole else self.sections.get(section, []), size))
        return self.made[at]


def document_gaps(source: dict[Any, Words], output: dict[Any, Words], units: list[Words]) -> Iterator[tuple]:
    """``(section, start, n, bucket, ratio, retention, words)``: gaps of each section; one that no rule here excuses has no bucket, its words and the share of them that runs cover."""
    runs, heads = Runs(output), {}
    for unit in units:
        if len(unit) >= SHORTEST_UNIT:
            heads.setdefault(tuple(unit[:SHORTEST_UNIT]), {}).setdefault(len(unit), set()).add(tuple(unit))
    for section, words in source.items():
        retention, found = section_gaps(words, output.get(section, []))
        spans = [(first, words[first:stop], replaced) for first, stop, replaced in found if not replaced or stop - first >= 2 * LEAST]
        if not spans:
            yield section, 0, 0, "none", 0.0, retention, None
        for first, span, replaced in spans:
            bucket, ratio = excused(span, section, runs, heads) if not replaced else ("changed", 0.0)
            yield section, first, len(span), bucket, ratio, retention, None if bucket else span


def excused(span: Words, section: Any, runs: Runs, units: dict) -> tuple[str | None, float]:
    """Bucket and ratio by the first rule that holds; no bucket and the share that runs cover if none does."""
    asked = windows(span)
    size = len(asked[0])
    here = sum(w in runs.of(size, section, whole=False) for w in asked) / len(asked)
    if here >= MOVED:
        return "relocated", here
    there = sum(w in runs.of(size) for w in asked) / len(asked)
    if there >= ELSEWHERE:
        return "elsewhere", there
    share = unit_share(span, units)
    if share >= UNITS:
        return "restructured", share
    share = covered(span, runs.of(RUN))
    if share >= ELSEWHERE:
        return "elsewhere", share
    if len(span) <= REORDERED and all((w,) in runs.of(1) for w in span):
        return "elsewhere", 1.0
    return None, share


def hollow_sections(source: dict[Any, Words], output: dict[Any, Words], kept: dict[Any, float]) -> Iterator[tuple]:
    """``(section, n_tokens, retention, absorbed_by, absorbed_ratio)`` of the sections in ``kept``."""
    asked = {s: windows(source[s]) for s in kept if len(source.get(s, [])) >= HOLLOW_BODY}
    wanted = {w for found in asked.values() for w in found}
    holders: dict[tuple[str, ...], set] = {}
    for section, words in output.items() if wanted else ():
        for w in grams(words, WINDOW):
            if w in wanted:
                holders.setdefault(w, set()).add(section)
    known = Runs(source)
    for section, found in asked.items():
        held = Counter(s for w in found for s in holders.get(w, ()) if s != section)
        if not held:
            continue
        ratio, back = max((n / len(found), -s) for s, n in held.items())
        if ratio >= HOLLOW_HELD and covered(output.get(section, []), known.of(RUN)) < HOLLOW_OWN:
            yield section, len(source[section]), kept[section], -back, ratio


def laid(rows: list[tuple[int, int, Words]]) -> Words:
    """The words of ``(pos, line, words)`` in order of their places; of words at one place the lower line's goes first."""
    if all(a[0] + len(a[2]) <= b[0] for a, b in zip(rows, rows[1:], strict=False)):
        return [w for _, _, words in rows for w in words]
    return [w for _, _, w in sorted(((pos + k, line, w) for pos, line, words in rows for k, w in enumerate(words)), key=lambda x: x[:2])]


def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, list[dict[Any, list[tuple[int, int, Words]]]]]]:
    """Each document of sorted rows with ``{section: rows}`` of each side."""
    now, sides = None, None
    for batch in batches:
        for doc, side, section, pos, line, token in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if sides is None or doc != now:
                if sides is not None:
                    yield now, sides
                now, sides = doc, [{} for _ in range(KNOWN + 1)]
            sides[side].setdefault(section, []).append((pos, line, token.split(" ")))
    if sides is not None:
        yield now, sides


def by_document(rows: DataFrame, find: Callable[..., Iterator[tuple]], kinds: str) -> DataFrame:
    """``(doc_id, section, *kinds)``: what ``find(source, output, sides)`` says of each document, whose rows lie in one task and come in order.

    The text is shuffled once, in partitions of bounded size; a task holds one document at a time.
    """
    doc, section = (rows.schema[c].dataType.simpleString() for c in AT)
    schema = f"doc_id {doc}, section {section}, {kinds}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for key, sides in documents(batches):
            source, output = ({s: laid(x) for s, x in sides[side].items()} for side in (SOURCE, OUTPUT))
            found.extend((key, *row) for row in find(source, output, sides))
            if len(found) >= BATCH:
                yield batch_of(found)
                found = []
        if found:
            yield batch_of(found)

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found, strict=True), types, strict=True)], names)

    empty = rows.sparkSession.createDataFrame([], schema)
    names, types = empty.columns, list(empty.toArrow().schema.types)
    ordered = dealt(rows.select("doc_id", "side", "section", "pos", "line", "token"), "doc_id", "token").sortWithinPartitions("doc_id", "side", "section", "pos", "line")
    return ordered.mapInArrow(run, schema)


def joined(tokens: DataFrame, side: int, others: DataFrame, section: Column, token: Column) -> DataFrame:
    """Rows of ``tokens`` and of what else belongs to their documents, as one table."""
    kinds = {c: tokens.schema[c].dataType for c in AT}
    line = F.col("line").cast("long") if "line" in tokens.columns else F.lit(0).cast("long")
    rows = tokens.select("doc_id", "side", "section", F.col("pos").cast("long").alias("pos"), line.alias("line"), "token")
    zero = F.lit(0).cast("long")
    return rows.unionByName(others.select(F.col("doc_id").cast(kinds["doc_id"]).alias("doc_id"), F.lit(side).alias("side"), section.cast(kinds["section"]).alias("section"), zero.alias("pos"), zero.alias("line"), token.alias("token")))


def localized_gaps(tokens: DataFrame, units: DataFrame) -> DataFrame:
    """``tokens(doc_id, side, section, pos, token)`` and ``units(doc_id, words)`` to gaps by section.

    A row's ``token`` is one word or several with a space between, which stand
    at ``pos`` and the places after it; where words of rows share a place, a
    column ``line`` says which go first.

    ``(doc_id, section, start, n, bucket, ratio, retention)``; side 0 is the
    source, 1 the output. A gap is a row of source words in no run that the
    section's output has in the same order. One that was deleted is, by the
    first rule that holds: ``relocated`` (most windows in its own section),
    ``elsewhere`` (nearly all of them in the whole output), ``restructured``
    (whole units make up half), ``elsewhere`` (runs cover nearly all, or it is
    short and every word is there), ``restructured`` (rows of a table of
    contents), else ``dropped``. One in whose place other words stand is
    ``changed``, from twice the size. retention is the share of its words that
    a section kept; one without a gap has one row of bucket ``none``.
    """
    rows = joined(tokens, UNIT, units.where(F.size("words") >= SHORTEST_UNIT), F.lit(0), F.array_join("words", " "))
    find = lambda source, output, sides: document_gaps(source, output, [words for listed in sides[UNIT].values() for _, _, words in listed])
    told = by_document(rows, find, "start int, n int, bucket string, ratio double, retention double, words array<string>")
    contents = F.col("bucket").isNull() & like_contents(F.col("words"))
    bucket = F.when(contents, "restructured").otherwise(F.coalesce("bucket", F.lit("dropped")))
    return cut(told.select(*AT, "start", "n", bucket.alias("bucket"), F.round(F.when(contents, 1.0).otherwise(F.col("ratio")), 4).alias("ratio"), F.round("retention", 4).alias("retention")), "gaps")


def hollow(tokens: DataFrame, gaps: DataFrame) -> DataFrame:
    """Sections that kept their heading and lost their body to another one: ``(doc_id, section, n_tokens, retention, absorbed_by, absorbed_ratio)``.

    The body is worth having, hardly any of it stayed, another section of the
    output holds most of its windows, and the section's own output isn't text
    that the source has.
    """
    thin = gaps.where(F.col("retention") <= HOLLOW_KEPT).select(*AT, "retention").distinct()
    rows = joined(tokens, KNOWN, thin, F.col("section"), F.col("retention").cast("string"))
    find = lambda source, output, sides: hollow_sections(source, output, {s: float(known[0][2][0]) for s, known in sides[KNOWN].items()})
    section = tokens.schema["section"].dataType.simpleString()
    found = by_document(rows, find, f"n_tokens bigint, retention double, absorbed_by {section}, absorbed_ratio double")
    return cut(found.withColumn("absorbed_ratio", F.round("absorbed_ratio", 4)), "hollow")
