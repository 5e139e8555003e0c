"""Benchmark decontamination by spaced seeds (operator 7).

Seeds of benchmark items and of documents are rows; they join on their hash,
and what a hit says is verified on the tokens around it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HashSet, cut, fresh, join_hot, table, text_of

#: An overlap is this many aligned tokens, or a whole shorter item, of which this share is equal.
WINDOW, SIMILAR = 13, 0.8
#: Token positions that a seed looks at; it ignores those between. Any 13 tokens with 2 substitutions hold one unharmed.
MASKS = ((0, 1, 4, 6, 7), (0, 1, 3, 4, 5))
#: The same for items of 5 to 12 tokens; shorter ones have to be equal.
SHORT_MASKS = ((0, 1, 2, 3), (0, 1, 2, 4), (0, 2, 3, 4), (0, 1, 3, 4), (0, 5, 6, 8))
#: All masks that items of any length may use.
EVERY = (*MASKS, *SHORT_MASKS, *(tuple(range(n)) for n in range(1, 5)))

HITS = "array<struct<item_id: bigint, matched: int, tokens: int, at: int>>"

_FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def tokens(text: str) -> list[bytes]:
    """Lower-cased words; ASCII punctuation separates, as white space does."""
    return text.lower().encode().translate(_FOLD).split()


def token_hashes(text: str) -> np.ndarray:
    import xxhash

    words = tokens(text)
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def allowed(window: int) -> int:
    """Substitutions that ``window`` aligned tokens may have."""
    return window - int(np.ceil(SIMILAR * window - 1e-9))


def masks_of(n: int) -> tuple[tuple[int, ...], ...]:
    """Masks for an item of ``n`` tokens."""
    return MASKS if n >= WINDOW else SHORT_MASKS if n >= 5 else (tuple(range(n)),) if n else ()


def seeds(ids: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """Hashes of the seed at each place where ``mask`` fits."""
    n = max(0, len(ids) - mask[-1])
    out = np.full(n, np.uint64(EVERY.index(mask) + 1) * _MIX[7], np.uint64)
    for k, off in enumerate(mask):
        out ^= (ids[off : off + n] + np.uint64(k + 1)) * _MIX[k]
        out *= _MIX[-1 - k] | np.uint64(1)
    return out ^ (out >> np.uint64(29))


def lists_of(arrays: list[np.ndarray]) -> pa.ListArray:
    """Arrays of 64-bit numbers as one Arrow column."""
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*arrays, np.empty(0, np.uint64)]).view(np.int64)))


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``(item, item_id, toks)``: distinct items with their tokens' hashes, a written table."""

    @F.arrow_udf("array<bigint>")
    def hashed(texts: pa.Array) -> pa.Array:
        return lists_of([token_hashes(x.as_py()) for x in texts])

    rows = benchmark.where("text is not null").select(F.xxhash64("item_id", "text").alias("item"), F.col("item_id").cast("long").alias("item_id"), hashed(F.col("text")).alias("toks"))
    return cut(rows.where(F.size("toks") > 0).dropDuplicates(["item"]), "benchmark-items")


def item_seeds(items: DataFrame) -> DataFrame:
    """``(h, item, at, span)`` for every seed of every item, a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, item, at, span = [], [], [], []
            for k, toks in zip(batch.column("item").to_pylist(), batch.column("toks"), strict=True):
                ids = toks.values.to_numpy(zero_copy_only=False).view(np.uint64)
                for mask in masks_of(len(ids)):
                    found = seeds(ids, mask)
                    h.append(found.view(np.int64))
                    item += [k] * len(found)
                    at += range(len(found))
                    span += [mask[-1] + 1] * len(found)
            yield pa.RecordBatch.from_pydict({"h": pa.array(np.concatenate([*h, np.empty(0, np.int64)])), "item": pa.array(item, pa.int64()), "at": pa.array(at, pa.int32()), "span": pa.array(span, pa.int32())})

    return cut(items.select("item", "toks").mapInArrow(run, "h bigint, item bigint, at int, span int"), "benchmark-seeds")


def text_seeds(rows: DataFrame, masks: list[tuple[int, ...]], wanted: HashSet) -> DataFrame:
    """``rows(digest, text)`` to ``(digest, h, at, low, near)``: seeds that an item may have, with the tokens around them.

    near are the hashes of the tokens from ``low``, as far as any window of
    WINDOW tokens that holds the whole seed reaches. The set lets few other
    seeds pass; the join drops those.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, h, at, low, near = [], [], [], [], []
            for digest, text in zip(batch.column("digest"), batch.column("text"), strict=True):
                ids = token_hashes(text.as_py())
                for mask in masks:
                    found = seeds(ids, mask)
                    for p in np.flatnonzero(wanted.has(found)).tolist():
                        digests.append(digest)
                        h.append(found[p])
                        at.append(p)
                        low.append(max(0, p + mask[-1] + 1 - WINDOW))
                        near.append(ids[low[-1] : p + WINDOW])
                    if len(near) >= 20_000:
                        yield packed(digests, h, at, low, near)
                        digests, h, at, low, near = [], [], [], [], []
            yield packed(digests, h, at, low, near)

    def packed(digests: list, h: list, at: list, low: list, near: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"digest": pa.array([d.as_py() for d in digests], pa.string()), "h": pa.array(np.array(h, np.uint64).view(np.int64)), "at": pa.array(at, pa.int32()), "low": pa.array(low, pa.int32()), "near": lists_of(near)})

    return rows.mapInArrow(run, "digest string, h bigint, at int, low int, near array<bigint>")


def good_places(ids: np.ndarray, low: int, at: int, item: np.ndarray, its: int, span: int) -> tuple[list[int], int]:
    """Equal tokens, as places in the item, within similar windows that hold the seed; and where the first begins in the text.

    ``ids`` are the text's tokens from ``low``; a seed of ``span`` tokens stands at ``at`` there and at ``its`` in the item.
    """
    width, shift = min(WINDOW, len(item)), at - its
    lo = max(0, its + span - width, low - shift)
    hi = min(len(item), its + width, low + len(ids) - shift)
    if hi - lo < width:
        return [], 0
    equal = ids[lo + shift - low : hi + shift - low] == item[lo:hi]
    run = np.r_[0, np.cumsum(equal)]
    good = np.flatnonzero(run[width:] - run[:-width] >= width - allowed(width))
    if not len(good):
        return [], 0
    inside = np.zeros(len(equal) + 1, int)
    np.add.at(inside, good, 1)
    np.add.at(inside, good + width, -1)
    return (lo + np.flatnonzero(equal & (np.cumsum(inside)[:-1] > 0))).tolist(), int(lo + shift + good[0])


def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined seeds to ``(digest, item, item_id, tokens, shift, places, first)`` where they verify."""
    for batch in batches:
        out: list[tuple] = []
        cols = [batch.column(c).to_pylist() for c in ("digest", "item", "item_id", "low", "at", "its", "span")]
        for digest, item, item_id, low, at, its, span, near, toks in zip(*cols, batch.column("near"), batch.column("toks"), strict=True):
            other = toks.values.to_numpy(zero_copy_only=False)
            places, first = good_places(near.values.to_numpy(zero_copy_only=False), low, at, other, its, span)
            if places:
                out.append((digest, item, item_id, len(other), at - its, places, first))
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.int32())
        names = ("digest", "item", "item_id", "tokens", "shift", "places", "first")
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [[]] * len(kinds), kinds, strict=True)], list(names))


def found_overlaps(rows: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``rows(digest, text)`` to ``(digest, hits)`` of what overlaps an item, a written table.

    One pass over the texts, however large the benchmark: what goes to the
    tasks is a bit array of at most 32 MB that tells which seeds are worth a
    row. Every window of an overlap holds an unharmed seed, so the windows
    around the seeds add up to all of it.
    """
    items = benchmark_items(benchmark)
    its = item_seeds(items)
    wanted = HashSet(its.select("h"), its.count())
    sizes = [r.n for r in items.select(F.least(F.size("toks"), F.lit(WINDOW)).alias("n")).distinct().collect()]
    masks = [m for m in EVERY if any(m in masks_of(n) for n in sizes)]
    mine = text_seeds(rows, masks, wanted)
    met = mine.join(its.withColumnRenamed("at", "its"), "h").join(items, "item")
    parts = met.select("digest", "item", "item_id", "low", "at", "its", "span", "near", "toks").mapInArrow(verified, "digest string, item bigint, item_id bigint, tokens int, shift int, places array<int>, first int")
    places = parts.select("digest", "item", "item_id", "tokens", "shift", "first", F.explode("places").alias("place"))
    places = places.groupBy("digest", "item", "item_id", "tokens", "shift", "place").agg(F.min("first").alias("first"))
    laid = places.groupBy("digest", "item", "item_id", "tokens", "shift").agg(F.count("*").cast("int").alias("matched"), F.min("first").alias("first"))
    best = laid.groupBy("digest", "item", "item_id", "tokens").agg(F.max(F.struct("matched", (-F.col("first")).alias("at"))).alias("x"))
    hit = F.struct("item_id", F.col("x.matched").alias("matched"), "tokens", (-F.col("x.at")).alias("at"))
    return cut(best.groupBy("digest").agg(F.array_sort(F.collect_list(hit)).alias("hits")), "overlaps")


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, digest, hits)`` of every row of ``docs``; hits is empty where it is clean.

    A document overlaps an item where 13 aligned tokens (a whole shorter item),
    at most a fifth of them substituted, are equal; hits are in order of item,
    then tokens matched. Null texts are empty and clean, and so are items
    without tokens; an item that repeats with its id counts once; repeated
    documents each get their row; an empty table gives none. Whole texts are
    scanned.
    """
    rows = docs.select("doc_id", F.sha2(text_of(), 256).alias("digest"), text_of().alias("text"))
    found = found_overlaps(rows.select("digest", "text"), benchmark)
    out = join_hot(rows.select("doc_id", "digest"), found, "digest", "left")
    return out.select("doc_id", "digest", F.coalesce("hits", F.array().cast(HITS)).alias("hits"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap no benchmark item, with all their columns, whatever their names.

    Null and empty texts stay; repeated rows stay or go together; ties and
    empty tables as in ``overlaps``.
    """
    digest = fresh(docs, "digest")
    rows = docs.withColumn(digest, F.sha2(text_of(), 256))
    bad = found_overlaps(rows.select(F.col(digest).alias("digest"), text_of().alias("text")), benchmark)
    return join_hot(rows, bad.select(F.col("digest").alias(digest)), digest, "left_anti").select(*docs.columns)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items that it overlaps; null texts are clean, repeated rows each get their row, equal items are listed each, an empty table gives no rows and an empty benchmark clean ones."""
    found = overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    share = F.array_max(F.transform("hits", lambda x: x["matched"] / x["tokens"]))
    return found.select("doc_id", (F.size("hits") > 0).alias("contaminated"), F.size("hits").cast("long").alias("n_items"), F.transform("hits", lambda x: x["item_id"]).alias("item_ids"), F.coalesce(share, F.lit(0.0)).alias("best_overlap"), F.transform("hits", lambda x: x["at"]).alias("at_tokens"))
