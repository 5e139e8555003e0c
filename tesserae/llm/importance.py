"""Importance resampling towards a target's distribution of hashed word runs (operator 12)."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, string_buffer, table, text_slices

BUCKETS = 10_000
#: Runs of one to so many words are features.
LONGEST_RUN = 3
LEAST_WORDS = 20
SEED = 42
#: Of the documents with enough words, so many in a hundred are drawn.
PERCENT = 5
#: Starts whose codes advance together; bytes of a word that they advance side by side, before a longer word goes on alone.
BLOCK, STEPS = 200_000, 64
#: Documents that one task ranks.
RANKED = 2_000_000

#: The lower-cased byte for a byte of a word (digits, letters, anything beyond ASCII), else 0.
WORD_BYTE = np.zeros(256, np.uint8)
for _low, _high, _shift in ((0x30, 0x39, 0), (0x41, 0x5A, 32), (0x61, 0x7A, 0), (0x80, 0xFF, 0)):
    WORD_BYTE[_low : _high + 1] = np.arange(_low, _high + 1) + _shift
#: crc32 of each single byte, as the automaton's transition table.
CRC = np.array([zlib.crc32(bytes([x])) ^ zlib.crc32(b"\0") for x in range(256)], np.uint32)
ONES = np.uint32(0xFFFFFFFF)


def find_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of an Arrow string array, the words' starts and sizes, and each text's first word (one more at the end).

    A null text has no words.
    """
    offsets, data = string_buffer(texts)
    kind = WORD_BYTE[data]
    held = kind != 0
    begins, stops = held.copy(), held.copy()
    begins[1:] &= ~held[:-1]
    stops[:-1] &= ~held[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]  # a word ends with its text
    begins[edges] = held[edges]
    stops[edges - 1] = held[edges - 1]
    starts = np.flatnonzero(begins)
    return kind, starts, np.flatnonzero(stops) + 1 - starts, np.searchsorted(starts, offsets)


def advance(state: np.ndarray, data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC states after the bytes ``data[at : at + size]``, one byte of all of them at a time."""
    order = np.argsort(np.minimum(size, STEPS + 1).astype(np.uint8), kind="stable")[::-1]  # the longest first: those that go on lie together
    state, at, size = state[order], at[order], size[order]
    longer = np.searchsorted(-size, -np.arange(STEPS + 1) - 0.5) if len(size) else [0]
    for k, m in enumerate(longer[:STEPS]):
        if not m:
            break
        state[:m] = CRC[(state[:m] ^ data[at[:m] + k]) & np.uint32(255)] ^ (state[:m] >> np.uint32(8))
    for j in range(longer[-1] if len(size) else 0):
        state[j] = np.uint32(zlib.crc32(data[at[j] + STEPS : at[j] + size[j]].tobytes(), int(state[j] ^ ONES))) ^ ONES
    back = np.empty_like(state)
    back[order] = state
    return back


def run_buckets(texts: pa.Array, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The text and the bucket of every run of words, in blocks of starts."""
    data, starts, sizes, first = find_words(texts)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    last = first[owner + 1]
    for low in range(0, len(starts), BLOCK):
        word = np.arange(low, min(low + BLOCK, len(starts)))
        state = np.full(len(word), ONES)
        for n in range(LONGEST_RUN):
            if n:
                on = word + n < last[word]
                word, state = word[on], state[on]
                state = CRC[(state ^ np.uint32(32)) & np.uint32(255)] ^ (state >> np.uint32(8))
            state = advance(state, data, starts[word + n], sizes[word + n])
            yield owner[word], (state ^ ONES) % np.uint32(buckets)


def bucket_counts(rows: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket is met in all rows' texts; each task hands on one row a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in text_slices(batch, "text"):
                for _, found in run_buckets(part.column("text"), buckets):
                    met += np.bincount(found, minlength=buckets)
        there = np.flatnonzero(met)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(there, pa.int64()), "n": pa.array(met[there], pa.int64())})

    found = rows.select(F.col(text).alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares in target and source, rounded down."""
    s_all, t_all, k = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + k) / ((s + 1.0) * (t_all + k)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, n_features, weight)`` of every row: the gains of its runs, summed."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worth = gain.astype(float)
        for batch in batches:
            for part in text_slices(batch, "text"):
                total, n_features = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
                n_words = None
                for k, (owner, found) in enumerate(run_buckets(part.column("text"), len(gain))):
                    here = np.bincount(owner, minlength=part.num_rows)
                    total += np.bincount(owner, worth[found], part.num_rows).astype(np.int64)
                    n_features += here
                    if k % LONGEST_RUN == 0:
                        n_words = here if n_words is None else n_words + here
                n_words = np.zeros(part.num_rows, np.int64) if n_words is None else n_words
                yield pa.RecordBatch.from_arrays([part.column(key), *(pa.array(x, pa.int64()) for x in (n_words, n_features, total))], [key, "n_words", "n_features", "weight"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).alias("text")).mapInArrow(sums, f"`{key}` {kind}, n_words long, n_features long, weight long")


def noise(key: Column, seed: int = SEED) -> Column:
    """A Gumbel variate in thousandths, rounded down, that only the id and the seed decide."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, key: str = "doc_id", ranked: int = RANKED) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... for the highest scores among rows with enough words, else null.

    Scores are dealt out by ranges; the sizes of the ranges say where each one's
    ranks start, so no task ranks more than its range.
    """
    fit = scored.where(F.col("n_words") >= least_words)
    n = fit.count()
    take, parts = percent * n // 100, max(1, -(-n // ranked))
    order = [F.col("score").desc(), F.col(key).asc_nulls_last()]
    dealt = cut(fit.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "resample-ranges")
    start, starts = 0, []
    for r in dealt.groupBy("part").count().orderBy("part").collect():
        starts.append((r.part, start))
        start += r["count"]
    before = F.create_map(*(F.lit(x) for pair in starts for x in pair))[F.col("part")] if starts else F.lit(0)
    met = [p for p, s in starts if s < take]
    rank = before + F.row_number().over(Window.partitionBy("part").orderBy(*order))
    top = dealt.where(F.col("part").isin(met)).withColumn("rank", rank.cast("long"))
    top = top.withColumn("rank", F.when(F.col("rank") <= take, F.col("rank")))
    rest = dealt.where(~F.col("part").isin(met)).drop("part").unionByName(scored.where(F.col("n_words") < least_words))
    return top.drop("part").unionByName(rest.withColumn("rank", F.lit(None).cast("long")))


def importance(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``(key, n_words, n_features, weight, score)`` of every row of ``docs``, written down.

    A null or empty text has no words: no features, weight 0, noise alone.
    Without target texts the gains follow the source's own counts. Repeated
    rows each get their row, equal ids the same noise; an empty table gives no
    rows; other columns play no part.
    """
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    return cut(weigh(docs, gain, key, text).withColumn("score", F.col("weight") + noise(F.col(key), seed)), "resample-scores")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is drawn, with all their columns; rows that share a drawn id all stay."""
    drawn = draw(importance(docs, target, key), percent, least_words, key).where("rank is not null").select(F.col(key).alias("drawn_id")).distinct()
    return docs.join(drawn, docs[key].eqNullSafe(drawn["drawn_id"]), "left_semi")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every document's weight towards ``benchmark``, its score and its rank if drawn.

    Null and empty texts weigh 0 and are never drawn; ties go to the smaller
    id; repeated rows each get their row and a rank of their own; an empty
    table gives no rows.
    """
    return draw(importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))).select("doc_id", "n_features", "weight", "score", "rank")
