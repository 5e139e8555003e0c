"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import cut, new_path, path_exists, shared_dir

__all__ = ["WORD", "HashSet", "ascii_lower", "bounded_batches", "crc_mod5", "cut", "fresh", "join_hot", "let", "new_path", "path_exists", "shared_dir", "starts_of", "string_buffer", "table", "text_of", "text_slices"]

#: A word of the contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: A table of at most this many narrow rows is broadcast.
FEW = 100_000
#: A key with more than one row in so many is joined apart from the others.
HOT = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the corpus tables, read lazily."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text of a row; a null text is empty."""
    return F.coalesce(F.col(column), F.lit(""))


def crc_mod5(column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % 5


def ascii_lower(column: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body) -> Column:
    """``body(value)`` with value worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def starts_of(sizes: Column, step: int = 64) -> Column:
    """Running sums before each element, in two levels: long arrays stay cheap."""
    zero = F.lit(0).cast("long")

    def total(a: Column) -> Column:
        return F.aggregate(a, zero, lambda x, y: x + y)

    def with_sizes(s: Column) -> Column:
        count = F.greatest(F.lit(0), F.ceil(F.size(s) / step).cast("int") - 1)
        blocks = F.transform(F.sequence(F.lit(0), count), lambda b: total(F.slice(s, b * step + 1, step)))
        bases = let(blocks, lambda b: F.transform(b, lambda x, i: total(F.slice(b, 1, i))))
        return let(bases, lambda base: F.transform(s, lambda x, i: F.get(base, F.floor(i / step).cast("int")) + total(F.slice(s, F.floor(i / step).cast("int") * step + 1, i % step))))

    return let(sizes, with_sizes)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def join_hot(rows: DataFrame, found: DataFrame, key: str, how: str = "inner", few: int = FEW, most: int | None = None) -> DataFrame:
    """``rows`` joined with ``found``, which has one narrow row for each ``key``; how is inner, left or left_anti.

    Both are written tables, unless ``found`` is known to have at most ``most``
    rows and that is few. A small ``found`` is broadcast. Beyond that, keys
    with over a thousandth of all rows are fewer than a thousand: those are
    broadcast and their rows stay where they are, the others shuffle. So no
    task gets more than a thousandth of the rows by one key.
    """
    if (found.count() if most is None or most > few else most) <= few:
        return rows.join(F.broadcast(found), key, how)
    sizes = rows.groupBy(key).agg(F.count("*").alias("n"))
    total = rows.count()
    hot = cut(sizes.where(F.col("n") > total / HOT).select(key), "hot")
    apart = rows.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(found.join(F.broadcast(hot), key, "left_semi")), key, how)
    rest = rows.join(F.broadcast(hot), key, "left_anti").join(found.join(F.broadcast(hot), key, "left_anti"), key, how)
    return apart.unionByName(rest)


def string_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of an Arrow string array, from 0, and its UTF-8 bytes; a null text has none."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    _, offsets, data = texts.buffers()
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(offsets, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], whole[offsets[0] : offsets[-1]]


def text_slices(batch: pa.RecordBatch, column: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows with at most ``size`` bytes of text, or a single row that has more."""
    offsets, _ = string_buffer(batch.column(column))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1)
        yield batch.slice(low, high - low)
        low = high


def bounded_batches(spark: SparkSession, size: str = "4m") -> None:
    """Let Spark hand whole texts to Python in batches of about ``size``, not of ten thousand rows: both sides hold a batch at a time.

    This is a setting of the session, and it stays.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


class HashSet:
    """A set of 64-bit hashes as a bit array of bounded size; a test may err on the side of yes.

    Spark sets the bits by word, so that what reaches the driver follows the
    array's size, at most ``2 ** most`` bits, however many hashes there are.
    """

    def __init__(self, hashes: DataFrame, count: int, most: int = 28) -> None:
        self.bits = min(most, max(12, (32 * count).bit_length()))
        at = F.shiftrightunsigned(F.col(hashes.columns[0]), 64 - self.bits)
        words = hashes.select(at.alias("b")).groupBy(F.shiftright("b", 6).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("b") % 64).cast("int"))).alias("m")).toArrow()
        self.words = np.zeros(1 << (self.bits - 6), np.uint64)
        self.words[words.column("w").to_numpy()] = words.column("m").to_numpy().view(np.uint64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each of the unsigned hashes may be in the set."""
        at = hashes >> np.uint64(64 - self.bits)
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
