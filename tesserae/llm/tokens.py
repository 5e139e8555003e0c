"""Token counts with a digest cache (operator 10)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HashSet, cut, join_hot, new_path, path_exists, table, text_of

CACHE_SCHEMA = "digest string, n_bytes long, n_tokens long, tokenizer string"


class PieceCounter:
    """Counts the pieces that a sentencepiece model gives for whole texts."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def count(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, num_threads=1)]


class JsonCounter:
    """Counts the tokens of a ``tokenizers`` file, special strings as plain text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()

    def count(self, texts: list[str]) -> list[int]:
        return [len(x.ids) for x in self.model.encode_batch(texts, add_special_tokens=False)]


def load_counter(path: str) -> PieceCounter | JsonCounter:
    return PieceCounter(path) if path.endswith(".model") else JsonCounter(path)


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file, so that another file never shares counts."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def encode_missing(texts: DataFrame, tokenizer: str, version: str, cache_dir: str) -> None:
    """Append the counts of ``texts(digest, text)`` to the cache."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load_counter(tokenizer)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):  # ids of few texts at once
                part = batch.slice(k, 256)
                found = part.column("text").to_pylist()
                yield pa.RecordBatch.from_pydict({
                    "digest": part.column("digest"),
                    "n_bytes": pa.array([len(x.encode()) for x in found], pa.int64()),
                    "n_tokens": pa.array(counter.count(found), pa.int64()),
                })

    counts = texts.mapInArrow(encode, "digest string, n_bytes long, n_tokens long")
    counts.withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache_dir)


def in_set(held: HashSet):
    """Arrow UDF: whether a hash may be in the set."""

    @F.arrow_udf("boolean")
    def member(hashes: pa.Array) -> pa.Array:
        return pa.array(held.has(hashes.to_numpy(zero_copy_only=False).view(np.uint64)))

    return member


def count_tokens(docs: DataFrame, tokenizer: str, cache_dir: str, keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """Token counts of whole texts, encoding each distinct unseen text once.

    ``cache_dir`` holds counts by content digest, in a folder for each
    tokenizer digest. Digests alone meet the cache and are counted; texts whose
    digest occurs once are encoded where they stand, and only texts that repeat
    shuffle, with partial reduction before, so that each is encoded once. What
    tells them apart on the spot are bit arrays of bounded size, which may send
    a text the longer way or encode one that is cached, and change no count.
    The digest is over the exact UTF-8 bytes, for any folding could change a
    count. A null text counts as empty (0 tokens); repeated rows and ids each
    get their row; an empty table gives no rows; other columns play no part.
    The tokenizer's file has to exist at the same path on every machine.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer)
    rows = docs.select(*keys, F.sha2(text_of(text), 256).alias("digest"), text_of(text).alias("text"))

    def cached() -> DataFrame:
        known = spark.read.schema(CACHE_SCHEMA).parquet(cache_dir).where(F.col("tokenizer") == version)
        return known.groupBy("digest").agg(F.max("n_bytes").alias("n_bytes"), F.max("n_tokens").alias("n_tokens"))

    narrow = cut(rows.select(*keys, "digest"), "token-digests")
    times = cut(narrow.groupBy("digest").agg(F.count("*").alias("n")), "token-times")
    there = path_exists(spark, cache_dir)
    missing = cut(times.join(cached().select("digest"), "digest", "left_anti"), "token-misses") if there else times
    head = F.xxhash64("digest")
    texts, count = rows.select("digest", "text"), missing.count()
    if count < times.count():
        texts = texts.where(in_set(HashSet(missing.select(head.alias("h")), count))(head))
    repeats = missing.where("n > 1")
    again = in_set(HashSet(repeats.select(head.alias("h")), repeats.count()))(head)
    texts = texts.withColumn("again", again)
    once = texts.where("not again").select("digest", "text")
    encode_missing(once.unionByName(texts.where("again").groupBy("digest").agg(F.first("text").alias("text"))), tokenizer, version, cache_dir)
    return join_hot(narrow, cut(cached(), "token-counts"), "digest").select(*keys, "n_bytes", "n_tokens")


def op10_token_counts(spark: SparkSession, sf_dir: str, cache_dir: str | None = None, limit: int = 4096) -> DataFrame:
    """Contract query: tokens of every document by piece_bpe_32k.model.

    Null texts are empty; repeated rows each get their row; an empty table
    gives none. Pass ``cache_dir`` to keep counts from one run to the next.
    """
    import public_tokenizers

    counts = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), cache_dir or new_path(spark, "token-cache"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
