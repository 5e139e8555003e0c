"""Approximate nearest neighbours over trained codes, exact scores for the best of them, and a router between this and exact search."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import cut
from . import topk

#: Dimensions that one byte stands for, values of a byte, rows that training looks at, and its rounds.
WIDTH, CENTERS, SAMPLE, ROUNDS = 2, 256, 20_000, 12
#: Candidates for each wanted neighbour.
OVER = 4
#: A table of at most so many rows is searched exactly.
FEW_ROWS = 100_000


def vectors_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(column), -1)


@dataclass
class Codebook:
    """Centers of each group of dimensions; a vector's code names the nearest ones."""

    centers: list[np.ndarray]

    def encode(self, x: np.ndarray) -> np.ndarray:
        out, at = np.zeros((len(x), len(self.centers)), np.uint8), 0
        for j, c in enumerate(self.centers):
            part = x[:, at : at + c.shape[1]]
            out[:, j] = ((c**2).sum(axis=1) - 2 * part @ c.T).argmin(axis=1)
            at += c.shape[1]
        return out

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([c[codes[:, j]] for j, c in enumerate(self.centers)], axis=1)

    def codes(self, embedding: Column) -> Column:
        """Arrow UDF: an embedding to its code, as bytes."""

        @F.arrow_udf("binary")
        def code(rows: pa.Array) -> pa.Array:
            return pa.array([x.tobytes() for x in self.encode(vectors_of(rows))], pa.binary())

        return code(embedding)


def train(rows: DataFrame, id_col: str, sample: int = SAMPLE, width: int = WIDTH, centers: int = CENTERS, rounds: int = ROUNDS, seed: int = 3) -> Codebook:
    """A codebook from ``sample`` rows at most, those whose ids have the smallest hashes; each group of dimensions is clustered on its own."""
    found = rows.where("embedding is not null").orderBy(F.xxhash64(F.col(id_col))).limit(sample).select("embedding").toArrow()
    if not found.num_rows:
        return Codebook([])
    x = vectors_of(found.column("embedding").combine_chunks())
    rng, out = np.random.default_rng(seed), []
    for at in range(0, x.shape[1], width):
        part = x[:, at : at + width]
        c = part[rng.choice(len(part), min(centers, max(1, len(part) // 4)), replace=False)]
        for _ in range(rounds):
            near = ((c**2).sum(axis=1) - 2 * part @ c.T).argmin(axis=1)
            n = np.bincount(near, minlength=len(c))
            sums = np.stack([np.bincount(near, part[:, d], len(c)) for d in range(part.shape[1])], axis=1)
            c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c).astype(np.float32)
        out.append(c)
    return Codebook(out)


def build(rows: DataFrame, id_col: str, book: Codebook, group: str = "label") -> DataFrame:
    """The index ``(id, group, code)`` of every row with an embedding, written down: one byte for ``WIDTH`` dimensions."""
    return cut(rows.where("embedding is not null").select(id_col, group, book.codes(F.col("embedding")).alias("code")), "ann-codes")


def candidates(index: DataFrame, queries: DataFrame, id_col: str, book: Codebook, n: int, floor: int | None = None, group: str = "label", most_queries: int = 10_000) -> DataFrame:
    """``(q, id, group, rough)``: the best ``n`` rows of each query by their codes, with ``floor`` also the best so many of each group.

    Queries are a stated set and go to the tasks in slices, as in exact search;
    a batch passes on no more than may still be among the best.
    """
    kinds = f"{id_col} {index.schema[id_col].dataType.simpleString()}, {group} {index.schema[group].dataType.simpleString()}, embedding array<float>"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            x = book.decode(codes)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.reshape(-1), pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(id_col), batch.column(group), flat], [id_col, group, "embedding"])

    rough = topk.scored(index.mapInArrow(decode, kinds), queries.select("q", "qvec"), id_col, most_queries, keep=n, floor=floor, group=group)
    order = [F.col("score").desc(), F.col(id_col)]
    best = topk.top_k(rough, n, ["q"], order) if floor is None else topk.top_k_with_floor(rough, n, floor, group, id_col)
    return best.select("q", id_col, group, F.col("score").alias("rough"))


def exact_scores(found: DataFrame, rows: DataFrame, queries: DataFrame, id_col: str) -> DataFrame:
    """Candidates with the score that exact search gives; only their rows' embeddings are read and moved."""

    @F.arrow_udf("double")
    def dot(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y = (v.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(v), -1) for v in (a, b))
        return pa.array((x * y).sum(axis=1))

    both = found.join(rows.select(id_col, "embedding"), id_col).join(queries.select("q", "qvec"), "q")
    return both.withColumn("score", F.round(dot("embedding", "qvec"), 6)).drop("embedding", "qvec")


def search(rows: DataFrame, queries: DataFrame, id_col: str, k: int, over: int = OVER, floor: int | None = None, group: str = "label", book: Codebook | None = None, index: DataFrame | None = None) -> DataFrame:
    """``(q, id, group, score, rk)``: about the ``k`` nearest rows of each query, with ``floor`` also so many of each group.

    ``over`` times as many candidates come from the codes and are scored
    exactly. A row without an embedding is in no result.
    """
    book = book or train(rows, id_col)
    if not book.centers:
        return topk.top_k(topk.scored(rows, queries.select("q", "qvec"), id_col), k, ["q"], [F.col("score").desc()])
    index = index if index is not None else build(rows, id_col, book, group)
    found = candidates(index, queries, id_col, book, k * over, None if floor is None else floor * over, group)
    scored = exact_scores(cut(found, "ann-candidates"), rows, queries, id_col).select("q", id_col, group, "score")
    if floor is None:
        return topk.top_k(scored, k, ["q"], [F.col("score").desc(), F.col(id_col)])
    return topk.top_k_with_floor(scored, k, floor, group, id_col)


def routed(rows: DataFrame, queries: DataFrame, id_col: str, k: int, scope: list | None = None, group: str = "label", few: int = FEW_ROWS, **options) -> DataFrame:
    """Exact search for a scope, which must not miss a row, and for few rows; else ``search``; ``backend`` says which it was."""
    if scope is not None or rows.count() <= few:
        inside = rows if scope is None else rows.where(F.col(group).isin(*scope))
        floor = options.get("floor")
        hits = topk.scored(inside.select(id_col, group, "embedding"), queries.select("q", "qvec"), id_col, keep=k, floor=floor, group=group)
        best = topk.top_k(hits, k, ["q"], [F.col("score").desc(), F.col(id_col)]) if floor is None else topk.top_k_with_floor(hits, k, floor, group, id_col)
        return best.select("q", id_col, group, "score", "rk").withColumn("backend", F.lit("exact"))
    return search(rows, queries, id_col, k, group=group, **options).select("q", id_col, group, "score", "rk").withColumn("backend", F.lit("codes"))
