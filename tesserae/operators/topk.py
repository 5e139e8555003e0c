"""Scoped, ranked and fairness-constrained search over vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


#: Rows of a batch, and queries, that are held against each other at once: what a task holds doesn't grow with the queries.
BLOCK, QUERIES = 2048, 512
#: Groups whose best scores a task remembers from block to block; of more groups, each block stands for itself.
MOST_GROUPS = 64
#: Rounding may make ties of what differs by less.
TIES = 2e-6


def scored(rows: DataFrame, queries: DataFrame, id_col: str, most_queries: int = 10_000, keep: int | None = None, floor: int | None = None, group: str = "label", margin: float = 0.0) -> DataFrame:
    """Rows against queries: ``(<queries but qvec>, <rows but embedding>, score)``, a row never against itself.

    ``queries(q, qvec, ...)`` is a stated set; it goes to the tasks in slices of
    ``most_queries`` rows, each a matrix that meets the rows block by block,
    ``QUERIES`` of them at a time.
    The score is a dot product in double precision, rounded so that ranks don't
    depend on summation order. With ``keep`` a task passes on just what may be
    among a query's best so many, or scores less than those by ``margin`` at
    most, with ``floor`` also what may be among the best so many of a
    ``group``; results stay exact.
    """
    count = queries.count()
    slices = max(1, -(-count // most_queries))
    kinds = {f.name: f for f in (*queries.schema.fields, *rows.schema.fields) if f.name not in ("qvec", "embedding")}
    schema = StructType([*kinds.values(), StructField("score", DoubleType())])
    parts = []
    for k in range(slices):
        asked = (queries if slices == 1 else queries.where(F.pmod(F.xxhash64("q"), F.lit(slices)) == k)).toArrow()
        if asked.num_rows:
            parts.append(rows.mapInArrow(_block_scores(asked, id_col, keep, floor, group, margin), schema))
    if not parts:
        return rows.sparkSession.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("score", F.round("score", 6))


class _Best:
    """The best ``n`` scores of each query so far."""

    def __init__(self, n: int, queries: int):
        self.n, self.seen = n, np.full((n, queries), -np.inf)

    def take(self, scores: np.ndarray, margin: float = 0.0) -> np.ndarray:
        """Which of ``scores`` may be among the best ``n`` of all, or within ``margin`` of them."""
        if not self.n:
            return np.zeros_like(scores, bool)
        both = np.concatenate([self.seen, scores])
        self.seen = np.partition(both, len(both) - self.n, axis=0)[len(both) - self.n :].copy()
        return scores >= self.seen[0] - margin - TIES


def _block_scores(asked: pa.Table, id_col: str, keep: int | None, floor: int | None, group: str, margin: float = 0.0):
    told = asked.drop_columns(["qvec"]).combine_chunks()
    vectors_asked = asked.column("qvec").combine_chunks()
    matrix = vectors_asked.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(asked.num_rows, -1)
    own = asked.column("q").to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, dict] = {first: {} for first in range(0, len(own), QUERIES)}  # of each slice of queries, by group

        def so_far(first: int, g: object, n: int, queries: int) -> _Best:
            known = best[first]
            if g in known:
                return known[g]
            new = _Best(n, queries)
            if len(known) <= MOST_GROUPS:
                known[g] = new
            return new

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                vectors = part.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(part.num_rows, -1)
                names = part.select([c for c in part.schema.names if c != "embedding"])
                ids = part.column(id_col).to_numpy()
                if floor is not None:
                    labels, inverse = np.unique(part.column(group).to_numpy(zero_copy_only=False), return_inverse=True)
                    members = np.split(np.argsort(inverse, kind="stable"), np.cumsum(np.bincount(inverse))[:-1])
                for first in range(0, len(own), QUERIES):
                    mine = slice(first, first + QUERIES)
                    scores = vectors @ matrix[mine].T
                    other = ids[:, None] != own[None, mine]
                    wanted = other
                    if keep is not None:
                        odd = np.isnan(scores)
                        ranked = np.where(other & ~odd, scores, -np.inf)
                        wanted = so_far(first, None, keep, scores.shape[1]).take(ranked, margin) | odd
                        if floor is not None:
                            for g, rows in zip(labels.tolist(), members, strict=True):
                                wanted[rows] |= so_far(first, (g,), floor, scores.shape[1]).take(ranked[rows])
                        wanted &= other
                    r, q = np.nonzero(wanted)
                    if not len(r):
                        continue
                    rest, mine_told = names.take(pa.array(r)), told.take(pa.array(q + first)).combine_chunks().to_batches()[0]
                    yield pa.RecordBatch.from_arrays([*mine_told.columns, *rest.columns, pa.array(scores[r, q])], [*told.schema.names, *rest.schema.names, "score"])

    return run


def top_k(hits: DataFrame, k: int, by: list[str], order: list[Column], rank: str = "rk") -> DataFrame:
    """The first ``k`` of each group; a single rank predicate lets Spark prune before the shuffle."""
    return hits.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= k)


def top_k_with_floor(hits: DataFrame, k: int, floor: int, group: str, id_col: str) -> DataFrame:
    """Global top ``k`` of each query together with the top ``floor`` of each group, each row once, ranked anew."""
    order = [F.col("score").desc(), F.col(id_col)]
    rank = F.row_number().over(Window.partitionBy("q").orderBy(*order))
    rows = hits.withColumn("rk", rank).withColumn("_rl", F.row_number().over(Window.partitionBy("q", group).orderBy(*order)))
    return rows.where((F.col("rk") <= k) | (F.col("_rl") <= floor)).drop("_rl").withColumn("rk", rank)


def within_margin(hits: DataFrame, k: int, least: float, margin: float, id_col: str) -> DataFrame:
    """Rows scoring at least ``least`` and within ``margin`` of the query's best, the first ``k`` of them."""
    best = hits.groupBy("q").agg(F.max("score").alias("best"))
    near = hits.where(F.col("score") >= least).join(best, "q").where(F.col("score") >= F.round(F.col("best") - margin, 6))
    return top_k(near, k, ["q"], [F.col("score").desc(), F.col(id_col)])


def clear_lead(hits: DataFrame, lead: float, id_col: str) -> DataFrame:
    """The best row of each query, only if it leads the second by ``lead``."""
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col(id_col))
    two = top_k(hits, 2, ["q"], [F.col("score").desc(), F.col(id_col)])
    two = two.withColumn("second", F.lead("score").over(order))
    return two.where((F.col("rk") == 1) & (F.col("second").isNull() | (F.round(F.col("score") - F.col("second"), 6) >= lead)))


def band_scores(ranks: DataFrame, mark: int, total: int) -> DataFrame:
    """List ranks to scores: those before the mark spread over (0.5, 1], those after over (0, 0.5)."""
    rk = F.col("rk")
    above = 1.0 - 0.5 * (rk - 1) / mark
    below = 0.5 * (total - rk + 1) / (total - mark + 1)
    return ranks.withColumn("band", F.round(F.when(rk <= mark, above).otherwise(below), 6))


def cascade_scores(ranks: DataFrame, finalists: int) -> DataFrame:
    """The first ``finalists`` map to [0.5, 1] by rank, the tail to (0, 0.5) by its rank."""
    n = F.count("*").over(Window.partitionBy("q"))
    rk = F.col("rk")
    top = F.when(F.lit(finalists) == 1, 1.0).otherwise(1.0 - 0.5 * (rk - 1) / F.greatest(F.lit(1), F.least(F.lit(finalists), n) - 1))
    tail = 0.5 * (n - rk + 1) / (n - finalists + 1)
    return ranks.withColumn("cascade", F.round(F.when(rk <= finalists, top).otherwise(tail), 6))


def retrieval_metrics(ranked: DataFrame, keys: list[str], at: tuple[int, ...] = (1, 3, 5, 10)) -> DataFrame:
    """hit@k, recall@k and mean reciprocal rank of ``ranked(q, rk, relevant, n_relevant)``, overall or by ``keys``."""
    per = ranked.groupBy("q", *keys).agg(
        F.min(F.when(F.col("relevant"), F.col("rk"))).alias("first"),
        *[F.sum(F.when(F.col("relevant") & (F.col("rk") <= k), 1).otherwise(0)).alias(f"n{k}") for k in at],
        F.max("n_relevant").alias("n_relevant"),
    )
    hit = [F.round(F.avg(F.when(F.col("first") <= k, 1.0).otherwise(0.0)), 6).alias(f"hit_{k}") for k in at]
    recall = [F.round(F.avg(F.col(f"n{k}") / F.col("n_relevant")), 6).alias(f"recall_{k}") for k in at]
    mrr = F.round(F.avg(F.coalesce(1.0 / F.col("first"), F.lit(0.0))), 6).alias("mrr")
    return per.groupBy(*keys).agg(F.count("*").alias("n_queries"), *hit, *recall, mrr)
