"""Quality classifier: regularised quadratic discriminant (operator 6)."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod5, cut, table, text_of

#: Share of a class's covariance that comes from both classes together, then of a scaled identity.
POOLED, RIDGE = 0.2, 0.02
#: Log-density differences are divided by this before they become a probability.
TEMPERATURE = 6.0
THRESHOLD = 0.3
#: Labels that the pipeline's stage learns from at most; 13 statistics need far fewer.
MOST_LABELS = 200_000

_LETTER_UP = np.zeros(256, bool)
_LETTER_UP[65:91] = True
_LETTER = _LETTER_UP.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STOPS = np.zeros(256, bool)
_STOPS[[33, 44, 46, 58, 59, 63]] = True
_SYMBOL = ~(_LETTER | _DIGIT | _SPACE | _STOPS)

FEATURES = ("length", "word_length", "upper", "digit", "symbol", "stop", "exclaim", "distinct", "repeat", "lines", "distinct_lines", "entropy", "letter_spread")


def statistics(text: str) -> list[float]:
    """Transformed statistics of one text: logs of sizes, roots of shares.

    All are finite; an empty text has them as well.
    """
    data = text.encode()
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size = max(1, len(data))
    words = data.lower().split()
    n = max(1, len(words))
    letters = max(1, int(counts[_LETTER].sum()))
    lines = data.split(b"\n")
    share = counts[counts > 0] / size
    entropy = float(-(share * np.log2(share)).sum()) if len(data) else 0.0
    spread = counts[_LETTER][counts[_LETTER] > 0] / letters
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    distinct = len(set(words))
    return [
        float(np.log1p(len(words))),
        float(np.log1p((size - int(counts[_SPACE].sum())) / n)),
        float(np.sqrt(counts[_LETTER_UP].sum() / letters)),
        float(np.sqrt(counts[_DIGIT].sum() / size)),
        float(np.sqrt(counts[_SYMBOL].sum() / size)),
        float(np.sqrt(counts[_STOPS].sum() / size)),
        float(np.sqrt(counts[33] / size)),
        # Herdan's C: hardly depends on length
        float(np.log1p(distinct) / np.log1p(n)) if words else 0.0,
        float(np.sqrt(same / n)),
        float(np.log1p(n / len(lines))),
        float(np.sqrt(len(set(lines)) / len(lines))),
        entropy,
        float(np.exp(-(spread * np.log(spread)).sum())) / 26 if len(spread) else 0.0,
    ]


def features(text: Column) -> Column:
    """Statistics of each whole text, by an Arrow UDF."""

    @F.arrow_udf("array<double>")
    def found(texts: pa.Array) -> pa.Array:
        flat = np.array([statistics(x.as_py()) for x in texts], float).reshape(-1)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, len(FEATURES)), pa.int32()), pa.array(flat))

    return found(text)


@dataclass
class Discriminant:
    """Class means and the inverse Cholesky factors of their shrunk covariances."""

    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    log_prior: float
    constant: float | None = field(default=None)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of ``x``."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        logs = []
        for c in (0, 1):
            z = (x - self.means[c]) @ self.factors[c].T
            logs.append(-0.5 * (z * z).sum(axis=1) - 0.5 * self.log_dets[c])
        margin = (logs[1] - logs[0] + self.log_prior) / TEMPERATURE
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))

    def udf(self):
        """Arrow UDF: an array of statistics to a score."""

        @F.arrow_udf("double")
        def score(rows: pa.Array) -> pa.Array:
            x = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
            return pa.array(self.score(x))

        return score


def fit(labelled: DataFrame) -> Discriminant:
    """A discriminant from rows ``(x: array<double>, y: 0 or 1)``, all of them.

    Spark sums the values and products by class and position, so only class
    counts, sums and products (a few hundred numbers) reach the driver. With
    rows of one class only, or none, the score is that class, or 0.5.
    """
    d = len(FEATURES)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    products = F.array(*[F.col("x")[i] for i in range(d)], *[F.col("x")[i] * F.col("x")[j] for i, j in pairs])
    rows = labelled.where("y in (0, 1)").select("y", F.posexplode(products).alias("k", "v"))
    sums = rows.groupBy("y", "k").agg(F.count("*").alias("n"), F.sum("v").alias("v")).collect()
    n, s = np.zeros(2), np.zeros((2, d + len(pairs)))
    for r in sums:
        n[r.y] = r.n
        s[r.y, r.k] = r.v
    if not n.all():
        return Discriminant(np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2), 0.0, 0.5 if not n.any() else float(n[1] > 0))
    means, scatter = s[:, :d] / n[:, None], np.zeros((2, d, d))
    for (i, j), v in zip(pairs, s[:, d:].T, strict=True):
        scatter[:, i, j] = scatter[:, j, i] = v - n * means[:, i] * means[:, j]
    pooled = scatter.sum(axis=0) / n.sum()
    scale = np.diag(np.diag(pooled) + 1e-9)
    factors, dets = [], []
    for c in (0, 1):
        own = (1 - POOLED) * scatter[c] / n[c] + POOLED * pooled
        low = np.linalg.cholesky((1 - RIDGE) * own + RIDGE * scale)
        factors.append(np.linalg.inv(low))
        dets.append(2 * np.log(np.diag(low)).sum())
    return Discriminant(means, np.array(factors), np.array(dets), float(np.log(n[1] / n[0])))


def train(known: DataFrame, labels: DataFrame) -> Discriminant:
    """Fit on the labelled ones of ``known(doc_id, held_out, x)`` outside the held-out fifth.

    Statistics join labels on doc_id, so that no text is shuffled. A null id
    has no label; repeated rows count as often as they stand there; null
    labels are left out.
    """
    rows = known.where("not held_out").select("doc_id", "x").join(labels.select("doc_id", F.col("quality").alias("y")), "doc_id")
    return fit(rows.select("y", "x"))


def measured(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, x)``: the statistics of every row, written down once."""
    return cut(docs.select("doc_id", (crc_mod5() == 0).alias("held_out"), features(text_of()).alias("x")), "quality")


def score_column(model: Discriminant, text: str = "text") -> Column:
    """Score of a text column, within the row: no join, any columns beside it."""
    return model.udf()(features(text_of(text)))


def labelled(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS) -> DataFrame:
    """``(doc_id, held_out, x)`` of the documents that a bounded sample of labels names, a written table.

    The sample has about ``most`` labels at most, in order of a hash, and goes
    to the documents: no text is shuffled, and only those that train are
    measured.
    """
    known = labels.where("quality in (0, 1)").select("doc_id").where("doc_id is not null").distinct()
    count = known.count()
    if count > most:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < 1_000_000 * most // count)
    return measured(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id", "left_semi"))


def reject_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score at least 0.3, with all their columns, whatever their names.

    Learns as ``op6_quality``, from MOST_LABELS labels at most. Null and empty
    texts score by their statistics; repeated rows stay or go together; without
    labels all stay; an empty table gives no rows.
    """
    model = train(labelled(docs, labels), labels)
    return docs.where(score_column(model) >= THRESHOLD)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: score and prediction for every document.

    Null and empty texts score by their statistics as any other. Equal texts
    score alike, repeated rows each get their row and teach as often as they
    stand there. An empty table gives no rows.
    """
    known = measured(table(spark, sf_dir, "documents"))
    model = train(known, table(spark, sf_dir, "labels"))
    scored = known.select("doc_id", "held_out", model.udf()("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
