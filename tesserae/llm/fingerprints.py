"""Document fingerprints from prefix polynomial hashes (operator 8)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_of

PRIME = np.uint64((1 << 31) - 1)
BASES = (0x2F0B4C47, 0x51ED270B)
#: Code points of the spans in a sketch, and how many of the smallest span hashes it keeps.
SPAN, KEPT = 16, 32
#: Texts under SHORT code points have spans of NARROW instead; those under LONG have both, to be comparable with either.
NARROW, SHORT, LONG = 4, 64, 256
#: Characters of text that a range of documents aims at, and how many ranges there may be (their first rows are broadcast).
RANGE_CHARS, MOST_RANGES = 12_000_000, 200_000
#: Rows that decide where ranges end: so many for each range, at most so many together.
SAMPLE, MOST_SAMPLED = 200, 2_000_000

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to 0, 1, ... ``n`` - 1 modulo the prime; kept, and doubled as needed."""
    have = _powers.get(base)
    if have is None:
        have = np.ones(1, np.uint64)
    while len(have) < n:
        step = pow(base, len(have), int(PRIME))
        have = np.concatenate([have, have * np.uint64(step) % PRIME])
    _powers[base] = have
    return have[:n]


class PrefixHash:
    """Prefix hashes of one text: any span's hash in constant time.

    ``at[i]`` sums code point times power over the first i places, modulo the
    prime; a span's hash is a difference times an inverse power, so equal
    spans agree wherever they stand.
    """

    INVERSE = pow(BASES[0], -1, int(PRIME))

    def __init__(self, text: str) -> None:
        self.text = text
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        terms = codes * powers(BASES[0], self.n) % PRIME
        self.at = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms) % PRIME])
        self.second = int((codes * powers(BASES[1], self.n) % PRIME).sum() % PRIME) if self.n else 0

    def spans(self, width: int) -> np.ndarray:
        """Hashes of all spans of ``width`` code points, in order."""
        low = self.at[: self.n - width + 1]
        return (self.at[width:] + PRIME - low) % PRIME * powers(self.INVERSE, len(low)) % PRIME

    def span(self, start: int, stop: int) -> int:
        """Hash of one span."""
        return int((self.at[stop] + PRIME - self.at[start]) % PRIME * powers(self.INVERSE, start + 1)[start] % PRIME)

    def common_extension(self, other: PrefixHash, mine: int = 0, its: int = 0) -> int:
        """How many code points agree from ``mine`` here and ``its`` there, by binary search.

        Hashes may agree by chance, so the texts are held against each other at
        the end; where they differ after all, the search goes on below.
        """
        high = min(self.n - mine, other.n - its)
        while True:
            low = 0
            while low < high:
                mid = (low + high + 1) // 2
                if self.span(mine, mine + mid) == other.span(its, its + mid):
                    low = mid
                else:
                    high = mid - 1
            if self.text[mine : mine + low] == other.text[its : its + low]:
                return low
            high = low - 1

    def sketch(self, width: int) -> np.ndarray:
        """The smallest distinct hashes of spans of ``width``, sorted; a shorter text is one span."""
        if not self.n:
            return np.empty(0, np.uint64)
        h = self.spans(min(width, self.n))
        if len(h) > 8 * KEPT:
            few = np.unique(np.partition(h, 8 * KEPT)[: 8 * KEPT])
            if len(few) >= KEPT:
                return few[:KEPT]
        return np.unique(h)[:KEPT]

    def fingerprint(self) -> str:
        """Two hashes of the whole text, then its sketches of wide and of narrow spans, in hexadecimal."""
        whole = f"{int(self.at[-1]):08x}{self.second:08x}"
        wide = self.sketch(SPAN) if self.n >= SHORT else np.empty(0, np.uint64)
        narrow = self.sketch(NARROW) if self.n < LONG else np.empty(0, np.uint64)
        return ":".join([whole, *(x.astype(">u4").tobytes().hex() for x in (wide, narrow))])


def likeness(a: str, b: str) -> float:
    """Share of spans that two fingerprints have in common, 0 to 1.

    The sketches estimate the Jaccard index j of the span sets; 2j / (1 + j)
    is the share of spans in common, which is one half if half a text is new.
    Spans are wide ones where both texts have them, else narrow ones; a text
    under SHORT code points and one of LONG or more have nothing in common.
    """
    if a == b:
        return 1.0
    for one, two in zip(a.split(":")[1:], b.split(":")[1:], strict=True):
        if one and two:
            one, two = ({x[k : k + 8] for k in range(0, len(x), 8)} for x in (one, two))
            least = sorted(one | two)[: KEPT if max(len(one), len(two)) == KEPT else None]
            j = sum(x in one and x in two for x in least) / len(least)
            return 2 * j / (1 + j)
    return 0.0


def edit(text: str, following: str) -> str:
    """``text`` with its last half replaced by the first code points of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


SCHEMA = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, lce_edited bigint, lce_next bigint"


class Ranges:
    """Bounds of ranges in descending order of id, then hash; rows without an id come last."""

    def __init__(self, known: list[tuple[int, int]], unknown: list[int]) -> None:
        known = sorted(set(known))
        self.ids, self.ties = (np.array(x, np.int64) for x in (zip(*known, strict=True) if known else ((), ())))
        self.unknown = np.array(sorted(set(unknown)), np.int64)
        self.count = len(self.ids) + len(self.unknown) + 2

    def of(self, missing: np.ndarray, ids: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Range of each row: how many bounds stand before it."""
        low, high = np.searchsorted(self.ids, ids, "left"), np.searchsorted(self.ids, ids, "right")
        upto = low.copy()
        for k in np.unique(low[high > low]):  # ids that bounds have: their hashes decide
            mine = np.flatnonzero((low == k) & (high > low))
            upto[mine] += np.searchsorted(self.ties[k : high[mine[0]]], ties[mine], "right")
        found = len(self.ids) - upto
        late = len(self.ids) + 1 + len(self.unknown) - np.searchsorted(self.unknown, ties, "right")
        return np.where(missing, late, found).astype(np.int32)


def ranges_of(rows: DataFrame) -> Ranges:
    """Ranges of about RANGE_CHARS characters, from a sample of bounded size; it decides no result, only where a row is worked on."""
    chars, n = rows.agg(F.sum(F.length("text")), F.count("*")).first()
    count = min(MOST_RANGES, max(1, (chars or 0) // RANGE_CHARS))
    if count == 1:
        return Ranges([], [])
    part = rows.select("doc_id", "tie", F.length("text").alias("n"))
    share = min(SAMPLE * count, MOST_SAMPLED) / n
    keys = (part.sample(share, 1) if share < 1 else part).toArrow()
    missing = keys.column("doc_id").is_null().to_numpy()
    ids, ties, sizes = keys.column("doc_id").fill_null(0).to_numpy(), keys.column("tie").to_numpy(), keys.column("n").to_numpy()
    order = np.lexsort((~ties, ~ids, missing))
    run = np.cumsum(sizes[order], dtype=np.float64)
    cuts = order[np.searchsorted(run, run[-1] * np.arange(1, count) / count)] if len(run) else []
    return Ranges([(int(ids[k]), int(ties[k])) for k in cuts if not missing[k]], [int(ties[k]) for k in cuts if missing[k]])


def in_order(docs: DataFrame) -> DataFrame:
    """Rows dealt into ranges of descending doc_id, then hash of the text: ``(bucket, ghost, doc_id, tie, text)``.

    A range's bucket is a pure function of both, so that rows of one id, or
    without any, part into as many ranges as their texts fill; only rows that
    repeat with id and text stay together. The first row of each range goes to
    the range before it as well, as a ghost behind its last row (the very first
    behind the very last), so that each row's next one is at hand with one
    shuffle and no task sees all rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn("tie", F.xxhash64("text"))
    ranges = ranges_of(rows)

    @F.arrow_udf("int")
    def bucket(ids: pa.Array, ties: pa.Array) -> pa.Array:
        return pa.array(ranges.of(ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False), ties.to_numpy(zero_copy_only=False)))

    rows = rows.withColumn("bucket", bucket("doc_id", "tie"))
    heads = rows.groupBy("bucket").agg(F.max(F.struct("doc_id", "tie")).alias("head")).collect()
    heads = sorted(heads, key=lambda r: r.bucket)
    spark = docs.sparkSession
    told = [(r.head.doc_id, r.head.tie, heads[k - 1].bucket) for k, r in enumerate(heads)]
    told = spark.createDataFrame(told, "id bigint, its_tie bigint, before int")
    # one row a range: at most MOST_RANGES
    ghosts = rows.join(F.broadcast(told), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tie") == F.col("its_tie")))
    ghosts = ghosts.select(F.col("before").alias("bucket"), F.lit(1).alias("ghost"), "doc_id", "tie", "text")
    rows = rows.select("bucket", F.lit(0).alias("ghost"), "doc_id", "tie", "text").unionByName(ghosts)
    order = ["bucket", "ghost", F.col("doc_id").desc_nulls_last(), F.col("tie").desc()]
    # neighbouring ranges share a task where there are more ranges than tasks
    tasks = min(ranges.count, 20_000)
    return rows.repartitionById(tasks, F.floor(F.col("bucket") * tasks / ranges.count).cast("int")).sortWithinPartitions(*order)


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each whole text and of its edited text (see SCHEMA).

    The edited text replaces the last half by the beginning of the next
    document in descending doc_id; rows with one id follow each other by a
    hash of their text, rows without an id come last, the first row follows
    the last. A row alone is its own next. lce_ columns count the code points
    that agree from the start. Null texts are empty; an empty table gives no
    rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before, awaiting its next one
        skip = None
        out: list[tuple] = []
        for batch in batches:
            for bucket, ghost, doc_id, text in zip(*(batch.column(c) for c in ("bucket", "ghost", "doc_id", "text")), strict=True):
                bucket, ghost = bucket.as_py(), ghost.as_py()
                if ghost and skip == bucket:
                    continue  # rows that repeat the head
                mine = PrefixHash(text.as_py())
                sign = mine.fingerprint()
                if held is not None:
                    before, its_sign, its_id = held
                    edited = PrefixHash(edit(before.text, mine.text))
                    its_edit = edited.fingerprint()
                    digest = hashlib.sha256(edited.text.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((its_id, before.n, digest, its_sign, its_edit, likeness(its_sign, its_edit), likeness(its_sign, sign), before.common_extension(edited), before.common_extension(mine)))
                held = None if ghost else (mine, sign, doc_id.as_py())
                skip = bucket if ghost else None
                if len(out) >= 512:
                    yield packed(out)
                    out = []
        yield packed(out)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        kinds = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[x.split()[1]]) for c, x in zip(columns, SCHEMA.split(", "), strict=True)], names)

    return in_order(docs).mapInArrow(run, SCHEMA)


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: fingerprints of all documents and their edited texts.

    Null texts are empty; rows that repeat follow each other and each get their
    row; an empty table gives none.
    """
    return fingerprint_edits(table(spark, sf_dir, "documents"))
