"""Language-model scores by prediction by partial matching (operator 2).

The model is a trie of byte contexts up to ``ORDER`` bytes, learned from the
training texts. What a context predicts follows escape method D with symbol
exclusion; as the learned model is fixed, a symbol's probability depends on
its window of ``ORDER`` + 1 symbols alone, so it is worked out once for each
distinct window. Neither the trie nor the word counts are held in one place:
texts lie in buckets of a bounded size, a bucket sends its distinct windows
and words to the tasks that own them, and gets back what it asked for.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod5, cut, table, text_of

#: Bytes of the longest context.
ORDER = 5
#: Symbols: bytes, then the end of a text; PAD stands before its start.
END, PAD, WIDTH = 256, 257, 9
SYMBOL, TRIPLE = (1 << WIDTH) - 1, (1 << 3 * WIDTH) - 1
#: Bytes of text that a bucket aims at, and symbols handled at once within it.
BUCKET_BYTES, CHUNK = 24_000_000, 2_000_000
#: Buckets to one owner of words and windows, and how many owners there may be: distinct windows grow far slower than texts.
OWNED, MOST_OWNERS = 3, 4096
#: Windows that an owner unpacks before it adds them up.
UNPACKED = 6_000_000

KEYS = "bucket long, owner long, kind string, n long, keys binary, counts binary"
VALUES = "bucket long, owner long, kind string, vals binary, tokens long, distinct_words long"


def pack(a: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(a).tobytes(), 1)


def unpack(b: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zlib.decompress(b), kind)


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=0))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b, np.int64))


def words(data: bytes) -> list[bytes]:
    """Words of a text's lower-cased bytes: runs of anything but ASCII white space."""
    return data.split()


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A window for each byte and each end of ``texts``, and where each text's begin.

    A window holds ORDER symbols of context and the symbol itself, 9 bits each.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate([[0], np.cumsum(sizes + 1 + ORDER)])
    symbols = np.full(begins[-1], PAD, np.int64)
    flat = np.frombuffer(b"".join(texts), np.uint8)
    at = np.arange(len(flat)) + np.repeat(ORDER + (1 + ORDER) * np.arange(len(texts)), sizes)
    symbols[at] = flat
    symbols[begins[1:] - 1] = END
    out = np.zeros(max(0, len(symbols) - ORDER), np.int64)
    for k in range(ORDER + 1):
        out <<= WIDTH
        out |= symbols[k : k + len(out)]
    keep = np.ones(len(out), bool)
    for k in range(ORDER):  # windows whose symbol is padding
        keep[begins[1:-1] + k - ORDER] = False
    return out[keep], np.concatenate([[0], np.cumsum(sizes + 1)])


def chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK symbols each."""
    start = total = 0
    for k, x in enumerate(texts):
        total += len(x) + 1
        if total >= CHUNK:
            yield start, k + 1
            start, total = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of several lists, and their summed counts."""
    keys = np.concatenate([k for k, _ in parts])
    found, place = np.unique(keys, return_inverse=True)
    return found, np.bincount(place, np.concatenate([n for _, n in parts]), len(found)).astype(np.int64)


def gather(owners: int):
    """Per bucket: its distinct words and windows, split by owner, with training counts."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        texts = [x.as_py().encode().lower() for x in group.column("text")]
        train = group.column("train").to_numpy().astype(bool)
        count: Counter = Counter()
        rest: set[bytes] = set()
        for x, t in zip(texts, train, strict=True):
            if t:
                count.update(words(x))
            else:
                rest.update(words(x))
        for w in rest:
            count.setdefault(w, 0)
        lists: list[list[bytes]] = [[] for _ in range(owners)]
        for w in count:
            lists[zlib.crc32(w) % owners].append(w)
        rows = []
        for k, own in enumerate(lists):
            own.sort()
            if own:
                rows.append((k, "word", len(own), zlib.compress(b" ".join(own), 1), pack(np.fromiter(map(count.__getitem__, own), np.int64, len(own)))))
        del count, rest, lists
        parts = []
        for a, b in chunks(texts):
            w, begins = windows(texts[a:b])
            u, place = np.unique(w, return_inverse=True)
            parts.append((u, np.bincount(place, np.repeat(train[a:b], np.diff(begins)), len(u)).astype(np.int64)))
        u, n = merged(parts)
        owner = suffix(u) % owners
        order = np.argsort(owner, kind="stable")
        stops = np.searchsorted(owner[order], np.arange(owners + 1))
        for k in np.flatnonzero(np.diff(stops)).tolist():
            mine = order[stops[k] : stops[k + 1]]
            rows.append((k, "gram", len(mine), pack_sorted(u[mine]), pack(n[mine])))
        low, n = merged([(u[n > 0] & TRIPLE, n[n > 0])])
        rows.append((0, "low", len(low), pack_sorted(low), pack(n)))
        owner, kind, n, keys, counts = zip(*rows, strict=True)
        return pa.table({"bucket": pa.array([bucket] * len(rows), pa.int64()), "owner": pa.array(owner, pa.int64()), "kind": pa.array(kind), "n": pa.array(n, pa.int64()), "keys": pa.array(keys, pa.binary()), "counts": pa.array(counts, pa.binary())})

    return run


def suffix(w: np.ndarray) -> np.ndarray:
    """A number for the three symbols before the last, by which windows have their owner."""
    return ((((w >> WIDTH) & TRIPLE) * 0x9E3779B1) & 0xFFFFFFFF) >> 5


class LowOrders:
    """Training counts of symbols after two symbols, one and none.

    Takes distinct, sorted triples of symbols that occur: at most 258 * 258 *
    257 by the alphabet, and in texts some hundred thousand.
    """

    def __init__(self, triples: np.ndarray, n: np.ndarray) -> None:
        self.triples, self.n = triples, n
        before, symbol = (triples >> WIDTH) & SYMBOL, triples & SYMBOL
        self.after = np.zeros((PAD + 1, END + 1), np.int64)
        np.add.at(self.after, (before, symbol), n)
        self.alone = self.after.sum(axis=0)
        self.contexts, at = np.unique(triples >> WIDTH, return_inverse=True)
        self.total, self.distinct = np.bincount(at, n).astype(np.int64), np.bincount(at)
        # counts after one symbol of what each context of two has seen
        self.below = np.bincount(at, self.after[before, symbol]).astype(np.int64)

    def count(self, triples: np.ndarray) -> np.ndarray:
        """How often each triple occurs."""
        if not len(self.triples):
            return np.zeros(len(triples), np.int64)
        at = np.minimum(np.searchsorted(self.triples, triples), len(self.triples) - 1)
        return np.where(self.triples[at] == triples, self.n[at], 0)

    def context(self, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sum of counts, distinct symbols and counts one level down of contexts of two symbols."""
        if not len(self.contexts):
            return (np.zeros(len(two), np.int64),) * 3
        at = np.minimum(np.searchsorted(self.contexts, two), len(self.contexts) - 1)
        there = self.contexts[at] == two
        return tuple(np.where(there, x[at], 0) for x in (self.total, self.distinct, self.below))


def log_probabilities(w: np.ndarray, n: np.ndarray, low: LowOrders) -> np.ndarray:
    """log10 probability of the last symbol of each window.

    ``w`` is sorted, distinct and complete for its contexts of three symbols.
    From the longest context down: of twice the counts of a context, a symbol
    seen there has twice its count less one, and each distinct symbol leaves
    one to the escape. Below, symbols that a longer context has seen
    are left out of the sums. What no context has seen shares the last escape
    evenly. A context that training lacks costs nothing.
    """
    escape = np.ones(len(w))
    out = np.zeros(len(w))
    open_ = np.ones(len(w), bool)
    above = None  # (sum of counts to leave out, distinct symbols to leave out) for each row
    levels = []
    for k in range(ORDER, 2, -1):
        keys, row = np.unique(w & ((1 << WIDTH * (k + 1)) - 1), return_inverse=True)
        c = np.bincount(row, n, len(keys))
        ctx, at = np.unique(keys >> WIDTH, return_inverse=True)
        levels.append((keys, row, c, at, np.bincount(at, c, len(ctx)), np.bincount(at, c > 0, len(ctx))))
    symbol, before = w & SYMBOL, (w >> WIDTH) & SYMBOL
    for i, k in enumerate(range(ORDER, -1, -1)):
        if k > 2:
            keys, row, c, at, total, distinct = levels[i]
            mine, t, q = c[row], total[at[row]], distinct[at[row]]
        elif k == 2:
            mine, (t, q, below) = low.count(w & TRIPLE), low.context((w >> WIDTH) & ((1 << 2 * WIDTH) - 1))
        elif k == 1:
            mine, t, q = low.after[before, symbol], low.after.sum(axis=1)[before], (low.after > 0).sum(axis=1)[before]
        else:
            mine, t, q = low.alone[symbol], np.full(len(w), low.alone.sum()), np.full(len(w), (low.alone > 0).sum())
        x, xq = above if above is not None else (0, 0)
        total_left, distinct_left = t - x, q - xq
        base = np.maximum(2 * total_left, 1)
        seen = open_ & (mine > 0)
        out[seen] = np.log10(escape[seen] * (2 * mine[seen] - 1) / base[seen])
        open_ &= ~seen
        goes = open_ & (total_left > 0)
        escape[goes] *= distinct_left[goes] / base[goes]
        # what this level has seen, counted one level down
        if k > 2:
            if k > 3:
                nk, _, nc = levels[i + 1][:3]
                fewer = nc[np.searchsorted(nk, keys & ((1 << WIDTH * k) - 1))]
            else:
                fewer = low.count(keys & TRIPLE)
            above = np.bincount(at, fewer * (c > 0), len(total))[at[row]], q
        elif k == 2:
            above = below, q
        elif k == 1:
            above = ((low.after > 0) * low.alone).sum(axis=1)[before], q
    left = END + 1 - (low.alone > 0).sum()
    out[open_] = np.log10(np.maximum(escape[open_], 1e-300) / max(1, left))
    return out


def answer(low: LowOrders):
    """Per owner and kind: total counts of words, or probabilities of windows, for each bucket that asked.

    Windows are unpacked and added up some at a time, then unpacked once more
    to answer, so that memory follows the owner's distinct windows.
    """

    def run(key: tuple, group: pa.Table) -> pa.Table:
        kind = key[1].as_py()
        buckets = group.column("bucket").to_pylist()
        tokens = known = 0
        if kind == "word":
            counts = [unpack(x.as_py(), np.int64) for x in group.column("counts")]
            place: dict[bytes, int] = {}
            lists = []
            for x in group.column("keys"):
                own = zlib.decompress(x.as_py()).split(b" ")
                lists.append(np.fromiter((place.setdefault(w, len(place)) for w in own), np.int64, len(own)))
            total = np.bincount(np.concatenate(lists), np.concatenate(counts), len(place)).astype(np.int64)
            vals = [pack(total[x]) for x in lists]
            tokens, known = int(total.sum()), int((total > 0).sum())
        else:
            parts, size = [], 0
            for x, c in zip(group.column("keys"), group.column("counts"), strict=True):
                parts.append((unpack_sorted(x.as_py()), unpack(c.as_py(), np.int64)))
                size += len(parts[-1][0])
                if size > UNPACKED:
                    parts = [merged(parts)]
                    size = len(parts[0][0]) // 2
            w, n = merged(parts)
            del parts
            logs = log_probabilities(w, n, low)
            vals = [logs[np.searchsorted(w, unpack_sorted(x.as_py()))].tobytes() for x in group.column("keys")]
        rest = [0] * (len(vals) - 1)  # an owner's totals stand once, beside its first answer
        return pa.table({"bucket": pa.array(buckets, pa.int64()), "owner": pa.array([key[0].as_py()] * len(vals), pa.int64()), "kind": pa.array([kind] * len(vals)), "vals": pa.array(vals, pa.binary()), "tokens": pa.array([tokens, *rest], pa.int64()), "distinct_words": pa.array([known, *rest], pa.int64())})

    return run


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_texts(train_tokens: int, train_words: int, train_texts: int):
    """Per bucket: scores of its texts from the answers to what it asked."""

    def run(key: tuple, texts: pa.Table, told: pa.Table) -> pa.Table:
        count: dict[bytes, int] = {}
        grams, logs = [], []
        for kind, keys, vals in zip(told.column("kind").to_pylist(), told.column("keys"), told.column("vals"), strict=True):
            if kind == "word":
                count.update(zip(zlib.decompress(keys.as_py()).split(b" "), unpack(vals.as_py(), np.int64).tolist(), strict=True))
            else:
                grams.append(unpack_sorted(keys.as_py()))
                logs.append(np.frombuffer(vals.as_py(), np.float64))
        grams, logs = np.concatenate(grams), np.concatenate(logs)
        order = np.argsort(grams)
        grams, logs = grams[order], logs[order]
        data = [x.as_py().encode().lower() for x in texts.column("text")]
        unit = train_tokens + 0.5 * (train_words + 1)
        n_tokens, n_known, base, score = [], [], [], np.zeros(len(data))
        for x in data:
            w = words(x)
            c = np.fromiter(map(count.__getitem__, w), np.int64, len(w))
            n_tokens.append(len(w) + 1)
            n_known.append(int((c > 0).sum()) + (train_texts > 0))
            base.append(float(np.log10((c + 0.5) / unit).sum() + np.log10((train_texts + 0.5) / unit)))
        for a, b in chunks(data):
            w, begins = windows(data[a:b])
            order = np.argsort(w)  # sorted windows are found several times faster
            each = np.empty(len(w))
            each[order] = logs[np.searchsorted(grams, w[order])]
            score[a:b] = np.add.reduceat(each, begins[:-1])
        names = [x.split()[0] for x in RESULT.split(", ")]
        held = pa.array(~texts.column("train").to_numpy().astype(bool))
        return pa.table([texts.column("doc_id"), held, pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array([train_tokens] * len(data), pa.int64()), pa.array(base), pa.array(score)], names=names)

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """Base and model scores of every row of ``docs`` (see RESULT).

    Learns from the rows whose crc32 of doc_id isn't 1 modulo 5. Null texts
    are empty: one token, the end. Rows that repeat count as often as they
    stand there and each get their row. An empty table gives no rows; without
    training rows each token has base probability 1 and each symbol 1/257.
    Texts go to buckets by a hash of id and text; only repeated rows share it.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), (crc_mod5() != 1).alias("train"))
    size, train_texts = rows.agg(F.sum(F.octet_length("text")), F.count_if("train")).first()
    buckets = max(6, -(-(size or 0) // BUCKET_BYTES))
    owners = min(MOST_OWNERS, max(8, buckets // OWNED))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)))
    asked = cut(rows.groupBy("bucket").applyInArrow(gather(owners), KEYS), "ppm-keys")
    lows = asked.where("kind = 'low'").select("keys", "counts").mapInArrow(add_triples, "triple long, n long").groupBy("triple").agg(F.sum("n").alias("n")).orderBy("triple").toArrow()
    low = LowOrders(lows.column("triple").to_numpy(), lows.column("n").to_numpy())
    told = asked.where("kind <> 'low'").groupBy("owner", "kind").applyInArrow(answer(low), VALUES)
    told = cut(told, "ppm-values")
    totals = told.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct_words"), F.lit(0))).first()
    answers = asked.join(told, ["bucket", "owner", "kind"]).select("bucket", "kind", "keys", "vals")
    run = score_texts(int(totals[0]) + train_texts, int(totals[1]) + (train_texts > 0), train_texts)
    return rows.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(run, RESULT)


def add_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums of a task's counts of symbol triples."""
    total = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        for keys, counts in zip(batch.column("keys"), batch.column("counts"), strict=True):
            total = merged([total, (unpack_sorted(keys.as_py()), unpack(counts.as_py(), np.int64))])
    yield pa.RecordBatch.from_pydict({"triple": pa.array(total[0], pa.int64()), "n": pa.array(total[1], pa.int64())})


def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: scores of all documents, those learned from and those held out.

    Null texts are empty; repeated rows each get their row; an empty table gives none.
    """
    return score_documents(table(spark, sf_dir, "documents"))
