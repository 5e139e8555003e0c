"""Languages of mixed texts: candidates by script, then Viterbi over word scores (operator 11)."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_slices

UNKNOWN = "und"
#: Orders of letter runs, the hash buckets of each order, and what is added to every count.
ORDERS, BUCKETS, ADDED = (2, 3, 4), 1 << 15, 0.1
#: A script is a language's own from this share of its letters.
SCRIPT_SHARE = 0.02
#: Nats that a change of language costs between two words, and that a word costs in a language of other scripts.
SWITCH, FOREIGN = 8.0, 50.0
#: Learned languages at most; a model holds 400 kB for each.
MOST_LANGUAGES = 1_000
#: Bytes of text labelled side by side.
SLICE = 2 << 20

#: First and last code point of the scripts told apart; letters elsewhere are of one more script. Fixed values (Unicode blocks).
SCRIPTS = (
    ("latin", ((0x0041, 0x024F), (0x1E00, 0x1EFF), (0xFF21, 0xFF5A))), ("greek", ((0x0370, 0x03FF), (0x1F00, 0x1FFF))), ("cyrillic", ((0x0400, 0x052F), (0x1C80, 0x1C8F))),
    ("armenian", ((0x0530, 0x058F),)), ("hebrew", ((0x0590, 0x05FF),)), ("arabic", ((0x0600, 0x06FF), (0x0750, 0x077F), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))),
    ("devanagari", ((0x0900, 0x097F),)), ("bengali", ((0x0980, 0x09FF),)), ("gurmukhi", ((0x0A00, 0x0A7F),)), ("gujarati", ((0x0A80, 0x0AFF),)), ("tamil", ((0x0B80, 0x0BFF),)),
    ("telugu", ((0x0C00, 0x0C7F),)), ("kannada", ((0x0C80, 0x0CFF),)), ("malayalam", ((0x0D00, 0x0D7F),)), ("thai", ((0x0E00, 0x0E7F),)), ("georgian", ((0x10A0, 0x10FF),)),
    ("hangul", ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF))), ("ethiopic", ((0x1200, 0x137F),)), ("khmer", ((0x1780, 0x17FF),)),
    ("kana", ((0x3040, 0x30FF), (0x31F0, 0x31FF))), ("han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF))),
)
N_SCRIPTS = len(SCRIPTS) + 1
MARK = 255


@cache
def letters() -> tuple[np.ndarray, np.ndarray]:
    """Tables by code point: script (0 no letter, ``MARK`` a combining mark) and lower case."""
    kinds = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
    script = np.array([N_SCRIPTS if k == "L" else MARK if k == "M" else 0 for k in kinds], np.uint8)
    for number, (_, ranges) in enumerate(SCRIPTS, 1):
        for low, high in ranges:
            part = script[low : high + 1]
            part[part == N_SCRIPTS] = number
    lower = np.array([ord(x) if len(x := chr(c).lower()) == 1 else c for c in range(0x110000)], np.uint32)
    return script, lower


@dataclass
class Words:
    """The words of some texts: runs of letters, with the marks that follow them."""

    codes: np.ndarray  # lower case, 0 where there is no letter
    start: np.ndarray
    size: np.ndarray
    script: np.ndarray  # of the first letter
    first: np.ndarray  # each text's first word, and one more at the end
    base: np.ndarray  # where each text starts

    @classmethod
    def of(cls, texts: list[str]) -> Words:
        script, lower = letters()
        codes = np.frombuffer(("\0" + "\0".join(texts) + "\0\0\0\0").encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = script[codes]
        held = kind > 0
        lone = held & (kind == MARK)  # a mark starts no word
        lone[1:] &= ~held[:-1]
        held &= ~lone
        edge = np.flatnonzero(np.diff(held))  # a NUL stands at both ends
        start, end = edge[::2] + 1, edge[1::2] + 1
        base = 1 + np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        return cls(np.where(held, lower[codes], 0).astype(np.uint32), start, end - start, kind[start], np.searchsorted(start, base), base[:-1])

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def runs(self, order: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """For words ``low`` to ``high``: the bucket of each run of ``order`` letters, a word's edges counting as letters, and the runs a word has."""
        count = np.maximum(0, self.size[low:high] + 3 - order)
        ends = np.cumsum(count)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[low:high] - 1 - ends + count, count)
        mixed = np.zeros(len(at), np.uint32)
        for k in range(order):
            mixed = (mixed ^ self.codes[at + k]) * np.uint32(0x9E3779B1)
            mixed ^= mixed >> np.uint32(15)
        return ((mixed * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64), count


#: Slots of the counts that training sums: runs by order and bucket, then letters by script, then documents.
RUNS = len(ORDERS) * BUCKETS
SLOTS = RUNS + N_SCRIPTS + 2


@dataclass
class Model:
    """What was learned: log shares of runs by language, which scripts are whose, and how common a language is."""

    names: list[str]
    runs: np.ndarray  # by order and bucket, then language
    own: np.ndarray  # by script, then language
    prior: np.ndarray

    def scores(self, words: Words, block: int = 20_000) -> np.ndarray:
        """Log score of every word in every language; a script narrows the candidates to its languages, if it has any."""
        out = np.zeros((len(words.start), len(self.names)), np.float32)
        for low in range(0, len(words.start), block):
            high = min(low + block, len(words.start))
            for k, order in enumerate(ORDERS):
                found, count = words.runs(order, low, high)
                some = np.flatnonzero(count)
                if len(some):
                    out[low + some] += np.add.reduceat(self.runs[k * BUCKETS + found], (np.cumsum(count) - count)[some], axis=0)
        out /= len(ORDERS)
        return out - np.float32(FOREIGN) * ~self.own[words.script]

    def path(self, scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
        """The best language of each word, texts side by side: a change between two words costs ``switch``."""
        label = np.zeros(len(scores), np.int32)
        if not len(scores):
            return label
        sizes = np.diff(first)
        order = np.argsort(-sizes, kind="stable")
        order = order[sizes[order] > 0]
        begin, sizes = first[order], sizes[order]
        live = np.searchsorted(-sizes, -np.arange(sizes[0]) - 0.5)  # texts with a word at each step
        back = np.zeros(scores.shape, np.uint16)
        alone = np.arange(scores.shape[1], dtype=np.uint16)
        best = scores[begin] + self.prior
        for t, m in enumerate(live[1:], 1):
            now, at = best[:m], begin[:m] + t
            top = now.argmax(axis=1)
            jump = now[np.arange(m), top] - np.float32(switch)
            back[at] = np.where(now >= jump[:, None], alone, top[:, None])
            best[:m] = np.maximum(now, jump[:, None]) + scores[at]
        label[begin + sizes - 1] = now = best.argmax(axis=1)
        for t in range(len(live) - 1, 0, -1):
            m = live[t]
            now[:m] = back[begin[:m] + t, now[:m]]
            label[begin[:m] + t - 1] = now[:m]
        return label


def train(docs: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """A model from every row whose ``lang`` isn't null.

    Tasks count runs of letters into buckets by language and Spark sums them,
    so what reaches the driver is bounded by languages and buckets, however
    many rows there are. A null text has no letters; repeated rows count each
    time; no rows give a model that knows no language.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                names, words = part.column("lang").to_pylist(), Words.of([x or "" for x in part.column("text").to_pylist()])
                at = {x: k for k, x in enumerate(dict.fromkeys(names))}
                own = np.array([at[x] for x in names])[words.owner()] if names else np.zeros(0, np.int64)
                met = np.zeros((len(at), SLOTS), np.int64)
                for k, order in enumerate(ORDERS):
                    found, n = words.runs(order, 0, len(words.start))
                    met[:, k * BUCKETS : (k + 1) * BUCKETS] = np.bincount(np.repeat(own, n) * BUCKETS + found, minlength=len(at) * BUCKETS).reshape(-1, BUCKETS)
                met[:, RUNS : SLOTS - 1] = np.bincount(own * (N_SCRIPTS + 1) + words.script, words.size, len(at) * (N_SCRIPTS + 1)).reshape(-1, N_SCRIPTS + 1)
                for x in names:
                    met[at[x], -1] += 1
                for x, k in at.items():
                    sums[x] = sums[x] + met[k] if x in sums else met[k]
        for x, found in sums.items():
            slot = np.flatnonzero(found)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([x] * len(slot), pa.string()), "slot": pa.array(slot, pa.int64()), "n": pa.array(found[slot], pa.int64())})

    rows = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    sums = rows.mapInArrow(count, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    langs = sums.column("lang").to_pylist()
    names = sorted(set(langs))
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"{len(names)} languages; at most {MOST_LANGUAGES} can be learned")
    at = {x: k for k, x in enumerate(names)}
    met = np.zeros((SLOTS, len(names)))
    met[sums.column("slot").to_numpy(), np.array([at[x] for x in langs], int)] = sums.column("n").to_numpy()
    runs = met[:RUNS].reshape(len(ORDERS), BUCKETS, -1) + ADDED
    by_script = met[RUNS : SLOTS - 1]
    own = by_script >= np.maximum(1, SCRIPT_SHARE * by_script.sum(axis=0))
    own[~own.any(axis=1)] = True
    prior = np.log(np.maximum(met[-1], 1) / max(1.0, met[-1].sum()))
    return Model(names, np.log(runs / runs.sum(axis=1, keepdims=True)).reshape(RUNS, -1).astype(np.float32), own, prior.astype(np.float32))


def identify(docs: DataFrame, model: Model, keys: tuple[str, ...] = ("doc_id",), text: str = "text", switch: float = SWITCH) -> DataFrame:
    """``(*keys, lang_pred, score, spans)`` of every whole text.

    spans are runs of words in one language, ``(start, end, lang)`` in code
    points. lang_pred has most letters in its spans, the commoner language in
    the training rows at a tie; score is those letters' share of all, each span
    counting by the probability of its language. A text that is null or has no
    letter, or any text under a model that knows no language, gives ``und``, 0
    and no spans. Repeated rows each get theirs; an empty table gives none.
    """

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                words = Words.of([x or "" for x in part.column("text").to_pylist()])
                named, share, spans = summarise(words)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), named, share, spans], [*keys, "lang_pred", "score", "spans"])

    def summarise(words: Words) -> tuple[pa.Array, pa.Array, pa.Array]:
        n, count = len(words.first) - 1, len(model.names)
        if not len(words.start) or not count:
            none = pa.ListArray.from_arrays(pa.array(np.zeros(n + 1), pa.int32()), pa.array([], SPAN))
            return pa.array([UNKNOWN] * n, pa.string()), pa.array(np.zeros(n)), none
        scores, owner = model.scores(words), words.owner()
        chosen = model.path(scores, words.first, switch)
        head = np.flatnonzero(np.concatenate([[True], (np.diff(chosen) != 0) | (np.diff(owner) != 0)]))
        tail = np.append(head[1:], len(chosen)) - 1
        lang, doc = chosen[head], owner[head]
        whole = np.add.reduceat(scores, head, axis=0).astype(float) + model.prior
        sure = 1 / np.exp(whole - whole[np.arange(len(head)), lang][:, None]).sum(axis=1).clip(1)
        size = np.add.reduceat(words.size, head)
        cell = doc * count + lang
        held = np.bincount(cell, size, n * count).reshape(n, count)
        best = np.lexsort((np.broadcast_to(model.prior, held.shape), held), axis=1)[:, -1]
        worth = np.bincount(cell, size * sure, n * count).reshape(n, count)[np.arange(n), best]
        some = held.sum(axis=1) > 0
        named = np.where(some, np.array(model.names, object)[best], UNKNOWN)
        origin = words.base[doc]
        rows = pa.StructArray.from_arrays([pa.array(words.start[head] - origin, pa.int64()), pa.array(words.start[tail] + words.size[tail] - origin, pa.int64()), pa.array(np.array(model.names, object)[lang], pa.string())], fields=list(SPAN))
        offsets = pa.array(np.searchsorted(doc, np.arange(n + 1)), pa.int32())
        return pa.array(named, pa.string()), pa.array(worth / np.maximum(1, held.sum(axis=1))), pa.ListArray.from_arrays(offsets, rows)

    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    return docs.select(*keys, F.col(text).alias("text")).mapInArrow(label, f"{kinds}, lang_pred string, score double, spans array<struct<start: bigint, end: bigint, lang: string>>")


SPAN = pa.struct([pa.field("start", pa.int64()), pa.field("end", pa.int64()), pa.field("lang", pa.string())])


def held_out():
    """Whether a row is kept from training: crc32 of its id as text, modulo 3, is 1; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the language of every document, learned from those that aren't held out.

    Null texts and texts without a letter are ``und`` with score 0; ties go to
    the commoner language; repeated rows each get their row; an empty table
    gives none.
    """
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    return identify(docs.withColumn("held_out", held_out()), model, ("doc_id", "held_out")).select("doc_id", "held_out", "lang_pred", "score")
