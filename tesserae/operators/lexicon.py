"""Spelling suggestions and text chunks: joins that narrow down, then a small Python measure."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import join_sliced


def common_letters(p: str, q: str) -> int:
    """Letters of a longest common subsequence, all places of one word as the bits of one number."""
    places: dict[str, int] = {}
    for i, c in enumerate(p):
        places[c] = places.get(c, 0) | 1 << i
    free = every = (1 << len(p)) - 1
    for c in q:
        met = free & places.get(c, 0)
        free = ((free + met) | (free - met)) & every
    return len(p) - free.bit_count()


def char_ratio(a: Column, b: Column, least: float = 0.0) -> Column:
    """Share of characters in matching blocks of two words, 0 to 1; no Spark function has it. Below ``least`` it may be 0."""

    def one(p: str, q: str) -> float:
        if 2 * common_letters(p, q) < least * (len(p) + len(q)) - 1e-9:  # blocks hold no more than that
            return 0.0
        return SequenceMatcher(None, p, q).ratio()

    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([one(p, q) for p, q in zip(x, y, strict=True)], dtype=float)

    return ratio(a, b)


def letter_bit(c: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.ascii(c) % 64)


def letter_set(word: Column) -> Column:
    """The letters of a word as bits; two letters may share one."""
    return F.aggregate(F.split(word, ""), F.lit(0).cast("bigint"), lambda a, c: a.bitwiseOR(letter_bit(c)))


def letters_again(word: Column) -> Column:
    """The bits that a word has twice or more."""
    none = F.lit(0).cast("bigint")
    return F.aggregate(F.split(word, ""), F.struct(none.alias("once"), none.alias("twice")), lambda a, c: F.struct(a["once"].bitwiseOR(letter_bit(c)).alias("once"), a["twice"].bitwiseOR(a["once"].bitwiseAND(letter_bit(c))).alias("twice")))["twice"]


def close_matches(words: DataFrame, lexicon: DataFrame, least: float = 0.8) -> DataFrame:
    """For ``words(word)`` the best ``lexicon(term, freq)``: ``(word, term, ratio)``.

    Terms share the initial and differ by two letters of length at most. A
    ratio r leaves at most (1 - r) times both lengths of letters in no matching
    block, so the letters that just one of them has, or has twice, settle most
    pairs, the built-in edit distance most others, and the Python measure sees
    few. Pairs of one initial and length are shared out among tasks. The best
    by ratio to one place, then frequency, then the ratio, then the word.
    """
    key = lambda word, n: F.concat(F.substring(word, 1, 1), F.lit(" "), n.cast("string")).alias("at")
    asked = words.select("word", letter_set(F.col("word")).alias("x1"), letters_again(F.col("word")).alias("x2"), F.explode(F.sequence(F.length("word") - 2, F.length("word") + 2)).alias("n"))
    both = F.length("word") + F.col("n")
    most = F.floor((1 - least) * both + 1e-9).cast("int")
    most = most - (both - most) % 2  # letters in no block are as even as all of them
    asked = asked.select("word", "x1", "x2", most.alias("most"), key("word", F.col("n")))
    known = lexicon.select("term", "freq", letter_set(F.col("term")).alias("y1"), letters_again(F.col("term")).alias("y2"), key("term", F.length("term")))
    pairs = join_sliced(asked, known, "at").where("word <> term")
    differ = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b)))
    near = F.call_function("levenshtein", F.col("word"), F.col("term"), F.col("most")) >= 0
    pairs = pairs.where((differ("x1", "y1") + differ("x2", "y2") <= F.col("most")) & near).select("word", "term", "freq", char_ratio(F.col("word"), F.col("term"), least).alias("ratio"))
    order = [F.round("ratio", 1).desc(), F.col("freq").desc(), F.col("ratio").desc(), F.col("term")]
    best = pairs.where(F.col("ratio") >= least).withColumn("r", F.row_number().over(Window.partitionBy("word").orderBy(*order)))
    return best.where("r = 1").select("word", "term", F.round("ratio", 6).alias("ratio"))


def chunk_text(text: Column, target: int = 1000, overlap: int = 150, most: int | None = None) -> Column:
    """Paragraphs packed to about ``target`` characters, each chunk beginning with the last sentences of the one before."""

    def pack(t: str) -> list[str]:
        chunks, now = [], ""
        for p in (x.strip() for x in t.split("\n")):
            if not p:
                continue
            if now and len(now) + 1 + len(p) > target:
                chunks.append(now)
                tail = now[-overlap:]
                cut = max(tail.find(". "), tail.find("! "), tail.find("? "))
                now = tail[cut + 2 :] if cut >= 0 else ""
            now = f"{now} {p}".strip()
        return [*chunks, *([now] if now else [])][:most]

    @F.pandas_udf("array<string>")
    def chunks(texts: pd.Series) -> pd.Series:
        return texts.map(pack)

    return chunks(F.coalesce(text, F.lit("")))
