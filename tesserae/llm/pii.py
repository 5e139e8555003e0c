"""Personal data by weak supervision (operator 1), DataFrame functions only.

Patterns find candidate spans. Labelers of three kinds (pattern checks,
gazetteers, context) vote on each or abstain. Expectation-maximisation over
the counts of vote patterns estimates how reliable each labeler is, and the
posteriors train the span classifier that decides on the candidates which the
base patterns don't settle. All work on texts stays in Spark expressions; the
driver sees counts by vote pattern and feature value, a few thousand at most.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fresh, let, starts_of, table, text_of

KINDS = ("email", "ip", "card", "phone")

#: Base patterns. Possessive runs and the look-behinds give the plain greedy patterns' matches without rescanning long runs.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Looser patterns, whose spans only the classifier can add: what stands next to further digits, is written out, or has another layout.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]|\{dot\}|\.) ?[A-Za-z0-9-]{1,63}){1,4}|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} at [A-Za-z0-9-]{1,63}(?: dot [A-Za-z0-9-]{2,63}){1,4}",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])|(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\])[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ .-][0-9]{4}){3}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})(?![0-9])",
    "phone": r"(?<![0-9+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])|(?<![0-9+().-])00[1-9][0-9][ ().0-9-]{6,18}[0-9]|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-][0-9]{4}(?![0-9])",
}
#: What a text has to hold for a pattern to be tried at all.
GUARDS = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike("[0-9]"),
    "phone": lambda t: F.contains(t, F.lit("+")),
}
LOOSE_GUARDS = {
    "email": lambda t: t.rlike(r"[(\[{]at[)\]}]| at [A-Za-z0-9-]+ dot "),
    "ip": lambda t: t.rlike(r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:|[0-9][(\[](?:\.|dot)[)\]][0-9]"),
    "card": lambda t: t.rlike(r"[0-9]{13}|[0-9]{4}[ .-][0-9]{4,6}[ .-]"),
    "phone": lambda t: t.rlike(r"[0-9]{3}[ .-][0-9]{4}|00[1-9][0-9]"),
}

#: Gazetteers (fixed values): domain endings, calling codes, first digits of card issuers.
ENDINGS = (
    "ac ad ae ai al am ar at au az ba bd be bg bh biz bo br by ca cat cc ch cl cloud club cn co com cr cu cy cz de dev dk do dz ec edu ee eg es eu example fi fm fr "
    "gb ge gg gh gl gov gr gt hk hn hr hu id ie il im in info int io iq ir is it jm jo jp ke kg kh kr kw kz la lb li lk lt lu lv ly ma md me mil mk ml mm mn mo mobi mt mx my "
    "name net ng ni nl no np nu nz om online org pa pe ph pk pl pr pro pt py qa ro rs ru sa sd se sg shop si site sk sn so store sv sy tech tel th tk tn to top tr tv tw tz "
    "ua ug uk us uy uz va ve vn ws xyz ye za zm zw"
).split()
CALLING = r"1|7|2[07]|21[1-3689]|22[0-9]|23[0-9]|24[0-9]|25[0-8]|26[0-9]|29[0179]|3[0-469]|35[0-9]|37[0-9]|38[0-9]|4[013-9]|42[013]|5[1-8]|50[0-9]|59[0-9]|6[0-6]|67[0-9]|68[0-9]|69[0-2]|8[1246]|85[02356]|88[0-6]|9[0-58]|96[0-8]|97[0-7]|99[2-8]"
ISSUERS = "3[0-9]|4|5[0-9]|6[0-9]|2[2-7]"
#: Context (fixed values): words that announce personal data, and words that announce other numbers.
CUES = {
    "email": r"(?i)\b(?:e-?mails?|mailto|contact|correo|courriel|kontakt|write|reply)\b",
    "ip": r"(?i)\b(?:ips?|address|host|server|login|logged|client|adresse|direcci.n)\b",
    "card": r"(?i)\b(?:cards?|visa|master ?card|amex|credit|debit|payment|karte|carte|tarjeta)\b",
    "phone": r"(?i)\b(?:phones?|tel|telephone|call|mobile|cell|fax|whatsapp|telefon|t.l.phone|tel.fono|anruf)\b",
}
AGAINST = r"(?i)\b(?:version|ver|release|build|isbn|issn|doi|order|invoice|serial|ref|part|model|section|chapter|token|key|hash|id)\b"

LABELERS = ("boundary", "gazetteer", "context", "format")
#: Values of each feature of a candidate beside the votes: length, separators, what stands before and after.
VALUES = 8
FEATURES = ("length", "separators", "before", "after")
CONTEXT = 32
THRESHOLD = 0.9
#: Rounds of expectation-maximisation, and what each count starts with.
ROUNDS, SMOOTH = 40, 1.0

SPAN = "array<struct<kind:int,start:bigint,stop:bigint,text:string,left:string,right:string,base:boolean>>"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def term(d: Column, i: Column) -> Column:
        twice = d * (1 + i % 2)
        return twice - F.when(twice > 9, 9).otherwise(0)

    each = F.transform(F.split(F.reverse(number), ""), lambda c: F.coalesce(F.try_to_number(c, F.lit("9")).cast("int"), F.lit(0)))
    return F.aggregate(F.transform(each, term), F.lit(0), lambda a, x: a + x) % 10 == 0


def passes(kind: str, text: Column) -> Column:
    """Whether a base match of ``kind`` is valid."""
    if kind == "ip":
        return F.forall(F.split(text, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        n = F.length(digits(text))
        return F.when(F.length(text) < 16, False).when(n.between(16, 19), luhn(digits(text))).otherwise(False)
    if kind == "phone":
        return F.length(digits(text)).between(8, 15)
    return F.lit(True)


def matches(text: Column, kind: str, pattern: str, guard: Column, base: bool) -> Column:
    """Leftmost non-overlapping matches with their code point positions and surroundings.

    The text is split at the matches; running sums of the lengths of what lies
    between and of the matches themselves give the positions.
    """
    k = KINDS.index(kind)

    def with_parts(x: Column) -> Column:
        between, hits = x["between"], x["hits"]
        sizes = F.zip_with(hits, F.slice(between, 1, F.size(hits)), lambda h, b: F.length(h).cast("long") + F.length(b))

        def span(h: Column, i: Column) -> Column:
            return F.struct(h.alias("text"), F.get(between, i).alias("b"), F.get(between, i + 1).alias("a"))

        def made(s: Column, at: Column) -> Column:
            start = at + F.length(s["b"])
            return F.struct(F.lit(k).alias("kind"), start.alias("start"), (start + F.length(s["text"])).alias("stop"), s["text"].alias("text"), F.right(s["b"], F.lit(CONTEXT)).alias("left"), F.left(s["a"], F.lit(1)).alias("right"), F.lit(base).alias("base"))

        return F.zip_with(F.transform(hits, span), starts_of(sizes), made)

    both = F.struct(F.split(text, pattern, -1).alias("between"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    found = F.when(guard, let(both, with_parts)).otherwise(F.array().cast(SPAN))
    return F.filter(found, lambda s: passes(kind, s["text"])) if base else found


def spans(text: Column) -> tuple[Column, Column]:
    """Base spans, and candidates that overlap none of them, of a text column."""
    base = F.concat(*[matches(text, k, BASE[k], GUARDS[k](text), True) for k in KINDS])
    loose = F.concat(*[matches(text, k, LOOSE[k], LOOSE_GUARDS[k](text), False) for k in KINDS])
    return base, loose


def apart(loose: Column, base: Column) -> Column:
    return F.filter(loose, lambda s: ~F.exists(base, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))


def by_kind(s: Column, make) -> Column:
    out = F.lit(0)
    for k, name in enumerate(KINDS):
        out = F.when(s["kind"] == k, make(name)).otherwise(out)
    return out


def vote(yes: Column, no: Column) -> Column:
    """1 for, 2 against, 0 abstains."""
    return F.when(yes, 1).when(no, 2).otherwise(0)


def votes(s: Column) -> list[Column]:
    """Each labeler's vote on a span."""
    text, left = s["text"], s["left"]
    plain = F.lower(F.regexp_replace(F.regexp_replace(text, r" ?[(\[{]dot[)\]}] ?| dot ", "."), r" ?[(\[{]at[)\]}] ?| at ", "@"))
    n = F.length(digits(text))

    def listed(kind: str) -> Column:
        if kind == "email":
            return vote(plain.rlike(rf"\.(?:{'|'.join(ENDINGS)})$"), ~plain.rlike(r"\.[a-z]{2,}$"))
        if kind == "ip":
            return vote(~text.rlike(r"^0*(?:0|10|127|22[4-9]|2[3-5][0-9])[.:\[(]"), text.rlike(r"^0*(?:0|127)[.:\[(]"))
        if kind == "card":
            return vote(text.rlike(f"^(?:{ISSUERS})"), text.rlike("^[01789]"))
        return vote(text.rlike(rf"^(?:\+|00)(?:{CALLING})") | text.rlike(r"^\(?[2-9][0-9]{2}"), text.rlike(r"^\(?[01]"))

    def formed(kind: str) -> Column:
        if kind == "email":
            return vote(plain.rlike(r"^[a-z0-9][a-z0-9._%+-]*@[a-z0-9][a-z0-9.-]*[a-z0-9]$"), plain.rlike(r"\.\.|--|^[.%+-]"))
        if kind == "ip":
            return vote(~text.rlike(r"(?:^|\.)0[0-9]"), text.rlike(r"(?:^|\.)0[0-9]"))
        if kind == "card":
            return vote(luhn(digits(text)), F.length(F.regexp_replace(digits(text), "^(.)\\1*$", "")) == 0)
        return vote(n.between(10, 13), (n < 8) | (n > 15))

    before, after = F.right(left, F.lit(1)), s["right"]
    touches = before.rlike(r"[\p{L}\p{N}_@#\"'=/]") | after.rlike(r"[\p{L}\p{N}_@\"'=/]")
    return [
        vote((before.rlike(r"^[\s(\[{<,;:!?&*$%#|.]?$")) & (after.rlike(r"^[\s)\]}>,;:!?&*$%#|.]?$")), touches),
        by_kind(s, listed),
        by_kind(s, lambda kind: vote(left.rlike(CUES[kind]), left.rlike(AGAINST))),
        by_kind(s, formed),
    ]


def features(s: Column) -> list[Column]:
    """Feature values of a span, each from 0 to VALUES - 1."""
    side = lambda c: F.when(c == "", 0).when(c.rlike("[ \n\t]"), 1).when(c.rlike("[A-Za-z]"), 2).when(c.rlike("[0-9]"), 3).when(c.rlike("[.,;:!?]"), 4).when(c.rlike("[(\\[<{\"')\\]>}]"), 5).otherwise(6)
    return [
        F.least(F.floor(F.length(s["text"]) / 4), F.lit(VALUES - 1)).cast("int"),
        F.least(F.length(F.regexp_replace(s["text"], "[A-Za-z0-9]", "")), F.lit(VALUES - 1)).cast("int"),
        side(F.right(s["left"], F.lit(1))),
        side(s["right"]),
    ]


@dataclass(frozen=True)
class Classifier:
    """Log-odds that a span is personal data: for a kind, each labeler's vote and each feature value."""

    prior: tuple[float, ...]
    vote_odds: tuple[tuple[tuple[float, ...], ...], ...]
    feature_odds: tuple[tuple[tuple[float, ...], ...], ...]

    def probability(self, s: Column) -> Column:
        """Probability of a span, as a Spark expression."""

        def weight(rows: tuple[tuple[tuple[float, ...], ...], ...], j: int, value: Column) -> Column:
            flat = F.array(*[F.lit(float(x)) for kind in rows for x in kind[j]])
            return F.get(flat, s["kind"] * len(rows[0][j]) + value)

        total = F.get(F.array(*map(F.lit, self.prior)), s["kind"])
        for j, v in enumerate(votes(s)):
            total = total + weight(self.vote_odds, j, v)
        for j, v in enumerate(features(s)):
            total = total + weight(self.feature_odds, j, v)
        return 1 / (1 + F.exp(-total))


def estimate(counts: dict[tuple[int, tuple[int, ...]], float], seen: dict[tuple[int, tuple[int, ...], int, int], float]) -> Classifier:
    """Reliabilities by expectation-maximisation, then the classifier.

    ``counts`` has spans by kind and vote pattern, ``seen`` also by feature and
    value. Two classes, labelers independent within a class; posteriors start
    from the majority of votes. Starting counts keep every share off 0 and 1,
    so that kinds without spans get odds that say nothing.
    """
    prior, vote_odds, feature_odds = [], [], []
    for kind in range(len(KINDS)):
        mine = {p: n for (k, p), n in counts.items() if k == kind}
        post = {p: 1 / (1 + math.exp(-1.5 * sum({0: 0, 1: 1, 2: -1}[v] for v in p))) for p in mine}
        share = 0.5
        odds = [[0.0] * 3 for _ in LABELERS]
        for _ in range(ROUNDS):
            yes = sum(n * post[p] for p, n in mine.items()) + SMOOTH
            no = sum(n * (1 - post[p]) for p, n in mine.items()) + SMOOTH
            share = yes / (yes + no)
            for j in range(len(LABELERS)):
                # what a labeler is presumed to do before it is observed
                t, f = [SMOOTH, 2 * SMOOTH, SMOOTH / 2], [SMOOTH, SMOOTH / 2, 2 * SMOOTH]
                for p, n in mine.items():
                    t[p[j]] += n * post[p]
                    f[p[j]] += n * (1 - post[p])
                odds[j] = [math.log(a / sum(t)) - math.log(b / sum(f)) for a, b in zip(t, f, strict=True)]
            post = {p: 1 / (1 + math.exp(-max(-60.0, min(60.0, math.log(share / (1 - share)) + sum(odds[j][v] for j, v in enumerate(p)))))) for p in mine}
        table_: list[tuple[float, ...]] = []
        for j in range(len(FEATURES)):
            t, f = [SMOOTH] * VALUES, [SMOOTH] * VALUES
            for (k, p, i, v), n in seen.items():
                if k == kind and i == j:
                    t[v] += n * post[p]
                    f[v] += n * (1 - post[p])
            # features are not independent of the votes: half weight
            table_.append(tuple(0.5 * (math.log(a / sum(t)) - math.log(b / sum(f))) for a, b in zip(t, f, strict=True)))
        prior.append(max(-2.0, min(2.0, math.log(share / (1 - share)))))
        vote_odds.append(tuple(map(tuple, odds)))
        feature_odds.append(tuple(table_))
    return Classifier(tuple(prior), tuple(vote_odds), tuple(feature_odds))


def candidates(text: Column) -> Column:
    """Struct of ``base`` spans of a text and ``loose`` ones apart from them."""
    base, loose = spans(text)
    return let(base, lambda b: F.struct(b.alias("base"), apart(loose, b).alias("loose")))


def learn(rows: DataFrame, column: str) -> Classifier:
    """Learn from every candidate in a column of ``candidates``: one pass, counts only."""
    c = F.col(column)
    found = rows.where((F.size(c["base"]) > 0) | (F.size(c["loose"]) > 0)).select(F.explode(F.concat(c["base"], c["loose"])).alias("s"))
    s = F.col("s")
    found = found.select(s["kind"].alias("kind"), F.array(*votes(s)).alias("p"), F.array(*features(s)).alias("f"))
    found = found.select("kind", "p", F.posexplode("f").alias("j", "v"))
    counts: dict = defaultdict(float)
    seen: dict = defaultdict(float)
    for r in found.groupBy("kind", "p", "j", "v").count().collect():
        seen[r.kind, tuple(r.p), r.j, r.v] += r["count"]
        if r.j == 0:
            counts[r.kind, tuple(r.p)] += r["count"]
    return estimate(counts, seen)


def train(docs: DataFrame) -> Classifier:
    """A classifier from the texts of ``docs``."""
    return learn(docs.select(candidates(text_of()).alias("c")), "c")


def decide(model: Classifier, found: Column) -> Column:
    """Struct of ``base`` and ``all`` spans from ``candidates``, each in order of kind, then start."""

    def with_added(added: Column) -> Column:
        every = F.when(F.size(added) > 0, F.array_sort(F.concat(found["base"], added))).otherwise(found["base"])
        return F.struct(found["base"].alias("base"), every.alias("all"))

    return let(F.filter(found["loose"], lambda s: model.probability(s) >= THRESHOLD), with_added)


def found_spans(model: Classifier, text: Column) -> Column:
    """Struct of ``base`` and ``all`` spans of a text."""
    return let(candidates(text), lambda c: decide(model, c))


def listing(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; overlapping spans go as one."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    order = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))

    def step(a: Column, s: Column) -> Column:
        fresh = s["start"] >= a["at"]
        kept = F.substring(text, a["at"].cast("int") + 1, (s["start"] - a["at"]).cast("int"))
        return F.struct(F.greatest(a["at"], s["stop"]).alias("at"), F.when(fresh, F.concat(a["out"], F.array(kept, F.get(names, s["kind"])))).otherwise(a["out"]).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))
    end = lambda a: F.array_join(F.concat(a["out"], F.array(F.substring(text, a["at"].cast("int") + 1, F.length(text)))), "")
    return F.when(F.size(found) > 0, F.aggregate(order, start, step, end)).otherwise(text)


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced and n_chars, where there is one, set anew.

    Rows and other columns, whatever their names, stay as they are; a null text
    stays null; an empty table gives no rows. Texts are searched once: what is
    found stands beside them in a written table.
    """
    name = fresh(docs, "found")
    rows = cut(docs.withColumn(name, candidates(text_of())), "pii")
    model = learn(rows, name)
    clean = F.when(F.col("text").isNotNull(), redact(F.col("text"), decide(model, F.col(name))["all"]))
    out = rows.withColumn("text", clean).drop(name)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: personal data in every document.

    Null texts are empty and hold nothing; repeated rows each get their row; an
    empty table gives none. n_ columns count base spans, n_added what the
    classifier adds.
    """
    docs = table(spark, sf_dir, "documents")
    rows = cut(docs.select("doc_id", candidates(text_of()).alias("c")), "pii")
    model = learn(rows, "c")
    rows = rows.select("doc_id", decide(model, F.col("c")).alias("x"))
    counts = [F.size(F.filter(F.col("x.base"), _is_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(listing(F.col("x.base")), 256).alias("base_sha256"), listing(F.col("x.all")).alias("spans"), (F.size("x.all") - F.size("x.base")).cast("long").alias("n_added"))


def _is_kind(k: int):
    return lambda s: s["kind"] == k
