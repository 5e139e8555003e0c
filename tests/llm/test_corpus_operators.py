"""The ten operators against brute force on small tables, and the awkward rows that each must survive."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.llm import chat, components, decontaminate, fingerprints, mixing, pii, ppm, quality, queries, simhash, tokens, urls
from tesserae.llm.common import HashSet, cut, fresh, join_hot

#: Rows with nulls in every column, empty and long texts, repeats and ties, and columns with clashing names.
LONG = " ".join(f"w{k % 977}" for k in range(30_000))
AWKWARD = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43), (2, "the quick brown fox jumps over the lazy dog", "en", "a", 43), (3, "", "en", None, 0), (4, None, None, "b", None),
    (None, "no id here at all", "en", "b", 17), (None, None, None, None, None), (5, "same row", "fr", "c", 8), (5, "same row", "fr", "c", 8), (5, "same id, other text", "fr", "c", 19), (6, LONG, "en", "a", len(LONG)), (7, "é𝒳 ü\t\n x", "de", "é", 7),
]
DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def awkward(spark):
    df = spark.createDataFrame(AWKWARD, DDL)
    return df.withColumn("size", F.lit(1)).withColumn("digest", F.lit("x")).withColumn("node", F.lit(2)).withColumn("bucket", F.lit(3)).withColumn("score", F.lit(0.5)).withColumn("k", F.lit(1))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


def crc(doc_id) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def run(name, spark, sf_dir):
    return queries.QUERIES[name](spark, sf_dir)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(name, same_as_sql):
    same_as_sql(queries.QUERIES[name], queries.ORACLES[name])


def test_columns_of_any_name_survive(spark, awkward):
    names = ["__id", "__tie", "__digest", "__low", "__h", "keeper_id", "keeper_tie", "found", "mix_h", "mix_low", "mix_source", "component_id", "doc_ID_2"]
    docs = awkward
    for n in names:
        docs = docs.withColumn(n, F.lit(n))
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0)], "doc_id long, quality int, toxic int")
    for out, more in ((simhash.keep_one(docs), []), (decontaminate.remove_contaminated(docs, bench), []), (pii.redact_documents(docs), []), (quality.reject_low_quality(docs, labels), []), (mixing.mix(docs), ["source_size", "target", "taken"])):
        assert out.columns == docs.columns + more
        assert all(r[n] == n for r in out.collect() for n in names)
    pages = spark.createDataFrame([(1, "http://a.com/", "x", "y")], "page_id long, url string, token string, best string")
    assert urls.judge(pages, urls.default_rules()).count() == 1
    assert ppm.score_documents(docs).count() == len(AWKWARD)


def test_empty_tables(spark, empty):
    assert pii.redact_documents(empty).count() == 0
    assert empty.select(pii.found_spans(pii.train(empty), F.coalesce("text", F.lit("")))).count() == 0
    assert urls.judge(spark.createDataFrame([], "page_id long, url string"), urls.default_rules()).count() == 0


# 1 personal data


def base_spans(t: str) -> list[tuple[int, int, int]]:
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in re.sub("[^0-9]", "", m[0])]
        if 16 <= len(d) <= 19 and sum(sum(divmod(2 * c, 10)) if i % 2 else c for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append((2, m.start(), m.end()))
    return out + [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_pii_base_spans_equal_brute_force(spark):
    rng = random.Random(5)
    hard = [None, "", "é𝒳 a@b.cc x", "a@b.com_x@c.de y@z", "1.2.3.4.5.6.7.8 999.1.1.1 0000255.1.1.1", "4111 1111 1111 1111", "+1 (743) 555-3824", "+1(2", "9" * 20_000, "a" * 20_000 + "@", "1 " * 5_000, "1.2.3.4 " * 800, "+1" + " " * 900]
    hard += ["".join(rng.choice("0123456789.+- ()@ab\n") for _ in range(rng.randint(1, 80))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(hard)), "doc_id long, text string")
    model = pii.train(df)
    rows = df.select("doc_id", pii.found_spans(model, F.coalesce("text", F.lit(""))).alias("x")).select("doc_id", pii.listing(F.col("x.base")).alias("base"), pii.listing(F.col("x.all")).alias("every")).collect()
    assert len(rows) == len(hard)
    for r in rows:
        want = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base_spans(hard[r.doc_id] or "")]
        assert r.base == ",".join(want)
        assert set(want) <= set(r.every.split(",")) | {""}


def test_pii_uses_no_python(spark, sf_dir):
    plan = run("op1_pii", spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pii_redacts_and_keeps_clean_texts(spark):
    rows = [(1, "write to ann@mail.example.com or +1 (743) 555-3824 now"), (2, "clean words, 12 of 1999"), (3, None), (4, "call: (743) 555-3824")]
    out = {r.doc_id: r.text for r in pii.redact_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: "write to <EMAIL> or <PHONE> now", 2: rows[1][1], 3: None, 4: "call: <PHONE>"}


def marked_sample(rng: random.Random) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Texts with spans that the base patterns miss, and with things that look like some."""

    def card(start: str, n: int = 16) -> str:
        x = start + "".join(rng.choice("0123456789") for _ in range(n - 1 - len(start)))
        odd = sum(sum(divmod(2 * int(c), 10)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(x)))
        return x + str(-odd % 10)

    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(3, 8)))
    hexes = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    out = []
    for k in range(600):
        yes, no = [], []
        kind = k % 10
        if kind == 0:
            yes = [(2, card("4")), (2, card("5"))]
        elif kind == 1:
            yes = [(3, f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"), (2, card("4"))]
        elif kind == 2:
            yes = [(0, f"{word()}.{word()} (at) {word()} (dot) com")]
        elif kind == 3:
            yes = [(3, f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}")]
        elif kind == 4:
            yes = [(1, ":".join(f"{rng.randrange(4096, 65536):x}" for _ in range(8)))]
        elif kind == 5:
            no = [f'token = "{hexes(14)}ab{hexes(3)}c"']
        elif kind == 6:
            bad = card("9")
            no = [f"order {bad[:-1]}{(int(bad[-1]) + 5) % 10}"]
        elif kind == 7:
            no = [f"serial {rng.choice('17')}{hexes(2)} {hexes(3)} {hexes(4)}"]
        elif kind == 8:
            yes = [(0, f"{word()}@{word()}.org")]  # base spans to learn from
        else:
            yes = [(2, card("4"))]
        text, spans = f"{word()} {word()} ", []
        for k2, s in yes:
            spans.append((k2, len(text), len(text) + len(s)))
            text += s + " "
        out.append((text + "".join(f"{x} " for x in no) + word(), spans))
    return out


def test_pii_added_spans_are_right_because_of_the_model(spark, monkeypatch):
    sample = marked_sample(random.Random(31))
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(sample)], "doc_id long, text string")

    def rates(model) -> tuple[float, float]:
        rows = df.select("doc_id", pii.found_spans(model, F.col("text")).alias("x")).select("doc_id", pii.listing(F.col("x.base")).alias("base"), pii.listing(F.col("x.all")).alias("every")).collect()
        right = wrong = wanted = 0
        for r in rows:
            base = set(r.base.split(",")) - {""}
            added = set(r.every.split(",")) - base - {""}
            marked = {f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in sample[r.doc_id][1]} - base
            right, wrong, wanted = right + len(added & marked), wrong + len(added - marked), wanted + len(marked)
        return right / max(1, right + wrong), right / wanted

    precision, recall = rates(pii.train(df))
    assert precision >= 0.97 and recall >= 0.9
    zero = tuple(((0.0,) * 3,) * 4 for _ in pii.KINDS), tuple(((0.0,) * pii.VALUES,) * 4 for _ in pii.KINDS)
    assert rates(pii.Classifier((0.0,) * 4, *zero))[1] == 0  # nothing is added without what was learned
    assert rates(pii.Classifier((9.0,) * 4, *zero))[0] < 0.9  # and too much if all is


def test_em_finds_the_unreliable_labeler():
    rng, counts = random.Random(2), Counter()
    for _ in range(4000):
        true = rng.random() < 0.5
        right = [0.95, 0.9, 0.55, 0.9]
        counts[0, tuple((1 if true else 2) if rng.random() < r else (2 if true else 1) for r in right)] += 1
    model = pii.estimate(counts, {})
    gain = [o[1] - o[2] for o in model.vote_odds[0]]
    assert gain[2] < 0.2 * min(gain[0], gain[1], gain[3])


# 2 language-model scores


def naive_ppm(train: list[bytes], asked: list[bytes]) -> list[float]:
    counts, k = defaultdict(Counter), ppm.ORDER
    pad = [ppm.PAD] * k
    for t in train:
        x = [*pad, *t, ppm.END]
        for i in range(k, len(x)):
            for n in range(k + 1):
                counts[tuple(x[i - n : i])][x[i]] += 1
    out = []
    for t in asked:
        x, total = [*pad, *t, ppm.END], 0.0
        for i in range(k, len(x)):
            escape, left_out = 1.0, set()
            for n in range(k, -1, -1):
                c = counts.get(tuple(x[i - n : i]), {})
                t_, q = sum(v for s, v in c.items() if s not in left_out), sum(s not in left_out for s in c)
                if x[i] in c:
                    total += math.log10(escape * (2 * c[x[i]] - 1) / (2 * t_))
                    break
                if t_:
                    escape *= q / (2 * t_)
                left_out |= set(c)
            else:
                total += math.log10(escape / (257 - len(counts.get((), {}))))
        out.append(total)
    return out


def test_ppm_equals_a_plain_trie(spark, documents, texts, monkeypatch):
    monkeypatch.setattr(ppm, "BUCKET_BYTES", 40_000)
    monkeypatch.setattr(ppm, "UNPACKED", 5_000)
    few = documents.where("doc_id < 60")
    rows = {r.doc_id: r for r in ppm.score_documents(few).collect()}
    data = {k: v.encode().lower() for k, v in texts.items() if k < 60}
    train = {k: v for k, v in data.items() if crc(k) != 1}
    count = Counter(w for v in train.values() for w in v.split())
    n, v = sum(count.values()) + len(train), len(count) + 1
    want = dict(zip(data, naive_ppm(list(train.values()), list(data.values())), strict=True))
    assert len(rows) == len(data)
    for k, r in rows.items():
        c = [count[w] for w in data[k].split()] + [len(train)]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(c), sum(x > 0 for x in c), n, k not in train)
        assert r.base_score == pytest.approx(sum(math.log10((x + 0.5) / (n + 0.5 * (v + 1))) for x in c))
        assert r.score == pytest.approx(want[k], rel=1e-11)


def test_ppm_probabilities_sum_to_at_most_one():
    w, _ = ppm.windows([b"abracadabra", b"abacus"])
    u, n = np.unique(w, return_counts=True)
    low = ppm.LowOrders(*ppm.merged([(u & ppm.TRIPLE, n)]))
    for context in {int(x) >> 9 for x in u}:
        every = np.unique(np.concatenate([u, (context << 9) | np.arange(257)]))
        counts = np.where(np.isin(every, u), np.bincount(np.searchsorted(every, u), n, len(every)), 0)
        logs = ppm.log_probabilities(every, counts, low)
        assert (10 ** logs[(every >> 9) == context]).sum() == pytest.approx(1, abs=1e-9)


def test_ppm_edge_rows(awkward, empty):
    assert ppm.score_documents(empty).count() == 0
    out = ppm.score_documents(awkward).collect()
    assert len(out) == len(AWKWARD)
    assert {r.n_tokens for r in out if r.doc_id in (3, 4)} == {1}


# 3 urls


def test_urls_by_rarest_token_equal_all_rules(spark):
    hosts, paths = ["com", "a.com", "example.com", "www.example.com", "Example.COM", "x.net", "spam-farm.org", "notexample.com", "ads.b.org", ""], ["", "/", "/en/x", "/en", "/es/", "/fr/1?q=/es/", "/EN/", "/ads/1"]
    told = [f"http://{h}{p}" for h in hosts for p in paths] + ["no scheme/en/", "", None, None, "x://a.com:80/en/#f", "http://a.com/?u=http://net/es/", "http://b.org/ads/\u212a", "http://spam\u212a.org/"]
    pages = spark.createDataFrame(list(enumerate(told)), "page_id long, url string")
    rules = urls.default_rules()
    got = {r.page_id: r for r in urls.judge(pages, rules).collect()}
    assert len(got) == len(told)
    for k, u in enumerate(told):
        after = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match("[^/?#]*", after)[0]
        path = re.match("[^?#]*", after[len(host) :])[0]
        tail, host = after[len(host) :], re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [(len(h + p), h + p, v) for v, h, p in urls.SITE_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        body = host + tail
        other = "block" if u and any(re.search(r.pattern.replace("(?s:.*)", "[\\s\\S]*"), body) for r in rules if r.rank == 0) else "allow"
        assert (got[k].host, got[k].path) == (host, path)
        assert (got[k].rule, got[k].verdict) == ((max(fits)[1], max(fits)[2]) if fits else (None, other)), u


def test_wildcard_tokens_are_whole():
    assert urls.wildcard_rule("block", "/ads/*banner^x").tokens == ("ads",)
    assert urls.wildcard_rule("block", "||spam.").tokens == ("spam",)


# 4 near duplicates


def naive_print(text: str, size: int) -> int:
    import xxhash

    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints: dict) -> dict:
    up = {k: k for k in prints}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {k: find(k) for k in prints}


def test_simhash_equals_all_pairs(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in run("op4_simhash", spark, sf_dir).collect()}
    prints = {k: naive_print(v, 4) for k, v in texts.items()}
    assert {k: int(r.fingerprint, 16) for k, r in rows.items()} == prints
    assert {k: r.component_id for k, r in rows.items()} == classes(prints)


def test_pigeonhole_links_every_close_pair_and_chains(spark):
    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(25)]
    values = set(centres)
    for c in centres:
        x = c
        for _ in range(12):
            for b in rng.sample(range(64), 4):
                x ^= 1 << b
            values.add(x)
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "node long").withColumn("f", F.array("node"))
    links = simhash.block_links(df, simhash.pigeonhole_masks(4, 7), 4)
    roots = {r.node: r.root for r in components.connected_components(links).collect()}
    assert roots == {r.node: r.root for r in components.connected_components(links, few=0).collect()}
    want = classes({v: v for v in values})
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    for a, b in itertools.combinations(values, 2):
        same = roots.get(signed[a], signed[a]) == roots.get(signed[b], signed[b])
        assert same == (want[a] == want[b])


def test_simhash_edge_rows(awkward, empty):
    assert simhash.near_duplicates(empty).count() == 0
    out = simhash.near_duplicates(awkward).collect()
    assert len(out) == len(AWKWARD)
    assert {r.f[0] for r in out if r.doc_id in (3, 4)} == {0}
    assert {r.component_id for r in out if r.doc_id in (1, 2)} == {1}


def test_keep_one_keeps_one_of_each_group(awkward, empty, spark):
    assert simhash.keep_one(empty).count() == 0
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(x for x in ids if x) == [1, 3, 5, 5, 6, 7] and ids.count(None) == 1


def test_near_copies_of_similarity_point_eight(spark, documents, texts):
    grams = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k, v in texts.items() if len(w := v.lower().split()) >= 40}
    close = [(a, b) for a, b in itertools.combinations(sorted(grams), 2) if texts[a] != texts[b] and 10 * len(grams[a] & grams[b]) >= 8 * len(grams[a] | grams[b])]
    found = {r.doc_id: r.component_id for r in simhash.similar_sets(documents).collect()}
    assert close and all(found[a] == found[b] for a, b in close)
    far = [(a, b) for a, b in itertools.combinations(sorted(grams), 2) if not grams[a] & grams[b] and found[a] == found[b]]
    assert not far


def test_thousands_of_planted_near_copies_are_all_found(spark):
    rng = random.Random(21)
    pairs = []
    for k in range(3000):
        words = [f"p{rng.randrange(10**7)}" for _ in range(rng.randint(20, 120))]
        other = list(words)
        at = rng.randrange(5, len(words) - 5)
        for j in range(max(1, int((len(words) - 4) * rng.uniform(0, 0.11)) - 4)):  # neighbours share the shingles they touch
            other[min(at + j, len(words) - 1)] = f"q{rng.randrange(10**7)}"
        pairs.append((" ".join(words), " ".join(other)))
    near = [10 * len(a & b) >= 8 * len(a | b) for a, b in ((shingle_set(x), shingle_set(y)) for x, y in pairs)]
    docs = spark.createDataFrame([(2 * k + j, p[j], "en", "s", 0) for k, p in enumerate(pairs) for j in (0, 1)], DDL)
    found = {r.doc_id: r.component_id for r in simhash.similar_sets(docs).collect()}
    assert sum(near) > 2000
    assert [found[2 * k] == found[2 * k + 1] for k in range(len(pairs))] == near


def test_large_groups_dealt_out_are_the_same(spark):
    rng = random.Random(13)
    base = [f"b{rng.randrange(10**6)}" for _ in range(60)]
    sets = []
    for k in range(400):  # a family around one text: some near it, some only near each other, some near none
        words = list(base)
        for j in rng.sample(range(60), rng.choice((0, 1, 2, 3, 6, 9))):
            words[j] = f"c{rng.randrange(40)}"
        sets.append(np.unique(simhash.shingle_hashes(" ".join(words), 5, simhash.SEED)))
    rows = [(k, k // 200, s.view(np.int64).tolist()) for k, s in enumerate(sets)]
    members = cut(spark.createDataFrame(rows, "node long, root long, s array<long>"), "members")
    as_sets = [set(s.tolist()) for s in sets]
    want = {}
    for lo in (0, 200):
        want |= {lo + k: lo + int(v) for k, v in enumerate(simhash.exact_roots(sets[lo : lo + 200]))}
    for a, b in itertools.combinations(range(400), 2):  # roots part what all pairs part
        if a // 200 == b // 200 and 10 * len(as_sets[a] & as_sets[b]) >= 8 * len(as_sets[a] | as_sets[b]):
            assert want[a] == want[b]
    for most in (10**6, 3_000, 500):
        links = simhash.exact_links(members, most).select(F.col("node").alias("u"), F.col("root").alias("v"))
        got = {r.node: r.root for r in components.connected_components(links).collect()}
        assert {k: got.get(k, k) for k in want} == want, most


def test_large_blocks_lose_no_pair():
    rng = np.random.default_rng(4)
    few = rng.integers(0, 2**63, 1, np.uint64) ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 40, (6000, 7)).astype(np.uint64), axis=1)
    prints = np.unique(few)[:, None]
    nodes = np.arange(len(prints))
    assert len(nodes) > simhash.LARGE

    def groups(pairs):
        up = np.arange(len(nodes))
        for _ in range(60):
            for u, v in zip(*pairs, strict=True):
                up[u] = up[v] = min(up[u], up[v])
            up = up[up]
        return up

    assert (groups(simhash.block_pairs(prints, nodes, 4)) == groups(simhash.star_links(prints, nodes, 4))).all()


def test_hash_sets_miss_nothing(spark):
    rng = np.random.default_rng(9)
    h = rng.integers(-(2**63), 2**63 - 1, 5000)
    held = HashSet(spark.createDataFrame([(int(x),) for x in h], "h long"), len(h))
    assert held.has(h.view(np.uint64)).all()
    assert held.has(rng.integers(0, 2**63, 20_000, np.uint64) * np.uint64(2)).mean() < 0.1


def test_hot_keys_join_apart(spark):
    rows = cut(spark.createDataFrame([(0 if k % 3 else k, k) for k in range(6000)], "node long, x long"), "rows")
    found = cut(rows.select("node").distinct().where("node % 2 = 0").withColumn("m", F.col("node") * 2), "found")
    for how in ("inner", "left", "left_anti"):
        a = join_hot(rows, found, "node", how, few=0)
        b = rows.join(found, "node", how)
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def shingle_set(text, size=5):
    w = text.lower().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}


def kept_by_all_pairs(texts):
    """Ids that stay when texts are linked at Jaccard 0.8 or more of distinct shingles."""
    sets, up = [shingle_set(t) for t in texts], list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return [k for k in range(len(texts)) if find(k) == k]


def varied_texts():
    """Groups of texts around 0.8 and well below it, short ones and ones with repeated lines."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(10**6)}"
    texts = []
    for n in (5, 8, 9, 10, 12, 14, 20, 60, 300):
        for changed in (1, 2, 3, 5, 8):
            base = [word() for _ in range(n)]
            other, end = list(base), list(base)
            for k in rng.sample(range(n), min(changed, n)):
                other[k] = word()
            end[-min(changed, n) :] = [word() for _ in range(min(changed, n))]
            texts += [" ".join(x) for x in (base, other, end, [*base, word()], base[1:])]
    line = [word() for _ in range(6)]
    texts += [" ".join(line * 30 + [word() for _ in range(40)]) for _ in range(4)]
    return texts


def test_keep_one_drops_nothing_below_point_eight(spark):
    texts = varied_texts()
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], DDL)
    kept = {r.doc_id for r in simhash.keep_one(docs).collect()}
    assert set(kept_by_all_pairs(texts)) <= kept


def test_keep_one_equals_all_pairs_at_point_eight(spark):
    texts = varied_texts()
    rng = random.Random(12)
    for n in (8, 9, 10, 13, 14, 24, 44, 104):  # n - 4 shingles; four in five of them stay
        for _ in range(12):
            base = [f"x{rng.randrange(10**6)}" for _ in range(n)]
            texts += [" ".join(base), " ".join([*base, *[f"x{rng.randrange(10**6)}" for _ in range((n - 4) // 4)]])]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], DDL)
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == kept_by_all_pairs(texts)


def test_prefixes_of_similar_sets_meet_whatever_is_common():
    rng = np.random.default_rng(5)
    for n in range(1, 80):
        big = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        small = np.sort(rng.permutation(big)[: -(-4 * n // 5)])
        for common in (big[:0], big[::3], big):
            assert np.intersect1d(simhash.prefix_of(big, common), simhash.prefix_of(small, common)).size
            assert np.intersect1d(simhash.prefix_of(big, common, 2), simhash.prefix_of(small, common, 2)).size >= min(2, len(small))


def test_blocks_of_common_shingles_are_dealt_out_without_a_loss(spark):
    rng = random.Random(31)
    lines = [" ".join(f"c{rng.randrange(10**6)}" for _ in range(12)) for _ in range(4)]
    texts = varied_texts()
    for _ in range(60):  # most of each text is lines that all have
        own = [f"o{rng.randrange(10**6)}" for _ in range(rng.choice((4, 8, 16)))]
        texts += [" ".join([*rng.sample(lines, 3), *own]), " ".join([*rng.sample(lines, 4), *own])]
    docs = cut(spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], DDL), "hot-texts")
    want = kept_by_all_pairs(texts)
    for block in (1, 3, 10_000):
        assert sorted(r.doc_id for r in simhash.similar_sets(docs, block=block).where("keeper").collect()) == want


# 5 mixing


def test_mix_meets_targets_with_ties_nulls_and_zero_sources(spark):
    rng = random.Random(4)
    rows = [(k, "w " * rng.randint(0, 90), "en", rng.choice("abc"), 0) for k in range(900)] + [(77_777, "x y z", "en", "d", 0)] * 300 + [(9_000, "", "en", "zero", 0), (None, None, None, None, None), (9_001, "u v", None, None, 0)]
    out = mixing.mix(spark.createDataFrame(rows, DDL)).collect()
    assert len(out) == len(rows)
    by = defaultdict(list)
    for r in out:
        assert 0 <= r.taken <= 2 * r.size
        by[r.source].append(r)
    assert sum(x[0].target for x in by.values()) == pytest.approx(1.5 * sum(r.size for r in out))
    for source, rs in by.items():
        assert rs[0].source_size == sum(r.size for r in rs)
        assert rs[0].target <= 2 * rs[0].source_size
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= (300 if source == "d" else 91)


def test_targets_equal_repeated_resharing(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 400, "e": 0, None: 77}
    out = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    order = sorted((k for k in sizes if k is not None)) + [None]
    w = {k: (3, 1, 2)[i % 3] for i, k in enumerate(order)}
    want, open_, left = {}, set(sizes), 1.5 * sum(sizes.values())
    while open_:
        unit = left / sum(w[k] for k in open_)
        over = {k for k in open_ if unit * w[k] > 2 * sizes[k]}
        if not over:
            want |= {k: unit * w[k] for k in open_}
            break
        want |= {k: 2.0 * sizes[k] for k in over}
        left -= sum(2 * sizes[k] for k in over)
        open_ -= over
    assert out == pytest.approx(want)


def test_mix_edge_rows(awkward, empty):
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(awkward).count() == len(AWKWARD)


# 6 quality


def test_quality_on_held_out_labels(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # the smallest has 19 held-out labels
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = run("op6_quality", spark, sf_dir).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (crc(r.doc_id) == 0) for r in rows) and held
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    assert sum(r.predicted == r.quality for r in held) >= 0.9 * len(held)


def test_discriminant_equals_the_textbook(spark):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(0, 1, (300, 13)), rng.normal(0.8, 1.5, (500, 13))])
    y = [0] * 300 + [1] * 500
    model = quality.fit(spark.createDataFrame([(a.tolist(), b) for a, b in zip(x, y, strict=True)], "x array<double>, y int"))
    logs, pooled = [], (np.cov(x[:300].T, bias=True) * 300 + np.cov(x[300:].T, bias=True) * 500) / 800
    for part in (x[:300], x[300:]):
        cov = (1 - quality.POOLED) * np.cov(part.T, bias=True) + quality.POOLED * pooled
        cov = (1 - quality.RIDGE) * cov + quality.RIDGE * (np.diag(np.diag(pooled)) + 1e-9 * np.eye(13))
        d = x - part.mean(axis=0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) - 0.5 * np.linalg.slogdet(cov)[1])
    want = 1 / (1 + np.exp(-(logs[1] - logs[0] + np.log(500 / 300)) / quality.TEMPERATURE))
    assert np.allclose(model.score(x), want)


def test_quality_edge_rows(awkward, empty, spark):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    assert quality.reject_low_quality(empty, labels).count() == 0
    kept = quality.reject_low_quality(awkward, labels)
    assert kept.columns == awkward.columns and kept.count() <= len(AWKWARD)
    none = quality.reject_low_quality(awkward, labels.where("false"))
    assert none.count() == len(AWKWARD)
    assert all(math.isfinite(v) for t in ("", " ", "\n", "!", LONG, "é") for v in quality.statistics(t))


# 7 decontamination


def overlaps_by_force(text: str, item: str) -> bool:
    a, b = decontaminate.tokens(text), decontaminate.tokens(item)
    w = min(decontaminate.WINDOW, len(b))
    if not w:
        return False
    for shift in range(-(len(b) - w), len(a) - w + 1):
        equal = [0 <= i + shift < len(a) and a[i + shift] == b[i] for i in range(len(b))]
        inside = [0 <= i + shift < len(a) for i in range(len(b))]
        for i in range(len(b) - w + 1):
            if all(inside[i : i + w]) and sum(equal[i : i + w]) >= w - decontaminate.allowed(w):
                return True
    return False


def test_decontamination_equals_all_alignments(spark):
    rng = random.Random(8)
    vocab = [f"w{k}" for k in range(40)]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.choice((3, 6, 10, 14, 25))))) for k in range(12)] + [(50, ""), (51, None), (0, "again the same id with other words in it for once, yes")]
    docs = []
    for k in range(120):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 60))]
        if k % 2:
            t = (rng.choice(items)[1] or "").split()
            for _ in range(rng.randint(0, 4)):
                if t:
                    t[rng.randrange(len(t))] = "other"
            at = rng.randint(0, len(words))
            words[at:at] = t[: rng.randint(len(t) // 2, len(t))] if t else []
        docs.append((k, " ".join(words).upper() if k % 3 == 0 else ", ".join(words)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = {r.doc_id: [h.item_id for h in r.hits] for r in decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    for k, t in docs:
        assert out[k] == sorted(i for i, x in items if overlaps_by_force(t, x or "")), (k, t)


def hits_by_force(text: str, items: list[tuple[int, str]]) -> list[tuple]:
    """Each overlapped item with the tokens that its best alignment matches, and where that begins."""
    a, out = decontaminate.tokens(text), []
    for item_id, x in items:
        b = decontaminate.tokens(x or "")
        w, best = min(decontaminate.WINDOW, len(b)), (0, 0)
        for shift in range(-(len(b) - w), len(a) - w + 1) if w else ():
            equal = [0 <= i + shift < len(a) and a[i + shift] == b[i] for i in range(len(b))]
            good = [i for i in range(len(b) - w + 1) if 0 <= i + shift and i + w + shift <= len(a) and sum(equal[i : i + w]) >= w - decontaminate.allowed(w)]
            inside = {j for i in good for j in range(i, i + w) if equal[j]}
            if good:
                best = max(best, (len(inside), -(good[0] + shift)))
        if best[0]:
            out.append((item_id, best[0], len(b), -best[1]))
    return sorted(out)


def test_decontamination_hits_equal_all_alignments(spark, monkeypatch):
    rng = random.Random(18)
    items = [(k, " ".join(rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(rng.choice((2, 5, 9, 13, 20, 40))))) for k in range(15)]
    docs = []
    for k in range(60):
        parts = [rng.choice(items)[1].split() for _ in range(2)]
        for t in parts:
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = "other"
        docs.append((k, " ".join(["filler"] * rng.randint(0, 9) + parts[0] + ["between"] * rng.randint(0, 3) + parts[1])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = {k: hits_by_force(t, items) for k, t in docs}
    assert {r.doc_id: [tuple(h) for h in r.hits] for r in decontaminate.overlaps(df, bench).collect()} == want
    # a short bit array lets many seeds pass: the same rows by the join alone
    monkeypatch.setattr(decontaminate, "HashSet", lambda hashes, count: HashSet(hashes, count, most=6))
    assert {r.doc_id: [tuple(h) for h in r.hits] for r in decontaminate.overlaps(df, bench).collect()} == want


@pytest.mark.parametrize("n", range(1, 16))
def test_masks_lose_no_allowed_substitution(n):
    masks = decontaminate.masks_of(n)
    w = min(n, decontaminate.WINDOW)
    places = [{o + i for i in m} for m in masks for o in range(w - m[-1])]
    assert all(any(not p & set(bad) for p in places) for bad in itertools.combinations(range(w), decontaminate.allowed(w)))


def test_decontamination_edge_rows(awkward, empty, spark):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog"), (None, None)], "item_id long, text string")
    assert decontaminate.overlaps(empty, bench).count() == 0
    kept = decontaminate.remove_contaminated(awkward, bench)
    assert kept.columns == awkward.columns and kept.count() == len(AWKWARD) - 2
    assert decontaminate.remove_contaminated(awkward, bench.where("false")).count() == len(AWKWARD)


# 8 fingerprints


def test_fingerprints_and_edits(spark, sf_dir, texts, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_CHARS", 50_000)
    rows = {r.doc_id: r for r in run("op8_fingerprints", spark, sf_dir).collect()}
    order = sorted(texts, reverse=True)
    assert sorted(rows) == sorted(texts)
    for k, after in zip(order, [*order[1:], order[0]], strict=True):
        edited = fingerprints.edit(texts[k], texts[after])
        r = rows[k]
        assert (r.n_chars, r.edited_sha256) == (len(texts[k]), hashlib.sha256(edited.encode()).hexdigest())
        agree = next((i for i, (a, b) in enumerate(zip(texts[k], edited, strict=False)) if a != b), min(len(edited), r.n_chars))
        assert r.lce_edited == agree
    by_text = defaultdict(set)
    for k, t in texts.items():
        by_text[t].add(rows[k].fingerprint)
    assert all(len(x) == 1 for x in by_text.values()) and len({x for s in by_text.values() for x in s}) == len(by_text)
    assert 0.4 < np.mean([r.near_edited for r in rows.values()]) < 0.6
    assert np.mean([r.near_next for r in rows.values()]) < 0.05


def test_span_hashes_agree_wherever_spans_stand():
    rng = random.Random(3)
    a = fingerprints.PrefixHash("".join(rng.choice("ab𝒳") for _ in range(300)))
    b = fingerprints.PrefixHash("zz" + a.text[40:200] + "y")
    assert a.span(40, 200) == b.span(2, 162) and a.span(40, 199) != b.span(2, 162)
    assert a.common_extension(b, 40, 2) >= 160 and a.common_extension(a) == 300
    for i in range(0, 290, 7):
        for j in range(i + 1, min(300, i + 9)):
            k = a.text.find(a.text[i:j])
            assert a.span(i, j) == a.span(k, k + j - i)


def test_short_texts_are_comparable():
    rng = random.Random(7)
    text = "".join(rng.choice("abcdefghij ") for _ in range(60))
    prints = {n: fingerprints.PrefixHash(text[:n]).fingerprint() for n in range(1, 61)}
    for n in range(40, 60):
        assert fingerprints.likeness(prints[60], prints[n]) == pytest.approx(2 * (n - 3) / (57 + n - 3), abs=0.2)
    longer = "".join(rng.choice("abcdefghij ") for _ in range(30))
    assert fingerprints.likeness(prints[60], fingerprints.PrefixHash(text + longer).fingerprint()) > 0.6
    assert fingerprints.likeness(prints[60], fingerprints.PrefixHash(text[::-1]).fingerprint()) < 0.2


def test_extension_survives_equal_hashes(monkeypatch):
    a, b = fingerprints.PrefixHash("same start, one end"), fingerprints.PrefixHash("same start, two end")
    monkeypatch.setattr(fingerprints.PrefixHash, "span", lambda self, start, stop: 0)
    assert a.common_extension(b) == 12


def test_rows_without_an_id_part_into_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_CHARS", 2_000)
    rng = random.Random(17)
    rows = [(None if k % 3 == 0 else 5 if k % 3 == 1 else k, "".join(rng.choice("abc ") for _ in range(100))) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spread = fingerprints.in_order(df).where("ghost = 0").groupBy("bucket").count().collect()
    assert max(r["count"] for r in spread) < 60
    tie = {t: h for t, h in df.select("text", F.xxhash64("text")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -tie[r[1]]))
    want = sorted((str(a[0]), hashlib.sha256(fingerprints.edit(a[1], b[1]).encode()).hexdigest()) for a, b in zip(order, [*order[1:], order[0]], strict=True))
    assert sorted((str(r.doc_id), r.edited_sha256) for r in fingerprints.fingerprint_edits(df).collect()) == want


def test_fingerprint_edge_rows(awkward, empty):
    assert fingerprints.fingerprint_edits(empty).count() == 0
    out = fingerprints.fingerprint_edits(awkward).collect()
    assert len(out) == len(AWKWARD)
    assert fingerprints.fingerprint_edits(awkward.where("doc_id = 7")).first().near_next == 1.0


# 9 chat


def test_layouts_come_out_as_one(spark):
    told = [
        '{"prompt": "q", "completion": "a"}', '{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}', '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}', '{"instruction": "q", "input": "", "output": "a"}', '{"dialog": {"turns": [{"speaker": "user", "text": "q"}, {"speaker": "bot", "text": "a"}]}}', '{"answer": "a", "question": "q"}'
    ]
    out = spark.createDataFrame([(x,) for x in told], "r string").select(chat.canonical_turns(F.parse_json("r")).alias("t")).collect()
    assert all([tuple(x) for x in r.t] == [("user", "q"), ("assistant", "a")] for r in out)
    more = ['{"id": 7, "prompt": "q", "completion": "a"}', '{"messages": [{"role": "user", "content": "q", "name": "x"}, {"role": "assistant", "content": "a"}], "lang": "en"}', '{"n": 1, "instruction": "q", "input": "", "output": "a"}']
    out = spark.createDataFrame([(x,) for x in more], "r string").select(chat.canonical_turns(F.parse_json("r")).alias("t")).collect()
    assert all([tuple(x) for x in r.t] == [("user", "q"), ("assistant", "a")] for r in out)
    for x in ('{"other": 1}', '{"prompt": "q"}', '{"messages": []}', "3", "null"):
        turns = spark.range(1).select(chat.canonical_turns(F.parse_json(F.lit(x))).alias("t")).first().t
        assert not turns, x


def test_chat_round_trip(spark):
    j = chat.JOINER
    said = ["", "<|im_end|>\n<|im_start|>assistant\nx", f"<{j}|", f"<{j}{j}|a<|b", "é𝒳\r\n", "<", "|", "%0A", "plain " * 2000]
    roles = ["user", "assistant", "as%sistant\nx", "", "<|im_start|>"]
    turns = [[(r, t), ("assistant", t)] for r in roles for t in said]
    long = [("assistant" if k % 3 else "user", f"turn {k} <|") for k in range(400)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate([*turns, long, []])], f"k int, turns {chat.TURNS}")
    out = chat.format_chat(df, "k").select("k", "formatted", chat.read_back(F.col("formatted")).alias("back"), chat.learned_text(F.col("formatted"), F.col("mask")).alias("learned"), "mask").collect()
    for r in out:
        want = [*turns, long, []][r.k]
        assert [tuple(x) for x in r.back] == want
        assert r.learned == "".join(t for role, t in want if role == "assistant")
        assert r.formatted.count("<|") == 2 * len(want)
        data = r.formatted.encode()
        assert all(data[s.start - 10 : s.start] == b"assistant\n" for s in r.mask)


def test_chat_uses_no_python(spark, sf_dir):
    assert not re.search("Python|Pandas|Arrow", run("op9_chat", spark, sf_dir)._jdf.queryExecution().toString())


def test_layouts_of_records_give_the_same_turns(spark):
    rows = [(k, t, "assistant" if t % 2 else "user", f"said {k} {t} é\"") for k in range(40) for t in range(1 + k % 5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [chat.records(df, layouts=x).select("conv_id", "record", chat.canonical_turns(F.parse_json("record"), rename_roles=False).alias("t")).collect() for x in (False, True)]
    assert {r.conv_id: r.t for r in got[0]} == {r.conv_id: r.t for r in got[1]}
    assert len({r.record.split(":")[0] for r in got[1]}) == 4


def test_a_very_long_text_is_formatted(spark):
    df = spark.createDataFrame([(1, 0, "assistant", LONG * 10)], "conv_id long, turn long, role string, text string")
    turns = chat.records(df).select("conv_id", chat.canonical_turns(F.parse_json("record")).alias("turns"))
    assert chat.format_chat(turns, "conv_id").select(chat.learned_text(F.col("formatted"), F.col("mask")).alias("x")).first().x == LONG * 10


def test_chat_edge_rows(spark):
    rows = [(1, 1, "assistant", None), (1, 0, None, "x"), (1, 0, None, "x"), (None, None, None, None), (2, None, "user", ""), (2, 5, "assistant", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r.record for r in chat.records(df).collect()}
    assert got[1] == '{"messages":[{"role":"","content":"x"},{"role":"","content":"x"},{"role":"assistant","content":""}]}'
    assert got[None] == '{"messages":[{"role":"","content":""}]}' and got[2].index('"user"') < got[2].index('"assistant"')
    assert chat.records(df.where("false")).count() == 0


# 10 tokens


@pytest.fixture(scope="module")
def model_path():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path


def test_counts_equal_the_library(spark, awkward, empty, model_path, tmp_path_factory):
    import sentencepiece

    whole = sentencepiece.SentencePieceProcessor(model_file=model_path("piece_bpe_32k.model"))
    rng = random.Random(6)
    counter = tokens.PieceCounter(model_path("piece_bpe_32k.model"))
    hard = ["", " ", "  a", "a  b ", "▁x▁", "\n\n a\tb", "<s> x </s>", "ａ①ﬁ", "\u3000x", LONG] + ["".join(rng.choice(" ab▁é\n\t1<>｡") for _ in range(rng.randint(1, 60))) for _ in range(500)]
    assert counter.count(hard) == [len(whole.encode(x)) for x in hard]
    cache = f"file://{tmp_path_factory.mktemp('cache')}/counts"
    out = tokens.count_tokens(awkward, model_path("piece_bpe_32k.model"), cache).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in out) == sorted((d or 0, len((t or "").encode()), len(whole.encode(t or ""))) for d, t, *_ in AWKWARD)
    assert tokens.count_tokens(empty, model_path("piece_bpe_32k.model"), cache).count() == 0


def test_only_distinct_misses_are_encoded_and_appended(spark, model_path, tmp_path):
    cache, path = f"file://{tmp_path}/counts", model_path("piece_bpe_32k.model")
    df = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c")], "doc_id long, text string")
    tokens.count_tokens(df.where("doc_id < 3"), path, cache).count()
    assert spark.read.parquet(cache).count() == 1
    assert tokens.count_tokens(df, path, cache).count() == 3
    assert spark.read.parquet(cache).count() == 2
    other = model_path("byte_bpe_50k.json")
    assert {r.doc_id: r.n_tokens for r in tokens.count_tokens(df, other, cache).collect()} == dict(zip((1, 2, 3), tokens.JsonCounter(other).count(["a b", "a b", "c"]), strict=True))
    assert spark.read.parquet(cache).count() == 4


def test_urls_of_any_length(spark):
    long = "http://spam." + "a" * 50_000 + ".com/" + "b/" * 20_000 + "?q=1"
    pages = spark.createDataFrame([(1, long), (2, None), (3, ""), (4, "http://x.net/fr/" + "z" * 60_000), (5, long)], "page_id long, url string").withColumn("token", F.lit("com")).withColumn("best", F.lit(1)).withColumn("host", F.lit("h"))
    out = {r.page_id: (len(r.host), r.rule, r.verdict) for r in urls.judge(pages, urls.default_rules()).collect()}
    assert out[1] == out[5] == (50_009, "com/", "allow") and out[2] == out[3] == (0, None, "allow") and out[4] == (5, "net/fr/", "block")


def test_conversations_with_clashing_columns(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "ok"), (2, 0, "assistant", None)]
    plain = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    more = plain
    for name in ("record", "turns", "mask", "formatted", "messages", "content", "key"):
        more = more.withColumn(name, F.lit(name))
    told = lambda df: sorted((r.conv_id, r.record) for r in chat.records(df).collect())
    assert told(more) == told(plain)


def test_empty_tables_of_mixing_and_decontamination(spark, empty, awkward):
    assert mixing.mix(empty).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.remove_contaminated(empty, none).count() == 0
    assert decontaminate.remove_contaminated(awkward, none).count() == len(AWKWARD)


def test_equal_texts_score_alike(spark, awkward):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (5, 0, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    kept = [r.doc_id for r in quality.reject_low_quality(awkward, labels).collect()]
    assert kept.count(1) == kept.count(2) and kept.count(5) in (0, 2, 3)
