"""SimHash near-duplicates by pigeonhole blocks (operator 4)."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import FEW, cut, fresh, join_hot, table, text_of, text_slices
from .components import connected_components

SEED = 42
#: Shingles whose bits are counted at once.
CHUNK = 32_768
#: Fingerprints of a block beyond which it is divided once more.
LARGE = 4_096
#: Shingles of a group of candidates that one task decides on; larger groups are dealt out in parts.
MOST_SHINGLES = 2_000_000
#: Members of a large group that go to each of its parts.
PIVOTS = 8
#: One set in so many tells which shingles many sets have.
SAMPLED = 64
#: Bytes of text whose sets of shingles a task holds at once.
SLICE = 2 << 20


def rank() -> Column:
    """Order of rows in a component: known ids before null ones."""
    return F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "tie")


def shingle_hashes(text: str, size: int, seed: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words, A-Z lower-cased and space-joined."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: len(words) - size].tolist()]
    stops = (ends[size - 1 :] - 1).tolist() if len(words) >= size else [len(joined)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, stops, strict=False)), np.uint64, len(stops))


def fold_bits(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes set, as a signed 64-bit number."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), CHUNK):
        ones += np.unpackbits(hashes[k : k + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def remixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """A further 64 bits for each hash, independent of the first for all practical purposes."""
    if not k:
        return hashes
    x = hashes + np.uint64(0x9E3779B97F4A7C15) * np.uint64(k)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bits(text: str, size: int, words: int) -> list[int]:
    """A text's fingerprint, 64 bits to a word."""
    hashes = shingle_hashes(text, size, SEED)
    return [fold_bits(remixed(hashes, k)) for k in range(words)]


def fingerprints(size: int, words: int):
    """Arrow UDF: text to an array of ``words`` 64-bit fingerprints."""

    @F.arrow_udf("array<bigint>")
    def simhash(texts: pa.Array) -> pa.Array:
        flat = np.fromiter((v for x in texts for v in text_bits(x.as_py(), size, words)), np.int64, len(texts) * words)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, words), pa.int32()), pa.array(flat))

    return simhash


def pigeonhole_masks(max_bits: int, blocks: int) -> list[tuple[int, ...]]:
    """One mask for each choice of ``blocks - max_bits`` of the blocks of 64 bits.

    ``max_bits`` differing bits touch at most as many blocks; the others agree,
    and one of the masks covers just blocks that agree: no close pair is lost.
    """
    if blocks <= max_bits:
        raise ValueError("more blocks than differing bits are needed")
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    each = [sum(1 << b for b in range(lo, hi)) for lo, hi in itertools.pairwise(edges)]
    return [(sum(pick),) for pick in itertools.combinations(each, blocks - max_bits)]


def star_links(prints: np.ndarray, nodes: np.ndarray, max_bits: int) -> tuple[list[int], list[int]]:
    """Links that connect what is close within one block, at most one for each node.

    Grows each component from its first fingerprint: whatever is reached leaves
    the candidates, so that a block of many copies needs few rounds and emits a
    star, not all its pairs. Memory follows the block's distinct fingerprints.
    """
    us, vs = [], []
    left = np.arange(len(nodes))
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = [root]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count(prints[left] ^ prints[x]).sum(axis=1) <= max_bits
            reached = left[near]
            if len(reached):
                us += [int(nodes[root])] * len(reached)
                vs += nodes[reached].tolist()
                front += reached.tolist()
                left = left[~near]
    return us, vs


def block_pairs(prints: np.ndarray, nodes: np.ndarray, max_bits: int) -> tuple[list[int], list[int]]:
    """The links of ``star_links``, of large blocks by pigeonhole once more.

    The bits that differ within the block fall into three more parts than
    may differ: close pairs agree in three of them, so that only fingerprints
    which do are held against each other, however many a block has.
    """
    if len(nodes) <= LARGE or prints.shape[1] > 1:
        return star_links(prints, nodes, max_bits)
    free = np.flatnonzero(np.unpackbits(np.array([np.bitwise_or.reduce(prints[:, 0] ^ prints[0, 0])]).view(np.uint8), bitorder="little"))
    if len(free) < max_bits + 3:
        return star_links(prints, nodes, max_bits)
    parts = [sum(1 << int(b) for b in p) for p in np.array_split(free, max_bits + 3)]
    us, vs = [], []
    for pick in itertools.combinations(parts, 3):
        key = prints[:, 0] & np.uint64(sum(pick))
        order = np.argsort(key, kind="stable")
        edges = np.flatnonzero(np.diff(key[order])) + 1
        for same in np.split(order, edges):
            if len(same) > 1:
                u, v = star_links(prints[same], nodes[same], max_bits)
                us += u
                vs += v
    return us, vs


def block_links(prints: DataFrame, masks: list[tuple[int, ...]], max_bits: int) -> DataFrame:
    """``prints(node, f: array<bigint>)``, distinct, to links ``(u, v)`` of close ones.

    Rows join on block values: each goes out once for each mask under a hash of
    what it keeps, rows of a hash stand together after one shuffle and sort,
    and Hamming distances are verified there.
    """
    words = len(masks[0])
    cols = [F.col("f")[w].alias(f"f{w}") for w in range(words)]
    # masks are constant rows: one small expression, however many there are
    kept = F.array(*[F.array(F.lit(t).cast("long"), *[F.lit(_signed(m)).cast("long") for m in mask]) for t, mask in enumerate(masks)])
    rows = prints.select("node", *cols).select("node", *[f"f{w}" for w in range(words)], F.explode(kept).alias("m"))
    key = F.xxhash64(F.col("m")[0], *[F.col(f"f{w}").bitwiseAND(F.col("m")[w + 1]) for w in range(words)])
    return keyed_links(rows.select("node", *[f"f{w}" for w in range(words)], key.alias("k")), words, max_bits)


def keyed_links(rows: DataFrame, words: int, max_bits: int) -> DataFrame:
    """``rows(node, f0.., k)`` to links ``(u, v)`` of close ones among those of the same ``k``."""
    rows = rows.repartition("k").sortWithinPartitions("k")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def blocks(part: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            k, node, f = (np.concatenate([p[i] for p in part]) for i in range(3))
            cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
            starts, stops = np.r_[0, cuts], np.r_[cuts, len(k)]
            long = stops - starts
            us, vs = [], []
            two = starts[long == 2]
            two = two[np.bitwise_count(f[two] ^ f[two + 1]).sum(axis=1) <= max_bits]
            us, vs = node[two].tolist(), node[two + 1].tolist()
            for a, b in zip(starts[long > 2], stops[long > 2], strict=True):
                u, v = block_pairs(f[a:b], node[a:b], max_bits)
                us += u
                vs += v
            yield pa.RecordBatch.from_pydict({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

        for batch in batches:
            if not batch.num_rows:
                continue
            k = batch.column("k").to_numpy()
            node = batch.column("node").to_numpy()
            f = np.stack([batch.column(f"f{w}").to_numpy() for w in range(words)], axis=1).view(np.uint64)
            last = int(np.searchsorted(k, k[-1], "left")) if k[0] <= k[-1] else 0
            if last == 0 and held and held[-1][0][-1] == k[0]:
                held.append((k, node, f))
                continue
            if held or last:
                yield from blocks([*held, (k[:last], node[:last], f[:last])])
            held = [(k[last:], node[last:], f[last:])]
        if held:
            yield from blocks(held)

    return rows.mapInArrow(verify, "u bigint, v bigint").distinct()


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def near_duplicates(docs: DataFrame, size: int = 4, max_bits: int = 4, blocks: int = 7) -> DataFrame:
    """``(doc_id, tie, f, component_id, keeper)`` for every row of ``docs``.

    Fingerprints of whole texts over ``size``-word shingles, links at
    ``max_bits`` or fewer differing bits, and component_id, the smallest doc_id
    reachable. Copies share a fingerprint and count once in the join, so a
    group of copies makes no pairs; no link is lost. keeper marks the row with
    the component's smallest doc_id, of rows with that id the one with the
    smallest hash (tie) of its text. Null and empty texts have fingerprint
    zero; a null doc_id comes after all others; repeated rows each get their
    row; an empty table gives none. Further columns play no part.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("tie"), fingerprints(size, 1)(text_of()).alias("f"))
    narrow = cut(narrow.withColumn("node", F.col("f")[0]), "simhash")
    prints = cut(narrow.groupBy("node").agg(F.min(rank()).alias("least")), "prints")
    links = block_links(prints.select("node", F.array("node").alias("f")), pigeonhole_masks(max_bits, blocks), max_bits)
    return named(narrow, prints, connected_components(links)).select("doc_id", "tie", "f", "component_id", "keeper")


def named(narrow: DataFrame, prints: DataFrame, roots: DataFrame) -> DataFrame:
    """``narrow`` rows with their component's least row; ``prints(node, least)`` are in ``roots`` where they have a link."""
    most = prints.count()
    keep = (lambda df, tag: df) if most <= FEW else cut
    member = keep(prints.join(keep(roots, "roots"), "node", "left").select("node", "least", F.coalesce("root", "node").alias("root")), "members")
    least = keep(member.groupBy("root").agg(F.min("least").alias("least")), "least")
    found = keep(join_hot(member.select("node", "root"), least, "root", most=most).select("node", "least"), "components")
    rows = join_hot(narrow, found, "node", most=most)
    return rows.withColumn("component_id", F.col("least.doc_id")).withColumn("keeper", rank() == F.col("least"))


def prefix_of(hashes: np.ndarray, common: np.ndarray, shared: int = 1) -> np.ndarray:
    """The first shingles of a set, enough that any two sets of Jaccard index 0.8 or more have their first ``shared`` in common.

    Such sets share at least four fifths of either; in any one order of all
    shingles, the first one that they share is among their first
    n - ceil(4n / 5) + 1, the second one place further at most. Shingles known to be
    ``common`` (sorted) come last, which only keeps blocks small.
    """
    n = len(hashes)
    at = np.minimum(np.searchsorted(common, hashes), max(0, len(common) - 1))
    late = common[at] == hashes if len(common) else np.zeros(n, bool)
    return np.r_[hashes[~late], hashes[late]][: n - (4 * n + 4) // 5 + shared] if n else hashes


def common_shingles(docs: DataFrame, size: int, one_in: int = 32, least: int = 8, most: int = 20_000) -> np.ndarray:
    """Shingles that many of a sample of distinct texts have, sorted; they decide an order, never a link."""

    @F.arrow_udf("array<bigint>")
    def shingles(texts: pa.Array) -> pa.Array:
        return lists_of([np.unique(shingle_hashes(x.as_py(), size, SEED)).view(np.int64) for x in texts])

    texts = docs.select(text_of().alias("t")).where(F.pmod(F.xxhash64("t"), F.lit(one_in)) == 0).distinct()
    counts = texts.select(F.explode(shingles("t")).alias("h")).groupBy("h").count().where(F.col("count") >= least)
    found = counts.orderBy(F.col("count").desc(), "h").limit(most).select("h").collect()
    return np.sort(np.array([r.h for r in found], np.int64).view(np.uint64))


def set_sketches(docs: DataFrame, size: int, words: int, common: np.ndarray) -> DataFrame:
    """``(doc_id, tie, f, p, s)`` of every text: its fingerprint, the prefix of its shingle hashes that two near sets share two of, and all of them, distinct and sorted."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):  # sets of few texts at once
                sets = [np.unique(shingle_hashes(x.as_py(), size, SEED)) for x in part.column("text")]
                f = lists_of([np.array([fold_bits(remixed(h, k)) for k in range(words)], np.int64) for h in sets])
                first = lists_of([prefix_of(h, common, 2).view(np.int64) for h in sets])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("tie"), f, first, lists_of([h.view(np.int64) for h in sets])], ["doc_id", "tie", "f", "p", "s"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("tie"), text_of().alias("text"))
    return rows.mapInArrow(sketch, "doc_id bigint, tie bigint, f array<bigint>, p array<bigint>, s array<bigint>")


def lists_of(arrays: list[np.ndarray]) -> pa.ListArray:
    """Arrays of 64-bit numbers as one Arrow column."""
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*arrays, np.empty(0, np.int64)]), pa.int64()))


def exact_roots(sets: list[np.ndarray], fifths: int = 4) -> np.ndarray:
    """The first index that each set reaches over pairs of Jaccard index ``fifths`` / 5 or more.

    Counts common elements over postings; what is reached leaves the
    candidates. Where more are reached and not yet asked than are left, those
    left are asked instead, so that a group of near copies takes few rounds.
    """
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(ids, kind="stable")
    docs, bounds = owner[order], np.r_[0, np.cumsum(np.bincount(ids))]
    at = np.r_[0, np.cumsum(sizes)]
    root, left = np.full(len(sets), -1), np.ones(len(sets), bool)

    def near(x: int) -> np.ndarray:
        mine = ids[at[x] : at[x + 1]]
        lo, long = bounds[mine], bounds[mine + 1] - bounds[mine]
        picks = np.repeat(lo - np.r_[0, np.cumsum(long)[:-1]], long) + np.arange(long.sum())
        common = np.bincount(docs[picks], minlength=len(sets))
        # c / (a + b - c) >= k / 5, in whole numbers
        return ((5 + fifths) * common >= fifths * (sizes + sizes[x])) & (common > 0)

    for r in range(len(sets)):
        if not left[r]:
            continue
        root[r], left[r], front = r, False, [r]
        while front:
            rest = np.flatnonzero(left)
            if not len(rest):
                break
            if len(front) <= len(rest):
                found = np.flatnonzero(left & near(front.pop()))
                front += found.tolist()
            else:
                group = root == r
                found = np.array([y for y in rest if (near(y) & group).any()], int)
                front = found.tolist()
            root[found], left[found] = r, False
    return root


def exact_groups(members: DataFrame) -> DataFrame:
    """``members(node, root, s)`` to ``(node, root)``: each group of candidates split where no pair of sets is near enough."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, sets, now = [], [], None

        def done() -> pa.RecordBatch:
            ids = np.array(nodes, np.int64)
            return pa.RecordBatch.from_pydict({"node": pa.array(ids), "root": pa.array(ids[exact_roots(sets)])})

        for batch in batches:
            for node, root, s in zip(batch.column("node").to_pylist(), batch.column("root").to_pylist(), batch.column("s"), strict=True):
                if root != now and nodes:
                    yield done()
                    nodes, sets = [], []
                now = root
                nodes.append(node)
                sets.append(s.values.to_numpy(zero_copy_only=False))
        if nodes:
            yield done()

    return members.repartition("root").sortWithinPartitions("root").mapInArrow(split, "node bigint, root bigint")


def exact_links(members: DataFrame, most: int = MOST_SHINGLES) -> DataFrame:
    """``members(node, root, s)``, a written table, to ``(node, root)`` links whose components are those of all near pairs.

    A group of up to ``most`` shingles is decided in one task. Larger ones are
    dealt out: each part meets itself and the group's pivots, then whatever
    does not hang together with the group's largest component by then meets
    every part, each pair of parts in a task of its own. No pair of sets is
    passed over but within that component, where a link would say nothing new.
    """
    sizes = members.groupBy("root").agg(F.sum(F.size("s")).alias("total"))
    large = cut(sizes.where(F.col("total") > most), "large")
    if large.isEmpty():
        return exact_groups(members)
    own = large.select("root", F.ceil(F.col("total") / most).cast("int").alias("parts"))
    small = join_hot(members, own, "root", "left_anti")
    rows = cut(join_hot(members, own, "root"), "large-members")
    part = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    task = lambda *keys: F.xxhash64("root", *keys).alias("root")
    pivots = rows.groupBy("root", "parts", part(F.lit(PIVOTS)).alias("p")).agg(F.min_by(F.struct("node", "s"), F.xxhash64("node", F.lit(1))).alias("x"))
    pivots = pivots.select("root", "x.node", "x.s", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"))
    first = rows.select("root", "node", "s", part(F.col("parts")).alias("i")).unionByName(pivots)
    links = cut(exact_groups(small.select("node", "root", "s")).unionByName(exact_groups(first.select("node", task("i"), "s"))), "exact")
    sub = cut(connected_components(links.select(F.col("node").alias("u"), F.col("root").alias("v"))).withColumnRenamed("root", "sub"), "sub")
    state = cut(rows.join(sub, "node", "left").select("root", "node", "s", F.coalesce("sub", "node").alias("sub")), "large-state")
    counts = state.groupBy("root", "sub").agg(F.count("*").alias("n"), F.sum(F.size("s")).alias("total"))
    best = counts.groupBy("root").agg(F.max_by("sub", F.struct("n", "sub")).alias("best"), (F.sum("total") - F.max_by("total", F.struct("n", "sub"))).alias("open"), F.sum("total").alias("all"))
    best = cut(best.select("root", "best", F.ceil(F.col("open") / most).cast("int").alias("us"), F.ceil(F.col("all") / most).cast("int").alias("them")).where("us > 0"), "largest")
    rows = join_hot(state, best, "root")
    all_ = rows.select("root", "node", "s", F.explode(F.sequence(F.lit(0), F.col("us") - 1)).alias("i"), part(F.col("them")).alias("j"))
    open_ = rows.where("sub <> best").select("root", "node", "s", part(F.col("us")).alias("i"), F.explode(F.sequence(F.lit(0), F.col("them") - 1)).alias("j"))
    return links.unionByName(exact_groups(all_.unionByName(open_).select("node", task("i", "j"), "s")))


def prefix_blocks(narrow: DataFrame, words: int, most: int) -> DataFrame:
    """``narrow(node, f, p, s)``, a written table, to ``(node, f0.., k)``: distinct sets under a key that any two near ones share.

    A key is one of a set's first shingles. Where, by a sample of sets, more
    than ``most`` have it, they go under it together with each further shingle
    of their prefix: two near sets have the first two that they share in both
    prefixes, so they meet whether or not the first one is a key of many. The
    sample decides the size of blocks alone.
    """
    n = F.col("n")
    first = F.slice("p", 1, F.greatest(n - F.floor((4 * n + 4) / 5).cast("int") + 1, F.lit(0)))
    some = narrow.where(F.pmod(F.xxhash64("node"), F.lit(SAMPLED)) == 0).select("node", "p", F.size("s").alias("n")).dropDuplicates(["node"])
    hot = cut(some.select(F.explode(first).alias("k")).groupBy("k").count().where(F.col("count") * SAMPLED > most).select("k"), "hot-shingles")
    once = narrow.groupBy("node").agg(F.first("f").alias("f"), F.first("p").alias("p"), F.max(F.size("s")).alias("n"))
    f = [F.col("f")[w].alias(f"f{w}") for w in range(words)]
    rows = once.select("node", *f, F.explode(first).alias("k"))
    if hot.isEmpty():
        return rows
    apart = join_hot(once.select("node", *f, "p", F.explode(first).alias("k")), hot, "k")
    apart = apart.withColumn("next", F.explode("p")).where("next <> k").withColumn("k", F.xxhash64("k", "next"))
    return join_hot(rows, hot, "k", "left_anti").unionByName(apart.select(*rows.columns))


def similar_sets(docs: DataFrame, size: int = 5, words: int = 4, max_bits: int = 84, most: int = MOST_SHINGLES, block: int = LARGE) -> DataFrame:
    """``(doc_id, tie, component_id, keeper)``: groups linked by Jaccard index 0.8 or more of their distinct shingles.

    Sets meet in blocks of a shared prefix shingle, or of two where one is in
    the prefix of over ``block`` sets, which loses no pair. Within a block,
    fingerprints tell apart what has nothing in common: at 0.8 a bit differs
    with probability 0.19 at most (four of five shingles), so 84 of 256 bits
    are over five deviations away, for tables of any size. Whatever may be
    linked is then decided on whole sets.
    """
    common = common_shingles(docs, size)
    narrow = cut(set_sketches(docs, size, words, common).withColumn("node", F.xxhash64("s")), "sets")
    prints = cut(narrow.groupBy("node").agg(F.min(rank()).alias("least")), "prints")
    coarse = cut(connected_components(keyed_links(prefix_blocks(narrow, words, block), words, max_bits)), "candidates")
    sets = join_hot(narrow.select("node", "s"), coarse, "node").groupBy("node", "root").agg(F.first("s").alias("s"))
    links = exact_links(cut(sets, "candidate-sets"), most)
    roots = connected_components(links.select(F.col("node").alias("u"), F.col("root").alias("v")))
    return named(narrow.select("doc_id", "tie", "node"), prints, roots).select("doc_id", "tie", "component_id", "keeper")


def keep_one(docs: DataFrame, size: int = 5, words: int = 4, max_bits: int = 84) -> DataFrame:
    """One document of each near-duplicate group, with all its columns.

    Texts are linked at Jaccard index 0.8 or more of their distinct five-word
    shingles, counted on whole sets. Candidates share one of a set's first
    shingles and pass a wide limit on differing bits of their fingerprints.
    The keeper of each component stays, once, however often its row repeats.
    Null and empty texts are one group; a null doc_id comes after all others;
    an empty table gives no rows; columns of any name stay.
    """
    found = cut(similar_sets(docs, size, words, max_bits), "keepers")
    its_id, its_tie = fresh(docs, "keeper_id"), fresh(docs, "keeper_tie")
    goes = found.where("not keeper").select(F.col("doc_id").alias(its_id), F.col("tie").alias(its_tie)).distinct()
    tie = F.xxhash64(text_of())
    stays = docs.join(goes, F.col("doc_id").eqNullSafe(F.col(its_id)) & (tie == F.col(its_tie)), "left_anti")
    if found.where("keeper").groupBy("doc_id", "tie").count().where("count > 1").isEmpty():
        return stays
    return stays.withColumn(its_tie, tie).dropDuplicates(["doc_id", its_tie]).drop(its_tie)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: fingerprint and component of every document.

    Null and empty texts have fingerprint zero and are linked like any other;
    texts of any length count whole; repeated rows each get their row and share
    a component; a null doc_id comes after all others; an empty table gives no
    rows; other columns play no part.
    """
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex(F.col("f")[0]), 16, "0")).alias("fingerprint"), "component_id")
