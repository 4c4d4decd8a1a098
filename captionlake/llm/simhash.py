"""SimHash near-duplicates by a binary trie self-join.

A document's fingerprint has a bit set when over half of its shingle hashes have it. The distinct fingerprints form a
binary trie; node pairs are traversed together, differing bits are accumulated, and a pair is dropped as soon as they
exceed the error budget. So that subtries can be dealt to tasks, there is one trie for each of budget + 1 rotations of
the bits, in which the leading block may not differ at all: two fingerprints that differ in at most budget bits agree in
one block at least. A fingerprint therefore goes to budget + 1 tasks, whatever the corpus size.

``near_duplicates`` makes classes of the fingerprints alone. ``keep_one`` uses the same trie join to find candidates, by
fingerprints that have budget for edited copies, and decides by the exact share of five-word shingles.

Edge cases: null or empty text and text without words have fingerprint zero, which is linked like any other; very long
texts are hashed whole, BLOCK shingles at a time; a bit that is set in just half of the hashes is not set; repeated rows
give repeated result rows; a null doc_id is kept as a row and never chosen as the class id unless the class has no other;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import connected_components, free_name, key_filter, materialize, may_hold, parts

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Shingles whose bits are counted at once; bounds the memory that a long text takes.
BLOCK = 1 << 16
#: Node pairs that are split at once, and fingerprints in a block above which its subtries are dealt out further.
PAIRS, HOT, STRIDE = 1 << 14, 20_000, 8


def shingle_hashes(text: str | None, words: int = 3, seed: int = 42) -> np.ndarray:
    """XXH64 of the word shingles of a whole text, repeats included."""
    found = (text or "").encode("utf-8", "replace").translate(LOWER).split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-words] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1 :].tolist())), np.uint64, len(starts))


def majorities(hashes: np.ndarray) -> np.ndarray:
    """For each column of hashes the unsigned 64-bit number whose bits are set in over half of its rows."""
    n, columns = hashes.shape
    counts = np.zeros(64 * columns, np.int64)
    for k in range(0, n, BLOCK):
        part = np.ascontiguousarray(hashes[k : k + BLOCK], "<u8")
        counts += np.unpackbits(part.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > n, bitorder="little").view("<u8")


def majority(hashes: np.ndarray) -> int:
    """The unsigned 64-bit number whose bits are set in over half of the hashes."""
    return int(majorities(hashes.reshape(-1, 1))[0])


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit fingerprint of a text's shingles."""
    return majority(shingle_hashes(text, words, seed))


class WordFingerprints:
    """Fingerprints of the distinct words of a text, each counted once: an edit of a word moves few of their bits. One for each seed.

    The hashes of words of up to 32 bytes are remembered, MEMORY words at most; then the memory starts anew.
    """

    MEMORY = 1 << 17

    def __init__(self, seeds: tuple[int, ...]):
        self.seeds, self.known, self.hashes = seeds, {}, np.zeros((self.MEMORY, len(seeds)), np.uint64)

    def _hashed(self, words: list[bytes]) -> np.ndarray:
        digest = xxhash.xxh64_intdigest
        return np.array([[digest(w, s) for s in self.seeds] for w in words], np.uint64).reshape(-1, len(self.seeds))

    def __call__(self, text: str | None) -> np.ndarray:
        found = list(set((text or "").encode("utf-8", "replace").translate(LOWER).split()))
        counts = []
        for k in range(0, len(found), BLOCK):
            counts.append(self._rows(found[k : k + BLOCK]))
        return majorities(np.concatenate(counts) if counts else np.zeros((0, len(self.seeds)), np.uint64))

    def _rows(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        new = [w for w in words if len(w) <= 32 and w not in known]
        if len(known) + len(new) > self.MEMORY:
            known.clear()
            new = [w for w in words if len(w) <= 32]
        self.hashes[len(known) : len(known) + len(new)] = self._hashed(new)
        known.update(zip(new, range(len(known), len(known) + len(new))))
        short = [known[w] for w in words if len(w) <= 32]
        rows = self.hashes[short]
        return rows if len(short) == len(words) else np.concatenate((rows, self._hashed([w for w in words if len(w) > 32])))


def word_fingerprint(text: str | None, seed: int) -> int:
    """The fingerprint of the distinct words of one text for one seed."""
    found = set((text or "").encode("utf-8", "replace").translate(LOWER).split())
    return majority(np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in found), np.uint64, len(found)))


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, h, fp): h is a hash of the text, fp its fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.array([fingerprint(t.as_py(), words, seed) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(got)], ["doc_id", "h", "fp"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), text_hash().alias("h")).mapInArrow(run, "doc_id long, h long, fp long")


def text_hash() -> F.Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _expand(lo1, hi1, lo2, hi2):
    """All pairs of the members of node pairs; of a node with itself, each pair once."""
    n2 = hi2 - lo2
    total = (hi1 - lo1) * n2
    which = np.repeat(np.arange(len(total)), total)
    at = np.arange(len(which)) - np.repeat(np.cumsum(total) - total, total)
    i, j = lo1[which] + at // n2[which], lo2[which] + at % n2[which]
    keep = (i < j) | (lo1 != lo2)[which]
    return i[keep], j[keep]


def trie_pairs(values: np.ndarray, lo1, hi1, lo2, hi2, depth: int, budget, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of indexes into values (each range sorted) that differ in at most `most` bits.

    budget is what each node pair has left of `most` below depth.

    Node pairs are taken last in, first out, in blocks of PAIRS, so that memory doesn't follow the number of links.
    """
    ones: dict[int, np.ndarray] = {}
    stack = [(lo1, hi1, lo2, hi2, np.asarray(budget), depth)]
    while stack:
        a, b, c, d, left, at = stack.pop()
        if len(a) > PAIRS:
            stack += [tuple(x[k : k + PAIRS] for x in (a, b, c, d, left)) + (at,) for k in range(0, len(a), PAIRS)]
            continue
        few = (b - a) * (d - c) <= 16
        if at >= 64:
            few[:] = True
        if few.any():
            i, j = _expand(a[few], b[few], c[few], d[few])
            total = np.bitwise_count(values[i] ^ values[j])
            near = total <= most
            if near.any():
                yield i[near], j[near]
            a, b, c, d, left = (x[~few] for x in (a, b, c, d, left))
        if not len(a):
            continue
        if at not in ones:
            ones[at] = np.concatenate(([0], np.cumsum((values >> np.uint64(63 - at)) & np.uint64(1)).astype(np.int64)))
        up = ones[at]
        m1, m2 = b - (up[b] - up[a]), d - (up[d] - up[c])
        own = a == c
        below = []
        for x1, y1, x2, y2, cost in ((a, m1, c, m2, 0), (m1, b, m2, d, 0), (a, m1, m2, d, 1), (m1, b, c, m2, 1)):
            ok = (y1 > x1) & (y2 > x2) & (left >= cost) & ~((x1 == x2) & (y1 - x1 < 2))
            if cost and x1 is m1:
                ok &= ~own  # of a node with itself, the two children meet once
            if ok.any():
                below.append((x1[ok], y1[ok], x2[ok], y2[ok], left[ok] - cost))
        if below:  # the children go on together, so that a level of small nodes is one step
            stack.append((*map(np.concatenate, zip(*below)), at + 1))


class Links:
    """Union by smaller index over one batch of fingerprints: a class of m members leaves m - 1 links, however many pairs it has."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        for x, y in zip(i.tolist(), j.tolist()):
            x, y = self.root(x), self.root(y)
            if x != y:
                self.up[max(x, y)] = min(x, y)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        roots = np.array([self.root(x) for x in range(len(self.up))], np.int64)
        i = np.flatnonzero(roots != np.arange(len(roots)))
        return i, roots[i]


def _groups(batches: Iterator[pa.RecordBatch], least: int = 200_000) -> Iterator[dict[str, np.ndarray]]:
    """Whole groups (equal k) of a stream that is sorted by k, many at a time."""
    held: list[dict[str, np.ndarray]] = []

    def joined():
        return {c: np.concatenate([x[c] for x in held]) for c in held[0]}

    for batch in batches:
        if batch.num_rows:
            held.append({c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names})
        if held and sum(len(x["k"]) for x in held) >= least:
            whole = joined()
            cut = int(np.flatnonzero(whole["k"] != whole["k"][-1])[-1]) + 1 if (whole["k"] != whole["k"][-1]).any() else 0
            if cut:
                yield {c: v[:cut] for c, v in whole.items()}
            held = [{c: v[cut:] for c, v in whole.items()}]
    if held:
        yield joined()


def _join_tasks(budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches):
            # side 0 and 1: the two nodes of a pair; 2: a node with itself
            rot = g["rot"].view(np.uint64)
            order = np.lexsort((rot, g["side"], g["k"]))
            rot, ids, k, side = rot[order], g["id"][order], g["k"][order], g["side"][order]
            depth, left = g["depth"][order], g["remain"][order]
            links = Links(len(ids))
            new = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (side[1:] != side[:-1]))))
            end = np.append(new[1:], len(k))
            own = side[new] == 2
            first = np.flatnonzero((side[new] == 0) & (np.append(k[new][1:], ~k[-1]) == k[new]))
            for d in np.unique(depth).tolist():
                n = own & (depth[new] == d) & (end - new > 1)
                for i, j in trie_pairs(rot, new[n], end[n], new[n], end[n], int(d), left[new[n]], budget):
                    links.add(i, j)
                m = first[depth[new[first]] == d]
                for i, j in trie_pairs(rot, new[m], end[m], new[m + 1], end[m + 1], int(d), left[new[m]], budget):
                    links.add(i, j)
            i, j = links.edges()
            yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(ids[j])], ["a", "b"])

    return run


def trie_links(nodes: DataFrame, budget: int = 2) -> DataFrame:
    """Edges (a, b) between nodes (fp, id, space) that connect the ids of all fingerprints of a space that differ in at most budget bits.

    A fingerprint stands once in its space; without a column id it is its own, and without a column space all are in one.

    Subtries with more than HOT fingerprints are split: their children at STRIDE more bits are paired with those that
    the budget still reaches, and each such node pair is a task of its own. This repeats until no subtrie is hot.
    """
    blocks = budget + 1
    size = -(-64 // blocks)
    at = []
    for r in range(blocks):
        bits = min(size, 64 - r * size)
        turn = r * size
        rot = F.expr(f"shiftleft(fp, {turn}) | shiftrightunsigned(fp, {64 - turn})") if turn else F.col("fp")
        at.append(F.struct(rot.alias("rot"), F.lit(bits).alias("depth"), F.lit(r).alias("r")))
    own, space = (F.col(c) if c in nodes.columns else other for c, other in (("id", F.col("fp")), ("space", F.lit(0))))
    tasks = nodes.select(own.alias("id"), space.alias("space"), F.explode(F.array(*at)).alias("x")).select("id", "space", "x.rot", "x.depth", "x.r")
    tasks = tasks.select(
        "id", "rot", "depth", F.lit(budget).alias("remain"), F.lit(2).alias("side"),
        F.xxhash64("space", "r", F.expr("shiftrightunsigned(rot, 64 - depth)")).alias("k"),
    )
    while True:
        hot = tasks.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("depth").alias("d")).where(f"n > {HOT} AND d <= {64 - STRIDE}")
        hot = materialize(hot.select("k"), "hot")
        if hot.isEmpty():
            break
        # Masks of up to `budget` bits: the children that a child can be paired with.
        masks = [m for m in range(1 << STRIDE) if m.bit_count() <= budget]
        cold = tasks.join(hot, "k", "left_anti")
        warm = tasks.join(hot, "k", "left_semi").withColumn("child", F.expr(f"shiftrightunsigned(rot, {64 - STRIDE} - depth) & {(1 << STRIDE) - 1}"))
        warm = warm.withColumn("m", F.explode(F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(m.bit_count()).alias("c")) for m in masks])))
        warm = warm.where("m.c <= remain").withColumn("other", F.expr("child ^ m.m"))
        own = F.expr("side = 2")
        # From a node with itself: the smaller child is side 0. From a pair: side stays, and the key is (child of 0, child of 1).
        first = F.when(own, F.least("child", "other")).when(F.expr("side = 0"), F.col("child")).otherwise(F.col("other"))
        last = F.when(own, F.greatest("child", "other")).when(F.expr("side = 0"), F.col("other")).otherwise(F.col("child"))
        warm = warm.select(
            "id", "rot", (F.col("depth") + STRIDE).alias("depth"), (F.col("remain") - F.col("m.c")).alias("remain"),
            F.when(own & F.expr("m.m = 0"), F.lit(2)).when(own, F.when(F.expr("child < other"), F.lit(0)).otherwise(F.lit(1))).otherwise(F.col("side")).alias("side"),
            F.xxhash64("k", first, last).alias("k"),
        )
        tasks = materialize(cold.select(*tasks.columns).union(warm.select(*tasks.columns)), "subtries")
    ordered = tasks.repartition("k").sortWithinPartitions("k")
    return ordered.mapInArrow(_join_tasks(budget), "a long, b long")


def classes(docs: DataFrame, budget: int = 2, words: int = 3, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, h, fp), and for every fingerprint its class (fp, root, least): least is its smallest doc_id."""
    rows = materialize(fingerprints(docs, words, seed), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(trie_links(nodes.select("fp"), budget))
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    return rows, materialize(named, "classes")


def near_duplicates(docs: DataFrame, budget: int = 2, words: int = 3, seed: int = 42) -> DataFrame:
    """One row for each row of docs: doc_id, fp, component_id (the smallest doc_id that links reach)."""
    rows, named = classes(docs, budget, words, seed)
    # What is aggregated is written before it is joined: both sides are then plain exchanges, whose hot keys Spark can split.
    first = materialize(named.groupBy("root").agg(F.min("least").alias("component_id")), "first")
    ids = materialize(named.join(first, "root").select("fp", "component_id"), "ids")
    return rows.join(ids, "fp").select("doc_id", "fp", "component_id")


def _similar(a: str, b: str, share: float) -> str:
    """SQL: whether two arrays of distinct shingle hashes have a Jaccard similarity of `share` or more; two empty ones have."""
    both = f"size(array_intersect({a}, {b}))"
    near = f"least(size({a}), size({b})) >= {share} * greatest(size({a}), size({b}))"  # the similarity can't exceed the ratio of the sizes
    return f"({near} AND {both} >= {share} * (size({a}) + size({b}) - {both}))"


def _entries(members: DataFrame, share: float, cells: int = 1 << 20) -> DataFrame:
    """(root, token, key, h, size, inner): the members (root, key, h, sh) by the rarest of their shingles, enough of them that two
    members of a component whose similarity is `share` or more have one in common.

    Of two such members the smaller one has it among its `inner` shingles, which are fewer still (prefix and index prefix of
    a similarity join). Rare is what has few shingles in its cell of a table of `cells` counts: a bounded stand-in for
    exact counts that puts what all texts of a form share last; the order only has to be one order for all texts.
    """
    seen = members.select(F.explode("sh").alias("t")).groupBy(F.expr(f"t & {cells - 1}").alias("cell")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    counts = np.zeros(cells, np.int64)
    counts[seen.column(0).to_numpy()] = seen.column(1).to_numpy()
    held = members.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            tokens, inner = [], []
            for sh in part.column(3):
                t = np.asarray(sh.values.to_numpy())
                n = len(t)
                near = n - math.ceil(share * n - 1e-9) + 1
                own = n - math.ceil(2 * share / (1 + share) * n - 1e-9) + 1
                # Texts without words have no shingle and are equal: they meet under one of their own.
                first = t[np.lexsort((t, held.value[t & (cells - 1)]))[:near]] if n else np.zeros(1, np.int64)
                tokens.append(first)
                inner.append(np.arange(len(first)) < own)
            sizes = pa.array([len(x) for x in part.column(3)], pa.int64())
            lists = [pa.array(tokens, pa.list_(pa.int64())), pa.array(inner, pa.list_(pa.bool_()))]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), sizes, *lists], ["root", "key", "h", "size", "t", "i"])

    rows = members.select("root", "key", "h", "sh").mapInArrow(run, "root long, key long, h long, size long, t array<long>, i array<boolean>")
    rows = rows.select("root", "key", "h", "size", F.explode(F.arrays_zip("t", "i")).alias("x"))
    return rows.select("root", F.col("x.t").alias("token"), "key", "h", "size", F.col("x.i").alias("inner"))


def _verified(pairs: DataFrame, members: DataFrame, share: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""
    sh = members.select("h", "sh")
    both = pairs.join(sh.withColumnsRenamed({"h": "a", "sh": "sa"}), "a").join(sh.withColumnsRenamed({"h": "b", "sh": "sb"}), "b")
    return both.where(_similar("sa", "sb", share)).select("a", "b")


def _stay(members: DataFrame, share: float) -> DataFrame:
    """(key, h) of the members (root, key, h, sh) that stay: in the order of key and h, a member goes if it is similar to one of its
    component that stays.

    Members meet by rare shingles (``_entries``), never by component. In a round the first member of each shingle's bucket is
    looked at: who is first in all its buckets stays, whoever shares a bucket with it is compared with it, and the similar
    ones go; who meets nobody stays. A group of copies is settled in one round, however large, with one pair for each copy.
    When a round settles less than half of what was left, which are members that share rare shingles without being similar,
    the rest is compared in pairs by bucket, and the similar pairs are settled in order. All of it are joins and aggregates
    that Spark can split; nothing is gathered by component, shingle or text.
    """
    entries = materialize(_entries(members, share), "entries")
    left = materialize(members.select("key", "h"), "undecided")
    n, kept = left.count(), None
    met = F.expr("(inner OR m.inner)") & F.expr(f"least(size, m.size) >= {share} * greatest(size, m.size)")
    while n:
        first = entries.groupBy("root", "token").agg(F.min(F.struct("key", "h", "size", "inner")).alias("m"), F.count(F.lit(1)).alias("c"), F.max("inner").alias("any")).where("c > 1 AND any")
        tagged = materialize(entries.join(materialize(first.drop("c", "any"), "first"), ["root", "token"]), "buckets")
        order = materialize(tagged.groupBy("h").agg(F.bool_and(F.expr("m.h = h")).alias("first")), "order")
        stay = left.join(order, "h", "left").where("first IS NULL OR first").select("key", "h")
        stay = materialize(stay, "stay")
        kept = stay if kept is None else kept.union(stay)
        pairs = tagged.where(met & F.expr("m.h <> h")).select(F.col("m.h").alias("a"), F.col("h").alias("b"))
        pairs = materialize(pairs.join(stay.select(F.col("h").alias("a")), "a", "left_semi").distinct(), "pairs")
        gone = materialize(_verified(pairs, members, share).select(F.col("b").alias("h")).distinct(), "gone")
        left = materialize(left.join(stay.select("h").union(gone), "h", "left_anti"), "undecided")
        entries = materialize(tagged.drop("m").join(left.select("h"), "h", "left_semi"), "entries")
        before, n = n, left.count()
        if 2 * n > before:
            break
    if n:
        other = entries.select("root", "token", F.struct("key", "h", "size", "inner").alias("m"))
        pairs = entries.join(other, ["root", "token"]).where(met & F.expr("struct(m.key, m.h) < struct(key, h)")).select(F.col("m.h").alias("a"), F.col("h").alias("b")).distinct()
        links = materialize(_verified(materialize(pairs, "pairs"), members, share), "links")
        while n:  # who has no smaller similar member left stays, and those similar to it go
            behind = links.select(F.col("b").alias("h")).distinct()
            stay = materialize(left.join(behind, "h", "left_anti"), "stay")
            kept = kept.union(stay)
            gone = materialize(links.join(stay.select(F.col("h").alias("a")), "a", "left_semi").select(F.col("b").alias("h")).distinct(), "gone")
            left = materialize(left.join(stay.select("h").union(gone), "h", "left_anti"), "undecided")
            out = gone.select(F.col("h").alias("a"))
            links = materialize(links.join(out, "a", "left_anti").join(out.withColumnRenamed("a", "b"), "b", "left_anti").select("a", "b"), "links")
            n = left.count()
    return kept if kept is not None else members.select("key", "h")


def keep_one(docs: DataFrame, budget: int = 3, words: int = 5, share: float = 0.8, seeds: tuple[int, ...] = (42, 43, 44, 45, 46)) -> DataFrame:
    """docs with one row of each group of near-duplicates: that of the smallest doc_id (rows without one come last), then of the smallest text hash.

    Texts are candidates when one of their word fingerprints (one for each seed) differs in at most budget bits; candidates
    are joined by the trie and form components. Within a component a text goes if its word shingles have a Jaccard
    similarity of `share` or more with those of a text that stays. Texts of fewer words than a shingle are one shingle.

    Equal texts are one text throughout. Null text counts as empty; texts without words are all equal; a row whose doc_id
    and text both repeat stays once; very long texts are read whole; extra columns, whatever their names, are carried
    along; an empty table gives an empty result.
    """
    h, at, other = (free_name(docs.columns, x) for x in ("own_hash", "own_key", "other"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))  # rows without doc_id sort last

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = WordFingerprints(seeds)
        for part in parts(batches):
            got = np.array([marked(t.as_py()) for t in part.column(2)], np.uint64).reshape(-1, len(seeds)).view(np.int64)
            fps = [pa.array(np.ascontiguousarray(x)) for x in got.T]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *fps], ["key", "h", *(f"fp{k}" for k in range(len(seeds)))])

    schema = ", ".join(["key long", "h long", *(f"fp{k} long" for k in range(len(seeds)))])
    rows = materialize(docs.select(key.alias("key"), text_hash().alias("h"), text.alias("text")).mapInArrow(marks, schema), "fingerprints")
    # One node for each text; equal texts have equal fingerprints.
    nodes = materialize(rows.groupBy("h").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("n"), *[F.min(f"fp{k}").alias(f"fp{k}") for k in range(len(seeds))]), "texts")
    # All seeds in one trie join, each a space of its own; of texts with one fingerprint the least hash stands for all.
    fps = nodes.select("h", F.posexplode(F.array(*[f"fp{k}" for k in range(len(seeds))])).alias("space", "fp"))
    one = materialize(fps.groupBy("space", "fp").agg(F.min("h").alias("id")), "one")
    same = fps.join(one, ["space", "fp"]).where("h <> id").select(F.col("h").alias("a"), F.col("id").alias("b"))
    links = same.union(trie_links(one, budget))
    roots = materialize(connected_components(links).withColumnRenamed("node", "h"), "roots")
    members = materialize(nodes.select("h", "key").join(roots, "h"), "members")
    # Shingles of texts in components; a filter keeps most other texts out of the join.
    held = docs.sparkSession.sparkContext.broadcast(key_filter(members, "h"))

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()  # copies within a task go once
        for part in parts(batches):
            hit = np.flatnonzero(may_hold(held.value, part.column(2).to_numpy())).tolist()
            number = part.column(0).to_numpy()
            new = [k for k in hit if number[k] not in sent and not sent.add(number[k])]
            got = [np.unique(shingle_hashes(part.column(1)[k].as_py(), words)).view(np.int64) for k in new]
            yield pa.RecordBatch.from_arrays([pa.array(number[new]), pa.array(got, pa.list_(pa.int64()))], ["h", "sh"])

    sh = docs.select(text_hash().alias("h"), text.alias("text")).withColumn("f", F.xxhash64("h")).mapInArrow(shingles, "h long, sh array<long>")
    sh = sh.groupBy("h").agg(F.first("sh").alias("sh"))  # equal texts have equal shingles
    members = materialize(members.join(materialize(sh, "shingles"), "h").select("root", "key", "h", "sh"), "members")
    kept = materialize(_stay(members, share), "kept")
    gone = members.select("h").join(kept, "h", "left_anti").withColumn("key", F.lit(0).cast("long")).withColumn("n", F.lit(0).cast("long"))
    repeated = nodes.where("n > 1").join(members.select("h").join(kept, "h", "left_anti"), "h", "left_anti").select("h", "key", "n")
    special = materialize(gone.select("h", "key", "n").union(repeated), "special")
    # Texts that neither go nor repeat stay as they are; of those that repeat, the row of the smallest key.
    columns = [F.col(f"`{c}`") for c in docs.columns]
    special = special.select(F.struct("h", "key", "n").alias(other))
    found = docs.withColumns({h: text_hash(), at: key}).join(special, F.col(h) == F.col(f"{other}.h"), "left")
    left = found.where(F.col(other).isNull()).select(*columns)
    again = found.where((F.col(f"{other}.n") > 0) & (F.col(at) == F.col(f"{other}.key"))).dropDuplicates([h, at]).select(*columns)
    return left.unionByName(again)
