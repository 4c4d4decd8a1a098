"""Exact removal of repeated passages: byte strings of ``least`` bytes that start in more than one place.

1. Anchors bring equal strings together. Every window of `least` bytes picks its smallest rolling hash of CORE bytes
   (winnowing, leftmost of equals), so equal windows pick the same bytes at the same offset. Neighbouring windows that
   pick the same place form a context: the bytes of all of them, about one context for every 170 bytes.
2. Contexts whose anchor stands nowhere else have no repeats. Of an anchor with one context, however often, all windows
   repeat. Only anchors with several different contexts are looked at byte by byte, each context once with its count.
3. The different contexts of an anchor are joined to a text, and many anchors to a block. From the block's
   Burrows-Wheeler transform the boundaries of common prefixes are derived by increasing length: the interval of every
   string that is new at a length is extended backward by each sign before it, and a boundary that is first reached at
   length l has the common prefix l. Expansion stops at `least`; neighbours without a boundary by then share `least` bytes.
4. Repeating windows go back to the texts that hold the contexts, whose bytes they cover are removed.

An anchor with more than HOT contexts is split: a window contains either more bytes on the left of the core or more on the right
of it, so its contexts are cut in two with longer cores, again and again until no group is hot.

Texts are shuffled only if they may hold a wanted context; which these are tells a Bloom filter sized by their
number (128 MB at most).
Texts are known by MD5, so copies share what is found for one.

Edge cases: null text is empty; texts shorter than `least` lose nothing; repeated rows are places of their own, so that
a repeated row of `least` bytes or more loses all; overlaps count, also within one text; very long texts are hashed in
stretches of STRETCH starts and read whole; there are no ties, since every place of a string that repeats is removed;
null doc_id is kept as a row; extra columns, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import key_filter, materialize, may_hold

CORE = 64
ODD = 0x9E3779B97F4A7C15
#: Window starts that are looked at at once, bytes of a block, contexts of a group that are split.
STRETCH, BLOCK_BYTES, HOT = 1 << 20, 1 << 21, 5_000
CONTEXT = "tkey binary, p int, windows int, rel int, g long, c long"


@lru_cache(maxsize=4)
def _powers(odd: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    k = 1
    while k < n:
        m = min(k, n - k)
        out[k : k + m] = out[:m] * np.uint64(pow(odd, k, 1 << 64))
        k += m
    return out


def rolling(data: np.ndarray, k: int) -> np.ndarray:
    """Mixed hashes of every k bytes in a row."""
    n = len(data)
    size = STRETCH + 4096
    up, down = _powers(ODD, size), _powers(pow(ODD, -1, 1 << 64), size)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    h = (sums[k:] - sums[:-k]) * down[: n - k + 1]
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    return h ^ (h >> np.uint64(32))


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    n = len(v)
    x = np.full(-(-n // w) * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    x[:n] = v
    x = x.reshape(-1, w)
    before = np.minimum.accumulate(x, axis=1).ravel()
    after = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - w + 1], before[w - 1 : n])


def contexts(data: bytes, least: int = 400, core: int = CORE) -> tuple[np.ndarray, ...]:
    """p, windows, rel, g, c of the contexts of a text: first window, number of windows, offset of the anchor, hashes of anchor and bytes."""
    found: list[tuple] = []
    for at in range(0, len(data) - least + 1, STRETCH):
        part = np.frombuffer(data, np.uint8, min(STRETCH + least - 1, len(data) - at), at)
        h = rolling(part, core)
        low = np.uint64((1 << 21) - 1)
        picked = _sliding_min((h & ~low) | np.arange(len(h), dtype=np.uint64), least - core + 1)
        new = np.flatnonzero(np.concatenate(([True], picked[1:] != picked[:-1])))
        n = np.diff(np.append(new, len(picked)))
        anchor = (picked[new] & low).astype(np.int64)
        rel, p = anchor - new, new + at
        c = np.array([xxhash.xxh3_64_intdigest(data[a : a + k + least - 1], r) for a, k, r in zip(p.tolist(), n.tolist(), rel.tolist())], np.uint64)
        found.append((p, n, rel, h[anchor].view(np.int64), c.view(np.int64)))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*found))


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first `depth` signs at least (prefix doubling); text holds values below 511."""
    n = len(text)
    signs = text.astype(np.int64)
    rank, reach = signs.copy(), 7  # seven signs of nine bits fit in one key
    for k in range(1, reach):
        rank <<= 9
        rank[: n - k] |= signs[k:]
    while True:
        order = np.argsort(rank)  # suffixes that share `depth` signs may stand in any order
        ordered = rank[order]
        new = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if reach >= depth or new[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = new + 1
        nxt = np.zeros(n, np.int64)
        nxt[: n - reach] = rank[reach:]
        rank = rank * (n + 2) + nxt
        reach *= 2


def deep_neighbours(text: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """Whether the suffixes at i - 1 and i of the order share `least` signs (0 at either end). Sign 0 stands between contexts.

    Breadth-first backward extension on the Burrows-Wheeler transform; a round handles all strings of one length.
    """
    n = len(text)
    bwt = text[order - 1]
    lf = np.empty(n, np.int64)
    lf[np.argsort(bwt.astype(np.uint16), kind="stable")] = np.arange(n)  # of 16 bits: a radix sort
    starts = np.flatnonzero(np.concatenate(([True], bwt[1:] != bwt[:-1])))  # runs of one sign
    stops = np.append(starts[1:], n)
    run = np.cumsum(np.concatenate(([0], (bwt[1:] != bwt[:-1]).astype(np.int64))))
    is_set = np.zeros(n + 1, bool)
    is_set[[0, n]] = True
    ends = np.cumsum(np.bincount(text))
    hi = np.unique(ends)
    lo = np.concatenate(([0], hi[:-1]))
    is_set[hi] = True
    for _ in range(1, least):
        if not len(lo):
            break
        # The runs within each interval; most have one.
        first, last = run[lo], run[hi - 1]
        k = last - first + 1
        which = np.repeat(np.arange(len(lo)), k)
        at = np.repeat(first - (np.cumsum(k) - k), k) + np.arange(len(which))
        a = np.maximum(starts[at], lo[which])
        b = np.minimum(stops[at], hi[which])
        sign = bwt[a]
        keep = sign != 0
        a, b, sign, which = lf[a[keep]], lf[b[keep] - 1] + 1, sign[keep], which[keep]
        if len(k) != len(which) or (k > 1).any():
            # Several runs of one sign in an interval make one interval of its extension.
            o = np.lexsort((a, sign, which))
            a, b, sign, which = a[o], b[o], sign[o], which[o]
            new = np.flatnonzero(np.concatenate(([True], (sign[1:] != sign[:-1]) | (which[1:] != which[:-1])))) if len(o) else o
            lo, hi = (a[new], np.maximum.reduceat(b, new)) if len(new) else (a, b)
        else:
            lo, hi = a, b
        fresh = ~is_set[hi]
        lo, hi = lo[fresh], hi[fresh]
        is_set[hi] = True
    return ~is_set


def repeated_windows(bodies: list[bytes], counts: list[int], least: int) -> list[list[tuple[int, int]]]:
    """For each context the runs (first window, behind the last) that start elsewhere too; counts: how often each context stands."""
    sizes = np.array([len(b) for b in bodies])
    text = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8).astype(np.int64) + 1
    begins = np.cumsum(sizes + 1) - sizes - 1
    text[begins + sizes] = 0
    order = suffix_order(text, least)
    deep = deep_neighbours(text, order, least)
    twice = np.zeros(len(text), bool)
    twice[order] = deep[:-1] | deep[1:]
    out = []
    for begin, size, n in zip(begins.tolist(), sizes.tolist(), counts):
        windows = size - least + 1
        if n > 1:
            out.append([(0, windows)])
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([0], twice[begin : begin + windows].astype(np.int8), [0]))))
        out.append(list(zip(edges[::2].tolist(), edges[1::2].tolist())))
    return out


def _find(least: int):
    """Runs of repeating windows of every context; batches are sorted by g, so that groups are whole."""
    names = ["g", "c", "runs"]
    kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        runs = repeated_windows([r[3] for r in rows], [r[2] for r in rows], least)
        keep = [k for k, r in enumerate(runs) if r]
        arrays = [pa.array([rows[k][0] for k in keep], pa.int64()), pa.array([rows[k][1] for k in keep], pa.int64())]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([[{"s": s, "e": e} for s, e in runs[k]] for k in keep], kind)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in ("g", "c", "n", "body"))):
                if size >= BLOCK_BYTES and row[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield solve(held)

    return run


def _halves(body: bytes, rel: int, core: int, least: int):
    """The two parts of a context: (bytes, offset of the core, its length, shift against the context)."""
    more = max(1, (least - core) // 2)
    windows = len(body) - least + 1
    left = min(max(rel - more + 1, 0), windows)  # windows that hold `more` bytes on the left of the core
    if left > 0:
        yield body[: left + least - 1], rel - more, core + more, 0
    if left < windows:
        yield body[left:], rel - left, least - more + 1 if more < least - core else core + 1, left


def _split(least: int):
    names = ["og", "oc", "shift", "g", "c", "n", "rel", "core", "body"]
    kinds = [pa.int64()] * 8 + [pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for g, c, n, rel, core, body in zip(*(batch.column(k).to_pylist() for k in ("g", "c", "n", "rel", "core", "body"))):
                for part, r, size, shift in _halves(body, rel, core, least):
                    size = min(size, least)
                    key = xxhash.xxh3_64_intdigest(part[r : r + size], g & 0x7FFFFFFFFFFFFFFF)
                    own = xxhash.xxh3_64_intdigest(part, r)
                    out.append((g, c, shift, *np.array([key, own], np.uint64).view(np.int64).tolist(), n, r, size, part))
            columns = zip(*out) if out else [()] * 9
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], names)

    return run


def _resolve(ctx: DataFrame, least: int, hot: int) -> DataFrame:
    """(g, c, runs) for contexts (g, c, n, rel, core, body); groups with over `hot` contexts are split first."""
    find = lambda rows: rows.select("g", "c", "n", "body").repartition("g").sortWithinPartitions("g", "c").mapInArrow(
        _find(least), "g long, c long, runs array<struct<s: int, e: int>>"
    )
    many = materialize(ctx.groupBy("g").agg(F.count(F.lit(1)).alias("m")).where(f"m > {hot}").select("g"), "hot")
    if many.isEmpty():
        return find(ctx)
    subs = ctx.join(many, "g", "left_semi").mapInArrow(
        _split(least), "og long, oc long, shift long, g long, c long, n long, rel long, core long, body binary"
    )
    subs = materialize(subs, "halves")
    parts = subs.groupBy("g", "c").agg(F.sum("n").alias("n"), F.min("rel").alias("rel"), F.min("core").alias("core"), F.min("body").alias("body"))
    below = materialize(_resolve(materialize(parts, "parts"), least, hot), "runs")
    back = subs.select("og", "oc", "shift", "g", "c").join(below, ["g", "c"])
    moved = F.transform("runs", lambda x: F.struct((x["s"] + F.col("shift")).cast("int").alias("s"), (x["e"] + F.col("shift")).cast("int").alias("e")))
    back = back.select(F.col("og").alias("g"), F.col("oc").alias("c"), moved.alias("runs"))
    back = back.groupBy("g", "c").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    return find(ctx.join(many, "g", "left_anti")).unionByName(back)


def removal_runs(docs: DataFrame, least: int = 400, hot: int = HOT) -> DataFrame:
    """(tkey, runs): for texts with repeats, the runs (s, e) of window starts that also start elsewhere; unordered, may touch."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).select(F.unhex(F.md5(F.col("text").cast("binary"))).alias("tkey"), "text")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in CONTEXT.split(", ")]
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                found = [contexts(t.as_py().encode("utf-8", "replace"), least) for t in part.column(1)]
                p, windows, rel, g, c = (np.concatenate(x) for x in zip(*found))
                keys = part.column(0).take(pa.array(np.repeat(np.arange(len(found)), [len(x[0]) for x in found])))
                arrays = [keys, *(pa.array(x.astype(np.int32)) for x in (p, windows, rel)), pa.array(g), pa.array(c)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    occ = materialize(texts.mapInArrow(emit, CONTEXT), "contexts")
    # Anchors that stand twice or more; those with one context are settled.
    twice = occ.groupBy("g").agg(F.count(F.lit(1)).alias("m"), F.min("c").alias("c1"), F.max("c").alias("c2")).where("m > 1").select("g", F.expr("c1 <> c2").alias("several"))
    # Written first, so that both sides of the join are plain exchanges, whose hot keys Spark can split.
    seen = materialize(occ.join(materialize(twice, "anchors"), "g"), "repeats")
    # Copies of a text have the same places: each once for what is removed, all for how often a context stands.
    settled = seen.where("NOT several").select("tkey", "p", "windows").distinct().select("tkey", F.array(F.struct(F.col("p").alias("s"), (F.col("p") + F.col("windows")).alias("e"))).alias("runs"))
    open_ = seen.where("several")
    asked = open_.groupBy("g", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("tkey", "p", "windows", "rel")).alias("x"))
    asked = asked.groupBy("x.tkey").agg(F.collect_list(F.struct("g", "c", "n", "x.p", "x.windows", "x.rel")).alias("asked"))
    asked = materialize(asked, "asked")
    held = spark.sparkContext.broadcast(key_filter(asked, "tkey"))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()  # copies within a task go once
        for batch in batches:
            keep = []
            for k in np.flatnonzero(may_hold(held.value, batch.column(2).to_numpy())).tolist():
                key = batch.column(0)[k].as_py()
                if key not in sent:
                    sent.add(key)
                    keep.append(k)
            yield batch.select(["tkey", "text"]).take(pa.array(keep, pa.int64()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["g", "c", "n", "rel", "core", "body"]
        for batch in batches:
            for text, rows in zip(batch.column(0), batch.column(1)):
                data, rows = text.as_py().encode("utf-8", "replace"), rows.as_py()
                bodies = [data[r["p"] : r["p"] + r["windows"] + least - 1] for r in rows]
                arrays = [pa.array([r[k] for r in rows], pa.int64()) for k in ("g", "c", "n", "rel")]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array([CORE] * len(rows), pa.int64()), pa.array(bodies, pa.binary())], names)

    near = texts.withColumn("h", F.xxhash64("tkey")).mapInArrow(wanted, "tkey binary, text string")
    ctx = near.join(asked, "tkey").select("text", "asked").mapInArrow(cut, "g long, c long, n long, rel long, core long, body binary")
    ctx = ctx.groupBy("g", "c").agg(F.min("n").alias("n"), F.min("rel").alias("rel"), F.min("core").alias("core"), F.min("body").alias("body"))
    found = materialize(_resolve(materialize(ctx, "bodies"), least, hot), "runs")
    moved = F.transform("runs", lambda x: F.struct((x["s"] + F.col("p")).alias("s"), (x["e"] + F.col("p")).alias("e")))
    return settled.union(open_.select("tkey", "p", "g", "c").distinct().join(found, ["g", "c"]).select("tkey", moved.alias("runs")))


def _merged(runs: list[dict], least: int) -> list[tuple[int, int]]:
    """Byte spans that windows starting in the runs cover, maximal and in order."""
    out: list[list[int]] = []
    for s, e in sorted((r["s"], r["e"] - 1 + least) for r in runs):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def remove_repeats(docs: DataFrame, least: int = 400, hot: int = HOT) -> DataFrame:
    """One row for each row of docs: doc_id, n_bytes, spans (byte start, end) removed, kept_sha256."""
    spark = docs.sparkSession
    runs = removal_runs(docs, least, hot)
    runs = materialize(runs.groupBy("tkey").agg(F.flatten(F.collect_list("runs")).alias("runs")), "removals")
    held = spark.sparkContext.broadcast(key_filter(runs, "tkey"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Only texts that may lose bytes go on as texts.
        for batch in batches:
            hit = may_hold(held.value, batch.column(3).to_numpy())
            data = [t.as_py().encode("utf-8", "replace") for t in batch.column(2)]
            arrays = [
                batch.column(0), batch.column(1), pa.array(list(map(len, data)), pa.int64()), pa.array([hashlib.sha256(d).hexdigest() for d in data]),
                pa.array([d if x else None for d, x in zip(data, hit)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "tkey", "n_bytes", "sha", "data"])

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
        for batch in batches:
            all_spans, digests = [], []
            for sha, data, found in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4)):
                spans = _merged(found.as_py() or [], least)
                if spans:
                    data, at, digest = data.as_py(), 0, hashlib.sha256()
                    for s, e in spans:
                        digest.update(data[at:s])
                        at = e
                    digest.update(data[at:])
                    sha = digest.hexdigest()
                all_spans.append([{"s": s, "e": e} for s, e in spans])
                digests.append(sha)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(all_spans, kind), pa.array(digests)], ["doc_id", "n_bytes", "spans", "kept_sha256"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("tkey"), "text").withColumn("h", F.xxhash64("tkey"))
    marked = rows.mapInArrow(mark, "doc_id long, tkey binary, n_bytes long, sha string, data binary")
    joined = marked.join(runs, "tkey", "left").select("doc_id", "n_bytes", "sha", "data", "runs")
    return joined.mapInArrow(drop, "doc_id long, n_bytes long, spans array<struct<s: long, e: long>>, kept_sha256 string")
