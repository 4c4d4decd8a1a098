"""Benchmark decontamination by greedy string tiling with running Karp-Rabin matching.

Words of documents and items are compared in lower case. Rolling hashes of five words of all items are the seeds; a
document that shares a seed with an item is tiled against it: the longest match of words that no tile covers yet is
marked, again and again, until no match of five words is left. An item whose words are covered to ``threshold`` or more
is in the document, in whatever order its passages stand.

Items are given to tasks in blocks of at most ``block_words`` words, so that what is broadcast has a fixed bound whatever
the size of the benchmark. Where there are several blocks, documents are read once with a filter of all seeds (128 MB at
most); the few that may share one are written, and only these meet the blocks. No document is shuffled.

Tiling takes memory for each word, not for each pair of equal words: a text that says one word 200,000 times is no heavier
than another of its length.

Edge cases: null and empty texts and items match nothing; items with fewer words than ``least`` have no seed and are
reported by none (call with a smaller ``least`` for them: words as short as that stand in clean texts too); of matches of
equal length the first in the item, then in the document, is marked; repeated items and repeated rows are reported each;
null item_id or doc_id are carried along; documents are tiled whole, however long; extra columns, whatever their names,
are ignored or carried along (``keep_clean``); an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import free_name, key_filter, materialize, may_hold, parts

WORD = re.compile(r"\w+")
BASE = np.uint64(0x9E3779B97F4A7C15)
SCHEMA = "doc_id long, item_id long, item_words long, covered long, n_tiles long, coverage double"


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def rolling(ids: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hashes of every k ids in a row."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    with np.errstate(over="ignore"):
        for j in range(k):
            out = out * BASE + mixed[j : j + n]
    return out


class Windows:
    """Hashes of all windows of a text's words, of whatever length, and which words are taken by a tile."""

    def __init__(self, ids: np.ndarray, taken: np.ndarray, power: np.ndarray):
        self.ids, self.taken, self.power = ids, taken.copy(), power
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        self.sums = np.zeros(len(ids) + 1, np.uint64)
        # sum of mixed[k] * BASE**k: windows are compared after lifting them to one exponent, which needs no loop.
        np.cumsum(mixed * power[: len(ids)], out=self.sums[1:])

    def free(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows of `size` words of which none is taken."""
        used = np.concatenate(([0], np.cumsum(self.taken)))
        starts = np.flatnonzero(used[size:] == used[: len(used) - size])
        return starts, (self.sums[starts + size] - self.sums[starts]) * self.power[len(self.power) - 1 - starts]

    def is_free(self, start: int, size: int) -> bool:
        return not self.taken[start : start + size].any()


def _mark(doc: Windows, item: Windows, size: int) -> Iterator[tuple[int, int]]:
    """Take the matches of `size` words that are free in both, first in the item, then in the document; gives (start in doc, start in item)."""
    places, hashes = doc.free(size)
    order = np.argsort(hashes, kind="stable")
    places, hashes = places[order], hashes[order]
    starts, wanted = item.free(size)
    lo, hi = np.searchsorted(hashes, wanted, "left"), np.searchsorted(hashes, wanted, "right")
    past: dict[int, int] = {}  # places before it are taken
    for b, first, end in zip(starts[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
        if not item.is_free(b, size):
            continue
        at = past.get(first, first)
        while at < end and not doc.is_free(places[at], size):
            at += 1
        past[first] = at
        while at < end:
            a = int(places[at])
            if doc.is_free(a, size) and np.array_equal(doc.ids[a : a + size], item.ids[b : b + size]):
                doc.taken[a : a + size] = True
                item.taken[b : b + size] = True
                yield a, b
                break
            at += 1


def tile(doc: np.ndarray, item: np.ndarray, least: int = 5) -> list[tuple[int, int, int]]:
    """Greedy tiles (start in doc, start in item, length), longest first; ties by start in the item, then in the document.

    The longest match is found by halving: whether some free window of a length stands in both texts is asked of the
    windows' hashes. Memory is a few numbers for each word, however often words repeat.
    """
    seeds = rolling(doc, least)
    hit = np.flatnonzero(np.isin(seeds, rolling(item, least)))
    if not len(hit):
        return []
    # Words in no common seed are in no match: what is left of the document, with a break wherever some are missing.
    near = np.zeros(len(doc) + 1, np.int64)
    np.add.at(near, hit, 1)
    np.add.at(near, hit + least, -1)
    place = np.flatnonzero(np.cumsum(near)[:-1])
    breaks = np.flatnonzero(np.diff(place) != 1) + 1
    place = np.insert(place, breaks, -1)
    words_left = np.where(place < 0, -2, doc[place])
    with np.errstate(over="ignore"):
        power = np.concatenate(([np.uint64(1)], np.cumprod(np.full(max(len(place), len(item)), BASE, np.uint64))))
        left, right = Windows(words_left, place < 0, power), Windows(item, np.zeros(len(item), bool), power)
        tiles, most = [], min(len(item), int(np.diff(np.concatenate(([-1], np.flatnonzero(place < 0), [len(place)]))).max()) - 1)
        while most >= least:
            low = least - 1
            while low < most:
                size = (low + most + 1) // 2
                if np.isin(right.free(size)[1], left.free(size)[1]).any():
                    low = size
                else:
                    most = size - 1
            if most >= least:
                tiles += [(int(place[a]), b, most) for a, b in _mark(left, right, most)]
            most -= 1
    return tiles


class Items:
    """A block of items: their words as small numbers, and the seeds of all of them in order."""

    def __init__(self, rows: list[tuple[int | None, str]], least: int):
        self.vocabulary: dict[str, int] = {}
        self.rows, hashes, owners = [], [], []
        for item_id, text in rows:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)], np.int64)
            got = np.unique(rolling(ids, least))
            hashes.append(got)
            owners.append(np.full(len(got), len(self.rows)))
            self.rows.append((item_id, ids))
        seeds, owner = np.concatenate(hashes), np.concatenate(owners)
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.owner = seeds[order], owner[order]

    def candidates(self, ids: np.ndarray, least: int) -> list[int]:
        known = ids > 0
        if np.count_nonzero(known) < least or not len(self.seeds):
            return []
        h = rolling(ids, least)
        whole = np.convolve(known, np.ones(least, np.int64), "valid") == least
        h = np.unique(h[whole])
        lo, hi = np.searchsorted(self.seeds, h, "left"), np.searchsorted(self.seeds, h, "right")
        return sorted({int(x) for a, b in zip(lo[hi > lo].tolist(), hi[hi > lo].tolist()) for x in self.owner[a:b]})

    def hits(self, text: str | None, threshold: float, least: int) -> list[tuple]:
        """(item_id, words of the item, words covered, tiles) of the items in a text."""
        number = self.vocabulary.get
        ids = np.array([number(w, 0) for w in words(text)], np.int64)
        found = []
        for k in self.candidates(ids, least):
            item_id, item = self.rows[k]
            # An unknown word equals none.
            tiles = tile(np.where(ids > 0, ids, -1), item, least)
            covered = sum(t[2] for t in tiles)
            if covered >= threshold * len(item):
                found.append((item_id, len(item), covered, len(tiles)))
        return found


def _blocks(items: Iterator, most: int) -> Iterator[list]:
    block, size = [], 0
    for item_id, text in items:
        n = len(words(text))
        if block and size + n > most:
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += n
    if block:
        yield block


def _plain(items: DataFrame) -> DataFrame:
    return items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL")


def seed_hashes(text: str | None, least: int) -> list[str]:
    found = words(text)
    return [" ".join(found[k : k + least]) for k in range(len(found) - least + 1)]


def _may_share(docs: DataFrame, items: DataFrame, text: str, least: int) -> DataFrame:
    """The rows of docs whose text may share `least` words in a row with some item."""
    name = free_name(docs.columns, "seeds")
    kind = "array<long>"

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[zlib.crc32(s.encode("utf-8", "replace")) for s in seed_hashes(t.as_py(), least)] for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int64()))], ["s"])

    seeds = materialize(items.select("text").mapInArrow(hashed, f"s {kind}").select(F.explode("s").alias("s")).distinct(), "seeds")
    held = docs.sparkSession.sparkContext.broadcast(key_filter(seeds.select(F.col("s").alias(name)), name))
    mix = xxhash.xxh64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for t in batch.column(text):
                crc = {zlib.crc32(s.encode("utf-8", "replace")) for s in seed_hashes(t.as_py(), least)}
                h = np.fromiter((mix(c.to_bytes(8, "little"), 42) for c in crc), np.uint64, len(crc)).view(np.int64)
                keep.append(bool(may_hold(held.value, h).any()) if len(h) else False)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.8, least: int = 5, block_words: int = 1_000_000) -> DataFrame:
    """One row for each document and item in it: coverage is the share of the item's words that tiles cover."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    items = _plain(items)
    result = None
    for n, block in enumerate(_blocks((tuple(r) for r in items.toLocalIterator()), block_words)):
        if n == 1:
            texts = materialize(_may_share(texts, items, "text", least), "candidates")
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            known = Items(held.value, least)
            for batch in batches:
                out = [
                    (doc_id, *hit, hit[2] / hit[1])
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1))
                    for hit in known.hits(text.as_py(), threshold, least)
                ]
                columns = zip(*out) if out else [()] * 6
                kinds = (pa.int64(),) * 5 + (pa.float64(),)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [x.split()[0] for x in SCHEMA.split(", ")])

        found = texts.mapInArrow(run, SCHEMA)
        if n:  # written block by block, so that one broadcast is needed at a time
            found = materialize(found, "hits")
            held.destroy()
        result = found if result is None else result.unionAll(found)
    return result if result is not None else docs.sparkSession.createDataFrame([], SCHEMA)


def keep_clean(docs: DataFrame, items: DataFrame, threshold: float = 0.8, least: int = 5, block_words: int = 1_000_000) -> DataFrame:
    """The rows of docs in which no item is. With one block of items documents are read once; with several the texts that hold an
    item are found block by block (``contaminated``), and the rows that have one of these texts go by a join on its hash."""
    spark, text = docs.sparkSession, free_name(docs.columns, "plain")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    blocks = _blocks((tuple(r) for r in _plain(items).toLocalIterator()), block_words)
    block, more = next(blocks, None), next(blocks, None) is not None
    blocks.close()
    if block is None:
        return docs
    if more:
        mark = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
        found = contaminated(docs.select(mark.alias("doc_id"), "text"), items, threshold, least, block_words)
        bad = materialize(found.select(F.col("doc_id").alias(text)).distinct(), "contaminated")
        return docs.join(bad, mark == bad[text], "left_anti")
    held = spark.sparkContext.broadcast(block)
    given = docs.select("text").schema[0]
    if isinstance(given.dataType, StringType):  # no text goes to Python twice
        text = given.name
    else:
        docs = docs.withColumn(text, F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Items(held.value, least)
        for part in parts(batches):
            yield part.filter(pa.array([not known.hits(t.as_py(), threshold, least) for t in part.column(text)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema).select(*columns)
