"""Ranked lexical search: compressed postings in shards, read document at a time.

``build_index`` cuts every partition of the documents into shards of about ``shard_postings`` postings, where it stands: a
shard is made by one task from rows that it has read, and no text is shuffled. In a shard documents are numbered by
doc_id; a term's postings are compressed to the gaps between the numbers and the counts, each list in the narrowest whole
numbers that hold it. A row without a term holds the shard's doc_ids and lengths.

``search`` takes the queries in blocks of bounded size. The postings of a block's terms are grouped by shard; in a shard a
heap merges the lists of a query's terms by document, a second heap of ``top`` entries keeps the best, least score and
largest document first out. Lists whose greatest scores together can't beat the worst kept entry are left out of the merge and
looked up for its documents only, so that frequent words cost little and the result stays exact. The bests of all shards
are merged by a window that Spark limits on both sides of its exchange.

Edge cases: null text has no terms, is no document in the counts and is never found; repeated rows are documents of their
own, and so are repeated items; a null doc_id is carried along and comes last among equal scores; a null item_id is an item;
terms that no document holds add nothing; long texts are read whole; an item larger than a block is a block of its own;
other columns, whatever their names, are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Bytes between terms become blanks, A-Z become small letters; what is not ASCII stays.
CLEAN = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()
LAST = np.iinfo(np.int64).max
INDEX = "shard long, term string, n_docs long, n_terms long, data binary"
HITS = "query long, doc_id long, score long"


class Index(NamedTuple):
    """postings (shard, term, n_docs, n_terms, data); n_docs documents with a term, n_terms terms in them."""

    postings: DataFrame
    n_docs: int
    n_terms: int


def terms(text: str | None) -> list[str]:
    return text.encode("utf-8", "replace").translate(CLEAN).decode().split(" ") if text else []


def _width(most: int) -> int:
    return 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8


def pack(gaps: np.ndarray, counts: np.ndarray) -> bytes:
    """The widths of both lists in bytes, then the lists in them."""
    a, b = _width(int(gaps.max())), _width(int(counts.max()))
    return bytes((a, b)) + gaps.astype(f"<u{a}").tobytes() + counts.astype(f"<u{b}").tobytes()


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    a, b = data[0], data[1]
    n = (len(data) - 2) // (a + b)
    return np.frombuffer(data, f"<u{a}", n, 2).astype(np.int64), np.frombuffer(data, f"<u{b}", n, 2 + n * a).astype(np.int64)


class Shard:
    """Documents of a shard while it is made: a posting is the document's place, shifted, and the count."""

    def __init__(self):
        self.ids: list[int] = []
        self.lengths: list[int] = []
        self.lists: dict[str, list[int]] = {}
        self.postings = 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        found = Counter(terms(text))
        del found[""]
        if found:
            place, lists = len(self.ids) << 32, self.lists
            self.ids.append(LAST if doc_id is None else doc_id)
            self.lengths.append(found.total())
            self.postings += len(found)
            for term, n in found.items():
                if term in lists:
                    lists[term].append(place | n)
                else:
                    lists[term] = [place | n]

    def rows(self, shard: int) -> Iterator[tuple]:
        ids, lengths = np.array(self.ids, np.int64), np.array(self.lengths, np.int64)
        order = np.argsort(ids, kind="stable")
        number = np.empty_like(order)
        number[order] = np.arange(len(order))
        yield shard, None, len(ids), int(lengths.sum()), zlib.compress(np.stack((ids[order], lengths[order])).tobytes(), 1)
        for term in sorted(self.lists):
            found = self.lists.pop(term)
            if len(found) == 1:
                doc, n = int(number[found[0] >> 32]), found[0] & 0xFFFFFFFF
                a, b = _width(doc), _width(n)
                yield shard, term, 1, n, bytes((a, b)) + doc.to_bytes(a, "little") + n.to_bytes(b, "little")
                continue
            both = np.array(found, np.int64)
            docs, counts = number[both >> 32], both & 0xFFFFFFFF
            by_doc = np.argsort(docs)
            yield shard, term, len(docs), int(counts.sum()), pack(np.diff(docs[by_doc], prepend=0), counts[by_doc])


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def build_index(docs: DataFrame, shard_postings: int = 1_000_000) -> Index:
    """The index of all rows of docs (doc_id, text), written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard, out = TaskContext.get().partitionId() << 32, Shard(), []

        def finished(everything: bool) -> Iterator[pa.RecordBatch]:
            for row in shard.rows(number) if shard.ids else ():
                out.append(row)
                if len(out) == 10_000:
                    yield _batch(out, INDEX)
                    out.clear()
            if everything:
                yield _batch(out, INDEX)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard.add(doc_id, text.as_py())
                if shard.postings >= shard_postings:
                    yield from finished(False)
                    number, shard = number + 1, Shard()
        yield from finished(True)

    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    postings = materialize(plain.mapInArrow(run, INDEX), "postings")
    n, total = postings.where("term IS NULL").agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    return Index(postings, n, total)


class Cursor(NamedTuple):
    """A term of a query in a shard: documents in order, what each adds to the score, and the most that one adds."""

    docs: list[int]
    adds: list[int]
    most: int


def best_of(cursors: list[Cursor], top: int) -> list[tuple[int, int]]:
    """(score, document) of the best documents by score, then by number, in no order."""
    cursors = sorted(cursors, key=lambda c: c.most)
    sums = np.cumsum([c.most for c in cursors]).tolist()
    kept: list[tuple[int, int]] = []  # (score, -document), the worst first
    least, out = 0, 0  # scores up to least can't enter; cursors before out are looked up only
    heap = [(c.docs[0], k) for k, c in enumerate(cursors)]
    heapq.heapify(heap)
    at = [0] * len(cursors)
    while heap:
        doc, score = heap[0][0], 0
        while heap and heap[0][0] == doc:
            k = heap[0][1]
            c, p = cursors[k], at[k]
            score += c.adds[p]
            at[k] = p = p + 1
            if p == len(c.docs):
                heapq.heappop(heap)
            else:
                heapq.heapreplace(heap, (c.docs[p], k))
        for k in range(out - 1, -1, -1):
            if score + sums[k] <= least:
                break
            c = cursors[k]
            at[k] = p = bisect_left(c.docs, doc, at[k])
            if p < len(c.docs) and c.docs[p] == doc:
                score += c.adds[p]
        if score > least:
            if len(kept) < top:
                heapq.heappush(kept, (score, -doc))
            else:
                heapq.heapreplace(kept, (score, -doc))
            if len(kept) == top:
                least = kept[0][0]
                if out < len(cursors) and sums[out] <= least:
                    while out < len(cursors) and sums[out] <= least:
                        out += 1
                    heap = [e for e in heap if e[1] >= out]
                    heapq.heapify(heap)
    return [(score, -doc) for score, doc in kept]


def _weights(index: Index, queries: DataFrame) -> DataFrame:
    """(query, term, times, weight) of the terms that some document holds."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for query, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = Counter(terms(text.as_py()))
                del found[""]
                yield _batch([(query, t, n) for t, n in found.items()], "query long, term string, times long")

    found = materialize(queries.mapInArrow(split, "query long, term string, times long"), "query-terms")
    held = index.postings.where("term IS NOT NULL").join(found.select("term").distinct(), "term", "left_semi")
    df = held.groupBy("term").agg(F.sum("n_docs").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(index.n_docs) + 2) / (2 * F.col("df") + 1))).cast("long")
    return materialize(found.join(df, "term").select("query", "term", "times", weight.alias("weight")), "weights")


def _blocks(weights: DataFrame, most: int) -> Iterator[list[tuple]]:
    """Rows of whole queries, at most `most` of them unless a query has more alone. Sizes of queries are read as they come."""
    first, size = None, 0
    for query, n in weights.groupBy("query").agg(F.count(F.lit(1)).alias("n")).orderBy("query").toLocalIterator():
        if first is not None and size + n > most:
            yield [tuple(r) for r in weights.where(F.col("query").between(first, before)).collect()]
            first = None
        if first is None:
            first, size = query, 0
        before, size = query, size + n
    if first is not None:
        yield [tuple(r) for r in weights.where(F.col("query").between(first, before)).collect()]


def _search_block(index: Index, block: list[tuple], top: int) -> DataFrame:
    spark = index.postings.sparkSession
    n_docs, n_terms = index.n_docs, index.n_terms
    wanted: dict[int, list] = {}
    weight: dict[str, int] = {}
    for query, term, times, w in block:
        if w:
            wanted.setdefault(query, []).append((term, times))
            weight[term] = w
    held = spark.sparkContext.broadcast((wanted, weight))

    def run(table: pa.Table) -> pa.Table:
        wanted, weight = held.value
        data = dict(zip(table.column("term").to_pylist(), table.column("data").to_pylist()))
        ids, lengths = np.frombuffer(zlib.decompress(data.pop(None)), np.int64).reshape(2, -1)
        m = 12 * (100 - 25 + 25 * lengths * n_docs // n_terms)
        lists = {}
        for term, packed in data.items():
            gaps, tf = unpack(packed)
            docs = np.cumsum(gaps)
            adds = weight[term] * (1_000_000_000 * tf // (1000 * tf + m[docs]))
            lists[term] = Cursor(docs.tolist(), adds.tolist(), int(adds.max()))
        out = []
        for query, parts in wanted.items():
            cursors = []
            for term, times in parts:
                if c := lists.get(term):
                    cursors.append(c if times == 1 else Cursor(c.docs, [times * x for x in c.adds], times * c.most))
            for score, doc in best_of(cursors, top):
                doc_id = int(ids[doc])
                out.append((query, None if doc_id == LAST else doc_id, score))
        return pa.Table.from_batches([_batch(out, HITS)])

    # The block bounds the terms that are broadcast; every shard comes with its row of documents.
    asked = F.broadcast(spark.createDataFrame([(t,) for t in weight], "term string"))
    found = index.postings.where("term IS NOT NULL").join(asked, "term", "left_semi").select("shard", "term", "data")
    found = found.unionByName(index.postings.where("term IS NULL").select("shard", "term", "data"))
    return found.groupBy("shard").applyInArrow(run, HITS)


def search(index: Index, items: DataFrame, top: int = 20, block_terms: int = 200_000) -> DataFrame:
    """The `top` best documents of each row of items (item_id, text): item_id, rank, doc_id, score."""
    numbered = materialize(items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).withColumn("query", F.monotonically_increasing_id()), "queries")
    weights = _weights(index, numbered.select("query", "text"))
    hits = None
    for block in _blocks(weights, block_terms):
        found = materialize(_search_block(index, block, top), "hits")
        hits = found if hits is None else hits.unionAll(found)
    if hits is None:
        return items.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(numbered.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
