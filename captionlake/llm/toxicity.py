"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its words in lower case and their first three to seven letters. A document is the set of its hashed
terms. The machine has a weight for each term and a vector whose products weigh pairs of terms that occur together.

Fitted on at most ``sample_rows`` labelled rows, half of each class as far as it goes; the intercept is then set back to
the share that the classes have among all labelled rows. The machine knows the ``alone`` terms whose presence tells the
classes apart best by chi-square, and, of the ``often`` terms that stand in most rows of label 1 besides, those that tell
them apart in a pair much better than either term of the pair alone (``GAIN``): terms that matter only together are
there too, without hundreds that matter not at all. The counts are a distributed aggregate; the driver gets the terms to
choose from and, for each sampled row, a bitmap of them, both of fixed size. Every document is scored whole, without a
shuffle.

Edge cases: null and empty texts have no terms and get the intercept's score; terms of equal rank are taken by their
number; repeated rows and null doc_id are kept as rows and scored alike; labelled rows that share a doc_id are one; very
long texts are sets of terms, as bounded as others; without labelled rows of both classes all documents get the share of
label 1 (one half without labels); extra columns, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .learning import class_counts, held_out, training_rows

WORD = re.compile(r"\w+")
BITS, PREFIXES, CACHE = 18, (3, 4, 5, 6, 7), 200_000
#: By how much the chi-square of a pair must exceed twice that of its better term; a chance pair among millions stays below; and of how many pairs terms are added.
GAIN, STRONGEST = 150.0, 32
_kept: dict[str, tuple[int, ...]] = {}


def _terms_of(word: str) -> tuple[int, ...]:
    got = _kept.get(word)
    if got is None:
        if len(_kept) >= CACHE:
            _kept.clear()
        forms = ["=" + word] + [word[:k] for k in PREFIXES if len(word) >= k]
        _kept[word] = got = tuple(zlib.crc32(f.encode("utf-8", "replace")) & (1 << BITS) - 1 for f in forms)
    return got


def terms(text: str | None) -> np.ndarray:
    """The distinct hashed terms of a whole text, in order."""
    found = set(WORD.findall((text or "").lower()))
    return np.array(sorted({t for w in found for t in _terms_of(w)}), np.int32)


@dataclass
class Machine:
    """place: hashed term -> row of weights and vectors, or -1."""

    place: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def score(self, found: np.ndarray) -> float:
        rows = self.place[found] if len(found) else found
        rows = rows[rows >= 0]
        v = self.vectors[rows]
        z = self.bias + self.weights[rows].sum() + 0.5 * float((v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def fit(x: np.ndarray, y: np.ndarray, terms_: np.ndarray, share: float, rank: int = 8, rounds: int = 60, seed: int = 7) -> Machine:
    """Adam on the logistic loss. x: rows by chosen terms, 0 or 1; terms_: the chosen terms."""
    place = np.full(1 << BITS, -1, np.int32)
    place[terms_] = np.arange(len(terms_))
    if not len(x) or y.min() == y.max():
        return Machine(np.full(1 << BITS, -1, np.int32), float(np.log(share / (1 - share))), np.zeros(0, np.float32), np.zeros((0, rank), np.float32))
    random = np.random.default_rng(seed)
    n1, n0, n = float(y.sum()), float((1 - y).sum()), x.shape[1]
    bias, w, v = np.zeros(1, np.float32), np.zeros(n, np.float32), random.normal(0, 0.01, (n, rank)).astype(np.float32)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (bias, w, v)]
    for step in range(1, rounds + 1):
        xv = x @ v
        # x is 0 or 1, so its square is itself.
        z = bias[0] + x @ w + 0.5 * ((xv**2).sum(axis=1) - x @ (v**2).sum(axis=1))
        g = ((1 / (1 + np.exp(-np.clip(z, -35, 35))) - y) / len(y)).astype(np.float32)
        xg = x.T @ g
        grads = (np.array([g.sum()], np.float32), xg + 1e-3 * w, x.T @ (xv * g[:, None]) - v * xg[:, None] + 1e-2 * v)
        for p, grad, s in zip((bias, w, v), grads, state):
            s[0] += 0.1 * (grad - s[0])
            s[1] += 0.01 * (grad**2 - s[1])
            p -= (0.05 * (s[0] / (1 - 0.9**step)) / (np.sqrt(s[1] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return Machine(place, float(bias[0]) + float(np.log(share / (1 - share)) - np.log(n1 / n0)), w, v)


def chi_square(a: np.ndarray, n: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """How well presence tells the classes apart: a of n rows with it have label 1."""
    expected = n * n1 / (n1 + n0)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.nan_to_num((a - expected) ** 2 / expected + (a - expected) ** 2 / (n - expected), posinf=0)


def candidates(rows: DataFrame, alone: int, often: int) -> tuple[np.ndarray, np.ndarray]:
    """Terms seen in three rows or more that are best alone, and the most frequent others of label 1; rows: (doc_id, y, terms)."""
    n, n1 = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    counts = rows.select("y", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("y").alias("a"), F.count(F.lit(1)).alias("n")).where("n >= 3")
    share = n1 / max(1, n)
    apart = F.expr(f"pow(a - n * {share}D, 2) / n")  # chi-square but for a factor that all terms share
    best = counts.where(apart > 0).orderBy(apart.desc(), "term").limit(alone)
    best = materialize(best.select("term"), "alone")
    more = counts.join(best, "term", "left_anti").where("a > 0").orderBy(F.col("a").desc(), "term").limit(often).select("term")
    return tuple(np.sort(x.toArrow().column(0).to_numpy()) for x in (best, more))


def paired(x: np.ndarray, y: np.ndarray, ours: np.ndarray) -> np.ndarray:
    """Which columns of x to keep: those of ours, and those that tell the classes apart in some pair."""
    n1, n0 = float(y.sum()), float((1 - y).sum())
    n, a = x.T @ x, x[y == 1].T @ x[y == 1]
    chi = np.where(n >= 3, chi_square(a, n, n1, n0), 0)
    own = np.diag(chi)
    gain = np.triu(chi - 2 * np.maximum(own[:, None], own[None, :]), 1).ravel()
    best = np.argsort(-gain, kind="stable")[:STRONGEST]
    pairs = np.unravel_index(best[gain[best] > GAIN], chi.shape)
    return ours | np.isin(np.arange(len(ours)), np.concatenate(pairs))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = 6000, alone: int = 2048, often: int = 1024) -> Machine:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32())), batch.column(2)], ["doc_id", "terms", "y"])

    rows = training_rows(docs, labels, label, sample_rows, balanced=True).select("doc_id", "text", "y")
    rows = materialize(rows.mapInArrow(run, "doc_id long, terms array<int>, y int"), "terms")
    best, more = candidates(rows, alone, often)
    known = np.concatenate([best, more]).astype(np.int64)
    place = np.full(1 << BITS, -1, np.int32)
    place[known] = np.arange(len(known))

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.zeros((batch.num_rows, alone + often), bool)
            for k, found in enumerate(batch.column(1)):
                at = place[found.values.to_numpy()]
                x[k, at[at >= 0]] = True
            packed = [r.tobytes() for r in np.packbits(x, axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary()), batch.column(2)], ["doc_id", "x", "y"])

    got = rows.mapInArrow(bits, "doc_id long, x binary, y int").toArrow().sort_by("doc_id")
    x = np.frombuffer(b"".join(got.column(1).to_pylist()), np.uint8).reshape(len(got), (alone + often + 7) // 8)
    x = np.unpackbits(x, axis=1)[:, : len(known)].astype(np.float32)
    y = got.column(2).to_numpy().astype(np.float32)
    keep = paired(x, y, np.arange(len(known)) < len(best))
    n0, n1 = class_counts(labels, label)
    return fit(np.ascontiguousarray(x[:, keep]), y, known[keep], (n1 + 1) / (n0 + n1 + 2))


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample_rows: int = 6000) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score, predicted."""
    held = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample_rows=sample_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = held.value
        for batch in batches:
            scores = [machine.score(terms(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
