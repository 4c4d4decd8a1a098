"""Quality by nearest-neighbour voting over latent-semantic vectors.

Terms of a text are its words in lower case, hashed; the shapes of its words (upper, lower, digits, other signs as they
stand, runs shortened) and pairs of neighbouring shapes; and how often a word, a run of five words or a line repeats.
Term shares are reduced to ``rank`` latent dimensions by a truncated singular value decomposition. At most
``sample_rows`` labelled vectors are broadcast (fixed size); for every document the cosine with all of them is computed
exactly, in blocks, and its nearest vote with their labels, weighted by similarity.

Edge cases: null and empty texts have only the term of their length and are scored like any other; cosines are rounded to
five places, and all labelled texts that tie with the last neighbour vote too, so that a score doesn't depend on the
block; repeated rows and null doc_id are kept as rows and scored alike; labelled rows that share a doc_id are one; without
labelled rows all scores are one half; texts are read whole, however long; extra columns, whatever their names, are
ignored; an empty table gives an empty result.
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

from .learning import held_out, training_rows

SHAPES, PAIRS, WORDS, CACHE = 512, 1024, 2048, 200_000
#: Counts behind the shapes and pairs: word as before it, as two before it, repeated window of five, repeated line; then lengths by powers of two.
COUNTS, LENGTHS = 4, 24
PLAIN = SHAPES + PAIRS + COUNTS + LENGTHS
WIDTH = PLAIN + WORDS
RUN = re.compile(r"(.)\1{2,}", re.S)
_kept: dict[str, tuple[int, int]] = {}


def _terms(word: str) -> tuple[int, int]:
    """Hashes of the shape of a word and of the word itself."""
    got = _kept.get(word)
    if got is None:
        if len(_kept) >= CACHE:
            _kept.clear()
        form = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
        hashed = lambda x, n: zlib.crc32(x.encode("utf-8", "replace")) % n
        _kept[word] = got = hashed(RUN.sub(r"\1\1", form), SHAPES), hashed(word.lower(), WORDS)
    return got


def features(text: str | None) -> np.ndarray:
    """Roots of the shares of the text's terms."""
    text = text or ""
    found = text.split()
    n, out = len(found), np.zeros(WIDTH, np.float32)
    out[SHAPES + PAIRS + COUNTS + min(n.bit_length(), LENGTHS - 1)] = 0.3
    if not n:
        return out
    shapes, own = np.array([_terms(w) for w in found], np.int64).T
    out[PLAIN:] = np.sqrt(np.bincount(own, minlength=WORDS) / n)
    out[:SHAPES] = np.sqrt(np.bincount(shapes, minlength=SHAPES) / n)
    if n > 1:
        pairs = (shapes[:-1] * 1_000_003 + shapes[1:] * 7_919) % PAIRS
        out[SHAPES : SHAPES + PAIRS] = np.sqrt(np.bincount(pairs, minlength=PAIRS) / (n - 1))
    words = np.fromiter(map(hash, found), np.int64, n).view(np.uint64)
    counts = [np.count_nonzero(words[k:] == words[:-k]) / n for k in (1, 2)]
    if n >= 5:
        mixed = words[4:].copy()
        for k in range(4):
            mixed = mixed + words[k : n - 4 + k] * np.uint64(0x9E3779B97F4A7C15 + 2 * k * 0x632BE5AB)
        counts.append(1 - len(np.unique(mixed)) / len(mixed))
    else:
        counts.append(0.0)
    lines = [x for x in text.split("\n") if x.strip()]
    counts.append(1 - len(set(lines)) / max(1, len(lines)))
    out[SHAPES + PAIRS : SHAPES + PAIRS + COUNTS] = np.sqrt(counts)
    return out


@dataclass
class Space:
    """mean: of the sample; basis: terms to latent dimensions; vectors: of length one, with their labels."""

    mean: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    y: np.ndarray

    def project(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.basis
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)

    def vote(self, x: np.ndarray, neighbours: int = 15, block: int = 512) -> np.ndarray:
        if not len(self.y):
            return np.full(len(x), 0.5)
        out = np.empty(len(x))
        k = min(neighbours, len(self.y))
        for a in range(0, len(x), block):
            cosine = np.round(self.project(x[a : a + block]) @ self.vectors.T, 5).astype(np.float64)
            last = np.partition(cosine, -k, axis=1)[:, -k]
            weight = np.where(cosine >= last[:, None], np.exp(20.0 * (cosine - 1)), 0)
            out[a : a + block] = (weight @ self.y) / weight.sum(axis=1)
        return np.clip(out, 0, 1)


def fit(x: np.ndarray, y: np.ndarray, rank: int = 48, seed: int = 7) -> Space:
    """The leading singular vectors of x less its mean, by power iterations of random ones."""
    if not len(x):
        return Space(np.zeros(WIDTH, np.float32), np.zeros((WIDTH, rank), np.float32), np.zeros((0, rank), np.float32), y)
    mean = x.mean(axis=0)
    up, down = (lambda v: x @ v - mean @ v), (lambda v: x.T @ v - np.outer(mean, v.sum(axis=0)))
    basis = np.random.default_rng(seed).normal(size=(x.shape[1], rank + 16)).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(down(up(basis)))
    _, _, turn = np.linalg.svd(up(basis), full_matrices=False)
    space = Space(mean, np.ascontiguousarray((basis @ turn.T)[:, :rank]), np.zeros((0, rank), np.float32), y.astype(np.float32))
    space.vectors = space.project(x)
    return space


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = 6000) -> Space:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                found = [features(t.as_py()).astype("<f2").tobytes() for t in part.column(1)]  # a fixed size for each row
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary()), part.column(2)], ["doc_id", "x", "y"])

    rows = training_rows(docs, labels, label, sample_rows, balanced=False).select("doc_id", "text", "y")
    got = sorted(rows.mapInArrow(run, "doc_id long, x binary, y int").toArrow().to_pylist(), key=lambda r: (r["doc_id"], r["x"]))
    x = np.array([np.frombuffer(r["x"], "<f2") for r in got], np.float32).reshape(len(got), WIDTH)
    return fit(x, np.array([r["y"] for r in got], np.float32))


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample_rows: int = 6000) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score, predicted."""
    held = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample_rows=sample_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = held.value
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                scores = space.vote(np.array([features(t.as_py()) for t in part.column(1)], np.float32))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
