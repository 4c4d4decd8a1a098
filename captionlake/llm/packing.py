"""Packing into fixed windows by the sum-of-squares rule for online bin packing.

A document's ids are cut into whole windows and a rest; the rest goes to the fill level h that makes the sum of the squared
counts of partially filled windows least. The counts are a level array, one entry for each fill level. Every partition
packs its own stream, so there is no shuffle, and a task that is run again gives the same rows.

A stream ends with up to about a thousand windows open, since every level of one token may hold some. Their pieces are placed
once more by the same rule over wider levels (``grains``, 128 tokens), where a window is full when its levels say so and the
tokens that rounding leaves free are topped up from the next piece. Only the windows that are open even then, some ten for
each partition, are closed by cutting: their pieces are laid end to end and cut at window borders, and what is left at the
very end is cut into powers of two, which need no padding. The same cutting is a guard of memory when more than ``max_open``
windows are open (8,192, at most 32 MB of ids), which the rule keeps far below.

Edge cases: null and empty texts are documents of the one id 0; of levels that are equally good the fullest is taken;
repeated rows are packed as often as they stand; a null doc_id is carried along; very long texts are tokenised whole; extra
columns, whatever their names, are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@lru_cache(maxsize=4)
def byte_bpe(json_path: str, ranks_path: str, pattern: str, special: str = "<|endoftext|>") -> Callable[[str], np.ndarray]:
    """text -> ids as the tokenizer file gives them without added special tokens; kept for a worker's next tasks.

    The rank file of the same vocabulary gives the same ids several times as fast; a text that holds the special string,
    which is one id there, goes to the tokenizer file itself.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    whole: list[Tokenizer] = []

    def encode(text: str) -> np.ndarray:
        if special not in text:
            return np.array(fast(text), "<u4")
        if not whole:
            whole.append(Tokenizer.from_file(json_path))
        return np.array(whole[0].encode(text, add_special_tokens=False).ids, "<u4")

    return encode


class Packer:
    """The level array and the open windows of one stream. rows: (doc_id, start, ids, doc_tokens, sequence, offset).

    A level is a fill rounded up to whole grains. With a grain of one token a window is full when it is filled exactly; with
    a wider one it is full when the levels say so, and the tokens that rounding leaves free, under two grains, are topped up
    from the piece that comes next.
    """

    def __init__(self, window: int = 1024, max_open: int = 8192, first: int = 0, grain: int = 1):
        self.window, self.max_open, self.sequence = window, max_open, first
        self.rows: list[tuple] = []
        #: Counts the pieces that came; a piece is (turn, doc_id, start, ids, doc_tokens).
        self.turn = 0
        self.closed = {"whole": 0, "rule": 0, "cut": 0}
        self.clear(grain)

    def clear(self, grain: int) -> None:
        if self.window % grain:
            raise ValueError(f"a window of {self.window} is no multiple of a grain of {grain}")
        self.grain, self.n_open = grain, 0
        self.levels = np.zeros(self.window // grain + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in self.levels]
        #: The full window that waits to be topped up, or none.
        self.short: list[tuple] = []

    def close(self, pieces: list[tuple], how: str) -> None:
        offset = 0
        for _, doc_id, start, ids, tokens in pieces:
            self.rows.append((doc_id, start, ids, tokens, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1
        self.closed[how] += 1

    def level_for(self, size: int) -> int:
        """The level to put a piece of so many grains on; 0 opens a window. Ties go to the fullest level."""
        n, w = self.levels, len(self.levels) - 1
        # What a level h adds to the sum: 1 - 2 n[h] if the window is completed, since it leaves the array, else 2 (n[h + size] - n[h] + 1).
        added = 2 - 2 * n[1 : w - size + 1]
        added[:-1] += 2 * n[size + 1 : w]
        added[-1:] -= 1
        added[n[1 : w - size + 1] == 0] = np.iinfo(np.int64).max
        if len(added):
            h = len(added) - int(np.argmin(added[::-1]))
            if added[h - 1] <= 2 * n[size] + 1:
                return h
        return 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        w, tokens, start = self.window, len(ids), 0
        while tokens - start >= w:
            self.close([(self.turn, doc_id, start, ids[start : start + w], tokens)], "whole")
            start += w
        if start < tokens:
            self.turn += 1
            self.put(self.turn, doc_id, start, np.array(ids[start:]), tokens)
            if self.n_open > self.max_open:
                self.compact()

    def put(self, turn: int, doc_id, start: int, ids: np.ndarray, tokens: int) -> None:
        """Place a piece shorter than a window."""
        if self.short:
            part = ids[: self.window - sum(len(p[3]) for p in self.short)]
            self.settle([*self.short, (turn, doc_id, start, part, tokens)])
            start, ids = start + len(part), ids[len(part) :]
            if not len(ids):
                return
        size = -(-len(ids) // self.grain)
        h = self.level_for(size) if size < len(self.levels) - 1 else 0
        pieces = [] if not h else self.open[h].pop()
        if h:
            self.levels[h] -= 1
            self.n_open -= 1
        self.settle([*pieces, (turn, doc_id, start, ids, tokens)])

    def settle(self, pieces: list[tuple]) -> None:
        """Close a window that is full, let it wait if only its topping is missing, or enter it in the level array."""
        fill = sum(len(p[3]) for p in pieces)
        if fill == self.window:
            self.short = []
            self.close(pieces, "rule")
        elif fill >= self.window - 2 * (self.grain - 1):
            self.short = pieces
        else:
            level = -(-fill // self.grain)
            self.open[level].append(pieces)
            self.levels[level] += 1
            self.n_open += 1

    def drain(self) -> list[tuple]:
        return [*self.short, *(p for level in reversed(self.open) for pieces in level for p in pieces)]

    def coarsen(self, grain: int) -> None:
        """Place the pieces of all open windows once more, in the order they came, by the same rule over wider levels."""
        pieces = sorted(self.drain(), key=lambda p: (p[0], p[2]))
        self.clear(grain)
        for piece in pieces:
            self.put(*piece)

    def compact(self, last: bool = False) -> None:
        """Lay the open windows end to end, fullest first, and cut them at window borders; the last rest becomes one open window again."""
        pieces = self.drain()
        self.clear(self.grain)
        left = sum(len(p[3]) for p in pieces)
        at, offset = 0, 0
        while left:
            room = self.window if left >= self.window else (1 << left.bit_length() - 1 if last else left)
            taken, got = [], 0
            while got < room:
                turn, doc_id, start, ids, tokens = pieces[at]
                part = ids[offset : offset + room - got]
                taken.append((turn, doc_id, start + offset, part, tokens))
                got += len(part)
                offset += len(part)
                if offset == len(ids):
                    at, offset = at + 1, 0
            left -= room
            if room == self.window or last:
                self.close(taken, "cut")
            else:
                self.settle(taken)

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        doc_id, start, ids, tokens, sequence, offset = zip(*rows) if rows else [()] * 6
        arrays = [
            pa.array(doc_id, pa.int64()), pa.array(start, pa.int64()), pa.array(map(len, ids), pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64()),
            pa.array(tokens, pa.int64()), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in SCHEMA.split(", ")])


def pack(
    docs: DataFrame, tokenizer: Callable[[], Callable[[str], np.ndarray]], window: int = 1024, end_id: int = 0, max_open: int = 8192, grains: tuple[int, ...] = (128,)
) -> DataFrame:
    """One row for each piece of a document. tokenizer makes, in a worker, the function from text to ids; grains are the wider levels of the stream's end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, max_open, TaskContext.get().partitionId() << 36)
        encode, end = tokenizer(), np.array([end_id], "<u4")
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc_id, np.concatenate((encode(text.as_py() or ""), end)))
                if len(packer.rows) >= 20_000:
                    yield packer.take()
        for grain in grains:
            packer.coarsen(grain)
        packer.compact(last=True)
        yield packer.take()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def public_tokenizer(name: str = "byte_bpe_50k", folder: str | None = None) -> Callable[[], Callable[[str], np.ndarray]]:
    """A tokenizer of the public vocabulary files; folder overrides where they are installed."""

    def make() -> Callable[[str], np.ndarray]:
        import public_tokenizers as P

        path = (lambda x: f"{folder}/{x}") if folder else P.path
        return byte_bpe(path(f"{name}.json"), path(f"{name}.tiktoken"), P.PATTERN)

    return make
