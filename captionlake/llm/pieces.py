"""SentencePiece encoding and decoding of merge-type models (BPE) by a table of prefixes.

The tokens of a prefix are the first tokens of any text that goes on after a token's end, so each prefix has one last
token. Prefixes are taken in order: of the pieces that an Aho-Corasick automaton finds to end there, the last token is
the one that is compatible with the last token of the prefix before it: merging the characters of these two pieces, best
score first and leftmost of equals, gives the two pieces again. The test plays the merges of both against the merge across
them; answers are remembered. The ids are recovered from the end backwards. The time is linear in the text, whatever it is.

No piece goes on after another character with the mark of a space, so a text falls into stretches that begin with such
marks. Short stretches are remembered with their ids. Both memories are emptied when they are full (``MOST``), so a
worker's memory has a bound.

Edge cases: null text is empty and has the begin and end ids only; characters that the model lacks become their bytes, or
the unknown id in a model without bytes, once for a run of them; characters of control are ordinary; long texts are
encoded whole; repeated rows give repeated rows; a null doc_id is carried along; other columns, whatever their names, are
carried along; an empty table gives an empty table. Decoding bytes that are no UTF-8 gives U+FFFD for each; null ids give
null.
"""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name

MARK = "▁"
STRETCH = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
#: Remembered stretches and pairs, and the characters of the longest stretch that is remembered.
MOST, SHORT = 250_000, 64
NEVER = float("-inf")
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

codecs.register_error("each-byte", lambda e: ("�" * (e.end - e.start), e.end))


class Pieces:
    """The pieces of a model file, their automaton, and what has been learnt of pairs and stretches."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{path}: only merge-type models that leave characters as they are")
        if any(MARK in p.piece.lstrip(MARK) for p in model.pieces if p.type == NORMAL):
            raise ValueError(f"{path}: a piece goes on after a character with the mark of a space")
        self.prefix = MARK if norm.add_dummy_prefix else ""
        self.text = [p.piece for p in model.pieces]
        self.id = {p.piece: k for k, p in enumerate(model.pieces) if p.type == NORMAL}
        self.score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.unknown = next(k for k, p in enumerate(model.pieces) if p.type == UNKNOWN)
        ids = {p.piece: k for k, p in enumerate(model.pieces)}
        self.begin, self.end = ids["<s>"], ids["</s>"]
        self.bytes = [ids[f"<0x{b:02X}>"] for b in range(256)] if BYTE in kinds else None
        surface = {UNKNOWN: model.trainer_spec.unk_surface.encode(), CONTROL: b""}
        self.surface = [
            bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else surface[p.type] if p.type in surface else p.piece.replace(MARK, " ").encode() for p in model.pieces
        ]
        self.leading = {k for k, p in enumerate(model.pieces) if p.type == NORMAL and p.piece.startswith(MARK)} if self.prefix else set()
        self.automaton = ahocorasick.Automaton()
        for piece, k in self.id.items():
            self.automaton.add_word(piece, (len(piece), k))
        self.automaton.make_automaton()
        self.made: dict[int, tuple | None] = {}
        self.pairs: dict[int, bool] = {}
        self.alone = [p.type == NORMAL and self.edges(k) is not None for k, p in enumerate(model.pieces)]
        self.known: dict[str, bytes] = {}

    def edges(self, piece: int) -> tuple[list[float], list[str], list[str]] | None:
        """How a piece comes about from its characters, best score first and leftmost of equals: the score of each merge,
        and the first and the last part before each merge and after all. None if other pieces come out."""
        if piece in self.made:
            return self.made[piece]
        parts, score = list(self.text[piece]), self.score.get
        scores, first, last = [], [parts[0]], [parts[-1]]
        while len(parts) > 1:
            found = [(s, -k) for k in range(len(parts) - 1) if (s := score(parts[k] + parts[k + 1])) is not None]
            if not found:
                break
            s, k = max(found)
            parts[-k : 2 - k] = [parts[-k] + parts[1 - k]]
            scores.append(s)
            first.append(parts[0])
            last.append(parts[-1])
        scores.append(NEVER)
        got = self.made[piece] = (scores, first, last) if len(parts) == 1 else None
        return got

    def compatible(self, left: int, right: int) -> bool:
        """Whether two pieces side by side come out as themselves: no merge across them is ever the next one."""
        key = left << 32 | right
        if len(self.pairs) >= MOST:
            self.pairs.clear()
        if not self.alone[right]:
            self.pairs[key] = False
            return False
        (before, _, last), (after, first, _) = self.edges(left), self.edges(right)
        i = j = 0
        score = self.score.get
        across = score(last[0] + first[0], NEVER)
        while not (across > before[i] and across >= after[j]):
            if before[i] >= after[j]:
                if before[i] == NEVER:
                    self.pairs[key] = True
                    return True
                i += 1
                if last[i] is last[i - 1]:
                    continue
            else:
                j += 1
                if first[j] is first[j - 1]:
                    continue
            across = score(last[i] + first[j], NEVER)
        self.pairs[key] = False
        return False

    def last_tokens(self, text: str) -> list[int]:
        """For each prefix but the empty one its last token; -1 where the last character is in no piece."""
        last = [-1] * len(text)
        answers, compatible, alone = self.pairs.get, self.compatible, self.alone
        for end, (size, piece) in self.automaton.iter(text):
            if last[end] >= 0:
                continue
            before = last[end - size] if end >= size else -1
            if before < 0:
                if alone[piece]:
                    last[end] = piece
                continue
            fits = answers(before << 32 | piece)
            if compatible(before, piece) if fits is None else fits:
                last[end] = piece
        return last

    def tokens(self, text: str) -> list[int]:
        """Ids of a stretch, recovered from its end backwards."""
        last, at, out, names = self.last_tokens(text), len(text), [], self.text
        while at:
            piece = last[at - 1]
            if piece >= 0:
                out.append(piece)
                at -= len(names[piece])
            else:
                at -= 1
                if self.bytes:
                    out.extend(self.bytes[b] for b in reversed(text[at].encode("utf-8", "replace")))
                elif not out or out[-1] != self.unknown:
                    out.append(self.unknown)
        out.reverse()
        return out

    def stretch(self, text: str) -> bytes:
        ids = self.tokens(text)
        got = struct.pack(f"<{len(ids)}I", *ids)
        if len(text) <= SHORT:
            if len(self.known) >= MOST:
                self.known.clear()
            self.known[text] = got
        return got

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers, with the begin and end ids."""
        marked = (self.prefix + text).replace(" ", MARK) if text else ""
        around = struct.pack("<2I", self.begin, self.end)
        known = self.known.get
        return b"".join((around[:4], *[known(s) or self.stretch(s) for s in STRETCH.findall(marked)], around[4:]))

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4").tolist()
        surface = self.surface
        # The mark of the first piece that shows anything is the one that encoding put there.
        first = next((k for k, i in enumerate(numbers) if surface[i]), None)
        if first is None:
            return ""
        skip = 1 if numbers[first] in self.leading else 0
        return b"".join(map(surface.__getitem__, numbers))[skip:].decode("utf-8", "each-byte")


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    """The pieces of a file; kept for a worker's next tasks."""
    return Pieces(path)


def public_model(name: str = "piece_bpe_32k", folder: str | None = None) -> Callable[[], Pieces]:
    """Pieces of a public model file; folder overrides where they are installed. The file is opened in the worker."""

    def make() -> Pieces:
        import public_tokenizers as P

        return load(f"{folder}/{name}.model" if folder else P.path(f"{name}.model"))

    return make


def _with_columns(df: DataFrame, names: dict[str, str], row: Callable[[Pieces], Callable], model: Callable[[], Pieces], source: str) -> DataFrame:
    """df and columns (name -> type) that row of the model makes, as a tuple, of column `source`. A taken name gets underscores before it."""
    taken = [free_name(df.columns, n) for n in names]
    at = len(df.columns)
    ready = df.withColumn(free_name(df.columns, "input"), F.col(f"`{source}`"))
    schema = df.select("*", *[F.lit(None).cast(k).alias(n) for n, k in zip(taken, names.values())]).schema
    kinds = [{"binary": pa.binary(), "string": pa.string()}[k] for k in names.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = row(model())
        for batch in batches:
            made = zip(*[apply(v.as_py()) for v in batch.column(at)]) if len(batch) else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], *map(pa.array, made, kinds)], schema.names)

    return ready.mapInArrow(run, schema)


def encode(docs: DataFrame, model: Callable[[], Pieces], text: str = "text", ids: str = "ids") -> DataFrame:
    """docs and a binary column of ids, little-endian unsigned 32-bit."""
    return _with_columns(docs, {ids: "binary"}, lambda m: lambda v: (m.encode(v),), model, text)


def decode(docs: DataFrame, model: Callable[[], Pieces], ids: str = "ids", text: str = "decoded") -> DataFrame:
    """docs and the text of their ids."""
    return _with_columns(docs, {text: "string"}, lambda m: lambda v: (None if v is None else m.decode(v),), model, ids)


def round_trip(docs: DataFrame, model: Callable[[], Pieces], text: str = "text", ids: str = "ids", back: str = "decoded") -> DataFrame:
    """docs with the ids of their text and the text of these ids: encode and decode in one worker."""

    def both(m: Pieces) -> Callable:
        def row(v: str | None) -> tuple[bytes, str]:
            got = m.encode(v)
            return got, m.decode(got)

        return row

    return _with_columns(docs, {ids: "binary", back: "string"}, both, model, text)
