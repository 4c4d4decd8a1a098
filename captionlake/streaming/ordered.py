"""Streams whose parts arrive in any order: replies of event lines, and sound cut anywhere.

A key's parts are numbered from 0. Those that come early are held in a map state by number; what continues the parts seen so
far is folded at once, so that the state is the fold and the parts beyond a gap, whatever the order or the cut into
micro-batches. A timer, set anew with every part, ends a key that has been quiet: parts beyond a gap that never closed are
folded in order, and what is left over is emitted. Rows are those of the batch readers on the same parts.

These operators keep state by ``transformWithState``, which needs the RocksDB state store; ``use_rocksdb`` sets it.

Edge cases: a part that comes again, or after its key has ended, is dropped; a null part counts as an empty one; a key
without parts has no row.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from captionlake.sources.readers import NO_STREAM, SHOWN

REPLY = "file_id long, content string, model string, finish string, usage string, errors array<string>, lines long, done boolean"
ENERGY = "file_id long, second long, l double, r double, mix double, diff double, blocks array<double>"


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class InOrder(StatefulProcessor):
    """Folds the parts of a key in the order of `ord`. Subclasses say what a part is (`kind`), what the fold is (`schema`) and give
    `begin`, `add` and the rows after some parts (`rows`) and at the end (`last`)."""

    kind = "string"
    schema = ""

    def __init__(self, quiet_ms: int):
        self.quiet_ms = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.place = handle.getValueState("place", "ord long, timer long")
        self.held = handle.getMapState("held", "ord long", f"part {self.kind}")
        self.fold = handle.getValueState("fold", self.schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        at, timer = self.place.get() if self.place.exists() else (0, 0)
        if at < 0:
            return
        early: dict[int, object] = {}
        for pdf in rows:
            early.update(zip(pdf["ord"].tolist(), pdf["part"].tolist()))
        fold = self.fold.get() if self.fold.exists() else self.begin()
        moved = False
        while True:
            if at in early:
                part = early.pop(at)
            elif self.held.containsKey((at,)):
                part = self.held.getValue((at,))[0]
                self.held.removeKey((at,))
            else:
                break
            fold, at, moved = self.add(fold, part), at + 1, True
        for n, part in early.items():
            if n > at:
                self.held.updateValue((n,), (part,))
        out, fold = self.rows(key[0], fold) if moved else ([], fold)
        if timer:
            self.handle.deleteTimer(timer)
        timer = timerValues.getCurrentProcessingTimeInMs() + self.quiet_ms
        self.handle.registerTimer(timer)
        self.place.update((at, timer))
        self.fold.update(fold)
        if out:
            yield self.frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        fold = self.fold.get() if self.fold.exists() else self.begin()
        for _, part in sorted((n[0], part[0]) for n, part in self.held.iterator()):
            fold = self.add(fold, part)
        out, fold = self.rows(key[0], fold)
        out += self.last(key[0], fold)
        self.held.clear()
        self.fold.clear()
        self.place.update((-1, 0))  # the end is kept, so that late parts are known as such
        if out:
            yield self.frame(out)

    def close(self) -> None:
        pass


class Replies(InOrder):
    """The reply so far: its text, the last model, reason to finish and usage, the errors, and how its body began."""

    schema = "content string, model string, finish string, usage string, errors array<string>, lines long, shown string, events boolean"

    def begin(self) -> tuple:
        return "", None, None, None, [], 0, None, None

    def add(self, fold: tuple, line: str | None) -> tuple:
        content, model, finish, usage, errors, lines, shown, events = fold
        line, errors = line or "", list(errors)
        if shown is None or len(shown) < SHOWN:
            shown = (line if shown is None else f"{shown}\n{line}")[:SHOWN]
        if events is None and line.strip():
            events = line.lstrip().startswith("data:")
        try:
            event = json.loads(line[5:]) if line.startswith("data:") else None
        except ValueError:
            event = None
        if isinstance(event, dict):
            lines += 1
            if "error" in event:
                errors.append(event["error"] if isinstance(event["error"], str) else json.dumps(event["error"], separators=(",", ":"), ensure_ascii=False))
            else:
                model = event.get("model") or model
                usage = json.dumps(event["usage"], separators=(",", ":"), ensure_ascii=False) if event.get("usage") else usage
                for choice in event.get("choices") or []:
                    content += (choice.get("delta") or {}).get("content") or ""
                    finish = choice.get("finish_reason") or finish
        return content, model, finish, usage, errors, lines, shown, events

    def rows(self, file_id: int, fold: tuple, done: bool = False) -> tuple[list[tuple], tuple]:
        return [(file_id, *fold[:4], list(fold[4]), fold[5], done)], fold

    def last(self, file_id: int, fold: tuple) -> list[tuple]:
        if fold[7] is False:
            fold = (*fold[:4], [*fold[4], NO_STREAM + fold[6]], *fold[5:])
        return self.rows(file_id, fold, True)[0]

    @staticmethod
    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows[-1:], columns=[x.split()[0] for x in REPLY.split(", ")])


class Sound(InOrder):
    """The number of the next second and the bytes that fill no second yet, down to parts of a sample."""

    kind = "binary"
    schema = "second long, rest binary"

    def __init__(self, quiet_ms: int, rate: int, per_sec: int):
        super().__init__(quiet_ms)
        self.rate, self.per_sec = rate, per_sec

    def begin(self) -> tuple:
        return 0, b""

    def add(self, fold: tuple, part: bytes | None) -> tuple:
        return fold[0], bytes(fold[1]) + bytes(part or b"")

    def energies(self, file_id: int, second: int, sound: bytes) -> tuple:
        x = np.frombuffer(sound, "<i2").reshape(-1, 2) / 32768.0
        l, r = x.T  # noqa: E741
        mean = lambda v: float(np.mean(v * v))
        size = self.rate // self.per_sec
        return file_id, second, mean(l), mean(r), mean((l + r) / 2), mean((l - r) / 2), [mean(x[k : k + size]) for k in range(0, len(x), size)]

    def rows(self, file_id: int, fold: tuple) -> tuple[list[tuple], tuple]:
        second, rest = fold
        size, out = 4 * self.rate, []
        for at in range(0, len(rest) - size + 1, size):
            out.append(self.energies(file_id, second, rest[at : at + size]))
            second += 1
        return out, (second, rest[len(rest) // size * size :])

    def last(self, file_id: int, fold: tuple) -> list[tuple]:
        whole = bytes(fold[1])[: len(fold[1]) // 4 * 4]
        return [self.energies(file_id, fold[0], whole)] if whole else []

    @staticmethod
    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[x.split()[0] for x in ENERGY.split(", ")])


def sse_fold(lines: DataFrame, quiet_ms: int = 60_000) -> DataFrame:
    """Replies so far from a stream of event lines (file_id, ord, line), in whatever order they arrive; the last row of one is done.

    Only data lines count; empty, [DONE] and broken ones are skipped. A reply that proves to be no event stream gets an
    error with the first 300 characters of its body when it is done. Errors and usage are JSON.
    """
    d = lines.select("file_id", "ord", F.col("line").alias("part"))
    return d.groupBy("file_id").transformWithStateInPandas(Replies(quiet_ms), REPLY, "Update", "ProcessingTime")


def pcm_energy(sound: DataFrame, rate: int = 8000, per_sec: int = 20, quiet_ms: int = 60_000) -> DataFrame:
    """Energies of seconds, and of their `per_sec` blocks, from a stream (file_id, ord, bytes) of interleaved 16-bit stereo cut anywhere.

    The seconds of a file come in order; when its sound has ended the rest of it, less than a second, is one too.
    """
    d = sound.select("file_id", "ord", F.col("bytes").alias("part"))
    return d.groupBy("file_id").transformWithStateInPandas(Sound(quiet_ms, rate, per_sec), ENERGY, "Append", "ProcessingTime")
