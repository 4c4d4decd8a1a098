"""Data sources `srt` and `sse`: subtitle files read by cue and written by file, and saved replies read as event streams.

    register(spark)
    spark.read.format("srt").load(folder)                      # path, n, start_ms, end_ms, text
    spark.read.format("srt").schema("n long, text string").load(folder)   # only these are made
    spark.read.format("sse").load(folder)                      # path, content, model, finish, usage, errors
    write_srt(cues, folder)                                    # (sinks) file_id, n, start_ms, end_ms, text

A file is read as a stream of lines, so that memory is that of a cue or of a reply; it is a partition, or where a folder has
many files a share of them is, so that a task's start is no file's cost. Writing goes by task:
each writes its files to a folder of its own, in the order in which the rows come, and tells the driver their names; when all
tasks have ended the driver moves the files into place. A task that is lost or run twice leaves only files that nobody was
told of, which go with that folder.

Edge cases: an empty folder has no rows but keeps its schema; an empty file has no cue, and an empty reply; byte order marks
and all line ends are understood, bytes that are no UTF-8 become U+FFFD; a cue without a time line or without text is none;
a time that can't be read is null; a null text is written as an empty cue, which is none when read.
"""

from __future__ import annotations

import io
import posixpath
import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyarrow import fs as arrow_fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

CUES = "path string, n long, start_ms long, end_ms long, text string"
REPLIES = "path string, content string, model string, finish string, usage string, errors array<string>"
BLANK = " \t\n\r\x0b\f"
TIME = re.compile(r"(\d+):(\d\d):(\d\d)[,.](\d{3})")


def _open(path: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(path)


def _ms(text: str) -> int | None:
    m = TIME.search(text)
    return m and ((int(m[1]) * 60 + int(m[2])) * 60 + int(m[3])) * 1000 + int(m[4])


def srt_time(ms: int) -> str:
    s, ms = divmod(max(0, ms), 1000)
    return f"{s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d},{ms:03d}"


def cues(lines: Iterator[str]) -> Iterator[tuple[int | None, int | None, str]]:
    """(start_ms, end_ms, text) of the cues of a file's lines: blocks between blank lines, from their time line on."""

    def cue(block: list[str]) -> tuple | None:
        head = next((k for k, line in enumerate(block) if "-->" in line), None)
        if head is None or head + 1 == len(block):
            return None
        start, end = block[head].split("-->", 1)
        return _ms(start), _ms(end), " ".join(block[head + 1 :])

    block: list[str] = []
    for line in lines:
        line = line.strip(BLANK)
        if line:
            block.append(line)
        elif block:
            found, block = cue(block), []
            if found:
                yield found
    if block and (found := cue(block)):
        yield found


#: Partitions that a folder's files are dealt out to at most, and files that a committing driver moves at the same time.
MOST_PARTS, MOVERS = 512, 16


@dataclass
class Share(InputPartition):
    paths: list[str]


class Files(DataSourceReader):
    """One partition for each file of a folder, in the order of their names, or for as many that follow each other as MOST_PARTS asks for; or the one file that a path names."""

    def __init__(self, path: str, ending: str, names: list[str]):
        self.path, self.ending, self.names = path, ending, names

    def partitions(self) -> list[InputPartition]:
        fs, path = _open(self.path)
        if fs.get_file_info(path).type == arrow_fs.FileType.File:
            return [Share([path])]
        found = fs.get_file_info(arrow_fs.FileSelector(path))
        names = sorted(f.path for f in found if f.type == arrow_fs.FileType.File and f.path.lower().endswith(self.ending))
        each = max(1, -(-len(names) // MOST_PARTS))
        return [Share(names[k : k + each]) for k in range(0, len(names), each)] or [Share([])]

    def lines(self, path: str) -> Iterator[str]:
        with _open(self.path)[0].open_input_stream(path) as raw:
            for line in io.TextIOWrapper(raw, "utf-8-sig", "replace"):
                yield line.removesuffix("\n")

    def row(self, made: dict) -> tuple:
        return tuple(made[n] for n in self.names)


class SrtReader(Files):
    def read(self, partition: Share) -> Iterator[tuple]:
        for path in partition.paths:
            for n, (start, end, text) in enumerate(cues(self.lines(path)), 1):
                yield self.row({"path": path, "n": n, "start_ms": start, "end_ms": end, "text": text})


class SseReader(Files):
    def read(self, partition: Share) -> Iterator[tuple]:
        from captionlake.streaming.ordered import NO_STREAM, Replies

        for path in partition.paths:
            whole = Replies(0)
            fold = whole.begin()
            for line in self.lines(path):
                fold = whole.add(fold, line)
            errors = list(fold[4]) + ([NO_STREAM + fold[6]] if fold[7] is False else [])
            yield self.row({"path": path, "content": fold[0], "model": fold[1], "finish": fold[2], "usage": fold[3], "errors": errors})


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: its folder, and the names of the files in it."""

    folder: str
    names: list[str]


class SrtWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite
        self.aside = f"_aside-{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> Written:
        fs, path = _open(self.path)
        folder = posixpath.join(path, self.aside, uuid.uuid4().hex)
        fs.create_dir(folder, recursive=True)
        names: list[str] = []
        done: set[str] = set()
        at = out = None
        try:
            for file_id, n, start, end, text in rows:
                if out is None or file_id != at:
                    if out is not None:
                        out.close()
                    at, name = file_id, f"{file_id}.srt"
                    if name in done:
                        raise ValueError(f"the cues of file {file_id} don't stand together")
                    done.add(name)
                    names.append(name)
                    out = fs.open_output_stream(posixpath.join(folder, name))
                    block = ""
                else:
                    block = "\n"
                out.write(f"{block}{n}\n{srt_time(start)} --> {srt_time(end)}\n{text or ''}\n".encode())
        finally:
            if out is not None:
                out.close()
        return Written(folder, names)

    def commit(self, messages: list[Written | None]) -> None:
        fs, path = _open(self.path)
        told = [m for m in messages if m is not None]
        names = [n for m in told for n in m.names]
        if len(names) != len(set(names)):
            raise ValueError("a file's cues were in more than one task")
        if self.overwrite and fs.get_file_info(path).type == arrow_fs.FileType.Directory:
            old = [f.path for f in fs.get_file_info(arrow_fs.FileSelector(path)) if f.type == arrow_fs.FileType.File and f.path.endswith(".srt")]
            with ThreadPoolExecutor(MOVERS) as pool:
                list(pool.map(fs.delete_file, old))
        moves = ((posixpath.join(m.folder, name), posixpath.join(path, name)) for m in told for name in m.names)
        with ThreadPoolExecutor(MOVERS) as pool:
            list(pool.map(lambda pair: fs.move(*pair), moves))
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        fs, path = _open(self.path)
        aside = posixpath.join(path, self.aside)
        if fs.get_file_info(aside).type == arrow_fs.FileType.Directory:
            fs.delete_dir(aside)


def _names(schema) -> list[str]:
    return [f.name for f in schema.fields]


class SrtSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "srt"

    def schema(self) -> str:
        return CUES

    def reader(self, schema) -> SrtReader:
        return SrtReader(self.options["path"], ".srt", _names(schema))

    def writer(self, schema, overwrite: bool) -> SrtWriter:
        if _names(schema) != ["file_id", "n", "start_ms", "end_ms", "text"]:
            raise ValueError("cues are written from file_id, n, start_ms, end_ms, text")
        return SrtWriter(self.options["path"], overwrite)


class SseSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sse"

    def schema(self) -> str:
        return REPLIES

    def reader(self, schema) -> SseReader:
        return SseReader(self.options["path"], self.options.get("ending", ".txt"), _names(schema))


def register(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(SrtSource)
    spark.dataSource.register(SseSource)
    return spark
