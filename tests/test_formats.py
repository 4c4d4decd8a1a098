"""The data sources of subtitle files and of saved replies, and the writer of subtitle files."""

import json

import pytest

from captionlake.functions import text as T
from captionlake.operators import cues as C
from captionlake.sources import formats, sinks
from captionlake.sources import readers as R

CUES = "file_id long, n long, text string, start_ms long, end_ms long"


def test_srt_source(spark, tmp_path):
    formats.register(spark)
    texts = {
        "a.srt": "﻿1\r\n00:00:00,000 --> 00:00:01,500\r\n One \r\ntwo\r\n\r\n\r\nno time line\r\n\r\n2\r\n0 --> 1\r\n\r\n3\r\n01:00:00.001 --> x\r\nlast",
        "B.SRT": "",
        "c.srt": "\n \n7\n0 --> 1\nx --> y\n\t\n1\n0 --> 1\ré\r\r2\r0 --> 1\rz\n",
    }
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "d.txt").write_text("1\n0 --> 1\nno subtitle file\n")
    read = spark.read.format("srt").load(str(tmp_path))
    got = {}
    for r in sorted(read.collect(), key=lambda r: (r.path, r.n)):
        got.setdefault(r.path.rsplit("/", 1)[1], []).append(r.text)
    whole = spark.createDataFrame(list(texts.items()), "name string, srt string").select("name", T.srt_cues("srt").alias("c")).collect()
    assert got == {r.name: r.c for r in whole if r.c} and got["a.srt"] == ["One two", "last"]
    assert [(r.start_ms, r.end_ms) for r in read.where("path LIKE '%a.srt'").orderBy("n").collect()] == [(0, 1500), (3600001, None)]
    assert read.rdd.getNumPartitions() == 3
    few = spark.read.format("srt").schema("n long, text string").load(str(tmp_path / "a.srt"))
    assert few.columns == ["n", "text"] and sorted(map(tuple, few.collect())) == [(1, "One two"), (2, "last")]
    (tmp_path / "empty").mkdir()
    assert spark.read.format("srt").load(str(tmp_path / "empty")).collect() == []


def test_many_files_share_partitions(spark, tmp_path):
    """More files than partitions are dealt out; each row still has its own file's path and numbers."""
    for k in range(2 * formats.MOST_PARTS + 3):
        (tmp_path / f"{k:05d}.srt").write_text(f"1\n0 --> 1\na{k}\n\n2\n0 --> 1\nb{k}\n")
    read = formats.register(spark).read.format("srt").load(str(tmp_path))
    assert read.rdd.getNumPartitions() <= formats.MOST_PARTS
    got = {(int(r.path[-9:-4]), r.n, r.text) for r in read.coalesce(4).collect()}
    assert got == {(k, n, f"{t}{k}") for k in range(2 * formats.MOST_PARTS + 3) for n, t in ((1, "a"), (2, "b"))}


def test_srt_writer(spark, tmp_path):
    """Files are what srt_text gives; a second run replaces the first; nothing is left aside."""
    rows = [(f, n, f"line {n}\nof {f}" if n % 3 else "é", 1000 * n - 500, 1000 * n + 400) for f in range(7) for n in range(1, 40 + f)]
    cues = spark.createDataFrame(rows, CUES).repartition(5)
    out = tmp_path / "out"
    sinks.write_srt(spark.createDataFrame([(99, 1, "old", 0, 1)], CUES), str(out))
    sinks.write_srt(cues, str(out))
    want = {f"{r.file_id}.srt": r.srt for r in C.srt_text(cues).collect()}
    assert {p.name: p.read_text() for p in out.iterdir()} == want
    back = formats.register(spark).read.format("srt").load(str(out))
    assert back.count() == len(rows) and back.where("text = 'é'").count() == sum(n % 3 == 0 for _, n, *_ in rows)
    sinks.write_srt(cues.limit(0), str(tmp_path / "none"))
    assert list((tmp_path / "none").iterdir()) == [] if (tmp_path / "none").exists() else True


def test_srt_writer_fails_whole(spark, tmp_path):
    """Cues of one file in two tasks, or apart in one: no file appears."""
    formats.register(spark)
    rows = [("a", 1, 0, 1, "x"), ("b", 1, 0, 1, "x"), ("a", 2, 1, 2, "y")]
    apart = spark.createDataFrame(rows, "file_id string, n long, start_ms long, end_ms long, text string")
    for d in (apart.coalesce(1), apart.repartitionByRange(2, "n")):
        with pytest.raises(Exception, match="stand together|more than one task"):
            d.write.format("srt").mode("append").save(str(tmp_path / "bad"))
    assert not list((tmp_path / "bad").glob("*.srt"))


def test_sse_source(spark, tmp_path):
    formats.register(spark)
    say = lambda t, **more: "data: " + json.dumps({"model": "m", "choices": [{"delta": {"content": t}, **more}]})
    files = {
        "1.txt": [say("Hel"), "", say("lo"), "data: {broken", say("", finish_reason="stop"), 'data: {"usage": {"cost": 2}}', "data: [DONE]"],
        "2.txt": ["<html>" + "y" * 400, "data: no"], "3.txt": [" ", 'data: {"error": {"code": 7}}', say("x")], "4.txt": [""],
    }
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join(lines))
    got = {r.path.rsplit("/", 1)[1]: tuple(r)[1:] for r in spark.read.format("sse").load(str(tmp_path)).collect()}
    lines = spark.createDataFrame([(int(n[0]), k, x) for n, every in files.items() for k, x in enumerate(every)], "file_id long, ord long, line string")
    assert got == {f"{r.file_id}.txt": tuple(r)[1:] for r in R.sse_replies(lines).collect()}
    assert got["1.txt"] == ("Hello", "m", "stop", '{"cost":2}', []) and len(got["2.txt"][4][0]) == 300 + len("not an event stream: ")
    assert spark.read.format("sse").schema("errors array<string>").load(str(tmp_path / "3.txt")).collect()[0].errors == ['{"code":7}']
