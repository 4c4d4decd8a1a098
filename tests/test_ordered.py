"""Streams whose parts arrive in any order, against the batch reader and numpy."""

import json
import random
import time

import numpy as np

from captionlake.sources import readers as R
from captionlake.streaming import ordered as O


def streamed(spark, folder, name, schema, batches, build, mode, until):
    """Rows of a stream fed one file a batch; it runs on until until(rows) holds, so that timers fire."""
    O.use_rocksdb(spark)
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder / name))
        time.sleep(0.02)
    d = build(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder / name)))
    q = d.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(folder / f"{name}-state")).trigger(processingTime="200 milliseconds").start()
    try:
        for _ in range(300):
            rows = spark.table(name).collect()
            if until(rows) or q.exception():
                break
            time.sleep(0.3)
        assert q.exception() is None
    finally:
        q.stop()
    return rows


def replies():
    """file_id -> lines"""
    say = lambda t, **more: "data: " + json.dumps({"model": "m", "choices": [{"delta": {"content": t}, **more}]})
    return {
        1: [say("Hel"), "", say("lo "), ": ping", "data: {broken", say("you", finish_reason="stop"), 'data: {"usage": {"cost": 1.5}}', "data: [DONE]"],
        2: ['data: {"error": {"code": 7}}', say("x"), 'data: {"error": "late"}'],
        3: ["<html>", " data: no", *(f"<p>{'y' * 90}</p>" for _ in range(9))],
        4: ["", "  ", "data:"],
    }


def test_replies_in_any_order(spark, tmp_path):
    rnd = random.Random(5)
    lines = [(f, k, line) for f, every in replies().items() for k, line in enumerate(every)]
    again = lines[3]
    rnd.shuffle(lines)
    batches = [lines[:9], lines[9:13], [again, *lines[13:]]]
    done = lambda rows: sum(r.done for r in rows) == 4
    rows = streamed(spark, tmp_path, "any_order", "file_id long, ord long, line string", batches, lambda s: O.sse_fold(s, quiet_ms=20_000), "update", done)
    got = {r.file_id: (r.content, r.model, r.finish, r.usage, r.errors) for r in rows if r.done}
    assert len(got) == 4 and got[1][:4] == ("Hello you", "m", "stop", '{"cost":1.5}')
    assert got[2][4] == ['{"code":7}', "late"] and len(got[3][4][0]) == len("not an event stream: ") + 300
    batch = R.sse_replies(spark.createDataFrame(lines, "file_id long, ord long, line string")).collect()
    assert got == {r.file_id: (r.content, r.model, r.finish, r.usage, r.errors) for r in batch}


def test_sound_in_any_order(spark, tmp_path):
    """Bytes cut within samples, batches shuffled, the rest of a second at the end, and (file 2) a part that never comes."""
    rate = 1000
    pcm = np.random.default_rng(1).integers(-3000, 3000, (2530, 2)).astype("<i2").tobytes() + b"\x01"
    cuts = {1: [0, 4, 1001, 4002, 4003, 9999, len(pcm)], 2: [0, 4, 1000, 4000, 8000, 9996, len(pcm)]}
    parts = [(f, k, pcm[a:b]) for f, c in cuts.items() for k, (a, b) in enumerate(zip(c, c[1:])) if (f, k) != (2, 2)]
    random.Random(3).shuffle(parts)
    x, n = {}, {}
    for f in cuts:
        heard = b"".join(p for g, _, p in sorted(parts) if g == f)
        x[f] = np.frombuffer(heard[: len(heard) // 4 * 4], "<i2").reshape(-1, 2) / 32768.0
        n[f] = -(-len(x[f]) // rate)
    build = lambda s: O.pcm_energy(s, rate=rate, quiet_ms=20_000)
    rows = streamed(spark, tmp_path, "sound", "file_id long, ord long, bytes binary", [parts[:4], parts[4:8], parts[8:]], build, "append", lambda rows: len(rows) >= sum(n.values()))
    seconds = {(r.file_id, r.second): r for r in rows}
    assert len(rows) == len(seconds) == sum(n.values()) and n == {1: 3, 2: 2}
    for (f, k), r in seconds.items():
        part = x[f][rate * k : rate * (k + 1)]
        assert abs(r.l - np.mean(part[:, 0] ** 2)) < 1e-12 and abs(r.diff - np.mean(((part[:, 0] - part[:, 1]) / 2) ** 2)) < 1e-12
        assert np.allclose(r.blocks, [np.mean(part[i : i + 50] ** 2) for i in range(0, len(part), 50)])
