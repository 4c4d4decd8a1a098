"""Traces of any fields, and the progress of a running stream."""

import json

from pyspark.sql import functions as F

from captionlake.sources import traces as TR
from captionlake.streaming.progress import Progress


def test_free_form_usage(spark, tmp_path):
    one = {"version": 1, "meta": {"model": "m", "thresholds": {"max_attempts": 3}}, "chunks": [
        {"idx": 1, "start": 0, "end": 9.5, "outcome": "merged", "attempts": [{"n": 1, "usage": None}, {"n": 2, "usage": {"cost": 0.5, "details": {"cached": 3}, "tier": "x"}}], "build": {"total_words": 7}},
        {"idx": 2, "attempts": [{"n": 1, "usage": [1]}]}, {"idx": 3},
    ]}
    (tmp_path / "a.json").write_text(json.dumps(one))
    (tmp_path / "b.json").write_text('{"chunks": [')
    (tmp_path / "c.json").write_text('{"chunks": 5, "meta": {"model": 7}}')
    t = TR.traces(spark, str(tmp_path)).withColumn("file", F.regexp_extract("path", "(.)[.]json$", 1))
    head = {r.file: r for r in TR.header(t).collect()}
    assert (head["a"].model, head["a"].thresholds, head["b"].version, head["c"].model) == ("m", {"max_attempts": 3.0}, None, "7")
    chunks = sorted((r.file, r.idx, r.end, r.total_words) for r in TR.chunks(t).where("idx IS NOT NULL").collect())
    assert chunks == [("a", 1, 9.5, 7), ("a", 2, None, None), ("a", 3, None, None)]
    tries = sorted((r.idx, r.try_n) for r in TR.attempts(t).where("try_n IS NOT NULL").collect())
    assert tries == [(1, 1), (1, 2), (2, 1)]
    used = {(r.idx, r["name"]): (r.amount, r.kind) for r in TR.usage_entries(TR.attempts(t)).collect()}
    assert used == {(1, "cost"): (0.5, "DECIMAL(1,1)"), (1, "details"): (None, "OBJECT<cached: BIGINT>"), (1, "tier"): (None, "STRING")}
    assert "details: OBJECT<cached: BIGINT>" in TR.schema(TR.attempts(t).where("try_n = 2"), "usage") and TR.schema(t.where("file = 'b'")) == "VOID"
    assert TR.schema(TR.attempts(t), "usage") == "VARIANT"  # an object in one trace and an array in another


def test_progress(spark, tmp_path):
    """Counts of a stream read from what passes, and the time left from them."""
    for k in range(4):
        spark.createDataFrame([(10 * k + i, i % 3 != 0) for i in range(5)], "id long, ok boolean").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    progress = Progress(total=30)
    spark.streams.addListener(progress)
    try:
        d = progress.watched(spark.readStream.schema("id long, ok boolean").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), F.col("ok"))
        q = d.writeStream.format("memory").queryName("watched").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        import time

        for _ in range(100):
            if progress.done == 20:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(progress)
    assert (progress.good, progress.bad, spark.table("watched").count()) == (12, 8, 20)
    assert progress.elapsed_ms > 0 and progress.eta_ms == 10 * progress.elapsed_ms // 20
    assert Progress(5).eta_ms is None
