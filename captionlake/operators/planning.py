"""Chunk plans: cut points in silence, emission chunks and windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from captionlake.config import PLAN, PlanConfig


def _cut_runs(silences: Column, until: Column, cfg: PlanConfig) -> Column:
    """Runs of cuts (at, gap, n) of a file: n cuts from `at` on, a target apart. Times are half milliseconds.

    silences are (gap, at) in order of their middles. They are passed once, by array functions: the state is the last cut,
    the widest silence near the next target, and the runs so far. Since a target is more than three searches, places near
    one target can't be near the next one whatever is chosen, so nothing has to be looked at twice. A silence beyond the
    search settles the target before it: the widest one found, else as many plain targets as lie before that silence.
    """
    step, reach = 2 * cfg.target_ms, 2 * cfg.search_ms
    run = "array<struct<at: bigint, gap: bigint, n: bigint>>"
    start = F.expr(f"struct(0L AS last, cast(null AS struct<gap: bigint, at: bigint>) AS widest, cast(array() AS {run}) AS runs)")

    def state(last: Column, widest: Column, runs: Column) -> Column:
        return F.struct(last.alias("last"), widest.alias("widest"), runs.alias("runs"))

    def one(at: Column, gap: Column, n: Column) -> Column:
        return F.array(F.struct(at.cast("long").alias("at"), gap.cast("long").alias("gap"), n.cast("long").alias("n")))

    nothing = F.lit(None).cast("struct<gap: bigint, at: bigint>")

    def settle(s: Column, m: Column) -> Column:
        past = s["widest"].isNotNull() & (m["at"] > s["last"] + step + reach)
        return F.when(past, state(s["widest"]["at"], nothing, F.concat(s["runs"], one(s["widest"]["at"], s["widest"]["gap"], F.lit(1))))).otherwise(s)

    def skip(s: Column, m: Column) -> Column:
        before = F.ceil((m["at"] - s["last"] - step - reach) / step)
        n = F.least(before, F.ceil((until - s["last"]) / step) - 1).cast("long")
        return F.when(s["widest"].isNull() & (n > 0), state(s["last"] + n * step, nothing, F.concat(s["runs"], one(s["last"] + step, F.lit(0), n)))).otherwise(s)

    def look(s: Column, m: Column) -> Column:
        target = s["last"] + step
        near = (F.abs(m["at"] - target) <= reach) & (target < until)
        return F.when(near, state(s["last"], F.greatest(s["widest"], m), s["runs"])).otherwise(s)

    phases = F.array(F.lit(0), F.lit(1), F.lit(2))
    done = F.array(F.struct(F.lit(0).cast("long").alias("gap"), (until + 2 * step + reach).cast("long").alias("at")))
    return F.aggregate(
        F.concat(silences, done), start,
        lambda s, m: F.aggregate(phases, s, lambda s, p: F.when(p == 0, settle(s, m)).when(p == 1, skip(s, m)).otherwise(look(s, m))),
        lambda s: s["runs"],
    )


def chunk_plan(speech: DataFrame, audio: DataFrame, cfg: PlanConfig = PLAN) -> DataFrame:
    """(file_id, idx, start_ms, end_ms, cut_gap_ms) for audio (file_id, dur_ms) and its speech segments.

    Chunks end in the middle of the widest silence near each target, the later of equals, else at the target; cuts are rounded to
    10 ms, halves to even, while the next target counts from the cut before rounding. A target in the last rest is none.
    Files are the partition key: one exchange serves the silences and their lists, which are as long as a file has silences.
    """
    if cfg.target_ms <= 3 * cfg.search_ms or cfg.target_ms - cfg.search_ms <= cfg.least_ms + 10:
        raise ValueError("a target must be more than three searches, and more than a search and the least chunk")
    after = F.lead("start_ms").over(Window.partitionBy("file_id").orderBy("seg"))
    gaps = speech.select("file_id", F.col("end_ms").alias("s"), after.alias("e")).where("e IS NOT NULL")
    lists = gaps.groupBy("file_id").agg(F.sort_array(F.collect_list(F.struct((F.col("s") + F.col("e")).alias("at"), (F.col("e") - F.col("s")).alias("gap")))).alias("x"))
    by_place = F.transform("x", lambda m: F.struct(m["gap"], m["at"]))
    none = F.expr("cast(array() AS array<struct<gap: bigint, at: bigint>>)")
    d = audio.join(lists, "file_id", "left").select("file_id", "dur_ms", F.coalesce(by_place, none).alias("x"))
    d = d.withColumn("runs", _cut_runs(F.col("x"), 2 * (F.col("dur_ms") - cfg.rest_ms), cfg))
    each = F.flatten(F.transform("runs", lambda r: F.transform(F.sequence(F.lit(0).cast("long"), r["n"] - 1), lambda k: F.struct((F.rint((r["at"] + k * 2 * cfg.target_ms) / 20) * 10).cast("long").alias("cut"), r["gap"].alias("gap")))))
    d = d.select("file_id", F.concat(each, F.array(F.struct(F.col("dur_ms").cast("long").alias("cut"), F.lit(0).cast("long").alias("gap")))).alias("c"))
    d = d.select("file_id", "c", F.posexplode("c").alias("k", "x"))
    start = F.when(F.col("k") == 0, F.lit(0).cast("long")).otherwise(F.get("c", F.col("k") - 1)["cut"])
    return d.select("file_id", (F.col("k") + 1).cast("long").alias("idx"), start.alias("start_ms"), F.col("x.cut").alias("end_ms"), F.col("x.gap").alias("cut_gap_ms"))


def chunk_bounds(files: DataFrame, total: str, chunk: int, least_tail: int) -> DataFrame:
    """files with k, a, b: whole chunks of `total`; a tail shorter than least_tail belongs to the chunk before it."""
    n = F.col(total)
    whole = F.floor(n / chunk).cast("long")
    tail = n - whole * chunk
    count = F.when(n <= 0, 0).when((tail >= least_tail) & (tail > 0), whole + 1).otherwise(F.greatest(whole, F.lit(1)))
    d = files.withColumn("c", count).where("c > 0").withColumn("k", F.explode(F.expr("sequence(1L, c)")))
    return d.withColumn("a", (F.col("k") - 1) * chunk).withColumn("b", F.when(F.col("k") == F.col("c"), n).otherwise(F.col("k") * chunk)).drop("c")


def window_bounds(files: DataFrame, blank: DataFrame) -> DataFrame:
    """(file_id, k, frame, word): bounds of the windows of files (file_id, total, windows, n_words).

    Each inner grid point moves to the nearest centre of a blank run (file_id, a, b), ties to the earliest, and stays
    where there is none. The runs on either side of a point are found by sorts of points and centres together, one for either direction.
    """
    points = files.where("windows > 1").select("file_id", F.explode(F.expr("sequence(1L, windows - 1L)")).alias("k"), "total", "windows")
    points = points.select("file_id", F.rint(F.col("total") * F.col("k") / F.col("windows")).cast("long").alias("t"), F.lit(True).alias("point"))
    centres = blank.select("file_id", F.expr("(a + b) div 2").alias("t"), F.lit(False).alias("point"))
    order = Window.partitionBy("file_id").orderBy("t", "point")
    centre = F.when(~F.col("point"), F.col("t"))
    d = points.union(centres).withColumn("x", F.last(centre, True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    back = Window.partitionBy("file_id").orderBy(F.col("t").desc(), F.col("point").desc())
    d = d.withColumn("y", F.last(centre, True).over(back.rowsBetween(Window.unboundedPreceding, 0))).where("point")
    near = F.when(F.col("y").isNull() | (F.col("t") - F.col("x") <= F.col("y") - F.col("t")), F.col("x")).otherwise(F.col("y"))
    inner = d.select("file_id", F.coalesce(near, F.col("y"), F.col("t")).alias("frame"))
    inner = inner.join(files.select("file_id", "total"), "file_id").where("frame > 0 AND frame < total").select("file_id", "frame")
    edges = files.select("file_id", F.explode(F.array(F.lit(0).cast("long"), F.col("total"))).alias("frame"))
    bounds = inner.union(edges).distinct().join(files.select("file_id", "total", "n_words"), "file_id")
    k = F.row_number().over(Window.partitionBy("file_id").orderBy("frame")) - 1
    return bounds.select("file_id", k.cast("long").alias("k"), "frame", F.rint(F.col("n_words") * F.col("frame") / F.col("total")).cast("long").alias("word"))
