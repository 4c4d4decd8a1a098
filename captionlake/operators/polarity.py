"""Polarity of stereo recordings: energies by second, labels, sections to flip, cancelled stretches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from captionlake.config import POLARITY, PolarityConfig

from .intervals import runs


def db(energy) -> Column:
    return 10 * F.log10(energy + 1e-12)


def second_energy(samples: DataFrame) -> DataFrame:
    """(file_id, second, l, r, mix, diff): mean energies from samples (file_id, second, l, r)."""
    square = lambda x: F.avg(x * x)
    l, r = F.col("l"), F.col("r")  # noqa: E741
    return samples.groupBy("file_id", "second").agg(square(l).alias("l"), square(r).alias("r"), square((l + r) / 2).alias("mix"), square((l - r) / 2).alias("diff"))


def block_energy(samples: DataFrame) -> DataFrame:
    """(file_id, block, energy): samples carry their block; the mean is over both channels."""
    return samples.groupBy("file_id", "block").agg(F.avg((F.col("l") * F.col("l") + F.col("r") * F.col("r")) / 2).alias("energy"))


def labels(energy: DataFrame, cfg: PolarityConfig = POLARITY) -> DataFrame:
    """energy with label: 1 inverted, 0 normal, -1 without signal."""
    loud = F.greatest(db(F.col("l")), db(F.col("r"))) >= cfg.signal_db
    inverted = db(F.col("diff")) >= db(F.col("mix")) + cfg.margin_db
    return energy.withColumn("label", F.when(loud, inverted.cast("int")).otherwise(-1))


def fill_silence(labelled: DataFrame) -> DataFrame:
    """Seconds without signal take the nearest label; two that differ at one distance, or none, give 0."""
    w = Window.partitionBy("file_id").orderBy("second")
    behind = (Window.unboundedPreceding, -1)
    known = F.when(F.col("label") >= 0, F.struct("second", "label"))
    d = labelled.withColumn("x", F.last(known, True).over(w.rowsBetween(*behind)))
    d = d.withColumn("y", F.last(known, True).over(Window.partitionBy("file_id").orderBy(F.col("second").desc()).rowsBetween(*behind)))
    dx, dy = F.col("second") - F.col("x.second"), F.col("y.second") - F.col("second")
    near = F.when(dy.isNull() | (dx < dy), F.col("x.label")).when(dx.isNull() | (dy < dx), F.col("y.label")).when(F.col("x.label") == F.col("y.label"), F.col("x.label"))
    return d.withColumn("label", F.when(F.col("label") >= 0, F.col("label")).otherwise(F.coalesce(near, F.lit(0)))).drop("x", "y")


def smooth(filled: DataFrame, cfg: PolarityConfig = POLARITY) -> DataFrame:
    """(file_id, a, b): inverted runs, joined over short normal ones first, then without short ones."""
    r = runs(filled, ["file_id"], "second", F.col("label") == 1)
    w = Window.partitionBy("file_id").orderBy("a")
    new = F.coalesce((F.col("a") - F.lag("b").over(w) >= cfg.merge_sec).cast("int"), F.lit(0))
    d = r.withColumn("new", new).withColumn("grp", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    joined = d.groupBy("file_id", "grp").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return joined.where(F.col("b") - F.col("a") >= cfg.section_sec).select("file_id", "a", "b")


def seams(edges: DataFrame, blocks: DataFrame, cfg: PolarityConfig = POLARITY) -> DataFrame:
    """edges (file_id, second) with seam_ms: the centre of the quietest block within a second of the edge, ties to the earliest; the edge itself without blocks.

    Every edge names the blocks it looks at, so blocks are found by key.
    """
    at = F.explode(F.sequence(F.greatest((F.col("second") - 1) * cfg.per_sec, F.lit(0)), (F.col("second") + 1) * cfg.per_sec - 1))
    near = edges.select("file_id", "second", at.alias("block")).join(blocks, ["file_id", "block"])
    best = near.groupBy("file_id", "second").agg(F.min(F.struct("energy", "block"))["block"].alias("block"))
    found = best.select("file_id", "second", F.expr(f"cast((2 * block + 1) * {1000 // cfg.per_sec} div 2 as long)").alias("seam_ms"))
    return edges.join(found, ["file_id", "second"], "left").withColumn("seam_ms", F.coalesce("seam_ms", F.col("second") * 1000))


def sections(energy: DataFrame, blocks: DataFrame | None = None, cfg: PolarityConfig = POLARITY) -> DataFrame:
    """(file_id, start_ms, end_ms): what to flip; 0 from the beginning, null to the end. Inner edges move to quiet blocks if there are any."""
    n = energy.groupBy("file_id").agg((F.max("second") + 1).alias("n"))
    s = smooth(fill_silence(labels(energy, cfg)), cfg).join(n, "file_id")
    if blocks is None:
        start, end = F.col("a") * 1000, F.col("b") * 1000
    else:
        edges = s.select("file_id", F.explode(F.array("a", "b")).alias("second")).distinct()
        moved = seams(edges, blocks, cfg)
        s = s.join(moved.select("file_id", F.col("second").alias("a"), F.col("seam_ms").alias("sa")), ["file_id", "a"])
        s = s.join(moved.select("file_id", F.col("second").alias("b"), F.col("seam_ms").alias("sb")), ["file_id", "b"])
        start, end = F.col("sa"), F.col("sb")
    return s.select("file_id", F.when(F.col("a") == 0, 0).otherwise(start).cast("long").alias("start_ms"), F.when(F.col("b") < F.col("n"), end).cast("long").alias("end_ms"))


def cancelled(energy: DataFrame, cfg: PolarityConfig = POLARITY) -> DataFrame:
    """(file_id, a, b): seconds where the mix stays far below the louder channel; seconds without signal neither count nor break a run."""
    louder = F.greatest(db(F.col("l")), db(F.col("r")))
    signal = energy.withColumn("louder", louder).where(F.col("louder") >= cfg.signal_db)
    k = F.row_number().over(Window.partitionBy("file_id").orderBy("second"))
    d = signal.withColumn("k", k.cast("long"))
    d = d.withColumn("bad", db(F.col("mix")) <= F.col("louder") - cfg.drop_db)
    r = runs(d, ["file_id"], "k", F.col("bad")).where(F.col("b") - F.col("a") >= cfg.check_sec)
    at = d.select("file_id", "k", "second")
    first = at.select("file_id", F.col("k").alias("a"), F.col("second").alias("s"))
    last = at.select("file_id", (F.col("k") + 1).alias("b"), F.col("second").alias("t"))
    return r.join(first, ["file_id", "a"]).join(last, ["file_id", "b"]).select("file_id", F.col("s").alias("a"), (F.col("t") + 1).alias("b"))


def flip_filter(section_rows: DataFrame, ramp_ms: int = 20) -> DataFrame:
    """(file_id, filter): the audio filter that turns the right channel inside the sections."""
    half = ramp_ms / 2000
    ramp = ramp_ms / 1000
    rise = F.when(F.col("start_ms") <= 0, "1").otherwise(F.format_string(f"clip((n/s-(%.3f))/{ramp:g},0,1)", F.col("start_ms") / 1000 - half))
    fall = F.when(F.col("end_ms").isNull(), "1").otherwise(F.format_string(f"clip(((%.3f)-n/s)/{ramp:g},0,1)", F.col("end_ms") / 1000 + half))
    d = section_rows.withColumn("term", F.concat(rise, F.lit("*"), fall))
    terms = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start_ms", "term"))), lambda x: x["term"]), "+")
    return d.groupBy("file_id").agg(terms.alias("t")).select(
        "file_id", F.concat(F.lit("aeval=exprs='val(0)|val(1)*(1-2*("), F.col("t"), F.lit("))',pan=stereo|c0=c0|c1=c1")).alias("filter")
    )
