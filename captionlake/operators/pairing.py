"""Pairing of transcripts with audio files by title."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from captionlake.functions.text import normalize_key


def keep_first(rows: DataFrame, title: str = "title", order: str = "ord") -> DataFrame:
    """rows with key, the first of each key; a hot key is reduced before the exchange by the aggregate."""
    d = rows.withColumn("key", normalize_key(title))
    return d.groupBy("key").agg(F.min(F.struct(order, title)).alias("x")).select("key", f"x.{order}", f"x.{title}")


def build_pairs(transcripts: DataFrame, audio: DataFrame) -> DataFrame:
    """(key, ord, audio_ord): full outer join on the title's key; many transcripts may share an audio file."""
    left = transcripts.select(normalize_key("title").alias("key"), "ord")
    right = keep_first(audio).select("key", F.col("ord").alias("audio_ord"))
    return left.join(right, "key", "full_outer")


def unpaired_report(pairs: DataFrame) -> DataFrame:
    """(side, n, line): markdown lines of what has no partner, numbered by key within a side; a side without any has one line that says so.

    Lines are rows, which a writer sorts by range; no side is gathered in one task. Numbers come from counts of keys by
    their first sign and, within these, from a window.
    """
    rows = pairs.select(F.when(F.col("audio_ord").isNull(), "transcript").when(F.col("ord").isNull(), "audio").alias("side"), "key", F.coalesce("ord", "audio_ord").alias("o")).where("side IS NOT NULL")
    rows = rows.withColumn("first", F.substring("key", 1, 2))
    counts = rows.groupBy("side", "first").agg(F.count(F.lit(1)).alias("c"))
    before = F.sum("c").over(Window.partitionBy("side").orderBy("first").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("c")
    at = F.row_number().over(Window.partitionBy("side", "first").orderBy("key", "o"))
    listed = rows.join(counts.select("side", "first", before.alias("before")), ["side", "first"]).select("side", (F.col("before") + at).cast("long").alias("n"), F.concat(F.lit("- "), F.col("key")).alias("line"))
    sides = pairs.sparkSession.sql("SELECT * FROM VALUES ('transcript'), ('audio') AS t(side)")
    none = sides.join(counts, "side", "left_anti").select("side", F.lit(1).cast("long").alias("n"), F.lit("- (none)").alias("line"))
    return listed.union(none)


def select_pairs(pairs: DataFrame, only: str | None = None, limit: int | None = None, sample: int | None = None, seed: int = 0) -> DataFrame:
    """Pairs whose key holds `only`; then a sample of that size by seeded hash (which wins over limit), or the first `limit` by key."""
    d = pairs.where(F.contains("key", F.lit(only))) if only else pairs
    if sample is not None:
        return d.orderBy(F.xxhash64(F.lit(seed), F.col("key")), "key", "ord").limit(sample).orderBy("key", "ord")
    return d.orderBy("key", "ord").limit(limit) if limit is not None else d


def top_shortest(files: DataFrame, k: int) -> DataFrame:
    """The k shortest files of known duration, ties by name."""
    return files.where("dur_ms IS NOT NULL").orderBy("dur_ms", "name").limit(k)


def pending(files: DataFrame, done: DataFrame, key: str, force: bool = False) -> DataFrame:
    """files without output yet; all with force."""
    return files if force else files.join(done.select(key), key, "left_anti")
