"""Words of transcripts: filling times, segments, sentences, alignment statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from captionlake.config import CUE, CueConfig


def _file() -> Window:
    return Window.partitionBy("file_id").orderBy("pos")


UP = (Window.unboundedPreceding, Window.currentRow)


def fill_times(words: DataFrame) -> DataFrame:
    """words in which untimed ones have start_ms and end_ms.

    In a run of untimed words after a word that ends at p and before one that starts at x: the first takes [p,
    max(p + 50, x)], every later one starts where its predecessor ends at first, less 50, and ends 50 later; without x each lasts 300.
    One sort by file and position serves all windows, the next timed word among them; frames grow with the row.
    """
    w = _file()
    timed = F.col("start_ms").isNotNull() & F.col("end_ms").isNotNull()
    d = words.withColumn("rn", F.row_number().over(w)).withColumn("timed", timed)
    before = lambda c: F.last(F.when(F.col("timed"), F.col(c)), True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = F.expr("lead(if(timed, start_ms, NULL)) IGNORE NULLS OVER (PARTITION BY file_id ORDER BY pos)")
    d = d.withColumns({"p": F.coalesce(before("end_ms"), F.lit(0)), "x": x, "r": F.col("rn") - F.coalesce(before("rn"), F.lit(0))})  # r: place in the run
    d = d.withColumn("e1", F.greatest(F.col("p") + 50, F.col("x")))
    start = F.when(F.col("x").isNull(), F.col("p") + 300 * (F.col("r") - 1)).when(F.col("r") == 1, F.col("p")).otherwise(F.col("e1") + 50 * (F.col("r") - 2))
    end = F.when(F.col("x").isNull(), F.col("p") + 300 * F.col("r")).otherwise(F.col("e1") + 50 * (F.col("r") - 1))
    filled = d.withColumn("start_ms", F.when(F.col("timed"), F.col("start_ms")).otherwise(start).cast("long"))
    filled = filled.withColumn("end_ms", F.when(F.col("timed"), F.col("end_ms")).otherwise(end).cast("long"))
    return filled.drop("timed", "rn", "p", "x", "r", "e1")


def ends_with(word: Column, signs: str) -> Column:
    return F.substring(word, -1, 1).isin(*signs)


def segments(filled: DataFrame, cfg: CueConfig = CUE) -> DataFrame:
    """filled with seg (from 0): a new one after a sentence end or a long pause."""
    w = _file()
    new = ends_with(F.lag("w").over(w), cfg.sentence_end) | ((F.col("start_ms") - F.lag("end_ms").over(w)) >= cfg.long_pause_ms)
    d = filled.withColumn("new", F.coalesce(new.cast("int"), F.lit(0)))
    return d.withColumn("seg", F.sum("new").over(w.rowsBetween(*UP)).cast("long")).drop("new")


def ordered_text(order: str, word: str = "w", sep: str = " ") -> Column:
    """Words of a group in order; the group is one cue or sentence, never a whole file."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, word))), lambda x: x[word]), sep)


def simple_cues(segmented: DataFrame) -> DataFrame:
    """(file_id, seg, text, start_ms, end_ms): one cue for each segment."""
    return segmented.groupBy("file_id", "seg").agg(ordered_text("pos").alias("text"), F.min_by("start_ms", "pos").alias("start_ms"), F.max_by("end_ms", "pos").alias("end_ms"))


def pin_edges(words: DataFrame) -> DataFrame:
    """Untimed words before the first timed one take its start, those behind the last take its end; inner ones stay untimed."""
    w = _file()
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    timed = F.col("start_ms").isNotNull()
    d = words.withColumns({
        "first_pos": F.min(F.when(timed, F.col("pos"))).over(whole), "last_pos": F.max(F.when(timed, F.col("pos"))).over(whole),
        "first_start": F.first("start_ms", True).over(whole), "last_end": F.last("end_ms", True).over(whole),
    })
    pin = F.when(F.col("pos") < F.col("first_pos"), F.col("first_start")).when(F.col("pos") > F.col("last_pos"), F.col("last_end"))
    d = d.withColumn("start_ms", F.coalesce("start_ms", pin)).withColumn("end_ms", F.coalesce("end_ms", pin))
    return d.drop("first_pos", "last_pos", "first_start", "last_end")


def align_stats(words: DataFrame) -> DataFrame:
    """(file_id, words, aligned, score_sum, scored)"""
    timed = F.col("start_ms").isNotNull()
    scored = timed & F.col("score_m").isNotNull()
    return words.groupBy("file_id").agg(
        F.count(F.lit(1)).alias("words"), F.count_if(timed).alias("aligned"), F.sum(F.when(scored, F.col("score_m"))).alias("score_sum"), F.count_if(scored).alias("scored")
    )


def sentences(words: DataFrame, signs: str = ".!?;", most: int = 40) -> DataFrame:
    """words with sent and piece: sentences end after a sign, pieces hold at most `most` words."""
    w = _file()
    new = F.coalesce(ends_with(F.lag("w").over(w), signs).cast("int"), F.lit(0))
    d = words.withColumn("new", new).withColumn("sent", F.sum("new").over(w.rowsBetween(*UP)).cast("long")).drop("new")
    at = F.row_number().over(Window.partitionBy("file_id", "sent").orderBy("pos")) - 1
    return d.withColumn("piece", F.floor(at / most).cast("long"))


def scored_sentences(words: DataFrame, threshold_m: int = 500) -> DataFrame:
    """(file_id, sent, piece, text, start_ms, end_ms, timed, score_sum, kept): untimed words have no say, timed ones without score count zero.

    The mean in thousandths, rounded to whole, must reach threshold_m; comparing doubled sums decides that in integers, halves to even.
    """
    timed = F.col("start_ms").isNotNull()
    g = sentences(words).groupBy("file_id", "sent", "piece").agg(
        ordered_text("pos").alias("text"), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.count_if(timed).alias("timed"),
        F.coalesce(F.sum(F.when(timed, F.coalesce("score_m", F.lit(0)))), F.lit(0)).alias("score_sum"),
    )
    reach = 2 * F.col("score_sum") >= (2 * threshold_m - 1) * F.col("timed")
    if threshold_m % 2:  # a half below an odd number rounds down to even
        reach = 2 * F.col("score_sum") > (2 * threshold_m - 1) * F.col("timed")
    return g.withColumn("kept", (F.col("timed") > 0) & reach)


def assemble(words: DataFrame, spans: DataFrame) -> DataFrame:
    """Times and mean score of each word from its letters' spans (pos, start, end, score); a word without spans has none.

    words: (file_id, pos, w). Returns start, end (first and last frame), score_sum, n_spans. Words and their spans meet in a
    window instead of a join, so that rows which are dealt out by file stay where they are.
    """
    found = ["start", "end", "score_sum", "n_spans"]
    g = spans.groupBy("file_id", "pos").agg(
        F.min_by("start", "k").alias("start"), F.max_by("end", "k").alias("end"), F.sum("score").alias("score_sum"), F.count(F.lit(1)).alias("n_spans")
    )
    both = words.withColumn("_word", F.lit(True)).unionByName(g.withColumn("_word", F.lit(False)), allowMissingColumns=True)
    whole, keyed = Window.partitionBy("file_id", "pos"), F.col("file_id").isNotNull() & F.col("pos").isNotNull()
    d = both.withColumns({c: F.when(keyed, F.max(c).over(whole)) for c in found}).where("_word")
    return d.select(*words.columns, *found[:-1], F.coalesce("n_spans", F.lit(0)).alias("n_spans"))


def shift(words: DataFrame, chunks: DataFrame) -> DataFrame:
    """Timed words moved by the start of their chunk (chunk, off_ms)."""
    d = words.join(chunks, ["file_id", "chunk"])
    return d.withColumn("start_ms", F.col("start_ms") + F.col("off_ms")).withColumn("end_ms", F.col("end_ms") + F.col("off_ms")).drop("off_ms")


def star_sequence(words: DataFrame, signs: str = ".!?;:,") -> DataFrame:
    """(file_id, slot, token): a star before the first word, after words that end in a sign, and at the end."""
    w = _file()
    last = F.lead("pos").over(w).isNull()
    d = words.withColumn("last", last).withColumn("stop", ends_with(F.col("w"), signs) | F.col("last"))
    own = d.select("file_id", (2 * F.col("pos") + 1).alias("slot"), F.col("w").alias("token"))
    after = d.where("stop").select("file_id", (2 * F.col("pos") + 2).alias("slot"), F.lit("*").alias("token"))
    first = d.groupBy("file_id").agg(F.min("pos").alias("p")).select("file_id", (2 * F.col("p")).alias("slot"), F.lit("*").alias("token"))
    return own.union(after).union(first)
