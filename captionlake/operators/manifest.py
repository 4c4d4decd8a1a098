"""Attempts, dispositions, summaries and settings of transcription runs, as CASE rules and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from captionlake.config import QC
from captionlake.functions.text import tokens

#: Texts that downstream readers match.
LOCKED, SILENT_BLOCKED, FAILED = "403 account locked - not transcribed", "silent blocked", "error after retry: "
SKIPPED, MAI_NOTE, BLOCK_MARK = "skipped (no speech)", "mai fallback: gemini blocked by filters", "blocked by gemini's filters"
#: Markers of log lines in order of precedence.
STAGES = (("[1/4]", "prepare"), ("[2/4]", "plan"), ("[3/4]", "transcribe"), ("[4/4]", "assemble"), ("[stage]", "stage"), ("align", "align"), ("gom cue", "align"), ("build srt", "align"))


def n_words(text) -> Column:
    return F.size(tokens(text)).cast("long")


def filter_block(finish: Column, text: Column) -> Column:
    """A reply that the service's content filter refused."""
    said = F.contains(F.replace(F.lower(text), F.lit("’"), F.lit("'")), F.lit(BLOCK_MARK))
    return (finish == "content_filter") | ((F.coalesce(finish, F.lit("")) == "") & said)


def density_reason(text: Column, speech_ms: Column, per_min: int = QC.words_per_min) -> Column:
    """Why a text is unusable for its speech, or null."""
    words = n_words(text)
    rate = F.rint(words * 60000.0 / F.nullif(speech_ms, F.lit(0))).cast("long").cast("string")
    return F.when(speech_ms < 30_000, None).when(words == 0, "empty despite speech present").when(words * 60_000 < per_min * speech_ms, F.concat(F.lit("low word density ("), rate, F.lit("/min)")))


def guard_reasons(error: Column, finish: Column, text: Column, speech_ms: Column) -> Column:
    """All reasons why a reply must be tried again, in order, joined by '; '."""
    return F.concat_ws(
        "; ", F.when(error != "", "error"), F.when(~finish.eqNullSafe("stop"), F.concat(F.lit("finish="), F.coalesce(F.nullif(finish, F.lit("")), F.lit("empty")))), density_reason(text, speech_ms)
    )


def mai_reasons(error: Column, http: Column, text: Column, expects_speech: Column) -> Column:
    """Why a reply of the word-timing service must be tried again, in order, joined by '; '; empty if it is good."""
    return F.concat_ws(
        "; ", F.when(error != "", F.concat(F.lit("error: "), F.substring(error, 1, 80))), F.when(~http.eqNullSafe("200"), F.concat(F.lit("http="), http)),
        F.when(expects_speech & (F.coalesce(text, F.lit("")) == ""), "empty despite speech present"),
    )


def locked(error: Column) -> Column:
    """An error that mentions 403 anywhere, also inside other numbers."""
    return F.contains(error, F.lit("403"))


def try_outcomes(tries: DataFrame) -> DataFrame:
    """tries with outcome, words and detail."""
    e, f, t = F.col("error"), F.col("finish"), F.col("text")
    d = tries.withColumn("locked", locked(e)).withColumn("blocked", ~F.col("locked") & filter_block(f, t))
    d = d.withColumn("reasons", F.when(F.col("locked"), "403 account locked").when(F.col("blocked"), "blocked by Gemini filters").otherwise(guard_reasons(e, f, t, F.col("speech_ms"))))
    outcome = F.when(F.col("locked"), "403").when(F.col("blocked"), "blocked").when(F.col("reasons") == "", "ok").when(e != "", "error")
    outcome = outcome.when(F.contains("reasons", F.lit("low word density")), "low density").when(n_words(t) == 0, "empty").otherwise("error")
    detail = F.when((e != "") & (F.col("reasons") != ""), F.concat("reasons", F.lit(" | "), e)).when(e != "", e).otherwise(F.col("reasons"))
    words = F.when(F.col("locked") | F.col("blocked"), 0).otherwise(n_words(t))
    return d.withColumn("outcome", outcome).withColumn("words", words.cast("long")).withColumn("detail", F.substring(detail, 1, 200))


def chunk_attempts(tries: DataFrame) -> DataFrame:
    """(file_id, chunk, attempts, locked, blocked, ok, words): tries count up to the first success or 403; blocked if any of them was and none succeeded."""
    o = try_outcomes(tries).select("file_id", "chunk", "n", "outcome", "words")
    stop = F.min(F.when(F.col("outcome").isin("ok", "403"), F.col("n"))).over(Window.partitionBy("file_id", "chunk"))
    d = o.withColumn("stop", stop).where("stop IS NULL OR n <= stop")
    has = lambda x: F.bool_or(F.col("outcome") == x)
    return d.groupBy("file_id", "chunk").agg(
        F.count(F.lit(1)).alias("attempts"), has("403").alias("locked"), (has("blocked") & ~has("ok") & ~has("403")).alias("blocked"), has("ok").alias("ok"), F.max_by("words", "n").alias("words")
    )


def disposition(chunks: DataFrame, threshold: str = "0.5") -> DataFrame:
    """chunks (locked, blocked, silent, reasons, words, engine) with included and note; the first rule that matches decides."""
    c = F.col
    note = F.when(c("locked"), LOCKED).when(c("blocked") & c("silent"), SILENT_BLOCKED).when(c("reasons") != "", F.concat(F.lit(FAILED), c("reasons")))
    note = note.when(c("silent") & (c("words") > 0), f"silent, scored at {threshold}").when(c("silent"), SKIPPED).when(c("engine") == "mai", MAI_NOTE).otherwise("")
    failed = c("locked") | (c("blocked") & c("silent")) | (c("reasons") != "") | (c("silent") & (c("words") == 0))
    return chunks.withColumn("included", ~failed).withColumn("note", note)


def mai_disposition(chunks: DataFrame) -> DataFrame:
    c = F.col
    note = F.when(c("reasons") != "", F.concat(F.lit("error: "), c("reasons"))).when(~c("has_speech"), F.when(c("words") > 20, "hallucination? words without speech").otherwise("skipped")).otherwise("")
    return chunks.withColumn("note", note).withColumn("included", note == "")


def outcome(records: DataFrame) -> DataFrame:
    """records (locked, engine, note, silent, included) with outcome."""
    c = F.col
    o = F.when(c("locked"), "locked").when(c("engine") == "mai", "mai").when(F.startswith(c("note"), F.lit(SILENT_BLOCKED)), "silent-blocked").when(F.startswith(c("note"), F.lit("error after retry")), "failed")
    return records.withColumn("outcome", o.when(c("silent") & c("included"), "silent-scored").when(c("silent"), "silent-empty").otherwise("merged"))


def run_summary(records: DataFrame) -> DataFrame:
    """(file_id, chunks, included, words, locked_chunks, failed_chunks): words of what is included and not silent; lists in order."""
    listed = lambda cond: F.array_join(F.array_sort(F.collect_list(F.when(cond, F.col("chunk")))), ",")
    return records.groupBy("file_id").agg(
        F.count(F.lit(1)).alias("chunks"), F.count_if("included").alias("included"), F.sum(F.when(F.col("included") & ~F.col("silent"), F.col("words")).otherwise(0)).alias("words"),
        listed(F.col("locked")).alias("locked_chunks"), listed(F.startswith("note", F.lit("error after retry"))).alias("failed_chunks"),
    )


def retry_wait_ms(attempt: Column, base_ms: int, http: Column, retry_after: Column, jitter: float = 0.5, cap_ms: int = 120_000) -> Column:
    """Doubling back-off with jitter; on 429 and 503 a longer numeric Retry-After wins; both are capped."""
    wait = F.least(F.lit(float(cap_ms)), base_ms * F.pow(F.lit(2.0), attempt - 1) * (0.5 + jitter))
    asked = F.when(http.isin("429", "503"), F.trim(retry_after).try_cast("double") * 1000)
    return F.rint(F.when(asked > wait, F.least(F.lit(float(cap_ms)), asked)).otherwise(wait)).cast("long")


def batch_wait_sec(kind: Column, n: Column) -> Column:
    """Waits of the batch service by kind of failure; null where it fails at once."""
    return F.when(kind == "429", 60 * n).when(kind.isin("500", "503"), 10 * n).when(kind == "timeout", 15 * n).when(kind == "not_stop", 5 * n).when(kind.isin("recitation", "value_error"), None).otherwise(0)


def log_stage(line: Column) -> Column:
    """Stage of a log line: the first marker, in fixed order, that stands in it."""
    found = None
    for mark, stage in STAGES:
        hit = F.contains(F.lower(line), F.lit(mark))
        found = F.when(hit, stage) if found is None else found.when(hit, stage)
    return found


def job_stages(log: DataFrame) -> DataFrame:
    """(job, ord, stage): the last stage that any line so far named."""
    w = Window.partitionBy("job").orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return log.select("job", "ord", F.last(log_stage(F.col("line")), True).over(w).alias("stage"))


def output_allowed(backend: Column, output: Column, has_gpu: Column) -> Column:
    return (output == "txt") | (backend == "mai") | has_gpu


def probe_class(backend: Column, status: Column) -> Column:
    return (
        F.when((status >= 200) & (status < 300), "ok").when(status == 401, "bad key").when((status == 403) & (backend == "router"), "ok")
        .when(status == 0, "unreachable").otherwise("unexpected")
    )


def step_chain(backend: Column, output: Column) -> Column:
    srt = output == "srt"
    vertex = F.when(srt, "stage>transcribe>align").otherwise("stage>transcribe")
    return F.when(backend == "vertex", vertex).otherwise(F.when(srt, "transcribe>build srt").otherwise("transcribe"))


def last_wins(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value))


def upsert(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """New non-empty values over old ones; unseen keys are added."""
    n = new.select(F.col(key), F.nullif(F.col(value), F.lit("")).alias("__new"))
    return old.join(n, key, "full_outer").select(key, F.coalesce("__new", value, F.lit("")).alias(value))


def env_merge(lines: DataFrame, new: DataFrame) -> DataFrame:
    """lines (ord, line) of a settings file with the values of new (k, v) in place; comments and other lines stay, unseen keys are added by name at the end."""
    s = F.trim("line")
    key = F.when((s != "") & ~F.startswith(s, F.lit("#")) & F.contains(s, F.lit("=")), F.trim(F.split(s, "=", 2)[0]))
    old = lines.withColumn("key", key).join(new.select(F.col("k").alias("key"), F.col("v").alias("value")), "key", "left")
    merged = old.select("ord", F.when(F.col("value").isNotNull(), F.concat_ws("=", "key", "value")).otherwise(F.col("line")).alias("line"))
    added = new.join(lines.select(key.alias("k")).where("k IS NOT NULL").distinct(), "k", "left_anti")
    last = lines.agg(F.coalesce(F.max("ord") + 1, F.lit(0).cast("long")).alias("last"))
    # The keys to add are those of one settings change, a few.
    added = added.select(F.row_number().over(Window.orderBy("k")).alias("o"), F.concat_ws("=", "k", "v").alias("line")).join(F.broadcast(last))
    return merged.union(added.select((F.col("last") + F.col("o") - 1).alias("ord"), "line"))


def progress(done: DataFrame) -> DataFrame:
    """done (job, ord, took_ms, ok) with counts so far and the time left, in whole milliseconds, at the mean so far."""
    w = Window.partitionBy("job").orderBy("ord")
    sofar = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.count(F.lit(1)).over(Window.partitionBy("job"))
    d = done.withColumn("good", F.sum(F.col("ok").cast("long")).over(sofar)).withColumn("elapsed_ms", F.sum("took_ms").over(sofar)).withColumn("left", total - F.col("ord"))
    return d.select("job", "ord", "good", (F.col("ord") - F.col("good")).alias("bad"), "elapsed_ms", F.expr("(left * elapsed_ms) div ord").alias("eta_ms"))
