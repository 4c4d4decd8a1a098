"""Readers: transcripts, subtitle files, word files, plans, streamed replies, headers, settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captionlake.functions.text import file_stem, normalize_key, srt_cues, tokens

#: The error of a reply that is no event stream: how many characters of the body it holds, and what stands before them.
SHOWN, NO_STREAM = 300, "not an event stream: "
WORD = "struct<w: string, start: double, end: double, score: double>"
WORDS_JSON = f"key string, audio string, vad array<double>, words array<{WORD}>"
PLAN_JSON = "dur double, input string, model string, segments array<array<double>>, chunks array<struct<idx: bigint, start: double, end: double, speech_sec: double, cut_gap_sec: double>>"
#: The file endings that count as audio for pairing, for a batch, and for choosing a file.
AUDIO = ("mp3",)
BATCH_AUDIO = ("mp3", "wav", "m4a", "flac", "ogg", "aac", "wma")
CHOICE_AUDIO = ("mp3", "m4a", "wav", "mp4", "mkv", "webm", "aac", "flac")


def _listed(spark: SparkSession, folder: str, endings: tuple[str, ...]) -> DataFrame:
    """(path, size) of the files of a folder, not of those below it, with one of the endings in whatever case."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder).select("path", F.col("length").alias("size"))
    return d.where(F.lower("path").rlike(r"\.(" + "|".join(endings) + ")$"))


def audio_files(spark: SparkSession, folders: list[str], endings: tuple[str, ...] = AUDIO) -> DataFrame:
    """(key, path, size): one file for each title; folders count in the order given, then names. Only names are read, never contents."""
    found = None
    for n, folder in enumerate(folders):
        f = _listed(spark, folder, endings).withColumn("folder", F.lit(n))
        found = f if found is None else found.union(f)
    d = found.withColumn("key", normalize_key(file_stem("path")))
    return d.groupBy("key").agg(F.min(F.struct("folder", "path", "size")).alias("x")).select("key", "x.path", "x.size")


def batch_listing(spark: SparkSession, folder: str) -> DataFrame:
    """(name, filename, path, size_mb) of a folder's audio files for a batch, in the order of their names."""
    d = _listed(spark, folder, BATCH_AUDIO).withColumn("filename", F.regexp_extract("path", "[^/]*$", 0))
    return d.select(F.regexp_replace("filename", r"\.[^.]*$", "").alias("name"), "filename", "path", (F.col("size") / 1048576).alias("size_mb")).orderBy("filename")


def choice_listing(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of a folder's sound and film files, in order."""
    return _listed(spark, folder, CHOICE_AUDIO).select("path").orderBy("path")


def transcripts(spark: SparkSession, path: str, kind: str = "txt") -> DataFrame:
    """(path, pos, w): words of text files, or of the cues of subtitle files."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value"))
    text = F.array_join(srt_cues("value"), " ") if kind == "srt" else F.col("value")
    return raw.select("path", F.posexplode(tokens(text)).alias("pos", "w"))


def words_json(spark: SparkSession, path: str) -> DataFrame:
    """(key, pos, w, start_ms, end_ms, score): an empty speech region is null."""
    raw = spark.read.schema(WORDS_JSON).json(path, multiLine=True)
    ms = lambda c: F.rint(F.col(c) * 1000).cast("long")
    return raw.select("key", "vad", F.posexplode("words").alias("pos", "x")).select("key", "pos", "x.w", ms("x.start").alias("start_ms"), ms("x.end").alias("end_ms"), "x.score")


def plan_json(spark: SparkSession, path: str) -> DataFrame:
    """Rows of plan files; a broken file gives nulls rather than an error."""
    return spark.read.schema(PLAN_JSON).option("mode", "PERMISSIVE").json(path, multiLine=True)


def manifest_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def trace_json(spark: SparkSession, path: str) -> DataFrame:
    """(path, chunks) of run traces; chunks is null where a file is broken."""
    kind = "chunks array<struct<idx: bigint, outcome: string, tries: array<struct<n: bigint, outcome: string, detail: string>>>>"
    raw = spark.read.text(path, wholetext=True, pathGlobFilter="*.json").select(F.input_file_name().alias("path"), "value")
    return raw.select("path", F.from_json("value", kind)["chunks"].alias("chunks"))


def mai_replies(replies: DataFrame) -> DataFrame:
    """(file_id, http, text, words, duration, language, cost, seconds, error) from replies (file_id, reply): a JSON body and a trailer |HTTP<code>.

    What stands behind the last trailer mark is the code. A body that is no JSON, or holds an error, gives no text and no
    words, and an error of at most 200 or 300 characters.
    """
    word = "array<struct<word: string, start: double, end: double>>"
    kind = f"text string, words {word}, duration double, language string, usage struct<cost: double, seconds: double>"
    mark = F.lit("|HTTP")
    body = F.when(F.contains("reply", mark), F.substring_index("reply", "|HTTP", -1)).otherwise(F.col("reply"))
    d = replies.withColumns({"tail": body, "marked": F.contains("reply", mark)})
    d = d.withColumn("body", F.when(F.col("marked"), F.expr("left(reply, length(reply) - length(tail) - 5)")).otherwise("")).withColumn("http", F.trim("tail"))
    d = d.withColumns({"x": F.from_json("body", kind), "whole": F.try_parse_json("body")})
    told = F.get_json_object("body", "$.error")
    error = F.when(F.col("whole").isNull(), F.concat(F.lit("body is not JSON: "), F.substring("body", 1, 200))).when(~told.isin("", "null", "false", "0", "{}", "[]"), F.substring(told, 1, 300))
    d = d.withColumn("error", error)
    good = lambda c, other: F.when(F.col("error").isNull(), F.coalesce(c, other)).otherwise(other)
    none = F.expr(f"cast(array() AS {word})")
    return d.select(
        "file_id", "http", good(F.trim("x.text"), F.lit("")).alias("text"), good(F.col("x.words"), none).alias("words"), good(F.col("x.duration"), F.lit(None)).alias("duration"),
        good(F.col("x.language"), F.lit(None)).alias("language"), good(F.col("x.usage.cost"), F.lit(None)).alias("cost"), good(F.col("x.usage.seconds"), F.lit(None)).alias("seconds"), "error",
    )


def sse_replies(lines: DataFrame) -> DataFrame:
    """(file_id, content, model, finish, usage, errors) from lines (file_id, ord, line) of event streams, ord from 0.

    Only data lines count; empty, [DONE] and broken ones are skipped; contents join in order, the last model, finish and usage
    win; an event with an error counts as that alone. A body that does not begin with a data line has an error with its
    first 300 characters. Errors and usage are JSON, an error that is a text is that text.
    """
    kind = "struct<model: string, usage: string, error: string, choices: array<struct<delta: struct<content: string>, finish_reason: string>>>"
    line = F.coalesce("line", F.lit(""))
    body = F.when(F.startswith(line, F.lit("data:")), F.trim(F.substring(line, 6, 1 << 30)))
    d = lines.withColumns({"line": line, "body": body}).withColumn("x", F.from_json("body", kind))
    d = d.withColumn("bad", F.get_json_object("body", "$.error").isNotNull())
    good = F.when(~F.col("bad"), F.col("x"))
    text = F.array_join(F.transform(F.coalesce(good["choices"], F.array().cast("array<struct<delta: struct<content: string>, finish_reason: string>>")), lambda c: F.coalesce(c["delta"]["content"], F.lit(""))), "")
    finish = F.try_element_at(F.filter(F.transform(good["choices"], lambda c: c["finish_reason"]), lambda f: F.length(f) > 0), F.lit(-1))
    usage = F.when(~F.coalesce(good["usage"], F.lit("")).isin("", "null", "{}", "[]", "0", "false"), good["usage"])
    d = d.withColumns({"t": text, "f": finish, "u": usage, "m": good["model"]})
    ordered = lambda keep, *c: F.array_sort(F.collect_list(F.when(keep, F.struct("ord", *c))))
    last = lambda x: F.max_by(x, F.when(F.nullif(x, F.lit("")).isNotNull(), F.col("ord")))
    begins = F.min_by(F.trim("line"), F.when(F.trim("line") != "", F.col("ord")))  # blanks before the first word don't count
    g = d.groupBy("file_id").agg(
        ordered(F.length("t") > 0, "t").alias("t"), last(F.col("m")).alias("model"), last(F.col("f")).alias("finish"), last(F.col("u")).alias("usage"),
        ordered(F.col("bad"), F.col("x.error").alias("e")).alias("e"), begins.alias("begins"),
        ordered(F.col("ord") < SHOWN, F.substring("line", 1, SHOWN).alias("l")).alias("shown"),
    )
    whole = F.substring(F.array_join(F.transform("shown", lambda x: x["l"]), "\n"), 1, SHOWN)
    error = F.when(~F.startswith("begins", F.lit("data:")), F.array(F.concat(F.lit(NO_STREAM), whole))).otherwise(F.array().cast("array<string>"))
    return g.select(
        "file_id", F.array_join(F.transform("t", lambda p: p["t"]), "").alias("content"), "model", "finish", "usage",
        F.concat(F.transform("e", lambda p: p["e"]), F.coalesce(error, F.array().cast("array<string>"))).alias("errors"),
    )


def last_header(lines: DataFrame, name: str) -> DataFrame:
    """(file_id, value) of the last header of that name over all blocks, whatever its case."""
    two = F.split("line", ":", 2)
    hit = lines.where(F.lower(F.trim(two[0])) == name.lower()).where(F.size(two) == 2)
    return hit.groupBy("file_id").agg(F.max_by(F.trim(two[1]), "ord").alias("value"))


def env_pairs(lines: DataFrame) -> DataFrame:
    """(k, v) of KEY=VALUE lines (ord, line); comments and lines without = are skipped, the last of a key wins."""
    d = lines.withColumn("line", F.trim("line")).where("line <> '' AND line NOT LIKE '#%' AND contains(line, '=')")
    two = F.split("line", "=", 2)
    return d.select("ord", F.trim(two[0]).alias("k"), F.trim(two[1]).alias("v")).groupBy("k").agg(F.max_by("v", "ord").alias("v"))


def job_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id string, backend string, output string, source string, status string, stage string, created double").option("mode", "DROPMALFORMED").json(path, multiLine=True)
