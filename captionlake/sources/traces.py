"""Run traces as VARIANT: each file is parsed once, whatever its fields, and asked for what a query needs.

Edge cases: a file that is no JSON is a null trace and has no chunks, attempts or usage; missing fields are null; a usage that is
no object has no entries; NaN is no JSON, so a trace that holds one is null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def traces(spark: SparkSession, path: str) -> DataFrame:
    """(path, trace) of the trace files below a folder."""
    raw = spark.read.text(path, wholetext=True, pathGlobFilter="*.json").select(F.input_file_name().alias("path"), "value")
    return parsed(raw, "value").select("path", "trace")


def parsed(rows: DataFrame, text: str) -> DataFrame:
    """rows with the variant `trace` of a JSON column."""
    return rows.withColumn("trace", F.try_parse_json(text))


def _exploded(rows: DataFrame, array: str, name: str) -> DataFrame:
    """rows beside each element of an array in a variant, as the variant `name`."""
    return rows.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col(array).outer()).select(F.col("value").alias(name)))


def header(rows: DataFrame) -> DataFrame:
    """rows (trace) with the fields of the run: version, input, duration, model, thresholds, and how the build ended."""
    got = lambda path, kind: F.try_variant_get("trace", path, kind)
    fields = {
        "version": ("$.version", "long"), "input": ("$.meta.input", "string"), "duration_sec": ("$.meta.duration_sec", "double"), "model": ("$.meta.model", "string"),
        "commit": ("$.meta.pipeline_commit", "string"), "prompt_sha256": ("$.meta.prompt_sha256", "string"), "mai_enabled": ("$.meta.mai_enabled", "boolean"),
        "started_at": ("$.meta.started_at", "string"), "finished_at": ("$.meta.finished_at", "string"), "speech_sec": ("$.vad.speech_sec", "double"),
        "thresholds": ("$.meta.thresholds", "map<string,double>"), "cues": ("$.build.cues", "long"), "mean_score": ("$.build.mean_score", "double"), "exit": ("$.build.exit", "long"),
    }
    return rows.withColumns({n: got(*x) for n, x in fields.items()})


def chunks(rows: DataFrame) -> DataFrame:
    """rows (trace) beside the fields of each of its chunks; `chunk` is the whole entry."""
    d = _exploded(rows.withColumn("_a", F.try_variant_get("trace", "$.chunks", "variant")), "_a", "chunk").drop("_a")
    fields = {
        "idx": "long", "start": "double", "end": "double", "speech_sec": "double", "vad": "string", "outcome": "string", "note": "string", "text": "string",
        "build.total_words": "long", "build.aligned_words": "long", "build.mean_score": "double", "build.align_error": "string",
    }
    return d.withColumns({n.replace("build.", ""): F.try_variant_get("chunk", f"$.{n}", k) for n, k in fields.items()})


def attempts(rows: DataFrame) -> DataFrame:
    """chunks() beside each attempt: number, engine, answer, and its usage, whatever that holds."""
    d = _exploded(chunks(rows).withColumn("_a", F.try_variant_get("chunk", "$.attempts", "variant")), "_a", "attempt").drop("_a")
    fields = {"n": "long", "engine": "string", "http": "string", "finish": "string", "words": "long", "served_model": "string", "detail": "string", "wait_sec": "double"}
    d = d.withColumns({"try_" + n: F.try_variant_get("attempt", f"$.{n}", k) for n, k in fields.items()})
    return d.withColumns({"try_outcome": F.try_variant_get("attempt", "$.outcome", "string"), "usage": F.try_variant_get("attempt", "$.usage", "variant")})


def usage_entries(rows: DataFrame) -> DataFrame:
    """attempts() beside each entry of the usage: name, amount (null unless it is a number) and kind."""
    d = rows.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("usage").outer()).select(F.col("key").alias("name"), F.col("value").alias("_v")))
    return d.where("name IS NOT NULL").withColumns({"amount": F.try_variant_get("_v", "$", "double"), "kind": F.schema_of_variant("_v")}).drop("_v")


def schema(rows: DataFrame, column: str = "trace") -> str:
    """The schema that all variants of a column fit into, merged by a distributed aggregate."""
    return rows.agg(F.schema_of_variant_agg(column)).first()[0]
