"""Writers: subtitle files, manifests, JSON without NaN."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def finite(df: DataFrame) -> DataFrame:
    """NaN and infinities become null, in nested columns too."""

    def clean(c, kind: T.DataType):
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
        if isinstance(kind, T.ArrayType):
            return F.transform(c, lambda x: clean(x, kind.elementType))
        if isinstance(kind, T.StructType):
            return F.when(c.isNotNull(), F.struct(*[clean(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
        return c

    return df.select(*[clean(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def write_json(df: DataFrame, path: str) -> None:
    finite(df).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_manifest(df: DataFrame, path: str) -> None:
    """A CSV with header; each run replaces it."""
    df.write.mode("overwrite").csv(path, header=True, emptyValue="")


def write_srt(cues: DataFrame, path: str, mode: str = "overwrite") -> None:
    """cues (file_id, n, start_ms, end_ms, text): one subtitle file for each file, streamed in order by the task that has it."""
    from captionlake.sources.formats import register

    register(cues.sparkSession)
    rows = cues.select(*[F.col(n).cast(k).alias(n) for n, k in (("file_id", "string"), ("n", "long"), ("start_ms", "long"), ("end_ms", "long"), ("text", "string"))])
    rows.repartition("file_id").sortWithinPartitions("file_id", "n").write.format("srt").mode(mode).save(path)
