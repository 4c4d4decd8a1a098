"""Shared pieces: tables in the shared folder, row access in Arrow batches, connected components."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
#: The label rows of this remainder are held out.
HELD_OUT = 2


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a folder of its own where that is unset and all runs in one process."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master.split("[")[0] != "local":
            raise ValueError(f"spark.checkpoint.dir must name a folder that driver and executors share; the master is {master}")
        base = tempfile.mkdtemp(prefix="captionlake-")
        atexit.register(shutil.rmtree, base, True)
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts the lineage, survives lost executors, and is computed once.

    Hadoop deletes the table when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return spark.read.schema(df.schema).parquet(path)


def free_name(taken: list[str], name: str) -> str:
    """name, with underscores before it until no column (whatever its case) is called so."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def key_filter(keys: DataFrame, column: str, most_bits: int = 30) -> np.ndarray:
    """A Bloom filter with one hash of a column: 16 to 32 bits for each key, 2**most_bits (128 MB) at most; fuller filters only let more pass."""
    bits = min(most_bits, max(16, math.ceil(math.log2(16 * max(1, keys.count())))))
    h = keys.select((F.xxhash64(column).bitwiseAND((1 << bits) - 1)).alias("h"))
    words = h.groupBy(F.expr("shiftright(h, 6)").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(h & 63 AS int)))").alias("b")).toArrow()
    out = np.zeros(1 << bits - 6, np.int64)
    out[words.column(0).to_numpy()] = words.column(1).to_numpy()
    return out


def may_hold(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which xxhash64 values h may be of a key of the filter."""
    h = h & np.int64((len(words) << 6) - 1)
    return (words[h >> 6].view(np.uint64) >> (h & 63).astype(np.uint64)) & np.uint64(1) == 1


def parts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Small slices of the batches, so that what is made of texts in Python stays small."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id) -> F.Column:
    """crc32 of doc_id as text, modulo 4."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def _signature(df: DataFrame) -> tuple:
    row = df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): alternating large and small stars.

    Every round is two partial aggregations and two equi-joins on the node. What was aggregated is written before it is
    joined, so that both sides of a join are plain exchanges and Spark can split a hub's edges over tasks (or broadcast
    the smaller side by its size); no component is gathered anywhere. root is the smallest node of the component.
    """
    e = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    before = _signature(e)
    while before[0]:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m")), "least")
        large = materialize(both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "large")
        low = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = materialize(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "stars")
        now = _signature(e)
        if now == before:
            break
        before = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select("b", "b").distinct())
