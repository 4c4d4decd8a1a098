"""The bounded labelled sample that models are fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HELD_OUT, remainder


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int, balanced: bool) -> DataFrame:
    """(doc_id, text, y) of at most `most` labelled documents that aren't held out.

    They are those of the smallest hash of doc_id; balanced: half of them of each class, as far as it goes. The ids are
    found by a top-k over labels, and their number bounds what is broadcast to find the texts. Of rows that share a doc_id
    one is taken, that of the smallest text hash, by an aggregate with a map-side part; labels that contradict each other
    for one doc_id are left out.
    """
    y = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)")
    y = y.where(remainder(F.col("doc_id")) != HELD_OUT).groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").drop("z")
    near = F.xxhash64("doc_id")
    if balanced:
        picked = y.where("y = 0").orderBy(near, "doc_id").limit(most // 2).union(y.where("y = 1").orderBy(near, "doc_id").limit(most // 2))
    else:
        picked = y.orderBy(near, "doc_id").limit(most)
    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(picked), "doc_id")
    return found.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x"), F.min("y").alias("y")).select("doc_id", "x.text", "y")


def class_counts(labels: DataFrame, label: str) -> tuple[int, int]:
    """How many labelled rows that aren't held out have label 0 and 1."""
    kept = labels.where(remainder(F.col("doc_id").cast("long")) != HELD_OUT).where(F.col(label).isin(0, 1))
    row = kept.agg(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).first()
    return row[0], row[1]


def held_out() -> F.Column:
    return remainder(F.col("doc_id")) == HELD_OUT
