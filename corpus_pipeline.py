"""The corpus pipeline: stages that each apply one operator to all that its predecessor kept.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of docs; the last returns pieces of packed sequences.

For every stage: null text is empty, very long texts are read whole, rows that repeat are judged alike, columns besides
doc_id, text, lang and source are carried along whatever their names, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from captionlake.llm import decontam, packing, quality_rules, secrets, simhash
from captionlake.llm.common import materialize, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are outliers of their language and source go; a text without words fails. A distance at the cut-off stays."""
    return quality_rules.keep(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share 0.8 of their five-word shingles the one with the smallest doc_id stays; rows without doc_id come last, ties go by text hash."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, 0.8 of its words in whatever order of passages, go; coverage of just 0.8 goes too. Items without five words are in none."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced and n_chars follows; the documents stay, null text stays null. Of spans that overlap the union is replaced."""
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1,024 tokens; repeated rows are packed as often as they stand, empty texts are their end id, and of equally good fill levels the fullest is taken."""
    return packing.pack(docs, packing.public_tokenizer())


STAGES = [
    ("quality rules", quality_stage),
    ("near-dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secret scan", secret_stage),
    ("packing", packing_stage),
]
#: SQL expresses neither the tries, the tiling nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
