"""The queries opN_<name> over the driver's tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import chat, decontam, lexical, licenses, merkle, oracles, packing, pieces, quality_knn, quality_rules, secrets, simhash, substring, toxicity
from .common import table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as they would be logged: answers stream in two parts, other turns begin as empty drafts that are edited."""
    extra = spark.sql("SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").union(extra)
    rows = rows.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("k", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")))
    parts = """if(role = 'assistant', array(struct(0 AS o, 'message' AS kind, left(text, cast(length(text) div 2 AS int)) AS part), struct(1 AS o, 'delta' AS kind, substring(text, cast(length(text) div 2 AS int) + 1) AS part)),
      array(struct(0 AS o, 'message' AS kind, '' AS part), struct(1 AS o, 'edit' AS kind, text AS part)))"""
    events = rows.withColumn("e", F.explode(F.expr(parts)))
    events = events.select("conv_id", F.expr("cast(2 * k + e.o AS long)").alias("seq"), "e.kind", "turn", "role", F.col("e.part").alias("text"))
    return chat.digest(chat.format_log(events))


OP2_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(regexp_replace(replace(text, '\', '\\'), '([<\[])(\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|<SYS>>|</SYS>>)', '\1\\\2', 'g'))
     + length(regexp_replace(replace(role, '\', '\\'), '([<\[])(\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|<SYS>>|</SYS>>)', '\1\\\2', 'g')) + 32 AS size
  FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(size)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])
    return rows.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256", (F.size("spans") > 0).alias("has_repeats"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.public_tokenizer())


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_knn.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.recognise(table(spark, sf_dir, "documents")).select("doc_id", "n_known", "licenses")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pieces.round_trip(table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("string").alias("text")), pieces.public_model())
    return rows.select(
        "doc_id", F.expr("cast(octet_length(ids) div 4 AS long)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS d, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), tf AS (SELECT d, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
n AS (SELECT d, sum(tf) AS n FROM tf GROUP BY d),
stats AS (SELECT count(*) AS n_docs, sum(n) AS n_terms FROM n),
m AS (SELECT d, CAST(100 - 25 + (25 * n * n_docs) // n_terms AS BIGINT) AS m FROM n, stats),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, stats GROUP BY term),
q AS (
  SELECT q, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS q, * FROM benchmark)
),
s AS (SELECT q, item_id, d, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (d) GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 2 divides the crc32 of a doc_id, a copy of the row whose text lost its line ends is held against the root."""
    docs = table(spark, sf_dir, "documents")
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(marked, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    leaves = docs.select("source", "doc_id", merkle.leaf().alias("leaf"), merkle.leaf(text=tampered).alias("claimed"))
    rows = merkle.proofs(leaves).withColumn("folded_root", merkle.fold(F.col("claimed"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_text(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup, op2_chat_format, op3_decontamination, op4_quality_classifier, op5_substring_dedup, op6_packing, op7_quality_rules, op8_secret_scan,
        op9_toxicity, op10_license_scan, op11_sentencepiece, op12_lexical_search, op13_merkle_manifest,
    )
}
ORACLE_SQL = {"op2_chat_format": OP2_SQL, "op8_secret_scan": oracles.secrets_sql(), "op10_license_scan": oracles.licenses_sql(), "op12_lexical_search": OP12_SQL, "op13_merkle_manifest": oracles.merkle_sql()}
