"""Queries on attempts, manifests, pairing, settings and job logs."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Window
from pyspark.sql import functions as F

from captionlake.functions import text as T
from captionlake.operators import manifest as M
from captionlake.operators import pairing as P
from captionlake.sources import readers as R
from captionlake.sources import sinks as S
from captionlake.sources import traces as TR

from .derive import ATTEMPTS, JOBLOG, attempts, job_log, titles, titles_sql
from .derive import table as src

Q, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


KEYS = titles_sql(T.MARKED, T.PLAIN)


@query("WITH " + KEYS + " SELECT key, ord, title FROM ix")
def q_index_keep_first(spark, d):
    return P.keep_first(titles(spark, d)[1])


def pairs(spark, d):
    return P.build_pairs(*titles(spark, d))


PAIRS = KEYS + ", pairs AS (SELECT coalesce(tl.key, ix.key) AS key, tl.ord, ix.ord AS audio_ord FROM tl FULL JOIN ix ON tl.key = ix.key)"


@query("WITH " + PAIRS + " SELECT * FROM pairs")
def q_pair_full_outer(spark, d):
    return pairs(spark, d)


def decomposed(text):
    """A text with the marked letters of European languages as letters and marks, the way some file systems give names."""
    for letter in "áéíóúýàèìòùâêîôûäëïöüãõñçåÁÉÍÓÚÝÀÈÌÒÙÂÊÎÔÛÄËÏÖÜÃÕÑÇÅ":
        text = F.replace(text, F.lit(letter), F.lit(unicodedata.normalize("NFD", letter)))
    return text


@query("WITH " + PAIRS + ", tc AS (SELECT ord, length(replace(title, chr(10), '')) AS chars FROM ta) SELECT key, pairs.ord, audio_ord, CAST(chars AS BIGINT) AS audio_chars FROM pairs LEFT JOIN tc ON tc.ord = audio_ord")
def q_pair_decomposed(spark, d):
    """Titles against audio names whose marks stand apart: the same pairs, and the same number of characters."""
    t, a = titles(spark, d)
    a = a.withColumn("title", decomposed(F.col("title")))
    chars = a.select(F.col("ord").alias("audio_ord"), T.char_count("title").alias("audio_chars"))
    return P.build_pairs(t, a).join(chars, "audio_ord", "left").select("key", "ord", "audio_ord", "audio_chars")


@query("WITH " + KEYS + " SELECT key, ord FROM ix WHERE key NOT IN (SELECT key FROM tl WHERE ord % 5 <> 0)")
def q_pair_unused_audio(spark, d):
    t, a = titles(spark, d)
    used = t.where("ord % 5 <> 0").select(T.normalize_key("title").alias("key"))
    return P.keep_first(a).join(used, "key", "left_anti").select("key", "ord")


@query("WITH " + KEYS + " SELECT ord FROM tl WHERE key IN (SELECT key FROM tr)")
def q_semi_delete_list(spark, d):
    t, a = titles(spark, d)
    return t.withColumn("key", T.normalize_key("title")).join(a.select(T.normalize_key("title").alias("key")), "key", "left_semi").select("ord")


@query("WITH " + PAIRS + """, x AS (SELECT 'transcript' AS side, key FROM pairs WHERE audio_ord IS NULL UNION ALL SELECT 'audio', key FROM pairs WHERE ord IS NULL)
SELECT side, row_number() OVER (PARTITION BY side ORDER BY key) AS n, '- ' || key AS line FROM x UNION ALL SELECT s, 1, '- (none)' FROM (VALUES ('transcript'), ('audio')) t(s) WHERE s NOT IN (SELECT side FROM x)""")
def q_unpaired_report(spark, d):
    return P.unpaired_report(pairs(spark, d))


@query("WITH " + PAIRS + " SELECT * FROM pairs WHERE contains(key, 'the') AND audio_ord IS NOT NULL AND ord IS NOT NULL ORDER BY key, ord LIMIT 20")
def q_select_pairs(spark, d):
    return P.select_pairs(pairs(spark, d).where("audio_ord IS NOT NULL AND ord IS NOT NULL"), only="the", limit=20)


@query("SELECT doc_id AS name, n_chars AS dur_ms FROM documents ORDER BY n_chars, doc_id LIMIT 300")
def q_top_shortest(spark, d):
    return P.top_shortest(src(spark, d, "documents").select(F.col("doc_id").alias("name"), F.col("n_chars").alias("dur_ms")), 300)


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.doc_id IS NULL")
def q_resume_pending(spark, d):
    return P.pending(src(spark, d, "documents").select("doc_id"), src(spark, d, "labels"), "doc_id")


@query("WITH " + KEYS + " SELECT key FROM tl INTERSECT SELECT key FROM tr")
def q_shared_keys(spark, d):
    t, a = titles(spark, d)
    return t.select(T.normalize_key("title").alias("key")).intersect(a.select(T.normalize_key("title").alias("key")))


@query("WITH " + KEYS + " SELECT key FROM tl EXCEPT SELECT key FROM tr")
def q_unpaired_except(spark, d):
    t, a = titles(spark, d)
    return t.select(T.normalize_key("title").alias("key")).subtract(a.select(T.normalize_key("title").alias("key")))


@query("SELECT DISTINCT path FROM (SELECT doc_id || '/a.srt' AS path FROM documents UNION ALL SELECT doc_id || '.txt' FROM documents UNION ALL SELECT doc_id || '/a.srt' FROM labels)")
def q_collect_outputs(spark, d):
    docs, labels = src(spark, d, "documents"), src(spark, d, "labels")
    srt = lambda x: x.select(F.concat(F.col("doc_id").cast("string"), F.lit("/a.srt")).alias("path"))
    return srt(docs).union(docs.select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))).union(srt(labels)).distinct()


BLOCK = "(finish = 'content_filter' OR (finish = '' AND contains(replace(lower(text), '’', ''''), 'blocked by gemini''s filters')))"
NW = r"len(list_filter(regexp_split_to_array(text, '[ \n\t\r]+'), lambda x: x <> ''))"
DENS = f"CASE WHEN speech_ms < 30000 THEN NULL WHEN {NW} = 0 THEN 'empty despite speech present' WHEN {NW} * 60000 < 60 * speech_ms THEN 'low word density (' || CAST(round_even({NW} * 60000.0::DOUBLE / speech_ms, 0) AS BIGINT) || '/min)' END"
REAS = f"concat_ws('; ', CASE WHEN error <> '' THEN 'error' END, CASE WHEN finish <> 'stop' THEN 'finish=' || CASE WHEN finish = '' THEN 'empty' ELSE finish END END, {DENS})"
OUT = ATTEMPTS + f""",
o1 AS (SELECT *, contains(error, '403') AS locked, NOT contains(error, '403') AND {BLOCK} AS blocked, {REAS} AS why, {NW} AS nw FROM tries),
o2 AS (SELECT *, CASE WHEN locked THEN '403 account locked' WHEN blocked THEN 'blocked by Gemini filters' ELSE why END AS reasons FROM o1),
o3 AS (SELECT *, CASE WHEN locked THEN '403' WHEN blocked THEN 'blocked' WHEN reasons = '' THEN 'ok' WHEN error <> '' THEN 'error' WHEN contains(reasons, 'low word density') THEN 'low density' WHEN nw = 0 THEN 'empty' ELSE 'error' END AS outcome,
  CASE WHEN locked OR blocked THEN 0 ELSE nw END AS words, left(CASE WHEN error <> '' AND reasons <> '' THEN reasons || ' | ' || error WHEN error <> '' THEN error ELSE reasons END, 200) AS detail FROM o2),
st AS (SELECT *, min(CASE WHEN outcome IN ('ok', '403') THEN n END) OVER (PARTITION BY file_id, chunk) AS stop FROM o3),
ca AS (SELECT file_id, chunk, count(*) AS attempts, bool_or(outcome = '403') AS locked, bool_or(outcome = 'blocked') AND NOT bool_or(outcome = 'ok') AND NOT bool_or(outcome = '403') AS blocked, bool_or(outcome = 'ok') AS ok, CAST(arg_max(words, n) AS BIGINT) AS words, arg_max(reasons, n) AS reasons, CAST(max(speech_ms) AS BIGINT) AS speech_ms FROM st WHERE stop IS NULL OR n <= stop GROUP BY file_id, chunk)"""


@query("WITH " + ATTEMPTS + f" SELECT event_id, {DENS} AS reason FROM tries")
def q_density_guard(spark, d):
    return attempts(spark, d).select("event_id", M.density_reason(F.col("text"), F.col("speech_ms")).alias("reason"))


@query("WITH " + ATTEMPTS + f" SELECT event_id, {REAS} AS reasons FROM tries")
def q_guard_reasons(spark, d):
    c = F.col
    return attempts(spark, d).select("event_id", M.guard_reasons(c("error"), c("finish"), c("text"), c("speech_ms")).alias("reasons"))


@query("WITH " + ATTEMPTS + f" SELECT event_id, {BLOCK} AS blocked FROM tries")
def q_filter_block(spark, d):
    return attempts(spark, d).select("event_id", M.filter_block(F.col("finish"), F.col("text")).alias("blocked"))


@query("WITH " + OUT + " SELECT event_id, n, outcome, CAST(words AS BIGINT) AS words, detail FROM o3")
def q_try_outcome(spark, d):
    return M.try_outcomes(attempts(spark, d)).select("event_id", "n", "outcome", "words", "detail")


@query("WITH " + OUT + " SELECT file_id, chunk, attempts, locked, blocked, ok, words FROM ca")
def q_chunk_attempts(spark, d):
    return M.chunk_attempts(attempts(spark, d))


DISP = OUT + f""",
di AS (SELECT file_id, chunk, locked, blocked, words, chunk % 4 = 0 AS silent, CASE WHEN ok OR locked THEN '' WHEN blocked THEN 'blocked by Gemini filters' ELSE 'finish=empty' END AS reasons, CASE WHEN chunk % 11 = 0 AND ok THEN 'mai' ELSE '' END AS engine FROM ca),
d2 AS (SELECT *, NOT (locked OR (blocked AND silent) OR reasons <> '' OR (silent AND words = 0)) AS included, CASE WHEN locked THEN '{M.LOCKED}' WHEN blocked AND silent THEN '{M.SILENT_BLOCKED}' WHEN reasons <> '' THEN '{M.FAILED}' || reasons WHEN silent AND words > 0 THEN 'silent, scored at 0.5' WHEN silent THEN '{M.SKIPPED}' WHEN engine = 'mai' THEN '{M.MAI_NOTE}' ELSE '' END AS note FROM di)"""


def chunks(spark, d):
    c = M.chunk_attempts(attempts(spark, d))
    why = F.when(F.col("ok") | F.col("locked"), "").when(F.col("blocked"), "blocked by Gemini filters").otherwise("finish=empty")
    engine = F.when((F.col("chunk") % 11 == 0) & F.col("ok"), "mai").otherwise("")
    return c.select("file_id", "chunk", "locked", "blocked", "words", (F.col("chunk") % 4 == 0).alias("silent"), why.alias("reasons"), engine.alias("engine"))


@query("WITH " + DISP + " SELECT file_id, chunk, included, note FROM d2")
def q_disposition(spark, d):
    return M.disposition(chunks(spark, d)).select("file_id", "chunk", "included", "note")


@query("WITH " + DISP + """, m AS (SELECT file_id, chunk, words, NOT silent AS has_speech, reasons FROM di) SELECT file_id, chunk, CASE WHEN reasons <> '' THEN 'error: ' || reasons WHEN NOT has_speech THEN CASE WHEN words > 20 THEN 'hallucination? words without speech' ELSE 'skipped' END ELSE '' END AS note, reasons = '' AND has_speech AS included FROM m""")
def q_mai_disposition(spark, d):
    c = chunks(spark, d).withColumn("has_speech", ~F.col("silent"))
    return M.mai_disposition(c).select("file_id", "chunk", "note", "included")


OUTC = DISP + """, oc AS (SELECT *, CASE WHEN locked THEN 'locked' WHEN engine = 'mai' THEN 'mai' WHEN note LIKE 'silent blocked%' THEN 'silent-blocked' WHEN note LIKE 'error after retry%' THEN 'failed' WHEN silent AND included THEN 'silent-scored' WHEN silent THEN 'silent-empty' ELSE 'merged' END AS outcome FROM d2)"""


@query("WITH " + OUTC + " SELECT file_id, chunk, outcome FROM oc")
def q_outcome(spark, d):
    return M.outcome(M.disposition(chunks(spark, d))).select("file_id", "chunk", "outcome")


@query("WITH " + DISP + " SELECT CASE WHEN locked THEN 'locked' WHEN included THEN 'included' WHEN note LIKE 'error after retry%' THEN 'failed' ELSE 'other' END AS status, count(*) AS n FROM d2 GROUP BY 1")
def q_manifest_status(spark, d):
    c = M.disposition(chunks(spark, d))
    s = F.when(F.col("locked"), "locked").when(F.col("included"), "included").when(F.startswith("note", F.lit("error after retry")), "failed").otherwise("other")
    return c.groupBy(s.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("WITH " + DISP + """ SELECT file_id, count(*) AS chunks, count(*) FILTER (included) AS included, CAST(coalesce(sum(words) FILTER (included AND NOT silent), 0) AS BIGINT) AS words, coalesce(string_agg(CAST(chunk AS VARCHAR), ',' ORDER BY chunk) FILTER (locked), '') AS locked_chunks, coalesce(string_agg(CAST(chunk AS VARCHAR), ',' ORDER BY chunk) FILTER (note LIKE 'error after retry%'), '') AS failed_chunks FROM d2 GROUP BY file_id""")
def q_run_summary(spark, d):
    return M.run_summary(M.disposition(chunks(spark, d)))


@query("WITH " + DISP + " SELECT file_id, chunk FROM d2 WHERE locked UNION SELECT file_id, chunk FROM d2 WHERE note LIKE 'error after retry%'")
def q_bad_chunks(spark, d):
    c = M.disposition(chunks(spark, d))
    return c.where("locked").select("file_id", "chunk").union(c.where("note LIKE 'error after retry%'").select("file_id", "chunk")).distinct()


@query("WITH " + OUTC + ", ag AS (SELECT file_id, chunk, attempts FROM ca) SELECT oc.file_id, oc.chunk, outcome, attempts, CASE WHEN outcome = 'merged' THEN words END AS aligned FROM oc LEFT JOIN ag ON ag.file_id = oc.file_id AND ag.chunk = oc.chunk")
def q_trace_build(spark, d):
    o = M.outcome(M.disposition(chunks(spark, d)))
    a = M.chunk_attempts(attempts(spark, d)).select("file_id", "chunk", "attempts")
    return o.join(a, ["file_id", "chunk"], "left").select("file_id", "chunk", "outcome", "attempts", F.when(F.col("outcome") == "merged", F.col("words")).alias("aligned"))


def trace_texts(spark, d):
    """(file_id, value): a trace for each user, whose chunks are events; usage has other fields for each kind, and some traces are cut off."""
    e = src(spark, d, "events")
    named = lambda name, kind, value: F.when(F.col("event_type") == kind, F.concat(F.lit(f'"{name}":'), value.cast("string")))
    n = F.col("event_id") % 97
    usage = F.concat_ws(",", named("prompt_tokens", "view", n), named("completion_tokens", "click", n * 2), named("cost", "purchase", n / 8), named("tier", "signup", F.lit('"x"')), F.concat(F.lit('"calls":'), (n % 3).cast("string")))
    chunk = F.concat(F.lit('{"idx":'), F.col("event_id").cast("string"), F.lit(',"outcome":"merged","attempts":[{"n":1,"usage":{'), usage, F.lit("}}]}"))
    body = F.array_join(F.sort_array(F.collect_list(chunk)), ",")
    value = F.concat(F.lit('{"version":1,"meta":{"model":"m'), (F.col("user_id") % 3).cast("string"), F.lit('","duration_sec":2.5},"chunks":['), body, F.when(F.col("user_id") % 7 == 0, "").otherwise("]}"))
    return e.groupBy("user_id").agg(value.alias("value")).select(F.col("user_id").alias("file_id"), "value")


@query("""WITH e AS (SELECT user_id % 3 AS m, event_type AS t, event_id % 97 AS n FROM events WHERE user_id % 7 <> 0),
u AS (SELECT m, 'calls' AS name, (n % 3)::DOUBLE AS v FROM e UNION ALL SELECT m, 'prompt_tokens', n FROM e WHERE t = 'view' UNION ALL SELECT m, 'completion_tokens', n * 2 FROM e WHERE t = 'click' UNION ALL SELECT m, 'cost', n / 8 FROM e WHERE t = 'purchase' UNION ALL SELECT m, 'tier', NULL FROM e WHERE t = 'signup')
SELECT 'm' || m AS model, name, count(*) AS tries, sum(v) AS amount FROM u GROUP BY ALL""")
def q_trace_usage(spark, d):
    """What each model's traces say they used, by name, whatever names there are."""
    t = TR.header(TR.parsed(trace_texts(spark, d), "value")).select("trace", F.col("model").alias("of"))
    return TR.usage_entries(TR.attempts(t)).groupBy(F.col("of").alias("model"), "name").agg(F.count(F.lit(1)).alias("tries"), F.sum("amount").alias("amount"))


@query("""SELECT user_id AS file_id, CASE WHEN user_id % 7 <> 0 THEN 1 END AS version, CASE WHEN user_id % 7 <> 0 THEN 'm' || user_id % 3 END AS model, CASE WHEN user_id % 7 <> 0 THEN 2500 END AS dur_ms, CASE WHEN user_id % 7 <> 0 THEN count(*) ELSE 0 END AS chunks, CASE WHEN user_id % 7 <> 0 THEN max(event_id) END AS last_idx FROM events GROUP BY user_id""")
def q_trace_header(spark, d):
    """The run's fields of every trace; a trace that is cut off is there with nulls."""
    t = TR.header(TR.parsed(trace_texts(spark, d), "value")).select("file_id", "trace", "version", "model", F.rint(F.col("duration_sec") * 1000).cast("long").alias("dur_ms"))
    c = TR.chunks(t.select("file_id", "trace")).groupBy("file_id").agg(F.count("idx").alias("chunks"), F.max("idx").alias("last_idx"))
    return t.drop("trace").join(c, "file_id", "left").select("file_id", "version", "model", "dur_ms", F.coalesce("chunks", F.lit(0)).alias("chunks"), "last_idx")


@query("WITH " + ATTEMPTS + " SELECT event_id, CAST(round_even(CASE WHEN a > w THEN least(120000.0, a) ELSE w END, 0) AS BIGINT) AS wait_ms FROM (SELECT event_id, least(120000.0::DOUBLE, 8000 * power(2.0, n - 1)) AS w, CASE WHEN http IN ('429', '503') THEN TRY_CAST(trim(ra) AS DOUBLE) * 1000 END AS a FROM (SELECT event_id, n, CASE WHEN event_id % 3 = 0 THEN '429' WHEN event_id % 3 = 1 THEN '503' ELSE '500' END AS http, CASE WHEN event_id % 7 = 0 THEN 'Wed, 21 Oct 2015 07:28:00 GMT' ELSE ' ' || event_id % 200 END AS ra FROM tries))")
def q_retry_wait(spark, d):
    e = F.col("event_id")
    http = F.when(e % 3 == 0, "429").when(e % 3 == 1, "503").otherwise("500")
    after = F.when(e % 7 == 0, "Wed, 21 Oct 2015 07:28:00 GMT").otherwise(F.concat(F.lit(" "), (e % 200).cast("string")))
    return attempts(spark, d).select("event_id", M.retry_wait_ms(F.col("n"), 8000, http, after).alias("wait_ms"))


KIND = "CASE event_id % 7 WHEN 0 THEN '429' WHEN 1 THEN '500' WHEN 2 THEN '503' WHEN 3 THEN 'timeout' WHEN 4 THEN 'not_stop' WHEN 5 THEN 'recitation' ELSE 'unknown' END"


@query("WITH " + ATTEMPTS + f", k AS (SELECT event_id, n, {KIND} AS kind FROM tries) SELECT event_id, CASE WHEN kind = '429' THEN 60 * n WHEN kind IN ('500', '503') THEN 10 * n WHEN kind = 'timeout' THEN 15 * n WHEN kind = 'not_stop' THEN 5 * n WHEN kind = 'recitation' THEN NULL ELSE 0 END AS wait_sec FROM k")
def q_vertex_wait(spark, d):
    return attempts(spark, d).select("event_id", M.batch_wait_sec(F.expr(KIND), F.col("n")).cast("long").alias("wait_sec"))


@query("WITH " + ATTEMPTS + ", c AS (SELECT file_id, chunk, CAST(sum(CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 1000 END) AS BIGINT) AS micro FROM tries GROUP BY file_id, chunk) SELECT file_id, CAST(sum(nullif(micro, 0)) AS BIGINT) AS micro, count(nullif(micro, 0)) AS known FROM c GROUP BY file_id")
def q_mai_cost(spark, d):
    """Known costs in millionths; null if none is known, and zero counts as unknown."""
    cost = F.when(F.col("event_id") % 3 != 0, F.col("event_id") % 1000)
    c = attempts(spark, d).groupBy("file_id", "chunk").agg(F.nullif(F.sum(cost), F.lit(0)).alias("micro"))
    return c.groupBy("file_id").agg(F.sum("micro").alias("micro"), F.count("micro").alias("known"))


@query("WITH " + OUT + f""", second AS (SELECT file_id, chunk, text, speech_ms, {NW} AS nw FROM tries WHERE n = 1 AND event_id % 2 = 0), f AS (SELECT a.file_id, a.chunk, CASE WHEN s.file_id IS NULL THEN 'no key' WHEN s.speech_ms >= 30000 AND s.nw = 0 THEN 'empty despite speech present' WHEN s.speech_ms >= 30000 AND s.nw * 60000 < 60 * s.speech_ms THEN 'low density' ELSE 'ok' END AS result FROM ca a LEFT JOIN second s ON s.file_id = a.file_id AND s.chunk = a.chunk WHERE a.blocked) SELECT * FROM f""")
def q_mai_fallback(spark, d):
    """What a second engine makes of blocked chunks; its texts are held to the same density rule."""
    t = attempts(spark, d)
    blocked = M.chunk_attempts(t).where("blocked").select("file_id", "chunk")
    second = t.where("n = 1 AND event_id % 2 = 0").select("file_id", "chunk", M.density_reason(F.col("text"), F.col("speech_ms")).alias("why"), F.lit(True).alias("there"))
    why = F.when(F.col("there").isNull(), "no key").when(F.startswith("why", F.lit("low")), "low density").otherwise(F.coalesce("why", F.lit("ok")))
    return blocked.join(second, ["file_id", "chunk"], "left").select("file_id", "chunk", why.alias("result"))


@query("SELECT conv_id, string_agg(trim(text, ' ' || chr(10)), chr(10) ORDER BY turn) AS transcript FROM conversations WHERE role <> 'system' GROUP BY conv_id")
def q_raw_transcript(spark, d):
    """Texts of included chunks (here all but system turns) in plan order."""
    c = src(spark, d, "conversations").where("role <> 'system'").select("conv_id", "turn", F.expr("trim(BOTH ' \\n' FROM text)").alias("text"))
    rows = F.array_sort(F.collect_list(F.struct("turn", "text")))
    return c.groupBy("conv_id").agg(F.array_join(F.transform(rows, lambda x: x["text"]), "\n").alias("transcript"))


def job_requests(spark, d):
    """(event_id, backend, output, has_gpu): what each event asks for."""
    e = src(spark, d, "events")
    backend = F.when(F.col("event_type").isin("view", "click"), "router").when(F.col("event_type") == "purchase", "mai").otherwise("vertex")
    return e.select("event_id", backend.alias("backend"), F.when(F.col("event_id") % 2 == 0, "srt").otherwise("txt").alias("output"), (F.col("user_id") % 3 == 0).alias("has_gpu"))


REQUESTS = "r AS (SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 'router' WHEN event_type = 'purchase' THEN 'mai' ELSE 'vertex' END AS backend, CASE WHEN event_id % 2 = 0 THEN 'srt' ELSE 'txt' END AS output, user_id % 3 = 0 AS has_gpu FROM events)"


@query("WITH " + REQUESTS + " SELECT *, output = 'txt' OR backend = 'mai' OR has_gpu AS allowed FROM r")
def q_output_gate(spark, d):
    return job_requests(spark, d).withColumn("allowed", M.output_allowed(F.col("backend"), F.col("output"), F.col("has_gpu")))


@query("SELECT event_id, CASE WHEN s BETWEEN 200 AND 299 THEN 'ok' WHEN s = 401 THEN 'bad key' WHEN s = 403 AND event_id % 2 = 0 THEN 'ok' WHEN s = 0 THEN 'unreachable' ELSE 'unexpected' END AS class FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 0 WHEN 1 THEN 204 WHEN 2 THEN 401 WHEN 3 THEN 403 ELSE 500 END AS s FROM events)")
def q_probe_class(spark, d):
    e = src(spark, d, "events").select("event_id", F.expr("CASE event_id % 5 WHEN 0 THEN 0 WHEN 1 THEN 204 WHEN 2 THEN 401 WHEN 3 THEN 403 ELSE 500 END").alias("s"))
    return e.select("event_id", M.probe_class(F.when(F.col("event_id") % 2 == 0, "router").otherwise("mai"), F.col("s")).alias("class"))


@query("WITH " + REQUESTS + " SELECT event_id, CASE WHEN backend = 'vertex' THEN CASE WHEN output = 'srt' THEN 'stage>transcribe>align' ELSE 'stage>transcribe' END WHEN output = 'srt' THEN 'transcribe>build srt' ELSE 'transcribe' END AS steps FROM r")
def q_step_chain(spark, d):
    return job_requests(spark, d).select("event_id", M.step_chain(F.col("backend"), F.col("output")).alias("steps"))


STAGE = "CASE WHEN contains(line, '[1/4]') THEN 'prepare' WHEN contains(line, '[2/4]') THEN 'plan' WHEN contains(line, '[3/4]') THEN 'transcribe' WHEN contains(line, '[4/4]') THEN 'assemble' END"


@query("WITH " + JOBLOG + f" SELECT job, ord, {STAGE} AS stage FROM joblog")
def q_log_stage(spark, d):
    return job_log(spark, d).select("job", "ord", M.log_stage(F.col("line")).alias("stage"))


@query("WITH " + JOBLOG + f", s AS (SELECT job, ord, {STAGE} AS stage FROM joblog) SELECT job, ord, last_value(stage IGNORE NULLS) OVER (PARTITION BY job ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stage FROM s")
def q_job_stage(spark, d):
    return M.job_stages(job_log(spark, d))


@query("SELECT user_id AS job, max(ts) AS created FROM events GROUP BY user_id ORDER BY created DESC, job LIMIT 10")
def q_jobs_recent(spark, d):
    return src(spark, d, "events").groupBy(F.col("user_id").alias("job")).agg(F.max("ts").alias("created")).orderBy(F.desc("created"), "job").limit(10)


@query("WITH x AS (SELECT user_id AS job, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ord, CAST(round(value * 100) AS BIGINT) AS took, event_type <> 'error' AS ok FROM events), y AS (SELECT job, ord, CAST(sum(ok::INT) OVER w AS BIGINT) AS good, CAST(sum(took) OVER w AS BIGINT) AS elapsed_ms, count(*) OVER (PARTITION BY job) - ord AS l FROM x WINDOW w AS (PARTITION BY job ORDER BY ord)) SELECT job, ord, good, ord - good AS bad, elapsed_ms, CAST(l * elapsed_ms // ord AS BIGINT) AS eta_ms FROM y")
def q_progress_eta(spark, d):
    e = src(spark, d, "events")
    o = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long")
    return M.progress(e.select(F.col("user_id").alias("job"), o.alias("ord"), F.round(F.col("value") * 100).cast("long").alias("took_ms"), (F.col("event_type") != "error").alias("ok")))


@query("SELECT conv_id, string_agg(text, '' ORDER BY turn) AS content, arg_max(role, turn) AS model FROM conversations WHERE turn % 5 <> 4 GROUP BY conv_id")
def q_sse_fold(spark, d):
    """Streamed replies, one event a turn; every fifth event is broken and is skipped."""
    line = F.when(F.col("turn") % 5 == 4, F.lit("data: {broken")).otherwise(F.concat(F.lit("data: "), F.to_json(F.struct(F.col("role").alias("model"), F.array(F.struct(F.struct(F.col("text").alias("content")).alias("delta"))).alias("choices")))))
    events = src(spark, d, "conversations").select(F.col("conv_id").alias("file_id"), F.col("turn").alias("ord"), line.alias("line"))
    return R.sse_replies(events).select(F.col("file_id").alias("conv_id"), "content", "model").where("model IS NOT NULL")


@query("""SELECT page_id, '' AS content, 'not an event stream: ' || left(html, 300) AS error FROM pages WHERE trim(html, ' ' || chr(9) || chr(10) || chr(13)) <> ''""")
def q_sse_body(spark, d):
    """Replies that are web pages in place of event streams."""
    lines = src(spark, d, "pages").select(F.col("page_id").alias("file_id"), F.posexplode(F.split("html", "\n")).alias("ord", "line"))
    return R.sse_replies(lines).select(F.col("file_id").alias("page_id"), "content", F.element_at("errors", 1).alias("error")).where("error IS NOT NULL")


@query("SELECT user_id, arg_max(CAST(event_id % 100 AS VARCHAR), event_id) AS retry_after FROM events WHERE event_type = 'error' GROUP BY user_id")
def q_last_header(spark, d):
    e = src(spark, d, "events")
    line = F.when(F.col("event_type") == "error", F.concat(F.lit("Retry-AFTER:  "), (F.col("event_id") % 100).cast("string"))).otherwise(F.concat(F.lit("x-id: "), F.col("event_id").cast("string")))
    h = R.last_header(e.select(F.col("user_id").alias("file_id"), F.col("event_id").alias("ord"), line.alias("line")), "retry-after")
    return h.select(F.col("file_id").alias("user_id"), F.col("value").alias("retry_after"))


ENV = "env AS (SELECT event_id AS ord, 'KEY_' || user_id % 50 AS k, CAST(event_id AS VARCHAR) || '=x' AS v FROM events WHERE event_type <> 'view')"


def env_lines(spark, d):
    e = src(spark, d, "events")
    line = F.when(F.col("event_type") == "view", "# comment").otherwise(F.concat(F.lit("KEY_"), (F.col("user_id") % 50).cast("string"), F.lit("="), F.col("event_id").cast("string"), F.lit("=x")))
    return e.select(F.col("event_id").alias("ord"), line.alias("line"))


@query("WITH " + ENV + " SELECT k, arg_max(v, ord) AS v FROM env GROUP BY k")
def q_kv_last_wins(spark, d):
    return R.env_pairs(env_lines(spark, d))


@query("WITH " + ENV + ", o AS (SELECT k, arg_max(v, ord) AS v FROM env GROUP BY k), n AS (SELECT 'KEY_' || nationkey AS k, CASE WHEN nationkey % 2 = 0 THEN '' ELSE 'new' END AS v FROM (SELECT n_nationkey * 3 AS nationkey FROM nation)) SELECT coalesce(o.k, n.k) AS k, coalesce(nullif(n.v, ''), o.v, '') AS v FROM o FULL JOIN n ON o.k = n.k")
def q_kv_upsert(spark, d):
    n = src(spark, d, "nation").select((F.col("n_nationkey") * 3).alias("x"))
    new = n.select(F.concat(F.lit("KEY_"), F.col("x").cast("string")).alias("k"), F.when(F.col("x") % 2 == 0, "").otherwise("new").alias("v"))
    return M.upsert(R.env_pairs(env_lines(spark, d)), new, "k", "v")


@query("SELECT event_id, CASE WHEN event_id % 4 IN (0, 1) THEN NULL ELSE value END AS value FROM events")
def q_nan_to_null(spark, d):
    bad = F.when(F.col("event_id") % 4 == 0, F.lit(float("nan"))).when(F.col("event_id") % 4 == 1, F.lit(float("inf"))).otherwise(F.col("value"))
    return S.finite(src(spark, d, "events").select("event_id", bad.alias("value")))


@query("""SELECT event_id, CASE WHEN event_type = 'error' THEN '502' WHEN event_type = 'signup' THEN '403' ELSE '200' END AS http, CASE WHEN event_type IN ('view', 'click') THEN repeat('w ', CAST(floor(value) AS BIGINT) % 7 + 1)[1:-2] ELSE '' END AS text,
CASE WHEN event_type IN ('view', 'click') THEN event_id % 7 / 8.0::DOUBLE END AS cost, CASE WHEN event_type = 'error' THEN 'error: body is not JSON: <html>' || event_id || '; http=502; empty despite speech present' WHEN event_type = 'signup' THEN 'error: {"code":403,"message":"' || repeat('m', 57) || '; http=403; empty despite speech present' WHEN event_type = 'purchase' THEN 'empty despite speech present' ELSE '' END AS reasons FROM events""")
def q_mai_replies(spark, d):
    """Replies of the word-timing service, parsed, and why each must be tried again."""
    kind, n = F.col("event_type"), F.floor("value").cast("int") % 7 + 1
    good = F.to_json(F.struct(F.concat(F.lit(" "), F.repeat(F.lit("w "), n)).alias("text"), F.struct((F.col("event_id") % 7 / 8.0).alias("cost")).alias("usage")))
    body = F.when(kind == "error", F.concat(F.lit("<html>"), F.col("event_id").cast("string"))).when(kind == "signup", F.concat(F.lit('{"error": {"code": 403, "message": "'), F.repeat(F.lit("m"), F.lit(400)), F.lit('"}}')))
    body = body.when(kind == "purchase", '{"text": ""}').otherwise(good)
    code = F.when(kind == "error", "502").when(kind == "signup", "403").otherwise("200")
    r = R.mai_replies(src(spark, d, "events").select(F.col("event_id").alias("file_id"), F.concat(body, F.lit("|HTTP"), code).alias("reply")))
    return r.select(F.col("file_id").alias("event_id"), "http", "text", "cost", M.mai_reasons(F.col("error"), F.col("http"), F.col("text"), F.lit(True)).alias("reasons"))


@query("WITH " + ENV + """, l AS (SELECT event_id AS ord, CASE WHEN event_type = 'view' THEN '# comment' ELSE 'KEY_' || user_id % 50 || '=' || event_id || '=x' END AS line, CASE WHEN event_type <> 'view' THEN 'KEY_' || user_id % 50 END AS k FROM events),
n AS (SELECT 'KEY_' || n_nationkey * 3 AS k, 'v' || n_nationkey AS v FROM nation)
SELECT ord, CASE WHEN v IS NULL THEN line ELSE l.k || '=' || v END AS line FROM l LEFT JOIN n ON n.k = l.k
UNION ALL SELECT (SELECT max(ord) FROM l) + row_number() OVER (ORDER BY k), k || '=' || v FROM n WHERE k NOT IN (SELECT k FROM l WHERE k IS NOT NULL)""")
def q_env_merge(spark, d):
    """A settings file with new values in place, comments kept, unseen keys at the end."""
    n = src(spark, d, "nation").select(F.concat(F.lit("KEY_"), (F.col("n_nationkey") * 3).cast("string")).alias("k"), F.concat(F.lit("v"), F.col("n_nationkey").cast("string")).alias("v"))
    return M.env_merge(env_lines(spark, d), n)
