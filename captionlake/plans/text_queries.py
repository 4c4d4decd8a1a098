"""Queries on texts and words."""

from __future__ import annotations

from pyspark.sql import functions as F

from captionlake.functions import text as T
from captionlake.operators import words as W
from captionlake.sources import formats
from captionlake.sources import sinks as S
from captionlake.sources.shared import scratch

from .derive import WORDS, titles, titles_sql, token_rows, words
from .derive import table as src

Q, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query(r"SELECT doc_id AS file_id, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS w FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \n\t\r\x0B\f]+'), lambda x: x <> '') AS t FROM documents)")
def q_tokenize(spark, d):
    return token_rows(src(spark, d, "documents"))


SRT_SQL = r"""
ln AS (SELECT doc_id AS file_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
srt AS (SELECT file_id, chr(65279) || string_agg(i || chr(13) || chr(10) || '00:00:00,000 --> 00:00:01,000' || chr(13) || chr(10) || line, chr(13) || chr(10) || chr(13) || chr(10) ORDER BY i) AS srt FROM ln GROUP BY file_id),
bl AS (SELECT file_id, unnest(b) AS block, generate_subscripts(b, 1) AS k FROM (SELECT file_id, regexp_split_to_array(ltrim(replace(replace(srt, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(65279)), '\n\s*\n') AS b FROM srt)),
li AS (SELECT file_id, k, list_filter(list_transform(string_split(block, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS lines FROM bl),
cu AS (SELECT file_id, k, array_to_string(lines[list_position(list_transform(lines, lambda x: contains(x, '-->')), true) + 1:], ' ') AS text FROM li WHERE list_position(list_transform(lines, lambda x: contains(x, '-->')), true) > 0),
cues AS (SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY k) AS n, text FROM cu WHERE text <> '')"""


def srt_files(spark, d):
    """(file_id, srt): every line of a document as a cue, with CRLF and a byte order mark."""
    block = F.expr("transform(split(text, '\\n'), (x, i) -> concat(i + 1, '\\r\\n00:00:00,000 --> 00:00:01,000\\r\\n', x))")
    return src(spark, d, "documents").select(F.col("doc_id").alias("file_id"), F.concat(F.lit("﻿"), F.array_join(block, "\r\n\r\n")).alias("srt"))


@query("WITH " + SRT_SQL + " SELECT file_id, n, text FROM cues")
def q_srt_parse(spark, d):
    return srt_files(spark, d).select("file_id", F.posexplode(T.srt_cues("srt")).alias("n", "text")).withColumn("n", (F.col("n") + 1).cast("long"))


@query("WITH " + SRT_SQL + " SELECT file_id, n, text FROM cues")
def q_srt_round_trip(spark, d):
    """Every line of a document as a cue, written to a subtitle file for each document and read back from the files."""
    lines = src(spark, d, "documents").select(F.col("doc_id").alias("file_id"), F.posexplode(F.split("text", "\n")).alias("n", "text")).where(F.trim("text") != "")
    folder = scratch(spark, "srt")
    S.write_srt(lines.select("file_id", "n", (F.col("n") * 1000).alias("start_ms"), (F.col("n") * 1000 + 900).alias("end_ms"), "text"), folder)
    read = formats.register(spark).read.format("srt").load(folder)
    return read.select(F.regexp_extract("path", r"([^/]*)\.srt$", 1).cast("long").alias("file_id"), "n", "text")


@query("WITH " + SRT_SQL + " SELECT file_id, string_agg(text, chr(10) ORDER BY n) AS transcript FROM cues GROUP BY file_id")
def q_srt_to_txt(spark, d):
    return srt_files(spark, d).select("file_id", F.array_join(T.srt_cues("srt"), "\n").alias("transcript")).where("transcript <> ''")


@query("SELECT doc_id, CAST(length(replace(text, chr(10), '')) AS BIGINT) AS chars FROM documents")
def q_char_count(spark, d):
    return src(spark, d, "documents").select("doc_id", T.char_count("text").alias("chars"))


@query("WITH " + titles_sql(T.MARKED, T.PLAIN) + " SELECT ord, key FROM tl")
def q_normalize_key(spark, d):
    return titles(spark, d)[0].select("ord", T.normalize_key("title").alias("key"))


@query("WITH " + WORDS + f" SELECT file_id, pos, regexp_replace(translate(lower(w), '{T.MARKED}', '{T.PLAIN}'), '[^a-z'']', '', 'g') AS word FROM words")
def q_normalize_word(spark, d):
    return words(spark, d).select("file_id", "pos", T.normalize_word("w").alias("word"))


@query("WITH " + WORDS + f", k AS (SELECT file_id, regexp_replace(translate(lower(w), '{T.MARKED}', '{T.PLAIN}'), '[^a-z'']', '', 'g') <> '' AS ok FROM words) SELECT file_id, bool_or(ok) AS alignable FROM k GROUP BY file_id")
def q_alignable(spark, d):
    return words(spark, d).groupBy("file_id").agg(F.bool_or(T.normalize_word("w") != "").alias("alignable"))


@query(r"SELECT doc_id, CAST(len(x) AS BIGINT) AS n, array_to_string(x, ' ') AS words FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS x FROM documents)")
def q_diff_words(spark, d):
    x = src(spark, d, "documents").select("doc_id", T.diff_words("text").alias("x"))
    return x.select("doc_id", F.size("x").cast("long").alias("n"), F.array_join("x", " ").alias("words"))


@query("WITH " + WORDS + r" SELECT file_id, pos, regexp_replace(lower(w), '[^\p{L}\p{N}_]', '', 'g') AS seam, regexp_replace(lower(w), '[^0-9a-zà-ỹ'']', '', 'g') AS html FROM words")
def q_word_keys(spark, d):
    return words(spark, d).select("file_id", "pos", T.seam_word("w").alias("seam"), T.html_key("w").alias("html"))


@query("SELECT doc_id, sha256(text) AS sha FROM documents")
def q_sha256(spark, d):
    return src(spark, d, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))


TIMES = """t AS (SELECT event_id, CAST(round(value * 100000) AS BIGINT) * (event_id % 7) - 500 AS ms FROM events)"""
TWO = "CASE WHEN {0} < 10 THEN '0' ELSE '' END || CAST({0} AS VARCHAR)"


def _two(x):
    return "(" + TWO.format(f"({x})") + ")"


@query(
    f"WITH {TIMES} SELECT event_id, {_two('greatest(ms, 0) // 3600000')} || ':' || {_two('greatest(ms, 0) // 60000 % 60')} || ':' || {_two('greatest(ms, 0) // 1000 % 60')} || ',' || lpad(CAST(greatest(ms, 0) % 1000 AS VARCHAR), 3, '0') AS srt FROM t"
)
def q_fmt_ts(spark, d):
    return times(spark, d).select("event_id", T.srt_time("ms").alias("srt"))


def times(spark, d):
    return src(spark, d, "events").select("event_id", (F.round(F.col("value") * 100000).cast("long") * (F.col("event_id") % 7) - 500).alias("ms"))


@query(
    f"WITH {TIMES}, s AS (SELECT event_id, ms // 1000 AS s FROM t WHERE ms >= 0) SELECT event_id, {_two('s // 60')} || ':' || {_two('s % 60')} AS ms, {_two('s // 3600')} || ':' || {_two('s // 60 % 60')} || ':' || {_two('s % 60')} AS hms, "
    f"CASE WHEN s >= 3600 THEN CAST(s // 3600 AS VARCHAR) || ':' || {_two('s // 60 % 60')} || ':' || {_two('s % 60')} ELSE CAST(s // 60 AS VARCHAR) || ':' || {_two('s % 60')} END AS dur FROM s"
)
def q_durations(spark, d):
    t = times(spark, d).where("ms >= 0")
    return t.select("event_id", T.min_sec("ms").alias("ms"), T.hour_min_sec("ms").alias("hms"), T.duration("ms").alias("dur"))


@query(r"SELECT doc_id, trim(regexp_replace(regexp_replace(trim('```text' || chr(10) || text || chr(10) || '```'), '^```[a-zA-Z]*[ \t]*\n?', ''), '\n?[ \t]*```$', '')) AS body FROM documents")
def q_strip_fence(spark, d):
    return src(spark, d, "documents").select("doc_id", T.strip_fence(F.concat(F.lit("```text\n"), F.col("text"), F.lit("\n```"))).alias("body"))


@query("SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS html FROM pages")
def q_html_escape(spark, d):
    return src(spark, d, "pages").select("page_id", T.html_escape("html").alias("html"))


@query(r"SELECT doc_id, substr(trim(regexp_replace(text, '\s+', ' ', 'g')), 1, 200) AS line FROM documents")
def q_one_line(spark, d):
    return src(spark, d, "documents").select("doc_id", T.one_line("text").alias("line"))


@query(r"SELECT page_id, regexp_replace(regexp_replace(url, '^.*[/\\]', ''), '(.)\.[^.]*$', '\1') || '.srt' AS out FROM pages")
def q_out_paths(spark, d):
    return src(spark, d, "pages").select("page_id", F.concat(T.file_stem("url"), F.lit(".srt")).alias("out"))


WRAP = r"""
ct AS (SELECT conv_id, turn, string_split(replace(text, chr(10), ' '), ' ')[1:14] AS w FROM conversations),
op AS (SELECT conv_id, turn, w, unnest(range(1, greatest(len(w), 2))) AS k FROM ct),
o2 AS (SELECT *, array_to_string(w[1:k], ' ') AS a, array_to_string(w[k + 1:], ' ') AS b FROM op),
o3 AS (SELECT *, CASE WHEN length(a) > 42 OR length(b) > 42 THEN 1 ELSE 0 END AS bad, abs(length(a) - length(b)) AS gap, CASE WHEN length(b) < length(a) THEN 1 ELSE 0 END AS top, CASE WHEN a LIKE '%,' THEN 0 ELSE 1 END AS nc FROM o2),
o4 AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY bad, gap, top, nc, k) AS rn FROM o3)"""


@query("WITH " + WRAP + " SELECT conv_id, turn, CASE WHEN length(array_to_string(w, ' ')) > 42 AND len(w) >= 2 THEN a || chr(10) || b ELSE array_to_string(w, ' ') END AS text FROM o4 WHERE rn = 1")
def q_wrap_two_lines(spark, d):
    c = src(spark, d, "conversations").select("conv_id", "turn", F.array_join(F.slice(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " "), 1, 14), " ").alias("text"))
    return c.select("conv_id", "turn", T.wrap_two_lines("text").alias("text"))


FILL = WORDS + """,
f1 AS (SELECT *, start_ms IS NOT NULL AS timed, coalesce(last_value(end_ms IGNORE NULLS) OVER (PARTITION BY file_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p,
  first_value(start_ms IGNORE NULLS) OVER (PARTITION BY file_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS x,
  max(CASE WHEN start_ms IS NOT NULL THEN pos END) OVER (PARTITION BY file_id ORDER BY pos) AS lastpos FROM words),
f2 AS (SELECT *, pos - coalesce(lastpos, -1) AS r FROM f1),
f3 AS (SELECT *, CASE WHEN x IS NULL THEN p + 300 * (r - 1) WHEN r = 1 THEN p ELSE greatest(p + 50, x) + 50 * (r - 2) END AS us, CASE WHEN x IS NULL THEN p + 300 * r ELSE greatest(p + 50, x) + 50 * (r - 1) END AS ue FROM f2),
filled AS (SELECT file_id, pos, w, CAST(CASE WHEN timed THEN start_ms ELSE us END AS BIGINT) AS start_ms, CAST(CASE WHEN timed THEN end_ms ELSE ue END AS BIGINT) AS end_ms, score_m FROM f3)"""
SEGS = FILL + """,
s1 AS (SELECT *, CASE WHEN right(lag(w) OVER o, 1) IN ('.', '!', '?', ':', ';') OR start_ms - lag(end_ms) OVER o >= 2000 THEN 1 ELSE 0 END AS new FROM filled WINDOW o AS (PARTITION BY file_id ORDER BY pos)),
segs AS (SELECT *, CAST(sum(new) OVER (PARTITION BY file_id ORDER BY pos) AS BIGINT) AS seg FROM s1)"""
SIMPLE = SEGS + """,
cues AS (SELECT file_id, seg + 1 AS n, string_agg(w, ' ' ORDER BY pos) AS text, arg_min(start_ms, pos) AS start_ms, arg_max(end_ms, pos) AS end_ms FROM segs GROUP BY file_id, seg)"""


@query("WITH " + FILL + " SELECT file_id, pos, w, start_ms, end_ms, score_m FROM filled")
def q_fill_times(spark, d):
    return W.fill_times(words(spark, d))


@query("WITH " + SEGS + " SELECT file_id, pos, seg FROM segs")
def q_segments(spark, d):
    return W.segments(W.fill_times(words(spark, d))).select("file_id", "pos", "seg")


@query("WITH " + SIMPLE + " SELECT * FROM cues")
def q_simple_cues(spark, d):
    return simple(spark, d)


def simple(spark, d):
    c = W.simple_cues(W.segments(W.fill_times(words(spark, d))))
    return c.select("file_id", (F.col("seg") + 1).alias("n"), "text", "start_ms", "end_ms")


@query("WITH " + WORDS + """, e AS (SELECT *, min(CASE WHEN start_ms IS NOT NULL THEN pos END) OVER f AS fp, max(CASE WHEN start_ms IS NOT NULL THEN pos END) OVER f AS lp FROM words WINDOW f AS (PARTITION BY file_id)),
g AS (SELECT *, max(CASE WHEN pos = fp THEN start_ms END) OVER f AS fs, max(CASE WHEN pos = lp THEN end_ms END) OVER f AS le FROM e WINDOW f AS (PARTITION BY file_id))
SELECT file_id, pos, w, coalesce(start_ms, CASE WHEN pos < fp THEN fs WHEN pos > lp THEN le END) AS start_ms, coalesce(end_ms, CASE WHEN pos < fp THEN fs WHEN pos > lp THEN le END) AS end_ms, score_m FROM g""")
def q_pin_edges(spark, d):
    return W.pin_edges(words(spark, d))


@query("WITH " + WORDS + " SELECT file_id, count(*) AS words, count(start_ms) AS aligned, CAST(sum(CASE WHEN start_ms IS NOT NULL THEN score_m END) AS BIGINT) AS score_sum, count(CASE WHEN start_ms IS NOT NULL THEN score_m END) AS scored FROM words GROUP BY file_id")
def q_align_stats(spark, d):
    return W.align_stats(words(spark, d))


SENT = WORDS + """,
n1 AS (SELECT *, CASE WHEN right(lag(w) OVER (PARTITION BY file_id ORDER BY pos), 1) IN ('.', '!', '?', ';') THEN 1 ELSE 0 END AS new FROM words),
n2 AS (SELECT *, CAST(sum(new) OVER (PARTITION BY file_id ORDER BY pos) AS BIGINT) AS sent FROM n1),
sents AS (SELECT *, (row_number() OVER (PARTITION BY file_id, sent ORDER BY pos) - 1) // 40 AS piece FROM n2),
scored AS (SELECT file_id, sent, piece, string_agg(w, ' ' ORDER BY pos) AS text, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(start_ms) AS timed, CAST(coalesce(sum(CASE WHEN start_ms IS NOT NULL THEN coalesce(score_m, 0) END), 0) AS BIGINT) AS score_sum FROM sents GROUP BY file_id, sent, piece)"""


@query("WITH " + SENT + " SELECT file_id, pos, sent, piece FROM sents")
def q_sentences(spark, d):
    return W.sentences(words(spark, d)).select("file_id", "pos", "sent", "piece")


@query("WITH " + SENT + " SELECT *, timed > 0 AND 2 * score_sum >= 999 * timed AS kept FROM scored")
def q_silent_sentences(spark, d):
    return W.scored_sentences(words(spark, d))


@query("WITH " + SENT + " SELECT file_id, min(start_ms) AS first_ms, max(end_ms) AS last_ms FROM scored WHERE timed > 0 AND 2 * score_sum >= 999 * timed GROUP BY file_id")
def q_region_widen(spark, d):
    kept = W.scored_sentences(words(spark, d)).where("kept")
    return kept.groupBy("file_id").agg(F.min("start_ms").alias("first_ms"), F.max("end_ms").alias("last_ms"))


@query("WITH " + WORDS + """, c AS (SELECT *, pos // 50 AS chunk FROM words) SELECT file_id, pos, chunk, start_ms + 1000 * chunk AS start_ms, end_ms + 1000 * chunk AS end_ms FROM c""")
def q_global_words(spark, d):
    w = words(spark, d).withColumn("chunk", F.expr("pos div 50"))
    chunks = w.select("file_id", "chunk").distinct().withColumn("off_ms", F.col("chunk") * 1000)
    return W.shift(w, chunks).select("file_id", "pos", "chunk", "start_ms", "end_ms")


@query("WITH " + WORDS + """, l AS (SELECT file_id, pos, unnest(range(1, length(w) + 1)) AS k FROM words WHERE (file_id + pos) % 17 NOT IN (3, 4)), sp AS (SELECT file_id, pos, k, pos * 100 + 3 * k AS s, pos * 100 + 3 * k + 2 AS e, (k * 37 + pos) % 1000 AS score FROM l),
g AS (SELECT file_id, pos, arg_min(s, k) AS "start", arg_max(e, k) AS "end", CAST(sum(score) AS BIGINT) AS score_sum, count(*) AS n_spans FROM sp GROUP BY file_id, pos)
SELECT w.file_id, w.pos, w.w, g."start", g."end", g.score_sum, coalesce(n_spans, 0) AS n_spans FROM words w LEFT JOIN g USING (file_id, pos)""")
def q_assemble_words(spark, d):
    w = words(spark, d)
    k = F.explode(F.expr("sequence(1L, cast(length(w) AS bigint))"))
    letters = w.where("(file_id + pos) % 17 NOT IN (3, 4)").select("file_id", "pos", k.alias("k"))
    spans = letters.select("file_id", "pos", "k", (F.col("pos") * 100 + 3 * F.col("k")).alias("start"), (F.col("pos") * 100 + 3 * F.col("k") + 2).alias("end"), ((F.col("k") * 37 + F.col("pos")) % 1000).alias("score"))
    return W.assemble(w.select("file_id", "pos", "w"), spans)


@query("WITH " + WORDS + """, x AS (SELECT *, lead(pos) OVER (PARTITION BY file_id ORDER BY pos) IS NULL AS l FROM words)
SELECT file_id, 2 * pos + 1 AS slot, w AS token FROM x UNION ALL SELECT file_id, 2 * pos + 2, '*' FROM x WHERE l OR right(w, 1) IN ('.', '!', '?', ';', ':', ',') UNION ALL SELECT file_id, 0, '*' FROM x WHERE pos = 0""")
def q_star_sequence(spark, d):
    return W.star_sequence(words(spark, d))
