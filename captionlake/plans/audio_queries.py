"""Queries on speech segments, chunk plans, polarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from captionlake.operators import intervals as I
from captionlake.operators import planning as PL
from captionlake.operators import polarity as PO

from .derive import FRAMES, SPEECH, STEREO, audio, frames, speech, stereo

Q, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("WITH " + SPEECH + " SELECT * FROM speech")
def q_speech_segments(spark, d):
    return speech(spark, d)


@query("WITH " + SPEECH + " SELECT file_id, count(*) AS segments, CAST(sum(end_ms - start_ms) AS BIGINT) AS speech_ms, min(start_ms) AS first_ms, max(end_ms) AS last_ms FROM speech GROUP BY file_id")
def q_vad_summary(spark, d):
    return speech(spark, d).groupBy("file_id").agg(
        F.count(F.lit(1)).alias("segments"), F.sum(F.col("end_ms") - F.col("start_ms")).alias("speech_ms"), F.min("start_ms").alias("first_ms"), F.max("end_ms").alias("last_ms")
    )


#: Speech cut at multiples of ten minutes, so that the grid is met by key.
GRID = SPEECH + """,
gr AS (SELECT file_id, k, k * 600000 AS start_ms, (k + 1) * 600000 AS end_ms FROM (SELECT DISTINCT file_id FROM speech), (SELECT unnest(range(0, 72)) AS k)),
cut AS (SELECT file_id, start_ms, end_ms, unnest(range(start_ms // 600000, (end_ms - 1) // 600000 + 1)) AS k FROM speech WHERE end_ms > start_ms),
ov AS (SELECT file_id, k, CAST(sum(least((k + 1) * 600000, end_ms) - greatest(k * 600000, start_ms)) AS BIGINT) AS v FROM cut GROUP BY ALL)"""


def grid(spark, d):
    files = speech(spark, d).select("file_id").distinct().withColumn("k", F.explode(F.expr("sequence(0L, 71L)")))
    return files.select("file_id", "k", (F.col("k") * 600_000).alias("start_ms"), ((F.col("k") + 1) * 600_000).alias("end_ms"))


@query("WITH " + GRID + " SELECT gr.file_id, gr.k, gr.start_ms, gr.end_ms, coalesce(v, 0) AS overlap_ms FROM gr LEFT JOIN ov ON ov.file_id = gr.file_id AND ov.k = gr.k")
def q_speech_overlap(spark, d):
    return I.overlap_sum(grid(spark, d), speech(spark, d), ["file_id"], ["k"])


@query("WITH " + GRID + " SELECT gr.file_id, gr.k, coalesce(v, 0) >= 30000 OR 2 * coalesce(v, 0) >= 600000 AS has_speech FROM gr LEFT JOIN ov ON ov.file_id = gr.file_id AND ov.k = gr.k")
def q_chunk_speech(spark, d):
    o = q_speech_overlap(spark, d)
    return o.select("file_id", "k", I.has_speech(F.col("overlap_ms"), F.col("end_ms") - F.col("start_ms"), 30_000, 0.5).alias("has_speech"))


@query("WITH RECURSIVE " + SPEECH.strip() + """,
gp AS (SELECT file_id, end_ms AS s, lead(start_ms) OVER (PARTITION BY file_id ORDER BY seg) AS e FROM speech),
gaps AS (SELECT file_id, e - s AS size, s + e AS mid2 FROM gp WHERE e IS NOT NULL),
step(file_id, idx, start_ms, target2, last2, cut, gap, dur_ms) AS (
  SELECT file_id, 0::BIGINT, 0::BIGINT, 1200000::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, dur_ms::BIGINT FROM audio
  UNION ALL
  SELECT file_id, idx + 1, cut, m2 + 1200000, 2 * c, c, size, dur_ms FROM (
    SELECT *, 10 * (m2 // 20 + CASE WHEN m2 % 20 > 10 OR (m2 % 20 = 10 AND (m2 // 20) % 2 = 1) THEN 1 ELSE 0 END) AS c FROM (
      SELECT s.file_id, s.idx, s.cut, s.dur_ms, coalesce(max(g.size), 0)::BIGINT AS size, coalesce(arg_max(g.mid2, g.size * 1000000000000 + g.mid2), any_value(s.target2))::BIGINT AS m2
      FROM step s LEFT JOIN gaps g ON g.file_id = s.file_id AND abs(g.mid2 - s.target2) <= 180000 AND g.mid2 > s.last2 + 600000
      WHERE s.target2 < 2 * (s.dur_ms - 150000) GROUP BY s.file_id, s.idx, s.cut, s.dur_ms)))
SELECT file_id, idx, start_ms, cut AS end_ms, gap AS cut_gap_ms FROM step WHERE idx > 0
UNION ALL SELECT file_id, max(idx) + 1, arg_max(cut, idx), any_value(dur_ms), 0 FROM step GROUP BY file_id""")
def q_chunk_plan(spark, d):
    return PL.chunk_plan(speech(spark, d), audio(spark, d))


@query("""WITH f AS (SELECT doc_id, length(text) AS n FROM documents), c AS (SELECT *, n // 600 AS w, CASE WHEN n <= 0 THEN 0 WHEN n % 600 >= 150 THEN n // 600 + 1 ELSE greatest(n // 600, 1) END AS c FROM f), k AS (SELECT *, unnest(range(1, c + 1)) AS k FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, k, (k - 1) * 600 AS a, CAST(CASE WHEN k = c THEN n ELSE k * 600 END AS BIGINT) AS b FROM k""")
def q_chunk_bounds(spark, d):
    files = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.length("text").cast("long").alias("n"))
    return PL.chunk_bounds(files, "n", 600, 150)


RUNS = FRAMES + """,
bl AS (SELECT *, frame - row_number() OVER (PARTITION BY file_id ORDER BY frame) AS g FROM frames WHERE blank),
runs AS (SELECT file_id, min(frame) AS a, max(frame) + 1 AS b FROM bl GROUP BY file_id, g)"""


@query("WITH " + RUNS + " SELECT * FROM runs")
def q_runs(spark, d):
    return I.runs(frames(spark, d), ["file_id"], "frame", F.col("blank"))


@query("WITH " + RUNS + " SELECT * FROM runs WHERE b - a >= 2")
def q_blank_runs(spark, d):
    return q_runs(spark, d).where("b - a >= 2")


@query("WITH " + RUNS + """, fi AS (SELECT file_id, max(frame) + 1 AS total FROM frames GROUP BY file_id), pt AS (SELECT file_id, total, unnest(range(1, 5)) AS k FROM fi), p2 AS (SELECT *, CAST(round_even(total * k / 5, 0) AS BIGINT) AS t FROM pt),
ce AS (SELECT file_id, (a + b) // 2 AS c FROM runs WHERE b - a >= 2),
nr AS (SELECT p.file_id, p.k, coalesce(arg_min(c, abs(c - t) * 1000000 + c), any_value(t)) AS frame, any_value(total) AS total FROM p2 p LEFT JOIN ce ON ce.file_id = p.file_id GROUP BY p.file_id, p.k),
al AS (SELECT DISTINCT file_id, frame FROM nr WHERE frame > 0 AND frame < total UNION SELECT file_id, 0 FROM fi UNION SELECT file_id, total FROM fi)
SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY frame) - 1 AS k, frame, CAST(round_even(1003 * frame / total, 0) AS BIGINT) AS word FROM al JOIN fi USING (file_id)""")
def q_window_bounds(spark, d):
    f = frames(spark, d)
    files = f.groupBy("file_id").agg((F.max("frame") + 1).alias("total")).withColumn("windows", F.lit(5).cast("long")).withColumn("n_words", F.lit(1003).cast("long"))
    return PL.window_bounds(files, q_blank_runs(spark, d))


def energy(spark, d):
    s = stereo(spark, d).select("file_id", "second", F.explode(F.arrays_zip("l", "r")).alias("x")).select("file_id", "second", "x.l", "x.r")
    return PO.second_energy(s)


def blocks(spark, d):
    """(file_id, block, energy) of 20 blocks a second, over which all samples are dealt."""
    s = stereo(spark, d).select("file_id", "second", F.posexplode(F.arrays_zip("l", "r")).alias("k", "x"))
    rows = s.select("file_id", F.expr("second * 20 + k * 20 div 32").alias("block"), "x.l", "x.r")
    return PO.block_energy(rows)


DB = lambda x: f"10 * log10({x} + 1e-12)"
LABEL = STEREO + f""",
lab AS (SELECT file_id, second, CASE WHEN greatest({DB('l')}, {DB('r')}) >= -50 THEN CASE WHEN {DB('diff')} >= {DB('mix')} + 6 THEN 1 ELSE 0 END ELSE -1 END AS label, greatest({DB('l')}, {DB('r')}) AS louder, {DB('mix')} AS m FROM energy)"""


@query("WITH " + STEREO + " SELECT file_id, second, CAST(round(l * 1e6) AS BIGINT) AS l, CAST(round(r * 1e6) AS BIGINT) AS r, CAST(round(mix * 1e6) AS BIGINT) AS mix, CAST(round(diff * 1e6) AS BIGINT) AS diff FROM energy")
def q_stereo_energy(spark, d):
    part = lambda c: F.round(F.col(c) * 1e6).cast("long").alias(c)
    return energy(spark, d).select("file_id", "second", part("l"), part("r"), part("mix"), part("diff"))


@query("WITH " + LABEL + " SELECT file_id, second, label FROM lab")
def q_polarity_labels(spark, d):
    return PO.labels(energy(spark, d)).select("file_id", "second", "label")


SECT = LABEL + """,
kn AS (SELECT file_id, second, label FROM lab WHERE label >= 0),
fl AS (SELECT l.file_id, l.second, CASE WHEN l.label >= 0 THEN l.label ELSE (
  SELECT CASE WHEN count(*) = 0 THEN 0 WHEN min(label) = max(label) THEN min(label) ELSE 0 END FROM kn WHERE kn.file_id = l.file_id AND abs(kn.second - l.second) = (SELECT min(abs(k2.second - l.second)) FROM kn k2 WHERE k2.file_id = l.file_id)) END AS label FROM lab l),
r1 AS (SELECT file_id, second, second - row_number() OVER (PARTITION BY file_id ORDER BY second) AS g FROM fl WHERE label = 1),
r2 AS (SELECT file_id, min(second) AS a, max(second) + 1 AS b FROM r1 GROUP BY file_id, g),
r3 AS (SELECT *, CASE WHEN a - lag(b) OVER (PARTITION BY file_id ORDER BY a) >= 3 THEN 1 ELSE 0 END AS new FROM r2),
r4 AS (SELECT *, sum(new) OVER (PARTITION BY file_id ORDER BY a) AS g FROM r3),
r5 AS (SELECT file_id, min(a) AS a, max(b) AS b FROM r4 GROUP BY file_id, g HAVING max(b) - min(a) >= 5),
ln AS (SELECT file_id, max(second) + 1 AS n FROM lab GROUP BY file_id)"""
SEAMS = SECT + """, ed AS (SELECT file_id, a AS second FROM r5 UNION SELECT file_id, b FROM r5),
bk AS (SELECT file_id, second * 20 + (k - 1) * 20 // 32 AS block, avg(((x * a) * (x * a) + (x * a * s) * (x * a * s)) / 2) AS en FROM (SELECT file_id, second, a, s, unnest(e)::DOUBLE AS x, generate_subscripts(e, 1) AS k FROM st) GROUP BY 1, 2),
bs AS (SELECT ed.file_id, second, arg_min(block, (en, block)) AS block FROM ed JOIN bk ON bk.file_id = ed.file_id AND block >= greatest((second - 1) * 20, 0) AND block < (second + 1) * 20 GROUP BY ALL),
sm AS (SELECT file_id, second, CAST((2 * block + 1) * 50 // 2 AS BIGINT) AS seam_ms FROM bs)"""


@query("WITH " + SECT + " SELECT file_id, CAST(CASE WHEN a = 0 THEN 0 ELSE a * 1000 END AS BIGINT) AS start_ms, CAST(CASE WHEN b < n THEN b * 1000 END AS BIGINT) AS end_ms FROM r5 JOIN ln USING (file_id)")
def q_polarity_sections(spark, d):
    return PO.sections(energy(spark, d)).select("file_id", "start_ms", "end_ms")


@query("WITH " + SEAMS + " SELECT * FROM sm")
def q_polarity_seams(spark, d):
    s = PO.smooth(PO.fill_silence(PO.labels(energy(spark, d))))
    edges = s.select("file_id", F.explode(F.array("a", "b")).alias("second")).distinct()
    return PO.seams(edges, blocks(spark, d)).select("file_id", "second", "seam_ms")


@query("WITH " + LABEL + """, sg AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY second) AS k FROM lab WHERE louder >= -50), bd AS (SELECT *, k - row_number() OVER (PARTITION BY file_id ORDER BY k) AS g FROM sg WHERE m <= louder - 10)
SELECT file_id, min(second) AS a, max(second) + 1 AS b FROM bd GROUP BY file_id, g HAVING count(*) >= 5""")
def q_cancelled(spark, d):
    return PO.cancelled(energy(spark, d)).select("file_id", "a", "b")


@query("WITH " + LABEL + ", x AS (SELECT file_id, second // 30 AS win, avg(mix) AS p FROM energy GROUP BY 1, 2) SELECT file_id, win, CAST(round(200 * log10(sqrt(p) + 1e-9)) AS BIGINT) AS tenth_db FROM x")
def q_loudness(spark, d):
    e = energy(spark, d).groupBy("file_id", F.expr("second div 30").alias("win")).agg(F.avg("mix").alias("p"))
    return e.select("file_id", "win", F.round(200 * F.log10(F.sqrt("p") + 1e-9)).cast("long").alias("tenth_db"))


@query("WITH " + SEAMS + """, se AS (SELECT r5.file_id, CASE WHEN a = 0 THEN 0 ELSE x.seam_ms END AS f, CASE WHEN b < n THEN y.seam_ms END AS t FROM r5 JOIN ln USING (file_id) JOIN sm x ON x.file_id = r5.file_id AND x.second = a LEFT JOIN sm y ON y.file_id = r5.file_id AND y.second = b),
te AS (SELECT file_id, f, CASE WHEN f <= 0 THEN '1' ELSE 'clip((n/s-(' || format('{:.3f}', f / 1000 - 0.01) || '))/0.02,0,1)' END || '*' || CASE WHEN t IS NULL THEN '1' ELSE 'clip(((' || format('{:.3f}', t / 1000 + 0.01) || ')-n/s)/0.02,0,1)' END AS term FROM se)
SELECT file_id, 'aeval=exprs=''val(0)|val(1)*(1-2*(' || string_agg(term, '+' ORDER BY f, term) || '))'',pan=stereo|c0=c0|c1=c1' AS filter FROM te GROUP BY file_id""")
def q_flip_filter(spark, d):
    return PO.flip_filter(PO.sections(energy(spark, d), blocks(spark, d)))
