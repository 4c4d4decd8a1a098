import difflib
import json
import os

import pytest
from pyspark.sql import functions as F

from captionlake.operators import manifest as M
from captionlake.operators import pairing as P
from captionlake.operators import quality as Q
from captionlake.sources import readers as R
from captionlake.sources import sinks as S
from captionlake.streaming import jobs as J

TRIES = "file_id long, chunk long, n long, http string, finish string, text string, error string, speech_ms long"


def test_attempts(spark):
    block = "This request was blocked by Gemini’s filters."
    rows = [
        (1, 0, 1, "200", "content_filter", "", "", 60_000), (1, 0, 2, "500", "", "", '{"code": 500}', 60_000),
        (1, 1, 1, "200", "", block, "", 60_000), (1, 1, 2, "200", "stop", "word " * 90, "", 60_000),
        (1, 2, 1, "403", "", "", '{"code": 403}', 60_000), (1, 2, 2, "200", "stop", "x", "", 1000),
        (1, 3, 1, "200", "stop", block, "", 1000), (1, 4, 1, "200", "stop", "few words", "", 60_000), (1, 5, 1, "200", "stop", " ", "", 60_000),
    ]
    t = spark.createDataFrame(rows, TRIES)
    got = {(r.chunk, r.n): r.outcome for r in M.try_outcomes(t).collect()}
    assert got == {(0, 1): "blocked", (0, 2): "error", (1, 1): "blocked", (1, 2): "ok", (2, 1): "403", (2, 2): "ok", (3, 1): "ok", (4, 1): "low density", (5, 1): "empty"}
    c = {r.chunk: (r.attempts, r.locked, r.blocked, r.ok) for r in M.chunk_attempts(t).collect()}
    assert c[0] == (2, False, True, False) and c[1] == (2, False, False, True) and c[2] == (1, True, False, False)


def test_retry_wait(spark):
    rows = [(2, "500", None), (1, "429", "30"), (1, "429", "600"), (1, "429", "Wed, 21 Oct"), (9, "500", None)]
    d = spark.createDataFrame(rows, "n long, http string, after string")
    assert [r[0] for r in d.select(M.retry_wait_ms(F.col("n"), 8000, F.col("http"), F.col("after"))).collect()] == [16_000, 30_000, 120_000, 8000, 120_000]


def test_pass_diff(spark):
    a, b = "the cat sat on the mat".split(), "the cat sits on a mat now".split()
    make = lambda x: spark.createDataFrame([(1, k, w) for k, w in enumerate(x)], "file_id long, pos long, w string")
    got = [(r.kind, r.i1, r.i2, r.j1, r.j2) for r in Q.pass_diff(make(a), make(b)).orderBy("k").collect()]
    assert got == difflib.SequenceMatcher(a=a, b=b, autojunk=False).get_opcodes()
    r = Q.agreement(Q.pass_diff(make(a), make(b))).first()
    assert (r.same, r.a_only, r.b_only, r.blocks) == (4, 2, 3, 3)


def test_pass_diff_of_many(spark):
    """Repetitive and ordinary passes of many files, in the standard library's terms; one empty pass, and a word that repeats and repeats."""
    import random

    rnd = random.Random(8)
    a, b, want = [], [], {}
    for f in range(60):
        words = [f"w{k}" for k in range(rnd.choice([1, 2, 4, 30, 200]))]
        x = [rnd.choice(words) for _ in range(rnd.randint(1, 80))]
        y = [rnd.choice(words) if rnd.random() < 0.2 else w for w in x if rnd.random() < 0.9] + [rnd.choice(words) for _ in range(rnd.randint(0, 4))]
        a += [(f, 3 * k, w) for k, w in enumerate(x)]
        b += [(f, k, w) for k, w in enumerate(y)]
        if y:
            want[f] = [(*op, "" if op[0] == "equal" else " ".join(x[op[1] : op[2]]), "" if op[0] == "equal" else " ".join(y[op[3] : op[4]])) for op in difflib.SequenceMatcher(a=x, b=y, autojunk=False).get_opcodes()]
    a, b = (spark.createDataFrame(x, "file_id long, pos long, w string").repartition(3) for x in (a, b))
    got = {}
    for r in Q.pass_diff(a, b).orderBy("file_id", "k").collect():
        got.setdefault(r.file_id, []).append((r.kind, r.i1, r.i2, r.j1, r.j2, r.a, r.b))
    assert got == want
    import numpy as np

    assert Q.matching(np.zeros(20_000, np.int64), np.zeros(3_000, np.int64)) == [(0, 0, 3000)]


def test_matching_by_windows(monkeypatch):
    """Long runs by windows and short ones only between them give what the library gives; pairs laid out at once and word by word are the same runs, and an ordinary long text lays out few."""
    import random

    import numpy as np

    rnd = random.Random(2)
    for _ in range(300):
        n = rnd.choice([1, 2, 5, 40, 300])
        x = np.array([rnd.randrange(n) for _ in range(rnd.randint(1, 90))], np.int64)
        y = np.array([rnd.randrange(n) if rnd.random() < 0.2 else w for w in x.tolist() if rnd.random() < 0.9], np.int64)
        want = [tuple(m) for m in difflib.SequenceMatcher(a=x.tolist(), b=y.tolist(), autojunk=False).get_matching_blocks()]
        got = []  # the library joins runs that touch
        for i, j, n in [*Q.matching(x, y), (len(x), len(y), 0)]:
            if n and got and got[-1][0] + got[-1][2] == i and got[-1][1] + got[-1][2] == j:
                i, j, n = (*got[-1][:2], got.pop()[2] + n)
            got.append((i, j, n))
        assert got == want
        runs = sorted(map(tuple, Q.common_runs(x, y).tolist()))
        monkeypatch.setattr(Q, "PAIRS", -1)
        assert sorted(map(tuple, Q.common_runs(x, y).tolist())) == runs
        monkeypatch.undo()
    x = np.array([rnd.randrange(300) for _ in range(20_000)], np.int64)
    sizes = []
    real = Q.common_runs
    monkeypatch.setattr(Q, "common_runs", lambda a, b: sizes.append(len(r := real(a, b))) or r)
    Q.matching(x, np.delete(x, np.arange(0, 20_000, 41)))
    assert max(sizes) < 40_000  # of all words, over a million


def test_matching_of_files(monkeypatch):
    """Many files at once, some of them empty, give what the library gives for each, however they are grouped and halved."""
    import random

    import numpy as np

    rnd = random.Random(5)
    for files, at_once, pairs in ((0, 200_000, 1_000_000), (1, 100, 5), (40, 100, 300), (40, 200_000, 5), (40, 200_000, 1_000_000)):
        monkeypatch.setattr(Q, "AT_ONCE", at_once)
        monkeypatch.setattr(Q, "PAIRS", pairs)
        said = []
        for _ in range(files):
            n = rnd.choice([1, 2, 5, 40, 300])
            x = [rnd.randrange(n) for _ in range(rnd.choice([0, 1, 2, 10, 90, 200]))]
            said.append((x, [rnd.randrange(n) if rnd.random() < 0.2 else w for w in x if rnd.random() < 0.9] + [rnd.randrange(n) for _ in range(rnd.choice([0, 0, 3]))]))
        a, b = (np.array([w for f in said for w in f[k]], np.int64) for k in (0, 1))
        starts = [np.append(0, np.cumsum([len(f[k]) for f in said])).astype(np.int64) for k in (0, 1)]
        rows, edges = Q.matching_files(a, b, *starts)
        assert [list(map(tuple, rows[k:m].tolist())) for k, m in zip(edges, edges[1:])] == [[tuple(m) for m in difflib.SequenceMatcher(a=x, b=y, autojunk=False).get_matching_blocks()] for x, y in said]


def test_pass_lists(spark, tmp_path):
    """The words of both passes as lists are those of the rows, for texts of one id too; the differences move the texts once, join nothing and run Python once."""
    from captionlake.plans import derive as D
    from captionlake.plans.cue_queries import Q as queries

    texts = [(k, " ".join(f"W{k * j % 31}é" for j in range(k * 7))) for k in range(12)] + [(3, "Ab cd\n ef"), (5, None), (20, None), (21, " \n"), (13, "alone")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = [{}, {}]
    for side, rows in zip(want, D.passes(spark, str(tmp_path))):
        for r in rows.orderBy("chunk", "pos", "w").collect():
            side.setdefault(r.chunk, []).append((r.pos, r.w))
    got = {r.file_id: (r.wa, r.wb) for r in D.pass_lists(spark, str(tmp_path)).collect()}
    assert got[20] == got[21] == ([], [])
    for k, side in enumerate(want):
        assert {f: sorted(x[k]) for f, x in got.items() if x[k]} == {f: sorted(w for _, w in rows) for f, rows in side.items()}
        assert all(got[f][k] == [w for _, w in rows] for f, rows in side.items() if f != 3)
    d = queries["q_pass_diff"](spark, str(tmp_path))
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and (plan.count("Exchange"), plan.count("ArrowEvalPython")) == (1, 1)


def test_bags_in_one_grouping(spark):
    make = lambda *rows: spark.createDataFrame([(f, k, w) for f, t in rows for k, w in enumerate(t.split())], "file_id long, pos long, w string")
    d = Q.bag_agreement(make((1, "a a b c"), (2, "x")), make((1, "a b b"), (3, "y y")))
    assert {tuple(r) for r in d.collect()} == {(1, 2, 2, 1), (2, 0, 1, 0), (3, 0, 0, 2)}
    assert "Join" not in d._jdf.queryExecution().executedPlan().toString()


def test_invented_runs_and_speech_without_length(spark):
    """A point of speech within a padded word ends a run, as in the SQL; one at its very edge doesn't; files without speech are one run."""
    words = spark.createDataFrame([(f, k, f"w{k}", 1000 * k, 1000 * k + 400, 1) for f in (1, 2, 3) for k in range(25)], "file_id long, pos long, w string, start_ms long, end_ms long, score_m long")
    speech = spark.createDataFrame([(1, 12_200, 12_200), (2, 11_700, 11_700), (2, 12_700, 12_700)], "file_id long, start_ms long, end_ms long")
    got = {(r.file_id, r.a, r.b, r.words, r.start_ms, r.end_ms, r.excerpt) for r in Q.invented_runs(words, speech).collect()}
    said = lambda a: " ".join(f"w{k}" for k in range(a, a + 12))
    assert {g for g in got if g[0] == 1} == {(1, 0, 12, 12, 0, 11_400, said(0)), (1, 13, 25, 12, 13_000, 24_400, said(13))}
    assert {g for g in got if g[0] > 1} == {(f, 0, 25, 25, 0, 24_400, said(0)) for f in (2, 3)}


def test_edge_omissions(spark):
    """Speech before the first timed word and behind the last; of words without times it is all before; times below zero don't count."""
    rows = [(1, 0, None, None), (1, 1, 6000, 7000), (1, 2, 8000, 9000), (1, 3, None, None), (2, 0, None, None), (3, 0, 0, 100), (4, 0, 500, 600)]
    words = spark.createDataFrame(rows, "file_id long, pos long, start_ms long, end_ms long")
    speech = spark.createDataFrame([(1, -3000, 2000), (1, 3000, 6950), (1, 8500, 11_500), (1, 12_000, 12_500), (2, 0, 1000), (2, 4000, 7000), (3, 0, 2099), (5, 0, 9000)], "file_id long, start_ms long, end_ms long")
    got = {tuple(r) for r in Q.edge_omissions(words, speech).collect()}
    assert got == {(1, "before", 5000, "omission"), (1, "behind", 3000, "review"), (2, "before", 4000, "review")}


def test_all_totals_of_a_check(spark):
    """q_qc_summary has every total that the queries beside it list."""
    from captionlake import queries

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no test data")
    rows = lambda name: queries.QUERIES[name](spark, d)
    r = rows("q_qc_summary").first()
    assert r.omissions + r.reviews == rows("q_qc_omission").count() and r.hallucinations == rows("q_qc_hallucination").count()
    assert r.seam_repeats == rows("q_seam_dup").where("dup > 0").count() and r.dropped == rows("q_disposition").where("NOT included").count() > 0
    assert r.edge_omissions + r.edge_reviews > 0


def test_seams(spark):
    rows = [(1, 0, "so he said, we go".split()), (1, 1, "We GO now".split()), (1, 2, [])]
    got = [(r.idx, r.dup) for r in Q.seam_repeats(spark.createDataFrame(rows, "file_id long, idx long, words array<string>")).orderBy("idx").collect()]
    assert got == [(0, 2), (1, 0)]


def test_pairs(spark):
    t = spark.createDataFrame([(0, "Đúng rồi"), (1, "DUNG  ROI"), (2, "alone")], "ord long, title string")
    a = spark.createDataFrame([(5, "dung roi"), (4, "Dung Roi"), (6, "unused")], "ord long, title string")
    got = sorted(((r.ord, r.audio_ord) for r in P.build_pairs(t, a).collect()), key=str)
    assert got == sorted([(0, 4), (1, 4), (2, None), (None, 6)], key=str)
    assert {(r.side, r.n, r.line) for r in P.unpaired_report(P.build_pairs(t, a)).collect()} == {("transcript", 1, "- alone"), ("audio", 1, "- unused")}
    more = P.build_pairs(spark.createDataFrame([(k, f"{x}{k % 3}") for k, x in enumerate("badcabdc")], "ord long, title string"), a.limit(0))
    assert [(r.side, r.n, r.line) for r in P.unpaired_report(more).orderBy("side", "n").collect()] == [("audio", 1, "- (none)"), *(("transcript", n, f"- {x}") for n, x in enumerate(sorted(f"{x}{k % 3}" for k, x in enumerate("badcabdc")), 1))]
    assert P.select_pairs(P.build_pairs(t, a), sample=2, seed=1).count() == 2


def test_readers(spark, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps({"key": "k", "audio": "a", "words": [{"w": "x", "start": 0.1, "end": 0.25, "score": 0.5}, {"w": "y", "start": None, "end": None}]}))
    assert [(r.w, r.start_ms, r.end_ms) for r in R.words_json(spark, str(tmp_path / "w.json")).orderBy("pos").collect()] == [("x", 100, 250), ("y", None, None)]
    (tmp_path / "t.srt").write_text("1\n0 --> 1\nHello there\n\n2\n1 --> 2\nyou\n")
    assert [r.w for r in R.transcripts(spark, str(tmp_path / "t.srt"), "srt").orderBy("pos").collect()] == ["Hello", "there", "you"]
    for n in ("B.mp3", "a.MP3", "c.txt"):
        (tmp_path / n).write_text("x")
    assert sorted(r.key for r in R.audio_files(spark, [str(tmp_path)]).collect()) == ["a", "b"]


def test_sse(spark):
    data = lambda **x: "data: " + json.dumps(x)
    lines = [": ping", data(model="m", choices=[{"delta": {"content": "Hel"}}]), "data: {bad", "data: [DONE]", data(choices=[{"delta": {"content": "lo"}, "finish_reason": "stop"}])]
    d = spark.createDataFrame([(1, k, x) for k, x in enumerate(lines)], "file_id long, ord long, line string")
    r = R.sse_replies(d).first()
    assert (r.content, r.model, r.finish) == ("Hello", "m", "stop")


def test_finite(spark):
    d = spark.createDataFrame([(float("nan"), [float("inf"), 1.0], (float("-inf"), 2))], "a double, b array<double>, c struct<x: double, y: int>")
    r = S.finite(d).first()
    assert r.a is None and r.b == [None, 1.0] and tuple(r.c) == (None, 2)


def test_job_stream(spark, tmp_path):
    rows = [(1, 1, "[1/4] go"), (1, 2, "x"), (1, 3, "[exit 0]"), (2, 1, "[2/4] a"), (2, 2, "[stop]"), (2, 3, "[exit 1]")]
    spark.createDataFrame(rows, "job long, ord long, line string").coalesce(1).write.parquet(str(tmp_path / "in"))
    log = spark.readStream.schema("job long, ord long, line string").parquet(str(tmp_path / "in"))
    q = J.job_status(log).writeStream.format("memory").queryName("status").outputMode("update").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r.job: (r.status, r.stage, r["lines"]) for r in spark.table("status").collect()}
    assert got == {1: ("done", "prepare", 3), 2: ("stopped", "plan", 3)}


def test_sample_stream(spark, tmp_path):
    from datetime import datetime, timedelta

    t0 = datetime(2024, 1, 1)
    rows = [(1, t0 + timedelta(milliseconds=250 * k), 0.5, -0.5 if k < 4 else 0.5) for k in range(8)] + [(1, t0 + timedelta(minutes=5), 0.0, 0.0)]
    spark.createDataFrame(rows, "file_id long, ts timestamp, l double, r double").write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("file_id long, ts timestamp, l double, r double").parquet(str(tmp_path / "in"))
    q = J.sample_energy(s).writeStream.format("memory").queryName("energy").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [(r.mix, r["diff"]) for r in spark.table("energy").orderBy("w.start").collect()] == [(0.0, 0.25), (0.25, 0.0)]


def test_threshold():
    import pytest

    from captionlake.config import parse_threshold

    assert [parse_threshold(x) for x in (None, " ", "0,7", "1")] == [0.5, 0.5, 0.7, 1.0]
    for bad in ("0", "1.1", "nan", "inf", "x", "0,,5"):
        with pytest.raises(ValueError):
            parse_threshold(bad)


def test_mai_replies(spark):
    rows = [
        (1, '{"text": " hi there ", "duration": 2.5, "language": "vi", "words": [{"word": "hi", "start": 0.1, "end": 0.4}, {"word": "there", "start": 0.5, "end": 0.9}], "usage": {"cost": 0.25, "seconds": 3.0}}\n|HTTP200'),
        (2, '{"error": {"code": 403, "message": "' + "m" * 400 + '"}}\n|HTTP403'), (3, "<html>|HTTP|HTTP502"), (4, '{"text": ""}\n|HTTP200'), (5, ""),
    ]
    d = R.mai_replies(spark.createDataFrame(rows, "file_id long, reply string"))
    got = {r.file_id: r for r in d.collect()}
    assert (got[1].text, got[1].http, got[1].cost, got[1].seconds, got[1].error) == ("hi there", "200", 0.25, 3.0, None) and [w.word for w in got[1].words] == ["hi", "there"]
    assert got[2].http == "403" and len(got[2].error) == 300 and got[2].error.startswith('{"code":') and got[2].text == ""
    assert got[3].http == "502" and got[3].error == "body is not JSON: <html>|HTTP" and got[4].error is None and got[5].error == "body is not JSON: "
    why = {r.file_id: r.reasons for r in d.select("file_id", M.mai_reasons(F.col("error"), F.col("http"), F.col("text"), F.lit(True)).alias("reasons")).collect()}
    assert why[1] == "" and why[4] == "empty despite speech present" and why[3] == "error: body is not JSON: <html>|HTTP; http=502; empty despite speech present"
    assert why[2].split("; ")[0] == "error: " + got[2].error[:80]


def test_env_merge(spark):
    lines = ["# keys", " A = 1 ", "", "B=x=y", "#C=3", "plain", "A=2"]
    old = spark.createDataFrame(list(enumerate(lines)), "ord long, line string")
    new = spark.createDataFrame([("A", "9"), ("C", "new"), ("D", "")], "k string, v string")
    got = [r.line for r in M.env_merge(old, new).orderBy("ord").collect()]
    assert got == ["# keys", "A=9", "", "B=x=y", "#C=3", "plain", "A=9", "C=new", "D="]
    assert [r.line for r in M.env_merge(old.limit(0), new).orderBy("ord").collect()] == ["A=9", "C=new", "D="]


def test_diff_page(spark):
    words = lambda t: [(1, k, w) for k, w in enumerate(t.split())]
    a, b = (spark.createDataFrame(words(t), "file_id long, pos long, w string") for t in ("a b c d e f g h", "a x c d 1 2 3 4 & h"))
    blocks = Q.pass_diff(a, b)
    rows = [r.html for r in Q.diff_rows_html(blocks).orderBy("k").collect()]
    assert [r.split('"')[1] for r in rows] == ["eq", "minor", "eq", "major", "eq"]
    assert '<tr class="major" id="d1"><td class="a"><span class="badge">1</span>' in rows[3] and "&amp;" in rows[3]
    nav = Q.diff_nav(blocks).collect()
    assert [(r.file_id, r.major, r.nav) for r in nav] == [(1, 1, '<a href="#d1">1</a>')]


def test_diff_numbers_without_a_window(spark, tmp_path):
    """Long differences that are numbered with the blocks are numbered as by a window, and q_diff_html moves the texts once."""
    from captionlake.plans.cue_queries import Q as queries

    words = lambda *files: spark.createDataFrame([(f, k, w) for f, t in enumerate(files) for k, w in enumerate(t.split())], "file_id long, pos long, w string")
    a, b = words("a b c d e f g h i j k l", "m n o p q r s t"), words("1 2 3 4 b c x y z w v g h 5 j 6 7 8 9", "m n q r s t")
    rows = lambda d: sorted((r.file_id, r.k, r.html) for r in d.collect())
    got = rows(Q.diff_rows_html(Q.list_diff(Q.pass_lists(a, b), major=4)))
    assert got == rows(Q.diff_rows_html(Q.pass_diff(a, b))) and sum("badge" in x[2] for x in got) == 3
    spark.createDataFrame([(1, "a b c d")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = queries["q_diff_html"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange") == 1


def test_diff_page_of_all_files(spark, tmp_path):
    """q_diff_html shows the words that match, and files that the second pass has no words of; its SQL gives the same."""
    import duckdb

    from captionlake.plans import cue_queries as C

    # Of file 41 the second pass lacks place 0, its only word; file 40 is the same in both.
    spark.createDataFrame([(41, "Gone<"), (40, "a b & d e f"), (7, " "), (8, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.file_id, r.k, r.html) for r in C.Q["q_diff_html"](spark, str(tmp_path)).collect())
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(c.sql("SELECT file_id, k, html FROM (" + C.SQL["q_diff_html"] + ")").fetchall())
    assert got[-1] == (41, 0, '<tr class="minor"><td class="a">gone&lt;</td><td class="b"><i>(none)</i></td></tr>')
    assert got[:-1] == [(40, 0, '<tr class="eq"><td class="a">a b &amp; d e f</td><td class="b">a b &amp; d e f</td></tr>')]
    assert {r.file_id for r in C.Q["q_pass_diff"](spark, str(tmp_path)).collect()} == {40}


def test_traces(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"chunks": [{"idx": 1, "outcome": "merged", "tries": [{"n": 1, "outcome": "ok"}]}]}))
    (tmp_path / "b.json").write_text('{"chunks": [')
    got = {r.path.rsplit("/", 1)[1]: r.chunks for r in R.trace_json(spark, str(tmp_path)).collect()}
    assert got["b.json"] is None and [(c.idx, c.outcome, c.tries[0].outcome) for c in got["a.json"]] == [(1, "merged", "ok")]
    S.write_manifest(spark.createDataFrame([("x", "ok", 3)], "file string, status string, words long"), str(tmp_path / "m"))
    assert [tuple(r) for r in R.manifest_csv(spark, str(tmp_path / "m"), "file string, status string, words long").collect()] == [("x", "ok", 3)]


def test_replay(spark):
    """A log that is replayed and then followed."""
    log = [(1, k, f"line {k}") for k in range(4)] + [(1, 4, "[exit 0]"), (2, 0, "go")]
    rows = J.replay_then_live(spark.createDataFrame(log, "job long, ord long, line string"), spark.createDataFrame([(1, 9, "late"), (2, 0, "go"), (2, 1, "on")], "job long, ord long, line string")).collect()
    assert sorted((r.job, r.ord, r.line) for r in rows) == sorted([*log, (2, 1, "on")])
