import random

from captionlake.config import CUE
from captionlake.operators import cues as C
from captionlake.operators import words as W

WORDS = "file_id long, pos long, w string, start_ms long, end_ms long, score_m long"


def words(spark, rows):
    return spark.createDataFrame([(1, k, w, s, e, 900) for k, (w, s, e) in enumerate(rows)], WORDS)


def built(spark, rows, **more):
    return [(r.text, r.start_ms, r.end_ms) for r in C.build_cues(words(spark, rows), **more).orderBy("n").collect()]


def test_fill_times_against_a_sequential_fold(spark):
    rnd = random.Random(3)
    rows = []
    for f in range(40):
        t = 0
        for k in range(rnd.randint(1, 25)):
            t += rnd.randint(0, 400)
            null = rnd.random() < 0.4
            rows.append((f, k, "w", None if null else t, None if null else t + rnd.randint(0, 300), 1))
    got = {(r.file_id, r.pos): (r.start_ms, r.end_ms) for r in W.fill_times(spark.createDataFrame(rows, WORDS)).collect()}
    for f in range(40):
        mine = [list(r[3:5]) for r in rows if r[0] == f]
        for i, w in enumerate(mine):
            if w[0] is None:
                p = mine[i - 1][1] if i else 0
                x = next((v[0] for v in mine[i + 1 :] if v[0] is not None), p + 300)
                mine[i] = [p, max(p + 50, x)]
        assert [got[f, k] for k in range(len(mine))] == [tuple(w) for w in mine]


def test_sentences_and_pauses_split(spark):
    assert len(built(spark, [("One.", 0, 2000), ("Two.", 2100, 4000)])) == 2
    assert len(built(spark, [("one", 0, 1600), ("two", 4000, 6000)])) == 2
    assert len(built(spark, [("one", 0, 1000), ("two", 1800, 3000)])) == 1


def test_far_first_word_joins_the_body(spark):
    rows = [("Five", 8300, 8600), *((f"w{k}", 54000 + 400 * k, 54300 + 400 * k) for k in range(6))]
    got = built(spark, rows)
    assert len(got) == 1 and got[0][1] >= 50000
    assert len(built(spark, rows, head=False)) == 2


def test_groups_fit_two_lines():
    rnd = random.Random(1)
    for _ in range(300):
        n = rnd.randint(1, 60)
        lengths = [rnd.randint(1, 12) for _ in range(n)]
        starts = [500 * k for k in range(n)]
        cuts = C.group_cuts(lengths, starts, [s + 400 for s in starts], [rnd.random() < 0.1 for _ in range(n)], CUE)
        assert cuts[-1] == n and cuts == sorted(set(cuts))
        assert all(C.fits(lengths[a:b], CUE) for a, b in zip([0, *cuts], cuts))
    assert C.group_cuts([50, 3], [0, 1], [1, 2], [False, False], CUE) == [1, 2]


def test_display_fold():
    cue = lambda t, s, e: {"text": t, "lengths": list(map(len, t.split())), "start": s, "end": e}
    run = lambda *c, **k: [(x["text"], x["start"], x["end"]) for x in C.Display(CUE, **k).run(list(c))]
    assert run(cue("a", 0, 100)) == [("a", 0, 1500)]
    assert run(cue("a b", 0, 2000), cue("c", 2100, 2300), cue("d", 2400, 9000)) == [("a b c", 0, 2300), ("d", 2400, 9000)]
    assert run(cue("a", 0, 200), cue("b", 500, 9000)) == [("a b", 0, 7000)]
    assert run(cue("a", 0, 10000)) == [("a", 0, 7000)]
    # too far back to join the cue before it, so it joins the next one
    assert run(cue("a b", 0, 2000), cue("c", 99000, 99100), cue("d", 99500, 103000), back_ms=8000) == [("a b", 0, 2000), ("c d", 99000, 103000)]


def test_clamp(spark):
    make = lambda rows: spark.createDataFrame([(1, k, "t", s, e) for k, (s, e) in enumerate(rows)], C.CUES)
    ends = lambda rows, region=None: [(r.start_ms, r.end_ms) for r in C.clamp(make(rows), region).orderBy("n").collect()]
    assert ends([(0, 3000), (2500, 5000)])[0][1] <= 2500 - 84
    assert ends([(0, 2000), (2300, 5000)])[0][1] == 2216
    assert ends([(0, 2000), (3000, 5000)])[0][1] == 2000
    assert ends([(0, 10000)]) == [(0, 7000)]
    region = spark.createDataFrame([(1, 2000, 6000)], "file_id long, first_ms long, last_ms long")
    assert ends([(0, 6000)], region)[0][0] == 2000


def test_pin_edges(spark):
    rows = [("a", None, None), ("b", 100, 200), ("c", None, None), ("d", 300, 400), ("e", None, None)]
    got = [(r.start_ms, r.end_ms) for r in W.pin_edges(words(spark, rows)).orderBy("pos").collect()]
    assert got == [(100, 100), (100, 200), (None, None), (300, 400), (400, 400)]


def test_scored_sentences(spark):
    rows = [(1, 0, "a", 0, 1, 499), (1, 1, "b.", 2, 3, 500), (1, 2, "c.", 4, 5, 499), (1, 3, "d", None, None, 900)]
    got = {r.text: r.kept for r in W.scored_sentences(spark.createDataFrame(rows, WORDS)).collect()}
    assert got == {"a b.": True, "c.": False, "d": False}
    long = spark.createDataFrame([(1, k, "x", 0, 1, 1) for k in range(95)], WORDS)
    assert sorted(r.timed for r in W.scored_sentences(long).collect()) == [15, 40, 40]


def test_empty(spark):
    assert C.build_cues(spark.createDataFrame([], WORDS)).count() == 0


def test_words_of_files_move_once(spark):
    """Documents are dealt out by file before they are cut into words; then neither words nor segments move or are sorted again."""
    import re

    from captionlake.plans.derive import by_file, words as derived

    few, many = (by_file(spark.range(99).selectExpr("id AS doc_id", "'a' AS text"), n).rdd.getNumPartitions() for n in (1 << 20, 8))
    assert few < many
    plan = W.simple_cues(W.segments(W.fill_times(derived(spark, "/root/testdata/sf0.001"))))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange ", plan)) == 1 and len(re.findall(r"\bSort ", plan)) == 1


def test_fits_lines_and_counts_by_length(spark):
    """Texts whose length tells, and those between, against packing word by word; marks and Korean letters aren't counted twice."""
    from pyspark.sql import functions as F

    from captionlake.functions.text import char_count

    rnd = random.Random(5)
    texts = ["", " ", "a" * 42, "a" * 43, "a" * 42 + " " + "b" * 42, "a" * 43 + " b"] + [" ".join("x" * rnd.randint(0, 30) for _ in range(rnd.randint(1, 12))) for _ in range(400)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.fits_lines(F.col("t")), char_count("t")).collect()
    assert [tuple(r) for r in got] == [(t, C.fits([len(w) for w in t.split(" ")], CUE), len(t)) for t in texts]
    other = spark.createDataFrame([("éa\nb",), ("각",), (None,)], "t string").select(char_count("t")).collect()
    assert [r[0] for r in other] == [3, 1, None]


def test_folds_hold_no_file(spark):
    """Files go through a fold one behind the other, in batches that end anywhere; the display fold reads one cue ahead."""
    from itertools import count

    endless = ({"text": f"w{k}", "lengths": [2], "start": 5000 * k, "end": 5000 * k + 2000} for k in count())
    first = next(iter(C.Display(CUE).run(endless)))
    assert (first["text"], first["end"]) == ("w0", 2000) and next(endless)["start"] < 20_000
    rnd = random.Random(9)
    rows, t = [], 0
    for f in range(12):
        for k in range(rnd.randint(1, 40)):
            t += rnd.choice((50, 700, 700, 2500))
            rows.append((f, k, "x" * rnd.randint(1, 14) + rnd.choice(("", "", "", ",", ".")), t, t + 400, 1))
            t += 400
    given = spark.createDataFrame(rows, WORDS).repartition(3)
    folds = [lambda w: C.balanced_groups(w), lambda w: C.min_display(C.balanced_groups(w)), lambda w: C.build_cues(w)]
    one = [[r for f in range(12) for r in sorted(map(tuple, fold(given.where(f"file_id = {f}")).collect()))] for fold in folds]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert [sorted(map(tuple, fold(given).collect())) for fold in folds] == one
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for f in range(12):
        mine = [r for r in rows if r[0] == f]
        assert " ".join(r[2] for r in one[0] if r[0] == f) == " ".join(r[2] for r in mine)
    assert not any("InPandas" in fold(given)._jdf.queryExecution().executedPlan().toString() for fold in folds)


def test_words_meet_their_spans_without_a_join(spark):
    """Words that are dealt out by file don't move again for their spans; words without spans, twice the same place and foreign spans are as in a left join."""
    import re

    from captionlake.queries import QUERIES

    plan = QUERIES["q_assemble_words"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and set(re.findall(r"Exchange hashpartitioning\((\w+)#", plan)) == {"doc_id"} and len(re.findall("Exchange hash", plan)) == len(re.findall("REPARTITION_BY_NUM", plan))
    w = spark.createDataFrame([(1, 0, "ab"), (1, 1, "c"), (1, 1, "d"), (2, 0, None), (None, 0, "e")], "file_id long, pos long, w string")
    s = spark.createDataFrame([(1, 0, 2, 5, 6, 7), (1, 0, 1, 9, 4, 2), (1, 1, 1, 3, 4, None), (2, 0, 1, 8, 9, 1), (3, 0, 1, 1, 1, 1), (None, 0, 1, 1, 1, 1)], "file_id long, pos long, k long, start long, end long, score long")
    got = sorted(map(tuple, W.assemble(w, s).collect()), key=str)
    assert got == sorted([(1, 0, "ab", 9, 6, 9, 2), (1, 1, "c", 3, 4, None, 1), (1, 1, "d", 3, 4, None, 1), (2, 0, None, 8, 9, 1, 1), (None, 0, "e", None, None, None, 0)], key=str)
