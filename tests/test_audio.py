import random

import numpy as np

from captionlake.operators import intervals as I
from captionlake.operators import planning as PL
from captionlake.operators import polarity as PO


def test_chunk_bounds(spark):
    def bounds(n):
        files = spark.createDataFrame([(n,)], "n long")
        return [(r.a, r.b) for r in PL.chunk_bounds(files, "n", 30, 15).orderBy("k").collect()]

    assert bounds(77) == [(0, 30), (30, 60), (60, 77)]
    assert bounds(74) == [(0, 30), (30, 74)]
    assert bounds(60) == [(0, 30), (30, 60)] and bounds(45) == [(0, 30), (30, 45)] and bounds(44) == [(0, 44)]
    assert bounds(1) == [(0, 1)] and bounds(0) == []


def test_window_bounds(spark):
    files = spark.createDataFrame([(1, 100, 2, 1000)], "file_id long, total long, windows long, n_words long")
    blank = spark.createDataFrame([(1, 40, 60)], "file_id long, a long, b long")
    assert [(r.frame, r.word) for r in PL.window_bounds(files, blank).orderBy("k").collect()] == [(0, 0), (50, 500), (100, 1000)]


def plan(spark, gaps, dur_ms):
    """(end, gap) of the chunks of a file whose silences are `gaps`."""
    edges = [0, *(x for g in gaps for x in g), dur_ms]
    speech = spark.createDataFrame([(1, k, edges[2 * k], edges[2 * k + 1]) for k in range(len(edges) // 2)], "file_id long, seg long, start_ms long, end_ms long")
    audio = spark.createDataFrame([(1, dur_ms)], "file_id long, dur_ms long")
    rows = PL.chunk_plan(speech, audio).orderBy("idx").collect()
    assert [r.start_ms for r in rows] == [0, *(r.end_ms for r in rows[:-1])] and [r.idx for r in rows] == list(range(1, len(rows) + 1))
    return [(r.end_ms, r.cut_gap_ms) for r in rows]


def test_chunk_plan(spark):
    assert plan(spark, [], 700_000) == [(700_000, 0)]
    assert plan(spark, [], 1_300_000) == [(600_000, 0), (1_300_000, 0)]
    assert plan(spark, [], 750_000) == [(750_000, 0)] and plan(spark, [], 750_001) == [(600_000, 0), (750_001, 0)]
    # the longest gap near the target, ties to the later one
    assert plan(spark, [(590_000, 592_000), (620_000, 622_000), (650_000, 651_000)], 1_000_000)[0] == (621_000, 2000)
    # just at the edge of the search, and just beyond it; the next target counts from the middle before rounding
    assert plan(spark, [(689_000, 691_000)], 1_000_000)[0] == (690_000, 2000)
    assert plan(spark, [(689_000, 691_002)], 1_000_000)[0] == (600_000, 0)
    assert plan(spark, [(600_000, 600_010), (1_289_000, 1_291_012)], 1_600_000) == [(600_000, 10), (1_200_000, 0), (1_600_000, 0)]
    # a silence that no target comes near, with plain targets before and after it
    assert plan(spark, [(3_300_000, 3_301_000), (4_790_000, 4_791_000)], 6_000_000) == [
        *((600_000 * k, 0) for k in range(1, 8)), (4_790_500, 1000), (5_390_500, 0), (6_000_000, 0)
    ]


def test_chunk_plan_by_search(spark):
    """Against the rule looked up target by target, on dense and sparse silences."""
    rnd = random.Random(9)
    files, want = [], {}
    for f in range(40):
        spread = rnd.choice([3_000, 40_000, 400_000, 1_500_000])
        edges = sorted({rnd.randrange(0, 9_000_000) for _ in range(2 * (9_000_000 // spread) + 2)})[: 2 * (9_000_000 // spread)]
        dur = 9_000_000 + rnd.randrange(1000)
        files += [(f, k, edges[k - 1] if k else 0, edges[k] if k < len(edges) else dur) for k in range(0, len(edges) + 1, 2)]
        places = {a + b: b - a for a, b in zip(edges[::2], edges[1::2])}
        last, cuts = 0, []
        while last + 1_200_000 < 2 * (dur - 150_000):
            target = last + 1_200_000
            near = [m for m in places if target - 180_000 <= m <= target + 180_000]
            last = sorted(near, key=lambda m: (places[m], m))[-1] if near else target
            cuts.append((10 * round(last / 20), places[last] if near else 0))
        want[f] = [*cuts, (dur, 0)]
    speech = spark.createDataFrame(files, "file_id long, seg long, start_ms long, end_ms long")
    audio = spark.createDataFrame([(f, c[-1][0]) for f, c in want.items()], "file_id long, dur_ms long")
    got = PL.chunk_plan(speech, audio)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString() and "InPandas" not in got._jdf.queryExecution().executedPlan().toString()
    rows = sorted((r.file_id, r.idx, r.end_ms, r.cut_gap_ms) for r in got.collect())
    assert rows == [(f, k, *c) for f in sorted(want) for k, c in enumerate(want[f], 1)]


def test_chunk_plan_of_a_long_file(spark):
    """A hundred thousand silences in one file."""
    import time

    n = 100_000
    speech = spark.range(n).selectExpr("1L AS file_id", "id AS seg", "id * 5000 AS start_ms", "id * 5000 + 4000 + id % 7 * 100 AS end_ms")
    audio = spark.createDataFrame([(1, 5000 * n)], "file_id long, dur_ms long")
    began = time.perf_counter()
    rows = PL.chunk_plan(speech, audio).collect()
    assert 700 < len(rows) < 900 and time.perf_counter() - began < 60


def test_overlap_sum(spark):
    rnd = random.Random(2)
    spans = [(f, k, s, s + rnd.randint(0, 200_000)) for f in range(3) for k in range(20) for s in [rnd.randint(-5000, 400_000)]]
    parts = [(f, s, s + rnd.randint(0, 90_000)) for f in range(3) for s in [rnd.randint(0, 500_000) for _ in range(30)]]
    a = spark.createDataFrame(spans, "f long, k long, start_ms long, end_ms long")
    b = spark.createDataFrame(parts, "f long, start_ms long, end_ms long")
    got = {(r.f, r.k): r.overlap_ms for r in I.overlap_sum(a, b, ["f"], ["k"]).collect()}
    for f, k, s, e in spans:
        assert got[f, k] == sum(max(0, min(e, y) - max(s, x)) for g, x, y in parts if g == f), (f, k)


def sections(spark, labels):
    """Sections for a list of labels 1, 0, -1."""
    energy = {1: (0.01, 0.01, 1e-6, 0.01), 0: (0.01, 0.01, 0.01, 1e-6), -1: (1e-9, 1e-9, 1e-9, 1e-9)}
    rows = [(1, k, *energy[x]) for k, x in enumerate(labels)]
    e = spark.createDataFrame(rows, "file_id long, second long, l double, r double, mix double, diff double")
    blocks = spark.createDataFrame([(1, k, 1.0) for k in range(20 * len(labels))], "file_id long, block long, energy double")
    return [(r.start_ms, r.end_ms) for r in PO.sections(e, blocks).orderBy("start_ms").collect()]


def test_sections(spark):
    # short normal runs join their neighbours, long ones don't; silence takes the nearest label; short inverted runs are dropped
    assert sections(spark, [1] * 9 + [0] + [1] * 9) == [(0, None)]
    assert [s for s, _ in sections(spark, [1] * 9 + [0] * 6 + [1] * 9)] == [0, 14_025]
    assert sections(spark, [1] * 31 + [-1] * 5 + [0] * 30) == [(0, 32_025)]
    assert sections(spark, [0] * 7 + [1] * 4 + [0] + [1] * 2 + [0] * 8) == [(6_025, 13_025)]
    assert sections(spark, [0] * 9 + [1] * 4 + [0] * 9) == []
    assert sections(spark, [-1] * 5) == []


def test_cancelled(spark):
    rows = [(1, k, 0.01, 0.01, 1e-9, 0.0) for k in range(7)]
    rows[3] = (1, 3, 1e-9, 1e-9, 1e-9, 0.0)
    e = spark.createDataFrame(rows, "file_id long, second long, l double, r double, mix double, diff double")
    assert [tuple(r)[1:] for r in PO.cancelled(e).collect()] == [(0, 7)]


def test_flip_filter(spark):
    rows = spark.createDataFrame([(1, 0, 10_000), (1, 20_000, None)], "file_id long, start_ms long, end_ms long")
    want = "aeval=exprs='val(0)|val(1)*(1-2*(1*clip(((10.010)-n/s)/0.02,0,1)+clip((n/s-(19.990))/0.02,0,1)*1))',pan=stereo|c0=c0|c1=c1"
    assert PO.flip_filter(rows).first().filter == want


def test_second_energy(spark):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(100, 2))
    s = spark.createDataFrame([(1, k // 50, float(a), float(b)) for k, (a, b) in enumerate(x)], "file_id long, second long, l double, r double")
    r = PO.second_energy(s).where("second = 1").first()
    assert abs(r.mix - np.mean(((x[50:, 0] + x[50:, 1]) / 2) ** 2)) < 1e-12
