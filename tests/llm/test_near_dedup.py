"""The filtering near-dedup stage and connected components against brute force."""

import random

import pytest
import xxhash

from captionlake.llm import simhash
from captionlake.llm.common import connected_components

from .test_operators import EXTRA, ODD, brute_classes, docs, sentence

WORDS = [f"{a}{b}" for a in "ba ce di fo gu ha je ki lo mu".split() for b in "na re si to vu za le mi po ru".split()]


def word_fp(text, seed):
    h = [xxhash.xxh64_intdigest(w.encode(), seed) for w in set((text or "").lower().split())]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_kept(texts, budget=3, share=0.8):
    """Rows are numbered; a text goes if it is similar to a smaller one of its component that stays."""
    first = {}
    for k, t in enumerate(texts):
        first.setdefault(t or "", k)
    ids, own = list(first.values()), list(first)
    up = list(range(len(own)))
    for seed in (42, 43, 44, 45, 46):
        fps = [word_fp(t, seed) for t in own]
        for a, b in enumerate(brute_classes(fps, budget)):
            x, y = up[a], up[b]
            up = [min(x, y) if z in (x, y) else z for z in up]
    kept, sets = [], [shingles(t) for t in own]
    alike = lambda a, b: len(a & b) >= share * len(a | b)
    for k in sorted(range(len(own)), key=lambda k: ids[k]):
        if not any(up[j] == up[k] and alike(sets[j], sets[k]) for j in kept):
            kept.append(k)
    return sorted(ids[k] for k in kept)


def edited(rnd, text, n):
    w = text.split()
    for _ in range(n):
        w[rnd.randrange(len(w))] = rnd.choice(WORDS)
    return " ".join(w)


def late_pair(rnd):
    """Two similar texts that only one of the last two seeds links."""
    while True:
        a = " ".join(rnd.choice(WORDS) for _ in range(120))
        b = edited(rnd, a, 2)
        near = [(word_fp(a, s) ^ word_fp(b, s)).bit_count() <= 3 for s in range(42, 47)]
        x, y = shingles(a), shingles(b)
        if not any(near[:3]) and any(near[3:]) and len(x & y) >= 0.8 * len(x | y):
            return [a, b]


def corpus(rnd):
    bases = [" ".join(rnd.choice(WORDS) for _ in range(rnd.choice([60, 150, 400]))) for _ in range(8)]
    texts = [*bases, *ODD, *(edited(rnd, b, n) for b in bases for n in (1, 2, 3, 6, 12)), bases[0], bases[0].upper()]
    # One component with texts that are not similar to each other: shared words in another order.
    texts += [" ".join(rnd.sample(WORDS, len(WORDS))) for _ in range(9)]
    texts += late_pair(rnd)
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize("hot", [20_000, 8])
def test_keep_one_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    texts = corpus(random.Random(21))
    d = docs(spark, texts).repartition(3)
    kept = simhash.keep_one(d)
    assert kept.columns == d.columns
    got = kept.collect()
    assert sorted(r.doc_id for r in got) == brute_kept(texts)
    assert all(r.text == texts[r.doc_id] and all(r[k] == v for k, v in EXTRA.items()) for r in got)


def test_keep_one_rows_that_repeat(spark):
    """Repeated ids and texts, rows without doc_id, and columns whose names the stage uses."""
    t = sentence(random.Random(22), 80)
    d = docs(spark, [t, t, t, t, None, "", "alone"], ids=[5, 5, 3, None, None, 9, None])
    d = d.withColumnsRenamed({"fp": "own_hash", "h": "other", "g": "__h", "c": "own_key"})
    got = simhash.keep_one(d)
    assert got.columns == d.columns
    rows = got.collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in rows) == [(-1, "alone"), (3, t), (9, "")]
    assert all((r.own_hash, r.other, r["__h"], r.own_key) == (1, 2, 3, 4) for r in rows)


def test_hub(spark):
    """A node with very many links, and a long chain."""
    hub = spark.range(1, 100_000).selectExpr("id AS a", "0L AS b")
    chain = spark.range(200_000, 200_200).selectExpr("id AS a", "id + 1 AS b")
    got = connected_components(hub.union(chain)).groupBy("root").count().orderBy("root").collect()
    assert [(r.root, r["count"]) for r in got] == [(0, 100_000), (200_000, 201)]


def form_letters(rnd, n):
    """Letters of 40 words of which one differs, so that no two have a similarity of 0.8, and all are one component."""
    form = [rnd.choice(WORDS) for _ in range(40)]
    return [" ".join([*form[:20], f"name{k}", *form[21:]]) for k in range(n)]


def stays(spark, sets, share=0.8, parts=4):
    rows = [(1, k, k, sorted(s)) for k, s in enumerate(sets)]
    members = spark.createDataFrame(rows, "root long, key long, h long, sh array<long>").repartition(parts)
    return sorted(r.h for r in simhash._stay(members, share).collect())


def greedy(sets, share=0.8):
    kept = []
    for k, s in enumerate(sets):
        if not any(len(s & sets[j]) >= share * len(s | sets[j]) for j in kept):
            kept.append(k)
    return kept


def test_stay_against_greedy(spark):
    """Chains, stars, nested sizes, empty sets, and members that share rare shingles without being similar."""
    rnd = random.Random(31)
    for case in range(4):
        sets = []
        for _ in range(6):
            base = {rnd.randrange(1, 1 << 40) for _ in range(rnd.choice([3, 12, 40]))}
            for _ in range(rnd.randint(1, 12)):
                s = set(base)
                for _ in range(rnd.randint(0, 6)):
                    s.discard(rnd.choice(sorted(s))) if s and rnd.random() < 0.5 else s.add(rnd.randrange(1, 1 << 40))
                sets.append(s)
                base = s if case % 2 else base
        if case >= 2:  # one rare shingle in common, everything else apart
            sets += [{7, *(rnd.randrange(1 << 41, 1 << 50) for _ in range(6))} for _ in range(25)]
        sets += [set(), set()]
        rnd.shuffle(sets)
        assert stays(spark, sets) == greedy(sets), case


def test_form_letters(spark):
    """Twenty thousand letters of one component, none similar to another: all stay, and nothing is gathered."""
    import time

    rnd = random.Random(32)
    texts = form_letters(rnd, 20_000)
    sets = [[int(x) for x in simhash.shingle_hashes(t, 5).view("int64")] for t in texts]
    began = time.perf_counter()
    assert stays(spark, map(set, sets)) == list(range(20_000))
    assert time.perf_counter() - began < 180
