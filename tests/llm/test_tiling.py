"""Greedy tiling against a plain search, on repetitive texts, and over many blocks of items."""

import random
import time
import tracemalloc

import numpy as np

from captionlake.llm import decontam

from .test_operators import docs


def brute_tiles(doc, item, least):
    free_d, free_i, tiles = [True] * len(doc), [True] * len(item), []
    while True:
        found = []
        for j in range(len(item)):
            for i in range(len(doc)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and free_d[i + n] and free_i[j + n]:
                    n += 1
                if n >= least:
                    found.append((-n, j, i))
        if not found:
            return tiles
        n, j, i = min(found)
        for k in range(-n):
            free_d[i + k] = free_i[j + k] = False
        tiles.append((i, j, -n))


def test_tiles_against_plain_search():
    rnd = random.Random(41)
    for case in range(250):
        words = rnd.choice([2, 3, 6, 40])
        item = [rnd.randrange(1, words + 1) for _ in range(rnd.randint(1, 40))]
        doc = [rnd.choice([-1, *range(1, words + 1)]) for _ in range(rnd.randint(0, 30))]
        for _ in range(rnd.randint(0, 3)):
            a = rnd.randrange(len(item))
            at = rnd.randint(0, len(doc))
            doc[at:at] = item[a : a + rnd.randint(1, 30)]
        least = rnd.choice([2, 3, 5])
        got = decontam.tile(np.array(doc, np.int64), np.array(item, np.int64), least)
        assert got == brute_tiles(doc, item, least), (case, doc, item, least)


def test_repeated_words():
    """A word 200,000 times against an item that says it 2,000 times, and against one that breaks it up."""
    known = decontam.Items([(1, "na " * 2000), (2, "na " * 30 + "x " + "na " * 40 + "y z")], 5)
    tracemalloc.start()
    began = time.perf_counter()
    hits = known.hits("na " * 200_000, 0.8, 5)
    assert time.perf_counter() - began < 30
    assert tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
    assert hits == [(1, 2000, 2000, 1), (2, 73, 70, 2)]


def test_many_blocks(spark):
    """Blocks of a few words give what one block gives, for both forms."""
    rnd = random.Random(42)
    words = [f"w{k}" for k in range(300)]
    items = [(k, " ".join(rnd.choice(words) for _ in range(12))) for k in range(15)] + [(99, None), (98, "too short")]
    texts = [" ".join(rnd.choice(words) for _ in range(50)) for _ in range(20)]
    texts += [f"{texts[k]} {items[k][1]} {texts[k + 1]}" for k in range(10)] + [None, "", texts[-1]]
    d = docs(spark, texts).withColumnRenamed("fp", "plain")
    b = spark.createDataFrame(items, "item_id long, text string")
    one, many = (sorted(map(tuple, decontam.contaminated(d, b, block_words=n).collect())) for n in (1_000_000, 30))
    assert one == many and len(one) >= 10
    bad = {r[0] for r in one}
    for n in (1_000_000, 30):
        kept = decontam.keep_clean(d, b, block_words=n)
        assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(range(len(texts))) - bad)
    assert decontam.keep_clean(d, b.limit(0)).count() == len(texts)
