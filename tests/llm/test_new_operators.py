"""SentencePiece, lexical search and the Merkle manifest against the library and brute force."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from captionlake.llm import lexical, merkle, pieces

from .test_operators import DOCS, EXTRA, ODD, docs, sentence

DATA = "/root/testdata/sf0.001"


# 11 --------------------------------------------------------------------------------------------


def library():
    import public_tokenizers as P
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def odd_texts(rnd, m, n):
    for _ in range(n):
        k, size = rnd.randrange(4), rnd.randint(1, 60)
        if k == 0:
            yield "".join(rnd.choice("ab er thinABsty  \n.,0123") for _ in range(size))
        elif k == 1:
            yield "".join(rnd.choice(m.text[rnd.randrange(259, 32000)]).replace("▁", " ") for _ in range(size))
        elif k == 2:
            yield "".join(m.text[rnd.randrange(259, 32000)].replace("▁", " ") for _ in range(size // 3 + 1))
        else:
            yield "".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(0xA0, 0x3000), rnd.randrange(0x4E00, 0x9FFF), rnd.randrange(0x1F300, 0x1F700)])) for _ in range(size))


def test_pieces_equal_the_library(monkeypatch):
    sp, m, rnd = library(), pieces.public_model()(), random.Random(3)
    fixed = ["", " ", "  ", "a", " a", "▁", "▁▁a ▁", "\t\n", "\x00a\x00", "<s> </s> <unk> <0x41>", " " * 100 + "x" + " " * 37, "a" * 40, "�", " ⁇ "]
    monkeypatch.setattr(pieces, "MOST", 300)  # memories that are emptied again and again
    for t in [*fixed, *(t or "" for t in ODD), *odd_texts(rnd, m, 1500)]:
        want = sp.encode(t, add_bos=True, add_eos=True)
        ids = m.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == want, t
        assert m.decode(ids) == sp.decode(want), t


def test_decode_any_ids():
    sp, m, rnd = library(), pieces.public_model()(), random.Random(4)
    for _ in range(1500):
        ids = [rnd.randrange(32000) if rnd.random() < 0.5 else rnd.randrange(259) for _ in range(rnd.randint(0, 12))]
        assert m.decode(np.array(ids, "<u4").tobytes()) == sp.decode(ids), ids


def test_prefix_table():
    """The last token of every prefix is that of the prefix encoded alone."""
    m, rnd = pieces.public_model()(), random.Random(5)
    for t in odd_texts(rnd, m, 60):
        t = "▁" + t.replace(" ", "▁")
        last = m.last_tokens(t)
        for k in range(1, len(t) + 1):
            if last[k - 1] >= 0:
                assert m.tokens(t[:k])[-1] == last[k - 1]


def test_encode_columns(spark):
    d = docs(spark, ODD, ids=[*range(len(ODD) - 1), None]).withColumnsRenamed({"fp": "ids", "h": "decoded", "g": "input"})
    sp = library()
    got = pieces.round_trip(d, pieces.public_model()).collect()
    assert [(r._ids, r._decoded) for r in got] == [(np.array(sp.encode(t or "", add_bos=True, add_eos=True), "<u4").tobytes(), sp.decode(sp.encode(t or ""))) for t in ODD]
    assert all((r.ids, r.decoded, r.input, r.text) == (1, 2, 3, t) for r, t in zip(got, ODD))
    two = pieces.decode(pieces.encode(d.select("doc_id", "text"), pieces.public_model()), pieces.public_model()).collect()
    assert [(r.ids, r.decoded) for r in two] == [(r._ids, r._decoded) for r in got]
    assert pieces.round_trip(d.limit(0), pieces.public_model()).collect() == []


# 12 --------------------------------------------------------------------------------------------


def brute_terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_search(rows, items, top):
    held = [(doc_id, Counter(brute_terms(t))) for doc_id, t in rows if brute_terms(t)]
    n_docs, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in items:
        found = []
        for doc_id, c in held:
            m = 75 + 25 * c.total() * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in brute_terms(text) if c[t])
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, k, None if null else doc_id, -s) for k, (s, null, doc_id) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("postings", "block"), [(1_000_000, 200_000), (40, 12)])
def test_search_against_brute_force(spark, postings, block):
    """Also with shards of a document or two and blocks of a query or two."""
    rnd = random.Random(11)
    texts = [*ODD, *(sentence(rnd, rnd.randint(1, 60)) for _ in range(150)), "same text", "same text", "Same-TEXT"]
    ids = [*range(len(texts) - 3), 7, 7, None]
    items = [(1, "alpha beta alpha, Gammas"), (2, None), (3, ""), (4, "no such term 日本語"), (1, "same text"), (None, "delta x"), (5, sentence(rnd, 200)), (6, "w")]
    d = docs(spark, texts, ids=ids).repartition(4)
    index = lexical.build_index(d, postings)
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("query", F.lit(1))
    got = sorted((tuple(r) for r in lexical.search(index, q, top=5, block_terms=block).collect()), key=str)
    assert got == brute_search(list(zip(ids, texts)), items, 5)
    shards = index.postings.select("shard").distinct().count()
    assert shards > 30 if postings == 40 else shards <= 4


def test_search_of_nothing(spark):
    d = docs(spark, ODD)
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert lexical.search(lexical.build_index(d), none).collect() == []
    assert lexical.search(lexical.build_index(d.limit(0)), some).collect() == []
    assert lexical.search(lexical.build_index(docs(spark, [None, "", "--"])), some).collect() == []


def test_heap_merge_prunes_and_stays_exact():
    rnd = random.Random(12)
    for _ in range(300):
        cursors, score = [], Counter()
        for _ in range(rnd.randint(1, 6)):
            at = sorted(rnd.sample(range(60), rnd.randint(1, 50)))
            adds = [rnd.randint(1, rnd.choice([3, 50])) for _ in at]
            cursors.append(lexical.Cursor(at, adds, max(adds)))
            score.update(dict(zip(at, adds)))
        top = rnd.randint(1, 8)
        want = sorted(((s, x) for x, s in score.items()), key=lambda p: (-p[0], p[1]))[:top]
        assert sorted(lexical.best_of(cursors, top), key=lambda p: (-p[0], p[1])) == want


def test_postings_round_trip():
    for gaps, counts in (([0], [1]), ([3, 1, 900], [1, 300, 2]), ([0, 1 << 33], [70_000, 1])):
        a, b = lexical.unpack(lexical.pack(np.array(gaps), np.array(counts)))
        assert (a.tolist(), b.tolist()) == (gaps, counts)


# 13 --------------------------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(d):
    return sha(*("-" if d[c] is None else f"{len(str(d[c]).encode())}:{d[c]}" for c in ("doc_id", "source", "lang", "n_chars", "text")))


def brute_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def brute_path(levels, i):
    out = []
    for nodes in levels[:-1]:
        run = i // 3 * 3
        out.append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 3])))
        i //= 3
    return out


def brute_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows as dictionaries."""
    groups = defaultdict(list)
    for d in rows:
        groups[d["source"]].append(d)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        groups[s].sort(key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0, brute_leaf(d)))
        trees[s] = brute_levels([brute_leaf(d) for d in groups[s]])
    top = brute_levels([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, d in enumerate(groups[s]):
            path = brute_path(trees[s], i) + brute_path(top, k)
            bad = d["doc_id"] is not None and d["text"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 2 == 0
            folded = brute_leaf({**d, "text": d["text"].replace("\n", "")} if bad else d)
            for left, right in path:
                folded = sha(left, folded, right)
            out.append((d["doc_id"], brute_leaf(d), trees[s][-1][0], top[-1][0], sha(*(x for p in path for x in p)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def manifest(d, **how):
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(marked, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    r = merkle.proofs(d.select("*", merkle.leaf().alias("leaf"), merkle.leaf(text=tampered).alias("claimed")), **how)
    return r.withColumn("folded", merkle.fold(F.col("claimed"), F.col(r.columns[-3]))), r.columns[-3:]


@pytest.mark.parametrize(("local", "band", "parts"), [(9, 6, 4), (1, 1, 7), (2, 2, 50), (0, 3, 3)])
def test_manifest_against_brute_force(spark, local, band, parts):
    """Hot and lone sources, and subtrees so low that most nodes are ragged."""
    rnd = random.Random(13)
    rows = []
    for k in range(400):
        source = rnd.choice(["hot", "hot", "hot", None, "", "é", "b", f"one{k}"])
        rows.append({"doc_id": rnd.choice([k, k, k, 5, None]), "text": rnd.choice([None, "", "a\nb", f"x{k}\n\n", "日本\n"]), "lang": rnd.choice(["en", None]), "source": source, "n_chars": rnd.choice([None, k])})
    rows += rows[:3]
    d = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], DOCS).withColumns({k: F.lit(v) for k, v in EXTRA.items()})
    d = d.withColumns({"path": F.lit(1), "low_path": F.lit(2), "subroot": F.lit(3), "idx": F.lit(4), "level": F.lit(5)})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        r, (path, subroot, root) = manifest(d, local=local, band=band)
        got = r.withColumn("proof", merkle.proof_text(F.col(path))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    assert sorted(((x.doc_id, x.leaf, x[subroot], x[root], x.proof, x.folded, x.folded == x[root]) for x in got), key=str) == brute_manifest(rows)
    assert all(x.path == 1 and x.low_path == 2 and x.grp == 7 and x["root"] == 15 for x in got)


def test_small_manifests(spark):
    d = docs(spark, ["only"], extra=False)
    r, (path, subroot, root) = manifest(d)
    (x,) = r.collect()
    assert x[path] == [] and x[subroot] == x[root] == x.leaf == x.folded
    assert manifest(d.limit(0))[0].collect() == []


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", ["op12_lexical_search", "op13_merkle_manifest"])
def test_sql(spark, name):
    import glob

    import duckdb

    from captionlake.llm import queries as Q

    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    got = Q.QUERIES[name](spark, DATA)
    want = c.sql(Q.ORACLE_SQL[name])
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.select(", ".join(got.columns)).fetchall()))
