from pyspark.sql import functions as F

from captionlake.functions import text as T


def one(spark, column, *values):
    df = spark.createDataFrame([values], [f"c{k}" for k in range(len(values))])
    return df.select(column.alias("x")).first().x


def test_srt_time(spark):
    df = spark.createDataFrame([(3661500,), (-1,), (360000000,)], "ms long")
    assert [r[0] for r in df.select(T.srt_time("ms")).collect()] == ["01:01:01,500", "00:00:00,000", "100:00:00,000"]


def test_srt_cues(spark):
    text = "﻿1\r\n00:00:00,000 --> 00:00:01,000\r\n One \r\ntwo\r\n\r\n\r\nno time line\r\n\r\n2\r\n0 --> 1\r\n\r\n3\r\n0 --> 1\r\nlast"
    assert one(spark, T.srt_cues("c0"), text) == ["One two", "last"]
    assert one(spark, T.srt_cues("c0"), "") == []


def test_keys(spark):
    assert one(spark, T.normalize_key("c0"), "  Đúng   RỒI é ") == "dung roi e"
    assert one(spark, T.normalize_word("c0"), "Đ’Été!") == "d'ete"
    assert one(spark, T.diff_words("c0"), "A_b, c-d 1") == ["a_b", "c", "d", "1"]


def test_wrap(spark):
    assert one(spark, T.wrap_two_lines("c0"), "short text") == "short text"
    long = "aaaaaaaaaa bbbbbbbbbb cccccccccc dddddddddd eeeeeeeeee"
    assert one(spark, T.wrap_two_lines("c0"), long) == "aaaaaaaaaa bbbbbbbbbb\ncccccccccc dddddddddd eeeeeeeeee"
    assert one(spark, T.wrap_two_lines("c0"), "x" * 50) == "x" * 50


def test_fence_and_stem(spark):
    assert one(spark, T.strip_fence("c0"), "```json\n{}\n```") == "{}"
    assert one(spark, T.file_stem("c0"), "/a/b.c/d.e.mp3") == "d.e"
    assert one(spark, T.html_escape("c0"), "<a b='\"&'>") == "&lt;a b=&#x27;&quot;&amp;&#x27;&gt;"


def test_nfc(spark):
    assert one(spark, T.nfc(F.col("c0")), "é") == "é"


def test_decomposed(spark):
    """Keys and counts don't depend on how letters are composed, in several scripts and orders of marks."""
    import unicodedata

    texts = ["Việt Nữ ế ệ", "Éclair ñandú", "Ελλάδα ώρα", "Йод ёж", "かがぱ", "한국어 각 가", "কো", "a\u0302\u0323b\n"]
    for t in texts:
        n, d = unicodedata.normalize("NFC", t), unicodedata.normalize("NFD", t)
        want = sum(unicodedata.category(c) not in ("Mn", "Mc", "Me") for c in n.replace("\n", ""))
        assert one(spark, T.char_count("c0"), n) == one(spark, T.char_count("c0"), d) == want, t
        key = "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn").lower().strip()
        both = {one(spark, T.normalize_key(T.nfc("c0")), x) for x in (n, d)}
        assert both == {unicodedata.normalize("NFC", key)}, t
        if not set("한কো") & set(n):
            assert one(spark, T.normalize_key("c0"), n) == one(spark, T.normalize_key("c0"), d)


def test_wrap_by_lengths(spark):
    """Cuts against all cuts tried word by word, blanks in a row and commas among them; a cue of many words makes each cut once."""
    import random

    rnd = random.Random(4)
    texts = [" ".join("x" * rnd.randint(0, 14) + rnd.choice(["", "", ","]) for _ in range(rnd.randint(1, 14))) for _ in range(300)]

    def cut(t):
        w = t.split(" ")
        if len(t) <= 42 or len(w) < 2:
            return t
        both = [(" ".join(w[:k]), " ".join(w[k:]), k) for k in range(1, len(w))]
        a, b, _ = min(both, key=lambda x: (len(x[0]) > 42 or len(x[1]) > 42, abs(len(x[0]) - len(x[1])), len(x[1]) < len(x[0]), not x[0].endswith(","), x[2]))
        return f"{a}\n{b}"

    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.wrap_two_lines("t")).collect()
    assert [r[1] for r in got] == [cut(r[0]) for r in got]
    plan = spark.range(1).select(T.wrap_two_lines(F.lit("a"))).columns[0]
    assert plan.count("array_join") <= 4
