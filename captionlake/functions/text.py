"""Column functions on texts."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _marked_letters() -> tuple[str, str]:
    """Lower-case letters of any script that decompose into one letter and marks, and that letter; and d with stroke."""
    pairs = [("đ", "d")]
    for code in (*range(0xDF, 0x1100), *range(0x1E00, 0x2C00), *range(0x3040, 0x3100)):
        c = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if base != c and len(base) == 1 and unicodedata.category(c) in ("Ll", "Lo") and "'" not in base:
            pairs.append((c, base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


MARKED, PLAIN = _marked_letters()


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tokens(text) -> Column:
    """Words between runs of white space; never empty ones."""
    return F.filter(F.split(col(text), r"[ \n\t\r\x0B\f]+"), lambda t: t != "")


@F.pandas_udf(StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Canonical composition, which the JVM functions lack; needed only where texts aren't composed already."""
    return s.str.normalize("NFC")


#: Korean syllables that composition makes one sign: of single letters, and of a syllable without a final letter and one.
SYLLABLE = "[\u1100-\u1112][\u1161-\u1175][\u11A8-\u11C2]?|[" + "".join(chr(c) for c in range(0xAC00, 0xD7A4, 28)) + "][\u11A8-\u11C2]"


def char_count(text) -> Column:
    """Characters of a text, composed or decomposed, without line breaks and combining marks.

    A letter and its marks are one character either way, since marks aren't counted; Korean syllables are the one
    composition besides that changes the count, and only texts with their single letters are looked at. Texts of one byte
    a character have none of these, and are counted without a pattern.
    """
    text = col(text)
    one = F.when(text.rlike("[\u1161-\u11C2]"), F.regexp_replace(text, SYLLABLE, "\uAC00")).otherwise(text)
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.length(F.replace(text, F.lit("\n"), F.lit("")))).otherwise(F.length(F.regexp_replace(one, r"[\p{M}\n]", ""))).cast("long")


def plain_letters(text) -> Column:
    return F.translate(F.regexp_replace(F.lower(col(text)), r"\p{Mn}", ""), MARKED, PLAIN)


def normalize_key(text) -> Column:
    """Comparison key of a title: no marks, lower case, single spaces; equal for composed and decomposed letters of all scripts
    but Korean syllables and the Indic vowel signs of two parts, whose titles go through nfc() first."""
    return F.trim(F.regexp_replace(plain_letters(text), r"\s+", " "))


def normalize_word(text) -> Column:
    """Letters a to z and apostrophes of a word."""
    return F.regexp_replace(F.replace(plain_letters(text), F.lit("’"), F.lit("'")), r"[^a-z']", "")


def diff_words(text) -> Column:
    return F.regexp_extract_all(F.lower(col(text)), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def seam_word(text) -> Column:
    return F.regexp_replace(F.lower(col(text)), r"[^\p{L}\p{N}_]", "")


def html_key(text) -> Column:
    return F.regexp_replace(F.lower(col(text)), "[^0-9a-zà-ỹ']", "")


def html_escape(text) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(col(text), F.lit(a), F.lit(b))
    return text


def one_line(text, most: int = 200) -> Column:
    return F.substring(F.trim(F.regexp_replace(col(text), r"\s+", " ")), 1, most)


def file_stem(name) -> Column:
    """Without folders and the last extension; a leading dot is no extension."""
    return F.regexp_replace(F.regexp_replace(col(name), r"^.*[/\\]", ""), r"(?<=.)\.[^.]*$", "")


def strip_fence(text) -> Column:
    """A reply without its surrounding code fence."""
    inner = F.regexp_replace(F.trim(col(text)), r"^```[a-zA-Z]*[ \t]*\n?", "")
    return F.trim(F.regexp_replace(inner, r"\n?[ \t]*```$", ""))


def two(n) -> Column:
    """At least two digits."""
    s = n.cast("string")
    return F.when(n < 10, F.concat(F.lit("0"), s)).otherwise(s)


def srt_time(ms) -> Column:
    """HH:MM:SS,mmm of whole milliseconds; before zero is zero, hours have no bound."""
    t = F.greatest(col(ms), F.lit(0)).cast("long")
    part = lambda k: F.floor(t / k).cast("long")
    return F.concat(two(part(3_600_000)), F.lit(":"), two(part(60_000) % 60), F.lit(":"), two(part(1000) % 60), F.lit(","), F.lpad((t % 1000).cast("string"), 3, "0"))


def min_sec(ms) -> Column:
    t = F.floor(col(ms) / 1000).cast("long")
    return F.concat(two(F.floor(t / 60).cast("long")), F.lit(":"), two(t % 60))


def hour_min_sec(ms) -> Column:
    t = F.floor(col(ms) / 1000).cast("long")
    return F.concat(two(F.floor(t / 3600).cast("long")), F.lit(":"), two(F.floor(t / 60).cast("long") % 60), F.lit(":"), two(t % 60))


def duration(ms) -> Column:
    """H:MM:SS, or M:SS below an hour; N/A where unknown."""
    t = F.floor(col(ms) / 1000).cast("long")
    h, m = F.floor(t / 3600).cast("long"), F.floor(t / 60).cast("long") % 60
    long = F.concat(h.cast("string"), F.lit(":"), two(m), F.lit(":"), two(t % 60))
    return F.when(col(ms).isNull(), "N/A").when(h > 0, long).otherwise(F.concat(m.cast("string"), F.lit(":"), two(t % 60)))


def srt_cues(text) -> Column:
    """Texts of the cues of an SRT file: blocks with a time line and text, lines joined by a space."""
    clean = F.regexp_replace(F.regexp_replace(col(text), r"\r\n?", "\n"), "^﻿", "")
    blocks = F.split(clean, r"\n[ \t\n]*\n")

    def one(block):
        lines = F.filter(F.transform(F.split(block, "\n"), lambda x: F.trim(x)), lambda x: x != "")
        at = F.array_position(F.transform(lines, lambda x: F.contains(x, F.lit("-->"))), F.lit(True))
        return F.when(at > 0, F.array_join(F.slice(lines, at.cast("int") + 1, F.size(lines)), " ")).otherwise("")

    return F.filter(F.transform(blocks, one), lambda x: x != "")


def wrap_two_lines(text, cpl: int = 42) -> Column:
    """Text over cpl characters is cut at the word that makes two valid lines of nearest length; then the first line not longer, then after a comma, then early."""
    text = col(text)
    words = F.split(text, " ")
    with_one = lambda value, f: F.transform(F.array(value), f)[0]  # noqa: E731  f of a value that is made once
    total = lambda n: F.aggregate(n, F.lit(0).cast("long"), lambda x, y: x + y)

    def cut(s):
        """s: the words, and how many characters each has."""
        w, n = s["w"], s["n"]
        firsts = F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda k: F.struct(k.alias("k"), (total(F.slice(n, 1, k)) + k - 1).alias("na")))

        def option(x, rest):
            k, na, nb = x["k"], x["na"], rest - x["na"]
            return F.struct(
                ((na > cpl) | (nb > cpl)).cast("int").alias("bad"), F.abs(na - nb).alias("gap"), (nb < na).cast("int").alias("top"),
                (~F.endswith(w[k - 1], F.lit(","))).cast("int").alias("no_comma"), k.alias("k"),
            )

        best = with_one(total(n) + F.size(w) - 2, lambda rest: F.array_min(F.transform(firsts, lambda x: option(x, rest)))["k"])
        return with_one(best, lambda k: F.concat(F.array_join(F.slice(w, 1, k), " "), F.lit("\n"), F.array_join(F.slice(w, k + 1, F.size(w)), " ")))

    made = with_one(F.struct(words.alias("w"), F.transform(words, char_count).alias("n")), cut)
    return F.when((char_count(text) > cpl) & (F.size(words) >= 2), made).otherwise(text)
