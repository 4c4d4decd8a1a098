"""DuckDB SQL of the scans, written out from their rules."""

from __future__ import annotations

import re

from .licenses import RULES, SENTENCES, _signs, normalised
from .secrets import BASE, MORE

_MARKS = "[*/#>|\\s-]"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _either_case(pattern: str) -> str:
    """(?i:...) with letters spelt in both cases, since RE2 would also fold letters beyond ASCII."""
    spelt = lambda m: re.sub("[a-z]", lambda x: f"[{x[0].upper()}{x[0]}]", m[1])
    return re.sub(r"\(\?i:([^)]*)\)", lambda m: "(?:" + spelt(m) + ")", pattern)


def secrets_sql() -> str:
    rules = BASE + MORE
    found = []
    for k, r in enumerate(rules):
        p = _quoted(_either_case(re.sub(r"\(\?<![^)]*\)", "", r.pattern)))  # RE2 has no look-behind: a token may also begin inside a run
        size = lambda x: f"coalesce(list_sum(list_transform({x}, lambda y: length(y))), 0)"
        start = f"{size('s[1:i]')} + {size('m[1:i - 1]')}"
        spans = f"list_transform(list_filter(range(1, len(m) + 1), lambda i: length(g[i]) >= {r.least}), lambda i: {{'s': CAST({start} AS BIGINT), 'o': {k}, 'e': CAST({start} + length(m[i]) AS BIGINT)}})"
        found.append(f"(SELECT {spans} FROM (SELECT regexp_extract_all(t, {p}, 0) AS m, regexp_split_to_array(t, {p}) AS s, regexp_extract_all(t, {p}, {r.group}) AS g))")
    kinds = "[" + ", ".join(_quoted(r.kind) for r in rules) + "]"
    text = lambda x: f"coalesce(array_to_string(list_transform({x}, lambda x: {kinds}[x.o + 1] || ':' || x.s || ':' || x.e), ','), '')"
    every = found[0]
    for f in found[1:]:
        every = f"list_concat({every}, {f})"
    counts = ", ".join(f"CAST(len(list_filter(f, lambda x: x.o = {k})) AS BIGINT) AS n_{r.kind}" for k, r in enumerate(BASE))
    base = f"list_filter(f, lambda x: x.o < {len(BASE)})"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), x AS (SELECT doc_id, list_sort({every}) AS f FROM d)
SELECT doc_id, {counts}, sha256({text(base)}) AS base_sha256, {text('f')} AS spans FROM x"""


def licenses_sql() -> str:
    signs = _signs(SENTENCES)
    known = "MAP {" + ", ".join(f"{_quoted(normalised(s))}: {_quoted(signs[n])}" for n, s in SENTENCES.items()) + "}"
    ordered = sorted(RULES, key=lambda r: -len(r[0]))
    joined = {"".join(signs[n] for n in names): licence for names, licence in ordered}
    shown = "MAP {" + ", ".join(f"{_quoted(a)}: {_quoted(b)}" for a, b in joined.items()) + "}"
    longest = max(len(normalised(s)) for s in SENTENCES.values())
    cut = f"regexp_replace(regexp_replace(coalesce(text, ''), '([.!?;:]){_MARKS}+', '\\1' || chr(1), 'g'), '\\s*\\n{_MARKS}*', chr(1), 'g')"
    norm = "trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))"
    return f"""WITH p AS (SELECT doc_id, string_split({cut}, chr(1)) AS parts FROM documents),
q AS (SELECT doc_id, array_to_string(list_transform(parts, lambda s: CASE WHEN length(s) <= {2 * longest} THEN coalesce({known}[{norm}], '.') ELSE '.' END), '') AS sequence FROM p)
SELECT doc_id, CAST(length(replace(sequence, '.', '')) AS BIGINT) AS n_known,
  array_to_string(list_transform(regexp_extract_all(sequence, {_quoted('|'.join(joined))}), lambda x: {shown}[x]), ',') AS licenses FROM q"""


#: crc32 of doc_id as text, bit by bit.
CRC = """xor(4294967295, list_reduce(
    list_transform(range(8 * length(doc_id::VARCHAR)), lambda k: (ord(substr(doc_id::VARCHAR, k // 8 + 1, 1))::BIGINT >> (k % 8)) & 1),
    lambda c, b: xor(c >> 1, CASE WHEN (c & 1) <> b THEN 3988292384 ELSE 0 END), 4294967295))"""


def merkle_sql() -> str:
    """Trees level by level, then every leaf folded up to the root."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    whole = lambda text: "sha256(" + " || ".join([*map(field, ("doc_id", "source", "lang", "n_chars")), field(text)]) + ")"

    def tree(name: str, leaves: str, group: str) -> str:
        return f"""
{name}_up AS (
  SELECT {group} AS g, 0 AS lv, i, h, n FROM {leaves}
  UNION ALL
  SELECT g, lv + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM {name}_up WHERE n > 1 GROUP BY g, lv, i // 3, n
), {name}_side AS (
  SELECT u.g, u.lv, u.i, coalesce(string_agg(v.h, '' ORDER BY v.i) FILTER (v.i < u.i), '') AS before, coalesce(string_agg(v.h, '' ORDER BY v.i) FILTER (v.i > u.i), '') AS after
  FROM {name}_up u JOIN {name}_up v ON u.g = v.g AND u.lv = v.lv AND u.i // 3 = v.i // 3 WHERE u.n > 1 GROUP BY u.g, u.lv, u.i
)"""

    def fold(name: str, start: str) -> str:
        return f"""
{name}_fold AS (
  {start}
  UNION ALL
  SELECT d, f.g, f.lv + 1, f.i // 3, sha256(before || h || after), proof || before || after
  FROM {name}_fold f JOIN {name}_side s ON f.g = s.g AND f.lv = s.lv AND f.i = s.i
)"""

    return f"""
WITH RECURSIVE base AS (
  SELECT row_number() OVER () AS d, doc_id, coalesce('=' || source, '') AS g, {whole("text")} AS leaf,
    {whole("t")} AS claimed
  FROM (SELECT *, CASE WHEN text IS NOT NULL AND doc_id IS NOT NULL AND crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS t FROM (SELECT *, {CRC} AS crc FROM documents))
), leaves AS (
  SELECT *, leaf AS h, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM base
), {tree("low", "leaves", "g")},
tops AS (SELECT g AS src, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM low_up WHERE n = 1),
{tree("high", "tops", "'all'")},
{fold("low", "SELECT d, g, 0 AS lv, i, claimed AS h, '' AS proof FROM leaves")},
low_end AS (SELECT d, g, h, proof FROM low_fold QUALIFY row_number() OVER (PARTITION BY d ORDER BY lv DESC) = 1),
{fold("high", "SELECT e.d, 'all' AS g, 0 AS lv, t.i, e.h, e.proof FROM low_end e JOIN tops t ON e.g = t.src")},
high_end AS (SELECT d, h, proof FROM high_fold QUALIFY row_number() OVER (PARTITION BY d ORDER BY lv DESC) = 1)
SELECT l.doc_id, l.leaf, t.h AS subroot, r.h AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root, e.h = r.h AS verified
FROM leaves l JOIN tops t ON l.g = t.src JOIN high_end e USING (d), (SELECT h FROM high_up WHERE n = 1) r
"""
