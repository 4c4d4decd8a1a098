"""Secret scans by a trigram inverted index, in DataFrame functions alone.

1. A Boolean trigram query is derived from every rule's regular expression: some alternative must have all of its trigrams.
2. The index has a posting (trigram, document) for each trigram of the rules that a text contains, in lower case.
3. Posting lists of an alternative's trigrams are intersected: a document is a candidate of a rule if it stands in all of them.
4. Candidates are verified by the regular expression. Rules with an alternative without trigrams scan every text.

Documents are posted by a hash of doc_id and text, so that copies are no hot key; two that share a hash share their
candidates, which verification sorts out. Offsets count code points, ends are exclusive. Matches of a kind are leftmost
and don't overlap. Places of matches are sums over all before them, taken by doubling, so that the work grows with
n log n in the matches of a text. No rule repeats a group, and none looks at a run of signs from each of its places, so
that the depth and time of a match stay small on texts that are made of a rule's own prefix.

Edge cases: null text is empty; repeated rows and null doc_id are kept as rows; texts are scanned whole, however long; of
matches of several rules that start together the earlier rule comes first; extra columns, whatever their names, are
ignored (``report``) or carried along (``scan``, ``redact``); an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize


@dataclass(frozen=True)
class Rule:
    """group and least: the group whose length must be at least `least` for a match to count."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base kinds, in their order.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Published formats of other credentials.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
GAP, MOST = "\0", 64


def _alternatives(parsed) -> list[str]:
    """What a match must contain, literal for literal, with GAP where anything may stand; one string for each alternative."""
    found = [""]
    for op, arg in parsed:
        if op is sre.LITERAL:
            new = [chr(arg)]
        elif op is sre.IN and len(arg) <= 8 and all(o is sre.LITERAL for o, _ in arg):
            new = [chr(a) for _, a in arg]
        elif op is sre.SUBPATTERN:
            new = _alternatives(arg[-1])
        elif op is sre.BRANCH:
            new = [x for branch in arg[1] for x in _alternatives(branch)]
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
            new = _alternatives(arg[2])
            if (arg[0], arg[1]) != (1, 1):  # only what one round must contain
                new = [x + GAP for x in new] if arg[0] == 1 or len(new) > 1 else [new[0] * min(arg[0], 8) + GAP]
        elif op is sre.AT:
            new = [""]
        else:
            new = [GAP]
        if len(found) * len(new) > MOST:
            new = [GAP]
        found = [a + b for a in found for b in new]
    return found


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Trigrams in lower case of every alternative; None if an alternative has none, so that the rule must scan fully."""
    found = []
    for x in _alternatives(sre_parser.parse(pattern)):
        grams = {run[k : k + 3] for run in x.lower().split(GAP) for k in range(len(run) - 2)}
        if not grams:
            return None
        found.append(frozenset(grams))
    smallest = [a for a in set(found) if not any(b < a for b in found)]
    return sorted(smallest, key=sorted)


def index_terms(rules: tuple[Rule, ...]) -> list[str]:
    return sorted({g for r in rules for a in trigram_query(r.pattern) or () for g in a})


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _key() -> F.Column:
    return F.xxhash64(F.col("doc_id").cast("string"), "text")


def postings(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """(trigram, key): the inverted index of the rules' trigrams over docs (doc_id, text)."""
    terms = F.array(*map(F.lit, index_terms(rules)))
    low = docs.select(_key().alias("key"), F.lower("text").alias("low"))
    return low.select("key", F.explode(F.filter(terms, lambda t: F.contains(F.col("low"), t))).alias("trigram")).select("trigram", "key")


def candidates(index: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """(key, rules): a bit for each rule of which some alternative's posting lists all hold the document.

    The rules' queries are a small table (rule, alternative, trigram, its bit, all bits), joined to the postings; a
    document is in the intersection of an alternative's lists if it has met all its bits.
    """
    asked = [(k, a, g, 1 << n, (1 << len(grams)) - 1) for k, r in enumerate(rules) for a, grams in enumerate(trigram_query(r.pattern) or ()) for n, g in enumerate(sorted(grams))]
    rows = ", ".join(f"({k}, {a}, {_sql(g)}, {bit}L, {need}L)" for k, a, g, bit, need in asked) or "(0, 0, '', 0L, 1L)"
    query = index.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS q(rule, alternative, trigram, bit, need)")
    met = index.join(F.broadcast(query), "trigram").groupBy("key", "rule", "alternative").agg(F.bit_or("bit").alias("met"), F.max("need").alias("need"))
    return met.where("met = need").groupBy("key").agg(F.expr("bit_or(shiftleft(1L, rule))").alias("rules"))


def spans(rule: Rule, number: int) -> str:
    """SQL for array<struct<s, o, e>> of the matches of a rule in the column text: start, number, end."""
    pattern = _sql(rule.pattern)
    none = "cast(array() AS array<struct<s: int, o: int, e: int>>)"
    # Lengths of what stands before each match and of the match; then their running sums: a sum over 2**k gaps from two over half of them.
    parts = (
        f"transform(array(regexp_extract_all(text, {pattern}, 0)), m -> transform(array(regexp_extract_all(text, {pattern}, {rule.group})), gs -> "
        f"transform(arrays_zip(slice(split(text, {pattern}, -1), 1, size(m)), m, gs), x -> struct(length(x['0']) + length(x.m) AS step, length(x.m) AS len, length(x.gs) >= {rule.least} AS ok)))[0])[0]"
    )
    ends = "aggregate(sequence(0, length(bin(size(p)))), transform(p, x -> x.step), (v, k) -> transform(v, (x, i) -> x + coalesce(get(v, i - shiftleft(1, k)), 0)))"
    placed = f"transform(array({ends}), ends -> transform(filter(transform(p, (x, i) -> struct(x.ok AS ok, x.len AS len, ends[i] AS e)), x -> x.ok), x -> struct(x.e - x.len AS s, {number} AS o, x.e AS e)))[0]"
    found = f"transform(array({parts}), p -> if(size(p) = 0, {none}, {placed}))[0]"
    test = f"text rlike {pattern}" if trigram_query(rule.pattern) is None else f"(rules & {1 << number}L) <> 0"
    return f"if({test}, {found}, {none})"


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """docs with found: array<struct<s, o, e>> of all rules' matches by start, then rule number. A column `found` of docs is replaced.

    The candidates are written first; the join with them is a broadcast where they are few and an exchange of the texts where not.
    """
    row = free_name(["text", "doc_id", "key", "rules"], "row")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(F.col("doc_id"), text.alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row)).withColumn("key", _key())
    hits = materialize(candidates(postings(d.select("doc_id", "text"), rules), rules), "candidates")
    d = d.join(hits, "key", "left").withColumn("rules", F.coalesce("rules", F.lit(0).cast("long")))
    every = F.expr(f"array_sort(concat({', '.join(spans(r, k) for k, r in enumerate(rules))}))")
    kept = [F.col(f"{row}.`{c}`").alias(c) for c in docs.columns if c.lower() != "found"]
    return d.select(*kept, every.alias("found"))


def joined(found: str, rules: tuple[Rule, ...]) -> str:
    """SQL for kind:start:end, comma-joined."""
    kinds = "array(" + ", ".join(_sql(r.kind) for r in rules) + ")"
    return f"array_join(transform({found}, x -> concat({kinds}[x.o], ':', x.s, ':', x.e)), ',')"


def report(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """One row for each row of docs: counts of the base kinds, their digest, and all spans."""
    found = scan(docs.select(F.col("doc_id").cast("long"), "text"), rules).select("doc_id", "found")
    counts = [F.expr(f"cast(size(filter(found, x -> x.o = {k})) AS long)").alias(f"n_{r.kind}") for k, r in enumerate(BASE)]
    base = joined(f"filter(found, x -> x.o < {len(BASE)})", rules)
    return found.select("doc_id", *counts, F.expr(f"sha2(cast({base} AS binary), 256)").alias("base_sha256"), F.expr(joined("found", rules)).alias("spans"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, mark: str = "[secret]") -> DataFrame:
    """docs whose texts have `mark` in place of every found span; of spans that overlap, the whole union is replaced. n_chars follows."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    d = scan(docs.select(row, F.col("doc_id"), F.col("text").cast("string").alias("text")), rules)
    # What the spans before each cover, by doubling; a span that begins behind that begins a union.
    cover = "aggregate(sequence(0, length(bin(size(found)))), transform(found, x -> x.e), (v, k) -> transform(v, (x, i) -> greatest(x, coalesce(get(v, i - shiftleft(1, k)), 0))))"
    first = "filter(transform(found, (x, i) -> struct(x.s AS s, coalesce(get(cover, i - 1), 0) AS at)), x -> x.s >= x.at)"
    pieces = f"array_join(transform({first}, x -> concat(substr(text, x.at + 1, x.s - x.at), {_sql(mark)})), '')"
    out = f"transform(array({cover}), cover -> concat({pieces}, substr(text, array_max(cover) + 1)))[0]"
    d = d.withColumn("new", F.expr(f"if(size(found) = 0, row.text, {out})"))
    changed = {"text": F.col("new"), "n_chars": F.expr("if(size(found) = 0, row.n_chars, length(new))").cast("long") if "n_chars" in docs.columns else None}
    return d.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
