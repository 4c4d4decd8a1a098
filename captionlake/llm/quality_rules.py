"""Quality rules: base counts of every text, then robust multivariate outliers by language and source; DataFrame functions alone.

The five transformed statistics of a document are compared with a minimum-covariance-determinant estimate of its (lang,
source) group. Three starts (medians with quartile ranges; correlations of squashed values; correlations of directions
from the medians) are concentrated by two steps each: a step takes the share ``support`` of the group that is nearest by
Mahalanobis distance and estimates mean and covariance anew. The start with the least determinant then goes on until
its logarithm falls by no more than a hundredth, after six steps at most. Its covariance is made consistent for normal data, and estimated once more
from all documents within the 97.5 % quantile.

Every document has a verdict: estimates are made for a language and for all documents as well, and those of a group are
drawn towards those of its language, and these towards those of all, by the weight ``prior`` against the group's rows.

A share of n units has a sampling error of 1 / (4 n) after the square root, a mean word length one that falls with the
words; these variances (``NOISE``), from a document's own counts, are added to its group's covariance. So the zeros that
most documents have (symbols, repeats) don't make an outlier of every other short document, and no constant floor decides.

All statistics are mergeable aggregates: a step sums the rows by group and class of distance (an eighth of the natural
logarithm), so that it finds the nearest and their moments in one pass; a group with a third of all rows is summed
map-side, and what is joined back is a few numbers for each group.

Edge cases: null or empty text has zero words and fails the base rule; null lang or source is a group of its own; very
long texts are counted whole; of the class of distance at the support's border all are taken; starts of equal determinant give
way to the first; rows that repeat count as often as they stand, and null doc_id is kept as a row; extra columns,
whatever their names, are ignored or carried along (``keep``); an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, materialize

WORDS = r"filter(split(coalesce(cast(text AS string), ''), '[\\x20\\x09-\\x0D]+'), w -> w <> '')"
#: Words of the text in windows of five that occur twice or more: hashes sorted with their places, places in order, gaps summed.
REPEATED = """
transform(array(if(size(words) < 5, array(), transform(sequence(0, size(words) - 5),
    i -> xxhash64(words[i], words[i + 1], words[i + 2], words[i + 3], words[i + 4])))), hs ->
  if(size(array_distinct(hs)) = size(hs), 0L,
    transform(array(array_sort(transform(hs, (h, i) -> struct(h, i)))), s ->
      transform(array(array_sort(filter(transform(s, (x, k) ->
          if(coalesce(get(s, k - 1).h = x.h, false) OR coalesce(get(s, k + 1).h = x.h, false), x.i, -1)), i -> i >= 0))), p ->
        aggregate(transform(p, (x, k) -> coalesce(least(5, get(p, k + 1) - x), 5)), 0L, (a, n) -> a + n))[0])[0]))[0]
"""
LINES = r"filter(split(coalesce(cast(text AS string), ''), '\\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"

STATS = ("x0", "x1", "x2", "x3", "x4")
#: Forms of the statistics: ln words, ln mean word length, roots of the shares of symbols, repeated words and repeated lines.
FORMS = ("ln(n)", "ln(c / n)", "sqrt(n_symbols / c)", "sqrt(n_repeat_words / n)", "sqrt(n_dup_lines / l)")
#: Sampling variances of the forms. Word lengths vary by about half their mean; symbols come by words; a repeat has ten words at least, so that ten words are a unit.
NOISE = ("0D", "0.25D / n", "0.25D / n", "2.5D / n", "0.25D / l")
PAIRS = [(i, j) for i in range(5) for j in range(i + 1)]
ESTIMATE = [f"m{i}" for i in range(5)] + [f"r{i}{j}" for i, j in PAIRS]
ACCURACY, MOST_BROADCAST = 2000, 200_000


def chi_square(x: float, odd: int) -> float:
    """Distribution function of chi-square with an odd number of degrees of freedom."""
    term, total = 1.0, 0.0
    for k in range(1, odd - 1, 2):
        term = term * (x / k) if k > 1 else 1.0
        total += term
    return math.erf(math.sqrt(x / 2)) - math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * total


def chi_square_quantile(share: float, odd: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square(mid, odd) < share else (lo, mid)
    return hi


def consistency(share: float) -> float:
    """What the covariance of the nearest `share` of normal rows is multiplied by to be that of all."""
    return share / chi_square(chi_square_quantile(share, 5), 7)


def base_counts(docs: DataFrame, more: str | None = None) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, and the column `more` of docs."""
    text = F.expr("coalesce(cast(text AS string), '')")
    more = [more] if more else []
    d = docs.select(
        F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), F.expr(WORDS).alias("words"), F.expr(LINES).alias("lines"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"), *more,
    )
    return d.select(
        "doc_id", "lang", "source", F.size("words").cast("long").alias("n_words"),
        F.expr("aggregate(words, 0L, (a, w) -> a + length(w))").alias("word_chars"), "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.expr(REPEATED).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"), *more,
    ).withColumn("base_failed", F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words"))


def _transformed(rows: DataFrame) -> DataFrame:
    """rows with the statistics x_i, their sampling variances u_i, and the keys g0, g1, g2 of all, the language and the group."""
    units = {"n": "greatest(n_words, 1L)", "c": "greatest(word_chars, 1L)", "l": "greatest(n_lines, 1L)"}

    def spelt(form: str) -> F.Column:
        for name, unit in units.items():
            form = re.sub(rf"\b{name}\b", unit, form)
        return F.expr(form)

    rows = rows.withColumns({**dict(zip(STATS, map(spelt, FORMS))), **{f"u{i}": spelt(x) for i, x in enumerate(NOISE)}})
    # Hashes skip null, so that what is null is hashed too.
    return rows.withColumns({"g0": F.lit(0).cast("long"), "g1": F.expr("xxhash64(1, lang IS NULL, lang)"), "g2": F.expr("xxhash64(2, lang IS NULL, lang, source IS NULL, source)")})


def _column(j: int) -> dict[str, F.Column]:
    """Column j of the elimination of the covariance c_ij with the noise u_i added: r_ij, of which r_jj are the pivots."""
    own = lambda i: f"c{i}{j} + u{i} + 1e-9D" if i == j else f"c{i}{j}"
    rest = lambda i: " - ".join([own(i)] + [f"r{i}{k} * r{j}{k} / r{k}{k}" for k in range(j)])
    return {f"r{i}{j}": F.expr(f"greatest({rest(i)}, 1e-12D)" if i == j else rest(i)) for i in range(j, 5)}


def _solved(j: int) -> dict[str, F.Column]:
    """Entry j of the deviation from the means m_i, eliminated alike."""
    return {f"y{j}": F.expr(" - ".join([f"x{j} - m{j}"] + [f"y{k} * r{j}{k} / r{k}{k}" for k in range(j)]))}


D2 = " + ".join(f"y{i} * y{i} / r{i}{i}" for i in range(5))


def _root(groups: DataFrame) -> DataFrame:
    """groups with r_ij and the logarithm of the determinant. One projection for each column keeps the generated code small."""
    for j in range(5):
        groups = groups.withColumns(_column(j))
    return groups.withColumn("det", F.expr(" + ".join(f"ln(r{i}{i})" for i in range(5))))


def _distance(rows: DataFrame) -> DataFrame:
    """rows (x_i, m_i, r_ij) with d2."""
    for j in range(5):
        rows = rows.withColumns(_solved(j))
    return rows.withColumn("d2", F.expr(D2))


def _by_group(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """rows beside what their group has: by a broadcast up to MOST_BROADCAST rows of groups (some 50 MB), so that no group is one task; else by key."""
    return rows.join(F.broadcast(groups) if groups.count() <= MOST_BROADCAST else groups, "grp")


def _starts(rows: DataFrame) -> DataFrame:
    """(grp, start, u_i, m_i, c_ij): three first estimates for each group."""
    q = rows.groupBy("grp").agg(
        *[F.percentile_approx(x, [0.25, 0.5, 0.75], ACCURACY).alias(f"q{i}") for i, x in enumerate(STATS)], *[F.avg(f"u{i}").alias(f"u{i}") for i in range(5)],
    )
    q = q.select("grp", *[f"u{i}" for i in range(5)], *[F.expr(f"q{i}[1]").alias(f"m{i}") for i in range(5)], *[
        F.expr(f"pow((q{i}[2] - q{i}[0]) / 1.349D, 2)").alias(f"v{i}") for i in range(5)
    ])
    q = materialize(q, "quartiles")
    z = _by_group(rows.select("grp", *STATS), q).select("grp", *[F.expr(f"(x{i} - m{i}) / sqrt(v{i} + u{i} + 1e-9D)").alias(f"z{i}") for i in range(5)])
    z = z.withColumn("size", F.expr("sqrt(" + " + ".join(f"z{i} * z{i}" for i in range(5)) + ") + 1e-9D"))
    z = z.select("grp", *[F.tanh(f"z{i}").alias(f"t{i}") for i in range(5)], *[F.expr(f"z{i} / size").alias(f"s{i}") for i in range(5)])
    r = z.groupBy("grp").agg(*[F.covar_pop(f"{k}{i}", f"{k}{j}").alias(f"{k}{i}{j}") for k in "ts" for i, j in PAIRS])
    r = r.select("grp", *[F.expr(f"coalesce(try_divide({k}{i}{j}, sqrt({k}{i}{i} * {k}{j}{j})), 0D)").alias(f"{k}{i}{j}") for k in "ts" for i, j in PAIRS if i != j])
    r = materialize(q.join(r, "grp"), "correlations")
    found = None
    for start, k in enumerate(("", "t", "s")):
        c = [(F.col(f"v{i}") if i == j else F.expr(f"{k}{i}{j} * sqrt(v{i} * v{j})") if k else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS]
        one = r.select("grp", F.lit(start).alias("start"), *[f"u{i}" for i in range(5)], *[f"m{i}" for i in range(5)], *c)
        found = one if found is None else found.union(one)
    return found


def _concentrated(rows: DataFrame, groups: DataFrame, support: float) -> DataFrame:
    """groups (grp, start, u_i, m_i, r_ij) after a step, with n, c_ij, the determinant and the one before."""
    near = _distance(_by_group(rows.select("grp", *STATS), groups.select("grp", "start", *ESTIMATE)))
    near = near.select("grp", "start", F.expr("cast(floor(8 * ln(greatest(d2, 1e-9D))) AS int)").alias("far"), *STATS)
    sums = [F.count(F.lit(1)).alias("n")] + [F.sum(x).alias(f"s{i}") for i, x in enumerate(STATS)] + [F.sum(F.expr(f"x{i} * x{j}")).alias(f"s{i}{j}") for i, j in PAIRS]
    by = Window.partitionBy("grp", "start")
    classes = near.groupBy("grp", "start", "far").agg(*sums)
    classes = classes.withColumns({"all": F.sum("n").over(by), "before": F.sum("n").over(by.orderBy("far").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")})
    names = ["n"] + [f"s{i}" for i in range(5)] + [f"s{i}{j}" for i, j in PAIRS]
    inside = classes.where(f"before < {support} * all").groupBy("grp", "start").agg(F.max("all").alias("all"), *[F.sum(x).alias(x) for x in names])
    factor = consistency(support)
    moments = inside.select("grp", "start", F.col("all").alias("n"), *[F.expr(f"s{i} / n").alias(f"m{i}") for i in range(5)], *[
        F.expr(f"{factor}D * (s{i}{j} / n - (s{i} / n) * (s{j} / n))").alias(f"c{i}{j}") for i, j in PAIRS
    ])
    return _root(moments.join(groups.select("grp", "start", F.col("det").alias("was"), *[f"u{i}" for i in range(5)]), ["grp", "start"]))


def mcd(rows: DataFrame, support: float = 0.75, most: int = 6) -> DataFrame:
    """One row for each grp: n, means m_i and covariance c_ij. rows: grp, x_i and u_i."""
    groups = materialize(_root(_starts(rows)), "mcd")
    for _ in range(2):
        groups = materialize(_concentrated(rows, groups, support), "mcd")
    best = groups.groupBy("grp").agg(F.min(F.struct("det", "start")).alias("x")).select("grp", "x.start")
    groups = materialize(groups.join(materialize(best, "best"), ["grp", "start"], "left_semi"), "mcd")
    for _ in range(most):
        fell = materialize(_concentrated(rows, groups, support).where("was - det > 0.01"), "fell")
        if fell.isEmpty():
            break
        groups = materialize(groups.join(fell.select("grp"), "grp", "left_anti").unionByName(fell), "mcd")
    within = 0.975
    near = _distance(_by_group(rows.select("grp", *STATS), groups.select("grp", *ESTIMATE))).where(f"d2 <= {chi_square_quantile(within, 5)}D")
    moments = near.groupBy("grp").agg(
        *[F.avg(x).alias(f"m{i}") for i, x in enumerate(STATS)], *[(F.covar_pop(STATS[i], STATS[j]) * consistency(within)).alias(f"c{i}{j}") for i, j in PAIRS],
    )
    return materialize(moments.join(groups.select("grp", "n"), "grp"), "estimates")


def _drawn(child: DataFrame, parent: DataFrame, on: str, prior: float) -> DataFrame:
    """child (on, key, n, m_i, c_ij) drawn towards parent (on, m_i, c_ij); a child without rows is its parent.

    The shift between the two counts as spread by the square of the child's weight, so that a single document can't widen
    what it is judged by.
    """
    names = [f"m{i}" for i in range(5)] + [f"c{i}{j}" for i, j in PAIRS]
    p = parent.select(F.col("key").alias(on), *[F.col(x).alias(f"p{x}") for x in names])
    d = child.join(p, on, "left").withColumn("w", F.expr(f"coalesce(n, 0L) / (coalesce(n, 0L) + {prior}D)"))
    mean = [F.expr(f"coalesce(w * m{i} + (1 - w) * pm{i}, m{i}, pm{i})").alias(f"m{i}") for i in range(5)]
    cov = [F.expr(f"coalesce(w * c{i}{j} + (1 - w) * pc{i}{j} + w * w * (1 - w) * (m{i} - pm{i}) * (m{j} - pm{j}), c{i}{j}, pc{i}{j})").alias(f"c{i}{j}") for i, j in PAIRS]
    return d.select("key", *mean, *cov)


def estimates(rows: DataFrame, support: float = 0.75, prior: float = 50.0) -> DataFrame:
    """(g2, m_i, c_ij) for every group of rows; what fails the base rules says nothing about the others."""
    keys = F.explode(F.array("g0", "g1", "g2")).alias("grp")
    found = mcd(rows.where("NOT base_failed").select(keys, *STATS, *[f"u{i}" for i in range(5)]), support)
    named = materialize(rows.select("g0", "g1", "g2").distinct(), "groups")
    whole = found.where("grp = 0").withColumnRenamed("grp", "key")
    level = lambda key, on: named.select(F.col(key).alias("key"), F.col(on)).distinct().join(found.withColumnRenamed("grp", "key"), "key", "left")
    langs = _drawn(level("g1", "g0"), whole, "g0", prior)
    return materialize(_drawn(level("g2", "g1"), langs, "g1", prior).withColumnRenamed("key", "g2"), "drawn")


def _judged(rows: DataFrame, groups: DataFrame, cutoff: float) -> DataFrame:
    d = rows.join(groups, "g2", "left")
    for j in range(5):
        d = d.withColumns(_column(j)).withColumns(_solved(j))
    d = d.withColumn("d2", F.expr(D2))
    return d.withColumn("distance", F.expr("sqrt(d2)")).withColumn("kept", F.expr(f"NOT base_failed AND coalesce(d2 <= {cutoff}D, true)"))


#: Documents further off than all but one in a million of normal rows are outliers.
CUTOFF = chi_square_quantile(1 - 1e-6, 5)


def quality_rules(docs: DataFrame, cutoff: float = CUTOFF, support: float = 0.75, prior: float = 50.0) -> DataFrame:
    """One row for each row of docs: the base counts, base_failed, distance (null if no document passes the base rules) and kept."""
    rows = materialize(_transformed(base_counts(docs)), "stats")
    return _judged(rows, estimates(rows, support, prior), cutoff).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept"
    )


def keep(docs: DataFrame, cutoff: float = CUTOFF, support: float = 0.75, prior: float = 50.0) -> DataFrame:
    """The rows of docs that are kept. Rows are written once beside their counts, so that no text is counted twice or moved by key."""
    row = free_name(docs.columns, "row")
    packed = docs.withColumn(row, F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    counted = materialize(_transformed(base_counts(packed, row)), "counted")
    judged = _judged(counted, estimates(counted.drop(row), support, prior), cutoff)
    # A filter on a generated column stays above it: pushed down, it would spell out the elimination, whose size doubles with each column.
    return judged.select(row, F.explode(F.array("kept")).alias("stays")).where("stays").select(f"{row}.*")
