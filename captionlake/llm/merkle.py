"""Merkle manifest of a table: a digest of every row, a tree over each source's rows, a tree over the sources, proofs.

Rows are range-sorted by group and key as an RDD. Each partition counts its first and its last group; from these counts the
driver gets the place of a partition's rows in their groups, which is all it holds. A partition then builds the complete
aligned subtrees of its own rows, of at most ``3 ** local`` leaves, so that its memory does not grow with it. Nodes
whose runs go beyond the partition or the subtree are ragged: they are shuffled by coordinate (group, level, index), a
band of ``band`` levels at a time, which finishes the upper levels whatever the size of a group. Going down again, each
ragged node gets its path to the root, and each leaf the path of the node that its subtree ends in. The trees over the
subroots are built the same way, so that sources may be many.

A path is a list of (left, right), the texts of the digests before and after one's own in each run up to the root.

Edge cases: null fields are marked as such and differ from empty ones; a null source is a source of its own and comes first;
a null doc_id comes first in its source; equal doc_ids go by digest, so repeated rows are leaves of their own with the
same digest; long texts are hashed whole; other columns are carried along, whatever their names; a lone leaf is its own
root with an empty path; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, groupby, islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize

#: Nodes in a run; levels of the subtrees that a partition builds; levels that are finished in one shuffle.
ARITY, LOCAL, BAND = 3, 9, 6
PATH = "array<struct<left: string, right: string>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(fields: tuple[str, ...] = FIELDS, **instead: Column) -> Column:
    """The digest of a row's fields: each `-` if null, else its UTF-8 size, a colon and itself. instead: columns in place of fields."""
    text = [instead.get(c, F.col(f"`{c}`")).cast("string") for c in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that a path leads to from a leaf's digest."""
    return F.aggregate(path, start, lambda at, step: F.sha2(F.concat(step["left"], at, step["right"]), 256))


def proof_text(path: Column) -> Column:
    """The digest of all siblings of a path in order."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def height(n: int) -> int:
    """Levels above n leaves until one node is left."""
    up = 0
    while n > 1:
        n, up = -(-n // ARITY), up + 1
    return up


def aside(run: list[str]) -> list[tuple[str, str]]:
    """What stands left and right of each node of a run."""
    return [("".join(run[:k]), "".join(run[k + 1 :])) for k in range(len(run))]


def subtrees(start: int, leaves: list[str], ends: bool, top: int) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, list]]]:
    """The ragged nodes (level, index, digest) of the leaves from `start` on, and for each leaf the level and index of the
    one above it and the path up to it. ends: the group has no leaf after these; top: the level to stop at."""
    ragged: list[tuple[int, int, str]] = []
    levels: list[tuple[int, int, int, list]] = []  # first index, nodes, index where complete runs begin, siblings in them
    at, nodes = start, leaves
    for level in range(top + 1):
        last = at + len(nodes)
        up, until = -(-at // ARITY), -(-last // ARITY) if ends else last // ARITY
        if level == top or up >= until:
            ragged += [(level, at + k, h) for k, h in enumerate(nodes)]
            levels.append((at, len(nodes), last, []))
            break
        begin, beyond = ARITY * up, min(ARITY * until, last)
        ragged += [(level, k, nodes[k - at]) for k in chain(range(at, begin), range(beyond, last))]
        runs = [nodes[k - at : k - at + ARITY] for k in range(begin, beyond, ARITY)]
        levels.append((at, len(nodes), begin, [s for run in runs for s in aside(run)]))
        at, nodes = up, [digest(run) for run in runs]
    # From the top down: where the node of a level ends up, and the steps to there.
    above: list[tuple[int, int, list]] = []
    higher = 0
    for level in range(len(levels) - 1, -1, -1):
        first, n, begin, siblings = levels[level]
        here = []
        for index in range(first, first + n):
            if begin <= index < begin + len(siblings):
                to, place, steps = above[index // ARITY - higher]
                here.append((to, place, [siblings[index - begin], *steps]))
            else:
                here.append((level, index, []))
        above, higher = here, first
    return ragged, above


def _ends(rows: Iterator, group: int) -> tuple | None:
    """The first and the last group of a partition and the rows of each."""
    first = last = None
    for g, part in groupby(rows, key=lambda r: r[group]):
        last = (g, sum(1 for _ in part))
        first = first or last
    return first and (*first, *last)


def _places(ends: list[tuple[int, tuple]]) -> dict[int, tuple[int, str, int]]:
    """For each partition: the rows that its first group has before it, its last group and the rows of that in all."""
    where, running = {}, None  # running: [group, rows so far], shared by the partitions that a group goes through
    for p, (g, n, h, m) in sorted(ends):
        if running is None or running[0] != g:
            running = [g, 0]
        before = running[1]
        running[1] += n
        if h != g:
            running = [h, m]
        where[p] = (before, running)
    return {p: (before, *last) for p, (before, last) in where.items()}


def _pieces(rows: Iterator, group: int, place: tuple[int, str, int], local: int) -> Iterator[tuple[str, int, list, bool]]:
    """(group, index of the first row, rows, whether the group ends with them): what one subtree of `local` levels holds."""
    most = ARITY**local
    at, final, total = place
    for g, part in groupby(rows, key=lambda r: r[group]):
        piece = list(islice(part, most - at % most))
        while piece:
            more = list(islice(part, most))
            yield g, at, piece, not more and (g != final or at + len(piece) == total)
            at, piece = at + len(piece), more
        at = 0


def _build(rows: Iterator, group: int, leaf: int, place: tuple[int, str, int], local: int) -> Iterator[tuple]:
    """(group, rows, ragged nodes, what is above each row) of the pieces of a partition."""
    for g, at, piece, ends in _pieces(rows, group, place, local):
        top = height(len(piece)) if ends and not at else local
        yield g, piece, *subtrees(at, [r[leaf] for r in piece], ends, top)


def tree(rows: DataFrame, group: str, order: list[Column], leaf: str, out: str, local: int = LOCAL, band: int = BAND) -> DataFrame:
    """rows with columns `out`_path (steps up to the group's root) and `out`_root. group: a column without nulls.

    order sorts the rows of a group; rows that it holds equal go by leaf.
    """
    level, idx, steps = (free_name([*rows.columns, f"{out}_path", f"{out}_root"], n) for n in ("level", "idx", "steps"))
    columns = rows.columns
    g, h = columns.index(group), columns.index(leaf)
    keys = [F.col(group), *order, F.col(leaf)]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).rdd
    ends = [e for e in ordered.mapPartitionsWithIndex(lambda p, it: [(p, _ends(it, g))]).collect() if e[1]]
    places = ordered.context.broadcast(_places(ends))
    built = lambda p, it: _build(it, g, h, places.value[p], local) if p in places.value else ()
    spark = rows.sparkSession
    nodes = spark.createDataFrame(
        ordered.mapPartitionsWithIndex(lambda p, it: ((name, *node) for name, _, ragged, _ in built(p, it) for node in ragged)),
        "g string, level int, idx long, hash string", verifySchema=False,
    )
    sizes = rows.groupBy(F.col(group).alias("g")).agg(F.count(F.lit(1)).alias("size"))
    upper = _upper(materialize(nodes, "ragged"), materialize(sizes, "sizes"), band)
    schema = rows.select("*", F.lit(0).alias(level), F.lit(0).cast("long").alias(idx), F.lit(None).cast(PATH).alias(steps)).schema
    leaves = spark.createDataFrame(
        ordered.mapPartitionsWithIndex(lambda p, it: ((*row, *end) for _, piece, _, above in built(p, it) for row, end in zip(piece, above))),
        schema, verifySchema=False,
    )
    upper = upper.select(F.col("g").alias("_g"), F.col("level").alias("_level"), F.col("idx").alias("_idx"), F.col("path").alias("_path"), F.col("root").alias("_root"))
    same = (leaves[group] == upper["_g"]) & (leaves[level] == upper["_level"]) & (leaves[idx] == upper["_idx"])
    return leaves.join(upper, same).select(*[leaves[f"`{c}`"] for c in columns], F.concat(leaves[steps], upper["_path"]).alias(f"{out}_path"), upper["_root"].alias(f"{out}_root"))


def _climb(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
    """The nodes of a band below one node: its digest, and the path of each to it."""
    group, top, index = key
    top, size = int(top), int(nodes["size"].iloc[0])
    given: dict[int, dict[int, str]] = {}
    for lv, i, h in zip(nodes["level"], nodes["idx"], nodes["hash"]):
        given.setdefault(int(lv), {})[int(i)] = h
    low = min(given)
    have = {lv: dict(given.get(lv, {})) for lv in range(low, top + 1)}
    beside: dict[tuple[int, int], tuple[str, str]] = {}
    width = size
    for _ in range(low):
        width = -(-width // ARITY)
    for lv in range(low, top):
        for parent in sorted({i // ARITY for i in have[lv]}):
            children = range(ARITY * parent, min(ARITY * parent + ARITY, width))
            run = [have[lv][i] for i in children]
            beside.update(zip(((lv, i) for i in children), aside(run)))
            have[lv + 1][parent] = digest(run)
        width = -(-width // ARITY)
    (root,) = have[top].values()
    rows = []
    for lv, some in given.items():
        for i in some:
            rows.append((group, lv, i, [beside[up, i // ARITY ** (up - lv)] for up in range(lv, top)], top, int(index), root))
    return pd.DataFrame(rows, columns=["g", "level", "idx", "path", "top", "place", "hash"])


def _upper(ragged: DataFrame, sizes: DataFrame, levels: int) -> DataFrame:
    """(g, level, idx, path, root) of the ragged nodes: their paths to the root of their group."""
    high = height(sizes.agg(F.coalesce(F.max("size"), F.lit(0))).first()[0])
    tall = F.lit(0)
    for k in range(high):  # levels above `size` leaves: one more for each power that it exceeds
        tall = tall + (F.col("size") > F.lit(ARITY**k).cast("long")).cast("int")
    ragged = ragged.join(sizes.withColumn("tall", tall), "g")
    done = ragged.where("level = tall").select("g", "level", "idx", F.array().cast(PATH).alias("path"), F.col("hash").alias("root"))
    open_nodes = ragged.where("level < tall")
    bands, tops = [], None
    for low in range(0, high, levels):
        here = open_nodes.where(F.col("level").between(low, low + levels - 1))
        here = here if tops is None else here.unionByName(tops.where("level < tall"))
        top = F.least(F.lit(low + levels), F.col("tall"))
        here = here.withColumn("top", top).withColumn("place", F.expr(f"cast(idx div cast(pow({ARITY}, top - level) AS long) AS long)"))
        schema = f"g string, level int, idx long, path {PATH}, top int, place long, hash string"
        band = materialize(here.groupBy("g", "top", "place").applyInPandas(_climb, schema), "band")
        tops = band.groupBy("g", F.col("top").alias("level"), F.col("place").alias("idx")).agg(F.first("hash").alias("hash")).join(sizes.withColumn("tall", tall), "g")
        bands.append(band)
    full = None
    for band in reversed(bands):
        if full is None:
            found = band.select("g", "level", "idx", "path", F.col("hash").alias("root"))
        else:
            over = full.select("g", F.col("level").alias("top"), F.col("idx").alias("place"), F.col("path").alias("rest"), "root")
            found = band.join(over, ["g", "top", "place"], "left").select(
                "g", "level", "idx", F.concat("path", F.coalesce("rest", F.array().cast(PATH))).alias("path"), F.coalesce("root", "hash").alias("root")
            )
        full = materialize(found, "paths")
        done = done.unionByName(full)
    return done


def proofs(docs: DataFrame, local: int = LOCAL, band: int = BAND) -> DataFrame:
    """docs (source, doc_id, leaf and what else is to be carried) with path (to the root), subroot and root.

    A name of a column that is taken gets underscores before it.
    """
    taken = docs.columns
    group, path, subroot, root = (free_name(taken, n) for n in ("grp", "path", "subroot", "root"))
    # A null source sorts before all others, and the mark keeps it apart from an empty one.
    marked = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    rows = materialize(docs.withColumn(group, marked), "leaves")
    low_out, high_out = (free_name([c.removesuffix("_path").removesuffix("_root") for c in taken], n) for n in ("low", "high"))
    low = materialize(tree(rows, group, [F.col("doc_id").asc_nulls_first()], "leaf", low_out, local, band), "low")
    tops = low.groupBy(F.col(group).alias("src")).agg(F.first(f"{low_out}_root").alias("leaf")).withColumn("all", F.lit("all"))
    high = tree(materialize(tops, "subroots"), "all", [F.col("src")], "leaf", high_out, local, band).select(F.col("src").alias(group), f"{high_out}_path", f"{high_out}_root")
    both = F.concat(f"{low_out}_path", f"{high_out}_path")
    columns = [F.col(f"`{c}`") for c in taken]
    return low.join(high, group).select(*columns, both.alias(path), F.col(f"{low_out}_root").alias(subroot), F.col(f"{high_out}_root").alias(root))
