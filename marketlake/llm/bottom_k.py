"""Near-duplicates by bottom-k sketches from one hash function.

A document is the set of its word shingles, each a 64-bit hash; its sketch keeps
the ``k`` smallest. Rows with equal sets are one class from then on, found by
grouping on a digest of the set with partial aggregation.

Inverted lists are keyed by runs of ``RUN`` neighbouring retained values. Two sets
of similarity 0.8 or more have such a run in common: always, where sets are no
larger than ``k`` (differences can't break up the common values any further; sets of
less than 16 values use shorter runs), else but with probability ``0.8 ** k`` (5e-10
for k = 96, less for more similar sets). Shared passages, in contrast, rarely fill a
whole run, which keeps the lists of unlike documents short.

Lists of up to ``SHORT_LIST`` classes give all their pairs. Longer lists give pairs
with one pivot, the member in most long lists; once links are verified and
components known, members of long lists in different components are paired if the
prefixes of their sets, in one order of all shingles from rare to common, meet: linked
sets always do. So every linked pair with a common run is tested unless a path of
links already joins it, and a large group of near copies costs about its size and
not its square.

Pairs pass a size bound and an estimate from the sketch of the union; the sets of
those that remain are compared in full. Components come from alternating large-star
and small-star steps; every step is written to the shared folder.

Defined results: null, empty or blank texts have an empty set, linked with nothing;
fewer words than a shingle's are one shingle; rows that share a doc_id count as one
document, each with its own set size; rows without a doc_id are linked with nothing.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stored, word_codes

RUN, SHORT_LIST = 4, 16
#: Ratio of the sizes at either end of a band.
BAND = 1.02
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M[1]
    h = (h ^ (h >> np.uint64(27))) * _M[2]
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """A sorted array of distinct signed hashes of n words for each text."""
    from xxhash import xxh3_64_intdigest

    codes, at, words = word_codes(texts)
    known = np.fromiter(map(xxh3_64_intdigest, words.cast(pa.binary()).to_pylist()), np.uint64, len(words))
    hashes, out = known[codes], []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        h = hashes[a:b]
        m = min(len(h), n)
        if m:
            s = np.full(len(h) - m + 1, m, np.uint64)
            for i in range(m):
                s = _mix(s * _M[0] + h[i : len(h) - m + 1 + i])
            h = s
        out.append(np.unique(h.view(np.int64)))
    return out


def sketches(docs: DataFrame, n: int, k: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set (null if it is empty) and sketch (the k smallest hashes, ascending)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"), n)
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            kept = [s[:k] for s in sets]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in kept])]).astype(np.int32)
            flat = pa.array(np.concatenate([*kept, np.zeros(0, np.int64)]))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "digest": pa.array(digest, pa.binary()), "sketch": pa.ListArray.from_arrays(pa.array(offsets), flat),
            })

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_shingles long, digest binary, sketch array<long>")


def full_sets(docs: DataFrame, n: int) -> DataFrame:
    """doc_id and its whole set, for documents of candidate pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"), n)
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = pa.array(np.concatenate([*sets, np.zeros(0, np.int64)]))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "shingles": pa.ListArray.from_arrays(pa.array(offsets), flat)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, shingles array<long>")


def run_keys(sketch: Column, n: Column) -> Column:
    """Hashes of runs of neighbouring retained values."""

    def runs(size: int) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(sketch) - size + 1),
            lambda i: F.xxhash64(F.lit(size), *(F.element_at(sketch, i + j) for j in range(size))),
        )

    none = F.array().cast("array<long>")
    # Unions of at least 16, 6 and 4 values hold unbroken runs of 4, 3 and 2 common ones.
    return F.concat(
        F.when((n >= 13) & (F.size(sketch) >= RUN), runs(RUN)).otherwise(none),
        F.when((n >= 5) & (n <= 15), runs(3)).otherwise(none),
        F.when((n >= 4) & (n <= 5), runs(2)).otherwise(none),
    )


def stars(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, root): each node of the edges (a, b) that isn't the smallest of its component, with the smallest.

    After a given number of rounds a root may not be the smallest yet, but still lies in the component.
    """
    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    mark = lambda df: tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
    last = mark(e) if rounds is None else None
    while last[0] if rounds is None else rounds:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        e = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        near = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(near.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        if rounds is not None:
            rounds -= 1
            continue
        now = mark(e)
        if now == last:
            break
        last = now
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def spread(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, s, df): the shingles of the nodes, and how many of the nodes have each."""
    need = nodes.select(F.col("node").alias("doc_id")).distinct()
    each = sets.join(need, "doc_id", "left_semi").select(F.col("doc_id").alias("node"), F.explode("shingles").alias("s"))
    return each.join(each.groupBy("s").agg(F.count("*").alias("df")), "s").select("node", "s", "df")


def least_common(of: int, p: float, loss: float = 1e-9) -> int:
    """Fewest common values of ``of`` that a pair of similarity ``p`` has, but for a probability below ``loss``."""
    below, c = 0.0, 0
    while c < of and below + math.comb(of, c) * p**c * (1 - p) ** (of - c) < loss:
        below += math.comb(of, c) * p**c * (1 - p) ** (of - c)
        c += 1
    return c


def likely(pairs: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose sizes and sketches allow a link, with the estimate."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b")
    rows = rows.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    # The k smallest of the union are the union's sketch; the share found in both estimates the similarity.
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, k)
    rows = rows.withColumn("_both", F.size(F.array_intersect(union, F.array_intersect("s_a", "s_b")))).withColumn("_of", F.size(union))
    # Exact where the sketches are whole sets.
    p = percent / 100
    least = F.element_at(F.array(*(F.lit(least_common(of, p)) for of in range(1, k + 1))), F.col("_of"))
    floor = F.when((F.col("n_a") <= k) & (F.col("n_b") <= k) & (F.col("_of") < k), p * F.col("_of")).otherwise(least)
    return stored(rows.where(F.col("_both") >= F.floor(floor)).select("a", "b", (F.col("_both") / F.col("_of")).alias("estimate")), "likely")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose full sets have 100 * intersection >= percent * union."""
    pairs = pairs.select("a", "b")
    need = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    few = sets.join(need, "doc_id", "left_semi")
    rows = pairs.join(few.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
    rows = rows.join(few.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b")
    both = F.size(F.array_intersect("x", "y"))
    return stored(rows.where(100 * both >= percent * (F.size("x") + F.size("y") - both)).select("a", "b").distinct(), "links")


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs that no path of links joins."""
    of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"r_{c}"))
    rows = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return rows.where(F.coalesce("r_a", "a") != F.coalesce("r_b", "b")).select(*pairs.columns)


def band(n: Column) -> Column:
    """Sizes that differ by less than a fiftieth or so share a band."""
    return F.floor(F.log(n) / math.log(BAND)).cast("int")


def meetings(prefix: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of rows of ``prefix`` (s, node, root, n, _at) under one shingle that sizes and places don't rule out, but for the width of a band.

    From its size and the shingle's place in it, a set knows the sizes that a partner may
    have. Rows go to the bands of these sizes, and meet where each is in a band that the
    other allows: holders of a passage that are too unlike for a link never meet, however many.
    """
    by_root = prefix.groupBy("s", "root").agg(F.count("*").alias("c"))
    open_ = by_root.groupBy("s").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.count("*").alias("roots")).where("roots > 1")
    n, rest = F.col("n"), F.lit(1) + F.col("n") - F.col("_at")
    low = F.expr(f"({percent} * n + 99) div 100")
    high = F.least(F.expr(f"100 * n div {percent}"), F.floor((100 + percent) * rest / percent).cast("long") - n)
    rows = prefix.withColumns({"_low": low, "_high": high}).where("_high >= _low").join(open_.select("s", "main"), "s")
    rows = rows.withColumns({"_own": band(n), "_theirs": F.explode(F.sequence(band(F.col("_low")), band(F.col("_high"))))})
    side = lambda c, own, theirs: rows.select("s", "main", F.col("_own").alias(own), F.col("_theirs").alias(theirs), *(F.col(x).alias(f"{x}_{c}") for x in ("node", "root", "n", "_at")))
    # Of two holders with different roots one is outside the largest component: pairs are its few with the others.
    outer = side("x", "_bx", "_by").where("root_x <> main").drop("main")
    return outer.join(side("y", "_by", "_bx").drop("main"), ["s", "_bx", "_by"])


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, k: int = 96) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (smallest doc_id reachable), kept. docs: doc_id, text.

    n: words of a shingle. percent: the least similarity of a link; runs are made for 80 or more.
    """
    if percent < 80:
        raise ValueError("inverted lists of runs are complete for 80 percent or more")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    members = stored(sketches(docs, n, k), "sketches")
    classes = members.where("digest IS NOT NULL").groupBy("digest")
    classes = classes.agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    nodes = stored(classes.where("node IS NOT NULL"), "classes")

    runs = nodes.select("node", "n", F.explode(run_keys(F.col("sketch"), F.col("n"))).alias("key"))
    lists = stored(runs.join(runs.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "key"), "lists")
    short = lists.where(F.col("size") <= SHORT_LIST)
    long = lists.where(F.col("size") > SHORT_LIST).select("key", "node", "n")
    side = lambda c: short.select("key", F.col("node").alias(c), F.col("n").alias(f"n_{c}"))
    alike = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    pairs = side("a").join(side("b"), "key").where((F.col("a") < F.col("b")) & alike).select("a", "b")
    weight = long.groupBy("node").agg(F.count("*").alias("w"))
    pivots = long.join(weight, "node").groupBy("key").agg(F.max(F.struct(F.col("w"), F.col("node"))).alias("p"))
    spokes = long.join(pivots.select("key", F.col("p.node").alias("p")), "key").where("node <> p")
    spokes = spokes.select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b"))
    need = lists.select(F.col("node").alias("doc_id")).distinct()
    sets = stored(full_sets(docs.join(need, "doc_id", "left_semi"), n), "sets")
    hopeful = likely(pairs.unionByName(spokes).distinct(), nodes, k, percent)
    # Each document's most promising partner first: most other pairs then lie within a component and need no sets.
    ends = hopeful.select(F.col("a").alias("x"), F.col("b").alias("y"), "estimate").unionByName(hopeful.select(F.col("b").alias("x"), F.col("a").alias("y"), "estimate"))
    best = ends.groupBy("x").agg(F.max_by("y", F.struct("estimate", "y")).alias("y"))
    links = confirmed(best.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), sets, percent)
    links = links.unionByName(confirmed(stored(apart(hopeful, stars(links, 2)), "pairs"), sets, percent))
    roots = stars(links, 2)
    # Members of long lists that no path of links joins. Their shingles are put in one order, rare ones first; linked sets
    # must share one of the first ``n - ceil(n * percent / 100) + 1`` of either. A shingle whose holders have one root is done.
    members_of = long.select("node", "n").distinct().join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = F.row_number().over(Window.partitionBy("node").orderBy("df", "s"))
    prefix = spread(long, sets).withColumn("_at", first).join(members_of, "node")
    prefix = prefix.where(F.col("_at") <= F.col("n") - F.expr(f"({percent} * n + 99) div 100") + 1)
    prefix = stored(prefix.where("df > 1").select("s", "node", "root", "n", "_at"), "prefix")
    # At the first shingle that two sets share, no more than the rest of either can follow.
    most = 1 + F.least(F.col("n_x") - F.col("_at_x"), F.col("n_y") - F.col("_at_y"))
    other = (F.col("root_x") != F.col("root_y")) & (100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y")) & ((100 + percent) * most >= percent * (F.col("n_x") + F.col("n_y")))
    rest = meetings(prefix, percent).where(other).select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b"))
    rest = stored(rest.distinct(), "pairs")
    if not rest.isEmpty():
        links = links.unionByName(confirmed(likely(rest, nodes, k, percent), sets, percent))
    roots = stars(links)

    known = nodes.select("digest", "node").join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("root"))
    out = members.select("doc_id", "n_shingles", "digest").join(known, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
