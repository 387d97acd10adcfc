"""Mixing sources to target weights by balanced sampling (the cube method).

Every source gets a target number of words; each of its documents is expected target / size times, which
is its whole part of copies for certain, plus one more with the fractional part as probability. Which
documents get the extra copy is drawn by the cube method: a vector of probabilities is moved, again and
again, along a direction that keeps both the number of documents and the number of words (the null space
of these two constraints), until a coordinate meets 0 or 1. Three undecided documents suffice for one
move, so only two per group remain open. Groups are random and of bounded size, whatever the size of the
source; what remains open of all groups is grouped again, and only the last group of each source lands
by rounding the few it has left as its totals ask.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.session import materialize
from .common import ranked

#: Documents of a group at most (on average, as groups are random).
GROUP = 2_048
#: A document is taken so many times at most.
MOST = 3
_WORD = r"[^\x20\x09-\x0D]+"
_STATE = ["doc_id", "place", "row", "size", "number", "source_size", "target", "whole", "p"]


def fill(sizes: Sequence[int], weights: Sequence[float], total: float, most: float = MOST) -> list[float]:
    """Targets in proportion to the weights, none above ``most`` times its size; the excess goes to the others."""
    targets = [0.0] * len(sizes)
    open_ones, rest = list(range(len(sizes))), float(total)
    while open_ones:
        weight = sum(weights[i] for i in open_ones)
        over = [i for i in open_ones if rest * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in open_ones:
                targets[i] = rest * weights[i] / weight
            break
        for i in over:
            targets[i] = float(most * sizes[i])
        rest -= sum(targets[i] for i in over)
        open_ones = [i for i in open_ones if i not in set(over)]
    return targets


def flight(p: np.ndarray, size: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Moves probabilities until at most two are undecided; sums of p and of p * size stay as they are.

    Each move takes three undecided units. Their direction is the cross product of the constraints
    (1, 1, 1) and their sizes; it is scaled to the nearest bound on either side, and the side is drawn so
    that every probability keeps its expectation.
    """
    p, s, draws = p.tolist(), size.tolist(), draws.tolist()
    waiting = [i for i, x in enumerate(p) if 0 < x < 1]
    waiting.reverse()
    active: list[int] = []
    step = 0
    while True:
        while len(active) < 3 and waiting:
            active.append(waiting.pop())
        if len(active) < 3:
            return np.array(p)
        a, b, c = active
        u = [s[c] - s[b], s[a] - s[c], s[b] - s[a]]
        if not any(u):
            u = [1.0, -1.0, 0.0]
        ahead = back = math.inf
        for i, d in zip(active, u):
            if d > 0:
                ahead, back = min(ahead, (1 - p[i]) / d), min(back, p[i] / d)
            elif d < 0:
                ahead, back = min(ahead, p[i] / -d), min(back, (1 - p[i]) / -d)
        move = ahead if draws[step] * (ahead + back) < back else -back
        step += 1
        nearest = None
        for i, d in zip(active, u):
            p[i] += move * d
            gap = min(p[i], 1 - p[i]) if d else math.inf
            if nearest is None or gap < nearest[0]:
                nearest = (gap, i)
        p[nearest[1]] = float(p[nearest[1]] > 0.5)
        for i in active:
            if p[i] < 1e-12 or p[i] > 1 - 1e-12:
                p[i] = float(p[i] > 0.5)
        active = [i for i in active if 0 < p[i] < 1]


def land(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rounds the last undecided units so that the words come nearest, then the documents."""
    undecided = np.flatnonzero((p > 0) & (p < 1))
    if not len(undecided):
        return p
    best = None
    for code in range(1 << len(undecided)):
        bits = np.array([code >> k & 1 for k in range(len(undecided))], float)
        off = bits - p[undecided]
        rank = (abs(float(off @ size[undecided])), abs(float(off.sum())), code)
        if best is None or rank < best[0]:
            best = (rank, bits)
    p = p.copy()
    p[undecided] = best[1]
    return p


def sized(documents: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, source, number of words and a hash of the text of each document, and ``row``: its own number, if it has one."""
    return documents.select(
        F.col("doc_id").cast("long"), "source", F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("text").alias("tie"), (F.col(row) if row else F.lit(None)).cast("long").alias("row"),
    )


def targets(rows: DataFrame, weights: Sequence[float], most: int = MOST) -> list[tuple]:
    """(number, source, source_size, target) per source, by code point, null last.

    The list of sources is the mix's configuration: one row each comes to the driver, never documents.
    """
    found = [(r["source"], r["n"]) for r in rows.groupBy("source").agg(F.sum("size").alias("n")).collect()]
    found.sort(key=lambda x: (x[0] is None, (x[0] or "").encode()))
    sizes = [n for _, n in found]
    share = fill(sizes, [weights[i % len(weights)] for i in range(len(found))], sum(sizes), most)
    return [(i, name, n, t) for i, ((name, n), t) in enumerate(zip(found, share))]


def mix(documents: DataFrame, weights: Sequence[float] = (5, 2, 1), seed: int = 17, most: int = MOST, row: str | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies of every document, and ``row`` if a column is named by it.

    ``copies`` is how often the mix holds the document and ``taken`` the words of all its copies. Documents
    without words have size 0 and take 0. A null source is a source of its own. Documents are numbered by
    source, doc_id (nulls first), size and a hash of their text; draws depend on the seed and on these numbers,
    so reruns agree under any partitioning, and rows that are alike in all of them, however many, are dealt
    over all groups. Such rows may differ in copies, but not in what is returned for all of them together. An
    empty table gives an empty one.
    """
    spark = documents.sparkSession
    order = [F.col("doc_id").asc_nulls_first(), F.col("size").asc(), F.col("tie").asc()]
    rows = ranked(sized(documents, row), F.col("source"), order).drop("tree", "n", "tie").withColumnRenamed("rank", "place")
    rows = materialize(rows, "mix-sizes")
    named = [F.col("row").alias(row)] if row else []
    shares = targets(rows, weights, most)
    if not shares:
        return rows.select("doc_id", "size", F.lit(0).cast("long").alias("source_size"), F.lit(0.0).alias("target"),
                           F.lit(0).cast("long").alias("taken"), F.lit(0).alias("copies"), *named)
    table = spark.createDataFrame(shares, "number int, _source string, source_size long, target double")
    expected = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    state = (
        rows.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_e", expected)
        .select(
            "doc_id", "place", "row", "size", "number", "source_size", "target", F.floor("_e").cast("int").alias("whole"),
            F.when(F.col("size") > 0, F.col("_e") - F.floor("_e")).otherwise(0.0).alias("p"),
        )
    )
    done, level = [], 0
    fields = "doc_id long, place long, row long, size long, number int, source_size long, target double, whole int, p double"
    while True:
        undecided = state.filter("p > 0 AND p < 1")
        counts = [(r["number"], r["count"]) for r in undecided.groupBy("number").count().collect()]
        done.append(state.filter("p <= 0 OR p >= 1"))
        if not counts:
            break
        groups = spark.createDataFrame([(k, -(-n // GROUP)) for k, n in counts], "number int, groups int")
        last = all(n <= GROUP for _, n in counts)
        key = F.xxhash64(F.lit(seed + level), "place", "number")
        keyed = undecided.join(F.broadcast(groups), "number").withColumn("_group", F.pmod(key, F.col("groups")).cast("int"))

        def fly(frame: pa.Table) -> pa.Table:
            frame = frame.sort_by("place")
            number, group, single = (frame[c][0].as_py() for c in ("number", "_group", "groups"))
            draw = np.random.default_rng([seed, level, number, group])
            order = draw.permutation(len(frame))
            frame = frame.take(pa.array(order))
            size = frame["size"].to_numpy().astype(float)
            p = flight(frame["p"].to_numpy(), size, draw.random(len(frame) + 1))
            p = pa.array(land(p, size) if single == 1 else p)
            return frame.set_column(frame.schema.get_field_index("p"), "p", p).select(_STATE)

        state = materialize(keyed.groupBy("number", "_group").applyInArrow(fly, fields), "mix-level")
        level += 1
        if last:
            done.append(state)
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    copies = (F.col("whole") + (F.col("p") >= 0.5).cast("int")).alias("copies")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).cast("long").alias("taken"), copies, *named)
