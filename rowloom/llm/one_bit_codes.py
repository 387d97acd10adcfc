"""Nearest neighbours by randomly rotated one-bit codes with error bounds (RaBitQ, Gao and Long, 2024).

Every vector is taken relative to the mean, scaled to length one and rotated at random; its code is the
sign of each coordinate. With the code go two scalars: the vector's distance from the mean, and the inner
product of code and vector. From these the inner product with a query is estimated without bias, with an
error that stays within ``EPSILON`` standard units but for a negligible share of pairs. So each distance
has a lower bound, and only vectors whose bound lies below the query's tenth best exact distance so far
are compared in full, in double precision.

The index is a table of blocks of codes, scalars and vectors; every row is indexed. Queries are taken in
blocks of bounded size, each broadcast to one scan of the index, and a task returns only its nearest k
per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.session import materialize

#: Half-width of the error bound; the chance of a miss falls as exp(-c * EPSILON ** 2).
EPSILON = 3.0
#: Vectors of an index block, and bytes of the queries that are broadcast at a time.
BLOCK = 4_096
QUERY_BYTES = 16 << 20


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, no null and no non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def rotation(dimension: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, distance from the mean, inner product of code and unit vector)."""
    rest = vectors.astype(np.float64) - mean
    norm = np.sqrt((rest * rest).sum(1))
    unit = rest / np.where(norm > 0, norm, 1)[:, None] @ turn
    return np.packbits(unit > 0, axis=1), norm, np.abs(unit).sum(1) / np.sqrt(vectors.shape[1])


def lower_bounds(codes: np.ndarray, norm: np.ndarray, fit: np.ndarray, queries: np.ndarray, q_norm: np.ndarray,
                 dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """(estimated squared distances, their lower bounds), a row per query, from codes and scalars alone."""
    signs = np.unpackbits(codes, axis=1, count=dimension).astype(np.float32) * 2 - 1
    safe = np.where(fit > 0, fit, 1)
    inner = (queries.astype(np.float32) @ signs.T) / np.sqrt(dimension) / safe
    error = EPSILON * np.sqrt(np.maximum(1 - safe * safe, 0)) / safe / np.sqrt(max(dimension - 1, 1))
    base, scale = norm ** 2 + q_norm[:, None] ** 2, 2 * norm * q_norm[:, None]
    return base - scale * inner, base - scale * (inner + error) - 1e-5 * (base + scale)


class _Nearest:
    """The k nearest of each query so far, by distance and id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors.astype(np.float64), k
        self.found = [(np.zeros(0), np.zeros(0, np.int64)) for _ in ids]
        self.bound = np.full(len(ids), np.inf)

    def offer(self, i: int, ids: np.ndarray, vectors: np.ndarray) -> None:
        gap = vectors.astype(np.float64) - self.vectors[i]
        distance = np.concatenate([self.found[i][0], np.sqrt((gap * gap).sum(1))])
        ids = np.concatenate([self.found[i][1], ids])
        best = np.lexsort((ids, distance))[: self.k]
        self.found[i] = distance[best], ids[best]
        if len(best) == self.k:
            self.bound[i] = distance[best[-1]] ** 2


_INDEX = pa.schema([("ids", pa.binary()), ("vectors", pa.binary()), ("codes", pa.binary()), ("norm", pa.binary()), ("fit", pa.binary())])
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _kind(vectors: DataFrame) -> type:
    """How components are held for the exact distances: as they are given."""
    return np.float32 if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else np.float64


def build(vectors: DataFrame, dimension: int, seed: int = 11) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(index, mean, rotation) of usable vectors (vec_id, embedding) of one dimension."""
    kind = _kind(vectors)
    totals = vectors.select(F.posexplode("embedding").alias("i", "x")).groupBy("i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    mean = np.zeros(dimension)
    for row in totals.collect():  # one row per dimension
        mean[row["i"]] = row["m"]
    turn = rotation(dimension, seed)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                matrix = _matrix(some.column(1), dimension).astype(kind)
                codes, norm, fit = encode(matrix.astype(np.float32), mean, turn)
                yield pa.RecordBatch.from_pydict({
                    "ids": [some.column(0).to_numpy().tobytes()], "vectors": [matrix.tobytes()], "codes": [codes.tobytes()],
                    "norm": [norm.tobytes()], "fit": [fit.tobytes()],
                }, schema=_INDEX)

    index = vectors.select("vec_id", "embedding").mapInArrow(pack, "ids binary, vectors binary, codes binary, norm binary, fit binary")
    return materialize(index, "codes"), mean, turn


def search(index: DataFrame, mean: np.ndarray, turn: np.ndarray, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest of each query (vec_id, embedding; one row per vec_id).

    Queries are taken in blocks of QUERY_BYTES, one after the other: driver and tasks hold one block, whatever
    the number of queries.
    """
    spark, kind = index.sparkSession, _kind(queries)
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    dimension = len(mean)
    total = queries.count()
    blocks = max(1, -(-total * dimension * 4 // QUERY_BYTES))
    partial = None
    for b in range(blocks):
        rows = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id").collect()  # one block
        if not rows:
            continue
        ids = np.array([r["vec_id"] for r in rows], np.int64)
        vectors = np.array([r["embedding"] for r in rows], kind)
        rest = vectors.astype(np.float64) - mean
        norm = np.sqrt((rest * rest).sum(1))
        turned = (rest / np.where(norm > 0, norm, 1)[:, None] @ turn).astype(np.float32)
        shared = spark.sparkContext.broadcast((ids, vectors, norm, turned))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, vectors, q_norm, turned = shared.value
            best = _Nearest(ids, vectors, k)
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    own = np.frombuffer(row[0], np.int64)
                    matrix = np.frombuffer(row[1], kind).reshape(-1, dimension)
                    codes = np.frombuffer(row[2], np.uint8).reshape(len(own), -1)
                    n, fit = np.frombuffer(row[3]), np.frombuffer(row[4])
                    for at in range(0, len(ids), 256):
                        part = slice(at, at + 256)
                        guess, low = lower_bounds(codes, n, fit, turned[part], q_norm[part], dimension)
                        for j in range(len(low)):
                            i = at + j
                            if not np.isfinite(best.bound[i]):
                                near = np.argpartition(guess[j], min(4 * k, len(own)) - 1)[: 4 * k]
                                near = near[own[near] != ids[i]]
                                best.offer(i, own[near], matrix[near])
                                low[j, near] = np.inf
                            open_ = np.flatnonzero((low[j] <= best.bound[i]) & (own != ids[i]) & np.isfinite(low[j]))
                            if len(open_):
                                best.offer(i, own[open_], matrix[open_])
            for at in range(0, len(ids), 1_000):
                found = [(int(q), v, d) for q, (ds, vs) in zip(ids[at:at + 1_000], best.found[at:at + 1_000]) for d, v in zip(ds.tolist(), vs.tolist())]
                if found:
                    q, v, d = zip(*found)
                    yield pa.RecordBatch.from_pydict({"query_id": q, "vec_id": v, "score": d}, schema=_FOUND)

        part = index.mapInArrow(scan, "query_id long, vec_id long, score double")
        part = part.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        part = materialize(part, "nearest")
        shared.destroy()
        partial = part if partial is None else partial.union(part)
    if partial is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return partial


def nearest(embeddings: DataFrame, is_query: Column, k: int = 10, seed: int = 11) -> DataFrame:
    """The k nearest vectors (Euclidean) of every row that ``is_query`` names, among all other rows.

    Vectors that are null, empty, zero, or hold a null or non-finite component take no part, nor do rows
    without vec_id or of another length than most have (of equally many, the longest). Rows of one vec_id
    are one query, that of its smallest vector, and none of them is its own neighbour. Fewer than k
    candidates are all returned; ties go to the smaller vec_id. An empty table gives an empty result.
    """
    given = embeddings.schema["embedding"].dataType.elementType.typeName()
    held = F.col("embedding") if given in ("float", "double") else F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long"), held.alias("embedding"), is_query.alias("_query"))
    rows = rows.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    most = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if most is None:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("embedding") == most["n"])
    index, mean, turn = build(rows, most["n"], seed)
    queries = rows.filter("_query").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return search(index, mean, turn, queries, k)
