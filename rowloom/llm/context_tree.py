"""A byte language model by context-tree weighting, and a word unigram model to compare it with.

A byte is predicted as eight binary decisions; each decision has its own tree of contexts, the up to
``DEPTH`` bytes before. A node's Krichevsky-Trofimov estimate of its own counts is mixed, half and half,
with the product of its children's weighted probabilities, from the leaves up; for prediction the same
weights mix the estimates of all depths. Scores are thus code lengths of a mixture over all prunings.

Counting is exact and covers all training bytes, and every context seen at least ``least`` times is a node,
so the model grows with the corpus. It is never in one place: blocks of documents send their distinct
(context, byte) grams, with training counts, to ranges of the nearest two bytes (three for frequent pairs),
as many as the texts' bytes ask for, and one task per range weighs the nodes below. A task reads the rows of a
range one after the other and holds its distinct grams only, however many blocks have them. Sums per nearest byte
and frequent pair are added up by tasks as well; the driver gets one row for each and weighs the few nodes above.
A second pass over the ranges mixes the probabilities of every gram that a block asks for and sends them
back to it; nothing is broadcast but the nodes above.

The unigram model needs the count of every word of every document. The distinct words of a run of documents
travel to ranges of word hashes, and their counts come back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.session import materialize
from .common import give_back, parts, pieces

DEPTH = 5
#: A context is a node if training saw it so often; contexts seen more rarely share one estimate.
LEAST = 2
#: Bytes of text for each range of grams: what a task weighs at a time.
RANGE_BYTES = 4 << 20
#: Begins and ends a text; no byte of UTF-8.
END = 0xFF
PIECE_BYTES = 2 << 20
#: Text whose distinct grams travel together.
BLOCK_BYTES = 2 << 20
#: Numbers of a range that are merged at a time.
MERGED = 1 << 20
#: Bytes of text for each range of words.
WORD_BYTES = 16 << 20


def grams(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(contexts, next bytes, number of predictions per text); the nearest byte is a context's highest."""
    pad = bytes([END]) * depth
    flat = np.frombuffer(b"".join([*(pad + t for t in texts), pad]), np.uint8)
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.cumsum(lengths + depth - 1) - (lengths + depth - 1) + depth
    # The pad of the next text ends this one: its first byte is predicted as well.
    at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    # Contexts of all places but the first pad's, whole slices at a time.
    context = np.zeros(len(flat) - depth, np.int64)
    for k in range(1, depth + 1):
        context <<= 8
        context |= flat[depth - k:len(flat) - k]
    return context[at - depth], flat[at], lengths


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after a shift by six."""
    shift = np.zeros_like(x)
    for k in range(6):
        shift += np.log(x + k)
    y = x + 6
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - shift


def _bits(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(zeros, ones) of the 255 binary decisions of each row of 256 byte counts; column 0 is unused."""
    total = np.zeros((len(counts), 512))
    total[:, 256:] = counts
    for j in range(255, 0, -1):
        total[:, j] = total[:, 2 * j] + total[:, 2 * j + 1]
    return total[:, 0:512:2][:, :256], total[:, 1:512:2][:, :256]


class Tree:
    """A small corpus's nodes in one process, by depth: sorted contexts and the table of log10 probabilities of the next byte."""

    def __init__(self, depths: list[tuple[np.ndarray, np.ndarray]], depth: int):
        self.depth = depth
        self.contexts = [c for c, _ in depths]
        self.offsets = np.cumsum([0, *(len(c) for c, _ in depths)])
        self.table = self._weigh([n for _, n in depths])

    def _parents(self, d: int) -> np.ndarray:
        return np.searchsorted(self.contexts[d - 1], self.contexts[d] >> 8)

    def _weigh(self, counts: list[np.ndarray]) -> np.ndarray:
        """Bottom-up weighted probabilities, then top-down mixtures.

        Per node and decision, what the mixture needs is its own part (weight times estimate), the weight of
        what lies below, and the estimate of its contexts that are no nodes. Rows are taken some at a time.
        """
        deepest = len(counts) - 1
        own, under, alone = ([None] * (deepest + 1) for _ in range(3))
        weighted = None
        for d in range(deepest, -1, -1):
            rows = len(counts[d])
            own[d], under[d], alone[d] = (np.zeros((rows, 256), np.float32) for _ in range(3))
            now = np.zeros((rows, 256))
            parent = self._parents(d + 1) if d < deepest and len(counts[d + 1]) else np.zeros(0, np.int64)
            starts = np.searchsorted(parent, np.arange(rows + 1))  # children are sorted by parent
            for a in range(0, rows, 1_000):
                b = min(a + 1_000, rows)
                z, o = _bits(counts[d][a:b])
                kt = _log_kt(z, o)
                w, rest = np.ones_like(kt), np.full_like(kt, 0.5)
                now[a:b] = kt
                i, j = starts[a], starts[b]
                if i < j:
                    which = parent[i:j] - a
                    cz, co = _bits(counts[d + 1][i:j])
                    below, bz, bo = np.zeros_like(kt), z.copy(), o.copy()
                    np.add.at(below, which, weighted[i:j])
                    np.subtract.at(bz, which, cz)
                    np.subtract.at(bo, which, co)
                    below += _log_kt(bz, bo)
                    has = np.unique(which)
                    now[a + has] = np.log(0.5) + np.logaddexp(kt[has], below[has])
                    w[has] = np.exp(np.log(0.5) + kt[has] - now[a + has])
                    rest = (bo + 0.5) / (bz + bo + 1)
                own[d][a:b] = w * (o + 0.5) / (z + o + 1)
                under[d][a:b] = 1 - w
                alone[d][a:b] = rest
            weighted = now
        table = np.zeros((int(self.offsets[-1]), 256), np.float32)
        for d in range(deepest + 1):
            for a in range(0, len(counts[d]), 1_000):
                # A one at this node if no child is met, then the mixture with its ancestors.
                node = np.arange(a, min(a + 1_000, len(counts[d])))
                p = own[d][node].astype(float) + under[d][node] * alone[d][node]
                log = np.zeros((len(node), 512))
                first = self.offsets[d] + a
                for up in range(d, 0, -1):
                    node = self._parents(up)[node]
                    p = own[up - 1][node] + under[up - 1][node] * p
                for j in range(1, 256):
                    log[:, 2 * j] = log[:, j] + np.log10(1 - p[:, j])
                    log[:, 2 * j + 1] = log[:, j] + np.log10(p[:, j])
                table[first:first + len(log)] = log[:, 256:]
        return table

    def nodes(self, contexts: np.ndarray) -> np.ndarray:
        """The deepest node of each context (of full depth), as a row of the table."""
        found = np.zeros(len(contexts), np.int64)
        for d in range(1, len(self.contexts)):
            kept, cut = self.contexts[d], contexts >> (8 * (self.depth - d))
            if len(kept):
                at = np.minimum(np.searchsorted(kept, cut), len(kept) - 1)
                found = np.where(kept[at] == cut, self.offsets[d] + at, found)
        return found


def log10_probabilities(tree: Tree, texts: list[bytes]) -> np.ndarray:
    """log10 of the probability of each text, its end included."""
    if not texts:
        return np.zeros(0)
    context, byte, lengths = grams(texts, tree.depth)
    code, kinds = pd.factorize(context)
    value = tree.table[tree.nodes(kinds)[code], byte].astype(np.float64)
    return np.add.reduceat(value, np.cumsum(lengths) - lengths)


def _count(documents: DataFrame, training: Column, depth: int, buckets: int) -> DataFrame:
    """(context, byte, count) of all training texts, packed, grouped by the two nearest bytes."""
    packed = pa.schema([("bucket", pa.int32()), ("gram", pa.binary()), ("count", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            near = held >> (8 * (depth - 1))
            bucket = (near * 40_503 % 65_521) % buckets
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            rows = [b for b in range(buckets) if ends[b] < ends[b + 1]]
            cut = [order[ends[b]:ends[b + 1]] for b in rows]
            return pa.RecordBatch.from_pydict({
                "bucket": rows, "gram": [held[c].tobytes() for c in cut], "count": [counts[c].astype(np.uint32).tobytes() for c in cut],
            }, schema=packed)

        for piece in pieces(batches, "text", PIECE_BYTES):
            texts = [(t or "").encode() for t in piece.column(0).to_pylist()]
            context, byte, _ = grams(texts, depth)
            code, kinds = pd.factorize(context << 8 | byte)
            both = np.concatenate([held, kinds])
            number = np.concatenate([counts, np.bincount(code, minlength=len(kinds))])
            code, held = pd.factorize(both)
            counts = np.bincount(code, number, len(held)).astype(np.int64)
            if len(held) > 2_000_000:
                yield out()
                held, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(held):
            yield out()

    return documents.filter(training).select("text").mapInArrow(work, "bucket int, gram binary, count binary")


def fit(documents: DataFrame, training: Column, depth: int = DEPTH, least_share: float = 0.0, least: int = LEAST) -> Tree:
    """The tree of a small corpus in one process; ``score`` spreads it over tasks."""
    spark = documents.sparkSession
    total = documents.filter(training).agg(
        F.coalesce(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1), F.lit(0)).alias("n"),
    ).first()["n"]
    least = max(float(least), least_share * total)
    kept = pa.schema([("depth", pa.int32()), ("context", pa.binary()), ("byte", pa.binary()), ("count", pa.binary())])

    def reduce(table: pa.Table) -> pa.Table:
        gram = np.frombuffer(b"".join(table["gram"].to_pylist()), np.int64)
        count = np.frombuffer(b"".join(table["count"].to_pylist()), np.uint32)
        code, gram = pd.factorize(gram)
        count = np.bincount(code, count, len(gram)).astype(np.int64)
        out = {c: [] for c in kept.names}
        for d in range(depth, 0, -1):
            cut = (gram >> (8 * (depth - d) + 8)) << 8 | (gram & 255)
            kinds, code = np.unique(cut, return_inverse=True)
            n = np.bincount(code, count).astype(np.int64)
            context = kinds >> 8
            _, which = np.unique(context, return_inverse=True)
            # Depth 1 is not complete within a bucket: all of it is passed on.
            good = np.bincount(which, n)[which] >= (least if d > 1 else 0)
            out["depth"].append(d)
            out["context"].append(context[good].tobytes())
            out["byte"].append((kinds[good] & 255).astype(np.uint8).tobytes())
            out["count"].append(n[good].tobytes())
        return pa.table(out, schema=kept)

    rows = _count(documents, training, depth, parts(spark)).groupBy("bucket").applyInArrow(reduce, "depth int, context binary, byte binary, count binary")
    found: dict[int, list] = {d: [] for d in range(1, depth + 1)}
    for r in rows.toLocalIterator():  # nodes of bounded number
        found[r["depth"]].append((np.frombuffer(r["context"], np.int64), np.frombuffer(r["byte"], np.uint8), np.frombuffer(r["count"], np.int64)))
    depths: list[tuple[np.ndarray, np.ndarray]] = []
    for d in range(1, depth + 1):
        context, byte, count = (np.concatenate(c) for c in zip(*found[d])) if found[d] else (np.zeros(0, np.int64),) * 3
        kinds, where = np.unique(context, return_inverse=True)
        if d > 1:
            sums = np.bincount(where, count, len(kinds))
            good = (sums >= least) & np.isin(kinds >> 8, depths[-1][0])
            kinds, byte, count, where = kinds[good], byte[good[where]], count[good[where]], (np.cumsum(good) - 1)[where[good[where]]]
        table = np.zeros((len(kinds), 256))
        np.add.at(table, (where, byte.astype(np.int64)), count)
        if d == 1:
            depths.append((np.zeros(1, np.int64), table.sum(0, keepdims=True)))
        good = table.sum(1) >= least
        depths.append((kinds[good], table[good]))
    return Tree(depths, depth)


def _block_name(ids: list, texts: list[bytes], turn: int) -> str:
    """The same for a repeated attempt at the same rows, another one for any other block."""
    digest = xxhash.xxh3_128()
    for k, t in zip(ids, texts):
        digest.update(f"{k} {xxhash.xxh3_64_hexdigest(t)} ")
    context = TaskContext.get()
    return f"{digest.hexdigest()}-{context.partitionId() if context else 0}-{turn}"


def _bucket(context: np.ndarray, depth: int, hot: np.ndarray, buckets: int) -> np.ndarray:
    """The range of each context: by its two nearest bytes, by three for the pairs in ``hot``."""
    pair, near = context >> (8 * (depth - 2)), context >> (8 * (depth - 3))
    mixed = np.where(np.isin(pair, hot), near + (1 << 24), pair) * 2_654_435_761 & 0xFFFFFFFF
    return mixed * buckets >> 32


def _starts(values: np.ndarray) -> np.ndarray:
    """Where sorted values change."""
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    return np.flatnonzero(first)


def _packed(values: np.ndarray) -> bytes:
    """The bytes of an array, place by place, compressed behind their number."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _hot_pairs(documents: DataFrame, training: Column, buckets: int) -> np.ndarray:
    """Pairs with more than an average range's bytes, by an eighth of the documents.

    They only decide which task weighs what.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << 16, np.int64)
        for piece in pieces(batches, "text", PIECE_BYTES):
            context, _, _ = grams([(t or "").encode() for t in piece.column(0).to_pylist()], 2)
            held += np.bincount(context, minlength=1 << 16)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(some, pa.int64()), "n": pa.array(held[some], pa.int64())})

    some = documents.filter(training & (F.pmod(F.xxhash64("doc_id"), F.lit(8)) == 0)).select("text")
    found = some.mapInArrow(work, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()  # 65,536 rows at most
    limit = max(100.0, sum(r["n"] for r in found) / buckets)
    return np.array(sorted(r["pair"] for r in found if r["n"] > limit), np.int64)


_GRAMS = pa.schema([
    ("bucket", pa.int32()), ("block", pa.string()), ("gram", pa.binary()), ("count", pa.binary()), ("info", pa.binary()),
])


def _gram_blocks(documents: DataFrame, training: Column, depth: int, hot: np.ndarray, buckets: int) -> DataFrame:
    """Per block and range: the block's distinct grams, ascending, as differences, and their training counts.

    A further row per block holds its documents.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for turn, piece in enumerate(pieces(batches, "text", BLOCK_BYTES)):
            texts = [(t or "").encode() for t in piece.column(1).to_pylist()]
            block = _block_name(piece.column(0).to_pylist(), texts, turn)
            context, byte, lengths = grams(texts, depth)
            # The lowest bit tells training from other texts; sorting is far cheaper here than hashing.
            key = np.sort((context << 8 | byte) << 1 | np.repeat(np.array(piece.column(2).to_pylist(), bool), lengths))
            del context, byte
            starts = _starts(key >> 1)
            kinds, count = key[starts] >> 1, np.add.reduceat(key & 1, starts).astype(np.uint32)
            del key, starts
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, piece.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_batch(piece)
            rows = [{"block": block, "info": sink.getvalue().to_pybytes()}]
            bucket = _bucket(kinds >> 8, depth, hot, buckets)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(ends)):
                own = order[ends[b]:ends[b + 1]]
                rows.append({"bucket": int(b), "block": block, "gram": _packed(np.diff(kinds[own], prepend=0)), "count": _packed(count[own])})
            found = pa.RecordBatch.from_pylist(rows, schema=_GRAMS)
            del rows, kinds, count, bucket, order, ends, texts, sink
            give_back(cycles=False)
            yield found

    rows = documents.select(F.col("doc_id").cast("long"), "text", F.coalesce(training, F.lit(False)).alias("_t"))
    return rows.mapInArrow(work, "bucket int, block string, gram binary, count binary, info binary")


def _mixed(zeros: np.ndarray, ones: np.ndarray, kin: np.ndarray, below: np.ndarray, bz: np.ndarray, bo: np.ndarray) -> tuple:
    """Log of the weighted probability, own part, weight of what lies below, and estimate of what is no node.

    ``kin`` says which nodes have nodes below, ``below`` sums their weighted logs, bz and bo count the rest.
    """
    kt = _log_kt(zeros, ones)
    both = np.where(kin, np.log(0.5) + np.logaddexp(kt, below + _log_kt(bz, bo)), kt)
    w = np.where(kin, np.exp(np.log(0.5) + kt - both), 1.0)
    return both, w * (ones + 0.5) / (zeros + ones + 1), 1 - w, np.where(kin, (bo + 0.5) / (bz + bo + 1), 0.5)


class _Range:
    """The grams of one range: distinct ones by depth, counts, and which contexts are nodes complete here."""

    def __init__(self, gram: np.ndarray, count: np.ndarray, depth: int, hot: np.ndarray, least: int):
        self.depth, self.hot = depth, hot
        self.keys, self.counts, self.up = {depth: gram}, {depth: count}, {}
        for d in range(depth - 1, 0, -1):
            # The key of a context one byte shorter; sorted, since the byte that goes is a context's last.
            above = self.keys[d + 1]
            self.keys[d], up = np.unique(above >> 16 << 8 | above & 255, return_inverse=True)
            self.up[d] = up.astype(np.int32)
            self.counts[d] = np.bincount(up, self.counts[d + 1], len(self.keys[d]))
            del above, up
        # Per key: whether its context is a node that this range weighs, and whether that has nodes below.
        self.node, self.kin = {}, {}
        for d in range(depth, 1, -1):
            run, starts = self.runs(d, 0)
            full = np.add.reduceat(self.counts[d], starts) >= least if len(starts) else np.zeros(0, bool)
            if d == 2:
                full &= ~np.isin(self.keys[2][starts] >> 8, hot)
            self.node[d] = full[run]
            if d < depth:
                self.kin[d] = (np.bincount(run[self.up[d]], self.node[d + 1], len(starts)) > 0)[run]
            else:
                self.kin[d] = np.zeros(len(run), bool)

    def runs(self, d: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The decision of each key at a level (bits of the byte already known), and each decision's first key."""
        same = self.keys[d] >> (8 - level)
        first = np.ones(len(same), bool)
        first[1:] = same[1:] != same[:-1]
        return np.cumsum(first, dtype=np.int32) - 1, np.flatnonzero(first)

    def level(self, level: int) -> Iterator[tuple]:
        """From the deepest contexts to pairs: depth, decision of each key, first keys, counts and mixture of decisions."""
        child = None
        for d in range(self.depth, 1, -1):
            run, starts = self.runs(d, level)
            n = self.counts[d]
            total = np.add.reduceat(n, starts)
            ones = np.add.reduceat(n * (self.keys[d] >> (7 - level) & 1), starts)
            zeros = total - ones
            below, bz, bo = np.zeros(len(starts)), zeros, ones
            if child is not None:
                first, z, o, both = child
                good = self.node[d + 1][first]
                parent = run[self.up[d][first[good]]]
                below = np.bincount(parent, both[good], len(starts))
                bz = zeros - np.bincount(parent, z[good], len(starts))
                bo = ones - np.bincount(parent, o[good], len(starts))
            mixture = _mixed(zeros, ones, self.kin[d][starts], below, bz, bo)
            child = starts, zeros, ones, mixture[0]
            yield d, run, starts, zeros, ones, mixture

    def partial(self) -> dict[int, np.ndarray]:
        """What nodes above need: (byte counts, zeros and ones of nodes below, their weighted logs, 1 if any) by context.

        Bytes are known by their number, frequent pairs by theirs and 256.
        """
        out: dict[int, np.ndarray] = {}
        for d in (1, 2):
            context, byte = self.keys[d] >> 8, self.keys[d] & 255
            use = np.ones(len(context), bool) if d == 1 else np.isin(context, self.hot)
            for c in np.unique(context[use]):
                row = out[int(c) + (256 if d == 2 else 0)] = np.zeros((5, 256))
                a, b = np.searchsorted(context, (c, c + 1))
                row[0, byte[a:b]] = self.counts[d][a:b]
        for level in range(8):
            for d, _, starts, zeros, ones, mixture in self.level(level):
                if d > 3:
                    continue
                good = self.node[d][starts]
                if d == 3:
                    good &= np.isin(self.keys[3][starts] >> 16, self.hot)
                first = self.keys[d][starts[good]]
                name = (first >> 16) + (256 if d == 3 else 0)
                decision = (1 << level) | ((first & 255) >> (8 - level))
                kinds, which = np.unique(name, return_inverse=True)
                at = which * 256 + decision
                for row, value in ((1, zeros), (2, ones), (3, mixture[0]), (4, np.ones(len(starts)))):
                    sums = np.bincount(at, value[good], len(kinds) * 256).reshape(-1, 256)
                    for i, c in enumerate(kinds):
                        out[int(c)][row] += sums[i]
        return out

    def log10(self, above: dict) -> np.ndarray:
        """log10 of the mixed probability of each gram's byte, ``above`` holding the nodes above the ranges."""
        gram = self.keys[self.depth]
        near, pair = gram >> (8 * self.depth), gram >> (8 * (self.depth - 1))
        result = np.zeros(len(gram))
        at = np.minimum(np.searchsorted(self.hot, pair), max(len(self.hot) - 1, 0))
        hot = self.hot[at] == pair if len(self.hot) else np.zeros(len(gram), bool)
        for level in range(8):
            p, met = np.full(len(gram), 0.5), np.zeros(len(gram), bool)

            def climb(node: np.ndarray, own: np.ndarray, under: np.ndarray, alone: np.ndarray) -> None:
                p[node] = (own + under * np.where(met, p, alone))[node]
                met[node] = True

            place = np.arange(len(gram))
            for d, run, _, _, _, (_, own, under, alone) in self.level(level):
                if d < self.depth:
                    place = self.up[d][place]
                where = run[place]
                climb(self.node[d][place], own[where], under[where], alone[where])
            decision = (1 << level) | ((gram & 255) >> (8 - level))
            if hot.any():
                climb(hot & above["pair_node"][at], *(above["pair"][i, at, decision] for i in range(3)))
            climb(above["byte_node"][near], *(above["byte"][i, near, decision] for i in range(3)))
            climb(np.ones(len(gram), bool), *(above["root"][i, 0, decision] for i in range(3)))
            result += np.log10(np.where(gram >> (7 - level) & 1, p, 1 - p))
        return result


class _Counts:
    """Distinct numbers, ascending, and their summed counts.

    What is added is merged as soon as it is as much as ``MERGED`` numbers and as what is there, so that many rows
    that repeat each other take the room of the distinct numbers.
    """

    def __init__(self, kind: type):
        self.kinds, self.counts = np.zeros(0, kind), np.zeros(0, np.int64)
        self.more: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, kinds: np.ndarray, counts: np.ndarray) -> None:
        self.more.append((kinds, counts))
        self.held += len(kinds)
        if self.held >= max(MERGED, len(self.kinds)):
            self.merge()

    def merge(self) -> None:
        if not self.held:
            return
        every = np.concatenate([self.kinds, *(k for k, _ in self.more)])
        counts = np.concatenate([self.counts, *(c for _, c in self.more)]).astype(np.int64)
        self.more, self.held = [], 0
        order = np.argsort(every, kind="stable")  # of sorted runs
        every = every[order]
        first = _starts(every)
        self.kinds, self.counts = every[first], np.add.reduceat(counts[order], first)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(bucket, some of its rows), in the order of the batches."""
    for batch in batches:
        bucket = batch.column(batch.schema.get_field_index("bucket")).to_numpy(zero_copy_only=False)
        ends = [0, *(np.flatnonzero(np.diff(bucket)) + 1), len(bucket)]
        for a, b in zip(ends, ends[1:]):
            if a < b:
                yield int(bucket[a]), batch.slice(a, b - a)


def _counted(batches: Iterator[pa.RecordBatch], kind: type, column: str, counts: str, numbers: Callable) -> Iterator[tuple[int, _Counts]]:
    """Each bucket's counts, from rows that come bucket by bucket; only distinct numbers are held."""
    at, held = None, None
    for bucket, rows in _runs(batches):
        if bucket != at:
            if held is not None:
                held.merge()
                yield at, held
            at, held = bucket, _Counts(kind)
        for k, n in zip(rows.column(column), rows.column(counts)):
            held.add(numbers(k.as_py()), _unpacked(n.as_py(), np.uint32))
    if held is not None:
        held.merge()
        yield at, held


def _together(rows: DataFrame, *then: str) -> DataFrame:
    """Rows of one bucket one after the other in one task, which needs not hold them all."""
    return rows.repartition("bucket").sortWithinPartitions("bucket", *then)


def _grams(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, np.int64))


def _above(partials: dict[int, np.ndarray], hot: np.ndarray, least: int) -> dict:
    """Own part, weight below and estimate of no nodes of the root, of all bytes and of the frequent pairs."""
    def weigh(rows: np.ndarray) -> tuple[np.ndarray, tuple, np.ndarray]:
        zeros, ones = _bits(rows[:, 0])
        kin = rows[:, 4].sum(1, keepdims=True) > 0
        mixture = _mixed(zeros, ones, np.broadcast_to(kin, zeros.shape), rows[:, 3], zeros - rows[:, 1], ones - rows[:, 2])
        return rows[:, 0].sum(1) >= least, mixture, np.stack([zeros, ones, mixture[0]], axis=1)

    blank = np.zeros((5, 256))
    pairs = np.stack([partials.get(int(c) + 256, blank) for c in hot]) if len(hot) else np.zeros((0, 5, 256))
    pair_node, pair, under = weigh(pairs)
    singles = np.stack([partials.get(c, blank) for c in range(256)])
    for c, good, row in zip(hot >> 8, pair_node, under):
        if good:
            singles[c, 1:4] += row
            singles[c, 4] += 1
    byte_node, byte, under = weigh(singles)
    top = np.zeros((1, 5, 256))
    top[0, 0] = singles[:, 0].sum(0)
    top[0, 1:4] = under[byte_node].sum(0)
    top[0, 4] = byte_node.any()
    _, root, _ = weigh(top)
    return {"pair_node": pair_node, "pair": np.stack(pair[1:]), "byte_node": byte_node, "byte": np.stack(byte[1:]), "root": np.stack(root[1:])}


def tree_scores(
    documents: DataFrame, training: Column, depth: int = DEPTH, buckets: int | None = None, least: int = LEAST,
) -> DataFrame:
    """_id, _tie, score and _bytes of every row; ``depth`` is 3 or more."""
    spark = documents.sparkSession
    if buckets is None:
        size = documents.agg(F.sum(F.octet_length("text").cast("long") + 1).alias("n")).first()["n"] or 0
        buckets = max(4 * parts(spark), -(-size // RANGE_BYTES))
    hot = _hot_pairs(documents, training, buckets)
    blocks = materialize(_gram_blocks(documents, training, depth, hot, buckets), "gram-blocks")
    asked = blocks.filter("bucket IS NOT NULL").select("bucket", "block", "gram", "count")

    kinds = "name long, sums array<double>, bucket int, gram binary, count binary"
    found_rows = pa.schema([
        ("name", pa.int64()), ("sums", pa.list_(pa.float64())), ("bucket", pa.int32()), ("gram", pa.binary()), ("count", pa.binary()),
    ])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, held in _counted(batches, np.int64, "gram", "count", _grams):
            table = {"bucket": bucket, "gram": _packed(np.diff(held.kinds, prepend=0)), "count": _packed(held.counts)}
            found = _Range(held.kinds, held.counts.astype(float), depth, hot, least).partial()
            held = None
            give_back(cycles=False)
            yield pa.RecordBatch.from_pylist([table, *({"name": k, "sums": x.ravel()} for k, x in found.items())], schema=found_rows)

    # Written, so that all ranges are weighed at the same time: each range's distinct grams with their counts, and
    # one row for each of 256 bytes and of the frequent pairs, of which there are fewer than ranges.
    found = materialize(_together(asked.drop("block")).mapInArrow(sums, kinds), "partial-sums")
    partial = found.filter("name IS NOT NULL").select("name", "sums")
    added = partial.groupBy("name").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))
    partials = {r["name"]: np.array(r["sums"]).reshape(5, 256) for r in added.collect()}
    shared = spark.sparkContext.broadcast(_above(partials, hot, least))

    answer = pa.schema([("block", pa.string()), ("bucket", pa.int32()), ("value", pa.binary()), ("info", pa.binary())])

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A range's grams come first, then the rows that ask for them."""
        gram = value = None
        for bucket, rows in _runs(batches):
            out = []
            for block, own, count in zip(*(rows.column(c) for c in ("block", "gram", "count"))):
                if block.is_valid:
                    out.append(_packed(value[np.searchsorted(gram, _grams(own.as_py()))]))
                    continue
                gram = value = None
                gram = _grams(own.as_py())
                value = _Range(gram, _unpacked(count.as_py(), np.int64).astype(float), depth, hot, least).log10(shared.value).astype(np.float32)
                give_back(cycles=False)
            if out:
                yield pa.RecordBatch.from_pydict({
                    "block": rows.column("block").drop_null(), "bucket": [bucket] * len(out), "value": out, "info": [None] * len(out),
                }, schema=answer)

    def back(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        with pa.ipc.open_stream(next(r["info"] for r in rows if r["info"] is not None)) as stream:
            piece = stream.read_all()
        texts = [(t or "").encode() for t in piece.column(1).to_pylist()]
        context, byte, lengths = grams(texts, depth)
        code, kinds = pd.factorize(context << 8 | byte)
        del context, byte
        order = np.argsort(kinds)
        order = order[np.argsort(_bucket(kinds[order] >> 8, depth, hot, buckets), kind="stable")]
        value = np.zeros(len(kinds), np.float64)
        held = sorted((r["bucket"], r["value"]) for r in rows if r["value"] is not None)
        value[order] = np.concatenate([_unpacked(v, np.float32) for _, v in held])
        return pa.table({
            "_id": piece.column(0), "_tie": pa.array([xxhash.xxh3_64_intdigest(t) >> 1 for t in texts], pa.int64()),
            "score": np.add.reduceat(value[code], np.cumsum(lengths) - lengths), "_bytes": pa.array([len(t) + 1 for t in texts], pa.int64()),
        })

    kinds = "block string, bucket int, value binary, info binary"
    tables = found.filter("bucket IS NOT NULL").select("bucket", F.lit(None).cast("string").alias("block"), "gram", "count")
    asking = asked.withColumn("count", F.lit(None).cast("binary"))
    answers = _together(tables.unionByName(asking), "block").mapInArrow(values, kinds)
    info = blocks.filter("info IS NOT NULL").select("block", "bucket", F.lit(None).cast("binary").alias("value"), "info")
    return answers.unionByName(info).groupBy("block").applyInArrow(back, "_id long, _tie long, score double, _bytes long")


def _word_blocks(documents: DataFrame, training: Column, buckets: int) -> DataFrame:
    """Per run of documents and range of word hashes: distinct words, training counts, and who holds them."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for turn, piece in enumerate(pieces(batches, "text", 3 * PIECE_BYTES)):
            data = [(t or "").encode() for t in piece.column(1).to_pylist()]
            words = [t.lower().split() for t in data]
            train = np.array(piece.column(2).to_pylist(), bool)
            lengths = np.array([len(w) for w in words], np.int64)
            # Every distinct word is hashed once.
            found = pa.array([w for ws in words for w in ws], pa.large_binary()).dictionary_encode()
            code = found.indices.to_numpy().astype(np.int64)
            kinds = np.fromiter(map(xxhash.xxh3_64_intdigest, found.dictionary.to_pylist()), np.uint64, len(found.dictionary))
            del words, found
            owner = np.repeat(np.arange(len(lengths)), lengths)
            trained = np.bincount(code, train[owner], len(kinds)).astype(np.uint32)
            # Words are numbered by their ranges; documents and their words ascend, so that differences are small.
            bucket = ((kinds >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
            by_kind = np.argsort(bucket, kind="stable")
            place = np.zeros(len(kinds), np.int64)
            place[by_kind] = np.arange(len(kinds))
            pair, number = np.unique(owner * max(len(kinds), 1) + place[code], return_counts=True)
            block = _block_name(piece.column(0).to_pylist(), data, turn)
            info = pa.RecordBatch.from_pydict({
                "doc_id": piece.column(0), "held_out": pa.array(~train), "n": pa.array(lengths + 1),
                "tie": pa.array([xxhash.xxh3_64_intdigest(t) >> 1 for t in data], pa.int64()),
            })
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, info.schema) as stream:
                stream.write_batch(info)
            ends = np.searchsorted(bucket[by_kind], np.arange(buckets + 1))
            rows = [{
                "block": block, "info": sink.getvalue().to_pybytes(), "pair": _packed(np.diff(pair, prepend=0)),
                "number": _packed(number.astype(np.uint32)),
            }]
            for b in np.flatnonzero(np.diff(ends)):
                own = by_kind[ends[b]:ends[b + 1]]
                rows.append({"bucket": int(b), "block": block, "words": kinds[own].tobytes(), "trained": _packed(trained[own])})
            yield pa.RecordBatch.from_pylist(rows, schema=_BLOCK)

    rows = documents.select(F.col("doc_id").cast("long"), "text", training.alias("_t"))
    return rows.mapInArrow(work, "bucket int, block string, " + ", ".join(f"{c} binary" for c in _BLOCK.names[2:]))


_BLOCK = pa.schema([
    ("bucket", pa.int32()), ("block", pa.string()),
    *((c, pa.binary()) for c in ("info", "pair", "number", "words", "trained")),
])
_WORDS = pa.schema([("bucket", pa.int32()), ("words", pa.binary()), ("trained", pa.binary()), ("distinct", pa.int64()), ("tokens", pa.int64())])
_ANSWER = pa.schema([("block", pa.string()), ("bucket", pa.int32()), ("count", pa.binary())])


def _words(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint64)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of each range of hashes, and how often training has them."""
    for bucket, held in _counted(batches, np.uint64, "words", "trained", _words):
        yield pa.RecordBatch.from_pylist([{
            "bucket": bucket, "words": held.kinds.tobytes(), "trained": _packed(held.counts),
            "distinct": int((held.counts > 0).sum()), "tokens": int(held.counts.sum()),
        }], schema=_WORDS)


def _word_answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training counts of the words of each block; a range's words come first, then the rows that ask for them."""
    words = counts = None
    for bucket, rows in _runs(batches):
        out = []
        for block, own, trained in zip(*(rows.column(c) for c in ("block", "words", "trained"))):
            if block.is_valid:
                out.append(_packed(counts[np.searchsorted(words, _words(own.as_py()))]))
            else:
                words, counts = _words(own.as_py()), _unpacked(trained.as_py(), np.int64)
        if out:
            yield pa.RecordBatch.from_pydict({"block": rows.column("block").drop_null(), "bucket": [bucket] * len(out), "count": out}, schema=_ANSWER)


def _per_document(table: pa.Table) -> pa.Table:
    """What the words of each of a block's documents add up to."""
    rows = table.to_pylist()
    own = next(r for r in rows if r["info"] is not None)
    with pa.ipc.open_stream(own["info"]) as stream:
        info = stream.read_all()
    held = sorted((r["bucket"], r["count"]) for r in rows if r["count"] is not None)
    count = np.concatenate([np.zeros(0, np.int64), *(_unpacked(c, np.int64) for _, c in held)])
    (owner, word), number = np.divmod(_grams(own["pair"]), max(len(count), 1)), _unpacked(own["number"], np.uint32)
    sums = np.bincount(owner, np.log10(count + 1)[word] * number, info.num_rows)
    known = np.bincount(owner, (count > 0)[word] * number, info.num_rows).astype(np.int64)
    return info.append_column("sums", pa.array(sums)).append_column("known", pa.array(known))


def unigram(documents: DataFrame, training: Column) -> DataFrame:
    """doc_id, tie, held_out, n_tokens, n_known, train_tokens and base_score of every row."""
    size = documents.agg(F.sum(F.octet_length("text").cast("long") + 1).alias("n")).first()["n"] or 0
    buckets = max(parts(documents.sparkSession), -(-size // WORD_BYTES))
    blocks = materialize(_word_blocks(documents, training, buckets), "word-blocks")
    asked = blocks.filter("bucket IS NOT NULL").select("bucket", "block", "words", "trained")
    kinds = "bucket int, words binary, trained binary, distinct long, tokens long"
    counts = materialize(_together(asked.drop("block")).mapInArrow(_word_counts, kinds), "word-sums")
    totals = counts.agg(F.coalesce(F.sum("distinct"), F.lit(0)).alias("v"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first()
    tables = counts.select("bucket", F.lit(None).cast("string").alias("block"), "words", "trained")
    asking = asked.withColumn("trained", F.lit(None).cast("binary"))
    answers = _together(tables.unionByName(asking), "block").mapInArrow(_word_answers, "block string, bucket int, count binary")
    info = blocks.filter("info IS NOT NULL").select("block", "info", "pair", "number")
    rows = answers.unionByName(info, allowMissingColumns=True).groupBy("block").applyInArrow(
        _per_document, "doc_id long, held_out boolean, n long, tie long, sums double, known long",
    )
    rows = materialize(rows, "unigram")
    texts = rows.filter("NOT held_out").count()
    tokens, distinct = totals["n"] + texts, totals["v"] + (texts > 0)
    end = float(np.log10(texts + 1))
    return rows.select(
        "doc_id", "tie", "held_out", F.col("n").alias("n_tokens"), (F.col("known") + F.lit(int(texts > 0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("sums") + F.lit(end) - F.col("n") * F.lit(float(np.log10(tokens + distinct + 1)))).alias("base_score"),
    )


def score(documents: DataFrame, training: Column, depth: int = DEPTH, least: int = LEAST) -> DataFrame:
    """Both models' log10 probabilities of every row, learned from the rows that ``training`` names.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte. Whole texts are
    learned and scored; null texts are empty and hold their end only. Rows are matched by doc_id (null
    included) and a hash of the text, so repeated rows and doc_ids keep their own scores. An empty table
    gives an empty one; without training rows every byte has probability 1 / 256 and N is 0.
    """
    scored = tree_scores(documents, training, depth, least=least)
    scored = scored.groupBy("_id", "_tie").agg(F.min("score").alias("score"), F.min("_bytes").alias("_bytes"))
    rows = unigram(documents, training)
    joined = rows.join(scored, rows["doc_id"].eqNullSafe(F.col("_id")) & (rows["tie"] == F.col("_tie")))
    return joined.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
        (-F.col("score") * float(np.log2(10)) / F.col("_bytes")).alias("bits_per_byte"),
    )
