"""Near copies by the Jaccard index of word n-grams, as a blocked sparse matrix product.

The matrix has a row per distinct set of n-grams and a column per n-gram. Its product with its own
transpose holds the overlap of every two sets, and most of it is never computed:

1. The matrix is cut into blocks of documents by ranges of columns. A task per column range counts how many
   rows hold each n-gram and returns only the columns that two rows share, back to their rows.
2. A row of size n whose shared n-grams number less than 0.8 n can reach nobody: it is discarded. For the
   rest, any partner of 0.8 or more holds one of the first n - ceil(0.8 n) + 1 n-grams, rarest first.
3. Rows that meet in such a prefix column form rough groups. Within a group, rows are multiplied with all
   rows not reached yet, overlaps are accumulated per row, pairs below the bound that follows from both
   sizes are dropped, and the reached rows go on: a breadth-first search along the links, exact, without a
   list of all pairs. A group too large for one task is searched by joins instead: rows of each prefix
   column are compared with a few of its rows, what links is merged, and at last every pair of rows that
   share a prefix column and lie in different components is compared, which is linear in the size of the
   merged ones.

N-grams are 64-bit hashes of word hashes; within the matrix a column is known by its range and 48 further
bits. Two different n-grams of one pair meet with a chance below one in 10**9.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.session import materialize
from . import components
from .common import give_back, giving_back, kept, parts, pieces

#: Text of one block of documents.
BLOCK_BYTES = 8 << 20
#: Text whose words are held as such at a time.
WORDS_BYTES = 1 << 20
#: Entries of the matrix per range of columns: what one task counts.
RANGE_ENTRIES = 3_000_000
#: Entries of a range that are compared with each other at a time.
SLICE_ENTRIES = 200_000
#: A rough group is searched in one task up to so many rows and shared entries, else by joins.
GROUP_ROWS = 4_096
GROUP_ENTRIES = 6_000_000
#: Distinct words a worker remembers (a cache only).
CACHE_WORDS = 250_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes]) -> np.ndarray:
    known = kept("word hashes", dict)
    new = set(words).difference(known)
    if len(known) + len(new) > CACHE_WORDS:
        known.clear()
        new = set(words)
    for w in new:
        known[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def ngram_sets(texts: list[str | None], n: int = 5) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text; fewer than n words are one n-gram, no words none."""
    words = [(t or "").encode().lower().split() for t in texts]
    flat = word_hashes([w for ws in words for w in ws])
    rolled = np.zeros(0, np.uint64)
    if len(flat) >= n:
        rolled = flat[: len(flat) - n + 1].copy()
        for k in range(1, n):
            rolled = rolled * _MULTIPLIER + flat[k:len(flat) - n + 1 + k]
        rolled = _mixed(rolled)
    found, at = [], 0
    for ws in words:
        m = len(ws)
        if m >= n:
            found.append(np.unique(rolled[at:at + m - n + 1]))
        elif m:
            h = np.uint64(m)
            with np.errstate(over="ignore"):
                for x in flat[at:at + m]:
                    h = h * _MULTIPLIER + x
            found.append(_mixed(np.array([h], np.uint64)))
        else:
            found.append(np.zeros(0, np.uint64))
        at += m
    return found


def _sets(batches: Iterator[pa.RecordBatch], column: int, n: int) -> Iterator[np.ndarray]:
    """The sets of all rows of ``batches``; words are held for a small part of the texts at a time."""
    for piece in pieces(batches, "text", WORDS_BYTES):
        yield from ngram_sets(piece.column(column).to_pylist(), n)


def _class(grams: np.ndarray) -> int:
    """A set's own number: 64 bits of its n-grams, as a signed long."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).astype(np.int64))


def sizes(documents: DataFrame, n: int = 5) -> DataFrame:
    """doc_id, n_shingles and the number of its set (null for an empty one) of every row."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", BLOCK_BYTES):
            sets = list(_sets(iter([piece]), 1, n))
            yield pa.RecordBatch.from_pydict({
                "doc_id": piece.column(0), "n_shingles": pa.array([len(x) for x in sets], pa.int64()),
                "set": pa.array([_class(x) if len(x) else None for x in sets], pa.int64()),
            })

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text"))
    return materialize(rows.mapInArrow(giving_back(count), "doc_id long, n_shingles long, set long"), "shingle-sizes")


def _blocks(documents: DataFrame, ranges: int, n: int) -> DataFrame:
    """Blocks of the matrix: per column range the entries of a run of documents, equal sets once."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", BLOCK_BYTES):
            sets = {}
            for grams in _sets(iter([piece]), 0, n):
                if len(grams):
                    sets.setdefault(_class(grams), grams)
            if not sets:
                continue
            rows = np.fromiter(sets, np.int64, len(sets))
            size = np.array([len(x) for x in sets.values()], np.uint32)
            every = np.concatenate(list(sets.values()))
            column = ((every >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.uint16)
            order = np.argsort(column, kind="stable")
            owner = np.repeat(np.arange(len(rows), dtype=np.uint32), size)[order]
            every = every[order]
            ends = np.searchsorted(column[order], np.arange(ranges + 1))
            out = {"range": [], "rows": [], "sizes": [], "counts": [], "low": [], "high": []}
            for r in range(ranges):
                a, b = ends[r], ends[r + 1]
                if a == b:
                    continue
                held, counts = np.unique(owner[a:b], return_counts=True)
                out["range"].append(r)
                out["rows"].append(rows[held].tobytes())
                out["sizes"].append(size[held].tobytes())
                out["counts"].append(counts.astype(np.uint32).tobytes())
                out["low"].append(every[a:b].astype(np.uint32).tobytes())
                out["high"].append((every[a:b] >> np.uint64(32)).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_pydict(out, schema=_BLOCK)

    return documents.select("text").mapInArrow(giving_back(cut), "range int, rows binary, sizes binary, counts binary, low binary, high binary")


_BLOCK = pa.schema([("range", pa.int32()), *((c, pa.binary()) for c in ("rows", "sizes", "counts", "low", "high"))])
_BACK = pa.schema([("owner", pa.int32()), *((c, pa.binary()) for c in ("rows", "sizes", "counts", "grams", "held"))])


def _flat(column: pa.ChunkedArray, kind) -> np.ndarray:
    """All values of a binary column one after the other, as numbers; a column of one chunk is not copied."""
    found = []
    for chunk in column.chunks:
        _, offsets, values = chunk.buffers()
        ends = np.frombuffer(offsets, np.int32)[chunk.offset:chunk.offset + len(chunk) + 1]
        found.append(np.frombuffer(values, np.uint8)[ends[0]:ends[-1]].view(kind) if values is not None and ends[-1] > ends[0] else np.zeros(0, kind))
    return found[0] if len(found) == 1 else np.concatenate([np.zeros(0, kind), *found])


def _entries(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places of entries that lie in runs."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def _shared_columns(owners: int):
    """For one column range: the entries of columns with two rows or more, to the owners of the rows.

    Columns are counted in slices and entries gathered per owner, so that beside the range itself and the result
    a few bytes per entry are held.
    """
    def count(table: pa.Table) -> pa.Table:
        kept("nothing", bool)
        row, size, counts = _flat(table["rows"], np.int64), _flat(table["sizes"], np.uint32), _flat(table["counts"], np.uint32).astype(np.int64)
        low, high = _flat(table["low"], np.uint32), _flat(table["high"], np.uint16)
        starts = np.cumsum(counts) - counts
        # A set that several blocks hold counts once.
        _, first = np.unique(row, return_index=True)
        once = np.zeros(len(row), bool)
        once[first] = True
        kept_entry = np.repeat(once, counts)
        held = np.zeros(len(low), np.uint16)
        slices = max(1, len(low) // SLICE_ENTRIES)
        part = (low % np.uint32(slices)).astype(np.uint16)
        for k in range(slices):
            at = np.flatnonzero((part == k) & kept_entry)
            _, where, number = np.unique(
                low[at] | (high[at].astype(np.int64) << 32), return_inverse=True, return_counts=True,
            )
            held[at] = np.minimum(number, 65_535).astype(np.uint16)[where]
        del part, kept_entry
        place = int(table["range"][0].as_py()) << 48
        first.sort()
        owner = (row[first] % owners).astype(np.int32)
        order = np.argsort(owner, kind="stable")
        rows_by_owner = first[order]
        ends = np.searchsorted(owner[order], np.arange(owners + 1))
        out = {c: [] for c in _BACK.names}
        for o in range(owners):
            mine = rows_by_owner[ends[o]:ends[o + 1]]
            if not len(mine):
                continue
            at = _entries(starts[mine], counts[mine])
            shared = held[at] > 1
            number = np.bincount(np.repeat(np.arange(len(mine)), counts[mine])[shared], minlength=len(mine))
            at, mine, number = at[shared], mine[number > 0], number[number > 0]
            if not len(at):
                continue
            out["owner"].append(o)
            out["rows"].append(row[mine].tobytes())
            out["sizes"].append(size[mine].tobytes())
            out["counts"].append(number.astype(np.uint32).tobytes())
            out["grams"].append((low[at] | (high[at].astype(np.int64) << 32) | place).tobytes())
            out["held"].append(held[at].tobytes())
        found = pa.table(out, schema=_BACK)
        del out, row, size, counts, low, high, held
        give_back()
        return found

    return count


def _needed(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def _candidates(percent: int):
    """Rows that can reach a partner: set, size, shared n-grams rarest first, and the prefix to meet by."""
    def gather(table: pa.Table) -> pa.Table:
        row, size, counts = _flat(table["rows"], np.int64), _flat(table["sizes"], np.uint32), _flat(table["counts"], np.uint32).astype(np.int64)
        grams, held = _flat(table["grams"], np.int64), _flat(table["held"], np.uint16)
        starts = np.cumsum(counts) - counts
        order = np.argsort(row, kind="stable")
        sets, begin, runs = np.unique(row[order], return_index=True, return_counts=True)
        out = {"set": [], "size": [], "grams": [], "prefix": []}
        for s, a, k in zip(sets.tolist(), begin.tolist(), runs.tolist()):
            mine = order[a:a + k]
            n, m = int(size[mine[0]]), int(counts[mine].sum())
            need = _needed(n, percent)
            if m < need:
                continue
            at = _entries(starts[mine], counts[mine])
            own = grams[at]
            own = own[np.lexsort((own, held[at]))]
            out["set"].append(s)
            out["size"].append(n)
            out["grams"].append(own.tobytes())
            out["prefix"].append(own[:m - need + 1])
        found = pa.table(out, schema=_CANDIDATE)
        del out, row, size, counts, grams, held, order
        give_back()
        return found

    return gather


_CANDIDATE = pa.schema([("set", pa.int64()), ("size", pa.int64()), ("grams", pa.binary()), ("prefix", pa.list_(pa.int64()))])
_CANDIDATE_DDL = "set long, size long, grams binary, prefix array<long>"


def linked(overlap, a, b, percent: int = 80):
    """Whether an overlap of sets of sizes a and b is ``percent`` of their union or more."""
    return 100 * overlap >= percent * (a + b - overlap)


def search(sets: np.ndarray, size: np.ndarray, grams: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that span the components of a group, (row, row reached), by products with the rows left."""
    m = len(sets)
    kinds, code = np.unique(np.concatenate(grams), return_inverse=True)
    number = np.array([len(g) for g in grams])
    starts = np.concatenate([[0], np.cumsum(number)])
    left = np.arange(m)
    mark = np.zeros(len(kinds), bool)
    found = []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            i = queue.pop()
            # The overlap is at most the fewer shared n-grams of the two.
            least = np.minimum(number[left], number[i])
            near = left[linked(least, size[left], size[i], percent)]
            if not len(near):
                continue
            mine = code[starts[i]:starts[i + 1]]
            mark[mine] = True
            lengths = number[near]
            begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            entries = np.repeat(starts[near] - begin, lengths) + np.arange(lengths.sum())
            overlap = np.add.reduceat(mark[code[entries]].astype(np.int64), begin)
            mark[mine] = False
            reached = near[linked(overlap, size[near], size[i], percent)]
            found += [(int(sets[i]), int(sets[j])) for j in reached]
            queue += reached.tolist()
            left = np.setdiff1d(left, reached, assume_unique=True)
    return found


_LINK = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _search_groups(percent: int):
    """Groups that lie one after the other in a partition, each searched when it is complete."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple[int, int]] = []

        def finish() -> None:
            if len(held) > 1:
                out.extend(search(
                    np.array([x[1] for x in held], np.int64), np.array([x[2] for x in held], np.int64),
                    [np.frombuffer(x[3], np.int64) for x in held], percent,
                ))
            held.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    finish()
                held.append(row)
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=_LINK)
                out = []
        finish()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=_LINK)

    return run


def _compare(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = [], []
            for a, b, n, k, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                overlap = len(np.intersect1d(np.frombuffer(x, np.int64), np.frombuffer(y, np.int64), assume_unique=True))
                if linked(overlap, n, k, percent):
                    u.append(a)
                    v.append(b)
            yield pa.RecordBatch.from_pydict({"u": u, "v": v}, schema=_LINK)

    return run


def _verified(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    a = rows.select(F.col("set").alias("a"), F.col("size").alias("n"), F.col("grams").alias("x"))
    b = rows.select(F.col("set").alias("b"), F.col("size").alias("k"), F.col("grams").alias("y"))
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "n", "k", "x", "y")
    return materialize(joined.mapInArrow(_compare(percent), "u long, v long"), "links")


def _search_by_joins(rows: DataFrame, percent: int, rounds: int = 3) -> DataFrame:
    """Links of rough groups of any size; no task holds a group and no list holds all its pairs."""
    spark = rows.sparkSession
    entries = rows.select("set", "size", (F.octet_length("grams") / 8).cast("long").alias("shared"), F.explode("prefix").alias("token"))
    entries = materialize(entries, "prefixes")
    labels = spark.createDataFrame([], "set long, label long")
    links = spark.createDataFrame([], "u long, v long")
    tested = spark.createDataFrame([], "a long, b long")
    smaller = F.least("shared", "other_shared")
    possible = 100 * smaller >= percent * (F.col("size") + F.col("other_size") - smaller)
    for r in range(rounds + 1):
        placed = entries.join(labels, "set", "left").withColumn("label", F.coalesce("label", "set"))
        mixed = placed.groupBy("token").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l <> h").select("token")
        placed = materialize(placed.join(mixed, "token", "left_semi"), "placed")
        if r < rounds:
            # A few rows per column stand for it; columns of one group mostly agree on them.
            lot = F.struct(F.xxhash64(F.lit(r), F.pmod("token", F.lit(4)), "set").alias("h"), "set", "size", "shared", "label")
            chosen = placed.groupBy("token").agg(F.min(lot).alias("c"))
        else:
            # Rows outside a column's most frequent component meet all rows of the column.
            main = placed.groupBy("token", "label").count().groupBy("token").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
            chosen = placed.join(main, "token").filter("label <> main").select("token", F.struct("set", "size", "shared", "label").alias("c"))
        others = chosen.select(
            "token", F.col("c.set").alias("other"), F.col("c.size").alias("other_size"),
            F.col("c.shared").alias("other_shared"), F.col("c.label").alias("other_label"),
        )
        met = placed.join(others, "token").filter((F.col("label") != F.col("other_label")) & possible)
        pairs = met.select(F.least("set", "other").alias("a"), F.greatest("set", "other").alias("b")).distinct()
        pairs = materialize(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        links = links.union(_verified(pairs, rows, percent))
        if r < rounds:
            tested = tested.union(pairs)
            labels = components.roots(links).select(F.col("u").alias("set"), F.col("v").alias("label"))
    return links


def links_between(documents: DataFrame, entries: int, n: int = 5, percent: int = 80,
                  group_rows: int = GROUP_ROWS, group_entries: int = GROUP_ENTRIES) -> DataFrame:
    """(u, v): links between sets that span every component of the near-copy graph.

    ``entries`` is the number of entries of the matrix; it sets the number of column ranges.
    """
    spark = documents.sparkSession
    ranges = max(1, min(32_768, -(-entries // RANGE_ENTRIES)))
    owners = max(ranges, parts(spark))
    back = _blocks(documents, ranges, n).groupBy("range").applyInArrow(
        _shared_columns(owners), "owner int, rows binary, sizes binary, counts binary, grams binary, held binary",
    )
    rows = materialize(back.groupBy("owner").applyInArrow(_candidates(percent), _CANDIDATE_DDL), "candidates")

    entry = rows.select("set", F.explode("prefix").alias("token"))
    hubs = entry.groupBy("token").agg(F.min("set").alias("v"))
    rough = components.roots(entry.join(hubs, "token").select(F.col("set").alias("u"), "v"))
    grouped = rows.join(rough.withColumnRenamed("u", "set").withColumnRenamed("v", "root"), "set", "left")
    grouped = grouped.withColumn("root", F.coalesce("root", "set"))
    volume = grouped.select("root", F.octet_length("grams").alias("bytes")).groupBy("root").agg(
        F.count(F.lit(1)).alias("rows"), (F.sum("bytes") / 8).alias("entries"),
    )
    fits = (F.col("rows") <= group_rows) & (F.col("entries") <= group_entries)
    volume = materialize(volume.filter("rows > 1").select("root", fits.alias("fits")), "rough-groups")
    small = (
        grouped.join(volume.filter("fits").select("root"), "root", "left_semi")
        .select("root", "set", "size", "grams").repartition(parts(spark), "root").sortWithinPartitions("root", "set")
        .mapInArrow(giving_back(_search_groups(percent)), "u long, v long")
    )
    small = materialize(small, "group-links")
    if volume.filter("NOT fits").isEmpty():
        return small
    large = materialize(grouped.join(volume.filter("NOT fits").select("root"), "root", "left_semi").drop("root"), "large-groups")
    return small.unionByName(_search_by_joins(large, percent))


def near_copies(documents: DataFrame, n: int = 5, percent: int = 80, **limits: int) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every row.

    Words are runs of other characters than ASCII white space, A-Z in lower case. A text of fewer than n
    words is one n-gram; a null or blank text has an empty set and is linked with nothing. Rows with equal
    sets are linked, repeated rows and repeated doc_ids included; a null doc_id is never a component's
    smallest unless there is no other. Only doc_id and text are read. An empty table gives an empty one.
    """
    found = sizes(documents, n)
    entries = found.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    links = links_between(documents, entries, n, percent, **limits)
    labels = components.roots(links).select(F.col("u").alias("set"), F.col("v").alias("label"))
    classes = found.filter("set IS NOT NULL").groupBy("set").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    placed = classes.join(labels, "set", "left").withColumn("label", F.coalesce("label", "set"))
    least = placed.groupBy("label").agg(F.min("least").alias("component"), F.sum("rows").alias("rows")).filter("rows > 1")
    linked_sets = placed.select("set", "label").join(least.select("label", "component"), "label").select("set", "component")
    return (
        found.join(linked_sets, "set", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )
