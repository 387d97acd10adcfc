"""Stretches of words that repeat with a period, by the dictionary of basic factors.

A basic factor is a stretch of 2**k words; equal ones of a document share a name. Names of length 2**(k+1)
are pairs of names of length 2**k, and only factors that occur more than once are kept, so natural text has
few levels. At each length the successor of an occurrence is the next one of the same name; occurrences no
further apart than the length, three in arithmetic progression, propose their distance as a period. A
proposal is extended to both sides by comparing factors of falling lengths, and equal results are one run.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces
from .winnowing import let

#: A run has so many words at least, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4

#: Bytes of text handled at a time, one document at least.
PIECE = 1 << 20

_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _groups(keys: np.ndarray, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, names) of the keys that occur more than once, by name and then by position."""
    order = np.argsort(keys, kind="stable")
    keys, positions = keys[order], positions[order]
    same = keys[1:] == keys[:-1]
    repeated = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    first = np.concatenate([[True], ~same])
    return positions[repeated], np.cumsum(first[repeated]) - 1


def factors(letters: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each k (positions, names) of the factors of 2**k letters that occur more than once, by position."""
    return [(positions, names) for positions, names, _, _ in _levels(letters)]


def _levels(letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """As ``factors``, and the same once more in the order of names."""
    n, length = len(letters), 1
    keys, positions = letters.astype(np.int64), np.arange(n)
    here = np.full(n + 1, -1, np.int64)
    while len(positions):
        grouped, named = _groups(keys, positions)
        if not len(grouped):
            return
        order = np.argsort(grouped, kind="stable")
        positions, names = grouped[order], named[order]
        yield positions, names, grouped, named
        here[:] = -1
        here[positions] = names
        after = here[np.minimum(positions + length, n)]
        both = after >= 0
        keys, positions = names[both] * (int(names.max()) + 1) + after[both], positions[both]
        length *= 2


def _equal(level: tuple[np.ndarray, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the factors at a and at b share a name; places outside of the text share none."""
    positions, names = level

    def name(at: np.ndarray, absent: int) -> np.ndarray:
        i = np.minimum(np.searchsorted(positions, at), len(positions) - 1)
        return np.where(positions[i] == at, names[i], absent)

    return name(a, -1) == name(b, -2)


def runs_of(letters: np.ndarray) -> np.ndarray:
    """(start, length, period) of every run, by start and period.

    A run is a stretch with smallest period q, 4 q letters and 6 letters long at least, that cannot be
    extended. With 2**(k-1) < q <= 2**k its factors of length 2**k follow each other at distance q exactly,
    since its period is no power, and the run has room for three of them: it is proposed at level k.
    """
    levels, starts, periods = [], [], []
    for k, (positions, names, grouped, named) in enumerate(_levels(letters)):
        levels.append((positions, names))
        gap, same, length = np.diff(grouped), named[1:] == named[:-1], 1 << k
        series = same[:-1] & same[1:] & (gap[:-1] == gap[1:]) & (2 * gap[:-1] > length) & (gap[:-1] <= length)
        at, gap = grouped[:-2][series], gap[:-1][series]
        order = np.lexsort((at, gap))
        at, gap = at[order], gap[order]
        # Proposals at consecutive places lie in one run.
        new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(gap) != 0)])[:len(at)]
        starts.append(at[new])
        periods.append(gap[new])
    if not starts:
        return np.zeros((0, 3), np.int64)
    left, period = np.concatenate(starts), np.concatenate(periods)
    right = left.copy()
    for k in range(len(levels) - 1, -1, -1):
        right += np.where(_equal(levels[k], right, right + period), 1 << k, 0)
        back = left - (1 << k)
        left = np.where(_equal(levels[k], back, back + period), back, left)
    length = right + period - left
    whole = (length >= LEAST_WORDS) & (length >= LEAST_PERIODS * period)
    return np.unique(np.stack([left[whole], length[whole], period[whole]], axis=1), axis=0)


def _sorted(runs: np.ndarray) -> np.ndarray:
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def words_of(text: bytes | None) -> list[bytes]:
    """Stretches without ASCII white space."""
    return (text or b"").split()


def _piece(texts: list[bytes | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each text, where each text's words start in the piece, and all runs of the piece.

    Equal words of different texts get different letters, so a factor that crosses two texts occurs once.
    """
    words, letters, base = [words_of(t) for t in texts], [], 0
    for ws in words:
        known: dict[bytes, int] = {}
        letters.append(np.fromiter((known.setdefault(w, len(known)) for w in ws), np.int64, len(ws)) + base)
        base += len(known)
    starts = np.concatenate([[0], np.cumsum([len(ws) for ws in words])]).astype(np.int64)
    return words, starts, _sorted(runs_of(np.concatenate(letters) if letters else np.zeros(0, np.int64)))


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those of a run after its first period, joined by a blank."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return b" ".join(compress(words, (np.cumsum(change[:-1]) == 0).tolist()))


def find(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed of every row.

    Words are stretches without ASCII white space, numbered from 0. ``collapsed`` holds the words that no
    run contains after its first period, joined by a blank. A null or empty text has no words, no runs and
    an empty ``collapsed``; equal rows are all kept; an empty table gives an empty one; only doc_id and
    text are read. Every document is searched whole, where it is read: nothing is shuffled.
    """
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", PIECE):
            words, starts, runs = _piece(piece.column(1).to_pylist())
            cuts = np.searchsorted(runs[:, 0], starts)
            shift = np.repeat(starts[:-1], np.diff(cuts))
            runs[:, 0] -= shift
            flat = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(runs[:, i])) for i in range(3)], ["start", "length", "period"])
            kept = [collapse(ws, runs[a:b]).decode() for ws, a, b in zip(words, cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([
                piece.column(0), pa.array(np.diff(starts)), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), flat), pa.array(kept, pa.string()),
            ], ["doc_id", "n_words", "runs", "collapsed"])

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(search, f"doc_id bigint, n_words bigint, runs {_RUNS}, collapsed string")


def most_periodic(runs: Column) -> Column:
    """The run with the greatest length / period, of equal ones the first; null without runs."""
    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def as_lines(runs: Column) -> Column:
    """``start,length,period`` and a line feed for each run."""
    line = F.transform(runs, lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"),
    ))
    return F.array_join(line, "")


def with_periodic_tails(documents: DataFrame, checksum: Column) -> DataFrame:
    """doc_id and text, where every tenth text (by checksum) repeats words of itself up to its end.

    With n words and g the checksum by ten, words from a = g % n on become the p words at a, over and over,
    p = 1 + (n - a) // (3 + g % 8). Words of a changed text are joined by a blank.
    """
    g = F.floor(checksum / 10)

    def repeat(words: Column) -> Column:
        n = F.size(words).cast("long")

        def from_a(a: Column) -> Column:
            p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
            return F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))

        return F.when(n > 0, F.array_join(let(g % n, from_a), " ")).otherwise(F.lit(""))

    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return documents.select("doc_id", F.when(checksum % 10 == 0, let(words, repeat)).otherwise(F.col("text")).alias("text"))


def tail_of(doc_id, words: list) -> list:
    """The words of one changed text, for tests."""
    h = zlib.crc32(str("" if doc_id is None else doc_id).encode())
    if h % 10 or not words:
        return words
    a = h // 10 % len(words)
    p = 1 + (len(words) - a) // (3 + h // 10 % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(len(words))]


def summary(documents: DataFrame, checksum: Column) -> DataFrame:
    """Runs of the texts with periodic tails: their number, the most periodic one, and digests."""
    found = find(with_periodic_tails(documents, checksum)).withColumn("_best", most_periodic(F.col("runs")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.floor(F.col("_best.length") * 1000 / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(as_lines(F.col("runs")), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
