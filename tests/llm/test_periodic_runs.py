"""Periodic runs against all stretches of all periods."""

import hashlib
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from rowloom.llm import periodic_runs as pr
from rowloom.llm.common import crc_text


def all_runs(words):
    """Every stretch that keeps a period and cannot be extended, with its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, end = i, j + q
            if end - start >= max(6, 4 * q):
                found.setdefault((start, end), q)  # a smaller period of the same stretch came first
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = pr.tail_of(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = all_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    exponent = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, exponent, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def made():
    rng = random.Random(3)
    yield from brute.texts(30)
    for alphabet in (1, 2, 3):
        for n in (0, 1, 5, 6, 7, 40, 90, 200):
            yield " ".join(rng.choice("abc"[:alphabet]) for _ in range(n))
    for period in (1, 2, 3, 7, 16, 17, 33):  # nested repeats, cut at odd places
        unit = [rng.choice("pq") for _ in range(period)] + ["z"]
        yield "\n".join((["x"] + unit * 9 + unit[:period // 2] + ["y", "y"]) * 5)
    a = ["a"]
    for _ in range(9):  # Fibonacci words have runs of every size
        a = a + (["b"] + a)[: len(a)]
    yield " ".join(a)
    yield "ab " * 4000 + "tail"


@pytest.mark.parametrize("seed", range(60))
def test_runs_of_random_letters(seed):
    rng = random.Random(seed)
    letters = [rng.randrange(1 + seed % 3) for _ in range(rng.randrange(150))]
    unit = letters[:1 + seed % 20]
    letters = letters[:50] + unit * (seed % 7) + letters[50:]
    got = pr._sorted(pr.runs_of(np.array(letters, np.int64)))
    assert [tuple(r) for r in got.tolist()] == all_runs(letters)


def test_summary_equals_brute_force(spark):
    rows = [(i * 7, t, f"s{i}", i) for i, t in enumerate(made())]
    rows += [rows[33], rows[33], (None, "a b " * 9, None, None), (None, None, None, 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, n_runs string, start long").repartition(3)
    got = pr.summary(table, crc_text(F.col("doc_id"))).collect()
    want = [expected(r[0], r[1]) for r in rows]
    assert any(w[1] > 1 for w in want) and any(w[1] == 0 for w in want)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_runs_and_collapsed_words(spark):
    table = spark.createDataFrame([(1, "x a b a b a b a b y")], "doc_id long, text string")
    row = pr.find(table).first()
    assert (row.n_words, [tuple(r) for r in row.runs], row.collapsed) == (10, [(1, 8, 2)], "x a b y")


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pr.summary(empty, crc_text(F.col("doc_id"))).collect() == []
