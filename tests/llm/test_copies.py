"""Near copies and fingerprints against brute force."""

import hashlib
import random
import tracemalloc

import brute
import numpy as np
import pyarrow as pa
import pytest

from rowloom.llm import components, ngram_join, winnowing
from pyspark.sql import functions as F


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(200 + i, 201 + i) for i in range(30)] + [(5, 5)]
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {r.u: r.v for r in components.roots(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: root(n) for n in parent if root(n) != n}
    assert components.roots(spark.createDataFrame([], "u long, v long")).collect() == []


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(8)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = [(r[0], r[1]) for r in brute.rows(25)]
    for i in range(50):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(9999)}"
        rows.append((1000 + i, (" " if i % 2 else "\n").join(copy).upper() if i % 3 else " ".join(copy)))
    return rows


@pytest.mark.parametrize("limits", [{}, {"group_rows": 3}, {"group_entries": 50}])
def test_near_copies(spark, documents, limits):
    df = spark.createDataFrame([(*r, 0) for r in documents], "doc_id long, text string, component_id long").repartition(6)
    got = ngram_join.near_copies(df, **limits).collect()
    assert brute.ordered(got) == brute.ordered(brute.near_copies(documents))


def test_no_documents(spark):
    assert ngram_join.near_copies(spark.createDataFrame([], "doc_id long, text string")).collect() == []




def test_winnowing_chooses_by_definition(spark):
    texts = [t or "" for t in brute.texts(20)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = {r.i: r for r in df.select("i", winnowing._grams(F.col("t")).alias("g"), winnowing.minima(F.col("t")).alias("m")).collect()}
    top, w = winnowing._TOP, winnowing.WINDOW
    for i, t in enumerate(texts):
        grams = [(g >> winnowing._BITS, top - (g & top)) for g in got[i].g]
        assert [p for _, p in grams] == list(range(max(len(t) - winnowing.K + 1, min(len(t), 1))))
        by_text = {}
        for h, p in grams:
            assert by_text.setdefault(t[p:p + winnowing.K], h) == h
        windows = [grams[k:k + w] for k in range(max(len(grams) - w + 1, min(len(grams), 1)))]
        chosen = [min(x, key=lambda g: (g[0], -g[1])) for x in windows]
        assert [(m >> winnowing._BITS, top - (m & top)) for m in got[i].m] == chosen


def test_shared_run_shares_a_fingerprint(spark):
    run = "".join(chr(97 + i * 7 % 26) for i in range(winnowing.K + winnowing.WINDOW - 1))
    df = spark.createDataFrame([("1" * 90 + run + "2" * 40, "345" * 30 + run)], "a string, b string")
    share = df.select(winnowing.likeness(winnowing.hashes(winnowing.minima(F.col("a"))), winnowing.hashes(winnowing.minima(F.col("b"))))).first()[0]
    assert 0 < share < 1


def test_compare(spark):
    rows = [(i * 3, t) for i, t in enumerate(brute.texts(20))]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_chars long").repartition(4)
    got = {r.doc_id: r for r in winnowing.compare(df).collect()}
    assert len(got) == len(rows)
    edits = []
    for i, (k, t) in enumerate(rows):
        t, after = t or "", rows[(i + 1) % len(rows)][1] or ""
        n, m = len(t), len(t) // 4
        edits.append((k, t[:n - m] + after[:m]))
        assert got[k].n_chars == n and got[k].edited_sha256 == hashlib.sha256(edits[-1][1].encode()).hexdigest()
    again = spark.createDataFrame(edits, "doc_id long, text string")
    plain = {r.doc_id: r.f for r in again.select("doc_id", winnowing.as_text(F.array_distinct(winnowing.minima(F.col("text")))).alias("f")).collect()}
    sets = {k: {x.split(":")[0] for x in got[k].fingerprint.split()} for k, _ in rows}
    for i, (k, t) in enumerate(rows):
        assert got[k].edited_fingerprint == plain[k]
        b, c = {x.split(":")[0] for x in plain[k].split()}, sets[rows[(i + 1) % len(rows)][0]]
        assert got[k].near_edited == pytest.approx(len(sets[k] & b) / len(sets[k] | b) if sets[k] | b else 1.0)
        assert got[k].near_next == pytest.approx(len(sets[k] & c) / len(sets[k] | c) if sets[k] | c else 1.0)


def test_compare_odd_tables(spark):
    ddl = "doc_id long, text string"
    assert winnowing.compare(spark.createDataFrame([], ddl)).collect() == []
    one = winnowing.compare(spark.createDataFrame([(1, "abcdefgh" * 9)], ddl)).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256((("abcdefgh" * 9)[:54] + ("abcdefgh" * 9)[:18]).encode()).hexdigest()
    odd = winnowing.compare(spark.createDataFrame([(None, "x"), (None, "y" * 8), (1, None), (1, None)], ddl)).collect()
    assert len(odd) == 4


def test_edited_fingerprint_beside_an_empty_document(spark):
    """What stays of a text whose next document is empty has the fingerprint of an equal text."""
    rng = random.Random(11)
    rows = []
    for i in range(0, 600, 3):
        text = "".join(rng.choice("abcdefgh ") for _ in range(80))
        rows += [(i, text), (i + 1, ""), (i + 2, text[:60])]
    got = {r.doc_id: r for r in winnowing.compare(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].edited_fingerprint == got[i + 2].fingerprint for i in range(0, 600, 3))


def test_counting_a_column_range_holds_few_bytes_per_entry():
    rng = np.random.default_rng(3)
    rows, each = 20_000, 50
    grams = rng.integers(0, 400_000, rows * each).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    sets = np.arange(rows, dtype=np.int64)
    block = {
        "range": [7], "rows": [sets.tobytes()], "sizes": [np.full(rows, each, np.uint32).tobytes()],
        "counts": [np.full(rows, each, np.uint32).tobytes()], "low": [grams.astype(np.uint32).tobytes()],
        "high": [(grams >> np.uint64(32)).astype(np.uint16).tobytes()],
    }
    table = pa.table(block, schema=ngram_join._BLOCK)
    tracemalloc.start()
    back = ngram_join._shared_columns(50)(table)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Ten of them are the result.
    assert most < 40 * len(grams)
    found = np.concatenate([np.frombuffer(x, np.int64) for x in back["grams"].to_pylist()])
    kinds, number = np.unique(grams & np.uint64(2**48 - 1), return_counts=True)
    expected = np.repeat(kinds[number > 1], number[number > 1]).astype(np.int64) | (7 << 48)
    assert np.array_equal(np.sort(found), np.sort(expected))
