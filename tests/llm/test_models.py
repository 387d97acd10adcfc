"""Classifiers, language model, search and mixing: brute force, closed forms and held-out accuracy."""

import collections
import itertools
import math
import random
import tracemalloc
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rowloom.llm import context_tree, cotraining, mixing, one_bit_codes, toxicity
from rowloom.llm.common import crc_text


# --- toxicity ---------------------------------------------------------------


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    energy, moves = rng.normal(0, 2, 7), rng.normal(0, 1.5, 3)
    weight = np.zeros(7)
    total = 0.0
    for y in itertools.product((0, 1), repeat=7):
        s = sum(e for e, v in zip(energy, y) if v)
        for a, b in zip((0, *y), y):
            s += {(0, 1): moves[0], (1, 0): moves[1], (1, 1): moves[2]}.get((a, b), 0.0)
        total += math.exp(s)
        weight += math.exp(s) * np.array(y)
    p = toxicity.marginals(np.concatenate([energy, energy]), np.array([0, 7]), np.array([6, 13]), moves)
    assert np.allclose(p[:7], weight / total, atol=1e-9) and np.allclose(p[7:], p[:7])


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    documents, labels = [], []
    for i in range(400):
        text = [rng.choice(words) for _ in range(rng.randint(20, 60))]
        bad, poor = i % 4 == 0, i % 5 == 0
        if bad:
            for _ in range(3):
                text[rng.randrange(len(text))] = "zork" + rng.choice("abcdef")
        if poor:
            text = [w.upper() + "!!" for w in text]
        documents.append((i, " ".join(text), "en", f"s{i % 3}", len(" ".join(text)), 0.0))
        labels.append((i, int(not poor), int(bad)))
    return documents, labels


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score double"
LABELS = "doc_id long, quality int, toxic int"
ODD = [(9000, None, None, None, None, None), (9001, "", "en", None, 0, 1.0), (None, "zorka zorkb", "xx", "s", 3, 2.0), (9000, "y " * 5000, None, "s1", 1, 0.0)]


def test_toxicity(spark, labelled):
    documents, labels = labelled
    labels = [*labels, (9000, None, None), (None, 1, 1), (9002, 1, 7)]
    df = spark.createDataFrame([*documents, *ODD], DOCUMENTS).repartition(3)
    got = toxicity.detect(df, spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(documents) + len(ODD)
    truth, text = {k: t for k, _, t in labels}, {d[0]: d[1] for d in documents}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0)
        if r.doc_id in text:
            assert r.predicted == truth[r.doc_id]
            if truth[r.doc_id]:
                assert all("zork" in text[r.doc_id][s.start:s.end].lower() for s in r.spans) and r.spans
    assert sum(r.predicted for r in got if r.doc_id is None) == 1


def test_toxicity_ignores_held_out_labels(spark, labelled):
    documents, labels = labelled
    df = spark.createDataFrame(documents[:80], DOCUMENTS)
    flipped = [(k, q, 1 - t if zlib.crc32(str(k).encode()) % 5 == 0 else t) for k, q, t in labels]
    a, b = ({r.doc_id: r.score for r in toxicity.detect(df, spark.createDataFrame(x, LABELS)).collect()} for x in (labels, flipped))
    assert a == pytest.approx(b, abs=1e-9)


def test_classifiers_without_labels(spark, labelled):
    df = spark.createDataFrame(labelled[0][:10], DOCUMENTS)
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in toxicity.detect(df, none).collect()} == {0.5}
    assert {r.score for r in cotraining.classify(df, none).collect()} == {0.5}
    one = spark.createDataFrame([(k, 1, 0) for k in range(10)], LABELS)
    assert all(r.predicted == 0 for r in toxicity.detect(df, one).collect())
    assert all(r.predicted == 1 for r in cotraining.classify(df, one).collect())
    assert toxicity.detect(df.limit(0), one).collect() == [] and cotraining.classify(df.limit(0), one).collect() == []


# --- quality ----------------------------------------------------------------


def test_quality(spark, labelled):
    documents, labels = labelled
    some = [x for x in labels if x[0] % 3]
    df = spark.createDataFrame([*documents, *ODD], DOCUMENTS).repartition(3)
    got = cotraining.classify(df, spark.createDataFrame(some, LABELS)).collect()
    truth = {k: q for k, q, _ in labels}
    assert len(got) == len(documents) + len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert np.mean([r.predicted == truth[r.doc_id] for r in got if r.doc_id in truth]) > 0.97
    kept = cotraining.with_score(df, cotraining.fit(df, spark.createDataFrame(some, LABELS), "quality", F.lit(True)))
    assert set(kept.columns) == set(df.columns) and kept.count() == df.count()


def test_cotraining_learns_from_all_unlabelled_rows(spark, labelled):
    """Every unlabelled row is written for the rounds, repeated and null ids too, and more of them change the model."""
    documents, labels = labelled
    known = spark.createDataFrame(labels[:200], LABELS)
    many = [(10_000 + i, *documents[i % 400][1:]) for i in range(5_000)]
    few, all_ = (spark.createDataFrame([*documents[:200], *more, *ODD], DOCUMENTS).repartition(3) for more in (many[:4_000], many))
    rows = cotraining._unlabelled(cotraining._columns(all_), known)
    assert rows.count() == 5_000 + len(ODD)
    one = cotraining._added(rows, 1, lambda x: np.array([float(len(x))]))
    assert one[0] == 5_000 + len(ODD)
    a, b = (cotraining.fit(df, known, "quality", F.lit(True)) for df in (few, all_))
    assert any(not np.allclose(v[2], w[2], atol=1e-6) for v, w in zip(a.views, b.views))


# --- language model ---------------------------------------------------------


def kt(a: int, b: int) -> float:
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


@pytest.mark.parametrize("least", [1, 2, 3])
def test_tree_equals_recursion(spark, least):
    """Weights and mixtures by the definition, over dictionaries of counts."""
    texts, depth = [b"abracadabra", b"abcabcabc", b"", "né".encode()] * 3, 2
    counts = collections.Counter()
    for t in texts:
        flat = bytes([255]) * depth + t + bytes([255])
        for i in range(depth, len(flat)):
            for d in range(depth + 1):
                counts[flat[i - d:i][::-1], flat[i]] += 1
    contexts = {c for c, _ in counts}
    total = collections.Counter()
    for (c, _), n in counts.items():
        total[c] += n

    def split(c, prefix, k):
        z = sum(n for (d, x), n in counts.items() if d == c and x >> (8 - k) == prefix and not x >> (7 - k) & 1)
        o = sum(n for (d, x), n in counts.items() if d == c and x >> (8 - k) == prefix and x >> (7 - k) & 1)
        return z, o

    kept = {c for c in contexts if total[c] >= least}

    def weighted(c, prefix, k):
        own = kt(*split(c, prefix, k))
        children = [d for d in kept if len(d) == len(c) + 1 and d[:len(c)] == c] if len(c) < depth else []
        if not children:
            return own, None, None
        z, o = split(c, prefix, k)
        below = 0.0
        for d in children:
            a, b = split(d, prefix, k)
            z, o = z - a, o - b
            below += weighted(d, prefix, k)[0]
        below += kt(z, o)
        both = math.log(0.5) + np.logaddexp(own, below)
        return both, math.exp(math.log(0.5) + own - both), (o + 0.5) / (z + o + 1)

    def chance(context, x):
        p_all = 1.0
        for k in range(8):
            prefix, bit = x >> (8 - k), x >> (7 - k) & 1
            p = None
            for d in range(depth, -1, -1):
                c = context[:d]
                if c not in kept and c:
                    continue
                z, o = split(c, prefix, k)
                _, w, rest = weighted(c, prefix, k)
                own = (o + 0.5) / (z + o + 1)
                p = own if w is None else w * own + (1 - w) * (rest if p is None else p)
            p_all *= p if bit else 1 - p
        return p_all

    df = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id long, text string")
    tree = context_tree.fit(df, F.lit(True), depth, 0.0, least)
    for text in (b"abra", b"zz"):
        flat = bytes([255]) * depth + text + bytes([255])
        want = sum(math.log10(chance(flat[i - depth:i][::-1], flat[i])) for i in range(depth, len(flat)))
        assert context_tree.log10_probabilities(tree, [text])[0] == pytest.approx(want, rel=1e-5)


def test_language_model(spark):
    rows = [(i, t) for i, t in enumerate(brute.texts(60))] + [(None, "null id"), (4, "again")] + [(5, brute.texts(60)[5])]
    train = lambda k: zlib.crc32(str("" if k is None else k).encode()) % 7 != 2
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, score long").repartition(3)
    got = context_tree.score(df, crc_text(F.col("doc_id")) % 7 != 2).collect()
    tokens = lambda t: [*brute.words(t), None]
    c = collections.Counter(w for k, t in rows if train(k) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = [
        (k, not train(k), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t)), 6))
        for k, t in rows
    ]
    assert brute.ordered((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == brute.ordered(want)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    none = context_tree.score(df, F.lit(False)).filter("doc_id = 4 AND n_tokens = 2").first()
    assert none.train_tokens == 0 and none.score == pytest.approx(6 * math.log10(1 / 256), rel=1e-5)
    assert context_tree.score(df.limit(0), F.lit(True)).collect() == []


@pytest.mark.parametrize("least", [1, 2])
@pytest.mark.parametrize("buckets", [3, 40, None])
def test_spread_tree_equals_one_tree(spark, buckets, least, monkeypatch):
    """Nodes weighed range by range give what one process gives, frequent pairs split or not."""
    texts = [t or "" for t in brute.texts(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    training = F.col("doc_id") % 7 != 2
    monkeypatch.setattr(context_tree, "RANGE_BYTES", 5_000)
    got = {r["_id"]: r.score for r in context_tree.tree_scores(df, training, 5, buckets, least).collect()}
    if buckets == 40:
        assert len(context_tree._hot_pairs(df, training, buckets))
    want = context_tree.log10_probabilities(context_tree.fit(df, training, least=least), [t.encode() for t in texts])
    assert [got[i] for i in range(len(texts))] == pytest.approx(want.tolist(), rel=1e-4)


def test_rare_context_is_modelled_in_a_large_corpus(spark):
    """Two occurrences make a node, whatever share of the corpus they are."""
    rows = [(i, "the same common words again and again " * 400) for i in range(40)] + [(100 + i, "zqxjkvwp") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    rare = context_tree.score(df, F.col("doc_id") != 102).filter("doc_id = 102").first()
    assert rare.bits_per_byte < 4


def test_ranges_are_as_many_as_nearest_pairs_allow():
    """Contexts are dealt by their two nearest bytes, three where a pair is frequent, not by the nearest alone."""
    rng = np.random.default_rng(3)
    context = rng.integers(97, 105, (20_000, 5)) @ (1 << 8 * np.arange(5, dtype=np.int64))
    hot = np.unique(context >> 24)[:1]
    found = context_tree._bucket(context, 5, hot, 1_000)
    pair, near = context >> 24, context >> 16
    assert len(set(found)) > 55  # 64 pairs
    for p in set(pair):
        assert len(set(found[pair == p])) == (1 if p != hot[0] else len(set(near[pair == p])))


def test_a_range_holds_its_distinct_numbers_only(monkeypatch):
    """200 blocks that ask for the same grams take the room of one, whatever their number."""
    monkeypatch.setattr(context_tree, "MERGED", 1 << 15)
    gram = np.arange(0, 200_000, 10, dtype=np.int64)
    row = {"bucket": 3, "gram": context_tree._packed(np.diff(gram, prepend=0)), "count": context_tree._packed(np.full(len(gram), 2, np.uint32))}
    batches = (pa.RecordBatch.from_pylist([row, row], pa.schema([("bucket", pa.int32()), ("gram", pa.binary()), ("count", pa.binary())])) for _ in range(100))
    tracemalloc.start()
    try:
        (bucket, held), = context_tree._counted(batches, np.int64, "gram", "count", context_tree._grams)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert bucket == 3 and held.kinds.tolist() == gram.tolist() and set(held.counts) == {400}
    assert peak < 200 * gram.nbytes / 4


def test_many_ranges_of_words_give_the_same_sums(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(brute.texts(60))] + [(None, "a b a"), (5, ""), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = []
    for size in (context_tree.WORD_BYTES, 300):
        monkeypatch.setattr(context_tree, "WORD_BYTES", size)
        got = context_tree.unigram(df, crc_text(F.col("doc_id")) % 7 != 2).collect()
        found.append(brute.ordered((*r[:-1], round(r.base_score, 6)) for r in got))
    assert found[0] == found[1] and len(found[0]) == len(rows)


def test_word_blocks_are_named_alike_by_a_repeated_attempt(spark):
    rows = [(i, t) for i, t in enumerate(brute.texts(30))] + [(None, "x"), (3, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "text")
    first, again = (
        sorted(r.block for r in context_tree._word_blocks(df, F.lit(True), 4).filter("info IS NOT NULL").collect()) for _ in range(2)
    )
    assert first == again and len(set(first)) == len(first)


# --- nearest neighbours -----------------------------------------------------


def test_nearest(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 32))
    data = [(i, (centres[i % 6] + rng.normal(size=32) * 0.3).astype(np.float32).tolist()) for i in range(600)]
    data += [(700 + i, data[7][1]) for i in range(30)]
    odd = [(800, None), (801, []), (802, [0.0] * 32), (803, [float("nan")] * 32), (804, [1.0, None] + [0.0] * 30), (805, [1.0] * 31), (None, data[1][1]), (900, [float("inf")] * 32)]
    df = spark.createDataFrame([(*r, 1.0) for r in [*data, *odd]], "vec_id long, embedding array<float>, score double").repartition(5)
    got = collections.defaultdict(list)
    for r in one_bit_codes.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    ids, matrix = np.array([k for k, _ in data]), np.array([x for _, x in data], np.float32).astype(float)
    assert set(got) == {k for k in ids.tolist() if k % 50 == 0}
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((matrix - matrix[ids == q][0]) ** 2).sum(1))
        other = ids != q
        best = np.lexsort((ids[other], d[other]))[:10]
        assert [x[0] for x in found] == list(range(1, 11))
        hits += len({x[1] for x in found} & set(ids[other][best].tolist()))
        assert all(s == pytest.approx(d[ids == v][0]) for _, v, s in found)
    assert hits >= 0.99 * 10 * len(got)


def test_nearest_in_blocks_of_queries(spark, monkeypatch):
    """Blocks of queries and double components change nothing but the scores' last digits."""
    rng = np.random.default_rng(4)
    data = [(i, rng.normal(size=16).tolist()) for i in range(200)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3)
    whole = one_bit_codes.nearest(df, F.col("vec_id") % 4 == 0, 5).collect()
    monkeypatch.setattr(one_bit_codes, "QUERY_BYTES", 600)
    assert brute.ordered(one_bit_codes.nearest(df, F.col("vec_id") % 4 == 0, 5).collect()) == brute.ordered(whole)
    matrix = np.array([x for _, x in data])
    for r in whole:  # exact on the doubles as they are
        assert r.score == pytest.approx(np.sqrt(((matrix[r.query_id] - matrix[r.vec_id]) ** 2).sum()), rel=1e-14)
    near = [(0, [1.0, 2.0]), (1, [1.0, 2.0 + 2e-9]), (2, [1.0, 2.0 + 1e-9])]
    got = one_bit_codes.nearest(spark.createDataFrame(near, "vec_id long, embedding array<double>"), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [2, 1]


def test_nearest_of_few(spark):
    ddl = "vec_id long, embedding array<float>"
    assert one_bit_codes.nearest(spark.createDataFrame([], ddl), F.lit(True)).collect() == []
    few = spark.createDataFrame([(0, [1.0, 2.0]), (5, [1.0, 2.0]), (2, [1.0, 2.0]), (0, [1.0, 3.0])], ddl)
    got = one_bit_codes.nearest(few, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 2, 0.0), (0, 2, 5, 0.0)]


# --- mixing -----------------------------------------------------------------


def test_fill_respects_limits():
    assert mixing.fill([10, 10, 10], [5, 2, 1], 30) == pytest.approx([18.75, 7.5, 3.75])
    got = mixing.fill([1, 100, 100], [5, 2, 1], 201)
    assert got[0] == 3 and sum(got) == pytest.approx(201) and got[1] == pytest.approx(2 * got[2])
    assert mixing.fill([0, 0], [5, 2], 0) == [0, 0] and mixing.fill([], [], 0) == []


def test_flight_keeps_totals():
    rng = np.random.default_rng(5)
    p, size = np.full(400, 0.37), rng.integers(1, 900, 400).astype(float)
    out = mixing.flight(p, size, rng.random(500))
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert out.sum() == pytest.approx(p.sum(), abs=1e-6) and out @ size == pytest.approx(p @ size, rel=1e-9)
    landed = mixing.land(out, size)
    assert set(np.unique(landed)) <= {0.0, 1.0} and abs(landed @ size - p @ size) <= size.max()


def test_flight_is_unbiased():
    p, size = np.array([0.2, 0.5, 0.3, 0.6, 0.4]), np.array([3.0, 1.0, 4.0, 1.0, 5.0])
    rng = np.random.default_rng(0)
    mean = np.mean([mixing.flight(p, size, rng.random(6)) for _ in range(4000)], axis=0)
    assert np.allclose(mean, p, atol=0.03)


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 16)
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["b", "a", "Z", None, "b", "b"]), i) for i in range(500)]
    rows += [rows[4], (None, "a b c", "a", 0), (700, None, "a", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long")
    got = mixing.mix(df.repartition(3)).collect()
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for _, t, s, _ in rows:
        sizes[s] += len(brute.words(t))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = dict(zip(names, mixing.fill([sizes[s] for s in names], [5, 2, 1, 5], sum(sizes.values()))))
    assert {(r.source_size, round(r.target, 6)) for r in got} == {(sizes[s], round(target[s], 6)) for s in names}
    taken = collections.Counter()
    for r in got:
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 3
        taken[r.source_size, r.target] += r.taken
    assert all(abs(t - n) <= 60 for (_, t), n in taken.items())
    again = mixing.mix(df.repartition(7)).collect()
    assert brute.ordered(got) == brute.ordered(again)
    assert mixing.mix(df.limit(0)).collect() == []
