"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels exist per document only, so tokens are labelled first: in toxic training documents, a token is toxic
if its word or one of its beginnings is found in toxic documents far more often than in others. The field
has two states; its features are the word, its beginnings of 4, 5 and 6 characters, and the transitions. It
is fitted by full gradients, which tasks compute on the sample and the driver adds (one vector per task).

Forward and backward passes run over all tokens of a batch at once: with two states, a message is one
number, and a pass is the fixed point of messages computed from their neighbours. It is reached exactly
after as many sweeps as a document is long, and to ``TOLERANCE`` after a few, since messages fade.

Marginals become a document score by a logistic model of their maximum, sum and number above one half; the
tokens above one half are the offending spans.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.session import materialize
from .common import crc_text, kept, pieces
from .labelled import SAMPLE_PER_CLASS, logistic, sample, sigmoid

TOLERANCE = 1e-10
#: A feature is used from so many sample documents on.
LEAST_DOCUMENTS = 5
#: A token's feature marks it toxic from these odds of toxic to other documents on, in so many toxic ones.
TOXIC_ODDS = 20.0
TOXIC_DOCUMENTS = 8
ROUNDS = 12
PIECE_BYTES = 2 << 20
_EDGE = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def features(word: bytes) -> list[bytes]:
    """A lower-case word without punctuation at its ends, and its beginnings."""
    text = word.strip(_EDGE).decode(errors="ignore")
    return [b"=" + text.encode(), *(b"%d" % k + text[:k].encode() for k in (4, 5, 6) if len(text) >= k)] if text else []


class Table:
    """Number of every word of a batch, with its features looked up once per worker."""

    def __init__(self, known: dict[bytes, int], limit: int = 300_000):
        self.known, self.limit = known, limit
        self.words: dict[bytes, int] = {}
        self.rows: list[list[int]] = []

    def numbers(self, words: list[bytes]) -> np.ndarray:
        new = set(words).difference(self.words)
        if len(self.words) + len(new) > self.limit:
            self.words, self.rows, new = {}, [], set(words)
        for w in new:
            self.words[w] = len(self.rows)
            self.rows.append([self.known[f] for f in features(w) if f in self.known])
        return np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))


class Energies:
    """The summed feature weights of words, looked up once per worker while they fit into its memory."""

    def __init__(self, known: dict[bytes, int], weights: np.ndarray, limit: int = 250_000):
        self.weight, self.limit = dict(zip(known, weights[list(known.values())].tolist())), limit
        self.words: dict[bytes, float] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        new = set(words).difference(self.words)
        if len(self.words) + len(new) > self.limit:
            self.words, new = {}, set(words)
        get = self.weight.get
        for w in new:
            self.words[w] = sum(get(f, 0.0) for f in features(w))
        return np.fromiter(map(self.words.__getitem__, words), float, len(words))


def messages(energy: np.ndarray, first: np.ndarray, last: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(forward odds, backward ratios) of all tokens; ``moves``: weights of 0-1, 1-0 and 1-1."""
    enter, leave, stay = np.exp(moves)
    e = np.exp(np.clip(energy, -30, 30))
    ahead = e * enter
    while len(e):
        before = np.concatenate([[0.0], ahead[:-1]])
        before[first] = 0.0
        new = e * (enter + before * stay) / (1 + before * leave)
        done = np.all(np.abs(new - ahead) <= TOLERANCE * (1 + ahead))
        ahead = new
        if done:
            break
    back = np.ones(len(e))
    while len(e):
        after = np.concatenate([(e * back)[1:], [0.0]])
        new = (leave + after * stay) / (1 + after * enter)
        new[last] = 1.0
        done = np.all(np.abs(new - back) <= TOLERANCE * (1 + back))
        back = new
        if done:
            break
    return ahead, back


def marginals(energy: np.ndarray, first: np.ndarray, last: np.ndarray, moves: np.ndarray) -> np.ndarray:
    ahead, back = messages(energy, first, last, moves)
    return 1 - 1 / (1 + ahead * back)


def _words(texts: list[str | None]) -> tuple[list[bytes], np.ndarray]:
    cut = [(t or "").encode().lower().split() for t in texts]
    return [w for ws in cut for w in ws], np.array([len(ws) for ws in cut], np.int64)


def _ends(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(lengths)
    held = lengths > 0
    return (ends - lengths)[held], ends[held] - 1


def document_features(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per document: largest marginal, log of their sum, log of the number above one half."""
    out = np.zeros((len(lengths), 3))
    held = lengths > 0
    if held.any():
        starts = (np.cumsum(lengths) - lengths)[held]
        out[held, 0] = np.maximum.reduceat(p, starts)
        out[held, 1] = np.log1p(np.add.reduceat(p, starts))
        out[held, 2] = np.log1p(np.add.reduceat((p > 0.5).astype(float), starts))
    return out


class Model:
    """Features and their weights, weights of the transitions, weights of the document score."""

    def __init__(self, known: dict[bytes, int], weights: np.ndarray, bias: float, moves: np.ndarray, document: np.ndarray):
        self.known, self.weights, self.bias, self.moves, self.document = known, weights, bias, moves, document


def _counts(rows: DataFrame, label: str) -> pd.DataFrame:
    """Per feature of the sample: toxic and other documents, and a bitmap of the contexts in toxic ones.

    Tasks add up before the shuffle. The bitmap tells a word that toxic documents share from one of a single
    text with many copies: neighbours differ from place to place, but not from copy to copy.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, list[int]] = {}
        cache: dict[bytes, list[bytes]] = {}
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = [b"", *(text or "").encode().lower().split(), b""]
                seen: dict[bytes, int] = {}
                for before, w, after in zip(words, words[1:], words[2:]):
                    if w not in cache:
                        cache[w] = features(w)
                    place = 1 << (zlib.crc32(before + b" " + after) % 63)
                    for f in cache[w]:
                        seen[f] = seen.get(f, 0) | place
                for f, places in seen.items():
                    held = found.setdefault(f, [0, 0, 0])
                    held[1 - y] += 1
                    held[2] |= places if y else 0
        if found:
            yield pa.RecordBatch.from_pydict({
                "f": list(found), **{c: [v[i] for v in found.values()] for i, c in enumerate("abm")},
            }, schema=pa.schema([("f", pa.binary()), *((c, pa.int64()) for c in "abm")]))

    rows = rows.select("text", label).mapInArrow(count, "f binary, a long, b long, m long")
    sums = rows.groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.bit_count(F.bit_or("m")).alias("places"))
    return sums.filter(F.col("a") + F.col("b") >= LEAST_DOCUMENTS).orderBy("f").toPandas()  # bounded by the sample


def _prepared(rows: DataFrame, label: str, shared) -> DataFrame:
    """The sample as arrays, a row per piece: what every round reads."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, toxic = shared.value
        for piece in pieces(batches, "text", PIECE_BYTES):
            table = Table(known, 1 << 60)
            words, lengths = _words(piece.column(0).to_pylist())
            y = np.array(piece.column(1).to_pylist(), np.int64)
            number = table.numbers(words)
            hit = np.array([bool(r) and bool(toxic[r].any()) for r in table.rows], bool)
            target = hit[number] & (np.repeat(y, lengths) == 1) if len(number) else np.zeros(0, bool)
            columns = np.array([c for r in table.rows for c in r], np.int64)
            yield pa.RecordBatch.from_pydict({
                "number": [number.tobytes()], "lengths": [lengths.tobytes()], "y": [y.tobytes()], "target": [target.tobytes()],
                "columns": [columns.tobytes()], "widths": [np.array([len(r) for r in table.rows], np.int64).tobytes()],
            }, schema=pa.schema([(c, pa.binary()) for c in ("number", "lengths", "y", "target", "columns", "widths")]))

    rows = rows.select("text", label).repartition(min(24, max(1, rows.count() // 100)))
    return materialize(rows.mapInArrow(work, "number binary, lengths binary, y binary, target binary, columns binary, widths binary"), "sample-arrays")


def _round(row: dict, now: np.ndarray, size: int, final: bool) -> np.ndarray:
    """The gradient over one piece, or in the end its document features and labels."""
    number, lengths, y, columns, widths = (np.frombuffer(row[c], np.int64) for c in ("number", "lengths", "y", "columns", "widths"))
    t = np.frombuffer(row["target"], bool).astype(float)
    owner = np.repeat(np.arange(len(widths)), widths)
    own = np.bincount(owner, now[columns], len(widths)) if len(columns) else np.zeros(len(widths))
    energy = own[number] + now[size]
    first, last = _ends(lengths)
    ahead, back = messages(energy, first, last, now[size + 1:])
    p = 1 - 1 / (1 + ahead * back)
    if final:
        return np.hstack([document_features(p, lengths), y[:, None]]).ravel()
    slope = np.zeros(len(now))
    if not len(p):
        return slope
    per_word = np.bincount(number, t - p, len(widths))
    slope[:size] = np.bincount(columns, per_word[owner], size)
    slope[size] = (t - p).sum()
    inner = np.ones(len(p), bool)
    inner[last] = False
    i = np.flatnonzero(inner)
    enter, leave, stay = np.exp(now[size + 1:])
    e = np.exp(np.clip(energy[i + 1], -30, 30)) * back[i + 1]
    pair = np.stack([e * enter, ahead[i] * leave, ahead[i] * e * stay])
    pair /= 1 + pair.sum(0)
    seen = np.stack([(1 - t[i]) * t[i + 1], t[i] * (1 - t[i + 1]), t[i] * t[i + 1]])
    slope[size + 1:] = (seen - pair).sum(1)
    slope[size + 1] += (t[first] - p[first]).sum()  # a document starts as if a clean token came before it
    return slope


def fit(documents: DataFrame, labels: DataFrame, label: str, allowed: Column, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """The field and the document score, from at most ``per_class`` labelled documents of each class.

    Without any labelled document, or with one class only, the score is that class's share (one half if
    there is none) for every document.
    """
    rows = sample(documents, labels, label, allowed, ["text"], per_class)
    classes = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    if len(classes) < 2:
        share = {(): 0.5, (0,): 0.0, (1,): 1.0}[tuple(classes)]
        return Model({}, np.zeros(0), -5.0, np.full(3, -5.0), np.array([0, 0, 0, 20 * (2 * share - 1)]))
    counts = _counts(rows, label)
    known = {bytes(f): i for i, f in enumerate(counts["f"])}
    least = min(TOXIC_DOCUMENTS, max(2, classes[1] // 20))
    a, b, places = (counts[c].to_numpy(float) for c in ("a", "b", "places"))
    toxic = (a >= least) & (places >= least - 1) & ((a + 0.5) / (classes[1] + 1) >= TOXIC_ODDS * (b + 0.5) / (classes[0] + 1))
    context, size = rows.sparkSession.sparkContext, len(known)
    arrays = _prepared(rows, label, context.broadcast((known, toxic)))

    def run(now: np.ndarray, final: bool) -> list[np.ndarray]:
        sent = context.broadcast(now)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = []
            for batch in batches:
                for row in batch.to_pylist():
                    out = _round(row, sent.value, size, final)
                    total = [*total, out] if final else [out + total[0]] if total else [out]
            if total:
                yield pa.RecordBatch.from_pydict({"v": [np.concatenate(total).tobytes()]}, schema=pa.schema([("v", pa.binary())]))

        return [np.frombuffer(r["v"]) for r in arrays.mapInArrow(work, "v binary").collect()]  # a vector per task

    weights = np.concatenate([np.zeros(size), [-3.0, -4.0, 0.0, 0.0]])
    squares = np.zeros(len(weights))
    total = sum(classes.values())
    for _ in range(ROUNDS):
        slope = sum(run(weights, False)) - 1e-3 * total * np.concatenate([weights[:size] * 1e-2, np.zeros(4)])
        squares += slope ** 2
        weights = weights + slope / np.sqrt(squares + 1e-9)
        weights[size + 1:] = np.clip(weights[size + 1:], -8, 4)
    scores = np.concatenate([v.reshape(-1, 4) for v in run(weights, True)])
    document = logistic(scores[:, :3], scores[:, 3], penalty=0.1)
    used = np.flatnonzero(np.abs(weights[:size]) > 1e-3)
    names = list(known)
    return Model({names[i]: j for j, i in enumerate(used)}, weights[used], float(weights[size]), weights[size + 1:], document)


def with_score(documents: DataFrame, model: Model, score: str = "score", spans: str = "spans") -> DataFrame:
    """``documents`` with the score and the offending spans of every row as further columns.

    Spans are (start, end, score) in characters. Whole texts are read, null ones as empty, which have no
    spans and the score of no evidence. All rows and columns stay; columns of the same names are replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast((model.known, model.weights, model.bias, model.moves, model.document))

    @F.pandas_udf("score double, spans array<struct<start: int, end: int, score: double>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = Model(*shared.value)
        energies = kept(f"toxicity {zlib.crc32(m.weights.tobytes())}", lambda: Energies(m.known, m.weights))
        for batch in batches:
            texts, out = batch.tolist(), []
            at = 0
            while at < len(texts):
                to, held = at, 0
                while to < len(texts) and (to == at or held + len(texts[to] or "") <= PIECE_BYTES):
                    held += len(texts[to] or "")
                    to += 1
                out.append(_scored(texts[at:to], m, energies))
                at = to
            yield pd.concat(out) if out else pd.DataFrame({"score": [], "spans": []})

    found = run(F.col("text").cast("string"))
    name = "_found" + "_" * max(map(len, documents.columns))
    rows = documents.withColumn(name, found)
    return rows.withColumns({score: F.col(f"{name}.score"), spans: F.col(f"{name}.spans")}).drop(name)


def _scored(texts: list[str | None], m: Model, energies: Energies) -> pd.DataFrame:
    words, lengths = _words(texts)
    first, last = _ends(lengths)
    p = marginals(energies.of(words) + m.bias, first, last, m.moves)
    x = document_features(p, lengths)
    ends = np.cumsum(lengths)
    spans: list[list[dict]] = [[] for _ in texts]
    for d in np.unique(np.searchsorted(ends, np.flatnonzero(p > 0.5), side="right")).tolist():
        own = p[ends[d] - lengths[d]:ends[d]]
        for k, found in enumerate(_TOKEN.finditer(texts[d])):
            if own[k] <= 0.5:
                continue
            if spans[d] and k and own[k - 1] > 0.5:
                spans[d][-1]["end"] = found.end()
                spans[d][-1]["score"] = max(spans[d][-1]["score"], float(own[k]))
            else:
                spans[d].append({"start": found.start(), "end": found.end(), "score": float(own[k])})
    return pd.DataFrame({"score": sigmoid(np.hstack([x, np.ones((len(x), 1))]) @ m.document), "spans": spans})


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows that never train: crc32 of doc_id as text leaves 0."""
    return crc_text(doc_id) % folds == 0


def detect(documents: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted and spans; labels of held-out rows are never read by the fit."""
    model = fit(documents, labels, label, ~held_out(F.col("doc_id")), per_class)
    return with_score(documents.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans",
    )
