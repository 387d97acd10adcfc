"""Quality by co-training: a classifier of the text and one of the page metadata teach each other.

The two views share no feature: the text view sees how the words are written, the metadata view sees
language, source and lengths. Both start from a bounded sample of labelled documents. In each round each
view labels all unlabelled documents, and every one it is sure of teaches the other in that round; a class's
pseudo-labels weigh as much as its labels together, and none more than a label. After the last round both are
calibrated on labelled documents that neither was fitted on, and their log-odds are combined, weighted by
what calibration found.

The features of unlabelled documents are written once. Each step of a fit is a scan of them: a task adds up
gradients and curvatures, the driver solves systems of the size of a view.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.session import materialize
from .common import crc_text, pieces
from .labelled import SAMPLE_PER_CLASS, logistic, sample, sigmoid

ROUNDS = 4
#: A document teaches the other view if its class is at least so likely.
SURE = 0.9
#: Steps of a fit, at most, each a scan.
STEPS = 12
PIECE_BYTES = 2 << 20
HASHED = 32



def text_features(text: str | None) -> list[float]:
    """Shares of character kinds, of repeated words, lines and ends of words; all between 0 and about 1."""
    text = text or ""
    n = len(text)
    if not n:
        return [0.0] * 12 + [1.0]
    data = text.encode()
    size = len(data)
    letters = size - len(data.translate(None, _LETTERS))
    upper = size - len(data.translate(None, _UPPERS))
    digits = size - len(data.translate(None, b"0123456789"))
    blank = size - len(data.translate(None, b" \t\n\r\x0b\x0c"))
    marks = size - len(data.translate(None, b"!?|#*$%&@<>{}[]=~^_+/\\"))
    stops = size - len(data.translate(None, b".,;:"))
    words = data.split()
    m = max(len(words), 1)
    distinct = set(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    return [
        letters / size, upper / max(letters, 1), digits / size, blank / size, min(1.0, 5 * marks / size), min(1.0, 5 * stops / size),
        1 - len(distinct) / m, 1 - len(set(lines)) / max(len(lines), 1), min(1.0, sum(map(len, words)) / m / 20),
        min(1.0, sum(w[-1:] in b"!?|#*$%&" for w in words) / m), min(1.0, len(lines) / m * 5), min(1.0, max(map(len, words), default=0) / 60), 0.0,
    ]


def metadata_features(lang: str | None, source: str | None, n_chars: int | None, url: str | None = None) -> list[float]:
    """Lengths and hashed names of language, source and (where pages have one) the address."""
    size = math.log1p(max(n_chars or 0, 0))
    out = [size / 12, (size / 12) ** 2, float(n_chars is None), float((n_chars or 0) < 200), float((n_chars or 0) > 20_000)]
    names = [0.0] * HASHED
    for kind, value in (("l", lang), ("s", source), ("u", url)):
        if kind != "u" or value is not None:
            names[zlib.crc32(f"{kind}{value}".encode()) % HASHED] += 1.0
    return out + names


_UPPERS = bytes(range(65, 91))
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])


class Model:
    """Means and spreads, weights and calibration of both views, and the share of good documents."""

    def __init__(self, views: list[tuple[np.ndarray, np.ndarray, np.ndarray]], final: np.ndarray):
        self.views, self.final = views, final

    def view_odds(self, view: int, x: np.ndarray) -> np.ndarray:
        mean, spread, w = self.views[view]
        return np.clip(np.hstack([(x - mean) / spread, np.ones((len(x), 1))]) @ w, -30, 30)

    def score(self, text: np.ndarray, page: np.ndarray) -> np.ndarray:
        odds = np.stack([self.view_odds(0, text), self.view_odds(1, page)], axis=1)
        return sigmoid(np.hstack([odds, np.ones((len(odds), 1))]) @ self.final)


def _columns(documents: DataFrame) -> DataFrame:
    """The columns that features read; missing ones are null."""
    have = set(documents.columns)
    kinds = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}
    return documents.select(*(F.col(f"`{c}`").cast(k).alias(c) if c in have else F.lit(None).cast(k).alias(c) for c, k in kinds.items()))


def _arrays(columns: list) -> tuple[np.ndarray, np.ndarray]:
    text, lang, source, n_chars = columns
    return (np.array([text_features(t) for t in text]).reshape(-1, 13),
            np.array([metadata_features(*x) for x in zip(lang, source, n_chars)]).reshape(-1, 5 + HASHED))


def _features(rows: DataFrame, label: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of a bounded table, computed in tasks; labels, or -1."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", PIECE_BYTES):
            a, b = _arrays([c.to_pylist() for c in piece.columns[:4]])
            yield pa.RecordBatch.from_pydict({"x": np.hstack([a, b]).tolist(), "y": piece.column(4)},
                                             schema=pa.schema([("x", pa.list_(pa.float64())), ("y", pa.int32())]))

    y = F.col(label).cast("int") if label else F.lit(-1)
    found = rows.select("text", "lang", "source", "n_chars", y.alias("_y")).mapInArrow(work, "x array<double>, y int").toPandas()
    x = np.array(found["x"].tolist(), float).reshape(-1, 18 + HASHED)
    order = np.lexsort(x.T)  # whatever order the tasks came in
    return x[order, :13], x[order, 13:], found["y"].to_numpy()[order]


WIDTHS = (13, 5 + HASHED)


def _unlabelled(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Packed features (floats of 32 bits) of every row whose doc_id has no label, null doc_ids included."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", PIECE_BYTES):
            x = np.hstack(_arrays([c.to_pylist() for c in piece.columns[1:]])).astype(np.float32)
            yield pa.RecordBatch.from_pydict({"doc_id": piece.column(0), "x": pa.array([r.tobytes() for r in x], pa.binary())})

    rows = documents.select("doc_id", "text", "lang", "source", "n_chars").mapInArrow(work, "doc_id long, x binary")
    return materialize(rows.join(labels.select("doc_id").distinct(), "doc_id", "left_anti").select("x"), "unlabelled")


def _added(rows: DataFrame, size: int, add: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``add`` of all rows' features, in batches; a task returns one vector."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += add(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.float32).reshape(-1, sum(WIDTHS)).astype(float))
        yield pa.RecordBatch.from_pydict({"v": [total.tobytes()]})

    total = np.zeros(size)
    for r in rows.mapInArrow(work, "v binary").collect():
        total += np.frombuffer(r["v"])
    return total


def _views(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x[:, :WIDTHS[0]], x[:, WIDTHS[0]:]


def _slopes(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Rows, gradient and curvature of each class, flat; ``x`` ends with ones."""
    out = []
    for c in (0, 1):
        own = x[y == c]
        p = sigmoid(own @ w)
        out += [[float(len(own))], own.T @ (p - c), ((own * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ own).ravel()]
    return np.concatenate(out)


def _taught(rows: DataFrame, model: Model, labelled: list[np.ndarray], y: np.ndarray) -> Model:
    """Both views fitted again: on the labels, and on what the other view of ``model`` is sure of."""
    sizes = [k + 1 for k in WIDTHS]
    lengths = [2 * (1 + k + k * k) for k in sizes]
    weights = [view[2].copy() for view in model.views]
    scaled = [np.hstack([(x - v[0]) / v[1], np.ones((len(x), 1))]) for x, v in zip(labelled, model.views)]
    for _ in range(STEPS):
        now = [w.copy() for w in weights]

        def add(x: np.ndarray) -> np.ndarray:
            parts = _views(x)
            out = []
            for view in (0, 1):
                p = sigmoid(model.view_odds(1 - view, parts[1 - view]))
                sure = np.where(p >= SURE, 1, np.where(1 - p >= SURE, 0, -1))
                mean, spread, _ = model.views[view]
                own = parts[view][sure >= 0]
                out.append(_slopes(np.hstack([(own - mean) / spread, np.ones((len(own), 1))]), sure[sure >= 0], now[view]))
            return np.concatenate(out)

        sums = np.split(_added(rows, sum(lengths), add), [lengths[0]])
        largest = 0.0
        for view, k in enumerate(sizes):
            ridge = np.full(k, 2.0)
            ridge[-1] = 1e-6
            gradient, curvature = ridge * weights[view], np.diag(ridge)
            told = _slopes(scaled[view], y, weights[view]).reshape(2, -1)
            for c, pseudo in enumerate(sums[view].reshape(2, -1)):
                half = 0.5 * len(y)
                label = half / max(told[c, 0], 1.0)
                total = label * told[c] + min(label, half / max(pseudo[0], 1.0)) * pseudo
                gradient = gradient + total[1:1 + k]
                curvature = curvature + total[1 + k:].reshape(k, k)
            move = np.linalg.solve(curvature, gradient)
            weights[view] = weights[view] - move * min(1.0, 5 / max(np.abs(move).max(), 1e-12))
            largest = max(largest, np.abs(move).max())
        if largest < 1e-6:
            break
    return Model([(m, d, w) for (m, d, _), w in zip(model.views, weights)], model.final)


def _balance(y: np.ndarray) -> np.ndarray:
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    return np.where(y == 1, 0.5 / share, 0.5 / (1 - share))


def fit(documents: DataFrame, labels: DataFrame, label: str, allowed: Column, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Both views after co-training, calibrated on a fifth of the sample.

    With no labels or one class only, every score is that class's share (one half without labels).
    """
    documents = _columns(documents)
    names = ["text", "lang", "source", "n_chars"]
    text, page, y = _features(sample(documents, labels, label, allowed, names, per_class), label)
    if len(set(y.tolist())) < 2:
        share = 0.5 if not len(y) else float(y[0])
        blank = [(np.zeros(k), np.ones(k), np.zeros(k + 1)) for k in (13, 5 + HASHED)]
        return Model(blank, np.array([0, 0, 20 * (2 * share - 1)]))
    apart = np.arange(len(y)) % 5 == 0
    if len(set(y[apart].tolist())) < 2 or len(set(y[~apart].tolist())) < 2:
        apart = np.zeros(len(y), bool)
    learn = ~apart
    rows = _unlabelled(documents, labels)
    # Means and spreads of labelled and unlabelled documents together, for all rounds.
    seen = np.hstack([text[learn], page[learn]])
    sums = _added(rows, 1 + 2 * seen.shape[1], lambda x: np.concatenate([[float(len(x))], x.sum(0), (x * x).sum(0)]))
    n = sums[0] + len(seen)
    one, two = np.split(sums[1:], 2)
    mean = (one + seen.sum(0)) / n
    spread = np.maximum(np.sqrt(np.maximum((two + (seen * seen).sum(0)) / n - mean * mean, 0)), 1e-3)
    views, own = [], y[learn]
    for x, m, d in zip((text[learn], page[learn]), _views(mean[None]), _views(spread[None])):
        views.append((m[0], d[0], logistic((x - m[0]) / d[0], own.astype(float), penalty=2.0, weight=_balance(own))))
    model = Model(views, np.zeros(3))
    for _ in range(ROUNDS if sums[0] else 0):
        model = _taught(rows, model, [text[learn], page[learn]], own)
    test = apart if apart.any() else learn
    odds = np.stack([model.view_odds(0, text[test]), model.view_odds(1, page[test])], axis=1)
    return Model(model.views, logistic(odds, y[test].astype(float), penalty=0.1, weight=_balance(y[test])))


def with_score(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``documents`` with the score (0 to 1, higher: better) of every row as a further column.

    Whole texts are read, a null text counts as empty, missing metadata columns as null. All rows and
    columns stay; a column of the same name is replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast((model.views, model.final))

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        m = Model(*shared.value)
        for columns in batches:
            known = [c.astype(object).where(c.notna(), None).tolist() for c in columns]
            yield pd.Series(m.score(*_arrays(known)), dtype=float)

    have = set(documents.columns)
    read = [
        F.col(f"`{c}`").cast(k) if c in have else F.lit(None).cast(k)
        for c, k in (("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "double"))
    ]
    return documents.withColumn(name, run(*read))


def classify(documents: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted; labels of held-out rows (crc32 of doc_id mod 5 is 0) are never read."""
    held_out = crc_text(F.col("doc_id")) % 5 == 0
    model = fit(documents, labels, label, ~held_out, per_class)
    return with_score(documents, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
