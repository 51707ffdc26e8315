"""Quality classifier: naive Bayes support vectors.

Indicators of n-grams are scaled by the classes' log-count ratios, and a linear hinge loss is fitted to
them by dual coordinate descent. N-grams: three bytes as written, words, and one to three word shapes
(case, symbols, digits, length, whether the word before is the same). The margin becomes a probability by
a logistic curve fitted to margins that models without the row's fold give it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _linear, _text

#: Rows of each class that the model is fitted on, at most.
PER_CLASS = 3000
BITS = [15, 18, 14, 14, 14]
FOLDS = 4
_U = np.uint64
#: Kinds of bytes: 1 lower case, 2 upper case, 4 digit, 8 other ASCII sign, 16 beyond ASCII.
_KIND = np.full(256, 8, np.uint8)
_KIND[48:58], _KIND[65:91], _KIND[97:123], _KIND[128:] = 4, 2, 1, 16


def shapes(data: np.ndarray, w: _text.Words, h: np.ndarray) -> np.ndarray:
    """A number for each word's shape."""
    if not len(h):
        return np.zeros(0, _U)
    size = w.ends - w.starts
    kind = _KIND[data]
    seen = np.bitwise_or.reduceat(kind, w.starts).astype(_U)  # also over the space behind, whose kind is 8
    signs = np.concatenate([[0], np.cumsum(kind == 8)])
    signs = signs[w.ends] - signs[w.starts]
    first = kind[w.starts].astype(_U)
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    heads = w.ptr[:-1][w.ptr[:-1] < len(h)]
    same[heads] = False
    out = (seen & _U(23)) | first << _U(5) | same.astype(_U) << _U(10) | np.minimum(signs, 3).astype(_U) << _U(11) | np.minimum(size // 4, 7).astype(_U) << _U(13)
    return _text.mix(out + _U(1))


def features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    w = _text.words(data, offsets)
    h = _text.word_hashes(data, w)
    shape = shapes(data, w, h)
    of = _text.owners(w.ptr)

    def grams(of_words: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        g = _text.gram_hashes(of_words, n, seed=n)
        on = of[: len(g)] == of[n - 1 :] if len(g) else np.zeros(0, bool)
        return of[: len(g)][on], (g[on] >> _U(64 - bits)).astype(np.int64)

    return [_linear.byte_grams(data, offsets, 3, BITS[0]), grams(h, 1, BITS[1]), *(grams(shape, n, BITS[1 + n]) for n in (1, 2, 3))]


class Model:
    def __init__(self, rows: list[np.ndarray], labels: list[int], prior: float):
        """prior: the share of label 1 among all labelled rows, for a sample that has as many of each."""
        self.width = sum(1 << b for b in BITS)
        y = np.where(np.array(labels) == 1, 1, -1)
        fold = np.arange(len(y)) % FOLDS
        held = np.zeros(len(y))
        for k in range(FOLDS):
            rest = np.flatnonzero(fold != k)
            values, w = self.fit([rows[i] for i in rest], y[rest])
            own = [rows[i] for i in np.flatnonzero(fold == k)]
            held[fold == k] = _linear.margins(own, _linear.unit(own, values), w)
        up = max((y == 1).sum(), 1)
        weight = np.where(y == 1, prior / up, (1 - prior) / max(len(y) - up, 1)) * len(y)
        self.slope, self.offset = _linear.platt(held, y, weight)
        self.values, self.w = self.fit(rows, y)

    def fit(self, rows: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values = _linear.log_ratios(rows, y, self.width)
        return values, _linear.hinge(rows, _linear.unit(rows, values), self.width, y, np.ones(len(y)))

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        margin, _ = _linear.sparse_margins(features(data, offsets), BITS, len(offsets) - 1, self.values, self.w)
        return _linear.sigmoid(self.slope * (margin + self.w[-1]) + self.offset)


def train(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = PER_CLASS) -> Model | float:
    """A model from texts and labels.quality of the rows for which learn holds.

    A doc_id with several labels has the least. Without rows of both classes: the score of every text, a
    constant.
    """
    told = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min("quality").alias("label"))
    found, counts = _linear.labelled_sample(docs, told.where(learn).withColumn("code", F.col("label")), per_class)
    rows, y = _linear.matrix(found, features, BITS)
    good = counts.get(1, 0) / max(sum(counts.values()), 1)
    if len(set(y)) < 2:
        return good if counts else 0.5
    return Model(rows, y, good)


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """(doc_id, score) for every row of docs, repeated ones too, from text alone.

    A null text counts as empty, a null doc_id stays null; other columns than doc_id and text are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for b in batches:
            for c in _text.chunks(b.column(1)):
                n = len(c.offsets) - 1
                value = np.full(n, found) if isinstance(found, float) else found.score(c.data, c.offsets)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(c.rows.start, n), pa.array(value)], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, model: Model | float, least: float = 0.5) -> DataFrame:
    """The rows of docs that score `least` or more, with all their columns, whatever their names.

    Rows of equal text stay or go alike, those without a doc_id too; a null text counts as empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(c: _text.Chunk) -> np.ndarray:
        found = shared.value
        return np.full(len(c.offsets) - 1, found >= least) if isinstance(found, float) else found.score(c.data, c.offsets) >= least

    return _text.kept(docs, judge)
