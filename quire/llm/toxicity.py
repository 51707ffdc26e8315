"""Toxicity by classifier chains.

Categories are predicted one after the other: whether a text is labelled poor, then whether it is labelled
toxic, which is the answer. Each has a linear model (hinge loss, dual coordinate
descent) over word n-gram indicators scaled by the category's log-count ratios, and over the
probabilities of the categories before it. In training these are out-of-fold: each row's come from models
that haven't seen its fold, so later models meet probabilities as unsure as those of new texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _linear, _text

#: Rows of each class that the models are fitted on, at most.
PER_CLASS = 3000
BITS = [18, 18]
FOLDS = 5
#: Indicators with a smaller log-count ratio are left out; in a long text they'd outweigh the few that tell.
TELLING = 1.5
#: In the chain's order; the last one is the answer. Each is a label of its own.
CATEGORIES = ("poor", "toxic")
#: Letters and digits in lower case; any other ASCII byte parts words.
_WORDS = np.full(256, 32, np.uint8)
_WORDS[48:58], _WORDS[97:123], _WORDS[128:] = np.arange(48, 58), np.arange(97, 123), np.arange(128, 256)
_WORDS[65:91] = np.arange(97, 123)


def features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    data = _WORDS[data]
    return [_linear.word_grams(data, offsets, n + 1, b) for n, b in enumerate(BITS)]


def best_cut(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The probability, at most 0.5, from which on calling texts positive has the largest F1 measure."""
    order = np.argsort(-p, kind="stable")
    hit, called = np.cumsum((weight * (y == 1))[order]), np.cumsum(weight[order])
    f1 = 2 * hit / (called + (weight * (y == 1)).sum())
    return float(min(p[order][f1.argmax()], 0.5))


class Chain:
    def __init__(self, rows: list[np.ndarray], categories: dict[str, np.ndarray], prior: dict[str, float]):
        """prior: each category's share among all labelled rows. cut: from which probability of the last
        category on a text counts as of it, chosen on the out-of-fold predictions."""
        self.width = sum(1 << b for b in BITS)
        self.names = list(categories)
        self.links = []
        fold = np.arange(len(rows)) % FOLDS
        earlier = np.zeros((len(rows), 0))
        for name, y in categories.items():
            held = np.zeros(len(rows))
            for k in range(FOLDS):
                rest, own = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
                values, w = self.fit([rows[i] for i in rest], earlier[rest], y[rest])
                held[own] = self.margins([rows[i] for i in own], earlier[own], values, w)
            up = max((y == 1).sum(), 1)
            weight = np.where(y == 1, prior[name] / up, (1 - prior[name]) / max(len(y) - up, 1)) * len(y)
            slope, offset = _linear.platt(held, y, weight)
            self.links.append((*self.fit(rows, earlier, y), slope, offset))
            chance = _linear.sigmoid(slope * held + offset)
            self.cut = best_cut(chance, y, weight)
            earlier = np.column_stack([earlier, 2 * chance - 1])

    def _inputs(self, rows: list[np.ndarray], earlier: np.ndarray, values: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        more = np.arange(self.width, self.width + earlier.shape[1])
        x = _linear.unit(rows, values)
        return [np.append(r, more) for r in rows], [np.append(v, e) for v, e in zip(x, earlier, strict=True)]

    def fit(self, rows: list[np.ndarray], earlier: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values = _linear.log_ratios(rows, y, self.width)
        values[np.abs(values) < TELLING] = 0.0
        return values, _linear.hinge(*self._inputs(rows, earlier, values), self.width + earlier.shape[1], y, np.ones(len(y)))

    def margins(self, rows: list[np.ndarray], earlier: np.ndarray, values: np.ndarray, w: np.ndarray) -> np.ndarray:
        return _linear.margins(*self._inputs(rows, earlier, values), w)

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probabilities, a row for each category."""
        n, pairs, out = len(offsets) - 1, features(data, offsets), []
        for values, w, slope, offset in self.links:
            margin, _ = _linear.sparse_margins(pairs, BITS, n, values, w)
            margin += w[-1]
            for k, p in enumerate(out):
                margin += w[self.width + k] * (2 * p - 1)
            out.append(_linear.sigmoid(slope * margin + offset))
        return np.stack(out)


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, per_class: int = PER_CLASS) -> Chain | None:
    """A chain from texts and labels.quality (poor: 0) and labels.toxic of the rows for which learn holds.

    Of a doc_id's labels the worst count; a null quality counts as not poor, a null toxic as unlabelled.
    None without rows of both classes.
    """
    told = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id"))
    told = told.agg(F.max("toxic").alias("label"), F.min(F.coalesce("quality", F.lit(1))).alias("quality"))
    told = told if learn is None else told.where(learn)
    poor = (F.col("quality") == 0).cast("int")
    found, counts = _linear.labelled_sample(docs, told.withColumn("code", F.col("label") + 2 * poor), per_class)
    rows, code = _linear.matrix(found, features, BITS)
    code = np.array(code, np.int64)
    if len(set(code & 1)) < 2:
        return None
    share = told.where("label IN (0, 1)").agg(F.avg(poor)).first()[0]
    prior = {"poor": share, "toxic": counts.get(1, 0) / sum(counts.values())}
    return Chain(rows, {"poor": np.where(code & 2, 1, -1), "toxic": np.where(code & 1, 1, -1)}, prior)


def predict(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """(doc_id, p_poor, p_toxic, toxic) for every row of docs, repeated ones too, from text alone.

    toxic is 1 if p_toxic reaches the chain's cut, 0.5 at most. A null text counts as empty, a null doc_id
    stays null; columns other than doc_id and text are not read. Without a chain all are 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for b in batches:
            for c in _text.chunks(b.column(1)):
                n = len(c.offsets) - 1
                p = np.zeros((len(CATEGORIES), n)) if found is None else found.predict(c.data, c.offsets)
                toxic = pa.array((p[-1] >= (1.0 if found is None else found.cut)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(c.rows.start, n), *map(pa.array, p), toxic], ["doc_id", *(f"p_{x}" for x in CATEGORIES), "toxic"])

    schema = "doc_id long, " + ", ".join(f"p_{x} double" for x in CATEGORIES) + ", toxic int"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
