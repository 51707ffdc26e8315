"""Hashed n-gram indicators of texts, and linear models fitted on a bounded sample of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _text

_U = np.uint64
Features = Callable[[np.ndarray, np.ndarray], list[tuple[np.ndarray, np.ndarray]]]


def byte_grams(data: np.ndarray, offsets: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of each n-byte gram within one document, in 2 ** bits buckets."""
    of = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    m = len(data) - n + 1
    if m <= 0:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    h = np.zeros(m, _U)
    for k in range(n):
        h = h * _U(257) + data[k : k + m]
    h = (h + _U(n)) * _U(0x9E3779B97F4A7C15)
    on = of[:m] == of[n - 1 :]
    return of[:m][on], (h >> _U(64 - bits))[on].astype(np.int64)


def word_grams(data: np.ndarray, offsets: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of each n-word gram within one document."""
    w = _text.words(data, offsets)
    h = _text.gram_hashes(_text.word_hashes(data, w), n, seed=n)
    of = _text.owners(w.ptr)
    on = of[: len(h)] == of[n - 1 :] if len(h) else np.zeros(0, bool)
    return of[: len(h)][on].astype(np.int32), (h[on] >> _U(64 - bits)).astype(np.int64)


def present(pairs: tuple[np.ndarray, np.ndarray], rows: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The different (document, bucket), sorted; a document's table is 2 ** bits flags."""
    step = max(1, (1 << 24) >> bits)
    of, bucket = [], []
    for lo in range(0, rows, step):
        a, b = np.searchsorted(pairs[0], [lo, lo + step])
        flags = np.zeros(min(step, rows - lo) << bits, bool)
        flags[(pairs[0][a:b].astype(np.int64) - lo) << bits | pairs[1][a:b]] = True
        on = np.flatnonzero(flags)
        of.append((on >> bits) + lo)
        bucket.append(on & ((1 << bits) - 1))
    return np.concatenate(of), np.concatenate(bucket)


#: Hashes are compared with shares of this range.
_RANGE = 1 << 40


def _chosen(key: Column, label: Column, counts: dict, per_class: int) -> Column:
    """Whether key, a hash, is under the threshold that about per_class of its label's rows are under."""
    under = F.lit(False)
    for value, n in counts.items():
        under = F.when(label == F.lit(value), F.pmod(key, F.lit(_RANGE)) < F.lit(min(_RANGE, _RANGE * per_class // n))).otherwise(under)
    return under


def sample(docs: DataFrame, label: Column, per_class: int) -> DataFrame:
    """(text, label): about per_class rows of each label, those whose hash of doc_id and text is under a
    threshold that follows from the label's count; all rows of a label that has no more.

    Nothing is ranked, and no text but the chosen ones is shuffled; the labels' counts, a row for each
    label, go to the driver. Rows without a label or a text are left out; repeated rows count once.
    """
    told = docs.where("text IS NOT NULL").withColumn("_label", label).where("_label IS NOT NULL")
    counts = dict(map(tuple, told.groupBy("_label").count().collect()))
    rows = told.select("text", F.col("_label").alias("label"), F.xxhash64("doc_id", "text").alias("h"))
    return rows.where(_chosen(F.col("h"), F.col("label"), counts, per_class)).dropDuplicates(["h"]).select("text", "label")


def labelled_sample(docs: DataFrame, told: DataFrame, per_class: int) -> tuple[DataFrame, dict]:
    """(text, code) of about per_class ids of each label in told (id, label, code; an id once), chosen as in
    sample(); and how many ids each label has.

    Only the chosen ids, about 2 * per_class, meet the texts, so no text is shuffled but theirs. Of several
    rows with an id, that with the least text hash counts.
    """
    rows = told.where("label IN (0, 1)")
    counts = dict(map(tuple, rows.groupBy("label").count().collect()))
    few = rows.where(_chosen(F.xxhash64("id"), F.col("label"), counts, per_class)).select("id", "code")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where("text IS NOT NULL").join(F.broadcast(few), "id")
    return texts.groupBy("id", "code").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("text", "code"), counts


def matrix(rows: DataFrame, features: Features, bits: list[int]) -> tuple[list[np.ndarray], list]:
    """Indicator features of (text, label): for each row its sorted columns; and the labels.

    Feature groups lie one after the other. The rows are a bounded sample, so they fit the driver: a row
    has one number for each different n-gram of its text, which is at most the feature groups' width.
    """
    start = np.concatenate([[0], np.cumsum([1 << b for b in bits])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in _text.chunks(b.column(0)):
                n = len(c.offsets) - 1
                cells = [present(p, n, k) for p, k in zip(features(c.data, c.offsets), bits, strict=True)]
                of = np.concatenate([x for x, _ in cells])
                column = np.concatenate([y + s for (_, y), s in zip(cells, start, strict=False)])
                order = np.argsort(of, kind="stable")
                ptr = np.searchsorted(of[order], np.arange(n + 1))
                lists = pa.ListArray.from_arrays(pa.array(ptr.astype(np.int32)), pa.array(column[order].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([lists, b.column(1).slice(c.rows.start, n)], ["columns", "label"])

    found = rows.mapInArrow(run, f"columns array<int>, label {rows.schema[1].dataType.simpleString()}").toArrow()
    lists = found.column("columns").combine_chunks()
    flat, ptr = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    order = np.argsort([hash_of(flat[a:b]) for a, b in zip(ptr[:-1], ptr[1:], strict=True)], kind="stable")  # reruns agree
    labels = [found.column("label")[int(i)].as_py() for i in order]
    flat = flat.copy()
    del found, lists
    pa.default_memory_pool().release_unused()
    return [flat[ptr[i] : ptr[i + 1]] for i in order], labels


def hash_of(columns: np.ndarray) -> int:
    return int(_text.mix(columns.astype(_U) * _U(0x9FB21C651E98DF25) + _U(1)).sum()) & ((1 << 62) - 1) if len(columns) else 0


def unit(rows: list[np.ndarray], values: np.ndarray) -> list[np.ndarray]:
    """Each row's values, scaled to length one: parts of one array, which goes back to the system as a whole."""
    ptr = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    found = np.empty(ptr[-1])
    out = [found[a:b] for a, b in zip(ptr[:-1], ptr[1:], strict=True)]
    for r, v in zip(rows, out, strict=True):
        np.take(values, r, out=v)
        v /= max(np.sqrt(v @ v), 1e-12)
    return out


def hinge(rows: list[np.ndarray], x: list[np.ndarray], width: int, y: np.ndarray, cost: np.ndarray, rounds: int = 30, seed: int = 0) -> np.ndarray:
    """Weights (the last one the bias) of an L2-regularised hinge loss by dual coordinate descent.

    Row i has the values x[i] in the columns rows[i] and a constant 1; cost bounds its dual variable.
    """
    w = np.zeros(width + 1)
    alpha = np.zeros(len(rows))
    q = np.array([(v * v).sum() + 1.0 for v in x])
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        most = 0.0
        for i in rng.permutation(len(rows)):
            g = y[i] * (w[rows[i]] @ x[i] + w[-1]) - 1.0
            a = min(max(alpha[i] - g / q[i], 0.0), cost[i])
            if step := (a - alpha[i]) * y[i]:
                w[rows[i]] += step * x[i]
                w[-1] += step
                alpha[i] = a
                most = max(most, abs(step))
        if most < 1e-3:
            break
    return w


def margins(rows: list[np.ndarray], x: list[np.ndarray], w: np.ndarray) -> np.ndarray:
    return np.array([w[r] @ v + w[-1] for r, v in zip(rows, x, strict=True)])


def log_ratios(rows: list[np.ndarray], y: np.ndarray, width: int, least: int = 3, smooth: float = 1.0) -> np.ndarray:
    """Naive Bayes log-count ratio of each indicator; 0 for those in fewer than `least` rows."""
    up, down = np.zeros(width), np.zeros(width)
    for r, k in zip(rows, y, strict=True):
        (up if k == 1 else down)[r] += 1  # a row has each column once
    p, q = up + smooth, down + smooth
    return np.where(up + down >= least, np.log(p / p.sum()) - np.log(q / q.sum()), 0.0)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a dense logistic regression by Newton's method; x has its constant column last."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def platt(margin: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities of y = 1, with smoothed targets."""
    if not len(y):
        return 1.0, 0.0
    up, down = (y == 1).sum(), (y != 1).sum()
    target = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = logistic(np.stack([margin, np.ones(len(y))], axis=1), target, np.ones(len(y)) if weight is None else weight, penalty=1e-3)
    return max(float(a), 1e-6), float(b)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def sparse_margins(pairs: list[tuple[np.ndarray, np.ndarray]], bits: list[int], rows: int, values: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each document w's margin without the bias, and the length of its values, before scaling to one.

    Only buckets with a value are told apart, so most n-grams fall out before anything is sorted.
    """
    total, square, start = np.zeros(rows), np.zeros(rows), 0
    for (of, bucket), b in zip(pairs, bits, strict=True):
        column = bucket + start
        on = values[column] != 0
        cell = np.unique(of[on].astype(np.int64) << 32 | column[on])
        of, column = cell >> 32, cell & 0xFFFFFFFF
        total += np.bincount(of, values[column] * w[column], minlength=rows)
        square += np.bincount(of, values[column] ** 2, minlength=rows)
        start += 1 << b
    length = np.maximum(np.sqrt(square), 1e-12)
    return total / length, length
