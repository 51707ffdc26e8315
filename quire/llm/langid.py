"""Language identification by hierarchical discrimination.

First the language family is predicted by linear models, one family against the rest; then, within the
family, one-versus-one linear support vector machines tell its languages apart: each pair votes, and
ties go to the larger sum of margins. Features are indicators of hashed three-byte grams and words in
lower case; a text's vector has length one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _linear, _text

#: Rows of each language that the models are fitted on, at most.
PER_LANGUAGE = 600
BITS = [14, 14]
#: Families of languages by ISO 639-1 code; any other language is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tk tr tt uz",
    "semitic": "am ar he mt",
    "indic": "as bn gu hi mr ne or pa sd si ur",
    "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te",
    "austronesian": "id jv mg ms su tl",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def lower(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and of the letters U+00C0 to U+00DE, in UTF-8."""
    out = _text.LOWER[data]
    second = np.flatnonzero((out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)) + 1
    out[second] += 0x20
    return out


def features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    data = lower(data)
    return [_linear.byte_grams(data, offsets, 3, BITS[0]), _linear.word_grams(data, offsets, 1, BITS[1])]


class Model:
    """families: names; members: languages of each; one: weights of family against the rest, with a
    slope and offset; pairs: weights of each two languages of a family, likewise."""

    def __init__(self, rows: list[np.ndarray], labels: list[str]):
        width = sum(1 << b for b in BITS)
        x = _linear.unit(rows, np.ones(width))
        y = np.array(labels)
        self.languages = sorted(set(labels))
        family = np.array([_FAMILY.get(code, code) for code in labels])
        self.families = sorted(set(family))
        self.members = [[c for c in self.languages if _FAMILY.get(c, c) == f] for f in self.families]

        def fit(on: np.ndarray, sign: np.ndarray) -> tuple[np.ndarray, float, float]:
            take = np.flatnonzero(on)
            few = min((sign[take] == 1).sum(), (sign[take] == -1).sum())
            cost = np.where(sign[take] == 1, few / (sign[take] == 1).sum(), few / (sign[take] == -1).sum()) * 4.0
            r, v = [rows[i] for i in take], [x[i] for i in take]
            w = _linear.hinge(r, v, width, sign[take], cost)
            return (w, *_linear.platt(_linear.margins(r, v, w), sign[take], cost))

        everything = np.ones(len(y), bool)
        self.one = [fit(everything, np.where(family == f, 1, -1)) for f in self.families] if len(self.families) > 1 else []
        self.pairs = {(a, b): fit((y == a) | (y == b), np.where(y == a, 1, -1)) for m in self.members for a, b in combinations(m, 2)}

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index in languages, and score, of each document."""
        n = len(offsets) - 1
        of, column, start = [], [], 0
        for p, b in zip(features(data, offsets), BITS, strict=True):
            x, y = _linear.present(p, n, b)
            of.append(x)
            column.append(y + start)
            start += 1 << b
        of, column = np.concatenate(of), np.concatenate(column)
        length = np.sqrt(np.maximum(np.bincount(of, minlength=n), 1))

        def probability(w: np.ndarray, slope: float, offset: float) -> np.ndarray:
            return _linear.sigmoid(slope * (np.bincount(of, w[column], minlength=n) / length + w[-1]) + offset)

        chance = np.stack([probability(*m) for m in self.one]) if self.one else np.ones((1, n))
        family = chance.argmax(axis=0)
        chance = (chance / chance.sum(axis=0)).max(axis=0)
        best, score = np.zeros(n, np.int64), np.zeros(n)
        for k, members in enumerate(self.members):
            on = family == k
            votes, sure = np.zeros((len(members), n)), np.zeros((len(members), n))
            for (i, a), (j, b) in combinations(enumerate(members), 2):
                p = probability(*self.pairs[a, b])
                for m, q in ((i, p), (j, 1 - p)):
                    votes[m] += q >= 0.5
                    sure[m] += q
            won = (votes + sure / (len(members) + 1)).argmax(axis=0)
            share = sure[won, np.arange(n)] / (len(members) - 1) if len(members) > 1 else np.ones(n)
            best[on] = np.array([self.languages.index(c) for c in members])[won[on]]
            score[on] = (chance * share)[on]
        return best, np.clip(score, 0.0, 1.0)


def train(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE) -> Model | None:
    """A model from the text and lang of the rows for which learn holds; None if there are none."""
    rows, labels = _linear.matrix(_linear.sample(docs.where(learn), F.col("lang"), per_language), features, BITS)
    return Model(rows, labels) if rows else None


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of docs, from text alone.

    A null text, one without a letter, and every text where nothing was learned, are `und` with score 0. Repeated
    rows are each told, a null doc_id stays null, other columns than doc_id and text are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for b in batches:
            told = b.column(1).is_valid().to_numpy(zero_copy_only=False)
            for c in _text.chunks(b.column(1)):
                ids = b.column(0).slice(c.rows.start, len(c.offsets) - 1)
                if found is None:
                    names, score = ["und"] * len(ids), np.zeros(len(ids))
                else:
                    best, score = found.predict(c.data, c.offsets)
                    score = np.where(told[c.rows], score, 0.0)
                    names = [found.languages[k] if t else "und" for k, t in zip(best, told[c.rows], strict=True)]
                yield pa.RecordBatch.from_arrays([ids, pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    text = F.when(F.col("text").rlike(r"\p{L}"), F.col("text"))
    return docs.select(F.col("doc_id").cast("long"), text.alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
