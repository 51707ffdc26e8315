"""Benchmark decontamination by q-gram lemma filtering.

A text that holds a benchmark item with at most e edits shares at least m - Q + 1 - Q * e of the item's
Q-grams with it (m: the item's characters), and their diagonals (place in the text less place in the item)
lie within e of each other. So shared Q-grams are counted by document, item and band of diagonals; bands
are 2 * e + 1 or more wide and overlap by half, and those that reach the bound are retained. A retained
region is verified by aligning the item within the band's diagonals.

Letters A-Z count as a-z and white space as a space; nothing else is normalised. Edits are insertions,
deletions and replacements of characters. The items go to the tasks in blocks of bounded size, each against all
documents; there is no join and no shuffle but the last one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text

Q = 10
#: Edits that an item may be away, as a share of its characters.
EDITS = 0.08
#: Characters of the items that are held against the documents at once.
BLOCK = 1 << 22
#: Pairs of a place in a text and a place in an item that are formed at once.
PAIRS = 1 << 20

_U = np.uint64
_FOLD = np.arange(128, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[9:14] = 32


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points, and the documents' offsets in them. Bytes that aren't UTF-8 become U+FFFD."""
    try:
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le", "surrogatepass"), np.uint32)
    except UnicodeDecodeError:
        texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    ascii_ = points < 128
    points = np.where(ascii_, _FOLD[np.where(ascii_, points, 0)], points)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points, heads[offsets]


def qgrams(points: np.ndarray) -> np.ndarray:
    h = np.zeros(max(len(points) - Q + 1, 0), _U)
    for k in range(Q):
        h = h * _U(0x9FB21C651E98DF25) + points[k : k + len(h)] + _U(1)
    return _text.mix(h)


def budget(m: int) -> int:
    """Edits an item of m characters may be away: a share, less where the lemma would be empty."""
    return max(min(int(m * EDITS), (m - Q) // Q), 0)


def aligned(item: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """(edits, start, stop) of the best place of item in text whose diagonals are from low to high; the
    leftmost end on ties. None if it takes more than `most` edits.

    Row i of the table is the item's first i characters, column d the diagonal low + d: text[: i + low + d].
    """
    width, far = high - low + 1, len(item) + 1
    at = low + np.arange(width)
    inside = (at >= 0) & (at <= len(text))
    cost = np.where(inside, 0, far)
    begin = at.copy()
    ramp = np.arange(width)
    for i in range(1, len(item) + 1):
        at = i + low + np.arange(width)
        inside = (at >= 0) & (at <= len(text))
        same = np.zeros(width, bool)
        ok = (at >= 1) & (at <= len(text))
        same[ok] = text[at[ok] - 1] == item[i - 1]
        step = np.where(ok, cost + ~same, far)  # along the diagonal
        drop = np.append(cost[1:] + 1, far)  # the item's character is missing from the text
        take = step <= drop
        new, origin = np.where(take, step, drop), np.where(take, begin, np.append(begin[1:], 0))
        new = np.where(inside, new, far)
        run = new - ramp  # characters of the text that the item lacks
        least = np.minimum.accumulate(run)
        came = np.maximum.accumulate(np.where(run == least, ramp, 0))
        cost, begin = np.where(inside, least + ramp, far), origin[came]
        if cost.min() > most:
            return None
    best = int(cost.argmin())
    return (int(cost[best]), int(begin[best]), int(len(item) + low + best)) if cost[best] <= most else None


def verbatim(item: np.ndarray, text: np.ndarray) -> int | None:
    """Where item first occurs in text, which an alignment without edits would find too."""
    raw, sought = text.astype("<u4").tobytes(), item.astype("<u4").tobytes()
    at = raw.find(sought)
    while at % 4 and at >= 0:
        at = raw.find(sought, at + 1)
    return at // 4 if at >= 0 else None


class Index:
    """The Q-grams of a block of items, sorted by hash."""

    def __init__(self, ids: list[int], texts: list[str]):
        column = pa.array(texts, pa.string())
        self.ids, self.items, hashes, places = ids, [], [], []
        for c in _text.chunks(column):
            points, offsets = characters(c.data, c.offsets)
            self.items += [points[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        self.most = np.array([budget(len(x)) for x in self.items], np.int64)
        self.least = np.array([len(x) - Q + 1 - Q * e for x, e in zip(self.items, self.most, strict=True)], np.int64)
        for i, x in enumerate(self.items):
            if len(x) >= Q:
                h = qgrams(x)
                hashes.append(h)
                places.append(np.stack([np.full(len(h), i), np.arange(len(h))]))
        h = np.concatenate(hashes or [np.zeros(0, _U)])
        order = np.argsort(h, kind="stable")
        self.places = np.concatenate(places, axis=1)[:, order] if places else np.zeros((2, 0), int)
        self.hashes, first, self.counts = np.unique(h[order], return_index=True, return_counts=True)
        self.first = first
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.hashes >> _U(42)).astype(np.int64)] = True

    def search(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(document, item, edits, start, stop) of each contained item; the best place in each document."""
        points, offsets = characters(data, offsets)
        h = qgrams(points)
        at = np.flatnonzero(self.bits[(h >> _U(42)).astype(np.int64)])
        found = np.minimum(np.searchsorted(self.hashes, h[at]), max(len(self.hashes) - 1, 0))
        if not len(self.hashes):
            return
        on = self.hashes[found] == h[at]
        at, found = at[on], found[on]
        of = np.searchsorted(offsets, at, "right") - 1
        on = at + Q <= offsets[of + 1]
        at, found, of = at[on], found[on], of[on]
        n, half_of = self.counts[found], self.most + 1  # bands are two halves wide
        shift = len(points) + max(map(len, self.items))  # a diagonal plus this isn't negative, but for the first half band
        wide = len(points) + shift + 2
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        sought: set[tuple[int, int]] = set()
        for overlap in (0, 1):
            key, size = self._bands(at, found, of, n, offsets, half_of, wide, shift, overlap)
            enough = size >= self.least[key // wide % len(self.items)]
            for k in key[enough].tolist():
                d, i, b = k // wide // len(self.items), k // wide % len(self.items), k % wide
                e = int(self.most[i])
                low = (2 * (b - 1) + overlap) * (e + 1) - shift
                text = points[offsets[d] : offsets[d + 1]]
                if (d, i) not in sought and (start := verbatim(self.items[i], text)) is not None:
                    best[d, i] = 0, start, start + len(self.items[i])
                sought.add((d, i))
                if (d, i) in best and not best[d, i][0]:
                    continue
                hit = aligned(self.items[i], text, low - e, low + 2 * (e + 1) - 1 + e, e)
                if hit and ((d, i) not in best or hit < best[d, i]):
                    best[d, i] = hit
        for (d, i), hit in sorted(best.items()):
            yield (d, i, *hit)


    def _bands(self, at, found, of, n, offsets, half_of, wide: int, shift: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
        """(band, shared Q-grams), a band told by document, item and place. at: places in the text, found:
        their Q-grams, each of which is at n places of items. A Q-gram that is often in the text and in items
        has as many pairs as the product, so pairs are formed and tallied PAIRS at a time."""
        keys, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        upto = np.cumsum(n)
        cuts = np.unique(np.concatenate([[0], np.searchsorted(upto, np.arange(PAIRS, upto[-1] if len(upto) else 0, PAIRS)), [len(n)]]))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            m = n[lo:hi]
            pick = np.repeat(self.first[found[lo:hi]] - (np.cumsum(m) - m), m) + np.arange(m.sum())
            item, place = self.places[:, pick]
            own, text = np.repeat(at[lo:hi], m), np.repeat(of[lo:hi], m)
            band = ((own - offsets[text] - place + shift) // half_of[item] - overlap) // 2 + 1
            key, size = np.unique((text * len(self.items) + item) * wide + band, return_counts=True)
            keys.append(key)
            sizes.append(size)
            if sum(map(len, keys)) > PAIRS:
                keys, sizes = ([x] for x in _summed(keys, sizes))
        return _summed(keys, sizes)


def _summed(keys: list[np.ndarray], sizes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(inverse, np.concatenate(sizes), len(key)).astype(np.int64)


def blocks(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of all items, each of BLOCK characters at most or of one item; they arrive in turn."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), "text").where("text IS NOT NULL").distinct().orderBy("item_id", "text")
    for item_id, text in rows.toLocalIterator():
        if texts and size + len(text) > BLOCK:
            yield Index(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(item_id)
        texts.append(text)
        size += len(text)
    if texts:
        yield Index(ids, texts)


def _against(docs: DataFrame, index: Index) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for b in batches:
            for c in _text.chunks(b.column(1)):
                if hits := list(found.search(c.data, c.offsets)):
                    d, i, *rest = map(list, zip(*hits, strict=True))
                    columns = [b.column(0).take(pa.array(d) if not c.rows.start else pa.array([x + c.rows.start for x in d])), pa.array([found.ids[x] for x in i], pa.int64()), *map(pa.array, rest)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "edits", "start", "stop"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, item_id long, edits long, start long, stop long")


def contained(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, edits, start, stop): items that lie in a document within their edit budget.

    One row for each row of docs and each item in it, with the best place (fewest edits, then the first):
    characters start to stop. The budget is EDITS of the item's characters, at most what leaves the lemma
    one shared Q-gram. Null, empty and shorter items than Q characters are in no document, null texts
    hold none, a null doc_id stays null. Equal items under several ids are each reported.
    """
    found = None
    for index in blocks(benchmark):
        one = _against(docs, index)
        found = one if found is None else found.unionByName(one)
    return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, edits long, start long, stop long") if found is None else found


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no item, with all their columns, whatever their names.

    Repeated rows stay or go alike; null and empty texts, and rows with a null doc_id, stay unless their text
    holds an item. An empty benchmark takes nothing out.
    """
    for index in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def judge(c: _text.Chunk, shared=shared) -> np.ndarray:
            keep = np.ones(len(c.offsets) - 1, bool)
            keep[[d for d, *_ in shared.value.search(c.data, c.offsets)]] = False
            return keep

        docs = _text.kept(docs, judge)
    return docs
