"""Substring deduplication: seed and extend over winnowed anchors.

A repeat is a run of at least LENGTH words that also starts earlier in the corpus. Each window of LENGTH
words has one anchor, the least hash among its SEED-word grams (winnowing: equal windows have equal
anchors at equal places, and neighbouring windows mostly share theirs). Documents are joined on the
anchors' hashes; an anchor that occurs once takes all its windows with it. From those that remain, the
match is extended both ways: each window around the anchor, as far as it belongs to it, is held against
the windows that the anchor has at the same offset elsewhere. Matching windows are merged to maximal repeats.

The seeds are a seventh of the words, and only windows around repeated seeds are ever shuffled. Exact
copies of a whole text are set aside first, by 128 bits of hash. Groups are streamed through a task
in order, never gathered: a repeated anchor needs its two neighbours, an extension the windows seen so far.
An anchor's rows are dealt to parts of HOT rows each. A part finds the windows that it has before; of an anchor
with several parts, each part's first windows then meet by their hashes, a row for each window and part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text
from ._common import checkpointed, partitions

LENGTH, SEED = 20, 6
#: Rows of an anchor that are held against each other in one task.
HOT = 20_000
LAST = (1 << 63) - 1
_U = np.uint64
_STEP = 0xD6E8FEB86659FD93


def anchors(h: np.ndarray, ptr: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For word hashes h: starts of the windows within one document, each one's anchor, and gram hashes."""
    none = np.zeros(0, np.int64)
    if len(h) < length:
        return none, none, np.zeros(0, _U)
    grams = _text.gram_hashes(h, seed)
    whole = np.diff(ptr) - length + 1
    n = np.maximum(whole, 0)
    starts = np.repeat(ptr[:-1] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    view = np.lib.stride_tricks.sliding_window_view(grams, length - seed + 1)
    at = np.concatenate([view[starts[i : i + 65536]].argmin(axis=1) for i in range(0, len(starts), 65536)] or [none])
    return starts, starts + at, grams


def window_hashes(h: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    sums = np.zeros(len(h) + 1, _U)
    np.cumsum(h * _text.powers(_STEP, len(h)), out=sums[1:])
    return _text.mix((sums[starts + length] - sums[starts]) * _text.powers(pow(_STEP, -1, 1 << 64), len(h))[starts])


def _runs(a: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and each row's count; null counts as empty."""
    n = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return pc.list_flatten(column).to_numpy(zero_copy_only=False), n


def _seeds(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            did, th = (b.column(i).to_numpy() for i in (0, 1))
            for c in _text.chunks(b.column(2)):
                w = _text.words(c.data, c.offsets)
                _, at, grams = anchors(_text.word_hashes(c.data, w), w.ptr, length, seed)
                at = at[_runs(at)]
                of = np.searchsorted(w.ptr, at, "right") - 1
                place = (at - w.ptr[of]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (grams[at].view(np.int64), did[c.rows][of], th[c.rows][of], place)], ["anchor", "did", "th", "place"])

    return run


def _repeated(hot: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows sorted by anchor, those whose anchor a neighbour has too. spot: the place, and above its
        32 bits the part: how often hot rows of this anchor came before."""
        last, held, seen = None, None, 0  # held: the row before, if its anchor hasn't been seen twice yet; seen: rows of its anchor

        def spots(b: pa.RecordBatch, part: np.ndarray) -> pa.RecordBatch:
            spot = b.column(3).to_numpy().astype(np.int64) | part << 32
            return pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(spot)], ["did", "th", "spot"])

        for b in batches:
            if not len(b):
                continue
            a = b.column(0).to_numpy()
            goes_on = last is not None and a[0] == last
            same = a[1:] == a[:-1]
            keep = np.concatenate([[goes_on], same])
            keep[:-1] |= same
            if held is not None and goes_on:
                yield spots(held, np.zeros(1, np.int64))
            first = _runs(a)
            size = np.diff(np.append(first, len(a)))
            place = np.arange(len(a)) - np.repeat(first, size)
            place[: size[0]] += seen if goes_on else 0
            yield spots(b.filter(pa.array(keep)), place[keep] // hot)
            last, held, seen = a[-1], None if keep[-1] else b.slice(len(b) - 1), int(place[-1]) + 1

    return run


def _extensions(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            did, th = (b.column(i).to_numpy() for i in (0, 1))
            spots, counts = _lists(b.column(3))
            ends = np.cumsum(counts)
            for c in _text.chunks(b.column(2)):
                w = _text.words(c.data, c.offsets)
                h = _text.word_hashes(c.data, w)
                starts, at, grams = anchors(h, w.ptr, length, seed)
                lo, hi = ends[c.rows.start] - counts[c.rows.start], ends[c.rows.stop - 1]
                part = np.full(len(h) + 1, LAST)
                own = (spots[lo:hi] & 0xFFFFFFFF) + np.repeat(w.ptr[:-1], counts[c.rows])
                np.minimum.at(part, own, spots[lo:hi] >> 32)  # repeated rows may be told several parts
                on = part[at] < LAST
                starts, at = starts[on], at[on]
                first = _runs(at)
                at, back = at[first], (at - starts)[first].astype(np.int32)
                of = np.searchsorted(w.ptr, at, "right") - 1
                offsets = np.append(first, len(starts)) * 8
                windows = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(window_hashes(h, starts, length))])
                columns = [pa.array(x) for x in (grams[at].view(np.int64), part[at].astype(np.int32), did[c.rows][of], th[c.rows][of], (at - w.ptr[of]).astype(np.int32), back)]
                yield pa.RecordBatch.from_arrays([*columns, windows], ["anchor", "part", "did", "th", "place", "back", "windows"])

    return run


def _later(hot: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of anchors' parts in corpus order, the windows that an earlier row has at the same offset.

        A window is told by anchor, offset and hash. Those of the last part are carried on to the next
        batch. mask has bit r for the window that starts r words before the anchor. Of an anchor with several
        parts each part's first windows follow, one a row, with the window's key.
        """
        names = ["did", "th", "place", "mask", "key"]
        carried = None  # part, keys, rows (did, th, place, offset), how many rows the part has had

        def firsts(key: np.ndarray, who: np.ndarray) -> pa.RecordBatch:
            did, th, place, off = who
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (did, th, place.astype(np.int32), np.int64(1) << off, key.view(np.int64))], names)

        for b in batches:
            if not len(b):
                continue
            anchor, part, did, th, place, back = (b.column(i).to_numpy() for i in range(6))
            sizes = pc.binary_length(b.column(6)).to_numpy() // 8
            offsets = np.frombuffer(b.column(6).buffers()[1], np.int32)[b.column(6).offset :][: len(b) + 1]
            hashes = np.frombuffer(b.column(6).buffers()[2], np.uint8)[offsets[0] : offsets[-1]].copy().view(_U)
            row = np.repeat(np.arange(len(b)), sizes)
            off = np.repeat(back, sizes) - (np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes))
            key = _text.mix(hashes ^ _text.mix(anchor.view(_U)[row] + off.astype(_U) * _U(_STEP)))
            who = np.stack([did[row], th[row], place[row].astype(np.int64), off.astype(np.int64)])
            group = np.cumsum(np.concatenate([[0], (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])]))
            rows_of = np.bincount(group)
            of, new = group[row], len(key)
            if carried is not None and carried[0] == (anchor[0], part[0]):
                key, who = np.concatenate([carried[1], key]), np.concatenate([carried[2], who], axis=1)
                of = np.concatenate([np.zeros(len(carried[1]), np.int64), of])
                rows_of[0] += carried[3]
            elif carried is not None and (carried[0][1] or carried[3] >= hot):
                yield firsts(carried[1], carried[2])
            _, first, inverse = np.unique(key ^ _text.mix(of.astype(_U)), return_index=True, return_inverse=True)
            again = (who[:3] != who[:3, first[inverse]]).any(axis=0)[len(key) - new :]
            mask = np.zeros(len(b), np.int64)
            np.bitwise_or.at(mask, row[again], np.int64(1) << off[again].astype(np.int64))
            on = mask != 0
            yield pa.RecordBatch.from_arrays([*(pa.array(x[on]) for x in (did, th, place, mask)), pa.nulls(int(on.sum()), pa.int64())], names)
            begins = _runs(group)
            several = (part[begins] > 0) | (rows_of >= hot)
            several[-1] = False  # the last part may go on
            ended = first[several[of[first]]]
            if len(ended):
                yield firsts(key[ended], who[:, ended])
            tail = first[of[first] == group[-1]]
            carried = (anchor[-1], part[-1]), key[tail], who[:, tail], int(rows_of[-1])
        if carried is not None and (carried[0][1] or carried[3] >= hot):
            yield firsts(carried[1], carried[2])

    return run


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            places, counts = _lists(b.column(3))
            masks, _ = _lists(b.column(4))
            ends = np.cumsum(counts)
            copy = b.column(2).fill_null(False).to_numpy(zero_copy_only=False)
            for c in _text.chunks(b.column(1)):
                data, w = _text.single_spaced(c.data, c.offsets)
                lo, hi = ends[c.rows.start] - counts[c.rows.start], ends[c.rows.stop - 1]
                at = places[lo:hi] + np.repeat(w.ptr[:-1], counts[c.rows])
                depth = np.zeros(len(w.starts) + 1, np.int64)
                for r in range(length):
                    starts = at[(masks[lo:hi] >> r) & 1 == 1] - r
                    np.add.at(depth, starts, 1)
                    np.add.at(depth, starts + length, -1)
                gone = np.cumsum(depth)[:-1] > 0
                n = np.diff(w.ptr)
                gone |= np.repeat(copy[c.rows] & (n >= length), n)
                removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[w.ptr])
                raw, sha = data.tobytes(), []
                for i, (p, q) in enumerate(zip(w.ptr[:-1].tolist(), w.ptr[1:].tolist(), strict=True)):
                    if not removed[i]:
                        kept = raw[w.starts[p] : w.ends[q - 1]] if q > p else b""
                    else:
                        kept = b" ".join(raw[w.starts[j] : w.ends[j]] for j in (np.flatnonzero(~gone[p:q]) + p).tolist())
                    sha.append((kept.decode(), hashlib.sha256(kept).hexdigest()))
                texts, sums = zip(*sha, strict=True)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(c.rows.start, len(n)), pa.array(n), pa.array(removed), pa.array(sums), pa.array(texts)], ["doc_id", "n_words", "n_removed", "kept_sha256", "text"])

    return run


def dedup(docs: DataFrame, length: int = LENGTH, seed: int = SEED, hot: int = HOT) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, text) for every row of docs.

    Removes each word that lies in a window of `length` words whose sequence also starts earlier: in a
    smaller doc_id, or before in the same document; windows are judged on the input. text: the kept
    words, joined by one space. A null text has no words. Rows alike in doc_id and text are one document
    and lose the same words; other texts of one doc_id follow each other by hash; a null doc_id comes
    last. Columns of docs other than doc_id and text are not read.
    """
    n = partitions(docs.sparkSession)
    told = F.coalesce("text", F.lit(""))
    ids = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("did"), F.xxhash64(told).alias("th"), told.alias("text"))
    texts = ids.repartition(n, "did", "th")

    keys = ids.select("did", "th", F.xxhash64(F.lit(1), "text").alias("th2"))
    first = keys.groupBy("th", "th2").agg(F.min("did").alias("first"))
    copies = keys.join(first, ["th", "th2"]).where("did > first").select("did", "th", F.lit(True).alias("copy")).distinct()

    alone = texts.join(copies.hint("shuffle_hash"), ["did", "th"], "left").where("copy IS NULL")
    seeds = alone.select("did", "th", "text").mapInArrow(_seeds(length, seed), "anchor long, did long, th long, place int")
    seeds = seeds.repartition(n, "anchor").sortWithinPartitions("anchor")
    repeated = seeds.mapInArrow(_repeated(hot), "did long, th long, spot long").groupBy("did", "th").agg(F.collect_set("spot").alias("spots"))

    around = texts.join(repeated.hint("shuffle_hash"), ["did", "th"]).select("did", "th", "text", "spots")
    around = around.mapInArrow(_extensions(length, seed), "anchor long, part int, did long, th long, place int, back int, windows binary")
    around = around.repartition(n, "anchor", "part").sortWithinPartitions("anchor", "part", "did", "th", "place")
    later = checkpointed(around.mapInArrow(_later(hot), "did long, th long, place int, mask long, key long"))
    where = F.struct("did", "th", "place")
    firsts = later.where("key IS NOT NULL")
    least = firsts.groupBy("key").agg(F.min(where).alias("first"))
    later = later.where("key IS NULL").drop("key").unionByName(firsts.join(least, "key").where(where > F.col("first")).select("did", "th", "place", "mask"))
    repeats = later.groupBy("did", "th").agg(F.collect_list("place").alias("places"), F.collect_list("mask").alias("masks"))

    gone = repeats.select("did", "th", F.lit(None).cast("boolean").alias("copy"), "places", "masks")
    gone = gone.unionByName(copies.select("did", "th", "copy", F.lit(None).cast("array<int>").alias("places"), F.lit(None).cast("array<bigint>").alias("masks")))
    both = texts.join(gone.hint("shuffle_hash"), ["did", "th"], "left").select("doc_id", "text", "copy", "places", "masks")
    return both.mapInArrow(_cut(length), "doc_id long, n_words long, n_removed long, kept_sha256 string, text string")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (SELECT doc_id, i, list_slice(words, i, i + 19) AS win FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d WHERE len(words) >= 20)),
m AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS n FROM g) WHERE n > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM m),
w AS (SELECT doc_id, words[j] AS word, j FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS j FROM d)),
k AS (SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.j) AS kept, count(*) AS n FROM w LEFT JOIN c ON w.doc_id = c.doc_id AND w.j = c.j WHERE c.j IS NULL GROUP BY w.doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""
