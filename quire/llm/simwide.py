"""Near copies by SimHash fingerprints that are wide enough for a Jaccard similarity of 0.8.

Two texts of similarity 0.8 differ in 15 % of their SimHash bits, so they share a positional byte with
probability 0.27 and about 51 of POSITIONS = 192; unrelated ones share under one. The index has a posting
for each three of every four consecutive positions, with the bytes there: 192 lists of 24 bits. A pair at
exactly 0.8 meets in none with probability 0.05, at 0.85 0.004, at 0.9 below 1e-4. Where a pair meets, its shared
positional bytes are tallied; pairs below LEAST, three deviations under the mean at 0.8, go. The
others are verified: their numbers of shingles must be within 0.8 of each other, of the fingerprints' bits MOST
may differ, three deviations over the mean at 0.8, and 0.8 of the texts' different shingles must be shared.

Texts with the same set of shingles are one node. Lists are compared in blocks of bounded size. First each
node is held against the one that it shares most bytes with, and nodes that share LEAST bytes with no other
of their list leave it, but for lists of several blocks: a partner may be in another block, so all stay and each
block meets each other one. Then only nodes meet that the verified pairs haven't connected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _common, _text
from ._common import checkpointed, components, partitions, small

POSITIONS, GROUP = 192, 4
#: Shared positional bytes that a pair needs.
LEAST = 33
#: Bits of the fingerprints in which a pair may differ: of 1536, at 0.8 a pair differs in 233 with deviation 14.
#: In texts of fewer shingles than SOME, few votes make a bit and more may differ (288 for 4 of 5): no limit there.
MOST, SOME = 275, 30
#: Nodes of a list that are compared at once, and the first ones of the list that each block begins with.
BLOCK, LEADERS = 1024, 32
#: Shingles that may be broadcast, at eight bytes each.
FEW = 4_000_000
#: In a list of SHORT nodes at most, one stays if another is within WORD_BITS of its 64 bits behind the list's
#: positions. At 0.8 a pair differs in 10 of them and is above the limit with probability 3e-4, an unrelated one in 32.
SHORT, WORD_BITS = 64, 20
#: Jaccard similarity of at least 0.8, in whole numbers: shared / (a + b - shared) >= 4 / 5.
SIMILAR = "9 * size(array_intersect(a.shingles, b.shingles)) >= 4 * (size(a.shingles) + size(b.shingles))"

_U = np.uint64
_FLIP, _ODD = (_text.mix(np.arange(k, k + POSITIONS // 8, dtype=_U)) for k in (1, 1 << 20))
_ODD |= _U(1)
#: For each byte, its bits in eight lanes of eight bits.
_LANES = sum(((np.arange(256, dtype=_U) >> _U(k)) & _U(1)) << _U(8 * k) for k in range(8))


def chunk_shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each document's different shingles, and where each document begins, with the end."""
    data = _text.LOWER[data]
    w = _text.words(data, offsets)
    h, n = _text.word_hashes(data, w), np.diff(w.ptr)
    take = np.where(n >= size, n - size + 1, np.minimum(n, 1))  # fewer words: the whole sequence
    ptr = np.concatenate([[0], np.cumsum(take)])
    out = np.zeros(ptr[-1], _U)
    for k in range(1, size + 1):
        count = np.where(n >= size if k == size else n == k, take, 0)
        if count.any():
            within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            out[np.repeat(ptr[:-1], count) + within] = _text.gram_hashes(h, k, k)[np.repeat(w.ptr[:-1], count) + within]
    of = _text.owners(ptr)
    _, first = np.unique(_text.mix(out + of.astype(_U) * _U(0x9FB21C651E98DF25)), return_index=True)
    first.sort()
    return out[first], np.searchsorted(of[first], np.arange(len(ptr)))


def chunk_fingerprints(h: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each document a hash of its set of shingles; the fingerprints, POSITIONS bytes each, of those
    that have shingles, and which these are. A bit is set if it is in over half of the shingles' hashes."""
    full = np.flatnonzero(np.diff(ptr))
    node, found = np.zeros(len(ptr) - 1, _U), np.zeros((len(full), POSITIONS), np.uint8)
    if not len(full):
        return node, found, full
    starts, n = ptr[:-1][full], np.diff(ptr)[full]
    node[full] = _text.mix(np.add.reduceat(_text.mix(h), starts))
    pieces = -(-n // 255)  # a lane counts to 255
    first = np.cumsum(pieces) - pieces
    cuts = np.repeat(starts, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(first, pieces))
    for k in range(POSITIONS // 8):
        by_byte = _text.mix((h ^ _FLIP[k]) * _ODD[k]).view(np.uint8).reshape(-1, 8)
        for j in range(8):
            lanes = np.add.reduceat(_LANES[by_byte[:, j]], cuts).view(np.uint8).reshape(-1, 8)
            tally = np.add.reduceat(lanes.astype(np.int64), first, axis=0)
            found[:, 8 * k + j] = np.packbits(2 * tally > n[:, None], axis=1, bitorder="little")[:, 0]
    return node, found, full


def _lists(ptr: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ptr.astype(np.int32)), pa.array(values))


def nodes_of(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, fp, th, sim, n) for each row: the set of shingles, the text, the fingerprint, how many shingles.
    Null and wordless texts have fp 0 and no fingerprint. One pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in _text.chunks(b.column(1)):
                h, ptr = chunk_shingles(c.data, c.offsets, shingle)
                node, found, full = chunk_fingerprints(h, ptr)
                raw, at = found.tobytes(), np.full(len(node), -1)
                at[full] = np.arange(len(full)) * POSITIONS
                sims = pa.array([raw[i : i + POSITIONS] if i >= 0 else None for i in at.tolist()], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0)[c.rows.start : c.rows.stop].cast(pa.int64()), pa.array(node.view(np.int64)), b.column(2)[c.rows.start : c.rows.stop], sims, pa.array(np.diff(ptr).astype(np.int32))], ["doc_id", "fp", "th", "sim", "n"])

    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return found.withColumn("th", F.xxhash64(F.coalesce("text", F.lit("")))).mapInArrow(run, "doc_id long, fp long, th long, sim binary, n int")


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(id, shingles) of (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in _text.chunks(b.column(1)):
                h, ptr = chunk_shingles(c.data, c.offsets, shingle)
                yield pa.RecordBatch.from_arrays([b.column(0)[c.rows.start : c.rows.stop], _lists(ptr, h.view(np.int64))], ["id", "shingles"])

    return texts.select("id", "text").mapInArrow(run, "id long, shingles array<long>")


def _matrix(column: pa.Array) -> np.ndarray:
    """A binary column of POSITIONS bytes each, as rows."""
    _, offsets, data = column.buffers()
    lo = int(np.frombuffer(offsets, np.int32)[column.offset])
    return np.frombuffer(data, np.uint8)[lo : lo + len(column) * POSITIONS].reshape(-1, POSITIONS)


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, posting, word). posting: above, the list, which is told by its number and three bytes; below, the
    upper half of the node's id. Nodes that share this half come with each other, which only proposes a few
    pairs more. word: the eight bytes behind the list's positions."""
    for b in batches:
        for lo in range(0, len(b), 4096):
            part = b.slice(lo, 4096)
            narrow = _matrix(part.column(1))
            f = narrow.astype(_U)
            half, kind = part.column(0).to_numpy().view(_U) >> _U(32), 0
            for g in range(0, POSITIONS, GROUP):
                word = np.ascontiguousarray(np.take(narrow, np.arange(g + GROUP, g + GROUP + 8) % POSITIONS, axis=1)).view(np.int64)[:, 0]
                for out in range(GROUP):
                    x, y, z = (f[:, g + i] for i in range(GROUP) if i != out)
                    key = _U(kind << 24) | x << _U(16) | y << _U(8) | z
                    yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.uint32).view(np.int32)), pa.array((key << _U(32) | half).view(np.int64)), pa.array(word)], ["key", "posting", "word"])
                    kind += 1


def _meeting(cuts: np.ndarray, sizes: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Which entries of the lists that begin at cuts have one within WORD_BITS of theirs; all of a long list."""
    left = np.repeat(sizes, sizes) - (np.arange(len(word)) - np.repeat(cuts, sizes))
    found = np.repeat(sizes > SHORT, sizes)
    left[found] = 0
    at, d = np.flatnonzero(left > 1), 1
    while len(at):
        near = at[np.bitwise_count(word[at] ^ word[at + d]) <= WORD_BITS]
        found[near] = found[near + d] = True
        d += 1
        at = at[left[at] > d]
    return found


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, block, ids) of sorted postings, for lists of two or more that may be alike; ids: halves of the
    nodes' ids. block is 0 for a list of one block; the blocks of a longer one count from 1, and each begins with
    the list's first nodes. Such a list is streamed, never held."""
    rest = np.zeros(0, _U), np.zeros(0, _U)
    streamed = None  # of a list that is streamed: its key, its first nodes, how many blocks it has had

    def rows(key: np.ndarray, block: list[int], ids: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(key.astype(np.uint32).view(np.int32)), pa.array(block, pa.int32()), ids], ["key", "block", "ids"])

    def block(key: np.uint64, ids: np.ndarray, number: int) -> pa.RecordBatch:
        return rows(np.array([key]), [number + 1], pa.array([ids], pa.list_(pa.int64())))

    for b in chain(batches, [None]):
        new = [b.column(i).to_numpy().view(_U) for i in (0, 1)] if b is not None else [x[:0] for x in rest]
        posting, word = (np.concatenate(x) for x in zip(rest, new, strict=True))
        if not len(posting):
            continue
        key, ids = posting >> _U(32), (posting & _U(0xFFFFFFFF)).astype(np.int64)
        cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(cuts, len(key)))
        done = len(cuts) - (b is not None)  # the last list may go on
        if streamed and done and key[0] == streamed[0]:
            for lo in range(0, sizes[0], BLOCK):
                yield block(key[0], np.concatenate([streamed[1], ids[lo : min(lo + BLOCK, sizes[0])]]), streamed[2] + lo // BLOCK)
            cuts, sizes, done, streamed = cuts[1:], sizes[1:], done - 1, None
        for k in np.flatnonzero(sizes[:done] > BLOCK).tolist():
            own = ids[cuts[k] : cuts[k] + sizes[k]]
            for number, lo in enumerate(range(0, len(own), BLOCK)):
                yield block(key[cuts[k]], np.concatenate([own[: min(lo, LEADERS)], own[lo : lo + BLOCK]]), number)
        if done:
            keep = (sizes[:done] > 1) & (sizes[:done] <= BLOCK)
            lo, hi = cuts[0], cuts[done - 1] + sizes[done - 1]
            on = _meeting(cuts[:done] - lo, sizes[:done], word[lo:hi]) & np.repeat(keep, sizes[:done])
            of = np.repeat(np.arange(done), sizes[:done])[on]
            count = np.bincount(of, minlength=done)
            told = np.flatnonzero(count)
            if len(told):
                yield rows(key[cuts[told]], [0] * len(told), _lists(np.concatenate([[0], np.cumsum(count[told])]), ids[lo:hi][on]))
        at = cuts[done] if done < len(cuts) else len(key)
        while len(posting) - at > BLOCK:  # so that something is always left
            first, number = (streamed[1], streamed[2]) if streamed else (ids[at : at + LEADERS], 0)
            yield block(key[at], np.concatenate([first[: number and LEADERS], ids[at : at + BLOCK]]), number)
            streamed = key[at], first, number + 1
            at += BLOCK
        rest = posting[at:], word[at:]


def _tallies(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Shared positional bytes of rows of a with all of b, some rows at a time: (first row, tally)."""
    step = max(1, (1 << 25) // max(b.size, 1))
    for i in range(0, len(a), step):
        yield i, (a[i : i + step, None, :] == b[None, :, :]).sum(axis=2, dtype=np.int16)


def _structs(column: pa.Array, row: int) -> list[pa.Array]:
    """The fields of one row of a column of lists of structs."""
    return column[row].values.flatten()


def _best(ids: np.ndarray, f: np.ndarray, every: bool) -> list[pa.Array] | None:
    """Of a block's nodes those that share LEAST bytes with another, or every node, and for each of them that has
    an earlier one the one with which it shares most, and the tally (null for the others)."""
    alive, best, most = np.zeros(len(f), bool), np.zeros(len(f), np.int64), np.zeros(len(f), np.int32)
    for lo, tally in _tallies(f, f):
        at = lo + np.arange(len(tally))
        tally[at - lo, at] = 0
        alive[at] = (tally >= LEAST).any(axis=1)
        tally[np.arange(len(f))[None, :] >= at[:, None]] = 0
        best[at] = tally.argmax(axis=1)
        most[at] = tally[at - lo, best[at]]
    alive |= every
    has = (most >= LEAST)[alive]
    return [pa.array(ids[alive]), *(pa.array(x[alive], mask=~has) for x in (ids[best], most))] if alive.any() else None


def _nearest(nodes_of_row: Callable[[pa.RecordBatch, int], tuple[np.ndarray, np.ndarray]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(key, block, ids, near, n) of blocks: _best() of their nodes, every one of a list of several blocks."""
        for b in batches:
            found = []
            for r in range(len(b)):
                block = b.column(1)[r].as_py()
                if (lists := _best(*nodes_of_row(b, r), block > 0)) is not None:
                    found.append((b.column(0)[r].as_py(), block, *lists))
            if found:
                key, block, *lists = zip(*found, strict=True)
                lists = [pa.array(x, pa.list_(t)) for x, t in zip(lists, (pa.int64(), pa.int64(), pa.int32()), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int32()), pa.array(block, pa.int32()), *lists], ["key", "block", "ids", "near", "n"])

    return run


def _gathered(b: pa.RecordBatch, r: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and fingerprints of a row's nodes, which it holds."""
    ids, sims = _structs(b.column(2), r)
    return ids.to_numpy(), _matrix(sims)


def _looked_up(shared):
    def nodes(b: pa.RecordBatch, r: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and fingerprints of the nodes that a row names by halves; these are broadcast."""
        halves, ids, f = shared.value
        own = b.column(2)[r].values.to_numpy()
        lo = np.searchsorted(halves, own)
        n = np.searchsorted(halves, own, "right") - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return ids[at], f[at]

    return nodes


def _arrays(table: DataFrame, *order: str) -> list[np.ndarray]:
    """A small table's columns as arrays, the fingerprints last."""
    found = table.orderBy(*order).toArrow().combine_chunks()
    *rest, sim = found.columns
    return [*(x.to_numpy() for x in rest), np.frombuffer(b"".join(sim.to_pylist()), np.uint8).reshape(-1, POSITIONS)]


def _apart(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> np.ndarray:
    """Pairs of two blocks' nodes, given as ids, classes, numbers of shingles and fingerprints, that are of two
    classes, share LEAST bytes and may be alike by their sizes and bits."""
    (ids, of, n, f), (oids, oof, on, of_f) = a, b
    bits, others = (np.ascontiguousarray(x).view(_U) for x in (f, of_f))
    found = [np.zeros((2, 0), np.int64)]
    for lo, tally in _tallies(of_f, f):
        tally[oof[lo : lo + len(tally), None] == of[None, :]] = 0
        x, y = np.nonzero(tally >= LEAST)
        x += lo
        low, high = (g(on[x], n[y]).astype(np.int64) for g in (np.minimum, np.maximum))
        near = np.bitwise_count(others[x] ^ bits[y]).sum(axis=1, dtype=np.int64) <= MOST
        may = (5 * low >= 4 * high) & (near | (low < SOME))
        found.append(np.stack([oids[x[may]], ids[y[may]]]))
    return np.concatenate(found, axis=1)


def _pairs(found: list[np.ndarray]) -> pa.RecordBatch:
    pairs = np.unique(np.sort(np.concatenate([np.zeros((2, 0), np.int64), *found], axis=1), axis=0), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in pairs], ["u", "v"])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs across classes of rows of two blocks, or of a block with itself."""
    for b in batches:
        found = []
        for r in range(len(b)):
            sides = [_structs(b.column(i), r) for i in (0, 1)]
            found.append(_apart(*((*(x.to_numpy() for x in rest), _matrix(sims)) for *rest, sims in sides)))
        yield _pairs(found)


def _across_known(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs across classes of each block's nodes, whose classes and fingerprints are broadcast."""
        known, of, n, f = shared.value
        for b in batches:
            found = []
            for r in range(len(b)):
                ids = b.column(0)[r].values.to_numpy()
                at = np.searchsorted(known, ids)
                if (of[at] != of[at[0]]).any():
                    own = ids, of[at], n[at], f[at]
                    found.append(_apart(own, own))
            yield _pairs(found)

    return run


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs whose texts are alike; sets: (id, shingles), marked for a broadcast if there are few shingles."""
    return pairs.join(sets.alias("a"), F.col("u") == F.col("a.id")).join(sets.alias("b"), F.col("v") == F.col("b.id")).where(SIMILAR).select("u", "v")


def linked(docs: DataFrame, known: DataFrame, shingle: int) -> DataFrame:
    """(node, component) of all nodes that are similar to another; known: nodes_of docs."""
    n = partitions(docs.sparkSession)
    nodes = known.where("sim IS NOT NULL").groupBy("fp").agg(F.first("sim").alias("sim"), F.first("n").alias("n"), F.min(F.struct("doc_id", "th")).alias("text"))
    nodes = checkpointed(nodes.select(F.col("fp").alias("id"), "n", "sim", "text.*"))
    postings = nodes.select("id", "sim").mapInArrow(_postings, "key int, posting long, word long").repartition(n, "key").select("posting", "word").sortWithinPartitions("posting")
    blocks = checkpointed(postings.mapInArrow(_blocks, "key int, block int, ids array<long>"))
    blocks = blocks.withColumn("ids", F.array_distinct("ids"))
    short = blocks.where("block = 0").groupBy("ids").agg(F.min("key").alias("key"))  # many lists hold the same nodes
    blocks = short.select("key", F.lit(0).alias("block"), "ids").unionByName(blocks.where("block > 0"))
    schema = "key int, block int, ids array<long>, near array<long>, n array<int>"
    by_half = nodes.select(F.shiftrightunsigned("id", 32).alias("half"), "id", "sim")
    listed = checkpointed(by_half.join(blocks.select(F.explode("ids").alias("half")).distinct(), "half", "left_semi"))
    if listed.count() <= _common.SMALL:
        shared = docs.sparkSession.sparkContext.broadcast(_arrays(listed, "half", "id"))
        blocks = blocks.mapInArrow(_nearest(_looked_up(shared)), schema)
    else:
        cells = blocks.select("key", "block", F.posexplode("ids").alias("place", "half")).join(by_half, "half")
        whole = F.transform(F.sort_array(F.collect_list(F.struct("place", "id", "sim"))), lambda x: F.struct(x["id"].alias("id"), x["sim"].alias("sim")))
        blocks = cells.groupBy("key", "block").agg(whole.alias("nodes")).where("size(nodes) > 1").mapInArrow(_nearest(_gathered), schema)
    blocks = checkpointed(blocks)

    met = blocks.select(F.explode("ids").alias("id")).distinct()
    met = checkpointed(nodes.drop("n", "sim").join(met, "id").withColumnsRenamed({"doc_id": "d", "th": "t"}))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).withColumn("th", F.xxhash64(F.coalesce("text", F.lit(""))))
    texts = texts.join(small(met), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t"))).dropDuplicates(["id"])
    sets = checkpointed(shingle_sets(texts, shingle))
    if (sets.agg(F.sum(F.size("shingles"))).first()[0] or 0) <= FEW:
        sets = F.broadcast(sets)

    near = blocks.select(F.inline(F.arrays_zip("ids", "near", "n"))).where("n IS NOT NULL").groupBy("ids").agg(F.max_by("near", F.struct("n", "near")).alias("u"))
    links = checkpointed(_verified(near.select("u", F.col("ids").alias("v")), sets))
    of = components(links)

    several = blocks.where("block > 0").select("key").distinct()
    classes = nodes.select("id", "n", "sim").join(of, F.col("id") == F.col("node"), "left").select("id", F.coalesce("component", "id").alias("class"), "n", "sim")
    classes = checkpointed(classes.join(met.select("id"), "id", "left_semi"))
    if several.isEmpty() and classes.count() <= _common.SMALL:
        shared = docs.sparkSession.sparkContext.broadcast(_arrays(classes, "id"))
        pairs = blocks.select("ids").mapInArrow(_across_known(shared), "u long, v long")
    else:
        cells = blocks.select("key", "block", F.explode("ids").alias("id")).join(classes, "id")
        blocks = cells.groupBy("key", "block").agg(F.collect_list(F.struct("id", "class", "n", "sim")).alias("nodes"), F.min("class").alias("low"), F.max("class").alias("high"))
        pairs = blocks.where("low < high").select("nodes", F.col("nodes").alias("others"))
        a, b = blocks.join(several, "key").alias("a"), blocks.join(several, "key").alias("b")
        differ = "a.key = b.key AND a.block < b.block AND NOT (a.low = b.high AND a.high = b.low)"
        pairs = pairs.unionByName(a.join(b, F.expr(differ)).select("a.nodes", F.col("b.nodes").alias("others"))).mapInArrow(_across, "u long, v long")
    more = checkpointed(_verified(pairs.distinct(), sets))
    return of if more.isEmpty() else components(links.unionByName(more))
