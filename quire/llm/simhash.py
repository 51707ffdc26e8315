"""SimHash near-duplicates through an inverted index of byte positions with count filtering.

A fingerprint is eight bytes. Two that differ in at most three bits differ in at most three bytes, so
they share at least five positional bytes. Five of eight positions hold three of one half, hence the
index has a posting for each of the eight (half, three of its four positions) with the bytes there; a
single byte's list would hold 1/256 of all fingerprints. Within a list the shared positional bytes of a
pair are tallied, pairs with five or more are kept, and those are verified by their differing bits.
Equal fingerprints meet beforehand, so a list holds different ones only. Lists of more than HOT
fingerprints are replaced by the lists of five positions that contain theirs, which by the same count
lose no pair and hold 2 ** 24 fingerprints at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _text, simwide
from ._common import checkpointed, components, partitions, small

SHINGLE = 5
MOST_BITS = 3
LEAST_BYTES = 8 - MOST_BITS
#: A list longer than this is dealt to lists of five positions.
HOT = 512
#: Pairs are formed in numpy up to lists of this length; longer ones are compared in blocks.
SHORT = 64

_U = np.uint64
#: For each byte, its bits in eight lanes of eight bits.
_LANES = sum(((np.arange(256, dtype=_U) >> _U(k)) & _U(1)) << _U(8 * k) for k in range(8))
TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]
FIVES = {t: [s for s in combinations(range(8), 5) if next(x for x in TRIPLES if set(x) <= set(s)) == t] for t in TRIPLES}


def majority(h: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """For each document the 64 bits that are set in over half of its hashes."""
    out = np.zeros(len(ptr) - 1, _U)
    full = np.flatnonzero(np.diff(ptr))
    if not len(full):
        return out
    starts, n = ptr[:-1][full], np.diff(ptr)[full]
    pieces = -(-n // 255)  # a lane counts to 255
    first = np.cumsum(pieces) - pieces
    cuts = np.repeat(starts, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(first, pieces))
    by_byte = h.view(np.uint8).reshape(-1, 8)
    tally = np.empty((len(full), 64), np.int64)
    for j in range(8):
        lanes = np.add.reduceat(_LANES[by_byte[:, j]], cuts)
        tally[:, 8 * j : 8 * j + 8] = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
    out[full] = np.packbits(2 * tally > n[:, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def chunk_fingerprints(data: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    text, w = _text.single_spaced(_text.LOWER[data], offsets)
    n = np.diff(w.ptr)
    take = np.where(n >= size, n - size + 1, np.minimum(n, 1))  # fewer words: the whole sequence
    ptr = np.concatenate([[0], np.cumsum(take)])
    first = np.repeat(w.ptr[:-1] - ptr[:-1], take) + np.arange(ptr[-1])
    last = first + np.repeat(np.minimum(n, size), take) - 1
    return majority(_text.xxh64(text, w.starts[first], w.ends[last]), ptr)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp, th) for each row; null or wordless texts have fingerprint 0. One pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [chunk_fingerprints(c.data, c.offsets, shingle) for c in _text.chunks(b.column(1))]
            if fp:
                yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(np.concatenate(fp).view(np.int64)), b.column(2)], ["doc_id", "fp", "th"])

    found = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string").alias("text"))
    return found.withColumn("th", F.xxhash64(F.coalesce("text", F.lit("")))).mapInArrow(run, "doc_id long, fp long, th long")


def _mask(positions: tuple[int, ...]) -> int:
    """The fingerprint's bytes at these positions, as a signed long."""
    m = sum(255 << 8 * p for p in positions)
    return m - (1 << 64) if m >> 63 else m


def _kinds(positions: list[tuple[int, ...]], first: int) -> str:
    """SQL array of the lists' kinds and masks."""
    return "array(" + ", ".join(f"struct({first + i} AS kind, {_mask(p)}L AS mask)" for i, p in enumerate(positions)) + ")"


def _changes(kind: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where a list begins, in entries sorted by list."""
    return np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (kind[1:] != kind[:-1])]))


def _linked(cuts: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of entries in one list that the tally and the verification keep; cuts: where lists begin."""
    a, b = [], []

    def keep(i: np.ndarray, j: np.ndarray) -> None:
        x = fp[i] ^ fp[j]
        tally = np.zeros(len(x), np.int8)
        for p in range(8):
            tally += (x >> _U(8 * p)) & _U(255) == 0
        on = tally >= LEAST_BYTES
        on[on] = np.bitwise_count(x[on]) <= MOST_BITS
        a.append(i[on])
        b.append(j[on])

    size = np.diff(np.concatenate([cuts, [len(fp)]]))
    place = np.arange(len(fp)) - np.repeat(cuts, size)
    left = np.repeat(size, size) - place  # entries from here to the list's end
    left[np.repeat(size, size) > SHORT] = 0
    at, d = np.flatnonzero(left > 1), 1
    while len(at):
        keep(at, at + d)
        d += 1
        at = at[left[at] > d]
    for lo, n in zip(cuts[size > SHORT], size[size > SHORT], strict=True):
        step = max(1, (1 << 20) // n)
        for i in range(lo, lo + n, step):
            rows = np.arange(i, min(i + step, lo + n))
            x = fp[rows][:, None] ^ fp[i : lo + n][None, :]
            r, c = np.nonzero(np.bitwise_count(x) <= MOST_BITS)
            keep(*(v[r < c] for v in (rows[r], i + c)))
            if len(a) > 1 and sum(map(len, a)) > 4 * len(fp):
                a[:], b[:] = ([v] for v in _forest(len(fp), np.concatenate(a), np.concatenate(b)))
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, int), np.zeros(0, int))


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few pairs as connect what the pairs connect."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            on = np.flatnonzero(label != np.arange(n))
            return on, label[on]
        label = new


def links(nodes: DataFrame) -> DataFrame:
    """(u, v): pairs of ids that connect all (id, fp) whose fingerprints link. fp are different."""
    n = partitions(nodes.sparkSession)
    code, finer = len(TRIPLES), []
    for t in TRIPLES:
        finer.append(_kinds(FIVES[t], code))
        code += len(FIVES[t])
    posting = lambda kinds: f"inline({kinds}) AS (kind, mask)"
    key = F.expr("fp & mask").alias("key")
    lists = nodes.selectExpr("id", "fp", posting(_kinds(TRIPLES, 0))).select("kind", key, "id", "fp")
    hot = lists.groupBy("kind", "key").count().where(F.col("count") > HOT).select("kind", "key", F.lit(True).alias("hot"))
    lists = checkpointed(lists.join(hot, ["kind", "key"], "left"))
    dealt = lists.where("hot").selectExpr("id", "fp", posting(f"element_at(array({', '.join(finer)}), kind + 1)"))
    lists = lists.where("hot IS NULL").select("kind", "key", "id", "fp").unionByName(dealt.select("kind", key, "id", "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def emit() -> Iterator[pa.RecordBatch]:
            kind, key, ids, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            a, b = _linked(_changes(kind, key), fp.view(_U))
            if len(a):
                a, b = _forest(len(fp), a, b)
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], ["u", "v"])

        for batch in batches:
            rows = [c.to_numpy() for c in batch.columns]
            if not len(rows[0]):
                continue
            if held and (rows[0][0] != held[-1][0][-1] or rows[1][0] != held[-1][1][-1]):
                yield from emit()
                held = []
            if cut := int(_changes(rows[0], rows[1])[-1]):  # the last list may go on in the next batch
                held.append([x[:cut] for x in rows])
                yield from emit()
                held = []
            held.append([x[cut:] for x in rows])
        if held:
            yield from emit()

    return lists.repartition(n, "kind", "key").sortWithinPartitions("kind", "key").mapInArrow(run, "u long, v long")


def classes(docs: DataFrame, shingle: int, text: str, doc_id: str) -> tuple[DataFrame, DataFrame]:
    """Of each row (doc_id, fp, th), th a hash of its text; of each fp its class, the least fp reached."""
    known = checkpointed(fingerprints(docs, shingle, text, doc_id))
    nodes = checkpointed(known.groupBy(F.col("fp").alias("id")).count().select("id", F.col("id").alias("fp")))
    found = components(links(nodes))
    return known, nodes.join(found, nodes.id == found.node, "left").select("fp", F.coalesce("component", "fp").alias("class"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of docs.

    Rows link if their fingerprints differ in three bits at most; component_id is the smallest doc_id
    that can be reached. Null and empty texts have fingerprint zero and link like any other. Repeated
    rows and doc_ids stay. A null doc_id links, but never is a component_id; where a component has no
    other, its component_id is null. Columns of docs other than the two named are not read.
    """
    known, of = classes(docs, shingle, text, doc_id)
    of = checkpointed(of)
    least = known.groupBy("fp").agg(F.min("doc_id").alias("id")).join(of, "fp").groupBy("class").agg(F.min("id").alias("component_id"))
    of = of.join(least, "class").select("fp", "component_id")
    return known.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of docs for each component, with all its columns: that of its smallest doc_id, or a row
    without doc_id where it has no other. Of rows that share this doc_id the one with the smallest text
    hash stays. Rows link if the Jaccard similarity of their shingles is at least 0.8, as three of 64 bits
    would reach near-identical texts only; null and wordless texts link with each other.
    """
    known = checkpointed(simwide.nodes_of(docs, shingle))
    found = simwide.linked(docs, known, shingle)
    of = known.select("fp").distinct().join(found, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("component", "fp").alias("class"))
    copies = known.groupBy("doc_id", "th", "fp").agg(F.count("*").alias("n")).join(of, "fp")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    first = copies.groupBy("class").agg(F.min(order).alias("first"))
    judged = checkpointed(copies.join(first, "class").select(F.col("doc_id").alias("id"), F.col("th").alias("hash"), "n", (order > F.col("first")).alias("goes")))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("own"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("id")) & (F.col("own") == F.col("hash"))
    told = checkpointed(judged.where("goes OR n > 1").select("id", "hash", "goes"))  # the other rows stay as they are
    rows = rows.join(small(told), same, "left").where("goes IS NULL OR NOT goes")
    if told.where("NOT goes").isEmpty():
        return rows.select("row.*")
    rank = F.row_number().over(Window.partitionBy("id", "hash").orderBy("id"))
    several = rows.where("goes IS NOT NULL").withColumn("rank", rank).where("rank = 1")
    return rows.where("goes IS NULL").select("row.*").unionByName(several.select("row.*"))
