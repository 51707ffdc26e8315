"""Vectorised scanning of Arrow text columns with numpy.

A chunk is a run of whole documents, taken straight from the Arrow buffers: one byte array and
the documents' offsets in it. Words are maximal runs of bytes other than space and \\t..\\r, which is
the contract's `[^\\x20\\x09-\\x0D]+` on UTF-8. No step loops over words or documents in Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that are scanned at once; one longer document makes a chunk of its own.
CHUNK = 1 << 19

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_RADIX = 0x9E3779B97F4A7C15 | 1
_powers: dict[int, np.ndarray] = {}


class Chunk(NamedTuple):
    """rows: slice of the batch; data: bytes; offsets: of each document in data, with the end."""

    rows: slice
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """starts, ends: byte positions; ptr: index of each document's first word, with the end."""

    starts: np.ndarray
    ends: np.ndarray
    ptr: np.ndarray


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[Chunk]:
    """Runs of rows of a text column; null counts as empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield Chunk(slice(at, to), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of each document; a document's border also ends a word."""
    inside = ~SEPARATOR[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = inside[heads]
    tails = offsets[1:][offsets[1:] > 0] - 1
    last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets))


def kept(docs: DataFrame, judge: Callable[[Chunk], np.ndarray]) -> DataFrame:
    """The rows of docs for whose text judge holds, with all their columns. One pass; a row goes through as a
    struct, so that columns may have any name."""
    at = docs.columns.index("text")
    rows = docs.select(F.struct("*").alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(b.column(0).field(at)):
                yield b.slice(c.rows.start, len(c.offsets) - 1).filter(pa.array(judge(c)))

    return rows.mapInArrow(run, rows.schema).select("row.*")


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit (a public 64-bit mixing function)."""
    h = h ^ (h >> _U(30))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK), base, _U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= CHUNK * 4:  # one very long text doesn't keep its table
            _powers[base] = have
    return have[:n]


def word_hashes(data: np.ndarray, w: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, from prefix sums of a polynomial."""
    n = len(data)
    sums = np.zeros(n + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * powers(_RADIX, n), out=sums[1:])
    inverse = powers(pow(_RADIX, -1, 1 << 64), n)
    return mix((sums[w.ends] - sums[w.starts]) * inverse[w.starts])


def gram_hashes(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of each n consecutive entries of h; entry i covers h[i : i + n]. Shorter by n - 1."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, _U)
    out = np.full(m, 0x2545F4914F6CDD1D + seed, _U)
    for k in range(n):
        out = out * _U(0x9FB21C651E98DF25) + h[k : k + m]
        out ^= out >> _U(32)
    return mix(out)


def owners(ptr: np.ndarray) -> np.ndarray:
    """For each entry, the document it is of."""
    return np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """An Arrow string column over bytes that are UTF-8."""
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))


def rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << _U(r)) | (x >> _U(64 - r))


#: Fixed values of the XXH64 specification.
P1, P2, P3, P4, P5 = (_U(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of data[start:end] for each pair. Up to 31 bytes in numpy, longer ones by the library."""
    import xxhash

    n = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    at8 = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    at4 = np.ndarray((len(data) + 1,), "<u4", padded, strides=(1,))
    acc = _U(seed) + P5 + n.astype(_U)
    pos = starts.copy()
    for lane in range(3):
        on = np.flatnonzero(n >= 8 * (lane + 1))
        k = rotl(at8[pos[on]] * P2, 31) * P1
        acc[on] = rotl(acc[on] ^ k, 27) * P1 + P4
        pos[on] += 8
    on = np.flatnonzero(n & 4)
    acc[on] = rotl(acc[on] ^ (at4[pos[on]].astype(_U) * P1), 23) * P2 + P3
    pos[on] += 4
    for byte in range(3):
        on = np.flatnonzero((n & 3) > byte)
        acc[on] = rotl(acc[on] ^ (padded[pos[on]].astype(_U) * P5), 11) * P1
        pos[on] += 1
    acc = (acc ^ (acc >> _U(33))) * P2
    acc = (acc ^ (acc >> _U(29))) * P3
    acc ^= acc >> _U(32)
    if len(long := np.flatnonzero(n >= 32)):
        raw = data.tobytes()
        acc[long] = [xxhash.xxh64_intdigest(raw[a:b], seed) for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
    return acc


def single_spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, Words]:
    """The words of each document, joined by one space, with the words' places in that."""
    w = words(data, offsets)
    n = w.ends - w.starts
    gap = np.ones(len(n), np.int64)
    gap[w.ptr[1:][w.ptr[1:] > w.ptr[:-1]] - 1] = 0
    starts = np.zeros(len(n), np.int64)
    np.cumsum((n + gap)[:-1], out=starts[1:])
    inside = ~SEPARATOR[data]
    keep = inside.copy()
    keep[w.ends[gap == 1]] = True
    out = np.where(inside, data, np.uint8(32))[keep]
    return out, Words(starts, starts + n, w.ptr)
