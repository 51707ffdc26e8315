"""The numpy scanner against plain Python."""

import re

import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import _text, simhash

TEXTS = st.lists(st.text(alphabet=" \n\t\x0b\xa0aBé漢z-", max_size=80), min_size=1, max_size=8)


def plain_words(t):
    return re.findall(_text.WORD, t)


def chunk(texts):
    (c,) = _text.chunks(pa.array(texts))
    return c


@settings(deadline=None, max_examples=60)
@given(TEXTS)
def test_words(texts):
    c = chunk(texts)
    w = _text.words(c.data, c.offsets)
    raw = c.data.tobytes()
    for i, t in enumerate(texts):
        assert [raw[a:b].decode() for a, b in zip(w.starts[w.ptr[i] : w.ptr[i + 1]], w.ends[w.ptr[i] : w.ptr[i + 1]])] == plain_words(t)


@settings(deadline=None, max_examples=60)
@given(TEXTS)
def test_single_spaced(texts):
    c = chunk(texts)
    data, w = _text.single_spaced(c.data, c.offsets)
    assert data.tobytes().decode() == "".join(" ".join(plain_words(t)) for t in texts)
    flat = [x for t in texts for x in plain_words(t)]
    assert [data.tobytes()[a:b].decode() for a, b in zip(w.starts, w.ends)] == flat


@settings(deadline=None, max_examples=60)
@given(TEXTS)
def test_word_hashes_follow_the_words(texts):
    c = chunk(texts)
    h = _text.word_hashes(c.data, _text.words(c.data, c.offsets)).tolist()
    flat = [x for t in texts for x in plain_words(t)]
    assert len(set(zip(h, flat))) == len(set(flat)) == len(set(h))


def test_xxh64_of_every_length():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = np.arange(0, 100).repeat(2) * 7
    ends = starts + np.arange(200) % 70
    got = _text.xxh64(data, starts, ends)
    assert got.tolist() == [xxhash.xxh64_intdigest(data[a:b].tobytes(), 42) for a, b in zip(starts, ends)]


def plain_fingerprint(t, size=3):
    w = plain_words("".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in t or ""))
    if not w:
        return 0
    grams = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@settings(deadline=None, max_examples=60)
@given(TEXTS)
def test_fingerprints(texts):
    c = chunk(texts)
    assert simhash.chunk_fingerprints(c.data, c.offsets, 3).tolist() == [plain_fingerprint(t) for t in texts]


def test_fingerprint_of_a_long_text():
    t = " ".join(f"w{i * i % 977}" for i in range(3000))
    c = chunk(["", t, "a"])
    assert simhash.chunk_fingerprints(c.data, c.offsets, 3).tolist() == [0, plain_fingerprint(t), plain_fingerprint("a")]
