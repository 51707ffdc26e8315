"""The pipeline's near copies against brute force over the same shingles."""

import numpy as np
import pyarrow as pa
import pytest

from quire.llm import _common, simhash, simwide

SCHEMA = "doc_id long, text string, source string, _n int, component_id string"


def plain_shingles(text, size=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def plain_first(rows):
    sets = {i: plain_shingles(t) for i, t in rows}
    low = {i: i for i in sets}

    def top(i):
        while low[i] != i:
            i = low[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and (sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])):
                x, y = sorted((top(a), top(b)))
                low[y] = x
    return sorted({top(i) for i in sets})


def edited(words, rng, n):
    words = list(words)
    for i in rng.integers(0, len(words), n):
        words[i] = f"new{rng.integers(1 << 30)}"
    return words


@pytest.mark.parametrize("block, small", [(1024, 200_000), (8, 0)])
def test_near_copies_against_brute_force(spark, monkeypatch, block, small):
    monkeypatch.setattr(_common, "SMALL", small)
    monkeypatch.setattr(simwide, "BLOCK", block)
    monkeypatch.setattr(simwide, "LEADERS", block // 4)
    rng = np.random.default_rng(5)
    texts = []
    for g in range(12):
        base = [f"g{g}w{i}" for i in range(int(rng.integers(60, 300)))]
        texts += [base] + [edited(base, rng, int(len(base) * rng.uniform(0, 0.06))) for _ in range(25 if g else 60)]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)] + [(9000, None), (9001, ""), (9002, "a B"), (9003, "A b")]
    rng.shuffle(rows)
    rows = [(int(i), t) for i, t in rows]
    kept = simhash.keep_first(spark.createDataFrame([(i, t, "s", 1, "c") for i, t in rows], SCHEMA))
    assert sorted(r.doc_id for r in kept.collect()) == plain_first(rows)


def test_recall_of_links_between_different_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sets = {}
    for r in docs.collect():
        if shingles := plain_shingles(r.text):
            sets.setdefault(frozenset(shingles), r.doc_id)
    sets, by_shingle = {i: s for s, i in sets.items()}, {}
    for i, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    pairs = {(a, b) for ids in by_shingle.values() for a in ids for b in ids if a < b}
    alike = [(a, b) for a, b in pairs if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    kept = {r.doc_id for r in simhash.keep_first(docs).collect()}
    assert len(alike) >= 5 and sum(b not in kept for a, b in alike) >= 0.9 * len(alike)
    assert set(sets) - kept <= {b for _, b in alike}  # nothing else goes


@pytest.mark.parametrize("block, step", [(4, 5), (4, 100), (64, 3), (1000, 1000)])
def test_streamed_blocks_hold_each_list_once(monkeypatch, block, step):
    monkeypatch.setattr(simwide, "BLOCK", block)
    monkeypatch.setattr(simwide, "LEADERS", 2)
    sizes = np.arange(40) % 7 * 3 % 11 + 1
    sizes[20] = 50
    key = np.repeat(np.arange(40), sizes)
    ids = np.arange(len(key))
    postings = np.sort(np.append(key << 32 | ids, [41 << 32 | 1 << 31] * 2))  # two nodes with the same half
    words = np.full(len(postings), 5)
    words[key.searchsorted(30) : key.searchsorted(31)] = np.arange(sizes[30]) % 2 * -1  # two sides far apart
    batches = [pa.RecordBatch.from_arrays([pa.array(x[i : i + step]) for x in (postings, words)], ["posting", "word"]) for i in range(0, len(postings), step)]
    rows = [r for b in simwide._blocks(iter(batches)) for r in b.to_pylist()]
    for k in range(42):
        own = ids[key == k].tolist() + [1 << 31] * 2 * (k == 41)
        found = [r["ids"] for r in sorted((r for r in rows if r["key"] == k), key=lambda r: r["block"])]
        if len(own) < 2:
            assert found == []
        elif len(own) <= block:
            assert found == [own]
        else:
            assert found == [own[: min(lo, 2)] + own[lo : lo + block] for lo in range(0, len(own), block)]


def test_partners_in_different_blocks_of_a_list_meet(monkeypatch):
    """Two alike nodes are the only such pair of a list, each among unlike nodes in a block of its own."""
    monkeypatch.setattr(simwide, "BLOCK", 8)
    monkeypatch.setattr(simwide, "LEADERS", 2)
    f = np.random.default_rng(7).integers(0, 256, (30, simwide.POSITIONS)).astype(np.uint8)
    f[21] = f[12]
    f[21, :40] ^= 1
    ids = np.arange(30)
    posting = pa.RecordBatch.from_arrays([pa.array(7 << 32 | ids), pa.array(np.full(30, 5))], ["posting", "word"])

    class Shared:
        value = ids, ids, f

    blocks = pa.Table.from_batches(simwide._nearest(simwide._looked_up(Shared))(simwide._blocks(iter([posting])))).to_pylist()
    assert sorted({i for b in blocks for i in b["ids"]}) == ids.tolist() and not any(b["block"] == 0 for b in blocks)
    sides = [(i := np.array(b["ids"]), i, np.full(len(i), 50), f[i]) for b in blocks]
    pairs = {tuple(sorted(p)) for x, a in enumerate(sides) for b in sides[x + 1 :] for p in simwide._apart(a, b).T.tolist()}
    assert pairs == {(12, 21)}


def test_lists_lose_those_that_are_far_from_all_others():
    word = np.array([0, 1, -1, -2, 0xFFFFFFFF, 7], np.int64).view(np.uint64)
    assert simwide._meeting(np.array([0, 5]), np.array([5, 1]), word).tolist() == [True, True, True, True, False, False]


def test_similarity_of_exactly_four_fifths(spark):
    w = [f"w{i}" for i in range(13)]  # 9 shingles; 8 of them are in all 10
    cases = [(1, w), (2, [*w[1:], "x"]), (3, [f"v{i}" for i in range(12)]), (4, [f"v{i}" for i in range(14)])]  # 8 of 10, 8 of 10
    kept = simhash.keep_first(spark.createDataFrame([(i, " ".join(x), "s", 1, "c") for i, x in cases], SCHEMA))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_short_texts_and_sizes_are_no_reason_to_lose_a_pair():
    """Of pairs of just 0.8 the bits let nearly all through, and all of few shingles; sizes alone never lose one."""
    rng = np.random.default_rng(3)
    lost = met = 0
    for a, b, shared in [(4, 5, 4), (8, 10, 8), (9, 9, 8), (12, 15, 12), (36, 45, 36), (90, 90, 80), (200, 250, 200)] * 30:
        every = rng.integers(0, 1 << 63, a + b - shared).astype(np.uint64)
        h, ptr = np.concatenate([every[:a], every[a - shared :]]), np.array([0, a, a + b])
        _, found, _ = simwide.chunk_fingerprints(h, ptr)
        sides = [(np.array([i]), np.array([i]), np.array([n], np.int32), found[i : i + 1]) for i, n in enumerate((a, b))]
        near = (found[0] == found[1]).sum() >= simwide.LEAST
        pairs = simwide._apart(*sides).shape[1]
        met += near
        lost += near - pairs
        assert pairs == near or min(a, b) >= simwide.SOME
    assert met >= 180 and lost <= 0.02 * met
    one, two = sides
    assert simwide._apart(one, (*two[:2], np.array([251], np.int32), two[3])).shape[1] == 0  # 200 of 251
