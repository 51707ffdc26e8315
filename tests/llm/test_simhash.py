"""SimHash links and components against brute force."""

import numpy as np
import pytest
from pyspark.sql import types as T

from quire.llm import simhash
from quire.llm._common import components

from .test_text import plain_fingerprint

SCHEMA = "doc_id long, text string, source string, _n int, component_id string"


def plain_components(fps):
    ids = sorted(fps)
    low = {i: i for i in ids}

    def top(i):
        while low[i] != i:
            i = low[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and bin(fps[a] ^ fps[b]).count("1") <= 3:
                x, y = sorted((top(a), top(b)))
                low[y] = x
    return {i: top(i) for i in ids}


def test_five_of_eight_positions_hold_a_posting():
    for x in range(1 << 8):
        same = {p for p in range(8) if x >> p & 1}
        if len(same) >= 5:
            assert any(set(t) <= same for t in simhash.TRIPLES)
    assert sum(map(len, simhash.FIVES.values())) == 56


@pytest.mark.parametrize("hot", [512, 3])
def test_links_of_clustered_fingerprints(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    monkeypatch.setattr(simhash, "SHORT", 8)
    rng = np.random.default_rng(3)
    fps = {}
    for centre in rng.integers(0, 1 << 63, 12):
        for _ in range(25):
            x = int(centre)
            for b in rng.integers(0, 64, rng.integers(0, 6)):
                x ^= 1 << int(b)
            fps[len(fps)] = x
    fps = {i: x for i, x in fps.items() if x not in [fps[j] for j in range(i)]}
    signed = [(i, x - (1 << 64) if x >> 63 else x) for i, x in fps.items()]
    found = components(simhash.links(spark.createDataFrame(signed, "id long, fp long")))
    got = {i: i for i in fps} | {r.node: r.component for r in found.collect()}
    assert got == plain_components(fps)


def test_odd_rows(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta"
    rows = [(3, text), (1, text), (1, text), (2, None), (5, ""), (7, " \n"), (9, "one Word"), (None, "x y z q"), (None, text), (4, "one word")]
    docs = spark.createDataFrame([(i, t, "s", 1, "c") for i, t in rows], SCHEMA)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs, 3).collect()), key=str)
    want = []
    first = {}
    for i, t in rows:
        f = plain_fingerprint(t)
        first.setdefault(f, []).append(i)
    for i, t in rows:
        f = plain_fingerprint(t)
        want.append((i, f"{f:016x}", min((x for x in first[f] if x is not None), default=None)))
    assert got == sorted(want, key=str)
    kept = simhash.keep_first(docs, 3)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 4, None], key=str)


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA), 3).count() == 0


def test_components_of_a_chain(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(5, 3), (3, 5), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {3: 3, 5: 3}
    assert isinstance(components(spark.createDataFrame([], "u long, v long")).schema, T.StructType)
