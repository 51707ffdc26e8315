"""Substring dedup, decontamination and language-model scores against brute force, and odd rows."""

import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from quire.llm import decontam, lmscore, substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, did string, th string, places int, source string"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "x", "y", 1, "s") for i, t in rows], SCHEMA).repartition(parts)


def corpus(seed, vocabulary=30, n=60):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    passage = [word() for _ in range(70)]
    rows = []
    for i in range(n):
        w = [word() for _ in range(rng.choice([0, 3, 19, 20, 40, 150]))]
        if rng.random() < 0.5:
            a = rng.randrange(30)
            w[len(w) // 2 : len(w) // 2] = passage[a : a + rng.choice([18, 25, 40])]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    rows += [(n + k, rows[k * 3][1]) for k in range(8)]  # exact copies
    rows += [(n + 20, "r " * 90), (n + 21, None), (n + 22, ""), (None, " ".join(passage)), (5, rows[5][1])]
    return rows


def plain_substring(rows, length):
    seen, out = set(), {}
    for i, t in sorted({(i, t or "") for i, t in rows}, key=lambda x: (x[0] is None, x[0] or 0)):
        w = WORD.findall(t)
        gone = set()
        own = [tuple(w[k : k + length]) for k in range(len(w) - length + 1)]
        for k, g in enumerate(own):
            if g in seen:
                gone |= set(range(k, k + length))
            seen.add(g)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i, t] = len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept
    return out


@pytest.mark.parametrize("seed, length, seeds, hot", [(1, 20, 6, 20_000), (2, 20, 6, 2), (3, 8, 3, 20_000), (3, 8, 3, 3), (3, 8, 3, 1)])
def test_substring_dedup(spark, seed, length, seeds, hot):
    rows = corpus(seed, vocabulary=4 if seed == 3 else 30)
    want = plain_substring(rows, length)
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.text) for r in substring.dedup(table(spark, rows), length, seeds, hot).collect())
    assert got == Counter((i, *want[i, t or ""]) for i, t in rows)


def test_carried_windows_over_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        rows = corpus(4)[:40]
        want = plain_substring(rows, 20)
        for hot in (20_000, 3):
            got = {(r.doc_id, r.kept_sha256) for r in substring.dedup(table(spark, rows), hot=hot).collect()}
            assert got == {(i, want[i, t or ""][2]) for i, t in rows}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_substring_empty(spark):
    assert substring.dedup(table(spark, [])).count() == 0


def plain_edits(item, text, most):
    """Fewest edits of item against any part of text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def fold(t):
    return "".join(" " if c in "\t\n\x0b\x0c\r" else c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in t)


def edited(rng, t, n):
    t = list(t)
    for _ in range(n):
        k = rng.randrange(len(t))
        what = rng.randrange(3)
        t[k : k + (what != 0)] = [] if what == 1 else [rng.choice("qzé")]
    return "".join(t)


def test_decontamination_loses_nothing(spark):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdéf ghi") for _ in range(n))
    items = [(k, text(rng.choice([60, 120, 250]))) for k in range(8)] + [(50, "short"), (51, ""), (52, None), (53, None)]
    rows = []
    for i in range(60):
        t = text(rng.choice([0, 5, 200, 900]))
        if i % 2:
            k = rng.randrange(8)
            most = decontam.budget(len(items[k][1]))
            at = rng.randrange(len(t) + 1)
            t = t[:at] + edited(rng, items[k][1].upper() if i % 4 == 1 else items[k][1], rng.choice([0, 1, most // 2, most, most + 3])) + t[at:]
        rows.append((i, t))
    rows += [(60, None), (None, items[0][1]), (61, items[1][1]), (61, items[1][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((r.doc_id, r.item_id, r.edits) for r in decontam.contained(table(spark, rows), benchmark).collect())
    want = Counter()
    for i, t in rows:
        for k, x in items[:8]:
            e = plain_edits(fold(x), fold(t or ""), 99)
            if e <= decontam.budget(len(x)):
                want[i, k, e] += 1
    assert got == want
    kept = decontam.clean(table(spark, rows), benchmark)
    assert kept.columns == SCHEMA.replace(",", "").split()[::2]
    dirty = {(i, t) for i, t in rows if any(key[0] == i for key in want)}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((i for i, t in rows if (i, t) not in dirty), key=str)


def test_decontamination_of_one_repeated_character():
    """Each of 3,991 places meets 291 places of each item."""
    items = ["a" * 300] * 9 + ["a" * 150 + "b" * 10 + "a" * 140]
    index = decontam.Index(list(range(10)), items)
    data = np.frombuffer(b"a" * 4000, np.uint8)
    tracemalloc.start()
    got = list(index.search(data, np.array([0, 4000])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(d, i, e) for d, i, e, *_ in got] == [(0, i, 0) for i in range(9)] + [(0, 9, plain_edits(items[9], "a" * 400, 99))]
    assert peak < 300 << 20


def test_decontamination_at_the_end_of_a_long_text():
    rng = random.Random(9)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    item, body = words(60), words(60_000)
    index = decontam.Index([5, 6], [item, words(50)])
    text = f"{body} {item[:100]}x{item[101:]}".encode()
    (hit,) = index.search(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert hit[:3] == (0, 0, 1) and hit[3] >= len(body)


@pytest.mark.parametrize("pairs", [1 << 20, 50])
def test_pairs_are_tallied_in_parts(monkeypatch, pairs):
    monkeypatch.setattr(decontam, "PAIRS", pairs)
    rng = random.Random(3)
    items = ["".join(rng.choice("ab ") for _ in range(n)) for n in (40, 90, 200)]
    texts = ["".join(rng.choice("ab ") for _ in range(n)) + edited(rng, items[i % 3], i % 4) for i, n in enumerate((0, 30, 120, 7, 60, 15))]
    data, offsets = "".join(texts).encode(), np.cumsum([0, *(len(t.encode()) for t in texts)])
    got = {(d, i): e for d, i, e, *_ in decontam.Index([0, 1, 2], items).search(np.frombuffer(data, np.uint8), offsets)}
    found = {(d, i): plain_edits(x, t, 99) for d, t in enumerate(texts) for i, x in enumerate(items)}
    assert got == {k: e for k, e in found.items() if e <= decontam.budget(len(items[k[1]]))}


def test_decontamination_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK", 100)
    benchmark = spark.createDataFrame([(k, f"item number {k} " * 5) for k in range(6)], "item_id long, text string")
    rows = table(spark, [(k, f"before {'item number %d ' % k * 5} after") for k in range(6)])
    assert {(r.doc_id, r.item_id) for r in decontam.contained(rows, benchmark).where("edits = 0").collect()} == {(k, k) for k in range(6)}
    assert decontam.contained(rows, benchmark.where("item_id < 0")).count() == 0
    assert decontam.clean(rows, benchmark.where("item_id < 0")).count() == 6


def plain_scores(rows):
    words = [[w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in WORD.findall(t or "")] for _, t in rows]
    pairs = [list(zip([""] + w[:-1], w)) for w in words]
    two, one, begins = Counter(p for x in pairs for p in x), Counter(w for x in words for w in x), Counter(a for x in pairs for a, _ in x)
    n = sum(one.values())
    return [np.mean([math.log(two[a, b] / begins[a]) if two[a, b] >= 2 else math.log(0.4 * one[b] / n) for a, b in x]) if x else None for x in pairs]


@pytest.mark.parametrize("top, pairs, head", [(65_534, 2_000_000, 512), (65_534, 2_000_000, 2), (50, 100, 50), (3, 200, 0), (0, 50, 512)])
def test_language_model_scores(spark, monkeypatch, top, pairs, head):
    monkeypatch.setattr(lmscore, "HEAD", head)
    monkeypatch.setattr(lmscore, "TOP", top)
    monkeypatch.setattr(lmscore, "PAIRS", pairs)
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["The", "the", "of", f"w{rng.randrange(200)}"]) for _ in range(rng.choice([0, 1, 5, 80])))) for i in range(80)]
    rows += [(200, None), (None, "the w1 of"), (None, "other one"), (7, rows[7][1])]
    got = sorted(((r.doc_id, r.n_words, None if r.log_score is None else round(r.log_score, 9)) for r in lmscore.score(table(spark, rows)).collect()), key=str)
    want = [(i, len(WORD.findall(t or "")), None if s is None else round(float(s), 9)) for (i, t), s in zip(rows, plain_scores(rows))]
    assert [x[:2] for x in got] == [x[:2] for x in sorted(want, key=str)]
    for a, b in zip(got, sorted(want, key=str)):
        assert a[2] == pytest.approx(b[2], abs=1e-8)


def test_language_model_empty(spark):
    assert lmscore.score(table(spark, [])).count() == 0
