"""Line dedup, mixing and quality rules against plain Python, and odd rows."""

import hashlib
import math
import re

import pytest

from quire.llm import linededup, mixing, quality_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, removed string, size string, hash string, id int, words string, row string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows):
    """rows: (doc_id, text, lang, source); the other columns only clash with names that operators use."""
    return spark.createDataFrame([(i, t, g, s, None if t is None else len(t), "x", "y", "z", 7, "w", "r") for i, t, g, s in rows], SCHEMA)


ABC = "line a\nline b\nline c"
ODD = [
    (1, ABC + "\nown 1", "en", "s1"), (2, "own 2\n" + ABC + "\nline d\nline e", "en", "s1"), (3, ABC, "en", None), (None, ABC + "\nnull id", None, "s2"), (4, None, "en", "s2"),
    (5, "", "de", "s2"), (6, "only\ntwo", "de", None), (7, "r\nr\nr\nr\nr", "de", "s3"), (8, "own 2\n" + ABC, "en", "s3"), (8, "own 2\n" + ABC, "en", "s3"), (8, "other text\n" + ABC, None, "s3"), (9, "x\ny\nz\n", "fr", ""),
]


def plain_dedup(rows):
    """Kept text by (doc_id, text); rows alike are one document, others of a doc_id in an unknown order."""
    seen, out = {}, {}
    for i, t in sorted({(i, t) for i, t, *_ in rows if t is not None}, key=lambda x: (x[0] is None, x[0] or 0)):
        lines = t.split("\n")
        gone = set()
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            if seen.setdefault(w, (i, t, k)) != (i, t, k):
                gone |= {k, k + 1, k + 2}
        out[i, t] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_line_dedup(spark):
    docs = table(spark, ODD)
    got = linededup.dedup(docs).select("row.doc_id", "row.text", "lines", "removed", "text").collect()
    assert len(got) == len(ODD)
    want = plain_dedup(ODD)
    for i, old, n, gone, new in got:
        if old is None:
            assert (n, gone, new) == (0, 0, None)
        else:
            assert new == want[i, old] and n == old.count("\n") + 1 and n - gone == (new.count("\n") + 1 if gone < n else 0)
    clean = linededup.without_repeats(docs)
    assert clean.schema.simpleString() == docs.schema.simpleString()
    report = {r.doc_id: r for r in linededup.report(docs).where("doc_id = 7").collect()}
    assert report[7].n_removed == 5 - 0 or report[7].kept_sha256 == hashlib.sha256(want[7, "r\nr\nr\nr\nr"].encode()).hexdigest()


def test_line_dedup_empty(spark):
    assert linededup.report(table(spark, [])).count() == 0


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        rest = [s for s in order if s not in capped]
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = {s for s in rest if share[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else share[s] for s in order}
        capped |= over


@pytest.mark.parametrize("rows", [ODD, [(i, "w " * (i % 17), "en", f"s{min(i % 40, 9)}" if i % 40 else None) for i in range(800)], [(1, "a b", "en", "s"), (2, "c", "en", "t"), (3, "d " * 90, "en", "u")]])
def test_mixing(spark, rows):
    got = mixing.mix(table(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {}
    sizes, largest = {}, {}
    for i, t, _, s in rows:
        n = len(WORD.findall(t or ""))
        sizes[s] = sizes.get(s, 0) + n
        largest[s] = max(largest.get(s, 0), n)
        by_id.setdefault((i, n), s)
    want = plain_targets(sizes)
    taken = {}
    for r in got:
        s = by_id[r.doc_id, r.size]
        taken[s] = taken.get(s, 0) + r.taken
        if len(rows) > 20:
            assert r.source_size == sizes[s] and math.isclose(r.target, want[s], rel_tol=1e-9)
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    if len(rows) > 20:
        for s, n in taken.items():
            assert want[s] - largest[s] - 1e-6 <= n <= want[s] + 1e-6
    again = mixing.mix(table(spark, rows[::-1])).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_mixing_empty(spark):
    assert mixing.mix(table(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix(table(spark, [(1, None, "en", None)])).collect()] == [0]


def plain_statistics(t):
    t = t or ""
    w = WORD.findall(t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_quality_statistics(spark):
    texts = [None, "", " \n\t", "a b c a b c", "a a a a a", "x y z", "# $ | <é>漢\nab\n\nab\nab", "a b c d a b c e a b", "\x0b".join("pqr"), "one two " * 40]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    got = {r.doc_id: tuple(r)[2:7] for r in quality_rules.statistics(table(spark, rows)).collect()}
    assert got == {i: plain_statistics(t) for i, t in enumerate(texts)}


def test_quality_rules_guard_good_texts(spark):
    good = [(i, " ".join(f"word{(i * 7 + k) % 911}" for k in range(60)), "en", "s") for i in range(900)]
    bad = [(1000 + i, " ".join(f"$$w{(i * 5 + k) % 701}%%" for k in range(60)), "en", "s") for i in range(50)]
    few = [(2000 + i, " ".join(f"$$m{(i * 3 + k) % 509}%%" for k in range(60)), "de", "s") for i in range(5)]
    labels = spark.createDataFrame([(i, 1, 0) for i, *_ in good] + [(i, 0, 0) for i, *_ in bad] + [(None, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in quality_rules.judge(table(spark, good + bad + few), labels).collect()}
    assert all(got[i] for i, *_ in good) and not any(got[i] for i, *_ in bad)
    assert all(got[i] for i, *_ in few)  # nothing is proved without labels of their language


def test_binomial_tail(spark):
    found = spark.createDataFrame([(500, 3), (2000, 20), (50, 40)], "n long, k long").selectExpr("n", "k", quality_rules._TAIL.format(risk="0.0125D") + " AS p").collect()
    for n, k, p in found:
        want = 1.0 if k > n * 0.0125 else sum(math.comb(n, i) * 0.0125**i * 0.9875 ** (n - i) for i in range(k + 1))
        assert p == pytest.approx(want, rel=1e-9)


def test_quality_rules_empty(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules.judge(table(spark, []), labels).count() == 0
    assert quality_rules.judge(table(spark, ODD), labels).count() == len(ODD)
