"""Held-out accuracy of the classifiers, odd rows, and that predictions use text alone."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import _linear, langid, nbsvm, queries, toxicity
from quire.llm._common import crc_rest

DATA = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, label string, score double, quality int, id long"
ODD = [(1, None), (2, ""), (3, " \n\t 12 34 !!"), (None, "the thing"), (4, "x" * 300_000), (5, "é"), (5, "é"), (6, "漢字 漢字")]


def odd(spark, rows=ODD):
    return spark.createDataFrame([(i, t, "en", "s", "l", 0.0, 1, 9) for i, t in rows], SCHEMA)


def test_language_id(spark):
    found = queries.op1_language_id(spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97


def test_language_id_of_odd_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(200)
    model = langid.train(docs, crc_rest(F.col("doc_id"), 4) != 2)
    got = langid.predict(odd(spark), model).collect()
    assert len(got) == len(ODD)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"} and all(r.lang_pred in model.languages for r in got if r.doc_id in (4, 5, 6))
    assert {r.lang_pred for r in langid.predict(odd(spark), langid.train(docs.where("doc_id < 0"), F.lit(True))).collect()} == {"und"}
    one = langid.Model([np.array([1, 2]), np.array([2, 3])], ["sw", "sw"])
    assert {r.lang_pred for r in langid.predict(odd(spark), one).collect()} == {"und", "sw"}
    assert langid.predict(odd(spark, []), one).count() == 0


def test_families_are_asked_before_languages():
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(np.arange(100 * k, 100 * k + 60), 20, replace=False)) for k in (0, 1, 2, 3) for _ in range(30)]
    model = langid.Model(rows, [x for x in ("en", "de", "fr", "es") for _ in range(30)])
    assert model.families == ["germanic", "romance"] and set(model.pairs) == {("de", "en"), ("es", "fr")} and len(model.one) == 2


def test_quality_classifier(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "quality")
    found = queries.op8_quality_classifier(spark, DATA).join(labels, "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) for r in found)
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95


def test_quality_classifier_of_odd_rows(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{x}.parquet") for x in ("documents", "labels"))
    model = nbsvm.train(docs, labels.unionByName(labels), F.lit(True), per_class=50)
    got = nbsvm.score(odd(spark), model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    kept = nbsvm.accepted(odd(spark), model)
    assert kept.columns == odd(spark).columns and kept.count() == sum(r.score >= 0.5 for r in got)
    none = labels.where("doc_id < 0")
    assert {r.score for r in nbsvm.score(odd(spark), nbsvm.train(docs, none, F.lit(True))).collect()} == {0.5}
    assert nbsvm.score(odd(spark, []), model).count() == 0


def test_toxicity(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    found = queries.op10_toxicity(spark, DATA)
    assert found.columns == ["doc_id", "held_out", "p_poor", "p_toxic", "toxic"]
    learned = found.where("NOT held_out").join(labels, "doc_id").collect()
    assert np.mean([r.toxic == r.label for r in learned]) > 0.97


def test_toxicity_held_out(spark):
    """Some 300 toxic rows in four languages to learn from."""
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    found = queries.op10_toxicity(spark, "/root/testdata/sf0.1").where("held_out").join(labels, "doc_id").collect()
    caught = [r.toxic for r in found if r.label == 1]
    clean = [r.toxic for r in found if r.label == 0]
    assert len(caught) > 100 and np.mean(caught) > 0.85 and np.mean(clean) < 0.01


def test_later_link_uses_earlier_probabilities():
    """The n-grams tell the second category too weakly to count, so all it knows comes from the first's link."""
    rng = np.random.default_rng(4)
    first = rng.integers(0, 2, 400) * 2 - 1
    rows = [np.unique(np.append(rng.integers(0, 1000, 8), 2000 + (y > 0))) for y in first]
    second = np.where(rng.random(400) < 0.75, first, -first)
    chain = toxicity.Chain(rows, {"poor": first, "toxic": second}, {"poor": 0.5, "toxic": 0.5})
    alone = toxicity.Chain(rows, {"toxic": second}, {"toxic": 0.5})
    assert chain.links[1][1][chain.width] > 0.1 and len(alone.links) == 1
    two, earlier = [np.array([2000 + (y > 0)]) for y in (1, -1)], np.array([[1.0], [-1.0]])
    up, down = chain.margins(two, earlier, *chain.links[1][:2])
    assert up > 0 > down and up - down > 0.5
    up, down = alone.margins(two, np.zeros((2, 0)), *alone.links[0][:2])
    assert up == down


def test_best_cut():
    p, y = np.array([0.9, 0.45, 0.4, 0.1, 0.05]), np.array([1, 1, -1, -1, -1])
    assert toxicity.best_cut(p, y, np.ones(5)) == 0.45
    assert toxicity.best_cut(p, np.array([1, -1, -1, -1, -1]), np.ones(5)) == 0.5


def test_toxicity_of_odd_rows(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{x}.parquet") for x in ("documents", "labels"))
    chain = toxicity.train(docs, labels, per_class=40)
    assert chain.names == ["poor", "toxic"] and len(chain.links[1][1]) == len(chain.links[0][1]) + 1  # the second sees the first
    got = toxicity.predict(odd(spark), chain).collect()
    assert len(got) == len(ODD) and all(0 <= r.p_toxic <= 1 for r in got)
    assert toxicity.predict(odd(spark), toxicity.train(docs, labels.where("toxic = 0"))).where("toxic = 1").count() == 0
    assert toxicity.predict(odd(spark, []), chain).count() == 0


def test_hinge_reaches_the_optimum():
    """Against projected subgradient steps on a small dense problem."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 5))
    y = np.where(x @ np.array([1.0, -2, 0.5, 0, 0]) + 0.3 * rng.normal(size=60) > 0, 1, -1)
    rows = [np.arange(5)] * 60
    w = _linear.hinge(rows, list(x), 5, y, np.ones(60), rounds=3000)
    loss = lambda w: 0.5 * w @ w + np.maximum(0, 1 - y * (x @ w[:5] + w[5])).sum()
    best, v = np.inf, np.zeros(6)
    for t in range(1, 60_000):
        on = y * (x @ v[:5] + v[5]) < 1
        v = v - (v - np.append((y[on, None] * x[on]).sum(axis=0), y[on].sum())) / t
        best = min(best, loss(v))
    assert loss(w) <= best + 1e-2


def test_sample_is_bounded_and_repeatable(spark):
    docs = spark.range(0, 500).selectExpr("id AS doc_id", "concat('t', id) AS text")
    told = spark.range(0, 500).selectExpr("id", "int(id % 5 = 0) AS label", "int(id % 5 = 0) AS code")
    take = lambda n: sorted(map(tuple, _linear.labelled_sample(docs, told, n)[0].collect()))
    assert take(30) == take(30) and 30 <= len(take(30)) <= 90
    assert _linear.labelled_sample(docs, told, 30)[1] == {0: 400, 1: 100} and len(take(1000)) == 500
    named = docs.withColumn("lang", F.when(F.col("doc_id") % 5 == 0, "a").when(F.col("doc_id") % 5 < 4, "b"))
    counts = _linear.sample(named.unionByName(named), F.col("lang"), 1000).groupBy("label").count().collect()
    assert dict(map(tuple, counts)) == {"a": 100, "b": 300}
    plan = _linear.sample(named, F.col("lang"), 30)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan


@pytest.mark.parametrize("n", [1, 3])
def test_byte_grams_stay_within_a_document(n):
    data, offsets = np.frombuffer(b"abcdefg", np.uint8), np.array([0, 2, 2, 7])
    of, _ = _linear.byte_grams(data, offsets, n, 8)
    assert np.bincount(of, minlength=3).tolist() == [max(2 - n + 1, 0), 0, 5 - n + 1]
