"""The pipeline: each stage's decisions against its operator, and rerun on what the one before kept."""

import corpus_pipeline
from pyspark.sql import functions as F

from quire.llm import decontam, simhash
from quire.llm._common import stored, table

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, DATA, "documents").withColumn("extra", F.lit("kept"))
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stored(stage(spark, docs, DATA))
        assert found.columns == columns, name
        assert found.count() <= before and found.count() > 0.6 * before
        docs, before = found, found.count()
    assert decontam.contained(docs, table(spark, DATA, "benchmark")).count() == 0
    classes = simhash.near_duplicates(docs)
    assert classes.groupBy("component_id").count().where("count > 1").count() <= 1  # line dedup comes first
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert mixed.where("taken <= 0 OR taken > 3 * size").count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, DATA).columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "near_duplicates", "decontamination", "source_mixing"]


ODD = [(1, None), (2, ""), (3, " \n"), (4, "one word"), (4, "one word"), (4, "another text"), (None, None), (None, "text without an id"), (None, "text without an id"), (5, "x " * 30_000), (6, "\n".join(f"line {i}" for i in range(500)))]


def odd(spark, rows):
    """Columns of documents, and some that operators use inside."""
    docs = spark.createDataFrame([(i, t, "en", None if i == 1 else "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({c: F.lit("mine") for c in ("id", "hash", "th", "own", "fp", "sim", "row", "goes", "removed", "lines", "size", "taken", "rank", "label", "class", "a.b")})


def test_stages_with_odd_rows(spark):
    docs = odd(spark, ODD)
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, DATA)
        rows = found.collect()
        kept = [(r.doc_id, r.text) for r in rows] if "text" in found.columns else None
        if name == "near duplicates":  # rows 1, 2, 3 and (None, None) have no words
            assert sorted(kept, key=str) == sorted({(1, None), *(x for x in ODD if x[1] and x[1].strip())}, key=str)
        elif name in ("line dedup", "decontamination"):
            assert sorted(kept, key=str) == sorted(ODD, key=str), name
        elif name == "quality classifier":
            assert len({x for x in kept if x[0] == 4 and x[1] == "one word"}) in (0, 1) and kept.count((4, "one word")) in (0, 2)
        else:
            assert {r.doc_id for r in rows} <= {4, 5, 6, None} and all(r.taken > 0 for r in rows)
        if name != "mixing":
            assert found.columns == docs.columns and all(r["a.b"] == r.th == "mine" for r in rows)


def test_stages_with_an_empty_table(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd(spark, []), DATA).count() == 0


def test_no_folder_is_left_but_the_last(spark):
    import os

    from quire.llm._common import shared_folder

    at = shared_folder(spark).removeprefix("file:")
    before = {x for x in os.listdir(at) if x.startswith("quire-")}
    corpus_pipeline.run(spark, DATA).count()
    assert len({x for x in os.listdir(at) if x.startswith("quire-")} - before) == 1
