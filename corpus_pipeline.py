"""The corpus pipeline: stages over `documents`, each an operator of quire.llm.

In every stage a null text counts as a text without words or lines, rows without a doc_id are judged like others,
repeated rows are judged alike (but for near duplicates, which keep one), an empty table stays empty, and columns
besides doc_id, text, source and n_chars go through as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import decontam, linededup, mixing, nbsvm, simhash
from quire.llm._common import new_folder, removed, stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from all labels; without labels of both kinds all
    documents have the share of good labels as their score (0.5 without any), and stay from 0.5 on."""
    return nbsvm.accepted(docs, nbsvm.train(docs, table(spark, sf_dir, "labels"), F.lit(True)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows leave the texts; every document stays, a null text as null."""
    return linededup.without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the smallest doc_id, of equal ones the smallest text
    hash. Texts without words are one group, null among them."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; a null text holds none."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document; those it doesn't take at all go, such as texts without words. A null
    source is a source of its own."""
    return mixing.mix(docs).where("taken > 0")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", source_mixing),
]
#: The classifier and the alignment have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage reads what the one before it has written to the shared folder, which is
    removed as soon as the next one is written; that of the last but one is read by the rows returned."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        at = new_folder(spark)
        docs = stored(stage(spark, docs, sf_dir), at)
        if before:
            removed(spark, before)
        before = at
    return STAGES[-1][1](spark, docs, sf_dir)
