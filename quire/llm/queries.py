"""One query for each corpus operator, with the contract's parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, langid, linededup, lmscore, mixing, nbsvm, quality_rules, simhash, substring, toxicity
from ._common import crc_rest, table


def _held_out(found: DataFrame, modulus: int, rest: int) -> DataFrame:
    """found with held_out behind doc_id; a null doc_id isn't held out, and is never learned from."""
    held = F.coalesce(crc_rest(F.col("doc_id"), modulus) == rest, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), *found.columns[1:])


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, crc_rest(F.col("doc_id"), 4) != 2)
    return _held_out(langid.predict(docs, model), 4, 2)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.report(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints over shingles of three words, as the contract of this query fixes."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lmscore.score(table(spark, sf_dir, "documents"))
    return found.withColumn("log_score", F.round("log_score", 6))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = nbsvm.train(docs, table(spark, sf_dir, "labels"), crc_rest(F.col("id"), 3) != 1)
    found = nbsvm.score(docs, model)
    return _held_out(found.withColumn("predicted", (F.col("score") >= 0.5).cast("int")), 3, 1)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(table(spark, sf_dir, "documents")).drop("text")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the labels that op8 learns from too; held_out: the rest, on which accuracy is measured."""
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), crc_rest(F.col("id"), 3) != 1)
    return _held_out(toxicity.predict(docs, chain), 3, 1)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_simhash": op4_simhash,
    "op5_mixing": op5_mixing,
    "op6_lm_score": op6_lm_score,
    "op7_decontamination": op7_decontamination,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_toxicity": op10_toxicity,
}
ORACLE_SQL: dict[str, str] = {"op2_line_dedup": linededup.SQL, "op3_quality_rules": quality_rules.SQL, "op5_mixing": mixing.SQL, "op6_lm_score": lmscore.SQL, "op9_substring_dedup": substring.SQL}
