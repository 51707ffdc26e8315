"""Incremental runs: files that arrive are converted once, and results are set by key.

The batch form is an anti join against what is done (operators.records). The streaming form keeps that
knowledge in the checkpoint: with the trigger availableNow a run takes what is new and ends.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources import layout


def new_documents(spark: SparkSession, path: str, schema: str = "doc_id long, text string, source string") -> DataFrame:
    """A stream of documents from Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).parquet(path)


def run_once(documents: DataFrame, convert: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> None:
    """Converts what has arrived since the last run; each micro-batch writes a folder of its own number, so a
    batch that is run again after a failure overwrites itself and nothing is there twice."""

    def write(batch: DataFrame, number: int) -> None:
        convert(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    documents.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def line_counts(documents: DataFrame) -> DataFrame:
    """(doc_id, n_lines): a conversion for run_once()."""
    return layout.layout_lines(documents).groupBy("doc_id").agg(F.count("*").alias("n_lines"))
