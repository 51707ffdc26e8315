"""Files as a source: by path, or as bytes that are at hand already."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, paths: str | list[str], ignore_missing: bool = False) -> DataFrame:
    """(path, name, size, content) of the files at paths or globs; a path without files is an error, unless
    those that vanish are to be ignored."""
    found = spark.read.format("binaryFile").option("ignoreMissingFiles", str(ignore_missing).lower()).load(paths)
    return found.select("path", F.regexp_extract("path", "[^/]*$", 0).alias("name"), F.col("length").alias("size"), "content")


def texts(contents: DataFrame, content: str = "content") -> DataFrame:
    """contents with `text`, its bytes as UTF-8; null where they aren't (a document that can't be read)."""
    return contents.withColumn("text", F.when(F.is_valid_utf8(F.col(content).cast("string")), F.col(content).cast("string")))
