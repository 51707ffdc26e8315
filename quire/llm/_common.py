"""What the corpus operators share: checkpoints, identities of rows, connected components."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words in SQL regular expressions (Java and RE2).
WORD = r"[^\x20\x09-\x0D]+"


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the cluster's shared checkpoint folder and read from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a temporary one if the session is local, as in
    tests; on a cluster that is an error, since executors don't see each other's disks."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        at = spark.conf.get("spark.checkpoint.dir", "")
        if not at and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(at or tempfile.mkdtemp(prefix="quire-"))
    return sc._jsc.sc().getCheckpointDir().get()


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/quire-{uuid.uuid4().hex}"


def stored(df: DataFrame, at: str | None = None) -> DataFrame:
    """df as Parquet in the shared folder, or at a new_folder() that the caller removes."""
    at = at or new_folder(df.sparkSession)
    df.write.parquet(at)
    return df.sparkSession.read.parquet(at)


def removed(spark: SparkSession, at: str) -> bool:
    """Deletes a folder of stored()."""
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Python workers are told where this package is installed."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a few numbers that may be broadcast.
SMALL = 200_000


def small(df: DataFrame) -> DataFrame:
    """df, a checkpointed table of a few numbers a row, marked for a broadcast if it has SMALL rows at most."""
    return F.broadcast(df) if df.count() <= SMALL else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_rest(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod modulus; null for a null doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def _edges(df: DataFrame, u: Column, v: Column) -> DataFrame:
    return df.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected edges (u, v); component is its least node.

    Alternates large-star and small-star steps until nothing changes, each step cut by a checkpoint.
    A hub's edges are never gathered: its least neighbour is a partial aggregate, joined back.
    """
    at = checkpointed(_edges(edges, F.col("u"), F.col("v")))
    seen = None
    while True:
        both = at.unionByName(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = _edges(both.join(least, "u").where("v > u"), F.col("v"), F.col("m"))
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        at = checkpointed(_edges(small, F.col("u"), F.col("v")))
        now = at.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == seen:
            nodes = at.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return nodes.unionByName(at.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = now
