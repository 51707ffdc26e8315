"""Mixing sources to target weights by hash-threshold histograms.

Each row has a hash of its identity. A source whose target is t times its size takes every row
floor(t) times, and once more the rows whose hash is under a threshold. The threshold comes from nested
histograms: tokens are summed by source and the hash's first digits, the bucket in which the budget runs
out is the boundary, and only its rows go on to the next digits. Nothing is sorted; a level's histogram
has 4096 buckets a source at most, whatever the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import WORD, checkpointed

LEVELS, BITS = 4, 12
WEIGHTS = (1, 2, 3)
MOST = 3


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, hash): words of each text, and 48 bits of the MD5 of doc_id and text."""
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.col("text"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long"), "source", size.alias("size"), F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("long").alias("hash"))


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, target, copies, budget) for each source.

    Sources in code point order, null last, weigh WEIGHTS in turn and share all sizes. A target stops
    at MOST times the source's size; the excess is shared again by weight: with sources ordered by
    cap / weight, the level is the first at which what is left fits under the next source's cap.
    copies: whole takes of every row; budget: words beyond those.
    """
    every = Window.partitionBy()
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weighed = by_source.withColumn("rank", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())))
    weighed = weighed.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int")))
    weighed = weighed.withColumn("ratio", F.lit(float(MOST)) * F.col("source_size") / F.col("weight"))
    before = every.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - MOST * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    weights = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = weighed.withColumn("level", left.cast("double") / weights.cast("double"))
    fits = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level"))).over(every)
    target = F.least(F.col("source_size") * float(MOST), fits.getField("level") * F.col("weight"))
    found = levels.select("source", "source_size", target.alias("target"))
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    return found.withColumn("copies", copies).withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size"))


def thresholds(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, stop): a row of source is taken once more if its hash is under stop; null: each is."""
    rows = sized.alias("d")
    at = plan.select("source", "budget", F.lit(0).cast("long").alias("spent"), F.lit(0).cast("long").alias("prefix"))
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        at = at.alias("t")
        inside = F.col("d.source").eqNullSafe(F.col("t.source")) & (F.shiftright("d.hash", shift + BITS) == F.col("t.prefix"))
        digits = F.shiftright("d.hash", shift).alias("digits")
        tally = rows.join(at, inside).groupBy("t.source", "t.budget", "t.spent", digits).agg(F.sum("d.size").alias("words"))
        running = Window.partitionBy("source").orderBy("digits").rowsBetween(Window.unboundedPreceding, 0)
        tally = tally.withColumn("upto", F.col("spent") + F.sum("words").over(running)).where("upto > budget")
        first = tally.groupBy("source").agg(F.min(F.struct("digits", "upto", "words", "budget")).alias("b"))
        at = first.select("source", "b.budget", (F.col("b.upto") - F.col("b.words")).alias("spent"), F.col("b.digits").alias("prefix"))
    return at.select("source", F.col("prefix").alias("stop"))


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of docs.

    A null text has size 0, a null source is a source, a null doc_id hashes by its text alone. Rows
    with equal doc_id and text have one hash and are taken alike, so that a source can miss its target by the
    size of its most repeated row. Other columns are not read; an empty table gives none.
    """
    sized = checkpointed(sizes(docs))
    plan = checkpointed(targets(sized))
    plan = plan.alias("p").join(thresholds(sized, plan).alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")), "left")
    plan = checkpointed(plan.select("p.source", "p.source_size", "p.target", "p.copies", "t.stop"))
    more = F.when(F.col("stop").isNull() | (F.col("hash") < F.col("stop")), 1).otherwise(0)
    both = sized.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
    # without a budget no hash is under the stop, which then is the smallest hash of a row with words
    return both.select("doc_id", "size", "source_size", "target", (F.col("size") * (F.col("copies") + F.when(F.col("copies") >= MOST, 0).otherwise(more))).alias("taken"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(concat_ws(':', doc_id::VARCHAR, text)), 1, 12))::BIGINT AS hash
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM d GROUP BY source),
w AS (SELECT *, (1 + (rank - 1) % 3)::BIGINT AS weight, 3.0::DOUBLE * source_size / (1 + (rank - 1) % 3) AS ratio FROM s),
l AS (SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0))::DOUBLE
                / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
      FROM w WINDOW before AS (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT level FROM l WHERE level <= ratio ORDER BY ratio, rank LIMIT 1),
t AS (SELECT source, source_size, least(3.0::DOUBLE * source_size, f.level * weight) AS target FROM l, f),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS copies FROM t),
c AS (SELECT d.*, p.source_size, p.target, p.copies,
             sum(size) OVER (PARTITION BY d.source ORDER BY hash RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * (copies + CASE WHEN copies < 3 AND upto <= target - copies * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""
