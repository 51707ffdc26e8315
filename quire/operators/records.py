"""Batch bookkeeping: what is eligible, numbered, counted and written."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def eligible(records: DataFrame, done: DataFrame, key: str = "file_id", limit: int | None = None) -> DataFrame:
    """Records with a key and a source that aren't skipped, and not among the done ones; the first by key
    if limited. The anti join goes before the limit."""
    fit = records.where(F.col(key).isNotNull() & F.col("s3_key_pdf").isNotNull() & F.col("skip_reason").isNull())
    left = fit.join(done.select(key), key, "left_anti")
    return left if limit is None else left.orderBy(key).limit(limit)


def done(records: DataFrame, key: str = "file_id") -> DataFrame:
    return records.where(F.col("s3_url_frontend").isNotNull()).select(key).distinct()


def largest_id(*tables: DataFrame, key: str = "file_id") -> DataFrame:
    """(max_id) over all tables, 0 if there is none."""
    found = None
    for t in tables:
        one = t.agg(F.coalesce(F.max(key), F.lit(0)).cast("long").alias("max_id"))
        found = one if found is None else found.unionByName(one)
    return found.agg(F.max("max_id").alias("max_id"))


def assign_ids(records: DataFrame, order: str, largest: DataFrame, compat: bool = False, key: str = "file_id") -> DataFrame:
    """records with a key each: those without one are numbered on from the largest, in order.

    Without gaps, or (compat) by their place among all records, so that numbered ones leave gaps. Ranks are
    of ranges: rows are counted per range of `order` and the offsets joined back, so no task ranks all rows.
    """
    counted = records if compat else records.where(F.col(key).isNull())
    part = F.floor(F.col(order) / 4096).alias("_part")
    sizes = counted.groupBy(part).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("_part", before.alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(order))
    ranked = counted.select("*", part).withColumn("_rank", rank).join(sizes, "_part").crossJoin(F.broadcast(largest))  # largest is one row
    number = (F.col("max_id") + F.col("_before") + F.col("_rank")).cast("long")
    new = ranked.withColumn(key, F.coalesce(key, number)).select(records.columns)
    return new if compat else new.unionByName(records.where(F.col(key).isNotNull()).select(records.columns))


def status_counts(results: DataFrame) -> DataFrame:
    """One row of counts by status."""
    names = ("processed", "skipped", "failed", "not_in_read_coll", "not_in_write_coll")
    return results.agg(*(F.count_if(F.col("status") == s).alias(s) for s in names), F.count_if(~F.col("status").isin(*names) | F.col("status").isNull()).alias("other"))


def updated(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """target with the fields of changes set where the key is there, and rows added where it isn't."""
    return target.join(changes.select(key), key, "left_anti").unionByName(changes.select(target.columns))


def within_quota(files: DataFrame, by: str, order: str, size: str, quota: int) -> DataFrame:
    """files with `kept`: pages go on until the sizes before them exceed the quota."""
    before = F.coalesce(F.sum(size).over(Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return files.withColumn("kept", before <= quota)


def output_paths(prefix: str, root: str, key: str = "file_id") -> dict[str, F.Column]:
    """The key under prefix of a record's HTML, and its address under root, the store's."""
    path = F.concat(F.lit(f"{prefix}/"), F.col(key).cast("string"), F.lit(".html"))
    return {"s3_key": path, "url": F.concat(F.lit(f"{root}/"), path)}


def processed(records: DataFrame, sources: DataFrame, prefix: str, root: str) -> DataFrame:
    """(file_id, status, s3_status, s3_key, s3_url): what becomes of each record, decided in this order.

    An uploaded record is skipped and keeps its fields; one without a source, one whose source can't be read
    (its status is stored) and one whose source has no line fail; the others are processed and uploaded.
    records: (file_id, s3_key_pdf, s3_status); sources: (s3_key_pdf, n_lines), n_lines null where unreadable.
    """
    both = records.join(sources.withColumn("_there", F.lit(True)), "s3_key_pdf", "left")
    status = (
        F.when(F.col("s3_status") == "uploaded", "skipped").when(F.col("_there").isNull(), "failed")
        .when(F.col("n_lines").isNull(), "unreadable").when(F.col("n_lines") == 0, "failed").otherwise("processed")
    )
    both = both.withColumn("_status", F.coalesce(status, F.lit("failed")))
    stored = F.when(F.col("_status") == "processed", "uploaded").when(F.col("_status") == "unreadable", "failed").otherwise(F.col("s3_status"))
    paths = output_paths(prefix, root)
    new = lambda c: F.when(F.col("_status") == "processed", c)
    told = F.when(F.col("_status") == "unreadable", "failed").otherwise(F.col("_status"))
    return both.select("file_id", told.alias("status"), stored.alias("s3_status"), new(paths["s3_key"]).alias("s3_key"), new(paths["url"]).alias("s3_url"))


def routed(documents: DataFrame, scanned: DataFrame, as_image, as_text) -> DataFrame:
    """documents in two branches by scanned (doc_id, scanned), each converted by its own function, and their union.

    Both functions give the same columns. A document that scanned doesn't tell goes by its image.
    """
    told = documents.join(scanned.select("doc_id", "scanned"), "doc_id", "left").withColumn("scanned", F.coalesce("scanned", F.lit(True)))
    return as_image(told.where("scanned").drop("scanned")).unionByName(as_text(told.where("NOT scanned").drop("scanned")))


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows, as often as they are in one of two tables more than in the other, with `side`: which of them."""
    return a.exceptAll(b).withColumn("side", F.lit("first")).unionByName(b.select(a.columns).exceptAll(a).withColumn("side", F.lit("second")))
