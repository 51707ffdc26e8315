"""One row of layout statistics for each document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import predicates as is_
from .margins import in_reading_order


def doc_stats(lines: DataFrame) -> DataFrame:
    """(doc_id, body_font, line_gap, left_indent, right_edge, line_height, judis): exact medians.

    Noise lines don't count, but a gap is taken to the line before whether it is noise or not, and counts
    from 0 to 40. judis: two or three of many list items, many short capital lines, mostly wide lines.
    """
    gap = F.col("y0") - F.lag("y1").over(in_reading_order())
    rows = lines.withColumn("gap", gap).where(~is_.margin_noise("text"))
    median = lambda x, default: F.coalesce(F.median(x), F.lit(default))
    width = F.col("x1") - F.col("x0")
    found = rows.groupBy("doc_id").agg(
        median("font_size", 11.0).alias("body_font"), median(F.when(F.col("gap").between(0, 40), F.col("gap")), 3.0).alias("line_gap"), median("x0", 72.0).alias("left_indent"),
        median("x1", 520.0).alias("right_edge"), F.median(F.col("y1") - F.col("y0")).alias("line_height"), F.median(width).alias("line_width"), F.collect_list(width).alias("widths"),
        F.avg(is_.list_item_base("text").cast("int")).alias("items"), F.avg(is_.caps_heading("text").cast("int")).alias("caps"),
    )
    wide = F.size(F.filter("widths", lambda w: w >= F.col("line_width") * 0.9)) / F.size("widths")
    signals = (F.col("items") >= 0.08).cast("int") + (F.col("caps") >= 0.04).cast("int") + (wide >= 0.55).cast("int")
    return found.select("doc_id", "body_font", "line_gap", "left_indent", "right_edge", "line_height", (signals >= 2).alias("judis"))


def base_indent(entries: DataFrame, indent: str = "indent") -> DataFrame:
    """(doc_id, base_indent): the most frequent indent, of equally frequent ones the first seen."""
    counts = entries.groupBy("doc_id", indent).agg(F.count("*").alias("n"), F.min(F.struct("page_no", "ord")).alias("first"))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("n"), "first"))
    return counts.withColumn("rank", rank).where("rank = 1").select("doc_id", F.col(indent).alias("base_indent"))


def characters(lines: DataFrame) -> DataFrame:
    """(doc_id, n_pages, n_lines, n_chars, scanned) of each document."""
    found = lines.groupBy("doc_id").agg(F.max("n_pages").alias("n_pages"), F.count("*").alias("n_lines"), F.sum(F.length("text")).alias("n_chars"))
    return found.withColumn("scanned", is_.scanned("n_chars"))
