"""Repeated margin lines and what is dropped before paragraphs are formed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as T

from . import predicates as is_


def repeated_lines(lines: DataFrame) -> DataFrame:
    """(doc_id, page_no, ord) of outer-margin lines whose text, numbers hidden, is on two pages or more.

    Pages are counted by a partial aggregate and joined back, so no document's lines meet in one place.
    """
    text = T.strip("text")
    margin = lines.where((text != "") & ~is_.page_marker(text) & ~is_.trailing_marker(text) & is_.in_outer_margin())
    margin = margin.select("doc_id", "page_no", "ord", T.repeated_line_key("text").alias("key"))
    often = margin.groupBy("doc_id", "key").agg(F.count_distinct("page_no").alias("n")).where("n >= 2").select("doc_id", "key")
    return margin.join(often, ["doc_id", "key"]).select("doc_id", "page_no", "ord")


def repeated_patterns(lines: DataFrame, compat: bool = False, share: float = 0.6, least: int = 2) -> DataFrame:
    """(doc_id, key) of header or footer texts on at least max(least, share of the pages) pages.

    A text in both bands counts with its larger count; compat: with the footer's.
    """
    bands = lines.where(is_.in_header() | is_.in_footer()).select("doc_id", "n_pages", "page_no", T.repetition_key("text").alias("key"), is_.in_header().alias("head"), is_.in_footer().alias("foot"))
    pages = lambda band: F.size(F.collect_set(F.when(F.col(band), F.col("page_no"))))
    counts = bands.where("key <> ''").groupBy("doc_id", "n_pages", "key").agg(pages("head").alias("head"), pages("foot").alias("foot"))
    count = F.when(F.col("foot") > 0, F.col("foot")).otherwise(F.col("head")) if compat else F.greatest("head", "foot")
    needed = F.greatest(F.lit(least), F.ceil(F.col("n_pages") * share).cast("int"))
    return counts.where(count >= needed).select("doc_id", "key")


def reasons(lines: DataFrame, compat: bool = False) -> DataFrame:
    """lines with `reason`: why a line is dropped, the first that holds, or null."""
    often = repeated_patterns(lines, compat).withColumn("often", F.lit(True))
    keyed = lines.withColumn("norm", T.normalize("text")).withColumn("low", F.lower("norm")).withColumn("key", T.numbers_hidden("low")).join(often, ["doc_id", "key"], "left")
    low = F.col("low")
    reason = (
        F.when(F.col("often"), "repeated").when(is_.signature_artefact("text", low), "signature").when(is_.page_number("text", compat, low), "page_number")
        .when(is_.watermark_text("text", norm=F.col("norm")), "watermark").when(is_.side_margin_noise("text"), "side_margin")
    )
    return keyed.withColumn("reason", reason).drop("norm", "low", "key", "often")


def clean_entries(lines: DataFrame) -> DataFrame:
    """Lines without repeated margin lines, page and case markers, annotations and bare citations."""
    kept = lines.join(repeated_lines(lines), ["doc_id", "page_no", "ord"], "left_anti")
    text = T.strip("text")
    drop = (text == "") | is_.page_marker(text) | is_.trailing_marker(text) | is_.annotation("text") | is_.bare_citation("text")
    return kept.where(~drop)


def overlapping_regions(lines: DataFrame, regions: DataFrame, cell: float = 64.0) -> DataFrame:
    """Lines that meet none of their page's regions (page_no, x0, y0, x1, y1).

    A range join: regions are dealt to the horizontal cells that they reach, lines to those they reach, and
    the boxes are compared within a cell.
    """
    cells = lambda: F.explode(F.sequence(F.floor(F.col("y0") / cell), F.floor(F.col("y1") / cell))).alias("cell")
    a = lines.select("doc_id", "page_no", "ord", "x0", "y0", "x1", "y1", cells()).alias("a")
    b = regions.select("doc_id", "page_no", "x0", "y0", "x1", "y1", cells()).alias("b")
    same = (F.col("a.doc_id") == F.col("b.doc_id")) & (F.col("a.page_no") == F.col("b.page_no")) & (F.col("a.cell") == F.col("b.cell"))
    meets = (F.col("a.x0") < F.col("b.x1")) & (F.col("b.x0") < F.col("a.x1")) & (F.col("a.y0") < F.col("b.y1")) & (F.col("b.y0") < F.col("a.y1"))
    hit = a.join(b, same & meets, "left_semi").select("doc_id", "page_no", "ord")
    return lines.join(hit, ["doc_id", "page_no", "ord"], "left_anti")


def in_reading_order() -> Window:
    return Window.partitionBy("doc_id", "page_no").orderBy(F.bround("y0", 1), F.bround("x0", 1), "ord")
