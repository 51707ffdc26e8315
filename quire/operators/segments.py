"""Lines to paragraphs, paragraphs to kinds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as T

from . import predicates as is_
from .margins import in_reading_order, reasons
from .stats import doc_stats

_BEFORE = ("text", "x0", "x1", "y1", "font_size", "block_no")


def _with_previous(lines: DataFrame, stats: DataFrame) -> DataFrame:
    w = in_reading_order()
    return lines.join(stats, "doc_id").select("*", *(F.lag(x).over(w).alias(f"p_{x}") for x in _BEFORE))


def _islands(lines: DataFrame, merges: Column) -> DataFrame:
    begins = F.when(F.col("p_text").isNull() | ~merges, 1).otherwise(0)
    ordered = lines.withColumn("begins", begins)
    w = in_reading_order().rowsBetween(Window.unboundedPreceding, 0)
    return ordered.withColumn("chunk", F.sum("begins").over(w).cast("int")).drop("begins", *(f"p_{x}" for x in _BEFORE))


def paragraphs(lines: DataFrame, stats: DataFrame) -> DataFrame:
    """lines with `chunk`: the number of the paragraph on the page. Whether a line goes on depends on it and
    the line before, so paragraphs are islands of a running sum."""
    rows = _with_previous(lines, stats)
    gap = F.greatest(F.lit(0.0), F.col("y0") - F.col("p_y1"))
    font = F.abs(F.col("font_size") - F.col("p_font_size")) <= 1.5
    indent = F.abs(F.col("x0") - F.col("p_x0"))
    alike = (indent <= 12) | (F.abs(F.col("x1") - F.col("p_x1")) <= 28)
    wrapped = is_.visual_wrap("p_x1", "right_edge")
    goes_on = is_.likely_continuation("p_text", "text", wrapped)
    breaks = is_.list_item("text") | is_.heading_like("text", "font_size", "body_font") | (gap > F.greatest(F.lit(10.0), F.col("line_gap") * 2.4))
    block = (F.col("block_no") == F.col("p_block_no")) & (F.col("block_no") != -1)
    starts = is_.paragraph_start("text") & ~is_.short_continuation("text")
    merges = font & (block | (alike & (indent <= 24) & goes_on) | (wrapped & ~starts))
    ended = is_.numbered_paragraph("text") & T.strip("p_text").rlike('[.?!:”"]$')
    return _islands(rows, ~ended & ~breaks & merges)


def paragraphs_base(lines: DataFrame, stats: DataFrame) -> DataFrame:
    """The base converter's paragraphs: twelve rules in order, the first that applies decides."""
    rows = _with_previous(lines, stats)
    gap = F.greatest(F.lit(0.0), F.col("y0") - F.col("p_y1"))
    change = F.abs(F.col("font_size") - F.col("p_font_size"))
    shift, right = F.col("x0") - F.col("p_x0"), F.abs(F.col("x1") - F.col("p_x1"))
    item, was_item = is_.list_item_base("text"), is_.list_item_base("p_text")
    goes_on = is_.likely_continuation("p_text", "text", base=True)
    ended = T.strip("p_text").rlike(is_.P.SENTENCE_END)
    hanging = (shift >= 12) & (gap <= F.greatest(F.col("line_gap") * 1.25, F.col("line_height") * 0.35))
    ragged = (F.col("p_x1") - F.col("p_x0") < (F.col("right_edge") - F.col("left_indent")) * 0.62) & ended
    large = gap > F.greatest(F.col("line_height") * 0.85, F.col("line_gap") * 1.9)
    list_gap = F.greatest(F.col("line_gap") * 1.8, F.col("line_height") * 0.55)
    judis = F.col("judis") & ((ended & (shift >= 12)) | (ended & (right > 28)) | (ragged & ~goes_on))
    border = (
        F.when(is_.heading_like("text", "font_size", "body_font", base=True), True)
        .when(is_.numbered_paragraph("text") & ended, True)
        .when(item & ~was_item, True)
        .when(item & was_item, (gap > list_gap) | (F.abs(shift) > 14))
        .when(change > 1.5, True)
        .when(large, True)
        .when((F.abs(shift) > 14) & ~hanging, True)
        .when(judis, True)
        .when(was_item & (F.col("x0") <= F.col("p_x0") - 14), True)
        .otherwise(~(((F.abs(shift) <= 10) | (right <= 18) | hanging) & goes_on))
    )
    return _islands(rows, ~border)


def chunks(lines: DataFrame, base: bool = False) -> DataFrame:
    """(doc_id, page_no, chunk, kind, text, x0, y0, x1, y1, n_lines) of each paragraph: h1, h2, h3, ol, ul
    (base only), blockquote or p. lines: with `chunk` and the statistics. text is escaped for HTML."""
    in_order = F.sort_array(F.collect_list(F.struct(F.bround("y0", 1).alias("a"), F.bround("x0", 1).alias("b"), "ord", "text")))
    found = lines.groupBy("doc_id", "page_no", "chunk").agg(
        F.transform(in_order, lambda s: s.text).alias("texts"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.avg("font_size").alias("font"),
        F.avg("x0").alias("indent"), F.count("*").alias("n_lines"), F.first("body_font").alias("body_font"), F.first("left_indent").alias("left_indent"),
    )
    found = found.withColumn("text", T.escape_html(T.join_lines(F.col("texts"))))
    over = F.col("font") - F.col("body_font")
    kind = F.when(is_.heading_like("text", "font", "body_font", base), F.when(over >= 3, "h1").when(over >= 1.5, "h2").otherwise("h3"))
    if base:
        items = (F.col("n_lines") >= 2) & F.forall("texts", is_.list_item_base)
        kind = kind.when(items, F.when(is_.ordered_item(F.get("texts", F.lit(0))), "ol").otherwise("ul"))
    kind = kind.when((F.col("n_lines") >= 2) & (F.col("indent") > F.col("left_indent") + 20), "blockquote").otherwise("p")
    return found.select("doc_id", "page_no", "chunk", kind.alias("kind"), "text", "x0", "y0", "x1", "y1", "n_lines", "texts")


def document_chunks(lines: DataFrame, base: bool = False, compat: bool = False) -> DataFrame:
    """From raw lines to chunks: statistics, dropping, paragraphs, kinds."""
    stats = doc_stats(lines)
    kept = reasons(lines, compat).where("reason IS NULL").drop("reason")
    return chunks((paragraphs_base if base else paragraphs)(kept, stats), base)


def list_items(found: DataFrame) -> DataFrame:
    """(doc_id, page_no, chunk, kind, items): the items of ordered and unordered lists, without their marks."""
    return found.where(F.col("kind").isin("ol", "ul")).select("doc_id", "page_no", "chunk", "kind", F.transform("texts", lambda t: T.escape_html(is_.list_marker_stripped(t))).alias("items"))


def titles(lines: DataFrame, names: DataFrame) -> DataFrame:
    """(doc_id, title): of the eight largest, then highest, lines of page 1 the first that looks like a title,
    or else the document's name. names: (doc_id, name)."""
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("font_size"), "y0", "ord"))
    text = T.strip("text")
    fit = (T.words(text) >= 2) & (F.length(text) <= 200) & ~is_.margin_noise(text)
    top = lines.where("page_no = 1").withColumn("rank", rank).where("rank <= 8").where(fit).groupBy("doc_id").agg(F.min_by("text", "rank").alias("found"))
    return names.join(top, "doc_id", "left").select("doc_id", F.coalesce(T.strip("found"), T.stem("name")).alias("title"))
