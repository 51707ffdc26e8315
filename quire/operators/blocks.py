"""Zones of judgment lines, sections, and numbered paragraphs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import patterns as P
from quire.functions import text as T


def zone(text: Column, indent: Column, base: Column, italic: Column) -> Column:
    """The first zone whose pattern matches; else quote by indent, or body."""
    upper = F.upper(T.strip(text))
    named = reduce(lambda c, z: c.when(upper.rlike(T.ascii_bounds(z[1])), z[0]), P.ZONES[1:], F.when(upper.rlike(P.ZONES[0][1]), P.ZONES[0][0]))
    return named.when((indent > base + 60) & italic, "quote").when(indent > base + 80, "quote").otherwise("body")


def sections(entries: DataFrame) -> DataFrame:
    """(doc_id, ord, page_no, text, zone, in_order, page_break) of classified entries (doc_id, ord, page_no, text, zone).

    in_order: after the first order heading; page_break: before it, on another page than the line before.
    """
    w = Window.partitionBy("doc_id").orderBy("ord")
    seen = F.coalesce(F.max((F.col("zone") == "order_heading").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) == 1
    own = F.coalesce(F.max((F.col("zone") == "order_heading").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)) == 1
    turned = F.col("page_no") != F.lag("page_no", 1, 1).over(w)
    return entries.select("doc_id", "ord", "page_no", "text", "zone", own.alias("in_order"), (turned & ~seen).alias("page_break"))


def merged_paragraphs(items: DataFrame) -> DataFrame:
    """(doc_id, n, kind, num, text) from (doc_id, ord, kind, text) with kinds heading, quote and body.

    A line that is or begins with a number opens a paragraph; others go on. A heading ends the number, a
    quote only the paragraph: text behind it opens another one of the same number.
    """
    text = T.strip("text")
    alone, begins = text.rlike(r"^\d+[.)]$"), text.rlike(r"^\d+[.)]\s+")
    number = F.when(F.col("kind") == "body", F.when(alone, text).when(begins, F.regexp_extract(text, r"^(\d+[.)])", 1)))
    rest = F.when(alone, "").when(begins, F.regexp_extract(text, r"(?s)^\d+[.)]\s+(.*)$", 1)).otherwise(text)
    w = Window.partitionBy("doc_id").orderBy("ord")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    marked = items.select("doc_id", "ord", "kind", number.alias("number"), F.when(F.col("kind") == "body", rest).otherwise(F.col("text")).alias("text"), F.sum((F.col("kind") == "heading").cast("int")).over(upto).alias("part"))
    opens = (F.col("kind") != "body") | F.col("number").isNotNull() | (F.lag("kind", 1, "none").over(w) != "body")
    numbered = marked.withColumn("block", F.sum(opens.cast("int")).over(upto)).withColumn("num", F.last("number", True).over(Window.partitionBy("doc_id", "part").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)))
    words = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "text"))), lambda s: s.text), " ")
    found = numbered.groupBy("doc_id", "block").agg(F.first("kind").alias("line_kind"), F.min(F.struct("ord", "num")).alias("head"), words.alias("text"))
    body = F.col("line_kind") == "body"
    found = found.select("doc_id", "block", F.when(~body, F.col("line_kind")).when(F.col("head.num").isNull(), "body").otherwise("para").alias("kind"), F.when(body, F.coalesce("head.num", F.lit(""))).otherwise("").alias("num"), F.when(body, T.strip(T.collapse_spaces(T.strip("text")))).otherwise(F.col("text")).alias("text"))
    found = found.where((F.col("text") != "") | ~F.col("kind").isin("body", "para"))
    return found.select("doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy("block")).alias("n"), "kind", "num", "text")


def judge_places(classified: DataFrame) -> DataFrame:
    """(doc_id, opener, signatures): the judge's name that opens the body, and those that sign below.

    classified: sections(). A name with (oral) always opens, the last such one; others open if a numbered
    paragraph is among the first three lines of the order, the first such one unless one is set before.
    """
    lines = classified.where("in_order AND zone IN ('order_heading', 'quote', 'body')")
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("ord")) - 1
    early = lines.select("doc_id", "zone", "text", place.alias("i")).where((F.col("zone") != "order_heading") & T.strip("text").rlike(r"^\d+[.)]")).groupBy("doc_id").agg((F.min("i") <= 2).alias("early"))
    names = classified.where("zone = 'judge_name'").join(early, "doc_id", "left").withColumn("early", F.coalesce("early", F.lit(False))).withColumn("oral", F.col("text").rlike(r"(?i)\(oral\)"))
    oral = F.max_by("text", F.when(F.col("oral"), F.col("ord")))
    first = F.min_by("text", F.when(F.col("early"), F.col("ord")))
    signed = F.transform(F.sort_array(F.collect_list(F.when(~F.col("oral") & ~F.col("early"), F.struct("ord", "text")))), lambda s: s.text)
    return names.groupBy("doc_id").agg(F.coalesce(oral, first).alias("opener"), signed.alias("signatures"))
