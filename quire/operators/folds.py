"""True folds: each step looks at what the steps before have merged.

Each group is one page or one text line, so a fold runs over a sorted array inside its row, in the JVM; no
group of a whole document or more is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T

from . import predicates as is_
from .predicates import P

_FRAGMENT = "struct<text:string,x0:double,y0:double,x1:double,y1:double,font_size:double>"
_ELEMENT = "struct<kind:string,text:string,x0:double,y0:double,x1:double,y1:double>"


def _fold(rows: Column, kind: str, merges, merged) -> Column:
    """Rows merged from left to right: each is held against the last one of what has come out so far."""

    def step(out: Column, row: Column) -> Column:
        last = F.get(out, F.size(out) - 1)
        kept = F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0)))
        both = F.concat(kept, F.array(merged(last, row).cast(kind)))
        return F.when((F.size(out) > 0) & merges(last, row), both).otherwise(F.concat(out, F.array(row.cast(kind))))

    return F.aggregate(rows, F.array().cast(f"array<{kind}>"), step)


def _box(a: Column, b: Column) -> list[Column]:
    return [F.least(a.x0, b.x0).alias("x0"), F.least(a.y0, b.y0).alias("y0"), F.greatest(a.x1, b.x1).alias("x1"), F.greatest(a.y1, b.y1).alias("y1")]


def baseline_fragments(lines: DataFrame, gap: float = 18.0) -> DataFrame:
    """(doc_id, page_no, n, text, x0, y0, x1, y1, font_size): fragments of one baseline as one line.

    A fragment joins the line so far if their tops are within 3, it begins at most `gap` after the line's
    end (3 before), and their font sizes are within 1; the larger size and the union of boxes stay.
    """
    rows = F.transform(F.sort_array(F.collect_list(F.struct(F.bround("y0", 1).alias("a"), F.bround("x0", 1).alias("b"), "ord", "text", "x0", "y0", "x1", "y1", "font_size"))), lambda s: F.struct(s.text.alias("text"), s.x0.alias("x0"), s.y0.alias("y0"), s.x1.alias("x1"), s.y1.alias("y1"), s.font_size.alias("font_size")))

    def merges(a: Column, b: Column) -> Column:
        return (F.abs(a.y0 - b.y0) <= 3) & ((b.x0 - a.x1).between(-3, gap)) & (F.abs(a.font_size - b.font_size) <= 1)

    def merged(a: Column, b: Column) -> Column:
        return F.struct(T.join_lines(F.array(a.text, b.text)).alias("text"), *_box(a, b), F.greatest(a.font_size, b.font_size).alias("font_size"))

    found = lines.groupBy("doc_id", "page_no").agg(rows.alias("rows")).withColumn("out", _fold(F.col("rows"), _FRAGMENT, merges, merged))
    return found.select("doc_id", "page_no", F.posexplode("out").alias("n", "f")).select("doc_id", "page_no", "n", "f.*")


def coalesced_elements(chunks: DataFrame, stats: DataFrame) -> DataFrame:
    """(doc_id, page_no, n, kind, text, x0, y0, x1, y1): paragraphs that go on are one element.

    Held against the box and text merged so far. text is unescaped in, escaped out.
    """
    order = F.struct(F.bround("y0", 1).alias("a"), F.when(F.col("kind").isin("h1", "h2", "h3"), 0).otherwise(1).alias("b"), "chunk", "kind", T.unescape_html("text").alias("text"), "x0", "y0", "x1", "y1")
    rows = F.transform(F.sort_array(F.collect_list(order)), lambda s: F.struct(*(s[n].alias(n) for n in ("kind", "text", "x0", "y0", "x1", "y1"))))
    gap_limit = F.greatest(F.lit(10.0), F.col("line_gap") * 2.2)

    def merges(a: Column, b: Column) -> Column:
        p, t = T.strip(a.text), T.strip(b.text)
        close = F.greatest(F.lit(0.0), b.y0 - a.y1) <= gap_limit
        aligned = (F.abs(b.x0 - a.x0) <= 18) | (F.abs(b.x1 - a.x1) <= 36)
        apart = is_.list_item(t) | is_.numbered_paragraph(t) | is_.heading_text(p) | is_.heading_text(t)
        word = F.regexp_replace(F.lower(F.regexp_extract(p, r"(\S+)$", 1)), r"[^a-z.]+$", "")
        on = p.rlike("-$") | word.isin(*P.CONTINUATION_WORDS) | ~p.rlike(P.SENTENCE_END) | t.rlike(r"^(?:\d{4}|\d{1,2}[/-]\d{1,2}[/-]\d{2,4})\b")
        return (a.kind == "p") & (b.kind == "p") & (p != "") & (t != "") & close & aligned & ~apart & on

    def merged(a: Column, b: Column) -> Column:
        return F.struct(a.kind.alias("kind"), T.join_lines(F.array(T.strip(a.text), T.strip(b.text))).alias("text"), *_box(a, b))

    found = chunks.groupBy("doc_id", "page_no").agg(rows.alias("rows")).join(stats.select("doc_id", "line_gap"), "doc_id")
    found = found.select("doc_id", "page_no", _fold(F.col("rows"), _ELEMENT, merges, merged).alias("out"))
    found = found.select("doc_id", "page_no", F.posexplode("out").alias("n", "e")).select("doc_id", "page_no", "n", "e.*")
    return found.withColumn("text", T.escape_html("text"))


def offset_drift(lines: DataFrame, eps: float = 1.0) -> DataFrame:
    """(doc_id, page_no, ord, emitted, drift): gaps between words rounded to a step, the error carried on.

    lines: with gaps, an array of doubles. What a gap leaves over is added to the next one.
    """
    start = F.struct(F.lit(0.0).alias("drift"), F.array().cast("array<double>").alias("out"))

    def step(s: Column, gap: Column) -> Column:
        value = F.bround((gap + s.drift) / eps) * eps
        return F.struct((gap + s.drift - value).alias("drift"), F.concat(s.out, F.array(value)).alias("out"))

    found = lines.withColumn("end", F.aggregate("gaps", start, step))
    return found.select("doc_id", "page_no", "ord", F.col("end.out").alias("emitted"), F.col("end.drift").alias("drift"))
