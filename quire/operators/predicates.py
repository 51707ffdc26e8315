"""Boolean heuristics on lines. Each takes and gives Columns; columns are those of layout_lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import patterns as P
from quire.functions import text as T

HEADER_BAND, FOOTER_BAND = 0.12, 0.10
PAGE_WIDTH, PAGE_HEIGHT = 612.0, 792.0


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def in_header(height: float = PAGE_HEIGHT) -> Column:
    return F.col("y0") <= height * HEADER_BAND


def in_footer(height: float = PAGE_HEIGHT) -> Column:
    return F.col("y1") >= height * (1 - FOOTER_BAND)


def in_outer_margin(height: float = PAGE_HEIGHT) -> Column:
    return (F.col("y1") <= height * 0.08) | (F.col("y0") >= height * 0.92)


def page_marker(x) -> Column:
    return c(x).rlike(P.PAGE_MARKER)


def trailing_marker(x) -> Column:
    return c(x).rlike(P.TRAILING_MARKER)


def annotation(x) -> Column:
    return c(x).contains("qrserver.com") | c(x).rlike(P.ANNOTATION)


def bare_citation(x) -> Column:
    return c(x).rlike(P.BARE_CITATION)


def signature_artefact(x, low: Column | None = None) -> Column:
    """low: x normalized, in lower case, where a column has that already."""
    t = F.lower(T.normalize(x)) if low is None else low
    return t.contains("signature not verified") | t.contains("digitally signed by") | t.rlike("^reason:?$") | (t.contains("ist") & t.rlike(P.CLOCK))


def margin_noise(x) -> Column:
    t = F.lower(T.strip(x))
    return (t == "") | t.rlike(P.PAGE_NUMBER) | t.rlike(P.LINK)


def page_number(x, compat: bool = False, low: Column | None = None) -> Column:
    """A page number in the header or footer band. compat: tested after numbers were hidden, so never true."""
    low = F.lower(T.normalize(x)) if low is None else low
    t = T.numbers_hidden(low) if compat else low
    return (in_header() | in_footer()) & t.rlike(P.PAGE_NUMBER)


def side_margin_noise(x, width: float = PAGE_WIDTH) -> Column:
    t = T.strip(x)
    return (t == "") | ((F.length(t) <= 2) & t.rlike(P.SIDE_LETTER) & ((F.col("x0") < width * 0.08) | (F.col("x1") > width * 0.92)))


def watermark_text(x, width: float = PAGE_WIDTH, height: float = PAGE_HEIGHT, norm: Column | None = None) -> Column:
    """Place and size are tested before the text, as few lines are large."""
    t = T.normalize(x) if norm is None else norm
    label = (T.upper_share(t) >= 0.82) & T.words(t).between(1, 8) & ~t.rlike(P.SENTENCE_END)
    middle = F.col("y0").between(height * 0.18, height * 0.82) & (F.abs((F.col("y0") + F.col("y1")) * 0.5 - height * 0.5) <= height * 0.32)
    large = ((F.col("x1") - F.col("x0")) / width >= 0.34) & (F.col("font_size") >= 20)
    return F.coalesce(large & middle & (F.length(t) <= 90) & t.rlike("[A-Za-z]") & (label | t.rlike(P.WATERMARK_WORD)), F.lit(False))


def list_item(x) -> Column:
    t = T.strip(x)
    return ~t.rlike(P.YEAR_START) & t.rlike(P.LIST_ITEM)


def list_item_base(x) -> Column:
    return c(x).rlike(P.LIST_ITEM_BASE)


def ordered_item(x) -> Column:
    return c(x).rlike(P.ORDERED_ITEM)


def list_marker_stripped(x) -> Column:
    return T.strip(F.regexp_replace(c(x), P.LIST_ITEM_BASE, ""))


def numbered_paragraph(x) -> Column:
    return c(x).rlike(P.NUMBERED_PARAGRAPH)


def short_continuation(x) -> Column:
    t = T.strip(x)
    return ((F.length(t) <= 8) & t.rlike(P.SHORT_NUMBER)) | ((T.words(t) <= 3) & t.rlike(P.SHORT_MARK))


def numeric_continuation(x) -> Column:
    return T.strip(x).rlike(P.NUMERIC_CONTINUATION)


def paragraph_start(x) -> Column:
    t = T.strip(x)
    return list_item(t) | t.rlike(P.MULTILEVEL_START) | t.rlike(P.CAPITAL_RUN)


def visual_wrap(x1, right_edge) -> Column:
    return F.abs(c(x1) - c(right_edge)) <= 24.0


def caps_heading(x) -> Column:
    t = T.strip(x)
    return (t != "") & (F.length(t) <= 120) & T.is_upper(t) & (T.words(t) <= 12)


def heading_like(x, font, body_font, base: bool = False) -> Column:
    """base: the base converter's form, which also knows five labels."""
    t = T.strip(x)
    n = T.words(x)
    some = (c(font) >= c(body_font) + 2.5) | caps_heading(t) | t.rlike(P.NUMBERED_HEADING) | (t.rlike(":$") & (n <= 10))
    return n.between(1, 18) & ((some | t.rlike(P.HEADING_LABEL)) if base else some)


def heading_text(x) -> Column:
    """Text that paragraphs don't merge with."""
    t = T.strip(x)
    n = T.words(t)
    return (t != "") & (((n <= 10) & T.is_upper(t)) | (t.rlike(":$") & (n <= 12)) | t.rlike(P.LEGAL_LABEL))


def likely_continuation(prev, curr, wrapped=None, base: bool = False) -> Column:
    """wrapped: whether the line before ends at the right edge."""
    p, t = T.strip(prev), T.strip(curr)
    first = F.substring(t, 1, 1)
    upper = (first == F.upper(first)) & (first != F.lower(first))
    item = list_item_base(t) if base else list_item(t)
    rest = (~p.rlike(P.SENTENCE_END)) | (F.lit(False) if wrapped is None else wrapped & ~paragraph_start(t))
    after = F.when(p.rlike("[:;]$") & upper, False).when(p.rlike("-$") | T.starts_lower(t), True).otherwise(rest)
    short = F.lit(False) if base else short_continuation(t)
    return F.when((p == "") | (t == "") | item, False).when(short, True).otherwise(after)


def near(a, b, eps: float = 1e-6) -> Column:
    return F.abs(c(a) - c(b)) <= eps


def scanned(chars, least: int = 200) -> Column:
    return F.coalesce(c(chars), F.lit(0)) < least
