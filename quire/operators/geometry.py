"""Arithmetic of text state: snapping, rescaled fonts, shifts of lines, borders, character boxes, visible pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import predicates as is_
from .regions import multiply, transform_box

EPS = 1e-6
CHAR_INSET = 0.1


def snapped(x: Column) -> Column:
    """x, or 0 where it is within EPS of 0."""
    return F.when(F.abs(x) <= EPS, 0.0).otherwise(x)


def rescaled_font(m: list[Column], size: Column, factor: Column) -> tuple[Column, Column, list[Column]]:
    """(scale, size, matrix): the height that the matrix gives to (0, 1) goes over to the font size, so that the
    matrix only turns and slants; a negative size becomes positive by turning the matrix.

    factor: the scale that browsers apply. A height of 0 leaves size and matrix as they are.
    """
    height = F.hypot(m[2], m[3]) / factor
    scale = F.when(height > EPS, height).otherwise(1.0)
    sign = F.when(size * scale < -EPS, -1.0).otherwise(1.0)
    return scale, sign * size * scale, [sign * x / scale for x in m[:4]]


def shift_between(old: list[Column], new: list[Column], old_at: tuple[Column, Column], new_at: tuple[Column, Column]) -> tuple[Column, Column]:
    """(dx, dy): how far, measured under the old map, new_at under the new map lies from old_at under the old one.
    Null where the old map is singular."""
    det = old[0] * old[3] - old[1] * old[2]
    x = new[0] * new_at[0] + new[2] * new_at[1] + new[4] - old[0] * old_at[0] - old[2] * old_at[1] - old[4]
    y = new[1] * new_at[0] + new[3] * new_at[1] + new[5] - old[1] * old_at[0] - old[3] * old_at[1] - old[5]
    guarded = lambda e: F.when(F.abs(det) > EPS, e)
    return guarded((old[3] * x - old[2] * y) / det), guarded((old[0] * y - old[1] * x) / det)


def lines_merge(dx: Column, dy: Column, old_em: Column, old_band: tuple[Column, Column], band: tuple[Column, Column], threshold: float = 0.125) -> Column:
    """Whether text goes on in the line: on its baseline, or not far to the left and with overlapping heights.
    Bands are (lowest, highest) around their own baselines. Null shifts don't merge."""
    beside = (dx >= -threshold * old_em - EPS) & (dy + band[0] <= old_band[1] + EPS) & (dy + band[1] >= old_band[0] - EPS)
    return F.coalesce((F.abs(dy) <= EPS) | beside, F.lit(False))


def colour_distance(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Distance of two colours of components 0 to 1, at most 1."""
    return F.sqrt(sum(((x - y) * (x - y) for x, y in zip(a, b, strict=True)), F.lit(0.0)) / 3.0)


def bordered_box(x0: Column, y0: Column, x1: Column, y1: Column, border: Column) -> list[Column]:
    """[x, y, width, height, border above and below, border beside]: a box with a border centred on its edges, as
    CSS draws it. A side that is thinner than the border is all border."""
    width, height = x1 - x0, y1 - y0
    side = lambda n: (F.when(n > border, n - border).otherwise(0.0), F.when(n > border, border).otherwise(border + n / 2))
    (w, beside), (h, above) = side(width), side(height)
    return [x0 - border / 2, y0 - border / 2, w, h, above, beside]


def character_box(page: list[Column], text: list[Column], at: tuple[Column, Column], size: Column, stretch: Column, width: Column, height: Column) -> list[Column]:
    """The upright box on the page of a character, without CHAR_INSET of its width and height at each side."""
    zero = F.lit(0.0)
    whole = multiply(page, multiply(text, [size * stretch, zero, zero, size, *at]))
    return transform_box(whole, [CHAR_INSET * width, CHAR_INSET * height, (1 - CHAR_INSET) * width, (1 - CHAR_INSET) * height])


def space_offset(word_space: Column, letter_space: Column, em_size: Column, space_width: Column, font_size: Column) -> Column:
    """How far a single space moves on; a font without an em has no width of its own."""
    return word_space + letter_space + F.when(em_size != 0, space_width * font_size).otherwise(0.0)


def em_height(font_size: Column, ascent: Column, descent: Column) -> Column:
    return font_size * (ascent - descent)


def text_scales(zoom: Column, multiplier: Column) -> tuple[Column, Column]:
    """(drawn, rest): text is drawn at the larger of zoom and multiplier, and scaled by the rest."""
    drawn = F.greatest(zoom, multiplier)
    return drawn, zoom / drawn


def inverse(m: list[Column]) -> list[Column]:
    """The map that undoes m; null where there is none."""
    det = m[0] * m[3] - m[1] * m[2]
    cells = [m[3] / det, -m[1] / det, -m[2] / det, m[0] / det, (m[2] * m[5] - m[3] * m[4]) / det, (m[1] * m[4] - m[0] * m[5]) / det]
    return [F.when(F.abs(det) > EPS, x) for x in cells]


def advances(lines: DataFrame, width: Column, letter_space: Column, word_space: Column) -> DataFrame:
    """lines with `offsets`: where each character of text begins, a running sum of the advances before it; and
    `advance`, the whole line's. A space also moves on by word_space."""
    chars = F.split("text", "")
    step = F.transform(chars, lambda c: width + letter_space + F.when(c == " ", word_space).otherwise(0.0))
    summed = F.aggregate("steps", F.struct(F.array().cast("array<double>").alias("offsets"), F.lit(0.0).alias("at")),
                         lambda s, x: F.struct(F.array_append(s["offsets"], s["at"]).alias("offsets"), (s["at"] + x).alias("at")))
    found = lines.withColumn("steps", step).withColumn("sums", summed)
    return found.select(*lines.columns, F.col("sums.offsets").alias("offsets"), F.col("sums.at").alias("advance"))


def line_states(states: DataFrame, *by: str) -> DataFrame:
    """states (by, ord, font, size, a, b, c, d, clip) with `state`: 0 goes on, 1 new state (font or size), 2 new line
    (matrix), 3 new clip; the gravest change against the state before counts. The first of a group is 3."""
    w = Window.partitionBy(*by).orderBy("ord")
    before = lambda x: F.lag(x).over(w)
    turned = F.lit(False)
    for x in "abcd":
        turned = turned | ~is_.near(F.col(x), before(x))
    gravest = F.greatest(
        F.when(F.col("clip") != before("clip"), 3).otherwise(0), F.when(turned, 2).otherwise(0),
        F.when((F.col("font") != before("font")) | ~is_.near(F.col("size"), before("size")), 1).otherwise(0),
    )
    return states.withColumn("state", F.when(before("font").isNull(), 3).otherwise(gravest))


def visible_page(pages: DataFrame, views: DataFrame) -> DataFrame:
    """(doc_id, view, page_no): the page that a view (doc_id, view, top, bottom, current) shows most of.

    pages: (doc_id, page_no, top, bottom). The current page stays while it is wholly visible, and where none is
    visible; of pages that show the same share the first counts. A document's views meet its own pages only.
    """
    both = views.join(pages.select("doc_id", "page_no", F.col("top").alias("y0"), F.col("bottom").alias("y1")), "doc_id")
    share = (F.least("bottom", "y1") - F.greatest("top", "y0")) / (F.col("y1") - F.col("y0"))
    seen = both.where("y0 <= bottom AND y1 >= top").select("doc_id", "view", "current", "page_no", share.alias("share"))
    stays = F.bool_or((F.col("page_no") == F.col("current")) & (F.abs(F.col("share") - 1) <= EPS))
    best = F.max_by("page_no", F.struct("share", -F.col("page_no")))
    found = seen.where("share > 0").groupBy("doc_id", "view").agg(F.when(stays, F.first("current")).otherwise(best).alias("page_no"))
    return views.join(found, ["doc_id", "view"], "left").select("doc_id", "view", F.coalesce("page_no", "current").alias("page_no"))
