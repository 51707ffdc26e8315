"""Boxes: overlap, covering, watermarks, tables, affine maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T

WATERMARK_AREA = 0.22
IMAGE_LEAST = 28.0


def intersection(a: list[Column], b: list[Column]) -> Column:
    """The common box of two boxes of any corner order, as a struct; null unless it has an area."""
    low = lambda i: F.greatest(F.least(a[i], a[i + 2]), F.least(b[i], b[i + 2]))
    high = lambda i: F.least(F.greatest(a[i], a[i + 2]), F.greatest(b[i], b[i + 2]))
    box = F.struct(low(0).alias("x0"), low(1).alias("y0"), high(0).alias("x1"), high(1).alias("y1"))
    return F.when((low(0) < high(0)) & (low(1) < high(1)), box)


def transform_point(m: list[Column], x: Column, y: Column, delta: bool = False) -> tuple[Column, Column]:
    """(x, y) under the affine map m; delta: without its translation."""
    return m[0] * x + m[2] * y + (0.0 if delta else m[4]), m[1] * x + m[3] * y + (0.0 if delta else m[5])


def multiply(a: list[Column], b: list[Column]) -> list[Column]:
    """The map that applies b, then a."""
    return [
        a[0] * b[0] + a[2] * b[1], a[1] * b[0] + a[3] * b[1], a[0] * b[2] + a[2] * b[3], a[1] * b[2] + a[3] * b[3],
        a[4] + a[0] * b[4] + a[2] * b[5], a[5] + a[1] * b[4] + a[3] * b[5],
    ]


def transform_box(m: list[Column], box: list[Column]) -> list[Column]:
    """The smallest upright box around a mapped box: least and greatest of its four corners."""
    corners = [transform_point(m, box[i], box[j]) for i in (0, 2) for j in (1, 3)]
    xs, ys = zip(*corners, strict=True)
    return [F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)]


def covered_characters(chars: DataFrame, shapes: DataFrame, mode: int = 1, cell: float = 64.0) -> DataFrame:
    """(doc_id, page_no, seq, visible, covered) of each character box.

    A shape drawn later hides the corners that lie in it. visible: mask of the corners left (1, 2, 4, 8 from
    the top left, clockwise). covered: none is left, or in mode 2 not all. A range join in cells of the page,
    reduced by bit_or: shapes are never gathered beside a character.
    """
    cells = lambda: F.explode(F.sequence(F.floor(F.col("y0") / cell), F.floor(F.col("y1") / cell))).alias("cell")
    a = chars.select("doc_id", "page_no", "seq", "x0", "y0", "x1", "y1", cells()).alias("a")
    b = shapes.select("doc_id", "page_no", "seq", "x0", "y0", "x1", "y1", cells()).alias("b")
    same = (F.col("a.doc_id") == F.col("b.doc_id")) & (F.col("a.page_no") == F.col("b.page_no")) & (F.col("a.cell") == F.col("b.cell")) & (F.col("b.seq") > F.col("a.seq"))
    meets = (F.col("a.x0") < F.col("b.x1")) & (F.col("b.x0") < F.col("a.x1")) & (F.col("a.y0") < F.col("b.y1")) & (F.col("b.y0") < F.col("a.y1"))

    def bit(value: int, x: str, y: str) -> Column:
        inside = F.col(f"a.{x}").between(F.col("b.x0"), F.col("b.x1")) & F.col(f"a.{y}").between(F.col("b.y0"), F.col("b.y1"))
        return F.when(inside, value).otherwise(0)

    mask = bit(1, "x0", "y0") + bit(2, "x1", "y0") + bit(4, "x1", "y1") + bit(8, "x0", "y1")
    hidden = a.join(b, same & meets).groupBy("a.doc_id", "a.page_no", "a.seq").agg(F.bit_or(mask).alias("hidden"))
    found = chars.join(hidden, ["doc_id", "page_no", "seq"], "left")
    visible = (F.lit(15) - F.coalesce("hidden", F.lit(0))).cast("int")
    return found.select("doc_id", "page_no", "seq", visible.alias("visible"), ((visible == 0) | ((visible != 15) & F.lit(mode == 2))).alias("covered"))


def distinct_images(images: DataFrame) -> DataFrame:
    """Images of 28 points or more each way, of those with equal whole-number boxes on a page the first."""
    large = images.where((F.col("xref") != 0) & (F.col("x1") - F.col("x0") >= IMAGE_LEAST) & (F.col("y1") - F.col("y0") >= IMAGE_LEAST))
    box = [F.col(x).cast("int").alias(f"i{x}") for x in ("x0", "y0", "x1", "y1")]
    first = large.groupBy("doc_id", "page_no", *box).agg(F.min("idx").alias("idx")).select("doc_id", "page_no", "idx")
    return large.join(first, ["doc_id", "page_no", "idx"], "left_semi")


def watermark_images(images: DataFrame, lines: DataFrame, width: float = 612.0, height: float = 792.0, base: bool = False) -> DataFrame:
    """(doc_id, page_no, idx, overlaps, watermark): how many text lines an image meets, and whether it is a
    background mark. base: the base converter also drops images as large as the page over much text."""
    same = (F.col("i.doc_id") == F.col("l.doc_id")) & (F.col("i.page_no") == F.col("l.page_no"))
    meets = (F.col("i.x0") < F.col("l.x1")) & (F.col("l.x0") < F.col("i.x1")) & (F.col("i.y0") < F.col("l.y1")) & (F.col("l.y0") < F.col("i.y1"))
    large = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")) / (width * height) >= WATERMARK_AREA  # counted only for these
    hits = images.where(large).alias("i").join(lines.alias("l"), same & meets).groupBy("i.doc_id", "i.page_no", "i.idx").agg(F.count("*").alias("overlaps"))
    n = lines.groupBy("doc_id", "page_no").agg(F.count("*").alias("n_lines"))
    found = images.join(hits, ["doc_id", "page_no", "idx"], "left").join(n, ["doc_id", "page_no"], "left")
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")) / (width * height)
    count = F.coalesce("overlaps", F.lit(0))
    share = F.coalesce(count / F.col("n_lines"), F.lit(0.0))
    centre = (F.abs((F.col("x0") + F.col("x1")) * 0.5 - width * 0.5) <= width * 0.22) & (F.abs((F.col("y0") + F.col("y1")) * 0.5 - height * 0.5) <= height * 0.22)
    marks = F.lower(F.coalesce("colorspace", F.lit(""))).contains("gray") | ((share >= 0.35) & (area >= 0.16)) | ((share <= 0.12) & (area >= 0.30))
    watermark = (area >= WATERMARK_AREA) & centre & marks
    if base:
        whole = ((F.col("x1") - F.col("x0")) / width >= 0.88) & ((F.col("y1") - F.col("y0")) / height >= 0.88)
        watermark = watermark | (whole & (count >= F.greatest(F.lit(8), F.floor(F.coalesce("n_lines", F.lit(0)) * 0.25))))
    return found.select("doc_id", "page_no", "idx", count.cast("long").alias("overlaps"), watermark.alias("watermark"))


def plausible_table(rows: Column) -> Column:
    """Whether an array of rows of cells is a table: two rows and columns, filled enough."""
    full = F.filter(rows, lambda r: F.size(r) > 0)
    columns = F.coalesce(F.array_max(F.transform(full, F.size)), F.lit(0))
    cells = F.flatten(full)
    told = F.size(F.filter(cells, lambda c: F.coalesce(T.normalize(c), F.lit("")) != ""))
    dense = told / F.greatest(F.size(cells), F.lit(1))
    return (F.size(full) >= 2) & (columns >= 2) & (F.size(cells) > 0) & ~((columns >= 6) & (dense < 0.45)) & (told / F.greatest(F.size(full), F.lit(1)) >= 1.8)


def box_union(lines: DataFrame, *by: str) -> DataFrame:
    return lines.groupBy(*by).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
