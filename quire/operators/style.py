"""Style dictionaries, running metrics, clip runs, outlines and link destinations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def dictionary(values: DataFrame, value: str, *order: str) -> DataFrame:
    """(value, id): each different value with a dense id in the order of its first occurrence.

    The aggregate goes first, so the numbering window holds different values only.
    """
    first = values.groupBy(value).agg(F.min(F.struct(*order)).alias("first"))
    return first.select(value, (F.row_number().over(Window.orderBy("first")) - 1).cast("int").alias("id"))


def css_rules(names: DataFrame, value: str, prefix: str, prop: str, unit: str = "px") -> DataFrame:
    """(ord, rule): a CSS class for each dictionary entry, by ascending value."""
    rule = F.concat(F.lit(f".{prefix}"), F.lower(F.hex("id")), F.lit(f"{{{prop}:"), F.format_string("%.6f", F.col(value)), F.lit(f"{unit};}}"))
    return names.select((F.row_number().over(Window.orderBy(value)) - 1).cast("int").alias("ord"), rule.alias("rule"))


def most_used_width(offsets: DataFrame, by: str, width: str, eps: float = 1e-6) -> DataFrame:
    """(by, width, n): the most frequent width in buckets of eps, the smallest on ties; null where it isn't
    more than half or not positive."""
    bucket = F.round(F.col(width) / eps).cast("long")
    counts = offsets.groupBy(by, bucket.alias("bucket")).agg(F.count("*").alias("n"), F.min(width).alias("width"))
    best = counts.groupBy(by).agg(F.max_by("width", F.struct("n", -F.col("width"))).alias("width"), F.max("n").alias("n"), F.sum("n").alias("total"))
    return best.select(by, F.when((F.col("n") > F.floor(F.col("total") / 2)) & (F.col("width") > eps), F.col("width")).alias("width"), "n")


def line_metrics(states: DataFrame, *by: str) -> DataFrame:
    """(by, ascent, descent): extremes of the running vertical alignment plus font metric times size, 0 at least."""
    upto = F.sum("vertical_align").over(Window.partitionBy(*by).orderBy("ord").rowsBetween(Window.unboundedPreceding, 0))
    rows = states.withColumn("upto", upto)
    return rows.groupBy(*by).agg(
        F.greatest(F.lit(0.0), F.max(F.col("upto") + F.col("ascent") * F.col("font_size"))).alias("ascent"),
        F.least(F.lit(0.0), F.min(F.col("upto") + F.col("descent") * F.col("font_size"))).alias("descent"),
    )


def clip_of_lines(lines: DataFrame, runs: DataFrame, by: str = "doc_id") -> DataFrame:
    """lines (by, ord) with the clip of the run that began last; runs: (by, start, clip).

    As-of by one window over both, carrying the last clip on; no inequality join.
    """
    both = lines.select(by, "ord", F.lit(None).cast("int").alias("clip"), F.lit(1).alias("what")).unionByName(runs.select(by, F.col("start").alias("ord"), "clip", F.lit(0).alias("what")))
    w = Window.partitionBy(by).orderBy("ord", "what").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("clip", F.last("clip", True).over(w)).where("what = 1").select(by, "ord", "clip")


def outline_paths(spark: SparkSession, items: DataFrame) -> DataFrame:
    """(item_id, depth, path): of each bookmark (item_id, parent_id, ord, title) the titles above it."""
    return spark.sql("""
        WITH RECURSIVE tree(item_id, depth, path) AS (
          SELECT item_id, 1, title FROM {items} WHERE parent_id IS NULL
          UNION ALL
          SELECT c.item_id, t.depth + 1, concat(t.path, ' / ', c.title) FROM {items} c JOIN tree t ON c.parent_id = t.item_id)
        SELECT * FROM tree""", items=items)  # fmt: skip


def _number(x: Column) -> Column:
    """As C++ streams print it (six significant digits, whole numbers without a point); null as null."""
    return F.when(x.isNull(), "null").when(x == F.floor(x), F.format_string("%d", x.cast("long"))).otherwise(F.regexp_replace(F.format_string("%.3f", x), r"0+$", ""))


def destination(kind: Column, page: Column, left: Column, bottom: Column, right: Column, top: Column, zoom: Column) -> Column:
    """A link destination as a JSON array; empty without a page."""
    parts = {"XYZ": [left, top, zoom], "Fit": [], "FitH": [top], "FitV": [left], "FitR": [left, bottom, right, top], "FitB": [], "FitBH": [top], "FitBV": [left]}
    body = F.lit("")
    for name, numbers in parts.items():
        body = F.when(kind == name, F.concat_ws(",", F.lit(f',"{name}"'), *map(_number, numbers))).otherwise(body)
    return F.when(page <= 0, "").otherwise(F.concat(F.lit("["), page.cast("string"), body, F.lit("]")))


def zoom(zoom_: Column, fit_width: Column, fit_height: Column, width: Column, height: Column) -> Column:
    """The least of the factors that are given and positive, or 1."""
    given = lambda x, y: F.when(x > 1e-6, y)
    return F.coalesce(F.array_min(F.array(given(zoom_, zoom_), given(fit_width, fit_width / width), given(fit_height, fit_height / height))), F.lit(1.0))


def clamped_dpi(dpi: Column, width: Column, height: Column) -> Column:
    return F.least(dpi, 72.0 * 9000 / F.greatest(width, height))


def generic_family(fixed: Column, serif: Column) -> Column:
    return F.when(fixed, "monospace").when(serif, "serif").otherwise("sans-serif")


def render_mode(mode: Column) -> tuple[Column, Column]:
    """(fill, stroke) of text render modes 0 to 7."""
    return mode.isin(0, 2, 4, 6), mode.isin(1, 2, 5, 6)
