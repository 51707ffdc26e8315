"""Fonts, images, links, forms and blocks: what a page has besides its lines of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T

OPACITY = 0.5
#: Border styles of annotations in CSS.
BORDERS = {"solid": "border-style:solid;", "dashed": "border-style:dashed;", "beveled": "border-style:outset;", "inset": "border-style:inset;", "underlined": "border-style:none;border-bottom-style:solid;"}


def border_style(kind: Column) -> Column:
    """CSS of an annotation's border; an unknown kind is solid."""
    found = F.lit(BORDERS["solid"])
    for name, css in BORDERS.items():
        found = F.when(kind == name, css).otherwise(found)
    return found


def text_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks that hold text: of type 0, with at least one line."""
    return blocks.where((F.col("type") == 0) & (F.size("lines") > 0))


def exploded_spans(blocks: DataFrame) -> DataFrame:
    """(doc_id, page_no, block_no, line_no, span_no, text, font, size) of nested blocks -> lines -> spans."""
    rows = blocks.select("doc_id", "page_no", "block_no", F.posexplode("lines").alias("line_no", "line"))
    rows = rows.select("doc_id", "page_no", "block_no", "line_no", F.posexplode("line.spans").alias("span_no", "span"))
    return rows.select("doc_id", "page_no", "block_no", "line_no", "span_no", "span.text", "span.font", "span.size")


def font_styles(font: Column) -> tuple[Column, Column]:
    """(weight, slant) that a font's name tells, in any case: oblique goes before italic."""
    low = F.lower(font)
    slant = F.when(low.contains("oblique"), "oblique").when(low.contains("italic"), "italic").otherwise("normal")
    return F.when(low.contains("bold"), "bold").otherwise("normal"), slant


def used_codes(spans: DataFrame) -> DataFrame:
    """(font, code): the different character codes that a font's spans use. Spans' codes are made different before
    they are exploded and shuffled."""
    codes = F.array_distinct(F.transform(F.filter(F.split("text", ""), lambda c: c != ""), lambda c: F.ascii(c)))
    return spans.select("font", F.explode(codes).alias("code")).distinct()


def font_codes(used: DataFrame, fonts: DataFrame, encoding: DataFrame) -> DataFrame:
    """(font, id, n_codes, n_encoded): each used font's id, and how many of its codes its encoding has.

    fonts: (font, id); encoding: (font, code). A font without an entry has a null id.
    """
    told = used.join(encoding.select("font", "code"), ["font", "code"], "left_semi").groupBy("font").agg(F.count("*").alias("n_encoded"))
    found = used.groupBy("font").agg(F.count("*").alias("n_codes")).join(told, "font", "left").join(fonts, "font", "left")
    return found.select("font", "id", "n_codes", F.coalesce("n_encoded", F.lit(0)).alias("n_encoded"))


def utf8_hex(code: Column) -> Column:
    """The UTF-8 bytes of a code point below 2 ** 16 other than a surrogate, as lower-case hex digits."""
    tail = lambda shift: 128 + F.shiftright(code, shift).bitwiseAND(63)
    byte = lambda x: F.lpad(F.hex(x), 2, "0")
    two = F.concat(byte(192 + F.shiftright(code, 6)), byte(tail(0)))
    three = F.concat(byte(224 + F.shiftright(code, 12)), byte(tail(6)), byte(tail(0)))
    return F.lower(F.when(code < 0x80, byte(code)).when(code < 0x800, two).otherwise(three))


def node_count(markup: Column, limit: int) -> tuple[Column, Column]:
    """(nodes, fallback): how many tags begin in markup, and whether they exceed the limit (0: none), so that
    a page is drawn as a bitmap."""
    n = F.length(markup) - F.length(F.replace(markup, F.lit("<"), F.lit("")))
    return n, (n > limit) & F.lit(limit > 0)


def references(bitmaps: DataFrame, uses: DataFrame) -> DataFrame:
    """bitmaps (bitmap) with n, how often uses (bitmap) name it, and temporary: never."""
    counts = uses.groupBy("bitmap").agg(F.count("*").alias("n"))
    return bitmaps.join(counts, "bitmap", "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("temporary", F.col("n") == 0)


def written(assets: DataFrame, kept: DataFrame, key: str = "src") -> DataFrame:
    """assets with `kept`: whether their key is among those of kept; the others aren't written at all."""
    return assets.join(kept.select(key, F.lit(True).alias("kept")).distinct(), key, "left").withColumn("kept", F.coalesce("kept", F.lit(False)))


def counted_shapes(drawings: DataFrame) -> DataFrame:
    """drawings (fill, stroke, opacity, grouped) with `covers` (its opacity is at least OPACITY, so that it hides
    text) and `clipped` (what it draws counts as clipped: in a transparency group, or not wholly opaque)."""
    return drawings.withColumn("covers", (F.col("fill") | F.col("stroke")) & (F.col("opacity") >= OPACITY)).withColumn("clipped", F.col("grouped") | (F.col("opacity") < 1))


def anchors(links: DataFrame, named: DataFrame) -> DataFrame:
    """(doc_id, link, html): links as anchors around a box.

    links: (doc_id, link, uri, name, detail, style, x, y, w, h); named: (doc_id, name, page_no). A link to a name
    leads to its page; one that leads nowhere is the box alone.
    """
    both = links.join(named, ["doc_id", "name"], "left")
    href = F.coalesce("uri", F.concat(F.lit("#pf"), F.lower(F.hex("page_no"))), F.lit(""))
    detail = F.when(F.coalesce("detail", F.lit("")) != "", F.concat(F.lit(" data-dest-detail='"), "detail", F.lit("'"))).otherwise("")
    px = lambda name, x: F.concat(F.lit(f"{name}:"), F.format_string("%.2f", F.col(x)), F.lit("px;"))
    box = F.concat(F.lit('<div class="d" style="'), border_style(F.col("style")), px("left", "x"), px("bottom", "y"), px("width", "w"), px("height", "h"), F.lit('"></div>'))
    whole = F.concat(F.lit('<a class="l" href="'), T.escape_attribute(href), F.lit('"'), detail, F.lit(">"), box, F.lit("</a>"))
    return both.select("doc_id", "link", F.when(href == "", box).otherwise(whole).alias("html"))


def inputs(fields: DataFrame) -> DataFrame:
    """(doc_id, page_no, field, html): form fields (type, x0, y0, x1, y1) as inputs; buttons are 3 larger, fields of
    other types are left out."""
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    px = lambda name, x: F.concat(F.lit(f"{name}:"), F.format_string("%.2f", x), F.lit("px;"))
    name = F.concat(F.when(F.col("type") == "text", "text-").otherwise("cb-"), "page_no", F.lit("-"), "field")
    place = F.concat(F.lit("position:absolute;"), px("left", F.col("x0")), px("bottom", F.col("y0")))
    text = F.concat(F.lit('<input id="'), name, F.lit('" type="text" value="" style="'), place, px("width", w), px("height", h), px("line-height", h), px("font-size", h / 2), F.lit('"/>'))
    button = F.concat(F.lit('<div id="'), name, F.lit('" style="'), place, px("width", w + 3), px("height", h + 3), F.lit('background-size:cover;"></div>'))
    return fields.where(F.col("type").isin("text", "button")).select("doc_id", "page_no", "field", F.when(F.col("type") == "text", text).otherwise(button).alias("html"))


def page_flow(chunks: DataFrame, tables: DataFrame) -> DataFrame:
    """(doc_id, page_no, place, kind, text): text chunks and tables (doc_id, page_no, y0, html) of a page in one
    flow, from above; at equal heights tables come first."""
    rows = chunks.select("doc_id", "page_no", "y0", F.lit(1).alias("what"), F.col("chunk").alias("n"), "kind", "text")
    rows = rows.unionByName(tables.select("doc_id", "page_no", "y0", F.lit(0).alias("what"), F.lit(0).alias("n"), F.lit("table").alias("kind"), F.col("html").alias("text")))
    parts = rows.groupBy("doc_id", "page_no").agg(F.sort_array(F.collect_list(F.struct("y0", "what", "n", "kind", "text"))).alias("parts"))
    return parts.select("doc_id", "page_no", F.posexplode("parts").alias("place", "p")).select("doc_id", "page_no", "place", "p.kind", "p.text")
