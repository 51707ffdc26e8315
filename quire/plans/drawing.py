"""Queries on text state, geometry, fonts, links, forms and batches, over lines of the whole texts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import assets, geometry, records, regions, segments, stats, style
from quire.operators import predicates as is_

from . import oracle as O
from .registry import docs, lines, query, tables

L = O.with_(O.LINES_SQL)
K = "doc_id, page_no, ord, "
KEYS = ("doc_id", "page_no", "ord")


def d_(x: float):
    return F.lit(float(x))


@query(L + f"SELECT {K}CASE WHEN abs((x0 - 72) * 1e-8::DOUBLE) <= 1e-6::DOUBLE THEN 0 ELSE (x0 - 72) * 1e-8::DOUBLE END::DOUBLE AS snapped, round(sqrt(x0 * x0 + y0 * y0), 6) AS reach, abs(x0 - 72) <= 1e-6::DOUBLE AS indented FROM lines")
def snap_and_reach(spark, d):
    return lines(spark, d).select(*KEYS, geometry.snapped((F.col("x0") - 72) * 1e-8).alias("snapped"), F.round(F.hypot("x0", "y0"), 6).alias("reach"), is_.near(F.col("x0"), F.lit(72.0)).alias("indented"))


TM = {"a": "font_size / 11.0 * (1 - ord % 2 * 2)", "b": "ord % 3 - 1.0", "c": "0.25 * (ord % 4)", "d": "(ord % 5 - 1) * 0.5"}


@query(L + f", m AS (SELECT {K}font_size, (font_size / 11.0::DOUBLE * (1 - ord % 2 * 2))::DOUBLE AS a, (ord % 3 - 1)::DOUBLE AS b, (0.25::DOUBLE * (ord % 4))::DOUBLE AS c, ((ord % 5 - 1) * 0.5::DOUBLE)::DOUBLE AS d FROM lines), h AS (SELECT *, sqrt(c * c + d * d) / 0.5::DOUBLE AS h FROM m), s AS (SELECT *, CASE WHEN h > 1e-6::DOUBLE THEN h ELSE 1 END AS s, CASE WHEN ord % 7 = 0 THEN -font_size ELSE font_size END AS size FROM h) SELECT {K}round(s, 6) AS scale, round(abs(size * s), 6) AS size, round(sign(size) * a / s, 6) + 0 AS a, round(sign(size) * b / s, 6) + 0 AS b, round(sign(size) * c / s, 6) + 0 AS c, round(sign(size) * d / s, 6) + 0 AS d FROM s")
def font_rescale(spark, d):
    rows = lines(spark, d).selectExpr(*KEYS, "CASE WHEN ord % 7 = 0 THEN -font_size ELSE font_size END AS font_size", *(f"double({x}) AS {n}" for n, x in TM.items()))
    scale, size, m = geometry.rescaled_font([F.col(x) for x in "abcd"], F.col("font_size"), d_(0.5))
    return rows.select(*KEYS, F.round(scale, 6).alias("scale"), F.round(size, 6).alias("size"), *((F.round(x, 6) + 0.0).alias(n) for n, x in zip("abcd", m, strict=True)))


@query(L + f", p AS (SELECT *, lag(x0) OVER w AS px, lag(y0) OVER w AS py, lag(font_size) OVER w AS ps FROM lines WINDOW w AS (PARTITION BY doc_id, page_no ORDER BY ord)), s AS (SELECT *, 2 * x0 + 0.5::DOUBLE * y0 - 2 * px - 0.5::DOUBLE * py AS lx, 4 * y0 - 4 * py AS ly FROM p WHERE px IS NOT NULL), q AS (SELECT {K}font_size, ps, (4 * lx - 0.5::DOUBLE * ly) / 8 AS dx, 2 * ly / 8 AS dy FROM s) SELECT {K}round(dx, 6) + 0 AS dx, round(dy, 6) + 0 AS dy, abs(dy) <= 1e-6::DOUBLE OR (dx >= -0.125::DOUBLE * ps - 1e-6::DOUBLE AND dy - 0.25::DOUBLE * font_size <= 0.75::DOUBLE * ps * 3 + 1e-6::DOUBLE AND dy + 0.75::DOUBLE * font_size >= -0.25::DOUBLE * ps - 1e-6::DOUBLE) AS merged FROM q")
def position_shift(spark, d):
    w = Window.partitionBy("doc_id", "page_no").orderBy("ord")
    rows = lines(spark, d).select(*KEYS, "x0", "y0", "font_size", *(F.lag(x).over(w).alias(f"p_{x}") for x in ("x0", "y0", "font_size"))).where("p_x0 IS NOT NULL")
    m = [d_(x) for x in (2, 0, 0.5, 4, 7, 9)]
    dx, dy = geometry.shift_between(m, m, (F.col("p_x0"), F.col("p_y0")), (F.col("x0"), F.col("y0")))
    rows = rows.withColumn("dx", dx).withColumn("dy", dy)
    old, new = F.col("p_font_size"), F.col("font_size")
    merged = geometry.lines_merge(F.col("dx"), F.col("dy"), geometry.em_height(old, d_(0.75), d_(-0.25)), (-0.25 * old, 0.75 * old * 3), (-0.25 * new, 0.75 * new))
    return rows.select(*KEYS, (F.round("dx", 6) + 0.0).alias("dx"), (F.round("dy", 6) + 0.0).alias("dy"), merged.alias("merged"))


_KINDS = ("solid", "dashed", "beveled", "inset", "underlined", "odd")


@query(L + f", c AS (SELECT *, (ord * 10 % 256)::INT AS r, length(text)::INT AS g, (block_no % 256)::INT AS b FROM lines) SELECT {K}round(sqrt(((r / 255.0::DOUBLE - 1) * (r / 255.0::DOUBLE - 1) + (g / 255.0::DOUBLE - 1) * (g / 255.0::DOUBLE - 1) + (b / 255.0::DOUBLE - 1) * (b / 255.0::DOUBLE - 1)) / 3), 6) AS to_white, CASE WHEN flags = 2 THEN 'transparent' ELSE 'rgb(' || r || ',' || g || ',' || b || ')' END AS colour, CASE ord % 6 WHEN 1 THEN 'border-style:dashed;' WHEN 2 THEN 'border-style:outset;' WHEN 3 THEN 'border-style:inset;' WHEN 4 THEN 'border-style:none;border-bottom-style:solid;' ELSE 'border-style:solid;' END AS border, CASE WHEN flags = 16 THEN 'monospace' WHEN flags = 0 THEN 'serif' ELSE 'sans-serif' END AS family FROM c")
def colour_styles(spark, d):
    rows = lines(spark, d).selectExpr(*KEYS, "ord * 10 % 256 AS r", "length(text) AS g", "block_no % 256 AS b", "flags", f"element_at(array({', '.join(map(repr, _KINDS))}), ord % 6 + 1) AS kind")
    rgb = [F.col(x) / 255.0 for x in "rgb"]
    return rows.select(*KEYS, F.round(geometry.colour_distance(rgb, [d_(1)] * 3), 6).alias("to_white"), T.css_colour(F.col("r"), F.col("g"), F.col("b"), F.col("flags") == 2).alias("colour"),
                       assets.border_style(F.col("kind")).alias("border"), style.generic_family(F.col("flags") == 16, F.col("flags") == 0).alias("family"))


@query(L + f", b AS (SELECT *, (1 + ord % 20)::DOUBLE AS t FROM lines) SELECT {K}x0 - t / 2 AS x, y0 - t / 2 AS y, CASE WHEN x1 - x0 > t THEN x1 - x0 - t ELSE 0 END::DOUBLE AS w, CASE WHEN y1 - y0 > t THEN y1 - y0 - t ELSE 0 END::DOUBLE AS h, CASE WHEN y1 - y0 > t THEN t ELSE t + (y1 - y0) / 2 END::DOUBLE AS above, CASE WHEN x1 - x0 > t THEN t ELSE t + (x1 - x0) / 2 END::DOUBLE AS beside FROM b")
def border_box(spark, d):
    cells = geometry.bordered_box(*(F.col(x) for x in ("x0", "y0", "x1", "y1")), 1.0 + F.col("ord") % 20)
    return lines(spark, d).select(*KEYS, *(c.alias(n) for c, n in zip(cells, ("x", "y", "w", "h", "above", "beside"), strict=True)))


@query(L + f", m AS (SELECT {K}x0, y0, font_size, 0.5::DOUBLE AS w, 0.75::DOUBLE AS h FROM lines), c AS (SELECT {K}2 * (font_size * 1.25::DOUBLE * v[1] + x0) + 0.5::DOUBLE * (font_size * v[2] + y0) + 3 AS x, -4 * (font_size * v[2] + y0) + 5 AS y FROM (SELECT *, unnest([[0.1::DOUBLE * w, 0.1::DOUBLE * h], [0.9::DOUBLE * w, 0.1::DOUBLE * h], [0.1::DOUBLE * w, 0.9::DOUBLE * h], [0.9::DOUBLE * w, 0.9::DOUBLE * h]]) AS v FROM m)) SELECT {K}round(min(x), 6) AS x0, round(min(y), 6) AS y0, round(max(x), 6) AS x1, round(max(y), 6) AS y1 FROM c GROUP BY ALL")
def character_boxes(spark, d):
    """The box of a line's first character under a page map that scales, slants and flips."""
    page, plain = [d_(x) for x in (2, 0, 0.5, -4, 3, 5)], [d_(x) for x in (1, 0, 0, 1, 0, 0)]
    box = geometry.character_box(page, plain, (F.col("x0"), F.col("y0")), F.col("font_size"), d_(1.25), d_(0.5), d_(0.75))
    return lines(spark, d).select(*KEYS, *(F.round(c, 6).alias(n) for c, n in zip(box, ("x0", "y0", "x1", "y1"), strict=True)))


@query(L + f", s AS (SELECT *, 0.25::DOUBLE * (ord % 3) AS ws, 0.125::DOUBLE * (ord % 2) AS ls, CASE WHEN flags = 16 THEN 0 ELSE 1000 END AS em, greatest(ord % 4, 0.5::DOUBLE) AS zoom FROM lines) SELECT {K}(ws + ls + CASE WHEN em <> 0 THEN 0.25::DOUBLE * font_size ELSE 0 END)::DOUBLE AS space, font_size * (0.75::DOUBLE - -0.25::DOUBLE) AS em_height, greatest(zoom, 1.5::DOUBLE) AS drawn, round(zoom / greatest(zoom, 1.5::DOUBLE), 9) AS rest, (len(text) * (5 + ls) + ws * (len(text) - len(replace(text, ' ', ''))))::DOUBLE AS advance, CASE WHEN len(text) > 1 THEN 5 + ls + CASE WHEN text[1] = ' ' THEN ws ELSE 0 END END::DOUBLE AS second FROM s")
def space_and_advance(spark, d):
    ws, ls = 0.25 * (F.col("ord") % 3), 0.125 * (F.col("ord") % 2)
    em = F.when(F.col("flags") == 16, 0).otherwise(1000)
    drawn, rest = geometry.text_scales(F.greatest((F.col("ord") % 4).cast("double"), d_(0.5)), d_(1.5))
    rows = geometry.advances(lines(spark, d).select(*KEYS, "text", "font_size", "flags"), d_(5), ls, ws)
    return rows.select(*KEYS, geometry.space_offset(ws, ls, em, d_(0.25), F.col("font_size")).alias("space"), geometry.em_height(F.col("font_size"), d_(0.75), d_(-0.25)).alias("em_height"),
                       drawn.alias("drawn"), F.round(rest, 9).alias("rest"), "advance", F.get("offsets", F.lit(1)).alias("second"))


@query(L + f", i AS (SELECT {K}(ord % 3)::DOUBLE AS a, x0, y0 FROM lines) SELECT {K}CASE WHEN a > 0 THEN round((4 * (x0 - 7) - 0.5::DOUBLE * (y0 - 9)) / (4 * a), 6) END AS x, CASE WHEN a > 0 THEN round(a * (y0 - 9) / (4 * a), 6) END AS y FROM i")
def inverse_points(spark, d):
    m = [(F.col("ord") % 3).cast("double"), d_(0), d_(0.5), d_(4), d_(7), d_(9)]
    x, y = regions.transform_point(geometry.inverse(m), F.col("x0"), F.col("y0"))
    return lines(spark, d).select(*KEYS, F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


@query(L + f", p AS (SELECT {K}flags, font_size, x0, ord // 8 AS clip, lag(flags) OVER w AS pf, lag(font_size) OVER w AS ps, lag(x0) OVER w AS px, lag(ord // 8) OVER w AS pc FROM lines WINDOW w AS (PARTITION BY doc_id, page_no ORDER BY ord)) SELECT {K}(CASE WHEN pf IS NULL OR clip <> pc THEN 3 WHEN x0 <> px THEN 2 WHEN flags <> pf OR font_size <> ps THEN 1 ELSE 0 END)::INT AS state FROM p")
def line_states(spark, d):
    rows = lines(spark, d).selectExpr(*KEYS, "flags AS font", "font_size AS size", "x0 / 72 AS a", "0D AS b", "0D AS c", "1D AS d", "ord div 8 AS clip")
    return geometry.line_states(rows, "doc_id", "page_no").select(*KEYS, F.col("state").cast("int").alias("state"))


@query(L + ", p AS (SELECT doc_id, page_no, (page_no - 1) * 800.0::DOUBLE AS y0, (page_no - 1) * 800.0::DOUBLE + 600 + 20 * least(count(*), 9) AS y1 FROM lines GROUP BY doc_id, page_no), v AS (SELECT doc_id, k::INT AS view, 250.0::DOUBLE * k AS top, 250.0::DOUBLE * k + 500 + 400 * (k % 2) AS bottom, (1 + k // 3)::INT AS current FROM (SELECT DISTINCT doc_id FROM lines), range(12) AS r(k)), s AS (SELECT v.*, page_no, (least(bottom, y1) - greatest(top, y0)) / (y1 - y0) AS share FROM v JOIN p ON v.doc_id = p.doc_id AND y0 <= bottom AND y1 >= top), b AS (SELECT doc_id, view, CASE WHEN bool_or(page_no = current AND abs(share - 1) <= 1e-6::DOUBLE) THEN any_value(current) ELSE arg_max(page_no, share::DOUBLE - page_no * 1e-12::DOUBLE) END AS page_no FROM s WHERE share > 0 GROUP BY ALL) SELECT v.doc_id, v.view, coalesce(b.page_no, current) AS page_no FROM v LEFT JOIN b ON v.doc_id = b.doc_id AND v.view = b.view")
def visible_page(spark, d):
    pages = lines(spark, d).groupBy("doc_id", "page_no").agg(F.count("*").alias("n")).selectExpr("doc_id", "page_no", "(page_no - 1) * 800D AS top", "(page_no - 1) * 800D + 600 + 20 * least(n, 9) AS bottom")
    views = pages.select("doc_id").distinct().select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(11))).alias("view"))
    views = views.selectExpr("doc_id", "view", "250D * view AS top", "250D * view + 500 + 400 * (view % 2) AS bottom", "int(1 + view div 3) AS current")
    return geometry.visible_page(pages, views)


@query(L + "SELECT doc_id, max(x1) AS width, max(y1) AS height FROM lines GROUP BY doc_id")
def largest_page(spark, d):
    return lines(spark, d).groupBy("doc_id").agg(F.max("x1").alias("width"), F.max("y1").alias("height"))


# Fonts

FONT = "CASE flags WHEN 16 THEN 'Serif-BoldOblique' WHEN 2 THEN 'SERIF-ITALIC' ELSE 'Serif' END"
_USED = f", u AS (SELECT DISTINCT font, unicode(c) AS code FROM (SELECT {FONT} AS font, unnest(string_split(text, '')) AS c FROM lines) WHERE c <> '')"


def spans_of(spark, d):
    return lines(spark, d).select("text", F.expr(FONT).alias("font"))


@query(L + _USED + ", f AS (SELECT font, row_number() OVER (ORDER BY font) - 1 AS id FROM (SELECT DISTINCT font FROM u WHERE font <> 'Serif')) SELECT u.font, any_value(f.id)::INT AS id, count(*) AS n_codes, count(*) FILTER (WHERE code BETWEEN 32 AND 126) AS n_encoded FROM u LEFT JOIN f ON u.font = f.font GROUP BY u.font")
def font_codes(spark, d):
    used = assets.used_codes(spans_of(spark, d))
    fonts = style.dictionary(used.where("font <> 'Serif'").select("font"), "font", "font").withColumnRenamed("value", "font")
    encoding = used.select("font").distinct().select("font", F.explode(F.sequence(F.lit(32), F.lit(126))).alias("code"))
    return assets.font_codes(used, fonts, encoding)


@query(L + ", u AS (SELECT DISTINCT unnest(string_split(text, '')) AS c FROM lines) SELECT unicode(c) AS code, lower(hex(encode(c))) AS bytes FROM u WHERE c <> '' AND unicode(c) < 65536")
def utf8_bytes(spark, d):
    return assets.used_codes(spans_of(spark, d)).where("code < 65536").select("code").distinct().select("code", assets.utf8_hex(F.col("code")).alias("bytes"))



@query(L + f", n AS (SELECT *, (row_number() OVER (PARTITION BY doc_id, page_no, block_no ORDER BY ord) - 1)::INT AS line_no, {FONT} AS font FROM lines) SELECT doc_id, page_no, block_no, line_no, (i - 1)::INT AS span_no, w[i] AS text, CASE WHEN font = 'Serif-BoldOblique' THEN 'bold' ELSE 'normal' END AS weight, CASE font WHEN 'Serif-BoldOblique' THEN 'oblique' WHEN 'SERIF-ITALIC' THEN 'italic' ELSE 'normal' END AS slant FROM (SELECT *, string_split(text, ' ') AS w, unnest(range(1, len(string_split(text, ' ')) + 1)) AS i FROM n)")
def font_name_styles(spark, d):
    """Blocks of nested lines and spans, taken apart; weight and slant by the font's name."""
    span = lambda w: F.struct(w.alias("text"), F.col("font").alias("font"), F.col("font_size").alias("size"))
    nested = lines(spark, d).withColumn("font", F.expr(FONT)).select("doc_id", "page_no", "block_no", "ord", F.transform(F.split("text", " "), span).alias("spans"))
    blocks = nested.groupBy("doc_id", "page_no", "block_no").agg(F.sort_array(F.collect_list(F.struct("ord", "spans"))).alias("lines"))
    empty = blocks.select("doc_id", "page_no", "block_no", F.slice("lines", 1, 0).alias("lines"))  # a block of images, and one without lines
    both = blocks.withColumn("type", F.lit(0)).unionByName(blocks.withColumn("type", F.lit(1))).unionByName(empty.withColumn("type", F.lit(0)))
    weight, slant = assets.font_styles(F.col("font"))
    return assets.exploded_spans(assets.text_blocks(both)).select("doc_id", "page_no", "block_no", "line_no", "span_no", "text", weight.alias("weight"), slant.alias("slant"))


@query(L + ", n AS (SELECT x1, row_number() OVER (ORDER BY min({'d': doc_id, 'p': page_no, 'o': ord})) - 1 AS id FROM lines GROUP BY x1) SELECT doc_id, page_no, ord, 'w' || lower(to_hex(id)) AS class FROM lines JOIN n ON lines.x1 = n.x1")
def styled_lines(spark, d):
    """Each line with the class of its width: the dictionary joined back."""
    rows = lines(spark, d).select(*KEYS, "x1")
    return rows.join(style.dictionary(rows, "x1", *KEYS), "x1").select(*KEYS, F.concat(F.lit("w"), F.lower(F.hex("id"))).alias("class"))


# Images, links, forms

@query("SELECT page_id, (length(html) - length(replace(html, '<', '')))::INT AS nodes, length(html) - length(replace(html, '<', '')) > 40 AS fallback FROM pages")
def node_counts(spark, d):
    nodes, fallback = assets.node_count(F.col("html"), 40)
    return spark.read.parquet(f"{d}/pages.parquet").select("page_id", nodes.alias("nodes"), fallback.alias("fallback"))


_BITMAP = "coalesce(source, '') || '-' || (doc_id % 50)"


@query(f"WITH b AS (SELECT DISTINCT {_BITMAP} AS bitmap FROM documents), u AS (SELECT {_BITMAP} AS bitmap FROM documents WHERE length(text) % 3 = 0) SELECT b.bitmap, count(u.bitmap) AS n, count(u.bitmap) = 0 AS temporary FROM b LEFT JOIN u ON b.bitmap = u.bitmap GROUP BY b.bitmap")
def bitmap_references(spark, d):
    rows = docs(spark, d, F.expr("concat(coalesce(source, ''), '-', doc_id % 50)").alias("bitmap"), F.length("text").alias("n_chars"))
    return assets.references(rows.select("bitmap").distinct(), rows.where("n_chars % 3 = 0").select("bitmap"))


_SRC = "printf('page_%04d_img_%03d.png', page_no, ord)"


@query(L + f", a AS (SELECT doc_id, {_SRC} AS src, ord FROM lines WHERE ord % 4 = 1) SELECT doc_id, src, src IN (SELECT src FROM a WHERE doc_id % 5 = 0 AND ord % 8 = 1) AS kept FROM a")
def written_assets(spark, d):
    rows = lines(spark, d).where("ord % 4 = 1").select("doc_id", "ord", T.page_file(F.lit(""), F.col("page_no"), F.col("ord"), "png").alias("src"))
    return assets.written(rows.select("doc_id", "src"), rows.where("doc_id % 5 = 0 AND ord % 8 = 1"))


@query(L + f", s AS (SELECT {K}flags <> 16 AS fill, flags = 2 AS stroke, (length(text) % 5) * 0.25::DOUBLE AS opacity, block_no = 2 AS grouped FROM lines) SELECT {K}(fill OR stroke) AND opacity >= 0.5::DOUBLE AS covers, grouped OR opacity < 1 AS clipped FROM s")
def opacity_gate(spark, d):
    rows = lines(spark, d).selectExpr(*KEYS, "flags <> 16 AS fill", "flags = 2 AS stroke", "(length(text) % 5) * 0.25D AS opacity", "block_no = 2 AS grouped")
    return assets.counted_shapes(rows).select(*KEYS, "covers", "clipped")


_PX = "':' || printf('%.2f', {}) || 'px;'"


def _css(**named: str) -> str:
    return " || ".join(f"'{n.replace('_', '-')}' || {_PX.format(x)}" for n, x in named.items())


@query(L + ", t AS (SELECT doc_id, 's' || ord AS name, min(page_no) AS page_no FROM lines WHERE ord < 6 AND ord % 2 = 0 GROUP BY ALL), l AS (SELECT doc_id, page_no * 100 + ord AS link, CASE WHEN ord % 3 = 0 THEN left(text, 12) END AS uri, 's' || (ord % 8) AS name, CASE WHEN ord % 4 = 1 THEN '[1,\"Fit\"]' END AS detail, ord % 6 AS kind, x0, y0, x1 - x0 AS w, y1 - y0 AS h FROM lines), "
    "b AS (SELECT l.*, coalesce(uri, '#pf' || lower(to_hex(t.page_no)), '') AS href, '<div class=\"d\" style=\"' || CASE kind WHEN 1 THEN 'border-style:dashed;' WHEN 2 THEN 'border-style:outset;' WHEN 3 THEN 'border-style:inset;' WHEN 4 THEN 'border-style:none;border-bottom-style:solid;' ELSE 'border-style:solid;' END || "
    + _css(left="x0", bottom="y0", width="w", height="h") + " || '\"></div>' AS box FROM l LEFT JOIN t ON l.doc_id = t.doc_id AND l.name = t.name) SELECT doc_id, link, CASE WHEN href = '' THEN box ELSE '<a class=\"l\" href=\"' || " + f"replace({O.markup('href')}, '`', '&#96;')" + " || '\"' || CASE WHEN detail IS NULL THEN '' ELSE ' data-dest-detail=''' || detail || '''' END || '>' || box || '</a>' END AS html FROM b")
def link_anchors(spark, d):
    rows = lines(spark, d)
    named = rows.where("ord < 6 AND ord % 2 = 0").groupBy("doc_id", F.concat(F.lit("s"), "ord").alias("name")).agg(F.min("page_no").alias("page_no"))
    links = rows.selectExpr(
        "doc_id", "page_no * 100 + ord AS link", "CASE WHEN ord % 3 = 0 THEN left(text, 12) END AS uri", "concat('s', ord % 8) AS name", "CASE WHEN ord % 4 = 1 THEN '[1,\"Fit\"]' END AS detail",
        f"element_at(array({', '.join(map(repr, _KINDS))}), ord % 6 + 1) AS style", "x0 AS x", "y0 AS y", "x1 - x0 AS w", "y1 - y0 AS h",
    )
    return assets.anchors(links, named)


@query(L + ", f AS (SELECT *, ord % 3 AS kind FROM lines WHERE ord % 3 < 2) SELECT doc_id, page_no, ord AS field, CASE kind WHEN 0 THEN '<input id=\"text-' || page_no || '-' || ord || '\" type=\"text\" value=\"\" style=\"position:absolute;' || " + _css(left="x0", bottom="y0", width="(x1 - x0)", height="(y1 - y0)", line_height="(y1 - y0)", font_size="((y1 - y0) / 2)")
    + " || '\"/>' ELSE '<div id=\"cb-' || page_no || '-' || ord || '\" style=\"position:absolute;' || " + _css(left="x0", bottom="y0", width="(x1 - x0 + 3)", height="(y1 - y0 + 3)") + " || 'background-size:cover;\"></div>' END AS html FROM f")
def form_inputs(spark, d):
    fields = lines(spark, d).selectExpr("doc_id", "page_no", "ord AS field", "element_at(array('text', 'button', 'choice'), ord % 3 + 1) AS type", "x0", "y0", "x1", "y1")
    return assets.inputs(fields)


# Documents and batches

@query(O.document_chunks() + f", t AS (SELECT doc_id, 1 AS page_no, 300.0::DOUBLE AS y0, '<table>' || doc_id || '</table>' AS html FROM documents WHERE doc_id % 5 > 1 AND length(text) > 0), a AS (SELECT doc_id, page_no, y0, 1 AS what, chunk, kind, text FROM chunks UNION ALL SELECT doc_id, page_no, y0, 0, 0, 'table', html FROM t) SELECT doc_id, page_no, (row_number() OVER (PARTITION BY doc_id, page_no ORDER BY y0, what, chunk) - 1)::INT AS place, kind, text FROM a")
def page_flow(spark, d):
    """Text chunks and plausible tables of each page in one flow."""
    found = tables(spark, d).join(docs(spark, d, "doc_id", "text").where("length(text) > 0").select("doc_id"), "doc_id", "left_semi").where("size(cells) > 1")
    found = found.select("doc_id", F.lit(1).alias("page_no"), d_(300).alias("y0"), F.concat(F.lit("<table>"), "doc_id", F.lit("</table>")).alias("html"))
    return assets.page_flow(segments.document_chunks(lines(spark, d)), found)


@query(L + ", s AS (SELECT doc_id, sum(length(text)) < 200 AS scanned FROM lines GROUP BY doc_id) SELECT d.doc_id, CASE WHEN coalesce(scanned, true) THEN 'image' ELSE 'text' END AS route, (SELECT count(*) FROM lines l WHERE l.doc_id = d.doc_id AND (CASE WHEN coalesce(scanned, true) THEN l.ord = 25 ELSE true END)) AS n FROM documents d LEFT JOIN s ON d.doc_id = s.doc_id")
def routed_documents(spark, d):
    """Scanned documents become an image for each page, the others their lines."""
    rows = lines(spark, d)

    def counted(route, kept):
        own = rows.where(kept).groupBy("doc_id").agg(F.count("*").alias("n"))
        return lambda found: found.join(own, "doc_id", "left").select("doc_id", F.lit(route).alias("route"), F.coalesce("n", F.lit(0)).alias("n"))

    return records.routed(docs(spark, d, "doc_id"), stats.characters(rows), counted("image", "ord = 25"), counted("text", "true"))


_BATCH = "records AS (SELECT doc_id, CASE WHEN doc_id % 4 > 0 THEN doc_id END AS file_id, CASE WHEN doc_id % 7 > 0 THEN 'k/' || doc_id END AS s3_key_pdf, CASE doc_id % 9 WHEN 2 THEN 'uploaded' WHEN 3 THEN 'failed' END AS s3_status FROM documents WHERE doc_id IS NOT NULL)"


@query(O.with_(O.LINES_SQL, _BATCH) + ", s AS (SELECT 'k/' || d.doc_id AS k, CASE WHEN d.doc_id % 11 = 5 THEN NULL ELSE count(l.doc_id) END AS n FROM documents d LEFT JOIN lines l ON d.doc_id = l.doc_id WHERE d.doc_id % 13 > 0 GROUP BY d.doc_id), p AS (SELECT r.*, CASE WHEN s3_status = 'uploaded' THEN 'skipped' WHEN k IS NULL THEN 'failed' WHEN n IS NULL THEN 'unreadable' WHEN n = 0 THEN 'failed' ELSE 'processed' END AS st FROM records r LEFT JOIN s ON r.s3_key_pdf = s.k) SELECT file_id, CASE st WHEN 'unreadable' THEN 'failed' ELSE st END AS status, CASE st WHEN 'processed' THEN 'uploaded' WHEN 'unreadable' THEN 'failed' ELSE s3_status END AS s3_status, CASE WHEN st = 'processed' THEN 'html/' || file_id || '.html' END AS s3_key, CASE WHEN st = 'processed' THEN 'store://html/' || file_id || '.html' END AS s3_url FROM p")
def process_records(spark, d):
    rows = docs(spark, d, "doc_id").where("doc_id IS NOT NULL").selectExpr("CASE WHEN doc_id % 4 > 0 THEN doc_id END AS file_id", "CASE WHEN doc_id % 7 > 0 THEN concat('k/', doc_id) END AS s3_key_pdf", "CASE doc_id % 9 WHEN 2 THEN 'uploaded' WHEN 3 THEN 'failed' END AS s3_status")
    read = docs(spark, d, "doc_id").where("doc_id % 13 > 0").join(stats.characters(lines(spark, d)), "doc_id", "left")
    read = read.selectExpr("concat('k/', doc_id) AS s3_key_pdf", "CASE WHEN doc_id % 11 <> 5 THEN coalesce(n_lines, 0) END AS n_lines")
    return records.processed(rows, read, "html", "store:/")


@query(O.with_(O.LINES_SQL, _BATCH.replace("records AS", "raw_ AS")) + ", s AS (SELECT 'k/' || doc_id AS k, count(*) AS n FROM lines GROUP BY doc_id), e AS (SELECT * FROM raw_ WHERE file_id IS NOT NULL AND s3_key_pdf IS NOT NULL AND file_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL) ORDER BY file_id LIMIT 500) SELECT count(*) FILTER (WHERE s3_status IS DISTINCT FROM 'uploaded' AND n IS NOT NULL) AS processed, count(*) FILTER (WHERE s3_status = 'uploaded') AS skipped, count(*) FILTER (WHERE s3_status IS DISTINCT FROM 'uploaded' AND n IS NULL) AS failed, 0::BIGINT AS not_in_read_coll, 0::BIGINT AS not_in_write_coll, 0::BIGINT AS other FROM e LEFT JOIN s ON e.s3_key_pdf = s.k")
def batch_run(spark, d):
    """What isn't done yet, the first 500 by id, each processed, and the statuses counted."""
    rows = docs(spark, d, "doc_id").where("doc_id IS NOT NULL").selectExpr("CASE WHEN doc_id % 4 > 0 THEN doc_id END AS file_id", "CASE WHEN doc_id % 7 > 0 THEN concat('k/', doc_id) END AS s3_key_pdf", "CASE doc_id % 9 WHEN 2 THEN 'uploaded' WHEN 3 THEN 'failed' END AS s3_status", "CAST(NULL AS string) AS skip_reason")
    done = spark.read.parquet(f"{d}/labels.parquet").select(F.col("doc_id").alias("file_id")).distinct()
    read = stats.characters(lines(spark, d)).selectExpr("concat('k/', doc_id) AS s3_key_pdf", "n_lines")
    return records.status_counts(records.processed(records.eligible(rows, done, limit=500), read, "html", "store:/"))


@query("WITH a AS (SELECT source, lang FROM documents WHERE doc_id % 3 > 0), b AS (SELECT source, lang FROM documents WHERE doc_id % 3 < 2) SELECT *, 'first' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'second' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)")
def differing_rows(spark, d):
    rows = docs(spark, d, "doc_id", "source", "lang")
    return records.differing(rows.where("doc_id % 3 > 0").drop("doc_id"), rows.where("doc_id % 3 < 2").drop("doc_id"))
