"""Text state, fonts, assets, batches and files on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from quire.operators import assets, geometry, records, regions
from quire.sources import files


def value(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def lit(*xs):
    return [F.lit(float(x)) for x in xs]


def test_rescaled_font(spark):
    scale, size, m = geometry.rescaled_font(lit(10, 0, 0, 10), F.lit(1.0), F.lit(1.0))
    assert value(spark, scale, size, *m) == (10, 10, 1, 0, 0, 1)
    scale, size, m = geometry.rescaled_font(lit(2, 0, 0, 0), F.lit(-3.0), F.lit(1.0))
    assert value(spark, scale, size, *m) == (1, 3, -2, 0, 0, 0)


def test_shift_and_merging(spark):
    m = lit(2, 0, 0, 2, 0, 0)
    dx, dy = geometry.shift_between(m, lit(2, 0, 0, 2, 10, 0), (F.lit(1.0), F.lit(1.0)), (F.lit(1.0), F.lit(1.0)))
    assert value(spark, dx, dy) == (5, 0)
    assert value(spark, *geometry.shift_between(lit(1, 2, 2, 4, 0, 0), m, *[(F.lit(0.0), F.lit(0.0))] * 2)) == (None, None)
    band = (F.lit(-2.0), F.lit(8.0))
    merge = lambda dx, dy: value(spark, geometry.lines_merge(*lit(dx, dy, 10), band, band))[0]
    assert merge(-500, 0) and merge(3, 5) and merge(-1, 5) and not merge(-2, 5) and not merge(3, 11)
    assert value(spark, geometry.lines_merge(F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(1.0), band, band)) == (False,)


def test_inverse_undoes(spark):
    m = lit(2, 1, -1, 3, 5, 7)
    x, y = regions.transform_point(m, *lit(11, 13))
    assert value(spark, *regions.transform_point(geometry.inverse(m), x, y)) == pytest.approx((11, 13))
    assert value(spark, *geometry.inverse(lit(1, 1, 1, 1, 0, 0))) == (None,) * 6


def test_boxes_colours_and_spaces(spark):
    assert value(spark, *geometry.bordered_box(*lit(0, 0, 10, 2, 4))) == (-2, -2, 6, 0, 5, 4)
    assert value(spark, geometry.colour_distance(lit(0, 0, 0), lit(1, 1, 1)), geometry.snapped(F.lit(1e-9)), geometry.snapped(F.lit(-0.5))) == (1, 0, -0.5)
    one = lit(1, 0, 0, 1, 0, 0)
    assert value(spark, *geometry.character_box(one, one, tuple(lit(100, 200)), *lit(10, 1, 0.5, 1))) == pytest.approx((100.5, 201, 104.5, 209))
    assert value(spark, geometry.space_offset(*lit(1, 2, 1000, 0.25, 8)), geometry.space_offset(*lit(1, 2, 0, 0.25, 8)), geometry.em_height(*lit(10, 0.75, -0.25)), *geometry.text_scales(*lit(1, 4))) == (5, 3, 10, 4, 0.25)
    (row,) = geometry.advances(spark.createDataFrame([("a b",)], "text string"), *lit(5, 1, 2)).collect()
    assert row.offsets == [0, 6, 14] and row.advance == 20


def test_line_states(spark):
    rows = [(1, 0, "f", 10.0, 1.0, 0), (1, 1, "f", 10.0, 1.0, 0), (1, 2, "g", 10.0, 1.0, 0), (1, 3, "g", 10.0, 2.0, 0), (1, 4, "h", 9.0, 1.0, 1), (2, 0, "f", 1.0, 1.0, 0)]
    states = spark.createDataFrame(rows, "page int, ord int, font string, size double, a double, clip int").withColumns({x: F.lit(0.0) for x in "bcd"})
    assert [r.state for r in geometry.line_states(states, "page").orderBy("page", "ord").collect()] == [3, 0, 1, 2, 3, 3]


def test_visible_page(spark):
    pages = spark.createDataFrame([(1, p, 100.0 * (p - 1), 100.0 * p - 10) for p in (1, 2, 3)], "doc_id int, page_no int, top double, bottom double")
    views = [(1, 0, 0.0, 300.0, 2), (1, 1, 60.0, 150.0, 1), (1, 2, 92.0, 96.0, 3), (1, 3, 0.0, 300.0, 9), (2, 0, 0.0, 9.0, 5)]
    found = geometry.visible_page(pages, spark.createDataFrame(views, "doc_id int, view int, top double, bottom double, current int"))
    assert sorted(map(tuple, found.collect())) == [(1, 0, 2), (1, 1, 2), (1, 2, 3), (1, 3, 1), (2, 0, 5)]


def test_fonts(spark):
    style = lambda name: value(spark, *assets.font_styles(F.lit(name)))
    assert [style(x) for x in ("Times-BOLDItalic", "Courier-ObliqueItalic", "Arial")] == [("bold", "italic"), ("normal", "oblique"), ("normal", "normal")]
    for code in (0, 65, 127, 128, 0x7FF, 0x800, 0x20AC, 0xFFFD):
        assert value(spark, assets.utf8_hex(F.lit(code))) == (chr(code).encode().hex(),)
    used = assets.used_codes(spark.createDataFrame([("f", "aab"), ("f", ""), ("g", "é"), ("g", None)], "font string, text string"))
    assert sorted(map(tuple, used.collect())) == [("f", 97), ("f", 98), ("g", 233)]
    fonts, encoding = spark.createDataFrame([("f", 4)], "font string, id int"), spark.createDataFrame([("f", 97), ("f", 97), ("h", 233)], "font string, code int")
    assert sorted(map(tuple, assets.font_codes(used, fonts, encoding.distinct()).collect())) == [("f", 4, 2, 1), ("g", None, 1, 0)]


def test_blocks_without_text(spark):
    schema = "doc_id int, page_no int, block_no int, type int, lines array<struct<spans: array<struct<text: string, font: string, size: double>>>>"
    blocks = spark.createDataFrame([(1, 1, 0, 0, [([("a", "F", 1.0), ("b", "F", 1.0)],), ([],)]), (1, 1, 1, 1, []), (1, 1, 2, 0, [])], schema)
    assert [r.block_no for r in assets.text_blocks(blocks).collect()] == [0]
    assert [(r.line_no, r.span_no, r.text) for r in assets.exploded_spans(blocks).collect()] == [(0, 0, "a"), (0, 1, "b")]


def test_links_and_forms(spark):
    links = spark.createDataFrame([(1, 0, "http://a?b&c`", None, "", "inset", 1.0), (1, 1, None, "here", '[2,"Fit"]', "odd", 1.0), (1, 2, None, "nowhere", None, None, 1.0)], "doc_id int, link int, uri string, name string, detail string, style string, x double")
    links = links.withColumns({"y": F.lit(2.0), "w": F.lit(3.0), "h": F.lit(4.5)})
    html = {r.link: r.html for r in assets.anchors(links, spark.createDataFrame([(1, "here", 26)], "doc_id int, name string, page_no int")).collect()}
    box = "left:1.00px;bottom:2.00px;width:3.00px;height:4.50px;"
    assert html[0] == f'<a class="l" href="http://a?b&amp;c&#96;"><div class="d" style="border-style:inset;{box}"></div></a>'
    assert html[1].startswith("<a class=\"l\" href=\"#pf1a\" data-dest-detail='[2,\"Fit\"]'>") and html[2] == f'<div class="d" style="border-style:solid;{box}"></div>'
    fields = spark.createDataFrame([(1, 2, 0, "text"), (1, 2, 1, "button"), (1, 2, 2, "choice")], "doc_id int, page_no int, field int, type string").withColumns({n: F.lit(x) for n, x in (("x0", 0.0), ("y0", 0.0), ("x1", 10.0), ("y1", 8.0))})
    found = {r.field: r.html for r in assets.inputs(fields).collect()}
    assert set(found) == {0, 1} and "font-size:4.00px" in found[0] and "width:13.00px;height:11.00px;" in found[1]


def test_process_records(spark):
    rows = [(1, "a", "uploaded"), (2, "b", None), (3, "c", None), (4, "d", "old"), (5, None, None), (6, "gone", None)]
    sources = spark.createDataFrame([("a", 3), ("b", 3), ("c", 0), ("d", None)], "s3_key_pdf string, n_lines int")
    found = records.processed(spark.createDataFrame(rows, "file_id int, s3_key_pdf string, s3_status string"), sources, "html", "store:/")
    assert sorted(map(tuple, found.collect())) == [
        (1, "skipped", "uploaded", None, None), (2, "processed", "uploaded", "html/2.html", "store://html/2.html"), (3, "failed", None, None, None),
        (4, "failed", "failed", None, None), (5, "failed", None, None, None), (6, "failed", None, None, None),
    ]
    same = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    assert sorted(map(tuple, records.differing(same, same.where("x = 1").unionByName(spark.createDataFrame([(3,)], "x int"))).collect())) == [(2, "first"), (3, "second")]


def test_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("ö\n".encode())
    (tmp_path / "b.txt").write_bytes(b"\xff\xfe")
    found = files.texts(files.documents(spark, f"{tmp_path}/*.txt"))
    assert sorted((r.name, r["size"], r.text) for r in found.collect()) == [("a.txt", 3, "ö\n"), ("b.txt", 2, None)]
    assert files.texts(spark.createDataFrame([(b"abc",), (None,)], "content binary")).where("text = 'abc'").count() == 1
    with pytest.raises(Exception, match="(?i)path"):
        files.documents(spark, f"{tmp_path}/none-here").count()
