"""Unit vectors, folds against plain Python, invariants, incremental runs."""

import base64
import html

import duckdb
import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import blocks, folds, margins, meta, records, regions, render, segments, stats
from quire.operators import predicates as is_
from quire.plans import registry
from quire.sources import judgments, layout
from quire.streaming import incremental

DOCS = "/root/testdata/sf0.001/documents.parquet"


def values(spark, texts, *columns):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string").select("i", *columns).orderBy("i").collect()
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in rows]


def test_normalize_and_keys(spark):
    texts = [" a b­c \n d ", "", "Page 3 of 10", "no5 5 é5 5", "\t"]
    assert values(spark, texts, T.normalize("x")) == ["a bc d", "", "Page 3 of 10", "no5 5 é5 5", ""]
    assert values(spark, texts, T.repetition_key("x")) == ["a bc d", "", "page # of #", "no5 # é5 #", ""]


@pytest.mark.parametrize(
    "text, want",
    [("1. Go", True), ("(iv) x", True), ("2020. The", False), ("• dot", True), ("A) b", True), ("word", False), ("1.5 x", False), ("", False)],
)
def test_list_items(spark, text, want):
    assert values(spark, [text], is_.list_item("x")) == [want]


def test_predicates(spark):
    assert values(spark, ["Page 2 of 3", "page 2", "12", "x", "see http://a", ""], is_.margin_noise("x")) == [True, True, True, False, True, True]
    assert values(spark, ["Signature Not Verified", "Reason:", "ist 10:11:12", "list"], is_.signature_artefact("x")) == [True, True, True, False]
    assert values(spark, ["À B-1", "STRAßE", "12", "ab"], T.is_upper("x")) == [True, False, False, False]
    assert values(spark, ["12-3.", "iv)", "hello", "a"], is_.short_continuation("x")) == [True, True, False, True]


def test_join_lines(spark):
    one = lambda *lines: values(spark, ["x"], T.join_lines(F.array(*map(F.lit, lines))))[0]
    assert one("exam-", "ple") == "example"
    assert one("well-", "Known") == "well-Known"
    assert one("see (", "a") == "see (a"
    assert one("end", ", so") == "end, so"
    assert one("", "a", "", "b") == "a b"


def test_filename_template(spark):
    assert values(spark, ["a%d%x", "%s%03d", "plain", "%"], T.filename_template("x")) == ["a%d%%x", "%%s%03d", None, None]


def test_hex_colour_keeps_all_digits(spark, tmp_path):
    numbers = [0, 255, 0xFFFFFF, 0x1000000, 37 * 512820]
    assert values(spark, list(map(str, numbers)), T.hex_colour(F.col("x").cast("long"))) == [f"#{n:06x}" for n in numbers]
    spark.createDataFrame([(i,) for i in (1, 453438, 453439, 512820)], "doc_id long").write.parquet(f"{tmp_path}/documents.parquet")
    found = registry.filename_template(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.colour for r in found} == {i: f"{37 * i:06x}" for i in (1, 453438, 453439, 512820)}


def test_illegal_codes(spark):
    got = {r.id for r in spark.range(0, 0x10000).where(T.is_illegal_code("id")).collect()}
    assert {0, 0x1F, 0x7F, 0xA0, 0xAD, 0x900, 0xFEFF, 0xFFFF} <= got and not {0x20, 0xA1, 0x980, 0xFFFD} & got


def fold_python(rows, gap=18.0):
    out = []
    for r in sorted(rows, key=lambda r: (r[2], r[1], r[0])):
        ord_, x0, y0, x1, y1, size, text = r
        if out and abs(out[-1][2] - y0) <= 3 and -3 <= x0 - out[-1][3] <= gap and abs(out[-1][5] - size) <= 1:
            p = out[-1]
            out[-1] = (0, min(p[1], x0), min(p[2], y0), max(p[3], x1), max(p[4], y1), max(p[5], size), f"{p[6]} {text}")
        else:
            out.append(r)
    return [(r[6], r[1], r[3], r[5]) for r in out]


def test_baseline_fragments_fold(spark):
    rows = [(1, 0.0, 10.0, 50.0, 20.0, 11.0, "a"), (2, 55.0, 11.0, 90.0, 21.0, 11.5, "b"), (3, 100.0, 10.0, 120.0, 20.0, 11.0, "c"), (4, 150.0, 10.0, 170.0, 20.0, 11.0, "d"), (5, 0.0, 40.0, 9.0, 50.0, 11.0, "e"), (6, 10.0, 40.0, 19.0, 50.0, 14.0, "f")]
    df = spark.createDataFrame([(1, 1, *r) for r in rows], "doc_id long, page_no int, ord int, x0 double, y0 double, x1 double, y1 double, font_size double, text string")
    got = [(r.text, r.x0, r.x1, r.font_size) for r in folds.baseline_fragments(df).orderBy("n").collect()]
    assert got == fold_python(rows)


def test_offset_drift_carries_the_error(spark):
    gaps = [0.4, 0.4, 0.4, 1.3, -0.7]
    df = spark.createDataFrame([(1, 1, 1, gaps)], "doc_id long, page_no int, ord int, gaps array<double>")
    row = folds.offset_drift(df).first()
    drift, want = 0.0, []
    for g in gaps:
        v = float(round(g + drift))
        drift, want = g + drift - v, [*want, v]
    assert row.emitted == want and row.drift == pytest.approx(drift)


def test_every_line_is_kept_once_or_dropped_with_a_reason(spark):
    lines = layout.layout_lines(spark.read.parquet(DOCS)).cache()
    told = margins.reasons(lines)
    assert told.count() == lines.count()
    kept = told.where("reason IS NULL")
    found = segments.document_chunks(lines)
    assert found.agg(F.sum("n_lines")).first()[0] == kept.count()


def test_coalesced_elements_keep_all_text(spark):
    lines = layout.layout_lines(spark.read.parquet(DOCS).limit(40)).cache()
    found = segments.document_chunks(lines)
    merged = folds.coalesced_elements(found, stats.doc_stats(lines))
    letters = lambda df: df.agg(F.sum(F.length(F.regexp_replace(T.unescape_html("text"), r"[\s-]", "")))).first()[0]
    assert merged.count() <= found.count() and letters(merged) == letters(found)


def test_advocates(spark):
    text = "Through: Mr. A. Rao, Sr. Adv. with Ms. B. Sen, Advocate versus X Through : Dr. D. Roy for respondent no. 1 CORAM: Y"
    found = meta.both_advocates(F.col("x"))
    assert values(spark, [text], *found.values()) == [(["Mr. A. Rao", "Ms. B. Sen"], ["Dr. D. Roy"])]


def test_judgment_metadata(spark):
    docs = spark.createDataFrame([(0, "some text of a document")], "doc_id long, text string")
    row = meta.extract(judgments.judgment_lines(docs)).first()
    assert (row.citation, row.neutral_citation_year, row.neutral_citation_number, row.is_division_bench) == ("2022:DHC:377-DB", 2022, 377, True)
    assert (row.case_number, row.judgment_date, row.reserved_on) == ("LPA-9/2020", "02.02.2022", "12.01.2022")
    assert (row.appellant, row.respondent, row.bench) == ("ALPHA TRADERS & CO.", "BETA MILLS (P) LTD.", ["E. KUMAR", "F. SINGH"])
    assert row.judgment_by == "E. KUMAR" and row.is_oral_judgment and row.via_video_conferencing


def test_bench_beside_accented_letters_equals_its_sql(spark, tmp_path):
    texts = ["enñcorami " + "straße y más " * 20, "xcoram " + "a b " * 40, "el coramá " + "ǰ ﬁn ᾳ ß " * 20, "coram: " + " \u00a0zz\u3000z " * 60]
    spark.createDataFrame([(4 * i + 3, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: (r.bench, r.is_division_bench) for r in registry.meta_bench(spark, str(tmp_path)).collect()}
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert found == {i: (bench, division) for i, bench, division in c.execute(registry.ORACLE_SQL["meta_bench"]).fetchall()}
    assert "STRAẞE" in found[3][0][0] and found[7] == ([], False) and found[11][1]


def test_merged_paragraphs(spark):
    kinds = [("heading", "ORDER"), ("body", "lead in"), ("body", "1."), ("body", "First"), ("body", "goes on"), ("quote", "said"), ("body", "after"), ("body", "2) Second"), ("heading", "END"), ("body", "tail")]
    df = spark.createDataFrame([(1, i, k, t) for i, (k, t) in enumerate(kinds)], "doc_id long, ord int, kind string, text string")
    got = [(r.kind, r.num, r.text) for r in blocks.merged_paragraphs(df).orderBy("n").collect()]
    assert got == [("heading", "", "ORDER"), ("body", "", "lead in"), ("para", "1.", "First goes on"), ("quote", "", "said"), ("para", "1.", "after"), ("para", "2)", "Second"), ("heading", "", "END"), ("body", "", "tail")]
    html = render.judgment_html(blocks.merged_paragraphs(df)).first().html
    assert 'id="para-1"' in html and 'id="para-1-2"' in html and html.count("<div") == html.count("</div")


def test_boxes(spark):
    box = [F.lit(x) for x in (-4.0, -4.0, -2.0, -1.0)]
    turned = regions.transform_box([F.lit(x) for x in (0.0, 1.0, -1.0, 0.0, 0.0, 0.0)], box)
    assert tuple(spark.range(1).select(*turned).first()) == (1.0, -4.0, 4.0, -2.0)
    assert spark.range(1).select(regions.intersection(box, [F.lit(x) for x in (-2.0, -4.0, 0.0, 0.0)])).first()[0] is None


def test_assigned_ids_are_dense(spark):
    rows = spark.range(0, 20000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("file_id"))
    got = records.assign_ids(rows, "id", records.largest_id(rows)).where("id % 3 <> 0").orderBy("id").collect()
    assert [r.file_id for r in got] == list(range(19999, 19999 + len(got)))


def test_incremental_stream_writes_once(spark, tmp_path):
    part = spark.read.parquet(DOCS).select("doc_id", "text", "source")
    arrived, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    part.where("doc_id < 50").write.parquet(arrived)
    run = lambda: incremental.run_once(incremental.new_documents(spark, arrived), incremental.line_counts, target, state)
    run()
    run()
    assert spark.read.parquet(target).count() == 50
    part.where("doc_id BETWEEN 50 AND 79").write.mode("append").parquet(arrived)
    run()
    got = spark.read.parquet(target)
    assert got.count() == got.select("doc_id").distinct().count() == 80


def test_judgment_lines_hold_the_whole_text(spark):
    text = "".join(chr(97 + i // 64 % 26) if i % 64 else "é" for i in range(64 * 300 + 7)) + " \nend 😀"
    docs = spark.createDataFrame([(3, text), (4, ""), (5, " \n")], "doc_id int, text string")
    got = {r.doc_id: r.lines for r in judgments.judgment_lines(docs).collect()}
    flat = text.replace("\n", " ")
    body = [flat[i : i + 64].strip(" ") for i in range(0, len(flat), 64)]
    assert len(body) == 301
    for i, own in ((3, body), (4, []), (5, [])):
        assert got[i] == judgments.HEADS[i % 4] + own + judgments.TAILS[i % 3]


@pytest.fixture
def long_texts(spark, tmp_path):
    """Documents whose texts go on behind all former prefixes."""
    rows = [(i, "plain words " * 20 + f"<é & \"{i}\">") for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path), dict(rows)


def test_span_html_holds_the_whole_text(spark, long_texts):
    for r in registry.span_html(spark, long_texts[0]).collect():
        assert r.html.endswith(f">{html.escape(long_texts[1][r.doc_id])}</span>")


def test_embed_holds_the_whole_text(spark, long_texts):
    tags = {r.doc_id: r.tag for r in registry.embed_or_link(spark, long_texts[0]).collect()}
    for i, text in long_texts[1].items():
        if i % 5 == 0:
            assert tags[i] == f"<style>{text}</style>"
        if i % 5 == 2:
            assert tags[i] == "data:image/png;base64," + base64.b64encode(text.encode()).decode()


def test_regions_are_of_every_document(spark, long_texts):
    found = registry.regions(spark, long_texts[0]).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in found} == dict.fromkeys(range(20), 3)


def test_lines_of_a_document_without_regions_stay(spark):
    box = "page_no int, {} x0 double, y0 double, x1 double, y1 double"
    rows = spark.createDataFrame([(i, 1, o, 10.0, 20.0 * o, 90.0, 20.0 * o + 12) for i in (1, 2) for o in (1, 2)], "doc_id int, " + box.format("ord int,"))
    reserved = spark.createDataFrame([(2, 1, 0.0, 0.0, 50.0, 35.0)], "doc_id int, " + box.format(""))
    found = margins.overlapping_regions(rows, reserved).collect()
    assert sorted((r.doc_id, r.ord) for r in found) == [(1, 1), (1, 2), (2, 2)]
