"""Queries by name, and the DuckDB SQL that each is held against."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions import patterns as P
from quire.functions import text as T
from quire.operators import blocks, folds, margins, meta, records, render, segments, stats, style
from quire.operators import predicates as is_
from quire.operators import regions as regions_
from quire.sources import judgments as J
from quire.sources import layout

from . import oracle as O
from . import oracle_meta as M

QUERIES: dict = {}
ORACLE_SQL: dict = {}
R_SPACES = r"regexp_replace(text, '\s+', ' ', 'g')"


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def docs(spark, d, *columns):
    found = spark.read.parquet(f"{d}/documents.parquet")
    return found.select(*columns) if columns else found


def lines(spark, d):
    return layout.layout_lines(docs(spark, d, "doc_id", "text", "source"))


@query(O.document_chunks() + "SELECT doc_id, count(*) FILTER (WHERE kind = 'h1') AS h1, count(*) FILTER (WHERE kind = 'h2') AS h2, count(*) FILTER (WHERE kind = 'h3') AS h3, count(*) FILTER (WHERE kind = 'blockquote') AS blockquote, count(*) FILTER (WHERE kind = 'p') AS p FROM chunks GROUP BY doc_id")
def flagship_kind_counts(spark, d):
    found = segments.document_chunks(lines(spark, d))
    return found.groupBy("doc_id").agg(*(F.count_if(F.col("kind") == k).alias(k) for k in ("h1", "h2", "h3", "blockquote", "p")))


@query(O.with_(O.LINES_SQL) + "SELECT * FROM lines")
def layout_lines(spark, d):
    return lines(spark, d)


@query(O.with_(O.LINES_SQL, O.patterns_cte()) + "SELECT * FROM patterns")
def margin_repeats_sem(spark, d):
    return margins.repeated_patterns(lines(spark, d))


@query(O.with_(O.LINES_SQL, O.patterns_cte(True)) + "SELECT * FROM patterns")
def margin_repeats_sem_compat(spark, d):
    return margins.repeated_patterns(lines(spark, d), compat=True)


@query(O.with_(O.LINES_SQL, O.STATS) + "SELECT * FROM stats")
def doc_stats(spark, d):
    return stats.doc_stats(lines(spark, d))


@query(O.with_(O.LINES_SQL, O.patterns_cte(), O.reasons_cte()) + "SELECT doc_id, page_no, ord, reason FROM reasons WHERE reason IS NOT NULL")
def drop_lines_reasoned(spark, d):
    return margins.reasons(lines(spark, d)).where("reason IS NOT NULL").select("doc_id", "page_no", "ord", "reason")


@query(O.with_(O.LINES_SQL, O.patterns_cte(), O.reasons_cte(), O.STATS, O.islands_cte()) + "SELECT doc_id, page_no, ord, chunk FROM islands")
def paragraph_islands_sem(spark, d):
    raw = lines(spark, d)
    kept = margins.reasons(raw).where("reason IS NULL").drop("reason")
    return segments.paragraphs(kept, stats.doc_stats(raw)).select("doc_id", "page_no", "ord", "chunk")


@query(O.with_(O.LINES_SQL, O.patterns_cte(), O.reasons_cte(), O.STATS, O.islands_cte(True)) + "SELECT doc_id, page_no, ord, chunk FROM islands")
def paragraph_islands_semb(spark, d):
    raw = lines(spark, d)
    kept = margins.reasons(raw).where("reason IS NULL").drop("reason")
    return segments.paragraphs_base(kept, stats.doc_stats(raw)).select("doc_id", "page_no", "ord", "chunk")


@query(O.document_chunks() + "SELECT doc_id, page_no, chunk, kind, text, x0, y0, x1, y1, n_lines FROM chunks")
def chunk_kinds(spark, d):
    return segments.document_chunks(lines(spark, d)).drop("texts")


@query(O.document_chunks(True) + "SELECT doc_id, page_no, chunk, kind, text, n_lines FROM chunks")
def chunk_kinds_base(spark, d):
    return segments.document_chunks(lines(spark, d), base=True).select("doc_id", "page_no", "chunk", "kind", "text", "n_lines")


def judgments(spark, d):
    return J.judgment_lines(docs(spark, d, "doc_id", "text").where("text IS NOT NULL"))


META = O.with_(J.LINES_SQL, M.HEAD)


@query(META + f"SELECT doc_id, citation, {M.YEAR} AS neutral_citation_year, {M.NUMBER} AS neutral_citation_number FROM cited")
def meta_citation(spark, d):
    return meta.extract(judgments(spark, d)).select("doc_id", "citation", "neutral_citation_year", "neutral_citation_number")


@query(META + f"SELECT doc_id, {M.CASE} AS case_number FROM head")
def meta_case_number(spark, d):
    return meta.extract(judgments(spark, d)).select("doc_id", "case_number")


@query(META + f"SELECT doc_id, {M.DATE} AS judgment_date, {M.RESERVED} AS reserved_on FROM head")
def meta_dates(spark, d):
    return meta.extract(judgments(spark, d)).select("doc_id", "judgment_date", "reserved_on")


@query(META + f"SELECT doc_id, {M.party(P.APPELLANT, 1)} AS appellant, {M.party(P.RESPONDENT, 2)} AS respondent FROM head")
def meta_parties(spark, d):
    return meta.extract(judgments(spark, d)).select("doc_id", "appellant", "respondent")


@query(META + f"SELECT doc_id, connected AS is_connected_matter, CASE WHEN connected THEN {O.strip(M.grab('head_text', P.LEAD_CASE, 1))} ELSE '' END AS lead_case FROM (SELECT *, {M.CONNECTED} AS connected FROM head)")
def meta_connected(spark, d):
    return meta.extract(judgments(spark, d)).select("doc_id", "is_connected_matter", "lead_case")


@query(O.with_(J.LINES_SQL, M.HEAD, M.BENCH) + "SELECT doc_id, bench, citation LIKE '%-DB' OR len(bench) >= 2 AS is_division_bench FROM benches")
def meta_bench(spark, d):
    return meta.extract(judgments(spark, d)).select("doc_id", "bench", "is_division_bench")


@query(O.with_(J.LINES_SQL, M.HEAD, M.JUDGE) + f"SELECT doc_id, judgment_by, {O.like('full_text', P.ORAL)} AS is_oral_judgment, {O.like('full_text', P.VIDEO)} AS via_video_conferencing FROM judges")
def meta_judge(spark, d):
    return meta.extract(judgments(spark, d)).select("doc_id", "judgment_by", "is_oral_judgment", "via_video_conferencing")


@query(META + f"SELECT doc_id, {M.REFS} AS referred_cases FROM cited")
def meta_refs(spark, d):
    return meta.extract(judgments(spark, d)).select("doc_id", "referred_cases")


@query(META + f"SELECT doc_id, {M.ACTS} AS acts_referred FROM head")
def meta_acts(spark, d):
    return meta.extract(judgments(spark, d)).select("doc_id", "acts_referred")


@query()
def meta_advocates(spark, d):
    """Lookahead, which the oracle's engine lacks; tested against Python."""
    return meta.extract(judgments(spark, d)).select("doc_id", "advocates_petitioner", "advocates_respondent")


def entries(spark, d):
    """Judgment lines with a page for each 30, and an indent and slant that vary by line."""
    rows = judgments(spark, d).select("doc_id", F.posexplode("lines").alias("ord", "text"))
    return rows.select("doc_id", "ord", F.floor(F.col("ord") / 30).cast("int").alias("i"), "text", (72 + F.when(F.col("ord") % 13 == 5, 90).when(F.col("ord") % 13 == 7, 70).when(F.col("ord") % 4 == 1, 20).otherwise(0)).cast("int").alias("indent"), (F.col("ord") % 26 == 7).alias("italic")).withColumn("page_no", F.col("i") + 1).drop("i")


def zoned(spark, d):
    found = entries(spark, d)
    both = found.join(stats.base_indent(found), "doc_id")
    return both.withColumn("zone", blocks.zone(F.col("text"), F.col("indent"), F.col("base_indent"), F.col("italic")))


ENTRIES = O.with_(J.LINES_SQL, M.ENTRIES, M.ZONED)


@query(O.with_(J.LINES_SQL, M.ENTRIES) + "SELECT * FROM base")
def base_indent(spark, d):
    return stats.base_indent(entries(spark, d))


@query(ENTRIES + "SELECT doc_id, ord, zone FROM zoned")
def block_zones(spark, d):
    return zoned(spark, d).select("doc_id", "ord", "zone")


@query(O.with_(J.LINES_SQL, M.ENTRIES, M.ZONED, M.SECTIONS) + "SELECT doc_id, ord, in_order, page_break FROM sections")
def order_flag_page_breaks(spark, d):
    return blocks.sections(zoned(spark, d)).select("doc_id", "ord", "in_order", "page_break")


def items(spark, d):
    kind = F.when(F.col("zone") == "order_heading", "heading").when(F.col("zone") == "quote", "quote").otherwise("body")
    return zoned(spark, d).select("doc_id", "ord", kind.alias("kind"), "text")


@query(O.with_(J.LINES_SQL, M.ENTRIES, M.ZONED, M.MERGED) + "SELECT * FROM merged")
def para_merge_s2(spark, d):
    return blocks.merged_paragraphs(items(spark, d))


@query(O.with_(J.LINES_SQL, M.ENTRIES, M.ZONED, M.SECTIONS, M.JUDGES) + "SELECT * FROM places")
def judge_name_places(spark, d):
    return blocks.judge_places(blocks.sections(zoned(spark, d)))


def outer(spark, d):
    """Layout lines moved so that the first and last of a page lie in the outer margin."""
    y = F.when(F.col("ord") == 1, 50.0).when(F.col("ord") == 24, 730.0).otherwise(F.col("y0"))
    return lines(spark, d).withColumn("y0", y).withColumn("y1", y + 12)


OUTER = "outer_ AS (SELECT * REPLACE (CASE WHEN ord = 1 THEN 50 WHEN ord = 24 THEN 730 ELSE y0 END AS y0, CASE WHEN ord = 1 THEN 62 WHEN ord = 24 THEN 742 ELSE y1 END AS y1) FROM lines)"


@query(O.with_(O.LINES_SQL, OUTER, M.REPEATED) + "SELECT * FROM repeated")
def margin_repeats_s2(spark, d):
    return margins.repeated_lines(outer(spark, d))


@query(O.with_(O.LINES_SQL, OUTER, M.REPEATED) + f"SELECT o.doc_id, o.page_no, o.ord, text FROM outer_ o ANTI JOIN repeated r ON o.doc_id = r.doc_id AND o.page_no = r.page_no AND o.ord = r.ord WHERE NOT ({O.like('text', P.PAGE_MARKER)} OR {O.like('text', P.TRAILING_MARKER)} OR text LIKE '%qrserver.com%' OR {O.like('text', P.ANNOTATION)} OR {O.like('text', P.BARE_CITATION)})")
def clean_entries(spark, d):
    return margins.clean_entries(outer(spark, d)).select("doc_id", "page_no", "ord", "text")


# Text functions over the documents' own lines

SOURCE_LINES = "source_lines AS (SELECT doc_id, (i - 1)::INT AS line_no, parts[i] AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS parts, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents) WHERE regexp_matches(parts[i], '\\S'))"


@query(O.with_(SOURCE_LINES) + "SELECT * FROM source_lines")
def split_lines(spark, d):
    return layout.source_lines(docs(spark, d, "doc_id", "text"))


@query(O.with_(O.LINES_SQL) + "SELECT doc_id, page_no, ord, text FROM lines WHERE page_no BETWEEN least(2, n_pages) AND greatest(least(2, n_pages), least(3, n_pages))")
def page_range(spark, d):
    return layout.page_range(lines(spark, d), 2, 3).select("doc_id", "page_no", "ord", "text")


@query(O.with_(O.LINES_SQL) + "SELECT doc_id, page_no, 612.0::DOUBLE AS width, 792.0::DOUBLE AS height, count(*) AS n_lines FROM lines GROUP BY doc_id, page_no")
def page_geometry(spark, d):
    return layout.page_geometry(lines(spark, d))


@query(O.with_(SOURCE_LINES) + f"SELECT doc_id, line_no, {O.norm('text')} AS value FROM source_lines")
def normalize_text(spark, d):
    return split_lines(spark, d).select("doc_id", "line_no", T.normalize("text").alias("value"))


@query(O.with_(SOURCE_LINES) + f"SELECT doc_id, line_no, {O.key('text')} AS sem, lower({O.hidden(O.strip(R_SPACES))}) AS s2 FROM source_lines")
def repetition_key(spark, d):
    return split_lines(spark, d).select("doc_id", "line_no", T.repetition_key("text").alias("sem"), T.repeated_line_key("text").alias("s2"))


@query(O.with_(SOURCE_LINES) + f"SELECT doc_id, line_no, {O.escape('text')} AS py, {O.markup('text')} AS markup, replace({O.markup('text')}, '`', '&#96;') AS attribute, {O.json('text')} AS json, replace(text, chr(10), '<br>') AS breaks FROM source_lines")
def html_escape(spark, d):
    return split_lines(spark, d).select("doc_id", "line_no", T.escape_html("text").alias("py"), T.escape_markup("text").alias("markup"), T.escape_attribute("text").alias("attribute"), T.escape_json("text").alias("json"), T.line_breaks("text").alias("breaks"))


@query(O.with_(SOURCE_LINES) + "SELECT doc_id, line_no, text AS value FROM source_lines")
def html_round_trip(spark, d):
    return split_lines(spark, d).select("doc_id", "line_no", T.unescape_html(T.escape_html("text")).alias("value"))


@query(O.with_(SOURCE_LINES) + f"SELECT doc_id, line_no, {O.upper('text')} AS is_upper, {O.words('text')}::INT AS words, CASE WHEN length(regexp_replace(text, '[^A-Za-z]', '', 'g')) > 0 THEN round(length(regexp_replace(text, '[^A-Z]', '', 'g')) / length(regexp_replace(text, '[^A-Za-z]', '', 'g'))::DOUBLE, 9) END AS share, regexp_replace(text, '\\s{{2,}}', ' ', 'g') AS collapsed, regexp_replace(text, '\\D', '', 'g') AS digits, base64(encode(text)) AS b64 FROM source_lines")
def text_measures(spark, d):
    return split_lines(spark, d).select(
        "doc_id", "line_no", T.is_upper("text").alias("is_upper"), T.words("text").alias("words"), F.round(T.upper_share("text"), 9).alias("share"), T.collapse_spaces("text").alias("collapsed"),
        F.regexp_replace("text", r"\D", "").alias("digits"), F.replace(F.base64(F.encode("text", "utf-8")), F.lit("\r\n"), F.lit("")).alias("b64"),
    )


PAIRS = O.with_(O.LINES_SQL) + "SELECT doc_id, page_no, ord, "


@query(PAIRS + f"CASE WHEN before IS NULL THEN NULL ELSE {O.join_lines('[before, text]')} END AS joined, before <> '' AND text <> '' AND NOT {O.like('before', P.NO_SPACE_AFTER)} AND NOT {O.like('text', P.NO_SPACE_BEFORE)} AS spaced FROM (SELECT *, lag(text) OVER (PARTITION BY doc_id, page_no ORDER BY ord) AS before FROM lines)")
def join_spacing(spark, d):
    before = F.lag("text").over(Window.partitionBy("doc_id", "page_no").orderBy("ord"))
    rows = lines(spark, d).withColumn("before", before)
    return rows.select("doc_id", "page_no", "ord", F.when(F.col("before").isNotNull(), T.join_lines(F.array("before", "text"))).alias("joined"), T.insert_space(F.col("before"), F.col("text")).alias("spaced"))


@query(O.with_(O.LINES_SQL) + f"SELECT doc_id, page_no, ord, {O.like('text', P.PAGE_MARKER)} AS page_marker, {O.noise('text')} AS noise, {O.item('text')} AS item, {O.like('text', P.ORDERED_ITEM)} AS ordered, {O.strip(O.sub('text', P.LIST_ITEM_BASE))} AS unmarked, {O.like('text', P.NUMBERED_PARAGRAPH)} AS numbered, {O.short('text')} AS short, {O.like(O.strip('text'), P.NUMERIC_CONTINUATION)} AS numeric, {O.start('text')} AS starts, {O.label('text')} AS label, {O._SIGNATURE} AS signature FROM lines")
def line_predicates(spark, d):
    return lines(spark, d).select(
        "doc_id", "page_no", "ord", is_.page_marker("text").alias("page_marker"), is_.margin_noise("text").alias("noise"), is_.list_item("text").alias("item"), is_.ordered_item("text").alias("ordered"),
        is_.list_marker_stripped("text").alias("unmarked"), is_.numbered_paragraph("text").alias("numbered"), is_.short_continuation("text").alias("short"), is_.numeric_continuation("text").alias("numeric"),
        is_.paragraph_start("text").alias("starts"), is_.heading_text("text").alias("label"), is_.signature_artefact("text").alias("signature"),
    )


ILLEGAL = " OR ".join(f"code BETWEEN {a} AND {b}" for a, b in P.ILLEGAL_RANGES)


@query(f"SELECT code, {ILLEGAL} AS illegal, CASE WHEN code + 58880 <= 63071 THEN code + 58880 WHEN code + 58880 - 63071 + 983040 <= 1048573 THEN code + 58880 - 63071 + 983040 ELSE code + 58880 - 63071 + 983040 - 1048573 + 1048576 END AS private FROM (SELECT DISTINCT (unnest([doc_id, doc_id * 7, doc_id * 66]))::BIGINT AS code FROM documents)")
def unicode_private_map(spark, d):
    codes = docs(spark, d, F.explode(F.array("doc_id", F.col("doc_id") * 7, F.col("doc_id") * 66)).alias("code")).distinct()
    return codes.select("code", T.is_illegal_code("code").alias("illegal"), T.private_code("code").alias("private"))


NAMES = "CASE doc_id % 4 WHEN 0 THEN 'a%d%03d_' || doc_id || '.page' WHEN 1 THEN '50%_p%4d%' WHEN 2 THEN 'plain' ELSE 'x%s%12d' END"


@query(f"SELECT doc_id, CASE WHEN regexp_matches(n, '%[0-9]*d') THEN replace(regexp_extract(n, '^(.*?)(%[0-9]*d)(.*)$', 1), '%', '%%') || regexp_extract(n, '^(.*?)(%[0-9]*d)(.*)$', 2) || replace(regexp_extract(n, '^(.*?)(%[0-9]*d)(.*)$', 3), '%', '%%') END AS template, printf('page_%04d_img_%03d.png', doc_id, doc_id % 7) AS asset, lower(printf('%06x', doc_id * 37)) AS colour FROM (SELECT doc_id, {NAMES} AS n FROM documents)")
def filename_template(spark, d):
    named = docs(spark, d, "doc_id").withColumn("n", F.expr(NAMES))
    return named.select("doc_id", T.filename_template("n").alias("template"), T.page_file(F.lit(""), F.col("doc_id"), F.col("doc_id") % 7, "png").alias("asset"), F.ltrim(T.hex_colour(F.col("doc_id") * 37), F.lit("#")).alias("colour"))


@query("SELECT page_id, regexp_replace(regexp_extract(url, '[^/]*$'), '(.)\\.[^.]*$', '\\1') AS stem, lower(regexp_extract(regexp_extract(url, '[^/]*$'), '^.+(\\.[^.]*)$', 1)) AS suffix FROM pages")
def path_parts(spark, d):
    return spark.read.parquet(f"{d}/pages.parquet").select("page_id", T.stem("url").alias("stem"), T.suffix("url").alias("suffix"))


TEMPLATE = ["# comment", '"""', "<html>", "# literal", '"""', "", "@base.css", "$css", '"""', "<body>", '"""', "$pages", "odd"]


@query(f"WITH t AS (SELECT doc_id::VARCHAR AS name, i AS line_no, l[i] AS text FROM (SELECT doc_id, {J._sql(TEMPLATE)} AS l, unnest(range(1, {len(TEMPLATE) + 1}))::INT AS i FROM documents)), w AS (SELECT *, count(*) FILTER (WHERE trim(text) = '\"\"\"') OVER (PARTITION BY name ORDER BY line_no) % 2 = 1 AS inside FROM t), k AS (SELECT name, line_no, CASE WHEN trim(text) = '\"\"\"' THEN 'toggle' WHEN inside THEN 'literal' WHEN text = '' OR text LIKE '#%' THEN 'comment' WHEN text LIKE '@%' THEN 'file' WHEN text LIKE '$%' THEN 'slot' ELSE 'unknown' END AS kind, text FROM w) SELECT name, line_no, kind, CASE WHEN kind IN ('file', 'slot') THEN substr(text, 2) ELSE text END AS value FROM k WHERE kind NOT IN ('toggle', 'comment')")
def template_sections(spark, d):
    rows = docs(spark, d, F.col("doc_id").cast("string").alias("name"), F.posexplode(F.array(*map(F.lit, TEMPLATE))).alias("p", "text"))
    return render.template_sections(rows.select("name", (F.col("p") + 1).alias("line_no"), "text"))


# Spans

SPANS = """spans AS (SELECT doc_id, page_no, ord, block_no, x0 + 7 * (i - 1) AS sx0, y0, x0 + 7 * (i - 1) + 7 * length(w[i]) AS sx1, y1, w[i] AS text, font_size - (i - 1) % 2 AS size,
  (CASE WHEN (i - 1) % 7 = 3 THEN 16 WHEN (i - 1) % 5 = 2 THEN 2 ELSE 0 END)::INT AS flags, i FROM (SELECT *, string_split(text, ' ') AS w, unnest(range(1, len(string_split(text, ' ')) + 1)) AS i FROM lines) WHERE regexp_matches(w[i], '\\S'))"""


@query(O.with_(O.LINES_SQL, SPANS) + f"SELECT doc_id, page_no, ord, string_agg({O.strip('text')}, ' ' ORDER BY i) AS text, max(size) AS size, bool_or(flags = 16) AS bold, bool_or(flags = 2) AS italic, round_even(min(sx0), 0)::INT AS indent FROM spans GROUP BY doc_id, page_no, ord")
def line_entries_from_spans(spark, d):
    return layout.line_entries(layout.spans(lines(spark, d)))


@query(O.with_(O.LINES_SQL, SPANS) + f"SELECT doc_id, page_no, ord, block_no, {O.norm('joined')} AS text, x0, y0, x1, y1, big.size AS font_size, CASE WHEN big.flags = 16 THEN 'Serif-Bold' ELSE 'Serif' END AS font_name, big.flags AS flags FROM (SELECT doc_id, page_no, ord, any_value(block_no) AS block_no, string_agg(text, '' ORDER BY i) AS joined, min(sx0) AS x0, min(y0) AS y0, max(sx1) AS x1, max(y1) AS y1, arg_max({{'size': size, 'flags': flags}}, length(text) * 1000 - i) AS big FROM spans GROUP BY doc_id, page_no, ord)")
def sem_lines_from_spans(spark, d):
    return layout.sem_lines(layout.spans(lines(spark, d)))


@query(O.with_(O.LINES_SQL) + "SELECT doc_id, max(n_pages) AS n_pages, count(*) AS n_lines, sum(length(text))::BIGINT AS n_chars, sum(length(text)) < 200 AS scanned FROM lines GROUP BY doc_id")
def scanned_routing(spark, d):
    return stats.characters(lines(spark, d))


@query(O.with_(O.LINES_SQL) + f", r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY font_size DESC, y0, ord) AS k FROM lines WHERE page_no = 1), t AS (SELECT doc_id, arg_min(text, k) AS found FROM r WHERE k <= 8 AND {O.words(O.strip('text'))} >= 2 AND length({O.strip('text')}) <= 200 AND NOT {O.noise('text')} GROUP BY doc_id) SELECT d.doc_id, coalesce({O.strip('found')}, 'doc-' || d.doc_id) AS title FROM documents d LEFT JOIN t ON d.doc_id = t.doc_id")
def title_guess(spark, d):
    return titled(spark, d)


def titled(spark, d):
    names = docs(spark, d, "doc_id", F.concat(F.lit("in/doc-"), "doc_id", F.lit(".pdf")).alias("name"))
    return segments.titles(lines(spark, d), names)


LISTED = "CASE WHEN ord % 8 IN (3, 4, 5) THEN CASE WHEN doc_id % 2 = 0 THEN '(' || ord || ') ' ELSE '- ' END || text ELSE text END"


@query(O.with_(O.LINES_SQL.replace("lines AS (", "raw_lines AS (", 1), f"lines AS (SELECT * REPLACE ({LISTED} AS text) FROM raw_lines)", O.patterns_cte(), O.reasons_cte(), O.STATS, O.islands_cte(True), O.chunks_cte(True)) + f"SELECT doc_id, page_no, chunk, kind, list_transform(texts, lambda t: {O.escape(O.strip(O.sub('t', P.LIST_ITEM_BASE)))}) AS items FROM chunks WHERE kind IN ('ol', 'ul')")
def list_blocks(spark, d):
    """Over layout lines of which three in eight are list items."""
    listed = lines(spark, d).withColumn("text", F.expr(LISTED))
    return segments.list_items(segments.document_chunks(listed, base=True))


# Regions

REGIONS = "regions AS (SELECT doc_id, (1 + k % 2)::INT AS page_no, (60 + 40 * k)::DOUBLE AS x0, (90 + 150 * k + doc_id % 50)::DOUBLE AS y0, (260 + 40 * k)::DOUBLE AS x1, (160 + 150 * k + doc_id % 50)::DOUBLE AS y1 FROM (SELECT doc_id, unnest(range(3)) AS k FROM documents))"


def regions(spark, d):
    k = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k")
    rows = docs(spark, d, "doc_id").select("doc_id", k)
    return rows.selectExpr("doc_id", "1 + k % 2 AS page_no", "double(60 + 40 * k) AS x0", "double(90 + 150 * k + doc_id % 50) AS y0", "double(260 + 40 * k) AS x1", "double(160 + 150 * k + doc_id % 50) AS y1")


@query(O.with_(O.LINES_SQL, REGIONS) + "SELECT doc_id, page_no, ord FROM lines l WHERE NOT EXISTS (SELECT 1 FROM regions r WHERE r.doc_id = l.doc_id AND r.page_no = l.page_no AND l.x0 < r.x1 AND r.x0 < l.x1 AND l.y0 < r.y1 AND r.y0 < l.y1)")
def region_overlap_anti(spark, d):
    return margins.overlapping_regions(lines(spark, d), regions(spark, d)).select("doc_id", "page_no", "ord")


SHAPES = "shapes AS (SELECT doc_id, page_no, 10 * ord AS seq, x0 - 20 AS x0, y0 - 40 AS y0, x0 + 200 AS x1, y0 + 35 AS y1 FROM lines WHERE ord % 6 = 2)"


@query(O.with_(O.LINES_SQL, SHAPES) + ", h AS (SELECT l.doc_id, l.page_no, l.ord, bit_or(CASE WHEN l.x0 BETWEEN s.x0 AND s.x1 AND l.y0 BETWEEN s.y0 AND s.y1 THEN 1 ELSE 0 END | CASE WHEN l.x1 BETWEEN s.x0 AND s.x1 AND l.y0 BETWEEN s.y0 AND s.y1 THEN 2 ELSE 0 END | CASE WHEN l.x1 BETWEEN s.x0 AND s.x1 AND l.y1 BETWEEN s.y0 AND s.y1 THEN 4 ELSE 0 END | CASE WHEN l.x0 BETWEEN s.x0 AND s.x1 AND l.y1 BETWEEN s.y0 AND s.y1 THEN 8 ELSE 0 END) AS hidden FROM lines l JOIN shapes s ON l.doc_id = s.doc_id AND l.page_no = s.page_no AND s.seq > l.ord * 9 AND l.x0 < s.x1 AND s.x0 < l.x1 AND l.y0 < s.y1 AND s.y0 < l.y1 GROUP BY ALL) SELECT l.doc_id, l.page_no, l.ord * 9 AS seq, (15 - coalesce(hidden, 0))::INT AS visible, coalesce(hidden, 0) <> 0 AS covered FROM lines l LEFT JOIN h ON l.doc_id = h.doc_id AND l.page_no = h.page_no AND l.ord = h.ord")
def char_cover_mask(spark, d):
    rows = lines(spark, d)
    chars = rows.withColumn("seq", F.col("ord") * 9)
    shapes = rows.where("ord % 6 = 2").selectExpr("doc_id", "page_no", "10 * ord AS seq", "x0 - 20 AS x0", "y0 - 40 AS y0", "x0 + 200 AS x1", "y0 + 35 AS y1")
    return regions_.covered_characters(chars, shapes, mode=2)


IMAGES = "images AS (SELECT doc_id, (1)::INT AS page_no, k::INT AS idx, (CASE WHEN k = 3 THEN 0 ELSE 5 + k END)::INT AS xref, (100 + k // 2 * 30 + 0.25 * k)::DOUBLE AS x0, (150.5 - 20 * (k // 2))::DOUBLE AS y0, (300 + k // 2 * 30 + doc_id % 5 * 60 + 0.25 * k)::DOUBLE AS x1, (170.5 + doc_id % 7 * 80)::DOUBLE AS y1, CASE WHEN doc_id % 2 = 0 THEN 'DeviceGray' ELSE 'DeviceRGB' END AS colorspace FROM (SELECT doc_id, unnest(range(5)) AS k FROM documents WHERE length(text) > 0))"


def images(spark, d):
    rows = docs(spark, d, "doc_id", "text").where("length(text) > 0").select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k"))
    return rows.selectExpr("doc_id", "1 AS page_no", "k AS idx", "CASE WHEN k = 3 THEN 0 ELSE 5 + k END AS xref", "double(100 + k div 2 * 30 + 0.25 * k) AS x0", "double(150.5 - 20 * (k div 2)) AS y0", "double(300 + k div 2 * 30 + doc_id % 5 * 60 + 0.25 * k) AS x1", "double(170.5 + doc_id % 7 * 80) AS y1", "CASE WHEN doc_id % 2 = 0 THEN 'DeviceGray' ELSE 'DeviceRGB' END AS colorspace")


@query(O.with_(IMAGES) + "SELECT doc_id, page_no, idx FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page_no, trunc(x0), trunc(y0), trunc(x1), trunc(y1) ORDER BY idx) AS n FROM images WHERE xref <> 0 AND x1 - x0 >= 28 AND y1 - y0 >= 28) WHERE n = 1")
def image_dedupe(spark, d):
    return regions_.distinct_images(images(spark, d)).select("doc_id", "page_no", "idx")


@query(O.with_(O.LINES_SQL, IMAGES) + """, a AS (SELECT *, (x1 - x0) * (y1 - y0) / (612 * 792) AS area FROM images), n AS (SELECT doc_id, page_no, count(*) AS n FROM lines GROUP BY ALL),
o AS (SELECT a.doc_id, a.page_no, a.idx, count(l.doc_id) AS c FROM a LEFT JOIN lines l ON area >= 0.22::DOUBLE AND a.doc_id = l.doc_id AND a.page_no = l.page_no AND a.x0 < l.x1 AND l.x0 < a.x1 AND a.y0 < l.y1 AND l.y0 < a.y1 GROUP BY ALL)
SELECT a.doc_id, a.page_no, a.idx, c AS overlaps, (area >= 0.22::DOUBLE AND abs((x0 + x1) * 0.5 - 306) <= 612 * 0.22::DOUBLE AND abs((y0 + y1) * 0.5 - 396) <= 792 * 0.22::DOUBLE AND (lower(colorspace) LIKE '%gray%' OR (c / n::DOUBLE >= 0.35::DOUBLE AND area >= 0.16::DOUBLE) OR (c / n::DOUBLE <= 0.12::DOUBLE AND area >= 0.30::DOUBLE))) OR ((x1 - x0) / 612 >= 0.88::DOUBLE AND (y1 - y0) / 792 >= 0.88::DOUBLE AND c >= greatest(8, floor(n * 0.25))) AS watermark
FROM a JOIN o ON a.doc_id = o.doc_id AND a.page_no = o.page_no AND a.idx = o.idx JOIN n ON a.doc_id = n.doc_id AND a.page_no = n.page_no""")
def watermark_images(spark, d):
    return regions_.watermark_images(images(spark, d), lines(spark, d), base=True)


@query(O.with_(O.LINES_SQL) + "SELECT doc_id, page_no, block_no, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM lines GROUP BY ALL")
def bbox_union(spark, d):
    return regions_.box_union(lines(spark, d), "doc_id", "page_no", "block_no")


@query(O.with_(O.LINES_SQL) + ", m AS (SELECT doc_id, page_no, ord, least(2 * x0 - 0.5 * y0, 2 * x0 - 0.5 * y1, 2 * x1 - 0.5 * y0, 2 * x1 - 0.5 * y1) + 10 AS ax0, least(0.25 * x0 - y0, 0.25 * x0 - y1, 0.25 * x1 - y0, 0.25 * x1 - y1) + 4 AS ay0, greatest(2 * x0 - 0.5 * y0, 2 * x0 - 0.5 * y1, 2 * x1 - 0.5 * y0, 2 * x1 - 0.5 * y1) + 10 AS ax1, greatest(0.25 * x0 - y0, 0.25 * x0 - y1, 0.25 * x1 - y0, 0.25 * x1 - y1) + 4 AS ay1 FROM lines) SELECT doc_id, page_no, ord, ax0::DOUBLE AS ax0, ay0::DOUBLE AS ay0, ax1::DOUBLE AS ax1, ay1::DOUBLE AS ay1, CASE WHEN greatest(ax0, 100) < least(ax1, 900) AND greatest(ay0, -400) < least(ay1, 0) THEN ((least(ax1, 900) - greatest(ax0, 100)) * (least(ay1, 0) - greatest(ay0, -400)))::DOUBLE END AS common FROM m")
def affine_bbox(spark, d):
    scale, turn = [[F.lit(x) for x in m] for m in ((2.0, 0.0, 0.0, -4.0, 10.0, 4.0), (1.0, -0.0625, -0.25, 0.25, 0.0, 0.0))]
    m = regions_.multiply(scale, turn)
    box = regions_.transform_box(m, [F.col(x) for x in ("x0", "y0", "x1", "y1")])
    found = lines(spark, d).select("doc_id", "page_no", "ord", *(b.alias(f"a{x}") for b, x in zip(box, ("x0", "y0", "x1", "y1"), strict=True)))
    common = regions_.intersection([F.col(f"a{x}") for x in ("x0", "y0", "x1", "y1")], [F.lit(x) for x in (100.0, 0.0, 900.0, -400.0)])
    found = found.withColumn("c", common)
    return found.select("doc_id", "page_no", "ord", "ax0", "ay0", "ax1", "ay1", ((F.col("c.x1") - F.col("c.x0")) * (F.col("c.y1") - F.col("c.y0"))).alias("common"))


CELLS = "list_transform(range(doc_id % 5), lambda r: list_transform(range(2 + doc_id % 6), lambda c: CASE WHEN (r * 7 + c * 3 + doc_id) % 4 = 0 THEN NULL WHEN (r + c + doc_id) % 5 = 0 THEN ' ' ELSE ' r' || r || ' <c' || c || '>' END))"


def tables(spark, d):
    cell = "CASE WHEN (r * 7 + c * 3 + doc_id) % 4 = 0 THEN NULL WHEN (r + c + doc_id) % 5 = 0 THEN ' ' ELSE concat(' r', r, ' <c', c, '>') END"
    rows = f"CASE WHEN doc_id % 5 = 0 THEN array() ELSE transform(sequence(0, int(doc_id % 5) - 1), r -> transform(sequence(0, int(1 + doc_id % 6)), c -> {cell})) END"
    return docs(spark, d, "doc_id").selectExpr("doc_id", f"{rows} AS cells")


@query(f"WITH t AS (SELECT doc_id, {CELLS} AS cells FROM documents), f AS (SELECT *, len(cells) AS rows, 2 + doc_id % 6 AS columns, len(list_filter(flatten(cells), lambda c: coalesce(trim(c), '') <> '')) AS told FROM t) SELECT doc_id, rows >= 2 AND NOT (columns >= 6 AND told / (rows * columns)::DOUBLE < 0.45::DOUBLE) AND told / rows::DOUBLE >= 1.8::DOUBLE AS plausible FROM f WHERE rows > 0 UNION ALL SELECT doc_id, false FROM f WHERE rows = 0")
def table_plausible(spark, d):
    return tables(spark, d).select("doc_id", regions_.plausible_table(F.col("cells")).alias("plausible"))


@query(f"WITH t AS (SELECT doc_id, list_filter({CELLS}, lambda r: len(list_filter(r, lambda c: coalesce(trim(c), '') <> '')) > 0) AS cells FROM documents) SELECT doc_id, CASE WHEN len(cells) = 0 THEN '' ELSE '<table><thead><tr>' || array_to_string(list_transform(cells[1], lambda c: '<th>' || {O.escape('coalesce(trim(c), chr(0))')} || '</th>'), '') || '</tr></thead>' || CASE WHEN len(cells) > 1 THEN '<tbody>' || array_to_string(list_transform(cells[2:], lambda r: '<tr>' || array_to_string(list_transform(r, lambda c: '<td>' || {O.escape('coalesce(trim(c), chr(0))')} || '</td>'), '') || '</tr>'), '') || '</tbody>' ELSE '' END || '</table>' END AS html FROM t".replace("chr(0)", "''"))
def table_html(spark, d):
    return tables(spark, d).select("doc_id", render.table_html(F.col("cells")).alias("html"))


# Style

@query(O.with_(O.LINES_SQL) + "SELECT x1, (row_number() OVER (ORDER BY min({'d': doc_id, 'p': page_no, 'o': ord})) - 1)::INT AS id FROM lines GROUP BY x1")
def style_dictionary(spark, d):
    return style.dictionary(lines(spark, d), "x1", "doc_id", "page_no", "ord")


@query(O.with_(O.LINES_SQL) + ", n AS (SELECT x1, row_number() OVER (ORDER BY min({'d': doc_id, 'p': page_no, 'o': ord})) - 1 AS id FROM lines GROUP BY x1) SELECT (row_number() OVER (ORDER BY x1) - 1)::INT AS ord, '.w' || lower(to_hex(id)) || '{width:' || printf('%.6f', x1) || 'px;}' AS rule FROM n")
def css_dump(spark, d):
    return style.css_rules(style_dictionary(spark, d), "x1", "w", "width")


@query(O.with_(O.LINES_SQL) + ", c AS (SELECT doc_id, x1 - x0 AS w, count(*) AS n FROM lines GROUP BY ALL), b AS (SELECT doc_id, arg_max(w, n * 100000 - w) AS width, max(n) AS n, sum(n) AS total FROM c GROUP BY doc_id) SELECT doc_id, CASE WHEN n > total // 2 AND width > 0.000001::DOUBLE THEN width END AS width, n FROM b")
def most_used_width(spark, d):
    return style.most_used_width(lines(spark, d).withColumn("w", F.col("x1") - F.col("x0")), "doc_id", "w")


@query(O.with_(O.LINES_SQL) + ", u AS (SELECT *, sum(ord % 5 - 2) OVER (PARTITION BY doc_id, page_no ORDER BY ord) AS upto FROM lines) SELECT doc_id, page_no, greatest(0, max(upto + 0.75 * font_size))::DOUBLE AS ascent, least(0, min(upto - 0.25 * font_size))::DOUBLE AS descent FROM u GROUP BY ALL")
def line_ascent(spark, d):
    states = lines(spark, d).selectExpr("doc_id", "page_no", "ord", "double(ord % 5 - 2) AS vertical_align", "double(0.75) AS ascent", "double(-0.25) AS descent", "font_size")
    return style.line_metrics(states, "doc_id", "page_no")


@query(O.with_(O.LINES_SQL) + ", r AS (SELECT DISTINCT doc_id, page_no, (7 * k + doc_id % 3)::INT AS start, k::INT AS clip FROM (SELECT *, unnest(range(4)) AS k FROM lines)) SELECT l.doc_id, l.page_no, l.ord, max_by(r.clip, r.start) AS clip FROM lines l LEFT JOIN r ON l.doc_id = r.doc_id AND l.page_no = r.page_no AND r.start <= l.ord GROUP BY ALL")
def clip_runs(spark, d):
    rows = lines(spark, d).withColumn("key", F.struct("doc_id", "page_no"))
    runs = rows.select("key").distinct().select("key", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("clip")).select("key", (7 * F.col("clip") + F.col("key.doc_id") % 3).cast("int").alias("start"), "clip")
    return style.clip_of_lines(rows, runs, "key").select("key.doc_id", "key.page_no", "ord", "clip")


@query("WITH RECURSIVE o AS (SELECT doc_id AS item_id, CASE WHEN doc_id > 0 AND doc_id % 10 <> 0 THEN doc_id // 3 END AS parent_id, 't' || doc_id AS title FROM documents WHERE doc_id IS NOT NULL), tree(item_id, depth, path) AS (SELECT item_id, 1, title FROM o WHERE parent_id IS NULL UNION ALL SELECT c.item_id, t.depth + 1, t.path || ' / ' || c.title FROM o c JOIN tree t ON c.parent_id = t.item_id) SELECT * FROM tree")
def outline_paths(spark, d):
    items = docs(spark, d, "doc_id").where("doc_id IS NOT NULL").selectExpr("doc_id AS item_id", "CASE WHEN doc_id > 0 AND doc_id % 10 <> 0 THEN doc_id div 3 END AS parent_id", "concat('t', doc_id) AS title")
    return style.outline_paths(spark, items)


KINDS = ["XYZ", "Fit", "FitH", "FitV", "FitR", "FitB", "FitBH", "FitBV", "Odd"]


def _num(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'null' WHEN {x} = floor({x}) THEN ({x})::BIGINT::VARCHAR ELSE regexp_replace(printf('%.3f', {x}), '0+$', '') END"


@query(f"WITH l AS (SELECT doc_id, {J._sql(KINDS)}[doc_id % 9 + 1] AS kind, (doc_id % 4)::INT AS page, CASE WHEN doc_id % 3 > 0 THEN (doc_id * 0.5)::DOUBLE END AS a, (doc_id - 3)::DOUBLE AS b, (doc_id * 0.125)::DOUBLE AS r, CASE WHEN doc_id % 5 > 0 THEN (7 + doc_id)::DOUBLE END AS t, CASE WHEN doc_id % 2 > 0 THEN 1.5::DOUBLE END AS z FROM documents) SELECT doc_id, CASE WHEN page <= 0 THEN '' ELSE '[' || page || CASE kind WHEN 'XYZ' THEN ',\"XYZ\",' || {_num('a')} || ',' || {_num('t')} || ',' || {_num('z')} WHEN 'FitH' THEN ',\"FitH\",' || {_num('t')} WHEN 'FitBH' THEN ',\"FitBH\",' || {_num('t')} WHEN 'FitV' THEN ',\"FitV\",' || {_num('a')} WHEN 'FitBV' THEN ',\"FitBV\",' || {_num('a')} WHEN 'FitR' THEN ',\"FitR\",' || {_num('a')} || ',' || {_num('b')} || ',' || {_num('r')} || ',' || {_num('t')} WHEN 'Fit' THEN ',\"Fit\"' WHEN 'FitB' THEN ',\"FitB\"' ELSE '' END || ']' END AS detail FROM l")
def link_dest_json(spark, d):
    rows = docs(spark, d, "doc_id").withColumn("kind", F.get(F.array(*map(F.lit, KINDS)), (F.col("doc_id") % 9).cast("int")))
    rows = rows.selectExpr("doc_id", "kind", "int(doc_id % 4) AS page", "CASE WHEN doc_id % 3 > 0 THEN doc_id * 0.5D END AS a", "double(doc_id - 3) AS b", "doc_id * 0.125D AS r", "CASE WHEN doc_id % 5 > 0 THEN double(7 + doc_id) END AS t", "CASE WHEN doc_id % 2 > 0 THEN 1.5D END AS z")
    return rows.select("doc_id", style.destination(*(F.col(x) for x in ("kind", "page", "a", "b", "r", "t", "z"))).alias("detail"))


# Records

RECORDS = "records AS (SELECT doc_id, CASE WHEN doc_id % 4 > 0 THEN doc_id END AS file_id, CASE WHEN doc_id % 7 > 0 THEN 'k/' || doc_id END AS s3_key_pdf, CASE WHEN doc_id % 10 = 3 THEN 'bad' END AS skip_reason, CASE WHEN l.id IS NOT NULL THEN 'u' END AS s3_url_frontend FROM documents LEFT JOIN (SELECT DISTINCT doc_id AS id FROM labels) l ON doc_id = l.id)"


def batch(spark, d):
    told = spark.read.parquet(f"{d}/labels.parquet").select(F.col("doc_id").alias("id")).distinct()
    rows = docs(spark, d, "doc_id").join(told, F.col("doc_id") == F.col("id"), "left")
    return rows.selectExpr("doc_id", "CASE WHEN doc_id % 4 > 0 THEN doc_id END AS file_id", "CASE WHEN doc_id % 7 > 0 THEN concat('k/', doc_id) END AS s3_key_pdf", "CASE WHEN doc_id % 10 = 3 THEN 'bad' END AS skip_reason", "CASE WHEN id IS NOT NULL THEN 'u' END AS s3_url_frontend")


@query(O.with_(RECORDS) + "SELECT file_id, s3_key_pdf FROM records WHERE file_id IS NOT NULL AND s3_key_pdf IS NOT NULL AND skip_reason IS NULL AND file_id NOT IN (SELECT file_id FROM records WHERE s3_url_frontend IS NOT NULL AND file_id IS NOT NULL)")
def incremental_skip(spark, d):
    rows = batch(spark, d)
    return records.eligible(rows, records.done(rows)).select("file_id", "s3_key_pdf")


@query(O.with_(RECORDS) + "SELECT file_id FROM records WHERE file_id IS NOT NULL AND s3_key_pdf IS NOT NULL AND skip_reason IS NULL AND file_id NOT IN (SELECT file_id FROM records WHERE s3_url_frontend IS NOT NULL AND file_id IS NOT NULL) ORDER BY file_id LIMIT 25")
def limit_after_skip(spark, d):
    rows = batch(spark, d)
    return records.eligible(rows, records.done(rows), limit=25).select("file_id")


@query(O.with_(RECORDS) + "SELECT greatest((SELECT coalesce(max(file_id), 0) FROM records), (SELECT coalesce(max(doc_id), 0) FROM labels))::BIGINT AS max_id")
def max_file_id(spark, d):
    return records.largest_id(batch(spark, d), spark.read.parquet(f"{d}/labels.parquet").select(F.col("doc_id").alias("file_id")))


@query(O.with_(RECORDS) + "SELECT doc_id, coalesce(file_id, (SELECT max(file_id) FROM records) + row_number() OVER (PARTITION BY file_id IS NULL ORDER BY doc_id)) AS file_id FROM records")
def assign_file_ids(spark, d):
    rows = batch(spark, d)
    return records.assign_ids(rows, "doc_id", records.largest_id(rows)).select("doc_id", "file_id")


@query(O.with_(RECORDS) + "SELECT doc_id, coalesce(file_id, (SELECT max(file_id) FROM records) + row_number() OVER (ORDER BY doc_id)) AS file_id FROM records")
def assign_file_ids_compat(spark, d):
    rows = batch(spark, d)
    return records.assign_ids(rows, "doc_id", records.largest_id(rows), compat=True).select("doc_id", "file_id")


STATUS = "CASE WHEN s3_url_frontend IS NOT NULL THEN 'skipped' WHEN s3_key_pdf IS NULL THEN 'failed' WHEN skip_reason IS NOT NULL THEN 'not_in_write_coll' WHEN file_id IS NULL THEN NULL ELSE 'processed' END"


@query(O.with_(RECORDS) + f"SELECT count(*) FILTER (WHERE s = 'processed') AS processed, count(*) FILTER (WHERE s = 'skipped') AS skipped, count(*) FILTER (WHERE s = 'failed') AS failed, count(*) FILTER (WHERE s = 'not_in_read_coll') AS not_in_read_coll, count(*) FILTER (WHERE s = 'not_in_write_coll') AS not_in_write_coll, count(*) FILTER (WHERE s IS NULL) AS other FROM (SELECT {STATUS} AS s FROM records)")
def status_counts(spark, d):
    return records.status_counts(batch(spark, d).selectExpr(f"{STATUS} AS status"))


@query(O.with_(RECORDS) + "SELECT doc_id, CASE WHEN doc_id % 6 = 1 THEN 'new' ELSE skip_reason END AS skip_reason FROM records UNION ALL SELECT doc_id + 1000000000, 'new' FROM records WHERE doc_id % 6 = 1")
def keyed_update(spark, d):
    rows = batch(spark, d).select("doc_id", "skip_reason")
    hit = rows.where("doc_id % 6 = 1").select("doc_id", F.lit("new").alias("skip_reason"))
    return records.updated(rows, hit.unionByName(hit.withColumn("doc_id", F.col("doc_id") + 1000000000)), "doc_id")


@query(O.with_(O.LINES_SQL) + ", p AS (SELECT doc_id, page_no, sum(length(text)) AS size FROM lines GROUP BY ALL) SELECT doc_id, page_no, coalesce(sum(size) OVER (PARTITION BY doc_id ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) <= 4000 AS kept FROM p")
def tmp_quota(spark, d):
    pages = lines(spark, d).groupBy("doc_id", "page_no").agg(F.sum(F.length("text")).alias("size"))
    return records.within_quota(pages, "doc_id", "page_no", "size", 4000).select("doc_id", "page_no", "kept")


# Documents

@query(O.document_chunks() + ", pages_ AS (SELECT doc_id, page_no, printf('<section class=\"page\" id=\"page-%d\">', page_no) || chr(10) || string_agg('<' || kind || '>' || text || '</' || kind || '>', chr(10) ORDER BY y0, CASE WHEN kind IN ('h1', 'h2', 'h3') THEN 0 ELSE 1 END, chunk) || chr(10) || '</section>' AS part FROM chunks GROUP BY doc_id, page_no) SELECT doc_id, '<!DOCTYPE html>' || chr(10) || '<html lang=\"en\">' || chr(10) || '<head>' || chr(10) || '<meta charset=\"utf-8\">' || chr(10) || '<title>D' || doc_id || '</title>' || chr(10) || '<style>" + render.CSS + "</style>' || chr(10) || '</head>' || chr(10) || '<body>' || chr(10) || '<main class=\"pdf-document\">' || chr(10) || '<h1>D' || doc_id || '</h1>' || chr(10) || string_agg(part, chr(10) ORDER BY page_no) || chr(10) || '</main>' || chr(10) || '</body>' || chr(10) || '</html>' AS html FROM pages_ GROUP BY doc_id")
def doc_html_semantic(spark, d):
    names = docs(spark, d, "doc_id", F.concat(F.lit("D"), "doc_id").alias("title"))
    return render.document_html(render.page_fragments(segments.document_chunks(lines(spark, d))), names)


@query(O.with_(J.LINES_SQL, M.ENTRIES, M.ZONED, M.MERGED, M.HTML) + "SELECT doc_id, html FROM html")
def doc_html_judgment(spark, d):
    return render.judgment_html(para_merge_s2(spark, d))


@query(O.with_(O.LINES_SQL, O.patterns_cte(), O.STATS) + ", k AS (SELECT doc_id, list_sort(list(key)) AS keys FROM patterns GROUP BY doc_id), n AS (SELECT doc_id, max(n_pages) AS n FROM lines GROUP BY doc_id) SELECT s.doc_id, '{\"title\":\"D' || s.doc_id || '\",\"pages\":' || n || ',\"stats\":{\"body_font\":' || body_font || ',\"line_gap\":' || line_gap || ',\"left_indent\":' || left_indent || ',\"right_edge\":' || right_edge || '},\"repeated\":[' || coalesce('\"' || array_to_string(keys, '\",\"') || '\"', '') || ']}' AS manifest FROM stats s JOIN n ON s.doc_id = n.doc_id LEFT JOIN k ON s.doc_id = k.doc_id")
def doc_manifest(spark, d):
    raw = lines(spark, d)
    names = docs(spark, d, "doc_id", F.concat(F.lit("D"), "doc_id").alias("title"))
    return render.manifests(stats.doc_stats(raw), stats.characters(raw).select("doc_id", "n_pages"), names, margins.repeated_patterns(raw))


# Folds: no SQL; tested against Python

@query()
def baseline_fragment_merge(spark, d):
    return folds.baseline_fragments(fragments(spark, d))


def fragments(spark, d):
    """Each layout line as two fragments on one baseline, 20 apart in every seventh line."""
    cut = F.greatest(F.lit(1), F.floor(F.length("text") / 2).cast("int"))
    left = F.struct(F.substring(F.col("text"), F.lit(1), cut).alias("text"), F.col("x0").alias("x0"), (F.col("x0") + 7 * cut).alias("x1"))
    right = F.struct(F.substring(F.col("text"), cut + 1, F.length("text")).alias("text"), (F.col("x0") + 7 * cut + F.when(F.col("ord") % 7 == 0, 20).otherwise(2)).alias("x0"), F.col("x1").alias("x1"))
    rows = lines(spark, d).select("doc_id", "page_no", F.col("ord").alias("o"), "y0", "y1", "font_size", F.posexplode(F.array(left, right)).alias("i", "f")).where("f.text <> ''")
    return rows.select("doc_id", "page_no", (F.col("o") * 2 + F.col("i")).alias("ord"), "f.text", "f.x0", "y0", "f.x1", "y1", "font_size")


@query()
def coalesce_elements(spark, d):
    raw = lines(spark, d)
    return folds.coalesced_elements(segments.document_chunks(raw), stats.doc_stats(raw))


@query()
def offset_drift(spark, d):
    gaps = F.transform(F.split("text", " "), lambda w: F.length(w) * 0.3)
    return folds.offset_drift(lines(spark, d).select("doc_id", "page_no", "ord", gaps.alias("gaps")))


@query("SELECT doc_id, '<span' || CASE WHEN doc_id % 3 > 0 OR doc_id % 4 > 0 THEN ' style=\"' || CASE WHEN doc_id % 3 > 0 THEN 'font-size:' || (12 + doc_id % 3) || 'px;' ELSE '' END || CASE WHEN doc_id % 4 > 0 THEN 'color:#' || lower(printf('%06x', doc_id % 4 * 255)) || ';' ELSE '' END || '\"' ELSE '' END || '>' || " + O.escape("text") + " || '</span>' AS html FROM documents WHERE text IS NOT NULL")
def span_html(spark, d):
    spans = F.array(F.struct(F.col("text"), (12 + F.col("doc_id") % 3).alias("size"), (F.col("doc_id") % 4 * 255).alias("color")))
    return docs(spark, d, "doc_id", "text").where("text IS NOT NULL").select("doc_id", render.span_html(spans).alias("html"))


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '<style>' || text || '</style>' WHEN 1 THEN '<script src=\"a.js\"></script>' WHEN 2 THEN 'data:image/png;base64,' || base64(encode(text)) END AS tag FROM documents WHERE text IS NOT NULL")
def embed_or_link(spark, d):
    name = F.get(F.array(*map(F.lit, ("x.css", "a.js", "b.png", "c.woff", "none"))), (F.col("doc_id") % 5).cast("int"))
    return docs(spark, d, "doc_id", "text").where("text IS NOT NULL").select("doc_id", render.embed(name, F.col("text"), {".js": False}).alias("tag"))


@query("SELECT doc_id, coalesce(list_min(list_filter([CASE WHEN doc_id % 3 > 0 THEN doc_id % 3 * 0.5 END, CASE WHEN doc_id % 4 > 0 THEN doc_id / 612.0 END, CASE WHEN doc_id % 5 > 0 THEN doc_id / 792.0 END], lambda x: x > 0.000001)), 1)::DOUBLE AS zoom, least(144.0, 648000.0 / greatest(612.0, doc_id * 10))::DOUBLE AS dpi, doc_id % 8 IN (0, 2, 4, 6) AS fill, doc_id % 8 IN (1, 2, 5, 6) AS stroke FROM documents".replace("doc_id / 612.0", "doc_id / 612.0::DOUBLE").replace("doc_id / 792.0", "doc_id / 792.0::DOUBLE").replace("648000.0", "648000.0::DOUBLE"))
def render_parameters(spark, d):
    i = F.col("doc_id")
    given = lambda k, x: F.when(i % k > 0, x)
    fill, stroke = style.render_mode(i % 8)
    zoom = style.zoom(given(3, i % 3 * 0.5), given(4, i.cast("double")), given(5, i.cast("double")), F.lit(612.0), F.lit(792.0))
    return docs(spark, d, "doc_id").select("doc_id", zoom.alias("zoom"), style.clamped_dpi(F.lit(144.0), F.lit(612.0), i * 10.0).alias("dpi"), fill.alias("fill"), stroke.alias("stroke"))


from . import drawing  # noqa: E402, F401  registers its queries
