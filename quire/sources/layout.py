"""Layout relations: lines of pages with their boxes.

`layout_lines` derives a layout from plain documents (64 characters a line, 24 lines a page, a running
header and footer), so that every operator downstream of an extractor can run on any corpus. A real
extractor delivers the same columns; see `line_entries` and `sem_lines` for its nested spans.
All relations are keyed by doc_id and page_no; `ord` orders the lines of a page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T

WIDTH, HEIGHT = 612.0, 792.0
CHARS, LINES = 64, 24


def layout_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, page_no, n_pages, ord, text, x0, y0, x1, y1, font_size, flags, block_no)."""
    flat = F.regexp_replace("text", r"[\n\r]", " ")
    sized = docs.where(F.length("text") > 0).select("doc_id", "source", flat.alias("flat"), F.ceil(F.length("text") / CHARS).cast("int").alias("n"))
    sized = sized.withColumn("n_pages", F.ceil(F.col("n") / LINES).cast("int"))

    parts = F.regexp_extract_all("flat", F.lit("(?s).{1,%d}" % CHARS), F.lit(0))  # one pass, where substrings would each count from the start

    def line(piece: Column, i: Column) -> Column:
        k = i % LINES
        x0 = F.when((F.col("doc_id") + k) % 5 == 0, 96.0).otherwise(72.0)
        return _row(F.floor(i / LINES).cast("int") + 1, k + 1, T.normalize(piece), x0, 40.0 + 29.0 * k, x0 + 7.0 * F.length(piece), 12.0,
                    F.when((F.col("doc_id") + i) % 17 == 0, 14.0).otherwise(11.0),
                    F.when((F.col("doc_id") + i) % 17 == 0, 16).when((F.col("doc_id") + i) % 11 == 0, 2).otherwise(0), F.floor(k / 6).cast("int"))

    def margin(p: Column, footer: bool) -> Column:
        words = F.concat(F.lit("Page "), p, F.lit(" of "), F.col("n_pages")) if footer else F.coalesce("source", F.lit(""))
        y0 = F.lit(760.0 if footer else 20.0)
        return _row(p, F.lit(25 if footer else 0), words, F.lit(72.0), y0, 72.0 + 7.0 * F.length(words), 12.0, F.lit(11.0), F.lit(0), F.lit(101 if footer else 100))

    pages = F.sequence(F.lit(1), F.col("n_pages"))
    rows = F.concat(F.transform(parts, line), F.transform(pages, lambda p: margin(p, False)), F.transform(pages, lambda p: margin(p, True)))
    return sized.select("doc_id", "n_pages", F.inline(rows)).where("text <> ''")


def _row(page_no, ord_, text, x0, y0, x1, height, size, flags, block) -> Column:
    cells = {"page_no": page_no.cast("int"), "ord": ord_.cast("int"), "text": text, "x0": x0.cast("double"), "y0": y0.cast("double"), "x1": x1.cast("double"), "y1": (y0 + height).cast("double"), "font_size": size.cast("double"), "flags": flags.cast("int"), "block_no": block.cast("int")}
    return F.struct(*(c.alias(name) for name, c in cells.items()))


def page_range(lines: DataFrame, first: int, last: int) -> DataFrame:
    """Lines of the pages from first to last, both clamped to each document's pages."""
    low = F.least(F.greatest(F.lit(first), F.lit(1)), F.col("n_pages"))
    return lines.where(F.col("page_no").between(low, F.greatest(low, F.least(F.lit(last), F.col("n_pages")))))


def page_geometry(lines: DataFrame) -> DataFrame:
    """(doc_id, page_no, width, height, n_lines) of each page."""
    return lines.groupBy("doc_id", "page_no").agg(F.lit(WIDTH).alias("width"), F.lit(HEIGHT).alias("height"), F.count("*").alias("n_lines"))


def source_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, text): the lines that the text itself has, blank ones left out."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "text")).where(F.col("text").rlike(r"\S"))


def spans(lines: DataFrame) -> DataFrame:
    """Lines with nested spans, a span for each word: what a page's dictionary holds before it is flattened."""
    words = F.split("text", " ")

    def span(w: Column, i: Column) -> Column:
        return F.struct(i.alias("span_id"), w.alias("text"), (F.col("x0") + 7 * i).alias("x0"), F.col("y0").alias("y0"), (F.col("x0") + 7 * i + 7 * F.length(w)).alias("x1"), F.col("y1").alias("y1"),
                        (F.col("font_size") - i % 2).alias("size"), F.when(i % 7 == 3, 16).when(i % 5 == 2, 2).otherwise(0).alias("flags"), F.when(i % 7 == 3, "Serif-Bold").otherwise("Serif").alias("font"))

    return lines.select("doc_id", "page_no", "ord", "block_no", F.transform(words, span).alias("spans"))


def line_entries(nested: DataFrame) -> DataFrame:
    """One row for each line: stripped spans joined by a space, the largest size, style bits, indent.

    Blank spans, and lines that have no other, are dropped. Bit 16 is bold, bit 2 italic.
    """
    full = F.filter("spans", lambda s: s.text.rlike(r"\S"))
    found = nested.withColumn("spans", full).where(F.size("spans") > 0)
    bit = lambda b: F.exists("spans", lambda s: s.flags.bitwiseAND(b) != 0)
    return found.select(
        "doc_id", "page_no", "ord", F.array_join(F.transform("spans", lambda s: T.strip(s.text)), " ").alias("text"), F.array_max(F.transform("spans", lambda s: s["size"])).alias("size"),
        bit(16).alias("bold"), bit(2).alias("italic"), F.bround(F.array_min(F.transform("spans", lambda s: s.x0))).cast("int").alias("indent"),
    )


def sem_lines(nested: DataFrame) -> DataFrame:
    """One row for each line: spans joined as they are, the union of their boxes, and the size, font and
    flags of the longest span, the first one on ties."""
    full = F.filter("spans", lambda s: s.text.rlike(r"\S"))
    found = nested.withColumn("spans", full).where(F.size("spans") > 0)
    longest = F.array_max(F.transform("spans", lambda s, i: F.struct(F.length(s.text).alias("n"), (-i).alias("i"), s["size"].alias("size"), s.font.alias("font"), s.flags.alias("flags"))))
    side = lambda f, name: f(F.transform("spans", lambda s: s[name])).alias(name)
    found = found.select("doc_id", "page_no", "ord", "block_no", T.normalize(F.array_join(F.transform("spans", lambda s: s.text), "")).alias("text"), side(F.array_min, "x0"), side(F.array_min, "y0"), side(F.array_max, "x1"), side(F.array_max, "y1"), longest.alias("longest"))
    return found.select("*", F.col("longest.size").alias("font_size"), F.col("longest.font").alias("font_name"), F.col("longest.flags").alias("flags")).drop("longest").where("text <> ''")


#: DuckDB: the lines of layout_lines, for the SQL that queries are held against.
LINES_SQL = r"""lines AS (
  WITH sized AS (SELECT doc_id, source, translate(text, chr(10) || chr(13), '  ') AS flat, ceil(length(text) / 64.0)::INT AS n, ceil(ceil(length(text) / 64.0) / 24.0)::INT AS n_pages FROM documents WHERE length(text) > 0),
  cut AS (SELECT doc_id, n_pages, i, i % 24 AS k, substr(flat, (i * 64 + 1)::BIGINT, 64) AS piece FROM (SELECT *, unnest(range(n))::INT AS i FROM sized)),
  body AS (SELECT doc_id, n_pages, (i // 24 + 1)::INT AS page_no, (k + 1)::INT AS ord, trim(regexp_replace(replace(replace(piece, chr(160), ' '), chr(173), ''), '[ \t]+', ' ', 'g'), E' \t\n\r\f\x0b') AS text,
           (CASE WHEN (doc_id + k) % 5 = 0 THEN 96 ELSE 72 END)::DOUBLE AS x0, (40 + 29 * k)::DOUBLE AS y0, (CASE WHEN (doc_id + k) % 5 = 0 THEN 96 ELSE 72 END + 7 * length(piece))::DOUBLE AS x1, (52 + 29 * k)::DOUBLE AS y1,
           (CASE WHEN (doc_id + i) % 17 = 0 THEN 14 ELSE 11 END)::DOUBLE AS font_size, (CASE WHEN (doc_id + i) % 17 = 0 THEN 16 WHEN (doc_id + i) % 11 = 0 THEN 2 ELSE 0 END)::INT AS flags, (k // 6)::INT AS block_no FROM cut),
  page AS (SELECT doc_id, coalesce(source, '') AS source, n_pages, unnest(range(1, n_pages + 1))::INT AS p FROM sized),
  head AS (SELECT doc_id, n_pages, p, 0 AS ord, source AS text, 72::DOUBLE, 20::DOUBLE, (72 + 7 * length(source))::DOUBLE, 32::DOUBLE, 11::DOUBLE, 0, 100 FROM page),
  foot AS (SELECT doc_id, n_pages, p, 25 AS ord, 'Page ' || p || ' of ' || n_pages AS text, 72::DOUBLE, 760::DOUBLE, (72 + 7 * length('Page ' || p || ' of ' || n_pages))::DOUBLE, 772::DOUBLE, 11::DOUBLE, 0, 101 FROM page)
  SELECT * FROM body WHERE text <> '' UNION ALL SELECT * FROM head WHERE text <> '' UNION ALL SELECT * FROM foot)"""
