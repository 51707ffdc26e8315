"""HTML and manifests from relations, by ordered string aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as T

CSS = "body{font-family:serif}"


def table_html(rows: Column) -> Column:
    """An array of rows of cells: blank rows go, the first row is the head."""
    full = F.filter(rows, lambda r: F.exists(r, lambda c: F.coalesce(T.strip(c), F.lit("")) != ""))
    cell = lambda c: T.escape_html(T.normalize(F.coalesce(c, F.lit(""))))

    def row(r: Column, tag: str) -> Column:
        return F.array_join(F.transform(r, lambda c: F.concat(F.lit(f"<{tag}>"), cell(c), F.lit(f"</{tag}>"))), "")

    head = F.concat(F.lit("<table><thead><tr>"), row(F.get(full, F.lit(0)), "th"), F.lit("</tr></thead>"))
    rest = F.slice(full, F.lit(2), F.greatest(F.size(full) - 1, F.lit(0)))
    body = F.concat(F.lit("<tbody>"), F.array_join(F.transform(rest, lambda r: F.concat(F.lit("<tr>"), row(r, "td"), F.lit("</tr>"))), ""), F.lit("</tbody>"))
    return F.when(F.size(full) == 0, "").otherwise(F.concat(head, F.when(F.size(full) > 1, body).otherwise(""), F.lit("</table>")))


def page_fragments(chunks: DataFrame) -> DataFrame:
    """(doc_id, page_no, html): chunks in page order (headings first at one height), each in its tag."""
    order = F.struct(F.bround("y0", 1).alias("a"), F.when(F.col("kind").isin("h1", "h2", "h3"), 0).otherwise(1).alias("b"), F.col("chunk").alias("c"), F.concat(F.lit("<"), "kind", F.lit(">"), "text", F.lit("</"), "kind", F.lit(">")).alias("html"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(order)), lambda s: s.html), "\n")
    return chunks.groupBy("doc_id", "page_no").agg(F.concat(F.format_string('<section class="page" id="page-%d">\n', "page_no"), body, F.lit("\n</section>")).alias("html"))


def document_html(pages: DataFrame, titles: DataFrame, css: str = CSS) -> DataFrame:
    """(doc_id, html): a document's pages in a frame with its title (doc_id, title)."""
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page_no", "html"))), lambda s: s.html), "\n")
    title = T.escape_html("title")
    head = F.concat(F.lit('<!DOCTYPE html>\n<html lang="en">\n<head>\n<meta charset="utf-8">\n<title>'), title, F.lit(f'</title>\n<style>{css}</style>\n</head>\n<body>\n<main class="pdf-document">\n<h1>'), title, F.lit("</h1>\n"))
    return pages.groupBy("doc_id").agg(body.alias("body")).join(titles, "doc_id").select("doc_id", F.concat(head, F.col("body"), F.lit("\n</main>\n</body>\n</html>")).alias("html"))


def judgment_html(paragraphs: DataFrame) -> DataFrame:
    """(doc_id, html) of merged paragraphs: quotes lie within the open paragraph's block, ids are made unique.

    A numbered or plain paragraph opens a block that the quotes behind it stay in; a heading closes it.
    """
    w = Window.partitionBy("doc_id").orderBy("n")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    text = T.escape_html("text")
    again = F.row_number().over(Window.partitionBy("doc_id", "kind", "num").orderBy("n"))
    digits = F.regexp_replace("num", r"\D", "")
    ident = F.concat(F.lit("para-"), digits, F.when(again > 1, F.concat(F.lit("-"), again)).otherwise(""))
    opens = F.col("kind").isin("para", "body")
    last = F.last(F.when(opens, "open").when(F.col("kind") == "heading", "shut"), True).over(upto.rowsBetween(Window.unboundedPreceding, -1))
    open_before = F.coalesce(last, F.lit("shut")) == "open"
    close = F.when(open_before & (F.col("kind") != "quote"), "</div>").otherwise("")
    para = F.concat(F.lit('<div class="block" id="'), ident, F.lit('"><p><span>'), F.col("num"), F.lit("</span> "), text, F.lit("</p>"))
    piece = F.concat(close, F.when(F.col("kind") == "heading", F.concat(F.lit("<h2>"), text, F.lit("</h2>"))).when(F.col("kind") == "quote", F.concat(F.lit("<blockquote>"), text, F.lit("</blockquote>"))).when(F.col("kind") == "para", para).otherwise(F.concat(F.lit('<div class="block"><p>'), text, F.lit("</p>"))))
    shut = F.last(F.when(opens, "open").when(F.col("kind") == "heading", "shut"), True).over(Window.partitionBy("doc_id").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = paragraphs.select("doc_id", "n", piece.alias("piece"), shut.alias("shut"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "piece"))), lambda s: s.piece), "\n")
    return rows.groupBy("doc_id").agg(F.concat(F.lit("<article>\n"), body, F.when(F.first("shut") == "open", "</div>").otherwise(""), F.lit("\n</article>")).alias("html"))


def span_html(spans: Column) -> Column:
    """Spans with a style where size isn't 12 or the colour isn't black."""

    def one(s: Column) -> Column:
        size = F.when(s["size"] != 12, F.concat(F.lit("font-size:"), s["size"].cast("int").cast("string"), F.lit("px;"))).otherwise("")
        colour = F.when(s["color"] != 0, F.concat(F.lit("color:"), T.hex_colour(s["color"]), F.lit(";"))).otherwise("")
        style = F.concat(size, colour)
        return F.concat(F.lit("<span"), F.when(style != "", F.concat(F.lit(' style="'), style, F.lit('"'))).otherwise(""), F.lit(">"), T.escape_html(s["text"]), F.lit("</span>"))

    return F.array_join(F.transform(spans, one), "")


def manifests(stats: DataFrame, counts: DataFrame, titles: DataFrame, patterns: DataFrame) -> DataFrame:
    """(doc_id, manifest): page count, title, statistics and sorted repeated texts as JSON."""
    keys = patterns.groupBy("doc_id").agg(F.array_sort(F.collect_set("key")).alias("keys"))
    found = stats.join(counts, "doc_id").join(titles, "doc_id").join(keys, "doc_id", "left")
    json = F.to_json(F.struct("title", F.col("n_pages").alias("pages"), F.struct("body_font", "line_gap", "left_indent", "right_edge").alias("stats"), F.coalesce("keys", F.array().cast("array<string>")).alias("repeated")))
    return found.select("doc_id", json.alias("manifest"))


def template_sections(lines: DataFrame) -> DataFrame:
    """(name, line_no, kind, value) of a template manifest's lines (name, line_no, text).

    A line of three quotes turns literal text on and off; outside, # is a comment, @ a file, $ a slot.
    """
    w = Window.partitionBy("name").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    quote = T.strip("text") == '"""'
    inside = F.sum(quote.cast("int")).over(w) % 2 == 1
    first = F.substring("text", 1, 1)
    kind = F.when(quote, "toggle").when(inside, "literal").when((F.col("text") == "") | (first == "#"), "comment").when(first == "@", "file").when(first == "$", "slot").otherwise("unknown")
    found = lines.select("name", "line_no", kind.alias("kind"), F.when(kind.isin("file", "slot"), F.substring("text", F.lit(2), F.length("text"))).otherwise(F.col("text")).alias("value"))
    return found.where(~F.col("kind").isin("toggle", "comment"))


def embed(name: Column, content: Column, flags: dict[str, bool]) -> Column:
    """How a side file enters the page: by suffix, embedded or linked."""
    ending = T.suffix(name)
    out = F.lit(None).cast("string")
    tags = {".css": ("<style>", "</style>", '<link rel="stylesheet" href="', '"/>'), ".js": ("<script>", "</script>", '<script src="', '"></script>')}
    for suffix, (a, b, c, d) in tags.items():
        out = F.when(ending == suffix, F.concat(F.lit(a), content, F.lit(b)) if flags.get(suffix, True) else F.concat(F.lit(c), name, F.lit(d))).otherwise(out)
    image = F.concat(F.lit("data:image/"), F.substring(ending, 2, 9), F.lit(";base64,"), F.replace(F.base64(content.cast("binary")), F.lit("\r\n"), F.lit("")))
    return F.when(ending.isin(".png", ".jpg", ".svg"), image if flags.get("image", True) else name).otherwise(out)
