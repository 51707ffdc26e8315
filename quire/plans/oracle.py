"""DuckDB SQL for the registered queries, written apart from the Spark operators."""

from __future__ import annotations

from quire.functions import patterns as P
from quire.sources.layout import LINES_SQL

WS = r"E' \t\n\r\f\x0b'"


def q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def like(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(pattern)})"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def norm(x: str) -> str:
    return strip(rf"regexp_replace(regexp_replace(replace(replace({x}, chr(160), ' '), chr(173), ''), '[ \t]+', ' ', 'g'), '\s*\n\s*', ' ', 'g')")


def hidden(x: str) -> str:
    once = lambda y: rf"regexp_replace({y}, '(^|[^0-9A-Za-z_À-ÿ])[0-9]+($|[^0-9A-Za-z_À-ÿ])', '\1#\2', 'g')"
    return once(once(x))


def key(x: str) -> str:
    return hidden(f"lower({norm(x)})")


def words(x: str) -> str:
    return rf"len(list_filter(regexp_split_to_array({x}, '\s+'), lambda w: w <> ''))"


def upper(x: str) -> str:
    return f"({x} = upper({x}) AND {x} <> lower({x}))"


def lower_start(x: str) -> str:
    return f"(left({x}, 1) = lower(left({x}, 1)) AND left({x}, 1) <> upper(left({x}, 1)))"


def upper_start(x: str) -> str:
    return f"(left({x}, 1) = upper(left({x}, 1)) AND left({x}, 1) <> lower(left({x}, 1)))"


def escape(x: str) -> str:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        x = f"replace({x}, {q(a)}, {q(b)})"
    return x


def markup(x: str) -> str:
    for a, b in (("&", "&amp;"), ('"', "&quot;"), ("'", "&apos;"), ("<", "&lt;"), (">", "&gt;")):
        x = f"replace({x}, {q(a)}, {q(b)})"
    return x


def json(x: str) -> str:
    for a in ("\\", '"', "'", "/"):
        x = f"replace({x}, {q(a)}, {q(chr(92) + a)})"
    for code, letter in ((8, "b"), (12, "f"), (10, "n"), (13, "r"), (9, "t")):
        x = f"replace({x}, chr({code}), {q(chr(92) + letter)})"
    return x


def sub(x: str, pattern: str) -> str:
    return f"regexp_replace({x}, {q(pattern)}, '')"


def label(x: str) -> str:
    t = strip(x)
    return f"({t} <> '' AND (({words(t)} <= 10 AND {upper(t)}) OR ({t} LIKE '%:' AND {words(t)} <= 12) OR {like(t, P.LEGAL_LABEL)}))"


def item(x: str) -> str:
    return f"(NOT {like(strip(x), P.YEAR_START)} AND {like(strip(x), P.LIST_ITEM)})"


def noise(x: str) -> str:
    t = f"lower({strip(x)})"
    return f"({t} = '' OR {like(t, P.PAGE_NUMBER)} OR {like(t, P.LINK)})"


def caps(x: str) -> str:
    t = strip(x)
    return f"({t} <> '' AND length({t}) <= 120 AND {upper(t)} AND {words(t)} <= 12)"


def heading(x: str, font: str, body: str, base: bool = False) -> str:
    t = strip(x)
    more = f" OR {like(t, P.HEADING_LABEL)}" if base else ""
    return f"({words(x)} BETWEEN 1 AND 18 AND ({font} >= {body} + 2.5 OR {caps(t)} OR {like(t, P.NUMBERED_HEADING)} OR ({t} LIKE '%:' AND {words(x)} <= 10){more}))"


def short(x: str) -> str:
    t = strip(x)
    return f"((length({t}) <= 8 AND {like(t, P.SHORT_NUMBER)}) OR ({words(t)} <= 3 AND {like(t, P.SHORT_MARK)}))"


def start(x: str) -> str:
    t = strip(x)
    return f"({item(t)} OR {like(t, P.MULTILEVEL_START)} OR {like(t, P.CAPITAL_RUN)})"


def goes_on(p: str, x: str, wrapped: str = "false", base: bool = False) -> str:
    p, t = strip(p), strip(x)
    is_item = like(t, P.LIST_ITEM_BASE) if base else item(t)
    shorts = "" if base else f"WHEN {short(t)} THEN true "
    return (
        f"(CASE WHEN {p} = '' OR {t} = '' OR {is_item} THEN false {shorts}WHEN regexp_matches({p}, '[:;]$') AND {upper_start(t)} THEN false "
        f"WHEN {p} LIKE '%-' OR {lower_start(t)} THEN true ELSE NOT regexp_matches({p}, '[.?!:]$') OR ({wrapped} AND NOT {start(t)}) END)"
    )


def join_lines(texts: str) -> str:
    r = strip("r")
    spaced = f"l <> '' AND NOT {like('l', P.NO_SPACE_AFTER)} AND NOT {like(r, P.NO_SPACE_BEFORE)}"
    hyphen = f"CASE WHEN {like(r, P.NUMERIC_CONTINUATION)} OR NOT {lower_start(r)} THEN l ELSE left(l, -1) END"
    return f"list_reduce({texts}, lambda l, r: CASE WHEN {r} = '' THEN l WHEN l = '' THEN {r} WHEN l LIKE '%-' THEN {hyphen} || {r} WHEN {spaced} THEN l || ' ' || {r} ELSE l || {r} END, '')"


HEAD, FOOT = "y0 <= 792 * 0.12::DOUBLE", "y1 >= 792 * (1 - 0.10::DOUBLE)"


def patterns_cte(compat: bool = False) -> str:
    count = "arg_max(n, band)" if compat else "max(n)"
    return f"""keyed AS MATERIALIZED (SELECT *, {key("text")} AS key FROM lines),
bands AS (SELECT DISTINCT doc_id, n_pages, page_no, key, 0 AS band FROM keyed WHERE {HEAD} AND key <> '' UNION ALL SELECT DISTINCT doc_id, n_pages, page_no, key, 1 FROM keyed WHERE {FOOT} AND key <> ''),
patterns AS (SELECT doc_id, key FROM (SELECT doc_id, n_pages, key, {count} AS n FROM (SELECT doc_id, n_pages, key, band, count(*) AS n FROM bands GROUP BY ALL) GROUP BY ALL) WHERE n >= greatest(2, ceil(n_pages * 0.6::DOUBLE)))"""


_T = f"lower({norm('text')})"
_SIGNATURE = f"({_T} LIKE '%signature not verified%' OR {_T} LIKE '%digitally signed by%' OR regexp_matches({_T}, '^reason:?$') OR ({_T} LIKE '%ist%' AND {like(_T, P.CLOCK)}))"
_N = norm("text")
_LETTERS, _UPPERS = f"length(regexp_replace({_N}, '[^A-Za-z]', '', 'g'))", f"length(regexp_replace({_N}, '[^A-Z]', '', 'g'))"
WATERMARK = (
    f"(length({_N}) <= 90 AND {_LETTERS} > 0 AND (({_UPPERS} / {_LETTERS}::DOUBLE >= 0.82::DOUBLE AND {words(_N)} BETWEEN 1 AND 8 AND NOT regexp_matches({_N}, '[.?!:]$')) OR {like(_N, P.WATERMARK_WORD)}) "
    "AND y0 BETWEEN 792 * 0.18::DOUBLE AND 792 * 0.82::DOUBLE AND abs((y0 + y1) * 0.5 - 396) <= 792 * 0.32::DOUBLE AND (x1 - x0) / 612 >= 0.34::DOUBLE AND font_size >= 20)"
)
SIDE = f"({strip('text')} = '' OR (length({strip('text')}) <= 2 AND {like(strip('text'), P.SIDE_LETTER)} AND (x0 < 612 * 0.08::DOUBLE OR x1 > 612 * 0.92::DOUBLE)))"


def reasons_cte(compat: bool = False) -> str:
    number = "key" if compat else _T
    return f"""reasons AS (SELECT k.* EXCLUDE (key), CASE WHEN p.key IS NOT NULL THEN 'repeated' WHEN {_SIGNATURE} THEN 'signature' WHEN ({HEAD} OR {FOOT}) AND {like(number.replace("key", "k.key"), P.PAGE_NUMBER)} THEN 'page_number'
  WHEN {WATERMARK} THEN 'watermark' WHEN {SIDE} THEN 'side_margin' END AS reason FROM keyed k LEFT JOIN patterns p ON k.doc_id = p.doc_id AND k.key = p.key)"""


STATS = f"""gaps AS (SELECT *, y0 - lag(y1) OVER (PARTITION BY doc_id, page_no ORDER BY y0, x0, ord) AS gap FROM lines),
told AS MATERIALIZED (SELECT * FROM gaps WHERE NOT {noise("text")}),
medians AS (SELECT doc_id, median(font_size) AS body_font, coalesce(median(gap) FILTER (WHERE gap BETWEEN 0 AND 40), 3) AS line_gap, median(x0) AS left_indent, median(x1) AS right_edge, median(y1 - y0) AS line_height,
  median(x1 - x0) AS line_width, avg(CASE WHEN {like("text", P.LIST_ITEM_BASE)} THEN 1 ELSE 0 END) AS items, avg(CASE WHEN {caps("text")} THEN 1 ELSE 0 END) AS caps FROM told GROUP BY doc_id),
wide AS (SELECT t.doc_id, avg(CASE WHEN x1 - x0 >= line_width * 0.9::DOUBLE THEN 1 ELSE 0 END) AS wide FROM told t JOIN medians m ON t.doc_id = m.doc_id GROUP BY t.doc_id),
stats AS (SELECT m.doc_id, body_font, line_gap, left_indent, right_edge, line_height, (items >= 0.08::DOUBLE)::INT + (caps >= 0.04::DOUBLE)::INT + (wide >= 0.55::DOUBLE)::INT >= 2 AS judis FROM medians m JOIN wide w ON m.doc_id = w.doc_id)"""

_W = "PARTITION BY r.doc_id, r.page_no ORDER BY y0, x0, ord"
_PREVIOUS = ", ".join(f"lag({x}) OVER ({_W}) AS p_{x}" for x in ("text", "x0", "x1", "y1", "font_size", "block_no"))
_WRAP = "abs(p_x1 - right_edge) <= 24"
_MERGE = f"""NOT ({like("text", P.NUMBERED_PARAGRAPH)} AND regexp_matches({strip("p_text")}, '[.?!:”"]$')) AND NOT ({item("text")} OR {heading("text", "font_size", "body_font")} OR greatest(0, y0 - p_y1) > greatest(10, line_gap * 2.4::DOUBLE))
  AND abs(font_size - p_font_size) <= 1.5 AND ((block_no = p_block_no AND block_no <> -1) OR ((abs(x0 - p_x0) <= 12 OR abs(x1 - p_x1) <= 28) AND abs(x0 - p_x0) <= 24 AND {goes_on("p_text", "text", _WRAP)})
       OR ({_WRAP} AND NOT ({start("text")} AND NOT {short("text")})))"""
_I, _PI = like("text", P.LIST_ITEM_BASE), like("p_text", P.LIST_ITEM_BASE)
_END = f"regexp_matches({strip('p_text')}, '[.?!:]$')"
_HANG = "(x0 - p_x0 >= 12 AND gap <= greatest(line_gap * 1.25, line_height * 0.35::DOUBLE))"
_ON = goes_on("p_text", "text", base=True)
_BORDER = f"""CASE WHEN {heading("text", "font_size", "body_font", True)} THEN true WHEN {like("text", P.NUMBERED_PARAGRAPH)} AND {_END} THEN true WHEN {_I} AND NOT {_PI} THEN true
  WHEN {_I} AND {_PI} THEN gap > greatest(line_gap * 1.8::DOUBLE, line_height * 0.55::DOUBLE) OR abs(x0 - p_x0) > 14 WHEN abs(font_size - p_font_size) > 1.5 THEN true
  WHEN gap > greatest(line_height * 0.85::DOUBLE, line_gap * 1.9::DOUBLE) THEN true WHEN abs(x0 - p_x0) > 14 AND NOT {_HANG} THEN true
  WHEN judis AND ({_END} AND (x0 - p_x0 >= 12 OR abs(x1 - p_x1) > 28) OR (p_x1 - p_x0 < (right_edge - left_indent) * 0.62::DOUBLE AND {_END} AND NOT {_ON})) THEN true
  WHEN {_PI} AND x0 <= p_x0 - 14 THEN true ELSE NOT ((abs(x0 - p_x0) <= 10 OR abs(x1 - p_x1) <= 18 OR {_HANG}) AND {_ON}) END"""


def islands_cte(base: bool = False) -> str:
    merge = f"NOT ({_BORDER})" if base else _MERGE
    return f"""prev AS (SELECT r.*, s.* EXCLUDE (doc_id), {_PREVIOUS} FROM reasons r JOIN stats s ON r.doc_id = s.doc_id WHERE reason IS NULL),
islands AS MATERIALIZED (SELECT *, sum(CASE WHEN p_text IS NULL OR NOT ({merge}) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page_no ORDER BY y0, x0, ord)::INT AS chunk FROM (SELECT *, greatest(0, y0 - p_y1) AS gap FROM prev))"""


def chunks_cte(base: bool = False) -> str:
    lists = f"WHEN n_lines >= 2 AND len(list_filter(texts, lambda t: NOT {like('t', P.LIST_ITEM_BASE)})) = 0 THEN CASE WHEN {like('texts[1]', P.ORDERED_ITEM)} THEN 'ol' ELSE 'ul' END" if base else ""
    return f"""grouped AS (SELECT doc_id, page_no, chunk, list(text ORDER BY y0, x0, ord) AS texts, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, avg(font_size) AS font, avg(x0) AS indent, count(*) AS n_lines,
  any_value(body_font) AS body_font, any_value(left_indent) AS left_indent FROM islands GROUP BY doc_id, page_no, chunk),
joined AS (SELECT *, {escape(join_lines("texts"))} AS text FROM grouped),
chunks AS (SELECT doc_id, page_no, chunk, CASE WHEN {heading("text", "font", "body_font", base)} THEN CASE WHEN font >= body_font + 3 THEN 'h1' WHEN font >= body_font + 1.5 THEN 'h2' ELSE 'h3' END {lists}
  WHEN n_lines >= 2 AND indent > left_indent + 20 THEN 'blockquote' ELSE 'p' END AS kind, text, x0, y0, x1, y1, n_lines, texts FROM joined)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def document_chunks(base: bool = False) -> str:
    return with_(LINES_SQL, patterns_cte(), reasons_cte(), STATS, islands_cte(base), chunks_cte(base))
