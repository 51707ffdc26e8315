"""DuckDB SQL for judgments: metadata, zones, paragraphs."""

from __future__ import annotations

from quire.functions import patterns as P

from .oracle import escape, hidden, like, q, strip, words  # noqa: F401


def grab(x: str, pattern: str, group: int = 0) -> str:
    return f"coalesce(regexp_extract({x}, {q(pattern)}, {group}), '')"


def first(found: str) -> str:
    return f"coalesce(list_filter({found}, lambda z: z <> '')[1], '')"


HEAD = f"""head AS MATERIALIZED (SELECT *, array_to_string(head, ' ') AS head_text, array_to_string(lines, ' ') AS full_text FROM (SELECT *, list_filter(lines[1:60], lambda x: NOT {like("x", P.ANNOTATION)}) AS head FROM judgments)),
cited AS (SELECT *, {grab("head_text", P.CITATION)} AS citation FROM head)"""
YEAR = "TRY_CAST(nullif(split_part(citation, ':', 1), '') AS INT)"
NUMBER = "TRY_CAST(nullif(replace(split_part(citation, ':', 3), '-DB', ''), '') AS INT)"
_OWN = strip(f"regexp_replace(coalesce({strip('source_case')}, ''), {q(P.TRAILING_CITATION)}, '')")
CASE = f"CASE WHEN {_OWN} <> '' THEN {_OWN} ELSE {first(f'list_transform(head, lambda x: {strip(grab(strip("x"), P.CASE_NUMBER, 1))})')} END"


def dated(patterns: tuple[str, ...], tidy: bool) -> str:
    def cleaned(x: str) -> str:
        x = rf"regexp_replace({strip(x)}, '\.+$', '')"
        return strip(f"regexp_replace({x}, '^[- –]+', '')") if tidy else x

    each = "[" + ", ".join(cleaned(grab("x", p, 1)) for p in patterns) + "]"
    return first(f"list_transform(head, lambda x: {first(each)})")


_DATE = dated(P.JUDGMENT_DATES, True)
DATE = strip(rf"regexp_replace(CASE WHEN {_DATE} <> '' THEN {_DATE} ELSE coalesce({strip('source_date')}, '') END, '^[-–]\s*', '')")
RESERVED = dated(P.RESERVED_DATES, False)


def party(pattern: str, side: int) -> str:
    name = strip(grab(strip("x"), pattern, 1))
    found = first(f"list_transform(head, lambda x: CASE WHEN length({name}) BETWEEN 2 AND 120 THEN {name} ELSE '' END)")
    parts = {1: lambda s: f"left(source_party, instr(source_party, '{s}') - 1)", 2: lambda s: f"substr(source_party, instr(source_party, '{s}') + {len(s)})"}[side]
    split = "CASE " + " ".join(f"WHEN contains(source_party, '{s}') THEN {strip(parts(s))}" for s in P.PARTY_SEPARATORS) + " ELSE '' END"
    return f"CASE WHEN {found} <> '' THEN {found} ELSE {split} END"


CONNECTED = f"({like('head_text', P.CONNECTED)} OR len(regexp_extract_all(head_text, {q(P.CASE_COUNT)})) >= 5)"
_H = lambda x: like(f"upper({strip(x)})", P.JUDGMENT_HEADING)
_TRIMMED = strip(f"regexp_replace({strip('x')}, ',+$', '')")
_NAME = strip(f"regexp_replace({strip(f'regexp_replace(x, {q(P.BENCH_PREFIX)}, {q("")})')}, ',+$', '')")
BENCH = f"""coram AS (SELECT *, list_filter(range(1, len(head) + 1), lambda i: {like("head[i]", P.CORAM)})[1] AS place FROM cited),
below AS (SELECT *, CASE WHEN place IS NULL THEN [] ELSE list_transform(head[place + 1:place + 9], lambda x: {_TRIMMED}) END AS below FROM coram),
stopped AS (SELECT *, coalesce(list_filter(range(1, len(below) + 1), lambda i: below[i] <> '' AND ({_H("below[i]")} OR {like("below[i]", P.BENCH_STOP)}))[1], 10) AS stop FROM below),
benches AS (SELECT doc_id, citation, list_filter(list_transform(below[1:stop - 1], lambda x: upper({_NAME})), lambda x: length(x) >= 3) AS bench FROM stopped)"""
_BY = f"upper({strip(grab(strip('x'), P.JUDGE_NAME, 1))})"
JUDGE = f"""started AS (SELECT *, list_filter(range(1, len(lines) + 1), lambda i: {_H("lines[i]")})[1] AS place FROM head),
judges AS (SELECT doc_id, full_text, CASE WHEN near <> '' THEN near ELSE {first(f"list_transform(lines[greatest(1, len(lines) - 19):], lambda x: {_BY})")} END AS judgment_by
  FROM (SELECT *, CASE WHEN place IS NULL THEN '' ELSE {first(f"list_transform(lines[place:place + 9], lambda x: {_BY})")} END AS near FROM started))"""
REFS = rf"list_sort(list_filter(list_distinct(regexp_extract_all(array_to_string(lines[61:], ' '), {q(P.REFERENCE)})), lambda x: x <> citation AND NOT regexp_matches(x, '^\d{{4}}$')))"
_STOP = "[" + ", ".join(map(q, P.ACT_STOP_WORDS)) + "]"
ACTS = rf"list_sort(list_distinct(list_filter(regexp_extract_all(full_text, {q(P.ACT)}, 1), lambda x: length(x) BETWEEN 8 AND 80 AND NOT {like('x', P.ACT_NOISE)} AND {words('x')} >= 2 AND NOT list_contains({_STOP}, lower(regexp_split_to_array(x, '\s+')[1])))))"

ENTRIES = """entries AS MATERIALIZED (SELECT doc_id, (i - 1)::INT AS ord, ((i - 1) // 30 + 1)::INT AS page_no, lines[i] AS text,
  (72 + CASE WHEN (i - 1) % 13 = 5 THEN 90 WHEN (i - 1) % 13 = 7 THEN 70 WHEN (i - 1) % 4 = 1 THEN 20 ELSE 0 END)::INT AS indent, (i - 1) % 26 = 7 AS italic FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM judgments)),
base AS (SELECT doc_id, indent AS base_indent FROM (SELECT doc_id, indent, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, min(ord)) AS k FROM entries GROUP BY doc_id, indent) WHERE k = 1)"""
_U = f"upper({strip('text')})"
ZONED = f"""zoned AS MATERIALIZED (SELECT e.*, CASE {" ".join(f"WHEN {like(_U, p)} THEN '{z}'" for z, p in P.ZONES)} WHEN (indent > base_indent + 60 AND italic) OR indent > base_indent + 80 THEN 'quote' ELSE 'body' END AS zone FROM entries e JOIN base b ON e.doc_id = b.doc_id)"""
SECTIONS = """heads AS (SELECT doc_id, min(ord) AS first FROM zoned WHERE zone = 'order_heading' GROUP BY doc_id),
sections AS MATERIALIZED (SELECT z.*, ord >= coalesce(first, 1000000) AS in_order, page_no <> lag(page_no, 1, 1) OVER (PARTITION BY z.doc_id ORDER BY ord) AND ord <= coalesce(first, 1000000) AS page_break FROM zoned z LEFT JOIN heads h ON z.doc_id = h.doc_id)"""
_T = strip("text")
_TIDY = strip(rf"regexp_replace({strip('text')}, '\s{{2,}}', ' ', 'g')")
MERGED = rf"""kinds AS (SELECT doc_id, ord, CASE zone WHEN 'order_heading' THEN 'heading' WHEN 'quote' THEN 'quote' ELSE 'body' END AS kind, text FROM zoned),
numbers AS (SELECT doc_id, ord, kind, CASE WHEN kind = 'body' AND regexp_matches({_T}, '^\d+[.)](\s|$)') THEN regexp_extract({_T}, '^\d+[.)]') END AS number,
  CASE WHEN kind <> 'body' THEN text WHEN regexp_matches({_T}, '^\d+[.)]$') THEN '' ELSE regexp_replace({_T}, '^\d+[.)]\s+', '') END AS text, count(*) FILTER (WHERE kind = 'heading') OVER (PARTITION BY doc_id ORDER BY ord) AS part, lag(kind, 1, 'none') OVER (PARTITION BY doc_id ORDER BY ord) AS before FROM kinds),
parted AS (SELECT *, sum(CASE WHEN kind <> 'body' OR number IS NOT NULL OR before <> 'body' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ord) AS block, last_value(number IGNORE NULLS) OVER (PARTITION BY doc_id, part ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS num FROM numbers),
gathered AS (SELECT doc_id, block, any_value(kind) AS k, arg_min(coalesce(num, ''), ord) AS num, string_agg(text, ' ' ORDER BY ord) AS text FROM parted GROUP BY doc_id, block),
tidy AS (SELECT doc_id, block, CASE WHEN k <> 'body' THEN k WHEN num = '' THEN 'body' ELSE 'para' END AS kind, CASE WHEN k = 'body' THEN num ELSE '' END AS num, CASE WHEN k = 'body' THEN {_TIDY} ELSE text END AS text FROM gathered),
merged AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY block)::INT AS n, kind, num, text FROM tidy WHERE text <> '' OR kind NOT IN ('body', 'para'))"""
JUDGES = rf"""ordered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord) - 1 AS i FROM sections WHERE in_order AND zone IN ('order_heading', 'quote', 'body')),
early AS (SELECT doc_id, min(i) <= 2 AS early FROM ordered WHERE zone <> 'order_heading' AND regexp_matches({_T}, '^\d+[.)]') GROUP BY doc_id),
names AS (SELECT s.*, coalesce(early, false) AS early, regexp_matches(text, '(?i)\(oral\)') AS oral FROM sections s LEFT JOIN early e ON s.doc_id = e.doc_id WHERE zone = 'judge_name'),
places AS (SELECT doc_id, coalesce(arg_max(text, ord) FILTER (WHERE oral), arg_min(text, ord) FILTER (WHERE early)) AS opener, coalesce(list(text ORDER BY ord) FILTER (WHERE NOT oral AND NOT early), []) AS signatures FROM names GROUP BY doc_id)"""
_K = f"lower({hidden(strip(r"regexp_replace(text, '\s+', ' ', 'g')"))})"
REPEATED = f"""inside AS (SELECT doc_id, page_no, ord, {_K} AS key FROM outer_ WHERE {_T} <> '' AND NOT {like(_T, P.PAGE_MARKER)} AND NOT {like(_T, P.TRAILING_MARKER)} AND (y1 <= 792 * 0.08::DOUBLE OR y0 >= 792 * 0.92::DOUBLE)),
repeated AS (SELECT doc_id, page_no, ord FROM inside WHERE (doc_id, key) IN (SELECT (doc_id, key) FROM inside GROUP BY doc_id, key HAVING count(DISTINCT page_no) >= 2))"""

HTML = rf"""marked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, kind, num ORDER BY n) AS again, coalesce(last_value(CASE WHEN kind IN ('para', 'body') THEN 1 WHEN kind = 'heading' THEN 0 END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open FROM merged),
pieces AS (SELECT doc_id, n, CASE WHEN open = 1 AND kind <> 'quote' THEN '</div>' ELSE '' END || CASE kind WHEN 'heading' THEN '<h2>' || {escape("text")} || '</h2>' WHEN 'quote' THEN '<blockquote>' || {escape("text")} || '</blockquote>'
  WHEN 'para' THEN '<div class="block" id="para-' || regexp_replace(num, '\D', '', 'g') || CASE WHEN again > 1 THEN '-' || again ELSE '' END || '"><p><span>' || num || '</span> ' || {escape("text")} || '</p>' ELSE '<div class="block"><p>' || {escape("text")} || '</p>' END AS piece FROM marked),
ends AS (SELECT doc_id, arg_max(kind, n) AS last FROM merged WHERE kind <> 'quote' GROUP BY doc_id),
html AS (SELECT p.doc_id, '<article>' || chr(10) || string_agg(piece, chr(10) ORDER BY n) || CASE WHEN any_value(e.last) IN ('para', 'body') THEN '</div>' ELSE '' END || chr(10) || '</article>' AS html FROM pieces p LEFT JOIN ends e ON p.doc_id = e.doc_id GROUP BY p.doc_id)"""
