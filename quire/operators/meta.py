"""Metadata of judgments from their lines, by regular expressions over arrays: no line is ever exploded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import patterns as P
from quire.functions import text as T

HEADER, TAIL, AFTER_CORAM, AFTER_HEADING, MOST_NAMES = 60, 20, 9, 10, 8


def first(found: Column) -> Column:
    """The first non-empty string of an array, or the empty string."""
    return F.coalesce(F.get(F.filter(found, lambda x: x != ""), F.lit(0)), F.lit(""))


def header(lines: Column) -> Column:
    """The first lines without annotations."""
    return F.filter(F.slice(lines, 1, HEADER), lambda x: ~x.rlike(P.ANNOTATION))


def citation(text: Column) -> dict[str, Column]:
    found = F.regexp_extract(text, P.CITATION, 0)
    part = lambda k, group: F.nullif(F.regexp_extract(found, r"^(\d{4}):DHC:(\d+)", group), F.lit("")).try_cast("int")
    return {"citation": found, "neutral_citation_year": part(0, 1), "neutral_citation_number": part(0, 2), "citation_db": found.endswith("-DB")}


def case_number(head: Column, source: Column) -> Column:
    """The source record's, without a citation behind it; else the first header line that is a case number."""
    own = T.strip(F.regexp_replace(F.coalesce(T.strip(source), F.lit("")), P.TRAILING_CITATION, ""))
    return F.when(own != "", own).otherwise(first(F.transform(head, lambda x: T.strip(F.regexp_extract(T.strip(x), T.ascii_bounds(P.CASE_NUMBER), 1)))))


def dated(head: Column, patterns: tuple[str, ...], tidy: bool) -> Column:
    """Of the first line that has one, what the first matching pattern finds there."""

    def cleaned(x: Column) -> Column:
        x = F.regexp_replace(T.strip(x), r"\.+$", "")
        return T.strip(F.regexp_replace(x, r"^[- –]+", "")) if tidy else x

    return first(F.transform(head, lambda x: first(F.array(*(cleaned(F.regexp_extract(x, p, 1)) for p in patterns)))))


def judgment_date(head: Column, source: Column) -> Column:
    found = dated(head, P.JUDGMENT_DATES, True)
    found = F.when(found != "", found).otherwise(F.coalesce(T.strip(source), F.lit("")))
    return T.strip(F.regexp_replace(found, r"^[-–]\s*", ""))


def party(head: Column, pattern: str, source: Column, side: int) -> Column:
    """A line with dotted leaders; else the side of the source's party field before or after its separator."""

    def named(x: Column) -> Column:
        x = T.strip(F.regexp_extract(T.strip(x), pattern, 1))
        return F.when(F.length(x).between(2, 120), x).otherwise("")

    found = first(F.transform(head, named))
    whole = F.coalesce(source, F.lit(""))
    split = F.coalesce(*(F.when(whole.contains(s), T.strip(F.get(F.split(whole, "\\Q" + s + "\\E", 2), F.lit(side)))) for s in P.PARTY_SEPARATORS), F.lit(""))
    return F.when(found != "", found).otherwise(split)


def connected(text: Column) -> Column:
    return text.rlike(P.CONNECTED) | (F.regexp_count(text, F.lit(T.ascii_bounds(P.CASE_COUNT))) >= 5)


def _heading(x: Column) -> Column:
    return F.upper(T.strip(x)).rlike(P.JUDGMENT_HEADING)


def _position(lines: Column, test) -> Column:
    """Place (from 1) of the first line for which test holds, or null."""
    return F.array_min(F.filter(F.transform(lines, lambda x, i: F.when(test(x), i + 1)), lambda i: i.isNotNull()))


def bench(head: Column) -> Column:
    """Judges below the CORAM line, up to a heading, in capitals and without their titles."""
    at = _position(head, lambda x: x.rlike(T.ascii_bounds(P.CORAM)))
    below = F.transform(F.slice(head, at + 1, F.lit(AFTER_CORAM)), lambda x: T.strip(F.regexp_replace(T.strip(x), ",+$", "")))
    stop = F.coalesce(_position(below, lambda x: (x != "") & (_heading(x) | x.rlike(P.BENCH_STOP))), F.lit(AFTER_CORAM + 1))
    names = F.transform(F.slice(below, F.lit(1), stop - 1), lambda x: T.upper(T.strip(F.regexp_replace(T.strip(F.regexp_replace(x, P.BENCH_PREFIX, "")), ",+$", ""))))
    return F.coalesce(F.filter(names, lambda x: F.length(x) >= 3), F.array().cast("array<string>"))


def judgment_by(lines: Column) -> Column:
    """The judge's name near the judgment's heading, or else in the last lines."""
    name = lambda x: F.upper(T.strip(F.regexp_extract(T.strip(x), P.JUDGE_NAME, 1)))
    at = _position(lines, _heading)
    near = F.coalesce(first(F.transform(F.slice(lines, at, F.lit(AFTER_HEADING)), name)), F.lit(""))
    near = F.when(at.isNull(), "").otherwise(near)
    return F.when(near != "", near).otherwise(first(F.transform(F.slice(lines, F.greatest(F.lit(1), F.size(lines) - TAIL + 1), F.lit(TAIL)), name)))


def advocates(raw: Column) -> Column:
    """Names with a title, without roles, eight at most."""
    raw = F.regexp_replace(F.regexp_replace(raw, P.ADVOCATE_SIDE, ""), T.ascii_bounds(P.ADVOCATE_TITLE), "")
    names = F.split(F.regexp_replace(raw, r"(?i)\s+with\s+", ", "), r",\s*")
    names = F.transform(F.filter(names, lambda x: x.rlike(r"\S")), lambda x: F.regexp_replace(T.strip(x), r"\.+$", ""))
    return F.slice(F.filter(names, lambda x: x.rlike(P.ADVOCATE_NAME)), 1, MOST_NAMES)


def both_advocates(text: Column) -> dict[str, Column]:
    blocks = F.regexp_extract_all(text, F.lit(T.ascii_bounds(P.THROUGH)), F.lit(1))

    def side(k: int, own: str, other: str) -> Column:
        through = advocates(F.coalesce(F.get(blocks, F.lit(k)), F.lit("")))
        named = advocates(F.regexp_extract(text, T.ascii_bounds(rf"(?is)For\s+the\s+{own}\s*:\s*(.+?)(?=For\s+the\s+{other}|CORAM\b|$)"), 1))
        return F.when(F.size(through) > 0, through).otherwise(named)

    return {"advocates_petitioner": side(0, "Petitioner", "Respondent"), "advocates_respondent": side(1, "Respondent", "Petitioner")}


def referred(lines: Column, own: Column) -> Column:
    """Cases cited beyond the header, sorted, without the document's own citation."""
    body = F.array_join(F.slice(lines, F.lit(HEADER + 1), F.greatest(F.size(lines) - HEADER, F.lit(0))), " ")
    found = F.array_distinct(F.transform(F.regexp_extract_all(body, F.lit(P.REFERENCE), F.lit(0)), T.strip))
    return F.array_sort(F.filter(found, lambda x: (x != own) & ~x.rlike(r"^\d{4}$")))


def acts(text: Column) -> Column:
    """Names of acts, sorted, without phrases that only look like one."""
    found = F.transform(F.regexp_extract_all(text, F.lit(T.ascii_bounds(P.ACT)), F.lit(1)), T.strip)
    word = lambda x: F.lower(F.get(F.split(x, r"\s+"), F.lit(0)))
    fit = lambda x: F.length(x).between(8, 80) & ~x.rlike(P.ACT_NOISE) & (T.words(x) >= 2) & ~word(x).isin(P.ACT_STOP_WORDS)
    return F.array_sort(F.array_distinct(F.filter(found, fit)))


def extract(judgments: DataFrame) -> DataFrame:
    """One row of metadata for each of judgment_lines()."""
    head = judgments.withColumn("head", header(F.col("lines"))).withColumn("head_text", F.array_join("head", " ")).withColumn("full_text", F.array_join("lines", " "))
    c = F.col
    head = head.select("*", *(x.alias(n) for n, x in citation(c("head_text")).items())).withColumn("bench", bench(c("head"))).withColumn("is_connected_matter", connected(c("head_text")))
    return head.select(
        "doc_id", "citation", "neutral_citation_year", "neutral_citation_number", (c("citation_db") | (F.size("bench") >= 2)).alias("is_division_bench"),
        case_number(c("head"), c("source_case")).alias("case_number"), judgment_date(c("head"), c("source_date")).alias("judgment_date"), dated(c("head"), P.RESERVED_DATES, False).alias("reserved_on"),
        party(c("head"), P.APPELLANT, c("source_party"), 0).alias("appellant"), party(c("head"), P.RESPONDENT, c("source_party"), 1).alias("respondent"), "is_connected_matter",
        F.when(c("is_connected_matter"), T.strip(F.regexp_extract("head_text", P.LEAD_CASE, 1))).otherwise("").alias("lead_case"), "bench", judgment_by(c("lines")).alias("judgment_by"),
        c("full_text").rlike(P.ORAL).alias("is_oral_judgment"), c("full_text").rlike(T.ascii_bounds(P.VIDEO)).alias("via_video_conferencing"),
        *(x.alias(n) for n, x in both_advocates(c("head_text")).items()), referred(c("lines"), c("citation")).alias("referred_cases"), acts(c("full_text")).alias("acts_referred"),
    )
