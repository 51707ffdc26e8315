"""Judgment-like line lists: a hand-written head and tail around a document's own text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEADS = [
    ["$~12", "* IN THE HIGH COURT OF EXAMPLE", "2022:DHC:377-DB", "+ RFA 411/2021 & CM APPL. 12/2021", "Judgment reserved on: 12.01.2022", "Judgment pronounced on: 02.02.2022.", "ALPHA TRADERS & CO. ..... Appellant", "Through: Mr. A. Rao, Sr. Adv. with Ms. B. Sen, Advocate",
     "versus", "BETA MILLS (P) LTD. ...... Respondents", "Through: Mr. C. Das and Dr. D. Roy, Advs. for respondent no. 1", "CORAM:", "HON'BLE MR. JUSTICE E. KUMAR", "HON'BLE MS. JUSTICE F. SINGH,", "J U D G M E N T", "E. KUMAR, J. (ORAL)", "1.", "The appeal under the Limitation Act, 1963 is filed in time.", "2. It refers to the Code of Civil Procedure Code, 1908."],
    ["IN THE SUPREME COURT OF EXAMPLE", "2019:DHC:55", "W.P.(C) 77/2019", "Date of decision: 5th May, 2019", "GAMMA ... Petitioner", "Through : Ms. G. Nair", "DELTA BOARD ... Respondent", "CORAM: HON'BLE DR. JUSTICE H. IYER", "HON'BLE DR. JUSTICE H. IYER", "ORDER", "3) The Arbitration Rules apply.", "Signed later, see below."],
    ["#~9", "CS(OS) 12/2018, CS(OS) 13/2018, RFA 14/2018, RSA 15/2018, FAO 16/2018 connected matters", "Date: 3.4.2018", "Heard on - 1.4.2018", "For the Petitioner: Mr. J. Khan, Adv.", "For the Respondent: Ms. K. Bose, Advocate", "CORAM:", "THE CHIEF JUSTICE L. MEHTA", "Through: Mr. N. Paul", "JUDGMENT", "M. OZA, J.", "1. Leave granted."],
    ["Page 1 of 9", "Notes without any heading", "Decided on : 9 June 2020", "EPSILON vs ZETA"],
]
TAILS = [
    ["See AIR 2005 SC 1234 and (2013) 1 SCC 641, also 2022:DHC:377-DB.", "The Indian Penal Code and the Evidence Act, 1872 were read.", "VIA VIDEO CONFERENCING", "E. KUMAR, J."],
    ["Relied on (2005) 7 SCR 234; [2013] 1 SCC 641; 2019:DHC:55; 2020:DHC:99.", "4. Order vii of the Civil Code does not apply, nor the Motor Vehicles Rules.", "MARCH 3, 2020"],
    ["No authority was cited.", "N. PAUL, J. (ORAL)"],
]
#: What SQL's trim takes for a space.
SPACES = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
PARTIES = ["Alpha Vs Beta", "Gamma v. Delta", "", "Epsilon vs Zeta vs Eta", "Theta"]


def _literal(x) -> F.Column:
    return F.array(*map(_literal, x)) if isinstance(x, list) else F.lit(x)


def judgment_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, lines, source_case, source_party, source_date): nullable columns of a source record beside
    the lines. doc_id picks head and tail, so each combination occurs."""
    flat = F.regexp_replace("text", r"[\n\r]", " ")
    parts = F.regexp_extract_all(flat, F.lit("(?s).{1,64}"), F.lit(0))  # one pass, where substrings would each count from the start
    body = F.coalesce(F.transform(parts, lambda x: F.trim(x, F.lit(SPACES))), F.array().cast("array<string>"))
    pick = lambda x, k: F.get(_literal(x), (F.col("doc_id") % k).cast("int"))
    lines = F.filter(F.concat(pick(HEADS, len(HEADS)), body, pick(TAILS, len(TAILS))), lambda x: x != "")
    return docs.select(
        "doc_id", lines.alias("lines"), F.when(F.col("doc_id") % 5 == 0, "LPA-9/2020 2022:DHC:377").alias("source_case"),
        pick(PARTIES, len(PARTIES)).alias("source_party"), F.when(F.col("doc_id") % 3 == 0, "-11.11.2011").alias("source_date"),
    )


def _sql(x) -> str:
    return "[" + ", ".join(map(_sql, x)) + "]" if isinstance(x, list) else "'" + x.replace("'", "''") + "'"


LINES_SQL = f"""judgments AS MATERIALIZED (
  SELECT doc_id, list_filter(list_concat({_sql(HEADS)}[doc_id % {len(HEADS)} + 1],
           list_transform(range(ceil(length(text) / 64.0)::BIGINT), lambda i: trim(substr(translate(text, chr(10) || chr(13), '  '), i * 64 + 1, 64))),
           {_sql(TAILS)}[doc_id % {len(TAILS)} + 1]), lambda x: x <> '') AS lines,
         CASE WHEN doc_id % 5 = 0 THEN 'LPA-9/2020 2022:DHC:377' END AS source_case, {_sql(PARTIES)}[doc_id % {len(PARTIES)} + 1] AS source_party, CASE WHEN doc_id % 3 = 0 THEN '-11.11.2011' END AS source_date
  FROM documents WHERE text IS NOT NULL)"""
