"""Line deduplication by overlapping windows of three lines, in DataFrame functions only.

Each window of three consecutive lines is hashed, windows that occur more than once are found over the
whole corpus, and every occurrence but the first (by doc_id, then place) is removed: the covered lines
of a document are the union of its later occurrences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import checkpointed

LINES = 3


def _windows(docs: DataFrame) -> DataFrame:
    """(doc_id, th, at, h1, h2): each window's place and 128 bits of hash; th tells texts of a doc_id apart."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("th"), F.split("text", "\n", -1).alias("lines")).where(F.size("lines") >= LINES)

    def window(i):
        w = [F.get("lines", i + k) for k in range(LINES)]
        return F.struct(i.alias("at"), F.xxhash64(*w).alias("h1"), F.xxhash64(F.lit(1), *w).alias("h2"))

    starts = F.sequence(F.lit(0), F.size("lines") - LINES)
    return lines.select("doc_id", "th", F.inline(F.transform(starts, window)))


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, th, removed): the numbers of each document's removed lines, where it has any."""
    windows = checkpointed(_windows(docs.select(F.col("doc_id").cast("long"), "text")))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "at")
    repeated = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = windows.join(repeated, ["h1", "h2"]).where(F.col("first") < place)
    covered = F.flatten(F.transform(F.collect_set("at"), lambda i: F.sequence(i, i + LINES - 1)))
    return later.groupBy("doc_id", "th").agg(F.array_distinct(covered).alias("removed"))


def dedup(docs: DataFrame) -> DataFrame:
    """(row, lines, removed, text) for every row of docs: the row itself, how many lines its text has
    and how many of them go, and what stays, joined by line feeds.

    Lines are compared exactly; a text of fewer than three lines keeps them all. A null text has no
    lines and stays null. Rows alike in doc_id and text are one document and lose the same lines; a null
    doc_id comes last. The first occurrence of a window always stays, so no line vanishes altogether.
    """
    gone = removed_lines(docs).withColumnsRenamed({"doc_id": "id", "th": "hash"}).hint("shuffle_hash")
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("own"))
    both = rows.join(gone, F.col("row.doc_id").cast("long").eqNullSafe(F.col("id")) & (F.col("own") == F.col("hash")), "left")
    both = both.select("row", "removed", F.when(F.col("removed").isNotNull(), F.split("row.text", "\n", -1)).alias("split"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("split") - 1), F.col("removed"))
    text = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("split", i)), "\n"))
    n = F.coalesce(F.length("row.text") - F.length(F.translate("row.text", "\n", "")) + 1, F.lit(0)).cast("long")
    return both.select("row", n.alias("lines"), F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("removed"), text.alias("text"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs with repeated lines taken out of text, and n_chars, if there is one, counted anew."""
    found = dedup(docs)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return found.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_sha256) for every row of docs."""
    return dedup(docs).select("row.doc_id", F.col("lines").alias("n_lines"), F.col("removed").alias("n_removed"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, i AS place, [lines[i], lines[i + 1], lines[i + 2]] AS win
      FROM (SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS i FROM l WHERE len(lines) >= 3)),
r AS (SELECT doc_id, place, row_number() OVER (PARTITION BY win ORDER BY doc_id, place) AS n FROM w),
c AS (SELECT DISTINCT doc_id, unnest([place, place + 1, place + 2]) AS line FROM r WHERE n > 1),
g AS (SELECT doc_id, list(line) AS gone FROM c GROUP BY doc_id)
SELECT l.doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_transform(list_filter(range(1, len(lines) + 1), lambda i: NOT list_contains(coalesce(gone, []), i)), lambda i: lines[i]), chr(10))) AS kept_sha256
FROM l LEFT JOIN g ON l.doc_id = g.doc_id
"""
