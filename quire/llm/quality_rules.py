"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

A rule rejects a text whose statistic is above a cutoff. Cutoffs are chosen per stratum (language) on
labelled good texts, from a grid fixed beforehand: a cutoff is proved if the exact binomial tail
P(Binomial(n, risk) <= rejected) is at most delta, so that a false rejection rate above risk would be that
rare. Going from the loosest cutoff to the strictest, the choice is the last one before a failure
(fixed-sequence testing needs no correction within the grid); rules and strata share delta by Bonferroni,
and the rules share the risk, so that with probability 1 - DELTA no stratum loses more than RISK of its
good texts. A stratum with too few labels proves nothing, and there no rule rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import WORD, checkpointed

RISK, DELTA = 0.05, 0.05
MIN_WORDS, MOST_REPEATED = 50, 50
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: Percentages, the last one code points a word; loosest first.
GRIDS = {
    "symbols": (60, 50, 40, 35, 30, 25, 20, 15, 12, 10, 8, 6, 5, 4, 3, 2),
    "dup_lines": (95, 90, 85, 80, 75, 70, 65, 60, 55, 50, 45, 40, 35, 30, 25, 20),
    "repeats": (50, 48, 46, 44, 42, 40, 38, 36, 34, 32, 30, 28, 26, 24, 22, 20),
    "word_length": (60, 50, 40, 35, 30, 25, 22, 20, 18, 16, 14, 13, 12, 11, 10, 9),
}


#: Words in three-word windows that a text has twice or more. Each window's hash gives way in its low
#: bits to the window's place, so one sort of longs brings equal windows together; neighbours that are
#: equal in the other bits are compared word by word. Steps: columns one after the other.
_STEPS = (
    ("bits", "length(bin(size(words)))"),
    ("keys", """CASE WHEN size(words) < 3 THEN array() ELSE sort_array(transform(sequence(0, size(words) - 3),
        i -> shiftleft(shiftright(xxhash64(get(words, i), get(words, i + 1), get(words, i + 2)), bits), bits) + i)) END"""),
    ("pairs", """filter(transform(keys, (x, i) -> CASE WHEN shiftright(x ^ get(keys, i + 1), bits) = 0 THEN struct(
        CAST(x & (shiftleft(1L, bits) - 1) AS int) AS a, CAST(get(keys, i + 1) & (shiftleft(1L, bits) - 1) AS int) AS b) END), p -> p IS NOT NULL)"""),
    ("same", """filter(pairs, p -> get(words, p.a) = get(words, p.b) AND get(words, p.a + 1) = get(words, p.b + 1) AND get(words, p.a + 2) = get(words, p.b + 2))"""),
    ("places", "sort_array(array_union(same.a, same.b))"),
    ("n_repeat_words", """CAST(CASE WHEN size(places) = 0 THEN 0 ELSE 3 + aggregate(sequence(1, size(places)), 0,
        (s, j) -> s + least(3, coalesce(get(places, j) - get(places, j - 1), 0))) END AS bigint)"""),
)


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines) of each row.

    A null text counts as empty. n_dup_lines: lines with a word that equal an earlier line; n_lines: lines
    with a word. No shuffle: a text's windows are compared within its row.
    """
    text = F.coalesce("text", F.lit(""))
    found = docs.select(
        F.col("doc_id").cast("long"), F.col("lang").alias("stratum"), text.alias("text"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"), F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)).alias("lines"),
    )  # fmt: skip
    for name, sql in _STEPS:
        found = found.withColumn(name, F.expr(sql))
    without = lambda chars: F.length(F.translate("text", chars, ""))  # noqa: E731
    long = lambda c, name: c.cast("long").alias(name)  # noqa: E731
    return found.select(
        "doc_id", "stratum", long(F.size("words"), "n_words"), long(without(SPACE), "word_chars"), long(F.length("text") - without(SYMBOLS), "n_symbols"),
        long(F.size("lines") - F.size(F.array_distinct("lines")), "n_dup_lines"), "n_repeat_words", long(F.size("lines"), "n_lines"),
    )  # fmt: skip


def _values() -> dict[str, Column]:
    share = lambda part, whole: F.when(F.col(whole) > 0, 100.0 * F.col(part) / F.col(whole)).otherwise(0.0)  # noqa: E731
    return {
        "symbols": share("n_symbols", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
        "word_length": share("word_chars", "n_words") / 100.0,
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


#: P(Binomial(n, risk) <= k): the terms' logarithms, each from the one before; 1 where k exceeds the mean.
_TAIL = """CASE WHEN k > n * {risk} THEN 1D ELSE aggregate(sequence(0, CAST(k AS int)),
    named_struct('log', CAST(n * ln(1 - {risk}) AS double), 'sum', 0D),
    (s, i) -> named_struct('log', s.log + ln((n - i) / (i + 1D)) + ln({risk} / (1 - {risk})), 'sum', s.sum + exp(s.log)), s -> s.sum) END"""


def cutoffs(found: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, cuts): for each stratum with labels, the chosen cutoff of each rule, null where none is proved.

    found: statistics(); labels: (doc_id, quality). The holdout is the good documents (every label of the
    doc_id is 1) that pass the base rules; labels only choose cutoffs, so none is spent on fitting.
    """
    each = risk / len(GRIDS)
    good = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")
    held = found.where(~base_failed()).join(good, "doc_id", "left_semi")
    rejected = [F.struct(F.lit(rule).alias("rule"), F.lit(i).alias("step"), F.lit(float(c)).alias("cut"), F.count_if(_values()[rule] > c).alias("k")) for rule, grid in GRIDS.items() for i, c in enumerate(grid)]
    counts = held.groupBy("stratum").agg(F.count("*").alias("n"), F.array(*rejected).alias("tried"))
    strata = counts.agg(F.count("*").alias("strata"))
    tested = counts.crossJoin(F.broadcast(strata)).select("stratum", "n", "strata", F.inline("tried"))  # one row beside each stratum
    tested = tested.withColumn("proved", F.expr(_TAIL.format(risk=f"{each!r}D")) <= F.lit(delta) / (len(GRIDS) * F.col("strata")))
    stop = F.coalesce(F.min(F.when(~F.col("proved"), F.col("step"))), F.lit(max(map(len, GRIDS.values()))))
    chosen = tested.groupBy("stratum", "rule").agg(stop.alias("stop"), F.collect_list(F.struct("step", "cut")).alias("steps"))
    chosen = chosen.select("stratum", "rule", F.array_max(F.filter("steps", lambda s: s.step < F.col("stop"))).getField("cut").alias("cut"))
    return chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cut"))).alias("cuts"))


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) for every row.

    Strata are values of lang, null among them; one without labels keeps all that pass the base rules.
    Rows may repeat and doc_id may be null (such rows are judged, but never labelled).
    """
    found = checkpointed(statistics(docs))
    cuts = checkpointed(cutoffs(found, labels.select(F.col("doc_id").cast("long"), "quality"), risk, delta)).withColumnRenamed("stratum", "of")
    both = found.join(cuts, F.col("stratum").eqNullSafe(F.col("of")), "left")
    over = F.lit(False)
    for rule, value in _values().items():
        over = over | F.coalesce(value > F.try_element_at("cuts", F.lit(rule)), F.lit(False))
    failed = base_failed()
    return both.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~over).alias("kept"))


_GRID_SQL = ", ".join(f"('{rule}', {i}, {float(c)}::DOUBLE)" for rule, grid in GRIDS.items() for i, c in enumerate(grid))
_RISK_SQL = f"{RISK / len(GRIDS)!r}::DOUBLE"
SQL = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, lang AS stratum, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^ 	-]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ 	-]')) AS lines
  FROM documents),
g AS (SELECT row, i, [words[i], words[i + 1], words[i + 2]] AS win FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM d WHERE len(words) >= 3)),
m AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, win) AS n FROM g) WHERE n > 1),
r AS (SELECT row, count(DISTINCT j) AS n FROM (SELECT row, unnest([i, i + 1, i + 2]) AS j FROM m) GROUP BY row),
f AS (SELECT doc_id, stratum, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[ 	-]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines
      FROM d LEFT JOIN r ON d.row = r.row),
v AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
             map {{'symbols': CASE WHEN word_chars > 0 THEN 100.0::DOUBLE * n_symbols / word_chars ELSE 0 END,
                   'dup_lines': CASE WHEN n_lines > 0 THEN 100.0::DOUBLE * n_dup_lines / n_lines ELSE 0 END,
                   'repeats': CASE WHEN n_words > 0 THEN 100.0::DOUBLE * n_repeat_words / n_words ELSE 0 END,
                   'word_length': CASE WHEN n_words > 0 THEN 100.0::DOUBLE * word_chars / n_words / 100.0::DOUBLE ELSE 0 END}} AS value
      FROM f),
h AS (SELECT * FROM v WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1)),
t AS (SELECT * FROM (VALUES {_GRID_SQL}) AS grid(rule, step, cut)),
k AS (SELECT stratum, rule, step, cut, count(*) AS n, count(*) FILTER (WHERE value[rule] > cut) AS k FROM h, t GROUP BY ALL),
p AS (SELECT *, (SELECT count(*) FROM (SELECT DISTINCT stratum FROM h)) AS strata,
             CASE WHEN k > n * {_RISK_SQL} THEN 1 ELSE list_sum(list_transform(range(0, k + 1),
               lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_RISK_SQL}) + (n - i) * ln(1 - {_RISK_SQL})))) END AS p
      FROM k),
s AS (SELECT stratum, rule, coalesce(min(step) FILTER (WHERE p > {DELTA} / ({len(GRIDS)} * strata)), 99) AS stop FROM p GROUP BY ALL),
c AS (SELECT p.stratum, p.rule, min(p.cut) AS cut FROM p JOIN s ON p.stratum IS NOT DISTINCT FROM s.stratum AND p.rule = s.rule AND p.step < s.stop GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT EXISTS (SELECT 1 FROM c WHERE c.stratum IS NOT DISTINCT FROM v.stratum AND v.value[c.rule] > c.cut) AS kept
FROM v
"""
