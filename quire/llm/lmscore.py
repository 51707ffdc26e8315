"""Language-model scores by stupid backoff, over counts of the whole corpus.

S(b | a) = count(a b) / count(a .) where the pair occurs MIN_COUNT times or more, else BACKOFF * count(b) / N;
a document's score is the mean of ln S over its words, the first one after a start mark. count(a .) are
the pairs that begin with a, N all words.

The pairs of each text are exploded and dealt by hash to the partition that holds their counts; there the
count table of a partition is made from its own rows and joined to them, and each document's part is
summed. A row is a chunk's pairs for one partition, packed in arrays, since a row for each pair would be
several times the text. Words among the TOP most frequent ones (a fixed number, so their table is
broadcast) are named by rank, and their pairs are dealt by both words, so that no frequent word makes a hot
partition; other pairs are dealt by the first word, whose count is then at hand. Words beyond the TOP to
which a pair backs off are joined to the table of word counts, partitioned by hash.

Pairs of two of the HEAD most frequent words, or of the start mark and one of them, aren't dealt: each task adds
them up in a table of fixed size, the sums are a broadcast table too, and the pairs are joined to it where they
are. So each dealt pair has a word that makes up less than 1 / HEAD of all words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text
from ._common import checkpointed, partitions, stored

BACKOFF, MIN_COUNT = 0.4, 2
#: Most frequent words that are named by rank; below 65535, the start mark's.
TOP = 65_534
START, OTHER = 65_534, 65_535
#: Most frequent words whose pairs are counted in one table; row HEAD of it is the start mark's.
HEAD = 512
#: Pairs that a partition of counts should hold.
PAIRS = 1_000_000
#: Bytes of text whose pairs are packed together; small rows would be many times as many.
PACKED = 1 << 21
#: Different words that are gathered in a task before they are passed on.
HELD = 1 << 19
_U = np.uint64


def hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word in lower case (A-Z), and the documents' first words."""
    data = _text.LOWER[data]
    w = _text.words(data, offsets)
    return _text.word_hashes(data, w), w.ptr


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n, ends): for each word's hash how often it occurs, and how often as a text's last one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64))]

        def merged() -> tuple[np.ndarray, ...]:
            word, n, ends = (np.concatenate(x) for x in zip(*held, strict=True))
            word, inverse = np.unique(word, return_inverse=True)
            return word, np.bincount(inverse, n, len(word)).astype(np.int64), np.bincount(inverse, ends, len(word)).astype(np.int64)

        for b in batches:
            for c in _text.chunks(b.column(0)):
                h, ptr = hashes(c.data, c.offsets)
                last = np.zeros(len(h), np.int64)
                last[ptr[1:][np.diff(ptr) > 0] - 1] = 1
                held.append((h, np.ones(len(h), np.int64), last))
                if sum(len(x[0]) for x in held) > HELD:
                    held = [merged()]
                    if len(held[0][0]) > HELD // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), *map(pa.array, held[0][1:])], ["word", "n", "ends"])
                        held = [tuple(x[:0] for x in held[0])]
        word, *rest = merged()
        if len(word):
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), *map(pa.array, rest)], ["word", "n", "ends"])

    found = docs.select(F.col("text").cast("string")).mapInArrow(run, "word long, n long, ends long")
    return found.groupBy("word").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends"))


def _firsts(ranks: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """The rank of the word before each."""
    out = np.empty_like(ranks)
    out[1:] = ranks[:-1]
    out[ptr[:-1][np.diff(ptr) > 0]] = START
    return out


def _cells(ra: np.ndarray, rb: np.ndarray, head: int) -> np.ndarray:
    """Places of pairs in the table of head pairs, -1 for those that aren't in it."""
    row = np.where(ra == START, head, ra).astype(np.int64)
    return np.where((row <= head) & (rb < head) & ((ra == START) | (ra < head)), row * head + rb, -1)


def head_counts(docs: DataFrame, top, head: int) -> np.ndarray:
    """How often each pair of the table occurs; at most (head + 1) * head rows come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found = top.value, np.zeros((head + 1) * head, np.int64)
        for b in batches:
            for c in _text.chunks(b.column(0)):
                h, ptr = hashes(c.data, c.offsets)
                rb = known.ranks(h)
                cell = _cells(_firsts(rb, ptr), rb, head)
                found += np.bincount(cell[cell >= 0], minlength=len(found))
        cell = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(found[cell])], ["cell", "n"])

    found = docs.select("text").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((head + 1) * head, np.int64)
    out[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return out


class Top:
    """The most frequent words: hash, rank, count, and pairs that begin with each."""

    def __init__(self, word: np.ndarray, n: np.ndarray, ends: np.ndarray, total: int, texts: int):
        order = np.argsort(word)
        self.word, self.rank = word[order], order.astype(np.uint16)
        self.n, self.total = np.append(n, 1), total  # by rank
        self.begins = np.append(n - ends, np.zeros(max(START - len(n), 0), np.int64))
        self.begins = np.append(self.begins[:START], texts)

    def ranks(self, h: np.ndarray) -> np.ndarray:
        if not len(self.word):
            return np.full(len(h), OTHER, np.uint16)
        at = np.minimum(np.searchsorted(self.word, h), len(self.word) - 1)
        return np.where(self.word[at] == h, self.rank[at], np.uint16(OTHER)).astype(np.uint16)


def _pack(x: np.ndarray) -> bytes:
    return x.tobytes()


SCHEMA = "bucket int, rid binary, value binary, doc binary, ra binary, rb binary, a binary, b binary"


def exploded(docs: DataFrame, top, table, head: int, buckets: int) -> DataFrame:
    """Pairs by bucket: for each chunk its documents, and each pair's document, ranks, and the hashes of
    the words without a rank. A row with values has the chunk's documents and the sums of their head pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Top = top.value
        n = table.value
        row = np.arange(len(n)) // max(head, 1)
        begins, backed = known.begins[np.where(row == head, START, row)], known.n[np.arange(len(n)) % max(head, 1)]
        worth = np.where(n >= MIN_COUNT, np.log(np.maximum(n, 1) / np.maximum(begins, 1)), np.log(BACKOFF * np.maximum(backed, 1) / known.total))
        for batch in batches:
            rid = batch.column(0).to_numpy()
            for c in _text.chunks(batch.column(1), PACKED):
                h, ptr = hashes(c.data, c.offsets)
                doc = _text.owners(ptr).astype(np.uint32)
                rb = known.ranks(h)
                ra, a = _firsts(rb, ptr), np.empty_like(h)
                a[1:] = h[:-1]
                a[ptr[:-1][np.diff(ptr) > 0]] = 0
                cell = _cells(ra, rb, head)
                own = np.flatnonzero(cell >= 0)
                sums = np.bincount(doc[own], worth[cell[own]], len(ptr) - 1)
                rest = np.flatnonzero(cell < 0)
                doc, ra, rb, a, h = (x[rest] for x in (doc, ra, rb, a, h))
                deal = np.where(ra != OTHER, _text.mix(a * _U(0x9FB21C651E98DF25) + h), _text.mix(a)) % _U(buckets)
                order = np.lexsort((doc, rb, ra, deal))
                deal, doc, ra, rb, a, h = (x[order] for x in (deal, doc, ra, rb, a, h))
                cuts = np.searchsorted(deal, np.arange(buckets + 1, dtype=_U))
                told = np.flatnonzero(np.diff(ptr))
                rows = [(int(sums.view(np.uint64).sum() % _U(buckets)), _pack(rid[told + c.rows.start]), _pack(sums[told]), *[None] * 5)]
                for k in np.flatnonzero(np.diff(cuts)).tolist():
                    on = slice(cuts[k], cuts[k + 1])
                    used, local = np.unique(doc[on], return_inverse=True)
                    kind = np.uint16 if len(used) < 65536 else np.uint32
                    own = used + c.rows.start
                    rows.append((k, _pack(rid[own]), None, _pack(local.astype(kind)), _pack(ra[on]), _pack(rb[on]), _pack(a[on][ra[on] == OTHER]), _pack(h[on][rb[on] == OTHER])))
                if len(told):
                    k, *rest = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), *(pa.array(x, pa.binary()) for x in rest)], [x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select("rid", "text").mapInArrow(run, SCHEMA)


def _bucket_scores(known: Top, parts: list[dict]) -> Iterator[pa.RecordBatch]:
    """Of one bucket, (rid, word, value): the sum of what is known of each document, with a null
    word; and how often each word beyond the top is backed off to."""
    rid, doc, ra, rb, a, b, base = [], [], [], [], [], [], 0
    for p in parts:
        rid.append(np.frombuffer(p["rid"], np.int64))
        x, y = np.frombuffer(p["ra"], np.uint16), np.frombuffer(p["rb"], np.uint16)
        local = np.frombuffer(p["doc"], np.uint16 if len(p["doc"]) == 2 * len(x) else np.uint32)
        doc.append(local.astype(np.int64) + base)
        base += len(rid[-1])
        for ranks, packed, out in ((x, "a", a), (y, "b", b)):
            full = ranks.astype(_U)
            full[ranks == OTHER] = np.frombuffer(p[packed], _U)
            out.append(full)
        ra.append(x)
        rb.append(y)
    rid, doc, ra, rb, a, b = map(np.concatenate, (rid, doc, ra, rb, a, b))
    pair = _text.mix(a * _U(0x9FB21C651E98DF25) + _text.mix(b + rb.astype(_U)) + ra.astype(_U))
    _, inverse, n = np.unique(pair, return_inverse=True, return_counts=True)
    n = n[inverse]
    _, inverse, begins = np.unique(np.where(ra == OTHER, a, 0), return_inverse=True, return_counts=True)
    begins = np.where(ra == OTHER, begins[inverse], known.begins[np.where(ra == OTHER, 0, ra)])
    seen, ranked = n >= MIN_COUNT, rb != OTHER
    value = np.where(seen, np.log(n / np.maximum(begins, 1)), np.log(BACKOFF / known.total))
    value += np.where(~seen & ranked, np.log(known.n[np.where(ranked, rb, len(known.n) - 1)]), 0.0)
    part = np.bincount(doc, value, base)
    yield pa.RecordBatch.from_arrays([pa.array(rid), pa.nulls(len(rid), pa.int64()), pa.array(part)], ["rid", "word", "value"])
    ask = ~seen & ~ranked
    if ask.any():
        yield pa.RecordBatch.from_arrays([pa.array(rid[doc[ask]]), pa.array(b[ask].view(np.int64)), pa.array(np.ones(ask.sum()))], ["rid", "word", "value"])


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, log_score) for every row of docs: the mean of ln S, null without a word.

    Counts cover all rows, repeated ones each time. A null text has no words. Rows alike in doc_id and
    text have one score, a null doc_id is told by its text (64 bits of hash). Other columns are not read.
    """
    n = partitions(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id").cast("long"), text).alias("rid"), text.alias("text"))
    counts = checkpointed(word_counts(docs))
    total, texts = (int(x or 0) for x in counts.agg(F.sum("n"), F.sum("ends")).first())
    most = counts.orderBy(F.desc("n"), "word").limit(TOP).toArrow()
    columns = [most.column(x).to_numpy() for x in ("word", "n", "ends")]
    top = docs.sparkSession.sparkContext.broadcast(Top(columns[0].view(_U), *columns[1:], max(total, 1), texts))
    head = min(HEAD, len(most))
    table = docs.sparkSession.sparkContext.broadcast(head_counts(rows, top, head))
    buckets = max(n, -(-total // PAIRS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = top.value, []
        for b in batches:
            for k in range(len(b)):  # one row's bytes at a time
                row = {name: b.column(i)[k].as_py() for i, name in enumerate(b.schema.names)}
                if row["value"] is not None:
                    rid, value = np.frombuffer(row["rid"], np.int64), np.frombuffer(row["value"], np.float64)
                    yield pa.RecordBatch.from_arrays([pa.array(rid), pa.nulls(len(rid), pa.int64()), pa.array(value)], ["rid", "word", "value"])
                    continue
                if held and row["bucket"] != held[0]["bucket"]:
                    yield from _bucket_scores(known, held)
                    held = []
                held.append(row)
        if held:
            yield from _bucket_scores(known, held)

    dealt = exploded(rows, top, table, head, buckets).repartition(n, "bucket").sortWithinPartitions("bucket")
    parts = stored(dealt.mapInArrow(run, "rid long, word long, value double"))
    backed = parts.where("word IS NOT NULL").join(counts.select("word", "n"), "word").select("rid", (F.col("value") * F.log("n")).alias("value"))
    sums = parts.where("word IS NULL").select("rid", "value").unionByName(backed).groupBy("rid").agg(F.sum("value").alias("value"))
    own = rows.select("doc_id", "rid", F.regexp_count("text", F.lit(_text.WORD)).cast("long").alias("n_words"))
    times = own.groupBy("rid").agg(F.count("*").alias("times"))
    found = own.join(sums.join(times, "rid"), "rid", "left")
    return found.select("doc_id", "n_words", F.when(F.col("n_words") > 0, F.col("value") / F.col("times") / F.col("n_words")).alias("log_score"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
p AS (SELECT row, CASE WHEN i > 1 THEN words[i - 1] ELSE '' END AS a, words[i] AS b FROM (SELECT row, words, unnest(range(1, len(words) + 1)) AS i FROM d)),
u AS (SELECT b, count(*) AS n FROM p GROUP BY b), c AS (SELECT a, count(*) AS n FROM p GROUP BY a), t AS (SELECT count(*) AS n FROM p),
g AS (SELECT a, b, count(*) AS n FROM p GROUP BY a, b),
s AS (SELECT row, avg(CASE WHEN g.n >= 2 THEN ln(g.n / c.n) ELSE ln(0.4 * u.n / t.n) END) AS log_score
      FROM p JOIN g ON p.a = g.a AND p.b = g.b JOIN u ON p.b = u.b JOIN c ON p.a = c.a, t GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, round(log_score, 6) AS log_score FROM d LEFT JOIN s ON d.row = s.row
"""
