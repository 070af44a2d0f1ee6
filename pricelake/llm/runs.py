"""Periodic runs of words: maximal pairs out of an LCP-interval tree.

A run is a stretch of words with smallest period q, at least ``least`` and at
least 2 * q words long, that neither neighbour extends.  Two occurrences i < j
of the same factor of m words, with different words before them and different
words after them, are a maximal pair.  If their distance q = j - i is at most
m, the stretch [i, j + m) has the period q, can't be extended and holds it
twice: maximal pairs with q <= m and q + m >= least *are* the runs, one for
each multiple of the smallest period that fits twice; of one stretch the
smallest distance is kept.

Per text: a suffix array by prefix doubling; longest common prefixes of
neighbours from the doubling's ranks; then the intervals of suffixes that
share at least least / 2 words (shorter factors give no run) bottom-up.  An
interval holds its positions in lists by the word to their left.  When two
children meet, each position of the smaller looks in the other's lists of
other left words, m words around it, so positions that only repeat a pair
further right are never touched.

Texts whose windows of least / 2 words are all different are known to have no
run after one pass over a batch's window hashes.  Texts are judged one by one
inside the scan: no shuffle, and a task holds one Arrow batch.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; a null or wordless text
has no runs and an empty collapsed text; a null id is passed through; rows
that repeat an id are judged each; other columns are ignored; empty tables
give no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, table

LEAST = 12
#: Words of texts that are looked at together, and words a task remembers.
TOGETHER, HELD = 200_000, 1_000_000
RUNS = "array<struct<start: long, length: long, period: long>>"


# ---- suffix array -----------------------------------------------------------

def suffix_array(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, words that each shares with the one before it)."""
    n, k = len(w), 1
    ranks = [np.unique(w, return_inverse=True)[1].astype(np.int64)]
    while ranks[-1].max() < n - 1:
        r = ranks[-1]
        then = np.zeros(n, np.int64)  # 0: past the end
        then[:n - k] = r[k:] + 1
        ranks.append(np.unique(r * (n + 1) + then, return_inverse=True)[1].astype(np.int64))
        k *= 2
    order = np.empty(n, np.int64)
    order[ranks[-1]] = np.arange(n)
    # equal ranks at one level are equal windows of its width, both inside the text
    lcp = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for level in range(len(ranks) - 2, -1, -1):
        r = np.append(ranks[level], -1)
        same = (np.maximum(a, b) < n) & (r[np.minimum(a, n)] == r[np.minimum(b, n)])
        step = same.astype(np.int64) << level
        a += step
        b += step
    lcp[1:] = a - order[:-1]
    return order, lcp


# ---- intervals ----------------------------------------------------------------

class Positions:
    """Positions of one interval: all in order, and by the word before them."""
    __slots__ = ("all", "by_left")

    def __init__(self, at: int, left: int):
        self.all, self.by_left = [at], {left: [at]}

    def near(self, at: int, left: int, reach: int):
        """Positions at most ``reach`` away with another word before them."""
        lo, hi = bisect_left(self.all, at - reach), bisect_right(self.all, at + reach)
        if lo == hi:
            return
        if hi - lo <= len(self.by_left):
            own = self.by_left.get(left, ())
            for x in self.all[lo:hi]:
                i = bisect_left(own, x)
                if i == len(own) or own[i] != x:
                    yield x
            return
        for word, held in self.by_left.items():
            if word != left:
                yield from held[bisect_left(held, at - reach):bisect_right(held, at + reach)]

    def take(self, other: Positions) -> None:
        for word, held in other.by_left.items():
            mine = self.by_left.setdefault(word, [])
            for x in held:
                insort(mine, x)
                insort(self.all, x)


def maximal_runs(w: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the words ``w``, in order."""
    if len(w) < least:
        return []
    shortest = (least + 1) // 2
    order, lcp = suffix_array(w)
    if lcp.max(initial=0) < shortest:
        return []
    found: dict[tuple[int, int], int] = {}

    def met(a: Positions, b: Positions, common: int) -> Positions:
        """One interval of both; its maximal pairs that are runs are found."""
        if len(a.all) < len(b.all):
            a, b = b, a
        for left, held in b.by_left.items():
            for at in held:
                for other in a.near(at, left, common):
                    q = abs(at - other)
                    if q + common >= least:
                        stretch = (min(at, other), q + common)
                        found[stretch] = min(q, found.get(stretch, q))
        a.take(b)
        return a

    # neighbours that share too little belong to no interval
    inner = np.flatnonzero((lcp >= shortest) | (np.append(lcp[1:], 0) >= shortest))
    left = np.append(-1, w)[order[inner]]
    open_: list[tuple[int, Positions]] = []
    last = None
    for at, before, common in zip(order[inner].tolist(), left.tolist(), lcp[inner].tolist()):
        while open_ and open_[-1][0] > common:
            depth, node = open_.pop()
            last = met(node, last, depth)
        if common >= shortest:
            if open_ and open_[-1][0] == common:
                open_[-1] = (common, met(open_[-1][1], last, common))
            else:
                open_.append((common, last))
        last = Positions(at, before)
    while open_:
        depth, node = open_.pop()
        last = met(node, last, depth)
    return sorted((start, length, q) for (start, length), q in found.items())


def repeats(w: np.ndarray, text: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the texts with a window of ``k`` words that occurs in them
    twice (seldom also of one without, by its hash)."""
    n = len(w) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = text[:n].astype(np.uint64)
    for i in range(k):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + w[i:n + i].astype(np.uint64)
    whole = np.flatnonzero(text[:n] == text[k - 1:])
    order = whole[np.argsort(h[whole], kind="stable")]
    return np.unique(text[order[1:][h[order[1:]] == h[order[:-1]]]])


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


# ---- Spark ----------------------------------------------------------------------

def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """One row per document: doc_id, runs (start and length in words, period;
    by start, then period), collapsed (its words without the repetitions)."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()),
                        ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
                        ("collapsed", pa.string())])

    def scan(batches):
        numbers: dict[bytes, int] = {}

        def judged(ids, texts):
            w = np.fromiter((numbers.setdefault(x, len(numbers)) for t in texts for x in t), np.int64)
            sizes = [len(t) for t in texts]
            ends = np.cumsum(sizes)
            again = set(repeats(w, np.repeat(np.arange(len(texts)), sizes), (least + 1) // 2).tolist())
            runs = [maximal_runs(w[ends[i] - sizes[i]:ends[i]], least) if i in again else [] for i in range(len(texts))]
            if len(numbers) > HELD:
                numbers.clear()
            return pa.record_batch([
                pa.array(ids, pa.int64()),
                pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], schema.field("runs").type),
                pa.array([b" ".join(collapse(t, r)) for t, r in zip(texts, runs)], pa.binary()).cast(pa.string())], schema=schema)

        for b in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(b.column(0), b.column(1)):
                ids.append(doc_id.as_py())
                # bytes split at ASCII white space, which is \x20 and \x09-\x0D
                texts.append((text.as_py() or "").encode().split())
                size += len(texts[-1])
                if size >= TOGETHER:
                    yield judged(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield judged(ids, texts)

    return src.mapInArrow(scan, f"doc_id long, runs {RUNS}, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """The texts that the contract asks for: with h the CRC-32 of the id in
    decimals and g = h div 10, every tenth text goes on from its word
    a = g % n with p = 1 + (n - a) div (3 + g % 8) words over and over."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    d = docs.select("doc_id", "text", h.alias("h")).withColumn("words", F.when(
        F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))))
    d = d.withColumn("n", F.size("words")).withColumn("a", F.expr("CASE WHEN n > 0 THEN cast(h div 10 % n AS int) END"))
    d = d.withColumn("p", F.expr("cast(1 + (n - a) div (3 + h div 10 % 8) AS int)"))
    tail = F.expr("slice(flatten(array_repeat(slice(words, a + 1, p), cast(1 + (n - a) div p AS int))), 1, n - a)")
    return d.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(F.concat(F.expr("slice(words, 1, a)"), tail), " "))
                    .otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns out of ``periodic_runs``."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("l"), r.start.alias("start"), r.period.alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    f = found.select("doc_id", "runs", "collapsed", longest.alias("best"), lines.alias("lines"))
    length = -F.col("best.l")
    return f.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"),
                    F.col("best.period").alias("period"), F.expr("1000 * -best.l div best.period").alias("exponent_milli"),
                    F.sha2(F.array_join(F.transform("lines", lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256"))


def query(spark, sf_dir):
    return digests(periodic_runs(planted(table(spark, sf_dir, "documents"))))


#: The same by islands of equal windows of six words at each distance; CRC-32 by its table.
SQL = r"""
WITH c AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY i) AS tab
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)),
d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(CAST(doc_id AS VARCHAR))) AS x,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
h AS (
  SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n,
         xor(list_reduce(list_transform(range(0, length(x) // 2), lambda i: CAST('0x' || substr(x, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)),
                         lambda a, y: xor(a >> 8, tab[CAST(xor(a, y) & 255 AS BIGINT) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h
  FROM d, c),
a AS (SELECT *, (h // 10) % n AS a FROM h WHERE n > 0),
b AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM a),
t AS (
  SELECT r, i, CASE WHEN h % 10 = 0 AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM b)),
s AS (
  SELECT r, i, word, lead(i, 5) OVER o AS whole,
         hash(word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o, lead(word, 5) OVER o) AS six,
         [word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o, lead(word, 5) OVER o] AS six_words
  FROM t WINDOW o AS (PARTITION BY r ORDER BY i)),
m AS (
  SELECT x.r, x.i, y.i - x.i AS q
  FROM s x JOIN s y ON x.r = y.r AND x.six = y.six AND x.i < y.i
  WHERE x.whole IS NOT NULL AND y.whole IS NOT NULL AND x.six_words = y.six_words),
e AS (
  SELECT r, q, min(i) AS start, count(*) + 5 AS common
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM m) GROUP BY r, q, island),
u AS (
  SELECT r, start, q + common AS length, min(q) AS period
  FROM e WHERE q <= common AND q + common >= 12 GROUP BY r, start, q + common),
v AS (
  SELECT r, count(*) AS n_runs, first(start ORDER BY length DESC, start, period) AS start, max(length) AS length,
         first(period ORDER BY length DESC, start, period) AS period,
         sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs_sha256
  FROM u GROUP BY r),
g AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM u),
k AS (SELECT t.r, string_agg(t.word, ' ' ORDER BY t.i) AS kept FROM t ANTI JOIN g ON g.r = t.r AND g.i = t.i GROUP BY t.r)
SELECT d.doc_id, coalesce(v.n_runs, 0) AS n_runs, v.start, CAST(v.length AS BIGINT) AS length, CAST(v.period AS BIGINT) AS period,
       CAST(1000 * v.length // v.period AS BIGINT) AS exponent_milli, coalesce(v.runs_sha256, sha256('')) AS runs_sha256,
       sha256(coalesce(k.kept, '')) AS collapsed_sha256
FROM d LEFT JOIN v ON v.r = d.r LEFT JOIN k ON k.r = d.r
"""
