"""Stupid-backoff language model scores, each document left out of its own model.

The corpus's n-grams of orders 1 to ``ORDER`` are counted over all documents
and every document is scored with the counts of all the others: a word's
score is C(context, word) / C(context) at the longest order that the rest of
the corpus has seen, times ``ALPHA`` per order given up; a word that it has
never seen scores as half an occurrence.

The n-gram and count tables are kept as columnar blocks, since a row per
n-gram would take several times the input in the shuffle:

1. documents are laid into chunks of about ``CHUNK_CHARS``, written once;
2. every chunk is exploded into its distinct n-grams (hashes of ``BITS`` bits)
   with their counts, one block per order and hash partition; there are so
   many partitions that one holds about ``PART_CHARS`` characters' worth,
   however large the corpus, and a frequent n-gram is one entry per chunk,
   not per document;
3. per hash partition the blocks are merged into the count table and joined
   with it: every block gets the corpus counts of its n-grams;
4. chunks are joined with their counts, the documents' own counts are taken
   off, and the scores summed per document.

Two n-grams with the same hash share their counts: of n distinct ones about
n^2 / 2^57 pairs do, less than one for a few hundred million.

Words are those of the contracts, A-Z lower-cased; n-grams stay within a
document.  Defined results: a text without words (or null) has n_words 0 and
null scores; a corpus of one document scores by unseen words only; repeated
rows are documents of their own, so a copy does count for the other; null ids
stay null; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import run_folder, stored, table
from .near_dedup import Hashes, _mix, words_of

ORDER, ALPHA = 3, 0.4
BITS = 56
CHUNK_CHARS, PART_CHARS = 8 << 20, 2 << 20


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers by byte planes, compressed."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(block: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


class Grams:
    """The n-grams of a chunk.  Per order: the positions of their last words
    and their keys, which sort by hash partition, then by the rest of the
    hash."""

    def __init__(self, texts: list[str | None], order: int, parts: int, hashes: Hashes):
        words, self.sizes = [], []
        for t in texts:
            w = words_of(t)
            self.sizes.append(len(w))
            words += w
        n = len(words)
        w = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
        del words
        sizes = np.array(self.sizes, np.int64)
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.at, self.keys = [], []
        self.width = np.uint64((1 << BITS) // parts + 1)
        h = None
        for k in range(1, order + 1):
            x = w if k == 1 else np.concatenate([w[:1], h[:-1]]) * np.uint64(0x9E3779B97F4A7C15) + w
            h = _mix(x + np.uint64(k))
            at = np.flatnonzero(place >= k - 1)
            short = h[at] >> np.uint64(64 - BITS)
            self.at.append(at)
            self.keys.append(short % np.uint64(parts) * self.width + short // np.uint64(parts))


def chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(chunk, n_words, block): documents in bounded blocks."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def lay(batches):
        from pyspark import TaskContext
        seq, held, size = TaskContext.get().partitionId() << 32, [], 0

        def out(held):
            t = pa.Table.from_batches(held).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, t.schema) as w:
                w.write_table(t)
            n = sum(len(words_of(x.as_py())) for x in t.column(1))
            return pa.record_batch([pa.array([seq], pa.int64()), pa.array([n], pa.int64()),
                                    pa.array([zstandard.ZstdCompressor(level=9).compress(sink.getvalue().to_pybytes())], pa.binary())],
                                   names=["chunk", "n_words", "block"])

        for b in batches:
            first = 0
            for i, t in enumerate(b.column(1)):
                size += len(t.as_py() or "") + 1
                if size >= CHUNK_CHARS:
                    yield out([*held, b.slice(first, i + 1 - first)])
                    held, size, first, seq = [], 0, i + 1, seq + 1
            if first < b.num_rows:
                held.append(b.slice(first))
        if held:
            yield out(held)

    return rows.mapInArrow(lay, "chunk long, n_words long, block binary")


def _opened(block: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(block)).read_all()


def exploded(laid: DataFrame, parts: int, order: int) -> DataFrame:
    """(part, chunk, grams, counts): each chunk's distinct n-grams; the parts
    of order k are numbered from (k - 1) * ``parts``."""
    def explode(batches):
        hashes = Hashes()
        for b in batches:
            for chunk, block in zip(b.column(0).to_pylist(), b.column(1)):
                g = Grams(_opened(block.as_py()).column(1).to_pylist(), order, parts, hashes)
                for k, keys in enumerate(g.keys):
                    keys, counts = np.unique(keys, return_counts=True)
                    cuts = np.searchsorted(keys, np.arange(parts + 1, dtype=np.uint64) * g.width).tolist()
                    rows = [(k * parts + p, pack(np.diff(keys[i:j] - np.uint64(p) * g.width, prepend=np.uint64(0))), pack(counts[i:j]))
                            for p, (i, j) in enumerate(zip(cuts, cuts[1:])) if i < j]
                    yield pa.record_batch([pa.array([p for p, _, _ in rows], pa.int64()), pa.array([chunk] * len(rows), pa.int64()),
                                           pa.array([x for _, x, _ in rows], pa.binary()), pa.array([c for _, _, c in rows], pa.binary())],
                                          names=["part", "chunk", "grams", "counts"])

    return laid.select("chunk", "block").mapInArrow(explode, "part long, chunk long, grams binary, counts binary")


def counted(requests: DataFrame) -> DataFrame:
    """(part, chunk, totals): the corpus counts of each block's n-grams."""
    def join(t: pa.Table) -> pa.Table:
        blocks = [np.cumsum(unpack(x.as_py()), dtype=np.uint64) for x in t.column("grams")]
        own = np.concatenate([unpack(x.as_py()) for x in t.column("counts")]).astype(np.float64)
        _, which = np.unique(np.concatenate(blocks), return_inverse=True)
        totals = np.bincount(which, weights=own).astype(np.uint64)[which]
        cuts = np.cumsum([0] + [len(b) for b in blocks]).tolist()
        return pa.table([t.column("part"), t.column("chunk"),
                         pa.array([pack(totals[i:j]) for i, j in zip(cuts, cuts[1:])], pa.binary())], names=["part", "chunk", "totals"])

    return requests.groupBy("part").applyInArrow(join, "part long, chunk long, totals binary")


def scores(grams: Grams, totals: list[np.ndarray], words: int, alpha: float) -> np.ndarray:
    """log10 score of every word position, its document left out.
    ``totals``: per order the corpus counts of the distinct keys, in order."""
    n, out = len(grams.doc), None
    for k, (at, keys, total) in enumerate(zip(grams.at, grams.keys, totals)):
        # stable: equal n-grams lie by position, so those of a document together
        order = np.argsort(keys, kind="stable")
        keys, doc = keys[order], grams.doc[at[order]]
        new = np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)]
        own = new | np.concatenate([[True], doc[1:] != doc[:-1]])[:len(keys)]
        starts = np.flatnonzero(own)
        size = np.diff(np.append(starts, len(keys)))
        c = np.zeros(n)
        c[at[order]] = total[np.cumsum(new) - 1] - np.repeat(size, size) if len(keys) else 0
        if k == 0:
            left = words - np.array(grams.sizes, np.int64)[grams.doc]
            out = np.log10(np.where(c > 0, c, 0.5) / np.maximum(left, 1))
        else:
            context = np.concatenate([[0], rest[:-1]])
            valid = np.zeros(n, bool)
            valid[at] = True
            seen = valid & (c > 0)
            higher = np.log10(np.where(seen, c, 1) / np.where(seen, context, 1))
            out = np.where(seen, higher, np.where(valid, out + math.log10(alpha), out))
        rest = c
    return out


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, alpha: float = ALPHA) -> DataFrame:
    """doc_id, n_words, log10_score (summed), mean_log10 and perplexity."""
    spark, folder = docs.sparkSession, run_folder(docs.sparkSession, "lmscore")
    laid = stored(chunks(docs, id_col, text_col), f"{folder}/chunks")
    total = laid.agg(F.sum("n_words").alias("n")).first().n or 0
    chars = docs.agg(F.sum(F.length(text_col).cast("long")).alias("n")).first().n or 0
    parts = max(1, math.ceil(chars / PART_CHARS))
    answers = counted(exploded(laid, parts, order))
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words long, log10_score double, mean_log10 double, perplexity double"

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        t = _opened(left.column("block")[0].as_py())
        g = Grams(t.column(1).to_pylist(), order, parts, Hashes())
        got, totals = right.sort_by("part"), []
        for k in range(order):
            blocks = [unpack(x.as_py()) for p, x in zip(got.column("part").to_pylist(), got.column("totals")) if p // parts == k]
            totals.append(np.concatenate(blocks).astype(np.float64) if blocks else np.zeros(0))
        sums = np.bincount(g.doc, scores(g, totals, total, alpha), len(g.sizes)) if len(g.doc) else np.zeros(len(g.sizes))
        n = np.array(g.sizes, np.int64)
        none = n == 0
        mean = sums / np.maximum(n, 1)
        return pa.table([t.column(0), pa.array(n), pa.array(sums, mask=none), pa.array(mean, mask=none),
                         pa.array(10.0 ** -mean, mask=none)], names=["doc_id", "n_words", "log10_score", "mean_log10", "perplexity"])

    return laid.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, schema)


def query(spark, sf_dir):
    s = lm_scores(table(spark, sf_dir, "documents"))
    return s.select("doc_id", "n_words", *[F.round(c, d).alias(c) for c, d in (("log10_score", 5), ("mean_log10", 8), ("perplexity", 3))])


#: The same by window counts over all words: what a word's n-gram has in the
#: corpus less what its document has.  n-grams are whole words, not hashes.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
t AS (SELECT r, i, w[i] AS c, CASE WHEN i > 1 THEN w[i - 1] END AS b, CASE WHEN i > 2 THEN w[i - 2] END AS a
      FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
o1 AS (SELECT r, c, count(*) AS n FROM t GROUP BY ALL), g1 AS (SELECT c, sum(n) AS n FROM o1 GROUP BY ALL),
o2 AS (SELECT r, b, c, count(*) AS n FROM t WHERE i > 1 GROUP BY ALL), g2 AS (SELECT b, c, sum(n) AS n FROM o2 GROUP BY ALL),
o3 AS (SELECT r, a, b, c, count(*) AS n FROM t WHERE i > 2 GROUP BY ALL), g3 AS (SELECT a, b, c, sum(n) AS n FROM o3 GROUP BY ALL),
x AS (
  SELECT t.r, t.i, g1.n - o1.n AS c1, gb.n - ob.n AS before1, g2.n - o2.n AS c2, gab.n - oab.n AS before2, g3.n - o3.n AS c3,
         (SELECT count(*) FROM t) - len(d.w) AS rest
  FROM t JOIN d ON d.r = t.r
  JOIN g1 ON g1.c = t.c JOIN o1 ON o1.r = t.r AND o1.c = t.c
  LEFT JOIN g1 gb ON gb.c = t.b LEFT JOIN o1 ob ON ob.r = t.r AND ob.c = t.b
  LEFT JOIN g2 ON g2.b = t.b AND g2.c = t.c LEFT JOIN o2 ON o2.r = t.r AND o2.b = t.b AND o2.c = t.c
  LEFT JOIN g2 gab ON gab.b = t.a AND gab.c = t.b LEFT JOIN o2 oab ON oab.r = t.r AND oab.b = t.a AND oab.c = t.b
  LEFT JOIN g3 ON g3.a = t.a AND g3.b = t.b AND g3.c = t.c LEFT JOIN o3 ON o3.r = t.r AND o3.a = t.a AND o3.b = t.b AND o3.c = t.c),
s AS (
  SELECT r, sum(CASE WHEN c3 > 0 THEN log10(c3::DOUBLE / before2)
                     WHEN c2 > 0 THEN log10(c2::DOUBLE / before1) + CASE WHEN i > 2 THEN log10(0.4::DOUBLE) ELSE 0 END
                     ELSE log10(CASE WHEN c1 > 0 THEN c1::DOUBLE ELSE 0.5 END / greatest(rest, 1)) + least(i - 1, 2) * log10(0.4::DOUBLE) END) AS score
  FROM x GROUP BY r)
SELECT doc_id, len(w) AS n_words, round(score, 5) AS log10_score, round(score / len(w), 8) AS mean_log10,
       round(pow(10.0::DOUBLE, -score / len(w)), 3) AS perplexity
FROM d LEFT JOIN s USING (r)
"""
