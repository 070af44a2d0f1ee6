"""Benchmark decontamination with an FM-index per training shard.

Benchmark items are cut into windows of ``window`` words (a shorter item is
one window); the distinct windows are the test phrases.  A task reads its
documents into shards: words become symbols of the benchmark's vocabulary,
and only runs of such words at least as long as the shortest phrase are laid
into the shard's text, since no phrase can touch any other word.  Each shard
is indexed, all phrases are searched backward through the wavelet ranks,
their occurrences located through sampled suffix positions, and the spans
merged per document.  A shard is closed at ``SHARD_SYMBOLS``, so memory is
bounded; a longer document is a shard of its own.

The phrases travel to the tasks in blocks of at most ``BLOCK_WORDS`` words of
benchmark text: one for the usual benchmark, several passes over the
documents for a larger one, whose spans are merged at the end.

Defined results: null and empty texts have no words, are not hit, and are not
contaminated; items without words have no windows; an item repeated under its
id counts once; an item with a null id hits words but is not listed; equal
rows are judged alike, each on its own; either table may be empty.  Rows of
the result are those of the documents, whatever their ids.  Other columns are
ignored.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import run_folder, set_aside, stored, table
from .fmindex import FMIndex

WINDOW = 13
#: A document is contaminated if it is hit and 20 hits >= words.
SHARE = 20
#: A shard closes at so many symbols of the benchmark, documents, or bytes of passed-on columns.
SHARD_SYMBOLS, SHARD_DOCUMENTS, SHARD_BYTES = 400_000, 50_000, 64 << 20
BLOCK_WORDS = 1_000_000

#: A-Z to a-z, every other ASCII character but a-z and 0-9 to a blank.
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words: [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_KEEP).split()


class Phrases:
    """The distinct windows of some benchmark items, as symbols."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.symbols: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str | None]] = {}
        for item, text in items:
            seq = [self.symbols.setdefault(w, len(self.symbols) + 1) for w in words_of(text)]
            for i in range(max(1, len(seq) - window + 1) if seq else 0):
                found.setdefault(tuple(seq[i:i + window]), set()).add(item)
        by_length: dict[int, list] = {}
        for phrase, names in found.items():
            by_length.setdefault(len(phrase), []).append((phrase, sorted(n for n in names if n is not None)))
        self.groups = [(np.array([p for p, _ in g], np.int64), [n for _, n in g]) for _, g in sorted(by_length.items())]
        self.shortest = min(by_length, default=0)


class Shard:
    """Documents of one index."""

    def __init__(self, phrases: Phrases):
        self.phrases, self.size = phrases, 0
        self.words: list[int] = []
        self.runs: list[tuple[int, int, np.ndarray]] = []

    def add(self, text: str | None) -> None:
        doc, words = len(self.words), words_of(text)
        self.words.append(len(words))
        if len(words) < self.phrases.shortest or not self.phrases.groups:
            return
        get = self.phrases.symbols.get
        seq = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        edge = np.flatnonzero(np.diff(np.concatenate([[0], seq != 0, [0]])))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b - a >= self.phrases.shortest:
                self.runs.append((doc, a, seq[a:b]))
                self.size += b - a + 1

    def search(self) -> tuple[list[list[tuple[int, int]]], list[set[str]]]:
        """Per document: merged (start, end) word spans, and items found."""
        spans: list[list[tuple[int, int]]] = [[] for _ in self.words]
        items: list[set[str]] = [set() for _ in self.words]
        if not self.runs:
            return spans, items
        starts = np.cumsum([0] + [len(s) + 1 for _, _, s in self.runs])[:-1]
        text = np.zeros(self.size, np.int64)
        for at, (_, _, s) in zip(starts.tolist(), self.runs):
            text[at:at + len(s)] = s
        index = FMIndex(text, len(self.phrases.symbols))
        edges = np.zeros(self.size + 1, np.int64)
        doc_of = np.array([d for d, _, _ in self.runs])
        for group, names in self.phrases.groups:
            lo, hi = index.search(group)
            n = hi - lo
            hits = np.flatnonzero(n)
            if not len(hits):
                continue
            which = np.repeat(hits, n[hits])
            rows = np.arange(len(which)) - np.repeat(np.cumsum(n[hits]) - n[hits], n[hits]) + np.repeat(lo[hits], n[hits])
            at = index.locate(rows)
            np.add.at(edges, at, 1)
            np.add.at(edges, at + group.shape[1], -1)
            docs = doc_of[np.searchsorted(starts, at, "right") - 1]
            for d, p in np.unique(np.stack([docs, which], 1), axis=0).tolist():
                items[d].update(names[p])
        hit = np.cumsum(edges[:-1]) > 0
        change = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
        for a, b in zip(change[::2].tolist(), change[1::2].tolist()):
            # a span never crosses a separator, so it lies in one run
            r = int(np.searchsorted(starts, a, "right") - 1)
            doc, first, _ = self.runs[r]
            spans[doc].append((first + a - int(starts[r]), first + b - int(starts[r])))
        return spans, items


FOUND = "n_words long, spans array<struct<start: int, end: int>>, items array<string>"


def _search(docs: DataFrame, phrases: Phrases, text_col: str, keep: list[str]) -> DataFrame:
    """``keep`` columns of every document with n_words, spans and items."""
    shared = docs.sparkSession.sparkContext.broadcast(phrases)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def scan(batches):
        p = shared.value

        def out(shard, rows):
            """A batch per batch that the shard's rows came in: columns are
            passed on as they are, never put together."""
            spans, items = shard.search()
            at = 0
            for b in rows:
                to = at + b.num_rows
                yield pa.record_batch(
                    [*b.columns, pa.array(shard.words[at:to], pa.int64()),
                     pa.array([[{"start": x, "end": y} for x, y in s] for s in spans[at:to]], span),
                     pa.array([sorted(i) for i in items[at:to]], pa.list_(pa.string()))],
                    names=[*b.schema.names, "n_words", "spans", "items"])
                at = to

        shard, rows, held = Shard(p), [], 0
        for b in batches:
            text, first = b.column(b.num_columns - 1), 0
            b = b.select(range(b.num_columns - 1))
            for i, t in enumerate(text):
                shard.add(t.as_py())
                if shard.size >= SHARD_SYMBOLS:
                    rows.append(b.slice(first, i + 1 - first))
                    yield from out(shard, rows)
                    shard, rows, held, first = Shard(p), [], 0, i + 1
            if first < b.num_rows:
                rows.append(b.slice(first))
                held += rows[-1].nbytes
            # by what is held, whether or not its words are the benchmark's
            if len(shard.words) >= SHARD_DOCUMENTS or held >= SHARD_BYTES:
                yield from out(shard, rows)
                shard, rows, held = Shard(p), [], 0
        if rows:
            yield from out(shard, rows)

    kept = docs.select(*keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(scan, f"{fields}, {FOUND}")


def blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int):
    """The benchmark's (item, text) rows in blocks of bounded size."""
    held, size = [], 0
    rows = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).alias("t"))
    for r in rows.toLocalIterator():
        held.append((r.i, r.t))
        size += len(words_of(r.t))
        if size >= block_words:
            yield held
            held, size = [], 0
    if held:
        yield held


def merged(spans: Column) -> Column:
    """Overlapping or touching word spans as one, in order."""
    s = F.array_sort(spans)
    empty = F.slice(s, 1, 0)
    return F.aggregate(s, empty, lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]),
        F.concat(F.slice(acc, F.lit(1), F.greatest(F.lit(0), F.size(acc) - 1)),
                 F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"),
                                  F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(x))))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  block_words: int = BLOCK_WORDS, keep: list[str] | None = None) -> DataFrame:
    """One row per document: ``keep`` (default: the id) and n_words, spans of
    hit words, items, n_hit, contaminated."""
    keep = keep or [id_col]
    rest = blocks(benchmark, item_col, item_text_col, block_words)
    first, second = next(rest, []), next(rest, None)
    if second is None:
        found = _search(docs, Phrases(first, window), text_col, keep)
    else:
        # several passes, of which the driver holds one block at a time: rows
        # are numbered once, spans of a row merged
        spark, folder = docs.sparkSession, run_folder(docs.sparkSession, "decontaminate")
        numbered = stored(docs.select(*keep, F.col(text_col).alias("_t"), F.monotonically_increasing_id().alias("_row")),
                          f"{folder}/rows")
        found = None
        for i, block in enumerate(chain([first, second], rest)):
            one = stored(_search(numbered, Phrases(block, window), "_t", ["_row"]), f"{folder}/{i}")
            found = one if found is None else found.unionByName(one)
        found = found.groupBy("_row").agg(
            F.max("n_words").alias("n_words"), merged(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        found = numbered.drop("_t").join(found, "_row").drop("_row")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + (x["end"] - x["start"]))
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words")))


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, whole, with all columns."""
    # the text goes through the scan once more beside the searched copy
    rows, names, back = set_aside(docs)
    out = contamination(rows, benchmark, names[id_col], names[text_col], item_col, item_text_col, window,
                        keep=list(names.values()))
    return back(out.filter("not contaminated"))


def query(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), "contaminated")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
b AS (
  SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM benchmark),
p AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m, list_slice(w, i, i + least(13, len(w)) - 1) AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
m AS (SELECT DISTINCT m FROM p),
o AS (
  SELECT r, m, i, list_slice(w, i, i + m - 1) AS phrase
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, m WHERE len(w) >= m)),
h AS (SELECT o.r, o.i, o.m, p.item_id FROM o JOIN p ON o.m = p.m AND o.phrase = p.phrase),
n AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS k FROM h) GROUP BY r),
t AS (
  SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS s FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)
"""
