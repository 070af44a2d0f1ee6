"""Spelling variants over a variable-length gram index.

1. Words: the runs of letters of whole texts, counted; those with at least
   ``SHORTEST`` letters and ``LEAST`` occurrences go on.
2. Gram dictionary: all grams of ``QMIN`` letters, and every longer gram (up
   to ``QMAX``) whose prefix, one letter shorter, occurs more often than once
   in ``SHARE`` of all gram positions: only grams too frequent to be useful
   are told apart further.  So at most SHARE prefixes a length are extended,
   by at most 90 letters each, whatever the corpus; that bounds the broadcast.
3. A word is decomposed into the longest dictionary gram at each of its
   positions, without those that lie inside an earlier one.
4. For each word, the most grams that one edit can affect (``affected``):
   those that cover the place, those that a longer gram through the place
   could replace or cover.  Two words one edit apart share all but so many
   grams of either, at positions that differ by at most the edit's shift.  So
   each word enters the lists of its affected + 1 rarest grams, keyed by gram,
   length of the word and position, and a near word shares one of these lists.
5. Lists are merged by a join; pairs that meet are verified by their edit
   distance.  Words all of whose grams one edit can affect have no such bound
   (short words of long grams): those alone are also listed under themselves
   with each letter left out, which two near words must share.

Of its near words the most frequent one (smallest first among equals) is a
word's form if it occurs at least ``RATIO`` times as often; the root is found
by doubling the steps along the forms, whose counts grow by RATIO each step.

Defined results: a null text has no words; a null id counts as empty in the
errors' hash; repeated rows count each; other columns are ignored; empty
tables give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import run_folder, stored, table

#: Letters A-Z, a-z and U+00C0 to U+00FF of texts in UTF-8, A-Z lower-cased before.
LETTERS = re.compile(rb"(?:[a-z]++|\xc3[\x80-\xbf])+")
SHORTEST, LEAST, RATIO = 6, 5, 5
QMIN, QMAX, SHARE = 2, 4, 2000
#: The contract's rate of errors: one in so many words of a text loses a letter.
ERRORS = 199
#: Distinct words or grams that a task holds before it passes its counts on.
HELD = 400_000


# ---- words ------------------------------------------------------------------

def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", errors: int | None = None,
                shortest: int = SHORTEST) -> DataFrame:
    """(word, n) of all words of at least ``shortest`` letters.  With
    ``errors``, a word whose CRC-32 with its document's id is divisible by
    that number loses the letter that the CRC-32 names."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches):
        held: Counter = Counter()

        def out():
            batch = pa.record_batch([pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], schema=schema)
            held.clear()
            return batch

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                start = zlib.crc32(f"{doc_id}:".encode() if doc_id is not None else b":")
                # lower() of bytes changes A-Z alone
                for w, n in Counter(LETTERS.findall((text.as_py() or "").encode().lower())).items():
                    if len(w) < shortest:
                        continue
                    if errors and not (h := zlib.crc32(w, start)) % errors:
                        word = w.decode()
                        at = h % len(word)
                        w = (word[:at] + word[at + 1:]).encode()
                    if len(w) - w.count(b"\xc3") >= shortest:
                        held[w] += n
                if len(held) > HELD:
                    yield out()
        yield out()

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))


# ---- gram dictionary ----------------------------------------------------------

def count_grams(words: DataFrame, qmin: int = QMIN, qmax: int = QMAX) -> DataFrame:
    """(gram, n): occurrences of all grams in the distinct words."""
    def count(batches):
        held: Counter = Counter()
        for b in batches:
            for w in b.column(0).to_pylist():
                for q in range(qmin, qmax + 1):
                    held.update(w[i:i + q] for i in range(len(w) - q + 1))
                if len(held) > HELD:
                    yield pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["gram", "n"])
                    held.clear()
        yield pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["gram", "n"])

    return words.select("word").mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def gram_dictionary(words: DataFrame, folder: str, qmin: int = QMIN, qmax: int = QMAX, share: int = SHARE) -> dict[str, int]:
    """The pruned dictionary with its counts: at most 90 ** qmin grams of the
    shortest length and 90 * share of each longer one."""
    grams = stored(count_grams(words, qmin, qmax), f"{folder}/grams")
    size = F.char_length("gram")
    positions = grams.where(size == qmin).agg(F.sum("n")).first()[0] or 0
    frequent = grams.where((size < qmax) & (F.col("n") * share > positions)).select(F.col("gram").alias("prefix"))
    longer = grams.where(size > qmin).join(
        F.broadcast(frequent), F.expr("left(gram, char_length(gram) - 1)") == F.col("prefix"), "left_semi")
    kept = grams.where(size == qmin).unionByName(longer).toArrow()
    return dict(zip(kept["gram"].to_pylist(), kept["n"].to_pylist()))


class Grams:
    """Decomposition by one dictionary."""

    def __init__(self, counts: dict[str, int], qmin: int = QMIN, qmax: int = QMAX):
        self.counts, self.qmin, self.qmax = counts, qmin, qmax
        self.heads = {g[:i] for g in counts for i in range(len(g))}
        self.tails = {g[i:] for g in counts for i in range(1, len(g) + 1)}

    def ends(self, w: str) -> list[int]:
        """Where the longest dictionary gram at each position ends."""
        out = []
        for p in range(len(w) - self.qmin + 1):
            end = min(len(w), p + self.qmax)
            while end > p + self.qmin and w[p:end] not in self.counts:
                end -= 1
            out.append(end)
        return out

    @staticmethod
    def kept(ends: list[int]) -> list[int]:
        """Positions whose gram does not lie inside an earlier one."""
        out, furthest = [], 0
        for p, end in enumerate(ends):
            if end > furthest:
                out.append(p)
                furthest = end
        return out

    def affected(self, w: str, ends: list[int], kept: list[int]) -> int:
        """The most kept grams that one inserted, deleted or replaced letter
        can change, cover or destroy.

        At a place i only positions in (i - qmax, i] can get another gram:
        where theirs reaches past i, or where w[p:i] begins a longer gram.
        From the first of these on, kept grams up to i may be covered anew;
        after i, those that end inside a gram through the place, which ends
        with the letters that follow it."""
        most, n, is_kept = 0, len(w), [False] * (len(w) + 1)
        for p in kept:
            is_kept[p] = True
        for i in range(n + 1):
            first = i
            for p in range(max(0, i - self.qmax + 1), i):
                if (p < len(ends) and ends[p] > i) or w[p:i] in self.heads:
                    first = p
                    break
            left = sum(is_kept[first:i])
            for after in ({i + 1, i} if i < n else {i}):  # replaced or deleted; inserted before
                reach = min(n, after + self.qmax - 1)
                while reach > after and w[after:reach] not in self.tails:
                    reach -= 1
                at_place = is_kept[i] if after > i and i < n else 0
                right = sum(1 for p in range(after, min(reach, len(ends))) if is_kept[p] and ends[p] <= reach)
                most = max(most, left + at_place + right)
        return most

    def lists(self, w: str) -> tuple[list[tuple[str, int]], bool]:
        """(gram, position) of the lists that the word enters; whether one
        edit can affect all its grams."""
        ends = self.ends(w)
        kept = self.kept(ends)
        affected = self.affected(w, ends, kept)
        grams = sorted(((w[p:ends[p]], p) for p in kept), key=lambda g: (self.counts.get(g[0], 0), g))
        return grams[:affected + 1], affected >= len(grams)


# ---- near words ---------------------------------------------------------------

def near_words(words: DataFrame, folder: str, qmin: int = QMIN, qmax: int = QMAX, share: int = SHARE) -> DataFrame:
    """(a, b, na, nb): all pairs of ``words(word, n)`` one edit apart, once."""
    spark = words.sparkSession
    counts = spark.sparkContext.broadcast(gram_dictionary(words, folder, qmin, qmax, share))
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("size", pa.int32()), ("gram", pa.string()),
                        ("in_size", pa.int32()), ("at", pa.int32())])

    def decompose(batches):
        grams = Grams(counts.value, qmin, qmax)
        for b in batches:
            rows = []
            for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                listed, loose = grams.lists(w)
                rows += [(w, n, len(w), g, len(w), p) for g, p in listed]
                if loose:
                    rows += [(w, n, len(w), x, -1, -1) for x in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}]
                if len(rows) > 50_000:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
            if rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    listed = stored(words.select("word", "n").mapInArrow(
        decompose, "word string, n long, size int, gram string, in_size int, at int"), f"{folder}/lists")
    # a word looks into its own lists, and as the shorter word into those of words one longer
    size, at = F.col("in_size"), F.col("at")
    looks = F.when(size < 0, F.array(F.struct(size.alias("in_size"), at.alias("at")))).otherwise(F.array(
        *[F.struct((size + s).alias("in_size"), (at + p).alias("at")) for s, p in ((0, 0), (1, 0), (1, 1))]))
    a = listed.select(F.col("word").alias("a"), F.col("n").alias("na"), F.col("size").alias("sa"), "gram", F.explode(looks).alias("l")).select(
        "a", "na", "sa", "gram", "l.in_size", "l.at")
    b = listed.select(F.col("word").alias("b"), F.col("n").alias("nb"), F.col("size").alias("sb"), "gram", "in_size", "at")
    once = ((F.col("in_size") >= 0) & (F.col("sa") < F.col("sb"))) | (F.col("a") < F.col("b"))
    met = a.join(b, ["gram", "in_size", "at"]).where(once & (F.levenshtein("a", "b", 1) == 1))
    x, y = F.struct(F.col("a").alias("w"), F.col("na").alias("n")), F.struct(F.col("b").alias("w"), F.col("nb").alias("n"))
    return (met.select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y"))
            .select(F.col("x.w").alias("a"), F.col("y.w").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb")).distinct())


def roots(forms: DataFrame, folder: str) -> DataFrame:
    """(word, root) of ``forms(word, form)``: the last form reached.  Each
    round doubles the steps; forms must not lead in circles."""
    spark = forms.sparkSession
    hop = stored(forms.select("word", F.col("form").alias("root")), f"{folder}/hop-0")
    i = 0
    while True:
        on = hop.select(F.col("word").alias("root"), F.col("root").alias("further"))
        i += 1
        nxt = hop.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        nxt.write.parquet(f"{folder}/hop-{i}")
        nxt = spark.read.schema(nxt.schema).parquet(f"{folder}/hop-{i}")
        hop = nxt.drop("moved")
        if nxt.where("moved").isEmpty():
            return hop


def spelling_variants(words: DataFrame, ratio: int = RATIO, qmin: int = QMIN, qmax: int = QMAX, share: int = SHARE) -> DataFrame:
    """One row per word of ``words(word, n)``: word, form, root, n, n_near, form_n."""
    folder = run_folder(words.sparkSession, "variants")
    words = stored(words.select("word", "n"), f"{folder}/words")
    pairs = stored(near_words(words, folder, qmin, qmax, share), f"{folder}/pairs")
    both = (pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("m"))
            .unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("m"))))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    judged = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.m") >= ratio * F.col("n"), F.col("best")).alias("best")), f"{folder}/judged")
    found = judged.where("best IS NOT NULL").select("word", F.col("best.near").alias("form"))
    return (judged.join(roots(found, folder), "word", "left")
            .select("word", F.col("best.near").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near", (-F.col("best.m")).alias("form_n")))


def query(spark, sf_dir):
    counted = count_words(table(spark, sf_dir, "documents"), errors=ERRORS)
    return spelling_variants(counted.where(F.col("n") >= LEAST))


#: The same: CRC-32 by its table, near words by their letters left out.
SQL = r"""
WITH RECURSIVE c AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY i) AS tab
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)),
o AS (
  SELECT doc_id, w, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[a-z\x{C0}-\x{FF}]+')) AS w FROM documents)
  WHERE length(w) >= 6 GROUP BY ALL),
b AS (
  SELECT w, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS x FROM o),
h AS (
  SELECT w, n, xor(list_reduce(list_transform(range(0, length(x) // 2), lambda i: CAST('0x' || substr(x, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)),
                               lambda a, y: xor(a >> 8, tab[CAST(xor(a, y) & 255 AS BIGINT) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h
  FROM b, c),
w AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) + 2 AS BIGINT)) ELSE w END AS word, n FROM h)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
k AS (
  SELECT word, word AS key FROM w
  UNION SELECT word, substr(word, 1, i - 1) || substr(word, i + 1) FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (
  SELECT DISTINCT x.word AS a, y.word AS b
  FROM k x JOIN k y ON x.key = y.key AND x.word <> y.word
  WHERE (length(x.word) <> length(y.word) AND (x.key = x.word OR x.key = y.word))
     OR (length(x.word) = length(y.word)
         AND len(list_filter(range(1, length(x.word) + 1), lambda i: substr(x.word, i, 1) <> substr(y.word, i, 1))) = 1)),
f AS (
  SELECT w.word, w.n, count(p.b) AS n_near, first(p.b ORDER BY o.n DESC, p.b) AS near, max(o.n) AS near_n
  FROM w LEFT JOIN p ON p.a = w.word LEFT JOIN w o ON o.word = p.b GROUP BY w.word, w.n),
g AS (SELECT *, CASE WHEN near_n >= 5 * n THEN near END AS form FROM f),
r AS (SELECT word, word AS spot, 0 AS steps FROM g
      UNION ALL SELECT r.word, g.form, steps + 1 FROM r JOIN g ON g.word = r.spot WHERE g.form IS NOT NULL)
SELECT g.word, g.form, r.root, g.n, g.n_near, CASE WHEN g.form IS NOT NULL THEN g.near_n END AS form_n
FROM g JOIN (SELECT word, arg_max(spot, steps) AS root FROM r GROUP BY word) r ON r.word = g.word
"""
