"""Language identification by words first, then shorter and shorter n-grams.

Training counts every word of every labelled training document (whole texts,
combined in the tasks), and from the word counts the character n-grams of
the padded words.  All counts stay in a table.  If it has at most
``MODEL_ENTRIES`` words and as many n-grams of each length, it is broadcast
whole; otherwise only the most frequent words are, and the other words of the
texts are joined to the table, counted once per document.  The way makes no
difference to the result: evidence is a multiple of 1 / ``GRID``, so that its
sums are exact in any order.

A word that was counted adds its log relative frequency per language.  An
unseen word falls back to its 4-grams; if none of them was counted, to its
3-grams, 2-grams, then letters.  What was never counted adds nothing.
The score is the posterior of the best language under equal priors.

Defined results: a null or empty text, or one without a letter, is ``und``
with score 0, as is every text if nothing could be learned.  A text with
letters but no evidence gets the language with the most training words, with
score 1 / languages.  A null id counts as the empty string for the held-out
split.  Ties go to the language with more training words, then by name.
"""

from __future__ import annotations

from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import remove, run_folder, set_aside, stored, table
from .words import HELD, LETTERS, count_words

#: Words, and n-grams of each length, that are broadcast.
MODEL_ENTRIES = 60_000
LENGTHS = (4, 3, 2, 1)
GRID = 2.0 ** 18
#: Letters of the longest entry that is a word; longer runs give n-grams.
LONGEST = 40
#: A word in more than one of so many (document, word) pairs is joined by broadcast.
BUSY = 10_000
#: Values of unseen words' evidence that a worker holds.
CACHED = 2_000_000


def held_out(id_col: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def count_grams(counts: DataFrame) -> DataFrame:
    """(label, k, word, n): the k-grams of the padded words of
    ``counts(label, word, n)``, weighted by n and summed in the tasks."""
    schema = pa.schema([("label", pa.string()), ("k", pa.int32()), ("word", pa.string()), ("n", pa.int64())])

    def count(batches):
        held: dict[tuple[str, int], dict[str, int]] = {}

        def out():
            for (label, k), c in held.items():
                yield pa.record_batch([pa.array([label] * len(c)), pa.array([k] * len(c), pa.int32()), pa.array(list(c)),
                                       pa.array(list(c.values()), pa.int64())], schema=schema)
            held.clear()

        for b in batches:
            for label, word, n in zip(*(c.to_pylist() for c in b.columns)):
                p = f" {word} "
                for k in LENGTHS:
                    c = held.setdefault((label, k), {})
                    for i in range(len(p) - k + 1):
                        g = p[i:i + k]
                        c[g] = c.get(g, 0) + n
            if sum(map(len, held.values())) > HELD:
                yield from out()
        yield from out()

    return (counts.select("label", "word", "n").mapInArrow(count, "label string, k int, word string, n long")
            .filter("word <> ' '").groupBy("label", "k", "word").agg(F.sum("n").alias("n")))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", entries: int = MODEL_ENTRIES) -> dict:
    """The model of ``docs``, all of whose labelled rows are learned from:
    languages, words -> row, n-grams -> row, and the rows' evidence.  If
    these are not the whole model, the most frequent words alone, and the
    tables of all evidence by length (0 for words)."""
    spark = docs.sparkSession
    folder = run_folder(spark, "langid")
    counts = stored(count_words(docs.filter(F.col(lang_col).isNotNull()), text_col, lang_col, None), folder)
    totals = counts.groupBy("label").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "label").collect()
    langs = [r.label for r in totals]
    if not langs:
        remove(spark, folder)
        return {"langs": [], "rows": {}, "evidence": np.zeros((0, 0), np.float32), "whole": True}
    words = counts.filter(F.length("word") <= LONGEST)
    both = words.withColumn("k", F.lit(0)).unionByName(count_grams(counts))
    per = both.groupBy("k", "word").agg(F.sum("n").alias("n"), *[
        F.sum(F.when(F.col("label") == x, F.col("n")).otherwise(0)).alias(f"n{i}") for i, x in enumerate(langs)])
    per = stored(per, f"{folder}-model")
    remove(spark, folder)
    sums = {r.k: r for r in per.groupBy("k").agg(F.count(F.lit(1)).alias("rows"), *[
        F.sum(f"n{i}").alias(f"n{i}") for i in range(len(langs))]).collect()}
    tables = {k: per.filter(F.col("k") == k).select("word", "n", *[
        (F.rint(F.log((F.col(f"n{i}") + 0.5) / F.lit(1.0 + (sums[k][f"n{i}"] if k in sums else 0))) * GRID) / GRID).alias(f"e{i}")
        for i in range(len(langs))]) for k in (0, *LENGTHS)}
    whole = all(r.rows <= entries for r in sums.values())
    rows, evidence = {}, []
    for k in (0, *LENGTHS) if whole else (0,):
        top = tables[k] if whole else most_frequent(tables[k], entries)
        top = top.drop("n").toArrow().combine_chunks()
        for w in top.column("word").to_pylist():
            rows[(k, w) if k else w] = len(rows)
        evidence.append(np.column_stack([top.column(f"e{i}").to_numpy() for i in range(len(langs))]).astype(np.float32))
    model = {"langs": langs, "rows": rows, "evidence": np.concatenate(evidence), "whole": whole}
    if whole:
        remove(spark, f"{folder}-model")
        return model
    return model | {"tables": tables, "folder": f"{folder}-model"}


def most_frequent(table: DataFrame, entries: int) -> DataFrame:
    """The rows of ``table(word, n, ...)`` from some frequency on, at most
    ``entries`` of them.  The frequency is found by counting rows per level
    (sixteen to a doubling, so some hundred levels), without sorting words in
    one place; none at all if the highest level alone holds too many."""
    level = F.floor(F.log2("n") * 16)
    least, total = None, 0
    for r in sorted(table.groupBy(level.alias("level")).count().collect(), reverse=True):
        total += r["count"]
        if total > entries:
            break
        least = r.level
    return table.filter(level >= least) if least is not None else table.limit(0)


class Scorer(dict):
    """word -> row of ``self.table``; an unseen word's row is its backed-off
    evidence, made when first met.  At most ``CACHED`` values are held."""

    def __init__(self, model: dict):
        super().__init__()
        self.rows, n = model["rows"], len(model["evidence"])
        self.own = n
        langs = len(model["langs"])
        self.table = np.concatenate([model["evidence"], np.zeros((1000 + CACHED // max(1, langs), langs), np.float32)])
        self.used = n

    def __missing__(self, word: str) -> int:
        at = self.rows.get(word)
        if at is not None:
            self[word] = at
            return at
        if self.used == len(self.table):
            raise LookupError
        p, rows = f" {word} ", self.rows
        for k in LENGTHS:
            got = [x for i in range(len(p) - k + 1) if (x := rows.get((k, p[i:i + k]))) is not None]
            if got:
                # as one word: the mean evidence of its n-grams
                self.table[self.used] = np.round(self.table[got].mean(0, dtype=np.float64) * GRID) / GRID
                break
        else:
            self.table[self.used] = 0
        self[word] = self.used
        self.used += 1
        return self.used - 1

    def evidence(self, words: list[str]) -> np.ndarray:
        total = np.zeros(self.table.shape[1])
        for i in range(0, len(words), 1000):
            part = words[i:i + 1000]
            try:
                at = list(map(self.__getitem__, part))
            except LookupError:
                self.clear()
                self.used = self.own
                at = list(map(self.__getitem__, part))
            total += self.table[at].sum(0, dtype=np.float64)
        return total


def predict(docs: DataFrame, model: dict, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with lang_pred and score, the text last or left out; by a
    model that is broadcast whole."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*[c for c in docs.columns if c != text_col], text_col)

    def score(batches):
        m = shared.value
        langs, scorer = m["langs"], Scorer(m)
        for b in batches:
            pred, conf = [], []
            for t in b.column(b.num_columns - 1):
                words = LETTERS.findall((t.as_py() or "").lower()) if langs else []
                if not any(c.isalpha() for w in words for c in w):
                    pred.append("und")
                    conf.append(0.0)
                    continue
                e = scorer.evidence(words)
                i = int(np.argmax(e))
                pred.append(langs[i])
                conf.append(1.0 / float(np.exp(e - e[i]).sum()))
            n = b.num_columns - (not keep_text)
            yield pa.record_batch([*b.columns[:n], pa.array(pred, pa.string()), pa.array(conf, pa.float64())],
                                  names=[*b.schema.names[:n], "lang_pred", "score"])

    kept = rows if keep_text else rows.drop(text_col)
    return rows.mapInArrow(score, kept.withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema)


def looked_up(words: DataFrame, tables: dict[int, DataFrame], langs: int, folder: str) -> DataFrame:
    """The evidence e0, e1, ... of distinct ``words(word, docs)``: of the word
    if it was counted, else the mean of its longest n-grams that were."""
    names = [f"e{i}" for i in range(langs)]
    both = stored(words.join(tables[0].drop("n"), "word", "left"), f"{folder}/seen")
    out, left = both.filter("e0 IS NOT NULL"), both.filter("e0 IS NULL").select("word", "docs")
    for k in LENGTHS:
        def cut(batches, k=k):
            for b in batches:
                for i in range(0, b.num_rows, 1000):
                    word, docs, gram, times = [], [], [], []
                    for w, d in zip(*(c.to_pylist() for c in b.slice(i, 1000).columns)):
                        p = f" {w} "
                        for g, n in Counter(p[j:j + k] for j in range(len(p) - k + 1)).items():
                            word.append(w)
                            docs.append(d)
                            gram.append(g)
                            times.append(n)
                    yield pa.record_batch([pa.array(word, pa.string()), pa.array(docs, pa.int64()), pa.array(gram, pa.string()),
                                           pa.array(times, pa.int64())], names=["word", "docs", "gram", "times"])

        grams = left.mapInArrow(cut, "word string, docs long, gram string, times long")
        mean = [(F.rint(F.sum(F.col("times") * F.col(e)) / F.sum("times") * GRID) / GRID).alias(e) for e in names]
        got = stored(grams.join(tables[k].drop("n").withColumnRenamed("word", "gram"), "gram")
                     .groupBy("word").agg(F.max("docs").alias("docs"), *mean), f"{folder}/grams-{k}")
        out = out.unionByName(got)
        left = stored(left.join(got, "word", "left_anti"), f"{folder}/left-{k}")
        if left.isEmpty():
            break
    return out


def predict_joined(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with lang_pred and score: words that are not
    broadcast get their evidence from the model's tables."""
    spark, langs = docs.sparkSession, model["langs"]
    folder = run_folder(spark, "langid-words")
    shared = spark.sparkContext.broadcast({x: model[x] for x in ("langs", "rows", "evidence")})
    others = [c for c in docs.columns if c != text_col]

    def scan(batches):
        rows, table = shared.value["rows"], shared.value["evidence"]
        for b in batches:
            sums, rest, times = [], [], []
            for t in b.column(b.num_columns - 1):
                words = LETTERS.findall((t.as_py() or "").lower())
                if not any(c.isalpha() for w in words for c in w):
                    sums.append(None)
                    rest.append([])
                    times.append([])
                    continue
                at = np.fromiter(map(rows.get, words, repeat(-1)), np.int64, len(words))
                total = np.zeros(table.shape[1])
                for i in range(0, len(at), 1000):
                    part = at[i:i + 1000]
                    total += table[part[part >= 0]].sum(0, dtype=np.float64)
                count = Counter(words[i] for i in np.flatnonzero(at < 0))
                sums.append(total.tolist())
                rest.append(list(count))
                times.append(list(count.values()))
            yield pa.record_batch([*b.columns[:-1], pa.array(sums, pa.list_(pa.float64())), pa.array(rest, pa.list_(pa.string())),
                                   pa.array(times, pa.list_(pa.int64()))], names=[*b.schema.names[:-1], "_e", "_words", "_times"])

    out = docs.select(*others).withColumn("_e", F.array(F.lit(0.0))).withColumn("_words", F.array(F.lit(""))).withColumn(
        "_times", F.array(F.lit(0).cast("long"))).schema
    for f in out:
        f.nullable = True
    scanned = stored(docs.select(*others, text_col).mapInArrow(scan, out).withColumn("_row", F.monotonically_increasing_id()),
                     f"{folder}/scanned")
    pairs = scanned.select("_row", F.explode(F.arrays_zip("_words", "_times")).alias("x")).select(
        "_row", F.col("x._words").alias("word"), F.col("x._times").alias("times"))
    asked = stored(pairs.groupBy("word").agg(F.count(F.lit(1)).alias("docs")), f"{folder}/asked")
    found = looked_up(asked, model["tables"], len(langs), folder)
    # fewer than BUSY words can be above this bound
    bound = (asked.agg(F.sum("docs")).first()[0] or 0) / BUSY
    busy, other = found.filter(F.col("docs") > bound).drop("docs"), found.filter(F.col("docs") <= bound).drop("docs")
    frequent = asked.filter(F.col("docs") > bound).select("word")
    joined = pairs.join(F.broadcast(busy), "word").unionByName(
        pairs.join(F.broadcast(frequent), "word", "left_anti").join(other, "word"))
    added = stored(joined.groupBy("_row").agg(*[F.sum(F.col("times") * F.col(f"e{i}")).alias(f"e{i}") for i in range(len(langs))]),
                   f"{folder}/added")
    for x in ("asked", "seen", *[f"{y}-{k}" for y in ("grams", "left") for k in LENGTHS]):
        remove(spark, f"{folder}/{x}")
    total = F.array(*[F.col("_e")[i] + F.coalesce(f"e{i}", F.lit(0.0)) for i in range(len(langs))])
    best = F.array_max("_total")
    place = F.array_position("_total", best).cast("int")
    score = 1 / F.aggregate("_total", F.lit(0.0), lambda a, x: a + F.exp(x - best))
    told = F.col("_e").isNotNull()
    return (scanned.drop("_words", "_times").join(added, "_row", "left").withColumn("_total", total)
            .select(*others, F.when(told, F.element_at(F.array(*map(F.lit, langs)), place)).otherwise("und").alias("lang_pred"),
                    F.when(told, score).otherwise(0.0).alias("score")))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             entries: int = MODEL_ENTRIES) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the labelled rows
    that are not held out."""
    model = train(docs.filter(~held_out(F.col(id_col))), text_col, lang_col, entries)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                       F.col(text_col).alias("text"))
    if model["whole"]:
        return predict(rows, model, keep_text=False)
    out = predict_joined(rows, model)
    remove(docs.sparkSession, model["folder"])
    return out


def identified(docs: DataFrame, min_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang", entries: int = MODEL_ENTRIES) -> DataFrame:
    """The documents whose language is told with ``min_score`` or more, with
    all their columns; the model learns as in ``identify``."""
    model = train(docs.filter(~held_out(F.col(id_col))), text_col, lang_col, entries)
    rows, names, back = set_aside(docs)
    good = (F.col("lang_pred") != "und") & (F.col("score") >= min_score)
    if model["whole"]:
        return back(predict(rows, model, names[text_col]).filter(good))
    # the language follows from the text alone; the id spreads equal texts
    key = F.concat(F.md5(F.coalesce(names[text_col], F.lit(""))), F.coalesce(F.col(names[id_col]).cast("string"), F.lit("")))
    told = predict_joined(rows.select(key.alias("_key"), names[text_col]), model, names[text_col]).filter(good)
    remove(docs.sparkSession, model["folder"])
    return back(rows.withColumn("_key", key).join(told.select("_key").distinct(), "_key", "left_semi"))


def query(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))
