import random
import re

import numpy as np
import pytest

from pricelake.llm import decontaminate as D
from pricelake.llm.fmindex import FMIndex, suffix_array

from .conftest import nasty_rows, prose, rows_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, window=13):
    out = []
    cut = []
    for name, t in items:
        w = words(t)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            cut.append((name, w[i:i + window]))
    for d, t, *_ in docs:
        w = words(t)
        hit, found = set(), set()
        for name, p in cut:
            for i in range(len(w) - len(p) + 1):
                if w[i] == p[0] and w[i:i + len(p)] == p:
                    hit.update(range(i, i + len(p)))
                    if name is not None:
                        found.add(str(name))
        out.append((d, len(w), len(hit), tuple(sorted(found)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def judged(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in rows_of(df, "doc_id")), key=str)


def planted():
    items = [(1, prose(50, 30)), (2, prose(51, 13)), (3, "Short item, FIVE words: é!"), (4, None), (5, "  ..."), (None, prose(52, 20)),
             (6, prose(50, 30)), (2, prose(53, 15)), (7, "w1")]
    text = dict(items)
    docs = nasty_rows()
    docs += [(200, "x " * 30 + items[0][1].upper() + " y" * 30, "en", "s"), (201, prose(60, 400) + " " + text[2], "en", "s"),
             (202, " ".join(items[0][1].split()[3:16]), "en", "s"), (203, " ".join(items[0][1].split()[3:15]), "en", "s"),
             (204, "a short ITEM five?words é b " * 3, "en", "s"), (205, items[5][1] + ". " + items[5][1], "en", "s"),
             (206, items[0][1].replace(" ", "-!-") + " " + items[7][1], "en", "s")]
    return docs, items


@pytest.mark.parametrize("block_words,symbols", [(10**6, 400_000), (20, 400_000), (10**6, 50)])
def test_against_brute_force(spark, nasty, monkeypatch, block_words, symbols):
    docs, items = planted()
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(D, "SHARD_SYMBOLS", symbols)
    assert judged(D.contamination(df, bench, block_words=block_words)) == brute(docs, items)


def test_clean_documents_stay_whole(spark, nasty):
    docs, items = planted()
    items = items[:-1]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    from pyspark.sql import functions as F
    df = df.withColumn("spans", F.lit(1)).withColumn("n_words", F.lit("x"))
    stay = D.decontaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    assert stay.columns == df.columns
    bad = {x[0] for x in brute(docs, items) if x[4]}
    want = sorted(((d, t) for d, t, *_ in docs if d not in bad), key=str)
    assert bad and sorted(((r.doc_id, r.text) for r in stay.collect()), key=str) == want


def test_empty_tables(spark, nasty, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert judged(D.contamination(nasty, bench)) == brute(nasty_rows(), [])
    full = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert D.contamination(empty, full).count() == 0


def test_suffix_array_and_search():
    r = random.Random(8)
    for n, k in ((1, 1), (2, 1), (50, 1), (300, 2), (400, 5), (200, 60)):
        text = np.array([r.randrange(k + 1) for _ in range(n - 1)] + [0], np.int64)
        s = [tuple(text[i:]) for i in range(n)]
        assert suffix_array(text).tolist() == sorted(range(n), key=lambda i: s[i])
        index = FMIndex(text, k)
        for m in (1, 2, 3):
            phrases = np.array([[r.randrange(1, k + 1) for _ in range(m)] for _ in range(20)], np.int64)
            lo, hi = index.search(phrases)
            for p, a, b in zip(phrases, lo, hi):
                want = [i for i in range(n - m + 1) if (text[i:i + m] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want


@pytest.mark.parametrize("documents, size", [(50_000, 1), (50_000, 30_000), (2, 64 << 20), (1, 1)])
def test_shards_close_by_bytes_and_documents(spark, monkeypatch, documents, size):
    """Clean long texts count too: what is held is bounded whatever they say."""
    from pricelake.llm.common import bounded_batches
    docs, items = planted()
    docs = docs + [(300 + i, "clean" * 2000, "en", "s") for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").coalesce(1)
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(D, "SHARD_DOCUMENTS", documents)
    monkeypatch.setattr(D, "SHARD_BYTES", size)
    bounded_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert judged(D.contamination(df, bench)) == brute(docs, items)
        assert D.decontaminated(df, bench).where("doc_id >= 300 AND length(text) = 10000").count() == 20
    finally:
        bounded_batches(spark)
