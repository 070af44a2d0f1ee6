import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelake.llm import langid as L

from .conftest import nasty_rows, rows_of


def test_nasty_rows(nasty):
    got = rows_of(L.identify(nasty), "doc_id")
    assert len(got) == len(nasty_rows())
    text = {d: t for d, t, *_ in nasty_rows() if d is not None}
    for r in got:
        d = r["doc_id"]
        assert r["held_out"] == (zlib.crc32(str("" if d is None else d).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
        if d is not None:
            letters = any(c.isalpha() for c in text[d] or "")
            assert (r["lang_pred"] == "und") == (not letters) and (letters or r["score"] == 0)
    right = [r["lang_pred"] == ("en", "de")[r["doc_id"] % 2] for r in got if r["doc_id"] is not None and 1 < r["doc_id"] < 40]
    assert all(right)


def corpus(spark, n=400):
    r = random.Random(2)
    stems = {"aa": "kala mana tolu sima ruko".split(), "bb": "schtren gruff klomp zwirn pfalt".split(), "cc": "oeuvie eaux ligne sieur beauté".split()}
    rows = []
    for i in range(n):
        lang = "aabbcc"[2 * (i % 3):2 * (i % 3) + 2]
        words = [r.choice(stems[lang]) + r.choice(["", "", r.choice(stems[lang])]) for _ in range(12)]
        rows.append((i, " ".join(words).capitalize() + ".", lang if i % 11 else None, "s"))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_held_out_accuracy_and_no_leak(spark):
    rows, df = corpus(spark)
    a = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows_of(L.identify(df), "doc_id")}
    held = [d for d, *_ in rows if zlib.crc32(str(d).encode()) % 3 == 1]
    right = sum(a[d][0] == "aabbcc"[2 * (d % 3):2 * (d % 3) + 2] for d in held)
    assert right >= 0.98 * len(held)
    # labels and sources of held-out rows change nothing
    scrambled = df.withColumn("lang", F.when(L.held_out(F.col("doc_id")), F.lit("aa")).otherwise(F.col("lang"))).withColumn("source", F.lit("x"))
    assert a == {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows_of(L.identify(scrambled), "doc_id")}


def test_backoff_against_brute_force(spark):
    rows, df = corpus(spark, 60)
    model = L.train(df)
    counts = {}
    for _, t, lang, _ in rows:
        if lang:
            for w in L.LETTERS.findall(t.lower()):
                counts.setdefault(lang, {}).setdefault(w, 0)
                counts[lang][w] += 1
    grams = {}
    for lang, c in counts.items():
        for w, n in c.items():
            for k in L.LENGTHS:
                p = f" {w} "
                for i in range(len(p) - k + 1):
                    if p[i:i + k] != " ":
                        d = grams.setdefault((lang, k), {})
                        d[p[i:i + k]] = d.get(p[i:i + k], 0) + n

    def evidence(w):
        def log(table):
            return np.array([np.log((table(x).get(g, 0) + 0.5) / (1 + sum(table(x).values()))) for x in model["langs"]])
        g = w
        if any(w in counts[x] for x in model["langs"]):
            return log(lambda x: counts[x])
        for k in L.LENGTHS:
            p, out = f" {w} ", []
            for i in range(len(p) - k + 1):
                g = p[i:i + k]
                if any(g in grams[x, k] for x in model["langs"]):
                    out.append(log(lambda x: grams[x, k]))
            if out:
                return np.mean(out, 0)
        return np.zeros(len(model["langs"]))

    scorer = L.Scorer(model)
    for w in ("kala", "gruff", "kalagruff", "zz", "éz", "ß", "q", "mananan"):
        assert np.allclose(scorer.evidence([w]), evidence(w), atol=1e-4), w


def test_more_words_than_are_broadcast(spark):
    # the way of a word's evidence, by broadcast or by join, changes nothing
    _, df = corpus(spark, 120)
    odd = [(900, None, "aa", "s"), (901, "123", None, "s"), (902, "kalagruff qqq Ж ligneeaux", None, "s"), (None, "zirn " * 50 + "ЖЖ", None, "s")]
    df = df.unionByName(spark.createDataFrame(odd * 2, df.schema))
    want = rows_of(L.identify(df), "doc_id", "score")
    assert len(want) == 128
    got = rows_of(L.identify(df, entries=6), "doc_id", "score")
    assert [(r["doc_id"], r["held_out"], r["lang_pred"]) for r in got] == [(r["doc_id"], r["held_out"], r["lang_pred"]) for r in want]
    assert np.allclose([r["score"] for r in got], [r["score"] for r in want], rtol=1e-12, atol=0)
    whole, joined = (sorted(map(tuple, L.identified(df, 0.9, entries=n).collect()), key=str) for n in (L.MODEL_ENTRIES, 6))
    assert whole == joined and 0 < len(whole) < 128


def test_label_of_long_runs_only_is_learned(spark):
    rows = [(i, ("ab" * 30 if i % 2 else "xy" * 30) + "c" * i, "pp" if i % 2 else "qq", "s") for i in range(24)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = rows_of(L.identify(df), "doc_id")
    assert [r["lang_pred"] for r in got] == ["pp" if i % 2 else "qq" for i in range(24)]


def test_filter_and_empty(nasty, empty, spark):
    stay = L.identified(nasty)
    assert stay.columns == nasty.columns
    assert not {105, 106, 107, 104} & {r.doc_id for r in stay.select("doc_id").collect()}
    assert L.identify(empty).count() == 0
    unlabelled = spark.createDataFrame([(1, "some text", None, None)], empty.schema)
    assert [(r["lang_pred"], r["score"]) for r in rows_of(L.identify(unlabelled), "doc_id")] == [("und", 0.0)]


def test_full_cache_starts_again():
    model = {"langs": ["a", "b"], "rows": {"x": 0}, "evidence": np.array([[1.0, 2.0]], np.float32)}
    s = L.Scorer(model)
    s.table = s.table[:3]
    for i in range(5):
        assert s.evidence(["x", f"u{i}"]).tolist() == [1.0, 2.0]


@pytest.mark.parametrize("entries, kept", [(0, 0), (1, 1), (3, 3), (6, 3), (7, 7), (100, 7)])
def test_most_frequent_by_levels(spark, entries, kept):
    """Whole levels only: ties are all in or all out."""
    df = spark.createDataFrame([("a", 1000), ("b", 300), ("c", 300), ("d", 2), ("e", 2), ("f", 2), ("g", 2)], "word string, n long")
    got = L.most_frequent(df, entries).collect()
    assert len(got) == kept and {r.word for r in got} == set("abcdefg"[:kept])


def test_many_labels(spark):
    """A label per word: as many languages as labels are learned and told apart."""
    r = random.Random(1)
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(120)]
    rows = [(3 * i + j, f"{w} {w} {w}", f"l{i}") for i, w in enumerate(words) for j in range(3)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(d)
    got = {r.doc_id: r.lang_pred for r in L.predict(d, model).collect()}
    assert len(model["langs"]) == 120 and sum(got[i] == lang for i, _, lang in rows) > 350
