"""Variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricelake.llm import variants as v
from pricelake.llm.common import run_folder
from tests.llm.conftest import SCHEMA, nasty_rows


def edits(w, letters="abc"):
    for i in range(len(w) + 1):
        for c in letters:
            yield w[:i] + c + w[i:], i, 1
        if i < len(w):
            yield w[:i] + w[i + 1:], i, -1
            for c in letters:
                yield w[:i] + c + w[i + 1:], i, 0


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(rows, errors=199):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % errors == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= 6}


def brute(words, ratio=5):
    """(word, form, root, n, n_near, form_n) by comparing all pairs."""
    forms, found = {}, {}
    for w, n in words.items():
        others = [x for x in words if near(w, x)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= ratio * n else None
        found[w] = len(others)

    def root(w):
        return w if forms[w] is None else root(forms[w])

    return sorted((w, forms[w], root(w), n, found[w], words.get(forms[w])) for w, n in words.items())


GRAMS = st.dictionaries(st.text("abc", min_size=2, max_size=4), st.integers(1, 9), max_size=25)


@settings(max_examples=600, deadline=None)
@given(GRAMS, st.text("abc", min_size=2, max_size=11))
def test_an_edit_affects_no_more_grams_than_stated(counts, w):
    g = v.Grams(counts)
    ends = g.ends(w)
    kept = g.kept(ends)
    bound = g.affected(w, ends, kept)
    mine = [(w[p:ends[p]], p) for p in kept]
    for x, i, shift in edits(w):
        other = g.ends(x)
        theirs = {(x[p:other[p]], p) for p in g.kept(other)}
        shared = sum(1 for gram, p in mine if (gram, p) in theirs or (gram, p + shift) in theirs)
        assert shared >= len(mine) - bound, (x, i, shift)
        # the lists that both words enter meet, or neither has a bound
        a, loose_a = g.lists(w)
        b, loose_b = g.lists(x) if len(x) >= 2 else ([], True)
        if x != w and not (loose_a and loose_b):
            assert any(gram == h and (q - p) * (1 if shift >= 0 else -1) in ((0, 1) if shift else (0,)) for gram, p in a for h, q in b), (x, a, b)


def many_words(seed, n):
    r = random.Random(seed)
    stems = ["".join(r.choice("abcdeilnorstéü") for _ in range(r.randint(6, 11))) for _ in range(n)]
    out = {}
    for s in stems:
        out[s] = r.choice([5, 6, 30, 200, 5000])
        for x in r.sample(sorted({e for e, _, _ in edits(s, "aen") if len(e) >= 6}), r.randint(0, 6)):
            out[x] = r.choice([5, 7, 31, 150])
            for y in r.sample(sorted({e for e, _, _ in edits(x, "st") if len(e) >= 6}), r.randint(0, 2)):
                out.setdefault(y, r.randint(5, 9))
    return out


@pytest.mark.parametrize("qmax,share", [(2, 2000), (3, 200), (4, 2000), (4, 20), (5, 10 ** 9)])
def test_all_pairs(spark, qmax, share):
    words = many_words(qmax, 150)
    words |= {"aaaaaa": 500, "aaaaaaa": 50, "aaaaaaaa": 9, "aabaaaa": 6, "x" * 300: 8, "x" * 299 + "y": 90}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = sorted((tuple(r) for r in v.spelling_variants(df, qmax=qmax, share=share).collect()), key=repr)
    assert got == sorted(brute(words), key=repr)


def test_words_without_a_bound_meet(spark, monkeypatch):
    """Every word listed only under its letters left out: the same pairs."""
    words = many_words(77, 60)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    monkeypatch.setattr(v.Grams, "lists", lambda self, w: ([], True))
    got = sorted((tuple(r) for r in v.spelling_variants(df).collect()), key=repr)
    assert got == sorted(brute(words), key=repr)


def test_counted_words(spark, nasty, empty):
    want = brute_words([(i, t) for i, t, _, _ in nasty_rows()])
    assert {r.word: r.n for r in v.count_words(nasty, errors=199).collect()} == want
    plain = {r.word: r.n for r in v.count_words(nasty).collect()}
    assert plain["a" * 20_000] == 1 and plain["changed"] == 1
    r = random.Random(4)
    rows = [(r.choice([None, -3, 7, 8, 10 ** 12]), " ".join(r.choice(["Straße", "GEWÄHLT", "naïvely", "x×y÷zzzzz", "ſpecial", "aßcdefg1hijklmn"])
             for _ in range(50)), None, None) for _ in range(120)]
    want = brute_words([(i, t) for i, t, _, _ in rows])
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.word: r.n for r in v.count_words(df, errors=199).collect()} == want
    assert v.spelling_variants(v.count_words(empty)).count() == 0


def test_counts_passed_on_often(spark, monkeypatch):
    words = many_words(5, 40)
    text = " ".join(w for w, n in words.items() for _ in range(min(n, 7)))
    df = spark.createDataFrame([(i, text, None, None) for i in range(6)], SCHEMA).coalesce(1)
    want = brute_words([(i, text) for i in range(6)])
    monkeypatch.setattr(v, "HELD", 10)
    counted = v.count_words(df, errors=199)
    assert {r.word: r.n for r in counted.collect()} == want
    got = v.spelling_variants(counted.where(F.col("n") >= 5)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute({w: n for w, n in want.items() if n >= 5}), key=repr)


def test_dictionary_is_bounded(spark):
    words = spark.createDataFrame(list(many_words(1, 200).items()), "word string, n long")
    full = {r.gram: r.n for r in v.count_grams(words).collect()}
    positions = sum(n for g, n in full.items() if len(g) == 2)
    d = v.gram_dictionary(words, run_folder(spark, "variants-test"), share=100)
    assert {g for g in d if len(g) == 2} == {g for g in full if len(g) == 2}
    assert {g for g in d if len(g) > 2} == {g for g in full if len(g) > 2 and full[g[:-1]] * 100 > positions}
    assert len([g for g in d if len(g) == 3]) <= 90 * 100


def test_long_chains_of_forms(spark):
    chain = spark.createDataFrame([(f"w{i:03}", f"w{i + 1:03}") for i in range(37)], "word string, form string")
    assert {r.root for r in v.roots(chain, run_folder(spark, "variants-test")).collect()} == {"w037"}


def test_edits_at_the_ends(spark):
    words = {w: 10 * i + 5 for i, w in enumerate(["abcdef", "xabcdef", "abcdefx", "xbcdef", "abcdex", "bcdef", "abcde", "a", "b", "ab", "cb", "ac", ""])}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = sorted((tuple(r) for r in v.spelling_variants(df).collect()), key=repr)
    assert got == sorted(brute(words), key=repr)
