"""Periodic runs against their definition, word by word."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricelake.llm import runs
from tests.llm.conftest import SCHEMA, prose, rows_of


def brute_runs(w, least=12):
    """Every (start, length, period) by trying all periods at all places."""
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 2 * q):
                x = w[i:i + length]
                if not any(x[p:] == x[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out)


def brute(doc_id, text):
    """The contract's row."""
    w = (text or "").encode().split()
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    return {"doc_id": doc_id, "n_runs": len(found), "start": best[0], "length": best[1], "period": best[2],
            "exponent_milli": None if best[0] is None else 1000 * best[1] // best[2],
            "runs_sha256": hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()}


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(2, 13))
def test_small_alphabets(w, least):
    assert runs.maximal_runs(np.array(w, np.int64), least) == brute_runs(w, least)


def test_repetitions_of_all_kinds():
    r = random.Random(3)
    for _ in range(300):
        w = []
        for _ in range(r.randint(1, 5)):
            w += [r.randrange(4) for _ in range(r.randint(1, 9))] * r.randint(1, 9)
            w += [r.randrange(50) for _ in range(r.randint(0, 6))]
        w = w * r.randint(1, 2)
        assert runs.maximal_runs(np.array(w, np.int64)) == brute_runs(w)


def test_fibonacci_word_and_long_powers():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    assert runs.maximal_runs(np.array(b, np.int64)) == brute_runs(b)
    assert runs.maximal_runs(np.zeros(50_000, np.int64)) == [(0, 50_000, 1)]
    period = list(range(700))
    assert runs.maximal_runs(np.array((period * 80)[:50_000], np.int64)) == [(0, 50_000, 700)]


def test_many_left_words_before_one_passage():
    """Occurrences of a passage far apart, each after a word of its own."""
    w = []
    for i in range(3000):
        w += [1000 + i, *range(12)]
    w += [5] * 40
    assert runs.maximal_runs(np.array(w, np.int64)) == [(len(w) - 40, 40, 1)]


def test_suffix_array():
    r = random.Random(2)
    for n in (1, 2, 7, 60):
        w = [r.randrange(2) for _ in range(n)]
        order, lcp = runs.suffix_array(np.array(w, np.int64))
        assert order.tolist() == sorted(range(n), key=lambda i: w[i:])
        for k in range(1, n):
            x, y = w[order[k - 1]:], w[order[k]:]
            assert lcp[k] == next((i for i, (s, t) in enumerate(zip(x, y)) if s != t), min(len(x), len(y)))


def periodic_rows():
    r = random.Random(9)
    rows = []
    for i in range(200, 330):
        words = prose(i, r.randint(0, 70), 30).split()
        if i % 3 == 0:
            words += words[:r.randint(1, 6)] * r.randint(2, 9)
        rows.append((i, " ".join(words), "en", "s0"))
    rows += [(400, "x " * 11, None, None), (401, "x\t" * 12, None, None), (402, "\x0b".join(["a b"] * 6), None, None),
             (403, "x  " * 12, None, None), (403, "y " * 13, None, None), (None, "z " * 14, None, None), (-7, "q r " * 8, None, None)]
    return rows


def test_query_against_the_definition(spark, nasty):
    from tests.llm.conftest import nasty_rows
    docs = spark.createDataFrame(periodic_rows(), SCHEMA).repartition(3)
    got = rows_of(runs.digests(runs.periodic_runs(runs.planted(docs))), "doc_id", "runs_sha256")
    want = sorted((brute(i, t) for i, t, _, _ in periodic_rows()),
                  key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["runs_sha256"]))
    assert got == want
    # nulls, empty and very long texts, repeated rows, clashing columns
    short = [(i, t) for i, t, _, _ in nasty_rows() if len(t or "") < 10_000]
    got = rows_of(runs.digests(runs.periodic_runs(runs.planted(nasty))), "doc_id", "collapsed_sha256")
    assert len(got) == len(nasty_rows())
    want = [brute(i, t) for i, t in short]
    for r in want:
        assert r in got


def test_general_operator(spark, empty):
    d = spark.createDataFrame([(1, "so a b a b a b a b a b a b end", "keep")], "k long, body string, runs string")
    r = runs.periodic_runs(d, "k", "body").first()
    assert [tuple(x) for x in r.runs] == [(1, 12, 2)] and r.collapsed == "so a b end"
    r = runs.periodic_runs(d, "k", "body", least=13).first()
    assert r.runs == [] and r.collapsed == "so a b a b a b a b a b a b end"
    assert runs.digests(runs.periodic_runs(runs.planted(empty))).count() == 0


@pytest.mark.parametrize("size", [10, 10 ** 9])
def test_chunks_of_texts(spark, monkeypatch, size):
    monkeypatch.setattr(runs, "TOGETHER", size)
    docs = spark.createDataFrame(periodic_rows(), SCHEMA).coalesce(1)
    assert runs.periodic_runs(docs).selectExpr("sum(size(runs))").first()[0] == sum(len(brute_runs((t or "").split())) if i != 403 else len(
        brute_runs(t.encode().split())) for i, t, _, _ in periodic_rows())
