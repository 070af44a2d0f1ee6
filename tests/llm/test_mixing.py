import re

import pytest
from pyspark.sql import functions as F

from pricelake.llm import mixing as M

from .conftest import nasty_rows, rows_of


def filled(sizes, weights=(3, 1, 2), share=1.5, limit=2):
    """Resharing round by round, as the contract words it."""
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, open_ = share * sum(sizes.values()), dict.fromkeys(names, 0.0), list(names)
    while open_ and left > 1e-9:
        unit = left / sum(w[s] for s in open_)
        for s in open_:
            target[s] += unit * w[s]
        left = sum(max(0.0, target[s] - limit * sizes[s]) for s in open_)
        over = [s for s in open_ if target[s] >= limit * sizes[s]]
        for s in over:
            target[s] = float(limit * sizes[s])
        open_ = [s for s in open_ if s not in over]
    return target


def size_of(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def test_targets_and_takes(nasty):
    rows = nasty_rows()
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + size_of(t)
    target = filled(sizes)
    got = rows_of(M.plan_mixture(nasty), "doc_id", "size")
    assert len(got) == len(rows)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"] and len(r["positions"]) == r["copies"]
        assert all(0 <= p <= 1 for p in r["positions"]) and r["positions"] == sorted(r["positions"])
        taken[r["source"]] += r["taken"]
    largest = {s: max(size_of(t) for _, t, _, x in rows if x == s) for s in sizes}
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s]
    assert sorted(r["size"] for r in got) == sorted(size_of(t) for _, t, *_ in rows)


def test_stream_has_every_copy_in_order(nasty):
    plan = rows_of(M.plan_mixture(nasty), "doc_id", "size")
    stream = M.mixed(nasty)
    assert stream.columns == nasty.columns
    want = {}
    for r in plan:
        want[(r["doc_id"], r["size"])] = want.get((r["doc_id"], r["size"]), 0) + r["copies"]
    got = {}
    for r in stream.select("doc_id", "text").collect():
        k = (r.doc_id, size_of(r.text))
        got[k] = got.get(k, 0) + 1
    assert got == {k: n for k, n in want.items() if n}


def test_reruns_agree_whatever_the_layout(nasty):
    a = rows_of(M.plan_mixture(nasty), "doc_id", "size")
    b = rows_of(M.plan_mixture(nasty.repartition(9, "text")), "doc_id", "size")
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"], str(r["positions"]))
    assert sorted(a, key=key) == sorted(b, key=key)


def test_schedules_invert(spark):
    for knots in M.SCHEDULES:
        ts = [i / 20 for i in range(21)]
        share = []
        for t in ts:
            x = 0.0
            for t0, w0, slope, lo, _ in M.segments(knots):
                if t >= t0:
                    x = lo + w0 * (t - t0) + slope * (t - t0) ** 2 / 2
            share.append(x)
        df = spark.createDataFrame(list(zip(share, ts)), "u double, t double")
        assert df.select(F.max(F.abs(M.inverse(F.col("u"), knots) - F.col("t")))).first()[0] < 1e-9


def test_empty_and_wordless(spark, empty):
    assert M.plan_mixture(empty).count() == 0
    d = spark.createDataFrame([(1, None, None, None), (2, " ", "en", "a")], empty.schema)
    assert [(r["taken"], r["target"]) for r in rows_of(M.plan_mixture(d), "doc_id")] == [(0, 0.0), (0, 0.0)]
    assert M.mixed(empty).count() == 0


def test_a_row_that_the_table_repeats_many_times(spark):
    """Equal rows are documents of their own: each is laid out as often as the plan takes it."""
    rows = [(7, "one two three", "en", "s0")] * 1500 + [(i, "four five", "en", "s1") for i in range(100, 400)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(6)
    taken = M.plan_mixture(d).groupBy("doc_id").agg({"copies": "sum"}).collect()
    out = {r.doc_id: r["count"] for r in M.mixed(d).groupBy("doc_id").count().collect()}
    assert out == {r.doc_id: r["sum(copies)"] for r in taken if r["sum(copies)"]}
