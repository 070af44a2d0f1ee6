"""Events by the calendar; levels against all partitions."""

import datetime as dt
import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricelake.operators import events as ev
from pricelake.operators import reconcile as rec

D = [dt.date(2024, 1, d) for d in (2, 3, 4, 5, 8, 9, 10, 11, 12, 16)]  # a weekend and a holiday inside


def pairs(spark, series):
    """{ticker: [(date, primary, secondary)]} as compared pairs."""
    rows = [(t, d, a, b) for t, s in series.items() for d, a, b in s]
    m = spark.createDataFrame(rows, "ticker string, date date, primary_adj_close double, secondary_adj_close double")
    return rec.pairs(m.withColumn("_merge", F.lit("both")))


def days(spark):
    return spark.createDataFrame([(d,) for d in D * 2], "date date")


def series(flags):
    return [(d, 100.0, 110.0 if f == "x" else 100.0) for d, f in zip(D, flags) if f != " "]


@pytest.mark.parametrize("flags,gap,want", [
    ("xxxxxxxxxx", 1, [("constant", 0, 9, 10)]),
    ("xxx.......", 1, [("until", 0, 2, 3)]),
    ("........xx", 1, [("since", 8, 9, 2)]),
    ("..xxx..x..", 1, [("window", 2, 4, 3), ("window", 7, 7, 1)]),
    ("..xxx.x...", 2, [("window", 2, 6, 5)]),
    (".xx xx....", 1, [("window", 1, 2, 2), ("window", 4, 5, 2)]),  # not compared for a day
    (".xx xx....", 2, [("window", 1, 5, 5)]),
    ("  xx..    ", 1, [("until", 2, 3, 2)]),  # its compared days begin late
    ("..........", 1, []),
    ("   x      ", 1, [("constant", 3, 3, 1)])])
def test_islands(spark, flags, gap, want):
    e = ev.discrepancy_events(pairs(spark, {"A": series(flags), "B": series("." * 10)}), days(spark), gap).orderBy("event_no").collect()
    assert [(r.kind, D.index(r.start), D.index(r.end), r.days_spanned) for r in e] == want
    assert [r.event_no for r in e] == list(range(1, len(want) + 1))
    assert sum(r.days_flagged for r in e) == flags.count("x")


def test_two_events_are_not_one_window(spark):
    p = pairs(spark, {"A": series(".x......x.")})
    assert ev.discrepancy_events(p, days(spark)).count() == 2
    assert rec.by_ticker(p).first().first_flagged == D[1] and rec.by_ticker(p).first().last_flagged == D[8]


def test_shift_and_infinite_discrepancies(spark):
    s = [(D[0], 100.0, 100.0), (D[1], 100.0, 90.0), (D[2], 5.0, -5.0), (D[3], 100.0, 100.2), (D[4], None, 3.0)]
    e = ev.discrepancy_events(pairs(spark, {"A": s}), days(spark)).first()
    assert e.max_pct_diff == float("inf") and e.mean_diff == pytest.approx(10 / 95)
    assert e.mean_shift == pytest.approx(10 / 95 - (0 - 0.2 / 100.1) / 2)
    whole = ev.discrepancy_events(pairs(spark, {"A": s[1:2]}), days(spark)).first()
    assert whole.kind == "constant" and whole.mean_shift is None


def test_empty(spark):
    p = pairs(spark, {"A": series("xx")})
    assert ev.discrepancy_events(p.where("false"), days(spark)).count() == 0
    assert ev.discrepancy_events(p, days(spark).where("false")).count() == 0
    assert ev.segments(p.where("false")).count() == 0


def sse(x):
    return float(((x - x.mean()) ** 2).sum())


def brute(x, penalty):
    n = len(x)
    return min((sum(sse(x[i:j]) + penalty for i, j in zip((0, *c), (*c, n))), c)
               for k in range(n) for c in itertools.combinations(range(1, n), k))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-8, 8), min_size=1, max_size=9), st.sampled_from([0.3, 1.0, 4.0, 30.0]))
def test_partition_is_optimal(x, penalty):
    x = np.array(x, float)
    at = ev.partition(x, penalty)
    assert at[0] == 0 and at == sorted(set(at))
    cost = sum(sse(x[i:j]) + penalty for i, j in zip(at, [*at[1:], len(x)]))
    assert cost == pytest.approx(brute(x, penalty)[0], abs=1e-9)


def test_partition_of_a_long_history():
    r = np.random.default_rng(1)
    x = np.concatenate([r.normal(m, 0.001, n) for m, n in ((0, 900), (0.07, 400), (0.013, 1200), (0, 500))])
    assert ev.partition(x, 1e-4) == [0, 900, 1300, 2500]


def test_segments(spark):
    r = random.Random(2)
    s = {"A": [(d, 100.0, 107.0 if i < 4 else 100.0) for i, d in enumerate(D)], "B": [(d, 50.0, 50.0) for d in D],
         "C": [(d, 100.0, 100.0 * r.uniform(0.9999, 1.0001) * (1.02 if i == 5 else 1)) for i, d in enumerate(D)],
         "Z": [(D[0], 1.0, -1.0), (D[1], None, 1.0), (D[2], 3.0, 3.0)]}
    got = {}
    for x in ev.segments(pairs(spark, s)).orderBy("ticker", "segment_no").collect():
        got.setdefault(x.ticker, []).append((D.index(x.start), D.index(x.end), x.days, x.kind, None if x["shift"] is None else round(x["shift"], 4)))
    assert got["A"] == [(0, 3, 4, "offset", None), (4, 9, 6, "agreement", round(7 / 103.5, 4))]
    assert got["B"] == [(0, 9, 10, "agreement", None)]
    assert [g[:4] for g in got["C"]] == [(0, 4, 5, "agreement"), (5, 5, 1, "offset"), (6, 9, 4, "agreement")]
    assert got["Z"] == [(2, 2, 1, "agreement", None)]
