"""Exact quantiles against sorting."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelake.operators import quantiles as qt

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def frame(spark, groups):
    return spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, x double").repartition(5)


def check(spark, groups, buckets, few):
    got = {(r.g, r.p): (r.quantile, r.n) for r in qt.exact_quantiles(frame(spark, groups), "x", PROBS, ["g"], buckets, few).collect()}
    want = {}
    for g, vs in groups.items():
        v = sorted(x for x in vs if x is not None and not math.isnan(x))
        for p in PROBS if v else ():
            at = p * (len(v) - 1)
            a, b, step = v[math.floor(at)], v[math.ceil(at)], at - math.floor(at)
            want[g, p] = (a if step == 0 or a == b else a + (b - a) * step, len(v))
    assert got.keys() == want.keys()
    for k, (q, n) in want.items():
        assert got[k][1] == n and (got[k][0] == q or got[k][0] == pytest.approx(q, rel=1e-14, abs=0) or math.isnan(q) and math.isnan(got[k][0])), (k, got[k], q)


@pytest.mark.parametrize("buckets, few", [(64, 40), (1024, 2), (1024, 10_000)])
def test_groups_of_all_kinds(spark, buckets, few):
    r = random.Random(buckets)
    check(spark, {
        "one": [4.0], "two": [1.0, 2.0], "equal": [0.1] * 50, "nulls": [None, 3.0, float("nan"), None, 5.0], "none": [None, float("nan")],
        "ties": [r.choice([0.0, -0.0, 1.5, 1.5000000000000002, 2.0]) for _ in range(101)],
        "wide": [-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324, 1.0], "infinite": [float("inf"), 1.0, 2.0, float("-inf"), float("inf")],
        "skewed": [math.exp(r.gauss(0, 8)) for _ in range(200)], "negative": [-r.random() for _ in range(77)]}, buckets, few)


def test_one_group_of_many_rows_moves_ranges_not_values(spark):
    df = spark.range(0, 400_000, 1, 16).select(F.lit("hot").alias("g"), F.sin(F.col("id") * 12.9898).alias("x"))
    got = {r.p: r.quantile for r in qt.exact_quantiles(df, "x", PROBS, ["g"], few=100).collect()}
    v = np.sin(np.arange(400_000) * 12.9898)
    for p in PROBS:
        assert got[p] == pytest.approx(np.quantile(v, p), rel=1e-12, abs=1e-12)


def test_empty(spark):
    assert qt.exact_quantiles(frame(spark, {"a": [1.0]}).where("false"), "x", [0.5], ["g"]).count() == 0
