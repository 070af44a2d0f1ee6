"""Point-in-time resolution against a plain interval search."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pricelake.operators import asof, facts

DAY0 = dt.date(2024, 1, 1)


def day(n):
    return DAY0 + dt.timedelta(days=n)


def make(seed, keys, bars, hot=0):
    r = random.Random(seed)
    versions, k = [], 0
    for t in range(keys):
        at = r.randint(0, 20)
        while at < 60 and r.random() < 0.85:
            end = at + r.randint(1, 15)
            versions.append((f"T{t}", day(at), None if r.random() < 0.2 else day(end), k))
            k += 1
            if versions[-1][2] is None:
                break
            at = end + r.choice([0, 0, 0, 3])
    rows = [(f"T{r.randrange(keys + 3)}", day(r.randint(0, 80)), float(i)) for i in range(bars)]
    rows += [("T0", day(r.randint(0, 80)), float(-i)) for i in range(hot)]
    rows += [(None, day(3), 0.5), ("T1", None, 0.25), ("T0", day(3), 7.0), ("T0", day(3), 7.0)]
    return rows, versions


def brute(rows, versions):
    out = []
    for t, d, x in rows:
        begun = [v for v in versions if t is not None and d is not None and v[0] == t and v[1] <= d]
        v = max(begun, key=lambda v: v[1], default=None)
        status = "none" if v is None else "valid" if v[2] is None or d < v[2] else "expired"
        out.append((t, d, x, v[3] if status == "valid" else None, status))
    return sorted(out, key=repr)


def frames(spark, rows, versions):
    return (spark.createDataFrame(rows, "ticker string, date date, x double").repartition(3),
            spark.createDataFrame(versions, "ticker string, effective_from date, effective_to date, security_key int"))


def resolved(spark, rows, versions, n):
    b, v = frames(spark, rows, versions)
    return asof.as_of(b, v, "ticker", "date", "effective_from", "effective_to", ["security_key"], status="status", num_partitions=n)


@pytest.mark.parametrize("seed,partitions", [(1, 1), (2, 4), (3, 40)])
def test_against_interval_search(spark, seed, partitions):
    rows, versions = make(seed, 12, 400)
    got = sorted((tuple(x) for x in resolved(spark, rows, versions, partitions).collect()), key=repr)
    assert got == brute(rows, versions)


def test_hot_ticker_splits_and_versions_cross_edges(spark):
    rows, versions = make(5, 8, 300, hot=4000)
    b, v = frames(spark, rows, versions)
    ranged = asof._ranged(b, v, "ticker", "date", "effective_from", "effective_to", ["security_key"], 16).cache()
    assert ranged.where("_key = 'T0'").select("_pid").distinct().count() >= 8
    # all but the first of its partitions need a version from before the edge; there are never more edges than partitions
    assert 0 < asof.edges(ranged).count() <= 16
    got = sorted((tuple(x) for x in resolved(spark, rows, versions, 16).collect()), key=repr)
    assert got == brute(rows, versions)


def test_one_day_of_one_ticker_splits(spark):
    """All rows on one key and date still spread, and all find the version."""
    rows = [("A", day(5), float(i)) for i in range(3000)]
    b, v = frames(spark, rows, [("A", day(1), None, 9)])
    ranged = asof._ranged(b, v, "ticker", "date", "effective_from", "effective_to", ["security_key"], 8).cache()
    assert ranged.select("_pid").distinct().count() >= 6
    out = resolved(spark, rows, [("A", day(1), None, 9)], 8)
    assert out.where("security_key = 9").count() == 3000


def test_no_pairing_join_in_the_plan(spark):
    rows, versions = make(6, 5, 50)
    plan = resolved(spark, rows, versions, 4)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortMergeJoin" not in plan


def test_empty_sides(spark):
    rows, versions = make(7, 5, 30)
    assert all(x.security_key is None and x.status == "none" for x in resolved(spark, rows, [], 4).collect())
    assert resolved(spark, [], versions, 4).count() == 0


def test_clashing_column_names(spark):
    b = spark.createDataFrame([("A", day(2), "mine", 1)], "ticker string, date date, _own string, _pid int")
    v = spark.createDataFrame([("A", day(1), None, 9)], "ticker string, effective_from date, effective_to date, security_key int")
    r = asof.as_of(b, v, "ticker", "date", "effective_from", "effective_to", ["security_key"]).first()
    assert tuple(r) == ("A", day(2), "mine", 1, 9)


def test_fact_rows_and_counts(spark):
    cols = ["open", "high", "low", "close", "adj_open", "adj_high", "adj_low", "adj_close"]
    bars = [("A", 0), ("A", 2), ("A", 5), ("A", 9), ("B", 2), ("A", 99)]
    s = spark.createDataFrame([(t, day(n)) for t, n in bars], "ticker string, date date").select(
        "*", *[F.lit(1.5).alias(c) for c in cols], F.lit(1).alias("volume"), F.lit(1).alias("adj_volume"), F.lit("primary").alias("source"))
    dd = spark.createDataFrame([(day(n), n) for n in range(30)], "date date, date_key int")
    ds = spark.createDataFrame([("A", day(1), day(4), 1), ("A", day(4), day(8), 2)],
                               "ticker string, effective_from date, effective_to date, security_key int")
    rows, counts = facts.fact_price_daily_as_of(s, dd, ds)
    assert sorted((r.security_key, r.date_key) for r in rows.collect()) == [(1, 2), (2, 5)]
    assert {r.key_status: (r.bars, r.skipped_no_date_key, r.loaded) for r in counts.collect()} == {
        "not yet": (1, 0, 0), "valid": (2, 0, 2), "gone": (2, 1, 0), "unknown": (1, 0, 0)}
