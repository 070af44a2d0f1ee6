"""Fingerprints of buckets against a full comparison of rows."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pricelake.operators import dims
from pricelake.operators import fingerprints as fp
from pricelake.plans import pipeline as pl
from pricelake.schemas import PRIMARY_BRONZE
from pricelake.sources import bronze
from pricelake.sources.gold import GoldStore

SCHEMA = "ticker string, date date, x double, y long"


def make(spark, rows):
    return fp.with_period(spark.createDataFrame(rows, SCHEMA)).select("ticker", "period", "date", "x", "y")


def brute(old, new):
    def buckets(rows):
        out = {}
        for t, d, x, y in rows:
            out.setdefault((t, d.replace(day=1) if d else None), Counter())[d, None if x != x else x, y] += 1
        return out

    a, b = buckets(old), buckets(new)
    return {k: "new" if k not in a else "gone" if k not in b else "same" if a[k] == b[k] else "changed" for k in {*a, *b}}


def test_against_all_rows(spark):
    r = random.Random(1)
    old = [(f"T{r.randrange(6)}", dt.date(2024, r.randint(1, 4), r.randint(1, 28)), r.choice([1.5, 2.5, None, 0.0]), r.choice([None, 1, 2])) for _ in range(300)]
    new = [(t, d, x if r.random() > 0.02 else 9.0, y) for t, d, x, y in old if r.random() > 0.02] + [("T9", dt.date(2024, 1, 1), 1.0, 1)]
    new = [row for row in new if row[0] != "T5"]
    r.shuffle(new)
    got = {(x.ticker, x.period): x.status for x in fp.changes(fp.fingerprints(make(spark, old)), fp.fingerprints(make(spark, new).repartition(7))).collect()}
    assert got == brute(old, new) and set(got.values()) == {"same", "changed", "new", "gone"}


@pytest.mark.parametrize("a, b, same", [
    ([(1.0, None)], [(None, 1)], False),           # a hash skips nulls
    ([(None, 1), (1.0, None)], [(None, None), (1.0, 1)], False),
    ([(0.0, 1)], [(-0.0, 1)], True),
    ([(float("nan"), 1)], [(None, 1)], True),       # silver reads both as NULL
    ([(1.0, 1)], [(1.0, 1), (1.0, 1)], False),      # repeated rows count
    ([(1.0, 1), (2.0, 2)], [(2.0, 2), (1.0, 1)], True),
    ([(1.0, 2), (2.0, 1)], [(1.0, 1), (2.0, 2)], False)])
def test_what_counts_as_a_change(spark, a, b, same):
    d = dt.date(2024, 1, 2)
    old, new = (make(spark, [("A", d, *v) for v in rows]) for rows in (a, b))
    assert (fp.changes(fp.fingerprints(old), fp.fingerprints(new)).first().status == "same") is same


def test_column_order_is_no_change(spark):
    df = make(spark, [("A", dt.date(2024, 1, 2), 1.0, 2)])
    assert fp.fingerprints(df).collect() == fp.fingerprints(df.select(*reversed(df.columns))).collect()


def bar(t, day, close):
    return (day, close, close, close, close, close, 1, 0.0, 0.0, t)


def test_a_run_builds_only_what_moved(spark, lake, monkeypatch):
    days = [dt.date(2024, m, d) for m in (1, 2, 3) for d in (2, 3, 4)]
    store = GoldStore(spark, f"{lake}/gold")
    store.upsert("dim_date", dims.build_dim_date(spark, days[0], days[-1], spark.createDataFrame([(d,) for d in days], "date date")))
    snap = spark.createDataFrame([(t, "n", "s", "i", None) for t in "AB"], "ticker string, company_name string, gics_sector string, "
                                 "gics_sub_industry string, figi string")
    store.upsert("dim_security", dims.apply_snapshot(dims.empty_dim(spark), snap, days[0])[0])

    def land(date, change=()):
        rows = [bar(t, d, 20.0 if (t, d) in change else 10.0) for t in "AB" for d in days]
        bronze.land(spark.createDataFrame(rows, PRIMARY_BRONZE), lake, "primary_prices", date)
        return {(r.ticker, r.period.month): r.status for r in pl.repull(spark, "primary", date, lake).collect()}

    assert set(land(dt.date(2024, 4, 1)).values()) == {"new"}
    first = set(store.read("fact_price_daily").inputFiles())
    assert set(land(dt.date(2024, 4, 2)).values()) == {"same"}
    assert set(store.read("fact_price_daily").inputFiles()) == first

    built = []
    whole = pl.facts.fact_price_daily
    monkeypatch.setattr(pl.facts, "fact_price_daily", lambda silver, *a: built.append(silver.count()) or whole(silver, *a))
    status = land(dt.date(2024, 4, 3), {("A", days[4])})
    assert status.pop(("A", 2)) == "changed" and set(status.values()) == {"same"}
    assert built == [3]  # one ticker's month out of 18 bars
    after = set(store.read("fact_price_daily").inputFiles())
    assert {f for f in first if "202402" not in f} == {f for f in after if "202402" not in f}
    f = store.read("fact_price_daily")
    assert f.count() == 18 and f.where("close = 20").count() == 1


def test_bucketed_vendors_join_without_exchange(spark, tmp_path):
    from pricelake.operators import reconcile as rec
    from pricelake.operators.silver import to_silver
    from pricelake.sources import bindings as bind
    from pricelake.sources import bucketed
    from tests.conftest import SF
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sides = {"primary": to_silver(bind.primary_bronze(spark, SF)), "secondary": to_silver(bind.secondary_bronze(spark, SF))}
        for k in range(2):  # replacing a table leaves no old rows
            for name, df in sides.items():
                bucketed.write_bucketed(df, f"t_{name}_b", str(tmp_path / name), 6)
        r = rec.Reconciliation(*(bucketed.read_bucketed(spark, f"t_{n}_b") for n in sides))
        plan = r.pairs()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        want = rec.Reconciliation(*sides.values()).pairs()
        assert sorted(map(tuple, r.pairs().collect())) == sorted(map(tuple, want.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("primary", "secondary"):
            spark.sql(f"DROP TABLE IF EXISTS t_{name}_b")
