"""Streams with state per bar: the same counts however landings are split."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricelake.operators import dims
from pricelake.operators import reconcile as rec
from pricelake.operators.silver import to_silver
from pricelake.schemas import SECONDARY_BRONZE
from pricelake.sources import bindings as bind
from pricelake.sources import bronze
from pricelake.sources.gold import GoldStore
from pricelake.streaming import keyed
from pricelake.streaming.bronze_stream import run_price_stream, stream_folder
from tests.conftest import SF

D = dt.date(2024, 2, 1)
BAR = "date date, open double, high double, low double, close double, adj_close double, volume long, dividends double, stock_splits double, ticker string"


def bars(spark, keys, close=10.0):
    return spark.createDataFrame([(dt.date(2024, 1, d), 10.0, 10.0, 10.0, close, close, 1, 0.0, 0.0, t) for t, d in keys], BAR)


LANDINGS = [(D, 0, [("A", 2), ("A", 3), ("B", 2), ("A", 2)]), (D, 1, [("A", 2), ("C", 9)]),
            (D + dt.timedelta(1), 0, [("B", 2), ("B", 2), ("A", 3), ("D", 4)]), (D + dt.timedelta(2), 0, [("A", 2)])]


def expected():
    keys = [k for *_, ks in LANDINGS for k in ks]
    return {t: (sum(k[0] == t for k in keys), len({k for k in keys if k[0] == t})) for t in "ABCD"}


def counts(spark, lake):
    return {r.ticker: (r.landed, r.kept) for r in keyed.superseded_counts(spark, "primary", lake).collect()}


@pytest.mark.parametrize("files, restarts", [(1, False), (None, False), (2, True), (None, True)])
def test_superseded_whatever_the_split(spark, lake, files, restarts):
    for i, (d, b, keys) in enumerate(LANDINGS):
        bronze.land(bars(spark, keys).repartition(2), lake, "primary_prices", d, batch=b)
        if restarts:
            keyed.run_superseded_stream(spark, "primary", lake, max_files=files)
    keyed.run_superseded_stream(spark, "primary", lake, max_files=files)
    assert counts(spark, lake) == expected()
    total = keyed.superseded_counts(spark, "primary", lake).agg(F.sum("superseded")).first()[0]
    assert total == sum(n - k for n, k in expected().values())
    # nothing new: nothing counted again
    keyed.run_superseded_stream(spark, "primary", lake, max_files=files)
    assert counts(spark, lake) == expected()


def test_an_older_landing_that_comes_late(spark, lake):
    bronze.land(bars(spark, [("A", 2)]), lake, "primary_prices", D + dt.timedelta(1))
    keyed.run_superseded_stream(spark, "primary", lake)
    bronze.land(bars(spark, [("A", 2), ("B", 2)]), lake, "primary_prices", D)
    keyed.run_superseded_stream(spark, "primary", lake)
    got = {r.ticker: (r.landed, r.superseded, r.late) for r in keyed.superseded_counts(spark, "primary", lake).collect()}
    assert got == {"A": (2, 1, 1), "B": (1, 0, 0)}


def test_state_expires(spark, lake):
    def land(day, keys):
        bronze.land(bars(spark, keys), lake, "primary_prices", D + dt.timedelta(day))
        keyed.run_superseded_stream(spark, "primary", lake, keep_days=5)

    land(0, [("A", 2), ("B", 2)])
    land(3, [("B", 2)])
    land(20, [("C", 2)])  # the watermark passes A and B
    land(21, [("C", 3)])
    land(22, [("A", 2), ("C", 2)])
    got = {r.ticker: (r.landed, r.superseded) for r in keyed.superseded_counts(spark, "primary", lake).collect()}
    assert got == {"A": (2, 0), "B": (2, 1), "C": (3, 1)}


def test_bars_of_one_bucket_share_a_row_of_state(spark, lake, monkeypatch):
    monkeypatch.setattr(keyed, "BUCKETS", 2)
    keys = [(t, d) for t in "ABCD" for d in range(1, 11)]
    bronze.land(bars(spark, keys), lake, "primary_prices", D)
    bronze.land(bars(spark, keys[::3]), lake, "primary_prices", D, batch=1)
    q = keyed.run_superseded_stream(spark, "primary", lake)
    assert 1 <= max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) <= 2
    assert counts(spark, lake) == {t: (10 + sum(k[0] == t for k in keys[::3]), 10) for t in "ABCD"}


def test_a_bar_expires_alone_in_its_bucket(spark, lake, monkeypatch):
    monkeypatch.setattr(keyed, "BUCKETS", 1)

    def land(day, keys):
        bronze.land(bars(spark, keys), lake, "primary_prices", D + dt.timedelta(day))
        keyed.run_superseded_stream(spark, "primary", lake, keep_days=5)

    land(0, [("A", 2), ("B", 2)])
    land(3, [("B", 2), ("A", 3)])
    land(13, [("C", 2)])
    land(14, [("C", 2)])  # the watermark has passed every bar of A and B but not C's
    land(15, [("A", 2), ("A", 3), ("B", 2), ("C", 2)])
    got = {r.ticker: (r.landed, r.superseded, r.late) for r in keyed.superseded_counts(spark, "primary", lake).collect()}
    assert got == {"A": (4, 0, 0), "B": (3, 1, 0), "C": (3, 2, 0)}


def test_rows_that_break_a_rule_supersede_nothing(spark, lake):
    bronze.land(bars(spark, [("A", 2)]), lake, "primary_prices", D)
    bronze.land(bars(spark, [("A", 2)], close=0.0).unionByName(bars(spark, [(None, 2)])), lake, "primary_prices", D, batch=1)
    keyed.run_superseded_stream(spark, "primary", lake)
    assert counts(spark, lake) == {"A": (1, 1)}


def test_stream_join_equals_batch(spark, lake):
    p, s = bind.primary_bronze(spark, SF).cache(), bind.secondary_bronze(spark, SF).cache()
    for source, b in (("primary", p), ("secondary", s)):
        bronze.land(b, lake, f"{source}_prices", D)
    keyed.run_reconciled_stream(spark, lake, delay="60 days")
    want = rec.Reconciliation(to_silver(p), to_silver(s))
    cols = ["ticker", "date", "primary_adj_close", "secondary_adj_close", "pct_diff", "flagged"]

    def rows(df):
        return sorted(map(tuple, df.select(cols).collect()), key=repr)

    assert rows(keyed.stream_pairs(spark, lake)) == rows(want.pairs())
    # single bars wait until both streams have passed their day
    assert keyed.reconciled(spark, lake).where("_merge <> 'both'").count() == 0
    for source in ("primary", "secondary"):
        keyed.heartbeat(spark, lake, source, D + dt.timedelta(1), dt.date(2025, 1, 1))
    keyed.run_reconciled_stream(spark, lake, delay="60 days")
    out = keyed.reconciled(spark, lake)
    assert sorted(map(tuple, out.select("ticker", "date", "_merge").collect())) == sorted(
        map(tuple, want.matched.select("ticker", "date", "_merge").collect()))
    assert rows(keyed.stream_pairs(spark, lake)) == rows(want.pairs())


def test_repeats_in_the_join_count_once(spark, lake):
    one = bars(spark, [("A", 2), ("A", 2)])
    bronze.land(one, lake, "primary_prices", D)
    s = bind.secondary_bronze(spark, SF)
    two = one.select(*[F.col(f.name) if f.name in one.columns else F.lit(10).cast(f.dataType).alias(f.name) for f in SECONDARY_BRONZE.fields])
    bronze.land(two.select(*s.columns), lake, "secondary_prices", D)
    keyed.run_reconciled_stream(spark, lake)
    assert keyed.stream_pairs(spark, lake).count() == 1


# ---- what a declared schema hides -------------------------------------------

def dimensions(spark):
    b = bind.primary_bronze(spark, SF)
    dd = dims.build_dim_date(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 31), dims.trading_days(b))
    ds, _ = dims.apply_snapshot(dims.empty_dim(spark), dims.prepare_snapshot(bind.constituents(spark, SF), None), bind.INGEST_DATE)
    return dd.cache(), ds.cache()


@pytest.mark.parametrize("told", [True, False])
def test_drift_fails_the_stream(spark, lake, told):
    dd, ds = dimensions(spark)
    bronze.land(bind.primary_bronze(spark, SF).drop("adj_close"), lake, "primary_prices", D)
    if not told:  # another writer, who leaves no list of columns
        from pricelake.sources import fs
        fs.delete(spark, f"{bronze.batch_path(lake, 'bronze', 'primary_prices', D, 0)}/{bronze.COLUMNS}")
    with pytest.raises(Exception, match="adj_close"):
        run_price_stream(spark, "primary", dd, ds, root=lake)


def test_old_landings_derive_adjusted_prices_in_the_stream(spark, lake):
    dd, ds = dimensions(spark)
    old = bind.secondary_bronze(spark, SF, native_adjusted=False).where("day(date) < 10")
    bronze.land(old, lake, "secondary_prices", D, batch=0)
    bronze.land(bind.secondary_bronze(spark, SF).where("day(date) >= 10"), lake, "secondary_prices", D, batch=1)
    run_price_stream(spark, "secondary", dd, ds, root=lake, schema=SECONDARY_BRONZE)
    facts = GoldStore(spark, f"{lake}/gold").read("fact_price_daily")
    both = facts.groupBy(F.col("date_key") % 100 < 10).agg(
        F.count_if(F.col("adj_open").isNull() | F.col("adj_volume").isNull()).alias("nulls"),
        F.avg(F.col("adj_volume") / F.col("volume")).alias("scale")).collect()
    assert {r[0]: (r.nulls, r.scale) for r in both} == {True: (0, 1.0), False: (0, 2.0)}
    assert spark.read.parquet(stream_folder(lake, "rejects", "secondary")).count() >= 0
