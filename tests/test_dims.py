import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricelake.operators import dims
from pricelake.session import cut_lineage

S1, S2, S3 = dt.date(2026, 1, 1), dt.date(2026, 3, 1), dt.date(2026, 4, 1)


def snap(spark, rows):
    return spark.createDataFrame(rows, "ticker string, company_name string, gics_sector string, "
                                       "gics_sub_industry string")


def ids(spark, rows):
    return spark.createDataFrame(rows, "ticker string, figi string")


def apply(spark, dim, rows, d, figis=()):
    s = dims.prepare_snapshot(snap(spark, rows), ids(spark, list(figis)))
    new, actions = dims.apply_snapshot(dim, s, d)
    counts = {r.action: r["count"] for r in actions.groupBy("action").count().collect()}
    return cut_lineage(new), counts


def test_scd2_transitions(spark):
    d0 = dims.empty_dim(spark)
    d1, c1 = apply(spark, d0, [("AAPL", "Apple", "IT", "HW"), ("MSFT", "Microsoft", "IT", "SW")], S1,
                   [("AAPL", "BBG000B9XRY4")])
    assert c1 == {"new": 2}
    assert d1.where("ticker = 'MSFT'").first().figi is None           # no identifier match: still loaded
    d2, c2 = apply(spark, d1, [("AAPL", "Apple", "IT", "HW"), ("MSFT", "Microsoft", "IT", "SW")], S1,
                   [("AAPL", "BBG000B9XRY4")])
    assert c2 == {"unchanged": 2}
    d3, c3 = apply(spark, d2, [("AAPL", "Apple", "Tech", "HW"), ("MSFT", "Microsoft", "IT", "SW")], S2,
                   [("AAPL", "BBG000B9XRY4")])
    assert c3 == {"changed": 1, "unchanged": 1}
    aapl = sorted(d3.where("ticker = 'AAPL'").collect(), key=lambda r: r.effective_from)
    assert (aapl[0].effective_from, aapl[0].effective_to, aapl[0].is_current) == (S1, S2, False)
    assert (aapl[1].effective_from, aapl[1].effective_to, aapl[1].is_current) == (S2, None, True)
    d4, c4 = apply(spark, d3, [("AAPL", "Apple", "Tech", "HW")], S3, [("AAPL", "BBG000B9XRY4")])
    assert c4 == {"closed": 1, "unchanged": 1}
    inv = {r.check_name: r.violations for r in dims.scd2_invariants(d4).collect()}
    assert all(v == 0 for v in inv.values())
    keys = [r.security_key for r in d4.orderBy("security_key").collect()]
    assert keys == [1, 2, 3]


def test_second_change_same_day_is_rejected(spark):
    d1, _ = apply(spark, dims.empty_dim(spark), [("A", "a", "x", None)], S1)
    with pytest.raises(Exception, match="same snapshot date"):
        apply(spark, d1, [("A", "a", "y", None)], S1)[0].collect()


def test_invariant_check_catches_two_current_rows(spark):
    d1, _ = apply(spark, dims.empty_dim(spark), [("A", "a", "x", None)], S1)
    broken = d1.unionByName(d1.withColumn("security_key", F.lit(9)).withColumn("effective_from", F.lit(S2)))
    inv = {r.check_name: r.violations for r in dims.scd2_invariants(broken).collect()}
    assert inv["one current row per ticker"] == 1


def test_bulk_history_equals_repeated_incremental(spark):
    from tests.conftest import SF
    from pricelake.plans.catalogue import SCD_ATTRS, scd_snapshots
    snaps = scd_snapshots(spark, SF).cache()
    bulk = dims.build_scd2_bulk(snaps, SCD_ATTRS)
    dim = dims.empty_dim(spark)
    for d in sorted(r.snapshot_date for r in snaps.select("snapshot_date").distinct().collect()):
        dim, _ = dims.apply_snapshot(dim, snaps.where(F.col("snapshot_date") == F.lit(d)).drop("snapshot_date"),
                                     d, SCD_ATTRS)
        dim = cut_lineage(dim)   # as if re-read from the gold store between runs
    cols = ["security_key", "ticker", *SCD_ATTRS, "effective_from", "effective_to", "is_current"]
    assert sorted(bulk.select(cols).collect()) == sorted(dim.select(cols).collect())


def test_dim_date_calendar_and_trading_flag(spark):
    td = spark.createDataFrame([(dt.date(2024, 1, 2),), (dt.date(2024, 1, 3),)], "date date")
    rows = {r.date: r for r in dims.build_dim_date(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 7), td).collect()}
    assert len(rows) == 7
    mon = rows[dt.date(2024, 1, 1)]
    assert (mon.date_key, mon.day_of_week, mon.day_name, mon.month_name, mon.quarter) == (20240101, 0, "Monday", "January", 1)
    assert rows[dt.date(2024, 1, 7)].is_weekday is False
    assert [d for d, r in sorted(rows.items()) if r.is_trading_day] == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]


def test_dim_date_refresh_only_updates_trading_flag(spark):
    a = spark.createDataFrame([(dt.date(2024, 1, 2),), (dt.date(2024, 1, 3),)], "date date")
    b = spark.createDataFrame([(dt.date(2024, 1, 3),)], "date date")
    first = dims.build_dim_date(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 7), a)
    second = dims.build_dim_date(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 8), b)
    narrowed = {r.date: r.is_trading_day for r in dims.refresh_dim_date(first, second).collect()}
    assert len(narrowed) == 8 and narrowed[dt.date(2024, 1, 2)] is False
    kept = {r.date: r.is_trading_day for r in dims.refresh_dim_date(first, second, monotone=True).collect()}
    assert kept[dt.date(2024, 1, 2)] is True


def test_action_counts_report_zero_actions(spark):
    d0 = dims.empty_dim(spark)
    s = dims.prepare_snapshot(snap(spark, [("AAPL", "Apple", "IT", "HW")]), ids(spark, []))
    _, actions = dims.apply_snapshot(d0, s, S1)
    row = dims.action_counts(actions).first()
    assert (row.new, row.changed, row.closed, row.unchanged) == (1, 0, 0, 0)
