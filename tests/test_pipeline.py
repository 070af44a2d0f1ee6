"""End to end on disk: land bronze, gate it, build gold twice (idempotent)."""

import datetime as dt

from pyspark.sql import functions as F

from pricelake.operators import quality
from pricelake.plans import pipeline as pl
from pricelake.sources import bindings as bind
from pricelake.sources import bronze
from pricelake.sources.gold import GoldStore
from tests.conftest import SF

D = bind.INGEST_DATE


def land_all(spark, root):
    bronze.land(bind.constituents(spark, SF), root, "constituents", D)
    bronze.land(bind.primary_bronze(spark, SF), root, "primary_prices", D)
    bronze.land(bind.secondary_bronze(spark, SF), root, "secondary_prices", D)
    bronze.land(bind.macro(spark, SF), root, "macro_series", D)
    bronze.land(bind.identifiers(spark, SF), root, "identifier_map", D)


def test_daily_run_end_to_end(spark, lake):
    land_all(spark, lake)
    report, verdict = pl.gate_bronze(spark, D, lake, constituents_band=(100, 200))
    per = {r.source: r for r in quality.rollup(report).collect()}
    assert set(per) >= {"constituents", "primary", "secondary", "identifiers"}
    assert per["constituents"].passed and per["identifiers"].passed
    assert not per["primary"].passed          # the seeded bad print breaks the 99.99 % OHLC rule
    v = verdict.first()
    assert v.sources_checked == len(per) and v.passed is False

    summary = {r.table: r for r in pl.build_gold(spark, D, dt.date(2024, 1, 1), lake).collect()}
    assert summary["fact_price_daily:primary"].loaded == 385
    assert summary["fact_price_daily_consensus"].loaded == 391
    store = GoldStore(spark, f"{lake}/gold")
    counts = {t: store.read(t).count() for t in ["dim_date", "dim_security", "fact_price_daily",
                                                "fact_price_daily_consensus", "fact_corporate_action",
                                                "fact_macro_rate"]}
    assert counts["dim_date"] == 31 and counts["dim_security"] == 150
    assert counts["fact_price_daily"] == 385 + 206

    pl.build_gold(spark, D, dt.date(2024, 1, 1), lake)          # rerun: idempotent
    again = {t: store.read(t).count() for t in counts}
    assert again == counts

    fresh = {r.check_name: r.passed for r in pl.gate_gold(spark, D, lake, min_securities=10,
                                                          min_rows_per_security=1).collect()}
    assert all(fresh.values())


def test_gate_with_nothing_landed_fails(spark, lake):
    report, verdict = pl.gate_bronze(spark, D, lake)
    assert report.count() == 0 and verdict.first().passed is False


def test_latest_partition_excludes_the_run_itself(spark, lake):
    b = bind.primary_bronze(spark, SF)
    bronze.land(b, lake, "primary_prices", dt.date(2024, 1, 29))
    bronze.land(b, lake, "primary_prices", D)
    got = bronze.latest_partition(spark, lake, "primary_prices", before=D).first()[0]
    assert got == dt.date(2024, 1, 29)


def test_universe_plan_sources_subset(spark):
    cons = bind.constituents(spark, SF)
    p = pl.universe_plan(cons, sample_size=5, sources=("primary",))
    assert "in_secondary_sample" not in p.columns and p.count() == 150
    full = pl.universe_plan(cons, sample_size=5)
    assert full.where("in_secondary_sample").count() == 5


def test_targeted_backfill_touches_only_the_subset(spark, lake):
    prev = dt.date(2024, 1, 20)
    cut = F.col("date") < F.lit(dt.date(2024, 1, 16))
    bronze.land(bind.constituents(spark, SF), lake, "constituents", prev)
    bronze.land(bind.identifiers(spark, SF), lake, "identifier_map", prev)
    bronze.land(bind.primary_bronze(spark, SF).where(cut), lake, "primary_prices", prev)
    bronze.land(bind.secondary_bronze(spark, SF).where(cut), lake, "secondary_prices", prev)
    bronze.land(bind.macro(spark, SF), lake, "macro_series", prev)
    pl.build_gold(spark, prev, dt.date(2024, 1, 1), lake)

    subset = bind.primary_bronze(spark, SF).where("stock_splits <> 0").select("ticker").distinct().cache()
    bronze.land(bind.primary_bronze(spark, SF).join(subset, "ticker", "left_semi"), lake, "primary_prices", D)
    bronze.land(bind.secondary_bronze(spark, SF).join(subset, "ticker", "left_semi"), lake, "secondary_prices", D)
    a = pl.run_backfill(spark, subset, D, dt.date(2024, 1, 1), lake).first()
    assert a.untouched_outside_subset and a.after_subset > a.before_subset
    store = GoldStore(spark, f"{lake}/gold")
    flags = {r.date: r.is_trading_day for r in store.read("dim_date").collect()}
    # days known from the previous full-universe run are never turned off
    assert flags[dt.date(2024, 1, 2)] and flags[dt.date(2024, 1, 29)]


def test_ingest_from_payloads_with_dead_letters(spark, lake):
    from pricelake.plans import ingest
    from pricelake.sources import landing
    cells, req = landing.wide_cells(spark, SF)
    rejects = ingest.ingest_wide_prices(spark, cells, req, D, lake)
    assert rejects.count() == 0 or all(r.reason == "no data returned" for r in rejects.collect())
    sample = bind.secondary_bronze(spark, SF).select("ticker").distinct()
    requested = sample.unionByName(spark.createDataFrame([("U999999",)], "ticker string"))
    rj = ingest.ingest_price_records(spark, landing.price_json(bind.secondary_bronze(spark, SF)), requested, D, lake)
    assert [r.key for r in rj.collect()] == ["U999999"]
    again = ingest.ingest_price_records(spark, landing.price_json(bind.secondary_bronze(spark, SF)), requested, D, lake)
    from pricelake.schemas import SECONDARY_BRONZE
    assert bronze.scan(spark, lake, "secondary_prices", SECONDARY_BRONZE, D).count() == 206   # resumed, not doubled
    snap = ingest.constituents_snapshot(spark, D, landing.constituents_html(spark, SF), root=lake)
    assert snap.count() == 150
    dead = spark.read.parquet(f"{lake}/bronze/_rejects")
    assert dead.where("source = 'secondary'").count() >= 1
    path = ingest.write_report(rj, lake, "rejects", D, csv=True)
    assert spark.read.option("header", "true").csv(path).count() == 1


def test_silver_history_range_and_order(spark, lake):
    bronze.land(bind.primary_bronze(spark, SF), lake, "primary_prices", D)
    s = pl.build_silver(spark, "primary", D, lake, start=dt.date(2024, 1, 10), end=dt.date(2024, 1, 20))
    dates = [r.date for r in s.select("date").distinct().collect()]
    assert min(dates) >= dt.date(2024, 1, 10) and max(dates) <= dt.date(2024, 1, 20)
    files = spark.read.parquet(f"{lake}/silver/primary_prices").select(
        F.input_file_name().alias("f"), "ticker").groupBy("f").agg(F.min("ticker").alias("lo"), F.max("ticker").alias("hi"))
    spans = sorted((r.lo, r.hi) for r in files.collect())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))      # files cover disjoint ticker ranges


def test_drift_in_a_landed_file_fails_the_scan(spark, lake):
    import pytest
    b = bind.primary_bronze(spark, SF)
    bronze.land(b, lake, "primary_prices", D, batch=0)
    bronze.land(b.drop("adj_close"), lake, "primary_prices", D, batch=1)
    with pytest.raises(ValueError, match="adj_close"):
        pl.build_silver(spark, "primary", D, lake)


def test_landing_order_is_numeric_and_empty_results_replace(spark, lake):
    b = bind.primary_bronze(spark, SF)
    one = b.limit(1)
    for k in (9, 10):
        bronze.land(one.withColumn("close", F.lit(float(k))), lake, "primary_prices", D, batch=k)
    assert [r.close for r in pl.build_silver(spark, "primary", D, lake).collect()] == [10.0]
    bronze.land(one.where("false"), lake, "primary_prices", D, batch=10)
    assert [r.close for r in pl.build_silver(spark, "primary", D, lake).collect()] == [9.0]


def test_forced_repull_replaces_only_the_requested(spark, lake):
    from pricelake.plans import ingest
    from pricelake.sources import landing
    b = bind.secondary_bronze(spark, SF).cache()
    names = sorted(r.ticker for r in b.select("ticker").distinct().collect())
    bronze.land(b, lake, "secondary_prices", D, batch=0)
    bronze.land(b.where(F.col("ticker") == names[0]), lake, "secondary_prices", D, batch=1)
    asked = spark.createDataFrame([(names[0],)], "ticker string")
    fresh = b.where(F.col("ticker") == names[0]).limit(1).withColumn("close", F.lit(200.0))
    rejects = ingest.ingest_price_records(spark, landing.price_json(fresh), asked, D, lake, force=True)
    s = pl.build_silver(spark, "secondary", D, lake)
    assert rejects.count() == 0
    assert [r.close for r in s.where(F.col("ticker") == names[0]).collect()] == [200.0]
    assert s.where(F.col("ticker") != names[0]).count() == b.where(F.col("ticker") != names[0]).count()


def test_daily_run_stops_and_passes(spark, lake):
    import pytest
    from pricelake.plans.catalogue import corrected_run
    from pricelake.sources import fs
    land_all(spark, lake)
    ok = {"constituents_band": (100, 200), "min_securities": 10, "min_rows_per_security": 1}
    with pytest.raises(pl.GateFailed) as e:
        pl.daily_run(spark, D, dt.date(2024, 1, 1), lake, **ok)
    assert e.value.gate == "bronze" and any("low <= open" in f for f in e.value.failed)
    assert not fs.exists(spark, f"{lake}/silver") and not fs.exists(spark, f"{lake}/gold")
    assert spark.read.parquet(f"{lake}/reports/bronze_gate").where("NOT success").count() == len(e.value.failed)
    corrected_run(spark, SF, lake)
    summary = pl.daily_run(spark, D, dt.date(2024, 1, 1), lake, **ok)
    assert {r.stage for r in summary.collect()} == {"bronze", "load", "gold"}
    with pytest.raises(pl.GateFailed) as e:
        pl.daily_run(spark, D, dt.date(2024, 1, 1), lake, **{**ok, "min_securities": 10 ** 6})
    assert e.value.gate == "gold"


def test_gold_by_the_version_of_the_day(spark, lake):
    """A security whose sector changed: bars before the change stay under its
    former key, those after it under the new one."""
    root, first, second = lake, dt.date(2024, 1, 10), dt.date(2024, 1, 20)
    bars = bind.primary_bronze(spark, SF).cache()
    ticker = bars.groupBy("ticker").count().orderBy(F.desc("count"), "ticker").first().ticker
    for day, sector in ((first, "OLD"), (second, "NEW")):
        members = bind.constituents(spark, SF, snapshot_date=day)
        members = members.withColumn("gics_sector", F.when(F.col("ticker") == ticker, sector).otherwise(F.col("gics_sector")))
        upto = F.col("date") <= F.lit(day)
        bronze.land(members, root, "constituents", day)
        bronze.land(bars.where(upto), root, "primary_prices", day)
        bronze.land(bind.secondary_bronze(spark, SF).where(upto), root, "secondary_prices", day)
        bronze.land(bind.macro(spark, SF).where(upto), root, "macro_series", day)
        bronze.land(bind.identifiers(spark, SF), root, "identifier_map", day)
        summary = {r.table: r for r in pl.build_gold(spark, day, dt.date(2024, 1, 1), root, point_in_time=True).collect()}
    store = GoldStore(spark, f"{root}/gold")
    keys = {r.gics_sector: r.security_key for r in store.read("dim_security").where(F.col("ticker") == ticker).collect()}
    assert set(keys) == {"OLD", "NEW"}
    f = store.read("fact_price_daily").where(F.col("source") == "primary")
    days = {s: sorted(r.date_key % 100 for r in f.where(F.col("security_key") == k).collect()) for s, k in keys.items()}
    mine = sorted(r.date.day for r in bars.where((F.col("ticker") == ticker) & (F.col("date") <= F.lit(second))).collect())
    assert days["OLD"] == [d for d in mine if 10 <= d < 20] and days["NEW"] == [d for d in mine if d == 20]
    # bars of before the first snapshot have no version of their day, and are counted
    assert summary["fact_price_daily:primary"].skipped_no_security_key == bars.where("day(date) < 10").count()


def test_discrepancy_reports(spark, lake):
    land_all(spark, lake)
    for source in ("primary", "secondary"):
        pl.build_silver(spark, source, D, lake)
    r = pl.reconcile(spark, D, lake)
    out = pl.discrepancy_reports(spark, D, r, lake)
    flagged = r.flagged().count()
    assert out["discrepancy_events"].agg(F.sum("days_flagged")).first()[0] == flagged > 0
    assert out["discrepancy_levels"].agg(F.sum("days")).first()[0] <= r.pairs().count()
    total = out["coverage"].where("grouping_id = 15").first()
    assert total.bars == r.matched.count()
    assert out["discrepancy_quantiles"].where("p = 0.5").agg(F.sum("n")).first()[0] == r.pairs().where("pct_diff IS NOT NULL").count()
    assert {p.name for p in __import__("pathlib").Path(f"{lake}/reports").iterdir()} >= set(out)
