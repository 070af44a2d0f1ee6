import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricelake.operators import dims, facts
from pricelake.operators.upsert import upsert
from pricelake.sources.gold import GoldStore

D1, D2 = dt.date(2024, 1, 2), dt.date(2024, 1, 3)


@pytest.fixture()
def dims_(spark):
    dd = dims.build_dim_date(spark, D1, D2, spark.createDataFrame([(D1,)], "date date"))
    snap = spark.createDataFrame([("A", "a", "s", "i", None)], "ticker string, company_name string, "
                                 "gics_sector string, gics_sub_industry string, figi string")
    ds, _ = dims.apply_snapshot(dims.empty_dim(spark), snap, D1)
    return dd, ds


def silver(spark, rows):
    return spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, "
                                       "close double, adj_close double, adj_open double, adj_high double, "
                                       "adj_low double, volume long, adj_volume long")


def test_unresolved_keys_are_counted_not_silent(spark, dims_):
    dd, ds = dims_
    s = silver(spark, [("A", D1, 1., 1., 1., 1., 1., 1., 1., 1., 5, 5),
                       ("ZZ", D1, 1., 1., 1., 1., 1., 1., 1., 1., None, None),
                       ("ZZ", dt.date(2023, 1, 1), 1., 1., 1., 1., 1., 1., 1., 1., 1, 1)])
    rows, cnt = facts.fact_price_daily(s, "primary", dd, ds)
    c = cnt.first()
    assert (c.loaded, c.skipped_no_security_key, c.skipped_no_date_key) == (1, 2, 1)   # overlapping skips
    assert rows.count() == 1


@pytest.mark.parametrize("v,want", [(7.625 * 1.00002, "7.625152"), (1.2345674999996, "1.234567"),
                                    (0.0000014999999, "0.000001"), (0.0000015, "0.000002"), (-2.0000005, "-2.000001")])
def test_decimal_scaling_rounds_the_printed_value_once(spark, dims_, v, want):
    from decimal import ROUND_HALF_UP, Decimal
    dd, ds = dims_
    s = silver(spark, [("A", D1, v, v, v, v, v, v, v, v, 1, 1)])
    r = facts.fact_price_daily(s, "primary", dd, ds)[0].first()
    assert f"{r.close:f}" == want == f"{Decimal(repr(v)).quantize(Decimal('0.000001'), ROUND_HALF_UP):f}"


def test_corporate_actions_are_sparse(spark, dims_):
    dd, ds = dims_
    b = spark.createDataFrame([("A", D1, 0.24, 0.0, 10.0), ("A", D2, 0.0, 2.0, 10.0), ("A", D2, 0.0, 0.0, 10.0)],
                              "ticker string, date date, dividends double, stock_splits double, close double")
    rows, cnt = facts.fact_corporate_action(b, dd, ds)
    assert sorted(r.action_type for r in rows.collect()) == ["dividend", "split"]
    only_div = facts.corporate_actions(b.drop("stock_splits"))
    assert only_div.count() == 1


def test_macro_date_outside_calendar_skipped(spark, dims_):
    dd, _ = dims_
    m = spark.createDataFrame([(D1, "DGS10", 4.1), (dt.date(2030, 1, 1), "DGS10", 4.2)],
                              "date date, series_id string, value double")
    rows, cnt = facts.fact_macro_rate(m, dd)
    assert rows.count() == 1 and cnt.first().skipped_no_date_key == 1


def test_upsert_replaces_conflicts_and_is_idempotent(spark):
    old = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    new = spark.createDataFrame([(2, "Y"), (3, "z")], "k int, v string")
    once = upsert(old, new, ["k"])
    twice = upsert(once, new, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect()) == [(1, "x"), (2, "Y"), (3, "z")]


def test_upsert_rejects_duplicate_keys_in_batch(spark):
    old = spark.createDataFrame([(1, "x")], "k int, v string")
    new = spark.createDataFrame([(2, "a"), (2, "b")], "k int, v string")
    with pytest.raises(Exception, match="duplicate key"):
        upsert(old, new, ["k"]).collect()


def test_store_upsert_rewrites_only_touched_months(spark, lake, dims_):
    dd, ds = dims_
    store = GoldStore(spark, lake)
    m = spark.createDataFrame([(20240102, "DGS10", 4.1), (20240203, "DGS10", 4.0)],
                              "date_key int, series_id string, value double").withColumn(
        "value", F.col("value").cast("decimal(18,6)"))
    store.upsert("fact_macro_rate", m)
    rev = spark.createDataFrame([(20240102, "DGS10", 4.5)], "date_key int, series_id string, value double") \
        .withColumn("value", F.col("value").cast("decimal(18,6)"))
    store.upsert("fact_macro_rate", rev)
    store.upsert("fact_macro_rate", rev)
    got = {r.date_key: float(r.value) for r in store.read("fact_macro_rate").collect()}
    assert got == {20240102: 4.5, 20240203: 4.0}


def test_fk_and_pk_checks(spark, dims_):
    dd, ds = dims_
    f = spark.createDataFrame([(1, 20240102), (1, 20240102), (7, 19990101)], "security_key int, date_key int")
    orph = {r.fk: r.orphans for r in facts.fk_orphans(f, "t", dd, ds).collect()}
    assert orph == {"date_key": 1, "security_key": 1}
    assert facts.pk_duplicates(f, "t", ["security_key", "date_key"]).first().duplicate_keys == 1


def test_freshness_gate_thresholds(spark, dims_):
    dd, ds = dims_
    cons = spark.createDataFrame([(1, 20240102)], "security_key int, date_key int")
    r = {x.check_name: x for x in facts.freshness(ds, cons, dd, dt.date(2024, 1, 5), 1, 1, 5).collect()}
    assert all(x.passed for x in r.values())
    late = {x.check_name: x for x in facts.freshness(ds, cons, dd, dt.date(2024, 1, 30), 1, 1, 5).collect()}
    assert not late["latest data within 5 days of ingest_date"].passed
    future = {x.check_name: x for x in facts.freshness(ds, cons, dd, dt.date(2024, 1, 1), 1, 1, 5).collect()}
    assert not future["latest data within 5 days of ingest_date"].passed


def month_rows(spark, value, days):
    return spark.createDataFrame([(k, "DGS10", value) for k in days], "date_key int, series_id string, value double").withColumn(
        "value", F.col("value").cast("decimal(18,6)"))


def test_upsert_reads_and_replaces_only_touched_months(spark, lake):
    store = GoldStore(spark, lake)
    store.upsert("fact_macro_rate", month_rows(spark, 1.0, [20240105, 20240205, 20240305]))
    before = {f for f in store.read("fact_macro_rate").inputFiles()}
    only = store.read("fact_macro_rate", [202402]).inputFiles()
    assert only and all("part=202402" in f for f in only)
    store.upsert("fact_macro_rate", month_rows(spark, 2.0, [20240206]))
    after = {f for f in store.read("fact_macro_rate").inputFiles()}
    assert {f for f in before if "202402" not in f} <= after
    assert sorted((r.date_key, float(r.value)) for r in store.read("fact_macro_rate").collect()) == [
        (20240105, 1.0), (20240205, 1.0), (20240206, 2.0), (20240305, 1.0)]


def test_a_crash_between_the_steps_leaves_the_old_table(spark, lake, monkeypatch):
    import os
    store = GoldStore(spark, lake)
    store.upsert("fact_macro_rate", month_rows(spark, 1.0, [20240105]))

    def crash(*a):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(store, "_publish", crash)
        with pytest.raises(RuntimeError):
            store.upsert("fact_macro_rate", month_rows(spark, 2.0, [20240105]))
    assert [float(r.value) for r in store.read("fact_macro_rate").collect()] == [1.0]
    store.upsert("fact_macro_rate", month_rows(spark, 3.0, [20240105]))
    assert [float(r.value) for r in store.read("fact_macro_rate").collect()] == [3.0]
    table = f"{lake}/fact_macro_rate"
    assert len([d for d in os.listdir(table) if d.startswith("version=")]) == 1      # nothing left over
    assert len([d for d in os.listdir(f"{table}/_manifest") if d.endswith(".json")]) == 1


def test_calendar_is_broadcast(spark, dims_):
    dd, ds = dims_
    s = silver(spark, [("A", D1, 1., 1., 1., 1., 1., 1., 1., 1., 5, 5)])
    plan = facts.resolve_keys(s, dd, None)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan


def test_readers_of_former_states_keep_their_files(spark, lake):
    import os
    store = GoldStore(spark, lake, keep=2)
    planned = []
    for v in range(1, 6):
        store.upsert("fact_macro_rate", month_rows(spark, float(v), [20240105, 20240200 + v]))
        planned.append(store.read("fact_macro_rate", [202401]))
    assert [float(df.first().value) for df in planned[-3:]] == [3.0, 4.0, 5.0]
    table = f"{lake}/fact_macro_rate"
    assert len(os.listdir(f"{table}/_manifest")) - len([n for n in os.listdir(f"{table}/_manifest") if n.startswith(".")]) == 3
    assert len([d for d in os.listdir(table) if d.startswith("version=")]) == 3
    assert store.read("fact_macro_rate").count() == 6
    GoldStore(spark, lake).clean("fact_macro_rate")
    assert len([d for d in os.listdir(table) if d.startswith("version=")]) == 1 and store.read("fact_macro_rate").count() == 6


def test_a_part_is_written_by_few_tasks(spark, lake):
    store = GoldStore(spark, lake)
    days = [20240100 + 100 * m + d for m in range(6) for d in range(1, 29)]
    store.upsert("fact_macro_rate", month_rows(spark, 1.0, days).repartition(24))
    assert len(store.read("fact_macro_rate").inputFiles()) <= 12
