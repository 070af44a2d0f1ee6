import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricelake.operators.silver import to_silver
from pricelake.schemas import PRIMARY_BRONZE, SILVER_COLUMNS
from pricelake.sources import bronze

D = dt.date(2024, 1, 2)


def bars(spark, n=3, factor=1.0):
    rows = []
    for i in range(n):
        close = 101.0 + i
        rows.append((D + dt.timedelta(days=i), 100.0 + i, 102.0 + i, 99.0 + i, close, close * factor,
                     1_000_000 + 1000 * i, "AAA"))
    return spark.createDataFrame(rows, "date date, open double, high double, low double, close double, "
                                       "adj_close double, volume long, ticker string")


def test_fixed_column_order_and_derived_volume(spark):
    s = to_silver(bars(spark))
    assert s.columns == SILVER_COLUMNS
    r = s.orderBy("date").first()
    assert r.adj_volume == r.volume == 1_000_000
    assert r.adj_open == pytest.approx(100.0)


def test_half_factor_scales_open_high_low(spark):
    df = spark.createDataFrame(
        [(D, 101.0, 103.0, 99.0, 101.0, 50.5, 10, "AAA")],
        "date date, open double, high double, low double, close double, adj_close double, volume long, ticker string")
    r = to_silver(df).first()
    assert r.adj_open == pytest.approx(50.5) and r.adj_high == pytest.approx(51.5) and r.adj_low == pytest.approx(49.5)


def test_native_adjusted_passes_through(spark):
    df = bars(spark).withColumn("adj_open", F.lit(1.0)).withColumn("adj_high", F.lit(2.0)) \
        .withColumn("adj_low", F.lit(0.5)).withColumn("adj_volume", F.col("volume") * 2)
    r = to_silver(df).orderBy("date").first()
    assert (r.adj_open, r.adj_high, r.adj_low, r.adj_volume) == (1.0, 2.0, 0.5, 2_000_000)


def test_partial_native_columns_fall_back_to_derivation(spark):
    df = bars(spark, factor=0.5).withColumn("adj_open", F.lit(1.0))
    r = to_silver(df).orderBy("date").first()
    assert r.adj_open == pytest.approx(50.0)


def test_missing_required_column_is_schema_drift(spark):
    with pytest.raises(ValueError, match="lacks columns"):
        to_silver(bars(spark).drop("adj_close"))


def test_non_positive_close_fails_the_job(spark):
    df = bars(spark).withColumn("close", F.lit(0.0))
    with pytest.raises(Exception, match="not positive"):
        to_silver(df).collect()


def test_keep_last_by_arrival_order(spark, lake):
    first = bars(spark).withColumn("dividends", F.lit(0.0)).withColumn("stock_splits", F.lit(0.0))
    again = first.where(F.col("date") == F.lit(D)).withColumn("close", F.lit(200.0)).withColumn("adj_close", F.lit(200.0))
    bronze.land(first, lake, "p", dt.date(2024, 1, 31), batch=0)
    bronze.land(again, lake, "p", dt.date(2024, 1, 31), batch=1)
    scanned = bronze.scan(spark, lake, "p", PRIMARY_BRONZE, dt.date(2024, 1, 31)).drop("ingest_date", "batch")
    s = to_silver(scanned)
    assert s.count() == 3
    assert s.where(F.col("date") == F.lit(D)).first().close == 200.0


def test_tasks_that_read_landings_sort_nothing(spark, lake):
    b = bars(spark).withColumns({"dividends": F.lit(0.0), "stock_splits": F.lit(0.0)})
    bronze.land(b, lake, "p", D)
    scanned = bronze.scan(spark, lake, "p", PRIMARY_BRONZE, D).drop("ingest_date", "batch")
    plan = to_silver(scanned)._jdf.queryExecution().executedPlan().toString()
    above, _, below = plan.partition("Exchange hashpartitioning(")
    assert "Window" in above and "Sort [" in above
    assert "Scan parquet" in below and "Sort [" not in below and "Exchange" not in below


def test_missing_partition_is_empty_not_error(spark, lake):
    assert bronze.scan(spark, lake, "nothing", PRIMARY_BRONZE, D).count() == 0


def test_golden_rows_adjusted_open(spark):
    # real vendor values; expectations computed independently
    p = spark.createDataFrame([(dt.date(2019, 1, 2), 38.7225, 39.712502, 38.557499, 39.48, 37.436916, 148158800, "AAPL")],
                              "date date, open double, high double, low double, close double, adj_close double, volume long, ticker string")
    s = spark.createDataFrame([(dt.date(2019, 1, 2), 154.89, 158.85, 154.23, 157.92, 37.437651, 37039737, "AAPL")],
                              p.schema)
    assert to_silver(p).first().adj_open == pytest.approx(36.718616509878416, rel=1e-9)
    assert to_silver(s).first().adj_open == pytest.approx(36.71933740748481, rel=1e-9)


@pytest.mark.parametrize("columns", [["adj_close"], ["ticker", "date"], ["adj_close", "ticker"]])
def test_guard_holds_under_pruned_columns(spark, columns):
    df = bars(spark).withColumn("close", F.when(F.col("date") == F.lit(D), 0.0).otherwise(F.col("close")))
    with pytest.raises(Exception, match="not positive"):
        to_silver(df).select(*columns).collect()
    with pytest.raises(Exception, match="not positive"):
        to_silver(df).count()


def test_rows_with_native_prices_need_no_factor(spark):
    df = (bars(spark).withColumn("close", F.lit(0.0)).withColumn("_native", F.lit(True))
          .withColumns({c: F.lit(1.0) for c in ("adj_open", "adj_high", "adj_low")}).withColumn("adj_volume", F.col("volume")))
    assert to_silver(df).count() == 3


def test_quarantine_sets_zero_closes_aside(spark, lake):
    from pricelake.plans import pipeline as pl
    b = bars(spark).withColumns({"dividends": F.lit(0.0), "stock_splits": F.lit(0.0)})
    b = b.withColumn("close", F.when(F.col("date") == F.lit(D), 0.0).otherwise(F.col("close")))
    day = dt.date(2024, 2, 1)
    bronze.land(b, lake, "primary_prices", day)
    with pytest.raises(Exception, match="not positive"):
        pl.build_silver(spark, "primary", day, lake)
    assert pl.build_silver(spark, "primary", day, lake, quarantine=True).count() == 2
    aside = spark.read.parquet(bronze.batch_path(lake, "quarantine", "primary_prices", day, 0)).collect()
    assert [(r.date, r.reason) for r in aside] == [(D, "close > 0")]
