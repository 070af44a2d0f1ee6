import datetime as dt

from pyspark.sql import functions as F

from pricelake.operators import dims
from pricelake.sources import bindings as bind
from pricelake.sources import bronze
from pricelake.sources.gold import GoldStore
from pricelake.streaming.bronze_stream import run_price_stream
from tests.conftest import SF


def test_stream_processes_new_landings_once_and_keeps_last(spark, lake):
    b = bind.primary_bronze(spark, SF).cache()
    dd = dims.build_dim_date(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 31), dims.trading_days(b))
    snap = dims.prepare_snapshot(bind.constituents(spark, SF), None)
    ds, _ = dims.apply_snapshot(dims.empty_dim(spark), snap, bind.INGEST_DATE)
    ds = ds.cache()
    early = F.col("date") < F.lit(dt.date(2024, 1, 16))
    bronze.land(b.where(early), lake, "primary_prices", dt.date(2024, 1, 16))
    run_price_stream(spark, "primary", dd, ds, root=lake)
    store = GoldStore(spark, f"{lake}/gold")
    n1 = store.read("fact_price_daily").count()
    assert n1 == b.where(early).count()

    # next day: the rest, plus a restated re-delivery of one early bar
    one = b.where(early).limit(1)
    restated = one.withColumn("adj_close", F.col("adj_close") * 2)
    bronze.land(b.where(~early).unionByName(restated), lake, "primary_prices", dt.date(2024, 1, 31))
    run_price_stream(spark, "primary", dd, ds, root=lake)
    facts = store.read("fact_price_daily")
    assert facts.count() == b.count()
    r = one.first()
    key = int(r.date.strftime("%Y%m%d"))
    got = facts.where(F.col("date_key") == key).join(
        ds.where(F.col("ticker") == r.ticker).select("security_key"), "security_key").first()
    assert abs(float(got.adj_close) - round(r.adj_close * 2, 6)) < 1e-6

    # nothing new: a rerun is a no-op
    run_price_stream(spark, "primary", dd, ds, root=lake)
    assert store.read("fact_price_daily").count() == b.count()
