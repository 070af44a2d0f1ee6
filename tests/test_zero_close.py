"""A bar with a close of zero has no adjusted prices, and its query still
returns it: over an events table of its own, against the SQL."""

import datetime as dt
import json
import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from pricelake.operators.silver import to_silver
from pricelake.plans import ingest
from pricelake.plans import pipeline as pl
from pricelake.sources import landing, payloads
from tests.test_silver import bars

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """Bars of three users; the first of user 20 closes at zero."""
    folder = str(tmp_path_factory.mktemp("zero"))
    rows = [(20, 16, 0.0), (20, 17, 3.0), (20, 17, 4.5), (22, 3, 8.0), (22, 16, 7.0), (21, 16, 5.0)]
    spark.createDataFrame([(i, dt.datetime(2024, 1, day, 9, i), uid, "click", value, "{}") for i, (uid, day, value) in enumerate(rows)],
                          "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
                          ).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("name", ["old_bronze_fallback", "price_payload_json", "forced_repull"])
def test_query_keeps_the_bar(spark, events, name):
    from oracle_check import digest
    got = entry_mod.queries()[name](spark, events).toPandas()
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{events}/events.parquet/*.parquet')")
    want = con.execute(entry_mod.oracle_sql()[name]).df()
    assert len(got) == len(want) and digest(got) == digest(want)
    zero = got[got.close == 0]
    assert len(zero) == 1 and zero.adj_open.isna().all() and zero.adj_close.notna().all()


def test_silver_without_the_guard(spark):
    df = bars(spark).withColumn("close", F.when(F.col("date") == F.lit(dt.date(2024, 1, 2)), 0.0).otherwise(F.col("close")))
    rows = to_silver(df, strict=False).orderBy("date").collect()
    assert [r.adj_open for r in rows] == [None, 101.0, 102.0] and [r.adj_volume for r in rows] == [r.volume for r in rows]


def test_payload_names_fields_without_a_value(spark):
    b = bars(spark, n=1)
    b = b.withColumns({c: F.lit(None).cast("double") for c in ("adj_open", "adj_high", "adj_low")}).withColumn("adj_volume", F.lit(2))
    rows, rejects = payloads.parse_price_records(landing.price_json(b))
    r, = rows.collect()
    assert (r.open, r.adj_open, r.adj_volume) == (100.0, None, 2) and rejects.count() == 0


def test_forced_repull_of_a_response_whose_first_record_lacks_fields(spark, tmp_path):
    """The first bar, without adjusted prices, leaves the fields out; the
    second names them.  A field that no record names is drift still."""
    root, d = str(tmp_path / "lake"), dt.date(2024, 1, 31)
    whole = {"date": "2024-01-03T00:00:00.000Z", "open": 1.0, "high": 2.0, "low": 0.5, "close": 1.5, "volume": 10,
             "adjClose": 1.4, "adjOpen": 0.9, "adjHigh": 1.9, "adjLow": 0.4, "adjVolume": 20}
    short = {k: v for k, v in whole.items() if k not in ("adjOpen", "adjHigh", "adjLow")} | {"date": "2024-01-02T00:00:00.000Z", "close": 0.0}

    def pull(*records):
        landed = spark.createDataFrame([("A", json.dumps(records))], "ticker string, payload string")
        return ingest.ingest_price_records(spark, landed, spark.createDataFrame([("A",)], "ticker string"), d, root, force=True)

    pull(whole)
    assert pull(short, whole).count() == 0
    rows = pl.build_silver(spark, "secondary", d, root).orderBy("date").collect()
    assert [(r.date.day, r.close, r.adj_open, r.adj_volume) for r in rows] == [(2, 0.0, None, 20), (3, 1.5, 0.9, 20)]
    with pytest.raises(Exception, match="missing: adjOpen,adjHigh,adjLow"):
        pull(short, short)
