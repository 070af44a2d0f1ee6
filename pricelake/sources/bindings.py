"""Bind the supplied tables to the price-lake datasets.

The supplied tables carry no prices, so each dataset below is *derived* from
them with integer-modulo and date rules only (no engine-specific hashing), so
that Spark and an independent SQL engine build identical inputs.

FIXED VALUES (binding rules):
  uid = events.user_id, dy = day of month, ticker = 'U' + uid zero-padded
        to at least 6 digits (never truncated, so distinct ids stay distinct)
  bars: per (uid, date) of events: open = first value by ts,
        high = max, low = min, close = last value by ts, volume = count;
        bad print where uid % 97 = 7 and dy = 5: low = open + 0.5;
        adj_close = close * 0.5 where uid % 3 = 0 and date < 2024-01-16
  primary:   bars where (uid + dy) % 31 <> 0
  secondary: bars where uid % 2 = 0 and (uid + dy) % 29 <> 0, adj_close
             scaled -1 (a zero mean) where uid % 46 = 6 and dy = 9, else
             1.07 where uid % 20 = 0 and date < 2024-01-10, else
             1.013 where uid % 50 = 4, else 1.00002; native adjusted OHLC is
             OHLC times adj_close / close and adj_volume = 2 * volume
  actions:   dividends 0.24 where uid % 10 = 0 and dy = 10;
             stock_splits 2.0 where uid % 3 = 0 and date = 2024-01-16
  primary landed: the primary feed as it arrives, with faults: a second,
             later copy with close and adj_close times 1.002 where uid % 41 = 3
             and dy = 7; ticker NULL where uid % 53 = 9 and dy = 11; close and
             adj_close 0 where uid % 61 = 5 and dy = 13; close negated where
             uid % 67 = 8 and dy = 14; close NULL where uid % 71 = 10 and
             dy = 15; volume negated where uid % 73 = 2 and dy = 16; an unknown
             ticker ('X' + ticker) where uid % 17 = 4 and dy = 3
  calendar:  from the day after the first event to the last event's day, so
             the first day's bars find no date
  constituents: all customers; sector = c_mktsegment,
             sub-industry = nation name, company name 'Acme <key>' plus
             ' Inc.' / ', Corp' / ' plc' / ' Class A' for key % 4 = 0/1/2/3
  holdings:  customers with key % 19 <> 0; name
             'ACME <key>' plus ' INCORPORATED' / ' Holdings' / ' LTD' for
             key % 3 = 0/1/2; title 'acme <key> class b'
  outside holdings: suppliers; name 'Acme <key> plc' where key % 3 = 1, else
             'Outside <key> Ltd'; title 'ACME <key> class b' where key % 3 = 0,
             else 'outside note <key>'
  identifiers: constituents with key % 13 <> 0, figi 'BBG' + key padded to 9
  snapshots: orders, one row per (o_custkey, order year), attribute = priority
             of the latest order (date desc, o_orderkey desc), snapshot date
             1 January of that year
  weekly snapshots: orders, one row per (o_custkey, week = o_orderkey % 5),
             attribute as above, snapshot date 2024-01-01 plus 7 days a week
  macro:     events per (series, date), value = average; series from
             event_type: click DGS3MO, view DGS10, purchase FEDFUNDS,
             signup CPIAUCSL, anything else upper(event_type)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

INGEST_DATE = dt.date(2024, 1, 31)
SPLIT_DATE = dt.date(2024, 1, 16)
RESTATED_BEFORE = dt.date(2024, 1, 10)


def ticker_of(key: Column) -> Column:
    s = key.cast("string")
    return F.concat(F.lit("U"), F.lpad(s, F.greatest(F.lit(6), F.length(s)), "0"))


def uid_of(ticker: Column) -> Column:
    """Inverse of ``ticker_of``."""
    return F.substr(ticker, F.lit(2)).cast("long")


def _max_uid(spark: SparkSession, sf_dir: str) -> Column:
    # scalar subquery: planned once, inlined as a literal, no join
    return read_table(spark, sf_dir, "events", "user_id").select(F.max("user_id")).scalar()


def bars_all(spark: SparkSession, sf_dir: str, copies: int = 1) -> DataFrame:
    ev = (read_table(spark, sf_dir, "events", "user_id", "ts", "value")
          .withColumn("date", F.to_date("ts")))
    if copies > 1:
        # scaled stress input derived from the same table: copy k shifts every
        # user id by k * (max id + 1) (a generator, not a join)
        stride = _max_uid(spark, sf_dir) + 1
        # copies multiply rows inside whichever task read them: spread the
        # input over the shuffle partitions first (a source file may be a
        # single split)
        ev = ev.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
        ev = (ev.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
              .withColumn("user_id", F.col("user_id") + F.col("_k") * stride).drop("_k"))
    # grouped on (ticker, date) — the key every price stage partitions on —
    # so de-duplication and the vendor join reuse this one exchange
    g = ev.withColumn("ticker", ticker_of(F.col("user_id"))).groupBy("ticker", "date").agg(
        F.max("user_id").alias("user_id"),
        F.min_by("value", "ts").alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", "ts").alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )
    uid, dy = F.col("user_id"), F.dayofmonth("date")
    bad_print = (uid % 97 == 7) & (dy == 5)
    split_era = (uid % 3 == 0) & (F.col("date") < F.lit(SPLIT_DATE))
    return g.select(
        uid.alias("uid"), "date", dy.alias("dy"), "ticker",
        "open", "high",
        F.when(bad_print, F.col("open") + 0.5).otherwise(F.col("low")).alias("low"),
        "close",
        (F.col("close") * F.when(split_era, 0.5).otherwise(1.0)).alias("adj_close"),
        "volume",
    )


def primary_bronze(spark: SparkSession, sf_dir: str, copies: int = 1) -> DataFrame:
    """Primary vendor: raw OHLC + adj_close + actions, no native adjusted OHLC."""
    b = bars_all(spark, sf_dir, copies).where((F.col("uid") + F.col("dy")) % 31 != 0)
    uid, dy = F.col("uid"), F.col("dy")
    return b.select(
        "date", "open", "high", "low", "close", "adj_close", "volume",
        F.when((uid % 10 == 0) & (dy == 10), 0.24).otherwise(0.0).alias("dividends"),
        F.when((uid % 3 == 0) & (F.col("date") == F.lit(SPLIT_DATE)), 2.0)
         .otherwise(0.0).alias("stock_splits"),
        "ticker",
    )


def primary_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The primary feed with the faults that the gate and the loads must find."""
    b = primary_bronze(spark, sf_dir)
    uid, dy = uid_of(F.col("ticker")), F.dayofmonth("date")

    def at(modulo, rest, day):
        return (uid % modulo == rest) & (dy == day)

    b = b.withColumn("_copies", F.when(at(41, 3, 7), F.array(F.lit(1.0), F.lit(1.002))).otherwise(F.array(F.lit(1.0))))
    b = b.withColumn("_f", F.explode("_copies"))
    close = (F.when(at(61, 5, 13), 0.0).when(at(67, 8, 14), -F.col("close")).when(at(71, 10, 15), F.lit(None).cast("double"))
             .otherwise(F.col("close") * F.col("_f")))
    adj = F.when(at(61, 5, 13), 0.0).otherwise(F.col("adj_close") * F.col("_f"))
    ticker = (F.when(at(53, 9, 11), F.lit(None).cast("string")).when(at(17, 4, 3), F.concat(F.lit("X"), "ticker"))
              .otherwise(F.col("ticker")))
    return b.select("date", "open", "high", "low", close.alias("close"), adj.alias("adj_close"),
                    F.when(at(73, 2, 16), -F.col("volume")).otherwise(F.col("volume")).alias("volume"),
                    "dividends", "stock_splits", ticker.alias("ticker"))


def calendar_bounds(spark: SparkSession, sf_dir: str) -> tuple[dt.date, dt.date]:
    """First and last day of the calendar: one row read from the events."""
    r = read_table(spark, sf_dir, "events", "ts").agg(
        F.date_add(F.to_date(F.min("ts")), 1).alias("lo"), F.to_date(F.max("ts")).alias("hi")).first()
    return r.lo, r.hi


def secondary_bronze(spark: SparkSession, sf_dir: str, native_adjusted: bool = True,
                     copies: int = 1) -> DataFrame:
    """Secondary vendor: sampled universe, restated / offset history."""
    b = bars_all(spark, sf_dir, copies).where((F.col("uid") % 2 == 0) & ((F.col("uid") + F.col("dy")) % 29 != 0))
    uid = F.col("uid")
    scale = (F.when((uid % 46 == 6) & (F.col("dy") == 9), -1.0)
             .when((uid % 20 == 0) & (F.col("date") < F.lit(RESTATED_BEFORE)), 1.07)
             .when(uid % 50 == 4, 1.013).otherwise(1.00002))
    b = b.withColumn("adj_close", F.col("adj_close") * scale)
    if not native_adjusted:
        return b.select("date", "open", "high", "low", "close", "adj_close", "volume", "ticker")
    f = F.try_divide(F.col("adj_close"), F.col("close"))
    return b.select(
        "date", "open", "high", "low", "close", "adj_close",
        (F.col("open") * f).alias("adj_open"), (F.col("high") * f).alias("adj_high"),
        (F.col("low") * f).alias("adj_low"), (F.col("volume") * 2).alias("adj_volume"),
        "volume", "ticker",
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")


def constituents(spark: SparkSession, sf_dir: str, snapshot_date: dt.date = INGEST_DATE) -> DataFrame:
    c = _customers(spark, sf_dir)
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")  # 25 rows, fixed
    k = F.col("c_custkey")
    suffix = (F.when(k % 4 == 0, " Inc.").when(k % 4 == 1, ", Corp")
              .when(k % 4 == 2, " plc").otherwise(" Class A"))
    return (c.join(F.broadcast(nation), c.c_nationkey == nation.n_nationkey, "left")
            .select(ticker_of(k).alias("ticker"),
                    F.concat(F.lit("Acme "), k.cast("string"), suffix).alias("company_name"),
                    F.col("c_mktsegment").alias("gics_sector"),
                    F.col("n_name").alias("gics_sub_industry"),
                    F.date_add(F.lit(dt.date(1990, 1, 1)), (k * 7).cast("int")).alias("date_added"),
                    F.lit(snapshot_date).alias("snapshot_date")))


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    c = _customers(spark, sf_dir).where(k % 19 != 0)
    suffix = F.when(k % 3 == 0, " INCORPORATED").when(k % 3 == 1, " Holdings").otherwise(" LTD")
    return c.select(
        F.concat(F.lit("ACME "), k.cast("string"), suffix).alias("name"),
        F.concat(F.lit("acme "), k.cast("string"), F.lit(" class b")).alias("title"),
        F.lpad(k.cast("string"), 9, "0").alias("cusip"),
        F.when(k % 7 == 3, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("US"), F.lpad(k.cast("string"), 10, "0"))).alias("isin"),
        F.when(k % 5 == 4, "STIV").otherwise("EC").alias("asset_cat"),
        (F.col("c_acctbal") / 1000.0).alias("pct_val"),
        F.col("c_acctbal").alias("val_usd"),
        k.alias("holding_key"),
    )


def outside_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holdings of a fund beyond the universe: by neither key, by title only
    or by name only known to it."""
    s, k = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_acctbal"), F.col("s_suppkey")
    key = k.cast("string")
    return s.select(
        F.when(k % 3 == 1, F.concat(F.lit("Acme "), key, F.lit(" plc"))).otherwise(F.concat(F.lit("Outside "), key, F.lit(" Ltd"))).alias("name"),
        F.when(k % 3 == 0, F.concat(F.lit("ACME "), key, F.lit(" class b"))).otherwise(F.concat(F.lit("outside note "), key)).alias("title"),
        F.concat(F.lit("X"), F.lpad(key, 8, "0")).alias("cusip"), F.lit(None).cast("string").alias("isin"), F.lit("EC").alias("asset_cat"),
        (F.col("s_acctbal") / 1000.0).alias("pct_val"), F.col("s_acctbal").alias("val_usd"))


def identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    c = _customers(spark, sf_dir).where(k % 13 != 0)
    return c.select(
        ticker_of(k).alias("ticker"),
        F.concat(F.lit("BBG"), F.lpad(k.cast("string"), 9, "0")).alias("figi"),
        F.concat(F.lit("BBC"), F.lpad(k.cast("string"), 9, "0")).alias("composite_figi"),
        F.lit(None).cast("string").alias("share_class_figi"),
        F.concat(F.lit("ACME "), k.cast("string")).alias("name"),
        F.lit("Common Stock").alias("security_type"),
        F.lit("Equity").alias("market_sector"),
    )


def membership_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticker, snapshot_date, attribute) — one row per customer and order year."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    latest = F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey"))
    g = (o.withColumn("yr", F.year("o_orderdate"))
         .groupBy("o_custkey", "yr").agg(latest.alias("attribute")))
    return g.select(ticker_of(F.col("o_custkey")).alias("ticker"),
                    F.make_date("yr", F.lit(1), F.lit(1)).alias("snapshot_date"),
                    "attribute")


def weekly_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticker, snapshot_date, attribute): membership by week of the bars' month."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    latest = F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey"))
    g = o.withColumn("wk", F.col("o_orderkey") % 5).groupBy("o_custkey", "wk").agg(latest.alias("attribute"))
    return g.select(ticker_of(F.col("o_custkey")).alias("ticker"),
                    F.date_add(F.lit(dt.date(2024, 1, 1)), (7 * F.col("wk")).cast("int")).alias("snapshot_date"), "attribute")


def series_of(event_type: Column) -> Column:
    return (F.when(event_type == "click", "DGS3MO").when(event_type == "view", "DGS10")
            .when(event_type == "purchase", "FEDFUNDS").when(event_type == "signup", "CPIAUCSL")
            .otherwise(F.upper(event_type)))


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "ts", "event_type", "value")
    return (ev.groupBy(F.to_date("ts").alias("date"), series_of(F.col("event_type")).alias("series_id"))
            .agg(F.avg("value").alias("value")))


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secondary-vendor request times: one request per event, one account."""
    return read_table(spark, sf_dir, "events", "event_id", "ts").select(
        F.lit("default").alias("account"), F.col("event_id").alias("request_id"),
        F.col("ts").alias("requested_at"))
