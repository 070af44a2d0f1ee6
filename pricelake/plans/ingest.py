"""Ingest verbs: landed vendor payloads → bronze partitions + dead letters.

Network fetching is out of scope; these start from landed payload tables
(one row per response) and do all the data work: parse, tag, check the
delivered keys against the requested ones, write bronze for the run date and
record every requested-but-undelivered key as a dead letter.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PRIMARY, SECONDARY
from ..schemas import CONSTITUENTS_BRONZE, IDENTIFIER_BRONZE, MACRO_BRONZE, PRIMARY_BRONZE, SECONDARY_BRONZE
from ..session import lake_root
from ..sources import bronze, payloads


def _requested_minus_delivered(requested: DataFrame, delivered: DataFrame, source: str,
                               reason: str, key: str = "ticker") -> DataFrame:
    return (requested.select(key).distinct().join(delivered.select(key).distinct(), key, "left_anti")
            .select(F.lit(source).alias("source"), F.col(key).alias("key"), F.lit(reason).alias("reason")))


def ingest_wide_prices(spark: SparkSession, cells: DataFrame, requested: DataFrame, ingest_date: dt.date,
                       root: str | None = None, source: str = PRIMARY) -> DataFrame:
    """Wide vendor responses (one map of '{ticker}.{field}' cells per batch
    and date) → long bronze rows for the date; requested tickers the vendor
    silently left out become dead letters.  Returns the dead letters."""
    root = root or lake_root(spark)
    long = payloads.cells_to_long(cells)
    bronze.land(long.select("date", "open", "high", "low", "close", "adj_close", "volume",
                            "dividends", "stock_splits", "ticker"), root, f"{source}_prices", ingest_date)
    landed = bronze.scan(spark, root, f"{source}_prices", PRIMARY_BRONZE, ingest_date, arrival=False)
    rejects = _requested_minus_delivered(requested, landed, source, "no data returned")
    bronze.write_rejects(rejects, root, ingest_date, source)
    return rejects


def ingest_price_records(spark: SparkSession, landed_json: DataFrame, requested: DataFrame,
                         ingest_date: dt.date, root: str | None = None, source: str = SECONDARY,
                         force: bool = False) -> DataFrame:
    """JSON daily-price responses → bronze for the date, as the next batch.

    Resumable: tickers already landed for the date are not re-landed (their
    rows stay).  With ``force`` the requested tickers' rows are first taken
    out of every earlier batch of the date, so that what is delivered now
    replaces them; other tickers' rows stay in their batches.  Requested
    tickers without a row for the date become dead letters."""
    root = root or lake_root(spark)
    name = f"{source}_prices"
    rows, empty = payloads.parse_price_records(landed_json)
    earlier = bronze.batches(spark, root, name, ingest_date)
    if force:
        for b in earlier:  # as many as the day has landings
            folder = bronze.batch_path(root, "bronze", name, ingest_date, b)
            held = spark.read.parquet(folder)
            bronze.land(held.join(requested.select("ticker").distinct(), "ticker", "left_anti").select(*held.columns),
                        root, name, ingest_date, batch=b)
    else:
        have = bronze.scan(spark, root, name, SECONDARY_BRONZE, ingest_date, arrival=False).select("ticker").distinct()
        rows = rows.join(have, "ticker", "left_anti")
    bronze.land(rows, root, name, ingest_date, batch=max(earlier, default=-1) + 1)
    landed = bronze.scan(spark, root, name, SECONDARY_BRONZE, ingest_date, arrival=False).select("ticker").distinct()
    rejects = _requested_minus_delivered(requested, landed, source, "no data returned").unionByName(
        empty.withColumn("source", F.lit(source)).join(landed.withColumnRenamed("ticker", "key"), "key", "left_anti")
        .select("source", "key", "reason"))
    rejects = rejects.groupBy("source", "key").agg(F.max("reason").alias("reason"))
    bronze.write_rejects(rejects, root, ingest_date, source)
    return rejects


def _rejected(rejects: DataFrame, requested: DataFrame | None, landed: DataFrame, source: str, key: str) -> DataFrame:
    """One dead letter per key: what the parser rejected, and what was
    requested and never came, unless it landed after all."""
    out = rejects.select(F.lit(source).alias("source"), "key", "reason")
    if requested is not None:
        out = out.unionByName(_requested_minus_delivered(requested, landed, source, "no data returned", key))
    have = landed.select(F.col(key).alias("key")).distinct()
    return out.join(have, "key", "left_anti").groupBy("source", "key").agg(F.max("reason").alias("reason"))


def ingest_observations(spark: SparkSession, landed_json: DataFrame, ingest_date: dt.date,
                        root: str | None = None, requested: DataFrame | None = None) -> DataFrame:
    """Macro observation responses → bronze (one dataset, all series);
    series with nothing usable, and those of ``requested(series_id)`` without
    any response, become dead letters."""
    root = root or lake_root(spark)
    rows, rejects = payloads.parse_observations(landed_json)
    bronze.land(rows, root, "macro_series", ingest_date)
    landed = bronze.scan(spark, root, "macro_series", MACRO_BRONZE, ingest_date, arrival=False)
    rejects = _rejected(rejects, requested, landed, "macro", "series_id")
    bronze.write_rejects(rejects, root, ingest_date, "macro")
    return rejects


def ingest_identifiers(spark: SparkSession, landed: DataFrame, ingest_date: dt.date,
                       root: str | None = None, requested: DataFrame | None = None) -> DataFrame:
    """Identifier responses (positionally zipped to their requests) → one
    mapping for the date; unmatched tickers, and those of
    ``requested(ticker)`` without any response, become dead letters."""
    root = root or lake_root(spark)
    rows, rejects = payloads.parse_identifier_responses(landed)
    bronze.land(rows, root, "identifier_map", ingest_date)
    have = bronze.scan(spark, root, "identifier_map", IDENTIFIER_BRONZE, ingest_date, arrival=False)
    rejects = _rejected(rejects, requested, have, "identifiers", "ticker")
    bronze.write_rejects(rejects, root, ingest_date, "identifiers")
    return rejects


def ingest_constituents(spark: SparkSession, pages: DataFrame, ingest_date: dt.date,
                        root: str | None = None) -> DataFrame:
    """Constituents page(s) → dated snapshot (other dates untouched)."""
    root = root or lake_root(spark)
    snap = payloads.parse_constituents_html(pages).withColumn("snapshot_date", F.lit(ingest_date))
    bronze.land(snap, root, "constituents", ingest_date)
    return snap


def constituents_snapshot(spark: SparkSession, ingest_date: dt.date, pages: DataFrame | None = None,
                          refresh: bool = False, root: str | None = None) -> DataFrame:
    """Reuse the date's landed snapshot unless ``refresh`` (or none exists),
    in which case ``pages`` are ingested first.  One row per ticker."""
    root = root or lake_root(spark)
    snap = bronze.scan(spark, root, "constituents", CONSTITUENTS_BRONZE, ingest_date, arrival=False)
    if refresh or snap.isEmpty():
        if pages is None:
            raise ValueError(f"{ingest_date}: neither a landed snapshot nor a page to parse")
        ingest_constituents(spark, pages, ingest_date, root)
    snap = bronze.scan(spark, root, "constituents", CONSTITUENTS_BRONZE, ingest_date)
    from ..operators.dedup import keep_one
    # dealt out first, as in silver.dedup_keep_last
    snap = keep_one(snap.repartition("ticker"), ["ticker"], [F.col(c) for c in bronze.ARRIVAL], last=False)
    return snap.drop(*bronze.ARRIVAL, "ingest_date", "batch")


def write_report(report: DataFrame, root: str, name: str, ingest_date: dt.date, csv: bool = False) -> str:
    """Report sink: a tidy report for the run date as parquet (or CSV), in
    as many files as the report's own partitions."""
    path = f"{root.rstrip('/')}/reports/{name}/ingest_date={ingest_date.isoformat()}"
    w = report.write.mode("overwrite")
    (w.option("header", "true").csv(path) if csv else w.parquet(path))
    return path
