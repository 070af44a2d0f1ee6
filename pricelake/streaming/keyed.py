"""Streams that hold state per bar: what a re-delivery supersedes, and the
reconciliation of two vendor streams as they arrive.

``superseded_stream`` keeps, per (ticker, date), the newest arrival and how
many came before it, so a late or repeated bar is counted as superseded in
whatever micro-batch it comes: the counts add up to what keep-last over all
landings drops.  ``reconciled_stream`` joins two vendors' bars in full; a pair
is given out when its second side arrives, a bar of one vendor alone once both
streams have passed its day.

State is expired by watermarks: of the landing's ingest date for supersession
(a full re-pull brings old bars in new landings, so a bar's own date says
nothing), of the bar's date for the join.  At scale, run with the RocksDB state
store (``spark.sql.streaming.stateStore.providerClass``), so that state is not
held in memory.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import PRIMARY, RECONCILIATION_TOLERANCE, SECONDARY
from ..functions import nan_to_null
from ..operators import quality
from ..operators import reconcile as rec
from ..schemas import PRIMARY_BRONZE, SECONDARY_BRONZE
from ..session import lake_root
from ..sources import bronze, fs
from .bronze_stream import price_stream, stream_folder

#: Days after its last arrival at which a bar's state goes.
KEEP_DAYS = 30
DAY_MS = 86_400_000
#: Buckets of tickers that share a row of state per month; fixed for the life
#: of a stream's checkpoint.  At 100,000 tickers a row holds 400 bars.
BUCKETS = 8192
ORDER = ["ingest_date", "_arrival_batch", "_arrival_file", "_arrival_row"]
SCHEMAS = {PRIMARY: PRIMARY_BRONZE, SECONDARY: SECONDARY_BRONZE}
#: Ticker of the rows that only move a stream's time on.
HEARTBEAT = "~heartbeat"


# ---- supersession -------------------------------------------------------------

def superseded_stream(rows: DataFrame, keep_days: int = KEEP_DAYS) -> DataFrame:
    """Per micro-batch and bar that arrived in it: ticker, date, landed (rows),
    superseded (of these or of former ones, replaced by a newer arrival), late
    (rows that were older than one already seen) and first (no state before).
    ``rows`` is a stream of landed bars with their arrival order; rows without
    a key are left out.  A call of Python serves a month's bars of one bucket of
    tickers, since a call costs far more than a bar; each bar has its own
    arrival and its own time to go in the bucket's state."""
    def arrive(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        held = {}
        if state.exists:
            files, *bars = state.get
            held = {(ticker, bar): (day, batch, files[file], row, until)
                    for ticker, bar, day, batch, file, row, until in zip(*bars, strict=True)}
        came: dict[tuple, list] = {}
        if not state.hasTimedOut:
            for got in batches:
                for ticker, bar, *order in zip(*[got[c].tolist() for c in ("ticker", "bar", *ORDER)], strict=True):
                    came.setdefault((ticker, bar), []).append(tuple(order))
        out = []
        for at, orders in came.items():
            before = held[at][:4] if at in held else None
            newest = max(orders) if before is None else max(*orders, before)
            held[at] = (*newest, max((newest[0] + keep_days) * DAY_MS, now + 1))
            out.append((*at, len(orders), len(orders) - (before is None),
                        sum(o < before for o in orders) if before else 0, before is None))
        # a bar that is not in this micro-batch goes when its own time is up
        held = {at: h for at, h in held.items() if at in came or h[4] >= now}
        if held:
            files = sorted({h[2] for h in held.values()})
            place = {f: i for i, f in enumerate(files)}
            bars = [(*at, day, batch, place[file], row, until) for at, (day, batch, file, row, until) in held.items()]
            state.update((files, *map(list, zip(*bars, strict=True))))
            state.setTimeoutTimestamp(max(min(h[4] for h in held.values()), now + 1))
        else:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["ticker", "bar", "landed", "superseded", "late", "first"])

    bar = F.to_date("date")
    keyed = (rows.where("ticker IS NOT NULL AND date IS NOT NULL")
             .select(F.pmod(F.xxhash64("ticker"), F.lit(BUCKETS)).alias("bucket"), F.trunc(bar, "month").alias("month"),
                     "ticker", F.unix_date(bar).alias("bar"), F.unix_date("ingest_date").alias("ingest_date"), *ORDER[1:],
                     F.col("ingest_date").cast("timestamp").alias("arrived"))
             .withWatermark("arrived", f"{keep_days} days"))
    per = keyed.groupBy("bucket", "month").applyInPandasWithState(
        arrive, "ticker string, bar int, landed long, superseded long, late long, first boolean",
        "files array<string>, tickers array<string>, bars array<long>, days array<long>, batches array<long>, "
        "file array<long>, rows array<long>, until array<long>", "update", GroupStateTimeout.EventTimeTimeout)
    return per.select("ticker", F.date_from_unix_date("bar").alias("date"), "landed", "superseded", "late", "first")


def run_superseded_stream(spark: SparkSession, source: str, root: str | None = None, max_files: int | None = None,
                          keep_days: int = KEEP_DAYS, checkpoint: str | None = None):
    """Count what each new landing of ``source`` supersedes (availableNow).
    Rows that break a rule by themselves are left to the gate.  Every
    micro-batch has a folder of its own, so a replayed one replaces its own."""
    root = root or lake_root(spark)
    dataset = f"{source}_prices"
    rows = price_stream(spark, root, dataset, SCHEMAS[source], max_files)
    rows = rows.where(quality.row_violation(quality.price_rules()).isNull())
    q = (superseded_stream(rows, keep_days).writeStream.outputMode("update")
         .foreachBatch(lambda df, epoch: fs.replace(df, root, f"{stream_folder(root, 'superseded', source)}/epoch_id={epoch}"))
         .option("checkpointLocation", checkpoint or f"{root}/_streams/{dataset}-superseded")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def superseded_counts(spark: SparkSession, source: str, root: str | None = None) -> DataFrame:
    """Per ticker over all micro-batches so far: landed, superseded, late, kept."""
    per = spark.read.parquet(stream_folder(root or lake_root(spark), "superseded", source))
    return per.groupBy("ticker").agg(*[F.sum(c).alias(c) for c in ("landed", "superseded", "late")],
                                     F.sum(F.col("landed") - F.col("superseded")).alias("kept"))


# ---- stream-stream reconciliation ---------------------------------------------

def reconciled_stream(primary_rows: DataFrame, secondary_rows: DataFrame, delay: str = "7 days",
                      primary: str = PRIMARY, secondary: str = SECONDARY) -> DataFrame:
    """The full outer join of two streams of bars on ticker and day, as
    ``reconcile.match`` gives it (ticker, date, both prices, _merge).  Of a bar
    that one vendor repeats within ``delay`` the first arrival counts.  Bars
    that come more than ``delay`` behind their stream's newest day are late and
    left out; what is late the batch reconciliation still sees."""
    def side(rows, label):
        typed = rows.where("ticker IS NOT NULL AND date IS NOT NULL").select(
            F.col("ticker").alias(f"{label}_ticker"), F.to_date("date").cast("timestamp").alias(f"{label}_day"),
            nan_to_null(F.col("adj_close").cast("double")).alias(f"{label}_adj_close"))
        return typed.withWatermark(f"{label}_day", delay).dropDuplicatesWithinWatermark([f"{label}_ticker", f"{label}_day"])

    def col(c, label):
        return F.col(f"{label}_{c}")

    j = side(primary_rows, primary).join(
        side(secondary_rows, secondary),
        (col("ticker", primary) == col("ticker", secondary)) & (col("day", primary) == col("day", secondary)), "full_outer")
    merge = (F.when(col("ticker", primary).isNotNull() & col("ticker", secondary).isNotNull(), "both")
             .when(col("ticker", primary).isNotNull(), "left_only").otherwise("right_only"))
    return j.select(F.coalesce(col("ticker", primary), col("ticker", secondary)).alias("ticker"),
                    F.coalesce(col("day", primary), col("day", secondary)).cast("date").alias("date"),
                    f"{primary}_adj_close", f"{secondary}_adj_close", merge.alias("_merge"))


def heartbeat(spark: SparkSession, root: str, source: str, ingest_date: dt.date, day: dt.date, batch: int = 0) -> None:
    """Land a row that moves the time of ``source``'s stream on to ``day``: on
    a quiet day, bars of the other vendor alone would wait for the next one.
    No load takes it for a bar, since no security has its ticker."""
    one = spark.createDataFrame([(HEARTBEAT, day)], "ticker string, date date")
    values = [F.lit(HEARTBEAT).alias("ticker") if f.name == "ticker" else F.col("date") if f.name == "date"
              else F.lit(1).cast(f.dataType).alias(f.name) for f in SCHEMAS[source].fields]
    bronze.land(one.select(*values), root, f"{source}_prices", ingest_date, batch)


def run_reconciled_stream(spark: SparkSession, root: str | None = None, delay: str = "7 days", max_files: int | None = None,
                          primary: str = PRIMARY, secondary: str = SECONDARY, gated: tuple[str, ...] = (PRIMARY,)):
    """Reconcile what is new in both vendors' landings (availableNow); vendors
    in ``gated`` without the rows that break a rule by themselves."""
    root = root or lake_root(spark)

    def rows(source):
        r = price_stream(spark, root, f"{source}_prices", SCHEMAS[source], max_files)
        return r.where(quality.row_violation(quality.price_rules()).isNull()) if source in gated else r

    q = (reconciled_stream(rows(primary), rows(secondary), delay, primary, secondary).writeStream.outputMode("append")
         .foreachBatch(lambda df, epoch: fs.replace(df.where(F.col("ticker") != HEARTBEAT), root,
                                                    f"{stream_folder(root, 'reconciled', primary)}/epoch_id={epoch}"))
         .option("checkpointLocation", f"{root}/_streams/{primary}-{secondary}-reconciled")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def reconciled(spark: SparkSession, root: str | None = None, primary: str = PRIMARY) -> DataFrame:
    """What the stream has matched or given up waiting for so far."""
    return spark.read.parquet(stream_folder(root or lake_root(spark), "reconciled", primary)).drop("epoch_id")


def stream_pairs(spark: SparkSession, root: str | None = None, primary: str = PRIMARY, secondary: str = SECONDARY,
                 tolerance: float = RECONCILIATION_TOLERANCE) -> DataFrame:
    """``reconcile.pairs`` over the stream's matches."""
    return rec.pairs(reconciled(spark, root, primary), primary, secondary, tolerance)
