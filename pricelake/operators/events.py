"""Discrepancy events: when two vendors disagree, from when to when, how much.

A profile says that a ticker has flagged days between a first and a last one;
two separate restatements read there as one long window.  ``discrepancy_events``
cuts the flagged days into islands by the trading calendar.  ``segments`` does
without the flags: it cuts a ticker's signed differences where their level
changes, by exact least-squares partitioning.

A ticker has one row per trading day, so its windows and groups are bounded by
the calendar, however many tickers there are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import PRIMARY, RECONCILIATION_TOLERANCE, SECONDARY

#: A boundary between two levels must save as much squared difference as a
#: shift by the tolerance on so many days.
DAYS_TO_PAY = 4


def signed_diff(a: Column, b: Column) -> Column:
    """(a - b) relative to the mean of both; NULL where that is zero or a
    price is missing."""
    return F.try_divide(a - b, (a + b) / 2)


def trading_index(trading: DataFrame) -> DataFrame:
    """(date, day_no): trading days numbered from 1.  One row a day: the only
    unpartitioned window here is bounded by the calendar."""
    return trading.select("date").distinct().where("date IS NOT NULL").withColumn(
        "day_no", F.row_number().over(Window.orderBy("date")))


def discrepancy_events(pairs: DataFrame, trading: DataFrame, gap: int = 1,
                       primary: str = PRIMARY, secondary: str = SECONDARY) -> DataFrame:
    """One row per event: a ticker's flagged days of which each is at most
    ``gap`` trading days after the one before (1: the next trading day, so
    weekends and holidays do not end an event, a day in agreement does).

    ticker, event_no (by date), start, end, days_flagged, days_spanned (trading
    days), max_pct_diff, mean_diff (signed), mean_shift (against the ticker's
    days outside events; NULL without any) and kind, by where the event lies in
    the ticker's compared days: "constant" (all of them), "until" (from the
    first: one vendor restated what was before), "since" (to the last) or
    "window".  Days outside the calendar are left out."""
    day = trading_index(trading)
    x = signed_diff(F.col(f"{primary}_adj_close"), F.col(f"{secondary}_adj_close"))
    p = pairs.select("ticker", "date", "flagged", "pct_diff", x.alias("x")).join(F.broadcast(day), "date")
    of = Window.partitionBy("ticker")
    order = of.orderBy("day_no")
    p = p.withColumns({
        "first_no": F.min("day_no").over(of), "last_no": F.max("day_no").over(of),
        "outside": F.avg(F.when(~F.col("flagged"), F.col("x"))).over(of)}).where("flagged")
    begins = F.coalesce(F.col("day_no") - F.lag("day_no").over(order) > gap, F.lit(True))
    p = p.withColumn("begins", begins.cast("int")).withColumn("event_no", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    e = p.groupBy("ticker", "event_no").agg(
        F.min("date").alias("start"), F.max("date").alias("end"), F.count(F.lit(1)).alias("days_flagged"),
        (F.max("day_no") - F.min("day_no") + 1).alias("days_spanned"), F.max("pct_diff").alias("max_pct_diff"),
        F.avg("x").alias("mean_diff"), F.first("outside").alias("outside"),
        (F.min("day_no") == F.first("first_no")).alias("from_first"), (F.max("day_no") == F.first("last_no")).alias("to_last"))
    kind = (F.when(F.col("from_first") & F.col("to_last"), "constant").when(F.col("from_first"), "until")
            .when(F.col("to_last"), "since").otherwise("window"))
    return e.select("ticker", "event_no", "start", "end", "days_flagged", "days_spanned", "max_pct_diff", "mean_diff",
                    (F.col("mean_diff") - F.col("outside")).alias("mean_shift"), kind.alias("kind"))


# ---- levels -------------------------------------------------------------------

def partition(x: np.ndarray, penalty: float) -> list[int]:
    """First positions of the segments that minimise the squared distance from
    the segments' means plus ``penalty`` a segment.  Exact: the best partition
    of every prefix, of equal ones the one with the longest last segment; a
    start goes once it costs more than the best even without its penalty,
    since it can never win again."""
    n = len(x)
    s1, s2 = np.append(0.0, np.cumsum(x)), np.append(0.0, np.cumsum(x * x))
    best, back = np.zeros(n + 1), np.zeros(n + 1, np.int64)
    starts = np.zeros(0, np.int64)
    for j in range(1, n + 1):
        starts = np.append(starts, j - 1)
        sums = s1[j] - s1[starts]
        cost = best[starts] + (s2[j] - s2[starts] - sums * sums / (j - starts))
        k = int(np.argmin(cost))
        best[j], back[j] = cost[k] + penalty, starts[k]
        starts = starts[cost <= best[j]]
    out, j = [], n
    while j > 0:
        j = int(back[j])
        out.append(j)
    return out[::-1]


def segments(pairs: DataFrame, tolerance: float = RECONCILIATION_TOLERANCE, days_to_pay: float = DAYS_TO_PAY,
             primary: str = PRIMARY, secondary: str = SECONDARY) -> DataFrame:
    """One row per level of a ticker's signed differences: ticker, segment_no,
    start, end, days, mean_diff, shift (from the level before; NULL for the
    first) and kind ("agreement" if the level is within the tolerance, else
    "offset").  Days without a finite difference are left out."""
    penalty = days_to_pay * tolerance * tolerance
    x = signed_diff(F.col(f"{primary}_adj_close"), F.col(f"{secondary}_adj_close"))

    def levels(ticker: pd.DataFrame) -> pd.DataFrame:
        t = ticker.sort_values("date", ignore_index=True)
        values = t["x"].to_numpy(np.float64)
        at = partition(values, penalty)
        ends = [*at[1:], len(values)]
        mean = [float(values[i:j].mean()) for i, j in zip(at, ends)]
        return pd.DataFrame({
            "ticker": t["ticker"].iloc[0], "segment_no": range(1, len(at) + 1), "start": t["date"].iloc[at].to_numpy(),
            "end": t["date"].iloc[[j - 1 for j in ends]].to_numpy(), "days": [j - i for i, j in zip(at, ends)], "mean_diff": mean,
            "shift": [None, *[b - a for a, b in zip(mean, mean[1:])]]})

    found = (pairs.select("ticker", "date", x.alias("x")).where("x IS NOT NULL AND NOT isnan(x)")
             .groupBy("ticker").applyInPandas(
                 levels, "ticker string, segment_no long, start date, end date, days long, mean_diff double, shift double"))
    return found.withColumns({"shift": F.when(~F.isnan("shift"), F.col("shift")),
                              "kind": F.when(F.abs("mean_diff") <= tolerance, "agreement").otherwise("offset")})
