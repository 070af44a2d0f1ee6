"""Gold dimensions: calendar (dim_date) and SCD-2 securities (dim_security)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import date_key, day_name, monday0_weekday, month_name
from ..schemas import DIM_DATE, SCD_ATTRIBUTES
from .dedup import keep_one
from .keys import assign_keys

#: Order of arrival, where a bronze scan exposes it.
ARRIVAL = ("_arrival_batch", "_arrival_file", "_arrival_row")


# ---- dim_date -----------------------------------------------------------

def trading_days(silver: DataFrame) -> DataFrame:
    """Distinct dates on which at least one security has a bar."""
    return silver.select(F.to_date("date").alias("date")).distinct()


def calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Every day in [start, end], generated in parallel (spark.range)."""
    n = (end - start).days + 1
    return spark.range(0, max(n, 0)).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("date"))


def build_dim_date(spark: SparkSession, start: dt.date, end: dt.date,
                   trading: DataFrame) -> DataFrame:
    """Calendar rows with parts and an empirical is_trading_day flag.

    The trading-day set is at most one row per calendar day of the range,
    so joining it is bounded by the calendar itself; AQE picks broadcast at
    runtime when it is small.
    """
    cal = calendar(spark, start, end)
    td = trading.select("date").distinct().withColumn("_t", F.lit(True))
    d = F.col("date")
    return (cal.join(td, "date", "left").select(
        date_key(d).alias("date_key"), d,
        F.year(d).cast("int").alias("year"), F.quarter(d).cast("int").alias("quarter"),
        F.month(d).cast("int").alias("month"), month_name(d).alias("month_name"),
        F.dayofmonth(d).cast("int").alias("day"), monday0_weekday(d).alias("day_of_week"),
        day_name(d).alias("day_name"), (monday0_weekday(d) < 5).alias("is_weekday"),
        F.coalesce(F.col("_t"), F.lit(False)).alias("is_trading_day"))
        .select(*DIM_DATE.fieldNames()))


def refresh_dim_date(existing: DataFrame, incoming: DataFrame, monotone: bool = False) -> DataFrame:
    """Upsert calendar rows: a conflicting date only updates is_trading_day.

    Default: the new flag replaces the old one both ways (a smaller trading
    set can turn true into false).  ``monotone=True`` ORs the flags instead,
    so a partial reload can never narrow the trading days.
    """
    from .upsert import upsert
    if monotone:
        old = existing.select("date_key", F.col("is_trading_day").alias("_old_td"))
        incoming = (incoming.join(old, "date_key", "left")
                    .withColumn("is_trading_day",
                                F.col("is_trading_day") | F.coalesce(F.col("_old_td"), F.lit(False)))
                    .drop("_old_td"))
    return upsert(existing, incoming, ["date_key"], update_cols=["is_trading_day"])


# ---- dim_security: SCD-2 ------------------------------------------------

def _attrs_equal(prefix_a: str, prefix_b: str, attrs: list[str]) -> Column:
    eq = F.lit(True)
    for a in attrs:
        eq = eq & F.col(f"{prefix_a}{a}").eqNullSafe(F.col(f"{prefix_b}{a}"))
    return eq


def prepare_snapshot(constituents: DataFrame, identifier_map: DataFrame | None) -> DataFrame:
    """Snapshot rows with figi left-joined (unmatched keeps NULL figi); the
    first row per ticker in order of arrival, as the scans expose it, else by
    the values, so that reruns agree."""
    def first(df, values):
        order = [c for c in ARRIVAL if c in df.columns] or values
        return keep_one(df, ["ticker"], [F.col(c) for c in order], last=False)

    snap = first(constituents, [c for c in constituents.columns if c != "ticker"])
    if identifier_map is not None:
        ids = first(identifier_map, ["figi"]).select("ticker", "figi")
        snap = snap.drop(*[c for c in ["figi"] if c in snap.columns]).join(ids, "ticker", "left")
    for a in SCD_ATTRIBUTES:
        if a not in snap.columns:
            snap = snap.withColumn(a, F.lit(None).cast("string"))
    return snap.select("ticker", *SCD_ATTRIBUTES)


def apply_snapshot(dim: DataFrame, snapshot: DataFrame, snapshot_date: dt.date | Column,
                   attrs: list[str] = SCD_ATTRIBUTES) -> tuple[DataFrame, DataFrame]:
    """Apply one dated snapshot as an SCD-2 update.

    Returns (new full dimension, per-ticker actions).  Actions: 'new' (ticker
    not current — first seen or returning), 'unchanged', 'changed' (current
    row closed at snapshot_date, new row opened), 'closed' (ticker left the
    snapshot).  A second change on the same day for one ticker is rejected.
    ``dim`` should be a materialised table (a gold-store read or a
    checkpoint): the result references it three times.
    """
    sd = snapshot_date if isinstance(snapshot_date, Column) else F.lit(snapshot_date)
    cur = dim.where("is_current").select(
        "ticker", "security_key", "effective_from", *[F.col(a).alias(f"o_{a}") for a in attrs])
    snap = snapshot.select("ticker", *[F.col(a).alias(f"n_{a}") for a in attrs]).withColumn("_in", F.lit(True))
    j = cur.join(snap, "ticker", "full")
    in_old, in_new = F.col("security_key").isNotNull(), F.col("_in").isNotNull()
    same = _attrs_equal("o_", "n_", attrs)
    action = (F.when(in_new & ~in_old, "new")
              .when(in_new & same, "unchanged")
              .when(in_new, F.when(F.col("effective_from") == sd, F.raise_error(F.lit(
                  "second change for one ticker on the same snapshot date")).cast("string"))
                    .otherwise("changed"))
              .otherwise("closed"))
    actions = j.select("ticker", "security_key", action.alias("action"), *[F.col(c) for c in j.columns
                                                                          if c.startswith("n_")])
    closing = actions.where(F.col("action").isin("changed", "closed")).select("security_key")
    kept = (dim.join(closing.withColumn("_close", F.lit(True)), "security_key", "left")
            .withColumn("effective_to", F.when(F.col("_close"), sd).otherwise(F.col("effective_to")))
            .withColumn("is_current", F.when(F.col("_close"), F.lit(False)).otherwise(F.col("is_current")))
            .drop("_close"))
    opened = actions.where(F.col("action").isin("new", "changed")).select(
        "ticker", *[F.col(f"n_{a}").alias(a) for a in attrs],
        sd.alias("effective_from"), F.lit(None).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"))
    max_key = dim.select(F.max("security_key")).scalar()
    opened = assign_keys(opened, ["effective_from", "ticker"], "security_key",
                         start=F.coalesce(max_key, F.lit(0)) + 1)
    cols = ["security_key", "ticker", *attrs, "effective_from", "effective_to", "is_current"]
    return kept.select(*cols).unionByName(opened.select(*cols)), actions.select("ticker", "action")


def action_counts(actions: DataFrame) -> DataFrame:
    """The load summary of one snapshot application: how many tickers were
    new / changed / closed / unchanged (one row, zeros included)."""
    a = F.col("action")
    return actions.agg(*[F.count_if(a == k).alias(k) for k in ("new", "changed", "closed", "unchanged")])


def empty_dim(spark: SparkSession, attrs: list[str] = SCD_ATTRIBUTES) -> DataFrame:
    fields = ", ".join(f"{a} string" for a in attrs)
    return spark.createDataFrame([], f"security_key int, ticker string, {fields}, "
                                     "effective_from date, effective_to date, is_current boolean")


def scd2_transitions(snapshots: DataFrame, attrs: list[str]) -> DataFrame:
    """Per (ticker, snapshot) transition facts for a bulk rebuild.

    Snapshot dates are indexed once (one row per snapshot date, bounded by
    the calendar); per-ticker windows hold one row per snapshot the ticker is
    in, so no group grows with the number of tickers.
    """
    # one row per ticker and date; between differing copies the values decide,
    # so that reruns agree
    snapshots = keep_one(snapshots, ["ticker", "snapshot_date"],
                         [F.col(c) for c in snapshots.columns if c not in ("ticker", "snapshot_date")], last=False)
    dates = snapshots.select("snapshot_date").distinct()
    idx = dates.select("snapshot_date",
                       F.row_number().over(Window.orderBy("snapshot_date")).alias("idx"),
                       F.lead("snapshot_date").over(Window.orderBy("snapshot_date")).alias("next_snapshot"))
    # one row per snapshot date, at most one a day: bounded by the history
    s = snapshots.join(F.broadcast(idx), "snapshot_date")
    w = Window.partitionBy("ticker").orderBy("idx")
    s = s.withColumn("prev_idx", F.lag("idx").over(w))
    for a in attrs:
        s = s.withColumn(f"p_{a}", F.lag(a).over(w))
    contiguous = F.col("prev_idx") == F.col("idx") - 1
    same = _attrs_equal("p_", "", attrs)
    kind = (F.when(F.col("prev_idx").isNull(), "first_seen")
            .when(~contiguous, "returned")
            .when(~same, "changed").otherwise("unchanged"))
    s = s.withColumn("transition", kind)
    nxt = F.lead("idx").over(w)
    s = s.withColumn("leaves_after", F.col("next_snapshot").isNotNull()
                     & (nxt.isNull() | (nxt != F.col("idx") + 1)))
    return s.drop(*[f"p_{a}" for a in attrs])


def build_scd2_bulk(snapshots: DataFrame, attrs: list[str] = SCD_ATTRIBUTES) -> DataFrame:
    """Full SCD-2 history from every dated snapshot at once (gaps and
    islands); equal to applying the snapshots one by one in date order."""
    s = scd2_transitions(snapshots, attrs)
    w = Window.partitionBy("ticker").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("_version", F.sum(F.when(F.col("transition") != "unchanged", 1).otherwise(0)).over(w))
    v = s.groupBy("ticker", "_version").agg(
        F.min("snapshot_date").alias("effective_from"),
        F.max_by("next_snapshot", "idx").alias("effective_to"),
        *[F.first(a, ignorenulls=False).alias(a) for a in attrs])
    v = v.withColumn("is_current", F.col("effective_to").isNull())
    v = assign_keys(v, ["effective_from", "ticker"], "security_key", start=1)
    return v.select("security_key", "ticker", *attrs, "effective_from", "effective_to", "is_current")


def scd2_summary(snapshots: DataFrame, attrs: list[str] = SCD_ATTRIBUTES) -> DataFrame:
    """Per snapshot date: how many tickers an incremental load would report
    as new / changed / closed / unchanged."""
    s = scd2_transitions(snapshots, attrs)
    per = s.groupBy("snapshot_date").agg(
        F.count_if(F.col("transition").isin("first_seen", "returned")).alias("new"),
        F.count_if(F.col("transition") == "changed").alias("changed"),
        F.count_if(F.col("transition") == "unchanged").alias("unchanged"),
        F.count_if(F.col("transition") == "returned").alias("returned"))
    closed = (s.where("leaves_after").groupBy(F.col("next_snapshot").alias("snapshot_date"))
              .agg(F.count(F.lit(1)).alias("closed")))
    return (per.join(closed, "snapshot_date", "left")
            .withColumn("closed", F.coalesce(F.col("closed"), F.lit(0)).cast("long"))
            .select("snapshot_date", "new", "changed", "closed", "unchanged", "returned"))


def scd2_invariants(dim: DataFrame) -> DataFrame:
    """Constraint checks a database would enforce: at most one current row
    per ticker, unique (ticker, effective_from), non-overlapping intervals,
    effective_to after effective_from.  One row per check with its
    violation count."""
    cur = (dim.where("is_current").groupBy("ticker").count()
           .agg(F.count_if(F.col("count") > 1).alias("v")))
    uniq = (dim.groupBy("ticker", "effective_from").count()
            .agg(F.count_if(F.col("count") > 1).alias("v")))
    w = Window.partitionBy("ticker").orderBy("effective_from")
    ov = (dim.withColumn("_next_from", F.lead("effective_from").over(w))
          .agg(F.count_if(F.col("_next_from").isNotNull()
                          & (F.col("effective_to").isNull() | (F.col("effective_to") > F.col("_next_from"))))
               .alias("v")))
    order = dim.agg(F.count_if(F.col("effective_to") <= F.col("effective_from")).alias("v"))

    def row(name, df):
        return df.select(F.lit(name).alias("check_name"), F.col("v").cast("long").alias("violations"))
    return (row("one current row per ticker", cur)
            .unionByName(row("unique (ticker, effective_from)", uniq))
            .unionByName(row("no overlapping intervals", ov))
            .unionByName(row("effective_to after effective_from", order)))
