"""Gold fact loaders: dimension key resolution with counted skips, typed
fact rows, and the checks a database would enforce (FK, PK)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MAX_STALENESS_DAYS, MIN_CONSENSUS_ROWS_PER_SECURITY, MIN_SECURITIES, PRIMARY
from ..functions import to_decimal


def current_security_keys(dim_security: DataFrame) -> DataFrame:
    return dim_security.where("is_current").select("ticker", "security_key")


def resolve_keys(df: DataFrame, dim_date: DataFrame, dim_security: DataFrame | None) -> DataFrame:
    """Attach date_key (by calendar date) and, when a security dimension is
    given, the *current* security_key (by ticker).  Unresolved keys stay
    NULL so they can be counted; both dimension sides are at most one row
    per day / per ticker; the calendar is broadcast."""
    # the calendar has a row per day: bounded by the history, not the data
    out = df.withColumn("date", F.to_date("date")).join(
        F.broadcast(dim_date.select("date", "date_key")), "date", "left")
    if dim_security is not None:
        out = out.join(current_security_keys(dim_security), "ticker", "left")
    return out


def load_counts(resolved: DataFrame, table: str, with_security: bool = True) -> DataFrame:
    """loaded / skipped_no_security_key / skipped_no_date_key in one pass.
    The two skip counts are independent and may overlap."""
    dk = F.col("date_key").isNull()
    sk = F.col("security_key").isNull() if with_security else F.lit(False)
    return resolved.agg(
        F.lit(table).alias("table"),
        F.count_if(~dk & ~sk).alias("loaded"),
        F.count_if(sk).alias("skipped_no_security_key"),
        F.count_if(dk).alias("skipped_no_date_key"))


def _resolved_only(resolved: DataFrame, with_security: bool = True) -> DataFrame:
    cond = F.col("date_key").isNotNull()
    if with_security:
        cond = cond & F.col("security_key").isNotNull()
    return resolved.where(cond)


def unresolved(df: DataFrame, dim_date: DataFrame, dim_security: DataFrame | None) -> DataFrame:
    """Rows that find no security or no date, with the reason."""
    r = resolve_keys(df, dim_date, dim_security)
    no_security = F.col("security_key").isNull() if dim_security is not None else F.lit(False)
    reason = F.when(no_security, "no security").when(F.col("date_key").isNull(), "no calendar date")
    return r.withColumn("reason", reason).where("reason IS NOT NULL").select(*df.columns, "reason")


def fact_price_daily(silver: DataFrame, source: str, dim_date: DataFrame,
                     dim_security: DataFrame, resolve=resolve_keys) -> tuple[DataFrame, DataFrame]:
    """(fact rows, load counts) at (security, date, source) grain.  ``resolve``:
    ``resolve_keys`` or ``resolve_keys_as_of``."""
    r = resolve(silver, dim_date, dim_security)
    prices = ["open", "high", "low", "close", "adj_open", "adj_high", "adj_low", "adj_close"]
    rows = _resolved_only(r).select(
        "security_key", "date_key", F.lit(source).alias("source"),
        *[to_decimal(c).alias(c) for c in prices],
        F.col("volume").cast("long").alias("volume"), F.col("adj_volume").cast("long").alias("adj_volume"))
    return rows, load_counts(r, f"fact_price_daily:{source}")


def fact_price_daily_sources(silver: DataFrame, dim_date: DataFrame,
                             dim_security: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``fact_price_daily`` for several vendors at once (``silver`` carries
    their ``source``): keys are resolved in one pass, counts come per source."""
    r = resolve_keys(silver, dim_date, dim_security)
    prices = ["open", "high", "low", "close", "adj_open", "adj_high", "adj_low", "adj_close"]
    rows = _resolved_only(r).select(
        "security_key", "date_key", "source", *[to_decimal(c).alias(c) for c in prices],
        F.col("volume").cast("long").alias("volume"), F.col("adj_volume").cast("long").alias("adj_volume"))
    dk, sk = F.col("date_key").isNull(), F.col("security_key").isNull()
    counts = r.groupBy(F.concat(F.lit("fact_price_daily:"), F.col("source")).alias("table")).agg(
        F.count_if(~dk & ~sk).alias("loaded"), F.count_if(sk).alias("skipped_no_security_key"),
        F.count_if(dk).alias("skipped_no_date_key"))
    return rows, counts


def resolve_keys_as_of(df: DataFrame, dim_date: DataFrame, dim_security: DataFrame) -> DataFrame:
    """Like ``resolve_keys``, but with the security_key of the version that
    was valid on the row's date, whatever became of the ticker since.
    ``key_status`` says why there is none: "unknown" ticker, "not yet" (before
    its first version) or "gone" (out of the universe on that day)."""
    from .asof import as_of
    out = df.withColumn("date", F.to_date("date")).join(
        F.broadcast(dim_date.select("date", "date_key")), "date", "left")
    out = as_of(out, dim_security, "ticker", "date", "effective_from", "effective_to", ["security_key"], status="key_status")
    known = dim_security.select("ticker").distinct().withColumn("_known", F.lit(True))
    status = (F.when(F.col("key_status") != "none", F.when(F.col("key_status") == "expired", "gone").otherwise("valid"))
              .when(F.col("_known"), "not yet").otherwise("unknown"))
    return out.join(known, "ticker", "left").withColumn("key_status", status).drop("_known")


def fact_price_daily_as_of(silver: DataFrame, dim_date: DataFrame, dim_security: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fact rows, load counts) for several vendors (``silver`` carries their
    ``source``), each bar under the security's version of its own day.  Counts
    come per source and key status; rows of a day outside the calendar are
    counted as skipped whatever their status."""
    r = resolve_keys_as_of(silver, dim_date, dim_security)
    prices = ["open", "high", "low", "close", "adj_open", "adj_high", "adj_low", "adj_close"]
    rows = _resolved_only(r).select(
        "security_key", "date_key", "source", *[to_decimal(c).alias(c) for c in prices],
        F.col("volume").cast("long").alias("volume"), F.col("adj_volume").cast("long").alias("adj_volume"))
    counts = r.groupBy("source", "key_status").agg(
        F.count(F.lit(1)).alias("bars"), F.count_if(F.col("date_key").isNull()).alias("skipped_no_date_key"),
        F.count_if(F.col("date_key").isNotNull() & F.col("security_key").isNotNull()).alias("loaded"))
    return rows, counts


def fact_consensus(consensus: DataFrame, dim_date: DataFrame,
                   dim_security: DataFrame, resolve=resolve_keys) -> tuple[DataFrame, DataFrame]:
    r = resolve(consensus, dim_date, dim_security)
    rows = _resolved_only(r).select(
        "security_key", "date_key", to_decimal("adj_close").alias("adj_close"),
        "primary_source", "sources_available", to_decimal("pct_diff", 9, 6).alias("pct_diff"),
        "reconciliation_flag")
    return rows, load_counts(r, "fact_price_daily_consensus")


# FIXED VALUES: action columns and their action_type labels.
ACTION_COLUMNS = [("dividends", "dividend"), ("stock_splits", "split")]


def corporate_actions(bronze: DataFrame) -> DataFrame:
    """Sparse (ticker, date, action_type, value) rows: the dividends and
    stock_splits columns unpivoted, zero/NULL dropped.  Either column may be
    absent."""
    present = [(c, label) for c, label in ACTION_COLUMNS if c in bronze.columns]
    if not present:
        return bronze.sparkSession.createDataFrame(
            [], "ticker string, date date, action_type string, value double")
    stacked = bronze.select(
        "ticker", F.to_date("date").alias("date"),
        F.explode(F.array(*[F.struct(F.lit(label).alias("action_type"),
                                     F.col(c).cast("double").alias("value")) for c, label in present]))
        .alias("a"))
    return (stacked.select("ticker", "date", "a.action_type", "a.value")
            .where(F.coalesce(F.col("value"), F.lit(0.0)) != 0))


def fact_corporate_action(bronze: DataFrame, dim_date: DataFrame, dim_security: DataFrame,
                          source: str = PRIMARY, resolve=resolve_keys) -> tuple[DataFrame, DataFrame]:
    r = resolve(corporate_actions(bronze), dim_date, dim_security)
    rows = _resolved_only(r).select(
        "security_key", "date_key", "action_type", to_decimal("value").alias("value"),
        F.lit(source).alias("source"))
    return rows, load_counts(r, "fact_corporate_action")


def fact_macro_rate(series: DataFrame, dim_date: DataFrame) -> tuple[DataFrame, DataFrame]:
    r = resolve_keys(series, dim_date, None)
    rows = _resolved_only(r, with_security=False).select(
        "date_key", "series_id", to_decimal("value").alias("value"))
    return rows, load_counts(r, "fact_macro_rate", with_security=False)


# ---- constraint checks --------------------------------------------------

def fk_orphans(fact: DataFrame, table: str, dim_date: DataFrame,
               dim_security: DataFrame | None) -> DataFrame:
    """Rows whose keys have no dimension row (anti-joins, counted)."""
    d = fact.join(F.broadcast(dim_date.select("date_key")), "date_key", "left_anti").agg(
        F.count(F.lit(1)).alias("n"))
    out = d.select(F.lit(table).alias("table"), F.lit("date_key").alias("fk"), F.col("n").alias("orphans"))
    if dim_security is not None:
        s = fact.join(dim_security.select("security_key"), "security_key", "left_anti").agg(
            F.count(F.lit(1)).alias("n"))
        out = out.unionByName(s.select(F.lit(table).alias("table"), F.lit("security_key").alias("fk"),
                                       F.col("n").alias("orphans")))
    return out


def pk_duplicates(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Number of primary-key values held by more than one row."""
    return (df.groupBy(*keys).count().agg(F.count_if(F.col("count") > 1).alias("n"))
            .select(F.lit(table).alias("table"), F.col("n").alias("duplicate_keys")))


def freshness(dim_security: DataFrame, consensus_fact: DataFrame, dim_date: DataFrame,
              ingest_date: dt.date | Column, min_securities: int = MIN_SECURITIES,
              min_rows_per_security: int = MIN_CONSENSUS_ROWS_PER_SECURITY,
              max_staleness_days: int = MAX_STALENESS_DAYS) -> DataFrame:
    """Gold gate: enough current securities, enough consensus rows per
    security, newest consensus date 0..max days before the ingest date
    (a future or absent date fails).  One row per check."""
    ing = ingest_date if isinstance(ingest_date, Column) else F.lit(ingest_date)
    secs = dim_security.where("is_current").agg(F.count(F.lit(1)).alias("securities"))
    # counted per date first, so the join is a calendar wide
    per_date = consensus_fact.groupBy("date_key").agg(F.count(F.lit(1)).alias("n"))
    cons = per_date.join(F.broadcast(dim_date.select("date_key", "date")), "date_key").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("consensus_rows"), F.max("date").alias("max_date"))
    j = secs.withColumn("_k", F.lit(1)).join(cons.withColumn("_k", F.lit(1)), "_k")
    per = F.coalesce(F.try_divide(F.col("consensus_rows").cast("double"), F.col("securities")), F.lit(0.0))
    stale = F.datediff(ing, F.col("max_date"))
    checks = F.array(
        F.struct(F.lit(f"security count >= {min_securities}").alias("check_name"),
                 (F.col("securities") >= min_securities).alias("passed"),
                 F.col("securities").cast("double").alias("observed")),
        F.struct(F.lit(f"consensus rows/security >= {min_rows_per_security}").alias("check_name"),
                 (per >= min_rows_per_security).alias("passed"), per.alias("observed")),
        F.struct(F.lit(f"latest data within {max_staleness_days} days of ingest_date").alias("check_name"),
                 F.coalesce(stale.between(0, max_staleness_days), F.lit(False)).alias("passed"),
                 stale.cast("double").alias("observed")),
    )
    return j.select(F.inline(checks))
