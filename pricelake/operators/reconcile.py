"""Symmetric cross-vendor reconciliation.

One full outer join on (ticker, date) classifies every key as *both*,
*primary only* or *secondary only* — coverage gaps are kept apart from real
disagreements.  Everything else (pairs, consensus, totals, per-ticker
profile, top discrepancies) is a projection or an aggregate over that one
join, so each output costs at most one more shuffle on a small key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PRIMARY, RECONCILIATION_TOLERANCE, SECONDARY
from ..functions import is_flagged, pct_diff


def _side(silver: DataFrame, label: str) -> DataFrame:
    return silver.select("ticker", "date", F.col("adj_close").alias(f"{label}_adj_close"),
                         F.lit(True).alias(f"_in_{label}"))


def match(primary_silver: DataFrame, secondary_silver: DataFrame,
          primary: str = PRIMARY, secondary: str = SECONDARY) -> DataFrame:
    """Full outer join with a match indicator ``_merge`` in
    {'both', 'left_only', 'right_only'} (branches on the side tags, never on
    a value column, so a NULL price cannot move a row between classes)."""
    j = _side(primary_silver, primary).join(_side(secondary_silver, secondary), ["ticker", "date"], "full")
    lp, rp = F.col(f"_in_{primary}"), F.col(f"_in_{secondary}")
    merge = (F.when(lp.isNotNull() & rp.isNotNull(), "both")
             .when(lp.isNotNull(), "left_only").otherwise("right_only"))
    return j.withColumn("_merge", merge).drop(f"_in_{primary}", f"_in_{secondary}")


def pairs(matched: DataFrame, primary: str = PRIMARY, secondary: str = SECONDARY,
          tolerance: float = RECONCILIATION_TOLERANCE) -> DataFrame:
    """Keys present in both vendors, with abs_diff, pct_diff and flagged."""
    a, b = F.col(f"{primary}_adj_close"), F.col(f"{secondary}_adj_close")
    return (matched.where(F.col("_merge") == "both")
            .select("ticker", "date", a, b,
                    F.abs(a - b).alias("abs_diff"),
                    pct_diff(a, b).alias("pct_diff"),
                    is_flagged(a, b, tolerance).alias("flagged")))


def consensus(matched: DataFrame, primary: str = PRIMARY, secondary: str = SECONDARY,
              tolerance: float = RECONCILIATION_TOLERANCE) -> DataFrame:
    """One trusted adj_close per (ticker, date) from either vendor, carrying
    its provenance and outcome.  The primary vendor wins whenever it has the
    key (coverage is the reason, not accuracy)."""
    a, b = F.col(f"{primary}_adj_close"), F.col(f"{secondary}_adj_close")
    m = F.col("_merge")
    both = m == "both"
    return matched.select(
        "ticker", "date",
        F.when(m == "right_only", b).otherwise(a).alias("adj_close"),
        F.when(m == "right_only", F.lit(secondary)).otherwise(F.lit(primary)).alias("primary_source"),
        F.when(both, F.array(F.lit(primary), F.lit(secondary)))
         .when(m == "left_only", F.array(F.lit(primary)))
         .otherwise(F.array(F.lit(secondary))).alias("sources_available"),
        F.when(both, pct_diff(a, b)).alias("pct_diff"),
        F.when(~both, F.lit("single_source"))
         .when(is_flagged(a, b, tolerance), F.lit("disagreed"))
         .otherwise(F.lit("agreed")).alias("reconciliation_flag"),
    )


def totals(matched: DataFrame, primary: str = PRIMARY, secondary: str = SECONDARY,
           tolerance: float = RECONCILIATION_TOLERANCE) -> DataFrame:
    """One-row coverage/discrepancy totals in a single aggregate."""
    a, b = F.col(f"{primary}_adj_close"), F.col(f"{secondary}_adj_close")
    m = F.col("_merge")
    compared = F.count_if(m == "both")
    flagged = F.count_if((m == "both") & is_flagged(a, b, tolerance))
    return matched.agg(
        compared.alias("total_compared"),
        flagged.alias("flagged_count"),
        F.coalesce(F.try_divide(flagged * 100.0, compared), F.lit(0.0)).alias("flagged_pct"),
        F.count_if(m == "left_only").alias(f"{primary}_only_count"),
        F.count_if(m == "right_only").alias(f"{secondary}_only_count"),
    )


def by_ticker(pairs_df: DataFrame) -> DataFrame:
    """Per-ticker discrepancy profile, flagged window fused in (no join).

    A ticker holds at most one row per trading day after de-duplication, so
    an exact median per ticker is bounded by the length of the history;
    groups without such a bound go through ``quantiles.exact_quantiles``.
    """
    flagged = F.col("flagged")
    g = pairs_df.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("rows_compared"),
        F.count_if(flagged).alias("rows_flagged"),
        F.max("pct_diff").alias("max_pct_diff"),
        F.median("pct_diff").alias("median_pct_diff"),
        F.min(F.when(flagged, F.col("date"))).alias("first_flagged"),
        F.max(F.when(flagged, F.col("date"))).alias("last_flagged"),
        F.min("date").alias("first_compared"),
        F.max("date").alias("last_compared"),
    )
    return g.withColumn("flagged_pct", F.col("rows_flagged") * 100.0 / F.col("rows_compared"))


def discrepancy_shape(profile: DataFrame, event_ratio: float = 10.0) -> DataFrame:
    """Label each ticker: 'none' (nothing flagged), 'event' (max well above
    the median — one-off restatement), 'constant' (a steady offset).  The
    ratio is a parameter of this library, not a reference constant."""
    mx, md = F.col("max_pct_diff"), F.col("median_pct_diff")
    shape = (F.when(F.col("rows_flagged") == 0, "none")
             .when(mx > F.lit(event_ratio) * md, "event")
             .otherwise("constant"))
    window_to_end = F.col("last_flagged") == F.col("last_compared")
    return profile.withColumn("shape", shape).withColumn(
        "window_reaches_end", F.when(F.col("rows_flagged") > 0, window_to_end))


def top_discrepancies(pairs_df: DataFrame, n: int = 10) -> DataFrame:
    """Largest flagged discrepancies, infinite ones first (a top-k report:
    the limit is the feature)."""
    return (pairs_df.where("flagged")
            .orderBy(F.col("pct_diff").desc_nulls_last(), "ticker", "date").limit(n))


#: Levels of the coverage report, and the columns that their grouping_id names.
ROLLUP_COLUMNS = ["sector", "ticker", "month", "outcome"]
ROLLUP_SETS = [["sector", "ticker", "month", "outcome"], ["sector", "ticker", "outcome"], ["sector", "month", "outcome"],
               ["sector", "outcome"], ["month", "outcome"], ["outcome"], ["sector"], []]


def coverage_rollup(consensus_df: DataFrame, sectors: DataFrame) -> DataFrame:
    """Coverage and disagreement at every level of ``ROLLUP_SETS`` at once:
    sector, ticker, month (first day), outcome, grouping_id (a bit per column
    that a row sums over, sector first), bars, mean_pct_diff (of finite ones).  ``sectors``: ticker, sector; a ticker
    without one has a NULL sector, which grouping_id tells from a total.

    Bars are summed up to the finest level first, so what is multiplied by
    the number of levels is a row per ticker, month and outcome."""
    pct = F.when(F.abs("pct_diff") < float("inf"), F.col("pct_diff"))
    fine = (consensus_df.groupBy("ticker", F.trunc("date", "month").alias("month"), F.col("reconciliation_flag").alias("outcome"))
            .agg(F.count(F.lit(1)).alias("bars"), F.sum(pct).alias("pct_sum"), F.count(pct).alias("pct_n"))
            .join(sectors.select("ticker", "sector"), "ticker", "left"))
    sets = [[F.col(c) for c in s] for s in ROLLUP_SETS]
    return (fine.groupingSets(sets, *[F.col(c) for c in ROLLUP_COLUMNS])
            .agg(F.grouping_id().alias("grouping_id"), F.sum("bars").alias("bars"),
                 F.try_divide(F.sum("pct_sum"), F.sum("pct_n")).alias("mean_pct_diff")))


def affected(profile: DataFrame) -> DataFrame:
    """k of n tickers with at least one flagged pair."""
    return profile.agg(F.count_if(F.col("rows_flagged") > 0).alias("tickers_affected"),
                       F.count(F.lit(1)).alias("tickers_compared"))


class Reconciliation:
    """All outputs of one reconciliation run over the same matched frame."""

    def __init__(self, primary_silver: DataFrame, secondary_silver: DataFrame,
                 primary: str = PRIMARY, secondary: str = SECONDARY,
                 tolerance: float = RECONCILIATION_TOLERANCE, materialize: bool = False):
        """``materialize=True`` checkpoints the matched frame once, for
        callers that derive several outputs from the same run."""
        self.primary, self.secondary, self.tolerance = primary, secondary, tolerance
        self.matched = match(primary_silver, secondary_silver, primary, secondary)
        if materialize:
            from ..session import cut_lineage
            self.matched = cut_lineage(self.matched)

    def pairs(self) -> DataFrame:
        return pairs(self.matched, self.primary, self.secondary, self.tolerance)

    def flagged(self) -> DataFrame:
        return self.pairs().where("flagged")

    def consensus(self) -> DataFrame:
        return consensus(self.matched, self.primary, self.secondary, self.tolerance)

    def totals(self) -> DataFrame:
        return totals(self.matched, self.primary, self.secondary, self.tolerance)

    def by_ticker(self) -> DataFrame:
        return by_ticker(self.pairs())

    def top(self, n: int = 10) -> DataFrame:
        return top_discrepancies(self.pairs(), n)

    def report_rows(self, top: int = 10) -> DataFrame:
        """The whole report as tidy rows (section, key, metric, value, text):
        headline totals, the profile of every affected ticker with its
        flagged window, and the largest discrepancies."""
        def rows(df, section, key, metrics, texts=()):
            cells = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"),
                              F.lit(None).cast("string").alias("text")) for m in metrics]
            cells += [F.struct(F.lit(m).alias("metric"), F.lit(None).cast("double").alias("value"),
                               c.cast("string").alias("text")) for m, c in texts]
            return df.select(F.lit(section).alias("section"), key.alias("key"), F.explode(F.array(*cells)).alias("c")).select(
                "section", "key", "c.metric", "c.value", "c.text")

        s = self.summary()
        out = rows(s, "totals", F.lit("all"), s.columns)
        window = F.concat_ws("..", F.col("first_flagged").cast("string"), F.col("last_flagged").cast("string"))
        out = out.unionByName(rows(
            self.by_ticker().where("rows_flagged > 0"), "ticker", F.col("ticker"),
            ["rows_flagged", "rows_compared", "flagged_pct", "max_pct_diff", "median_pct_diff"], [("window", window)]))
        return out.unionByName(rows(
            self.top(top), "top", F.concat_ws(" ", "ticker", F.col("date").cast("string")),
            [f"{self.primary}_adj_close", f"{self.secondary}_adj_close", "abs_diff", "pct_diff"]))

    def summary(self) -> DataFrame:
        """Totals plus affected/compared ticker counts, one row."""
        prof = self.by_ticker()
        ticker_counts = affected(prof)
        tot = self.totals()
        # both sides are single-row aggregates: join on a constant key
        return (tot.withColumn("_k", F.lit(1))
                .join(ticker_counts.withColumn("_k", F.lit(1)), "_k").drop("_k"))
