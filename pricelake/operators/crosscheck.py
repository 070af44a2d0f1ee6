"""Membership cross-check by normalised company name (a heuristic match;
whatever stays unmatched is reported, never auto-corrected)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import normalize_company_name


def unmatched_list(members: DataFrame, holdings: DataFrame) -> DataFrame:
    """Members whose normalised name matches neither a holding's name nor
    its title."""
    known = (holdings.select(normalize_company_name("name").alias("_norm"))
             .union(holdings.select(normalize_company_name("title").alias("_norm"))).distinct())
    m = members.withColumn("_norm", normalize_company_name("company_name"))
    return m.join(known, "_norm", "left_anti").drop("_norm")


def unmatched_holdings(members: DataFrame, holdings: DataFrame) -> DataFrame:
    """Holdings whose name AND title are both unknown: two chained anti
    joins, one per key (a disjunctive join condition would be a nested loop)."""
    names = members.select(normalize_company_name("company_name").alias("_k")).distinct()
    h = (holdings.withColumn("_n", normalize_company_name("name"))
         .withColumn("_t", normalize_company_name("title")))
    h = h.join(names.withColumnRenamed("_k", "_n"), "_n", "left_anti")
    h = h.join(names.withColumnRenamed("_k", "_t"), "_t", "left_anti")
    return h.drop("_n", "_t")


def summary(members: DataFrame, holdings: DataFrame) -> DataFrame:
    """Counts; matched = members − unmatched members.  Empty normalised
    names match each other, so their number is reported too.

    Both sides are normalised once and collapsed to distinct names with
    counts; the joins then move names, not rows."""
    m = (members.groupBy(normalize_company_name("company_name").alias("k")).agg(F.count(F.lit(1)).alias("n")))
    h = holdings.groupBy(normalize_company_name("name").alias("a"), normalize_company_name("title").alias("b")).agg(
        F.count(F.lit(1)).alias("n"))
    known = h.select(F.explode(F.array("a", "b")).alias("k")).distinct().withColumn("known", F.lit(True))
    names = m.select("k", F.lit(True).alias("member"))
    per_name = m.join(known, "k", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("list_count"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("unmatched_list"),
        F.coalesce(F.sum(F.when(F.col("k") == "", F.col("n"))), F.lit(0)).alias("empty_names"), F.lit(1).alias("_k"))
    both = (h.join(names.withColumnRenamed("k", "a").withColumnRenamed("member", "by_name"), "a", "left")
            .join(names.withColumnRenamed("k", "b").withColumnRenamed("member", "by_title"), "b", "left"))
    per_holding = both.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("holdings_count"),
        F.coalesce(F.sum(F.when(F.col("by_name").isNull() & F.col("by_title").isNull(), F.col("n"))), F.lit(0)).alias("unmatched_holdings"),
        F.lit(1).alias("_k"))
    # two single-row aggregates side by side
    return per_name.join(per_holding, "_k").withColumn("matched", F.col("list_count") - F.col("unmatched_list")).select(
        "list_count", "holdings_count", "matched", "unmatched_list", "unmatched_holdings", "empty_names")
