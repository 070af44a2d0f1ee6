"""Work planning over key lists: batches, stratified samples, resumable
work-lists, and a request-budget audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import SECONDARY_HOURLY_CAP
from .keys import assign_keys, running_total


def batch_plan(keys: DataFrame, size: int, key: str = "ticker") -> DataFrame:
    """(batch_id, position, key): fixed-size batches in key order.  The rank
    is computed distributed (no single-task window)."""
    k = assign_keys(keys.select(key).distinct(), [key], "position", start=0)
    return k.select((F.col("position") / size).cast("long").alias("batch_id"),
                    F.col("position").cast("long").alias("position"), key)


def stratified_sample(universe: DataFrame, n: int, stratum: str = "gics_sector",
                      key: str = "ticker", seed: int = 42, salt_buckets: int = 64) -> DataFrame:
    """Round-robin across strata in sorted stratum order, each stratum in a
    seeded pseudo-random order; rows with a NULL stratum are never drawn.
    If ``n`` covers the universe, every key is returned.

    A stratum may hold a third of the universe, so its rank is found in two
    bounded steps: the first ``n`` of every (stratum, salt) sub-group, then
    the first ``n`` of the stratum among those at most n × ``salt_buckets``
    candidates — exact, because a stratum's first n are always among the
    first n of their own sub-groups.  Each ``rank <= n`` filter is pushed
    below its shuffle (window group limit).  The final top-n is a
    TakeOrderedAndProject: the limit is the sampling feature.
    """
    u = universe.select(key, stratum).dropDuplicates([key])
    total = u.select(F.count(F.lit(1))).scalar()
    order = [F.col("_o"), F.col(key)]
    cand = (u.where(F.col(stratum).isNotNull())
            .withColumn("_o", F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))))
            .withColumn("_salt", F.pmod(F.hash(F.col(key)), F.lit(salt_buckets)))
            .withColumn("_r1", F.row_number().over(Window.partitionBy(stratum, "_salt").orderBy(*order)))
            .where(F.col("_r1") <= n))
    ranked = (cand.withColumn("_rn", F.row_number().over(Window.partitionBy(stratum).orderBy(*order)))
              .where(F.col("_rn") <= n))
    picked = ranked.orderBy("_rn", stratum).limit(n).select(key).where(total > F.lit(n))
    everything = u.select(key).where(total <= F.lit(n))
    return picked.unionByName(everything).orderBy(key)


def resume_worklist(requested: DataFrame, landed: DataFrame, force: bool = False,
                    key: str = "ticker") -> DataFrame:
    """Which requested keys still need fetching for this run date: every
    key when ``force``; otherwise only keys not already landed.  Landed keys
    are reported too (their rows are reused, not re-fetched)."""
    req = requested.select(key).distinct()
    if force:
        return req.withColumn("status", F.lit("to_fetch"))
    have = landed.select(key).distinct()
    todo = req.join(have, key, "left_anti").withColumn("status", F.lit("to_fetch"))
    done = req.join(have, key, "left_semi").withColumn("status", F.lit("landed"))
    return todo.unionByName(done)


def trailing_hour_budget(log: DataFrame, cap: int = SECONDARY_HOURLY_CAP,
                         account: str = "account", ts: str = "requested_at",
                         window_seconds: int = 3600) -> DataFrame:
    """For every request: how many requests of the same account fall in the
    trailing hour [t - 1h, t] (ties included), and whether that exceeds
    ``cap``.

    Exact and skew-proof whatever the distribution — one account, or one
    hour of one account, may hold a third of the log: requests are first
    counted per (account, time), in the tasks; count = R(t) - R(before
    t - 1h), where R is a running count over the distinct times under the
    order (account, time).  Each distinct time is exploded into itself and a
    weightless probe just before everything at t - 1h; one distributed
    running total (range-partitioned, no single-task window) prices both.
    Requests take their time's count by a join that AQE can split.
    """
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    times = log.groupBy(F.col(f"`{account}`").alias("_acct"), us.alias("_us")).agg(F.count(F.lit(1)).alias("_n"))
    probes = F.array(
        F.struct(F.lit(0).alias("k"), (F.col("_us") - window_seconds * 1_000_000).alias("u"), F.lit(0).cast("long").alias("w")),
        F.struct(F.lit(1).alias("k"), F.col("_us").alias("u"), F.col("_n").alias("w")))
    flat = times.select("_acct", "_us", F.explode(probes).alias("_p")).select("_acct", "_us", "_p.k", "_p.u", "_p.w")
    priced = running_total(flat, ["_acct", "u", "k", "_us"], "_r", weight=F.col("w"))
    per = priced.groupBy("_acct", "_us").agg(
        (F.max(F.when(F.col("k") == 1, F.col("_r"))) - F.max(F.when(F.col("k") == 0, F.col("_r")))).alias("trailing_count"))
    out = log.join(per, F.col(f"`{account}`").eqNullSafe(F.col("_acct")) & us.eqNullSafe(F.col("_us")))
    return out.select(*[F.col(f"`{c}`") for c in log.columns], "trailing_count", (F.col("trailing_count") > cap).alias("over_cap"))
