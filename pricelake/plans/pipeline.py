"""Public verbs: the stages of one daily run, composed from the operators.

Stages hand data to each other through the lake (parquet partitions), like
the reference's tasks; inside a stage everything is one lazy plan and jobs
start only at the sinks.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import (IDENTIFIER_BATCH_SIZE, PRIMARY, PRIMARY_BATCH_SIZE, RECONCILIATION_TOLERANCE,
                      SECONDARY)
from ..operators import dims, events, facts, fingerprints, planning, quality
from ..operators import reconcile as rec
from ..operators.quantiles import exact_quantiles
from ..operators.dedup import keep_one
from ..operators.silver import dedup_keep_last, history_range, to_silver, type_columns
from ..operators.upsert import upsert
from ..schemas import (CONSTITUENTS_BRONZE, IDENTIFIER_BRONZE, MACRO_BRONZE, PRIMARY_BRONZE,
                       SECONDARY_BRONZE, SILVER)
from ..session import cut_lineage, lake_root
from ..sources import bronze
from ..sources.gold import KEPT, GoldStore

ALL_SOURCES = ("primary", "secondary", "macro", "identifiers")
PRICE_SCHEMAS = {PRIMARY: PRIMARY_BRONZE, SECONDARY: SECONDARY_BRONZE}


# ---- planning ------------------------------------------------------------

def universe_plan(constituents: DataFrame, sample_size: int = 45, sources=ALL_SOURCES,
                  primary_batch: int = PRIMARY_BATCH_SIZE,
                  identifier_batch: int = IDENTIFIER_BATCH_SIZE) -> DataFrame:
    """Per ticker of the universe: its primary fetch batch, its identifier
    request batch, and whether it is in the secondary vendor's stratified
    sample — only for the selected sources."""
    bad = set(sources) - set(ALL_SOURCES)
    if bad:
        raise ValueError(f"unknown sources: {sorted(bad)}")
    uni = keep_one(constituents, ["ticker"], [F.col(c) for c in constituents.columns if c != "ticker"],
                   last=False).select("ticker", "gics_sector")
    out = uni
    sizes = {c: n for c, n, src in (("primary_batch", primary_batch, "primary"),
                                    ("identifier_batch", identifier_batch, "identifiers")) if src in sources}
    if sizes:
        # one ranking of the universe serves every fixed-size batching
        pos = planning.batch_plan(uni, 1).select("ticker", "position")
        out = out.join(pos.select("ticker", *[(F.col("position") / n).cast("long").alias(c)
                                              for c, n in sizes.items()]), "ticker")
    if "secondary" in sources:
        s = planning.stratified_sample(uni, sample_size).withColumn("in_secondary_sample", F.lit(True))
        out = (out.join(s, "ticker", "left")
               .withColumn("in_secondary_sample", F.coalesce("in_secondary_sample", F.lit(False))))
    return out


# ---- bronze gate -----------------------------------------------------------

def gate_bronze(spark: SparkSession, ingest_date: dt.date, root: str | None = None,
                constituents_band: tuple[int, int] | None = None,
                required_sources: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(report, verdict) for every dataset landed on ``ingest_date``.
    Absent datasets are skipped; no report at all fails; ``required_sources``
    must be present."""
    root = root or lake_root(spark)
    reports = []
    present_sources = []

    def landed(name, schema):
        df = bronze.scan(spark, root, name, schema, ingest_date, arrival=False)
        return df.drop("ingest_date", "batch", "_native")

    c = landed("constituents", CONSTITUENTS_BRONZE)
    if not c.isEmpty():
        present_sources.append("constituents")
        rules = quality.constituents_rules(*(constituents_band and [constituents_band] or []))
        reports.append(quality.evaluate(c, rules, "constituents"))
    for src, schema in PRICE_SCHEMAS.items():
        p = landed(f"{src}_prices", schema)
        if not p.isEmpty():
            present_sources.append(src)
            reports.append(quality.evaluate(p, quality.price_rules(), src))
    m = landed("macro_series", MACRO_BRONZE)
    if not m.isEmpty():
        present_sources.append("macro")
        reports.append(quality.evaluate_macro(m))
    i = landed("identifier_map", IDENTIFIER_BRONZE)
    if not i.isEmpty():
        present_sources.append("identifiers")
        reports.append(quality.evaluate(i, quality.identifier_rules(), "identifiers"))
    missing = set(required_sources) - set(present_sources)
    if missing:
        raise ValueError(f"required bronze datasets absent for {ingest_date}: {sorted(missing)}")
    if not reports:
        empty = spark.createDataFrame([], "source string, check_name string, success boolean, "
                                          "unexpected_count long, element_count long")
        return empty, spark.createDataFrame([(0, 0, False)], "sources_clean int, sources_checked int, passed boolean")
    report = reports[0]
    for r in reports[1:]:
        report = report.unionByName(r)
    return report, quality.overall(report)


def land_gated(df: DataFrame, root: str, dataset: str, ingest_date: dt.date, rules: list[quality.Rule], source: str,
               batch: int = 0) -> DataFrame:
    """Land ``df`` and return the gate's report on it, counted by the pass
    that writes it: all ``rules`` but uniqueness."""
    seen = quality.Observed(rules)
    bronze.land(seen.watch(df), root, dataset, ingest_date, batch)
    return seen.report(df.sparkSession, source)


def repull(spark: SparkSession, source: str, ingest_date: dt.date, root: str | None = None, period: str = "month") -> DataFrame:
    """Load what a re-pull of ``source`` changed: buckets of (ticker, period)
    whose fingerprint moved go through the gate, silver and the fact upsert,
    which reads and writes only the months they touch; all others are not
    built.  Returns the status of every bucket.  Bars that a vendor took back
    stay in the facts, as with any upsert; their buckets are told as "gone" or
    "changed".  A run that breaks off keeps the former fingerprints and starts
    over."""
    root = root or lake_root(spark)
    dataset, schema = f"{source}_prices", PRICE_SCHEMAS[source]
    status, now = fingerprints.landed_changes(spark, root, dataset, schema, ingest_date, period)
    status = cut_lineage(status, spark)
    rows = bronze.scan(spark, root, dataset, schema, ingest_date).drop("ingest_date", "batch")
    moved = fingerprints.moved_rows(fingerprints.with_period(rows, period), status).drop("period")
    good, _ = quality.set_aside(moved, quality.price_rules())
    store = GoldStore(spark, f"{root}/gold", keep=KEPT)
    facts_rows, _ = facts.fact_price_daily(to_silver(good, source), source, store.read("dim_date"), store.read("dim_security"))
    store.upsert("fact_price_daily", facts_rows)
    fingerprints.keep(now, root, dataset)
    return status


# ---- silver / reconcile ------------------------------------------------------

def build_silver(spark: SparkSession, source: str, ingest_date: dt.date, root: str | None = None,
                 start: dt.date | None = None, end: dt.date | None = None, quarantine: bool = False,
                 strict: bool = True) -> DataFrame:
    """Bronze partition → silver partition for one vendor, optionally kept
    to the history range [start, end]; returns the written silver (read
    back).  A close that is not positive fails the job where adjusted prices
    are derived; with ``quarantine`` rows that break a rule by themselves are
    written aside with the rule's name first (layer "quarantine"), and the
    others go on; unless ``strict``, rows with a close of zero go on without
    adjusted prices."""
    if source not in PRICE_SCHEMAS:
        raise ValueError(f"{source!r} is no price source; there are {sorted(PRICE_SCHEMAS)}")
    root = root or lake_root(spark)
    b = bronze.scan(spark, root, f"{source}_prices", PRICE_SCHEMAS[source], ingest_date)
    b = b.drop("ingest_date", "batch")
    if quarantine:
        b, broken = quality.set_aside(b, quality.price_rules())
        bronze.land(broken.drop(*bronze.ARRIVAL, "_native"), root, f"{source}_prices", ingest_date, layer="quarantine")
    silver = to_silver(b, source, strict)
    if start is not None:
        silver = history_range(silver, start, end)
    bronze.write_silver(silver, root, f"{source}_prices", ingest_date)
    return read_silver(spark, source, ingest_date, root)


def read_silver(spark: SparkSession, source: str, ingest_date: dt.date, root: str | None = None) -> DataFrame:
    root = root or lake_root(spark)
    return bronze.scan(spark, root, f"{source}_prices", SILVER, ingest_date, layer="silver",
                       arrival=False).drop("ingest_date", "batch")


def reconcile(spark: SparkSession, ingest_date: dt.date, root: str | None = None,
              primary: str = PRIMARY, secondary: str = SECONDARY,
              tolerance: float = RECONCILIATION_TOLERANCE) -> rec.Reconciliation:
    """Reconcile two silver partitions; the compared pairs are materialised
    once to silver/reconciled_prices and every report reads from there."""
    root = root or lake_root(spark)
    p, s = read_silver(spark, primary, ingest_date, root), read_silver(spark, secondary, ingest_date, root)
    if p.isEmpty() or s.isEmpty():
        absent = [n for n, df in ((primary, p), (secondary, s)) if df.isEmpty()]
        raise ValueError(f"{ingest_date}: nothing to reconcile, no silver of {', '.join(absent)}")
    # one full outer join per run: pairs (written) and every report read it
    r = rec.Reconciliation(p, s, primary, secondary, tolerance, materialize=True)
    bronze.land(r.pairs(), root, "reconciled_prices", ingest_date, layer="silver")
    return r


def discrepancy_reports(spark: SparkSession, ingest_date: dt.date, r: rec.Reconciliation, root: str | None = None,
                        gap: int = 1, quantiles: tuple[float, ...] = (0.5, 0.9, 0.99)) -> dict[str, DataFrame]:
    """Write what a reconciliation found beyond its profile, each as a report
    of the date: ``events`` (stretches of disagreement), ``levels`` (where the
    difference changes its level), ``quantiles`` of the discrepancy per sector
    and ``coverage`` at every level of sector, ticker and month.  Sectors are
    those of the date's constituents.  Returns the reports as written."""
    from .ingest import write_report
    root = root or lake_root(spark)
    sectors = (bronze.scan(spark, root, "constituents", CONSTITUENTS_BRONZE, ingest_date, arrival=False)
               .select("ticker", F.col("gics_sector").alias("sector")).dropDuplicates(["ticker"]))
    pairs = r.pairs()
    found = {
        "discrepancy_events": events.discrepancy_events(pairs, r.matched.select("date"), gap, r.primary, r.secondary),
        "discrepancy_levels": events.segments(pairs, r.tolerance, primary=r.primary, secondary=r.secondary),
        "discrepancy_quantiles": exact_quantiles(pairs.join(sectors, "ticker", "left"), "pct_diff", list(quantiles), ["sector"]),
        "coverage": rec.coverage_rollup(r.consensus(), sectors)}
    return {name: spark.read.schema(df.schema).parquet(write_report(df, root, name, ingest_date)) for name, df in found.items()}


# ---- gold ------------------------------------------------------------------

def build_gold(spark: SparkSession, ingest_date: dt.date, start: dt.date, root: str | None = None,
               primary: str = PRIMARY, secondary: str = SECONDARY, point_in_time: bool = False) -> DataFrame:
    """Silver for both vendors → dims → facts → consensus, all upserted.
    Returns the load summary (one row per load).  Facts hang on the current
    version of their security, or with ``point_in_time`` on the one that was
    valid on their day; a table is loaded one way or the other, since a key
    that moves would leave its former rows behind."""
    resolve = facts.resolve_keys_as_of if point_in_time else facts.resolve_keys
    root = root or lake_root(spark)
    store = GoldStore(spark, f"{root}/gold", keep=KEPT)
    ps = build_silver(spark, primary, ingest_date, root)
    if ps.isEmpty():
        raise ValueError(f"no {primary} silver for {ingest_date}: refusing to build dims from nothing")
    ss = build_silver(spark, secondary, ingest_date, root)

    dd_new = dims.build_dim_date(spark, start, ingest_date, dims.trading_days(ps))
    store.upsert("dim_date", dd_new, update_cols=["is_trading_day"])
    dd = store.read("dim_date")

    cons = bronze.scan(spark, root, "constituents", CONSTITUENTS_BRONZE, ingest_date)
    ids = bronze.scan(spark, root, "identifier_map", IDENTIFIER_BRONZE, ingest_date)
    snap = dims.prepare_snapshot(cons.drop("ingest_date", "batch"), ids.drop("ingest_date", "batch"))
    if snap.isEmpty():
        raise ValueError(f"constituents snapshot for {ingest_date} is empty")
    ds_new, _ = dims.apply_snapshot(store.read("dim_security"), snap, ingest_date)
    store.upsert("dim_security", ds_new)
    ds = store.read("dim_security")

    summaries = []
    for silver, src in ((ps, primary), (ss, secondary)):
        rows, cnt = facts.fact_price_daily(silver, src, dd, ds, resolve)
        store.upsert("fact_price_daily", rows)
        summaries.append(cnt)
    r = reconcile(spark, ingest_date, root, primary, secondary)
    rows, cnt = facts.fact_consensus(r.consensus(), dd, ds, resolve)
    store.upsert("fact_price_daily_consensus", rows)
    summaries.append(cnt)
    pb = bronze.scan(spark, root, f"{primary}_prices", PRIMARY_BRONZE, ingest_date)
    actions_src = dedup_keep_last(type_columns(pb.drop("ingest_date", "batch")))
    rows, cnt = facts.fact_corporate_action(actions_src, dd, ds, primary, resolve)
    store.upsert("fact_corporate_action", rows)
    summaries.append(cnt)
    macro = bronze.scan(spark, root, "macro_series", MACRO_BRONZE, ingest_date, arrival=False)
    rows, cnt = facts.fact_macro_rate(macro.drop("ingest_date", "batch"), dd)
    store.upsert("fact_macro_rate", rows)
    summaries.append(cnt)
    out = summaries[0]
    for s in summaries[1:]:
        out = out.unionByName(s)
    return out


def gate_gold(spark: SparkSession, ingest_date: dt.date, root: str | None = None, **thresholds) -> DataFrame:
    root = root or lake_root(spark)
    store = GoldStore(spark, f"{root}/gold", keep=KEPT)
    return facts.freshness(store.read("dim_security"), store.read("fact_price_daily_consensus"),
                           store.read("dim_date"), ingest_date, **thresholds)


# ---- targeted backfill --------------------------------------------------------

def subset_count(consensus_fact: DataFrame, dim_security: DataFrame, tickers: DataFrame) -> DataFrame:
    """Consensus rows whose security is one of ``tickers`` (semi-join)."""
    keys = dim_security.join(tickers.select("ticker").distinct(), "ticker", "left_semi").select("security_key")
    return consensus_fact.join(keys, "security_key", "left_semi")


def backfill_audit(before: DataFrame, backfill_rows: DataFrame, dim_security: DataFrame,
                   tickers: DataFrame) -> DataFrame:
    """Upsert a subset's backfilled consensus rows and prove nothing outside
    the subset changed: total delta must equal subset delta."""
    after = upsert(before, backfill_rows, ["security_key", "date_key"])

    def cnt(df, name):
        return df.agg(F.count(F.lit(1)).alias(name)).withColumn("_k", F.lit(1))

    out = (cnt(before, "before_total")
           .join(cnt(after, "after_total"), "_k")
           .join(cnt(subset_count(before, dim_security, tickers), "before_subset"), "_k")
           .join(cnt(subset_count(after, dim_security, tickers), "after_subset"), "_k").drop("_k"))
    return out.withColumn("untouched_outside_subset",
                          (F.col("after_total") - F.col("before_total"))
                          == (F.col("after_subset") - F.col("before_subset")))


def monotone_trading_days(previous_silver: DataFrame, new_silver: DataFrame) -> DataFrame:
    """Trading days never narrow: previous full-universe days ∪ new days."""
    return dims.trading_days(previous_silver).union(dims.trading_days(new_silver)).distinct()


def run_backfill(spark: SparkSession, tickers: DataFrame, ingest_date: dt.date, start: dt.date,
                 root: str | None = None, primary: str = PRIMARY, secondary: str = SECONDARY) -> DataFrame:
    """Targeted backfill of a ticker subset whose full history was landed
    for ``ingest_date``: silver, calendar (trading days unioned with the
    latest full-universe silver strictly *before* this run, flags only ever
    turned on), price facts and consensus — dim_security untouched.
    Returns the audit row (total delta must equal subset delta), with the
    rows that found no security or date."""
    root = root or lake_root(spark)
    store = GoldStore(spark, f"{root}/gold", keep=KEPT)
    ds = store.read("dim_security")
    # a reliable checkpoint, not a cache: a cached read of the table would be
    # refreshed when the table's path is overwritten below
    before = cut_lineage(store.read("fact_price_daily_consensus"), spark)
    ps = build_silver(spark, primary, ingest_date, root)
    ss = build_silver(spark, secondary, ingest_date, root)
    latest = bronze.latest_date(spark, root, f"{primary}_prices", before=ingest_date, layer="silver")
    days = dims.trading_days(ps)
    if latest is not None:
        days = monotone_trading_days(read_silver(spark, primary, latest, root), ps)
    incoming = dims.build_dim_date(spark, start, ingest_date, days)
    existing = store.read("dim_date")
    incoming = (incoming.join(existing.select("date_key", F.col("is_trading_day").alias("_old")), "date_key", "left")
                .withColumn("is_trading_day", F.col("is_trading_day") | F.coalesce("_old", F.lit(False)))
                .drop("_old"))
    store.upsert("dim_date", incoming, update_cols=["is_trading_day"])
    dd = store.read("dim_date")
    counts = None
    for silver, src in ((ps, primary), (ss, secondary)):
        rows, cnt = facts.fact_price_daily(silver, src, dd, ds)
        store.upsert("fact_price_daily", rows)
        counts = cnt if counts is None else counts.unionByName(cnt)
    r = reconcile(spark, ingest_date, root, primary, secondary)
    rows, cnt = facts.fact_consensus(r.consensus(), dd, ds)
    skipped = counts.unionByName(cnt).agg(
        F.sum("skipped_no_security_key").alias("skipped_no_security_key"),
        F.sum("skipped_no_date_key").alias("skipped_no_date_key"), F.lit(1).alias("_k"))
    audit = backfill_audit(before, rows, ds, tickers).withColumn("_k", F.lit(1)).join(skipped, "_k").drop("_k")
    audit = cut_lineage(audit, spark)
    store.upsert("fact_price_daily_consensus", rows)
    return audit


# ---- the daily run -------------------------------------------------------------

class GateFailed(RuntimeError):
    """A gate refused the run; the report says which checks failed."""

    def __init__(self, gate: str, failed: list[str]):
        self.gate, self.failed = gate, failed
        super().__init__(f"{gate} gate failed: {'; '.join(failed)}")


def daily_run(spark: SparkSession, ingest_date: dt.date, start: dt.date, root: str | None = None,
              primary: str = PRIMARY, secondary: str = SECONDARY,
              constituents_band: tuple[int, int] | None = None, **thresholds) -> DataFrame:
    """Gate, build, gate: one whole run over what was landed for the date.

    Stops before silver if a bronze check fails, and after gold if the result
    is not fresh; either report is written first.  Returns the summary: one
    row per stage with its checks or loads."""
    from .ingest import write_report
    root = root or lake_root(spark)
    report, _ = gate_bronze(spark, ingest_date, root, constituents_band)
    report = cut_lineage(report, spark)
    write_report(report, root, "bronze_gate", ingest_date)
    failed = [f"{r.source}: {r.check_name} ({r.unexpected_count} of {r.element_count})"
              for r in report.where("NOT success").orderBy("source", "check_name").collect()]  # one row per rule
    if failed or report.isEmpty():
        raise GateFailed("bronze", failed or ["nothing was landed"])
    loads = cut_lineage(build_gold(spark, ingest_date, start, root, primary, secondary), spark)
    fresh = cut_lineage(gate_gold(spark, ingest_date, root, **thresholds), spark)
    write_report(fresh, root, "gold_gate", ingest_date)
    stale = [f"{r.check_name} (found {r.observed})" for r in fresh.where("NOT passed").collect()]
    if stale:
        raise GateFailed("gold", stale)
    one = report.select(F.lit("bronze").alias("stage"), F.concat_ws(": ", "source", "check_name").alias("item"),
                        (F.col("element_count") - F.col("unexpected_count")).cast("double").alias("value"))
    two = loads.select(F.lit("load").alias("stage"), F.col("table").alias("item"), F.col("loaded").cast("double").alias("value"))
    three = fresh.select(F.lit("gold").alias("stage"), F.col("check_name").alias("item"), F.col("observed").alias("value"))
    return one.unionByName(two).unionByName(three)
