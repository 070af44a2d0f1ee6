"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
computed over the whole supplied tables (via the bindings)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PRIMARY, SECONDARY
from ..operators import events as ev
from ..operators import fingerprints as fp
from ..operators import quality as qc
from ..operators import quantiles as qt
from ..operators import reconcile as rec
from ..operators.silver import to_silver
from ..sources import bindings as bind
from .present import present

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---- silver -------------------------------------------------------------

def sound(bronze: DataFrame) -> DataFrame:
    """Bronze rows that pass the gate by themselves: vendors do send closes of zero."""
    return qc.set_aside(bronze, qc.price_rules())[0]


def primary_silver(spark, sf_dir) -> DataFrame:
    return to_silver(sound(bind.primary_bronze(spark, sf_dir)), PRIMARY)


def secondary_silver(spark, sf_dir) -> DataFrame:
    return to_silver(bind.secondary_bronze(spark, sf_dir), SECONDARY)


def reconciliation(spark, sf_dir, materialize: bool = False) -> rec.Reconciliation:
    return rec.Reconciliation(primary_silver(spark, sf_dir), secondary_silver(spark, sf_dir),
                              materialize=materialize)


@query("silver_adjusted_derived")
def q_silver_adjusted_derived(spark, sf_dir):
    return present(primary_silver(spark, sf_dir))


@query("silver_adjusted_native")
def q_silver_adjusted_native(spark, sf_dir):
    return present(secondary_silver(spark, sf_dir))


# ---- reconciliation -----------------------------------------------------

@query("reconcile_pairs")
def q_reconcile_pairs(spark, sf_dir):
    return present(reconciliation(spark, sf_dir).pairs())


@query("reconcile_coverage")
def q_reconcile_coverage(spark, sf_dir):
    return present(reconciliation(spark, sf_dir).totals())


@query("reconcile_by_ticker")
def q_reconcile_by_ticker(spark, sf_dir):
    prof = reconciliation(spark, sf_dir).by_ticker()
    return present(prof.orderBy(F.col("rows_flagged").desc(), "ticker"))


@query("discrepancy_shape")
def q_discrepancy_shape(spark, sf_dir):
    prof = reconciliation(spark, sf_dir).by_ticker()
    return present(rec.discrepancy_shape(prof).select(
        "ticker", "rows_flagged", "max_pct_diff", "median_pct_diff", "first_flagged",
        "last_flagged", "shape", "window_reaches_end"))


@query("reconcile_top")
def q_reconcile_top(spark, sf_dir):
    return present(reconciliation(spark, sf_dir).top(10))


@query("reconcile_summary")
def q_reconcile_summary(spark, sf_dir):
    return present(reconciliation(spark, sf_dir, materialize=True).summary())


@query("consensus")
def q_consensus(spark, sf_dir):
    return present(reconciliation(spark, sf_dir).consensus())


@query("discrepancy_events")
def q_discrepancy_events(spark, sf_dir):
    """Each stretch of disagreement of each ticker, by the trading calendar."""
    days = primary_silver(spark, sf_dir).select("date").unionByName(secondary_silver(spark, sf_dir).select("date"))
    return present(ev.discrepancy_events(reconciliation(spark, sf_dir).pairs(), days))


QUANTILES = [0.01, 0.25, 0.5, 0.75, 0.9, 0.99]


@query("pct_diff_quantiles")
def q_pct_diff_quantiles(spark, sf_dir):
    """Exact quantiles of the discrepancy over the universe and per sector."""
    from ..session import cut_lineage
    sector = bind.constituents(spark, sf_dir).select("ticker", F.col("gics_sector").alias("grp"))
    p = cut_lineage(reconciliation(spark, sf_dir).pairs().join(sector, "ticker", "left").withColumn("grp", F.coalesce("grp", F.lit("none"))))
    whole = p.withColumn("grp", F.lit("universe"))
    return present(qt.exact_quantiles(whole, "pct_diff", QUANTILES, ["grp"]).unionByName(qt.exact_quantiles(p, "pct_diff", QUANTILES, ["grp"])))


@query("coverage_rollup")
def q_coverage_rollup(spark, sf_dir):
    """Outcomes by sector, ticker and month, with all totals."""
    sector = bind.constituents(spark, sf_dir).select("ticker", F.col("gics_sector").alias("sector"))
    return present(rec.coverage_rollup(reconciliation(spark, sf_dir).consensus(), sector))


@query("reconcile_bucketed")
def q_reconcile_bucketed(spark, sf_dir):
    """Both vendors from bucketed silver tables: no exchange under the join."""
    from ..sources import bucketed
    path = scratch_dir(spark, "bucketed")
    tables = []
    for source, silver in ((PRIMARY, primary_silver(spark, sf_dir)), (SECONDARY, secondary_silver(spark, sf_dir))):
        tables.append(f"silver_{source}_{path[-12:]}")
        bucketed.write_bucketed(silver, tables[-1], f"{path}/{source}", buckets=16)
    p, s = (bucketed.read_bucketed(spark, t) for t in tables)
    return present(rec.Reconciliation(p, s).pairs())


@query("discrepancy_segments")
def q_discrepancy_segments(spark, sf_dir):
    """The levels of each ticker's signed difference and where they change."""
    return present(ev.segments(reconciliation(spark, sf_dir).pairs()))


# ---- quality gate -------------------------------------------------------

def _price_reports(spark, sf_dir):
    return (qc.evaluate(bind.primary_landed(spark, sf_dir), qc.price_rules(), PRIMARY)
            .unionByName(qc.evaluate(bind.secondary_bronze(spark, sf_dir), qc.price_rules(), SECONDARY)))


def _all_reports(spark, sf_dir):
    return (qc.evaluate(bind.constituents(spark, sf_dir), qc.constituents_rules(), "constituents")
            .unionByName(_price_reports(spark, sf_dir))
            .unionByName(qc.evaluate_macro(bind.macro(spark, sf_dir)))
            .unionByName(qc.evaluate(bind.identifiers(spark, sf_dir), qc.identifier_rules(), "identifiers")))


@query("quality_prices")
def q_quality_prices(spark, sf_dir):
    return present(_price_reports(spark, sf_dir))


@query("quality_constituents")
def q_quality_constituents(spark, sf_dir):
    return present(qc.evaluate(bind.constituents(spark, sf_dir), qc.constituents_rules(), "constituents"))


@query("quality_macro")
def q_quality_macro(spark, sf_dir):
    return present(qc.evaluate_macro(bind.macro(spark, sf_dir)))


@query("quality_identifiers")
def q_quality_identifiers(spark, sf_dir):
    return present(qc.evaluate(bind.identifiers(spark, sf_dir), qc.identifier_rules(), "identifiers"))


@query("quality_rollup")
def q_quality_rollup(spark, sf_dir):
    return present(qc.rollup(_all_reports(spark, sf_dir)))


@query("ohlc_violations")
def q_ohlc_violations(spark, sf_dir):
    cols = ["ticker", "date", "open", "high", "low", "close", "adj_close", "volume"]
    p = bind.primary_bronze(spark, sf_dir).select(F.lit(PRIMARY).alias("source"), *cols)
    s = bind.secondary_bronze(spark, sf_dir).select(F.lit(SECONDARY).alias("source"), *cols)
    v = qc.ohlc_violations(p.unionByName(s))
    return present(v.orderBy("source", "ticker", "date"))


# ---- gold dimensions ----------------------------------------------------
import datetime as _dt  # noqa: E402

from ..operators import dims  # noqa: E402

SCD_ATTRS = ["company_name", "gics_sector", "gics_sub_industry", "figi"]


def scd_snapshots(spark, sf_dir):
    s = bind.membership_snapshots(spark, sf_dir)
    return s.select("ticker", "snapshot_date",
                    F.concat(F.lit("Acme "), F.col("ticker")).alias("company_name"),
                    F.col("attribute").alias("gics_sector"),
                    F.lit(None).cast("string").alias("gics_sub_industry"),
                    F.lit(None).cast("string").alias("figi"))


@query("trading_days")
def q_trading_days(spark, sf_dir):
    return present(dims.trading_days(primary_silver(spark, sf_dir)))


@query("dim_date")
def q_dim_date(spark, sf_dir):
    return present(gold_dim_date(spark, sf_dir))


@query("dim_date_refresh")
def q_dim_date_refresh(spark, sf_dir):
    """First load: early window with the secondary vendor's trading days;
    refresh: later, overlapping window with the primary's."""
    start, end = bind.calendar_bounds(spark, sf_dir)
    first = dims.build_dim_date(spark, start, _dt.date(2024, 1, 20),
                                dims.trading_days(secondary_silver(spark, sf_dir)))
    second = dims.build_dim_date(spark, _dt.date(2024, 1, 10), end,
                                 dims.trading_days(primary_silver(spark, sf_dir)))
    return present(dims.refresh_dim_date(first, second))


@query("scd2_history")
def q_scd2_history(spark, sf_dir):
    return present(dims.build_scd2_bulk(scd_snapshots(spark, sf_dir), SCD_ATTRS))


@query("scd2_apply_snapshot")
def q_scd2_apply_snapshot(spark, sf_dir):
    """History up to the previous snapshot (bulk), then the latest snapshot
    applied incrementally — must equal the bulk history over all."""
    snaps = scd_snapshots(spark, sf_dir)
    last = snaps.select(F.max("snapshot_date")).scalar()
    before = dims.build_scd2_bulk(snaps.where(F.col("snapshot_date") < last), SCD_ATTRS)
    latest = snaps.where(F.col("snapshot_date") == last).drop("snapshot_date")
    new_dim, _ = dims.apply_snapshot(before, latest, last, SCD_ATTRS)
    return present(new_dim)


@query("scd2_summary")
def q_scd2_summary(spark, sf_dir):
    return present(dims.scd2_summary(scd_snapshots(spark, sf_dir), SCD_ATTRS))


@query("scd2_invariants")
def q_scd2_invariants(spark, sf_dir):
    return present(dims.scd2_invariants(dims.build_scd2_bulk(scd_snapshots(spark, sf_dir), SCD_ATTRS)))


# ---- gold facts ---------------------------------------------------------
from ..operators import facts as fx  # noqa: E402
from ..operators.silver import dedup_keep_last, type_columns  # noqa: E402


def gold_dim_date(spark, sf_dir):
    start, end = bind.calendar_bounds(spark, sf_dir)
    return dims.build_dim_date(spark, start, end, dims.trading_days(primary_silver(spark, sf_dir)))


def gold_dim_security(spark, sf_dir):
    snap = dims.prepare_snapshot(bind.constituents(spark, sf_dir), bind.identifiers(spark, sf_dir))
    dim, _ = dims.apply_snapshot(dims.empty_dim(spark), snap, bind.INGEST_DATE)
    return dim


FACT_TABLES = ("fact_price_daily", "fact_price_daily_consensus", "fact_corporate_action", "fact_macro_rate")


def landed_silver(spark, sf_dir) -> DataFrame:
    """Silver of the faulty feed: rows that break a rule by themselves are set
    aside, of re-delivered bars the last stays."""
    return to_silver(sound(bind.primary_landed(spark, sf_dir)), PRIMARY)


def gold_facts(spark, sf_dir, materialize: bool = False, tables=FACT_TABLES, landed: bool = False):
    """(dim_date, dim_security, table -> (rows, load counts)) of one gold
    build, planning only the requested fact ``tables`` (dim_security is
    None when only the macro fact is asked for).  ``materialize=True``
    computes each input once (reliable checkpoint) — as the pipeline reads
    them back from storage — for reports that check several tables."""
    from ..session import cut_lineage
    keep = cut_lineage if materialize else (lambda df: df)
    want = set(tables)
    primary = landed_silver if landed else primary_silver
    dd = keep(gold_dim_date(spark, sf_dir))
    ds = keep(gold_dim_security(spark, sf_dir)) if want - {"fact_macro_rate"} else None
    out = {}
    if want & {"fact_price_daily", "fact_price_daily_consensus"}:
        ps, ss = keep(primary(spark, sf_dir)), keep(secondary_silver(spark, sf_dir))
    if "fact_price_daily" in want:
        # keys are resolved once for both vendors
        both = ps.withColumn("source", F.lit(PRIMARY)).unionByName(ss.withColumn("source", F.lit(SECONDARY)))
        out["fact_price_daily"] = fx.fact_price_daily_sources(both, dd, ds)
    if "fact_price_daily_consensus" in want:
        out["fact_price_daily_consensus"] = fx.fact_consensus(rec.Reconciliation(ps, ss).consensus(), dd, ds)
    if "fact_corporate_action" in want:
        actions_bronze = dedup_keep_last(type_columns(bind.primary_bronze(spark, sf_dir)))
        out["fact_corporate_action"] = fx.fact_corporate_action(keep(actions_bronze), dd, ds)
    if "fact_macro_rate" in want:
        out["fact_macro_rate"] = fx.fact_macro_rate(keep(bind.macro(spark, sf_dir)), dd)
    return dd, ds, {t: out[t] for t in FACT_TABLES if t in out}


def _fact_rows(spark, sf_dir, table):
    return gold_facts(spark, sf_dir, tables=(table,))[2][table][0]


def materialized_gold(spark, sf_dir):
    return gold_facts(spark, sf_dir, materialize=True, landed=True)


@query("fact_price_daily")
def q_fact_price_daily(spark, sf_dir):
    return present(_fact_rows(spark, sf_dir, "fact_price_daily"))


@query("fact_consensus")
def q_fact_consensus(spark, sf_dir):
    return present(_fact_rows(spark, sf_dir, "fact_price_daily_consensus"))


@query("fact_corporate_action")
def q_fact_corporate_action(spark, sf_dir):
    return present(_fact_rows(spark, sf_dir, "fact_corporate_action"))


@query("fact_macro_rate")
def q_fact_macro_rate(spark, sf_dir):
    return present(_fact_rows(spark, sf_dir, "fact_macro_rate"))


@query("load_summary")
def q_load_summary(spark, sf_dir):
    f = materialized_gold(spark, sf_dir)[2]
    out = None
    for _, (_, cnt) in f.items():
        out = cnt if out is None else out.unionByName(cnt)
    return present(out)


@query("fk_orphans")
def q_fk_orphans(spark, sf_dir):
    """Facts checked against dimensions that have since lost every tenth
    date and every seventh security."""
    dd, ds, f = materialized_gold(spark, sf_dir)
    dd, ds = dd.where("date_key % 10 <> 0"), ds.where("security_key % 7 <> 0")
    out = None
    for table, (rows, _) in f.items():
        o = fx.fk_orphans(rows, table, dd, None if table == "fact_macro_rate" else ds)
        out = o if out is None else out.unionByName(o)
    return present(out)


@query("pk_duplicates")
def q_pk_duplicates(spark, sf_dir):
    """Primary keys held twice after an append that was no upsert."""
    from ..schemas import GOLD_TABLES
    dd, ds, f = materialized_gold(spark, sf_dir)
    tables = {"dim_date": dd, "dim_security": ds, **{t: r for t, (r, _) in f.items()}}
    # every table appended once more, without an upsert, from the tenth on
    tables = {t: df.unionByName(df.where((F.col("security_key") % 10 == 0) if t == "dim_security"
                                         else (F.col("date_key") % 100 >= 10))) for t, df in tables.items()}
    out = None
    for t, df in tables.items():
        o = fx.pk_duplicates(df, t, GOLD_TABLES[t][1])
        out = o if out is None else out.unionByName(o)
    return present(out)


@query("freshness_gate")
def q_freshness_gate(spark, sf_dir):
    dd, ds, f = gold_facts(spark, sf_dir, materialize=True, tables=("fact_price_daily_consensus",))
    return present(fx.freshness(ds, f["fact_price_daily_consensus"][0], dd, bind.INGEST_DATE))


@query("gold_build_counts")
def q_gold_build_counts(spark, sf_dir):
    dd, ds, f = materialized_gold(spark, sf_dir)
    tables = {"dim_date": dd, "dim_security": ds, **{t: r for t, (r, _) in f.items()}}
    out = None
    for t, df in tables.items():
        o = df.agg(F.lit(t).alias("table"), F.count(F.lit(1)).alias("rows"))
        out = o if out is None else out.unionByName(o)
    return present(out)


# ---- point-in-time keys -------------------------------------------------

def weekly_dim_security(spark, sf_dir):
    """Securities with their history within the bars' month: members come,
    change, leave and return by week."""
    s = bind.weekly_snapshots(spark, sf_dir)
    return dims.build_scd2_bulk(s.select(
        "ticker", "snapshot_date", F.concat(F.lit("Acme "), "ticker").alias("company_name"), F.col("attribute").alias("gics_sector"),
        F.lit(None).cast("string").alias("gics_sub_industry"), F.lit(None).cast("string").alias("figi")), SCD_ATTRS)


def _as_of(spark, sf_dir):
    both = (primary_silver(spark, sf_dir).withColumn("source", F.lit(PRIMARY))
            .unionByName(secondary_silver(spark, sf_dir).withColumn("source", F.lit(SECONDARY))))
    return fx.fact_price_daily_as_of(both, gold_dim_date(spark, sf_dir), weekly_dim_security(spark, sf_dir))


@query("fact_price_daily_as_of")
def q_fact_price_daily_as_of(spark, sf_dir):
    """Every bar under the version of its security that was valid that day."""
    return present(_as_of(spark, sf_dir)[0])


@query("as_of_load_summary")
def q_as_of_load_summary(spark, sf_dir):
    """Bars by what point-in-time resolution found for them."""
    return present(_as_of(spark, sf_dir)[1])


# ---- landed payloads ----------------------------------------------------
from ..sources import landing, payloads  # noqa: E402


@query("price_payload_json")
def q_price_payload_json(spark, sf_dir):
    rows, _ = payloads.parse_price_records(landing.price_json(bind.secondary_bronze(spark, sf_dir)))
    return present(rows)


@query("macro_payload_json")
def q_macro_payload_json(spark, sf_dir):
    rows, _ = payloads.parse_observations(landing.observations_json(spark, sf_dir))
    return present(rows)


@query("identifier_payload_zip")
def q_identifier_payload_zip(spark, sf_dir):
    rows, rejects = payloads.parse_identifier_responses(landing.identifier_responses(spark, sf_dir))
    return present(rows.select(*rows.columns, F.lit("mapped").alias("status"))
                   .unionByName(rejects.select(F.col("key").alias("ticker"), *[
                       F.lit(None).cast("string").alias(c) for c in rows.columns if c != "ticker"],
                       F.lit("rejected").alias("status"))))


@query("holdings_xml")
def q_holdings_xml(spark, sf_dir):
    return present(payloads.parse_holdings_xml(landing.holdings_xml(spark, sf_dir)))


@query("holdings_xml_file")
def q_holdings_xml_file(spark, sf_dir):
    """The filings as files, cut into holdings while they are read; holdings
    that do not parse are rejects."""
    path = scratch_dir(spark, "filings")
    landing.holdings_xml(spark, sf_dir, faults=True).select("xml", "filed_date").write.partitionBy("filed_date").text(path)
    rows, rejects = payloads.read_holdings_files(spark, path)
    cusip = F.regexp_extract("text", "cusip>([^<]*)<", 1).alias("cusip")
    lost = rejects.select(cusip, F.col("reason").alias("status"))
    return present(rows.withColumn("status", F.lit("parsed")).unionByName(lost, allowMissingColumns=True))


@query("filing_index_pick")
def q_filing_index_pick(spark, sf_dir):
    rows, _ = payloads.pick_filing(landing.filing_index(spark, sf_dir))
    return present(rows)


@query("constituents_html")
def q_constituents_html(spark, sf_dir):
    return present(payloads.parse_constituents_html(landing.constituents_html(spark, sf_dir)))


@query("wide_to_long_prices")
def q_wide_to_long_prices(spark, sf_dir):
    cells, _ = landing.wide_cells(spark, sf_dir)
    return present(payloads.cells_to_long(cells))


@query("missing_from_batch")
def q_missing_from_batch(spark, sf_dir):
    """Requested tickers a 'successful' wide response silently left out —
    the dead-letter rows of the primary fetch."""
    cells, req = landing.wide_cells(spark, sf_dir)
    delivered = payloads.cells_to_long(cells).select("ticker").distinct()
    missing = req.join(delivered, "ticker", "left_anti")
    return present(missing.select(F.lit(PRIMARY).alias("source"), "batch_id", "ticker",
                                  F.lit("no data returned").alias("reason")))


# ---- planning, cross-check, bronze storage --------------------------------
from ..config import MACRO_SERIES  # noqa: E402
from ..operators import crosscheck as xc  # noqa: E402
from ..operators import planning as plan  # noqa: E402
from ..schemas import PRIMARY_BRONZE  # noqa: E402
from ..session import scratch_dir  # noqa: E402
from ..sources import bronze  # noqa: E402

SAMPLE_N = 45


@query("batch_plan")
def q_batch_plan(spark, sf_dir):
    return present(plan.batch_plan(bind.constituents(spark, sf_dir), 50))


@query("stratified_sample")
def q_stratified_sample(spark, sf_dir):
    return present(plan.stratified_sample(bind.constituents(spark, sf_dir), SAMPLE_N))


@query("resume_worklist")
def q_resume_worklist(spark, sf_dir):
    sample = plan.stratified_sample(bind.constituents(spark, sf_dir), SAMPLE_N)
    landed = bind.secondary_bronze(spark, sf_dir).select("ticker")
    return present(plan.resume_worklist(sample, landed))


@query("trailing_hour_budget")
def q_trailing_hour_budget(spark, sf_dir):
    return present(plan.trailing_hour_budget(bind.request_log(spark, sf_dir)))


def _ec_holdings(spark, sf_dir):
    inside = bind.holdings(spark, sf_dir).where(F.col("asset_cat") == "EC").drop("holding_key")
    return inside.unionByName(bind.outside_holdings(spark, sf_dir))


@query("crosscheck_unmatched_list")
def q_crosscheck_unmatched_list(spark, sf_dir):
    return present(xc.unmatched_list(bind.constituents(spark, sf_dir), _ec_holdings(spark, sf_dir)))


@query("crosscheck_unmatched_holdings")
def q_crosscheck_unmatched_holdings(spark, sf_dir):
    return present(xc.unmatched_holdings(bind.constituents(spark, sf_dir), _ec_holdings(spark, sf_dir)))


@query("crosscheck_summary")
def q_crosscheck_summary(spark, sf_dir):
    return present(xc.summary(bind.constituents(spark, sf_dir), _ec_holdings(spark, sf_dir)))


@query("macro_labelled")
def q_macro_labelled(spark, sf_dir):
    labels = spark.createDataFrame(MACRO_SERIES, "series_id string, label string")  # fixed 4 rows
    return present(bind.macro(spark, sf_dir).join(F.broadcast(labels), "series_id", "left"))


@query("universe_plan")
def q_universe_plan(spark, sf_dir):
    from .pipeline import universe_plan
    return present(universe_plan(bind.constituents(spark, sf_dir), sample_size=SAMPLE_N))


def _landed_primary(spark, sf_dir):
    """Two snapshots of the primary feed landed in shared storage: the
    previous day's (history before 2024-01-30) and today's full history."""
    root = scratch_dir(spark, "lake")
    b = bind.primary_bronze(spark, sf_dir)
    bronze.land(b.where(F.col("date") < F.lit(_dt.date(2024, 1, 30))), root, "primary_prices",
                _dt.date(2024, 1, 30))
    bronze.land(b, root, "primary_prices", bind.INGEST_DATE)
    return root


@query("bronze_partition_scan")
def q_bronze_partition_scan(spark, sf_dir):
    root = _landed_primary(spark, sf_dir)
    df = bronze.scan(spark, root, "primary_prices", PRIMARY_BRONZE, bind.INGEST_DATE, arrival=False)
    return present(df.drop("batch"))


@query("latest_partition")
def q_latest_partition(spark, sf_dir):
    root = _landed_primary(spark, sf_dir)
    latest = bronze.latest_partition(spark, root, "primary_prices", before=bind.INGEST_DATE)
    rows = bronze.scan(spark, root, "primary_prices", PRIMARY_BRONZE, arrival=False)
    counted = rows.join(latest, rows.ingest_date == latest.latest_ingest_date, "left_semi").agg(
        F.count(F.lit(1)).alias("rows_in_partition"))
    return present(latest.withColumn("_k", F.lit(1)).join(counted.withColumn("_k", F.lit(1)), "_k").drop("_k"))


def _landed_twice(spark, sf_dir):
    """Today's feed landed twice: the full pull (batch 0), then a
    re-delivery of some bars with restated prices (batch 1)."""
    root = scratch_dir(spark, "lake")
    b = bind.primary_bronze(spark, sf_dir)
    uid = bind.uid_of(F.col("ticker"))
    revised = (b.where((uid + F.dayofmonth("date")) % 7 == 0)
               .withColumn("close", F.col("close") * 1.001).withColumn("adj_close", F.col("adj_close") * 1.001))
    bronze.land(b, root, "primary_prices", bind.INGEST_DATE, batch=0)
    bronze.land(revised, root, "primary_prices", bind.INGEST_DATE, batch=1)
    return bronze.scan(spark, root, "primary_prices", PRIMARY_BRONZE, bind.INGEST_DATE)


@query("silver_dedup")
def q_silver_dedup(spark, sf_dir):
    """Keep-last over the double landing must pick the re-delivery."""
    scanned = sound(_landed_twice(spark, sf_dir))
    return present(to_silver(scanned.drop("ingest_date", "batch"), PRIMARY))


@query("silver_dedup_counts")
def q_silver_dedup_counts(spark, sf_dir):
    """Keep-last drops are counted, never silent: rows landed, rows a
    keep-last de-duplication drops, rows kept."""
    per_key = _landed_twice(spark, sf_dir).groupBy("ticker", "date").agg(F.count(F.lit(1)).alias("n"))
    return present(per_key.agg(F.sum("n").alias("rows_landed"),
                               F.sum(F.col("n") - 1).alias("rows_dropped"),
                               F.count(F.lit(1)).alias("rows_kept")))


# ---- targeted backfill ------------------------------------------------------
from . import pipeline as pl  # noqa: E402

BACKFILL_FROM = _dt.date(2024, 1, 16)


def _split_tickers(spark, sf_dir):
    """The backfill subset: every ticker with a split action (data-derived)."""
    return (fx.corporate_actions(bind.primary_bronze(spark, sf_dir))
            .where(F.col("action_type") == "split").select("ticker").distinct())


@query("trading_days_union")
def q_trading_days_union(spark, sf_dir):
    ps = primary_silver(spark, sf_dir)
    previous = ps.where(F.col("date") < F.lit(BACKFILL_FROM))
    subset = ps.join(_split_tickers(spark, sf_dir), "ticker", "left_semi")
    return present(pl.monotone_trading_days(previous, subset))


@query("backfill_audit")
def q_backfill_audit(spark, sf_dir):
    from ..session import cut_lineage
    dd, ds = cut_lineage(gold_dim_date(spark, sf_dir)), cut_lineage(gold_dim_security(spark, sf_dir))
    early = F.col("date") < F.lit(BACKFILL_FROM)
    ps, ss = cut_lineage(primary_silver(spark, sf_dir)), cut_lineage(secondary_silver(spark, sf_dir))
    before, _ = fx.fact_consensus(rec.Reconciliation(ps.where(early), ss.where(early)).consensus(), dd, ds)
    subset = cut_lineage(_split_tickers(spark, sf_dir))
    sub_rec = rec.Reconciliation(ps.join(subset, "ticker", "left_semi"), ss.join(subset, "ticker", "left_semi"))
    backfill, _ = fx.fact_consensus(sub_rec.consensus(), dd, ds)
    return present(pl.backfill_audit(cut_lineage(before), cut_lineage(backfill), ds, subset))


@query("fact_price_daily_upsert")
def q_fact_price_daily_upsert(spark, sf_dir):
    """Two loads into a parquet fact table: the primary history, then a
    re-pull restating adj_close from the 20th plus the secondary vendor's
    rows.  Conflicting keys take the new values; nothing else changes."""
    from ..sources.gold import GoldStore
    store = GoldStore(spark, scratch_dir(spark, "gold"))
    dd, ds = gold_dim_date(spark, sf_dir), gold_dim_security(spark, sf_dir)
    ps = primary_silver(spark, sf_dir)
    first, _ = fx.fact_price_daily(ps, PRIMARY, dd, ds)
    store.upsert("fact_price_daily", first)
    restated = (ps.where(F.dayofmonth("date") >= 20)
                .withColumn("adj_close", F.col("adj_close") * 1.001))
    second, _ = fx.fact_price_daily(restated, PRIMARY, dd, ds)
    sec, _ = fx.fact_price_daily(secondary_silver(spark, sf_dir), SECONDARY, dd, ds)
    store.upsert("fact_price_daily", second.unionByName(sec))
    return present(store.read("fact_price_daily"))


# ---- lake round trips, history range, reports ------------------------------
HISTORY_START, HISTORY_END = _dt.date(2024, 1, 8), _dt.date(2024, 1, 24)


@query("silver_roundtrip")
def q_silver_roundtrip(spark, sf_dir):
    """The daily silver stage through the lake: bronze landed for the run
    date, partition scan, silver transform, silver sink (range-partitioned by
    ticker, sorted), read back from the silver partition."""
    root = scratch_dir(spark, "lake")
    bronze.land(bind.primary_bronze(spark, sf_dir), root, "primary_prices", bind.INGEST_DATE)
    return present(pl.build_silver(spark, PRIMARY, bind.INGEST_DATE, root, quarantine=True))


@query("silver_history_range")
def q_silver_history_range(spark, sf_dir):
    """Silver kept to the history range [start, end] (both inclusive)."""
    from ..operators.silver import history_range
    return present(history_range(primary_silver(spark, sf_dir), HISTORY_START, HISTORY_END))


@query("reconcile_report_rows")
def q_reconcile_report_rows(spark, sf_dir):
    """The reconciliation report as tidy (section, key, value) rows: the
    headline totals, then the flagged share of every affected ticker."""
    return present(reconciliation(spark, sf_dir, materialize=True).report_rows())


@query("scd2_snapshot_actions")
def q_scd2_snapshot_actions(spark, sf_dir):
    """Load summary of applying the latest snapshot incrementally on top of
    the history of all earlier ones: new / changed / closed / unchanged."""
    snaps = scd_snapshots(spark, sf_dir)
    last = snaps.select(F.max("snapshot_date")).scalar()
    before = dims.build_scd2_bulk(snaps.where(F.col("snapshot_date") < last), SCD_ATTRS)
    latest = snaps.where(F.col("snapshot_date") == last).drop("snapshot_date")
    _, actions = dims.apply_snapshot(before, latest, last, SCD_ATTRS)
    return present(dims.action_counts(actions))


def _land_run(spark, sf_dir):
    """Every bronze dataset of one run date landed in a fresh lake."""
    root = scratch_dir(spark, "lake")
    d = bind.INGEST_DATE
    bronze.land(bind.constituents(spark, sf_dir), root, "constituents", d)
    bronze.land(bind.primary_landed(spark, sf_dir), root, "primary_prices", d)
    bronze.land(bind.secondary_bronze(spark, sf_dir), root, "secondary_prices", d)
    bronze.land(bind.macro(spark, sf_dir), root, "macro_series", d)
    bronze.land(bind.identifiers(spark, sf_dir), root, "identifier_map", d)
    return root


@query("gate_bronze_report")
def q_gate_bronze_report(spark, sf_dir):
    """The bronze gate verb over a landed run date: every rule of every
    dataset present, in one report."""
    report, _ = pl.gate_bronze(spark, bind.INGEST_DATE, _land_run(spark, sf_dir))
    return present(report)


@query("gate_observed")
def q_gate_observed(spark, sf_dir):
    """The price rules counted by the writes that land both feeds."""
    root, d = scratch_dir(spark, "lake"), bind.INGEST_DATE
    p = pl.land_gated(bind.primary_landed(spark, sf_dir), root, "primary_prices", d, qc.price_rules(), PRIMARY)
    s = pl.land_gated(bind.secondary_bronze(spark, sf_dir), root, "secondary_prices", d, qc.price_rules(), SECONDARY)
    return present(p.unionByName(s))


@query("repull_changed_buckets")
def q_repull_changed_buckets(spark, sf_dir):
    """A feed pulled again with some bars restated and some taken back: every
    (ticker, week) bucket and what became of it, by fingerprints."""
    root = scratch_dir(spark, "lake")
    b = bind.primary_bronze(spark, sf_dir)
    uid, day = bind.uid_of(F.col("ticker")), F.dayofmonth("date")
    bronze.land(b.where(~((uid % 9 == 4) & (day > 22))), root, "primary_prices", bind.SPLIT_DATE)
    _, kept = fp.landed_changes(spark, root, "primary_prices", PRIMARY_BRONZE, bind.SPLIT_DATE, "week")
    fp.keep(kept, root, "primary_prices")
    restated = F.when((uid % 7 == 0) & day.between(10, 12), F.col("close") * 1.001).otherwise(F.col("close"))
    bronze.land(b.withColumn("close", restated).where(~((uid % 11 == 3) & (day < 16))), root, "primary_prices", bind.INGEST_DATE)
    return present(fp.landed_changes(spark, root, "primary_prices", PRIMARY_BRONZE, bind.INGEST_DATE, "week")[0])


@query("constituents_snapshot_reuse")
def q_constituents_snapshot_reuse(spark, sf_dir):
    """Reuse-or-refresh: the first call for a run date ingests the page; a
    second call without a page must reuse that landed snapshot."""
    from .ingest import constituents_snapshot
    root = scratch_dir(spark, "lake")
    constituents_snapshot(spark, bind.INGEST_DATE, landing.constituents_html(spark, sf_dir), root=root)
    return present(constituents_snapshot(spark, bind.INGEST_DATE, None, root=root))


@query("fact_price_daily_stream")
def q_fact_price_daily_stream(spark, sf_dir):
    """The streaming form of the primary fact load: two landings (history
    before the split date, then the rest) each picked up once by an
    availableNow file stream whose micro-batches gate, build silver and
    upsert; the fact table then holds every primary bar exactly once."""
    from ..session import cut_lineage
    from ..sources.gold import GoldStore
    from ..streaming.bronze_stream import run_price_stream
    root = scratch_dir(spark, "lake")
    dd, ds = cut_lineage(gold_dim_date(spark, sf_dir)), cut_lineage(gold_dim_security(spark, sf_dir))
    b = bind.primary_bronze(spark, sf_dir)
    early = F.col("date") < F.lit(bind.SPLIT_DATE)
    bronze.land(b.where(early), root, "primary_prices", bind.SPLIT_DATE)
    run_price_stream(spark, PRIMARY, dd, ds, root=root)
    bronze.land(b.where(~early), root, "primary_prices", bind.INGEST_DATE)
    run_price_stream(spark, PRIMARY, dd, ds, root=root)
    return present(GoldStore(spark, f"{root}/gold").read("fact_price_daily"))


@query("stream_superseded")
def q_stream_superseded(spark, sf_dir):
    """Three landings through the stream, a few files a micro-batch, with a
    restart in between: per ticker, the rows landed, superseded and kept."""
    from ..streaming import keyed
    root = scratch_dir(spark, "lake")
    b = bind.primary_bronze(spark, sf_dir)
    uid = bind.uid_of(F.col("ticker"))
    bronze.land(b, root, "primary_prices", bind.SPLIT_DATE)
    keyed.run_superseded_stream(spark, PRIMARY, root, max_files=12)
    again = b.withColumn("close", F.col("close") * 1.001)
    bronze.land(again.where((uid + F.dayofmonth("date")) % 7 == 0), root, "primary_prices", bind.INGEST_DATE, batch=0)
    bronze.land(again.where((uid + F.dayofmonth("date")) % 3 == 0), root, "primary_prices", bind.INGEST_DATE, batch=1)
    keyed.run_superseded_stream(spark, PRIMARY, root, max_files=12)
    return present(keyed.superseded_counts(spark, PRIMARY, root).drop("late"))


@query("reconcile_stream")
def q_reconcile_stream(spark, sf_dir):
    """Both vendors by thirds of the month through the stream-stream join, the
    secondary a step behind: each key once, with its outcome."""
    from ..streaming import keyed
    root = scratch_dir(spark, "lake")
    feeds = {PRIMARY: bind.primary_bronze(spark, sf_dir), SECONDARY: bind.secondary_bronze(spark, sf_dir)}
    cuts = [_dt.date(2000, 1, 1), _dt.date(2024, 1, 11), _dt.date(2024, 1, 21), _dt.date(2100, 1, 1)]

    def land(source, k):
        third = feeds[source].where((F.col("date") >= F.lit(cuts[k])) & (F.col("date") < F.lit(cuts[k + 1])))
        bronze.land(third, root, f"{source}_prices", min(cuts[k + 1], bind.INGEST_DATE))

    for k in range(3):
        land(PRIMARY, k)
        if k:
            land(SECONDARY, k - 1)
            keyed.run_reconciled_stream(spark, root, delay="40 days")
    land(SECONDARY, 2)
    for source in feeds:
        keyed.heartbeat(spark, root, source, bind.INGEST_DATE, _dt.date(2100, 1, 1), batch=1)
    keyed.run_reconciled_stream(spark, root, delay="40 days")
    m = keyed.reconciled(spark, root)
    p = rec.pairs(m).select("ticker", "date", "abs_diff", "pct_diff", "flagged")
    return present(m.join(p, ["ticker", "date"], "left").withColumnRenamed("_merge", "outcome"))


# ---- bronze repair and gates --------------------------------------------------

@query("forced_repull")
def q_forced_repull(spark, sf_dir):
    """A day landed twice, then some tickers pulled again by force with a
    shorter history: their rows of either landing are gone, other tickers
    keep theirs."""
    from .ingest import ingest_price_records
    root, d = scratch_dir(spark, "lake"), bind.INGEST_DATE
    b = bind.secondary_bronze(spark, sf_dir)
    uid = bind.uid_of(F.col("ticker"))
    bronze.land(b, root, "secondary_prices", d, batch=0)
    bronze.land(b.where(uid % 3 == 0).withColumn("close", F.col("close") * 1.001), root, "secondary_prices", d, batch=1)
    again = b.where((uid % 5 == 0) & (F.dayofmonth("date") >= 10)).withColumn("close", F.col("close") * 1.002)
    ingest_price_records(spark, landing.price_json(again), b.where(uid % 5 == 0).select("ticker").distinct(), d, root, force=True)
    return present(pl.build_silver(spark, SECONDARY, d, root))


@query("ten_batches_keep_last")
def q_ten_batches_keep_last(spark, sf_dir):
    """Eleven landings of one day, each restating fewer bars: the last
    landing of a bar wins, also from batch 10 on."""
    root = scratch_dir(spark, "lake")
    b = bind.primary_bronze(spark, sf_dir)
    last = (bind.uid_of(F.col("ticker")) + F.dayofmonth("date")) % 11
    for k in range(11):
        bronze.land(b.where(last >= k).withColumn("close", F.col("close") * F.lit(1 + k * 0.001)), root, "primary_prices",
                    bind.INGEST_DATE, batch=k)
    return present(pl.build_silver(spark, PRIMARY, bind.INGEST_DATE, root, quarantine=True))


@query("old_bronze_fallback")
def q_old_bronze_fallback(spark, sf_dir):
    """One date holds an older landing without the vendor's adjusted prices
    and a newer one with them: derived for the one, kept for the other; a bar
    with a close of zero has none in either."""
    root, d = scratch_dir(spark, "lake"), bind.INGEST_DATE
    uid = bind.uid_of(F.col("ticker"))
    bronze.land(bind.secondary_bronze(spark, sf_dir, native_adjusted=False).where(uid % 4 == 0), root, "secondary_prices", d, batch=0)
    bronze.land(bind.secondary_bronze(spark, sf_dir).where(uid % 4 != 0), root, "secondary_prices", d, batch=1)
    return present(pl.build_silver(spark, SECONDARY, d, root, strict=False))


@query("empty_reland")
def q_empty_reland(spark, sf_dir):
    """A landing and its dead letters, then both again with nothing in them."""
    from ..session import cut_lineage
    root, d = scratch_dir(spark, "lake"), bind.INGEST_DATE
    b = bind.primary_bronze(spark, sf_dir)
    lost = (b.where(bind.uid_of(F.col("ticker")) % 9 == 0).select(F.col("ticker").alias("key")).distinct()
            .withColumn("reason", F.lit("no data returned")))

    def counts(when):
        rows = bronze.scan(spark, root, "primary_prices", PRIMARY_BRONZE, d, arrival=False)
        return (rows.agg(F.count(F.lit(1)).alias(f"rows_{when}")).withColumn("_k", F.lit(1))
                .join(bronze.read_rejects(spark, root).agg(F.count(F.lit(1)).alias(f"rejects_{when}")).withColumn("_k", F.lit(1)), "_k"))

    bronze.land(b, root, "primary_prices", d)
    bronze.write_rejects(lost, root, d, PRIMARY)
    before = cut_lineage(counts("before"))
    bronze.land(b.where("false"), root, "primary_prices", d)
    bronze.write_rejects(lost.where("false"), root, d, PRIMARY)
    return present(before.join(counts("after"), "_k").drop("_k"))


def corrected_run(spark, sf_dir, root):
    """Every dataset of the run date as a gate lets it pass: bad prints, sign
    errors and implausible rates put right at the source, bars without a
    positive close left out."""
    d = bind.INGEST_DATE
    low = F.least("open", "high", "low", "close")
    bronze.land(bind.constituents(spark, sf_dir), root, "constituents", d)
    bronze.land(sound(bind.primary_bronze(spark, sf_dir)).withColumn("low", low), root, "primary_prices", d)
    s = bind.secondary_bronze(spark, sf_dir).withColumn("low", low)
    s = s.withColumns({c: F.abs(c) for c in ("adj_close", "adj_open", "adj_high", "adj_low")})
    bronze.land(sound(s), root, "secondary_prices", d)
    bronze.land(bind.macro(spark, sf_dir).withColumn("value", F.least(F.lit(25.0), F.greatest(F.lit(0.01), F.col("value")))),
                root, "macro_series", d)
    bronze.land(bind.identifiers(spark, sf_dir), root, "identifier_map", d)


@query("daily_run_summary")
def q_daily_run_summary(spark, sf_dir):
    """The daily run over the faulty landing is refused before silver; over
    the corrected one it goes through.  The refusal and the run's summary."""
    from ..sources import fs
    root, d = _land_run(spark, sf_dir), bind.INGEST_DATE
    start, _ = bind.calendar_bounds(spark, sf_dir)
    gates = {"constituents_band": (1, 10 ** 9), "min_rows_per_security": 1, "min_securities": 1}
    try:
        pl.daily_run(spark, d, start, root, **gates)
        refused = 0
    except pl.GateFailed as e:
        refused = len(e.failed)
    if fs.exists(spark, f"{root}/silver") or fs.exists(spark, f"{root}/gold"):
        raise AssertionError("a refused run left silver or gold behind")
    corrected_run(spark, sf_dir, root)
    done = pl.daily_run(spark, d, start, root, **gates)
    first = spark.createDataFrame([("refused", "bronze checks failed", float(refused))], "stage string, item string, value double")
    return present(first.unionByName(done))


@query("stream_rejects")
def q_stream_rejects(spark, sf_dir):
    """The faulty feed through the stream: rows set aside by reason, and the
    rows loaded."""
    from ..session import cut_lineage
    from ..streaming.bronze_stream import run_price_stream, stream_folder
    root = scratch_dir(spark, "lake")
    dd, ds = cut_lineage(gold_dim_date(spark, sf_dir)), cut_lineage(gold_dim_security(spark, sf_dir))
    bronze.land(bind.primary_landed(spark, sf_dir), root, "primary_prices", bind.INGEST_DATE)
    run_price_stream(spark, PRIMARY, dd, ds, root=root)
    lost = spark.read.parquet(stream_folder(root, "rejects", PRIMARY)).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
    loaded = spark.read.parquet(stream_folder(root, "loads", PRIMARY)).agg(F.sum("loaded").alias("rows"))
    return present(lost.unionByName(loaded.select(F.lit("loaded").alias("reason"), "rows")))
