"""Vendor-shaped payloads built from the bound rows.

The supplied tables hold no vendor payloads, so these builders render the
bound datasets the way each vendor delivers them (JSON responses, a
namespaced XML filing, an HTML page, a wide frame), grouped the way the
vendor responds (per ticker and month, per request batch, per document).
Every group is bounded by that response size, never by the data size.

FIXED VALUES (landing rules):
  price JSON: one response per (ticker, calendar month, page of at most
              1000 rows), date rendered as 'yyyy-MM-ddT00:00:00.000Z'
  observations: one response per (series, calendar month, page of at most
              1000 rows), one observation per event, value text '.' where
              event_id % 20 = 0
  identifier responses: request batches of 100 tickers in ticker order; a
              second, worse-ranked match is listed where key % 5 = 0; no match
              gives {"warning": "No identifier found."}
  holdings XML: one document per (key div 6), namespace prefix 'nport';
              isin omitted where key % 7 = 3; asset category STIV where
              key % 5 = 4, else EC
  filing index: one per (filer, page of at most 1000 orders), most recent
              (date, accession) first within a page, form
              NPORT-P for priority '1-URGENT' else 10-Q, accession
              '<key padded 10>-<yy>-<orderkey mod 1e6 padded 6>'
  HTML pages: one page per (key div 50); symbols of key % 50 = 7 carry a
              '.B' share-class suffix; date added 'n/a' where key % 11 = 5
  wide frames: batches of 50 tickers in ticker order; tickers with
              uid % 37 = 5 are missing from the vendor's response
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import assign_keys
from . import bindings as bind


PAGE_ROWS = 1000


def page_of(page_rows: int = PAGE_ROWS) -> Column:
    """Page number bounding any response group to ``page_rows`` rows: rows
    are numbered within their input split, so a hot key (or many copies of
    one bar) is spread over many pages instead of one giant response."""
    return F.floor(F.monotonically_increasing_id() / page_rows)


def _xml_text(c: Column) -> Column:
    t = F.replace(c.cast("string"), F.lit("&"), F.lit("&amp;"))
    t = F.replace(t, F.lit("<"), F.lit("&lt;"))
    return F.replace(t, F.lit(">"), F.lit("&gt;"))


def price_json(secondary_bronze: DataFrame) -> DataFrame:
    rec = F.struct(
        F.concat(F.date_format("date", "yyyy-MM-dd'T'00:00:00.000"),
                 F.when(F.dayofmonth("date") % 3 == 0, "+09:00").when(F.dayofmonth("date") % 3 == 1, "-05:00")
                 .otherwise("Z")).alias("date"),
        "open", "high", "low", "close", "volume", F.col("adj_close").alias("adjClose"),
        F.col("adj_open").alias("adjOpen"), F.col("adj_high").alias("adjHigh"),
        F.col("adj_low").alias("adjLow"), F.col("adj_volume").alias("adjVolume"))
    g = secondary_bronze.groupBy("ticker", F.date_trunc("month", "date").alias("month"),
                                 page_of().alias("page")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("date").alias("_d"), rec.alias("r")))).alias("rs"))
    # the vendor names every field of a record, also one without a value
    return g.select("ticker", "month", "page",
                    F.to_json(F.transform("rs", lambda x: x["r"]), {"ignoreNullFields": "false"}).alias("payload"))


def observations_json(spark, sf_dir) -> DataFrame:
    ev = bind.read_table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value")
    ob = ev.select(bind.series_of(F.col("event_type")).alias("series_id"), F.to_date("ts").alias("date"),
                   "event_id",
                   F.when(F.col("event_id") % 20 == 0, F.lit(".")).otherwise(F.col("value").cast("string")).alias("v"))
    g = ob.groupBy("series_id", F.date_trunc("month", "date").alias("month"), page_of().alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("date", "event_id", "v"))).alias("os"))
    obs = F.transform("os", lambda x: F.struct(F.date_format(x["date"], "yyyy-MM-dd").alias("date"),
                                               x["v"].alias("value")))
    return g.select("series_id", "month", "page", F.to_json(F.struct(obs.alias("observations"))).alias("payload"))


def identifier_responses(spark, sf_dir, batch_size: int = 100) -> DataFrame:
    cons = bind.constituents(spark, sf_dir).select("ticker")
    ids = bind.identifiers(spark, sf_dir)
    keyed = assign_keys(cons, ["ticker"], "pos0", start=0)
    keyed = keyed.withColumn("batch_id", (F.col("pos0") / batch_size).cast("long"))
    j = keyed.join(ids, "ticker", "left")
    k = bind.uid_of(F.col("ticker"))
    best = F.struct(F.col("figi"), F.col("composite_figi").alias("compositeFIGI"),
                    F.col("share_class_figi").alias("shareClassFIGI"), F.col("name"),
                    F.col("security_type").alias("securityType"), F.col("market_sector").alias("marketSector"))
    worse = F.struct(F.concat(F.lit("BBX"), F.substring("figi", 4, 9)).alias("figi"),
                     F.lit(None).cast("string").alias("compositeFIGI"),
                     F.lit(None).cast("string").alias("shareClassFIGI"), F.col("name"),
                     F.lit("ADR").alias("securityType"), F.col("market_sector").alias("marketSector"))
    result = F.when(F.col("figi").isNull(),
                    F.struct(F.lit(None).cast("array<struct<figi:string,compositeFIGI:string,shareClassFIGI:string,"
                                              "name:string,securityType:string,marketSector:string>>").alias("data"),
                             F.lit("No identifier found.").alias("warning"))) \
        .otherwise(F.struct(F.when(k % 5 == 0, F.array(best, worse)).otherwise(F.array(best)).alias("data"),
                            F.lit(None).cast("string").alias("warning")))
    g = j.groupBy("batch_id").agg(F.sort_array(F.collect_list(F.struct("pos0", "ticker", result.alias("res")))).alias("xs"))
    return g.select("batch_id", F.transform("xs", lambda x: x["ticker"]).alias("requested"),
                    F.to_json(F.transform("xs", lambda x: x["res"]), {"ignoreNullFields": "true"}).alias("payload"))


def holdings_xml(spark, sf_dir, faults: bool = False) -> DataFrame:
    """Filing documents; with ``faults`` the weight of every seventeenth
    holding is no number and that of every nineteenth breaks its element."""
    h = bind.holdings(spark, sf_dir)
    weight = F.col("pct_val").cast("string")
    if faults:
        weight = F.when(F.col("holding_key") % 17 == 4, "n/a").otherwise(weight)

    def el(name, c):
        return F.concat(F.lit(f"<nport:{name}>"), _xml_text(c), F.lit(f"</nport:{name}>"))

    isin = F.when(F.col("isin").isNull(), F.lit("<nport:identifiers/>")).otherwise(
        F.concat(F.lit('<nport:identifiers><nport:isin value="'), _xml_text(F.col("isin")), F.lit('"/></nport:identifiers>')))
    item = F.concat(F.lit("<nport:invstOrSec>"), el("name", F.col("name")), el("title", F.col("title")),
                    el("cusip", F.col("cusip")), isin, el("valUSD", F.col("val_usd")),
                    el("pctVal", weight), F.when(F.lit(faults) & (F.col("holding_key") % 19 == 5), "<nport:x>").otherwise(""), el("assetCat", F.col("asset_cat")),
                    F.lit("</nport:invstOrSec>"))
    g = h.groupBy((F.col("holding_key") / 6).cast("long").alias("doc_id")).agg(
        F.sort_array(F.collect_list(F.struct("holding_key", item.alias("x")))).alias("xs"))
    body = F.array_join(F.transform("xs", lambda x: x["x"]), "")
    xml = F.concat(F.lit('<nport:edgarSubmission xmlns:nport="http://www.sec.gov/edgar/nport">'
                         '<nport:headerData><nport:name>filer</nport:name></nport:headerData>'
                         '<nport:formData><nport:invstOrSecs>'), body,
                   F.lit('</nport:invstOrSecs></nport:formData></nport:edgarSubmission>'))
    return g.select("doc_id", xml.alias("xml"), F.lit("2024-01-31").cast("date").alias("filed_date"))


def filing_index(spark, sf_dir) -> DataFrame:
    o = bind.read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    d = F.to_date("o_orderdate")
    acc = F.concat_ws("-", F.lpad(F.col("o_custkey").cast("string"), 10, "0"),
                      F.date_format(d, "yy"), F.lpad((F.col("o_orderkey") % 1000000).cast("string"), 6, "0"))
    form = F.when(F.col("o_orderpriority") == "1-URGENT", "NPORT-P").otherwise("10-Q")
    g = o.groupBy("o_custkey", page_of().alias("page")).agg(F.sort_array(F.collect_list(F.struct(
        d.alias("d"), acc.alias("acc"), form.alias("form"))), asc=False).alias("fs"))
    recent = F.struct(F.transform("fs", lambda x: x["form"]).alias("form"),
                      F.transform("fs", lambda x: x["acc"]).alias("accessionNumber"),
                      F.transform("fs", lambda x: F.date_format(x["d"], "yyyy-MM-dd")).alias("filingDate"))
    return g.select(bind.ticker_of(F.col("o_custkey")).alias("cik"), "page",
                    F.to_json(F.struct(F.struct(recent.alias("recent")).alias("filings"))).alias("payload"))


def constituents_html(spark, sf_dir) -> DataFrame:
    c = bind.constituents(spark, sf_dir)
    k = bind.uid_of(F.col("ticker"))
    sym = F.when(k % 50 == 7, F.concat("ticker", F.lit(".B"))).otherwise(F.col("ticker"))
    added = F.when(k % 11 == 5, F.lit("n/a")).otherwise(F.date_format("date_added", "yyyy-MM-dd"))

    def td(x):
        return F.concat(F.lit("<td>"), x, F.when(k % 3 == 0, "\n  ").otherwise(""), F.lit("</td>"))

    name = _xml_text(F.col("company_name"))
    # markup as pages have it: line ends before closing tags, entities
    name = (F.when(k % 5 == 0, F.regexp_replace(name, "^A", "&#65;")).when(k % 5 == 1, F.regexp_replace(name, "^A", "&#x41;"))
            .otherwise(name))
    row = F.concat(F.lit("<tr>"), td(F.concat(F.when(k % 4 == 1, "&nbsp;").otherwise(" "), sym, F.lit(" "))), td(name),
                   td(F.col("gics_sector")), td(F.col("gics_sub_industry")), td(added), F.lit("</tr>\n"))
    g = c.groupBy((k / 50).cast("long").alias("page_id")).agg(
        F.sort_array(F.collect_list(F.struct(k.alias("k"), row.alias("r")))).alias("rs"))
    head = ("<html><body><p>Index members</p><table class=\"wikitable sortable\" id=\"constituents\">\n"
            "<thead><tr><th>Symbol</th><th>Security</th><th>GICS Sector</th><th>GICS Sub-Industry</th>"
            "<th>Date added</th></tr></thead><tbody>\n")
    tail = ("</tbody></table>\n<table id=\"changes\"><tr><th>Date</th><th>Added</th></tr>"
            "<tr><td>2024-01-02</td><td>ZZZZ</td></tr></table></body></html>")
    return g.select("page_id", F.concat(F.lit(head), F.array_join(F.transform("rs", lambda x: x["r"]), ""),
                                        F.lit(tail)).alias("html"))


def wide_cells(spark, sf_dir, batch_size: int = 50) -> tuple[DataFrame, DataFrame]:
    """(landed wide cells per (batch, date), requested tickers per batch)."""
    from .payloads import WIDE_FIELDS
    cons = bind.constituents(spark, sf_dir).select("ticker")
    req = assign_keys(cons, ["ticker"], "pos0", start=0).withColumn(
        "batch_id", (F.col("pos0") / batch_size).cast("long")).select("batch_id", "ticker")
    # a wide frame holds one cell per (ticker, field, date): re-delivered
    # copies collapse to the last one (map-side top-1 before the shuffle)
    from ..operators.dedup import keep_one
    bars = keep_one(bind.primary_bronze(spark, sf_dir).withColumn("_a", F.monotonically_increasing_id()),
                    ["ticker", "date"], [F.col("_a")], last=True).drop("_a")
    uid = bind.uid_of(F.col("ticker"))
    bars = bars.where(uid % 37 != 5).join(req, "ticker")
    col_of = dict((c, f) for f, c in WIDE_FIELDS)
    entries = F.array(*[F.struct(F.concat("ticker", F.lit("." + col_of[c])).alias("k"),
                                 F.col(c).cast("double").alias("v"))
                        for c in ["open", "high", "low", "close", "adj_close", "volume", "dividends", "stock_splits"]])
    g = bars.groupBy("batch_id", "date").agg(F.flatten(F.collect_list(entries)).alias("es"))
    return g.select("batch_id", "date", F.map_from_entries("es").alias("cells")), req
