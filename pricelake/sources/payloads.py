"""Parsers for landed vendor payloads.

Each parser takes a DataFrame of landed payload rows (key columns plus the
raw text) and returns typed rows.  Everything runs inside Spark
(``from_json`` / ``from_xml`` / regex extraction + explode); payloads are
parsed where they sit, one row (or one file) per response.
Responses that carry nothing usable are returned as *rejects* (source, key,
reason) instead of being silently dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EQUITY_ASSET_CATEGORY, FILING_FORM, MACRO_PLACEHOLDER
from ..functions.expr import normalize_ticker, strip


def _drift_checked(text: Column, required: list[str], what: str) -> Column:
    """``text`` itself, or a job failure if no record of the payload names
    a required key (folded into the value so it can never be pruned).  A
    record may leave out a field without a value, so where the first one
    lacks a key the others are read too."""
    first = F.get_json_object(text, "$[0]")
    keys = F.json_object_keys(first)
    lacks = F.array_except(F.array(*[F.lit(k) for k in required]), F.coalesce(keys, F.array()))
    records = F.filter(F.from_json(text, "array<map<string, string>>"), lambda r: r.isNotNull())
    named = F.flatten(F.transform(records, lambda r: F.map_keys(r)))
    missing = F.array_except(lacks, F.coalesce(named, F.array()))
    # nested, so that the other records are parsed only where they decide
    return F.when(first.isNotNull() & (F.size(lacks) > 0), F.when(F.size(missing) > 0, F.raise_error(F.concat(
        F.lit(f"{what} schema drift, missing: "), F.array_join(missing, ",")))).otherwise(text)).otherwise(text)


# ---- daily price records (JSON array of objects) -------------------------
# FIXED VALUES: vendor field names → our column names.
PRICE_FIELDS = [
    ("date", "date"), ("open", "open"), ("high", "high"), ("low", "low"),
    ("close", "close"), ("volume", "volume"), ("adjClose", "adj_close"),
    ("adjOpen", "adj_open"), ("adjHigh", "adj_high"), ("adjLow", "adj_low"),
    ("adjVolume", "adj_volume"),
]
PRICE_REQUIRED = [src for src, _ in PRICE_FIELDS]
# read as text, so that a value of the wrong kind is seen and not nulled
_PRICE_SCHEMA = "array<struct<" + ", ".join(f"{src}: string" for src in PRICE_REQUIRED) + ">>"


def _whole(text: Column, what: str) -> Column:
    """Text to long; bad text or a fraction fails the job."""
    d = text.cast("decimal(38,6)")
    return F.when(d != F.floor(d), F.raise_error(F.concat(F.lit(f"{what} is no whole number: "), text))).otherwise(
        d.cast("long"))


def parse_price_records(landed: DataFrame, payload: str = "payload", ticker: str = "ticker") -> tuple[DataFrame, DataFrame]:
    """(rows, rejects).  Dates are ISO strings with a time and an offset, of
    which the calendar date stands as written.  Numbers are cast strictly.
    A payload with no records is a reject for its ticker."""
    text = _drift_checked(F.col(payload), PRICE_REQUIRED, "price payload")
    p = landed.select(F.col(ticker).alias("ticker"), F.from_json(text, _PRICE_SCHEMA).alias("_r"))
    rows = p.select("ticker", F.explode("_r").alias("r")).select(
        F.substring("r.date", 1, 10).cast("date").alias("date"),
        *[(_whole(F.col(f"r.{src}"), src) if "volume" in dst else F.col(f"r.{src}").cast("double")).alias(dst)
          for src, dst in PRICE_FIELDS if src != "date"], "ticker")
    cols = ["date", "open", "high", "low", "close", "adj_close", "adj_open", "adj_high", "adj_low",
            "adj_volume", "volume", "ticker"]
    rejects = p.where(F.coalesce(F.size("_r"), F.lit(0)) <= 0).select(
        F.lit("price").alias("source"), F.col("ticker").alias("key"),
        F.lit("empty response").alias("reason"))
    return rows.select(*cols), rejects


# ---- macro observations ---------------------------------------------------
_OBS_SCHEMA = "struct<observations: array<struct<date: string, value: string>>>"


def parse_observations(landed: DataFrame, payload: str = "payload",
                       series: str = "series_id") -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): placeholder values are dropped *inside* the cast
    expression (so no plan reordering can expose the strict cast to them);
    any other unparsable text still fails the job.  A series with no
    observations, or only placeholders, is rejected."""
    p = landed.select(F.col(series).alias("series_id"),
                      F.from_json(F.col(payload), _OBS_SCHEMA).alias("_p"))
    obs = p.select("series_id", F.explode_outer("_p.observations").alias("o"))
    val = F.when(F.col("o.value") != MACRO_PLACEHOLDER, F.col("o.value").cast("double"))
    typed = obs.select(F.to_date("o.date").alias("date"), "series_id", val.alias("value"))
    rows = typed.where(F.col("value").isNotNull())
    per = typed.groupBy("series_id").agg(F.count("date").alias("n"), F.count("value").alias("v"))
    rejects = per.where(F.col("v") == 0).select(
        F.lit("macro").alias("source"), F.col("series_id").alias("key"),
        F.when(F.col("n") == 0, "no observations").otherwise("only placeholder values").alias("reason"))
    return rows.select("date", "series_id", "value"), rejects


# ---- identifier mapping responses ----------------------------------------
_ID_SCHEMA = ("array<struct<data: array<struct<figi: string, compositeFIGI: string, shareClassFIGI: string, "
              "name: string, securityType: string, marketSector: string>>, warning: string, error: string>>")


def parse_identifier_responses(landed: DataFrame, requested: str = "requested",
                               payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Result i belongs to request i (positional zip).  A response whose
    length differs from its request fails the job; an entry without data is
    a reject; otherwise the first (best-ranked) match is kept."""
    res = F.from_json(F.col(payload), _ID_SCHEMA)
    checked = F.when(F.size(res) != F.size(F.col(requested)), F.raise_error(
        F.lit("identifier response does not line up 1:1 with its request"))).otherwise(res)
    z = landed.select(F.explode(F.arrays_zip(F.col(requested).alias("ticker"),
                                             checked.alias("result"))).alias("z"))
    z = z.select(F.col("z.ticker").alias("ticker"), F.col("z.result").alias("r"))
    has = F.coalesce(F.size("r.data"), F.lit(0)) > 0
    best = F.get(F.col("r.data"), 0)
    rows = z.where(has).select(
        "ticker", best["figi"].alias("figi"), best["compositeFIGI"].alias("composite_figi"),
        best["shareClassFIGI"].alias("share_class_figi"), best["name"].alias("name"),
        best["securityType"].alias("security_type"), best["marketSector"].alias("market_sector"))
    rejects = z.where(~has).select(F.lit("identifiers").alias("source"), F.col("ticker").alias("key"),
                                   F.coalesce("r.warning", "r.error", F.lit("no data")).alias("reason"))
    return rows, rejects


# ---- holdings XML --------------------------------------------------------
_HOLDINGS_SCHEMA = ("formData struct<invstOrSecs: struct<invstOrSec: array<struct<name: string, title: string, "
                    "cusip: string, identifiers: struct<isin: struct<_value: string>>, valUSD: double, "
                    "pctVal: double, assetCat: string>>>>")


def parse_holdings_xml(landed: DataFrame, payload: str = "xml",
                       filed: str | None = "filed_date", keep_category: str | None = EQUITY_ASSET_CATEGORY) -> DataFrame:
    """Every ``invstOrSec`` of a namespaced filing document, leaf fields plus
    the ``isin`` attribute; a document with zero holdings fails the job
    (more likely a parser/schema mismatch than an empty fund).  Only
    ``keep_category`` (equity common) holdings are returned."""
    doc = F.from_xml(F.col(payload), _HOLDINGS_SCHEMA, {"ignoreNamespace": "true"})
    extra = [F.col(filed).alias("nport_filed_date")] if filed else []
    d = landed.select(doc.alias("d"), *extra)
    items = F.col("d.formData.invstOrSecs.invstOrSec")
    items = F.when(F.coalesce(F.size(items), F.lit(0)) <= 0, F.raise_error(F.lit(
        "parsed zero holdings from a filing document"))).otherwise(items)
    h = d.select(F.explode(items).alias("h"), *[c for c in ["nport_filed_date"] if filed])
    out = h.select(
        F.col("h.name").alias("name"), F.col("h.title").alias("title"), F.col("h.cusip").alias("cusip"),
        F.col("h.identifiers.isin._value").alias("isin"), F.col("h.assetCat").alias("asset_cat"),
        F.col("h.pctVal").alias("pct_val"), F.col("h.valUSD").alias("val_usd"),
        *[c for c in ["nport_filed_date"] if filed])
    if keep_category:
        out = out.where(F.col("asset_cat") == keep_category)
    return out


_HOLDING = ("name string, title string, cusip string, identifiers struct<isin: struct<_value: string>>, valUSD double, "
            "pctVal double, assetCat string, _broken string")


def read_holdings_files(spark: SparkSession, path: str, keep_category: str | None = EQUITY_ASSET_CATEGORY) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of filing files under ``path``, one row per holding of
    ``parse_holdings_xml`` and one per holding that does not parse, with its
    text; folders ``filed_date=...`` give the date.

    Files are cut at the holdings' tags while they are read, so a filing of
    any size is read by many tasks and one bad holding costs only itself.  A
    file without any holding fails the job."""
    tag = "invstOrSec>"  # ends both the opening and the closing tag
    read = spark.read.option("lineSep", tag).text(path)
    dated = [F.col("filed_date").cast("date").alias("nport_filed_date")] if "filed_date" in read.columns else []
    # what stands before a closing tag is a holding
    body = F.regexp_extract("value", r"(?s)^(?:.*<[^<>]*invstOrSec\s[^>]*>)?(.*)</[^<>/]*$", 1)
    parts = read.select(F.col("_metadata.file_path").alias("file"), F.rlike("value", F.lit(r"</[^<>/]*$")).alias("whole"), body.alias("body"), *dated)
    empty = parts.groupBy("file").agg(F.count_if("whole").alias("n")).select(F.min("n").alias("n"))
    held = parts.where("whole").withColumn("body", F.when(empty.scalar() == 0, F.raise_error(F.lit(
        "parsed zero holdings from a filing document"))).otherwise(F.col("body")))
    text = F.concat(F.lit("<invstOrSec>"), "body", F.lit("</invstOrSec>"))
    d = held.withColumn("h", F.from_xml(text, _HOLDING, {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}))
    broken = F.col("h._broken").isNotNull() | F.col("h").isNull()
    kept = [c for c in ["nport_filed_date"] if dated]
    rows = d.where(~broken).select(
        F.col("h.name").alias("name"), F.col("h.title").alias("title"), F.col("h.cusip").alias("cusip"),
        F.col("h.identifiers.isin._value").alias("isin"), F.col("h.assetCat").alias("asset_cat"),
        F.col("h.pctVal").alias("pct_val"), F.col("h.valUSD").alias("val_usd"), *kept)
    if keep_category:
        rows = rows.where(F.col("asset_cat") == keep_category)
    return rows, d.where(broken).select("file", F.col("body").alias("text"), F.lit("malformed holding").alias("reason"))


# ---- filing index ----------------------------------------------------------
_INDEX_SCHEMA = ("struct<filings: struct<recent: struct<form: array<string>, accessionNumber: array<string>, "
                 "filingDate: array<string>>>>")


def pick_filing(landed: DataFrame, filer: str = "cik", payload: str = "payload",
                form: str = FILING_FORM) -> tuple[DataFrame, DataFrame]:
    """Most recent entry whose form matches, from three parallel arrays
    (most recent first within each index page); dashes removed from the
    accession number.  A filer's index may span several pages: each page
    yields its first hit and the filer keeps the latest (a partial
    aggregate, so a filer with a huge history is still no single group).
    Filers without any hit are rejects."""
    r = F.from_json(F.col(payload), _INDEX_SCHEMA)["filings"]["recent"]
    z = F.arrays_zip(r["form"].alias("form"), r["accessionNumber"].alias("acc"),
                     r["filingDate"].alias("filed"))
    hit = F.get(F.filter(z, lambda x: x["form"] == F.lit(form)), 0)
    p = landed.select(F.col(filer).alias("cik"), hit.alias("h"))
    best = p.groupBy("cik").agg(F.max_by("h", F.struct(F.col("h.filed"), F.col("h.acc"))).alias("h"),
                                F.count("h").alias("_hits"))
    rows = best.where(F.col("_hits") > 0).select(
        "cik", F.replace(F.col("h.acc"), F.lit("-"), F.lit("")).alias("accession"),
        F.to_date("h.filed").alias("filed_date"))
    rejects = best.where(F.col("_hits") == 0).select(
        F.lit("filings").alias("source"), F.col("cik").alias("key"), F.lit(f"no {form} filing").alias("reason"))
    return rows, rejects


# ---- HTML constituents table ---------------------------------------------
# FIXED VALUES: page header → column.
HTML_COLUMNS = [("Symbol", "ticker"), ("Security", "company_name"), ("GICS Sector", "gics_sector"),
                ("GICS Sub-Industry", "gics_sub_industry"), ("Date added", "date_added")]

_TAGS = r"(?s)<[^>]+>"


# FIXED VALUES: named entities of the page; the ampersand's comes last, so
# that an escaped entity is not decoded twice.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&ndash;", "\u2013"),
            ("&mdash;", "\u2014")]


def _numeric_entities(t: Column) -> Column:
    """Decimal and hexadecimal character references as their characters;
    what is none stays."""
    pieces = F.split(t, "&#")

    def decoded(p):
        hexa = F.regexp_extract(p, r"^[xX]([0-9a-fA-F]{1,6});", 1)
        code = F.when(hexa != "", hexa).otherwise(
            F.hex(F.nullif(F.regexp_extract(p, r"^([0-9]{1,7});", 1), F.lit("")).cast("long")))
        ok = code.isNotNull() & (F.lpad(code, 8, "0") <= "0010FFFF")
        char = F.decode(F.unhex(F.lpad(F.upper(code), 8, "0")), "UTF-32")
        return F.when(ok, F.concat(char, F.regexp_replace(p, r"^[^;]*;", ""))).otherwise(F.concat(F.lit("&#"), p))

    rest = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), decoded)
    return F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, ""))


def _cell_text(c: Column) -> Column:
    t = F.regexp_replace(c, _TAGS, "")
    for ent, ch in ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(ch))
    return strip(F.replace(_numeric_entities(t), F.lit("&amp;"), F.lit("&")))


def parse_constituents_html(landed: DataFrame, page: str = "page_id", html: str = "html") -> DataFrame:
    """First table of each page → rows.  The header row drives the column
    mapping (a missing expected header fails the job); tickers are
    normalised (dot → dash, trimmed); dates are parsed leniently (bad →
    NULL); the first row per ticker wins in page/row order."""
    table = F.regexp_extract(F.col(html), r"(?s)<table[^>]*>(.*?)</table>", 1)
    t = landed.select(F.col(page).alias("page"), table.alias("t"))
    heads = F.transform(F.regexp_extract_all(F.col("t"), F.lit(r"(?s)<th[^>]*>(.*?)</th>"), F.lit(1)), _cell_text)
    need = F.array(*[F.lit(h) for h, _ in HTML_COLUMNS])
    missing = F.array_except(need, heads)
    heads = F.when(F.size(missing) > 0, F.raise_error(F.concat(
        F.lit("constituents table schema drift, missing: "), F.array_join(missing, ",")))).otherwise(heads)
    rows = F.regexp_extract_all(F.col("t"), F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    r = t.select("page", heads.alias("heads"), F.posexplode(rows).alias("row_pos", "tr"))
    cells = F.transform(F.regexp_extract_all(F.col("tr"), F.lit(r"(?s)<td[^>]*>(.*?)</td>"), F.lit(1)), _cell_text)
    r = r.select("page", "row_pos", "heads", cells.alias("cells")).where(F.size("cells") > 0)

    def cell(header):
        return F.get(F.col("cells"), F.array_position(F.col("heads"), F.lit(header)).cast("int") - 1)

    out = r.select("page", "row_pos", *[cell(h).alias(c) for h, c in HTML_COLUMNS])
    out = (out.withColumn("ticker", normalize_ticker("ticker"))
              .withColumn("date_added", F.try_to_date(F.col("date_added"), "yyyy-MM-dd")))
    from ..operators.dedup import keep_one
    out = keep_one(out, ["ticker"], [F.col("page"), F.col("row_pos")], last=False)
    return out.select(*[c for _, c in HTML_COLUMNS])


# ---- wide vendor frames ----------------------------------------------------
# FIXED VALUES: vendor field labels → our column names (wide frames).
WIDE_FIELDS = [("Open", "open"), ("High", "high"), ("Low", "low"), ("Close", "close"),
               ("Adj Close", "adj_close"), ("Volume", "volume"), ("Dividends", "dividends"),
               ("Stock Splits", "stock_splits")]
WIDE_CORE = ["open", "high", "low", "close", "adj_close", "volume"]


def wide_to_long(wide: DataFrame, date_col: str = "date", sep: str = ".") -> DataFrame:
    """A genuinely wide frame (columns ``{ticker}{sep}{field}``) → one row per
    (ticker, date).  The column list comes from the schema (metadata), not
    from data.  All-null ticker blocks are dropped."""
    label = dict(WIDE_FIELDS)
    cols = [c for c in wide.columns if c != date_col and sep in c]
    pairs = [(c, *c.rsplit(sep, 1)) for c in cols]
    tickers = sorted({t for _, t, _ in pairs})
    fields = [f for f, _ in WIDE_FIELDS if any(ff == f for _, _, ff in pairs)]
    missing = [label[f] for f, _ in WIDE_FIELDS if f not in fields and label[f] in WIDE_CORE]
    if missing:
        raise ValueError(f"wide frame lacks core fields: {missing}")
    blocks = []
    for t in tickers:
        present = {f: c for c, tt, f in pairs if tt == t}
        blocks.append(F.struct(F.lit(t).alias("ticker"), *[
            (F.col(f"`{present[f]}`").cast("double") if f in present else F.lit(None).cast("double"))
            .alias(label[f]) for f in fields]))
    long = wide.select(F.col(date_col).alias("date"), F.explode(F.array(*blocks)).alias("b")).select("date", "b.*")
    return long.dropna("all", subset=[label[f] for f in fields]).withColumn("volume", F.col("volume").cast("long"))


def cells_to_long(cells: DataFrame, key: str = "cells", date_col: str = "date", sep: str = ".") -> DataFrame:
    """The same reshape for wide frames landed as one map per (batch, date)
    (``"{ticker}{sep}{field}" → value``): explode, split the key, pivot the
    known fields back with conditional aggregates per (ticker, date).  A
    response that lacks a core field altogether fails the job."""
    fields = F.transform(F.map_keys(key), lambda k: F.element_at(F.split(k, f"\\{sep}"), -1))
    core = [f for f, c in WIDE_FIELDS if c in WIDE_CORE]
    missing = F.array_except(F.array(*map(F.lit, core)), fields)
    checked = F.when((F.size(key) > 0) & (F.size(missing) > 0), F.raise_error(F.concat(
        F.lit("wide response lacks core fields: "), F.array_join(missing, ",")))).otherwise(F.col(key))
    e = cells.select(F.col(date_col).alias("date"), F.explode(checked).alias("k", "v"))
    pos = F.length("k") - F.locate(sep, F.reverse("k")) + 1  # last separator
    e = e.select("date", F.substring("k", F.lit(1), pos - 1).alias("ticker"),
                 F.expr(f"substring(k, {'length(k) - locate(' + repr(sep) + ', reverse(k)) + 2'})").alias("field"), "v")
    aggs = [F.max(F.when(F.col("field") == f, F.col("v"))).alias(c) for f, c in WIDE_FIELDS]
    long = e.groupBy("ticker", "date").agg(*aggs)
    return long.dropna("all", subset=[c for _, c in WIDE_FIELDS]).withColumn("volume", F.col("volume").cast("long"))
