import json

import pytest
from pyspark.sql import functions as F

from pricelake.sources import payloads


def test_price_records_parse_and_drop_timezone(spark):
    rec = [{"date": "2024-01-02T00:00:00.000Z", "open": 1.0, "high": 2.0, "low": 0.5, "close": 1.5, "volume": 10,
            "adjClose": 1.4, "adjOpen": 0.9, "adjHigh": 1.9, "adjLow": 0.4, "adjVolume": 20}]
    landed = spark.createDataFrame([("AAA", json.dumps(rec)), ("BBB", "[]")], "ticker string, payload string")
    rows, rejects = payloads.parse_price_records(landed)
    r = rows.first()
    assert str(r.date) == "2024-01-02" and r.adj_close == 1.4 and r.adj_volume == 20 and r.ticker == "AAA"
    assert [x.key for x in rejects.collect()] == ["BBB"]


def test_price_records_schema_drift_fails(spark):
    landed = spark.createDataFrame([("AAA", json.dumps([{"date": "2024-01-02", "open": 1.0}]))],
                                   "ticker string, payload string")
    with pytest.raises(Exception, match="schema drift"):
        payloads.parse_price_records(landed)[0].collect()


def test_observations_drop_placeholders(spark):
    good = {"observations": [{"date": "2024-01-02", "value": "4.1"}, {"date": "2024-01-03", "value": "."}]}
    dots = {"observations": [{"date": "2024-01-02", "value": "."}]}
    landed = spark.createDataFrame([("DGS10", json.dumps(good)), ("CPIAUCSL", json.dumps(dots)),
                                    ("FEDFUNDS", json.dumps({"observations": []}))],
                                   "series_id string, payload string")
    rows, rejects = payloads.parse_observations(landed)
    assert [(r.series_id, r.value) for r in rows.collect()] == [("DGS10", 4.1)]
    assert {(r.key, r.reason) for r in rejects.collect()} == {
        ("CPIAUCSL", "only placeholder values"), ("FEDFUNDS", "no observations")}


def test_observations_bad_text_still_fails(spark):
    landed = spark.createDataFrame([("X", json.dumps({"observations": [{"date": "2024-01-02", "value": "abc"}]}))],
                                   "series_id string, payload string")
    with pytest.raises(Exception):
        payloads.parse_observations(landed)[0].collect()


def test_identifier_zip_first_match_and_rejects(spark):
    resp = [{"data": [{"figi": "BBG1", "name": "A"}, {"figi": "BBG2", "name": "A2"}]},
            {"warning": "No identifier found."}]
    landed = spark.createDataFrame([(["AAA", "BBB"], json.dumps(resp))], "requested array<string>, payload string")
    rows, rejects = payloads.parse_identifier_responses(landed)
    assert [(r.ticker, r.figi) for r in rows.collect()] == [("AAA", "BBG1")]
    assert [(r.key, r.reason) for r in rejects.collect()] == [("BBB", "No identifier found.")]


def test_identifier_length_mismatch_fails(spark):
    landed = spark.createDataFrame([(["AAA", "BBB"], json.dumps([{"data": []}]))],
                                   "requested array<string>, payload string")
    with pytest.raises(Exception, match="1:1"):
        payloads.parse_identifier_responses(landed)[0].collect()


XML = """<edgarSubmission xmlns="http://www.sec.gov/edgar/nport"><formData><invstOrSecs>
<invstOrSec><name>Apple Inc</name><title>Apple Inc</title><cusip>037833100</cusip>
<identifiers><isin value="US0378331005"/></identifiers><valUSD>100.5</valUSD><pctVal>7.1</pctVal>
<assetCat>EC</assetCat></invstOrSec>
<invstOrSec><name>Cash fund</name><title>Cash</title><cusip>000</cusip><identifiers/>
<valUSD>5</valUSD><pctVal>0.1</pctVal><assetCat>STIV</assetCat></invstOrSec>
<invstOrSec><name>No Isin Corp</name><title>NIC</title><cusip>111</cusip><identifiers/>
<valUSD>7</valUSD><pctVal>0.2</pctVal><assetCat>EC</assetCat></invstOrSec>
</invstOrSecs><other><name>not a holding</name></other></formData></edgarSubmission>"""


def test_holdings_xml(spark):
    landed = spark.createDataFrame([(XML, "2024-01-31")], "xml string, filed_date string")
    rows = {r.name: r for r in payloads.parse_holdings_xml(landed).collect()}
    assert set(rows) == {"Apple Inc", "No Isin Corp"}
    assert rows["Apple Inc"].isin == "US0378331005" and rows["No Isin Corp"].isin is None
    assert rows["Apple Inc"].val_usd == 100.5 and rows["Apple Inc"].nport_filed_date == "2024-01-31"


def test_holdings_xml_without_holdings_fails(spark):
    landed = spark.createDataFrame([("<edgarSubmission><formData/></edgarSubmission>", None)],
                                   "xml string, filed_date string")
    with pytest.raises(Exception, match="zero holdings"):
        payloads.parse_holdings_xml(landed).collect()


def test_filing_pick(spark):
    idx = {"filings": {"recent": {"form": ["10-Q", "NPORT-P", "NPORT-P"],
                                  "accessionNumber": ["1-1", "0000884394-24-000123", "0000884394-23-000001"],
                                  "filingDate": ["2024-03-01", "2024-02-27", "2023-11-20"]}}}
    landed = spark.createDataFrame([("SPY", json.dumps(idx)),
                                    ("OTHER", json.dumps({"filings": {"recent": {"form": ["10-K"],
                                     "accessionNumber": ["x"], "filingDate": ["2024-01-01"]}}}))],
                                   "cik string, payload string")
    rows, rejects = payloads.pick_filing(landed)
    r = rows.first()
    assert (r.cik, r.accession, str(r.filed_date)) == ("SPY", "000088439424000123", "2024-02-27")
    assert [x.key for x in rejects.collect()] == ["OTHER"]


def test_html_first_table_header_driven(spark):
    html = ("<table><tr><th>Security</th><th>Symbol</th><th>GICS Sector</th><th>GICS Sub-Industry</th>"
            "<th>Date added</th></tr><tr><td>Berkshire Hathaway</td><td> BRK.B </td><td>Financials</td>"
            "<td>Multi</td><td>2010-02-16</td></tr><tr><td>AT&amp;T</td><td>T</td><td>Comm</td><td>Tel</td>"
            "<td>unknown</td></tr></table><table><tr><th>x</th></tr><tr><td>NOPE</td></tr></table>")
    landed = spark.createDataFrame([(1, html)], "page_id int, html string")
    rows = {r.ticker: r for r in payloads.parse_constituents_html(landed).collect()}
    assert set(rows) == {"BRK-B", "T"}
    assert rows["T"].company_name == "AT&T" and rows["T"].date_added is None
    assert str(rows["BRK-B"].date_added) == "2010-02-16"


def test_html_missing_header_is_drift(spark):
    landed = spark.createDataFrame([(1, "<table><tr><th>Symbol</th></tr><tr><td>A</td></tr></table>")],
                                   "page_id int, html string")
    with pytest.raises(Exception, match="schema drift"):
        payloads.parse_constituents_html(landed).collect()


def test_wide_to_long_from_columns(spark):
    wide = spark.createDataFrame(
        [("2024-01-02", 1.0, 2.0, 0.5, 1.5, 1.4, 10.0, None, None, None, None, None, None)],
        "date string, `AAA.Open` double, `AAA.High` double, `AAA.Low` double, `AAA.Close` double, "
        "`AAA.Adj Close` double, `AAA.Volume` double, `B.C.Open` double, `B.C.High` double, `B.C.Low` double, "
        "`B.C.Close` double, `B.C.Adj Close` double, `B.C.Volume` double")
    rows = payloads.wide_to_long(wide).collect()
    assert [(r.ticker, r.close, r.volume) for r in rows] == [("AAA", 1.5, 10)]   # all-null block dropped


def test_wide_cells_to_long(spark):
    cells = spark.createDataFrame([("2024-01-02", {"B.C.Open": 1.0, "B.C.Close": 2.0, "B.C.Volume": 3.0, "B.C.High": None,
                                                   "B.C.Low": None, "B.C.Adj Close": None})],
                                  "date string, cells map<string,double>")
    r = payloads.cells_to_long(cells).first()
    assert (r.ticker, r.open, r.close, r.volume, r.high) == ("B.C", 1.0, 2.0, 3, None)


def test_html_as_pages_have_it(spark):
    page = ("<table><tr><th>Symbol\n</th><th>Security</th><th>GICS&nbsp;Sector</th><th>GICS Sector</th><th>GICS Sub-Industry</th>"
            "<th>Date added\n</th></tr><tr><td>&#160;BRK.B\n</td><td>A &amp;#38; B&apos;s &#x20AC;&#128512; &#xZZ;</td><td>x</td>"
            "<td>F&nbsp;</td><td>G</td><td>2001-02-03\n</td></tr></table>")
    (r,) = parse_html(spark, page)
    assert (r.ticker, r.gics_sector, str(r.date_added)) == ("BRK-B", "F", "2001-02-03")
    assert r.company_name == "A &#38; B's \u20ac\U0001f600 &#xZZ;"


def parse_html(spark, page):
    return payloads.parse_constituents_html(spark.createDataFrame([(1, page)], "page_id int, html string")).collect()


PRICE = ('[{"date": "%s", "open": 1, "high": %s, "low": 1, "close": 1, "volume": %s, "adjClose": 1, "adjOpen": 1, "adjHigh": 1,'
         ' "adjLow": 1, "adjVolume": 3}]')


def price(spark, date="2024-01-05T00:00:00.000Z", high="2.5", volume="7"):
    return payloads.parse_price_records(spark.createDataFrame([("A", PRICE % (date, high, volume))], "ticker string, payload string"))[0]


def test_price_dates_stand_as_written(spark):
    for offset in ("Z", "+09:00", "-11:00"):
        assert str(price(spark, f"2024-01-05T00:00:00.000{offset}").first().date) == "2024-01-05"


def test_price_values_are_cast_strictly(spark):
    r = price(spark, volume="7.0").first()
    assert (r.high, r.volume) == (2.5, 7)
    for bad in ({"high": '"abc"'}, {"volume": "10.5"}, {"volume": '"many"'}, {"date": "2024-13-05T00:00:00Z"}):
        with pytest.raises(Exception):
            price(spark, **bad).collect()


def test_price_payload_without_adjusted_fields_is_drift(spark):
    text = (PRICE % ("2024-01-05", "1", "1")).replace('"adjOpen": 1, ', "")
    df = spark.createDataFrame([("A", text)], "ticker string, payload string")
    with pytest.raises(Exception, match="adjOpen"):
        payloads.parse_price_records(df)[0].collect()


def test_landed_wide_response_without_a_core_field_is_drift(spark):
    df = spark.createDataFrame([("2024-01-05", {"A.Open": 1.0, "A.High": 1.0, "A.Low": 1.0, "A.Close": 1.0, "A.Volume": 1.0})],
                               "date string, cells map<string, double>")
    with pytest.raises(Exception, match="Adj Close"):
        payloads.cells_to_long(df).collect()


def test_tickers_lose_any_white_space(spark):
    from pricelake.functions import normalize_ticker
    df = spark.createDataFrame([("MMM\n",), ("\u00a0BRK.B\u2003\t",)], "t string")
    assert [r[0] for r in df.select(normalize_ticker("t")).collect()] == ["MMM", "BRK-B"]


def test_keys_asked_for_and_never_answered_are_dead_letters(spark, lake):
    import datetime as dt
    from pricelake.plans import ingest
    from pricelake.sources import bronze
    d = dt.date(2024, 1, 31)
    obs = spark.createDataFrame([("DGS10", '{"observations": [{"date": "2024-01-02", "value": "4.1"}]}')], "series_id string, payload string")
    asked = spark.createDataFrame([("DGS10",), ("NONE",)], "series_id string")
    assert [r.key for r in ingest.ingest_observations(spark, obs, d, lake, requested=asked).collect()] == ["NONE"]
    ingest.ingest_observations(spark, obs, d, lake, requested=asked.limit(1))
    assert bronze.read_rejects(spark, lake).count() == 0            # the newer, empty list replaces the old one


def filing(items, ns="nport:"):
    body = "\n".join(f"<{ns}invstOrSec{a}>{x}</{ns}invstOrSec>" for a, x in items)
    return (f'<?xml version="1.0"?>\n<{ns}edgarSubmission xmlns:nport="u"><{ns}headerData><{ns}name>filer</{ns}name></{ns}headerData>'
            f"<{ns}formData>\n<{ns}invstOrSecs>{body}</{ns}invstOrSecs></{ns}formData></{ns}edgarSubmission>\n")


def holding(i, ns="nport:", pct="1.5", cat="EC"):
    return (f"\n <{ns}name>N&amp;{i}</{ns}name><{ns}title>t &lt; {i}</{ns}title>"
            f"<{ns}identifiers><{ns}isin value=\"US{i}\"/></{ns}identifiers>"
            f"<{ns}pctVal>{pct}</{ns}pctVal><{ns}assetCat>{cat}</{ns}assetCat> ")


def test_holdings_files(spark, tmp_path):
    d = tmp_path / "filed_date=2024-01-31"
    d.mkdir()
    (d / "a.xml").write_text(filing([("", holding(i)) for i in range(5)] + [(' id="x"', holding(5)), ("", holding(6, cat="DBT"))]))
    (d / "b.xml").write_text(filing([("", holding(7, "", pct="n/a")), ("", "<name>open"), ("", holding(8, ""))], ns=""))
    rows, rejects = payloads.read_holdings_files(spark, str(tmp_path))
    got = {r.name: (r.title, r.isin, r.pct_val, str(r.nport_filed_date)) for r in rows.collect()}
    assert got == {f"N&{i}": (f"t < {i}", f"US{i}", 1.5, "2024-01-31") for i in (0, 1, 2, 3, 4, 5, 8)}
    lost = rejects.collect()
    assert len(lost) == 2 and all(r.file.endswith("b.xml") and r.reason == "malformed holding" for r in lost)
    assert payloads.read_holdings_files(spark, str(tmp_path), None)[0].count() == 8


def test_a_huge_filing_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "a.xml").write_text(filing([("", holding(i)) for i in range(20_000)]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        rows, rejects = payloads.read_holdings_files(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 8
        assert rows.agg(F.countDistinct("name")).first()[0] == 20_000 and rejects.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_file_without_holdings_fails(spark, tmp_path):
    (tmp_path / "a.xml").write_text(filing([("", holding(1))]))
    (tmp_path / "b.xml").write_text(filing([]))
    with pytest.raises(Exception, match="zero holdings"):
        payloads.read_holdings_files(spark, str(tmp_path))[0].collect()
