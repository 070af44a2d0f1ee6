"""The archive gives back every capture, record and file byte for byte."""

import base64
import glob
import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from pricelake.llm import warc
from pricelake.llm.common import run_folder
from tests.conftest import SF

PAGES = [(1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, "http://a/3", "zwei ü\U0001f600\r\n\r\nWARC/1.0\r\n"),
         (4, None, None), (5, "http://a/5", ""), (6, "http://a/\r\nWARC-Type: warcinfo", "x" * 200_000), (7, "http://a/7", "<p>ONE</p>"),
         (8, "http://a/8", "<p>one</p>"), (8, "http://a/8", "<p>one</p>"), (None, "http://a/n", "<p>one</p>"),
         (None, "http://a/n1", "only null"), (None, "http://a/n2", "only null"), (9, "", "x" * 200_000), (-5, "u", "one\n")]
SCHEMA = "page_id long, url string, html string, key string, `check` string, header string, payload string, keep_id long"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "k", "c", "h", "p", 0) for r in PAGES], SCHEMA).repartition(3)


def expected(least=0):
    out = []
    for page_id, _, html in PAGES:
        t = (html or "").encode()
        ids = [i for i, _, h in PAGES if (h or "").encode() == t and i is not None]
        keep = max(ids, default=None)
        revisit = len(t) >= least and page_id != keep
        out.append((page_id, len(t), base64.b32encode(hashlib.sha1(t).digest()).decode(), "revisit" if revisit else "response",
                    keep if revisit else None, html or ""))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload").collect()), key=repr)


def parse(content: bytes):
    """(headers, block) of every record of a WARC file, by its own lengths."""
    while content:
        head, _, rest = content.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.0"
        fields = dict(x.split(": ", 1) for x in lines[1:])
        n = int(fields["Content-Length"])
        assert rest[n:n + 4] == b"\r\n\r\n"
        yield fields, rest[:n]
        content = rest[n + 4:]


@pytest.mark.parametrize("least", [0, 5, 11, 10 ** 9])
def test_every_capture_comes_back(spark, pages, least):
    folder = run_folder(spark, "warc-test")
    warc.archive(pages, folder, least_bytes=least)
    back = warc.read_back(spark, folder)
    assert got(back) == expected(least)
    assert spark.read.parquet(f"{folder}/payloads").count() == len({h or "" for _, _, h in PAGES})
    assert {r.target_uri for r in back.collect()} == {u and u.replace("\r", "%0D").replace("\n", "%0A") for _, u, _ in PAGES if u != ""}


def test_warc_files_parse_by_their_lengths(spark, pages, tmp_path):
    folder, out = run_folder(spark, "warc-test"), str(tmp_path / "out")
    warc.archive(pages, folder)
    warc.write_warc(spark, folder, out)
    seen = []
    for f in glob.glob(f"{out}/part-*"):
        for fields, block in parse(open(f, "rb").read()):
            http, _, payload = block.partition(b"\r\n\r\n")
            assert http.startswith(b"HTTP/1.1 200 OK")
            if fields["WARC-Type"] == "response":
                assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
                assert f"Content-Length: {len(payload)}".encode() in http
            else:
                assert payload == b"" and fields["WARC-Profile"] == warc.REVISIT_PROFILE
            seen.append((fields["WARC-Record-ID"], fields["WARC-Type"], fields.get("WARC-Refers-To")))
    urn = "<urn:page:{}>".format
    assert sorted(seen, key=repr) == sorted(((urn("null" if i is None else i), kind, None if k is None else urn(k)) for i, _, _, kind, k, _ in expected()), key=repr)


def test_colliding_digests_share_nothing(spark, pages):
    def weak(c):
        return F.octet_length(c).cast("string").cast("binary")

    folder = run_folder(spark, "warc-test")
    warc.archive(pages, folder, digest=weak)
    assert got(warc.read_back(spark, folder, digest=weak)) == expected()


def test_a_changed_payload_is_found(spark, pages):
    folder = run_folder(spark, "warc-test")
    warc.archive(pages, folder)
    p = spark.read.parquet(f"{folder}/payloads")
    p.withColumn("payload", F.when(F.length("payload") > 20, F.concat("payload", F.lit("!"))).otherwise(F.col("payload"))).write.parquet(f"{folder}/changed/payloads")
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{folder}/changed/headers")
    with pytest.raises(Exception, match="differs from its address"):
        warc.read_back(spark, f"{folder}/changed").select("page_id").collect()
    p.where("length(payload) < 20").write.parquet(f"{folder}/lost/payloads")
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{folder}/lost/headers")
    with pytest.raises(Exception, match="no payload as the header names it"):
        warc.read_back(spark, f"{folder}/lost").count()


def test_hot_payload_and_empty_table(spark):
    d = spark.range(0, 3000, 1, 8).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(
        F.col("id") % 3 == 0, "hot " * 50).otherwise(F.concat(F.lit("page "), F.col("id") % 1000)).alias("html"))
    folder = run_folder(spark, "warc-test")
    warc.archive(d, folder)
    b = warc.read_back(spark, folder)
    assert b.where("record_type = 'response'").count() == spark.read.parquet(f"{folder}/payloads").count() == d.select("html").distinct().count()
    assert b.where("refers_to = 2997").count() == 999
    folder = run_folder(spark, "warc-test")
    warc.archive(d.where("false"), folder)
    assert warc.read_back(spark, folder).count() == 0


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{SF}/pages.parquet')")
    want = con.execute(warc.SQL).fetchall()
    df = warc.query(spark, SF)
    assert df.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted(want, key=repr)
