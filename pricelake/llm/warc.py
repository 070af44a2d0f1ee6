"""Content-addressed WARC archive.

``archive`` writes two tables.  ``payloads`` holds every distinct payload
once, under its address: the SHA-256 of its bytes, verified by their SHA-512
and number, so that records only share bytes on which both digests agree.
``headers`` holds, per record, the exact bytes that stand before its payload
(the WARC header block and the HTTP header) and the address.  Joining the two
gives back

* ``records``: every record byte for byte (a revisit carries no payload);
* ``write_warc``: the same as WARC files, one record after the other;
* ``read_back``: every capture with its payload, also those of revisits.

Reading parses the stored headers and compares each payload with its address,
its header's SHA-1 and its length; a difference fails the job.

Of records with equal payloads of at least ``least_bytes``, the one with the
largest id is the response and the others are revisits of it; smaller ones
are all responses, though their bytes too are stored once.

Only digests, ids and lengths are grouped, combined before the shuffle; a
payload moves once to be stored and once to be read.  Rows of a payload that
makes up a third of the table are dealt by id when the winner is looked up,
and meet the winner's row in a join that Spark can split on their side.  All
of it is DataFrame code without Python workers.

Defined results: a null payload counts as empty; a null id loses to any, and
copies that all have null ids are all responses; rows that repeat the winning
id are responses each; a null URL leaves its header out, and line breaks in a
URL are percent-encoded; other columns are ignored; empty tables give empty
archives.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import run_folder, table

CRLF = "\r\n"
#: Fixed by the WARC format: the profile of a revisit with the same payload.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: Fixed: digits of conv() to base 32 and those of the base 32 of RFC 4648.
CONV_DIGITS, BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CAPTURED = "1970-01-01T00:00:00Z"
PAYLOADS = "key binary, check binary, payload string"
HEADERS = "page_id long, header string, key binary, check binary"


def sha256(payload: Column) -> Column:
    return F.unhex(F.sha2(payload, 256))


def base32_sha1(payload: Column) -> Column:
    """Upper-case base 32: 40 bits are ten hexadecimal or eight base-32 digits."""
    h = F.sha1(payload.cast("binary"))
    eights = [F.lpad(F.conv(F.substring(h, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*eights), CONV_DIGITS, BASE32_DIGITS)


def _line(name: str, *value) -> Column:
    return F.concat(F.lit(f"{name}: "), *[v if isinstance(v, Column) else F.lit(v) for v in value], F.lit(CRLF))


def _header(revisit: Column, captured: str) -> Column:
    """The bytes before the payload, from page_id, url, keep_id, payload_bytes
    and payload_digest."""
    size = F.col("payload_bytes")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}"), _line("Content-Type", "text/html; charset=utf-8"),
                    _line("Content-Length", size.cast("string")), F.lit(CRLF))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))

    def urn(c):
        return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))

    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(size)
    return F.concat(
        F.lit(f"WARC/1.0{CRLF}"), _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", urn(F.col("page_id"))), F.coalesce(_line("WARC-Target-URI", url), F.lit("")),
        _line("WARC-Date", captured), _line("WARC-Payload-Digest", "sha1:", F.col("payload_digest")),
        F.when(revisit, F.concat(_line("WARC-Refers-To", urn(F.col("keep_id"))), _line("WARC-Profile", REVISIT_PROFILE))).otherwise(""),
        _line("Content-Type", "application/http; msgtype=response"), _line("Content-Length", block.cast("string")),
        F.lit(CRLF), http)


def archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            least_bytes: int = 0, captured: str = CAPTURED, digest: Callable[[Column], Column] = sha256) -> None:
    """Write the archive of ``pages`` under ``folder`` (shared storage).
    ``captured`` is the date that records carry."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"key": digest(F.col("payload")), "check": F.unhex(F.sha2("payload", 512)),
                             "payload_bytes": F.octet_length("payload").cast("long")})
    same = ["key", "check", "payload_bytes"]
    tally = rows.groupBy(*same).agg(F.max("page_id").alias("keep_id"))
    tally.write.parquet(f"{folder}/tally")
    tally = spark.read.parquet(f"{folder}/tally")
    # the winner's id is part of the join's key, so copies don't meet here, and
    # rows that repeat the winner lie together already
    def named(df, c):
        return df.withColumns({"id": F.coalesce(F.col(c), F.lit(0)), "no_id": F.col(c).isNull()})

    at = [*same, "id", "no_id"]
    stored = named(rows, "page_id").select(*at, "payload").join(named(tally, "keep_id").select(*at), at, "left_semi").dropDuplicates(at)
    stored.select("key", "check", "payload").write.parquet(f"{folder}/payloads")
    told = rows.withColumn("payload_digest", base32_sha1(F.col("payload"))).drop("payload").join(tally, same)
    revisit = (F.col("payload_bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("keep_id"))
    (told.select("page_id", _header(revisit, captured).alias("header"), "key", "check")
     .write.parquet(f"{folder}/headers"))


def _payloads(spark: SparkSession, folder: str, digest: Callable[[Column], Column]) -> DataFrame:
    """The stored payloads, each compared with its address, and what headers
    say of them.  Computed before any join, so that a reader who wants no
    payloads moves none."""
    p = spark.read.schema(PAYLOADS).parquet(f"{folder}/payloads")
    sound = (digest(F.col("payload")) == F.col("key")) & (F.unhex(F.sha2("payload", 512)) == F.col("check"))
    # a filter, so that no choice of columns skips the comparison
    p = p.where(F.when(sound, F.lit(True)).otherwise(F.raise_error(F.concat(
        F.lit("a payload differs from its address: "), F.hex("key"))).cast("boolean")))
    return p.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": base32_sha1(F.col("payload"))})


def _joined(spark: SparkSession, folder: str, digest: Callable[[Column], Column]) -> DataFrame:
    """Headers with the payloads they name; a payload that is missing, or that
    is not what the header says, fails the job."""
    told = spark.read.schema(HEADERS).parquet(f"{folder}/headers").withColumns({
        "_sha1": _field("WARC-Payload-Digest"),
        "_size": F.regexp_extract("header", r"(?s)\r\n\r\n.*\r\nContent-Length: ([0-9]+)\r\n", 1).cast("long")})
    d = told.join(_payloads(spark, folder, digest), ["key", "check"], "left")
    sound = (F.concat(F.lit("sha1:"), "payload_digest") == F.col("_sha1")) & (F.col("payload_bytes") == F.col("_size"))
    return d.where(F.when(F.coalesce(sound, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.concat(
        F.lit("no payload as the header names it: "), "_sha1")).cast("boolean")))


def _field(name: str) -> Column:
    """The first header line of a name (the WARC block comes first)."""
    return F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)\r\n", 1)


def records(spark: SparkSession, folder: str, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """page_id and record: every record as it was archived, without the two
    line breaks that end it."""
    body = F.when(_field("WARC-Type") == "response", F.col("payload")).otherwise("")
    return _joined(spark, folder, digest).select("page_id", F.concat("header", body).alias("record"))


def write_warc(spark: SparkSession, folder: str, out: str) -> None:
    """The archive as WARC files: the text writer ends each record with the
    format's two line breaks."""
    (records(spark, folder).select("record").write.option("compression", "none").option("lineSep", CRLF * 2).text(out))


def read_back(spark: SparkSession, folder: str, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Every capture out of the archive: page_id, target_uri, record_type,
    refers_to, payload, payload_bytes, payload_digest."""
    def page(name):
        return F.expr(f"try_cast(regexp_extract({name}, '^<urn:page:(-?[0-9]+)>$', 1) AS long)")

    d = _joined(spark, folder, digest).withColumns({
        "record_type": _field("WARC-Type"), "_id": _field("WARC-Record-ID"), "_of": _field("WARC-Refers-To"),
        "target_uri": F.nullif(_field("WARC-Target-URI"), F.lit(""))})
    return d.select(page("_id").alias("page_id"), "target_uri", "record_type", page("_of").alias("refers_to"), "payload",
                    "payload_bytes", "payload_digest")


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, strlen(t) AS payload_bytes, sha1(t) AS h, max(page_id) OVER (PARTITION BY t) AS keep_id FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('{BASE32_DIGITS}', CAST(1 + ((CAST('0x' || substr(h, CAST(1 + 10 * (i // 8) AS BIGINT), 10) AS BIGINT)
                                                             >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM keep_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM keep_id THEN keep_id END AS refers_to
FROM d
"""


def query(spark, sf_dir):
    folder = run_folder(spark, "warc")
    archive(table(spark, sf_dir, "pages"), folder)
    return read_back(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
