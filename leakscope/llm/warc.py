"""A content-addressed archive of WARC records (WARC 1.1, ISO 28500).

Three facts are kept apart: what a payload holds (``payloads``: its bytes once, by SHA-256), what a record says
(``headers``: the exact header bytes of every record, and the digest its payload is found by), and how a record
is put together again (a join of the two). A payload's address is its SHA-256 with its length and a second,
independent hash; rows share an address only if all three agree, and reading checks stored bytes against it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ADDRESS = ["digest", "size", "mark"]
# Rows of one payload that are joined by one task; a payload with more is copied to as many more.
SHARE = 10_000
# Fixed value: what a revisit record names as its profile (WARC 1.1, section 6.7.2).
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def _line(name: str, *value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), *[F.lit(v) if isinstance(v, str) else v for v in value], F.lit("\r\n"))


def _urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def _one_line(value: Column) -> Column:
    """A header value: line ends and other control characters percent-encoded, null empty."""
    out = F.coalesce(value.cast("string"), F.lit(""))
    for code in (37, *range(32), 127):
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return out


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  date: str = "2024-01-01T00:00:00Z", least: int = 100) -> None:
    """Write one record per row to ``path/payloads`` and ``path/headers``.

    The payload is the UTF-8 of ``payload_col`` (null: empty). Of records with equal payloads of ``least`` bytes or
    more that with the smallest id is a response and the others revisit it; smaller payloads are stored once
    too, but each of their records is a response. Null ids come last; rows that repeat the response's id are
    responses as well. An empty table makes an empty archive.

    Equal payloads meet in a partial aggregate in each task before they are shuffled, so a payload that a third
    of all pages share crosses the network once per task. Headers are narrow; their join may be split.
    """
    body = F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").alias("page"), F.col(f"`{url_col}`").alias("url"), body.alias("payload")).select(
        "*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("size"),
        F.xxhash64("payload").alias("mark"))
    once = rows.groupBy(*ADDRESS).agg(F.any_value("payload").alias("payload"), F.min("page").alias("first"),
                                      F.count("*").alias("records"))
    once.write.option("compression", "zstd").parquet(f"{path}/payloads")
    known = pages.sparkSession.read.parquet(f"{path}/payloads").select(*ADDRESS, "first", "records")
    records = rows.drop("payload").join(known, ADDRESS)
    again = (F.col("size") >= least) & ~F.col("page").eqNullSafe(F.col("first"))
    kind = F.when(again, "revisit").otherwise("response")
    length = F.octet_length(F.lit(HTTP)) + F.octet_length(_line("Content-Length", F.col("size").cast("string"))) + 2
    named = F.concat(F.lit("sha256:"), F.col("digest"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", kind), _line("WARC-Record-ID", _urn(F.col("page"))),
        _line("WARC-Date", date), _line("WARC-Target-URI", _one_line(F.col("url"))), _line("WARC-Payload-Digest", named),
        F.when(again, F.concat(_line("WARC-Profile", PROFILE), _line("WARC-Refers-To", _urn(F.col("first"))))).otherwise(""),
        _line("Content-Type", "application/http; msgtype=response"),
        _line("Content-Length", F.when(again, length).otherwise(length + F.col("size")).cast("string")), F.lit("\r\n"))
    http = F.concat(F.lit(HTTP), _line("Content-Length", F.col("size").cast("string")), F.lit("\r\n"))
    records.select(header.cast("binary").alias("header"), http.cast("binary").alias("http_header"), *ADDRESS, "records").write.option(
        "compression", "zstd").parquet(f"{path}/headers")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """All records: ``header``, ``http_header`` and the full ``payload``, of revisits too, each joined to its headers by
    address. A payload whose bytes do not have the digest it is stored by fails the job.

    A payload with very many records is copied once per ``SHARE`` of them, so its records spread over tasks.
    """
    headers = spark.read.parquet(f"{path}/headers")
    stored_ = spark.read.parquet(f"{path}/payloads").select(*ADDRESS, "payload", "records")
    parts = F.ceil(F.col("records") / SHARE).cast("int")
    verified = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("stored payload does not have digest "), F.col("digest"))).cast("binary"))
    payloads = stored_.select(*ADDRESS, verified.alias("payload"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    dealt = headers.withColumn("part", F.pmod(F.xxhash64("header"), parts).cast("int")).drop("records")
    return dealt.join(payloads, [*ADDRESS, "part"]).select("header", "http_header", "payload", *ADDRESS)


def field(header: Column, name: str) -> Column:
    """A named field of header bytes; null where the record has none."""
    got = F.regexp_extract(header.cast("string"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(got != "", got)


def page_of(urn: Column) -> Column:
    """The page id in a record id; null where the page had none."""
    return F.regexp_extract(urn, "^<urn:page:(.*)>$", 1).try_cast("long")


def record_bytes(row_header: str = "header", http: str = "http_header", payload: str = "payload") -> Column:
    """A record as it stands in a WARC file: header, block and two line ends; a revisit's block has no payload."""
    revisit = field(F.col(row_header), "WARC-Type") == "revisit"
    return F.concat(F.col(row_header), F.col(http), F.when(revisit, F.lit(b"")).otherwise(F.col(payload)), F.lit(b"\r\n\r\n"))
