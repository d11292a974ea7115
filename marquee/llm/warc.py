"""Web archives with transaction assembly (operator 8).

``write_archive`` turns pages into WARC 1.1 records -- a request, a
response (or a revisit of the page whose payload is equal) and a metadata
record per capture, tied by ``WARC-Concurrent-To`` -- and Spark's text
writer stores them, as gzip files if asked: a record ends in CRLF CRLF, whose
last byte is the writer's line end.  ``read_records`` parses the archives by
``Content-Length`` and compares each response's payload with its digest;
``transactions`` joins request and metadata to their
capture through the concurrent-to ids, one nested row per capture.

Of pages with equal payloads of at least ``min_bytes`` bytes, the largest
page id is the response and the others are revisits; rows that repeat that
id are all responses.  Equality is that of SHA-256 and length.

Defined results: a null html is an empty payload; a null page id is written
without a page field, sorts below all ids and is read as null; line ends in
urls are percent-encoded, a null url becomes ``urn:none``; no pages, no
records.
"""

from __future__ import annotations

import gzip
import re
from base64 import b32encode
from hashlib import sha1

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CRLF = "\r\n"
RECORD = ("type string, id string, concurrent_to string, page_id long, refers_to long, uri string, "
          "payload_digest string, payload_bytes long, payload binary")


def base32_sha1(data: Column) -> Column:
    """SHA-1 as 32 base-32 characters: four groups of 40 bits."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def judged(pages: DataFrame, min_bytes: int = 0, salts: int = 32) -> DataFrame:
    """page_id, url, html, digest, size, and ``refers_to`` for revisits.
    The winner of each payload comes from a partial aggregate; the join
    back is salted, so a payload of very many pages spreads."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"),
                        F.sha2(html, 256).alias("key"), F.octet_length(html).cast("long").alias("size"))
    best = rows.filter(F.col("size") >= min_bytes).groupBy("key", "size").agg(
        F.max("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n") \
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int")) \
        .join(best, ["key", "size", "salt"], "left")
    return rows.withColumn("refers_to", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))) \
        .withColumn("digest", base32_sha1(F.encode("html", "UTF-8"))).drop("key", "salt", "first")


def _record(kind: str | Column, rec_id: Column, when: str, fields: list[Column], body: Column) -> Column:
    kind = kind if isinstance(kind, Column) else F.lit(kind)
    head = F.concat(F.lit("WARC/1.1" + CRLF + "WARC-Type: "), kind, F.lit(CRLF + "WARC-Record-ID: "), rec_id,
                    F.lit(f"{CRLF}WARC-Date: {when}{CRLF}"))
    return F.concat(head, *fields, F.lit("Content-Length: "), F.octet_length(body).cast("string"), F.lit(CRLF + CRLF), body,
                    F.lit(CRLF + "\r"))


def _field(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0, when: str = "2020-01-01T00:00:00Z",
                  rows_per_file: int = 2000, file_bytes: int = 1 << 26, compression: str = "none") -> None:
    """Write the archives of ``pages`` (page_id, url, html) under ``path``.
    Files hold at most ``rows_per_file`` captures and ``file_bytes`` bytes
    (or one capture) before compression ("none" or "gzip"), so each can be read as a whole by one task.  For this,
    pages are written by classes of payload size, each twice the one below;
    equal payloads are of one class."""
    size = F.coalesce(F.octet_length("html"), F.lit(0))
    level = F.greatest(F.ceil(F.log2(F.greatest(size, F.lit(1)) / F.lit(1 << 15))), F.lit(0)).cast("int")
    most = F.max(size.cast("long") + 12 * F.coalesce(F.octet_length(F.col("url").cast("string")), F.lit(0)) + 2048)
    levels = pages.groupBy(level.alias("level")).agg(most.alias("bytes")).collect()    # 17 rows at most
    for k, one in enumerate(levels or [None]):
        some = pages if len(levels) < 2 else pages.filter(level == one["level"])
        _write_class(some, path, min_bytes, when, min(rows_per_file, max(1, file_bytes // one["bytes"])) if one else rows_per_file,
                     "append" if k else "error", compression)


def _write_class(pages: DataFrame, path: str, min_bytes: int, when: str, rows_per_file: int, mode: str,
                 compression: str) -> None:
    rows = judged(pages, min_bytes)
    uri = F.coalesce(F.regexp_replace("url", r"[\r\n]", "%0A"), F.lit("urn:none"))
    part = F.sha1(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), "digest",
                              F.monotonically_increasing_id().cast("string")))
    rec = lambda k: F.concat(F.lit(f"<urn:sha1:{k}-"), part, F.lit(">"))
    page = lambda c: F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(">"))
    rows = rows.withColumn("capture", rec("c")).withColumn("uri", uri)
    about = [_field("WARC-Target-URI", F.col("uri"))]
    tie = [_field("WARC-Concurrent-To", F.col("capture"))]
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("size").cast("string"), F.lit(CRLF + CRLF), F.when(revisit, F.lit("")).otherwise(F.col("html")))
    capture = _record(F.when(revisit, "revisit").otherwise("response"), F.col("capture"), when, [
        *about, _field("WARC-Page-ID", page("page_id")), _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, _field("WARC-Refers-To", page("refers_to"))).otherwise(F.lit("")),
        F.when(revisit, F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}")).otherwise(F.lit("")),
        F.lit(f"Content-Type: application/http;msgtype=response{CRLF}")], http)
    request = _record("request", F.replace(F.col("capture"), F.lit(":c-"), F.lit(":q-")), when,
                      [*about, *tie, F.lit(f"Content-Type: application/http;msgtype=request{CRLF}")],
                      F.concat(F.lit("GET "), F.col("uri"), F.lit(f" HTTP/1.1{CRLF}{CRLF}")))
    meta = _record("metadata", F.replace(F.col("capture"), F.lit(":c-"), F.lit(":m-")), when,
                   [*about, *tie, F.lit(f"Content-Type: application/warc-fields{CRLF}")],
                   F.concat(F.lit("payloadBytes: "), F.col("size").cast("string"), F.lit(CRLF)))
    rows.select(F.explode(F.array(request, capture, meta)).alias("value")) \
        .write.mode(mode).option("lineSep", "\n").option("maxRecordsPerFile", 3 * rows_per_file) \
        .option("compression", compression).text(path)


_HEAD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def parse(data: bytes):
    """(fields, block) of each record of an archive file."""
    at = 0
    while at < len(data):
        to = data.index(b"\r\n\r\n", at) + 4
        fields = {k.lower().decode(): v.decode("utf-8") for k, v in _HEAD.findall(data, at, to)}
        end = to + int(fields["content-length"])
        yield fields, data[to:end]
        at = end + 4


def _number(value: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    return int(m[1]) if m else None


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record.  ``payload`` is the HTTP body of responses (left
    null with ``payloads=False``).  A row of the input is a whole file; Spark
    bounds the bytes of an Arrow batch.  Plain and gzip files are read alike."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def run(batches):
        for b in batches:
            for data in b["content"]:
                out = []
                for f, block in parse(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                    size = body = None
                    if f["warc-type"] in ("response", "revisit"):
                        head, _, body = block.partition(b"\r\n\r\n")
                        size = int(re.search(rb"(?i)^content-length:\s*(\d+)", head, re.M)[1])
                        if f["warc-type"] == "response" and size != len(body):
                            raise ValueError("payload length differs from its header")
                        if f["warc-type"] == "response" and "sha1:" + b32encode(sha1(body).digest()).decode() != f.get("warc-payload-digest"):
                            raise ValueError("payload differs from its digest")
                    out.append((f["warc-type"], f["warc-record-id"], f.get("warc-concurrent-to"), _number(f.get("warc-page-id")),
                                _number(f.get("warc-refers-to")), f.get("warc-target-uri"),
                                (f.get("warc-payload-digest") or "").removeprefix("sha1:") or None, size,
                                body if payloads and f["warc-type"] == "response" else None))
                    if len(out) == 512:
                        yield _frame(out)
                        out = []
                yield _frame(out)

    return files.mapInPandas(run, RECORD)


def _frame(rows: list) -> pd.DataFrame:
    names = [c.strip().split(" ")[0] for c in RECORD.split(",")]
    out = pd.DataFrame(rows, columns=names)
    return out.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture`` and the ``request`` and
    ``metadata`` recorded with it (the first by record id, should an archive
    hold more; null if none), with how many there were.  One window over the
    concurrent-to ids, so the archives are parsed once."""
    is_capture = F.col("type").isin("response", "revisit")
    rows = records.withColumn("to", F.when(is_capture, F.col("id")).otherwise(F.col("concurrent_to"))) \
        .filter(is_capture | F.col("to").isNotNull())
    group = Window.partitionBy("to")

    def tied(kind):
        one = F.when(F.col("type") == kind, F.struct("id", "uri", "concurrent_to"))
        return [F.min(one).over(group).alias(kind), F.nullif(F.count(one).over(group), F.lit(0)).alias(f"n_{kind}")]

    capture = F.struct("type", "id", "page_id", "refers_to", "uri", "payload_digest", "payload_bytes", "payload")
    return rows.select(is_capture.alias("main"), capture.alias("capture"), *tied("request"), *tied("metadata")) \
        .filter("main").drop("main")
