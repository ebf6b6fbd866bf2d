"""WARC archives whose repeated payloads are revisit records.

Records are written and read by Spark: one text row per record (its header
block, its HTTP head and, for responses, the payload), so files are committed
like those of any other job and need no local disk.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
URN = "urn:page:"
BASE32_CONV = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORD_SCHEMA = ("record_type string, page_id string, url string, payload_digest string, payload_bytes long, "
                 "refers_to string, payload binary")


def base32_sha1(payload: Column) -> Column:
    """SHA-1 as 32 upper-case base-32 letters (ten hex digits are eight letters)."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), BASE32_CONV, BASE32)


def resolve(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Headers (page_id, payload_digest, payload_bytes, record_type, refers_to) of ``pages``.

    Only headers move: they are grouped by payload digest with a map-side
    maximum, and every record joins its group's response (AQE splits a digest
    that holds many records).  In a group of payloads of ``min_bytes`` or more
    the largest page_id is the response and the others revisit it; below it
    all are responses.  A null html is the empty payload.  A repeated row with
    the largest page_id is a response again; where every page_id of a group is
    null, all are responses; other null ids revisit.  Extra columns are not read.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    heads = pages.select(F.col("page_id"), base32_sha1(payload).alias("payload_digest"),
                         F.octet_length(payload).cast("long").alias("payload_bytes"))
    firsts = heads.groupBy("payload_digest").agg(F.max("page_id").alias("first_id"))
    original = (F.col("payload_bytes") < min_bytes) | F.col("first_id").isNull() | F.col("page_id").eqNullSafe(F.col("first_id"))
    return heads.join(firsts, "payload_digest").select(
        "page_id", "payload_digest", "payload_bytes",
        F.when(original, "response").otherwise("revisit").alias("record_type"),
        F.when(~original, F.col("first_id")).alias("refers_to"))


def _clean(value: Column) -> Column:
    """A header value on one line."""
    return F.regexp_replace(value, r"[\r\n]+", " ")


def _lines(*pairs: tuple[str, Column]) -> Column:
    return F.concat_ws("\r\n", *[F.concat(F.lit(f"{k}: "), v) for k, v in pairs])


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2025-01-01T00:00:00Z",
               file_bytes: int = 16 << 20) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) below ``path``.

    Headers are resolved first (see :func:`resolve`) and joined to the
    payloads by record, so a digest with many pages does not gather payloads.
    A revisit keeps its HTTP head and drops the payload.  Files hold about
    ``file_bytes`` before gzip (one record at least).  A null url is left out of the
    header.  An empty table writes no record.
    """
    heads = resolve(pages, min_bytes).dropDuplicates(["page_id", "payload_digest"])
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"), base32_sha1(payload).alias("digest"))
    total = pages.select(F.sum(F.octet_length(F.coalesce(F.col("html"), F.lit(""))) + F.lit(600))).first()[0] or 0
    n = max(1, -(-int(total) // file_bytes))
    heads = heads.select(F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("id"), F.col("payload_digest").alias("digest"),
                         "payload_bytes", "record_type", F.col("refers_to").cast("string").alias("refers_to"))
    joined = rows.repartition(n, "id", "digest").join(heads, ["id", "digest"])
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END))
    body = F.when(F.col("record_type") == "response", F.col("payload").cast("string")).otherwise("")
    revisit = F.col("record_type") == "revisit"
    block_bytes = F.octet_length(http) + F.octet_length(body)
    head = _lines(
        ("WARC-Type", F.col("record_type")),
        ("WARC-Record-ID", F.concat(F.lit(f"<{URN}"), _clean(F.col("id")), F.lit(">"))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", _clean(F.col("url"))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        ("WARC-Refers-To", F.when(revisit, F.concat(F.lit(f"<{URN}"), F.col("refers_to"), F.lit(">")))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", block_bytes.cast("string")))
    record = F.concat(F.lit(f"{VERSION}\r\n"), head, F.lit(END), http, body)
    joined.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


_FIELD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def parse_records(data: bytes) -> Iterator[dict]:
    """The records of one archive (gzip or plain), in order; lengths come from the headers.

    Size and digest of a response are measured on its payload, and a header
    that says otherwise is an error; a revisit has only its header's.
    """
    data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    at, view = 0, memoryview(data)
    while (at := data.find(b"WARC/1.", at)) >= 0:
        head_end = data.index(b"\r\n\r\n", at)
        fields = {k.lower(): v.decode("utf-8", "replace") for k, v in _FIELD.findall(data, data.index(b"\r\n", at) + 2, head_end + 2)}
        start, size = head_end + 4, int(fields[b"content-length"])
        http_end = data.index(b"\r\n\r\n", start) + 4
        http = dict((k.lower(), v) for k, v in _FIELD.findall(data, start, http_end - 2))
        kind = fields[b"warc-type"]
        digest, length = fields[b"warc-payload-digest"].removeprefix("sha1:"), int(http[b"content-length"])
        payload = bytes(view[http_end:start + size]) if kind == "response" else None
        if payload is not None:
            claimed = digest, length
            digest, length = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
            if claimed != (digest, length):
                raise ValueError(f"damaged record {fields[b'warc-record-id']}: payload of {length} bytes, sha1 {digest}, but its header says {claimed[1]}, {claimed[0]}")
        yield {
            "record_type": kind, "page_id": fields[b"warc-record-id"][len(URN) + 1:-1] or None,
            "url": fields.get(b"warc-target-uri"), "payload_digest": digest, "payload_bytes": length,
            "refers_to": fields[b"warc-refers-to"][len(URN) + 1:-1] if b"warc-refers-to" in fields else None,
            "payload": payload,
        }
        at = start + size + 4


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records below ``path`` as RECORD_SCHEMA; ``payloads=False`` leaves the payload column null."""
    schema = pa.schema([("record_type", pa.string()), ("page_id", pa.string()), ("url", pa.string()), ("payload_digest", pa.string()),
                        ("payload_bytes", pa.int64()), ("refers_to", pa.string()), ("payload", pa.binary())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for row in parse_records(content.as_py()):
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                    size += len(row["payload"] or b"") + 200
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parse, RECORD_SCHEMA)


def restore_payloads(records: DataFrame) -> DataFrame:
    """``records`` with every revisit's payload taken from the response that it refers to."""
    responses = records.filter(F.col("record_type") == "response").select(
        F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload").alias("original")).dropDuplicates(["refers_to", "payload_digest"])
    joined = records.join(responses, ["refers_to", "payload_digest"], "left")
    return joined.select("record_type", "page_id", "url", "payload_digest", "payload_bytes", "refers_to",
                         F.coalesce("payload", "original").alias("payload"))
