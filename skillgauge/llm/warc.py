"""WARC archives written and read by Spark, and assembly of capture transactions.

Writing: every page makes a request, a response (or revisit) and a metadata record. Spark's
text writer puts records, whose last line break pair is the line separator, into gzip files of a
bounded number of records. Reading: ``binaryFile`` rows are parsed record by record along their
``Content-Length``. Assembly: requests and metadata join their response through
``WARC-Concurrent-To``, one nested row per capture.

Pages with equal payloads are found by digest: counts and the smallest page are combined per task
before the shuffle, so a payload shared by a third of all pages is no hot key there; the join back to
the pages leaves a skewed digest to Spark's skew handling.

Defined cases: a null payload is empty. Pages without ``page_id`` come after all others; in a group
of only such pages all are responses. Rows that repeat the smallest ``page_id`` of a payload are all
responses. A null or blank URL leaves the header out. A request or metadata record whose response
is missing is a capture without response. Columns other than page_id, url, html are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgauge.llm import words as W
from skillgauge.session import shared_folder
from skillgauge.sources.stores import stage

_BREAK = "\r\n"
_RECORDS_PER_FILE = 6000
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# Fixed values of the format.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: five hex digits are four base32 digits."""
    digest = F.sha1(payload)
    letters = []
    for k in range(0, 40, 5):
        number = F.conv(F.substring(digest, k + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(_BASE32), F.shiftright(number, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def dedupe(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages with payload, payload_bytes, payload_digest and the page each revisit refers to. Payloads
    below ``min_bytes`` are never revisits."""
    known = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    known = known.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", base32_sha1(F.col("payload").cast("binary")))
    first = known.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = first.where("n > 1 and first is not null").select("payload_digest", "first")
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    return known.join(shared, "payload_digest", "left").withColumn(
        "refers_to", F.when(F.col("first").isNotNull() & (F.col("payload_bytes") >= min_bytes) & later, F.col("first"))).drop("first")


def _record(kind: Column, number: Column, headers: list[tuple[str, Column]], content_type: Column, block: Column) -> Column:
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), number), F.lit(f"WARC-Date: {_DATE}")]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    lines += [F.concat(F.lit("Content-Type: "), content_type), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(_BREAK, *lines), F.lit(_BREAK * 2), block)


def _urn(kind: str, number: Column) -> Column:
    h = F.md5(F.concat(F.lit(f"{kind}:"), number).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> None:
    """Write the archives of ``pages`` (page_id, url, html) to ``folder``."""
    rows = dedupe(pages, min_bytes).withColumn("row", F.concat(F.lit(uuid.uuid4().hex), F.monotonically_increasing_id().cast("string")))
    revisit = F.col("refers_to").isNotNull()
    response = _urn("response", F.col("row"))
    uri = ("WARC-Target-URI", F.nullif(F.trim(F.translate("url", "\r\n", "  ")), F.lit("")))
    page = ("WARC-Page-ID", F.col("page_id").cast("string"))
    digest = F.concat(F.lit("sha1:"), "payload_digest")
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{_BREAK}Content-Type: text/html; charset=utf-8{_BREAK}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(_BREAK * 2))
    http = F.lit("application/http")
    records = F.array(
        _record(F.when(revisit, "revisit").otherwise("response"), response, [
            uri, page, ("WARC-Payload-Digest", digest), ("WARC-Profile", F.when(revisit, _PROFILE)),
            ("WARC-Refers-To-Page-ID", F.col("refers_to").cast("string"))], http, F.when(revisit, head).otherwise(F.concat(head, "payload"))),
        _record(F.lit("request"), _urn("request", F.col("row")), [uri, page, ("WARC-Concurrent-To", response)], http,
                F.lit(f"GET / HTTP/1.1{_BREAK * 2}")),
        _record(F.lit("metadata"), _urn("metadata", F.col("row")), [uri, page, ("WARC-Concurrent-To", response)], F.lit("application/warc-fields"),
                F.concat(F.lit("payload-length: "), F.col("payload_bytes").cast("string"), F.lit(f"{_BREAK}payload-digest: "), digest, F.lit(_BREAK))),
    )
    rows.select(F.explode(records).alias("value")).write.option("lineSep", _BREAK * 2).option("compression", "gzip").option(
        "maxRecordsPerFile", _RECORDS_PER_FILE).text(folder)


def parse_records(data: bytes):
    """(headers, block) of every record of one archive; gzip members may be any number."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while True:
        at = data.find(b"WARC/", at)
        if at < 0:
            return
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split(_BREAK)[1:]
        headers = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        size = int(headers.get("content-length", 0))
        yield headers, data[end + 4 : end + 4 + size]
        at = end + 4 + size


_RECORD = pa.schema([
    ("type", pa.string()), ("record_id", pa.string()), ("concurrent_to", pa.string()), ("page_id", pa.int64()), ("uri", pa.string()),
    ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
_RECORD_SQL = (
    "type string, record_id string, concurrent_to string, page_id long, uri string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary")


def _number(text: str | None) -> int | None:
    return int(text) if text and text.lstrip("-").isdigit() else None


def _parse(with_payload: bool):
    def one(headers: dict, block: bytes) -> tuple:
        kind = headers.get("warc-type")
        payload, length, digest = None, None, headers.get("warc-payload-digest")
        if kind == "response":
            payload = block[block.find(b"\r\n\r\n") + 4 :]
            length, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        elif kind == "metadata":
            fields = dict(line.split(": ", 1) for line in block.decode("utf-8", "replace").split(_BREAK) if ": " in line)
            length, digest = _number(fields.get("payload-length")), fields.get("payload-digest")
        return (kind, headers.get("warc-record-id"), headers.get("warc-concurrent-to"), _number(headers.get("warc-page-id")),
                headers.get("warc-target-uri"), _number(headers.get("warc-refers-to-page-id")), length,
                digest.removeprefix("sha1:") if digest else None, payload if with_payload else None)

    def run(batches):
        for batch in batches:
            for data in batch.column("content").to_pylist():
                rows = []
                for headers, block in parse_records(data):
                    rows.append(one(headers, block))
                    if len(rows) >= 500:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _RECORD.types)], schema=_RECORD)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _RECORD.types)], schema=_RECORD)

    return run


def read_records(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives in ``folder``."""
    W.small_batches(spark)
    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(_parse(with_payload), _RECORD_SQL)


def assemble(records: DataFrame) -> DataFrame:
    """(capture_id, response, requests, metadata): one nested row per capture."""
    def side(kind: str) -> DataFrame:
        fields = F.struct("record_id", "page_id", "uri", "payload_bytes", "payload_digest")
        return records.where(F.col("type") == kind).groupBy(F.col("concurrent_to").alias("capture_id")).agg(F.collect_list(fields).alias(kind))

    responses = records.where(F.col("type").isin("response", "revisit")).select(
        F.col("record_id").alias("capture_id"),
        F.struct("type", "page_id", "uri", "refers_to", "payload_bytes", "payload_digest", "payload").alias("response"))
    joined = responses.join(side("request"), "capture_id", "full_outer").join(side("metadata"), "capture_id", "full_outer")
    return joined.select("capture_id", "response", F.col("request").alias("requests"), "metadata")


def captures(pages: DataFrame, with_payload: bool = True) -> DataFrame:
    """Archive ``pages`` in the shared folder, read the archives back and assemble their captures."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder)
    return assemble(stage(read_records(spark, folder, with_payload), "records"))


def op3_warc(spark, sf_dir: str) -> DataFrame:
    nested = captures(spark.read.parquet(f"{sf_dir}/pages.parquet"), with_payload=False)
    described = F.element_at("metadata", 1)
    return nested.select(
        F.col("response.page_id").alias("page_id"), F.coalesce("response.payload_bytes", described["payload_bytes"]).alias("payload_bytes"),
        F.coalesce("response.payload_digest", described["payload_digest"]).alias("payload_digest"),
        F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("refers_to"))
