"""Operator 4: WARC archives whose repeated payloads become revisit records.

Records are written by Spark's text writer: a record is its headers, a blank
line and the payload, and the writer's line separator is the two line breaks
that end a WARC record. Files are gzipped and committed by Spark, so a lost
executor leaves neither half a record nor a second copy. They are read back as
whole files (a file holds what one task wrote, at most FILE_RECORDS records),
inflated as a stream, and cut by Content-Length.

To resolve revisits only the headers are shuffled: per payload digest and length
the largest page_id is found with a partial maximum, so a payload that a third
of all records share is no hot group. The decisions are then joined to the
records, and fresh archives are written: the response with its payload, revisits
with headers alone. Reading those archives back, revisit records are joined to
their original responses by the id they refer to.

Defined cases: null HTML is an empty payload; a null URL leaves out the target
header; a null page_id leaves out its header, and such a record is always a
response, since nothing could refer to it; rows that repeat a page_id with the
same payload, that page_id being the largest, are all responses; an empty table
gives empty archives and an empty result; only page_id, url and html are read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recoflow.llm.common import materialize, scratch_dir

MIN_REVISIT_BYTES = 1000
FILE_RECORDS = 20_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing if the value is null; line breaks are escaped."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def _record_id(page_id: Column) -> Column:
    m = F.md5(F.concat(F.lit("page:"), page_id.cast("string")).cast("binary"))
    parts = [m.substr(1, 8), m.substr(9, 4), m.substr(13, 4), m.substr(17, 4), m.substr(21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_archives(records: DataFrame, path: str) -> None:
    """Write records (page_id, url, payload, payload_bytes, payload_digest,
    record_type, refers_to); the payload of a revisit is not written."""
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    text = F.concat(
        F.lit("WARC/1.1\r\n"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type"), F.lit("\r\n")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        F.lit(f"WARC-Date: {DATE}\r\n"),
        _line("WARC-Target-URI", F.col("url")),
        F.lit("Content-Type: text/html\r\n"),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Refers-To", _record_id(F.col("refers_to"))),
        _line("X-Page-ID", F.col("page_id").cast("string")),
        _line("X-Refers-To-Page", F.col("refers_to").cast("string")),
        _line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        _line("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"), body)
    (records.select(text.alias("value")).write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))


READ_SCHEMA = ("page_id bigint, url string, record_type string, payload_digest string, payload_bytes bigint, "
               "refers_to bigint, body string")


def _records(chunks: Iterator[bytes]) -> Iterator[tuple[dict, bytes]]:
    """(headers, body) of each record of an archive's bytes."""
    held, at = bytearray(), 0
    chunks = iter(chunks)

    def need(n: int) -> bool:
        nonlocal held, at
        if at and len(held) - at < n:
            del held[:at]
            at = 0
        while len(held) - at < n:
            more = next(chunks, None)
            if more is None:
                return False
            held += more
        return True

    while need(len("WARC/1.1")):
        end, size = -1, 4096
        while end < 0:
            whole = need(size)
            end = held.find(b"\r\n\r\n", at)
            if end < 0 and not whole:
                raise ValueError("an archive ends within a record's headers")
            size *= 2
        lines = bytes(held[at:end]).decode("utf-8").split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        n = int(head["Content-Length"])
        at = end + 4
        if not need(n + 4):
            raise ValueError("an archive ends within a record's payload")
        yield head, bytes(held[at:at + n])
        at += n + 4


def _inflate(blob: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The inflated bytes of one or more gzip members, in pieces."""
    z, view = zlib.decompressobj(31), memoryview(blob)
    for i in range(0, len(blob), step):
        piece = view[i:i + step]
        while True:
            yield z.decompress(piece)
            if not z.eof or not z.unused_data:
                break
            piece, z = z.unused_data, zlib.decompressobj(31)


def read_archives(spark: SparkSession, path: str, with_body: bool = True) -> DataFrame:
    """Every record of the archives in ``path``; the body of a response is held
    against its digest, and a damaged one fails the job."""
    kind = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                      ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                      ("refers_to", pa.int64()), ("body", pa.string())])

    def parse(batches):
        number = lambda x: None if x is None else int(x)
        for batch in batches:
            for blob in batch.column("content"):
                rows, held = [], 0
                for head, body in _records(_inflate(blob.as_py())):
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if head["WARC-Type"] == "response" and hashlib.sha1(body).hexdigest() != digest:
                        raise ValueError(f"payload of page {head.get('X-Page-ID')} is damaged")
                    rows.append((number(head.get("X-Page-ID")), head.get("WARC-Target-URI"), head["WARC-Type"], digest,
                                 int(head["X-Payload-Length"]), number(head.get("X-Refers-To-Page")),
                                 body.decode("utf-8") if with_body else None))
                    held += len(body) if with_body else 200
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kind.types)], schema=kind)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kind.types)], schema=kind)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(parse, READ_SCHEMA)


def page_records(pages: DataFrame) -> DataFrame:
    """A response record per page."""
    payload = F.coalesce("html", F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload.cast("binary")).alias("payload_digest"),
        F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))


def resolve(headers: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, payload_digest, payload_bytes, original): for payloads of at least ``min_bytes``
    that several page ids share, the page id of the response."""
    key = ["payload_digest", "payload_bytes"]
    return (headers.where(F.col("page_id").isNotNull() & (F.col("payload_bytes") >= min_bytes))
            .groupBy(*key).agg(F.max("page_id").alias("original"), F.min("page_id").alias("least"))
            .where("least < original").drop("least"))


def deduplicate_archives(spark: SparkSession, source: str, target: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Read the archives in ``source`` and write them to ``target`` with fresh
    headers, repeated payloads as revisit records. Revisits already there stay."""
    winners = materialize(resolve(read_archives(spark, source, with_body=False)
                                  .where("record_type = 'response'"), min_bytes), "originals")
    held = read_archives(spark, source).withColumnRenamed("body", "payload")
    joined = held.join(winners, ["payload_digest", "payload_bytes"], "left")
    again = (F.col("record_type") == "response") & (F.col("page_id") < F.col("original"))
    write_archives(joined.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(again, F.lit("revisit")).otherwise(F.col("record_type")).alias("record_type"),
        F.when(again, F.col("original")).otherwise(F.col("refers_to")).alias("refers_to")), target)


def resolved_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of deduplicated archives, each revisit joined to the response it refers to, whose
    length and digest it takes; a revisit whose response is missing keeps those of its header."""
    held = materialize(read_archives(spark, path, with_body=False).drop("body"), "headers")
    responses = (held.where("record_type = 'response' and page_id is not null")
                 .groupBy(F.col("page_id").alias("refers_to"), "payload_digest")
                 .agg(F.max("payload_bytes").alias("original_bytes")))
    return held.join(responses, ["refers_to", "payload_digest"], "left").select(
        "page_id", "url", F.coalesce("original_bytes", "payload_bytes").alias("payload_bytes"), "payload_digest",
        "record_type", "refers_to", ((F.col("record_type") == "response") | F.col("original_bytes").isNotNull()).alias("resolved"))


def archive_pages(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write a page table as archives, deduplicate those, and read the result back."""
    spark = pages.sparkSession
    raw, fresh = scratch_dir(spark, "warc-raw"), scratch_dir(spark, "warc-dedup")
    write_archives(page_records(pages), raw)
    deduplicate_archives(spark, raw, fresh, min_bytes)
    return resolved_records(spark, fresh)
