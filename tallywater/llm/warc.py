"""WARC archives: pages written as request, response and metadata records, and captures put together.

Writing is a DataFrame expression per page and Spark's text writer: records are separated by
``CRLF CRLF``, which is the writer's line separator, so every file is a WARC file whatever the file
system, and a lost task is written again whole. Files hold a bounded number of records.

Reading takes the files as they are, parses records by their Content-Length in Python (a file at a
time, its memory bounded by the file), and assembles transactions by joins: request and metadata
records name the response (or revisit) that they are concurrent to; a revisit names the response it
refers to. One nested row per capture comes out.

Defined results: null html is an empty payload; null url is an empty target. Of equal payloads of at
least ``least`` bytes the smallest page_id is the response and the others revisit it; rows that
repeat that page_id are responses too, and smaller payloads always are. Texts of any length and
content survive, also those that contain record headers. An empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallywater.llm.shared import ship
from tallywater.session import fresh_folder

ship(__name__)

CRLF = "\r\n"
#: Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 30_000


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: five hex digits at a time are four of base 32."""
    digest = F.sha1(payload.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32_DIGITS)


def record_id(kind: str, page_id: Column) -> Column:
    """A name-based identifier: the same page gets the same one whenever it is written."""
    h = F.md5(F.concat(F.lit(f"{kind}:"), F.coalesce(page_id.cast("string"), F.lit("null"))))
    parts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(headers: list[tuple[str, Column | str]], block: Column) -> Column:
    """Headers that are null are left out."""
    lines = [F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value) for name, value in headers]
    head = F.concat_ws(CRLF, F.lit(VERSION), *lines, F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(head, F.lit(CRLF * 2), block)


def with_originals(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, payload, digest, and ``original``: the page a revisit refers to, else null."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        "page_id", F.coalesce(F.regexp_replace(F.col("url").cast("string"), r"[\r\n]", " "), F.lit("")).alias("url"),
        html.alias("payload"), base32_sha1(html).alias("digest"),
    )
    firsts = (
        rows.where(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("digest", "first")
    )
    original = F.when(F.col("page_id") != F.col("first"), F.col("first"))
    # Digests of payloads below ``least`` are not among the first ones: length is part of a payload.
    return rows.join(firsts, "digest", "left").withColumn("original", original).drop("first")


def write_archive(pages: DataFrame, path: str, *, least: int = 0, per_file: int = RECORDS_PER_FILE) -> None:
    """Write a request, a response or revisit, and a metadata record for every page."""
    rows = with_originals(pages, least)
    revisit = F.col("original").isNotNull()
    main = F.when(revisit, record_id("revisit", F.col("page_id"))).otherwise(record_id("response", F.col("page_id")))
    target = F.col("url")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length("payload").cast("string"), F.lit(CRLF * 2),
    )
    host = F.regexp_extract(target, r"://([^/?#]*)", 1)
    request = _record(
        [("WARC-Type", "request"), ("WARC-Record-ID", record_id("request", F.col("page_id"))), ("WARC-Date", DATE),
         ("WARC-Target-URI", target), ("WARC-Concurrent-To", main), ("Content-Type", "application/http;msgtype=request")],
        F.concat(F.lit("GET "), target, F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(CRLF * 2)),
    )
    response = _record(
        [("WARC-Type", F.when(revisit, "revisit").otherwise("response")), ("WARC-Record-ID", main), ("WARC-Date", DATE),
         ("WARC-Target-URI", target), ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
         ("WARC-Profile", F.when(revisit, REVISIT_PROFILE)),
         ("WARC-Refers-To", F.when(revisit, record_id("response", F.col("original")))),
         ("Content-Type", "application/http;msgtype=response")],
        F.when(revisit, http).otherwise(F.concat(http, F.col("payload"))),
    )
    metadata = _record(
        [("WARC-Type", "metadata"), ("WARC-Record-ID", record_id("metadata", F.col("page_id"))), ("WARC-Date", DATE),
         ("WARC-Target-URI", target), ("WARC-Concurrent-To", main), ("Content-Type", "application/warc-fields")],
        F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF)),
    )
    (
        rows.select(F.explode(F.array(request, response, metadata)).alias("value"))
        .write.option("lineSep", CRLF * 2)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", per_file)
        .text(path)
    )


RECORD = (
    "type string, record_id string, target string, concurrent_to string, refers_to string, digest string, "
    "status int, payload_bytes long, payload_digest string, fields map<string,string>, payload binary"
)


def _inflated(content: bytes) -> bytes:
    """The bytes of a file of one or many gzip members, or of a plain one."""
    out = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out += [member.decompress(content), member.flush()]
        content = member.unused_data
    return b"".join([*out, content])


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in head.split(b"\r\n") if b":" in line)
    return {name.strip().lower().decode("utf-8", "replace"): value.strip().decode("utf-8", "replace") for name, _, value in pairs}


def parse_records(data: bytes, payloads: bool) -> Iterator[tuple]:
    """The records of a file in turn; a record that is cut off ends the file with an error."""
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            raise ValueError("a WARC record without the end of its headers")
        head = _fields(data[at:end])
        start = end + 4
        at = start + int(head["content-length"])
        if at > len(data):
            raise ValueError("a WARC record is shorter than its Content-Length")
        kind, block = head.get("warc-type", ""), data[start:at]
        status = size = digest = payload = None
        fields: dict[str, str] = {}
        if kind in ("response", "revisit"):
            top, _, body = block.partition(b"\r\n\r\n")
            line, _, rest = top.partition(b"\r\n")
            parts = line.split(b" ")
            status = int(parts[1]) if len(parts) > 1 and parts[1].isdigit() else None
            fields = _fields(rest)
            if kind == "response":
                size, digest = len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()
                payload = body if payloads else None
            else:
                size = int(fields.get("content-length", 0))
        elif kind == "metadata":
            fields = _fields(block)
        elif kind == "request":
            fields = _fields(block.partition(b"\r\n")[2])
        stated = head.get("warc-payload-digest", "").rpartition(":")[2] or None
        yield (
            kind, head.get("warc-record-id"), head.get("warc-target-uri"), head.get("warc-concurrent-to"), head.get("warc-refers-to"),
            stated, status, size, digest or stated, fields, payload,
        )


def read_records(spark: SparkSession, path: str, *, payloads: bool = True) -> DataFrame:
    """One row per record; without ``payloads`` only their sizes and digests leave the parser."""
    names = [c.split()[0] for c in RECORD.replace("map<string,string>", "map").split(", ")]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for row in parse_records(_inflated(content), payloads):
                    rows.append(row)
                    if len(rows) >= 2000:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInPandas(parse, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit, its requests and its metadata.

    A capture without a request or metadata record has an empty array there; a request whose response
    is missing belongs to no capture. ``refers_to`` is the metadata's page of the record referred to.
    """
    beside = (
        records.where(F.col("type").isin("request", "metadata") & F.col("concurrent_to").isNotNull())
        .select("concurrent_to", "type", F.struct("record_id", "target", "fields").alias("record"))
        .groupBy(F.col("concurrent_to").alias("record_id"))
        .agg(
            F.collect_list(F.when(F.col("type") == "request", F.col("record"))).alias("requests"),
            F.collect_list(F.when(F.col("type") == "metadata", F.col("record"))).alias("metadata"),
        )
    )
    empty = F.array().cast("array<struct<record_id:string,target:string,fields:map<string,string>>>")
    page = F.col("metadata")[0]["fields"]["page-id"].try_cast("long")
    captures = (
        records.where(F.col("type").isin("response", "revisit"))
        .select("record_id", F.struct("type", "target", "status", "digest", "payload_bytes", "payload_digest", "refers_to", "payload").alias("response"))
        .join(beside, "record_id", "left")
        .withColumns({"requests": F.coalesce("requests", empty), "metadata": F.coalesce("metadata", empty)})
    )
    captures = captures.withColumn("page_id", F.when(F.size("metadata") > 0, page))
    referred = captures.where(F.col("response.type") == "response").groupBy(F.col("record_id").alias("_to")).agg(F.first("page_id").alias("refers_to"))
    return captures.join(referred, F.col("response.refers_to") == F.col("_to"), "left").drop("_to")


def archived(pages: DataFrame, *, least: int = 0, payloads: bool = False) -> DataFrame:
    """Write ``pages`` to a new archive in the shared folder and read its captures back."""
    path = fresh_folder(pages.sparkSession, "warc")
    write_archive(pages, path, least=least)
    return assemble(read_records(pages.sparkSession, path, payloads=payloads))
