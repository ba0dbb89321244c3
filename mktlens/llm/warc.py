"""WARC derivatives: linked metadata and plain-text conversion records.

Method: derivative builder.  Each ``response`` record gives one ``metadata``
and one ``conversion`` record.  Both refer to the response by its record id
(WARC-Refers-To), name the same target and date, and carry the response's
payload digest; the metadata record keeps the response's own HTTP headers as
``http-header-...`` fields and names the conversion, so the three stay linked.
Record ids are derived from the response's id, so reruns agree.

A record is one row and is built alone: no shuffle, and memory is one batch.
``as_members`` gives each record as a gzip member; members written one after
another are a WARC file, and ``read_warc`` reads such files through Spark's
binaryFile source, one record at a time.

Defined cases: a NULL html is an empty payload; a NULL url gives an empty
target; a payload that is not a response's HTTP message counts as body with no
headers; repeated rows give repeated records; an empty table gives none; extra
columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from mktlens.llm.html_extract import plain_text

RECORD = ("record_id string, type string, refers_to string, target_uri string, date string, content_type string, "
          "block_digest string, payload_digest string, block binary")
FIELDS = [c.split()[0] for c in RECORD.split(", ")]
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, name)}>"


def split_http(block: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """(headers, payload) of an HTTP response message."""
    if not block.startswith(b"HTTP/"):
        return [], block
    head, _, body = block.partition(b"\r\n\r\n")
    lines = [x.partition(":") for x in head.decode("latin-1").split("\r\n")[1:]]
    return [(k.strip(), v.strip()) for k, _, v in lines if k.strip()], body


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """``response`` records of the pages (page_id, url, html)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for page_id, url, page in zip(b["page_id"], b["url"], b["html"], strict=True):
                body, url = (page or "").encode(), url or ""
                block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body
                rows.append((_id(f"response {page_id} {url}"), "response", None, url, date, "application/http; msgtype=response",
                             digest(block), digest(body), block))
            yield pd.DataFrame(rows, columns=FIELDS)

    return pages.select("page_id", "url", "html").mapInPandas(run, RECORD)


def derive(records: DataFrame) -> DataFrame:
    """The metadata and conversion records of the response records."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b[b["type"] == "response"].itertuples(index=False):
                headers, body = split_http(bytes(r.block or b""))
                payload_digest = r.payload_digest or digest(body)
                text = plain_text(body.decode("utf-8", "replace")).encode()
                conversion, metadata = _id(f"conversion {r.record_id}"), _id(f"metadata {r.record_id}")
                fields = [("conversion", conversion), ("payload-length", str(len(body))), ("text-length", str(len(text))),
                          ("payload-digest", payload_digest), *((f"http-header-{k.lower()}", v) for k, v in headers)]
                block = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
                rows.append((metadata, "metadata", r.record_id, r.target_uri, r.date, "application/warc-fields", digest(block), payload_digest, block))
                rows.append((conversion, "conversion", r.record_id, r.target_uri, r.date, "text/plain; charset=utf-8", digest(text), payload_digest, text))
            yield pd.DataFrame(rows, columns=FIELDS)

    return records.mapInPandas(run, RECORD)


def serialise(r) -> bytes:
    """One record in WARC/1.1 form."""
    source = "WARC-Payload-Digest" if r.type == "response" else "WARC-Source-Payload-Digest"
    head = [("WARC-Type", r.type), ("WARC-Record-ID", r.record_id), ("WARC-Refers-To", r.refers_to), ("WARC-Target-URI", r.target_uri),
            ("WARC-Date", r.date), ("Content-Type", r.content_type), ("WARC-Block-Digest", r.block_digest), (source, r.payload_digest),
            ("Content-Length", str(len(r.block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head if v) + "\r\n").encode() + bytes(r.block) + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple]:
    """The records of a WARC file's bytes, gzip members or not."""
    while data:
        if data[:2] == b"\x1f\x8b":
            d = zlib.decompressobj(31)
            record, data = d.decompress(data), d.unused_data
        else:
            record, data = data, b""
        while record.startswith(b"WARC/"):
            head, _, rest = record.partition(b"\r\n\r\n")
            h = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
            n = int(h.get("content-length", 0))
            yield (h.get("warc-record-id"), h.get("warc-type"), h.get("warc-refers-to"), h.get("warc-target-uri", ""), h.get("warc-date"),
                   h.get("content-type"), h.get("warc-block-digest"), h.get("warc-payload-digest") or h.get("warc-source-payload-digest"), rest[:n])
            record = rest[n:].lstrip(b"\r\n")


def as_members(records: DataFrame) -> DataFrame:
    """(record_id, member): each record as a gzip member."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"record_id": b["record_id"], "member": [gzip.compress(serialise(r), 6, mtime=0) for r in b.itertuples(index=False)]})

    return records.mapInPandas(run, "record_id string, member binary")


def records_of(members: DataFrame, column: str = "member") -> DataFrame:
    """Records of a binary column that holds WARC bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for data in b[column]:
                rows: list[tuple] = []
                for r in parse_records(bytes(data)):
                    rows.append(r)
                    if len(rows) == 1000:
                        yield pd.DataFrame(rows, columns=FIELDS)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=FIELDS)

    return members.select(column).mapInPandas(run, RECORD)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    return records_of(spark.read.format("binaryFile").load(path), "content")


def op10_warc_derivatives(pages: DataFrame) -> DataFrame:
    """All derived records of the pages; the block as text."""
    d = derive(responses(pages))
    return d.withColumn("content", d["block"].cast("string")).drop("block")
