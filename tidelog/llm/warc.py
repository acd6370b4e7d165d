"""WARC archives written and read as chunked record tables.

*Writing.*  A record becomes rows (record identifier, chunk number, bytes): a payload longer than ``CHUNK`` is streamed as a
first record and continuation segments, as the format has them, each row with the SHA-1 digest of the payload so far.
Rows go to gzipped files through Spark's text writer, whose line separator is the blank line that ends a WARC record; so
any store that Spark reaches will do, and no record is ever held whole by the writer's file.
*Duplicates.*  Of equal payloads of at least ``revisit_from`` bytes the one of the largest page_id is written in full, the others
as revisit records that refer to it.
*Reading.*  Files are split at blank lines, not at records; a parser follows the records by their lengths, in the order
of the file, and updates the digest chunk by chunk.  A digest or length that differs from the header's is an error.

Null payloads are empty, null URLs are left out.  A null page_id is below all others and is written as such.  Rows with equal
payload and the same, largest page_id are all responses.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import work_dir

CHUNK = 1 << 20
BLANK = "\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"
_ID = "urn:page:"
_CHUNKS = "record_id string, chunk int, digest_so_far binary, bytes binary"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _header(kind: str, record: str, length: int, more: dict[str, str | None]) -> bytes:
    lines = {"WARC-Type": kind, "WARC-Record-ID": f"<{record}>", "WARC-Date": "1970-01-01T00:00:00Z", **more, "Content-Length": str(length)}
    return "\r\n".join(["WARC/1.1", *(f"{k}: {v}" for k, v in lines.items() if v is not None)]).encode()


def _records(chunk: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids, urls, payloads, refers = (batch.column(c) for c in ("page_id", "url", "payload", "refers_to"))
            for row in range(batch.num_rows):
                page, url, refer = ids[row].as_py(), urls[row].as_py(), refers[row].as_py()
                payload = memoryview(payloads[row].as_buffer())
                record = f"{_ID}{'' if page is None else page}"
                digest = hashlib.sha1()
                out = []
                about = {"WARC-Target-URI": None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%~"), "X-Payload-Length": str(len(payload))}
                if refer is not None:
                    digest.update(payload)
                    about |= {"WARC-Payload-Digest": f"sha1:{base32(digest.digest())}", "WARC-Refers-To": f"<{_ID}{refer}>"}
                    out.append((record, 0, digest.digest(), _header("revisit", record, 0, about) + BLANK.encode()))
                else:
                    whole = hashlib.sha1(payload)
                    about["WARC-Payload-Digest"] = f"sha1:{base32(whole.digest())}"
                    n = max(1, -(-len(payload) // chunk))
                    for i in range(n):
                        part = payload[i * chunk:(i + 1) * chunk]
                        digest.update(part)
                        head = HTTP + BLANK.encode() if i == 0 else b""
                        segment = {"WARC-Segment-Number": str(i + 1)} if n > 1 else {}
                        if i and i == n - 1:
                            segment["WARC-Segment-Total-Length"] = str(len(payload) + len(HTTP) + len(BLANK))
                        if i == 0:
                            segment |= about | {"Content-Type": "application/http; msgtype=response"}
                        else:
                            segment["WARC-Segment-Origin-ID"] = f"<{record}>"
                        header = _header("response" if i == 0 else "continuation", record if i == 0 else f"{record}:{i + 1}", len(head) + len(part), segment)
                        out.append((record, i, digest.digest(), header + BLANK.encode() + head + bytes(part)))
                        if len(out) > 16:
                            yield _rows(out)
                            out = []
                if out:
                    yield _rows(out)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["record_id", "chunk", "digest_so_far", "bytes"])


def record_chunks(pages: DataFrame, revisit_from: int = 0, chunk: int = CHUNK) -> DataFrame:
    """(record_id, chunk, digest_so_far, bytes) of a record for each row of (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1(F.col("payload").cast("binary"))))
    first = rows.filter(F.octet_length("payload") >= revisit_from).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    rows = rows.join(first.filter("n > 1"), "digest", "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.select("page_id", "url", F.col("payload").cast("binary").alias("payload"), refers.alias("refers_to")).mapInArrow(_records(chunk), _CHUNKS)


def write_archives(pages: DataFrame, path: str, revisit_from: int = 0, chunk: int = CHUNK) -> None:
    """Gzipped WARC files below ``path``, one a task."""
    chunks = record_chunks(pages, revisit_from, chunk)
    # the separator is the blank line behind each record
    chunks.select(F.col("bytes").cast("string").alias("value")).write.option("lineSep", BLANK).option("compression", "gzip").text(path)


class _Parser:
    """Takes a file's bytes piece by piece; ``done`` collects what is known of its records, not their payloads."""

    def __init__(self) -> None:
        self.done: list[dict] = []
        self.header, self.left, self.http = bytearray(), 0, None
        self.record: dict | None = None  # the last one, whose segments may follow

    def close(self) -> None:
        """Checks the last record against its header."""
        if (record := self.record) is not None:
            sha1, seen = record.pop("sha1"), record.pop("seen")
            if record["record_type"] == "response" and (base32(sha1.digest()), seen) != (record["payload_digest"], record["payload_bytes"]):
                raise ValueError(f"record {record['page_id']}: payload differs from its header")
            self.done.append(record)
        self.record = None

    def feed(self, data: bytes) -> None:
        while data:
            if self.left:
                part, data = data[:self.left], data[self.left:]
                self.left -= len(part)
                if self.http is not None:  # the payload begins behind the first blank line
                    self.http += part
                    if (end := self.http.find(BLANK.encode())) < 0:
                        continue
                    part, self.http = bytes(self.http[end + len(BLANK):]), None
                self.record["sha1"].update(part)
                self.record["seen"] += len(part)
                continue
            if not self.header:
                data = data.lstrip(b"\r\n")  # what ends the record before
            self.header += data
            if (end := self.header.find(BLANK.encode())) < 0:
                return
            header, data, self.header = bytes(self.header[:end]), bytes(self.header[end + len(BLANK):]), bytearray()
            self.begin(dict(x.split(": ", 1) for x in header.decode().split("\r\n")[1:]))

    def begin(self, fields: dict[str, str]) -> None:
        self.left = int(fields["Content-Length"])
        self.http = bytearray() if fields.get("Content-Type", "").startswith("application/http") else None
        if fields["WARC-Type"] == "continuation":
            return
        self.close()
        page, refer = (fields.get(k, "").removeprefix(f"<{_ID}").removesuffix(">") for k in ("WARC-Record-ID", "WARC-Refers-To"))
        url = fields.get("WARC-Target-URI")
        self.record = {
            "page_id": int(page) if page else None, "url": None if url is None else unquote(url), "payload_bytes": int(fields["X-Payload-Length"]),
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "record_type": fields["WARC-Type"],
            "refers_to": int(refer) if refer else None, "sha1": hashlib.sha1(), "seen": 0}


def _parse(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows are what stands between blank lines, wherever these are; with the blank lines they are the file again."""
    parser = _Parser()
    for batch in it:
        for value in batch.column("value"):
            parser.feed(value.as_py() + BLANK.encode())
        if len(parser.done) >= 1000:
            yield _found(parser.done)
            parser.done = []
    parser.close()
    yield _found(parser.done)


_FOUND = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def _found(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _FOUND)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of each record, with the payloads checked."""
    lines = spark.read.option("lineSep", BLANK).text(path)
    # gzipped files are not split, so a task reads whole files from their beginning
    return lines.select(F.col("value").cast("binary").alias("value")).mapInArrow(
        _parse, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_round_trip(pages: DataFrame, revisit_from: int = 0, chunk: int = CHUNK) -> DataFrame:
    """Archives of ``pages`` in the shared folder, read back."""
    path = work_dir(pages.sparkSession, "warc")
    write_archives(pages, path, revisit_from, chunk)
    return read_archives(pages.sparkSession, path)
