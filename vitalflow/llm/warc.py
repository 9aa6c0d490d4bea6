"""WARC archives of pages: a writer, and a sequential reader.

An archive is a series of gzip members, one record in each. The reader inflates member by
member from chunks of the file, takes the record's headers, frames its block by Content-Length
and checks block and payload digests while the bytes pass, so that memory does not grow with
a record unless its payload is asked for.

Of pages with equal payloads the one with the largest page_id is written as a response, the
others as revisit records that refer to it and carry no block. Rows that share that page_id and
payload are all responses; in a group without any page_id every row is. A payload shorter than
`min_revisit_bytes` is always a response.

Nulls: null html is an empty payload, a null url leaves out the target URI, a null page_id is
written and read as null. An empty table gives no archive. Other columns are not read.

Each task streams its rows into an archive of its own, with a name of its own for each attempt;
only archives of finished tasks are listed and read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import RowWriter

CHUNK = 1 << 16
#: A fixed capture date: tables hold none.
DATE = "2026-01-01T00:00:00Z"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, url string"
)
_ID = re.compile(r"<urn:page:(-?\d+|null)>")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member."""
    block = b"" if revisit else HTTP_HEAD % len(payload) + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", page_urn(page_id)),
        ("WARC-Date", DATE),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", page_urn(refers_to))]
    fields += [
        ("WARC-Payload-Digest", "sha1:" + base32_sha1(payload)),
        ("WARC-Block-Digest", "sha1:" + base32_sha1(block)),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(head.encode()) + squeeze.compress(block + b"\r\n\r\n") + squeeze.flush()


class WarcError(ValueError):
    """The archive is damaged: framing, length or digest do not hold."""


class WarcReader:
    """Iterates over (headers, payload or None) of a stream of gzip members."""

    def __init__(self, stream, payloads: bool = True):
        self.stream, self.payloads = stream, payloads
        self._raw = b""  # compressed bytes that are read and not yet inflated

    def __iter__(self):
        while self._raw or self._more():
            self._inflate, self._text = zlib.decompressobj(31), b""
            yield self._record()

    def _more(self) -> bool:
        self._raw = bytes(self.stream.read(CHUNK))
        return bool(self._raw)

    def _grow(self) -> bool:
        """Inflates some more of the member into _text; False at its end."""
        while not self._inflate.eof:
            if not self._raw and not self._inflate.unconsumed_tail and not self._more():
                raise WarcError("the archive ends inside a record")
            data = self._inflate.unconsumed_tail + self._raw
            out = self._inflate.decompress(data, CHUNK)
            self._raw = self._inflate.unused_data
            if out:
                self._text += out
                return True
        return False

    def _record(self):
        while (end := self._text.find(b"\r\n\r\n")) < 0:
            if not self._grow():
                raise WarcError("a record without an end of headers")
        lines = self._text[:end].decode().split("\r\n")
        self._text = self._text[end + 4 :]
        if not lines[0].startswith("WARC/"):
            raise WarcError("a record without a version")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        left = int(headers["Content-Length"])
        block, body = hashlib.sha1(), hashlib.sha1()
        response = headers["WARC-Type"] == "response"
        http_head, kept, length = (b"" if response else None), [], 0
        while left:
            if not self._text and not self._grow():
                raise WarcError("a block shorter than its length")
            part, self._text = self._text[:left], self._text[left:]
            left -= len(part)
            block.update(part)
            if http_head is not None:  # up to the blank line
                http_head += part
                cut = http_head.find(b"\r\n\r\n")
                if cut < 0:
                    continue
                part, http_head = http_head[cut + 4 :], None
            body.update(part)
            length += len(part)
            if self.payloads:
                kept.append(part)
        while self._grow():
            pass
        if self._text != b"\r\n\r\n":
            raise WarcError("a record that does not end after its block")
        if headers["WARC-Block-Digest"] != "sha1:" + base64.b32encode(block.digest()).decode():
            raise WarcError("a block that does not have its digest")
        if response and headers["WARC-Payload-Digest"] != "sha1:" + base64.b32encode(body.digest()).decode():
            raise WarcError("a payload that does not have its digest")
        if response and int(headers.setdefault("X-Payload-Length", str(length))) != length:
            raise WarcError("a payload that does not have its length")
        return headers, b"".join(kept) if self.payloads and response else None


def _write_archives(place: str):
    def run(batches):
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(place)
        system.create_dir(root, recursive=True)
        name, stream, n = f"{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            page_ids, urls, refers, revisits = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
            stream = stream or system.open_output_stream(f"{root}/{name}", compression=None)
            for page_id, url, html, refers_to, revisit in zip(page_ids, urls, batch.column(2), refers, revisits):
                stream.write(record(page_id, url, html.as_py() or b"", refers_to, revisit))
                n += 1
        if stream:
            stream.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{place}/{name}"]), pa.array([n])], ["url", "records"])

    return run


def write(pages: DataFrame, place: str, min_revisit_bytes: int = 0) -> list[str]:
    """Writes one record for each page; the URLs of the archives.

    The group of a payload is its SHA-1 and length. Groups are made of ids alone; the pages then
    meet them in a plain join, which adaptive execution can split at a hot payload.
    """
    html = F.coalesce(pages["html"].cast("binary"), F.lit(b""))
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"),
        pages["url"].alias("url"),
        html.alias("html"),
        F.sha1(html).alias("digest"),
        F.octet_length(html).alias("n"),
    )
    # joined on more columns than grouped by, so that both sides of the join get exchanges of
    # its own, as splitting needs
    best = rows.groupBy("digest").agg(F.max("page_id").alias("best"), F.max("n").alias("n"))
    joined = rows.join(best, ["digest", "n"], "left")
    revisit = (
        (F.col("n") >= min_revisit_bytes) & F.col("best").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("best"))
    )
    marked = joined.select(
        "page_id", "url", "html", F.when(revisit, F.col("best")).alias("refers_to"), revisit.alias("revisit")
    )
    listed = marked.mapInArrow(_write_archives(place), "url string, records long").collect()
    return sorted(r[0] for r in listed)


def read(spark: SparkSession, archives: list[str]) -> DataFrame:
    """One row per record, taken from its headers and checked against its bytes."""
    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([pa.field(n, kinds[k]) for n, k in (c.split() for c in RECORDS.split(", "))])

    def number(urn: str | None) -> int | None:
        found = _ID.fullmatch(urn or "")
        return int(found[1]) if found and found[1] != "null" else None

    def run(batches):
        from pyarrow import fs

        out = RowWriter(schema)
        for batch in batches:
            for url in batch.column(0).to_pylist():
                system, path = fs.FileSystem.from_uri(url)
                with system.open_input_stream(path, compression=None) as stream:
                    for headers, _ in WarcReader(stream, payloads=False):
                        out.add(
                            number(headers["WARC-Record-ID"]),
                            int(headers["X-Payload-Length"]),
                            headers["WARC-Payload-Digest"].removeprefix("sha1:"),
                            headers["WARC-Type"],
                            number(headers.get("WARC-Refers-To")),
                            headers.get("WARC-Target-URI"),
                        )
                        if out.full():
                            yield out.take()
        yield out.take()

    listed = spark.createDataFrame([(a,) for a in archives], "url string")
    return listed.repartition(max(1, len(archives))).mapInArrow(run, RECORDS)


_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(list_sum(list_transform(range(5), lambda k: CAST(substr(bits, CAST(5 * i + k + 1 AS INT), 1) AS INT) * (16 >> k))) AS INT), 1)"
#: Base32 of the digest from its bits.
ORACLE = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (SELECT hex, max(page_id) AS best FROM p GROUP BY hex),
j AS (SELECT p.*, best, CAST(CAST(unhex(hex) AS BIT) AS VARCHAR) AS bits FROM p JOIN b USING (hex))
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: {_DIGIT}), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = best THEN NULL ELSE best END AS refers_to
FROM j
"""
