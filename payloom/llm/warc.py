"""Dictionary-compressed WARC files: written by tasks, read back record by record.

A file begins with a skippable frame that holds a Zstandard dictionary built
from the records of that file; every record is a frame of its own, compressed
with it. A file needs nothing outside itself, and a record can be read at its
offset once the first frame is known.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payloom.llm.common import batches_of, one_file_a_task, open_input, open_output, shared_folder, task_file, written

# Fixed value: magic number of the skippable frame that holds a dictionary.
DICTIONARY_FRAME = 0x184D2A5D
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 32 << 10
FILE_BYTES = 64 << 20
SALTS = 16
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("bytes", pa.int64()), ("dictionary_bytes", pa.int64())])
ROWS = pa.schema([("record_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                  ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("path", pa.string()), ("at", pa.int64())])
ROWS_DDL = ("record_id long, record_type string, url string, payload_bytes long, payload_digest string, refers_to long, "
            "payload binary, path string, at long")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A response, or a revisit without payload whose headers tell the payload's digest and length."""
    response = refers_to is None
    block = HTTP % len(payload) + (payload if response else b"")
    headers = ["WARC/1.1", f"WARC-Type: {'response' if response else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
               f"WARC-Date: {date}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
               f"WARC-Payload-Digest: sha1:{digest_of(payload)}", f"X-Payload-Length: {len(payload)}"]
    if url is not None:
        headers.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if not response:
        headers += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> bytes:
    """A trained dictionary; the records' own first bytes where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[:DICTIONARY_BYTES]


class WarcWriter:
    """One file. Its first SAMPLE_BYTES of records are held back until the dictionary is built from them."""

    def __init__(self, uri: str):
        self.uri, self.held, self.held_bytes, self.out = uri, [], 0, None
        self.n = self.bytes = self.dictionary_bytes = 0

    def add(self, data: bytes) -> None:
        self.n += 1
        if self.out is not None:
            return self._put(data)
        self.held.append(data)
        self.held_bytes += len(data)
        if self.held_bytes >= SAMPLE_BYTES:
            self._start()

    def _start(self) -> None:
        raw = build_dictionary(self.held)
        self.dictionary_bytes = len(raw)
        self.packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(raw), write_checksum=True)
        self.out = open_output(self.uri)
        frame = zstandard.ZstdCompressor(level=19).compress(raw)
        self._write(struct.pack("<II", DICTIONARY_FRAME, len(frame)) + frame)
        for data in self.held:
            self._put(data)
        self.held = []

    def _put(self, data: bytes) -> None:
        self._write(self.packer.compress(data))

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def close(self) -> tuple[str, int, int, int]:
        if self.out is None:
            self._start()
        self.out.close()
        return self.uri, self.n, self.bytes, self.dictionary_bytes


def read_records(uri: str, chunk: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of a file, with one record and one chunk in memory."""
    with open_input(uri) as source:
        magic, size = struct.unpack("<II", source.read(8))
        if magic != DICTIONARY_FRAME:
            raise ValueError(f"{uri} does not begin with a dictionary")
        frame = source.read(size)
        raw = zstandard.ZstdDecompressor().decompress(frame)
        unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
        start = at = 8 + size
        waiting, parts, one = b"", [], unpacker.decompressobj()
        while True:
            data = waiting or source.read(chunk)
            if not data:
                break
            at += 0 if waiting else len(data)
            parts.append(one.decompress(data))
            waiting = b""
            if one.eof:
                waiting = one.unused_data
                yield start, b"".join(parts)
                start = at - len(waiting)
                parts, one = [], unpacker.decompressobj()
        if any(parts):
            raise ValueError(f"{uri} ends within a record")


def parse(data: bytes) -> tuple:
    """Fields of a record; the payload's digest is computed again and compared."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda name: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))) else None
    response = fields["WARC-Type"] == "response"
    if response and digest_of(payload) != digest:
        raise ValueError(f"record {fields['WARC-Record-ID']} does not match its digest")
    return (number("WARC-Record-ID"), fields["WARC-Type"], fields.get("WARC-Target-URI"), int(fields["X-Payload-Length"]), digest,
            number("WARC-Refers-To"), payload if response else None)


def revisits(pages: DataFrame, *, page_id: str, payload: str, least_bytes: int = 0) -> DataFrame:
    """(page_id, refers_to) of pages whose payload another page's response holds: of equal payloads, that with the largest id.

    Only ids and digests are shuffled. Digests that occur once leave before
    the join; those that occur often are dealt over SALTS parts, so a payload
    that a third of all pages share isn't one task.
    """
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("body"))
    keys = rows.filter((F.octet_length("body") >= least_bytes) & F.col("page_id").isNotNull()).select("page_id", F.unhex(F.sha1("body")).alias("digest"))
    shared = keys.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).filter("refers_to > least")
    salted = shared.select("digest", "refers_to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = keys.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, ["digest", "salt"]).filter("page_id < refers_to").select("page_id", "refers_to").distinct()


def write_warc(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0,
               date: str = "1970-01-01T00:00:00Z", folder: str | None = None) -> DataFrame:
    """Write a record per page; returns the list of files: (path, n_records, bytes, dictionary_bytes).

    Payloads are the column's text in UTF-8; null is empty. Of records with
    equal payloads of `least_bytes` or more, the one with the largest id is a
    response and the others revisit it. Payloads are shuffled once, by id.
    Only files in the returned list count; a repeated task writes new ones.

    Rows without id are responses of their own. Rows with equal id and payload
    are the same page: they are all responses, or all revisits. An empty
    table writes no file. White space and control characters of a url are
    percent-encoded, a null url has no header. Other columns are not read.
    """
    folder = folder or shared_folder(pages.sparkSession, "warc")
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                        F.col(f"`{payload}`").cast("binary").alias("body"))
    joined = rows.join(revisits(pages, page_id=page_id, payload=payload, least_bytes=least_bytes), "page_id", "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, listed = None, []
        for batch in batches:
            for page, link, body, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writer is None:
                    writer = WarcWriter(task_file(folder, len(listed), ".warc.zst"))
                writer.add(record(page, link, body or b"", refers_to, date))
                if writer.bytes >= FILE_BYTES:
                    listed.append(writer.close())
                    writer = None
        if writer is not None:
            listed.append(writer.close())
        yield from batches_of(listed, MANIFEST)

    listed = joined.select("page_id", "url", "body", "refers_to").mapInArrow(write, "path string, n_records long, bytes long, dictionary_bytes long")
    return written(listed, "warc-files")


def read_warc(files: DataFrame, *, payloads: bool = True) -> DataFrame:
    """Records of the listed files: (record_id, record_type, url, payload_bytes, payload_digest, refers_to, payload, path, at).

    Digests of responses are verified against their payloads. Revisits have no
    payload; length and digest are those of the payload they refer to.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                found = ((parse(data), at) for at, data in read_records(path))
                yield from batches_of(((*(f if payloads else f[:-1] + (None,)), path, at) for f, at in found), ROWS)

    return one_file_a_task(files.select("path")).mapInArrow(read, ROWS_DDL)
