"""WARC archives compressed with a Zstandard dictionary.

``write_archives`` writes records one Zstandard frame each, after a skippable frame (magic ``0x184D2A5D``) that
holds the dictionary of the file, so that any record can be read from its offset and the file by itself. The dictionary is trained
on records of the file: the first ones up to ``SAMPLE_BYTES`` of a task, whose rows arrive in the order of their payloads' SHA-1,
that is, as a random sample of them; the task holds no more than that sample. A file with too little to train
on has no dictionary frame. A task starts another file after ``FILE_BYTES``.

Of records with equal payloads (by SHA-1 and length) of at least ``min_bytes`` bytes, the one with the largest
page_id is a response; the others revisit it: their records have the HTTP headers (with the payload's
length), its digest and a reference, but no payload. ``read_archives`` streams files and checks each response's digest.

Defined cases: a null payload is empty; a null url is ``urn:unknown``, and white space and control characters in urls are
percent-encoded; a null page_id is smaller than any other; rows that share the largest page_id and the
payload are all responses; an empty table writes no file; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm.files import opened, written
from tripspark.llm.storage import fresh_path, materialize

DICTIONARY_MAGIC = 0x184D2A5D  # of the skippable frame
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20
SAMPLE_RECORD_BYTES = 64 << 10  # of a record, for training
FILE_BYTES = 1 << 30
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(record: str) -> int | None:
    number = record[len("<urn:page:") : -1]
    return None if number == "none" else int(number)


def base32_digest(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def make_record(page_id: int | None, url: str | None, payload: bytes, sha1: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    safe = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else "urn:unknown"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Target-URI: {safe}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base32_digest(sha1)}",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {REVISIT}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def train(samples: list[bytes]):
    """A dictionary, or None if there is too little to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [s[:SAMPLE_RECORD_BYTES] for s in samples], k=512, d=8)
    except zstandard.ZstdError:
        return None


class ArchiveWriter:
    """One file: the dictionary frame, then a frame for each record."""

    def __init__(self, out, samples: list[bytes]) -> None:
        import zstandard

        dictionary = train(samples)
        self.out, self.size, self.records = out, 0, 0
        if dictionary is not None:
            data = dictionary.as_bytes()
            self._put(struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, record: bytes) -> None:
        self._put(self.compressor.compress(record))
        self.records += 1


MANIFEST = "path string, records long, bytes long"


def _archiver(folder: str, date: str):
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, sha1, refers_to, revisit = (batch.column(c)[i].as_py() for c in ("page_id", "url", "sha1", "refers_to", "revisit"))
                payload = batch.column("payload")[i].as_py()
                yield make_record(page_id, url, payload, bytes.fromhex(sha1), refers_to, revisit, date)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, part, n = records(batches), TaskContext.get().partitionId(), 0
        while True:
            first, held = [], 0
            for record in left:
                first.append(record)
                held += len(record)
                if held >= SAMPLE_BYTES:
                    break
            if not first:
                return
            path = f"{folder}/pages-{part:06d}-{n:04d}.warc.zst"
            with written(path) as out:
                archive = ArchiveWriter(out, first)
                for record in first:
                    archive.add(record)
                first = []
                while archive.size < FILE_BYTES and (record := next(left, None)) is not None:
                    archive.add(record)
            yield pa.record_batch([pa.array([path]), pa.array([archive.records]), pa.array([archive.size])], ["path", "records", "bytes"])
            n += 1

    return write


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = DATE) -> DataFrame:
    """Write ``(page_id, url, html)``; the manifest ``(path, records, bytes)`` of the files."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    keyed = pages.select("page_id", "url", payload.alias("payload")).withColumns({"sha1": F.sha1("payload"), "n": F.octet_length("payload")})
    newest = keyed.groupBy("sha1", "n").agg(F.max("page_id").alias("newest"))
    later = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    revisit = (F.col("n") >= min_bytes) & later
    ruled = keyed.join(newest, ["sha1", "n"]).withColumn("revisit", revisit).withColumn("refers_to", F.when(F.col("revisit"), F.col("newest")))
    rows = ruled.select("page_id", "url", "payload", "sha1", "refers_to", "revisit")
    return materialize(rows.mapInArrow(_archiver(folder, date), MANIFEST), "warc-manifest")


def _headers(stream: io.BufferedReader) -> dict[str, str]:
    out = {}
    while line := stream.readline().rstrip(b"\r\n"):
        name, _, value = line.decode("utf-8").partition(": ")
        out[name] = value
    return out


def iter_records(file) -> Iterator[dict]:
    """The records of an open archive: ``page_id, payload_bytes, payload_digest, record_type, refers_to, payload``."""
    import zstandard

    head, dictionary = file.read(8), None
    magic, size = struct.unpack("<II", head) if len(head) == 8 else (0, 0)
    if magic == DICTIONARY_MAGIC:
        dictionary = zstandard.ZstdCompressionDict(file.read(size))
    else:
        file.seek(0)
    reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(file, read_across_frames=True, closefd=False)
    stream = io.BufferedReader(reader, 1 << 20)
    while version := stream.readline():
        if version.rstrip() != b"WARC/1.1":
            raise ValueError(f"not the start of a record: {version[:40]!r}")
        headers = _headers(stream)
        block = io.BytesIO(stream.read(int(headers["Content-Length"])))
        stream.read(4)
        block.readline()  # the HTTP status
        length = int(_headers(block)["Content-Length"])
        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
        payload = None
        if headers["WARC-Type"] == "response":
            payload = block.read()
            if len(payload) != length or base32_digest(hashlib.sha1(payload).digest()) != digest:
                raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
        refers_to = page_of(headers["WARC-Refers-To"]) if "WARC-Refers-To" in headers else None
        yield {
            "page_id": page_of(headers["WARC-Record-ID"]),
            "payload_bytes": length,
            "payload_digest": digest,
            "record_type": headers["WARC-Type"],
            "refers_to": refers_to,
            "payload": payload,
        }


RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of the files in ``path``; with ``payload`` (null for revisits) if asked for."""
    names = [c.split()[0] for c in RECORDS.split(", ")] + ["payload"] * with_payload
    types = {"payload_digest": pa.string(), "record_type": pa.string(), "payload": pa.binary()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with opened(path) as f:
                    rows, held = [], 0
                    for record in iter_records(f):
                        rows.append(record)
                        held += 100 + (len(record["payload"] or b"") if with_payload else 0)
                        if not with_payload:
                            del record["payload"]
                        if held > 1 << 22:
                            yield as_batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield as_batch(rows)

    def as_batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[n] for r in rows], types.get(n, pa.int64())) for n in names], names)

    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path").repartition(parts, "path").mapInArrow(read, RECORDS + ", payload binary" * with_payload)


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages, then read the archives back."""
    return read_archives(write_archives(pages, fresh_path(pages.sparkSession, "warc"), min_bytes))
