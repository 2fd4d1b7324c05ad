"""WARC archives compressed record by record with a Zstandard dictionary of their own.

An archive starts with a skippable frame that holds the dictionary, trained on the first records
of that archive; every record follows as a frame of its own, so a reader needs nothing else.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logflow.scratch import materialize
from logflow.session import ship_package

#: Fixed values of the formats: the skippable frame's magic number, profile and header lines.
DICTIONARY_FRAME = 0x184D2A5D
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

#: Copies of this many salts let Spark split a payload that a large share of all pages has.
SALTS = 16

MANIFEST = "archive string, records long, bytes long"
READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def with_originals(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Pages as ``page_id, url, payload, sha1, refers_to``: null for responses, else the first page's id.

    Of pages with equal payloads of at least ``min_revisit_bytes`` bytes, those with the smallest
    page_id are responses (repeated rows of one page alike) and all others refer to it.  Equal payloads
    are found on digests alone; payloads move only if Spark does not broadcast the repeated digests.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("sha1"))
    repeated = (
        rows.where(F.length("payload") >= min_revisit_bytes)
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .select("sha1", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salt: Column = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")
    other = F.col("page_id").isNull() | (F.col("page_id") != F.col("first"))
    return (
        rows.withColumn("salt", salt)
        .join(repeated, ["sha1", "salt"], "left")
        .select("page_id", "url", "payload", "sha1", F.when(other, F.col("first")).alias("refers_to"))
    )


def record_id(page_id: int | None, sha1: str) -> str:
    name = f"page:{page_id}" if page_id is not None else f"payload:{sha1}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, first: int | None, date: str) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the header of the response only."""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, sha1)}",
        f"WARC-Date: {date}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}",
    ]
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if first is not None:
        lines += [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: {record_id(first, sha1)}", f"Refers-To-Page-ID: {first}"]
    block = (HTTP_HEAD % len(payload)).encode() + (payload if first is None else b"")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(samples: list[bytes], size: int) -> bytes | None:
    """A dictionary of the samples, or None where there are too few of them."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if len(samples) > 7 else None
    except zstandard.ZstdError:
        return None


class Archive:
    """One archive, written under a temporary name and moved once it is whole."""

    def __init__(self, root: str, samples: list[bytes], dict_bytes: int, level: int) -> None:
        self.store, base = fs.FileSystem.from_uri(root)
        self.store.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.zst"
        self.path, self.final, self.uri = f"{base}/.{name}", f"{base}/{name}", f"{root}/{name}"
        self.out, self.records, self.raw = self.store.open_output_stream(self.path), 0, 0
        words = train(samples, dict_bytes)
        if words:
            self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(words)) + words)
        own = zstandard.ZstdCompressionDict(words) if words else None
        self.frames = zstandard.ZstdCompressor(level=level, dict_data=own)

    def add(self, data: bytes) -> None:
        self.out.write(self.frames.compress(data))
        self.records += 1
        self.raw += len(data)

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        self.store.move(self.path, self.final)
        return self.uri, self.records, self.raw


def write_archives(
    pages: DataFrame,
    root: str,
    min_revisit_bytes: int = 0,
    archive_bytes: int = 256 << 20,
    sample_bytes: int = 2 << 20,
    dict_bytes: int = 64 << 10,
    level: int = 3,
    date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Write ``pages (page_id, url, html)`` as archives under ``root``; returns the stored list of archives.

    A task starts a new archive after ``archive_bytes`` of records.  The dictionary of an archive is trained
    on its first ``sample_bytes``; archives of a few records have none.  A null html is an empty payload, a
    null url or page_id leaves its header line out, other columns are ignored, an empty table gives no
    archive.  A task that runs twice writes twice, and only the archives in the list count.
    """
    ship_package(pages.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[str, int, int]] = []
        archive, waiting, held = None, [], 0

        def start() -> Archive:
            new = Archive(root, waiting, dict_bytes, level)
            for data in waiting:
                new.add(data)
            return new

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "sha1", "refers_to")]
            for i in range(batch.num_rows):
                page, url, payload, sha1, first = (c[i].as_py() for c in columns)
                data = record(page, url, payload, sha1, first, date)
                if archive:
                    archive.add(data)
                else:
                    waiting.append(data)
                    held += len(data)
                    if held >= sample_bytes:
                        archive, waiting, held = start(), [], 0
                if archive and archive.raw >= archive_bytes:
                    done.append(archive.close())
                    archive = None
        if waiting:
            archive = start()
        if archive:
            done.append(archive.close())
        names, records, sizes = zip(*done, strict=True) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())],
            names=["archive", "records", "bytes"],
        )

    return materialize(with_originals(pages, min_revisit_bytes).mapInArrow(write, MANIFEST), "archives")


def records_of(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an archive, read as a stream."""
    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_stream(path) as file:
        head, own = file.read(8), None
        if len(head) == 8 and struct.unpack("<II", head)[0] == DICTIONARY_FRAME:
            own, head = zstandard.ZstdCompressionDict(file.read(struct.unpack("<II", head)[1])), b""
        source = io.BufferedReader(_Rest(head, file)) if head else file
        frames = zstandard.ZstdDecompressor(dict_data=own).stream_reader(source, read_across_frames=True)
        lines = io.BufferedReader(frames, 1 << 16)
        while version := lines.readline():
            if not version.startswith(b"WARC/"):
                raise ValueError(f"{uri}: no record starts with {version[:20]!r}")
            fields = {}
            while (line := lines.readline().rstrip(b"\r\n")):
                name, _, value = line.decode().partition(": ")
                fields[name] = value
            block = lines.read(int(fields["Content-Length"]))
            if lines.read(4) != b"\r\n\r\n":
                raise ValueError(f"{uri}: a record does not end where its length says")
            yield fields, block


class _Rest(io.RawIOBase):
    """A stream with some bytes put back before it."""

    def __init__(self, head: bytes, file) -> None:
        self.head, self.file = head, file

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        data = self.head[: len(into)] or self.file.read(len(into))
        self.head = self.head[len(into) :]
        into[: len(data)] = data
        return len(data)


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of listed archives: READ's columns, and ``payload`` on request (null for revisits).

    Size and digest of a response are taken from its payload and must agree with its header.
    """
    ship_package(archives.sparkSession)
    names = [c.split()[0] for c in READ.split(", ")] + ["payload"] * with_payload
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * with_payload

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for listed in batches:
            for uri in listed.column("archive").to_pylist():
                rows, held = [], 0
                for fields, block in records_of(uri):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    digest, first = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields.get("Refers-To-Page-ID")
                    size = int(head.rpartition(b"Content-Length: ")[2])
                    if fields["WARC-Type"] == "response":
                        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if (len(payload), found) != (size, digest):
                            raise ValueError(f"{uri}: payload of {fields['WARC-Record-ID']} is damaged")
                    page = fields.get("Page-ID")
                    row = (page and int(page), fields.get("WARC-Target-URI"), size, digest, fields["WARC-Type"], first and int(first))
                    rows.append(row + ((payload if first is None else None,) if with_payload else ()))
                    held += len(payload) * with_payload
                    if len(rows) == 4096 or held > 8 << 20:
                        yield batch(rows)
                        rows, held = [], 0
                yield batch(rows)

    schema = READ + ", payload binary" * with_payload
    return archives.repartition(max(1, archives.count()), "archive").mapInArrow(read, schema)
