"""WARC archives: one gzip member per record, written by tasks and read back sequentially.

Writing: payloads of at least ``REVISIT_BYTES`` that occur more than once are found by a partial aggregate of
their digests; one of their pages becomes a response, the others revisit it. Each task writes its own archives
to the shared folder, a new one whenever the last has grown large, and reports them in a manifest. Names carry
the task attempt, and only archives of the stored manifest are read, so a repeated task does no harm.

Reading: a task streams an archive member by member. It holds one chunk of compressed data, decompresses as
far as it needs, takes header lines up to the blank one, frames the block by its Content-Length and checks the
digests of block and payload on the way.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from riskflow.llm.common import bounded_batches, text_rows
from riskflow.session import materialize, new_path

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
CHUNK = 1 << 16
LEVEL = 4
MAX_HEADER = 1 << 20

# The format's own words.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of capture
PAGE_URN = "urn:x-page:"


def _sha1(data: bytes) -> str:
    return hashlib.sha1(data, usedforsecurity=False).hexdigest()


def _clean(value: object) -> str:
    """A header value on one line."""
    return " ".join(str(value).split())


def _page_uri(page_id: object) -> str:
    return f"<{PAGE_URN}{'' if page_id is None else page_id}>"


def record(page_id: object, uri: str | None, payload: bytes, refers_to: object = None, revisit: bool = False) -> bytes:
    """One record as plain bytes."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _page_uri(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": _clean(uri or ""),
        "WARC-Payload-Digest": f"sha1:{_sha1(payload)}",
        "WARC-Block-Digest": f"sha1:{_sha1(block)}",
        "Content-Type": "application/http; msgtype=response",
    }
    if revisit:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _page_uri(refers_to)}
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{name}: {value}\r\n" for name, value in head.items())
    return f"{VERSION}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


@dataclass
class Record:
    """A record as read: header fields in lower case, the payload, and whether the digests hold."""

    fields: dict[str, str]
    payload_bytes: int = 0
    payload_digest: str = ""
    payload: bytes | None = None
    faults: list[str] = field(default_factory=list)

    def page(self, name: str) -> str | None:
        """The page id in a record-id field."""
        value = self.fields.get(name, "").strip("<>")
        return value.removeprefix(PAGE_URN) or None if value.startswith(PAGE_URN) else None


class Members:
    """The gzip members of a stream, each read as a file of its own."""

    def __init__(self, stream: BinaryIO, chunk: int = CHUNK) -> None:
        self._stream, self._chunk = stream, chunk
        self._raw = b""
        self._inflate = None
        self._plain = b""

    def open_next(self) -> bool:
        """Start the next member; false at the end of the stream."""
        self._raw = self._raw or self._stream.read(self._chunk)
        self._plain = b""
        self._inflate = zlib.decompressobj(wbits=31) if self._raw else None
        return self._inflate is not None

    def _fill(self) -> bool:
        """Decompress one more chunk at most; false at the end of the member."""
        while not self._inflate.eof:
            if not self._raw:
                self._raw = self._stream.read(self._chunk)
                if not self._raw:
                    raise ValueError("the archive ends within a member")
            more = self._inflate.decompress(self._raw, self._chunk)
            self._raw = self._inflate.unused_data if self._inflate.eof else self._inflate.unconsumed_tail
            if more:
                self._plain += more
                return True
        return False

    def line(self) -> str:
        while b"\r\n" not in self._plain:
            if len(self._plain) > MAX_HEADER or not self._fill():
                raise ValueError("a header line has no end")
        line, _, self._plain = self._plain.partition(b"\r\n")
        return line.decode("utf-8", "replace")

    def read(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes, in parts."""
        while size:
            if not self._plain and not self._fill():
                raise ValueError("a record is shorter than its Content-Length")
            part, self._plain = self._plain[:size], self._plain[size:]
            size -= len(part)
            yield part

    def rest(self) -> bytes:
        while self._fill():
            if len(self._plain) > MAX_HEADER:
                raise ValueError("a record is longer than its Content-Length")
        return self._plain


def read_record(members: Members, with_payload: bool) -> Record:
    """The record in the member that has just been opened."""
    version = members.line()
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields: dict[str, str] = {}
    while line := members.line():
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    block, body = hashlib.sha1(usedforsecurity=False), hashlib.sha1(usedforsecurity=False)
    head, kept, size, in_body = b"", [], 0, "http" not in fields.get("content-type", "")
    for part in members.read(int(fields["content-length"])):
        block.update(part)
        if not in_body:
            head += part
            before, found, part = head.partition(b"\r\n\r\n")
            if not found:
                continue
            in_body = True
        body.update(part)
        size += len(part)
        if with_payload:
            kept.append(part)
    found = Record(fields, size, body.hexdigest(), b"".join(kept) if with_payload else None)
    if members.rest() != b"\r\n\r\n":
        found.faults.append("end")
    if fields.get("warc-block-digest", "") not in ("", f"sha1:{block.hexdigest()}"):
        found.faults.append("block digest")
    claimed = fields.get("warc-payload-digest", "")
    if fields.get("warc-type") == "revisit":
        found.payload_digest = claimed.removeprefix("sha1:")
    elif claimed not in ("", f"sha1:{found.payload_digest}"):
        found.faults.append("payload digest")
    return found


def _open(path: str):
    """The file system of a path that all executors share, and the path on it."""
    return pafs.FileSystem.from_uri(path)


def write_archives(
    pages: DataFrame,
    target: str | None = None,
    revisit_bytes: int = REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    level: int = LEVEL,
) -> DataFrame:
    """Write a record per row of (page_id, url, html) and return the stored manifest: path, records, bytes.

    Of rows with equal payloads of at least ``revisit_bytes`` that with the largest id is the response; rows that
    repeat its id are responses too. A null html is an empty payload, a null url an empty one, a null id a
    record without a page id that no other refers to. An empty table writes nothing.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    folder = (target or new_path(spark, "warc")).rstrip("/")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    source = text_rows(pages, "page_id", "url", "html").select("page_id", "url", payload.alias("payload"))
    keyed = source.withColumn(
        "digest", F.when(F.octet_length("payload") >= revisit_bytes, F.sha2("payload", 256))
    )
    repeated = (
        keyed.filter("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND refers_to IS NOT NULL")
        .select("digest", "refers_to")
    )
    repeated = materialize(repeated, "repeated")
    rows = keyed.join(repeated, "digest", "left").select("page_id", "url", "payload", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, base = _open(folder)
        system.create_dir(base, recursive=True)
        made, stream, name = [], None, ""
        n = size = 0

        def close() -> None:
            if stream is not None:
                stream.close()
                made.append((f"{folder}/{name}", n, size))

        for batch in batches:
            for row in batch.to_pylist():
                if stream is None or size >= archive_bytes:
                    close()
                    name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{len(made)}.warc.gz"
                    stream, n, size = system.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                revisit = row["refers_to"] is not None and row["page_id"] != row["refers_to"]
                plain = record(row["page_id"], row["url"], row["payload"], row["refers_to"], revisit)
                member = zlib.compress(plain, level, wbits=31)
                stream.write(member)
                n, size = n + 1, size + len(member)
        close()
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)], names=["path", "records", "bytes"])

    return materialize(rows.mapInArrow(write, "path string, records bigint, bytes bigint"), "manifest")


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives listed in ``manifest.path``, each read by one task from start to end.

    page_id, uri, record_type, refers_to (page ids as text), payload_bytes, payload_digest (hex SHA-1),
    payload, faults (names of what did not verify). A revisit has the digest that it claims and no bytes. A
    broken archive or one with other than its listed records stops the job.
    """
    files = manifest.select("path", "records")
    n = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "uri", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload", "faults"]
        types = [*[pa.string()] * 4, pa.int64(), pa.string(), pa.binary(), pa.list_(pa.string())]

        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for path, expected in zip(*[batch.column(i).to_pylist() for i in (0, 1)]):
                system, name = _open(path)
                rows, total, held = [], 0, 0
                with system.open_input_stream(name, compression=None) as stream:
                    members = Members(stream)
                    while members.open_next():
                        r = read_record(members, with_payload)
                        rows.append(
                            (
                                r.page("warc-record-id"),
                                r.fields.get("warc-target-uri"),
                                r.fields.get("warc-type"),
                                r.page("warc-refers-to"),
                                r.payload_bytes,
                                r.payload_digest,
                                r.payload,
                                r.faults,
                            )
                        )
                        total, held = total + 1, held + len(r.payload or b"") + 200
                        if held > 4 << 20:
                            yield table(rows)
                            rows, held = [], 0
                if rows:
                    yield table(rows)
                if total != expected:
                    raise ValueError(f"{path} has {total} records instead of {expected}")

    return files.repartition(n, "path").mapInArrow(
        read,
        "page_id string, uri string, record_type string, refers_to string, payload_bytes bigint, "
        "payload_digest string, payload binary, faults array<string>",
    )


def with_full_payloads(records: DataFrame) -> DataFrame:
    """Revisits with the bytes of the response they refer to, from stored ``records`` without payloads.

    ``verified`` is false for a record with a fault, and for a revisit whose response is missing or has another
    digest.
    """
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    plain = records.filter("record_type <> 'revisit'").select(*columns, (F.size("faults") == 0).alias("verified"))
    revisits = records.filter("record_type = 'revisit'").drop("payload_bytes", "payload")
    wanted = revisits.select(F.col("refers_to").alias("wanted")).distinct()
    found = (
        records.filter("record_type = 'response'")
        .join(wanted, F.col("page_id") == F.col("wanted"), "left_semi")
        .groupBy(F.col("page_id").alias("of_page"), F.col("payload_digest").alias("of_digest"))
        .agg(F.max("payload_bytes").alias("payload_bytes"))
    )
    found = materialize(found, "responses")
    same = (F.col("refers_to") == F.col("of_page")) & (F.col("payload_digest") == F.col("of_digest"))
    full = revisits.join(found, same, "left").select(
        *columns, ((F.size("faults") == 0) & F.col("of_page").isNotNull()).alias("verified")
    )
    return plain.unionByName(full)


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back and return a row per page.

    page_id, payload_bytes, payload_digest, record_type, refers_to, verified. A broken record stops the job or
    has ``verified`` false. See ``write_archives`` for nulls, repeated rows and empty tables.
    """
    manifest = write_archives(pages)
    records = materialize(read_archives(manifest, with_payload=False).drop("payload", "uri"), "records")
    kind = pages.schema["page_id"].dataType.simpleString()
    return with_full_payloads(records).withColumns(
        {name: F.col(name).cast(kind) for name in ("page_id", "refers_to")}
    )
