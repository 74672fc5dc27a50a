"""WARC archives: a writer that revisits repeated payloads and a sequential reader.

An archive is a series of gzip members, one per record (WARC 1.1). The reader takes it from a
stream, inflates ``CHUNK`` bytes at a time, frames a record by its Content-Length and adds to its
digests as it goes; of a payload that nobody asked for it keeps no more than such a piece.

Writing raw bytes with Spark's own text writer keeps archives on any file system Spark knows: a
row is an archive without its last byte, and the line separator NUL supplies that byte. The last
byte of a member is the top byte of its length, zero for records below 16 MiB; a longer record
is followed by an empty member, whose last byte is zero too.

Defined results: a null payload is an empty one; a record with a null id is a response, has the
record id ``urn:page:null`` and is never revisited; rows with the smallest id of a payload are
all responses, also when that id repeats; null urls become empty. A damaged archive raises
``WarcError``, so no record is skipped in silence.
"""

from __future__ import annotations

import hashlib
import io
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"  # fixed: equal input gives equal archives
CHUNK = 1 << 16
BLANK = b"\r\n\r\n"
BATCH = 8 << 20  # bytes of payload sent on at once
RECORDS = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string,"
    " record_type string, refers_to bigint, payload binary"
)


class WarcError(ValueError):
    pass


def _lines(*fields: tuple[str, object]) -> bytes:
    return b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)


def _one_line(text: str | None) -> str:
    return " ".join((text or "").split())


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One uncompressed record. A revisit keeps the HTTP head, with the payload's length."""
    head = b"HTTP/1.1 200 OK\r\n"
    head += _lines(("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload)))
    revisit = refers_to is not None
    block = head + b"\r\n" + (b"" if revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'null' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _one_line(url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    if revisit:
        refers = [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
        fields[3:3] = refers
    return VERSION + b"\r\n" + _lines(*fields) + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """``data`` as a gzip member that ends in a zero byte."""
    packed = _gzip(data, level)
    return packed if packed[-1] == 0 else packed + _gzip(b"", level)


def _gzip(data: bytes, level: int) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def first_holders(pages: DataFrame, least_bytes: int) -> DataFrame:
    """digest, length, holder: the smallest page id of every payload that repeats."""
    long = pages.where(F.col("payload_bytes") >= least_bytes)
    return (
        long.groupBy("payload_digest")
        .agg(
            F.min("page_id").alias("holder"),
            F.max("payload_bytes").alias("payload_bytes"),
            F.count("*").alias("n"),
        )
        .where(F.col("n") > 1)
        .drop("n")
    )


def write(
    pages: DataFrame,
    path: str,
    least_bytes: int = 100,
    per_file: int = 20_000,
    file_bytes: int = 32 << 20,
) -> None:
    """Archives of ``pages`` (page_id, url, html) below ``path``. An archive has ``per_file`` records
    and ``file_bytes`` bytes at most (a record that alone is longer has one of its own), so that
    the tasks that write and read it hold a bounded value.

    The payload is shuffled once, to meet its group; the groups come from digests alone. The
    join's keys hold the length as well, so the groups are dealt anew and a payload that a
    third of the pages share can be split.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {
            "payload_digest": F.sha2("payload", 256),
            "payload_bytes": F.octet_length("payload").cast("bigint"),
        }
    )
    groups = first_holders(rows.drop("payload"), least_bytes)
    marked = rows.join(groups, ["payload_digest", "payload_bytes"], "left").select(
        "page_id", "url", "payload", "payload_digest",
        F.when(F.col("page_id") > F.col("holder"), F.col("holder")).alias("refers_to"),
    )

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(members: list[bytes]) -> pa.RecordBatch:
            archive = b"".join(members)
            return pa.record_batch({"value": pa.array([memoryview(archive)[:-1]], pa.binary())})

        members, size = [], 0
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                columns = batch.slice(i, 64).to_pydict().values()
                for row in zip(*columns, strict=True):
                    new = member(record(*row))
                    if members and (len(members) == per_file or size + len(new) > file_bytes):
                        yield packed(members)
                        members, size = [], 0
                    members.append(new)
                    size += len(new)
        if members:
            yield packed(members)

    rows = marked.mapInArrow(archives, "value binary")
    writer = rows.select(F.col("value").cast("string").alias("value")).write
    writer.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


class Members:
    """The gzip members of a stream one after the other, inflated in pieces."""

    def __init__(self, stream: BinaryIO) -> None:
        self._stream, self._rest = stream, b""
        self._unpack = zlib.decompressobj(31)

    def open(self) -> bool:
        """Goes on to the next member; false at the end of the stream."""
        self._rest = self._rest or self._stream.read(CHUNK)
        self._unpack = zlib.decompressobj(31)
        return bool(self._rest)

    def read(self) -> bytes:
        """The next piece of the member, ``CHUNK`` bytes at most, empty at its end."""
        while not self._unpack.eof:
            self._rest = self._rest or self._stream.read(CHUNK)
            last = not self._rest
            try:
                piece = self._unpack.decompress(self._rest, CHUNK)
            except zlib.error as error:
                raise WarcError(f"damaged gzip member: {error}") from error
            ended = self._unpack.eof
            self._rest = self._unpack.unused_data if ended else self._unpack.unconsumed_tail
            if piece:
                return piece
            if last and not ended:
                raise WarcError("the archive ends inside a gzip member")
        return b""


def inflate(archive: bytes) -> Iterator[bytes]:
    """The content of each gzip member that has any, whole."""
    members = Members(io.BytesIO(archive))
    while members.open():
        data = b"".join(iter(members.read, b""))
        if data:
            yield data


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:] if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _page(urn: str | None) -> int | None:
    found = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(found) if found not in ("", "null") else None


def _verify(found: str, named: str, what: str) -> None:
    if found != named.removeprefix("sha256:"):
        raise WarcError(f"the {what} digest does not match")


def _record(data: bytes, read: Callable[[], bytes], keep: bool) -> tuple:
    """One record as a row of ``RECORDS``, its digests verified. ``data`` is its first piece, ``read``
    gives those that follow."""
    while BLANK not in data:
        more = read()
        if not more:
            raise WarcError("no WARC header")
        data += more
    head, _, data = data.partition(BLANK)
    if not head.startswith(VERSION + b"\r\n"):
        raise WarcError("no WARC header")
    fields = _fields(head)
    left = int(fields["content-length"])
    block, body = hashlib.sha256(), hashlib.sha256()
    http, inside, got, kept = b"", False, 0, []
    while True:
        piece, data = data[:left], data[left:]
        left -= len(piece)
        block.update(piece)
        if not inside:
            http += piece
            http, found, piece = http.partition(BLANK)
            inside = bool(found)
        body.update(piece)
        got += len(piece)
        if keep:
            kept.append(piece)
        if not left:
            break
        data = read()
        if not data:
            break
    while len(data) <= len(BLANK) and (more := read()):
        data += more
    if left or data != BLANK:
        raise WarcError("the record's length differs from its Content-Length")
    _verify(block.hexdigest(), fields["warc-block-digest"], "block")
    kind, size = fields["warc-type"], int(_fields(http)["content-length"])
    digest = fields["warc-payload-digest"]
    if kind == "response":
        _verify(body.hexdigest(), digest, "payload")
        if got != size:
            raise WarcError("the payload's length differs from the HTTP head's")
    page, uri = _page(fields["warc-record-id"]), fields["warc-target-uri"]
    payload = b"".join(kept) if keep and kind == "response" else None
    refers = _page(fields.get("warc-refers-to"))
    return page, uri, size, digest.removeprefix("sha256:"), kind, refers, payload


def parse(data: bytes) -> tuple:
    """One uncompressed record as a row of ``RECORDS``."""
    return _record(data, bytes, True)


def records(stream: BinaryIO, keep: bool = True) -> Iterator[tuple]:
    """Rows of ``RECORDS`` of an archive, in its order; without payloads unless ``keep``."""
    members = Members(stream)
    while members.open():
        first = members.read()
        if first:
            yield _record(first, members.read, keep)


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives below ``path``, in rows of ``RECORDS``."""
    names = [part.split()[0] for part in RECORDS.split(", ")]
    kept = names if with_payload else names[:-1]
    schema = RECORDS if with_payload else RECORDS.removesuffix(", payload binary")

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        kinds.append(pa.binary())

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds)]
            return pa.record_batch(columns[: len(kept)], names=kept)

        for batch in batches:
            for archive in batch.column("content"):
                rows, size = [], 0
                for row in records(pa.BufferReader(archive.as_buffer()), with_payload):
                    rows.append(row)
                    size += len(row[-1] or b"")
                    if len(rows) == 256 or size >= BATCH:
                        yield packed(rows)
                        rows, size = [], 0
                if rows:
                    yield packed(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(rows_of, schema)
