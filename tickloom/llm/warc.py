"""Operator 8: WARC archives written and read as a table of records and chunks."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.arrays import rows_of, text_buffer
from tickloom.llm.components import cut
from tickloom.session import new_folder

CHUNK_BYTES = 256 << 10
IO_BYTES = 256 << 10
REVISIT_BYTES = 1000
#: Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The date is a parameter of the job, so that a task that runs again writes the same bytes.
DATE = "2000-01-01T00:00:00Z"


def _open(uri: str, write: bool = False):
    """A stream of a file in any store that Arrow reaches, shared by all executors."""
    from pyarrow import fs

    if uri.startswith("file:"):
        store, path = fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    elif uri.startswith("/"):
        store, path = fs.LocalFileSystem(), uri
    else:
        store, path = fs.FileSystem.from_uri(uri)
    if write:
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        return store.open_output_stream(path, compression=None, buffer_size=IO_BYTES)
    return store.open_input_stream(path, compression=None, buffer_size=IO_BYTES)


def decide(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """pages (id, url, html) with refers_to: the largest id with the same payload, where that is
    another one and the payload has `least_bytes` bytes; else null.

    Payloads meet by SHA-256 and length in an aggregate that combines before its shuffle, so the
    number of copies does not matter; the payloads themselves move once, to their revisits by id.
    """
    raw = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select("id", "url", "html", F.octet_length(raw).alias("bytes"), F.unhex(F.sha2(raw, 256)).alias("key"))
    large = keyed.where(F.col("bytes") >= least_bytes)
    last = large.groupBy("key", "bytes").agg(F.max("id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    revisits = (
        large.select("id", "key", "bytes")
        .join(last, ["key", "bytes"])
        .where(F.col("refers_to").isNotNull() & ~F.col("id").eqNullSafe(F.col("refers_to")))
        .select(F.col("id").alias("r_id"), F.col("key").alias("r_key"), "refers_to")
        .distinct()
    )
    same = keyed["id"].eqNullSafe(F.col("r_id")) & (keyed["key"] == F.col("r_key"))
    return keyed.join(revisits, same, "left").select("id", "url", "html", "refers_to")


def _headers(kind: str, row_id: int | None, url: str | None, length: int, digest: bytes, refers_to: int | None) -> bytes:
    name = "none" if row_id is None else str(row_id)
    lines = [
        VERSION.decode(),
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {length}",
    ]
    if url is not None:
        # Line ends and other control characters would break the header.
        lines.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str, level: int = 1) -> DataFrame:
    """Archives of the rows (id, url, html, refers_to), one file per task; returns (file, records).

    Each record is a gzip member of its own and is streamed out in pieces. A task that runs again
    writes a file of a new name, and only files of tasks that ended are in the returned table,
    which is itself kept in the shared folder. A row with refers_to becomes a revisit without a
    payload.
    """
    schema = pa.schema([("file", pa.string()), ("records", pa.int64())])

    def put(sink, head: bytes, payload) -> None:
        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
        sink.write(packer.compress(head))
        for at in range(0, len(payload), IO_BYTES):
            sink.write(packer.compress(payload[at : at + IO_BYTES]))
        sink.write(packer.compress(b"\r\n\r\n") + packer.flush())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.warc.gz"
        sink, records = None, 0
        for batch in batches:
            held, offsets = text_buffer(batch.column(2))
            view = memoryview(held) if len(held) else memoryview(b"")
            ids, urls, refs = (batch.column(k).to_pylist() for k in (0, 1, 3))
            for k in range(batch.num_rows):
                if sink is None:
                    sink = _open(name, write=True)
                payload = view[offsets[k] : offsets[k + 1]]
                digest = hashlib.sha1(payload).digest()
                http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
                kind = "response" if refs[k] is None else "revisit"
                body = payload if refs[k] is None else memoryview(b"")
                put(sink, _headers(kind, ids[k], urls[k], len(http) + len(body), digest, refs[k]) + http, body)
                records += 1
        if sink is not None:
            sink.close()
            yield rows_of(schema, [name], [records])

    picked = pages.select("id", "url", F.coalesce("html", F.lit("")).alias("html"), "refers_to")
    return cut(picked.mapInArrow(each, "file string, records long"))


class _Inflated:
    """Bytes of a stream of gzip members, read piece by piece."""

    def __init__(self, source) -> None:
        self.source, self.unpack, self.rest, self.held = source, None, b"", b""

    def _more(self) -> bool:
        while True:
            if not self.rest:
                self.rest = self.source.read(IO_BYTES)
                if not self.rest:
                    return False
            if self.unpack is None:
                self.unpack = zlib.decompressobj(31)
            got = self.unpack.decompress(self.rest, IO_BYTES)
            if self.unpack.eof:
                self.rest, self.unpack = self.unpack.unused_data, None
            else:
                self.rest = self.unpack.unconsumed_tail
            if got:
                self.held += got
                return True

    def head(self) -> bytes | None:
        """Up to and with the next empty line; None at the end."""
        while (at := self.held.find(b"\r\n\r\n")) < 0:
            if not self._more():
                return None
        out, self.held = self.held[: at + 4], self.held[at + 4 :]
        return out

    def pieces(self, length: int, most: int) -> Iterator[bytes]:
        while length:
            want = min(length, most)
            while len(self.held) < want and self._more():
                pass
            piece, self.held = self.held[:want], self.held[want:]
            if not piece:
                raise ValueError("an archive ends inside a record")
            length -= len(piece)
            yield piece


def _records(source, chunk_bytes: int, payload: bool):
    stream = _Inflated(source)
    while (head := stream.head()) is not None:
        lines = head.decode().split("\r\n")
        if lines[0] != VERSION.decode():
            raise ValueError(f"no WARC record: {lines[0][:40]!r}")
        field = dict(line.split(": ", 1) for line in lines[1:] if line)
        name = field["WARC-Record-ID"][len("<urn:page:") : -1]
        row_id = None if name == "none" else int(name)
        refers = field.get("WARC-Refers-To")
        refers_to = int(refers[len("<urn:page:") : -1]) if refers else None
        http = stream.head()
        left = int(field["Content-Length"]) - len(http)
        told = base64.b32decode(field["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        running, done, number = hashlib.sha1(), 0, 0
        if not left:
            yield row_id, 0, True, 0, told if refers else running.hexdigest(), told, field["WARC-Type"], refers_to, b""
        for piece in stream.pieces(left, chunk_bytes):
            running.update(piece)
            done += len(piece)
            yield row_id, number, done == left, done, running.hexdigest(), told, field["WARC-Type"], refers_to, piece if payload else None
            number += 1
        if b"".join(stream.pieces(4, 4)) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")


def read_chunks(archives: DataFrame, chunk_bytes: int = CHUNK_BYTES, payload: bool = True) -> DataFrame:
    """(id, chunk, last, bytes, digest, told_digest, record_type, refers_to, data) of every chunk of
    every record of the archives named in column `file`.

    bytes and digest (SHA-1, hex) are those of the payload up to and with the chunk, carried on from
    chunk to chunk, so the last chunk has those of the whole payload, and no task ever holds more
    than a chunk of it. told_digest is the header's. A payload of no bytes is one empty chunk; so is
    a revisit, whose digest is the header's. data is null with payload=False.
    """
    schema = pa.schema(
        [
            ("id", pa.int64()), ("chunk", pa.int64()), ("last", pa.bool_()), ("bytes", pa.int64()), ("digest", pa.string()),
            ("told_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("data", pa.binary()),
        ]
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with _open(name) as source:
                    for row in _records(source, chunk_bytes, payload):
                        rows.append(row)
                        held += len(row[8] or b"")
                        if len(rows) >= 1000 or held >= 4 << 20:
                            yield rows_of(schema, *zip(*rows))
                            rows, held = [], 0
                if rows:
                    yield rows_of(schema, *zip(*rows))

    files = archives.select("file")
    kinds = "id long, chunk long, last boolean, bytes long, digest string, told_digest string, record_type string, refers_to long, data binary"
    return files.repartition(max(1, files.count()), "file").mapInArrow(each, kinds)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", folder: str | None = None) -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to, intact) of every page, read back
    from archives written for it.

    A null html is an empty payload; a null id is never referred to. Of rows that repeat an id and a
    payload each is written. intact says whether the digest read agrees with the header's.
    """
    spark: SparkSession = pages.sparkSession
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    archives = write_archives(decide(rows), folder or new_folder(spark, "warc"))
    ends = cut(read_chunks(archives, payload=False).where("last").drop("data"))
    whole = ends.where("record_type = 'response'")
    revisits = ends.where("record_type = 'revisit'")
    target = whole.groupBy("id", "digest").agg(F.max("bytes").alias("t_bytes"))
    target = target.select(F.col("id").alias("t_id"), F.col("digest").alias("t_digest"), "t_bytes")
    found = revisits.join(target, (F.col("refers_to") == F.col("t_id")) & (F.col("digest") == F.col("t_digest")), "left")
    columns = ["id", F.col("digest").alias("payload_digest"), "record_type", "refers_to", (F.col("digest") == F.col("told_digest")).alias("intact")]
    return whole.select(F.col("bytes").alias("payload_bytes"), *columns).unionByName(
        found.select(F.col("t_bytes").alias("payload_bytes"), *columns)
    )
