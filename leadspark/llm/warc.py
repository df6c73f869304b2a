"""WARC archives: write, normalise, read back.

A task streams its pages into archives of bounded size, each one gzip stream over all its records, as crawlers leave
them. The normaliser inflates each such stream once, rewrites every record as a gzip member of its own, and writes a
sidecar index of offsets, so that any record can be read alone. A payload that the archives hold already becomes a
revisit record that names the page which has it.

Archives are files in a folder that all executors share, reached through the file system of its URI. A file is written
under the name of its task's attempt and then moved to its final name, so a repeated task replaces it by the same.

Defined cases: a null ``html`` is an empty payload. A null or odd ``url`` is percent-encoded or replaced by the record's
number. Of equal payloads the smallest ``page_id`` is the response; rows that repeat this id are responses too; null ids
come last, and are responses if no other page has the payload. An empty table gives no archives and no rows. Other
columns are not stored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import urllib.parse
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from leadspark.session import keep, shared_folder

ARCHIVE_BYTES = 32 << 20
_LEVEL = 4
_DATE = "1970-01-01T00:00:00Z"
_WRITTEN = "archive string, number long, page_id long, digest string, payload_bytes long"
_WRITTEN_ARROW = pa.schema([("archive", pa.string()), ("number", pa.int64()), ("page_id", pa.int64()), ("digest", pa.string()), ("payload_bytes", pa.int64())])
INDEX = "archive string, number long, offset long, length long, page_id long, record_type string"
_INDEX_ARROW = pa.schema([("archive", pa.string()), ("number", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()), ("record_type", pa.string())])
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_RECORDS_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _place(folder: str):
    system, path = pafs.FileSystem.from_uri(folder)
    return system, path.rstrip("/")


def _put(folder: str, name: str, content: bytes) -> None:
    system, path = _place(folder)
    part = f"{path}/.{name}-{TaskContext.get().taskAttemptId() if TaskContext.get() else 0}"
    system.create_dir(path, recursive=True)
    with system.open_output_stream(part, compression=None) as out:
        out.write(content)
    system.move(part, f"{path}/{name}")


def _get(folder: str, name: str):
    system, path = _place(folder)
    return system.open_input_file(f"{path}/{name}")


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + f"Content-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def response(name: str, number: int, page_id: int | None, url: str | None, payload: bytes, digest: str) -> bytes:
    uri = urllib.parse.quote(url, safe=":/?#[]@!$&'()*+,;=%~-._") if url else f"urn:record:{name}:{number}"
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}/{number}')}>"), ("WARC-Date", _DATE), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    fields.append(("Content-Type", "application/http; msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return record(fields, http + payload)


def revisit(fields: list[tuple[str, str]], refers_to: int | None) -> bytes:
    """The record with its payload left out."""
    changed = [(k, "revisit" if k == "WARC-Type" else v) for k, v in fields if k != "Content-Length"]
    changed += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page-Id", str(refers_to))]
    return record(changed, b"")


class Inflated(io.RawIOBase):
    """The bytes of a gzip stream of one or many members, inflated as they are read."""

    def __init__(self, source, chunk: int = 1 << 18):
        self.source, self.chunk, self.buffer = source, chunk, bytearray()
        self.engine = zlib.decompressobj(31)
        self.left = b""

    def _more(self) -> bool:
        data = self.left or self.source.read(self.chunk)
        self.left = b""
        if not data:
            return False
        if self.engine.eof:
            self.engine = zlib.decompressobj(31)
        self.buffer += self.engine.decompress(data)
        if self.engine.eof:
            self.left = self.engine.unused_data
        return True

    def until(self, mark: bytes) -> bytes | None:
        """The bytes up to and with the mark; None at the end of the stream."""
        searched = 0
        while (at := self.buffer.find(mark, searched)) < 0:
            searched = max(0, len(self.buffer) - len(mark))
            if not self._more():
                if self.buffer.strip():
                    raise ValueError("the archive ends within a record")
                return None
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self._more():
                raise ValueError("the archive ends within a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def records_of(stream: Inflated):
    """``(fields, block)`` of each record of a stream."""
    while (head := stream.until(b"\r\n\r\n")) is not None:
        lines = head.decode().lstrip("\r\n").split("\r\n")
        if not re.match(r"WARC/\d", lines[0]):
            raise ValueError("no WARC record")
        fields = [tuple(x.split(": ", 1)) for x in lines[1:] if x]
        block = stream.take(int(dict(fields)["Content-Length"]))
        stream.take(4)
        yield fields, block


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the pages as whole-file gzip archives; one row for each record. Lazy: keep the rows before use."""

    def write(batches):
        part = TaskContext.get().partitionId()
        rows, size, archives, packer, packed = [], 0, 0, None, []

        def close():
            nonlocal rows, size, archives, packer, packed
            if packer is None:
                return None
            _put(folder, rows[0][0], b"".join(packed) + packer.flush())
            out = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _WRITTEN_ARROW, strict=True)], schema=_WRITTEN_ARROW)
            rows, size, packer, packed, archives = [], 0, None, [], archives + 1
            return out

        for batch in batches:
            for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                name = f"raw-{part:06d}-{archives:05d}.warc.gz"
                packer = packer or zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
                payload = (html or "").encode()
                digest = digest_of(payload)
                packed.append(packer.compress(response(name, len(rows), page_id, url, payload, digest)))
                rows.append((name, len(rows), page_id, digest, len(payload)))
                size += len(payload) + 512
                if size >= archive_bytes:
                    yield close()
        if (last := close()) is not None:
            yield last

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(write, _WRITTEN)


def choose_responses(written: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Add ``keeper``: of equal payloads of at least so many bytes, the smallest page; null where the record stays whole."""
    keepers = written.where(F.col("payload_bytes") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("keeper"))
    whole = (F.col("payload_bytes") < least_bytes) | F.col("keeper").isNull() | F.col("page_id").eqNullSafe(F.col("keeper"))
    return written.join(keepers, "digest", "left").withColumn("keeper", F.when(~whole, F.col("keeper")))


def normalise(chosen: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive with a member for each record and write its index beside it; the index rows are returned.

    An archive's rows are as many as its bounded size allows.
    """

    def rewrite(table):
        raw = table.column("archive")[0].as_py()
        name = raw.removeprefix("raw-")
        keepers = dict(zip(table.column("number").to_pylist(), table.column("keeper").to_pylist(), strict=True))
        out, at, rows = [], 0, []
        with _get(folder, raw) as source:
            for number, (fields, block) in enumerate(records_of(Inflated(source))):
                named = dict(fields)
                keeper = keepers[number]
                whole = record([x for x in fields if x[0] != "Content-Length"], block) if keeper is None else revisit(fields, keeper)
                packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
                member = packer.compress(whole) + packer.flush()
                out.append(member)
                page = named.get("X-Page-Id")
                rows.append((name, number, at, len(member), None if page is None else int(page), "response" if keeper is None else "revisit"))
                at += len(member)
        _put(folder, name, b"".join(out))
        fields = [f.name for f in _INDEX_ARROW]
        _put(folder, f"{name}.index.jsonl", "".join(json.dumps(dict(zip(fields, r, strict=True))) + "\n" for r in rows).encode())
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _INDEX_ARROW, strict=True)], schema=_INDEX_ARROW)

    return chosen.select("archive", "number", "keeper").groupBy("archive").applyInArrow(rewrite, INDEX)


def read_archives(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records that the index lists, each inflated alone from its offset, and checked against its digest."""

    def read(table):
        rows = []
        with _get(folder, table.column("archive")[0].as_py()) as source:
            for offset, length in sorted(zip(table.column("offset").to_pylist(), table.column("length").to_pylist(), strict=True)):
                source.seek(offset)
                ((fields, block),) = records_of(Inflated(io.BytesIO(source.read(length))))
                named = dict(fields)
                is_response = named["WARC-Type"] == "response"
                payload = block.split(b"\r\n\r\n", 1)[1] if is_response else None
                size, digest = int(named["X-Payload-Length"]), named["WARC-Payload-Digest"].removeprefix("sha1:")
                if is_response and (len(payload), digest_of(payload)) != (size, digest):
                    raise ValueError(f"damaged record at {offset}")
                number = lambda k: None if named.get(k) is None else int(named[k])
                rows.append((number("X-Page-Id"), named["WARC-Target-URI"], size, digest, named["WARC-Type"], number("X-Refers-To-Page-Id"), payload if payloads else None))
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _RECORDS_ARROW, strict=True)], schema=_RECORDS_ARROW)

    return index.select("archive", "offset", "length").groupBy("archive").applyInArrow(read, RECORDS)


def archive_pages(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, payloads: bool = True) -> DataFrame:
    """Write, normalise and read back the pages (``page_id``, ``url``, ``html``): the records of the archives."""
    folder = folder or f"{shared_folder(pages.sparkSession)}-warc"
    written = keep(write_archives(pages, folder))
    index = keep(normalise(choose_responses(written, least_bytes), folder))
    return read_archives(index, folder, payloads)
