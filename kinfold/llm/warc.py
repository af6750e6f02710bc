"""WARC archives: a writer, a normaliser for monolithic gzip files, and an indexed reader.

``write_archives`` writes each partition's rows as WARC/1.1 records into whole-file gzip
streams, the form that can only be read from its start. ``normalise`` inflates such a stream once,
piece by piece, rewrites every record as a gzip member of its own and writes a sidecar
index (offset, length, record id, type) beside it. ``read_archives`` reads records by that index.

Files go to the shared folder under names of one attempt each; the manifest of a finished stage, not
a listing, says which files count, so repeated or lost attempts leave nothing that is read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

_MANIFEST = pa.schema([("archive", pa.string()), ("index", pa.string()), ("records", pa.int64())])
_MANIFEST_DDL = "archive string, index string, records long"
_RECORD = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])
_RECORD_DDL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
_GZIP = 16 + zlib.MAX_WBITS
_CHUNK = 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    number = record_id.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _header_text(value: str) -> str:
    """A header value on one line: control characters and % before hex digits are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def record(page_id: int | None, url: str | None, payload: bytes | None, length: int, digest: str, refers_to: tuple | None, date: str) -> bytes:
    """One WARC record; without a payload a revisit of the page in ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_text(url)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_record_id(refers_to[0])}", f"WARC-Profile: {_PROFILE}"]
    block = http + (payload or b"")
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers_of(head: bytes) -> dict[str, str]:
    """Names (lower-case) and values of a header block after its first line."""
    found = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        found[name.strip().lower()] = value.strip()
    return found


class Inflater:
    """The bytes of a gzip file of one or many members, as they are asked for."""

    def __init__(self, source) -> None:
        self.source, self.buffer, self.z = source, bytearray(), zlib.decompressobj(_GZIP)

    def _more(self) -> bool:
        while True:
            data = self.z.unconsumed_tail or (self.z.unused_data if self.z.eof else b"") or self.source.read(_CHUNK)
            if self.z.eof:
                if not data:
                    return False
                self.z = zlib.decompressobj(_GZIP)
            elif not data:
                raise EOFError("a gzip stream ends early")
            if out := self.z.decompress(data, _CHUNK):
                self.buffer += out
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with ``mark``; None at the end of the file."""
        start = 0
        while (at := self.buffer.find(mark, start)) < 0:
            start = max(0, len(self.buffer) - len(mark) + 1)
            if not self._more():
                if self.buffer.strip():
                    raise EOFError("a record's header ends early")
                return None
        out = bytes(self.buffer[: at + len(mark)])
        del self.buffer[: at + len(mark)]
        return out

    def pieces(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes."""
        while size:
            if not self.buffer and not self._more():
                raise EOFError("a record ends early")
            out = bytes(self.buffer[:size])
            del self.buffer[: len(out)]
            size -= len(out)
            yield out


def normalise(source, sink, level: int) -> Iterator[dict]:
    """Rewrite a gzip WARC stream, one member for each record; yield the index entries."""
    inflater, at = Inflater(source), 0
    while (head := inflater.until(b"\r\n\r\n")) is not None:
        fields = headers_of(head.strip())
        z, size = zlib.compressobj(level, zlib.DEFLATED, _GZIP), 0
        for piece in (head.lstrip(b"\r\n"), *()):
            size += sink.write(z.compress(piece)) or 0
        for piece in inflater.pieces(int(fields["content-length"]) + 4):
            size += sink.write(z.compress(piece)) or 0
        size += sink.write(z.flush()) or 0
        yield {"offset": at, "length": size, "id": fields["warc-record-id"], "type": fields["warc-type"]}
        at += size


class _Counting:
    """A sink whose write() says how much it wrote."""

    def __init__(self, sink) -> None:
        self.sink = sink

    def write(self, data: bytes) -> int:
        if data:
            self.sink.write(data)
        return len(data)


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    return fs, path


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, level: int = 1, roll: int = 256 << 20, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write ``pages`` (page_id, url, html) as whole-file gzip archives of about ``roll`` bytes before compression; the manifest.

    A null html is an empty payload. Of pages with equal payloads of at least
    ``min_revisit_bytes`` the one with the largest page_id is a response, the others revisit it; null
    ids count as the smallest. Rows that repeat a response's id and payload are responses too. A null url
    has no target line. Other columns are not read; an empty table gives an empty manifest.
    """
    common.tune(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("html"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("html")))
    keepers = rows.where(F.octet_length("html") >= min_revisit_bytes).groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("copies")).where("copies > 1").select(F.col("digest").alias("d"), "keeper")
    tagged = rows.join(keepers, F.col("digest") == F.col("d"), "left")
    revisit = F.col("d").isNotNull() & ~common.same(F.col("page_id"), F.col("keeper"))
    tagged = tagged.select("page_id", "url", "digest", F.octet_length("html").cast("long").alias("length"), "keeper", revisit.alias("revisit"), F.when(~revisit, F.col("html")).alias("payload"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open(f"{folder}/raw")
        sink, count, size, name, z = None, 0, 0, "", None
        for columns in common.columns_of(batches, "page_id", "url", "digest", "length", "keeper", "revisit", "payload"):
            for page_id, url, digest, length, keeper, again, payload in zip(*columns, strict=True):
                if sink is None:
                    name, count, size = f"{path}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink, z = fs.open_output_stream(name, compression=None), zlib.compressobj(level, zlib.DEFLATED, _GZIP)
                data = record(page_id, url, payload, length, base64.b32encode(digest).decode(), (keeper,) if again else None, date)
                sink.write(z.compress(data))
                count, size = count + 1, size + len(data)
                if size >= roll:
                    sink.write(z.flush())
                    sink.close()
                    sink = None
                    yield common.batch_of(_MANIFEST, [name], [None], [count])
        if sink is not None:
            sink.write(z.flush())
            sink.close()
            yield common.batch_of(_MANIFEST, [name], [None], [count])

    return common.saved(tagged.mapInArrow(write, _MANIFEST_DDL), "warc-manifest")


def _spread(manifest: DataFrame) -> DataFrame:
    return manifest.repartition(max(1, min(50_000, manifest.count())))


def normalise_archives(manifest: DataFrame, folder: str, level: int = 4) -> DataFrame:
    """The manifest of normalised archives and their sidecar indexes; one task inflates an archive once.

    ``manifest`` has an ``archive`` column with paths, none of them null; a path that is repeated is normalised
    again, into a file of its own. Archives without records give empty ones, an empty manifest an empty one; a stream
    that ends early is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open(f"{folder}/normal")
        for (archives,) in common.columns_of(batches, "archive"):
            for archive in archives:
                name = f"{path}/{uuid.uuid4().hex}"
                count = 0
                with fs.open_input_stream(archive, compression=None) as source, fs.open_output_stream(f"{name}.warc.gz", compression=None) as sink, fs.open_output_stream(f"{name}.idx", compression=None) as index:
                    for entry in normalise(source, _Counting(sink), level):
                        index.write(json.dumps(entry).encode() + b"\n")
                        count += 1
                yield common.batch_of(_MANIFEST, [f"{name}.warc.gz"], [f"{name}.idx"], [count])

    return common.saved(_spread(manifest).mapInArrow(run, _MANIFEST_DDL), "warc-manifest")


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """One row per record of normalised archives; payload digests of responses are recomputed and checked.

    Records are found by the sidecar index alone. A page without an id, url or html has nulls or an empty payload, as
    written; repeated archives give their records again; an empty manifest gives no rows; a payload that isn't what
    its header says is an error.
    """

    def lines(stream) -> Iterator[bytes]:
        rest = b""
        while data := stream.read(_CHUNK):
            *whole, rest = (rest + data).split(b"\n")
            yield from whole

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(folder)
        for archives, indexes in common.columns_of(batches, "archive", "index"):
            for archive, index in zip(archives, indexes, strict=True):
                out: list[tuple] = []
                held = 0
                with fs.open_input_file(archive) as source, fs.open_input_stream(index, compression=None) as entries:
                    for entry in map(json.loads, lines(entries)):
                        source.seek(entry["offset"])
                        out.append(_parsed(zlib.decompress(source.read(entry["length"]), _GZIP), payloads))
                        held += len(out[-1][-1] or b"")
                        if len(out) >= common.BATCH_ROWS or held >= common.BATCH_BYTES:
                            yield common.batch_of(_RECORD, *zip(*out, strict=True))
                            out, held = [], 0
                if out:
                    yield common.batch_of(_RECORD, *zip(*out, strict=True))

    return _spread(manifest).mapInArrow(run, _RECORD_DDL)


def _parsed(data: bytes, payloads: bool) -> tuple:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = headers_of(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    length = int(headers_of(http)["content-length"])
    if fields["warc-type"] == "response" and (len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} isn't what its header says")
    refers = fields.get("warc-refers-to")
    return _page_id(fields["warc-record-id"]), length, digest, fields["warc-type"], None if refers is None else _page_id(refers), fields.get("warc-target-uri"), payload if payloads else None


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages to archives and back. Nulls, ties, repeats and empty tables: see ``write_archives``."""
    folder = common.scratch(spark, "warc")
    raw = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    normal = normalise_archives(raw, folder)
    common.remove(spark, f"{folder}/raw")
    records = read_archives(normal, folder, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS hex, max(page_id) OVER (PARTITION BY b) AS keeper FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = keeper THEN NULL ELSE keeper END AS refers_to
FROM d
"""
