"""WARC archives: write, normalise to one gzip member per record, index and read back.

Archives written as one gzip stream per file can only be read from the start. The
normaliser inflates such a stream once, in chunks, rewrites every record as a gzip member
of its own and leaves a sidecar index of offsets, by which single records can be read.
Tasks write files with names of their own; only files listed in a stored manifest count,
so what a lost or repeated task leaves behind is never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmart.llm.common import discard, saved
from trailmart.session import shared_dir

#: Payloads at least this long are written once; repetitions refer to it.
REVISIT_BYTES = 1000
#: Uncompressed bytes after which the next archive file begins.
FILE_BYTES = 64 << 20
CHUNK = 1 << 20
ROWS_OUT = 64
DATE = "1970-01-01T00:00:00Z"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_ID = -(1 << 63)


def opened(uri: str):
    """File system and path of a URI that executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def record_id(row: int, page_id: int | None) -> str:
    """A record id holding the row number and the page id; the top bit marks a null page."""
    high = (row & ((1 << 63) - 1)) | ((page_id is None) << 63)
    return f"<urn:uuid:{uuid.UUID(int=high << 64 | (page_id or 0) & ((1 << 64) - 1))}>"


def page_of(identifier: str) -> int | None:
    value = uuid.UUID(identifier.strip("<>").removeprefix("urn:uuid:")).int
    if value >> 127:
        return None
    low = value & ((1 << 64) - 1)
    return low - (1 << 64) if low >> 63 else low


def record(row: int, page_id, url, payload: bytes, digest: str, leader, leader_page) -> bytes:
    """One response record, or a revisit of ``leader`` without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = leader is not None
    block = http if revisit else http + payload
    target = quote(url, safe="!#$&'()*+,/:;=?@[]~%") if url else f"urn:page:{page_id}"
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(row, page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
    ]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(leader, leader_page))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + END


RECORD_COLUMNS = ("row", "page_id", "url", "payload", "digest", "leader", "leader_page")


def manifest_rows(rows: list[tuple[str, int]]) -> pa.RecordBatch:
    paths, records = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(records, pa.int64())], names=["path", "records"])


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write (row, page_id, url, payload, digest, leader, leader_page) as gzip streams; a manifest.

    Rows come as Arrow, where an id beside nulls stays a whole number.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = opened(folder)
        fs.create_dir(base, recursive=True)
        stream = packer = None
        name, count, size = "", 0, 0

        def close():
            stream.write(packer.flush())
            stream.close()
            return manifest_rows([(f"{folder}/{name}", count)])

        for batch in batches:
            for r in batch.to_pylist():
                if stream is None:
                    name, count, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    stream = fs.open_output_stream(f"{base}/{name}", compression=None)
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = record(*(r[column] for column in RECORD_COLUMNS))
                stream.write(packer.compress(data))
                count, size = count + 1, size + len(data)
                if size >= FILE_BYTES:
                    yield close()
                    stream = None
        if stream is not None:
            yield close()

    return rows.select(*RECORD_COLUMNS).mapInArrow(write, "path string, records long")


def inflated(stream) -> Iterator[bytes]:
    """Contents of a gzip file of one or several members, in chunks."""
    unpack = zlib.decompressobj(31)
    while chunk := stream.read(CHUNK):
        while chunk:
            data = unpack.decompress(chunk, CHUNK)
            if data:
                yield data
            chunk = unpack.unconsumed_tail
            if unpack.eof:
                chunk = unpack.unused_data
                unpack = zlib.decompressobj(31)
    if tail := unpack.flush():
        yield tail


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}


def records_of(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and whole bytes of each record of an inflated stream."""
    buffer, need, fields = bytearray(), 0, None
    for chunk in chunks:
        buffer += chunk
        while True:
            if fields is None:
                end = buffer.find(END)
                if end < 0:
                    break
                fields = fields_of(bytes(buffer[:end]))
                need = end + 4 + int(fields["content-length"]) + 4
            if len(buffer) < need:
                break
            data = bytes(buffer[:need])
            if not data.startswith(b"WARC/") or not data.endswith(END):
                raise ValueError("not a WARC record")
            del buffer[:need]
            yield fields, data
            fields = None
    if buffer:
        raise ValueError("the archive ends within a record")


def normalise(manifest: DataFrame, folder: str, files: int) -> DataFrame:
    """Rewrite each archive with one member per record and an index; the new manifest."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = opened(folder)
        target.create_dir(base, recursive=True)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                source, location = opened(path)
                name, offset, lines = f"{uuid.uuid4().hex}.warc.gz", 0, []
                with source.open_input_stream(location, compression=None) as read, target.open_output_stream(f"{base}/{name}", compression=None) as out:
                    for fields, data in records_of(inflated(read)):
                        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = packer.compress(data) + packer.flush()
                        out.write(member)
                        lines.append(f"{offset} {len(member)} {fields['warc-type']} {fields['warc-record-id']}\n")
                        offset += len(member)
                with target.open_output_stream(f"{base}/{name}.idx", compression=None) as index:
                    index.write("".join(lines).encode())
                yield manifest_rows([(f"{folder}/{name}", len(lines))])

    return manifest.repartition(max(1, files)).mapInArrow(rewrite, "path string, records long")


READ_SCHEMA = (
    "page_id long, record_id string, record_type string, refers_to long, target_uri string, "
    "declared_digest string, declared_bytes long, payload binary"
)


def read_records(manifest: DataFrame, files: int) -> DataFrame:
    """Every record of normalised archives, each fetched by its entry in the index.

    A revisit has no payload; length and digest of the page are what its headers declare.
    A payload that does not have the declared digest is an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [part.split() for part in READ_SCHEMA.split(", ")]
        types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        rows = []

        def batch_of(rows):
            columns = zip(*rows, strict=True)
            arrays = [pa.array(column, types[kind]) for column, (_, kind) in zip(columns, fields, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])

        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, location = opened(path)
                with fs.open_input_stream(f"{location}.idx", compression=None) as stream:
                    index = stream.read().decode().splitlines()
                with fs.open_input_file(location) as archive:
                    for line in index:
                        offset, length, kind, identifier = line.split(" ")
                        archive.seek(int(offset))
                        data = zlib.decompress(archive.read(int(length)), 31)
                        rows.append(parsed(data, kind, identifier))
                        if len(rows) >= ROWS_OUT:
                            yield batch_of(rows)
                            rows = []
        if rows:
            yield batch_of(rows)

    def parsed(data: bytes, kind: str, identifier: str) -> tuple:
        head, _, rest = data.partition(END)
        fields = fields_of(head)
        if fields["warc-type"] != kind or fields["warc-record-id"] != identifier:
            raise ValueError("the index does not fit the archive")
        http, _, payload = rest[: int(fields["content-length"])].partition(END)
        digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
        response = kind == "response"
        if response and hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload of {identifier} is damaged")
        refers = None if response else page_of(fields["warc-refers-to"])
        size = int(fields_of(http)["content-length"])
        return page_of(identifier), identifier, kind, refers, fields["warc-target-uri"], digest, size, payload if response else None

    return manifest.repartition(max(1, files)).mapInArrow(read, READ_SCHEMA)


def archive_pages(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Records of normalised archives of ``pages`` (page_id, url, html), read back.

    A null html is an empty payload, a null url becomes a URN of the page, null page ids
    are smaller than any other. Of equal payloads of ``revisit_bytes`` or more the row with
    the largest page_id, of repeated such rows one, is the response the others refer to.
    Other columns are not read; an empty table gives no records.
    """
    spark = pages.sparkSession
    payload = F.coalesce("html", F.lit("")).cast("binary")
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"),
        F.sha1(payload).alias("digest"), F.monotonically_increasing_id().alias("row"),
    )
    numbered, numbered_path = saved(base, "warc-pages", "zstd")
    order = F.coalesce("page_id", F.lit(LEAST_ID))
    leaders = (
        numbered.where(F.octet_length("payload") >= revisit_bytes)
        .groupBy("digest")
        .agg(F.max_by("row", order).alias("first"), F.max("page_id").alias("first_page"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    leaders, leaders_path = saved(leaders, "warc-leaders")
    other = F.col("row") != F.col("first")
    rows = numbered.join(leaders.hint("merge"), "digest", "left").select(
        "row", "page_id", "url", "payload", "digest",
        F.when(other, F.col("first")).alias("leader"), F.when(other, F.col("first_page")).alias("leader_page"),
    )
    folder = shared_dir(spark, "warc")
    raw, raw_path = saved(write_archives(rows, f"{folder}/streams"), "warc-manifest")
    files = raw.count()
    discard(spark, numbered_path, leaders_path)
    normal, _ = saved(normalise(raw, f"{folder}/records", files), "warc-manifest")
    discard(spark, f"{folder}/streams", raw_path)
    return read_records(normal, files)
