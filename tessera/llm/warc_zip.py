"""WARC records in ZIP packages: write, read directories, range-read records.

A package is a ZIP archive of stored members: ``archive/data.warc.gz`` (the records, each a
gzip member of its own), ``indexes/index.txt`` (a line per record: its offset and length in
the data member) and ``datapackage.json``. Each task streams its rows into packages of bounded size; only
packages that the returned frame lists count, so a retried task leaves nothing half-read.

Reading parses the end record, the ZIP64 end record where a field is full, and the central
directory, finds the stored members by their local headers, reads the index, and then
range-reads records through the data member's place in the package. Nothing is extracted,
and a task reads about a megabyte of packed records at a time.

Of records with equal payloads (by SHA-1; at least ``min_revisit`` bytes) the one with the
largest page id is a response, the others are revisits that refer to it; rows that share
that largest id are all responses, and so are rows of a payload without any id. NULL
bodies are empty payloads, NULL ids and urls stay NULL, repeated rows are records of their
own, an empty table gives no packages, extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import struct
import urllib.parse
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bound_batches, kept, lean, shared_path, shuffle_partitions, text_slices
from tessera.llm.token_files import filesystem

DATA, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.txt", "datapackage.json"
GZIP = 31                        # zlib's window setting for gzip members
PACKAGE_BYTES = 512 << 20
READ_BYTES = 1 << 20
RECORD_URN = "urn:tessera:page:"
# The formats' signatures, layouts and names.
END_RECORD, END_64_LOCATOR, END_64_RECORD = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06"
ENTRY, LOCAL = b"PK\x01\x02", b"PK\x03\x04"
FULL_16, FULL_32 = 0xFFFF, 0xFFFFFFFF
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header_url(url: str | None) -> str:
    """A url as a header value: controls, spaces and other alphabets percent-encoded."""
    return urllib.parse.quote(url or "", safe="!#$%&'()*+,/:;=?@[]~|^`{}\\\"<>")


def record(page_id, url: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """One WARC record; a revisit (``refers_to`` given) holds the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
             f"WARC-Record-ID: <{RECORD_URN}{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {header_url(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{payload_digest(payload)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: <{RECORD_URN}{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields, block) of one record."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"WARC/"):
        raise ValueError("no WARC record")
    fields = fields_of(head)
    return fields, rest[:int(fields["content-length"])]


def page_of(raw: bytes) -> tuple[int | None, int, str, str, int | None]:
    """(page id, payload bytes, digest, type, refers to) of one record, its payload checked."""
    fields, block = parse_record(raw)
    number = lambda urn: int(x) if (x := urn.strip("<>").removeprefix(RECORD_URN)) else None
    head, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "revisit":
        return number(fields["warc-record-id"]), int(fields_of(head)["content-length"]), digest, "revisit", number(fields["warc-refers-to"])
    if payload_digest(payload) != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    return number(fields["warc-record-id"]), len(payload), digest, "response", None


class PackageWriter:
    def __init__(self, path: str):
        fs, place = filesystem(path)
        fs.create_dir(os.path.dirname(place), recursive=True)
        self.path, self.stream = path, fs.open_output_stream(place)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.at, self.index = 0, []

    def add(self, raw: bytes) -> None:
        packer = zlib.compressobj(5, zlib.DEFLATED, GZIP)
        raw = packer.compress(raw) + packer.flush()
        self.data.write(raw)
        self.index.append(f"{self.at} {len(raw)}\n")
        self.at += len(raw)

    def close(self) -> tuple[str, int]:
        self.data.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "".join(self.index))
        self.zip.writestr(zipfile.ZipInfo(PACKAGE), json.dumps({"resources": [DATA, INDEX], "records": len(self.index)}))
        self.zip.close()
        self.stream.close()
        return self.path, len(self.index)


class Package:
    """Members of a ZIP archive, found by range reads: name -> (start of its bytes, length)."""

    def __init__(self, path: str):
        fs, place = filesystem(path)
        self.file = fs.open_input_file(place)
        self.members = {name: (offset, size) for name, offset, size in self.directory()}

    def read(self, start: int, size: int) -> bytes:
        return self.file.read_at(size, start)

    def directory(self):
        size = self.file.size()
        tail = self.read(max(0, size - 22 - FULL_16), min(size, 22 + FULL_16))
        at = tail.rfind(END_RECORD)
        if at < 0:
            raise ValueError("no ZIP archive")
        entries, length, start = struct.unpack_from("<HII", tail, at + 10)
        if entries == FULL_16 or FULL_32 in (length, start):
            found = at - 20
            if tail[max(0, found):found + 4] != END_64_LOCATOR:
                raise ValueError("ZIP64 locator is missing")
            record_at = struct.unpack_from("<Q", tail, found + 8)[0]
            raw = self.read(record_at, 56)
            if raw[:4] != END_64_RECORD:
                raise ValueError("ZIP64 end record is missing")
            entries, length, start = struct.unpack_from("<QQQ", raw, 32)
        raw, at = self.read(start, length), 0
        for _ in range(entries):
            if raw[at:at + 4] != ENTRY:
                raise ValueError("broken central directory")
            flags, method = struct.unpack_from("<HH", raw, at + 8)
            packed, plain, name_len, extra_len, note_len = struct.unpack_from("<IIHHH", raw, at + 20)
            offset = struct.unpack_from("<I", raw, at + 42)[0]
            name = raw[at + 46:at + 46 + name_len].decode("utf-8" if flags & 0x800 else "cp437")
            extra = raw[at + 46 + name_len:at + 46 + name_len + extra_len]
            plain, packed, offset = wide_fields(extra, plain, packed, offset)
            at += 46 + name_len + extra_len + note_len
            if method or flags & 1:
                continue  # only stored, plain members can be read in place
            yield name, offset, plain

    def place(self, name: str) -> tuple[int, int]:
        """Where a member's bytes start, past its local header, and their number."""
        offset, size = self.members[name]
        head = self.read(offset, 30)
        if head[:4] != LOCAL:
            raise ValueError("broken local header")
        return offset + 30 + sum(struct.unpack_from("<HH", head, 26)), size


def wide_fields(extra: bytes, *fields: int) -> tuple[int, ...]:
    """The directory's 32-bit fields, full ones taken from the ZIP64 extra field in order."""
    at, wide = 0, b""
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            wide = extra[at + 4:at + 4 + size]
        at += 4 + size
    out, at = [], 0
    for value in fields:
        if value == FULL_32:
            value = struct.unpack_from("<Q", wide, at)[0]
            at += 8
        out.append(value)
    return tuple(out)


def write_rows(folder: str, date: str, package_bytes: int):
    def run(batches):
        from pyspark import TaskContext
        part, done, writer = TaskContext.get().partitionId(), [], None
        for batch in batches:
            ids, urls, refers = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("id", "url", "refers_to"))
            for first, bodies in text_slices(batch, "body"):
                for i, body in enumerate(bodies, first):
                    if writer is not None and writer.at >= package_bytes:
                        done.append(writer.close())
                        writer = None
                    if writer is None:
                        writer = PackageWriter(f"{folder}/part-{part:06d}-{len(done):04d}-{uuid.uuid4().hex}.zip")
                    writer.add(record(ids[i], urls[i], body, refers[i], date))
        if writer is not None:
            done.append(writer.close())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()),
                                          pa.array([d[1] for d in done], pa.int64())], names=["path", "records"])
    return run


def write_packages(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                   body_col: str = "html", min_revisit: int = 0, date: str = "2026-01-01T00:00:00Z",
                   package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write the packages; one row per package: path, records."""
    bound_batches(pages.sparkSession)
    folder = folder or shared_path(pages.sparkSession, "warc")
    body = F.coalesce(F.col(body_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumn("digest", F.unhex(F.sha1(F.col("body").cast("binary"))))
    # One row per payload that occurs more than once, counted before it is shuffled; held, so
    # that both sides of the join are shuffles and Spark can split a payload of very many pages.
    holders = kept(pages.select(F.col(id_col).cast("long").alias("id"), body.alias("body"))
               .select("id", F.unhex(F.sha1(F.col("body").cast("binary"))).alias("digest"), F.octet_length("body").alias("size"))
               .filter(F.col("size") >= min_revisit).groupBy("digest")
               .agg(F.max("id").alias("holder"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    met = rows.join(holders, "digest", "left").select(
        "id", "url", "body", F.when(~F.col("id").eqNullSafe(F.col("holder")), F.col("holder")).alias("refers_to"))
    written = met.mapInArrow(lean(write_rows(folder, date, package_bytes)), "path string, records long")
    # The one job that writes; one short row per package.
    return pages.sparkSession.createDataFrame(written.collect(), "path string, records long")


def index_rows(batches):
    """Directory and index of each package, as runs of records to read together."""
    for batch in batches:
        for path in batch.column(0).to_pylist():
            package = Package(path)
            base, _ = package.place(DATA)
            start, size = package.place(INDEX)
            runs, offsets, lengths = [], [], []
            for line in package.read(start, size).splitlines():
                offset, length = map(int, line.split())
                if offsets and base + offset + length - offsets[0] > READ_BYTES:
                    runs.append((offsets, lengths))
                    offsets, lengths = [], []
                offsets.append(base + offset)
                lengths.append(length)
            if offsets:
                runs.append((offsets, lengths))
            package.file.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * len(runs), pa.string()), pa.array([r[0] for r in runs], pa.list_(pa.int64())),
                 pa.array([r[1] for r in runs], pa.list_(pa.int64()))], names=["path", "offsets", "lengths"])


def read_rows(id_col: str):
    def run(batches):
        for batch in batches:
            for path, offsets, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                fs, place = filesystem(path)
                with fs.open_input_file(place) as file:
                    raw = file.read_at(offsets[-1] + lengths[-1] - offsets[0], offsets[0])
                got = [page_of(zlib.decompress(raw[a - offsets[0]:a - offsets[0] + n], GZIP)) for a, n in zip(offsets, lengths)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*got), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                    names=[id_col, "payload_bytes", "payload_digest", "record_type", "refers_to"])
    return run


def read_packages(packages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Per record: id, payload_bytes, payload_digest, record_type, refers_to."""
    # The rows are few and short but stand for much data: a stated number of parts is not merged.
    parts = shuffle_partitions(packages.sparkSession)
    runs = packages.select("path").repartition(parts, F.col("path")).mapInArrow(
        lean(index_rows), "path string, offsets array<long>, lengths array<long>")
    return runs.repartition(parts, F.col("path"), F.col("offsets")[0]).mapInArrow(
        lean(read_rows(id_col)), f"{id_col} long, payload_bytes long, payload_digest string, record_type string, refers_to long")
