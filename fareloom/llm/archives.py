"""Web archives packaged as ZIP: writing them, and reading records by range without extraction.

Each task writes archives of a bounded size: a ZIP file whose stored members are a file of WARC
records, each compressed on its own, and an index with a line per record (its offset and
length in that member). Reading starts at the end of the file: the end record, or the ZIP64
one it points to, leads to the central directory, that to the local headers, and those to where
the stored members begin. The index is read from its range in pieces, and its lines become rows
that Spark spreads over tasks; a task reads just its records' ranges.

Files are opened by their URI (``file``, ``hdfs``, ``s3`` ...) through Arrow, on the executors. A
task writes under a name that no other attempt uses, and only names that finished tasks
have returned are read, so repeated attempts do no harm.

Of records whose payloads are equal and have at least ``LEAST_REVISITED`` bytes the one with the
smallest id is written as response, the others as revisits that refer to it.

Defined results: a NULL payload or URL counts as empty. A row without an id gets a record without
a number; it can revisit but not be referred to. Rows that repeat an id are records of their own;
equal ones that have the smallest id are all responses. Control characters and blanks in a URL
are percent-encoded. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.llm.frames import batch_of, slices
from fareloom.llm.tables import Scratch

LEAST_REVISITED = 100
ARCHIVE_BYTES = 32 << 20
#: Records that one row of the read plan covers, and how far apart ranges read together may lie.
SLICE_BYTES = 4 << 20
RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"

_RECORD_URN = "urn:record:"
_END, _END64, _LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_ENTRY, _LOCAL = b"PK\x01\x02", b"PK\x03\x04"
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF

WRITTEN = T.StructType([T.StructField("path", T.StringType()), T.StructField("records", T.LongType())])
PLACED = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("offsets", T.ArrayType(T.LongType())),
        T.StructField("lengths", T.ArrayType(T.LongType())),
    ]
)
RECORD = T.StructType(
    [
        T.StructField("record_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def opened_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system a URI names and the path in it; a plain path is a local one."""
    if not urlsplit(uri).scheme:
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), urlsplit(uri).path
    return fs.FileSystem.from_uri(uri)


# Records


def clean_url(url: str) -> str:
    """A URL that can stand in a header line and an index line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda found: f"%{ord(found[0]):02X}", url)


def http_block(payload: bytes | None, size: int) -> bytes:
    """The HTTP response kept in a record; without a payload only its head."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    return head.encode() + (payload or b"")


def warc_record(key: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, not compressed."""
    kind = "response" if refers_to is None else "revisit"
    block = http_block(payload if refers_to is None else None, len(payload))
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{_RECORD_URN}{'' if key is None else key}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{_RECORD_URN}{refers_to}>",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def fields_of(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode().split("\r\n")[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def parse_record(raw: bytes) -> dict[str, object]:
    """A record's fields and payload; a payload that does not have its SHA-256 digest is an error."""
    head, rest = raw.split(b"\r\n\r\n", 1)
    if not head.startswith(b"WARC/"):
        raise ValueError("no WARC record where the index says")
    told = fields_of(head)
    block = rest[: int(told["content-length"])]
    kind, digest = told["warc-type"], told.get("warc-payload-digest", "")
    http = {}
    payload = block
    if told.get("content-type", "").startswith("application/http"):
        http_head, _, payload = block.partition(b"\r\n\r\n")
        http = fields_of(http_head)
    if kind == "revisit":
        size = int(http["content-length"]) if "content-length" in http else None
        found = {"payload_digest": digest.removeprefix("sha256:"), "payload_bytes": size, "payload": None}
    else:
        own = hashlib.sha256(payload).hexdigest()
        if digest.startswith("sha256:") and digest != f"sha256:{own}":
            raise ValueError(f"the payload of {told.get('warc-record-id')} does not have its digest")
        found = {"payload_digest": own, "payload_bytes": len(payload), "payload": payload}

    def number(name: str) -> int | None:
        matched = re.fullmatch(f"<{_RECORD_URN}(-?[0-9]+)>", told.get(name, ""))
        return int(matched[1]) if matched else None

    return found | {
        "record_id": number("warc-record-id"),
        "url": told.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": number("warc-refers-to"),
    }


# Writing


class _Archive:
    """A ZIP file being written: records go out as they come, the index follows them."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}.wacz"
        system, path = opened_fs(self.uri)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.stream = system.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.records = self.zip.open(RECORDS, "w", force_zip64=True)
        self.index: list[str] = []
        self.size = 0

    def add(self, url: str, record: bytes) -> None:
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        packed = packer.compress(record) + packer.flush()
        self.records.write(packed)
        place = json.dumps({"offset": self.size, "length": len(packed), "filename": RECORDS})
        self.index.append(f"{url} 19700101000000 {place}\n")
        self.size += len(packed)

    def close(self) -> tuple[str, int]:
        self.records.close()
        self.zip.writestr(INDEX, "".join(self.index))
        self.zip.close()
        self.stream.close()
        return self.uri, len(self.index)


def _writer(folder: str, archive_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in batches:
            for part in slices(batch, "payload"):
                columns = [part.column(c).to_pylist() for c in ("key", "url", "payload", "digest", "refers_to")]
                for key, url, payload, digest, refers_to in zip(*columns, strict=True):
                    archive = archive or _Archive(folder)
                    archive.add(clean_url(url), warc_record(key, clean_url(url), payload, digest, refers_to))
                    if archive.size >= archive_bytes:
                        path, n = archive.close()
                        archive = None
                        yield batch_of({"path": [path], "records": [n]}, WRITTEN)
        if archive:
            path, n = archive.close()
            yield batch_of({"path": [path], "records": [n]}, WRITTEN)

    return run


def write_archives(
    df: DataFrame,
    scratch: Scratch,
    folder: str | None = None,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Writes a record per row into archives; a row (``path``, ``records``) per archive."""
    raw = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = df.select(
        F.col(key).cast("long").alias("key"),
        F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"),
        raw.alias("payload"),
        F.sha2(raw, 256).alias("digest"),
    )
    # Digests and ids only: the first id of each digest that occurs again.
    long = rows.where(F.octet_length("payload") >= LEAST_REVISITED).select("key", "digest")
    keys = scratch.write(long, "digests")
    firsts = keys.groupBy("digest").agg(F.min("key").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    firsts = scratch.write(firsts.where("n > 1 AND refers_to IS NOT NULL").select("digest", "refers_to"), "firsts")
    later = ~F.col("key").eqNullSafe(F.col("refers_to"))
    revisits = keys.join(firsts, "digest").where(later).distinct()
    revisits = scratch.write(revisits.withColumnsRenamed({"key": "_key", "digest": "_digest"}), "revisits")
    same = (F.col("digest") == F.col("_digest")) & F.col("key").eqNullSafe(F.col("_key"))
    marked = rows.join(revisits, same, "left").drop("_key", "_digest")
    written = marked.mapInArrow(_writer(folder or scratch.path("archives"), archive_bytes), WRITTEN)
    return scratch.write(written, "written")


# Reading


@dataclass(frozen=True)
class Member:
    """A member of a ZIP file as its central directory tells it."""

    name: str
    method: int
    size: int
    header: int


def _zip64_extra(extra: bytes, values: list[int]) -> list[int]:
    """Sizes and offset with those that did not fit replaced from the extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            wide = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            return [next(wide) if value == _FULL32 else value for value in values]
        at += 4 + size
    return values


def central_directory(file: pa.NativeFile) -> list[Member]:
    """The members, found from the end of the file."""
    size = file.size()
    tail_at = max(0, size - (1 << 16) - 22 - 20)
    tail = file.read_at(size - tail_at, tail_at)
    end = tail.rfind(_END)
    # A comment may hold the same bytes; the true record's comment ends with the file.
    while end >= 0 and tail[end + 20 : end + 22] != (max(0, len(tail) - end - 22) & _FULL16).to_bytes(2, "little"):
        end = tail.rfind(_END, 0, end)
    if end < 0:
        raise ValueError("no end of a central directory: not a ZIP file")
    _, _, _, entries, length, start, _ = struct.unpack_from("<4H2IH", tail, end + 4)
    locator = end - 20
    if locator >= 0 and tail[locator : locator + 4] == _LOCATOR64:
        at = struct.unpack_from("<Q", tail, locator + 8)[0]
        wide = file.read_at(56, at)
        if wide[:4] != _END64:
            raise ValueError("the ZIP64 end record is not where its locator says")
        entries, length, start = struct.unpack_from("<3Q", wide, 32)
    directory = file.read_at(length, start)
    members, at = [], 0
    for _ in range(entries):
        if directory[at : at + 4] != _ENTRY:
            raise ValueError("a damaged central directory")
        method = struct.unpack_from("<H", directory, at + 10)[0]
        packed, plain, name_size, extra_size, note_size = struct.unpack_from("<2I3H", directory, at + 20)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + name_size].decode()
        extra = directory[at + 46 + name_size : at + 46 + name_size + extra_size]
        plain, packed, header = _zip64_extra(extra, [plain, packed, header])
        members.append(Member(name, method, packed, header))
        at += 46 + name_size + extra_size + note_size
    return members


def member_start(file: pa.NativeFile, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method != zipfile.ZIP_STORED:
        raise ValueError(f"{member.name} is compressed; only stored members are read by range")
    head = file.read_at(30, member.header)
    if head[:4] != _LOCAL:
        raise ValueError(f"no local header of {member.name} where the directory says")
    name_size, extra_size = struct.unpack_from("<2H", head, 26)
    return member.header + 30 + name_size + extra_size


def index_lines(file: pa.NativeFile, member: Member, piece: int = 1 << 20) -> Iterator[dict]:
    """The index's entries, read piece by piece from the member's range."""
    start, at, rest = member_start(file, member), 0, b""
    while at < member.size:
        got = file.read_at(min(piece, member.size - at), start + at)
        at += len(got)
        *lines, rest = (rest + got).split(b"\n")
        yield from (json.loads(line[line.index(b" {") :]) for line in lines if line)
    if rest:
        yield json.loads(rest[rest.index(b" {") :])


def _planner(slice_bytes: int):
    """Rows of places to read, a bounded number of bytes each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (path for batch in batches for path in batch.column("path").to_pylist()):
            system, place = opened_fs(path)
            with system.open_input_file(place) as file:
                members = {member.name: member for member in central_directory(file)}
                begins: dict[str, int] = {}
                held: dict[str, tuple[list[int], list[int]]] = {}
                for index in [m for name, m in members.items() if name.startswith("indexes/") and name.endswith((".cdx", ".cdxj"))]:
                    for line in index_lines(file, index):
                        name = line["filename"] if line["filename"] in members else f"archive/{line['filename']}"
                        if name not in begins:
                            begins[name] = member_start(file, members[name])
                        offsets, lengths = held.setdefault(name, ([], []))
                        offsets.append(int(line["offset"]))
                        lengths.append(int(line["length"]))
                        if offsets[-1] + lengths[-1] - offsets[0] >= slice_bytes:
                            yield batch_of({"path": [path], "start": [begins[name]], "offsets": [offsets], "lengths": [lengths]}, PLACED)
                            del held[name]
                for name, (offsets, lengths) in held.items():
                    yield batch_of({"path": [path], "start": [begins[name]], "offsets": [offsets], "lengths": [lengths]}, PLACED)

    return run


def _range_reader(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start, offsets, lengths in zip(*(batch.column(c).to_pylist() for c in PLACED.names), strict=True):
            system, place = opened_fs(path)
            out: dict[str, list] = {name: [] for name in RECORD.names}
            with system.open_input_file(place) as file:
                for offset, length in zip(offsets, lengths, strict=True):
                    found = parse_record(zlib.decompress(file.read_at(length, start + offset), 31))
                    for name in RECORD.names:
                        out[name].append(found[name])
            yield batch_of(out, RECORD)


def read_archives(paths: DataFrame, scratch: Scratch, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """All records of the archives named in the column ``path``, each read by its range."""
    spark = paths.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    archives = scratch.write(paths.select("path"), "paths")
    # Rows are few and small, work is not: the numbers of tasks are given, not left to the rows' size.
    plan = archives.repartition(max(1, min(least, archives.count()))).mapInArrow(_planner(slice_bytes), PLACED)
    plan = scratch.write(plan, "ranges")
    return plan.repartition(max(least, plan.count() // 4)).mapInArrow(_range_reader, RECORD)
