"""WARC archives as a Spark data source (operator 6).

``spark.read.format("warc")`` plans one partition for each run of files, reads a
record's headers first, tests the pushed-down header predicates on them, and inflates
a payload only if the record is wanted.  ``df.write.format("warc")`` writes each record
as a gzip member of its own whose extra field gives the member's length, so a reader can
step over it.  Files are reached through pyarrow's file systems by URI.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    WriterCommitMessage,
)

from ..session import materialize
from .common import prepare

# --- fixed values (the WARC 1.1 and gzip formats) ------------------------------
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_HEAD = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff"
# --- end of fixed values --------------------------------------------------------

SCHEMA = T.StructType([
    T.StructField("record_id", T.StringType()),
    T.StructField("record_type", T.StringType()),
    T.StructField("target_uri", T.StringType()),
    T.StructField("refers_to", T.StringType()),
    T.StructField("payload_digest", T.StringType()),
    T.StructField("payload_length", T.LongType()),
    T.StructField("payload", T.BinaryType()),
])
#: Column to header, for those on which filters are pushed down.
HEADER_OF = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}
FILE_BYTES = 64 << 20
PARTITION_BYTES = 64 << 20
CHUNK = 1 << 20
HEAD_CHUNK = 1 << 13


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path)


def bare_digest(value: str | None) -> str | None:
    return value.split(":", 1)[1] if value and ":" in value else value


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def clean(value: str) -> str:
    """A header value on one line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def member(record: bytes) -> bytes:
    """One gzip member with its own length in the extra field ``sl``."""
    c = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = c.compress(record) + c.flush()
    size = len(GZIP_HEAD) + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(record) & 0xFFFFFFFF)
    return GZIP_HEAD + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def record_bytes(row: dict, date: str) -> bytes:
    """A response or revisit with its HTTP block; a revisit leaves the payload out."""
    payload = row["payload"] or b""
    kind = row["record_type"] or "response"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (b"" if kind == "revisit" else payload)
    head = [("WARC-Type", kind), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", date), ("WARC-Target-URI", row["target_uri"])]
    if kind == "revisit":
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", row["refers_to"])]
    head += [("WARC-Payload-Digest", "sha1:" + sha1_base32(payload)), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = [VERSION] + [f"{k}: {clean(v)}".encode() for k, v in head if v is not None]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_head(data: bytes) -> dict[str, str]:
    out, last = {}, None
    for line in data.split(b"\r\n")[1:]:
        if line[:1] in (b" ", b"\t") and last:
            out[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        k, _, v = line.partition(b":")
        last = k.strip().decode("latin-1").lower()
        out.setdefault(last, v.strip().decode("utf-8", "replace"))
    return out


class _Window:
    """Random access to a file through one buffer."""

    def __init__(self, f):
        self.f, self.size, self.at, self.buf = f, f.size(), 0, b""

    def get(self, at: int, n: int) -> bytes:
        n = min(n, self.size - at)
        if n <= 0:
            return b""
        if at < self.at or at + n > self.at + len(self.buf):
            self.f.seek(at)
            self.at, self.buf = at, self.f.read(max(n, min(CHUNK, self.size - at)))
        return self.buf[at - self.at : at - self.at + n]


def _inflate(w: _Window, at: int, enough: int | None) -> tuple[bytes, int | None]:
    """The member at ``at``, or its first ``enough`` bytes; and where it ends, if seen."""
    d, out, pos = zlib.decompressobj(31), [], at
    have = 0
    while not d.eof:
        data = d.unconsumed_tail
        if not data:
            data = w.get(pos, 1 << 16)
            if not data:
                raise ValueError(f"gzip member at {at} is cut off")
            pos += len(data)
        part = d.decompress(data, 0 if enough is None else max(1, enough - have))
        out.append(part)
        have += len(part)
        if enough is not None and have >= enough:
            return b"".join(out), None
    return b"".join(out), pos - len(d.unused_data)


def _own_length(w: _Window, at: int) -> int | None:
    """Length of the member from its extra field ``sl``."""
    head = w.get(at, 24)
    if len(head) == 24 and head[3] & 4 and head[12:14] == b"sl":
        return struct.unpack("<I", head[16:20])[0] or None
    return None


def _wanted(head: dict[str, str], filters: list[tuple[str, frozenset]]) -> bool:
    return all((bare_digest(head.get(k)) if k == "warc-payload-digest" else head.get(k)) in allowed for k, allowed in filters)


def _split_http(block: bytes, head: dict[str, str]) -> tuple[int | None, bytes]:
    """Length that the HTTP headers give, and the payload."""
    if not head.get("content-type", "").startswith("application/http"):
        return None, block
    http, _, payload = block.partition(b"\r\n\r\n")
    length = parse_head(http).get("content-length", "")
    return (int(length) if length.isdigit() else None), payload


def _row(head: dict[str, str], block: bytes | None, verify: bool) -> tuple:
    kind = head.get("warc-type")
    digest, length, payload = bare_digest(head.get("warc-payload-digest")), None, None
    if block is not None:
        length, payload = _split_http(block, head)
        if kind == "revisit":
            payload = None
        else:
            length = len(payload)
            if verify and head.get("warc-payload-digest", "").startswith("sha1:") and sha1_base32(payload) != digest:
                raise ValueError(f"payload of {head.get('warc-record-id')} does not match its digest")
    return head.get("warc-record-id"), kind, head.get("warc-target-uri"), head.get("warc-refers-to"), digest, length, payload


def records(f, compressed: bool, filters: list, payloads: bool, verify: bool) -> Iterator[tuple]:
    """Rows of one archive; headers are parsed first, blocks only for wanted records."""
    w, at = _Window(f), 0
    while at < w.size:
        if compressed:
            own = _own_length(w, at)
            start, end = _inflate(w, at, HEAD_CHUNK)
            while b"\r\n\r\n" not in start and end is None:
                start, end = _inflate(w, at, 2 * len(start))
            head_end = start.index(b"\r\n\r\n") + 4
            head = parse_head(start[: head_end - 4])
            size = int(head.get("content-length", 0))
            wanted = _wanted(head, filters)
            block = None
            if wanted and payloads:
                if end is None:
                    start, end = _inflate(w, at, None)
                block = start[head_end : head_end + size]
            if end is None:
                end = at + own if own else _inflate(w, at, None)[1]
            at = end
        else:
            data = w.get(at, HEAD_CHUNK)
            skip = len(data) - len(data.lstrip(b"\r\n"))
            if skip:
                at += skip
                continue
            while b"\r\n\r\n" not in data and at + len(data) < w.size:
                data = w.get(at, 2 * len(data))
            head_end = data.index(b"\r\n\r\n") + 4
            head = parse_head(data[: head_end - 4])
            size = int(head.get("content-length", 0))
            wanted = _wanted(head, filters)
            block = w.get(at + head_end, size) if wanted and payloads else None
            at += head_end + size
        if wanted:
            yield _row(head, block, verify)


@dataclass
class Files(InputPartition):
    paths: list


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payloads = str(options.get("payloads", "true")).lower() == "true"
        self.verify = str(options.get("verify", "true")).lower() == "true"
        self.filters: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in HEADER_OF and isinstance(f, EqualTo):
                self.filters.append((HEADER_OF[name], frozenset([f.value])))
            elif name in HEADER_OF and isinstance(f, In):
                self.filters.append((HEADER_OF[name], frozenset(f.value)))
            else:
                yield f

    def partitions(self):
        """Runs of files of about equal size; a committed folder's list names its files."""
        system, path = file_system(self.path)
        info = system.get_file_info(path)
        if info.type == pafs.FileType.File:
            found = [(path, info.size)]
        else:
            found = sorted((x.path, x.size) for x in system.get_file_info(pafs.FileSelector(path)) if x.path.endswith((".warc", ".warc.gz")))
            listed = [p for p, _ in _listing(system, path)]
            if listed:
                found = [x for x in found if x[0].rsplit("/", 1)[1] in set(listed)]
        out, size = [], PARTITION_BYTES
        for p, n in found:
            if size + n > PARTITION_BYTES:
                out.append(Files([]))
                size = 0
            out[-1].paths.append(p)
            size += n
        return out or [Files([])]

    def read(self, partition):
        system, _ = file_system(self.path)
        fields = pa.schema([(f.name, pa.binary() if isinstance(f.dataType, T.BinaryType) else pa.int64() if isinstance(f.dataType, T.LongType) else pa.string()) for f in SCHEMA.fields])
        for path in partition.paths:
            with system.open_input_file(path) as f:
                rows, size = [], 0
                for r in records(f, path.endswith(".gz"), self.filters, self.payloads, self.verify):
                    rows.append(r)
                    size += len(r[-1] or b"")
                    if size > 4 << 20 or len(rows) >= 2048:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), fields)], schema=fields)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), fields)], schema=fields)


def _listing(system: pafs.FileSystem, path: str) -> list[tuple[str, int]]:
    """Files of all commits; each writes a list of its own."""
    out: list[tuple[str, int]] = []
    for x in system.get_file_info(pafs.FileSelector(path)):
        name = x.path.rsplit("/", 1)[-1]
        if name.startswith("_files") and name.endswith(".json"):
            with system.open_input_stream(x.path) as f:
                out += [tuple(y) for y in json.loads(f.read())]
    return out


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    """Each task attempt writes files of its own names; a list of the files of the
    attempts that won, written last, makes them the archive."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.date = options.get("date", "2024-01-01T00:00:00Z")

    def write(self, iterator):
        system, path = file_system(self.path)
        system.create_dir(path, recursive=True)
        out, files, rows = None, [], 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    name, rows, size = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                    info = b"software: warc data source\r\nformat: WARC File Format 1.1\r\n"
                    size += out.write(member(b"%s\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:%s>\r\nWARC-Date: %s\r\nContent-Type: application/warc-fields\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (VERSION, str(uuid.uuid4()).encode(), self.date.encode(), len(info), info)))
                size += out.write(member(record_bytes(row, self.date)))
                rows += 1
                if size > FILE_BYTES:
                    out.close()
                    files.append((name, rows))
                    out = None
        if out is not None:
            out.close()
            files.append((name, rows))
        return Written(files)

    def commit(self, messages):
        system, path = file_system(self.path)
        files = sorted(f for m in messages if m for f in m.files)
        system.create_dir(path, recursive=True)
        with system.open_output_stream(f"{path}/_files-{uuid.uuid4().hex}.json", compression=None) as f:
            f.write(json.dumps(files).encode())

    def abort(self, messages):
        """Files of a failed job stay unlisted."""


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    prepare(spark)
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


RECORD = "<urn:pairloom:page:{}>"


def page_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """WARC records of ``pages`` (page_id, url, html).

    Of the pages with equal payloads of at least ``min_bytes`` bytes, that with the
    smallest page_id is the response and others are revisits of it.  A null html is an
    empty payload.  A page without an id is a response, as is each row that repeats the
    smallest id.  Digests are compared on narrow rows; a payload that very many pages
    share is combined before the shuffle, and the join back is one that adaptive
    execution splits.  Other columns are not read.
    """
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("_sha1", F.sha1("payload"))
    firsts = rows.where(F.octet_length("payload") >= min_bytes).groupBy("_sha1").agg(F.min("page_id").alias("_first"), F.count("*").alias("_n"))
    rows = rows.join(materialize(firsts.where("_n > 1").drop("_n"), "warc-firsts"), "_sha1", "left")
    again = (F.col("page_id") != F.col("_first")) & (F.octet_length("payload") >= min_bytes)
    named = lambda c: F.concat(F.lit(RECORD[:-3]), c.cast("string"), F.lit(">"))
    return rows.select(
        F.coalesce(named(F.col("page_id")), F.lit(RECORD.format(""))).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.when(again, named(F.col("_first"))).alias("refers_to"),
        F.lit(None).cast("string").alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_length"),
        "payload",
    )


def write_archive(records_df: DataFrame, path: str) -> None:
    register(records_df.sparkSession)
    records_df.write.format("warc").mode("append").save(path)


def read_archive(spark: SparkSession, path: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(**options).load(path)


def page_id(record_id: str):
    """The page of a record id, as a column."""
    return F.expr(f"try_cast(regexp_extract({record_id}, 'page:(-?[0-9]+)>', 1) AS BIGINT)")
