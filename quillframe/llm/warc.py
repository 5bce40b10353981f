"""WARC archives as a Spark data source, and writing pages as response and revisit records."""

from __future__ import annotations

import gzip
import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from .common import scratch_path

SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, "
    "date string, headers map<string,string>, payload_bytes bigint, payload binary"
)
# Columns that a record's header alone decides: predicates on them are evaluated there.
HEADER_OF = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "date": "warc-date",
}
MANIFEST = "_manifest.json"
FILE_BYTES = 256_000_000  # a file is closed once it is this long
PARTITION_BYTES = 32_000_000  # small files are read together up to this size
BATCH_BYTES, BATCH_ROWS = 8_000_000, 2_000
PAYLOAD_FLOOR = 1000  # shorter payloads are never replaced by a revisit


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI; executors reach the same files by it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


def _bare(value: str | None, prefix: str = "") -> str | None:
    """A header value without angle brackets and prefix."""
    return None if value is None else value.strip("<>").removeprefix(prefix)


# ---------------------------------------------------------------- writing


@dataclass
class _Written(WriterCommitMessage):
    files: list


def _head(lines: list[tuple[str, str | None]]) -> bytes:
    clean = [(k, v.replace("\r", " ").replace("\n", " ")) for k, v in lines if v is not None]
    return "".join(f"{k}: {v}\r\n" for k, v in clean).encode("utf-8", "surrogatepass")


def _record(row: dict) -> bytes:
    payload = row["payload"] or b""
    http = b"HTTP/1.1 200 OK\r\n" + _head([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(row["payload_bytes"]))]) + b"\r\n"
    block = http if row["record_type"] == "revisit" else http + payload
    refers = row["refers_to"]
    head = _head(
        [
            ("WARC-Type", row["record_type"]),
            ("WARC-Record-ID", f"<{row['record_id']}>"),
            ("WARC-Date", row.get("date") or "1970-01-01T00:00:00Z"),
            ("WARC-Target-URI", row["target_uri"]),
            ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
            ("WARC-Refers-To", None if refers is None else f"<{refers}>"),
            ("WARC-Profile", None if refers is None else "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(block))),
        ]
    )
    return b"WARC/1.1\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def _member(record: bytes) -> bytes:
    """A gzip member of its own, whose extra field ``sl`` holds its length and the record's.

    Any gzip reader takes it; a reader that knows the field need not inflate what it skips.
    """
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    length = 12 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, length, len(record) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


class _Writer(DataSourceArrowWriter):
    """Every task writes files of its own; only those of committed tasks enter the manifest."""

    def __init__(self, options):
        self.path = options["path"]
        self.compress = str(options.get("compression", "none")).lower() == "gzip"
        self.file_bytes = int(options.get("fileBytes", FILE_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        part, files, out, name, size = TaskContext.get().partitionId(), [], None, "", 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    name = f"part-{part:05d}-{uuid.uuid4().hex}.warc" + ".gz" * self.compress
                    out, size = store.open_output_stream(f"{root}/{name}", compression=None), 0
                record = _record(row)
                record = _member(record) if self.compress else record
                out.write(record)
                size += len(record)
                if size >= self.file_bytes:
                    out.close()
                    files.append((name, size))
                    out = None
        if out is not None:
            out.close()
            files.append((name, size))
        return _Written(files)

    def commit(self, messages) -> None:
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        files = sorted(f for m in messages if m is not None for f in m.files)
        with store.open_output_stream(f"{root}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages) -> None:
        """Files without a manifest entry are never read."""


# ---------------------------------------------------------------- reading


@dataclass
class _Files(InputPartition):
    files: list

    def __post_init__(self):
        super().__init__(self.files)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() != "false"
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name not in HEADER_OF:
                yield f
            elif isinstance(f, EqualTo):
                self.tests.append((name, "in", frozenset([f.value])))
            elif isinstance(f, In):
                self.tests.append((name, "in", frozenset(f.value)))
            elif isinstance(f, StringStartsWith):
                self.tests.append((name, "starts", f.value))
            elif isinstance(f, IsNotNull):
                self.tests.append((name, "known", None))
            else:
                yield f

    def partitions(self):
        store, root = _open(self.path)
        manifest = store.get_file_info(f"{root}/{MANIFEST}")
        if manifest.type == fs.FileType.File:
            with store.open_input_stream(manifest.path) as f:
                files = [(f"{root}/{n}", size) for n, size in json.loads(f.read())]
        else:
            found = store.get_file_info(fs.FileSelector(root, recursive=True))
            files = [(x.path, x.size) for x in found if x.path.endswith((".warc", ".warc.gz"))]
        plan, held = [], 0
        for path, size in sorted(files):
            if not plan or held + size > self.partition_bytes:
                plan.append([])
                held = 0
            plan[-1].append(path)
            held += size
        return [_Files(p) for p in plan] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        store, _ = _open(self.path)
        rows, size = [], 0
        for path in partition.files:
            with store.open_input_file(path) as raw:
                found = _compressed_records if path.endswith(".gz") else _records
                for row in found(raw, self.tests, self.payload):
                    rows.append(row)
                    size += len(row["payload"] or b"")
                    if size >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)


_ARROW = pa.schema(
    [(n, pa.string()) for n in ("record_id", "record_type", "target_uri", "refers_to", "payload_digest", "date")]
    + [("headers", pa.map_(pa.string(), pa.string())), ("payload_bytes", pa.int64()), ("payload", pa.binary())]
)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ARROW)


class _Lines:
    """Lines and blocks of a stream, with a look-ahead of its own so that blocks can be skipped by seeking."""

    def __init__(self, stream, ahead: int = 65_536):
        self.stream, self.held, self.at, self.ahead = stream, b"", 0, ahead

    def _more(self) -> bool:
        data = self.stream.read(self.ahead)
        self.held, self.at = self.held[self.at :] + data, 0
        return bool(data)

    def until(self, mark: bytes) -> bytes | None:
        """Everything up to and with the mark; None at the end of the stream."""
        start = self.at
        while (end := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - self.at - len(mark) + 1)
            if not self._more():
                return None
        out, self.at = self.held[self.at : end + len(mark)], end + len(mark)
        return out

    def take(self, n: int) -> bytes:
        out = self.held[self.at : self.at + n]
        self.at += len(out)
        return out if len(out) == n else out + self.stream.read(n - len(out))

    def skip(self, n: int) -> None:
        inside = min(n, len(self.held) - self.at)
        self.at += inside
        n -= inside
        if n and not isinstance(self.stream, io.BufferedReader):
            self.stream.seek(self.stream.tell() + n)
        else:
            while n:  # a compressed stream has no places to jump to
                got = len(self.stream.read(min(n, 1 << 20)))
                n = n - got if got else 0


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            out[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return out


def _passes(row: dict, tests) -> bool:
    for name, kind, value in tests:
        own = row[name]
        if own is None or (kind == "in" and own not in value) or (kind == "starts" and not own.startswith(value)):
            return False
    return True


class _Inflated:
    """The bytes of one gzip member, inflated as far as they are asked for."""

    def __init__(self, raw, left: int):
        self.raw, self.left, self.inflate = raw, left, zlib.decompressobj(-15)

    def read(self, n: int) -> bytes:
        out = []
        while n > 0 and not self.inflate.eof:
            data = self.inflate.unconsumed_tail
            if not data:
                data = self.raw.read(min(self.left, 16_384))
                self.left -= len(data)
                if not data:
                    break
            out.append(self.inflate.decompress(data, n))
            n -= len(out[-1])
        return b"".join(out)


def _compressed_records(raw, tests, payload: bool) -> Iterator[dict]:
    """Records of gzip members; a member with its length in field ``sl`` is left by seeking."""
    at = 0
    while True:
        raw.seek(at)
        head = raw.read(24)
        if head[3:4] == b"\x04" and head[12:14] == b"sl":
            yield from _records(_Inflated(raw, 1 << 62), tests, payload, ahead=2_048, single=True)
            at += struct.unpack("<I", head[16:20])[0]
            continue
        if head:
            raw.seek(at)
            yield from _records(io.BufferedReader(gzip.GzipFile(fileobj=raw)), tests, payload)
        return


def _records(stream, tests, payload: bool, ahead: int = 65_536, single: bool = False) -> Iterator[dict]:
    """Records that pass the tests; the blocks of all others are skipped unread.

    ``single``: the stream holds one record, so nothing needs to be skipped.
    """
    lines = _Lines(stream, ahead)
    while (head := lines.until(b"\r\n\r\n")) is not None:
        headers = _fields(head.lstrip(b"\r\n"))
        length = int(headers.get("content-length", 0))
        row = {n: _bare(headers.get(h), "sha1:" if n == "payload_digest" else "") for n, h in HEADER_OF.items()}
        if not _passes(row, tests):
            if single:
                return
            lines.skip(length + 4)
            continue
        row |= {"headers": list(headers.items()), "payload": None, "payload_bytes": length}
        if headers.get("content-type", "").startswith("application/http") and length:
            http = lines.until(b"\r\n\r\n") or b""
            length -= len(http)
            full = _fields(http).get("content-length")
            row["payload_bytes"] = int(full) if row["record_type"] == "revisit" and full else length
        if payload and row["record_type"] != "revisit":
            row["payload"] = lines.take(length)
            length = 0
        yield row
        if single:
            return
        lines.skip(length + 4)


class WarcDataSource(DataSource):
    """``format("warc")``: option ``payload=false`` leaves payloads undecoded, ``compression=gzip`` writes a member a record."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options)


def read_warc(spark: SparkSession, path: str, **options) -> DataFrame:
    """The records below a folder. Filters on header columns are decided before a block is read.

    Files are grouped into partitions by size; folders written by :func:`write_warc` are read
    by their manifest, others file by file (``.warc``, ``.warc.gz``).
    """
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").options(**options).load(path)


def write_warc(records: DataFrame, path: str, **options) -> None:
    """Write records (columns of SCHEMA but headers; date optional) as WARC files."""
    records.sparkSession.dataSource.register(WarcDataSource)
    records.write.format("warc").options(**options).mode("append").save(path)


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A WARC record per page: response, or revisit where a later page has the same payload.

    The payload is the html in UTF-8, null being empty. Of equal payloads of at least
    PAYLOAD_FLOOR bytes the one with the largest id is the response and the others refer to
    it; a page without an id never is the response while another has one, and pages that
    repeat that largest id are all responses. Shorter payloads, and groups of which no page
    has an id, are all responses. Extra columns are ignored, an empty table gives no record.
    """
    html = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("target_uri"),
        html.alias("payload"),
        F.sha1(html).alias("payload_digest"),
        F.octet_length(html).cast("bigint").alias("payload_bytes"),
    )
    repeated = (
        rows.filter(F.col("payload_bytes") >= PAYLOAD_FLOOR)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
        .select("payload_digest", "response")
    )
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")))
    revisit = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return rows.join(repeated, "payload_digest", "left").select(
        urn("page_id").alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.when(revisit, urn("response")).alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def pages_round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as WARC files into the shared folder and read them back.

    Digest and length of a response are computed anew from the payload that was read; those
    of a revisit are its own headers'.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(page_records(pages), path, compression="gzip")
    page = lambda c: F.expr(f"try_cast(substr({c}, {len('urn:page:') + 1}) AS bigint)")
    return read_warc(spark, path).select(
        page("record_id").alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("bigint"), "payload_bytes").alias("payload_bytes"),
        F.coalesce(F.sha1("payload"), "payload_digest").alias("payload_digest"),
        "record_type",
        page("refers_to").alias("refers_to"),
    )


SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS response FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN response END AS refers_to
FROM g
"""
