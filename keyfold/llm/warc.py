"""WARC archives as a Spark data source (format ``warc``), and writing a page table as archives.

Reading plans partitions over whole archive files, small ones together. Every
record's headers are parsed first and put to the pushed-down filters (record
type, ids, URI, digest, date, length); the payload is decoded only for records
that pass, and only if the ``payload`` option asks for it. Archives written here
carry each record's compressed length in its gzip header ("sl" extra field, from
the WARC specification's annex on compression), so a payload that isn't wanted
is never even decompressed. Archives without it, and plain ones, are read too.

Writing is safe against lost and repeated tasks: each attempt writes files of
its own name, and only those that a commit lists in its manifest are read. Each
commit adds a manifest; an overwriting one then drops the earlier ones.

Cases: a null payload is empty; repeated records are kept; a null id has an
empty last part in its record id and reads back as null; null or odd URIs are
left out or percent-encoded; an empty table gives an archive without records.
Columns beside those of the record are ignored.
"""

from __future__ import annotations

import base64
import contextlib
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from keyfold.llm.common import scratch

#: Names from the WARC and HTTP formats.
MANIFEST = "_manifest"
#: Lies in folders that this writer has begun: without a manifest, no write there has ended.
BEGUN = "_begun"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADER_OF = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "date": "WARC-Date",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
}

SCHEMA = ("record_type string, record_id string, date string, target_uri string, refers_to string, "
          "payload_digest string, payload_bytes long, headers map<string,string>, payload binary")
_MEMBER = struct.Struct("<4sLBBH2sHLL")  # gzip header with an "sl" field: member length, plain length
_PEEK = 8192


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """Any store that Arrow knows: local, hdfs, s3, gs."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "", 1))


def manifests(store: fs.FileSystem, root: str) -> list[str]:
    """Paths of the manifests of all commits."""
    return [i.path for i in store.get_file_info(fs.FileSelector(root)) if i.base_name.startswith(MANIFEST) and i.base_name.endswith(".json")]


def member(plain: bytes) -> bytes:
    """One gzip member that tells its own length."""
    pack = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = pack.compress(plain) + pack.flush()
    tail = struct.pack("<LL", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)
    total = _MEMBER.size + len(body) + 8
    if max(total, len(plain)) >= 1 << 32:
        return b"\x1f\x8b\x08\0\0\0\0\0\0\xff" + body + tail
    return _MEMBER.pack(b"\x1f\x8b\x08\x04", 0, 0, 255, 12, b"sl", 8, total, len(plain)) + body + tail


def record_bytes(fields: dict[str, str | None], payload: bytes, payload_bytes: int) -> bytes:
    """A record with an HTTP response block; a revisit has the HTTP headers only."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    if fields["record_type"] == "revisit":
        payload, fields = b"", fields | {"WARC-Profile": REVISIT_PROFILE}
    lines = [VERSION]
    for name, value in fields.items():
        if value is not None:
            lines.append(f"{HEADER_OF.get(name, name)}: {value}".replace("\r", "%0D").replace("\n", "%0A"))
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block) + len(payload)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "replace") + block + payload + b"\r\n\r\n"


def digest_of(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


class Writer(ds.DataSourceArrowWriter):
    def __init__(self, path: str, max_file_bytes: int, overwrite: bool = False):
        self.path, self.max_file_bytes, self.overwrite = path, max_file_bytes, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> ds.WriterCommitMessage:
        store, root = file_system(self.path)
        store.create_dir(root, recursive=True)
        store.open_output_stream(f"{root}/{BEGUN}").close()
        attempt, names, out = uuid.uuid4().hex, [], None
        try:
            for batch in iterator:
                plain = [n for n in HEADER_OF if n in batch.schema.names and n != "payload_digest"]
                columns = {n: batch.column(n) for n in [*plain, "payload"]}
                for row in range(batch.num_rows):
                    if out is None or out.tell() >= self.max_file_bytes:
                        if out is not None:
                            out.close()
                        names.append(f"{attempt}-{len(names):05d}.warc.gz")
                        out = store.open_output_stream(f"{root}/{names[-1]}", compression=None)
                    payload = columns["payload"][row].as_py() or b""
                    fields = {n: columns[n][row].as_py() for n in plain}
                    out.write(member(record_bytes(fields | {"payload_digest": digest_of(payload)}, payload, len(payload))))
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def commit(self, messages: list[ds.WriterCommitMessage | None]) -> None:
        store, root = file_system(self.path)
        store.create_dir(root, recursive=True)
        names = sorted(n for m in messages if m for n in m.names)
        earlier = manifests(store, root) if self.overwrite else []
        with store.open_output_stream(f"{root}/{MANIFEST}-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(names).encode())
        for path in earlier:
            store.delete_file(path)

    def abort(self, messages: list[ds.WriterCommitMessage | None]) -> None:
        """Deletes the files of tasks that had ended; what a failed task has left is in no manifest and is never read."""
        store, root = file_system(self.path)
        for name in [n for m in messages if m for n in m.names]:
            with contextlib.suppress(FileNotFoundError):
                store.delete_file(f"{root}/{name}")


@dataclass
class Written(ds.WriterCommitMessage):
    names: list[str]


@dataclass
class Files(ds.InputPartition):
    paths: list[str]

    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


def _compare(f: ds.Filter, row: dict) -> bool | None:
    """A filter's value on a record's headers; None where SQL has null."""
    if isinstance(f, ds.Not):
        inner = _compare(f.child, row)
        return None if inner is None else not inner
    value = row.get(f.attribute[0])
    if isinstance(f, ds.IsNull):
        return value is None
    if isinstance(f, ds.IsNotNull):
        return value is not None
    if isinstance(f, ds.EqualNullSafe):
        return value == f.value
    if value is None:
        return None
    tests = {ds.EqualTo: lambda: value == f.value, ds.In: lambda: value in f.value,
             ds.GreaterThan: lambda: value > f.value, ds.GreaterThanOrEqual: lambda: value >= f.value,
             ds.LessThan: lambda: value < f.value, ds.LessThanOrEqual: lambda: value <= f.value,
             ds.StringStartsWith: lambda: value.startswith(f.value), ds.StringEndsWith: lambda: value.endswith(f.value),
             ds.StringContains: lambda: f.value in value}
    return tests[type(f)]()


class Reader(ds.DataSourceReader):
    def __init__(self, path: str, payload: bool, verify: bool, partition_bytes: int):
        self.path, self.payload, self.verify, self.partition_bytes = path, payload, verify, partition_bytes
        self.filters: list[ds.Filter] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        """Takes what can be judged from the headers; the rest stays with Spark."""
        known = {*HEADER_OF, "payload_bytes"}
        simple = (ds.EqualTo, ds.EqualNullSafe, ds.In, ds.GreaterThan, ds.GreaterThanOrEqual, ds.LessThan, ds.LessThanOrEqual,
                  ds.StringStartsWith, ds.StringEndsWith, ds.StringContains, ds.IsNull, ds.IsNotNull)
        for f in filters:
            inner = f.child if isinstance(f, ds.Not) else f
            # Arrow and Java compare text by bytes, Python by code points: leave text ranges to Spark
            ranged = isinstance(inner, (ds.GreaterThan, ds.GreaterThanOrEqual, ds.LessThan, ds.LessThanOrEqual))
            if isinstance(inner, simple) and len(inner.attribute) == 1 and inner.attribute[0] in known and not (
                    ranged and inner.attribute[0] != "payload_bytes"):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[ds.InputPartition]:
        store, root = file_system(self.path)
        if listed := manifests(store, root):
            names: set[str] = set()
            for path in listed:
                with store.open_input_stream(path) as f:
                    names.update(json.loads(f.read()))
            infos = store.get_file_info([f"{root}/{n}" for n in sorted(names)])
        elif store.get_file_info(f"{root}/{BEGUN}").type == fs.FileType.File:
            infos = []  # a write that failed or hasn't ended: none of its files count
        else:
            infos = [i for i in store.get_file_info(fs.FileSelector(root)) if i.type == fs.FileType.File and ".warc" in i.base_name]
        out, size = [], 0
        for info in sorted(infos, key=lambda i: i.path):
            if not out or size + info.size > self.partition_bytes:
                out.append([])
                size = 0
            out[-1].append(info.path)
            size += info.size
        return [Files(paths) for paths in out] or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        store, _ = file_system(self.path)
        for path in partition.paths:
            with store.open_input_file(path) as f:
                yield from self.records(f, path)

    def records(self, f: pa.NativeFile, path: str) -> Iterator[tuple]:
        size, at = f.size(), 0
        while at < size:
            f.seek(at)
            head = f.read(min(_PEEK, size - at))
            if head[:4] == b"\x1f\x8b\x08\x04" and head[12:14] == b"sl" and head[10:12] == b"\x0c\0":
                total = _MEMBER.unpack_from(head)[7]
                unpack = zlib.decompressobj(-15)
                rest = lambda got=len(head), total=total: f.read(max(0, total - got))
                yield from self.record(unpack.decompress(head[_MEMBER.size:total]), rest, unpack.decompress, path)
                at += total
            elif head[:2] == b"\x1f\x8b":
                unpack, plain = zlib.decompressobj(31), []
                while head and not unpack.eof:
                    plain.append(unpack.decompress(head))
                    at += len(head) - len(unpack.unused_data)
                    head = b"" if unpack.eof else f.read(1 << 20)
                yield from self.record(b"".join(plain), lambda: b"", bytes, path)
            else:
                skip = len(head) - len(head.lstrip(b"\r\n"))
                if skip:
                    at += skip
                    continue
                while b"\r\n\r\n" not in head and len(head) < size - at:
                    head += f.read(1 << 16)
                top = head.index(b"\r\n\r\n") + 4
                length = int(dict(_headers(head[:top]))["content-length"])
                total = top + length
                yield from self.record(head[:total], lambda got=len(head), total=total: f.read(max(0, total - got)), bytes, path)
                at += total

    def record(self, plain: bytes, more, unpack, path: str) -> Iterator[tuple]:
        """The row of a record, or nothing. ``more()`` reads the rest of it, ``unpack`` decodes that."""
        whole = False

        def need(mark: bytes, start: int) -> int:
            nonlocal plain, whole
            end = plain.find(mark, start)
            if end < 0 and not whole:
                plain, whole = plain + unpack(more()), True
                end = plain.find(mark, start)
            return end

        top = need(b"\r\n\r\n", 0) + 4
        if top < 4 or not plain.startswith(b"WARC/"):
            raise ValueError(f"{path}: not a WARC record: {plain[:40]!r}")
        pairs = _headers(plain[:top])
        headers = dict(pairs)
        row = {name: headers.get(h.lower()) for name, h in HEADER_OF.items()}
        length, body, http = int(headers.get("content-length", 0)), top, {}
        if headers.get("content-type", "").startswith("application/http"):
            body = need(b"\r\n\r\n", top) + 4
            http = dict(_headers(plain[top:body]))
        row["payload_bytes"] = int(http["content-length"]) if "content-length" in http else length - (body - top)
        if all(_compare(f, row) for f in self.filters):
            payload = None
            if self.payload:
                if not whole and len(plain) < top + length:
                    plain += unpack(more())
                payload = plain[body:top + length]
                if len(payload) != length - (body - top):
                    raise ValueError(f"{path}: {row['record_id']} is cut short")
                if self.verify and row["record_type"] == "response" and (row["payload_digest"] or "").startswith("sha1:") \
                        and digest_of(payload) != row["payload_digest"]:
                    raise ValueError(f"{path}: {row['record_id']} doesn't match its digest")
            yield (*[row[n] for n in HEADER_OF], row["payload_bytes"], dict(pairs), payload)


def _headers(block: bytes) -> list[tuple[str, str]]:
    """(lower-case name, value) of each header line after the first line."""
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    return [(k.strip().lower(), v.strip()) for k, _, v in (line.partition(":") for line in lines if line)]


class WarcSource(ds.DataSource):
    """Options: path; payload (true), verify (false), partitionBytes; for writing maxFileBytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        get = self.options.get
        return Reader(self.options["path"], get("payload", "true") == "true", get("verify", "false") == "true",
                      int(get("partitionBytes", 128 << 20)))

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options["path"], int(self.options.get("maxFileBytes", 1 << 30)), overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def as_records(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0,
               date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Rows for the writer: of equal payloads the largest page id is the response, the others revisit it.

    Payloads under ``min_bytes`` are all responses. Rows that share the largest
    id and the payload are all responses; without any id in the group, all are.
    """
    name = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("target_uri"),
                        F.coalesce(F.encode(F.col(html).cast("string"), "UTF-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("_digest", F.sha1("payload"))
    # one slim row per payload that occurs twice; a hot payload's copies are split by AQE's skew join
    same = (rows.where(F.length("payload") >= min_bytes).groupBy("_digest")
            .agg(F.max("page_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1 and _first is not null").drop("_n"))
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return rows.join(same, "_digest", "left").select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), name(F.col("page_id")).alias("record_id"),
        F.lit(date).alias("date"), "target_uri", F.when(revisit, name(F.col("_first"))).alias("refers_to"), "payload")


def write_archives(records: DataFrame, path: str) -> None:
    register(records.sparkSession)
    records.write.format("warc").option("path", path).mode("append").save()


def read_archives(spark: SparkSession, path: str, *, payload: bool = True, verify: bool = False) -> DataFrame:
    register(spark)
    return (spark.read.format("warc").option("path", path).option("payload", str(payload).lower())
            .option("verify", str(verify).lower()).load())


def roundtrip(pages: DataFrame) -> DataFrame:
    """Write all pages as archives in the shared folder and read them back, payloads checked against their digests."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_archives(as_records(pages), path)
    return read_archives(spark, path, verify=True)


def page_number(column: str) -> F.Column:
    return F.regexp_extract(column, "^<urn:x-page:(-?[0-9]*)>$", 1).try_cast("long")
