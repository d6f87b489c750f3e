"""WARC archives as a Spark data source, read and written: ``spark.read.format("warc")``.

*Reading.*  ``partitions`` plans the files: small ones are put together, and each task reads its own from the store.  A
record's headers are parsed first.  Predicates on columns that come from headers (record type, URI, digest, ...) are
pushed down and decided on them; of a record that they refuse, or when no payload is asked for, nothing else is decoded.
In plain files it is jumped over.  In compressed files each record is a gzip member of its own, and members written here
say in an extra field (``sl``: lengths packed and unpacked) where the next one begins, so it is jumped over as well;
other members are unpacked to their end in pieces and thrown away.

*Writing.*  Each task writes files of its own, and a list of the files of all tasks is added when the job is committed.
What a lost or repeated task left is in no list and is not read.  A folder without lists is read file by file.

Files are opened through ``pyarrow.fs`` by their URI (local, S3, GCS, HDFS).  A damaged archive raises an error that
names the file and the place.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import datasource as ds
from pyspark.sql.types import StructType

from strataflow.llm.common import stored

# Header fields of the format.
FIELDS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "content_type": "content-type",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = (
    ", ".join(f"{c} string" for c in FIELDS)
    + ", content_length long, headers map<string,string>, payload binary, digest_ok boolean, file string, offset long"
)
KINDS = [pa.string()] * len(FIELDS) + [
    pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary(), pa.bool_(), pa.string(), pa.int64()
]
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
WRITTEN = ["record_id", "record_type", "target_uri", "refers_to", "payload_sha1", "payload"]
END = b"\r\n\r\n"
READ = 1 << 13
UNPACKED = 1 << 16  # bytes that a gzip member is unpacked by
WINDOW = 1 << 18
HEADERS = 1 << 20  # longer ones are taken for damage
BATCH_BYTES = 4_000_000
PARTITION_BYTES = 128 << 20
FILE_BYTES = 1 << 30


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def base32_sha1(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


# ---------------------------------------------------------------- reading


class Window:
    """Random reads of a file through one piece of it: near ones read nothing again, far ones nothing between."""

    def __init__(self, file):
        self.file, self.size, self.first, self.data = file, file.size(), 0, b""

    def get(self, at: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``at`` on; fewer only at the end of the file."""
        if not self.first <= at <= at + n <= self.first + len(self.data):
            self.file.seek(at)
            self.first, self.data = at, self.file.read(max(n, WINDOW))
        return self.data[at - self.first : at - self.first + n]


class Plain:
    """The bytes of an uncompressed file, in order."""

    def __init__(self, file):
        self.window, self.at = Window(file), 0

    def read(self, n: int) -> bytes:
        """Up to ``n`` bytes, none at the end."""
        out = self.window.get(self.at, n)
        self.at += len(out)
        return out

    def unread(self, data: bytes) -> None:
        self.at -= len(data)

    def skip(self, n: int) -> None:
        self.at += n
        if self.at > self.window.size:
            raise ValueError("the file ends inside a record")

    def place(self) -> int:
        return self.at


class Gzip:
    """The same for a file of gzip members; ``skip`` to the end of a member jumps to the next one where it can."""

    def __init__(self, file):
        self.window, self.next, self.held = Window(file), 0, b""
        self.member, self.unpacker, self.packed, self.fed, self.length, self.given = 0, None, b"", 0, None, 0

    def feed(self) -> None:
        self.packed = self.window.get(self.fed, READ)
        self.fed += len(self.packed)

    def start(self) -> bool:
        """Open the next member, if there is one."""
        if self.next >= self.window.size:
            return False
        self.member = self.fed = self.next
        self.feed()
        if self.packed[:2] != b"\x1f\x8b":
            raise ValueError("no gzip member")
        self.length, self.given = None, 0
        # ID, method, flags (4: extra field), time, system, length of the extra field, then our 12 bytes.
        if self.packed[3] == 4 and self.packed[10:16] == b"\x0c\x00sl\x08\x00" and len(self.packed) >= 24:
            self.length = struct.unpack("<II", self.packed[16:24])
        self.unpacker = zlib.decompressobj(31)
        return True

    def read(self, n: int) -> bytes:
        while not self.held:
            if self.unpacker is None and not self.start():
                return b""
            if not self.packed:
                self.feed()
                if not self.packed:
                    raise ValueError("the file ends inside a gzip member")
            self.held = self.unpacker.decompress(self.packed, UNPACKED)
            self.given += len(self.held)
            self.packed = self.unpacker.unconsumed_tail
            if self.unpacker.eof:
                self.next = self.fed - len(self.unpacker.unused_data)
                self.unpacker = None
        out, self.held = self.held[:n], self.held[n:]
        return out

    def unread(self, data: bytes) -> None:
        self.held = data + self.held

    def skip(self, n: int) -> None:
        if self.unpacker is not None and self.length and self.given - len(self.held) + n == self.length[1]:
            there = self.member + self.length[0]
            if there > self.window.size or there < self.window.size and self.window.get(there, 2) != b"\x1f\x8b":
                raise ValueError("a gzip member is not as long as it says")
            self.next, self.unpacker, self.held = there, None, b""
            return
        while n:
            out = self.read(min(n, UNPACKED))
            if not out:
                raise ValueError("the file ends inside a record")
            n -= len(out)

    def place(self) -> int:
        """Of the member that the next byte is in."""
        return self.member if self.held or self.unpacker is not None else self.next


def exactly(source: Plain | Gzip, n: int) -> bytes:
    parts = []
    while n:
        part = source.read(n)
        if not part:
            raise ValueError("the file ends inside a record")
        parts.append(part)
        n -= len(part)
    return b"".join(parts)


def header_block(source: Plain | Gzip) -> bytes:
    """What stands before the next empty line; nothing at the end of the file."""
    block = b""
    while END not in block:
        part = source.read(READ)
        if not part and not block.strip():
            return b""
        if not part or len(block) > HEADERS:
            raise ValueError("no end of the headers")
        block = (block + part).lstrip(b"\r\n") if not block else block + part
    block, rest = block.split(END, 1)
    source.unread(rest)
    return block


def parsed(block: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a field that is given again is joined by a comma."""
    first, *lines = block.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no WARC record but {first[:40]!r}")
    fields: dict[str, str] = {}
    last = ""
    for line in lines:
        if line[:1] in " \t" and last:
            fields[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if colon:
            last, value = name.strip().lower(), value.strip()
            fields[last] = f"{fields[last]}, {value}" if last in fields else value
    return fields


def values_of(fields: dict[str, str]) -> dict[str, object]:
    """The columns that headers give: ids without angle brackets, the digest without its ``sha1:``."""
    found: dict[str, object] = {c: fields.get(name) for c, name in FIELDS.items()}
    for c in ("record_id", "refers_to", "target_uri"):
        found[c] = found[c] and found[c].strip("<>")
    found["payload_digest"] = found["payload_digest"] and found["payload_digest"].rpartition(":")[2]
    found["content_length"] = int(fields.get("content-length", 0))
    return found


def payload_of(block: bytes, content_type: str | None) -> bytes:
    """The entity behind HTTP headers, as transferred; the block itself of records that hold no HTTP message."""
    return block.partition(END)[2] if (content_type or "").startswith("application/http") else block


def records(file, packed: bool, wanted: Callable[[dict], bool], payloads: bool) -> Iterator[tuple]:
    """(columns, header fields, payload or None, place) of the wanted records of an open file."""
    source = Gzip(file) if packed else Plain(file)
    while True:
        place = source.place()
        block = header_block(source)
        if not block:
            return
        fields = parsed(block)
        values = values_of(fields)
        length = values["content_length"]
        if not wanted(values):
            source.skip(length + len(END))
            continue
        payload = None
        if payloads:
            payload = payload_of(exactly(source, length), values["content_type"])
            source.skip(len(END))
        else:
            source.skip(length + len(END))
        yield values, fields, payload, place


TESTS: dict[type, Callable[[object, object], bool]] = {
    ds.EqualTo: lambda x, y: x is not None and x == y,
    ds.EqualNullSafe: lambda x, y: x == y,
    ds.In: lambda x, y: x is not None and x in y,
    ds.GreaterThan: lambda x, y: x is not None and x > y,
    ds.GreaterThanOrEqual: lambda x, y: x is not None and x >= y,
    ds.LessThan: lambda x, y: x is not None and x < y,
    ds.LessThanOrEqual: lambda x, y: x is not None and x <= y,
    ds.StringStartsWith: lambda x, y: x is not None and x.startswith(y),
    ds.StringEndsWith: lambda x, y: x is not None and x.endswith(y),
    ds.StringContains: lambda x, y: x is not None and y in x,
    ds.IsNull: lambda x, _: x is None,
    ds.IsNotNull: lambda x, _: x is not None,
}
# Strings compare in Spark as their UTF-8 bytes do, in Python by code points: the same order.


def decidable(condition: ds.Filter) -> bool:
    inner = condition.child if isinstance(condition, ds.Not) else condition
    return type(inner) in TESTS and inner.attribute[0] in (*FIELDS, "content_length") and len(inner.attribute) == 1


def holds(condition: ds.Filter, values: dict) -> bool:
    if isinstance(condition, ds.Not):
        inner = condition.child
        null = values[inner.attribute[0]] is None and type(inner) not in (ds.IsNull, ds.IsNotNull, ds.EqualNullSafe)
        return not null and not holds(inner, values)
    operand = getattr(condition, "value", None)
    return TESTS[type(condition)](values[condition.attribute[0]], operand)


@dataclass
class Files(ds.InputPartition):
    names: tuple[str, ...]


@dataclass
class WarcReader(ds.DataSourceReader):
    path: str
    payloads: bool
    partition_bytes: int
    conditions: tuple = ()

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        self.conditions = tuple(f for f in filters if decidable(f))
        return [f for f in filters if not decidable(f)]

    def partitions(self) -> list[Files]:
        planned, names, total = [], [], 0
        for name, size in listed(self.path):
            if names and total + size > self.partition_bytes:
                planned.append(Files(tuple(names)))
                names, total = [], 0
            names.append(name)
            total += size
        return [*planned, Files(tuple(names))]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = store_of(self.path)
        rows, size = [], 0

        def batch() -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), KINDS, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, NAMES)

        def wanted(values: dict) -> bool:
            return all(holds(c, values) for c in self.conditions)

        for name in partition.names:
            with store.open_input_file(name) as file:
                found = records(file, name.endswith(".gz"), wanted, self.payloads)
                try:
                    for values, fields, payload, place in found:
                        said, ok = values["payload_digest"], None
                        if payload is not None and said:
                            ok = base32_sha1(hashlib.sha1(payload).digest()) == said
                        rows.append((*values.values(), list(fields.items()), payload, ok, name, place))
                        size += len(payload or b"") + 500
                        if size > BATCH_BYTES:
                            yield batch()
                            size = 0
                except (ValueError, zlib.error) as error:
                    raise ValueError(f"{name}, at or behind byte {file.tell()}: {error}") from error
        if rows:
            yield batch()


def listed(path: str) -> list[tuple[str, int]]:
    """(name, bytes) of the archive files of a folder, or the one file that ``path`` names."""
    store, top = store_of(path)
    info = store.get_file_info(top)
    if info.type == fs.FileType.File:
        return [(info.path, info.size)]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = {i.path: i.size for i in store.get_file_info(fs.FileSelector(top)) if i.type == fs.FileType.File}
    lists = [p for p in found if p.endswith(".json") and "/_files-" in p]
    if lists:
        names: set[str] = set()
        for name in lists:
            with store.open_input_stream(name) as file:
                names |= {f"{top.rstrip('/')}/{n}" for n in json.loads(file.read())}
    else:
        names = {p for p in found if p.endswith((".warc", ".warc.gz"))}
    return sorted((n, found[n]) for n in names)


# ---------------------------------------------------------------- writing


def record_bytes(values: dict, date: str) -> bytes:
    """One record: a response holds the payload as an HTTP message, a revisit only refers to the one that does."""
    payload, kind = values["payload"] or b"", values["record_type"]
    sha1 = bytes.fromhex(values["payload_sha1"]) if values["payload_sha1"] else hashlib.sha1(payload).digest()
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = http.encode() + (b"\r\n" if kind == "revisit" else b"Content-Length: %d\r\n\r\n" % len(payload) + payload)
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<{values['record_id']}>",
        "WARC-Date": date,
        "WARC-Target-URI": values["target_uri"],
        "WARC-Payload-Digest": f"sha1:{base32_sha1(sha1)}",
        "WARC-Refers-To": values["refers_to"] and f"<{values['refers_to']}>",
        "WARC-Profile": PROFILE if kind == "revisit" else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    # A field is one line: white space inside a value, line ends included, is a blank.
    lines = ["WARC/1.1", *(f"{k}: {' '.join(v.split())}" for k, v in fields.items() if v is not None)]
    return "\r\n".join(lines).encode() + END + block + END


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """A gzip member that says in its extra field how long it is, packed and unpacked."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    length = 24 + len(body) + 8
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    if max(length, len(data)) >= 1 << 32:
        return b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff" + body + tail
    extra = b"\x0c\x00sl\x08\x00" + struct.pack("<II", length, len(data))
    return b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + extra + body + tail


@dataclass
class Written(ds.WriterCommitMessage):
    names: tuple[str, ...]


@dataclass
class WarcWriter(ds.DataSourceArrowWriter):
    path: str
    overwrite: bool
    date: str
    packed: bool
    file_bytes: int

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, top = store_of(self.path)
        store.create_dir(top, recursive=True)
        names, file, size = [], None, 0
        for batch in iterator:
            for values in batch.to_pylist():
                if file is None:
                    names.append(f"part-{uuid.uuid4().hex}.warc{'.gz' if self.packed else ''}")
                    file, size = store.open_output_stream(f"{top}/{names[-1]}", compression=None), 0
                data = record_bytes(values, self.date)
                data = gzip_member(data) if self.packed else data
                file.write(data)
                size += len(data)
                if size >= self.file_bytes:
                    file.close()
                    file = None
        if file is not None:
            file.close()
        return Written(tuple(names))

    def commit(self, messages: list[Written | None]) -> None:
        store, top = store_of(self.path)
        store.create_dir(top, recursive=True)
        old = [i.path for i in store.get_file_info(fs.FileSelector(top)) if "/_files-" in i.path] if self.overwrite else []
        gone = listed(self.path) if old else []
        names = [n for m in messages if m for n in m.names]
        with store.open_output_stream(f"{top}/_files-{uuid.uuid4().hex}.json", compression=None) as file:
            file.write(json.dumps(names).encode())
        for name in [*old, *(n for n, _ in gone)]:
            store.delete_file(name)

    def abort(self, messages: list[Written | None]) -> None:
        store, top = store_of(self.path)
        for name in (n for m in messages if m for n in m.names):
            store.delete_file(f"{top}/{name}")


class WarcDataSource(ds.DataSource):
    """Options: ``payload`` (false: headers only), ``partitionBytes``; for writing ``date``, ``compression`` (gzip or
    none), ``fileBytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        payloads = self.options.get("payload", "true").lower() == "true"
        return WarcReader(self.options["path"], payloads, int(self.options.get("partitionBytes", PARTITION_BYTES)))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        if missing := set(WRITTEN) - set(schema.names):
            raise ValueError(f"columns missing: {sorted(missing)}")
        now = dt.datetime.now(dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
        packed = self.options.get("compression", "gzip") == "gzip"
        size = int(self.options.get("fileBytes", FILE_BYTES))
        return WarcWriter(self.options["path"], overwrite, self.options.get("date", now), packed, size)


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let predicates reach it."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# ---------------------------------------------------------------- pages


def page_records(pages: DataFrame, revisits_from: int = 0) -> DataFrame:
    """Records of ``pages`` (page_id, url, html), ready to be written.

    Of pages with one payload, ``revisits_from`` bytes or more, the one with the largest page_id is the response and
    the others revisit it; rows that repeat its page_id are responses as well.  A null html is an empty payload, a null
    page_id is the least.  Only digests are grouped; payloads of revisits are left behind before the write.
    """
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").alias("target_uri"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("payload_sha1", F.sha1("payload"))
    last = own.groupBy("payload_sha1").agg(F.max("page_id").alias("_last"))

    def record_id(page: str) -> str:
        return f"concat('urn:page:', coalesce(CAST({page} AS STRING), 'null'), ':', payload_sha1)"

    joined = own.join(last, "payload_sha1")
    again = f"octet_length(payload) >= {revisits_from} AND NOT page_id <=> _last"
    return joined.selectExpr(
        f"{record_id('page_id')} AS record_id",
        f"CASE WHEN {again} THEN 'revisit' ELSE 'response' END AS record_type",
        "target_uri",
        f"CASE WHEN {again} THEN {record_id('_last')} END AS refers_to",
        "payload_sha1",
        f"CASE WHEN {again} THEN NULL ELSE payload END AS payload",
    )


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record of an archive of pages.

    Responses are read with their payload, whose digest must be the one in the header; of revisits only headers are
    read, and their response says how long the payload is.
    """
    register(spark)
    archive = spark.read.format("warc")
    digest = F.when(F.col("digest_ok"), F.col("payload_digest"))
    digest = digest.otherwise(F.raise_error(F.concat(F.lit("digest of "), "record_id", F.lit(" does not fit"))))
    responses = archive.load(path).where("record_type = 'response'")
    responses = stored(
        responses.select("record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), digest.alias("payload_digest")),
        "warc-responses",
    )
    revisits = archive.option("payload", "false").load(path).where("record_type = 'revisit'")
    lengths = responses.select(F.col("record_id").alias("refers_to"), "payload_bytes").distinct()
    revisits = revisits.select("record_id", "refers_to", "payload_digest").join(lengths, "refers_to", "left")

    def page(column: str) -> str:
        return f"try_cast(split({column}, ':')[2] AS LONG)"

    common = ["payload_bytes", "payload_digest"]
    one = responses.selectExpr(f"{page('record_id')} AS page_id", *common, "'response' AS record_type", "CAST(NULL AS LONG) AS refers_to")
    other = revisits.selectExpr(f"{page('record_id')} AS page_id", *common, "'revisit' AS record_type", f"{page('refers_to')} AS refers_to")
    return one.unionByName(other)


def write_pages(pages: DataFrame, path: str, revisits_from: int = 0) -> None:
    register(pages.sparkSession)
    page_records(pages, revisits_from).select(*WRITTEN).write.format("warc").mode("append").save(path)


ORACLE = """
WITH sums AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, from_hex(sha1(coalesce(html, '')))::BIT::VARCHAR AS bits
    FROM pages
), named AS (
    SELECT page_id, payload_bytes, max(page_id) OVER (PARTITION BY bits) AS last,
        list_reduce(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + list_sum(list_transform(range(5), lambda j: substr(bits, 5 * i + j + 1, 1)::INT << (4 - j)))::INT, 1)),
            lambda a, b: a || b) AS payload_digest
    FROM sums
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
    CASE WHEN page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM named
"""
