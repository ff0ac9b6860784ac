"""WARC archives as a Spark data source for reading and writing.

Reading: the driver lists files and packs them into partitions; tasks parse the
header block of each record first, test record type and header predicates that
Spark pushed down, and go on to the next record without inflating the payload of
one that is not wanted. Works on plain files, on one gzip member per record, and
quickest on members that carry the ``sl`` extra field (member length), which the
writer here adds: an unwanted record is then not even read to its end.

Writing: one file of gzip members per task attempt, named at random. The commit
writes a manifest, and readers take only files that a manifest names, so neither
a lost task nor a repeated one shows. Folders without a manifest are read whole.

Paths are those of ``pyarrow.fs`` (``file://``, ``s3://``, ``gs://``, ``hdfs://``
or a plain path).
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from ..operators.skew import shared_folder, stage

SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, refers_to string, "
    "payload_digest string, payload_bytes long, payload binary"
)
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
ARROW = pa.schema([(n, {"long": pa.int64(), "binary": pa.binary()}.get(k, pa.string())) for n, k in map(str.split, SCHEMA.split(", "))])
# The WARC header behind each column that predicates may use.
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}
SMALLEST_SHARED = 100
WINDOW_BYTES = 1 << 18
HEAD_BYTES = 1 << 14
BATCH_BYTES = 8 << 20
PARTITION_BYTES = 64 << 20
SUFFIXES = (".warc", ".warc.gz")


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


@dataclass
class Written(WriterCommitMessage):
    name: str | None


class Window:
    """Ranges of a file, read in blocks."""

    def __init__(self, source: pa.NativeFile) -> None:
        self.source, self.size, self.start, self.block = source, source.size(), 0, b""

    def take(self, at: int, n: int) -> bytes:
        if at < self.start or at + n > self.start + len(self.block):
            self.source.seek(at)
            self.start, self.block = at, self.source.read(max(n, WINDOW_BYTES))
        return self.block[at - self.start : at - self.start + n]


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    pairs = (line.partition(":") for line in lines[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


Wanted = Callable[[dict[str, str]], bool]


def member_size(head: bytes) -> int | None:
    """The length of a gzip member by its ``sl`` field."""
    if len(head) < 24 or not head[3] & 4:
        return None
    at, end = 12, 12 + struct.unpack_from("<H", head, 10)[0]
    while at + 4 <= end:
        name, n = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
        if name == b"sl" and n == 8:
            return struct.unpack_from("<I", head, at + 4)[0]
        at += 4 + n
    return None


def gzip_records(window: Window, wanted: Wanted) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < window.size:
        known = member_size(window.take(at, 64))
        inflate, record, read, head = zlib.decompressobj(31), bytearray(), at, None
        while not inflate.eof:
            left = (at + known if known else window.size) - read
            piece = window.take(read, min(HEAD_BYTES if head is None else WINDOW_BYTES, left))
            if not piece:
                raise ValueError("a gzip member is cut off")
            read += len(piece)
            record += inflate.decompress(piece)
            if head is None and (cut := record.find(b"\r\n\r\n")) >= 0:
                head = parse_head(record[:cut])
                keep = wanted(head)
                if not keep and known:
                    break
                if not keep:
                    record = bytearray()
            elif head is not None and not keep:
                record = bytearray()
        if head is None:
            raise ValueError("a record has no header")
        if keep:
            body = cut + 4
            yield head, bytes(record[body : body + int(head["content-length"])])
        at = at + known if known else read - len(inflate.unused_data)


def plain_records(window: Window, wanted: Wanted) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < window.size:
        n = HEAD_BYTES
        while (cut := window.take(at, n).find(b"\r\n\r\n")) < 0:
            if at + n >= window.size:
                if window.take(at, n).strip():
                    raise ValueError("a record has no header")
                return
            n *= 2
        head = parse_head(window.take(at, cut))
        size = int(head["content-length"])
        if wanted(head):
            yield head, window.take(at + cut + 4, size)
        at += cut + 4 + size + 4


def records(path: str, wanted: Wanted) -> Iterator[tuple[dict[str, str], bytes]]:
    files, name = pafs.FileSystem.from_uri(path)
    with files.open_input_file(name) as source:
        window = Window(source)
        yield from (gzip_records if window.take(0, 2) == b"\x1f\x8b" else plain_records)(window, wanted)


def row_of(head: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    payload, declared = block, None
    if head.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        lengths = [x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        declared = int(lengths[0].split(b":")[1]) if lengths else None
    digest = head.get("warc-payload-digest")
    kind = head.get("warc-type")
    if kind == "revisit":
        payload = None
    elif digest and digest.startswith("sha256:") and hashlib.sha256(payload).hexdigest() != digest[7:]:
        raise ValueError(f"payload of {head.get('warc-record-id')} does not match its digest")
    size = declared if payload is None else len(payload)
    found = [head.get(h) for h in HEADERS.values()]
    return (*found, size, payload if with_payload else None)


def passes(head: dict[str, str], predicates: list[tuple[str, str, tuple]]) -> bool:
    for column, test, values in predicates:
        value = head.get(HEADERS[column])
        if value is None:
            return False
        if test == "in" and value not in values or test == "starts" and not value.startswith(values[0]):
            return False
    return True


def committed(path: str) -> list[tuple[str, int]]:
    """(URI, size) of the files that count."""
    files, name = pafs.FileSystem.from_uri(path)
    base = path.rstrip("/")
    info = files.get_file_info(pafs.FileSelector(name, recursive=False))
    here = {x.base_name: x.size for x in info if x.base_name.endswith(SUFFIXES)}
    lists = [x.path for x in info if x.base_name.startswith("_manifest-")]
    if lists:
        named = set()
        for one in lists:
            with files.open_input_stream(one) as source:
                named.update(json.loads(source.read()))
        if lost := named - here.keys():
            raise FileNotFoundError(f"{len(lost)} committed archives are missing in {path}")
        here = {n: here[n] for n in named}
    return [(f"{base}/{n}", size) for n, size in sorted(here.items())]


class WarcReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path = options["path"]
        self.with_payload = options.get("payload", "true") == "true"
        self.partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.predicates: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters):  # noqa: N802  Spark's name
        for one in filters:
            column = one.attribute[0] if len(getattr(one, "attribute", ())) == 1 else None
            if column not in HEADERS:
                yield one
            elif isinstance(one, EqualTo):
                self.predicates.append((column, "in", (one.value,)))
            elif isinstance(one, In):
                self.predicates.append((column, "in", tuple(one.value)))
            elif isinstance(one, StringStartsWith):
                self.predicates.append((column, "starts", (one.value,)))
            elif isinstance(one, IsNotNull):
                self.predicates.append((column, "present", ()))
            else:
                yield one

    def partitions(self):
        planned, held, size = [], [], 0
        for name, n in committed(self.path):
            if held and size + n > self.partition_bytes:
                planned.append(Files(tuple(held)))
                held, size = [], 0
            held.append(name)
            size += n
        return [*planned, Files(tuple(held))]

    def read(self, partition):
        held, size = [], 0
        for path in partition.paths:
            for head, block in records(path, lambda head: passes(head, self.predicates)):
                held.append(row_of(head, block, self.with_payload))
                size += len(block)
                if len(held) >= 1000 or size >= BATCH_BYTES:
                    yield as_batch(held)
                    held, size = [], 0
        if held:
            yield as_batch(held)


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), ARROW, strict=True)], schema=ARROW
    )


def member(record: bytes, level: int) -> bytes:
    """A gzip member that names its own length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    total = 10 + 2 + 12 + len(body) + 8
    tail = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    if total >= 1 << 32:
        return b"\x1f\x8b\x08\x00" + bytes(4) + b"\x00\xff" + body + tail
    extra = b"sl" + struct.pack("<HII", 8, total, len(record) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", len(extra)) + extra + body + tail


def record_bytes(row: dict) -> bytes:
    payload = row["payload"] or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    block = http.encode() + (b"" if row["record_type"] == "revisit" else payload)
    lines = ["WARC/1.1"]
    for column, header in HEADERS.items():
        if row[column] is not None:
            lines.append(f"{header.title().replace('Warc', 'WARC').replace('-Id', '-ID').replace('Uri', 'URI')}: {one_line(row[column])}")
    if row["record_type"] == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def one_line(value: str) -> str:
    return " ".join(value.split()) if any(c in value for c in "\r\n") else value


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool) -> None:
        self.path = options["path"]
        self.level = int(options.get("level", 3))
        self.overwrite = overwrite

    def write(self, iterator):
        name, out = f"part-{uuid.uuid4().hex}.warc.gz", None
        files, folder = pafs.FileSystem.from_uri(self.path)
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None:
                        files.create_dir(folder, recursive=True)
                        out = files.open_output_stream(f"{folder}/{name}", compression=None)
                    out.write(member(record_bytes(row), self.level))
        finally:
            if out is not None:
                out.close()
        return Written(name if out is not None else None)

    def commit(self, messages):
        files, folder = pafs.FileSystem.from_uri(self.path)
        files.create_dir(folder, recursive=True)
        old = [x.path for x in files.get_file_info(pafs.FileSelector(folder)) if x.base_name.startswith("_manifest-")]
        with files.open_output_stream(f"{folder}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps([m.name for m in messages if m and m.name]).encode())
        for path in old if self.overwrite else ():
            files.delete_file(path)

    def abort(self, messages):
        files, folder = pafs.FileSystem.from_uri(self.path)
        for one in messages:
            if one and one.name:
                files.delete_file(f"{folder}/{one.name}")


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(path)`` and ``df.write.format("warc").save(path)``.

    Options: ``payload`` (``false`` leaves payloads out of the rows), ``partitionBytes``,
    ``level`` (gzip level when writing).
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def page_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))


def page_records(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """A WARC record per row of ``pages`` (``page_id``, ``url``, ``html``).

    Of records with equal payloads of at least 100 bytes, the one with the
    smallest ``page_id`` keeps the payload; the others are revisits that refer to
    it. Null html is an empty payload, a null url or id has no header. Rows that
    repeat the smallest id are responses too; where all ids of a payload are
    null, all its records are responses. Other columns are ignored.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    full = pages.select(
        "page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("size")
    )
    shared = (
        full.filter(F.col("size") >= SMALLEST_SHARED)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
        .select("digest", "first")
    )
    joined = full.join(stage(shared), "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        page_urn(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        F.when(again, page_urn(F.col("first"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), F.col("digest")).alias("payload_digest"),
        F.col("size").cast("long").alias("payload_bytes"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def write_pages(pages: DataFrame, path: str) -> None:
    register(pages.sparkSession)
    page_records(pages).write.format("warc").mode("append").save(path)


def read_warc(spark: SparkSession, path: str, **options: str) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(**options).load(path)


def archive_round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` as archives, read them back, and return one digest row per record.

    Digests of responses are computed again from the payload that was read.
    """
    spark = pages.sparkSession
    path = path or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_pages(pages, path)
    read = read_warc(spark, path)
    number = lambda c: F.regexp_extract(c, "^<urn:page:(.*)>$", 1)
    kind = pages.schema["page_id"].dataType
    return read.select(
        number("record_id").cast(kind).alias("page_id"),
        "payload_bytes",
        F.when(F.col("payload").isNotNull(), F.sha2("payload", 256))
        .otherwise(F.substring("payload_digest", 8, 64))
        .alias("payload_digest"),
        "record_type",
        F.when(F.col("refers_to").isNotNull(), number("refers_to").cast(kind)).alias("refers_to"),
    )
