"""WARC archives as a PySpark data source: filters on headers, payloads decoded only where wanted."""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from verdigris.session import scratch_path

#: Columns of records. ``payload`` is null unless the option ``payload`` is true.
SCHEMA = (
    "warc_type string, record_id string, target_uri string, warc_date string, payload_digest string, "
    "payload_length long, refers_to string, content_type string, payload binary"
)
#: Header names of the format, by column, and the profile of a revisit with an equal payload.
HEADERS = {
    "warc_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "payload_length": "WARC-Payload-Length",
    "refers_to": "WARC-Refers-To",
    "content_type": "Content-Type",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_records.json"
_DATE = "1970-01-01T00:00:00Z"
_READ = 1 << 20


def _open(path: str):
    """File system and path of a URI or an absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def record_bytes(row: dict) -> bytes:
    """One record: headers, an empty line, the block (an HTTP response, or none for a revisit), two line ends."""
    payload = row.get("payload")
    if payload is None or row["warc_type"] == "revisit":
        block = b""
    else:
        head = f"HTTP/1.1 200 OK\r\nContent-Type: {row.get('content_type') or 'text/html; charset=utf-8'}\r\nContent-Length: {len(payload)}\r\n\r\n"
        block = head.encode() + payload
    lines = ["WARC/1.1"]
    for column, name in HEADERS.items():
        value = row.get(column)
        if value is not None and column != "content_type":
            text = str(value).replace("\r", "%0D").replace("\n", "%0A")
            lines.append(f"{name}: {text}")
    if row["warc_type"] == "revisit":
        lines.append(f"WARC-Profile: {PROFILE}")
    lines.append("Content-Type: application/http; msgtype=response")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member with its own length in the extra field ``sl``, so that a reader can pass over it."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = 24 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size, len(data))
    head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def parse_headers(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8", "replace").split("\r\n")
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:]) if value}


class _Window:
    """Bytes of a file at any place, read ahead."""

    def __init__(self, file):
        self.file, self.size = file, file.size()
        self.start, self.data = 0, b""

    def get(self, at: int, n: int) -> bytes:
        if not (self.start <= at and at + n <= self.start + len(self.data)):
            self.start, self.data = at, self.file.read_at(min(max(n, _READ), self.size - at), at)
        return self.data[at - self.start : at - self.start + n]


class _Packed:
    """One gzip member, inflated only as far as asked."""

    def __init__(self, window: _Window, at: int, size: int):
        self.window, self.at, self.step = window, at, size
        self.packer = zlib.decompressobj(31)
        self.out = bytearray()
        self.small = True  # inflate a little for the headers, all there is for a payload

    def until(self, stop) -> bool:
        """Inflates till ``stop(bytes so far)`` holds or the member ends; whether it held."""
        while not stop(self.out):
            if self.packer.eof:
                return False
            rest = self.packer.unconsumed_tail
            if not rest:
                rest = self.window.get(self.at, min(self.step, self.window.size - self.at))
                if not rest:
                    raise ValueError("a WARC file ends inside a record")
                self.at += len(rest)
            self.out += self.packer.decompress(rest, 1 << 12 if self.small else 0)
        return True

    def end(self) -> int:
        """Where the next member begins, from the inflated whole."""
        self.until(lambda out: False)
        return self.at - len(self.packer.unused_data)


def read_records(path: str, wanted, need_payload: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, payload) of the records of one file for which ``wanted(headers)`` holds.

    Headers are parsed first. A record that isn't wanted, or whose payload isn't, is passed over by
    its length: in plain files always, in gzip files if the member tells it, else by inflating it.
    """
    system, place = _open(path)
    with system.open_input_file(place) as file:
        window = _Window(file)
        at = 0
        while at < window.size:
            if window.get(at, 2) == b"\x1f\x8b":
                head = window.get(at, min(24, window.size - at))
                known = len(head) == 24 and head[3] & 4 and head[12:14] == b"sl" and head[14:16] == b"\x08\x00"
                # as much at once as the member has, or little where that isn't known
                source = _Packed(window, at, struct.unpack("<I", head[16:20])[0] if known else 1 << 14)
                if not source.until(lambda out: b"\r\n\r\n" in out):
                    raise ValueError("a WARC record without an end of its headers")
                cut = source.out.index(b"\r\n\r\n")
                headers = parse_headers(bytes(source.out[:cut]))
                block = None
                if wanted(headers) and need_payload:
                    length = int(headers["content-length"])
                    source.small = False
                    source.until(lambda out: len(out) >= cut + 4 + length)
                    block = bytes(source.out[cut + 4 : cut + 4 + length])
                at = at + struct.unpack("<I", head[16:20])[0] if known else source.end()
            else:
                size = 1 << 12
                while b"\r\n\r\n" not in (data := window.get(at, min(size, window.size - at))):
                    if size >= window.size - at:
                        raise ValueError("a WARC record without an end of its headers")
                    size *= 2
                cut = data.index(b"\r\n\r\n")
                headers = parse_headers(data[:cut])
                length = int(headers["content-length"])
                block = window.get(at + cut + 4, length) if wanted(headers) and need_payload else None
                at += cut + 4 + length + 4
            if wanted(headers):
                yield headers, None if block is None else _payload(headers, block)


def _payload(headers: dict[str, str], block: bytes) -> bytes | None:
    if headers.get("warc-type") == "revisit":
        return None
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


@dataclass
class _File(InputPartition):
    path: str


@dataclass
class _Written(WriterCommitMessage):
    name: str | None
    records: int


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.need_payload = options.get("payload", "false").lower() == "true"
        self.verify = options.get("verify", "false").lower() == "true"
        self.filters: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equality, set membership and prefixes of header columns; the rest stays with Spark."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name not in HEADERS or name in ("payload_length", "content_type"):
                yield f
            elif isinstance(f, (EqualTo, EqualNullSafe)) and f.value is not None:
                self.filters.append((HEADERS[name].lower(), "in", (f.value,)))
            elif isinstance(f, In):
                self.filters.append((HEADERS[name].lower(), "in", tuple(f.value)))
            elif isinstance(f, StringStartsWith):
                self.filters.append((HEADERS[name].lower(), "prefix", (f.value,)))
            elif isinstance(f, IsNotNull):
                self.filters.append((HEADERS[name].lower(), "there", ()))
            else:
                yield f

    def wanted(self, headers: dict[str, str]) -> bool:
        for name, kind, values in self.filters:
            value = headers.get(name)
            if value is None or (kind == "in" and value not in values) or (kind == "prefix" and not value.startswith(values[0])):
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        """One per file: those of the manifest where there is one, else all archives of the folder."""
        from pyarrow import fs

        system, place = _open(self.path)
        manifest = system.get_file_info(f"{place}/{MANIFEST}")
        base = self.path.rstrip("/")
        if manifest.type == fs.FileType.File:
            with system.open_input_stream(manifest.path) as file:
                names = [f["name"] for f in json.loads(file.read())["files"]]
        elif system.get_file_info(place).type == fs.FileType.File:
            return [_File(self.path)]
        else:
            found = system.get_file_info(fs.FileSelector(place))
            names = sorted(f.base_name for f in found if f.base_name.endswith((".warc", ".warc.gz")))
        return [_File(f"{base}/{name}") for name in names] or [_File("")]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        names = [*HEADERS, "payload"]
        kinds = [pa.int64() if c == "payload_length" else pa.string() for c in HEADERS] + [pa.binary()]
        rows: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        if not partition.path:
            return
        for headers, payload in read_records(partition.path, self.wanted, self.need_payload or self.verify):
            if self.verify and payload is not None and headers.get("warc-payload-digest", "").startswith("sha256:"):
                if hashlib.sha256(payload).hexdigest() != headers["warc-payload-digest"][7:]:
                    raise ValueError(f"the payload of {headers.get('warc-record-id')} is not what its digest says")
            values = [headers.get(name.lower()) for name in HEADERS.values()]
            length = values[5]
            values[5] = int(length) if length is not None else None
            rows.append((*values, payload if self.need_payload else None))
            size += len(payload) if self.need_payload and payload else 200
            if len(rows) >= 5_000 or size >= 8_000_000:
                yield batch()
                rows, size = [], 0
        if rows:
            yield batch()


class WarcWriter(DataSourceArrowWriter):
    """One file per task under a name of its own; a file counts once the manifest names it."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        system, place = _open(self.path)
        system.create_dir(place, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        system, place = _open(f"{self.path}/{name}")
        records = 0
        with system.open_output_stream(place, compression=None) as out:
            for batch in iterator:
                for at in range(0, batch.num_rows, 64):
                    for row in batch.slice(at, 64).to_pylist():
                        out.write(member(record_bytes({"warc_date": _DATE} | row)))
                        records += 1
        return _Written(name, records)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files = [{"name": m.name, "records": m.records} for m in messages if m and m.records]
        system, place = _open(f"{self.path}/{MANIFEST}")
        with system.open_output_stream(place, compression=None) as out:
            out.write(json.dumps({"files": files}).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        for m in messages:
            if m and m.name:
                system, place = _open(f"{self.path}/{m.name}")
                system.delete_file(place)


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(folder)`` and ``df.write.format("warc").save(folder)``.

    Options of reading: ``payload`` (false: headers only, payloads are not decoded), ``verify`` (true: the
    SHA-256 of each payload read must be that of its header).
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


#: Payloads of fewer bytes are always stored.
LEAST_PAYLOAD = 100
_ID = "urn:page:"


def page_records(pages: DataFrame) -> DataFrame:
    """A record per page (page_id, url, html): a response, or a revisit of the smallest page with an equal payload.

    A null html is an empty payload. Only payloads of LEAST_PAYLOAD bytes or more are revisited; rows
    that share the smallest page_id are all responses. A null page_id or url leaves its header out (a null id
    is larger than any). Digests are grouped without the payloads; those that occur twice or more meet the
    pages in a join which adaptive execution can split.
    """
    named = pages.select(
        pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"), F.encode(F.coalesce(pages["html"], F.lit("")), "UTF-8").alias("payload")
    )
    digested = named.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload").cast("long"))
    large = digested.where(F.col("bytes") >= LEAST_PAYLOAD)
    first = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
    again = (F.col("first").isNotNull()) & (F.col("bytes") >= LEAST_PAYLOAD) & (F.col("page_id").isNull() | (F.col("page_id") != F.col("first")))
    return digested.join(first.drop("n"), "digest", "left").select(
        F.when(again, "revisit").otherwise("response").alias("warc_type"),
        F.concat(F.lit(f"<{_ID}"), F.col("page_id").cast("string"), F.lit(">")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(_DATE).alias("warc_date"),
        F.concat(F.lit("sha256:"), F.col("digest")).alias("payload_digest"),
        F.col("bytes").alias("payload_length"),
        F.when(again, F.concat(F.lit(f"<{_ID}"), F.col("first").cast("string"), F.lit(">"))).alias("refers_to"),
        F.lit("text/html; charset=utf-8").alias("content_type"),
        F.when(again, F.lit(None)).otherwise(F.col("payload")).cast("binary").alias("payload"),
    )


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the pages' records to WARC files and returns, from the files, what they say of each page.

    (page_id, payload_bytes, payload_digest, record_type, refers_to); payloads are checked against their digests
    as they are read, in the reading tasks. An empty table gives no file and no rows; repeated rows are repeated
    records; columns beyond page_id, url and html are not read.
    """
    spark = pages.sparkSession
    register(spark)
    target = path or scratch_path(spark, "warc")
    page_records(pages).write.format("warc").mode("append").save(target)
    records = spark.read.format("warc").option("verify", "true").load(target)
    number = F.regexp_extract("record_id", r"page:(-?\d+)>", 1)
    return records.where(F.col("warc_type").isin("response", "revisit")).select(
        F.when(number != "", number).cast("long").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        F.expr("substring(payload_digest, 8)").alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        F.when(F.col("refers_to").isNotNull(), F.regexp_extract("refers_to", r"page:(-?\d+)>", 1)).cast("long").alias("refers_to"),
    )
