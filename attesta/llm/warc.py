"""A WARC data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading plans one partition per run of archive files.  Predicates on record_type, page_id and refers_to are pushed into the
reader, which parses a record's header first and steps over the payload of an unwanted record, or of every record if the
schema asked for has no payload: an uncompressed archive is stepped over by seeking, a record-wise compressed one is inflated
no further than its header where an index (``.idx``, written beside each archive) tells where the next record starts.

Writing gives each task an archive of its own under a name of that attempt; the commit lists the archives of the attempts
that count, so a lost executor or a repeated task leaves no duplicate records.  Paths are local, or any that pyarrow's file
systems open (``file:``, ``hdfs:``, ``s3:``, ``gs:``); on a cluster the folder must be shared.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import Row, StructType

from attesta.session import scratch

SCHEMA = (
    "record_type string, page_id long, url string, payload_digest string, payload_bytes long, refers_to long, payload binary"
)
# fixed values of the format
VERSION, END = b"WARC/1.1", b"\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BATCH_BYTES = 16 << 20


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (pafs.LocalFileSystem(), path)


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(row: dict, page: int) -> str:
    """Name of the response that holds a page's payload, known to its revisits without a look at it."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{row["payload_digest"]}')}>"


def record(row: dict) -> tuple[bytes, bytes]:
    """Header and block of one record."""
    payload = row["payload"] if row["record_type"] == "response" else b""
    block = HTTP + (payload or b"")
    page, refers = row["page_id"], row["refers_to"]
    head = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", record_id(row, page) if row["record_type"] == "response" and page is not None else f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Refers-To", record_id(row, refers) if refers is not None else None),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", " ".join((row["url"] or "").split()) or None),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
        ("WARC-Profile", PROFILE if row["record_type"] == "revisit" else None),
        ("X-Page-ID", page),
        ("X-Refers-To-Page", refers),
        ("X-Payload-Length", row["payload_bytes"]),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    lines = [f"{k}: {v}".encode() for k, v in head if v is not None]
    return b"\r\n".join([VERSION, *lines]) + END, block + END


@dataclass
class Archive(InputPartition):
    paths: tuple[str, ...] = ()


@dataclass
class Written(WriterCommitMessage):
    names: tuple[str, ...] = ()


class WarcWriter(DataSourceWriter):
    """Options: path, compress (true: one gzip member per record), file_bytes (archives are closed beyond it)."""

    def __init__(self, options: dict, schema: StructType):
        self.path, self.compress = options["path"].rstrip("/"), options.get("compress", "true") == "true"
        self.file_bytes = int(options.get("file_bytes", 64 << 20))

    def write(self, rows: Iterator[Row]) -> WriterCommitMessage:
        disk, path = file_system(self.path)
        disk.create_dir(path, recursive=True)
        names, out, index, at = [], None, [], 0

        def close() -> None:
            if out is not None:
                out.close()
                with disk.open_output_stream(f"{path}/{names[-1]}.idx") as f:
                    f.write("\n".join(map(str, index)).encode())

        for row in rows:
            if out is None or at >= self.file_bytes:
                close()
                names.append(f"{uuid.uuid4().hex}.warc" + (".gz" if self.compress else ""))
                out, index, at = disk.open_output_stream(f"{path}/{names[-1]}", compression=None), [], 0
            head, block = record(row.asDict())
            if self.compress:
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                data = packer.compress(head) + packer.flush(zlib.Z_SYNC_FLUSH) + packer.compress(block) + packer.flush()
            else:
                data = head + block
            index.append(at)
            out.write(data)
            at += len(data)
        close()
        return Written(tuple(names))

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        disk, path = file_system(self.path)
        disk.create_dir(path, recursive=True)
        names = sorted(n for m in messages if m for n in m.names)
        with disk.open_output_stream(f"{path}/_archives-{uuid.uuid4().hex}.json") as f:
            f.write(json.dumps(names).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        disk, path = file_system(self.path)
        for name in (n for m in messages if m for n in m.names):
            for full in (f"{path}/{name}", f"{path}/{name}.idx"):
                if disk.get_file_info(full).type == pafs.FileType.File:
                    disk.delete_file(full)


class _Inflater:
    """Reads the gzip member that starts at an offset, no further than asked."""

    def __init__(self, source, at: int):
        source.seek(at)
        self.source, self.unpack, self.ready, self.at = source, zlib.decompressobj(31), b"", at

    def _more(self) -> bool:
        if self.unpack.eof:
            return False
        data = self.source.read(1 << 14)
        if not data:
            return False
        self.at += len(data)
        self.ready += self.unpack.decompress(data)
        return True

    def until(self, mark: bytes) -> bytes:
        while mark not in self.ready:
            if not self._more():
                return b""
        found, _, self.ready = self.ready.partition(mark)
        return found

    def take(self, n: int) -> bytes:
        parts, have = [self.ready], len(self.ready)
        while have < n:
            self.ready = b""
            if not self._more():
                break
            parts.append(self.ready)
            have += len(self.ready)
        data = b"".join(parts)
        self.ready = data[n:]
        return data[:n]

    def next_member(self) -> int:
        while not self.unpack.eof and self._more():
            self.ready = b""
        return self.at - len(self.unpack.unused_data)


def headers(raw: bytes) -> dict[str, str]:
    return dict(x.split(": ", 1) for x in raw.decode("utf-8", "replace").split("\r\n")[1:] if ": " in x)


class WarcReader(DataSourceReader):
    """Options: path, split_bytes (archives of at most so many bytes together make a partition)."""

    def __init__(self, options: dict, schema: StructType):
        self.path, self.schema = options["path"].rstrip("/"), schema
        self.split_bytes = int(options.get("split_bytes", 32 << 20))
        self.wanted: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute in (("record_type",), ("page_id",), ("refers_to",)):
                self.wanted.append((f.attribute[0], frozenset([f.value] if isinstance(f, EqualTo) else f.value)))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        disk, path = file_system(self.path)
        found = {f.base_name: f for f in disk.get_file_info(pafs.FileSelector(path, allow_not_found=True)) if f.is_file}
        listed = [n for n in sorted(found) if n.startswith("_archives-")]
        names = [n for n in sorted(found) if n.endswith((".warc", ".warc.gz"))]
        if listed:  # written by this source: only what was committed
            names = []
            for n in listed:
                with disk.open_input_stream(f"{path}/{n}") as f:
                    names += json.loads(f.read())
        runs, held = [[]], 0
        for n in names:
            if runs[-1] and held + found[n].size > self.split_bytes:
                runs.append([])
                held = 0
            runs[-1].append(f"{path}/{n}")
            held += found[n].size
        return [Archive(tuple(r)) for r in runs]

    def _row(self, head: dict[str, str]) -> dict:
        number = lambda k: int(head[k]) if k in head else None
        return {
            "record_type": head.get("WARC-Type"),
            "page_id": number("X-Page-ID"),
            "url": head.get("WARC-Target-URI"),
            "payload_digest": head.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None,
            "payload_bytes": number("X-Payload-Length"),
            "refers_to": number("X-Refers-To-Page"),
        }

    def _records(self, disk: pafs.FileSystem, path: str) -> Iterator[dict]:
        with_payload = "payload" in self.schema.names
        packed = path.endswith(".gz")
        index = None
        if disk.get_file_info(f"{path}.idx").is_file:
            with disk.open_input_stream(f"{path}.idx") as f:
                index = [int(x) for x in f.read().split()]
        with disk.open_input_file(path) as source:
            at, size, k = 0, source.size(), 0
            while at < size:
                begin = at
                if packed:
                    member = _Inflater(source, at)
                    head = headers(member.until(END))
                else:
                    source.seek(at)
                    raw = source.read(1 << 12)
                    while END not in raw and (more := source.read(1 << 12)):
                        raw += more
                    head = headers(raw.partition(END)[0])
                    at += raw.find(END) + len(END)
                if not head.get("Content-Length", "").isdigit() or "WARC-Type" not in head:
                    raise ValueError(f"{path}: no record header at byte {begin} (record {k})")
                length, row = int(head["Content-Length"]), self._row(head)
                if all(row[c] in v for c, v in self.wanted):
                    if with_payload:
                        if packed:
                            block = member.take(length)
                        else:
                            source.seek(at)
                            block = source.read(length)
                        row["payload"] = block.partition(END)[2] if row["record_type"] == "response" else None
                    yield row
                k += 1
                if not packed:
                    at += length + len(END)
                elif index is not None and k < len(index):
                    if not at < index[k] < size:
                        raise ValueError(f"{path}.idx does not fit the archive at record {k}")
                    at = index[k]
                else:  # an index that ends early is followed by the members themselves
                    at = member.next_member()

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        rows, held = [], 0
        for path in partition.paths:
            disk, _ = file_system(self.path)
            for row in self._records(disk, path):
                rows.append(row)
                held += 200 + len(row.get("payload") or b"")
                if held > BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


class Warc(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("archives are only added to; choose a new folder")
        return WarcWriter(self.options, schema)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Warc)


def records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """A record per page in the columns of the source.

    The payload is the html in UTF-8 (null: empty).  Of records with equal payloads of at least ``min_bytes`` bytes, that
    with the smallest page_id is the response and the others are revisits of it; smaller payloads are all responses.  Rows
    that share the smallest page_id are all responses; a row without page_id is a revisit if any equal payload has one,
    else a response.  Further columns of ``pages`` are ignored.
    """
    rows = pages.select(
        F.col("`page_id`").alias("page_id"), F.col("`url`").alias("url"),
        F.coalesce(F.col("`html`"), F.lit("")).cast("binary").alias("payload"),
    )
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("sha", F.sha1("payload"))
    # one row per digest, written: against a stored side, adaptive execution splits the copies of a hot payload over tasks
    first = rows.filter(F.col("payload_bytes") >= min_bytes).groupBy("sha").agg(F.min("page_id").alias("first"))
    path = scratch(pages.sparkSession, "warc-first")
    first.write.parquet(path)
    joined = rows.join(pages.sparkSession.read.parquet(path), "sha", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    base32 = base32_of_hex(F.col("sha"))
    return joined.select(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        "page_id", "url", base32.alias("payload_digest"), "payload_bytes",
        F.when(revisit, F.col("first")).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def verified(responses: DataFrame) -> DataFrame:
    """Responses with length and digest worked out from the payload that was read; a difference to the header stops the job."""
    size, digest = F.octet_length("payload").cast("long"), base32_of_hex(F.sha1("payload"))
    damaged = F.raise_error(F.concat_ws(" ", F.lit("payload does not fit its header: page"), F.col("page_id").cast("string")))
    fits = (digest == F.col("payload_digest")) & (size == F.coalesce(F.col("payload_bytes"), size))
    checked = responses.filter(F.when(F.coalesce(fits, F.lit(False)), F.lit(True)).otherwise(damaged.cast("boolean")))
    return checked.withColumns({"payload_bytes": size, "payload_digest": digest})


def base32_of_hex(sha: Column) -> Column:
    """40 hex digits → 32 base-32 digits: 10 hex digits are 40 bits are 8 base-32 digits."""
    parts = [F.lpad(F.conv(F.substring(sha, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    # fixed values: digits as conv() writes them and the base-32 alphabet
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, compress: bool = True) -> None:
    """Write a record per page under ``path``; an empty table gives a folder without archives."""
    register(pages.sparkSession)
    out = records(pages, min_bytes).write.format("warc").mode("append")
    out.option("path", path).option("compress", str(compress).lower()).save()


def read_archives(spark: SparkSession, path: str, columns: str = SCHEMA) -> DataFrame:
    """Records under ``path``; without ``payload`` among the columns no payload is decoded."""
    register(spark)
    return spark.read.format("warc").schema(columns).option("path", path).load()
