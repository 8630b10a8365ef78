"""Web archives: a writer, and a Python data source that reads headers first.

The source plans one partition for a group of files, takes filters on the record type, the target and
any other header column, and parses a record's headers before anything else: what the filters reject
and what the query doesn't ask for is skipped, not decoded.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith
from pyspark.sql.types import StructType

from listenlake.llm.columns import text_of
from listenlake.llm.files import opened
from listenlake.operators.durable import materialise, scratch_path

# Names and layout of the archive format.
VERSION = b"WARC/1.0"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
HEADER_OF = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "content_type": "content-type",
    "refers_to_uri": "warc-refers-to",
    "page_id": "x-page-id",
    "refers_to": "x-refers-to-page-id",
}
SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, content_type string,"
    " refers_to_uri string, page_id long, refers_to long, payload_bytes long, payload_digest string, payload binary"
)
FILE_BYTES, PARTITION_BYTES, BATCH_BYTES, BATCH_RECORDS = 256 << 20, 128 << 20, 4 << 20, 2000


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """One record; header values are kept on one line, and those without a value are left out."""
    lines = [VERSION]
    for name, value in [*headers, ("Content-Length", len(block))]:
        if value is not None:
            lines.append(f"{name}: {' '.join(str(value).split())}".encode())
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


class Output:
    """Files of a bounded size in one folder, each under a name of its own."""

    def __init__(self, folder: str, compress: bool):
        self.system, self.path = opened(folder)
        self.system.create_dir(self.path, recursive=True)
        self.compress, self.file, self.size, self.name = compress, None, 0, ""

    def write(self, data: bytes) -> str:
        if self.file is None or self.size > FILE_BYTES:
            self.close()
            self.name = f"{uuid.uuid4().hex}.warc" + ".gz" * self.compress
            self.file, self.size = self.system.open_output_stream(f"{self.path}/{self.name}", compression=None), 0
        data = gzip.compress(data, 1) if self.compress else data
        self.file.write(data)
        self.size += len(data)
        return self.name

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def headers_of(stream) -> dict[str, str] | None:
    """Headers of the next record, names in lower case; None at the end of the file."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a record: {line[:40]!r}")
    found = {}
    while (line := stream.readline().strip()):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def http_payload(block: bytes, content_type: str) -> bytes:
    """What follows the HTTP head, or the block itself where it is no HTTP message."""
    if not content_type.startswith("application/http"):
        return block
    return block.partition(b"\r\n\r\n")[2]


@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.columns, self.schema, self.options = schema.names, schema, options
        self.only: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = getattr(f, "attribute", ("",))[0]
            known = column in HEADER_OF and column not in ("page_id", "refers_to")
            if known and isinstance(f, EqualTo):
                self.only.append((column, "in", (f.value,)))
            elif known and isinstance(f, In):
                self.only.append((column, "in", tuple(f.value)))
            elif known and isinstance(f, StringStartsWith):
                self.only.append((column, "starts", f.value))
            else:
                yield f

    def partitions(self) -> list[Files]:
        system, path = opened(self.options["path"])
        found = [x for x in system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True)) if x.is_file]
        found = sorted((x for x in found if x.path.endswith((".warc", ".warc.gz"))), key=lambda x: (-x.size, x.path))
        out, size = [], 0
        for x in found:
            if not out or size + x.size > PARTITION_BYTES:
                out.append(Files([]))
                size = 0
            out[-1].paths.append(x.path)
            size += x.size
        return out or [Files([])]

    def wanted(self, headers: dict[str, str]) -> bool:
        for column, how, value in self.only:
            has = headers.get(HEADER_OF[column])
            if has is None or not (has in value if how == "in" else has.startswith(value)):
                return False
        return True

    def values(self, headers: dict[str, str], stream) -> dict:
        """Column values of the record whose block comes next; the block is read only where it must be."""
        length = int(headers.get("content-length", 0))
        out = {c: headers.get(h) for c, h in HEADER_OF.items() if c in self.columns}
        for c in ("page_id", "refers_to"):
            if out.get(c) is not None:
                out[c] = int(out[c])
        stated = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
        if headers.get("warc-type") == "revisit" or not {"payload", "payload_bytes", "payload_digest"} & {*self.columns}:
            stream.seek(length, 1)
            size = headers.get("x-payload-length")
            return out | {"payload": None, "payload_bytes": size and int(size), "payload_digest": stated}
        payload = http_payload(stream.read(length), headers.get("content-type", ""))
        digest = digest_of(payload) if "payload_digest" in self.columns else None
        if digest and stated and digest != stated:
            raise ValueError(f"record {headers.get('warc-record-id')} is damaged: {digest} isn't {stated}")
        return out | {"payload": payload, "payload_bytes": len(payload), "payload_digest": digest}

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        system, _ = opened(self.options["path"])
        schema = to_arrow_schema(self.schema)
        rows, size = [], 0
        for path in partition.paths:
            file = system.open_input_file(path)
            stream = gzip.GzipFile(fileobj=file) if path.endswith(".gz") else io.BufferedReader(file, 1 << 20)
            while (headers := headers_of(stream)) is not None:
                if not self.wanted(headers):
                    stream.seek(int(headers.get("content-length", 0)), 1)
                    continue
                found = self.values(headers, stream)
                rows.append(found)
                size += len(found["payload"] or b"") if "payload" in self.columns else 0
                if size > BATCH_BYTES or len(rows) >= BATCH_RECORDS:
                    yield self._batch(rows, schema)
                    rows, size = [], 0
            file.close()
        if rows:
            yield self._batch(rows, schema)

    def _batch(self, rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)``; a schema with fewer columns makes it read less."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)


def read_warc(spark: SparkSession, folder: str, columns: list[str] | None = None) -> DataFrame:
    """Records of all archives under ``folder``; ``columns`` names the only ones to read."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    fields = [f.strip() for f in SCHEMA.split(",")]
    kept = [f for f in fields if columns is None or f.split()[0] in columns]
    return spark.read.format("warc").schema(", ".join(kept)).load(folder)


def _numbered(pages: DataFrame) -> DataFrame:
    """Pages with ``digest`` and ``response_id``, and ``first``: whether the row is the response."""
    plain = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        (F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")).alias("url"),
        text_of("html").alias("html"),
    ).withColumns({"digest": F.sha1("html"), "size": F.octet_length("html").cast("long")})
    same = ["digest", "size"]
    groups = plain.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("response_id"))
    groups = materialise(groups, "payloads")
    rows = plain.join(groups, same).withColumn("first", F.col("page_id").eqNullSafe(F.col("response_id")))
    # rows that repeat page and payload of a response: one of them is it
    firsts = groups.where("n > 1").select(*same, "response_id")
    twice = plain.join(firsts, same).where(F.col("page_id").eqNullSafe(F.col("response_id"))).groupBy(*same)
    twice = materialise(twice.agg(F.count(F.lit(1)).alias("k")).where("k > 1").select(*same), "repeated")
    if twice.isEmpty():
        return rows
    order = Window.partitionBy(*same, "page_id").orderBy("url")
    odd = rows.join(twice, same, "left_semi")
    odd = odd.withColumn("first", F.col("first") & (F.row_number().over(order) == 1))
    return rows.join(twice, same, "left_anti").unionByName(odd)


def write_pages(pages: DataFrame, folder: str, least: int = 0, compress: bool = False, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write a record for every page; returns (file, records) of the files that count.

    Of equal payloads of ``least`` bytes or more the one with the smallest page id is a response and the
    others are revisits without payload. A null html is an empty payload. A task writes files of its own;
    what a repeated attempt leaves under other names is told apart by the result, which is why it is
    written down before it is returned.
    """
    names = ["page_id", "url", "html", "digest", "size", "response_id", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, counts = Output(folder, compress), {}
        try:
            for batch in batches:
                for page, url, html, digest, size, response, first in zip(*(c.to_pylist() for c in batch.columns)):
                    first = first or size < least
                    block = HTTP_HEAD % size + html.encode() if first else b""
                    text = base64.b32encode(bytes.fromhex(digest)).decode()
                    headers = [
                        ("WARC-Type", "response" if first else "revisit"),
                        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                        ("WARC-Date", date),
                        ("WARC-Target-URI", url),
                        ("WARC-Payload-Digest", f"sha1:{text}"),
                        ("Content-Type", "application/http; msgtype=response"),
                        ("X-Page-Id", page),
                        ("X-Payload-Length", size),
                    ]
                    if not first:
                        headers += [("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page-Id", response)]
                    name = out.write(record(headers, block))
                    counts[name] = counts.get(name, 0) + 1
        finally:
            out.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["file", "records"]
        )

    return materialise(_numbered(pages).select(names).mapInArrow(run, "file string, records long"), "archives")


def keep_only(folder: str, files: DataFrame) -> None:
    """Delete what failed attempts have left; only names of files, not of records, come to the driver."""
    system, path = opened(folder)
    kept = {row.file for row in files.select("file").distinct().toLocalIterator()}
    for x in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
        if x.is_file and x.base_name not in kept:
            system.delete_file(x.path)


def archived_pages(pages: DataFrame, least: int = 0) -> DataFrame:
    """Archive the pages, read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Needs ``page_id`` and ``html``, and ``url`` if there is one; other columns are ignored. Null ids are read back as
    null and, as the smallest id of a payload, come after all others. Of repeated rows one is the response
    and the others revisit it. An empty table gives an empty archive and no rows.
    """
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    keep_only(folder, write_pages(pages, folder, least, compress=True))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return read_warc(spark, folder, columns).select(columns)
