"""WARC archives as tables: one record per page, and chunks of payload read back."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendmill.session import scratch_path, stage

CHUNK_BYTES = 1 << 20
FILE_BYTES = 64 << 20  # an archive file is closed beyond this
MIN_SHARED_BYTES = 1000  # smaller payloads are stored again and again
DATE = "2000-01-01T00:00:00Z"  # the pages have no time of their own

FILES = "path STRING, records BIGINT, bytes BIGINT"
CHUNKS = """page_id BIGINT, url STRING, record_type STRING, refers_to BIGINT, chunk INT, data BINARY,
    bytes_so_far BIGINT, digest_so_far STRING, last BOOLEAN, payload_bytes BIGINT, intact BOOLEAN"""
CHUNK_FIELDS = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("chunk", pa.int32()), ("data", pa.binary()), ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()),
        ("last", pa.bool_()), ("payload_bytes", pa.int64()), ("intact", pa.bool_()),
    ]
)


def with_revisits(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """The records to be written for the pages.

    Of equal payloads (by SHA-1 and length) of MIN_SHARED_BYTES or more, the page with the largest
    id is the response and the others are revisits of it, without payload. Rows that repeat the
    largest id are responses as well; if no page of a group has an id, all of them are. Null html
    is an empty payload; line breaks in a URL are percent-encoded.
    """
    payload = F.coalesce(F.col(f"`{html_column}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"), F.col(f"`{url_column}`").cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha1("payload"))
    shared = rows.where(F.col("payload_bytes") >= MIN_SHARED_BYTES).groupBy("payload_digest", "payload_bytes").agg(
        F.count("*").alias("n"), F.max("page_id").alias("first")
    )
    shared = stage(shared.where("n > 1 AND first IS NOT NULL").drop("n"), "shared")
    joined = rows.join(shared, ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to"),
    )


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that Spark names by URI."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _uri_of(page_id: int | None) -> str:
    return "<urn:page:unknown>" if page_id is None else f"<urn:page:{page_id}>"


def _page_of(uri: str | None) -> int | None:
    number = (uri or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def _head(row: dict) -> bytes:
    """All of a record before its payload: WARC header and the header of the HTTP answer."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    length = len(http) + (len(row["payload"]) if row["record_type"] == "response" else 0)
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {_uri_of(row['page_id'])}", f"WARC-Date: {DATE}"]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + row["url"].replace("\r", "%0D").replace("\n", "%0A"))
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Refers-To: {_uri_of(row['refers_to'])}")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {length}"]
    return "\r\n".join([*lines, "", http]).encode()


class _Archive:
    """A file of records, each a gzip member of its own."""

    def __init__(self, folder: str, number: int):
        task = TaskContext.get()
        self.path = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{number:04d}.warc.gz"
        system, path = _place(self.path)
        self.out, self.records = system.open_output_stream(path, compression=None), 0

    def add(self, row: dict) -> None:
        squeeze = zlib.compressobj(4, wbits=31)
        self.out.write(squeeze.compress(_head(row)))
        payload = memoryview(row["payload"] or b"")
        for at in range(0, len(payload), CHUNK_BYTES):
            self.out.write(squeeze.compress(payload[at : at + CHUNK_BYTES]))
        self.out.write(squeeze.compress(b"\r\n\r\n") + squeeze.flush())
        self.records += 1

    def close(self) -> dict:
        size = self.out.tell()
        self.out.close()
        return {"path": self.path, "records": self.records, "bytes": size}


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write the records as .warc.gz files below ``folder``; path, records and bytes of each file.

    ``folder`` must be on a file system that all executors share. An attempt of a task writes files
    of its own name, and only those of the attempt that succeeded are in the returned table, which
    is stored; so a task that is run again does no harm.
    """
    system, path = _place(folder)
    system.create_dir(path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, made, number = None, [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                archive = archive or _Archive(folder, number)
                archive.add(batch.slice(i, 1).to_pylist()[0])
                if archive.out.tell() >= FILE_BYTES:
                    made.append(archive.close())
                    archive, number = None, number + 1
        if archive:
            made.append(archive.close())
        fields = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
        yield pa.RecordBatch.from_pylist(made, schema=fields)

    return stage(records.mapInArrow(work, FILES), "archives")


def _records(stream: io.BufferedReader) -> Iterator[dict]:
    """The chunks of the payloads in an archive, read one after the other."""
    while line := stream.readline():
        if not line.strip():
            continue
        fields = {}
        while (line := stream.readline().strip()):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.lower()] = value.strip()
        left, length = int(fields["content-length"]), 0
        while left and (line := stream.readline(left)).strip():
            left -= len(line)
            if line.lower().startswith(b"content-length:"):
                length = int(line.split(b":")[1])
        left -= len(line)
        stored = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
        row = {
            "page_id": _page_of(fields["warc-record-id"]), "record_type": fields["warc-type"], "payload_bytes": length,
            "url": fields.get("warc-target-uri"), "refers_to": _page_of(fields.get("warc-refers-to")), "data": None,
        }
        if fields["warc-type"] == "revisit":
            yield row | {"chunk": 0, "bytes_so_far": length, "digest_so_far": stored, "last": True, "intact": True}
            continue
        digest, so_far, chunk = hashlib.sha1(), 0, 0
        while True:
            data = stream.read(min(left, CHUNK_BYTES))
            left, so_far = left - len(data), so_far + len(data)
            digest.update(data)
            last = not left or not data
            intact = not last or (digest.hexdigest() == stored and so_far == length)
            yield row | {"chunk": chunk, "data": data, "bytes_so_far": so_far, "digest_so_far": digest.hexdigest(), "last": last, "intact": intact}
            chunk += 1
            if last:
                break


def read_archives(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Chunks of the records in the files of ``write_archives``; see CHUNKS.

    A payload comes as rows of at most CHUNK_BYTES with a running count and SHA-1; the row marked
    ``last`` has those of the whole payload, and whether they are what the header says. An empty
    payload has one empty chunk. A revisit has no data; its length and digest are from its header.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch["path"].to_pylist():
                system, path = _place(uri)
                with system.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as plain:
                    held, size = [], 0
                    for row in _records(io.BufferedReader(plain, 1 << 16)):
                        held.append(row)
                        size += len(row["data"] or b"") + 200
                        if size >= CHUNK_BYTES:
                            yield pa.RecordBatch.from_pylist(held, schema=CHUNK_FIELDS)
                            held, size = [], 0
                    yield pa.RecordBatch.from_pylist(held, schema=CHUNK_FIELDS)

    spread = files.select("path").repartition(spark.sparkContext.defaultParallelism * 4, "path")
    return spread.mapInArrow(work, CHUNKS)


def archive(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages as archives (in a new shared folder, if none is given) and read these as chunks."""
    spark = pages.sparkSession
    return read_archives(spark, write_archives(with_revisits(pages), folder or scratch_path(spark, "warc")))
