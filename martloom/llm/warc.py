"""WARC archives: writing, normalising monolithic gzip files, and reading records by their offsets.

A monolithic archive is one gzip stream; none of its records can be reached without inflating all before it. The
normaliser inflates such a stream once, writes each record as a gzip member of its own, and beside the archive an index
with the place of every member. The index is a table of small rows, so any number of tasks can share the records of one
archive.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import col, map_batches, materialize, slices
from martloom.llm.files import AtomicFile, store

# Payloads below this size are stored again; uncompressed bytes after which a new archive begins.
SHARED_FROM = 100
ARCHIVE_BYTES = 1 << 30
CHUNK = 1 << 16
READ_BYTES = 32 << 20
GZIP = 31  # window bits that make zlib read and write gzip members
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVE = "pages-{:06d}-{:04d}.warc.gz"
INDEX = ".index.jsonl"
INDEX_SCHEMA = "archive string, offset long, length long, type string, id string, uri string, digest string"


def record_id(page: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, page)}>"


def record(kind: str, fields: dict[str, str | None], block: bytes) -> bytes:
    """One WARC record; fields without a value are left out."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return f"WARC/1.1\r\nWARC-Type: {kind}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def page_record(page: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """A response with the payload, or a revisit that names the page which has it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = {
        "WARC-Record-ID": record_id(str(page)), "WARC-Date": DATE,
        # Anything that could end the line is escaped.
        "WARC-Target-URI": None if url is None else quote(url, safe="/:?#[]@!$&'()*+,;=%~"),
        "WARC-Payload-Digest": f"sha256:{digest}", "X-Payload-Length": str(len(payload)), "X-Page-ID": page,
        "Content-Type": "application/http; msgtype=response",
    }
    if refers_to is None:
        return record("response", fields, http + payload)
    fields |= {"WARC-Refers-To": record_id(refers_to), "X-Refers-To-Page": refers_to, "WARC-Profile": PROFILE}
    return record("revisit", fields, http)


def parsed(head: bytes) -> dict[str, str]:
    """The fields of a record's head, names in lower case."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:60]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:] if line)}


class Inflated:
    """The inflated bytes of a gzip file, one member or many, read once from front to back."""

    def __init__(self, source):
        self.source, self.inflate, self.ready = source, zlib.decompressobj(GZIP), bytearray()
        self.compressed = b""

    def _more(self) -> bool:
        """Inflate another chunk; false at the end of the file."""
        while True:
            data = self.compressed or self.source.read(CHUNK)
            self.compressed = b""
            if self.inflate.eof and data:
                self.inflate = zlib.decompressobj(GZIP)
            if not data:
                if self.inflate.eof:
                    return False
                raise ValueError("the gzip stream ends early")
            out = self.inflate.decompress(data)
            self.compressed = self.inflate.unused_data
            if out:
                self.ready += out
                return True

    def head(self) -> bytes | None:
        """The next record's head with the blank line, or None at the end."""
        start = 0
        while (end := self.ready.find(b"\r\n\r\n", start)) < 0:
            start = max(0, len(self.ready) - 3)
            if not self._more():
                if self.ready.strip():
                    raise ValueError("the archive ends inside a record")
                return None
        out = bytes(self.ready[: end + 4])
        del self.ready[: end + 4]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes."""
        while n:
            if not self.ready and not self._more():
                raise ValueError("the archive ends inside a record")
            piece = bytes(self.ready[: min(n, len(self.ready))])
            del self.ready[: len(piece)]
            n -= len(piece)
            yield piece


def mark_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page, url, payload, digest, refers_to``: of equal payloads the page with the smallest id is referred to.

    Payloads below ``SHARED_FROM`` bytes, pages without an id and rows that repeat that smallest id refer to none.
    """
    rows = pages.select(
        col(id_col).alias("page"), col(url_col).cast("string").alias("url"),
        F.coalesce(col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    shared = rows.filter(F.octet_length("payload") >= SHARED_FROM).groupBy("digest")
    shared = shared.agg(F.min("page").alias("first"), F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL").drop("n")
    # Both sides are plain scans, so the rows of a hot payload are split.
    joined = rows.join(materialize(shared, "warc-shared").hint("merge"), "digest", "left")
    refers_to = F.when(F.col("page").isNotNull() & (F.col("page") != F.col("first")), F.col("first"))
    return joined.select(F.col("page").cast("string").alias("page"), "url", "payload", "digest", refers_to.cast("string").alias("refers_to"))


def write_monolithic(marked: DataFrame, out: str) -> DataFrame:
    """Write archives of one gzip stream each below ``out``; returns ``archive, records`` per file."""
    schema = T.StructType([T.StructField("archive", T.StringType()), T.StructField("records", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        task = TaskContext.get()
        file, name, stream, count, size, number = None, "", None, 0, 0, 0

        def close() -> list:
            file.sink.write(stream.flush())
            file.close()
            return [pa.array([name]), pa.array([count], pa.int64())]

        for batch in batches:
            for part in slices(batch, "payload"):
                for row in part.to_pylist():
                    if file is None:
                        name = ARCHIVE.format(task.partitionId(), number)
                        file, stream, count, size = AtomicFile(f"{out}/{name}", task.taskAttemptId()), zlib.compressobj(6, wbits=GZIP), 0, 0
                        number += 1
                    data = page_record(row["page"], row["url"], row["payload"], row["digest"], row["refers_to"])
                    file.sink.write(stream.compress(data))
                    count, size = count + 1, size + len(data)
                    if size >= ARCHIVE_BYTES:
                        yield close()
                        file = None
        if file:
            yield close()

    return materialize(map_batches(marked.select("page", "url", "payload", "digest", "refers_to"), run, schema), "warc-written")


def normalise_file(source: str, out: str, name: str, attempt: int) -> int:
    """Rewrite one archive and write its index; returns the number of records."""
    fs, path = store(source)
    archive, index = AtomicFile(f"{out}/{name}", attempt), AtomicFile(f"{out}/{name}{INDEX}", attempt)
    count = offset = 0
    with fs.open_input_stream(path, compression=None) as stream:
        inflated = Inflated(stream)
        while (head := inflated.head()) is not None:
            fields = parsed(head)
            member, length = zlib.compressobj(6, wbits=GZIP), 0
            for piece in chain([head], inflated.pieces(int(fields["content-length"]) + 4), [None]):
                packed = member.flush() if piece is None else member.compress(piece)
                archive.sink.write(packed)
                length += len(packed)
            entry = {
                "archive": name, "offset": offset, "length": length, "type": fields.get("warc-type"),
                "id": fields.get("warc-record-id"), "uri": fields.get("warc-target-uri"), "digest": fields.get("warc-payload-digest"),
            }
            index.sink.write(json.dumps(entry).encode() + b"\n")
            offset, count = offset + length, count + 1
    archive.close()
    index.close()
    return count


def normalise(archives: DataFrame, source: str, out: str) -> DataFrame:
    """Rewrite the archives named in column ``archive`` from below ``source`` to below ``out``, one file per task at a time.

    Returns ``archive, records``. Archives that have members already come out the same. A broken stream is an error.
    """
    schema = T.StructType([T.StructField("archive", T.StringType()), T.StructField("records", T.LongType())])
    n = archives.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                yield [pa.array([name]), pa.array([normalise_file(f"{source}/{name}", out, name, attempt)], pa.int64())]

    spread = archives.select("archive").repartition(max(1, n))
    return materialize(map_batches(spread, run, schema), "warc-normalised")


def read_index(spark: SparkSession, out: str) -> DataFrame:
    """The rows of all indexes below ``out``."""
    return spark.read.schema(INDEX_SCHEMA).json(f"{out}/*{INDEX}")


def read_records(index: DataFrame, out: str) -> DataFrame:
    """``page, record_type, refers_to, uri, payload, payload_bytes, payload_digest`` of the records in ``index``.

    Each is inflated from its own offset. A revisit has no payload here; size and digest are those it carries.
    """
    schema = T.StructType([
        *[T.StructField(c, T.StringType()) for c in ("page", "record_type", "refers_to", "uri")], T.StructField("payload", T.BinaryType()),
        T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    ])
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, int(total // READ_BYTES) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        name = file = None
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for entry in batch.to_pylist():
                if entry["archive"] != name:
                    name = entry["archive"]
                    fs, path = store(f"{out}/{name}")
                    file = fs.open_input_file(path)
                file.seek(entry["offset"])
                data = zlib.decompress(file.read(entry["length"]), GZIP)
                head, _, rest = data.partition(b"\r\n\r\n")
                fields = parsed(head)
                block = rest[: int(fields["content-length"])]
                payload = block.partition(b"\r\n\r\n")[2] if fields["warc-type"] == "response" else None
                rows.append((
                    fields.get("x-page-id"), fields["warc-type"], fields.get("x-refers-to-page"), fields.get("warc-target-uri"), payload,
                    int(fields["x-payload-length"]) if payload is None else len(payload),
                    fields["warc-payload-digest"].removeprefix("sha256:") if payload is None else None,
                ))
                size += len(payload or b"")
                if size >= READ_BYTES // 4:
                    yield [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                    rows, size = [], 0
            if rows:
                yield [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]

    kinds = [pa.string()] * 4 + [pa.binary(), pa.int64(), pa.string()]
    spread = index.select("archive", "offset", "length").repartitionByRange(tasks, "archive", "offset")
    read = map_batches(spread.sortWithinPartitions("archive", "offset"), run, schema)
    # The digest of a response is taken from the payload that was read.
    return read.withColumn("payload_digest", F.coalesce(F.sha2("payload", 256), "payload_digest"))


def round_trip(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write ``pages`` as monolithic archives below ``folder``, normalise them and read them back by their indexes.

    Per row: the id, ``record_type`` (response or revisit), ``refers_to``, ``payload`` (null for revisits), ``payload_bytes``
    and ``payload_digest`` of the full payload.

    * Null html is an empty payload; a null URL writes none; a null id comes back as null and is a response.
    * Rows that repeat id and payload are all written. Other columns are not. An empty table writes no archive.
    """
    raw, packed = f"{folder}/monolithic", f"{folder}/normalised"
    written = write_monolithic(mark_revisits(pages, id_col, url_col, html_col), raw)
    kind = pages.schema[id_col].dataType
    if written.isEmpty():
        records = pages.sparkSession.createDataFrame(
            [], "page string, record_type string, refers_to string, payload binary, payload_bytes long, payload_digest string"
        )
    else:
        normalise(written, raw, packed)
        records = read_records(read_index(pages.sparkSession, packed), packed)
    return records.select(
        F.col("page").cast(kind).alias(id_col), "record_type", F.col("refers_to").cast(kind).alias("refers_to"),
        "payload", "payload_bytes", "payload_digest",
    )
