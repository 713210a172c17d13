"""WARC archives as a PySpark data source.

Reading plans partitions from file sizes, takes filters on the record type and on header columns, and
parses a record's headers first: the payload of a record that is filtered out, or of which no payload is
asked for, is skipped by its length and never decoded.

Paths are those of ``pyarrow.fs`` (local or mounted folders, s3, gcs, hdfs).
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import json
import uuid
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, WriterCommitMessage,
)

READ_TYPE = (
    "record_id string, record_type string, uri string, payload_digest string, payload_length long, "
    "refers_to string, headers map<string,string>, payload binary, payload_sha1 string"
)
WRITE_TYPE = "id string, uri string, payload binary, refers_to string"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
PARTITION_BYTES = 64 << 20
BATCH_BYTES, BATCH_ROWS = 4 << 20, 2_000
READ_BYTES = 64 << 10
# columns taken from headers
FIELDS = {
    "record_id": "warc-record-id", "record_type": "warc-type", "uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to",
}
LENGTH_FIELD = "warc-x-payload-length"
COMPARE = {
    EqualTo: lambda x, y: x is not None and x == y,
    In: lambda x, y: x is not None and x in y,
    GreaterThan: lambda x, y: x is not None and x > y,
    GreaterThanOrEqual: lambda x, y: x is not None and x >= y,
    LessThan: lambda x, y: x is not None and x < y,
    LessThanOrEqual: lambda x, y: x is not None and x <= y,
}


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path within it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    return fs.FileSystem.from_uri(path)


class Input:
    """Forward reading of one archive file, plain or gzip by its name."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.plain = not path.endswith(".gz")
        self.file = store.open_input_file(path) if self.plain else store.open_input_stream(path, compression="gzip")
        self.buffer = b""

    def headers(self) -> bytes | None:
        """The next block up to an empty line, without it; None at the end of the file."""
        end = self.buffer.find(b"\r\n\r\n")
        while end < 0:
            more = self.file.read(READ_BYTES)
            if not more:
                if self.buffer.strip():
                    raise ValueError("the archive ends within headers")
                return None
            self.buffer += more
            end = self.buffer.find(b"\r\n\r\n")
        block, self.buffer = self.buffer[:end], self.buffer[end + 4 :]
        return block

    def read(self, n: int) -> bytes:
        if n > len(self.buffer):
            self.buffer += self.file.read(n - len(self.buffer))
        if n > len(self.buffer):
            raise ValueError("the archive ends within a record")
        block, self.buffer = self.buffer[:n], self.buffer[n:]
        return block

    def skip(self, n: int) -> None:
        held = min(n, len(self.buffer))
        self.buffer = self.buffer[held:]
        n -= held
        if n and self.plain:
            self.file.seek(n, 1)
        while n and not self.plain:
            got = len(self.file.read(min(n, 1 << 20)))
            if not got:
                raise ValueError("the archive ends within a record")
            n -= got


def parse_headers(block: bytes) -> dict[str, str]:
    """Header names in lower case and their values; the version line gives none."""
    lines = block.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
    return {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines[1:] if ":" in line)}


def header_columns(headers: dict[str, str]) -> dict[str, object]:
    length = headers.get(LENGTH_FIELD)
    return {c: headers.get(name) for c, name in FIELDS.items()} | {"payload_length": None if length is None else int(length)}


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool, partition_bytes: int):
        self.path, self.payload, self.partition_bytes = path, payload, partition_bytes
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        """Takes comparisons, membership and null tests on columns that come from headers."""
        known = {*FIELDS, "payload_length"}
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in known and isinstance(f, (IsNull, IsNotNull)):
                self.tests.append((type(f).__name__, column, None))
            elif column in known and type(f) in COMPARE:
                self.tests.append((type(f).__name__, column, f.value))
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        """Committed archive files, neighbours together up to the partition size."""
        store, root = open_store(self.path)
        found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        manifests = [x.path for x in found if x.base_name.startswith("_committed-")]
        sizes = {x.path: x.size for x in found if x.path.endswith((".warc", ".warc.gz"))}
        if manifests:
            listed: set[str] = set()
            for m in manifests:
                with store.open_input_stream(m) as f:
                    listed |= set(json.loads(f.read()))
            sizes = {p: n for p, n in sizes.items() if p.rpartition("/")[2] in listed}
        groups: list[list[str]] = []
        room = 0
        for path in sorted(sizes):
            if sizes[path] > room:
                groups.append([])
                room = self.partition_bytes
            groups[-1].append(path)
            room -= sizes[path]
        return [InputPartition(g) for g in groups] or [InputPartition([])]

    def wanted(self, columns: dict[str, object]) -> bool:
        compare = {kind.__name__: test for kind, test in COMPARE.items()}
        for kind, column, value in self.tests:
            x = columns[column]
            if not ((x is None) == (kind == "IsNull") if kind in ("IsNull", "IsNotNull") else compare[kind](x, value)):
                return False
        return True

    def records(self, path: str) -> Iterator[dict[str, object]]:
        store, _ = open_store(self.path)
        source = Input(store, path)
        while (block := source.headers()) is not None:
            headers = parse_headers(block.lstrip(b"\r\n"))
            length = int(headers["content-length"])
            columns = header_columns(headers)
            if not self.wanted(columns):
                source.skip(length + 4)
                continue
            row = columns | {"headers": list(headers.items()), "payload": None, "payload_sha1": None}
            if self.payload and columns["record_type"] != "revisit":
                content = source.read(length)
                if headers.get("content-type", "").startswith("application/http"):
                    content = content.partition(b"\r\n\r\n")[2]
                row |= {"payload": content, "payload_sha1": sha1_base32(content)}
                source.skip(4)
            else:
                source.skip(length + 4)
            yield row

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            *((c, pa.string()) for c in ("record_id", "record_type", "uri", "payload_digest")), ("payload_length", pa.int64()),
            ("refers_to", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
            ("payload_sha1", pa.string()),
        ])
        rows: list[dict[str, object]] = []
        held = 0
        for path in partition.value:
            for row in self.records(path):
                rows.append(row)
                held += len(row["payload"] or b"")
                if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


class Committed(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    """Every task attempt writes files of its own; only those of committed tasks are listed and read."""

    def __init__(self, path: str, compress: bool, file_bytes: int, date: str):
        self.path, self.compress, self.file_bytes, self.date = path, compress, file_bytes, date

    def record(self, id_: str | None, uri: str | None, payload: bytes | None, refers_to: str | None) -> bytes:
        payload = payload or b""
        name = f"urn:x-record:{id_}" if id_ is not None else f"urn:uuid:{uuid.uuid4()}"
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
        block = http if refers_to is not None else http + payload
        lines = [
            "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{name}>",
            f"WARC-Date: {self.date}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
            f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}", f"WARC-X-Payload-Length: {len(payload)}",
        ]
        if uri is not None:
            lines.append("WARC-Target-URI: " + "".join(uri.splitlines()))
        if refers_to is not None:
            lines += [
                f"WARC-Refers-To: <urn:x-record:{refers_to}>",
                "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            ]
        return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        import zlib

        store, root = open_store(self.path)
        store.create_dir(root, recursive=True)
        files: list[str] = []
        out, size = None, 0
        for batch in iterator:
            columns = [batch.column(c) for c in ("id", "uri", "payload", "refers_to")]
            for i in range(batch.num_rows):
                if out is None or size >= self.file_bytes:
                    if out is not None:
                        out.close()
                    files.append(f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.compress)
                    out, size = store.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                data = self.record(*(c[i].as_py() for c in columns))
                if self.compress:
                    member = zlib.compressobj(1, wbits=31)
                    data = member.compress(data) + member.flush()
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
        return Committed(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = open_store(self.path)
        store.create_dir(root, recursive=True)
        files = [f for m in messages if m for f in m.files]
        with store.open_output_stream(f"{root}/_committed-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = open_store(self.path)
        for m in messages:
            for f in m.files if m else ():
                store.delete_file(f"{root}/{f}")


class WarcSource(DataSource):
    """Options: path; payload (read payloads, default true); partition_bytes; compress; file_bytes; date."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_TYPE

    def reader(self, schema) -> DataSourceReader:
        o = self.options
        return WarcReader(o["path"], o.get("payload", "true") == "true", int(o.get("partition_bytes", PARTITION_BYTES)))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        o = self.options
        now = datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        return WarcWriter(o["path"], o.get("compress", "false") == "true", int(o.get("file_bytes", PARTITION_BYTES)), o.get("date", now))


def write_archive(
    pages: DataFrame, path: str, min_bytes: int = 0, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
    compress: bool = False,
) -> None:
    """Writes one record per row to ``path``: a response, or a revisit of an earlier equal payload.

    Of equal payloads of at least ``min_bytes`` the one with the smallest id is the response and others
    revisit it; smaller payloads are all responses. A null payload is empty. A row with a null id is a
    response nobody revisits; rows that repeat the smallest id are all responses. A null address leaves its
    header out. An empty table gives an archive without records; other columns are ignored.

    Equal payloads are found by SHA-256, reduced within tasks; a hot payload meets its one first row in a
    join whose large partitions adaptive execution splits.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("_id"), F.col(uri_col).cast("string").alias("uri"), payload.alias("payload"))
    rows = rows.withColumn("_sha", F.when(F.octet_length("payload") >= min_bytes, F.sha2("payload", 256)))
    first = rows.filter(F.col("_sha").isNotNull()).groupBy(F.col("_sha").alias("_same")).agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    found = rows.join(first, F.col("_sha") == F.col("_same"), "left")
    refers = F.when(F.col("_first") < F.col("_id"), F.col("_first").cast("string"))
    records = found.select(F.col("_id").cast("string").alias("id"), "uri", "payload", refers.alias("refers_to"))
    pages.sparkSession.dataSource.register(WarcSource)
    records.write.format("warc").mode("append").option("path", path).option("compress", str(compress).lower()).save()


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """All records below ``path`` (see ``READ_TYPE``); filters on header columns reach the reader.

    ``payload_digest`` and ``payload_length`` are the headers' word, ``payload_sha1`` is worked out from a
    payload that was read. Revisits have no payload. Sets the session's filter pushdown for Python sources.
    """
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("path", path).option("payload", str(payload).lower()).load()


def record_number(column: str) -> Column:
    """The integer id in a record id written by ``write_archive``."""
    return F.regexp_extract(column, r"^<urn:x-record:(-?\d+)>$", 1).try_cast("long")
