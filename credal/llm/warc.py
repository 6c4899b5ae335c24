"""WARC archives as a Spark data source, read and written.

``spark.read.format("warc").load(folder)`` plans one partition per group of
files, reads a record's headers first and evaluates pushed predicates on
record type and other header columns there; the block of a record that is
filtered out, or whose payload is not asked for (``option("payload", "false")``),
is skipped without being decoded. ``df.write.format("warc").save(folder)`` writes
one file per task; a task's file gets its final name when the job commits, so
attempts that failed or were repeated leave nothing that a reader takes.

Files are read through pyarrow's file systems. ``.warc`` files are seekable;
``.warc.gz`` files (one gzip member per record) are streamed, and ``offset`` counts their
unpacked bytes.
"""

from __future__ import annotations

import base64
import gzip
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition,
                                    IsNotNull, StringStartsWith, WriterCommitMessage)

from credal.llm.common import open_fs, shared_path

SCHEMA = ("record_type string, record_id string, target_uri string, date string, refers_to string, "
          "payload_digest string, payload_bytes long, payload binary, file string, offset long")
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
#: columns known from the headers alone, on which predicates are pushed
HEADER_COLUMNS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
                  "date": "warc-date", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PARTITION_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
DATE = "2000-01-01T00:00:00Z"


def _bare(name: str, value: str | None) -> str | None:
    """A header's value as a column: ids without angle brackets, SHA-1 as hex."""
    if value is None:
        return None
    if name in ("warc-record-id", "warc-refers-to"):
        return value.strip("<>")
    if name == "warc-payload-digest" and value.lower().startswith("sha1:"):
        digest = value[5:]
        return base64.b32decode(digest.upper()).hex() if len(digest) == 32 else digest.lower()
    return value


class Predicate:
    """A pushed conjunction on header columns."""

    def __init__(self):
        self.terms: list[tuple[str, str, object]] = []

    def take(self, f) -> bool:
        """Whether the filter is one that headers alone decide."""
        if len(getattr(f, "attribute", ())) != 1 or f.attribute[0] not in HEADER_COLUMNS:
            return False
        name = HEADER_COLUMNS[f.attribute[0]]
        if isinstance(f, EqualTo):
            self.terms.append((name, "in", {f.value}))
        elif isinstance(f, In):
            self.terms.append((name, "in", set(f.value)))
        elif isinstance(f, IsNotNull):
            self.terms.append((name, "some", None))
        elif isinstance(f, StringStartsWith):
            self.terms.append((name, "starts", f.value))
        else:
            return False
        return True

    def holds(self, headers: dict[str, str]) -> bool:
        for name, kind, arg in self.terms:
            v = _bare(name, headers.get(name))
            if v is None or (kind == "in" and v not in arg) or (kind == "starts" and not v.startswith(arg)):
                return False
        return True


def read_headers(file) -> dict[str, str] | None:
    """Headers of the next record, names lower-cased; None at the end."""
    line = file.readline()
    while line in (b"\r\n", b"\n"):
        line = file.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record where one should begin: {line[:40]!r}")
    headers: dict[str, str] = {}
    last = None
    while (line := file.readline()) not in (b"\r\n", b"\n"):
        if not line:
            raise ValueError("the file ends inside a record's headers")
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in " \t" and last:
            headers[last] += " " + text.strip()
            continue
        name, _, value = text.partition(":")
        last = name.strip().lower()
        headers[last] = value.strip()
    return headers


def split_http(block: bytes) -> tuple[dict[str, str], bytes]:
    """HTTP headers (lower-case names) and payload of a response block."""
    head, sep, body = block.partition(b"\r\n\r\n")
    if not sep:
        head, _, body = block.partition(b"\n\n")
    lines = head.decode("utf-8", "replace").splitlines()[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, body


def records(file, predicate: Predicate | None = None, payload: bool = True, seekable: bool = True) -> Iterator[dict]:
    """Records of an open archive that pass the predicate, as column values."""
    while True:
        offset = file.tell()
        headers = read_headers(file)
        if headers is None:
            return
        length = int(headers.get("content-length", 0))
        wanted = predicate is None or predicate.holds(headers)
        http = headers.get("content-type", "").startswith("application/http")
        revisit = headers.get("warc-type") == "revisit"
        block = b""
        if wanted and (payload or (http and revisit)):
            block = file.read(length)
            if len(block) < length:
                raise ValueError(f"record at {offset}: the file ends inside its block")
        elif seekable:
            file.seek(length, 1)
        else:
            left = length
            while left and (got := len(file.read(min(left, 1 << 20)))):
                left -= got
        if not wanted:
            continue
        row = {c: _bare(h, headers.get(h)) for c, h in HEADER_COLUMNS.items()}
        inner, body = split_http(block) if http and block else ({}, block)
        size = inner.get("content-length")
        row["payload"] = body if payload and not revisit else None
        row["payload_bytes"] = int(size) if size and size.isdigit() else len(body) if block else None
        row["offset"] = offset
        yield row


class _Reading:
    """A pyarrow file with readline, through a buffer."""

    def __init__(self, raw, size: int):
        self.raw, self.size, self.buffer, self.at = raw, size, b"", 0     # at: position of the buffer's start

    def tell(self):
        return self.at

    def _fill(self, n):
        while len(self.buffer) < n:
            got = self.raw.read(max(1 << 16, n - len(self.buffer)))
            if not got:
                return
            self.buffer += got

    def read(self, n):
        self._fill(n)
        out, self.buffer = self.buffer[:n], self.buffer[n:]
        self.at += len(out)
        return out

    def readline(self):
        k, step = -1, 1 << 12
        while True:
            self._fill(step)
            k = self.buffer.find(b"\n", 0, step)
            if k >= 0 or len(self.buffer) < step:
                break
            step *= 2
        return self.read(k + 1 if k >= 0 else len(self.buffer))

    def seek(self, n, _whence):
        if n <= len(self.buffer):
            self.buffer = self.buffer[n:]
        else:
            self.raw.seek(min(self.size, self.at + n))
            self.buffer = b""
        self.at += n


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() != "false"
        self.predicate = Predicate()

    def pushFilters(self, filters):
        for f in filters:
            if not self.predicate.take(f):
                yield f

    def partitions(self):
        """Files by falling size, packed to about ``PARTITION_BYTES``."""
        from pyarrow import fs
        store, root = open_fs(self.path)
        info = store.get_file_info(root)
        found = [info] if info.type == fs.FileType.File else \
            store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        names = sorted((-f.size, f.path) for f in found if f.type == fs.FileType.File
                       and f.path.endswith((".warc", ".warc.gz")) and not f.base_name.startswith(("_", ".")))
        parts, size = [[]], 0
        for neg, name in names:
            if parts[-1] and size - neg > PARTITION_BYTES:
                parts.append([])
                size = 0
            parts[-1].append(name)
            size -= neg
        return [Files(tuple(p)) for p in parts]

    def read(self, partition):
        store, _ = open_fs(self.path)
        schema = pa.schema([(c, pa.int64() if c in ("payload_bytes", "offset") else
                             pa.binary() if c == "payload" else pa.string()) for c in COLUMNS])
        for path in partition.paths:
            with store.open_input_file(path) as raw:
                packed = path.endswith(".gz")
                file = gzip.GzipFile(fileobj=raw) if packed else _Reading(raw, raw.size())
                held, size = [], 0
                for row in records(file, self.predicate, self.payload, not packed):
                    held.append(row | {"file": path})
                    size += 500 + len(row["payload"] or b"")
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)


@dataclass
class Written(WriterCommitMessage):
    name: str | None
    records: int


def _clean(value) -> str:
    return str(value).replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(row: dict) -> bytes:
    """One record. A revisit has the HTTP headers of its response only; their
    Content-Length is that of the full payload."""
    body = row.get("payload") or b""
    size = row.get("payload_bytes")
    size = len(body) if size is None else size
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + body
    head = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{row['record_id']}>"),
            ("WARC-Date", row.get("date") or DATE)]
    if row.get("target_uri") is not None:
        head.append(("WARC-Target-URI", row["target_uri"]))
    if row.get("payload_digest"):
        head.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()))
    if revisit:
        head.append(("WARC-Profile", REVISIT_PROFILE))
        if row.get("refers_to") is not None:
            head.append(("WARC-Refers-To", f"<{row['refers_to']}>"))
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {_clean(v)}\r\n" for k, v in head) + "\r\n"
    return text.encode() + block + b"\r\n\r\n"


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.gzip = str(options.get("compression", "none")).lower() == "gzip"

    def write(self, iterator):
        store, root = open_fs(self.path)
        store.create_dir(root, recursive=True)
        name, n, out = f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.gzip, 0, None
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    out = store.open_output_stream(f"{root}/_{name}", compression=None)
                data = record_bytes(row)
                out.write(gzip.compress(data, 6, mtime=0) if self.gzip else data)
                n += 1
        if out is not None:
            out.close()
        return Written(name if n else None, n)

    def commit(self, messages):
        from pyarrow import fs
        store, root = open_fs(self.path)
        store.create_dir(root, recursive=True)
        if self.overwrite:
            for f in store.get_file_info(fs.FileSelector(root)):
                if f.type == fs.FileType.File and not f.base_name.startswith("_"):
                    store.delete_file(f.path)
        for m in messages:
            if m is not None and m.name:
                store.move(f"{root}/_{m.name}", f"{root}/{m.name}")

    def abort(self, messages):
        store, root = open_fs(self.path)
        for m in messages:
            if m is not None and m.name:
                store.delete_file(f"{root}/_{m.name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make ``format("warc")`` known to the session and let filters reach it."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def pages_to_records(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """``pages(page_id, url, html)`` → rows to write. The payload is the html in
    UTF-8, empty for null. Of equal payloads of at least ``min_bytes`` the row of
    the largest page_id is the response and others revisit it; a row that
    repeats that id is a response, too, as are all rows of a payload that has
    only null ids. Smaller payloads are responses."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"),
                        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")) \
        .withColumn("payload_digest", F.sha1("payload"))
    # one row per payload that occurs under two ids; the digest's groups are aggregated map-side
    shared = rows.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest") \
        .agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n")).where("n > 1 and holder is not null") \
        .select("payload_digest", "holder")
    rows = rows.join(shared, "payload_digest", "left")
    revisit = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    return rows.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null"))).alias("record_id"),
        "target_uri", F.lit(DATE).alias("date"),
        F.when(revisit, F.concat(F.lit("urn:page:"), F.col("holder").cast("string"))).alias("refers_to"),
        "payload_digest", "payload_bytes", F.when(~revisit, F.col("payload")).alias("payload"),
        F.lit(None).cast("string").alias("file"), F.lit(None).cast("long").alias("offset"))


def page_of(urn):
    """The page id in a record's URN; null for none."""
    return F.try_element_at(F.split(urn, ":"), F.lit(3)).try_cast("long")


def archive_pages(pages: DataFrame, path: str | None = None, compression: str = "gzip") -> DataFrame:
    """Write a record per page, read the archives back: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to``. A response's size and digest are
    of the payload bytes read; a revisit's are those in its headers."""
    spark = pages.sparkSession
    register(spark)
    path = path or shared_path(spark, "warc")
    pages_to_records(pages).write.format("warc").option("compression", compression) \
        .mode("append").save(path)
    back = spark.read.format("warc").load(path)
    full = F.col("record_type") == "response"
    return back.select(
        page_of(F.col("record_id")).alias("page_id"),
        F.when(full, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(full, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", page_of(F.col("refers_to")).alias("refers_to"))
