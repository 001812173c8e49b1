"""WARC archives as a PySpark Python data source, and pages written to them and read back.

Reading (``spark.read.format("warc")``):

* *Planning.* Files below the path, or those its commits name, are packed into partitions of about
  ``partition_bytes``; a file is never split, so writers keep files below ``file_bytes``.
* *Predicates* on any column but the payload, record type included, go to the reader, which compares
  them with the record's own headers before anything else is read.
* *Columns.* A schema given to ``spark.read.schema`` names the columns wanted. Without ``payload``
  no payload is inflated or decoded; without HTTP columns the block is not touched at all.

Writing (``df.write.format("warc")``): each task rolls over files of its own; a commit file names
those of the tasks that count, so what a lost executor left behind is never read.

Nulls: a header that is missing gives null, a null column writes no header, a null payload writes an
empty one. Empty tables give an archive without files, which reads as no rows. Damage (a file that
ends within a record, say) stops the job unless ``damaged`` is ``skip``, which goes on with the next
file. Texts of any length are one record each, held in memory one at a time.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from veracast.llm.common import arrow_type, kept, new_place
from veracast.llm.warc_records import (
    REVISIT_PROFILE,
    DamagedArchive,
    Record,
    base32,
    gzip_member,
    hex_digest,
    record_bytes,
    records,
)

# Column, and the record header it comes from.
_FROM_HEADER = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "warc_date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "content_type": "content-type",
    "content_length": "content-length",
}
_FROM_HTTP = ("http_status", "payload_bytes")
SCHEMA = StructType(
    [
        StructField("record_type", StringType()),
        StructField("record_id", StringType()),
        StructField("target_uri", StringType()),
        StructField("warc_date", StringType()),
        StructField("refers_to", StringType()),
        StructField("payload_digest", StringType()),
        StructField("content_type", StringType()),
        StructField("content_length", LongType()),
        StructField("http_status", IntegerType()),
        StructField("payload_bytes", LongType()),
        StructField("file", StringType()),
        StructField("offset", LongType()),
        StructField("payload", BinaryType()),
    ]
)
# Payloads of fewer bytes are always stored, copies or not.
LEAST_REVISIT_BYTES = 1000
FILE_BYTES, PARTITION_BYTES, BATCH_BYTES = 128 << 20, 128 << 20, 8 << 20
_COMMITS = "_commits"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path:
        path = "file://" + path.removeprefix("file:")
    elif path.startswith("file:///"):
        path = "file://" + path.removeprefix("file://")
    return fs.FileSystem.from_uri(path)


def _column(record: Record, name: str, file: str):
    if name in _FROM_HEADER:
        value = record.headers.get(_FROM_HEADER[name])
        if value is None:
            return None
        if name in ("record_id", "refers_to"):
            return value.strip("<>")
        if name == "payload_digest":
            return hex_digest(value)
        return int(value) if name == "content_length" else value
    if name == "offset":
        return record.offset
    if name == "file":
        return file
    status, fields = record.http()
    if name == "http_status":
        return status
    # A revisit states the length of the payload it leaves out.
    stated = fields.get("content-length", "")
    plain = not fields.get("transfer-encoding") and not fields.get("content-encoding")
    return int(stated) if plain and stated.isdigit() else None


_COMPARE = {
    EqualTo: lambda a, b: a == b,
    GreaterThan: lambda a, b: a > b,
    GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b,
    LessThanOrEqual: lambda a, b: a <= b,
    In: lambda a, b: a in b,
    StringStartsWith: lambda a, b: a.startswith(b),
    StringEndsWith: lambda a, b: a.endswith(b),
    StringContains: lambda a, b: b in a,
}


def _held(predicate, value_of) -> bool | None:
    """Whether a predicate holds, null (None) as in SQL."""
    if isinstance(predicate, Not):
        inner = _held(predicate.child, value_of)
        return None if inner is None else not inner
    value = value_of(predicate.attribute[0])
    if isinstance(predicate, IsNotNull):
        return value is not None
    if isinstance(predicate, IsNull):
        return value is None
    if isinstance(predicate, EqualNullSafe):
        return value == predicate.value
    if value is None or predicate.value is None:
        return None
    return _COMPARE[type(predicate)](value, predicate.value)


def _supported(predicate) -> bool:
    if isinstance(predicate, Not):
        return _supported(predicate.child)
    known = isinstance(predicate, (IsNotNull, IsNull, EqualNullSafe, *_COMPARE))
    if not known or len(predicate.attribute) != 1:
        return False
    # Null in an IN list makes the answer null rather than false.
    if isinstance(predicate, In) and None in predicate.value:
        return False
    return predicate.attribute[0] in (*_FROM_HEADER, *_FROM_HTTP, "file", "offset")


def _cheap_first(predicate) -> bool:
    """Predicates that need the HTTP headers come after those that do not."""
    while isinstance(predicate, Not):
        predicate = predicate.child
    return predicate.attribute[0] in _FROM_HTTP


@dataclass
class Files(InputPartition):
    """Files (path, bytes) one task reads."""

    paths: list[tuple[str, int]]


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        if unknown := [n for n in schema.names if n not in SCHEMA.names]:
            raise ValueError(f"columns {unknown} are not among those of WARC records")
        self.schema, self.path = schema, options["path"]
        self.partition_bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        self.least_partitions = int(options.get("least_partitions", 1))
        self.skip_damaged = options.get("damaged", "fail") == "skip"
        self.predicates: list = []

    def pushFilters(self, filters):
        for f in filters:
            if _supported(f):
                self.predicates.append(f)
            else:
                yield f
        self.predicates.sort(key=_cheap_first)

    def files(self) -> list[tuple[str, int]]:
        """(path, bytes): those the commits name, or every archive below a path without commits."""
        store, root = _store(self.path)
        commits = store.get_file_info(fs.FileSelector(f"{root}/{_COMMITS}", allow_not_found=True))
        commits = [c.path for c in commits if c.path.endswith(".json")]
        if commits:
            out = []
            for commit in sorted(commits):
                with store.open_input_stream(commit) as source:
                    listed = json.loads(source.read())
                out += [(f"{root}/{name}", size) for name, size in listed["files"]]
            return sorted(out)
        info = store.get_file_info(root)
        if info.type == fs.FileType.File:
            return [(info.path, info.size)]
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
        own = [f for f in found if f.type == fs.FileType.File]
        hidden = lambda p: any(s[:1] in "_." for s in p[len(root) :].split("/") if s)
        return sorted(
            (f.path, f.size) for f in own if f.path.endswith((".warc", ".warc.gz")) and not hidden(f.path)
        )

    def partitions(self) -> list[Files]:
        """Files, largest first, each into the emptiest partition that is open."""
        import heapq

        files = sorted(self.files(), key=lambda f: (-f[1], f[0]))
        wanted = max(self.least_partitions, -(-sum(n for _, n in files) // self.partition_bytes))
        heap = [(0, i, []) for i in range(min(wanted, max(1, len(files))))]
        for file in files:
            size, i, paths = heapq.heappop(heap)
            paths.append(file)
            heapq.heappush(heap, (size + file[1], i, paths))
        return [Files(paths) for _, _, paths in sorted(heap, key=lambda h: h[1])]

    def _wanted(self, record: Record, file: str) -> bool:
        value_of = lambda name: _column(record, name, file)
        return all(_held(p, value_of) for p in self.predicates)

    def _rows(self, partition: Files) -> Iterator[list]:
        names = self.schema.names
        store, _ = _store(self.path)
        for path, size in partition.paths:
            with store.open_input_file(path) as source:
                try:
                    for record in records(source, size):
                        if not self._wanted(record, path):
                            continue
                        row = {n: _column(record, n, path) for n in names if n != "payload"}
                        if "payload" in names:
                            row["payload"] = record.payload()
                            # Codings other than the identity leave the length to be counted.
                            if "payload_bytes" in names and row["payload_bytes"] is None:
                                row["payload_bytes"] = len(row["payload"])
                        yield [row[n] for n in names]
                except DamagedArchive as wrong:
                    if not self.skip_damaged:
                        raise DamagedArchive(f"{path}: {wrong}") from wrong

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(f.name, arrow_type(f.dataType)) for f in self.schema])
        held, size = [], 0
        payload = self.schema.names.index("payload") if "payload" in self.schema.names else None
        for row in self._rows(partition):
            held.append(row)
            size += 200 + (len(row[payload]) if payload is not None else 0)
            if size >= BATCH_BYTES:
                yield _batch(held, schema)
                held, size = [], 0
        if held:
            yield _batch(held, schema)


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if len(schema) else []
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


@dataclass
class Written(WriterCommitMessage):
    """Files one task wrote: name, bytes and records of each."""

    files: list[tuple[str, int, int]]


class WarcWriter(DataSourceArrowWriter):
    """Rows to records: response, revisit (no payload) or any other type as the row names it."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.file_bytes = int(options.get("file_bytes", FILE_BYTES))
        self.level = int(options.get("level", 4))
        self.gzip = options.get("compression", "gzip") == "gzip"
        self.date = options.get("date", "1970-01-01T00:00:00Z")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        task, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        files: list[tuple[str, int, int]] = []
        sink = None
        held = rows = 0
        for batch in iterator:
            names = batch.schema.names
            for i in range(batch.num_rows):
                if sink is not None and held >= self.file_bytes:
                    sink.close()
                    files.append((name, held, rows))
                    sink = None
                if sink is None:
                    tail = ".warc.gz" if self.gzip else ".warc"
                    name = f"part-{task:06d}-{attempt}-{len(files):04d}{tail}"
                    sink = store.open_output_stream(f"{root}/{name}", compression=None)
                    held = sink.write(self._packed(self._info(name)))
                    rows = 0
                row = {n: batch.column(c)[i].as_py() for c, n in enumerate(names)}
                data = self._packed(self._record(row))
                sink.write(data)
                held += len(data)
                rows += 1
        if sink is not None:
            sink.close()
            files.append((name, held, rows))
        return Written(files)

    def _packed(self, data: bytes) -> bytes:
        return gzip_member(data, self.level) if self.gzip else data

    def _info(self, name: str) -> bytes:
        fields = [
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"),
            ("WARC-Date", self.date),
            ("WARC-Filename", name),
            ("Content-Type", "application/warc-fields"),
        ]
        return record_bytes(fields, b"format: WARC File Format 1.1\r\n")

    def _record(self, row: dict) -> bytes:
        kind = row.get("record_type") or "response"
        angle = lambda v: None if v is None else f"<{v}>"
        digest = row.get("payload_digest")
        payload = row.get("payload") or b""
        length = row.get("payload_bytes")
        length = len(payload) if length is None else length
        http = kind in ("response", "revisit")
        fields = [
            ("WARC-Type", kind),
            ("WARC-Record-ID", angle(row.get("record_id") or f"urn:uuid:{uuid.uuid4()}")),
            ("WARC-Target-URI", row.get("target_uri")),
            ("WARC-Date", row.get("warc_date") or self.date),
            ("WARC-Profile", REVISIT_PROFILE if kind == "revisit" else None),
            ("WARC-Refers-To", angle(row.get("refers_to"))),
            ("WARC-Payload-Digest", digest and "sha1:" + base32(digest.removeprefix("sha1:"))),
            ("Content-Type", "application/http; msgtype=response" if http else row.get("content_type")),
        ]
        if not http:
            return record_bytes(fields, payload)
        status = row.get("http_status") or 200
        head = f"HTTP/1.1 {status}\r\nContent-Type: {row.get('content_type') or 'text/html; charset=utf-8'}"
        block = f"{head}\r\nContent-Length: {length}\r\n\r\n".encode()
        return record_bytes(fields, block if kind == "revisit" else block + payload)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _store(self.path)
        folder = f"{root}/{_COMMITS}"
        store.create_dir(folder, recursive=True)
        older = [c.path for c in store.get_file_info(fs.FileSelector(folder))]
        name = f"{folder}/{uuid.uuid4().hex}"
        files = [(n, size) for m in messages if m for n, size, _ in m.files]
        with store.open_output_stream(f"{name}.tmp") as sink:
            sink.write(json.dumps({"files": files}).encode())
        store.move(f"{name}.tmp", f"{name}.json")
        if self.overwrite:
            for path in older:
                store.delete_file(path)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _store(self.path)
        for m in messages:
            for n, *_ in m.files if m else ():
                if store.get_file_info(f"{root}/{n}").type == fs.FileType.File:
                    store.delete_file(f"{root}/{n}")


class WarcSource(DataSource):
    """``format("warc")``; options ``path``, ``partition_bytes``, ``least_partitions`` (as far as there
    are files), ``damaged``; for writing ``file_bytes``, ``compression`` (gzip or none), ``level`` and ``date``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> StructType:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make ``format("warc")`` known and let filters reach it."""
    spark.dataSource.register(WarcSource)
    spark.conf.set(PUSHDOWN, "true")


def read_archives(spark: SparkSession, path: str, columns: list[str] | None = None, **options: str) -> DataFrame:
    """Records below ``path``; ``columns`` names those wanted, all by default."""
    register(spark)
    schema = StructType([SCHEMA[c] for c in columns]) if columns else SCHEMA
    return spark.read.format("warc").schema(schema).options(**options).load(path)


def record_urn(key: Column, kind: str) -> Column:
    """``urn:<kind>:<key>``, the key percent-encoded; ``~``, which no encoded key is, for null."""
    text = F.replace(F.url_encode(key.cast("string")), F.lit("~"), F.lit("%7E"))
    return F.concat(F.lit(f"urn:{kind}:"), F.coalesce(text, F.lit("~")))


def urn_key(urn: Column) -> Column:
    """The key in such a name, as text."""
    text = F.substring_index(urn, ":", -1)
    return F.when(text != "~", F.url_decode(text))


def write_pages(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = LEAST_REVISIT_BYTES,
    **options: str,
) -> None:
    """One record a row: the page as response, or a revisit of the response with the same payload.

    Of the rows with equal payloads of at least ``least`` bytes the one with the largest key is the
    response; a null key is smaller than any other. Rows that share both that key and that payload
    are all responses. A null page is an empty payload. Other columns are not used, whatever their
    names. Equal payloads are told by SHA-1 and a second hash; only digests and keys are shuffled to
    find them, and only payloads that occur twice or more meet the pages again, which Spark does by
    broadcast while the table of those is below its threshold.
    """
    spark = pages.sparkSession
    register(spark)
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).cast("string").alias("target_uri"), payload.alias("payload")
    ).select(
        "*",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha1("payload").alias("sha1"),
        F.xxhash64("payload").alias("other"),
    )
    same = ["sha1", "other", "payload_bytes"]
    repeated = kept(
        rows.where(F.col("payload_bytes") >= least)
        .groupBy(*same)
        .agg(F.max("key").alias("top"), F.count("*").alias("n"))
        .where("n > 1 and top is not null")
        .drop("n"),
        "repeated",
    )
    joined = rows.join(repeated, same, "left")
    first = F.col("top").isNull() | F.col("key").eqNullSafe(F.col("top"))
    joined.select(
        F.when(first, "response").otherwise("revisit").alias("record_type"),
        record_urn(F.col("key"), "page").alias("record_id"),
        "target_uri",
        F.when(~first, record_urn(F.col("top"), "page")).alias("refers_to"),
        F.col("sha1").alias("payload_digest"),
        "payload_bytes",
        F.when(first, F.col("payload")).alias("payload"),
    ).write.format("warc").options(**options).mode("append").save(folder)


def archived(pages: DataFrame, **options: str) -> DataFrame:
    """``pages`` written to archives in the shared folder and read back: key (text), payload_bytes,
    payload_digest, record_type, refers_to (text).

    Figures of responses come from the payload read, those of revisits from their headers.
    """
    folder = new_place(pages.sparkSession, "warc")
    write_pages(pages, folder, **options)
    columns = [
        "record_type", "record_id", "refers_to", "payload_digest", "payload_bytes", "payload",
    ]
    cores = str(pages.sparkSession.sparkContext.defaultParallelism)
    back = read_archives(pages.sparkSession, folder, columns, least_partitions=cores)
    whole = F.col("record_type") == "response"
    return back.where(F.col("record_type").isin("response", "revisit")).select(
        urn_key(F.col("record_id")).alias("key"),
        F.when(whole, F.octet_length("payload").cast("bigint"))
        .otherwise(F.col("payload_bytes"))
        .alias("payload_bytes"),
        F.when(whole, F.sha1("payload"))
        .otherwise(F.substring_index("payload_digest", ":", -1))
        .alias("payload_digest"),
        "record_type",
        urn_key(F.col("refers_to")).alias("refers_to"),
    )
