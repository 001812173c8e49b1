"""Token ids as Arrow files of equal-length sequences with masks.

Every shard is one Arrow file of record batches with two fixed-size-list columns and ``BATCH_ROWS``
rows a batch: ``ids``, ``length`` values a row (uint16 if the vocabulary allows, else uint32), and
``mask``, as many booleans, which Arrow packs into bits. Row i of a shard is
row i % BATCH_ROWS of batch i // BATCH_ROWS, so any sequence is reached through the file's footer
without reading others, and its values are a view of the mapped file. A shard's ids are those of its
documents one after the other; only its last sequence is filled up, with id 0 and mask 0. Beside it
lies a second Arrow file with the place of each document: doc_id, first id, number of ids.

Shards hold ascending ranges of doc_id. Texts are encoded where they are read; ids, not texts, are
shuffled to the shards, whose bounds come from a sketch of the doc_ids.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from veracast.llm.common import new_place
from veracast.llm.encode import RunEncoder, byte_slices, tokenizer_path

LENGTH = 1024
BATCH_ROWS = 256
END_ID = 2
# Text to a shard, and the most shards: past that, larger ones.
SHARD_BYTES, MOST_SHARDS = 96 << 20, 100_000
_ENCODED = "shard int, doc_id bigint, h bigint, n bigint, ids binary"
_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
_MANIFEST = "shard int, path string, docs bigint, tokens bigint"
_ROWS = "shard int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def _opened(path: str):
    where = path if "://" in path or path.startswith("file:") else f"file://{path}"
    if where.startswith("file:/") and not where.startswith("file://"):
        where = "file://" + where[5:]
    return fs.FileSystem.from_uri(where)


class SequenceWriter:
    """Collects ids and writes them batch by batch."""

    def __init__(self, sink, length: int = LENGTH, kind: np.dtype = np.dtype(np.uint32)):
        self.length, self._type = length, kind
        self._schema = pa.schema(
            [("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length))]
        )
        self._writer = pa.ipc.new_file(sink, self._schema)
        self._parts: list[np.ndarray] = []
        self._held = 0
        self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self._parts.append(ids)
        self._held += len(ids)
        self.total += len(ids)
        size = self.length * BATCH_ROWS
        if self._held >= size:
            flat = np.concatenate(self._parts)
            whole = len(flat) // size * size
            for at in range(0, whole, size):
                self._write(flat[at : at + size], size)
            self._parts, self._held = [flat[whole:].copy()], len(flat) - whole

    def _write(self, flat: np.ndarray, real: int) -> None:
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(flat.astype(self._type)), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(flat)) < real), self.length),
        ]
        self._writer.write_batch(pa.record_batch(columns, schema=self._schema))

    def close(self) -> None:
        if self._held:
            flat = np.concatenate(self._parts)
            filled = np.zeros(-(-len(flat) // self.length) * self.length, self._type)
            filled[: len(flat)] = flat
            self._write(filled, len(flat))
        self._writer.close()


class SequenceFile:
    """Random access to the sequences of one shard."""

    def __init__(self, source):
        self._file = pa.ipc.open_file(source)
        self._batches = self._file.num_record_batches
        self.length = self._file.schema.field("ids").type.list_size

    def __len__(self) -> int:
        if not self._batches:
            return 0
        last = self._file.get_batch(self._batches - 1).num_rows
        return (self._batches - 1) * BATCH_ROWS + last

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of a sequence, both views of the file."""
        batch, row = self._file.get_batch(i // BATCH_ROWS), i % BATCH_ROWS
        return (
            _values(batch)[row * self.length : (row + 1) * self.length],
            batch.column("mask").slice(row, 1).flatten(),
        )

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids [start, start + n) of the shard, in one view for each batch they lie in."""
        size = self.length * BATCH_ROWS
        while n > 0:
            flat = _values(self._file.get_batch(start // size))
            part = flat[start % size : start % size + n]
            yield part
            start, n = start + len(part), n - len(part)


def _values(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("ids").flatten().to_numpy(zero_copy_only=True)


def shard_of(ids: np.ndarray, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Shard of each document: the number of bounds below its id.

    An id that is several bounds, as very frequent ones are, goes on by the order of its hash.
    """
    low, high = np.searchsorted(bounds, ids, "left"), np.searchsorted(bounds, ids, "right")
    place = hashes.astype(np.float64) / 2.0**64 + 0.5
    return low + np.minimum((place * (high - low + 1)).astype(np.int64), high - low)


def _encoder(tokenizer: str, end_id: int, bounds: np.ndarray):
    """Rows (doc_id, h, text) to rows of ``_ENCODED``: ids as 16 or 32 bit numbers, end id included."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = RunEncoder(tokenizer)
        kind = np.uint16 if max(encoder.vocabulary, end_id + 1) <= 1 << 16 else np.uint32
        for batch in batches:
            for at, n in byte_slices(batch.column(2)):
                some = batch.slice(at, n)
                code = encoder.encode(some.column(2))
                ends = np.cumsum(code.counts)
                flat = np.insert(code.ids, ends, end_id).astype(kind)
                counts = code.counts + 1
                starts = np.concatenate([[0], np.cumsum(counts)]) * flat.itemsize
                data = pa.Array.from_buffers(
                    pa.large_binary(), n, [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(flat)]
                ).cast(pa.binary())
                ids = some.column(0).fill_null(np.iinfo(np.int64).min).to_numpy()
                shard = shard_of(ids, some.column(1).to_numpy(), bounds)
                yield pa.record_batch(
                    [pa.array(shard, pa.int32()), some.column(0), some.column(1), pa.array(counts), data],
                    names=["shard", "doc_id", "h", "n", "ids"],
                )

    return rows


def _shard_writer(folder: str, length: int):
    """One shard a task, from its sorted rows of ``_ENCODED``."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from contextlib import ExitStack

        out = None
        with ExitStack() as files:
            docs = 0
            for batch in batches:
                if not batch.num_rows:
                    continue
                counts = batch.column("n").to_numpy()
                flat, kind = _flat_ids(batch.column("ids"), int(counts.sum()))
                if out is None:
                    shard = batch.column("shard")[0].as_py()
                    # Each attempt writes files of its own; the manifest names those that count.
                    path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}"
                    store, root = _opened(path)
                    store.create_dir(root.rsplit("/", 1)[0], recursive=True)
                    ids_sink = files.enter_context(store.open_output_stream(f"{root}.ids.arrow"))
                    docs_sink = files.enter_context(store.open_output_stream(f"{root}.docs.arrow"))
                    out, index = SequenceWriter(ids_sink, length, kind), pa.ipc.new_file(docs_sink, _INDEX)
                starts = out.total + np.cumsum(counts) - counts
                out.add(flat)
                columns = [batch.column("doc_id"), pa.array(starts), pa.array(counts)]
                index.write_batch(pa.record_batch(columns, schema=_INDEX))
                docs += batch.num_rows
            if out is None:
                return
            out.close()
            index.close()
        row = [[shard], [path], [docs], [out.total]]
        types = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.record_batch(
            [pa.array(v, t) for v, t in zip(row, types)],
            names=["shard", "path", "docs", "tokens"],
        )

    return write


def _flat_ids(column: pa.Array, n: int) -> tuple[np.ndarray, np.dtype]:
    """The ids of all rows, and their type, which the bytes of an id tell."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    kind = np.dtype(f"u{len(data) // n}")
    return data.copy().view(kind), kind


def write_sequences(
    docs: DataFrame,
    folder: str,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    length: int = LENGTH,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Write shards below ``folder``; returns the manifest: shard, path, docs, tokens, base.

    ``base`` is the number of ids in all earlier shards. A null or empty text is its end id alone.
    Ids are whole numbers; any other kind stops the job. Rows without an id come first; equal ids lie
    side by side, ordered by a hash of their text, and may be split over shards. An empty table gives an empty manifest. Other columns are not used.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or tokenizer_path()
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.xxhash64(text).alias("h"),
        F.col(text).alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    if not size[1]:
        return spark.createDataFrame([], f"{_MANIFEST}, base bigint")
    shards = max(1, -(-(size[0] or 0) // shard_bytes), spark.sparkContext.defaultParallelism)
    shards = min(shards, MOST_SHARDS)
    # Rows without an id count as the least one.
    places = F.coalesce("doc_id", F.lit(int(np.iinfo(np.int64).min)))
    cuts = [i / shards for i in range(1, shards)]
    bounds = rows.agg(F.percentile_approx(places, cuts, max(10_000, 20 * shards))).first()[0] if cuts else []
    encoded = rows.select("doc_id", "h", "text").mapInArrow(
        _encoder(tokenizer, end_id, np.array(sorted(bounds), np.int64)), _ENCODED
    )
    ranged = encoded.repartitionById(shards, F.col("shard")).sortWithinPartitions("doc_id", "h")
    place = f"{folder}/manifest"
    ranged.mapInArrow(_shard_writer(f"{folder}/shards", length), _MANIFEST).write.parquet(place)
    manifest = spark.read.schema(_MANIFEST).parquet(place)
    # One row a shard.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _shard_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            store, root = _opened(path)
            with (
                store.open_input_file(f"{root}.ids.arrow") as ids_source,
                store.open_input_file(f"{root}.docs.arrow") as docs_source,
            ):
                ids, index = SequenceFile(ids_source), pa.ipc.open_file(docs_source)
                for i in range(index.num_record_batches):
                    place = index.get_batch(i)
                    crcs = []
                    starts = place.column("start").to_numpy()
                    counts = place.column("n_tokens").to_numpy()
                    for start, n in zip(starts.tolist(), counts.tolist()):
                        crc = 0
                        for part in ids.ids(start, n):
                            crc = zlib.crc32(part.astype("<u4"), crc)
                        crcs.append(crc)
                    columns = [pa.array([shard] * len(crcs), pa.int32()), *place.columns]
                    yield pa.record_batch(
                        [*columns, pa.array(crcs, pa.int64())],
                        names=["shard", "doc_id", "start", "n_tokens", "ids_crc32"],
                    )


def read_documents(manifest: DataFrame) -> DataFrame:
    """One row a document, from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is of the document's ids as
    little-endian unsigned 32-bit integers.
    """
    paths = manifest.select("shard", "path").repartition(
        max(1, manifest.sparkSession.sparkContext.defaultParallelism * 2), "shard"
    )
    found = paths.mapInArrow(_shard_reader, _ROWS)
    return found.join(manifest.select("shard", "base"), "shard").select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"
    )


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` written as sequences in the shared folder and read back by document."""
    spark: SparkSession = docs.sparkSession
    folder = new_place(spark, "sequences")
    return read_documents(write_sequences(docs, folder))
