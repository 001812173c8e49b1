"""Topic to raw table: decode, set bad messages aside, insert what the table does not hold yet."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark import StorageLevel
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from veracast.operators.merge import merge_insert_only, only_matching
from veracast.session import pin_utc, shared_folder
from veracast.sources import store
from veracast.sources.messages import ARRIVAL, QUARANTINE, decode, split_good
from veracast.sources.tables import UNKEYED, RawTable
from veracast.sources.versions import PART, Version, VersionedTable

log = logging.getLogger(__name__)
_REPORT = "stream string, batch bigint, read bigint, inserted bigint, duplicates bigint, quarantined bigint"


@dataclass(frozen=True)
class LandingReport:
    """What became of one batch of messages."""

    batch: int
    read: int
    inserted: int
    duplicates: int
    quarantined: int


def _arrival_order(records: DataFrame) -> list[str]:
    """First writer first: broker order where known, else collection time."""
    known = [f"`{c}` ASC" for c in ARRIVAL if c in records.columns]
    return known or ["heure_run ASC NULLS FIRST"]


def _quarantine(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, f"{path}/quarantine")


def _set_aside(bad: DataFrame, path: str, stream: str, batch: int) -> None:
    """Add a batch's bad messages to the quarantine, once however often the batch is repeated."""
    table = _quarantine(bad.sparkSession, path)
    base = table.version()
    if base.notes.get(stream, -1) >= batch:
        return
    added, _ = table.add(bad.select(*QUARANTINE.names), None)
    table.commit(base, added, {**base.notes, stream: batch}, QUARANTINE)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The messages set aside: ``body`` holds the bytes as they came."""
    return _quarantine(spark, path).read(QUARANTINE)


def land_batch(
    messages: DataFrame,
    table: RawTable,
    path: str,
    stream: str,
    batch: int,
    absent_only: bool = True,
) -> LandingReport:
    """Land one bounded batch, once however often it is repeated with the same ``stream`` and ``batch``.

    The commit that makes the batch's rows visible also notes its number and report; a repeat finds
    them there and changes nothing. What an attempt without commit wrote is never read. Only the
    days the batch touches are looked up in the table. One writer per table at a time: a second
    one's commit fails.
    """
    spark = pin_utc(messages.sparkSession)
    raw = VersionedTable(spark, path)
    base = raw.version()
    landed = base.notes.get("streams", {}).get(stream)
    if landed is not None and batch <= landed["batch"]:
        if batch < landed["batch"]:
            raise ValueError(f"batch {batch} of {stream} is behind batch {landed['batch']}")
        return _reported(spark, path, stream, LandingReport(**landed))
    # Of good messages the bytes are not looked at again, so they are not held either.
    body = F.when(~F.col("is_good"), F.col("body"))
    decoded = decode(messages, table.schema, absent_only).withColumns({PART: table.part(), "body": body})
    decoded.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # One row a day of the batch; the pass also fills the cache.
        days = decoded.groupBy(PART, "is_good").agg(F.count(F.lit(1)).alias("n")).collect()
        read, bad = sum(d["n"] for d in days), sum(d["n"] for d in days if not d["is_good"])
        good, aside = split_good(decoded, table.schema)
        if bad:
            log.warning("%s batch %d: %d messages set aside", table.name, batch, bad)
            _set_aside(aside, path, stream, batch)
        touched = {d[PART] for d in days if d["is_good"]} - {UNKEYED}
        key = list(table.key)
        stored = raw.read(table.schema, touched, base)
        fresh = merge_insert_only(good, only_matching(stored, good, key), key, _arrival_order(good))
        added, counts = raw.add(fresh.select(*table.schema.names), table.part())
    finally:
        decoded.unpersist()

    inserted = counts["rows"]
    report = LandingReport(batch, read, inserted, read - bad - inserted, bad)
    notes = {
        "rows": base.notes.get("rows", 0) + inserted,
        "streams": {**base.notes.get("streams", {}), stream: asdict(report)},
    }
    raw.commit(base, added, notes, table.schema)
    log.info("%s: %s", table.name, report)
    return _reported(spark, path, stream, report)


def _reported(spark: SparkSession, path: str, stream: str, report: LandingReport) -> LandingReport:
    """Write the report beside the table; a repeated batch writes the same one again."""
    where = f"{path}/reports/{stream}-{report.batch:010d}.json"
    store.write_text(spark, where, json.dumps({"stream": stream, **asdict(report)}))
    return report


def landing_reports(spark: SparkSession, path: str) -> DataFrame:
    """One row for every batch landed in the table: read, inserted, duplicates, quarantined."""
    if not store.names(spark, f"{path}/reports"):
        return spark.createDataFrame([], _REPORT)
    return spark.read.schema(_REPORT).json(f"{path}/reports")


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The query's lasting id, which Spark writes to its checkpoint before the first batch."""
    line = spark.read.text(f"{checkpoint}/metadata").first()
    return json.loads(line[0])["id"]


def create(spark: SparkSession, table: RawTable, path: str) -> None:
    """Make the empty table if it is not there."""
    raw = VersionedTable(spark, path)
    if not raw.numbers():
        raw.commit(Version(), {}, {"rows": 0, "streams": {}}, table.schema)


def start_landing(
    messages: DataFrame,
    table: RawTable,
    path: str,
    checkpoint: str | None = None,
    on_batch: Callable[[LandingReport], None] | None = None,
    absent_only: bool = True,
) -> StreamingQuery:
    """Drain what the topic holds now into the raw table, then stop.

    ``checkpoint`` plays the consumer group: it remembers what was read. It defaults to a folder
    for this table under the session's shared checkpoint folder.
    """
    spark = pin_utc(messages.sparkSession)
    checkpoint = checkpoint or f"{shared_folder(spark)}/landing/{table.name}"
    create(spark, table, path)

    def each(batch: DataFrame, number: int) -> None:
        stream = _stream_id(batch.sparkSession, checkpoint)
        report = land_batch(batch, table, path, stream, number, absent_only)
        if on_batch is not None:
            on_batch(report)

    return (
        messages.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


class _Enough(Exception):
    """Raised behind a landed batch to end a run early."""


def drain(
    messages: DataFrame,
    table: RawTable,
    path: str,
    checkpoint: str | None = None,
    most_batches: int | None = None,
    absent_only: bool = True,
) -> list[LandingReport]:
    """Land what the topic holds now, or so many batches of it; returns what became of each.

    A batch's size is that of the topic's limits (``messages.open_topic``). The next call goes on
    from the checkpoint; the last batch of a run cut short is offered again and found landed.
    """
    reports: list[LandingReport] = []

    def each(report: LandingReport) -> None:
        reports.append(report)
        if most_batches is not None and len(reports) >= most_batches:
            raise _Enough

    query = start_landing(messages, table, path, checkpoint, each, absent_only)
    try:
        query.awaitTermination()
    except StreamingQueryException as stopped:
        if "_Enough" not in str(stopped):
            raise
    return reports
