"""Rows that arrive after their hour was closed: told apart, counted and kept.

Windows over a stream drop such rows without a trace. Here a stream of raw observations is first split
by the watermark its batch meets: the newest measurement of all earlier batches less the allowed delay.

    rows/batch=<n>/arrival=on_time | late | untimed/*.parquet

A batch is written to a draft folder and renamed into place, so it shows whole or not at all, and a
repeated batch finds itself done. Its newest measurement so far lies in the same folder, which is all
the next batch needs to know. Windows over the on-time rows then lose nothing: a row counts as late
exactly if its hour ends at or before the watermark.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from veracast.functions.scalars import epoch_instant
from veracast.schemas import RAW_WEATHER
from veracast.session import pin_utc
from veracast.sources import store

ARRIVAL = "arrival"
ON_TIME, LATE, UNTIMED = "on_time", "late", "untimed"
DELAY_SECONDS = 7200
_STORED = T.StructType(
    [*RAW_WEATHER, T.StructField("batch", T.LongType()), T.StructField(ARRIVAL, T.StringType())]
)
_SUMMARY = "_summary.json"


def arrival(measured_at: Column, watermark: int | None, window: str = "HOUR") -> Column:
    """Whether a row's hour was still open at a watermark (epoch seconds; None: nothing seen yet)."""
    end = F.unix_seconds(F.date_trunc(window, measured_at)) + 3600
    late = F.lit(False) if watermark is None else end <= watermark
    return F.when(measured_at.isNull(), UNTIMED).when(late, LATE).otherwise(ON_TIME)


def _newest_before(spark: SparkSession, path: str, batch: int) -> int | None:
    """Newest measurement of all batches before this one."""
    done = [int(n.split("=")[1]) for n in store.names(spark, f"{path}/rows") if n.startswith("batch=")]
    earlier = [n for n in done if n < batch]
    if not earlier:
        return None
    return json.loads(store.read_text(spark, f"{path}/rows/batch={max(earlier)}/{_SUMMARY}"))["newest"]


def split_batch(rows: DataFrame, path: str, batch: int, delay: int = DELAY_SECONDS) -> None:
    """Write one batch of raw observations, split by arrival; does nothing if it is there already."""
    spark = pin_utc(rows.sparkSession)
    target = f"{path}/rows/batch={batch}"
    if store.exists(spark, target):
        return
    newest = _newest_before(spark, path, batch)
    watermark = None if newest is None else newest - delay
    at, seen, draft = epoch_instant(F.col("time_api")), Observation(), f"{path}/drafts/{uuid.uuid4().hex}"
    told = rows.select(*RAW_WEATHER.names, arrival(at, watermark).alias(ARRIVAL))
    told.observe(seen, F.max(F.unix_seconds(at)).alias("newest")).write.partitionBy(ARRIVAL).parquet(draft)
    known = [t for t in (newest, seen.get["newest"]) if t is not None]
    summary = {"newest": max(known, default=None), "watermark": watermark}
    store.write_text(spark, f"{draft}/{_SUMMARY}", json.dumps(summary))
    store.move(spark, draft, target)


def start_split(
    raw_weather: DataFrame, path: str, checkpoint: str, delay: int = DELAY_SECONDS
) -> StreamingQuery:
    """Split what the stream holds now, then stop; the next start goes on from the checkpoint."""
    pin_utc(raw_weather.sparkSession)
    return (
        raw_weather.writeStream.foreachBatch(lambda rows, batch: split_batch(rows, path, batch, delay))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_split(spark: SparkSession, path: str) -> DataFrame:
    """All rows with the batch they came in and their arrival."""
    return spark.read.schema(_STORED).option("basePath", f"{path}/rows").parquet(f"{path}/rows")


def on_time(spark: SparkSession, path: str) -> DataFrame:
    """The on-time rows as a stream.

    No limit per trigger: whole batches, which appear at once, keep rows of one batch from closing
    each other's hours.
    """
    rows = spark.readStream.schema(_STORED).option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    return rows.where(F.col(ARRIVAL) == ON_TIME).select(*RAW_WEATHER.names)


def arrival_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows read, on time, late and untimed of every batch, counted from what was written."""
    kind = F.col(ARRIVAL)
    return read_split(spark, path).groupBy("batch").agg(
        F.count(F.lit(1)).alias("read"),
        *[F.count_if(kind == name).alias(name) for name in (ON_TIME, LATE, UNTIMED)],
    )
