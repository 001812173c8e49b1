"""Streaming forms of the newest-per-hour and 3-hour-slot steps.

Rows later than the watermark are dropped here; ``streaming.late`` tells them apart beforehand, counts
and keeps them. The batch models stay the full truth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from veracast.operators.slots import slot_means
from veracast.plans.staging import OBSERVATION_COLUMNS, clean_observations

_RANKED_BY = ("weather_ts", "record_id")


def newest_per_hour(raw_weather: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Newest observation per city and hour of a raw stream.

    Keeps an ``hour`` window column so that a further window can follow. The largest struct wins,
    compared field by field in the order the batch model ranks by.
    """
    clean = clean_observations(raw_weather).withWatermark("weather_ts", delay)
    rest = [c for c in OBSERVATION_COLUMNS if c not in ("ville", "heure_meteo")]
    newest = F.struct(
        F.coalesce("run_ts", "heure_meteo").alias("_rank"), *_RANKED_BY, "heure_meteo", *rest
    )
    hours = clean.groupBy(F.window("weather_ts", "1 hour").alias("hour"), "ville").agg(
        F.max(newest).alias("n")
    )
    return hours.select(
        "hour", "ville", "n.heure_meteo", *[F.col(f"n.{c}").alias(c) for c in rest]
    )


def slots_of_hours(hours: DataFrame) -> DataFrame:
    """Mean measures per city and 3-hour slot of ``newest_per_hour``."""
    slot = F.window(F.window_time("hour"), "3 hours").alias("slot")
    return slot_means(hours.groupBy(slot, "ville"), F.col("slot.start"))


def drain_windows(windows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the closed windows of what the stream holds now to a Parquet table, then stop."""
    return (
        windows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
