"""Weather API documents to flat records.

Input is one row per document: the city it was asked for and the JSON body. One expression serves
every city.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from veracast.functions.scalars import epoch_instant, record_key
from veracast.schemas import CURRENT_PAYLOAD, FORECAST_PAYLOAD, RAW_FORECAST, RAW_WEATHER
from veracast.session import pin_utc


def _run_text(collected_at: Column | dt.datetime | str) -> Column:
    if isinstance(collected_at, Column):
        return collected_at
    if isinstance(collected_at, dt.datetime):
        if collected_at.tzinfo is None:
            collected_at = collected_at.replace(tzinfo=dt.timezone.utc)
        collected_at = collected_at.astimezone(dt.timezone.utc).isoformat()
    return F.lit(collected_at)


def _fields(item: str, run: Column) -> list[Column]:
    """Record fields both documents share; an absent or empty weather list gives null words."""
    words = F.get(F.col(f"{item}.weather"), F.lit(0))
    return [
        F.col("ville"),
        F.col(f"{item}.main.temp").alias("temperature"),
        F.col(f"{item}.main.humidity").alias("humidite"),
        F.col(f"{item}.wind.speed").alias("vitesse_vent"),
        words["main"].alias("categorie_meteo"),
        words["description"].alias("description_meteo"),
        F.col(f"{item}.dt").alias("time_api"),
        run.alias("heure_run"),
    ]


def _id(item: str) -> Column:
    return record_key(F.col("ville"), epoch_instant(F.col(f"{item}.dt")))


def flatten_current(payloads: DataFrame, collected_at: Column | dt.datetime | str) -> DataFrame:
    """(ville, body) documents of current weather to raw_weather records."""
    pin_utc(payloads.sparkSession)
    read = payloads.select("ville", F.from_json("body", CURRENT_PAYLOAD).alias("p"))
    records = read.select(_id("p").alias("record_id"), *_fields("p", _run_text(collected_at)))
    return records.select(*RAW_WEATHER.names)


def flatten_forecast(payloads: DataFrame, collected_at: Column | dt.datetime | str) -> DataFrame:
    """(ville, body) forecast documents to raw_forecast records, one per listed slot.

    A document without a list gives no rows.
    """
    pin_utc(payloads.sparkSession)
    run = _run_text(collected_at)
    read = payloads.select(
        "ville", run.alias("_run"), F.from_json("body", FORECAST_PAYLOAD).alias("p")
    )
    slots = read.select("ville", "_run", F.explode("p.list").alias("p"))
    records = slots.select(
        _id("p").alias("record_forecast_id"),
        *_fields("p", F.col("_run")),
        F.col("p.dt").alias("forecast_timestamp"),
    )
    return records.select(*RAW_FORECAST.names)
