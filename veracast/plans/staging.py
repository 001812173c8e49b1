"""Staging models: raw tables to clean, deduplicated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veracast.functions.rules import all_present, city_name
from veracast.functions.scalars import (
    epoch_instant,
    key_suffix,
    parse_instant,
    record_key,
    whole_hours,
)
from veracast.operators.once import computed_once
from veracast.operators.top_one import breaking_ties, first_per_key
from veracast.session import pin_utc

OBSERVATION_COLUMNS = (
    "ville",
    "heure_meteo",
    "run_ts",
    "temperature",
    "humidite",
    "vitesse_vent",
    "categorie_meteo",
    "description_meteo",
)
FORECAST_COLUMNS = (
    "ville",
    "id_prevision",
    "date_heure_collecte",
    "date_heure_prevue",
    "horizon_heures",
    "temperature_prevue",
    "humidite_prevue",
    "vent_prevu",
    "categorie_prevue",
    "description_prevue",
)

# The collection time as an instant, where a table has been given it already.
RUN = "_run"


def with_run(raw: DataFrame) -> DataFrame:
    """``raw`` with ``heure_run`` read as an instant, ``RUN``; read once a row, however often used."""
    if RUN in raw.columns:
        return raw
    return computed_once(raw, **{RUN: parse_instant(F.col("heure_run"))})


def clean_observations(raw_weather: DataFrame) -> DataFrame:
    """Raw observations with one city spelling, parsed instants and their hour."""
    pin_utc(raw_weather.sparkSession)
    measured_at = epoch_instant(F.col("time_api"))
    run = F.col(RUN) if RUN in raw_weather.columns else parse_instant(F.col("heure_run"))
    return raw_weather.select(
        city_name(F.col("ville")).alias("ville"),
        F.date_trunc("HOUR", measured_at).alias("heure_meteo"),
        measured_at.alias("weather_ts"),
        run.alias("run_ts"),
        "temperature",
        "humidite",
        "vitesse_vent",
        "categorie_meteo",
        "description_meteo",
        "record_id",
    )


def stg_weather_stream(raw_weather: DataFrame) -> DataFrame:
    """Newest observation per city and hour.

    Newest by collection time, or by the hour itself where that is unknown. The source leaves equal
    collection times open; here the later measurement, then the higher id and values win.
    """
    clean = clean_observations(raw_weather)
    newest = (
        "coalesce(run_ts, heure_meteo) DESC NULLS LAST",
        "weather_ts DESC NULLS LAST",
        "record_id DESC NULLS LAST",
    )
    order = breaking_ties(clean, newest, ("ville", "heure_meteo", "weather_ts", "record_id"))
    return first_per_key(clean, ["ville", "heure_meteo"], order).select(*OBSERVATION_COLUMNS)


def clean_forecasts(raw_forecast: DataFrame) -> DataFrame:
    """Raw forecasts with parsed instants, rebuilt ids and horizon; duplicates still in.

    The target time comes from the first readable of: forecast_timestamp, time_api, the id's suffix.
    Rows without target or collection time are dropped.
    """
    pin_utc(raw_forecast.sparkSession)
    given_target = F.coalesce(
        epoch_instant(F.col("forecast_timestamp")), epoch_instant(F.col("time_api"))
    )
    parsed = with_run(raw_forecast).select(
        city_name(F.col("ville")).alias("ville"),
        F.col(RUN).alias("date_heure_collecte"),
        F.coalesce(
            given_target, parse_instant(key_suffix(F.col("record_forecast_id")))
        ).alias("date_heure_prevue"),
        F.col("temperature").alias("temperature_prevue"),
        F.col("humidite").alias("humidite_prevue"),
        F.col("vitesse_vent").alias("vent_prevu"),
        F.col("categorie_meteo").alias("categorie_prevue"),
        F.col("description_meteo").alias("description_prevue"),
        F.coalesce("record_forecast_id", record_key(city_name(F.col("ville")), given_target)).alias(
            "id_prevision"
        ),
    )
    usable = parsed.where(all_present(F.col("date_heure_collecte"), F.col("date_heure_prevue")))
    horizon = whole_hours(F.col("date_heure_collecte"), F.col("date_heure_prevue"))
    return usable.withColumn("horizon_heures", horizon).select(*FORECAST_COLUMNS)


def duplicate_order(forecasts: DataFrame, *front: str) -> list[str]:
    """Sort terms: ``front``, then what decides between copies of one forecast: highest id, then values."""
    fixed = ("ville", "date_heure_collecte", "date_heure_prevue", "horizon_heures", "id_prevision")
    return breaking_ties(forecasts, [*front, "id_prevision DESC NULLS LAST"], fixed)


def stg_forecast(raw_forecast: DataFrame) -> DataFrame:
    """One row per city, collection time and target time."""
    clean = clean_forecasts(raw_forecast)
    keys = ["ville", "date_heure_collecte", "date_heure_prevue"]
    return first_per_key(clean, keys, duplicate_order(clean))
