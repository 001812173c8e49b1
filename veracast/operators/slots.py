"""Hourly observations to 3-hour slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.group import GroupedData

from veracast.functions.scalars import round_half_up, slot_start


def slot_means(grouped: GroupedData, start: Column) -> DataFrame:
    """Mean measures of grouped hours; category and description of the earliest hour.

    ``start`` is the slot's start, given in terms of the grouping columns.
    """
    words = F.struct("categorie_meteo", "description_meteo")
    means = grouped.agg(
        F.avg("temperature").alias("t"),
        F.avg("vitesse_vent").alias("v"),
        F.avg("humidite").alias("h"),
        F.min_by(words, F.col("heure_meteo")).alias("w"),
    )
    return means.select(
        "ville",
        start.alias("date_heure"),
        round_half_up(F.col("t"), 2).alias("temperature_reelle"),
        round_half_up(F.col("v"), 2).alias("vent_reel"),
        round_half_up(F.col("h"), 2).alias("humidite_reelle"),
        F.col("w.categorie_meteo").alias("categorie_reelle"),
        F.col("w.description_meteo").alias("description_reelle"),
    )


def average_by_slot(hourly: DataFrame) -> DataFrame:
    """Mean measures per city and 3-hour slot.

    ``hourly`` holds one row per (ville, heure_meteo), so a slot has three rows at most.
    """
    slot = slot_start(F.col("heure_meteo")).alias("date_heure")
    return slot_means(hourly.groupBy("ville", slot), F.col("date_heure"))
