"""Mart models: risk, forecast accuracy, reliability history and the two-day outlook."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from veracast.functions import rules
from veracast.functions.scalars import hour_of, round_half_up
from veracast.operators.slots import average_by_slot
from veracast.operators.top_one import first_per_key
from veracast.plans.staging import duplicate_order
from veracast.session import pin_utc

TARGET_HORIZON = 24


def mart_weather_stream(observations: DataFrame) -> DataFrame:
    """Observed hours with logistics risk and display category."""
    pin_utc(observations.sparkSession)
    risk = rules.risk_index(
        F.col("temperature"), F.col("vitesse_vent"), F.col("categorie_meteo"), drizzle_is_risk=True
    )
    return observations.select(
        "ville",
        "heure_meteo",
        F.to_date("heure_meteo").alias("jour"),
        hour_of(F.col("heure_meteo")).alias("heure"),
        "temperature",
        "humidite",
        "vitesse_vent",
        rules.category_label(F.col("categorie_meteo")).alias("categorie_meteo"),
        "description_meteo",
        risk.alias("indice_risque_meteo"),
        rules.risk_label(risk).alias("niveau_risque"),
    )


def _rounded_measures() -> list[Column]:
    names = ("temperature_prevue", "humidite_prevue", "vent_prevu")
    return [round_half_up(F.col(n), 2).alias(n) for n in names]


def int_forecast_24h(
    forecasts: DataFrame, tolerance: tuple[int, int] | None = None
) -> DataFrame:
    """For each city and target time, the forecast made nearest to 24 hours ahead.

    Later collection wins between equal gaps. ``tolerance`` keeps only horizons in that inclusive
    range; by default any horizon may be chosen.

    Takes the staging model or, equally, ``clean_forecasts``: the order goes on with the one staging
    uses between copies, so choosing straight from the clean rows gives the same row and spares the
    shuffle that removes copies first.
    """
    if tolerance is not None:
        forecasts = forecasts.where(F.col("horizon_heures").between(*tolerance))
    gap = f"abs(horizon_heures - {TARGET_HORIZON}) ASC"
    order = duplicate_order(forecasts, gap, "date_heure_collecte DESC")
    chosen = first_per_key(forecasts, ["ville", "date_heure_prevue"], order)
    return chosen.select(
        "ville",
        "date_heure_prevue",
        "date_heure_collecte",
        "horizon_heures",
        *_rounded_measures(),
        "categorie_prevue",
        "description_prevue",
    )


def mart_weather_accuracy_24h(
    weather: DataFrame, chosen: DataFrame, keep_uncovered: bool = False
) -> DataFrame:
    """Forecast against observation per city and 3-hour slot, with gaps, points and grade.

    Both sides arrive hashed on (city, slot) from their own aggregation and ranking, so the join
    itself moves nothing. Slots without a forecast are left out unless ``keep_uncovered``.
    """
    pin_utc(weather.sparkSession)
    observed = average_by_slot(weather)
    forecast = chosen.withColumnRenamed("date_heure_prevue", "date_heure")
    joined = observed.join(forecast, ["ville", "date_heure"], "left")
    if not keep_uncovered:
        joined = joined.where(F.col("date_heure_collecte").isNotNull())

    pairs = {
        "temperature": ("temperature_prevue", "temperature_reelle", rules.TEMPERATURE_STEPS),
        "vent": ("vent_prevu", "vent_reel", rules.WIND_STEPS),
        "humidite": ("humidite_prevue", "humidite_reelle", rules.HUMIDITY_STEPS),
    }
    graded = {}
    for name, (f, o, steps) in pairs.items():
        graded[f"ecart_{name}"] = round_half_up(F.abs(F.col(f) - F.col(o)), 2)
        graded[f"score_{name}_0_3"] = rules.gap_points(F.col(f), F.col(o), steps)
    sides = [F.col(c) for f, o, _ in pairs.values() for c in (f, o)]
    scored = joined.withColumns(graded).withColumns(
        {
            "prevision_disponible_24h": rules.flag(F.col("date_heure_collecte").isNotNull()),
            "comparaison_possible": rules.flag(rules.all_present(*sides)),
            "_points": sum((F.col(f"score_{n}_0_3") for n in pairs), F.lit(0).cast("bigint")),
        }
    )
    hour = hour_of(F.col("date_heure"))
    return scored.select(
        "ville",
        "date_heure",
        F.to_date("date_heure").alias("jour"),
        hour.alias("heure"),
        F.floor(hour / 3).alias("tranche_3h_index"),
        "prevision_disponible_24h",
        "comparaison_possible",
        "date_heure_collecte",
        "horizon_heures",
        *[
            c
            for name, (f, o, _) in pairs.items()
            for c in (f, o, f"ecart_{name}", f"score_{name}_0_3")
        ],
        "categorie_prevue",
        "categorie_reelle",
        "description_prevue",
        "description_reelle",
        round_half_up(F.col("_points") / F.lit(rules.FULL_SCORE) * 100, 1).alias(
            "score_fiabilite_0_100"
        ),
        rules.reliability_level(F.col("_points")).alias("niveau_fiabilite"),
    )


def mart_reliability_reference(accuracy: DataFrame) -> DataFrame:
    """Past reliability per city and forecast category."""
    comparable = rules.all_present(F.col("score_fiabilite_0_100"), F.col("categorie_prevue"))
    history = (
        accuracy.where(comparable)
        .groupBy("ville", "categorie_prevue")
        .agg(
            F.count("*").alias("nb_observations"),
            F.avg("score_fiabilite_0_100").alias("_mean"),
        )
    )
    mean = round_half_up(F.col("_mean"), 2)
    return history.select(
        "ville",
        "categorie_prevue",
        "nb_observations",
        mean.alias("score_fiabilite_moyen_0_100"),
        rules.confidence_level(F.col("nb_observations"), mean).alias(
            "niveau_confiance_historique"
        ),
    )


def mart_next_two_days(
    forecasts: DataFrame, reference: DataFrame, as_of: dt.date | str | None = None
) -> DataFrame:
    """Latest forecast per city and target time for the two days after ``as_of``, with risk and advice.

    ``as_of`` defaults to today (UTC). The day filter is a plain range on the target time, so it
    reaches a Parquet scan. Like ``int_forecast_24h`` this takes staged or clean forecasts.

    The history has one row per city and category and grows with the cities, so no broadcast is
    forced: Spark broadcasts it when its measured size allows.
    """
    pin_utc(forecasts.sparkSession)
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    target = F.col("date_heure_prevue")
    ahead = forecasts.where(
        (target >= F.date_add(today, 1).cast("timestamp"))
        & (target < F.date_add(today, 3).cast("timestamp"))
    )
    order = duplicate_order(ahead, "date_heure_collecte DESC")
    latest = first_per_key(ahead, ["ville", "date_heure_prevue"], order)
    # Risk reads the measures as forecast, before they are rounded for display.
    risk = rules.risk_index(
        F.col("temperature_prevue"),
        F.col("vent_prevu"),
        F.col("categorie_prevue"),
        drizzle_is_risk=False,
    )
    scored = latest.select(
        "ville",
        "date_heure_prevue",
        F.to_date(target).alias("jour_prevu"),
        hour_of(target).alias("heure_prevue"),
        F.col("date_heure_collecte").alias("date_heure_collecte_utilisee"),
        "horizon_heures",
        *_rounded_measures(),
        "categorie_prevue",
        "description_prevue",
        risk.alias("indice_risque_meteo_prevu"),
    )
    return scored.join(reference, ["ville", "categorie_prevue"], "left").select(
        "ville",
        "date_heure_prevue",
        "jour_prevu",
        "heure_prevue",
        "date_heure_collecte_utilisee",
        "horizon_heures",
        "temperature_prevue",
        "vent_prevu",
        "humidite_prevue",
        rules.category_label(F.col("categorie_prevue")).alias("categorie_prevue_fr"),
        F.col("categorie_prevue").alias("categorie_prevue_en"),
        "description_prevue",
        "indice_risque_meteo_prevu",
        rules.risk_label(F.col("indice_risque_meteo_prevu")).alias("niveau_risque_prevu"),
        "nb_observations",
        "score_fiabilite_moyen_0_100",
        "niveau_confiance_historique",
        rules.advice(F.col("nb_observations"), F.col("niveau_confiance_historique")).alias(
            "recommandation"
        ),
    )
