"""Full refresh: every model rebuilt in order, each from its parents' tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from veracast.plans import marts, staging
from veracast.plans.quality import counted_report, counting_times, null_checks, observed_times
from veracast.session import pin_utc
from veracast.sources.tables import day_part, read_model, write_model


def days_ahead(as_of: dt.date | str | None = None) -> list[str]:
    """The two days after ``as_of`` (today in UTC by default), as parts of a table."""
    today = as_of or dt.datetime.now(dt.timezone.utc).date()
    if isinstance(today, str):
        today = dt.date.fromisoformat(today)
    return [(today + dt.timedelta(days=n)).isoformat() for n in (1, 2)]


def rebuild(
    raw_weather: DataFrame,
    raw_forecast: DataFrame,
    folder: str,
    as_of: dt.date | str | None = None,
    rows: dict[str, int | None] | None = None,
) -> dict[str, DataFrame]:
    """Write all models under ``folder`` and return them as read back, with the quality report.

    Every table is replaced at once, when it is whole. Missing values and unreadable times are
    counted by the writes themselves; ``rows`` gives the raw tables' sizes, if known, to check those
    counts by. Staged forecasts are laid out by target day, so the next two days are read alone.
    """
    spark = pin_utc(raw_weather.sparkSession)
    as_of = as_of or dt.datetime.now(dt.timezone.utc).date()
    out: dict[str, DataFrame] = {}
    counts: dict[str, dict[str, int]] = {}

    def build(name: str, df: DataFrame, part: Column | None = None) -> DataFrame:
        out[name], found = write_model(df, folder, name, part, null_checks(name))
        if found.keys() - {"rows"}:
            counts[name] = {c: n for c, n in found.items() if c != "rows"}
        return out[name]

    known = rows or {}
    seen_weather, weather_times = counting_times(raw_weather)
    seen_forecast, forecast_times = counting_times(raw_forecast)
    observed = build("stg_weather_stream", staging.stg_weather_stream(seen_weather))
    by_target = day_part(F.col("date_heure_prevue"))
    forecasts = build("stg_forecast", staging.stg_forecast(seen_forecast), by_target)
    weather = build("mart_weather_stream", marts.mart_weather_stream(observed))
    chosen = build("int_forecast_24h", marts.int_forecast_24h(forecasts))
    accuracy = build(
        "mart_weather_accuracy_24h", marts.mart_weather_accuracy_24h(weather, chosen)
    )
    reference = build(
        "mart_reliability_reference", marts.mart_reliability_reference(accuracy)
    )
    ahead = read_model(spark, folder, "stg_forecast", days_ahead(as_of))
    build("mart_next_two_days", marts.mart_next_two_days(ahead, reference, as_of))
    counts["raw_weather"] = observed_times(raw_weather, weather_times, known.get("raw_weather"))
    counts["raw_forecast"] = observed_times(raw_forecast, forecast_times, known.get("raw_forecast"))
    build("quality_report", counted_report(spark, counts))
    return out
