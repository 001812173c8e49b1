"""Weather-shaped raw tables worked out from an ``events`` table, for checks and benchmarks.

Every event becomes one observation, and every (user, 3-hour slot) with events gets forecasts at six
horizons, so both tables grow with ``events``. Formulas are in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veracast.schemas import RAW_FORECAST, RAW_WEATHER
from veracast.session import pin_utc

HORIZONS = (6, 12, 18, 24, 30, 48)

_CITY = """CASE user_id WHEN 0 THEN 'Lisbon' WHEN 1 THEN 'Paris' WHEN 2 THEN 'Rome'
  WHEN 3 THEN 'Amsterdam' ELSE concat('V', user_id) END"""
_SLOT = "unix_seconds(CAST(ts AS TIMESTAMP)) DIV 10800"
_TEMPERATURE = "(slot + user_id * 5) % 66 - 14"
_WIND = "(slot * 13 + user_id * 3) % 230 / 10D"
_HUMIDITY = "10 + (slot * 17 + user_id) % 80"


def _iso(epoch: str) -> str:
    return f"date_format(timestamp_seconds({epoch}), \"yyyy-MM-dd'T'HH:mm:ssxxx\")"


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.parquet(f"{folder}/events.parquet")


def weather_from_events(events: DataFrame) -> DataFrame:
    """raw_weather: one observation per event."""
    pin_utc(events.sparkSession)
    timed = events.selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "unix_seconds(CAST(ts AS TIMESTAMP)) AS time_api",
        f"{_SLOT} AS slot",
        f"{_CITY} AS ville",
    )
    return timed.selectExpr(
        f"concat(ville, '_', {_iso('time_api')}) AS record_id",
        "ville",
        f"{_TEMPERATURE} + (event_id % 21 - 10) / 10D AS temperature",
        f"{_HUMIDITY} + event_id % 10 AS humidite",
        f"{_WIND} + event_id % 9 / 10D AS vitesse_vent",
        """CASE event_type WHEN 'click' THEN 'Clear' WHEN 'view' THEN 'Clouds'
             WHEN 'purchase' THEN 'Rain' WHEN 'signup' THEN 'Drizzle'
             WHEN 'error' THEN CASE event_id % 4 WHEN 0 THEN 'Snow' WHEN 1 THEN 'Thunderstorm'
               WHEN 2 THEN 'Mist' END END AS categorie_meteo""",
        "event_type AS description_meteo",
        "time_api",
        f"{_iso('time_api + event_id % 50 * 60')} AS heure_run",
    ).select(*RAW_WEATHER.names)


def forecast_from_events(events: DataFrame) -> DataFrame:
    """raw_forecast: six horizons per (user, slot), with gaps, bad fields and copies on purpose."""
    pin_utc(events.sparkSession)
    slots = events.selectExpr("user_id", f"{_SLOT} AS slot").distinct()
    # One entry per horizon with its finished collection time, so a later filter on that text stays
    # above the explode and the text is written once per row.
    collected = ", ".join(
        f"""struct({h}L AS h, CASE WHEN (slot + {h}) % 97 = 0 THEN 'garbage'
          ELSE {_iso(f"slot * 10800 - {h * 3600} - (slot + user_id) % 50 * 60")} END AS heure_run)"""
        for h in HORIZONS
    )
    made = slots.where("(slot * 3 + user_id) % 11 <> 0").selectExpr(
        "user_id",
        "slot",
        "slot * 10800 AS start",
        "1 + user_id % 3 AS k",
        f"{_CITY} AS ville",
        f"concat({_CITY}, '_', {_iso('slot * 10800')}) AS start_id",
        f"inline(array({collected}))",
    )
    # Slots divisible by 23 come twice, the second time without an id.
    twice = made.selectExpr(
        "*", "explode(IF(slot % 23 = 0, array(true, false), array(true))) AS keeps_id"
    )
    return twice.selectExpr(
        "IF(keeps_id AND (slot + h) % 10 <> 0, start_id, NULL) AS record_forecast_id",
        "ville",
        f"{_TEMPERATURE} + ((slot * 7 + h) % 41 - 20) * k / 10D AS temperature",
        f"{_HUMIDITY} + ((slot * 5 + h) % 27 - 13) * k AS humidite",
        f"{_WIND} + ((slot * 11 + h) % 41 - 20) * k / 10D AS vitesse_vent",
        """CASE (slot + h DIV 6 + user_id) % 7 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Clouds'
             WHEN 2 THEN 'Rain' WHEN 3 THEN 'Drizzle' WHEN 4 THEN 'Snow'
             WHEN 5 THEN 'Thunderstorm' END AS categorie_meteo""",
        "concat('h', h) AS description_meteo",
        "IF((slot + h) % 7 = 0, NULL, start) AS time_api",
        "heure_run",
        "IF((slot + h) % 3 = 0, NULL, start) AS forecast_timestamp",
    ).select(*RAW_FORECAST.names)


_DOCUMENT = """named_struct(
  'dt', time_api,
  'main', named_struct('temp', temperature, 'humidity', humidite),
  'wind', named_struct('speed', vitesse_vent),
  'weather', array(named_struct('main', categorie_meteo, 'description', description_meteo)))"""


def current_documents(events: DataFrame) -> DataFrame:
    """(ville, body): every observation as the API document it would come from."""
    return weather_from_events(events).selectExpr("ville", f"to_json({_DOCUMENT}) AS body")


def forecast_documents(events: DataFrame) -> DataFrame:
    """(ville, body): per observation a forecast document of 0 to 3 slots, 3 hours apart.

    Slot i is i degrees warmer than the observation; a document of no slots lacks its list.
    """
    slot = _DOCUMENT.replace("time_api", "time_api + i * 10800").replace(
        "temperature", "temperature + i"
    )
    listed = f"to_json(named_struct('list', transform(sequence(1, n), i -> {slot})))"
    counted = weather_from_events(events).selectExpr("*", "CAST(time_api % 4 AS INT) AS n")
    return counted.selectExpr("ville", f"IF(n = 0, '{{}}', {listed}) AS body")


def wire_messages(events: DataFrame) -> DataFrame:
    """(key, value): every observation as a topic message, spoiled by its second.

    Last digit 0: no JSON. 1: fractional humidity. 2: legacy names only. 3: temperature given as
    null beside its legacy name. 4: wrapped in an array. Others are sound.
    """
    rest = "record_id, ville, vitesse_vent, time_api, heure_run"
    record = f"struct({', '.join(RAW_WEATHER.names)})"
    spoiled = f"""CASE time_api % 10
      WHEN 0 THEN 'no json'
      WHEN 1 THEN to_json(struct({rest}, humidite + 0.5D AS humidite))
      WHEN 2 THEN to_json(struct({rest}, temperature AS `température`, humidite AS `humidité`,
        categorie_meteo AS `catégorie météo`, description_meteo AS `description météo`))
      WHEN 3 THEN to_json(struct({rest}, humidite, categorie_meteo, description_meteo,
        CAST(NULL AS DOUBLE) AS temperature, temperature AS `température`),
        map('ignoreNullFields', 'false'))
      WHEN 4 THEN concat('[', to_json({record}), ']')
      ELSE to_json({record}) END"""
    return weather_from_events(events).selectExpr(
        "CAST(ville AS BINARY) AS key", f"CAST({spoiled} AS BINARY) AS value"
    )


def deliveries(records: DataFrame, key: str) -> DataFrame:
    """``records`` as two overlapping deliveries (column ``delivery``) of a topic.

    The first leaves out a third of the records, the second another third. In the second, all values
    are 100 degrees warmer, a fifth of the records comes once more, 200 degrees warmer, and a seventh
    has lost its key.
    """
    listed = """explode(filter(array(
      IF(humidite % 3 <> 2, named_struct('delivery', 0, 'warmer', 0D), NULL),
      IF(humidite % 3 <> 0, named_struct('delivery', 1, 'warmer', 100D), NULL),
      IF(humidite % 3 <> 0 AND humidite % 5 = 0, named_struct('delivery', 1, 'warmer', 200D), NULL)),
      d -> d IS NOT NULL)) AS d"""
    changed = {
        key: f"IF(d.delivery = 1 AND humidite % 7 = 0, NULL, {key}) AS {key}",
        "temperature": "temperature + d.warmer AS temperature",
    }
    return records.selectExpr("*", listed).selectExpr(
        *[changed.get(c, c) for c in records.columns], "d.delivery"
    )


def junk_messages(records: DataFrame) -> DataFrame:
    """(key, value): a message that is no JSON for each record of an eleventh."""
    return records.where("humidite % 11 = 0").selectExpr(
        "CAST(ville AS BINARY) AS key", "CAST('no json' AS BINARY) AS value"
    )


# Days of a month in three deliveries; a seventh of the seconds comes one delivery late.
ARRIVES = "least((time_api - 1704067200) DIV 864000 + IF(time_api % 7 = 0, 1, 0), 2)"
