"""Fixed schemas of the payloads, the raw tables and the topic messages."""

from pyspark.sql import types as T

# Field names and types of the weather API documents.
_MEASURES = T.StructType(
    [
        T.StructField("dt", T.LongType()),
        T.StructField(
            "main",
            T.StructType(
                [T.StructField("temp", T.DoubleType()), T.StructField("humidity", T.LongType())]
            ),
        ),
        T.StructField("wind", T.StructType([T.StructField("speed", T.DoubleType())])),
        T.StructField(
            "weather",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("main", T.StringType()),
                        T.StructField("description", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)
CURRENT_PAYLOAD = _MEASURES
FORECAST_PAYLOAD = T.StructType([T.StructField("list", T.ArrayType(_MEASURES))])

# Column names, order and types of the two landing tables.
RAW_WEATHER = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("ville", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidite", T.LongType()),
        T.StructField("vitesse_vent", T.DoubleType()),
        T.StructField("categorie_meteo", T.StringType()),
        T.StructField("description_meteo", T.StringType()),
        T.StructField("time_api", T.LongType()),
        T.StructField("heure_run", T.StringType()),
    ]
)
RAW_FORECAST = T.StructType(
    [
        T.StructField("record_forecast_id", T.StringType()),
        *RAW_WEATHER.fields[1:],
        T.StructField("forecast_timestamp", T.LongType()),
    ]
)

# Accented names older producers used for four of the fields.
LEGACY_NAMES = {
    "temperature": "température",
    "humidite": "humidité",
    "categorie_meteo": "catégorie météo",
    "description_meteo": "description météo",
}

MESSAGE = T.StructType(
    [T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType())]
)
