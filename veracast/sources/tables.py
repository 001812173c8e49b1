"""Raw landing tables and model tables on shared storage, all of them versioned.

A raw table is parted by the day read from the key itself: equal keys always share a part, so a merge
reads only the days its batch touches. Rows whose key has a null part match nothing and have a part of
their own, as have keys that name no day.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from veracast.functions.rules import all_present
from veracast.functions.scalars import epoch_instant, parse_instant
from veracast.schemas import RAW_FORECAST, RAW_WEATHER
from veracast.session import pin_utc
from veracast.sources.versions import VersionedTable

UNKEYED, UNDATED = "unkeyed", "undated"


def day_in_id(key: str) -> Callable[[], Column]:
    """Day written behind the last underscore of an id; null if there is none."""
    return lambda: F.to_date(parse_instant(F.substring_index(key, "_", -1)))


def day_of_epoch(name: str) -> Callable[[], Column]:
    return lambda: F.to_date(epoch_instant(F.col(name)))


def day_part(instant: Column) -> Column:
    """A day as the name of a part."""
    return F.date_format(instant, "yyyy-MM-dd")


@dataclass(frozen=True)
class RawTable:
    """Schema, merge key and the day a key belongs to (a function of the key alone)."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    day: Callable[[], Column]

    def part(self) -> Column:
        """The part of the table a row belongs to."""
        whole = all_present(*[F.col(k) for k in self.key])
        return F.when(whole, F.coalesce(day_part(self.day()), F.lit(UNDATED))).otherwise(UNKEYED)


RAW_WEATHER_TABLE = RawTable("raw_weather", RAW_WEATHER, ("record_id",), day_in_id("record_id"))
# The id names city and target time only, so later collections of a slot are never stored.
RAW_FORECAST_TABLE = RawTable(
    "raw_forecast", RAW_FORECAST, ("record_forecast_id",), day_in_id("record_forecast_id")
)
# Keeps every collection of a slot, which the choice of the forecast nearest 24 hours needs.
RAW_FORECAST_HISTORY_TABLE = RawTable(
    "raw_forecast", RAW_FORECAST, ("ville", "time_api", "heure_run"), day_of_epoch("time_api")
)


def read_raw(
    spark: SparkSession, table: RawTable, path: str, parts: Iterable[str] | None = None
) -> DataFrame:
    """Rows of a raw table, of some parts if given. Files older than a column give null for it."""
    pin_utc(spark)
    return VersionedTable(spark, path).read(table.schema, parts)


def row_count(spark: SparkSession, path: str) -> int | None:
    """Rows of a raw table as its landings counted them, without reading it."""
    return VersionedTable(spark, path).version().notes.get("rows")


def compact_raw(spark: SparkSession, table: RawTable, path: str, least: int = 8) -> list[str]:
    """Join the writes of parts that have many; older versions stay readable until they expire."""
    pin_utc(spark)
    store = VersionedTable(spark, path)
    joined = store.compact(table.schema, least)
    store.expire()
    return joined


# Tables whose stored name differs from the model's.
ALIASES = {
    "stg_forecast": "previsions_meteo_nettoyees",
    "int_forecast_24h": "previsions_cible_24h",
    "mart_weather_accuracy_24h": "fiabilite_previsions_24h",
    "mart_reliability_reference": "mart_fiabilite_reference_ville_categorie_24h",
    "mart_next_two_days": "mart_previsions_demain_apresdemain",
}


def model_path(folder: str, model: str) -> str:
    return f"{folder.rstrip('/')}/{ALIASES.get(model, model)}"


def write_model(
    df: DataFrame,
    folder: str,
    model: str,
    part: Column | None = None,
    checks: dict[str, Column] | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """Replace a model's table; returns it as read back, and how many rows meet each check.

    Readers see the old table until the new one is whole, also if the job dies on the way. Reading
    back cuts the lineage: later models start from files that outlive any executor. ``part`` lays
    the table out in parts (days), which a reader can ask for.
    """
    table = VersionedTable(df.sparkSession, model_path(folder, model))
    counts = table.replace(df, part, checks)
    return table.read(), counts


def read_model(
    spark: SparkSession, folder: str, model: str, parts: Iterable[str] | None = None
) -> DataFrame:
    """A model's table as last committed, or some of its parts."""
    pin_utc(spark)
    return VersionedTable(spark, model_path(folder, model)).read(parts=parts)
