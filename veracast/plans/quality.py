"""Data-quality checks: one pass per table, one report row per checked column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from veracast.functions.scalars import epoch_instant, parse_instant
from veracast.plans.staging import RUN, with_run

# The columns that must not be null, per model.
NOT_NULL = {
    "stg_weather_stream": ("ville", "heure_meteo"),
    "stg_forecast": ("ville", "date_heure_prevue", "date_heure_collecte", "id_prevision"),
    "int_forecast_24h": ("ville", "date_heure_prevue"),
    "mart_weather_accuracy_24h": ("ville", "date_heure"),
}


def _count_rows(df: DataFrame, model: str, checks: dict[str, Column]) -> DataFrame:
    """Count the rows meeting each condition in a single pass; (model, column, failures) rows."""
    names = list(checks)
    counts = df.agg(*[F.count_if(checks[n]).alias(f"c{i}") for i, n in enumerate(names)])
    entries = [
        F.struct(F.lit(n).alias("column_name"), F.col(f"c{i}").alias("failures"))
        for i, n in enumerate(names)
    ]
    rows = counts.select(F.explode(F.array(*entries)).alias("e"))
    return rows.select(F.lit(model).alias("model_name"), "e.column_name", "e.failures")


def null_checks(model: str) -> dict[str, Column]:
    """Conditions that count a model's missing values while its table is written."""
    return {c: F.col(c).isNull() for c in NOT_NULL.get(model, ())}


def counted_report(spark: SparkSession, counts: dict[str, dict[str, int]]) -> DataFrame:
    """The report from counts that writes have already taken: table to column to failures."""
    rows = [(t, c, int(n)) for t, columns in counts.items() for c, n in columns.items()]
    return spark.createDataFrame(rows, "model_name string, column_name string, failures bigint")


def time_checks(raw: DataFrame) -> dict[str, Column]:
    """Conditions under which a time field is present but cannot be read.

    Staging turns such values into null instead of stopping the job, so they are counted.
    """
    checks = {"heure_run": F.col(RUN) if RUN in raw.columns else parse_instant(F.col("heure_run"))}
    for name in ("time_api", "forecast_timestamp"):
        if name in raw.columns:
            checks[name] = epoch_instant(F.col(name))
    return {n: F.col(n).isNotNull() & read.isNull() for n, read in checks.items()}


def counting_times(raw: DataFrame) -> tuple[DataFrame, Observation]:
    """``raw``, whose next job also counts its rows and unreadable times.

    The collection time is read for the count and stays, for staging to take up.
    """
    seen, raw = Observation(), with_run(raw)
    counts = [F.count_if(c).alias(n) for n, c in time_checks(raw).items()]
    return raw.observe(seen, F.count(F.lit(1)).alias("_rows"), *counts), seen


def observed_times(raw: DataFrame, seen: Observation, rows: int | None) -> dict[str, int]:
    """Unreadable times as counted on the way.

    A map task that a lost executor makes Spark repeat counts twice, which shows in the number of
    rows: if that is known and differs, the table is counted again by a scan of the time columns.
    """
    counts = dict(seen.get)
    if rows is not None and counts.pop("_rows") != rows:
        found = unreadable_times(raw, "").collect()
        return {r["column_name"]: r["failures"] for r in found}
    counts.pop("_rows", None)
    return counts


def not_null_report(models: dict[str, DataFrame]) -> DataFrame:
    """Null counts of the constrained columns of the given models."""
    parts = [
        _count_rows(df, name, {c: F.col(c).isNull() for c in NOT_NULL[name]})
        for name, df in models.items()
        if name in NOT_NULL
    ]
    return reduce(DataFrame.unionByName, parts)


def unreadable_times(raw: DataFrame, table: str) -> DataFrame:
    """Counts of time fields of a raw table that are present but cannot be read, by a scan."""
    return _count_rows(raw, table, time_checks(raw))
