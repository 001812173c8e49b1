"""Work out a costly expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with the given columns, each evaluated once even if rows are then filtered on it.

    A filter on a plain projected column is pushed below the projection, which repeats the whole
    expression (a JSON or time parse) there and again above. Filters do not move below an explode
    on the column it makes, so the values are put in an array of one and taken out again.
    """
    made = F.struct(*[value.alias(name) for name, value in columns.items()])
    kept = df.select("*", F.explode(F.array(made)).alias("__once"))
    return kept.select(*df.columns, *[F.col(f"__once.{name}").alias(name) for name in columns])
