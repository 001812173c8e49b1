"""Summary indicators over the marts.

The source project names these indicators without giving formulas; the definitions are this
package's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from veracast.functions.rules import risk_label
from veracast.functions.scalars import round_half_up


def _share(part: Column, whole: Column) -> Column:
    return round_half_up(part / whole, 4)


def risk_by_city(weather: DataFrame) -> DataFrame:
    """Observed hours per city and risk level."""
    return weather.groupBy("ville", "niveau_risque").agg(F.count("*").alias("nb_heures"))


def high_risk_slots(weather: DataFrame) -> DataFrame:
    """Per city and hour of day, how many observed hours carried the highest risk."""
    severe = F.count_if(F.col("indice_risque_meteo") == 2)
    counted = weather.groupBy("ville", "heure").agg(
        F.count("*").alias("nb_heures"), severe.alias("nb_risque_fort")
    )
    return counted.withColumn(
        "part_risque_fort", _share(F.col("nb_risque_fort"), F.col("nb_heures"))
    )


def risk_next_48h(outlook: DataFrame) -> DataFrame:
    """Highest forecast risk per city and day of the two-day outlook."""
    worst = outlook.groupBy("ville", "jour_prevu").agg(
        F.count("*").alias("nb_creneaux"),
        F.max("indice_risque_meteo_prevu").alias("risque_max"),
    )
    return worst.withColumn("niveau_risque_max", risk_label(F.col("risque_max")))


def category_distribution(weather: DataFrame) -> DataFrame:
    """Observed hours per city and category, with the category's share of the city.

    City totals are summed and joined back: a window would hold all of a city's categories, which
    are free text, in one task.
    """
    counted = weather.groupBy("ville", "categorie_meteo").agg(F.count("*").alias("nb_heures"))
    totals = counted.groupBy(F.col("ville").alias("_ville")).agg(F.sum("nb_heures").alias("_all"))
    joined = counted.join(totals, F.col("ville").eqNullSafe(F.col("_ville")))
    return joined.withColumn("part", _share(F.col("nb_heures"), F.col("_all"))).drop(
        "_ville", "_all"
    )


def global_reliability(accuracy: DataFrame) -> DataFrame:
    """Mean reliability score, overall and per city.

    Scores have one decimal, so they are summed as decimals: exact in any order. The overall row
    adds up the cities' sums and does not read the slots again.
    """
    scores = F.col("score_fiabilite_0_100").cast("decimal(9,1)")
    by_city = (
        accuracy.where(scores.isNotNull())
        .groupBy("ville")
        .agg(F.sum(scores).cast("decimal(28,1)").alias("s"), F.count("*").alias("n"))
    )
    both = by_city.rollup("ville").agg(
        F.grouping("ville").alias("g"), F.sum("s").alias("s"), F.sum("n").alias("n")
    )
    return both.select(
        F.when(F.col("g") == 1, "global").otherwise("ville").alias("portee"),
        "ville",
        F.col("n").alias("nb_creneaux"),
        round_half_up(F.col("s").cast("double") / F.col("n"), 2).alias("score_moyen"),
    )


def most_unstable_city(weather: DataFrame) -> DataFrame:
    """The city with the largest share of hours at risk 1 or 2; first by name on a tie."""
    counted = weather.groupBy("ville").agg(
        F.count("*").alias("nb_heures"),
        F.count_if(F.col("indice_risque_meteo") >= 1).alias("nb_heures_a_risque"),
    )
    share = F.col("nb_heures_a_risque") / F.col("nb_heures")
    top = counted.orderBy(share.desc(), F.col("ville").asc()).limit(1)
    return top.withColumn("part_a_risque", round_half_up(share, 4))
