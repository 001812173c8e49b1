"""Business rules: labels, risk levels and scores, as Column functions.

Each rule is one conditional expression, so it stays inside whole-stage code generation. A missing
operand makes a condition unknown, and an unknown condition does not match.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ---------------------------------------------------------------------------------------------
# Every name, label, text and threshold the rules need.
CITY_NAMES = {"Lisbon": "Lisbonne"}

CATEGORY_LABELS = {
    "Rain": "Pluie",
    "Clouds": "Nuageux",
    "Clear": "Ciel dégagé",
    "Snow": "Neige",
    "Thunderstorm": "Orage",
    "Drizzle": "Bruine",
}
CATEGORY_UNKNOWN = "Inconnu"

RISK_LABELS = ("Aucun risque", "Risque modéré", "Risque fort")
SEVERE_CATEGORIES = ("Snow", "Thunderstorm")
MODERATE_CATEGORIES = ("Rain",)
MODERATE_CATEGORIES_OBSERVED = ("Rain", "Drizzle")
SEVERE_BELOW, SEVERE_ABOVE = -10, 45
MODERATE_BELOW, MODERATE_FROM = -5, 35
SEVERE_WIND, MODERATE_WIND = 20, 17

# Largest gap that still earns 3, 2 and 1 points.
TEMPERATURE_STEPS = (1, 2, 3)
WIND_STEPS = (1, 2, 3.5)
HUMIDITY_STEPS = (5, 10, 20)
FULL_SCORE = 9.0

RELIABILITY_FLOORS = ((8, "très fiable"), (6, "fiable"), (4, "assez fiable"))
CONFIDENCE_FLOORS = ((85, "très fiable"), (70, "fiable"), (55, "assez fiable"))
UNRELIABLE = "pas fiable"
INCOMPLETE = "incomplet"
TOO_FEW = "insuffisant"
CONFIDENCE_MIN_COUNT = 8
ADVICE_MIN_COUNT = 10

ADVICE_NO_HISTORY = "Confiance inconnue (pas d’historique)"
ADVICE_TOO_FEW = "Données insuffisantes : prudence"
ADVICE_BY_LEVEL = {
    "très fiable": "Prévision à suivre",
    "fiable": "Prévision à suivre",
    "assez fiable": "Prévision plausible",
}
ADVICE_OTHERWISE = "Prévision incertaine : prévoir une marge"
# ---------------------------------------------------------------------------------------------


def _translate(x: Column, names: dict[str, str], otherwise: Column) -> Column:
    """Replace the listed values, give ``otherwise`` for all others."""
    out: Column | None = None
    for source, target in names.items():
        out = F.when(x == source, target) if out is None else out.when(x == source, target)
    return out.otherwise(otherwise)


def _by_floor(x: Column, floors, below: str, start: Column) -> Column:
    """Label of the highest floor reached; ``start`` holds the cases decided beforehand."""
    for floor, label in floors:
        start = start.when(x >= floor, label)
    return start.otherwise(below)


def city_name(city: Column) -> Column:
    """One spelling per city."""
    return _translate(city, CITY_NAMES, city)


def category_label(category: Column) -> Column:
    """Display name of a weather category; unlisted ones stay as they are."""
    return _translate(category, CATEGORY_LABELS, F.coalesce(category, F.lit(CATEGORY_UNKNOWN)))


def risk_index(
    temperature: Column, wind: Column, category: Column, *, drizzle_is_risk: bool
) -> Column:
    """Logistics risk 0, 1 or 2. Drizzle counts for observations only, not for forecasts."""
    temp = F.nanvl(temperature, F.lit(None).cast("double"))
    speed = F.nanvl(wind, F.lit(None).cast("double"))
    severe = (
        (temp < SEVERE_BELOW)
        | (temp > SEVERE_ABOVE)
        | category.isin(*SEVERE_CATEGORIES)
        | (speed >= SEVERE_WIND)
    )
    wet = MODERATE_CATEGORIES_OBSERVED if drizzle_is_risk else MODERATE_CATEGORIES
    # Asked only once `severe` is not true, so neither temperature band needs its outer bound.
    moderate = (
        (temp >= MODERATE_FROM)
        | (temp < MODERATE_BELOW)
        | category.isin(*wet)
        | (speed >= MODERATE_WIND)
    )
    return F.when(severe, F.lit(2)).when(moderate, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def risk_label(index: Column) -> Column:
    none, moderate, severe = RISK_LABELS
    return F.when(index == 0, none).when(index == 1, moderate).otherwise(severe)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def all_present(*columns: Column) -> Column:
    out = columns[0].isNotNull()
    for c in columns[1:]:
        out = out & c.isNotNull()
    return out


def gap_points(forecast: Column, observed: Column, steps) -> Column:
    """3 to 0 points by how far the forecast was off; null if either side is missing."""
    gap = F.abs(forecast - observed)
    three, two, one = steps
    return (
        F.when(gap <= three, F.lit(3))
        .when(gap <= two, F.lit(2))
        .when(gap <= one, F.lit(1))
        .when(gap.isNotNull(), F.lit(0))
        .cast("bigint")
    )


def reliability_level(points: Column) -> Column:
    """Grade of the summed points (0-9); null sum means something was missing."""
    return _by_floor(points, RELIABILITY_FLOORS, UNRELIABLE, F.when(points.isNull(), INCOMPLETE))


def confidence_level(count: Column, mean_score: Column) -> Column:
    """Grade of a city and category's past scores."""
    few = F.when(count < CONFIDENCE_MIN_COUNT, TOO_FEW)
    return _by_floor(mean_score, CONFIDENCE_FLOORS, UNRELIABLE, few)


def advice(count: Column, level: Column) -> Column:
    """What to do with a forecast, given the history of its city and category."""
    known = F.when(count.isNull(), ADVICE_NO_HISTORY).when(count < ADVICE_MIN_COUNT, ADVICE_TOO_FEW)
    for name, text in ADVICE_BY_LEVEL.items():
        known = known.when(level == name, text)
    return known.otherwise(ADVICE_OTHERWISE)
