"""Every rule at, just under and just over its thresholds, with missing operands."""

import pytest
from pyspark.sql import functions as F

from veracast.functions import rules

RISK_ROWS = [
    # temperature, wind, category, observed, forecast
    (-10.1, 0.0, "Clear", 2, 2),
    (-10.0, 0.0, "Clear", 1, 1),
    (-5.1, 0.0, "Clear", 1, 1),
    (-5.0, 0.0, "Clear", 0, 0),
    (34.9, 0.0, "Clear", 0, 0),
    (35.0, 0.0, "Clear", 1, 1),
    (45.0, 0.0, "Clear", 1, 1),
    (45.1, 0.0, "Clear", 2, 2),
    (20.0, 16.9, "Clear", 0, 0),
    (20.0, 17.0, "Clear", 1, 1),
    (20.0, 19.9, "Clear", 1, 1),
    (20.0, 20.0, "Clear", 2, 2),
    (20.0, 0.0, "Snow", 2, 2),
    (20.0, 0.0, "Thunderstorm", 2, 2),
    (20.0, 0.0, "Rain", 1, 1),
    (20.0, 0.0, "Drizzle", 1, 0),
    (20.0, 0.0, "Clouds", 0, 0),
    (20.0, 0.0, "Mist", 0, 0),
    (None, 0.0, "Rain", 1, 1),
    (None, None, "Snow", 2, 2),
    (None, 20.0, None, 2, 2),
    (36.0, None, None, 1, 1),
    (None, None, None, 0, 0),
    (float("nan"), float("nan"), "Clear", 0, 0),
]


def test_risk_index(spark):
    df = spark.createDataFrame(RISK_ROWS, "t double, w double, c string, o bigint, f bigint")
    args = [F.col("t"), F.col("w"), F.col("c")]
    got = df.select(
        "*",
        rules.risk_index(*args, drizzle_is_risk=True).alias("go"),
        rules.risk_index(*args, drizzle_is_risk=False).alias("gf"),
    ).collect()
    assert [(r.go, r.gf) for r in got] == [r[3:] for r in RISK_ROWS]


def test_labels(spark):
    rows = [
        ("Lisbon", "Rain", 0),
        ("Lisbonne", "Clouds", 1),
        ("Paris", "Clear", 2),
        (None, "Snow", None),
        ("x", "Thunderstorm", 0),
        ("x", "Drizzle", 0),
        ("x", None, 0),
        ("x", "Mist", 0),
    ]
    df = spark.createDataFrame(rows, "v string, c string, r bigint")
    got = df.select(
        rules.city_name(F.col("v")), rules.category_label(F.col("c")), rules.risk_label(F.col("r"))
    ).collect()
    assert [tuple(r) for r in got] == [
        ("Lisbonne", "Pluie", "Aucun risque"),
        ("Lisbonne", "Nuageux", "Risque modéré"),
        ("Paris", "Ciel dégagé", "Risque fort"),
        (None, "Neige", "Risque fort"),
        ("x", "Orage", "Aucun risque"),
        ("x", "Bruine", "Aucun risque"),
        ("x", "Inconnu", "Aucun risque"),
        ("x", "Mist", "Aucun risque"),
    ]


@pytest.mark.parametrize(
    "steps, gaps",
    [
        (rules.TEMPERATURE_STEPS, [0, 1, 1.01, 2, 2.01, 3, 3.01]),
        (rules.WIND_STEPS, [0, 1, 1.01, 2, 2.01, 3.5, 3.51]),
        (rules.HUMIDITY_STEPS, [0, 5, 5.01, 10, 10.01, 20, 20.01]),
    ],
)
def test_gap_points(spark, steps, gaps):
    rows = [(float(g), 0.0) for g in gaps] + [(None, 0.0), (0.0, None), (None, None)]
    df = spark.createDataFrame(rows, "f double, o double")
    got = [r[0] for r in df.select(rules.gap_points(F.col("f"), F.col("o"), steps)).collect()]
    assert got == [3, 3, 2, 2, 1, 1, 0, None, None, None]


def test_levels(spark):
    points = [0, 3, 4, 5, 6, 7, 8, 9, None]
    df = spark.createDataFrame([(p,) for p in points], "p bigint")
    got = [r[0] for r in df.select(rules.reliability_level(F.col("p"))).collect()]
    assert got == ["pas fiable"] * 2 + ["assez fiable"] * 2 + ["fiable"] * 2 + [
        "très fiable"
    ] * 2 + ["incomplet"]

    history = [
        (7, 99.0, "insuffisant", "Données insuffisantes : prudence"),
        (8, 54.99, "pas fiable", "Données insuffisantes : prudence"),
        (9, 85.0, "très fiable", "Données insuffisantes : prudence"),
        (10, 85.0, "très fiable", "Prévision à suivre"),
        (10, 84.99, "fiable", "Prévision à suivre"),
        (10, 70.0, "fiable", "Prévision à suivre"),
        (10, 69.99, "assez fiable", "Prévision plausible"),
        (10, 55.0, "assez fiable", "Prévision plausible"),
        (10, 54.99, "pas fiable", "Prévision incertaine : prévoir une marge"),
    ]
    df = spark.createDataFrame([h[:2] for h in history], "n bigint, m double")
    level = rules.confidence_level(F.col("n"), F.col("m"))
    got = df.select(level, rules.advice(F.col("n"), level)).collect()
    assert [tuple(r) for r in got] == [h[2:] for h in history]
    none = F.lit(None)
    unknown = spark.range(1).select(rules.advice(none.cast("bigint"), none.cast("string")))
    assert unknown.first()[0] == "Confiance inconnue (pas d’historique)"
