import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from veracast.functions import scalars as s


def _one(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_round_half_up(spark):
    rows = [(x,) for x in (1.005, 2.675, 0.1 + 0.2, -1.005, 1e300, None, float("inf"))]
    got = _one(spark, rows, "x double", s.round_half_up(F.col("x"), 2))
    assert got == [1.01, 2.68, 0.3, -1.01, 1e300, None, float("inf")]


def test_parse_instant(spark):
    texts = [
        "2024-01-01T02:00:00+02:00",
        "2024-01-01 00:00:00.5",
        "2024-01-01",
        "garbage",
        "",
        None,
        "10:30",
        "T10:30",
        "2024",
        "2024-01",
        "2024-13-01T00:00:00",
    ]
    got = _one(spark, [(t,) for t in texts], "x string", s.parse_instant(F.col("x")))
    midnight = dt.datetime(2024, 1, 1)
    assert got == [midnight, midnight.replace(microsecond=500000), midnight] + [None] * 8


def test_epoch_instant(spark):
    rows = [(0,), (1704067200,), (None,), (2**63 - 1,), (-(2**63),)]
    got = _one(spark, rows, "x bigint", s.epoch_instant(F.col("x")).cast("string"))
    assert got == ["1970-01-01 00:00:00", "2024-01-01 00:00:00", None, None, None]
    texts = _one(spark, [("12",), ("1.5",), ("x",)], "x string", s.epoch_instant(F.col("x")).cast("string"))
    assert texts == ["1970-01-01 00:00:12", None, None]


def test_hours_and_slots(spark):
    rows = [
        ("2024-01-01 00:00:00", "2024-01-01 00:59:59"),
        ("2024-01-01 01:30:00", "2024-01-01 00:00:00"),
        ("2024-01-01 02:59:59", "2024-01-02 02:59:59"),
    ]
    df = spark.createDataFrame(rows, "a string, b string").selectExpr(
        "cast(a as timestamp) a", "cast(b as timestamp) b"
    )
    got = df.select(
        s.whole_hours(F.col("a"), F.col("b")), s.slot_start(F.col("b")).cast("string")
    ).collect()
    assert [tuple(r) for r in got] == [
        (0, "2024-01-01 00:00:00"),
        (-1, "2024-01-01 00:00:00"),
        (24, "2024-01-02 00:00:00"),
    ]


def test_keys(spark):
    keys = ["Paris_2024-01-01T00:00:00+00:00", "Paris", "a_b_c", None]
    assert _one(spark, [(k,) for k in keys], "x string", s.key_suffix(F.col("x"))) == [
        "2024-01-01T00:00:00+00:00",
        None,
        "b",
        None,
    ]
    got = _one(
        spark,
        [("Rome", 1704067200), ("Rome", None)],
        "v string, e bigint",
        s.record_key(F.col("v"), s.epoch_instant(F.col("e"))),
    )
    assert got == ["Rome_2024-01-01T00:00:00+00:00", None]


def test_rounding_near_ties_and_noise(spark):
    values = [(2.4949999996, 2.49), (0.1 + 0.2, 0.3), (2.675, 2.68), (1.005, 1.01), (-1.005, -1.01)]
    rows = spark.createDataFrame(values, "x double, want double")
    assert rows.where(s.round_half_up(F.col("x"), 2) != F.col("want")).count() == 0


def test_rounding_without_decimals_is_the_same(spark):
    """Values clear of a tie skip the decimal; every bit, also the sign of 0, is as with it."""
    draw = np.random.default_rng(0)
    values = [*draw.normal(0, 50, 2000), *draw.integers(-20000, 20000, 2000) / 1000, *draw.normal(0, 1e8, 200)]
    values += [0.0, -0.0, -0.001, 0.005, -0.005, 1e6 + 0.005, 2.0**53, 1e30, -1e30, float("nan"), float("inf"), None]
    df = spark.createDataFrame([(None if x is None else float(x),) for x in values], "x double")
    for digits in (1, 2):
        exact = F.round(F.col("x").try_cast("decimal(38,12)"), digits).cast("double")
        want = F.coalesce(exact, F.round("x", digits))
        same = s.round_half_up(F.col("x"), digits).eqNullSafe(want)
        assert df.where(~same).count() == 0
        signs = F.concat(s.round_half_up(F.col("x"), digits).cast("string"), F.lit(" "), want.cast("string"))
        assert not [r for r in df.select(signs.alias("s")).collect() if r["s"] and len(set(r["s"].split())) > 1]
