"""Shapes the physical plans must keep: early pruning, few shuffles, pushed filters."""

import pytest
from pyspark.sql import functions as F

from veracast.operators.merge import merge_insert_only
from veracast.operators.top_one import first_per_key
from veracast.plans import kpis, marts, staging
from veracast.plans.quality import counting_times
from veracast.schemas import RAW_FORECAST, RAW_WEATHER
from veracast.sources.tables import write_model


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    from __spark_entry__ import _Models

    m = _Models(spark, "/root/testdata/sf0.001")
    folder = tmp_path_factory.mktemp("raw")
    m.raw_weather().write.parquet(str(folder / "w"))
    m.raw_forecast().write.parquet(str(folder / "f"))
    return (
        spark.read.schema(RAW_WEATHER).parquet(str(folder / "w")),
        spark.read.schema(RAW_FORECAST).parquet(str(folder / "f")),
    )


@pytest.fixture()
def unhelped(spark):
    """No broadcast: the plan a table too large for it gets."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return text.count("Exchange hashpartitioning")


def test_ranking_prunes_before_its_shuffle(raw, unhelped):
    weather, forecasts = raw
    clean = staging.clean_forecasts(forecasts)
    for df in (
        staging.stg_weather_stream(weather),
        staging.stg_forecast(forecasts),
        marts.int_forecast_24h(clean),
    ):
        text = plan(df)
        assert shuffles(text) == 1
        assert ", Partial" in text and ", Final" in text
        assert text.index(", Final") < text.index("Exchange") < text.index(", Partial")


def test_accuracy_join_adds_no_shuffle(raw, unhelped):
    weather, forecasts = raw
    m3 = marts.mart_weather_stream(staging.stg_weather_stream(weather))
    m4 = marts.int_forecast_24h(staging.clean_forecasts(forecasts))
    text = plan(marts.mart_weather_accuracy_24h(m3, m4))
    assert shuffles(text) == 3  # newest per hour, slot means, chosen forecast
    assert "SortMergeJoin" in text and "Inner" in text


def test_no_pairwise_joins(raw, unhelped):
    weather, forecasts = raw
    clean = staging.clean_forecasts(forecasts)
    m3 = marts.mart_weather_stream(staging.stg_weather_stream(weather))
    m5 = marts.mart_weather_accuracy_24h(m3, marts.int_forecast_24h(clean))
    m7 = marts.mart_next_two_days(clean, marts.mart_reliability_reference(m5), "2024-01-15")
    for df in (m7, kpis.global_reliability(m5), kpis.category_distribution(m3)):
        text = plan(df)
        assert "Cartesian" not in text and "NestedLoop" not in text and "Broadcast" not in text


def test_day_filter_and_columns_reach_the_scan(raw, spark, tmp_path):
    _, forecasts = raw
    table, _ = write_model(staging.stg_forecast(forecasts), str(tmp_path), "stg_forecast")
    reference = spark.createDataFrame(
        [], "ville string, categorie_prevue string, nb_observations bigint, "
        "score_fiabilite_moyen_0_100 double, niveau_confiance_historique string",
    )
    text = plan(marts.mart_next_two_days(table, reference, "2024-01-15"))
    assert "GreaterThanOrEqual(date_heure_prevue,2024-01-16" in text
    assert "LessThan(date_heure_prevue,2024-01-18" in text
    counted = plan(kpis.risk_by_city(marts.mart_weather_stream(staging.stg_weather_stream(raw[0]))))
    assert "heure_run" in counted.split("ReadSchema:")[1]
    narrow = plan(table.select("ville"))
    assert "ReadSchema: struct<ville:string>" in narrow


def test_merge_shuffles_source_and_target_once(raw, unhelped):
    _, forecasts = raw
    text = plan(merge_insert_only(forecasts, forecasts, "record_forecast_id"))
    assert shuffles(text) == 2
    assert "LeftAnti" in text


def test_one_key_with_a_third_of_all_rows(spark):
    n = 90_000
    rows = spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1000).alias("k"),
        (F.col("id") * 7919 % n).alias("v"),
    )
    got = first_per_key(rows, ["k"], ["v DESC"])
    want = rows.groupBy("k").agg(F.max("v").alias("v"))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    got.write.format("noop").mode("overwrite").save()

    target = rows.where("k % 2 = 0")
    new = merge_insert_only(rows, target, "k", ["v DESC"])
    assert new.exceptAll(want.where("k % 2 <> 0")).count() == 0
    assert new.count() == want.where("k % 2 <> 0").count()


def test_collection_time_is_read_once(raw, unhelped):
    """Filter, projection and the count of unreadable times share one reading of ``heure_run``."""
    forecasts = raw[1]
    for df in (forecasts, counting_times(forecasts)[0]):
        assert plan(staging.stg_forecast(df)).count("try_cast(heure_run") == 1
