"""The whole chain as jobs: documents, topic, raw tables, models."""

import pytest

from veracast.__main__ import run
from veracast.sources.tables import RAW_FORECAST_TABLE, read_model, read_raw
from veracast.session import apply_settings, shared_folder, shuffle_settings
from oracle.from_events import current_documents, forecast_documents, read_events


def test_documents_to_models(spark, tmp_path):
    events = read_events(spark, "/root/testdata/sf0.001")
    current_documents(events).write.json(str(tmp_path / "current"))
    forecast_documents(events).write.json(str(tmp_path / "forecast"))
    for feed, folder in (("weather", "current"), ("forecast", "forecast")):
        place = ["--format", "parquet", "--option", f"path={tmp_path}/{feed}-topic"]
        documents = str(tmp_path / folder)
        run(spark, ["publish", "--feed", feed, "--documents", documents, *place])
        landing = ["--raw", str(tmp_path / "raw"), "--checkpoint", str(tmp_path / f"{feed}-check")]
        run(spark, ["land", "--feed", feed, *landing, *place])
    run(
        spark,
        ["rebuild", "--raw", str(tmp_path / "raw"), "--out", str(tmp_path / "out")]
        + ["--as-of", "2024-01-15"],
    )
    out = tmp_path / "out"
    hours = read_model(spark, str(out), "stg_weather_stream")
    assert 900 < hours.count() <= 1000
    assert read_model(spark, str(out), "int_forecast_24h").count() > 0
    report = read_model(spark, str(out), "quality_report")
    assert report.where("failures > 0").count() == 0
    path = str(tmp_path / "raw" / "raw_forecast")
    before = read_raw(spark, RAW_FORECAST_TABLE, path)
    rows = sorted(before.collect(), key=str)
    run(spark, ["compact", "--feed", "forecast", "--raw", str(tmp_path / "raw"), "--least", "1"])
    assert sorted(read_raw(spark, RAW_FORECAST_TABLE, path).collect(), key=str) == rows


def test_jobs_session_carries_the_settings(spark):
    given = spark.sparkContext.getConf().get("spark.sql.shuffle.partitions")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    apply_settings(spark, 100 * 2**40)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "1024m"
    # The submitter's own choice stays.
    assert spark.conf.get("spark.sql.shuffle.partitions") == given
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_cluster_without_a_shared_folder_is_refused():
    class Cluster:
        conf = type("conf", (), {"get": staticmethod(lambda name, default: None)})
        sparkContext = type(
            "context", (), {"master": "yarn", "getCheckpointDir": staticmethod(lambda: None)}
        )

    with pytest.raises(ValueError):
        shared_folder(Cluster())


def test_shuffle_settings():
    small = shuffle_settings(10 * 2**20, 8)
    large = shuffle_settings(100 * 2**40, 4000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert large["spark.sql.shuffle.partitions"] == "100000"
    assert large["spark.sql.files.maxPartitionBytes"] == "1024m"


class _Named:
    """A session whose cluster names a shared folder."""

    class conf:
        @staticmethod
        def get(name, default):
            return {"spark.checkpoint.dir": "hdfs://shared/checkpoints/"}.get(name, default)


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(_Named()) == "hdfs://shared/checkpoints"
    named = spark.conf.get("spark.checkpoint.dir", None)
    own = shared_folder(spark)
    assert own == shared_folder(spark) == (named or spark.sparkContext.getCheckpointDir())
