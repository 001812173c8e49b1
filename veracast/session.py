"""Session settings the models rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_MB = 1024 * 1024
# Aimed-at shuffle data per task, and the most reduce tasks a shuffle should have: the blocks of a
# shuffle are map tasks times reduce tasks, so past this point larger tasks (which may spill) cost
# less than smaller blocks. AQE merges small partitions and splits skewed join ones.
_BYTES_PER_TASK = 512 * _MB
_MOST_TASKS = 100_000


def shuffle_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Session settings for a job over this much raw data on this many executor cores.

    No model's shuffle carries more than its input, so the input bounds it. The partition count is a
    whole number of task waves.
    """
    wanted = min(-(-input_bytes // _BYTES_PER_TASK), _MOST_TASKS)
    waves = max(1, -(-wanted // cores))
    split = 256 if input_bytes < 10 * _MB * _MB else 1024
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(waves * cores),
        "spark.sql.files.maxPartitionBytes": f"{split}m",
        # The default timestamp storage keeps no minima and maxima, so no filter could skip pages.
        "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    }


def apply_settings(spark: SparkSession, input_bytes: int) -> None:
    """Give a job's session the settings for its input, save those the submitter has set."""
    given = {name for name, _ in spark.sparkContext.getConf().getAll()}
    wanted = shuffle_settings(input_bytes, spark.sparkContext.defaultParallelism)
    for name, value in wanted.items():
        if name not in given:
            spark.conf.set(name, value)


def pin_utc(spark: SparkSession) -> SparkSession:
    """Every instant is read, cut and printed in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only where that is unset on a single machine (tests) is a local checkpoint folder made; on a
    cluster each executor would write to its own disk, so the setting is asked for.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if not context.getCheckpointDir():
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="veracast-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")
