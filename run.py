"""Entry point for spark-submit; see ``veracast/__main__.py``."""

from pyspark.sql import SparkSession

from veracast.__main__ import run

if __name__ == "__main__":
    run(SparkSession.builder.appName("veracast").getOrCreate())
