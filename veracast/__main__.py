"""Jobs for spark-submit: publish documents, land a topic, rebuild the models.

    spark-submit run.py publish  --feed weather  --documents DIR --format kafka --option topic=...
    spark-submit run.py land     --feed forecast --raw DIR --checkpoint DIR --format kafka --option ...
    spark-submit run.py compact  --feed forecast --raw DIR
    spark-submit run.py rebuild  --raw DIR --out DIR [--as-of 2024-01-15]
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from veracast.plans.rebuild import rebuild
from veracast.session import apply_settings, pin_utc
from veracast.sources import messages, payloads, store, tables
from veracast.streaming.landing import start_landing

FEEDS = {
    "weather": (tables.RAW_WEATHER_TABLE, payloads.flatten_current),
    "forecast": (tables.RAW_FORECAST_TABLE, payloads.flatten_forecast),
    "forecast-history": (tables.RAW_FORECAST_HISTORY_TABLE, payloads.flatten_forecast),
}


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="veracast")
    jobs = parser.add_subparsers(dest="job", required=True)
    job = jobs.add_parser("compact")
    job.add_argument("--feed", choices=FEEDS, required=True)
    job.add_argument("--raw", required=True)
    job.add_argument("--least", type=int, default=8, help="writes a day has before they are joined")
    for name in ("publish", "land"):
        job = jobs.add_parser(name)
        job.add_argument("--feed", choices=FEEDS, required=True)
        job.add_argument("--format", default="kafka")
        job.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")
        if name == "publish":
            job.add_argument("--documents", required=True, help="JSON lines with ville and body")
        else:
            job.add_argument("--raw", required=True)
            job.add_argument("--checkpoint")
            job.add_argument("--starting-offsets", default="latest")
    job = jobs.add_parser("rebuild")
    job.add_argument("--raw", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--as-of")
    for job in jobs.choices.values():
        job.add_argument("--input-bytes", type=int, help="size of the input; measured if left out")
    job.add_argument("--forecast-feed", choices=FEEDS, default="forecast")
    return parser.parse_args(argv)


def run(spark: SparkSession, argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    pin_utc(spark)
    folder = args.documents if args.job == "publish" else args.raw
    size = store.size(spark, folder) if args.input_bytes is None else args.input_bytes
    apply_settings(spark, size)
    if args.job == "rebuild":
        raw = [
            tables.read_raw(spark, table, f"{args.raw}/{table.name}")
            for table, _ in (FEEDS["weather"], FEEDS[args.forecast_feed])
        ]
        names = ("raw_weather", "raw_forecast")
        rows = {n: tables.row_count(spark, f"{args.raw}/{n}") for n in names}
        rebuild(*raw, args.out, args.as_of, rows)
        return
    table, flatten = FEEDS[args.feed]
    if args.job == "compact":
        tables.compact_raw(spark, table, f"{args.raw}/{table.name}", args.least)
        return
    options = dict(o.split("=", 1) for o in args.option)
    if args.job == "publish":
        documents = spark.read.schema("ville string, body string").json(args.documents)
        now = dt.datetime.now(dt.timezone.utc)
        messages.publish(flatten(documents, now), args.format, **options)
    else:
        topic = messages.open_topic(spark, args.format, args.starting_offsets, **options)
        path = f"{args.raw}/{table.name}"
        start_landing(topic, table, path, args.checkpoint).awaitTermination()


if __name__ == "__main__":
    run(SparkSession.builder.appName("veracast").getOrCreate())
