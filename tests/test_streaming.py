"""Streams from file sources: landing is idempotent, windows agree with the batch models."""

import pytest
from pyspark.sql import functions as F

from veracast.operators.slots import average_by_slot
from veracast.plans.staging import stg_weather_stream
from veracast.schemas import RAW_WEATHER
from veracast.sources import messages, store, tables
from veracast.sources.versions import VersionedTable
from veracast.streaming import landing, late
from oracle.from_events import forecast_from_events, read_events, weather_from_events
from veracast.streaming.landing import start_landing
from veracast.streaming.windows import drain_windows, newest_per_hour, slots_of_hours

FOLDER = "/root/testdata/sf0.001"


def _drain(spark, table, topic, path, checkpoint):
    reports = []
    stream = messages.open_topic(spark, "parquet", path=topic, maxFilesPerTrigger="2")
    query = start_landing(stream, table, path, checkpoint, reports.append)
    query.awaitTermination()
    assert query.exception() is None
    return reports


def _land(spark, tmp_path, table, records):
    topic, path, check = (str(tmp_path / n) for n in ("topic", "raw", "check"))
    messages.publish(records.repartition(5), "parquet", path=topic)
    junk = spark.createDataFrame([(b"k", b"not json")], "key binary, value binary")
    junk.write.mode("append").parquet(topic)
    reports = _drain(spark, table, topic, path, check)
    assert len(reports) > 1
    assert sum(r.read for r in reports) == records.count() + 1
    assert sum(r.quarantined for r in reports) == 1
    landed = tables.read_raw(spark, table, path)
    assert sum(r.inserted for r in reports) == landed.count()
    assert _drain(spark, table, topic, path, check) == []  # nothing new in the topic

    whole = F.lit(True)
    for k in table.key:
        whole = whole & F.col(k).isNotNull()
    keys = records.where(whole).select(*table.key).distinct()
    assert landed.where(whole).count() == keys.count()
    assert landed.where(~whole).count() == records.where(~whole).count()
    assert landed.exceptAll(records).count() == 0

    # The same messages under a new consumer: keyed rows are duplicates, others come again.
    before = landed.where(whole).count()
    _drain(spark, table, topic, path, str(tmp_path / "check2"))
    assert tables.read_raw(spark, table, path).where(whole).count() == before


def test_land_weather(spark, tmp_path):
    records = weather_from_events(read_events(spark, FOLDER))
    twice = records.unionByName(records.limit(100))
    _land(spark, tmp_path, tables.RAW_WEATHER_TABLE, twice)


def test_land_forecast(spark, tmp_path):
    records = forecast_from_events(read_events(spark, FOLDER)).where("heure_run < '2024-01-04'")
    _land(spark, tmp_path, tables.RAW_FORECAST_TABLE, records)


def test_land_forecast_with_wide_key(spark, tmp_path):
    records = forecast_from_events(read_events(spark, FOLDER)).where("heure_run < '2024-01-03'")
    _land(spark, tmp_path, tables.RAW_FORECAST_HISTORY_TABLE, records)


def _run_stream(df, tmp_path):
    out = str(tmp_path / "out")
    drain_windows(df, out, str(tmp_path / "check")).awaitTermination()
    return df.sparkSession.read.parquet(out)


def test_windows_agree_with_batch(spark, tmp_path):
    raw = weather_from_events(read_events(spark, FOLDER))
    path = str(tmp_path / "raw")
    raw.coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(RAW_WEATHER).parquet(path)

    hours = newest_per_hour(stream)
    got = _run_stream(hours.drop("hour"), tmp_path / "hours")
    batch = stg_weather_stream(raw)
    last = raw.agg(F.max("time_api")).first()[0] - 7200
    closed = batch.where(F.unix_seconds("heure_meteo") + 3600 <= last)
    names = closed.columns
    assert closed.count() > 900
    assert got.select(*names).exceptAll(closed).count() == 0
    assert closed.exceptAll(got.select(*names)).count() == 0

    slots = _run_stream(slots_of_hours(newest_per_hour(stream)), tmp_path / "slots")
    expected = average_by_slot(batch)
    assert slots.count() > 800
    assert slots.exceptAll(expected).count() == 0
    # What is missing is still open at the end of input.
    missing = expected.join(slots, ["ville", "date_heure"], "left_anti")
    assert missing.where(F.unix_seconds("date_heure") + 10800 <= last - 3600).count() == 0


def test_queries_read_a_folder_of_part_files(spark, tmp_path):
    from __spark_entry__ import queries

    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    source.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    name = "t4_slots_3h_stream"
    one = queries()[name](spark, "/root/testdata/sf0.001").count()
    assert queries()[name](spark, str(tmp_path)).count() == one > 0


@pytest.mark.parametrize("name", ["t1_ingest_weather", "t2_ingest_forecast", "s8_merge_insert_only"])
def test_an_append_in_place_of_the_merge_is_seen(spark, monkeypatch, name):
    import __spark_entry__
    from __spark_entry__ import oracle_sql, queries
    from compare import differences, duck
    from veracast.streaming import landing

    check = lambda: differences(queries()[name](spark, FOLDER), duck(FOLDER), oracle_sql()[name])
    assert check() == []
    for module in (landing, __spark_entry__):
        monkeypatch.setattr(module, "merge_insert_only", lambda source, *rest: source)
    assert check() != []


def test_a_landing_reads_only_the_days_it_touches(spark, tmp_path, monkeypatch):
    table, path = tables.RAW_WEATHER_TABLE, str(tmp_path / "raw")
    records = weather_from_events(read_events(spark, FOLDER))
    sent = messages.to_messages(records)
    landing.land_batch(sent, table, path, "s", 0)
    raw = VersionedTable(spark, path)
    assert len(raw.version().parts) == 30
    asked, files = [], []
    read, listed = VersionedTable.read, store.read_text

    def reads(self, schema=None, parts=None, version=None):
        out = read(self, schema, parts, version)
        asked.append((sorted(parts or ()), {f.split("jour_cle=")[1].split("/")[0] for f in out.inputFiles()}))
        return out

    monkeypatch.setattr(VersionedTable, "read", reads)
    monkeypatch.setattr(store, "read_text", lambda s, p: files.append(p) or listed(s, p))
    # The first and the last day, none between.
    ends = ("2024-01-01", "2024-01-30")
    some = records.where(F.substring_index("record_id", "_", -1).substr(1, 10).isin(*ends))
    report = landing.land_batch(messages.to_messages(some), table, path, "s", 1)
    assert (report.inserted, report.duplicates) == (0, some.count())
    assert asked == [(list(ends), set(ends))]
    assert len(files) <= 2  # the version and one list


def test_drain_goes_on_where_it_stopped(spark, tmp_path):
    records = weather_from_events(read_events(spark, FOLDER))
    topic, path, check = (str(tmp_path / n) for n in ("topic", "raw", "check"))
    messages.publish(records.repartition(5, "record_id"), "parquet", path=topic)
    stream = messages.open_topic(spark, "parquet", path=topic, maxFilesPerTrigger="1")
    table = tables.RAW_WEATHER_TABLE
    first = landing.drain(stream, table, path, check, most_batches=2)
    assert len(first) == 2 and 0 < tables.read_raw(spark, table, path).count() < records.count()
    rest = landing.drain(stream, table, path, check)
    # The batch at which the first run stopped is offered again and changes nothing.
    assert [r.batch for r in first + rest] == [0, 1, 1, 2, 3, 4]
    got = tables.read_raw(spark, table, path)
    assert got.exceptAll(records).count() == records.exceptAll(got).count() == 0
    assert landing.landing_reports(spark, path).agg(F.sum("inserted")).first()[0] == records.count()


def test_two_writers_of_one_version(spark, tmp_path):
    raw = VersionedTable(spark, str(tmp_path))
    rows = spark.range(3).toDF("n")
    base = raw.version()
    raw.commit(base, raw.add(rows, None)[0], schema=rows.schema)
    with pytest.raises(store.AlreadyThere):
        raw.commit(base, raw.add(rows, None)[0], schema=rows.schema)
    assert raw.read().count() == 3


def test_compaction_and_expiry(spark, tmp_path):
    raw = VersionedTable(spark, str(tmp_path))
    rows = spark.range(40).select(F.col("id").alias("n"), F.lit("x").alias("jour"))
    for i in range(6):
        day = F.when(F.col("n") % 2 == 0, "2024-01-01").otherwise(f"2024-01-1{i}")
        raw.commit(raw.version(), raw.add(rows.where(F.col("n") >= i), day)[0], schema=rows.schema)
    before = sorted(raw.read().collect())
    old, days = raw.read(), len(raw.folders(raw.version()))
    assert raw.compact(rows.schema, least=3) == ["2024-01-01"]
    assert len(raw.folders(raw.version())) == days - 5
    assert sorted(raw.read().collect()) == before
    assert sorted(r["n"] for r in raw.read(parts=["2024-01-12"]).collect()) == list(range(3, 40, 2))
    assert sorted(old.collect()) == before
    raw.expire(keep=1)
    assert raw.numbers() == [7] and sorted(raw.read().collect()) == before
    left = [p for p in (tmp_path / "data").rglob("jour_cle=2024-01-01")]
    assert len(left) == 1
    assert raw.compact(rows.schema, least=3) == []


def _arrive(spark, tmp_path, deliveries, delay=7200):
    """Deliveries one after the other, each split in a run of its own."""
    topic, split, check = (str(tmp_path / n) for n in ("topic", "split", "check"))
    for rows in deliveries:
        rows.coalesce(1).write.mode("append").parquet(topic)
        stream = spark.readStream.schema(RAW_WEATHER).parquet(topic)
        late.start_split(stream, split, check, delay).awaitTermination()
    return split


def test_late_rows_are_counted_and_kept(spark, tmp_path):
    hour = 1704067200

    def rows(*times):
        made = [(f"P_{t}", "Paris", 1.0, 5, 1.0, None, None, t, None) for t in times]
        return spark.createDataFrame(made, RAW_WEATHER)

    # After the first delivery the watermark is hour 3: hours that end by then are closed.
    first = rows(hour, hour + 5 * 3600)
    second = rows(hour + 60, hour + 2 * 3600 + 60, hour + 3 * 3600, hour + 9 * 3600, None)
    third = rows(hour + 6 * 3600 - 1, hour + 7 * 3600, hour + 8 * 3600)
    split = _arrive(spark, tmp_path, [first, second, third])
    counts = [tuple(r) for r in late.arrival_counts(spark, split).orderBy("batch").collect()]
    assert counts == [(0, 2, 2, 0, 0), (1, 5, 2, 2, 1), (2, 3, 2, 1, 0)]
    told = late.read_split(spark, split)
    assert {r["time_api"] for r in told.where("arrival = 'late'").collect()} == {
        hour + 60, hour + 2 * 3600 + 60, hour + 6 * 3600 - 1,
    }
    # Windows over the on-time rows drop none of them.
    got = _run_stream(newest_per_hour(late.on_time(spark, split)).drop("hour"), tmp_path / "w")
    closed = told.where(f"arrival = 'on_time' and time_api + 3600 <= {hour + 7 * 3600}")
    assert got.count() == closed.count() == 3


def test_a_repeated_split_changes_nothing(spark, tmp_path, monkeypatch):
    raw = weather_from_events(read_events(spark, FOLDER))
    path = str(tmp_path / "split")
    late.split_batch(raw.where("time_api % 2 = 0"), path, 0)
    # The next batch dies before its rename, then comes again.
    monkeypatch.setattr(store, "move", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        late.split_batch(raw.where("time_api % 2 = 1"), path, 1)
    monkeypatch.undo()
    assert late.read_split(spark, path).count() == raw.where("time_api % 2 = 0").count()
    for _ in range(2):
        late.split_batch(raw.where("time_api % 2 = 1"), path, 1)
    assert late.read_split(spark, path).count() == raw.count()
