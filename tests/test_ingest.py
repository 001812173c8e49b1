"""Payloads, messages, merge and raw tables, in batch."""

import json

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from veracast.operators.merge import merge_insert_only
from veracast.schemas import MESSAGE, RAW_FORECAST, RAW_WEATHER
from veracast.sources import messages as msg
from veracast.plans import quality
from veracast.plans.rebuild import days_ahead
from veracast.sources import payloads, tables
from veracast.sources.versions import VersionedTable
from veracast.streaming.landing import create, land_batch, landing_reports, read_quarantine

T0 = 1704067200
RUN = "2024-01-01T00:05:00.123456+00:00"
ID = "Paris_2024-01-01T00:00:00+00:00"


def _item(dt, temp, words=({"main": "Rain", "description": "pluie"},)):
    return {
        "dt": dt,
        "main": {"temp": temp, "humidity": 80},
        "wind": {"speed": 3.5},
        "weather": list(words),
    }


def test_flatten(spark):
    docs = [("Paris", json.dumps(_item(T0, 7.5))), ("Lisbonne", json.dumps(_item(T0, 12)))]
    df = spark.createDataFrame(docs, "ville string, body string")
    got = sorted(map(tuple, payloads.flatten_current(df, RUN).collect()))
    assert got[1] == (ID, "Paris", 7.5, 80, 3.5, "Rain", "pluie", T0, RUN)
    assert got[0][0] == "Lisbonne_2024-01-01T00:00:00+00:00" and got[0][2] == 12.0

    docs = [
        ("Paris", json.dumps({"list": [_item(T0, 7.5), _item(T0 + 10800, 8.5, ())]})),
        ("Rome", "{}"),
        ("Oslo", json.dumps({"list": []})),
    ]
    df = spark.createDataFrame(docs, "ville string, body string")
    out = payloads.flatten_forecast(df, RUN)
    assert out.schema.names == RAW_FORECAST.names
    got = sorted(map(tuple, out.collect()))
    assert got == [
        (ID, "Paris", 7.5, 80, 3.5, "Rain", "pluie", T0, RUN, T0),
        ("Paris_2024-01-01T03:00:00+00:00", "Paris", 8.5, 80, 3.5, None, None, T0 + 10800, RUN)
        + (T0 + 10800,),
    ]


def _wire(spark, bodies):
    rows = [(b"k", b.encode() if isinstance(b, str) else b) for b in bodies]
    return spark.createDataFrame(rows, MESSAGE)


def test_publish_round_trip(spark, tmp_path):
    records = spark.createDataFrame(
        [(ID, "Paris", 7.5, None, 3.5, "Rain", "pluie dégagée", T0, RUN)], RAW_WEATHER
    )
    path = str(tmp_path / "topic")
    msg.publish(records, "parquet", path=path)
    sent = spark.read.parquet(path)
    key, value = sent.first()
    assert bytes(key) == b"Paris"
    assert json.loads(bytes(value)) == records.first().asDict()
    good, bad = msg.split_good(msg.decode(sent, RAW_WEATHER), RAW_WEATHER)
    assert good.collect() == records.collect() and bad.count() == 0


def test_decode_sets_bad_messages_aside(spark):
    bad = [
        "not json",
        '{"humidite": 55.5}',
        '{"humidite": "abc"}',
        '{"temperature": "warm"}',
        '{"time_api": 99999999999999999999}',
        '[{"ville": "Paris"}]',
        '"text"',
        "5",
        "null",
        "",
        "{'ville': 'Paris'}",
        '{"ville": "Paris"} tail',
        b'{"ville": "\xff"}',
        None,
    ]
    good = ['{"ville": "Paris"}', ' {"temperature": 5} ', "{}", '{"other": 1}']
    out = msg.decode(_wire(spark, bad + good), RAW_WEATHER)
    assert [r.is_good for r in out.collect()] == [False] * len(bad) + [True] * len(good)
    records, aside = msg.split_good(out, RAW_WEATHER)
    assert (records.count(), aside.count()) == (len(good), len(bad))


def test_legacy_names(spark):
    bodies = [
        {"température": 1.5, "humidité": 40, "catégorie météo": "Rain", "description météo": "x"},
        {"température": 1.5, "temperature": 2.5},
        {"température": 1.5, "temperature": None},
        {"temperature": 3.5},
    ]
    wire = _wire(spark, [json.dumps(b, ensure_ascii=False) for b in bodies])

    def temperatures(**kw):
        return [r.temperature for r in msg.decode(wire, RAW_WEATHER, **kw).collect()]

    assert temperatures() == [1.5, 2.5, None, 3.5]
    assert temperatures(absent_only=False) == [1.5, 2.5, 1.5, 3.5]
    first = msg.decode(wire, RAW_WEATHER).first()
    assert (first.humidite, first.categorie_meteo, first.description_meteo) == (40, "Rain", "x")


def test_merge_insert_only(spark):
    schema = "k string, v bigint"
    source = spark.createDataFrame(
        [("a", 2), ("a", 1), ("b", 1), ("c", 1), (None, 7), (None, 7)], schema
    )
    target = spark.createDataFrame([("b", 9), (None, 7)], schema)
    new = merge_insert_only(source, target, "k", ["v ASC"])
    assert sorted(map(str, new.collect())) == sorted(
        map(str, [r for r in source.collect() if (r.k, r.v) in {("a", 1), ("c", 1), (None, 7)}])
    )
    again = merge_insert_only(source, target.unionByName(new), "k", ["v ASC"])
    assert [r.k for r in again.collect()] == [None, None]  # null keys always insert

    pairs = spark.createDataFrame([("a", 1), ("a", 2), ("a", None)], schema)
    held = spark.createDataFrame([("a", 1), ("a", None)], schema)
    wide = merge_insert_only(pairs, held, ["k", "v"]).collect()
    assert sorted((r.v is None, r.v) for r in wide) == [(False, 2), (True, None)]


def test_land_batch_is_repeatable(spark, tmp_path):
    path, table = str(tmp_path / "raw"), tables.RAW_WEATHER_TABLE
    create(spark, table, path)
    create(spark, table, path)

    def body(key, temp, run=RUN):
        return json.dumps({"record_id": key, "ville": "Paris", "temperature": temp, "heure_run": run})

    odd = "no day in here"
    first = _wire(
        spark,
        [body(ID, 2.0, "2024-01-01T09"), body(ID, 1.0, "2024-01-01T08")]
        + [body(odd, 3.0), body(None, 4.0), body(None, 4.0), "junk"],
    )
    report = land_batch(first, table, path, "s", 0)
    assert (report.read, report.inserted, report.duplicates, report.quarantined) == (6, 4, 1, 1)
    again = land_batch(first, table, path, "s", 0)  # the same batch after a lost checkpoint
    assert again == report
    got = tables.read_raw(spark, table, path)
    assert got.schema.names == RAW_WEATHER.names
    assert sorted(got.select("temperature").toPandas().temperature) == [1.0, 3.0, 4.0, 4.0]

    later = _wire(
        spark,
        [body(ID, 9.0), body(odd, 9.0), body("Paris_2024-03-01T00:00:00+00:00", 5.0), body(None, 4.0)],
    )
    report = land_batch(later, table, path, "s", 1)
    assert (report.inserted, report.duplicates) == (2, 2)
    assert tables.read_raw(spark, table, path).count() == 6
    assert [bytes(r["body"]) for r in read_quarantine(spark, path).collect()] == [b"junk"]
    assert tables.row_count(spark, path) == 6
    told = landing_reports(spark, path).orderBy("batch").collect()
    assert [(r["read"], r["inserted"], r["duplicates"], r["quarantined"]) for r in told] == [
        (6, 4, 1, 1),
        (4, 2, 2, 0),
    ]


def test_files_of_two_schemas_are_one_scan(spark, tmp_path):
    raw, table = VersionedTable(spark, str(tmp_path / "raw")), tables.RAW_FORECAST_TABLE
    older = spark.createDataFrame([(ID, "P")], "record_forecast_id string, ville string")
    newer = spark.createDataFrame(
        [("Paris_2024-01-01T06:00:00+00:00", "P", T0)],
        "record_forecast_id string, ville string, forecast_timestamp bigint",
    )
    for rows in (older, newer):
        raw.commit(raw.version(), raw.add(rows, F.lit("2024-01-01"))[0])
    got = tables.read_raw(spark, table, raw.path)
    assert got.schema.names == RAW_FORECAST.names
    assert sorted(r["forecast_timestamp"] or 0 for r in got.collect()) == [0, T0]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Union" not in plan


def test_rebuild_writes_every_table(spark, tmp_path):
    from __spark_entry__ import _Models
    from veracast.plans.rebuild import rebuild

    m = _Models(spark, "/root/testdata/sf0.001")
    known = {"raw_weather": m.raw_weather().count(), "raw_forecast": m.raw_forecast().count()}
    out = rebuild(m.raw_weather(), m.raw_forecast(), str(tmp_path), "2024-01-15", known)
    assert {p.name for p in tmp_path.iterdir()} == {
        "stg_weather_stream",
        "previsions_meteo_nettoyees",
        "mart_weather_stream",
        "previsions_cible_24h",
        "fiabilite_previsions_24h",
        "mart_fiabilite_reference_ville_categorie_24h",
        "mart_previsions_demain_apresdemain",
        "quality_report",
    }
    direct = m.m7()
    tabled = out["mart_next_two_days"]
    assert direct.exceptAll(tabled).count() == 0 and tabled.exceptAll(direct).count() == 0
    assert out["quality_report"].count() == 15
    # The report is the one that scans give.
    scanned = quality.not_null_report({n: out[n] for n in quality.NOT_NULL})
    scanned = scanned.unionByName(quality.unreadable_times(m.raw_weather(), "raw_weather"))
    scanned = scanned.unionByName(quality.unreadable_times(m.raw_forecast(), "raw_forecast"))
    assert sorted(scanned.collect()) == sorted(out["quality_report"].collect())
    # Two days' rows come from two days' files.
    ahead = tables.read_model(spark, str(tmp_path), "stg_forecast", days_ahead("2024-01-15"))
    days = {f.split("jour_cle=")[1].split("/")[0] for f in ahead.inputFiles()}
    assert days == {"2024-01-16", "2024-01-17"}
    assert len(out["stg_forecast"].inputFiles()) > len(ahead.inputFiles())


def test_a_rebuild_that_dies_leaves_the_old_tables(spark, tmp_path, monkeypatch):
    folder, old = str(tmp_path), spark.range(5).toDF("n")
    tables.write_model(old, folder, "stg_forecast")
    with pytest.raises(Exception, match="lost"):
        # Some rows are written before the job fails.
        fails = spark.range(0, 1000, 1, 10).select(
            F.when(F.col("id") == 999, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("n")
        )
        tables.write_model(fails, folder, "stg_forecast")
    assert tables.read_model(spark, folder, "stg_forecast").count() == 5
    # Killed between the write and the commit.
    monkeypatch.setattr(VersionedTable, "commit", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        tables.write_model(spark.range(9).toDF("n"), folder, "stg_forecast")
    monkeypatch.undo()
    before = tables.read_model(spark, folder, "stg_forecast")
    assert before.count() == 5
    tables.write_model(spark.range(9).toDF("n"), folder, "stg_forecast")
    assert tables.read_model(spark, folder, "stg_forecast").count() == 9
    # A reader of the old version still has its files.
    assert before.count() == 5


def test_recount_when_a_task_was_counted_twice(spark):
    raw = weather_rows(spark)
    counted, seen = quality.counting_times(raw)
    counted.collect()
    assert quality.observed_times(raw, seen, raw.count()) == {"heure_run": 1, "time_api": 0}
    twice = type("Twice", (), {"get": {"_rows": 2 * raw.count(), "heure_run": 2, "time_api": 0}})
    assert quality.observed_times(raw, twice, raw.count()) == {"heure_run": 1, "time_api": 0}


def weather_rows(spark):
    rows = [(ID, "Paris", 1.0, 5, 1.0, None, None, T0, r) for r in (RUN, "garbage", None)]
    return spark.createDataFrame(rows, RAW_WEATHER)


def test_legacy_value_counts_only_when_taken(spark):
    bodies = [
        '{"record_id": "a", "temperature": 7.5, "température": "chaud"}',
        '{"record_id": "b", "température": "chaud"}',
        '{"record_id": "c", "température": 7.5}',
        '{"record_id": "d", "humidite": "55"}',
        '{"record_id": "e", "humidite": 55.0}',
        '{"record_id": "f", "temperature": "7.5"}',
    ]
    sent = spark.createDataFrame([(b.encode(),) for b in bodies], "value binary")
    rows = msg.decode(sent, RAW_WEATHER).collect()
    assert [r["is_good"] for r in rows] == [True, False, True, False, False, False]
    assert rows[0]["temperature"] == rows[2]["temperature"] == 7.5


def test_writes_by_part_are_not_sorted_first(spark, tmp_path, monkeypatch):
    """Some parts' files are open side by side during a write; the setting goes with it."""
    name, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet

    def spied(self, *args, **kwargs):
        seen.append(int(spark.conf.get(name, "0")))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", spied)
    rows = spark.range(300).select("id", (F.col("id") % 50).cast("string").alias("p"))
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(rows, F.col("p"))
    assert len(seen) == 1 and seen[0] > 0 and int(spark.conf.get(name, "0")) == 0
    # More parts than are open at a time.
    assert sorted(r["id"] for r in table.read().collect()) == list(range(300))
    assert {r["id"] for r in table.read(parts=["7"]).collect()} == set(range(7, 300, 50))


def test_bytes_of_good_messages_are_not_held(spark, tmp_path, monkeypatch):
    good = json.dumps({"record_id": ID, "ville": "Paris", "time_api": T0, "heure_run": RUN})
    batch = _wire(spark, [good, f" \t{good}\n", "x{}", "{} x"])
    held, persist = [], type(batch).persist

    def spied(self, *args, **kwargs):
        out = persist(self, *args, **kwargs)
        held.extend(tuple(r) for r in out.select("is_good", "body").collect())
        return out

    monkeypatch.setattr(type(batch), "persist", spied)
    report = land_batch(batch, tables.RAW_WEATHER_TABLE, str(tmp_path / "raw"), "s", 0)
    assert (report.read, report.inserted, report.quarantined) == (4, 1, 2)
    assert [body for good, body in held if good] == [None, None]
    assert sorted(bytes(body) for good, body in held if not good) == [b"x{}", b"{} x"]
    aside = read_quarantine(spark, str(tmp_path / "raw")).collect()
    assert sorted(bytes(r["body"]) for r in aside) == [b"x{}", b"{} x"]
