"""Staging and mart models on hand rows: gaps, ties, copies and boundaries."""

import datetime as dt

from pyspark.sql import functions as F

from veracast.plans import marts, quality, staging
from veracast.schemas import RAW_FORECAST, RAW_WEATHER

T0 = 1704067200  # 2024-01-01 00:00 UTC
DAY = 86400


def _iso(epoch):
    return dt.datetime.fromtimestamp(epoch, dt.timezone.utc).isoformat()


def _naive(epoch):
    return dt.datetime.fromtimestamp(epoch, dt.timezone.utc).replace(tzinfo=None)


def weather(spark, rows):
    return spark.createDataFrame(rows, RAW_WEATHER)


def forecast(spark, rows):
    return spark.createDataFrame(rows, RAW_FORECAST)


def test_newest_observation_per_hour(spark):
    def row(city, key, temp, at, run):
        return (key, city, temp, 50, 3.0, "Clear", "d", at, run)

    rows = [
        row("Lisbon", "a", 1.0, T0, _iso(T0 + 60)),
        row("Lisbonne", "b", 2.0, T0 + 1800, _iso(T0 + 120)),  # same city, newer run
        row("Paris", "a", 3.0, T0 + 10, None),  # falls back to the hour
        row("Paris", "b", 4.0, T0 + 20, _iso(T0 - 60)),  # run before the hour: older
        row("Rome", "a", 5.0, T0 + 10, _iso(T0 + 60)),
        row("Rome", "b", 6.0, T0 + 20, _iso(T0 + 60)),  # equal run: later measure wins
        row("Oslo", "b", 7.0, T0, _iso(T0 + 60)),
        row("Oslo", "a", 8.0, T0, _iso(T0 + 60)),  # equal in time: higher id wins
        row("Bonn", "a", 9.0, T0, "garbage"),
        row("Bern", "a", 10.0, None, _iso(T0)),  # no hour: one row of its own
        row("Bern", "b", 11.0, None, _iso(T0 + 1)),
    ]
    got = {r.ville: r for r in staging.stg_weather_stream(weather(spark, rows)).collect()}
    assert {v: r.temperature for v, r in got.items()} == {
        "Lisbonne": 2.0,
        "Paris": 3.0,
        "Rome": 6.0,
        "Oslo": 7.0,
        "Bonn": 9.0,
        "Bern": 11.0,
    }
    assert got["Bonn"].run_ts is None and got["Bern"].heure_meteo is None
    assert got["Lisbonne"].heure_meteo == _naive(T0)


def test_forecast_staging(spark):
    def row(key, city, temp, api, run, target):
        return (key, city, temp, 50, 3.0, "Rain", "d", api, run, target)

    run = _iso(T0 - DAY)
    rows = [
        row("A_x", "A", 1.0, None, run, T0),
        row("B_x", "B", 1.0, T0, run, None),
        row(f"C_{_iso(T0)}", "C", 1.0, None, run, None),
        row("D", "D", 1.0, None, run, None),  # no time at all
        row("E_x", "E", 1.0, T0, "garbage", T0),
        row(None, "Lisbon", 1.0, T0, run, None),  # id rebuilt
        row("F_1", "F", 1.0, T0, run, T0),
        row("F_2", "F", 2.0, T0, run, T0),  # copy with higher id wins
        row("G_x", "G", 1.0, T0 + 10800, run, T0),  # first source wins
        row(None, "H", 1.0, None, run, None),
        row("I_x", "I", 1.0, T0 - 2 * DAY, run, None),
    ]
    got = {r.ville: r for r in staging.stg_forecast(forecast(spark, rows)).collect()}
    assert set(got) == {"A", "B", "C", "Lisbonne", "F", "G", "I"}
    assert all(got[c].date_heure_prevue == _naive(T0) for c in "ABCG")
    assert got["Lisbonne"].id_prevision == f"Lisbonne_{_iso(T0)}"
    assert got["F"].id_prevision == "F_2" and got["F"].temperature_prevue == 2.0
    assert got["A"].horizon_heures == 24 and got["I"].horizon_heures == -24


def _runs(spark, horizons):
    rows = [
        (f"P_{h}", "P", float(i), 50, 3.0, "Rain", "d", T0, _iso(T0 - h * 3600), T0)
        for i, h in enumerate(horizons)
    ]
    return staging.clean_forecasts(forecast(spark, rows))


def test_forecast_nearest_24h(spark):
    def horizon(*hours, **kw):
        return [r.horizon_heures for r in marts.int_forecast_24h(_runs(spark, hours), **kw).collect()]

    assert horizon(18, 30) == [18]  # equal gap: later collection
    assert horizon(30, 48, -6) == [30]
    assert horizon(-6) == [-6]
    assert horizon(6, 48, tolerance=(18, 30)) == []


def test_choosing_from_clean_or_staged_is_the_same(spark):
    from __spark_entry__ import _Models

    m = _Models(spark, "/root/testdata/sf0.001")
    clean = staging.clean_forecasts(m.raw_forecast())
    staged = staging.stg_forecast(m.raw_forecast())
    for pick in (
        marts.int_forecast_24h,
        lambda f: marts.mart_next_two_days(f, m.m6(), "2024-01-15"),
    ):
        a, b = pick(clean), pick(staged)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_accuracy(spark):
    hour = 3600
    obs = [
        ("P_1", "P", 10.0, 50, 3.0, "Rain", "first", T0, _iso(T0)),
        ("P_2", "P", 13.0, 53, 4.0, "Snow", "second", T0 + hour, _iso(T0 + hour)),
        ("Q_1", "Q", 10.0, None, 3.0, "Rain", "d", T0, _iso(T0)),
        ("R_1", "R", 10.0, 50, 3.0, None, "d", T0, _iso(T0)),  # no forecast
    ]
    fc = [
        (f"{c}_x", c, 12.5, 51, 3.0, "Clear", "f", T0, _iso(T0 - DAY), T0) for c in ("P", "Q")
    ]
    m3 = marts.mart_weather_stream(staging.stg_weather_stream(weather(spark, obs)))
    m4 = marts.int_forecast_24h(staging.clean_forecasts(forecast(spark, fc)))
    got = {r.ville: r for r in marts.mart_weather_accuracy_24h(m3, m4, keep_uncovered=True).collect()}
    p, q, r = got["P"], got["Q"], got["R"]
    assert (p.temperature_reelle, p.vent_reel, p.humidite_reelle) == (11.5, 3.5, 51.5)
    assert (p.categorie_reelle, p.description_reelle) == ("Pluie", "first")
    assert (p.ecart_temperature, p.ecart_vent, p.ecart_humidite) == (1.0, 0.5, 0.5)
    assert (p.score_fiabilite_0_100, p.niveau_fiabilite) == (100.0, "très fiable")
    assert (p.comparaison_possible, p.prevision_disponible_24h) == (1, 1)
    assert (q.comparaison_possible, q.score_humidite_0_3, q.ecart_humidite) == (0, None, None)
    assert (q.score_fiabilite_0_100, q.niveau_fiabilite) == (None, "incomplet")
    assert (r.prevision_disponible_24h, r.niveau_fiabilite) == (0, "incomplet")
    kept = marts.mart_weather_accuracy_24h(m3, m4)
    assert {x.ville for x in kept.collect()} == {"P", "Q"}
    history = marts.mart_reliability_reference(kept).collect()
    assert [tuple(h) for h in history] == [("P", "Clear", 1, 100.0, "insuffisant")]


def test_next_two_days(spark):
    edges = [0, DAY - 1, DAY, 2 * DAY - 1, 2 * DAY, 3 * DAY - 1, 3 * DAY]
    rows = [
        (f"P_{e}", "P", -10.004, 50, 3.0, None, "d", T0 + e, _iso(T0 - DAY), T0 + e) for e in edges
    ] + [("P_new", "P", 20.0, 50, 3.0, "Drizzle", "d", T0 + DAY, _iso(T0), T0 + DAY)]
    staged = staging.stg_forecast(forecast(spark, rows))
    reference = spark.createDataFrame(
        [("P", "Drizzle", 12, 90.0, "très fiable")],
        "ville string, categorie_prevue string, nb_observations bigint, "
        "score_fiabilite_moyen_0_100 double, niveau_confiance_historique string",
    )
    out = marts.mart_next_two_days(staged, reference, dt.date(2024, 1, 1))
    got = sorted(out.collect(), key=lambda r: r.date_heure_prevue)
    assert [r.date_heure_prevue for r in got] == [_naive(T0 + e) for e in edges[2:6]]
    first, second = got[0], got[1]
    assert first.date_heure_collecte_utilisee == _naive(T0)
    assert (first.categorie_prevue_fr, first.indice_risque_meteo_prevu) == ("Bruine", 0)
    assert first.recommandation == "Prévision à suivre"
    # Risk reads the unrounded -10.004, display shows -10.0; a null category has no history.
    assert (second.temperature_prevue, second.indice_risque_meteo_prevu) == (-10.0, 2)
    assert (second.categorie_prevue_fr, second.categorie_prevue_en) == ("Inconnu", None)
    assert second.recommandation == "Confiance inconnue (pas d’historique)"


def test_next_two_days_starts_from_today(spark):
    today = int(dt.datetime.now(dt.timezone.utc).timestamp()) // DAY * DAY
    rows = [
        (f"P_{d}", "P", 1.0, 50, 3.0, "Rain", "d", None, _iso(today), today + d * DAY)
        for d in range(5)
    ]
    reference = marts.mart_reliability_reference(
        spark.createDataFrame(
            [("P", "Rain", 50.0)], "ville string, categorie_prevue string, score_fiabilite_0_100 double"
        )
    )
    got = marts.mart_next_two_days(staging.stg_forecast(forecast(spark, rows)), reference).collect()
    assert sorted(r.date_heure_prevue for r in got) == [_naive(today + d * DAY) for d in (1, 2)]
    assert {r.nb_observations for r in got} == {1}


def test_quality(spark):
    rows = [
        ("a", None, 1.0, 1, 1.0, "c", "d", T0, "garbage"),
        ("b", "P", 1.0, 1, 1.0, "c", "d", None, _iso(T0)),
        ("c", "P", 1.0, 1, 1.0, "c", "d", 2**62, None),
    ]
    raw = weather(spark, rows)
    report = quality.not_null_report({"stg_weather_stream": staging.stg_weather_stream(raw)})
    assert {(r.column_name, r.failures) for r in report.collect()} == {
        ("ville", 1),
        ("heure_meteo", 1),
    }
    unread = {r.column_name: r.failures for r in quality.unreadable_times(raw, "raw").collect()}
    assert unread == {"heure_run": 1, "time_api": 1}


def test_properties(spark):
    from __spark_entry__ import _Models

    m = _Models(spark, "/root/testdata/sf0.001")
    m1, m5 = m.m1(), m.m5()
    assert m1.count() == m1.select("ville", "heure_meteo").distinct().count()
    m4 = m.m4()
    assert m4.count() == m4.select("ville", "date_heure_prevue").distinct().count()
    scores = {r[0] for r in m5.select("score_fiabilite_0_100").distinct().collect()}
    assert scores <= {round(p / 9 * 100, 1) for p in range(10)}


def test_slot_means_are_those_of_exact_fractions(spark):
    """Measures are whole tenths, so their means are known exactly; no decimal is shared with the models."""
    from collections import defaultdict
    from fractions import Fraction

    from __spark_entry__ import _Models

    m = _Models(spark, "/root/testdata/sf0.001")
    tenths = defaultdict(list)
    for r in m.m3().collect():
        epoch = int(r["heure_meteo"].replace(tzinfo=dt.timezone.utc).timestamp())
        tenths[r["ville"], epoch // 10800].append(round(r["temperature"] * 10))
    for r in m.a1().collect():
        epoch = int(r["date_heure"].replace(tzinfo=dt.timezone.utc).timestamp())
        own = tenths.pop((r["ville"], epoch // 10800))
        scaled = Fraction(100 * sum(own), 10 * len(own))
        nearest = (abs(scaled) + Fraction(1, 2)).__floor__() * (1 if scaled >= 0 else -1)
        assert r["temperature_reelle"] == nearest / 100
    assert not tenths
