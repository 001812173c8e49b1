"""One DuckDB statement per query, put together from named steps.

Each step is a plain select; ``_with`` puts the steps a statement needs in front of it. Instants are
naive timestamps in UTC, whole numbers are cast to bigint.
"""

from __future__ import annotations

AS_OF = "2024-01-15"
COLLECTED_AT = "2024-02-01T00:00:00.123456+00:00"


def _iso(epoch: str) -> str:
    return f"strftime(make_timestamp(({epoch})::bigint * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00'"


def _ts(epoch: str) -> str:
    return f"make_timestamp(({epoch})::bigint * 1000000)"


def _round(x: str, n: int) -> str:
    return f"round(({x})::decimal(38,12), {n})::double"


_CITY = """case user_id when 0 then 'Lisbon' when 1 then 'Paris' when 2 then 'Rome'
  when 3 then 'Amsterdam' else 'V' || user_id end"""

# Labels, thresholds and category names.
_FRENCH = """case {c} when 'Rain' then 'Pluie' when 'Clouds' then 'Nuageux'
  when 'Clear' then 'Ciel dégagé' when 'Snow' then 'Neige' when 'Thunderstorm' then 'Orage'
  when 'Drizzle' then 'Bruine' else coalesce({c}, 'Inconnu') end"""

_RISK = """case
  when {t} < -10 or {t} > 45 or {c} in ('Snow', 'Thunderstorm') or {w} >= 20 then 2
  when {t} between 35 and 45 or ({t} >= -10 and {t} < -5) or {c} in ({wet}) or {w} >= 17 then 1
  else 0 end::bigint"""

_LABEL = """case {r} when 0 then 'Aucun risque' when 1 then 'Risque modéré' else 'Risque fort' end"""


def _points(f: str, o: str, a, b, c) -> str:
    d = f"abs({f} - {o})"
    return (
        f"case when {f} is null or {o} is null then null when {d} <= {a} then 3 "
        f"when {d} <= {b} then 2 when {d} <= {c} then 1 else 0 end::bigint"
    )


def _gap(f: str, o: str) -> str:
    return _round(f"abs({f} - {o})", 2)


STEPS: dict[str, str] = {}

STEPS["ev"] = f"""select event_id, user_id, event_type, {_CITY} as city,
  epoch(date_trunc('second', ts))::bigint as e,
  (epoch(date_trunc('second', ts))::bigint // 10800)::bigint as slot
from events"""

STEPS["raw_weather"] = f"""select
  city || '_' || {_iso('e')} as record_id,
  city as ville,
  ((slot + user_id * 5) % 66) - 14 + ((event_id % 21) - 10) / cast(10 as double) as temperature,
  (10 + (slot * 17 + user_id) % 80 + event_id % 10)::bigint as humidite,
  ((slot * 13 + user_id * 3) % 230) / cast(10 as double) + (event_id % 9) / cast(10 as double)
    as vitesse_vent,
  case event_type when 'click' then 'Clear' when 'view' then 'Clouds' when 'purchase' then 'Rain'
    when 'signup' then 'Drizzle'
    when 'error' then case event_id % 4 when 0 then 'Snow' when 1 then 'Thunderstorm'
      when 2 then 'Mist' end end as categorie_meteo,
  event_type as description_meteo,
  e as time_api,
  {_iso('e + (event_id % 50) * 60')} as heure_run
from ev"""

STEPS["raw_forecast_once"] = f"""select s.*, h,
  case when (slot + h) % 10 = 0 then null else city || '_' || {_iso('slot * 10800')} end
    as record_forecast_id,
  city as ville,
  ((slot + user_id * 5) % 66) - 14
    + ((slot * 7 + h) % 41 - 20) * (1 + user_id % 3) / cast(10 as double) as temperature,
  (10 + (slot * 17 + user_id) % 80 + ((slot * 5 + h) % 27 - 13) * (1 + user_id % 3))::bigint
    as humidite,
  ((slot * 13 + user_id * 3) % 230) / cast(10 as double)
    + ((slot * 11 + h) % 41 - 20) * (1 + user_id % 3) / cast(10 as double) as vitesse_vent,
  case (slot + h // 6 + user_id) % 7 when 0 then 'Clear' when 1 then 'Clouds' when 2 then 'Rain'
    when 3 then 'Drizzle' when 4 then 'Snow' when 5 then 'Thunderstorm' end as categorie_meteo,
  'h' || h as description_meteo,
  case when (slot + h) % 7 = 0 then null else slot * 10800 end as time_api,
  case when (slot + h) % 97 = 0 then 'garbage'
    else {_iso('slot * 10800 - h * 3600 - ((slot + user_id) % 50) * 60')} end as heure_run,
  case when (slot + h) % 3 = 0 then null else slot * 10800 end as forecast_timestamp
from (select distinct user_id, slot, city from ev where (slot * 3 + user_id) % 11 <> 0) s,
  (values (6::bigint), (12), (18), (24), (30), (48)) as hs(h)"""

_RAW_FORECAST = (
    "record_forecast_id, ville, temperature, humidite, vitesse_vent, categorie_meteo, "
    "description_meteo, time_api, heure_run, forecast_timestamp"
)
STEPS["raw_forecast"] = f"""select {_RAW_FORECAST} from raw_forecast_once
union all
select {_RAW_FORECAST.replace('record_forecast_id', 'null as record_forecast_id')}
from raw_forecast_once where slot % 23 = 0"""

STEPS["m1"] = f"""select ville, heure_meteo, run_ts, temperature, humidite, vitesse_vent,
  categorie_meteo, description_meteo
from (
  select *, row_number() over (partition by ville, heure_meteo order by
    coalesce(run_ts, heure_meteo) desc nulls last, weather_ts desc nulls last,
    record_id desc nulls last, run_ts desc nulls last, temperature desc nulls last,
    humidite desc nulls last, vitesse_vent desc nulls last, categorie_meteo desc nulls last,
    description_meteo desc nulls last) as rn
  from (
    select case when ville = 'Lisbon' then 'Lisbonne' else ville end as ville,
      {_ts('time_api')} as weather_ts, date_trunc('hour', {_ts('time_api')}) as heure_meteo,
      try_cast(heure_run as timestamp) as run_ts, temperature, humidite, vitesse_vent,
      categorie_meteo, description_meteo, record_id
    from raw_weather))
where rn = 1"""

STEPS["m2"] = f"""select ville, id_prevision, date_heure_collecte, date_heure_prevue,
  datesub('hour', date_heure_collecte, date_heure_prevue)::bigint as horizon_heures,
  temperature_prevue, humidite_prevue, vent_prevu, categorie_prevue, description_prevue
from (
  select *, row_number() over (
    partition by ville, date_heure_collecte, date_heure_prevue
    order by id_prevision desc nulls last, temperature_prevue desc nulls last,
      humidite_prevue desc nulls last, vent_prevu desc nulls last,
      categorie_prevue desc nulls last, description_prevue desc nulls last) as rn
  from (
    select case when ville = 'Lisbon' then 'Lisbonne' else ville end as ville,
      try_cast(heure_run as timestamp) as date_heure_collecte,
      coalesce({_ts('forecast_timestamp')}, {_ts('time_api')},
        try_cast(split_part(record_forecast_id, '_', 2) as timestamp)) as date_heure_prevue,
      temperature as temperature_prevue, humidite as humidite_prevue,
      vitesse_vent as vent_prevu, categorie_meteo as categorie_prevue,
      description_meteo as description_prevue,
      coalesce(record_forecast_id, case when ville = 'Lisbon' then 'Lisbonne' else ville end
        || '_' || {_iso('coalesce(forecast_timestamp, time_api)')}) as id_prevision
    from raw_forecast)
  where date_heure_collecte is not null and date_heure_prevue is not null)
where rn = 1"""

_WET_OBSERVED = "'Rain', 'Drizzle'"
STEPS["m3"] = f"""select ville, heure_meteo, heure_meteo::date as jour,
  extract(hour from heure_meteo)::bigint as heure, temperature, humidite, vitesse_vent,
  {_FRENCH.format(c='categorie_meteo')} as categorie_meteo, description_meteo,
  risk as indice_risque_meteo, {_LABEL.format(r='risk')} as niveau_risque
from (select *,
  {_RISK.format(t='temperature', c='categorie_meteo', w='vitesse_vent', wet=_WET_OBSERVED)} as risk
  from m1)"""

STEPS["a1"] = f"""select ville, {_ts("epoch(heure_meteo)::bigint // 10800 * 10800")} as date_heure,
  {_round('avg(temperature)', 2)} as temperature_reelle,
  {_round('avg(vitesse_vent)', 2)} as vent_reel,
  {_round('avg(humidite)', 2)} as humidite_reelle,
  arg_min_null(categorie_meteo, heure_meteo) as categorie_reelle,
  arg_min_null(description_meteo, heure_meteo) as description_reelle
from m3 group by 1, 2"""

STEPS["m4"] = f"""select ville, date_heure_prevue, date_heure_collecte, horizon_heures,
  {_round('temperature_prevue', 2)} as temperature_prevue,
  {_round('humidite_prevue', 2)} as humidite_prevue,
  {_round('vent_prevu', 2)} as vent_prevu, categorie_prevue, description_prevue
from (select *, row_number() over (partition by ville, date_heure_prevue
    order by abs(horizon_heures - 24) asc nulls first, date_heure_collecte desc nulls last) as rn
  from m2)
where rn = 1"""

_PAIRS = (
    ("temperature", "temperature_prevue", "temperature_reelle", (1, 2, 3)),
    ("vent", "vent_prevu", "vent_reel", (1, 2, 3.5)),
    ("humidite", "humidite_prevue", "humidite_reelle", (5, 10, 20)),
)
_SCORED = ", ".join(
    f"{f}, {o}, {_gap(f, o)} as ecart_{n}, {_points(f, o, *steps)} as score_{n}_0_3"
    for n, f, o, steps in _PAIRS
)
_BOTH = " and ".join(f"{f} is not null and {o} is not null" for _, f, o, _ in _PAIRS)
_SUM = "(score_temperature_0_3 + score_vent_0_3 + score_humidite_0_3)"


def _accuracy(where: str) -> str:
    return f"""select ville, date_heure, date_heure::date as jour,
  extract(hour from date_heure)::bigint as heure,
  (extract(hour from date_heure) // 3)::bigint as tranche_3h_index,
  prevision_disponible_24h, comparaison_possible, date_heure_collecte, horizon_heures,
  temperature_prevue, temperature_reelle, ecart_temperature, score_temperature_0_3,
  vent_prevu, vent_reel, ecart_vent, score_vent_0_3,
  humidite_prevue, humidite_reelle, ecart_humidite, score_humidite_0_3,
  categorie_prevue, categorie_reelle, description_prevue, description_reelle,
  {_round(_SUM + ' / cast(9 as double) * 100', 1)} as score_fiabilite_0_100,
  case when {_SUM} is null then 'incomplet' when {_SUM} >= 8 then 'très fiable'
    when {_SUM} >= 6 then 'fiable' when {_SUM} >= 4 then 'assez fiable'
    else 'pas fiable' end as niveau_fiabilite
from (
  select a1.ville, a1.date_heure, date_heure_collecte, horizon_heures,
    (case when date_heure_collecte is not null then 1 else 0 end)::bigint
      as prevision_disponible_24h,
    (case when {_BOTH} then 1 else 0 end)::bigint as comparaison_possible,
    {_SCORED}, categorie_prevue, categorie_reelle, description_prevue, description_reelle
  from a1 left join m4 on m4.ville = a1.ville and m4.date_heure_prevue = a1.date_heure)
{where}"""


STEPS["m5"] = _accuracy("where date_heure_collecte is not null")
STEPS["m5_all"] = _accuracy("")

STEPS["m6"] = f"""select ville, categorie_prevue, n as nb_observations,
  mean as score_fiabilite_moyen_0_100,
  case when n < 8 then 'insuffisant' when mean >= 85 then 'très fiable'
    when mean >= 70 then 'fiable' when mean >= 55 then 'assez fiable'
    else 'pas fiable' end as niveau_confiance_historique
from (select ville, categorie_prevue, count(*) as n,
    {_round('avg(score_fiabilite_0_100)', 2)} as mean
  from m5 where score_fiabilite_0_100 is not null and categorie_prevue is not null
  group by ville, categorie_prevue)"""

_FORECAST_RISK = _RISK.format(
    t="temperature_prevue", c="categorie_prevue", w="vent_prevu", wet="'Rain'"
)
STEPS["m7"] = f"""select f.ville, f.date_heure_prevue, f.date_heure_prevue::date as jour_prevu,
  extract(hour from f.date_heure_prevue)::bigint as heure_prevue,
  f.date_heure_collecte as date_heure_collecte_utilisee, f.horizon_heures,
  {_round('f.temperature_prevue', 2)} as temperature_prevue,
  {_round('f.vent_prevu', 2)} as vent_prevu,
  {_round('f.humidite_prevue', 2)} as humidite_prevue,
  {_FRENCH.format(c='f.categorie_prevue')} as categorie_prevue_fr,
  f.categorie_prevue as categorie_prevue_en, f.description_prevue,
  f.risk as indice_risque_meteo_prevu, {_LABEL.format(r='f.risk')} as niveau_risque_prevu,
  r.nb_observations, r.score_fiabilite_moyen_0_100, r.niveau_confiance_historique,
  case when r.nb_observations is null then 'Confiance inconnue (pas d’historique)'
    when r.nb_observations < 10 then 'Données insuffisantes : prudence'
    when r.niveau_confiance_historique in ('très fiable', 'fiable') then 'Prévision à suivre'
    when r.niveau_confiance_historique = 'assez fiable' then 'Prévision plausible'
    else 'Prévision incertaine : prévoir une marge' end as recommandation
from (select *, {_FORECAST_RISK} as risk
  from (select *, row_number() over (partition by ville, date_heure_prevue
      order by date_heure_collecte desc nulls last) as rn
    from m2
    where date_heure_prevue::date between date '{AS_OF}' + 1 and date '{AS_OF}' + 2)
  where rn = 1) f
left join m6 r on r.ville = f.ville and r.categorie_prevue = f.categorie_prevue"""

def _sent(table: str, key: str, columns: str) -> str:
    """Two overlapping deliveries: other thirds, warmer values, repeats and lost keys in the second."""
    changed = {
        key: f"case when delivery = 1 and humidite % 7 = 0 then null else {key} end as {key}",
        "temperature": "temperature + warmer as temperature",
    }
    taken = ", ".join(changed.get(c, c) for c in columns.split(", "))
    return f"""select {taken}, delivery
from {table}, (values (0, 0::double), (1, 100), (1, 200)) as d(delivery, warmer)
where case warmer when 0 then humidite % 3 <> 2 when 100 then humidite % 3 <> 0
  else humidite % 3 <> 0 and humidite % 5 = 0 end"""


_RAW_WEATHER = (
    "record_id, ville, temperature, humidite, vitesse_vent, categorie_meteo, description_meteo, "
    "time_api, heure_run"
)
STEPS["sent_weather"] = _sent("raw_weather", "record_id", _RAW_WEATHER)
STEPS["sent_forecast"] = _sent("raw_forecast", "record_forecast_id", _RAW_FORECAST)


def _merged(table: str, key: str, columns: str, delivered: str = "") -> str:
    """Rows with their place among those of their id: by delivery, collection time, then values."""
    rest = [c for c in columns.split(", ") if c not in (key, "heure_run")]
    ties = ", ".join(f"{c} desc nulls last" for c in rest)
    return f"""select *, {key} is null or row_number() over (
  partition by {key} order by {delivered}heure_run asc nulls first, {ties}) = 1 as lands
from {table}"""


STEPS["landed_weather"] = _merged("sent_weather", "record_id", _RAW_WEATHER, "delivery, ")
STEPS["landed_forecast"] = _merged("sent_forecast", "record_forecast_id", _RAW_FORECAST, "delivery, ")

# Observations in three deliveries; a row is late if its hour ended by the watermark of its delivery.
STEPS["arrived"] = """select w.* exclude (delivery), delivery as batch,
  case when time_api is null then 'untimed'
    when time_api // 3600 * 3600 + 3600 <= newest - 7200 then 'late' else 'on_time' end as arrival
from (select *, least((time_api - 1704067200) // 864000 + (time_api % 7 = 0)::int, 2)::bigint as delivery
      from raw_weather) w
left join (select n, max(time_api) as newest
  from raw_weather, (values (1::bigint), (2)) as later(n)
  where least((time_api - 1704067200) // 864000 + (time_api % 7 = 0)::int, 2) < n group by n) on n = delivery"""
STEPS["on_time"] = "select * exclude (batch, arrival) from arrived where arrival = 'on_time'"
STEPS["m1_on_time"] = STEPS["m1"].replace("from raw_weather", "from on_time")

# Which steps each step reads.
READS = {
    "sent_weather": ("raw_weather",),
    "sent_forecast": ("raw_forecast",),
    "landed_weather": ("sent_weather",),
    "landed_forecast": ("sent_forecast",),
    "arrived": ("raw_weather",),
    "on_time": ("arrived",),
    "m1_on_time": ("on_time",),
    "ev": (),
    "raw_weather": ("ev",),
    "raw_forecast_once": ("ev",),
    "raw_forecast": ("raw_forecast_once",),
    "m1": ("raw_weather",),
    "m2": ("raw_forecast",),
    "m3": ("m1",),
    "a1": ("m3",),
    "m4": ("m2",),
    "m5": ("a1", "m4"),
    "m5_all": ("a1", "m4"),
    "m6": ("m5",),
    "m7": ("m2", "m6"),
}


def _with(sql: str, *reads: str) -> str:
    """The statement with every step it needs, directly or not, in front."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for parent in READS[name]:
            visit(parent)
        if name not in ordered:
            ordered.append(name)

    for name in reads:
        visit(name)
    # Worked out once each, however often they are read.
    steps = ",\n".join(f"{n} as materialized (\n{STEPS[n]}\n)" for n in ordered)
    return f"with {steps}\n{sql}"


def _nulls(model: str, *columns: str) -> str:
    step = {
        "stg_weather_stream": "m1",
        "stg_forecast": "m2",
        "int_forecast_24h": "m4",
        "mart_weather_accuracy_24h": "m5",
    }[model]
    return "\nunion all\n".join(
        f"select '{model}' as model_name, '{c}' as column_name, "
        f"count(*) filter (where {c} is null)::bigint as failures from {step}"
        for c in columns
    )


def _body(*fields: tuple[str, str]) -> str:
    """A JSON object as Spark writes it: in this order, without fields that are null."""
    quoted = lambda v: f"'\"' || {v} || '\"'"
    parts = []
    for name, kind in fields:
        value = f"cast({name} as varchar)" if kind == "number" else quoted(name)
        parts.append(f"""case when {name} is not null then '"{name.split(' ')[0]}":' || {value} end""")
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


_NUMBERS = ("temperature", "humidite", "vitesse_vent", "time_api")
_FIELDS = [(c, "number" if c in _NUMBERS else "text") for c in _RAW_WEATHER.split(", ")]
_REST = [f for f in _FIELDS if f[0] in ("record_id", "ville", "vitesse_vent", "time_api", "heure_run")]

# Hours and slots end before the last measurement less two hours, the stream's watermark.
_CLOSED = "<= (select max(time_api) from raw_weather) - 7200"


def _ingest_sql() -> dict[str, str]:
    return {
        "s1_flatten_current": _with(
            f"select * replace ('{COLLECTED_AT}' as heure_run) from raw_weather", "raw_weather"
        ),
        "s2_flatten_forecast": _with(
            f"""select ville || '_' || {_iso('time_api + i * 10800')} as record_forecast_id, ville,
  temperature + i as temperature, humidite, vitesse_vent, categorie_meteo, description_meteo,
  time_api + i * 10800 as time_api, '{COLLECTED_AT}' as heure_run,
  time_api + i * 10800 as forecast_timestamp
from raw_weather, (values (1::bigint), (2), (3)) as g(i) where i <= time_api % 4""",
            "raw_weather",
        ),
        "s3_publish_decode": _with("select *, true as is_good from raw_weather", "raw_weather"),
        "s5_decode_good": _with(
            """select * replace (case when time_api % 10 <> 3 then temperature end as temperature)
from raw_weather where time_api % 10 not in (0, 1, 4)""",
            "raw_weather",
        ),
        "s4_bounded_drain": _with(
            f"""select {_RAW_WEATHER} from ({_merged('raw_weather', 'record_id', _RAW_WEATHER)})
where lands""",
            "raw_weather",
        ),
        "s7_quarantine": _with(
            f"""select sha256(case time_api % 10 when 0 then 'no json'
    when 1 then {_body(*_REST, ('humidite + 0.5::double', 'number'))}
    else '[' || {_body(*_FIELDS)} || ']' end) as body_sha256, count(*) as nb_messages
from raw_weather where time_api % 10 in (0, 1, 4) group by 1""",
            "raw_weather",
        ),
        "s9_added_column": _with(
            """select * replace (case when humidite % 2 <> 0 then forecast_timestamp end
  as forecast_timestamp) from raw_forecast""",
            "raw_forecast",
        ),
        "s10_landing_reports": _with(
            """select delivery::bigint as batch, count(*) + count(*) filter (where humidite % 11 = 0) as read,
  count(*) filter (where lands) as inserted, count(*) filter (where not lands) as duplicates,
  count(*) filter (where humidite % 11 = 0) as quarantined
from landed_weather group by delivery""",
            "landed_weather",
        ),
        "t1_ingest_weather": _with(
            f"select {_RAW_WEATHER} from landed_weather where lands", "landed_weather"
        ),
        "t2_ingest_forecast": _with(
            f"select {_RAW_FORECAST} from landed_forecast where lands", "landed_forecast"
        ),
        "t3_newest_per_hour_stream": _with(
            f"select * from m1_on_time where epoch(heure_meteo)::bigint + 3600 {_CLOSED}", "m1_on_time"
        ),
        "t4_slots_3h_stream": _with(
            f"""select * from ({STEPS['a1'].replace('from m3', 'from m1_on_time')})
where epoch(date_heure)::bigint + 10800 {_CLOSED}""",
            "m1_on_time",
        ),
        "t5_late_rows": _with("select * from arrived", "arrived"),
    }


def oracle_sql() -> dict[str, str]:
    out = {
        "m1_stg_weather": _with("select * from m1", "m1"),
        "m2_stg_forecast": _with("select * from m2", "m2"),
        "m3_mart_weather": _with("select * from m3", "m3"),
        "m4_forecast_24h": _with("select * from m4", "m4"),
        "m5_accuracy": _with("select * from m5", "m5"),
        "m5_accuracy_uncovered": _with("select * from m5_all", "m5_all"),
        "m6_reference": _with("select * from m6", "m6"),
        "m7_next_two_days": _with("select * from m7", "m7"),
        "a1_slots_3h": _with("select * from a1", "a1"),
    }
    out["s8_merge_insert_only"] = _with(
        f"""select {_RAW_FORECAST} from (
  select *, record_forecast_id is not null and bool_or(
    coalesce((time_api // 10800) % 5 = 0, false)) over (partition by record_forecast_id) as held
  from ({_merged('raw_forecast', 'record_forecast_id', _RAW_FORECAST)}))
where lands and not held""",
        "raw_forecast",
    )
    out["s12_full_refresh"] = out["m7_next_two_days"]
    missing = "\nunion all\n".join(
        (
            _nulls("stg_weather_stream", "ville", "heure_meteo"),
            _nulls(
                "stg_forecast", "ville", "date_heure_prevue", "date_heure_collecte", "id_prevision"
            ),
            _nulls("int_forecast_24h", "ville", "date_heure_prevue"),
            _nulls("mart_weather_accuracy_24h", "ville", "date_heure"),
        )
    )
    # Times the raw tables give but nobody can read; epochs are sound throughout.
    unread = "\nunion all\n".join(
        f"select '{t}', '{c}', count(*) filter (where {c} is not null and {bad})::bigint from {t}"
        for t, columns in (
            ("raw_weather", ("heure_run", "time_api")),
            ("raw_forecast", ("heure_run", "time_api", "forecast_timestamp")),
        )
        for c in columns
        for bad in ["try_cast(heure_run as timestamp) is null" if c == "heure_run" else "false"]
    )
    models = ("m1", "m2", "m4", "m5")
    out["q1_not_null"] = _with(missing, *models)
    out["q2_counted_quality"] = _with(f"{missing}\nunion all\n{unread}", *models)
    out["k1_risk_by_city"] = _with(
        "select ville, niveau_risque, count(*) as nb_heures from m3 group by 1, 2", "m3"
    )
    out["k2_high_risk_slots"] = _with(
        f"""select ville, heure, count(*) as nb_heures,
  count(*) filter (where indice_risque_meteo = 2) as nb_risque_fort,
  {_round("count(*) filter (where indice_risque_meteo = 2)::double / count(*)", 4)}
    as part_risque_fort
from m3 group by 1, 2""",
        "m3",
    )
    out["k3_risk_48h"] = _with(
        f"""select *, {_LABEL.format(r='risque_max')} as niveau_risque_max
from (select ville, jour_prevu, count(*) as nb_creneaux,
    max(indice_risque_meteo_prevu) as risque_max
  from m7 group by 1, 2)""",
        "m7",
    )
    out["k4_category_distribution"] = _with(
        f"""select ville, categorie_meteo, nb_heures,
  {_round("nb_heures::double / sum(nb_heures) over (partition by ville)", 4)} as part
from (select ville, categorie_meteo, count(*) as nb_heures from m3 group by 1, 2)""",
        "m3",
    )
    out["k5_global_reliability"] = _with(
        f"""select case when grouping(ville) = 1 then 'global' else 'ville' end as portee, ville,
  count(*) as nb_creneaux,
  {_round("sum(score_fiabilite_0_100::decimal(9,1))::double / count(*)", 2)} as score_moyen
from m5 where score_fiabilite_0_100 is not null group by grouping sets ((), (ville))""",
        "m5",
    )
    out["k6_unstable_city"] = _with(
        f"""select ville, nb_heures, nb_heures_a_risque,
  {_round("nb_heures_a_risque::double / nb_heures", 4)} as part_a_risque
from (select ville, count(*) as nb_heures,
    count(*) filter (where indice_risque_meteo >= 1) as nb_heures_a_risque
  from m3 group by 1)
order by nb_heures_a_risque::double / nb_heures desc, ville asc limit 1""",
        "m3",
    )
    out.update(_ingest_sql())
    return out
