"""The same results as plain SQL over the given tables, for an independent engine."""

from machpulse.functions.fixed_values import (
    ALERT_RULES,
    EVENT_SOURCES,
    EVENT_TYPES,
    MACHINE_ID_RANGE,
    MEASURES,
    PLAUSIBLE_RANGES,
    RED_FROM,
    WEEKDAYS,
)
from machpulse.functions.keyed_hash import key_pads
from machpulse.plans.bindings import AS_OF, DEMO_KEY, RUN_DATE
from machpulse.plans.catalogue import HISTORY_MACHINE, PERIOD, SPLIT_DAY

_ID_DATE = RUN_DATE.replace("-", "")


def _r(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


_MEASURES = _r(*MEASURES)

_TELE = """tele AS (
  SELECT event_id, CAST(user_id AS INTEGER) AS machine_id, date_trunc('second', ts) AS datetime_mes,
         100.0::DOUBLE + value AS volt, 418.5::DOUBLE + (event_id % 40) * 9 AS rotate,
         25.0::DOUBLE + value AS pressure, 2.0::DOUBLE + value / 2 AS vibration,
         date_trunc('second', ts) + to_seconds(CAST(event_id % 45 AS BIGINT)) AS horodatage_ingestion
  FROM events)"""

_MOTIF = "CASE " + " ".join(
    f"WHEN {c} < {low} OR {c} > {high} THEN '{c}_hors_plage'" for c, (low, high) in PLAUSIBLE_RANGES.items()
) + " END"

_FLAGGED = f"{_TELE}, flagged AS (SELECT *, {_MOTIF} AS motif FROM tele)"
_VALID = f"{_FLAGGED}, valid AS (SELECT * FROM flagged WHERE motif IS NULL)"


def _windows(source: str, unit: str) -> str:
    return f"""windows AS (
  SELECT machine_id, date_trunc('{unit}', datetime_mes) AS fenetre,
         sqrt(avg(vibration * vibration)) AS rms_vibration, avg(pressure) AS pression_moyenne
  FROM {source} GROUP BY 1, 2)"""


_TREND = """trend AS (
  SELECT *, pression_moyenne - coalesce(lag(pression_moyenne) OVER (PARTITION BY machine_id ORDER BY fenetre),
                                        pression_moyenne) AS tendance_pression
  FROM windows)"""
_ALL_TREND = f"{_TELE}, {_windows('tele', 'minute')}, {_TREND}"
_VALID_TREND = f"{_VALID}, {_windows('valid', 'minute')}, {_TREND}"
_TREND_COLUMNS = f"machine_id, fenetre, {_r('rms_vibration', 'pression_moyenne', 'tendance_pression')}"

# Messages: text built by concatenation, read back by the engine's own JSON functions.
_MESSAGES = f"""{_TELE}, bodies AS (
  SELECT event_id, machine_id, datetime_mes,
    '{{"machine_id":"' || CASE WHEN event_id % 50 = 2 THEN 'x' ELSE CAST(machine_id AS VARCHAR) END || '","datetime_mes":"'
    || CASE WHEN event_id % 50 = 3 THEN 'pas-une-date' ELSE strftime(datetime_mes, '%Y-%m-%dT%H:%M:%S') END || '",'
    || CASE WHEN event_id % 50 = 1 THEN '' ELSE '"volt":' || CAST(volt AS VARCHAR) || ',' END
    || '"rotate":' || CAST(rotate AS VARCHAR) || ',"pressure":' || CAST(pressure AS VARCHAR)
    || ',"vibration":' || CAST(vibration AS VARCHAR) || '}}' AS body
  FROM tele),
messages AS (
  SELECT event_id, machine_id, datetime_mes,
    CASE WHEN event_id % 50 = 0 THEN left(body, length(body) - 5) ELSE body END AS value,
    'usine/capteurs/' || CAST(machine_id AS VARCHAR) || CASE WHEN event_id % 7 = 0 THEN '/atelier/mesure' ELSE '/mesure' END AS topic
  FROM bodies)"""


def _json(field: str) -> str:
    return f"json_extract_string(CASE WHEN json_valid(value) THEN value END, '$.{field}')"


_PARSED = f"""{_MESSAGES}, texts AS (
  SELECT event_id, value, json_valid(value) AS ok, {", ".join(f"{_json(f)} AS t_{f}" for f in ("machine_id", "datetime_mes", *MEASURES))}
  FROM messages),
parsed AS (
  SELECT event_id, value, TRY_CAST(t_machine_id AS INTEGER) AS machine_id, TRY_CAST(t_datetime_mes AS TIMESTAMP) AS datetime_mes,
    {", ".join(f"TRY_CAST(t_{f} AS DOUBLE) AS {f}" for f in MEASURES)},
    CASE WHEN NOT ok THEN 'json_invalide'
         WHEN t_machine_id IS NULL OR t_datetime_mes IS NULL OR {" OR ".join(f"t_{f} IS NULL" for f in MEASURES)} THEN 'champ_manquant'
         WHEN TRY_CAST(t_machine_id AS INTEGER) IS NULL
              OR TRY_CAST(t_machine_id AS INTEGER) NOT BETWEEN {MACHINE_ID_RANGE[0]} AND {MACHINE_ID_RANGE[1]}
              OR {" OR ".join(f"TRY_CAST(t_{f} AS DOUBLE) IS NULL" for f in MEASURES)} THEN 'type_invalide'
         WHEN TRY_CAST(t_datetime_mes AS TIMESTAMP) IS NULL THEN 'horodatage_invalide' END AS malformed_reason
  FROM texts),
streamed AS (SELECT *, {_MOTIF} AS motif FROM parsed WHERE malformed_reason IS NULL),
accepted AS (SELECT * FROM streamed WHERE motif IS NULL)"""

_STAGING = """erreurs AS (
  SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS datetime_evt, CAST(user_id AS INTEGER) AS machine_id,
         'error' || CAST(event_id % 5 + 1 AS VARCHAR) AS code FROM events WHERE event_type = 'error'),
pannes AS (
  SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS datetime_evt, CAST(user_id AS INTEGER) AS machine_id,
         'comp' || CAST(event_id % 4 + 1 AS VARCHAR) AS code FROM events WHERE event_type = 'purchase'),
maintenances AS (
  SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS datetime_evt, CAST(user_id AS INTEGER) AS machine_id,
         'comp' || CAST(event_id % 4 + 1 AS VARCHAR) AS code FROM events WHERE event_type = 'signup'),
machines AS (
  SELECT CAST(c_custkey AS INTEGER) AS machine_id, 'model' || CAST(c_custkey % 4 + 1 AS VARCHAR) AS model,
         CAST(c_custkey % 21 AS INTEGER) AS age, c_acctbal FROM customer)"""

_FACT = f"""{_STAGING}, fused AS (
  SELECT 'ERREUR' AS code_type, 'PdM_errors.csv' AS source_fichier, * FROM erreurs
  UNION SELECT 'PANNE', 'PdM_failures.csv', * FROM pannes
  UNION SELECT 'MAINTENANCE', 'PdM_maint.csv', * FROM maintenances),
fact AS (
  SELECT f.machine_id AS machine_id_nat, code_type, code AS code_brut, datetime_evt,
         CAST(strftime(datetime_evt, '%Y%m%d') AS INTEGER) AS id_date, source_fichier, true AS sans_operateur
  FROM fused f JOIN machines m ON m.machine_id = f.machine_id)"""


def _dim_date(days: str) -> str:
    weekday = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(WEEKDAYS, 1))
    return f"""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS id_date, CAST(d AS VARCHAR) AS date_complete,
  CAST(year(d) AS INTEGER) AS annee, CAST(quarter(d) AS INTEGER) AS trimestre, CAST(month(d) AS INTEGER) AS mois,
  CAST(day(d) AS INTEGER) AS jour, CASE isodow(d) {weekday} END AS jour_semaine, isodow(d) IN (6, 7) AS est_weekend
FROM ({days})"""


_DAILY_TELEMETRY = f"""daily_tele AS (
  SELECT machine_id, avg(rms_vibration) AS rms_vibration_moyen, max(rms_vibration) AS rms_vibration_max,
         avg(tendance_pression) AS tendance_pression_moyenne
  FROM trend WHERE CAST(fenetre AS DATE) = DATE '{RUN_DATE}' GROUP BY 1)"""
_DAY_MEASURES = _r("rms_vibration_moyen", "rms_vibration_max", "tendance_pression_moyenne")


def _daily_events(name: str, id_date: str) -> str:
    return f"""{name} AS (
  SELECT machine_id_nat,
         CAST(count(*) FILTER (WHERE code_type = 'ERREUR') AS INTEGER) AS nb_erreurs,
         CAST(count(*) FILTER (WHERE code_type = 'PANNE') AS INTEGER) AS nb_pannes,
         CAST(count(*) FILTER (WHERE code_type = 'MAINTENANCE') AS INTEGER) AS nb_maintenances
  FROM fact WHERE id_date = {id_date} GROUP BY 1)"""


_DAY = f"""day AS (
  SELECT {_ID_DATE} AS id_date, m.machine_id AS machine_id_nat, {_DAY_MEASURES},
         coalesce(nb_erreurs, 0) AS nb_erreurs, coalesce(nb_pannes, 0) AS nb_pannes,
         coalesce(nb_maintenances, 0) AS nb_maintenances
  FROM machines m LEFT JOIN daily_tele t ON t.machine_id = m.machine_id
  LEFT JOIN daily_ev e ON e.machine_id_nat = m.machine_id)"""
_DAY_ALL = f"{_VALID_TREND}, {_DAILY_TELEMETRY}, {_FACT}, {_daily_events('daily_ev', _ID_DATE)}, {_DAY}"
_DAY_COLUMNS = (
    "id_date, machine_id_nat, rms_vibration_moyen, rms_vibration_max, tendance_pression_moyenne, "
    "nb_erreurs, nb_pannes, nb_maintenances"
)


def _alert(rule: str, threshold: float, join: str = "LEFT JOIN fleet ON fenetre = eval_at", hold: int = 2) -> str:
    """Gaps and islands on an even grid that carries the latest window forward."""
    return f"""SELECT '{rule}' AS rule, eval_at, round(v, 6) AS value,
  CASE WHEN NOT breach THEN 'normal'
       WHEN eval_at - min(eval_at) OVER (PARTITION BY run, breach) >= INTERVAL {hold} MINUTE THEN 'firing' ELSE 'pending' END AS state
FROM (SELECT *, v > {threshold} AS breach,
             sum(CASE WHEN v > {threshold} THEN 0 ELSE 1 END) OVER (ORDER BY eval_at) AS run
      FROM (SELECT eval_at, last_value({rule} IGNORE NULLS) OVER (ORDER BY eval_at ROWS UNBOUNDED PRECEDING) AS v
            FROM grid {join}))"""


def _fleet(condition: str = "") -> str:
    return f"fleet AS (SELECT fenetre, {', '.join(f'max({r}) AS {r}' for r in ALERT_RULES)} FROM trend {condition} GROUP BY 1)"


def _episodes(rule: str, threshold: float) -> str:
    """Islands of evaluations above the threshold; the one of the last evaluation has no end."""
    return f"""SELECT '{rule}' AS rule, min(eval_at) AS debut, nullif(max(eval_at), any_value(final)) AS fin
FROM (SELECT *, sum(CASE WHEN v > {threshold} THEN 0 ELSE 1 END) OVER (ORDER BY eval_at) AS run, max(eval_at) OVER () AS final
      FROM (SELECT eval_at, last_value({rule} IGNORE NULLS) OVER (ORDER BY eval_at ROWS UNBOUNDED PRECEDING) AS v
            FROM grid LEFT JOIN fleet ON fenetre = eval_at))
WHERE v > {threshold} GROUP BY run"""


def _blob(data: bytes) -> str:
    return f"from_hex('{data.hex()}')"


def _hmac(text: str) -> str:
    inner, outer = key_pads(DEMO_KEY)
    return f"sha256({_blob(outer)} || from_hex(sha256({_blob(inner)} || encode({text}))))"


_OPERATORS = """operateurs AS (
  SELECT 'OP-' || CAST(c_custkey AS VARCHAR) AS matricule, c_name AS nom, c_mktsegment AS equipe FROM customer)"""


def _panels() -> str:
    at = f"TIMESTAMP '{AS_OF}'"
    values = {
        "fraicheur_secondes": f"(SELECT CAST(date_diff('second', max(datetime_mes), {at}) AS DOUBLE) FROM valid)",
        "taux_erreur_pct": f"""(SELECT 100.0::DOUBLE * q / greatest(q + v, 1) FROM (SELECT
            (SELECT count(*) FROM flagged WHERE motif IS NOT NULL AND horodatage_ingestion >= {at} - INTERVAL 1 DAY) AS q,
            (SELECT count(*) FROM valid WHERE horodatage_ingestion >= {at} - INTERVAL 1 DAY) AS v))""",
        "latence_secondes": f"""(SELECT avg(date_diff('second', datetime_mes, horodatage_ingestion)) FROM valid
            WHERE horodatage_ingestion >= {at} - INTERVAL 1 HOUR)""",
    }
    rows = [
        f"""SELECT metric, round(value, 6) AS value,
            CASE WHEN value IS NULL THEN 'no_data' WHEN value >= {RED_FROM[m]} THEN 'red' ELSE 'green' END AS status
            FROM (SELECT '{m}' AS metric, {v} AS value)"""
        for m, v in values.items()
    ]
    rows.append(
        "SELECT 'messages_malformes', CAST(count(*) AS DOUBLE), 'info' FROM parsed WHERE malformed_reason IS NOT NULL"
    )
    # One WITH list: the message texts start from the same telemetry.
    rest = _PARSED.removeprefix(_TELE + ", ")
    return f"WITH {_VALID}, {rest} " + " UNION ALL ".join(rows)


def _stream_panels() -> str:
    """All messages arrived at one time, which is also that of the panels."""
    at = f"TIMESTAMP '{AS_OF}'"
    values = {
        "fraicheur_secondes": f"CAST(date_diff('second', max(datetime_mes), {at}) AS DOUBLE) FROM accepted",
        "taux_erreur_pct": "100.0::DOUBLE * count(motif) / greatest(count(*), 1) FROM streamed",
        "latence_secondes": f"avg(date_diff('second', datetime_mes, {at})) FROM accepted",
    }
    rows = [
        f"""SELECT metric, round(value, 6) AS value,
            CASE WHEN value IS NULL THEN 'no_data' WHEN value >= {RED_FROM[m]} THEN 'red' ELSE 'green' END AS status
            FROM (SELECT '{m}' AS metric, (SELECT {v}) AS value)"""
        for m, v in values.items()
    ]
    rows.append("SELECT 'messages_malformes', CAST(count(*) AS DOUBLE), 'info' FROM parsed WHERE malformed_reason IS NOT NULL")
    return f"WITH {_PARSED} " + " UNION ALL ".join(rows)


def _latest(rule: str) -> str:
    return f"""SELECT max(fenetre) AS fenetre, '{rule}' AS rule, round(max({rule}), 6) AS value,
  {ALERT_RULES[rule]}::DOUBLE AS threshold, max({rule}) > {ALERT_RULES[rule]} AS breach
FROM trend WHERE fenetre = (SELECT max(fenetre) FROM trend)"""


def _latest_per_machine(rule: str) -> str:
    return f"""SELECT machine_id, fenetre, '{rule}' AS rule, round({rule}, 6) AS value,
  {ALERT_RULES[rule]}::DOUBLE AS threshold, {rule} > {ALERT_RULES[rule]} AS breach
FROM trend t WHERE fenetre = (SELECT max(fenetre) FROM trend u WHERE u.machine_id = t.machine_id)"""


def _profile(c: str) -> str:
    low, high = PLAUSIBLE_RANGES[c]
    return f"""SELECT '{c}' AS champ, round(min({c}), 6) AS min, round(max({c}), 6) AS max,
  count(*) FILTER (WHERE {c} < {low}) AS below, count(*) FILTER (WHERE {c} > {high}) AS above, count(*) FILTER (WHERE isnan({c})) AS nan,
  round(min({c}) - {low}::DOUBLE, 6) AS margin_low, round({high}::DOUBLE - max({c}), 6) AS margin_high FROM tele"""


def _counts(table: str) -> str:
    return f"""SELECT '{table}' AS source, (SELECT count(*) FROM {table}) AS attempted,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM {table} EXCEPT
   SELECT * FROM {table} WHERE datetime_evt < TIMESTAMP '{SPLIT_DAY}')) AS inserted"""


_FACT_COLUMNS = "machine_id_nat, code_type, code_brut, datetime_evt, id_date, source_fichier, sans_operateur"
_TYPE_ROWS = ", ".join(f"('{code}', '{label}')" for _, code, label in EVENT_TYPES)
_LAST = "SELECT machine_id, max(datetime_mes) AS last_seen FROM {} GROUP BY 1"


def _orphans(table: str) -> str:
    return f"SELECT * FROM {table} WHERE machine_id NOT IN (SELECT machine_id FROM machines WHERE c_acctbal >= 0)"


def _event_rules(table: str, code: str) -> str:
    counted = {
        "not_null:datetime_evt": "count(*) FILTER (WHERE datetime_evt IS NULL)",
        "not_null:machine_id": "count(*) FILTER (WHERE machine_id IS NULL)",
        f"not_null:{code}": "count(*) FILTER (WHERE code IS NULL)",
        f"check:{code}": "count(*) FILTER (WHERE code IN ('error5', 'comp4'))",
        f"length:{code}": "count(*) FILTER (WHERE length(code) > 5)",
        f"unique:datetime_evt,machine_id,{code}": f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {table}))",
        "foreign:machine_id": f"any_value((SELECT count(*) FROM ({_orphans(table)})))",
    }
    return " UNION ALL ".join(f"SELECT '{table}' AS source, '{r}' AS rule, {n} AS violations FROM {table}" for r, n in counted.items())


def all_sql() -> dict[str, str]:
    return {
        "parsed_messages": f"""WITH {_PARSED} SELECT event_id,
            {", ".join(f"CASE WHEN malformed_reason IS NULL THEN {c} END AS {c}" for c in ("machine_id", "datetime_mes"))},
            {", ".join(f"CASE WHEN malformed_reason IS NULL THEN round({c}, 6) END AS {c}" for c in MEASURES)},
            malformed_reason FROM parsed""",
        "dead_letters": f"WITH {_PARSED} SELECT event_id, value, malformed_reason FROM parsed WHERE malformed_reason IS NOT NULL",
        "typed_messages": f"""WITH {_TELE} SELECT event_id,
            CASE event_id % 8 WHEN 3 THEN 1 WHEN 4 THEN 0 WHEN 5 THEN NULL WHEN 6 THEN NULL ELSE machine_id END AS machine_id,
            CASE WHEN event_id % 8 IN (5, 6) THEN NULL WHEN event_id % 5 IN (0, 1) THEN CAST(CAST(round(volt, 6) AS DECIMAL(18, 6)) AS VARCHAR)
                 WHEN event_id % 5 = 2 THEN '1.000000' WHEN event_id % 5 = 3 THEN 'NaN' ELSE '105.000000' END AS volt,
            CASE WHEN event_id % 8 IN (5, 6) THEN 'type_invalide' END AS malformed_reason FROM tele""",
        "keyed_messages": f"""WITH {_TELE} SELECT CAST(machine_id AS VARCHAR) AS key,
            '{{"machine_id":' || CAST(machine_id AS VARCHAR) || ',"datetime_mes":"' || strftime(datetime_mes, '%Y-%m-%dT%H:%M:%S')
            || '","volt":' || CAST(volt AS VARCHAR) || ',"rotate":' || CAST(rotate AS VARCHAR) || ',"pressure":'
            || CAST(pressure AS VARCHAR) || ',"vibration":' || CAST(vibration AS VARCHAR) || '}}' AS value FROM tele""",
        "topic_filter": f"""WITH {_MESSAGES} SELECT event_id, topic FROM messages
            WHERE len(string_split(topic, '/')) = 4 AND starts_with(topic, 'usine/capteurs/') AND ends_with(topic, '/mesure')""",
        "range_flags": f"WITH {_FLAGGED} SELECT event_id, machine_id, coalesce(motif, 'valide') AS motif FROM flagged",
        "valid_quarantine_split": f"WITH {_FLAGGED} SELECT coalesce(motif, 'valide') AS motif, count(*) AS n FROM flagged GROUP BY 1",
        "range_profile": f"WITH {_TELE} " + " UNION ALL ".join(_profile(c) for c in MEASURES),
        "raw_table_rows": f"""WITH {_VALID} SELECT machine_id, datetime_mes, {_MEASURES}, horodatage_ingestion,
            CAST(strftime(datetime_mes, '%Y%m') AS INTEGER) AS mois FROM valid""",
        "quarantine_rows": f"""WITH {_FLAGGED} SELECT machine_id, datetime_mes, {_MEASURES}, motif,
            horodatage_ingestion AS horodatage_quarantaine, CAST(strftime(datetime_mes, '%Y%m') AS INTEGER) AS mois
            FROM flagged WHERE motif IS NOT NULL""",
        "silent_sensors": f"""WITH {_VALID}, {_STAGING}, seen AS ({_LAST.format("valid")})
            SELECT m.machine_id, last_seen FROM machines m LEFT JOIN seen s ON s.machine_id = m.machine_id
            WHERE last_seen IS NULL OR TIMESTAMP '{AS_OF}' - last_seen > INTERVAL 12 HOUR ORDER BY 1""",
        "last_seen": f"WITH {_VALID} {_LAST.format('valid')}",
        "never_seen": f"WITH {_VALID}, {_STAGING} SELECT machine_id FROM machines EXCEPT SELECT machine_id FROM valid",
        "valid_window_trend": f"WITH {_VALID_TREND} SELECT {_TREND_COLUMNS} FROM trend",
        "minute_windows": f"""WITH {_TELE}, {_windows('tele', 'minute')}
            SELECT machine_id, fenetre, {_r('rms_vibration', 'pression_moyenne')} FROM windows""",
        "partial_states": f"""WITH {_VALID} SELECT machine_id, date_trunc('hour', datetime_mes) AS fenetre,
            round(sum(vibration * vibration), 6) AS sum_sq, round(sum(pressure), 6) AS sum_p, count(*) AS n
            FROM valid GROUP BY 1, 2""",
        "merged_states": f"""WITH {_TELE} SELECT machine_id, CAST(date_trunc('day', datetime_mes) AS TIMESTAMP) AS fenetre,
            round(sqrt(avg(vibration * vibration)), 6) AS rms_vibration, round(avg(pressure), 6) AS pression_moyenne
            FROM tele GROUP BY 1, 2""",
        "hourly_trend": f"WITH {_TELE}, {_windows('tele', 'hour')}, {_TREND} SELECT {_TREND_COLUMNS} FROM trend",
        "trend_split_by_day": f"WITH {_ALL_TREND} SELECT {_TREND_COLUMNS} FROM trend",
        "trend_of_partials": f"WITH {_ALL_TREND} SELECT {_TREND_COLUMNS} FROM trend",
        "day_trend_with_carry": f"WITH {_ALL_TREND} SELECT {_TREND_COLUMNS} FROM trend WHERE CAST(fenetre AS DATE) = DATE '{RUN_DATE}'",
        "machine_history": f"""WITH {_TELE} SELECT machine_id, datetime_mes, {_MEASURES} FROM tele
            WHERE machine_id = {HISTORY_MACHINE} ORDER BY datetime_mes""",
        "fleet_period": f"""WITH {_TELE} SELECT event_id, machine_id, datetime_mes, {_MEASURES} FROM tele
            WHERE datetime_mes >= TIMESTAMP '{PERIOD[0]}' AND datetime_mes < TIMESTAMP '{PERIOD[1]}'""",
        "landed_staging": f"""WITH {_STAGING} SELECT 'erreurs' AS source, *, NULL::INTEGER AS age FROM erreurs
            UNION ALL SELECT 'pannes', *, NULL FROM pannes UNION ALL SELECT 'maintenances', *, NULL FROM maintenances
            UNION ALL SELECT 'machines', NULL, machine_id, model, age FROM machines""",
        "staging_insert": f"""WITH {_STAGING} SELECT datetime_evt, machine_id, code AS error_id FROM (
            SELECT * FROM erreurs EXCEPT SELECT * FROM erreurs WHERE datetime_evt < TIMESTAMP '{SPLIT_DAY}')""",
        "staging_counts": f"WITH {_STAGING} " + " UNION ALL ".join(_counts(t) for t in ("erreurs", "pannes", "maintenances")),
        "first_write_wins": """SELECT machine_id, model, age FROM (
            SELECT CAST(o_custkey AS INTEGER) AS machine_id, 'model' || CAST(o_orderkey % 4 + 1 AS VARCHAR) AS model,
                   CAST(o_orderkey % 21 AS INTEGER) AS age FROM orders)
            QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY age, model) = 1""",
        "dim_machine": f"""WITH {_STAGING} SELECT machine_id AS machine_id_nat, model, age,
            CASE WHEN age <= 5 THEN '0-5 ans' WHEN age <= 10 THEN '6-10 ans' WHEN age <= 15 THEN '11-15 ans'
                 ELSE '16-20 ans' END AS tranche_age, c_acctbal < 0 AS surrogate_kept FROM machines""",
        "surrogate_keys": f"""WITH {_FACT} SELECT 'machine' AS dimension, count(*) AS n, count(*) AS n_distinct, 0::BIGINT AS n_bad
            FROM machines UNION ALL SELECT 'code', count(*), count(*), 0
            FROM (SELECT DISTINCT code_type, code FROM fused)""",
        "dim_date": f"WITH {_STAGING} " + _dim_date(
            "SELECT CAST(datetime_evt AS DATE) AS d FROM erreurs UNION SELECT CAST(datetime_evt AS DATE) FROM pannes "
            "UNION SELECT CAST(datetime_evt AS DATE) FROM maintenances"
        ),
        "dim_date_calendar": _dim_date(
            "SELECT CAST(x AS DATE) AS d FROM (SELECT unnest(generate_series(min(o_orderdate)::TIMESTAMP, "
            "max(o_orderdate)::TIMESTAMP, INTERVAL 1 DAY)) AS x FROM orders)"
        ),
        "dim_code": f"WITH {_FACT} SELECT DISTINCT code_type, code AS code_brut, code AS libelle FROM fused",
        "event_type_usage": f"""WITH {_FACT}, types(code_type, libelle) AS (VALUES {_TYPE_ROWS})
            SELECT code_type, libelle, count(*) AS n FROM fact JOIN types USING (code_type) GROUP BY 1, 2""",
        "event_fact": f"WITH {_FACT} SELECT {_FACT_COLUMNS} FROM fact",
        "event_fact_increment": f"WITH {_FACT} SELECT {_FACT_COLUMNS} FROM fact WHERE datetime_evt >= TIMESTAMP '{SPLIT_DAY}'",
        "interventions": f"WITH {_FACT} SELECT {_FACT_COLUMNS} FROM fact WHERE code_type IN ('PANNE', 'MAINTENANCE')",
        "event_history": f"WITH {_FACT} SELECT {_FACT_COLUMNS} FROM fact WHERE machine_id_nat = {HISTORY_MACHINE} ORDER BY datetime_evt",
        "orphan_events": f"WITH {_STAGING} " + " UNION ALL ".join(
            f"SELECT '{t}' AS source, datetime_evt, machine_id, code FROM ({_orphans(t)})" for t in EVENT_SOURCES
        ),
        "constraint_report": f"""WITH {_STAGING}
            {" UNION ALL ".join(_event_rules(t, code) for t, (_, code, _) in EVENT_SOURCES.items())}
            UNION ALL SELECT 'machines', rule, violations FROM (
              SELECT 'not_null:machine_id' AS rule, count(*) FILTER (WHERE machine_id IS NULL) AS violations FROM machines
              UNION ALL SELECT 'not_null:model', count(*) FILTER (WHERE model IS NULL) FROM machines
              UNION ALL SELECT 'not_null:age', count(*) FILTER (WHERE age IS NULL) FROM machines
              UNION ALL SELECT 'check:age', count(*) FILTER (WHERE age NOT BETWEEN 0 AND 40) FROM machines
              UNION ALL SELECT 'check:machine_id', count(*) FILTER (WHERE machine_id NOT BETWEEN 0 AND 65535) FROM machines
              UNION ALL SELECT 'length:model', count(*) FILTER (WHERE length(model) > 20) FROM machines)""",
        "daily_telemetry": f"WITH {_VALID_TREND}, {_DAILY_TELEMETRY} SELECT machine_id, {_DAY_MEASURES} FROM daily_tele",
        "daily_events": f"WITH {_FACT}, {_daily_events('daily_ev', _ID_DATE)} SELECT * FROM daily_ev",
        "daily_consolidation": f"WITH {_DAY_ALL} SELECT {_DAY_COLUMNS} FROM day",
        "daily_upsert": f"""WITH {_DAY_ALL}, {_daily_events('eve', '20240109')} SELECT {_DAY_COLUMNS} FROM day
            UNION ALL SELECT 20240109, machine_id_nat, NULL, NULL, NULL, nb_erreurs, nb_pannes, nb_maintenances FROM eve""",
        "health_panels": _panels(),
        "recent_readings": f"""WITH {_VALID} SELECT event_id, machine_id, datetime_mes, horodatage_ingestion FROM valid
            WHERE horodatage_ingestion >= TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY""",
        "latest_breaches": f"WITH {_VALID_TREND} " + " UNION ALL ".join(_latest(r) for r in ALERT_RULES),
        "machine_breaches": f"WITH {_VALID_TREND} " + " UNION ALL ".join(_latest_per_machine(r) for r in ALERT_RULES),
        "alert_states": f"""WITH {_VALID_TREND}, fleet AS (
            SELECT fenetre, {", ".join(f"max({r}) AS {r}" for r in ALERT_RULES)} FROM trend GROUP BY 1),
            grid AS (SELECT unnest(generate_series(min(fenetre), max(fenetre), INTERVAL 1 MINUTE)) AS eval_at FROM fleet) """
        + " UNION ALL ".join(_alert(r, t) for r, t in ALERT_RULES.items()),
        "alert_states_5min": f"""WITH {_VALID_TREND}, fleet AS (
            SELECT fenetre, {", ".join(f"max({r}) AS {r}" for r in ALERT_RULES)} FROM trend GROUP BY 1),
            grid AS (SELECT unnest(generate_series(
              time_bucket(INTERVAL 5 MINUTE, min(fenetre) + INTERVAL 4 MINUTE + INTERVAL 59 SECOND),
              time_bucket(INTERVAL 5 MINUTE, max(fenetre)), INTERVAL 5 MINUTE)) AS eval_at FROM fleet) """
        + " UNION ALL ".join(_alert(r, t, "ASOF JOIN fleet ON fenetre <= eval_at", 10) for r, t in ALERT_RULES.items()),
        "trend_in_view_order": f"WITH {_VALID_TREND} SELECT {_TREND_COLUMNS} FROM trend ORDER BY machine_id, fenetre",
        "daily_run_interrupted": f"WITH {_DAY_ALL} SELECT {_DAY_COLUMNS} FROM day",
        "pseudonymised_operators": f"""WITH {_OPERATORS} SELECT {_hmac('matricule')} AS matricule_pseudonymise,
            {_hmac('nom')} AS nom_pseudonymise, equipe FROM operateurs""",
        "pseudonym_join": """SELECT c_mktsegment AS equipe, count(DISTINCT o_custkey) AS operateurs,
            count(*)::HUGEINT::BIGINT AS interventions FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1""",
        "refused_identifiers": f"""WITH {_OPERATORS}, blanked AS (SELECT nom, equipe, CASE WHEN equipe = 'FURNITURE' THEN ''
              WHEN equipe <> 'MACHINERY' THEN matricule END AS matricule FROM operateurs)
            SELECT nom, equipe, CASE WHEN matricule <> '' THEN {_hmac('matricule')} END AS matricule_pseudonymise,
              CASE WHEN matricule IS NULL OR matricule = '' THEN 'matricule_vide' END AS rejet_motif FROM blanked""",
        "stream_trend": f"WITH {_PARSED}, {_windows('accepted', 'minute')}, {_TREND} SELECT {_TREND_COLUMNS} FROM trend",
        "stream_replayed": f"""WITH {_PARSED}, {_windows('accepted', 'minute')}
            SELECT machine_id, fenetre, {_r('rms_vibration', 'pression_moyenne')} FROM windows""",
        "stream_tables": f"""WITH {_PARSED} SELECT 'telemetrie' AS sink, count(*) AS n FROM accepted
            UNION ALL SELECT 'lac', count(*) FROM accepted
            UNION ALL SELECT 'quarantaine', count(*) FROM streamed WHERE motif IS NOT NULL
            UNION ALL SELECT 'rejets', count(*) FROM parsed WHERE malformed_reason IS NOT NULL""",
        "stream_batch_counts": f"""WITH {_PARSED} SELECT (SELECT count(*) FROM accepted) AS valides,
            (SELECT count(*) FROM streamed WHERE motif IS NOT NULL) AS quarantaine,
            (SELECT count(*) FROM parsed WHERE malformed_reason IS NOT NULL) AS malformes""",
        "stream_raw_table": f"""WITH {_PARSED} SELECT machine_id, datetime_mes, {_MEASURES},
            CAST(strftime(datetime_mes, '%Y%m') AS INTEGER) AS mois FROM accepted""",
        "relay_dead_letters": f"""WITH {_PARSED} SELECT topic, value, malformed_reason FROM parsed JOIN messages USING (event_id, value)
            WHERE malformed_reason IS NOT NULL AND len(string_split(topic, '/')) = 4""",
        "relayed_messages": f"""WITH {_PARSED} SELECT CAST(parsed.machine_id AS VARCHAR) AS key, count(*) AS n
            FROM parsed JOIN messages USING (event_id) WHERE malformed_reason IS NULL AND len(string_split(topic, '/')) = 4 GROUP BY 1""",
        "alerts_now": f"""WITH {_PARSED}, {_windows('accepted', 'minute')}, {_TREND}, {_fleet(f"WHERE fenetre <= TIMESTAMP '{AS_OF}'")},
            grid AS (SELECT unnest(generate_series(min(fenetre), TIMESTAMP '{AS_OF}', INTERVAL 1 MINUTE)) AS eval_at FROM fleet)
            SELECT * FROM (""" + " UNION ALL ".join(_alert(r, t) for r, t in ALERT_RULES.items()) + """)
            QUALIFY eval_at = max(eval_at) OVER ()""",
        "alert_journal": f"""WITH {_PARSED}, {_windows('accepted', 'minute')}, {_TREND}, {_fleet()},
            grid AS (SELECT unnest(generate_series(min(fenetre), max(fenetre), INTERVAL 1 MINUTE)) AS eval_at FROM fleet) """
        + " UNION ALL ".join(_episodes(r, t) for r, t in ALERT_RULES.items()),
        "stream_health": _stream_panels(),
        "daily_run": f"WITH {_DAY_ALL} SELECT {_DAY_COLUMNS} FROM day",
        "daily_run_events": f"WITH {_FACT} SELECT code_type, id_date, count(*) AS n FROM fact GROUP BY 1, 2",
    }
