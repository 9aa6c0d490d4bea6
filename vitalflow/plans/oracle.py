"""SQL equivalents of the registered queries, for checking on another engine.

Written from the definition of each operator, not from its Spark plan: windows where the
library works in pieces, joins where it aggregates.
"""

from __future__ import annotations

import re

from .. import schemas as S
from .proxy import AS_OF, ENTITY_TYPES, RAW_SQL, SOURCE_SYSTEM, TABLES, TARGET_WORDS

NOW = f"TIMESTAMP '{AS_OF} 00:00:00'"
OPEN = "TIMESTAMP '9999-12-31 00:00:00'"
META = f"{NOW} AS INGESTION_TIMESTAMP, '{SOURCE_SYSTEM}' AS SOURCE_SYSTEM"
LOADED = f"{NOW} AS SILVER_LOAD_TIMESTAMP"


def q(name: str) -> str:
    return f'"{name}"'


def missing(c: str, *extra: str) -> str:
    texts = ", ".join(f"'{t}'" for t in ("NULL", "", *extra))
    return f"({c} IS NULL OR {c} IN ({texts}))"


def ts(c: str) -> str:
    return f"TRY_CAST({c} AS TIMESTAMP)"


def day(c: str) -> str:
    return f"CAST({ts(c)} AS DATE)"


def show(body: str, days: tuple = (), times: tuple = (), doubles: tuple = (), ints: tuple = ()) -> str:
    """Print values the way the Spark side prints them."""
    parts = [f"strftime({q(c)}, '%Y-%m-%d') AS {q(c)}" for c in days]
    parts += [f"strftime({q(c)}, '%Y-%m-%d %H:%M:%S') AS {q(c)}" for c in times]
    parts += [f"round({q(c)}, 6) AS {q(c)}" for c in doubles]
    parts += [f"CAST({q(c)} AS BIGINT) AS {q(c)}" for c in ints]
    replace = f" REPLACE ({', '.join(parts)})" if parts else ""
    return f"SELECT *{replace} FROM ({body}) AS shown"


CTE: dict[str, str] = {n: sql.format(**{t: t for t in TABLES}) for n, sql in RAW_SQL.items()}

# --- silver ------------------------------------------------------------------------------
_fill = ", ".join(
    f"CASE WHEN {missing(c, 'false')} THEN '{t}' ELSE {c} END AS {c}" for c, t in S.IDENTITY_PLACEHOLDERS.items()
)
CTE["patients_silver"] = f"""
SELECT ID AS PATIENT_ID, {day('BIRTHDATE')} AS BIRTHDATE,
  CASE WHEN {missing('DEATHDATE')} THEN DATE '9999-12-31' ELSE {day('DEATHDATE')} END AS DEATHDATE,
  {_fill}, CASE WHEN {missing('MARITAL')} THEN 'UNKNOWN' ELSE MARITAL END AS MARITAL,
  RACE, ETHNICITY, GENDER, BIRTHPLACE, ADDRESS, concat_ws(' ', FIRST, LAST) AS FULL_NAME, {META}
FROM patients_raw"""
_why = "coalesce(REASONCODE, 'N/A') AS REASONCODE, coalesce(REASONDESCRIPTION, 'Unspecified') AS REASONDESCRIPTION"
CTE["encounters_silver"] = f"""
SELECT ID AS ENCOUNTER_ID, PATIENT AS PATIENT_ID, CODE, DESCRIPTION, coalesce(REASONCODE, 'N/A') AS REASONCODE,
  coalesce(REASONDESCRIPTION, 'Routine / Unspecified') AS REASONDESCRIPTION, {ts('DATE')} AS ENCOUNTER_DATE, {META}
FROM encounters_raw"""
_links = "PATIENT AS PATIENT_ID, ENCOUNTER AS ENCOUNTER_ID, CODE, DESCRIPTION"
_span = f"{ts('START')} AS START_DATE, coalesce({ts('STOP')}, {OPEN}) AS END_DATE"
CTE["conditions_silver"] = f"SELECT {_links}, {_span}, {META} FROM conditions_raw"
CTE["medications_silver"] = f"""
SELECT {_links}, {_why}, {_span}, {META}, {LOADED} FROM medications_raw
WHERE {ts('STOP')} IS NULL OR {ts('STOP')} >= {ts('START')}"""
CTE["procedures_silver"] = f"SELECT {_links}, {_why}, {ts('DATE')} AS PROCEDURE_DATE, {META}, {LOADED} FROM procedures_raw"
CTE["immunizations_silver"] = f"SELECT {_links}, {ts('DATE')} AS IMMUNIZATION_DATE, {META}, {LOADED} FROM immunizations_raw"
CTE["allergies_silver"] = f"SELECT {_links}, {_span}, {META}, {LOADED} FROM allergies_raw"
CTE["careplans_silver"] = f"SELECT ID AS CAREPLAN_ID, {_links}, {_why}, {_span}, {META}, {LOADED} FROM careplans_raw"
_num = "regexp_full_match(VALUE, '[-+]?[0-9]*\\.?[0-9]+')"
CTE["values_split"] = f"""
SELECT {_links}, UNITS, {META}, {day('DATE')} AS OBSERVATION_DATE,
  CASE WHEN NOT {_num} THEN VALUE END AS VALUE_TEXT,
  CASE WHEN {_num} THEN TRY_CAST(VALUE AS DOUBLE) END AS VALUE_NUMERIC
FROM observations_raw"""
_hashed = ["CODE", "DESCRIPTION", "ENCOUNTER_ID", "OBSERVATION_DATE", "PATIENT_ID", "SOURCE_SYSTEM", "UNITS",
           "VALUE_NUMERIC", "VALUE_TEXT"]


def hash_of(*columns: str) -> str:
    texts = [f"CAST({c} AS VARCHAR)" for c in columns]
    return "md5(concat(" + ", ".join(f"coalesce(length({t}) || ':' || {t}, '~')" for t in texts) + "))"


_h = hash_of(*_hashed)
CTE["reading_numbers"] = f"""
SELECT *, row_number() OVER (
  PARTITION BY PATIENT_ID, ENCOUNTER_ID, CODE, OBSERVATION_DATE, VALUE_TEXT, VALUE_NUMERIC
  ORDER BY INGESTION_TIMESTAMP, {_h}) AS READING_SEQ
FROM values_split"""
CTE["observations_silver"] = "SELECT * FROM reading_numbers WHERE VALUE_TEXT IS NOT NULL OR VALUE_NUMERIC IS NOT NULL"

# --- gold --------------------------------------------------------------------------------
_base = "PATIENT_ID, ENCOUNTER_ID, OBSERVATION_DATE, READING_SEQ"
CTE["values_actual"] = "SELECT *, coalesce(CAST(VALUE_NUMERIC AS VARCHAR), VALUE_TEXT) AS ACTUAL_VALUE FROM values_split"
CTE["silver_actual"] = "SELECT *, coalesce(CAST(VALUE_NUMERIC AS VARCHAR), VALUE_TEXT) AS ACTUAL_VALUE FROM observations_silver"
_cells = ", ".join(f"min(ACTUAL_VALUE) FILTER (DESCRIPTION = '{m}') AS {q(m)}" for m in S.MEASUREMENTS)
_names = ", ".join(f"'{m}'" for m in S.MEASUREMENTS)
CTE["pivoted"] = f"SELECT {_base}, {_cells} FROM silver_actual WHERE DESCRIPTION IN ({_names}) GROUP BY {_base}"
CTE["bases"] = f"SELECT DISTINCT {_base} FROM observations_silver"
_filled = ", ".join(f"coalesce(p.{q(m)}, 'Not Recorded') AS {q(m)}" for m in S.MEASUREMENTS)
_same = " AND ".join(f"b.{c.strip()} IS NOT DISTINCT FROM p.{c.strip()}" for c in _base.split(","))
CTE["observations_gold"] = f"""
SELECT b.PATIENT_ID, b.ENCOUNTER_ID, b.OBSERVATION_DATE, b.READING_SEQ, {_filled}
FROM bases b LEFT JOIN pivoted p ON {_same}"""
CTE["patients_gold"] = """
SELECT PATIENT_ID, BIRTHDATE, DEATHDATE, MARITAL, RACE, ETHNICITY, GENDER, FULL_NAME FROM patients_silver"""
for _e in ("encounters", "conditions", "medications", "procedures", "immunizations", "allergies", "careplans"):
    _drop = "INGESTION_TIMESTAMP, SOURCE_SYSTEM"
    if _e not in ("encounters", "conditions"):
        _drop += ", SILVER_LOAD_TIMESTAMP"
    CTE[f"{_e}_gold"] = f"SELECT * EXCLUDE ({_drop}) FROM {_e}_silver"
for _e, _n in (("conditions", "ALL_CONDITIONS"), ("medications", "ALL_MEDICATIONS")):
    CTE[f"{_e}_listed"] = f"""
SELECT ENCOUNTER_ID, coalesce(string_agg(DESCRIPTION, ' | ' ORDER BY DESCRIPTION), '') AS {_n}
FROM {_e}_gold WHERE ENCOUNTER_ID IS NOT NULL GROUP BY ENCOUNTER_ID"""

# --- events ------------------------------------------------------------------------------
_types = ", ".join(f"'{t}'" for t in S.EVENT_TYPES)
_known = f"coalesce(event_type IN ({_types}), false)"


def field(name: str) -> str:
    return f"json_extract_string(pj, '$.{name}')"


def has(c: str) -> str:
    return f"coalesce(trim({c}) <> '', false)"


_rule = "CASE event_type " + " ".join(
    f"WHEN '{t}' THEN list_filter([" + ", ".join(f"CASE WHEN NOT {has(field(f))} THEN '{f}' END" for f in fields)
    + "], lambda x: x IS NOT NULL)"
    for t, fields in S.REQUIRED_FIELDS.items()
) + " ELSE [] END"
_value_ok = f"(event_type <> 'OBSERVATION' OR {field('VALUE_NUMERIC')} IS NOT NULL OR {field('VALUE_TEXT')} IS NOT NULL)"
CTE["events_json"] = "SELECT *, CASE WHEN json_valid(payload) THEN payload END AS pj FROM events_raw"
_event_hash = hash_of("patient_id", "event_type", "event_timestamp", "payload")


def _identified(source: str) -> str:
    return f"""
SELECT CASE WHEN {has('event_id')} THEN event_id ELSE {_event_hash} END AS event_id, patient_id, event_type,
  event_timestamp, payload, pj, coalesce({ts('event_timestamp')}, {NOW}) AS EVENT_TS
FROM {source}"""


CTE["events_named"] = _identified("events_json")


def _first(source: str) -> str:
    """The earliest event of each id."""
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY EVENT_TS, patient_id NULLS FIRST,
    event_type NULLS FIRST, event_timestamp NULLS FIRST, payload NULLS FIRST) AS rn FROM {source})
WHERE rn = 1"""


CTE["events_first"] = _first("events_named")


def _judged(source: str) -> str:
    return f"""
SELECT *, CASE WHEN NOT {_known} THEN 'unknown event_type' WHEN NOT {has('patient_id')} THEN 'patient_id is empty'
  WHEN len({_rule}) > 0 THEN 'missing required fields: ' || array_to_string({_rule}, ',')
  WHEN NOT {_value_ok} THEN 'observation needs VALUE_NUMERIC or VALUE_TEXT' END AS REASON
FROM {source}"""


CTE["events_judged"] = _judged("events_named")
# ids first, then the rules, then one of each id among the valid
CTE["events_good"] = _first("(SELECT * EXCLUDE (REASON) FROM events_judged WHERE REASON IS NULL)")
CTE["events_arrived_json"] = "SELECT *, CASE WHEN json_valid(payload) THEN payload END AS pj FROM events_arrived"
CTE["events_arrived_good"] = _first(
    f"(SELECT * EXCLUDE (REASON) FROM ({_judged('(' + _identified('events_arrived_json') + ')')}) WHERE REASON IS NULL)")


def _rt(event_type: str) -> str:
    defaults = S.DEFAULT_FIELDS[event_type]

    def value(name: str) -> str:
        return f"coalesce({field(name)}, '{defaults[name]}')" if name in defaults else field(name)

    columns = []
    for f in S.REALTIME_SCHEMAS[S.EVENT_TABLES[event_type]]:
        n = f.name
        if n == "EVENT_ID":
            x = "event_id"
        elif n == "PATIENT_ID":
            x = "patient_id"
        elif n == "EVENT_TS":
            x = "EVENT_TS"
        elif n == "INGESTION_TS":
            x = NOW
        elif n == "CAREPLAN_ID" or (n == "ENCOUNTER_ID" and event_type == "ENCOUNTER"):
            x = f"coalesce({field(n)}, event_id)"
        elif n == "OBSERVATION_DATE":
            x = day(value(n))
        elif n == "END_DATE":
            x = f"coalesce({ts(value(n))}, {OPEN})"
        elif n.endswith("_DATE"):
            x = ts(value(n))
        elif n == "VALUE_NUMERIC":
            x = f"TRY_CAST({value(n)} AS DOUBLE)"
        elif n == "READING_SEQ":
            x = f"coalesce(TRY_CAST({value(n)} AS INTEGER), 1)"
        else:
            x = value(n)
        columns.append(f"{x} AS {n}")
    return f"SELECT {', '.join(columns)} FROM events_good WHERE event_type = '{event_type}'"


for _t, _table in S.EVENT_TABLES.items():
    CTE[_table.lower()] = _rt(_t)
CTE["rt_common"] = " UNION ALL ".join(
    f"SELECT '{t}' AS TABLE_NAME, EVENT_ID, PATIENT_ID, ENCOUNTER_ID, DESCRIPTION, EVENT_TS, INGESTION_TS FROM {t.lower()}"
    for t in S.REALTIME_SCHEMAS
)
_table_of = "CASE event_type " + " ".join(f"WHEN '{t}' THEN '{n}'" for t, n in S.EVENT_TABLES.items()) + " END"
CTE["stored_ids"] = f"SELECT event_id AS EVENT_ID, {_table_of} AS TABLE_NAME FROM events_arrived_good"
CTE["published"] = f"SELECT event_id, event_type, {_table_of} AS TABLE_NAME FROM events_first"

# --- state -------------------------------------------------------------------------------
_interval = "CODE, DESCRIPTION, START_DATE, END_DATE"


def _both(hist: str, rt: str, columns: str) -> str:
    return (f"SELECT PATIENT_ID, {columns}, 'historical' AS SOURCE FROM {hist} UNION ALL "
            f"SELECT PATIENT_ID, {columns}, 'realtime' AS SOURCE FROM {rt}")


def _top(body: str, order: str, n: int) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY PATIENT_ID ORDER BY {order}) AS rn FROM ({body})) WHERE rn <= {n}"""


CTE["visits"] = _both("encounters_gold", "rt_encounters", "ENCOUNTER_ID, CODE, DESCRIPTION, REASONDESCRIPTION, ENCOUNTER_DATE")
CTE["conditions_both"] = _both("conditions_gold", "rt_conditions", _interval)
CTE["medications_both"] = _both("medications_gold", "rt_medications", "REASONDESCRIPTION, " + _interval)
CTE["allergies_both"] = _both("allergies_gold", "rt_allergies", _interval)
_visit_order = """ENCOUNTER_DATE DESC NULLS LAST, SOURCE, ENCOUNTER_ID NULLS FIRST, CODE NULLS FIRST,
  DESCRIPTION NULLS FIRST, REASONDESCRIPTION NULLS FIRST"""
_cols = ", ".join(q(m) for m in S.MEASUREMENTS)
CTE["readings_long"] = " UNION ALL ".join(
    [
        f"""SELECT PATIENT_ID, OBSERVATION_DATE, '{m}' AS DESCRIPTION, TRY_CAST({q(m)} AS DOUBLE) AS VALUE_NUMERIC,
  CASE WHEN TRY_CAST({q(m)} AS DOUBLE) IS NULL THEN {q(m)} END AS VALUE_TEXT, 'historical' AS SOURCE
FROM observations_gold WHERE {q(m)} <> 'Not Recorded'"""
        for m in S.MEASUREMENTS
    ]
    + ["SELECT PATIENT_ID, OBSERVATION_DATE, DESCRIPTION, VALUE_NUMERIC, VALUE_TEXT, 'realtime' AS SOURCE FROM rt_observations"]
)


def _line(table: str, kind: str, date: str, text: str, detail: str, source: str, link: str) -> str:
    return (f"SELECT PATIENT_ID, CAST({date} AS TIMESTAMP) AS EVENT_DATE, '{kind}' AS EVENT_TYPE, {text} AS DESCRIPTION, "
            f"{detail} AS DETAIL, '{source}' AS SOURCE, {link} AS ENCOUNTER_ID FROM {table} WHERE {date} IS NOT NULL")


def _timeline() -> str:
    why, code = "coalesce(REASONDESCRIPTION, '')", "coalesce(CODE, '')"
    spec = [
        ("encounters", "ENCOUNTER", "ENCOUNTER_DATE", why),
        ("conditions", "CONDITION", "START_DATE", code),
        ("medications", "MEDICATION", "START_DATE", why),
        ("procedures", "PROCEDURE", "PROCEDURE_DATE", why),
        ("immunizations", "IMMUNIZATION", "IMMUNIZATION_DATE", code),
        ("allergies", "ALLERGY", "START_DATE", code),
        ("careplans", "CAREPLAN", "START_DATE", why),
    ]
    lines = [
        _line("observations_gold", "OBSERVATION", "OBSERVATION_DATE", "'Vital Signs Reading'", "''", "historical", "ENCOUNTER_ID"),
        _line("rt_observations", "OBSERVATION", "OBSERVATION_DATE", "DESCRIPTION",
              "coalesce(CAST(VALUE_NUMERIC AS VARCHAR), VALUE_TEXT, '')", "realtime", "ENCOUNTER_ID"),
    ]
    for name, kind, date, detail in spec:
        link = "NULL" if kind in ("CONDITION", "MEDICATION") else "ENCOUNTER_ID"
        lines.append(_line(f"{name}_gold", kind, date, "DESCRIPTION", detail, "historical", link))
        lines.append(_line(f"rt_{name}", kind, date, "DESCRIPTION", detail, "realtime", "ENCOUNTER_ID"))
    return " UNION ALL ".join(lines)


_time_order = """EVENT_DATE DESC, EVENT_TYPE, SOURCE, DESCRIPTION NULLS LAST, DETAIL NULLS LAST, ENCOUNTER_ID NULLS LAST"""
CTE["timeline_all"] = _timeline()

# --- features ----------------------------------------------------------------------------
_gold_vitals = ", ".join(f"TRY_CAST({q(m)} AS DOUBLE) AS {f}" for f, m in S.VITAL_FEATURES.items())
_live_vitals = ", ".join(
    f"CASE WHEN upper(DESCRIPTION) = upper('{m}') THEN VALUE_NUMERIC END AS {f}" for f, m in S.VITAL_FEATURES.items()
)
CTE["vital_rows"] = f"""
SELECT PATIENT_ID, OBSERVATION_DATE AS D, {_gold_vitals} FROM observations_gold
UNION ALL SELECT PATIENT_ID, OBSERVATION_DATE AS D, {_live_vitals} FROM rt_observations"""
_avgs = ", ".join(f"avg({f}) AS {f}" for f in S.VITAL_FEATURES)
_flag = """CASE WHEN count(AVG_GLUCOSE) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS HAS_GLUCOSE_READING,
  CASE WHEN count(AVG_CHOLESTEROL) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS HAS_CHOLESTEROL_READING"""
CTE["vital_facts"] = f"SELECT PATIENT_ID, {_avgs}, CAST(count(*) AS DOUBLE) AS OBSERVATION_COUNT, {_flag} FROM vital_rows GROUP BY PATIENT_ID"
CTE["condition_codes"] = "SELECT PATIENT_ID, CODE, CAST(START_DATE AS DATE) AS D FROM conditions_both WHERE CODE IS NOT NULL"
CTE["medication_codes"] = "SELECT PATIENT_ID, CODE, CAST(START_DATE AS DATE) AS D FROM medications_both WHERE CODE IS NOT NULL"
CTE["code_counts"] = """
SELECT PATIENT_ID, CAST(sum(v) AS DOUBLE) AS TOTAL_ENCOUNTERS, CAST(sum(k) AS DOUBLE) AS DISTINCT_CONDITION_COUNT,
  CAST(sum(m) AS DOUBLE) AS DISTINCT_MEDICATION_COUNT FROM (
  SELECT PATIENT_ID, count(*) AS v, 0 AS k, 0 AS m FROM visits GROUP BY PATIENT_ID
  UNION ALL SELECT PATIENT_ID, 0, count(DISTINCT CODE), 0 FROM condition_codes GROUP BY PATIENT_ID
  UNION ALL SELECT PATIENT_ID, 0, 0, count(DISTINCT CODE) FROM medication_codes GROUP BY PATIENT_ID)
GROUP BY PATIENT_ID"""
_kinds = ", ".join(
    f"CASE WHEN {c} <> '' THEN {c} ELSE '{'UNKNOWN' if c == 'MARITAL' else 'unknown'}' END AS {c}"
    for c in S.CATEGORICAL_FEATURES
)


def _feature_row(age: str) -> str:
    numbers = []
    for f in S.NUMERIC_FEATURES:
        if f == "AGE_AT_INDEX":
            numbers.append(f"{age} AS AGE_AT_INDEX")
        elif f in S.COUNT_FEATURES or f in S.FLAG_FEATURES:
            numbers.append(f"coalesce({f}, 0.0::DOUBLE) AS {f}")
        else:
            numbers.append(f)
    return ", ".join(numbers) + ", " + _kinds


CTE["features_live"] = f"""
SELECT PATIENT_ID, {_feature_row(f"date_diff('day', BIRTHDATE, DATE '{AS_OF}') / 365.25::DOUBLE")}
FROM patients_gold LEFT JOIN vital_facts USING (PATIENT_ID) LEFT JOIN code_counts USING (PATIENT_ID)"""

# --- cohorts -----------------------------------------------------------------------------
CTE["index_dates"] = " UNION ALL ".join(
    f"""SELECT PATIENT_ID, '{t}' AS TARGET_NAME, min(CAST(START_DATE AS DATE)) AS INDEX_DATE FROM conditions_gold
WHERE DESCRIPTION LIKE '%{w}' AND START_DATE IS NOT NULL AND PATIENT_ID IS NOT NULL GROUP BY PATIENT_ID"""
    for t, w in TARGET_WORDS.items()
)


def _asof(dates: str, buffer_days: int = 0) -> str:
    limit = f"d.INDEX_DATE - INTERVAL {buffer_days} DAY"

    def before(table: str, what: str, date: str = "D") -> str:
        return f"""(SELECT d.PATIENT_ID, d.INDEX_DATE, {what} FROM d JOIN {table} x ON x.PATIENT_ID = d.PATIENT_ID
    AND CAST(x.{date} AS DATE) < {limit} GROUP BY 1, 2)"""

    vit = ", ".join(f"avg(x.{f}) AS {f}" for f in S.VITAL_FEATURES) + ", CAST(count(*) AS DOUBLE) AS OBSERVATION_COUNT, "
    vit += _flag.replace("AVG_", "x.AVG_")
    return f"""
WITH d AS (SELECT DISTINCT PATIENT_ID, INDEX_DATE FROM {dates})
SELECT PATIENT_ID, INDEX_DATE, {_feature_row("date_diff('day', BIRTHDATE, INDEX_DATE) / 365.25::DOUBLE")}
FROM d JOIN patients_gold USING (PATIENT_ID)
LEFT JOIN {before('vital_rows', vit)} USING (PATIENT_ID, INDEX_DATE)
LEFT JOIN {before('visits', 'CAST(count(*) AS DOUBLE) AS TOTAL_ENCOUNTERS', 'ENCOUNTER_DATE')} USING (PATIENT_ID, INDEX_DATE)
LEFT JOIN {before('condition_codes', 'CAST(count(DISTINCT x.CODE) AS DOUBLE) AS DISTINCT_CONDITION_COUNT')} USING (PATIENT_ID, INDEX_DATE)
LEFT JOIN {before('medication_codes', 'CAST(count(DISTINCT x.CODE) AS DOUBLE) AS DISTINCT_MEDICATION_COUNT')} USING (PATIENT_ID, INDEX_DATE)"""


_target_rows = ", ".join(f"('{t}')" for t in S.TARGETS)
_open_day = "DATE '9999-12-31'"
CTE["risk_line"] = f"""
SELECT *, row_number() OVER (PARTITION BY TARGET_NAME, STRATUM ORDER BY DAY, H, PATIENT_ID) AS POS,
  count(*) OVER (PARTITION BY TARGET_NAME, STRATUM) AS SIZE
FROM (SELECT p.PATIENT_ID, t.TARGET_NAME, GENDER || '|' || CAST(year(BIRTHDATE) // 10 AS VARCHAR) AS STRATUM, i.INDEX_DATE,
    least(coalesce(i.INDEX_DATE, {_open_day}), coalesce(p.DEATHDATE, {_open_day})) AS DAY,
    {hash_of('t.TARGET_NAME', 'p.PATIENT_ID')} AS H
  FROM patients_gold p CROSS JOIN (VALUES {_target_rows}) t(TARGET_NAME)
  LEFT JOIN index_dates i ON i.PATIENT_ID = p.PATIENT_ID AND i.TARGET_NAME = t.TARGET_NAME
  WHERE NOT {missing('GENDER')} AND BIRTHDATE IS NOT NULL)"""
CTE["risk_cases"] = """
SELECT c.TARGET_NAME, c.STRATUM, c.PATIENT_ID, c.INDEX_DATE, c.H, c.SIZE, count(k.PATIENT_ID) AS LAST
FROM risk_line c LEFT JOIN risk_line k ON k.TARGET_NAME = c.TARGET_NAME AND k.STRATUM = c.STRATUM AND k.DAY <= c.INDEX_DATE
WHERE c.INDEX_DATE IS NOT NULL GROUP BY ALL"""


def _controls(per_case: int) -> str:
    draws = ", ".join(f"({j})" for j in range(per_case))
    return f"""
SELECT c.TARGET_NAME, c.PATIENT_ID AS CASE_ID, k.PATIENT_ID AS CONTROL_ID, c.INDEX_DATE
FROM risk_cases c CROSS JOIN (VALUES {draws}) j(J)
JOIN risk_line k ON k.TARGET_NAME = c.TARGET_NAME AND k.STRATUM = c.STRATUM
  AND k.POS = c.LAST + 1 + (CAST('0x' || substr(c.H, 1, 8) AS BIGINT) + j.J) % (c.SIZE - c.LAST)
WHERE c.SIZE - c.LAST > j.J"""


CTE["controls"] = _controls(1)
CTE["labels"] = """
SELECT PATIENT_ID, TARGET_NAME, 1 AS LABEL, INDEX_DATE FROM index_dates WHERE PATIENT_ID IN (SELECT PATIENT_ID FROM patients_gold)
UNION ALL SELECT DISTINCT CONTROL_ID, TARGET_NAME, 0, INDEX_DATE FROM controls"""
CTE["features_before"] = _asof("labels")
CTE["long_table"] = f"""
SELECT PATIENT_ID, TARGET_NAME, LABEL, INDEX_DATE, {', '.join(S.FEATURES)}
FROM labels JOIN features_before USING (PATIENT_ID, INDEX_DATE)"""

# --- metrics -----------------------------------------------------------------------------
CTE["split_scores"] = f"""
SELECT * EXCLUDE (rn, n), CASE WHEN rn <= n * 0.2::DOUBLE THEN 'test' ELSE 'train' END AS SPLIT FROM (
  SELECT *, row_number() OVER (PARTITION BY TARGET_NAME, LABEL
    ORDER BY {hash_of('TARGET_NAME', 'ITEM_ID')}, ITEM_ID) AS rn,
    count(*) OVER (PARTITION BY TARGET_NAME, LABEL) AS n FROM scores)"""


def _curve(source: str, keys: str) -> str:
    return f"""
SELECT {keys}, PROBABILITY, POS, NEG,
  sum(POS) OVER (PARTITION BY {keys} ORDER BY PROBABILITY DESC) AS TP,
  sum(NEG) OVER (PARTITION BY {keys} ORDER BY PROBABILITY DESC) AS FP,
  sum(POS) OVER (PARTITION BY {keys}) AS P, sum(NEG) OVER (PARTITION BY {keys}) AS N
FROM (SELECT {keys}, PROBABILITY, count(*) FILTER (LABEL = 1) AS POS, count(*) FILTER (LABEL = 0) AS NEG
  FROM {source} GROUP BY {keys}, PROBABILITY)"""


CTE["curve"] = _curve("scores", "TARGET_NAME")
CTE["test_scores"] = "SELECT * FROM split_scores WHERE SPLIT = 'test'"
CTE["test_curve"] = _curve("test_scores", "TARGET_NAME")


def _points(curve: str) -> str:
    return f"""
SELECT *, 2.0::DOUBLE * "PRECISION" * RECALL / ("PRECISION" + RECALL + 1e-9::DOUBLE) AS F1 FROM (
  SELECT TARGET_NAME, PROBABILITY AS THRESHOLD, TP / (TP + FP) AS "PRECISION", TP / P AS RECALL FROM {curve})"""


CTE["curve_points"] = _points("curve")
CTE["test_points"] = _points("test_curve")
CTE["best"] = """
SELECT TARGET_NAME, THRESHOLD, F1 FROM (
  SELECT *, row_number() OVER (PARTITION BY TARGET_NAME ORDER BY F1 DESC, THRESHOLD) AS rn FROM test_points) WHERE rn = 1"""
CTE["lifts"] = """
SELECT TARGET_NAME, PR_AUC, PREVALENCE, CASE WHEN PREVALENCE > 0 THEN PR_AUC / PREVALENCE ELSE 0 END AS LIFT FROM (
  SELECT TARGET_NAME, coalesce(sum((R - R0) * TP / (TP + FP)), 0) AS PR_AUC, max(P) / (max(P) + max(N)) AS PREVALENCE
  FROM (SELECT *, TP / P AS R, coalesce(lag(TP / P) OVER (PARTITION BY TARGET_NAME ORDER BY PROBABILITY DESC), 0) AS R0 FROM curve)
  GROUP BY TARGET_NAME)"""


def _auc(source: str, keys: str) -> str:
    return f"""
SELECT {keys}, (sum(r) FILTER (LABEL = 1) - n1 * (n1 + 1) / 2) / (n1 * n0) AS ROC_AUC FROM (
  SELECT *, rank() OVER (PARTITION BY {keys} ORDER BY PROBABILITY)
      + (count(*) OVER (PARTITION BY {keys}, PROBABILITY) - 1) / 2 AS r,
    count(*) FILTER (LABEL = 1) OVER (PARTITION BY {keys}) AS n1,
    count(*) FILTER (LABEL = 0) OVER (PARTITION BY {keys}) AS n0 FROM {source})
GROUP BY {keys}, n1, n0"""


CTE["confusion"] = """
SELECT s.TARGET_NAME, count(*) FILTER (y = 1 AND LABEL = 1) AS TP, count(*) FILTER (y = 1 AND LABEL = 0) AS FP,
  count(*) FILTER (y = 0 AND LABEL = 1) AS FN, count(*) FILTER (y = 0 AND LABEL = 0) AS TN
FROM (SELECT s.*, CASE WHEN PROBABILITY >= THRESHOLD THEN 1 ELSE 0 END AS y FROM test_scores s JOIN best USING (TARGET_NAME)) s
GROUP BY s.TARGET_NAME"""
CTE["per_class"] = """
SELECT TARGET_NAME, '1' AS CLASS, CASE WHEN TP + FP > 0 THEN TP / (TP + FP) ELSE 0 END AS "PRECISION",
  CASE WHEN TP + FN > 0 THEN TP / (TP + FN) ELSE 0 END AS RECALL,
  CASE WHEN 2 * TP + FP + FN > 0 THEN 2 * TP / (2 * TP + FP + FN) ELSE 0 END AS F1, TP + FN AS SUPPORT FROM confusion
UNION ALL
SELECT TARGET_NAME, '0', CASE WHEN TN + FN > 0 THEN TN / (TN + FN) ELSE 0 END, CASE WHEN TN + FP > 0 THEN TN / (TN + FP) ELSE 0 END,
  CASE WHEN 2 * TN + FP + FN > 0 THEN 2 * TN / (2 * TN + FP + FN) ELSE 0 END, TN + FP FROM confusion"""
_report = """
SELECT * FROM per_class
UNION ALL SELECT TARGET_NAME, 'accuracy', NULL, NULL, (TP + TN) / (TP + TN + FP + FN), TP + TN + FP + FN FROM confusion
UNION ALL SELECT TARGET_NAME, 'macro avg', avg("PRECISION"), avg(RECALL), avg(F1), sum(SUPPORT) FROM per_class GROUP BY TARGET_NAME
UNION ALL SELECT TARGET_NAME, 'weighted avg', sum("PRECISION" * SUPPORT) / sum(SUPPORT), sum(RECALL * SUPPORT) / sum(SUPPORT),
  sum(F1 * SUPPORT) / sum(SUPPORT), sum(SUPPORT) FROM per_class GROUP BY TARGET_NAME"""

_WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def _needs(sql: str, seen: dict[str, None]) -> None:
    for word in _WORD.findall(sql):
        if word in CTE and word not in seen:
            _needs(CTE[word], seen)
            seen[word] = None


def full(body: str) -> str:
    """The body with the common table expressions it needs, in order."""
    used: dict[str, None] = {}
    _needs(body, used)
    parts = [f"{n} AS ({CTE[n]})" for n in used]
    return f"WITH {', '.join(parts)} {body}" if parts else body


_BODY: dict[str, str] = {}
# columns of each entity in Silver and Gold, as the definitions state them
WIDTH = {
    "patients": (18, 8), "encounters": (9, 7), "observations": (11, 11), "conditions": (8, 6), "medications": (11, 8),
    "procedures": (10, 7), "immunizations": (8, 5), "allergies": (9, 6), "careplans": (12, 9),
}

# --- sources, bronze, quality ------------------------------------------------------------
_present = " ".join(f"WHEN '{t}' THEN '{e}'" for e, t in ENTITY_TYPES.items() if e != "careplans")
_entities = ", ".join(f"('{e}')" for e in S.ENTITIES)
_BODY["manifest_missing"] = f"""
SELECT TABLE_NAME FROM (VALUES {_entities}) e(TABLE_NAME)
WHERE TABLE_NAME NOT IN (SELECT DISTINCT CASE p_type {_present} END FROM part WHERE p_type <> 'PROMO')"""
_BODY["layer_report"] = " UNION ALL ".join(
    f"SELECT '{e}_{layer}' AS TABLE_NAME, (SELECT count(*) FROM {table}) AS ROW_COUNT, "
    f"(SELECT {columns} FROM (SELECT 1) LEFT JOIN (SELECT * FROM {table} LIMIT 1) ON true) AS COLUMN_COUNT, 'OK' AS STATUS"
    for e in S.ENTITIES
    for layer, table, columns in (
        ("staging", f"{e}_raw", f"CAST({len(S.RAW_SCHEMAS[e])} AS BIGINT)"),
        ("bronze", f"{e}_raw", f"CAST({len(S.RAW_SCHEMAS[e]) + 2} AS BIGINT)"),
        ("silver", f"{e}_silver", f"CAST({WIDTH[e][0]} AS BIGINT)"),
        ("gold", f"{e}_gold", f"CAST({WIDTH[e][1]} AS BIGINT)"),
    )
)
_BODY["bronze_stamp"] = show(f"SELECT *, {META} FROM encounters_raw", times=("INGESTION_TIMESTAMP",))
for _e in S.ENTITIES:
    if _e != "encounters":
        _BODY[f"bronze_{_e}"] = show(f"SELECT *, {META} FROM {_e}_raw", times=("INGESTION_TIMESTAMP",))


def _profile(entity: str) -> str:
    columns = [*S.RAW_SCHEMAS[entity].names, "SOURCE_SYSTEM"]
    return " UNION ALL ".join(
        f"SELECT '{entity}' AS TABLE_NAME, '{c}' AS COLUMN_NAME, count(*) FILTER ({missing(c)}) AS MISSING, count(*) AS TOTAL "
        f"FROM (SELECT *, {META} FROM {entity}_raw)"
        for c in columns
    )


_profiles = " UNION ALL ".join(map(_profile, S.ENTITIES))
_BODY["null_profile"] = _profiles
_BODY["null_profile_pct"] = f"""
SELECT TABLE_NAME, COLUMN_NAME, MISSING, round(MISSING / TOTAL * 100, 6) AS MISSING_PCT FROM ({_profiles}) WHERE MISSING > 0"""
_BODY["merged_profile"] = " UNION ALL ".join(
    f"""SELECT '{e}' AS TABLE_NAME, '{c}' AS COLUMN_NAME, count(*) AS TOTAL,
  count(*) FILTER ({missing(c) if c != 'INGESTION_TIMESTAMP' else f'{c} IS NULL'}) AS MISSING, count(DISTINCT {c}) AS EXACT, true AS NEAR
FROM (SELECT *, {META} FROM {e}_raw)"""
    for e in S.ENTITIES for c in (*S.RAW_SCHEMAS[e].names, "SOURCE_SYSTEM", "INGESTION_TIMESTAMP"))
_BODY["key_uniqueness"] = " UNION ALL ".join(
    f"SELECT '{e}' AS TABLE_NAME, count(*) AS TOTAL_ROWS, count(DISTINCT ID) AS DISTINCT_KEYS FROM {e}_raw"
    for e in ("patients", "encounters", "careplans"))
_BODY["duplicate_rows"] = " UNION ALL ".join(
    f"""
SELECT '{e}' AS TABLE_NAME, t AS TOTAL_ROWS, d AS DISTINCT_ROWS, t - d AS DUPLICATE_ROWS
FROM (SELECT (SELECT count(*) FROM {e}_raw) AS t, (SELECT count(*) FROM (SELECT DISTINCT * FROM {e}_raw)) AS d)"""
    for e in S.ENTITIES)
_BODY["interval_anomalies"] = " UNION ALL ".join(
    f"SELECT '{e}' AS TABLE_NAME, count(*) AS TOTAL_ROWS, count(*) FILTER ({ts('STOP')} < {ts('START')}) AS ANOMALIES FROM {e}_raw"
    for e in ("conditions", "medications", "allergies", "careplans")
)

# --- silver ------------------------------------------------------------------------------
_BODY["placeholder_fill"] = f"SELECT ID, {_fill} FROM patients_raw"
_IN, _LD, _IV = "INGESTION_TIMESTAMP", "SILVER_LOAD_TIMESTAMP", ("START_DATE", "END_DATE")
_BODY["silver_patients"] = show("SELECT * FROM patients_silver", days=("BIRTHDATE", "DEATHDATE"), times=(_IN,))
_BODY["silver_encounters"] = show("SELECT * FROM encounters_silver", times=(_IN, "ENCOUNTER_DATE"))
_BODY["silver_conditions"] = show("SELECT * FROM conditions_silver", times=(_IN, *_IV))
_BODY["silver_medications"] = show("SELECT * FROM medications_silver", times=(_IN, _LD, *_IV))
_BODY["silver_observations"] = show("SELECT * FROM observations_silver", days=("OBSERVATION_DATE",), times=(_IN,),
                                    doubles=("VALUE_NUMERIC",), ints=("READING_SEQ",))
_BODY["silver_procedures"] = show("SELECT * FROM procedures_silver", times=(_IN, _LD, "PROCEDURE_DATE"))
_BODY["silver_immunizations"] = show("SELECT * FROM immunizations_silver", times=(_IN, _LD, "IMMUNIZATION_DATE"))
_BODY["silver_allergies"] = show("SELECT * FROM allergies_silver", times=(_IN, _LD, *_IV))
_BODY["silver_careplans"] = show("SELECT * FROM careplans_silver", times=(_IN, _LD, *_IV))
_BODY["reading_seq"] = show("SELECT * FROM reading_numbers", days=("OBSERVATION_DATE",), times=(_IN,),
                            doubles=("VALUE_NUMERIC",), ints=("READING_SEQ",))

# --- gold --------------------------------------------------------------------------------
_BODY["gold_patients"] = show("SELECT * FROM patients_gold", days=("BIRTHDATE", "DEATHDATE"))
_BODY["actual_value"] = show("SELECT * FROM values_actual", days=("OBSERVATION_DATE",), times=(_IN,), doubles=("VALUE_NUMERIC",))
_BODY["observations_pivot"] = show("SELECT * FROM pivoted", days=("OBSERVATION_DATE",), ints=("READING_SEQ",))
_BODY["reading_base"] = show("SELECT * FROM bases", days=("OBSERVATION_DATE",), ints=("READING_SEQ",))
_BODY["gold_observations"] = show("SELECT * FROM observations_gold", days=("OBSERVATION_DATE",), ints=("READING_SEQ",))
_BODY["conditions_per_encounter"] = "SELECT * FROM conditions_listed"
_BODY["medications_per_encounter"] = "SELECT * FROM medications_listed"
_BODY["obt_patient_encounters"] = show(
    """SELECT * EXCLUDE (ALL_CONDITIONS, ALL_MEDICATIONS), coalesce(ALL_CONDITIONS, 'No Conditions Recorded') AS ALL_CONDITIONS,
  coalesce(ALL_MEDICATIONS, 'No Medications Recorded') AS ALL_MEDICATIONS
FROM encounters_gold LEFT JOIN patients_gold USING (PATIENT_ID) LEFT JOIN observations_gold USING (PATIENT_ID, ENCOUNTER_ID)
LEFT JOIN conditions_listed USING (ENCOUNTER_ID) LEFT JOIN medications_listed USING (ENCOUNTER_ID)""",
    days=("BIRTHDATE", "DEATHDATE", "OBSERVATION_DATE"), times=("ENCOUNTER_DATE",), ints=("READING_SEQ",))

# --- events ------------------------------------------------------------------------------
_BODY["event_type_filter"] = f"SELECT event_id, event_type FROM events_raw WHERE event_type IN ({_types})"
_BODY["invalid_patient_events"] = f"SELECT event_id, patient_id FROM events_raw WHERE NOT {has('patient_id')}"
_BODY["missing_required_fields"] = f"""
SELECT event_id, event_type, array_to_string(m, ',') AS MISSING_FIELDS
FROM (SELECT *, {_rule} AS m FROM events_json WHERE event_type IN ({_types})) WHERE len(m) > 0"""
_BODY["observation_value_rule"] = f"SELECT event_id, {_value_ok} AS VALUE_OK FROM events_json WHERE event_type = 'OBSERVATION'"


def _default_of(name: str) -> str:
    if name == "CAREPLAN_ID":
        return f"coalesce({field(name)}, CASE WHEN event_type = 'CAREPLAN' THEN event_id END)"
    given = {t: d[name] for t, d in S.DEFAULT_FIELDS.items() if name in d}
    if not given:
        return field(name)
    return f"coalesce({field(name)}, CASE event_type " + " ".join(f"WHEN '{t}' THEN '{v}'" for t, v in given.items()) + " END)"


_BODY["event_defaults"] = f"""
SELECT event_id, event_type, {', '.join(f'{_default_of(f)} AS {f}' for f in S.PAYLOAD_FIELDS)}
FROM events_json WHERE event_type IN ({_types})"""
_BODY["event_identity"] = show("SELECT event_id, event_type, EVENT_TS FROM events_named", times=("EVENT_TS",))
_BODY["event_quarantine"] = "SELECT event_id, event_type, REASON FROM events_judged WHERE REASON IS NOT NULL"
_report_rows = [
    f"SELECT event_id, 'Event ID' AS LABEL, {has('event_id')} AS OK, event_id AS DETAIL FROM events_json",
    f"SELECT event_id, 'Patient ID', {has('patient_id')}, CASE WHEN patient_id <> '' THEN patient_id ELSE '—' END FROM events_json",
    f"SELECT event_id, 'Event Type', {_known}, event_type FROM events_json",
    f"""SELECT event_id, 'Timestamp', {has('event_timestamp')},
  CASE WHEN {has('event_timestamp')} THEN event_timestamp ELSE '—' END FROM events_json""",
]
for _t, _fields in S.REQUIRED_FIELDS.items():
    for _f in _fields:
        _report_rows.append(
            f"""SELECT event_id, 'payload.{_f}', {has(field(_f))},
  CASE WHEN {field(_f)} <> '' THEN {field(_f)} ELSE 'missing' END FROM events_json WHERE event_type = '{_t}'""")
_report_rows.append(
    f"""SELECT event_id, 'At least one value', {_value_ok},
  CASE WHEN {_value_ok} THEN 'VALUE_NUMERIC or VALUE_TEXT present' ELSE 'both null' END FROM events_json WHERE event_type = 'OBSERVATION'""")
_BODY["validation_report"] = " UNION ALL ".join(_report_rows)
_BODY["envelope_roundtrip"] = f"""
SELECT event_id, patient_id, event_type, event_timestamp, {field('CODE')} AS CODE, {field('DESCRIPTION')} AS DESCRIPTION
FROM events_judged WHERE REASON IS NULL"""
_BODY["make_observation_events"] = show(
    f"""SELECT PATIENT_ID AS patient_id, 'OBSERVATION' AS event_type, '{AS_OF}T00:00:00Z' AS event_timestamp, DESCRIPTION, OBSERVATION_DATE, VALUE_NUMERIC, VALUE_TEXT,
  ENCOUNTER_ID FROM observations_silver""", days=("OBSERVATION_DATE",), doubles=("VALUE_NUMERIC",))
_payload_as_sent = ", ".join(f"{field(f)} AS {f}" for f in S.PAYLOAD_FIELDS)
_BODY["event_envelope_json"] = f"""
SELECT patient_id AS key, event_id, patient_id, event_type, event_timestamp, {_payload_as_sent}
FROM events_judged WHERE REASON IS NULL"""
_BODY["published_events"] = f"""
SELECT patient_id AS key, event_id, patient_id, event_type, event_timestamp, {', '.join(f'{_default_of(f)} AS {f}' for f in S.PAYLOAD_FIELDS)}
FROM events_judged WHERE REASON IS NULL"""
_BODY["stream_envelope"] = "SELECT event_id, patient_id, event_type, event_timestamp, payload FROM events_raw"
_BODY["stream_guard"] = f"""
SELECT event_id, patient_id, event_type FROM events_raw
WHERE event_type IN ({_types}) AND patient_id IS NOT NULL AND event_id IS NOT NULL"""
for _t, _schema in S.REALTIME_SCHEMAS.items():
    _kinds_of = {f.name: f.dataType.typeName() for f in _schema}
    _BODY[_t.lower()] = show(
        f"SELECT * FROM {_t.lower()}",
        days=tuple(n for n, k in _kinds_of.items() if k == "date"),
        times=tuple(n for n, k in _kinds_of.items() if k == "timestamp"),
        doubles=tuple(n for n, k in _kinds_of.items() if k == "double"),
        ints=tuple(n for n, k in _kinds_of.items() if k == "integer"),
    )
_BODY["direct_append_events"] = show("SELECT * FROM rt_common", times=("EVENT_TS", "INGESTION_TS"))
_BODY["route_counts"] = f"""
SELECT event_type, {_table_of} AS TABLE_NAME, count(*) AS ROW_COUNT FROM events_good GROUP BY event_type"""
_hit = "EXISTS (SELECT 1 FROM stored_ids s WHERE s.EVENT_ID = p.event_id AND s.TABLE_NAME = p.TABLE_NAME)"
_BODY["persisted_events"] = f"SELECT * FROM published p WHERE {_hit}"
_BODY["pending_events"] = f"SELECT * FROM published p WHERE NOT {_hit}"
_BODY["confirmed_events"] = show(
    """SELECT p.event_id, p.event_type, p.EVENT_TS AS PUBLISHED_TS, s.STORED_TS,
  CASE WHEN s.STORED_TS IS NULL THEN 'TIMED_OUT' ELSE 'CONFIRMED' END AS STATUS
FROM events_good p LEFT JOIN (
  SELECT event_id, event_type, EVENT_TS + to_seconds(CAST(length(payload) % 60 AS BIGINT)) AS STORED_TS FROM events_arrived_good) s
ON s.event_id = p.event_id AND s.event_type = p.event_type AND s.STORED_TS >= p.EVENT_TS
  AND s.STORED_TS <= p.EVENT_TS + INTERVAL 30 SECOND""", times=("PUBLISHED_TS", "STORED_TS"))
_BODY["dedup_events"] = "SELECT event_id, patient_id, event_type, event_timestamp FROM events_first"
_BODY["events_per_window"] = show(
    """SELECT CAST(date_trunc('day', EVENT_TS) AS TIMESTAMP) AS WINDOW_START, event_type, count(*) AS EVENT_COUNT
FROM events_good GROUP BY 1, 2""", times=("WINDOW_START",))

# --- state -------------------------------------------------------------------------------
_PD = ("BIRTHDATE", "DEATHDATE")
_BODY["patient_by_id"] = show("SELECT * FROM patients_gold WHERE PATIENT_ID = '17' LIMIT 1", days=_PD)
_BODY["patients_by_name"] = show(
    "SELECT * FROM patients_gold WHERE contains(upper(FULL_NAME), 'MER 00000000') ORDER BY FULL_NAME, PATIENT_ID LIMIT 50", days=_PD)
_BODY["patients_by_name_index"] = _BODY["patients_by_name"]
_BODY["patient_info"] = show(
    "SELECT PATIENT_ID, BIRTHDATE, DEATHDATE, MARITAL, RACE, ETHNICITY, GENDER, FULL_NAME FROM patients_gold", days=_PD)
_BODY["patient_status"] = """
SELECT PATIENT_ID, CASE WHEN DEATHDATE IS NULL OR DEATHDATE = DATE '9999-12-31' THEN 'Alive'
  ELSE strftime(DEATHDATE, '%Y-%m-%d') END AS STATUS FROM patients_gold"""
_BODY["encounters_state"] = show(_top("SELECT * FROM visits", _visit_order, 20), times=("ENCOUNTER_DATE",))


def _placed(table: str, date: str, rest: tuple[str, ...]) -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in rest)
    return (f"SELECT *, row_number() OVER (PARTITION BY PATIENT_ID ORDER BY {date} DESC NULLS LAST, {order}) AS POSITION "
            f"FROM ({table})")


for _e, _rest in (("conditions", ("CODE", "DESCRIPTION", "END_DATE", "SOURCE")),
                  ("medications", ("REASONDESCRIPTION", "CODE", "DESCRIPTION", "END_DATE", "SOURCE")),
                  ("allergies", ("CODE", "DESCRIPTION", "END_DATE", "SOURCE"))):
    _BODY[f"{_e}_state"] = show(_placed(f"SELECT * FROM {_e}_both", "START_DATE", _rest), times=_IV)
_BODY["latest_obs_hist"] = show(
    "SELECT * EXCLUDE (ENCOUNTER_ID, READING_SEQ), 'historical' AS SOURCE FROM ("
    + _top("SELECT * FROM observations_gold", "OBSERVATION_DATE DESC NULLS LAST, ENCOUNTER_ID NULLS LAST, READING_SEQ", 10)
    + ")", days=("OBSERVATION_DATE",))
_BODY["latest_obs_rt"] = show(
    _placed("""SELECT PATIENT_ID, OBSERVATION_DATE, DESCRIPTION, VALUE_NUMERIC, VALUE_TEXT, 'realtime' AS SOURCE
FROM rt_observations""", "OBSERVATION_DATE", ("DESCRIPTION", "VALUE_NUMERIC", "VALUE_TEXT", "SOURCE")),
    days=("OBSERVATION_DATE",), doubles=("VALUE_NUMERIC",))
_BODY["observations_long"] = show("SELECT * FROM readings_long", days=("OBSERVATION_DATE",), doubles=("VALUE_NUMERIC",))
_asked = "(SELECT DISTINCT CAST(user_id * 11 AS VARCHAR) AS PATIENT_ID FROM events)"
_BODY["known_patients"] = f"SELECT PATIENT_ID FROM {_asked} WHERE PATIENT_ID IN (SELECT PATIENT_ID FROM patients_gold)"
_BODY["unknown_patients"] = f"SELECT PATIENT_ID FROM {_asked} WHERE PATIENT_ID NOT IN (SELECT PATIENT_ID FROM patients_gold)"
_BODY["clinical_timeline"] = show(_top("SELECT * FROM timeline_all", _time_order, 200), times=("EVENT_DATE",))
_BODY["timeline_filtered"] = show(
    "SELECT * FROM timeline_all WHERE SOURCE = 'realtime' AND EVENT_TYPE IN ('ENCOUNTER', 'OBSERVATION', 'MEDICATION')",
    times=("EVENT_DATE",))
_BODY["timeline_day_breaks"] = show(
    """SELECT * EXCLUDE (rn) FROM (
  SELECT *, CAST(EVENT_DATE AS DATE) AS DAY, count(*) OVER (PARTITION BY PATIENT_ID, CAST(EVENT_DATE AS DATE)) AS EVENTS,
    row_number() OVER (PARTITION BY PATIENT_ID, CAST(EVENT_DATE AS DATE) ORDER BY """ + _time_order + """) AS rn
  FROM timeline_all) WHERE rn = 1""", days=("DAY",), times=("EVENT_DATE",))
_BODY["timeline_counts"] = """
SELECT PATIENT_ID, count(*) AS TOTAL, count(*) FILTER (SOURCE = 'historical') AS HISTORICAL,
  count(*) FILTER (SOURCE = 'realtime') AS REALTIME FROM timeline_all GROUP BY PATIENT_ID"""


def _pair(name: str, body: str) -> str:
    hist = "count(*) FILTER (SOURCE = 'historical')"
    return (f"LEFT JOIN (SELECT PATIENT_ID, {hist} AS {name}_HIST, count(*) FILTER (SOURCE = 'realtime') AS {name}_RT "
            f"FROM ({body}) GROUP BY PATIENT_ID) USING (PATIENT_ID)")


_sides = [f"{n}_{s}" for n in ("ENCOUNTERS", "CONDITIONS", "MEDICATIONS", "OBSERVATIONS") for s in ("HIST", "RT")]
_BODY["patient_360"] = f"""
SELECT PATIENT_ID, {', '.join(f'coalesce({c}, 0) AS {c}' for c in _sides)},
  {', '.join(f"coalesce({n}_HIST, 0) + coalesce({n}_RT, 0) AS {n}_TOTAL" for n in ("ENCOUNTERS", "CONDITIONS", "MEDICATIONS", "OBSERVATIONS"))}
FROM patients_gold
{_pair('ENCOUNTERS', 'SELECT * FROM visits')}
{_pair('CONDITIONS', 'SELECT * FROM conditions_both')}
{_pair('MEDICATIONS', 'SELECT * FROM medications_both')}
{_pair('OBSERVATIONS', "SELECT PATIENT_ID, 'historical' AS SOURCE FROM observations_gold UNION ALL SELECT PATIENT_ID, 'realtime' FROM rt_observations")}"""

# --- features ----------------------------------------------------------------------------
_NF = tuple(S.NUMERIC_FEATURES)
_BODY["vital_averages"] = show(
    f"SELECT PATIENT_ID, {', '.join(S.VITAL_FEATURES)} FROM vital_facts", doubles=tuple(S.VITAL_FEATURES))
_BODY["reading_flags"] = "SELECT PATIENT_ID, HAS_GLUCOSE_READING, HAS_CHOLESTEROL_READING FROM vital_facts"
_age = f"date_diff('day', BIRTHDATE, DATE '{AS_OF}') / 365.25::DOUBLE"
_BODY["age_at_index"] = show(f"SELECT PATIENT_ID, {_age} AS AGE_AT_INDEX FROM patients_gold", doubles=("AGE_AT_INDEX",))
_BODY["activity_counts"] = """
SELECT PATIENT_ID, coalesce(OBSERVATION_COUNT, 0) AS OBSERVATION_COUNT, coalesce(DISTINCT_CONDITION_COUNT, 0) AS DISTINCT_CONDITION_COUNT,
  coalesce(DISTINCT_MEDICATION_COUNT, 0) AS DISTINCT_MEDICATION_COUNT, coalesce(TOTAL_ENCOUNTERS, 0) AS TOTAL_ENCOUNTERS
FROM vital_facts FULL JOIN code_counts USING (PATIENT_ID)"""
_BODY["patient_features"] = show("SELECT * FROM features_live", doubles=_NF)
_BODY["incremental_features"] = _BODY["patient_features"]
_BODY["age_safety"] = show(
    f"""SELECT PATIENT_ID, CASE WHEN a > 200 THEN a / 365.25::DOUBLE ELSE a END AS AGE_AT_INDEX FROM (
  SELECT PATIENT_ID, CASE WHEN CAST(PATIENT_ID AS BIGINT) % 2 = 0 THEN {_age} * 365.25::DOUBLE ELSE {_age} END AS a FROM patients_gold)""",
    doubles=("AGE_AT_INDEX",))
_BODY["feature_contract"] = show(
    "SELECT * REPLACE (NULL::DOUBLE AS AVG_GLUCOSE, 'unknown' AS RACE) FROM features_live", doubles=_NF)
_BODY["features_ablated"] = show(
    f"SELECT * EXCLUDE ({', '.join(S.COUNT_FEATURES)}) FROM features_live", doubles=tuple(S.ABLATED_NUMERIC_FEATURES))
_BODY["features_long"] = " UNION ALL ".join(
    [f"SELECT PATIENT_ID, '{f}' AS FEATURE, CAST(round({f}, 4) AS VARCHAR) AS VALUE FROM features_live" for f in S.NUMERIC_FEATURES]
    + [f"SELECT PATIENT_ID, '{f}', {f} FROM features_live" for f in S.CATEGORICAL_FEATURES])

# --- cohorts -----------------------------------------------------------------------------
_BODY["index_dates"] = show("SELECT * FROM index_dates", days=("INDEX_DATE",))
_BODY["features_asof"] = show(_asof("index_dates"), days=("INDEX_DATE",), doubles=_NF)
_BODY["features_buffered"] = show(_asof("index_dates", 180), days=("INDEX_DATE",), doubles=_NF)
_BODY["matched_controls"] = show(_controls(2), days=("INDEX_DATE",))
_BODY["features_targets_long"] = show("SELECT * FROM long_table", days=("INDEX_DATE",), doubles=_NF, ints=("LABEL",))
_BODY["features_for_target"] = show(
    "SELECT * FROM long_table WHERE TARGET_NAME = 'Stroke'", days=("INDEX_DATE",), doubles=_NF, ints=("LABEL",))

# --- metrics -----------------------------------------------------------------------------
_BODY["class_guard"] = """
SELECT TARGET_NAME, count(*) AS ROW_COUNT, count(DISTINCT LABEL) > 1 AS TRAINABLE FROM scores GROUP BY TARGET_NAME"""
_BODY["stratified_split"] = show("SELECT ITEM_ID, TARGET_NAME, LABEL, SPLIT FROM split_scores", ints=("LABEL",))
_BODY["class_weights"] = """
SELECT TARGET_NAME, count(*) FILTER (LABEL = 0) AS N_NEG, count(*) FILTER (LABEL = 1) AS N_POS,
  round(count(*) FILTER (LABEL = 0) / count(*) FILTER (LABEL = 1), 6) AS POSITIVE_WEIGHT
FROM split_scores WHERE SPLIT = 'train' GROUP BY TARGET_NAME"""
_BODY["pr_curve"] = show("SELECT * FROM curve_points", doubles=("THRESHOLD", "PRECISION", "RECALL", "F1"))
_BODY["optimal_threshold"] = show("SELECT * FROM best", doubles=("THRESHOLD", "F1"))
_BODY["accuracy_at_threshold"] = show(
    """SELECT TARGET_NAME, SPLIT, avg(CASE WHEN (PROBABILITY >= THRESHOLD) = (LABEL = 1) THEN 1.0::DOUBLE ELSE 0 END) AS ACCURACY
FROM split_scores JOIN best USING (TARGET_NAME) GROUP BY TARGET_NAME, SPLIT""", doubles=("ACCURACY",))
_BODY["roc_auc"] = show(_auc("split_scores", "TARGET_NAME, SPLIT"), doubles=("ROC_AUC",))
_BODY["average_precision_lift"] = show("SELECT * FROM lifts", doubles=("PR_AUC", "PREVALENCE", "LIFT"))
_BODY["classification_report"] = show(_report, doubles=("PRECISION", "RECALL", "F1"), ints=("SUPPORT",))
_row_key = "concat_ws('|', PATIENT_ID, strftime(INDEX_DATE, '%Y-%m-%d'), CAST(LABEL AS VARCHAR))"
_age_rule = "CASE WHEN AGE_AT_INDEX > 200 THEN AGE_AT_INDEX / 365.25::DOUBLE ELSE AGE_AT_INDEX END AS AGE_AT_INDEX"
CTE["long_split"] = f"""
SELECT * EXCLUDE (rn, n) REPLACE ({_age_rule}), CASE WHEN rn <= n * 0.2::DOUBLE THEN 'test' ELSE 'train' END AS SPLIT FROM (
  SELECT *, row_number() OVER (PARTITION BY TARGET_NAME, LABEL ORDER BY {hash_of('TARGET_NAME', 'ROW_ID')}, ROW_ID) AS rn,
    count(*) OVER (PARTITION BY TARGET_NAME, LABEL) AS n FROM (SELECT *, {_row_key} AS ROW_ID FROM long_table))"""
_meds = ", ".join(f"median({f}) AS {f}" for f in S.NUMERIC_FEATURES)
_fills = ", ".join(f"coalesce(r.{f}, m.{f}) AS {f}" for f in S.NUMERIC_FEATURES)
_BODY["median_impute"] = show(
    f"""SELECT r.PATIENT_ID, r.TARGET_NAME, r.INDEX_DATE, r.LABEL, r.SPLIT, {_fills} FROM long_split r LEFT JOIN (
  SELECT TARGET_NAME, {_meds} FROM long_split WHERE SPLIT = 'train' GROUP BY TARGET_NAME) m ON m.TARGET_NAME = r.TARGET_NAME""",
    days=("INDEX_DATE",), doubles=_NF, ints=("LABEL",))
_BODY["onehot"] = " UNION ALL ".join(
    f"""SELECT t.TARGET_NAME, PATIENT_ID, '{c}_' || CASE WHEN known.V IS NOT NULL THEN {c} ELSE 'OTHER' END AS FEATURE
FROM features_live CROSS JOIN (SELECT DISTINCT TARGET_NAME FROM long_split WHERE SPLIT = 'train') t
LEFT JOIN (SELECT DISTINCT TARGET_NAME, {c} AS V FROM long_split WHERE SPLIT = 'train') known
  ON known.TARGET_NAME = t.TARGET_NAME AND known.V = {c}"""
    for c in S.CATEGORICAL_FEATURES)

# --- risk --------------------------------------------------------------------------------
_BODY["train_score_rows"] = show(
    """SELECT PATIENT_ID, TARGET_NAME, INDEX_DATE, LABEL, SPLIT, true AS IN_RANGE FROM long_split
WHERE TARGET_NAME IN (SELECT TARGET_NAME FROM long_split WHERE SPLIT = 'train' GROUP BY TARGET_NAME HAVING count(DISTINCT LABEL) = 2)""",
    days=("INDEX_DATE",), ints=("LABEL",))
_BODY["risk_scores_rows"] = f"""
SELECT PATIENT_ID, t.TARGET_NAME, t.TARGET_NAME IN (
  SELECT TARGET_NAME FROM long_split WHERE SPLIT = 'train' GROUP BY TARGET_NAME HAVING count(DISTINCT LABEL) = 2) AS IN_RANGE
FROM features_live CROSS JOIN (VALUES {_target_rows}) t(TARGET_NAME)"""
_trainable = """SELECT TARGET_NAME FROM long_split WHERE SPLIT = 'train' GROUP BY TARGET_NAME HAVING count(DISTINCT LABEL) = 2"""
_sets = (("Full Features", S.NUMERIC_FEATURES), ("Ablated Features", S.ABLATED_NUMERIC_FEATURES))
_values = " + ".join(f"count(DISTINCT {c})" for c in S.CATEGORICAL_FEATURES)
_BODY["importance_rows"] = " UNION ALL ".join(
    f"""SELECT TARGET_NAME, '{name}' AS FEATURE_SET, {len(columns)} + {_values} AS FEATURES, true AS SHARES
FROM long_split WHERE SPLIT = 'train' AND TARGET_NAME IN ({_trainable}) GROUP BY TARGET_NAME""" for name, columns in _sets)
_BODY["comparison_rows"] = " UNION ALL ".join(
    f"SELECT TARGET_NAME, '{name}' AS FEATURE_SET, 'GBT' AS MODEL, true AS IN_RANGE FROM ({_trainable})" for name, _ in _sets)
_records = " UNION ALL ".join(
    f"""SELECT TARGET_NAME, 'GBT_{name.replace(' ', '')}_' || TARGET_NAME AS MODEL_NAME, 'GBT' AS MODEL_TYPE, '{name}' AS FEATURE_SET,
  '{','.join(columns)}' AS NUMERIC_FEATURES, '{','.join(S.CATEGORICAL_FEATURES)}' AS CATEGORICAL_FEATURES,
  'GBT model predicting ' || TARGET_NAME || ' using {name.lower()}.' AS DESCRIPTION FROM ({_trainable})""" for name, columns in _sets)
_BODY["registry_keys"] = f"""
SELECT t.TARGET_NAME, r.* EXCLUDE (TARGET_NAME), MODEL_NAME IS NOT NULL AS AVAILABLE, MODEL_NAME IS NOT NULL AS IN_RANGE
FROM (SELECT TARGET_NAME FROM (VALUES {_target_rows}) v(TARGET_NAME) UNION ALL SELECT 'Untrained') t
LEFT JOIN ({_records}) r ON r.TARGET_NAME = t.TARGET_NAME"""
_BODY["model_registry"] = show(
    f"""SELECT t.TARGET_NAME, MODEL_NAME, MODEL_TYPE, FEATURE_SET, NUMERIC_FEATURES, CATEGORICAL_FEATURES, DESCRIPTION,
  ROC_AUC, PR_AUC, PREVALENCE, LIFT, MODEL_NAME IS NOT NULL AS AVAILABLE
FROM (SELECT DISTINCT TARGET_NAME FROM scores UNION ALL SELECT 'Untrained') t LEFT JOIN (
  SELECT TARGET_NAME, 'GBT_FullFeatures_' || TARGET_NAME AS MODEL_NAME, 'GBT' AS MODEL_TYPE, 'Full Features' AS FEATURE_SET,
    '{','.join(S.NUMERIC_FEATURES)}' AS NUMERIC_FEATURES, '{','.join(S.CATEGORICAL_FEATURES)}' AS CATEGORICAL_FEATURES,
    'GBT model predicting ' || TARGET_NAME || ' using full features.' AS DESCRIPTION, ROC_AUC, PR_AUC, PREVALENCE, LIFT
  FROM lifts JOIN ({_auc('scores', 'TARGET_NAME')}) USING (TARGET_NAME)) r
ON r.TARGET_NAME = t.TARGET_NAME""", doubles=("ROC_AUC", "PR_AUC", "PREVALENCE", "LIFT"))


def _percent(x: str) -> str:
    # to the nearest tenth by binary value, ties to even; the side of a tie from two exact parts
    v = f"abs({x} * 100)"
    f = f"({v} - floor({v}))"
    hi = f"(floor({f} * 67108864) / 67108864)"
    k = f"floor({f} * 10)"
    over = f"(({hi} * 10 - ({k} + 0.5::DOUBLE)) + ({f} - {hi}) * 10)"
    up = f"CASE WHEN {over} > 0 OR ({over} = 0 AND {k} % 2 = 1) THEN 1 ELSE 0 END"
    return f"sign({x}) * (floor({v}) * 10 + {k} + {up}) / 10"


def _tier(none: str, high: str, middle: str, low: str) -> str:
    return (f"CASE WHEN PROBABILITY IS NULL THEN '{none}' WHEN PROBABILITY >= 0.7 THEN '{high}' "
            f"WHEN PROBABILITY >= 0.4 THEN '{middle}' ELSE '{low}' END")


_BODY["risk_tiers"] = show(
    f"""SELECT PATIENT_ID, TARGET_NAME, PROBABILITY, {_tier('unavailable', 'high', 'moderate', 'low')} AS TIER,
  {_tier('Model Unavailable', '🔴 High Risk', '🟡 Moderate Risk', '🟢 Low Risk')} AS LABEL,
  {_tier('gray', 'red', 'orange', 'green')} AS COLOR, {_percent('PROBABILITY')} AS PCT,
  CASE WHEN PROBABILITY IS NOT NULL THEN greatest(0.0::DOUBLE, least(100.0::DOUBLE, {_percent('PROBABILITY')})) END AS BAR
FROM risk_before""", doubles=("PROBABILITY",))
_BODY["models_found_missing"] = """
SELECT PATIENT_ID, coalesce(string_agg(TARGET_NAME, ', ' ORDER BY TARGET_NAME) FILTER (PROBABILITY IS NOT NULL), '') AS MODELS_FOUND,
  coalesce(string_agg(TARGET_NAME, ', ' ORDER BY TARGET_NAME) FILTER (PROBABILITY IS NULL), '') AS MODELS_MISSING
FROM risk_before GROUP BY PATIENT_ID"""
_BODY["risk_delta"] = f"""
SELECT PATIENT_ID, TARGET_NAME, {_percent('b')} AS BEFORE_PCT, {_percent('a')} AS AFTER_PCT, round(d, 6) AS DELTA,
  CASE WHEN d > 0.005 THEN '▲' WHEN d < -0.005 THEN '▼' ELSE '—' END AS DIRECTION,
  CASE WHEN d IS NULL THEN '—' WHEN d > 0.005 THEN '+' || CAST({_percent('d')} AS VARCHAR) || '%'
    WHEN d < -0.005 THEN CAST({_percent('d')} AS VARCHAR) || '%' ELSE 'No change' END AS CHANGE
FROM (SELECT coalesce(x.PATIENT_ID, y.PATIENT_ID) AS PATIENT_ID, coalesce(x.TARGET_NAME, y.TARGET_NAME) AS TARGET_NAME,
    x.PROBABILITY AS b, y.PROBABILITY AS a, y.PROBABILITY - x.PROBABILITY AS d
  FROM risk_before x FULL JOIN risk_after y ON x.PATIENT_ID = y.PATIENT_ID AND x.TARGET_NAME = y.TARGET_NAME)"""

ORACLE: dict[str, str] = {name: full(body) for name, body in _BODY.items()}
