"""Rules of cleaning, pivoting, events, state, features and risk on hand-made rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from vitalflow import schemas as S
from vitalflow.functions import is_missing, parse_date, parse_number, parse_timestamp
from vitalflow.operators import events, features, quality, risk, silver, state
from vitalflow.operators import gold as G

AS_OF = "2026-09-01"


def strings(spark, names, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))


# --- cleaning -------------------------------------------------------------------
def test_missing_and_parsing(spark):
    df = strings(spark, ["a"], [(None,), ("NULL",), ("",), ("false",), ("x",)])
    plain = [r[0] for r in df.select(is_missing("a")).collect()]
    extra = [r[0] for r in df.select(is_missing("a", ["false"])).collect()]
    assert plain == [True, True, True, False, False] and extra == [True, True, True, True, False]
    bad = strings(spark, ["a"], [("12a",), ("2017-05-24T10:00:00Z",), ("soon",)])
    got = bad.select(parse_number("a"), parse_date("a"), parse_timestamp("a")).collect()
    assert got[0][0] is None and got[2][1] is None
    assert got[1][1] == dt.date(2017, 5, 24) and got[1][2] == dt.datetime(2017, 5, 24, 10)


def test_patient_placeholders(spark):
    row = {c: None for c in S.RAW_SCHEMAS["patients"].names} | {"ID": "1", "DRIVERS": "false", "FIRST": "A", "BIRTHDATE": "bad"}
    got = silver.patients(spark.createDataFrame([row], S.RAW_SCHEMAS["patients"])).first()
    assert got["DRIVERS"] == "NO_LICENSE" and got["PREFIX"] == "NONE" and got["MARITAL"] == "UNKNOWN"
    assert got["FULL_NAME"] == "A" and got["BIRTHDATE"] is None and got["DEATHDATE"] == dt.date(9999, 12, 31)


def test_medication_intervals(spark):
    names = S.RAW_SCHEMAS["medications"].names
    base = ("1", "e", "c", "d", None, None)
    rows = [("2020-01-02", "2020-01-01", *base), ("2020-01-01", None, *base), (None, "2020-01-01", *base), ("2020-01-01", "2020-01-01", *base)]
    got = silver.medications(strings(spark, names, rows), AS_OF).orderBy("END_DATE").collect()
    assert [r["END_DATE"].year for r in got] == [2020, 9999]
    assert got[0]["REASONCODE"] == "N/A"
    counted = quality.interval_anomalies({"m": strings(spark, names, rows)}).first()
    assert counted["ANOMALIES"] == 1 and counted["TOTAL_ROWS"] == 4


@pytest.mark.parametrize(
    "text, number, kept",
    [("5.", None, "5."), ("1e3", None, "1e3"), ("", None, ""), (".5", 0.5, None), ("+1.25", 1.25, None), (None, None, None),
     ("12345678.9", 12345678.9, None)],
)
def test_value_split(spark, text, number, kept):
    row = ("2020-01-01", "p", "e", "c", "Glucose", text, "u")
    got = silver.split_value(strings(spark, S.RAW_SCHEMAS["observations"].names, [row])).first()
    assert (got["VALUE_NUMERIC"], got["VALUE_TEXT"]) == (number, kept)


def _readings(spark, values, encounter="e"):
    rows = [("2020-01-01", "p", encounter, "c", "Glucose", v, "u") for v in values]
    raw = strings(spark, S.RAW_SCHEMAS["observations"].names, rows)
    return silver.bronze_stamp(raw, "B", AS_OF)


def test_reading_sequence_and_pivot(spark):
    obs = silver.observations(_readings(spark, ["1", "1", "2", None]))
    assert sorted((r["VALUE_NUMERIC"], r["READING_SEQ"]) for r in obs.collect()) == [(1, 1), (1, 2), (2, 1)]
    wide = {r["READING_SEQ"]: r["Glucose"] for r in G.observations(obs).collect()}
    assert wide == {1: "1.0", 2: "1.0"}
    kept = silver.observations(_readings(spark, ["1", "1", "2", None]), resequence=True)
    assert sorted(r["Glucose"] for r in G.observations(kept).collect()) == ["1.0", "1.0", "2.0"]
    latest = G.observations(obs, resolve="latest").filter("READING_SEQ = 1").first()
    assert latest["Glucose"] == "2.0" and latest["Body Weight"] == "Not Recorded"


def test_missing_encounter_keeps_readings(spark):
    obs = silver.observations(_readings(spark, ["7"], encounter=None))
    assert G.observations(obs).first()["Glucose"] == "7.0"
    assert G.observations(obs, strict_join=True).first()["Glucose"] == "Not Recorded"


def test_description_list(spark):
    df = strings(spark, ["ENCOUNTER_ID", "DESCRIPTION"], [("e", "b"), ("e", "a"), ("e", "b"), ("e", None), ("f", None)])
    got = dict(map(tuple, G.conditions_per_encounter(df).collect()))
    assert got == {"e": "a | b | b", "f": ""}


def test_wide_table_keeps_all_encounters(spark):
    enc = strings(spark, ["ENCOUNTER_ID", "PATIENT_ID"], [("e1", "p"), ("e2", "p"), ("e3", "q"), (None, "p")])
    pat = strings(spark, ["PATIENT_ID", "GENDER"], [("p", "F")])
    obs = strings(spark, ["PATIENT_ID", "ENCOUNTER_ID", "Glucose"], [("p", "e1", "1"), ("p", "e1", "2"), ("p", None, "9")])
    cond = strings(spark, ["ENCOUNTER_ID", "DESCRIPTION"], [("e2", "x"), (None, "y")])
    got = G.obt_patient_encounters(enc, pat, obs, cond, cond.limit(0))
    rows = sorted((r["ENCOUNTER_ID"] or "", r["GENDER"] or "", r["Glucose"] or "", r["ALL_CONDITIONS"]) for r in got.collect())
    none = "No Conditions Recorded"
    assert rows == [("", "F", "", none), ("e1", "F", "1", none), ("e1", "F", "2", none), ("e2", "F", "", "x"), ("e3", "", "", none)]
    assert {r["ALL_MEDICATIONS"] for r in got.collect()} == {"No Medications Recorded"}


def test_layer_report_and_profile(spark):
    df = strings(spark, ["a", "b"], [("", "x"), ("NULL", "y")])
    report = quality.layer_report({"t": df}, ["SOURCE_SYSTEM"]).first()
    assert report["STATUS"] == "MISSING METADATA COLUMNS" and report["ROW_COUNT"] == 2
    assert [tuple(r) for r in quality.null_profile_pct(df).collect()] == [("a", 2, 100.0)]
    assert quality.key_uniqueness(df, "b", approximate=True).first()["DISTINCT_KEYS"] == 2


# --- events ---------------------------------------------------------------------
OBS = '{"DESCRIPTION":"Body Weight","OBSERVATION_DATE":"2026-09-01","VALUE_NUMERIC":72.5}'


def event(spark, *rows):
    return spark.createDataFrame(rows, S.ENVELOPE_SCHEMA)


@pytest.mark.parametrize(
    "patient, kind, payload, reason",
    [
        ("p", "OBSERVATION", OBS, None),
        ("p", "OBSERVATION", '{"DESCRIPTION":"x","OBSERVATION_DATE":"2026-09-01","VALUE_NUMERIC":null,"VALUE_TEXT":"Positive"}', None),
        ("p", "ENCOUNTER", '{"CODE":"185345009","DESCRIPTION":"d","ENCOUNTER_DATE":"2026-09-01T10:00:00"}', None),
        ("p", "LAB_RESULT", "{}", events.REJECT_TYPE),
        ("", "OBSERVATION", OBS, events.REJECT_PATIENT),
        ("   ", "OBSERVATION", OBS, events.REJECT_PATIENT),
        (None, "OBSERVATION", OBS, events.REJECT_PATIENT),
        ("p", "OBSERVATION", '{"OBSERVATION_DATE":"2026-09-01","VALUE_NUMERIC":1}', events.REJECT_FIELDS + "DESCRIPTION"),
        ("p", "OBSERVATION", '{"DESCRIPTION":"x","OBSERVATION_DATE":"2026-09-01"}', events.REJECT_VALUE),
        ("p", "ENCOUNTER", '{"CODE":"","DESCRIPTION":"d","ENCOUNTER_DATE":null}', events.REJECT_FIELDS + "CODE,ENCOUNTER_DATE"),
        ("p", "CONDITION", '{"DESCRIPTION":"Hypertension"}', events.REJECT_FIELDS + "CODE,START_DATE"),
        ("p", "CONDITION", "{broken", events.REJECT_FIELDS + "CODE,DESCRIPTION,START_DATE"),
    ],
)
def test_validation(spark, patient, kind, payload, reason):
    assert events.judge(event(spark, ("e", patient, kind, "2026-09-01T00:00:00Z", payload))).first()["REASON"] == reason


def test_each_event_is_accepted_or_rejected_once(spark, sf_dir):
    from vitalflow.plans.proxy import Clinic

    c = Clinic(spark, sf_dir)
    named = events.identify(c.events, c.now)
    assert events.accepted(named).count() + events.quarantine(named).count() == c.events.count()
    good = events.accepted(named)
    typed = events.realtime_tables(c.events, c.now)
    assert sum(df.count() for df in typed.values()) == good.select("event_id").distinct().count()


def test_defaults_and_ids(spark):
    df = event(
        spark,
        ("e1", "p", "CAREPLAN", "2026-09-01T00:00:00Z", '{"CODE":"c","DESCRIPTION":"d","START_DATE":"2026-01-01"}'),
        ("e2", "p", "ENCOUNTER", "nonsense", '{"CODE":"c","DESCRIPTION":"d","ENCOUNTER_DATE":"soon"}'),
        ("", "p", "OBSERVATION", "", OBS),
    )
    now = F.lit(AS_OF).cast("timestamp")
    rt = events.realtime_tables(df, now)
    plan = rt["RT_CAREPLANS"].first()
    assert plan["CAREPLAN_ID"] == "e1" and plan["END_DATE"].year == 9999 and plan["REASONCODE"] == "N/A"
    visit = rt["RT_ENCOUNTERS"].first()
    assert visit["ENCOUNTER_ID"] == "e2" and visit["ENCOUNTER_DATE"] is None and visit["EVENT_TS"] == dt.datetime(2026, 9, 1)
    assert visit["REASONDESCRIPTION"] == "Routine / Unspecified"
    again = events.realtime_tables(df, now)["RT_OBSERVATIONS"].first()["EVENT_ID"]
    reading = rt["RT_OBSERVATIONS"].first()
    assert len(again) == 32 and again == reading["EVENT_ID"]
    assert reading["VALUE_NUMERIC"] == 72.5 and reading["READING_SEQ"] == 1
    for name, table in rt.items():
        assert table.schema.names == S.REALTIME_SCHEMAS[name].names


def test_envelope_roundtrip_keeps_nested_payload(spark):
    sent = events.serialize_envelope(event(spark, ("e", "p", "OBSERVATION", "t", OBS)))
    assert sent.first()["key"] == "p" and '"payload":{' in sent.first()["value"]
    back = events.with_payload(events.parse_envelope(sent)).first()
    assert back["P"]["VALUE_NUMERIC"] == "72.5" and back["event_id"] == "e"
    assert events.parse_envelope(spark.createDataFrame([("not json",)], "value string")).first()["event_id"] is None


def test_envelope_keeps_the_text_of_numbers(spark):
    sent = '{"a":26.0,"n":{"x":1.50},\n"c":0.10000000000000000001,"s":"1.0"}'
    texts = [sent, '{"a":1.0},"event_id":"other"', '{"a":1.0}} x', "{broken", None]
    rows = [(str(i), "p", "MEDICATION", "t", text) for i, text in enumerate(texts)]
    got = [r["value"] for r in events.serialize_envelope(event(spark, *rows)).collect()]
    assert sent.replace("\n", " ") in got[0]
    assert [json.loads(v).get("payload") for v in got[1:]] == [{"a": 1}, {"a": 1}, None, None]
    assert [json.loads(v)["event_id"] for v in got] == ["0", "1", "2", "3", "4"]


def test_merged_defaults_keep_the_text_of_numbers(spark):
    sent = '{"REASONCODE":null,"END_DATE":1.0,"x":26.5,"u":-100.0,"i":7,"s":"3.0","z":10000000000000000000000.0,"q\\"":true}'
    got = events.merge_defaults(event(spark, ("e", "p", "MEDICATION", "t", sent))).first()["payload"]
    for part in ('"END_DATE":1.0,', '"x":26.5,', '"u":-100.0,', '"i":7,', '"s":"3.0",', '"z":10000000000000000000000.0,', '"q\\"":true,'):
        assert part in got
    assert json.loads(got)["REASONCODE"] == S.DEFAULT_FIELDS["MEDICATION"]["REASONCODE"]


def test_ids_of_first_events_move_no_payloads(spark):
    rows = [("e", "p", "CONDITION", "2026-09-01T10:00:00Z", "b"), ("e", "p", "CONDITION", "2026-09-01T10:00:00Z", "a"),
            ("e", "p", "ALLERGY", "2026-09-01T11:00:00Z", "a"), ("f", None, "ALLERGY", None, None), ("f", "p", "CONDITION", None, "x")]
    named = events.identify(event(spark, *rows), F.lit(AS_OF).cast("timestamp"))
    ids = events.dedup_ids(named)
    assert sorted(ids.collect()) == sorted(events.dedup_events(named).select("event_id", "event_type").collect())
    aggregate = ids._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[1].splitlines()[0]
    assert "patient_id" in aggregate and "payload" not in aggregate


# --- state ------------------------------------------------------------------------
def test_name_search_is_literal(spark):
    df = strings(spark, ["PATIENT_ID", "FULL_NAME"], [("1", "Ann Smith"), ("2", "A%b"), ("3", "smithers")])
    assert [r[0] for r in state.patients_by_name(df, "SMITH").collect()] == ["1", "3"]
    assert [r[0] for r in state.patients_by_name(df, "%").collect()] == ["2"]
    assert len(state.patients_by_name(df, "a%h", pattern=True).collect()) == 1


def test_timeline_skips_absent_tables_and_null_dates(spark):
    schema = "PATIENT_ID string, ENCOUNTER_ID string, DESCRIPTION string, REASONDESCRIPTION string, ENCOUNTER_DATE timestamp"
    t = dt.datetime(2020, 1, 1)
    enc = spark.createDataFrame([("p", "e1", "d", None, t), ("p", "e2", "d", "r", None), ("p", "e3", "d", "r", t)], schema)
    line = state.clinical_timeline({"encounters": enc}, {})
    assert [r["DETAIL"] for r in line.orderBy("DETAIL").collect()] == ["", "r"]
    breaks = state.timeline_day_breaks(line).collect()
    assert [(r["EVENTS"], r["DETAIL"]) for r in breaks] == [(2, "")], "one row a day, with the event that stands first"
    assert state.clinical_timeline({"encounters": enc}, {}, limit=1).count() == 1


# --- features -----------------------------------------------------------------------
@pytest.mark.parametrize("given, want", [(12000.0, 12000 / 365.25), (45.0, 45.0), (35.5, 35.5), (0.0, 0.0), (None, None), (float("nan"), None), (20000.0, 20000 / 365.25)])
def test_age_rule(spark, given, want):
    df = spark.createDataFrame([("p", given)], "PATIENT_ID string, AGE_AT_INDEX double")
    assert features.age_safety(df).first()["AGE_AT_INDEX"] == want


@pytest.mark.parametrize("born, low, high", [("1994-01-01", 32, 33), ("1936-01-01", 90, 91)])
def test_age(spark, born, low, high):
    df = strings(spark, ["PATIENT_ID", "B"], [("p", born)]).withColumn("BIRTHDATE", F.to_date("B"))
    assert low <= features.age_at_index(df, AS_OF).first()["AGE_AT_INDEX"] <= high


def test_contract_fills_absent_columns(spark):
    row = features.feature_contract(strings(spark, ["PATIENT_ID", "GENDER"], [("p", "M")])).first()
    assert row.asDict().keys() == {"PATIENT_ID", *S.FEATURES} and list(row.asDict())[1:] == S.FEATURES
    assert row["AVG_BMI"] is None and row["RACE"] == "unknown" and row["MARITAL"] == "unknown" and row["GENDER"] == "M"
    assert len(S.NUMERIC_FEATURES) == 14 and len(S.FEATURES) == 18 and len(S.ABLATED_NUMERIC_FEATURES) == 10


def test_weighted_average_and_counts(spark):
    wide = ", ".join(f"`{m}` string" for m in S.MEASUREMENTS)
    none = ["Not Recorded"] * len(S.MEASUREMENTS)
    at = S.MEASUREMENTS.index("Glucose")
    hist_rows = [("p", "e", dt.date(2020, 1, 1), 1, *[v if i == at else x for i, x in enumerate(none)]) for v in ("90.0", "100.0", "positive")]
    day = dt.datetime(2020, 2, 1)
    gold = {
        "observations": spark.createDataFrame(hist_rows, f"PATIENT_ID string, ENCOUNTER_ID string, OBSERVATION_DATE date, READING_SEQ int, {wide}"),
        "encounters": spark.createDataFrame([("p", day), ("p", day)], "PATIENT_ID string, ENCOUNTER_DATE timestamp"),
        "conditions": spark.createDataFrame([("p", "c", day), ("p", None, day)], "PATIENT_ID string, CODE string, START_DATE timestamp"),
        "medications": spark.createDataFrame([("p", "m", day)], "PATIENT_ID string, CODE string, START_DATE timestamp"),
    }
    rt = {
        "RT_OBSERVATIONS": spark.createDataFrame([("p", "GLUCOSE", dt.date(2021, 1, 1), 110.0)], "PATIENT_ID string, DESCRIPTION string, OBSERVATION_DATE date, VALUE_NUMERIC double"),
        "RT_ENCOUNTERS": gold["encounters"].limit(1),
        "RT_CONDITIONS": spark.createDataFrame([("p", "c", day), ("p", "d", None)], "PATIENT_ID string, CODE string, START_DATE timestamp"),
        "RT_MEDICATIONS": gold["medications"].limit(0),
    }
    pats = spark.createDataFrame([("p", None, "", None, "x", None), ("q", dt.date(2000, 1, 1), "F", "r", "e", "M")],
                                 "PATIENT_ID string, BIRTHDATE date, GENDER string, RACE string, ETHNICITY string, MARITAL string")
    rows = {r["PATIENT_ID"]: r for r in features.patient_features(pats, gold, rt, AS_OF).collect()}
    p, q = rows["p"], rows["q"]
    assert p["AVG_GLUCOSE"] == 100.0 and p["OBSERVATION_COUNT"] == 4 and p["HAS_GLUCOSE_READING"] == 1 and p["HAS_CHOLESTEROL_READING"] == 0
    assert p["DISTINCT_CONDITION_COUNT"] == 2 and p["DISTINCT_MEDICATION_COUNT"] == 1 and p["TOTAL_ENCOUNTERS"] == 3
    assert p["AGE_AT_INDEX"] is None and p["GENDER"] == "unknown" and p["MARITAL"] == "UNKNOWN"
    assert q["AVG_GLUCOSE"] is None and q["OBSERVATION_COUNT"] == 0
    dates = spark.createDataFrame([("p", dt.date(2020, 2, 1)), ("p", dt.date(2020, 2, 2))], "PATIENT_ID string, INDEX_DATE date")
    asof = {r["INDEX_DATE"].day: r for r in features.features_asof(dates, pats, gold, rt).collect()}
    assert asof[1]["AVG_GLUCOSE"] == 95.0 and asof[1]["TOTAL_ENCOUNTERS"] == 0 and asof[1]["DISTINCT_CONDITION_COUNT"] == 0
    assert asof[2]["TOTAL_ENCOUNTERS"] == 3 and asof[2]["DISTINCT_CONDITION_COUNT"] == 1


# --- risk -------------------------------------------------------------------------------
@pytest.mark.parametrize("p, tier, color, pct", [(0.75, "high", "red", 75.0), (0.7, "high", "red", 70.0), (0.55, "moderate", "orange", 55.0),
                                                 (0.4, "moderate", "orange", 40.0), (0.2, "low", "green", 20.0), (None, "unavailable", "gray", None)])
def test_tiers(spark, p, tier, color, pct):
    df = spark.createDataFrame([("x", "Stroke", p)], "PATIENT_ID string, TARGET_NAME string, PROBABILITY double")
    row = risk.risk_tiers(df).first()
    assert (row["TIER"], row["COLOR"], row["PCT"]) == (tier, color, pct)


def test_delta_band(spark):
    def snap(*ps):
        return spark.createDataFrame([("x", f"t{i}", p) for i, p in enumerate(ps)], "PATIENT_ID string, TARGET_NAME string, PROBABILITY double")

    rows = risk.risk_delta(snap(0.2, 0.5, 0.5, None), snap(0.3, 0.25, 0.504, 0.1)).orderBy("TARGET_NAME").collect()
    assert [(r["DIRECTION"], r["CHANGE"]) for r in rows] == [("▲", "+10.0%"), ("▼", "-25.0%"), ("—", "No change"), ("—", "—")]


def test_percent_rounds_by_binary_value(spark):
    values = [i / 2000 for i in range(2001)] + [0.1225, 0.3455, 0.5185, 0.7085]
    df = spark.createDataFrame([(v,) for v in values], "p double")
    got = [r[0] for r in df.select(risk.percent(F.col("p"))).collect()]
    assert got == [round(v * 100, 1) for v in values]


def test_long_features_round_by_binary_value(spark):
    # 23.67375 times 10 000 is 236737.49999999997 in doubles
    row = spark.createDataFrame([("1", 23.67375)], "PATIENT_ID string, AVG_BMI double")
    long = features.features_long(features.feature_contract(row))
    assert long.filter("FEATURE = 'AVG_BMI'").first()["VALUE"] == "23.6737"
