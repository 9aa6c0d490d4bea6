"""Patient state: Gold united with the realtime tables, for all patients at once.

`gold` and `rt` are dicts of DataFrames by table name (`encounters`, ... and
`RT_ENCOUNTERS`, ...). Every function takes an optional `patient_id`; the filter sits
above the union and Spark pushes it into both scans. Limits are per patient.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import keep_top, parse_number, split_row_number

Tables = Mapping[str, DataFrame]
NAME_LIMIT = 50
ENCOUNTER_LIMIT = 20
READING_LIMIT = 10
TIMELINE_LIMIT = 200
TIMELINE_COLUMNS = ["PATIENT_ID", "EVENT_DATE", "EVENT_TYPE", "DESCRIPTION", "DETAIL", "SOURCE", "ENCOUNTER_ID"]


def _of(df: DataFrame, patient_id: str | None) -> DataFrame:
    return df if patient_id is None else df.filter(F.col("PATIENT_ID") == patient_id)


def _tagged(df: DataFrame, columns: Sequence[str | Column], source: str) -> DataFrame:
    return df.select(*columns, F.lit(source).alias("SOURCE"))


def _both(hist: DataFrame, rt: DataFrame, columns: Sequence[str], patient_id: str | None) -> DataFrame:
    united = _tagged(hist, columns, S.HISTORICAL).unionByName(_tagged(rt, columns, S.REALTIME))
    return _of(united, patient_id)


def newest(column: str) -> Column:
    return F.col(column).desc_nulls_last()


# --- patients ----------------------------------------------------------------
def patient_by_id(patients: DataFrame, patient_id: str) -> DataFrame:
    return patients.filter(F.col("PATIENT_ID") == patient_id).limit(1)


def patients_by_name(
    patients: DataFrame, text: str, limit: int = NAME_LIMIT, pattern: bool = False
) -> DataFrame:
    """Name search without regard to case. `pattern` lets % and _ act as wildcards."""
    name = F.upper("FULL_NAME")
    found = name.like(f"%{text.upper()}%") if pattern else F.contains(name, F.lit(text.upper()))
    return patients.filter(found).orderBy("FULL_NAME", "PATIENT_ID").limit(limit)


def patient_info(patients: DataFrame, patient_id: str | None = None) -> DataFrame:
    return _of(patients, patient_id).select(
        "PATIENT_ID", "BIRTHDATE", "DEATHDATE", "MARITAL", "RACE", "ETHNICITY", "GENDER", "FULL_NAME"
    )


def patient_status(patients: DataFrame) -> DataFrame:
    """Alive while the death date is missing or the open end, else the date."""
    alive = F.col("DEATHDATE").isNull() | (F.col("DEATHDATE") == F.lit(S.OPEN_END).cast("date"))
    text = F.date_format("DEATHDATE", "yyyy-MM-dd")
    return patients.select("PATIENT_ID", F.when(alive, F.lit("Alive")).otherwise(text).alias("STATUS"))


def known_patients(requested: DataFrame, patients: DataFrame) -> DataFrame:
    return requested.join(patients.select("PATIENT_ID"), "PATIENT_ID", "left_semi")


def unknown_patients(requested: DataFrame, patients: DataFrame) -> DataFrame:
    return requested.join(patients.select("PATIENT_ID"), "PATIENT_ID", "left_anti")


# --- united tables -------------------------------------------------------------
def encounters_state(
    gold: Tables, rt: Tables, limit: int | None = ENCOUNTER_LIMIT, patient_id: str | None = None
) -> DataFrame:
    columns = ["PATIENT_ID", "ENCOUNTER_ID", "CODE", "DESCRIPTION", "REASONDESCRIPTION", "ENCOUNTER_DATE"]
    united = _both(gold["encounters"], rt["RT_ENCOUNTERS"], columns, patient_id)
    ties = ["SOURCE", "ENCOUNTER_ID", "CODE", "DESCRIPTION", "REASONDESCRIPTION"]
    return keep_top(united, ["PATIENT_ID"], [newest("ENCOUNTER_DATE"), *map(F.col, ties)], limit)


_INTERVAL = ["CODE", "DESCRIPTION", "START_DATE", "END_DATE"]


def conditions_state(gold: Tables, rt: Tables, patient_id: str | None = None) -> DataFrame:
    return _both(gold["conditions"], rt["RT_CONDITIONS"], ["PATIENT_ID", *_INTERVAL], patient_id)


def medications_state(gold: Tables, rt: Tables, patient_id: str | None = None) -> DataFrame:
    columns = ["PATIENT_ID", "REASONDESCRIPTION", *_INTERVAL]
    return _both(gold["medications"], rt["RT_MEDICATIONS"], columns, patient_id)


def allergies_state(gold: Tables, rt: Tables, patient_id: str | None = None) -> DataFrame:
    return _both(gold["allergies"], rt["RT_ALLERGIES"], ["PATIENT_ID", *_INTERVAL], patient_id)


def newest_first(df: DataFrame, date: str = "START_DATE") -> DataFrame:
    """Adds POSITION, the place of a row in its patient's list, newest first.

    Numbered by days, so a patient with very many rows is not gathered in one task.
    """
    rest = [c for c in df.columns if c not in ("PATIENT_ID", date)]
    day = F.coalesce(F.unix_date(F.col(date).cast("date")) * -1, F.lit(2**31 - 1))
    order = [newest(date), *map(F.col, rest)]
    numbered = split_row_number(df.withColumn("__day", day), ["PATIENT_ID"], ["__day"], order, "POSITION")
    return numbered.drop("__day")


def latest_obs_hist(gold: Tables, limit: int | None = READING_LIMIT, patient_id: str | None = None) -> DataFrame:
    """The newest wide readings of each patient."""
    columns = ["PATIENT_ID", "OBSERVATION_DATE", *S.MEASUREMENTS]
    hist = _of(gold["observations"], patient_id)
    wide = hist.select(*columns, F.lit(S.HISTORICAL).alias("SOURCE"), "ENCOUNTER_ID", "READING_SEQ")
    order = [newest("OBSERVATION_DATE"), F.col("ENCOUNTER_ID").asc_nulls_last(), F.col("READING_SEQ")]
    return keep_top(wide, ["PATIENT_ID"], order, limit).drop("ENCOUNTER_ID", "READING_SEQ")


def latest_obs_rt(rt: Tables, patient_id: str | None = None) -> DataFrame:
    columns = ["PATIENT_ID", "OBSERVATION_DATE", "DESCRIPTION", "VALUE_NUMERIC", "VALUE_TEXT"]
    return _tagged(_of(rt["RT_OBSERVATIONS"], patient_id), columns, S.REALTIME)


def observations_long(gold: Tables, rt: Tables, patient_id: str | None = None) -> DataFrame:
    """Both sources in long form: one row per recorded measurement."""
    hist = gold["observations"].unpivot(
        ["PATIENT_ID", "OBSERVATION_DATE"], [F.col(f"`{m}`") for m in S.MEASUREMENTS], "DESCRIPTION", "VALUE"
    )
    hist = hist.filter(F.col("VALUE") != S.NOT_RECORDED)
    number = parse_number("VALUE")
    hist = hist.select(
        "PATIENT_ID",
        "OBSERVATION_DATE",
        "DESCRIPTION",
        number.alias("VALUE_NUMERIC"),
        F.when(number.isNull(), F.col("VALUE")).alias("VALUE_TEXT"),
    )
    columns = hist.columns
    return _both(hist, rt["RT_OBSERVATIONS"], columns, patient_id)


# --- timeline ------------------------------------------------------------------
def _branch(df: DataFrame, source: str, event_type: str, date: str, text: Column, detail: Column,
            encounter: bool = True) -> DataFrame:
    return df.select(
        "PATIENT_ID",
        F.col(date).cast("timestamp").alias("EVENT_DATE"),
        F.lit(event_type).alias("EVENT_TYPE"),
        text.alias("DESCRIPTION"),
        detail.alias("DETAIL"),
        F.lit(source).alias("SOURCE"),
        (F.col("ENCOUNTER_ID") if encounter else F.lit(None).cast("string")).alias("ENCOUNTER_ID"),
    )


def _blank(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


# Date column and detail column of each event type
_TIMELINE = {
    "ENCOUNTER": ("ENCOUNTER_DATE", "REASONDESCRIPTION"),
    "CONDITION": ("START_DATE", "CODE"),
    "MEDICATION": ("START_DATE", "REASONDESCRIPTION"),
    "OBSERVATION": ("OBSERVATION_DATE", None),
    "PROCEDURE": ("PROCEDURE_DATE", "REASONDESCRIPTION"),
    "IMMUNIZATION": ("IMMUNIZATION_DATE", "CODE"),
    "ALLERGY": ("START_DATE", "CODE"),
    "CAREPLAN": ("START_DATE", "REASONDESCRIPTION"),
}
_GOLD_NAME = {
    "ENCOUNTER": "encounters",
    "CONDITION": "conditions",
    "MEDICATION": "medications",
    "OBSERVATION": "observations",
    "PROCEDURE": "procedures",
    "IMMUNIZATION": "immunizations",
    "ALLERGY": "allergies",
    "CAREPLAN": "careplans",
}
# Historical rows of these types carry no encounter in the timeline.
_UNLINKED = ("CONDITION", "MEDICATION")
_TIMELINE_ORDER = [
    ("EVENT_DATE", "desc"),
    ("EVENT_TYPE", "asc"),
    ("SOURCE", "asc"),
    ("DESCRIPTION", "asc"),
    ("DETAIL", "asc"),
    ("ENCOUNTER_ID", "asc"),
]


def _timeline_order() -> list[Column]:
    return [
        F.col(c).desc_nulls_last() if way == "desc" else F.col(c).asc_nulls_last()
        for c, way in _TIMELINE_ORDER
    ]


def timeline_rows(gold: Tables, rt: Tables, patient_id: str | None = None) -> DataFrame:
    """All dated events of both sources in one shape. Tables that are absent are skipped."""
    parts = []
    for event_type, (date, detail) in _TIMELINE.items():
        hist, live = _GOLD_NAME[event_type], S.EVENT_TABLES[event_type]
        if hist in gold:
            if detail is None:
                text, note = F.lit("Vital Signs Reading"), F.lit("")
            else:
                text, note = F.col("DESCRIPTION"), _blank(detail)
            linked = event_type not in _UNLINKED
            parts.append(_branch(gold[hist], S.HISTORICAL, event_type, date, text, note, linked))
        if live in rt:
            if detail is None:
                note = F.coalesce(F.col("VALUE_NUMERIC").cast("string"), F.col("VALUE_TEXT"), F.lit(""))
            else:
                note = _blank(detail)
            parts.append(_branch(rt[live], S.REALTIME, event_type, date, F.col("DESCRIPTION"), note))
    united = reduce(DataFrame.unionByName, parts)
    return _of(united.filter(F.col("EVENT_DATE").isNotNull()), patient_id)


def clinical_timeline(
    gold: Tables, rt: Tables, limit: int | None = TIMELINE_LIMIT, patient_id: str | None = None
) -> DataFrame:
    """The newest events of every patient."""
    return keep_top(timeline_rows(gold, rt, patient_id), ["PATIENT_ID"], _timeline_order(), limit)


def timeline_filtered(
    rows: DataFrame, sources: Sequence[str], event_types: Sequence[str], limit: int | None = None
) -> DataFrame:
    """Timeline rows of some sources and types; with `limit` the newest of each patient."""
    found = rows.filter(F.col("SOURCE").isin(*sources) & F.col("EVENT_TYPE").isin(*event_types))
    return keep_top(found, ["PATIENT_ID"], _timeline_order(), limit)


def timeline_day_breaks(rows: DataFrame) -> DataFrame:
    """Per patient and day with events: how many, and the one that stands first.

    The least struct in timeline order combines map-side; no patient's rows are gathered.
    """
    keys = []
    for name, way in _TIMELINE_ORDER:
        value = F.unix_micros(name) * -1 if way == "desc" else F.col(name)
        keys += [F.col(name).isNull().alias(f"{name}_ABSENT"), value.alias(f"{name}_KEY")]
    event = F.struct(*[c for c in TIMELINE_COLUMNS if c != "PATIENT_ID"]).alias("EVENT")
    return (
        rows.groupBy("PATIENT_ID", F.to_date("EVENT_DATE").alias("DAY"))
        .agg(F.count(F.lit(1)).alias("EVENTS"), F.min(F.struct(*keys, event)).alias("FIRST"))
        .select("PATIENT_ID", "DAY", "EVENTS", "FIRST.EVENT.*")
    )


def timeline_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("PATIENT_ID").agg(
        F.count(F.lit(1)).alias("TOTAL"),
        F.count_if(F.col("SOURCE") == S.HISTORICAL).alias("HISTORICAL"),
        F.count_if(F.col("SOURCE") == S.REALTIME).alias("REALTIME"),
    )


# --- summary --------------------------------------------------------------------
def patient_360(gold: Tables, rt: Tables, patients: DataFrame) -> DataFrame:
    """Counts per patient, total and by source.

    All four sources are reduced to marker rows and counted in one aggregation that combines
    map-side.
    """
    hist_obs = _tagged(gold["observations"], ["PATIENT_ID"], S.HISTORICAL)
    rt_obs = _tagged(rt["RT_OBSERVATIONS"], ["PATIENT_ID"], S.REALTIME)
    marked = {
        "ENCOUNTERS": encounters_state(gold, rt, limit=None),
        "CONDITIONS": conditions_state(gold, rt),
        "MEDICATIONS": medications_state(gold, rt),
        "OBSERVATIONS": hist_obs.unionByName(rt_obs),
    }
    rows = reduce(
        DataFrame.unionByName,
        [df.select("PATIENT_ID", "SOURCE", F.lit(name).alias("K")) for name, df in marked.items()],
    )
    counts = []
    for name in marked:
        for suffix, source in (("HIST", S.HISTORICAL), ("RT", S.REALTIME)):
            n = F.count_if((F.col("K") == name) & (F.col("SOURCE") == source))
            counts.append(n.alias(f"{name}_{suffix}"))
    joined = patients.select("PATIENT_ID").join(rows.groupBy("PATIENT_ID").agg(*counts), "PATIENT_ID", "left")
    filled = joined.fillna(0)
    totals = {f"{n}_TOTAL": F.col(f"{n}_HIST") + F.col(f"{n}_RT") for n in marked}
    return filled.withColumns(totals)
