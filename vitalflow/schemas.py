"""Fixed values and declared schemas.

Everything here is a contract: names, defaults and types that results must carry.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# sentinels
# ---------------------------------------------------------------------------
OPEN_END = "9999-12-31"
NOT_RECORDED = "Not Recorded"
NO_CONDITIONS = "No Conditions Recorded"
NO_MEDICATIONS = "No Medications Recorded"
REASON_CODE_DEFAULT = "N/A"
REASON_TEXT_DEFAULT = "Unspecified"
ENCOUNTER_REASON_TEXT_DEFAULT = "Routine / Unspecified"
MARITAL_DEFAULT = "UNKNOWN"
CATEGORY_DEFAULT = "unknown"
NUMERIC_PATTERN = r"^[-+]?[0-9]*\.?[0-9]+$"
LIST_SEPARATOR = " | "
HISTORICAL = "historical"
REALTIME = "realtime"

# Placeholders for missing identity columns
IDENTITY_PLACEHOLDERS = {
    "DRIVERS": "NO_LICENSE",
    "PASSPORT": "NO_PASSPORT",
    "PREFIX": "NONE",
    "SUFFIX": "NONE",
    "MAIDEN": "NONE",
    "SSN": "NONE",
}

# Columns that do not leave Silver
PII_COLUMNS = ["SSN", "DRIVERS", "PASSPORT", "PREFIX", "SUFFIX", "MAIDEN", "BIRTHPLACE", "ADDRESS"]
BRONZE_METADATA = ["INGESTION_TIMESTAMP", "SOURCE_SYSTEM"]
LOAD_METADATA = BRONZE_METADATA + ["SILVER_LOAD_TIMESTAMP"]

# Entities and measurements
ENTITIES = [
    "patients",
    "encounters",
    "observations",
    "conditions",
    "medications",
    "allergies",
    "procedures",
    "immunizations",
    "careplans",
]
MEASUREMENTS = [
    "Body Weight",
    "Body Height",
    "Body Mass Index",
    "Systolic Blood Pressure",
    "Diastolic Blood Pressure",
    "Glucose",
    "Total Cholesterol",
]

# Feature contract (names and order)
VITAL_FEATURES = {
    "AVG_HEIGHT": "Body Height",
    "AVG_BMI": "Body Mass Index",
    "AVG_WEIGHT": "Body Weight",
    "AVG_DIASTOLIC_BP": "Diastolic Blood Pressure",
    "AVG_GLUCOSE": "Glucose",
    "AVG_SYSTOLIC_BP": "Systolic Blood Pressure",
    "AVG_CHOLESTEROL": "Total Cholesterol",
}
FLAG_FEATURES = {
    "HAS_GLUCOSE_READING": "Glucose",
    "HAS_CHOLESTEROL_READING": "Total Cholesterol",
}
COUNT_FEATURES = [
    "OBSERVATION_COUNT",
    "DISTINCT_CONDITION_COUNT",
    "DISTINCT_MEDICATION_COUNT",
    "TOTAL_ENCOUNTERS",
]
NUMERIC_FEATURES = ["AGE_AT_INDEX", *VITAL_FEATURES, *COUNT_FEATURES, *FLAG_FEATURES]
ABLATED_NUMERIC_FEATURES = [c for c in NUMERIC_FEATURES if c not in COUNT_FEATURES]
CATEGORICAL_FEATURES = ["GENDER", "RACE", "ETHNICITY", "MARITAL"]
FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES
LABEL_METADATA = ["PATIENT_ID", "TARGET_NAME", "LABEL", "INDEX_DATE"]
TARGETS = ["Diabetes", "Hypertension", "Coronary Heart Disease", "Stroke", "Asthma"]
DAYS_PER_YEAR = 365.25
AGE_LIMIT_YEARS = 200

# Boosted-tree settings
TREE_COUNT = 300
TREE_DEPTH = 5
TREE_STEP = 0.05
MODEL_SEED = 42

# Risk display
HIGH_RISK = 0.7
MODERATE_RISK = 0.4
DELTA_BAND = 0.005

# ---------------------------------------------------------------------------
# Event rules
# ---------------------------------------------------------------------------
EVENT_TYPES = [
    "ENCOUNTER",
    "OBSERVATION",
    "CONDITION",
    "MEDICATION",
    "PROCEDURE",
    "IMMUNIZATION",
    "ALLERGY",
    "CAREPLAN",
]
REQUIRED_FIELDS = {
    "ENCOUNTER": ["CODE", "DESCRIPTION", "ENCOUNTER_DATE"],
    "OBSERVATION": ["DESCRIPTION", "OBSERVATION_DATE"],
    "CONDITION": ["CODE", "DESCRIPTION", "START_DATE"],
    "MEDICATION": ["CODE", "DESCRIPTION", "START_DATE"],
    "PROCEDURE": ["CODE", "DESCRIPTION", "PROCEDURE_DATE"],
    "IMMUNIZATION": ["CODE", "DESCRIPTION", "IMMUNIZATION_DATE"],
    "ALLERGY": ["CODE", "DESCRIPTION", "START_DATE"],
    "CAREPLAN": ["CODE", "DESCRIPTION", "START_DATE"],
}
OPEN_END_PAYLOAD = "9999-12-31T00:00:00"
DEFAULT_FIELDS = {
    "ENCOUNTER": {"REASONCODE": "N/A", "REASONDESCRIPTION": "Routine / Unspecified"},
    "OBSERVATION": {"READING_SEQ": "1"},
    "CONDITION": {"END_DATE": OPEN_END_PAYLOAD},
    "MEDICATION": {
        "END_DATE": OPEN_END_PAYLOAD,
        "REASONCODE": "N/A",
        "REASONDESCRIPTION": "Unspecified",
    },
    "PROCEDURE": {"REASONCODE": "N/A", "REASONDESCRIPTION": "Unspecified"},
    "IMMUNIZATION": {},
    "ALLERGY": {"END_DATE": OPEN_END_PAYLOAD},
    "CAREPLAN": {
        "END_DATE": OPEN_END_PAYLOAD,
        "REASONCODE": "N/A",
        "REASONDESCRIPTION": "Unspecified",
    },
}
PAYLOAD_FIELDS = [
    "ENCOUNTER_ID",
    "CAREPLAN_ID",
    "CODE",
    "DESCRIPTION",
    "REASONCODE",
    "REASONDESCRIPTION",
    "ENCOUNTER_DATE",
    "OBSERVATION_DATE",
    "PROCEDURE_DATE",
    "IMMUNIZATION_DATE",
    "START_DATE",
    "END_DATE",
    "VALUE_NUMERIC",
    "VALUE_TEXT",
    "READING_SEQ",
]
EVENT_TABLES = {
    "ENCOUNTER": "RT_ENCOUNTERS",
    "OBSERVATION": "RT_OBSERVATIONS",
    "CONDITION": "RT_CONDITIONS",
    "MEDICATION": "RT_MEDICATIONS",
    "PROCEDURE": "RT_PROCEDURES",
    "IMMUNIZATION": "RT_IMMUNIZATIONS",
    "ALLERGY": "RT_ALLERGIES",
    "CAREPLAN": "RT_CAREPLANS",
}


# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------
def _struct(columns: list[tuple[str, object]]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns])


def _strings(*names: str) -> StructType:
    return _struct([(name, StringType()) for name in names])


# Raw entities hold text only, so that blank and literal "NULL" can be compared.
RAW_SCHEMAS = {
    "patients": _strings(
        "ID", "BIRTHDATE", "DEATHDATE", "SSN", "DRIVERS", "PASSPORT", "PREFIX", "FIRST", "LAST",
        "SUFFIX", "MAIDEN", "MARITAL", "RACE", "ETHNICITY", "GENDER", "BIRTHPLACE", "ADDRESS",
    ),
    "encounters": _strings(
        "ID", "DATE", "PATIENT", "CODE", "DESCRIPTION", "REASONCODE", "REASONDESCRIPTION"
    ),
    "observations": _strings("DATE", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION", "VALUE", "UNITS"),
    "conditions": _strings("START", "STOP", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION"),
    "medications": _strings(
        "START", "STOP", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION", "REASONCODE", "REASONDESCRIPTION"
    ),
    "allergies": _strings("START", "STOP", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION"),
    "procedures": _strings(
        "DATE", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION", "REASONCODE", "REASONDESCRIPTION"
    ),
    "immunizations": _strings("DATE", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION"),
    "careplans": _strings(
        "ID", "START", "STOP", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION", "REASONCODE",
        "REASONDESCRIPTION",
    ),
}

ENVELOPE_SCHEMA = _strings("event_id", "patient_id", "event_type", "event_timestamp", "payload")
PAYLOAD_SCHEMA = _strings(*PAYLOAD_FIELDS)

_RT_HEAD = [("EVENT_ID", StringType()), ("PATIENT_ID", StringType()), ("ENCOUNTER_ID", StringType())]
_CODED = [("CODE", StringType()), ("DESCRIPTION", StringType())]
_REASON = [("REASONCODE", StringType()), ("REASONDESCRIPTION", StringType())]
_INTERVAL = [("START_DATE", TimestampType()), ("END_DATE", TimestampType())]
# EVENT_TS keeps the event time; INGESTION_TS is when the row was taken in.
_RT_TAIL = [("EVENT_TS", TimestampType()), ("INGESTION_TS", TimestampType())]

REALTIME_SCHEMAS = {
    "RT_ENCOUNTERS": _struct(
        _RT_HEAD + _CODED + _REASON + [("ENCOUNTER_DATE", TimestampType())] + _RT_TAIL
    ),
    "RT_OBSERVATIONS": _struct(
        _RT_HEAD
        + [
            ("DESCRIPTION", StringType()),
            ("OBSERVATION_DATE", DateType()),
            ("VALUE_NUMERIC", DoubleType()),
            ("VALUE_TEXT", StringType()),
            ("READING_SEQ", IntegerType()),
        ]
        + _RT_TAIL
    ),
    "RT_CONDITIONS": _struct(_RT_HEAD + _CODED + _INTERVAL + _RT_TAIL),
    "RT_MEDICATIONS": _struct(_RT_HEAD + _CODED + _REASON + _INTERVAL + _RT_TAIL),
    "RT_PROCEDURES": _struct(
        _RT_HEAD + _CODED + _REASON + [("PROCEDURE_DATE", TimestampType())] + _RT_TAIL
    ),
    "RT_IMMUNIZATIONS": _struct(_RT_HEAD + _CODED + [("IMMUNIZATION_DATE", TimestampType())] + _RT_TAIL),
    "RT_ALLERGIES": _struct(_RT_HEAD + _CODED + _INTERVAL + _RT_TAIL),
    "RT_CAREPLANS": _struct(
        _RT_HEAD + [("CAREPLAN_ID", StringType())] + _CODED + _REASON + _INTERVAL + _RT_TAIL
    ),
}

FEATURE_SCHEMA = _struct(
    [(name, DoubleType()) for name in NUMERIC_FEATURES]
    + [(name, StringType()) for name in CATEGORICAL_FEATURES]
)
