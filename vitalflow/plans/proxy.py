"""Clinical views over the sample tables, for the registered queries, tests and bench.

The sample tables hold no clinical data, so each raw view derives one: missing values,
malformed dates, repeated readings and broken events come from key arithmetic. The texts
are plain SQL that both Spark and the checking engine read; `{name}` stands for a table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import cohort, events, features, silver
from ..operators import gold as G
from ..session import write_through

AS_OF = "2024-06-01"
SOURCE_SYSTEM = "BATCH_1"

# One word of the item name per target
TARGET_WORDS = {
    "Diabetes": "bolt",
    "Hypertension": "gear",
    "Coronary Heart Disease": "plate",
    "Stroke": "ring",
    "Asthma": "rod",
}
TARGET_PATTERNS = {t: f"{w}$" for t, w in TARGET_WORDS.items()}

# Item type per entity
ENTITY_TYPES = {
    "conditions": "ECONOMY",
    "medications": "LARGE",
    "procedures": "STANDARD",
    "immunizations": "SMALL",
    "allergies": "MEDIUM",
    "careplans": "PROMO",
}


def _day(x: str) -> str:
    return f"CAST(CAST({x} AS DATE) AS STRING)"


_BORN = "DATE '1930-01-01' + CAST(c_custkey * 17 % 25000 AS INT)"
_K = "CAST(c_custkey AS STRING)"
PATIENTS_SQL = f"""
SELECT {_K} AS ID,
  CASE WHEN c_custkey % 97 = 5 THEN '' WHEN c_custkey % 101 = 7 THEN 'not-a-date'
       ELSE {_day(_BORN)} END AS BIRTHDATE,
  CASE c_custkey % 10 WHEN 0 THEN {_day(_BORN + ' + 20000')} WHEN 1 THEN '' WHEN 2 THEN 'NULL' END AS DEATHDATE,
  CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE '999-' || {_K} END AS SSN,
  CASE c_custkey % 4 WHEN 0 THEN 'false' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE 'S' || {_K} END AS DRIVERS,
  CASE c_custkey % 3 WHEN 0 THEN 'false' WHEN 1 THEN 'NULL' ELSE 'X' || {_K} END AS PASSPORT,
  CASE c_custkey % 6 WHEN 0 THEN 'Mr.' WHEN 1 THEN 'Mrs.' WHEN 2 THEN '' END AS PREFIX,
  split_part(c_name, '#', 1) AS FIRST,
  CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE split_part(c_name, '#', 2) END AS LAST,
  CASE c_custkey % 8 WHEN 0 THEN 'PhD' END AS SUFFIX,
  CASE c_custkey % 9 WHEN 0 THEN 'false' WHEN 1 THEN 'N' || {_K} ELSE '' END AS MAIDEN,
  CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'NULL' WHEN 2 THEN NULL ELSE c_mktsegment END AS MARITAL,
  CASE WHEN c_custkey % 53 = 0 THEN NULL WHEN c_nationkey % 5 = 0 THEN 'white' WHEN c_nationkey % 5 = 1 THEN 'black'
       WHEN c_nationkey % 5 = 2 THEN 'asian' WHEN c_nationkey % 5 = 3 THEN 'native' ELSE 'other' END AS RACE,
  CASE c_custkey % 3 WHEN 0 THEN 'hispanic' WHEN 1 THEN 'nonhispanic' END AS ETHNICITY,
  CASE WHEN c_custkey % 61 = 0 THEN '' WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS GENDER,
  'City ' || CAST(c_nationkey AS STRING) AS BIRTHPLACE,
  'Street ' || {_K} AS ADDRESS
FROM {{customer}}
"""

ENCOUNTERS_SQL = f"""
SELECT CAST(o_orderkey AS STRING) AS ID,
  CASE WHEN o_orderkey % 89 = 3 THEN 'bad' WHEN o_orderkey % 2 = 0 THEN {_day('o_orderdate')} || 'T10:30:00Z'
       ELSE {_day('o_orderdate')} END AS DATE,
  CAST(o_custkey AS STRING) AS PATIENT,
  o_orderstatus AS CODE,
  o_orderpriority AS DESCRIPTION,
  CASE WHEN o_orderstatus <> 'P' THEN 'R' || CAST(o_orderkey % 17 AS STRING) END AS REASONCODE,
  CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 19 <> 0 THEN 'Reason ' || CAST(o_orderkey % 17 AS STRING) END
    AS REASONDESCRIPTION
FROM {{orders}}
"""

OBSERVATIONS_SQL = f"""
SELECT CASE WHEN l_partkey % 103 = 1 THEN 'unknown' ELSE {_day('o_orderdate')} END AS DATE,
  CAST(o_custkey AS STRING) AS PATIENT,
  CASE WHEN l_partkey % 13 <> 0 THEN CAST(o_orderkey AS STRING) END AS ENCOUNTER,
  CASE l_linenumber WHEN 1 THEN '29463-7' WHEN 2 THEN '8302-2' WHEN 3 THEN '39156-5' WHEN 4 THEN '8480-6'
       WHEN 5 THEN '8462-4' WHEN 6 THEN '2339-0' ELSE '2093-3' END AS CODE,
  CASE l_linenumber WHEN 1 THEN 'Body Weight' WHEN 2 THEN 'Body Height' WHEN 3 THEN 'Body Mass Index'
       WHEN 4 THEN 'Systolic Blood Pressure' WHEN 5 THEN 'Diastolic Blood Pressure' WHEN 6 THEN 'Glucose'
       ELSE 'Total Cholesterol' END AS DESCRIPTION,
  CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 29 = 0 THEN '' WHEN l_returnflag = 'A' THEN 'positive'
       ELSE CAST(l_quantity AS STRING) END AS VALUE,
  CASE WHEN l_suppkey % 3 = 0 THEN 'u1' ELSE 'u2' END AS UNITS
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
"""

_LINKS = """CAST(o_custkey AS STRING) AS PATIENT,
  CASE WHEN l_partkey % 17 <> 0 THEN CAST(o_orderkey AS STRING) END AS ENCOUNTER,
  p_brand AS CODE, p_name AS DESCRIPTION"""
_SPAN = f"""CASE WHEN l_partkey % 109 = 2 THEN 'n/a' ELSE {_day('o_orderdate')} END AS START,
  CASE WHEN l_linestatus <> 'O' THEN {_day('l_shipdate')} END AS STOP"""
_WHEN = f"CASE WHEN l_partkey % 109 = 2 THEN 'n/a' ELSE {_day('o_orderdate')} END AS DATE"
_WHY = """CASE WHEN l_suppkey % 4 <> 0 THEN 'R' || CAST(l_suppkey % 13 AS STRING) END AS REASONCODE,
  CASE WHEN l_suppkey % 5 <> 0 THEN 'Reason ' || CAST(l_suppkey % 13 AS STRING) END AS REASONDESCRIPTION"""
_PLAN_ID = "CAST(o_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS ID"

_VISITS = "{lineitem} JOIN {orders} ON l_orderkey = o_orderkey"
_LINES = f"{_VISITS} JOIN {{part}} ON l_partkey = p_partkey"
# the lines that observations and entities start from
_ALL_LINES = f"""
SELECT o_custkey, o_orderkey, o_orderdate, l_partkey, l_suppkey, l_linenumber, l_linestatus, l_shipdate, l_quantity, l_returnflag
FROM {_VISITS}
"""
_TYPED_LINES = """
SELECT o_custkey, o_orderkey, o_orderdate, l_partkey, l_suppkey, l_linenumber, l_linestatus, l_shipdate, p_type, p_brand, p_name
FROM {{visits}} JOIN {{part}} ON l_partkey = p_partkey
WHERE p_type IN ({types})
"""
# the same rows, those of some items: the items go first, so that fewer lines meet the orders
_SOME_LINES = """
SELECT o_custkey, o_orderkey, o_orderdate, l_partkey, l_suppkey, l_linenumber, l_linestatus, l_shipdate, p_type, p_brand, p_name
FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey JOIN {{orders}} ON l_orderkey = o_orderkey
WHERE p_type IN ({types})
"""


def _entity(entity: str, columns: list[str]) -> str:
    return f"""
SELECT {', '.join(columns)}
FROM {_LINES}
WHERE p_type = '{ENTITY_TYPES[entity]}'
"""


_EVENT_DAY = "CAST(CAST(ts AS DATE) AS STRING)"
_E = "CAST(event_id AS STRING)"
_DATE_KEY = """CASE event_id % 9 WHEN 0 THEN 'ENCOUNTER_DATE' WHEN 1 THEN 'OBSERVATION_DATE' WHEN 4 THEN 'PROCEDURE_DATE'
       WHEN 5 THEN 'IMMUNIZATION_DATE' ELSE 'START_DATE' END"""
_MEASURE = """CASE CAST((event_id - event_id % 9) / 9 AS BIGINT) % 7 WHEN 0 THEN 'body weight' WHEN 1 THEN 'Body Height'
       WHEN 2 THEN 'Body Mass Index' WHEN 3 THEN 'Systolic Blood Pressure' WHEN 4 THEN 'Diastolic Blood Pressure'
       WHEN 5 THEN 'GLUCOSE' ELSE 'Total Cholesterol' END"""
_PAYLOAD = f"""CASE WHEN event_id % 501 = 0 THEN '{{{{broken' ELSE '{{{{'
  || CASE WHEN event_id % 23 = 0 THEN '' ELSE '"CODE":"C' || CAST(event_id % 50 AS STRING) || '",' END
  || CASE WHEN event_id % 29 = 0 THEN '"DESCRIPTION":"  ",' WHEN event_id % 31 = 0 THEN '"DESCRIPTION":null,'
          WHEN event_id % 9 = 1 THEN '"DESCRIPTION":"' || {_MEASURE} || '",'
          ELSE '"DESCRIPTION":"Item ' || CAST(event_id % 40 AS STRING) || '",' END
  || CASE WHEN event_id % 59 = 0 THEN '' WHEN event_id % 61 = 0 THEN '"' || {_DATE_KEY} || '":"soon",'
          ELSE '"' || {_DATE_KEY} || '":"' || {_EVENT_DAY} || '",' END
  || CASE WHEN event_id % 9 IN (2, 3, 6, 7) AND event_id % 2 = 0 THEN '"END_DATE":"' || {_EVENT_DAY} || 'T23:00:00",' ELSE '' END
  || CASE WHEN event_id % 9 = 1 AND event_id % 5 <> 0 THEN '"VALUE_NUMERIC":' || CAST(value AS STRING) || ',' ELSE '' END
  || CASE WHEN event_id % 9 = 1 AND event_id % 7 = 0 THEN '"VALUE_TEXT":"seen",' ELSE '' END
  || CASE WHEN event_id % 9 = 1 AND event_id % 4 = 0 THEN '"READING_SEQ":2,' ELSE '' END
  || CASE WHEN event_id % 3 = 0 THEN '"REASONCODE":"RC","REASONDESCRIPTION":"Follow-up",' ELSE '' END
  || CASE WHEN event_id % 6 = 0 THEN '"ENCOUNTER_ID":"n' || CAST(event_id % 300 AS STRING) || '",' ELSE '' END
  || CASE WHEN event_id % 9 = 7 AND event_id % 4 = 0 THEN '"CAREPLAN_ID":"cp' || {_E} || '",' ELSE '' END
  || '"SEEN":true}}}}' END"""
EVENTS_SQL = f"""
WITH numbered AS (
  SELECT event_id, user_id, value, ts FROM {{events}}
  UNION ALL
  SELECT event_id, user_id, value, ts FROM {{events}} WHERE event_id % 100 = 3
)
SELECT CASE WHEN event_id % 211 = 0 THEN '' ELSE 'e' || {_E} END AS event_id,
  CASE WHEN event_id % 37 = 1 THEN NULL WHEN event_id % 41 = 2 THEN '   ' ELSE CAST(user_id AS STRING) END AS patient_id,
  CASE event_id % 9 WHEN 0 THEN 'ENCOUNTER' WHEN 1 THEN 'OBSERVATION' WHEN 2 THEN 'CONDITION' WHEN 3 THEN 'MEDICATION'
       WHEN 4 THEN 'PROCEDURE' WHEN 5 THEN 'IMMUNIZATION' WHEN 6 THEN 'ALLERGY' WHEN 7 THEN 'CAREPLAN'
       ELSE 'LAB_RESULT' END AS event_type,
  CASE WHEN event_id % 43 = 4 THEN '' WHEN event_id % 47 = 0 THEN 'garbled'
       ELSE replace(CAST(date_trunc('second', ts) AS STRING), ' ', 'T') || 'Z' END AS event_timestamp,
  {_PAYLOAD} AS payload
FROM numbered
"""

EVENTS_ARRIVED_SQL = EVENTS_SQL + "WHERE event_id % 10 NOT IN (0, 3, 6)\n"

_TARGET_OF = """CASE event_type WHEN 'view' THEN 'Diabetes' WHEN 'click' THEN 'Hypertension'
       WHEN 'purchase' THEN 'Coronary Heart Disease' WHEN 'signup' THEN 'Stroke' ELSE 'Asthma' END"""
SCORES_SQL = f"""
SELECT event_id AS ITEM_ID, {_TARGET_OF} AS TARGET_NAME,
  CASE WHEN event_id * 7 % 10 < 3 THEN 1 ELSE 0 END AS LABEL,
  least(value / 200, CAST(1 AS DOUBLE)) AS PROBABILITY
FROM {{events}}
"""


def _snapshot(side: int) -> str:
    return f"""
SELECT CAST(user_id AS STRING) AS PATIENT_ID, {_TARGET_OF} AS TARGET_NAME,
  max(CASE WHEN event_id % 2 = {side} THEN least(value / 200, CAST(1 AS DOUBLE)) END) AS PROBABILITY
FROM {{events}} GROUP BY 1, 2
"""


RAW_SQL = {
    "patients_raw": PATIENTS_SQL,
    "encounters_raw": ENCOUNTERS_SQL,
    "observations_raw": OBSERVATIONS_SQL,
    "conditions_raw": _entity("conditions", [_SPAN, _LINKS]),
    "medications_raw": _entity("medications", [_SPAN, _LINKS, _WHY]),
    "procedures_raw": _entity("procedures", [_WHEN, _LINKS, _WHY]),
    "immunizations_raw": _entity("immunizations", [_WHEN, _LINKS]),
    "allergies_raw": _entity("allergies", [_SPAN, _LINKS]),
    "careplans_raw": _entity("careplans", [_PLAN_ID, _SPAN, _LINKS, _WHY]),
    "events_raw": EVENTS_SQL,
    "events_arrived": EVENTS_ARRIVED_SQL,
    "scores": SCORES_SQL,
    "risk_before": _snapshot(0),
    "risk_after": _snapshot(1),
}
TABLES = ["customer", "orders", "lineitem", "part", "events"]


class Lazy(Mapping):
    """A mapping whose DataFrames are declared on first use."""

    def __init__(self, names: Iterable[str], build: Callable[[str], DataFrame]):
        self._names, self._build, self._made = list(names), build, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._made:
            self._made[name] = self._build(name)
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class Clinic:
    """All views over one folder of sample tables, built lazily.

    What several views of a query start from is written once to the shared folder: the lines of the
    entities named in `joined`, the lines with their orders where it names observations, the events
    that are kept, and the index dates of a labelled table; with `keep_readings` the wide readings too.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, joined: Iterable[str] = (), keep_readings: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.joined = tuple(joined)
        self.keep_readings = keep_readings
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def files(self) -> list[tuple[str, int, int]]:
        """Name, size and time of change of every file of the tables, which change with the data."""
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path
        conf, out = self.spark._jsc.hadoopConfiguration(), []
        for name in TABLES:
            for file in self.table(name).inputFiles():
                at = fs_path(file)
                status = at.getFileSystem(conf).getFileStatus(at)
                out.append((file, status.getLen(), status.getModificationTime()))
        return sorted(out)

    def view(self, name: str) -> DataFrame:
        text = RAW_SQL[name]
        used = {t: self.table(t) for t in TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)

    @cached_property
    def lines(self) -> DataFrame:
        types = ", ".join(f"'{ENTITY_TYPES[e]}'" for e in self.joined if e in ENTITY_TYPES)
        if "observations" in self.joined:
            text, used = _TYPED_LINES, {"visits": self.visits, "part": self.table("part")}
        else:
            text, used = _SOME_LINES, {t: self.table(t) for t in ("lineitem", "part", "orders")}
        return write_through(self.spark.sql(text.format(types=types), **used), "lines")

    @cached_property
    def visits(self) -> DataFrame:
        used = {t: self.table(t) for t in ("lineitem", "orders")}
        return write_through(self.spark.sql(_ALL_LINES, **used), "visits")

    def raw(self, entity: str) -> DataFrame:
        if entity == "observations" and entity in self.joined:
            return self.spark.sql(OBSERVATIONS_SQL.replace(_VISITS, "{visits}"), visits=self.visits)
        if entity in self.joined:
            return self.spark.sql(RAW_SQL[f"{entity}_raw"].replace(_LINES, "{lines}"), lines=self.lines)
        return self.view(f"{entity}_raw")

    def bronze(self, entity: str) -> DataFrame:
        return silver.bronze_stamp(self.raw(entity), SOURCE_SYSTEM, AS_OF)

    def silver(self, entity: str) -> DataFrame:
        return G.SILVER_FROM_BRONZE[entity](self.bronze(entity), AS_OF)

    @cached_property
    def gold(self) -> Mapping[str, DataFrame]:
        def build(entity: str) -> DataFrame:
            made = G.GOLD_FROM_SILVER[entity](self.silver(entity))
            return write_through(made, "readings") if self.keep_readings and entity == "observations" else made

        return Lazy(S.ENTITIES, build)

    @property
    def patients(self) -> DataFrame:
        return self.gold["patients"]

    @property
    def events(self) -> DataFrame:
        return self.view("events_raw")

    @property
    def now(self):
        return F.lit(AS_OF).cast("timestamp")

    @cached_property
    def rt(self) -> Mapping[str, DataFrame]:
        return self._typed(self.events)

    @cached_property
    def arrived(self) -> DataFrame:
        """Ids and tables of what is stored while some published events are still on their way."""
        return events.routed(events.ingest_ids(self.view("events_arrived"), self.now))

    def _typed(self, raw: DataFrame) -> Mapping[str, DataFrame]:
        kept: list[DataFrame] = []
        kinds = {table: t for t, table in S.EVENT_TABLES.items()}

        def table(name: str) -> DataFrame:
            if not kept:
                kept.append(write_through(events.ingest(raw, self.now).drop("P"), "events"))
            of_kind = kept[0].filter(F.col("event_type") == kinds[name])
            return events.parse_type(events.with_payload(of_kind), kinds[name], self.now)

        return Lazy(S.REALTIME_SCHEMAS, table)

    @cached_property
    def features(self) -> DataFrame:
        return features.patient_features(self.patients, self.gold, self.rt, AS_OF)

    @cached_property
    def dates(self) -> DataFrame:
        return cohort.index_dates(self.gold["conditions"], TARGET_PATTERNS)

    @cached_property
    def long(self) -> DataFrame:
        return self.labelled(S.TARGETS)

    def labelled(self, targets: list[str]) -> DataFrame:
        dates = write_through(self.dates, "index-dates")
        return cohort.features_targets_long(self.patients, dates, self.gold, self.rt, targets)
