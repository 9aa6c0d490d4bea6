"""Medical events: envelope, validation, defaults, routing and typed parsing.

Plain DataFrame to DataFrame functions without shuffles, so the batch path and the
stream run the same code. The payload stays JSON text in the envelope and is read once
into a struct of texts, `P`.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import hash_key, open_end, parse_date, parse_number, parse_timestamp, present

EVENT_DATE = "EVENT_DATE"
REJECT_PAYLOAD = "payload is not a JSON object"
REJECT_TYPE = "unknown event_type"
REJECT_PATIENT = "patient_id is empty"
REJECT_FIELDS = "missing required fields: "
REJECT_VALUE = "observation needs VALUE_NUMERIC or VALUE_TEXT"


RAW = "RAW"


def parse_envelope(df: DataFrame, value: str = "value", keep: Sequence[str | Column] = ()) -> DataFrame:
    """Bytes or text of one JSON envelope per row to the five envelope columns.

    `keep` names further columns to carry along, such as the text itself as RAW.
    """
    envelope = F.from_json(F.col(value).cast("string"), S.ENVELOPE_SCHEMA).alias("e")
    return df.select(envelope, *keep).select("e.*", "*").drop("e")


def serialize_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    """Envelope columns to `key` (the patient, for partition affinity) and JSON `value`.

    The payload is embedded as an object, not as quoted text, and as it was sent: a reader sees 26.0
    where 26.0 was sent. Only its line breaks, which can stand between its tokens alone, become blanks.
    """
    head = F.to_json(F.struct("event_id", "patient_id", "event_type", "event_timestamp"))
    first = F.to_json(F.try_parse_json("payload"))
    text = F.when(_is_one_value("payload"), F.translate("payload", "\r\n", "  ")).otherwise(first)
    comma = F.when(head == "{}", "").otherwise(",")
    whole = F.concat(F.substr(head, F.lit(1), F.length(head) - 1), comma, F.lit('"payload":'), text, F.lit("}"))
    return df.select(F.col("patient_id").alias("key"), F.coalesce(whole, head).alias(value))


def _is_one_value(payload: str) -> Column:
    """Whether the text is one JSON value with nothing behind it, which parsing alone leaves open.

    It is read as a field of an object with another one behind it, whose name no text can hold that
    closes the object itself.
    """
    end = F.sha2(payload, 256)
    framed = F.concat(F.lit('{"payload":'), payload, F.lit(',"'), end, F.lit('":0}'))
    names = F.map_keys(F.try_parse_json(framed).cast("map<string,variant>"))
    return F.coalesce((F.size(names) == 2) & F.array_contains(names, end), F.lit(False))


def guard(df: DataFrame) -> DataFrame:
    """Known type, patient and event id present."""
    return event_type_filter(df).filter(F.col("patient_id").isNotNull() & F.col("event_id").isNotNull())


def event_type_filter(df: DataFrame) -> DataFrame:
    return df.filter(F.col("event_type").isin(S.EVENT_TYPES))


def with_payload(df: DataFrame) -> DataFrame:
    """Adds P, the payload's fields as texts.

    It is made by a generator of one row. As a plain column it would be written out anew for each
    field that a later filter asks for, and every event parsed some fifty times.
    """
    return df.select("*", F.explode(F.array(F.from_json("payload", S.PAYLOAD_SCHEMA))).alias("P"))


def identify(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Fill a missing event id and event time.

    The id is a hash of the event, so a replay gives the same id; where nothing of the envelope
    could be read it is a hash of the RAW text, if that is carried. EVENT_TS is the typed event
    time, or `as_of` where it is absent or unreadable. EVENT_DATE is the day of the event's own
    time and null without one, so copies of an event agree on it whenever they arrive.
    """
    now = F.current_timestamp() if as_of is None else as_of
    fields = ["patient_id", "event_type", "event_timestamp", "payload"]
    hashed = hash_key(*fields)
    if RAW in df.columns:
        empty = F.coalesce(*fields).isNull()
        hashed = F.when(empty, hash_key(RAW)).otherwise(hashed)
    own_time = parse_timestamp("event_timestamp")
    return df.withColumns(
        {
            "event_id": F.when(present("event_id"), F.col("event_id")).otherwise(hashed),
            "EVENT_TS": F.coalesce(own_time, now),
            EVENT_DATE: F.to_date(own_time),
        }
    )


def _missing_fields() -> Column:
    """Required payload fields that are absent, null or blank, in their declared order."""
    by_type = None
    for event_type, fields in S.REQUIRED_FIELDS.items():
        gaps = F.array_compact(
            F.array(*[F.when(~present(F.col(f"P.{f}")), F.lit(f)) for f in fields])
        )
        test = F.col("event_type") == event_type
        by_type = F.when(test, gaps) if by_type is None else by_type.when(test, gaps)
    return F.coalesce(by_type, F.array().cast("array<string>"))


def _observation_value_ok() -> Column:
    return (
        (F.col("event_type") != "OBSERVATION")
        | F.col("P.VALUE_NUMERIC").isNotNull()
        | F.col("P.VALUE_TEXT").isNotNull()
    )


def missing_required_fields(df: DataFrame) -> DataFrame:
    """Events with gaps and their gaps, comma-joined."""
    found = with_payload(event_type_filter(df)).withColumn("MISSING_FIELDS", _missing_fields())
    return found.filter(F.size("MISSING_FIELDS") > 0).select(
        "event_id", "event_type", F.concat_ws(",", "MISSING_FIELDS").alias("MISSING_FIELDS")
    )


def invalid_patient_events(df: DataFrame) -> DataFrame:
    return df.filter(~present("patient_id"))


def observation_value_rule(df: DataFrame) -> DataFrame:
    """Each observation event with whether it carries any value."""
    return (
        with_payload(df.filter(F.col("event_type") == "OBSERVATION"))
        .withColumn("VALUE_OK", _observation_value_ok())
        .select("event_id", "VALUE_OK")
    )


def judge(df: DataFrame) -> DataFrame:
    """Add the parsed payload P and REASON, null for a valid event.

    Only the first broken rule is reported, in the order type, patient, fields, value.
    """
    checked = with_payload(df).withColumn("__gaps", _missing_fields())
    reason = (
        F.when(~F.coalesce(F.col("event_type").isin(S.EVENT_TYPES), F.lit(False)), F.lit(REJECT_TYPE))
        .when(~present("patient_id"), F.lit(REJECT_PATIENT))
        .when(
            F.size("__gaps") > 0, F.concat(F.lit(REJECT_FIELDS), F.concat_ws(",", F.col("__gaps")))
        )
        .when(~_observation_value_ok(), F.lit(REJECT_VALUE))
    )
    return checked.withColumn("REASON", reason).drop("__gaps")


def accepted(df: DataFrame) -> DataFrame:
    return judge(df).filter(F.col("REASON").isNull()).drop("REASON")


def quarantine(df: DataFrame) -> DataFrame:
    return judge(df).filter(F.col("REASON").isNotNull()).drop("P")


def _default(field: str) -> Column | None:
    chosen = None
    for event_type, defaults in S.DEFAULT_FIELDS.items():
        if field in defaults:
            test, text = F.col("event_type") == event_type, F.lit(defaults[field])
            chosen = F.when(test, text) if chosen is None else chosen.when(test, text)
    return chosen


def fill_defaults(df: DataFrame) -> DataFrame:
    """Optional payload fields of P filled by event type; a care plan takes the event id."""
    filled = []
    for field in S.PAYLOAD_FIELDS:
        value = F.col(f"P.{field}")
        if field == "CAREPLAN_ID":
            default = F.when(F.col("event_type") == "CAREPLAN", F.col("event_id"))
        else:
            default = _default(field)
        filled.append((value if default is None else F.coalesce(value, default)).alias(field))
    return df.withColumn("P", F.struct(*filled))


_JSON_MAP = "map<string,variant>"


def is_object(payload: str = "payload") -> Column:
    """Whether the payload is a readable JSON object."""
    return F.coalesce(F.schema_of_variant(F.try_parse_json(payload)).startswith("OBJECT"), F.lit(False))


def merge_defaults(df: DataFrame) -> DataFrame:
    """The payload as it was sent, with the defaults of its type where a field is absent or null.

    All other fields keep their names, values and JSON types.
    """
    defaults = F.from_json(F.lit("{}"), _JSON_MAP)
    for event_type, fields in S.DEFAULT_FIELDS.items():
        given = {k: int(v) if k == "READING_SEQ" else v for k, v in fields.items()} | {"ENCOUNTER_ID": None}
        own = F.from_json(F.lit(json.dumps(given)), _JSON_MAP)
        if event_type == "CAREPLAN":
            own = F.map_concat(own, F.create_map(F.lit("CAREPLAN_ID"), F.col("event_id").cast("variant")))
        defaults = F.when(F.col("event_type") == event_type, own).otherwise(defaults)
    sent = F.from_json("payload", _JSON_MAP)

    def missing(k: Column, v: Column) -> Column:
        return v.isNull() | F.is_variant_null(v)

    there = F.map_keys(F.map_filter(sent, lambda k, v: ~missing(k, v)))
    added = F.map_filter(defaults, lambda k, v: ~F.array_contains(there, k))
    kept = F.map_filter(sent, lambda k, v: ~F.array_contains(F.map_keys(added), k))
    texts = F.from_json("payload", "map<string,string>")

    def field(k: Column, v: Column) -> Column:
        # a variant forgets the zeros behind a number's point
        shown = F.to_json(v)
        cut = F.schema_of_variant(v).startswith("DECIMAL") & F.element_at(texts, k).contains(".") & ~shown.contains(".")
        shown = F.when(cut, F.concat(shown, F.lit(".0"))).otherwise(shown)
        return F.concat(F.to_json(k.cast("variant")), F.lit(":"), F.coalesce(shown, F.lit("null")))

    merged = F.map_concat(kept, added)
    fields = F.transform(F.map_entries(merged), lambda e: field(e["key"], e["value"]))
    payload = F.concat(F.lit("{"), F.array_join(fields, ","), F.lit("}"))
    return df.withColumn("payload", payload)


def make_observation_events(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Columns of readings to OBSERVATION events.

    Expects PATIENT_ID, DESCRIPTION, OBSERVATION_DATE and optionally VALUE_NUMERIC,
    VALUE_TEXT, ENCOUNTER_ID. Absent values stay in the payload as null. Equal readings are
    events of their own: their number goes into the id. The event time is `at`, or now.
    """
    moment = F.current_timestamp() if at is None else at
    fields = ["DESCRIPTION", "OBSERVATION_DATE", "VALUE_NUMERIC", "VALUE_TEXT", "ENCOUNTER_ID"]
    payload = F.to_json(
        F.struct(*[F.col(f) if f in df.columns else F.lit(None).cast("string").alias(f) for f in fields]),
        {"ignoreNullFields": "false"},
    )
    counted = df.select("PATIENT_ID", payload.alias("payload")).groupBy("PATIENT_ID", "payload")
    copies = counted.agg(F.count(F.lit(1)).alias("n")).withColumn("n", F.explode(F.sequence(F.lit(1), F.col("n"))))
    time = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return copies.select(
        hash_key("PATIENT_ID", "payload", time, "n").alias("event_id"),
        F.col("PATIENT_ID").alias("patient_id"),
        F.lit("OBSERVATION").alias("event_type"),
        time.alias("event_timestamp"),
        "payload",
    )


def validation_report(df: DataFrame) -> DataFrame:
    """Long table: one row per event and check with its outcome and the value it saw."""

    def check(label: str, ok: Column, detail: Column) -> Column:
        return F.struct(F.lit(label).alias("LABEL"), ok.alias("OK"), detail.alias("DETAIL"))

    dash = F.lit("—")
    known = F.coalesce(F.col("event_type").isin(S.EVENT_TYPES), F.lit(False))
    timed = present("event_timestamp")
    checks = [
        check("Event ID", present("event_id"), F.col("event_id")),
        check("Patient ID", present("patient_id"), F.when(F.col("patient_id") != "", F.col("patient_id")).otherwise(dash)),
        check("Event Type", known, F.col("event_type")),
        check("Timestamp", timed, F.when(timed, F.col("event_timestamp")).otherwise(dash)),
    ]
    required = sorted({f for fields in S.REQUIRED_FIELDS.values() for f in fields})
    for field in required:
        value = F.col(f"P.{field}")
        asks = F.col("event_type").isin([t for t, fields in S.REQUIRED_FIELDS.items() if field in fields])
        detail = F.when(value != "", value).otherwise(F.lit("missing"))
        checks.append(F.when(asks, check(f"payload.{field}", present(value), detail)))
    has_value = _observation_value_ok()
    checks.append(
        F.when(
            F.col("event_type") == "OBSERVATION",
            check(
                "At least one value",
                has_value,
                F.when(has_value, F.lit("VALUE_NUMERIC or VALUE_TEXT present")).otherwise(F.lit("both null")),
            ),
        )
    )
    return (
        with_payload(df)
        .select("event_id", F.explode(F.array_compact(F.array(*checks))).alias("c"))
        .select("event_id", "c.LABEL", "c.OK", "c.DETAIL")
    )


# ---------------------------------------------------------------------------
# Typed tables
# ---------------------------------------------------------------------------
# Encounter and care plan ids fall back to the event id; other links stay as sent.
_TYPED = {
    "ENCOUNTER_DATE": parse_timestamp,
    "PROCEDURE_DATE": parse_timestamp,
    "IMMUNIZATION_DATE": parse_timestamp,
    "OBSERVATION_DATE": parse_date,
    "START_DATE": parse_timestamp,
    "END_DATE": lambda c: open_end(parse_timestamp(c)),
    "VALUE_NUMERIC": parse_number,
    "READING_SEQ": lambda c: F.coalesce(c.try_cast("int"), F.lit(1)),
}


def parse_type(
    df: DataFrame, event_type: str, as_of: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Rows of one realtime table from envelopes that carry P and EVENT_TS; `keep` adds columns."""
    now = F.current_timestamp() if as_of is None else as_of
    schema = S.REALTIME_SCHEMAS[S.EVENT_TABLES[event_type]]
    given = {
        "EVENT_ID": F.col("event_id"),
        "PATIENT_ID": F.col("patient_id"),
        "EVENT_TS": F.col("EVENT_TS"),
        "INGESTION_TS": now,
    }
    if event_type == "ENCOUNTER":
        given["ENCOUNTER_ID"] = F.coalesce(F.col("P.ENCOUNTER_ID"), F.col("event_id"))

    if event_type == "CAREPLAN":
        given["CAREPLAN_ID"] = F.coalesce(F.col("P.CAREPLAN_ID"), F.col("event_id"))
    defaults = S.DEFAULT_FIELDS[event_type]

    def column(name: str) -> Column:
        if name in given:
            return given[name]
        value = F.col(f"P.{name}")
        if name in defaults:
            value = F.coalesce(value, F.lit(defaults[name]))
        return _TYPED[name](value) if name in _TYPED else value

    rows = df.filter(F.col("event_type") == event_type)
    return rows.select(*[column(f.name).cast(f.dataType).alias(f.name) for f in schema], *keep)


def _typed_fields() -> dict[str, tuple]:
    """Every column of the typed tables: its type and the event types that have it."""
    fields: dict[str, tuple] = {}
    for event_type, table in S.EVENT_TABLES.items():
        for f in S.REALTIME_SCHEMAS[table]:
            fields.setdefault(f.name, (f.dataType, []))[1].append(event_type)
    return fields


def parse_typed(df: DataFrame, as_of: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """All typed tables as one wide row set: TABLE_NAME and their columns, null where a table has none.

    Each event is typed once. The rows of one table, cut to its columns, are those of parse_type.
    """
    now = F.current_timestamp() if as_of is None else as_of
    kind, own_id = F.col("event_type"), F.col("event_id")
    given = {
        "EVENT_ID": own_id,
        "PATIENT_ID": F.col("patient_id"),
        "EVENT_TS": F.col("EVENT_TS"),
        "INGESTION_TS": now,
        "ENCOUNTER_ID": F.coalesce("P.ENCOUNTER_ID", F.when(kind == "ENCOUNTER", own_id)),
        "CAREPLAN_ID": F.when(kind == "CAREPLAN", F.coalesce("P.CAREPLAN_ID", own_id)),
    }

    def column(name: str, data_type, kinds: list[str]) -> Column:
        if name in given:
            return given[name].cast(data_type).alias(name)
        default = _default(name)
        text = F.col(f"P.{name}") if default is None else F.coalesce(f"P.{name}", default)
        value = _TYPED[name](text) if name in _TYPED else text
        return F.when(kind.isin(kinds), value.cast(data_type)).alias(name)

    table = F.create_map(*[F.lit(x) for pair in S.EVENT_TABLES.items() for x in pair])[kind]
    columns = [column(n, t, kinds) for n, (t, kinds) in _typed_fields().items()]
    return df.select(table.alias("TABLE_NAME"), *columns, *keep)


def ingest(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """What enters the realtime tables: named, judged, and then one row per id of the valid ones.

    Copies are dropped by their envelopes, and only what stays is parsed again.
    """
    return with_payload(dedup_events(accepted(identify(df, as_of)).drop("P")))


def realtime_tables(df: DataFrame, as_of: Column | None = None) -> dict[str, DataFrame]:
    """All eight typed tables of a set of raw envelopes."""
    good = ingest(df, as_of)
    return {table: parse_type(good, t, as_of) for t, table in S.EVENT_TABLES.items()}


def route_counts(df: DataFrame) -> DataFrame:
    """Rows per target table, in one pass."""
    target = F.create_map(*[F.lit(x) for pair in S.EVENT_TABLES.items() for x in pair])
    return (
        df.groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("ROW_COUNT"))
        .select("event_type", target[F.col("event_type")].alias("TABLE_NAME"), "ROW_COUNT")
    )


def dedup_events(df: DataFrame, arrival: str = "ARRIVAL_TS") -> DataFrame:
    """One row per id of identified events: the earliest by event time, arrival, then content.

    Events need their ids first: without, all that lack one would count as copies of another.
    min over a struct combines map-side, so many copies of one event cost one row per task.
    """
    order = _dedup_order(df, arrival)
    rest = order + [c for c in df.columns if c not in order and c != "event_id"]
    return _first_of_each(df, rest).select(*df.columns)


def _dedup_order(df: DataFrame, arrival: str) -> list[str]:
    return [c for c in ("EVENT_TS", arrival, *S.ENVELOPE_SCHEMA.names) if c in df.columns and c != "event_id"]


def _first_of_each(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy("event_id").agg(F.min(F.struct(*columns)).alias("r")).select("event_id", "r.*")


def dedup_ids(df: DataFrame, arrival: str = "ARRIVAL_TS") -> DataFrame:
    """event_id and event_type of the rows that dedup_events keeps.

    What stands behind the type in the order, the payload above all, decides among rows of one type
    only, so it is not sorted nor moved.
    """
    order = _dedup_order(df, arrival)
    return _first_of_each(df, order[: order.index("event_type") + 1]).select("event_id", "event_type")


def ingest_ids(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """event_id and event_type of the rows that ingest gives."""
    return dedup_ids(accepted(identify(df, as_of)))


def events_per_window(df: DataFrame, width: str = "1 day") -> DataFrame:
    """Arrivals per type and tumbling window of event time."""
    return (
        df.groupBy(F.window("EVENT_TS", width).alias("w"), "event_type")
        .agg(F.count(F.lit(1)).alias("EVENT_COUNT"))
        .select(F.col("w.start").alias("WINDOW_START"), "event_type", "EVENT_COUNT")
    )


def event_ids(tables: dict[str, DataFrame]) -> DataFrame:
    """All persisted event ids with the table that holds them."""
    parts = [df.select("EVENT_ID", F.lit(t).alias("TABLE_NAME")) for t, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def routed(ids: DataFrame) -> DataFrame:
    """Ids and types of events to EVENT_ID and the TABLE_NAME that stores them."""
    target = F.create_map(*[F.lit(x) for pair in S.EVENT_TABLES.items() for x in pair])
    return ids.select(F.col("event_id").alias("EVENT_ID"), target[F.col("event_type")].alias("TABLE_NAME"))


def persisted_events(
    published: DataFrame, tables: dict[str, DataFrame] | DataFrame, pending: bool = False
) -> DataFrame:
    """Published events found in the table of their type, or with `pending` those not found.

    `tables` are the stored tables, or their ids at once as event_ids gives them.
    """
    target = F.create_map(*[F.lit(x) for pair in S.EVENT_TABLES.items() for x in pair])
    wanted = published.withColumn("TABLE_NAME", target[F.upper("event_type")])
    ids = tables if isinstance(tables, DataFrame) else event_ids(tables)
    # one row per id, so that many copies of an id do not meet in one task
    stored = ids.distinct().withColumnRenamed("EVENT_ID", "event_id")
    return wanted.join(stored, ["event_id", "TABLE_NAME"], "left_anti" if pending else "left_semi")
