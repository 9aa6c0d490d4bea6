"""Bronze stamping and Silver cleaning: typing, defaults and reading sequence.

Narrow projections only, except the reading sequence. `as_of` fixes the load stamp so
that a rerun gives the same rows; left out, it is the time of the run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import schemas as S
from ..functions import (
    count_copies,
    hash_key,
    is_missing,
    open_end,
    parse_date,
    parse_timestamp,
    reason_defaults,
    split_row_number,
)

READING_KEYS = ["PATIENT_ID", "ENCOUNTER_ID", "CODE", "OBSERVATION_DATE", "VALUE_TEXT", "VALUE_NUMERIC"]
VISIT_KEYS = ["PATIENT_ID", "ENCOUNTER_ID", "CODE", "OBSERVATION_DATE"]
#: What readings are moved by: the pivot groups by these too and then moves nothing.
PLACE_KEYS = ["PATIENT_ID", "ENCOUNTER_ID"]


def _stamp(as_of: str | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def bronze_stamp(df: DataFrame, source: str, as_of: str | None = None) -> DataFrame:
    return df.withColumns({"INGESTION_TIMESTAMP": _stamp(as_of), "SOURCE_SYSTEM": F.lit(source)})


def _linked(df: DataFrame, own_id: str | None = None) -> DataFrame:
    names = {"PATIENT": "PATIENT_ID", "ENCOUNTER": "ENCOUNTER_ID"}
    if own_id:
        names["ID"] = own_id
    return df.withColumnsRenamed(names)


def _interval(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"START_DATE": parse_timestamp("START"), "END_DATE": open_end(parse_timestamp("STOP"))}
    ).drop("START", "STOP")


def _loaded(df: DataFrame, as_of: str | None) -> DataFrame:
    return df.withColumn("SILVER_LOAD_TIMESTAMP", _stamp(as_of))


def placeholder_fill(df: DataFrame, placeholders: dict[str, str] = S.IDENTITY_PLACEHOLDERS) -> DataFrame:
    """Missing identity columns, including the text false, become fixed placeholders."""
    return df.withColumns(
        {
            c: F.when(is_missing(c, extra=["false"]), F.lit(text)).otherwise(F.col(c))
            for c, text in placeholders.items()
            if c in df.columns
        }
    )


def patients(df: DataFrame) -> DataFrame:
    typed = df.withColumnsRenamed({"ID": "PATIENT_ID"}).withColumns(
        {
            "BIRTHDATE": parse_date("BIRTHDATE"),
            "DEATHDATE": F.when(is_missing("DEATHDATE"), F.lit(S.OPEN_END).cast("date")).otherwise(
                parse_date("DEATHDATE")
            ),
            "MARITAL": F.when(is_missing("MARITAL"), F.lit(S.MARITAL_DEFAULT)).otherwise(F.col("MARITAL")),
            "FULL_NAME": F.concat_ws(" ", "FIRST", "LAST"),
        }
    )
    return placeholder_fill(typed.drop("FIRST", "LAST"))


def encounters(df: DataFrame) -> DataFrame:
    return (
        _linked(df, "ENCOUNTER_ID")
        .withColumn("ENCOUNTER_DATE", parse_timestamp("DATE"))
        .fillna(reason_defaults(S.ENCOUNTER_REASON_TEXT_DEFAULT))
        .drop("DATE")
    )


def conditions(df: DataFrame) -> DataFrame:
    return _interval(_linked(df))


def medications(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Typed intervals; those that end before they start, or have an end but no start, go."""
    start, stop = parse_timestamp("START"), parse_timestamp("STOP")
    kept = df.filter(stop.isNull() | (stop >= start))
    return _loaded(_interval(_linked(kept)).fillna(reason_defaults()), as_of)


def split_value(df: DataFrame) -> DataFrame:
    """Typed date, and VALUE as either a number or a text."""
    numeric = F.col("VALUE").rlike(S.NUMERIC_PATTERN)
    return (
        _linked(df)
        .withColumns(
            {
                "OBSERVATION_DATE": parse_date("DATE"),
                "VALUE_TEXT": F.when(~numeric, F.col("VALUE")),
                "VALUE_NUMERIC": F.when(numeric, F.col("VALUE").try_cast("double")),
            }
        )
        .drop("DATE", "VALUE")
    )


#: Rows that share keys beyond this number are numbered in pieces.
HOT_ROWS = 1_000_000
#: Slots that readings are counted in by a hash, so that counting moves a bounded number of rows a task.
SLOTS = 65_536


def reading_seq(df: DataFrame, keys: list[str] | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Number repeated readings within `keys`, in order of ingestion.

    The order inside one ingestion time is by content hash, so it is total and repeatable. Readings
    are counted by a hash of what they are moved by, in `SLOTS` slots. Those of a slot with more than
    `hot_rows` rows may be too many for a task: their fully equal rows are counted before the shuffle
    and they are cut by hash, so no key lands whole in one task. All other readings are moved and
    numbered once, and only those whose keys occur again are hashed. Both ways give the same numbers.
    """
    keys = READING_KEYS if keys is None else keys
    place = [k for k in PLACE_KEYS if k in keys] or keys
    slot, count = "__slot", F.count(F.lit(1))
    sent = df.withColumn(slot, F.pmod(F.xxhash64(*place), F.lit(SLOTS)))
    hot = F.broadcast(sent.groupBy(slot).agg(count.alias("__n")).filter(F.col("__n") > hot_rows).select(slot))
    few, many = sent.join(hot, slot, "left_anti").drop(slot), sent.join(hot, slot, "left_semi").drop(slot)
    order = Window.partitionBy(*keys).orderBy("__at", "__h")
    again = count.over(Window.partitionBy(*keys)) > 1
    moved = few.repartition(*place).withColumn("__again", again)
    plain = _placed(moved, df.columns, F.col("__again")).withColumn("READING_SEQ", F.row_number().over(order))
    cut = _placed(count_copies(many, "__n"), df.columns).withColumn("__p", F.substring("__h", 1, 2))
    numbered = split_row_number(cut, keys, ["__at", "__p"], [F.col("__h")], "READING_SEQ", "__n")
    seq = F.col("READING_SEQ").cast("int").alias("READING_SEQ")
    return plain.select(*df.columns, seq).unionByName(numbered.select(*df.columns, seq))


def _placed(df: DataFrame, columns: list[str], needed: Column | None = None) -> DataFrame:
    """Adds what readings are ordered by: the ingestion time and, where `needed`, a hash of the content."""
    earliest = F.lit("0001-01-01").cast("timestamp")
    at = F.coalesce(F.col("INGESTION_TIMESTAMP").cast("timestamp"), earliest)
    content = hash_key(*sorted(set(columns) - {"INGESTION_TIMESTAMP"}))
    return df.withColumns({"__at": at, "__h": content if needed is None else F.when(needed, content)})


def observations(df: DataFrame, resequence: bool = False) -> DataFrame:
    """Typed readings with a sequence number; rows without any reading are left out.

    By default equal values of one visit are numbered apart. `resequence` numbers all
    readings of a visit instead, so that different values are kept apart downstream.
    Rows without a reading form their own group, so they can go before the numbering.
    """
    typed = split_value(df).dropna(how="all", subset=["VALUE_TEXT", "VALUE_NUMERIC"])
    return reading_seq(typed, VISIT_KEYS if resequence else READING_KEYS)


def procedures(df: DataFrame, as_of: str | None = None) -> DataFrame:
    typed = _linked(df).withColumn("PROCEDURE_DATE", parse_timestamp("DATE")).fillna(reason_defaults())
    return _loaded(typed.drop("DATE"), as_of)


def immunizations(df: DataFrame, as_of: str | None = None) -> DataFrame:
    typed = _linked(df).withColumn("IMMUNIZATION_DATE", parse_timestamp("DATE"))
    return _loaded(typed.drop("DATE"), as_of)


def allergies(df: DataFrame, as_of: str | None = None) -> DataFrame:
    return _loaded(_interval(_linked(df)), as_of)


def careplans(df: DataFrame, as_of: str | None = None) -> DataFrame:
    return _loaded(_interval(_linked(df, "CAREPLAN_ID")).fillna(reason_defaults()), as_of)
