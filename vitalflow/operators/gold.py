"""Gold: column pruning, the measurement pivot, text lists per encounter and the wide table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from . import silver

READING_BASE = ["PATIENT_ID", "ENCOUNTER_ID", "OBSERVATION_DATE", "READING_SEQ"]


def prune(df: DataFrame, columns: Sequence[str] = S.LOAD_METADATA) -> DataFrame:
    """Drop those of `columns` that exist."""
    return df.drop(*[c for c in columns if c in df.columns])


def patients(df: DataFrame) -> DataFrame:
    return prune(df, S.PII_COLUMNS + S.BRONZE_METADATA)


def actual_value(df: DataFrame) -> DataFrame:
    """One text reading: the number as text, else the text."""
    return df.withColumn(
        "ACTUAL_VALUE", F.coalesce(F.col("VALUE_NUMERIC").cast("string"), F.col("VALUE_TEXT"))
    )


def reading_base(df: DataFrame) -> DataFrame:
    return df.select(*READING_BASE).distinct()


def _cell(measurement: str, resolve: str) -> Column:
    value = F.when(F.col("DESCRIPTION") == measurement, F.col("ACTUAL_VALUE"))
    if resolve == "min":
        return F.min(value).alias(measurement)
    if resolve == "latest":
        rank = F.when(
            F.col("DESCRIPTION") == measurement, F.struct("INGESTION_TIMESTAMP", "ACTUAL_VALUE")
        )
        return F.max_by(value, rank).alias(measurement)
    raise ValueError(f"resolve must be min or latest, not {resolve}")


def observations_pivot(df: DataFrame, resolve: str = "min") -> DataFrame:
    """One row per reading with one column per known measurement."""
    known = actual_value(df).filter(F.col("DESCRIPTION").isin(S.MEASUREMENTS))
    return known.groupBy(*READING_BASE).agg(*[_cell(m, resolve) for m in S.MEASUREMENTS])


def observations(df: DataFrame, resolve: str = "min", strict_join: bool = False) -> DataFrame:
    """Every reading with its measurements, `Not Recorded` where there is none.

    One conditional aggregation gives the base rows and the pivot together. It combines
    map-side and keeps readings without an encounter. `strict_join` joins base and pivot
    instead, where a missing encounter never matches.
    """
    if strict_join:
        wide = reading_base(df).join(observations_pivot(df, resolve), READING_BASE, "left")
    else:
        wide = actual_value(df).groupBy(*READING_BASE).agg(*[_cell(m, resolve) for m in S.MEASUREMENTS])
    return wide.fillna(S.NOT_RECORDED, subset=S.MEASUREMENTS)


def descriptions_per_encounter(df: DataFrame, name: str) -> DataFrame:
    """All descriptions of an encounter in sorted order, joined to one text.

    Rows without an encounter belong to no list.

    Repeats are counted before the shuffle, so the list gathered per encounter holds
    distinct descriptions only and is written out once.
    """
    counted = df.filter(F.col("ENCOUNTER_ID").isNotNull()).groupBy("ENCOUNTER_ID", "DESCRIPTION").agg(
        F.count(F.lit(1)).cast("int").alias("__n")
    )
    lists = counted.groupBy("ENCOUNTER_ID").agg(
        F.sort_array(F.collect_list(F.struct("DESCRIPTION", "__n"))).alias("__d")
    )
    repeated = F.flatten(F.transform("__d", lambda d: F.array_repeat(d["DESCRIPTION"], d["__n"])))
    return lists.select("ENCOUNTER_ID", F.concat_ws(S.LIST_SEPARATOR, repeated).alias(name))


def conditions_per_encounter(df: DataFrame) -> DataFrame:
    return descriptions_per_encounter(df, "ALL_CONDITIONS")


def medications_per_encounter(df: DataFrame) -> DataFrame:
    return descriptions_per_encounter(df, "ALL_MEDICATIONS")


def obt_patient_encounters(
    encounters: DataFrame,
    patients_gold: DataFrame,
    observations_gold: DataFrame,
    conditions: DataFrame,
    medications: DataFrame,
) -> DataFrame:
    """Encounters with patient, readings, conditions and medications.

    Grain: one row per encounter and reading. The two text lists join on the encounter
    first, so encounters move once for both. The reading join is written as an inner join
    plus the encounters without readings: in that form adaptive execution may split a hot
    encounter on the reading side, which it cannot do for a left outer join.
    """
    known = F.col("ENCOUNTER_ID").isNotNull()
    wide = (
        encounters.join(conditions_per_encounter(conditions), "ENCOUNTER_ID", "left")
        .join(medications_per_encounter(medications), "ENCOUNTER_ID", "left")
        .join(patients_gold, "PATIENT_ID", "left")
        .fillna({"ALL_CONDITIONS": S.NO_CONDITIONS, "ALL_MEDICATIONS": S.NO_MEDICATIONS})
    )
    keys = ["PATIENT_ID", "ENCOUNTER_ID"]
    readings = observations_gold.filter(F.col("PATIENT_ID").isNotNull() & known)
    with_reading = wide.join(readings, keys, "inner")
    without = wide.join(readings.select(*keys).distinct(), keys, "left_anti")
    return with_reading.unionByName(without, allowMissingColumns=True)


GOLD_FROM_SILVER = {
    "patients": patients,
    "encounters": prune,
    "observations": observations,
    "conditions": prune,
    "medications": prune,
    "procedures": prune,
    "immunizations": prune,
    "allergies": prune,
    "careplans": prune,
}
SILVER_FROM_BRONZE = {
    "patients": lambda df, as_of: silver.patients(df),
    "encounters": lambda df, as_of: silver.encounters(df),
    "observations": lambda df, as_of: silver.observations(df),
    "conditions": lambda df, as_of: silver.conditions(df),
    "medications": silver.medications,
    "procedures": silver.procedures,
    "immunizations": silver.immunizations,
    "allergies": silver.allergies,
    "careplans": silver.careplans,
}
