"""Labelled cohorts: index dates, risk-set control sampling and the long training table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import schemas as S
from ..functions import hash_key, is_missing, split_row_number
from .features import Tables, age_safety, features_at

AGE_BAND_YEARS = 10


def index_dates(conditions: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """First diagnosis day per patient and target; `patterns` maps targets to regexes.

    A condition may belong to several targets. min combines map-side.
    """
    hits = F.array_compact(
        F.array(*[F.when(F.col("DESCRIPTION").rlike(p), F.lit(t)) for t, p in patterns.items()])
    )
    return (
        conditions.filter(F.col("START_DATE").isNotNull() & F.col("PATIENT_ID").isNotNull())
        .select("PATIENT_ID", F.to_date("START_DATE").alias("D"), F.explode(hits).alias("TARGET_NAME"))
        .groupBy("PATIENT_ID", "TARGET_NAME")
        .agg(F.min("D").alias("INDEX_DATE"))
    )


def _people(patients: DataFrame, dates: DataFrame, targets: list[str]) -> DataFrame:
    """Every patient once per target with stratum, hash and the day of leaving the risk set.

    A patient leaves it with the diagnosis or with death, whichever comes first.
    """
    stratum = F.concat_ws(
        "|", "GENDER", F.floor(F.year("BIRTHDATE") / AGE_BAND_YEARS).cast("string")
    )
    usable = patients.filter(~is_missing("GENDER") & F.col("BIRTHDATE").isNotNull())
    people = usable.select(
        "PATIENT_ID",
        "DEATHDATE",
        stratum.alias("STRATUM"),
        F.explode(F.array(*[F.lit(t) for t in targets])).alias("TARGET_NAME"),
    )
    end = F.lit(S.OPEN_END).cast("date")
    hashed = hash_key("TARGET_NAME", "PATIENT_ID")
    return people.join(dates, ["PATIENT_ID", "TARGET_NAME"], "left").select(
        "PATIENT_ID",
        "TARGET_NAME",
        "STRATUM",
        "INDEX_DATE",
        F.least(F.coalesce("INDEX_DATE", end), F.coalesce("DEATHDATE", end)).alias("DAY"),
        hashed.alias("H"),
        F.substring(hashed, 1, 2).alias("HP"),
    )


def matched_controls(
    patients: DataFrame,
    dates: DataFrame,
    targets: list[str] = S.TARGETS,
    per_case: int = 1,
) -> DataFrame:
    """Incidence-density sampling: up to `per_case` controls for each case.

    A control shares gender and ten-year birth band, is alive on the case's index date and has
    no diagnosis on or before it; a later case may serve. It inherits the date. Patients of a
    stratum stand in a line by the day they leave the risk set, so the risk set of a case is
    the tail of its line behind its index date, and a control is looked up by position: a
    start drawn from the case's hash, then the following places, wrapping round. No pairs are
    formed.
    """
    people = _people(patients, dates, targets)
    line = ["TARGET_NAME", "STRATUM"]
    ill = people.filter(F.col("INDEX_DATE").isNotNull())
    # how many have left by each day that occurs, as such a day or as an index date
    leaving = people.groupBy(*line, "DAY").agg(F.count(F.lit(1)).alias("n"))
    asked = ill.select(*line, F.col("INDEX_DATE").alias("DAY")).distinct().withColumn("n", F.lit(0))
    per_day = leaving.unionByName(asked).groupBy(*line, "DAY").agg(F.sum("n").alias("n"))
    # one row per day of a stratum: bounded by the calendar
    days = Window.partitionBy(*line)
    so_far = days.orderBy("DAY").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = per_day.select(
        *line, F.col("DAY").alias("INDEX_DATE"), F.sum("n").over(so_far).alias("LAST"), F.sum("n").over(days).alias("SIZE")
    )
    cases = ill.join(sizes, [*line, "INDEX_DATE"])
    free = F.col("SIZE") - F.col("LAST")
    start = F.conv(F.substring("H", 1, 8), 16, 10).cast("bigint")
    draws = (
        cases.filter(free > 0)
        .withColumn("J", F.explode(F.sequence(F.lit(0), F.lit(per_case - 1))))
        .filter(F.col("J") < free)
        .select(
            *line,
            F.col("PATIENT_ID").alias("CASE_ID"),
            "INDEX_DATE",
            (F.col("LAST") + 1 + F.pmod(start + F.col("J"), free)).alias("POS"),
        )
    )
    numbered = split_row_number(people, line, ["DAY", "HP"], [F.col("H"), F.col("PATIENT_ID")], "POS")
    pool = numbered.select(*line, "POS", F.col("PATIENT_ID").alias("CONTROL_ID"))
    return draws.join(pool, [*line, "POS"]).select("TARGET_NAME", "CASE_ID", "CONTROL_ID", "INDEX_DATE")


def labels(patients: DataFrame, dates: DataFrame, targets: list[str] = S.TARGETS, per_case: int = 1) -> DataFrame:
    """Cases with label 1 and their controls with label 0, each with its index date."""
    asked = dates.filter(F.col("TARGET_NAME").isin(list(targets)))
    known = asked.join(patients.select("PATIENT_ID"), "PATIENT_ID", "left_semi")
    cases = known.select("PATIENT_ID", "TARGET_NAME", F.lit(1).alias("LABEL"), "INDEX_DATE")
    controls = matched_controls(patients, dates, targets, per_case).select(
        F.col("CONTROL_ID").alias("PATIENT_ID"), "TARGET_NAME", F.lit(0).alias("LABEL"), "INDEX_DATE"
    )
    return cases.unionByName(controls.distinct())


def features_targets_long(
    patients: DataFrame,
    dates: DataFrame,
    gold: Tables,
    rt: Tables,
    targets: list[str] = S.TARGETS,
    per_case: int = 1,
    buffer_days: int = 0,
) -> DataFrame:
    """The labelled long table: metadata columns and the feature row before the index date.

    A patient's targets and labels of one date travel together through the running sums, at most
    two per target.
    """
    label = F.struct("TARGET_NAME", "LABEL")
    marks = labels(patients, dates, targets, per_case).groupBy("PATIENT_ID", "INDEX_DATE").agg(
        F.collect_list(label).alias("MARKED")
    )
    rows = features_at(marks, patients, gold, rt, buffer_days).withColumn("M", F.explode("MARKED"))
    return rows.select("*", "M.*").select(*S.LABEL_METADATA, *S.FEATURES)


def features_for_target(long: DataFrame, target: str) -> DataFrame:
    """One target's rows with the age rule; prunes partitions when stored by TARGET_NAME.

    Where the table is not stored, features_targets_long with this target alone builds no others.
    """
    return age_safety(long.filter(F.col("TARGET_NAME") == target))
