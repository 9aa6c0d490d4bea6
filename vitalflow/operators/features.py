"""The 18-column feature row for every patient in one job, live or as of a date.

Every fact becomes a *contribution*: a patient, a day and additive numbers. Distinct
codes are additive too once each code counts on its first day. Live features add up all
contributions; as-of features add up those before an index date.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import schemas as S
from ..functions import parse_number

Tables = Mapping[str, DataFrame]

_PARTS = [f"{side}_{f}" for f in S.VITAL_FEATURES for side in ("SUM", "N")] + S.COUNT_FEATURES


def _contribution(df: DataFrame, day: Column, given: dict[str, Column]) -> DataFrame:
    def part(name: str) -> Column:
        kind = "double" if name.startswith("SUM_") else "bigint"
        return given.get(name, F.lit(None)).cast(kind).alias(name)

    return df.select("PATIENT_ID", day.alias("FACT_DATE"), *[part(p) for p in _PARTS])


def _vital_parts(values: dict[str, Column]) -> dict[str, Column]:
    sums = {f"SUM_{f}": v for f, v in values.items()}
    counts = {f"N_{f}": F.when(v.isNotNull(), F.lit(1)) for f, v in values.items()}
    return {**sums, **counts}


def _vital_sources(gold: Tables, rt: Tables) -> list[DataFrame]:
    one = {"OBSERVATION_COUNT": F.lit(1)}
    # most cells say that nothing was recorded, and a text that is no number is slow to parse
    cells = {f: F.col(f"`{m}`") for f, m in S.VITAL_FEATURES.items()}
    wide = {f: F.when(c != S.NOT_RECORDED, parse_number(c)) for f, c in cells.items()}
    hist = _contribution(gold["observations"], F.col("OBSERVATION_DATE"), {**_vital_parts(wide), **one})
    name = F.upper("DESCRIPTION")
    long = {f: F.when(name == m.upper(), F.col("VALUE_NUMERIC")) for f, m in S.VITAL_FEATURES.items()}
    return [hist, _contribution(rt["RT_OBSERVATIONS"], F.col("OBSERVATION_DATE"), {**_vital_parts(long), **one})]


def vital_contributions(gold: Tables, rt: Tables) -> DataFrame:
    """Wide historical rows and long realtime rows, both as vital sums and counts."""
    return reduce(DataFrame.unionByName, _vital_sources(gold, rt))


def _first_codes(hist: DataFrame, live: DataFrame, feature: str) -> DataFrame:
    columns = ["PATIENT_ID", "CODE", F.to_date("START_DATE").alias("D")]
    united = hist.select(*columns).unionByName(live.select(*columns))
    firsts = united.filter(F.col("CODE").isNotNull()).groupBy("PATIENT_ID", "CODE").agg(F.min("D").alias("D"))
    return _contribution(firsts, F.col("D"), {feature: F.lit(1)})


#: Of each count of distinct codes the historical and the realtime table.
_CODES = {
    "DISTINCT_CONDITION_COUNT": ("conditions", "RT_CONDITIONS"),
    "DISTINCT_MEDICATION_COUNT": ("medications", "RT_MEDICATIONS"),
}


def _visit_sources(gold: Tables, rt: Tables) -> list[DataFrame]:
    visits = [gold["encounters"], rt["RT_ENCOUNTERS"]]
    return [_contribution(v, F.to_date("ENCOUNTER_DATE"), {"TOTAL_ENCOUNTERS": F.lit(1)}) for v in visits]


def activity_contributions(gold: Tables, rt: Tables) -> DataFrame:
    firsts = [_first_codes(gold[hist], rt[live], feature) for feature, (hist, live) in _CODES.items()]
    return reduce(DataFrame.unionByName, [*_visit_sources(gold, rt), *firsts])


def contributions(gold: Tables, rt: Tables) -> DataFrame:
    return vital_contributions(gold, rt).unionByName(activity_contributions(gold, rt))


def _add_up(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(p).alias(p) for p in _PARTS])


def _averages() -> list[Column]:
    return [
        F.when(F.col(f"N_{f}") > 0, F.col(f"SUM_{f}") / F.col(f"N_{f}")).alias(f) for f in S.VITAL_FEATURES
    ]


def _flags() -> list[Column]:
    feature = {m: f for f, m in S.VITAL_FEATURES.items()}
    return [
        F.when(F.col(f"N_{feature[m]}") > 0, 1.0).otherwise(0.0).alias(flag)
        for flag, m in S.FLAG_FEATURES.items()
    ]


def _counts() -> list[Column]:
    return [F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in S.COUNT_FEATURES]


def vital_averages(gold: Tables, rt: Tables) -> DataFrame:
    """Average over all readings of both sources together; null without any."""
    return _add_up(vital_contributions(gold, rt), ["PATIENT_ID"]).select("PATIENT_ID", *_averages())


def reading_flags(gold: Tables, rt: Tables) -> DataFrame:
    return _add_up(vital_contributions(gold, rt), ["PATIENT_ID"]).select("PATIENT_ID", *_flags())


def activity_counts(gold: Tables, rt: Tables) -> DataFrame:
    return _add_up(contributions(gold, rt), ["PATIENT_ID"]).select("PATIENT_ID", *_counts())


def age_in_years(day: Column) -> Column:
    return F.date_diff(day, F.col("BIRTHDATE")) / F.lit(S.DAYS_PER_YEAR)


def age_at_index(patients: DataFrame, as_of: str) -> DataFrame:
    age = age_in_years(F.lit(as_of).cast("date"))
    return patients.select("PATIENT_ID", age.alias("AGE_AT_INDEX"))


def _categories() -> list[Column]:
    """NULL or blank becomes unknown; for MARITAL it becomes UNKNOWN."""
    return [
        F.when(F.col(c) != "", F.col(c))
        .otherwise(F.lit(S.MARITAL_DEFAULT if c == "MARITAL" else S.CATEGORY_DEFAULT))
        .alias(c)
        for c in S.CATEGORICAL_FEATURES
    ]


def patient_categories(patients: DataFrame) -> DataFrame:
    """PATIENT_ID and the categorical features, which come from the patient alone."""
    return patients.select("PATIENT_ID", *_categories())


def _rows(df: DataFrame, age: Column, keep: Sequence[str]) -> DataFrame:
    typed = df.select(
        *keep, age.alias("AGE_AT_INDEX"), *_averages(), *_counts(), *_flags(), *_categories()
    )
    return typed.select(*keep, *S.FEATURES)


def _sums_side_by_side(patients: DataFrame, gold: Tables, rt: Tables) -> DataFrame:
    """The patients with the sums of each source joined to them one after the other.

    Over tables that are stored by patient with one number of buckets nothing is moved: each source
    is added up where it lies and joined where it lies.
    """
    wide, sources = patients, [*_vital_sources(gold, rt), *_visit_sources(gold, rt)]
    for i, source in enumerate(sources):
        sums = _add_up(source, ["PATIENT_ID"]).withColumnsRenamed({p: f"{p}_{i}" for p in _PARTS})
        wide = wide.join(sums, "PATIENT_ID", "left")
    total = {p: reduce(Column.__add__, [F.coalesce(f"{p}_{i}", F.lit(0)) for i in range(len(sources))]) for p in _PARTS}
    for feature, (hist, live) in _CODES.items():
        # a patient's distinct codes are bounded by the codes that there are
        for side, table in (("H", gold[hist]), ("L", rt[live])):
            wide = wide.join(table.groupBy("PATIENT_ID").agg(F.collect_set("CODE").alias(f"{feature}_{side}")), "PATIENT_ID", "left")
        sides = [F.coalesce(f"{feature}_{side}", F.array().cast("array<string>")) for side in "HL"]
        total[feature] = F.size(F.array_union(*sides))
    return wide.select(*patients.columns, *[c.alias(p) for p, c in total.items()])


def patient_features(
    patients: DataFrame, gold: Tables, rt: Tables, as_of: str, stored_by_patient: bool = False
) -> DataFrame:
    """PATIENT_ID and the full feature row for every patient, over all data.

    The contributions of all sources are added up in one shuffle; with `stored_by_patient` each source
    is added up by itself, in none.
    """
    age = age_in_years(F.lit(as_of).cast("date"))
    if stored_by_patient:
        return _rows(_sums_side_by_side(patients, gold, rt), age, ["PATIENT_ID"])
    facts = _add_up(contributions(gold, rt), ["PATIENT_ID"])
    return _rows(patients.join(facts, "PATIENT_ID", "left"), age, ["PATIENT_ID"])


def features_at(
    marks: DataFrame,
    patients: DataFrame,
    gold: Tables,
    rt: Tables,
    buffer_days: int = 0,
) -> DataFrame:
    """Feature rows for each row of `marks`, from facts strictly before its INDEX_DATE.

    Other columns of `marks` are kept. Facts are added up per patient and day and stand in one line
    with the marks, each mark before the facts of its day; one running sum per patient is read off
    at the marks. A patient's line holds a row per day and mark, so its length is bounded by the
    calendar, and no day is joined with a date.
    """
    kept = [c for c in marks.columns if c != "PATIENT_ID"]
    daily = _add_up(contributions(gold, rt).filter(F.col("FACT_DATE").isNotNull()), ["PATIENT_ID", "FACT_DATE"])
    facts = daily.withColumnRenamed("FACT_DATE", "DAY").withColumn("FACT", F.lit(1))
    placed = marks.withColumns({"DAY": F.date_sub("INDEX_DATE", buffer_days), "FACT": F.lit(0)})
    line = facts.unionByName(placed, allowMissingColumns=True)
    before = (
        Window.partitionBy("PATIENT_ID").orderBy("DAY", "FACT").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = line.select("PATIENT_ID", "FACT", *kept, *[F.sum(p).over(before).alias(p) for p in _PARTS])
    named = summed.filter(F.col("FACT") == 0).join(
        patients.select("PATIENT_ID", "BIRTHDATE", *S.CATEGORICAL_FEATURES), "PATIENT_ID"
    )
    return _rows(named, age_in_years(F.col("INDEX_DATE")), ["PATIENT_ID", *kept])


def features_asof(
    dates: DataFrame,
    patients: DataFrame,
    gold: Tables,
    rt: Tables,
    buffer_days: int = 0,
) -> DataFrame:
    """Feature rows for each (PATIENT_ID, INDEX_DATE), from facts strictly before the date.

    `buffer_days` leaves out that many days before the index date as well.
    """
    return features_at(dates.select("PATIENT_ID", "INDEX_DATE").distinct(), patients, gold, rt, buffer_days)


def age_safety(df: DataFrame) -> DataFrame:
    """Ages above 200 were stored in days; missing stays missing."""
    age = F.col("AGE_AT_INDEX")
    known = F.when(F.isnan(age), F.lit(None)).otherwise(age)
    return df.withColumn(
        "AGE_AT_INDEX", F.when(known > S.AGE_LIMIT_YEARS, known / S.DAYS_PER_YEAR).otherwise(known)
    )


def feature_contract(df: DataFrame, keep: Sequence[str] = ("PATIENT_ID",)) -> DataFrame:
    """Exactly the contract columns in order; absent numbers are null, absent texts unknown."""

    def column(name: str) -> Column:
        kind = S.FEATURE_SCHEMA[name].dataType
        if name in df.columns:
            return F.col(name).cast(kind).alias(name)
        default = F.lit(S.CATEGORY_DEFAULT) if name in S.CATEGORICAL_FEATURES else F.lit(None)
        return default.cast(kind).alias(name)

    return age_safety(df.select(*keep, *[column(n) for n in S.FEATURES]))


def features_ablated(df: DataFrame, keep: Sequence[str] = ("PATIENT_ID",)) -> DataFrame:
    """Without the count features, which follow from a diagnosis."""
    return df.select(*keep, *S.ABLATED_NUMERIC_FEATURES, *S.CATEGORICAL_FEATURES)


def features_long(df: DataFrame, keep: Sequence[str] = ("PATIENT_ID",)) -> DataFrame:
    """One row per patient and feature as text, numbers rounded to four digits by their binary value.

    Rounding a double itself would go by its shortest decimal text: 23.67375, held as a little less, to 23.6738.
    """
    texts = [(F.round(F.col(c) * 10_000) / 10_000).cast("string").alias(c) for c in S.NUMERIC_FEATURES]
    shown = df.select(*keep, *texts, *S.CATEGORICAL_FEATURES)
    return shown.unpivot(list(keep), S.FEATURES, "FEATURE", "VALUE")
