"""Risk display: tiers, found and missing models, before/after comparison.

Scores are long: PATIENT_ID, TARGET_NAME, PROBABILITY (null when a model is missing).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S

# Cuts a double below one into two parts that stay exact when multiplied by ten.
SPLIT = float(1 << 26)

# Tier, label and colour
TIERS = {
    "unavailable": ("Model Unavailable", "gray"),
    "high": ("🔴 High Risk", "red"),
    "moderate": ("🟡 Moderate Risk", "orange"),
    "low": ("🟢 Low Risk", "green"),
}


def _by_tier(p: Column, pick) -> Column:
    return (
        F.when(p.isNull(), F.lit(pick("unavailable")))
        .when(p >= S.HIGH_RISK, F.lit(pick("high")))
        .when(p >= S.MODERATE_RISK, F.lit(pick("moderate")))
        .otherwise(F.lit(pick("low")))
    )


def one_digit(x: Column) -> Column:
    """Nearest number with one decimal, by the exact binary value; exact ties go to even.

    The built-in round works on the shortest decimal text, where 34.55, which is really
    a little less, would count as a tie and go up.
    """
    size = F.abs(x)
    whole = F.floor(size).cast("double")
    fraction = size - whole
    # ten times the fraction in two exact parts, so that the side of a tie is known
    high = F.floor(fraction * SPLIT) / SPLIT
    tenth = F.floor(fraction * 10)
    over = (high * 10 - (tenth + 0.5)) + (fraction - high) * 10
    up = (over > 0) | ((over == 0) & (tenth % 2 == 1))
    return F.signum(x) * (whole * 10 + tenth + F.when(up, 1).otherwise(0)) / 10


def percent(p: Column) -> Column:
    return one_digit(p * F.lit(100.0))


def risk_tiers(scores: DataFrame) -> DataFrame:
    p = F.col("PROBABILITY")
    pct = percent(p)
    return scores.select(
        "PATIENT_ID",
        "TARGET_NAME",
        "PROBABILITY",
        _by_tier(p, lambda t: t).alias("TIER"),
        _by_tier(p, lambda t: TIERS[t][0]).alias("LABEL"),
        _by_tier(p, lambda t: TIERS[t][1]).alias("COLOR"),
        pct.alias("PCT"),
        F.when(pct.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), pct))).alias("BAR"),
    )


def models_found_missing(scores: DataFrame) -> DataFrame:
    """Sorted target names with and without a score, per patient; bounded by the targets."""
    p, name = F.col("PROBABILITY"), F.col("TARGET_NAME")

    def names(test: Column) -> Column:
        return F.concat_ws(", ", F.sort_array(F.collect_set(F.when(test, name))))

    return scores.groupBy("PATIENT_ID").agg(
        names(p.isNotNull()).alias("MODELS_FOUND"), names(p.isNull()).alias("MODELS_MISSING")
    )


def risk_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Change of each score between two snapshots, with a dead band around zero."""
    keys = ["PATIENT_ID", "TARGET_NAME"]
    b = before.select(*keys, F.col("PROBABILITY").alias("BEFORE"))
    a = after.select(*keys, F.col("PROBABILITY").alias("AFTER"))
    delta = F.col("AFTER") - F.col("BEFORE")
    up, down = delta > S.DELTA_BAND, delta < -S.DELTA_BAND
    shown = percent(delta).cast("string")

    def pick(no_pair: str, rise, fall, same: str) -> Column:
        return F.when(delta.isNull(), no_pair).when(up, rise).when(down, fall).otherwise(same)

    return b.join(a, keys, "full_outer").select(
        *keys,
        percent(F.col("BEFORE")).alias("BEFORE_PCT"),
        percent(F.col("AFTER")).alias("AFTER_PCT"),
        delta.alias("DELTA"),
        pick("—", F.lit("▲"), F.lit("▼"), "—").alias("DIRECTION"),
        pick("—", F.concat(F.lit("+"), shown, F.lit("%")), F.concat(shown, F.lit("%")), "No change").alias("CHANGE"),
    )
