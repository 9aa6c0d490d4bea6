"""Feature rows kept up to date batch by batch.

The state is two tables: additive sums per patient (SUMS) and the distinct codes per patient (CODES).
A batch of new facts changes only the patients in it: their sums are added to, codes they did not have
are counted, and only their feature rows and scores are made anew. `Lake(versioned=True)` holds the
state, so a job replaces what it reads and a failed one changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import features, risk
from .features import Tables

SUMS, CODES, KIND = "feature_sums", "feature_codes", "KIND"
LAYER = "ml"


def batch_sums(gold: Tables, rt: Tables) -> DataFrame:
    """What a batch's readings and visits add per patient; counts of codes are not additive."""
    sources = [*features._vital_sources(gold, rt), *features._visit_sources(gold, rt)]
    return features._add_up(reduce(DataFrame.unionByName, sources), ["PATIENT_ID"])


def batch_codes(gold: Tables, rt: Tables) -> DataFrame:
    """PATIENT_ID, KIND (the feature that counts them) and CODE, each once."""
    parts = []
    for feature, tables in features._CODES.items():
        for table in (gold[tables[0]], rt[tables[1]]):
            parts.append(table.select("PATIENT_ID", F.lit(feature).alias(KIND), "CODE"))
    return reduce(DataFrame.unionByName, parts).filter(F.col("CODE").isNotNull()).distinct()


def merge(old: tuple[DataFrame, DataFrame] | None, sums: DataFrame, codes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New sums, new codes, and the patients (PATIENT_ID) whose rows the batch changes.

    Stored codes are read for the batch's patients only where tables are stored by patient.
    """
    if old is not None:
        codes = codes.join(old[1], ["PATIENT_ID", KIND, "CODE"], "left_anti")
    counts = codes.groupBy("PATIENT_ID").agg(
        *[F.count_if(F.col(KIND) == f).alias(f) for f in features._CODES]
    )
    added = features._add_up(sums.unionByName(counts, allowMissingColumns=True), ["PATIENT_ID"])
    touched = sums.select("PATIENT_ID").union(codes.select("PATIENT_ID")).distinct()
    if old is None:
        return added, codes, touched
    total = features._add_up(old[0].unionByName(added), ["PATIENT_ID"])
    return total, old[1].unionByName(codes), touched


def feature_rows(patients: DataFrame, sums: DataFrame, as_of: str, only: DataFrame | None = None) -> DataFrame:
    """Feature rows from the state, of all patients or of those in `only`."""
    if only is not None:
        patients = patients.join(only, "PATIENT_ID", "left_semi")
    age = features.age_in_years(F.lit(as_of).cast("date"))
    return features._rows(patients.join(sums, "PATIENT_ID", "left"), age, ["PATIENT_ID"])


def apply_batch(lake, gold: Tables, rt: Tables) -> DataFrame:
    """Merge a batch of facts into the stored state; the patients that it changed, as a written table.

    A batch must be applied once: sums of facts that come again are added again.
    """
    old = (lake.read(LAYER, SUMS), lake.read(LAYER, CODES)) if lake.exists(LAYER, SUMS) else None
    sums, codes, touched = merge(old, batch_sums(gold, rt), batch_codes(gold, rt))
    lake.write(touched, LAYER, "feature_touched")
    lake.write(codes, LAYER, CODES)
    # sums last: they tell that a state is there
    lake.write(sums, LAYER, SUMS)
    return lake.read(LAYER, "feature_touched")


def rescored(
    before: DataFrame, patients: DataFrame, sums: DataFrame, touched: DataFrame, as_of: str, score: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """Scores of all patients after a batch, and the change of those that it touched.

    `score` gives PATIENT_ID, TARGET_NAME and PROBABILITY of feature rows; it sees touched patients only.
    """
    fresh = score(feature_rows(patients, sums, as_of, touched)).select("PATIENT_ID", "TARGET_NAME", "PROBABILITY")
    kept = before.select(*fresh.columns).join(touched, "PATIENT_ID", "left_anti")
    changed = risk.risk_delta(before.join(touched, "PATIENT_ID", "left_semi"), fresh)
    return kept.unionByName(fresh), changed


