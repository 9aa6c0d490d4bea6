"""What is kept up to date batch by batch: profiles, features, the name index; and hot readings."""

import random
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalflow import schemas as S
from vitalflow.operators import feature_state, name_index, quality, silver, state
from vitalflow.operators import gold as G
from vitalflow.plans.proxy import AS_OF, Clinic
from vitalflow.plans.registry import JOINED, render
from vitalflow.sources import Lake


def strings(spark, names, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))


def test_a_profile_of_merged_batches_is_that_of_all_rows(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["", None, "NULL", "a", "b"]), f"k{rng.randrange(3000)}", rng.choice([None, 1, 2])) for _ in range(6000)]
    df = spark.createDataFrame(rows, "a string, b string, n int")
    parts = [spark.createDataFrame(rows[i : i + 2000], df.schema) for i in (0, 2000, 4000)]
    states = [quality.profile_state(p, f"b{i}") for i, p in enumerate([*parts, df.limit(0)])]
    again = states[1]  # a load that was profiled twice
    merged = {r["COLUMN_NAME"]: r for r in quality.merged_profile(reduce(DataFrame.unionByName, [*states, again])).collect()}
    whole = {r["COLUMN_NAME"]: r for r in quality.null_profile(df).collect()}
    for c in df.columns:
        assert (merged[c]["TOTAL"], merged[c]["MISSING"]) == (6000, whole[c]["MISSING"])
        exact = len({r[df.columns.index(c)] for r in rows} - {None})
        assert abs(merged[c]["DISTINCT_VALUES"] - exact) <= 0.03 * exact


def test_features_after_random_batches_are_those_of_all_facts(spark, sf_dir, tmp_path):
    c = Clinic(spark, sf_dir)
    facts = {**{e: c.gold[e] for e in ("observations", "encounters", "conditions", "medications")},
             **{t: c.rt[t] for t in ("RT_OBSERVATIONS", "RT_ENCOUNTERS", "RT_CONDITIONS", "RT_MEDICATIONS")}}
    batch_of = F.pmod(F.xxhash64("PATIENT_ID"), F.lit(7))
    facts = {n: df.withColumn("__b", F.when(batch_of == 0, 0).otherwise(F.pmod(F.xxhash64(*df.columns), F.lit(2)))) for n, df in facts.items()}
    lake = Lake(spark, str(tmp_path), versioned=True)
    touched = []
    for b in (0, 1):
        part = {n: df.filter(F.col("__b") == b).drop("__b") for n, df in facts.items()}
        touched.append({r[0] for r in feature_state.apply_batch(lake, part, part).collect()})
    sums = lake.read("ml", feature_state.SUMS)
    got = render(feature_state.feature_rows(c.patients, sums, AS_OF))
    want = render(c.features)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    # a seventh of the patients has nothing in the second batch
    assert touched[0] - touched[1]

    def score(rows):
        return rows.select("PATIENT_ID", F.lit("Stroke").alias("TARGET_NAME"), (F.col("TOTAL_ENCOUNTERS") / 100).alias("PROBABILITY"))

    before = score(c.features).withColumn("PROBABILITY", F.lit(0.5))
    only = spark.createDataFrame([(p,) for p in touched[1]], "PATIENT_ID string")
    after, change = feature_state.rescored(before, c.patients, sums, only, AS_OF, score)
    assert after.count() == before.count() and {r[0] for r in change.select("PATIENT_ID").collect()} <= touched[1]
    kept = after.filter(~F.col("PATIENT_ID").isin(sorted(touched[1])))
    assert kept.filter("PROBABILITY <> 0.5").isEmpty() and kept.count() == before.count() - change.count()


def test_a_name_search_by_index_finds_what_a_scan_finds(spark, sf_dir, tmp_path):
    patients = Clinic(spark, sf_dir).patients.cache()
    name_index.write_postings(patients, str(tmp_path / "names"))
    index = name_index.read_postings(spark, str(tmp_path / "names"))
    names = [r[0] for r in patients.select("FULL_NAME").collect() if r[0]]
    rng = random.Random(8)
    texts = ["", "m", "00", "zzz", "mer 0", "MR.", "0000"]
    for _ in range(12):
        name = rng.choice(names)
        at = rng.randrange(len(name))
        texts.append(name[at : at + rng.randint(1, 9)].swapcase())
    for text in texts:
        got = name_index.search(patients, index, text, limit=1000).select("PATIENT_ID").collect()
        want = state.patients_by_name(patients, text, limit=1000).select("PATIENT_ID").collect()
        assert got == want, text
    plan = name_index.search(patients, index, "mer 00")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "SLICE" in plan.split("PartitionFilters: [")[1].split("]")[0] + plan.split("PartitionFilters: [")[-1].split("]")[0]


def test_hot_readings_are_numbered_as_all_others(spark):
    rows = [("2020-01-01", "p" if i % 3 else None, "e", "c", "Glucose", str(i % 2), f"u{i % 5}") for i in range(90)]
    typed = silver.split_value(silver.bronze_stamp(strings(spark, S.RAW_SCHEMAS["observations"].names, rows), "B", AS_OF))
    plain = silver.reading_seq(typed)
    for hot_rows in (0, 5, 20):
        other = silver.reading_seq(typed, hot_rows=hot_rows)
        assert plain.exceptAll(other).isEmpty() and other.count() == 90


def test_readings_are_moved_once_for_numbers_and_pivot(spark, sf_dir):
    """Numbering and pivot share one exchange, and no hash is moved with the rows."""
    rows = [("2020-01-01", f"p{i % 9}", f"e{i % 30}", "c", "Glucose", str(i % 4), f"u{i % 5}") for i in range(300)]
    typed = silver.split_value(silver.bronze_stamp(strings(spark, S.RAW_SCHEMAS["observations"].names, rows), "B", AS_OF))
    wide = G.observations(silver.reading_seq(typed))
    assert wide.count() == len({(r["PATIENT_ID"], r["ENCOUNTER_ID"], r["READING_SEQ"]) for r in wide.collect()})
    plan = wide._jdf.queryExecution().executedPlan()
    final = plan.toString().split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning(PATIENT_ID") == 1, final


def test_all_entities_of_a_query_start_from_lines_joined_once(spark, sf_dir):
    joined = JOINED["clinical_timeline"]
    clinic, plain = Clinic(spark, sf_dir, joined), Clinic(spark, sf_dir)
    for entity in joined:
        made = clinic.raw(entity)
        assert all("lineitem" not in f and "orders" not in f for f in made.inputFiles()), entity
        other = plain.raw(entity)
        assert made.exceptAll(other).isEmpty() and other.exceptAll(made).isEmpty(), entity
