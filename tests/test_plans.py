"""Plans that must hold at scale."""

import re

import pytest

from vitalflow.plans.proxy import Clinic
from vitalflow.plans.registry import QUERIES, TRAINING

# these run training jobs while they are declared
NAMES = sorted(set(QUERIES) - TRAINING - {"median_impute", "onehot"})


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_pairing_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|InPandas", plan)
    # a window without keys would gather everything in one task
    assert "Exchange SinglePartition" not in plan or "Window" not in plan.split("Exchange SinglePartition")[0]


@pytest.mark.parametrize("name", ["encounters_state", "latest_obs_hist", "clinical_timeline"])
def test_top_n_is_cut_before_the_shuffle(spark, sf_dir, name):
    assert "WindowGroupLimit" in plan_of(QUERIES[name](spark, sf_dir))


def test_patient_filter_reaches_the_scan(spark, tmp_path):
    from vitalflow import schemas as S
    from vitalflow.operators import state

    gold = spark.createDataFrame([], "PATIENT_ID string, CODE string, DESCRIPTION string, START_DATE timestamp, END_DATE timestamp, OTHER string")
    rt = spark.createDataFrame([], S.REALTIME_SCHEMAS["RT_CONDITIONS"])
    gold.write.parquet(str(tmp_path / "g"))
    rt.write.parquet(str(tmp_path / "r"))
    one = state.conditions_state(
        {"conditions": spark.read.parquet(str(tmp_path / "g"))}, {"RT_CONDITIONS": spark.read.parquet(str(tmp_path / "r"))}, "7"
    )
    plan = plan_of(one)
    assert plan.count("EqualTo(PATIENT_ID,7)") == 2
    assert "OTHER" not in plan


def test_raw_views_read_only_needed_columns(spark, sf_dir):
    plan = plan_of(Clinic(spark, sf_dir).raw("encounters").select("ID"))
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_an_event_is_parsed_a_bounded_number_of_times(spark, sf_dir):
    """As plain columns, filters would write the parse out anew for each field."""
    plan = QUERIES["rt_observations"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") <= 2


def test_days_are_not_joined_with_index_dates(spark, sf_dir):
    c = Clinic(spark, sf_dir)
    plan = QUERIES["features_asof"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "FACT_DATE" in plan and not re.search(r"Join .*FACT_DATE", plan)
    assert c.dates.columns == ["PATIENT_ID", "TARGET_NAME", "INDEX_DATE"]


def test_lines_of_several_entities_are_joined_once(spark, sf_dir):
    plan = QUERIES["null_profile"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1, "the readings alone, whose lines need no item"
    plain, joined = Clinic(spark, sf_dir), Clinic(spark, sf_dir, ["conditions", "careplans"])
    for entity in ("conditions", "careplans"):
        assert joined.raw(entity).columns == plain.raw(entity).columns
        assert joined.raw(entity).exceptAll(plain.raw(entity)).isEmpty()
        assert plain.raw(entity).exceptAll(joined.raw(entity)).isEmpty()
