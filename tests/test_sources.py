"""CSV intake, layer tables and the whole batch run from files to the wide table."""

import csv

import pytest

from vitalflow import schemas as S
from vitalflow.operators import features, state
from vitalflow.plans import medallion as M
from vitalflow.plans.proxy import AS_OF, Clinic
from vitalflow.plans.registry import render
from vitalflow.sources import Lake, load_csv, split_corrupt


def test_csv_keeps_good_rows_and_sets_bad_ones_aside(spark, tmp_path):
    path = tmp_path / "conditions.csv"
    path.write_text('START,STOP,PATIENT,ENCOUNTER,CODE,DESCRIPTION\n2020-01-01,,p,e,c,"a, b"\n2020-01-02,2020-01-03,p\n"2020-01-04","","q","e","c","say ""x"""\n')
    good, bad = split_corrupt(load_csv(spark, str(path), S.RAW_SCHEMAS["conditions"]).persist())
    rows = good.orderBy("START").collect()
    assert [r["DESCRIPTION"] for r in rows] == ["a, b", 'say "x"'] and rows[0]["STOP"] is None and rows[1]["STOP"] is None
    assert [r["LINE"] for r in bad.collect()] == ["2020-01-02,2020-01-03,p"]


class BlankIsNull(Clinic):
    """What a CSV can carry: it has no way to tell blank from NULL."""

    def raw(self, entity):
        return super().raw(entity).replace("", None)


@pytest.fixture(scope="module")
def folder(spark, sf_dir, tmp_path_factory):
    home = tmp_path_factory.mktemp("csv")
    c = Clinic(spark, sf_dir)
    for e in S.ENTITIES:
        rows = c.raw(e).select(*S.RAW_SCHEMAS[e].names).collect()
        with open(home / f"{e}.csv", "w", newline="") as f:
            out = csv.writer(f)
            out.writerow(S.RAW_SCHEMAS[e].names)
            out.writerows([["" if v is None else v for v in r] for r in rows])
    return home


def test_batch_run(spark, sf_dir, folder, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    M.stage_files(lake, str(folder))
    M.run_bronze(lake, "BATCH_1", AS_OF)
    report = {r["TABLE_NAME"]: r for r in M.report(lake, M.BRONZE).collect()}
    assert len(report) == 9 and {r["STATUS"] for r in report.values()} == {"OK"}
    M.run_silver(lake, AS_OF)
    M.run_gold(lake, silver_final=True)
    gold = M.gold_tables(lake)
    assert set(gold) == set(S.ENTITIES)
    assert not set(S.PII_COLUMNS + S.LOAD_METADATA) & set(gold["patients"].columns)
    assert "SSN" in lake.read(M.SILVER, "patients_silver").columns
    assert "SSN" not in lake.read(M.SILVER, "patients_silver_final").columns
    wide = lake.read(M.GOLD, M.OBT)
    want = M.wide_table(BlankIsNull(spark, sf_dir).gold).select(*wide.columns)
    assert wide.count() == want.count() and wide.exceptAll(want).isEmpty()
    assert sorted(r[0] for r in lake.names("staging").collect())[0] == "allergies"


def test_overwrite_by_partition_leaves_no_old_rows(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    df = spark.createDataFrame([("a", 1), ("b", 2)], "t string, v int")
    lake.write(df, "ml", "x", partition_by=["t"])
    lake.write(df.filter("t = 'a'"), "ml", "x", partition_by=["t"])
    assert lake.read("ml", "x").count() == 1 and lake.exists("ml", "x") and not lake.exists("ml", "y")


def test_bucketed_catalog_tables_join_without_shuffle(spark):
    lake = Lake(spark, catalog=True)
    df = spark.range(1000).selectExpr("cast(id % 50 as string) PATIENT_ID", "id v")
    for name in ("l", "r"):
        lake.write(df, "bucketed", name, bucket_by=(4, "PATIENT_ID"))
    joined = lake.read("bucketed", "l").hint("merge").join(lake.read("bucketed", "r"), "PATIENT_ID")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert lake.exists("bucketed", "l")


# --- versions and buckets -----------------------------------------------------------------------
def test_a_job_may_overwrite_what_it_reads_and_readers_see_one_version(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path), versioned=True)
    assert not lake.exists("silver", "x") and lake.current("silver", "x") is None
    lake.write(spark.range(10), "silver", "x")
    opened, first = lake.read("silver", "x"), lake.current("silver", "x")
    lake.write(lake.read("silver", "x").filter("id > 3"), "silver", "x")
    assert lake.read("silver", "x").count() == 6 and opened.count() == 10, "a reader keeps its version"
    assert lake.read("silver", "x", first).count() == 10

    def crash(*_):
        raise RuntimeError("lost before the swap")

    with monkeypatch.context() as patched:
        patched.setattr(Lake, "_swap", crash)
        with pytest.raises(RuntimeError):
            lake.write(spark.range(1), "silver", "x")
    assert lake.read("silver", "x").count() == 6, "a write that does not commit changes nothing"
    assert len(lake.versions("silver", "x")) == 3
    assert len(lake.vacuum("silver", "x")) == 2 and lake.vacuum("silver", "x") == []
    assert lake.read("silver", "x").count() == 6 and lake.exists("silver", "x")
    with pytest.raises(ValueError):
        Lake(spark, catalog=True, versioned=True)


def test_silver_is_pruned_in_place_in_a_versioned_lake(spark, sf_dir, tmp_path):
    lake = Lake(spark, str(tmp_path), versioned=True)
    c = Clinic(spark, sf_dir)
    for e in S.ENTITIES:
        lake.write(c.silver(e), M.SILVER, f"{e}_silver")
    M.run_gold(lake, silver_final=True)
    assert "SSN" not in lake.read(M.SILVER, "patients_silver").columns
    assert lake.read(M.GOLD, "encounters_gold").count() == c.silver("encounters").count()


def test_features_over_tables_stored_by_patient_move_no_rows(spark, sf_dir):
    lake = Lake(spark, catalog=True, buckets=4)
    c = Clinic(spark, sf_dir)
    for e in ("patients", "encounters", "observations", "conditions", "medications"):
        lake.write(c.gold[e], M.GOLD, f"{e}_gold")
    names = ("RT_OBSERVATIONS", "RT_ENCOUNTERS", "RT_CONDITIONS", "RT_MEDICATIONS")
    rt = M.publish_realtime(lake, {t: c.rt[t] for t in names})
    gold = {e: lake.read(M.GOLD, f"{e}_gold") for e in ("patients", "encounters", "observations", "conditions", "medications")}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = features.patient_features(gold["patients"], gold, rt, AS_OF, stored_by_patient=True)
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        assert render(found).exceptAll(render(c.features)).isEmpty() and found.count() == c.features.count()
        one = state.encounters_state(gold, rt, patient_id="17")
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SelectedBucketsCount: 1 out of 4") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
