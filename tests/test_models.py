"""Training, scoring, saving, and evaluation against direct computation."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalflow import schemas as S
from vitalflow.operators import boosting, metrics, models

TINY = models.TreeSettings(trees=3, depth=3)


@pytest.fixture(scope="module")
def prepared(spark):
    rng = random.Random(5)
    rows = []
    for t in ("Stroke", "Asthma"):
        for i in range(240):
            y = int(i % 4 == 0) if t == "Stroke" else 0
            age = 70 + rng.random() * 10 if y else 30 + rng.random() * 20
            rows.append((f"p{i}", t, y, age, None if i % 5 == 0 else 90.0 + y * 20, rng.choice(["M", "F"])))
    df = spark.createDataFrame(rows, "PATIENT_ID string, TARGET_NAME string, LABEL int, AGE_AT_INDEX double, AVG_GLUCOSE double, GENDER string")
    extra = {c: F.lit(1.0) for c in S.NUMERIC_FEATURES if c not in df.columns} | {c: F.lit("x") for c in S.CATEGORICAL_FEATURES if c not in df.columns}
    return models.prepare(df.withColumns({**extra, "INDEX_DATE": F.lit("2020-01-01").cast("date")}))


def test_train_score_save_and_load(spark, prepared, tmp_path):
    fitted, scored = models.train_score(prepared, ["Stroke", "Asthma"], settings=TINY)
    assert list(fitted) == ["Stroke"], "a single-class target is skipped"
    assert scored.filter("PROBABILITY < 0 or PROBABILITY > 1").count() == 0
    row = models.evaluate(scored).first()
    assert row["ROC_AUC"] > 0.9 and row["TEST_ACCURACY"] > 0.9
    top = models.feature_importance(spark, fitted["Stroke"]).first()
    assert top["FEATURE"] in ("AGE_AT_INDEX", "AVG_GLUCOSE")
    models.save_model(spark, fitted["Stroke"], str(tmp_path))
    assert models.models_available(spark, str(tmp_path))["Stroke"] and models.load_model(spark, str(tmp_path), "Asthma") is None
    back = models.load_model(spark, str(tmp_path), "Stroke")
    people = spark.createDataFrame([("a", 75.0, "M"), ("b", 35.0, "neverseen")], "PATIENT_ID string, AGE_AT_INDEX double, GENDER string")
    got = models.risk_scores(people, {"Stroke": back})
    assert got.count() == 2 * len(S.TARGETS) and got.filter("PROBABILITY is not null").count() == 2
    p = {r["PATIENT_ID"]: r["PROBABILITY"] for r in got.filter("TARGET_NAME = 'Stroke'").collect()}
    assert p["a"] > p["b"]


def test_split_is_stratified_and_stable(prepared):
    n = {(r["TARGET_NAME"], r["LABEL"], r["SPLIT"]): r["count"] for r in prepared.groupBy("TARGET_NAME", "LABEL", "SPLIT").count().collect()}
    assert n[("Stroke", 1, "test")] == 12 and n[("Stroke", 0, "test")] == 36 and n[("Asthma", 0, "test")] == 48


def test_hot_features_use_the_vocabulary_of_the_train_part(spark):
    columns = "PATIENT_ID string, GENDER string, RACE string, ETHNICITY string, MARITAL string"
    train = spark.createDataFrame([("a", "F", "x", "x", "x")], columns)
    df = spark.createDataFrame([("b", "M", "x", None, "x")], columns)
    train = train.withColumn("TARGET_NAME", F.lit("Stroke")).unionByName(
        spark.createDataFrame([("c", "M", "y", "y", "y")], columns).withColumn("TARGET_NAME", F.lit("Asthma"))
    )
    got = {(r["TARGET_NAME"], r["FEATURE"]) for r in models.hot_features(df, train, ["PATIENT_ID"]).collect()}
    assert {f for t, f in got if t == "Stroke"} == {"GENDER_OTHER", "RACE_x", "ETHNICITY_OTHER", "MARITAL_x"}
    assert {f for t, f in got if t == "Asthma"} == {"GENDER_M", "RACE_OTHER", "ETHNICITY_OTHER", "MARITAL_OTHER"}


@pytest.mark.parametrize("column", S.CATEGORICAL_FEATURES)
def test_importance_names_the_column_that_decides(spark, column):
    rows = [(f"p{i}", "Stroke", int(i % 3 == 0), "yes" if i % 3 == 0 else "no") for i in range(120)]
    df = spark.createDataFrame(rows, f"PATIENT_ID string, TARGET_NAME string, LABEL int, {column} string")
    extra = {c: F.lit(1.0) for c in S.NUMERIC_FEATURES} | {c: F.lit("x") for c in S.CATEGORICAL_FEATURES if c != column}
    long = df.withColumns({**extra, "INDEX_DATE": F.lit("2020-01-01").cast("date")})
    model = models.train_target(models.prepare(long), "Stroke", settings=TINY)
    top = models.feature_importance(spark, model).first()
    assert top["FEATURE"] in (f"{column}_yes", f"{column}_no") and top["IMPORTANCE"] > 0.9


def test_metrics_against_brute_force(spark):
    rng = random.Random(11)
    rows = [("t", int(rng.random() < 0.3), round(rng.random(), 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "TARGET_NAME string, LABEL int, PROBABILITY double")
    pos = [p for _, y, p in rows if y]
    neg = [p for _, y, p in rows if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert metrics.roc_auc(df).first()["ROC_AUC"] == pytest.approx(auc)
    best, ap, before = (-1.0, 0.0), 0.0, 0.0
    for t in sorted({p for _, _, p in rows}, reverse=True):
        tp, n = sum(p >= t for p in pos), sum(p >= t for _, _, p in rows)
        precision, recall = tp / n, tp / len(pos)
        ap += (recall - before) * precision
        before = recall
        f1 = 2 * precision * recall / (precision + recall + 1e-9)
        if f1 >= best[0]:
            best = (f1, t)
    got = metrics.optimal_threshold(metrics.pr_curve(df)).first()
    assert (got["F1"], got["THRESHOLD"]) == pytest.approx(best)
    lift = metrics.average_precision_lift(df).first()
    assert lift["PR_AUC"] == pytest.approx(ap) and lift["LIFT"] == pytest.approx(ap / (len(pos) / len(rows)))


def test_one_class_has_no_area_and_no_lift(spark):
    df = spark.createDataFrame([("t", 0, 0.5), ("t", 0, 0.7)], "TARGET_NAME string, LABEL int, PROBABILITY double")
    assert metrics.roc_auc(df).first()["ROC_AUC"] is None
    assert metrics.average_precision_lift(df).first()["LIFT"] == 0
    assert metrics.class_guard(df).first()["TRAINABLE"] is False


# --- the trees against a plain learner ----------------------------------------------------
def plain_trees(rows, labels, weight, numeric, growth):
    """Margins of every row after second-order boosting, by trying every split of every node."""
    margins = [0.0] * len(rows)

    def worth(g, h):
        return g * g / (h + growth.l2)

    def split(members, g, h, depth):
        total = sum(g[i] for i in members), sum(h[i] for i in members)
        best = None
        if depth < growth.depth:
            for j in range(len(rows[0])):
                for b in sorted({rows[i][j] for i in members}):
                    right = [i for i in members if (rows[i][j] > b if j < numeric else rows[i][j] == b)]
                    gr, hr = sum(g[i] for i in right), sum(h[i] for i in right)
                    gl, hl = total[0] - gr, total[1] - hr
                    if min(hl, hr) < growth.least_hessian:
                        continue
                    gain = worth(gl, hl) + worth(gr, hr) - worth(*total)
                    if gain > (best[0] + 1e-9 if best else boosting.LEAST_GAIN):
                        best = gain, right
        if best is None:
            for i in members:
                margins[i] -= growth.step * total[0] / (total[1] + growth.l2)
            return
        right = set(best[1])
        split([i for i in members if i not in right], g, h, depth + 1)
        split(best[1], g, h, depth + 1)

    for _ in range(growth.trees):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        w = [weight if y else 1.0 for y in labels]
        g = [w[i] * (p[i] - labels[i]) for i in range(len(rows))]
        h = [w[i] * p[i] * (1 - p[i]) for i in range(len(rows))]
        split(list(range(len(rows))), g, h, 0)
    return margins


@pytest.mark.parametrize("tasks", [1, 3, 40])
def test_all_models_grow_as_a_plain_learner_grows_each(spark, tasks):
    rng = random.Random(tasks)
    growth = boosting.Growth(trees=7, depth=3, step=0.3, settle_every=2)
    shape = boosting._Shape(2, (6, 4, 3), ((0, 1, 2), (1, 2)), 2)
    data = {m: [[rng.randrange(w) for w in shape.widths] for _ in range(90)] for m in (0, 1)}
    labels = {m: [int(r[0] + r[1] + rng.random() * 3 > 6 - m or r[2] == 1) for r in data[m]] for m in data}
    weight = {0: 1.0, 1: 2.5}
    rows = [(m, r, y) for m in data for r, y in zip(data[m], labels[m])]
    rng.shuffle(rows)

    def block(part):
        m, bins, y = (np.array([r[k] for r in part]) for k in range(3))
        return m, bins.reshape(len(part), 3), y, np.where(y == 1, [weight[i] for i in m], 1.0), np.zeros((2, len(part)))

    blocks = spark.sparkContext.parallelize([block(rows[i::tasks]) for i in range(tasks)], tasks)
    forests = boosting.grow(blocks, shape, growth)
    for s, columns in enumerate(shape.sets):
        for m in data:
            own = [[r[j] for j in columns] for r in data[m]]
            want = plain_trees(own, labels[m], weight[m], sum(j < 2 for j in columns), growth)
            got = forests[s][m].margins(np.array(data[m]))
            assert np.allclose(got, want), (s, m)


def test_a_saved_model_scores_as_before(spark, prepared, tmp_path):
    model = models.train_target(prepared, "Stroke", models.ABLATED, TINY)
    models.save_model(spark, model, str(tmp_path))
    back = models.load_model(spark, str(tmp_path), "Stroke")
    rows = prepared.filter("TARGET_NAME = 'Stroke'")
    assert models.score(model, rows).exceptAll(models.score(back, rows)).count() == 0
    assert not set(models.importances(model)) & set(S.COUNT_FEATURES)
    assert sum(models.importances(model).values()) == pytest.approx(1.0)


def test_registry_holds_the_figures_of_the_fitted_models(spark, prepared):
    grid = models.train_grid(prepared, settings=TINY)
    assert set(grid) == {("Stroke", models.FULL), ("Stroke", models.ABLATED)}
    targets = spark.createDataFrame([("Stroke",), ("Asthma",)], "TARGET_NAME string")
    got = models.trained_registry(prepared, grid, targets).collect()
    assert {(r["TARGET_NAME"], r["FEATURE_SET"], r["AVAILABLE"]) for r in got} == {
        ("Stroke", models.FULL, True), ("Stroke", models.ABLATED, True), ("Asthma", None, False)
    }
    assert all(r["ROC_AUC"] > 0.9 for r in got if r["AVAILABLE"])


@pytest.mark.parametrize("rows_alone", [0, 45, 1000])
def test_models_are_the_same_grown_alone_and_level_by_level(spark, rows_alone):
    rng = np.random.default_rng(7)
    shape = boosting._Shape(2, (6, 4, 3), ((0, 1, 2), (1, 2)), 2)

    def block(n):
        bins = np.column_stack([rng.integers(0, w, n) for w in shape.widths])
        label = ((bins[:, 0] + rng.random(n) * 3) > 3).astype(np.int8)
        return rng.integers(0, 2, n), bins, label, np.ones(n), np.zeros((2, n))

    blocks = [block(n) for n in (30, 1, 20, 40)]
    made, jobs = [], []
    for limit in (1000, rows_alone):
        growth = boosting.Growth(trees=4, depth=3, step=0.3, settle_every=2, rows_alone=limit)
        group = f"grown-{rows_alone}-{len(made)}"
        spark.sparkContext.setJobGroup(group, group)
        forests = boosting.grow(spark.sparkContext.parallelize(blocks, 4), shape, growth)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
        made.append([f for row in forests for f in row])
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for one, other in zip(*made):
        assert (one.column == other.column).all() and (one.bin == other.bin).all()
        assert np.allclose(one.value, other.value)
    # a job per level costs time whatever the number of rows
    assert jobs[0] <= 3
    assert jobs[1] <= 3 if rows_alone == 1000 else jobs[1] > 4 * 2


def test_trees_do_not_depend_on_the_order_of_rows(spark):
    """A child's sums are taken as its parent's less its sibling's, which is exact for rounded gradients."""
    rng = np.random.default_rng(5)
    n = 4000
    model, label = rng.integers(0, 2, n), rng.integers(0, 2, n).astype(np.int8)
    bins = np.stack([rng.integers(0, 40, n), label * 3 + rng.integers(0, 5, n), rng.integers(0, 4, n)], 1).astype(np.uint8)
    shape = boosting._Shape(2, (40, 8, 4), ((0, 1, 2), (1, 2)), 2)
    weight, made = np.where(label == 1, 1.7, 1.0), []
    for rows_alone in (n, 0):
        for order in (np.arange(n), rng.permutation(n)):
            cut = [(model[i], bins[i], label[i], weight[i], np.zeros((2, len(i)))) for i in np.array_split(order, 3)]
            growth = boosting.Growth(trees=6, depth=4, step=0.3, rows_alone=rows_alone)
            made.append(boosting.grow(spark.sparkContext.parallelize(cut, 3), shape, growth))
    for other in made[1:]:
        for one, two in zip(sum(made[0], []), sum(other, [])):
            for name in ("column", "bin", "value", "gain"):
                assert np.array_equal(getattr(one, name), getattr(two, name)), name
    for s, m in ((0, 0), (1, 1)):
        forest = made[0][s][m]
        walked = sum(
            v[boosting._walk(bins, 2, c[None], b[None], np.zeros(n, np.int64))]
            for c, b, v in zip(forest.column, forest.bin, forest.value)
        )
        assert np.array_equal(forest.margins(bins), walked)


class LocalRows:
    """As much of an RDD as growth by levels asks for, in this process; kept blocks are made once."""

    context = property(lambda self: self)

    def __init__(self, blocks):
        self.blocks = blocks

    def getNumPartitions(self):
        return 1

    def broadcast(self, value):
        self.value = value
        return self

    def persist(self):
        return self

    unpersist = persist

    def map(self, f):
        return LocalRows([f(block) for block in self.blocks])

    def mapPartitions(self, f):
        return LocalRows(list(f(self.blocks)))

    def collect(self):
        return self.blocks


def test_a_late_tree_grown_by_levels_costs_what_an_early_one_costs(monkeypatch):
    rng = np.random.default_rng(2)
    n = 300
    bins = np.stack([rng.integers(0, 9, n), rng.integers(0, 5, n)], 1).astype(np.uint8)
    label = (bins[:, 0] + rng.random(n) * 6 > 7).astype(np.int8)
    block = np.zeros(n, np.int64), bins, label, np.ones(n), np.zeros((1, n))
    shape, walks, real = boosting._Shape(2, (9, 5), ((0, 1),), 1), [], boosting._walk
    monkeypatch.setattr(boosting, "_walk", lambda *given: walks.append(1) or real(*given))
    found = {}
    for trees in (20, 40):
        walks.clear()
        boosting._grow_by_levels(LocalRows([block]), shape, boosting.Growth(trees, 2, 0.1, least_hessian=0.1))
        found[trees] = len(walks)
    assert found[40] <= 2.2 * found[20]


def test_blocks_made_anew_grow_the_same_trees(spark, monkeypatch):
    rng = np.random.default_rng(3)
    shape = boosting._Shape(1, (30, 4), ((0, 1), (0,)), 2)

    def block(n):
        bins = np.stack([rng.integers(0, 30, n), rng.integers(0, 4, n)], 1).astype(np.uint8)
        return rng.integers(0, 2, n), bins, (bins[:, 0] + rng.random(n) * 20 > 25).astype(np.int8), np.ones(n), np.zeros((2, n))

    blocks, made = [block(n) for n in (500, 70, 300)], []
    for every, settle in ((50, 1), (3, 1), (4, 3)):
        monkeypatch.setattr(boosting, "ANEW_EVERY", every)
        growth = boosting.Growth(trees=8, depth=3, step=0.3, settle_every=settle, rows_alone=0)
        made.append(boosting.grow(spark.sparkContext.parallelize(blocks, 2), shape, growth))
    for other in made[1:]:
        for one, two in zip(sum(made[0], []), sum(other, [])):
            assert all(np.array_equal(getattr(one, k), getattr(two, k)) for k in ("column", "bin", "value", "gain"))


def test_columns_are_added_up_together_where_rows_are_many():
    shape = boosting._Shape(14, (64,) * 12 + (2, 2, 4, 7, 4, 6), (tuple(range(18)),), 1)
    many, few = (boosting._Joint.groups(shape, shape.sets[0], n) for n in (1_000_000, 100))
    assert len(many) <= 7 and len(few) >= 13
    for groups in (many, few):
        assert sorted(j for group in groups for j in group.columns) == list(range(18))
        assert all(group.cells <= boosting.JOINT_CELLS for group in groups)
    bins = np.random.default_rng(4).integers(0, shape.widths, (1000, 18))
    for group in many:
        keys = group.keys(bins)
        assert all(np.array_equal(group.bins[j][keys], bins[:, j]) for j in group.columns)


@pytest.mark.parametrize("depth", [1, 4, 5, 6, 7])
def test_margins_of_deep_trees_are_those_of_a_walk(depth):
    rng = np.random.default_rng(depth)
    nodes, trees, n = 2 ** (depth + 1) - 1, 9, 500
    column = rng.integers(-1, 4, (trees, nodes)).astype(np.int16)
    column[:, nodes // 2 :] = -1
    for node in range(1, nodes):  # nothing splits below a leaf
        column[column[:, (node - 1) // 2] < 0, node] = -1
    forest = boosting.Forest(column, rng.integers(0, 12, (trees, nodes)), rng.normal(size=(trees, nodes)), np.zeros((trees, nodes)), 2)
    bins = rng.integers(0, 14, (n, 4)).astype(np.uint16)
    walked = sum(
        v[boosting._walk(bins, 2, c[None], b[None], np.zeros(n, np.int64))]
        for c, b, v in zip(forest.column, forest.bin, forest.value)
    )
    assert np.array_equal(forest.margins(bins), walked)


def test_medians_between_limits_are_exact_whatever_the_limits(spark):
    rng = random.Random(8)
    values = [None if rng.random() < 0.1 else round(rng.gauss(0, 3), 1) for _ in range(301)]
    rows = [(t, v, float(i % 2), None) for t in ("Stroke", "Asthma") for i, v in enumerate(values[: 300 if t == "Stroke" else 301])]
    df = spark.createDataFrame(rows, "TARGET_NAME string, A double, B double, C double")
    want = {}
    for r in models.feature_medians(df, ["A", "B", "C"]).collect():
        want.setdefault(r["TARGET_NAME"], {})[r["FEATURE"]] = r["MEDIAN"]
    limits = {
        # around the middle; beside it; one value that is the middle; none at all
        "Stroke": {"A": (-1.0, 1.0), "B": (0.0, 1.0), "C": (None, None)},
        "Asthma": {"A": (5.0, 6.0), "B": (1.0, 1.0), "C": (None, None)},
    }
    assert models.medians_between(df, limits, ["A", "B", "C"]) == want


def test_few_values_are_counted_for_the_medians(spark, monkeypatch):
    rng = random.Random(4)
    rows = [("Stroke", i % 2, *[rng.random() for _ in S.NUMERIC_FEATURES]) for i in range(4000)]
    kinds = ", ".join(f"{c} double" for c in S.NUMERIC_FEATURES)
    df = spark.createDataFrame(rows, f"TARGET_NAME string, LABEL int, {kinds}")
    df = df.withColumns({c: F.lit("x") for c in S.CATEGORICAL_FEATURES})
    written, real = [], models.write_through
    monkeypatch.setattr(models, "write_through", lambda rows, name: written.append(real(rows, name)) or written[-1])
    got = models.learn_encodings(df)["Stroke"].medians
    assert got == {r["FEATURE"]: r["MEDIAN"] for r in models.feature_medians(df, S.NUMERIC_FEATURES).collect()}
    assert written[0].count() < 4000, "of 14 times 4000 distinct values"


def test_evaluation_gives_what_the_metrics_give(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(t, y := int(rng.random() < 0.3), rng.choice(["test", "train", "train"]), round((rng.random() + y) / 2, 2))
            for t in ("Stroke", "Asthma") for _ in range(400)]
    scored = spark.createDataFrame(rows, "TARGET_NAME string, LABEL int, SPLIT string, PROBABILITY double")
    test = scored.filter("SPLIT = 'test'")
    best = metrics.optimal_threshold(metrics.pr_curve(test))
    counted, real = [], metrics.count_scores
    monkeypatch.setattr(metrics, "count_scores", lambda *given: counted.append(1) or real(*given))
    got = {r["TARGET_NAME"]: r for r in models.evaluate(scored).collect()}
    assert len(counted) == 1, "the scores are sorted once for all metrics"

    def by(df, value, *keys):
        return {tuple(r[k] for k in ("TARGET_NAME", *keys)): r[value] for r in df.collect()}

    area = by(metrics.roc_auc(scored, ["TARGET_NAME", "SPLIT"]), "ROC_AUC", "SPLIT")
    accuracy = by(metrics.accuracy_at_threshold(scored, best), "ACCURACY", "SPLIT")
    lift, found = metrics.average_precision_lift(test), by(best, "F1")
    for t, r in got.items():
        assert (r["ROC_AUC"], r["TRAIN_ROC_AUC"]) == pytest.approx((area[t, "test"], area[t, "train"]), abs=6e-5)
        assert (r["TEST_ACCURACY"], r["TRAIN_ACCURACY"]) == pytest.approx((accuracy[t, "test"], accuracy[t, "train"]), abs=6e-5)
        assert (r["PR_AUC"], r["OPTIMAL_F1"]) == pytest.approx((by(lift, "PR_AUC")[(t,)], found[(t,)]), abs=6e-4)
        assert r["OPTIMAL_THRESHOLD"] == pytest.approx(by(best, "THRESHOLD")[(t,)], abs=6e-4)
        assert r["LIFT"] == pytest.approx(by(lift, "LIFT")[(t,)], abs=0.06)
