"""Training and batch scoring: boosted trees per target and feature set, all grown together."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import exact_median
from ..session import write_through
from . import boosting, metrics
from .features import age_safety, feature_contract

FULL, ABLATED = "Full Features", "Ablated Features"
FEATURE_SETS = {FULL: S.NUMERIC_FEATURES, ABLATED: S.ABLATED_NUMERIC_FEATURES}
MODEL_NAME = "GBT"
ROW_ID = "ROW_ID"
OTHER = "OTHER"
#: Training rows of one task, as bin numbers some 40 bytes each: at least and at most, between which
#: there are as many tasks as the cluster runs at once.
LEAST_ROWS, MOST_ROWS = 10_000, 100_000


@dataclass(frozen=True)
class TreeSettings:
    trees: int = S.TREE_COUNT
    depth: int = S.TREE_DEPTH
    step: float = S.TREE_STEP
    #: numbers are cut at this many quantiles, learned from all training rows
    bins: int = 64
    #: rank error of a quantile is one over this
    quantile_accuracy: int = 10_000

    @property
    def growth(self) -> boosting.Growth:
        return boosting.Growth(self.trees, self.depth, self.step)


@dataclass
class TrainedModel:
    """One fitted target: how its columns are read, and its trees."""

    target: str
    feature_set: str
    encoding: boosting.Encoding
    forest: boosting.Forest
    settings: TreeSettings = field(default_factory=TreeSettings)


def feature_medians(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("TARGET_NAME",)) -> DataFrame:
    """Exact median of each numeric feature per target: TARGET_NAME, FEATURE, MEDIAN."""
    keys = list(keys)
    long = df.select(*keys, *columns).unpivot(keys, list(columns), "FEATURE", "VALUE")
    return exact_median(long, [*keys, "FEATURE"], "VALUE")


def median_impute(df: DataFrame, medians: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("TARGET_NAME",)) -> DataFrame:
    """Fill missing numbers with the medians of their target.

    The medians are turned into one row per target before the join, so the data joins a
    handful of rows once.
    """
    keys = list(keys)
    wide = medians.groupBy(*keys).agg(
        *[F.max(F.when(F.col("FEATURE") == c, F.col("MEDIAN"))).alias(f"__m_{c}") for c in columns]
    )
    filled = {c: F.coalesce(F.col(c), F.col(f"__m_{c}")) for c in columns}
    return df.join(wide, keys, "left").withColumns(filled).select(*df.columns)


def onehot(df: DataFrame, categories: Mapping[str, Sequence[str]], keep: Sequence[str]) -> DataFrame:
    """0/1 columns for known categories; an unknown value gives all zeros."""
    flags = [
        F.coalesce((F.col(c) == v).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c, values in categories.items()
        for v in values
    ]
    return df.select(*keep, *flags)


def hot_features(df: DataFrame, train: DataFrame, keys: Sequence[str],
                 columns: Sequence[str] = S.CATEGORICAL_FEATURES) -> DataFrame:
    """The one-hot features that are 1, per target: TARGET_NAME, keys, FEATURE.

    The vocabulary of a target is that of its rows in `train`; a value that they lack counts under
    its column's last name, OTHER.
    """
    known = train.select("TARGET_NAME", *columns).unpivot(["TARGET_NAME"], list(columns), "C", "V").distinct()
    known = known.filter(F.col("V").isNotNull()).withColumn("KNOWN", F.lit(True))
    # one row per target and column: every row of df is met by all targets
    targets = train.groupBy().agg(F.sort_array(F.collect_set("TARGET_NAME")).alias("t")).first()["t"]
    rows = df.select(*keys, *columns).unpivot(list(keys), list(columns), "C", "V")
    rows = rows.withColumn("TARGET_NAME", F.explode(F.array(*[F.lit(t) for t in targets])))
    name = F.concat_ws("_", "C", F.when(F.col("KNOWN"), F.col("V")).otherwise(F.lit(OTHER)))
    # a row per distinct value: Spark broadcasts it when its size allows
    return rows.join(known, ["TARGET_NAME", "C", "V"], "left").select("TARGET_NAME", *keys, name.alias("FEATURE"))


def prepare(df: DataFrame, test_share: float = 0.2) -> DataFrame:
    """Age rule, row id and stratified split of the long labelled table.

    Training reads the result many times, so it is written once to the shared folder.
    """
    # a patient may serve a target on several index dates
    marked = age_safety(df).withColumn(ROW_ID, F.concat_ws("|", "PATIENT_ID", "INDEX_DATE", "LABEL"))
    return write_through(metrics.stratified_split(marked, ROW_ID, test_share), "training-rows")


def medians_between(
    df: DataFrame, limits: Mapping[str, Mapping[str, tuple[float | None, float | None]]], columns: Sequence[str]
) -> dict[str, dict[str, float]]:
    """Exact median of each feature per target, given two values that it most likely lies between.

    Values outside the two become infinite, which leaves the middle as it is; so nearly all rows are
    counted as two values where they are read. A median that turns out infinite lay outside its limits
    and is found among all values.
    """
    far = {side: F.lit(float(f"{side}inf")) for side in "-+"}
    of = [
        (F.lit(t), F.struct(*[F.lit(x).cast("double").alias(f"{side}{c}") for c in columns for side, x in zip("-+", pair[c])]))
        for t, pair in limits.items()  # an entry per target
    ]

    def near(c: str):
        x = F.col(c).cast("double")
        low, high = (F.col("LIMITS")[f"{side}{c}"] for side in "-+")
        return F.when(x < low, far["-"]).when(x > high, far["+"]).otherwise(x).alias(c)

    rows = df.select("*", F.create_map(*[x for entry in of for x in entry])[F.col("TARGET_NAME")].alias("LIMITS"))
    long = rows.select("TARGET_NAME", *[near(c) for c in columns]).unpivot(["TARGET_NAME"], list(columns), "FEATURE", "VALUE")
    keys = ["TARGET_NAME", "FEATURE"]
    counted = long.filter(F.col("VALUE").isNotNull()).groupBy(*keys, "VALUE").agg(F.count(F.lit(1)).alias("N"))
    found = exact_median(write_through(counted, "median-values"), keys, "VALUE", times="N").collect()  # a row per key
    outside = [r for r in found if not np.isfinite(r["MEDIAN"])]
    if outside:
        some = df.filter(F.col("TARGET_NAME").isin([r["TARGET_NAME"] for r in outside]))
        missed = {(r["TARGET_NAME"], r["FEATURE"]) for r in outside}
        again = feature_medians(some, sorted({r["FEATURE"] for r in outside})).collect()
        found = [r for r in found if (r["TARGET_NAME"], r["FEATURE"]) not in missed]
        found += [r for r in again if (r["TARGET_NAME"], r["FEATURE"]) in missed]
    out: dict[str, dict[str, float]] = {}
    for r in found:
        out.setdefault(r["TARGET_NAME"], {})[r["FEATURE"]] = r["MEDIAN"]
    return out


def learn_encodings(train: DataFrame, settings: TreeSettings = TreeSettings()) -> dict[str, boosting.Encoding]:
    """Per target of the training rows: medians, quantile edges of numbers, values of categories."""
    numeric, cuts = S.NUMERIC_FEATURES, [i / settings.bins for i in range(1, settings.bins)]
    # of the same sketches: values on either side of the median, by more than the error of a rank
    beside = [0.5 - 2 / settings.quantile_accuracy, 0.5 + 2 / settings.quantile_accuracy]
    learned = train.groupBy("TARGET_NAME").agg(
        *[F.percentile_approx(c, [*cuts, *beside], settings.quantile_accuracy).alias(c) for c in numeric],
        *[F.sort_array(F.collect_set(c)).alias(c) for c in S.CATEGORICAL_FEATURES],
    ).orderBy("TARGET_NAME").collect()  # a row per target
    limits = {row["TARGET_NAME"]: {c: tuple(row[c][-2:]) if row[c] else (None, None) for c in numeric} for row in learned}
    medians = medians_between(train, limits, numeric)
    out = {}
    for row in learned:
        known = medians.get(row["TARGET_NAME"], {})
        out[row["TARGET_NAME"]] = boosting.Encoding(
            # a feature without any training value has no median: zero, a constant to the trees
            {c: known.get(c, 0.0) for c in numeric},
            {c: sorted(set((row[c] or ())[:-2])) for c in numeric},
            {c: list(row[c]) for c in S.CATEGORICAL_FEATURES},
        )
    return out


def train_grid(
    prepared: DataFrame,
    targets: Sequence[str] = S.TARGETS,
    feature_sets: Sequence[str] = tuple(FEATURE_SETS),
    settings: TreeSettings = TreeSettings(),
) -> dict[tuple[str, str], TrainedModel]:
    """Every target that has both classes, with every feature set; all are grown together."""
    train = prepared.filter((F.col("SPLIT") == "train") & F.col("TARGET_NAME").isin(list(targets)))
    sizes = {r["TARGET_NAME"]: r for r in metrics.class_weights(train).collect()}  # a row per target
    usable = [t for t in targets if t in sizes and sizes[t]["N_POS"] and sizes[t]["N_NEG"]]
    if not usable:
        return {}
    train = train.filter(F.col("TARGET_NAME").isin(usable))
    learned = learn_encodings(train, settings)
    encodings = {t: learned[t] for t in usable}
    rows = sum(sizes[t]["N_POS"] + sizes[t]["N_NEG"] for t in usable)
    parallel = prepared.sparkSession.sparkContext.defaultParallelism
    tasks = min(-(-rows // LEAST_ROWS), max(parallel, -(-rows // MOST_ROWS)))
    blocks = boosting.encoded(train.coalesce(tasks), encodings)
    weights = {t: float(sizes[t]["POSITIVE_WEIGHT"]) for t in usable}
    columns = [[*FEATURE_SETS[f], *S.CATEGORICAL_FEATURES] for f in feature_sets]
    forests = boosting.fit(write_through(blocks, "training-blocks"), encodings, weights, columns, settings.growth)
    return {
        (t, f): TrainedModel(t, f, encodings[t], forest[t], settings)
        for f, forest in zip(feature_sets, forests)
        for t in usable
    }


def train_target(
    prepared: DataFrame,
    target: str,
    feature_set: str = FULL,
    settings: TreeSettings = TreeSettings(),
) -> TrainedModel | None:
    """One target with one feature set; None when only one class occurs."""
    return train_grid(prepared, [target], [feature_set], settings).get((target, feature_set))


def _parts(models: Mapping[str, TrainedModel]) -> dict[str, tuple[boosting.Encoding, boosting.Forest]]:
    return {t: (m.encoding, m.forest) for t, m in models.items()}


def score(model: TrainedModel, df: DataFrame) -> DataFrame:
    """Add PROBABILITY of the positive class."""
    scored = boosting.probabilities(df, _parts({model.target: model}))
    return scored.select(*df.columns, F.col("PROBABILITIES")[0].alias("PROBABILITY"))


def score_parts(prepared: DataFrame, fitted: Mapping[str, TrainedModel]) -> DataFrame:
    """Train and test rows of each target with its model's score, in one pass."""
    if not fitted:
        raise ValueError("no target has both classes")
    rows = prepared.filter(F.col("TARGET_NAME").isin(list(fitted)))
    return boosting.probability_by_target(rows, _parts(fitted)).select(
        "PATIENT_ID", "TARGET_NAME", "INDEX_DATE", "LABEL", "SPLIT", "PROBABILITY"
    )


def train_score(prepared: DataFrame, targets: Sequence[str], feature_set: str = FULL,
                settings: TreeSettings = TreeSettings()) -> tuple[dict[str, TrainedModel], DataFrame]:
    """Models per trainable target, and train and test rows with their scores."""
    grid = train_grid(prepared, targets, [feature_set], settings)
    fitted = {target: model for (target, _), model in grid.items()}
    return fitted, score_parts(prepared, fitted)


def evaluate(scored: DataFrame) -> DataFrame:
    """One result row per target: test metrics, tuned threshold and train/test accuracy."""
    # read many times below: the counts of every distinct score, which all metrics follow from
    parts = ["TARGET_NAME", "SPLIT"]
    per_score = metrics.count_scores(scored.select(*parts, "LABEL", "PROBABILITY"), parts)
    counts = write_through(metrics.running_counts(write_through(per_score, "scores"), parts), "score-counts")
    test = counts.filter(F.col("SPLIT") == "test")
    best = write_through(metrics.optimal_threshold(metrics.pr_points(test)), "thresholds")
    area = write_through(metrics.area(counts, parts), "areas")
    accuracy = write_through(metrics.accuracy_of_counts(counts, best), "accuracies")

    def side(df: DataFrame, value: str, part: str, name: str) -> DataFrame:
        return df.filter(F.col("SPLIT") == part).select("TARGET_NAME", F.col(value).alias(name))

    joined = [
        metrics.precision_lift(test),
        best.select("TARGET_NAME", F.col("F1").alias("OPTIMAL_F1"), F.col("THRESHOLD").alias("OPTIMAL_THRESHOLD")),
        side(accuracy, "ACCURACY", "train", "TRAIN_ACCURACY"),
        side(accuracy, "ACCURACY", "test", "TEST_ACCURACY"),
        side(area, "ROC_AUC", "train", "TRAIN_ROC_AUC"),
    ]
    table = side(area, "ROC_AUC", "test", "ROC_AUC")
    for part in joined:
        table = table.join(part, "TARGET_NAME", "left")
    digits = {"ROC_AUC": 4, "PR_AUC": 4, "LIFT": 1, "OPTIMAL_F1": 3, "OPTIMAL_THRESHOLD": 3,
              "TRAIN_ACCURACY": 4, "TEST_ACCURACY": 4, "TRAIN_ROC_AUC": 4}
    return table.select("TARGET_NAME", *[F.round(c, d).alias(c) for c, d in digits.items()])


def experiment_comparison(prepared: DataFrame, grid: Mapping[tuple[str, str], TrainedModel]) -> DataFrame:
    """Every target with every feature set of the grid, one result row each."""
    parts = []
    for feature_set in dict.fromkeys(f for _, f in grid):
        fitted = {t: m for (t, f), m in grid.items() if f == feature_set}
        result = evaluate(score_parts(prepared, fitted))
        parts.append(
            result.select(
                "TARGET_NAME",
                F.lit(feature_set).alias("FEATURE_SET"),
                F.lit(MODEL_NAME).alias("MODEL"),
                *result.columns[1:],
            )
        )
    return reduce(DataFrame.unionByName, parts)


def importances(model: TrainedModel) -> dict[str, float]:
    """Mean gain of a feature's splits as a share of all features' mean gains, in column order."""
    names, gained, splits = model.encoding.names(), {}, {}
    for j, row in enumerate(names):
        if j >= model.forest.numeric or list(model.encoding.edges)[j] in FEATURE_SETS[model.feature_set]:
            # a categorical column's last bin stands for values not met in training
            gained |= dict.fromkeys(row[:-1] or row, 0.0)
    used = model.forest.column >= 0
    places = zip(model.forest.column[used].tolist(), model.forest.bin[used].tolist(), model.forest.gain[used].tolist())
    for j, at, gain in places:
        name = names[j][at]
        gained[name] += gain
        splits[name] = splits.get(name, 0) + 1
    means = {n: g / splits.get(n, 1) for n, g in gained.items()}
    total = sum(means.values()) or 1.0
    return {n: m / total for n, m in means.items()}


def feature_importance(spark: SparkSession, model: TrainedModel, top: int | None = 10) -> DataFrame:
    """Importance per feature column, highest first. The row count is the model width."""
    rows = [(model.target, model.feature_set, n, v) for n, v in importances(model).items()]
    out = spark.createDataFrame(rows, "TARGET_NAME string, FEATURE_SET string, FEATURE string, IMPORTANCE double")
    out = out.orderBy(F.desc("IMPORTANCE"), "FEATURE")
    return out if top is None else out.limit(top)


def risk_scores(features: DataFrame, models: Mapping[str, TrainedModel | None],
                targets: Sequence[str] = S.TARGETS) -> DataFrame:
    """Every patient against every target; a missing model gives null, not a failure.

    The features are read once and all models are applied to a batch together.
    """
    there = {t: models[t] for t in targets if models.get(t) is not None}
    scored = boosting.probabilities(feature_contract(features), _parts(there))
    place = {t: F.col("PROBABILITIES")[i] for i, t in enumerate(there)}
    none = F.lit(None).cast("double")
    entries = [F.struct(F.lit(t).alias("TARGET_NAME"), place.get(t, none).alias("PROBABILITY")) for t in targets]
    return scored.select("PATIENT_ID", F.explode(F.array(*entries)).alias("e")).select("PATIENT_ID", "e.*")


# --- registry ---------------------------------------------------------------------
def registry_rows(results: DataFrame, feature_set: str = FULL) -> DataFrame:
    """Metadata record per evaluated model."""
    numeric = FEATURE_SETS[feature_set]
    named = F.concat(F.lit(f"{MODEL_NAME}_{feature_set.replace(' ', '')}_"), F.col("TARGET_NAME"))
    text = F.concat(F.lit(f"{MODEL_NAME} model predicting "), "TARGET_NAME", F.lit(f" using {feature_set.lower()}."))
    training = [c for c in results.columns if c != "TARGET_NAME"]
    return results.select(
        "TARGET_NAME",
        named.alias("MODEL_NAME"),
        F.lit(MODEL_NAME).alias("MODEL_TYPE"),
        F.lit(feature_set).alias("FEATURE_SET"),
        F.lit(",".join(numeric)).alias("NUMERIC_FEATURES"),
        F.lit(",".join(S.CATEGORICAL_FEATURES)).alias("CATEGORICAL_FEATURES"),
        text.alias("DESCRIPTION"),
        *training,
    )


def _folder(target: str) -> str:
    return target.lower().replace(" ", "_")


def model_registry(targets: DataFrame, registry: DataFrame) -> DataFrame:
    """All targets (TARGET_NAME) with their record, and whether a model exists."""
    joined = targets.join(registry, "TARGET_NAME", "left")
    return joined.withColumn("AVAILABLE", F.col("MODEL_NAME").isNotNull())


def _folder(target: str) -> str:
    return target.lower().replace(" ", "_")


def trained_registry(prepared: DataFrame, grid: Mapping[tuple[str, str], TrainedModel],
                     targets: DataFrame) -> DataFrame:
    """The record of every target's fitted models with their own test metrics, per feature set."""
    records = []
    for feature_set in dict.fromkeys(f for _, f in grid):
        fitted = {t: m for (t, f), m in grid.items() if f == feature_set}
        records.append(registry_rows(evaluate(score_parts(prepared, fitted)), feature_set))
    return model_registry(targets, reduce(DataFrame.unionByName, records))


def save_model(spark: SparkSession, model: TrainedModel, root: str, metrics: Mapping[str, float] | None = None) -> str:
    """Write a model as one JSON text, with a row of evaluate(), under root/<target>; returns the folder."""
    path = f"{root.rstrip('/')}/{_folder(model.target)}"
    trees = {name: getattr(model.forest, name).tolist() for name in ("column", "bin", "value", "gain")}
    meta = {
        "target": model.target,
        "feature_set": model.feature_set,
        "encoding": asdict(model.encoding),
        "trees": trees,
        "numeric": model.forest.numeric,
        "settings": asdict(model.settings),
        "metrics": dict(metrics or {}),
    }
    text = spark.createDataFrame([(json.dumps(meta),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
    return path


def load_model(spark: SparkSession, root: str, target: str) -> TrainedModel | None:
    """Read a saved model; None when the folder holds none."""
    if not models_available(spark, root, [target])[target]:
        return None
    meta = json.loads(spark.read.text(f"{root.rstrip('/')}/{_folder(target)}/metadata").first()["value"])
    kinds = {"column": np.int16, "bin": np.int32, "value": float, "gain": float}
    trees = {name: np.array(meta["trees"][name], kind) for name, kind in kinds.items()}
    return TrainedModel(
        meta["target"],
        meta["feature_set"],
        boosting.Encoding(**meta["encoding"]),
        boosting.Forest(**trees, numeric=meta["numeric"]),
        TreeSettings(**meta["settings"]),
    )


def models_available(spark: SparkSession, root: str, targets: Sequence[str] = S.TARGETS) -> dict[str, bool]:
    fs_conf = spark._jsc.hadoopConfiguration()
    found = {}
    for t in targets:
        home = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{_folder(t)}/metadata/_SUCCESS")
        found[t] = home.getFileSystem(fs_conf).exists(home)
    return found
