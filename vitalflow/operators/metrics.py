"""Model evaluation as DataFrame aggregations.

Input is a score table: TARGET_NAME, LABEL (0/1), PROBABILITY and, where split parts are
compared, SPLIT. Rows are first counted per distinct score, so ties are exact and a score
shared by many rows is one row; cumulative counts then run in pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hash_key, running_totals, split_row_number

F1_EPSILON = 1e-9


def class_guard(df: DataFrame) -> DataFrame:
    """Targets with whether both classes occur."""
    return df.groupBy("TARGET_NAME").agg(
        F.count(F.lit(1)).alias("ROW_COUNT"),
        F.coalesce(F.min("LABEL") != F.max("LABEL"), F.lit(False)).alias("TRAINABLE"),
    )


def stratified_split(df: DataFrame, key: str, test_share: float = 0.2) -> DataFrame:
    """Add SPLIT: the first `test_share` of each target and label by hash of the key is test.

    Exact and repeatable; the key must be unique within a target. Classes are few and
    large, so the ranking is piecewise.
    """
    hashed = df.withColumn("__h", hash_key("TARGET_NAME", key)).withColumn("__p", F.substring("__h", 1, 3))
    strata = ["TARGET_NAME", "LABEL"]
    ranked = split_row_number(hashed, strata, ["__p"], [F.col("__h"), F.col(key)], "__r")
    sizes = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("__n"))
    test = F.col("__r") <= F.col("__n") * F.lit(test_share)
    return ranked.join(sizes, strata).select(*df.columns, F.when(test, "test").otherwise("train").alias("SPLIT"))


def class_weights(df: DataFrame) -> DataFrame:
    """Weight of the positive class, negatives over positives, per target."""
    counts = df.groupBy("TARGET_NAME").agg(
        F.count_if(F.col("LABEL") == 0).alias("N_NEG"), F.count_if(F.col("LABEL") == 1).alias("N_POS")
    )
    weight = F.when(F.col("N_POS") > 0, F.col("N_NEG") / F.col("N_POS"))
    return counts.withColumn("POSITIVE_WEIGHT", weight)


def count_scores(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per distinct score its positives and negatives."""
    return df.groupBy(*keys, "PROBABILITY").agg(
        F.count_if(F.col("LABEL") == 1).alias("POS"), F.count_if(F.col("LABEL") == 0).alias("NEG")
    )


def running_counts(per_score: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The counts of every score, and those at or above it."""
    return running_totals(per_score, keys, "PROBABILITY", {"TP": "POS", "FP": "NEG"}, descending=True)


def cumulative_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per distinct score: its positives and negatives, and those at or above it."""
    return running_counts(count_scores(df, keys), keys)


def _class_totals(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count_if(F.col("LABEL") == 1).alias("P"), F.count_if(F.col("LABEL") == 0).alias("N")
    )


def pr_curve(df: DataFrame, keys: Sequence[str] = ("TARGET_NAME",)) -> DataFrame:
    """Precision, recall and F1 at every distinct score as threshold."""
    keys = list(keys)
    return _points(cumulative_counts(df, keys).join(_class_totals(df, keys), keys), keys)


def pr_points(counts: DataFrame, keys: Sequence[str] = ("TARGET_NAME",)) -> DataFrame:
    """pr_curve() from the running counts of the scores."""
    totals = counts.groupBy(*keys).agg(F.sum("POS").alias("P"), F.sum("NEG").alias("N"))
    return _points(counts.join(totals, list(keys)), keys)


def _points(curve: DataFrame, keys: Sequence[str]) -> DataFrame:
    precision = F.col("TP") / (F.col("TP") + F.col("FP"))
    recall = F.when(F.col("P") > 0, F.col("TP") / F.col("P"))
    points = curve.select(
        *keys, F.col("PROBABILITY").alias("THRESHOLD"), precision.alias("PRECISION"), recall.alias("RECALL")
    )
    p, r = F.col("PRECISION"), F.col("RECALL")
    return points.withColumn("F1", F.lit(2.0) * p * r / (p + r + F.lit(F1_EPSILON)))


def optimal_threshold(curve: DataFrame, keys: Sequence[str] = ("TARGET_NAME",)) -> DataFrame:
    """The threshold with the highest F1; the lowest such threshold on a tie."""
    best = F.max(F.struct("F1", (-F.col("THRESHOLD")).alias("T")))
    return curve.groupBy(*keys).agg(best.alias("b")).select(
        *keys, (-F.col("b.T")).alias("THRESHOLD"), F.col("b.F1").alias("F1")
    )


def accuracy_at_threshold(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Share of right predictions per target and split part."""
    hit = (F.col("PROBABILITY") >= F.col("THRESHOLD")).cast("int") == F.col("LABEL")
    joined = df.join(thresholds.select("TARGET_NAME", "THRESHOLD"), "TARGET_NAME")
    return joined.groupBy("TARGET_NAME", "SPLIT").agg(F.avg(hit.cast("double")).alias("ACCURACY"))


def accuracy_of_counts(counts: DataFrame, thresholds: DataFrame) -> DataFrame:
    """accuracy_at_threshold() from the counts of the scores."""
    hits = F.when(F.col("PROBABILITY") >= F.col("THRESHOLD"), F.col("POS")).otherwise(F.col("NEG"))
    joined = counts.join(thresholds.select("TARGET_NAME", "THRESHOLD"), "TARGET_NAME")
    share = F.sum(hits) / F.sum(F.col("POS") + F.col("NEG"))
    return joined.groupBy("TARGET_NAME", "SPLIT").agg(share.alias("ACCURACY"))


def roc_auc(df: DataFrame, keys: Sequence[str] = ("TARGET_NAME",)) -> DataFrame:
    """Area under the ROC curve; ties count half. Null for a single class."""
    return area(cumulative_counts(df, keys), keys)


def area(counts: DataFrame, keys: Sequence[str] = ("TARGET_NAME",)) -> DataFrame:
    """roc_auc() from the running counts of the scores."""
    keys = list(keys)
    above = F.col("TP") - F.col("POS")
    area = F.sum(F.col("NEG") * (above + F.col("POS") / 2))
    sums = counts.groupBy(*keys).agg(
        area.alias("A"), F.sum("POS").alias("P"), F.sum("NEG").alias("N")
    )
    valid = (F.col("P") > 0) & (F.col("N") > 0)
    return sums.select(*keys, F.when(valid, F.col("A") / (F.col("P") * F.col("N"))).alias("ROC_AUC"))


def average_precision_lift(df: DataFrame, keys: Sequence[str] = ("TARGET_NAME",)) -> DataFrame:
    """Average precision, prevalence and their ratio (0 without positives)."""
    return precision_lift(cumulative_counts(df, keys), keys)


def precision_lift(counts: DataFrame, keys: Sequence[str] = ("TARGET_NAME",)) -> DataFrame:
    """average_precision_lift() from the running counts of the scores."""
    keys = list(keys)
    weighted = F.sum(F.col("POS") * F.col("TP") / (F.col("TP") + F.col("FP")))
    sums = counts.groupBy(*keys).agg(
        weighted.alias("A"), F.sum("POS").alias("P"), F.sum("NEG").alias("N")
    )
    some = F.col("P") > 0
    out = sums.select(
        *keys,
        F.when(some, F.col("A") / F.col("P")).otherwise(0.0).alias("PR_AUC"),
        (F.col("P") / (F.col("P") + F.col("N"))).alias("PREVALENCE"),
    )
    return out.withColumn("LIFT", F.when(F.col("PREVALENCE") > 0, F.col("PR_AUC") / F.col("PREVALENCE")).otherwise(0.0))


def classification_report(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Per class, accuracy, macro and weighted averages, from one confusion count."""
    predicted = (F.col("PROBABILITY") >= F.col("THRESHOLD")).cast("int")
    marked = df.join(thresholds.select("TARGET_NAME", "THRESHOLD"), "TARGET_NAME").withColumn("Y", predicted)

    def cell(label: int, y: int):
        return F.count_if((F.col("LABEL") == label) & (F.col("Y") == y))

    cells = marked.groupBy("TARGET_NAME").agg(
        cell(1, 1).alias("TP"), cell(0, 1).alias("FP"), cell(1, 0).alias("FN"), cell(0, 0).alias("TN")
    )

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(0.0)

    def line(name: str, hit: str, false_hit: str, miss: str):
        h, fh, m = F.col(hit), F.col(false_hit), F.col(miss)
        return F.struct(
            F.lit(name).alias("CLASS"),
            ratio(h, h + fh).alias("PRECISION"),
            ratio(h, h + m).alias("RECALL"),
            ratio(2.0 * h, 2 * h + fh + m).alias("F1"),
            (h + m).alias("SUPPORT"),
        )

    both = cells.select("TARGET_NAME", "TP", "TN", line("0", "TN", "FN", "FP").alias("c0"), line("1", "TP", "FP", "FN").alias("c1"))
    total = F.col("c0.SUPPORT") + F.col("c1.SUPPORT")

    def mean(name: str, weighted: bool):
        def value(f: str):
            if weighted:
                top = F.col(f"c0.{f}") * F.col("c0.SUPPORT") + F.col(f"c1.{f}") * F.col("c1.SUPPORT")
                return (top / total).alias(f)
            return ((F.col(f"c0.{f}") + F.col(f"c1.{f}")) / 2).alias(f)

        return F.struct(F.lit(name).alias("CLASS"), *[value(f) for f in ("PRECISION", "RECALL", "F1")], total.alias("SUPPORT"))

    none = F.lit(None).cast("double")
    accuracy = F.struct(
        F.lit("accuracy").alias("CLASS"),
        none.alias("PRECISION"),
        none.alias("RECALL"),
        ((F.col("TP") + F.col("TN")) / total).alias("F1"),
        total.alias("SUPPORT"),
    )
    lines = F.array(F.col("c0"), F.col("c1"), accuracy, mean("macro avg", False), mean("weighted avg", True))
    return both.select("TARGET_NAME", F.explode(lines).alias("r")).select("TARGET_NAME", "r.*")
