"""Piecewise ranking, totals and medians against plain windows, with hot keys and copies."""

import random
import statistics

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vitalflow.functions import exact_median, hash_key, keep_top, running_totals, split_row_number
from vitalflow.functions.ranking import count_copies


def _skewed(spark, n=3000):
    """A third of the rows under one key, a third without a key."""
    rng = random.Random(7)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{rng.randrange(40)}"
        rows.append((key, rng.randrange(30), rng.randrange(10)))
    return spark.createDataFrame(rows, "k string, v int, w int")


def _numbered(df):
    return df.withColumn("h", hash_key("k", "v", "w")).withColumn("p", F.substring("h", 1, 1))


@pytest.mark.parametrize("copies", [False, True])
def test_split_row_number_equals_window(spark, copies):
    df = _skewed(spark)
    if copies:
        got = split_row_number(_numbered(count_copies(df, "t")), ["k"], ["p"], [F.col("h")], "n", "t")
    else:
        got = split_row_number(_numbered(df), ["k"], ["p"], [F.col("h")], "n")
    want = _numbered(df).withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("p", "h")))
    columns = ["k", "v", "w", "n"]

    def rows(x):
        return sorted(map(str, x.select(*columns).collect()))

    # equal rows are interchangeable, so compare as sorted sets of numbered rows
    assert rows(got) == rows(want)


def test_many_copies_are_cut_into_parts(spark):
    df = spark.createDataFrame([("a", "x", 25), ("a", "y", 1), ("b", "x", 10)], "k string, v string, t bigint")
    tagged = df.withColumn("p", F.lit("0"))
    rows = split_row_number(tagged, ["k"], ["p"], [F.col("v")], "n", "t", chunk=10).collect()
    assert sorted(r["n"] for r in rows if r["k"] == "a") == list(range(1, 27))
    assert sorted(r["n"] for r in rows if r["k"] == "b") == list(range(1, 11))
    assert sum(r["v"] == "y" for r in rows) == 1


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_equal_window(spark, descending):
    df = _skewed(spark).filter("k is not null").groupBy("k", "v").agg(F.count(F.lit(1)).alias("c"))
    got = running_totals(df, ["k"], "v", {"s": "c"}, pieces=7, descending=descending)
    order = F.col("v").desc() if descending else F.col("v")
    want = df.withColumn("s", F.sum("c").over(Window.partitionBy("k").orderBy(order)))
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())


def test_running_totals_on_one_hot_range(spark):
    """Most values crowd into a tiny range; pieces follow the data."""
    df = spark.range(5000).select(
        F.lit("t").alias("k"), (F.col("id") / 1e9 + F.when(F.col("id") % 50 == 0, 1).otherwise(0)).alias("v"), F.lit(1).alias("c")
    )
    got = running_totals(df, ["k"], "v", {"s": "c"}).orderBy("v").select("s").collect()
    assert [r["s"] for r in got] == list(range(1, 5001))


def test_exact_median(spark):
    rng = random.Random(3)
    data = {"a": [rng.random() for _ in range(501)], "b": [rng.randrange(5) * 1.0 for _ in range(400)], "c": [2.5]}
    rows = [(k, v) for k, vs in data.items() for v in vs] + [("a", None), ("d", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r["MEDIAN"] for r in exact_median(df, ["k"], "v").collect()}
    assert got == {k: statistics.median(v) for k, v in data.items()}


def test_keep_top_limits_before_the_shuffle(spark):
    df = _skewed(spark)
    top = keep_top(df, ["k"], [F.col("v").desc(), F.col("w")], 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert top.filter("k = 'hot'").count() == 3


def test_edges_below_a_value_are_found_by_halving(spark):
    from vitalflow.functions.ranking import edges_below

    rng = random.Random(9)
    rows = []
    for n in (0, 1, 2, 7, 8, 9, 254, 255):
        edges = sorted({round(rng.random(), 4) for _ in range(n)})
        values = [None, float("nan"), float("-inf"), -1.0, 2.0, *edges[:3], *edges[-2:], *[rng.random() for _ in range(20)]]
        rows += [(edges, v) for v in values]
    df = spark.createDataFrame(rows, "E array<double>, V double")
    found = df.select(edges_below(F.col("E"), F.col("V"), 256).alias("N"), F.size(F.filter("E", lambda e: e < F.col("V"))).alias("M"))
    assert all(r["N"] == r["M"] for r in found.collect())
    plan = running_totals(df.select(F.lit(1).alias("K"), "V", F.lit(1).alias("C")), ["K"], "V", {"T": "C"})
    assert "lambdafunction((edge" not in plan._jdf.queryExecution().optimizedPlan().toString(), "each value meets every edge"


def test_pieces_are_cut_once(spark):
    """Merged in another order, sketches give other cuts; offsets and rows of other pieces don't belong together."""
    df = spark.range(1000).select(F.lit(1).alias("K"), F.rand(1).alias("V"), F.lit(1).alias("C"))
    plan = running_totals(df, ["K"], "V", {"T": "C"})._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile_approx" not in plan
