"""Data-quality profiles. Each one is a single aggregation over the table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType

from ..functions import is_missing, parse_timestamp


def null_profile(df: DataFrame) -> DataFrame:
    """COLUMN_NAME, MISSING and TOTAL for every column that is not a timestamp."""
    fields = [f for f in df.schema if not isinstance(f.dataType, (TimestampType, TimestampNTZType))]
    total = "__total"

    def missing(field) -> Column:
        c = F.col(f"`{field.name}`")
        return is_missing(c) if isinstance(field.dataType, StringType) else c.isNull()

    counts = df.agg(
        F.count(F.lit(1)).alias(total), *[F.count_if(missing(f)).alias(f.name) for f in fields]
    )
    return counts.unpivot(
        [total], [F.col(f"`{f.name}`") for f in fields], "COLUMN_NAME", "MISSING"
    ).select("COLUMN_NAME", "MISSING", F.col(total).alias("TOTAL"))


def over_tables(
    tables: Mapping[str, DataFrame], profile: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """One profile of several tables, with TABLE_NAME in front."""
    parts = [profile(df).select(F.lit(name).alias("TABLE_NAME"), "*") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def null_profile_pct(df: DataFrame) -> DataFrame:
    """Missing share in percent, for columns that miss anything."""
    return (
        null_profile(df)
        .filter(F.col("MISSING") > 0)
        .select("COLUMN_NAME", "MISSING", (F.col("MISSING") / F.col("TOTAL") * 100).alias("MISSING_PCT"))
    )


def key_uniqueness(df: DataFrame, key: str, approximate: bool = False) -> DataFrame:
    """Row count against distinct key count."""
    distinct = F.approx_count_distinct(key) if approximate else F.count_distinct(key)
    return df.agg(F.count(F.lit(1)).alias("TOTAL_ROWS"), distinct.alias("DISTINCT_KEYS"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Total, distinct and surplus full rows, from one pass of row counts."""
    times = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    return times.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("TOTAL_ROWS"),
        F.count(F.lit(1)).alias("DISTINCT_ROWS"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("DUPLICATE_ROWS"),
    )


def interval_anomalies(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table, the number of intervals that stop before they start."""
    parts = [
        df.agg(
            F.lit(name).alias("TABLE_NAME"),
            F.count(F.lit(1)).alias("TOTAL_ROWS"),
            F.count_if(parse_timestamp("STOP") < parse_timestamp("START")).alias("ANOMALIES"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def layer_report(tables: Mapping[str, DataFrame], required: Sequence[str] = ()) -> DataFrame:
    """Per table: rows, columns and whether the required metadata columns are there."""
    parts = [
        df.agg(
            F.lit(name).alias("TABLE_NAME"),
            F.count(F.lit(1)).alias("ROW_COUNT"),
            F.lit(len(df.columns)).cast("bigint").alias("COLUMN_COUNT"),
            F.lit("OK" if set(required) <= set(df.columns) else "MISSING METADATA COLUMNS").alias("STATUS"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def manifest_missing(spark: SparkSession, expected: Iterable[str], found: DataFrame) -> DataFrame:
    """Expected table names absent from `found` (column TABLE_NAME)."""
    wanted = spark.createDataFrame([(name,) for name in expected], "TABLE_NAME string")
    return wanted.join(found.select(F.lower("TABLE_NAME").alias("TABLE_NAME")), "TABLE_NAME", "left_anti")


# --- profiles that are kept per loaded batch and merged ------------------------------------------
#: Registers of a distinct-count sketch, as a power of two: a standard error of 0.8 percent.
SKETCH = 14


def profile_state(df: DataFrame, batch: str) -> DataFrame:
    """What one batch adds to a table's profile: a row per column, BATCH in front.

    TOTAL and MISSING are counts and VALUES is a sketch of the distinct values (nulls left out), so
    states of batches add up to that of all rows without reading the rows again.
    """
    found = df.agg(
        F.count(F.lit(1)).alias("TOTAL"),
        *[_missing_count(f).alias(f"m_{i}") for i, f in enumerate(df.schema)],
        # a sketch leaves out empty texts, so each value gets a mark in front
        *[
            F.hll_sketch_agg(F.concat(F.lit("="), F.col(f"`{f.name}`").cast("string")), SKETCH).alias(f"v_{i}")
            for i, f in enumerate(df.schema)
        ],
    )
    rows = [
        F.struct(F.lit(f.name).alias("COLUMN_NAME"), F.col(f"m_{i}").alias("MISSING"), F.col(f"v_{i}").alias("VALUES"))
        for i, f in enumerate(df.schema)
    ]
    listed = found.select("TOTAL", F.explode(F.array(*rows)).alias("c"))
    return listed.select(F.lit(batch).alias("BATCH"), "c.COLUMN_NAME", "TOTAL", "c.MISSING", "c.VALUES")


def _missing_count(field) -> Column:
    c = F.col(f"`{field.name}`")
    return F.count_if(is_missing(c) if isinstance(field.dataType, StringType) else c.isNull())


def merged_profile(states: DataFrame) -> DataFrame:
    """The profile of all batches: COLUMN_NAME, TOTAL, MISSING and DISTINCT_VALUES, an estimate.

    A batch that was stored twice counts once.
    """
    once = states.groupBy("BATCH", "COLUMN_NAME").agg(
        F.max("TOTAL").alias("TOTAL"), F.max("MISSING").alias("MISSING"), F.hll_union_agg("VALUES").alias("VALUES")
    )
    # a batch without rows has a state of its own and adds nothing
    return once.groupBy("COLUMN_NAME").agg(
        F.sum("TOTAL").alias("TOTAL"),
        F.sum("MISSING").alias("MISSING"),
        F.hll_sketch_estimate(F.hll_union_agg("VALUES")).alias("DISTINCT_VALUES"),
    )
