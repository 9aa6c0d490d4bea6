"""Positions of rows in a sorted order, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise

#: Row numbers within a partition stand in the low bits of Spark's own row numbers.
_PARTITION_BITS = 33


def positions(rows: DataFrame, group: str, order: Sequence[str], name: str, size: str, place: str) -> DataFrame:
    """Adds each row's position from 0 in its group, and the group's size.

    `rows` must be read from files, so that a task that runs again sees the same rows. They are
    sorted once by ranges of (group, order, place in the files) and written. Ranges cut groups of
    any size, and rows that are equal in all, so no key has to fit one task. What is then counted
    per range and group has fewer rows than there are ranges and groups together. Nulls are a
    group like any other and come first in the order.
    """
    tie, part, seq, first, before = "__tie", "__part", "__seq", "__first", "__before"
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)] + [F.col(tie)]
    tagged = rows.withColumn(tie, F.monotonically_increasing_id())
    ranged = tagged.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(tie)
    number = F.monotonically_increasing_id()
    numbered = ranged.withColumn(part, F.shiftright(number, _PARTITION_BITS)).withColumn(
        seq, number.bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1))
    )
    written = materialise(numbered, place)
    counts = written.groupBy(group, part).agg(F.count(F.lit(1)).alias(size), F.min(seq).alias(first))
    whole = Window.partitionBy(group)
    so_far = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(group).alias("__group"),
        F.col(part).alias("__its"),
        (F.coalesce(F.sum(size).over(so_far), F.lit(0)) - F.col(first)).alias(before),
        F.sum(size).over(whole).alias(size),
    )
    same = F.col(group).eqNullSafe(F.col("__group")) & (F.col(part) == F.col("__its"))
    joined = written.join(starts, same)
    return joined.select(*rows.columns, (F.col(before) + F.col(seq)).alias(name), size)
