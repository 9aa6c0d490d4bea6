"""Exact ordered computations that never put one whole key into one task.

A plain window over a key sends all of that key's rows to a single task. The helpers
below cut every key into ordered *pieces*, work inside pieces, and add per-piece
offsets. A piece is a set of columns that never decreases along the wanted order, so
(piece, order) sorts the same way as the order itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import write_through

# Pieces per key when they are cut from the data. Bounded: it is the size of one
# array per key and the number of offset rows per key.
PIECES = 256
# Copies of one row written out by one task at a time.
COPY_CHUNK = 1_000_000


def hash_key(*parts: Column | str) -> Column:
    """Stable 32-digit hash text of some columns; equal in every engine and on replay.

    Each part stands behind its length and a missing one is a mark without a length, so no two
    lists of parts give one text.
    """
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    marked = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~")) for t in texts]
    return F.md5(F.concat(*marked))


def keep_top(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int | None) -> DataFrame:
    """The first `n` rows of every key; all of them for None.

    Spark turns `row_number() <= n` into a group limit that runs before the shuffle, so a
    hot key contributes at most n rows per map task.
    """
    if n is None:
        return df
    rank = "__rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n).drop(rank)


def count_copies(df: DataFrame, times: str) -> DataFrame:
    """Distinct rows with how often each occurs; equal rows are combined before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(times))


def split_row_number(
    df: DataFrame,
    keys: Sequence[str],
    piece: Sequence[str],
    order: Sequence[Column],
    name: str,
    times: str | None = None,
    chunk: int = COPY_CHUNK,
) -> DataFrame:
    """row_number() over (keys order by piece, order), computed piece by piece.

    `piece` columns must be non-null. The keys may hold nulls, which form one group as in a
    window. Only piece counts, not rows, are brought together per key.

    With `times` each row stands for that many equal rows, which are numbered together and
    then written out in parts of `chunk`, dealt anew so that one row's copies are spread.
    """
    group, base, first, part = "__group", "__base", "__first", "__part"
    given = [c for c in df.columns if c != times]
    # One text per key, so that the join below is a plain equi-join on the same columns as
    # the window and needs no second shuffle of the rows. It is declared non-null: a null
    # filter inferred from the join would sit on one side only and keep Spark from sharing
    # the exchange that both sides start from.
    key = F.coalesce(F.md5(F.to_json(F.struct(*keys))), F.lit(""))
    tagged = df.withColumn(group, key)
    pieces = list(piece)
    inside = Window.partitionBy(group, *pieces).orderBy(*order)
    if times is None:
        size, local = F.count(F.lit(1)), F.row_number().over(inside)
    else:
        running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        size, local = F.sum(times), F.sum(times).over(running) - F.col(times) + 1
    # one level of the piece at a time, so that a window holds the values of one level only
    offsets = tagged.groupBy(group, *pieces).agg(size.alias("__n"))
    counted, starts = offsets, []
    for level in range(len(pieces), 0, -1):
        above = [group, *pieces[: level - 1]]
        before = Window.partitionBy(*above).orderBy(pieces[level - 1]).rowsBetween(Window.unboundedPreceding, -1)
        begin = F.coalesce(F.sum("__n").over(before), F.lit(0))
        starts.append((level, counted.select(*above, pieces[level - 1], begin.alias(f"__b{level}"))))
        counted = counted.groupBy(*above).agg(F.sum("__n").alias("__n"))
    level, offsets = starts[0]
    for upper, table in starts[1:]:
        offsets = offsets.join(table, [group, *pieces[:upper]])
    total = sum((F.col(f"__b{k}") for k, _ in starts[1:]), F.col(f"__b{level}"))
    offsets = offsets.select(group, *pieces, total.alias(base))
    placed = tagged.withColumn(first, local).join(offsets, [group, *pieces])
    start = F.col(base) + F.col(first)
    if times is None:
        return placed.select(*given, start.alias(name))
    parts = F.explode(F.sequence(F.lit(0), F.floor((F.col(times) - 1) / chunk)))
    dealt = placed.select(*given, start.alias(name), times, parts.alias(part)).hint("rebalance")
    begin, end = F.col(name) + F.col(part) * chunk, F.col(name) + F.col(times) - 1
    numbers = F.sequence(begin, F.least(end, begin + (chunk - 1)))
    return dealt.select(*given, F.explode(numbers).alias(name))


def edges_below(edges: Column, value: Column, most: int) -> Column:
    """How many of fewer than `most` sorted edges lie below a value, by halving: 8 steps for 256."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(most.bit_length()))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(edges, at + step - 1) < value, at + step).otherwise(at)
    )


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    totals: Mapping[str, str],
    pieces: int = PIECES,
    descending: bool = False,
) -> DataFrame:
    """Cumulative sums along a numeric column, inclusive of the current row.

    `df` must hold one row per (keys, order) value: aggregate first. `totals` maps new
    column names to summed columns. Cut points are approximate quantiles, so pieces are
    of like size whatever the distribution; the result itself is exact.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("running_totals needs at least one key column")
    cut, slot = "__cuts", "__slot"
    fractions = [i / pieces for i in range(1, pieces)]
    cuts = df.groupBy(*keys).agg(
        F.array_sort(F.array_distinct(F.percentile_approx(order, fractions, 10 * pieces))).alias(cut)
    )
    # The rows are placed twice below, and sketches merged in another order give other cuts: written, they
    # are the same for both. One small row per key; the optimizer decides on broadcast from its size.
    placed = df.join(write_through(cuts, "cuts"), keys)
    slots = edges_below(F.col(cut), F.col(order), pieces)
    placed = placed.withColumn(slot, -slots if descending else slots).drop(cut)
    sums = placed.groupBy(*keys, slot).agg(*[F.sum(c).alias(f"__s_{n}") for n, c in totals.items()])
    before = Window.partitionBy(*keys).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *keys,
        slot,
        *[F.coalesce(F.sum(f"__s_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in totals],
    )
    direction = F.col(order).desc() if descending else F.col(order).asc()
    inside = (
        Window.partitionBy(*keys, slot)
        .orderBy(direction)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = placed.withColumns({f"__l_{n}": F.sum(c).over(inside) for n, c in totals.items()})
    joined = local.join(offsets, [*keys, slot])
    return joined.select(
        *df.columns, *[(F.col(f"__o_{n}") + F.col(f"__l_{n}")).alias(n) for n in totals]
    )


def exact_median(
    df: DataFrame, keys: Sequence[str], value: str, name: str = "MEDIAN", times: str | None = None
) -> DataFrame:
    """Exact median per key: the mean of the middle one or two values, nulls left out.

    Values are counted first, so repeated values cost nothing, and the position of each
    value comes from piecewise running totals. With `times` each row stands for that many.
    """
    keys = list(keys)
    size = F.count(F.lit(1)) if times is None else F.sum(times)
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(size.alias("__c"))
    last = running_totals(counted, keys, value, {"__last": "__c"})
    size = counted.groupBy(*keys).agg(F.sum("__c").alias("__n"))
    placed = last.join(size, keys)
    low = F.floor((F.col("__n") + 1) / 2)
    high = F.floor((F.col("__n") + 2) / 2)
    first = F.col("__last") - F.col("__c") + 1

    def holds(position: Column) -> Column:
        return (first <= position) & (position <= F.col("__last"))

    return (
        placed.filter(holds(low) | holds(high))
        .groupBy(*keys)
        .agg(((F.min(value) + F.max(value)) / 2).alias(name))
    )
