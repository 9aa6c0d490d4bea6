"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Every document of a source has the same expected number of copies, target / source size. The
documents of a source stand in a fixed order; the running sum of expected copies plus one
random offset per source crosses integers, and a document is taken once for each integer that
it crosses. The order puts documents of like size together, which keeps the words taken near
the target: (size class, md5 of doc_id, doc_id, size).

The running sum is rank x expected copies, so only the rank in a source is needed. A source is
cut into pieces (size class, first two digits of the md5); rows are ranked inside pieces, and
counts of pieces are added up per class and per source. The largest window over rows is one
piece and a hot source is spread over hundreds of them.

Sources are ordered by code point, null last, and weigh `weights` in turn. Targets share the
size of all documents by weight but stop at `most` times a source's size; what is left over is
shared again until no target is above: the fixed point of that is one common level, found from
running sums over the sources in order of cap / weight.

Nulls: null text has size 0; null source is a source of its own; a null doc_id sorts as empty.
Repeated rows are documents of their own. Empty tables give no rows. In a source of size 0 all
rows take 0. Columns named like the results are kept aside in a struct and never clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD

WEIGHTS, MOST, SEED = (1, 2, 3), 3, 17


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """Eight classes for each doubling; 0 for 0."""
    bits = F.length(F.bin(size))
    lead = F.call_function("shiftright", size, F.greatest(bits - 4, F.lit(0)))
    return F.when(size > 0, bits * 8 + lead % 8).otherwise(F.lit(0)).cast("int")


def random_offset(key: Column, seed: int) -> Column:
    """One number in [0, 1) for each source, from a hash: reruns agree."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}|"), key)), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)


def measure(
    docs: DataFrame,
    keep: Sequence[str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """row (a struct of the kept columns), size, and what the order of a source needs."""
    size = word_count(docs[text])
    digest = F.md5(F.coalesce(docs[doc_id].cast("string"), F.lit("")))
    return docs.select(
        F.struct(*[docs[c] for c in (docs.columns if keep is None else keep)]).alias("row"),
        docs[doc_id].alias("doc"),
        docs[source].alias("source"),
        F.coalesce(F.concat(F.lit("s"), docs[source]), F.lit("n")).alias("key"),
        size.alias("size"),
        size_class(size).alias("class"),
        F.substring(digest, 1, 2).alias("digits"),
        digest.alias("digest"),
    )


def targets(sources: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """sources: key, source, source_size, one row each. Adds target.

    These are rows per source, not documents, so one task takes them.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")
    named = sources.select(
        "*",
        F.element_at(F.array(*map(F.lit, weights)), turn).cast("long").alias("weight"),
        (F.col("source_size") * most).alias("cap"),
    )
    by_level = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    so_far = by_level.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # what is left if all sources of a lower level are capped, and who shares it
    left = named.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left"),
        F.sum("weight").over(onward).alias("sharers"),
    )
    fits = F.col("left") * F.col("weight") <= F.col("cap") * F.col("sharers")
    level = F.first(F.when(fits, F.struct("left", "sharers")), ignorenulls=True).over(so_far)
    shared = (F.col("weight") * F.col("level.left")).cast("double") / F.col("level.sharers")
    return left.withColumn("level", level).select(
        "key",
        "source_size",
        F.coalesce(shared, F.col("cap").cast("double")).alias("target"),
    )


def mix(
    measured: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
) -> DataFrame:
    """row, size, source_size, target, copies for every row of measure()."""
    piece = ["key", "class", "digits"]
    pieces = measured.groupBy(*piece).agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"), F.first("source").alias("source")
    )
    classes = pieces.groupBy("key", "class").agg(
        F.sum("n").alias("n"), F.sum("words").alias("words"), F.first("source").alias("source")
    )
    sources = classes.groupBy("key").agg(F.sum("words").alias("source_size"), F.first("source").alias("source"))
    back = (Window.unboundedPreceding, -1)
    of_class = Window.partitionBy("key", "class").orderBy("digits").rowsBetween(*back)
    of_source = Window.partitionBy("key").orderBy("class").rowsBetween(*back)
    class_start = classes.select(
        "key", "class", F.coalesce(F.sum("n").over(of_source), F.lit(0)).alias("class_start")
    ).join(targets(sources, weights, most), "key")
    starts = pieces.select(
        *piece, F.coalesce(F.sum("n").over(of_class), F.lit(0)).alias("piece_start")
    ).join(class_start, ["key", "class"])
    inside = Window.partitionBy(*piece).orderBy("digest", "doc", "size")
    ranked = measured.select(
        "row", "size", *piece, F.row_number().over(inside).alias("place")
    ).join(starts, piece)
    rank = F.col("class_start") + F.col("piece_start") + F.col("place")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = random_offset(F.col("key"), seed)
    crossed = F.floor(rank * share + start) - F.floor((rank - 1) * share + start)
    return ranked.select("row", "size", "source_size", "target", crossed.cast("long").alias("copies"))


def emit(mixed: DataFrame) -> DataFrame:
    """The kept columns of each row, as often as the mix takes it."""
    times = mixed.filter(F.col("copies") > 0).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    )
    return times.select("row.*")


#: The same by windows over whole sources.
ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS key, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
         CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size
  FROM documents),
c AS (
  SELECT *, CASE WHEN size > 0 THEN length(bin(size)) * 8 + (size >> greatest(length(bin(size)) - 4, 0)) % 8
            ELSE 0 END AS class FROM d),
s AS (SELECT key, source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY key, source),
w AS (
  SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight, source_size * {MOST} AS cap FROM s),
l AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS sharers,
         row_number() OVER o AS place
  FROM w WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, source ASC NULLS LAST)),
f AS (SELECT place, rest, sharers FROM l WHERE rest * weight <= cap * sharers ORDER BY place LIMIT 1),
t AS (
  SELECT key, source_size, CASE WHEN l.place >= f.place THEN CAST(weight * f.rest AS DOUBLE) / CAST(f.sharers AS DOUBLE)
         ELSE CAST(cap AS DOUBLE) END AS target,
         CAST(('0x' || substr(md5('{SEED}|' || key), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE) AS start
  FROM l LEFT JOIN f ON true),
r AS (
  SELECT c.doc_id, c.size, t.*, row_number() OVER (PARTITION BY c.key ORDER BY class, digest, doc_id, size) AS place,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS share
  FROM c JOIN t USING (key))
SELECT doc_id, size, source_size, target,
       CAST(floor(place * share + start) - floor((place - 1) * share + start) AS BIGINT) * size AS taken
FROM r
"""
