"""The ids of all stored events, kept apart from the tables so that a batch reads few of them.

Layout: root/EVENT_IDS/fresh/BATCH_KEY=<key>/ holds the ids of each batch as it was written, and
root/EVENT_IDS/settled/RUN=<name>/SLICE=<n>/ those of batches that `settle` has joined, cut by hash of
the id, sorted, with a Parquet Bloom filter of the ids in each row group.

A batch looks its ids up in the fresh part, whose size settling bounds, and in the slices of the
settled part that its own ids fall in: equality with each id is pushed to the scan, where min, max
and Bloom filter let only row groups through that may hold one. So what a batch reads follows its
own size and not what is stored. A batch of more than LOOKUP_IDS ids reads the whole index.

Both parts may hold an id twice, and a crash while settling leaves that; lookups don't mind.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import write_through

FOLDER, BATCH_KEY, SLICE, RUN = "EVENT_IDS", "BATCH_KEY", "SLICE", "RUN"
FRESH_SCHEMA = f"event_id string, event_type string, {BATCH_KEY} string"
SETTLED_SCHEMA = f"event_id string, event_type string, WRITER string, {RUN} string, {SLICE} int"
#: Fixed: changing it needs a new index.
SLICES = 64
#: Ids that one batch asks for by value, some 300 a slice; they are gathered on the driver.
LOOKUP_IDS = 20_000
IN_THRESHOLD = "spark.sql.parquet.pushdown.inFilterThreshold"
FALSE_POSITIVES = "0.0001"
#: Ids of one row group.
GROUP_IDS = 1_000_000


def slice_of(event_id="event_id"):
    return F.pmod(F.xxhash64(event_id), F.lit(SLICES)).cast("int")


class EventIds:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root.rstrip('/')}/{FOLDER}"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()

    def _files(self, part: str):
        home = self._path(f"{self.root}/{part}")
        return home.getFileSystem(self._conf), home

    def _names(self, part: str) -> list[str]:
        fs, home = self._files(part)
        return sorted(s.getPath().getName() for s in fs.listStatus(home)) if fs.exists(home) else []

    def exists(self) -> bool:
        return bool(self._names("fresh") or self._names("settled"))

    def _read(self, part: str, schema: str) -> DataFrame:
        if not self._names(part):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{part}").parquet(f"{self.root}/{part}")

    def fresh(self) -> DataFrame:
        return self._read("fresh", FRESH_SCHEMA)

    def settled(self) -> DataFrame:
        return self._read("settled", SETTLED_SCHEMA)

    def append(self, events: DataFrame, batch_key: str) -> None:
        """The ids of a batch; writing a batch again replaces them."""
        place = f"{self.root}/fresh/{BATCH_KEY}={batch_key}"
        events.select("event_id", "event_type").hint("rebalance").write.mode("overwrite").parquet(place)

    def lookup(self, ids: list[tuple[int, str]]) -> DataFrame:
        """Settled rows of some ids, given as (slice, id), by a scan of each of their slices.

        Ids pushed to a scan need a plan made while IN_THRESHOLD is at least their number.
        """
        by_slice: dict[int, list[str]] = {}
        for number, event_id in ids:
            by_slice.setdefault(number, []).append(event_id)
        settled = self.settled()
        parts = [settled.filter((F.col(SLICE) == n) & F.col("event_id").isin(found)) for n, found in by_slice.items()]
        return reduce(DataFrame.unionByName, parts) if parts else settled.limit(0)

    def stored(self, events: DataFrame, batch_key: str) -> DataFrame:
        """event_id and event_type of those of `events`, a written table, that another batch stored."""
        fresh = self.fresh().filter(F.col(BATCH_KEY) != batch_key).select("event_id", "event_type")
        asked = events.select("event_id").distinct()
        if not self._names("settled"):
            settled = self.settled()
        elif asked.count() > LOOKUP_IDS:
            settled = self.settled().join(asked, "event_id", "left_semi")
        else:
            before = self.spark.conf.get(IN_THRESHOLD)
            try:
                self.spark.conf.set(IN_THRESHOLD, str(LOOKUP_IDS))
                ids = [tuple(r) for r in asked.select(slice_of(), "event_id").collect()]  # at most LOOKUP_IDS
                settled = write_through(self.lookup(ids), "stored-ids")
            finally:
                self.spark.conf.set(IN_THRESHOLD, before)
        other = settled.filter(F.col("WRITER") != batch_key).select("event_id", "event_type")
        return fresh.unionByName(other).distinct()

    def settle(self, name: str, whole: bool = False, group_bytes: int | None = None) -> int:
        """Join the fresh ids of committed batches into a run of that name; the number of batches.

        With `whole` the earlier runs are joined in too, so that lookups open one file a slice. New
        rows are written before old ones go.
        """
        keys = self._names("fresh")
        runs = [r for r in self._names("settled") if whole and r != f"{RUN}={name}"]
        if not keys:
            return 0
        taken = [k.partition("=")[2] for k in keys]
        rows = self.fresh().filter(F.col(BATCH_KEY).isin(taken)).select("event_id", "event_type", F.col(BATCH_KEY).alias("WRITER"))
        if runs:
            earlier = self.settled().filter(F.col(RUN).isin([r.partition("=")[2] for r in runs]))
            rows = rows.unionByName(earlier.select("event_id", "event_type", "WRITER"))
        sliced = rows.distinct().withColumn(SLICE, slice_of()).repartition(SLICES, SLICE)
        writer = sliced.sortWithinPartitions(SLICE, "event_id").write.mode("overwrite").partitionBy(SLICE)
        options = {
            "parquet.bloom.filter.enabled#event_id": "true",
            "parquet.bloom.filter.expected.ndv#event_id": str(GROUP_IDS),
            "parquet.bloom.filter.fpp#event_id": FALSE_POSITIVES,
            "parquet.bloom.filter.adaptive.enabled": "true",
            "partitionOverwriteMode": "static",
        }
        if group_bytes:
            options["parquet.block.size"] = str(group_bytes)
        writer.options(**options).parquet(f"{self.root}/settled/{RUN}={name}")
        for part, old in [*(("fresh", k) for k in keys), *(("settled", r) for r in runs)]:
            fs, home = self._files(f"{part}/{old}")
            fs.delete(home, True)
        return len(keys)
