"""The append-only realtime tables.

Layout: root/EVENTS/TABLE=RT_x/EVENT_DATE=<day>/BATCH_KEY=<writer and batch>/. A batch writes all its
tables in one job of typed rows, owns its BATCH_KEY folders and overwrites them, so writing the same
batch again after a failure leaves the same rows. A table is its folder read by its own schema.
Below it EVENT_DATE stands first, so date-bound reads list one folder; events without a readable
time of their own share the folder of no date. `compact_day` joins the small files of many
batches. Ids are also kept in an index of their own (sources.id_index), in which a batch looks up
what is stored already.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from .. import schemas as S
from ..operators import events
from ..session import write_through
from .id_index import EventIds

QUARANTINE = "RT_QUARANTINE"
TABLE, BATCH_KEY, EVENT_DATE = "TABLE", "BATCH_KEY", events.EVENT_DATE
DIRECT, COMPACTED = "direct", "compacted"


def _stored(schema: StructType) -> StructType:
    return StructType(
        [*schema.fields, StructField(EVENT_DATE, DateType()), StructField(BATCH_KEY, StringType())]
    )


def events_path(root: str) -> str:
    return f"{root.rstrip('/')}/EVENTS"


def table_path(root: str, table: str) -> str:
    if table == QUARANTINE:
        return f"{root.rstrip('/')}/{table}"
    return f"{events_path(root)}/{TABLE}={table}"


def create_realtime_tables(spark: SparkSession, root: str) -> None:
    """Make the eight table folders where they are absent."""
    conf = spark._jsc.hadoopConfiguration()
    for table in S.REALTIME_SCHEMAS:
        home = spark._jvm.org.apache.hadoop.fs.Path(table_path(root, table))
        home.getFileSystem(conf).mkdirs(home)


def read_realtime(spark: SparkSession, root: str, table: str, stored: bool = False) -> DataFrame:
    """A realtime table by its declared schema; empty if nothing was written yet."""
    schema = S.REALTIME_SCHEMAS[table]
    df = spark.read.schema(_stored(schema)).parquet(table_path(root, table))
    return df if stored else df.select(*schema.names)


def realtime_state(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {t: read_realtime(spark, root, t) for t in S.REALTIME_SCHEMAS}


def append_batch(df: DataFrame, root: str, table: str, batch_key: str) -> None:
    """Write one batch's rows, which carry EVENT_DATE, into its own folders."""
    rows = df.withColumn(BATCH_KEY, F.lit(batch_key))
    # few, full files per day; a large day is cut into several. Only the folders of this batch
    # are replaced.
    rows.hint("rebalance", EVENT_DATE).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(EVENT_DATE, BATCH_KEY).parquet(table_path(root, table))


def append_quarantine(df: DataFrame, root: str, batch_key: str) -> None:
    df.write.mode("overwrite").parquet(f"{table_path(root, QUARANTINE)}/{BATCH_KEY}={batch_key}")


def append_events(good: DataFrame, root: str, batch_key: str) -> None:
    """Write a batch's events to the folders of all their tables in one job."""
    typed = events.parse_typed(good, keep=[EVENT_DATE]).withColumnRenamed("TABLE_NAME", TABLE)
    typed.withColumn(BATCH_KEY, F.lit(batch_key)).hint("rebalance", TABLE, EVENT_DATE).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(TABLE, EVENT_DATE, BATCH_KEY).parquet(events_path(root))


def index_stored(spark: SparkSession, root: str) -> EventIds:
    """The id index; made from the tables where they hold rows and it is not there."""
    index = EventIds(spark, root)
    if not index.exists():
        parts = [
            read_realtime(spark, root, table, stored=True).select(
                F.col("EVENT_ID").alias("event_id"), F.lit(kind).alias("event_type"), BATCH_KEY
            )
            for kind, table in S.EVENT_TABLES.items()
        ]
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        if every.take(1):
            every.write.partitionBy(BATCH_KEY).mode("overwrite").parquet(f"{index.root}/fresh")
    return index


def new_events(df: DataFrame, root: str, batch_key: str) -> DataFrame:
    """Events whose id no other batch has stored yet, however long ago; a written table.

    Rows of the batch itself do not count, so running a batch again gives the same rows.
    """
    asked = write_through(df, "batch")
    ids = index_stored(df.sparkSession, root).stored(asked, batch_key)
    return write_through(asked.join(ids, ["event_id", "event_type"], "left_anti"), "new-events")


def append_new(valid: DataFrame, root: str, batch_key: str) -> dict[str, int]:
    """Store the new ones of a batch's valid events, and their ids. Returns rows per type.

    Ids are written last: a batch that fails before is not known, and runs again as a whole.
    """
    fresh = new_events(events.dedup_events(valid), root, batch_key)
    counts = {r["event_type"]: r["ROW_COUNT"] for r in events.route_counts(fresh).collect()}
    if counts:
        append_events(fresh, root, batch_key)
        EventIds(valid.sparkSession, root).append(fresh, batch_key)
    return counts


def compact_day(spark: SparkSession, root: str, table: str, day: str | None, name: str) -> int:
    """Join the files of all batches of one day (None: of no date) into one set of files.

    Run it for days whose batches are committed. The joined rows are written first, one per id,
    and then the batches' folders go: a crash between leaves copies that the next run removes,
    and a batch that is replayed later finds its ids stored and adds nothing. Returns the
    number of folders removed.
    """
    stored = read_realtime(spark, root, table, stored=True)
    on_day = F.col(EVENT_DATE).isNull() if day is None else F.col(EVENT_DATE) == F.lit(day).cast("date")
    keys = [r[0] for r in stored.filter(on_day).select(BATCH_KEY).distinct().collect()]  # one per batch
    target = f"{COMPACTED}-{name}"
    old = [k for k in keys if k != target]
    if not old:
        return 0
    rest = [c for c in stored.columns if c not in ("EVENT_ID", BATCH_KEY)]
    once = stored.filter(on_day).groupBy("EVENT_ID").agg(F.min(F.struct(*rest)).alias("r"))
    rows = once.select("EVENT_ID", "r.*").select(*[c for c in stored.columns if c != BATCH_KEY])
    # a plan may not overwrite a folder that it reads
    append_batch(write_through(rows, "compacted") if target in keys else rows, root, table, target)
    folder = "__HIVE_DEFAULT_PARTITION__" if day is None else day
    # ids that a batch finds under another key than its own count as stored when it runs again
    kind = next(k for k, t in S.EVENT_TABLES.items() if t == table)
    joined = read_realtime(spark, root, table, stored=True).filter(on_day & (F.col(BATCH_KEY) == target))
    held = joined.select(F.col("EVENT_ID").alias("event_id"), F.lit(kind).alias("event_type"))
    EventIds(spark, root).append(held, f"{target}-{table}-{folder}")
    conf = spark._jsc.hadoopConfiguration()
    for key in old:
        path = spark._jvm.org.apache.hadoop.fs.Path(
            f"{table_path(root, table)}/{EVENT_DATE}={folder}/{BATCH_KEY}={key}"
        )
        path.getFileSystem(conf).delete(path, True)
    return len(old)


def direct_append(df: DataFrame, root: str, batch_key: str) -> dict[str, int]:
    """Batch path for envelopes when no broker is there: same rules, same tables.

    Events that another batch has stored, such as the stream's, are left out. Running the
    same batch key again rewrites the same rows. Returns rows per type.
    """
    create_realtime_tables(df.sparkSession, root)
    key = f"{DIRECT}-{batch_key}"
    judged = events.judge(events.identify(df))
    append_quarantine(judged.filter(F.col("REASON").isNotNull()).drop("P"), root, key)
    valid = judged.filter(F.col("REASON").isNull()).drop("REASON")
    return append_new(valid, root, key)
