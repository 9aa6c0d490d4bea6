"""The event stream: parse, name, judge; then each micro-batch drops repeats and is routed.

The reading, judging and typing are the functions of `operators.events`, which the batch
path shares.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import events
from ..sources import realtime
from ..sources.messages import ARRIVAL

TRIGGER = "10 seconds"


def judged_stream(raw: DataFrame) -> DataFrame:
    """Envelope columns, P, REASON, EVENT_TS and the RAW text of a stream of raw messages.

    Nothing is dropped here: a rejected event and its corrected copy share an id, and every
    reject is kept with its text.
    """
    text = F.col("value").cast("string").alias(events.RAW)
    envelope = events.parse_envelope(raw, keep=[text, ARRIVAL])
    return events.judge(events.identify(envelope, F.col(ARRIVAL)))


def route_batch(root: str, stream_id: str, on_counts: Callable[[int, dict], None] | None = None):
    """The foreachBatch function. A repeated batch id rewrites the same folders.

    Valid events are reduced to one per id and to ids that no other batch has stored, however
    long ago; rejects are all kept.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        key = f"{stream_id}-{batch_id}"
        realtime.create_realtime_tables(batch.sparkSession, root)
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            bad = held.filter(F.col("REASON").isNotNull()).drop("P")
            if bad.take(1):
                realtime.append_quarantine(bad, root, key)
            valid = held.filter(F.col("REASON").isNull()).drop("REASON", events.RAW)
            # one job writes all tables
            counts = realtime.append_new(valid, root, key)
            if on_counts is not None:
                on_counts(batch_id, counts)
        finally:
            held.unpersist()

    return run


def start_ingest(
    raw: DataFrame,
    root: str,
    checkpoint: str,
    stream_id: str = "stream",
    once: bool = False,
    trigger: str = TRIGGER,
    on_counts: Callable[[int, dict], None] | None = None,
) -> StreamingQuery:
    """Start the job. `stream_id` names the checkpoint: use a new id with a new checkpoint.

    `once` works off what is there and stops.
    """
    realtime.create_realtime_tables(raw.sparkSession, root)
    writer = (
        judged_stream(raw)
        .writeStream.foreachBatch(route_batch(root, stream_id, on_counts))
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)).start()


def start_window_counts(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    width: str = "1 day",
    lateness: str = "1 day",
    once: bool = False,
) -> StreamingQuery:
    """Monitoring: valid events per type and window, each window written once it closes.

    An event dated after its arrival counts at its arrival, so one wrong date cannot close
    windows early. Copies within `lateness` count once.
    """
    valid = judged_stream(raw).filter(F.col("REASON").isNull())
    timed = valid.withColumn("EVENT_TS", F.least("EVENT_TS", ARRIVAL)).withWatermark("EVENT_TS", lateness)
    once_each = timed.dropDuplicatesWithinWatermark(["event_id"])
    counts = events.events_per_window(once_each, width)
    writer = (
        counts.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=TRIGGER)).start()
