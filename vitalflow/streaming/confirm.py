"""Confirmation of published events: stored within a deadline, or timed out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..operators import events
from ..sources import realtime
from ..sources.messages import ARRIVAL

DEADLINE = "30 seconds"
#: How much later than others of its time an event may come and still be counted.
LATENESS = "10 seconds"
CONFIRMED, TIMED_OUT = "CONFIRMED", "TIMED_OUT"


def published_stream(raw: DataFrame) -> DataFrame:
    """event_id, event_type and PUBLISHED_TS of the valid events of a stream of raw messages."""
    envelope = events.parse_envelope(raw, keep=[ARRIVAL])
    valid = events.accepted(events.identify(envelope, F.col(ARRIVAL)))
    return valid.select("event_id", "event_type", F.col(ARRIVAL).alias("PUBLISHED_TS"))


def stored_stream(spark: SparkSession, root: str) -> DataFrame:
    """event_id, event_type and STORED_TS of all realtime tables as one stream of their files."""
    kinds = F.create_map(*[F.lit(x) for kind, table in S.EVENT_TABLES.items() for x in (table, kind)])
    rows = spark.readStream.schema(f"EVENT_ID string, INGESTION_TS timestamp, {realtime.TABLE} string").parquet(
        realtime.events_path(root)
    )
    return rows.select(
        F.col("EVENT_ID").alias("event_id"), kinds[F.col(realtime.TABLE)].alias("event_type"), F.col("INGESTION_TS").alias("STORED_TS")
    )


def confirmations(published: DataFrame, stored: DataFrame, within: str = DEADLINE, lateness: str = LATENESS) -> DataFrame:
    """Published events with STATUS and STORED_TS, each once, as soon as its outcome is known.

    The two streams are joined on the id within the deadline. An event that is stored later, or never,
    comes out as timed out when the watermarks of both have passed its deadline; state is dropped then.
    Works on tables too, where every event that has no partner is timed out at once.
    """
    sent, kept = published, stored.withColumnsRenamed({"event_id": "stored_id", "event_type": "stored_type"})
    if published.isStreaming:
        sent, kept = sent.withWatermark("PUBLISHED_TS", lateness), kept.withWatermark("STORED_TS", lateness)
        # copies of an event are stored once, so they are asked for once
        sent = sent.dropDuplicatesWithinWatermark(["event_id", "event_type"])
    else:
        sent, kept = sent.dropDuplicates(["event_id", "event_type"]), kept.dropDuplicates(["stored_id", "stored_type"])
    deadline = F.col("PUBLISHED_TS") + F.expr(f"INTERVAL {within}")
    same = (F.col("event_id") == F.col("stored_id")) & (F.col("event_type") == F.col("stored_type"))
    timely = (F.col("STORED_TS") >= F.col("PUBLISHED_TS")) & (F.col("STORED_TS") <= deadline)
    status = F.when(F.col("stored_id").isNotNull(), CONFIRMED).otherwise(TIMED_OUT)
    return sent.join(kept, same & timely, "left_outer").select(
        "event_id", "event_type", "PUBLISHED_TS", "STORED_TS", status.alias("STATUS")
    )


def start_confirmations(
    published: DataFrame,
    stored: DataFrame,
    path: str,
    checkpoint: str,
    within: str = DEADLINE,
    lateness: str = LATENESS,
    once: bool = False,
    trigger: str = "10 seconds",
) -> StreamingQuery:
    """Write outcomes to Parquet files at `path` as they become known."""
    writer = (
        confirmations(published, stored, within, lateness)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)).start()
