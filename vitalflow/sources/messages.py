"""Event messages: reading a topic or folder as a stream, and publishing envelopes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import events

TOPIC = "medical-events"
ARRIVAL = "ARRIVAL_TS"


def read_event_stream(
    spark: SparkSession,
    source: str = "kafka",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Streaming rows of `value` and ARRIVAL_TS.

    For kafka pass `kafka.bootstrap.servers`; the topic, start at the latest offset and
    tolerance of lost offsets are defaults that `options` may override. Any other source
    is a folder of text files with one envelope per line. ARRIVAL_TS is the broker's time,
    or the time of the micro-batch, which is logged and so the same on replay.
    """
    reader = spark.readStream.format(source)
    if source == "kafka":
        defaults = {"subscribe": TOPIC, "startingOffsets": "latest", "failOnDataLoss": "false"}
        raw = reader.options(**{**defaults, **(options or {})}).load()
        return raw.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias(ARRIVAL))
    raw = reader.options(**(options or {})).load(path)
    return raw.select("value", F.current_timestamp().alias(ARRIVAL))


def publish_events(
    df: DataFrame,
    sink: str = "kafka",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    validate: bool = True,
) -> DataFrame:
    """Write envelopes, keyed by patient. Returns the rejected ones with a reason.

    Valid ones only, with their defaults, or with `validate` off all whose payload is a JSON
    object, as they are.
    """
    identified = events.identify(df)
    if validate:
        good, bad = events.merge_defaults(events.accepted(identified)), events.quarantine(identified)
    else:
        readable = events.is_object()
        good = identified.filter(readable)
        bad = identified.filter(~readable).withColumn("REASON", F.lit(events.REJECT_PAYLOAD))
    out = events.serialize_envelope(good)
    if sink == "kafka":
        defaults = {"topic": TOPIC, "kafka.acks": "all", "kafka.retries": "3"}
        out.write.format("kafka").options(**{**defaults, **(options or {})}).save()
    else:
        out.select("value").write.format(sink).options(**(options or {})).mode("append").save(path)
    return bad
