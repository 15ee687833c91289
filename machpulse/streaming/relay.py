"""Relay of raw sensor messages to the keyed topic that the ingest reads."""

from datetime import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from machpulse.functions.time_columns import timestamp
from machpulse.sources.messages import parse_messages, to_messages, topic_matches
from machpulse.streaming.ingest import utc_now

#: Topics that carry measurements: one level for the machine.
SENSOR_TOPICS = "usine/capteurs/+/mesure"


def sorted_out(messages: DataFrame, pattern: str = SENSOR_TOPICS, typed: bool = False) -> DataFrame:
    """The messages whose ``topic`` fits the pattern, parsed; others are none of the relay's."""
    return parse_messages(messages.filter(topic_matches(F.col("topic"), pattern)), typed=typed)


def keyed(parsed: DataFrame) -> DataFrame:
    """(key, value) of the well-formed messages."""
    return to_messages(parsed.filter(F.col("malformed_reason").isNull()))


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Topic, text and reason of the malformed messages."""
    return parsed.filter(F.col("malformed_reason").isNotNull()).select("topic", F.col("value").cast("string").alias("value"), "malformed_reason")


def relay(
    messages: DataFrame, options: dict[str, str], checkpoint: str, sink: str = "kafka", pattern: str = SENSOR_TOPICS,
    available_now: bool = False, rejects: str | None = None, clock: Callable[[], datetime] = utc_now,
    typed: bool = False,
) -> StreamingQuery:
    """Publish the keyed messages of a stream with ``topic`` and ``value`` to a sink given by format and options, such as
    ``kafka_target``.

    Malformed messages go to the folder ``rejects``, beside the checkpoint unless given, with their reason and time. Each
    batch replaces its own folder there, and in a sink with a ``path``; another sink may get a batch that is replayed twice.
    ``typed`` converts values by their JSON types, see ``parse_messages``.
    """
    rejects = rejects or f"{checkpoint.rstrip('/')}_rejets"

    def publish(batch: DataFrame, number: int) -> None:
        parsed = sorted_out(batch, pattern, typed).persist()
        try:
            letters = dead_letters(parsed).withColumn("horodatage_rejet", timestamp(clock()))
            letters.write.mode("overwrite").parquet(f"{rejects}/batch_id={number}")
            target, mode = dict(options), "append"
            if "path" in target:
                target["path"], mode = f"{target['path'].rstrip('/')}/batch_id={number}", "overwrite"
            keyed(parsed).write.format(sink).options(**target).mode(mode).save()
        finally:
            parsed.unpersist()

    writer = messages.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
