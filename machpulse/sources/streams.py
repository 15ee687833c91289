"""Streaming sources and options of the keyed topic."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from machpulse.functions.fixed_values import FLUSH_MESSAGES, FLUSH_SECONDS
from machpulse.schemas import fields


#: A micro-batch is kept in executor memory while it is written; a backlog is worked off in batches of this size.
MAX_OFFSETS = 1_000_000


def kafka_options(servers: str, topic: str, max_offsets: int | None = MAX_OFFSETS) -> dict[str, str]:
    """Start at the earliest offset; fire at 500 messages or after 10 seconds, whichever is first.

    The source itself watches both limits, so the query must ask it without pause: see ``run_stream``. At most
    ``max_offsets`` messages make one batch, the rest wait for the next; None takes a backlog in one.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "minOffsetsPerTrigger": str(FLUSH_MESSAGES),
        "maxTriggerDelay": f"{FLUSH_SECONDS}s",
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = MAX_OFFSETS) -> DataFrame:
    """``key, value, topic, partition, offset``. Needs the Kafka connector on the class path."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topic, max_offsets)).load()
    return stream.select("key", "value", "topic", "partition", "offset")


def file_stream(
    spark: SparkSession, path: str, schema: StructType, max_files: int | None = None, file_format: str = "parquet"
) -> DataFrame:
    reader = spark.readStream.format(file_format).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """One message per line in column ``value``."""
    return file_stream(spark, path, fields("value STRING"), max_files, "text")


def kafka_target(servers: str, topic: str) -> dict[str, str]:
    """Options of a topic to publish (key, value) rows to, as ``relay`` takes them."""
    return {"kafka.bootstrap.servers": servers, "topic": topic}
