"""One streaming query from raw messages to lake, raw table, quarantine, dead letters and state."""

import logging
import time
from collections.abc import Callable
from datetime import datetime, timezone
from functools import partial

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from machpulse.functions.fixed_values import FLUSH_SECONDS, WINDOW
from machpulse.functions.time_columns import seconds_between, timestamp
from machpulse.operators.quality import flag_out_of_range
from machpulse.plans.together import together
from machpulse.sources.messages import parse_messages
from machpulse.sources.telemetry_store import (
    KEEP_SECONDS, RATIO, TABLES, TelemetryStore, edge_rows, lake_rows, quarantine_rows, raw_rows, seen_rows, state_rows,
)
from machpulse.streaming.derived import AlertJournal, update_alerts, update_maxima, update_trend

log = logging.getLogger(__name__)

PACED_BY_SOURCE = "0 seconds"


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)


def classify(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Parsed messages with ``statut``: ``malforme``, ``quarantaine`` or ``valide``."""
    flagged = flag_out_of_range(parse_messages(messages, value_col))
    status = (
        F.when(F.col("malformed_reason").isNotNull(), "malforme")
        .when(F.col("motif").isNotNull(), "quarantaine")
        .otherwise("valide")
    )
    return flagged.withColumn("statut", status)


_COUNTED = {"valides": "valide", "quarantaine": "quarantaine", "malformes": "malforme"}


def process_batch(
    messages: DataFrame, batch_id: int, store: TelemetryStore, clock: Callable[[], datetime] = utc_now, trend: bool = True,
    alerts: AlertJournal | None = None,
) -> dict[str, int]:
    """Write one micro-batch: dead letters, quarantine, lake, raw table, window state and edges, last seen, trend, counts.

    With ``alerts`` the journal of breaches follows, which needs the trend.

    The batch is parsed once, and counted while its dead letters are written; tables that do not read each other are
    written side by side. A sink without rows is not written, so a fully quarantined batch leaves no lake file. Every
    write replaces the folder of this batch, so a replay changes nothing.
    """
    spark = messages.sparkSession
    rows = classify(messages).persist()
    try:
        at = timestamp(clock())
        status = F.col("statut")
        sound = status == "valide"
        counted = Observation()
        observed = rows.observe(
            counted,
            *[F.count_if(status == key).alias(name) for name, key in _COUNTED.items()],
            F.max(F.when(sound, F.col("datetime_mes"))).cast("string").alias("derniere"),
            F.coalesce(F.sum(F.when(sound, seconds_between("datetime_mes", at))), F.lit(0)).alias("latence_somme"),
        )

        def only(key: str) -> DataFrame:
            return rows.filter(status == key)

        def write(table: str, made: DataFrame) -> Callable[[], None]:
            return partial(store.write_batch, table, batch_id, made)

        letters = observed.filter(status == "malforme").select(
            F.col("value").cast("string").alias("value"), "malformed_reason", at.alias("horodatage_rejet")
        )
        store.write_batch("rejets", batch_id, letters)
        facts = counted.get
        totals = {name: facts[name] for name in _COUNTED}
        if not totals["malformes"]:
            store.remove_batch(spark, "rejets", batch_id)
        if not any(totals.values()):
            return totals
        steps = []
        if totals["quarantaine"]:
            steps.append(write("quarantaine", quarantine_rows(only("quarantaine"), at)))
        if totals["valides"]:
            valid = only("valide")
            made = {
                "lac": lake_rows(valid, at), "telemetrie": raw_rows(valid, at), "etats": state_rows(valid),
                "bords": edge_rows(valid), "vus": seen_rows(valid),
            }
            steps += [write(table, frame) for table, frame in made.items()]
        if steps:
            together(spark, *steps)
        summary = spark.range(1, numPartitions=1).select(
            *[F.lit(n).cast("long").alias(name) for name, n in totals.items()], at.alias("horodatage"),
            F.lit(facts["derniere"]).cast("timestamp_ntz").alias("derniere"), F.lit(facts["latence_somme"]).cast("long").alias("latence_somme"),
        )

        def follow() -> None:
            update_trend(spark, store, batch_id)
            if alerts:
                update_maxima(spark, store, batch_id, alerts)
                update_alerts(spark, store, batch_id, alerts)

        last = [write("lots", summary)]
        if (trend or alerts) and totals["valides"]:
            last.append(follow)
        together(spark, *last)
        log.info("batch %s: %s", batch_id, totals)
        return totals
    finally:
        rows.unpersist()


#: Levels that the stream itself merges: a segment of the last one holds some 4,000 batches. ``fold_all`` merges on.
STREAM_LEVELS = 3


def fold_finished(spark: SparkSession, store: TelemetryStore, levels: int | None = STREAM_LEVELS, keep_seconds: float = KEEP_SECONDS) -> None:
    """Fold all batches but the newest of every table, and drop what was folded ``keep_seconds`` ago."""

    def fold(table: str) -> None:
        newest = store.newest_batch(spark, table)
        if newest > 0:
            store.compact(spark, table, newest - 1, levels)
            store.drop_folded(spark, table, keep_seconds)

    together(spark, *[partial(fold, table) for table in TABLES])


def fold_all(spark: SparkSession, store: TelemetryStore) -> None:
    """Merge the segments of every table on all levels; for a job beside the stream, once a day."""
    for table in TABLES:
        store.merge(spark, table)


def run_stream(
    source: DataFrame,
    store: TelemetryStore,
    checkpoint: str,
    available_now: bool = False,
    clock: Callable[[], datetime] = utc_now,
    every: str = f"{FLUSH_SECONDS} seconds",
    compact_every: int | None = RATIO,
    keep_seconds: float = KEEP_SECONDS,
    trend: bool = True,
    alerts: AlertJournal | None = None,
) -> StreamingQuery:
    """Start the query. Offsets are committed only after all writes of a batch succeeded.

    ``every`` paces sources that cannot wait by themselves. With Kafka it should be ``PACED_BY_SOURCE``: the source
    then fires at 500 messages or after 10 seconds, instead of being asked only every 10 seconds. Each
    ``compact_every`` batches the finished ones of every table are folded; None leaves them as they are.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, store, clock, trend, alerts)
        if compact_every and batch_id and batch_id % compact_every == 0:
            fold_finished(batch.sparkSession, store, keep_seconds=keep_seconds)

    writer = source.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def keep_running(start: Callable[[], StreamingQuery], restarts: int, wait_seconds: float = FLUSH_SECONDS) -> int:
    """Run a query to its end, starting it again from its checkpoint when a batch fails.

    Returns how often it had to be restarted; the last failure is raised once ``restarts`` are used up.
    """
    used = 0
    while True:
        try:
            start().awaitTermination()
            return used
        except StreamingQueryException:
            if used >= restarts:
                raise
            used += 1
            log.exception("operational alert: micro-batch failed, restart %s of %s", used, restarts)
            time.sleep(wait_seconds)


def watermarked_windows(stream: DataFrame, delay: str, window: str = WINDOW) -> DataFrame:
    """Windows kept in Spark's own streaming state, for ``update`` mode.

    Another contract than the stored partials: readings later than ``delay`` are dropped.
    """
    # Watermarks only take timestamps with a zone; the column is back to its own type in the result.
    timed = stream.withColumn("datetime_mes", F.col("datetime_mes").cast("timestamp"))
    return (
        timed.withWatermark("datetime_mes", delay)
        .groupBy("machine_id", F.window("datetime_mes", window).alias("w"))
        .agg(
            F.sqrt(F.avg(F.col("vibration") * F.col("vibration"))).alias("rms_vibration"),
            F.avg("pressure").alias("pression_moyenne"),
        )
        .select("machine_id", F.col("w.start").cast("timestamp_ntz").alias("fenetre"), "rms_vibration", "pression_moyenne")
    )
