"""Alert rules and health panels evaluated while data arrives."""

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from machpulse.functions.fixed_values import ALERT_HOLD, ALERT_RULES, ALERT_STEP
from machpulse.functions.time_columns import timestamp
from machpulse.operators.monitoring import alert_episodes, fleet_maxima, health_of_batches, states_at
from machpulse.operators.telemetry import trend_of_state
from machpulse.sources.telemetry_store import TelemetryStore
from machpulse.streaming.derived import AlertJournal, alerts_now
from machpulse.streaming.ingest import utc_now


def alert_check(
    state: DataFrame, as_of: datetime, rules=ALERT_RULES, hold: str = ALERT_HOLD, step: str = ALERT_STEP, max_age: str | None = None
) -> DataFrame:
    """The rules' states at ``as_of``, worked out from the whole stored window state.

    An alert goes on as long as no later window is below its threshold, however old it is, unless ``max_age`` is given.
    ``watch_alerts`` reads the same from the journal that the stream keeps.
    """
    at = timestamp(as_of)
    maxima = fleet_maxima(trend_of_state(state.filter(F.col("fenetre") <= at)), rules)
    episodes = alert_episodes(maxima, rules, step, max_age)
    return states_at(episodes, maxima, at, rules, hold, step, max_age).withColumn("controle_a", at)


def watch(
    spark: SparkSession, check: Callable[[datetime], DataFrame], out: str, checkpoint: str, every: str = "1 minute",
    clock: Callable[[], datetime] = utc_now,
) -> StreamingQuery:
    """Run a check, of alerts or panels, once per ``every``. Each run reads the tables as they then are and replaces its folder."""

    def run(_: DataFrame, number: int) -> None:
        check(clock()).write.mode("overwrite").parquet(f"{out}/controle={number}")

    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    writer = ticks.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every).start()


def watch_alerts(
    spark: SparkSession, store: TelemetryStore, out: str, checkpoint: str, every: str = "1 minute",
    journal: AlertJournal = AlertJournal(), hold: str = ALERT_HOLD, clock: Callable[[], datetime] = utc_now,
) -> StreamingQuery:
    """The rules' states once per ``every``, from the journal of a stream that runs with the same ``journal``."""

    def check(now: datetime) -> DataFrame:
        return alerts_now(spark, store, timestamp(now), journal, hold).withColumn("controle_a", timestamp(now))

    return watch(spark, check, out, checkpoint, every, clock)


def watch_health(
    spark: SparkSession, store: TelemetryStore, out: str, checkpoint: str, every: str = "1 minute",
    clock: Callable[[], datetime] = utc_now,
) -> StreamingQuery:
    """The health panels once per ``every``, from the one row per batch that the stream keeps."""

    def check(now: datetime) -> DataFrame:
        return health_of_batches(store.read(spark, "lots"), timestamp(now)).withColumn("controle_a", timestamp(now))

    return watch(spark, check, out, checkpoint, every, clock)
