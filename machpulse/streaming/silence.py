"""Sensors that stopped sending: a periodic check of all known ones, and a timer for each that has sent."""

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from machpulse.functions.fixed_values import SILENCE_THRESHOLD
from machpulse.functions.time_columns import timestamp
from machpulse.operators.quality import silent_sensors
from machpulse.streaming.ingest import utc_now


def silence_check(
    known: DataFrame, seen: DataFrame, as_of: datetime, threshold: str = SILENCE_THRESHOLD
) -> DataFrame:
    """Silent machines at ``as_of``, stamped with it.

    ``seen`` is the last-seen table (``machine_id, last_seen``) that the ingest keeps, one row per machine and
    unfolded batch, so a check never reads the readings. A raw table with ``datetime_mes`` serves too.
    """
    at = timestamp(as_of)
    if "last_seen" in seen.columns:
        seen = seen.withColumnRenamed("last_seen", "datetime_mes")
    return silent_sensors(known, seen, at, threshold).select("machine_id", "last_seen", at.alias("controle_a"))


def watch_silence(
    spark: SparkSession,
    known: Callable[[], DataFrame],
    seen: Callable[[], DataFrame],
    out: str,
    checkpoint: str,
    every: str = "1 minute",
    threshold: str = SILENCE_THRESHOLD,
    clock: Callable[[], datetime] = utc_now,
) -> StreamingQuery:
    """Run the check once per ``every``. Each run reads the tables as they then are and replaces its folder."""

    def check(_: DataFrame, run: int) -> None:
        found = silence_check(known(), seen(), clock(), threshold)
        found.write.mode("overwrite").parquet(f"{out}/controle={run}")

    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    writer = ticks.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every).start()


#: Keyed state with timers needs this store; set it before the query starts.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}
TRANSITIONS = "machine_id int, last_seen timestamp_ntz, etat string, constate_a timestamp_ntz"


def _moment(millis: int) -> datetime:
    return datetime.fromtimestamp(millis / 1000, timezone.utc).replace(tzinfo=None)


class SilenceTimer(StatefulProcessor):
    """One value per machine: its newest reading and whether it was reported silent. One timer: when it will be."""

    def __init__(self, threshold: timedelta):
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("vue", "last_seen timestamp_ntz, silent boolean")

    def _row(self, key, last_seen: datetime, state: str, now: datetime) -> Row:
        return Row(machine_id=key[0], last_seen=last_seen, etat=state, constate_a=now)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = _moment(timerValues.getCurrentProcessingTimeInMs())
        last_seen, silent = self.held.get() if self.held.exists() else (None, False)
        newest = max([row.datetime_mes for row in rows if row.datetime_mes is not None] + ([last_seen] if last_seen else []), default=None)
        if newest is None:
            return
        overdue = newest + self.threshold < now
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not overdue:
            # The first millisecond at which the threshold is exceeded.
            due = (newest + self.threshold).replace(tzinfo=timezone.utc)
            self.handle.registerTimer(int(due.timestamp() * 1000) + 1)
        self.held.update((newest, overdue))
        if overdue != silent:
            yield self._row(key, newest, "silence" if overdue else "retour", now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.held.exists():
            return
        last_seen, silent = self.held.get()
        if not silent:
            self.held.update((last_seen, True))
            yield self._row(key, last_seen, "silence", _moment(expiredTimerInfo.getExpiryTimeInMs()))

    def close(self) -> None:
        pass


def _length(threshold: str) -> timedelta:
    amount, unit = threshold.split()
    return timedelta(**{unit.rstrip("s") + "s": int(amount)})


def silence_transitions(readings: DataFrame, threshold: str = SILENCE_THRESHOLD) -> DataFrame:
    """``machine_id, last_seen, etat, constate_a`` of a stream of readings: one row when a machine falls silent, one when it returns.

    A machine is silent once its newest reading is older than ``threshold``, by the clock of the cluster. State is one
    row per machine, whatever the number of readings; it survives restarts. A machine that has never sent is unknown
    here: the periodic check finds it.
    """
    lean = readings.select("machine_id", F.col("datetime_mes"))
    timer = SilenceTimer(_length(threshold))
    return lean.groupBy("machine_id").transformWithState(timer, TRANSITIONS, "append", "processingTime")


def watch_transitions(
    readings: DataFrame, out: str, checkpoint: str, every: str = "10 seconds", threshold: str = SILENCE_THRESHOLD
) -> StreamingQuery:
    """Write the transitions, one folder per batch that a replay replaces. Needs ``STATE_STORE`` in the session."""
    spark = readings.sparkSession
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)

    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch_id={number}")

    writer = silence_transitions(readings, threshold).writeStream.outputMode("append").foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
