"""The journal of breaches and the rows per batch, beside a replay over everything."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from machpulse.functions.time_columns import timestamp
from machpulse.operators import monitoring
from machpulse.operators.telemetry import trend_of_state
from machpulse.sources.telemetry_store import TelemetryStore
from machpulse.streaming import derived, ingest
from tests.helpers import at, message, rows_of

START = datetime(2030, 2, 2, 9)


def deliver(spark, store, number, journal, readings):
    """One batch of (machine, minute, vibration, pressure)."""
    texts = [message(machine_id=m, time=(START + timedelta(minutes=k)).isoformat(), vibration=v, pressure=p) for m, k, v, p in readings]
    ingest.process_batch(spark.createDataFrame([(t,) for t in texts], "value string"), number, store, lambda: START, alerts=journal)


def replayed(spark, store, journal):
    maxima = monitoring.fleet_maxima(trend_of_state(store.read_state(spark)), journal.rules)
    return monitoring.alert_episodes(maxima, journal.rules, journal.step, journal.max_age)


def agree(spark, store, journal, minutes):
    assert rows_of(derived.read_episodes(spark, store)) == rows_of(replayed(spark, store, journal))
    trend = trend_of_state(store.read_state(spark))
    for minute in minutes:
        now = START + timedelta(minutes=minute)
        live = derived.alerts_now(spark, store, timestamp(now), journal).select("rule", "eval_at", F.round("value", 6).alias("value"), "state")
        until = timestamp(now)
        whole = monitoring.alert_states(trend.filter(F.col("fenetre") <= until), journal.rules, step=journal.step, until=until, max_age=journal.max_age)
        last = whole.groupBy("rule").agg(F.max_by(F.struct("eval_at", F.round("value", 6).alias("value"), "state"), "eval_at").alias("s"))
        assert rows_of(live) == rows_of(last.select("rule", "s.*"))


@pytest.mark.parametrize("max_age, step", [(None, "1 minute"), ("3 minutes", "1 minute"), (None, "5 minutes")])
def test_live_equals_replay_after_each_batch(spark, tmp_path, max_age, step):
    rng = random.Random(11)
    store = TelemetryStore(str(tmp_path / "store"))
    journal = derived.AlertJournal(step=step, max_age=max_age)
    for number in range(4):
        # Late readings too: they start breaches, end them, join two and take one back.
        readings = [
            (rng.randint(1, 2), rng.randint(0, 12 + 6 * number), rng.choice([20.0, 60.0, 80.0]), rng.choice([90.0, 100.0, 130.0]))
            for _ in range(rng.randint(1, 6))
        ]
        deliver(spark, store, number, journal, readings)
        if number == 2:
            deliver(spark, store, number, journal, readings)
            ingest.fold_finished(spark, store, keep_seconds=0)
        agree(spark, store, journal, (7, 60))


def test_late_data_take_a_breach_back(spark, tmp_path):
    store, journal = TelemetryStore(str(tmp_path / "store")), derived.AlertJournal(rules={"rms_vibration": 45.0})
    deliver(spark, store, 0, journal, [(1, 0, 60.0, 100.0), (1, 4, 20.0, 100.0), (1, 8, 60.0, 100.0)])

    def held():
        return [(debut.minute, fin and fin.minute) for debut, fin in rows_of(derived.read_episodes(spark, store), "debut", "fin")]

    assert held() == [(0, 3), (8, None)]
    # The first window falls below the threshold, the second rises above it.
    deliver(spark, store, 1, journal, [(1, 0, 10.0, 100.0), (1, 0, 10.0, 100.0), (1, 0, 10.0, 100.0), (1, 0, 10.0, 100.0), (1, 4, 90.0, 100.0)])
    assert held() == [(4, None)]
    assert rows_of(store.read(spark, "alertes").filter("version = 1"), "debut", "retire") == [
        (at("2030-02-02T09:00:00"), True), (at("2030-02-02T09:04:00"), False), (at("2030-02-02T09:08:00"), True),
    ]
    (row,) = derived.alerts_now(spark, store, timestamp("2031-01-01 00:00:00"), journal).collect()
    assert row.state == "firing" and row.value == 60.0


def test_panels_from_the_rows_per_batch(spark, tmp_path):
    store = TelemetryStore(str(tmp_path / "store"))
    clocks = [datetime(2030, 2, 1, 9), datetime(2030, 2, 2, 8, 30), datetime(2030, 2, 2, 9)]
    for number, clock in enumerate(clocks):
        texts = [message(time=(clock - timedelta(seconds=20 + 10 * k)).isoformat()) for k in range(number + 1)]
        texts += [message(volt=999.0)] * number + ["{"] * number
        ingest.process_batch(spark.createDataFrame([(t,) for t in texts], "value string"), number, store, lambda c=clock: c)
    ingest.fold_finished(spark, store)
    for now in (datetime(2030, 2, 2, 9, 0, 30), datetime(2030, 2, 2, 9, 31), datetime(2030, 3, 1)):
        panels = monitoring.health_of_batches(store.read(spark, "lots"), timestamp(now))
        plain = monitoring.health(store.read(spark, "telemetrie"), store.read(spark, "quarantaine"), timestamp(now), store.read(spark, "rejets"))
        assert rows_of(panels.withColumn("value", F.round("value", 9)).fillna(-1.0)) == rows_of(plain.withColumn("value", F.round("value", 9)).fillna(-1.0))
        assert all("/lots" in path for path in panels.inputFiles())
