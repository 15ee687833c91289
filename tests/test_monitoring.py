from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from machpulse import schemas
from machpulse.functions.time_columns import timestamp
from machpulse.operators import monitoring
from tests.helpers import READING, at, rows_of

def as_of():
    return timestamp("2026-01-15 12:00:00")


def stored(spark, *rows):
    """Readings as (measured, ingested)."""
    full = [(1, at(m), *READING.values(), at(i)) for m, i in rows]
    return spark.createDataFrame(full, schemas.TELEMETRY)


def rejected(spark, *times):
    rows = [(1, at(t), *READING.values(), "volt_hors_plage", at(t)) for t in times]
    return spark.createDataFrame(rows, schemas.QUARANTINE)


def panels(*args):
    return {r["metric"]: (r["value"], r["status"]) for r in monitoring.health(*args).collect()}


def test_panels(spark):
    telemetry = stored(
        spark,
        ("2026-01-15T11:58:30", "2026-01-15T11:58:50"),
        ("2026-01-15T11:30:00", "2026-01-15T11:30:50"),
        ("2026-01-15T10:00:00", "2026-01-15T10:59:59"),
        ("2026-01-13T10:00:00", "2026-01-13T10:00:00"),
    )
    quarantine = rejected(spark, "2026-01-14T12:00:00", "2026-01-14T11:59:59")
    assert panels(telemetry, quarantine, as_of()) == {
        "fraicheur_secondes": (90.0, "green"),
        "taux_erreur_pct": (25.0, "red"),
        "latence_secondes": (35.0, "red"),
    }


def test_status_turns_red_at_the_step(spark):
    telemetry = stored(spark, ("2026-01-15T11:58:00", "2026-01-15T11:58:29"))
    got = panels(telemetry, rejected(spark), as_of())
    assert got == {"fraicheur_secondes": (120.0, "red"), "taux_erreur_pct": (0.0, "green"), "latence_secondes": (29.0, "green")}


def test_empty_tables_give_no_data(spark):
    letters = spark.createDataFrame([("x", "json_invalide", at("2026-01-15T11:00:00"))], schemas.DEAD_LETTER)
    assert panels(stored(spark), rejected(spark), as_of(), letters) == {
        "fraicheur_secondes": (None, "no_data"),
        "taux_erreur_pct": (0.0, "green"),
        "latence_secondes": (None, "no_data"),
        "messages_malformes": (1.0, "info"),
    }


def trend(spark, *rows):
    """Rows of (machine, time, rms, trend)."""
    full = [(m, at(t), float(r), 100.0, float(p)) for m, t, r, p in rows]
    return spark.createDataFrame(
        full,
        "machine_id int, fenetre timestamp_ntz, rms_vibration double, pression_moyenne double, tendance_pression double",
    )


def test_latest_window_is_fleet_wide(spark):
    df = trend(
        spark,
        (1, "2026-01-15T10:00:00", 80, 1),
        (2, "2026-01-15T10:01:00", 45.0, 15.1),
        (3, "2026-01-15T10:01:00", 44.0, -3),
    )
    latest = rows_of(monitoring.latest_breaches(df), "rule", "value", "breach")
    assert latest == [("rms_vibration", 45.0, False), ("tendance_pression", 15.1, True)]
    per_machine = monitoring.latest_breaches(df, per_machine=True).filter(F.col("breach"))
    assert rows_of(per_machine, "machine_id", "rule") == [(1, "rms_vibration"), (2, "tendance_pression")]


def states(df, rule="rms_vibration", **options):
    found = monitoring.alert_states(df, **options).filter(F.col("rule") == rule).orderBy("eval_at").collect()
    return [(r["eval_at"].strftime("%H:%M"), r["state"]) for r in found]


def test_breach_is_pending_then_firing(spark):
    df = trend(
        spark,
        (1, "2026-01-15T10:00:00", 40, 0),
        (1, "2026-01-15T10:01:00", 50, 0),
        (1, "2026-01-15T10:05:00", 10, 0),
        (1, "2026-01-15T10:06:00", 46, 0),
    )
    assert states(df) == [
        ("10:00", "normal"),
        ("10:01", "pending"),
        ("10:02", "pending"),
        ("10:03", "firing"),
        ("10:04", "firing"),
        ("10:05", "normal"),
        ("10:06", "pending"),
    ]
    assert states(df, until=timestamp("2026-01-15 10:08:00"))[-2:] == [("10:07", "pending"), ("10:08", "firing")]
    assert dict(states(df, max_age="1 minute"))["10:03"] == "no_data"


def test_hold_runs_over_midnight(spark):
    df = trend(spark, (1, "2026-01-15T23:58:00", 10, 0), (1, "2026-01-15T23:59:00", 50, 0), (1, "2026-01-16T00:02:00", 50, 0))
    assert [s for _, s in states(df)] == ["normal", "pending", "pending", "firing", "firing"]


def test_nan_never_fires(spark):
    df = trend(spark, (1, "2026-01-15T10:00:00", float("nan"), 0), (1, "2026-01-15T10:03:00", float("nan"), 0))
    assert {s for _, s in states(df)} == {"normal"}


def test_nan_hides_no_other_machine(spark):
    df = trend(spark, (1, "2026-01-15T10:00:00", float("nan"), 0), (2, "2026-01-15T10:00:00", 90, 0))
    assert rows_of(monitoring.latest_breaches(df).filter("breach"), "rule", "value") == [("rms_vibration", 90.0)]
    assert states(df) == [("10:00", "pending")]


def test_every_step_evaluates_the_latest_window(spark):
    start = datetime(2026, 1, 15, 10, 0)
    df = trend(spark, *[(1, (start + timedelta(minutes=m)).isoformat(), 50 if m >= 4 else 10, 0) for m in range(21)])
    assert states(df, step="5 minutes", hold="10 minutes") == [
        ("10:00", "normal"), ("10:05", "pending"), ("10:10", "pending"), ("10:15", "firing"), ("10:20", "firing")
    ]
    late = trend(spark, *[(1, (start + timedelta(minutes=m)).isoformat(), 50, 0) for m in (3, 4, 11)])
    assert [t for t, _ in states(late, step="5 minutes")] == ["10:05", "10:10"]


def test_a_stray_date_is_one_run(spark):
    df = trend(spark, (1, "0990-01-01T00:00:00", 50, 0), (1, "2026-01-15T10:00:00", 10, 0))
    runs = monitoring.alert_runs(df).filter("rule = 'rms_vibration'").orderBy("first_eval").collect()
    assert [r["state"] for r in runs] == ["pending", "firing", "normal"]
    recent = monitoring.alert_states(df, since=timestamp("2026-01-15 09:58:30")).filter("rule = 'rms_vibration'")
    assert [s for _, s in sorted((r["eval_at"], r["state"]) for r in recent.collect())] == ["firing", "normal"]


series = st.dictionaries(st.integers(0, 60), st.sampled_from([10.0, 45.0, 46.0, 80.0]), min_size=1, max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(series)
def test_states_equal_a_step_by_step_replay(spark, values):
    start = datetime(2026, 1, 15, 23, 30)
    df = trend(spark, *[(1, (start + timedelta(minutes=m)).isoformat(), v, 0) for m, v in values.items()])
    want, since, current = [], None, None
    for minute in range(min(values), max(values) + 1):
        current = values.get(minute, current)
        since = (since if since is not None else minute) if current > 45.0 else None
        state = "normal" if since is None else "firing" if minute - since >= 2 else "pending"
        want.append(((start + timedelta(minutes=minute)).strftime("%H:%M"), state))
    assert states(df) == want
