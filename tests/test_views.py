import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from machpulse.operators.datamart import event_types
from machpulse.operators.telemetry import merge_windows, partial_windows
from machpulse.plans import catalogue, integrity, views
from machpulse.plans.batch import Warehouse, run_batch
from machpulse.sources import streams
from machpulse.sources.messages import parse_messages
from machpulse.sources.telemetry_store import TelemetryStore
from machpulse.streaming import ingest
from machpulse.streaming.alerting import alert_check, watch
from machpulse.streaming.relay import relay
from machpulse.streaming.silence import silence_check, watch_silence
from tests.helpers import at, message, rows_of, telemetry
from tests.test_batch import FIRST, deliver, state

NOW = datetime(2026, 1, 15, 6, 10)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    kept = TelemetryStore(str(tmp_path_factory.mktemp("store")))
    texts = [
        message(machine_id=1, time="2026-01-15T06:00:10", vibration=30.0),
        message(machine_id=1, time="2026-01-15T06:09:30", pressure=130.0, vibration=50.0),
        message(machine_id=2, time="2026-01-15T06:01:00"),
        message(machine_id=3, time="2025-11-15T06:01:00"),
        message(machine_id=2, volt=999.0),
    ]
    batch = spark.createDataFrame([(t,) for t in texts], "value string")
    ingest.process_batch(batch, 0, kept, lambda: NOW)
    return kept


def test_dashboard_statements_run_as_sql(spark, store):
    views.register_telemetry(spark, store)
    latest = spark.sql(
        "SELECT max(rms_vibration) AS v FROM v_telemetrie_tendance "
        "WHERE fenetre = (SELECT max(fenetre) FROM v_telemetrie_tendance)"
    )
    assert latest.first()["v"] == 50.0
    rate = spark.sql(
        "SELECT 100.0 * q / greatest(q + v, 1) AS rate FROM (SELECT (SELECT count(*) FROM telemetrie_quarantaine) AS q, "
        "(SELECT count(*) FROM telemetrie) AS v)"
    )
    assert float(rate.first()["rate"]) == 20.0
    assert spark.table("v_telemetrie_fenetre_1min").count() == spark.table("telemetrie_fenetre_1min").count() == 4
    assert rows_of(spark.sql("SELECT max(tendance_pression) AS t FROM v_telemetrie_tendance")) == [(30.0,)]


def test_warehouse_views_and_integrity(spark, tmp_path):
    raw, warehouse = str(tmp_path / "raw"), Warehouse(str(tmp_path / "warehouse"))
    assert "fait_evenement" in views.register_warehouse(spark, warehouse)
    deliver(spark, raw, "2030-03-10", FIRST)
    run_batch(spark, "2030-03-10", raw, warehouse, state(spark))
    views.register_warehouse(spark, warehouse)
    counted = spark.sql(
        "SELECT m.machine_id_nat, count(*) AS n FROM fait_evenement f JOIN dim_machine m ON m.id_machine = f.id_machine "
        "JOIN dim_date d ON d.id_date = f.id_date GROUP BY 1"
    )
    assert rows_of(counted) == [(201, 2), (202, 1)]
    assert spark.table("v_interventions").count() == 2
    assert event_types(spark).count() == 3
    report = integrity.integrity_report(spark, warehouse)
    assert {r["table"] for r in report.collect()} == {
        "dim_date", "dim_machine", "dim_code_evenement", "fait_evenement", "fait_telemetrie_jour",
    }
    assert report.filter("violations > 0").count() == 0
    # A day without any event has no row in the event calendar.
    deliver(spark, raw, "2030-03-12", FIRST)
    run_batch(spark, "2030-03-12", raw, warehouse, state(spark))
    broken = integrity.integrity_report(spark, warehouse).filter("violations > 0")
    assert rows_of(broken) == [("fait_telemetrie_jour", "foreign:id_date", 2)]


def test_silence_check(spark, store):
    known = spark.createDataFrame([(1,), (2,), (3,), (4,)], "machine_id int")
    found = silence_check(known, store.last_seen(spark), NOW).orderBy("machine_id").collect()
    assert [tuple(r) for r in found] == [
        (2, at("2026-01-15T06:01:00"), NOW),
        (3, at("2025-11-15T06:01:00"), NOW),
        (4, None, NOW),
    ]
    plain = silence_check(known, store.read(spark, "telemetrie"), NOW)
    assert rows_of(plain, "machine_id") == [(2,), (3,), (4,)]


def test_silence_watch_writes_each_check(spark, store, tmp_path):
    known = spark.createDataFrame([(1,), (2,)], "machine_id int")
    out = str(tmp_path / "silences")
    query = watch_silence(
        spark, lambda: known, lambda: store.last_seen(spark), out, str(tmp_path / "cp"), "1 second", clock=lambda: NOW
    )
    deadline = time.time() + 60
    while time.time() < deadline and not (tmp_path / "silences" / "controle=0" / "_SUCCESS").exists():
        time.sleep(0.5)
    query.stop()
    assert rows_of(spark.read.parquet(f"{out}/controle=0"), "machine_id") == [(2,)]
    assert merge_windows(store.read_state(spark)).count() == 4


def test_operators_are_a_view(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path / "warehouse"))
    views.register_warehouse(spark, warehouse)
    assert spark.table("dim_operateur").columns == ["matricule_pseudonymise", "nom_pseudonymise", "equipe"]
    people = spark.createDataFrame([("a", "b", "c")], "matricule_pseudonymise string, nom_pseudonymise string, equipe string")
    views.register_warehouse(spark, warehouse, people)
    assert rows_of(spark.table("dim_operateur")) == [("a", "b", "c")]


def test_relay_keys_fitting_messages(spark, tmp_path):
    rows = [
        ("usine/capteurs/7/mesure", message(machine_id=7)),
        ("usine/capteurs/7/x/mesure", message(machine_id=8)),
        ("usine/capteurs/9/mesure", "{broken"),
        ("usine/capteurs/3/mesure", message(machine_id=3)),
    ]
    spark.createDataFrame(rows, "topic string, value string").write.parquet(str(tmp_path / "raw"))
    source = streams.file_stream(spark, str(tmp_path / "raw"), spark.read.parquet(str(tmp_path / "raw")).schema)
    out = {"path": str(tmp_path / "keyed")}
    relay(source, out, str(tmp_path / "checkpoint"), sink="parquet", available_now=True).awaitTermination()
    keyed = spark.read.parquet(out["path"])
    assert sorted(r["key"] for r in keyed.collect()) == ["3", "7"]
    assert rows_of(parse_messages(keyed), "machine_id", "malformed_reason") == [(3, None), (7, None)]
    letters = spark.read.parquet(str(tmp_path / "checkpoint_rejets"))
    assert rows_of(letters, "topic", "value", "malformed_reason") == [("usine/capteurs/9/mesure", "{broken", "json_invalide")]


def test_alerts_as_they_stand(spark):
    times = [f"2026-01-15T06:0{m}:00" for m in range(4)]
    raw = telemetry(spark, [(1, t, 100, 20 if t < times[1] else 60) for t in times])
    partials = partial_windows(raw).withColumn("mois", F.lit(202601))
    found = {m: {r["rule"]: r["state"] for r in alert_check(partials, datetime(2026, 1, 15, 6, m, 30)).collect()} for m in (0, 1, 2, 3)}
    assert [found[m]["rms_vibration"] for m in range(4)] == ["normal", "pending", "pending", "firing"]
    # Nothing came after: the alert stands, however old, unless a greatest age is given.
    old = {r["rule"]: r["state"] for r in alert_check(partials, datetime(2027, 1, 20)).collect()}
    assert old == {"rms_vibration": "firing", "tendance_pression": "normal"}
    aged = {r["rule"]: r["state"] for r in alert_check(partials, datetime(2026, 1, 20), max_age="1 hour").collect()}
    assert set(aged.values()) == {"no_data"}
    assert alert_check(partials, datetime(2026, 1, 14)).count() == 0


def test_a_long_breach_fires_by_its_whole_length(spark):
    raw = telemetry(spark, [(1, f"2026-01-{d:02d}T06:00:00", 100, 60) for d in (15, 16, 17, 18)])
    found = {r["rule"]: r["state"] for r in alert_check(partial_windows(raw), datetime(2026, 1, 18, 7), hold="36 hours").collect()}
    assert found["rms_vibration"] == "firing"


def test_watch_writes_a_folder_per_check(spark, tmp_path):
    query = watch(spark, lambda now: spark.createDataFrame([(now,)], "at timestamp_ntz"), str(tmp_path / "out"),
                  str(tmp_path / "checkpoint"), "1 second", lambda: NOW)
    try:
        for _ in range(60):
            time.sleep(0.5)
            if list((tmp_path / "out").glob("controle=*/_SUCCESS")):
                break
    finally:
        query.stop()
    assert rows_of(spark.read.parquet(str(tmp_path / "out")), "at")[0] == (NOW,)


def test_filters_of_machine_and_period_reach_the_scan(spark):
    for query, wanted in ((catalogue.machine_history, "EqualTo(user_id"), (catalogue.fleet_period, "GreaterThanOrEqual(ts")):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert wanted in plan[plan.index("PushedFilters"):]


def test_raw_table_is_sorted_by_machine_and_time(spark, tmp_path):
    kept = TelemetryStore(str(tmp_path / "store"))
    texts = [message(machine_id=m, time=f"2026-01-{d:02d}T06:00:00") for d in (9, 3, 21) for m in (5, 2, 9)]
    ingest.process_batch(spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1), 0, kept, lambda: NOW)
    rows = [(r["machine_id"], r["datetime_mes"]) for r in kept.read(spark, "telemetrie").coalesce(1).collect()]
    assert len(rows) == 9 and rows == sorted(rows)
