import math

from machpulse import schemas
from machpulse.operators import consolidation, datamart, telemetry as t
from machpulse.operators.writes import upsert
from tests.helpers import at, rows_of, telemetry

DAY = "2030-03-10"


def dim(spark, *ids):
    return spark.createDataFrame([(i * 10, i, "m", 1, "0-5 ans") for i in ids], schemas.DIM_MACHINE)


def fact(spark, dim_machine, *events):
    """Events as (machine, type id, day)."""
    rows = [(n, int(day.replace("-", "")), at(f"{day}T06:00:00"), m * 10, kind, n, None, "f") for n, (m, kind, day) in enumerate(events)]
    return spark.createDataFrame(rows, schemas.FACT_EVENT)


def test_dense_grid(spark):
    machines = dim(spark, 1, 2, 3)
    tele = spark.createDataFrame(
        [(1, 40.0, 50.0, 1.5), (9, 1.0, 1.0, 1.0)],
        "machine_id int, rms_vibration_moyen double, rms_vibration_max double, tendance_pression_moyenne double",
    )
    events = spark.createDataFrame([(2, 1, 0, 0)], "machine_id_nat int, nb_erreurs int, nb_pannes int, nb_maintenances int")
    out = consolidation.consolidate(machines, tele, events, DAY)
    assert out.columns == schemas.FACT_DAY.fieldNames()
    assert [tuple(r) for r in out.orderBy("id_machine").collect()] == [
        (20300310, 10, 40.0, 50.0, 1.5, 0, 0, 0),
        (20300310, 20, None, None, None, 1, 0, 0),
        (20300310, 30, None, None, None, 0, 0, 0),
    ]


def test_counts_by_type_and_day(spark):
    machines, types = dim(spark, 1, 2), datamart.event_types(spark)
    facts = fact(spark, machines, (1, 1, DAY), (1, 1, DAY), (1, 2, DAY), (2, 3, DAY), (2, 1, "2030-03-11"))
    assert rows_of(consolidation.daily_events(facts, machines, types, DAY)) == [(1, 2, 1, 0), (2, 0, 0, 1)]
    assert consolidation.daily_events(facts, machines, types, "2030-03-12").count() == 0


def test_day_of_two_windows(spark):
    raw = telemetry(spark, [(501, f"{DAY}T08:00:10", 100, 30), (501, f"{DAY}T08:30:10", 110, 50)])
    trend = t.pressure_trend(t.window_metrics(raw))
    machines = dim(spark, 501)
    events = consolidation.daily_events(fact(spark, machines, (501, 2, DAY)), machines, datamart.event_types(spark), DAY)
    (row,) = consolidation.consolidate(machines, consolidation.daily_telemetry(trend, DAY), events, DAY).collect()
    assert math.isclose(row["rms_vibration_moyen"], 40.0) and row["rms_vibration_max"] == 50.0
    assert row["tendance_pression_moyenne"] == 5.0
    assert (row["nb_erreurs"], row["nb_pannes"], row["nb_maintenances"]) == (0, 1, 0)


def test_first_window_of_the_day_looks_at_an_earlier_day(spark):
    raw = telemetry(spark, [(1, "2030-03-07T08:00:00", 100, 30), (1, f"{DAY}T08:00:00", 130, 30)])
    trend = t.pressure_trend(t.window_metrics(raw))
    assert consolidation.daily_telemetry(trend, DAY).first()["tendance_pression_moyenne"] == 30.0


def test_second_load_replaces_the_day(spark):
    keys = ["id_date", "id_machine"]
    first = spark.createDataFrame(
        [(20300310, 10, None, None, None, 0, 0, 0), (20300309, 10, 1.0, 1.0, 1.0, 1, 1, 1)], schemas.FACT_DAY
    )
    second = spark.createDataFrame([(20300310, 10, 40.0, 50.0, 5.0, 0, 1, 0)], schemas.FACT_DAY)
    once = upsert(first, second, keys)
    assert rows_of(once) == [(20300309, 10, 1.0, 1.0, 1.0, 1, 1, 1), (20300310, 10, 40.0, 50.0, 5.0, 0, 1, 0)]
    assert rows_of(upsert(once, second, keys)) == rows_of(once)
