from datetime import datetime

import pytest
from pyspark.sql import functions as F

from machpulse import schemas
from machpulse.functions.time_columns import month_of
from machpulse.operators import telemetry as t
from machpulse.operators.constraints import ConstraintViolation
from machpulse.plans import batch, catalogue
from machpulse.plans import bindings as b
from machpulse.plans.batch import Warehouse, run_batch
from machpulse.sources import landing, storage
from tests.helpers import rows_of, telemetry

MAPPINGS = {name: mapping for name, (_, mapping) in landing.STAGING_FILES.items()}

FIRST = {
    "PdM_machines.csv": [("201", "model4", "12"), ("202", "model2", "3")],
    "PdM_errors.csv": [("2030-03-10 06:00:00", "201", "error3"), ("2030-03-10 06:00:00", "201", "error3")],
    "PdM_failures.csv": [("2030-03-10 07:00:00", "202", "comp1")],
    "PdM_maint.csv": [("2030-03-09 08:00:00", "201", "comp2")],
}


def deliver(spark, root, run_date, rows):
    frames = {}
    for name, mapping in MAPPINGS.items():
        schema = ", ".join(f"{source} string" for source, _ in mapping)
        frames[name] = spark.createDataFrame(rows[name], schema)
    return landing.land(frames, root, run_date)


def state(spark):
    raw = telemetry(
        spark,
        [
            (201, "2030-03-09T08:00:10", 100, 20),
            (201, "2030-03-10T08:00:10", 100, 30),
            (201, "2030-03-10T08:30:10", 110, 50),
            (999, "2030-03-10T08:30:10", 110, 50),
        ],
    )
    return t.partial_windows(raw).withColumn("mois", month_of("fenetre"))


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "raw"), Warehouse(str(tmp_path / "warehouse"))


def test_read_renames_orders_and_drops(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text("extra,age,model,machineID\nx,18,model3,1\ny,5,model1,2\n")
    df = landing.read_raw_csv(spark, str(path), MAPPINGS["PdM_machines.csv"])
    assert df.columns == ["machine_id", "model", "age"]
    assert rows_of(df) == [("1", "model3", "18"), ("2", "model1", "5")]
    assert landing.typed(df, "machines").schema == schemas.STAGING["machines"]
    path.write_text("machineID,model\n1,model3\n")
    with pytest.raises(ValueError, match="missing columns age"):
        landing.read_raw_csv(spark, str(path), MAPPINGS["PdM_machines.csv"])


def test_empty_and_unknown_files(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text("machineID,model,age\n")
    assert landing.read_raw_csv(spark, str(path), MAPPINGS["PdM_machines.csv"]).count() == 0
    path.write_text("")
    assert landing.read_raw_csv(spark, str(path), MAPPINGS["PdM_machines.csv"]).count() == 0
    with pytest.raises(ValueError, match="PdM_telemetry.csv"):
        landing.staging_target("PdM_telemetry.csv")


def test_landing_overwrites_its_date_only(spark, places):
    raw, _ = places
    deliver(spark, raw, "2030-03-10", FIRST)
    deliver(spark, raw, "2030-03-11", FIRST)
    assert len(deliver(spark, raw, "2030-03-10", FIRST)) == 4
    assert landing.read_landed(spark, raw, "2030-03-10", "PdM_errors.csv").count() == 2
    assert storage.names(spark, raw) == ["2030-03-10", "2030-03-11"]


def test_missing_inputs(spark, places):
    raw, warehouse = places
    with pytest.raises(landing.MissingInput):
        landing.land({}, raw, "2030-03-10")
    with pytest.raises(landing.MissingInput, match="PdM_machines.csv"):
        run_batch(spark, "2030-03-10", raw, warehouse, state(spark))
    assert warehouse.published(spark) == []


def tables(spark, warehouse):
    return {
        "fact": rows_of(warehouse.events(spark), "id_date", "id_machine", "id_type_evenement", "id_code", "source_fichier"),
        "machines": rows_of(warehouse.dimension(spark, "dim_machine")),
        "dates": rows_of(warehouse.dimension(spark, "dim_date"), "id_date"),
        "codes": rows_of(warehouse.dimension(spark, "dim_code_evenement")),
        "days": [str(r) for r in rows_of(warehouse.days(spark).fillna(-1.0))],
    }


def test_run_rerun_and_next_day(spark, places):
    raw, warehouse = places
    deliver(spark, raw, "2030-03-10", FIRST)
    counts = run_batch(spark, "2030-03-10", raw, warehouse, state(spark))
    assert counts["machines"] == {"attempted": 2, "inserted": 2}
    assert counts["erreurs"] == {"attempted": 2, "inserted": 1}
    assert counts["fait_evenement"] == {"inserted": 3}
    named = warehouse.days(spark).join(warehouse.dimension(spark, "dim_machine"), "id_machine")
    columns = ("machine_id_nat", "rms_vibration_moyen", "rms_vibration_max", "tendance_pression_moyenne")
    assert [tuple(r) for r in named.orderBy("machine_id_nat").select(*columns, "nb_erreurs", "nb_pannes", "nb_maintenances").collect()] == [
        (201, 40.0, 50.0, 5.0, 1, 0, 0),
        (202, None, None, None, 0, 1, 0),
    ]
    before = tables(spark, warehouse)

    again = run_batch(spark, "2030-03-10", raw, warehouse, state(spark))
    assert [c["inserted"] for k, c in again.items() if k != "fait_telemetrie_jour"] == [0] * 5
    assert tables(spark, warehouse) == before

    following = {
        "PdM_machines.csv": [("201", "model4", "13"), ("203", "model1", "7")],
        "PdM_errors.csv": [*FIRST["PdM_errors.csv"], ("2030-03-11 06:00:00", "203", "error1")],
        "PdM_failures.csv": [],
        "PdM_maint.csv": FIRST["PdM_maint.csv"],
    }
    deliver(spark, raw, "2030-03-11", following)
    counts = run_batch(spark, "2030-03-11", raw, warehouse, state(spark))
    assert counts["erreurs"] == {"attempted": 3, "inserted": 1}
    assert counts["fait_evenement"] == {"inserted": 1}
    machines = {r["machine_id_nat"]: r for r in warehouse.dimension(spark, "dim_machine").collect()}
    # First write wins in staging: the changed age of 201 never arrives.
    assert {m: r["age"] for m, r in machines.items()} == {201: 12, 202: 3, 203: 7}
    assert warehouse.events(spark).count() == 4
    assert rows_of(warehouse.days(spark).groupBy("id_date").count()) == [(20300310, 2), (20300311, 3)]


def test_violation_publishes_nothing(spark, places):
    raw, warehouse = places
    broken = {**FIRST, "PdM_errors.csv": [("2030-03-10 06:00:00", "777", "error3")]}
    deliver(spark, raw, "2030-03-10", broken)
    with pytest.raises(ConstraintViolation, match="foreign:machine_id=1"):
        run_batch(spark, "2030-03-10", raw, warehouse, state(spark))
    assert warehouse.published(spark) == [] and warehouse.events(spark).count() == 0
    # In report mode the orphan reaches staging and the inner join keeps it out of the fact.
    run_batch(spark, "2030-03-10", raw, warehouse, state(spark), on_violation="report")
    assert warehouse.events(spark).filter(F.col("source_fichier") == "PdM_errors.csv").count() == 0
    assert warehouse.events(spark).count() == 2


def test_text_that_does_not_fit_stops_the_load(spark, places):
    raw, warehouse = places
    deliver(spark, raw, "2030-03-10", {**FIRST, "PdM_machines.csv": [("deux", "model4", "12")]})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_batch(spark, "2030-03-10", raw, warehouse, state(spark))
    assert warehouse.published(spark) == []


def test_unpublished_run_is_invisible(spark, places):
    raw, warehouse = places
    deliver(spark, raw, "2030-03-10", FIRST)
    run_batch(spark, "2030-03-10", raw, warehouse, state(spark))
    storage.remove(spark, f"{warehouse.root}/_published/1")
    assert warehouse.events(spark).count() == 0 and warehouse.dimension(spark, "dim_machine") is None
    assert run_batch(spark, "2030-03-10", raw, warehouse, state(spark))["fait_evenement"] == {"inserted": 3}


class Dying(Warehouse):
    def publish(self, spark, run_id):
        raise RuntimeError("killed before it was published")


def test_day_table_waits_for_its_run(spark, places):
    raw, warehouse = places
    deliver(spark, raw, "2030-03-10", FIRST)
    with pytest.raises(RuntimeError):
        run_batch(spark, "2030-03-10", raw, Dying(warehouse.root), state(spark))
    assert warehouse.days(spark).count() == 0
    run_batch(spark, "2030-03-10", raw, warehouse, state(spark))
    before = rows_of(warehouse.days(spark))
    with pytest.raises(RuntimeError):
        run_batch(spark, "2030-03-10", raw, Dying(warehouse.root), state(spark).limit(0))
    assert rows_of(warehouse.days(spark)) == before and len(before) == 2
    run_batch(spark, "2030-03-10", raw, warehouse, state(spark).limit(0))
    assert {r["rms_vibration_max"] for r in warehouse.days(spark).collect()} == {None}


def test_lost_folder_of_a_published_run_is_an_error(spark, places):
    raw, warehouse = places
    deliver(spark, raw, "2030-03-10", FIRST)
    run_batch(spark, "2030-03-10", raw, warehouse, state(spark))
    storage.remove(spark, warehouse.path("fait_evenement", 1))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        warehouse.events(spark).count()


def test_lost_day_of_a_published_run_is_an_error(spark, places):
    raw, warehouse = places
    deliver(spark, raw, "2030-03-10", FIRST)
    deliver(spark, raw, "2030-03-11", FIRST)
    run_batch(spark, "2030-03-10", raw, warehouse, state(spark))
    run_batch(spark, "2030-03-11", raw, warehouse, state(spark))
    index = warehouse.index(spark)
    assert index["days"] == {"20300310": {"run": 1, "rows": 2}, "20300311": {"run": 2, "rows": 2}} and index["machines"] == 2
    storage.remove(spark, warehouse.path("fait_telemetrie_jour", 1))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        warehouse.days(spark).count()
    # The other day is read without a look at the lost one; a day that no run wrote has no rows.
    assert warehouse.days(spark, 20300311).count() == 2
    assert warehouse.days(spark, 20300312).count() == 0


def test_day_from_the_index_of_edges(spark, places):
    raw, warehouse = places
    deliver(spark, raw, "2030-03-10", FIRST)
    edges = t.edge_windows(state(spark).drop("mois")).withColumn("mois", month_of("fenetre"))
    run_batch(spark, "2030-03-10", raw, warehouse, state(spark), edges=edges)
    before = rows_of(warehouse.days(spark).fillna(-1.0))
    run_batch(spark, "2030-03-10", raw, warehouse, state(spark))
    assert rows_of(warehouse.days(spark).fillna(-1.0)) == before


def test_dimensions_hold_what_changed(spark, places, monkeypatch):
    raw, warehouse = places
    monkeypatch.setattr(batch, "FOLD_AFTER", 3)
    machines = FIRST["PdM_machines.csv"]
    surrogates = {}
    for run in range(1, 6):
        if run != 2:
            machines = [*machines, (str(300 + run), "model1", str(run))]
        deliver(spark, raw, f"2030-03-1{run}", {**FIRST, "PdM_machines.csv": machines})
        run_batch(spark, f"2030-03-1{run}", raw, warehouse, state(spark))
        rows = {r["machine_id_nat"]: r for r in warehouse.dimension(spark, "dim_machine").collect()}
        assert sorted(rows) == sorted(int(m) for m, _, _ in machines)
        assert len({r["id_machine"] for r in rows.values()}) == len(rows)
        assert all(rows[m]["id_machine"] == n for m, n in surrogates.items())
        surrogates = {m: r["id_machine"] for m, r in rows.items()}
        assert warehouse.index(spark)["machines"] == len(machines) and warehouse.machines(spark).count() == len(machines)
    # The second run changed nothing and wrote nothing; the fifth wrote the whole after three changes.
    written = {run: spark.read.parquet(warehouse.path("dim_machine", run)).count() for run in (1, 3, 4, 5)}
    assert written == {1: 3, 3: 1, 4: 1, 5: 6}
    assert not storage.exists(spark, warehouse.path("dim_machine", 2)) and not storage.exists(spark, warehouse.path("dim_date", 2))
    assert warehouse.index(spark)["runs"]["dim_machine"] == [5] and warehouse.index(spark)["runs"]["dim_date"] == [1]


def test_machines_load_up_to_the_ids_of_messages(spark, places):
    raw, warehouse = places
    wide = [("65536", "model1", "4"), ("2147483647", "model3", "7")]
    deliver(spark, raw, "2030-03-10", {**FIRST, "PdM_machines.csv": [*FIRST["PdM_machines.csv"], *wide]})
    assert run_batch(spark, "2030-03-10", raw, warehouse, state(spark))["machines"] == {"attempted": 4, "inserted": 4}
    deliver(spark, raw, "2030-03-11", {**FIRST, "PdM_machines.csv": [("-1", "model1", "4")]})
    with pytest.raises(ConstraintViolation, match="check:machine_id=1"):
        run_batch(spark, "2030-03-11", raw, warehouse, state(spark))
    assert warehouse.published(spark) == [1]


@pytest.fixture
def wide_tables(spark, tmp_path):
    """Tables whose ids pass 16 bits."""
    customers = [(i, f"c{i}", 1, 10.0, "BUILDING") for i in (7, 65535, 65536, 900_000)]
    spark.createDataFrame(customers, b.INPUTS["customer"]).write.parquet(f"{tmp_path}/customer.parquet")
    events = [
        (1, datetime(2024, 1, 10, 6, 0, 5), 65536, "error", 20.0, "{}"),
        (2, datetime(2024, 1, 10, 7, 0, 5), 900_000, "purchase", 30.0, "{}"),
        (3, datetime(2024, 1, 9, 7, 0, 5), 900_000, "signup", 40.0, "{}"),
    ]
    spark.createDataFrame(events, b.INPUTS["events"]).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_daily_run_takes_ids_above_16_bits(spark, wide_tables):
    day = catalogue.all_queries()["daily_run"](spark, wide_tables)
    counts = rows_of(day, "machine_id_nat", "nb_erreurs", "nb_pannes", "nb_maintenances")
    assert counts == [(7, 0, 0, 0), (65535, 0, 0, 0), (65536, 1, 0, 0), (900_000, 0, 1, 0)]


def test_daily_run_events_takes_ids_above_16_bits(spark, wide_tables):
    fact = catalogue.all_queries()["daily_run_events"](spark, wide_tables)
    assert rows_of(fact) == [("ERREUR", 20240110, 1), ("MAINTENANCE", 20240109, 1), ("PANNE", 20240110, 1)]


def test_interrupted_run_takes_ids_above_16_bits(spark, wide_tables):
    day = catalogue.all_queries()["daily_run_interrupted"](spark, wide_tables)
    counts = rows_of(day, "machine_id_nat", "nb_erreurs", "nb_pannes", "nb_maintenances")
    assert counts == [(7, 0, 0, 0), (65535, 0, 0, 0), (65536, 1, 0, 0), (900_000, 0, 1, 0)]
