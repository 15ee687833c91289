from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from machpulse import schemas
from machpulse.operators import datamart, writes
from machpulse.operators.constraints import ConstraintViolation, Rules, check_constraints, enforce, orphans
from machpulse.operators.history import event_history
from tests.helpers import at, rows_of


def machines(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.STAGING["machines"])


def events(spark, table, *rows):
    return spark.createDataFrame([(at(t), m, c) for t, m, c in rows], schemas.STAGING[table])


def three_sources(spark):
    return {
        "erreurs": events(spark, "erreurs", ("2030-03-10T06:00:00", 201, "error3")),
        "pannes": events(spark, "pannes", ("2030-03-10T07:00:00", 202, "comp1")),
        "maintenances": events(spark, "maintenances", ("2030-03-11T08:00:00", 201, "comp2")),
    }


def build(spark, sources, existing=None):
    types = datamart.event_types(spark)
    dim = datamart.build_dim_machine(machines(spark, (201, "model4", 12), (202, "model2", 3)))
    fused = datamart.fuse_events(**sources)
    codes = datamart.build_dim_code(fused, types)
    return types, dim, codes, datamart.build_event_fact(fused, dim, types, codes, existing)


def test_three_sources_become_one_fact(spark):
    types, dim, codes, fact = build(spark, three_sources(spark))
    assert fact.columns == schemas.FACT_EVENT.fieldNames()
    star = datamart.star_rows(fact, dim, types, codes)
    assert rows_of(star, "machine_id_nat", "code_type", "code_brut", "id_date", "source_fichier") == [
        (201, "ERREUR", "error3", 20300310, "PdM_errors.csv"),
        (201, "MAINTENANCE", "comp2", 20300311, "PdM_maint.csv"),
        (202, "PANNE", "comp1", 20300310, "PdM_failures.csv"),
    ]
    assert fact.filter(F.col("id_operateur").isNotNull()).count() == 0
    assert [r["code_type"] for r in datamart.star_rows(datamart.interventions(fact, types), dim, types, codes).orderBy("code_type").collect()] == [
        "MAINTENANCE",
        "PANNE",
    ]
    assert event_history(fact, dim, 201).count() == 2


def test_rerun_adds_nothing(spark):
    fact = build(spark, three_sources(spark))[3].cache()
    assert fact.count() == 3
    assert build(spark, three_sources(spark), fact)[3].count() == 0


def test_copies_and_unknown_machines(spark):
    sources = three_sources(spark)
    sources["erreurs"] = events(
        spark, "erreurs", *[("2030-03-10T06:00:00", 201, "error3")] * 5, ("2030-03-10T06:00:00", 999, "error3")
    )
    assert build(spark, sources)[3].count() == 3


def test_same_code_under_two_types_stays_apart(spark):
    sources = three_sources(spark)
    sources["maintenances"] = events(spark, "maintenances", ("2030-03-10T07:00:00", 202, "comp1"))
    types, dim, codes, fact = build(spark, sources)
    assert rows_of(codes, "id_type_evenement", "code_brut", "libelle") == [
        (1, "error3", "error3"),
        (2, "comp1", "comp1"),
        (3, "comp1", "comp1"),
    ]
    assert fact.count() == 3


@pytest.mark.parametrize(
    ("age", "band"),
    [(0, "0-5 ans"), (5, "0-5 ans"), (6, "6-10 ans"), (10, "6-10 ans"), (15, "11-15 ans"), (16, "16-20 ans"), (35, "16-20 ans")],
)
def test_age_bands(spark, age, band):
    assert datamart.build_dim_machine(machines(spark, (1, "m", age))).first()["tranche_age"] == band


def test_machine_upsert_keeps_surrogates(spark):
    first = datamart.build_dim_machine(machines(spark, (1, "a", 3), (2, "b", 4))).cache()
    second = datamart.build_dim_machine(machines(spark, (2, "b2", 12), (3, "c", 20)), first)
    old = dict(rows_of(first, "machine_id_nat", "id_machine"))
    new = {r["machine_id_nat"]: r for r in second.collect()}
    assert set(new) == {1, 2, 3}
    assert (new[1]["id_machine"], new[2]["id_machine"]) == (old[1], old[2])
    assert new[3]["id_machine"] > max(old.values())
    assert (new[1]["model"], new[2]["model"], new[2]["tranche_age"]) == ("a", "b2", "11-15 ans")
    again = datamart.build_dim_machine(machines(spark, (2, "b2", 12), (3, "c", 20)), second)
    assert rows_of(again) == rows_of(second)


def test_latest_snapshot(spark):
    snapshots = spark.createDataFrame(
        [(1, "a", 3, "2030-01-01"), (1, "a", 4, "2030-02-01")], "machine_id int, model string, age int, run_date string"
    )
    assert datamart.build_dim_machine(snapshots, latest_snapshot=True).first()["age"] == 4


def test_dates(spark):
    sources = three_sources(spark)
    rows = datamart.build_dim_date(*sources.values()).orderBy("id_date").collect()
    assert [tuple(r) for r in rows] == [
        (20300310, date(2030, 3, 10), 2030, 1, 3, 10, "dimanche", True),
        (20300311, date(2030, 3, 11), 2030, 1, 3, 11, "lundi", False),
    ]
    far = events(spark, "erreurs", ("2030-03-13T00:00:00", 1, "error1"), ("2030-03-09T10:00:00", 1, "error1"))
    week = datamart.build_dim_date(far, calendar=True)
    assert rows_of(week, "id_date", "jour_semaine", "est_weekend") == [
        (20300309, "samedi", True),
        (20300310, "dimanche", True),
        (20300311, "lundi", False),
        (20300312, "mardi", False),
        (20300313, "mercredi", False),
    ]
    assert datamart.build_dim_date(far.filter(F.lit(False)), calendar=True).count() == 0
    grown = datamart.build_dim_date(far, existing=datamart.build_dim_date(*sources.values()))
    assert [r[0] for r in rows_of(grown, "id_date")] == [20300309, 20300310, 20300311, 20300313]


def test_numbers_are_unique_whatever_the_size(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), F.lit(None).cast("int").alias("n"))
    first = writes.number_new_keys(df, ["k"], "n").cache()
    assert first.agg(F.countDistinct("n"), F.min("n")).first()[0] == 5000
    more = first.unionByName(spark.range(5000, 7000).select(F.col("id").alias("k"), F.lit(None).cast("int").alias("n")))
    grown = writes.number_new_keys(more, ["k"], "n", first)
    assert grown.select("n").distinct().count() == 7000
    assert grown.join(first, ["k", "n"]).count() == 5000


def test_first_per_key_takes_the_smallest(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (1, "c", 9), (2, "z", 1)], "k int, s string, o int")
    assert rows_of(writes.first_per_key(df, ["k"], ["o"])) == [(1, "a", 2), (2, "z", 1)]


pairs = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3)), max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs, pairs)
def test_upserts_are_idempotent(spark, held, offered):
    def frame(items):
        return spark.createDataFrame(sorted(dict(items).items()), "k int, v int")

    for mode in ("nothing", "update"):
        once = writes.upsert(frame(held), frame(offered), ["k"], mode)
        want = {**dict(offered), **dict(held)} if mode == "nothing" else {**dict(held), **dict(offered)}
        assert dict(rows_of(once)) == want
        assert rows_of(writes.upsert(once, frame(offered), ["k"], mode)) == sorted(want.items())


def test_update_writes_nulls_and_keeps_uncarried_columns(spark):
    held = spark.createDataFrame([(1, 10, "x")], "k int, v int, kept string")
    offered = spark.createDataFrame([(1, None)], "k int, v int")
    assert [tuple(r) for r in writes.upsert(held, offered, ["k"]).collect()] == [(1, None, "x")]
    with pytest.raises(ValueError):
        writes.upsert(held, offered, ["k"], "replace")


def test_constraints(spark):
    parent = spark.createDataFrame([(1,), (2,)], "machine_id int")
    child = spark.createDataFrame(
        [(1, "aa", 5), (1, "aa", 5), (9, "toolong", 50), (9, None, None), (None, "a", 1)],
        "machine_id int, code string, age int",
    )
    rules = Rules(
        not_null=("code",),
        checks={"age": F.col("age").between(0, 40)},
        lengths={"code": 3},
        unique=(("machine_id", "code"),),
        foreign=(("machine_id", parent, "machine_id"),),
    )
    assert dict(rows_of(check_constraints(child, rules))) == {
        "not_null:code": 1,
        "check:age": 1,
        "length:code": 1,
        "unique:machine_id,code": 1,
        "foreign:machine_id": 2,
    }
    assert rows_of(orphans(child.filter("machine_id is not null"), "machine_id", parent, "machine_id"), "machine_id") == [(9,), (9,)]
    with pytest.raises(ConstraintViolation, match="check:age=1"):
        enforce(child, rules)
    assert enforce(child, rules, "report").count() == 5
    assert enforce(parent, Rules(not_null=("machine_id",))).count() == 1
