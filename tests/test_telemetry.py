import re
import math
from datetime import datetime, timedelta

from functools import reduce

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from machpulse.functions.time_columns import month_of
from machpulse.operators import telemetry as t
from machpulse.operators.neighbours import next_row, previous_row
from tests.helpers import at, rows_of, telemetry


def test_rms_and_trend_of_two_windows(spark):
    raw = telemetry(
        spark,
        [
            (301, "2030-02-01T10:00:10", 100, 30),
            (301, "2030-02-01T10:00:40", 110, 40),
            (301, "2030-02-01T10:01:10", 130, 50),
        ],
    )
    first, second = t.pressure_trend(t.merge_windows(t.partial_windows(raw))).orderBy("fenetre").collect()
    assert first["fenetre"] == at("2030-02-01T10:00:00")
    assert math.isclose(first["rms_vibration"], math.sqrt(1250.0))
    assert (first["pression_moyenne"], first["tendance_pression"]) == (105.0, 0.0)
    assert (second["rms_vibration"], second["tendance_pression"]) == (50.0, 25.0)


def test_later_insert_refines_its_window(spark):
    early = t.partial_windows(telemetry(spark, [(302, "2030-02-02T09:00:05", 100, 20)]))
    late = t.partial_windows(telemetry(spark, [(302, "2030-02-02T09:00:40", 100, 40)]))
    assert t.merge_windows(early).first()["rms_vibration"] == 20.0
    (merged,) = t.merge_windows(early.unionByName(late)).collect()
    assert math.isclose(merged["rms_vibration"], math.sqrt(1000.0))


def test_trend_reaches_over_gaps_and_days(spark):
    raw = telemetry(
        spark,
        [
            (1, "2030-01-01T23:59:00", 100, 40),
            (1, "2030-01-05T00:00:30", 90, 40),
            (1, "2030-01-05T08:00:00", 95, 40),
            (1, "2030-03-01T08:00:00", 120, 40),
            (2, "2030-01-05T00:00:30", 50, 40),
        ],
    )
    trend = t.pressure_trend(t.window_metrics(raw), split_days=True)
    got = {(r["machine_id"], r["fenetre"].day): [] for r in trend.collect()}
    for r in trend.orderBy("fenetre").collect():
        got[(r["machine_id"], r["fenetre"].day)].append(r["tendance_pression"])
    assert got == {(1, 1): [0.0, 25.0], (1, 5): [-10.0, 5.0], (2, 5): [0.0]}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_days_keeps_groups_within_a_day(spark):
    raw = telemetry(spark, [(1, "2030-01-01T00:00:00", 1, 1)])
    plan = plan_of(t.pressure_trend(t.window_metrics(raw), split_days=True))
    groups = [line.rsplit("], [", 2)[1] for line in plan.splitlines() if "Window [" in line]
    assert len(groups) == 2
    # Both windows partition by the machine and one more expression.
    assert all(g.startswith("machine_id#") and ", _w" in g for g in groups)


def test_trend_of_state_adds_up_before_the_shuffle(spark, tmp_path):
    raw = telemetry(spark, [(1, "2026-01-15T10:00:00", 100, 20), (1, "2026-01-16T10:01:00", 101, 20)])
    t.partial_windows(raw).write.parquet(str(tmp_path / "state"))
    plan = plan_of(t.trend_of_state(spark.read.parquet(str(tmp_path / "state"))))
    scan_side = plan[plan.rindex("Exchange"):]
    assert "partial_sum" in scan_side and "Exchange hashpartitioning(machine_id" in plan
    # Every window group is a day of a machine, or the edges of its days.
    assert plan.count("Window [") == 2 and "hashpartitioning(machine_id#" in plan
    assert not re.search(r"hashpartitioning\(machine_id#\d+, \d+\)", plan)



readings = st.lists(
    st.tuples(
        st.integers(1, 3),
        st.integers(0, 4 * 24 * 60),
        st.integers(30, 200),
        st.integers(5, 90),
        st.integers(0, 3),
    ),
    min_size=1,
    max_size=40,
)


def as_rows(sample):
    start = datetime(2030, 1, 30)
    return [(m, (start + timedelta(minutes=minute)).isoformat(), p, v) for m, minute, p, v, _ in sample]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(readings)
def test_any_batch_split_merges_to_the_single_pass(spark, sample):
    raw = telemetry(spark, as_rows(sample))
    numbered = list(zip(as_rows(sample), [s[4] for s in sample]))
    parts = [
        t.partial_windows(telemetry(spark, rows))
        for rows in ([r for r, n in numbered if n == k] for k in range(4))
        if rows
    ]
    state = parts[0]
    for part in parts[1:]:
        state = state.unionByName(part)
    whole = {r[:2]: r[2:] for r in rows_of(t.window_metrics(raw))}
    merged = {r[:2]: r[2:] for r in rows_of(t.merge_windows(t.compact_state(state)))}
    assert whole.keys() == merged.keys()
    for key, values in whole.items():
        assert all(math.isclose(a, b, rel_tol=1e-12) for a, b in zip(values, merged[key]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(readings)
def test_trend_equals_plain_lag(spark, sample):
    windows = t.window_metrics(telemetry(spark, as_rows(sample)))
    previous, want = {}, {}
    for machine, window, pressure in rows_of(windows, "machine_id", "fenetre", "pression_moyenne"):
        want[machine, window] = pressure - previous.get(machine, pressure)
        previous[machine] = pressure
    for split in (False, True):
        trend = t.pressure_trend(windows, split)
        assert {r[:2]: r[2] for r in rows_of(trend, "machine_id", "fenetre", "tendance_pression")} == want


def in_batches(spark, sample):
    """Window partials of the sample's rows, by the batch each was dealt to."""
    numbered = list(zip(as_rows(sample), [s[4] for s in sample]))
    dealt = {k: [r for r, n in numbered if n == k] for k in range(4)}
    return [t.partial_windows(telemetry(spark, rows)) for rows in dealt.values() if rows]


def together(parts):
    return reduce(DataFrame.unionByName, parts)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(readings, st.integers(0, 4), st.booleans())
def test_day_trend_equals_filtered_history(spark, sample, day, indexed):
    parts = in_batches(spark, sample)
    state = together(parts).withColumn("mois", month_of("fenetre"))
    edges = together([t.edge_windows(p) for p in parts]).withColumn("mois", month_of("fenetre")) if indexed else None
    run_date = (datetime(2030, 1, 30) + timedelta(days=day)).date().isoformat()
    full = t.pressure_trend(t.merge_windows(state)).filter(F.to_date("fenetre") == F.lit(run_date).cast("date"))
    found = {r[:2]: r[2:] for r in rows_of(t.trend_of_day(state, run_date, edges))}
    want = {r[:2]: r[2:] for r in rows_of(full)}
    assert found.keys() == want.keys()
    for key, values in want.items():
        assert all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) for a, b in zip(values, found[key]))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(readings, st.randoms())
def test_touched_rows_keep_the_trend_up_to_date(spark, sample, rng):
    """Whatever the order in which batches arrive, the newest version of every row is the trend of all partials."""
    parts = in_batches(spark, sample)
    rng.shuffle(parts)
    parts = [spark.createDataFrame(p.collect(), p.schema) for p in parts]
    kept = {}
    for n in range(1, len(parts) + 1):
        state, edges = together(parts[:n]), together([t.edge_windows(p) for p in parts[:n]])
        for row in t.touched_trend(parts[n - 1], state, edges).collect():
            kept[row.machine_id, row.fenetre] = tuple(row)[2:]
        want = {r[:2]: r[2:] for r in rows_of(t.trend_of_state(state))}
        assert kept.keys() == want.keys()
        for key, values in want.items():
            assert all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) for a, b in zip(values, kept[key]))


def test_only_touched_windows_and_successors_change(spark):
    days = [f"2030-01-0{d}T10:0{m}:00" for d in (1, 3, 5) for m in (0, 1, 2)]
    old = t.partial_windows(telemetry(spark, [(1, when, 100, 20) for when in days] + [(2, days[0], 50, 20)]))

    def changed(*rows):
        new = t.partial_windows(telemetry(spark, list(rows)))
        state, edges = together([old, new]), together([t.edge_windows(old), t.edge_windows(new)])
        return [(r.machine_id, r.fenetre.isoformat(), r.tendance_pression) for r in t.touched_trend(new, state, edges).orderBy("fenetre").collect()]

    # Inside a day, at its end, on a day without windows, before and after all others.
    assert changed((1, "2030-01-03T10:01:30", 120, 20)) == [(1, "2030-01-03T10:01:00", 10.0), (1, "2030-01-03T10:02:00", -10.0)]
    assert changed((1, "2030-01-03T10:02:30", 120, 20)) == [(1, "2030-01-03T10:02:00", 10.0), (1, "2030-01-05T10:00:00", -10.0)]
    assert changed((1, "2030-01-04T09:00:00", 130, 20)) == [(1, "2030-01-04T09:00:00", 30.0), (1, "2030-01-05T10:00:00", -30.0)]
    assert changed((1, "2029-12-31T09:00:00", 90, 20)) == [(1, "2029-12-31T09:00:00", 0.0), (1, "2030-01-01T10:00:00", 10.0)]
    assert changed((1, "2030-01-09T09:00:00", 90, 20)) == [(1, "2030-01-09T09:00:00", -10.0)]


def test_edges_are_first_and_last_windows(spark):
    raw = telemetry(spark, [(1, f"2030-01-01T1{h}:00:00", 100 + h, 20) for h in range(4)] + [(1, "2030-01-02T00:00:00", 1, 1)])
    found = rows_of(t.edge_windows(t.partial_windows(raw)), "fenetre", "sum_p", "n")
    assert found == [(at("2030-01-01T10:00:00"), 100.0, 1), (at("2030-01-01T13:00:00"), 103.0, 1), (at("2030-01-02T00:00:00"), 1.0, 1)]


def test_neighbours_without_keys(spark):
    df = spark.createDataFrame(
        [(at("2030-01-01T10:00:00"), 1), (at("2030-01-01T11:00:00"), None), (at("2030-01-03T10:00:00"), 3)],
        "t timestamp_ntz, v int",
    )
    assert rows_of(previous_row(df, [], "t", {"p": "v"}).select("t", F.coalesce("p", F.lit(-1)))) == [
        (at("2030-01-01T10:00:00"), -1),
        (at("2030-01-01T11:00:00"), 1),
        (at("2030-01-03T10:00:00"), -1),
    ]
    following = next_row(df, [], "t", {"n": "t"}).orderBy("t").collect()
    assert [r["n"] for r in following] == [at("2030-01-01T11:00:00"), at("2030-01-03T10:00:00"), None]
