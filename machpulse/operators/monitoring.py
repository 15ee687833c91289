"""Health panels and early-warning alerts."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from machpulse.functions.fixed_values import ALERT_HOLD, ALERT_RULES, ALERT_STEP, RED_FROM
from machpulse.functions.time_columns import interval, seconds_between, timestamp
from machpulse.operators.neighbours import next_row

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def recent(df: DataFrame, time_column: str, as_of: Column, period: str) -> DataFrame:
    """Rows whose time lies within ``period`` before ``as_of``, or later."""
    return df.filter(F.col(time_column) >= as_of - interval(period))


def health(
    telemetry: DataFrame, quarantine: DataFrame, as_of: Column, dead_letter: DataFrame | None = None
) -> DataFrame:
    """Freshness, error rate over a day, mean latency over an hour, each with its colour.

    One pass over the union of the inputs, two columns each, folded map-side into one row; no join.
    ``dead_letter`` adds a count of malformed messages, which the error rate leaves out.
    """
    day_ago, hour_ago = as_of - interval("1 day"), as_of - interval("1 hour")
    shape = "kind", "mesure", "arrivee"
    parts = telemetry.select(F.lit("valide"), "datetime_mes", "horodatage_ingestion").toDF(*shape)
    none = F.lit(None).cast("timestamp_ntz")
    parts = parts.unionByName(quarantine.select(F.lit("quarantaine"), none, F.col("horodatage_quarantaine")).toDF(*shape))
    if dead_letter is not None:
        parts = parts.unionByName(dead_letter.select(F.lit("malforme"), none, F.col("horodatage_rejet")).toDF(*shape))

    kind, arrived = F.col("kind"), F.col("arrivee")
    latency = F.when((kind == "valide") & (arrived >= hour_ago), seconds_between("mesure", "arrivee"))
    totals = parts.agg(
        F.max("mesure").alias("derniere"),
        F.count_if((kind == "quarantaine") & (arrived >= day_ago)).alias("q"),
        F.count_if((kind == "valide") & (arrived >= day_ago)).alias("v"),
        F.count_if((kind == "malforme") & (arrived >= day_ago)).alias("m"),
        F.avg(latency).alias("latence"),
    )
    return _panels(totals, as_of, dead_letter is not None)


def health_of_batches(batches: DataFrame, as_of: Column) -> DataFrame:
    """The panels of ``health`` from one row per micro-batch: its counts, ingest time, newest reading and summed latency.

    A batch has one ingest time, so its row lies wholly inside or outside each period; no reading or message is read.
    """
    arrived = F.col("horodatage")
    day, hour = arrived >= as_of - interval("1 day"), arrived >= as_of - interval("1 hour")

    def within(period: Column, column: str) -> Column:
        return F.coalesce(F.sum(F.when(period, F.col(column))), F.lit(0))

    totals = batches.agg(
        F.max("derniere").alias("derniere"), within(day, "quarantaine").alias("q"), within(day, "valides").alias("v"),
        within(day, "malformes").alias("m"),
        F.try_divide(within(hour, "latence_somme").cast("double"), within(hour, "valides")).alias("latence"),
    )
    return _panels(totals, as_of, True)


def _panels(totals: DataFrame, as_of: Column, malformed: bool) -> DataFrame:
    """One row per panel from the row ``derniere, q, v, m, latence``."""
    values = {
        "fraicheur_secondes": seconds_between(F.col("derniere"), as_of).cast("double"),
        "taux_erreur_pct": 100.0 * F.col("q") / F.greatest(F.col("q") + F.col("v"), F.lit(1)),
        "latence_secondes": F.col("latence"),
    }
    rows = [
        F.struct(
            F.lit(name).alias("metric"),
            value.alias("value"),
            F.when(value.isNull(), "no_data").when(value >= RED_FROM[name], "red").otherwise("green").alias("status"),
        )
        for name, value in values.items()
    ]
    if malformed:
        rows.append(
            F.struct(
                F.lit("messages_malformes").alias("metric"),
                F.col("m").cast("double").alias("value"),
                F.lit("info").alias("status"),
            )
        )
    return totals.select(F.inline(F.array(*rows)))


def _exceeds(value: Column, threshold: Column) -> Column:
    """Strictly above; NaN and NULL never exceed."""
    return F.coalesce(~F.isnan(value) & (value > threshold), F.lit(False))


def fleet_maxima(trend: DataFrame, rules=ALERT_RULES) -> DataFrame:
    """Highest value of each ruled column over all machines, per window. NaN is left out; NULL if there is no other."""
    # NaN is above every number for max; a broken sensor must not hide the others.
    return trend.groupBy("fenetre").agg(*[F.max(F.when(~F.isnan(c), F.col(c))).alias(c) for c in rules])


def _by_rule(df: DataFrame, rules, keep: list[str]) -> DataFrame:
    """One row per rule: rule, value, threshold."""
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("rule"), F.col(c).alias("value"), F.lit(float(t)).alias("threshold"))
            for c, t in rules.items()
        ]
    )
    return df.select(*keep, F.inline(rows))


def latest_breaches(trend: DataFrame, rules=ALERT_RULES, per_machine: bool = False) -> DataFrame:
    """Each rule at the latest window: fleet-wide window and maximum, or each machine's own last window.

    Found with one aggregation per level, without reading the trend a second time for the latest time.
    """
    keys = ["machine_id"] if per_machine else []
    per_window = trend if per_machine else fleet_maxima(trend, rules)
    latest = per_window.groupBy(*keys).agg(
        F.max("fenetre").alias("fenetre"), *[F.max_by(c, "fenetre").alias(c) for c in rules]
    )
    flat = _by_rule(latest, rules, [*keys, "fenetre"])
    return flat.withColumn("breach", _exceeds(F.col("value"), F.col("threshold")))


_EPOCH = "1970-01-01 00:00:00"


def _seconds(text: str) -> int:
    amount, unit = text.split()
    return int(amount) * _UNIT_SECONDS[unit.rstrip("s")]


def _second_of(c: str | Column) -> Column:
    return seconds_between(timestamp(_EPOCH), c)


def _time_of(seconds: str | Column) -> Column:
    return timestamp(_EPOCH) + F.expr("INTERVAL '1' SECOND") * (F.col(seconds) if isinstance(seconds, str) else seconds)


def _down(seconds: Column, step: int) -> Column:
    """The last point of the grid that is not later."""
    return F.floor(seconds / F.lit(step)) * F.lit(step)


def _up(seconds: Column, step: int) -> Column:
    return -_down(-seconds, step)


def _evaluated(
    maxima: DataFrame, rules, step: str, until: Column | None, max_age: str | None, since: dict[str, Column] | None = None,
    open_end: bool = False,
) -> DataFrame:
    """Stretches of evaluations that see one window: ``rule, w, first, last, breach, stale, began`` in seconds.

    ``began`` is the first evaluation of the breach that the stretch belongs to, if it does. ``since`` leaves out the
    evaluations of a rule before a time, where a breach is known to begin or not to go on. With ``open_end`` the last
    window has its evaluation even if that comes after all windows.
    """
    wide = _seconds(step)
    series = _by_rule(maxima, rules, ["fenetre"]).withColumn("seen", _second_of("fenetre"))
    if until is not None:
        series = series.withColumn("until", until)
    # Of several windows before one evaluation, the latest counts.
    latest = F.max(F.struct("seen", "value", "threshold"))
    points = series.groupBy("rule", _up(F.col("seen"), wide).alias("first")).agg(
        latest.alias("w"), *([F.max("until").alias("until")] if until is not None else [])
    )
    if since:
        points = points.filter(reduce(or_, [(F.col("rule") == rule) & (F.col("first") >= _second_of(at)) for rule, at in since.items()]))
    points = points.withColumn("first_eval", _time_of("first"))
    points = next_row(points, ["rule"], "first_eval", {"__next": "first"})
    last = F.col("w.seen") if until is None else F.greatest(F.col("w.seen"), _second_of("until"))
    end = F.greatest("first", _down(last, wide)) if open_end else _down(last, wide)
    points = points.withColumn("last", F.coalesce(F.col("__next") - wide, end))
    points = points.withColumn("latest", F.col("__next").isNull()).filter("first <= last")
    breach = _exceeds(F.col("w.value"), F.col("w.threshold"))
    if max_age is None:
        parts = points.withColumn("stale", F.lit(False)).withColumn("breach", breach)
    else:
        fresh_to = F.least(F.col("last"), _down(F.col("w.seen") + _seconds(max_age), wide))
        halves = F.array(
            F.struct(F.lit(False).alias("stale"), F.col("first").alias("f"), fresh_to.alias("l")),
            F.struct(F.lit(True).alias("stale"), F.greatest(F.col("first"), fresh_to + wide).alias("f"), F.col("last").alias("l")),
        )
        split = points.withColumn("b", breach).select("rule", "w", "b", "latest", F.inline(halves)).filter("f <= l")
        parts = split.select(
            "rule", "w", "stale", "latest", (F.col("b") & ~F.col("stale")).alias("breach"), F.col("f").alias("first"), F.col("l").alias("last")
        )
    # A breach began one step after the last evaluation without one.
    parts = parts.withColumn("day", F.to_date(_time_of("first"))).withColumn("calm", F.when(~F.col("breach"), F.col("last")))
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = parts.groupBy("rule", "day").agg(F.max("calm").alias("calm"), F.min("first").alias("first"))
    days = days.select(
        "rule", "day", F.max("calm").over(before.partitionBy("rule")).alias("carried"),
        F.min("first").over(Window.partitionBy("rule")).alias("origin"),
    )
    in_day = Window.partitionBy("rule", "day").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    known = parts.withColumn("near", F.max("calm").over(in_day)).join(days, ["rule", "day"])
    return known.withColumn("began", F.coalesce(F.coalesce("near", "carried") + wide, F.col("origin")))


def alert_runs(
    trend: DataFrame,
    rules=ALERT_RULES,
    hold: str = ALERT_HOLD,
    step: str = ALERT_STEP,
    until: Column | None = None,
    max_age: str | None = None,
) -> DataFrame:
    """Replay of the alert rules as runs of evaluations with one value and state: ``rule, first_eval, last_eval, value, state``.

    Evaluations stand on one grid, the multiples of ``step``, from the first window to the last (or ``until``); each
    sees the fleet maximum of the latest window at that time. A breach is ``pending`` until it has lasted ``hold``,
    then ``firing``. With ``max_age``, evaluations whose window is older are ``no_data``. A live evaluator runs on the
    wall clock; the replay clock makes the result repeatable.

    A window makes at most a few rows, however long the silence after it: a stray reading of another decade is one
    run. The start of a breach is looked up in the same day, then in one row per earlier day.
    """
    wide, held = _seconds(step), _seconds(hold)
    known = _evaluated(fleet_maxima(trend, rules), rules, step, until, max_age)
    fires = _up(F.col("began") + held, wide)
    states = F.array(
        F.struct(F.lit("no_data").alias("state"), F.col("first").alias("f"), F.when(F.col("stale"), F.col("last")).alias("l")),
        F.struct(F.lit("normal").alias("state"), F.col("first").alias("f"), F.when(~F.col("stale") & ~F.col("breach"), F.col("last")).alias("l")),
        F.struct(F.lit("pending").alias("state"), F.col("first").alias("f"), F.when(F.col("breach"), F.least("last", fires - wide)).alias("l")),
        F.struct(F.lit("firing").alias("state"), F.greatest("first", fires).alias("f"), F.when(F.col("breach"), F.col("last")).alias("l")),
    )
    runs = known.select("rule", F.col("w.value").alias("value"), F.inline(states)).filter("f <= l")
    return runs.select("rule", _time_of("f").alias("first_eval"), _time_of("l").alias("last_eval"), "value", "state")


def first_evaluation(window: Column, step: str = ALERT_STEP) -> Column:
    """The first evaluation that sees a window."""
    return _time_of(_up(_second_of(window), _seconds(step)))


def alert_episodes(
    maxima: DataFrame, rules=ALERT_RULES, step: str = ALERT_STEP, max_age: str | None = None, since: dict[str, Column] | None = None
) -> DataFrame:
    """The breaches of each rule: ``rule, debut, fin``, first and last evaluation; ``fin`` is NULL while the latest window breaches.

    ``maxima`` are the fleet maxima per window. A breach ends with the next window below, or, with ``max_age``, when its
    window has become older than that before another came.
    """
    known = _evaluated(maxima, rules, step, None, max_age, since, open_end=True).filter("breach")
    ends = known.groupBy("rule", "began").agg(F.max("last").alias("last"), F.bool_or("latest").alias("open"))
    return ends.select("rule", _time_of("began").alias("debut"), F.when(~F.col("open"), _time_of("last")).alias("fin"))


def states_at(
    episodes: DataFrame,
    maxima: DataFrame,
    as_of: Column,
    rules=ALERT_RULES,
    hold: str = ALERT_HOLD,
    step: str = ALERT_STEP,
    max_age: str | None = None,
) -> DataFrame:
    """``rule, eval_at, value, state`` at the last evaluation up to ``as_of``; no row before the first window.

    However old the latest window is, it counts and a breach of it goes on, unless ``max_age`` is given.
    """
    wide = _seconds(step)
    seen = maxima.withColumn("e", _down(_second_of(as_of), wide)).filter(_second_of("fenetre") <= F.col("e"))
    latest = seen.agg(F.max("e").alias("e"), F.max("fenetre").alias("fenetre"), *[F.max_by(c, "fenetre").alias(c) for c in rules])
    now = _by_rule(latest.filter("fenetre IS NOT NULL"), rules, ["e", "fenetre"])
    rows = episodes.select("rule", _second_of("debut").alias("d"), _second_of("fin").alias("f"))
    joined = now.join(rows, (now["rule"] == rows["rule"]) & (rows["d"] <= now["e"]) & (rows["f"].isNull() | (rows["f"] >= now["e"])), "left")
    stale = F.lit(False) if max_age is None else _down(_second_of("fenetre") + _seconds(max_age), wide) < F.col("e")
    state = (
        F.when(stale, "no_data").when(F.col("d").isNull(), "normal")
        .when(F.col("e") >= _up(F.col("d") + _seconds(hold), wide), "firing").otherwise("pending")
    )
    return joined.select(now["rule"], _time_of("e").alias("eval_at"), "value", state.alias("state"))


def alert_states(
    trend: DataFrame,
    rules=ALERT_RULES,
    hold: str = ALERT_HOLD,
    step: str = ALERT_STEP,
    until: Column | None = None,
    max_age: str | None = None,
    since: Column | None = None,
) -> DataFrame:
    """The runs of ``alert_runs``, one row per evaluation: ``rule, eval_at, value, state``.

    ``since`` leaves out earlier evaluations without changing later ones. Long runs are first cut by day, so that no
    array holds more than a day's evaluations.
    """
    runs = alert_runs(trend, rules, hold, step, until, max_age)
    if since is not None:
        wide = _seconds(step)
        floor = _time_of(_up(_second_of(since), wide))
        runs = runs.filter(F.col("last_eval") >= since).withColumn("first_eval", F.greatest("first_eval", floor))
    one_day, one_step = F.expr("INTERVAL '1' DAY"), interval(step)
    days = F.sequence(F.to_date("first_eval"), F.to_date("last_eval"), one_day)
    cut = runs.withColumn("day", F.explode(days)).withColumn("midnight", F.col("day").cast("timestamp_ntz"))
    wide = _seconds(step)
    begin = F.greatest(F.col("first_eval"), _time_of(_up(_second_of("midnight"), wide)))
    end = F.least(F.col("last_eval"), F.col("midnight") + one_day - F.expr("INTERVAL '1' SECOND"))
    cut = cut.withColumn("begin", begin).withColumn("end", end).filter("begin <= end")
    return cut.select("rule", F.explode(F.sequence("begin", "end", one_step)).alias("eval_at"), "value", "state")
