"""Tumbling-window vibration RMS and mean pressure from mergeable partial sums, and pressure trend."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from machpulse.functions.fixed_values import WINDOW
from machpulse.functions.time_columns import month_of, window_start
from machpulse.operators.neighbours import previous_row

KEYS = ["machine_id", "fenetre"]


def partial_windows(telemetry: DataFrame, window: str = WINDOW) -> DataFrame:
    """Mergeable state per machine and window. Map-side partial sums absorb any hot machine."""
    return (
        telemetry.select(
            "machine_id", window_start("datetime_mes", window).alias("fenetre"), "pressure", "vibration"
        )
        .groupBy(*KEYS)
        .agg(
            F.sum(F.col("vibration") * F.col("vibration")).alias("sum_sq"),
            F.sum("pressure").alias("sum_p"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def compact_state(state: DataFrame) -> DataFrame:
    """Fold all partials of a window into one row; merging the result gives the same windows."""
    return state.groupBy(*KEYS).agg(
        F.sum("sum_sq").alias("sum_sq"), F.sum("sum_p").alias("sum_p"), F.sum("n").alias("n")
    )


def merge_windows(state: DataFrame) -> DataFrame:
    """RMS and mean pressure per machine and window from any number of partials."""
    return compact_state(state).select(
        *KEYS,
        F.sqrt(F.col("sum_sq") / F.col("n")).alias("rms_vibration"),
        (F.col("sum_p") / F.col("n")).alias("pression_moyenne"),
    )


def window_metrics(telemetry: DataFrame, window: str = WINDOW) -> DataFrame:
    """The same windows in a single pass over raw telemetry."""
    return (
        telemetry.select(
            "machine_id", window_start("datetime_mes", window).alias("fenetre"), "pressure", "vibration"
        )
        .groupBy(*KEYS)
        .agg(
            F.sqrt(F.avg(F.col("vibration") * F.col("vibration"))).alias("rms_vibration"),
            F.avg("pressure").alias("pression_moyenne"),
        )
    )


def _minus_previous() -> Column:
    pressure = F.col("pression_moyenne")
    return (pressure - F.coalesce(F.col("__previous"), pressure)).alias("tendance_pression")


def pressure_trend(windows: DataFrame, split_days: bool = True) -> DataFrame:
    """Add the change of mean pressure against the machine's previous window; 0 for its first one.

    No group holds more than a day of a machine: rows are ranked within their day, and only the first and last
    row of each day meet in a second, small group. ``split_days=False`` orders a machine's whole history in one
    group, with one shuffle less, for short histories of many machines.
    """
    if split_days:
        staged = previous_row(windows, ["machine_id"], "fenetre", {"__previous": "pression_moyenne"})
    else:
        ordered = Window.partitionBy("machine_id").orderBy("fenetre")
        staged = windows.withColumn("__previous", F.lag("pression_moyenne").over(ordered))
    return staged.select(*windows.columns, _minus_previous())


def trend_of_state(state: DataFrame, split_days: bool = True) -> DataFrame:
    """Trend over stored partials.

    Partials of a window are first added up where they are read, so a machine with many small or late batches
    sends one row per window and task.
    """
    return pressure_trend(merge_windows(state), split_days)


def closing_windows(windows: DataFrame) -> DataFrame:
    """Last mean pressure of each machine."""
    return windows.groupBy("machine_id").agg(F.max_by("pression_moyenne", "fenetre").alias("pression_moyenne"))


def _between(state: DataFrame, start: Column | None, end: Column) -> DataFrame:
    """Windows in [start, end), with the month predicate that lets the partitioned table prune."""
    fenetre = F.col("fenetre")
    kept = state.filter(fenetre < end)
    if start is not None:
        kept = kept.filter(fenetre >= start)
    if "mois" in state.columns:
        kept = kept.filter(F.col("mois") <= month_of(end))
        if start is not None:
            kept = kept.filter(F.col("mois") >= month_of(start))
    return kept


def trend_of_day(state: DataFrame, run_date: str, edges: DataFrame | None = None) -> DataFrame:
    """Trend rows of one day, equal to the full-history trend filtered to that day.

    The day's first window of a machine compares with the machine's last earlier window. ``edges`` is the stored index
    of first and last windows per machine and day; with it no older window is read. Without it, the older windows of
    the day's machines are folded in one aggregation.
    """
    start = F.lit(str(run_date)).cast("date").cast("timestamp_ntz")
    end = start + F.expr("INTERVAL '1' DAY")
    today = merge_windows(_between(state, start, end))
    if edges is None:
        machines = _between(state, start, end).select("machine_id").distinct()
        earlier = _between(state, None, start).join(machines, "machine_id", "left_semi")
    else:
        earlier = _between(edges, None, start)
    closing = closing_windows(merge_windows(earlier))

    in_day = Window.partitionBy("machine_id").orderBy("fenetre")
    staged = today.withColumn("__in_day", F.lag("pression_moyenne").over(in_day))
    carried = closing.select("machine_id", F.col("pression_moyenne").alias("__carried"))
    return (
        staged.join(carried, "machine_id", "left")
        .withColumn("__previous", F.coalesce("__in_day", "__carried"))
        .select(*today.columns, _minus_previous())
    )


def edge_windows(state: DataFrame) -> DataFrame:
    """Of each machine and day only the first and the last window, for partials with one row per window.

    The edges of several batches, merged as partials, hold the true first and last window of every machine and day:
    whichever batch has a part of that window has it as its own first or last. What they hold of other windows may be
    a part only. Folding edges and taking the edges of the result gives edges again.
    """
    row = F.struct("fenetre", "sum_sq", "sum_p", "n")
    ends = state.groupBy("machine_id", F.to_date("fenetre").alias("__day")).agg(
        F.min_by(row, "fenetre").alias("__first"), F.max_by(row, "fenetre").alias("__last")
    )
    return ends.select("machine_id", F.inline(F.array_distinct(F.array("__first", "__last"))))


def _neighbours_of_days(days: DataFrame, edges: DataFrame) -> DataFrame:
    """Last window before and first window after each (machine, day) of ``days``, where that lies in another day."""
    near = merge_windows(edges.join(days.select("machine_id").distinct(), "machine_id", "left_semi"))
    row = F.struct("fenetre", "rms_vibration", "pression_moyenne")
    per_day = near.groupBy("machine_id", F.to_date("fenetre").alias("__day")).agg(
        F.min_by(row, "fenetre").alias("__first"), F.max_by(row, "fenetre").alias("__last")
    )
    # One row per day of a touched machine is ordered, not its windows.
    ordered = Window.partitionBy("machine_id").orderBy("__day")
    flagged = per_day.join(days.withColumn("__in", F.lit(True)), ["machine_id", "__day"], "left").withColumns(
        {"__after": F.lag("__in").over(ordered), "__before": F.lead("__in").over(ordered)}
    )
    wanted = F.array(F.when(F.col("__after"), F.col("__first")), F.when(F.col("__before"), F.col("__last")))
    rows = F.array_distinct(F.filter(wanted, lambda w: w.isNotNull()))
    return flagged.filter(F.col("__in").isNull()).select("machine_id", F.inline(rows))


def touched_trend(touched: DataFrame, state: DataFrame, edges: DataFrame) -> DataFrame:
    """The trend rows that new partials change: those of the touched windows and of each one's successor.

    ``touched`` holds the keys of the new partials, which ``state`` and ``edges`` already contain. Of the state only the
    touched days of touched machines are used; windows before and after come from the edges.
    """
    days = touched.select("machine_id", F.to_date("fenetre").alias("__day")).distinct()
    in_days = state.withColumn("__day", F.to_date("fenetre")).join(days, ["machine_id", "__day"], "left_semi")
    rows = merge_windows(in_days).unionByName(_neighbours_of_days(days, edges))
    marked = rows.join(touched.select(*KEYS).distinct().withColumn("__new", F.lit(True)), KEYS, "left")
    staged = previous_row(marked, ["machine_id"], "fenetre", {"__previous": "pression_moyenne", "__previous_new": "__new"})
    changed = staged.filter(F.coalesce("__new", "__previous_new", F.lit(False)))
    return changed.select(*rows.columns, _minus_previous())
