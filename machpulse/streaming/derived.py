"""Tables that follow each micro-batch: only what the batch touches is worked out again."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from machpulse.functions.fixed_values import ALERT_HOLD, ALERT_RULES, ALERT_STEP
from machpulse.functions.time_columns import interval, month_of
from machpulse.operators.monitoring import alert_episodes, first_evaluation, fleet_maxima, states_at
from machpulse.operators.telemetry import KEYS, touched_trend
from machpulse.sources import storage
from machpulse.sources.telemetry_store import TelemetryStore, newest_version


def months_of_batch(spark: SparkSession, store: TelemetryStore, table: str, batch_id: int) -> list[int]:
    """The months that a batch wrote to, from the names of its folders."""
    found = storage.names(spark, store.batch_folder(table, batch_id))
    return sorted(int(n.removeprefix("mois=")) for n in found if n.startswith("mois="))


def _span(rows: DataFrame) -> tuple[Column, Column]:
    """First and last window of a batch's rows, one row on the driver."""
    first, last = rows.agg(F.min("fenetre"), F.max("fenetre")).first()
    return tuple(F.lit(str(t)).cast("timestamp_ntz") for t in (first, last))


def changed_trend(spark: SparkSession, store: TelemetryStore, batch_id: int) -> DataFrame:
    """Trend rows that the batch's partials change.

    Of the state only the months of the batch are read, and of these the files whose times meet the batch's days.
    """
    touched = store.read_batch(spark, "etats", batch_id).select(*KEYS)
    months, (first, last) = months_of_batch(spark, store, "etats", batch_id), _span(touched)
    begin, end = (F.to_date(t).cast("timestamp_ntz") for t in (first, last + interval("1 day")))
    state = store.read_state(spark).filter(F.col("mois").isin(months) & (F.col("fenetre") >= begin) & (F.col("fenetre") < end))
    return touched_trend(touched, state, store.read(spark, "bords"))


def update_trend(spark: SparkSession, store: TelemetryStore, batch_id: int) -> None:
    """Write the batch's changes of the stored trend; they replace older versions of the same windows."""
    changed = changed_trend(spark, store, batch_id)
    store.write_batch("tendance", batch_id, changed.withColumn("mois", month_of("fenetre")))


@dataclass(frozen=True)
class AlertJournal:
    """What a stream's journal of breaches is kept for. ``max_age`` ends a breach whose window has become older."""

    rules: dict[str, float] = field(default_factory=lambda: dict(ALERT_RULES))
    step: str = ALERT_STEP
    max_age: str | None = None


def update_maxima(spark: SparkSession, store: TelemetryStore, batch_id: int, journal: AlertJournal) -> None:
    """Write the fleet maxima of the windows whose trend the batch changed."""
    changed = store.read_batch(spark, "tendance", batch_id)
    months, (first, last) = months_of_batch(spark, store, "tendance", batch_id), _span(changed)
    rows = store.read(spark, "tendance").filter(F.col("mois").isin(months) & F.col("fenetre").between(first, last))
    rows = rows.join(changed.select("fenetre").distinct(), "fenetre", "left_semi").select(*rows.columns)
    maxima = fleet_maxima(newest_version(rows, ("machine_id", "fenetre")), journal.rules)
    store.write_batch("maxima", batch_id, maxima.withColumn("mois", month_of("fenetre")))


def read_maxima(spark: SparkSession, store: TelemetryStore, since: Column | None = None) -> DataFrame:
    rows = store.read(spark, "maxima")
    if since is not None:
        rows = rows.filter((F.col("fenetre") >= since) & (F.col("mois") >= month_of(since)))
    return newest_version(rows, ("fenetre",)).drop("version", "mois")


def read_episodes(spark: SparkSession, store: TelemetryStore, before: int | None = None) -> DataFrame:
    """The journal as it stands: ``rule, debut, fin``; with ``before``, as it stood before that batch."""
    rows = store.read(spark, "alertes")
    if before is not None:
        rows = rows.filter(F.col("version") < before)
    return newest_version(rows, ("rule", "debut")).filter("NOT retire").select("rule", "debut", "fin")


def update_alerts(spark: SparkSession, store: TelemetryStore, batch_id: int, journal: AlertJournal) -> None:
    """Append what the batch changes in the journal: new breaches, new ends, and breaches that late data take back.

    Evaluations before the first changed window stand. They are worked out again from there, or from the start of the
    breach that the window falls into or goes on from, over the fleet maxima (one row per window).
    """
    first = first_evaluation(_span(store.read_batch(spark, "maxima", batch_id))[0], journal.step)
    held = read_episodes(spark, store, batch_id)
    before = first - interval(journal.step)
    reaching = held.filter((F.col("debut") < first) & (F.col("fin").isNull() | (F.col("fin") >= before)))
    begun = {r["rule"]: F.lit(str(r["debut"])).cast("timestamp_ntz") for r in reaching.groupBy("rule").agg(F.min("debut").alias("debut")).collect()}
    since = {rule: begun.get(rule, first) for rule in journal.rules}
    start = F.least(*since.values()) if len(since) > 1 else next(iter(since.values()))
    maxima = read_maxima(spark, store, start - interval(journal.step))
    found = alert_episodes(maxima, journal.rules, journal.step, journal.max_age, since)
    later = F.lit(False)
    for rule, at in since.items():
        later = later | ((F.col("rule") == rule) & (F.col("debut") >= at))
    old = held.filter(later).select("rule", "debut", F.col("fin").alias("__fin"), F.lit(True).alias("__held"))
    both = found.withColumn("__found", F.lit(True)).join(old, ["rule", "debut"], "full_outer")
    same = F.col("__found") & F.col("__held") & F.col("fin").eqNullSafe(F.col("__fin"))
    changes = both.filter(~F.coalesce(same, F.lit(False)))
    store.write_batch("alertes", batch_id, changes.select("rule", "debut", "fin", F.col("__found").isNull().alias("retire")).coalesce(1))


def alerts_now(
    spark: SparkSession, store: TelemetryStore, as_of: Column, journal: AlertJournal = AlertJournal(), hold: str = ALERT_HOLD
) -> DataFrame:
    """Each rule's state at ``as_of`` from the journal: ``rule, eval_at, value, state``."""
    episodes, maxima = read_episodes(spark, store), read_maxima(spark, store)
    return states_at(episodes, maxima, as_of, journal.rules, hold, journal.step, journal.max_age)
