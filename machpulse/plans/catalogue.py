"""Registered queries: every operator over the whole given tables.

Surrogate numbers never leave a query; rows carry natural keys instead, so any engine can check them.
Doubles are rounded to six places.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from machpulse.functions.fixed_values import EVENT_SOURCES, MEASURES
from machpulse.functions.keyed_hash import key_table
from machpulse.functions.time_columns import month_of, timestamp, window_start
from machpulse.operators import consolidation, datamart, history, monitoring, privacy, quality, telemetry, writes
from machpulse.operators.constraints import check_constraints, orphans
from machpulse.plans import bindings as b
from machpulse.plans import runs
from machpulse.plans.batch import staging_rules
from machpulse.sources import messages as msg
from machpulse.sources.telemetry_store import quarantine_rows as to_quarantine_rows
from machpulse.sources.storage import stored
from machpulse.sources.telemetry_store import raw_rows as to_raw_rows
from machpulse.streaming.derived import AlertJournal, read_episodes
from machpulse.streaming.derived import alerts_now as read_alerts_now

_REGISTRY = {}


def _query(fn):
    _REGISTRY[fn.__name__] = fn
    return fn


def all_queries() -> dict:
    return dict(_REGISTRY)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in columns})


TREND = ("rms_vibration", "pression_moyenne", "tendance_pression")
SPLIT_DAY = "2024-01-15"
HISTORY_MACHINE = 42
PERIOD = ("2024-01-10 00:00:00", "2024-01-12 00:00:00")


# Messages, quality


@_query
def parsed_messages(spark: SparkSession, sf: str) -> DataFrame:
    parsed = msg.parse_messages(b.messages(spark, sf))
    sound = F.col("malformed_reason").isNull()
    kept = [F.when(sound, F.col(c)).alias(c) for c in ("machine_id", "datetime_mes", *MEASURES)]
    return rounded(parsed.select("event_id", *kept, "malformed_reason"), *MEASURES)


@_query
def dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    parsed = msg.parse_messages(b.messages(spark, sf))
    return parsed.filter(F.col("malformed_reason").isNotNull()).select("event_id", "value", "malformed_reason")


@_query
def typed_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Values of many JSON types, converted by their types."""
    parsed = msg.parse_messages(b.typed_messages(spark, sf), typed=True)
    volt = F.when(F.isnan("volt"), "NaN").otherwise(F.round("volt", 6).cast("decimal(18,6)").cast("string"))
    sound = F.col("malformed_reason").isNull()
    return parsed.select("event_id", F.when(sound, F.col("machine_id")).alias("machine_id"), F.when(sound, volt).alias("volt"), "malformed_reason")


@_query
def keyed_messages(spark: SparkSession, sf: str) -> DataFrame:
    return msg.to_messages(b.telemetry(spark, sf))


@_query
def topic_filter(spark: SparkSession, sf: str) -> DataFrame:
    return b.messages(spark, sf).filter(msg.topic_matches(F.col("topic"), b.TOPIC_FILTER)).select("event_id", "topic")


@_query
def range_flags(spark: SparkSession, sf: str) -> DataFrame:
    flagged = quality.flag_out_of_range(b.telemetry(spark, sf))
    return flagged.select("event_id", "machine_id", F.coalesce("motif", F.lit("valide")).alias("motif"))


@_query
def valid_quarantine_split(spark: SparkSession, sf: str) -> DataFrame:
    valid, rejected = b.split_telemetry(spark, sf)
    counted = [
        valid.groupBy(F.lit("valide").alias("motif")).agg(F.count(F.lit(1)).alias("n")),
        rejected.groupBy("motif").agg(F.count(F.lit(1)).alias("n")),
    ]
    return counted[0].unionByName(counted[1])


@_query
def range_profile(spark: SparkSession, sf: str) -> DataFrame:
    profile = quality.profile_bounds(b.telemetry(spark, sf))
    return rounded(profile, "min", "max", "margin_low", "margin_high")


@_query
def raw_table_rows(spark: SparkSession, sf: str) -> DataFrame:
    valid = b.valid_telemetry(spark, sf)
    return rounded(to_raw_rows(valid, F.col("horodatage_ingestion")), *MEASURES)


@_query
def quarantine_rows(spark: SparkSession, sf: str) -> DataFrame:
    rejected = b.split_telemetry(spark, sf)[1]
    return rounded(to_quarantine_rows(rejected, F.col("horodatage_quarantaine")), *MEASURES)


@_query
def silent_sensors(spark: SparkSession, sf: str) -> DataFrame:
    known = b.staging_machines(spark, sf).select("machine_id")
    return quality.silent_sensors(known, b.valid_telemetry(spark, sf), b.as_of(), "12 hours").orderBy("machine_id")


@_query
def last_seen(spark: SparkSession, sf: str) -> DataFrame:
    return quality.last_seen(b.valid_telemetry(spark, sf))


@_query
def never_seen(spark: SparkSession, sf: str) -> DataFrame:
    known = quality.known_machines(datamart.build_dim_machine(b.staging_machines(spark, sf)))
    seen = quality.last_seen(b.valid_telemetry(spark, sf)).select("machine_id")
    return known.exceptAll(seen)


# Windows and trend


@_query
def valid_window_trend(spark: SparkSession, sf: str) -> DataFrame:
    """Flag, drop implausible readings, one-minute windows, trend."""
    windows = telemetry.window_metrics(b.valid_telemetry(spark, sf))
    return rounded(telemetry.pressure_trend(windows), *TREND)


@_query
def minute_windows(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(telemetry.window_metrics(b.telemetry(spark, sf)), *TREND[:2])


@_query
def partial_states(spark: SparkSession, sf: str) -> DataFrame:
    states = telemetry.partial_windows(b.valid_telemetry(spark, sf), "1 hour")
    return rounded(states, "sum_sq", "sum_p")


@_query
def merged_states(spark: SparkSession, sf: str) -> DataFrame:
    """Minute partials merged into day windows."""
    partials = telemetry.partial_windows(b.telemetry(spark, sf))
    by_day = partials.withColumn("fenetre", window_start("fenetre", "1 day"))
    return rounded(telemetry.merge_windows(by_day), *TREND[:2])


@_query
def hourly_trend(spark: SparkSession, sf: str) -> DataFrame:
    windows = telemetry.window_metrics(b.telemetry(spark, sf), "1 hour")
    return rounded(telemetry.pressure_trend(windows), *TREND)


@_query
def trend_split_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """Minute trend with every window group kept within one day."""
    windows = telemetry.window_metrics(b.telemetry(spark, sf))
    return rounded(telemetry.pressure_trend(windows, split_days=True), *TREND)


@_query
def trend_of_partials(spark: SparkSession, sf: str) -> DataFrame:
    """The same trend from mergeable partials, one shuffle after they are built."""
    return rounded(telemetry.trend_of_state(telemetry.partial_windows(b.telemetry(spark, sf))), *TREND)


@_query
def day_trend_with_carry(spark: SparkSession, sf: str) -> DataFrame:
    """One day's trend from stored partials, the previous window looked up in the past."""
    state = telemetry.partial_windows(b.telemetry(spark, sf)).withColumn("mois", month_of("fenetre"))
    return rounded(telemetry.trend_of_day(state, b.RUN_DATE), *TREND)


@_query
def machine_history(spark: SparkSession, sf: str) -> DataFrame:
    source = b.telemetry(spark, sf, F.col("user_id") == HISTORY_MACHINE)
    rows = history.machine_history(source, HISTORY_MACHINE)
    return rounded(rows.select("machine_id", "datetime_mes", *MEASURES), *MEASURES).orderBy("datetime_mes")


@_query
def fleet_period(spark: SparkSession, sf: str) -> DataFrame:
    start, end = timestamp(PERIOD[0]), timestamp(PERIOD[1])
    # Whole seconds at both ends, so the times before rounding down lie in the same period.
    source = b.telemetry(spark, sf, (F.col("ts") >= start) & (F.col("ts") < end))
    rows = history.fleet_period(source, start, end)
    return rounded(rows.select("event_id", "machine_id", "datetime_mes", *MEASURES), *MEASURES)


# Landing and staging


@_query
def landed_staging(spark: SparkSession, sf: str) -> DataFrame:
    """Deliver the files as CSV under their date, read them back renamed and typed."""
    tables = runs.landed(spark, sf)
    return reduce(
        DataFrame.unionByName,
        [
            df.select(
                F.lit(name).alias("source"),
                F.col("datetime_evt") if "datetime_evt" in df.columns else F.lit(None).cast("timestamp_ntz").alias("datetime_evt"),
                "machine_id", F.col(code).alias("code"), (F.col("age") if "age" in df.columns else F.lit(None).cast("int")).alias("age"),
            )
            for name, code, df in tables
        ],
    )


def _staged_before(spark, sf, name):
    rows = b.staging_events(spark, sf, name)
    return rows.filter(F.col("datetime_evt") < timestamp(f"{SPLIT_DAY} 00:00:00")).distinct()


@_query
def staging_insert(spark: SparkSession, sf: str) -> DataFrame:
    """Whole error list offered to a table that already holds its first half."""
    keys = ["datetime_evt", "machine_id", "error_id"]
    return writes.insert_if_absent(_staged_before(spark, sf, "erreurs"), b.staging_events(spark, sf, "erreurs"), keys)


@_query
def staging_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows attempted and inserted per table."""
    counted = []
    for name, rows in b.all_staging_events(spark, sf).items():
        held = _staged_before(spark, sf, name).withColumn("held", F.lit(True))
        per_key = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
        offered = per_key.join(held, rows.columns, "left").agg(
            F.sum("copies").alias("attempted"), F.count_if(F.col("held").isNull()).alias("inserted")
        )
        counted.append(offered.select(F.lit(name).alias("source"), "attempted", "inserted"))
    return reduce(DataFrame.unionByName, counted)


@_query
def first_write_wins(spark: SparkSession, sf: str) -> DataFrame:
    """Machine list with one row per order of a customer: the youngest offered age stays."""
    offered = b.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("int").alias("machine_id"),
        F.concat(F.lit("model"), (F.col("o_orderkey") % 4 + 1).cast("string")).alias("model"),
        (F.col("o_orderkey") % 21).cast("int").alias("age"),
    )
    return writes.first_per_key(offered, ["machine_id"], ["age", "model"])


# Star schema


@_query
def dim_machine(spark: SparkSession, sf: str) -> DataFrame:
    """Upsert of the whole machine list into a dimension that holds part of it with older attributes."""
    customers = b.table(spark, sf, "customer")
    debtors = customers.filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").cast("int").alias("machine_id"))
    machines = b.staging_machines(spark, sf)
    earlier = machines.join(debtors, "machine_id", "left_semi").withColumn("age", F.col("age") + 1)
    held = datamart.build_dim_machine(earlier)
    merged = datamart.build_dim_machine(machines, held)
    before = held.select("machine_id_nat", F.col("id_machine").alias("held_id"))
    return merged.join(before, "machine_id_nat", "left").select(
        "machine_id_nat",
        "model",
        "age",
        "tranche_age",
        F.coalesce(F.col("held_id") == F.col("id_machine"), F.lit(False)).alias("surrogate_kept"),
    )


@_query
def surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Unique and complete numbers on machines and codes."""
    star = b.star(spark, sf)
    tables = {"machine": (star["machines"], "id_machine"), "code": (star["codes"], "id_code")}
    checked = [
        df.agg(
            F.count(F.lit(1)).alias("n"),
            F.countDistinct(key).alias("n_distinct"),
            F.count_if(F.col(key).isNull() | (F.col(key) <= 0)).alias("n_bad"),
        ).select(F.lit(name).alias("dimension"), "n", "n_distinct", "n_bad")
        for name, (df, key) in tables.items()
    ]
    return checked[0].unionByName(checked[1])


def _dates(df: DataFrame) -> DataFrame:
    return df.withColumn("date_complete", F.col("date_complete").cast("string"))


@_query
def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    return _dates(datamart.build_dim_date(*b.all_staging_events(spark, sf).values()))


@_query
def dim_date_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Every day between the first and the last order."""
    orders = b.table(spark, sf, "orders").select(F.col("o_orderdate").cast("timestamp_ntz").alias("datetime_evt"))
    return _dates(datamart.build_dim_date(orders, calendar=True))


@_query
def dim_code(spark: SparkSession, sf: str) -> DataFrame:
    star = b.star(spark, sf)
    return star["codes"].join(F.broadcast(star["types"].drop("libelle")), "id_type_evenement").select(
        "code_type", "code_brut", "libelle"
    )


@_query
def event_type_usage(spark: SparkSession, sf: str) -> DataFrame:
    star = b.star(spark, sf)
    used = star["fact"].groupBy("id_type_evenement").agg(F.count(F.lit(1)).alias("n"))
    return used.join(F.broadcast(star["types"]), "id_type_evenement").select("code_type", "libelle", "n")


def _star_rows(spark, sf, fact=None, star=None) -> DataFrame:
    star = star or b.star(spark, sf)
    rows = datamart.star_rows(star["fact"] if fact is None else fact, star["machines"], star["types"], star["codes"])
    return rows.withColumn("sans_operateur", F.col("id_operateur").isNull()).drop("id_operateur")


@_query
def event_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Fused events joined back to their dimensions."""
    return _star_rows(spark, sf)


@_query
def event_fact_increment(spark: SparkSession, sf: str) -> DataFrame:
    """Rows a rerun over the whole history would append to a fact that stops at the split day."""
    star = b.star(spark, sf)
    held = star["fact"].filter(F.col("id_date") < consolidation.id_date_value(SPLIT_DAY))
    fresh = datamart.build_event_fact(star["events"], star["machines"], star["types"], star["codes"], held)
    return _star_rows(spark, sf, fresh, star)


@_query
def interventions(spark: SparkSession, sf: str) -> DataFrame:
    star = b.star(spark, sf)
    return _star_rows(spark, sf, datamart.interventions(star["fact"], star["types"]), star)


@_query
def event_history(spark: SparkSession, sf: str) -> DataFrame:
    star = b.star(spark, sf)
    rows = history.event_history(star["fact"], star["machines"], HISTORY_MACHINE)
    return _star_rows(spark, sf, rows, star).orderBy("datetime_evt")


@_query
def orphan_events(spark: SparkSession, sf: str) -> DataFrame:
    """Errors, failures and maintenance of machines that are missing from a partial machine list."""
    customers = b.table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
    parent = customers.select(F.col("c_custkey").cast("int").alias("machine_id"))
    found = [
        orphans(b.staging_events(spark, sf, table), "machine_id", parent, "machine_id").select(
            F.lit(table).alias("source"), "datetime_evt", "machine_id", F.col(code).alias("code")
        )
        for table, (_, code, _) in EVENT_SOURCES.items()
    ]
    return reduce(DataFrame.unionByName, found)


@_query
def constraint_report(spark: SparkSession, sf: str) -> DataFrame:
    """Rules of the staging machines and the three event tables, the latter against a partial machine list."""
    customers = b.table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
    parent = customers.select(F.col("c_custkey").cast("int").alias("machine_id"))
    # Against the 16 bits of the telemetry table's id column; the load itself takes wider ids.
    narrow = staging_rules("machines", machine_ids=(0, 65535))
    reports = [check_constraints(b.staging_machines(spark, sf), narrow).withColumn("source", F.lit("machines"))]
    for table, (_, code, _) in EVENT_SOURCES.items():
        rules = staging_rules(table, parent)
        report = check_constraints(
            b.staging_events(spark, sf, table),
            type(rules)(
                not_null=rules.not_null,
                checks={code: ~F.col(code).isin("error5", "comp4")},
                lengths={code: 5},
                unique=(("datetime_evt", "machine_id", code),),
                foreign=rules.foreign,
            ),
        )
        reports.append(report.withColumn("source", F.lit(table)))
    return reduce(DataFrame.unionByName, reports).select("source", "rule", F.col("violations").cast("long").alias("violations"))


# Daily consolidation


def _day_trend(spark, sf, run_date):
    """The day's trend: its own windows, and of earlier days the index of first and last windows only."""
    state = telemetry.partial_windows(b.valid_telemetry(spark, sf))
    edges = stored(telemetry.edge_windows(state), "edges")
    return telemetry.trend_of_day(state, run_date, edges)


def _day(spark, sf, run_date, star):
    return consolidation.consolidate(
        star["machines"],
        consolidation.daily_telemetry(_day_trend(spark, sf, run_date), run_date),
        consolidation.daily_events(star["fact"], star["machines"], star["types"], run_date),
        run_date,
    )


DAY_MEASURES = ("rms_vibration_moyen", "rms_vibration_max", "tendance_pression_moyenne")


def _natural_day(day: DataFrame, machines: DataFrame) -> DataFrame:
    named = day.join(machines.select("id_machine", "machine_id_nat"), "id_machine").drop("id_machine")
    return rounded(named, *DAY_MEASURES)


@_query
def daily_telemetry(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(consolidation.daily_telemetry(_day_trend(spark, sf, b.RUN_DATE), b.RUN_DATE), *DAY_MEASURES)


@_query
def daily_events(spark: SparkSession, sf: str) -> DataFrame:
    star = b.star(spark, sf)
    return consolidation.daily_events(star["fact"], star["machines"], star["types"], b.RUN_DATE)


@_query
def daily_consolidation(spark: SparkSession, sf: str) -> DataFrame:
    star = b.star(spark, sf)
    return _natural_day(_day(spark, sf, b.RUN_DATE, star), star["machines"])


@_query
def daily_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A day that was first loaded without telemetry, next to the day before, is loaded again in full."""
    star = b.star(spark, sf)
    none = [F.lit(None).cast("double").alias(c) for c in DAY_MEASURES]
    counts = list(consolidation.COUNTS.values())

    def events_only(run_date):
        events = consolidation.daily_events(star["fact"], star["machines"], star["types"], run_date)
        return events.join(star["machines"], "machine_id_nat").select(
            F.lit(consolidation.id_date_value(run_date)).alias("id_date"), "id_machine", *none, *counts
        )

    held = events_only("2024-01-09").unionByName(events_only(b.RUN_DATE))
    written = writes.upsert(held, _day(spark, sf, b.RUN_DATE, star), ["id_date", "id_machine"])
    return _natural_day(written, star["machines"])


# Monitoring


@_query
def health_panels(spark: SparkSession, sf: str) -> DataFrame:
    valid, rejected = b.split_telemetry(spark, sf)
    letters = msg.parse_messages(b.messages(spark, sf)).filter(F.col("malformed_reason").isNotNull())
    stamped = letters.withColumn("horodatage_rejet", b.as_of())
    return rounded(monitoring.health(valid, rejected, b.as_of(), stamped), "value")


@_query
def recent_readings(spark: SparkSession, sf: str) -> DataFrame:
    rows = monitoring.recent(b.valid_telemetry(spark, sf), "horodatage_ingestion", b.as_of(), "1 day")
    return rows.select("event_id", "machine_id", "datetime_mes", "horodatage_ingestion")


def _valid_trend(spark, sf):
    return telemetry.pressure_trend(telemetry.window_metrics(b.valid_telemetry(spark, sf)))


@_query
def latest_breaches(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(monitoring.latest_breaches(_valid_trend(spark, sf)), "value")


@_query
def machine_breaches(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(monitoring.latest_breaches(_valid_trend(spark, sf), per_machine=True), "value")


@_query
def alert_states(spark: SparkSession, sf: str) -> DataFrame:
    """Both rules at every minute of the event span."""
    return rounded(monitoring.alert_states(_valid_trend(spark, sf)), "value")


@_query
def alert_states_5min(spark: SparkSession, sf: str) -> DataFrame:
    """Both rules every five minutes: of the windows since the evaluation before, the latest counts."""
    return rounded(monitoring.alert_states(_valid_trend(spark, sf), step="5 minutes", hold="10 minutes"), "value")


@_query
def trend_in_view_order(spark: SparkSession, sf: str) -> DataFrame:
    """The trend as its view lists it, by machine and window."""
    return rounded(_valid_trend(spark, sf), *TREND).orderBy("machine_id", "fenetre")


@_query
def daily_run_interrupted(spark: SparkSession, sf: str) -> DataFrame:
    """The day table after one good run and one that died before it was published."""
    warehouse = runs.interrupted(spark, sf)
    return _natural_day(warehouse.days(spark), warehouse.dimension(spark, "dim_machine"))


# Privacy


@_query
def pseudonymised_operators(spark: SparkSession, sf: str) -> DataFrame:
    return privacy.pseudonymise_operators(b.operators(spark, sf), key_table(spark, b.DEMO_KEY))


@_query
def pseudonym_join(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and operators pseudonymised apart still join."""
    key = key_table(spark, b.DEMO_KEY)
    people = privacy.pseudonymise_operators(b.operators(spark, sf), key)
    per_badge = b.table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    badges = per_badge.select(F.concat(F.lit("OP-"), F.col("o_custkey").cast("string")).alias("matricule"), "n")
    hidden = privacy.pseudonymise(badges, ["matricule"], key)
    joined = people.join(hidden, "matricule_pseudonymise")
    return joined.groupBy("equipe").agg(F.count(F.lit(1)).alias("operateurs"), F.sum("n").alias("interventions"))


@_query
def refused_identifiers(spark: SparkSession, sf: str) -> DataFrame:
    """Badges blank for one team and missing for another are refused, the others hashed."""
    blanked = F.when(F.col("equipe") == "FURNITURE", "").when(F.col("equipe") != "MACHINERY", F.col("matricule"))
    rows = b.operators(spark, sf).withColumn("matricule", blanked)
    made = privacy.pseudonymise(rows, ["matricule"], key_table(spark, b.DEMO_KEY), on_empty="reject")
    return made.select("nom", "equipe", "matricule_pseudonymise", "rejet_motif")


# Streams and daily runs


@_query
def stream_trend(spark: SparkSession, sf: str) -> DataFrame:
    """Messages streamed in several micro-batches; the trend that each batch kept up."""
    store = runs.streamed(spark, sf)
    return rounded(store.read_trend(spark), *TREND)


@_query
def stream_replayed(spark: SparkSession, sf: str) -> DataFrame:
    """Every micro-batch delivered twice, then the state folded into segments: same windows."""
    store = runs.streamed(spark, sf, replay=True)
    runs.fold(spark, store)
    return rounded(telemetry.merge_windows(store.read_state(spark)), *TREND[:2])


@_query
def stream_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Rows the stream left in each table."""
    store = runs.streamed(spark, sf)
    parts = [
        store.read(spark, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("sink"), "n")
        for t in ("telemetrie", "lac", "quarantaine", "rejets")
    ]
    return reduce(DataFrame.unionByName, parts)


@_query
def stream_batch_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts logged per micro-batch, added up."""
    counts = runs.streamed(spark, sf).read(spark, "lots")
    return counts.agg(*[F.sum(c).alias(c) for c in ("valides", "quarantaine", "malformes")])


@_query
def stream_raw_table(spark: SparkSession, sf: str) -> DataFrame:
    """Raw table as the stream wrote it, its older batches folded into larger files."""
    store = runs.streamed(spark, sf)
    runs.fold(spark, store)
    rows = store.read(spark, "telemetrie")
    return rounded(rows.select("machine_id", "datetime_mes", *MEASURES, "mois"), *MEASURES)


@_query
def daily_run(spark: SparkSession, sf: str) -> DataFrame:
    """Landing, staging, star schema and machine x day table, run twice for the same day."""
    warehouse = runs.batch(spark, sf, times=2)
    return _natural_day(warehouse.days(spark), warehouse.dimension(spark, "dim_machine"))


@_query
def daily_run_events(spark: SparkSession, sf: str) -> DataFrame:
    """Event fact after two runs of the same day, by type and day."""
    warehouse = runs.batch(spark, sf, times=2)
    types = datamart.event_types(spark)
    counted = warehouse.events(spark).groupBy("id_type_evenement", "id_date").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(F.broadcast(types), "id_type_evenement").select("code_type", "id_date", "n")


@_query
def relay_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of the sensor topics that the relay could not read; those of other topics are not its own."""
    letters = runs.relayed(spark, sf)[1]
    return letters.select("topic", "value", "malformed_reason")


@_query
def relayed_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Well-formed messages of the sensor topics, counted per key."""
    published = runs.relayed(spark, sf)[0]
    return published.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


@_query
def alerts_now(spark: SparkSession, sf: str) -> DataFrame:
    """Both rules at one time, from the journal that the stream kept."""
    store = runs.streamed(spark, sf, alerts=AlertJournal())
    return rounded(read_alerts_now(spark, store, b.as_of()), "value")


@_query
def alert_journal(spark: SparkSession, sf: str) -> DataFrame:
    """Every breach that the stream's journal holds after its last batch."""
    return read_episodes(spark, runs.streamed(spark, sf, alerts=AlertJournal()))


@_query
def stream_health(spark: SparkSession, sf: str) -> DataFrame:
    """Health panels from the one row per batch that the stream kept."""
    lots = runs.streamed(spark, sf).read(spark, "lots")
    return rounded(monitoring.health_of_batches(lots, b.as_of()), "value")
