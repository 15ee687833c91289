"""Star schema: machine, date, type and code dimensions, and the fused event fact."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from machpulse import schemas
from machpulse.functions.fixed_values import (
    AGE_BANDS,
    EVENT_SOURCES,
    EVENT_TYPES,
    INTERVENTION_TYPES,
    OLDEST_BAND,
    WEEKDAYS,
)
from machpulse.functions.time_columns import id_date_of, iso_weekday
from machpulse.operators.writes import absent, hash_key, number_new_keys, upsert


def event_types(spark: SparkSession) -> DataFrame:
    """The three event types. Literal rows, so broadcasting them is always safe."""
    rows = ", ".join(f"({number}, '{code}', '{label}')" for number, code, label in EVENT_TYPES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({', '.join(schemas.DIM_TYPE.fieldNames())})")


def age_band(age: Column) -> Column:
    (first, label), *others = AGE_BANDS
    bands = F.when(age <= first, label)
    for upper, label in others:
        bands = bands.when(age <= upper, label)
    return bands.otherwise(OLDEST_BAND)


def build_dim_machine(
    machines: DataFrame, existing: DataFrame | None = None, latest_snapshot: bool = False
) -> DataFrame:
    """Type-1 dimension: attributes follow staging, surrogates stay, unknown machines get new ones.

    ``latest_snapshot`` expects an extra ``run_date`` column and takes each machine's newest row
    instead of its only one.
    """
    if latest_snapshot:
        newest = F.max_by(F.struct("model", "age"), "run_date").alias("m")
        machines = machines.groupBy("machine_id").agg(newest).select("machine_id", "m.*")
    current = machines.select(
        F.col("machine_id").alias("machine_id_nat"),
        "model",
        "age",
        age_band(F.col("age")).alias("tranche_age"),
    )
    columns = schemas.DIM_MACHINE.fieldNames()
    if existing is None:
        merged = current.withColumn("id_machine", F.lit(None).cast("int"))
    else:
        merged = upsert(existing, current, ["machine_id_nat"])
    return number_new_keys(merged, ["machine_id_nat"], "id_machine", existing).select(*columns)


def build_dim_date(*event_tables: DataFrame, existing: DataFrame | None = None, calendar: bool = False) -> DataFrame:
    """One row per day that has an event; with ``calendar``, every day between the first and the last."""
    days = reduce(
        DataFrame.unionByName,
        [t.select(F.to_date("datetime_evt").alias("d")).filter(F.col("d").isNotNull()).distinct() for t in event_tables],
    ).distinct()
    if calendar:
        days = days.agg(F.min("d").alias("a"), F.max("d").alias("b")).filter(F.col("a").isNotNull())
        days = days.select(F.explode(F.sequence("a", "b")).alias("d"))
    names = F.array(*[F.lit(w) for w in WEEKDAYS])
    built = days.select(
        id_date_of("d").alias("id_date"),
        F.col("d").alias("date_complete"),
        F.year("d").alias("annee"),
        F.quarter("d").alias("trimestre"),
        F.month("d").alias("mois"),
        F.dayofmonth("d").alias("jour"),
        F.element_at(names, iso_weekday("d")).alias("jour_semaine"),
        (iso_weekday("d") >= 6).alias("est_weekend"),
    )
    return built if existing is None else upsert(existing, built, ["id_date"], "nothing")


def fuse_events(erreurs: DataFrame, pannes: DataFrame, maintenances: DataFrame) -> DataFrame:
    """The three sources under one shape, one row per natural key."""
    tables = {"erreurs": erreurs, "pannes": pannes, "maintenances": maintenances}
    shaped = [
        tables[table].select(
            "datetime_evt",
            "machine_id",
            F.lit(code_type).alias("code_type"),
            F.col(code).alias("code_brut"),
            F.lit(source).alias("source_fichier"),
        )
        for table, (code_type, code, source) in EVENT_SOURCES.items()
    ]
    # Every column belongs to the natural key, so copies collapse map-side before any join.
    return reduce(DataFrame.unionByName, shaped).distinct()


def build_dim_code(events: DataFrame, types: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Codes seen per event type. ``events`` is the output of :func:`fuse_events`."""
    pairs = events.select("code_type", "code_brut").distinct()
    seen = pairs.join(F.broadcast(types.select("code_type", "id_type_evenement")), "code_type").select(
        "id_type_evenement", "code_brut", F.col("code_brut").alias("libelle")
    )
    keys = ["id_type_evenement", "code_brut"]
    columns = schemas.DIM_CODE.fieldNames()
    if existing is None:
        merged = seen.withColumn("id_code", F.lit(None).cast("int"))
    else:
        merged = upsert(existing, seen, keys, "nothing")
    return number_new_keys(merged, keys, "id_code", existing).select(*columns)


def build_event_fact(
    events: DataFrame,
    dim_machine: DataFrame,
    types: DataFrame,
    dim_code: DataFrame,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Fact rows to append. ``events`` is the output of :func:`fuse_events`.

    Only the three-row type table is broadcast by hint. The other dimensions grow with the data: pass
    them as stored tables, so that the planner broadcasts them by their measured size. Above the
    broadcast threshold the join shuffles, and adaptive execution splits the partitions of a hot
    machine or code.
    """
    machines = dim_machine.select(F.col("machine_id_nat").alias("machine_id"), "id_machine")
    codes = dim_code.select("id_type_evenement", "code_brut", "id_code")
    rows = (
        events.join(F.broadcast(types.select("code_type", "id_type_evenement")), "code_type")
        .join(codes, ["id_type_evenement", "code_brut"])
        .join(machines, "machine_id")
        .withColumns(
            {
                "id_date": id_date_of("datetime_evt"),
                "id_operateur": F.lit(None).cast("int"),
            }
        )
    )
    if existing is not None:
        # One row per natural key already: the dimensions map natural keys one to one.
        rows = absent(existing, rows, schemas.FACT_EVENT_KEY)
    return rows.withColumn("id_evenement", hash_key(schemas.FACT_EVENT_KEY)).select(*schemas.FACT_EVENT.fieldNames())


def interventions(fact: DataFrame, types: DataFrame) -> DataFrame:
    """Failures and maintenance only; a mere error is no intervention."""
    wanted = types.filter(F.col("code_type").isin(*INTERVENTION_TYPES)).select("id_type_evenement")
    return fact.join(F.broadcast(wanted), "id_type_evenement", "left_semi").select(*fact.columns)


def star_rows(fact: DataFrame, dim_machine: DataFrame, types: DataFrame, dim_code: DataFrame) -> DataFrame:
    """Fact rows with the natural keys of their dimensions."""
    return (
        fact.join(F.broadcast(types.select("id_type_evenement", "code_type")), "id_type_evenement")
        .join(dim_code.select("id_code", "code_brut"), "id_code")
        .join(dim_machine.select("id_machine", "machine_id_nat"), "id_machine")
        .select("machine_id_nat", "code_type", "code_brut", "datetime_evt", "id_date", "id_operateur", "source_fichier")
    )

