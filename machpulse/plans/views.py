"""Every table and derived view under one name each, for queries in plain SQL."""

from pyspark.sql import DataFrame, SparkSession

from machpulse import schemas
from machpulse.operators import datamart
from machpulse.operators.telemetry import merge_windows
from machpulse.plans.batch import SNAPSHOTS, Warehouse
from machpulse.sources.telemetry_store import TelemetryStore


def register_telemetry(spark: SparkSession, store: TelemetryStore) -> list[str]:
    """Raw readings, quarantine, dead letters, window partials, and the two views read over them."""
    frames = {
        "telemetrie": store.read(spark, "telemetrie"),
        "telemetrie_quarantaine": store.read(spark, "quarantaine"),
        "telemetrie_rejets": store.read(spark, "rejets"),
        "telemetrie_fenetre_1min": store.read_state(spark),
        "v_telemetrie_fenetre_1min": merge_windows(store.read_state(spark)),
        "v_telemetrie_tendance": store.read_trend(spark),
    }
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)


def register_warehouse(spark: SparkSession, warehouse: Warehouse, operators: DataFrame | None = None) -> list[str]:
    """Published dimensions and facts, and the interventions among the events.

    ``operators`` are the pseudonymised operators, empty if none are given.
    """
    types = datamart.event_types(spark)
    frames = {name: warehouse.dimension(spark, name) for name in SNAPSHOTS}
    frames = {name: df for name, df in frames.items() if df is not None}
    frames |= {
        "dim_type_evenement": types,
        "dim_operateur": spark.createDataFrame([], schemas.DIM_OPERATOR) if operators is None else operators.select(*schemas.DIM_OPERATOR.names),
        "fait_evenement": warehouse.events(spark),
        "fait_telemetrie_jour": warehouse.days(spark),
        "v_interventions": datamart.interventions(warehouse.events(spark), types),
    }
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)
