"""Whole runs on the given tables in a fresh work folder: landing, stream, daily batch."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from machpulse.functions.fixed_values import EVENT_SOURCES, STAGING_FILES
from machpulse.functions.time_columns import month_of
from machpulse.operators.telemetry import edge_windows, partial_windows
from machpulse.plans import bindings as b
from machpulse.plans.batch import Warehouse, run_batch
from machpulse.sources import landing, storage, streams
from machpulse.sources.telemetry_store import TelemetryStore
from machpulse.streaming.derived import AlertJournal
from machpulse.streaming.ingest import process_batch, run_stream
from machpulse.streaming.relay import relay

# Message files are delivered per day; one micro-batch takes up to this many.
FILES_PER_BATCH = 8
INGEST_CLOCK = datetime(2024, 1, 31)


def delivered_frames(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The four files with their source headers."""
    frames = {}
    for filename, (table, mapping) in STAGING_FILES.items():
        rows = b.staging_machines(spark, sf) if table == "machines" else b.staging_events(spark, sf, table)
        frames[filename] = rows.select(*[F.col(target).cast("string").alias(source) for source, target in mapping])
    return frames


def _land(spark: SparkSession, sf: str) -> str:
    root = storage.work_folder(spark, "raw")
    landing.land(delivered_frames(spark, sf), root, b.RUN_DATE)
    return root


def landed(spark: SparkSession, sf: str) -> list[tuple[str, str, DataFrame]]:
    """(table, code column, typed rows) of the four landed files; a machine's code is its model."""
    root = _land(spark, sf)
    landing.require_landed(spark, root, b.RUN_DATE)
    found = []
    for filename, (table, _) in STAGING_FILES.items():
        code = EVENT_SOURCES[table][1] if table in EVENT_SOURCES else "model"
        found.append((table, code, landing.read_landed(spark, root, b.RUN_DATE, filename)))
    return found


def streamed(spark: SparkSession, sf: str, replay: bool = False, alerts: AlertJournal | None = None) -> TelemetryStore:
    """All messages through the streaming query. ``replay`` repeats each batch's writes; ``alerts`` keeps the journal."""
    root = storage.work_folder(spark, "stream")
    delivered = b.messages(spark, sf).select("value", "jour").hint("rebalance", "jour")
    delivered.write.partitionBy("jour").text(f"{root}/messages")
    store = TelemetryStore(f"{root}/store")
    source = streams.text_stream(spark, f"{root}/messages", FILES_PER_BATCH).select("value")
    if not replay:
        run_stream(source, store, f"{root}/checkpoint", available_now=True, clock=_clock, alerts=alerts).awaitTermination()
        return store

    def twice(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, store, _clock)
        process_batch(batch, batch_id, store, _clock)

    writer = source.writeStream.foreachBatch(twice).option("checkpointLocation", f"{root}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return store


def relayed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """All messages with their topics through the relay: what it published, and its dead letters."""
    root = storage.work_folder(spark, "relay")
    b.messages(spark, sf).select("topic", "value").write.parquet(f"{root}/messages")
    source = streams.file_stream(spark, f"{root}/messages", spark.read.parquet(f"{root}/messages").schema)
    relay(
        source, {"path": f"{root}/keyed"}, f"{root}/checkpoint", sink="parquet", available_now=True, rejects=f"{root}/rejets", clock=_clock
    ).awaitTermination()
    return spark.read.parquet(f"{root}/keyed"), spark.read.parquet(f"{root}/rejets")


def _clock() -> datetime:
    return INGEST_CLOCK


def fold(spark: SparkSession, store: TelemetryStore) -> None:
    """Fold all but the newest batch of state and raw table, in two segments, and drop what they cover."""
    for table in ("etats", "telemetrie"):
        older = storage.numbered(spark, store.folder(table), "batch_id=")[:-1]
        for last in sorted({len(older) // 2, len(older) - 1}) if older else []:
            store.compact(spark, table, older[last])
        store.drop_folded(spark, table, keep_seconds=0)


def batch(spark: SparkSession, sf: str, times: int = 1) -> Warehouse:
    """The daily run, ``times`` times over."""
    raw = _land(spark, sf)
    warehouse = Warehouse(storage.work_folder(spark, "warehouse"))
    state = storage.stored(partial_windows(b.valid_telemetry(spark, sf)).withColumn("mois", month_of("fenetre")), "state")
    edges = storage.stored(edge_windows(state).withColumn("mois", month_of("fenetre")), "edges")
    for _ in range(times):
        run_batch(spark, b.RUN_DATE, raw, warehouse, state, edges=edges)
    return warehouse


class Unpublished(Warehouse):
    """A warehouse whose runs die just before they become visible."""

    def publish(self, spark: SparkSession, run_id: int) -> None:
        pass


def interrupted(spark: SparkSession, sf: str) -> Warehouse:
    """One published run, and a rerun of the same day without any telemetry that is never published."""
    warehouse = batch(spark, sf)
    empty = partial_windows(b.valid_telemetry(spark, sf).limit(0)).withColumn("mois", month_of("fenetre"))
    run_batch(spark, b.RUN_DATE, _land(spark, sf), Unpublished(warehouse.root), empty)
    return warehouse
